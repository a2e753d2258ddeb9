"""Conversation repair against a plain search over all edits."""

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinark.llm import conversations as C

GRAMMAR = re.compile(r"(s?(ua)+)?")
BLANK = " \t\n\x0b\x0c\r"


def faults(rows):
    """rows (turn, role, text) in order to [(turn, role, text, fault)]."""
    seen, out = set(), []
    for turn, role, text in rows:
        end = text.rstrip(BLANK)
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def plain(rows):
    """(cost, audit, repaired text): the cheapest, ASCII-least edits by a forward search that keeps
    the best (cost, audit) of every prefix of the grammar."""
    then = {"": "u", "s": "u", "u": "a", "a": "u"}

    def inserted(best):
        for _ in range(4):
            for last, (cost, audit, text) in list(best.items()):
                new = (cost + 2, audit + "I", [*text, ("user" if then[last] == "u" else "assistant") + ":"])
                best[then[last]] = min(best.get(then[last], new), new, key=lambda x: x[:2])
        return best

    best = {"": (0, "", [])}
    for _, role, text, fault in rows:
        new = {}

        def offer(last, item, new=new):
            new[last] = min(new.get(last, item), item, key=lambda x: x[:2])

        for last, (cost, audit, out) in inserted(best).items():
            offer(last, (cost + 3, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            extra = fault == "truncated"
            if role[:1] == then[last] or (role[:1] == "s" and last == ""):
                offer(role[:1], (cost + extra, audit + "K", [*out, role + ":" + text]))
            name = "user" if then[last] == "u" else "assistant"
            offer(then[last], (cost + 2 + extra, audit + "R", [*out, name + ":" + text]))
        best = new
    cost, audit, out = min((v for k, v in inserted(best).items() if k in ("", "a")), key=lambda x: x[:2])
    return cost, audit, "\n".join(out)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))


def digest(rows):
    rows = faults(ordered(rows))
    turns = [t for t, *_ in rows if t is not None]
    count = [sum(f == x for *_, f in rows) for x in ("blank", "duplicate", "truncated")]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, text = plain(rows)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *count, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumns({c: F.lit(1) for c in ("key", "n", "first", "fault", "edit", "part", "later", "copy")})


def digests(spark, df, first_block=C.FIRST_BLOCK):
    got = C.repair(df, first_block).mapInArrow(C._digests, f"conv_id long, {C._DIGEST}")
    return {r["conv_id"]: tuple(r)[1:] for r in got.collect()}


def conversations(seed, n):
    rng = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "tool", "", "ä"]
    texts = ["One.", "two", " ", "", "Three! \n", "four?", "five\x0b", ".", "x" * 50 + "."]
    out = []
    for conv in range(n):
        size = int(rng.integers(1, 12))
        turns = rng.integers(0, 8, size)
        out += [(conv, None if rng.random() < 0.1 else int(t), str(rng.choice(roles, p=[.35, .35, .15, .05, .05, .05])),
                 str(rng.choice(texts)) + (str(rng.integers(100)) + "." if rng.random() < 0.5 else "")) for t in turns]
    return out


def by_conversation(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    return {c: digest(r) for c, r in groups.items()}


@pytest.mark.parametrize("first_block", [1, C.FIRST_BLOCK])
def test_many_small_conversations(spark, first_block):
    rows = conversations(0, 150)
    assert digests(spark, frame(spark, rows), first_block) == by_conversation(rows)


@pytest.mark.parametrize("first_block", [3, 40])
def test_one_conversation_over_many_blocks_and_tasks(spark, first_block):
    rng = np.random.default_rng(5)
    rows = [(7, t, str(rng.choice(["user", "assistant", "system"], p=[.5, .4, .1])),
             str(rng.choice(["a.", "b", "", f"t{t}.", f"u{t}"], p=[.02, .02, .05, .6, .31]))) for t in range(3000)]
    rows += [(c, t, "user", "x.") for c in (6, 8) for t in range(3)]
    df = frame(spark, rows)
    blocks = C.edits(C._keyed(df), first_block)
    assert blocks.count() > 2000
    assert digests(spark, df, first_block) == by_conversation(rows)


def test_edge_rows(spark):
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (1, None, "user", "a."), (1, None, "assistant", "b"),
            (2, 5, "user", "same."), (2, 5, "user", "same."), (2, 9, "user", "same."), (2, 6, "assistant", "ok."),
            (3, 1, "system", "only."), (4, 1, "user", "line.\n" * 50_000), (4, 2, "assistant", "fine."), (5, 1, "", "x."),
            (6, -5, "assistant", "later?"), (7, 1, None, "x."), (8, 1, "user", " \t")]
    assert digests(spark, frame(spark, rows)) == by_conversation(rows)


def test_empty_table(spark):
    assert C.repair(frame(spark, [])).collect() == []


def test_audit_gives_the_grammar_and_matches_the_script(spark):
    rows = conversations(4, 60)
    script = defaultdict(list)
    for part in C.repair(frame(spark, rows)).rdd.glom().collect():
        for r in part:
            script[r["conv_id"]].append(r)
    for got in script.values():
        kept = [r for r in got if r["edit"] != "D"]
        assert GRAMMAR.fullmatch("".join(r["new_role"][0] for r in kept))
        assert all(r["text"] is None for r in got if r["edit"] == "D")
        assert all(r["edit"] == "D" for r in got if r["fault"] in ("blank", "duplicate"))


def test_program_against_all_edits():
    """Short code sequences against every string of edits."""
    for codes in itertools.product(range(9), repeat=3):
        best = None
        for letters in itertools.product("DKR", repeat=3):
            for before in itertools.product(range(3), repeat=4):
                state, cost, audit, ok = C.START, 0, "", True
                for code, letter, k in zip([*codes, None], [*letters, ""], before, strict=True):
                    for _ in range(k):
                        state, cost, audit = C._THEN[state], cost + 2, audit + "I"
                    if code is None:
                        break
                    move = {x: (t, c) for x, t, c in C._choices(code, (0, 0, 0, 0), state)}
                    if letter not in move:
                        ok = False
                        break
                    state, cost, audit = move[letter][0], cost + move[letter][1], audit + letter
                if ok and state in (C.START, C.ASSISTANT):
                    best = min(best or (cost, audit), (cost, audit))
        edits, state = C.tight_edits(bytes(codes), C.START, C.FINAL)
        assert "".join("I" * len(b) + x for b, x, _ in edits) + "I" * len(C.closing(state)) == best[1]


def test_damage(spark):
    rows = [(c, t, "assistant", f"a. b! c? {t}.") for c in range(30) for t in range(4)] + [(None, None, None, None)]
    got = defaultdict(list)
    for r in C.damage(frame(spark, rows)).collect():
        got[r["conv_id"], r["turn"]].append((r["role"], r["text"]))
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault, row = zlib.crc32(name.encode()) % 20, (role or " ", text or " ")
        want = {0: [], 1: [(row[0], "")], 2: [(row[0], re.sub("[.!?]", "", row[1]))], 3: [row, row], 4: [("user", row[1])]}
        assert got[conv, turn] == want.get(fault, [row])
