"""Repair of conversation structure by a square-root checkpointed dynamic program (op 11).

Rows of a conversation are taken by turn (NULLs first), then role, then SHA-256 of the text. A row
is *blank* without a character other than blank and \\x09-\\x0D, else a *duplicate* if its role and
text stand earlier, else *truncated* if its last such character is not one of ``.!?``. Edits
turn the sequence of role initials into ``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (2),
Delete (3, the only edit of a blank or duplicate row), Insert an empty user or assistant row (2);
a truncated row that stays adds 1. The cheapest edits are given, of these the ASCII-least.

The program has four states (nothing yet, after s, after u, after a). Backward cost vectors are
kept at every sqrt(n)-th row only; walking forward, the vectors of one block are computed again
and the first letter in D, I, K, R that is tight is taken.

Across tasks the same scheme holds. Rows without their texts are range-partitioned in order, so
that a conversation with a third of all rows is many tasks' work; each cuts its part into blocks
of 1, 2, 3, ... times ``FIRST_BLOCK`` rows, so a conversation has in the order of sqrt(n) blocks a
task. Conversations inside one block are edited at once. For others a block gives its 4 x 4 cost
matrix; one group of a conversation's matrices gives the vectors at the block ends (the
checkpoints), each block computes its vectors again for its exits from the four states, one group
of exits gives the entry states, and the blocks emit their edits.

Texts move once, sorted by conversation beside their edits; a task reads them as a stream. (The
contract's hash runs over a whole conversation, so that last pass is one stream a conversation,
with memory for one row.)

Defined cases: a NULL role or text is one blank; a NULL conv_id is a conversation; a role that is
empty or of another initial than s, u, a can't stay as it is; rows equal in all four columns are
copies that stand together; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinark.llm.common import read_table, stored

FIRST_BLOCK = 1024
#: What the contract takes as white space, and the ends of a whole text.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")

DELETE, REROLE, INSERT, CUT_SHORT = 3, 2, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
_THEN = (USER, USER, ASSISTANT, USER)                 # the state after the role that must follow
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_INITIAL = {"s": 0, "u": 1, "a": 2}
_FAR = 1 << 40
FINAL = (0, 2 * INSERT, INSERT, 0)                    # costs after the last row: what is open is closed

Vector = tuple[int, int, int, int]


# --- the program over row codes -------------------------------------------------

def code_of(role: str, must_go: bool, truncated: bool) -> int:
    """0 for a row that must go, else 1 + 2 * (place of its initial in s, u, a, other) + truncated."""
    return 0 if must_go else 1 + 2 * _INITIAL.get(role[:1], 3) + truncated


@lru_cache(maxsize=1 << 16)
def _choices(code: int, after: Vector, state: int) -> tuple[tuple[str, int, int], ...]:
    """(letter, next state, cost to the end) of the edits of a row, without an insert before it."""
    out = [("D", state, DELETE + after[state])]
    if code:
        kind, short = divmod(code - 1, 2)
        then = _THEN[state]
        if kind == 0 and state == START:
            out.append(("K", SYSTEM, short * CUT_SHORT + after[SYSTEM]))
        elif (kind, then) in ((1, USER), (2, ASSISTANT)):
            out.append(("K", then, short * CUT_SHORT + after[then]))
        out.append(("R", then, REROLE + short * CUT_SHORT + after[then]))
    return tuple(out)


@lru_cache(maxsize=1 << 16)
def back(code: int, after: Vector) -> Vector:
    """The cost vector before a row from that after it, less its smallest cost (``shift`` is that)."""
    best = [min(c for _, _, c in _choices(code, after, s)) for s in range(4)]
    user, assistant = min(best[USER], INSERT + best[ASSISTANT]), min(best[ASSISTANT], INSERT + best[USER])
    full = (min(best[START], INSERT + user), min(best[SYSTEM], INSERT + user), user, assistant)
    return tuple(min(c, _FAR) for c in full)


def _relative(v: Vector) -> Vector:
    low = min(v)
    return tuple(c - low if c < _FAR else _FAR for c in v)


@lru_cache(maxsize=1 << 16)
def _tight(code: int, after: Vector, state: int) -> tuple[str, str, int]:
    """(roles inserted before the row, its letter, the state after it): the ASCII-least tight edits."""
    before, inserted = back(code, after), ""
    while True:
        options = {letter: (then, cost) for letter, then, cost in _choices(code, after, state)}
        tight = {letter for letter, (_, cost) in options.items() if cost == before[state]}
        if INSERT + before[_THEN[state]] == before[state]:
            tight.add("I")
        letter = min(tight)
        if letter != "I":
            return inserted, letter, options[letter][0]
        state = _THEN[state]
        inserted += _ROLE[state][0]


def tight_edits(codes: bytes, state: int, end: Vector) -> tuple[list[tuple[str, str, int]], int]:
    """(inserted roles, letter, state after) of every row, and the state behind the last.

    Vectors are stored at every sqrt(n)-th row; the rows between are computed again block by block."""
    n = len(codes)
    size = isqrt(n) + 1
    v, checkpoints = _relative(end), {}
    for i in range(n - 1, -1, -1):
        if (i + 1) % size == 0 or i == n - 1:
            checkpoints[i // size] = v                  # the vector after the block's last row
        v = _relative(back(codes[i], v))
    out = []
    for block in range(-(-n // size)):
        lo, hi = block * size, min(n, (block + 1) * size)
        after = [checkpoints[block]]
        for i in range(hi - 1, lo, -1):
            after.append(_relative(back(codes[i], after[-1])))
        for i in range(lo, hi):
            edit = _tight(codes[i], after[hi - 1 - i], state)
            out.append(edit)
            state = edit[2]
    return out, state


def cost_matrix(codes: bytes) -> list[int]:
    """Cheapest costs from each state before the rows (row) to each state after them (column)."""
    columns = []
    for t in range(4):
        v, total = tuple(0 if s == t else _FAR for s in range(4)), 0
        for code in reversed(codes):
            v = back(code, v)
            low = min(v)
            total += low
            v = _relative(v)
        columns.append([c + total if c < _FAR else _FAR for c in v])
    return [columns[t][s] for s in range(4) for t in range(4)]


def closing(state: int) -> str:
    """Roles inserted behind the last row."""
    return {SYSTEM: "ua", USER: "a"}.get(state, "")


# --- tables ---------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """The contract's faults, by crc32(conv_id:turn) mod 20: 0 drops the row, 1 empties its text, 2 takes
    out its ``.!?``, 3 repeats it, 4 sets the role to user. NULLs are one blank."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        F.pmod(F.crc32(name.cast("binary")), F.lit(20)).alias("fault")).where("fault <> 0")
    text = (F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", "".join(ENDS), ""))
            .otherwise(F.col("text")))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _keyed(conversations: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(" "))
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                                F.unhex(F.sha2(text, 256)).alias("key"), text.alias("text"))


def _row_codes(keyed: DataFrame) -> DataFrame:
    """One row per different (conv_id, turn, role, text) with n copies: blank, truncated, and whether its
    first copy is the first of its role and text."""
    end = F.rtrim("text", F.lit(BLANKS))
    rows = (keyed.select("conv_id", "turn", "role", "key", (end == "").alias("blank"),
                         (~F.substring(end, -1, 1).isin(*ENDS)).alias("truncated"))
            .groupBy("conv_id", "turn", "role", "key")
            .agg(F.count(F.lit(1)).alias("n"), F.bool_or("blank").alias("blank"), F.bool_or("truncated").alias("truncated")))
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = (rows.groupBy("conv_id", "role", "key").agg(F.min(order).alias("at"), F.count(F.lit(1)).alias("places"))
             .where("places > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("key").alias("k"), "at"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k"))
    return rows.join(again, same, "left").select(
        "conv_id", "turn", "role", "key", "n", "blank", "truncated",
        (F.col("at.known").isNull() | F.col("at").eqNullSafe(order)).alias("first"))


def _blocks(first_block: int):
    """Sorted rows to blocks. A block is whole if its conversation surely lies in it: it is neither the
    task's first nor its last one, which may go on in another task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        conv, nth, ended, rows = None, 0, 0, []

        def close(whole: bool) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            codes = bytes(code_of(role, blank or not first, truncated)
                          for role, blank, truncated, first in zip(cols[2], *cols[5:], strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], types[0]), pa.array([part], pa.int32()), pa.array([number], pa.int64()),
                 pa.array([whole]), pa.array([codes], pa.binary()),
                 pa.array([[] if whole else cost_matrix(codes)], pa.list_(pa.int64())),
                 *(pa.array([list(c)], pa.list_(t)) for c, t in zip(cols[1:], types[1:], strict=True))], schema=_block_schema(types))

        for batch in batches:
            types = [f.type for f in batch.schema]
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                done = bool(rows) and row[0] != conv
                if done or len(rows) == first_block * (nth + 1):
                    yield close(done and not nth and ended > 0)
                    number, rows = number + 1, []
                    nth, ended = (0, ended + 1) if done else (nth + 1, ended)
                conv = row[0]
                rows.append(row)
        if rows:
            yield close(False)
    return run


def _block_schema(types) -> pa.Schema:
    return pa.schema([("conv_id", types[0]), ("part", pa.int32()), ("block", pa.int64()), ("whole", pa.bool_()),
                      ("codes", pa.binary()), ("matrix", pa.list_(pa.int64())),
                      *((c, pa.list_(t)) for c, t in zip(("turns", "roles", "keys", "ns", "blanks", "shorts", "firsts"),
                                                         types[1:], strict=True))])


def _ends(table: pa.Table) -> pa.Table:
    """The cost vector behind each block of one conversation, from the blocks' matrices."""
    table = table.sort_by([("part", "ascending"), ("block", "ascending")])
    v, out = np.array(FINAL), []
    for m in reversed(table.column("matrix").to_pylist()):
        out.append(v.tolist())
        v = np.minimum((np.array(m).reshape(4, 4) + v).min(1), _FAR)
        v = np.where(v < _FAR, v - v.min(), _FAR)
    return pa.table({"p": table.column("part"), "b": table.column("block"), "end": pa.array(out[::-1], pa.list_(pa.int64()))})


def _entries(table: pa.Table) -> pa.Table:
    """Each block's entry state, from every block's exits, and which block is the last."""
    table = table.sort_by([("part", "ascending"), ("block", "ascending")])
    state, out = START, []
    for exits in table.column("exits").to_pylist():
        out.append(state)
        state = exits[state]
    return pa.table({"p": table.column("part"), "b": table.column("block"), "entry": pa.array(out, pa.int32()),
                     "end": table.column("end"), "last": pa.array([False] * (len(out) - 1) + [True])})


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes, ends = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        exits = [[tight_edits(c, s, tuple(e))[1] for s in range(4)] for c, e in zip(codes, ends, strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 1, 2, 4)), pa.array(exits, pa.list_(pa.int32()))],
                                         ["conv_id", "part", "block", "end", "exits"])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks (codes, entry, end, last, rows) to one edit row per different row."""
    for batch in batches:
        col = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            end = col["end"][i].as_py()
            edits, state = tight_edits(col["codes"][i].as_py(), col["entry"][i].as_py(), tuple(end))
            n = len(edits)
            behind = [""] * n
            if col["last"][i].as_py():
                behind[-1] = closing(state)
            letters = pa.array([e[1] for e in edits], pa.string())
            yield pa.RecordBatch.from_arrays(
                [col["conv_id"].take(pa.array([i] * n, pa.int64())), col["turns"][i].values, col["roles"][i].values,
                 col["keys"][i].values, col["ns"][i].values, col["blanks"][i].values, col["shorts"][i].values,
                 col["firsts"][i].values, pa.array([e[0] for e in edits], pa.string()), letters,
                 pa.array([_ROLE.get(e[2]) if e[1] == "R" else None for e in edits], pa.string()),
                 pa.array(behind, pa.string())],
                ["conv_id", "turn", "role", "key", "n", "blank", "truncated", "first", "before", "edit", "new_role", "after"])


def edits(keyed: DataFrame, first_block: int = FIRST_BLOCK) -> DataFrame:
    """The edits of every different row, without texts (see the module text)."""
    conv = keyed.schema["conv_id"].dataType.simpleString()
    codes = stored(_row_codes(keyed), "conversation-rows")
    order = ("conv_id", "turn", "role", "key")
    rows = ("turns array<bigint>, roles array<string>, keys array<binary>, ns array<bigint>, blanks array<boolean>, "
            "shorts array<boolean>, firsts array<boolean>")
    blocks = stored(codes.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _blocks(first_block), f"conv_id {conv}, part int, block bigint, whole boolean, codes binary, matrix array<bigint>, {rows}"),
        "conversation-blocks")
    one, several = blocks.where("whole"), blocks.where("not whole")
    ends = several.select("conv_id", "part", "block", "matrix").groupBy("conv_id").applyInArrow(
        _ends, "p int, b bigint, end array<bigint>")
    same = (F.col("part") == F.col("p")) & (F.col("block") == F.col("b"))
    exits = several.select("conv_id", "part", "block", "codes").join(ends, same).select(
        "conv_id", "part", "block", "codes", "end").mapInArrow(
        _exits, f"conv_id {conv}, part int, block bigint, end array<bigint>, exits array<int>")
    entries = stored(exits.groupBy("conv_id").applyInArrow(_entries, "p int, b bigint, entry int, end array<bigint>, last boolean"),
                     "conversation-entries")
    columns = ["conv_id", "codes", "entry", "end", "last", "turns", "roles", "keys", "ns", "blanks", "shorts", "firsts"]
    plan = one.withColumns({"entry": F.lit(START), "end": F.array(*map(F.lit, FINAL)).cast("array<bigint>"),
                            "last": F.lit(True)}).select(*columns)
    plan = plan.unionByName(several.join(entries, same).select(*columns))
    return plan.mapInArrow(_edits, f"conv_id {conv}, turn bigint, role string, key binary, n bigint, blank boolean, "
                                   "truncated boolean, first boolean, before string, edit string, new_role string, after string")


_SCRIPT = "turn bigint, role string, fault string, edit string, new_role string, text string"
_KEPT = ("n", "blank", "truncated", "first", "before", "edit", "new_role", "after")


def _script(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edit rows, each followed by its rows with texts, to one row per edit, in order."""
    edit, left = None, 0
    for batch in batches:
        out = []
        rows = batch.to_pylist()
        conv_type = batch.schema.field("conv_id").type
        for r in rows:
            if r["edit"] is not None:
                edit, left = r, r["n"]
                continue
            if left == edit["n"]:
                out += [(r["conv_id"], None, None, None, "I", _ROLE[USER if b == "u" else ASSISTANT], "") for b in edit["before"]]
                lead = edit["first"] and not edit["blank"]
            else:
                lead = False
            fault = ("blank" if edit["blank"] else "duplicate" if not lead else "truncated" if edit["truncated"] else None)
            letter = edit["edit"] if lead else "D"
            role = None if letter == "D" else edit["new_role"] or r["role"]
            out.append((r["conv_id"], r["turn"], r["role"], fault, letter, role, r["text"] if letter != "D" else None))
            left -= 1
            if not left:
                out += [(r["conv_id"], None, None, None, "I", _ROLE[USER if b == "u" else ASSISTANT], "") for b in edit["after"]]
        if out:
            cols = list(zip(*out, strict=True))
            types = [conv_type, pa.int64(), *[pa.string()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             ["conv_id", "turn", "role", "fault", "edit", "new_role", "text"])


def repair(conversations: DataFrame, first_block: int = FIRST_BLOCK) -> DataFrame:
    """Rows (conv_id, turn, role, text) to their edit script: conv_id, turn, role and fault of the row (NULL for
    an inserted one), edit (K, R, D, I), new_role and text after it (NULL for D).

    A conversation's edits stand together, in order, within one partition; the repaired conversation is
    the rows whose edit is not D."""
    conv = conversations.schema["conv_id"].dataType.simpleString()
    keyed = _keyed(conversations)
    nothing = {c: F.lit(None) for c in _KEPT}
    texts = keyed.withColumns(nothing)
    made = edits(keyed, first_block).withColumn("text", F.lit(None).cast("string"))
    both = made.unionByName(texts.select(*made.columns)).withColumn("later", F.col("edit").isNull())
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "key", "later").drop("later", "key")
    return both.mapInArrow(_script, f"conv_id {conv}, {_SCRIPT}")


_DIGEST = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
           "repaired_sha256 string")
_LEGAL = {"su", "ua", "au"}
_COST = {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a conversation's script rows to the contract's columns."""
    conv, now, schema = None, None, None

    def row():
        gaps = now["high"] - now["low"] + 1 - now["turns"] if now["turns"] else 0
        values = [conv, gaps, *(now[c] for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
                  "".join(now["audit"]), now["sha"].hexdigest()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, schema.types, strict=True)], schema=schema)

    for batch in batches:
        schema = pa.schema([("conv_id", batch.schema.field("conv_id").type),
                            *((c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _DIGEST.split(", "))])
        for r in batch.to_pylist():
            if now is None or r["conv_id"] != conv:
                if now is not None:
                    yield row()
                conv = r["conv_id"]
                now = dict(low=None, high=None, turns=0, blank=0, duplicate=0, truncated=0, illegal=0, cost=0, audit=[],
                           sha=hashlib.sha256(), initial=None, written=False)
            now["audit"].append(r["edit"])
            now["cost"] += _COST[r["edit"]] + (CUT_SHORT if r["fault"] == "truncated" and r["edit"] != "D" else 0)
            if r["edit"] != "D":
                now["sha"].update(("\n" * now["written"] + r["new_role"] + ":" + r["text"]).encode())
                now["written"] = True
            if r["edit"] == "I":
                continue
            if r["fault"]:
                now[r["fault"]] += 1
            initial = r["role"][:1]
            now["illegal"] += now["initial"] is not None and now["initial"] + initial not in _LEGAL
            now["initial"] = initial
            if r["turn"] is not None and r["turn"] != now["high"]:
                now["low"] = r["turn"] if now["low"] is None else now["low"]
                now["high"], now["turns"] = r["turn"], now["turns"] + 1
    if now is not None:
        yield row()


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Faults, cost, edits and hash of the repair of every damaged conversation."""
    given = read_table(spark, sf_dir, "conversations")
    conv = given.schema["conv_id"].dataType.simpleString()
    found = repair(damage(given)).mapInArrow(_digests, f"conv_id {conv}, {_DIGEST}")
    found = found.withColumnRenamed("conv_id", "c")
    rows = given.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    empty = hashlib.sha256().hexdigest()
    return rows.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
