"""Near-duplicate documents by fast similarity sketches, banding and exact checks (op 5).

Sketch. ``COORDINATES`` minima are filled in rounds: in round i every shingle is hashed to
one bin with the value i + r; a later round only fills bins that are still empty, and the
last ``COORDINATES`` rounds place every shingle in one given bin, so each coordinate is
filled whatever the set's size. One pass over a large set is enough (the sketch costs
n + t log t, not n * t), and coordinate agreement concentrates around the similarity as
for independent minima. ``bands_for`` gives the number of bands of ``ROWS`` at which a pair at
the wanted similarity shares none with probability ``MISS`` at most (25 at 0.85, 37 at 0.8).

Whole job without all pairs. (1) Documents with equal shingle sets (128-bit sum of the
set) form one class; only its smallest row goes on. (2) Band buckets of two or more classes
are kept. (3) Every member is checked against its bucket's smallest one, on the full
shingle sets of the two texts; a group of thousands of mutual copies is connected by one
pair per member. (4) Buckets whose other members are still not connected are searched
whole: buckets that share members form a group, its members are dealt into blocks, and a
task takes two blocks, accumulates all intersection sizes term by term from the one's
postings and returns only links that connect something new. No pair of a bucket is
dropped, and none is emitted without being a link. (5) Links give the components.

Defined cases: a NULL or wordless text has an empty set, is linked with nothing and is its
own component; fewer words than a shingle make one shingle of the whole text; a row with
NULL doc_id has a NULL component and is kept; rows that repeat a doc_id are texts of their own, and
their components are one, as the id is reachable from all of them (``by_id`` False keeps them apart);
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinark.llm.common import NOT_BLANK, chunks, mix, read_table, row_words, stored, text_bytes
from clinark.llm.components import components

SHINGLE = 5
PERCENT = 85
ROWS = 5
MISS = 5e-7


def bands_for(percent: int) -> int:
    return 1 if percent >= 100 else math.ceil(math.log(MISS) / math.log1p(-(percent / 100) ** ROWS))


BANDS = bands_for(PERCENT)
COORDINATES = ROWS * BANDS
BLOCK_MEMBERS = 512
BLOCK_SHINGLES = 1 << 19
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = np.array([pow(0xBF58476D1CE4E5B9, j + 1, 1 << 64) for j in range(8)], np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row of a chunk, and the rows' offsets in them."""
    words, bounds = row_words(data, offsets, NOT_BLANK)
    count = np.diff(bounds)
    long = count >= width
    rolled = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for j in range(width):
        rolled += words[j:j + len(rolled)] * _STEP[j]
    per_row = np.where(long, count - width + 1, (count > 0).astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(per_row)])
    out = np.empty(ends[-1], np.uint64)
    for row in np.flatnonzero(per_row):
        a, n = bounds[row], count[row]
        if n >= width:
            out[ends[row]:ends[row + 1]] = rolled[a:a + n - width + 1]
        else:
            out[ends[row]] = (words[a:a + n] * _STEP[:n]).sum(dtype=np.uint64) ^ np.uint64(n)
    out = mix(out)
    for row in np.flatnonzero(per_row > 1):
        out[ends[row]:ends[row + 1]].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    keep[ends[:-1][per_row > 0]] = True
    return out[keep], np.concatenate([[0], np.cumsum(keep)])[ends]


def sketch(hashes: np.ndarray, bounds: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Rounds of bin placement; one row of ``coordinates`` minima per set (empty sets stay unfilled)."""
    rows = len(bounds) - 1
    out = np.full((rows, coordinates), _EMPTY)
    owner = np.repeat(np.arange(rows), np.diff(bounds))
    for turn in range(2 * coordinates):
        if not len(owner):
            break
        if turn < coordinates:
            r = mix(hashes + np.uint64((turn + 1) * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF))
            place = ((r & np.uint64(0xFFFFFFFF)) * np.uint64(coordinates) >> np.uint64(32)).astype(np.int64)
            value = (np.uint64(turn) << np.uint64(32)) | (r >> np.uint64(32))
        else:
            place = np.full(len(hashes), turn - coordinates)
            value = (np.uint64(turn) << np.uint64(32)) | (mix(hashes) >> np.uint64(32))
        np.minimum.at(out.reshape(-1), owner * coordinates + place, value)
        open_rows = (out == _EMPTY).any(axis=1)
        left = open_rows[owner]
        if not left.all():
            owner, hashes = owner[left], hashes[left]
    return out


def band_keys(sketches: np.ndarray) -> np.ndarray:
    bands = sketches.shape[1] // ROWS
    parts = sketches.reshape(len(sketches), bands, ROWS)
    key = (parts * _STEP[:ROWS]).sum(axis=2, dtype=np.uint64)
    return mix(key + np.arange(1, bands + 1, dtype=np.uint64) * _STEP[6]).view(np.int64)


_SKETCH = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()),
                     ("bands", pa.list_(pa.int64()))])


def _sketches(bands: int):
    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets):
                hashes, bounds = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ _STEP[j]), dtype=np.uint64)])
                        for j in (4, 5)]
                prints = [pa.array((s[bounds[1:]] - s[bounds[:-1]]).view(np.int64)) for s in sums]
                keys = band_keys(sketch(hashes, bounds, bands * ROWS))
                lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, bands, dtype=np.int32), keys.reshape(-1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(np.diff(bounds)), *prints,
                     lists], schema=_SKETCH)
    return sketches


def _check(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = text_bytes(batch.column(2)), text_bytes(batch.column(3))
            ok = np.zeros(len(batch), bool)
            for a, b in chunks(left[1] + right[1]):
                x, y = (shingle_sets(d[o[a]:o[b]], o[a:b + 1] - o[a]) for d, o in (left, right))
                for i in range(b - a):
                    p, q = x[0][x[1][i]:x[1][i + 1]], y[0][y[1][i]:y[1][i + 1]]
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    ok[a + i] = both > 0 and 100 * both >= percent * (len(p) + len(q) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=schema).filter(pa.array(ok))
    return links


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts reach the similarity on their full shingle sets."""
    rows = (pairs.join(texts.withColumnsRenamed({"doc_id": "a", "text": "text_a"}), "a")
            .join(texts.withColumnsRenamed({"doc_id": "b", "text": "text_b"}), "b"))
    return rows.select("a", "b", "text_a", "text_b").mapInArrow(_check(percent), "a long, b long")


def _block_links(percent: int):
    """Links of one pair of blocks that join members not yet connected: a spanning forest of them."""
    def links(table: pa.Table) -> pa.Table:
        ids, labels, block = (table.column(c).to_pylist() for c in ("rep", "label", "block"))
        data, offsets = text_bytes(table.column("text").combine_chunks())
        sets: list[np.ndarray] = []
        for a, b in chunks(offsets):
            hashes, bounds = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            sets += [hashes[x:y] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
        p, q = table.column("p")[0].as_py(), table.column("q")[0].as_py()
        left, right = ([i for i, x in enumerate(block) if x == side] for side in (p, q))
        sizes = np.array([len(sets[i]) for i in right])
        tokens, owner = np.concatenate([sets[i] for i in right] or [np.zeros(0, np.uint64)]), np.repeat(np.arange(len(right)), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        first: dict[int, int] = {}
        parent = [first.setdefault(label, i) for i, label in enumerate(labels)]

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        out = []
        for i in left:
            lo, hi = (np.searchsorted(tokens, sets[i], side) for side in ("left", "right"))
            n = hi - lo
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(right))
            for j in np.flatnonzero((both > 0) & (100 * both >= percent * (len(sets[i]) + sizes - both))):
                x, y = root(i), root(right[j])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    out.append({"a": ids[i], "b": ids[right[j]]})
        return pa.Table.from_pylist(out, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))
    return links


def _blocked(live: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links inside the groups of buckets that hang together, block against block."""
    nodes = stored(components(live.select(F.col("rep").alias("a"), F.col("key").alias("b"))), "bucket-groups")
    members = (live.groupBy("rep").agg(F.first("n").alias("n"), F.first("label").alias("label"))
               .join(nodes.select(F.col("node").alias("rep"), F.col("label").alias("group")), "rep"))
    size = members.groupBy("group").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    rows = (members.join(size, "group").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
            .join(texts.withColumnRenamed("doc_id", "rep"), "rep")
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("group", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
                    "block", "rep", "label", "text"))
    return rows.groupBy("group", "p", "q").applyInArrow(_block_links(percent), "a long, b long")


def text_key():
    """Tells rows with one doc_id and different texts apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, by_id: bool = True) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_shingles, class_id, component_id, kept, text_key, and kept_row: whether
    the row is its component's smallest (doc_id, text_key), or has no component."""
    texts = docs.select("doc_id", "text", text_key().alias("text_key"))
    sketches = stored(texts.mapInArrow(_sketches(bands_for(percent)), "doc_id long, text_key long, n_shingles long, fp1 long, "
                                       "fp2 long, bands array<long>"), "sketches")
    key = ["n_shingles", "fp1", "fp2"]
    known = sketches.where("n_shingles > 0 and doc_id is not null")
    # A class is named by its set, not by an id, as ids may repeat.
    classes = stored(known.groupBy(*key).agg(F.min(F.struct("doc_id", "text_key")).alias("one"), F.first("bands").alias("bands"))
                     .withColumn("rep", F.xxhash64(*key)), "classes")
    band = classes.select(F.explode("bands").alias("key"), "rep", F.col("n_shingles").alias("n"))
    shared = band.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    buckets = stored(band.join(shared.hint("merge"), "key").distinct(), "buckets")
    members = buckets.select("rep").distinct().join(classes.select("rep", "one.doc_id", "one.text_key"), "rep")
    texts = texts.join(members.hint("merge"), ["doc_id", "text_key"]).select(F.col("rep").alias("doc_id"), "text")
    texts = stored(texts.dropDuplicates(["doc_id"]), "candidate-texts")

    # Every member against its bucket's smallest one.
    pivots = buckets.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("p"))
    pairs = (buckets.join(pivots, "key").where("rep <> p.rep")
             .where(F.least("n", "p.n") * 100 >= F.greatest("n", "p.n") * percent)
             .select(F.least("rep", "p.rep").alias("a"), F.greatest("rep", "p.rep").alias("b")).distinct())
    links = stored(_verified(stored(pairs, "pairs"), texts, percent), "star-links")
    labels = stored(components(links), "star-labels").withColumnRenamed("node", "rep")

    # Buckets whose other members are not connected by that.
    live = (buckets.join(pivots.select("key", F.col("p.rep").alias("rep")), ["key", "rep"], "left_anti")
            .join(labels, "rep", "left").select("key", "rep", "n", F.coalesce("label", "rep").alias("label")))
    split = live.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key")
    live = stored(live.join(split, "key"), "live")
    more = []
    if not live.isEmpty():
        more.append(stored(_blocked(live, texts, percent), "block-links"))
    if by_id:
        nodes = known.select(F.col("doc_id").alias("id"), F.xxhash64(*key).alias("b"))
        several = nodes.groupBy("id").agg(F.min("b").alias("a"), F.max("b").alias("last")).where("a <> last").drop("last")
        same_id = stored(nodes.join(several, "id").where("a <> b").select("a", "b").distinct(), "repeated-ids")
        if not same_id.isEmpty():
            more.append(same_id)
    if more:
        for m in more:
            links = links.unionByName(m)
        labels = stored(components(links), "labels").withColumnRenamed("node", "rep")

    named = classes.drop("bands").join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    first = named.groupBy("label").agg(F.min("one").alias("first"))
    named = named.join(first, "label").select(*key, "one", "first")
    out = sketches.drop("bands").join(named, key, "left")
    has_id, alone = F.col("doc_id").isNotNull(), F.col("first").isNull()
    component = F.when(has_id, F.coalesce("first.doc_id", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", F.when(has_id, F.coalesce("one.doc_id", "doc_id")).alias("class_id"),
        component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "text_key",
        (~has_id | alone | (F.struct("doc_id", "text_key") == F.col("first"))).alias("kept_row"))


def op5_near_dup(spark, sf_dir: str) -> DataFrame:
    """Shingle-set size, component and keep decision of every document."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")
