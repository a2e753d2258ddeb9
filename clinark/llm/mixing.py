"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree (op 8).

Targets. Sources (by code point, NULL last) weigh 5, 2, 1, 5, 2, 1, ... and share the
mix's words; a target stops at three times its source's size and the excess is reshared
by weight until none is above. There is one row per source, and that list is what the
driver holds.

Blocks. A source's documents are dealt by hash into ``BLOCKS`` blocks, so a source with a
third of all rows is thousands of groups. A source whose target is e whole sizes and a
rest gives every block e times, and once more the blocks first in a hashed order until the
rest is reached; the block where it ends gives documents in hashed order, the last of them
in part, so that the source's taken words are its rounded target exactly.

Shards. The block draws of all sources are split among ``shards`` outputs by a binary
tree: at each node the left half gets a multivariate-hypergeometric draw of the node's
draws per source, the right half the rest, so the quotas are exact and distributed as a
uniform shuffle's would be. Each source's draws, in a hashed order, are then cut by the
quotas: shards hold disjoint draws. ``order_key`` sorts a shard locally. Everything is
hashed or seeded, so reruns agree.

Defined cases: NULL or wordless texts have size 0 and are taken 0 words; a source without
words has target 0; rows that repeat a doc_id count each; equal hashes fall back to id and
size; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinark.llm.common import read_table, stored
from clinark.session import run_dir

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCKS = 4096
SHARDS = 64
SEED = 8
#: Fixed value: words of the contract are runs of anything but blank and \x09-\x0D.
WORDS = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> dict:
    """Target words of each source of (source, size)."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size = dict(order)
    out, free, rest = {}, [s for s, _ in order], float(sum(size.values()))
    while free:
        total = sum(weight[s] for s in free)
        share = {s: rest * weight[s] / total for s in free}
        above = [s for s in free if share[s] > cap * size[s]]
        if not above:
            return out | share
        for s in above:
            out[s] = float(cap * size[s])
            rest -= out[s]
        free = [s for s in free if s not in out]
    return out


def split_quotas(draws: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """(shards, sources) block quotas: exact column sums, row sums as even as can be."""
    rng = np.random.default_rng(seed)
    out = np.zeros((shards, len(draws)), np.int64)

    def split(lo: int, hi: int, counts: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = counts
            return
        middle = (lo + hi) // 2
        take = int(counts.sum()) * (middle - lo) // (hi - lo)
        left = rng.multivariate_hypergeometric(counts, take, method="marginals") if take else np.zeros_like(counts)
        split(lo, middle, left)
        split(middle, hi, counts - left)

    split(0, shards, draws.astype(np.int64))
    return out


def mixture(docs: DataFrame, shards: int = SHARDS, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP,
            blocks: int = BLOCKS, seed: int = SEED) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, source) with size, source_size, target, taken and ``draws``:
    one (epoch, shard, words, order_key) for every time the mix takes the document."""
    spark = docs.sparkSession
    sized = stored(docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"))
        .withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "size"))
        .withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(blocks)).cast("int")), "sizes")
    block = stored(sized.groupBy("source", "block").agg(F.sum("size").alias("words")), "blocks")
    found = [(r["source"], r["n"], r["blocks"]) for r in
             block.groupBy("source").agg(F.sum("words").alias("n"), F.count(F.lit(1)).alias("blocks")).collect()]
    found.sort(key=lambda x: (x[0] is None, x[0] or ""))
    target = targets([(s, n) for s, n, _ in found], weights, cap)
    plan = []
    for s, n, _ in found:
        words = min(int(np.floor(target[s] + 0.5)), cap * n)
        plan.append((s, n, target[s], words // n if n else 0, words % n if n else 0))
    plan = spark.createDataFrame(plan, "p_source string, source_size long, target double, epochs long, rest long")
    same = F.col("source").eqNullSafe(F.col("p_source"))

    # Blocks of the last, partial epoch: whole ones in hashed order, then the one where the rest ends.
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 2), "block"), "block")
    cut = (block.join(plan, same).drop("p_source")
           .withColumn("before", F.sum("words").over(order) - F.col("words"))
           .withColumn("part", F.greatest(F.lit(0), F.least("words", F.col("rest") - F.col("before")))))
    cut = stored(cut.select("source", "block", "words", "source_size", "target", "epochs", "part"), "cut")

    # One draw per block and epoch; the tree's quotas cut each source's draws, in hashed order, into shards.
    n_draws = F.col("epochs") + (F.col("part") > 0).cast("long")
    draws = cut.where(n_draws > 0).select(
        "source", "block", F.explode(F.sequence(F.lit(0).cast("long"), n_draws - 1)).alias("epoch"))
    draws = draws.withColumn("order_key", F.xxhash64(F.lit(seed + 3), "source", "block", "epoch"))
    counts = {r["source"]: r["n"] for r in draws.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = [s for s, _, _ in found if s in counts]
    quotas = split_quotas(np.array([counts[s] for s in names], np.int64), shards, seed) if names else np.zeros((shards, 0))
    ends = [(s, [int(x) for x in np.cumsum(quotas[:, i])]) for i, s in enumerate(names)]
    ends = spark.createDataFrame(ends, "p_source string, ends array<long>")
    rank = F.row_number().over(Window.partitionBy("source").orderBy("order_key", "block", "epoch")) - 1
    placed = (draws.withColumn("rank", rank).join(ends, same)
              .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("rank"))))
              .groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct("epoch", "shard", "order_key"))).alias("at")))

    block_plan = cut.join(placed.withColumnsRenamed({"source": "p_source", "block": "p_block"}),
                          same & (F.col("block") == F.col("p_block")), "left").drop("p_source", "p_block")
    block_plan = stored(block_plan.withColumnsRenamed({"source": "p_source", "block": "p_block"}), "block-plan")

    # Inside the block where a source's rest ends, documents in hashed order; one table row per source.
    edge = block_plan.where("part > 0 and part < words").select("p_source", "p_block", "part")
    inner = Window.partitionBy("source", "block").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    at_edge = same & (F.col("block") == F.col("p_block"))
    edge_docs = (sized.join(edge, at_edge)
                 .withColumn("before", F.sum("size").over(inner) - F.col("size"))
                 .select(F.col("source"), "block", "doc_id", "key", "size",
                         F.greatest(F.lit(0), F.least("size", F.col("part") - F.col("before"))).alias("last")))
    other = sized.join(edge.drop("part"), at_edge, "left_anti").select(
        "source", "block", "doc_id", "key", "size", F.lit(None).cast("long").alias("last"))
    rows = edge_docs.unionByName(other).join(block_plan, at_edge, "left")
    last = F.coalesce("last", F.when(F.col("part") > 0, F.col("size")).otherwise(F.lit(0)))
    return rows.withColumn("draws", F.filter(F.transform(
        F.coalesce("at", F.array()), lambda d: F.struct(
            d["epoch"].alias("epoch"), d["shard"].alias("shard"),
            F.when(d["epoch"] < F.col("epochs"), F.col("size")).otherwise(last).alias("words"),
            F.xxhash64(d["order_key"], F.col("key")).alias("order_key"))), lambda d: d["words"] > 0)
    ).select("doc_id", "source", "size", "source_size", "target",
             F.aggregate("draws", F.lit(0).cast("long"), lambda n, d: n + d["words"]).alias("taken"), "draws")


def write_shards(mixed: DataFrame, path: str, *columns: str) -> None:
    """Write the draws of ``mixture`` rows: one folder per shard, its files in the order of the shuffled keys (a
    large shard is several ranges of them, so several tasks). Each draw has order_key, words and ``columns``."""
    rows = mixed.select(F.explode("draws").alias("draw"), *columns).select(
        F.col("draw.shard").alias("shard"), F.col("draw.order_key").alias("order_key"), F.col("draw.words").alias("words"),
        F.col("draw.epoch").alias("epoch"), *columns)
    rows = rows.repartitionByRange("shard", "order_key").sortWithinPartitions("shard", "order_key")
    rows.write.partitionBy("shard").parquet(path)


def shard_texts(docs: DataFrame, mixed: DataFrame, path: str) -> None:
    """Write the mix itself: the shards' draws with the texts."""
    one = docs.select("doc_id", "text").dropDuplicates(["doc_id"])
    write_shards(mixed.join(one, "doc_id"), path, "doc_id", "text")


def taken_from_shards(mixed: DataFrame) -> DataFrame:
    """Writes the shards' draws, reads them back, and gives every row of ``mixed`` the words that they take of it
    and the shards that hold it."""
    spark = mixed.sparkSession
    rows = stored(mixed.withColumn("row", F.monotonically_increasing_id()), "mixture")
    path = f"{run_dir(spark, 'shards')}/shards"
    write_shards(rows, path, "row")
    schema = "order_key long, words long, epoch long, row long, shard int"
    drawn = spark.read.schema(schema).parquet(path).groupBy(F.col("row").alias("drawn")).agg(
        F.sum("words").alias("taken"), F.sort_array(F.collect_list("shard")).alias("shards"))
    rows = rows.drop("taken", "draws").join(drawn, F.col("row") == F.col("drawn"), "left")
    return rows.withColumns({"taken": F.coalesce("taken", F.lit(0).cast("long")), "shards": F.coalesce(
        "shards", F.array().cast("array<int>"))}).drop("row", "drawn")


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    """Size, source size and target of every document, and the words that the written shards take of it."""
    return taken_from_shards(mixture(read_table(spark, sf_dir, "documents"))).drop("source")
