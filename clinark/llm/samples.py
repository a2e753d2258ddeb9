"""Bounded, hash-drawn training samples, the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Rows kept of a stratum: Spark pushes a rank limit below the shuffle up to 1,000.
STRATUM = 500


def stratified(rows: DataFrame, by: str, id_col: str, per_class: int) -> DataFrame:
    """At most ``per_class`` rows of each class: those first in hashed id order in each of
    the class's hashed strata.

    The limit of a stratum is pushed below the shuffle (a task sends on that many of its
    rows), so a class with most of the rows costs no more than another.
    """
    strata = -(-per_class // STRATUM)
    order = Window.partitionBy(by, "_stratum").orderBy(F.xxhash64(id_col), id_col)
    return (rows.withColumn("_stratum", F.pmod(F.xxhash64(F.lit(1), id_col), F.lit(strata)))
            .withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= per_class // strata)
            .drop("_place", "_stratum"))


def labelled(docs: DataFrame, labels: DataFrame, column: str, learn, per_class: int) -> tuple[DataFrame, list[float]]:
    """(doc_id, text, y) of a stratified sample of the learning rows, and the classes' true shares.
    A document with several labels has the largest.
    The drawn ids are broadcast: 2 * ``per_class`` rows at most, so no text is shuffled."""
    one = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("y"))
           .where("y in (0, 1) and doc_id is not null").where(learn).groupBy("doc_id").agg(F.max("y").alias("y")))
    count = {r["y"]: r["n"] for r in one.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(count.values())
    drawn = stratified(one, "y", "doc_id", per_class)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(drawn), "doc_id"),
            [(count.get(y, 0) + 0.5) / (total + 1) for y in (0, 1)])
