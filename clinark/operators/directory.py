"""The page directory of the clustered patients — how many ids lie before each slice of keys.

One row per first ``DIRECTORY_CHARS`` characters of the patient key (65,536 slices of the hashed keys,
and NULL), with its folder, its smallest id, its distinct ids and how many ids sort before it. It is
written with the tier and replaced with it, so a page is found by a look into a small table, and the
page itself reads only the folders and row groups of its slices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinark.functions import exprs as X
from clinark.sources.parquet import write_parquet

DIRECTORY = "patients_directory"
DIRECTORY_CHARS = 4
SCHEMA = f"{X.PATIENT_BUCKET} string, prefix string, first_id string, ids bigint, start bigint"


def patient_directory(patients: DataFrame) -> DataFrame:
    """The directory of a patients table (see the module text)."""
    key = F.col("patient_id")
    ids = patients.select(X.patient_bucket(key).alias(X.PATIENT_BUCKET),
                          F.substring(key, 1, DIRECTORY_CHARS).alias("prefix"), key.alias("id")).distinct()
    slices = ids.groupBy(X.PATIENT_BUCKET, "prefix").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("ids"))
    # A window over the slices alone, in the order of the pages.
    before = F.sum("ids").over(Window.orderBy(F.asc_nulls_last("prefix"))) - F.col("ids")
    return slices.withColumn("start", before)


def write_directory(patients: DataFrame, clean_root: str) -> int:
    """Write the directory beside the clustered table; returns its rows."""
    return write_parquet(patient_directory(patients).coalesce(1), f"{clean_root.rstrip('/')}/{DIRECTORY}")


def read_directory(spark: SparkSession, clean_root: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(f"{clean_root.rstrip('/')}/{DIRECTORY}")


def _after(prefix: str) -> str | None:
    """The smallest text above every text that begins with ``prefix``; None if there is none."""
    for i in range(len(prefix) - 1, -1, -1):
        if prefix[i] != "\U0010ffff":
            following = ord(prefix[i]) + 1
            return prefix[:i] + chr(0xE000 if following == 0xD800 else following)
    return None


def page_slice(patients: DataFrame, directory: DataFrame, offset: int, limit: int) -> tuple[DataFrame, int]:
    """(rows, skip): the rows of the slices that hold the ids from ``offset`` to ``offset + limit``, and how many
    of their ids come before the page. At most ``limit`` slices, as each holds an id."""
    held = directory.where((F.col("start") < offset + limit) & (F.col("start") + F.col("ids") > offset))
    slices = held.orderBy("start").limit(limit).collect()
    if not slices:
        return patients.limit(0), 0
    key, wanted = F.col("patient_id"), F.lit(False)
    known = [s for s in slices if s["first_id"] is not None]
    if known:
        wanted = key >= F.lit(known[0]["first_id"])
        above = _after(known[-1]["prefix"]) if known[-1]["prefix"] else "\x00"
        if above is not None:
            wanted &= key < F.lit(above)
        if X.PATIENT_BUCKET in patients.columns:
            wanted &= F.col(X.PATIENT_BUCKET).isin(sorted({s[X.PATIENT_BUCKET] for s in known}))
    if len(known) < len(slices):
        wanted |= key.isNull()
    return patients.where(wanted), offset - slices[0]["start"]
