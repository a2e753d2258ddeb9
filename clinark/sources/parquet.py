"""Clean and gold tables as Parquet, plus U1 (row count observed during the write).

Clean tables that are looked up by patient (patients, conditions, encounters) can be
written *clustered*: folders by the first two characters of ``patient_id`` (256
folders for the SHA-256 hex keys), rows sorted by key inside every file. A lookup of
one patient then reads one folder, and in each file only the row groups whose
statistics contain the key — the Parquet counterpart of the row store's index.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clinark.functions.exprs import PATIENT_BUCKET as CLUSTER_COLUMN
from clinark.functions.exprs import packed_key, patient_bucket, patient_key, unpacked_key
from clinark.schemas import ALL_TABLES, LINE

CLUSTER_KEY = "patient_id"
# Sort columns after the key, per clustered table (a total order inside each file).
CLUSTERED_TABLES = {
    "patients": ("gender", "birth_year", "age_group", "state", "city"),
    "conditions": ("condition_id",),
    "encounters": ("encounter_id",),
}


# Columns that rows are looked up by, per clean table: their row groups get Bloom filters, so that a look-up of
# an id reads only row groups that hold it, wherever it lies between their smallest and largest id.
LOOKUP_COLUMNS = {
    "patients": ("patient_id",),
    "conditions": ("patient_id", "condition_id"),
    "encounters": ("patient_id", "encounter_id"),
    "medications": ("patient_id", "med_id"),
}


#: Fixed value: hashed keys have half a byte of content in every character, which zstd takes out and snappy leaves in.
COMPRESSION = {"compression": "zstd"}


def lookup_options(name: str) -> dict[str, str]:
    """Parquet write options of a table: a Bloom filter a row group for every look-up column, of the size that
    its distinct values need."""
    out = {f"parquet.bloom.filter.enabled#{c}": "true" for c in LOOKUP_COLUMNS.get(name, ())}
    return out | {"parquet.bloom.filter.adaptive.enabled": "true"} if out else out


def clean_schema(name: str, clustered: bool = False) -> StructType:
    """Declared schema of a table; clustered tables carry the folder column as a
    string, so folder values such as ``01`` are not read as numbers."""
    schema = ALL_TABLES[name]
    if clustered:
        schema = StructType(list(schema.fields) + [StructField(CLUSTER_COLUMN, StringType())])
    return schema


def read_clean(spark: SparkSession, root: str, name: str, clustered: bool = False) -> DataFrame:
    """A clean/gold table by name, read with its declared schema (no inference pass);
    filters and projections on it reach the Parquet scan. ``clustered`` reads a
    table written by ``write_clustered`` (adds the folder column)."""
    return spark.read.schema(clean_schema(name, clustered)).parquet(f"{root.rstrip('/')}/{name}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that this library wrote, on whichever file system holds it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_observed(df: DataFrame, write) -> int:
    """Run ``write(observed_df)`` and return the number of rows it wrote.

    The count is an observed metric of the write itself, so the plan is executed once
    (a ``count()`` afterwards would run it again).
    """
    obs = Observation()
    write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get.get("rows", 0))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None, options: dict[str, str] | None = None) -> int:
    """Write ``df`` as Parquet at ``path``; returns the rows written. Never point
    ``path`` at a directory the same plan reads."""
    def _w(d: DataFrame) -> None:
        w = d.write.mode(mode).options(**(COMPRESSION | (options or {})))
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    return write_observed(df, _w)


def _order(name: str, *lead: str) -> list[Column]:
    """The order of clean table ``name``: ``lead``, key, and what makes it total."""
    return [F.asc_nulls_first(c) for c in (*lead, CLUSTER_KEY, *CLUSTERED_TABLES[name])]


def _dealt(df: DataFrame, plain: bool = False) -> DataFrame:
    """Rows of a clean table dealt by folder. The key crosses the shuffle as bytes: a hash in hex takes half of them. A
    ``plain`` key crosses it as it is, which takes fewer, and is hashed on either side."""
    folder = patient_bucket(patient_key(CLUSTER_KEY) if plain else CLUSTER_KEY)
    dealt = (df.withColumn(CLUSTER_COLUMN, folder)
               .withColumn(CLUSTER_KEY, F.col(CLUSTER_KEY) if plain else packed_key(CLUSTER_KEY))
               .hint("rebalance", CLUSTER_COLUMN))
    return dealt.withColumn(CLUSTER_KEY, (patient_key if plain else unpacked_key)(CLUSTER_KEY))


def _laid_out(df: DataFrame, name: str) -> DataFrame:
    """Rows of clean table ``name`` dealt by folder and sorted by folder and key inside each task."""
    return _dealt(df).sortWithinPartitions(*_order(name, CLUSTER_COLUMN))


def write_clustered(df: DataFrame, path: str, name: str, mode: str = "overwrite") -> int:
    """Write clean table ``name`` clustered by patient (see the module text); returns
    the rows written.

    One shuffle, by the ``REBALANCE`` hint on the folder column: rows of a folder
    meet in the same tasks, and the adaptive planner splits a folder that is too
    big (one patient holding a third of the rows spreads over many tasks and files)
    and merges small ones. Unlike a range sort there is no sampling pass, so the
    input (e.g. the JSON parse of the raw tier) is evaluated once. The sort inside
    each task leads with the folder, which is the writer's required order, so no
    second sort is added.
    """
    return write_parquet(_laid_out(df, name), path, mode, partition_by=[CLUSTER_COLUMN], options=lookup_options(name))


def _move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename folder ``source`` to ``target``, replacing it; False if there is no such folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path(source)):
        return False
    fs.delete(path(target), True)
    fs.mkdirs(path(target).getParent())
    if not fs.rename(path(source), path(target)):
        raise OSError(f"could not move {source} to {target}")
    return True


def write_split(df: DataFrame, path: str, lines_path: str, name: str, clustered: bool = False,
                plain: bool = False) -> tuple[int, int]:
    """Write clean table ``name`` and its quarantine in one pass over ``df``, which has the table's columns and
    ``_line`` (NULL for a row, else a malformed line); returns (rows, lines), counted by the write.

    One job writes both kinds to folders of their own beside ``path``; the rows' folder then becomes ``path`` by a
    rename, and the (few) lines are written to ``lines_path`` as (line). With ``clustered`` the rows are laid out
    as by ``write_clustered``; with ``plain`` too, their ``patient_id`` comes as the plain id and is written hashed."""
    if plain and not clustered:
        raise ValueError("plain ids are hashed where rows are clustered")
    spark = df.sparkSession
    schema = ALL_TABLES[name]
    carrier = schema[0].name                 # in the folder of lines this column holds the line
    is_row = F.col(LINE).isNull()
    out = df.select("*", F.when(is_row, "rows").otherwise("lines").alias("_kind"))
    folders = ["_kind"]
    if clustered:
        out = _dealt(out, plain).sortWithinPartitions(*_order(name))
        folders.append(CLUSTER_COLUMN)
    counts = Observation()
    out = out.observe(counts, F.count_if(is_row).alias("rows"), F.count(LINE).alias("lines"))
    if clustered:
        # The folders that lead the writer's order are alike in most rows of a task, and a sort that cannot tell rows by
        # the first bytes of its first column looks up every row it compares. By key it can; rows that come in that order
        # are compared once. (Without the counts between them the optimizer would drop the first sort.)
        out = out.sortWithinPartitions(*_order(name, *folders))
    out = out.select(F.when(is_row, F.col(carrier)).otherwise(F.col(LINE)).alias(carrier),
                     *(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields[1:]), *folders)
    staging = f"{path.rstrip('/')}-{uuid.uuid4().hex[:12]}"
    out.write.partitionBy(*folders).options(**COMPRESSION, **lookup_options(name)).parquet(staging)
    found = counts.get
    if found["lines"]:
        lines = spark.read.schema(schema).parquet(f"{staging}/_kind=lines").select(F.col(carrier).alias("line"))
    else:
        lines = spark.createDataFrame([], "line string")
    lines.write.mode("overwrite").parquet(lines_path)
    if not found["rows"]:
        spark.createDataFrame([], clean_schema(name, clustered)).write.mode("overwrite").parquet(path)
    else:
        _move(spark, f"{staging}/_kind=rows", path)
    remove(spark, staging)
    return int(found["rows"]), int(found["lines"])
