"""The clean tier as external Parquet tables in a catalog database, and SQL on them.

``register_clean`` puts written folders into the catalog; ``write_bucketed`` writes tables bucketed by
patient, whose joins and groupings by patient need no shuffle; ``analyze`` gives the planner their
sizes and column statistics.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from clinark.functions.exprs import PATIENT_BUCKET
from clinark.schemas import CLEAN, conform
from clinark.sources.parquet import CLUSTER_KEY, CLUSTERED_TABLES, COMPRESSION, lookup_options

CATALOG_TABLES = ("patients", "conditions", "encounters")
BUCKETS = 256
#: Columns the planner gets statistics of: join and group keys, and what rows are filtered by.
ANALYZED = {
    "patients": ("patient_id", "gender", "age_group", "state"),
    "conditions": ("patient_id", "icd_code", "clinical_status"),
    "encounters": ("patient_id", "start_date"),
}
DEFAULT_DB = "medical"
_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"bad identifier: {name!r}")
    return name


def _literal(text: str) -> str:
    """A SQL text literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_clean(spark: SparkSession, root: str, db: str = DEFAULT_DB,
                   tables: tuple[str, ...] = CATALOG_TABLES, replace: bool = False,
                   db_location: str | None = None, clustered: bool = False) -> list[str]:
    """Create ``db`` and one external Parquet table per clean table at ``<root>/<name>``.

    Columns are declared (all string) and resolved by name. Like the source DDL, an
    existing table is kept (``IF NOT EXISTS``) unless ``replace`` is set; dropping an
    external table removes only its catalog entry, never the files. ``clustered``
    registers tables written by ``sources.parquet.write_clustered``: the folder
    column is the partition column, the folders are recovered from storage, and a
    query that filters on it reads only the matching folders.
    """
    db = _ident(db)
    loc = f" LOCATION {_literal(db_location)}" if db_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")
    names = []
    for t in tables:
        t = _ident(t)
        fields = [f.name for f in CLEAN[t].fields]
        parted = clustered and t in CLUSTERED_TABLES
        if parted:
            fields.append(PATIENT_BUCKET)
        cols = ", ".join(f"{name} STRING" for name in fields)
        path = _literal(f"{root.rstrip('/')}/{t}")
        if replace:
            spark.sql(f"DROP TABLE IF EXISTS {db}.{t}")
        part = f" PARTITIONED BY ({PATIENT_BUCKET})" if parted else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{t} ({cols}) USING PARQUET{part} "
                  f"LOCATION {path}")
        if parted:
            spark.sql(f"ALTER TABLE {db}.{t} RECOVER PARTITIONS")
        names.append(f"{db}.{t}")
    return names


def write_bucketed(spark: SparkSession, tables: dict[str, DataFrame], root: str, db: str = DEFAULT_DB,
                   buckets: int = BUCKETS, db_location: str | None = None) -> list[str]:
    """Write clean tables at ``<root>/<name>`` as catalog tables of ``db`` bucketed by patient_id, replacing
    them; returns their names. Equal bucket numbers make joins and groupings by patient shuffle-free.

    The ``REBALANCE`` hint deals rows by patient and lets the adaptive planner split a bucket that is too
    big, so a hot patient or the NULL key is written by several tasks to several files of its bucket."""
    db = _ident(db)
    loc = f" LOCATION {_literal(db_location)}" if db_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")
    names = []
    for t, df in tables.items():
        name = f"{db}.{_ident(t)}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        dealt = conform(df, t).hint("rebalance", buckets, CLUSTER_KEY)
        (dealt.write.mode("overwrite").options(**COMPRESSION, **lookup_options(t)).bucketBy(buckets, CLUSTER_KEY).sortBy(CLUSTER_KEY)
         .option("path", f"{root.rstrip('/')}/{t}").format("parquet").saveAsTable(name))
        names.append(name)
    return names


def analyze(spark: SparkSession, names: list[str]) -> None:
    """Compute the size, row count and column statistics of catalog tables, for the planner: sizes decide on
    broadcasts; with ``spark.sql.cbo.enabled`` column statistics size what filters leave and order joins."""
    for name in names:
        columns = ", ".join(ANALYZED[name.split(".")[-1]])
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {columns}")


def catalog_sql(spark: SparkSession, text: str, args: dict | None = None) -> DataFrame:
    """Run SQL over the catalog tables with bound parameters (``:name`` markers), never
    by pasting values into the text. Result columns carry bare names."""
    return spark.sql(text, args=args or None)
