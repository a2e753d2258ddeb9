"""Raw FHIR NDJSON scans with declared schemas.

Two layouts are accepted:

* ``routed`` — the root written by the routing ingest (``streaming.ingest``), one
  ``resource_type=<Type>`` partition per resource. The scan reads the root through
  the sink's metadata log (only committed files) and prunes to one partition.
* ``directory`` — one plain directory per resource type, ``<root>/<Type>/``.

A line is parsed once, to its row and its verdict: ``read_lines`` gives both, so that one
write can send rows to a table and lines that are no JSON object to its quarantine
(``sources.parquet.write_split``). ``read_raw`` gives the rows, ``malformed_lines`` the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clinark.schemas import CORRUPT, LINE, RAW, UNMATCHED

PARTITION_COLUMN = "resource_type"
#: How lines are written: NDJSON repeats its keys in every line and shrinks to a small part. A gzip file is read by
#: one task, so no file holds more lines than one task reads in seconds.
LINES_PER_FILE = 500_000
#: At level 6 writing takes two and a half times the CPU of level 3, for a fifth fewer bytes.
LEVEL = "zlib.compress.level"
TEXT_OPTIONS = {"compression": "gzip", "maxRecordsPerFile": str(LINES_PER_FILE), LEVEL: "THREE"}
#: Shuffle files go when their query ends, not when the driver happens to collect its garbage.
SHORT_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: A task over compressed lines reads this part of the bytes a task otherwise reads, as they expand on reading (about
#: fifteenfold for FHIR lines): what it sorts or groups stays in memory.
COMPRESSED_SHARE = 8
COMPRESSED_SUFFIXES = (".gz", ".deflate", ".zst", ".lz4", ".snappy")


def with_options(spark: SparkSession, options: dict[str, str]) -> SparkSession:
    """A session of the same application with the options of ``spark`` and those given; ``spark`` keeps its own."""
    session = spark.newSession()
    for key, value in (spark.conf.getAll | options).items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            session.conf.set(key, value)
    return session


def line_session(spark: SparkSession, root: str, resource: str, layout: str = "routed") -> SparkSession:
    """The session to read one type's lines with: its tasks take less of compressed files (see ``COMPRESSED_SHARE``)."""
    files = _lines(spark, root, resource, layout).inputFiles()
    if not any(f.endswith(COMPRESSED_SUFFIXES) for f in files):
        return spark
    key = "spark.sql.files.maxPartitionBytes"
    size = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return with_options(spark, {key: str(max(size // COMPRESSED_SHARE, 1))})


def _lines(spark: SparkSession, root: str, resource: str, layout: str) -> DataFrame:
    """(value): the non-blank text lines of one resource type."""
    if layout not in ("routed", "directory"):
        raise ValueError("layout must be 'routed' or 'directory'")
    reader = spark.read.format("text")
    if layout == "routed":
        lines = (reader.schema(StructType([StructField("value", StringType()),
                                           StructField(PARTITION_COLUMN, StringType())])).load(root)
                       .where(F.col(PARTITION_COLUMN) == F.lit(resource)))
    else:
        lines = reader.load(f"{root.rstrip('/')}/{resource}")
    return lines.select("value").where(F.trim("value") != "")


#: Fixed value: the white space of JSON.
_JSON_BLANKS = " \t\r\n"


def _is_object(parsed: Column) -> Column:
    """Whether the line is a JSON object. The parser marks every line with something it could not take; only
    for those the line is looked at again, as an object with a mistyped field is still a row."""
    begins = F.ltrim("value", F.lit(_JSON_BLANKS)).startswith("{")
    return begins & (parsed[CORRUPT].isNull() | F.json_object_keys("value").isNotNull())


def read_lines(spark: SparkSession, root: str, resource: str, layout: str = "routed") -> DataFrame:
    """Every non-blank line of one type, parsed once: the declared raw columns, and in ``_line`` the text of a
    line that is no JSON object (NULL for a row; the other columns are then NULL)."""
    schema = StructType([*RAW[resource].fields, StructField(CORRUPT, StringType())])
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # A generator, as the optimizer would otherwise copy the parse into every filter pushed below it.
    lines = _lines(spark, root, resource, layout).select("value", F.explode(F.array(parsed)).alias("r"))
    lines = lines.select("r", F.when(~_is_object(F.col("r")), F.col("value")).alias(LINE))
    return lines.select(*(F.when(F.col(LINE).isNull(), F.col("r")[f.name]).alias(f.name) for f in RAW[resource]), LINE)


def malformed_lines(spark: SparkSession, root: str, resource: str, layout: str = "routed") -> DataFrame:
    """(line): the lines that are no JSON object, for a quarantine table."""
    return read_lines(spark, root, resource, layout).where(F.col(LINE).isNotNull()).select(F.col(LINE).alias("line"))


def read_raw(spark: SparkSession, root: str, resource: str, layout: str = "routed",
             corrupt: Observation | None = None) -> DataFrame:
    """Resources of one type as a nested DataFrame with the declared raw schema.

    A row per JSON object, whichever columns are read: a field of another type than
    declared is NULL and the row stays; only lines that are no JSON object are left out
    (``malformed_lines`` gives them). ``corrupt``, if given, receives
    ``{"corrupt_lines": n}`` after the first action; it is observed at the scan, so a
    re-run map stage can count twice. The job counts in its write instead.
    """
    lines = read_lines(spark, root, resource, layout)
    if corrupt is not None:
        lines = lines.observe(corrupt, F.count(LINE).alias("corrupt_lines"))
    return lines.where(F.col(LINE).isNull()).drop(LINE)


def unmatched_lines(spark: SparkSession, root: str) -> int:
    """Lines in the ingest's dead-letter partition of a routed root (read through the
    sink log; the partition filter prunes the scan to that partition)."""
    lines = (spark.read.schema(StructType([StructField("value", StringType()),
                                           StructField(PARTITION_COLUMN, StringType())]))
                  .format("text").load(root))
    return lines.where(F.col(PARTITION_COLUMN) == F.lit(UNMATCHED)).count()
