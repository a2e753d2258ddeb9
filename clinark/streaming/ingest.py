"""Routing ingest — pick up files, split to lines, route by resource type, land per type.

A Structured Streaming query: the text file source splits files into lines, the
route is ``get_json_object(value, '$.resourceType')`` (unknown or unparsable lines
go to ``_unmatched``), and the file sink lands the lines as text partitioned by
``resource_type``, compressed and at most ``LINES_PER_FILE`` lines a file. The checkpoint makes it exactly-once: a replay on the same
checkpoint adds nothing, and readers that go through the sink's metadata log see
only committed files.

Every micro-batch observes how many lines it routes to each type, so a run's counts come from
the reports of its own batches: the routed root is not read for them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clinark.schemas import RESOURCE_TYPES, UNMATCHED
from clinark.sources.raw import LEVEL, PARTITION_COLUMN, TEXT_OPTIONS, with_options


def route(lines: DataFrame, types: tuple[str, ...] = RESOURCE_TYPES) -> DataFrame:
    """(value, resource_type) for each line; works on batch and streaming frames."""
    t = F.get_json_object(F.col("value"), "$.resourceType")
    # Looked up, as a comparison and its result would each parse the line.
    known = F.create_map(*(F.lit(x) for x in types for _ in range(2)))
    return lines.select("value", F.coalesce(F.try_element_at(known, t), F.lit(UNMATCHED)).alias(PARTITION_COLUMN))


# Bytes a micro-batch takes at most, so that a large landing is many batches.
MAX_BYTES_PER_TRIGGER = 256 << 30
# Name of the observed counts, their columns, and how often a run looks at its reports.
OBSERVED = "routed"
ROUTES = (*RESOURCE_TYPES, UNMATCHED)
POLL_SECONDS = 0.2
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def start_ingest(spark: SparkSession, landing: str, routed_root: str, checkpoint: str,
                 available_now: bool = True, processing_time: str | None = None,
                 max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: int | None = MAX_BYTES_PER_TRIGGER,
                 archive_dir: str | None = None) -> StreamingQuery:
    """Start the routing stream. ``available_now`` processes what is there (in
    batches of at most ``max_files_per_trigger`` files, or if that is unset
    ``max_bytes_per_trigger``) and stops; otherwise it runs every ``processing_time``.

    ``archive_dir`` makes the pick-up consume its input: Spark moves the files of a
    committed batch there (keeping their full path below it) when a later batch runs,
    so the landing folder keeps only the last batch and work still to do. Moving is
    best effort and never fails the stream; the checkpoint alone decides what has been
    routed, so a file is never routed twice.

    The query runs in a session of its own (the options of ``spark``, and one), whose ``streams`` list it.
    """
    # A file stays open for every route, so no task sorts (and past its memory spills) its lines by route.
    session = with_options(spark, {OPEN_FILES: str(max(int(spark.conf.get(OPEN_FILES)), len(ROUTES)))})
    session.conf.set(LEVEL, TEXT_OPTIONS[LEVEL])      # the file sink takes a codec's settings from the session alone
    reader = session.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    elif max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    if archive_dir:
        reader = (reader.option("cleanSource", "archive")
                        .option("sourceArchiveDir", archive_dir))
    routed = route(reader.load(landing))
    routed = routed.observe(OBSERVED, *(F.count_if(F.col(PARTITION_COLUMN) == t).alias(t) for t in ROUTES))
    writer = (routed.writeStream.format("text")
                    .partitionBy(PARTITION_COLUMN)
                    .options(**TEXT_OPTIONS)
                    .option("checkpointLocation", checkpoint)
                    .outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(routed_root)


def ingest_counts(spark: SparkSession, landing: str, routed_root: str, checkpoint: str,
                  poll_seconds: float = POLL_SECONDS, **kw) -> dict[str, int]:
    """Run the stream until the landed files are processed; returns the lines it routed, per type.

    The reports of the run's batches are gathered while it runs (Spark keeps the latest 100). Should
    a batch commit without its report being seen, the files that the sink log lists for that
    batch, and no others, are counted.
    """
    first = _next_batch(spark, checkpoint)
    q = start_ingest(spark, landing, routed_root, checkpoint, available_now=True, **kw)
    seen: dict[int, dict[str, int]] = {}
    stopped = False
    while not stopped:
        stopped = q.awaitTermination(poll_seconds)
        for p in q.recentProgress:
            if OBSERVED in p.observedMetrics:
                seen[p.batchId] = p.observedMetrics[OBSERVED].asDict()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    for batch in range(first, _next_batch(spark, checkpoint)):
        if batch not in seen:
            seen[batch] = _batch_counts(spark, routed_root, batch)
    return {t: sum(counts.get(t) or 0 for counts in seen.values()) for t in ROUTES}


def run_ingest(spark: SparkSession, landing: str, routed_root: str, checkpoint: str, **kw) -> int:
    """Run the stream until the landed files are processed; returns the lines routed."""
    return sum(ingest_counts(spark, landing, routed_root, checkpoint, **kw).values())


def _listing(spark: SparkSession, folder: str) -> set[str]:
    """Names of the files in a folder (none if it does not exist)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in fs.listStatus(path)} if fs.exists(path) else set()


def _next_batch(spark: SparkSession, checkpoint: str) -> int:
    """The number after the last committed micro-batch of a checkpoint."""
    return 1 + max((int(n) for n in _listing(spark, f"{checkpoint}/commits") if n.isdigit()), default=-1)


def _batch_counts(spark: SparkSession, routed_root: str, batch: int) -> dict[str, int]:
    """Lines per type in the files that the sink log lists for one batch."""
    log = f"{routed_root}/_spark_metadata"
    names = _listing(spark, log)

    def listed(name: str) -> set[str]:
        # Spark reads nothing below a sink log, and reads the lists themselves in the driver, as here.
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{log}/{name}")
        file = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
        finally:
            file.close()
        return {json.loads(line)["path"] for line in text.split("\n")[1:] if line}     # the first line is the version

    if str(batch) in names:
        paths = listed(str(batch))
    elif f"{batch}.compact" in names:
        # A compacted list holds all earlier files as well: those of the lists since the one before go.
        paths, earlier = listed(f"{batch}.compact"), batch - 1
        while earlier >= 0 and f"{earlier}.compact" not in names:
            paths -= listed(str(earlier))
            earlier -= 1
        if earlier >= 0:
            paths -= listed(f"{earlier}.compact")
    else:
        return {}                                         # the batch routed nothing
    if not paths:
        return {}
    lines = spark.read.option("basePath", routed_root).schema(f"value string, {PARTITION_COLUMN} string").text(sorted(paths))
    return {r[0]: r[1] for r in lines.groupBy(PARTITION_COLUMN).count().collect()}


def routed_counts(spark: SparkSession, routed_root: str) -> DataFrame:
    """Lines per resource type in the routed root, read through the sink log."""
    return (spark.read.format("text").load(routed_root)
                 .groupBy(PARTITION_COLUMN).agg(F.count(F.lit(1)).alias("lines")))
