"""Documents as they arrive: a file stream whose batches become bundles, and windowed monitors of record streams.

The checkpoint delivers each file once; the sink writes by document id, so a batch that is repeated after a failure
replaces what it left. A run with ``available_now`` takes up what came since the last one and ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foliate.functions import text as fn
from foliate.operators import bundle

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def arriving(spark: SparkSession, root: str, accept: str | None = None) -> DataFrame:
    """A stream of scanned files."""
    stream = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true").load(root)
    base = "/" + root.split("://", 1)[-1].strip("/")
    rel = F.substr(F.regexp_replace(F.regexp_replace("path", "^[a-z0-9]+:/+", "/"), "^/+", "/"), F.lit(len(base) + 2))
    rows = stream.select(rel.alias("rel"), F.col("length").alias("size"), "content").withColumn("c", fn.classify("rel", accept))
    return rows.select("rel", fn.document_id("rel").alias("doc_id"), "c.*", "size", "content")


def stream_bundles(spark: SparkSession, root: str, out: str, checkpoint: str, accept: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Starts the stream from files to bundles; the manifest grows by a folder per batch."""

    def batch(df: DataFrame, number: int) -> None:
        rows = bundle.write_bundles(bundle.convert(df.where("accepted")), out, f"batch-{number}")
        rows.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out.rstrip('/')}/manifest/batch={number}")

    writer = arriving(spark, root, accept).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()


def tumbling(records: DataFrame, time: str, by: str, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums per window and key; works on streams (with a watermark) and on tables alike."""
    rows = records.withWatermark(time, late) if records.isStreaming else records
    got = rows.groupBy(F.window(time, length), by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return got.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), by, "n", "total")


def sliding(records: DataFrame, time: str, by: str, length: str = "1 hour", step: str = "15 minutes", late: str = "10 minutes") -> DataFrame:
    rows = records.withWatermark(time, late) if records.isStreaming else records
    got = rows.groupBy(F.window(time, length, step), by).agg(F.count("*").alias("n"))
    return got.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), by, "n")


def sessions(records: DataFrame, time: str, by: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of a key, parted by gaps of at least that long."""
    rows = records.withWatermark(time, late) if records.isStreaming else records
    got = rows.groupBy(F.session_window(time, gap), by).agg(F.count("*").alias("n"))
    return got.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), by, "n")


def latest_states(records: DataFrame, key: str, order: list[str], late_column: str | None = None, late: str = "1 day") -> DataFrame:
    """The last record per key of a stream or table: an aggregation, for output mode `update` or `complete`."""
    rest = [c for c in records.columns if c != key]
    rows = records.withWatermark(late_column, late) if late_column and records.isStreaming else records
    best = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return best.select(key, *[F.col(f"r.`{c}`").alias(c) for c in rest])
