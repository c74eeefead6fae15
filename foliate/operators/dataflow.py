"""Corpus dataflow: logs in which the last record counts, work left to do, order, stripes, rollups and bags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliate.functions import text as fn
from foliate.session import written


def last_wins(log: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last record of each key by the order columns (make them unique). One aggregation that combines before the shuffle: a hot key costs a row a task."""
    rest = [c for c in log.columns if c != key]
    best = log.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return best.select(key, *[F.col(f"r.`{c}`").alias(c) for c in rest]).select(*log.columns)


def todo(plan: DataFrame, done: DataFrame, key: str, blacklist: DataFrame | None = None) -> DataFrame:
    """Rows of the plan whose key is neither done nor given up."""
    left = plan.join(done.select(key).distinct(), key, "left_anti")
    return left if blacklist is None else left.join(blacklist.select(key).distinct(), key, "left_anti")


def biggest_first(df: DataFrame, size: str, key: str) -> DataFrame:
    """Largest first, unknown sizes as 0, ties by key: a range partitioning, no single task sorts all."""
    return df.orderBy(F.coalesce(F.col(size), F.lit(0)).desc(), F.col(key))


def ranked(df: DataFrame, order: list[Column]) -> DataFrame:
    """With the 0-based place `n` of each row in a total order, in parallel.

    A range partitioning by the order's sort key lets each partition number its own rows; the counts of the partitions
    before (one small row each) are added. No task sees all rows. The sorted rows are written once, so that both sides
    see the same partitions.
    """
    rows = written(df.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id()), "ranked")
    counts = rows.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_id").alias("_base"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a partition
    offsets = counts.select("_part", (before - F.col("_base")).alias("_shift"))
    return rows.join(F.broadcast(offsets), "_part").withColumn("n", F.col("_id") + F.col("_shift")).drop("_part", "_id", "_shift")


def route_rollup(names: DataFrame, name: str, accept: str | None = None) -> DataFrame:
    """(lane, verdict, n, first_name): what the lanes get, what no lane takes, what the accept list leaves out."""
    c = names.select(F.col(name).alias("name"), fn.classify(name, accept).alias("c"))
    verdict = F.when(F.col("c.accepted"), "accepted").when(F.col("c.lane") == fn.UNSUPPORTED, "unsupported").otherwise("declined")
    return c.groupBy(F.col("c.lane").alias("lane"), verdict.alias("verdict")).agg(F.count("*").alias("n"), F.min("name").alias("first_name"))


def extension_counts(names: DataFrame, name: str) -> DataFrame:
    ext = fn.extension(name)
    return names.groupBy(F.when(ext == "", "no-ext").otherwise(ext).alias("ext")).agg(F.count("*").alias("n"))


def lane_summary(log: DataFrame) -> DataFrame:
    """By extension: documents, valid ones, lowest recall, warnings; the total is the row with a null extension."""
    return log.rollup("ext").agg(F.count("*").alias("n"), F.count_if("valid").alias("valid"), F.min("recall").alias("min_recall"), F.sum("structure_warnings").alias("warnings"))


def bag_difference(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    """(by, n): occurrences of a beyond those of b."""
    both = a.groupBy(*by).agg(F.count("*").alias("n")).select(*by, F.col("n"), F.lit(1).alias("s")).unionByName(b.groupBy(*by).agg(F.count("*").alias("n")).select(*by, F.col("n"), F.lit(-1).alias("s")))
    return both.groupBy(*by).agg(F.sum(F.col("n") * F.col("s")).alias("n")).where("n > 0")


def select_source(native: DataFrame, markdown: DataFrame, key: str, backend: str = "native", least: int = 20) -> DataFrame:
    """(key, text, origin): the Markdown where it is preferred and long enough, else the native text."""
    rows = native.select(key, F.col("text").alias("native")).join(markdown.select(key, F.col("text").alias("md")), key, "left")
    use = F.lit(backend == "docling") & (F.length(fn.strip(F.coalesce("md", F.lit("")))) >= least)
    return rows.select(key, F.when(use, F.col("md")).otherwise(F.coalesce("native", F.lit(""))).alias("text"), F.when(use, "markdown").otherwise("native").alias("origin"))


def same_content(a: DataFrame, b: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, verdict): whether two runs gave the same content: same, changed, first-only or second-only."""
    rows = a.select(key, F.col(digest).alias("x")).join(b.select(key, F.col(digest).alias("y"), F.lit(True).alias("there")), key, "full").withColumn("there", F.coalesce("there", F.lit(False)))
    verdict = F.when(~F.col("there"), "first-only").when(F.col("x").isNull(), "second-only").when(F.col("x") == F.col("y"), "same").otherwise("changed")
    return rows.select(key, verdict.alias("verdict"))


def progress(plan: DataFrame, done: DataFrame, given_up: DataFrame, key: str, by: str) -> DataFrame:
    """(by, planned, done, given_up, left): how far a run has come, without running anything."""
    rows = plan.select(key, by).distinct().join(done.select(key, F.lit(1).alias("d")).distinct(), key, "left").join(given_up.select(key, F.lit(1).alias("g")).distinct(), key, "left")
    is_done, is_gone = F.col("d").isNotNull(), F.col("d").isNull() & F.col("g").isNotNull()
    return rows.groupBy(by).agg(F.count("*").alias("planned"), F.count_if(is_done).alias("done"), F.count_if(is_gone).alias("given_up"), F.count_if(~is_done & ~is_gone).alias("left"))
