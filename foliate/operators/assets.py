"""Pictures of bundles: which are stored and linked, what is left over, and the section that lists captioned ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.functions import text as fn

SECTION = "## Figures (captioned images)"


def references(docs: DataFrame, key: str = "doc_id", md: str = "markdown") -> DataFrame:
    """(doc_id, part, n): how often each picture mark stands in a document."""
    return docs.select(F.col(key).alias("doc_id"), F.explode(fn.sentinels(md, "ooxml-image")).alias("part")).groupBy("doc_id", "part").agg(F.count("*").alias("n"))


def plan(docs: DataFrame, media: DataFrame, folder: str = "images", key: str = "doc_id", md: str = "markdown") -> DataFrame:
    """(doc_id, part, n, file, link): each marked picture with the file that holds its bytes; equal bytes share one; without bytes there is no link.

    media(doc_id, part, bytes). Only hashes are joined and kept, not the bytes.
    """
    ext = F.coalesce(F.nullif(F.lower(F.regexp_extract("part", r"\.([A-Za-z0-9]+)$", 1)), F.lit("")), F.lit("bin"))
    stored = media.where(F.length("bytes") > 0).select("doc_id", "part", F.concat(F.substring(F.sha2("bytes", 256), 1, 16), F.lit("."), ext).alias("file")).dropDuplicates(["doc_id", "part"])
    rows = references(docs, key, md).join(stored, ["doc_id", "part"], "left")
    return rows.withColumn("link", F.when(F.col("file").isNotNull(), F.concat(F.lit(f"![]({folder}/"), F.col("file"), F.lit(")"))))


def plan_summary(planned: DataFrame) -> DataFrame:
    """(doc_id, n_referenced, n_resolved, n_files, n_missing)"""
    found = F.col("file").isNotNull()
    got = planned.groupBy("doc_id").agg(F.sum("n").alias("n_referenced"), F.sum(F.when(found, F.col("n")).otherwise(0)).alias("n_resolved"), F.countDistinct("file").alias("n_files"))
    return got.withColumn("n_missing", F.col("n_referenced") - F.col("n_resolved"))


def filled(docs: DataFrame, planned: DataFrame, key: str = "doc_id", md: str = "markdown") -> DataFrame:
    """The documents with links in place of the marks; marks without bytes are dropped."""
    maps = planned.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("part", "link"))).alias("fills"))
    rows = docs.join(maps.withColumnRenamed("doc_id", key), key, "left")
    body = F.when(F.col("fills").isNull(), F.col(md)).otherwise(fn.fill_sentinels(md, "fills", "ooxml-image"))
    return rows.withColumn(md, body).drop("fills")


def orphans(files: DataFrame, planned: DataFrame) -> DataFrame:
    """Stored files (doc_id, file) named by a hash that no document refers to."""
    own = files.where(F.col("file").rlike(r"^[0-9a-f]{16}\.[A-Za-z0-9]+$"))
    return own.join(planned.where("file is not null").select("doc_id", "file"), ["doc_id", "file"], "left_anti")


def with_figures_section(docs: DataFrame, figures: DataFrame, key: str = "doc_id", md: str = "markdown") -> DataFrame:
    """The documents with the section of their captioned figures, made anew. figures(doc_id, seq, caption, path)."""
    lines = figures.withColumn("line", fn.image_link("caption", F.col("path"))).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", "line"))).alias("f"))
    rows = docs.join(lines.withColumnRenamed("doc_id", key), key, "left")
    bare = F.regexp_replace(F.col(md), rf"(?s)\n*\Q{SECTION}\E\n.*$", "\n")
    listed = F.concat(F.regexp_replace(bare, r"\n+$", ""), F.lit(f"\n\n{SECTION}\n\n"), F.array_join(F.transform("f", lambda x: x["line"]), "\n\n"), F.lit("\n"))
    return rows.withColumn(md, F.when(F.col("f").isNotNull(), listed).otherwise(bare)).drop("f")
