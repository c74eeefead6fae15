"""Files as rows: scans of document trees, text with repair of bad bytes, append logs, bundles."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliate.functions import text as fn


def scan_tree(spark: SparkSession, root: str, accept: str | None = None, lanes: tuple[str, ...] = ()) -> DataFrame:
    """(rel, doc_id, ext, lane, accepted, reason, modified, size, content) of the files below root, of some lanes or all.

    The relative path is the raw one, so that its hash is the document's id. Content is read only where a query uses it.
    """
    base = root.rstrip("/")
    at = F.regexp_replace(F.regexp_replace("path", "^[a-z0-9]+:/+", "/"), "^/+", "/")
    rel = F.substr(at, F.lit(len("/" + base.split("://", 1)[-1].lstrip("/")) + 2))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    rows = files.select(rel.alias("rel"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"), "content")
    rows = rows.withColumn("c", fn.classify("rel", accept)).select("rel", fn.document_id("rel").alias("doc_id"), "c.*", "modified", "size", "content")
    return rows.where(F.col("lane").isin(*lanes)) if lanes else rows


@F.pandas_udf(T.StringType())
def decode_text(content: pd.Series) -> pd.Series:
    """UTF-8 with a replacement character for every damaged byte; nothing for a missing file."""
    return content.map(lambda c: bytes(c).decode("utf-8", "replace") if c is not None else "")


def sniffed_lines(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Records of JSON-line logs with the name of their shard and a number in reading order; damaged lines are left out."""
    rows = spark.read.schema(schema + ", _damaged string").option("columnNameOfCorruptRecord", "_damaged").json(paths)
    rows = rows.withColumn("shard", F.input_file_name()).withColumn("ordinal", F.monotonically_increasing_id())
    return rows.where("_damaged is null").drop("_damaged")


def markdown_files(spark: SparkSession, root: str) -> DataFrame:
    """(doc_id, markdown) of the *.md files of a folder whose names don't begin with an underscore."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(root)
    name = F.element_at(F.split("path", "/"), -1)
    return files.where(~name.startswith("_")).select(F.regexp_replace(name, r"\.md$", "").alias("doc_id"), decode_text("content").alias("markdown"))
