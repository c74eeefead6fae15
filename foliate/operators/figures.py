"""Figures: the gate, outcomes and coverage, the corpus index, byte formats and sizes, and the audit."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from foliate.functions import text as fn

#: Classes of marks that are no content, and the area shares that decide (fixed values).
DENIED = ("logo", "icon", "stamp", "signature", "qr_code", "bar_code", "page_thumbnail")
AREA_MIN, AREA_READMIT = 0.02, 0.05


def gate(pictures: DataFrame, doc: str = "doc_id", order: str = "pos") -> DataFrame:
    """The pictures with keep and reason. pictures(doc, order, cls, area, sha, ref).

    Of equal pictures that nothing else drops, the first of a document is kept: a row number within (document, hash),
    which spreads a document's pictures over their hashes. Pictures without a hash are never duplicates.
    """
    area = F.col("area")
    first = F.when(area < AREA_MIN, "tiny").when(F.col("cls").isin(*DENIED) & ~F.coalesce(area >= AREA_READMIT, F.lit(False)), F.concat(F.lit("deny:"), F.col("cls"))).when(F.col("ref") == "chrome", "chrome")
    rows = pictures.withColumn("reason", first)
    place = F.row_number().over(Window.partitionBy(doc, "sha", F.col("reason").isNull()).orderBy(order))
    again = F.col("reason").isNull() & F.col("sha").isNotNull() & (place > 1)
    reason = F.when(again, "dup").otherwise(F.coalesce("reason", F.lit("keep")))
    return rows.withColumn("reason", reason).withColumn("keep", F.col("reason") == "keep")


def outcome(keep: Column, reason: Column, stored: Column, caption_ok: Column) -> Column:
    """What became of a figure."""
    gated = F.when(reason == "tiny", "gated_tiny").when(reason.startswith("deny"), "gated_deny").when(reason == "chrome", "gated_chrome").when(reason == "dup", "gated_dup").otherwise("gated_other")
    return F.when(~keep, gated).when(~stored, "lost_bad_crop").when(caption_ok, "captured").otherwise("no_caption")


def coverage(outcomes: DataFrame, documents: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Figures per document by outcome. outcomes(doc, outcome), documents(doc, n_placeholders, bailed).

    Where the placeholders didn't match and inlining was given up, what would have been kept is lost.
    """
    rows = documents.select(doc, "n_placeholders", "bailed").join(outcomes.select(doc, "outcome"), doc, "left")
    ok = F.col("outcome").isin("captured", "no_caption")
    lost = F.col("outcome").startswith("lost")
    n = lambda c: F.count_if(c)
    out = rows.groupBy(doc, "n_placeholders", "bailed").agg(
        F.count("outcome").alias("n_body"),
        n(ok & ~F.col("bailed")).alias("n_captured"),
        n(F.col("outcome").startswith("gated")).alias("n_gated"),
        n(lost | (ok & F.col("bailed"))).alias("n_lost"),
    )
    return out.withColumn("lossless", (F.col("n_lost") == 0) & (F.col("n_body") == F.col("n_placeholders")))


def corpus_index(figures: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(sha, n_docs, most): in how many documents a picture is, and how often at most in one. The first count combines before the shuffle."""
    return figures.groupBy("sha", doc).agg(F.count("*").alias("n")).groupBy("sha").agg(F.count("*").alias("n_docs"), F.max("n").alias("most"))


def audit(source: DataFrame, records: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Per document, how the pictures of its source are accounted for.

    source(doc, sha, placement), records(doc, sha, seq, kept, outcome_kind, reason, asset_ok). Of a picture's records
    the strongest counts: kept ones first, then those with a good caption, then the earliest.
    """
    rank = F.when(F.col("kept"), 2).otherwise(0) + F.when(F.col("outcome_kind") == "OK", 1).otherwise(0)
    best = records.groupBy(doc, "sha").agg(F.max_by(F.struct("kept", "outcome_kind", "reason", "asset_ok"), F.struct(rank, -F.col("seq"))).alias("r"))
    rows = source.select(doc, "sha", "placement").distinct().join(best, [doc, "sha"], "left").select(doc, "placement", F.col("r").isNull().alias("none"), "r.*")
    pending = ~F.col("none") & (F.col("reason") == "pending")
    loss = ~F.col("none") & ~pending & (F.col("outcome_kind").isin("RENDER_FAILED", "MEDIA_MISSING") | F.col("reason").isin("render_failed", "media_missing"))
    live = ~F.col("none") & ~pending & ~loss
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    out = rows.groupBy(doc).agg(
        F.count("*").alias("n_source"),
        n(live & F.col("kept") & (F.col("outcome_kind") == "OK")).alias("n_captured"),
        n(live & F.col("kept") & ~(F.col("outcome_kind") == "OK")).alias("n_kept"),
        n(live & ~F.col("kept")).alias("n_dropped"),
        n(pending).alias("n_pending"),
        n(F.col("none")).alias("n_unaccounted"),
        n(live & F.col("kept") & ~F.col("asset_ok")).alias("n_orphan"),
        n(live & ~F.col("kept") & (F.col("reason") == "chrome") & (F.col("placement") != "chrome")).alias("n_misgate"),
        n(loss).alias("n_loss"),
    )
    return out.withColumn("lossless", F.expr("n_unaccounted + n_orphan + n_misgate + n_pending + n_loss = 0"))


def sniff(content: Column | str) -> Column:
    """The picture format that the first bytes show; empty for none."""
    c = fn.col(content)
    head = lambda n: F.hex(F.substring(c, 1, n))
    at = lambda start, n: F.hex(F.substring(c, start, n))
    text = F.lower(F.decode(F.substring(c, 1, 2048), "ISO-8859-1"))
    start = F.regexp_replace(text, r"^[\x{EF}\x{BB}\x{BF} \t\r\n]+", "")
    return (
        F.when(head(8) == "89504E470D0A1A0A", "png")
        .when(head(3) == "FFD8FF", "jpeg")
        .when(head(6).isin("474946383761", "474946383961"), "gif")
        .when(head(2) == "424D", "bmp")
        .when(head(4).isin("49492A00", "4D4D002A"), "tiff")
        .when((head(4) == "52494646") & (at(9, 4) == "57454250"), "webp")
        .when(head(4).isin("D7CDC69A", "01000900"), "wmf")
        .when((at(41, 4) == "20454D46") & (head(4) == "01000000"), "emf")
        .when((start.startswith("<?xml") | start.startswith("<svg")) & text.contains("<svg"), "svg")
        .otherwise("")
    )


def dimensions(data: bytes | None) -> tuple[int, int] | None:
    """(width, height) of PNG, GIF, BMP and JPEG bytes; None where they don't tell."""
    d = data or b""
    try:
        if d[:8] == b"\x89PNG\r\n\x1a\n" and d[12:16] == b"IHDR":
            return struct.unpack(">II", d[16:24])
        if d[:4] == b"GIF8":
            return struct.unpack("<HH", d[6:10])
        if d[:2] == b"BM":
            w, h = struct.unpack("<ii", d[18:26])
            return abs(w), abs(h)
        if d[:3] == b"\xff\xd8\xff":
            at = 2
            while at + 9 < len(d):
                if d[at] != 0xFF:
                    at += 1
                    continue
                mark = d[at + 1]
                if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack(">HH", d[at + 5 : at + 9])
                    return w, h
                if mark == 0xFF or mark == 0x01 or 0xD0 <= mark <= 0xD9:
                    at += 1 if mark == 0xFF else 2
                else:
                    at += 2 + struct.unpack(">H", d[at + 2 : at + 4])[0]
    except struct.error:
        pass
    return None


@F.pandas_udf(T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))
def image_size(content: pd.Series) -> pd.DataFrame:
    sizes = [dimensions(c) or (None, None) for c in content]
    return pd.DataFrame(sizes, columns=["width", "height"]).astype("Int32")
