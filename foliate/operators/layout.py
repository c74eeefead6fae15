"""Measuring conversions of layout documents, which have no ground truth but an independent text layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliate.functions import text as fn
from foliate.functions.markdown import markdown_to_text
from foliate.operators import recall

BAD_STATUS = ("FAILURE", "PARTIAL_SUCCESS")


def text_layer_probe(pages: DataFrame, sample: int = 10, least: int = 100) -> DataFrame:
    """(doc_id, has_text): whether the first and the last pages hold enough characters a page. pages(doc_id, page_no, text), from 0.

    A window's characters are those of its joined pages without the white space at its ends.
    """
    n = pages.groupBy("doc_id").agg(F.max("page_no").alias("last"))
    rows = pages.join(n, "doc_id")
    ends = F.array(F.when(F.col("page_no") < sample, F.lit("head")), F.when((F.col("last") >= sample) & (F.col("page_no") > F.col("last") - sample), F.lit("tail")))
    windows = rows.select("doc_id", "page_no", "text", F.explode(ends).alias("end")).where("end is not null")
    joined = windows.groupBy("doc_id", "end").agg(F.array_sort(F.collect_list(F.struct("page_no", "text"))).alias("p"))  # at most `sample` pages
    chars = F.length(fn.strip(F.array_join(F.transform("p", lambda x: F.coalesce(x["text"], F.lit(""))), "")))
    return joined.select("doc_id", (chars / F.greatest(F.size("p"), F.lit(1)) >= least).alias("ok")).groupBy("doc_id").agg(F.bool_and("ok").alias("has_text"))


def needs_ocr(mode: str, ext: Column, has_text: Column) -> Column:
    """Only for page documents: always, never, or where there is no text layer."""
    return (ext == "pdf") & {"on": F.lit(True), "off": F.lit(False)}.get(mode, ~F.coalesce(has_text, F.lit(False)))


def region_text(words: DataFrame, boxes: DataFrame) -> DataFrame:
    """(doc_id, text): the words that lie in regions, page by page in reading order; a word in two regions comes twice. words(doc_id, page, pos, word, x0..y1), boxes(doc_id, page, box, x0..y1)."""
    inside = recall.words_in_boxes(words.withColumn("word", F.struct("pos", "word")), boxes, ["doc_id", "page"])
    got = inside.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "box", "word"))).alias("w"))
    return got.select("doc_id", F.array_join(F.transform("w", lambda x: x["word"]["word"]), " ").alias("text"))


def more_complete(layer: Column, md: Column, content_min: float = 0.85, least_tokens: int = 100) -> Column:
    """Whether the text layer holds what the Markdown misses."""
    big = F.size(fn.tokenize(layer)) >= least_tokens
    return big & (recall.char_recall(layer, markdown_to_text(F.coalesce(md, F.lit("")))) < content_min)


def with_fallback(rows: DataFrame, layer: str = "layer", md: str = "markdown") -> DataFrame:
    """Where the text layer is more complete it becomes the body, without running lines; `fell_back` says so."""
    rows = rows.withColumn("fell_back", more_complete(F.col(layer), F.col(md)))
    return rows.withColumn(md, F.when(F.col("fell_back"), recall.without_running_lines(layer)).otherwise(F.col(md)))


def losslessness(rows: DataFrame, min_recall: float = 0.8, min_tokens: int = 50, content_min: float = 0.95) -> DataFrame:
    """(doc_id, token_recall, content_recall, lossy, unexplained, gate). rows(doc_id, layer, markdown, furniture, image_text).

    Furniture and text within pictures count as kept: they are taken off the source's tokens, and put beside the target's characters.
    """
    furniture, images = (F.coalesce(F.col(c), F.lit("")) for c in ("furniture", "image_text"))
    base = rows.select(F.col("doc_id").alias("key"), F.col("layer").alias("text"), markdown_to_text(F.coalesce("markdown", F.lit(""))).alias("md"), F.concat_ws(" ", furniture, images).alias("extra"))
    tokens = recall.coverage(base.select("key", "text"), base.select("key", F.col("md").alias("text")), base.select("key", F.col("extra").alias("text")))
    content = base.select("key", recall.char_recall("text", F.concat_ws(" ", "md", "extra")).alias("content_recall"))
    out = tokens.join(content, "key")
    lossy = recall.is_lossy_explained(F.col("n_source"), F.col("recall"), F.col("content_recall"), min_recall, min_tokens, content_min)
    return out.select(F.col("key").alias("doc_id"), F.col("recall").alias("token_recall"), "content_recall", lossy.alias("lossy"), F.greatest(F.lit(0.0), 1 - F.col("content_recall")).alias("unexplained"), F.lit("best-effort").alias("gate"))


def is_valid(status: Column, structure_ok: Column, lossy: Column, figures_lossless: Column) -> Column:
    """Structure and content hold, the converter didn't fail, and figures, where measured, are whole; text that passes through needs its structure only."""
    whole = ~F.upper(F.coalesce(status, F.lit(""))).isin(*BAD_STATUS) & ~lossy & F.coalesce(figures_lossless, F.lit(True))
    return F.when(F.upper(status) == "PASSTHROUGH", structure_ok).otherwise(structure_ok & whole)
