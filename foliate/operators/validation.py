"""Structural checks of Markdown, content metrics, and the gates that turn counts into verdicts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from foliate.functions import text as fn

#: Fence lines, headings, cells, leaked markup and damage (fixed patterns).
FENCE = r"^\s{0,3}(```|~~~)"
_LEAD = r"[ \t\f\x0B\r]{0,3}"  # white space within a line
_fence = re.compile(FENCE)
_heading = re.compile(r"(#{1,6})\s+\S")
_pipe = re.compile(r"(?<!\\)\|")
_rule_cell = re.compile(r":?-+:?")
_leak = re.compile(r"(?<!\\)</?(?:w|a|p|c|m|mc|v|o|wp|wps|wpg|pic|xdr|cp|dcterms|dc):[A-Za-z][A-Za-z0-9]*\b")
_damage = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffd]")

Issue = tuple[int, str, str, str]


def cells(line: str) -> list[str]:
    """The cells of a pipe-table line; escaped pipes are text."""
    parts = _pipe.split(line.strip())
    start = 1 if parts and not parts[0].strip() else 0
    end = len(parts) - (1 if len(parts) > start and not parts[-1].strip() else 0)
    return parts[start:end]


def is_rule(line: str) -> bool:
    found = cells(line)
    return bool(found) and all(_rule_cell.fullmatch(c.strip()) for c in found)


def _table(block: list[tuple[int, str]]) -> Iterator[Issue]:
    if len(block) < 2:
        return
    (first, header), rest = block[0], block[1:]
    if not is_rule(rest[0][1]):
        yield first, "table-no-separator", "warning", "pipe block has no separator row"
        return
    want = len(cells(header))
    for number, line in rest:
        if (got := len(cells(line))) != want:
            yield number, "table-columns", "error", f"row has {got} cells, header has {want}"


def issues(md: str | None) -> list[Issue]:
    """(line from 1, code, severity, message) of every structural issue, by line and code."""
    lines = (md or "").split("\n")
    found: list[Issue] = []
    body = 0
    if lines[0].strip() == "---":
        body = next((i + 1 for i in range(1, len(lines)) if lines[i].strip() == "---"), 0)
        if not body:
            found.append((1, "frontmatter-unclosed", "error", "front matter is never closed"))
            body = len(lines)
    found += [(i + 1, "bad-chars", "error", "control or replacement character") for i, line in enumerate(lines) if _damage.search(line)]
    opened, level, block = 0, 0, []
    for i in range(body, len(lines)):
        line, number = lines[i], i + 1
        if _fence.match(line):
            found += _table(block)
            block = []
            opened = 0 if opened else number
            fence_line = number
            continue
        if opened:
            continue
        if _leak.search(line):
            found.append((number, "xml-leak", "error", "raw markup leaked into the text"))
        if m := _heading.match(line):
            if level and len(m[1]) > level + 1:
                found.append((number, "heading-jump", "warning", f"heading level jumps from {level} to {len(m[1])}"))
            level = len(m[1])
        if _pipe.search(line):
            block.append((number, line))
        else:
            found += _table(block)
            block = []
    found += _table(block)
    if opened:
        found.append((fence_line, "fence-unclosed", "error", "code fence is never closed"))
    return sorted(found, key=lambda x: (x[0], x[1]))


ISSUES_TYPE = T.ArrayType(T.StructType([T.StructField("line", T.IntegerType()), *(T.StructField(n, T.StringType()) for n in ("code", "severity", "message"))]))


@F.pandas_udf(ISSUES_TYPE)
def validate_markdown(md: pd.Series) -> pd.Series:
    names = ("line", "code", "severity", "message")
    return md.map(lambda t: [dict(zip(names, i)) for i in issues(t)])


def lines_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line, raw): the lines of each document, from 0."""
    return docs.select(F.col(key).alias("key"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("line", "raw"))


def content_metrics(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Counts per document. Document-local and linear in its length: no row is exploded or shuffled.

    Fence lines open and close code in turn, whatever their marks, so code is taken out of the text by one pattern that
    runs from a fence line to the next (or to the end); the rest is counted line by line.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    prose = F.regexp_replace(body, rf"(?ms)^{_LEAD}(?:```|~~~)[^\n]*(?:\n.*?)??(?:\n{_LEAD}(?:```|~~~)[^\n]*$|\z)", "")
    base = docs.select(F.col(key).alias("key"), body.alias("body"), F.split(body, "\n", -1).alias("lines"), F.split(prose, "\n", -1).alias("prose"))
    count = lambda p: F.size(F.filter("prose", lambda x: x.rlike(p))).cast("bigint")
    total = lambda p: F.aggregate("prose", F.lit(0), lambda a, x: a + F.regexp_count(x, F.lit(p))).cast("bigint")
    piped = r"(?<!\\)\|"
    rule = lambda s: s.rlike(piped) & fn.strip(s).rlike(r"^\|?(\s*:?-+:?\s*\|)*\s*:?-+:?\s*\|?$")
    starts = F.transform("prose", lambda x, i: x.rlike(piped) & rule(F.coalesce(F.get("prose", i + 1), F.lit(""))))
    dollars = (F.length("body") - F.length(F.replace("body", F.lit("$$"), F.lit("")))) / 2
    return base.select(
        "key",
        F.length("body").cast("bigint").alias("chars"),
        F.aggregate("lines", F.lit(0), lambda a, x: a + ((F.length(x) + 3) / 4).cast("int")).cast("bigint").alias("tokens"),
        count(r"^#{1,6}\s+\S").alias("headings"),
        F.size(F.filter(starts, lambda x: x)).cast("bigint").alias("tables"),
        total(r"!\[[^\]]*\]\([^)\s]+").alias("images"),
        total(r"(?<![!\\])\[[^\]]*\]\([^)\s]+").alias("links"),
        count(r"^\s*([-*+]|\d+[.)])\s+\S").alias("lists"),
        F.floor(F.regexp_count("body", F.lit(rf"(?m)^{_LEAD}(?:```|~~~)")) / 2).cast("bigint").alias("code_blocks"),
        F.floor(dollars / 2).cast("bigint").alias("formulas"),
    )


def pipe_blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, first, n): runs of consecutive lines with a pipe, by the difference of two numberings."""
    rows = lines_of(docs, key, text).where(F.col("raw").contains("|"))
    rows = rows.withColumn("island", F.col("line") - F.row_number().over(Window.partitionBy("key").orderBy("line")))
    return rows.groupBy("key", "island").agg(F.min("line").alias("first"), F.count("*").alias("n")).select("key", "first", "n")


# ---- gates ----------------------------------------------------------------------------------------------------------


def lossless(recall: Column, errors: Column, foreign: Column, content: Column, content_min: float = 0.95) -> Column:
    """Every token survives, no error, and where three letters or more are of other scripts, the characters survive, too."""
    return (recall == 1.0) & (errors == 0) & ((foreign < 3) | (content >= content_min))


def foreign_letters(text: Column | str) -> Column:
    """Letters and digits outside of ASCII."""
    return F.length(F.regexp_replace(fn.unicode_stream(text), r"[\x00-\x7F]+", ""))


def measured_gate(lane: Column, valid: Column, given: Column) -> Column:
    """Only the office lane is graded against its source; the others' gate is never a pass."""
    return F.when(lane == "office", F.when(valid, "pass").otherwise("fail")).when(given.isNull() | (given == "pass"), "best-effort").otherwise(given)


def report_status(gate: Column, errors: Column, warnings: Column) -> Column:
    return F.when((gate == "fail") | (errors > 0), "failed").when(warnings > 0, "degraded").otherwise("ok")


def image_gate(referenced: Column, extracted: Column, unique_files: Column, missing: Column, orphans: Column, verified: Column) -> Column:
    return F.when((missing == 0) & (orphans == 0) & (extracted == referenced) & (verified == unique_files), "pass").otherwise("degraded")


def outline_gate(uncovered: Column) -> Column:
    return F.when(uncovered == 0, "pass").otherwise("degraded")


def outline_ratio(content: Column, covered: Column, toc: Column) -> Column:
    return F.when(content != 0, F.round((covered + toc) / content, 4)).otherwise(1.0)


def caption_gate(enabled: Column, expected: Column, captioned: Column, furniture: Column, useless: Column, pending: Column) -> Column:
    tried = captioned + furniture + useless
    return F.when(~enabled, "disabled").when((expected == 0) | (pending == 0), "complete").when(tried == 0, "pending").otherwise("incomplete")


def bundle_status(status: Column, images: Column, outline: Column) -> Column:
    """Pictures and outline degrade only what is ok."""
    return F.when((status == "ok") & ((images != "pass") | (outline != "pass")), "degraded").otherwise(status)
