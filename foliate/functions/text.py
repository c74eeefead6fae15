"""Text functions as column expressions: they stay inside the JVM and its generated code.

White space and digits mean the Unicode ones throughout (SPACE); null texts count as empty.
"""

from __future__ import annotations

import html as _html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What counts as white space, as a character class that Java and RE2 read alike (fixed values).
SPACE = r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"

#: The kinds of file and the lane that converts each (fixed values).
LANES = {
    "ooxml": ("docx", "pptx", "xlsx"),
    "docling": ("pdf", "html", "htm"),
    "passthrough": ("md", "markdown", "txt", "text"),
    "fence": ("json", "yaml", "yml", "toml", "xml", "csv", "tsv", "ini"),
    "libreoffice": ("odt", "odp", "ods", "doc", "ppt", "xls", "rtf"),
}
UNSUPPORTED = "unsupported"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(c, f"^[{SPACE}]+|[{SPACE}]+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space become one blank; none at the ends."""
    return strip(F.regexp_replace(c, f"[{SPACE}]+", " "))


# ---- routing --------------------------------------------------------------------------------------------------------


def supported_formats() -> tuple[str, ...]:
    return tuple(sorted(e for exts in LANES.values() for e in exts))


def accepted_formats(spec: str | list[str] | tuple[str, ...] | None) -> frozenset[str]:
    """The formats that an accept list names; all where it names none or `all`. Unknown ones are kept."""
    tokens = spec.replace(",", " ").replace(";", " ").split() if isinstance(spec, str) else list(spec or ())
    names = {str(t).strip().lower().lstrip(".") for t in tokens} - {""}
    return frozenset(supported_formats()) if not names or "all" in names else frozenset(names)


def unknown_formats(spec: str | list[str] | None) -> tuple[str, ...]:
    """Formats in an accept list that no lane converts."""
    return tuple(sorted(accepted_formats(spec) - set(supported_formats())))


def extension(name: Column | str) -> Column:
    """The last extension of a path's file name, in lower case; empty where there is none."""
    base = F.element_at(F.split(F.replace(strip(F.coalesce(col(name), F.lit(""))), F.lit("\\"), F.lit("/")), "/"), -1)
    return F.when(F.regexp_replace(base, r"^\.+", "").contains("."), F.lower(strip(F.element_at(F.split(base, r"\."), -1)))).otherwise("")


def lane_of(ext: Column | str) -> Column:
    """The lane that converts files of an extension."""
    bare = F.regexp_replace(F.lower(strip(F.coalesce(col(ext), F.lit("")))), r"^\.+", "")
    cases = [F.when(bare.isin(*exts), F.lit(lane)) for lane, exts in LANES.items()]
    return F.coalesce(*cases, F.lit(UNSUPPORTED))


def classify(name: Column | str, accept: str | None = None) -> Column:
    """struct(ext, lane, accepted, reason) of a path."""
    ext = extension(name)
    lane = lane_of(ext)
    allowed = ext.isin(*sorted(accepted_formats(accept)))
    shown = F.when(ext == "", "(no extension)").otherwise(F.concat(F.lit("."), ext))
    reason = F.when(lane == UNSUPPORTED, F.concat(F.lit("unsupported format "), shown)).when(~allowed, F.concat(F.lit("format "), shown, F.lit(" excluded by accept-list"))).otherwise("")
    return F.struct(ext.alias("ext"), lane.alias("lane"), ((lane != UNSUPPORTED) & allowed).alias("accepted"), reason.alias("reason"))


def document_id(relpath: Column | str) -> Column:
    return F.substring(F.sha1(F.encode(col(relpath), "UTF-8")), 1, 16)


# ---- tokens ---------------------------------------------------------------------------------------------------------


def tokenize(text: Column | str) -> Column:
    """Runs of a-z and 0-9 of the text in lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(col(text), F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))


def ascii_stream(text: Column | str) -> Column:
    """Only the letters a-z and digits of the text in lower case."""
    return F.regexp_replace(F.lower(F.coalesce(col(text), F.lit(""))), "[^a-z0-9]+", "")


def unicode_stream(text: Column | str) -> Column:
    """Only the letters and digits of any script, in lower case."""
    return F.regexp_replace(F.lower(F.coalesce(col(text), F.lit(""))), r"[^\p{L}\p{N}]+", "")


@F.pandas_udf(T.StringType())
def _unescaped(texts: pd.Series) -> pd.Series:
    """Named and numeric character references become their characters."""
    return texts.map(lambda t: _html.unescape(t) if "&" in t else t, na_action="ignore")


def visible_text(page: Column | str) -> Column:
    """The visible text of a page: comments, bodies of scripts and styles, then tags become blanks; then every character reference is resolved."""
    c = F.regexp_replace(F.coalesce(col(page), F.lit("")), "(?s)<!--.*?-->", " ")
    c = F.regexp_replace(c, r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>", " ")
    c = F.regexp_replace(c, "(?s)<[^>]+>", " ")
    return _unescaped(c)


def savings(source_chars: Column | str, markdown_chars: Column | str) -> Column:
    """struct(reduction_ratio, saved_pct): how much smaller the Markdown is than what it stands for."""
    src, md = col(source_chars).cast("double"), col(markdown_chars).cast("double")
    ratio = F.when(md != 0, F.round(src / md, 2)).when(src == 0, 1.0).otherwise(0.0)
    saved = F.when(src != 0, F.round(F.lit(100.0) * (1 - md / src), 2)).otherwise(0.0)
    return F.struct(ratio.alias("reduction_ratio"), saved.alias("saved_pct"))


# ---- Markdown pieces ------------------------------------------------------------------------------------------------


def yaml_scalar(value: Column | str) -> Column:
    """A double-quoted scalar on one line."""
    c = F.coalesce(col(value).cast("string"), F.lit("None"))
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\r\n", "\\n"), ("\n", "\\n"), ("\r", "\\n"), ("\t", "\\t")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.concat(F.lit('"'), c, F.lit('"'))


def front_matter(fields: dict[str, Column]) -> Column:
    """A block of fields in the given order; a null value leaves its line out; no line at all gives the empty text."""
    lines = F.filter(F.array(*[F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), yaml_scalar(v))) for k, v in fields.items()]), lambda x: x.isNotNull())
    return F.when(F.size(lines) > 0, F.concat(F.lit("---\n"), F.array_join(lines, "\n"), F.lit("\n---\n"))).otherwise("")


def strip_front_matter(md: Column | str) -> Column:
    """Without a leading front-matter block."""
    c = F.coalesce(col(md), F.lit(""))
    close = F.locate("\n---\n", c, 4)
    return F.when(c.startswith("---\n") & (close > 0), F.substr(c, close + 5)).otherwise(c)


def fence(content: Column | str, language: Column | str = "") -> Column:
    """The content in a code fence longer than any run of backticks in it."""
    c = F.coalesce(col(content), F.lit(""))
    lang = language if isinstance(language, Column) else F.lit(language)
    runs = F.transform(F.regexp_extract_all(c, F.lit("`+"), F.lit(0)), lambda x: F.length(x))
    ticks = F.repeat(F.lit("`"), F.greatest(F.lit(3), F.coalesce(F.array_max(runs) + 1, F.lit(3))))
    body = F.when((c == "") | c.endswith("\n"), c).otherwise(F.concat(c, F.lit("\n")))
    return F.concat(ticks, lang, F.lit("\n"), body, ticks, F.lit("\n"))


def image_link(caption: Column | str, path: Column | str) -> Column:
    """An image link whose caption can't break it."""
    alt = squeeze(F.coalesce(col(caption), F.lit("")))
    for a, b in (("\\", " "), ("]", "\\]"), ("|", "/"), ("`", "'")):
        alt = F.replace(alt, F.lit(a), F.lit(b))
    return F.concat(F.lit("!["), alt, F.lit("]("), col(path), F.lit(")"))


def fill_placeholders(md: Column | str, renders: Column | str, placeholder: str = "<!-- image -->") -> Column:
    """The k-th placeholder becomes the k-th render; a null render drops it; more placeholders than renders stay."""
    parts = F.split(col(md), r"\Q" + placeholder + r"\E", -1)
    rest = F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1)))
    items = F.coalesce(col(renders), F.array().cast("array<string>"))
    filled = F.transform(rest, lambda p, i: F.concat(F.when(i < F.size(items), F.coalesce(F.get(items, i), F.lit(""))).otherwise(placeholder), p))
    return F.concat(F.element_at(parts, 1), F.array_join(filled, ""))


def sentinels(md: Column | str, kind: str) -> Column:
    """The names in `<!-- kind:NAME -->` marks, in order."""
    return F.regexp_extract_all(F.coalesce(col(md), F.lit("")), F.lit(rf"<!-- {kind}:([^>]+?) -->"), F.lit(1))


def fill_sentinels(md: Column | str, fills: Column | str, kind: str) -> Column:
    """Each mark becomes what the map has under its name; a null drops it; unknown names stay."""
    table = col(fills)
    texts = F.split(col(md), rf"<!-- {kind}:[^>]+? -->", -1)
    names = sentinels(md, kind)
    mark = lambda n: F.concat(F.lit(f"<!-- {kind}:"), n, F.lit(" -->"))
    tail = F.transform(names, lambda n, i: F.concat(F.when(F.map_contains_key(table, n), F.coalesce(F.try_element_at(table, n), F.lit(""))).otherwise(mark(n)), F.get(texts, i + 1)))
    return F.concat(F.element_at(texts, 1), F.array_join(tail, ""))


def escape_markdown(text: Column | str) -> Column:
    """Characters that Markdown would read are escaped."""
    return F.regexp_replace(F.coalesce(col(text), F.lit("")), r"([\\*_`<\[\]~])", r"\\$1")


def escape_lead(text: Column | str) -> Column:
    """A line start that would make a quote, a list or a heading is escaped."""
    c = F.regexp_replace(F.coalesce(col(text), F.lit("")), r"^(>|[#+*\-](?=\s))", r"\\$1")
    return F.regexp_replace(c, r"^(\d+)([.)])(?=\s)", r"$1\\$2")


def table_cell(text: Column | str) -> Column:
    """A cell on one line with its pipes escaped."""
    return F.replace(squeeze(F.coalesce(col(text), F.lit(""))), F.lit("|"), F.lit("\\|"))


def pipe_table(rows: Column | str) -> Column:
    """Rows (an array of arrays) as a pipe table; blank rows are dropped, short ones padded, the first is the header."""
    cells = F.filter(F.transform(col(rows), lambda r: F.transform(r, lambda c: table_cell(c))), lambda r: F.exists(r, lambda c: c != ""))
    last = lambda r: F.coalesce(F.array_max(F.transform(r, lambda c, i: F.when(c != "", i + 1).otherwise(0))), F.lit(0))
    width = F.coalesce(F.array_max(F.transform(cells, last)), F.lit(0))
    padded = F.transform(cells, lambda r: F.slice(F.concat(r, F.array_repeat(F.lit(""), width)), F.lit(1), F.greatest(width, F.lit(1))))
    line = lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |"))
    separator = F.array(line(F.array_repeat(F.lit("---"), width)))
    body = F.transform(padded, line)
    out = F.concat(F.slice(body, 1, 1), separator, F.slice(body, 2, F.greatest(F.size(body), F.lit(1))))
    return F.when(F.size(body) > 0, F.array_join(out, "\n")).otherwise("")


def collapse_padding(md: Column | str) -> Column:
    """Table rows with one blank around each cell; separators keep their colons; other lines stay."""
    cut = lambda s: F.regexp_replace(F.regexp_replace(s, r"^\|", ""), r"\|$", "")

    def one(raw: Column) -> Column:
        s = strip(raw)
        cells = F.transform(F.split(cut(s), r"(?<!\\)\|", -1), strip)
        rule = raw.rlike(r"^\s*\|?[\s:|\-]*-[\s:|\-]*\|?\s*$")
        marks = F.transform(cells, lambda c: F.concat(F.when(c.startswith(":"), ":").otherwise(""), F.lit("---"), F.when(c.endswith(":"), ":").otherwise("")))
        row = F.concat(F.lit("| "), F.array_join(F.when(rule, marks).otherwise(cells), " | "), F.lit(" |"))
        return F.when(s.rlike(r"^\|.*\|"), row).otherwise(raw)

    return F.array_join(F.transform(F.split(F.coalesce(col(md), F.lit("")), "\n", -1), one), "\n")


# ---- headings -------------------------------------------------------------------------------------------------------


#: What makes a line a heading (fixed values): pattern, base level, and the character whose number in the pattern's group is added.
#: The first that fits counts. Both the column expression here and the outline's walk are made from this table.
HEADINGS = (
    (r"^(#{1,6}\s+\S[\s\S]*)", 0, "#"),
    (r"(?i)^(chapter|section|appendix|part)\s+[0-9IVXLA-Z]", 1, ""),
    (r"^(\d+(?:\.\d+){0,3})\.?\s+[A-Za-z]", 1, "."),
)
LONGEST_HEADING = 120
#: A line in capitals is a heading, too: longest, most words, share of capitals among its letters (fixed values).
LOUD = (70, 10, 0.85)
#: Contents entries, bare numbers, the contents' own heading, table rows (fixed patterns).
LEADERS, BARE_NUMBER, CONTENTS, TABLE_ROW = r"\.{4,}\s*\d+\s*$", r"^\s*\d+\s*$", r"(?i)^\s*(?:table of contents|contents)\s*$", r"^\|.*\|"


def heading_level(line: Column | str) -> Column:
    """The level of a heading line, 0 for others."""
    s = strip(F.coalesce(col(line), F.lit("")))
    letters, capitals = F.length(F.regexp_replace(s, r"[^\p{L}]+", "")), F.length(F.regexp_replace(s, r"[^\p{Lu}]+", ""))
    loud = (letters > 0) & (F.length(s) <= LOUD[0]) & (F.size(F.split(squeeze(s), " ")) <= LOUD[1]) & (capitals / F.greatest(letters, F.lit(1)) > LOUD[2])
    level = F.when((s == "") | (F.length(s) > LONGEST_HEADING), 0)
    for pattern, base, counted in HEADINGS:
        group = F.regexp_extract(s, pattern, 1)
        level = level.when(s.rlike(pattern), F.length(group) - F.length(F.replace(group, F.lit(counted), F.lit(""))) + base if counted else F.lit(base))
    return level.when(loud, 1).otherwise(0)


def is_toc_line(line: Column | str) -> Column:
    """An entry with leaders and a page number, or a bare number."""
    return col(line).rlike(LEADERS) | col(line).rlike(BARE_NUMBER)


def is_table_row(line: Column | str) -> Column:
    return strip(col(line)).rlike(TABLE_ROW)


def is_separator_row(line: Column | str) -> Column:
    s = strip(col(line))
    return s.contains("-") & s.contains("|") & s.rlike(rf"^[|:\-{SPACE}]+$")


def normal_title(title: Column | str) -> Column:
    """A heading's text for anchors: without marks, number and case."""
    s = strip(F.regexp_replace(strip(F.coalesce(col(title), F.lit(""))), "^#+", ""))
    s = F.regexp_replace(s, r"\s+#+\s*$", "")
    s = F.regexp_replace(s, r"^\s*\d+(?:\.\d+){0,3}\.?\s+", "")
    return F.lower(squeeze(s))


# ---- captions -------------------------------------------------------------------------------------------------------

#: Words that make a caption one of content, and those that make it one of page furniture (fixed values).
INFORMATIVE = "architecture block chart circuit diagram drawing equation figure flowchart formula graph histogram illustration layout map network photo photograph plot render scatter schematic screenshot sequence state table timing tree waveform".split()
FURNITURE = "avatar badge bullet emblem favicon icon letterhead logo signature stamp thumbnail watermark".split()


def caption_is_useful(text: Column | str) -> Column:
    """A sentence of mostly letters that doesn't repeat itself."""
    c = squeeze(F.coalesce(col(text), F.lit("")))
    words = F.split(F.lower(c), " ")
    letters = F.length(F.regexp_replace(c, r"[^\p{L}]+", ""))
    dull = (F.size(words) >= 8) & (F.size(F.array_distinct(words)) <= 0.3 * F.size(words))
    return (F.length(c) >= 25) & (letters >= 0.5 * F.length(c)) & ~dull


def caption_is_furniture(text: Column | str) -> Column:
    """The first sentence names furniture and no part names content."""
    low = F.lower(strip(F.coalesce(col(text), F.lit(""))))
    return ~low.rlike(rf"\b(?:{'|'.join(INFORMATIVE)})") & F.regexp_extract(low, r"(?s)^[^.]*\.?", 0).rlike(rf"\b(?:{'|'.join(FURNITURE)})")
