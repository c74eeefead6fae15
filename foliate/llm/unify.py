"""One consistent form for text that looks the same but differs in its characters.

The form of a line: compatibility composition (NFKC); characters that are ignorable by default removed; spaces and
hyphens of all kinds mapped to the ASCII ones; Greek and Cyrillic look-alikes inside an otherwise Latin run of
letters, digits and ``_`` mapped to the Latin letters; full case folding; composition again.

A line is *irregular* if it holds a compatibility form, a letter with a separate combining accent, an ignorable
character, another space or hyphen than the ASCII one, or a look-alike in a Latin run. Tabs and form feeds, wholly
non-Latin words, precomposed letters, and units written with Greek mu or omega are regular.

Work is vectorised: lines are split and screened as Arrow arrays (one pass of a character class in C++), and what is
left is looked at once per distinct value of a batch. No shuffle but that of the few result rows.

Defined results: null texts give null and no lines; empty texts give the empty text; repeated rows are reported once
per key and line; texts of any length are handled whole.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.llm.lines import slices, split_lines

#: Characters of the property Default_Ignorable_Code_Point, and others that take no room (fixed values of the Unicode standard).
IGNORABLE = "\u00ad\u034f\u061c\u115f-\u1160\u17b4-\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\ufff0-\ufff8\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff"
#: Hyphens other than the ASCII one (fixed values).
HYPHENS = "\u058a\u1806\u2010\u2011\u2e17\ufe63\uff0d"
#: Combining accents of the general blocks (fixed values).
ACCENTS = "\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f"
#: Look-alike letters and the Latin letters they stand for (fixed values).
CYRILLIC = ("АВЕКМНОРСТУХЅІЈЁаеіјорсухѕԁԛԝһ", "ABEKMHOPCTYXSIJËaeijopcyxsdqwh")
GREEK = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαεγικνορτυχϲϳ", "ABEZHIKMNOPTYXaeyikvoptuxcj")
LOOKALIKES = str.maketrans(CYRILLIC[0] + GREEK[0], CYRILLIC[1] + GREEK[1])

_ignorable = re.compile(f"[{IGNORABLE}]+")
_space = re.compile("[\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_hyphen = re.compile(f"[{HYPHENS}]")
_accented = re.compile(f"[^\\W\\d_][{ACCENTS}]")
_run = re.compile(r"\w+")
_foreign = re.compile("[\u0370-\u03ff\u0400-\u052f\u1f00-\u1fff]")
_latin = re.compile("[A-Za-z\u00aa\u00ba\u00c0-\u024f\u1e00-\u1eff]")
_others = re.compile("[^0-9_A-Za-z\u00aa\u00ba\u00c0-\u024f\u1e00-\u1eff\u0370-\u03ff\u0400-\u052f\u1f00-\u1fff]")
_unit = re.compile("[0-9]*(?:[TGMkmnpf]?Ω|μ[A-Za-z]{1,3})")


def _ranges(points: list[int]) -> str:
    out, start = [], None
    for a, b in zip(points, points[1:] + [-1]):
        start = a if start is None else start
        if b != a + 1:
            out.append(f"\\x{{{start:X}}}-\\x{{{a:X}}}")
            start = None
    return "".join(out)


@lru_cache(1)
def compatibility_class() -> str:
    """RE2 ranges of the characters that compatibility normalisation changes."""
    return _ranges([i for i in range(0x80, sys.maxunicode + 1) if not 0xD800 <= i < 0xE000 and not unicodedata.is_normalized("NFKC", chr(i))])


@lru_cache(1)
def screen_class() -> str:
    """RE2 class of all characters an irregular line must hold one of."""
    points: set[int] = set()
    for text in (IGNORABLE, HYPHENS, ACCENTS, "\u0370-\u03ff", "\u0400-\u052f", "\u1f00-\u1fff", "\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"):
        for m in re.finditer("(.)(?:-(.))?", text, re.DOTALL):
            points.update(range(ord(m[1]), ord(m[2] or m[1]) + 1))
    return f"[{_ranges(sorted(points))}{compatibility_class()}]"


def _mixed_runs(line: str) -> list[re.Match]:
    """Runs of letters, digits and _ that hold a Greek or Cyrillic letter and are Latin otherwise; units excepted."""
    return [m for m in _run.finditer(line) if _foreign.search(m[0]) and not _others.search(m[0]) and _mixes(m[0])]


def _mixes(run: str) -> bool:
    """Whether a run is Latin but for its foreign letters: by a Latin letter, or as a number in which they are the fewer signs."""
    return bool(_latin.search(run) or (re.search("[0-9]", run) and len(_foreign.findall(run)) < len(run) / 2)) and not _unit.fullmatch(run)


def irregular(line: str) -> bool:
    """Whether a line differs in its characters from the consistent form (case apart)."""
    if line.isascii():
        return False
    if _ignorable.search(line) or _space.search(line) or _hyphen.search(line) or _accented.search(line):
        return True
    if any(not c.isascii() and not unicodedata.is_normalized("NFKC", c) for c in set(line)):
        return True
    return bool(_foreign.search(line) and _mixed_runs(line))


def consistent(line: str, fold_case: bool = True) -> str:
    """The consistent form of a line."""
    if line.isascii():
        return line.casefold() if fold_case else line
    line = _ignorable.sub("", line)
    line = unicodedata.normalize("NFKC", _space.sub(" ", line))
    line = _hyphen.sub("-", _ignorable.sub("", line))
    if _foreign.search(line):
        out, at = [], 0
        for m in _mixed_runs(line):
            out += [line[at : m.start()], m[0].translate(LOOKALIKES)]
            at = m.end()
        line = "".join(out) + line[at:]
    return unicodedata.normalize("NFKC", line.casefold()) if fold_case else line


def irregular_lines(df: DataFrame, field: str, key_col: str, text_col: str) -> DataFrame:
    """(field, rec_key, line_no, form): every irregular line of every text, with its consistent form."""
    screen = screen_class()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                lines, row, number = split_lines(batch.column(1))
                hit = pc.match_substring_regex(lines, screen).to_numpy(zero_copy_only=False)
                at = np.flatnonzero(hit)
                if not len(at):
                    continue
                coded = lines.take(pa.array(at)).dictionary_encode()
                values = coded.dictionary.to_pylist()
                forms = [consistent(v) if irregular(v) else None for v in values]
                code = coded.indices.to_numpy()
                bad = np.array([f is not None for f in forms])[code]
                at, code = at[bad], code[bad]
                keys = batch.column(0).take(pa.array(row[at]))
                yield pa.RecordBatch.from_arrays([keys, pa.array(number[at]), pa.array(forms, pa.string()).take(pa.array(code))], ["rec_key", "line_no", "form"])

    source = df.select(F.col(key_col).cast("string").alias("k"), F.col(text_col).alias("t")).where("k is not null and t is not null")
    out = source.mapInArrow(run, "rec_key string, line_no bigint, form string")
    return out.select(F.lit(field).alias("field"), "rec_key", "line_no", "form")


def consistent_column(df: DataFrame, text_col: str, out_col: str, fold_case: bool = True) -> DataFrame:
    """The rows with the consistent form of a text column beside them; an equal text is normalised once per batch."""
    n = len(df.columns)
    names = [f"c{i}" for i in range(n + 1)]
    fields = ", ".join(f"{a} {f.dataType.simpleString()}" for a, f in zip(names, df.schema.fields))
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.column(at).dictionary_encode()
            forms = []
            for text in coded.dictionary.to_pylist():
                lines = text.split("\n")
                seen = {line: consistent(line, fold_case) for line in set(lines)}
                forms.append("\n".join(map(seen.__getitem__, lines)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forms, pa.string()).take(coded.indices)], names)

    return df.toDF(*names[:n]).mapInArrow(run, f"{fields}, {names[n]} string").toDF(*df.columns, out_col)
