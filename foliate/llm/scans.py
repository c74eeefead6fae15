"""Repairing the text of scanned pages: furniture, cut words and misread characters.

* *Lexicon.* Tokens, hyphenated compounds and pairs of neighbouring tokens are counted over all texts, on whole batches
  as arrays of characters. The counts stay a table; none is left out, however rare.
* *Misread words.* Each *distinct* token is corrected once, as a table. A symmetric-delete index joins the tokens to the
  words: on either side up to two units (characters or pairs that scanning confuses) give way to a hole, and equal forms
  meet. Digits and @, which no word holds, are put back first. So every word within reach is found, not only near ones.
  A weighted edit distance, in which only the confusion pairs of scanning are cheap, prices the pairs, and a word must be
  RATIO times as frequent as the token (a relative measure: the same page gives the same result in a corpus of any size).
  The counts of the pairs with the tokens before and after pick among several candidates.
* *Cut words.* A line that ends in a mark after letters is joined with the next running line without the mark, if the
  joined word is known (or is a misreading of a known one) and the hyphenated compound is not more frequent.
* *Furniture.* Lines are compared in a folded form, in which misread characters and numbers coincide. Page numbers are
  lines of a numbering style whose numbers run on; running headers and footers are folded forms that come again at page
  borders. Page borders are known where a form feed begins a page, else they are where furniture meets.

Evidence: a misreading with a digit or @ stands for itself. One by letters alone needs another sign of scanning in its
text (a cut word, a misreading with a digit or @, page numbers that run on, running lines at form feeds), or a neighbour
with which the word is RATIO times as frequent as the token; capitalised tokens, which may be names, are held to be
misread by letters alone only for words of a share of USUAL_SHARE. Running lines of a text without form feeds need
another sign as well. How many findings a text has doesn't count.

What the pages need of the tables (*facts*) is joined to them by what they hold; where there are at most MAX_FACTS in
all, they travel to the tasks instead. Either way gives the same result.

Defined results: null texts give nothing, empty texts stay empty; repeated rows are reported once; texts of any length
are handled whole; headings, table rows and pictures are never
furniture, and these and code are never cut or misread; equal texts under
different keys are reported for each; ties between candidates go to the more frequent, then to the first in order. The
halves of a cut word are looked for within BORDER written lines, which is more than page borders hold.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.llm.lines import slices
from foliate.llm.neardup import mix
from foliate.llm.screen import Shipped, passes, screen
from foliate.session import written

USUAL_SHARE = 1e-4  # a capitalised token may be any name: without a digit or @ it is held to be a misreading of usual words only
RATIO = 20
KNOWN = 3  # a word seen so often is one
BORDER = 12
PARTED = 3  # lines in a row that may be taken for furniture because they part a known word
MAX_FACTS = 400_000  # rows that travel to the tasks; with more, the pages are joined to them

#: What scanning makes of characters: (misread, true), with the cost of the pair (fixed values).
CONFUSIONS = {
    ("0", "o"): 0.3, ("1", "l"): 0.3, ("1", "i"): 0.3, ("5", "s"): 0.3, ("@", "a"): 0.3, ("2", "z"): 0.3, ("6", "b"): 0.3, ("8", "b"): 0.4, ("9", "g"): 0.4, ("4", "a"): 0.4, ("3", "e"): 0.4, ("7", "t"): 0.4,
    ("c", "e"): 0.35, ("e", "c"): 0.4, ("b", "h"): 0.35, ("h", "b"): 0.4, ("f", "t"): 0.35, ("t", "f"): 0.4, ("q", "g"): 0.35, ("g", "q"): 0.4, ("l", "i"): 0.4, ("i", "l"): 0.4, ("l", "t"): 0.45, ("t", "l"): 0.45, ("o", "c"): 0.45, ("u", "v"): 0.45, ("v", "u"): 0.45, ("n", "u"): 0.45, ("u", "n"): 0.45, ("y", "v"): 0.45, ("a", "o"): 0.45, ("o", "a"): 0.45,
    ("rn", "m"): 0.35, ("m", "rn"): 0.4, ("nn", "m"): 0.45, ("in", "m"): 0.45, ("vv", "w"): 0.35, ("w", "vv"): 0.45, ("ii", "u"): 0.35, ("ll", "u"): 0.45, ("u", "ii"): 0.45, ("ri", "n"): 0.35, ("n", "ri"): 0.4, ("cl", "d"): 0.35, ("d", "cl"): 0.35, ("li", "h"): 0.45, ("h", "li"): 0.45,
}
FARTHEST = 0.9

_lower = "a-zß-öø-ÿ"
_apart = "\\w@\u0300-\u036f\u00ad\u180e\u200b-\u200f\u2060-\u2064\ufeff"  # a token next to these is part of something else
_token = re.compile(f"(?<![{_apart}])(?!0x)(?:[A-ZÀ-ÖØ-Þ](?=[{_lower}0-9@]*[{_lower}])|(?=[{_lower}0-9@]*[{_lower}@]))[{_lower}0-9@]+(?![{_apart}])")
_rough = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ0-9@]{3,}")  # every token, and parts of other things
_cut = re.compile(f"([A-Za-zÀ-ÖØ-öø-ÿ0-9@]*[{_lower}A-Z@])(-|¬|\xad|‐)[ \t]*$")
_cut_somewhere = re.compile(f"[{_lower}A-Z@][-¬\xad‐][ \t]*(?:\n|$)")
_head = re.compile(f"[ \t\f]*([{_lower}0-9@]*[{_lower}@][{_lower}0-9@]*)(?![\\w@])")
_marked = re.compile("[0-9@]")  # what no word holds: a strong sign of a misreading
_MARKS = frozenset("-¬\xad‐")
_fence = re.compile(r"\s*(```|~~~)")
_structured = re.compile(r"\s*(#{1,6}\s|\||!\[|<!--|[-*_]{3,}\s*$)")

# ---- counts ---------------------------------------------------------------------------------------------------------

TOKEN, COMPOUND, PAIR, NEED = range(4)  # kinds of counted terms; NEED: looked up for a cut word, counted as none
_OTHER, _LOWER, _UPPER, _DIGIT, _AT, _WORD = range(6)


@lru_cache(1)
def _classes() -> np.ndarray:
    """The class of every character: those of _WORD part a token off."""
    out = np.zeros(0x110000, np.uint8)
    out[np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)] = _WORD
    for c in (0x5F, 0xAD, 0x180E, 0xFEFF, *range(0x300, 0x370), *range(0x200B, 0x2010), *range(0x2060, 0x2065)):
        out[c] = _WORD
    out[[*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = _LOWER
    out[[*range(0x41, 0x5B), *range(0xC0, 0xD7), *range(0xD8, 0xDF)]] = _UPPER
    out[0x30:0x3A] = _DIGIT
    out[0x40] = _AT
    return out


def _count(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct value stands first, and how often it comes."""
    _, first, n = np.unique(values, return_index=True, return_counts=True)
    return first, n


def count_terms(texts: list[str]) -> list[tuple[str, int, int]]:
    """(term, kind, n): the tokens in lower case, compounds ("a-b") and pairs of neighbouring lower-case tokens ("a b") of some texts.

    Tokens are those of the pattern `_token` (without a capital from two characters on); the halves of words that are
    cut at a line's end are none.
    """
    whole = "\n".join(texts) + "\n"
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _classes()[points]
    inside = kind != _OTHER
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return []

    def sums(mask: np.ndarray) -> np.ndarray:
        total = np.cumsum(mask, dtype=np.int32)
        return total[stops - 1] - total[starts] + mask[starts]

    length = stops - starts
    lower, other = sums(kind == _LOWER), sums((kind == _DIGIT) | (kind == _AT))
    capital = kind[starts] == _UPPER
    at = sums(kind == _AT) > 0
    hexed = (points[starts] == 0x30) & (points[np.minimum(starts + 1, len(points) - 1)] == 0x78)
    good = (lower + other + capital == length) & ((lower > 0) | (at & ~capital)) & (length > 1) & ~hexed
    # halves of cut words: a mark and nothing else up to the line's end, and the first part behind that
    mark = (points[stops] == 0x2D) | (points[stops] == 0xAC) | (points[stops] == 0x2010)
    lines = np.flatnonzero(points == 10)
    blank = (points == 32) | (points == 9) | (points == 10) | (points == 12)
    written_before = np.concatenate([[0], np.cumsum(~blank)])
    end = lines[np.searchsorted(lines, stops)]
    half = mark & (written_before[end] == written_before[stops + 1])
    right = np.concatenate([[False], half[:-1]]) & (written_before[starts] == written_before[np.concatenate([[0], end[:-1]])])
    good &= ~half & ~right
    starts, stops, capital, length, lower = starts[good], stops[good], capital[good], length[good], lower[good]
    if not len(starts):
        return []
    begin = np.cumsum(length) - length
    within = np.arange(int(length.sum())) - np.repeat(begin, length)
    letters = points[np.repeat(starts, length) + within].astype(np.uint64)
    letters[begin[capital]] += np.uint64(32)
    powers = np.cumprod(np.full(int(length.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    h = mix(np.add.reduceat((letters + np.uint64(1)) * powers[within], begin))
    out = [(whole[starts[i] : stops[i]].lower(), TOKEN, n) for i, n in zip(*map(np.ndarray.tolist, _count(h)))]
    small = np.flatnonzero(~capital)
    if len(small) > 1:
        a, b = small[:-1], small[1:]
        text = lambda i: whole[starts[i] : stops[i]]
        first, n = _count(mix(h[a] * np.uint64(3) + h[b]))
        out += [(f"{text(a[i])} {text(b[i])}", PAIR, k) for i, k in zip(first.tolist(), n.tolist())]
        plain = lower == length
        tied = np.flatnonzero((starts[b] == stops[a] + 1) & (points[stops[a]] == 0x2D) & plain[a] & plain[b])
        if len(tied):
            first, n = _count(mix(h[a[tied]] * np.uint64(5) + h[b[tied]]))
            out += [(f"{text(a[i])}-{text(b[i])}", COMPOUND, k) for i, k in zip(tied[first].tolist(), n.tolist())]
    return out


def cut_terms(text: str) -> set[str]:
    """What is looked up for the cut words of a text: the halves, the joined words and the compounds."""
    out: set[str] = set()
    if not _cut_somewhere.search(text):
        return out
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if m := _cut.search(line):
            left, seen, at = m[1].lower(), 0, i + 1
            while seen < BORDER and at < len(lines):
                if lines[at].strip(" \t\f"):
                    seen += 1
                    if h := _head.match(lines[at]):
                        out |= {left, h[1], left + h[1], f"{left}-{h[1]}"}
                at += 1
    return out


def term_counts(texts: DataFrame) -> DataFrame:
    """(term, kind, n) over texts(t)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 0):
                part = batch.column(0).to_pylist()
                rows = count_terms(part)
                needs: set[str] = set()
                needs.update(*map(cut_terms, part))
                rows += [(t, NEED, 0) for t in needs]
                if rows:
                    terms, kinds, n = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(kinds, pa.int8()), pa.array(n, pa.int64())], ["term", "kind", "n"])

    return texts.select("t").where("t is not null and t != ''").mapInArrow(run, "term string, kind tinyint, n bigint").groupBy("term", "kind").agg(F.sum("n").alias("n"))


# ---- candidates of distinct tokens ----------------------------------------------------------------------------------

_ALPHABETIC = [(a, b) for a, b in CONFUSIONS if not _marked.search(a)]
_SEEN_UNITS, _TRUE_UNITS = frozenset(a for a, _ in _ALPHABETIC), frozenset(b for _, b in _ALPHABETIC)
_CHEAPEST = min(CONFUSIONS[c] for c in _ALPHABETIC)
_BACK: dict[str, list[tuple[str, float]]] = defaultdict(list)
for (_a, _b), _c in CONFUSIONS.items():
    if _marked.search(_a):
        _BACK[_a].append((_b, _c))


def forms(word: str, units: frozenset[str], depth: int) -> set[str]:
    """The word with up to `depth` of its units replaced by holes."""
    at = [(i, i + n) for n in (1, 2) for i in range(len(word) - n + 1) if word[i : i + n] in units]
    out = {word}
    if depth:
        out |= {f"{word[:a]}_{word[b:]}" for a, b in at}
    if depth > 1:
        at.sort()
        out |= {f"{word[:a]}_{word[b:c]}_{word[d:]}" for (a, b), (c, d) in combinations(at, 2) if b <= c}
    return out


def seen_forms(token: str) -> set[str]:
    """The forms by which a token finds the words it may be a misreading of: those that are some confusions of at most FARTHEST away."""
    marked = _marked.findall(token)
    if len(token) < 3 or any(c not in _BACK for c in marked) or sum(min(c for _, c in _BACK[x]) for x in marked) > FARTHEST:
        return set()
    out: set[str] = set()
    for back in product(*(_BACK[c] for c in marked)):
        left = FARTHEST - sum(c for _, c in back) + 1e-9
        if left < 0:
            continue
        new = iter(back)
        depth = min(2, int(left / _CHEAPEST)) if len(token) > 4 else 1 - len(marked)
        if depth >= 0:
            out |= forms(_marked.sub(lambda _: next(new)[0], token), _SEEN_UNITS, depth)
    return out


def distance(seen: str, true: str) -> float:
    """Weighted edit distance from what was read to what stood there; confusion pairs are cheap."""
    n, m = len(seen), len(true)
    row: list[list[float]] = [[9.0] * (m + 1) for _ in range(n + 1)]
    row[0][0] = 0.0
    for i in range(n + 1):
        for j in range(m + 1):
            here = row[i][j]
            if here > FARTHEST:
                continue
            if i < n and j < m:
                cost = 0.0 if seen[i] == true[j] else CONFUSIONS.get((seen[i], true[j]), 1.0)
                row[i + 1][j + 1] = min(row[i + 1][j + 1], here + cost)
            if i < n:
                row[i + 1][j] = min(row[i + 1][j], here + 1)
            if j < m:
                row[i][j + 1] = min(row[i][j + 1], here + 1)
            for a, b in ((1, 2), (2, 1)):
                if i + a <= n and j + b <= m and (cost := CONFUSIONS.get((seen[i : i + a], true[j : j + b]))):
                    row[i + a][j + b] = min(row[i + a][j + b], here + cost)
    return row[n][m]


def _form_rows(words: DataFrame, seen: Shipped | None) -> DataFrame:
    """(form, term, n) of words(term, n); with the screen of the words' forms, those of tokens that pass it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = seen.value if seen else b""
        for whole in batches:
            for at in range(0, whole.num_rows, 5000):
                batch = whole.slice(at, 5000)
                made = [[f for f in seen_forms(t) if passes(bits, f)] if seen else list(forms(t, _TRUE_UNITS, 2)) for t in batch.column(0).to_pylist()]
                index = pa.array(np.repeat(np.arange(len(made)), [len(x) for x in made]))
                if len(index):
                    yield pa.RecordBatch.from_arrays([pa.array([f for x in made for f in x], pa.string()), batch.column(0).take(index), batch.column(1).take(index)], ["form", "term", "n"])

    return words.select("term", "n").mapInArrow(run, "form string, term string, n bigint")


def candidates(terms: DataFrame) -> DataFrame:
    """(term, words): for each distinct token that may be misread the words it may stand for, each (cost, n, word)."""
    counted = terms.where(f"kind in ({TOKEN}, {NEED})").groupBy("term").agg(F.max("n").alias("n"))
    letters = F.col("term").rlike(f"^[{_lower}]{{3,}}$")
    words = counted.where(letters & (F.col("n") >= RATIO))
    looked_up = counted.where(F.col("term").rlike(f"^[{_lower}0-9@]{{3,}}$"))
    b = written(_form_rows(words, None), "scan-forms").toDF("form", "word", "m")
    a = _form_rows(looked_up, screen(b, F.col("form")))
    met = a.join(b, "form").where((F.col("m") >= RATIO * F.greatest("n", F.lit(1))) & (F.col("term") != F.col("word"))).select("term", "word", "m").distinct()

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = [distance(t, w) for t, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(costs, pa.float64())], ["term", "word", "m", "cost"])

    priced = met.mapInArrow(price, "term string, word string, m bigint, cost double")
    near = priced.where((F.col("cost") <= FARTHEST) & ((F.col("cost") < 0.5) | (F.length("term") > 4)))
    return near.groupBy("term").agg(F.collect_list(F.struct("cost", F.col("m").alias("n"), "word")).alias("words"))  # words within a few confusions of a token


def contexts(near: DataFrame, terms: DataFrame) -> DataFrame:
    """(key, words): for each pair of neighbours one of which may be misread, how often its candidates stand beside the other one: (the pair's own count, n, word)."""
    pairs = terms.where(f"kind = {PAIR}").select(F.split_part("term", F.lit(" "), F.lit(1)).alias("a"), F.split_part("term", F.lit(" "), F.lit(2)).alias("b"), "n")
    one = near.select("term", F.explode("words.word").alias("word"))
    found = []
    for own, other in (("b", "a"), ("a", "b")):
        seen = pairs.join(one.withColumnRenamed("term", own), own).select(F.concat_ws(" ", "a", "b").alias("key"), other, F.col("word").alias(own), F.col("n").alias("was"))
        true = seen.join(pairs, ["a", "b"]).select("key", F.struct(F.col("was").cast("double").alias("cost"), "n", F.col(own).alias("word")).alias("w"), F.lit(own).alias("side"))
        found.append(true.groupBy("key", "side").agg(F.collect_list("w").alias("words")))
    return found[0].unionByName(found[1]).select(F.concat("side", F.lit(" "), "key").alias("key"), "words")


class Facts:
    """What pages look up: candidates of tokens, their contexts, counts for cut words; as a table, and in the tasks as dictionaries."""

    def __init__(self, total: int, rows: list[tuple[str, list]] = ()):
        self.usual = USUAL_SHARE * total
        self.near: dict[str, list[tuple[float, int, str]]] = {}
        self.words: dict[str, int] = {}
        self.context: dict[str, dict[str, tuple[float, int]]] = {}
        for key, words in rows:
            if key[0] == "=":
                self.words[key[1:]] = words[0][1]
            elif key[:2] in ("a ", "b "):
                self.context[key] = {w: (was, n) for was, n, w in words}
            else:
                self.near[key[1:]] = sorted(((c, n, w) for c, n, w in words), key=lambda c: (c[0] - 0.05 * log(c[1]), c[2]))

    def known(self, word: str) -> bool:
        return self.words.get(word, 0) >= KNOWN

    def beside(self, before: str, token: str, after: str) -> tuple[dict, dict]:
        """The contexts of a token: with what stands before it and with what stands behind it."""
        return self.context.get(f"b {before} {token}", {}), self.context.get(f"a {token} {after}", {})

    def correct(self, token: str, before: str = "", after: str = "", usual: bool = False) -> tuple[str, bool] | None:
        """What a misread token stands for, among usual words only if so asked, and whether a neighbour speaks for it; None where it isn't misread."""
        found = [c for c in self.near.get(token, ()) if not usual or c[1] >= self.usual]
        if not found:
            return None
        sides = self.beside(before, token, after)
        seen = lambda w: sum(side[w][1] for side in sides if w in side)
        best = min(found, key=lambda c: (c[0] - 0.05 * log(c[1]) - 0.1 * log(1 + seen(c[2])), c[2]))[2]
        return best, any(best in side and side[best][1] >= RATIO * max(1, side[best][0]) for side in sides)


class FactTable:
    """The facts of a corpus as a table (key, words) with the number of its tokens."""

    def __init__(self, texts: DataFrame):
        self.spark = texts.sparkSession
        terms = written(term_counts(texts), "scan-terms")
        near = written(candidates(terms), "scan-candidates")
        needed = terms.where(f"kind = {NEED}").select("term").join(terms.where(f"kind in ({TOKEN}, {COMPOUND})").select("term", "n"), "term")
        needed = needed.select(F.concat(F.lit("="), "term").alias("key"), F.array(F.struct(F.lit(0.0).alias("cost"), "n", F.lit("").alias("word"))).alias("words"))
        rows = near.select(F.concat(F.lit("~"), "term").alias("key"), "words").unionByName(contexts(near, terms)).unionByName(needed)
        self.rows = written(rows, "scan-facts")
        self.total = terms.where(f"kind = {TOKEN}").agg(F.sum("n")).collect()[0][0] or 0
        self.shipped = None
        kept = self.rows.limit(MAX_FACTS + 1).toArrow()  # bounded; used only where it is all
        if kept.num_rows <= MAX_FACTS:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, kept.schema) as w:
                w.write_table(kept)
            self.shipped = Shipped(self.spark, (self.total, sink.getvalue().to_pybytes()))

    def with_facts(self, df: DataFrame) -> DataFrame:
        """df(k, t) with the facts of each text, or with none where they travel with the tasks."""
        if self.shipped:
            return df.withColumn("facts", F.lit(None).cast("array<struct<key:string,words:array<struct<cost:double,n:bigint,word:string>>>>"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in slices(whole, 1):
                    for h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                        keys = list(keys_of(t or ""))
                        yield pa.RecordBatch.from_arrays([pa.array([h] * len(keys), pa.string()), pa.array(keys, pa.string())], ["h", "key"])

        named = df.withColumn("h", F.sha2("t", 256))
        asked = named.where("t is not null").select("h", "t").dropDuplicates(["h"]).mapInArrow(run, "h string, key string")
        got = asked.join(self.rows, "key").groupBy("h").agg(F.collect_list(F.struct("key", "words")).alias("facts"))  # bounded by the text itself
        return named.join(got, "h", "left").select("k", "t", F.coalesce("facts", F.array()).alias("facts"))


def neighbours(found: list[re.Match], k: int) -> tuple[str, str]:
    """The lower-case tokens before and after the k-th token of a line."""
    before = next((x[0] for x in reversed(found[:k]) if not x[0][0].isupper()), "")
    after = next((x[0] for x in found[k + 1 :] if not x[0][0].isupper()), "")
    return before, after


def keys_of(text: str) -> set[str]:
    """The keys of all facts that a text may look up."""
    cut = cut_terms(text)
    out = {f"={t}" for t in cut} | {f"~{t}" for t in cut}
    for line in text.split("\n"):
        found = list(_token.finditer(line))
        for k, m in enumerate(found):
            token, (before, after) = m[0].lower(), neighbours(found, k)
            out |= {f"~{token}", f"b {before} {token}", f"a {token} {after}"}
    return out


# ---- furniture ------------------------------------------------------------------------------------------------------

_SINGLE = str.maketrans({"c": "e", "0": "o", "1": "l", "i": "l", "5": "s", "@": "a", "h": "b", "6": "b", "t": "f", "q": "g", "2": "z"})
_number = re.compile(r"(?<![\w])\d+(?![\w])")
_dash = re.compile(r"[-–—] ?(\d+) ?[-–—]")
_slash = re.compile(r"[\[(]? ?(\d+) ?/ ?(\d+) ?[\])]?")
_paged = re.compile(r"(?:p[a@]g[ec]s?|seit[ec]|p[áa@]gin[a@]|p[áa]g\.?|p\.|s\.|f[o0]li[o0]) ?(\d+)(?: ?(?:[o0]f|v[o0]n|d[ec]|sur|/) ?\d+)?", re.IGNORECASE)
_bare = re.compile(r"\d{1,4}")
_roman = re.compile(r"[ivxl]{1,7}")
_ENDS = frozenset("0123456789-–—])ivxl")  # what the styles end with, but for numbers at the head
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50}
_leading = re.compile(r"(\d{1,4})(?: {2,}|\t)(\S.*)")
_trailing = re.compile(r"(\S.*?)(?: {2,}|\t)(\d{1,4}|[ivxl]{1,7})")


def fold(line: str) -> str:
    """The form in which misreadings and numbers of a line coincide."""
    return _number.sub("#", " ".join(line.split()).lower()).translate(_SINGLE)


def roman(text: str) -> int:
    out = 0
    for a, b in zip(text, text[1:] + " "):
        out += -_ROMAN[a] if b in _ROMAN and _ROMAN[b] > _ROMAN[a] else _ROMAN[a]
    return out


def _numbered(line: str) -> tuple[str, int, str] | None:
    """(style, number, other text) of a line that a page number can be."""
    if line[-1] not in _ENDS and not line[0].isdigit():
        return None
    for style, pattern in (("dash", _dash), ("slash", _slash), ("paged", _paged), ("bare", _bare)):
        if m := pattern.fullmatch(line):
            return style, int(m[1] if m.groups() else m[0]), ""
    if _roman.fullmatch(line):
        return "roman", roman(line), ""
    if m := _leading.fullmatch(line):
        return "leading", int(m[1]), fold(m[2])
    if m := _trailing.fullmatch(line):
        return "trailing", int(m[2]) if m[2].isdigit() else roman(m[2]), fold(m[1])
    return None


def _running(values: list[tuple[int, int]]) -> list[int]:
    """The longest run of (line, number) whose numbers rise by one, now and then two or three: indexes into values."""
    best: list[tuple[int, int]] = []  # length, index before
    last: dict[int, int] = {}
    for i, (_, v) in enumerate(values):
        before, length = -1, 0
        for step in (1, 2, 3):
            j = last.get(v - step)
            if j is not None and best[j][0] > length:
                before, length = j, best[j][0]
        best.append((length + 1, before))
        if v not in last or best[last[v]][0] <= length + 1:
            last[v] = i
    if not best:
        return []
    at = max(range(len(best)), key=lambda i: (best[i][0], -i))
    out = []
    while at >= 0:
        out.append(at)
        at = best[at][1]
    return out[::-1]


def furniture(lines: list[str], running: list[bool]) -> set[int]:
    """Numbers of the lines that are running headers, footers or page numbers. running: the lines that can be some."""
    flat = [line.replace("\f", "").strip() for line in lines]
    breaks = [i for i, line in enumerate(lines) if line.startswith("\f")]
    page_of = (lambda i: bisect_left(breaks, i + 1)) if breaks else None
    styles: dict[str, list[tuple[int, int]]] = defaultdict(list)
    numbered: dict[int, tuple[str, int, str]] = {}
    for i, line in enumerate(flat):
        if running[i] and line and (n := _numbered(line)):
            numbered[i] = n
            styles["bare" if n[0] == "roman" else n[0]].append((i, n[1]))
    edges = _edges(flat, breaks) if breaks else None
    found: set[int] = set()
    for style, values in styles.items():
        if style in ("dash", "slash", "paged"):
            chain = _running(values)
            if len(chain) > 1:
                found |= {i for i, _ in values}
        elif style == "bare":  # numbers alone, of either kind: numberings change from one to the other
            if edges is not None:
                values = [(i, v) for i, v in values if i in edges]
                offsets = Counter(v - page_of(i) for i, v in values)
                if offsets and (top := offsets.most_common(1)[0])[1] > 1:
                    found |= {i for i, v in values if v - page_of(i) == top[0]}
            else:
                found |= {i for i, _ in _steady(values)}
    # running lines: folded forms that come again
    groups: dict[str, list[int]] = defaultdict(list)
    for i, line in enumerate(flat):
        if not running[i] or not line or i in found:
            continue
        n = numbered.get(i)
        if n and n[2]:
            groups[n[2]].append(i)
        elif not n and len(line) < 120 and (line[0].isupper() or line[0].isdigit() or line[0] in "@(©") and line[-1] not in ".,;:!?-¬":
            groups[fold(line)].append(i)
    again = {k: v for k, v in groups.items() if len(v) > 1}
    accepted: set[str] = set()
    before = -1
    while len(accepted) != before:  # a header meets a footer: what is found supports its neighbours
        before = len(accepted)
        for key, at in again.items():
            if key in accepted:
                continue
            if edges is not None:
                near = sum(i in edges for i in at)
                ok = near > 1 and near >= 0.7 * len(at)
            else:
                near = sum(_meets(i, found, flat) for i in at)
                with_number = sum(i in numbered for i in at)
                middle = sum(_interrupts(i, flat) for i in at)
                ok = near >= max(1, 0.4 * len(at)) or with_number > 1 or middle == len(at) or (len(at) > 2 and (middle >= 0.5 * len(at) or _regular(at))) or _fits(at, found)
            if ok:
                accepted.add(key)
                found |= set(at)
    if not accepted and edges is None and not any(s in styles for s in ("dash", "slash", "paged")):
        return set()
    for key, at in groups.items():  # once only, but the same but for misread characters of other kinds
        if len(at) == 1 and accepted and (edges is None or at[0] in edges) and any(_alike(key, k) for k in accepted):
            found |= set(at)
    return found


def _steady(values: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of (line, number) whose numbers rise by one, now and then two, at a steady number of lines a page; three at least."""
    best: list[tuple[int, int]] = []
    by: dict[int, list[int]] = defaultdict(list)
    for line, v in values:
        by[v].append(line)
    tried = set()
    for line, v in values:
        for after in by.get(v + 1, ()):
            page = after - line
            if not 9 < page < 200 or (line, page) in tried:
                continue
            chain = [(line, v)]
            while True:
                at, n = chain[-1]
                step = next(((x, n + k) for k in (1, 2) for x in sorted(by.get(n + k, ()), key=lambda x: abs(x - at - k * page)) if abs(x - at - k * page) <= max(2, 0.15 * k * page)), None)
                if step is None:
                    break
                chain.append(step)
                tried.add((step[0], page))
            if len(chain) > max(2, len(best)):
                best = chain
    return best


def _edges(flat: list[str], breaks: list[int]) -> set[int]:
    """The first three and the last three written lines of every page."""
    out: set[int] = set()
    for start, end in zip([0, *breaks], [*breaks, len(flat)]):
        full = [i for i in range(start, end) if flat[i]]
        out |= {*full[:3], *full[-3:]}
    return out


def _meets(i: int, found: set[int], flat: list[str]) -> bool:
    return i == 0 or i - 1 in found or i + 1 in found


def _interrupts(i: int, flat: list[str]) -> bool:
    """Whether a line stands in the middle of others, without blank lines around it."""
    return i == 0 or bool(i + 1 < len(flat) and flat[i - 1] and flat[i + 1])


def _regular(at: list[int]) -> bool:
    """Whether lines come again at about the same distance or multiples of it."""
    gaps = [b - a for a, b in zip(at, at[1:])]
    page = min(gaps)
    return page > 9 and all(abs(g - page * round(g / page)) <= max(3, 0.12 * g) for g in gaps)


def _fits(at: list[int], found: set[int]) -> bool:
    """Whether the distances between lines are those between furniture found already."""
    known = sorted(found)
    gaps = {b - a for a, b in zip(known, known[1:]) if b - a > 9}
    return bool(gaps) and all(any(abs((b - a) - n * g) <= 2 * n for g in gaps for n in (1, 2)) for a, b in zip(at, at[1:]))


def _alike(a: str, b: str) -> bool:
    """Whether two folded lines differ in few characters only."""
    if abs(len(a) - len(b)) > 2 or len(a) < 8:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return max(len(a), len(b)) - i - j <= 3


# ---- a whole text ---------------------------------------------------------------------------------------------------


class Page:
    """The findings of one text: kind by line, corrections by position, joints of cut words."""

    def __init__(self, text: str, facts: Facts):
        self.lines = lines = text.split("\n")
        self.running = running = []
        plain = []  # what a page border may lie in: code, too
        fenced = False
        for line in lines:
            mark = bool(_fence.match(line))
            fenced ^= mark
            plain.append(not mark and not _structured.match(line.replace("\f", "")))
            running.append(plain[-1] and not fenced)
        self.furniture = furniture(lines, plain)
        self.hyphen: dict[int, int] = {}  # line -> the line that goes on
        self.fixes: dict[int, list[tuple[int, int, str]]] = defaultdict(list)
        self.certain: set[tuple[int, int]] = set()  # fixes (line, start) that stand for themselves
        self._cuts(facts)
        self._words(text, facts)
        marked = any(_marked.search(lines[i][start:end]) for i, fixes in self.fixes.items() for start, end, _ in fixes)
        if not (self.hyphen or marked or self.furniture and ("\f" in text or self._numbers_run())):  # no sign of scanning
            kept = {i: [f for f in fixes if (i, f[0]) in self.certain] for i, fixes in self.fixes.items()}
            self.fixes = defaultdict(list, {i: fixes for i, fixes in kept.items() if fixes})
            self.furniture = set()

    def _numbers_run(self) -> bool:
        """Whether two lines of furniture are page numbers of one style that follow one another."""
        styles: dict[tuple[str, str], list[tuple[int, int]]] = defaultdict(list)
        for i in sorted(self.furniture):
            if n := _numbered(self.lines[i].replace("\f", "").strip()):
                styles["bare" if n[0] == "roman" else n[0], n[2]].append((i, n[1]))
        return any(len(_running(values)) > 1 for values in styles.values())

    def _following(self, i: int) -> int | None:
        """The line that goes on after line i: the next written one, over furniture and, behind that, blank lines."""
        over = False
        for j in range(i + 1, len(self.lines)):
            if j in self.furniture:
                over = True
            elif self.lines[j].strip(" \t\f"):
                return j if self.running[j] else None
            elif not over and j + 1 not in self.furniture:
                return None
        return None

    def _cuts(self, facts: Facts) -> None:
        self.parts: dict[int, set[str]] = defaultdict(set)
        for i, line in enumerate(self.lines):
            if line.rstrip(" \t")[-1:] not in _MARKS or not self.running[i] or i in self.furniture or not (m := _cut.search(line)):
                continue
            j = self._following(i)
            h = _head.match(self.lines[j]) if j is not None else None
            if not (h and facts.known((m[1] + h[1]).lower())):  # lines that part a known word are furniture
                near = range(i + 2, min(len(self.lines), i + 2 + PARTED))
                k = next((k for k in near if self.running[k] and (g := _head.match(self.lines[k])) and facts.known((m[1] + g[1]).lower())), None)
                if k is not None and all(0 < len(self.lines[x].strip()) < 100 and self.lines[x].strip()[-1] not in ".,;" for x in range(i + 1, k) if x not in self.furniture):
                    self.furniture.update(range(i + 1, k))
                    j, h = k, _head.match(self.lines[k])
            if not h:
                continue
            left, right, mark = m[1], h[1], m[2]
            joined = (left + right).lower()
            whole, compound = facts.words.get(joined, 0), facts.words.get(f"{left.lower()}-{right}", 0)
            if mark != "-" or whole > compound:
                cut = True
            elif compound:
                cut = False
            else:
                cut = joined in facts.near or not (facts.known(left.lower()) and facts.known(right))
            if cut:
                self.hyphen[i] = j
                self.parts[i].add("end")
                self.parts[j].add("start")
                if left[0].islower() or left[0] in "@0125":
                    if not facts.known(joined) and (true := facts.correct(joined)):
                        self._place(i, m.start(1), j, h.start(1), left, right, true[0])

    def _place(self, i: int, at: int, j: int, head: int, left: str, right: str, true: str) -> None:
        """Note the correction of a cut word in the line or lines whose part is misread."""
        best = min(range(len(true) + 1), key=lambda k: distance(left, true[:k]) + distance(right, true[k:]))
        if left != true[:best]:
            self.fixes[i].append((at, at + len(left), true[:best]))
        if right != true[best:]:
            self.fixes[j].append((head, head + len(right), true[best:]))

    def _words(self, text: str, facts: Facts) -> None:
        doubtful = {t for t in set(_rough.findall(text)) if t.lower() in facts.near}
        if not doubtful:
            return
        anywhere = re.compile("|".join(map(re.escape, sorted(doubtful))))
        for i, line in enumerate(self.lines):
            if not self.running[i] or i in self.furniture or not anywhere.search(line):
                continue
            found = list(_token.finditer(line))
            for k, m in enumerate(found):
                token = m[0].lower()
                if m[0] not in doubtful:
                    continue
                if (k == 0 and "start" in self.parts.get(i, ()) and not line[: m.start()].strip(" \t\f")) or (k == len(found) - 1 and "end" in self.parts.get(i, ()) and not line[m.end() :].strip(" \t-¬\xad‐")):
                    continue
                capital, marked = m[0] != token, bool(_marked.search(token))
                if true := facts.correct(token, *neighbours(found, k), capital and not marked):
                    self.fixes[i].append((m.start(), m.end(), true[0].capitalize() if capital else true[0]))
                    if marked or true[1]:
                        self.certain.add((i, m.start()))

    def cases(self) -> list[tuple[int, str]]:
        return sorted([(i, "furniture") for i in self.furniture] + [(i, "hyphen") for i in self.hyphen] + [(i, "ocr") for i in self.fixes])

    def repaired(self) -> str:
        """Continuous paragraphs: without furniture, cut words joined, misread words corrected, wrapped lines joined."""
        lines = list(self.lines)
        for i, fixes in self.fixes.items():
            for start, end, true in sorted(fixes, reverse=True):
                lines[i] = lines[i][:start] + true + lines[i][end:]
        if not self.hyphen and not self.fixes and not self.furniture:
            return "\n".join(lines)
        out: list[str] = []
        open_ = glue = bridge = False  # open_: a running line that can go on; bridge: furniture lay in between
        for i, line in enumerate(lines):
            if i in self.furniture:
                bridge = True
                continue
            body = line.strip(" \t\f")
            if not self.running[i] or not body:
                if not body and bridge and (glue or open_ and out and out[-1][-1:] not in ".!?:"):
                    continue
                out.append(line.replace("\f", "").rstrip() if body else "")
                open_ = glue = bridge = False
                continue
            if glue:
                out[-1] += body
            elif open_ and not re.match(r"[-*] |\d+[.)] ", body):
                out[-1] += " " + body
            else:
                out.append(body)
            open_, glue, bridge = True, i in self.hyphen, False
            if glue:
                out[-1] = out[-1].rstrip()[:-1]
        return "\n".join(out)


_held: dict[int, Facts] = {}


def _shipped_facts(shipped: Shipped) -> Facts:
    """The facts as dictionaries, made once a worker."""
    if shipped.id not in _held:
        total, table = shipped.value
        _held.clear()
        _held[shipped.id] = Facts(total, _rows(pa.ipc.open_stream(table).read_all()))
    return _held[shipped.id]


def _rows(table: pa.Table | pa.StructArray) -> Iterator[tuple[str, list[tuple[float, int, str]]]]:
    """(key, words) of facts as Arrow."""
    if isinstance(table, pa.Table):
        table = table.combine_chunks().to_struct_array().combine_chunks() if table.num_rows else pa.array([], pa.struct(table.schema))
    words = table.field("words")
    ends = words.offsets.to_pylist()
    cost, n, word = (words.values.field(x).to_pylist() for x in ("cost", "n", "word"))
    for key, a, b in zip(table.field("key").to_pylist(), ends, ends[1:]):
        yield key, list(zip(cost[a:b], n[a:b], word[a:b]))


def _pages(df: DataFrame, table: FactTable, make, schema: str) -> DataFrame:
    """make(keys, pages) -> record batch over the pages of df(k, t)."""
    shipped, total = table.shipped, table.total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                if shipped:
                    facts = [_shipped_facts(shipped)] * batch.num_rows
                else:
                    facts = [Facts(total, [(x["key"], [(w["cost"], w["n"], w["word"]) for w in x["words"]]) for x in own or ()]) for own in batch.column(2).to_pylist()]
                out = make(batch.column(0), [t and Page(t, f) for t, f in zip(batch.column(1).to_pylist(), facts)])
                if out is not None:
                    yield out

    return table.with_facts(df).mapInArrow(run, schema)


def scan_cases(df: DataFrame, field: str, key_col: str, text_col: str, table: FactTable) -> DataFrame:
    """(field, rec_key, line_no, kind) of every case."""

    def make(keys: pa.Array, pages: list[Page]) -> pa.RecordBatch | None:
        found = [p.cases() for p in pages]
        cases = [c for f in found for c in f]
        if not cases:
            return None
        number, kind = zip(*cases)
        index = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
        return pa.RecordBatch.from_arrays([keys.take(index), pa.array(number, pa.int64()), pa.array(kind)], ["rec_key", "line_no", "kind"])

    source = df.select(F.col(key_col).cast("string").alias("k"), F.col(text_col).alias("t")).where("k is not null and t is not null and t != ''")
    out = _pages(source, table, make, "rec_key string, line_no bigint, kind string")
    return out.select(F.lit(field).alias("field"), "rec_key", "line_no", "kind")


def repaired_column(df: DataFrame, key_col: str, text_col: str, table: FactTable, out_col: str = "repaired") -> DataFrame:
    """(key, repaired text) of every row."""
    kind = df.schema[key_col].dataType.simpleString()

    def make(keys: pa.Array, pages: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([keys, pa.array([p.repaired() if p else p for p in pages], pa.string())], ["a", "b"])

    return _pages(df.select(F.col(key_col).alias("k"), F.col(text_col).alias("t")), table, make, f"a {kind}, b string").toDF(key_col, out_col)
