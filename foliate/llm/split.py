"""Splitting oversized sections at natural boundaries: lexical-cohesion segmentation with overlap.

A text becomes *units*: lines; lines above MAX_UNIT tokens become sentences, and sentences above it runs of words (or,
where there is no blank, of characters). Each unit knows how natural a cut before it is: a heading, the first line of a
paragraph, another line (row, list item), a sentence, words.

Cohesion at a gap is the cosine of the word counts of the blocks of about BLOCK tokens on either side of it, computed
for all gaps of a text at once from running sums; a gap's *depth* is how far its cohesion lies below the nearest peaks
to the left and right. A piece ends in the second half of its size window at the deepest valley; how natural a gap is
weighs its depth (WEIGHT), and gaps within sentences count only where the window has no other. Of equals the more
natural, then the later one is taken. The next piece begins about OVERLAP tokens before the cut, at a unit's start if one
is near enough, else between words.

Tokens of a line are (characters + 3) div 4, without its newline. A piece never exceeds the limit.

Defined results: null ids or bodies, sections without a usable line_span or within the limit, and structure rows whose
hash isn't that of the body give nothing; lines beyond the body's end don't count; a single line, sentence or word of
any length is cut; repeated body rows count once; repeated structure rows have ids of their own and count each.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.operators import nested
from foliate.operators.ledger import hash_key
from foliate.session import written

LIMIT, OVERLAP, BLOCK, MAX_UNIT = 1200, 100, 150, 120
HEADING, PARAGRAPH, LINE, SENTENCE, WORDS = 4, 3, 2, 1, 0
WEIGHT = (1.0, 0.9, 1.0, 1.1, 1.25)  # of a gap's depth, by kind
KINDS = ["words", "sentence", "line", "paragraph", "heading"]

_heading = re.compile(r"\s{0,3}#{1,6}\s")
_fence = re.compile(r"\s{0,3}(```|~~~)")
_sentence = re.compile(r"(?<=[.!?;:。！？])\s+")
_word = re.compile(r"[^\W_]{3,}")


def tokens_of(text: str) -> int:
    return (len(text) + 3) >> 2


def units_of(lines: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(line, first character, end, tokens, kind of the gap before) of every unit."""
    out = []
    fenced, blank = False, True
    for n, line in enumerate(lines):
        if _fence.match(line):
            kind, fenced = PARAGRAPH if blank and not fenced else LINE, not fenced
        elif not fenced and _heading.match(line):
            kind = HEADING
        else:
            kind = PARAGRAPH if blank and not fenced and line.strip() else LINE
        blank = not line.strip()
        if tokens_of(line) <= MAX_UNIT:
            out.append((n, 0, len(line), tokens_of(line), kind))
            continue
        cuts = [0, *(m.end() for m in _sentence.finditer(line)), len(line)]
        for start, end in zip(cuts, cuts[1:]):
            at = start
            while at < end:
                to = end
                if end - at > 4 * MAX_UNIT:
                    to = line.rfind(" ", at + 2 * MAX_UNIT, at + 4 * MAX_UNIT) + 1 or at + 4 * MAX_UNIT
                out.append((n, at, to, tokens_of(line[at:to]), (kind if not at else SENTENCE) if at == start else WORDS))
                at = to
    return out


def depths(lines: list[str], units: list[tuple[int, int, int, int, int]]) -> np.ndarray:
    """How deep the valley of lexical cohesion before each unit is."""
    n = len(units)
    ids: dict[str, int] = {}
    rows, columns = [], []
    for i, (line, a, b, _, _) in enumerate(units):
        for w in _word.findall(lines[line][a:b].lower()):
            rows.append(i)
            columns.append(ids.setdefault(w, len(ids)))
    if not ids or n < 3:
        return np.zeros(n)
    size = np.cumsum([0] + [u[3] for u in units])
    left = np.maximum(np.searchsorted(size, size[:-1] - BLOCK, "left"), 0)
    right = np.minimum(np.searchsorted(size, size[:-1] + BLOCK, "left"), n)
    cosine = np.zeros(n)
    rows, columns = np.asarray(rows), np.asarray(columns)
    step = max(1, (1 << 20) // (len(ids) + 1))  # gaps at once, so that memory doesn't grow with units times words
    for first in range(0, n, step):
        last = min(n, first + step)
        low, high = int(left[first]), int(right[last - 1])
        here = (rows >= low) & (rows < high)
        own, columns_here = np.unique(columns[here], return_inverse=True)
        bags = np.zeros((high - low + 1, max(1, len(own))), np.float32)
        np.add.at(bags, (rows[here] - low + 1, columns_here), 1)
        np.cumsum(bags, axis=0, out=bags)
        gaps = np.arange(first, last)
        before, after = bags[gaps - low] - bags[left[gaps] - low], bags[right[gaps] - low] - bags[gaps - low]
        norm = np.sqrt((before**2).sum(1) * (after**2).sum(1))
        cosine[first:last] = (before * after).sum(1) / np.maximum(norm, 1e-9)
    values, out = cosine.tolist(), np.zeros(n)
    peak_left, peak_right = values[:], values[:]
    for i in range(2, n):  # the peak reached by climbing away from the gap
        if values[i - 1] >= values[i]:
            peak_left[i] = peak_left[i - 1]
    for i in range(n - 2, 0, -1):
        if values[i + 1] >= values[i]:
            peak_right[i] = peak_right[i + 1]
    out[1:] = np.asarray(peak_left[1:]) + np.asarray(peak_right[1:]) - 2 * cosine[1:]
    return out


class Splitter:
    """The units of one body with their cohesion, computed once and used for all its sections."""

    def __init__(self, body: str):
        self.lines = body.split("\n")
        sizes = [tokens_of(x) for x in self.lines]
        self.before = np.concatenate([[0], np.cumsum(sizes)])
        self._units = None

    def tokens(self, a: int, b: int) -> int:
        """Tokens of the lines a to b - 1."""
        a, b = max(0, min(a, len(self.lines))), max(0, min(b, len(self.lines)))
        return int(self.before[b] - self.before[a]) if a < b else 0

    def pieces(self, a: int, b: int, limit: int = LIMIT, overlap: int = OVERLAP):
        """Pieces of the lines a to b - 1: (first line, first character, last line, end character, tokens, kind of the cut before, overlapping tokens)."""
        if self._units is None:
            self._units = units_of(self.lines)
            self._depth = depths(self.lines, self._units)
            self._size = np.concatenate([[0], np.cumsum([u[3] for u in self._units])]).tolist()
            self._starts = [u[0] for u in self._units]
        units, size, depth = self._units, self._size, self._depth
        first, end = bisect_right(self._starts, max(0, a) - 1), bisect_right(self._starts, b - 1)
        start, kind, shared = (units[first][0], units[first][1]), KINDS[units[first][4]], 0
        while first < end:
            room = limit - shared
            if size[end] - size[first] <= room:
                cut = end
            else:
                last = bisect_right(size, size[first] + room) - 1  # the farthest cut that keeps the limit
                half = max(first + 1, min(last, bisect_right(size, size[first] + room // 2)))
                cut = max(range(half, last + 1), key=lambda g: (units[g][4] > WORDS, depth[g] * WEIGHT[units[g][4]], units[g][4], g))
            yield (*start, units[cut - 1][0], units[cut - 1][2], shared + size[cut] - size[first], kind, shared)
            if cut == end:
                return
            back = cut  # go back by whole units as long as that stays near the overlap
            while back > first and size[cut] - size[back - 1] <= overlap * 3 // 2 and size[cut] - size[back] < overlap:
                back -= 1
            shared = size[cut] - size[back]
            start = units[back][:2]
            if shared < overlap // 2:  # the unit before is long: begin inside it
                line, u, v = units[back - 1][:3]
                want = max(u, v - 4 * (overlap - shared))
                at = self.lines[line].find(" ", want, v) + 1 or want
                start, shared = (line, at), shared + tokens_of(self.lines[line][at:v])
            first, kind = cut, KINDS[units[cut][4]]

    def text(self, piece) -> str:
        l0, c0, l1, c1 = piece[:4]
        if l0 == l1:
            return self.lines[l0][c0:c1]
        return "\n".join([self.lines[l0][c0:], *self.lines[l0 + 1 : l1], self.lines[l1][:c1]])


def _span(value) -> tuple[int, int] | None:
    """line_span as two numbers; None where it isn't that."""
    if isinstance(value, str):
        value = nested.parse_json(value)
    if not isinstance(value, list) or len(value) != 2:
        return None
    try:
        a, b = (int(x) for x in value)
    except (TypeError, ValueError):
        return None
    return (a, b) if a < b else None


def section_spans(structure: DataFrame) -> DataFrame:
    """(structure_id, doc_id, sha, work, spans): the sections of each current outline; the outline itself goes no further.

    work names what is to be split: rows of one document, hash and set of sections have the same.
    """
    spec = nested.TreeSpec(kinds={"children": "section"}, leaves={"children": ("line_span",)})
    item = pa.struct([("path", pa.string()), ("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                spans: list[list] = [[] for _ in range(batch.num_rows)]
                for _, records, paths, _, leaves in nested.assemble(nested.shred(batch.column(3).to_pylist(), spec), spec):
                    for r, path, value in zip(records.tolist(), paths, leaves["line_span"][1]):
                        if span := _span(value):
                            spans[r].append({"path": path, "a": span[0], "b": span[1]})
                keys = [hashlib.sha1(f"{d}\n{h}\n{s}".encode()).hexdigest() for d, h, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), spans)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(keys), pa.array(spans, pa.list_(item))], ["structure_id", "doc_id", "sha", "work", "spans"])

    rows = structure.select("structure_id", "doc_id", hash_key(F.col("markdown_sha256")).alias("sha"), "outline")
    rows = rows.where("doc_id is not null and sha is not null and outline is not null")
    return rows.mapInArrow(run, "structure_id bigint, doc_id string, sha string, work string, spans array<struct<path:string,a:bigint,b:bigint>>").where("size(spans) > 0")


def split_sections(structure: DataFrame, bodies: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True) -> DataFrame:
    """Pieces of every section above the limit: one row per structure row, section and piece (numbered from 1).

    Bodies that can't reach the limit as a whole are left out before the shuffle; each other body is shuffled once, by
    document and hash. Structure rows that ask for the same sections of the same body are one piece of work, joined
    back to their ids at the end: so neither a document of many versions nor a structure row that comes a million times
    is one task's work.
    """
    body = bodies.select("doc_id", F.sha2(F.col("body_md"), 256).alias("sha"), "body_md")
    newlines = F.length("body_md") - F.length(F.regexp_replace("body_md", "\n", "")) + 1
    body = body.where(F.col("doc_id").isNotNull() & (F.length("body_md") + 2 * newlines + 1 > 4 * limit)).dropDuplicates(["doc_id", "sha"])
    asked = written(section_spans(structure), "split-spans")
    joined = asked.drop("structure_id").dropDuplicates(["work"]).join(body, ["doc_id", "sha"]).select("work", "spans", "body_md")
    names = ["work", "node_path", "piece_no", "first_line", "first_char", "last_line", "end_char", "n_tokens", "cut", "overlap_tokens", "text"]
    types = [pa.string(), pa.string(), *[pa.int64()] * 6, pa.string(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for work, spans, body in zip(*(batch.column(i) for i in range(3))):
                split = Splitter(body.as_py())
                for s in spans.as_py():
                    if split.tokens(s["a"], s["b"]) <= limit:
                        continue
                    for n, p in enumerate(split.pieces(s["a"], s["b"], limit, overlap), 1):
                        out.append((work.as_py(), s["path"], n, *p, split.text(p) if with_text else None))
                if len(out) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    schema = "work string, node_path string, piece_no bigint, first_line bigint, first_char bigint, last_line bigint, end_char bigint, n_tokens bigint, cut string, overlap_tokens bigint, text string"
    pieces = joined.mapInArrow(run, schema)
    return asked.select("structure_id", "work").join(pieces, "work").drop("work")
