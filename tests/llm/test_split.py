"""Pieces of oversized sections: limits, overlap, natural cuts, and the sections against a plain recount."""

import hashlib
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foliate.llm import split
from foliate.llm.queries import p3_found, p3_pieces

WORDS = "clock reset fuse lane bridge timer packet mask offset field".split()


def body_of(rng, n):
    out = []
    for _ in range(n):
        kind = rng.randrange(7)
        text = " ".join(rng.choice(WORDS) for _ in range(rng.randrange(3, 60)))
        out += {0: ["## " + text[:40], ""], 1: [text + ". " + text + ".", ""], 2: ["| a | " + text + " |"], 3: ["- " + text], 4: ["x" * rng.randrange(20000)], 5: [(text + ". ") * 40], 6: ["```", "# " + text, "```", ""]}[kind]
    return "\n".join(out)


@settings(max_examples=120, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 120))
def test_limits_cover_and_overlap(seed, n):
    body = body_of(random.Random(seed), n)
    s = split.Splitter(body)
    a, b = 0, len(s.lines)
    if s.tokens(a, b) <= split.LIMIT:
        return
    pieces = list(s.pieces(a, b))
    assert len(pieces) > 1
    offset = lambda line, char: sum(len(x) + 1 for x in s.lines[:line]) + char
    end = 0
    for i, p in enumerate(pieces):
        text = s.text(p)
        counted = sum(split.tokens_of(x) for x in text.split("\n"))
        assert counted <= p[4] <= split.LIMIT
        begin = offset(p[0], p[1])
        assert body[begin : begin + len(text)] == text
        if i:
            shared = sum(split.tokens_of(x) for x in body[begin:end].split("\n"))
            assert begin < end and 40 <= shared <= 160
        else:
            assert begin == 0
        assert begin + len(text) > end
        end = offset(p[2], p[3])
    assert end == len(body)


def test_cuts_are_at_the_deepest_weighted_valley():
    """Every cut against a plain search of its window; where the topic changes in the middle of plain lines, the cut is there."""
    rng = random.Random(2)
    topics = [[f"{t}{i}" for i in range(12)] for t in ("clock", "fuse", "lane", "bridge", "packet")]
    lines = [" ".join(rng.choices(topic, k=9)) for topic in topics for _ in range(46)]
    s = split.Splitter("\n".join(lines))
    pieces = list(s.pieces(0, len(lines)))
    cuts = [p[2] + 1 for p in pieces[:-1]]
    assert {c for c in cuts if c % 46 == 0} == {46, 92, 138, 184} & set(cuts) and sum(c % 46 == 0 for c in cuts) >= 3
    for seed in range(20):
        s = split.Splitter(body_of(random.Random(seed), 90))
        first, shared = 0, 0
        pieces = list(s.pieces(0, len(s.lines)))
        for p, after in zip(pieces, pieces[1:]):
            room = split.LIMIT - shared
            window = [g for g in range(first + 1, len(s._units)) if s._size[g] - s._size[first] <= room]
            window = [g for g in window if s._size[g] - s._size[first] > room // 2] or window[-1:]
            natural = [g for g in window if s._units[g][4] > split.WORDS] or window
            cut = next(g for g in window if (s._units[g - 1][0], s._units[g - 1][2]) == (p[2], p[3]))
            worth = lambda g: s._depth[g] * split.WEIGHT[s._units[g][4]]
            assert cut in natural and worth(cut) >= max(map(worth, natural)) - 1e-12
            first, shared = cut, after[6]


def test_deepest_valley_is_chosen():
    talk = lambda words, n: [" ".join(random.Random(i).choices(words, k=12)) for i in range(n)]
    lines = talk(["clock", "reset", "phase"], 50) + talk(["invoice", "ledger", "payment"], 60)
    s = split.Splitter("\n".join(lines))
    second = list(s.pieces(0, len(lines)))[1]
    assert second[5] == "line"
    depth = split.depths(lines, split.units_of(lines))
    assert int(depth[10:90].argmax()) + 10 == 50


def test_cohesion_against_plain_version():
    rng = random.Random(3)
    lines = [" ".join(rng.choices(WORDS, k=rng.randrange(20))) for _ in range(60)]
    units = split.units_of(lines)
    got = split.depths(lines, units)
    from collections import Counter
    from math import sqrt

    def bag(a, b):
        return Counter(w for line in lines[a:b] for w in line.split() if len(w) > 2)

    size = [0]
    for u in units:
        size.append(size[-1] + u[3])
    cos = []
    for g in range(len(units)):
        lo = next(i for i in range(len(size)) if size[i] >= size[g] - split.BLOCK)
        hi = next((i for i in range(len(size)) if size[i] >= size[g] + split.BLOCK), len(units))
        x, y = bag(lo, g), bag(g, min(hi, len(units)))
        norm = sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
        cos.append(sum(x[w] * y[w] for w in x) / norm if norm else 0)
    for g in range(1, len(units)):
        i, j = g, g
        while i - 1 >= 1 and cos[i - 1] >= cos[i] - 1e-6:
            i -= 1
        while j + 1 < len(units) and cos[j + 1] >= cos[j] - 1e-6:
            j += 1
        assert got[g] == pytest.approx(cos[i] + cos[j] - 2 * cos[g], abs=1e-4)


def recount(structure, bodies):
    by = {}
    for d, b in bodies:
        if d is not None and b is not None:
            by[d, hashlib.sha256(b.encode()).hexdigest()] = b.split("\n")
    out = []
    for sid, d, sha, outline in structure:
        lines = by.get((d, (sha or "").strip().lower().removeprefix("sha256:")))
        try:
            tree = json.loads(outline or "null")
        except ValueError:
            continue

        def walk(nodes, above):
            while isinstance(nodes, str):
                nodes = json.loads(nodes)
            for i, n in enumerate([nodes] if isinstance(nodes, dict) else nodes or [], 1):
                if isinstance(n, dict):
                    path = f"{above}.{i}" if above else str(i)
                    if lines and isinstance(n.get("line_span"), list):
                        a, b = n["line_span"]
                        if sum((len(x) + 3) // 4 for x in lines[a:b]) > 1200:
                            out.append((sid, path))
                    walk(n.get("children"), path)

        walk(tree, "")
    return sorted(out)


def test_query_against_recount(spark, data):
    got = sorted((r.structure_id, r.node_path) for r in p3_found(spark, data).collect())
    structure = spark.read.parquet(f"{data}/structure.parquet").select("structure_id", "doc_id", "markdown_sha256", "outline").collect()
    assert got == recount(structure, spark.read.parquet(f"{data}/document_md.parquet").select("doc_id", "body_md").collect()) and got
    assert max(r.n_tokens for r in p3_pieces(spark, data).select("n_tokens").collect()) <= 1200


def test_dirty_rows(spark):
    body = "\n".join(["word " * 100] * 20)
    sha = hashlib.sha256(body.encode()).hexdigest()
    spans = lambda x: json.dumps([{"line_span": x}])
    rows = [(1, "d", "SHA256:" + sha.upper(), spans([0, 99])), (2, "d", sha, spans([0, 99])), (3, "d", "0" * 64, spans([0, 99])), (4, "d", None, spans([0, 9])), (5, None, sha, spans([0, 9])), (6, "d", sha, None), (7, "d", sha, "[{"), (8, "d", sha, spans([3, 4])), (9, "d", sha, spans("x")), (10, "d", sha, spans(None)), (11, "d", sha, spans([9, 2]))]
    structure = spark.createDataFrame([(*r, "x") for r in rows], "structure_id long, doc_id string, markdown_sha256 string, outline string, body_md string")
    bodies = spark.createDataFrame([("d", body), ("d", body), ("d", None), (None, body)], "doc_id string, body_md string")
    got = split.split_sections(structure, bodies).collect()
    assert {r.structure_id for r in got} == {1, 2}
    assert len(got) == len({(r.structure_id, r.node_path, r.piece_no) for r in got})
    assert split.split_sections(structure.limit(0), bodies).count() == 0


def test_a_structure_row_that_comes_very_often(spark):
    body = "\n".join(f"line {i} " + "word " * 60 for i in range(40))
    sha = hashlib.sha256(body.encode()).hexdigest()
    one = '[{"line_span": [0, 40]}]'
    rows = [(i, "hot", sha, one) for i in range(600)] + [(1000 + i, "hot", sha, '[{"line_span": [0, 39]}]') for i in range(3)] + [(2000 + i, f"d{i}", sha, one) for i in range(20)]
    structure = spark.createDataFrame(rows, "structure_id long, doc_id string, markdown_sha256 string, outline string")
    bodies = spark.createDataFrame([("hot", body)] * 50 + [(f"d{i}", body) for i in range(20)], "doc_id string, body_md string")
    got = split.split_sections(structure, bodies, with_text=False).groupBy("structure_id").count().collect()
    assert len(got) == 623 and {r["count"] for r in got} == {len(list(split.Splitter(body).pieces(0, 40)))}
