"""Near-duplicates: sets and signatures against plain versions, pairs and groups against all pairs."""

import re
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from foliate.llm import neardup
from foliate.llm.queries import p2_found, p2_groups

WORD = re.compile(r"[^\W_]+")


def plain_set(text, k):
    w = WORD.findall(text.lower())
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def all_pairs(rows, k, threshold):
    """Brute force over an index of elements."""
    sets = defaultdict(set)
    for i, t in rows:
        if i is not None and t is not None and (s := plain_set(t, k)):
            sets[s].add(i)
    index = defaultdict(list)
    for s in sets:
        for e in s:
            index[e].append(s)
    out = set()
    for s, ids in sets.items():
        near = {t for e in s for t in index[e]}
        for t in near:
            if len(s & t) / len(s | t) >= threshold:
                out |= {(a, b) for a in ids for b in sets[t] if a < b}
                out |= {(b, a) for a in ids for b in sets[t] if b < a}
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab1_ -éßİ文.", max_size=14), min_size=1, max_size=5), st.integers(1, 3))
def test_sets(texts, k):
    elements, counts = neardup.shingle_sets(texts, k)
    assert counts.tolist() == [len(plain_set(t, k)) for t in texts]
    at = 0
    keys = {}
    for t, n in zip(texts, counts.tolist()):
        keys.setdefault(plain_set(t, k), set()).add(tuple(elements[at : at + n].tolist()))
        at += n
    assert all(len(v) == 1 for v in keys.values()) and len({next(iter(v)) for v in keys.values()}) == len(keys)


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    bands = 400
    flip, factor = neardup._permutations(2 * bands)
    for shared, own in ((60, 20), (300, 200), (30, 100)):
        e = rng.integers(0, 1 << 32, shared + 2 * own, np.uint32)
        a, b = e[: shared + own], np.concatenate([e[:shared], e[shared + own :]])
        x, y = (a[None] ^ flip) * factor, (b[None] ^ flip) * factor
        same = np.concatenate([x.min(1) == y.min(1), x.max(1) == y.max(1)]).mean()
        assert abs(same - shared / (shared + 2 * own)) < 0.06
        both = np.concatenate([np.sort(a), np.sort(b)])
        keys = neardup.signatures(both, np.array([len(a), len(b)]), bands)
        j = shared / (shared + 2 * own)
        assert abs((keys[0] == keys[1]).mean() - j**4) < 0.08


def test_query_against_all_pairs(spark, data):
    got = {(r.field, r.doc_a, r.doc_b) for r in p2_found(spark, data).collect()}
    want = set()
    for field, name, k, t in (("body_md", "document_md", 3, 0.6), ("source_relpath", "manifest", 1, 0.5)):
        rows = [tuple(r) for r in spark.read.parquet(f"{data}/{name}.parquet").select("doc_id", field).collect()]
        want |= {(field, a, b) for a, b in all_pairs(rows, k, t)}
    assert got == want and want


def test_groups_are_the_components(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/document_md.parquet").select("doc_id", "body_md").collect()]
    group = {r.doc_id: r.class_id for r in p2_groups(spark, data).collect()}
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in all_pairs(rows, 3, 0.6):
        parent[root(a)] = root(b)
    by_root, by_class = defaultdict(set), defaultdict(set)
    for i in group:
        by_root[root(i)].add(i)
        by_class[group[i]].add(i)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_class.values()))


def test_dirty_rows_and_copies(spark):
    text = "one two three four five six seven eight"
    rows = [("a", text), ("a", text), ("b", text.upper()), ("c", text + " nine"), ("d", None), (None, text), ("e", ""), ("f", "one two"), ("g", "two one")] + [(f"z{i}", "x y z w") for i in range(12)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_a string, doc_b string, set_key int")
    got = {(r.doc_a, r.doc_b) for r in neardup.near_duplicates(df, "doc_a", "doc_b", k=3, threshold=0.6).collect()}
    assert got == all_pairs(rows, 3, 0.6) and ("a", "b") in got and ("b", "c") in got and len(got) == 3 + 66
    groups = {r.doc_a: (r.class_id, r.links) for r in neardup.duplicate_groups(df, "doc_a", "doc_b", k=3, threshold=0.6).collect()}
    assert len({groups[x][0] for x in "abc"}) == 1 and groups["a"][1] == 1 and groups["z3"][1] == 0 and len({groups[f"z{i}"][0] for i in range(12)}) == 1
    assert neardup.near_duplicates(df.limit(0), "doc_a", "doc_b").count() == 0


def test_a_third_of_all_rows_are_copies(spark):
    import random

    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    hot = " ".join(rng.choices(words, k=80))
    near = hot.rsplit(" ", 3)[0]
    rows = [(f"h{i:03}", hot) for i in range(60)] + [("n1", near), ("n2", near + " x")] + [(f"o{i:03}", " ".join(rng.choices(words, k=80))) for i in range(120)]
    df = spark.createDataFrame(rows, "d string, t string")
    groups = {r.d: (r.class_id, r.links) for r in neardup.duplicate_groups(df, "d", "t").collect()}
    assert len(groups) == len(rows) and len({groups[d][0] for d in groups if d[0] in "hn"}) == 1 and groups["h000"][1] == 2
    assert len({groups[d][0] for d in groups if d[0] == "o"}) == 120
    pairs = neardup.near_duplicates(df, "d", "t").count()
    assert pairs == 62 * 61 // 2


def test_groups_have_short_and_null_texts(spark):
    long = "one two three four five six"
    rows = [("a", long), ("b", long), ("c", "two words"), ("d", "two words"), ("d", "two words"), ("e", "other"), ("f", None), ("g", None), ("h", ""), (None, "x")]
    got = neardup.duplicate_groups(spark.createDataFrame(rows, "id string, t string"), "id", "t", k=3).collect()
    by = {r.id: r.class_id for r in got}
    assert len(got) == 8 and set(by) == set("abcdefgh") and all(r.links == 0 for r in got)
    assert by["a"] == by["b"] and by["c"] == by["d"] and len(set(by.values())) == 6


def test_hot_buckets_are_cut_into_blocks(spark, monkeypatch):
    """Forty versions of one text share most buckets: blocks of any size give all pairs, and no unit holds a whole bucket."""
    import random

    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    base = rng.choices(words, k=150)
    rows = []
    for i in range(40):
        text = list(base)
        for _ in range(rng.randrange(1, 12)):
            text[rng.randrange(150)] = rng.choice(words)
        rows.append((f"d{i:02}", " ".join(text)))
    rows += [(f"o{i:02}", " ".join(rng.choices(words, k=150))) for i in range(20)]
    df = spark.createDataFrame(rows, "d string, t string")
    want = all_pairs(rows, 3, 0.6)
    for block in (4, 64):
        monkeypatch.setattr(neardup, "BLOCK", block)
        got = {(r.doc_a, r.doc_b) for r in neardup.near_duplicates(df, "d", "t", k=3, threshold=0.6).collect()}
        assert got == want and len(want) > 200
    monkeypatch.setattr(neardup, "BLOCK", 4)
    units = neardup.candidate_classes(neardup.signature_table(df, "d", "t", 3, 48), 0.6).groupBy("unit").count()
    assert max(r["count"] for r in units.collect()) <= 100


def test_sets_are_packed_and_unpacked():
    rng = np.random.default_rng(5)
    for n in (1, 2, 700):
        e = np.unique(rng.integers(0, 1 << 32, n, np.uint32))
        assert (neardup._unpack(neardup._pack(e)) == e).all()


def test_the_screen_changes_nothing(spark, monkeypatch):
    from foliate.llm import screen

    text = "one two three four five six seven eight nine ten"
    rows = [(f"a{i}", text) for i in range(9)] + [(f"b{i}", text + " eleven") for i in range(9)] + [("c", "quite another text of some words")]
    df = spark.createDataFrame(rows, "d string, t string").repartition(3)
    monkeypatch.setattr(neardup, "screen", lambda rows, value: screen.Shipped(spark, b"\xff" * (screen.BITS // 8)))  # all passes
    assert {(r.doc_a, r.doc_b) for r in neardup.near_duplicates(df, "d", "t", k=3, threshold=0.6).collect()} == all_pairs(rows, 3, 0.6)
