"""The mixture: shares, caps, the cube method's balance and its inclusion probabilities."""

import numpy as np
import pytest

from foliate.llm import mixing
from foliate.llm.queries import p8_mixture, p8_shares


@pytest.mark.parametrize("seed", range(5))
def test_flight_keeps_both_sums(seed):
    rng = np.random.default_rng(seed)
    size = rng.integers(1, 3000, 500).astype(float)
    size[:50] = 7
    p = rng.random(500)
    q = mixing.flight(size, p, rng)
    assert ((q > 0) & (q < 1)).sum() <= 2
    assert abs(q.sum() - p.sum()) < 1e-6 and abs((q * size).sum() - (p * size).sum()) < 1e-3
    r = mixing.landing(size, q)
    assert set(r) <= {0.0, 1.0} and abs((r * size).sum() - (p * size).sum()) <= 3000


def test_inclusion_probabilities_are_kept():
    size = np.array([1, 5, 2, 9, 4, 4, 7, 3.0])
    p = np.array([0.1, 0.5, 0.3, 0.8, 0.45, 0.6, 0.25, 0.7])
    mean = np.mean([mixing.flight(size, p, np.random.default_rng(i)) for i in range(6000)], axis=0)
    assert np.abs(mean - p).max() < 0.03


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(3)
    data = [(i, ["a", "b", "c"][min(2, int(rng.integers(0, 6)))], int(rng.integers(1, 400))) for i in range(3000)]
    return spark.createDataFrame(data, "doc_key long, source string, n_tokens long"), data


@pytest.mark.parametrize("block", [20_000, 40])
def test_shares_and_caps(spark, docs, block, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", block)
    counts, data = docs
    targets = spark.createDataFrame([("A ", 0.5, 3), ("b", 0.3, 2), ("none", 0.1, 1), ("c", 0.0, 5), ("zero", 0.1, 0)], "source string, target_share double, max_repeats int")
    got = rows(mixing.mixture(counts, targets))
    assert len({r[0] for r in got}) == len(got)
    used = {s: sum(n * c for _, x, n, c in got if x == s) for s in "abc"}
    total = sum(used.values())
    assert used["c"] == 0 and abs(used["a"] / total - 0.625) < 800 / total and abs(used["b"] / total - 0.375) < 800 / total
    cap = {"a": 3, "b": 2}
    assert all(c <= cap[s] for _, s, _, c in got)
    have = {s: sum(n for _, x, n in data if x == s) for s in "ab"}
    assert abs(total - min(3 * have["a"] / 0.625, 2 * have["b"] / 0.375)) < 1600
    for s in "ab":  # uses of a source's documents differ by one at most
        copies = {i: 0 for i, x, _ in data if x == s} | {r[0]: r[3] for r in got if r[1] == s}
        assert max(copies.values()) - min(copies.values()) <= 1
    assert sorted(rows(mixing.mixture(counts.repartition(7), targets))) == sorted(got)


def test_given_total_and_empty(spark, docs):
    counts, _ = docs
    targets = spark.createDataFrame([("a", 0.5, 3), ("b", 0.5, 2)], "source string, target_share double, max_repeats int")
    got = rows(mixing.mixture(counts, targets, total_tokens=20000))
    assert abs(sum(n * c for *_, n, c in got) - 20000) < 1000
    assert rows(mixing.mixture(counts.limit(0), targets)) == [] and rows(mixing.mixture(counts, targets.limit(0))) == []


def test_counts_of_dirty_rows(spark):
    df = spark.createDataFrame([(1, " X", "one two"), (1, " X", "one two"), (2, "x", None), (3, "x", ""), (4, None, "one"), (5, "y", "one two three")], "doc_id long, source string, text string")
    got = sorted(rows(mixing.token_counts(df, "doc_id", "source", "text", "/opt/tokenizers/byte_bpe_50k.tiktoken")))
    assert got == [(1, "x", 2), (5, "y", 3)]


def test_queries(spark, data):
    shares = {r.source: r for r in p8_shares(spark, data).collect()}
    have = sum(r.target_share for r in shares.values() if r.n_docs)
    total = sum(r.used_tokens for r in shares.values())
    for r in shares.values():
        want = r.target_share / have if r.n_docs else 0
        assert abs(r.actual_share - want) < 4000 / total, r
    assert abs(sum(r.actual_share for r in shares.values()) - 1) < 1e-9
    caps = {r.source: r.max_repeats for r in spark.read.parquet(f"{data}/mix_targets.parquet").collect()}
    assert all(1 <= r.copies <= caps[r.source] for r in p8_mixture(spark, data).collect())


def test_too_many_targets_are_refused_first(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(mixing, "MAX_SOURCES", 2)
    counts = spark.createDataFrame([(1, "a", 5)], "doc_key long, source string, n_tokens long")
    targets = spark.createDataFrame([(x, 0.1, 1) for x in "abc"], "source string, target_share double, max_repeats int")
    with pytest.raises(ValueError):
        mixing.mixture(counts, targets)
