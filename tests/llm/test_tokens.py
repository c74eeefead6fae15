"""The transducer against merging by the definition and against a public encoder; decoding round trips."""

import random

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from foliate.llm import tokens
from foliate.llm.queries import p7_ids

tiktoken = pytest.importorskip("tiktoken")
PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as f:
        return tokens.Vocabulary(f.read())


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={}).encode_ordinary


def unpack(packed):
    return list(memoryview(packed).cast("i")) if packed else []


TEXT = st.text(st.sampled_from("aabcdeet 's\n\t019.-_=é文 \U0001f600thing'll"), max_size=60) | st.text(max_size=40)


@settings(max_examples=400, deadline=None)
@given(TEXT, st.integers(1, 9))
def test_whole_and_chunked(vocabulary, reference, text, step):
    if any("\ud800" <= c <= "\udfff" for c in text):
        return
    e = tokens.StreamingEncoder(vocabulary)
    want = reference(text)
    assert unpack(e.encode(text)) == want
    assert unpack(b"".join([e.feed(text[i : i + step]) for i in range(0, len(text), step)]) + e.close()) == want
    d = tokens.StreamingDecoder(vocabulary)
    assert "".join([d.feed([i]) for i in want]) + d.close() == text


@settings(max_examples=300, deadline=None)
@given(st.binary(min_size=1, max_size=30) | st.text("abcdehinotrs", min_size=1, max_size=40).map(str.encode))
def test_transducer_is_the_merge_list(vocabulary, piece):
    assert tokens.Transducer(vocabulary).encode(piece) == [vocabulary.ranks[t] for t in vocabulary.merge(piece)]


def test_neighbours(vocabulary):
    rng = random.Random(1)
    some = rng.sample(sorted(vocabulary.ranks), 400)
    for _ in range(3000):
        a, b = rng.choice(some), rng.choice(some)
        assert vocabulary.fits(a, b) == (vocabulary.merge(a + b) == [a, b])


@pytest.mark.parametrize("unit", ["a", "ab", "-", "=-", " ", "\n", "9", "the", "é", "zzyx"])
def test_long_pieces_keep_constant_memory(vocabulary, reference, unit, monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK", 512)
    text = "x " + unit * 3000 + " end"
    e = tokens.StreamingEncoder(vocabulary)
    most, got = 0, b""
    for i in range(0, len(text), 512):
        got += e.feed(text[i : i + 512])
        most = max(most, len(e.rest) + len(e._long.window))
    got += e.close()
    assert unpack(got) == reference(text)
    assert most < 512 + 4096 + 4 * (vocabulary.sufficient_lookahead() + vocabulary.longest)
    assert unpack(e.encode(text)) == reference(text)


def test_random_letters_in_small_feeds(vocabulary):
    rng = random.Random(5)
    for _ in range(20):
        piece = "".join(rng.choice("etaoinshr") for _ in range(2500)).encode()
        t = tokens.Transducer(vocabulary)
        out = []
        for i in range(0, len(piece), 97):
            out += t.feed(piece[i : i + 97])
        assert out, "nothing was emitted before the end"
        assert out + t.close() == [vocabulary.ranks[x] for x in vocabulary.merge(piece)]


def test_decoder_holds_back_and_replaces(vocabulary):
    d = tokens.StreamingDecoder(vocabulary)
    half = [vocabulary.ranks["é".encode()[:1]]]
    assert d.feed(half) == "" and d.close() == "�"


def test_pattern_is_the_public_one():
    public = regex.compile(tokens.PATTERN)
    assert public.findall("I'll  go 12a\n\n b") == ["I", "'ll", " ", " go", " 12", "a", "\n\n", " b"]


def test_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "<|endoftext|> x", 5), (3, "<|endoftext|> x", 5), (4, "a" * 200000, 5)], "doc_id long, text string, ids int")
    rows = tokens.encode_column(df, "doc_id", "text", PATH).collect()
    by = {r.doc_id: r.ids for r in rows}
    assert len(rows) == 5 and by[1] == by[2] == [] and 50256 not in by[3] and len(by[4]) > 1000
    counts = {r.doc_id: r.n_tokens for r in tokens.count_column(df, ["doc_id"], "text", PATH).collect()}
    assert counts == {k: len(v) for k, v in by.items()}
    assert tokens.encode_column(df.limit(0), "doc_id", "text", PATH).count() == 0


def test_query(spark, data, reference):
    got = {r.doc_id: r.ids for r in p7_ids(spark, data).collect()}
    want = {r.doc_id: reference(r.text or "") for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    assert got == want
