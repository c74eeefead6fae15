"""The consistent form and the irregular lines, against a plain character-by-character version."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foliate.llm import unify
from foliate.llm.queries import p6_found


def brute(line):
    """Irregular or not, one character at a time."""
    for i, c in enumerate(line):
        if c.isascii():
            continue
        name = unicodedata.name(c, "")
        if unicodedata.normalize("NFKC", c) != c or unicodedata.category(c) in ("Zs", "Zl", "Zp") or "HYPHEN" in name and unicodedata.category(c) == "Pd":
            return True
        if unicodedata.category(c) == "Cf" or c in "᠎͏":
            return True
        if unicodedata.combining(c) and name.startswith("COMBINING") and i and line[i - 1].isalpha():
            return True
    run = ""
    for c in line + " ":
        if c.isalnum() or c == "_":
            run += c
            continue
        scripts = {unicodedata.name(x, "").split()[0] for x in run if x.isalpha()}
        foreign = sum(unicodedata.name(x, "").split()[0] in ("GREEK", "CYRILLIC") for x in run if x.isalpha())
        numeric = any(x in "0123456789" for x in run) and foreign < len(run) / 2  # a number with a letter for one of its signs
        if ("LATIN" in scripts or numeric) and foreign and scripts <= {"LATIN", "GREEK", "CYRILLIC"}:
            unit = run.lstrip("0123456789")
            if not (unit in ("Ω", "kΩ", "MΩ", "mΩ") or unit.startswith("μ") and unit[1:].isascii() and unit[1:].isalpha() and len(unit) < 5):
                return True
        run = ""
    return False


ALPHABET = "aeB9_ -.|éñü\ţ́  　‑‐​‍­﻿᠎ａＢ９ﬁ𝐞𝗇℃µΩ№аеоΑνμΩблокσή時計。¬"


@settings(max_examples=800, deadline=None)
@given(st.text(ALPHABET, max_size=12))
def test_against_brute_force(line):
    assert unify.irregular(line) == brute(line)
    if not unify.irregular(line):
        assert unify.consistent(line, fold_case=False) == unicodedata.normalize("NFKC", line)


@settings(max_examples=300, deadline=None)
@given(st.text(ALPHABET, max_size=12))
def test_form_is_stable_and_regular(line):
    form = unify.consistent(line)
    assert unify.consistent(form) == form


@pytest.mark.parametrize(
    "line, form",
    [
        ("Ｌ２＿ｇａｉｎ", "l2_gain"),
        ("crème", "crème"),
        ("con‍trol​ler", "controller"),
        ("a b c　d", "a b c d"),
        ("low‑power", "low-power"),
        ("соnvertеr 0хВFA", "converter 0xbfa"),
        ("смотри таблицу", "смотри таблицу"),
        ("5 μs, 3 kΩ", "5 μs, 3 kω"),
        ("abschließen", "abschliessen"),
        ("\tx\f", "\tx\f"),
    ],
)
def test_forms(line, form):
    assert unify.consistent(line) == form


def test_rows(spark):
    df = spark.createDataFrame([("k", "ok\nﬁne\r\n\nx​", 1), ("k", "ok\nﬁne\r\n\nx​", 1), ("n", None, 1), ("e", "", 1), (None, "ﬁ", 1), ("l", "a" * 300000 + " ", 1)], "key string, t string, line_no int")
    got = sorted((r.rec_key, r.line_no) for r in unify.irregular_lines(df, "t", "key", "t").distinct().collect())
    assert got == [("k", 1), ("k", 3), ("l", 0)]
    forms = [r.u for r in unify.consistent_column(df, "t", "u").collect()]
    assert forms[0] == forms[1] == "ok\nfine\r\n\nx" and forms[2] is None and forms[3] == "" and len(forms) == 6
    assert unify.irregular_lines(df.limit(0), "t", "key", "t").count() == 0


def test_query(spark, data):
    got = {(r.field, r.rec_key, r.line_no) for r in p6_found(spark, data).collect()}
    want = set()
    for name, key, text in (("document_md", "doc_id", "body_md"), ("coverage_record", "rec_id", "source_text")):
        for k, t in spark.read.parquet(f"{data}/{name}.parquet").select(key, text).collect():
            want |= {(text, str(k), i) for i, line in enumerate((t or "").split("\n")) if t and brute(line)}
    assert got == want and got
