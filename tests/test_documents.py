"""Document operators against literal cases and against plain versions."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliate.functions import text as fn
from foliate.functions.markdown import to_text
from foliate.operators import dataflow, figures, outline, recall, recovery, validation


def values(spark, column, *rows):
    """The column's value for each row of (a, b, c)."""
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,)), *[None] * (2 - (len(r) if isinstance(r, tuple) else 1))) for i, r in enumerate(rows)], "i int, a string, b string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_routing(spark):
    assert values(spark, fn.extension("a"), "a/b/Spec.DOCX", "report.tar.gz", "README", "dir.d/Makefile", " x.PDF ", ".bashrc", "a\\b.md", None) == ["docx", "gz", "", "", "pdf", "", "md", ""]
    assert values(spark, fn.lane_of("a"), "DOCX", ".pdf", "yml", "xls", "tcl", "") == ["ooxml", "docling", "fence", "libreoffice", "unsupported", "unsupported"]
    got = values(spark, fn.classify("a", "docx,pdf,odt"), "a.docx", "b.md", "c.pdf", "e.bin", "f")
    assert [(r.lane, r.accepted, r.reason) for r in got] == [("ooxml", True, ""), ("passthrough", False, "format .md excluded by accept-list"), ("docling", True, ""), ("unsupported", False, "unsupported format .bin"), ("unsupported", False, "unsupported format (no extension)")]
    assert fn.unknown_formats("docx;pfd") == ("pfd",) and fn.accepted_formats("all") == fn.accepted_formats(None) == set(fn.supported_formats()) and len(fn.supported_formats()) == 25


def sides(spark, source, target):
    return spark.createDataFrame([("d", source)], "key string, text string"), spark.createDataFrame([("d", target)], "key string, text string")


@pytest.mark.parametrize(
    "source, target, exclude, want",
    [
        ("alpha beta gamma delta", "alpha beta", None, (4, 2, 2, 0.5)),
        ("reg reg reg done", "reg done", None, (4, 2, 2, 0.5)),
        ("", "x", None, (0, 0, 0, 1.0)),
        (None, "x", None, (0, 0, 0, 1.0)),
        ("reg " * 1000, "reg " * 400, None, (1000, 400, 600, 0.4)),
        ("header alpha beta header gamma", "alpha beta gamma", "header header", (3, 3, 0, 1.0)),
        ("x x keep", "keep", "x", (2, 1, 1, 0.5)),
        ("café 温度 sensor 42", "caf sensor", None, (3, 2, 1, 2 / 3)),
    ],
)
def test_recall(spark, source, target, exclude, want):
    s, t = sides(spark, source, target)
    x = s.select("key", F.lit(exclude).alias("text")) if exclude else None
    r = recall.coverage(s, t, x).collect()
    assert [(q.n_source, q.n_covered, q.n_missing, q.recall) for q in r] == [want]


def test_top_missing(spark):
    s, t = sides(spark, "intro slide notes notes notes important point " + " ".join(f"w{i:02}" for i in range(50)), "intro slide point")
    got = [(r.token, r.n) for r in recall.top_missing(recall.bags(s, t)).orderBy("rank").collect()]
    assert got[0] == ("notes", 3) and len(got) == 12 and [g[0] for g in got[1:]] == sorted(g[0] for g in got[1:])


@settings(max_examples=150, deadline=None)
@given(st.text("abc1é文", max_size=12), st.text("abc1é文", max_size=12))
def test_gram_recall(a, b):
    from collections import Counter

    x, y = (Counter(t[i : i + 3] for i in range(len(t) - 2)) for t in (a, b))
    want = sum((x & y).values()) / sum(x.values()) if x else 1.0
    assert recall.gram_recall(a, b) == pytest.approx(want)


def test_running_lines():
    pages = "\f".join(f"Header\nbody {i}\n{i}" for i in range(3))
    assert recall.strip_running(pages) == "\f".join(f"body {i}\n{i}" for i in range(3))
    four = "H\na\fH\nb\fx\nc\fy\nd"
    assert recall.strip_running(four, 0.75) == four and recall.strip_running(four, 0.5) == "a\fb\fx\nc\fy\nd"
    assert recall.strip_running("H\nH") == "H\nH" and recall.strip_running(None) is None


@pytest.mark.parametrize(
    "raw, target, image, want",
    [
        ("inter face controller", "interface controller", "", {"covered": 1, "fused": 2, "absent": 0}),
        ("42 v signal", "signal", "", {"numeric": 1, "short": 1, "absent": 0}),
        ("\f".join(["a1\ndraft copy", "b2\ndraft copy", "c3 x", "d4 y", "e5 z"]), "a1 b2 c3 x d4 y e5 z", "", {"residual_boiler": 4, "absent": 0}),
        ("\f".join(f"Page {i} of 3" for i in (1, 2, 3)), "", "", {"residual_boiler": 6, "numeric": 6}),
        ("face face face flag", "interface flag", "", {"fused": 1, "absent": 2}),
        ("interface face", "interface", "", {"fused": 0, "absent": 1}),
        ("body prose here gate1 clkdiv xtal", "body prose here", "gate1 clkdiv xtal", {"image_text": 3, "absent": 0}),
        ("", "x", "", {"n_source": 0}),
    ],
)
def test_gaps(raw, target, image, want):
    counts, _ = recall.explain(raw, target, 0.5, image)
    got = dict(zip(recall.GAP_FIELDS, counts))
    assert {k: got[k] for k in want} == want
    assert got["n_source"] == sum(got[k] for k in recall.GAP_FIELDS[1:])


def test_geometry():
    got = recall.merge_boxes([(0.1, 0.1, 0.2, 0.2), (0.8, 0.8, 0.9, 0.9), (0.205, 0.1, 0.3, 0.2), (0.3, 0.1, 0.4, 0.2)], 0.01)
    assert sorted((n, b) for b, n in got) == [(1, (0.8, 0.8, 0.9, 0.9)), (3, (0.1, 0.1, 0.4, 0.2))]


def test_identifiers(spark):
    vocabulary = values(spark, recall.identifier_vocabulary("a"), "(AB_CD), X_Y end.", "(ABC_DEF). docIdent The REGISTER DFTController", None)
    assert vocabulary == [[], ["ABC_DEF", "DFTController", "docIdent"], []]
    assert recall.rejoin("SMBUS_PERSISTENT_SLV_AD DR4_EN x", ["SMBUS_PERSISTENT_SLV_ADDR4_EN"]) == "SMBUS_PERSISTENT_SLV_ADDR4_EN x"
    assert recall.rejoin("DEST\\_MS IZE", ["DEST_MSIZE"]) == "DEST\\_MSIZE"
    assert recall.rejoin("ALPHA_BETA _GAMMA _DELTA", ["ALPHA_BETA_GAMMA_DELTA", "ALPHA_BETA_GAMMA"]) == "ALPHA_BETA_GAMMA_DELTA"
    assert recall.rejoin("the register", ["REGISTER"]) == "the register"


@pytest.mark.parametrize(
    "md, want",
    [
        ("**Silicon** Operations", "Silicon Operations"), ("the *fast* path", "the fast path"), ("~~old~~ new", "old new"), ("[Owen Carter](mailto:owen@x.com)", "Owen Carter"), ("see [the spec](https://x/y)", "see the spec"), ("![AXI4 diagram](img/axi.png)", "AXI4 diagram"),
        ("<https://example.com/a>", "https://example.com/a"), ("#### ECO flow ####", "ECO flow"), ("| Name | Role |\n| :-- | --- |\n| Owen Carter | Lead Engineer |", "Name Role\n\nOwen Carter Lead Engineer"), ("```python\nx = 1\n```", "x = 1"), ("- first\n- second", "first\nsecond"), ("1. alpha\n2. beta", "alpha\nbeta"),
        ("Title\n===\n\nbody\n\n---", "Title\n\nbody"), ("a \\* literal asterisk", "a * literal asterisk"), ("x <!-- c\nd --> y \\<!-- z -->", "x y <!-- z -->"), ("> quote", "quote"), ("snake_case_name and a_b", "snake_case_name and a_b"), ("\\[SA,TD\\](zero,SDF)", "[SA,TD](zero,SDF)"), (None, ""),
    ],
)
def test_markdown_to_text(md, want):
    assert to_text(md) == want


def test_markdown_pieces(spark):
    assert values(spark, fn.collapse_padding("a"), "| a     |  b\\|c |\n| :----- | ----: | :---: |\nx | y", "") == ["| a | b\\|c |\n| :--- | ---: | :---: |\nx | y", ""]
    assert values(spark, fn.fence("a", "json"), "x", "a ```` b\n", "", None) == ["```json\nx\n```\n", "`````json\na ```` b\n`````\n", "```json\n```\n", "```json\n```\n"]
    assert values(spark, fn.image_link("a", "b"), ("a\n b]c|d`e\\f", "p.png"), (None, "q")) == ["![a b\\]c/d'e f](p.png)", "![](q)"]
    assert values(spark, fn.escape_lead(fn.escape_markdown("a")), "15. foo", "> q", "- x", "-x", "# h", "a*b", "1.5 V") == ["15\\. foo", "\\> q", "\\- x", "-x", "\\# h", "a\\*b", "1.5 V"]
    assert values(spark, fn.front_matter({"x": F.col("a"), "y": F.col("b")}), ('q"\\\n', None), (None, None)) == ['---\nx: "q\\"\\\\\\n"\n---\n', ""]
    assert values(spark, fn.strip_front_matter("a"), "---\nx: 1\n---\nbody", "---\nopen", "no") == ["body", "---\nopen", "no"]
    rows = F.array(F.array(F.lit("a"), F.lit("b|c"), F.lit("")), F.array(F.lit(" "), F.lit(""), F.lit("")), F.array(F.lit("1")))
    assert values(spark, fn.pipe_table(rows), "x") == ["| a | b\\|c |\n| --- | --- |\n| 1 |  |"]
    md = F.lit("a <!-- image --> b <!-- image --> c <!-- image -->")
    assert values(spark, fn.fill_placeholders(md, F.array(F.lit("X"), F.lit(None).cast("string"))), "x") == ["a X b  c <!-- image -->"]
    marks = F.lit("<!-- figure:a --> <!-- figure:b --> <!-- figure:c -->")
    assert values(spark, fn.fill_sentinels(marks, F.create_map(F.lit("a"), F.lit("A"), F.lit("b"), F.lit(None).cast("string")), "figure"), "x") == ["A  <!-- figure:c -->"]
    assert values(spark, fn.savings("a", "b").getField("reduction_ratio"), ("100", "40"), ("0", "0"), ("5", "0")) == [2.5, 1.0, 0.0]


@pytest.mark.parametrize(
    "md, want",
    [
        ("---\nx: 1\n---\n# A\n\n| a | b |\n| --- | --- |\n| 1 | 2 |\n| 3 | 4 |", []), ("| A | B |\n| - | - |\n| 1 | 2 | 3 |", [(3, "table-columns")]), ("| a | b |\n| c | d |", [(1, "table-no-separator")]), ("| A | B |\n|---|---|\n| x \\| y | z |", []),
        ("x\n```\ny", [(2, "fence-unclosed")]), ("---\nopen", [(1, "frontmatter-unclosed")]), ("a <w:t> b", [(1, "xml-leak")]), ("a\x00", [(1, "bad-chars")]), ("�", [(1, "bad-chars")]), ("# Top\n### Jumped", [(2, "heading-jump")]), ("", []), ("a | b", []), ("```\n<w:t>\n# x\n### y\n```", []),
    ],
)
def test_validation(md, want):
    assert [(i[0], i[1]) for i in validation.issues(md)] == want


def test_gates(spark):
    df = spark.range(1)
    one = lambda c: df.select(c).collect()[0][0]
    L = F.lit
    assert one(validation.caption_gate(L(True), L(5), L(4), L(1), L(0), L(0))) == "complete" and one(validation.caption_gate(L(False), L(5), L(4), L(1), L(0), L(0))) == "disabled" and one(validation.caption_gate(L(True), L(5), L(0), L(0), L(0), L(5))) == "pending"
    assert one(validation.measured_gate(L("pdf"), L(True), L("pass"))) == "best-effort" and one(validation.measured_gate(L("office"), L(False), L(None).cast("string"))) == "fail"
    assert one(validation.bundle_status(L("ok"), L("degraded"), L("pass"))) == "degraded" and one(validation.bundle_status(L("failed"), L("degraded"), L("pass"))) == "failed"
    assert one(validation.lossless(L(1.0), L(0), L(9), L(0.5))) is False and one(validation.lossless(L(1.0), L(0), L(2), L(0.5))) is True


def test_headings(spark):
    lines = ["# Title", "### Deep", "1.2.3 Something Here", "a long lower sentence", "# C# x", "CHAPTER OVERVIEW NOTES", "appendix B", "", None, "x" * 121]
    got = values(spark, fn.heading_level("a"), *lines)
    assert got == [1, 3, 3, 0, 2, 1, 1, 0, 0, 0] == [outline.level_of(x or "") for x in lines]
    titles = ["## Background", "BACKGROUND", "1.2 Background", "# A  b ##"]
    assert values(spark, fn.normal_title("a"), *titles) == ["background"] * 3 + ["a b"] == [outline.normal_title(t) for t in titles]


def test_outline():
    nodes = outline.outline("intro\n\n- 1 item\n\n# One\ntext [a](u) ![i](images/x.png)\n## 1.2 Constraints\n```\n[no](link)\n```\n# One\n")
    assert [(n["title"], n["level"], n["parent"], n["anchor"]) for n in nodes] == [("(preamble)", 1, -1, "preamble"), ("One", 1, -1, "one"), ("1.2 Constraints", 2, 1, "constraints"), ("One", 1, -1, "one#2")]
    assert nodes[1]["links"] == [{"text": "a", "url": "u", "line": 5}] and nodes[1]["images"][0]["image_id"] == "x" and nodes[2]["links"] == []
    assert outline.content_start("Contents\n1 A ..... 3\n2 B ..... 5\n\n# A\nx\n# B\ny\nz\nw".split("\n")) == 3
    assert outline.content_start("text\n1\nmore\n".split("\n")) == 0
    assert outline.content_start("1 A ..... 3\n# H\nx\ny\nz".split("\n")) == 1


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**6))
def test_outline_invariants(seed):
    rng = random.Random(seed)
    text = "\n".join(rng.choice(["# A", "## B", "### C", "text", "", "1.1 Num Head", "| a | b |", "|---|---|", "- item", "```"]) for _ in range(rng.randrange(60)))
    nodes = outline.outline(text)
    total = sum((len(x) + 3) // 4 for x in text.split("\n"))
    for i, n in enumerate(nodes):
        assert n["subtree_tokens"] == n["self_tokens"] + sum(c["subtree_tokens"] for c in nodes if c["parent"] == i)
    if nodes and outline.content_start(text.split("\n")) == 0:
        covered = sum(n["subtree_tokens"] for n in nodes if n["parent"] < 0)
        assert covered <= total


def test_chunks():
    assert len(outline.chunks("d", "# A\nx\n# B\ny")) == 1
    many = outline.chunks("d", "\n".join(f"# H{i}\n" + "word " * 40 for i in range(1000)))
    assert 1 < len(many) < 50 and many[0]["l0"] == 0 and all(a["l1"] == b["l0"] for a, b in zip(many, many[1:]))
    windows = outline.chunks("d", "# H\n" + "\n".join(["x" * 100] * 150))
    assert len(windows) >= 2 and all(c["level"] == 2 and ".w" in c["section_id"] for c in windows)
    table = "| Name | V |\n| --- | --- |\n" + "\n".join(f"| n{i} | {i} |" for i in range(4000))
    lines = table.split("\n")
    assert all("| Name | V |" in c["prefix"] + "\n".join(lines[c["l0"] : c["l1"]]) for c in outline.chunks("d", table))
    assert outline.fingerprint("**a** b") == outline.fingerprint("a  b")


def test_figures(spark):
    rows = [("d", 1, None, 0.005, "s", "body"), ("d", 2, "logo", 0.30, "t", "body"), ("d", 3, "logo", 0.03, "u", "body"), ("d", 4, None, None, "x", "body"), ("d", 5, None, None, "x", "body"), ("d", 6, None, None, "y", "chrome"), ("d", 7, "icon", None, "z", "body"), ("d", 8, None, None, None, None), ("d", 9, None, None, None, None), ("e", 1, None, None, "x", "body"), ("e", 2, "chart", 0.01, "x", "body")]
    df = spark.createDataFrame(rows, "doc_id string, pos int, cls string, area double, sha string, ref string")
    got = [r.reason for r in figures.gate(df).orderBy("doc_id", "pos").collect()]
    assert got == ["tiny", "keep", "deny:logo", "keep", "dup", "chrome", "deny:icon", "keep", "keep", "keep", "tiny"]
    caps = values(spark, fn.caption_is_useful("a"), "a timing diagram", "the " * 12, "12345 67890 12345 67890 1234", "A block diagram of the clock tree with two lanes.", None)
    assert caps == [False, False, False, True, False]
    assert values(spark, fn.caption_is_furniture("a"), "A logo. Nothing more", "A block diagram of the logo", "Equations. logo", "", None) == [True, False, False, False, False]


def test_recovery(spark):
    rows = [(137, False, "", True, None), (137, True, "", True, None), (1, False, "std::bad_alloc", True, None), (1, False, "not a PDF", True, None), (0, False, "", True, "partial_success"), (0, False, "", False, None), (1, False, "", True, None), (0, False, "", True, None), (-9, False, None, True, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, rc int, dog boolean, log string, had boolean, st string").orderBy("i")
    c = F.col
    assert [r[0] for r in df.select(recovery.failure_class(c("rc"), c("dog"), c("log"), c("had"), c("st"))).collect()] == ["oom", "hang", "oom", "input", "docling", "docling", "transient", "none", "oom"]
    kinds = [("oom", 0), ("oom", 1), ("docling", 0), ("input", 0), ("transient", 0), ("transient", 2), ("none", 0)]
    k = spark.createDataFrame([(i, *x) for i, x in enumerate(kinds)], "i int, k string, n int").orderBy("i")
    assert [r.a.action for r in k.select(recovery.recovery_action(c("k"), c("n")).alias("a")).collect()] == ["escalate", "fallback", "fallback", "blacklist", "retry", "fallback", "retry"]
    load = spark.createDataFrame([(0, 2.0, 200.0, 2), (1, 40.0, 200.0, 8), (2, 999.0, 200.0, 1), (3, 2.0, 1.0, 2), (4, 1.0, 500.0, 8)], "i int, l double, g double, w int").orderBy("i")
    assert [r[0] for r in load.select(recovery.admission(c("l"), c("g"), c("w"), F.lit(32))).collect()] == ["grow", "shrink", "hold", "hold", "hold"]
    hosts = spark.createDataFrame([("a", 32, 256.0), ("b", 2, 1.0), ("c", 64, 100.0), ("d", None, 500.0), ("e", 16, None)], "host string, cores int, free_gb double")
    assert {r.host: (r.shards, r.bound) for r in recovery.shards(hosts).collect()} == {"a": (8, "cores"), "b": (1, "memory"), "c": (12, "memory"), "d": (1, "cores"), "e": (4, "cores")}
    assert {r.host: (r.shards, r.bound) for r in recovery.shards(hosts, recovery.Limits(max_shards=3)).collect()}["a"] == (3, "setting")


def test_dataflow(spark):
    log = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), (None, 9, "n")], "k string, o int, v string")
    assert sorted((r.k, r.v) for r in dataflow.last_wins(log, "k", ["o"]).collect()) == [("a", "y"), ("b", "z")]
    sizes = spark.createDataFrame([("small", 10), ("huge", 9000), ("mid", 500), ("tie_b", 500), ("none", None)], "k string, s int")
    assert [r.k for r in dataflow.biggest_first(sizes, "s", "k").collect()] == ["huge", "mid", "tie_b", "small", "none"]
    ranked = dataflow.ranked(spark.range(0, 5000, 1, 7).withColumn("x", (F.col("id") * 7919) % 5000), [F.col("x")])
    assert all(r.x == r.n for r in ranked.collect())
    bag = lambda *v: spark.createDataFrame([(x,) for x in v], "v string")
    assert [(r.v, r.n) for r in dataflow.bag_difference(bag("a", "a", "b"), bag("a", "b", "c"), ["v"]).collect()] == [("a", 1)]
    native, md = (spark.createDataFrame(rows, "k string, text string") for rows in ([("a", "n"), ("b", "n"), ("c", None)], [("a", "m" * 20), ("b", " m ")]))
    pick = lambda backend: sorted((r.k, r.origin) for r in dataflow.select_source(native, md, "k", backend).collect())
    assert pick("docling") == [("a", "markdown"), ("b", "native"), ("c", "native")] and {o for _, o in pick("native")} == {"native"}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["# A", "text [a](b)", "```", "  ~~~ x", "- item", "| a |", "|---|", "", "![i](j)"]), max_size=9), min_size=5, max_size=20))
def test_content_metrics_against_a_plain_walk(spark, docs):
    df = spark.createDataFrame([(i, "\n".join(d)) for i, d in enumerate(docs)], "k int, t string")
    got = {r.key: (r.headings, r.tables, r.images, r.links, r.lists, r.code_blocks) for r in validation.content_metrics(df, "k", "t").collect()}
    for i, d in enumerate(docs):
        fenced, prose, marks = False, [], 0
        for line in d:
            mark = line.strip().startswith(("```", "~~~"))
            marks += mark
            fenced ^= mark
            prose.append("" if mark or fenced else line)
        tables = sum(a.startswith("|") and b == "|---|" for a, b in zip(prose, prose[1:]))
        assert got[i] == (prose.count("# A"), tables, prose.count("![i](j)"), prose.count("text [a](b)"), prose.count("- item"), marks // 2), d


def test_recovery_rounds(spark):
    tried = []

    def attempt(left):
        rows = left.collect()
        tried.append(sorted((r.doc_id, r.attempts, r.threads, r.mem_gb) for r in rows))
        out = []
        for r in rows:
            fails = {"oom": r.mem_gb < 20, "never": True, "flaky": r.attempts < 2, "input": True, "odd": True}.get(r.doc_id, False)
            log = {"oom": "Killed process 3", "input": "x\nnot a PDF", "never": "[validate] MemoryError"}.get(r.doc_id, "")
            out.append((r.doc_id, None if fails else "# ok", int(fails), False, log, "SUCCESS"))
        return spark.createDataFrame(out, "doc_id string, " + recovery.ATTEMPT)

    docs = spark.createDataFrame([("fine", "pdf", "x"), ("oom", "pdf", "x"), ("never", "pdf", "layer text"), ("flaky", "md", "x"), ("input", "pdf", "x"), ("odd", "docx", "x"), ("fine", "pdf", "x")], "doc_id string, ext string, raw string")
    got = recovery.recover(docs, attempt, lambda rows: rows.select("doc_id", recovery.fallback_body("ext", "raw").alias("body")))
    rows = {r.doc_id: (r.outcome, r.attempts, r.body) for r in got.collect()}
    assert got.count() == 6 and rows == {
        "fine": ("converted", 0, "# ok"), "oom": ("converted", 1, "# ok"), "never": ("fallback", 2, "layer text"), "flaky": ("converted", 2, "# ok"), "input": ("blacklist", 0, None), "odd": ("blacklist", 2, None),
    }
    assert tried[1] == [("flaky", 1, 4, 8.0), ("never", 1, 4, 8.0), ("odd", 1, 4, 8.0), ("oom", 1, 4, 24.0)] and len(tried) == 3
    begun, ended = (spark.createDataFrame([(x,) for x in ids], "doc_id string") for ids in (["a", "b", "b", None], ["a"]))
    assert [r.doc_id for r in recovery.crashed(begun, ended).collect()] == ["b"]
