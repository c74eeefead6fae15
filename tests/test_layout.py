"""Layout measurement, picture assets, SQL functions, older formats and token counters."""

import pytest
from pyspark.sql import functions as F

from foliate.functions import counters
from foliate.operators import assets, layout
from foliate.plans import sql
from foliate.sources import html, legacy
from tests.test_office import doc, p, zipped


def test_text_layer_probe(spark):
    full, thin = "x" * 150, " "
    rows = [("a", i, full) for i in range(3)] + [("b", i, full if i < 15 else thin) for i in range(25)] + [("c", 0, thin)] + [("d", 0, "  " + "y" * 80 + "  "), ("d", 1, "y" * 130)]
    got = {r.doc_id: r.has_text for r in layout.text_layer_probe(spark.createDataFrame(rows, "doc_id string, page_no int, text string")).collect()}
    assert got == {"a": True, "b": False, "c": False, "d": True}
    one = lambda mode, ext, has: spark.range(1).select(layout.needs_ocr(mode, F.lit(ext), F.lit(has))).collect()[0][0]
    assert one("auto", "pdf", False) and not one("auto", "pdf", True) and not one("on", "html", False) and one("on", "pdf", True) and not one("off", "pdf", False)


def test_losslessness_and_fallback(spark):
    text = " ".join(f"word{i} token{i}" for i in range(80))
    rows = spark.createDataFrame([("ok", text, text, "", ""), ("lost", text, "word1", "", ""), ("furn", text + " runhead foot", text, "runhead", "foot"), ("tiny", "a b", "", None, None)], "doc_id string, layer string, markdown string, furniture string, image_text string")
    got = {r.doc_id: r for r in layout.losslessness(rows).collect()}
    assert got["ok"].token_recall == got["furn"].token_recall == 1.0 and got["lost"].lossy and not got["tiny"].lossy and got["lost"].unexplained > 0.5 and got["ok"].gate == "best-effort"
    fell = {r.doc_id: (r.fell_back, r.markdown == text) for r in layout.with_fallback(rows).collect()}
    assert fell["lost"] == (True, True) and fell["ok"] == (False, True) and fell["tiny"][0] is False
    valid = lambda *a: spark.range(1).select(layout.is_valid(*map(F.lit, a))).collect()[0][0]
    assert valid("SUCCESS", True, False, True) and not valid("partial_success", True, False, True) and valid("PASSTHROUGH", True, True, False) and not valid("SUCCESS", True, False, False)


def test_region_text(spark):
    words = spark.createDataFrame([("d", 1, 0, "in", 0.2, 0.2, 0.3, 0.24), ("d", 1, 1, "out", 0.8, 0.8, 0.9, 0.84), ("d", 1, 2, "edge", 0.1, 0.1, 0.5, 0.5)], "doc_id string, page int, pos int, word string, x0 double, y0 double, x1 double, y1 double")
    boxes = spark.createDataFrame([("d", 1, 0, 0.15, 0.15, 0.55, 0.55), ("d", 1, 1, 0.0, 0.0, 0.31, 0.31)], "doc_id string, page int, box int, x0 double, y0 double, x1 double, y1 double")
    assert layout.region_text(words, boxes).collect()[0].text == "in edge in edge"


def test_assets(spark):
    md = "<!-- ooxml-image:a.png --> x <!-- ooxml-image:b.PNG --> <!-- ooxml-image:a.png --> <!-- ooxml-image:gone.png -->"
    docs = spark.createDataFrame([("d", md), ("e", "no pictures")], "doc_id string, markdown string")
    media = spark.createDataFrame([("d", "a.png", bytearray(b"1")), ("d", "b.PNG", bytearray(b"1")), ("d", "gone.png", bytearray(b""))], "doc_id string, part string, bytes binary")
    planned = assets.plan(docs, media)
    summary = assets.plan_summary(planned).collect()[0]
    assert (summary.n_referenced, summary.n_resolved, summary.n_files, summary.n_missing) == (4, 3, 1, 1)
    name = "6b86b273ff34fce1.png"
    got = {r.doc_id: r.markdown for r in assets.filled(docs, planned).collect()}
    assert got == {"d": f"![](images/{name}) x ![](images/{name}) ![](images/{name}) ", "e": "no pictures"}
    files = spark.createDataFrame([("d", name), ("d", "0123456789abcdef.png"), ("d", "notes.txt")], "doc_id string, file string")
    assert [r.file for r in assets.orphans(files, planned).collect()] == ["0123456789abcdef.png"]
    figures = spark.createDataFrame([("e", 2, "second", "b"), ("e", 1, "first", "a")], "doc_id string, seq int, caption string, path string")
    once = assets.with_figures_section(docs, figures)
    twice = assets.with_figures_section(once, figures)
    text = {r.doc_id: r.markdown for r in once.collect()}["e"]
    assert text == "no pictures\n\n## Figures (captioned images)\n\n![first](a)\n\n![second](b)\n" == {r.doc_id: r.markdown for r in twice.collect()}["e"]


def test_sql_functions(spark):
    sql.register(spark)
    spark.createDataFrame([("d", "# A\ntext\n### B\n")], "doc_id string, body string").createOrReplaceTempView("docs")
    assert spark.sql("select o.title from docs, lateral outline_nodes(body) o order by o.id").collect() == [("A",), ("B",)]
    assert spark.sql("select c.level from docs, lateral chunk_sections(doc_id, body) c").collect() == [(1,)]
    assert spark.sql("select i.code from docs, lateral md_issues(body) i").collect() == [("heading-jump",)]
    assert spark.sql("select markdown_to_text(body), tokenize(body), document_id('a') from docs").collect() == [("A\ntext\nB", ["a", "text", "b"], "86f7e437faa5a7fc")]
    content = zipped(doc(p("x")))
    spark.createDataFrame([(bytearray(content),)], "c binary").createOrReplaceTempView("zips")
    assert spark.sql("select u.part from zips, lateral unzip_parts(c, 'docx') u").collect() == [("word/document.xml",)]


def test_legacy(monkeypatch, tmp_path):
    monkeypatch.setattr(html, "LAYOUT", {})
    assert legacy.to_package("", b"x", "doc") == b"" and legacy.to_package("/no/such", b"x", "doc") == b"" and not legacy.register("")
    program = tmp_path / "office"
    package = tmp_path / "made.docx"
    package.write_bytes(zipped(doc(p("converted"))))
    program.write_text(f'#!/bin/sh\nfor a; do last=$a; done\ncp {package} "$(dirname "$last")/in.docx"\n')
    program.chmod(0o755)
    assert legacy.register(str(program)) and html.LAYOUT["doc"](b"x")["markdown"] == "converted\n"


def test_counters():
    assert counters.token_counter() == (None, counters.ESTIMATE) and counters.token_counter(len)[0]("abc") == 3
    count, label = counters.token_counter("tokenizers:/opt/tokenizers/byte_bpe_50k.json")
    assert count("a b") == 2 and label.startswith("tokenizers:")
    with pytest.raises(ValueError):
        counters.token_counter("nothing:x")
