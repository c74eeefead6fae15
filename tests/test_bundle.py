"""From files to bundles: lanes, gates, restarts, streams, captions and settings."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from foliate import config
from foliate.operators import bundle, captions, figures
from foliate.sources import files, html
from foliate.streaming import ingest
from tests.test_office import doc, p, table, zipped


@pytest.fixture()
def tree(tmp_path):
    root = tmp_path / "src"
    (root / "a b").mkdir(parents=True)
    (root / "a b" / "Spec é.DOCX").write_bytes(zipped(doc(p("Alpha beta") + table([(p("k"), ""), (p("v"), "")], [(p("1"), ""), (p("2"), "")]))))
    (root / "note.md").write_text("# Head\n\nSome *text* here.\n")
    (root / "data.json").write_text('{"a": "```"}\n')
    (root / "page.html").write_text("<html><head><style>x{}</style></head><body><h1>T</h1><p>one <a href='https://e.example'>two</a></p><ul><li>i</li><li>j</li></ul><table><tr><th>a</th></tr><tr><td>1|2</td></tr></table><script>no()</script></body></html>")
    (root / "bad.docx").write_bytes(b"junk")
    (root / "scan.pdf").write_bytes(b"%PDF")
    (root / "flow.tcl").write_text("puts x")
    return root


def test_scan(spark, tree):
    rows = {r.rel: r for r in files.scan_tree(spark, str(tree)).drop("content").collect()}
    assert rows["a b/Spec é.DOCX"].lane == "ooxml" and rows["flow.tcl"].accepted is False and len(rows) == 7
    import hashlib

    assert rows["a b/Spec é.DOCX"].doc_id == hashlib.sha1("a b/Spec é.DOCX".encode()).hexdigest()[:16]


def test_bundles_and_restart(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    rows = {r.source_relpath: r for r in bundle.run_tree(spark, str(tree), out, run="r1").collect()}
    status = {k: r.status for k, r in rows.items()}
    assert status == {"a b/Spec é.DOCX": "ok", "note.md": "ok", "data.json": "ok", "page.html": "ok", "bad.docx": "failed", "scan.pdf": "failed"}
    assert rows["bad.docx"].error == "unreadable-zip" and rows["scan.pdf"].error == "no-text-layer"
    folder = Path(out) / rows["a b/Spec é.DOCX"].doc_id
    report, structure = (json.loads((folder / n).read_text()) for n in ("report.json", "structure.json"))
    assert report["losslessness"]["gate"] == "pass" and report["markdown_sha256"] == structure["markdown_sha256"] == rows["a b/Spec é.DOCX"].markdown_sha256
    assert (folder / "document.md").read_text().startswith("---\ndoc_id: ") and not (Path(out) / rows["bad.docx"].doc_id / "document.md").exists()
    assert "````json\n" in (Path(out) / rows["data.json"].doc_id / "document.md").read_text()
    again = {r.source_relpath for r in bundle.run_tree(spark, str(tree), out).collect()}
    assert again == {"bad.docx", "scan.pdf"}


def test_plugged_converter(spark, tree, monkeypatch):
    monkeypatch.setattr(html, "LAYOUT", {})
    html.register_layout_converter(".pdf", lambda b: {"markdown": "# P\n", "source_text": "P"})
    rows = {r.rel: r for r in bundle.convert(files.scan_tree(spark, str(tree)).where("accepted")).collect()}
    assert rows["scan.pdf"].markdown == "# P\n" and rows["scan.pdf"].error == ""
    assert html.has_text_layer(["x" * 200] * 3) and not html.has_text_layer(["x" * 200] * 20 + [""] * 20) and not html.has_text_layer([])


def test_page_markdown():
    got = html.page_markdown("<body><h2>A*</h2><p>x<br>y</p><ol><li>a<ul><li>b</li></ul></li></ol><pre>c  d</pre><table><tr><td>1</td><td>2</td></tr></table></body>")
    assert got == "## A\\*\n\nx y\n\n1. a\n  - b\n\n```\nc  d\n```\n\n| 1 | 2 |\n| --- | --- |\n"


def test_stream(spark, tree, tmp_path):
    out, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")
    ingest.stream_bundles(spark, str(tree), out, checkpoint).awaitTermination()
    (tree / "late.txt").write_text("late words\n")
    ingest.stream_bundles(spark, str(tree), out, checkpoint).awaitTermination()
    rows = spark.read.parquet(f"{out}/manifest").collect()
    assert len(rows) == 7 and len({r.doc_id for r in rows}) == 7 and {r.batch for r in rows} == {0, 1}


def test_windows_agree_on_stream_and_table(spark, data, tmp_path):
    events = spark.read.parquet(f"{data}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    folder = str(tmp_path / "e")
    events.repartition(1).sortWithinPartitions("ts").write.parquet(folder)
    stream = spark.readStream.schema(events.schema).parquet(folder)
    q = ingest.tumbling(stream, "ts", "event_type").writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda df: sorted((r.start, r.event_type, r.n) for r in df.collect())
    assert key(spark.table("windows")) == key(ingest.tumbling(events, "ts", "event_type")) != []
    assert ingest.sessions(events, "ts", "event_type").agg(F.sum("n")).collect()[0][0] == events.count()
    assert ingest.sliding(events, "ts", "event_type").agg(F.sum("n")).collect()[0][0] == 4 * events.count()


class Mock:
    calls = 0

    def caption(self, image, prompt):
        if image == b"down":
            raise OSError
        return {b"logo": ("A small logo in a corner of the page.", "stop", True), b"x": ("x", "length", True)}.get(image, ("A block diagram of the clock tree with two lanes.", "stop", True))


def test_captions(spark):
    images = spark.createDataFrame([(bytearray(b), "p") for b in (b"logo", b"x", b"fig", b"fig", b"down")], "image binary, prompt string")
    made = captions.caption_images(images, Mock, "m")
    kinds = sorted(r.kind for r in made.collect())
    assert kinds == ["FURNITURE", "OK", "UNAVAILABLE", "USELESS"]
    cache = made.where("kind != 'UNAVAILABLE'")
    again = captions.caption_images(images, Mock, "m", cache)
    assert sorted(r.kind for r in again.collect()) == kinds
    pictures = spark.createDataFrame([("d", "i", 5, 0, 9)], "doc_id string, image_id string, line int, line_start int, line_end int")
    lines = spark.createDataFrame([("d", 4, "before"), ("d", 5, "![](i)"), ("d", 6, "| --- |"), ("d", 7, "after  it"), ("d", 9, "out")], "key string, line int, raw string")
    assert captions.context(pictures, lines).collect()[0].nearby == "before after it"
    assert captions.payload(b"a", "jpg", "t", "m", 5)["messages"][0]["content"][1]["image_url"]["url"] == "data:image/jpeg;base64,YQ=="


def test_pictures(spark, tmp_path):
    png = b"\x89PNG\r\n\x1a\n" + b"\x00\x00\x00\rIHDR" + (40).to_bytes(4, "big") + (30).to_bytes(4, "big")
    gif, bmp = b"GIF89a" + (7).to_bytes(2, "little") + (5).to_bytes(2, "little"), b"BM" + bytes(16) + (9).to_bytes(4, "little") + (-8).to_bytes(4, "little", signed=True)
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08\x00\x10\x00\x20\x01\x01"
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate([png, gif, bmp, jpeg, b"<?xml?><svg/>", b"none", b""])], "i int, b binary")
    got = [(r.f, r.s.width, r.s.height) for r in df.orderBy("i").select(figures.sniff("b").alias("f"), figures.image_size("b").alias("s")).collect()]
    assert got == [("png", 40, 30), ("gif", 7, 5), ("bmp", 9, 8), ("jpeg", 32, 16), ("svg", None, None), ("", None, None), ("", None, None)]
    assets = spark.createDataFrame([("6e340b9cffb37a98.png", bytearray(b"\x00")), ("x.png", bytearray(b"\x00"))], "file string, bytes binary")
    assert [r.intact for r in bundle.verify_assets(assets).collect()] == [True, False]


def test_settings(tmp_path):
    f = tmp_path / "c.toml"
    f.write_text('[paths]\nsource_docs = "/s"\n[ingest]\nmin_recall = 0.5\nmax_shards = "x"\n')
    s = config.load({"FOLIATE_MIN_RECALL": "0.7", "FOLIATE_ENABLE_CAPTIONS": "Yes", "FOLIATE_ACCEPT_FORMATS": "pdf,docx", "FOLIATE_VLM_MAX_TOKENS": "0"}, f)
    assert (s.min_recall, s.max_shards, s.enable_captions, s.accept_formats, s.vlm_max_tokens, s.source_docs) == (0.7, 0, True, ("docx", "pdf"), 8192, "/s")
    with pytest.raises(ValueError):
        config.load({"FOLIATE_BACKEND": "other"})


PNG = b"\x89PNG\r\n\x1a\n" + b"\x00\x00\x00\rIHDR" + (1).to_bytes(4, "big") * 2
REL = '<Relationship Id="{0}" Type="x/image" Target="media/{1}"/>'


def pictured(targets, media, text="Some words about a figure"):
    body = p("First heading", '<w:outlineLvl w:val="0"/>') + p(text) + "".join(f'<w:p><a:blip r:embed="i{n}"/></w:p>' for n in range(len(targets)))
    rels = "<Relationships>" + "".join(REL.format(f"i{n}", t) for n, t in enumerate(targets)) + "</Relationships>"
    return zipped(doc(body) | {"word/_rels/document.xml.rels": rels} | {f"word/media/{k}": v for k, v in media.items()})


def bundle_of(out, row):
    folder = Path(out) / row.doc_id
    report, structure = (json.loads((folder / n).read_text()) for n in ("report.json", "structure.json"))
    files_ = {f.name: f.read_bytes() for f in (folder / "images").iterdir()} if (folder / "images").exists() else {}
    return report, structure, (folder / "document.md").read_text(), files_


def test_pictures_in_bundles(spark, tmp_path):
    import hashlib
    import re

    root, out = tmp_path / "s", str(tmp_path / "o")
    root.mkdir()
    (root / "two.docx").write_bytes(pictured(["a.png", "b.gif"], {"a.png": PNG, "b.gif": b"GIF89a...."}))
    (root / "twice.docx").write_bytes(pictured(["a.png", "a.png", "same.png"], {"a.png": PNG, "same.png": PNG}))
    (root / "gap.docx").write_bytes(pictured(["a.png", "ghost.png"], {"a.png": PNG}))
    rows = {r.source_relpath: r for r in bundle.run_tree(spark, str(root), out, run="r1").collect()}
    assert {k: r.status for k, r in rows.items()} == {"two.docx": "ok", "twice.docx": "ok", "gap.docx": "degraded"}
    for name, referenced, unique, missing in (("two.docx", 2, 2, 0), ("twice.docx", 3, 1, 0), ("gap.docx", 1, 1, 1)):
        report, structure, text, stored = bundle_of(out, rows[name])
        block = report["images"]
        assert (block["referenced"], block["unique_files"], block["missing"], block["verified"], block["orphans"]) == (referenced, unique, missing, unique, 0)
        assert block["gate"] == ("degraded" if missing else "pass") and report["losslessness"]["gate"] == "pass" and "ooxml-image" not in text
        assert set(re.findall(r"\(images/([^)]+)\)", text)) == set(stored) == {hashlib.sha256(b).hexdigest()[:16] + "." + f.split(".")[1] for f, b in stored.items()}
        entries = list(bundle.pictures_in(structure["outline"]))
        assert len(entries) == referenced and all(e["caption"] is None for e in entries)
        assert report["captions"] == bundle.caption_block(False, unique, 0) and any(w["code"] == "image_bytes_missing" for w in report["warnings"]) == bool(missing)

    # a rebuild removes what is no longer shown and carries captions of what stays
    at = Path(out) / rows["two.docx"].doc_id
    structure = json.loads((at / "structure.json").read_text())
    for e in bundle.pictures_in(structure["outline"]):
        e["caption"] = f"about {e['image_id']}"
    (at / "structure.json").write_text(json.dumps(structure))
    (root / "two.docx").write_bytes(pictured(["a.png"], {"a.png": PNG}))
    (again,) = [r for r in bundle.run_tree(spark, str(root), out, run="r2", force=True).collect() if r.source_relpath == "two.docx"]
    report, structure, _, stored = bundle_of(out, again)
    (entry,) = bundle.pictures_in(structure["outline"])
    assert entry["caption"] == f"about {entry['image_id']}" and len(stored) == 1 and report["captions"]["captioned"] == 1
    assert [w["code"] for w in report["warnings"]] == ["orphan_images_removed"]


def test_gates_of_blocks_are_those_of_columns(spark):
    from itertools import product

    from foliate.operators import validation

    cases = list(product((0, 1, 2), repeat=3))
    rows = spark.createDataFrame([(r, m, o) for r, m, o in cases], "r int, m int, o int")
    c, lit = F.col, F.lit
    got = {(x.r, x.m, x.o): x.g for x in rows.select("*", validation.image_gate(c("r"), lit(2) - c("m"), lit(1), c("m"), c("o"), lit(1)).alias("g")).collect()}
    assert got == {(r, m, o): bundle.picture_block(r, 2 - m, 1, m, o, 1)["gate"] for r, m, o in cases}
    for enabled in (True, False):
        got = {(x.r, x.m, x.o): x.g for x in rows.select("*", validation.caption_gate(lit(enabled), lit(4), c("r"), c("m"), lit(0), lit(4) - c("r") - c("m")).alias("g")).collect()}
        assert got == {(r, m, o): bundle.caption_block(enabled, 4, r, m)["gate"] for r, m, o in cases}


def test_one_scan(spark, tree):
    plan = bundle.convert(files.scan_tree(spark, str(tree)).where("accepted"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan binaryFile") == 1


class Describer:
    """Knows one picture only; the other can't be had."""

    def caption(self, image, prompt):
        if image != PNG:
            raise OSError
        assert "Some words about a figure" in prompt and "First heading" in prompt
        return "A block diagram of the clock tree with two lanes.", "stop", True


class Both(Describer):
    def caption(self, image, prompt):
        return ("A small company logo in the corner.", "stop", True) if image != PNG else super().caption(image, prompt)


class Never:
    def caption(self, image, prompt):
        raise AssertionError("nothing is left to ask")


def test_captions_of_bundles(spark, tmp_path):
    root, out = tmp_path / "s", str(tmp_path / "o")
    root.mkdir()
    (root / "two.docx").write_bytes(pictured(["a.png", "b.gif"], {"a.png": PNG, "b.gif": b"GIF89a...."}))
    (row,) = bundle.run_tree(spark, str(root), out).collect()
    before = bundle_of(out, row)
    for factory, want in ((Describer, (2, 1, 0, 0, 1, "incomplete")), (Both, (2, 1, 1, 0, 0, "complete")), (Never, (2, 1, 1, 0, 0, "complete"))):
        (got,) = captions.caption_bundles(spark, out, factory, "m", "Describe the figure.").collect()
        assert tuple(got)[1:] == want
    report, structure, text, stored = bundle_of(out, row)
    assert sorted(e["caption"] or "" for e in bundle.pictures_in(structure["outline"])) == ["", "A block diagram of the clock tree with two lanes."]
    assert text == before[2] and stored == before[3] and report["captions"]["model"] == "m" and {k: v for k, v in report.items() if k != "captions"} == {k: v for k, v in before[0].items() if k != "captions"}


def test_chat_service():
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Service(BaseHTTPRequestHandler):
        def _send(self, value):
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(value).encode())

        def do_GET(self):
            self._send({"data": [{"id": "m"}]})

        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            assert asked["messages"][0]["content"][1]["image_url"]["url"].startswith("data:image/gif;base64,")
            self._send({"choices": [{"message": {"content": "", "reasoning_content": " a chart "}, "finish_reason": "length"}]})

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    client = captions.ChatCaptioner(f"http://127.0.0.1:{server.server_port}", "m", seconds=5)
    assert client.healthy() and not captions.ChatCaptioner(client.url, "other", seconds=5).healthy()
    assert client.caption(b"GIF89a", "p") == ("a chart", "length", True) and captions.reply_of({}) == ("", "", False)
    server.shutdown()
    assert not captions.ChatCaptioner("http://127.0.0.1:9", "m", seconds=1).healthy()


def test_scan_and_audit(spark, tmp_path):
    root, out = tmp_path / "s", str(tmp_path / "o")
    root.mkdir()
    (root / "two.docx").write_bytes(pictured(["a.png", "b.gif"], {"a.png": PNG, "b.gif": b"GIF89a...."}))
    (root / "note.md").write_text("# Head\n\nSome words.\n")
    (root / "bad.docx").write_bytes(b"junk")
    ids = {r.source_relpath: r.doc_id for r in bundle.run_tree(spark, str(root), out).collect()}
    assert bundle.scan(spark, out).count() == 3 and bundle.audit(bundle.scan(spark, out)).count() == 0
    two, note = Path(out) / ids["two.docx"], Path(out) / ids["note.md"]
    first, second = sorted((two / "images").iterdir())
    first.write_bytes(b"other")
    second.rename(second.with_name("0123456789abcdef.gif"))
    (note / "document.md").write_text((note / "document.md").read_text() + "more\n")
    got = {r.doc_id: set(r.problems) for r in bundle.audit(bundle.scan(spark, out)).collect()}
    assert got == {ids["two.docx"]: {"picture-bytes", "missing-picture", "orphan-picture"}, ids["note.md"]: {"report-hash", "structure-hash", "document-hash"}}
    (note / "structure.json").unlink()
    assert "incomplete" in bundle.audit(bundle.scan(spark, out)).where(F.col("doc_id") == ids["note.md"]).collect()[0].problems


def test_pdf_text_layer(spark, tmp_path):
    from foliate.sources import fixtures, pdf

    pages = [["Header of all", "The first (page) \\ é 漢字", "", "two  blanks"], ["Header of all", "second page"], ["Header of all"]]
    for packed in (False, True):
        data = fixtures.pdf(pages, "Tïtle", packed)
        assert pdf.text_pages(data) == ["\n".join(p) for p in pages] and pdf.info(data) == {"title": "Tïtle", "pages": "3"}
        assert pdf.convert(data)["markdown"] == "The first (page) \\ é 漢字\n\ntwo  blanks\n\nsecond page\n"
    plain = b"%PDF-1.4\n1 0 obj<</Type/Pages/Kids[2 0 R 1 0 R 9 0 R]>>endobj 2 0 obj<</Parent 1 0 R/Contents[3 0 R]/Resources<</Font<</F 4 0 R>>>>>>endobj 4 0 obj<</Subtype/Type1>>endobj 3 0 obj<</Length 5 0 R>>stream\nBT /F 10 Tf 1 0 0 1 50 700 Tm (A\\(b\\)\\101) Tj 30 0 Td (far) Tj 0 -14 Td [(k)-20(ern)-900(ed)] TJ T* <414243> Tj ET\nendstream endobj 5 0 obj 200 endobj"
    assert pdf.text_pages(plain)[0].split("\n") == ["A(b)A far", "kern edABC"]
    for bad in (None, b"", b"%PDF", b"junk", plain[:200], b"%PDF-1.4 trailer<</Encrypt 1 0 R>>" + plain):
        assert not "".join(pdf.text_pages(bad)).strip()
    root, out = tmp_path / "s", str(tmp_path / "o")
    root.mkdir()
    (root / "a.pdf").write_bytes(fixtures.pdf(pages, "T"))
    (row,) = bundle.run_tree(spark, str(root), out).collect()
    report = json.loads((Path(out) / row.doc_id / "report.json").read_text())
    assert row.status in ("ok", "degraded") and report["losslessness"]["gate"] == "best-effort" and 'source_title: "T"' in (Path(out) / row.doc_id / "document.md").read_text()


def test_flat_files_and_coverage_log(spark, tree, tmp_path):
    from foliate.operators.dataflow import last_wins

    made = bundle.convert(files.scan_tree(spark, str(tree)).where("accepted"))
    rows = {r.doc_id: r for r in bundle.write_flat(made, str(tmp_path / "flat")).collect()}
    assert sorted(p.name for p in (tmp_path / "flat").iterdir()) == sorted(r.file for r in rows.values() if r.file) and sum(r.file is None for r in rows.values()) == 2
    assert {r.doc_id for r in files.markdown_files(spark, str(tmp_path / "flat")).collect()} == {k for k, r in rows.items() if r.file}
    log = str(tmp_path / "log")
    assert bundle.append_coverage(made, log).count() == len(rows) == bundle.append_coverage(made, log).count()
    last = {r.rel: r for r in last_wins(spark.read.parquet(log), "id", ["ts", "run"]).collect()}
    assert len(last) == len(rows) and last["note.md"].recall == 1.0 and last["note.md"].valid and not last["bad.docx"].valid and last["bad.docx"].error == "unreadable-zip"
    lossy = spark.createDataFrame([("i", "r", "docx", "ooxml", "one two\n", "one two three three " + "four " * 60, "")], "doc_id string, rel string, ext string, lane string, markdown string, source_text string, error string")
    (r,) = bundle.coverage_records(lossy).collect()
    assert (r.n_source, r.n_covered, r.n_missing, r.valid) == (64, 2, 62, False) and [tuple(x) for x in r.missing_top] == [("four", 60), ("three", 2)]
