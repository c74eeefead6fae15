"""Office packages: structure of the Markdown, independence of the ground truth, damage."""

import io
import zipfile

import pytest

from foliate.functions.markdown import to_text
from foliate.operators.recall import explain
from foliate.plans import document_queries
from foliate.sources import office

W = 'xmlns:w="http://w" xmlns:r="http://r" xmlns:a="http://a"'


def doc(body, **parts):
    return {"word/document.xml": f"<w:document {W}><w:body>{body}</w:body></w:document>", **{k.replace("__", "/") + ".xml": v for k, v in parts.items()}}


def p(text, props=""):
    return f"<w:p><w:pPr>{props}</w:pPr><w:r><w:t>{text}</w:t></w:r></w:p>"


def table(*rows):
    return "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc><w:tcPr>{pr}</w:tcPr>{t}</w:tc>" for t, pr in r) + "</w:tr>" for r in rows) + "</w:tbl>"


def md(parts, ext="docx", images=False):
    return office.markdown_of(ext, parts, images)


def style(name, shown, level=None):
    outline = "" if level is None else f'<w:pPr><w:outlineLvl w:val="{level}"/></w:pPr>'
    return f'<w:style w:styleId="{name}"><w:name w:val="{shown}"/>{outline}</w:style>'


STYLES = f"<w:styles {W}>" + style("Kapitel", "heading 1") + style("Abschnitt", "Heading 2") + style("Randnotiz", "side note", 2) + style("Deckblatt", "Title") + "</w:styles>"


def test_headings_runs_and_links():
    parts = doc(p("A", '<w:pStyle w:val="Kapitel"/>') + p("B", '<w:pStyle w:val="Abschnitt"/>') + p("C", '<w:pStyle w:val="Randnotiz"/>') + p("D", '<w:pStyle w:val="Deckblatt"/>') + "<w:p><w:r><w:t>volt</w:t></w:r><w:r><w:t>age</w:t></w:r><w:r><w:t>Mon7</w:t></w:r></w:p>", word__styles=STYLES)
    assert md(parts) == "# A\n\n## B\n\n### C\n\n# D\n\nvoltageMon7\n"
    linked = doc('<w:p><w:hyperlink r:id="r1"><w:r><w:t>here</w:t></w:r></w:hyperlink></w:p>')
    linked["word/_rels/document.xml.rels"] = '<Relationships><Relationship Id="r1" Type="x/hyperlink" Target="https://a.example/b" TargetMode="External"/></Relationships>'
    assert md(linked) == "[here](https://a.example/b)\n"


def test_lists():
    kinds = {31: ["bullet", "bullet"], 44: ["decimal"]}
    levels = lambda formats: "".join(f'<w:lvl w:ilvl="{i}"><w:numFmt w:val="{x}"/></w:lvl>' for i, x in enumerate(formats))
    abstract = "".join(f'<w:abstractNum w:abstractNumId="{k}">{levels(v)}</w:abstractNum>' for k, v in kinds.items())
    numbering = f"<w:numbering {W}>" + abstract + "".join(f'<w:num w:numId="{n}"><w:abstractNumId w:val="{k}"/></w:num>' for n, k in ((8, 31), (9, 44))) + "</w:numbering>"
    item = lambda t, n, lv: p(t, f'<w:numPr><w:ilvl w:val="{lv}"/><w:numId w:val="{n}"/></w:numPr>')
    assert md(doc(item("a", 8, 0) + item("b", 8, 1) + item("step", 9, 0) + item("no list", 0, 0), word__numbering=numbering)) == "- a\n  - b\n1. step\n\nno list\n"


def test_tables():
    assert md(doc(table([(p("a|b"), ""), (p("c"), "")], [(p("1") + p("2"), ""), (p("x"), "")]))) == "| a\\|b | c |\n| --- | --- |\n| 1<br>2 | x |\n"
    span = table([(p("wide"), '<w:gridSpan w:val="2"/>'), (p("z"), "")], [(p("1"), ""), (p("2"), ""), (p("3"), "")])
    assert md(doc(span)).startswith("| wide |  | z |\n")
    merged = table([(p("m"), '<w:vMerge w:val="restart"/>'), (p("1"), "")], [("<w:p/>", "<w:vMerge/>"), (p("2"), "")], [(p("own"), "<w:vMerge/>"), (p("3"), "")], [("<w:p/>", ""), (p("4"), "")])
    assert md(doc(merged)) == "| m | 1 |\n| --- | --- |\n| m | 2 |\n| own | 3 |\n|  | 4 |\n"
    assert md(doc(table([(p("framed"), "")]))) == "framed\n"


def test_escapes_notes_and_pictures():
    parts = doc(p("1. not a list *x*") + '<w:p><a:blip r:embed="r2"/></w:p>', word__footnotes=f"<w:footnotes {W}><w:footnote><w:p><w:r><w:t>note</w:t></w:r></w:p></w:footnote></w:footnotes>")
    parts["word/_rels/document.xml.rels"] = '<Relationships><Relationship Id="r2" Type="x/image" Target="media/i.png"/></Relationships>'
    assert md(parts, images=True) == "1\\. not a list \\*x\\*\n\n<!-- ooxml-image:word/media/i.png -->\n\n## Footnotes\n\n- note\n"
    assert md(parts) == "1\\. not a list \\*x\\*\n\n## Footnotes\n\n- note\n"


def slide(n, title, body):
    shape = lambda kind, t: f'<p:sp><p:nvPr><p:ph type="{kind}"/></p:nvPr><p:txBody><a:p><a:r><a:t>{t}</a:t></a:r></a:p></p:txBody></p:sp>'
    return {f"ppt/slides/slide{n}.xml": f'<p:sld xmlns:p="http://p" xmlns:a="http://a">{shape("title", title)}{shape("body", body)}{shape("sldNum", "77")}</p:sld>'}


def test_slides():
    parts = slide(10, "ten", "x") | slide(2, "two", "y") | slide(1, "one", "z")
    parts["ppt/notesSlides/notesSlide1.xml"] = '<p:notes xmlns:p="http://p" xmlns:a="http://a"><p:sp><p:txBody><a:p><a:r><a:t>say</a:t></a:r></a:p></p:txBody></p:sp></p:notes>'
    assert md(parts, "pptx") == "## Slide 1 — one\n\n- z\n\n### Speaker notes\n\n- say\n\n## Slide 2 — two\n\n- y\n\n## Slide 10 — ten\n\n- x\n"
    assert "77" not in office.source_text_of("pptx", parts)


def test_sheets():
    parts = {
        "xl/workbook.xml": '<workbook xmlns:r="http://r"><sheets><sheet name="S" r:id="a"/><sheet name="Gone" r:id="b"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="a" Target="worksheets/sheet1.xml"/><Relationship Id="b" Target="worksheets/none.xml"/></Relationships>',
        "xl/sharedStrings.xml": "<sst><si><t>head</t></si><si><r><t>ri</t></r><r><t>ch</t></r></si></sst>",
        "xl/worksheets/sheet1.xml": '<worksheet><sheetData><row><c r="B1" t="s"><v>0</v></c><c r="D1" t="s"><v>1</v></c></row><row><c r="B2" t="b"><v>1</v></c><c r="D2"><f>1+1</f><v>2.50</v></c><c t="inlineStr"><is><t>in</t></is></c></row></sheetData></worksheet>',
    }
    assert md(parts, "xlsx") == "## S\n\n|  | head |  | rich |  |\n| --- | --- | --- | --- | --- |\n|  | TRUE |  | 2.50 | in |\n\n## Gone\n"


def test_every_token_survives():
    parts = doc(p("Alpha *beta* 1) gamma") + table([(p("k|1"), ""), (p("v_2"), "")], [(p("3"), ""), (p("4"), "")]) + p("<![CDATA[a [b](c) <d>]]>"))
    counts, _ = explain(office.source_text_of("docx", parts), to_text(md(parts)))
    assert counts[0] == counts[1] > 0


def zipped(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for k, v in parts.items():
            z.writestr(k, v)
    return out.getvalue()


@pytest.mark.parametrize(
    "content, error",
    [(b"", "empty-source-file"), (b"junk", "unreadable-zip"), (zipped({"word/document.xml": "<w"}), "malformed-content-part:word/document.xml"), (zipped(doc("")), "empty-conversion"), (zipped(doc(p("x"))), "")],
)
def test_damage(content, error):
    assert office.convert_package(content, "docx")["error"] == error


def test_rows(spark):
    core = '<cp:coreProperties xmlns:cp="http://c" xmlns:dc="http://d"><dc:title>T &amp; U</dc:title><dc:creator>Me</dc:creator></cp:coreProperties>'
    content = zipped(doc(p("x")) | {"docProps/core.xml": core, "word/media/i.png": "\x89PNG", "word/_rels/document.xml.rels": '<R><Relationship Type="a/image" Target="media/i.png"/></R>', "word/_rels/header1.xml.rels": '<R><Relationship Type="a/image" Target="media/i.png"/><Relationship Type="a/image" Target="media/h.png"/></R>'})
    files = spark.createDataFrame([("d", bytearray(content), "docx"), ("n", None, "docx")], "doc_id string, content binary, ext string")
    rows = {r.doc_id: r.c for r in files.select("doc_id", office.convert_office("content", "ext").alias("c")).collect()}
    assert rows["d"].markdown == "x\n" and rows["d"].properties == {"title": "T & U", "author": "Me"} and rows["n"].error == "empty-source-file"
    media = office.package_entries(files, office.MEDIA.pattern).collect()
    assert [(r.doc_id, r.part) for r in media] == [("d", "word/media/i.png")]
    rels = {r.part: bytes(r.bytes).decode() for r in office.package_entries(files, r".*\.rels").collect()}
    assert office.placements(rels) == {"word/media/i.png": "body", "word/media/h.png": "chrome"}


def test_packages_pass_in_one_step(spark, tmp_path):
    """One Python step holds one package at a time, and converts each once."""
    made = {
        "plain": "# A b\n\ntext with _marks_ and |\n- one\n- two\n![](images/x.png)\n![](images/x.png)\n| a\\|b | c |\n| --- | --- |\n| d | |",
        "none": None,
        "blank": "\n\n",
        "odd": "# \x0b\n#\xa0no\n# é\n>q\n1) z\n\x01 <&> ```\n- \xa0x",
        None: "- x",
    }
    spark.createDataFrame(list(made.items()), "doc_id string, body_md string").write.parquet(f"{tmp_path}/document_md.parquet")
    df = document_queries.office_documents(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan
    rows = {r.doc_id: tuple(r)[1:] for r in df.collect()}
    assert rows == {
        "plain": ("", "plain", True, 1, 2, 2, True),
        "none": ("empty-conversion", "none", True, 0, 0, 0, False),
        "blank": ("empty-conversion", "blank", True, 0, 0, 0, False),
        "odd": ("", "odd", True, 1, 0, 0, False),
        None: ("", None, True, 0, 1, 0, False),
    }


def test_trees_are_parsed_once_or_not_kept(monkeypatch):
    parts, parsed = doc(p("x") + table([(p("a"), ""), (p("b"), "")])) | {"word/comments.xml": f"<w:comments {W}>{p('n')}</w:comments>"}, []
    parse = office.parse
    monkeypatch.setattr(office, "parse", lambda xml: parsed.append(xml) or parse(xml))
    once = office.convert_package(zipped(parts), "docx")
    assert len(set(filter(None, parsed))) == len(list(filter(None, parsed)))
    monkeypatch.setattr(office, "KEPT_CHARS", 0)
    assert office.convert_package(zipped(parts), "docx") == once and len(list(filter(None, parsed))) > 2 * len(parts)
