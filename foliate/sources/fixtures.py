"""Office packages made from Markdown-like lines: whole test corpora of any size, with styles, lists, tables and pictures.

A line becomes a heading (by style), a list item (by numbering), a table's row, a picture (by relationship) or a plain
paragraph. Characters that XML can't hold become U+FFFD. The same lines always give the same bytes.
"""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from itertools import groupby
from xml.sax.saxutils import escape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliate.functions.markdown import to_text
from foliate.operators import recall
from foliate.sources import office

_NAMES = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'
_unfit = re.compile("[^\t\n\r\x20-퟿-�\U00010000-\U0010ffff]")
_heading, _item, _row, _rule = re.compile(r"(#{1,6}) +(\S.*)"), re.compile(r"- (\S.*)"), re.compile(r"\|.*\|"), re.compile(r"[|:\- ]+")
_picture = re.compile(r"!\[[^\]]*\]\(images/([^)\s]+)\)")


def _run(text: str) -> str:
    kept = ' xml:space="preserve"' if text != text.strip() else ""
    return f"<w:r><w:t{kept}>{escape(text)}</w:t></w:r>"


def _paragraph(text: str, properties: str = "") -> str:
    return f"<w:p>{properties and f'<w:pPr>{properties}</w:pPr>'}{_run(text)}</w:p>"


def _kind(line: str) -> str:
    return "row" if line[:1] == "|" and _row.fullmatch(line) else "line"


def docx(lines: list[str], title: str = "") -> bytes:
    """A word-processing package of the lines; a picture's bytes are made from its name."""
    body, pictures = [], []
    for kind, group in groupby(lines, _kind):
        if kind == "row":
            rows = [r.strip("|").split("|") for r in group if not _rule.fullmatch(r)]
            cells = ("".join(f"<w:tc>{_paragraph(c.strip())}</w:tc>" for c in r) for r in rows)
            body.append("<w:tbl>" + "".join(f"<w:tr>{c}</w:tr>" for c in cells) + "</w:tbl>" if rows else "")
            continue
        for line in group:
            sign = line[:1]
            if sign == "#" and (m := _heading.fullmatch(line)):
                body.append(_paragraph(m[2], f'<w:pStyle w:val="Level{len(m[1])}"/>'))
            elif sign == "-" and (m := _item.fullmatch(line)):
                body.append(_paragraph(m[1], '<w:numPr><w:ilvl w:val="0"/><w:numId w:val="1"/></w:numPr>'))
            elif sign == "!" and (m := _picture.fullmatch(line)):
                pictures.append(m[1])
                body.append(f'<w:p><w:r><w:drawing><a:blip r:embed="p{len(pictures)}"/></w:drawing></w:r></w:p>')
            elif line.strip():
                body.append(_paragraph(line))
    styles = "".join(f'<w:style w:styleId="Level{n}"><w:name w:val="heading {n}"/></w:style>' for n in range(1, 7))
    numbering = '<w:abstractNum w:abstractNumId="0"><w:lvl w:ilvl="0"><w:numFmt w:val="bullet"/></w:lvl></w:abstractNum><w:num w:numId="1"><w:abstractNumId w:val="0"/></w:num>'
    links = "".join(f'<Relationship Id="p{i}" Type="x/image" Target="media/{escape(name)}"/>' for i, name in enumerate(pictures, 1))
    parts = {
        "word/document.xml": f"<w:document {_NAMES}><w:body>{''.join(body)}</w:body></w:document>",
        "word/styles.xml": f"<w:styles {_NAMES}>{styles}</w:styles>",
        "word/numbering.xml": f"<w:numbering {_NAMES}>{numbering}</w:numbering>",
        "word/_rels/document.xml.rels": f"<Relationships>{links}</Relationships>",
        "docProps/core.xml": f'<cp:coreProperties xmlns:cp="http://c" xmlns:dc="http://d"><dc:title>{escape(title)}</dc:title></cp:coreProperties>',
    }
    unfit = _unfit.search("\n".join((title, *lines)))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in parts.items():
            z.writestr(zipfile.ZipInfo(name), _unfit.sub("�", content) if unfit else content)
        for name in dict.fromkeys(pictures):
            z.writestr(zipfile.ZipInfo(f"word/media/{name}"), b"\x89PNG\r\n\x1a\n" + name.encode())
    return out.getvalue()


@F.pandas_udf(T.BinaryType())
def docx_of(text: pd.Series, title: pd.Series) -> pd.Series:
    """A package of each text's lines."""
    return pd.Series([docx((t or "").split("\n"), n or "") for t, n in zip(text, title)])


_shown = {"headings": re.compile(r"#{1,6} +\S", re.ASCII), "items": re.compile(r"- \S", re.ASCII)}
TRIP = {"error": pa.string(), "title": pa.string(), "lossless": pa.bool_(), "headings": pa.int64(), "items": pa.int64(), "pictures": pa.int64(), "stored": pa.bool_()}


def docx_trip(text: str | None, title: str | None) -> dict:
    """What of a text's lines comes through a package and back."""
    made = office.convert_package(docx((text or "").split("\n"), title or ""), "docx")
    gap = dict(zip(recall.GAP_FIELDS, recall.explain(made["source_text"], to_text(made["markdown"]))[0]))
    lines, pictures = made["markdown"].split("\n"), made["pictures"]
    return {
        "error": made["error"],
        "title": made["properties"].get("title"),
        "lossless": gap["covered"] == gap["n_source"],
        **{name: sum(1 for line in lines if pattern.match(line)) for name, pattern in _shown.items()},
        "pictures": sum(p["n"] for p in pictures),
        "stored": any(p["file"] is not None for p in pictures),
    }


def docx_trips(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, what comes through) of each text as a package with the key as its title.

    One pass of one worker, which holds one package at a time: neither packages nor Markdown are kept for a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [docx_trip(t.as_py(), k.as_py()) for k, t in zip(batch.column(0), batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[f] for r in rows], type_) for f, type_ in TRIP.items())], ["key", *TRIP])

    fields = "error string, title string, lossless boolean, headings bigint, items bigint, pictures bigint, stored boolean"
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key string, {fields}").withColumnRenamed("key", key)


def pdf(pages: list[list[str]], title: str = "", packed: bool = False) -> bytes:
    """A PDF of pages of lines, with a map to Unicode; packed: streams and objects are compressed."""
    glyphs = {c: i for i, c in enumerate(sorted({c for page in pages for line in page for c in line}), 1)}
    hexed = lambda line: "".join(f"{glyphs[c]:04x}" for c in line)
    to = "\n".join(f"<{i:04x}> <{c.encode('utf-16-be', 'surrogatepass').hex()}>" for c, i in glyphs.items())
    cmap = f"begincmap 1 begincodespacerange <0000> <ffff> endcodespacerange {len(glyphs)} beginbfchar\n{to}\nendbfchar endcmap"
    flow = lambda page: "BT /F1 10 Tf 12 TL 50 780 Td\n" + "\n".join(f"<{hexed(line)}> Tj T*" for line in page) + "\nET"
    first = 6
    kids = " ".join(f"{first + 2 * i} 0 R" for i in range(len(pages)))
    plain = {
        1: "<< /Type /Catalog /Pages 2 0 R >>",
        2: f"<< /Type /Pages /Kids [{kids}] /Count {len(pages)} /Resources << /Font << /F1 3 0 R >> >> >>",
        3: "<< /Type /Font /Subtype /Type0 /BaseFont /X /ToUnicode 4 0 R >>",
        5: f"<< /Title <feff{title.encode('utf-16-be').hex()}> >>",
        **{first + 2 * i: f"<< /Type /Page /Parent 2 0 R /Contents {first + 2 * i + 1} 0 R >>" for i in range(len(pages))},
    }
    streams = {4: cmap, **{first + 2 * i + 1: flow(page) for i, page in enumerate(pages)}}
    out = bytearray(b"%PDF-1.7\n")

    def put(number: int, head: str, data: bytes) -> None:
        if packed:
            data, head = zlib.compress(data), head + " /Filter /FlateDecode"
        out.extend(f"{number} 0 obj\n<< {head} /Length {len(data)} >>\nstream\n".encode() + data + b"\nendstream\nendobj\n")

    for number, data in streams.items():
        put(number, "", data.encode())
    if packed:
        bodies = [v + " " for v in plain.values()]
        places = [sum(map(len, bodies[:i])) for i in range(len(bodies))]
        index = " ".join(f"{n} {at}" for n, at in zip(plain, places)) + " "
        put(9_000_000, f"/Type /ObjStm /N {len(plain)} /First {len(index)}", (index + "".join(bodies)).encode())
        put(9_000_001, "/Type /XRef /Root 1 0 R /Info 5 0 R", b"")
    else:
        for number, value in plain.items():
            out.extend(f"{number} 0 obj\n{value}\nendobj\n".encode())
        out.extend(b"trailer\n<< /Root 1 0 R /Info 5 0 R >>\n%%EOF\n")
    return bytes(out)


@F.pandas_udf(T.BinaryType())
def pdf_of(text: pd.Series, title: pd.Series) -> pd.Series:
    """A PDF of each text: form feeds part its pages; every second file is packed."""
    return pd.Series([pdf([p.split("\n") for p in (t or "").split("\f")], n or "", packed=len(t or "") % 2 == 0) for t, n in zip(text, title)])
