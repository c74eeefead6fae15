"""Office packages as Markdown, and independently as plain text to measure the Markdown against.

A package is a map of part names to XML. Each format has a writer that walks the structure (headings, lists, tables,
slides, sheets) and a reader that takes every run of text whatever the structure; they share only the reading of XML
and the policy of what counts as content, so neither hides the other's losses. Tags are matched by local name.

In Spark, a package file is a row; `parts` opens it where it lies and `convert` turns it into Markdown, text and
errors, in Arrow batches. Damaged parts give no text and never an exception.
"""

from __future__ import annotations

import hashlib
import io
import re
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parts of each format that are read (fixed patterns).
MAIN_PARTS = {
    "docx": r"word/(document|styles|numbering|footnotes|endnotes|comments)\.xml|word/_rels/document\.xml\.rels|word/charts/chart\d+\.xml|word/diagrams/data\d+\.xml|word/media/[^/]+\.svg|docProps/(core|app)\.xml",
    "pptx": r"ppt/slides/slide\d+\.xml|ppt/slides/_rels/slide\d+\.xml\.rels|ppt/notesSlides/notesSlide\d+\.xml|ppt/diagrams/data\d+\.xml|ppt/charts/chart\d+\.xml|ppt/comments/[^/]+\.xml|ppt/media/[^/]+\.svg|docProps/(core|app)\.xml",
    "xlsx": r"xl/(workbook|sharedStrings|comments\d*)\.xml|xl/_rels/workbook\.xml\.rels|xl/worksheets/[^/]+\.xml|xl/drawings/drawing\d+\.xml|xl/drawings/_rels/drawing\d+\.xml\.rels|xl/charts/chart\d+\.xml|xl/media/[^/]+\.svg|docProps/(core|app)\.xml",
}
MEDIA = re.compile(r"(word|ppt|xl)/media/[^/]+\.(png|jpe?g|gif|bmp|tiff?|emf|wmf|webp)", re.IGNORECASE)
_PICTURE = re.compile(r"\.(png|jpe?g|gif|bmp|tiff?|emf|wmf|webp)$", re.IGNORECASE)
HIDDEN = {"Fallback", "rPh", "moveFrom"}  # copies for other readers, phonetic help, text that moved away
CHROME = {"sldNum", "dt", "ftr"}
BREAKS = {"p", "tab", "br", "cr"}
_TR, _TC, _P_TBL, _SPANS = frozenset({"tr"}), frozenset({"tc"}), frozenset({"p", "tbl"}), frozenset({"gridSpan", "vMerge"})
_NOT_TR, _NOT_TC, _NOT_P = frozenset({"tc", "p", "tblPr", "tblGrid"}), frozenset({"p", "tbl", "trPr"}), frozenset({"tcPr"})
_STYLING, _CHANGES = frozenset({"pStyle", "numId", "ilvl", "outlineLvl"}), frozenset({"pPrChange", "rPrChange"})
KEPT_CHARS = 4_000_000  # of XML whose trees a package keeps

Element = ElementTree.Element


@lru_cache(4096)
def _local(tag: object) -> str:
    return tag.rsplit("}", 1)[-1] if isinstance(tag, str) else ""


def local(el: Element) -> str:
    return _local(el.tag)


def attribute(el: Element, name: str) -> str:
    for k, v in el.attrib.items():
        if _local(k) == name:
            return v
    return ""


def number(text: str, default: int = 0) -> int:
    try:
        return int(text)
    except ValueError:
        return default


def flat(text: str) -> str:
    return " ".join(text.split())


def find(el: Element, names: set[str], around: frozenset[str] = frozenset()) -> Iterator[Element]:
    """Descendants of these names in document order, not within each other nor within `around`; wrappers are transparent."""
    for child in el:
        name = _local(child.tag)
        if name in names and name not in HIDDEN:
            yield child
        elif name not in HIDDEN and name not in around:
            yield from find(child, names, around)


def runs(el: Element, values: frozenset[str] = frozenset({"t"}), skip: Callable[[Element], bool] | None = None) -> list[str]:
    """All text below an element as it is: runs join without a blank, breaks and paragraphs give one."""
    out: list[str] = []
    if skip is None and "v" not in values:  # where nothing is hidden, plain order does
        roles: dict[object, int] = {}
        for x in el.iter():
            role = roles.get(tag := x.tag)
            if role is None:
                name = _local(tag)
                role = roles[tag] = 4 if name in HIDDEN else (name in BREAKS) + 2 * (name in values)
            if role:
                if role == 4:
                    out.clear()
                    break
                if role != 2:
                    out.append(" ")
                if role != 1 and x.text:
                    out.append(x.text)
        else:
            return out
    _gather(el, values, skip, out)
    return out


def _gather(el: Element, values: frozenset[str], skip: Callable[[Element], bool] | None, out: list[str]) -> None:
    name = _local(el.tag)
    if name in HIDDEN or skip and skip(el):
        return
    if name == "v" and name in values:
        out.append(f" {el.text or ''} ")
        return
    if name in BREAKS:
        out.append(" ")
    if name in values and el.text:
        out.append(el.text)
    for child in el:
        _gather(child, values, skip, out)


def text_of(el: Element | None, values: Iterable[str] = ("t",), skip: Callable[[Element], bool] | None = None) -> str:
    return "" if el is None else flat("".join(runs(el, frozenset(values), skip)))


_special, _lead, _numbered = re.compile(r"([\\*_`<\[\]~])"), re.compile(r">|[#+*\-](?=\s)"), re.compile(r"(\d+)[.)](?=\s)")


def escape(text: str) -> str:
    return _special.sub(r"\\\1", text) if _special.search(text) else text


def escape_lead(text: str) -> str:
    if text[:1].isalpha():
        return text
    if _lead.match(text):
        return "\\" + text
    m = _numbered.match(text)
    return f"{m[1]}\\{text[m.end(1) :]}" if m else text


def cell(text: str) -> str:
    return flat(text).replace("|", "\\|")


def pipe_table(rows: list[list[str]]) -> str:
    rows = [r for r in rows if any(c.strip() for c in r)]
    width = max((i + 1 for r in rows for i, c in enumerate(r) if c.strip()), default=0)
    lines = ["| " + " | ".join((r + [""] * width)[:width]) + " |" for r in rows]
    return "\n".join([*lines[:1], "| " + " | ".join(["---"] * width) + " |", *lines[1:]]) if rows else ""


class Blocks(list):
    """Blocks of a document; list items stand line under line, everything else with a blank line between."""

    def put(self, kind: str, text: str) -> None:
        if text:
            self.append((kind, text))

    def join(self) -> str:
        out, before = "", ""
        for kind, text in self:
            out += ("" if not out else "\n" if kind == before == "item" else "\n\n") + text
            before = kind
        return out + "\n" if out else ""


def resolve(folder: str, target: str) -> str:
    """The package path of a relationship's target."""
    target = (target or "").replace("\\", "/").strip()
    if target.startswith("/"):
        return target.lstrip("/")
    path: list[str] = []
    for step in (folder + "/" + target).split("/"):
        if step == "..":
            del path[-1:]
        elif step not in ("", "."):
            path.append(step)
    return "/".join(path)


class Package:
    """Parts of a package with their trees; a tree is parsed once, but where many or large ones would fill the memory."""

    def __init__(self, parts: dict[str, str]):
        self.parts = parts
        self.trees: dict[str, Element | None] = {}
        self.room = KEPT_CHARS

    @classmethod
    def of(cls, parts: dict[str, str] | Package) -> Package:
        return parts if isinstance(parts, cls) else cls(parts)

    def tree(self, name: str) -> Element | None:
        if name in self.trees:
            return self.trees[name]
        xml = self.parts.get(name, "")
        root = parse(xml)
        if len(xml) <= self.room:
            self.room -= len(xml)
            self.trees[name] = root
        return root

    def children(self, name: str) -> list[Element]:
        root = self.tree(name)
        return [] if root is None else list(root)

    def names(self, pattern: str) -> list[str]:
        return sorted(n for n in self.parts if re.fullmatch(pattern, n))

    def relations(self, owner: str) -> list[tuple[str, str, str, bool]]:
        """(id, type, target, external) of a part's relationships."""
        folder, _, base = owner.rpartition("/")
        root = self.tree(f"{folder}/_rels/{base}.rels")
        return [(r.get("Id", ""), r.get("Type", ""), r.get("Target", ""), r.get("TargetMode") == "External") for r in (root if root is not None else []) if local(r) == "Relationship"]

    def pictures(self, owner: str) -> dict[str, str]:
        """Relationship id -> part of the pictures within the package."""
        folder = owner.rpartition("/")[0]
        found = {i: resolve(folder, t) for i, kind, t, out in self.relations(owner) if i and t and not out and (kind.endswith("/image") or _PICTURE.search(t))}
        return {i: p for i, p in found.items() if p and not p.lower().endswith(".svg")}

    def points(self, name: str) -> list[str]:
        root = self.tree(name)
        return [] if root is None else [t for p in find(root, {"pt"}) if (t := text_of(p))]

    def chart(self, name: str) -> str:
        return text_of(self.tree(name), ("t", "v"))

    def comments(self, name: str) -> list[str]:
        root = self.tree(name)
        return [] if root is None else [t for c in list(find(root, {"comment", "cm"})) or [root] if (t := text_of(c, ("t", "text")))]

    def labels(self) -> list[str]:
        """Labels in drawn pictures, one picture's lines together."""
        out = []
        for name in self.names(r"(word|ppt|xl)/media/[^/]+\.svg"):
            root = self.tree(name)
            lines = [t for el in (root.iter() if root is not None else []) if local(el) == "text" and (t := flat(" ".join(el.itertext())))]
            out += ["\n".join(lines)] if lines else []
        return out


def parse(xml: str) -> Element | None:
    try:
        return ElementTree.fromstring(xml) if xml else None
    except ElementTree.ParseError:
        return None


def sentinel(part: str) -> str:
    return f"<!-- ooxml-image:{part} -->"


def picture_ids(el: Element) -> Iterator[str]:
    for found in find(el, {"blip", "imagedata"}):
        rid = (attribute(found, "embed") or attribute(found, "link")) if local(found) == "blip" else attribute(found, "id")
        if rid:
            yield rid


# ---- word processing ------------------------------------------------------------------------------------------------


class Word:
    def __init__(self, package: Package, images: bool):
        self.package = package
        self.levels = self._levels()
        self.formats = self._formats()
        relations = package.relations("word/document.xml")
        self.links = {i: t for i, _, t, out in relations if out and i and t}
        self.pictures = package.pictures("word/document.xml") if images else {}
        self.blocks = Blocks()

    def _levels(self) -> dict[str, int]:
        """Style -> heading level: by the style's name, or its outline level."""
        out: dict[str, int] = {}
        for style in self.package.children("word/styles.xml"):
            sid = attribute(style, "styleId")
            if local(style) != "style" or not sid:
                continue
            by = {local(x): attribute(x, "val") for x in style.iter()}
            name = by.get("name", "").strip().lower()
            if m := re.fullmatch(r"heading\s+([1-9])", name):
                out[sid] = int(m[1])
            elif name == "title":
                out[sid] = 1
            elif 0 <= number(by.get("outlineLvl", ""), -1) <= 8:
                out[sid] = number(by["outlineLvl"]) + 1
        return out

    def _formats(self) -> dict[tuple[str, str], str]:
        root = self.package.tree("word/numbering.xml")
        root = root if root is not None else []
        abstract = {(attribute(a, "abstractNumId"), attribute(lv, "ilvl")): attribute(f, "val") for a in root if local(a) == "abstractNum" for lv in a if local(lv) == "lvl" for f in lv if local(f) == "numFmt"}
        refs = {attribute(n, "numId"): attribute(r, "val") for n in root if local(n) == "num" for r in n if local(r) == "abstractNumId"}
        return {(num, level): kind for num, a in refs.items() for (x, level), kind in abstract.items() if x == a}

    def paragraph(self, p: Element, boxes: list[Element], images: list[str]) -> str:
        out: list[str] = []
        self.inline(p, out, boxes, images)
        return flat("".join(out))

    def inline(self, el: Element, out: list[str], boxes: list[Element], images: list[str]) -> None:
        for child in el:
            name = _local(child.tag)
            if name == "t":
                out.append(escape(child.text or ""))
            elif name in HIDDEN or name == "pPr":
                continue
            elif name == "txbxContent":
                boxes.append(child)
            elif name in ("blip", "imagedata"):
                images.extend(picture_ids([child]))  # type: ignore[arg-type]
            elif name == "hyperlink":
                mark = len(out)
                self.inline(child, out, boxes, images)
                inner = flat("".join(out[mark:]))
                url = self.links.get(attribute(child, "id"), "")
                out[mark:] = [f"[{inner}]({url})" if inner and url.startswith(("http://", "https://")) else inner]
            elif name in ("tab", "br", "cr"):
                out.append(" ")
            else:
                self.inline(child, out, boxes, images)

    def properties(self, p: Element) -> dict[str, str]:
        found: dict[str, str] = {}
        for pr in p:
            if _local(pr.tag) == "pPr":
                for x in find(pr, _STYLING, _CHANGES):
                    found[local(x)] = attribute(x, "val")
        return found

    def cell_text(self, tc: Element, boxes: list[Element], images: list[str]) -> str:
        out = []
        for el in find(tc, _P_TBL, _NOT_P):
            if local(el) == "p":
                out.append(self.paragraph(el, boxes, images).replace("|", "\\|"))
            else:
                out += [" ".join(c for c in row if c) for row in self.rows(el, boxes, images)]
        return "<br>".join(x for x in out if x)

    def rows(self, table: Element, boxes: list[Element], images: list[str]) -> list[list[str]]:
        """Rows of cells; spans pad, and a cell merged with the one above repeats its text."""
        rows, above = [], {}
        for tr in find(table, _TR, _NOT_TR):
            row: list[str] = []
            for tc in find(tr, _TC, _NOT_TC):
                if len(tc) == 1 and _local(tc[0].tag) == "p":  # neither merged nor spanning
                    above.pop(len(row), None)
                    row.append(self.paragraph(tc[0], boxes, images).replace("|", "\\|"))
                    continue
                at, text = len(row), self.cell_text(tc, boxes, images)
                inner = {local(x): attribute(x, "val") for x in reversed(list(find(tc, _SPANS, _P_TBL)))}
                if inner.get("vMerge") == "restart":
                    above[at] = text
                elif "vMerge" in inner:
                    text = text or above.get(at, "")
                else:
                    above.pop(at, None)
                row += [text] + [""] * (max(1, number(inner.get("gridSpan", "1"), 1)) - 1)
            if row:
                rows.append(row)
        return rows

    def walk(self, el: Element) -> None:
        for child in el:
            name = _local(child.tag)
            if name in HIDDEN:
                continue
            boxes: list[Element] = []
            images: list[str] = []
            if name == "p":
                text, pr = self.paragraph(child, boxes, images), self.properties(child)
                level = self.levels.get(pr.get("pStyle", "")) or (number(pr["outlineLvl"], -1) + 1 if pr.get("outlineLvl") else 0)
                if text and level:
                    self.blocks.put("head", "#" * min(level, 6) + " " + escape_lead(text))
                elif text and pr.get("numId", "0") not in ("", "0"):
                    depth = pr.get("ilvl") or "0"
                    mark = "-" if self.formats.get((pr["numId"], depth), "bullet") == "bullet" else "1."
                    self.blocks.put("item", "  " * number(depth) + f"{mark} {text}")
                else:
                    self.blocks.put("text", escape_lead(text))
            elif name == "tbl":
                trs = list(find(child, _TR, _NOT_TR))
                tcs = list(find(trs[0], _TC, _NOT_TC)) if len(trs) == 1 else []
                if len(tcs) == 1:  # a frame around text
                    self.walk(tcs[0])
                    continue
                self.blocks.put("table", pipe_table(self.rows(child, boxes, images)))
            else:
                self.walk(child)
                continue
            for rid in images:
                if rid in self.pictures:
                    self.blocks.put("image", sentinel(self.pictures[rid]))
            for box in boxes:
                self.walk(box)

    def markdown(self) -> str:
        root = self.package.tree("word/document.xml")
        if root is None:
            return ""
        self.walk(root)
        for part in ("footnotes", "endnotes", "comments"):
            notes = [escape(t) for n in self.package.children(f"word/{part}.xml") if (t := text_of(n, ("t", "text")))]
            if notes:
                self.blocks.put("section", f"## {part.capitalize()}\n\n" + "\n".join(f"- {n}" for n in notes))
        embedded(self.package, self.blocks, (("Diagrams", r"word/diagrams/data\d+\.xml", points_list), ("Charts", r"word/charts/chart\d+\.xml", lambda p, n: escape(p.chart(n)))))
        return self.blocks.join()


def points_list(package: Package, name: str) -> str:
    return "\n".join(f"- {escape(t)}" for t in package.points(name))


def embedded(package: Package, blocks: Blocks, kinds: Iterable[tuple[str, str, Callable[[Package, str], str]]]) -> None:
    for title, pattern, render in kinds:
        texts = [t for n in package.names(pattern) if (t := render(package, n))]
        if texts:
            blocks.put("head", f"## {title}")
            for t in texts:
                blocks.put("text", t if t.startswith("- ") else escape_lead(t))


def word_text(package: Package) -> list[str]:
    out = [text_of(package.tree(f"word/{n}.xml"), ("t", "text")) for n in ("document", "footnotes", "endnotes", "comments")]
    for n in package.names(r"word/(diagrams/data|charts/chart)\d+\.xml"):
        out.append(package.chart(n) if "/charts/" in n else " ".join(package.points(n)))
    return out


# ---- slides ---------------------------------------------------------------------------------------------------------


def placeholder(shape: Element) -> str:
    return next((attribute(p, "type") for p in find(shape, {"ph"}, frozenset({"txBody"}))), "")


def is_chrome(el: Element) -> bool:
    return local(el) == "sp" and placeholder(el) in CHROME


def paragraphs(box: Element) -> Iterator[tuple[int, str]]:
    for body in [box] if local(box) == "txBody" else find(box, {"txBody"}):
        for p in (x for x in body if local(x) == "p"):
            if t := text_of(p):
                yield number(next((attribute(x, "lvl") for x in p if local(x) == "pPr"), "0") or "0"), t


def shapes(el: Element, blocks: Blocks, title: list[str], pictures: dict[str, str]) -> None:
    for child in el:
        name = local(child)
        if name in HIDDEN or is_chrome(child):
            continue
        if name == "sp":
            found = list(paragraphs(child))
            if found and not title and placeholder(child) in ("title", "ctrTitle"):
                title.append(" ".join(escape(t) for _, t in found))
            else:
                for level, t in found:
                    blocks.put("item", "  " * level + "- " + escape(t))
        elif name == "txBody":
            for level, t in paragraphs(child):
                blocks.put("item", "  " * level + "- " + escape(t))
        elif name in ("graphicFrame", "pic"):
            for table in find(child, {"tbl"}) if name == "graphicFrame" else ():
                blocks.put("table", pipe_table([[cell(escape(text_of(tc))) for tc in find(tr, {"tc"})] for tr in find(table, {"tr"}, frozenset({"tc"}))]))
            for rid in picture_ids(child):
                if rid in pictures:
                    blocks.put("image", sentinel(pictures[rid]))
        else:
            shapes(child, blocks, title, pictures)


def slides_markdown(package: Package, images: bool) -> str:
    blocks, used, noted = Blocks(), set(), set()
    objects = r"ppt/(diagrams/data|charts/chart)\d+\.xml"

    def render(name: str) -> str:
        return points_list(package, name) if "/diagrams/" in name else escape_lead(escape(package.chart(name)))

    def notes(name: str) -> None:
        root, body, title = package.tree(name), Blocks(), []
        noted.add(name)
        if root is None:
            return
        shapes(root, body, title, {})
        if body or title:
            blocks.put("head", "### Speaker notes")
            blocks.put("text", title[0] if title else "")
            blocks.extend(body)

    for name in sorted(package.names(r"ppt/slides/slide\d+\.xml"), key=lambda n: int(re.search(r"\d+", n)[0])):
        n, root = int(re.search(r"\d+", name)[0]), package.tree(name)
        if root is None:
            continue
        body, title = Blocks(), []
        shapes(root, body, title, package.pictures(name) if images else {})
        blocks.put("head", f"## Slide {n}" + (f" — {title[0]}" if title else ""))
        blocks.extend(body)
        refs = list(dict.fromkeys(r for _, _, t, out in package.relations(name) if not out and (r := resolve("ppt/slides", t)) in package.parts))
        for ref in (r for r in refs if re.fullmatch(objects, r)):
            used.add(ref)
            if text := render(ref):
                blocks.put("head", "### Diagram" if "/diagrams/" in ref else "### Chart")
                blocks.put("text", text)
        bound = [r for r in refs if re.fullmatch(r"ppt/notesSlides/notesSlide\d+\.xml", r)]
        for note in bound or [x for x in (f"ppt/notesSlides/notesSlide{n}.xml",) if x in package.parts]:
            if note not in noted:
                notes(note)
    orphans = [t for o in package.names(objects) if o not in used and (t := render(o))]
    if orphans:
        blocks.put("head", "## Embedded objects")
        for t in orphans:
            blocks.put("text", t)
    for note in package.names(r"ppt/notesSlides/notesSlide\d+\.xml"):
        if note not in noted:
            notes(note)
    said = [t for n in package.names(r"ppt/comments/[^/]+\.xml") for t in package.comments(n)]
    if said:
        blocks.put("head", "## Comments")
        blocks.put("text", "\n".join(f"- {escape(t)}" for t in said))
    return blocks.join()


def slides_text(package: Package) -> list[str]:
    out = [text_of(package.tree(n), skip=is_chrome) for n in package.names(r"ppt/(slides/slide|notesSlides/notesSlide)\d+\.xml")]
    for n in package.names(r"ppt/(diagrams/data|charts/chart)\d+\.xml|ppt/comments/[^/]+\.xml"):
        out.append(package.chart(n) if "/charts/" in n else " ".join(package.points(n) if "/diagrams/" in n else package.comments(n)))
    return out


# ---- sheets ---------------------------------------------------------------------------------------------------------


def shared_strings(package: Package) -> list[str]:
    root = package.tree("xl/sharedStrings.xml")
    return ["".join(runs(si)) for si in (root if root is not None else []) if local(si) == "si"]


def column(ref: str) -> int:
    """The 0-based column of a cell reference; -1 where there is none."""
    m = re.fullmatch(r"([A-Z]+)\d+", ref or "")
    n = 0
    for c in m[1] if m else "":
        n = n * 26 + ord(c) - 64
    return n - 1


def value(c: Element, shared: list[str]) -> str:
    """What a cell shows."""
    kind = attribute(c, "t") or "n"
    by = {local(x): x for x in c}
    raw = (by["v"].text or "") if "v" in by else ""
    if kind == "s":
        i = number(raw.strip(), -1)
        return shared[i] if 0 <= i < len(shared) else ""
    if kind == "inlineStr":
        return "".join(runs(by["is"])) if "is" in by else ""
    return ("TRUE" if raw.strip() == "1" else "FALSE") if kind == "b" else raw


def sheets(package: Package) -> list[tuple[str, str | None]]:
    """(name, part) of the workbook's sheets in order; no part where the target is none."""
    root = package.tree("xl/workbook.xml")
    targets = {i: t for i, _, t, _ in package.relations("xl/workbook.xml")}
    out = []
    for s in find(root, {"sheet"}) if root is not None else ():
        m = re.fullmatch(r"(?:/xl/|xl/|\.\./|\./)*(worksheets/[^/]+\.xml)", targets.get(attribute(s, "id"), ""))
        part = f"xl/{m[1]}" if m else None
        out.append((attribute(s, "name"), part if part in package.parts else None))
    return out


def sheet_table(package: Package, part: str, shared: list[str]) -> str:
    root, rows = package.tree(part), []
    for tr in find(root, {"row"}) if root is not None else ():
        row: list[str] = []
        for c in (x for x in tr if local(x) == "c"):
            at = column(attribute(c, "r"))
            at = len(row) if at < 0 else at
            row += [""] * (at + 1 - len(row))
            row[at] = cell(escape(value(c, shared)))
        rows.append(row)
    return pipe_table(rows)


def sheets_markdown(package: Package, images: bool) -> str:
    blocks, shared, linked = Blocks(), shared_strings(package), set()
    for name, part in sheets(package):
        blocks.put("head", f"## {escape(name)}")
        if part:
            linked.add(part)
            blocks.put("table", sheet_table(package, part, shared))
    for part in package.names(r"xl/worksheets/[^/]+\.xml"):
        if part not in linked and (table := sheet_table(package, part, shared)):
            blocks.put("head", f"## Sheet (unlinked): {escape(part.rsplit('/', 1)[-1][:-4])}")
            blocks.put("table", table)
    drawings = r"xl/drawings/drawing\d+\.xml"
    embedded(
        package, blocks,
        (("Text boxes", drawings, lambda p, n: escape(text_of(p.tree(n)))), ("Comments", r"xl/comments\d*\.xml", lambda p, n: "\n".join(f"- {escape(t)}" for t in p.comments(n))), ("Charts", r"xl/charts/chart\d+\.xml", lambda p, n: escape(p.chart(n)))),
    )
    marks = [sentinel(pics[rid]) for n in package.names(drawings) if images and (root := package.tree(n)) is not None for pics in [package.pictures(n)] for rid in picture_ids(root) if rid in pics]
    if marks:
        blocks.put("head", "## Images")
        for m in marks:
            blocks.put("image", m)
    return blocks.join()


def sheets_text(package: Package) -> list[str]:
    shared = shared_strings(package)
    out = [name for name, _ in sheets(package)]
    for n in package.names(r"xl/worksheets/[^/]+\.xml"):
        root = package.tree(n)
        out += [value(c, shared) for c in find(root, {"c"})] if root is not None else []
    for n in package.names(r"xl/(drawings/drawing\d+|comments\d*|charts/chart\d+)\.xml"):
        out.append(package.chart(n) if "/charts/" in n else " ".join(package.comments(n)) if "/comments" in n else text_of(package.tree(n)))
    return out


# ---- formats --------------------------------------------------------------------------------------------------------


def markdown_of(ext: str, parts: dict[str, str] | Package, images: bool = False) -> str:
    package, kind = Package.of(parts), ext.lower().lstrip(".")
    body = Word(package, images).markdown() if kind == "docx" else slides_markdown(package, images) if kind == "pptx" else sheets_markdown(package, images) if kind == "xlsx" else ""
    labels = package.labels()
    if labels:
        figures = "\n\n".join("\n".join(escape_lead(escape(line)) for line in t.split("\n")) for t in labels)
        body = (body + "\n\n" if body.strip() else "") + f"## Figures\n\n{figures}\n"
    return body


def source_text_of(ext: str, parts: dict[str, str] | Package) -> str:
    package, kind = Package.of(parts), ext.lower().lstrip(".")
    texts = word_text(package) if kind == "docx" else slides_text(package) if kind == "pptx" else sheets_text(package) if kind == "xlsx" else []
    base = flat(" ".join(t for t in texts if t))
    return "\n".join([base, *package.labels()]) if package.labels() else base


def core_properties(parts: dict[str, str] | Package) -> dict[str, str]:
    """What a package says of itself, in order; only what is there."""
    package, out = Package.of(parts), {}
    for part, fields in (("docProps/core.xml", (("title", "title"), ("author", "creator"), ("version", "revision"), ("created", "created"), ("modified", "modified"), ("last_modified_by", "lastModifiedBy"))), ("docProps/app.xml", (("company", "Company"), ("app_version", "AppVersion")))):
        root = package.tree(part)
        by = {local(x): (x.text or "").strip() for x in reversed(list(root.iter()))} if root is not None else {}
        out |= {key: by[name] for key, name in fields if by.get(name)}
    return out


CONTENT = r"word/(document|footnotes|endnotes|comments)\.xml|ppt/(slides/slide|notesSlides/notesSlide)\d+\.xml|ppt/comments/[^/]+\.xml|xl/(sharedStrings|workbook)\.xml|xl/worksheets/[^/]+\.xml|xl/(drawings/drawing|comments)\d*\.xml|(word|ppt|xl)/(charts/chart|diagrams/data)\d+\.xml"


def open_package(content: bytes | None) -> zipfile.ZipFile | None:
    try:
        return zipfile.ZipFile(io.BytesIO(content or b""))
    except (zipfile.BadZipFile, OSError, ValueError):
        return None


def read_parts(content: bytes | zipfile.ZipFile | None, ext: str) -> dict[str, str]:
    """The main parts of a package; none where it can't be opened."""
    z, pattern = content if isinstance(content, zipfile.ZipFile) else open_package(content), re.compile(MAIN_PARTS.get(ext, "$^"))
    out = {}
    for name in z.namelist() if z else ():
        if pattern.fullmatch(name):
            try:
                out[name] = z.read(name).decode("utf-8", "replace")
            except (zipfile.BadZipFile, zlib.error, OSError, RuntimeError, NotImplementedError):
                continue
    return out


_mark = re.compile(r"<!-- ooxml-image:([^>]+?) -->")


def place_pictures(markdown: str, package: zipfile.ZipFile, folder: str = "images") -> tuple[str, list[dict]]:
    """The Markdown with a link for each picture mark, and (part, file, n, bytes) of the marked parts in order.

    A file is named by the hash of its bytes, so equal pictures are one file; a mark whose part has no bytes is dropped
    and its file is null.
    """
    marks = _mark.findall(markdown)
    if not marks:
        return markdown, []
    held = set(package.namelist())
    pictures: dict[str, dict] = {}
    for part in marks:
        if part not in pictures:
            try:
                data = package.read(part) if part in held else b""
            except (zipfile.BadZipFile, zlib.error, OSError, RuntimeError, NotImplementedError):
                data = b""
            kind = re.search(r"\.([A-Za-z0-9]+)$", part)
            file = f"{hashlib.sha256(data).hexdigest()[:16]}.{kind[1].lower() if kind else 'bin'}" if data else None
            pictures[part] = {"part": part, "file": file, "n": 0, "bytes": data or None}
        pictures[part]["n"] += 1
    link = lambda m: f"![]({folder}/{pictures[m[1]]['file']})" if pictures[m[1]]["file"] else ""
    return _mark.sub(link, markdown), list(pictures.values())


BLANK = {"markdown": "", "source_text": "", "repr_chars": 0, "properties": {}, "error": "", "pictures": []}


def convert_package(content: bytes | None, ext: str, images: bool = True) -> dict:
    """markdown, source_text, chars, properties, error and pictures of one package; an empty file is a success with a stub."""
    blank = BLANK
    if not content:
        return blank | {"markdown": "*(empty source file)*\n", "error": "empty-source-file"}
    package = open_package(content)
    if package is None:
        return blank | {"error": "unreadable-zip"}
    parts = read_parts(package, ext)
    read = Package(parts)
    broken = next((n for n in sorted(parts) if re.fullmatch(CONTENT, n) and read.tree(n) is None), None)
    made = blank | {"repr_chars": sum(map(len, parts.values())), "properties": core_properties(read)}
    if broken:
        return made | {"error": f"malformed-content-part:{broken}"}
    markdown, pictures = place_pictures(markdown_of(ext, read, images), package)
    made |= {"markdown": markdown, "source_text": source_text_of(ext, read), "pictures": pictures}
    return made if made["markdown"].strip() else made | {"error": "empty-conversion"}


PICTURE = T.StructType([T.StructField("part", T.StringType()), T.StructField("file", T.StringType()), T.StructField("n", T.LongType()), T.StructField("bytes", T.BinaryType())])
CONVERTED = T.StructType(
    [
        T.StructField("markdown", T.StringType()),
        T.StructField("source_text", T.StringType()),
        T.StructField("repr_chars", T.LongType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("error", T.StringType()),
        T.StructField("pictures", T.ArrayType(PICTURE)),
    ]
)


@F.pandas_udf(CONVERTED)
def convert_office(content: pd.Series, ext: pd.Series) -> pd.DataFrame:
    """Converts a column of packages, each where it lies."""
    return pd.DataFrame([convert_package(c, e) for c, e in zip(content, ext)], columns=[f.name for f in CONVERTED])


def package_entries(files: DataFrame, pattern: str, key: str = "doc_id", content: str = "content") -> DataFrame:
    """(key, part, bytes) of the entries whose names match: media, relationships, or everything ('.*')."""
    kind = files.schema[key].dataType.simpleString()
    wanted = re.compile(pattern, re.IGNORECASE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                z = open_package(batch.column(1)[i].as_py())
                rows = []
                for name in z.namelist() if z else ():
                    if wanted.fullmatch(name) and not name.endswith("/"):
                        try:
                            rows.append((name, z.read(name)))
                        except (zipfile.BadZipFile, zlib.error, OSError, RuntimeError, NotImplementedError):
                            continue
                if rows:
                    names, data = zip(*rows)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i] * len(rows))), pa.array(names), pa.array(data, pa.binary())], ["key", "part", "bytes"])

    return files.select(F.col(key).alias("key"), F.col(content).alias("c")).mapInArrow(run, f"key {kind}, part string, bytes binary").withColumnRenamed("key", key)


def placements(package_rels: dict[str, str]) -> dict[str, str]:
    """Media part -> body, chrome or unknown, from all relationship parts; the body wins."""
    body = re.compile(r"word/(document|footnotes|endnotes|comments)\.xml|ppt/(slides/slide|notesSlides/notesSlide)\d+\.xml|xl/worksheets/[^/]+\.xml|xl/drawings/drawing\d+\.xml|(word|ppt|xl)/(diagrams|charts)/.*")
    rank = {"body": 2, "chrome": 1, "unknown": 0}
    out: dict[str, str] = {}
    for name, xml in package_rels.items():
        folder, _, base = name.rpartition("/")
        owner = "/".join(x for x in (folder.rpartition("/")[0], base.removesuffix(".rels")) if x)
        place = "body" if body.fullmatch(owner) else "chrome" if re.fullmatch(r"word/(header|footer)\d*\.xml", owner) else "unknown"
        for r in parse(xml) if parse(xml) is not None else ():
            target = r.get("Target", "")
            if local(r) == "Relationship" and r.get("TargetMode") != "External" and (r.get("Type", "").endswith("/image") or re.search(r"\.(png|jpe?g|gif|bmp|tiff?|emf|wmf|webp|svg)$", target, re.IGNORECASE)):
                media = resolve(owner.rpartition("/")[0], target)
                if rank[place] >= rank.get(out.get(media, ""), -1):
                    out[media] = place
    return out
