"""The text layer of PDF files, without outside programs: pages as lines of text, and what a file says of itself.

Read are the objects of a file (also packed and compressed ones), the page tree, content streams with their text
operators, and the fonts' maps to Unicode; where a font has none, its codes are Latin-1. Lines follow the positions of
the text: a new baseline begins a line, a wide gap is a blank. Pictures, encryption and other compressions than Flate
aren't read: such a file gives no text, and whether that means a scan is for the probe of the text layer to say.

Defined results: null, empty and damaged files give no pages; a page without text is an empty string; objects defined
twice count as defined last; any number of pages; reference loops end.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_object = re.compile(rb"(?<!\d)(\d+)\s+(\d+)\s+obj\b")
_space = b" \t\r\n\f\0"
_delimiters = b"()<>[]{}/%"
_escapes = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


class Name(str):
    """A name object."""


class Ref(int):
    """A reference to an object by its number."""


class Operator(bytes):
    """A word that is no value: an operator or a keyword."""


class Reader:
    """Values of a stretch of PDF syntax, one after the other."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def _skip(self) -> None:
        data = self.data
        while self.at < len(data):
            c = data[self.at : self.at + 1]
            if c in _space and c:
                self.at += 1
            elif c == b"%":
                while self.at < len(data) and data[self.at] not in b"\r\n":
                    self.at += 1
            else:
                return

    def value(self):
        """The next value; None at the end. Lists and dictionaries are read with an own stack, so depth is no matter."""
        stack: list[tuple[bytes, list]] = []
        while True:
            item = self._one()
            if item is None:
                return self._dict(stack[0][1]) if stack and stack[0][0] == b"<<" else stack[0][1] if stack else None
            if type(item) is Operator and item in (b"<<", b"["):
                stack.append((bytes(item), []))
                continue
            if type(item) is Operator and item in (b">>", b"]"):
                if not stack:
                    continue
                kind, held = stack.pop()
                item = self._dict(held) if kind == b"<<" else held
            elif type(item) is Operator and item == b"R" and stack and len(stack[-1][1]) > 1 and isinstance(stack[-1][1][-2], int):
                stack[-1][1][-2:] = [Ref(stack[-1][1][-2])]
                continue
            if not stack:
                return item
            stack[-1][1].append(item)

    @staticmethod
    def _dict(held: list) -> dict:
        return {k: v for k, v in zip(held[::2], held[1::2]) if isinstance(k, str)}

    def _one(self):
        self._skip()
        data, at = self.data, self.at
        if at >= len(data):
            return None
        c = data[at : at + 1]
        if data[at : at + 2] in (b"<<", b">>"):
            self.at += 2
            return Operator(data[at : at + 2])
        if c in b"[]{})":
            self.at += 1
            return Operator(c)
        if c == b"(":
            return self._string()
        if c == b"<":
            end = data.find(b">", at)
            self.at = len(data) if end < 0 else end + 1
            digits = re.sub(rb"[^0-9A-Fa-f]", b"", data[at + 1 : self.at - 1])
            return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        begin = self.at = at + (c == b"/")
        while self.at < len(data) and data[self.at] not in _space and data[self.at] not in _delimiters:
            self.at += 1
        word = data[begin : self.at]
        if c == b"/":
            return Name(re.sub(rb"#([0-9A-Fa-f]{2})", lambda m: bytes.fromhex(m[1].decode()), word).decode("latin-1"))
        if not word:
            self.at += 1
            return Operator(c)
        try:
            return int(word)
        except ValueError:
            try:
                return float(word) if re.fullmatch(rb"[+-]?\d*\.?\d*", word) else Operator(word)
            except ValueError:
                return Operator(word)

    def _string(self) -> bytes:
        data, out, depth = self.data, bytearray(), 0
        while self.at < len(data):
            c = data[self.at : self.at + 1]
            self.at += 1
            if c == b"\\":
                n = data[self.at : self.at + 1]
                if n in b"01234567" and n:
                    m = re.compile(rb"[0-7]{1,3}").match(data, self.at)
                    self.at = m.end()
                    out.append(int(m[0], 8) & 255)
                    continue
                self.at += 1
                if n == b"\r" and data[self.at : self.at + 1] == b"\n":
                    self.at += 1
                elif n not in (b"\r", b"\n"):
                    out += _escapes.get(n, n)
                continue
            depth += (c == b"(") - (c == b")")
            if depth == 0:
                break
            if c != b"(" or depth > 1:
                out += c
        return bytes(out)


class Document:
    """The objects of a file."""

    def __init__(self, data: bytes):
        self.data = data
        self.at = {int(m[1]): m.end() for m in _object.finditer(data)}
        self.packed: dict[int, object] = {}
        self._held: dict[int, object] = {}
        for number in list(self.at):
            value = self.get(Ref(number))
            if isinstance(value, tuple) and value[0].get("Type") == "ObjStm":
                self._unpack(*value)
        self.trailer: dict = {}
        for m in re.finditer(rb"trailer\s*(?=<<)", data):
            found = Reader(data, m.end()).value()
            self.trailer |= found if isinstance(found, dict) else {}
        for number in self.at:
            value = self.get(Ref(number))
            if isinstance(value, tuple) and value[0].get("Type") == "XRef":
                self.trailer |= {k: v for k, v in value[0].items() if k in ("Root", "Info", "Encrypt")}

    def get(self, value):
        """What a reference stands for; streams are (dictionary, bytes)."""
        if type(value) is not Ref:
            return value
        if value not in self._held:
            self._held[value] = None  # a loop ends here
            self._held[value] = self._read(value)
        return self._held[value]

    def _read(self, number: int):
        if number not in self.at:
            return self.packed.get(number)
        reader = Reader(self.data, self.at[number])
        value = reader.value()
        m = re.compile(rb"\s*stream(\r\n|\n|\r)").match(self.data, reader.at)
        if not isinstance(value, dict) or not m:
            return value
        length = self.get(value.get("Length"))
        end = m.end() + length if isinstance(length, int) and self.data[m.end() + length :].lstrip()[:9] == b"endstream" else self.data.find(b"endstream", m.end())
        return value, self.data[m.end() : end if end >= 0 else len(self.data)]

    def stream(self, value) -> bytes:
        """The bytes of a stream as they were before compression; nothing where that isn't known."""
        held = self.get(value)
        if not isinstance(held, tuple):
            return b""
        filters = self.get(held[0].get("Filter")) or []
        data = held[1]
        for f in filters if isinstance(filters, list) else [filters]:
            if f != "FlateDecode":
                return b""
            data = zlib_all(data)
        parameters = self.get(held[0].get("DecodeParms"))
        return data if not isinstance(parameters, dict) or parameters.get("Predictor", 1) == 1 else b""

    def _unpack(self, head: dict, _: bytes) -> None:
        number = next(k for k, v in self._held.items() if isinstance(v, tuple) and v[0] is head)
        data = self.stream(Ref(number))
        first, count = self.get(head.get("First")), self.get(head.get("N"))
        if not isinstance(first, int) or not isinstance(count, int):
            return
        numbers = [int(x) for x in re.findall(rb"\d+", data[:first])][: 2 * count]
        for n, offset in zip(numbers[::2], numbers[1::2]):
            if n not in self.at:
                self.packed[n] = Reader(data, first + offset).value()

    def pages(self) -> Iterator[dict]:
        """The page dictionaries in order, each with the resources it inherits."""
        root = self.get(self.trailer.get("Root"))
        top = root.get("Pages") if isinstance(root, dict) else next((Ref(n) for n in self.at if isinstance(self.get(Ref(n)), dict) and self.get(Ref(n)).get("Type") == "Pages" and "Parent" not in self.get(Ref(n))), None)
        stack, seen = [(top, None)], set()
        while stack:
            ref, resources = stack.pop()
            node = self.get(ref)
            if not isinstance(node, dict) or (type(ref) is Ref and ref in seen):
                continue
            seen.add(ref if type(ref) is Ref else id(node))
            resources = node.get("Resources", resources)
            kids = self.get(node.get("Kids"))
            if isinstance(kids, list):
                stack += [(k, resources) for k in reversed(kids)]
            else:
                yield node | {"Resources": resources}


def zlib_all(data: bytes) -> bytes:
    """What can be had of a compressed stream, also of one that is cut short."""
    try:
        return zlib.decompressobj().decompress(data)
    except zlib.error:
        return b""


def unicode_map(cmap: bytes) -> tuple[int, dict[int, str]]:
    """(bytes a code, code -> text) of a font's map to Unicode."""
    out: dict[int, str] = {}
    width = 1
    text = lambda b: b.decode("utf-16-be", "replace")
    reader, held = Reader(cmap), []
    while (item := reader.value()) is not None:
        if type(item) is not Operator:
            held.append(item)
            continue
        if item == b"endcodespacerange" and held and isinstance(held[-1], bytes):
            width = max(width, len(held[-1]))
        elif item == b"endbfchar":
            for code, to in zip(held[::2], held[1::2]):
                if isinstance(code, bytes) and isinstance(to, bytes):
                    out[int.from_bytes(code)] = text(to)
        elif item == b"endbfrange":
            for low, high, to in zip(held[::3], held[1::3], held[2::3]):
                if isinstance(low, bytes) and isinstance(high, bytes):
                    for n, code in enumerate(range(int.from_bytes(low), min(int.from_bytes(high), int.from_bytes(low) + 65535) + 1)):
                        if isinstance(to, list):
                            out[code] = text(to[n]) if n < len(to) else ""
                        elif isinstance(to, bytes) and to:
                            out[code] = text((int.from_bytes(to) + n).to_bytes(len(to)))
        held = []
    return width, out


def _decoder(document: Document, font) -> tuple[int, dict[int, str] | None]:
    font = document.get(font)
    if isinstance(font, dict) and "ToUnicode" in font:
        return unicode_map(document.stream(font["ToUnicode"]))
    return (2 if isinstance(font, dict) and font.get("Subtype") == "Type0" else 1), None


def _times(a: tuple, b: tuple) -> tuple:
    return (a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3], a[4] * b[0] + a[5] * b[2] + b[4], a[4] * b[1] + a[5] * b[3] + b[5])


ONE = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)


def page_text(document: Document, page: dict) -> str:
    """The text of a page, a line per baseline in the order of the content."""
    contents = document.get(page.get("Contents"))
    data = b"\n".join(document.stream(c) for c in (contents if isinstance(contents, list) else [page.get("Contents")]))
    resources = document.get(page.get("Resources")) or {}
    fonts = document.get(resources.get("Font")) if isinstance(resources, dict) else None
    decoders: dict = {}
    font, size, leading = (1, None), 1.0, 0.0
    line, text = ONE, ONE
    lines: list[str] = []
    last: tuple[float, float] | None = None  # where the last text ended
    reader, held = Reader(data), []

    def show(code: bytes, at: tuple) -> None:
        nonlocal last, text
        width, table = font
        codes = [int.from_bytes(code[i : i + width]) for i in range(0, len(code), width)]
        shown = "".join(table.get(c, "") if table is not None else chr(c) if width == 1 else "" for c in codes)
        x, y, tall = at[4], at[5], abs(size * (at[3] or at[0])) or 1.0
        if not lines or last is None or abs(y - last[1]) > 0.4 * tall:
            lines.append(shown)
        else:
            gap = x - last[0] > 0.25 * tall and lines[-1][-1:].strip() and shown[:1].strip()
            lines[-1] += (" " if gap else "") + shown
        advance = 0.5 * size * len(codes)  # widths aren't read: half a letter's height is near enough for gaps
        text = _times((1.0, 0.0, 0.0, 1.0, advance, 0.0), at)
        last = (text[4], y)

    while (item := reader.value()) is not None:
        if type(item) is not Operator:
            held.append(item)
            continue
        numbers = [float(x) for x in held if isinstance(x, (int, float))]
        if item == b"BT":
            line = text = ONE
        elif item == b"Tf" and held and isinstance(held[0], str) and numbers:
            if held[0] not in decoders:
                decoders[held[0]] = _decoder(document, fonts.get(held[0])) if isinstance(fonts, dict) else (1, None)
            font, size = decoders[held[0]], numbers[-1]
        elif item == b"TL" and numbers:
            leading = numbers[0]
        elif item in (b"Td", b"TD") and len(numbers) > 1:
            leading = -numbers[1] if item == b"TD" else leading
            line = text = _times((1.0, 0.0, 0.0, 1.0, numbers[0], numbers[1]), line)
        elif item == b"Tm" and len(numbers) > 5:
            line = text = tuple(numbers[:6])
        elif item in (b"T*", b"'", b'"'):
            line = text = _times((1.0, 0.0, 0.0, 1.0, 0.0, -leading), line)
        if item in (b"Tj", b"'", b'"') and held and isinstance(held[-1], bytes):
            show(held[-1], text)
        elif item == b"TJ" and held and isinstance(held[-1], list):
            for part in held[-1]:
                if isinstance(part, bytes):
                    show(part, text)
                elif isinstance(part, (int, float)):
                    text = _times((1.0, 0.0, 0.0, 1.0, -part / 1000 * size, 0.0), text)
        elif item == b"BI":  # a picture in line
            end = data.find(b"EI", reader.at)
            reader.at = len(data) if end < 0 else end + 2
        held = []
    return "\n".join(x.rstrip() for x in lines)


def text_pages(data: bytes | None) -> list[str]:
    """The text layer of a file, page by page; nothing where it can't be read or is encrypted."""
    if not data or b"%PDF" not in data[:1024]:
        return []
    document = Document(data)
    return [] if "Encrypt" in document.trailer else [page_text(document, p) for p in document.pages()]


#: What a file says of itself and under which name it is kept (fixed values).
INFO = (("title", "Title"), ("author", "Author"), ("subject", "Subject"), ("creator", "Creator"), ("producer", "Producer"), ("created", "CreationDate"), ("modified", "ModDate"))


def info(data: bytes | None) -> dict[str, str]:
    """The properties of a file, and its number of pages; only what is there."""
    if not data or b"%PDF" not in data[:1024]:
        return {}
    document = Document(data)
    held = document.get(document.trailer.get("Info"))
    decode = lambda b: b[2:].decode("utf-16-be", "replace") if b[:2] == b"\xfe\xff" else b.decode("latin-1")
    found = {key: document.get(held.get(name)) for key, name in INFO} if isinstance(held, dict) else {}
    out = {k: decode(v).strip() for k, v in found.items() if isinstance(v, bytes) and decode(v).strip()}
    return out | {"pages": str(sum(1 for _ in document.pages()))}


LAYER = T.StructType([T.StructField(n, T.StringType()) for n in ("layer", "title", "pages")])


@F.pandas_udf(LAYER)
def read_layer(content: pd.Series) -> pd.DataFrame:
    """The text layer of a column of files, with their titles and numbers of pages."""
    found = [("\f".join(text_pages(c)), info(c)) for c in content]
    return pd.DataFrame({"layer": [t for t, _ in found], "title": [i.get("title") for _, i in found], "pages": [i.get("pages") for _, i in found]})


def convert(data: bytes) -> dict:
    """A PDF as a layout converter gives it: its pages without running lines as the body, the whole layer as what it is measured by."""
    from foliate.operators.recall import strip_running

    pages = text_pages(data)
    layer = "\f".join(pages)
    body = (strip_running(layer) or "").replace("\f", "\n\n").strip()
    return {"markdown": body + "\n" if body else "", "source_text": layer, "properties": info(data), "error": "" if body else "no-text-layer"}
