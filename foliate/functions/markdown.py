"""Markdown as plain text: a state machine over the lines of each document, in Arrow batches."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Constructs of Markdown (fixed patterns).
_COMMENT = re.compile(r"(?<!\\)<!--.*?-->", re.DOTALL)
FENCE_ANY = re.compile(r"\s*(?:`{3,}|~{3,})")
_EMPTY = re.compile(r"\s*(?:([-*_])(?:\s*\1){2,}|=+|-+|\|?[\s:|-]*-[\s:|-]*\|?)\s*")  # rules, underlines, table separators
_QUOTE = re.compile(r"\s*>+\s?")
_HEAD, _HEAD_END = re.compile(r"\s*#{1,6}\s+"), re.compile(r"\s+#+\s*$")
_ITEM = re.compile(r"\s*(?:[-*+]|\d+[.)])\s+")
_ESCAPED = re.compile(r"\\([!-/:-@\[-`{-~])")
_HIDDEN = re.compile("\x00([0-9a-f]{2})")
_MARK = re.compile(r"[\[<`*_~\x00]")
#: What each inline construct leaves, in the order in which they are taken off, and two marks of which it has one.
_INLINE = [
    (re.compile(r"!\[([^\]]*)\]\([^)]*\)"), 1, "![", "!["),
    (re.compile(r"!?\[([^\]]*)\]\([^)]*\)"), 1, "](", "]("),
    (re.compile(r"\[([^\]]*)\]\[[^\]]*\]"), 1, "][", "]["),
    (re.compile(r"<((?:https?://|mailto:)[^>]+)>"), 1, "<", "<"),
    (re.compile(r"`+([^`]*)`+"), 1, "`", "`"),
    (re.compile(r"(\*\*|__)(.+?)\1", re.DOTALL), 2, "**", "__"),
    (re.compile(r"~~(.+?)~~", re.DOTALL), 1, "~~", "~~"),
    (re.compile(r"(?<![\w*_])([*_])(?=\S)(.+?)(?<=\S)\1(?![\w*_])", re.DOTALL), 2, "*", "_"),
]
_BAR = re.compile(r"(?<!\\)\|")
_GAP = re.compile(r"[ \t]{2,}|\t")


def inline_text(text: str) -> str:
    """Without inline marks; escaped punctuation is literal."""
    if not _MARK.search(_ESCAPED.sub("", text) if "\\" in text else text):
        return _ESCAPED.sub(r"\1", text) if "\\" in text else text
    if "\\" in text:
        text = _ESCAPED.sub(lambda m: f"\x00{ord(m[1]):02x}", text)
    for pattern, group, mark, other in _INLINE:
        if mark in text or other in text:
            text = pattern.sub(lambda m, g=group: m[g], text)
    return _HIDDEN.sub(lambda m: chr(int(m[1], 16)), text) if "\x00" in text else text


def row_text(line: str) -> str:
    """The cells of a table row, joined by blanks."""
    s = line.strip()
    s = s[1:] if s.startswith("|") else s
    s = s[:-1] if s.endswith("|") else s
    return " ".join([t for c in (_BAR.split(s) if "\\" in s else s.split("|")) if (t := c.strip())])


def to_text(md: str | None) -> str:
    """The prose of a document: no marks, rules, separators, fences or comments; links and images leave their text."""
    out, code = [], False
    for raw in _COMMENT.sub(" ", (md or "").replace("\x00", "")).split("\n"):
        sign = raw.lstrip()[:1]
        if sign in "`~" and FENCE_ANY.match(raw):
            code = not code
        elif code:
            out.append(raw.rstrip())
        elif not sign:
            out.append("")
        elif sign.isalpha() or sign == "\\":  # no mark of a line begins so
            out.append(_GAP.sub(" ", inline_text(raw)).strip())
        elif _EMPTY.fullmatch(raw):
            out.append("")
        else:
            line = _QUOTE.sub("", raw, count=1) if sign == ">" else raw
            if sign == "|":
                line = row_text(line)
            elif _HEAD.match(line):
                line = _HEAD_END.sub("", line[_HEAD.match(line).end() :])
            if sign != "|" and (m := _ITEM.match(line)):
                line = line[m.end() :]
            out.append(_GAP.sub(" ", inline_text(line)).strip())
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip()


@F.pandas_udf(T.StringType())
def markdown_to_text(md: pd.Series) -> pd.Series:
    return md.map(to_text)
