"""Deeply nested records as flat, linked tables: columnar shredding with repetition and definition levels.

A record is a tree of *nodes*. Each node has scalar leaves and repeated groups; one of the groups (the
recursive one, e.g. ``children``) holds nodes again, the others (e.g. ``images``, ``links``) hold items.
Shredding turns a batch of records into one column per path: for each depth and group one for the group itself and one
for each of its leaves (``children.title``, ``children.children.title``, ...). An entry of a column is (repetition
level, definition level); a leaf's column holds the values besides, only those that are defined, in order:

* repetition level: the depth of the repeated group at which the entry repeats; 0 begins a record,
  a level below the column's own begins the list of the next parent, the column's own level continues a list;
* definition level, counted within the parent, which is always defined: 0 the list is missing or empty,
  1 the list has this slot but its element is null, 2 the element is there; of a leaf also
  2 the element lacks it, 3 it is null, 4 it has a value.

Entries whose parent is itself undefined are elided: the parent's own column carries them. So the number of
entries grows with the number of nodes and not with nodes times depth, whatever the nesting.

A table per repeated ancestor is then rebuilt from the level sequences alone: a repetition level below the
own one moves on to the next defined parent and starts counting at 1, the own level counts on, and the
definition level says whether the slot gives a row. Positions count null slots. A leaf's definition level says
whether its row takes the next value, so missing, null and present ones are told apart.

Defined results for dirty input
  null record, JSON that is damaged or incomplete, a scalar document: no row;
  a single object where a list is expected: a list of one;
  a JSON string that itself holds JSON, at any level: what it holds;
  null, numbers, booleans, plain text and nested lists as elements: they count in positions and give no row;
  missing, null or empty lists: no row;  NaN and Infinity: not JSON, so the record gives no row;
  repeated keys in an object: the last one counts;  any depth: no recursion is used beyond the C parser's
  own bound, and above it a plain iterative parser takes over.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TreeSpec:
    """Names of a recursive record: its recursive group, the other groups, and the leaves to keep.

    kinds maps a group to the item_kind of its rows; the recursive group's kind is that of the nodes.
    Leaves are returned as text (strings as they are, other values as JSON), nulls as null.
    """

    recursive: str = "children"
    kinds: dict[str, str] = field(default_factory=lambda: {"children": "section", "images": "image", "links": "link"})
    leaves: dict[str, tuple[str, ...]] = field(default_factory=dict)


MISSING, NULL, VALUE = 2, 3, 4  # definition levels of a leaf whose element is there


class Leaf:
    """Definition levels and values of one leaf path; its repetition levels are those of its group."""

    __slots__ = ("defs", "values")

    def __init__(self):
        self.defs: list[int] = []
        self.values: list = []

    def aligned(self) -> tuple[list[int], list]:
        """(definition level, value or None) of every element that is there."""
        defs = [d for d in self.defs if d >= MISSING]
        values = iter(self.values)
        return defs, [next(values) if d == VALUE else None for d in defs]


class Column:
    """Levels of one group's path, and its leaves."""

    __slots__ = ("defs", "leaves", "reps")

    def __init__(self, leaves: tuple[str, ...]):
        self.reps: list[int] = []
        self.defs: list[int] = []
        self.leaves: dict[str, Leaf] = {name: Leaf() for name in leaves}


def _no_constant(name: str):
    raise ValueError(f"{name} is not JSON")


_decode = json.JSONDecoder(parse_constant=_no_constant).decode
_TOKEN = re.compile(r'[ \t\r\n]*(?:([\[\]{},:])|("(?:[^"\\\x00-\x1f]|\\.)*")|([^\s\[\]{},:"]+))')
_SCALARS = (str, int, float, bool, type(None))


def _parse_deep(text: str):
    """JSON without recursion, for documents nested deeper than the C parser goes."""
    root: list = []
    stack: list = [root]  # containers that are open
    keys: list[str | None] = [None]
    need, pos, end = "value", 0, len(text.rstrip(" \t\r\n"))
    # need: value, value-or-end, key, key-or-end, colon, comma
    while pos < end:
        m = _TOKEN.match(text, pos)
        if not m:
            raise ValueError("not JSON")
        pos, (mark, string, other) = m.end(), m.groups()
        top = stack[-1]
        if mark and mark in ",:":
            if need != ("comma" if mark == "," else "colon") or len(stack) == 1:
                raise ValueError("not JSON")
            need = "value" if mark == ":" else ("key" if isinstance(top, dict) else "value")
            continue
        if mark and mark in "]}":
            if len(stack) == 1 or (mark == "}") != isinstance(top, dict) or need not in ("comma", "value-or-end", "key-or-end"):
                raise ValueError("not JSON")
            stack.pop()
            keys.pop()
            need = "comma"
            continue
        if need in ("key", "key-or-end"):
            if not string:
                raise ValueError("not JSON")
            keys[-1], need = _decode(string), "colon"
            continue
        if need not in ("value", "value-or-end"):
            raise ValueError("not JSON")
        new = [] if mark == "[" else {} if mark == "{" else _decode(string or other)
        if isinstance(top, dict):
            top[keys[-1]] = new
        else:
            top.append(new)
        if mark:
            stack.append(new)
            keys.append(None)
            need = "value-or-end" if mark == "[" else "key-or-end"
        else:
            need = "comma"
    if len(stack) != 1 or len(root) != 1:
        raise ValueError("not JSON")
    return root[0]


def parse_json(text: str | None):
    """The value of a complete JSON text; None where it is null, damaged or incomplete."""
    if text is None:
        return None
    try:
        return _decode(text)
    except RecursionError:
        try:
            return _parse_deep(text)
        except ValueError:
            return None
    except ValueError:
        return None


def _unwrap(value):
    """What a JSON string holds stands for it."""
    while isinstance(value, str):
        head = value.lstrip(" \t\r\n")[:1]
        if head not in ('"', "{", "["):
            return None
        value = parse_json(value)
    return value


def _slots(value) -> list:
    value = _unwrap(value)
    if isinstance(value, dict):
        return [value]
    return value if isinstance(value, list) else []


def shred(texts: list[str | None], spec: TreeSpec) -> dict[tuple[int, str], Column]:
    """The columns of a batch of records, by (depth of the parent, group); depth 0 is the record itself."""
    columns: dict[tuple[int, str], Column] = {}
    groups = list(spec.kinds)
    parents: list = texts
    depth = 0
    starts: list[int] = [0] * len(texts)  # the level at which each parent's first entry repeats
    while parents:
        following: list = []
        following_starts: list[int] = []
        for group in groups if depth else [spec.recursive]:
            column = Column(spec.leaves.get(group, ()))
            reps, defs, leaves, own = column.reps, column.defs, list(column.leaves.items()), depth + 1
            recursive = group == spec.recursive
            for parent, level in zip(parents, starts):
                raw = parse_json(parent) if depth == 0 else parent.get(group)
                slots = _slots(raw) if raw is not None else ()
                if not slots:
                    reps.append(level)
                    defs.append(0)
                    for _, leaf in leaves:
                        leaf.defs.append(0)
                    continue
                for element in slots:
                    reps.append(level)
                    if type(element) is str:
                        element = _unwrap(element)
                    if type(element) is dict:
                        defs.append(2)
                        for name, leaf in leaves:
                            value = element.get(name, leaf)
                            if value is leaf:
                                leaf.defs.append(MISSING)
                            elif value is None:
                                leaf.defs.append(NULL)
                            else:
                                leaf.defs.append(VALUE)
                                leaf.values.append(value)
                        if recursive:
                            following.append(element)
                            following_starts.append(level)
                    else:
                        defs.append(1)
                        for _, leaf in leaves:
                            leaf.defs.append(1)
                    level = own
            if 2 in defs or 1 in defs or depth == 0:
                columns[depth, group] = column
        parents, starts, depth = following, following_starts, depth + 1
    return columns


def _as_text(value) -> str | None:
    if value is None or type(value) is str:
        return value
    return json.dumps(value, ensure_ascii=False)


def assemble(columns: dict[tuple[int, str], Column], spec: TreeSpec) -> Iterator[tuple[str, np.ndarray, list[str], list[str], dict[str, tuple[list[int], list]]]]:
    """Rebuild the tables from the level sequences: (item kind, record numbers, paths, parents' paths, levels and values of the leaves)."""
    at_depth: list[str] = []
    record = np.zeros(0, np.int64)
    depth = 0
    while any((depth, group) in columns for group in spec.kinds):
        nodes = None
        for group, kind in spec.kinds.items():
            column = columns.get((depth, group))
            if column is None:
                continue
            reps, defs = np.asarray(column.reps, np.int32), np.asarray(column.defs, np.int8)
            begins = reps <= depth
            parent = np.cumsum(begins) - 1
            index = np.arange(len(reps))
            position = index - np.maximum.accumulate(np.where(begins, index, 0)) + 1
            there = defs == 2
            parent, position = parent[there], position[there]
            if depth == 0:
                records, above = parent, [""] * len(parent)
                paths = [str(p) for p in position.tolist()]
            else:
                records = record[parent]
                above = [at_depth[p] for p in parent.tolist()]
                mark = "." if group == spec.recursive else "/"
                paths = [f"{a}{mark}{p}" for a, p in zip(above, position.tolist())]
            yield kind, records, paths, above, {name: leaf.aligned() for name, leaf in column.leaves.items()}
            if group == spec.recursive:
                nodes = records, paths
        if nodes is None or not len(nodes[0]):
            return
        record, at_depth = nodes
        depth += 1


def shred_tables(df: DataFrame, id_col: str, json_col: str, spec: TreeSpec | None = None) -> DataFrame:
    """Rows (id, item_kind, item_path, parent_path, leaves map) of every node and item of every record.

    One pass over the rows, no shuffle: a record is shredded where it is read. Filter on item_kind for the
    table of one kind; parent_path is the key of the parent's row in the table of nodes.
    The leaves map holds (definition level, value) of the leaves named in spec.leaves; it is left out where none is named.
    Input columns other than the two named are not read, so clashing names don't matter.
    """
    spec = spec or TreeSpec()
    kind_type = df.schema[id_col].dataType.simpleString()
    keep = any(spec.leaves.values())
    ids = df.select(F.col(id_col).alias("id"), F.col(json_col).alias("doc")).where(F.col("doc").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                keys, texts = batch.column(0), batch.column(1).to_pylist()
                for kind, records, paths, above, leaves in assemble(shred(texts, spec), spec):
                    if not paths:
                        continue
                    out = [keys.take(pa.array(records)), pa.array([kind] * len(paths)), pa.array(paths), pa.array(above)]
                    if keep:
                        columns = [[(name, {"def": d, "value": _as_text(v)}) for d, v in zip(*leaf)] for name, leaf in leaves.items()]
                        rows = list(zip(*columns)) if columns else [()] * len(paths)
                        out.append(pa.array([list(r) for r in rows], pa.map_(pa.string(), pa.struct([("def", pa.int8()), ("value", pa.string())]))))
                    yield pa.RecordBatch.from_arrays(out, ["id", "item_kind", "item_path", "parent_path", "leaves"][: len(out)])

    out = ids.mapInArrow(run, f"id {kind_type}, item_kind string, item_path string, parent_path string" + ", leaves map<string,struct<def:tinyint,value:string>>" * keep)
    return out.withColumnRenamed("id", id_col)
