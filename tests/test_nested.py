"""Shredding of nested records, against a plain recursive walk."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliate.operators import nested
from foliate.plans.core_queries import p1_found

KINDS = {"children": "section", "images": "image", "links": "link"}


def walk(value, group="children", above="", out=None):
    """Brute force: the rows of a document by recursion."""
    out = [] if out is None else out
    while isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            return out
    for i, e in enumerate([value] if isinstance(value, dict) else value if isinstance(value, list) else [], 1):
        while isinstance(e, str):
            try:
                e = json.loads(e)
            except ValueError:
                break
        if not isinstance(e, dict):
            continue
        path = (f"{above}.{i}" if above else str(i)) if group == "children" else f"{above}/{i}"
        out.append((KINDS[group], path, above))
        if group == "children":
            for g in KINDS:
                walk(e.get(g), g, path, out)
    return out


def shredded(docs):
    spec = nested.TreeSpec()
    rows = {i: [] for i in range(len(docs))}
    for kind, records, paths, above, _ in nested.assemble(nested.shred(docs, spec), spec):
        for r, p, a in zip(records.tolist(), paths, above):
            rows[r].append((kind, p, a))
    return [sorted(rows[i]) for i in range(len(docs))]


def brute(doc):
    try:
        return sorted(walk(json.loads(doc))) if doc is not None else []
    except ValueError:
        return []


items = st.one_of(st.none(), st.integers(), st.just("text"), st.fixed_dictionaries({"line": st.integers()}), st.just('{"line": 1}'))
lists = st.one_of(st.none(), items, st.lists(items, max_size=3))
nodes = st.recursive(
    st.fixed_dictionaries({"title": st.text(max_size=3)}, optional={"images": lists, "links": lists}),
    lambda inner: st.fixed_dictionaries({}, optional={"children": st.one_of(st.none(), inner, st.lists(st.one_of(st.none(), inner, inner.map(json.dumps)), max_size=3)), "images": lists}),
    max_leaves=12,
)
docs = st.one_of(st.none(), st.lists(st.one_of(st.none(), nodes), max_size=3).map(json.dumps), nodes.map(json.dumps), nodes.map(lambda n: json.dumps(json.dumps(n))), nodes.map(lambda n: json.dumps(n)[:-1]), st.just("NaN x"))


@settings(max_examples=150, deadline=None)
@given(st.lists(docs, max_size=6))
def test_levels_rebuild_what_recursion_finds(batch):
    assert shredded(batch) == [brute(d) for d in batch]


def test_defined_cases():
    deep = '[{"children":' * 5000 + "null" + "}]" * 5000
    got = shredded([None, "", "[", "[]", "3", "[NaN]", '{"children": [null, {}, 4, "x", [{}]]}', deep])
    assert got[:6] == [[]] * 6
    assert got[6] == [("section", "1", ""), ("section", "1.2", "1")]
    assert len(got[7]) == 5000 and ("section", ".".join(["1"] * 5000), ".".join(["1"] * 4999)) in got[7]


def test_deep_parser_agrees():
    for text in ['[1,{"a":[],"b":{"c":"\\u00e9 ]"}},"x",true,null,-1.5e3]', "[1,]", '{"a"}', '{"a":1 "b":2}', "[1]]", "", "[}", '{"a":1,}', "[,1]", "{1:2}"]:
        try:
            want = json.loads(text)
        except ValueError:
            want = ValueError
        try:
            got = nested._parse_deep(text)
        except ValueError:
            got = ValueError
        assert got == want, text


def test_leaves_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, '[{"title":"A","level":2,"images":[{"ref":"r"}]}]', "x")], "key long, doc string, item_path string")
    spec = nested.TreeSpec(leaves={"children": ("title", "level"), "images": ("ref",)})
    rows = {(r.item_kind, r.item_path, r.parent_path): {k: tuple(v) for k, v in r.leaves.items()} for r in nested.shred_tables(df, "key", "doc", spec).collect()}
    assert rows == {("section", "1", ""): {"title": (4, "A"), "level": (4, "2")}, ("image", "1/1", "1"): {"ref": (4, "r")}}
    assert nested.shred_tables(df.where("key < 0"), "key", "doc").count() == 0


def test_query_against_recursion(spark, data):
    got = sorted((r.structure_id, r.item_kind, r.item_path, r.parent_path) for r in p1_found(spark, data).collect())
    want = spark.read.parquet(f"{data}/structure.parquet").where(F.col("outline").isNotNull()).select("structure_id", "outline").collect()
    assert got == sorted((i, *row) for i, o in want for row in brute(o))
    assert got


def test_levels_of_leaf_paths():
    spec = nested.TreeSpec(kinds={"children": "section"}, leaves={"children": ("title",)})
    docs = ['[{"title":"A","children":[{"title":null},null,{}]},{"children":{"title":"B"}},7]', "[]", None, '{"title":["x"]}']
    columns = nested.shred(docs, spec)
    top, below = columns[0, "children"], columns[1, "children"]
    assert (top.reps, top.defs, top.leaves["title"].defs, top.leaves["title"].values) == ([0, 1, 1, 0, 0, 0], [2, 2, 1, 0, 0, 2], [4, 2, 1, 0, 0, 4], ["A", ["x"]])
    assert (below.reps, below.defs, below.leaves["title"].defs, below.leaves["title"].values) == ([0, 2, 2, 1, 0], [2, 1, 2, 2, 0], [3, 1, 2, 4, 0], ["B"])
    rows = [(r, p, d, v) for _, records, paths, _, leaves in nested.assemble(columns, spec) for r, p, d, v in zip(records.tolist(), paths, *leaves["title"])]
    assert rows == [(0, "1", 4, "A"), (0, "2", 2, None), (3, "1", 4, ["x"]), (0, "1.1", 3, None), (0, "1.3", 2, None), (0, "2.1", 4, "B")]
