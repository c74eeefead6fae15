"""Queries over whole tables against brute force, where their SQL does less."""

import re
from collections import Counter, defaultdict

from foliate.plans import document_queries as queries


def plain_link(text, path):
    alt = re.sub(r"\s+", " ", text or "").strip()
    for a, b in (("\\", " "), ("]", "\\]"), ("|", "/"), ("`", "'")):
        alt = alt.replace(a, b)
    return f"![{alt}]({path})"


def test_image_links_hold_whole_texts(spark, data, tmp_path):
    made = {1: "a " * 150 + "b]c|d`e\\f\n\n g", 2: None, 3: "x" * 5000 + "|", 4: "", 5: " \t"}
    spark.createDataFrame(list(made.items()), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for folder in (str(tmp_path), data):
        texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
        got = queries.image_links(spark, folder).collect()
        assert len(got) == len(texts) and any(len(t or "") > 200 for t in texts.values())
        assert {r.doc_id: r.link for r in got} == {k: plain_link(t, f"images/{k}.png") for k, t in texts.items()}


def test_words_in_boxes_of_all_lines(spark, data):
    lines, want = defaultdict(list), Counter()
    for r in spark.read.parquet(f"{data}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").collect():
        lines[r.l_orderkey].append(r)
    for page, rows in lines.items():
        for w in rows:
            x = (w.l_partkey % 90 / 100 + (w.l_partkey % 90 + 4) / 100) / 2
            y = (w.l_suppkey % 90 / 100 + (w.l_suppkey % 90 + 2) / 100) / 2
            for b in rows:
                if b.l_partkey % 40 / 100 <= x <= (b.l_partkey % 40 + 40) / 100 and b.l_suppkey % 40 / 100 <= y <= (b.l_suppkey % 40 + 40) / 100:
                    want[page, f"w{w.l_linenumber}", b.l_linenumber] += 1
    got = queries.words_in_boxes(spark, data).collect()
    assert len(got) == len(want) and {(r.page, r.word, r.box): r.n for r in got} == want
    assert max(r.box for r in got) > 2
