"""Queries of the llm operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.llm import mixing, neardup, pii, scans, split, tokens, unify
from foliate.plans.core_queries import SECTIONS
from foliate.tables import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    bodies = neardup.near_duplicates(table(spark, d, "document_md", "doc_id", "body_md"), "doc_id", "body_md", k=3, threshold=0.6)
    paths = table(spark, d, "manifest", "doc_id", "source_relpath").distinct()
    paths = neardup.near_duplicates(paths, "doc_id", "source_relpath", k=1, threshold=0.5, bands=neardup.PATH_BANDS)
    return bodies.select(F.lit("body_md").alias("field"), "doc_a", "doc_b").unionByName(paths.select(F.lit("source_relpath").alias("field"), "doc_a", "doc_b"))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    """The group of near-copies that each document belongs to, by its body."""
    return neardup.duplicate_groups(table(spark, d, "document_md", "doc_id", "body_md"), "doc_id", "body_md", k=3, threshold=0.6)


def p3_pieces(spark: SparkSession, d: str, with_text: bool = True) -> DataFrame:
    """The pieces of every oversized section."""
    structure = table(spark, d, "structure", "structure_id", "doc_id", "markdown_sha256", "outline")
    return split.split_sections(structure, table(spark, d, "document_md", "doc_id", "body_md"), with_text=with_text)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """The sections that were split: each has a first piece."""
    return p3_pieces(spark, d, with_text=False).where("piece_no = 1").select("structure_id", "node_path")


def _scan_facts(spark: SparkSession, d: str) -> scans.FactTable:
    bodies = table(spark, d, "document_md", "body_md").withColumnRenamed("body_md", "t")
    sources = table(spark, d, "coverage_record", "source_text").withColumnRenamed("source_text", "t")
    return scans.FactTable(bodies.unionByName(sources))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    facts = _scan_facts(spark, d)
    bodies = scans.scan_cases(table(spark, d, "document_md", "doc_id", "body_md"), "body_md", "doc_id", "body_md", facts)
    sources = scans.scan_cases(table(spark, d, "coverage_record", "rec_id", "source_text"), "source_text", "rec_id", "source_text", facts)
    return bodies.unionByName(sources).distinct()


def p5_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Both text columns as continuous paragraphs."""
    facts = _scan_facts(spark, d)
    bodies = scans.repaired_column(table(spark, d, "document_md", "doc_id", "body_md"), "doc_id", "body_md", facts)
    sources = scans.repaired_column(table(spark, d, "coverage_record", "rec_id", "source_text"), "rec_id", "source_text", facts)
    named = [df.select(F.lit(field).alias("field"), F.col(key).cast("string").alias("rec_key"), "repaired") for df, field, key in ((bodies, "body_md", "doc_id"), (sources, "source_text", "rec_id"))]
    return named[0].unionByName(named[1]).distinct()


def p6_lines(spark: SparkSession, d: str) -> DataFrame:
    """Irregular lines of both text columns with their consistent form."""
    bodies = unify.irregular_lines(table(spark, d, "document_md", "doc_id", "body_md"), "body_md", "doc_id", "body_md")
    sources = unify.irregular_lines(table(spark, d, "coverage_record", "rec_id", "source_text"), "source_text", "rec_id", "source_text")
    return bodies.unionByName(sources).distinct()


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_lines(spark, d).select("field", "rec_key", "line_no").distinct()


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_column(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", tokens.vocabulary_path(spark))


def _counts(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents", "doc_id", "source", "text")
    return mixing.token_counts(documents, "doc_id", "source", "text", tokens.vocabulary_path(spark))


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The documents of the mixture with their number of copies."""
    mixed = mixing.mixture(_counts(spark, d), table(spark, d, "mix_targets"))
    return mixed.withColumnRenamed("doc_key", "doc_id")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual shares of the sources."""
    counts, targets = _counts(spark, d), table(spark, d, "mix_targets")
    return mixing.shares(counts, targets, mixing.mixture(counts, targets))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    given = pii.listed_names(table(spark, d, "given_names"))
    return pii.find_items(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", given).select("doc_id", "kind", "start_pos")


def p9_redacted(spark: SparkSession, d: str) -> DataFrame:
    given = pii.listed_names(table(spark, d, "given_names"))
    return pii.redact_column(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", given)


QUERIES = {"p2_found": p2_found, "p2_groups": p2_groups, "p3_found": p3_found, "p3_pieces": p3_pieces, "p5_found": p5_found, "p5_repaired": p5_repaired, "p6_found": p6_found, "p6_lines": p6_lines, "p7_ids": p7_ids, "p8_mixture": p8_mixture, "p8_shares": p8_shares, "p9_found": p9_found, "p9_redacted": p9_redacted}



def _similar(field: str, rows: str, k: int, threshold: float) -> tuple[str, str]:
    """All pairs by an index of the elements."""
    words = "regexp_extract_all(lower(t), '[\\p{L}\\p{N}]+')"
    gram = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    return f"""select '{field}' as field, a.doc_id as doc_a, b.doc_id as doc_b from
  (select doc_id, e, n from s_{k}) a join (select doc_id, e, n from s_{k}) b on a.e = b.e and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having count(*) >= {threshold} * (a.n + b.n - count(*))""", f"""s_{k} as (
  select doc_id, e, count(*) over (partition by doc_id) as n from (
    select distinct doc_id, {gram} as e from (select doc_id, w, unnest(range(1, len(w) - {k - 2})) as i from (select doc_id, {words} as w from ({rows})))))"""


_BODIES = _similar("body_md", "select doc_id, any_value(body_md) as t from document_md where doc_id is not null and body_md is not null group by 1", 3, 0.6)
_PATHS = _similar("source_relpath", "select distinct doc_id, source_relpath as t from manifest where doc_id is not null and source_relpath is not null", 1, 0.5)

SQL: dict[str, str] = {
    "p2_groups": f"""with recursive {_BODIES[1]}, pairs as ({_BODIES[0]}),
 sym as (select doc_a as x, doc_b as y from pairs union select doc_b, doc_a from pairs),
 docs as (select doc_id, any_value(body_md) as body from document_md where doc_id is not null group by 1),
 sets as (select doc_id, md5(string_agg(e, '|' order by e)) as own from s_3 group by 1),
 short as (select doc_id, min(doc_id) over (partition by body) as least from docs where body is not null and doc_id not in (select doc_id from sets)),
 reach as (select x, y from sym union select r.x, b.y from reach r join sym b on b.x = r.y),
 least as (select x, min(y) as y from reach group by 1),
 links as (select b.x, count(distinct s.own) as n from sym b join sets s on s.doc_id = b.y join sets t on t.doc_id = b.x where s.own <> t.own group by 1)
 select d.doc_id, coalesce(least(d.doc_id, l.y), short.least, d.doc_id) as class_id, coalesce(k.n, 0) as links from docs d left join least l on l.x = d.doc_id left join short on short.doc_id = d.doc_id left join links k on k.x = d.doc_id""",
    "p2_found": f"with {_BODIES[1]}, {_PATHS[1]} {_BODIES[0]} union all {_PATHS[0]}",
    "p3_found": f"""with recursive {SECTIONS},
 b as (select doc_id, sha256(body_md) as sha, string_split(any_value(body_md), chr(10)) as lines from document_md group by doc_id, sha256(body_md)),
 x as (select s.structure_id, item_path, lines, try_cast(json_extract(node, '$.line_span[0]') as bigint) as a, try_cast(json_extract(node, '$.line_span[1]') as bigint) as z
   from sections join structure s using (structure_id) join b on b.doc_id = s.doc_id and b.sha = regexp_replace(lower(trim(s.markdown_sha256)), '^sha256:', ''))
 select structure_id, item_path as node_path from x where a < z and list_sum(list_transform(lines[greatest(a, 0) + 1:z], lambda l: (len(l) + 3) // 4)) > 1200""",
}
