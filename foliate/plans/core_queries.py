"""Queries of the core's training-data operators and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.operators import ledger, nested
from foliate.session import session_dir
from foliate.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    rows = nested.shred_tables(table(spark, d, "structure", "structure_id", "outline"), "structure_id", "outline")
    return rows.select("structure_id", "item_kind", "item_path", "parent_path")


def p1_sections(spark: SparkSession, d: str) -> DataFrame:
    """Every section with its title and level, and whether the record lacks them, has null or a value (definition levels 2, 3, 4)."""
    spec = nested.TreeSpec(kinds={"children": "section"}, leaves={"children": ("title", "level")})
    rows = nested.shred_tables(table(spark, d, "structure", "structure_id", "outline"), "structure_id", "outline", spec)
    leaf = lambda n: [F.col(f"leaves.{n}.value").alias(n), F.col(f"leaves.{n}.def").cast("int").alias(f"{n}_def")]
    return rows.select("structure_id", "item_path", "parent_path", *leaf("title"), *leaf("level"))


def p4_commits(spark: SparkSession, d: str) -> DataFrame:
    """Committed reports: those with a structure row of the same run, document and hashes.

    One aggregation over the union of both tables stands for the join: it combines repeated rows before the shuffle.
    """
    key = ["run_no", "doc_id", "src", "md"]
    hashes = [F.col("run_no"), F.col("doc_id"), ledger.hash_key(F.col("source_sha256")).alias("src"), ledger.hash_key(F.col("markdown_sha256")).alias("md")]
    report = table(spark, d, "report", "run_no", "doc_id", "source_sha256", "markdown_sha256", "status", "written_at")
    report = report.where(F.lower(F.trim("status")).isin("ok", "degraded")).select(*hashes, F.col("written_at"), F.lit(1).alias("side"))
    structure = table(spark, d, "structure", "run_no", "doc_id", "source_sha256", "markdown_sha256")
    structure = structure.select(*hashes, F.lit(None).cast("timestamp_ntz").alias("written_at"), F.lit(2).alias("side"))
    both = report.unionByName(structure).where(" and ".join(f"{k} is not null" for k in key))
    both = both.groupBy(*key).agg(F.min("side").alias("a"), F.max("side").alias("b"), F.max("written_at").alias("at"))
    return both.where("a = 1 and b = 2").select("run_no", F.col("doc_id").alias("item_key"), F.col("src").alias("version"), F.col("at").alias("committed_at"))


def p4_offers(spark: SparkSession, d: str) -> DataFrame:
    """What each run's listing offers."""
    plan = table(spark, d, "plan", "run_no", "doc_id", "source_sha256", "scanned_at")
    return plan.select("run_no", F.col("doc_id").alias("item_key"), F.col("source_sha256").alias("version"), F.col("scanned_at").alias("seen_at"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The items that the ledger leases in each run, its states driven over the logs of all runs."""
    store = ledger.LedgerStore(spark, f"{session_dir(spark)}/ledger-{uuid.uuid4().hex}")
    pending = ledger.replay_runs(store, p4_offers(spark, d), p4_commits(spark, d))
    return pending.select(F.col("run_no").cast("bigint").alias("run_no"), F.col("item_key").alias("doc_id"))


QUERIES = {"p1_found": p1_found, "p1_sections": p1_sections, "p4_found": p4_found}

_HASH = "nullif(regexp_replace(lower(trim({})), '^sha256:', ''), '')"




def _array(x: str) -> str:
    """A JSON value as a list: a string stands for what it holds, an object for a list of one."""
    held = f"case when json_type({x}) = 'VARCHAR' then try_cast(json_extract_string({x}, '$') as json) else {x} end"
    return f"case json_type({held}) when 'ARRAY' then cast({held} as json[]) when 'OBJECT' then [{held}] else cast([] as json[]) end"


def _element(x: str) -> str:
    return f"case when json_type({x}) = 'VARCHAR' then try_cast(json_extract_string({x}, '$') as json) else {x} end"


#: Sections of all outlines: sections(structure_id, parent_path, item_path, node).
SECTIONS = f"""r as (select structure_id, cast(outline as json) as j from structure where outline is not null and json_valid(outline)),
sections as (
  select structure_id, '' as parent_path, cast(i as varchar) as item_path, {_element("e")} as node
  from (select structure_id, unnest({_array("j")}) as e, generate_subscripts({_array("j")}, 1) as i from r) where json_type({_element("e")}) = 'OBJECT'
  union all
  select structure_id, item_path, item_path || '.' || i, {_element("e")}
  from (select structure_id, item_path, unnest({_array("json_extract(node, '$.children')")}) as e, generate_subscripts({_array("json_extract(node, '$.children')")}, 1) as i from sections) where json_type({_element("e")}) = 'OBJECT')"""


def _items(group: str, kind: str) -> str:
    items = _array(f"json_extract(node, '$.{group}')")
    return f"""select structure_id, '{kind}' as item_kind, item_path || '/' || i as item_path, item_path as parent_path
  from (select structure_id, item_path, unnest({items}) as e, generate_subscripts({items}, 1) as i from sections) where json_type({_element("e")}) = 'OBJECT'"""


def _defined(leaf: str) -> str:
    return f"case when json_extract(node, '$.{leaf}') is null then 2 when json_type(json_extract(node, '$.{leaf}')) = 'NULL' then 3 else 4 end"


SQL = {
    "p1_found": f"""with recursive {SECTIONS}
select structure_id, 'section' as item_kind, item_path, parent_path from sections
union all {_items("images", "image")}
union all {_items("links", "link")}""",
    "p1_sections": f"""with recursive {SECTIONS}
select structure_id, item_path, parent_path, json_extract_string(node, '$.title') as title, {_defined("title")} as title_def, json_extract_string(node, '$.level') as level, {_defined("level")} as level_def from sections""",
    "p4_found": f"""
with p as (
  select run_no, doc_id, {_HASH.format("source_sha256")} as h,
         row_number() over (partition by run_no, doc_id order by scanned_at desc, {_HASH.format("source_sha256")} desc nulls last) as k
  from plan where doc_id is not null and run_no is not null),
c as (
  select r.doc_id, r.run_no, {_HASH.format("r.source_sha256")} as h, max(r.written_at) as t
  from report r join structure s on r.run_no = s.run_no and r.doc_id = s.doc_id
    and {_HASH.format("r.source_sha256")} = {_HASH.format("s.source_sha256")}
    and {_HASH.format("r.markdown_sha256")} = {_HASH.format("s.markdown_sha256")}
  where lower(trim(r.status)) in ('ok', 'degraded') group by all),
one as (select *, row_number() over (partition by doc_id, run_no order by t desc nulls last, h desc) as k from c),
j as (
  select p.run_no, p.doc_id, p.h, arg_max(o.h, o.run_no) as done
  from p left join one o on o.doc_id = p.doc_id and o.run_no < p.run_no and o.k = 1
  where p.k = 1 and p.h is not null group by all)
select cast(run_no as bigint) as run_no, doc_id from j where h is distinct from done""",
}
