"""Queries of the document operators over whole tables, each with SQL that computes the same where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.functions import text as fn
from foliate.functions.markdown import markdown_to_text
from foliate.operators import assets, dataflow, figures, layout, outline, recall, recovery, validation
from foliate.sources import fixtures, pdf
from foliate.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql.replace("count_if(", "count(*) filter (where ")
        return f

    return add


WS = f"[{fn.SPACE}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def sql_squeeze(x: str) -> str:
    squeezed = f"regexp_replace({x}, '{WS}+', ' ', 'g')"
    return f"regexp_replace({squeezed}, '^ +| +$', '', 'g')"


BASE = "list_extract(string_split(replace({0}, '\\', '/'), '/'), -1)".format(sql_strip("coalesce(n, '')"))
EXT = f"case when contains(regexp_replace({BASE}, '^\\.+', ''), '.') then lower({sql_strip(f'list_extract(string_split({BASE}, {chr(39)}.{chr(39)}), -1)')}) else '' end"
LANE = "case " + " ".join(f"when ext in ({', '.join(repr(e) for e in exts)}) then '{lane}'" for lane, exts in fn.LANES.items()) + " else 'unsupported' end"


def sql_classified(source: str, accept: str | None = None) -> str:
    allowed = ", ".join(repr(e) for e in sorted(fn.accepted_formats(accept)))
    return f"""a as (select n, {EXT} as ext from ({source})), b as (select n, ext, {LANE} as lane, ext in ({allowed}) as ok from a),
    c as (select n, ext, lane, (lane <> 'unsupported' and ok) as accepted,
      case when lane = 'unsupported' then 'unsupported format ' || case when ext = '' then '(no extension)' else '.' || ext end
           when not ok then 'format .' || ext || ' excluded by accept-list' else '' end as reason from b)"""


ACCEPT = "docx, pdf; md"


@query(f"with {sql_classified('select distinct source_relpath as n from plan where source_relpath is not null', ACCEPT)} select n as source_relpath, ext, lane, accepted, reason from c")
def route_classify(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "plan", "source_relpath").where("source_relpath is not null").distinct()
    return names.select("source_relpath", fn.classify("source_relpath", ACCEPT).alias("c")).select("source_relpath", "c.*")


@query(f"with {sql_classified('select source_relpath as n from manifest', ACCEPT)} select lane, case when accepted then 'accepted' when lane = 'unsupported' then 'unsupported' else 'declined' end as verdict, count(*) as n, min(n) as first_name from c group by 1, 2")
def route_rollup(spark: SparkSession, d: str) -> DataFrame:
    return dataflow.route_rollup(table(spark, d, "manifest", "source_relpath"), "source_relpath", ACCEPT)


@query(f"with a as (select {EXT} as ext from (select source_relpath as n from plan)) select case when ext = '' then 'no-ext' else ext end as ext, count(*) as n from a group by 1")
def extension_counts(spark: SparkSession, d: str) -> DataFrame:
    return dataflow.extension_counts(table(spark, d, "plan", "source_relpath"), "source_relpath")


@query(f"with {sql_classified('select source_relpath as n from plan', ACCEPT)} select ext, lane, reason, count(*) as n from c where not accepted group by all")
def unconverted_warnings(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "plan", "source_relpath").select(fn.classify("source_relpath", ACCEPT).alias("c")).select("c.*")
    return c.where("not accepted").groupBy("ext", "lane", "reason").agg(F.count("*").alias("n"))


@query("select distinct source_relpath, substr(sha1(source_relpath), 1, 16) as id, substr(sha1(source_relpath), 1, 16) = doc_id as same from plan where source_relpath is not null")
def document_ids(spark: SparkSession, d: str) -> DataFrame:
    id_ = fn.document_id("source_relpath")
    return table(spark, d, "plan", "source_relpath", "doc_id").where("source_relpath is not null").select("source_relpath", id_.alias("id"), (id_ == F.col("doc_id")).alias("same")).distinct()


TOKENS = "regexp_extract_all(lower(coalesce({0}, '')), '[a-z0-9]+')"


@query(f"select doc_id, cast(len(t) as bigint) as n_tokens, cast(len(list_distinct(t)) as bigint) as n_distinct from (select doc_id, {TOKENS.format('text')} as t from documents)")
def token_stats(spark: SparkSession, d: str) -> DataFrame:
    t = fn.tokenize("text")
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", F.size(t).cast("bigint").alias("n_tokens"), F.size(F.array_distinct(t)).cast("bigint").alias("n_distinct"))


@query(f"select t.token, count(*) as n, count(distinct doc_id) as n_docs from (select doc_id, unnest({TOKENS.format('text')}) as token from documents) t group by 1")
def token_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents", "doc_id", "text").select("doc_id", F.explode(fn.tokenize("text")).alias("token"))
    per = rows.groupBy("token", "doc_id").agg(F.count("*").alias("k"))
    return per.groupBy("token").agg(F.sum("k").alias("n"), F.count("*").alias("n_docs"))


def _page(text):
    """A page around a text, with parts that don't show and with references of all kinds."""
    shown = F.coalesce(text, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), ("e", "&#101;"), ("o", "&#x6F;"), ("é", "&eacute;"), ("ß", "&szlig;"), ("—", "&mdash;")):
        shown = F.replace(shown, F.lit(a), F.lit(b)) if a != "e" else F.regexp_replace(shown, "(?<!&)e", b)
    return F.concat(F.lit("<html><style>p { a: b }</style><!-- c <p> --><SCRIPT type='x'>if (a < b) c();</SCRIPT ><p class=\"k\">"), shown, F.lit("</p>\n</html>"))


# what shows: a blank for each tag, comment, script and style, and the text as it was
@query("select doc_id, md5(repeat(' ', 5) || coalesce(text, '') || ' ' || chr(10) || ' ') as digest from documents")
def visible_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", F.md5(fn.visible_text(_page(F.col("text")))).alias("digest"))


def bodies(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "document_md", "doc_id", "body_md").dropDuplicates(["doc_id"])


def latest(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The last coverage record of each document."""
    return dataflow.last_wins(table(spark, d, "coverage_record", "id", "ts", "rec_id", *columns), "id", ["ts", "rec_id"])


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    source = latest(spark, d, "source_text").select(F.col("id").alias("key"), F.col("source_text").alias("text"))
    return source, bodies(spark, d).select(F.col("doc_id").alias("key"), F.col("body_md").alias("text"))


SIDES = """s as (select id as key, source_text as text from (select *, row_number() over (partition by id order by ts desc, rec_id desc) as k from coverage_record where id is not null) where k = 1),
 t as (select doc_id as key, any_value(body_md) as text from document_md group by 1)"""
BAGS = f"""{SIDES}, sb as (select key, token, count(*) as n from (select key, unnest({TOKENS.format('text')}) as token from s) group by all),
 tb as (select key, token, count(*) as n from (select key, unnest({TOKENS.format('text')}) as token from t) group by all),
 j as (select sb.key, sb.token, sb.n as src, coalesce(tb.n, 0) as tgt from sb left join tb using (key, token))"""
COVERAGE = """cov as (select s.key, cast(coalesce(sum(src), 0) as bigint) as n_source, cast(coalesce(sum(least(src, tgt)), 0) as bigint) as n_covered from s left join j using (key) group by 1)"""


@query(f"with {BAGS}, {COVERAGE} select key, n_source, n_covered, n_source - n_covered as n_missing, case when n_source = 0 then 1.0::double else n_covered / n_source::double end as recall from cov")
def multiset_recall(spark: SparkSession, d: str) -> DataFrame:
    return recall.coverage(*_sides(spark, d))


@query(
    f"""with {SIDES}, x as (select id as key, rel as text from (select *, row_number() over (partition by id order by ts desc, rec_id desc) as k from coverage_record where id is not null) where k = 1),
 r as (select key, token, sum(a) as a, sum(b) as b, sum(c) as c from (
   select key, unnest({TOKENS.format('text')}) as token, 1 as a, 0 as b, 0 as c from s union all select key, unnest({TOKENS.format('text')}), 0, 1, 0 from t union all select key, unnest({TOKENS.format('text')}), 0, 0, 1 from x) group by all),
 g as (select key, cast(sum(greatest(a - c, 0)) as bigint) as n, cast(sum(least(greatest(a - c, 0), b)) as bigint) as h from r group by 1)
 select s.key, coalesce(n, 0) as n_source, coalesce(h, 0) as n_covered, coalesce(n - h, 0) as n_missing, case when coalesce(n, 0) = 0 then 1.0::double else h / n::double end as recall from s left join g using (key)"""
)
def recall_with_exclude(spark: SparkSession, d: str) -> DataFrame:
    source, target = _sides(spark, d)
    exclude = latest(spark, d, "rel").select(F.col("id").alias("key"), F.col("rel").alias("text"))
    return recall.coverage(source, target, exclude)


@query(f"with {BAGS} select key, token, n, rank from (select key, token, cast(src - least(src, tgt) as bigint) as n, row_number() over (partition by key order by src - least(src, tgt) desc, token)::integer as rank from j where src > tgt) where rank <= 12")
def missing_top(spark: SparkSession, d: str) -> DataFrame:
    return recall.top_missing(recall.bags(*_sides(spark, d)))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    source, target = _sides(spark, d)
    return source.withColumnRenamed("text", "source").join(target.withColumnRenamed("text", "target"), "key")


def _gram_sql(stream: str) -> str:
    grams = "list_transform(range(1, len({0}) - 1), lambda i: substr({0}, i, 3))"
    return f"""with {SIDES}, p as (select s.key, {stream.format('s.text')} as a, {stream.format('t.text')} as b from s join t using (key)),
 ga as (select key, g, count(*) as n from (select key, unnest({grams.format('a')}) as g from p where len(a) > 2) group by all),
 gb as (select key, g, count(*) as n from (select key, unnest({grams.format('b')}) as g from p where len(b) > 2) group by all),
 r as (select ga.key, sum(ga.n) as n, sum(least(ga.n, coalesce(gb.n, 0))) as h from ga left join gb using (key, g) group by 1)
 select p.key, coalesce(h / n::double, 1.0::double) as content_recall from p left join r using (key)"""


@query(_gram_sql("regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]+', '', 'g')"))
def char_recall(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select("key", recall.char_recall("source", "target").alias("content_recall"))


@query(_gram_sql(r"regexp_replace(lower(coalesce({0}, '')), '[^\p{{L}}\p{{N}}]+', '', 'g')"))
def unicode_recall(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select("key", recall.unicode_recall("source", "target").alias("content_recall"))


@query(f"with {BAGS}, {COVERAGE}, c as ({_gram_sql(chr(114) + 'egexp_replace(lower(coalesce({0}, ' + chr(39) * 2 + ')), ' + chr(39) + '[^a-z0-9]+' + chr(39) + ', ' + chr(39) * 2 + ', ' + chr(39) + 'g' + chr(39) + ')').replace('with ' + SIDES + ', ', 'with ')}) select key, n_source >= 50 and n_covered / greatest(n_source, 1)::double < 0.8 as lossy, n_source >= 50 and n_covered / greatest(n_source, 1)::double < 0.8 and content_recall < 0.95 as lossy_explained from cov join c using (key)")
def lossy_verdict(spark: SparkSession, d: str) -> DataFrame:
    rows = multiset_recall(spark, d).join(char_recall(spark, d), "key")
    n, r = F.col("n_source"), F.col("recall")
    return rows.select("key", recall.is_lossy(n, r).alias("lossy"), recall.is_lossy_explained(n, r, F.col("content_recall")).alias("lossy_explained"))


PAGES = f"""p as (select rec_id as key, string_split(source_text, chr(12)) as pages from coverage_record where source_text is not null),
 q as (select key, len(pages) as n, unnest(pages) as body, generate_subscripts(pages, 1) - 1 as page from p),
 l as (select key, n, page, unnest(string_split(body, chr(10))) as raw, generate_subscripts(string_split(body, chr(10)), 1) - 1 as line from q),
 f as (select *, {sql_squeeze('raw')} as flat from l),
 b as (select key, flat from f where flat <> '' group by key, flat, n having n > 1 and count(distinct page) >= 2 and count(distinct page) >= 0.5 * n)"""


@query(f"with {PAGES} select key, flat from b")
def running_lines(spark: SparkSession, d: str) -> DataFrame:
    return recall.running_lines(table(spark, d, "coverage_record", "rec_id", "source_text").where("source_text is not null"), "rec_id", "source_text")


@query(
    f"""with {PAGES}, k as (select f.key, f.page, string_agg(f.raw, chr(10) order by f.line) as body from f anti join b on f.key = b.key and f.flat = b.flat group by all),
 m as (select q.key, string_agg(coalesce(k.body, ''), chr(12) order by q.page) as text from q left join k on q.key = k.key and q.page = k.page group by 1)
 select key as rec_id, md5(text) as digest from m"""
)
def without_running_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "coverage_record", "rec_id", "source_text").where("source_text is not null")
    return rows.select("rec_id", F.md5(recall.without_running_lines("source_text")).alias("digest"))


_GAP_PAGES = PAGES.replace("select rec_id as key, string_split(source_text, chr(12)) as pages from coverage_record where source_text is not null", "select s.key, string_split(coalesce(s.text, ''), chr(12)) as pages from s join t using (key)")


@query(
    f"""with {SIDES}, {_GAP_PAGES},
 k as (select f.* from f anti join b on f.key = b.key and f.flat = b.flat),
 sw as (select key, token, count(*) as n from (select key, unnest({TOKENS.format('raw')}) as token from k) group by all),
 tw as (select key, unnest(w) as token, generate_subscripts(w, 1) as pos from (select t.key, {TOKENS.format('t.text')} as w from t join s using (key))),
 tn as (select key, token, count(*) as n from tw group by all),
 ms as (select sw.key, sw.token, sw.n as src, least(sw.n, coalesce(tn.n, 0)) as hit from sw left join tn using (key, token)),
 su as (select tw.*, row_number() over (partition by tw.key, tw.token order by pos) > coalesce(sw.n, 0) as extra from tw left join sw using (key, token)),
 st as (select key, string_agg(token, '' order by pos) as stream from su where extra group by 1),
 mk as (select key, page, flat, regexp_replace(flat, '\\d+', '#', 'g') as form from k where flat <> ''),
 mm as (select key, form from mk group by all having count(distinct page) > 1),
 bw as (select key, token, count(*) as n from (select mk.key, unnest({TOKENS.format('flat')}) as token from mk join mm on mk.key = mm.key and mk.form = mm.form) group by all),
 c1 as (select ms.key, token, src, hit, src - hit as m, regexp_full_match(token, '[0-9]+') as digits, case when len(token) > 3 and not regexp_full_match(token, '[0-9]+') then least(src - hit, coalesce((len(stream) - len(replace(stream, token, ''))) // len(token), 0)) else 0 end as fused from ms left join st using (key)),
 c2 as (select c1.*, case when digits then 0 else least(m - fused, coalesce(bw.n, 0)) end as boiler from c1 left join bw using (key, token)),
 c3 as (select *, case when digits then 0 else m - fused - boiler end as rest from c2),
 top as (select key, token, rest, row_number() over (partition by key order by rest desc, token) as place from c3 where rest > 0 and len(token) > 3),
 tj as (select key, string_agg('{{"token":"' || token || '","cnt":' || rest || '}}', ',' order by place) as j from top where place <= 20 group by 1),
 g as (select key, sum(src) as n_source, sum(hit) as covered, sum(fused) as fused, sum(case when digits then m else 0 end) as numeric, sum(boiler) as residual_boiler, sum(case when len(token) < 4 then rest else 0 end) as short, sum(case when len(token) > 3 then rest else 0 end) as absent from c3 group by 1)
 select s.key, coalesce(n_source, 0)::bigint as n_source, coalesce(covered, 0)::bigint as covered, coalesce(fused, 0)::bigint as fused, coalesce(numeric, 0)::bigint as numeric, 0::bigint as image_text, coalesce(residual_boiler, 0)::bigint as residual_boiler, coalesce(short, 0)::bigint as short, coalesce(absent, 0)::bigint as absent, '[' || coalesce(j, '') || ']' as absent_top
 from s join t using (key) left join g using (key) left join tj using (key)"""
)
def gap_buckets(spark: SparkSession, d: str) -> DataFrame:
    rows = _pairs(spark, d).select("key", recall.explain_gap("source", "target").alias("g"))
    return rows.select("key", *[F.col(f"g.{f}").alias(f) for f in recall.GAP_FIELDS], F.to_json("g.absent_top").alias("absent_top"))


def _words(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").selectExpr(
        "l_orderkey as page", "concat('w', l_linenumber) as word", "(l_partkey % 90) / 100.0D as x0", "(l_partkey % 90 + 4) / 100.0D as x1", "(l_suppkey % 90) / 100.0D as y0", "(l_suppkey % 90 + 2) / 100.0D as y1"
    )


@query(
    """with w as (select l_orderkey as page, 'w' || l_linenumber as word, (l_partkey % 90) / 100.0::double as x0, (l_partkey % 90 + 4) / 100.0::double as x1, (l_suppkey % 90) / 100.0::double as y0, (l_suppkey % 90 + 2) / 100.0::double as y1 from lineitem),
 b as (select l_orderkey as page, l_linenumber as box, (l_partkey % 40) / 100.0::double as x0, (l_partkey % 40 + 40) / 100.0::double as x1, (l_suppkey % 40) / 100.0::double as y0, (l_suppkey % 40 + 40) / 100.0::double as y1 from lineitem)
 select w.page, w.word, b.box, count(*) as n from w join b on w.page = b.page and (w.x0 + w.x1) / 2 between b.x0 and b.x1 and (w.y0 + w.y1) / 2 between b.y0 and b.y1 group by all"""
)
def words_in_boxes(spark: SparkSession, d: str) -> DataFrame:
    boxes = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").selectExpr(
        "l_orderkey as page", "l_linenumber as box", "(l_partkey % 40) / 100.0D as x0", "(l_partkey % 40 + 40) / 100.0D as x1", "(l_suppkey % 40) / 100.0D as y0", "(l_suppkey % 40 + 40) / 100.0D as y1"
    )
    return recall.words_in_boxes(_words(spark, d), boxes, ["page"]).groupBy("page", "word", "box").agg(F.count("*").alias("n"))


_EDGE = "[" + "".join("\\" + c for c in ".,:;()[]{}|<>\"'`").replace("'", "''") + "]"


@query(
    f"""with t as (select doc_id, unnest(string_split({sql_squeeze("body_md")}, ' ')) as w from (select doc_id, any_value(body_md) as body_md from document_md group by 1)),
 c as (select doc_id, regexp_replace(w, '^{_EDGE}+|{_EDGE}+$', '', 'g') as w from t)
 select doc_id, w as identifier from c where len(w) >= 6 and regexp_matches(w, '_|[a-z][A-Z]|[A-Z][A-Z][a-z]') group by all"""
)
def identifier_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return bodies(spark, d).select("doc_id", F.explode(recall.identifier_vocabulary("body_md")).alias("identifier"))


@query()
def rejoined_identifiers(spark: SparkSession, d: str) -> DataFrame:
    """Bodies in which an identifier of the source text was parted are healed."""
    rows = _pairs(spark, d).select("key", "target", recall.identifier_vocabulary("source").alias("v"))
    broken = F.regexp_replace("target", r"\b([A-Za-z0-9]+_[A-Za-z0-9]+)_([A-Za-z0-9]+)\b", "$1 _$2")
    healed = recall.rejoin_identifiers(broken, F.col("v"))
    return rows.select("key", (broken != F.col("target")).alias("was_parted"), F.md5(healed).alias("digest"))


# ---- Markdown -------------------------------------------------------------------------------------------------------

_TICKS = "greatest(3, coalesce(list_max(list_transform(regexp_extract_all(coalesce(text, ''), '`+'), lambda x: len(x))) + 1, 3))"


@query(f"select doc_id, md5(repeat('`', cast({_TICKS} as integer)) || 'txt' || chr(10) || coalesce(text, '') || case when coalesce(text, '') = '' or text like '%' || chr(10) then '' else chr(10) end || repeat('`', cast({_TICKS} as integer)) || chr(10)) as digest from documents")
def fenced(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", F.md5(fn.fence("text", "txt")).alias("digest"))


def _yaml(x: str) -> str:
    for a, b in (("chr(92)", "chr(92) || chr(92)"), ("'\"'", "chr(92) || '\"'"), ("chr(13) || chr(10)", "chr(92) || 'n'"), ("chr(10)", "chr(92) || 'n'"), ("chr(13)", "chr(92) || 'n'"), ("chr(9)", "chr(92) || 't'")):
        x = f"replace({x}, {a}, {b})"
    return f"'\"' || {x} || '\"'"


_FM = " || ".join(f"coalesce('{k}: ' || {_yaml(f'cast({c} as varchar)')} || chr(10), '')" for k, c in (("doc_id", "doc_id"), ("lane", "lane"), ("source_relpath", "source_relpath"), ("source_sha256", "source_sha256"), ("error", "error")))


@query(f"select report_id, '---' || chr(10) || {_FM} || '---' || chr(10) as front_matter from report")
def front_matter(spark: SparkSession, d: str) -> DataFrame:
    names = ["doc_id", "lane", "source_relpath", "source_sha256", "error"]
    return table(spark, d, "report", "report_id", *names).select("report_id", fn.front_matter({c: F.col(c) for c in names}).alias("front_matter"))


@query("select doc_id, md5(body_md) as digest, true as kept from (select distinct doc_id, body_md from document_md)")
def front_matter_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Putting a block before a body and taking it off again gives the body."""
    rows = table(spark, d, "document_md", "doc_id", "body_md").distinct()
    whole = F.concat(fn.front_matter({"doc_id": F.col("doc_id"), "lane": F.lit('a "b"\\c')}), F.col("body_md"))
    body = fn.strip_front_matter(whole)
    return rows.select("doc_id", F.md5(body).alias("digest"), (body == F.col("body_md")).alias("kept"))


@query(
    """with r as (select r_regionkey, '| ' || 'nation' || ' | ' || 'key' || ' | ' || '' || ' |' as head from region), n as (select n_regionkey, string_agg('| ' || replace(n_name, '|', chr(92) || '|') || ' | ' || n_nationkey || ' | ' || 'x' || ' |', chr(10) order by n_nationkey) as body from nation group by 1)
 select r_regionkey, head || chr(10) || '| --- | --- | --- |' || chr(10) || body as markdown from r join n on r_regionkey = n_regionkey"""
)
def pipe_tables(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("r"))
    cells = F.transform("r", lambda x: F.array(x["n_name"], x["n_nationkey"].cast("string"), F.lit("x")))
    made = F.concat(F.array(F.array(F.lit("nation"), F.lit(" key\n"))), F.array(F.array(F.lit(" "), F.lit(""))), cells)
    return rows.select(F.col("n_regionkey").alias("r_regionkey"), fn.pipe_table(made).alias("markdown"))


_ALT = "replace(replace(replace(replace({0}, chr(92), ' '), ']', chr(92) || ']'), '|', '/'), '`', '''')".format(sql_squeeze("coalesce(text, '')"))


@query(f"select doc_id, '![' || {_ALT} || '](images/' || doc_id || '.png)' as link from documents")
def image_links(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", fn.image_link("text", F.concat(F.lit("images/"), F.col("doc_id").cast("string"), F.lit(".png"))).alias("link"))


_PARTS = "string_split(coalesce(text, ''), '. ')"
_MARK = "'<!-- image -->'"


# every sentence end of the text is a placeholder; there are renders for the first two
@query(
    f"""with p as (select doc_id, lang, {_PARTS} as w from documents)
 select doc_id, w[1] || case when len(w) > 1 then case when doc_id % 3 = 0 then '' else coalesce(lang, '') end || w[2] else '' end || case when len(w) > 2 then doc_id || w[3] else '' end
  || case when len(w) > 3 then {_MARK} || array_to_string(w[4:], {_MARK}) else '' end as filled from p"""
)
def filled_placeholders(spark: SparkSession, d: str) -> DataFrame:
    md = F.array_join(F.split(F.coalesce("text", F.lit("")), r"\. ", -1), "<!-- image -->")
    renders = F.array(F.when(F.col("doc_id") % 3 != 0, F.col("lang")), F.col("doc_id").cast("string"))
    return table(spark, d, "documents", "doc_id", "lang", "text").select("doc_id", fn.fill_placeholders(md, renders).alias("filled"))


# sentence ends are marks of one name, which is filled with the language; line ends are marks of a name that isn't known
@query("select doc_id, replace(replace(coalesce(text, ''), '. ', coalesce(lang, '')), chr(10), '<!-- figure:' || doc_id || ':2 -->') as filled from documents")
def filled_sentinels(spark: SparkSession, d: str) -> DataFrame:
    mark = lambda k: F.concat(F.lit("<!-- figure:"), F.col("doc_id").cast("string"), F.lit(f":{k} -->"))
    md = F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit(". "), mark(1)), F.lit("\n"), mark(2))
    fills = F.create_map(F.concat(F.col("doc_id").cast("string"), F.lit(":1")), F.col("lang"))
    return table(spark, d, "documents", "doc_id", "lang", "text").select("doc_id", fn.fill_sentinels(md, fills, "figure").alias("filled"))


_ROW = "regexp_replace(regexp_replace({0}, '^\\|', ''), '\\|$', '')"


@query(
    f"""with l as (select doc_id, unnest(string_split(body, chr(10))) as raw, generate_subscripts(string_split(body, chr(10)), 1) as i from (select doc_id, any_value(body_md) as body from document_md group by 1)),
 c as (select *, {sql_strip('raw')} as s from l),
 x as (select doc_id, i, case when regexp_matches(s, '^\\|.*\\|') then '| ' || array_to_string(list_transform(string_split(replace({_ROW.format('s')}, chr(92) || '|', chr(1)), '|'),
   lambda z: case when regexp_full_match(raw, '\\s*\\|?[\\s:|\\-]*-[\\s:|\\-]*\\|?\\s*') then case when {sql_strip('z')} like ':%' then ':' else '' end || '---' || case when {sql_strip('z')} like '%:' then ':' else '' end else {sql_strip('z')} end), ' | ') || ' |' else raw end as t from c)
 select doc_id, md5(string_agg(replace(t, chr(1), chr(92) || '|'), chr(10) order by i)) as digest from x group by 1"""
)
def collapsed_tables(spark: SparkSession, d: str) -> DataFrame:
    return bodies(spark, d).select("doc_id", F.md5(fn.collapse_padding("body_md")).alias("digest"))


@query()
def markdown_texts(spark: SparkSession, d: str) -> DataFrame:
    text = markdown_to_text(F.col("body_md"))
    return bodies(spark, d).select("doc_id", text.alias("t")).select("doc_id", F.length("t").alias("n_chars"), F.md5("t").alias("digest"))


# ---- validation -----------------------------------------------------------------------------------------------------

_F = "regexp_matches(raw, '^\\s{0,3}(```|~~~)')"
_PIPED = "regexp_matches(raw, '(^|[^\\\\])\\|')"


@query(
    f"""with b as (select doc_id as key, any_value(body_md) as body from document_md group by 1),
 l as (select key, unnest(string_split(body, chr(10))) as raw, generate_subscripts(string_split(body, chr(10)), 1) as i from b),
 p as (select *, {_F} as mark, sum(case when {_F} then 1 else 0 end) over (partition by key order by i) as run, lead(raw, 1, '') over (partition by key order by i) as nxt from l),
 m as (select key, sum((len(raw) + 3) // 4) as tokens, count_if(mark) as fences,
   count_if(not mark and run % 2 = 0 and regexp_matches(raw, '^#{{1,6}}\\s+\\S')) as headings,
   count_if(not mark and run % 2 = 0 and {_PIPED} and {_PIPED.replace('raw', 'nxt')} and regexp_full_match({sql_strip('nxt')}, '\\|?(\\s*:?-+:?\\s*\\|)*\\s*:?-+:?\\s*\\|?')) as tables,
   sum(case when not mark and run % 2 = 0 then len(regexp_extract_all(raw, '!\\[[^\\]]*\\]\\([^)\\s]+')) else 0 end) as images,
   sum(case when not mark and run % 2 = 0 then len(regexp_extract_all(raw, '(^|[^!\\\\])\\[[^\\]]*\\]\\([^)\\s]+')) else 0 end) as links,
   count_if(not mark and run % 2 = 0 and regexp_matches(raw, '^\\s*([-*+]|\\d+[.)])\\s+\\S')) as lists from p group by 1)
 select m.key, cast(len(b.body) as bigint) as chars, cast(tokens as bigint) as tokens, cast(headings as bigint) as headings, cast(tables as bigint) as tables, cast(images as bigint) as images, cast(links as bigint) as links, cast(lists as bigint) as lists,
   cast(fences // 2 as bigint) as code_blocks, cast((len(b.body) - len(replace(b.body, '$$', ''))) // 4 as bigint) as formulas from m join b using (key)"""
)
def content_metrics(spark: SparkSession, d: str) -> DataFrame:
    return validation.content_metrics(bodies(spark, d), "doc_id", "body_md")


@query(
    """with l as (select doc_id as key, unnest(string_split(body, chr(10))) as raw, generate_subscripts(string_split(body, chr(10)), 1) - 1 as line from (select doc_id, any_value(body_md) as body from document_md group by 1)),
 p as (select key, line, line - row_number() over (partition by key order by line) as island from l where contains(raw, '|'))
 select key, cast(min(line) as integer) as first, count(*) as n from p group by key, island"""
)
def pipe_blocks(spark: SparkSession, d: str) -> DataFrame:
    return validation.pipe_blocks(bodies(spark, d), "doc_id", "body_md")


@query()
def markdown_issues(spark: SparkSession, d: str) -> DataFrame:
    rows = bodies(spark, d).select("doc_id", F.explode(validation.validate_markdown(F.col("body_md"))).alias("i"))
    return rows.select("doc_id", "i.line", "i.code", "i.severity", "i.message")


_TRUE_LINES = f"""l as (select doc_id, unnest(string_split(body, chr(10))) as raw, generate_subscripts(string_split(body, chr(10)), 1) as line from (select doc_id, any_value(body_md) as body from document_md group by 1)),
 p as (select *, {_F} as mark, sum(case when {_F} then 1 else 0 end) over (partition by doc_id order by line) as run from l)"""


@query(
    f"""with {_TRUE_LINES}, h as (select doc_id, line, len(regexp_extract(raw, '^(#{{1,6}})\\s+\\S', 1)) as level from p where not mark and run % 2 = 0 and regexp_matches(raw, '^#{{1,6}}\\s+\\S')),
 j as (select *, lag(level) over (partition by doc_id order by line) as above from h)
 select doc_id, cast(line as integer) as line, 'heading level jumps from ' || above || ' to ' || level as message from j where level > above + 1"""
)
def heading_jumps(spark: SparkSession, d: str) -> DataFrame:
    return markdown_issues(spark, d).where("code = 'heading-jump'").select("doc_id", "line", "message")


@query(
    f"""with {_TRUE_LINES}, q as (select *, {_PIPED} as piped from p where not mark and run % 2 = 0),
 g as (select *, line - row_number() over (partition by doc_id, run order by line) as island, run as r from q where piped),
 n as (select doc_id, r, island, min(line) as first, count(*) as n from g group by all),
 s as (select n.doc_id, n.first, g.raw as second from n join g on g.doc_id = n.doc_id and g.line = n.first + 1 where n.n > 1)
 select doc_id, cast(first as integer) as line from s where not regexp_full_match({sql_strip("second")}, '\\|?(\\s*:?-+:?\\s*\\|)*\\s*:?-+:?\\s*\\|?')"""
)
def tables_without_separator(spark: SparkSession, d: str) -> DataFrame:
    return markdown_issues(spark, d).where("code = 'table-no-separator'").select("doc_id", "line")


# damage is planted, for the tables have none: colons at line ends become a bell, question marks the replacement character
@query(
    """with l as (select doc_id, unnest(string_split(body, chr(10))) as raw, generate_subscripts(string_split(body, chr(10)), 1) as line from (select doc_id, any_value(body_md) as body from document_md group by 1))
 select doc_id, cast(line as integer) as line, 'bad-chars' as code from l where contains(raw, '?') or raw like '%:' or regexp_matches(raw, '[\\x{00}-\\x{08}\\x{0b}\\x{0c}\\x{0e}-\\x{1f}\\x{FFFD}]')"""
)
def damaged_lines(spark: SparkSession, d: str) -> DataFrame:
    planted = F.translate(F.regexp_replace("body_md", "(?md):$", "\x07"), "?", "\ufffd")
    rows = bodies(spark, d).select("doc_id", F.explode(validation.validate_markdown(planted)).alias("i"))
    return rows.select("doc_id", "i.line", "i.code").where("code = 'bad-chars'")


@query(
    """with v as (select rec_id, recall, structure_errors as e, structure_warnings as w, case when ext in ('docx', 'pptx', 'xlsx') then 'office' else 'pdf' end as lane, coalesce(recall, 0) = 1.0 and structure_errors = 0 as ok from coverage_record),
 g as (select *, case when lane = 'office' then case when ok then 'pass' else 'fail' end else 'best-effort' end as gate from v)
 select rec_id, lane, gate, case when gate = 'fail' or e > 0 then 'failed' when w > 0 then 'degraded' else 'ok' end as status from g"""
)
def report_verdicts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "coverage_record", "rec_id", "recall", "structure_errors", "structure_warnings", "ext")
    lane = F.when(F.col("ext").isin("docx", "pptx", "xlsx"), "office").otherwise("pdf")
    valid = validation.lossless(F.coalesce("recall", F.lit(0.0)), F.col("structure_errors"), F.lit(0), F.lit(1.0))
    rows = rows.select("rec_id", lane.alias("lane"), validation.measured_gate(lane, valid, F.lit(None).cast("string")).alias("gate"), "structure_errors", "structure_warnings")
    return rows.select("rec_id", "lane", "gate", validation.report_status(F.col("gate"), F.col("structure_errors"), F.col("structure_warnings")).alias("status"))


@query(
    """select l_orderkey, l_linenumber, case when m = 0 and o = 0 and e = r and v = u then 'pass' else 'degraded' end as images, case when o = 0 then 'pass' else 'degraded' end as outline,
  case when l_returnflag = 'R' then 'disabled' when r = 0 or m = 0 then 'complete' when e + o + v = 0 then 'pending' else 'incomplete' end as captions,
  case when r <> 0 then round((u + v) / r::double, 4) else 1.0 end as ratio
 from (select l_orderkey, l_linenumber, l_returnflag, l_partkey % 3 as r, l_suppkey % 3 as e, l_partkey % 2 as u, l_suppkey % 2 as v, l_quantity::bigint % 2 as m, l_orderkey % 2 as o from lineitem)"""
)
def gates(spark: SparkSession, d: str) -> DataFrame:
    r, e, u, v, m, o = (F.expr(x) for x in ("l_partkey % 3", "l_suppkey % 3", "l_partkey % 2", "l_suppkey % 2", "cast(l_quantity as bigint) % 2", "l_orderkey % 2"))
    rows = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_partkey", "l_suppkey", "l_quantity")
    return rows.select(
        "l_orderkey", "l_linenumber", validation.image_gate(r, e, u, m, o, v).alias("images"), validation.outline_gate(o).alias("outline"),
        validation.caption_gate(F.col("l_returnflag") != "R", r, e, o, v, m).alias("captions"), validation.outline_ratio(r, u, v).alias("ratio"),
    )


@query(f"with {SIDES} select key, case when len(t.text) <> 0 then round(len(s.text) / len(t.text)::double, 2) when len(s.text) = 0 then 1.0 else 0.0 end as reduction_ratio, case when len(s.text) <> 0 then round(100.0::double * (1 - len(t.text) / len(s.text)::double), 2) else 0.0 end as saved_pct from s join t using (key) where s.text is not null")
def savings(spark: SparkSession, d: str) -> DataFrame:
    rows = _pairs(spark, d).where("source is not null")
    return rows.select("key", fn.savings(F.length("source"), F.length("target")).alias("s")).select("key", "s.*")


# ---- outlines -------------------------------------------------------------------------------------------------------

_S = sql_strip("raw")
HEADING = f"""case when s = '' or len(s) > 120 then 0 when regexp_matches(s, '^#{{1,6}}\\s+\\S') then len(s) - len(replace(s, '#', ''))
  when regexp_matches(s, '(?i)^(chapter|section|appendix|part)\\s+[0-9IVXLA-Z]') then 1
  when num <> '' then 1 + len(num) - len(replace(num, '.', ''))
  when letters > 0 and len(s) <= 70 and words <= 10 and capitals / greatest(letters, 1)::double > 0.85 then 1 else 0 end"""
LINES = "select doc_id, unnest(string_split(body, chr(10))) as raw, generate_subscripts(string_split(body, chr(10)), 1) - 1 as line from (select doc_id, any_value(body_md) as body from document_md group by 1)"


@query(
    f"""with l as ({LINES}), a as (select *, {_S} as s from l),
 b as (select *, regexp_extract(s, '^(\\d+(?:\\.\\d+){{0,3}})\\.?\\s+[A-Za-z]', 1) as num, len(regexp_replace(s, '[^\\p{{L}}]+', '', 'g')) as letters, len(regexp_replace(s, '[^\\p{{Lu}}]+', '', 'g')) as capitals, len(string_split(regexp_replace(s, '{WS}+', ' ', 'g'), ' ')) as words from a)
 select doc_id, cast(line as integer) as line, cast({HEADING} as integer) as level from b where {HEADING} > 0"""
)
def heading_levels(spark: SparkSession, d: str) -> DataFrame:
    lines = validation.lines_of(bodies(spark, d), "doc_id", "body_md")
    return lines.select(F.col("key").alias("doc_id"), "line", fn.heading_level("raw").alias("level")).where("level > 0")


@query(f"with l as ({LINES}) select doc_id, count_if(regexp_matches(raw, '\\.{{4,}}\\s*\\d+\\s*$') or regexp_matches(raw, '^\\s*\\d+\\s*$')) as toc, count_if(regexp_matches({_S}, '^\\|.*\\|')) as table_rows, count_if(contains({_S}, '-') and contains({_S}, '|') and regexp_full_match({_S}, '[|:\\-{fn.SPACE}]+')) as rules from l group by 1")
def line_kinds(spark: SparkSession, d: str) -> DataFrame:
    lines = validation.lines_of(bodies(spark, d), "doc_id", "body_md")
    n = lambda c: F.count_if(c)
    return lines.groupBy(F.col("key").alias("doc_id")).agg(n(fn.is_toc_line("raw")).alias("toc"), n(fn.is_table_row("raw")).alias("table_rows"), n(fn.is_separator_row("raw")).alias("rules"))


HEADS = f"""l as ({LINES}), a as (select *, {_S} as s, (len(raw) + 3) // 4 as tokens from l),
 b as (select *, regexp_extract(s, '^(\\d+(?:\\.\\d+){{0,3}})\\.?\\s+[A-Za-z]', 1) as num, len(regexp_replace(s, '[^\\p{{L}}]+', '', 'g')) as letters, len(regexp_replace(s, '[^\\p{{Lu}}]+', '', 'g')) as capitals, len(string_split(regexp_replace(s, '{WS}+', ' ', 'g'), ' ')) as words,
   coalesce(sum(tokens) over (partition by doc_id order by line rows between unbounded preceding and 1 preceding), 0) as before from a),
 e as (select doc_id, max(line) + 1 as n, sum(tokens) as total from a group by 1),
 h0 as (select doc_id, line, before, {HEADING} as level from b where not regexp_matches(raw, '\\.{{4,}}\\s*\\d+\\s*$') and not regexp_matches(raw, '^\\s*\\d+\\s*$') and not regexp_matches(s, '^\\|.*\\|') and not (contains(s, '-') and contains(s, '|') and regexp_full_match(s, '[|:\\-{fn.SPACE}]+')) and not regexp_matches(raw, '^\\s*(?:[-*+]|\\d+[.)])\\s+\\S')),
 h as (select * from h0 where level > 0),
 own as (select *, lead(line) over (partition by doc_id order by line) as next_line, lead(before) over (partition by doc_id order by line) as next_before from h),
 sub as (select h.doc_id, h.line, min(k.line) as stop, min(k.before) as stop_before from h join h k on k.doc_id = h.doc_id and k.line > h.line and k.level <= h.level group by all),
 spans as (select own.doc_id, own.level, own.line as line_start, coalesce(sub.stop, e.n) as line_end, coalesce(next_before, e.total) - own.before as self_tokens, coalesce(stop_before, e.total) - own.before as subtree_tokens from own join e using (doc_id) left join sub on sub.doc_id = own.doc_id and sub.line = own.line),
 first as (select e.doc_id, coalesce(min(h.line), any_value(e.n)) as line, coalesce(min(h.before), any_value(e.total)) as before from e left join h using (doc_id) group by 1),
 preamble as (select doc_id, 1 as level, 0 as line_start, first.line as line_end, first.before as self_tokens, first.before as subtree_tokens from first where exists (select 1 from a where a.doc_id = first.doc_id and a.line < first.line and a.s <> '')),
 nodes as (select * from spans union all select * from preamble)"""


_FENCED = f"regexp_matches(raw, '^[{fn.SPACE}]{{0,3}}(```|~~~)')"
_TITLED = sql_strip("regexp_replace(s, '^#+', '')")
_NORMAL = "lower(" + sql_squeeze(f"regexp_replace(regexp_replace({sql_strip("regexp_replace(title, '^#+', '')")}, '{WS}+#+{WS}*$', ''), '^{WS}*\\d+(?:\\.\\d+){{0,3}}\\.?{WS}+', '')") + ")"


@query(
    f"""with {HEADS}, t0 as (select n.*, h.line is null as pre, a.s from nodes n left join h on h.doc_id = n.doc_id and h.line = n.line_start join a on a.doc_id = n.doc_id and a.line = n.line_start),
 t1 as (select *, case when pre then '(preamble)' else coalesce(nullif(substr({_TITLED}, 1, 120), ''), 'section') end as title, row_number() over (partition by doc_id order by line_start) - 1 as idx, lead(line_start) over (partition by doc_id order by line_start) as own from t0),
 t2 as (select *, coalesce(nullif({_NORMAL}, ''), 'section') as base from t1),
 t3 as (select *, row_number() over (partition by doc_id, base, pre order by line_start) as k from t2),
 up as (select c.doc_id, c.idx, max(p.idx) as parent from t3 c join t3 p on p.doc_id = c.doc_id and p.idx < c.idx and p.level < c.level and not p.pre and not c.pre group by all),
 g as (select *, sum(case when {_FENCED} then 1 else 0 end) over (partition by doc_id order by line) as marks, lead(s) over (partition by doc_id order by line) as below from a),
 c as (select doc_id, line, regexp_matches(s, '^\\|.*\\|') and contains(below, '-') and contains(below, '|') and regexp_full_match(below, '[|:\\-{fn.SPACE}]+') as hit,
   len(regexp_extract_all(raw, '!\\[[^\\]]*\\]\\([^)\\s]+')) as images, case when marks % 2 = 0 and not {_FENCED} then len(regexp_extract_all(raw, '(?:^|[^!\\\\])\\[[^\\]]*\\]\\([^)\\s]+')) else 0 end as links from g)
 select t.doc_id, 'sec-' || lpad(cast(t.idx + 1 as varchar), 4, '0') as id, cast(coalesce(any_value(up.parent), -1) as integer) as parent, t.level::integer as level, t.title, case when t.pre then 'preamble' when t.k = 1 then t.base else t.base || '#' || t.k end as anchor,
   t.line_start::integer as line_start, t.line_end::integer as line_end, t.self_tokens::bigint as self_tokens, t.subtree_tokens::bigint as subtree_tokens,
   cast(count(*) filter (where c.hit and c.line < coalesce(t.own, e.n) - 1) as integer) as tables, cast(coalesce(sum(c.images), 0) as integer) as n_images, cast(coalesce(sum(c.links), 0) as integer) as n_links
 from t3 t join e on e.doc_id = t.doc_id left join up on up.doc_id = t.doc_id and up.idx = t.idx left join c on c.doc_id = t.doc_id and c.line >= t.line_start and c.line < coalesce(t.own, e.n)
 group by t.doc_id, t.idx, t.level, t.title, t.pre, t.k, t.base, t.line_start, t.line_end, t.self_tokens, t.subtree_tokens"""
)
def outline_nodes(spark: SparkSession, d: str) -> DataFrame:
    nodes = outline.outline_nodes(bodies(spark, d), "doc_id", "body_md")
    return nodes.select(F.col("key").alias("doc_id"), "id", "parent", "level", "title", "anchor", "line_start", "line_end", "self_tokens", "subtree_tokens", "tables", F.size("images").alias("n_images"), F.size("links").alias("n_links"))


@query(f"with {HEADS} select doc_id, level::integer as level, line_start::integer as line_start, line_end::integer as line_end, self_tokens::bigint as self_tokens, subtree_tokens::bigint as subtree_tokens from nodes")
def outline_spans(spark: SparkSession, d: str) -> DataFrame:
    return outline_nodes(spark, d).select("doc_id", "level", "line_start", "line_end", "self_tokens", "subtree_tokens")


@query(f"with l as ({LINES}) select doc_id, cast(line as integer) as line, parse_path(m[3], '/')[-1] as file from (select doc_id, line, unnest(list_transform(regexp_extract_all(raw, '!\\[[^\\]]*\\]\\([^)\\s]+'), lambda x: ['', '', regexp_extract(x, '\\(([^)\\s]+)', 1)])) as m from l)")
def image_references(spark: SparkSession, d: str) -> DataFrame:
    nodes = outline.outline_nodes(bodies(spark, d), "doc_id", "body_md")
    return nodes.select(F.col("key").alias("doc_id"), F.explode("images").alias("i")).select("doc_id", F.col("i.line").alias("line"), F.element_at(F.split("i.ref", "/"), -1).alias("file"))


_LINKS = "regexp_extract_all(raw, '(?:^|[^!\\\\])\\[[^\\]]*\\]\\([^)\\s]+')"


@query(
    f"""with l as ({LINES}), p as (select *, {_F} as mark, sum(case when {_F} then 1 else 0 end) over (partition by doc_id order by line) as run from l),
 m as (select doc_id, line, unnest({_LINKS}) as x from p where not mark and run % 2 = 0)
 select doc_id, cast(line as integer) as line, regexp_extract(x, '\\[([^\\]]*)\\]\\(([^)\\s]+)$', 1) as text, regexp_extract(x, '\\[([^\\]]*)\\]\\(([^)\\s]+)$', 2) as url from m"""
)
def link_edges(spark: SparkSession, d: str) -> DataFrame:
    nodes = outline.outline_nodes(bodies(spark, d), "doc_id", "body_md")
    return nodes.select(F.col("key").alias("doc_id"), F.explode("links").alias("l")).select("doc_id", "l.line", "l.text", "l.url")


@query(
    f"""with {HEADS}, c as (select a.doc_id, a.line, a.s, exists (select 1 from nodes n where n.doc_id = a.doc_id and n.line_start <= a.line and a.line < n.line_end) as covered from a where a.s <> ''),
 k as (select *, not covered and (regexp_matches(s, '\\.{{4,}}\\s*\\d+$') or regexp_matches(s, '^\\d+$') or regexp_matches(s, '(?i)^(table of contents|contents)$')) as toc from c)
 select e.doc_id as key, count(k.line) as content_lines, count_if(coalesce(covered, false)) as covered_lines, count_if(coalesce(toc, false)) as toc_lines, count_if(coalesce(not covered and not toc, false)) as uncovered_lines,
   cast(list_slice(coalesce(list_sort(list(k.line) filter (where not covered and not toc)), []), 1, 5) as integer[]) as first_uncovered from e left join k on k.doc_id = e.doc_id group by 1"""
)
def outline_coverage(spark: SparkSession, d: str) -> DataFrame:
    return outline.outline_coverage(bodies(spark, d), "doc_id", "body_md")


@query()
def chunk_sections(spark: SparkSession, d: str) -> DataFrame:
    return outline.chunk_sections(bodies(spark, d), "doc_id", "body_md").withColumnRenamed("key", "doc_id")


# ---- figures --------------------------------------------------------------------------------------------------------

_CLASSES = "array('logo', 'icon', 'chart', 'photo', 'stamp', 'diagram', 'table')"


def pictures(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_quantity").selectExpr(
        "l_orderkey % 4000 as doc_id", "((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey as pos", f"element_at({_CLASSES}, cast(l_partkey % 7 as int) + 1) as cls", "if(l_suppkey % 9 = 0, null, l_discount) as area",
        "if(l_partkey % 11 = 0, null, sha1(cast(l_partkey % 60 as string))) as sha", "if(l_suppkey % 5 = 0, 'chrome', 'body') as ref", "l_quantity > 5 as stored", "l_quantity > 15 as good",
    )


PICTURES = """pic as (select l_orderkey % 4000 as doc_id, ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey as pos, ['logo', 'icon', 'chart', 'photo', 'stamp', 'diagram', 'table'][(l_partkey % 7 + 1)::int] as cls, case when l_suppkey % 9 = 0 then null else l_discount end as area,
 case when l_partkey % 11 = 0 then null else sha1(cast(l_partkey % 60 as varchar)) end as sha, case when l_suppkey % 5 = 0 then 'chrome' else 'body' end as ref, l_quantity > 5 as stored, l_quantity > 15 as good from lineitem),
 g1 as (select *, case when area < 0.02 then 'tiny' when cls in ('logo', 'icon', 'stamp') and not coalesce(area >= 0.05, false) then 'deny:' || cls when ref = 'chrome' then 'chrome' end as r from pic),
 g2 as (select *, row_number() over (partition by doc_id, sha, r is null order by pos) as k from g1),
 g as (select *, case when r is null and sha is not null and k > 1 then 'dup' else coalesce(r, 'keep') end as reason from g2),
 o as (select *, case when reason = 'tiny' then 'gated_tiny' when reason like 'deny%' then 'gated_deny' when reason = 'chrome' then 'gated_chrome' when reason = 'dup' then 'gated_dup' when not stored then 'lost_bad_crop' when good then 'captured' else 'no_caption' end as outcome from g)"""


@query(f"with {PICTURES} select doc_id, pos, reason, reason = 'keep' as keep from g")
def figure_gate(spark: SparkSession, d: str) -> DataFrame:
    return figures.gate(pictures(spark, d)).select("doc_id", "pos", "reason", "keep")


def _outcomes(spark: SparkSession, d: str) -> DataFrame:
    g = figures.gate(pictures(spark, d))
    return g.withColumn("outcome", figures.outcome(F.col("keep"), F.col("reason"), F.col("stored"), F.col("good")))


@query(f"with {PICTURES} select outcome, count(*) as n from o group by 1")
def figure_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return _outcomes(spark, d).groupBy("outcome").agg(F.count("*").alias("n"))


@query(
    f"""with {PICTURES}, dd as (select doc_id, count(*) - (doc_id % 2) as n_placeholders, doc_id % 5 = 0 as bailed from pic group by doc_id),
 c as (select dd.*, count(outcome) as n_body, count_if(outcome in ('captured', 'no_caption') and not bailed) as n_captured, count_if(outcome like 'gated%') as n_gated, count_if(outcome like 'lost%' or (outcome in ('captured', 'no_caption') and bailed)) as n_lost from dd left join o using (doc_id) group by all)
 select *, n_lost = 0 and n_body = n_placeholders as lossless from c"""
)
def figure_coverage(spark: SparkSession, d: str) -> DataFrame:
    docs = pictures(spark, d).groupBy("doc_id").agg(F.count("*").alias("n")).select("doc_id", (F.col("n") - F.col("doc_id") % 2).alias("n_placeholders"), (F.col("doc_id") % 5 == 0).alias("bailed"))
    return figures.coverage(_outcomes(spark, d), docs)


@query(f"with {PICTURES}, a as (select sha, doc_id, count(*) as n from pic group by all) select sha, count(*) as n_docs, max(n) as most from a group by 1")
def corpus_image_index(spark: SparkSession, d: str) -> DataFrame:
    return figures.corpus_index(pictures(spark, d))


@query(
    f"""with {PICTURES}, src as (select distinct doc_id, sha, ref as placement from pic where sha is not null),
 rec as (select doc_id, sha, pos, reason = 'keep' as kept, case when good then 'OK' when stored then 'USELESS' else 'RENDER_FAILED' end as kind, case when pos % 17 = 0 then 'pending' else reason end as reason, stored as asset_ok from g where sha is not null and pos % 13 <> 0),
 best as (select * from (select *, row_number() over (partition by doc_id, sha order by (case when kept then 2 else 0 end + case when kind = 'OK' then 1 else 0 end) desc, pos) as n from rec) where n = 1),
 j as (select src.doc_id, src.placement, best.sha is null as none, best.* exclude (doc_id, sha) from src left join best using (doc_id, sha)),
 k as (select *, not none and reason = 'pending' as pend, not none and reason <> 'pending' and kind in ('RENDER_FAILED', 'MEDIA_MISSING') as loss from j),
 a as (select doc_id, count(*) as n_source, count_if(not none and not pend and not loss and kept and kind = 'OK') as n_captured, count_if(not none and not pend and not loss and kept and kind <> 'OK') as n_kept, count_if(not none and not pend and not loss and not kept) as n_dropped,
  count_if(pend) as n_pending, count_if(none) as n_unaccounted, count_if(not none and not pend and not loss and kept and not asset_ok) as n_orphan, count_if(not none and not pend and not loss and not kept and reason = 'chrome' and placement <> 'chrome') as n_misgate, count_if(loss) as n_loss from k group by 1)
 select *, n_unaccounted + n_orphan + n_misgate + n_pending + n_loss = 0 as lossless from a"""
)
def figure_audit(spark: SparkSession, d: str) -> DataFrame:
    g = figures.gate(pictures(spark, d)).where("sha is not null")
    source = g.select("doc_id", "sha", F.col("ref").alias("placement"))
    kind = F.when(F.col("good"), "OK").when(F.col("stored"), "USELESS").otherwise("RENDER_FAILED")
    reason = F.when(F.col("pos") % 17 == 0, "pending").otherwise(F.col("reason"))
    records = g.where("pos % 13 != 0").select("doc_id", "sha", F.col("pos").alias("seq"), F.col("keep").alias("kept"), kind.alias("outcome_kind"), reason.alias("reason"), F.col("stored").alias("asset_ok"))
    return figures.audit(source, records)


_INFO, _FURN = "|".join(fn.INFORMATIVE), "|".join(fn.FURNITURE)
_C = sql_squeeze("coalesce(text, '')")


@query(
    f"""with a as (select doc_id, {_C} as c, lower({sql_strip("coalesce(text, '')")}) as low from documents), b as (select *, string_split(lower(c), ' ') as w, len(regexp_replace(c, '[^\\p{{L}}]+', '', 'g')) as letters from a)
 select doc_id, len(c) >= 25 and letters >= 0.5 * len(c) and not (len(w) >= 8 and len(list_distinct(w)) <= 0.3 * len(w)) as useful, not regexp_matches(low, '\\b(?:{_INFO})') and regexp_matches(regexp_extract(low, '(?s)^[^.]*\\.?'), '\\b(?:{_FURN})') as furniture from b"""
)
def captions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", fn.caption_is_useful("text").alias("useful"), fn.caption_is_furniture("text").alias("furniture"))


_PICTURE = r"!\[[^\]]*\]\(images/([^)\s]+)\)"


@query(
    f"""with b as (select doc_id, any_value(body_md) as body from document_md group by 1),
 r as (select doc_id, part, count(*) as n from (select doc_id, unnest(regexp_extract_all(body, '{_PICTURE}', 1)) as part from b) group by all),
 f as (select *, case when len(regexp_replace(part, '[^0-7]', '', 'g')) % 5 <> 0 then substr(sha256(part), 1, 16) || '.' || lower(regexp_extract(part, '\\.([A-Za-z0-9]+)$', 1)) end as file from r)
 select doc_id, sum(n)::bigint as n_referenced, coalesce(sum(n) filter (where file is not null), 0)::bigint as n_resolved, count(distinct file) as n_files, (sum(n) - coalesce(sum(n) filter (where file is not null), 0))::bigint as n_missing from f group by 1"""
)
def asset_plan(spark: SparkSession, d: str) -> DataFrame:
    """The pictures of the bodies as marks, with bytes for most of them."""
    docs = bodies(spark, d).select("doc_id", F.regexp_replace("body_md", _PICTURE, "<!-- ooxml-image:$1 -->").alias("markdown"))
    media = assets.references(docs).where("length(regexp_replace(part, '[^0-7]', '')) % 5 != 0").select("doc_id", "part", F.encode("part", "UTF-8").alias("bytes"))
    return assets.plan_summary(assets.plan(docs, media))


@query(
    f"""with p as (select id as doc_id, string_split(source_text, chr(12)) as pages from (select *, row_number() over (partition by id order by ts desc, rec_id desc) as k from coverage_record where id is not null) where k = 1 and source_text is not null),
 q as (select doc_id, len(pages) - 1 as last, unnest(pages) as text, generate_subscripts(pages, 1) - 1 as page from p),
 w as (select doc_id, 'head' as e, page, text from q where page < 10 union all select doc_id, 'tail', page, text from q where last >= 10 and page > last - 10),
 g as (select doc_id, e, len({sql_strip("string_agg(text, '' order by page)")}) / greatest(count(*), 1)::double >= 100 as ok from w group by all)
 select doc_id, bool_and(ok) as has_text from g group by 1"""
)
def text_layer_probe(spark: SparkSession, d: str) -> DataFrame:
    pages = latest(spark, d, "source_text").where("source_text is not null").select(F.col("id").alias("doc_id"), F.posexplode(F.split("source_text", "\f", -1)).alias("page_no", "text"))
    return layout.text_layer_probe(pages)


@query(
    """select rec_id, case when upper(docling_status) = 'PASSTHROUGH' then structure_errors = 0 else structure_errors = 0 and upper(coalesce(docling_status, '')) not in ('FAILURE', 'PARTIAL_SUCCESS') and not (n_source >= 50 and recall < 0.8) end as valid,
  ext = 'pdf' and not (coalesce(n_source, 0) > 500) as ocr from coverage_record"""
)
def layout_validity(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "coverage_record", "rec_id", "ext", "docling_status", "structure_errors", "n_source", "recall")
    lossy = recall.is_lossy(F.col("n_source"), F.col("recall"))
    valid = layout.is_valid(F.col("docling_status"), F.col("structure_errors") == 0, lossy, F.lit(None).cast("boolean"))
    return rows.select("rec_id", valid.alias("valid"), layout.needs_ocr("auto", F.col("ext"), F.col("n_source") > 500).alias("ocr"))


@query()
def layout_losslessness(spark: SparkSession, d: str) -> DataFrame:
    """The page documents measured against their text layer."""
    source = latest(spark, d, "source_text", "ext").where("ext = 'pdf' and source_text is not null").select(F.col("id").alias("doc_id"), F.col("source_text").alias("layer"))
    rows = source.join(bodies(spark, d).withColumnRenamed("body_md", "markdown"), "doc_id").select("*", F.lit("").alias("furniture"), F.lit("").alias("image_text"))
    return layout.losslessness(rows)


# ---- dataflow -------------------------------------------------------------------------------------------------------


@query("select doc_id, manifest_id, lane, status, markdown_sha256, appended_at from (select *, row_number() over (partition by doc_id order by appended_at desc, manifest_id desc) as k from manifest where doc_id is not null) where k = 1")
def manifest_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return dataflow.last_wins(table(spark, d, "manifest", "doc_id", "manifest_id", "lane", "status", "markdown_sha256", "appended_at"), "doc_id", ["appended_at", "manifest_id"])


@query("select id, rec_id, ext, valid, recall from (select *, row_number() over (partition by id order by ts desc, rec_id desc) as k from coverage_record where id is not null) where k = 1")
def coverage_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return latest(spark, d, "ext", "valid", "recall").select("id", "rec_id", "ext", "valid", "recall")


@query("select distinct doc_id, lane from plan where doc_id not in (select doc_id from report where lower(trim(status)) in ('ok', 'degraded') and doc_id is not null) and doc_id not in (select doc_id from manifest where status = 'failed' and doc_id is not null)")
def todo(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "report", "doc_id", "status").where(F.lower(F.trim("status")).isin("ok", "degraded"))
    gone = table(spark, d, "manifest", "doc_id", "status").where("status = 'failed'")
    return dataflow.todo(table(spark, d, "plan", "doc_id", "lane").where("doc_id is not null").distinct(), done, "doc_id", gone)


@query("select plan_id, cast(row_number() over (order by coalesce(len(source_relpath), 0) desc, plan_id) - 1 as bigint) as n, cast((row_number() over (order by coalesce(len(source_relpath), 0) desc, plan_id) - 1) % 4 as bigint) as stripe from plan")
def stripes(spark: SparkSession, d: str) -> DataFrame:
    """Biggest first, dealt out to four stripes."""
    rows = table(spark, d, "plan", "plan_id", "source_relpath").select("plan_id", F.coalesce(F.length("source_relpath"), F.lit(0)).alias("size"))
    return dataflow.ranked(rows, [F.desc("size"), F.col("plan_id")]).select("plan_id", "n", (F.col("n") % 4).alias("stripe"))


@query(
    """select ext, count(*) as n, count_if(valid) as valid, min(recall) as min_recall, cast(sum(structure_warnings) as bigint) as warnings
 from (select *, row_number() over (partition by id order by ts desc, rec_id desc) as k from coverage_record where id is not null) where k = 1 group by rollup (ext)"""
)
def lane_summary(spark: SparkSession, d: str) -> DataFrame:
    return dataflow.lane_summary(latest(spark, d, "ext", "valid", "recall", "structure_warnings"))


@query(
    """with a as (select doc_id, count(*) as n from plan where doc_id is not null group by 1), b as (select doc_id, count(*) as n from manifest where doc_id is not null group by 1)
 select a.doc_id, cast(a.n - coalesce(b.n, 0) as bigint) as n from a left join b using (doc_id) where a.n > coalesce(b.n, 0)"""
)
def bag_difference(spark: SparkSession, d: str) -> DataFrame:
    return dataflow.bag_difference(table(spark, d, "plan", "doc_id").where("doc_id is not null"), table(spark, d, "manifest", "doc_id").where("doc_id is not null"), ["doc_id"])


@query(f"with {SIDES} select s.key, case when len({sql_strip('coalesce(t.text, ' + chr(39) * 2 + ')')}) >= 20 then 'markdown' else 'native' end as origin, len(case when len({sql_strip('coalesce(t.text, ' + chr(39) * 2 + ')')}) >= 20 then t.text else coalesce(s.text, '') end) as n_chars from s left join t using (key)")
def source_selection(spark: SparkSession, d: str) -> DataFrame:
    source, target = _sides(spark, d)
    return dataflow.select_source(source, target, "key", "docling").select("key", "origin", F.length("text").cast("bigint").alias("n_chars"))


@query("select lane, lower(trim(status)) as status, count(*) as n, count(distinct doc_id) as n_docs, avg(token_recall) as recall from report group by 1, 2")
def status_rollup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "report").groupBy("lane", F.lower(F.trim("status")).alias("status")).agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_docs"), F.avg("token_recall").alias("recall"))


@query("select w.code, count(*) as n, count(distinct doc_id) as n_docs from (select doc_id, unnest(warnings) as w from report) group by 1")
def warning_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "report", "doc_id", "warnings").select("doc_id", F.explode("warnings").alias("w"))
    return rows.groupBy(F.col("w.code").alias("code")).agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_docs"))


@query(
    """with a as (select m.doc_id, m.markdown_sha256 as recorded, sha256(b.body) as actual from (select doc_id, markdown_sha256, row_number() over (partition by doc_id order by appended_at desc, manifest_id desc) as k from manifest where doc_id is not null) m join (select doc_id, any_value(body_md) as body from document_md group by 1) b using (doc_id) where k = 1)
 select doc_id, coalesce(regexp_replace(lower(trim(recorded)), '^sha256:', '') = actual, false) as intact from a"""
)
def fingerprint_check(spark: SparkSession, d: str) -> DataFrame:
    """Whether the last recorded hash of a document is that of its body."""
    from foliate.operators.ledger import hash_key

    rows = manifest_last_wins(spark, d).select("doc_id", "markdown_sha256").join(bodies(spark, d), "doc_id")
    return rows.select("doc_id", F.coalesce(hash_key(F.col("markdown_sha256")) == F.sha2("body_md", 256), F.lit(False)).alias("intact"))


# ---- recovery -------------------------------------------------------------------------------------------------------

_LOGS = ["", "std::bad_alloc", "file is not a PDF", "process killed", "is encrypted", "all fine"]
_STATUS = ["SUCCESS", "FAILURE", "PARTIAL_SUCCESS", ""]


def failures(spark: SparkSession, d: str) -> DataFrame:
    logs, status = (f"array({', '.join(repr(x) for x in v)})" for v in (_LOGS, _STATUS))
    rows = table(spark, d, "events", "event_id").selectExpr(
        "event_id", "element_at(array(0, 0, 1, 137, -9, 2), cast(event_id % 6 as int) + 1) as rc", "event_id % 29 = 0 as watchdog", f"element_at({logs}, cast((event_id div 7) % 6 as int) + 1) as log", "event_id % 3 = 0 as had", f"element_at({status}, cast((event_id div 11) % 4 as int) + 1) as status", "cast(event_id % 3 as int) as attempts",
    )
    return rows.withColumn("kind", recovery.failure_class(F.col("rc"), F.col("watchdog"), F.col("log"), F.col("had"), F.col("status")))


FAILURES = f"""f as (select event_id, [0, 0, 1, 137, -9, 2][(event_id % 6 + 1)::int] as rc, event_id % 29 = 0 as watchdog, {_LOGS!r}[((event_id // 7) % 6 + 1)::int] as log, event_id % 3 = 0 as had, {_STATUS!r}[((event_id // 11) % 4 + 1)::int] as status, (event_id % 3)::int as attempts from events),
 k as (select *, case when watchdog then 'hang' when rc in (137, -9) or regexp_matches(log, '{recovery.MEMORY}') then 'oom' when regexp_matches(log, '{recovery.INPUT}') then 'input' when upper(status) in ('FAILURE', 'PARTIAL_SUCCESS') then 'docling' when rc = 0 then case when had then 'none' else 'docling' end else 'transient' end as kind from f)"""


@query(f"with {FAILURES} select event_id, kind from k")
def failure_classes(spark: SparkSession, d: str) -> DataFrame:
    return failures(spark, d).select("event_id", "kind")


@query(
    f"""with {FAILURES}, a as (select *, case when kind in ('oom', 'hang') then case when attempts < 1 then 'escalate' else 'fallback' end when kind = 'docling' then 'fallback' when kind = 'input' then 'blacklist' when kind = 'transient' then case when attempts < 2 then 'retry' else 'fallback' end else 'retry' end as action from k)
 select event_id, action, cast(case action when 'escalate' then 16 when 'blacklist' then 0 else 4 end as integer) as threads, cast(case action when 'escalate' then 24 when 'blacklist' then 0 else 8 end as double) as mem_gb from a"""
)
def recovery_actions(spark: SparkSession, d: str) -> DataFrame:
    return failures(spark, d).select("event_id", recovery.recovery_action(F.col("kind"), F.col("attempts"), cores=16).alias("a")).select("event_id", "a.*")


@query(
    """select event_id, case when load > 32 * 1.1 and w > 1 then 'shrink' when load < 32 * 0.5 and (w + 1) * 4 <= 32 and free >= 8 then 'grow' else 'hold' end as action, case when free < 30 then 'ok' when load >= 20 then 'spare' else 'kill' end as verdict
 from (select event_id, (event_id % 50)::double as load, (event_id % 97)::double as free, (event_id % 10)::int as w from events)"""
)
def admissions(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events", "event_id").selectExpr("event_id", "cast(event_id % 50 as double) as load", "cast(event_id % 97 as double) as free", "cast(event_id % 10 as int) as w")
    return rows.select("event_id", recovery.admission(F.col("load"), F.col("free"), F.col("w"), F.lit(32)).alias("action"), recovery.watchdog(F.col("free"), F.col("load"), 30, 20).alias("verdict"))


# ---- recovery rounds ------------------------------------------------------------------------------------------------

_LAYERS = "select id as doc_id, ext, source_text from (select *, row_number() over (partition by id order by ts desc, rec_id desc) as k from coverage_record where id is not null) where k = 1"


def _trial(left: DataFrame) -> DataFrame:
    """A converter that fails as the last digit of a document's id and the number of attempts say."""
    digit, n = F.substring("doc_id", 16, 1), F.col("attempts")
    oom = ((digit == "0") & (n == 0)) | (digit == "1")
    hang = (digit == "6") & (n == 0)
    transient = ((digit == "3") & (n < 2)) | (digit == "4") | ((digit == "6") & (n == 1)) | ((digit == "7") & (n == 0))
    bad = (digit == "2") | oom | hang | transient
    log = F.when(oom, "loading\nMemoryError").when(digit == "2", "page 1\nnot a PDF").when(digit == "7", "[hb 3] password-protected-notes.pdf\nconnection reset")
    return left.select(
        "doc_id", F.when(~bad & (digit != "5"), F.concat(F.lit("# "), "doc_id")).alias("body"), F.when(bad, 1).otherwise(0).alias("returncode"), hang.alias("watchdog"), log.alias("log"),
        F.when(digit == "5", "FAILURE").otherwise("SUCCESS").alias("status"),
    )


@query(
    f"""with l as ({_LAYERS}), d as (select *, substr(doc_id, 16, 1) as x, ext in ('pdf', 'html', 'htm', 'md') and length({sql_strip("coalesce(source_text, '')")}) > 0 as layer from l),
 e as (select doc_id, case when x in ('1', '4', '5') then 'fallback' when x = '2' then 'blacklist' else 'converted' end as plan, case x when '0' then 1 when '1' then 1 when '3' then 2 when '4' then 2 when '6' then 2 when '7' then 1 else 0 end as attempts, layer from d)
 select doc_id, case when plan = 'fallback' and not layer then 'blacklist' else plan end as outcome, cast(attempts as integer) as attempts, plan = 'converted' or (plan = 'fallback' and layer) as has_body from e"""
)
def recovery_rounds(spark: SparkSession, d: str) -> DataFrame:
    """Retries, escalations, fallbacks and what is given up, over all documents with a record."""
    docs = latest(spark, d, "ext", "source_text").select(F.col("id").alias("doc_id"), "ext", "source_text")
    made = recovery.recover(docs, _trial, lambda rows: rows.select("doc_id", recovery.fallback_body("ext", "source_text").alias("body")))
    return made.select("doc_id", "outcome", F.col("attempts").cast("int").alias("attempts"), (F.coalesce(F.length("body"), F.lit(0)) > 0).alias("has_body"))


@query(
    """with a as (select doc_id, markdown_sha256 as x from (select *, row_number() over (partition by doc_id order by appended_at desc, manifest_id desc) as k from manifest where doc_id is not null) where k = 1),
 b as (select doc_id, sha256(any_value(body_md)) as y from document_md where doc_id is not null group by 1)
 select coalesce(a.doc_id, b.doc_id) as doc_id, case when b.doc_id is null then 'first-only' when x is null then 'second-only' when x = y then 'same' else 'changed' end as verdict from a full join b on a.doc_id = b.doc_id"""
)
def same_content(spark: SparkSession, d: str) -> DataFrame:
    """The manifest's last hashes against those of the bodies."""
    rows = bodies(spark, d).where("doc_id is not null").select("doc_id", F.sha2("body_md", 256).alias("markdown_sha256"))
    return dataflow.same_content(manifest_last_wins(spark, d), rows, "doc_id", "markdown_sha256")


@query(
    """with p as (select distinct doc_id, lane from plan where doc_id is not null), o as (select distinct doc_id from report where lower(trim(status)) in ('ok', 'degraded')), g as (select distinct doc_id from manifest where status = 'failed')
 select lane, count(*) as planned, count_if(o.doc_id is not null) as done, count_if(o.doc_id is null and g.doc_id is not null) as given_up, count_if(o.doc_id is null and g.doc_id is null) as left from p left join o using (doc_id) left join g using (doc_id) group by 1""".replace(" as left", ' as "left"').replace("count_if(", "count(*) filter (where ")
)
def progress(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "report", "doc_id", "status").where(F.lower(F.trim("status")).isin("ok", "degraded"))
    gone = table(spark, d, "manifest", "doc_id", "status").where("status = 'failed'")
    return dataflow.progress(table(spark, d, "plan", "doc_id", "lane").where("doc_id is not null"), done, gone, "doc_id", "lane")


@query(
    """with v as (select value as log from (values ('a' || chr(10) || '[hb 2] damaged.pdf' || chr(10) || 'end'), ('  CONVERT encrypted.pdf' || chr(13) || chr(10) || 'ok'), (''), (null)) t(value)), r as (select r_regionkey from region)
 select r_regionkey, case r_regionkey % 4 when 0 then 'a' || chr(10) || 'end' when 1 then 'ok' else '' end as tail from r"""
)
def log_tails(spark: SparkSession, d: str) -> DataFrame:
    log = F.element_at(F.array(F.lit("a\n[hb 2] damaged.pdf\nend"), F.lit("  CONVERT encrypted.pdf\r\nok"), F.lit(""), F.lit(None)), (F.col("r_regionkey") % 4 + 1).cast("int"))
    return table(spark, d, "region", "r_regionkey").select("r_regionkey", recovery.clean_tail(log).alias("tail"))


# ---- office packages ------------------------------------------------------------------------------------------------


@query(
    f"""with l as ({LINES})
 select doc_id, '' as error, doc_id as title, true as lossless, count(*) filter (where regexp_full_match(raw, '#{{1,6}} +\\S.*')) as headings, count(*) filter (where regexp_full_match(raw, '- \\S.*')) as items,
   count(*) filter (where regexp_full_match(raw, '!\\[[^\\]]*\\]\\(images/[^)\\s]+\\)')) as pictures, count(distinct case when regexp_full_match(raw, '!\\[[^\\]]*\\]\\(images/[^)\\s]+\\)') then raw end) > 0 as stored from l group by 1"""
)
def office_documents(spark: SparkSession, d: str) -> DataFrame:
    """Every body as a word-processing package, converted back: headings, items, pictures and the title come through, and no token is lost."""
    return fixtures.docx_trips(bodies(spark, d), "doc_id", "body_md")


@query(
    f"""with p as (select rec_id, string_split(source_text, chr(12)) as pages from coverage_record where source_text is not null),
 t as (select rec_id, len(pages) as n, array_to_string(list_transform(pages, lambda x: array_to_string(list_transform(string_split(x, chr(10)), lambda y: regexp_replace(y, '{WS}+$', '')), chr(10))), chr(12)) as layer from p)
 select rec_id, cast(n as varchar) as pages, cast(rec_id as varchar) as title, md5(layer) as digest from t"""
)
def pdf_layers(spark: SparkSession, d: str) -> DataFrame:
    """Every source text as a PDF, plain or packed, and its text layer read back."""
    rows = table(spark, d, "coverage_record", "rec_id", "source_text").where("source_text is not null")
    made = rows.select("rec_id", pdf.read_layer(fixtures.pdf_of("source_text", F.col("rec_id").cast("string"))).alias("p"))
    return made.select("rec_id", "p.pages", "p.title", F.md5("p.layer").alias("digest"))
