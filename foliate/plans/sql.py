"""The operators as SQL functions: scalar ones, and table functions for LATERAL joins."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from foliate.functions.markdown import markdown_to_text
from foliate.operators import outline, recall, validation
from foliate.session import ship_package
from foliate.sources import html, office


class OutlineNodes:
    def eval(self, text: str):
        for n in outline.outline(text or ""):
            yield n["id"], n["parent"], n["level"], n["title"], n["anchor"], n["line_start"], n["line_end"], n["self_tokens"], n["subtree_tokens"]


class ChunkSections:
    def eval(self, doc_id: str, text: str):
        for c in outline.chunks(doc_id or "", text or ""):
            yield c["section_id"], c["level"], c["parent"], c["title"], c["l0"], c["l1"], c["fingerprint"]


class MarkdownIssues:
    def eval(self, text: str):
        yield from validation.issues(text)


class PackageParts:
    def eval(self, content: bytes, ext: str):
        yield from office.read_parts(content, ext or "").items()


def register(spark: SparkSession) -> None:
    """Registers the functions in a session."""
    ship_package(spark)
    spark.udf.register("markdown_to_text", markdown_to_text)
    spark.udf.register("html_to_markdown", html.html_markdown)
    spark.udf.register("char_ngram_recall", recall._gram_recall)
    spark.udf.register("convert_office", office.convert_office)
    spark.sql(r"create or replace temporary function tokenize(t string) returns array<string> return regexp_extract_all(lower(coalesce(t, '')), '[a-z0-9]+', 0)")
    spark.sql("create or replace temporary function document_id(relpath string) returns string return substring(sha1(relpath), 1, 16)")
    for name, cls, schema in (
        ("outline_nodes", OutlineNodes, "id string, parent int, level int, title string, anchor string, line_start int, line_end int, self_tokens bigint, subtree_tokens bigint"),
        ("chunk_sections", ChunkSections, "section_id string, level int, parent string, title string, l0 int, l1 int, fingerprint string"),
        ("md_issues", MarkdownIssues, "line int, code string, severity string, message string"),
        ("unzip_parts", PackageParts, "part string, xml string"),
    ):
        spark.udtf.register(name, udtf(cls, returnType=schema))


