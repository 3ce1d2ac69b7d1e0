"""Queries of the operators that SQL cannot express, or only on made texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clusters, code, distill
from ..sources import io
from .registry import query, table


def sources(spark: SparkSession, d: str) -> DataFrame:
    """A small program for each document."""
    n = F.col("doc_id").cast("string")
    text = F.concat(F.lit("import os, json\nfrom .m"), n, F.lit(" import x\nimport numpy as np\n\nclass A"), n, F.lit(":\n    def run(self, a):\n        return a\n\ndef f"), n, F.lit("(b):\n    return b\n"))
    return table(spark, d, "documents").select("doc_id", F.concat(F.lit("src/m"), n, F.lit(".py")).alias("path"), text.alias("text"))


@query("g8_python_imports", "SELECT doc_id, n.name, n.kind AS module_type FROM documents, (VALUES (1, 'os', 'stdlib'), (2, 'json', 'stdlib'), (3, '.m', 'relative'), (4, 'numpy', 'external')) v(i, b, kind), LATERAL (SELECT b || CASE WHEN i = 3 THEN doc_id::VARCHAR ELSE '' END AS name, kind) n")
def g8(spark: SparkSession, d: str) -> DataFrame:
    return sources(spark, d).select("doc_id", F.explode(code.python_imports("text")).alias("x")).select("doc_id", "x.name", "x.module_type")


@query("g1_python_fragments", "SELECT doc_id, 'A' || doc_id AS name, 'class' AS kind, 'class A' || doc_id || ':' || chr(10) || '    def run(self, a):' AS skeleton FROM documents UNION ALL SELECT doc_id, 'f' || doc_id, 'function', 'def f' || doc_id || '(b):' FROM documents")
def g1(spark: SparkSession, d: str) -> DataFrame:
    return sources(spark, d).select("doc_id", F.explode(code.python_fragments("text")).alias("x")).select("doc_id", "x.name", "x.kind", "x.skeleton")


@query("g7_include_edges", "SELECT 'f' || doc_id || '.php' AS source_file, 'lib/' || (doc_id % 7) || '.php' AS target_file, 'require_once' AS include_type, 2 AS line_number FROM documents UNION ALL SELECT 'f' || doc_id || '.php', '$DYNAMIC', 'include', 3 FROM documents")
def g7(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id").cast("string")
    text = F.concat(F.lit("<?php\nrequire_once('lib/"), (F.col("doc_id") % 7).cast("string"), F.lit(".php');\ninclude $base;\n"))
    return code.include_edges(table(spark, d, "documents").select(F.concat(F.lit("f"), n, F.lit(".php")).alias("path"), text.alias("text")))


@query("x6_script_imports", "SELECT doc_id, 'lit,./m' || doc_id || ',fs' AS modules FROM documents")
def x6(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("import {html} from 'lit';\nimport './m"), F.col("doc_id").cast("string"), F.lit("';\nconst f = require(\"fs\");\nimport x from 'lit';"))
    return table(spark, d, "documents").select("doc_id", F.array_join(code.script_imports(text), ",").alias("modules"))


@query("g3_markdown_sections", "SELECT doc_id, 'One' AS title, 200 AS n FROM documents UNION ALL SELECT doc_id, 'Three', 150 FROM documents")
def g3(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("# One\n" + "a" * 200 + "\n## Two\nshort\n## Three\n"), F.repeat(F.lit("b"), 150))
    x = table(spark, d, "documents").select("doc_id", F.explode(code.markdown_sections(text)).alias("s"))
    return x.select("doc_id", "s.title", F.char_length("s.body").alias("n"))


@query("a21_recall", "SELECT 'src/m' || doc_id || '.py' AS path, CASE WHEN doc_id % 2 = 0 THEN 1.0 ELSE 0.5 END::DOUBLE AS recall FROM documents")
def a21(spark: SparkSession, d: str) -> DataFrame:
    s = sources(spark, d)
    names = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("os"), F.lit("json"))).otherwise(F.array(F.lit("os"), F.lit("missing")))
    gold = s.select("path", F.explode(names).alias("name"))
    found = s.select("path", F.posexplode(code.python_imports("text")).alias("at", "x")).select("path", "x.name", (F.col("at") + 1).alias("rank"))
    return code.recall_at(gold, found, 5)


@query("j8_nearest_readme", "SELECT 'a/b' || (doc_id % 3) || '/c/' || doc_id AS path, CASE doc_id % 3 WHEN 0 THEN 'deep' ELSE 'top' END AS readme FROM documents")
def j8(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "documents").select(F.concat(F.lit("a/b"), (F.col("doc_id") % 3).cast("string"), F.lit("/c/"), F.col("doc_id").cast("string")).alias("path"))
    readmes = spark.createDataFrame([("a", "top"), ("a/b0", "deep")], "folder string, readme string")
    return code.nearest_ancestor(files, readmes)


@query("c4_semantic_dedup")
def c4(spark: SparkSession, d: str) -> DataFrame:
    return clusters.semantic_dedup(table(spark, d, "documents"), "doc_id", "text")


C6 = """
x AS (SELECT doc_id, coalesce(text, '') AS text, doc_id % 5 + 1 AS r, doc_id % 4 + 1 AS m, doc_id % 3 AS c, chr(10) AS n, md5(doc_id::VARCHAR) AS a, md5('c' || doc_id) AS b, md5('x' || doc_id) AS y, md5('y' || doc_id) AS z FROM documents),
kept AS (SELECT doc_id, text, 'checking ' || a || CASE WHEN r > 1 THEN n || 'checking ' || a ELSE '' END || n || n || array_to_string(list_transform(range(m), lambda i: '- option ' || md5('o' || i)), chr(10))
  || CASE WHEN c > 0 THEN n || n || '```py' || n || b || n || '```' ELSE '' END || n || n || '1. ' || y || n || n || '2. ' || z AS t FROM x)"""


@query("c6_distill", f"WITH {C6.strip()} SELECT doc_id, length(t) AS n, md5(t || '</think>' || text) AS digest FROM kept")
def c6(spark: SparkSession, d: str) -> DataFrame:
    """Runs of a line, list items that recur, copies of a code block and of a numbered cycle, by the id."""
    i, hashed = F.col("doc_id"), lambda p: F.md5(F.concat(F.lit(p), F.col("doc_id").cast("string")))
    lines = F.array_join(F.array_repeat(F.concat(F.lit("checking "), hashed("")), (i % 5 + 1).cast("int")), "\n")
    items = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda k: F.concat(F.lit("- option "), F.md5(F.concat(F.lit("o"), (k % (i % 4 + 1)).cast("string"))))), "\n")
    block = F.array_repeat(F.concat(F.lit("```py\n"), hashed("c"), F.lit("\n```")), (i % 3).cast("int"))
    cycle = F.array_repeat(F.concat(F.lit("1. "), hashed("x"), F.lit("\n\n2. "), hashed("y")), (i % 2 + 1).cast("int"))
    thought = F.array_join(F.concat(F.array(lines, items), block, cycle), "\n\n")
    x = table(spark, d, "documents").select("doc_id", distill.distill(100)(F.concat(thought, F.lit("</think>"), F.coalesce("text", F.lit("")))).alias("t"))
    return x.select("doc_id", (F.instr("t", "</think>") - 1).cast("long").alias("n"), F.md5("t").alias("digest"))


@query("k10_chat_lines", "SELECT count(*) AS n, count(DISTINCT text) AS texts FROM documents")
def k10(spark: SparkSession, d: str) -> DataFrame:
    lines = io.chat_lines(table(spark, d, "documents"), "be brief", "lang", "text")
    back = lines.select(F.from_json("line", "messages array<struct<role:string,content:string>>").alias("r")).select(F.element_at("r.messages", 3)["content"].alias("text"))
    return back.agg(F.count("*").alias("n"), F.count_distinct("text").alias("texts"))


@query("k11_prometheus", "SELECT 'docs_total{lang=\"' || lang || '\"} ' || count(*) AS line FROM documents GROUP BY lang")
def k11(spark: SparkSession, d: str) -> DataFrame:
    return io.prometheus(table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n")), "docs_total", ["lang"], "n")
