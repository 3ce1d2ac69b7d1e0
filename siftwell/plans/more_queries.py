"""Further queries: pattern detectors, reports of ignored records, calibration arithmetic, experiments, seeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import audit as A
from .registry import query, table


def docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


@query("w2_sentence_loops", r"WITH s AS (SELECT doc_id, unnest(list_filter(list_transform(string_split(text, '.'), lambda x: regexp_replace(x, '^[ \t\n\r\x0B\f]+|[ \t\n\r\x0B\f]+$', '', 'g')), lambda x: x <> '')) AS s, unnest(range(len(list_filter(list_transform(string_split(text, '.'), lambda x: regexp_replace(x, '^[ \t\n\r\x0B\f]+|[ \t\n\r\x0B\f]+$', '', 'g')), lambda x: x <> '')))) AS i FROM documents), m AS (SELECT *, CASE WHEN s = lag(s) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS new FROM s), g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM m), r AS (SELECT doc_id, island, count(*) AS run FROM g GROUP BY 1, 2) SELECT doc_id, max(run) AS longest FROM r GROUP BY doc_id")
def w2(spark: SparkSession, d: str) -> DataFrame:
    parts = F.filter(F.transform(F.split("text", r"\."), T.strip), lambda x: x != "")
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc, x):
        run = F.when(acc["last"] == x, acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return docs(spark, d).select("doc_id", F.aggregate(parts, start, step, lambda a: a["best"]).cast("long").alias("longest")).filter("longest > 0")


@query("t17_grid_shift", "SELECT doc_id, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, (doc_id % 10) / 8.0::DOUBLE * 1.2::DOUBLE)), 9) AS up, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, (doc_id % 10) / 8.0::DOUBLE * 0.8::DOUBLE)), 9) AS down FROM documents")
def t17(spark: SparkSession, d: str) -> DataFrame:
    v = (F.col("doc_id") % 10) / 8.0
    return docs(spark, d).select("doc_id", F.round(T.clamp01(v * 1.2), 9).alias("up"), F.round(T.clamp01(v * 0.8), 9).alias("down"))


@query("t18_judge_normalize", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 0.5::DOUBLE ELSE least(1.0::DOUBLE, (doc_id % 7) / 4.0::DOUBLE) END AS depth, 0.5::DOUBLE AS style FROM documents")
def t18(spark: SparkSession, d: str) -> DataFrame:
    scores = F.when(F.col("doc_id") % 3 == 0, F.create_map(F.lit("other"), F.lit(1.0))).otherwise(F.create_map(F.lit("depth"), (F.col("doc_id") % 7) / 4.0))
    of = lambda name: T.clamp01(F.coalesce(F.try_element_at(scores, F.lit(name)), F.lit(0.5))).alias(name)
    return docs(spark, d).select("doc_id", of("depth"), of("style"))


@query("a14_weighted_best", "WITH r AS (SELECT (l_quantity % 5)::DOUBLE AS p, l_discount * 10 AS score FROM lineitem), k AS (SELECT *, percent_rank() OVER (ORDER BY score DESC) AS r FROM r) SELECT round(sum(p * score) / sum(score), 6) AS centre FROM k WHERE r <= 0.25")
def a14(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "lineitem").select((F.col("l_quantity") % 5).alias("p"), (F.col("l_discount") * 10).alias("score"))
    return A.weighted_best(r, "p", "score").withColumn("centre", F.round("centre", 6))


@query("a26_best_experiment", "SELECT source, arg_min(doc_id, (n_chars, doc_id)) FILTER (WHERE doc_id % 3 <> 0) AS best FROM documents GROUP BY source")
def a26(spark: SparkSession, d: str) -> DataFrame:
    metric = F.when(F.col("doc_id") % 3 == 0, "n/a").otherwise(F.col("n_chars").cast("string"))
    value = F.expr("try_cast(metric AS bigint)")
    x = docs(spark, d).select("source", "doc_id", metric.alias("metric")).withColumn("v", value).filter("v is not null")
    return docs(spark, d).select("source").distinct().join(x.groupBy("source").agg(F.min_by("doc_id", F.struct("v", "doc_id")).alias("best")), "source", "left")


@query("a27_efficiency", "SELECT l_orderkey, l_linenumber, round(1.0::DOUBLE / (l_quantity + 1) * l_discount / (l_extendedprice / 1000.0::DOUBLE), 9) AS efficiency FROM lineitem")
def a27(spark: SparkSession, d: str) -> DataFrame:
    e = F.lit(1.0) / (F.col("l_quantity") + 1) * F.col("l_discount") / (F.col("l_extendedprice") / 1000.0)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(e, 9).alias("efficiency"))


@query("x17_seed_recycling", "SELECT d.doc_id, b.item_id FROM documents d JOIN (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS k, count(*) OVER () AS n FROM benchmark) b ON d.doc_id % b.n = b.k WHERE d.doc_id < 10 * b.n")
def x17(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "benchmark").select("item_id", (F.row_number().over(Window.orderBy("item_id")) - 1).alias("k"), F.count("*").over(Window.partitionBy()).alias("n"))
    n = table(spark, d, "benchmark").count()
    return docs(spark, d).withColumn("k", F.col("doc_id") % n).join(b, "k").filter(F.col("doc_id") < 10 * F.col("n")).select("doc_id", "item_id")


@query("w20_random_types", "WITH h AS (SELECT doc_id, ('0x' || md5(doc_id || ':7')[:4])::INT % 100 AS h, doc_id % 9 = 0 AS legacy FROM documents) SELECT doc_id, CASE WHEN legacy THEN CASE WHEN h < 60 THEN 'refactor' ELSE 'explain' END WHEN h < 50 THEN 'write' WHEN h < 80 THEN 'refactor' ELSE 'explain' END AS kind FROM h")
def w20(spark: SparkSession, d: str) -> DataFrame:
    h = F.conv(F.substring(F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(":7"))), 1, 4), 16, 10).cast("int") % 100
    legacy = F.col("doc_id") % 9 == 0
    kind = F.when(legacy, F.when(h < 60, "refactor").otherwise("explain")).when(h < 50, "write").when(h < 80, "refactor").otherwise("explain")
    return docs(spark, d).select("doc_id", kind.alias("kind"))


@query("x14_pairwise_scores", "SELECT doc_id, i AS place, abs((doc_id + i) % 5 - (doc_id * i) % 3) AS score FROM documents, range(4) t(i)")
def x14(spark: SparkSession, d: str) -> DataFrame:
    ids = F.sequence(F.lit(0), F.lit(3))
    a, b = F.transform(ids, lambda i: (F.col("doc_id") + i) % 5), F.transform(ids, lambda i: (F.col("doc_id") * i) % 3)
    x = docs(spark, d).select("doc_id", F.posexplode(F.arrays_zip(a.alias("a"), b.alias("b"))).alias("place", "p"))
    return x.select("doc_id", F.col("place").cast("long").alias("place"), F.abs(F.col("p.a") - F.col("p.b")).alias("score"))


@query("f23_prompt_echo", "WITH p AS (SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'user') AS u, arg_min(text, turn) FILTER (WHERE role = 'assistant') AS a FROM conversations GROUP BY conv_id), w AS (SELECT conv_id, list_distinct(string_split(lower(u), ' ')) AS u, list_distinct(string_split(lower(a), ' ')) AS a FROM p WHERE u IS NOT NULL AND a IS NOT NULL) SELECT conv_id, round(len(list_intersect(u, a)) / len(u)::DOUBLE, 9) AS share, len(list_intersect(u, a)) / len(u)::DOUBLE >= 0.6 AS echo FROM w")
def f23(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    first = lambda r: F.min_by(F.when(F.col("role") == r, F.col("text")), F.when(F.col("role") == r, F.col("turn")))
    p = c.groupBy("conv_id").agg(first("user").alias("u"), first("assistant").alias("a")).filter("u is not null and a is not null")
    words = lambda x: F.array_distinct(F.split(F.lower(x), " "))
    share = F.size(F.array_intersect(words(F.col("u")), words(F.col("a")))) / F.size(words(F.col("u")))
    return p.select("conv_id", F.round(share, 9).alias("share"), (share >= 0.6).alias("echo"))
