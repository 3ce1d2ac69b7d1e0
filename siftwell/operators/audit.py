"""Scorecards, reports, latency, recall and parameter analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize

#: The weights of the five dimensions.
WEIGHTS = {"d1": 0.30, "d2": 0.25, "d3": 0.25, "d4": 0.12, "d5": 0.08}
#: The parameter grid.
GRID = {"temperature": [0.1, 0.3, 0.5, 0.7, 0.9, 1.1], "top_k": [10, 20, 40, 60, 80, 100], "min_p": [0.0, 0.02, 0.05, 0.1, 0.2], "repetition_penalty": [1.0, 1.05, 1.1, 1.15, 1.2], "presence_penalty": [0.0, 0.3, 0.6, 0.9, 1.2]}


def last_by_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key, as filling a dictionary would leave it."""
    row = F.struct(*df.columns)
    return df.groupBy(key).agg(F.max_by(row, F.col(order)).alias("__r")).select("__r.*")


def pattern_penalty(code: Column, patterns: Column, most: float = 0.3, without_code: float = 0.0) -> Column:
    """``most`` times the share of target patterns that the code lacks; ``without_code`` where there is none."""
    missing = F.size(F.filter(patterns, lambda p: ~F.lower(code).contains(F.lower(p))))
    return F.when(F.size(patterns) == 0, F.lit(0.0)).when(F.coalesce(code, F.lit("")) == "", F.lit(without_code)).otherwise(F.lit(most) * missing / F.size(patterns))


def composite(dims: dict[str, Column]) -> Column:
    total = F.lit(0.0)
    for name, w in WEIGHTS.items():
        total = total + F.lit(w) * dims[name]
    return total


#: The scales of the scorecard and of the written report, and the verdicts.
SCORECARD_GRADES = ((90, "A+"), (80, "A"), (70, "B"), (60, "C"), (50, "D"))
REPORT_GRADES = ((90, "A"), (80, "B"), (70, "C"), (60, "D"), (50, "E"))
VERDICTS = ((80, "PASS"), (60, "CONDITIONAL"), (40, "WARN"))


def _step(score: Column, steps, lowest: str) -> Column:
    out = F.lit(lowest)
    for limit, name in reversed(steps):
        out = F.when(score >= limit, name).otherwise(out)
    return out


def grade(score: Column, scale=SCORECARD_GRADES) -> Column:
    """The grade of a score of 0 to 100."""
    return _step(score, scale, "F")


def verdict(score: Column) -> Column:
    """Whether what was audited may be merged: PASS, CONDITIONAL, WARN or FAIL."""
    return _step(score, VERDICTS, "FAIL")


def latency_summary(df: DataFrame, by: str, value: str) -> DataFrame:
    """Mean, median, interpolated percentiles and the nearest-rank 95th (the value at place int(0.95 n), from 0)."""
    p = F.percentile(value, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    ranked = df.withColumn("__r", F.row_number().over(Window.partitionBy(by).orderBy(value))).withColumn("__n", F.count("*").over(Window.partitionBy(by)))
    nearest = ranked.filter(F.col("__r") == F.floor(F.col("__n") * 0.95) + 1).select(by, F.col(value).alias("p95_nearest"))
    summary = df.groupBy(by).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.min(value).alias("least"), F.max(value).alias("most"), p.alias("p"))
    return summary.join(nearest, by).select(by, "n", "mean", "least", "most", F.col("p")[0].alias("median"), F.col("p")[1].alias("p95"), F.col("p")[2].alias("p99"), "p95_nearest")


def grid(spark, params: dict[str, list] | None = None) -> DataFrame:
    """Every combination of parameter values, numbered. A few thousand rows by construction."""
    df = None
    for name, values in (params or GRID).items():
        one = spark.createDataFrame([(float(v),) for v in values], f"{name} double")
        df = one if df is None else df.crossJoin(F.broadcast(one))
    return df


def by_parameter(results: DataFrame, params: list[str], score: str) -> DataFrame:
    """Mean score and count of each value of each parameter."""
    long = results.select(F.col(score).alias("score"), F.explode(F.array(*[F.struct(F.lit(p).alias("parameter"), F.col(p).cast("double").alias("value")) for p in params])).alias("x")).select("x.*", "score")
    return long.groupBy("parameter", "value").agg(F.avg("score").alias("mean"), F.count("*").alias("n"))


def noxious_values(stats: DataFrame, least: int = 5, gap: float = 0.15, small_gap: float = 0.015, worst: float = 0.25) -> DataFrame:
    """Values to drop: far below the best of the parameter, or below it by a little and among its worst; never all."""
    s = stats.filter(F.col("n") >= least)
    w = Window.partitionBy("parameter")
    best, n = F.max("mean").over(w), F.count("*").over(w)
    rank = F.row_number().over(w.orderBy("mean", "value"))
    below = best - F.col("mean")
    bad = (below > gap) | ((below > small_gap) & (rank <= F.ceil(n * worst)))
    return s.select("parameter", "value", "mean", "n", bad.alias("noxious"))


def weighted_best(results: DataFrame, param: str, score: str, share: float = 0.25) -> DataFrame:
    """Score-weighted mean of a parameter over the best share of the results, by their percent rank.

    Equal scores go as one; these are sorted in ranges, of which each is ranked by itself after the counts of those
    before it, so no task holds more than its range."""
    value = F.col(score)
    each = results.groupBy(value.alias("score")).agg(F.count("*").alias("n"), F.sum(F.col(param) * value).alias("weighted"), F.sum(value).alias("total"))
    ranges = max(1, int(results.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    each = materialize(each.repartitionByRange(ranges, F.desc("score")).withColumn("range", F.spark_partition_id()), "ranged")
    every, ranged = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    sums = each.groupBy("range").agg(F.sum("n").alias("rows"))
    sums = sums.select("range", F.coalesce(F.sum("rows").over(every), F.lit(0)).alias("earlier"), F.sum("rows").over(Window.partitionBy()).alias("all"))
    better = F.col("earlier") + F.coalesce(F.sum("n").over(ranged), F.lit(0))
    ranked = each.join(F.broadcast(sums), "range").withColumn("__p", F.when(F.col("all") > 1, better / F.greatest(F.col("all") - 1, F.lit(1))).otherwise(F.lit(0.0)))
    return ranked.filter(F.col("__p") <= share).agg((F.sum("weighted") / F.sum("total")).alias("centre"))


def degrees(edges: DataFrame, a: str, b: str) -> DataFrame:
    """In- and out-degree, and the marks of leaves (no edge in), entry points (no edge in but some out) and hubs."""
    out = edges.groupBy(F.col(a).alias("node")).agg(F.count("*").alias("out_degree"))
    into = edges.groupBy(F.col(b).alias("node")).agg(F.count("*").alias("in_degree"))
    both = out.join(into, "node", "full_outer").select("node", F.coalesce("in_degree", F.lit(0)).alias("in_degree"), F.coalesce("out_degree", F.lit(0)).alias("out_degree"))
    return both.withColumn("entry_point", F.col("in_degree") == 0).withColumn("hub", F.col("in_degree") >= 5)
