"""Budgets, proportional cuts, stratified samples, shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize


def stratified_allocation(df: DataFrame, by: str, size: int) -> DataFrame:
    """How many rows each group gives to a balanced sample: an equal quota, then what is left to the largest groups
    first (ties by name). One row for each group, so the windows are small whatever the input."""
    counts = df.groupBy(by).agg(F.count("*").alias("available"))
    every = Window.partitionBy()
    order = Window.orderBy(F.desc("available"), by)
    base = F.least(F.floor(F.lit(size) / F.count("*").over(every)), F.col("available"))
    c = counts.withColumn("base", base).withColumn("room", F.col("available") - F.col("base"))
    left = F.lit(size) - F.sum("base").over(every)
    before = F.coalesce(F.sum("room").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    extra = F.greatest(F.lit(0), F.least(F.col("room"), left - before))
    return c.select(by, "available", (F.col("base") + extra).cast("long").alias("allocated"))


def stratified_sample(df: DataFrame, by: str, size: int, key: Column) -> DataFrame:
    """The allocated number of rows of each group, by the order of a digest of the key."""
    alloc = stratified_allocation(df, by, size).select(by, "allocated")
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.md5(key.cast("string"))))
    return df.withColumn("__rank", rank).join(alloc, by).filter("__rank <= allocated").drop("__rank", "allocated")


def proportional_cut(df: DataFrame, by: str, order: str, total: int) -> DataFrame:
    """The first rows of each group, as many as its share of ``total``; the last group by name takes the rest."""
    counts = df.groupBy(by).agg(F.count("*").alias("n"))
    every, names = Window.partitionBy(), Window.orderBy(by)
    share = F.floor(F.lit(total) * (F.col("n") / F.sum("n").over(every)))
    before = F.coalesce(F.sum("share").over(names.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    quota = F.when(F.row_number().over(names) == F.count("*").over(every), F.lit(total) - before).otherwise(F.col("share"))
    quotas = counts.withColumn("share", share).withColumn("quota", quota).select(by, "quota")
    rank = F.row_number().over(Window.partitionBy(by).orderBy(order))
    return df.withColumn("__rank", rank).join(quotas, by).filter("__rank <= quota").drop("__rank", "quota")


def greedy_budget(df: DataFrame, order: str, tokens: str, budget: int) -> DataFrame:
    """Takes rows in order while they fit into the budget, passing over those that do not; null tokens count as 0 and
    rows that tie go by a digest, equal ones by their place.

    The rows are sorted once, in ranges. A round adds up the rows not larger than what is left of the budget, range by
    range and then within the one range where the sum passes it: all before that row are taken, it is passed over, and
    the next round goes on behind it with less left than its size. So what is left falls from round to round, mostly to
    a fraction; the driver sees one place and one sum a round, and the result is a filter by these places."""
    size = F.coalesce(F.col(tokens).cast("long"), F.lit(0))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(F.struct(F.col(order).alias("o"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("d")).alias("at"), size.alias("t"), row.alias("row"))
    ranges = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    rows = rows.repartitionByRange(ranges, "at").sortWithinPartitions("at").withColumn("range", F.spark_partition_id())
    rows = materialize(rows.withColumn("no", F.monotonically_increasing_id()), "ranged")
    left, place, taken = int(budget), -1, F.lit(False)
    while True:
        open_ = rows.filter((F.col("no") > place) & (F.col("t") <= left)).select("range", "no", "t")
        sums = open_.groupBy("range").agg(F.sum("t").alias("s"))
        upto = sums.withColumn("upto", F.sum("s").over(Window.orderBy("range")))
        over = upto.filter(F.col("upto") > left).agg(F.min(F.struct("range", F.col("upto") - F.col("s"))).alias("x")).first()["x"]
        if over is None:
            return rows.filter(taken | ((F.col("no") > place) & (F.col("t") <= left))).select("row.*")
        inside = open_.filter(F.col("range") == over[0]).withColumn("upto", F.sum("t").over(Window.orderBy("no")) + F.lit(int(over[1])))
        row_over = inside.filter(F.col("upto") > left).agg(F.min(F.struct("no", F.col("upto") - F.col("t"))).alias("x")).first()["x"]
        taken = taken | ((F.col("no") > place) & (F.col("no") < row_over[0]) & (F.col("t") <= left))
        place, left = row_over[0], left - int(row_over[1])


def mix(specialized: DataFrame, anchor: DataFrame, order: str, tokens: str, specialized_pct: float, anchor_pct: float, target_records: int | None = None, seed: int = 42) -> DataFrame:
    """Specialised and anchor records in a proportion of tokens: anchor records are taken in order while they fit into
    their share; over ``target_records`` both give their first records in proportion; the rest is in a seeded
    order. Adds ``is_anchor`` and ``place_key``, the digest by which the mix is ordered."""
    has = specialized.agg(F.sum(tokens)).first()[0] or 0
    if has > 0 and specialized_pct > 0:
        target = int(has * anchor_pct / specialized_pct)
        if (anchor.agg(F.sum(tokens)).first()[0] or 0) > target:
            anchor = greedy_budget(anchor, order, tokens, target)
    n, m = specialized.count(), anchor.count()
    if target_records is not None and n + m > target_records:
        first = int(target_records * (n / (n + m)))
        specialized, anchor = specialized.orderBy(order).limit(first), anchor.orderBy(order).limit(target_records - first)
    both = specialized.withColumn("is_anchor", F.lit(False)).unionByName(anchor.withColumn("is_anchor", F.lit(True)), allowMissingColumns=True)
    return both.withColumn("place_key", seeded_order(F.concat(F.col(order).cast("string"), F.col("is_anchor").cast("string")), seed)).orderBy("place_key")


def typed_sample(df: DataFrame, by: str, kinds: tuple[str, ...], size: int, key: Column) -> DataFrame:
    """A like number of rows of each kind by the order of a key, filled up to ``size`` from the rest: a top-k report."""
    x = df.withColumn("__key", key)
    first = x.filter(F.col(by).isin(*kinds)).withColumn("__r", F.row_number().over(Window.partitionBy(by).orderBy("__key"))).filter(F.col("__r") <= size // len(kinds)).drop("__r")
    rest = x.join(first.select("__key"), "__key", "left_anti").orderBy("__key").limit(size)
    some = first.withColumn("__late", F.lit(False)).unionByName(rest.withColumn("__late", F.lit(True)))
    return some.orderBy("__late", "__key").limit(size).drop("__late", "__key")


def seeded_order(key: Column, seed: int) -> Column:
    """A shuffled order that reruns repeat."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def compose(df: DataFrame, origin: str, kind: str, fmt: str, tokens: str) -> DataFrame:
    """Composition report in long form: records by origin, type and format, and the origin's share of tokens. One
    scan by grouping sets."""
    view = df.select(F.col(origin).alias("origin"), F.col(kind).alias("type"), F.col(fmt).alias("format"), F.col(tokens).alias("tokens"))
    sets = view.groupingSets([["origin"], ["type"], ["format"]], "origin", "type", "format").agg(F.count("*").alias("records"), F.sum("tokens").alias("tokens"), F.grouping("origin").alias("g1"), F.grouping("type").alias("g2"))
    axis = F.when(F.col("g1") == 0, "origin").when(F.col("g2") == 0, "type").otherwise("format")
    out = sets.select(axis.alias("axis"), F.coalesce("origin", "type", "format", F.lit("unknown")).alias("value"), "records", "tokens")
    total = F.sum("tokens").over(Window.partitionBy("axis"))
    return out.withColumn("token_pct", F.when(total > 0, F.round(100.0 * F.col("tokens") / total, 6)))
