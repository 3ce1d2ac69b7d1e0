"""Operator 2: mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Every source is a queue of its documents in a shuffled order that a digest fixes, repeated epoch after epoch.
A document's virtual finish time is the number of words of its queue up to its own end, divided by its source's
target: a queue reaches 1 when the source has reached its target. All queues are then merged in the order of
these times and cut where the total budget is spent.

The running sums are made in two levels, so that no task holds a source and none holds the whole order: words by
(source, bucket of the digest) give each bucket its offset, and a window runs within a bucket only. The queues hold
digests and sizes, never rows. Instead of range-sorting all finish times and walking to the budget, the cut is
searched on a grid of the times, then on a grid within the one cell that holds it, and exactly within the last small
cell: the same documents as the sort would give. What reaches the driver are the two cells' numbers and the last place
taken. Within a source the order of the times is the order of the digests, so the cut is one digest for each source
and epoch; the rows themselves are joined with these few and never shuffled.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, release

BUCKET_DIGITS = 3  # of the digest, in base 16: 4096 buckets in each source
CELLS = 4096


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Targets by source from (source, source_size): shares of ``share`` times all words by weight, none above
    ``most`` times its source's words, the excess going to the others by weight.

    With sources in the order of cap / weight, the capped ones come first. The level of the first source whose
    cap is not below it is the final one.
    """
    everywhere = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("__r", F.row_number().over(everywhere) - 1)
    w = functools.reduce(lambda c, k: F.when(F.col("__r") % len(weights) == k, F.lit(float(weights[k]))).otherwise(c), range(len(weights)), F.lit(None).cast("double"))
    ranked = ranked.withColumn("__w", w).withColumn("__cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("__cap") / F.col("__w"), "__r")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(whole) * F.lit(float(share))
    level = (total - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))) / F.sum("__w").over(after)
    ranked = ranked.withColumn("__level", level)
    ranked = ranked.withColumn("__final", F.first(F.when(F.col("__level") <= F.col("__cap") / F.col("__w"), F.col("__level")), ignorenulls=True).over(whole))
    target = F.coalesce(F.least(F.col("__cap"), F.col("__final") * F.col("__w")), F.col("__cap"))
    return ranked.select("source", "source_size", target.alias("target"))


def _cell(times: Column) -> Column:
    """The cell of a finish time; from 2 on there is one for all, which lies beyond any cut."""
    return F.least(F.floor(times * CELLS), F.lit(2 * CELLS)).cast("long")


def fair_mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: list[str] | None = None,
) -> DataFrame:
    """Mixes the sources of ``docs`` to targets by weight.

    ``weights`` go round over the sources by code point, null last; the mix has ``share`` times the words of all
    documents, and no source gets more than ``most`` times its own. Returns a row for each row of ``docs`` with
    the columns ``carry`` (unset: all), ``size`` (words; null text: 0), ``source_size``, ``target``, ``copies``
    (epochs in which the mix takes the row) and ``taken`` (its words, repeats counted). Null sources are one
    source. Rows of no words take nothing. Rows without an id are told apart by their text; rows with one id and size
    in a source are taken together or not at all. Columns named as a result is are dropped; an empty table gives an empty
    one. Reruns agree.
    """
    results = ["size", "source_size", "target", "copies", "taken"]
    carry = [c for c in docs.columns if c.lower() not in results] if carry is None else carry
    text, source = F.col(f"`{text_col}`"), F.col(f"`{source_col}`").cast("string")
    key = F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), text, F.lit("")).cast("binary"))
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    bucket = F.conv(F.substring("key", 1, BUCKET_DIGITS), 16, 10).cast("int")
    # equal rows are one entry: the queues hold (source, key, size) and no rows
    slim = docs.select(source.alias("source"), size.alias("size"), key.alias("key")).groupBy("source", "key", "size").agg(F.sum("size").alias("words"))
    sized = materialize(slim.withColumn("bucket", bucket), "sized")

    by_bucket = materialize(sized.groupBy("source", "bucket").agg(F.sum("words").alias("words")), "buckets")
    targets = source_targets(by_bucket.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    targets = materialize(targets, "targets")
    in_source = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_bucket.withColumn("offset", F.coalesce(F.sum("words").over(in_source), F.lit(0)))
    o, t = offsets.alias("o"), targets.alias("t")
    offsets = o.join(t, F.col("o.source").eqNullSafe(F.col("t.source"))).select(F.col("o.source").alias("__s"), F.col("o.bucket").alias("__b"), "offset", "source_size", "target")

    in_bucket = Window.partitionBy("source", "bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    queues = sized.withColumn("within", F.sum("words").over(in_bucket))
    queues = queues.join(offsets, F.col("source").eqNullSafe(F.col("__s")) & (F.col("bucket") == F.col("__b")))
    end = F.col("offset") + F.col("within")
    epochs = max(1, math.ceil(most))
    times = F.array(*[F.when(F.col("target") > 0, (end + F.col("source_size") * e) / F.col("target")).otherwise(F.lit(0.0)) for e in range(epochs)])
    timed = materialize(queues.filter("size > 0").select("source", "key", "size", "words", times.alias("times")), "timed")

    budget = min(share, most) * (by_bucket.agg(F.sum("words")).first()[0] or 0)
    cut = _cut(timed.select(F.col("words").alias("size"), "key", F.explode("times").alias("f")), budget)
    # within a source times go with (key, size), so the cut is a place in each source's order for each epoch
    inside = lambda e: F.lit(False) if cut is None else (F.col("times")[e] < F.lit(cut[0])) | ((F.col("times")[e] == F.lit(cut[0])) & (F.col("key") <= F.lit(cut[1])))
    place = lambda e: F.max(F.when(inside(e), F.struct("key", "size"))).alias(f"last_{e}")
    lasts = timed.groupBy("source").agg(*[place(e) for e in range(epochs)])
    t, u = targets.alias("t"), lasts.alias("u")
    ends = t.join(u, F.col("t.source").eqNullSafe(F.col("u.source")), "left").select(F.col("t.source").alias("__s"), "source_size", "target", *[f"last_{e}" for e in range(epochs)])
    ends = materialize(ends, "ends")
    release(sized, by_bucket, targets, timed)

    row = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(None).alias("__none"))
    rows = docs.select(row.alias("__row"), source.alias("__source"), size.alias("size"), key.alias("key"))
    rows = rows.join(ends, F.col("__source").eqNullSafe(F.col("__s")))
    copies = functools.reduce(operator.add, [F.coalesce(F.struct("key", "size") <= F.col(f"last_{e}"), F.lit(False)).cast("int") for e in range(epochs)])
    copies = F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("int")
    taken = (copies * F.col("size")).cast("long")
    return rows.select(*[F.col(f"__row.`{c}`") for c in carry], "size", "source_size", "target", copies.alias("copies"), taken.alias("taken"))


def _cut(entries: DataFrame, budget: float) -> tuple[float, str] | None:
    """The last (time, key) that fits into the budget."""

    def first_over(cells: DataFrame, spent: float) -> tuple[int, float]:
        """The first cell that does not fit, and what was spent before it; at most 2 * CELLS + 1 rows are sorted."""
        sums = cells.groupBy("cell").agg(F.sum("size").alias("words"))
        running = sums.withColumn("upto", F.sum("words").over(Window.orderBy("cell")) + F.lit(spent))
        over = running.filter(F.col("upto") > F.lit(budget)).agg(F.min_by(F.struct("cell", F.col("upto") - F.col("words")), "cell").alias("x")).first()["x"]
        return (int(over[0]), float(over[1])) if over else (2 * CELLS + 1, spent)

    cells = entries.withColumn("cell", _cell(F.col("f")))
    cell, spent = first_over(cells, 0.0)
    inner = F.least(F.floor((F.col("f") * CELLS - F.lit(cell)) * CELLS), F.lit(CELLS)).cast("long")
    fine = cells.filter(F.col("cell") == cell).select("size", "key", "f", inner.alias("cell"))
    fine_cell, fine_spent = first_over(fine, spent)
    last = fine.filter(F.col("cell") == fine_cell).groupBy("f", "key").agg(F.sum("size").alias("words"))
    last = last.withColumn("upto", F.sum("words").over(Window.orderBy("f", "key")) + F.lit(fine_spent)).filter(F.col("upto") <= F.lit(budget))
    below = cells.filter((F.col("cell") < cell) | ((F.col("cell") == cell) & (F.floor((F.col("f") * CELLS - F.lit(cell)) * CELLS) < fine_cell)))
    found = last.agg(F.max(F.struct("f", "key")).alias("x")).first()["x"] or below.agg(F.max(F.struct("f", "key")).alias("x")).first()["x"]
    return (found[0], found[1]) if found else None


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it, with its own columns whatever their names."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc")
    named = {k: options.get(k, v) for k, v in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source"))}
    mixed = fair_mix(docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys(named.values())], whole), carry=["__doc"], **options)
    return mixed.filter("copies > 0").select("__doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("__doc.*")


def oracle_sql() -> str:
    """DuckDB SQL for the rows of the query of operator 2."""
    return r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, text, '')) AS key FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM s
), w AS (
  SELECT source, source_size, r, CASE r % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w, source_size * 2.0::DOUBLE AS cap, (SELECT sum(source_size)::DOUBLE FROM s) * 1.5::DOUBLE AS total FROM r
), l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0::DOUBLE)) / sum(w) OVER (ORDER BY cap / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
), t AS (
  SELECT source, source_size, total, coalesce(least(cap, (SELECT arg_min(level, cap / w) FROM l WHERE level <= cap / w) * w), cap) AS target FROM l
), q AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.total, d.key, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT *, (upto + source_size * n)::DOUBLE / target AS f FROM q, (VALUES (0), (1)) v(n) WHERE size > 0
), c AS (
  SELECT doc_id, key, size, sum(size) OVER (ORDER BY f, key) AS spent, total FROM e
), k AS (
  SELECT doc_id, key, size, sum(size)::BIGINT AS taken FROM c WHERE spent <= total GROUP BY ALL
)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(k.taken, 0)::BIGINT AS taken
FROM q LEFT JOIN k ON q.doc_id = k.doc_id AND q.key = k.key AND q.size = k.size
"""
