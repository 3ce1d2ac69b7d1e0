"""Connected components of links between long ids, by alternating large and small stars.

Every step shrinks paths without gathering a component anywhere: a node's edges are re-hung to its smallest
neighbour by an aggregation with partial sums and a join, both of which split hot nodes, after each partition has
reduced its own edges to a spanning forest. Each round is written to the shared scratch folder, and the one before it
is deleted. Every round hangs some node lower until all hang on their smallest, so the rounds end by themselves, after
about the square of the logarithm of the nodes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, and the smallest node of each one's component."""
    nodes, back = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = back[: len(a)], back[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _forests(batches):
    for batch in batches:
        if batch.num_rows:
            nodes, roots = forest(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            own = nodes != roots
            yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(roots[own])], names=["u", "v"])


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node that has an edge to another."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    e = materialize(e.mapInArrow(_forests, "u long, v long").distinct(), "edges")
    last = None
    while True:
        sign = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(sign) == last:
            break
        last = tuple(sign)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(lowest, "u")
        small = hung.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).filter("u <> v").unionByName(lowest.select("u", F.col("m").alias("v")))
        e, before = materialize(small.distinct(), "edges"), e
        release(before)
    stars = e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    out = materialize(stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components")
    release(e)
    return out
