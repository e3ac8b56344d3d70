"""Connected components: few edges at once, any number by alternating large-star and small-star rounds over stored edge tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import done_with, stored

#: Distinct edges up to which the driver takes them all, 16 bytes each. A round is some five exchanges, whatever there is to do.
FEW_EDGES = 100_000


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Label of each of n members: the smallest member that the links reach."""
    label = np.arange(n)
    while len(i):
        was = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        np.minimum.at(label, was, label)
        label = label[label]
        if (label == was).all():
            break
    return label


def few_components(edges: DataFrame) -> DataFrame:
    """The same as components(), of edges that the driver holds."""
    got = edges.select("a", "b").toArrow()
    a, b = (got[c].to_numpy() for c in "ab")
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    roots = nodes[forest(len(nodes), at[: len(a)], at[len(a) :])]
    return edges.sparkSession.createDataFrame(pa.table({"node": pa.array(nodes, pa.int64()), "root": pa.array(roots, pa.int64())}), "node long, root long")


def components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) -> node long, root long: the smallest node that is reachable. Nodes without edges are absent.

    Up to FEW_EDGES edges are collected. Beyond, each round joins edges with one minimum for each node; nothing is
    collected but the count and the checksum of the edge table, which show when a round changed nothing.
    """

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    was, mine = None, mark(now)
    if mine[0] <= FEW_EDGES:
        return few_components(now)
    while mine != was and mine[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = large.join(least, "a")
        small = pairs.select("a", F.col("m").alias("b")).unionByName(pairs.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        old, now, was = now, stored(small), mine
        done_with(now.sparkSession, old)
        mine = mark(now)
    return now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root").unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
