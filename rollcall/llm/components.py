"""Connected components of a table of links, by alternating large and small stars.

Every round is two joins and two groupings; its result is written to the shared folder, which cuts the
lineage and survives lost executors. Rounds grow with the logarithm of a component's size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.session import stage


def _small_star(links: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and the node, hang on the smallest of them."""
    least = links.groupBy("node").agg(F.min("root").alias("least"))
    met = links.join(least, "node")
    moved = met.filter("root <> least").select(F.col("root").alias("node"), F.col("least").alias("root"))
    return moved.unionByName(least.select("node", F.col("least").alias("root"))).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours hang on the smallest of the node and its neighbours."""
    back = links.select(F.col("root").alias("node"), F.col("node").alias("root"))
    both = links.unionByName(back)
    least = both.groupBy("node").agg(F.least("node", F.min("root")).alias("least"))
    met = both.join(least, "node").filter("root > node")
    return met.select(F.col("root").alias("node"), F.col("least").alias("root")).distinct()


def _print_of(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "root")),
        F.sum(F.pmod(F.xxhash64("root", "node"), F.lit(1 << 31))),
    ).first()
    return tuple(row)


def components(links: DataFrame, stem: str = "components") -> DataFrame:
    """(node, root) for every node that is not its component's smallest.

    ``links`` has two orderable columns ``a`` and ``b``; nulls and loops are ignored, repeated links
    count once. Nodes without a link do not appear.
    """
    now = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")
    ).distinct()
    now = stage(now, stem)
    seen = _print_of(now)
    while seen[0]:
        now = stage(_small_star(_large_star(now)), stem)
        found = _print_of(now)
        if found == seen:
            break
        seen = found
    return now


def labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member of the component of each of ``n`` items that links ``i`` - ``j`` join."""
    label = np.arange(n)
    while True:
        p, q = label[i], label[j]
        differ = p != q
        if not differ.any():
            return label
        i, j, p, q = i[differ], j[differ], p[differ], q[differ]
        np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
