"""Exact top-k by inner product: columnar branch-and-bound in tiles.

Components are integers, ``floor(scale * x)``. Vectors are dealt into tiles by hash of their
identifier, queries into blocks; each pair of a tile and a block is one group. In a group vectors lie by
dimension. For a query the scores of all candidates grow by one block of dimensions at a time; the mass
a vector has in its remaining dimensions bounds what it can still gain or lose (Cauchy-Schwarz), and
candidates whose best case is under the k-th worst case are left behind. Each group yields k rows per
query at most, from which the k best of all groups are taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TILE, QUERIES = 8192, 2048
DIMENSIONS = 16
SCALE, K, EVERY = 256, 5, 50


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, q): integer components of the vectors that take part.

    Left out: null identifiers, null vectors and vectors with null or non-finite components.
    """
    x = F.col("embedding")
    good = F.forall(x, lambda c: F.coalesce(
        ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")), F.lit(False)
    ))
    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("bigint"))
    rows = vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & good)
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("q"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers, shorter ones filled up with zeros."""
    found = column.combine_chunks()
    found = found.chunk(0) if isinstance(found, pa.ChunkedArray) else found
    size = np.diff(found.offsets.to_numpy())
    values = found.flatten().to_numpy()
    rows = np.zeros((len(found), width), dtype=np.int64)
    rows[np.repeat(np.arange(len(found)), size), _inner(size)] = values
    return rows


def _inner(size: np.ndarray) -> np.ndarray:
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def _exact(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The numbers in a type whose inner products are exact: double where it can be, else Python's."""
    most = max(np.abs(rows.astype(np.float64)).max(initial=0), np.abs(others.astype(np.float64)).max(initial=0))
    return rows.astype(np.float64 if most**2 * max(1, rows.shape[1]) < 2**52 else object)


def search(query: np.ndarray, own: int, columns: np.ndarray, ids: np.ndarray, mass: np.ndarray, k: int):
    """Numbers and scores of the k best candidates; ``mass`` has what is left from each block on."""
    alive = np.flatnonzero(ids != own)
    score = np.zeros(len(alive), dtype=columns.dtype)
    rest = np.r_[np.cumsum((query.astype(np.float64) ** 2)[::-1])[::-1], 0.0]
    for n, at in enumerate(range(0, len(query), DIMENSIONS)):
        block = columns[at : at + DIMENSIONS]
        block = block if len(alive) == len(ids) else block[:, alive]
        score = score + query[at : at + DIMENSIONS] @ block
        left = min(at + DIMENSIONS, len(query))
        if left == len(query) or len(alive) <= k or score.dtype == object:
            continue
        slack = np.sqrt(rest[left] * mass[n + 1][alive]) * (1 + 1e-9) + 1
        seen = score.astype(np.float64)
        worst = seen - slack
        floor = np.partition(worst, len(worst) - k)[len(worst) - k]
        keep = seen + slack >= floor
        alive, score = alive[keep], score[keep]
    if score.dtype == object:
        score = np.array([max(-(2**63), min(2**63 - 1, int(x))) for x in score], dtype=object)
    if len(alive) > k:
        floor = np.sort(score)[-k]
        keep = score >= floor
        alive, score = alive[keep], score[keep]
    order = np.lexsort((ids[alive], -score.astype(np.float64))) if score.dtype != object else np.array(
        sorted(range(len(alive)), key=lambda i: (-score[i], ids[alive[i]])), dtype=np.int64
    )
    return alive[order[:k]], score[order[:k]]


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = K, tile: int = TILE, block: int = QUERIES
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` highest inner products for every query.

    Both sides are (vec_id, q). A vector with the query's identifier is the query's own and no
    candidate; ties go to the smaller identifier. A query whose row is repeated counts once; rows of queries
    that share an identifier but not a vector are queries of their own, each with its ranks. Vectors of different lengths are compared as if the
    shorter ended in zeros. Scores beyond 64 bits are clipped
    before they are ranked; numbers that large are scored without bounds.
    """
    queries = queries.dropDuplicates(["vec_id", "q"])
    n_tiles = max(1, -(-vectors.count() // tile))
    n_blocks = max(1, -(-queries.count() // block))
    deal = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.select("vec_id", "q", F.lit(0).cast("bigint").alias("mark"), F.lit(0).alias("side"), deal(n_tiles, 0).alias("tile"),
                          every(n_blocks).alias("block"))
    right = queries.select("vec_id", "q", F.xxhash64("q").alias("mark"), F.lit(1).alias("side"), every(n_tiles).alias("tile"),
                           deal(n_blocks, 1).alias("block"))

    def run(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        size = np.array([len(q) for q in group.column("q")])
        width = int(size.max(initial=0))
        rows, ids = _matrix(group.column("q"), width), group.column("vec_id").to_numpy()
        wanted, wanted_ids, marks = rows[side == 1], ids[side == 1], group.column("mark").to_numpy()[side == 1]
        rows, ids = rows[side == 0], ids[side == 0]
        columns = np.ascontiguousarray(_exact(rows, wanted).T)
        wanted = wanted.astype(columns.dtype)
        power = rows.astype(np.float64).T ** 2
        mass = [power[at:].sum(axis=0) for at in range(0, width, DIMENSIONS)] + [np.zeros(len(ids))]
        out: dict[str, list] = {"query_id": [], "mark": [], "vec_id": [], "score": []}
        for query, own, mark in zip(wanted, wanted_ids.tolist(), marks.tolist()):
            found, score = search(query, own, columns, ids, mass, k)
            out["query_id"] += [own] * len(found)
            out["mark"] += [mark] * len(found)
            out["vec_id"] += ids[found].tolist()
            out["score"] += [int(s) for s in score]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    part = left.unionByName(right).groupBy("tile", "block").applyInArrow(
        run, "query_id bigint, mark bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    ranked = part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
