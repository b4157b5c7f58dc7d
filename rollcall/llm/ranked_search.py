"""Ranked lexical search by MaxScore with bounds of term pairs.

Documents lie in tiles of bounded size, each with its lists of the terms that some query asks for. For pairs
of terms of a query, heaviest with heaviest, the intersection of the two lists is taken once and the largest
impact that both terms have together in one document of the tile is stored. It is often well below the sum of
the terms' own maxima, since few documents are best in both.

A query combines the stored bounds of its pairs (two ways to pair its terms, the smaller sum counts) into a
bound of the tile. Its best tile is searched first and gives a score that 50 documents reach; tiles bounded
below it are skipped for this query. In the others the pairs are taken largest bound first: once the pairs
that are left cannot lift an unseen document to the threshold, only documents seen so far go on, and these
drop out as soon as the pairs left cannot lift them either.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import LOWER, UPPER, blocks, texts
from rollcall.session import stage

TOP = 50
# Documents of a tile; items searched together, whose terms and pairs every task knows.
TILE, ITEMS = 4096, 1024

# Digits, letters and all beyond ASCII make terms; A-Z are lower-cased.
_TERM = bytes(
    c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)
).translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM).split()


@dataclass
class Plan:
    """The terms of some items and how they are paired; weights come with the counts of the corpus."""

    items: list[list[int]]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    # For every item and each way to pair its terms: numbers of pairs (a term alone is paired with itself).
    ways: list[list[list[int]]] = field(default_factory=list)
    weight: np.ndarray | None = None
    factor: tuple[int, int] = (0, 1)

    def weigh(self, weight: np.ndarray, n_docs: int, n_terms: int) -> None:
        """Pair the terms, heaviest first, once from the first term on and once from the second."""
        self.weight, self.factor = weight, (n_docs, max(1, n_terms))
        number: dict[tuple[int, int], int] = {}
        for terms in self.items:
            order = sorted((t for t in terms if weight[t] > 0), key=lambda t: (-weight[t], t))
            ways = []
            for alone in (0, 1):
                found = [(t, t) for t in order[:alone]]
                rest = order[alone:]
                found += [(rest[i], rest[min(i + 1, len(rest) - 1)]) for i in range(0, len(rest), 2)]
                ways.append([number.setdefault(p, len(number)) for p in found])
            self.ways.append(ways)
        self.pairs = list(number)


class Tile:
    """Lists of a tile with impacts: documents and what the term adds to each one's score."""

    def __init__(self, row: dict, plan: Plan) -> None:
        length = np.asarray(row["lengths"], dtype=np.int64)
        n_docs, n_terms = plan.factor
        mass = 50 + (50 * length * n_docs) // n_terms
        ends = np.cumsum(row["counts"])
        docs, tf = np.asarray(row["docs"], dtype=np.int64), np.asarray(row["tfs"], dtype=np.int64)
        self.size = len(length)
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for term, a, b in zip(row["terms"], [0, *ends.tolist()], ends.tolist()):
            at = docs[a:b]
            impact = plan.weight[term] * ((1_000_000_000 * tf[a:b]) // (1000 * tf[a:b] + 20 * mass[at]))
            self.lists[term] = (at, impact)

    def joint(self, pair: tuple[int, int]) -> int:
        """The most that the two terms add to one document: together where both occur, else alone."""
        one = self.lists.get(pair[0])
        two = self.lists.get(pair[1]) if pair[1] != pair[0] else None
        if one is None or two is None:
            found = one or two
            return int(found[1].max()) if found else 0
        most = max(int(one[1].max()), int(two[1].max()))
        _, i, j = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
        return max(most, int((one[1][i] + two[1][j]).max())) if len(i) else most

    def search(
        self, pairs: list[tuple[int, int]], bounds: list[int], least: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Documents that score ``least`` (over 0) or more, and their scores."""
        order = np.argsort(-np.asarray(bounds, dtype=np.int64), kind="stable").tolist()
        left = np.cumsum([0, *[bounds[k] for k in reversed(order)]])[::-1].tolist()
        score = np.zeros(self.size, dtype=np.int64)
        spare = np.zeros(self.size, dtype=np.int64)
        alive = None
        for place, k in enumerate(order):
            if alive is None and left[place] < least:
                alive = np.flatnonzero(score + left[place] >= least)
            for term in dict.fromkeys(pairs[k]):
                if term not in self.lists:
                    continue
                docs, impact = self.lists[term]
                if alive is None:
                    score[docs] += impact
                else:
                    spare[docs] = impact
                    score[alive] += spare[alive]
                    spare[docs] = 0
            if alive is not None:
                alive = alive[score[alive] + left[place + 1] >= least]
                if len(alive) == 0:
                    break
        found = np.flatnonzero(score >= least) if alive is None else alive
        return found, score[found]


_LISTS = T.StructType([
    T.StructField("tile", T.LongType()),
    T.StructField("n_docs", T.LongType()), T.StructField("n_terms", T.LongType()),
    T.StructField("lengths", T.ArrayType(T.LongType())),
    T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType())),
    T.StructField("docs", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.IntegerType())),
])


class _Building:
    """A tile as it is filled."""

    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.lengths: list[int] = []
        self.docs: list[np.ndarray] = []
        self.terms: list[np.ndarray] = []
        self.tfs: list[np.ndarray] = []
        self.n_docs = self.n_terms = 0

    def add(self, batch: pa.RecordBatch, known: dict[bytes, int]) -> None:
        held = []
        for place, text in enumerate(texts(batch, "text")):
            words = terms_of(text)
            self.n_docs += bool(words)
            self.n_terms += len(words)
            found = np.fromiter((t for t in map(known.get, words) if t is not None), np.int64)
            if len(found) == 0:
                continue
            term, tf = np.unique(found, return_counts=True)
            self.docs.append(np.full(len(term), len(self.lengths)))
            self.terms.append(term)
            self.tfs.append(tf)
            self.lengths.append(len(words))
            held.append(place)
        self.ids.append(batch.column("doc_id").take(pa.array(held, pa.int64())))

    def row(self, tile: int, id_type: pa.DataType) -> pa.RecordBatch:
        none = [np.zeros(0, dtype=np.int64)]
        docs, terms, tfs = (np.concatenate(none + x) for x in (self.docs, self.terms, self.tfs))
        order = np.argsort(terms, kind="stable")
        term, count = np.unique(terms, return_counts=True)
        ids = pa.concat_arrays([pa.array([], id_type), *self.ids])
        listed = lambda x, kind: pa.array([x], pa.list_(kind))
        return pa.RecordBatch.from_pydict({
            "tile": pa.array([tile], pa.int64()),
            "n_docs": pa.array([self.n_docs], pa.int64()), "n_terms": pa.array([self.n_terms], pa.int64()),
            "lengths": listed(self.lengths, pa.int64()),
            "terms": listed(term, pa.int32()), "counts": listed(count, pa.int32()),
            "docs": listed(docs[order], pa.int32()), "tfs": listed(tfs[order], pa.int32()),
            "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
        })


def index(docs: DataFrame, vocabulary: dict[bytes, int], tile: int = TILE) -> DataFrame:
    """A row per tile: counts of its documents and terms, and the lists of the terms of the vocabulary.

    Documents without any of them count, and are in no list. Lists hold places in ``ids``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, held = TaskContext.get().partitionId() << 32, 0, _Building()
        kind = None
        for batch in blocks(batches, "text"):
            kind = batch.column("doc_id").type
            for a in range(0, batch.num_rows, tile):
                part = batch.slice(a, tile)
                if held.lengths and len(held.lengths) + part.num_rows > tile:
                    yield held.row(base + made, kind)
                    made, held = made + 1, _Building()
                held.add(part, vocabulary)
        if kind is not None:
            yield held.row(base + made, kind)

    schema = T.StructType([*_LISTS.fields, T.StructField("ids", T.ArrayType(docs.schema["doc_id"].dataType))])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _lists(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[tuple[pa.RecordBatch, int, Tile]]:
    """Every tile of a task, one at a time."""
    names = ("lengths", "terms", "counts", "docs", "tfs")
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in names}
            row |= {c: row[c].tolist() for c in ("terms",)}
            yield batch, k, Tile(row, plan)


def joint_bounds(tiles: DataFrame, plan: Plan) -> DataFrame:
    """(tile, joint): the largest joint impact of every pair of the plan in every tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, k, tile in _lists(batches, plan):
            found = [tile.joint(p) for p in plan.pairs]
            yield pa.RecordBatch.from_pydict({
                "tile": batch.column("tile").slice(k, 1), "joint": pa.array([found], pa.list_(pa.int64())),
            })

    return tiles.drop("ids").mapInArrow(run, "tile bigint, joint array<bigint>")


def _item_bounds(joint: DataFrame, plan: Plan) -> DataFrame:
    """(tile, item, bound): what no document of the tile exceeds; only items that occur in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                most = batch.column("joint")[k].values.to_numpy()
                bound = np.array(
                    [min(int(most[w].sum()) for w in ways) for ways in plan.ways], dtype=np.int64
                )
                item = np.flatnonzero(bound > 0)
                tile = batch.column("tile")[k].as_py()
                yield pa.RecordBatch.from_pydict({
                    "tile": pa.array([tile] * len(item), pa.int64()),
                    "item": pa.array(item, pa.int32()), "bound": pa.array(bound[item]),
                })

    return joint.mapInArrow(run, "tile bigint, item int, bound bigint")


def _searched(tiles: DataFrame, asked: DataFrame, plan: Plan, top: int) -> DataFrame:
    """(item, doc_id, score): the best of every tile for the items asked of it.

    ``asked`` has ``tile``, ``joint`` and ``wanted``, an array of (item, least score).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}  # the best scores of this task's tiles so far, by item
        for batch, k, tile in _lists(batches, plan):
            joint = batch.column("joint")[k].values.to_numpy()
            ids = batch.column("ids")[k].values
            rank = np.empty(len(ids), dtype=np.int64)
            rank[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
            items, at, scores = [], [], []
            for want in batch.column("wanted")[k].as_py():
                item, least = want["item"], max(1, want["least"])
                known = best.get(item, np.zeros(0, dtype=np.int64))
                if len(known) >= top:
                    least = max(least, int(known[-1]))
                way = min(plan.ways[item], key=lambda w: int(joint[w].sum()))
                found, score = tile.search([plan.pairs[p] for p in way], joint[way].tolist(), least)
                order = np.lexsort((rank[found], -score))[:top]
                items.append(np.full(len(order), item))
                at.append(found[order])
                scores.append(score[order])
                best[item] = -np.sort(-np.r_[known, score[order]])[:top]
            if items:
                yield pa.RecordBatch.from_pydict({
                    "item": pa.array(np.concatenate(items), pa.int32()),
                    "doc_id": ids.take(pa.array(np.concatenate(at), pa.int64())),
                    "score": pa.array(np.concatenate(scores), pa.int64()),
                })

    kind = tiles.schema["ids"].dataType.elementType
    schema = T.StructType([
        T.StructField("item", T.IntegerType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType()),
    ])
    return tiles.join(asked, "tile").mapInArrow(run, schema)


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _search_block(docs: DataFrame, items: list[list[bytes]], top: int, tile: int) -> DataFrame:
    """(item, rank, doc_id, score) of the items of one block, named by their place."""
    vocabulary = {t: n for n, t in enumerate(sorted({t for terms in items for t in terms}))}
    plan = Plan([[vocabulary[t] for t in terms] for terms in items])
    tiles = stage(index(docs, vocabulary, tile), "search-tiles")
    n_docs, n_terms = tiles.agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))
    ).first()
    listed = tiles.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    df = np.zeros(len(vocabulary), dtype=np.int64)
    # As many rows as the items have terms, whatever the corpus.
    for term, count in listed.groupBy("t.terms").agg(F.sum("t.counts")).collect():
        df[term] = count
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df]
    plan.weigh(np.array(weight, dtype=np.int64), n_docs, n_terms)
    joint = stage(joint_bounds(tiles, plan), "joint-bounds")
    bounds = stage(_item_bounds(joint, plan), "item-bounds")
    first = bounds.groupBy("item").agg(F.max_by("tile", "bound").alias("tile"))
    asked = _asked(first.withColumn("least", F.lit(1).cast("bigint")), joint)
    seeds = stage(_best(_searched(tiles, asked, plan, top), top), "search-seeds")
    least = seeds.filter(F.col("rank") == top).select("item", F.col("score").alias("least"))
    rest = bounds.join(least, "item", "left").withColumn("least", F.coalesce("least", F.lit(1)))
    asked = _asked(rest.filter("bound >= least"), joint)
    return _best(_searched(tiles, asked, plan, top), top)


def _asked(wanted: DataFrame, joint: DataFrame) -> DataFrame:
    each = wanted.groupBy("tile").agg(F.collect_list(F.struct("item", "least")).alias("wanted"))
    return each.join(joint, "tile")


def search(
    docs: DataFrame, queries: DataFrame, top: int = TOP, tile: int = TILE, block: int = ITEMS
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every item, score above 0.

    ``docs`` has ``doc_id`` and ``text``, ``queries`` has ``item_id`` and ``text``; other columns are left
    out. Terms are runs of digits, letters and characters beyond ASCII, A-Z lower-cased. A term weighs
    floor(1000 ln((2N + 2) / (2 df + 1))) and adds its weight times (10^9 tf) div (1000 tf + 20 m), m being
    50 + (50 n N) div L. Equal scores rank by identifier, null last. Null and empty texts hold no terms: as
    documents they count nowhere, as items they find nothing. Rows of ``queries`` that share an identifier
    are one item with the terms of all; rows of ``docs`` are documents of their own, repeated ones too.

    Items are searched ``block`` at a time; only a block's terms, pairs and their counts reach the driver.
    """
    names = queries.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    asked = stage(names.groupBy("item_id").agg(F.collect_set("text").alias("texts")), "search-items")
    n_blocks = max(1, -(-asked.count() // block))
    where = F.pmod(F.xxhash64("item_id"), F.lit(n_blocks))
    found = []
    for n in range(n_blocks):
        rows = sorted(asked.filter(where == n).collect(), key=repr)
        items = [list(dict.fromkeys(t for text in sorted(r.texts) for t in terms_of(text))) for r in rows]
        key = asked.schema["item_id"]
        ids = docs.sparkSession.createDataFrame(
            [(i, r.item_id) for i, r in enumerate(rows)],
            T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", key.dataType)]),
        )
        block_found = _search_block(docs, items, top, tile)
        if n_blocks > 1:
            block_found = stage(block_found, "search-block")
        found.append(block_found.join(ids, "item").select("item_id", "rank", "doc_id", "score"))
    all_found = found[0]
    for more in found[1:]:
        all_found = all_found.unionByName(more)
    return all_found
