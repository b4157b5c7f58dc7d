"""Jaccard join of texts by word n-grams, partitioned vertically.

All n-grams are in one global order, that of their hashes. The order is cut into ``FRAGMENTS`` ranges, so
every text's set falls into as many segments. In each fragment the common n-grams of a pair are counted
on their own; a pair's counts are then summed over the fragments and held against the sizes of its sets.
No task ever holds two whole sets.

Which pairs are counted follows from finer cuts of the same order, the *cells*. Two sets that link differ in
at most D n-grams, where D hangs on their sizes alone; cut into more than D cells they agree on a whole cell.
Texts therefore meet on equal cells only (``cells_of``), and no pair that links is missed.

A crowd of near copies yields no pairs of its own. Where many sets meet, each is counted with one of them,
the pivot: the set that meets most others, hence the middle of its crowd. What is still apart after that is
compared by what it has more or less than the pivot, a few n-grams of each set: two sets differ just where
these differences do. They meet in tiles of bounded size, and a tile returns a spanning forest of its links.

Most cells and most texts meet nothing. Bitmaps of what meets leave nearly all of them out where they are
read, before a shuffle; the joins behind them decide, so a bitmap that lets too much through changes no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import LOWER, UPPER, bitmap_of, blocks, row_key, texts
from rollcall.llm.components import components, labels
from rollcall.session import stage

WORDS, PERCENT = 3, 90
# Ranges of the global order in which common n-grams are counted.
FRAGMENTS = 8
# Sizes of a band differ by this factor; up to this D texts meet on two cells at once, beyond on one of
# so many n-grams at least.
BAND, PAIRED, STRONG = 1.2, 4, 3
# Sets of a tile, n-grams that they have more or less than their pivot, and those compared at a time.
TILE, TILE_GRAMS, COLUMNS = 1024, 1 << 19, 2048
# Bits of a bitmap for each hash in it, and at most in all, as a power of two.
SPARSE, BITS = 32, 27

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_MIX = np.random.default_rng(11).integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
# Hashes of words met, up to a bound.
_HASHES: dict[bytes, int] = {}
MOST_HASHES = 1 << 19


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result hangs on all bits of a number."""
    x = (x ^ (x >> np.uint64(32))) * _MIX[60]
    x = (x ^ (x >> np.uint64(29))) * _MIX[61]
    return x ^ (x >> np.uint64(32))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct n-grams; of the whole sequence if it is shorter; none without words."""
    found = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    new = set(found).difference(_HASHES)
    if len(_HASHES) + len(new) > MOST_HASHES:
        _HASHES.clear()
        new = set(found)
    digest = xxhash.xxh3_64_intdigest
    _HASHES.update((w, digest(w)) for w in new)
    each = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
    width = min(words, len(found))
    total = np.repeat(_MIX[40 + width % 8], len(found) - width + 1)
    for k in range(width):
        total += each[k : len(each) - width + 1 + k] * _MIX[k]
    return np.unique(_mixed(total))


def _differ(sizes: int, percent: int) -> int:
    """Most n-grams in one of two sets alone, if they link and have so many together."""
    return sizes * (100 - percent) // (100 + percent)


@cache
def _bands(percent: int) -> list[int]:
    """Where each band of sizes begins; below the first only equal sets link."""
    least = next(n for n in range(1, 1000) if _differ(2 * n - 1, percent) >= 1)
    found = [least]
    while found[-1] < 1 << 40:
        found.append(max(found[-1] + 1, int(found[-1] * BAND)))
    return found


def cells_of(held: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Numbers of the cells on which a set meets others.

    A pair is looked for in the band of its larger set, where both are cut in the same way. Up to
    ``PAIRED`` differences there are two cells more than these, and sets meet on two cells together.
    Beyond that sets meet on cells of ``STRONG`` n-grams; a set with so few of them that all could
    differ meets on its other cells too.
    """
    n = len(held)
    edges = _bands(percent)
    own = int(np.searchsorted(edges, n, side="right")) - 1
    last = int(np.searchsorted(edges, n * 100 // percent, side="right")) - 1
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(_mixed(held ^ _MIX[50]), dtype=np.uint64)]
    found = [np.zeros(0, dtype=np.uint64)]
    for band in range(max(own, 0), last + 1):
        d = _differ(2 * (edges[band + 1] - 1), percent)
        many = d + 2 if d <= PAIRED else d + 1 + -(-d // 16)
        place = ((held >> np.uint64(32)) * np.uint64(many)) >> np.uint64(32)
        at = np.searchsorted(place, np.arange(many + 1, dtype=np.uint64))
        size = np.diff(at)
        cell = np.arange(many, dtype=np.uint64)
        held_by = _mixed(sums[at[1:]] - sums[at[:-1]] + (cell + np.uint64(band << 32)) * _MIX[51])
        if d <= PAIRED:
            i, j = np.triu_indices(many, 1)
            found.append(_mixed(held_by[i] * _MIX[53] + held_by[j] * _MIX[54]))
        else:
            strong = size >= STRONG
            found.append(held_by[strong] if strong.sum() > d else held_by)
    return np.concatenate(found)


_SETS = "node binary, n bigint, cells array<bigint>"


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, dtype=np.uint64), *parts]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _node(held: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(held.tobytes())


def _sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Row key, name of the set, its size and cells, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            held = [shingles(t, words) for t in texts(batch, "text")]
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c) for c in ("row_id", "row_hash", "row_check")},
                "node": pa.array(map(_node, held), pa.binary()),
                "n": pa.array(map(len, held), pa.int64()),
                "cells": _lists([cells_of(x, percent) for x in held]),
            })

    id_type = docs.schema["row_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"row_id {id_type}, row_hash bigint, row_check bigint, {_SETS}")


def _bitmap(hashes: DataFrame, column: str) -> Broadcast:
    """A broadcast bitmap of the upper bits of a column of hashes; ``hashes`` is read twice."""
    size = min(BITS, max(10, (SPARSE * hashes.count()).bit_length()))
    return bitmap_of(hashes.select(F.shiftrightunsigned(column, 64 - size).alias("at")), size)


def _held(bitmap: Broadcast, hashes: np.ndarray) -> np.ndarray:
    """Whether the bitmap has these hashes, and now and then others."""
    bits = bitmap.value.view(np.uint64)
    at = hashes.view(np.uint64) >> np.uint64(59 - len(bits).bit_length())
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _likely_cells(seen: DataFrame, shared: DataFrame) -> DataFrame:
    """(cell, node, n): all cells of the sets that are in ``shared``, and few others."""
    bitmap = _bitmap(shared, "cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("cells")
            found = cells.flatten().to_numpy()
            owner = np.repeat(np.arange(len(cells)), pc.list_value_length(cells).to_numpy())
            keep = _held(bitmap, found)
            at = pa.array(owner[keep])
            yield pa.RecordBatch.from_pydict({
                "cell": pa.array(found[keep]), "node": batch.column("node").take(at),
                "n": batch.column("n").take(at),
            })

    return seen.select("node", "n", "cells").mapInArrow(run, "cell bigint, node binary, n bigint")


def _likely_texts(docs: DataFrame, lead: DataFrame) -> DataFrame:
    """(row_hash, row_check, text): all texts that are in ``lead``, and few others."""
    bitmap = _bitmap(lead, "row_hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_held(bitmap, batch.column("row_hash").to_numpy())))

    text = docs.select("row_hash", "row_check", F.col("text").cast("string"))
    return text.mapInArrow(run, "row_hash bigint, row_check bigint, text string")


def _segments(docs: DataFrame, words: int) -> DataFrame:
    """(node, fragment, held): the n-grams of every text, by fragment of the global order."""
    cuts = np.array([(f << 64) // FRAGMENTS for f in range(1, FRAGMENTS)], dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            nodes, fragments, parts = [], [], []
            for text in texts(batch, "text"):
                held = shingles(text, words)
                nodes += [_node(held)] * FRAGMENTS
                fragments += range(FRAGMENTS)
                parts += np.split(held, np.searchsorted(held, cuts))
            yield pa.RecordBatch.from_pydict({
                "node": pa.array(nodes, pa.binary()),
                "fragment": pa.array(fragments, pa.int32()), "held": _lists(parts),
            })

    return docs.mapInArrow(run, "node binary, fragment int, held array<bigint>")


def _read_again(pairs: DataFrame, docs: DataFrame, seen: DataFrame, words: int) -> DataFrame:
    """The segments of the sets in pairs, written; one text of each set is read again for it."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    once = seen.join(nodes, "node", "left_semi").groupBy("node").agg(
        F.min(F.struct("row_hash", "row_check")).alias("lead")
    ).select("lead.*")
    once = stage(once, "lead-texts")
    text = _likely_texts(docs, once).join(once, ["row_hash", "row_check"], "left_semi")
    text = text.groupBy("row_hash", "row_check").agg(F.first("text").alias("text"))
    return stage(_segments(text.select("text"), words), "segments")


def _met(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """The segments of both sets of every pair, by fragment.

    Both sides are dealt out by set and fragment, so one shuffle of the segments serves both joins.
    """
    one = segments.select(F.col("node").alias("a"), "fragment", F.col("held").alias("a_held"))
    two = segments.select(F.col("node").alias("b"), "fragment", F.col("held").alias("b_held"))
    each = pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))))
    return each.join(two, ["b", "fragment"]).join(one, ["a", "fragment"])


def _linked(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Links ``a``, ``b`` of those pairs (a, b, a_n, b_n: sets and their sizes) that hold enough in common."""
    common = F.size(F.array_intersect("a_held", "b_held")).alias("c")
    partial = _met(pairs, segments).select("a", "b", "a_n", "b_n", common)
    told = partial.groupBy("a", "b", "a_n", "b_n").agg(F.sum("c").alias("c"))
    return told.filter(100 * F.col("c") >= percent * (F.col("a_n") + F.col("b_n") - F.col("c"))).select("a", "b")


def _crowd(group: pa.Table, percent: int) -> pa.Table:
    """A spanning forest of the links between the sets of a tile, or of two tiles, of a pivot's followers."""
    names, who = np.unique(np.array(group.column("b").to_pylist(), dtype=object), return_inverse=True)
    size, root, tile = np.zeros(len(names), np.int64), np.zeros(len(names), object), np.zeros(len(names), int)
    size[who], tile[who] = group.column("b_n").to_numpy(), group.column("tile").to_numpy()
    root[who] = group.column("root").to_pylist()
    kin = np.unique(root, return_inverse=True)[1]
    held = group.column("apart").combine_chunks()
    owner = np.repeat(who, pc.list_value_length(held).to_numpy(zero_copy_only=False))
    gram, column, often = np.unique(held.values.to_numpy(), return_inverse=True, return_counts=True)
    mine = np.bincount(owner, minlength=len(names))
    # Only n-grams of two sets or more can be common to two.
    shared = often[column] > 1
    column, owner = np.unique(column[shared], return_inverse=True)[1], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    low = tile == tile.min()
    left, right = np.flatnonzero(low), np.flatnonzero(~low if not low.all() else low)
    both = np.zeros((len(left), len(right)), dtype=np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (start, start + COLUMNS))
        grid = np.zeros((len(names), COLUMNS), dtype=np.float32)
        grid[owner[a:b], column[a:b] - start] = 1
        both += grid[left] @ grid[right].T
    total = size[left, None] + size[None, right]
    common = (total - (mine[left, None] + mine[None, right] - 2 * both.astype(np.int64))) // 2
    good = (100 * common >= percent * (total - common)) & (kin[left, None] != kin[None, right])
    i, j = np.nonzero(good)
    label = labels(len(names), left[i], right[j])
    far = np.flatnonzero(label != np.arange(len(names)))
    return pa.table({
        "a": pa.array(names[label[far]].tolist(), pa.binary()), "b": pa.array(names[far].tolist(), pa.binary()),
    })


def _links_of_crowds(crowds: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Links between followers of one pivot (a, b, a_n, b_n, root: pivot, follower, sizes, its component)."""
    less, more = F.array_except("a_held", "b_held"), F.array_except("b_held", "a_held")
    apart = _met(crowds, segments).select("a", "b", "b_n", "root", F.concat(less, more).alias("apart"))
    apart = stage(apart, "differences")
    sizes = apart.groupBy("a").agg(F.count_distinct("b").alias("m"), F.sum(F.size("apart")).alias("grams"))
    tiles = F.greatest(F.ceil(F.col("m") / TILE), F.ceil(F.col("grams") / TILE_GRAMS)).cast("int")
    dealt = apart.join(sizes.filter("m > 1").select("a", tiles.alias("tiles")), "a")
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("b"), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select(
        "a", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"),
        "b", "b_n", "root", "tile", "apart",
    )
    return dealt.groupBy("a", "lo", "hi").applyInArrow(
        lambda group: _crowd(group, percent), "a binary, b binary"
    )


def links(docs: DataFrame, seen: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(node, root): the sets that hang together with a smaller one, by links of ``percent`` or more.

    ``docs`` has the columns of a row key and ``text``, ``seen`` its sets (``_sets``), written.
    """
    cells = seen.select(F.explode("cells").alias("cell"), "node", "n")
    short = F.xxhash64("node")
    shared = cells.groupBy("cell").agg(F.min(short).alias("lo"), F.max(short).alias("hi"))
    shared = stage(shared.filter("lo <> hi").select("cell"), "shared-cells")
    members = stage(_likely_cells(seen, shared).join(shared, "cell").distinct(), "cell-members")
    # The middle of a crowd meets most others; it is the pivot of all cells that it shares with them.
    many = members.groupBy("cell").agg(F.count(F.lit(1)).alias("many"))
    degree = members.join(many, "cell").groupBy("node").agg(F.sum("many").alias("degree"))
    ranked = members.join(stage(degree, "degrees"), "node")
    pivots = ranked.groupBy("cell").agg(F.max(F.struct("degree", "node", "n")).alias("p"))
    pivots = pivots.select("cell", F.col("p.node").alias("a"), F.col("p.n").alias("a_n"))
    follow = members.select("cell", F.col("node").alias("b"), F.col("n").alias("b_n")).join(pivots, "cell")
    follow = stage(follow.filter("a <> b"), "followers")
    pairs = stage(follow.select("a", "b", "a_n", "b_n").distinct(), "set-pairs")
    segments = _read_again(pairs, docs, seen, words)
    fit = 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")
    known = stage(_linked(pairs.filter(fit), segments, percent), "set-links")
    roots = components(known, "set-roots").withColumnRenamed("node", "b")
    # All have met the pivot of their cells. Only followers of a cell that are still apart go on.
    placed = follow.join(roots, "b", "left").withColumn("root", F.coalesce("root", "b"))
    placed = stage(placed, "placed-followers")
    apart = placed.groupBy("cell").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    crowds = placed.join(apart.filter("lo <> hi").select("cell"), "cell")
    crowds = stage(crowds.select("a", "b", "a_n", "b_n", "root").distinct(), "crowds")
    more = _links_of_crowds(crowds, segments, percent)
    known = stage(known.unionByName(more), "all-set-links")
    return components(known, "set-roots")


def similar_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """A row per row of ``docs``: ``doc_id``, ``n_shingles`` (bigint), ``component_id``.

    A text's set holds its distinct n-grams of ``words`` words (A-Z lower-cased, ASCII white space between
    them), or its whole sequence if that is shorter. Texts link when they share ``percent`` or more of the
    n-grams of both; ``component_id`` is the smallest identifier reachable by links, its own included.
    Null, empty and blank texts have an empty set and link with nothing, so their component is their own
    identifier. Null identifiers count last: a component has one only if it has no other. Repeated rows and
    rows that share an identifier stay rows of their own. Other columns are left out.

    N-grams are told apart by 64-bit hashes, sets by 128 bits. ``docs`` is read twice.
    """
    keyed = docs.select(*row_key(), F.col("text"))
    seen = stage(_sets(keyed, words, percent), "ngram-sets")
    roots = links(keyed, seen, words, percent)
    placed = seen.filter("n > 0").groupBy("node").agg(F.min("row_id").alias("least"))
    placed = placed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = stage(placed, "set-places")
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.select("node", "root").join(least, "root")
    told = seen.select("row_id", "n", "node").join(named.select("node", "component_id"), "node", "left")
    return told.select(
        F.col("row_id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("row_id")).alias("component_id"),
    )
