"""SimHash near-duplicates: fingerprints, and a binary-trie self-join under a Hamming budget.

Distinct fingerprints form a binary trie, one bit per level. Two of its nodes can hold a linked pair only
if the bits on the way to them differ at most ``budget`` times, so the join walks pairs of nodes: it
starts at the root with itself, adds up differing bits and drops a pair once the budget is spent.

The upper trie is cut into leaves of bounded size, deeper where fingerprints are dense; its nodes and the
pairs of nodes are tables, and the walk goes down by joins. Pairs of leaves within the budget are Spark's
groups; inside a group the walk goes on over sorted arrays, and small nodes are compared at once. A group returns a spanning forest of its links,
never all pairs, so a crowd of near copies yields as many rows as it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import KEY, LOWER, UPPER, blocks, output, row_key, texts
from rollcall.llm.components import components
from rollcall.session import stage

WORDS, BUDGET, SEED = 4, 4, 42
# Distinct fingerprints a leaf of the upper trie holds at most, and how many levels one step goes down.
NODE_SIZE, STEP = 1 << 16, 4
PAIR = ("a_depth", "a", "b_depth", "b")
# Comparisons at which two nodes are compared outright.
LEAF = 1 << 16

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint(text: str, words: int = WORDS) -> int:
    """SimHash of the shingles of a text, as a signed 64-bit number; 0 without words."""
    found = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    width = min(words, len(found))
    digest = xxhash.xxh64_digest
    hashes = b"".join([
        digest(joined[a:b], SEED)
        for a, b in zip(starts[: len(found) - width + 1].tolist(), ends[width - 1 :].tolist())
    ])
    count, n = np.zeros(64, dtype=np.int64), len(hashes) // 8
    each = np.frombuffer(hashes, dtype=np.uint8).reshape(n, 8)
    for a in range(0, n, 1 << 15):
        count += np.unpackbits(each[a : a + (1 << 15)], axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * count > n)
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Adds ``fingerprint`` (bigint), and leaves out the text."""
    docs = docs.select(*[c for c in docs.columns if c != "fingerprint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            marks = [fingerprint(t, words) for t in texts(batch, "text")]
            yield output(batch, ("text",), fingerprint=pa.array(marks, pa.int64()))

    fields = [f for f in docs.schema.fields if f.name != "text"]
    return docs.mapInArrow(run, T.StructType([*fields, T.StructField("fingerprint", T.LongType())]))


def levels(marks: DataFrame, limit: int) -> list[DataFrame]:
    """The nodes (parent, prefix, leaf) of the upper trie, level by level, ``STEP`` bits apart, written.

    A node of ``limit`` marks or fewer is a leaf of it; only the others have nodes below.
    """
    found: list[DataFrame] = []
    while not found or found[-1].filter("NOT leaf").take(1):
        depth = STEP * (len(found) + 1)
        rows = marks.select(F.shiftrightunsigned("fingerprint", 64 - depth).alias("prefix"))
        rows = rows.select(F.shiftright("prefix", STEP).alias("parent"), "prefix")
        if found:
            above = found[-1].filter("NOT leaf").select(F.col("prefix").alias("parent"))
            rows = rows.join(above, "parent", "left_semi")
        leaf = (F.count(F.lit(1)) <= limit) | F.lit(depth >= 60)
        found.append(stage(rows.groupBy("parent", "prefix").agg(leaf.alias("leaf")), "trie-nodes"))
    return found


def _below(pairs: DataFrame, side: str, nodes: DataFrame, depth: int) -> DataFrame:
    """The pairs with the nodes below in place of one side's node, where it is no leaf."""
    leaf = f"{side}_leaf"
    kids = nodes.select("parent", F.col("prefix").alias("kid"), F.col("leaf").alias("kid_leaf"))
    down = pairs.filter(~F.col(leaf)).join(kids, F.col(side) == F.col("parent"))
    down = down.withColumns({side: F.col("kid"), leaf: F.col("kid_leaf"), f"{side}_depth": F.lit(depth)})
    return pairs.filter(leaf).unionByName(down.drop("parent", "kid", "kid_leaf"))


def node_pairs(tree: list[DataFrame], budget: int) -> DataFrame:
    """Pairs of leaves of the upper trie whose common bits differ ``budget`` times at most.

    The walk begins with the root and itself and goes down both sides level by level, by joins on the
    parent; a side that is a leaf stays, and then no more bits are common.
    """
    spark = tree[0].sparkSession
    pairs = spark.range(1).select(
        *[F.lit(x).cast(t).alias(f"{s}{n}") for s in "ab" for n, x, t in (
            ("", 0, "bigint"), ("_leaf", False, "boolean"), ("_depth", 0, "int"))],
        F.lit(0).alias("level"), F.lit(0).alias("errors"),
    )
    done = []
    for n, nodes in enumerate(tree, 1):
        depth = STEP * n
        met = pairs.withColumns({
            "met": ~F.col("a_leaf") & ~F.col("b_leaf"),
            "same": (F.col("a") == F.col("b")) & (F.col("a_depth") == F.col("b_depth")),
        })
        moved = _below(_below(met, "a", nodes, depth), "b", nodes, depth)
        more = F.bit_count(F.col("a").bitwiseXOR(F.col("b")).bitwiseAND((1 << STEP) - 1))
        moved = moved.withColumns({
            "errors": F.when(F.col("met"), F.col("errors") + more).otherwise(F.col("errors")).cast("int"),
            "level": F.when(F.col("met"), F.lit(depth)).otherwise(F.col("level")),
        })
        # Below one node both orders of a pair come up: one is enough.
        moved = moved.filter(f"errors <= {budget} AND (NOT same OR a <= b)").drop("met", "same")
        moved = stage(moved, "node-pairs")
        done.append(moved.filter("a_leaf AND b_leaf"))
        pairs = moved.filter("NOT (a_leaf AND b_leaf)")
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    return every.drop("a_leaf", "b_leaf")


class _Walk:
    """The walk below one pair of leaves; ``label`` holds the forest."""

    def __init__(self, left: np.ndarray, right: np.ndarray | None, budget: int) -> None:
        self.budget = budget
        both = left if right is None else np.concatenate([left, right])
        self.marks, self.split = both, len(left)
        self.label = np.arange(len(both))
        self.children: dict[tuple[int, int, int], int] = {}

    def halves(self, node: tuple[int, int], depth: int) -> list[tuple[int, int] | None]:
        """The node's two children, None where there are no marks."""
        lo, hi = node
        at = self.children.get((lo, hi, depth))
        if at is None:
            bit = (self.marks[lo:hi] >> np.uint64(63 - depth)) & np.uint64(1)
            at = self.children[(lo, hi, depth)] = lo + int(np.searchsorted(bit, 1))
        return [(lo, at) if at > lo else None, (at, hi) if hi > at else None]

    def run(self, a: tuple[int, int], b: tuple[int, int], depth: int, errors: int) -> None:
        todo = [(a, b, depth, errors)]
        while todo:
            a, b, depth, errors = todo.pop()
            if depth == 64 or (a[1] - a[0]) * (b[1] - b[0]) <= LEAF:
                self.compare(a, b)
                continue
            mine, theirs = self.halves(a, depth), self.halves(b, depth)
            for x in (0, 1):
                for y in (0, 1):
                    if a == b and x > y or mine[x] is None or theirs[y] is None:
                        continue
                    if (spent := errors + (x != y)) <= self.budget:
                        todo.append((mine[x], theirs[y], depth + 1, spent))

    def compare(self, a: tuple[int, int], b: tuple[int, int]) -> None:
        one, two = self.label[a[0] : a[1]], self.label[b[0] : b[1]]
        if (one == one[0]).all() and (two == one[0]).all():
            return  # all connected already
        step = max(1, (1 << 20) // (b[1] - b[0]))
        for lo in range(a[0], a[1], step):
            hi = min(a[1], lo + step)
            apart = np.bitwise_count(self.marks[lo:hi, None] ^ self.marks[None, b[0] : b[1]])
            i, j = np.nonzero(apart <= self.budget)
            self.join(i + lo, j + b[0])

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            p, q = label[i], label[j]
            differ = p != q
            if not differ.any():
                return
            i, j, p, q = i[differ], j[differ], p[differ], q[differ]
            np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up


def links(marks: DataFrame, budget: int = BUDGET, node_size: int = NODE_SIZE) -> DataFrame:
    """Links ``a``, ``b`` that connect all marks within ``budget`` bits of each other.

    ``marks`` holds distinct values in ``fingerprint``. The links are a forest for every pair of
    leaves: two marks hang together by them exactly if a chain of near pairs joins them.
    """
    spark = marks.sparkSession
    tree = levels(marks, node_size)
    pairs = node_pairs(tree, budget)
    same = (F.col("a") == F.col("b")) & (F.col("a_depth") == F.col("b_depth"))
    sides = [
        side.select(
            F.col(f"{s}_depth").alias("depth"), F.col(s).alias("prefix"), F.struct(*PAIR).alias("pair"),
            F.lit(n).alias("side"), "level", "errors",
        )
        for n, (s, side) in enumerate((("a", pairs), ("b", pairs.filter(~same))))
    ]
    ways = F.explode(F.array(*[
        F.struct(
            F.lit(d).alias("depth"),
            F.shiftrightunsigned("fingerprint", 64 - d).alias("prefix"),
        )
        for d in range(STEP, STEP * len(tree) + 1, STEP)
    ]))
    sent = marks.select("fingerprint", ways.alias("w")).select("fingerprint", "w.*")
    sent = sent.join(sides[0].unionByName(sides[1]), ["depth", "prefix"]).drop("depth", "prefix")
    # Groups are small in bytes and long in work: a number of tasks that is not merged by size.
    tasks = max(1, min(pairs.count(), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    sent = sent.repartition(tasks, "pair")

    def walk(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        marks = group.column("fingerprint").to_numpy().view(np.uint64)
        left, right = np.sort(marks[side == 0]), np.sort(marks[side == 1])
        level, errors = group.column("level")[0].as_py(), group.column("errors")[0].as_py()
        if len(right) == 0:
            held = _Walk(left, None, budget)
            held.run((0, len(left)), (0, len(left)), level, 0)
        else:
            held = _Walk(left, right, budget)
            held.run((0, len(left)), (len(left), len(held.marks)), level, errors)
        far = np.flatnonzero(held.label != np.arange(len(held.label)))
        as_signed = held.marks.view(np.int64)
        return pa.table({"a": as_signed[far], "b": as_signed[held.label[far]]})

    return sent.groupBy("pair").applyInArrow(walk, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, words: int = WORDS, budget: int = BUDGET, node_size: int = NODE_SIZE
) -> DataFrame:
    """A row per row of ``docs``: its row key, ``fingerprint`` (bigint), ``component_id``, ``first``.

    Texts are linked when their fingerprints differ in ``budget`` bits at most; ``component_id`` is the
    smallest identifier reachable. ``first`` marks one row key of each component: the smallest
    identifier, null last, then the smallest hashes. Texts without words share fingerprint zero and are
    linked like any others; null texts count as empty. Copies of a row share all values.
    """
    keyed = docs.select(*row_key(), F.col("text"))
    seen = stage(with_fingerprint(keyed, words), "fingerprints")
    key = F.struct(F.col("row_id").isNull().alias("none"), *KEY)
    marks = stage(
        seen.groupBy("fingerprint").agg(F.min("row_id").alias("least"), F.min(key).alias("lead")),
        "marks",
    )
    near = links(marks.select("fingerprint"), budget, node_size)
    roots = components(near, "simhash-links")
    placed = marks.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    placed = stage(placed.withColumn("root", F.coalesce("root", "fingerprint")), "simhash-roots")
    least = placed.groupBy("root").agg(
        F.min("least").alias("component_id"), F.min("lead").alias("lead")
    )
    named = placed.select("fingerprint", "root").join(least, "root")
    told = seen.join(named.select("fingerprint", "component_id", "lead"), "fingerprint")
    return told.withColumn("first", F.col("lead") == key).select(
        *KEY, "fingerprint", "component_id", "first"
    )


def keep_one(docs: DataFrame, words: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one row of each component stays."""
    told = near_duplicates(docs, words, budget)
    first = told.filter("first").select(*KEY).distinct()
    first = first.withColumnRenamed("row_id", "kept_id")
    names = docs.columns
    keyed = docs.select(F.struct(*names).alias("row"), *row_key())
    met = keyed.join(
        first,
        (keyed["row_hash"] == first["row_hash"]) & (keyed["row_check"] == first["row_check"])
        & keyed["row_id"].eqNullSafe(first["kept_id"]),
        "left_semi",
    )
    return met.dropDuplicates(list(KEY)).select("row.*")
