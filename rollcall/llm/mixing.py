"""Mixing sources to target weights: random order by hash, distributed prefix sums, exact cuts.

Every document gets a random key by hash. Within its source, documents are range-sorted by key: the
leading bits of a uniform key are ranges of equal size, so no sampling is needed, and their number grows
with the largest source. Sizes are summed by range, prefix sums over ranges are taken in two levels, and
a window inside each range gives every document the words before it. A source whose target is over its
size is taken whole as many times as fit; one more pass is cut where the rest of its budget ends.

Everything runs as DataFrame operations; no window holds more than some thousand rows but those over
the list of sources and over ranges of ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import WORD, row_key, whole
from rollcall.session import stage

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
SEED = 2024
# Documents in a range on average, and ranges whose sums are added up together.
RANGE_ROWS, RANGES = 2048, 4096


def targets(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target, n_rows) from (source, size).

    Sources take the weights in order of their code points, null last, over and over. Together they
    get ``share`` of all sizes, each at most ``most`` times its own size; what one cannot take goes to the
    others by weight. So a target is min(most x size, level x weight) for one common level. With sources
    sorted by size per weight, filling the first ones up leaves a level for the rest; it rises for as
    long as the next one cannot take its part and falls from then on, so the highest is the one.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("most", F.lit(float(most)) * F.col("source_size"))
    by_fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    below = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    full = F.coalesce(F.sum("most").over(below), F.lit(0.0))
    left = F.lit(float(share)) * F.sum("source_size").over(everything) - full
    per = per.withColumn("try", left / F.sum("weight").over(onward))
    level = F.max("try").over(everything)
    target = F.least(F.col("most"), level * F.col("weight"))
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(target)
    return per.select("source", "source_size", target.alias("target"), "n_rows")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = SEED,
    keep_row: bool = False,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row, ``taken`` in words.

    Nothing depends on chance: the order is that of a hash of identifier and text with ``seed``, then of
    the row key. Null texts and texts without words have size 0; a null source is one of its own.
    Copies of a row are rows of their own; they share a key, so which of them a cut meets makes no
    difference. ``keep_row`` adds the input row as the struct ``row``.
    """
    row = [F.struct(*docs.columns).alias("row")] if keep_row else []
    size = F.regexp_count(whole(), F.lit(WORD)).cast("bigint")
    sized = docs.select(*row_key(), F.col("source"), size.alias("size"), *row)
    key = F.xxhash64(F.lit(seed), "row_id", "row_hash", "row_check")
    sized = sized.withColumn("key", F.shiftrightunsigned(key, 1))  # 63 bits, never negative
    sized = stage(sized, "sized")
    goals = stage(targets(sized, weights, share, most), "targets")
    largest = goals.agg(F.max("n_rows")).first()[0] or 0
    bits = max(0, -(-largest // RANGE_ROWS) - 1).bit_length()
    part = F.shiftright("key", 63 - bits)
    dealt = sized.withColumn("range", part)

    sums = dealt.groupBy("source", "range").agg(F.sum("size").alias("sum"))
    sums = sums.withColumn("upper", F.floor(F.col("range") / RANGES))
    upper = sums.groupBy("source", "upper").agg(F.sum("sum").alias("upper_sum"))
    above = Window.partitionBy("source").orderBy("upper").rowsBetween(Window.unboundedPreceding, -1)
    upper = upper.select("source", "upper", F.coalesce(F.sum("upper_sum").over(above), F.lit(0)).alias("base"))
    inner = Window.partitionBy("source", "upper").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sums = sums.withColumn("within", F.coalesce(F.sum("sum").over(inner), F.lit(0)))
    offsets = _join_source(sums, upper, "upper").select(
        "source", "range", (F.col("base") + F.col("within")).alias("offset")
    )

    before = Window.partitionBy("source", "range").orderBy("key", "row_id", "row_hash", "row_check")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    placed = _join_source(placed, offsets, "range")
    placed = _join_source(placed, goals.drop("n_rows"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.round(F.col("target") - passes * F.col("source_size")).cast("bigint")
    once_more = F.greatest(F.lit(0), F.least("size", rest - F.col("before") - F.col("offset")))
    taken = (passes * F.col("size") + once_more).cast("bigint")
    return placed.select(
        F.col("row_id").alias("doc_id"), "source", "size", "source_size", "target",
        taken.alias("taken"), *(["row"] if keep_row else []),
    )


def _join_source(left: DataFrame, right: DataFrame, *more: str) -> DataFrame:
    """Inner join on the source, null meeting null, and on further columns."""
    renamed = right
    for c in ("source", *more):
        renamed = renamed.withColumnRenamed(c, f"{c}_there")
    on = left["source"].eqNullSafe(renamed["source_there"])
    for c in more:
        on = on & (left[c] == renamed[f"{c}_there"])
    return left.join(renamed, on).drop(*[f"{c}_there" for c in ("source", *more)])


def take(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: rows of ``docs``, whole as often as taken, and cut where a budget ends.

    A row of which the mix takes a part of a pass comes once more with that many words of its text.
    Rows without words take no place in a mix and are left out, as are rows it takes nothing of.
    """
    names = docs.columns
    mixed = mix(docs, keep_row=True, **settings).filter("taken > 0")
    passes = F.floor(F.col("taken") / F.col("size")).cast("int")
    part = (F.col("taken") % F.col("size")).cast("bigint")
    copies = F.concat(
        F.array_repeat(F.lit(-1).cast("bigint"), passes), F.when(part > 0, F.array(part)).otherwise(
            F.array().cast("array<bigint>"))
    )
    made = mixed.select("row", F.explode(copies).alias("words"))
    # Pieces end where words do, so a text's first pieces are its first words as they stand.
    pieces = F.split("row.text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", -1)
    cut = F.array_join(F.slice(pieces, 1, F.greatest(F.lit(0), F.col("words")).cast("int")), "")
    text = F.when(F.col("words") < 0, F.col("row.text")).otherwise(cut)
    return made.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in names])
