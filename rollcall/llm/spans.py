"""Substring dedup by sliding sentence spans.

Every run of a few consecutive pieces of sentences is hashed. Runs with the same hash, anywhere in the
corpus, are occurrences of one span; the first (by identifier, then by place) stays, and pieces covered by
any other occurrence go. From each piece starts one run, the shortest that has ``MIN_PIECES`` pieces and
``MIN_WORDS`` words, and at each piece ends one. A repeated passage is then covered from the first end of a
piece in it to the last one.

Sentences end at a line break and after a word that ends in one of ``STOPS``. Pieces end there too, and after
one word in ``PIECE`` picked by its hash alone: whether a passage is cut at some place depends on no word
outside it, wherever it starts and ends. Only where no word is picked is it cut after ``LONGEST`` words. In
scripts without spaces every code point is a word that counts half. Words are compared lower-cased, white
space does not count. Of a sentence that is not covered whole, stretches of fewer than ``FRAGMENT`` words stay.

The corpus is read in two passes. The first sends nothing but packed hashes of runs and tells which can be
repeated, as a bitmap of a fixed size. The second makes rows of those runs alone and compares 96 bits; a bit
set by chance costs a row, and loses nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import bitmap_of, blocks, code_points, output, row_key, texts
from rollcall.session import stage

MIN_PIECES, MIN_WORDS = 2, 12
PIECE, LONGEST, FRAGMENT = 4, 48, 4
# Bits of the bitmap, as a power of two; runs a task holds before it sends them; bytes of text of the corpus
# for each group of packed hashes.
BITS, HELD, GROUP = 26, 1 << 20, 16 << 20

# Characters that end a sentence, and scripts written without spaces.
STOPS = ".!?。！？｡．।॥"
DENSE = "฀-໿ༀ-࿿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿ｦ-ﾟ\U00020000-\U0003ffff"
SPACE, BREAK, ALONE, STOP = 1, 2, 4, 8

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_POWERS: dict[int, np.ndarray] = {}
ROW = ["row_id", "row_hash"]
_SCHEMA = "mark bigint, check int, row_id bigint, row_hash bigint, first int, last int"
# Bytes of text whose runs are found together.
BLOCK = 1 << 19


@cache
def _kinds() -> np.ndarray:
    """White space, line break, script without spaces and stop, by code point."""
    kind = np.zeros(0x110000, dtype=np.uint8)
    kind[[c for c in range(0x110000) if chr(c).isspace()]] = SPACE
    kind[10] |= BREAK
    for a, b in re.findall("(.)-(.)", DENSE):
        kind[ord(a) : ord(b) + 1] |= ALONE
    kind[[ord(c) for c in STOPS]] |= STOP
    return kind


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(factor: int, n: int) -> np.ndarray:
    """Powers of an odd number in 64 bits, from the zeroth on."""
    held = _POWERS.get(factor)
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), factor, dtype=np.uint64)
        held[0] = 1
        held = _POWERS[factor] = np.cumprod(held, dtype=np.uint64)
    return held[:n]


def _stretches(value: np.ndarray, a: np.ndarray, b: np.ndarray, odd: int) -> np.ndarray:
    """A hash of the values from each ``a`` to each ``b``, the same wherever they stand.

    Values times powers for their places are summed up; the inverse power takes the place out again.
    """
    total = np.zeros(len(value) + 1, dtype=np.uint64)
    np.cumsum(value * _powers(odd, len(value)), out=total[1:])
    return _mixed((total[b] - total[a]) * _powers(pow(odd, -1, 1 << 64), len(total))[a])


@dataclass
class Words:
    """The words of some texts, end to end."""

    start: np.ndarray  # in code points, as is the end
    value: np.ndarray  # hashes
    half: np.ndarray  # whether they count half
    stops: np.ndarray  # whether a sentence ends before each one, and after the last
    at: np.ndarray  # the first word of each text, with the end


def words(parts: list[str]) -> Words:
    flat, at = code_points(parts)
    kind = _kinds()[flat]
    ink, alone = (kind & SPACE) == 0, (kind & ALONE) > 0
    edge = np.zeros(len(flat) + 1, dtype=bool)
    edge[at] = True
    edge[1:-1] |= ~ink[1:] | ~ink[:-1] | alone[1:] | alone[:-1]
    start, end = np.flatnonzero(ink & edge[:-1]), np.flatnonzero(ink & edge[1:]) + 1
    first = np.searchsorted(start, at)
    stops = np.zeros(len(start) + 1, dtype=bool)
    stops[first] = True
    stops[np.searchsorted(start, np.flatnonzero(kind & BREAK))] = True
    stops[1:] |= (kind[end - 1] & STOP) > 0
    value = _stretches(flat.astype(np.uint64) + np.uint64(1), start, end, _ODD[2])
    return Words(start, value, alone[start], stops, first)


def picked(word: str) -> bool:
    """Whether a piece ends after a lower-cased word, by its hash."""
    return bool(_picked(words([word]).value)[0])


def _picked(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(7)) % np.uint64(PIECE) == 0


@dataclass
class Pieces:
    """The pieces of some texts, end to end: all places are those of words."""

    words: Words
    start: np.ndarray  # of each piece, with the end
    weight: np.ndarray  # of all words before each piece, in halves, with the end
    ends_sentence: np.ndarray  # whether each piece does
    of_text: np.ndarray  # the first piece of each text, with the end


def pieces(parts: list[str]) -> Pieces:
    """The pieces of texts that are lower-cased already."""
    found = words(parts)
    n = len(found.start)
    ends = found.stops.copy()
    ends[1:] |= _picked(found.value)
    # Words since the last end: where none is picked, every LONGEST-th ends a piece.
    place = np.arange(n + 1)
    since = place - np.maximum.accumulate(np.where(ends, place, 0))
    ends |= (since > 0) & (since % LONGEST == 0)
    end = np.flatnonzero(ends[1:]) + 1
    start = np.r_[0, end]
    weight = np.r_[0, np.cumsum(np.where(found.half, 1, 2))][start]
    return Pieces(found, start, weight, found.stops[end], np.searchsorted(start, found.at))


def runs(held: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last piece of every run, and two hashes of its words; no run is listed twice."""
    n = len(held.start) - 1
    owner = np.searchsorted(held.of_text, np.arange(n), side="right") - 1
    piece = np.arange(n)
    # The piece up to which a run from each one has enough words, and from which a run to each one has.
    stop = np.searchsorted(held.weight, held.weight[:-1] + 2 * MIN_WORDS)
    stop = np.maximum(stop, piece + MIN_PIECES)
    begin = np.searchsorted(held.weight, held.weight[1:] - 2 * MIN_WORDS, side="right") - 1
    begin = np.minimum(begin, piece + 1 - MIN_PIECES)
    on, back = stop <= held.of_text[owner + 1], begin >= held.of_text[owner]
    both = np.unique(np.r_[piece[on] * (n + 1) + stop[on], begin[back] * (n + 1) + piece[back] + 1])
    first, stop = both // (n + 1), both % (n + 1)
    a, b = held.start[first], held.start[stop]
    return first, stop - 1, *[_stretches(held.words.value, a, b, odd) for odd in _ODD[:2]]


def _lower(batch: pa.RecordBatch) -> list[str]:
    return [t.lower() for t in texts(batch, "text")]


def _split(mark: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """The range of a hash, and 32 more bits that tell it from others there."""
    return ((mark >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32), mark & np.uint64(0xFFFFFFFF)


def _bit(part: np.ndarray, code: np.ndarray, bits: int) -> np.ndarray:
    return _mixed((part << np.uint64(32)) | code) >> np.uint64(64 - bits)


def _perhaps_repeated(docs: DataFrame, ranges: int) -> DataFrame:
    """(at): bits of the runs that occur twice or more, and of some that only seem to."""
    bits, most = BITS, HELD

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        mark, count = np.unique(np.concatenate(held), return_counts=True)
        mark = np.sort(np.r_[mark, mark[count > 1]])  # twice is enough
        part, code = _split(mark, ranges)
        cuts = np.searchsorted(part, np.arange(ranges + 1, dtype=np.uint64))
        code = code.astype("<u4")
        full = np.flatnonzero(np.diff(cuts))
        return pa.RecordBatch.from_pydict({
            "part": pa.array(full.astype(np.int32)),
            "codes": pa.array([code[cuts[k] : cuts[k + 1]].tobytes() for k in full], pa.binary()),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in blocks(batches, "text", BLOCK):
            held.append(runs(pieces(_lower(batch)))[2])
            size += len(held[-1])
            if size >= most:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    def twice(key: tuple, group: pa.Table) -> pa.Table:
        code = np.sort(np.frombuffer(b"".join(group.column("codes").to_pylist()), dtype="<u4"))
        found = np.unique(code[1:][code[1:] == code[:-1]]).astype(np.uint64)
        part = np.full(len(found), key[0].as_py(), dtype=np.uint64)
        return pa.table({"at": pa.array(_bit(part, found, bits).astype(np.int64))})

    sent = docs.select("text").mapInArrow(run, "part int, codes binary")
    return sent.groupBy("part").applyInArrow(twice, "at bigint")


def _spans(docs: DataFrame) -> DataFrame:
    """Every run of every row of (row key, text) that is perhaps repeated."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(tasks, -(-total // GROUP))
    bits = BITS
    again = bitmap_of(_perhaps_repeated(docs, ranges), bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = again.value.view(np.uint64)
        for batch in blocks(batches, "text", BLOCK):
            held = pieces(_lower(batch))
            first, last, mark, check = runs(held)
            at = _bit(*_split(mark, ranges), bits)
            kept = np.flatnonzero((bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1))
            first, last = first[kept], last[kept]
            row = np.searchsorted(held.of_text, first, side="right") - 1
            which = pa.array(row)
            yield pa.RecordBatch.from_pydict({
                "mark": pa.array(mark[kept].view(np.int64)), "check": pa.array((check[kept] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                **{c: batch.column(c).take(which) for c in ROW},
                "first": pa.array((first - held.of_text[row]).astype(np.int32)),
                "last": pa.array((last - held.of_text[row]).astype(np.int32)),
            })

    return docs.mapInArrow(run, _SCHEMA)


def repeated(docs: DataFrame) -> DataFrame:
    """Row key and ``cover``: array of (first, last) pieces of each row's non-first spans.

    Rows without one do not appear; the copies of a row share one line.
    """
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    spans = _spans(keyed.select(*row_key()[:2], F.col("text")))
    # Of two runs that start at one piece only one has a given hash.
    place = F.struct(F.col("row_id").isNull().alias("none"), *ROW, "first")
    firsts = spans.groupBy("mark", "check").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("lead"))
    # Only repeated spans, written: a join of two plain exchanges lets Spark split a frequent span.
    firsts = stage(firsts.filter("n > 1").select("mark", "check", "lead"), "repeated-spans")
    later = spans.join(firsts, ["mark", "check"]).filter(F.col("lead") != place)
    return later.groupBy(*ROW).agg(F.collect_set(F.struct("first", "last")).alias("cover"))


def remove_repeated(docs: DataFrame) -> DataFrame:
    """Every row with the pieces of its non-first spans cut out of ``text``; adds ``n_removed``.

    ``n_removed`` counts the sentences that are gone whole. What follows a piece up to the next one goes
    with it; all else stays as it is. Null texts stay
    null, empty and blank ones as they are. The first copy of a row keeps its spans and so do rows equal
    to it in identifier and text. A column ``n_removed`` is replaced. Identifiers are numbers, or texts that
    are one: others stop the job. ``docs`` is read several times: give it a table.
    """
    names = [c for c in docs.columns if c != "n_removed"]
    docs = docs.select(*names)
    cover = repeated(docs)
    rest = [F.col(c) for c in names if c != "text"]
    rows = docs.select(F.struct(*rest).alias("row"), "text", *row_key()[:2])
    rows = rows.withColumn("row_id", F.col("row_id").cast("bigint"))
    same = rows["row_id"].eqNullSafe(cover["row_id"]) & (rows["row_hash"] == cover["row_hash"])
    met = rows.join(cover, same, "left").select("row", "text", "cover.first", "cover.last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            hit = np.flatnonzero(pc.fill_null(pc.list_value_length(batch.column("first")), 0))
            gone = np.zeros(batch.num_rows, dtype=np.int64)
            if len(hit):
                column = batch.column("text").to_pylist()
                for k in hit.tolist():
                    spans = [batch.column(c)[k].values.to_numpy() for c in ("first", "last")]
                    column[k], gone[k] = _without(column[k], *spans)
                text = pa.array(column, pa.string())
            else:
                text = batch.column("text")
            yield output(batch, ("first", "last"), text=text, n_removed=pa.array(gone))

    schema = T.StructType([
        met.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_removed", T.LongType()),
    ])
    cut = met.mapInArrow(run, schema)
    columns = [F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in names]
    return cut.select(*columns, "n_removed")


def _without(text: str, first: np.ndarray, last: np.ndarray) -> tuple[str, int]:
    """The text without the pieces of these spans, and how many sentences are gone whole."""
    held = pieces([text.lower()])
    n = len(held.start) - 1
    mark = np.zeros(n + 1, dtype=np.int64)
    np.add.at(mark, first, 1)
    np.add.at(mark, last + 1, -1)
    covered = np.cumsum(mark)[:-1] > 0
    sentence = np.cumsum(np.r_[0, held.ends_sentence[:-1]])
    # Stretches of a few words in a sentence of which others stay are the same by chance.
    size = np.diff(held.weight)
    stretch = np.cumsum(np.r_[0, (np.diff(sentence) != 0) | np.diff(covered)])
    run, whole = np.bincount(stretch, size)[stretch], np.bincount(sentence, size)[sentence]
    covered &= (run == whole) | (run >= 2 * FRAGMENT)
    left = np.bincount(sentence, ~covered, int(sentence[-1]) + 1)
    # Lower-casing can make a text longer, and makes neither words nor gaps.
    bounds = np.r_[words([text]).start[held.start[:-1]], len(text)]
    edge = np.flatnonzero(np.diff(np.r_[True, covered, True].astype(np.int8)))
    parts = [text[: bounds[0]]]
    parts += [text[bounds[a] : bounds[b]] for a, b in zip(edge[::2], edge[1::2])]
    return "".join(parts), int((left == 0).sum())
