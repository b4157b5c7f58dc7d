"""Phrase collocation mining by best-first branch-and-bound growth.

Phrases grow word by word. A prefix of ``c`` occurrences whose first word occurs ``f`` times bounds all that
grows from it: a phrase occurs at most ``c`` times, what stands behind its first word at least as often as
the phrase itself, so no score exceeds ``c / f``. The pairs of words are a language's frontier, each with the
larger of its own score and that bound.

The best of the frontier is grown first: all of it down to a threshold, each round in one pass over the
corpus that counts only phrases with a prefix (or, for what can drop a pair, a suffix) in the open frontier.
A language is settled once its ``top``-th surviving score reaches the threshold: nothing unopened can score
as much. Else its threshold falls, at last to nothing.

Words are counted first. Pairs are counted twice: all of them as packed hashes, which tells what can be frequent
enough, and then those alone, exactly. What can be frequent is held in bitmaps of a fixed size: a bit set by
chance costs a count, and loses nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import LOWER, UPPER, bitmap_of, blocks, texts
from rollcall.session import stage

LEAST, TOP, SHARE, UNKNOWN = 10, 2000, 50, "und"
SCALE = 1_000_000
# Pairs of words opened in a language at first, as times ``top``, and how many times more in each round.
OPEN, WIDER = 4, 16
# Bits of a bitmap, as a power of two; words counted together in a task before they are handed on; words of
# the corpus for each group of packed hashes.
BITS, HELD, GROUP = 25, 1 << 20, 1 << 20

# Characters that end a piece, A-Z lower-cased, tabs as spaces.
_CLEAN = bytes(
    10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256)
).translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))
_BREAK, _SKIP = 1, 0  # in place of a word's hash
_KNOWN: dict[bytes, int] = {}
MOST_KNOWN = 1 << 19


def word_hash(word: bytes, seed: int = 42) -> int:
    """The hash by which Spark's ``xxhash64`` knows the word too, as an unsigned number."""
    return xxhash.xxh64_intdigest(word, seed)


def words_of(text: str) -> list[bytes]:
    """The words of a text in order, with a line break where a piece ends; some are empty."""
    data = text.encode("utf-8", "surrogatepass").translate(_CLEAN)
    return data.replace(b"\n", b" \n ").split(b" ")


def _hashes(text: str) -> np.ndarray:
    """The hashes of a text's words, ``_BREAK`` between pieces."""
    found = words_of(text)
    new = set(found).difference(_KNOWN)
    if len(_KNOWN) + len(new) > MOST_KNOWN:
        _KNOWN.clear()
        new = set(found)
    _KNOWN.update((w, word_hash(w)) for w in new)
    _KNOWN[b""], _KNOWN[b"\n"] = _SKIP, _BREAK
    each = np.fromiter(map(_KNOWN.__getitem__, found), np.uint64, len(found))
    return each[each != _SKIP]


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str]]]:
    held: dict[str, list[str]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), texts(batch, "text")):
        held.setdefault(UNKNOWN if lang is None else lang, []).append(text)
    yield from held.items()


def _place(*parts: np.ndarray, lang: str, bits: int) -> np.ndarray:
    """Where phrases stand in a bitmap."""
    x = np.repeat(np.array([xxhash.xxh64_intdigest(lang, 7)], dtype=np.uint64), len(parts[0]))
    for part in parts:
        x = (x ^ part) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    return x >> np.uint64(64 - bits)


class _Counts:
    """Phrases of one task, counted by language and handed on, packed by range, when many words are held."""

    def __init__(self, edges: np.ndarray) -> None:
        self.edges = edges
        self.held: dict[str, list[np.ndarray]] = {}
        self.size = 0

    def add(self, lang: str, phrases: np.ndarray) -> None:
        if len(phrases):
            self.held.setdefault(lang, []).append(phrases)
            self.size += len(phrases)

    def hand_on(self) -> Iterator[pa.RecordBatch]:
        for lang, parts in self.held.items():
            rows, count = _summed(np.concatenate(parts), None)
            place = _place(*rows.T, lang=lang, bits=64)
            order = np.argsort(place)
            rows, count = rows[order], count[order].astype(np.int64)
            cuts = [0, *np.searchsorted(place[order], self.edges).tolist(), len(order)]
            full = [k for k in range(len(cuts) - 1) if cuts[k + 1] > cuts[k]]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(full), pa.string()), "range": pa.array(full, pa.int32()),
                "rows": pa.array([rows[cuts[k] : cuts[k + 1]].tobytes() for k in full], pa.binary()),
                "counts": pa.array([count[cuts[k] : cuts[k + 1]].tobytes() for k in full], pa.binary()),
            })
        self.held, self.size = {}, 0


def _summed(rows: np.ndarray, count: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Each row once, and the sum of its counts."""
    order = np.lexsort(rows.T)
    rows = rows[order]
    first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)])
    if count is None:
        return rows[first], np.diff(np.r_[first, len(rows)])
    return rows[first], np.add.reduceat(count[order], first)


def _ranges(docs: DataFrame, words: int) -> np.ndarray:
    """Where ranges of hashes begin, but for the first: as many as a corpus of so many words needs."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(tasks, -(-words // GROUP))
    return np.array([(k << 64) // ranges for k in range(1, ranges)], dtype=np.uint64)


def _counted(docs: DataFrame, width: int, wanted, least: int, edges: np.ndarray) -> DataFrame:
    """(lang, w0, .., c): phrases of ``width`` words that occur ``least`` times or more.

    ``wanted(lang, words in order)`` tells which are counted. Tasks send packed counts, which meet by
    range of a hash.
    """
    most = HELD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(edges)
        for batch in blocks(batches, "text"):
            for lang, parts in _by_language(batch):
                cut = _cut(lang, parts, width)
                keep = np.flatnonzero(wanted(lang, cut))
                counts.add(lang, np.stack([x[keep] for x in cut], axis=1))
            if counts.size >= most:
                yield from counts.hand_on()
        yield from counts.hand_on()

    def total(key: tuple, group: pa.Table) -> pa.Table:
        rows = np.frombuffer(b"".join(group.column("rows").to_pylist()), dtype=np.uint64).reshape(-1, width)
        rows, count = _summed(rows, np.frombuffer(b"".join(group.column("counts").to_pylist()), dtype=np.int64))
        often = count >= least
        return pa.table({
            "lang": pa.array([key[0].as_py()] * int(often.sum()), pa.string()),
            **{f"w{k}": pa.array(rows[often, k].view(np.int64)) for k in range(width)},
            "c": pa.array(count[often]),
        })

    columns = ", ".join(f"w{k} bigint" for k in range(width))
    sent = docs.mapInArrow(run, "lang string, range int, rows binary, counts binary")
    return sent.groupBy("lang", "range").applyInArrow(total, f"lang string, {columns}, c bigint")


def _cut(lang: str, parts: list[str], width: int) -> list[np.ndarray]:
    """Every phrase of ``width`` words within a piece: its first words, its second ones, and so on."""
    each = np.concatenate([x for t in parts for x in (_hashes(t), [np.uint64(_BREAK)])])
    ends = max(0, len(each) - width + 1)
    cut = [each[k : ends + k] for k in range(width)]
    good = np.flatnonzero(np.logical_and.reduce([x != _BREAK for x in cut]))
    return [x[good] for x in cut]


def _frequent_codes(docs: DataFrame, wanted, least: int, edges: np.ndarray) -> DataFrame:
    """(at): hashes of pairs of words that are ``least`` in number, as far as hashes can tell.

    A task sends its distinct hashes, packed by range and with counts up to ``least``, so a pair takes
    about nine bytes; the hashes of one range meet in one group.
    """
    most = HELD

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        code, count = np.unique(np.concatenate(held), return_counts=True)
        count = np.minimum(count, least).astype(np.int32)
        cuts = [0, *np.searchsorted(code, edges).tolist(), len(code)]
        full = [k for k in range(len(cuts) - 1) if cuts[k + 1] > cuts[k]]
        return pa.RecordBatch.from_pydict({
            "range": pa.array(full, pa.int32()),
            "codes": pa.array([code[cuts[k] : cuts[k + 1]].tobytes() for k in full], pa.binary()),
            "counts": pa.array([count[cuts[k] : cuts[k + 1]].tobytes() for k in full], pa.binary()),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in blocks(batches, "text"):
            for lang, parts in _by_language(batch):
                cut = _cut(lang, parts, 2)
                keep = np.flatnonzero(wanted(lang, cut))
                held.append(_place(*[x[keep] for x in cut], lang=lang, bits=64))
                size += len(keep)
            if size >= most:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    def summed(group: pa.Table) -> pa.Table:
        code = np.frombuffer(b"".join(group.column("codes").to_pylist()), dtype=np.uint64)
        count = np.frombuffer(b"".join(group.column("counts").to_pylist()), dtype=np.int32)
        order = np.argsort(code)
        code, count = code[order], count[order]
        first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        often = np.add.reduceat(count.astype(np.int64), first) >= least
        return pa.table({"at": pa.array(code[first[often]].view(np.int64))})

    sent = docs.mapInArrow(run, "range int, codes binary, counts binary")
    return sent.groupBy("range").applyInArrow(summed, "at bigint")


def _word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, c) of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        size = 0

        def hand_on() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(counts), pa.string()),
                    "word": pa.array(list(counts), pa.binary()).cast(pa.string()),
                    "c": pa.array(list(counts.values()), pa.int64()),
                })

        for batch in blocks(batches, "text"):
            for lang, parts in _by_language(batch):
                counts = held.setdefault(lang, Counter())
                before = len(counts)
                for text in parts:
                    counts.update(words_of(text))
                counts.pop(b"", None)
                counts.pop(b"\n", None)
                size += len(counts) - before
            if size >= HELD // 4:
                yield from hand_on()
                held, size = {}, 0
        yield from hand_on()

    found = docs.mapInArrow(run, "lang string, word string, c bigint")
    return found.groupBy("lang", "word").agg(F.sum("c").alias("c"))


def _bitmap(phrases: DataFrame, names: list[str]) -> Broadcast:
    """A bitmap of the phrases' places, of ``2 ** BITS`` bits however many they are."""
    size = BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list[int]] = {}
            for n, lang in enumerate(batch.column("lang").to_pylist()):
                held.setdefault(lang, []).append(n)
            for lang, rows in held.items():
                parts = [batch.column(c).to_numpy().view(np.uint64)[rows] for c in names]
                at = np.unique(_place(*parts, lang=lang, bits=size).astype(np.int64))
                yield pa.RecordBatch.from_pydict({"at": pa.array(at)})

    return bitmap_of(phrases.select("lang", *names).mapInArrow(run, "at bigint"), size)


def _held(bitmap: Broadcast, lang: str, *parts: np.ndarray) -> np.ndarray:
    """Whether the bitmap has the phrases, made of these words in order."""
    bits = bitmap.value.view(np.uint64)
    at = _place(*parts, lang=lang, bits=len(bits).bit_length() + 5)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def score(a: str, left: str, right: str) -> Column:
    """floor(10^6 a a / (left right)), exact beyond 64 bits."""
    a, left, right = (f"cast({x} as decimal(18, 0))" for x in (a, left, right))
    return F.expr(f"({SCALE} * {a} * {a}) div ({left} * {right})")


def _thresholds(pairs: DataFrame, many: int) -> dict[str, int]:
    """By language the score down to which about ``many`` pairs are opened; 0 where there are fewer.

    As many rows as there are languages and scores in thousands reach one task; a row for each
    language the driver.
    """
    step = SCALE // 1000
    count = pairs.groupBy("lang", (F.col("best") - F.col("best") % step).alias("edge")).count()
    upto = Window.partitionBy("lang").orderBy(F.desc("edge"))
    told = count.withColumn("so_far", F.sum("count").over(upto))
    rows = told.groupBy("lang").agg(
        F.max(F.when(F.col("so_far") >= many, F.col("edge"))).alias("t")
    ).collect()
    return {r.lang: r.t or 0 for r in rows}


def mine(
    docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = SHARE, opened: int | None = None
) -> DataFrame:
    """The ``top`` best phrases of two or three words of every language (``lang``; null: ``und``).

    Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line breaks, and those into words at
    spaces and tabs. A phrase of ``a`` occurrences, ``least`` or more, is cut after its first words; with
    ``l`` and ``r`` occurrences of its parts it scores floor(10^6 a a / (l r)), its worst cut counts, and the
    first of equal ones. A phrase inside a longer one that occurs ``share`` percent as often, and ``least``
    times, is dropped. Result: lang, rank, phrase, a, l, r, n (words of the language), score; in order of
    score, ``a``, phrase (by UTF-8 bytes).

    Null and empty texts have no words; a language without phrases has no rows. Repeated rows count as often
    as they occur. Other columns are left out. ``docs`` is read several times: give it a table. ``opened``
    says how many pairs of a language are grown at first.
    """
    docs = docs.select("text", "lang")
    words = stage(_word_counts(docs), "word-counts")
    clash = words.groupBy("lang", F.xxhash64("word").alias("w")).count().filter("count > 1")
    total = words.groupBy("lang").agg(F.sum("c").alias("n"))
    often = words.filter(F.col("c") >= least).select("lang", F.xxhash64("word").alias("w"), "word", "c")
    often = stage(often, "frequent-words")
    if clash.join(often, ["lang", "w"], "left_semi").take(1):
        raise RuntimeError("two words of a language have one hash")
    single = _bitmap(often, ["w"])

    def frequent(lang: str, cut: list[np.ndarray]) -> np.ndarray:
        good = np.ones(len(cut[0]), dtype=bool)
        for part in cut:
            good &= _held(single, lang, part)
        return good

    n_words = total.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    edges = _ranges(docs, n_words)
    codes = _frequent_codes(docs, frequent, least, edges)
    likely = bitmap_of(codes.select(F.shiftrightunsigned("at", 64 - BITS).alias("at")), BITS)

    def promising(lang: str, cut: list[np.ndarray]) -> np.ndarray:
        return _held(likely, lang, *cut) & frequent(lang, cut)

    pairs = _counted(docs, 2, promising, least, edges)
    for k in (0, 1):
        word = often.select("lang", F.col("w").alias(f"w{k}"), F.col("c").alias(f"f{k}"))
        pairs = pairs.join(word, ["lang", f"w{k}"])
    own = score("c", "f0", "f1")
    bound = F.expr(f"({SCALE} * cast(c as decimal(18, 0))) div f0")
    pairs = stage(pairs.select("lang", "w0", "w1", "c", "f0", "f1", own.alias("score"), bound.alias("bound"))
                  .withColumn("best", F.greatest("score", "bound")), "word-pairs")
    double = _bitmap(pairs, ["w0", "w1"])
    many, done, found = opened or OPEN * top, set(), []
    while True:
        limits = {lang: t for lang, t in _thresholds(pairs, many).items() if lang not in done}
        if not limits:
            break
        survivors = stage(_grown(docs, pairs, limits, double, least, share, edges), "phrases")
        # The top of a language is settled where it lies above what was not opened.
        reached = {r.lang: r["count"] for r in survivors.groupBy("lang").count().collect()}
        settled = [lang for lang, t in limits.items() if t == 0 or reached.get(lang, 0) >= top]
        found.append(survivors.filter(F.col("lang").isin(settled)))
        done.update(settled)
        many *= WIDER
    if not found:
        found = [_nothing(docs)]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return _ranked(every, often, total, top)


def _nothing(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame(
        [], "lang string, w0 bigint, w1 bigint, w2 bigint, a bigint, l bigint, r bigint, score bigint"
    )


def _grown(
    docs: DataFrame, pairs: DataFrame, limits: dict[str, int], double: Broadcast, least: int, share: int,
    edges: np.ndarray,
) -> DataFrame:
    """Phrases that survive and score their language's threshold or more."""
    table = docs.sparkSession.createDataFrame(list(limits.items()), "lang string, threshold bigint")
    open_pairs = pairs.join(table, "lang").filter("best >= threshold")
    scored = open_pairs.filter("score >= threshold")
    prefix, suffix = _bitmap(open_pairs, ["w0", "w1"]), _bitmap(scored, ["w0", "w1"])

    def wanted(lang: str, cut: list[np.ndarray]) -> np.ndarray:
        one, two = cut[:2], cut[1:]
        opened = _held(prefix, lang, *one) | _held(suffix, lang, *two)
        return opened & _held(double, lang, *one) & _held(double, lang, *two)

    threes = stage(_counted(docs, 3, wanted, least, edges), "word-triples")
    # What a pair is dropped for: the most frequent phrase that it begins or ends.
    parts = threes.select("lang", "w0", "w1", "c").union(threes.select("lang", "w1", "w2", "c"))
    above = parts.groupBy("lang", "w0", "w1").agg(F.max("c").alias("above"))
    two = scored.join(above, ["lang", "w0", "w1"], "left").filter(
        F.col("above").isNull() | (100 * F.col("above") < share * F.col("c"))
    ).select(
        "lang", "w0", "w1", F.lit(None).cast("bigint").alias("w2"), F.col("c").alias("a"),
        F.col("f0").alias("l"), F.col("f1").alias("r"), "score",
    )
    front = pairs.select("lang", "w0", "w1", F.col("c").alias("c01"), "f0")
    back = pairs.select("lang", F.col("w0").alias("w1"), F.col("w1").alias("w2"), F.col("c").alias("c12"),
                        F.col("f1").alias("f2"))
    three = threes.join(front, ["lang", "w0", "w1"]).join(back, ["lang", "w1", "w2"]).join(table, "lang")
    three = three.withColumn("one", score("c", "f0", "c12")).withColumn("other", score("c", "c01", "f2"))
    first = F.col("one") <= F.col("other")
    three = three.select(
        "lang", "w0", "w1", "w2", F.col("c").alias("a"), "threshold",
        F.when(first, F.col("f0")).otherwise(F.col("c01")).alias("l"),
        F.when(first, F.col("c12")).otherwise(F.col("f2")).alias("r"),
        F.least("one", "other").alias("score"),
    ).filter("score >= threshold").drop("threshold")
    return two.unionByName(three)


def _ranked(found: DataFrame, often: DataFrame, total: DataFrame, top: int) -> DataFrame:
    """The best by language; ranked in shares of it first, so that no task sorts all of a language."""
    for k in range(3):
        word = often.select("lang", F.col("w").alias(f"w{k}"), F.col("word").alias(f"s{k}"))
        found = found.join(word, ["lang", f"w{k}"], "left" if k == 2 else "inner")
    found = found.select("lang", F.concat_ws(" ", "s0", "s1", "s2").alias("phrase"), "a", "l", "r", "score")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    part = Window.partitionBy("lang", share).orderBy(*best)
    found = found.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top).drop("rank")
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint"))
    found = found.filter(F.col("rank") <= top).join(total, "lang")
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
