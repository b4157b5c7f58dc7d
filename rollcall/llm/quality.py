"""Quality rules: counts of a text, and a calibrated classifier on hashed n-grams.

The classifier is a logistic regression on the relative frequencies of hashed character n-grams and
of hashed words and word pairs. It learns from labelled rows of at most ``MAX_TEXT`` code
points each, at most ``MAX_DOCS`` of them and ``MAX_CHARS`` code points in all, picked by hash, and from the
first rows of each label, however rare it is; a fifth of these is set aside to calibrate its scores to probabilities (Platt). Scoring covers every text whole, in Arrow batches.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import SPACE, blocks, code_points, output, texts

# Bounds of the sample the classifier learns from.
MAX_DOCS, MAX_CHARS = 2_000, 4_000_000
# A labelled text of more code points than this, 20 times its share of MAX_CHARS, is not learnt from:
# MAX_CHARS then holds at least 100 rows, whatever the lengths. It is scored whole like any other.
MAX_TEXT = 20 * MAX_CHARS // MAX_DOCS
# Of each label this part of MAX_DOCS rows is in the sample by right, with this part of MAX_CHARS code points:
# longer texts only where there are no shorter ones, and one text at least.
ROWS_PART, CHARS_PART = 20, 4
BUCKETS = 1 << 18
CHAR_SIZES = (1, 2, 3, 4)
MIN_SEEN = 5
THRESHOLD = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)
_SPACES = np.array([ord(c) for c in SPACE], dtype=np.uint32)


def _families(flat: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each family of n-grams: buckets, and where those of each text start (with the end)."""
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    wide = flat.astype(np.uint64) + np.uint64(1)
    rolled = np.zeros_like(wide)
    for size in CHAR_SIZES:
        if len(flat) < size:
            yield np.zeros(0, dtype=np.int64), np.zeros(len(at), dtype=np.int64)
            continue
        rolled = rolled[: len(flat) - size + 1] * _MIX + wide[size - 1 :]
        inside = doc[size - 1 :] == doc[: len(doc) - size + 1]
        bucket = ((rolled * _MIX + np.uint64(size)) * _MIX >> _SHIFT).astype(np.int64)[inside]
        yield bucket, np.searchsorted(doc[: len(inside)][inside], np.arange(len(at)))
    space = np.isin(flat, _SPACES)
    before = np.r_[True, space[:-1]]
    before[at[:-1][at[:-1] < len(flat)]] = True
    start = np.flatnonzero(~space & before)
    if len(start) == 0:
        for _ in range(2):
            yield np.zeros(0, dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        return
    # A word's hash adds up its code points, each times a power for its place in the word.
    begin = np.zeros(len(flat), dtype=np.int64)
    begin[start] = start
    place = np.arange(len(flat)) - np.maximum.accumulate(begin)
    power = np.cumprod(np.full(64, _MIX, dtype=np.uint64))
    part = np.where(space, np.uint64(0), wide * power[place & 63])
    word = np.add.reduceat(part, start)
    owner = doc[start]
    yield (word * _MIX >> _SHIFT).astype(np.int64), np.searchsorted(owner, np.arange(len(at)))
    pair = (word[:-1] * _MIX + word[1:]) * _MIX >> _SHIFT
    inside = owner[1:] == owner[:-1]
    yield pair.astype(np.int64)[inside], np.searchsorted(owner[:-1][inside], np.arange(len(at)))


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.r_[0.0, np.cumsum(values, dtype=np.float64)]
    return total[at[1:]] - total[at[:-1]]


@dataclass(frozen=True)
class Classifier:
    """Weights by family and bucket, an intercept, and the two numbers of the calibration."""

    weights: np.ndarray | None
    intercept: float = 0.0
    slope: float = 1.0
    offset: float = 0.0

    def probability(self, parts: list[str]) -> np.ndarray:
        """Chance that each text is of good quality; 1 for a model without labels."""
        if self.weights is None:
            return np.ones(len(parts))
        flat, at = code_points(parts)
        score = np.full(len(parts), self.intercept)
        for weight, (bucket, ends) in zip(self.weights, _families(flat, at)):
            score += _sums(weight[bucket], ends) / np.maximum(1, np.diff(ends))
        return _sigmoid(self.slope * score + self.offset)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with their label."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    return docs.join(known.groupBy("doc_id").agg(F.min("quality").alias("label")), "doc_id")


def sample_labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Text and label of at most ``MAX_DOCS`` labelled rows and ``MAX_CHARS`` code points, by hash.

    Texts of over ``MAX_TEXT`` code points are left out before rows are ranked, so that none ends the
    sample for the rows behind it. To these come the first rows of each label (good: over 0), a
    ``ROWS_PART``-th of ``MAX_DOCS``, texts of over ``MAX_TEXT`` last, up to a ``CHARS_PART``-th of ``MAX_CHARS``;
    the first text has no such bound.

    Labels are one per identifier (the lowest, if several) and not null. Identifiers, hashes and lengths
    decide which rows belong to the sample; no text moves but theirs.
    """
    docs = docs.filter("text IS NOT NULL").withColumn("mark", F.xxhash64("text"))
    found = _labelled(docs.select("doc_id", "mark", F.char_length("text").alias("n")), labels)
    order = F.struct(F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), "doc_id", "mark")
    found = found.withColumns({"order": order, "long": F.col("n") > MAX_TEXT, "good": F.col("label") > 0})
    picked = found.filter("NOT long").orderBy("order").limit(MAX_DOCS)
    upto = Window.orderBy("order").rowsBetween(Window.unboundedPreceding, 0)
    picked = picked.withColumn("upto", F.sum("n").over(upto)).filter(F.col("upto") <= MAX_CHARS)
    first = Window.partitionBy("good").orderBy("long", "order")
    assured = found.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= max(1, MAX_DOCS // ROWS_PART))
    assured = assured.withColumn("upto", F.sum("n").over(first.rowsBetween(Window.unboundedPreceding, 0)))
    assured = assured.filter((F.col("place") == 1) | (F.col("upto") <= MAX_CHARS // CHARS_PART))
    names = ["doc_id", "mark", "label"]
    # At most MAX_DOCS and two of its parts: rows of three numbers.
    chosen = F.broadcast(picked.select(*names).union(assured.select(*names)).distinct())
    return docs.join(chosen, ["doc_id", "mark"]).select("doc_id", "text", "label")


def _features(sample: DataFrame) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """Identifier, label, feature numbers and relative frequencies of each row of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", 1 << 20):
            flat, at = code_points(texts(batch, "text"))
            numbers: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            shares: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            for family, (bucket, ends) in enumerate(_families(flat, at)):
                for row in range(batch.num_rows):
                    mine = bucket[ends[row] : ends[row + 1]]
                    if len(mine):
                        which, count = np.unique(mine, return_counts=True)
                        numbers[row].append((which + family * BUCKETS).astype(np.int32))
                        shares[row].append((count / len(mine)).astype(np.float32))
            pack = lambda x, t: np.concatenate([np.zeros(0, t), *x]).astype(t).tobytes()
            yield output(
                batch, ("text",),
                numbers=pa.array([pack(x, np.int32) for x in numbers], pa.binary()),
                shares=pa.array([pack(x, np.float32) for x in shares], pa.binary()),
            )

    rows = sample.mapInArrow(run, "doc_id bigint, label int, numbers binary, shares binary").collect()
    rows.sort(key=lambda r: (r.doc_id, r.label, bytes(r.numbers)))
    return [
        (r.doc_id, r.label, np.frombuffer(r.numbers, np.int32), np.frombuffer(r.shares, np.float32))
        for r in rows
    ]


def train(docs: DataFrame, labels: DataFrame, rounds: int = 200, penalty: float = 1e-3) -> Classifier:
    """Fit on the bounded sample; a table of one label only (or none) gives a model that keeps all.

    Buckets seen in fewer than ``MIN_SEEN`` texts of the sample take no part, and both labels weigh
    alike while the weights are fitted; the calibration then sees labels as frequent as they are.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    labels = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                           F.col("quality").cast("int").alias("quality"))
    rows = _features(sample_labelled(docs, labels))
    if len({r[1] > 0 for r in rows}) < 2:
        return Classifier(None)
    label = np.array([r[1] > 0 for r in rows], dtype=np.float64)
    every, many = np.unique(np.concatenate([r[2] for r in rows]), return_counts=True)
    used = every[many >= min(MIN_SEEN, len(rows) // 20 + 1)]
    rows = [(i, q, n[kept], v[kept]) for i, q, n, v in rows for kept in [np.isin(n, used, kind="sort")]]
    number = np.searchsorted(used, np.concatenate([r[2] for r in rows])).astype(np.int32)
    # Frequencies are tiny; dividing by a bucket's root mean square brings all features to one scale.
    share = np.concatenate([r[3] for r in rows])
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[2]) for r in rows])
    scale = 1 / np.sqrt(np.bincount(number, share * share, len(used)) / len(rows) + 1e-8)
    scale = np.minimum(scale, 300) / np.sqrt(len(rows[0][2]) + 1)
    value = share * scale.astype(np.float32)[number]
    aside = np.arange(len(rows)) % 5 == 4
    fit = ~aside if len({*label[~aside]}) == 2 else np.ones(len(rows), dtype=bool)
    weight, bias = np.zeros(len(used)), 0.0
    seen, seen_bias = np.zeros(len(used)), 0.0
    good = label[fit].mean()
    matter = np.where(fit, np.where(label > 0, 0.5 / good, 0.5 / (1 - good)), 0) / fit.sum()
    for _ in range(rounds):  # AdaGrad on the whole sample
        score = np.bincount(row, value * weight[number], len(rows)) + bias
        error = (_sigmoid(score) - label) * matter
        slope = np.bincount(number, value * error[row], len(used)) + penalty * weight
        seen += slope**2
        weight -= 0.1 * slope / np.sqrt(seen + 1e-16)
        seen_bias += error.sum() ** 2
        bias -= 0.1 * error.sum() / np.sqrt(seen_bias + 1e-16)
    score = np.bincount(row, value * weight[number], len(rows)) + bias
    held = aside if fit.sum() < len(rows) and len({*label[aside]}) == 2 else fit
    slope, offset = _calibrate(score[held], label[held])
    whole = np.zeros((len(CHAR_SIZES) + 2) * BUCKETS, dtype=np.float32)
    whole[used] = weight * scale
    return Classifier(whole.reshape(-1, BUCKETS), bias, slope, offset)


def _calibrate(score: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn scores into probabilities, with smoothed targets (Platt)."""
    good, bad = label.sum(), len(label) - label.sum()
    target = np.where(label > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.c_[score, np.ones(len(score))]
    x[:, 0] /= np.abs(score).mean() + 1e-9
    w, rest = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(200):  # a weak pull to the raw scores keeps clean cuts from running away
        p = _sigmoid(x @ w)
        slope = x.T @ (p - target) + 0.1 * (w - rest)
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        step = np.linalg.solve(hess, slope)
        w = w - step / max(1.0, np.abs(step).max())
        w[0] = max(w[0], 1e-3)
    return float(w[0] / (np.abs(score).mean() + 1e-9)), float(w[1])


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated windows of three.

    ``bytes.split`` and ``bytes.strip`` know ASCII white space only, as is meant here.
    """
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    chars = len(text) - sum(map(text.count, SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    twice = {w for w, n in Counter(windows).items() if n > 1}
    repeated, upto = 0, 0
    if twice:
        for i, w in enumerate(windows):
            if w in twice:
                repeated += i + 3 - max(i, upto)
                upto = i + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge_quality(docs: DataFrame, model: Classifier, threshold: float = THRESHOLD) -> DataFrame:
    """Adds the five counts, ``base_failed``, ``probability`` and ``kept`` to every row.

    ``base_failed``: under 50 words, or over half the words in repeated windows. ``kept``: not failed
    and a probability of at least ``threshold``. A null text counts as empty; repeated rows are
    judged each; columns of these names are replaced.
    """
    new = [*COUNTS, "base_failed", "probability", "kept"]
    docs = docs.select(*[c for c in docs.columns if c not in new])
    # Six tables of buckets: of one size whatever the corpus.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", 1 << 20):
            parts = texts(batch, "text")
            counts = np.array([base_counts(t) for t in parts], dtype=np.int64)
            chance = shared.value.probability(parts)
            failed = (counts[:, 0] < MIN_WORDS) | (
                100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0]
            )
            yield output(
                batch,
                **{c: pa.array(counts[:, i]) for i, c in enumerate(COUNTS)},
                base_failed=pa.array(failed),
                probability=pa.array(chance),
                kept=pa.array(~failed & (chance >= threshold)),
            )

    fields = [T.StructField(c, T.LongType()) for c in COUNTS]
    fields += [T.StructField("base_failed", T.BooleanType()), T.StructField("probability", T.DoubleType())]
    schema = T.StructType([*docs.schema.fields, *fields, T.StructField("kept", T.BooleanType())])
    return docs.mapInArrow(run, schema)
