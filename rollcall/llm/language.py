"""Language identification: scripts narrow the candidates, Viterbi labels spans of words.

A word is a run of letters and marks. Its score for a language adds up log-likelihoods of hashed
character n-grams; only languages that write in the word's script are candidates. Viterbi then finds
the best labelling of a text's words when every change of language costs a penalty, so mixed texts
come out as spans. The label that holds most letters is the text's language, and its share of all
letters the score.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import blocks, code_points, output, texts
from rollcall.session import stage

UNKNOWN = "und"
# Bound of the sample the model learns from: documents of each language, picked by hash.
MAX_DOCS = 1_500
# Shares of a language that are ranked apart first.
SHARES = 64
BUCKETS = 1 << 16
SIZES = (2, 3, 4)
PENALTY = 12.0
# A language writes in a script that holds at least this share of its letters.
MIN_SCRIPT_SHARE = 0.01

# First code points of Unicode ranges by script; a range ends where the next begins.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"),
    (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"),
    (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1380, "other"),
    (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"), (0x1C80, "cyrillic"),
    (0x1C90, "other"), (0x1D00, "latin"), (0x1F00, "greek"), (0x2000, "latin"),
    (0x2C00, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"),
    (0x2E00, "han"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"),
    (0x3190, "han"), (0x31F0, "kana"), (0x3200, "han"), (0xA640, "cyrillic"),
    (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"),
    (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "latin"),
    (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"),
    (0x40000, "other"),
)
NAMES = tuple(sorted({name for _, name in SCRIPTS}))

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: 1 for letters and 2 for marks, the lower-case form, the script's number."""
    kind = np.zeros(0x110000, dtype=np.uint8)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        group = unicodedata.category(chr(c))[0]
        if group == "L":
            kind[c] = 1
            small = chr(c).lower()
            if len(small) == 1:
                lower[c] = ord(small)
        elif group == "M":
            kind[c] = 2
    script = np.zeros(0x110000, dtype=np.uint8)
    for first, name in SCRIPTS:
        script[first:] = NAMES.index(name)
    return kind, lower, script


@dataclass
class Words:
    """The words of a block of texts, and their n-grams."""

    start: np.ndarray  # of each word, in the block's code points
    end: np.ndarray
    letters: np.ndarray  # of each word
    doc: np.ndarray  # the text of each word
    script: np.ndarray
    bucket: np.ndarray  # of each n-gram
    owner: np.ndarray  # the word of each n-gram


def split_words(parts: list[str]) -> Words:
    kinds, lower, scripts = _tables()
    flat, at = code_points(parts)
    doc = np.repeat(np.arange(len(parts)), np.diff(at))
    kind = kinds[flat]
    inside = kind > 0
    change = np.r_[True, (inside[1:] != inside[:-1]) | (doc[1:] != doc[:-1])] if len(flat) else inside
    first = np.flatnonzero(change & inside)
    bounds = np.r_[np.flatnonzero(change), len(flat)]
    end = bounds[np.searchsorted(bounds, first, side="right")]
    has = np.r_[0, np.cumsum(kind == 1)]
    letters = has[end] - has[first]
    keep = letters > 0
    first, end, letters = first[keep], end[keep], letters[keep]
    # Each word between two zeros; texts are laid out anew so that n-grams never meet two words.
    size = end - first
    base = np.r_[0, np.cumsum(size + 1)]
    laid = np.zeros(int(base[-1]) + 1, dtype=np.uint64)
    word = np.repeat(np.arange(len(first)), size)
    inner = np.arange(len(word)) - np.repeat(np.r_[0, np.cumsum(size)[:-1]], size) if len(first) else word
    laid[base[word] + 1 + inner] = lower[flat[first[word] + inner]]
    of = np.repeat(np.arange(len(first)), size + 1)
    buckets, owners = [], []
    rolled = laid
    for n in range(2, max(SIZES) + 1):
        rolled = rolled[: len(laid) - n + 1] * _MIX + laid[n - 1 :]
        if n in SIZES and len(rolled):
            inner_zero = np.zeros(len(rolled), dtype=bool)
            for k in range(1, n - 1):
                inner_zero |= laid[k : k + len(rolled)] == 0
            here = np.flatnonzero(~inner_zero)
            owner = of[np.minimum(here, len(of) - 1)]
            buckets.append((rolled[here] * _MIX + np.uint64(n)) * _MIX >> _SHIFT)
            owners.append(owner)
    empty = np.zeros(0, dtype=np.int64)
    return Words(
        first, end, letters, doc[first] if len(first) else empty,
        scripts[flat[first]] if len(first) else empty.astype(np.uint8),
        np.concatenate(buckets).astype(np.int64) if buckets else empty,
        np.concatenate(owners) if owners else empty,
    )


@dataclass(frozen=True)
class Model:
    """Languages, log-likelihoods by bucket and language, and the scripts each language uses."""

    languages: tuple[str, ...]
    table: np.ndarray
    writes: np.ndarray  # script, language
    common: int  # number of the language with most documents

    def word_scores(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Scores by word and language, and whether any language writes the word's script."""
        n = len(words.start)
        scores = np.empty((n, len(self.languages)))
        for i in range(len(self.languages)):
            scores[:, i] = np.bincount(words.owner, self.table[words.bucket, i], n)[:n]
        can = self.writes[words.script]
        known = can.any(axis=1)
        scores[~can & known[:, None]] = -1e4
        scores[~known] = 0
        return scores, known


def viterbi(scores: np.ndarray, at: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word; words of text i are those from ``at[i]`` to ``at[i + 1]``.

    A text keeps one label throughout if no stretch of it would gain more than ``penalty`` under
    other labels: then no labelling with a change can win. The other texts go through the usual
    recursion, all of a block side by side.
    """
    n_docs = len(at) - 1
    label = np.zeros(len(scores), dtype=np.int64)
    size = np.diff(at)
    full = np.flatnonzero(size > 0)
    if len(full) == 0:
        return label
    total = np.add.reduceat(scores, at[:-1][full], axis=0)
    best = np.zeros(n_docs, dtype=np.int64)
    best[full] = total.argmax(axis=1)
    label[:] = np.repeat(best, size)
    gain = scores.max(axis=1) - scores[np.arange(len(scores)), label]
    # Gains are never negative: their sum over a text bounds what any stretch can gain.
    rest = full[np.add.reduceat(gain, at[:-1][full]) > penalty]
    if len(rest):
        own = scores[np.arange(len(scores)), label]
        rest = np.array([d for d in rest if _stretch(scores, own, label, at[d], at[d + 1]) > penalty],
                        dtype=np.int64)
    if len(rest) == 0:
        return label
    order = rest[np.argsort(-size[rest], kind="stable")]
    first, long = at[:-1][order], size[order]
    value = scores[first].copy()
    kind = np.min_scalar_type(scores.shape[1])
    back = np.zeros((len(scores), scores.shape[1]), dtype=kind)
    own = np.arange(scores.shape[1], dtype=kind)
    for step in range(1, int(long[0])):
        live = int(np.searchsorted(-long, -step, side="left"))
        now, here = value[:live], first[:live] + step
        top = now.argmax(axis=1)
        other = now[np.arange(live), top] - penalty
        stay = now >= other[:, None]
        back[here] = np.where(stay, own, top[:, None].astype(kind))
        value[:live] = scores[here] + np.where(stay, now, other[:, None])
    current = value.argmax(axis=1)
    for step in range(int(long[0]) - 1, -1, -1):
        live = int(np.searchsorted(-long, -step, side="left"))
        here = first[:live] + step
        label[here] = current[:live]
        current[:live] = back[here, current[:live]]
    return label


def _stretch(scores: np.ndarray, own: np.ndarray, label: np.ndarray, a: int, b: int) -> float:
    """Upper bound of what any stretch of one text gains under other labels than its best one.

    Each word counts with its best other label; words the text's own label explains better count
    against the stretch.
    """
    rival = np.delete(scores[a:b], label[a], axis=1)
    if rival.shape[1] == 0:
        return 0.0
    total = np.r_[0.0, np.cumsum(rival.max(axis=1) - own[a:b])]
    return float((total - np.minimum.accumulate(total)).max())


def train(docs: DataFrame, lang: str = "lang") -> Model:
    """Learn from texts with a language: at most ``MAX_DOCS`` of each, picked by hash of the text.

    n-gram counts are summed by language and bucket in Spark; what reaches the driver, and every task, is a
    table of (languages x ``BUCKETS``) numbers at most, whatever the corpus: 26 MB for 100 languages, 260 MB
    for 1,000.
    """
    known = docs.filter(F.col("text").isNotNull() & F.col(lang).isNotNull())
    known = known.select(F.col(lang).cast("string").alias("lang"), "text", F.xxhash64("text").alias("order"))
    # The first of each share of a language, then the first of these: no task sorts a whole language.
    picked = known.select("lang", "order").distinct()
    for share in ([F.pmod(F.xxhash64("order"), F.lit(SHARES))], []):
        rank = Window.partitionBy("lang", *share).orderBy("order")
        picked = picked.withColumn("n", F.row_number().over(rank)).filter(F.col("n") <= MAX_DOCS).drop("n")
    # One number per language: texts up to it are the sample.
    edges = stage(picked.groupBy("lang").agg(F.max("order").alias("edge")), "language-edges")
    sample = known.join(edges, "lang").filter(F.col("order") <= F.col("edge")).drop("edge")
    sample = sample.dropDuplicates(["lang", "order"])
    sizes = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in blocks(batches, "text", 1 << 18):
            parts, tags = texts(batch, "text"), batch.column("lang").to_pylist()
            for tag in set(tags):
                mine = split_words([p for p, t in zip(parts, tags) if t == tag])
                held = sums.setdefault(tag, np.zeros(BUCKETS + len(NAMES), dtype=np.int64))
                held[:BUCKETS] += np.bincount(mine.bucket, minlength=BUCKETS)
                held[BUCKETS:] += np.bincount(
                    mine.script, mine.letters, len(NAMES)
                ).astype(np.int64)
        for tag, held in sums.items():
            where = np.flatnonzero(held)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([tag] * len(where), pa.string()),
                "place": pa.array(where.astype(np.int32)), "n": pa.array(held[where]),
            })

    counts = sample.select("lang", "text").mapInArrow(count, "lang string, place int, n bigint")
    rows = counts.groupBy("lang", "place").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(set(rows["lang"])))
    table = np.zeros((BUCKETS, len(languages)), dtype=np.float32)
    writes = np.zeros((len(NAMES), len(languages)), dtype=bool)
    for i, tag in enumerate(languages):
        mine = rows[rows["lang"] == tag]
        held = np.zeros(BUCKETS + len(NAMES))
        held[mine["place"].to_numpy()] = mine["n"].to_numpy()
        grams, letters = held[:BUCKETS], held[BUCKETS:]
        table[:, i] = np.log((grams + 0.5) / (grams.sum() + 0.5 * BUCKETS))
        writes[:, i] = letters >= max(1, MIN_SCRIPT_SHARE * letters.sum())
    # Only differences between languages matter; three sizes of n-grams tell the same story.
    table = (table - table.mean(axis=1, keepdims=True)) / len(SIZES) if languages else table
    common = max(range(len(languages)), key=lambda i: (sizes[languages[i]], -i), default=0)
    return Model(languages, table, writes, common)


SPAN = "array<struct<first:int,last:int,lang:string>>"


def identify(
    docs: DataFrame, model: Model, penalty: float = PENALTY, spans: bool = False
) -> DataFrame:
    """Adds ``lang_pred`` and ``lang_score`` to every row, and ``lang_spans`` if asked.

    ``lang_pred`` is ``und`` with score 0 for texts that are null or without letters, or if nothing
    was learned. Words in a script that no known language writes belong to no language; a text of
    such words alone gets the commonest language with score 0. Ties go to the first language in
    order. Spans give the first and last code point of consecutive words of one language. Columns of
    these names are replaced; repeated rows each get their row.
    """
    new = ["lang_pred", "lang_score", "lang_spans"]
    docs = docs.select(*[c for c in docs.columns if c not in new])
    # The table has a fixed number of buckets for each language.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        n_langs = len(held.languages)
        for batch in blocks(batches, "text", 1 << 18):
            parts = texts(batch, "text")
            n = len(parts)
            words = split_words(parts)
            tags, scores, found = [UNKNOWN] * n, np.zeros(n), [[] for _ in range(n)]
            if n_langs and len(words.start):
                each, known = held.word_scores(words)
                at = np.searchsorted(words.doc, np.arange(n + 1))
                label = viterbi(each, at, penalty)
                weight = np.where(known, words.letters, 0)
                total = np.bincount(words.doc * n_langs + label, weight, n * n_langs)
                total = total.reshape(n, n_langs)
                of_all = np.bincount(words.doc, words.letters, n)
                top = np.where(total.sum(axis=1) > 0, total.argmax(axis=1), held.common)
                scores = total[np.arange(n), top] / np.maximum(1, of_all)
                tags = [held.languages[t] if a else UNKNOWN for t, a in zip(top, of_all)]
                if spans:
                    found = _spans(words, label, known, held.languages, parts)
            columns = {"lang_pred": pa.array(tags, pa.string()), "lang_score": pa.array(scores)}
            if spans:
                kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())]))
                columns["lang_spans"] = pa.array(found, kind)
            yield output(batch, **columns)

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())]
    schema = T.StructType([*docs.schema.fields, *fields])
    if spans:
        schema.add("lang_spans", T.DataType.fromDDL(SPAN))
    return docs.mapInArrow(run, schema)


def _spans(words: Words, label: np.ndarray, known: np.ndarray, languages, parts) -> list[list[dict]]:
    """Runs of words of one text with one label; words of unknown scripts are left out."""
    found: list[list[dict]] = [[] for _ in parts]
    base = np.cumsum([0, *map(len, parts)])
    use = np.flatnonzero(known)
    doc, tag = words.doc[use], label[use]
    cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])]) if len(use) else use
    for a, b in zip(cut, np.r_[cut[1:], len(use)]):
        d = int(doc[a])
        found[d].append({
            "first": int(words.start[use[a]] - base[d]), "last": int(words.end[use[b - 1]] - 1 - base[d]),
            "lang": languages[tag[a]],
        })
    return found
