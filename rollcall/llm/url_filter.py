"""URL filters: many glob rules at once by a bit-parallel Shift-And automaton.

Every rule is compiled into consecutive bits of a few 64-bit words: one bit for its start and one
for each character it takes. A character of the URL moves all bits of all rules in a handful of word
operations; a star keeps a bit where it is. Blocks of URLs move together, one column of characters
at a time, so the cost is (longest URL) x (words) vector operations per block.

Globs run over the canonical URL ``.host/path``: ``*`` takes any characters but ``/``, ``**`` any
characters, ``?`` one character other than ``/``; the whole canonical URL must be taken.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import LOWER, UPPER, blocks, code_points, output, texts

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    """``verdict`` for a host with its subdomains and all paths that start alike: ``org/x``."""

    verdict: str
    rule: str

    def glob(self) -> str:
        escaped = re.sub(r"([*?\\])", r"\\\1", self.rule)
        return f"*.{escaped}**"


class Glob(NamedTuple):
    """``verdict`` for canonical URLs that fit a glob."""

    verdict: str
    pattern: str


class Automaton:
    """All globs packed into words; ``match`` gives, per string, a boolean for every glob."""

    def __init__(self, globs: Sequence[str]) -> None:
        takes: list[tuple[int, str]] = []  # bit, character it takes ("?" as any but "/")
        stays, anywhere, starts, self.ends = [], [], [], []
        bit = 0
        for glob in globs:
            starts.append(bit)
            for token in re.findall(r"\*\*|\*|\\.|[^*\\]|\\", glob, re.S):
                if token in ("*", "**"):
                    (anywhere if token == "**" else stays).append(bit)
                else:
                    bit += 1
                    takes.append((bit, "any" if token == "?" else token[-1]))
            self.ends.append(bit)
            bit += 1
        self.words = max(1, -(-bit // 64))
        letters = sorted({c for _, c in takes if c != "any"} | {"/"})
        # Class 0 stands for every character no rule names.
        self.classes = np.zeros(0x110000, dtype=np.uint16)
        for n, c in enumerate(letters, 1):
            self.classes[ord(c)] = n
        slash = letters.index("/") + 1
        self.enter = np.zeros((len(letters) + 1, self.words), dtype=np.uint64)
        self.keep = np.zeros_like(self.enter)
        for b, c in takes:
            rows = np.arange(len(letters) + 1) != slash if c == "any" else letters.index(c) + 1
            self.enter[rows, b // 64] |= np.uint64(1 << b % 64)
        for b in anywhere:
            self.keep[:, b // 64] |= np.uint64(1 << b % 64)
        for b in stays:
            self.keep[np.arange(len(letters) + 1) != slash, b // 64] |= np.uint64(1 << b % 64)
        self.start = np.zeros(self.words, dtype=np.uint64)
        for b in starts:
            self.start[b // 64] |= np.uint64(1 << b % 64)

    def match(self, strings: list[str]) -> np.ndarray:
        flat, at = code_points(strings)
        length = np.diff(at)
        order = np.argsort(-length, kind="stable")
        first, long = at[:-1][order], length[order]
        state = np.tile(self.start, (len(strings), 1))
        one, top = np.uint64(1), np.uint64(63)
        for step in range(int(long[0]) if len(strings) else 0):
            live = int(np.searchsorted(-long, -step, side="left"))  # strings longer than step
            seen = self.classes[flat[first[:live] + step]]
            now = state[:live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:live] = moved & self.enter[seen] | now & self.keep[seen]
        bits = np.array(self.ends, dtype=np.int64)
        found = np.zeros((len(strings), len(bits)), dtype=bool)
        found[order] = state[:, bits // 64] >> (bits % 64).astype(np.uint64) & one
        return found


def split_url(urls: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``: host after the first ``://`` with A-Z lower-cased, then the path.

    Both are empty for null and for a URL without ``://``.
    """
    rest = F.when(
        F.locate("://", F.col(url)) > 0,
        F.substr(F.col(url), F.locate("://", F.col(url)) + 3),
    ).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return urls.withColumns({
        "host": host,
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    })


def judge_urls(
    urls: DataFrame,
    rules: Sequence[Rule],
    globs: Sequence[Glob] = (),
    default: str = ALLOW,
    url: str = "url",
) -> DataFrame:
    """Adds ``host``, ``path``, ``rule``, ``glob``, ``verdict`` to every row.

    The longest fitting rule decides; of equal ones, block. Without a rule the longest fitting glob
    decides, of equal lengths block, then the first in order; without either, ``default``. Nulls, URLs
    without ``://`` and repeated rows each get their row; columns of those five names are replaced.
    """
    kept = [c for c in urls.columns if c not in ("host", "path", "rule", "glob", "verdict")]
    split = split_url(urls.select(*kept), url)
    rules = sorted(set(rules), key=lambda r: (-len(r.rule), r.verdict != BLOCK, r.rule))
    globs = sorted(set(globs), key=lambda g: (-len(g.pattern), g.verdict != BLOCK, g.pattern))
    said = [r.verdict for r in rules], [g.verdict for g in globs]
    named = [r.rule for r in rules], [g.pattern for g in globs]
    patterns = [r.glob() for r in rules] + [g.pattern for g in globs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(patterns)
        for batch in blocks(batches, "path", 1 << 18):
            canonical = [f".{h}{p}" for h, p in zip(texts(batch, "host"), texts(batch, "path"))]
            found = automaton.match(canonical)
            rule = _first(found[:, : len(rules)])
            glob = np.where(rule < 0, _first(found[:, len(rules) :]), -1)
            verdict = [
                said[0][r] if r >= 0 else said[1][g] if g >= 0 else default
                for r, g in zip(rule.tolist(), glob.tolist())
            ]
            yield output(
                batch,
                rule=pa.array([named[0][r] if r >= 0 else None for r in rule.tolist()], pa.string()),
                glob=pa.array([named[1][g] if g >= 0 else None for g in glob.tolist()], pa.string()),
                verdict=pa.array(verdict, pa.string()),
            )

    schema = T.StructType([
        *split.schema.fields,
        *[T.StructField(c, T.StringType()) for c in ("rule", "glob", "verdict")],
    ])
    return split.mapInArrow(run, schema)


def _first(found: np.ndarray) -> np.ndarray:
    """Per row the first true column, -1 without one."""
    if found.shape[1] == 0:
        return np.full(len(found), -1)
    return np.where(found.any(axis=1), found.argmax(axis=1), -1)
