import math
import random
import re

import numpy as np
import pytest
from helpers import ASCII_LOWER, TEXTS, rows

from rollcall.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def brute(docs, items, top=50):
    held = [(r[0], terms(r[1])) for r in docs]
    n_docs = sum(bool(t) for _, t in held)
    n_terms = sum(len(t) for _, t in held)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    df = {t: sum(t in h for _, h in held) for ts in asked.values() for t in ts}
    out = []
    for item, ts in asked.items():
        scored = []
        for doc, h in held:
            if not h:
                continue
            m = 50 + (50 * len(h) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((10**9 * h.count(t)) // (1000 * h.count(t) + 20 * m)) for t in ts if t in h
            )
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(scored[:top])]
    return sorted(out, key=repr)


def run(spark, docs, items, **options):
    docs = spark.createDataFrame([r[:2] for r in docs], "doc_id bigint, text string")
    items = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted((tuple(r) for r in ranked_search.search(docs, items, **options).collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"t{int(rng.paretovariate(0.7))}" for _ in range(400)]
    made = rows([*TEXTS, *[" ".join(rng.choices(vocabulary, k=rng.randrange(1, 60))) for _ in range(n)]])
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 20)))) for i in range(12)]
    items += [(20, None), (21, " .,"), (22, "nowhere to be found"), (23, "the MIT license"), (23, "Apache"),
              (None, "t1 t2 one two"), (24, "日本語 É words"), (25, "t1"), (25, "t1")]
    return made, items


@pytest.mark.parametrize("options", [{}, {"tile": 16, "top": 5}, {"tile": 7, "top": 3, "block": 4}])
def test_against_every_document(spark, options):
    made, items = corpus(3, 250)
    assert run(spark, made, items, **options) == brute(made, items, options.get("top", 50))


def test_empty_tables_and_clashing_columns(spark, docs, no_docs):
    items = spark.createDataFrame([(1, "the words")], "item_id int, text string")
    assert ranked_search.search(no_docs, items).count() == 0
    assert ranked_search.search(docs, items.limit(0)).count() == 0
    clash = docs.withColumnRenamed("lang", "item").withColumnRenamed("source", "score")
    got = sorted((tuple(r) for r in ranked_search.search(clash, items).collect()), key=repr)
    assert got == brute(rows(), [(1, "the words")])


def _tile(seed):
    rng = np.random.default_rng(seed)
    size, n_terms = 300, 9
    lists = {}
    for t in range(n_terms):
        docs = np.flatnonzero(rng.random(size) < rng.uniform(0.02, 0.6))
        lists[t] = (docs, rng.integers(1, 1 + 10 ** int(rng.integers(1, 5)), len(docs)))
    made = object.__new__(ranked_search.Tile)
    made.size, made.lists = size, lists
    return made


@pytest.mark.parametrize("seed", range(30))
def test_skipping_loses_nobody(seed):
    tile = _tile(seed)
    pairs = [(0, 1), (2, 3), (4, 5), (6, 7), (8, 8)]
    full = np.zeros(tile.size, dtype=np.int64)
    for docs, impact in tile.lists.values():
        full[docs] += impact
    bounds = [tile.joint(p) for p in pairs]
    assert sum(bounds) >= full.max()
    assert all(b <= sum(int(tile.lists[t][1].max()) for t in set(p)) for p, b in zip(pairs, bounds))
    for least in (1, int(np.median(full)) + 1, int(np.sort(full)[-10]), int(full.max())):
        found, score = tile.search(pairs, bounds, least)
        assert sorted(found.tolist()) == np.flatnonzero(full >= least).tolist()
        assert (full[found] == score).all()


def test_pair_bounds_skip_tiles_that_term_bounds_do_not(spark):
    """Documents best in one term each: apart they promise what no document holds."""
    made = [(i, "alpha " * 9 if i % 2 else "beta " * 9) for i in range(40)]
    made += [(100 + i, "alpha beta " + "filler " * 7) for i in range(4)]
    tile = _tile(0)
    docs = np.arange(40)
    tile.lists = {0: (docs[::2], np.full(20, 90)), 1: (docs[1::2], np.full(20, 80))}
    assert tile.joint((0, 1)) == 90 < 170
    assert run(spark, made, [(1, "alpha beta")], tile=8, top=4) == brute(made, [(1, "alpha beta")], 4)
