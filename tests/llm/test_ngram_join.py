import random

import numpy as np
import pytest
from helpers import ASCII_LOWER, TEXTS, rows, words
from hypothesis import given, settings
from hypothesis import strategies as st

from rollcall.llm import ngram_join


def held(text, n=3):
    w = words((text or "").translate(ASCII_LOWER))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(made, percent=90):
    """(doc_id, set size, component) of every row, all pairs compared."""
    sets = [held(r[1]) for r in made]
    root = list(range(len(made)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    out = []
    for i, r in enumerate(made):
        ids = [s[0] for j, s in enumerate(made) if find(j) == find(i) and s[0] is not None]
        out.append((r[0], len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def run(spark, made, percent=90):
    docs = spark.createDataFrame([r[:2] for r in made], "doc_id bigint, text string")
    return sorted((tuple(r) for r in ngram_join.similar_groups(docs, percent=percent).collect()), key=repr)


def edited(rng, w, edits):
    w = list(w)
    for _ in range(edits):
        at = rng.randrange(len(w))
        kind = rng.randrange(3)
        if kind == 0:
            w[at] = f"new{rng.random()}"
        elif kind == 1:
            w.insert(at, f"new{rng.random()}")
        elif len(w) > 5:
            del w[at]
    return " ".join(w)


@pytest.mark.parametrize("percent", [90, 80])
def test_against_all_pairs(spark, percent):
    rng = random.Random(percent)
    texts = list(TEXTS)
    for size in (9, 10, 11, 12, 14, 20, 30, 45, 60, 100, 300):
        base = [f"w{rng.randrange(4000)}" for _ in range(size)]
        texts += [edited(rng, base, rng.randrange(1 + size // 25)) for _ in range(7)]
        texts += [" ".join(base) + f" tail{k}" for k in range(3)]
    made = rows(texts)
    assert run(spark, made, percent) == brute(made, percent)


def test_a_crowd_apart_from_its_pivot(spark):
    """Sets in a chain and sets that share most of their text but do not link."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    chain = [" ".join(base[k : k + 100]) for k in range(0, 20, 2)]
    apart = [" ".join(base[:100] + [f"x{k}-{i}" for i in range(25)]) for k in range(25)]
    near = [edited(rng, apart[k].split(), 1) for k in (3, 9, 20)]
    made = [(i, t) for i, t in enumerate([*chain, *apart, *near])]
    assert run(spark, made) == brute(made)


def test_crowd_yields_few_pairs(spark, monkeypatch):
    """150 near copies, some too far from all others: pairs and links grow with the crowd."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(200)]
    made = [(i, edited(rng, base, rng.choice([1, 1, 2, 6]))) for i in range(150)]
    seen = []
    linked, crowds = ngram_join._linked, ngram_join._links_of_crowds
    monkeypatch.setattr(ngram_join, "_linked", lambda p, *a: seen.append(p.count()) or linked(p, *a))

    def count(*a):
        found = crowds(*a)
        seen.append(found.count())
        return found

    monkeypatch.setattr(ngram_join, "_links_of_crowds", count)
    assert run(spark, made) == brute(made)
    assert len(seen) == 2 and sum(seen) < 6 * len(made)


@pytest.mark.parametrize("sizes", [{"TILE": 7, "COLUMNS": 16}, {"TILE_GRAMS": 300}])
def test_crowds_in_tiles(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    made = [(i, edited(rng, base, rng.choice([1, 3, 5, 6]))) for i in range(60)]
    made += [(100 + i, edited(rng, made[i][1].split(), 1)) for i in range(30)]
    assert run(spark, made) == brute(made)


def test_what_meets_nothing_is_left_out_before_a_shuffle(spark, monkeypatch):
    """Of 300 texts 12 meet another: few other cells and texts pass the bitmaps, but none that meets is lost."""
    rng = random.Random(9)
    made = [(i, " ".join(f"w{rng.randrange(9000)}" for _ in range(120))) for i in range(300)]
    made += [(300 + i, edited(rng, made[i][1].split(), 1)) for i in range(6)]
    passed = {}
    for name in ("_likely_cells", "_likely_texts"):

        def told(*a, name=name, made=getattr(ngram_join, name)):
            found = made(*a)
            passed[name] = found.count()
            return found

        monkeypatch.setattr(ngram_join, name, told)
    assert run(spark, made) == brute(made)
    assert passed["_likely_texts"] < 60
    assert passed["_likely_cells"] < 0.3 * sum(len(ngram_join.cells_of(ngram_join.shingles(t))) for _, t in made)


def test_full_bitmaps_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BITS", 6)
    rng = random.Random(10)
    made = [(i, " ".join(f"w{rng.randrange(900)}" for _ in range(40))) for i in range(80)]
    made += [(80 + i, edited(rng, made[i][1].split(), 1)) for i in range(40)]
    assert run(spark, made) == brute(made)


def test_one_shuffle_of_the_segments(spark):
    nodes = [f"{i}".encode() for i in range(6)]
    segments = spark.createDataFrame(
        [(x, f, [i * f]) for i, x in enumerate(nodes) for f in range(ngram_join.FRAGMENTS)],
        "node binary, fragment int, held array<bigint>",
    )
    pairs = spark.createDataFrame(list(zip(nodes, nodes[1:])), "a binary, b binary")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = ngram_join._met(pairs, segments)
        assert len(met.collect()) == 5 * ngram_join.FRAGMENTS
        assert "ReusedExchange" in met._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_empty_table_and_clashing_columns(spark, no_docs, docs):
    assert ngram_join.similar_groups(no_docs).count() == 0
    clash = docs.withColumnRenamed("lang", "node").withColumnRenamed("source", "row_hash")
    got = sorted((tuple(r) for r in ngram_join.similar_groups(clash).collect()), key=repr)
    assert got == brute(rows())


@settings(max_examples=300, deadline=None)
@given(st.integers(9, 900), st.integers(0, 10**6), st.sampled_from([90, 80, 95]))
def test_sets_that_link_share_a_cell(n, seed, percent):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2**64, n, dtype=np.uint64)
    if seed % 3 == 0:
        a >>= np.uint64(rng.integers(1, 12))  # crowded ranges and empty cells
    d = ngram_join._differ(2 * n, percent)
    cut = int(rng.integers(0, d + 1))
    more = int(rng.integers(0, d + 1 - cut))
    b = np.r_[a[cut:], rng.integers(0, 2**64, more, dtype=np.uint64)]
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b))
    if 100 * both >= percent * (len(a) + len(b) - both) and both and not np.array_equal(a, b):
        x, y = ngram_join.cells_of(a, percent), ngram_join.cells_of(b, percent)
        assert len(np.intersect1d(x, y))


def test_shingles_of_words():
    assert len(ngram_join.shingles("a b c a b c a b c")) == 3
    assert ngram_join.shingles("A b") == ngram_join.shingles(" a\tB ") != ngram_join.shingles("a")
    assert len(ngram_join.shingles(" \n")) == 0
