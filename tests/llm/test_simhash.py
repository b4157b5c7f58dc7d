import random

import numpy as np
import pytest
import xxhash
from helpers import ASCII_LOWER, rows, words

from rollcall.llm import simhash
from rollcall.llm.components import components


def brute(text):
    w = words((text or "").translate(ASCII_LOWER))
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(marks):
    """Smallest member of each mark's component, all pairs compared."""
    root = list(range(len(marks)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(marks))]


def test_fingerprints():
    for row in rows():
        assert simhash.fingerprint(row[1] or "") % 2**64 == brute(row[1])


def _links(spark, marks, node_size):
    signed = [(m - 2**64 if m >= 2**63 else m,) for m in marks]
    frame = spark.createDataFrame(signed, "fingerprint bigint")
    return [(r.a % 2**64, r.b % 2**64) for r in simhash.links(frame, node_size=node_size).collect()]


@pytest.mark.parametrize("node_size", [5, 1 << 16])
def test_trie_join_links_what_all_pairs_link(spark, node_size, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 64)
    rng = random.Random(node_size)
    marks = {0, 2**64 - 1, 1, 0b11111}
    for _ in range(25):  # near ones around centres, some at exactly 4 and 5 bits
        centre = rng.getrandbits(64)
        marks |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([0, 1, 3, 4, 5]))) for _ in range(8)}
    crowd = rng.getrandbits(64)
    marks |= {crowd ^ (1 << a) ^ (1 << b) for a in range(10) for b in range(a)}
    marks = sorted(marks)
    place = {m: i for i, m in enumerate(marks)}
    want = groups(marks)
    root = list(range(len(marks)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in _links(spark, marks, node_size):
        a, b = sorted((find(place[a]), find(place[b])))
        root[b] = a
    assert [find(i) for i in range(len(marks))] == want


def test_leaf_pairs_are_all_within_the_budget(spark):
    """Leaves at several depths, against all pairs of leaves."""
    rng = random.Random(12)
    marks = {rng.getrandbits(64) for _ in range(40)} | {(7 << 60) | rng.getrandbits(52) for _ in range(60)}
    signed = [(m - 2**64 if m >= 2**63 else m,) for m in marks]
    tree = simhash.levels(spark.createDataFrame(signed, "fingerprint bigint"), 6)
    leaves = [(4 * n, r.prefix) for n, t in enumerate(tree, 1) for r in t.filter("leaf").collect()]
    assert len({d for d, _ in leaves}) > 2
    assert all(sum(m >> (64 - d) == p for d, p in leaves) == 1 for m in marks)
    want = set()
    for i, (d, p) in enumerate(leaves):
        for e, q in leaves[i:]:
            level = min(d, e)
            errors = ((p >> (d - level)) ^ (q >> (e - level))).bit_count()
            if errors <= 4:
                want.add((frozenset([(d, p), (e, q)]), level, errors))
    found = simhash.node_pairs(tree, 4).collect()
    got = {(frozenset([(r.a_depth, r.a), (r.b_depth, r.b)]), r.level, r.errors) for r in found}
    assert got == want and len(found) == len(want)


def test_crowd_yields_no_pairs(spark):
    crowd = [0b1111 << 20 ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)]
    assert len(_links(spark, crowd, 1 << 16)) < 2 * len(crowd)


def test_documents(spark, docs, no_docs):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows())
    marks = [r.fingerprint % 2**64 for r in got]
    root = groups(marks)
    for i, r in enumerate(got):
        ids = [g.row_id for g, x in zip(got, root) if x == root[i] and g.row_id is not None]
        assert r.component_id == (min(ids) if ids else None)
    zero = {r.component_id for r in got if r.fingerprint == 0}
    assert zero == {0}
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_of_each_group_stays(spark, docs, no_docs):
    clash = docs.withColumnRenamed("lang", "row_id").withColumnRenamed("source", "first")
    kept = simhash.keep_one(clash)
    assert kept.columns == ["doc_id", "text", "row_id", "first", "n_chars"]
    marks = [simhash.fingerprint(r.text or "") % 2**64 for r in kept.collect()]
    assert len(set(groups(marks))) == len(marks)
    every = [simhash.fingerprint(r[1] or "") % 2**64 for r in rows()]
    assert len(marks) == len(set(groups(every)))
    assert simhash.keep_one(no_docs).count() == 0


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(1, 70)] + [(500, 500 + i) for i in range(1, 60)]
    path += [(3, 3), (None, 4), (900, 901), (901, 900), (900, 901)]
    found = {r.node: r.root for r in components(spark.createDataFrame(path, "a bigint, b bigint")).collect()}
    want = {i: 1 for i in range(2, 71)} | {i: 500 for i in range(501, 560)} | {901: 900}
    assert found == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_walk_keeps_to_the_budget():
    marks = np.array(sorted([0, 0b1111, 0b11111, 1 << 63]), dtype=np.uint64)
    walk = simhash._Walk(marks, None, 4)
    walk.run((0, 4), (0, 4), 0, 0)
    assert walk.label.tolist() == [0, 0, 0, 0]  # 0-15-31 in a chain, 0 and 2**63 one bit apart
    walk = simhash._Walk(marks[[0, 2]], None, 4)
    walk.run((0, 2), (0, 2), 0, 0)
    assert walk.label.tolist() == [0, 1]
