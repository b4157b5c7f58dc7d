from collections import defaultdict

import pytest
from helpers import rows, words

from rollcall.llm import mixing


def brute_targets(sizes):
    """Resharing in rounds, as the rule is told."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = dict.fromkeys(order, 0.0), set(order), 1.5 * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


def check(found, given):
    sizes = defaultdict(int)
    for _, text, _, source, _ in given:
        sizes[source] += len(words(text))
    want = brute_targets(sizes)
    taken = defaultdict(int)
    for r in found:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)


@pytest.mark.parametrize("range_rows", [2048, 1])
def test_targets_and_budgets(spark, docs, monkeypatch, range_rows):
    monkeypatch.setattr(mixing, "RANGE_ROWS", range_rows)
    monkeypatch.setattr(mixing, "RANGES", 2)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows())
    check(found, rows())
    again = mixing.mix(docs.repartition(3)).collect()
    key = lambda r: tuple(map(repr, r))
    assert sorted(found, key=key) == sorted(again, key=key)


def test_hot_source_and_many_sources(spark):
    given = [(i, "w " * (i % 7 + 1), None, "hot" if i % 3 else f"s{i % 40}", 0) for i in range(600)]
    found = mixing.mix(spark.createDataFrame(given, "doc_id int, text string, lang string, source string, n_chars int"))
    check(found.collect(), given)


def test_range_size_changes_nothing(spark, docs, monkeypatch):
    one = sorted(map(repr, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 2)
    assert sorted(map(repr, mixing.mix(docs).collect())) == one


def test_taken_documents(spark, docs, no_docs):
    clash = docs.withColumnRenamed("lang", "size").withColumnRenamed("n_chars", "taken")
    wanted = mixing.mix(clash)
    total = defaultdict(int)
    for r in wanted.collect():
        total[r.doc_id] += r.taken
    got = mixing.take(clash)
    assert got.columns == clash.columns
    made = defaultdict(int)
    texts = {r[1] for r in rows()}
    for r in got.collect():
        made[r.doc_id] += len(words(r.text))
        assert r.text in texts or any((t or "").startswith(r.text) for t in texts)
    assert made == {k: v for k, v in total.items() if v}
    assert mixing.mix(no_docs).count() == 0 and mixing.take(no_docs).count() == 0


def test_nothing_to_mix(spark):
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None), (3, " ", "a")], "doc_id int, text string, source string")
    assert {(r.target, r.taken) for r in mixing.mix(blank).collect()} == {(0.0, 0)}
