import hashlib
from collections import defaultdict

import pytest
from helpers import ASCII_LOWER, LINE, rows

from rollcall.llm import line_dedup
from rollcall.llm.common import SPACE


def brute(given, min_chars=40, min_docs=5):
    key = lambda x: x.strip(SPACE).translate(ASCII_LOWER)
    holds = defaultdict(set)
    for i, text, *_ in given:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holds[key(line)].add(i)
    out = []
    for i, text, *_ in given:
        lines = (text or "").split("\n")
        gone = [i is not None and len(holds[key(x)]) >= min_docs and max(holds[key(x)]) != i for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=repr)


def got(docs, **settings):
    found = line_dedup.without_common_lines(docs, **settings)
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in found.collect()), key=repr)


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_documents(docs, batches):
    want = brute(rows())
    assert got(docs, batches=batches) == want and sum(n for _, _, n, _ in want) == 6


def test_hot_lines_and_long_texts(spark):
    line = "y" * 60
    given = [(i, "\n".join([line, f"own line of document {i} " * 2, LINE if i % 2 else "short", line])) for i in range(200)]
    given += [(500, "\n".join(f"{k:040d}" for k in range(3000)))] + [(600 + i, "\n".join(f"{k:040d}" for k in range(2000))) for i in range(4)]
    frame = spark.createDataFrame(given, "doc_id bigint, text string")
    assert got(frame) == brute(given)


def test_clashing_names_and_no_documents(docs, no_docs):
    clash = docs.withColumnRenamed("lang", "gone").withColumnRenamed("source", "row").withColumnRenamed("n_chars", "n_lines")
    found = line_dedup.without_common_lines(clash)
    assert found.columns == ["doc_id", "text", "gone", "row", "n_lines", "n_dropped"]
    assert found.filter("doc_id = 0").first().text is None
    assert line_dedup.without_common_lines(no_docs).count() == 0


def _lines(spark, texts):
    return line_dedup.hashed_lines(spark.createDataFrame(texts, "doc_id bigint, text string"), 1)


def test_runs_are_levelled(spark):
    runs = line_dedup.Runs(spark, buckets=2, fanout=2)
    assert runs.totals(1).count() == 0
    shape = []
    for n in range(8):
        fresh = runs.add(_lines(spark, [(10 * n + i, f"common\nline {n} {i}\nold {n // 2}") for i in range(3)]))
        shape.append([len(level) for level in runs.levels])
        # Of a batch, only lines no earlier one had are new.
        assert fresh.count() == 3 + (n == 0) + (n % 2 == 0)
    assert shape == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1], [0, 1, 1], [1, 1, 1], [0, 0, 0, 1]]
    known = runs.known()
    assert known.count() == known.select("h1", "h2").distinct().count() == 1 + 24 + 4
    totals = {(r.n_docs, r.last_doc) for r in runs.totals(6).collect()}
    assert totals == {(24, 72)} | {(6, 10 * n + 2) for n in (1, 3, 5, 7)}
    runs.forget()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_merge_anti_join_does_not_shuffle_a_run(spark):
    runs = line_dedup.Runs(spark, buckets=4)
    runs.add(_lines(spark, [(1, "a\nb")]))
    run = spark.table(runs.levels[0][0]).hint("merge")
    batch = spark.createDataFrame([(1, 2)], "h1 bigint, h2 bigint").repartition(4, "h1", "h2")
    plan = batch.join(run.select("h1", "h2"), ["h1", "h2"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    runs.forget()


def test_a_failed_job_leaves_no_runs(spark, docs, monkeypatch):
    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(line_dedup.Runs, "totals", fail)
    with pytest.raises(RuntimeError, match="lost"):
        line_dedup.dropped_places(docs)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_digest_of_nothing():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
