import re
from collections import Counter

import numpy as np
import pytest
from helpers import rows, words

from rollcall.llm import quality


def brute(text):
    w = words(text)
    count = Counter(zip(w, w[1:], w[2:]))
    inside = {i + k for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(inside))


def test_counts_and_flags(docs, no_docs):
    judged = quality.judge_quality(docs.selectExpr("*", "1 AS n_words"), quality.Classifier(None)).collect()
    assert len(judged) == len(rows())
    for r in judged:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text)
        assert r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words)
        assert r.kept == (not r.base_failed)
    assert quality.judge_quality(no_docs, quality.Classifier(None)).count() == 0


def _corpus(spark):
    rng = np.random.default_rng(1)
    made = []
    for i in range(240):
        good = i % 4 > 0
        w = [f"{'good' if good else 'junk##'}{rng.integers(30)}" for _ in range(80)]
        made.append((i, " ".join(w), int(good)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in made], "doc_id bigint, text string")
    labels = [(i, q) for i, _, q in made if i < 180] + [(None, 1), (3, None), (5, 1), (5, 1), (10**9, 0)]
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int"), {i: q for i, _, q in made}


def test_classifier_on_rows_it_has_not_seen(spark):
    docs, labels, truth = _corpus(spark)
    model = quality.train(docs, labels, rounds=60)
    got = {r.doc_id: r for r in quality.judge_quality(docs, model).collect()}
    held = [i for i in truth if i >= 180]
    assert np.mean([(got[i].probability >= 0.5) == bool(truth[i]) for i in held]) >= 0.95
    again = {r.doc_id: r.probability for r in quality.judge_quality(docs, quality.train(docs, labels, 60)).collect()}
    assert all(abs(again[i] - got[i].probability) < 1e-9 for i in again)


def test_sample_is_bounded(spark, monkeypatch):
    docs, labels, _ = _corpus(spark)
    monkeypatch.setattr(quality, "MAX_DOCS", 20)
    assert quality.sample_labelled(docs, labels).count() == 20
    monkeypatch.setattr(quality, "MAX_CHARS", 2000)
    assert 0 < quality.sample_labelled(docs, labels).count() < 20


def test_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.train(docs, none).weights is None
    one = spark.createDataFrame([(3, 1), (5, 1)], "doc_id bigint, quality int")
    assert quality.train(docs, one).probability(["x"])[0] == 1.0


def test_one_long_text_does_not_end_the_sample(spark):
    docs, labels, _ = _corpus(spark)
    count = quality.sample_labelled(docs, labels).count()
    long = docs.selectExpr("doc_id", "if(doc_id % 9 = 0, repeat('long ', 900000), text) AS text")
    assert count > 150 and quality.sample_labelled(long, labels).count() >= count * 8 // 9 - 1
    assert quality.train(long, labels, rounds=5).weights is not None


def test_a_label_of_long_texts_alone_is_learnt(spark):
    docs, labels, _ = _corpus(spark)
    long = docs.selectExpr("doc_id", "if(doc_id % 4 = 0, repeat('junk ', 9000), text) AS text")
    taken = {r.label: r["count"] for r in quality.sample_labelled(long, labels).groupBy("label").count().collect()}
    assert 0 < taken[0] <= 1_000_000 // 45_000 and taken[1] > 100
    model = quality.train(long, labels, rounds=60)
    assert model.probability(["junk " * 100])[0] < 0.5 < model.probability(["good1 good2 good3 " * 30])[0]
    endless = docs.selectExpr("doc_id", "if(doc_id % 4 = 0, repeat('junk ', 900000), text) AS text")
    assert quality.sample_labelled(endless, labels).filter("label = 0").count() == 1


def test_a_rare_label_is_learnt(spark):
    docs = spark.range(60_000).selectExpr(
        "id AS doc_id", "concat_ws(' ', transform(sequence(1, 30), i -> concat(if(id % 20000 = 7, 'junk##', 'good'), "
        "cast(pmod(xxhash64(id, i), 30) AS string)))) AS text")
    labels = docs.selectExpr("doc_id", "if(doc_id % 20000 = 7, 0, 1) AS quality")
    sample = quality.sample_labelled(docs, labels)
    assert sample.filter("label = 0").count() == 3
    assert quality.MAX_DOCS <= sample.count() <= quality.MAX_DOCS + 200
    model = quality.train(docs, labels, rounds=40)
    assert model.probability([" ".join(f"junk##{i}" for i in range(30))])[0] < model.probability(
        [" ".join(f"good{i}" for i in range(30))])[0]


def test_rows_of_the_given_table_it_has_not_seen(spark, monkeypatch):
    """Labelled rows that pass the base rules and are not in a sample of 300."""
    monkeypatch.setattr(quality, "MAX_DOCS", 200)
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    seen = {r.doc_id for r in quality.sample_labelled(docs, labels).select("doc_id").collect()}
    judged = quality.judge_quality(docs, quality.train(docs, labels)).filter("NOT base_failed").join(labels, "doc_id")
    rest = [r for r in judged.select("doc_id", "kept", "quality").collect() if r.doc_id not in seen]
    assert len(rest) > 80 and sum(r.kept == (r.quality > 0) for r in rest) >= 0.95 * len(rest)
