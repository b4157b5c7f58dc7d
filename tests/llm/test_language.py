import itertools

import numpy as np
import pytest
from helpers import rows

from rollcall.llm import language

ENGLISH = "the that with from which and have this they would there their about other these".split()
GERMAN = "der und nicht mit sich auch eine nach wird bei einer durch schon zwischen über".split()
RUSSIAN = "это что как его для они быть только можно время когда если даже после люди".split()


def _text(words, seed, n=30):
    rng = np.random.default_rng(seed)
    return " ".join(words[i] for i in rng.integers(len(words), size=n))


@pytest.fixture(scope="module")
def model(spark):
    made = [(i, _text(w, i), tag) for i in range(40) for w, tag in ((ENGLISH, "en"), (GERMAN, "de"), (RUSSIAN, "ru"))]
    made += [(-1, None, "en"), (-2, "untold", None), (-3, "", "en")]
    return language.train(spark.createDataFrame(made, "doc_id int, text string, lang string"))


def test_texts_it_has_not_seen(spark, model):
    made = [(w, _text(w, 1000 + i), tag) for i in range(20) for w, tag in ((ENGLISH, "en"), (GERMAN, "de"), (RUSSIAN, "ru"))]
    frame = spark.createDataFrame([(t, tag) for _, t, tag in made], "text string, lang string")
    got = language.identify(frame, model).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) == 1.0
    assert all(0 <= r.lang_score <= 1 for r in got)


def test_mixed_text_has_spans(spark, model):
    a, b, c = _text(ENGLISH, 1, 40), _text(GERMAN, 2, 20), _text(RUSSIAN, 3, 10)
    text = f"{a}\n{b} 12 {c}"
    r = language.identify(spark.createDataFrame([(text,)], "text string"), model, spans=True).first()
    assert [(text[s.first : s.last + 1], s.lang) for s in r.lang_spans] == [(a, "en"), (b, "de"), (c, "ru")]
    assert r.lang_pred == "en" and 0.4 < r.lang_score < 0.8


def test_scripts_narrow_candidates(spark, model):
    r = language.identify(spark.createDataFrame([("ψψψ the that ψψψ",), ("ψψψ",)], "text string"), model).collect()
    assert r[0].lang_pred == "en" and r[0].lang_score == 7 / 13
    assert r[1].lang_pred in model.languages and r[1].lang_score == 0


def brute(scores, penalty):
    best = None
    for path in itertools.product(range(scores.shape[1]), repeat=len(scores)):
        value = sum(scores[i, p] for i, p in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))
        best = value if best is None else max(best, value)
    return best


def test_viterbi_finds_the_best_labelling():
    rng = np.random.default_rng(5)
    for _ in range(60):
        sizes = rng.integers(0, 7, size=5)
        at = np.r_[0, np.cumsum(sizes)]
        scores = rng.normal(scale=rng.choice([0.3, 2, 5]), size=(at[-1], 3))
        penalty = rng.choice([0.1, 1.0, 4.0])
        label = language.viterbi(scores, at, penalty)
        for a, b in zip(at, at[1:]):
            path = label[a:b]
            value = scores[np.arange(a, b), path].sum() - penalty * (path[1:] != path[:-1]).sum()
            assert b == a or abs(value - brute(scores[a:b], penalty)) < 1e-9


def test_more_languages_than_a_byte_holds():
    rng = np.random.default_rng(8)
    scores = rng.normal(size=(40, 300))
    scores[:20, 299] += 9
    scores[20:, 270] += 9
    label = language.viterbi(scores, np.array([0, 40]), 4.0)
    assert label.tolist() == [299] * 20 + [270] * 20


def test_three_hundred_languages(spark):
    tags = [f"l{i:03d}" for i in range(300)]
    words = {t: [f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + k)}ou" for k in range(8)] for i, t in enumerate(tags)}
    made = [(_text(words[t], i * 7 + k), t) for i, t in enumerate(tags) for k in range(2)]
    model = language.train(spark.createDataFrame(made, "text string, lang string"))
    assert len(model.languages) == 300
    mixed = [(f"{_text(words[a], 1, 30)} {_text(words[b], 2, 25)}", a) for a, b in zip(tags[200:], tags[:100])]
    got = language.identify(spark.createDataFrame(mixed, "text string, lang string"), model).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 98


def test_unseen_rows_of_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = (docs["doc_id"] % 4) == 2
    got = language.identify(docs.filter(held), language.train(docs.filter(~held))).collect()
    assert len(got) > 200 and sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)


def test_words_and_grams():
    found = language.split_words(["", "Ab1c", None or "", "é́x  --"])
    assert found.doc.tolist() == [1, 1, 3] and found.letters.tolist() == [2, 1, 2]
    one, two = language.split_words(["ab cd"]), language.split_words(["CD", "x", "AB"])
    assert set(one.bucket[one.owner == 1]) == set(two.bucket[two.owner == 0])


def test_dirt(spark, docs, no_docs, model):
    got = language.identify(docs.selectExpr("*", "'x' AS lang_pred"), model).collect()
    assert len(got) == len(rows())
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or r.lang_score == 0)
    assert language.identify(no_docs, model).count() == 0
    nothing = language.train(no_docs)
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_DOCS", 1)
    made = [(_text(ENGLISH, i), "en") for i in range(9)]
    few = language.train(spark.createDataFrame(made, "text string, lang string"))
    monkeypatch.setattr(language, "MAX_DOCS", 9)
    many = language.train(spark.createDataFrame(made, "text string, lang string"))
    assert few.languages == many.languages == ("en",)
