import re

from helpers import ASCII_LOWER, rows

from rollcall.llm import license_scan
from rollcall.llm.license_scan import NOTICES, Template, scan

WORDS = re.compile(license_scan.WORDS)
PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def brute(text):
    w = WORDS.findall((text or "").translate(ASCII_LOWER))
    at = [(i, tag) for i in range(len(w)) for p, tag in PHRASES.items() if tuple(w[i : i + len(p)]) == p]
    return (len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({t for _, t in at})))


def check(found):
    for r, text in found:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text)
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
        assert (r.score > 0) == (r.labels != "") and r.score <= 1
        assert not r.base_labels or r.score == 1


def test_documents(docs, no_docs):
    clash = docs.withColumnRenamed("lang", "template").withColumnRenamed("source", "w")
    got = scan(clash).collect()
    given = rows()
    assert sorted(map(repr, (r.doc_id for r in got))) == sorted(repr(r[0]) for r in given)
    texts = {}
    for i, t, *_ in given:
        texts.setdefault(i, []).append(brute(t))
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) in texts[r.doc_id]
    assert scan(no_docs).count() == 0


def test_places(spark):
    texts = [
        "MIT License mit-license MIT\nLICENSE", "mit licenses; mit. license", "general public general public license",
        "apache license " * 3000 + "mit license", "mit", "license mit", "gnu general public license, apache license",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    check([(r, texts[r.doc_id]) for r in scan(frame).collect()])


def test_notices_with_changed_words(spark):
    bsd = next(t.text for t in NOTICES if t.label == "bsd")
    less = bsd.replace("binary forms", "compiled forms").replace("with or without", "with or indeed without")
    texts = [f"Foo bar. {bsd}: one two", f"Foo {less} bar", " ".join(bsd.split()[:6]), " ".join(reversed(bsd.split())),
             "Licensed under CC BY-NC 4.0.", f"{bsd} {bsd}", " filler words here ".join(bsd.split())]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r for r in scan(frame).collect()}
    assert [got[i].labels for i in range(7)] == ["bsd", "bsd", "", "", "cc-by-nc", "bsd", ""]
    assert got[0].score == 1 and got[1].score < 1 and len(got[5].spans) == 2
    assert (got[0].spans[0].start, got[0].spans[0].end) == (2, 2 + len(WORDS.findall(bsd)))


def test_templates_are_bounded(spark):
    table = license_scan.template_table(spark, [*license_scan.PHRASES, *NOTICES])
    assert table.count() < 300
    long = Template("long", " ".join(f"w{i}" for i in range(80)))
    try:
        license_scan.template_table(spark, [long]).collect()
    except Exception as e:
        assert "word pairs" in str(e)
    else:
        raise AssertionError("a template too long for its bits went through")
