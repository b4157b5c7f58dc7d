import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import ASCII_LOWER, TEXTS, rows

from rollcall.llm import collocations


def brute(made, least=10, top=2000, share=50):
    count, total = {}, Counter()
    for r in made:
        lang = "und" if r[2] is None else r[2]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r[1] or "").translate(ASCII_LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            held = count.setdefault(lang, Counter())
            for n in (1, 2, 3):
                held.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in count.items():
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        above = Counter()
        for p, a in good.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    above[q] = max(above[q], a)
        scored = []
        for p, a in good.items():
            if 100 * above[p] >= share * a and above[p]:
                continue
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            s, k = min(cuts)
            scored.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def run(spark, made, **options):
    docs = spark.createDataFrame(made, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return sorted(tuple(r) for r in collocations.mine(docs, **options).collect())


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(500)]
    fixed = ["New York city", "is of the", "é ü ö", "one two three four five", "Ab aB AB ab"]
    made = []
    for i in range(n):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 12))) for _ in range(6)]
        parts += rng.choices(fixed, k=5)
        rng.shuffle(parts)
        made.append((i, rng.choice([" ", ". ", "\n", "\t", ",", " \x0b"]).join(parts), rng.choice(["en", "de", None]), "a", 1))
    return made + rows(TEXTS)


@pytest.mark.parametrize("options", [{}, {"top": 20, "opened": 5}, {"least": 3, "top": 7, "opened": 1}, {"share": 90}])
def test_against_every_phrase(spark, options):
    made = corpus(len(options) + 1)
    want = brute(made, **{k: v for k, v in options.items() if k != "opened"})
    assert len(want) > 10
    assert run(spark, made, **options) == want


def test_threshold_falls_until_settled(spark, monkeypatch):
    """Opened one pair at a time, with few bits in the bitmaps: more rounds and counts, the same phrases."""
    rounds = []
    grown = collocations._grown
    monkeypatch.setattr(collocations, "_grown", lambda *a: rounds.append(a[2]) or grown(*a))
    monkeypatch.setattr(collocations, "BITS", 7)
    monkeypatch.setattr(collocations, "HELD", 64)
    made = corpus(9)
    assert run(spark, made, top=40, opened=1) == brute(made, top=40)
    assert len(rounds) > 1
    for lang in set(rounds[0]) & set(rounds[1]):
        assert rounds[1][lang] <= rounds[0][lang]


def test_repeats_overlap_and_ties(spark):
    made = [(i, "la la la la", "fr", "a", 1) for i in range(12)] + [(i, f"x{i % 2} y{i % 2}", "en", "a", 1) for i in range(24)]
    assert run(spark, made) == brute(made)


def test_nothing(spark, no_docs):
    assert collocations.mine(no_docs).count() == 0
    assert run(spark, [(1, None, None, None, None), (2, "a b c", "en", "a", 1)]) == []


def test_scores_beyond_64_bits(spark):
    big = 10**15
    row = spark.sql(f"SELECT {big + 1}L AS a, {big + 3}L AS l, {big + 7}L AS r").select(
        collocations.score("a", "l", "r").alias("s")).first()
    assert row.s == 10**6 * (big + 1) ** 2 // ((big + 3) * (big + 7))


def test_hash_is_that_of_spark(spark):
    for word in ("word", "é日", "x" * 200):
        told = spark.sql(f"SELECT xxhash64('{word}') AS h").first().h
        assert collocations.word_hash(word.encode()) == told % 2**64
    assert np.uint64(collocations._hashes("a b.c")[2]) == collocations._BREAK
