import itertools
import random
import re

import numpy as np
from helpers import rows

from rollcall.llm import spans

PASSAGE = (
    "The first sentence of the passage has quite a few words in it. A second one follows it at once! "
    "Is the third a question of more words than the second one, or is it not? Then comes the last of them."
)


def _frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_passage_stays_in_the_first_document_only(spark):
    own = [f"Document {i} begins in its own words here." for i in range(4)]
    texts = [f"{o}\n{PASSAGE} End of number {i} is here now." for i, o in enumerate(own)]
    texts.append("Nothing of this is anywhere else. So it stays as it is, all of it, to the last word of all.")
    got = {r.doc_id: r for r in spans.remove_repeated(_frame(spark, texts)).collect()}
    assert got[0].text == texts[0] and got[4].text == texts[4]
    for i in (1, 2, 3):
        assert got[i].text == f"{own[i]}\nEnd of number {i} is here now." and got[i].n_removed == 4


SPLIT = re.compile(rf"[{spans.DENSE}]|[^\s{spans.DENSE}]+|\n")


def brute(texts):
    """Text and whole sentences removed: words by a pattern, runs as tuples of words, all in one dict."""
    laid = []
    for text in texts:
        words, ends, stops = [], set(), set()
        for m in SPLIT.finditer(text or ""):
            if m.group() == "\n":
                stops.add(len(words))
                continue
            words.append((m.start(), m.group().lower(), 1 if re.fullmatch(f"[{spans.DENSE}]", m.group()) else 2))
            if m.group()[-1] in spans.STOPS:
                stops.add(len(words))
            if spans.picked(m.group().lower()):
                ends.add(len(words))
        stops = (stops | {len(words)}) - {0}
        ends |= stops
        since = 0
        for k in range(1, len(words) + 1):
            since += 1
            if k in ends or since == 48:
                ends.add(k)
                since = 0
        laid.append((words, sorted({0} | (ends if words else set())), stops))
    first, found = {}, []
    for i, (words, edge, _) in enumerate(laid):
        weigh = lambda a, b: sum(w for *_, w in words[edge[a] : edge[b]])
        n = len(edge) - 1
        cut = set()
        for a in range(n):
            fit = [b for b in range(a + 2, n + 1) if weigh(a, b) >= 24]
            cut |= {(a, min(fit))} if fit else set()
        for b in range(1, n + 1):
            fit = [a for a in range(b - 1) if weigh(a, b) >= 24]
            cut |= {(max(fit), b)} if fit else set()
        runs = [(a, b, tuple(w for _, w, _ in words[edge[a] : edge[b]])) for a, b in cut]
        found.append(runs)
        for a, _, run in sorted(runs):
            first.setdefault(run, (i, a))
    out = []
    for i, (text, (words, edge, stops)) in enumerate(zip(texts, laid)):
        gone = {p for a, b, run in found[i] if first[run] != (i, a) for p in range(a, b)}
        sentences, now = [], []
        for p in range(len(edge) - 1):
            now.append(p)
            if edge[p + 1] in stops:
                sentences.append(now)
                now = []
        size = lambda ps: sum(w for p in ps for *_, w in words[edge[p] : edge[p + 1]])
        whole = 0
        for sentence in sentences:
            if set(sentence) <= gone:
                whole += 1
                continue
            for _, group in itertools.groupby(sentence, key=lambda p: p in gone):
                group = list(group)
                if group[0] in gone and size(group) < 8:
                    gone -= set(group)
        bounds = [words[e][0] for e in edge[:-1]] + [len(text or "")]
        if gone:
            text = text[: bounds[0]] + "".join(
                text[bounds[p] : bounds[p + 1]] for p in range(len(edge) - 1) if p not in gone)
        out.append((text, whole))
    return out


def _compared(spark, texts):
    got = {r.doc_id: (r.text, r.n_removed) for r in spans.remove_repeated(_frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)
    return got


def test_against_brute_force(spark):
    rng = random.Random(3)
    lines = [f"Sentence number {k} has some six words. And {k} more words follow it there." for k in range(12)]
    texts = [" ".join(lines[(i * j) % 12] for j in range(1, 7)) for i in range(25)] + [None, "", lines[0]]
    vocabulary = [f"{rng.choice('abcdefgh')}{k}" for k in range(400)] + ["end.", "what?", "\n", "no!\n", "文字。"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(8, 70))] for _ in range(12)]
    for _ in range(50):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 90))]
        for passage in rng.choices(passages, k=rng.randrange(0, 4)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() if rng.random() < 0.2 else w for w in passage]
        texts.append(" ".join(words))
    got = _compared(spark, texts)
    assert sum(n for _, n in got.values()) > 20


def test_passages_without_spaces(spark):
    rng = random.Random(4)
    signs = [chr(0x4E00 + k) for k in range(900)] + [chr(0x3042 + k) for k in range(60)]
    own = lambda n: "".join(rng.choice(signs) + ("。" if k % 25 == 24 else "") for k in range(n))
    passage = own(190)
    texts = [own(80) + passage + own(60), own(70) + passage + own(90), own(200)]
    got = _compared(spark, texts)
    assert got[0][0] == texts[0] and got[2][0] == texts[2]
    assert len(got[1][0]) < len(texts[1]) - 150


def test_long_stretch_without_full_stops(spark):
    stretch = " ".join(f"piece{k}" for k in range(200))
    texts = [f"alpha {stretch} omega", f"beta gamma {stretch} delta"]
    got = {r.doc_id: r.text for r in spans.remove_repeated(_frame(spark, texts)).collect()}
    assert got[0] == texts[0] and len(got[1].split()) < 60


def test_one_word_over_and_over(spark):
    texts = ["Oure " * 500, "own words first " + "Oure " * 400, "Oure " * 500]
    got = {r.doc_id: len(r.text.split()) for r in spans.remove_repeated(_frame(spark, texts)).collect()}
    assert got[0] <= 96 and got[1] < 100 and got[2] < 50


def test_dirt(spark, docs, no_docs):
    got = spans.remove_repeated(docs.withColumnRenamed("lang", "row").withColumnRenamed("source", "first"))
    assert got.columns == ["doc_id", "text", "row", "first", "n_chars", "n_removed"]
    assert got.count() == len(rows())
    kept = {(r.doc_id, r.text) for r in got.collect()}
    assert (0, None) in kept and (1, "") in kept and (2, " \t\r\n") in kept
    assert spans.remove_repeated(no_docs).count() == 0


def test_pieces_cover_all_words():
    texts = [r[1] or "" for r in rows()] + [PASSAGE, "x " * 500, "Oure " * 300, "a. b.\nc", "\n" * 2000 + "a"]
    for text in texts:
        held = spans.pieces([text])
        assert held.start[-1] == len(held.words.value) and (np.diff(held.start) > 0).all()
        assert (np.diff(held.start) <= spans.LONGEST).all()
    held = spans.pieces(texts)
    each = [spans.pieces([t]) for t in texts]
    assert np.diff(held.of_text).tolist() == [len(e.start) - 1 for e in each]
    marks = np.concatenate([spans.runs(e)[2] for e in each])
    assert sorted(marks.tolist()) == sorted(spans.runs(held)[2].tolist())


def test_passages_planted_mid_sentence(spark):
    rng = random.Random(8)
    vocabulary = [f"{rng.choice('abcdefgh')}{k}" for k in range(3000)]

    def prose(n):
        out = []
        while len(out) < n:
            out += [rng.choice(vocabulary) for _ in range(rng.randrange(6, 22))]
            out[-1] += "."
        return out[:n]

    texts, passages = [], []
    for i in range(150):
        passage = [f"{w[:-1]}q{i}." if w[-1] == "." else f"{w}q{i}" for w in prose(rng.randrange(51, 61))]
        passages.append({w.strip(".") for w in passage})
        for host in (prose(150), prose(150)):
            at = rng.randrange(1, 149)
            texts.append(" ".join([*host[:at], *passage, *host[at:]]))
    got = {r.doc_id: r.text for r in spans.remove_repeated(_frame(spark, texts)).collect()}
    assert all(got[i] == texts[i] for i in range(0, 300, 2))
    left = [len({w.strip(".") for w in got[2 * i + 1].split()} & p) / len(p) for i, p in enumerate(passages)]
    print("missed", sum(x == 1 for x in left), "left on average", sum(left) / len(left))
    assert max(left) < 1 and sum(left) / len(left) < 0.2
