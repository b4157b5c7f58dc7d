import hashlib
import uuid

import public_tokenizers
import pytest
import regex
import tiktoken
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from rollcall.llm import bpe

PATTERN = regex.compile(public_tokenizers.PATTERN)
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "a", "Z", "é", "1", "²", "!",
          "#", " ", "　", "\x1c", "\x85", "漢", "́", "😀"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), max_size=4))
def test_pre_tokens_are_those_of_the_pattern(texts):
    found, at = bpe.pre_tokens(texts)
    for i, text in enumerate(texts):
        assert found[at[i] : at[i + 1]] == PATTERN.findall(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_pre_tokens_of_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    found, at = bpe.pre_tokens(texts)
    for i, text in enumerate(texts):
        assert found[at[i] : at[i + 1]] == PATTERN.findall(text)


@pytest.fixture(scope="module")
def coder():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(PATH), special_tokens={})


def _written(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "docs"))
    return spark.read.parquet(str(tmp_path / "docs"))


@pytest.mark.parametrize("block", [1, 200, 24 << 20])
def test_ids_and_round_trip(spark, docs, coder, tmp_path, monkeypatch, block):
    monkeypatch.setattr(bpe, "BLOCK", block)
    read = _written(spark, docs.selectExpr("*", "text AS whole", "1 AS ids"), tmp_path)
    got = bpe.decode(bpe.encode(read)).collect()
    assert len(got) == len(rows())
    for r in got:
        assert r.ids == coder.encode_ordinary(r.whole or "")
        assert bytes(r.decoded) == (r.whole or "").encode()
    told = {r.doc_id: r for r in bpe.decode_digest(bpe.encode(read.filter("doc_id = 25"))).collect()}
    want = coder.encode_ordinary(rows()[25][1])
    assert told[25].n_tokens == len(want)
    assert told[25].ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()


def test_very_long_word(spark, coder, tmp_path):
    texts = [(1, "ab" * 50_000), (2, " " * 20_000 + "x"), (3, "é" * 10_000)]
    read = _written(spark, spark.createDataFrame(texts, "doc_id bigint, text string"), tmp_path)
    got = {r.doc_id: r.ids for r in bpe.encode(read).collect()}
    assert all(got[i] == coder.encode_ordinary(t) for i, t in texts)


def test_no_documents(spark, no_docs):
    assert bpe.decode(bpe.encode(no_docs)).count() == 0
    table = bpe.token_table(PATH)
    assert all(table[i].as_py() == t for t, i in bpe.ranks(PATH).items())


def test_decoding_joins_the_table(spark):
    rows = [(1, [0, 5, 49_000]), (2, None), (3, []), (4, [256, 256])]
    encoded = spark.createDataFrame(rows, "doc_id int, ids array<int>")
    token = {i: t for t, i in bpe.ranks(PATH).items()}
    for r in bpe.decode(encoded).collect():
        assert r.decoded == (None if r.ids is None else b"".join(token[i] for i in r.ids))
    told = {r.doc_id: r for r in bpe.decode_digest(encoded).collect()}
    assert told[2].n_tokens == 0 and told[2].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    for wrong in (10**6, -1):
        with pytest.raises(Exception, match="vocabulary|bounds"):
            bpe.decode(spark.createDataFrame([(1, [wrong])], "doc_id int, ids array<int>")).collect()


def test_groups_of_words_stay_small(spark, tmp_path, monkeypatch):
    """With one shuffle partition too, words are dealt into groups by the size of the corpus."""
    monkeypatch.setattr(bpe, "GROUP", 2_000)
    monkeypatch.setattr(bpe, "BLOCK", 1)
    texts = [(i, " ".join(f"w{i * k}" for k in range(40))) for i in range(60)]
    read = _written(spark, spark.createDataFrame(texts, "doc_id int, text string"), tmp_path)
    most = spark.sparkContext.accumulator(0)
    coder, before = bpe.word_encoder, spark.conf.get("spark.sql.shuffle.partitions")

    def counting(path):  # called once for each group
        most.add(1)
        return coder(path)

    monkeypatch.setattr(bpe, "word_encoder", counting)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert len(bpe.encode(read).collect()) == 60
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert most.value >= 4


def test_each_distinct_word_is_encoded_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 1)  # every text is a block
    texts = [(i, f"same words here {i}") for i in range(50)]
    read = _written(spark, spark.createDataFrame(texts, "doc_id int, text string"), tmp_path)
    seen = spark.sparkContext.accumulator(0)
    coder = bpe.word_encoder

    def counting(path):
        inner = coder(path)

        def one(word):
            seen.add(1)
            return inner(word)

        return one

    monkeypatch.setattr(bpe, "word_encoder", counting)
    assert len(bpe.encode(read).collect()) == 50
    assert seen.value == 3 + 50


def test_changed_input_is_found_out(spark):
    def other_each_time(batches):
        for part in batches:
            yield part.assign(text=[f"words {uuid.uuid4().hex}" for _ in range(len(part))])

    moving = spark.range(20).selectExpr("id", "'' AS text").mapInPandas(other_each_time, "id long, text string")
    with pytest.raises(Exception, match="changed between two reads"):
        bpe.encode(moving).collect()
