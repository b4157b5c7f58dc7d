import corpus_pipeline
import helpers
import oracle
import pytest
from test_simhash import groups

import __spark_entry__ as bound
from rollcall.llm import bpe, queries, simhash

SMALL = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = bound.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert set(queries.oracle_sql()) <= set(names)


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, key):
    found = queries.queries()[key](spark, SMALL)
    assert oracle.compare(found, oracle.connect(SMALL), queries.oracle_sql()[key]) is None


def _through(spark, docs, folder, upto=5):
    """The stages as they are run for real: each result written and read again."""
    seen = [docs]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:upto]):
        stage(spark, seen[-1], SMALL).write.parquet(str(folder / str(n)))
        seen.append(spark.read.parquet(str(folder / str(n))))
    return seen


def test_stages_on_given_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = _through(spark, docs, tmp_path)
    assert all(s.columns == docs.columns for s in seen[:5])
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in seen]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and len(ids[1]) >= 0.97 * len(ids[0])
    kept = [r.text for r in seen[3].select("text").collect()]
    marks = [simhash.fingerprint(t or "") % 2**64 for t in kept]
    assert len(set(groups(marks))) == len(marks)
    # The mix: words by source come near the targets of what near-dedup kept.
    from test_mixing import brute_targets

    size = {}
    for r in seen[3].collect():
        size[r.source] = size.get(r.source, 0) + len(helpers.words(r.text))
    taken = dict.fromkeys(size, 0)
    for r in seen[4].collect():
        taken[r.source] += len(helpers.words(r.text))
    want = brute_targets(size)
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in size)
    texts = sorted(r.text for r in seen[4].collect())
    token = {i: t for t, i in bpe.ranks(bpe.public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).items()}
    assert sorted(b"".join(token[i] for i in r.ids).decode() for r in seen[5].collect()) == texts


def test_run_gives_what_the_stages_give(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = _through(spark, docs, tmp_path)[-1]
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == want.columns and helpers.tuples(got) == helpers.tuples(want)


def test_stages_on_dirt(spark, docs, tmp_path):
    seen = _through(spark, docs, tmp_path)
    assert all(s.columns == docs.columns for s in seen[:5])
    texts = {r.text for r in seen[1].collect()}
    assert None not in texts and "" not in texts and "12 34 5 67 8 9" not in texts


def test_stages_on_no_documents(spark, no_docs, tmp_path):
    assert [s.count() for s in _through(spark, no_docs, tmp_path)] == [0] * 6
