"""A corpus made ready for training, stage by stage.

Each stage takes the documents its predecessor kept and returns documents with the columns they came
with; the last returns token ids in place of texts. ``run`` writes every stage to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import bpe, language, line_dedup, mixing, simhash
from rollcall.session import ship_package, stage

# A document is rejected if the spans of its language hold less than this share of its letters.
MIN_LANGUAGE = 0.5
# Near-duplicates have fingerprints of that many words a shingle, and differ in that many bits at most.
SHINGLE_WORDS, MAX_BITS = 4, 4


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents in no known language, or in none that holds half their letters, go."""
    model = language.train(docs)
    told = language.identify(docs, model)
    kept = told.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("lang_score") >= MIN_LANGUAGE))
    return kept.select(*docs.columns)


def lines_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines that many documents share stay in one of them; ``n_chars`` follows."""
    kept = line_dedup.without_common_lines(docs).select(*docs.columns)
    return _counted(kept)


def near_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each group of near fingerprints stays."""
    return simhash.keep_one(docs, words=SHINGLE_WORDS, budget=MAX_BITS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents as often as their source's target asks for, the last one cut at the budget."""
    return _counted(mixing.take(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: token ids in place of texts, checked by decoding them again."""
    rows = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    back = bpe.decode_digest(bpe.encode(rows), keep_ids=True)
    wrong = F.raise_error(F.lit("decoded text differs from the document"))
    same = F.col("decoded_sha256") == F.col("text_sha256")
    kept = [c for c in docs.columns if c != "text"]
    return back.select(*kept, "ids", F.when(same, F.col("n_tokens")).otherwise(wrong).alias("n_tokens"))


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` anew where the documents have it."""
    if "n_chars" not in docs.columns:
        return docs
    n = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return docs.select(*[n.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


STAGES = [
    ("language ID", identified),
    ("line dedup", lines_once),
    ("SimHash near-dedup", near_once),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", encoded),
]

# SQL knows neither the language model nor fingerprints nor tokens: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written as Parquet and read again."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{n}")
    return docs
