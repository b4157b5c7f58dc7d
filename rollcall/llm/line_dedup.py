"""Line dedup over levelled sorted runs of line hashes, with DataFrame operations alone.

What is known of the lines seen so far lies in *runs*: tables of line hashes, bucketed and sorted by hash,
with the documents that hold each line counted and the largest identifier among them. A batch of
documents is added in three steps:

1. its lines are hashed and counted by hash;
2. these are merge-anti-joined with the runs: lines no run knows make a new run of level 0, the others
   only add to the tally of known lines, which holds repeated lines and nothing else;
3. when a level has ``FANOUT`` runs they are merged into one of the next level.

A run is read in its order and never shuffled again, and a line is rewritten once for each level.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.common import KEY, SPACE, ascii_lower, row_key, whole
from rollcall.session import scratch_path, stage

MIN_CHARS, MIN_DOCS = 40, 5
FANOUT = 2
# Lines of a batch; fewer make two batches all the same.
BATCH_LINES, MIN_BATCHES = 50_000_000, 2
HASH = ["h1", "h2"]
COUNTED = "h1 bigint, h2 bigint, n_docs bigint, last_doc bigint"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Row key, ``place`` and hashes of every line whose key has ``min_chars`` code points."""
    lines = F.posexplode(F.split(whole(), "\n", -1)).alias("place", "line")
    rows = docs.filter("doc_id IS NOT NULL").select(*row_key(), lines)
    rows = rows.filter(F.octet_length("line") >= min_chars)  # bytes are never fewer
    rows = rows.withColumn("key", line_key(F.col("line"))).filter(F.char_length("key") >= min_chars)
    return rows.select(*KEY, "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def counted(lines: DataFrame) -> DataFrame:
    """Documents and largest identifier by hash, from rows with (row_id, h1, h2).

    First each line once per document, dealt by both, so that no frequent line meets in one task;
    then partial counts by line.
    """
    once = lines.select("row_id", *HASH).distinct()
    return once.groupBy(*HASH).agg(
        F.count(F.lit(1)).alias("n_docs"), F.max("row_id").alias("last_doc")
    )


class Runs:
    """The levelled runs of one collection, and the tally of lines met again."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = FANOUT) -> None:
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.tallies: list[DataFrame] = []

    def _write(self, rows: DataFrame) -> tuple[str, str]:
        """Write a run; the name of its table and its folder."""
        name = f"line_run_{uuid.uuid4().hex}"
        path = scratch_path(self.spark, name)
        rows = rows.repartition(self.buckets, *HASH)
        rows.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", path).saveAsTable(name)
        return name, path

    def known(self) -> DataFrame | None:
        """All runs; no line is in two of them."""
        found = [self.spark.table(name) for level in self.levels for name in level]
        return _union(found) if found else None

    def add(self, lines: DataFrame) -> DataFrame:
        """Take in a batch of hashed lines; returns those no earlier batch had, counted."""
        batch = stage(counted(lines), "line-batch")
        fresh, again = batch, None
        for level in self.levels:
            for name in level:
                run = self.spark.table(name).hint("merge")
                met = batch.join(run.select(*HASH), HASH, "left_semi")
                again = met if again is None else again.unionByName(met)
                fresh = fresh.join(run.select(*HASH), HASH, "left_anti")
        if again is not None:
            self.tallies.append(stage(again, "line-tally"))
        name, path = self._write(fresh)
        self._place(name, 0)
        return self.spark.read.schema(COUNTED).parquet(path)

    def _place(self, name: str, level: int) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged, _ = self._write(_union([self.spark.table(n) for n in full]))
            for n in full:
                self.spark.sql(f"DROP TABLE {n}")  # the catalogue's entry; the folder is scratch
            self._place(merged, level + 1)

    def totals(self, min_docs: int) -> DataFrame:
        """Lines of at least ``min_docs`` documents in all batches: hashes, ``n_docs``, ``last_doc``.

        A line's run has the count of the batch that brought it; only the tally can add to it.
        """
        known = self.known()
        if known is None:
            return self.spark.createDataFrame([], COUNTED)
        parts = known
        if self.tallies:
            more = _union(self.tallies).groupBy(*HASH).agg(
                F.sum("n_docs").alias("more"), F.max("last_doc").alias("later")
            )
            parts = known.join(more, HASH, "left").select(
                *HASH, (F.col("n_docs") + F.coalesce("more", F.lit(0))).alias("n_docs"),
                F.greatest("last_doc", "later").alias("last_doc"),
            )
        return parts.filter(F.col("n_docs") >= min_docs)

    def forget(self) -> None:
        """Take the runs out of the session's catalogue."""
        for level in self.levels:
            for name in level:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels = []


def _union(parts: list[DataFrame]) -> DataFrame:
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def dropped_places(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int | None = None
) -> DataFrame:
    """Row key and ``gone``: the places of lines that a row loses. Rows that lose none are absent.

    A line goes if at least ``min_docs`` documents hold its key, save from the largest identifier that
    does. All documents are taken in, in ``batches`` batches dealt by hash of the identifier; their number
    follows that of the lines if it is not given.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "lines")
    hashed_lines(docs, min_chars).write.parquet(path)
    schema = "row_id bigint, row_hash bigint, row_check bigint, place int, h1 bigint, h2 bigint"
    lines = spark.read.schema(schema).parquet(path)
    batches = batches or max(MIN_BATCHES, -(-lines.count() // BATCH_LINES))
    lines = lines.withColumn("batch", F.pmod(F.xxhash64("row_id"), F.lit(batches)).cast("int"))
    runs = Runs(spark)
    try:
        for n in range(batches):
            runs.add(lines.filter(F.col("batch") == n))
        common = stage(runs.totals(min_docs).select(*HASH, "last_doc"), "common-lines")
    finally:
        runs.forget()
    gone = lines.join(common, HASH).filter("row_id <> last_doc")
    return gone.groupBy(*KEY).agg(F.collect_set("place").alias("gone"))


def without_common_lines(docs: DataFrame, **settings) -> DataFrame:
    """Every row with the lines it loses cut out of ``text``; adds ``n_lines`` and ``n_dropped``.

    ``n_lines`` counts before. Null and empty texts are one empty line. Lines that stay are joined by
    line breaks; a row that loses none keeps its text as it is. Rows without an identifier count for
    nothing and lose nothing; rows that share one are one document. Columns of the two names are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    docs = docs.select(*names).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    gone = dropped_places(docs, **settings)
    rows = docs.select(F.struct(*names).alias("row"), *row_key())
    same = [rows[c] == gone[c] for c in KEY]
    met = rows.join(gone, same[0] & same[1] & same[2], "left").select("row", "gone")
    met = met.withColumn("lines", F.split(whole("row.text"), "\n", -1))
    size = F.size("lines")
    # Places that stay, by a set difference: linear in the number of lines.
    stay = F.array_except(F.sequence(F.lit(0), size - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    )
    columns = [text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in names]
    return met.select(
        *columns, size.cast("bigint").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("bigint").alias("n_dropped"),
    )
