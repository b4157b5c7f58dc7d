"""Delimited text with line breaks inside quotes, read by many tasks per file.

A file is cut into byte ranges by Spark's text source, which gives whole lines. Whether a line break ends a
record depends on the quotes before it: an odd number of them leaves a quote open. So

1. every range counts its quotes, and a running sum over the few ranges of a file tells in which state each
   one begins;
2. with that, a task passes over the lines of its ranges in their order, finds where records end, and puts the
   lines of each record together;
3. records that cross the end of a range come as fragments, at most one at either end of a range, and are
   joined in the order of the ranges;
4. ``from_csv`` reads each record.

Lines stay where they are read: nothing but counts of ranges and fragments is shuffled, and a task holds one
batch of lines and the record it is in. The one row per range, about a millionth of the text, is broadcast.
The text is read four times: twice for the ranges (their states, and the files of fragments), then for whole
records and for fragments.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.session import ship_package

_FILE, _START, _SIZE = "__file", "__start", "__size"
_RANGE = [_FILE, _START, _SIZE]


def read_split(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    options: Mapping[str, object],
    *,
    mode: str = "FAILFAST",
    shard: str | None = None,
) -> DataFrame:
    """Headerless files as the columns of ``schema``; ``options`` are those of the CSV reader.

    Records end with ``\\n`` or ``\\r\\n`` outside quotes; breaks inside quotes are kept as they are, and
    empty lines are no records. Quotes inside a quoted field must be doubled, and an unquoted field may
    hold none: a file whose quotes do not pair up stops the load under ``FAILFAST``, as does a record with
    too few or too many fields. With ``PERMISSIVE`` such a file ends in one record that runs to its end.
    An empty file gives no rows. ``shard`` names a column for the file's name.
    """
    quote = str(options.get("quote", '"'))
    ship_package(spark)
    encoding = str(options.get("encoding", "UTF-8"))
    text = _records(spark, paths, quote, encoding, strict=mode == "FAILFAST", named=shard is not None)
    fields = {k: v for k, v in options.items() if k != "encoding"}
    row = F.from_csv("text", schema.simpleString(), {**_strings(fields), "multiLine": "true", "mode": mode})
    # Parsed once: without the guard the planner would repeat the parser for every column taken from it.
    rows = text.select(*text.columns[1:], F.explode(F.array(row)).alias("row"))
    name = [F.element_at(F.split(_FILE, "/"), -1).alias(shard)] if shard else []
    return rows.select("row.*", *name)


def _strings(options: Mapping[str, object]) -> dict[str, str]:
    return {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()}


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(range, value): physical lines as their bytes, told by the range they were read from."""
    # Only \n parts lines here: \r alone is text, and one before \n goes with the record's end.
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select(
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_START),
        F.col("_metadata.file_block_length").alias(_SIZE),
        "value",
    )


def _quotes(quote: str) -> Column:
    value = F.col("value")
    n = F.octet_length(value) - F.octet_length(F.replace(value, F.lit(quote), F.lit("")))
    return n.cast("long")


def _ranges(lines: DataFrame, quote: str) -> DataFrame:
    """(range, open, number): whether a range begins inside quotes, and its place among all. One row per range."""
    counted = lines.groupBy(*_RANGE).agg(F.sum(_quotes(quote)).alias("n"))
    before = Window.partitionBy(_FILE).orderBy(_START).rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("n").over(before), F.lit(0)) % 2
    number = F.row_number().over(Window.orderBy(_FILE, _START))
    return counted.select(*_RANGE, odd.alias("open"), number.cast("long").alias("number"))


def _cut(batches: Iterator[pa.RecordBatch], quote: bytes) -> Iterator[tuple[int, bool, bool, pa.Array]]:
    """(number of range, begun in it, ended in it, texts) from lines in the order of their ranges.

    Whole records come many at a time, a fragment alone.
    """
    number, odd, begun, held = None, 0, True, []
    for batch in batches:
        numbers = batch["number"].to_numpy()
        edges = np.flatnonzero(np.diff(numbers)) + 1
        for first, last in zip([0, *edges], [*edges, len(numbers)]):
            if first == last:
                continue
            if numbers[first] != number:
                if held:
                    yield number, begun, False, pa.array([b"\n".join(held)], pa.binary())
                number, odd, held = int(numbers[first]), batch["open"][first].as_py(), []
                begun = odd == 0
            lines = batch["value"][first:last]
            after = (odd + np.cumsum(pc.count_substring(lines, quote).to_numpy())) % 2
            odd, ends = int(after[-1]), np.flatnonzero(after == 0) + 1
            if len(ends) and (held or not begun):
                held += lines[: ends[0]].to_pylist()
                yield number, begun, True, pa.array([b"\n".join(held)], pa.binary())
                begun, held, lines, ends = True, [], lines[ends[0] :], ends[1:] - ends[0]
            if len(ends):
                of_records = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), lines)
                yield number, True, True, pc.binary_join(of_records, pa.scalar(b"\n", pa.binary()))
                lines = lines[ends[-1] :]
            held += lines.to_pylist()
    if held:
        yield number, begun, False, pa.array([b"\n".join(held)], pa.binary())


_WHOLE = "number long, text binary"
_FRAGMENTS = "number long, begun boolean, odd long, text binary"


def _whole(quote: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, begun, ended, texts in _cut(batches, quote):
            if begun and ended:
                numbers = pa.array(np.full(len(texts), number))
                yield pa.RecordBatch.from_arrays([numbers, texts], ["number", "text"])

    return cut


def _fragments(quote: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, begun, ended, texts in _cut(batches, quote):
            if not (begun and ended):
                # A fragment has an odd number of quotes if it opens or closes the record, and not both.
                row = {"number": [number], "begun": [begun], "odd": [int(begun or ended)]}
                yield pa.RecordBatch.from_arrays([*map(pa.array, row.values()), texts], [*row, "text"])

    return cut


def _records(
    spark: SparkSession, paths: str | Sequence[str], quote: str, encoding: str, *, strict: bool, named: bool
) -> DataFrame:
    """(text), or (text, file): the records of all files, decoded."""
    lines = _lines(spark, paths)
    ranges = _ranges(lines, quote)
    files = F.broadcast(ranges.select("number", _FILE))
    # Both readings must be cut alike; a session that gained or lost cores between them may cut anew.
    recut = F.raise_error(F.lit("the ranges of a file changed between two readings; read it again"))
    # Broadcast whatever its size, so that lines keep the order in which they are read.
    placed = lines.join(F.broadcast(ranges), _RANGE, "left").select(
        "number", F.coalesce("open", recut.cast("long")).alias("open"), F.col("value").cast("binary").alias("value")
    )
    mark, decoded = quote.encode(), F.decode("text", encoding)
    text = placed.mapInArrow(_whole(mark), _WHOLE).withColumn("text", decoded)
    text = text.join(files, "number").select("text", _FILE) if named else text.select("text")
    fragments = placed.mapInArrow(_fragments(mark), _FRAGMENTS).withColumn("text", decoded)
    text = text.unionByName(_stitched(fragments.join(files, "number"), strict).select(*text.columns))
    text = text.withColumn(
        "text", F.when(F.endswith("text", F.lit("\r")), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    )
    return text.where(F.col("text") != "")


def _stitched(fragments: DataFrame, strict: bool) -> DataFrame:
    """(file, text): records that cross ends of ranges; a begun one takes what follows until the next begins.

    There are at most two fragments per range, so the order within a file is that of a few rows.
    """
    order = Window.partitionBy(_FILE).orderBy("number", "begun").rowsBetween(Window.unboundedPreceding, 0)
    told = fragments.withColumn("owner", F.sum(F.col("begun").cast("long")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("number", "begun", "text")))
    joined = F.array_join(F.transform(parts, lambda p: p["text"]), "\n")
    records = told.groupBy(_FILE, "owner").agg(joined.alias("text"), F.sum("odd").alias("odd"))
    if strict:
        unclosed = F.raise_error(F.concat(F.lit("malformed: a quote is not closed in "), F.col(_FILE)))
        text = F.when(F.col("odd") % 2 == 0, F.col("text")).otherwise(unclosed.cast("string"))
        records = records.withColumn("text", text)
    return records.select(_FILE, "text")
