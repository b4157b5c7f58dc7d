"""Helpers the operators share: row keys, ASCII white space and letters, text in bounded blocks.

A *row key* names a row by its identifier and by two hashes of its text. Rows that share an
identifier but not a text stay apart; rows equal in both are copies of one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ASCII white space, and the patterns of what is no white space.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

KEY = ("row_id", "row_hash", "row_check")

# Bytes of text a task holds at a time in Python.
BLOCK_BYTES = 4 << 20


def whole(text: str | Column = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` does just that for pure ASCII, only faster."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def row_key(id_column: str = "doc_id", text_column: str = "text") -> list[Column]:
    """The columns of a row key, named as in ``KEY``."""
    text = whole(text_column)
    return [
        F.col(id_column).alias("row_id"),
        F.xxhash64(text).alias("row_hash"),
        F.xxhash64(F.lit(1), text).alias("row_check"),
    ]


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on the row key; null identifiers meet each other."""
    parts = [left[c].eqNullSafe(right[c]) if c == "row_id" else left[c] == right[c] for c in KEY]
    return parts[0] & parts[1] & parts[2]


def blocks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one holds about ``limit`` bytes of text, or one longer text alone."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The strings of a column, null as empty."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def code_points(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all strings in a row, and where each string starts (with the end)."""
    ends = np.cumsum([0, *map(len, parts)])
    joined = "".join(parts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, dtype=np.uint32), ends


def bitmap_of(at: DataFrame, size: int) -> Broadcast:
    """A bitmap of ``2 ** size`` bits, broadcast, with the bits named in the column ``at`` set."""
    word = F.expr("shiftleft(1L, cast(at & 63 as int))")
    found = at.groupBy(F.shiftright("at", 6).alias("k")).agg(F.bit_or(word).alias("bits"))
    told = found.toArrow()
    bits = np.zeros(1 << (size - 6), dtype=np.int64)
    bits[told.column("k").to_numpy()] = told.column("bits").to_numpy()
    return at.sparkSession.sparkContext.broadcast(bits)


def output(batch: pa.RecordBatch, drop: tuple[str, ...] = (), **columns: pa.Array) -> pa.RecordBatch:
    """The batch without some columns and with new ones."""
    named = {n: batch.column(n) for n in batch.schema.names if n not in drop and n not in columns}
    return pa.RecordBatch.from_pydict({**named, **columns})
