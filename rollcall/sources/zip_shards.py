"""Spark data source for zipped extract shards: one partition per zip file, read or written.

    spark.dataSource.register(ZipShards)
    spark.read.format("registry_zip").schema(ENTITY).option("pattern", "Empresas*.zip").load(folder)

The first member of each zip is streamed through an Arrow CSV reader in blocks. That reader fetches up to 32
blocks ahead of the one it parses, so blocks begin small: a task holds about 40 MB of text however large its
shard is, more only where a record is longer than a small block. A zip member cannot be read from the middle;
write the result to Parquet once and work from there. The folder must be mounted on every executor.

    df.write.format("registry_zip").mode("append").option("stem", "Empresas").save(folder)

Every task writes one shard into a folder of the job's own; the commit moves the shards of the tasks that
counted into place, the abort leaves none. Attempts that were lost or repeated leave nothing behind.
"""

from __future__ import annotations

import glob
import io
import os
import shutil
import time
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from rollcall.schemas import ENTITY, ESTABLISHMENT

# The block a record must fit into at most, and the one that reading begins with.
BLOCK_BYTES = 8 << 20
FIRST_BLOCK_BYTES = 1 << 20
SHARD = "shard"


def _without_nul(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch with 0x00 characters dropped from its text, as the text files' reader does."""
    clean = [
        c if c.null_count == len(c) else pc.replace_substring(c, "\x00", "") for c in batch.columns
    ]
    return pa.RecordBatch.from_arrays(clean, schema=batch.schema)


class Shard(InputPartition):
    def __init__(self, path: str):
        self.path = path


def _block_sizes(block: int) -> list[int]:
    """Sizes to try one after another, the last one being ``block``."""
    sizes, size = [], FIRST_BLOCK_BYTES
    while size < block:
        sizes.append(size)
        size *= 8
    return [*sizes, block]


def shard_batches(path: str, columns: list[str], block: int = BLOCK_BYTES) -> Iterator:
    """Arrow batches of one shard: its text columns and the shard's file name.

    A record that is too long for small blocks has the shard read again in larger ones, up to ``block``; rows
    given by then are left out.
    """
    *smaller, last = _block_sizes(block)
    given = 0
    for size in smaller:
        try:
            for batch in _blocks(path, columns, size, given):
                given += batch.num_rows
                yield batch
            return
        except pa.ArrowInvalid:
            continue
    yield from _blocks(path, columns, last, given)


def _blocks(path: str, columns: list[str], block: int, skip: int) -> Iterator:
    """Batches of a shard read in blocks of one size, without its first ``skip`` rows."""
    with zipfile.ZipFile(path) as archive, archive.open(archive.namelist()[0]) as member:
        stream = pa.PythonFile(member, mode="r")
        try:
            reader = pacsv.open_csv(
                stream,
                read_options=pacsv.ReadOptions(
                    column_names=columns, encoding="latin1", block_size=block, use_threads=False
                ),
                parse_options=pacsv.ParseOptions(
                    delimiter=";", quote_char='"', double_quote=True, newlines_in_values=True
                ),
                convert_options=pacsv.ConvertOptions(
                    column_types={c: pa.string() for c in columns},
                    null_values=[""],
                    strings_can_be_null=True,
                    quoted_strings_can_be_null=False,
                ),
            )
        except pa.ArrowInvalid as error:
            if "Empty CSV" in str(error):
                return
            raise
        name = os.path.basename(path)
        for batch in reader:
            seen, batch = batch.num_rows, batch.slice(skip)
            skip = max(0, skip - seen)
            if seen and not batch.num_rows:
                continue
            batch = _without_nul(batch)
            shard = pa.array([name] * batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], [*columns, SHARD])


def shard_nuls(path: str, block: int = BLOCK_BYTES) -> int:
    """Number of 0x00 bytes in the first member of a zip."""
    with zipfile.ZipFile(path) as archive, archive.open(archive.namelist()[0]) as member:
        removed = 0
        while data := member.read(block):
            removed += data.count(b"\x00")
        return removed


class ZipShards(DataSource):
    """Options: ``pattern`` (default ``*.zip``); ``report=nul`` gives NUL counts per shard.

    ``block`` is the largest number of bytes read at a time; a record must fit into one (default 8 MiB).
    ``stem`` begins the names of shards that are written.
    """

    @classmethod
    def name(cls) -> str:
        return "registry_zip"

    def schema(self) -> T.StructType:
        if self.options.get("report") == "nul":
            return T.StructType([
                T.StructField(SHARD, T.StringType()), T.StructField("removed", T.LongType()),
            ])
        raise ValueError("give the shard columns with .schema(...)")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ZipShardReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ZipShardWriter(schema, self.options, overwrite)


class ZipShardReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options):
        folder, pattern = options["path"], options.get("pattern", "*.zip")
        self.paths = sorted(glob.glob(os.path.join(folder, pattern)))
        if not self.paths:
            raise FileNotFoundError(f"no file matches {pattern} in {folder}")
        self.report = options.get("report")
        self.block = int(options.get("block", BLOCK_BYTES))
        self.columns = [f.name for f in schema if f.name != SHARD]

    def partitions(self):
        return [Shard(path) for path in self.paths]

    def read(self, partition: Shard):
        if self.report == "nul":
            yield os.path.basename(partition.path), shard_nuls(partition.path, self.block)
        else:
            yield from shard_batches(partition.path, self.columns, self.block)


@dataclass
class Written(WriterCommitMessage):
    """A shard that a task has written whole, None if it had no rows, and its place among the tasks."""

    path: str | None
    task: int


class ZipShardWriter(DataSourceArrowWriter):
    """One zip per task that has rows, named ``<stem><job>-<task>.zip``.

    Shards become visible one after another at the commit, so a reader that comes in between can see some.
    With ``overwrite`` shards of the same stem that were there before go after the new ones are in place.
    """

    def __init__(self, schema: T.StructType, options, overwrite: bool):
        wrong = [f.name for f in schema if not isinstance(f.dataType, T.StringType)]
        if wrong:
            raise ValueError(f"shards hold text; cast {', '.join(wrong)}")
        self.folder, self.overwrite = options["path"], overwrite
        self.stem = options.get("stem", "Shard")
        self.job = uuid.uuid4().hex
        self.staging = os.path.join(self.folder, f"_writing-{self.job}")
        # Made here and not by the tasks: one that outlives the job then has nowhere left to write.
        os.makedirs(self.staging)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        # Attempts of one task run side by side under speculation: each has a file of its own.
        path = os.path.join(self.staging, f"{task.partitionId()}-{task.taskAttemptId()}.zip")
        rows = write_shard(path, f"{self.stem}{task.partitionId()}.csv", iterator)
        return Written(path if rows else None, task.partitionId())

    def commit(self, messages: list) -> None:
        old = glob.glob(os.path.join(glob.escape(self.folder), f"{glob.escape(self.stem)}*.zip"))
        for shard in (m for m in messages if m and m.path):
            name = f"{self.stem}{self.job}-{shard.task:06d}.zip"
            os.replace(shard.path, os.path.join(self.folder, name))
        for path in old if self.overwrite else ():
            os.remove(path)
        self._leave()

    def abort(self, messages: list) -> None:
        self._leave()

    def _leave(self) -> None:
        # A task that is being stopped may add a file while the folder goes.
        for _ in range(10):
            shutil.rmtree(self.staging, ignore_errors=True)
            if not os.path.exists(self.staging):
                return
            time.sleep(0.2)


def csv_bytes(batch: pa.RecordBatch) -> bytes:
    """A batch in the layout of the extracts: all that is known in quotes, NULL as nothing.

    A character that Latin-1 lacks stops the job: it would come back as another one.
    """
    out = io.BytesIO()
    options = pacsv.WriteOptions(include_header=False, delimiter=";", quoting_style="all_valid")
    pacsv.write_csv(batch, out, options)
    return out.getvalue().decode("utf-8").encode("latin-1")


def write_shard(path: str, member: str, batches: Iterator[pa.RecordBatch]) -> int:
    """Stream batches into the one member of a zip; the number of rows. No file is made for none."""
    rows = 0
    archive = stream = None
    try:
        for batch in batches:
            if not batch.num_rows:
                continue
            if archive is None:
                archive = zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED)
                stream = archive.open(member, "w", force_zip64=True)
            stream.write(csv_bytes(batch))
            rows += batch.num_rows
    finally:
        if archive is not None:
            stream.close()
            archive.close()
    return rows


def write_zips(df: DataFrame, folder: str, stem: str, *, overwrite: bool = False) -> None:
    """Write text columns as zipped shards, one per partition of ``df`` that has rows."""
    df.sparkSession.dataSource.register(ZipShards)
    writer = df.write.format("registry_zip").mode("overwrite" if overwrite else "append")
    writer.option("stem", stem).save(folder)


def _read(
    spark: SparkSession, folder: str, pattern: str, schema: T.StructType, block: int
) -> DataFrame:
    spark.dataSource.register(ZipShards)
    with_shard = T.StructType([*schema.fields, T.StructField(SHARD, T.StringType())])
    return (
        spark.read.format("registry_zip")
        .schema(with_shard)
        .option("pattern", pattern)
        .option("block", block)
        .load(folder)
    )


def read_entity_zips(
    spark: SparkSession, folder: str, pattern: str = "Empresas*.zip", block: int = BLOCK_BYTES
) -> DataFrame:
    """All entity shards: seven text columns and the shard name."""
    return _read(spark, folder, pattern, ENTITY, block)


def read_establishment_zips(
    spark: SparkSession,
    folder: str,
    pattern: str = "Estabelecimentos*.zip",
    block: int = BLOCK_BYTES,
) -> DataFrame:
    """All establishment shards: thirty text columns and the shard name."""
    return _read(spark, folder, pattern, ESTABLISHMENT, block)


def zip_nul_report(spark: SparkSession, folder: str, pattern: str = "*.zip") -> DataFrame:
    """NUL bytes dropped from each shard."""
    spark.dataSource.register(ZipShards)
    return (
        spark.read.format("registry_zip")
        .option("report", "nul")
        .option("pattern", pattern)
        .load(folder)
    )
