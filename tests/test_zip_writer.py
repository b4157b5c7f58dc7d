"""Zipped shards written by tasks: what comes back, what a failed or repeated task leaves."""

import os
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.schemas import ENTITY
from rollcall.sources import zip_shards


def entities(spark, names, tasks=1):
    rows = [(str(i), name, None, "", "1,00", 'a"b', ";") for i, name in enumerate(names)]
    return spark.createDataFrame(rows, ENTITY).repartition(tasks)


def rows_of(df):
    return sorted((tuple(r) for r in df.drop(zip_shards.SHARD).collect()), key=repr)


def test_rows_come_back_whole(spark, tmp_path):
    names = ["é", 'quote "" and \n break', "x\r\ny", "", None, " ;", "\x00nul"] * 3
    df = entities(spark, names, tasks=3)
    folder = str(tmp_path / "zips")
    zip_shards.write_zips(df, folder, "Empresas")
    wanted = sorted((tuple(v and v.replace("\x00", "") for v in r) for r in df.collect()), key=repr)
    found = zip_shards.read_entity_zips(spark, folder)
    assert rows_of(found) == wanted
    shards = os.listdir(folder)
    assert len(shards) == 3 == found.select(zip_shards.SHARD).distinct().count()
    assert all(s.startswith("Empresas") and s.endswith(".zip") for s in shards)


def test_append_and_overwrite(spark, tmp_path):
    folder = str(tmp_path)
    for _ in range(2):
        zip_shards.write_zips(entities(spark, ["a"]), folder, "Empresas")
    zip_shards.write_zips(entities(spark, ["other"]), folder, "Outras")
    assert zip_shards.read_entity_zips(spark, folder).count() == 2
    zip_shards.write_zips(entities(spark, ["b", "c"]), folder, "Empresas", overwrite=True)
    assert {r[1] for r in rows_of(zip_shards.read_entity_zips(spark, folder))} == {"b", "c"}
    assert zip_shards.read_entity_zips(spark, folder, "Outras*.zip").count() == 1


def test_a_failed_task_leaves_the_old_shards_alone(spark, tmp_path):
    folder = str(tmp_path)
    zip_shards.write_zips(entities(spark, ["old"]), folder, "Empresas")
    before = os.listdir(folder)
    # Latin-1 has no such sign: one task of several fails after others have written.
    bad = entities(spark, ["good"] * 20 + ["bad 中"], tasks=4)
    for overwrite in (False, True):
        with pytest.raises(Exception, match="(?i)latin-1"):
            zip_shards.write_zips(bad, folder, "Empresas", overwrite=overwrite)
        assert os.listdir(folder) == before


def test_a_repeated_attempt_does_not_count(tmp_path):
    """Two attempts of one task have written; the message of one is committed."""
    writer = zip_shards.ZipShardWriter(ENTITY, {"path": str(tmp_path), "stem": "Empresas"}, False)
    batch = pa.RecordBatch.from_pydict({c: pa.array(["x"]) for c in ENTITY.fieldNames()})
    paths = [os.path.join(writer.staging, f"0-{attempt}.zip") for attempt in (1, 2)]
    for path in paths:
        assert zip_shards.write_shard(path, "a.csv", iter([batch])) == 1
    writer.commit([None, zip_shards.Written(None, 1), zip_shards.Written(paths[1], 0)])
    (shard,) = os.listdir(tmp_path)
    with zipfile.ZipFile(tmp_path / shard) as archive:
        assert archive.read("a.csv") == b";".join([b'"x"'] * 7) + b"\n"
    writer.abort([])
    assert os.listdir(tmp_path) == [shard]


def test_tasks_without_rows_write_nothing(spark, tmp_path):
    zip_shards.write_zips(entities(spark, ["a"], tasks=4), str(tmp_path), "Empresas")
    assert len(os.listdir(tmp_path)) == 1
    empty = str(tmp_path / "empty")
    zip_shards.write_zips(spark.createDataFrame([], ENTITY), empty, "Empresas")
    assert os.listdir(empty) == []


def test_shards_hold_text(spark, tmp_path):
    df = spark.createDataFrame([(1,)], T.StructType([T.StructField("n", T.LongType())]))
    with pytest.raises(Exception, match="shards hold text"):
        zip_shards.write_zips(df, str(tmp_path), "Numbers")
    zip_shards.write_zips(df.select(F.col("n").cast("string")), str(tmp_path), "Numbers")
