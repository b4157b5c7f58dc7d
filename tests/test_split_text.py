"""Files split inside records: the same rows as a parser that reads each file from its beginning."""

import contextlib
import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.sources import text_files
from rollcall.sources.split_text import _lines

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b", "c")])


@contextlib.contextmanager
def ranges_of(spark, size):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def split(spark, path, **options):
    return text_files.read_raw(spark, str(path), SCHEMA, split=True, **options)


def by_csv(content):
    """Every field as text; the files below have no unquoted empty field."""
    return sorted((tuple(r) for r in csv.reader(io.StringIO(content, newline=""), delimiter=";") if r), key=repr)


def field(rng):
    pieces = ["x", "é", ";", '""', "\n", "\n\n", " ", "long word", '""\n""', "\r\n"]
    return '"' + "".join(rng.choice(pieces) for _ in range(rng.randrange(12))) + '"'


@pytest.mark.parametrize("size", [7, 64, 1000])
@pytest.mark.parametrize("seed", [1, 2])
def test_every_cut_gives_the_rows_of_a_whole_reading(spark, tmp_path, size, seed):
    rng = random.Random(seed)
    wanted = []
    for n in range(3):
        ends = "\r\n" if n == 1 else "\n"
        lines = [";".join(field(rng) for _ in SCHEMA) for _ in range(60)]
        content = ends.join(lines) + (ends if n else "")
        (tmp_path / f"part{n}.csv").write_bytes(content.encode("latin-1"))
        wanted += by_csv(content)
    with ranges_of(spark, size):
        found = split(spark, tmp_path)
        assert rows_of(found) == sorted(wanted, key=repr)


def test_one_file_is_many_tasks_with_breaks_across_their_ends(spark, tmp_path):
    rng = random.Random(5)
    content = "\n".join(f'"{i}";"{"line" * rng.randrange(9)}\nnext";"z"' for i in range(400)) + "\n"
    path = tmp_path / "one.csv"
    path.write_bytes(content.encode("latin-1"))
    with ranges_of(spark, 512):
        lines = _lines(spark, str(path))
        ranges = lines.select("__start").distinct().count()
        assert lines.rdd.getNumPartitions() > 10 and ranges > 10
        # Some ranges do begin inside quotes: their first line closes what an earlier one opened.
        first = lines.groupBy("__start").agg(F.first("value").alias("v")).where(F.col("v").startswith("next"))
        assert first.count() > 0
        assert rows_of(split(spark, path)) == by_csv(content)


def test_a_record_longer_than_several_ranges(spark, tmp_path):
    long = "\n".join(f"line {i}" for i in range(300))
    content = f'"1";"{long}";"a"\n"2";"b";"c"\n"3";"d";"{long}"\n'
    path = tmp_path / "long.csv"
    path.write_bytes(content.encode("latin-1"))
    with ranges_of(spark, 100):
        assert rows_of(split(spark, path)) == by_csv(content)


def test_nulls_empty_lines_empty_files_and_shards(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('"1";;""\n\n\n"2";"é";x\n'.encode("latin-1"))
    (tmp_path / "b.csv").write_bytes(b"")
    rows = rows_of(split(spark, tmp_path, shard="shard"))
    assert rows == [("1", None, "", "a.csv"), ("2", "é", "x", "a.csv")]
    assert rows_of(text_files.read_raw(spark, str(tmp_path), SCHEMA)) == [r[:3] for r in rows]


def test_repeated_records_all_stay(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'"1";"x\ny";"z"\n' * 50)
    with ranges_of(spark, 40):
        assert rows_of(split(spark, tmp_path)) == [("1", "x\ny", "z")] * 50


def test_open_quotes_and_wrong_lengths_stop_the_load(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'"1";"x";"y"\n"2";"x";"y\n"3";"x;"y"\n'.replace(b'"x;"', b'"x;'))
    (tmp_path / "b.csv").write_bytes(b'"1";"x";"y"\n"2";"x"\n')
    with pytest.raises(Exception, match="a quote is not closed"):
        split(spark, tmp_path / "a.csv").collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        split(spark, tmp_path / "b.csv").collect()
    assert rows_of(split(spark, tmp_path / "b.csv", mode="PERMISSIVE")) == [("1", "x", "y"), ("2", "x", None)]


def test_shards_need_split(spark, tmp_path):
    with pytest.raises(ValueError, match="shard goes with split"):
        text_files.read_raw(spark, str(tmp_path), SCHEMA, shard="shard")


def test_lines_move_once(spark, tmp_path):
    """One exchange holds the lines; the others move ranges and fragments."""
    (tmp_path / "a.csv").write_bytes(b'"1";"x\ny";"z"\n' * 50)
    with ranges_of(spark, 40):
        found = split(spark, tmp_path)
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    moved = [line for line in final.splitlines() if "+- Exchange hashpartitioning(__file" in line]
    with_lines = [line for line in moved if "__start" in line and "__size" in line]
    assert "ReusedExchange" in final, final
    assert len(with_lines) <= 2, "\n".join(moved)  # lines, and counts of ranges


def test_records_across_batches_of_lines(spark, tmp_path):
    rng = random.Random(7)
    content = "".join(f'"{i}";"{"line{}".format(rng.randrange(9)) * 2}\n\nnext";"{chr(10) * (i % 11)}"\n' for i in range(200))
    path = tmp_path / "one.csv"
    path.write_bytes(content.encode("latin-1"))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, "3")
    try:
        with ranges_of(spark, 900):
            assert rows_of(split(spark, path)) == by_csv(content)
    finally:
        spark.conf.set(name, old)


def shuffled(node):
    """Records that a run plan has written to shuffles."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled(node.plan())
    if kind == "ReusedExchangeExec":
        return 0
    own = node.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
    children = node.children()
    return own + sum(shuffled(children.apply(i)) for i in range(children.size()))


def test_lines_stay_where_they_are_read(spark, tmp_path):
    """What is shuffled grows with the ranges, not with the lines."""
    path = tmp_path / "a.csv"
    path.write_bytes(b'"1";"x\ny";"z"\n' * 2000)
    with ranges_of(spark, 8000):
        found = split(spark, path)
        n = len(found.collect())
        ranges = _lines(spark, str(path)).select("__start").distinct().count()
    assert n == 2000 and ranges > 2
    assert shuffled(found._jdf.queryExecution().executedPlan()) <= 20 * ranges
