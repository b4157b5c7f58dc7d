"""Capital rankings from the published slice."""

import glob
import random
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rollcall import load, schemas
from rollcall.plans import strategic
from rollcall.session import stage


@pytest.fixture(scope="module")
def registry(spark):
    rng = random.Random(3)
    rows = [
        (f"{n:08d}", f"E{n}", None, rng.choice([None, Decimal(0), Decimal(rng.randrange(1, 900))]), None,
         rng.choice([None, 1, 2]) if n % 500 else 3, rng.choice([7, 8]), "SP", 2, None)
        for n in range(6000)
    ]
    return stage(spark.createDataFrame(rows, schemas.GOLD), "ranked")


@pytest.fixture(scope="module")
def codes(spark):
    sec = spark.createDataFrame([(1, "a"), (2, "b"), (3, "rare")], schemas.CODES)
    return sec, spark.createDataFrame([(7, "x"), (8, "y")], schemas.CODES)


def scanned_rows(df):
    """Rows that the scan of an executed plan gave; its subqueries not counted."""
    def scans(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return scans(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return scans(node.plan())
        below = node.children()
        if below.size() == 0:
            return [node.metrics().apply("numOutputRows").value()]
        return [n for i in range(below.size()) for n in scans(below.apply(i))]

    (rows,) = scans(df._jdf.queryExecution().executedPlan())
    return rows


def unreadable(reg):
    return reg.withColumn("capital", F.raise_error(F.lit("gold was read")).cast("decimal(18,2)"))


def test_slice_is_complete_above_its_floor(registry):
    top = strategic.capital_slice(registry, 0.05)
    floor = top.agg(F.min("capital")).first()[0]
    assert top.count() == registry.where(F.col("capital") >= floor).count()
    with_capital = registry.where("capital > 0").count()
    assert 0.03 * with_capital < top.count() < 0.08 * with_capital
    assert strategic.capital_slice(registry.limit(0)).count() == 0
    assert strategic.capital_slice(registry.where("capital IS NULL OR capital = 0")).count() == 0
    same = registry.where("capital > 0").withColumn("capital", F.lit(5).cast("decimal(18,2)"))
    assert strategic.capital_slice(same).count() == with_capital  # ties are never cut


@pytest.mark.parametrize("n, sector, city, enough", [
    (25, None, None, True), (5, "a", "x", True), (5000, None, None, False), (10, "rare", None, False),
    (10, "none such", None, False),
])
def test_ranking_asks_gold_only_when_the_slice_is_short(registry, codes, n, sector, city, enough):
    top = stage(strategic.capital_slice(registry, 0.05), "top")
    reg = unreadable(registry) if enough else registry
    mine = strategic.rank_capital(reg, *codes, n, sector, city, top=top)
    assert mine.collect() == strategic.rank_capital(registry, *codes, n, sector, city).collect()


def test_row_groups_of_the_slice_are_skipped(spark, registry, tmp_path):
    path = str(tmp_path / "top")
    whole = registry.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("copy")
    top = strategic.capital_slice(whole, 0.9).coalesce(1)
    top.write.option("parquet.block.size", 16384).option("parquet.page.row.count.limit", 200).parquet(path)
    (file,) = glob.glob(f"{path}/*.parquet")
    meta = pq.ParquetFile(file).metadata
    column = meta.schema.to_arrow_schema().get_field_index("capital")
    groups = [meta.row_group(i).column(column).statistics for i in range(meta.num_row_groups)]
    kth = sorted((r[0] for r in spark.read.parquet(path).select("capital").collect()), reverse=True)[24]
    assert len(groups) > 4 and sum(g.max >= kth for g in groups) == 1
    ranked = strategic.largest_rows(spark.read.parquet(path), 25, "capital", "entity_id", nulls=False)
    assert len(ranked.collect()) == 25
    # The second pass reads one row group; the first, the capital column of all of them.
    assert scanned_rows(ranked) < 2 * max(meta.row_group(i).num_rows for i in range(meta.num_row_groups))


def test_a_release_holds_its_slice(spark, registry, codes):
    assert list(load.release_of_top("p_")) == ["p_top_capital"]
    made = load.release_of_top("p_")["p_top_capital"](lambda name: registry)
    assert made.count() == strategic.capital_slice(registry).count()
