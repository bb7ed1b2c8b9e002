import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from castledger.operators import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """4,000 rows over 40 keys; one key holds a third of them. Values repeat, some
    are negative, some missing."""
    return spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 39 != 1,
               F.concat(F.lit("k"), (F.col("id") % 39).cast("string"))).alias("k"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 7919) % 101 - 40).cast("decimal(18,2)").alias("v"),
        "id").repartition(7)


def test_rank_equals_row_number(skewed):
    ranked = ordered.rank_within(skewed, ["k"], "v", ["id"], "r", {"s": "v"})
    w = Window.partitionBy("k")
    plain = skewed.select(
        "*", F.row_number().over(w.orderBy(F.desc_nulls_last("v"), "id")).cast("bigint").alias("r"),
        F.sum("v").over(w).alias("s"))
    assert sorted(ranked.collect(), key=repr) == sorted(plain.select(ranked.columns).collect(), key=repr)


def cell_sizes(df):
    return [r["count"] for r in df.groupBy("k", ordered._CELL).count().collect()]


def test_a_hot_group_is_ranked_in_even_cells(skewed):
    """No ranking task gets more than twice the mean, whatever values repeat."""
    cells = cell_sizes(ordered.with_cells(skewed.where("k = 'hot'"), ["k"], "v", ["id"]))
    assert len(cells) > 50 and max(cells) <= 2 * sum(cells) / len(cells)


def test_equal_values_spread_over_cells(spark):
    rows = spark.range(100_000).select(
        F.lit("m").alias("k"), "id", F.when(F.col("id") % 3 == 0, 7.5).otherwise(F.rand(3) * 100).alias("v"))
    cells = cell_sizes(ordered.with_cells(rows, ["k"], "v", ["id"]))
    assert sum(cells) == 100_000 and max(cells) <= 2 * 100_000 / ordered.CELLS
    ranked = ordered.rank_within(rows, ["k"], "v", ["id"], "r").where("v = 7.5").orderBy("r").collect()
    assert [r.id for r in ranked] == sorted(r.id for r in ranked)
    assert [r.r for r in ranked] == list(range(ranked[0].r, ranked[0].r + len(ranked)))


def test_rows_that_are_equal_in_all(spark):
    rows = spark.range(5000).select(F.lit("m").alias("k"), F.lit(1).alias("id"), F.lit(2.0).alias("v"))
    assert sorted(r.r for r in ordered.rank_within(rows, ["k"], "v", ["id"], "r").collect()) == list(range(1, 5001))


def test_the_rows_are_computed_once(skewed):
    ranked = ordered.rank_within(skewed, ["k"], "v", ["id"], "r", {"s": "v"})
    ranked.collect()
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Range (0, 4000") == 1 and "ReusedExchange" in final


def test_rank_shuffles_the_rows_once_and_builds_without_a_job(spark, skewed):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    df = ordered.rank_within(skewed, ["k"], "v", ["id"], "r", {"s": "v"})
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before


def test_empty_input(skewed):
    assert ordered.rank_within(skewed.where("false"), ["k"], "v", [], "r").count() == 0


def test_cells_keep_the_order(spark):
    values = [None, -1e12, -5.5, -1.0, -0.01, 0.0, 0.01, 0.02, 1.0, 1.001, 3.0, 1e3, 1e12]
    frame = spark.createDataFrame([("a", v) for v in values], "k string, v double")
    cells = [r[ordered._CELL] for r in ordered.with_cells(frame, ["k"], "v", [], cells=5).orderBy(
        F.desc_nulls_last("v")).collect()]
    assert cells == sorted(cells) and len(set(cells)) == 5
