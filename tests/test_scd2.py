import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from castledger.operators import scd2

DAY = dt.date
OPEN = DAY(9999, 12, 31)


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame(
        [("h1", "p", DAY(2022, 1, 1), DAY(2022, 3, 31), D("10.00"), False),
         ("h2", "p", DAY(2022, 7, 1), OPEN, D("12.00"), True),
         ("h3", "q", DAY(2022, 2, 10), DAY(2022, 2, 19), D("1.00"), False),
         ("h4", "q", DAY(2022, 2, 20), OPEN, D("2.00"), True)],
        "historico_id string, produto_id string, valid_from date, valid_to date, "
        "custo_padrao_novo decimal(18,2), is_current boolean")


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(
        [(1, "p", DAY(2022, 5, 1)), (2, "p", DAY(2022, 3, 31)), (3, "p", DAY(2023, 1, 1)),
         (4, "p", DAY(2021, 12, 31)), (5, "q", DAY(2022, 2, 19)), (6, "q", DAY(2022, 2, 20)),
         (7, "unknown", DAY(2022, 2, 20)), (8, None, DAY(2022, 2, 20))],
        "id int, produto_id string, d date")


def costs(df):
    rows = df.collect()
    assert len(rows) == len({r.id for r in rows})
    return {r.id: r.custo_padrao_vigente and str(r.custo_padrao_vigente) for r in rows}


@pytest.mark.parametrize("until", [None, DAY(2024, 1, 1)])
def test_interval_lookup_is_null_in_a_gap(facts, history, until):
    got = costs(scd2.lookup_between(facts, "d", history, until))
    assert got == {1: None, 2: "10.00", 3: "12.00", 4: None, 5: "1.00", 6: "2.00", 7: None, 8: None}


@pytest.mark.parametrize("until", [None, DAY(2024, 1, 1)])
def test_asof_lookup_bridges_a_gap(facts, history, until):
    got = costs(scd2.lookup_asof(facts, "d", history, until))
    assert got == {1: "10.00", 2: "10.00", 3: "12.00", 4: None, 5: "1.00", 6: "2.00",
                   7: None, 8: None}


def test_asof_takes_the_highest_id_of_a_day(spark, facts, history):
    again = history.where("historico_id = 'h1'").select(
        F.lit("h9").alias("historico_id"), "produto_id", "valid_from", "valid_to",
        F.lit("99.00").cast("decimal(18,2)").alias("custo_padrao_novo"), "is_current")
    assert costs(scd2.lookup_asof(facts, "d", history.unionByName(again)))[2] == "99.00"


def test_overlapping_versions_all_match(spark, history):
    fact = spark.createDataFrame([(1, "p", DAY(2022, 8, 1))], "id int, produto_id string, d date")
    wide = history.unionByName(history.where("historico_id = 'h2'").withColumn(
        "historico_id", F.lit("h8")))
    found = scd2.lookup_between(fact, "d", wide).collect()
    assert sorted(r.historico_id for r in found) == ["h2", "h8"]


def test_facts_are_read_once_and_joined_by_a_shuffle(spark, facts, history, tmp_path):
    facts.write.parquet(f"{tmp_path}/facts")
    stored = spark.read.parquet(f"{tmp_path}/facts")
    plan = scd2.lookup_between(stored, "d", history)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("SortMergeJoin") == 1


def test_facts_far_outside_the_history(spark, history):
    far = spark.createDataFrame([(1, "p", DAY(2050, 6, 1)), (2, "q", DAY(1990, 6, 1)), (3, "q", DAY(9000, 1, 1)),
                                 (4, "p", None)], "id int, produto_id string, d date")
    for lookup in (scd2.lookup_asof, scd2.lookup_between):
        assert costs(lookup(far, "d", history)) == {1: "12.00", 2: None, 3: "2.00", 4: None}


def test_empty_or_broken_history(spark, facts, history):
    broken = history.withColumn("valid_to", F.date_sub("valid_from", 3))
    for versions in (history.where("false"), broken):
        assert set(costs(scd2.lookup_between(facts, "d", versions)).values()) == {None}


def test_no_facts_unroll_nothing(facts, history):
    none = facts.where("false")
    assert scd2.lookup_asof(none, "d", history).count() == 0
    assert scd2.lookup_between(none, "d", history).count() == 0


def test_current_lookup(facts, history):
    got = costs(scd2.lookup_current(facts, history))
    assert got[4] == "12.00" and got[5] == "2.00" and got[7] is None


def test_build_chains_versions(spark):
    events = spark.createDataFrame(
        [("h2", "p", DAY(2022, 7, 1), D("12.00"), "m"), ("h1", "p", DAY(2022, 1, 1), D("10.00"), "m"),
         ("h3", "q", DAY(2022, 2, 10), D("0.00"), "m"), ("h4", "q", DAY(2022, 2, 20), D("5.00"), "m")],
        "historico_id string, produto_id string, valid_from date, "
        "custo_padrao_novo decimal(18,2), motivo_alteracao string")
    got = {r.historico_id: r for r in scd2.scd2_build(events).collect()}
    assert (got["h1"].valid_to, got["h1"].is_current) == (DAY(2022, 6, 30), False)
    assert (got["h2"].valid_to, got["h2"].is_current) == (OPEN, True)
    assert (got["h2"].custo_padrao_anterior, got["h2"].variacao_pct) == (D("10.00"), D("0.2000"))
    assert got["h1"].custo_padrao_anterior is None and got["h4"].variacao_pct is None


def test_build_with_missing_products_and_equal_days(spark):
    """4,000 events without product over several partitions: one chain, one current
    version; of events of one day the highest id holds."""
    days = spark.range(0, 4000, 1, 8).select(
        F.lpad(F.col("id").cast("string"), 5, "0").alias("historico_id"), F.lit(None).cast("string").alias("produto_id"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 1000).cast("int")).alias("valid_from"),
        F.col("id").cast("decimal(18,2)").alias("custo_padrao_novo"), F.lit("m").alias("motivo_alteracao"))
    got = scd2.scd2_build(days).orderBy("valid_from").collect()
    assert len(got) == 1000 and [r.historico_id for r in got[:2]] == ["03000", "03001"]
    assert [r.is_current for r in got] == [False] * 999 + [True]
    assert all(a.valid_to == b.valid_from - dt.timedelta(days=1) for a, b in zip(got, got[1:]))
    assert all(r.valid_to >= r.valid_from for r in got)
