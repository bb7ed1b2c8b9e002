from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from castledger.functions import expr as E


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("raw, want", [
    (1.005, "1.01"), (0.285, "0.29"), (2.675, "2.68"), (-2.345, "-2.35"),
    (1.0049999999999999, "1.01"), (12.344, "12.34"), (None, None)])
def test_money_rounds_halves_away_from_zero(spark, raw, want):
    got = value(spark, E.money(F.lit(raw).cast("double")))
    assert got == (None if want is None else D(want))


@pytest.mark.parametrize("raw, want", [
    (2.5, 3), (3.7, 4), (-2.5, -3), (0.4, 0), (None, None)])
def test_int_round_does_not_truncate(spark, raw, want):
    assert value(spark, E.int_round(F.lit(raw).cast("double"))) == want


def test_trim_strips_all_unicode_spaces(spark):
    padded = "\t  a b 　 \n"
    assert value(spark, E.trim_all(F.lit(padded))) == "a b"
    assert value(spark, E.upper_trim(F.lit(" pção "))) == "PÇÃO"


def test_pct_is_null_on_zero_and_rounds_once(spark):
    part, whole = F.lit("123449999").cast(E.TOTAL), F.lit("1000000000").cast(E.TOTAL)
    assert value(spark, E.pct(part, whole)) == D("12.34")
    assert value(spark, E.pct(part, F.lit(0).cast(E.TOTAL))) is None
    assert value(spark, E.pct(F.lit(None).cast(E.TOTAL), whole)) is None


def test_pct_matches_exact_integers(spark):
    rows = [(a * 7919 % 100003 - 50000, b * 104729 % 99991 + 1)
            for a in range(60) for b in range(60)]
    df = spark.createDataFrame(rows, "a bigint, b bigint").select(
        "a", "b", E.pct((F.col("a") / 100).cast(E.TOTAL), (F.col("b") / 100).cast(E.TOTAL))
        .alias("p"))

    def exact(a, b):
        q = (20000 * abs(a) + b) // (2 * b)
        return D(q if a >= 0 else -q).scaleb(-2)

    assert all(r.p == exact(r.a, r.b) for r in df.collect())


def test_not_below_zero_keeps_null(spark):
    assert value(spark, E.not_below_zero(F.lit(None).cast(E.TOTAL4))) is None
    assert value(spark, E.not_below_zero(F.lit("-3.5").cast(E.TOTAL4))) == 0
    assert value(spark, E.not_below_zero(F.lit("3.5").cast(E.TOTAL4))) == D("3.5")


def test_decimal_literal_keeps_products_decimal(spark):
    df = spark.range(1).select((F.lit(1).cast(E.TOTAL) * E.dec("0.34")).alias("x"))
    assert df.dtypes[0][1].startswith("decimal")


def test_growth_on_negative_base(spark):
    now, before = F.lit(5).cast(E.TOTAL), F.lit(-10).cast(E.TOTAL)
    assert value(spark, E.growth_pct(now, before, True)) == D("150.00")
    assert value(spark, E.growth_pct(now, before, False)) == D("-150.00")


def test_dates(spark):
    day = F.lit("2023-11-17").cast("date")
    assert str(value(spark, E.month_start(day))) == "2023-11-01"
    assert value(spark, E.month_index(day, 2022)) == 22
    assert str(value(spark, E.first_of_month(F.lit(2024), F.lit(2)))) == "2024-02-01"


def test_company_totals_do_not_overflow(spark):
    df = spark.range(1000).select(F.lit("300000000000000.00").cast(E.MONEY).alias("m"))
    assert df.agg(E.total("m").alias("t")).first().t == D("300000000000000000.00")


def test_formatted_ids(spark):
    from castledger.functions.expr import formatted_id
    rows = spark.createDataFrame([(7,), (12345678,), (None,)], "n long").select(
        formatted_id("VND", "n", 7).alias("x"), formatted_id("PROD", "n", 4).alias("y")).collect()
    assert [tuple(r) for r in rows] == [("VND-0000007", "PROD-0007"), ("VND-12345678", "PROD-12345678"), (None, None)]
