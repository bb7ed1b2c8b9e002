import datetime as dt

import pytest
from pyspark.sql import functions as F

from castledger.operators import quality
from castledger.sources.registry import INGESTED_AT, TABLES, TableSpec

NOW = dt.datetime(2024, 1, 1)


def test_declared_checks_are_complete():
    not_null = sum(len(c) for c in quality.NOT_NULL.values())
    accepted = sum(len(c) for c in quality.ACCEPTED_VALUES.values())
    assert (not_null, len(quality.UNIQUE), accepted, len(quality.RELATIONSHIPS)) == (49, 13, 10, 3)
    assert len(TABLES) == 9


def test_duplicate_keys_ignore_nulls_for_unique(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert {r.k: r.duplicatas for r in quality.duplicate_keys(df, "k").collect()} == {
        "a": 2, None: 2}


def test_deduplicate_keeps_one_whole_row(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 9, None)], "k string, n int, t string")
    got = sorted(quality.deduplicate(df, "k", ["n"]).collect())
    assert [tuple(r) for r in got] == [("a", 1, "y"), ("b", 9, None)]


def test_relationships_count_rows_and_skip_null_keys(spark):
    tables = {
        "stg_vendas": spark.createDataFrame(
            [("p", "c"), ("x", "c"), ("x", None), (None, "c")], "produto_id string, cliente_id string"),
        "stg_custos": spark.createDataFrame([("p",)], "produto_id string"),
        "stg_produtos": spark.createDataFrame([("p",)], "produto_id string"),
        "stg_clientes": spark.createDataFrame([("c",)], "cliente_id string")}
    rows = quality.dq_relationships(tables.get).collect()
    assert [r.failing_rows for r in rows] == [2, 0, 0]


def test_reconciliation_reports_differences(spark):
    df = spark.createDataFrame(
        [(2022, 1, 100.0, 10.0, 5.0, 85.0), (2022, 1, 100.0, 10.0, 5.0, 80.0)],
        "ano bigint, mes bigint, valor_bruto double, valor_desconto double, devolucao_valor double, "
        "valor_liquido double")
    typed = df.select("ano", "mes", *[F.col(c).cast("decimal(18,2)") for c in df.columns[2:]])
    row = quality.net_reconciliation(typed).first()
    assert (row.registros, row.divergentes, row.diferenca) == (2, 1, 5)


def spec(name, rows):
    return TableSpec(name, "", "", TABLES[0].schema, key="k", min_rows=rows)


def test_validation_collects_every_finding_then_raises(spark):
    loaded = spark.createDataFrame([("a", NOW), ("b", None)], f"k string, {INGESTED_AT} timestamp")

    def source(name):
        return loaded if name != "missing" else spark.table("no_such_table")

    report = quality.validate_bronze(source, [spec("few", 5), spec("missing", 1), spec("ok", 2)])
    got = {(r.check_name, r.table_name): r.failing_rows for r in report.collect()}
    assert got == {("min_rows", "few"): 3, ("not_null", "few"): 1, ("readable", "missing"): 1,
                   ("min_rows", "ok"): 0, ("not_null", "ok"): 1}
    with pytest.raises(quality.ValidationError, match="4 check"):
        quality.assert_valid(report)
    quality.assert_valid(report.where("failing_rows = 0"))


def test_a_file_that_fails_while_it_is_read_is_a_finding(spark, tmp_path):
    good, broken = str(tmp_path / "good"), str(tmp_path / "broken")
    rows = spark.createDataFrame([("a", NOW)] * 50, f"k string, {INGESTED_AT} timestamp")
    rows.write.parquet(good)
    rows.coalesce(1).write.parquet(broken)
    (part,) = (tmp_path / "broken").glob("part-*.parquet")
    content = part.read_bytes()
    part.write_bytes(b"\x00" * (len(content) - 400) + content[-400:])  # the footer is intact, the pages are not
    (tmp_path / "broken" / f".{part.name}.crc").unlink()
    schema = rows.schema

    def source(name):
        return spark.read.schema(schema).parquet(broken if name == "bad" else good)

    report = quality.validate_bronze(source, [spec("bad", 1), spec("ok", 2)])
    got = {(r.check_name, r.table_name): r.failing_rows for r in report.collect()}
    assert got == {("readable", "bad"): 1, ("min_rows", "ok"): 0, ("not_null", "ok"): 0}
