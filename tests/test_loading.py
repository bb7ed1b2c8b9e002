"""Quarantine, date votes, measured loads, sketches, buckets and checks made while writing."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from castledger.operators import quality, sketches
from castledger.operators.intermediate import MONTH_LINE
from castledger.plans import medallion
from castledger.plans.models import Models
from castledger.session import shared_folder
from castledger.sources import bronze, quarantine
from castledger.sources.bronze import Layers
from castledger.sources.registry import INGESTED_AT, SPECS
from castledger.sources.testdata import TestData

CLOCK = dt.datetime(2025, 2, 3, tzinfo=dt.timezone.utc)
EXPENSES = SPECS["raw_despesas"]


def feed(spark):
    return spark.createDataFrame([
        ("d1", "2024-01-31", "X", "n", "C", "10.50"), ("d2", "31/01/2024", "X", "n", "C", "1,5"),
        (" ", "2024-02-30", "X", "n", "C", "7"), ("d4", "", None, "n", "C", " "),
        ("d5", " 2024-03-01 10:20:30 ", "X", "n", "C", "NaN"), ("d6", "2024-03-01", "X", "n", "C", "1e400")],
        "despesa_id string, MES_REFERENCIA string, centro_custo_tipo string, natureza string, classificacao_dre string, valor string")


def test_bad_values_are_set_aside_with_their_reason(spark):
    got = quarantine.load(spark, feed(spark), EXPENSES, tempfile.mkdtemp(prefix="castledger-q-"))
    assert [f.name for f in got.accepted.schema] == EXPENSES.schema.names
    assert {(r.despesa_id, r.mes_referencia, r.valor) for r in got.accepted.collect()} == {
        ("d1", dt.datetime(2024, 1, 31), 10.5), ("d4", None, None)}
    problems = sorted((r.coluna, r.valor, r.motivo) for r in got.rejected.collect())
    assert problems == sorted([
        ("mes_referencia", "31/01/2024", "NOT_A_DATE"), ("valor", "1,5", "NOT_A_NUMBER"), ("despesa_id", " ", "MISSING_KEY"),
        ("mes_referencia", "2024-02-30", "NOT_A_DATE"), ("valor", "NaN", "NOT_A_NUMBER"), ("valor", "1e400", "NOT_A_NUMBER")])
    assert got.rejected_rows.count() == 4 == feed(spark).count() - got.accepted.count()


def test_other_patterns_and_missing_columns(spark):
    raw = spark.createDataFrame([("d2", "31/01/2024", "2")], "despesa_id string, mes_referencia string, valor string")
    got = quarantine.load(spark, raw, EXPENSES, tempfile.mkdtemp(prefix="castledger-q-"), ["dd/MM/yyyy"]).accepted.first()
    assert got.mes_referencia == dt.datetime(2024, 1, 31) and got.natureza is None and got.valor == 2.0


@pytest.mark.parametrize("table", ["raw_centros_custo", "raw_orcamento", "raw_historico_custos"])
def test_flags_and_whole_numbers(spark, table):
    spec = SPECS[table]
    good = {"boolean": "true", "bigint": "7", "double": "1.5", "timestamp": "2024-01-01", "string": "k"}
    types = {f.name: f.dataType.simpleString() for f in spec.schema}
    rows = [tuple(good[t] for t in types.values()), tuple("k" if t == "string" else "?" for t in types.values())]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in types))
    got = quarantine.load(spark, raw, spec, tempfile.mkdtemp(prefix="castledger-q-"))
    assert got.accepted.count() == 1 and got.rejected_rows.count() == 1
    assert {r.coluna for r in got.rejected.collect()} == {c for c, t in types.items() if t != "string"}


def test_a_column_adopts_the_pattern_that_loses_nothing(spark):
    df = spark.createDataFrame(
        [("05/01/2022", "01/25/2022", "20220105", "05/01/2022", "05/01/2022", "2022-01-05 10:00:00"),
         ("31/12/2022", "12/01/2022", "20221231", "2022-01-05", "n/d", "2022-12-31 23:59:59"),
         (None, None, None, None, None, None)],
        "data_dia string, data_mes string, data_junta string, data_mista string, data_ruim string, data_hora string")
    got = bronze.coerce_dates(df)
    kinds = dict(got.dtypes)
    assert [c for c, t in kinds.items() if t == "string"] == ["data_mista", "data_ruim"]
    first = got.first()
    assert first.data_dia == dt.datetime(2022, 1, 5) and first.data_mes == dt.datetime(2022, 1, 25)
    assert first.data_junta == dt.datetime(2022, 1, 5) and first.data_hora == dt.datetime(2022, 1, 5, 10)
    votes = bronze.date_votes(df, ["data_mista"], ["yyyy-MM-dd", "dd/MM/yyyy"])
    assert votes == {"data_mista": {"yyyy-MM-dd": 1, "dd/MM/yyyy": 1}}


def test_an_ambiguous_column_reads_day_first(spark):
    got = bronze.coerce_dates(spark.createDataFrame([("05/01/2022",)], "data string"))
    assert got.first().data == dt.datetime(2022, 1, 5)


def test_the_load_report_equals_a_recount(spark, folder):
    layers = Layers("m_bronze", "m_silver", "m_gold")
    data = TestData(spark, folder)
    tables = [SPECS[t] for t in ("raw_vendas", "raw_produtos", "raw_commodities")]
    report = {r.tabela: r for r in bronze.ingest_from(
        spark, lambda s: getattr(data, s.table)(), layers, CLOCK, tables).collect()}
    for spec in tables:
        stored, line = spark.table(f"m_bronze.{spec.table}"), report[spec.table]
        assert line.registros == stored.count() and line.sem_carga == 0 and line.bytes > 0
        assert line.chaves_nulas == (stored.where(F.col(spec.key).isNull()).count() if spec.key else 0)
        if spec.partition:
            assert (line.primeira_data, line.ultima_data) == tuple(stored.agg(
                F.min(F.col(spec.partition).cast("date")), F.max(F.col(spec.partition).cast("date"))).first())
        else:
            assert line.primeira_data is None


def test_sketches_merge_upward(spark, folder):
    sales = Models(TestData(spark, folder).raw).get("stg_vendas")
    months = sketches.sales_sketches(sales)
    for by in (MONTH_LINE, ["ano"], []):
        rows = sketches.compared(sales, by, months).collect()
        assert rows and all(r.dentro_do_limite for r in rows)
    year = sketches.estimates(sketches.rolled_up(sketches.rolled_up(months, ["ano", "mes"]), ["ano"]))
    assert year.columns == ["ano", "receita_bruta", "qtd_pecas_vendidas", *sketches.COUNTED.values()]
    exact = {r.ano: r.v for r in sales.groupBy("ano").agg(F.sum("valor_bruto").alias("v")).collect()}
    assert {r.ano: r.receita_bruta for r in year.collect()} == exact


def test_a_large_sketch_keeps_its_bound(spark):
    rows = spark.range(400_000).select(
        (F.col("id") % 3 + 2020).alias("ano"), F.lit(1).cast("bigint").alias("mes"), F.lit("L").alias("linha_producao_id"),
        F.lit(1).cast("decimal(18,2)").alias("valor_bruto"), F.lit(1).cast("bigint").alias("quantidade"),
        F.col("id").cast("string").alias("venda_id"), (F.col("id") % 90_000).cast("string").alias("produto_id"),
        (F.col("id") % 2).cast("string").alias("cliente_id"))
    (row,) = sketches.compared(rows, [], sketches.sales_sketches(rows)).collect()
    assert row.dentro_do_limite and (row.qtd_vendas, row.qtd_produtos_vendidos, row.qtd_clientes) == (400_000, 90_000, 2)
    assert row.qtd_vendas_aprox != row.qtd_vendas  # it is an estimate


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_an_exchange(spark, folder):
    layers = Layers("b_bronze", "b_silver", "b_gold")
    layers.create(spark)
    direct, stored = Models(TestData(spark, folder).raw), Models(TestData(spark, folder).raw)
    for _ in range(2):  # a second store replaces the first
        medallion.store_bucketed(spark, Models(TestData(spark, folder).raw), 4, layers)
    for name in medallion.BUCKETED:
        stored.store(name, spark.table(f"b_silver.{name}"))
    plan = plan_of(stored.get("int_cmv_mensal"))
    below = plan[plan.index("SortMergeJoin"):]
    assert "Exchange" not in below and "Bucketed: true" in below and plan.count("Exchange") == 1
    joined = plan_of(stored.get("product_margins"))
    assert "Exchange hashpartitioning(ano" not in joined
    for name in ("int_cmv_mensal", "product_margins"):
        got, want = stored.get(name), direct.get(name)
        assert got.count() == want.count() > 0 and got.exceptAll(want.select(got.columns)).count() == 0
    comment = spark.sql("DESCRIBE TABLE EXTENDED b_silver.stg_vendas").where("col_name = 'Comment'").first().data_type
    assert comment == medallion.BUCKETED["stg_vendas"]


def test_checks_made_while_writing_equal_a_pass(spark):
    rows = spark.createDataFrame([("p", 1, 1, "SAUDAVEL"), (None, 1, None, "x"), ("q", 2, 2, None)],
                                 "produto_id string, ano int, mes int, status_margem string")
    watched, found = quality.observed(rows, "mart_margem_produto")
    watched.write.mode("overwrite").parquet(tempfile.mkdtemp(prefix="castledger-o-") + "/t")
    assert found.get["rows"] == 3 and found.get["not_null.produto_id"] == 1 and found.get["accepted_values.status_margem"] == 1

    def source(name):
        return rows if name == "mart_margem_produto" else spark.createDataFrame(
            [], ", ".join(f"{c} string" for c in {*quality.NOT_NULL.get(name, ()), *quality.ACCEPTED_VALUES.get(name, {})}))

    passed = sorted(map(tuple, quality.column_checks(source).collect()))
    assert passed == sorted(map(tuple, quality.column_checks(source, {"mart_margem_produto": found.get}).collect()))
    assert passed == sorted(map(tuple, quality.dq_not_null(source).union(quality.dq_accepted_values(source)).collect()))
    assert len(passed) == 59


class Session:
    """A stand-in with a setting or without."""

    def __init__(self, master, **settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda name, default=None: settings.get(name, default))})


def test_the_shared_folder():
    warehouse = {"spark.sql.warehouse.dir": "/w"}
    assert shared_folder(Session("yarn", **{"spark.checkpoint.dir": "hdfs:/c"}, **warehouse)) == "hdfs:/c"
    assert shared_folder(Session("local[4]", **warehouse)) == "/w/_scratch"
    for master in ("yarn", "local-cluster[2,1,1024]"):  # the warehouse may be the driver's own disk
        with pytest.raises(ValueError):
            shared_folder(Session(master, **warehouse))
