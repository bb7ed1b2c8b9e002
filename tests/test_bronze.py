import datetime as dt
import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from castledger.operators import quality
from castledger.plans import medallion
from castledger.plans.models import MARTS, Models
from castledger.sources import bronze
from castledger.sources.bronze import PART_MONTH, Layers
from castledger.sources.registry import INGESTED_AT, SPECS, TABLES
from castledger.sources.testdata import TestData
from castledger.streaming import incremental

LAYERS = Layers("t_bronze", "t_silver", "t_gold")
CLOCK = dt.datetime(2025, 2, 3, 4, 5, 6, tzinfo=dt.timezone.utc)
# The test files are smaller than production; the thresholds are tested apart.
SMALL = [replace(t, min_rows=1) for t in TABLES]


@pytest.fixture(scope="module")
def landing(spark, folder):
    """The nine raw files, written once."""
    target = tempfile.mkdtemp(prefix="castledger-landing-")
    data = TestData(spark, folder)
    for t in TABLES:
        df = getattr(data, t.table)()
        if t.partition and dict(df.dtypes)[t.partition] == "date":
            df = df.withColumn(t.partition, F.col(t.partition).cast("timestamp"))
        df.write.parquet(f"{target}/{t.file}")
    return target


@pytest.fixture(scope="module")
def built(spark, landing):
    return medallion.run(spark, landing, LAYERS, loaded_at=CLOCK, tables=SMALL)


def test_full_run_equals_direct_models(spark, folder, built):
    direct = Models(TestData(spark, folder).raw)
    for mart in MARTS:
        stored = spark.table(f"t_gold.{mart}").drop(INGESTED_AT)
        lazy = direct.get(mart).select(stored.columns)
        assert stored.count() == lazy.count() > 0
        assert stored.exceptAll(lazy).count() == 0, mart


def test_declared_checks_run_on_stored_models(built):
    report = medallion.check(built)
    assert report.count() == 75
    failing = {(r.check_name, r.table_name, r.column_name)
               for r in report.where("failing_rows > 0").collect()}
    # the test files hold null sale ids and unclean expense classes on purpose
    assert failing == {("not_null", "raw_vendas", "venda_id"),
                       ("accepted_values", "raw_despesas", "classificacao_dre")}


def test_reload_replaces_rows(spark, landing, built):
    spec = SPECS["raw_vendas"]
    before = spark.table("t_bronze.raw_vendas").count()
    later = CLOCK + dt.timedelta(days=1)
    bronze.load_table(spark, landing, spec, LAYERS, later)
    table = spark.table("t_bronze.raw_vendas")
    assert table.count() == before
    assert [r[0] for r in table.select(INGESTED_AT).distinct().collect()] == [
        later.replace(tzinfo=None)]


def test_report_counts_rows_and_bytes(spark, landing, built):
    landed = Layers("r_bronze", "r_silver", "r_gold")
    rows = {r.tabela: r for r in bronze.ingest(spark, landing, landed, CLOCK, SMALL).collect()}
    assert len(rows) == 9 and all(r.bytes > 0 for r in rows.values())
    for name, row in rows.items():
        assert row.registros == spark.table(f"r_bronze.{name}").count() == spark.table(f"t_bronze.{name}").count()


def test_description_is_stored(spark, built):
    text = spark.sql("DESCRIBE TABLE EXTENDED t_bronze.raw_vendas").where(
        "col_name = 'Comment'").first().data_type
    assert text == SPECS["raw_vendas"].description


def test_date_filter_prunes_month_partitions(spark, built):
    table = spark.table("t_bronze.raw_vendas")
    df = bronze.between_dates(table, "data_emissao", dt.date(1996, 3, 10), dt.date(1996, 4, 20))
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert PART_MONTH in filters
    plain = table.where(F.col("data_emissao").cast("date").between(
        dt.date(1996, 3, 10), dt.date(1996, 4, 20)))
    assert df.count() == plain.count() > 0


def test_files_are_clustered(spark, landing):
    spec = SPECS["raw_vendas"]
    df = bronze.add_audit(bronze.read_raw(spark, landing, spec), CLOCK)
    laid = bronze.arrange(df, spec).withColumn("_p", F.spark_partition_id()).collect()
    keys = [(r._p, r[PART_MONTH], r.produto_id, r.cliente_id) for r in laid]
    assert keys == sorted(keys, key=lambda k: (k[0], k[1], k[2], k[3] or ""))


def test_partitioning_needs_a_temporal_column(spark):
    text = spark.createDataFrame([("2022-01-01",)], "data_emissao string")
    assert not bronze.is_month_partitioned(text, SPECS["raw_vendas"])
    assert PART_MONTH not in bronze.arrange(text, SPECS["raw_vendas"]).columns


def test_date_coercion_is_all_or_nothing(spark):
    df = spark.createDataFrame(
        [("2022-01-05", "2022-01-05", None, "2022-01-05", 1), (None, "n/d", None, "x", 2)],
        "data_ok string, update_text string, vigencia_nula string, outro string, data_num int")
    got = dict(bronze.coerce_dates(df).dtypes)
    assert got == {"data_ok": "timestamp", "update_text": "string", "vigencia_nula": "timestamp",
                   "outro": "string", "data_num": "int"}


def test_declared_schema_scan(spark, landing):
    df = bronze.read_raw(spark, landing, SPECS["raw_vendas"], declared=True)
    assert df.schema == SPECS["raw_vendas"].schema and df.count() > 0


def test_export_writes_both_formats(spark):
    target = tempfile.mkdtemp(prefix="castledger-export-")
    df = spark.createDataFrame([("ç", 1), (None, 2)], "a string, b int")
    bronze.export(df, target, "t")
    bronze.export(df, target, "t")
    assert spark.read.parquet(f"{target}/parquet/t").count() == 2
    back = spark.read.option("header", True).schema("a string, b int").csv(f"{target}/csv/t")
    assert sorted(back.collect(), key=lambda r: r.b) == sorted(df.collect(), key=lambda r: r.b)


def test_thresholds_are_reported(spark, built):
    report = quality.min_rows(bronze.bronze_source(spark, LAYERS))
    status = {r.tabela: r.status for r in report.collect()}
    assert status["raw_vendas"] == "ALERTA" and status["raw_produtos"] == "OK"


def test_reading_order(spark, built):
    rows = medallion.ordered(spark, "mart_dre_mensal", LAYERS).select("ano", "mes").collect()
    assert rows == sorted(rows)


def test_incremental_load_takes_each_file_once(spark, landing):
    base = tempfile.mkdtemp(prefix="castledger-stream-")
    spec = SPECS["raw_vendas"]
    sales = bronze.read_raw(spark, landing, spec)
    early, late = sales.where("data_emissao < '1998-01-01'"), sales.where("data_emissao >= '1998-01-01'")

    early.coalesce(2).write.parquet(f"{base}/in/a")
    first = _load(spark, spec, base)
    assert first.count() == early.count()
    late.coalesce(1).write.parquet(f"{base}/in/b")
    second = _load(spark, spec, base)
    assert second.count() == sales.count()
    assert _load(spark, spec, base).count() == sales.count()
    assert PART_MONTH in second.columns
    assert second.select(INGESTED_AT).distinct().count() == 2


def _load(spark, spec, base):
    query = incremental.load_new_files(
        spark, spec, f"{base}/in/*", f"{base}/out", f"{base}/checkpoint")
    query.awaitTermination(120)
    return incremental.loaded(spark, f"{base}/out")


def test_failed_load_leaves_the_old_table(spark, built):
    before = spark.table("t_bronze.raw_produtos").count()
    broken = spark.table("t_bronze.raw_produtos").withColumn("produto_id", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        bronze.write_table(spark, broken, "t_bronze.raw_produtos", "d")
    assert spark.table("t_bronze.raw_produtos").count() == before > 0


def test_all_failures_are_reported_and_other_tables_loaded(spark, landing, built, tmp_path):
    later = CLOCK + dt.timedelta(days=3)
    missing = [replace(SPECS[t], file="absent") for t in ("raw_custos", "raw_despesas")]
    with pytest.raises(bronze.LoadError, match="raw_custos.*raw_despesas"):
        bronze.ingest(spark, landing, LAYERS, later, [*missing, SPECS["raw_clientes"]])
    stamps = spark.table("t_bronze.raw_clientes").select(INGESTED_AT).distinct().collect()
    assert [r[0] for r in stamps] == [later.replace(tzinfo=None)]


def test_models_read_only_the_months_asked_for(spark, built):
    source = bronze.bronze_source(spark, LAYERS, dt.date(1996, 3, 1), dt.date(1996, 4, 30))
    df = source("raw_vendas")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert PART_MONTH in plan[plan.index("PartitionFilters"):].split("]")[0] and PART_MONTH not in df.columns
    months = {r[0] for r in df.select(F.date_format("data_emissao", "yyyy-MM")).distinct().collect()}
    assert months == {"1996-03", "1996-04"}
    assert source("raw_produtos").count() == spark.table("t_bronze.raw_produtos").count()
