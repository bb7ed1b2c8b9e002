"""Upserts by month, the rebuild of touched months, and the merged cost history."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castledger.operators import scd2
from castledger.plans.models import Models
from castledger.plans.refresh import MONTHLY, MonthlyModels
from castledger.sources.registry import INGESTED_AT, SPECS
from castledger.sources.testdata import TestData
from castledger.streaming import upsert
from castledger.streaming.history import HistoryStore
from castledger.streaming.upsert import MonthStore, apply_batch, upsert_new_files

SALES = SPECS["raw_vendas"]
NOW = dt.datetime(2025, 1, 1)


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="castledger-upsert-")


def batch(spark, *rows):
    """Sales from (id, day, gross value); all else is NULL."""
    schema = T.StructType([*SALES.schema.fields, T.StructField(INGESTED_AT, T.TimestampType())])
    values = {"venda_id": 0, "data_emissao": 1, "valor_bruto": 2}
    return spark.createDataFrame([
        tuple(r[values[f.name]] if f.name in values else NOW if f.name == INGESTED_AT else None for f in schema)
        for r in rows], schema)


def held(store, spark):
    return sorted(((r.venda_id, r.data_emissao and r.data_emissao.date(), r.valor_bruto) for r in store.rows(spark).collect()),
                  key=repr)


def day(month, d=5, year=2024):
    return dt.datetime(year, month, d)


def test_a_batch_replaces_what_it_delivers_again(spark, root):
    store = MonthStore(root, SALES)
    apply_batch(batch(spark, ("a", day(1), 1.0), ("b", day(1), 2.0), ("c", day(2), 3.0), (None, day(2), 4.0)), "1", store)
    months = apply_batch(batch(spark, ("b", day(1), 20.0), ("d", day(1), 5.0), (None, day(3), 6.0)), "2", store)
    assert sorted(months) == [dt.date(2024, 1, 1), dt.date(2024, 3, 1)]
    assert held(store, spark) == sorted([
        ("a", day(1).date(), 1.0), ("b", day(1).date(), 20.0), ("c", day(2).date(), 3.0), ("d", day(1).date(), 5.0),
        (None, day(2).date(), 4.0), (None, day(3).date(), 6.0)], key=repr)


def test_a_row_that_changes_its_month_leaves_the_old_one(spark, root):
    store = MonthStore(root, SALES)
    apply_batch(batch(spark, ("a", day(1), 1.0), ("b", day(2), 2.0)), "1", store)
    months = apply_batch(batch(spark, ("a", day(4), 1.5), ("n", None, 7.0)), "2", store)
    assert set(months) == {dt.date(2024, 1, 1), dt.date(2024, 4, 1), None}
    assert held(store, spark) == sorted([("a", day(4).date(), 1.5), ("b", day(2).date(), 2.0), ("n", None, 7.0)], key=repr)
    apply_batch(batch(spark, ("n", day(2), 8.0)), "3", store)
    assert ("n", None, 7.0) not in held(store, spark) and len(held(store, spark)) == 3


def test_of_one_key_the_latest_row_of_a_batch_wins(spark, root):
    store = MonthStore(root, SALES)
    apply_batch(batch(spark, ("a", day(1), 9.0), ("a", day(2), 1.0), ("a", day(2), 2.0)), "1", store)
    assert held(store, spark) == [("a", day(2).date(), 2.0)]


def test_only_rows_whose_key_repeats_are_folded(spark, root):
    """A maximum of structs sorts all its rows: batches without repeated keys pass as they are."""
    store = MonthStore(root, SALES)
    rows = batch(spark, ("a", day(1), 1.0), ("b", day(1), 2.0), (None, day(1), 3.0), (None, day(1), 3.0))
    whole = upsert._newest(rows, store, f"{root}/once")
    assert "Aggregate" not in whole._jdf.queryExecution().toString() and whole.count() == 4
    folded = upsert._newest(rows.union(batch(spark, ("b", day(2), 1.0))), store, f"{root}/twice")
    assert sorted(((r.venda_id, r.valor_bruto) for r in folded.collect()), key=repr) == [
        ("a", 1.0), ("b", 1.0), (None, 3.0), (None, 3.0)]


def test_costs_of_one_small_file_of_products_are_made_by_several_tasks(spark, folder):
    assert TestData(spark, folder).raw_custos().select(F.spark_partition_id()).distinct().count() > 1


def test_a_replayed_batch_changes_nothing(spark, root):
    store = MonthStore(root, SALES)
    rows = batch(spark, ("a", day(1), 1.0), (None, day(1), 2.0))
    assert apply_batch(rows, "1", store) == apply_batch(rows, "1", store) == [dt.date(2024, 1, 1)]
    assert len(held(store, spark)) == 2


@pytest.mark.parametrize("step", ["stage", "publish", "log"])
def test_a_batch_that_failed_half_way_counts_once(spark, root, monkeypatch, step):
    """The driver stops after staging, while publishing, or before the log."""
    store = MonthStore(root, SALES)
    apply_batch(batch(spark, ("a", day(1), 1.0), (None, day(1), 2.0)), "1", store)
    rows = batch(spark, ("a", day(1), 3.0), (None, day(1), 4.0), ("b", day(2), 5.0))
    with monkeypatch.context() as patched:
        if step == "stage":
            patched.setattr(upsert, "overwrite_months", lambda *a: 1 / 0)
        elif step == "publish":
            whole = upsert.overwrite_months
            patched.setattr(upsert, "overwrite_months", lambda s, r, f, months: (
                upsert.delete(s, f"{f}/{upsert.partition_folder(months[0])}"), 1 / 0))
        else:
            patched.setattr(MonthStore, "_log", lambda self, name: 1 / 0 if name == "2" and done else whole_log(self, name))
            whole_log, done = lambda self, name: f"{self.root}/{self.spec.table}/log/batch={name}", []
            whole = upsert.overwrite_months
            patched.setattr(upsert, "overwrite_months", lambda *a: (whole(*a), done.append(1)))
        with pytest.raises(ZeroDivisionError):
            apply_batch(rows, "2", store)
    apply_batch(rows, "2", store)
    assert held(store, spark) == sorted([("a", day(1).date(), 3.0), (None, day(1).date(), 2.0), (None, day(1).date(), 4.0),
                                         ("b", day(2).date(), 5.0)], key=repr)


def test_untouched_months_are_not_written(spark, root):
    store = MonthStore(root, SALES)
    apply_batch(batch(spark, ("a", day(1), 1.0), ("b", day(2), 2.0)), "1", store)
    before = {r[0] for r in store.rows(spark).where("month(data_emissao) = 2").select(F.input_file_name()).collect()}
    apply_batch(batch(spark, ("c", day(1), 3.0)), "2", store)
    after = {r[0] for r in store.rows(spark).where("month(data_emissao) = 2").select(F.input_file_name()).collect()}
    assert before == after


def test_a_table_without_month_or_key_is_refused(spark, root):
    for table in ("raw_produtos", "raw_commodities"):
        with pytest.raises(ValueError):
            apply_batch(batch(spark), "1", MonthStore(root, SPECS[table]))


def test_an_empty_batch(spark, root):
    store = MonthStore(root, SALES)
    assert apply_batch(batch(spark), "1", store) == []
    assert held(store, spark) == []


# -- models -------------------------------------------------------------------

def stores(root):
    return [MonthStore(root, SPECS[t], k) for t, k in (
        ("raw_vendas", ()), ("raw_custos", ("produto_id", "mes_referencia")), ("raw_despesas", ()))]


def test_files_one_by_one_equal_a_full_run(spark, folder, root):
    data = TestData(spark, folder)
    sales, costs, expenses = stores(root)
    for store in (costs, expenses):
        apply_batch(data.raw(store.spec.table).to(T.StructType([
            *store.spec.schema.fields, T.StructField(INGESTED_AT, T.TimestampType())])), "first", store)
    built = MonthlyModels(spark, f"{root}/gold", [sales, costs, expenses], data.raw)
    rows = data.raw_vendas().to(sales.spec.schema)
    wrong = (F.month("data_emissao") == 3) & (F.year("data_emissao") == 1996)
    late = (F.month("data_emissao") == 4) & (F.year("data_emissao") == 1997)
    parts = [rows.where(~late).withColumn("valor_bruto", F.when(wrong, F.col("valor_bruto") + 10).otherwise(F.col("valor_bruto"))),
             rows.where(late), rows.where(wrong)]
    touched = []
    for part in parts:
        part.coalesce(2).write.mode("append").parquet(f"{root}/incoming")
        upsert_new_files(spark, sales, f"{root}/incoming", f"{root}/seen", files_per_batch=1).awaitTermination()
        touched.append(built.refresh())
    assert len(touched[0]) > 80 and touched[1:] == [[dt.date(1997, 4, 1)], [dt.date(1996, 3, 1)]]
    assert built.refresh() == []
    built.rebuild_for("raw_orcamento")  # months that are only planned

    direct = Models(data.raw)
    for name in (*MONTHLY, "mart_kpis_executivo"):
        got, want = built.get(name), direct.get(name)
        got, want = got.drop(INGESTED_AT), want.drop(INGESTED_AT).select(got.drop(INGESTED_AT).columns)
        assert got.count() == want.count() > 0, name
        assert got.exceptAll(want).count() == 0, name


def test_a_month_that_loses_its_rows_leaves_the_models(spark, root):
    store = MonthStore(root, SALES)
    folder = f"{root}/model"
    rows = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 2, 1), 2)], f"{upsert.PART_MONTH} date, n int")
    upsert.overwrite_months(spark, rows, folder, [dt.date(2024, 1, 1), dt.date(2024, 2, 1)])
    upsert.overwrite_months(spark, rows.where("n = 3"), folder, [dt.date(2024, 1, 1)])
    assert [r.n for r in spark.read.parquet(folder).collect()] == [2] and store.key == ["venda_id"]


# -- history ------------------------------------------------------------------

EVENTS = [("h1", "p", dt.date(2024, 1, 1), 10, "A"), ("h3", "p", dt.date(2024, 3, 1), 12, "B"),
          ("h2", "p", dt.date(2024, 2, 1), 11, "C"), ("h4", "p", dt.date(2024, 2, 1), 15, "D"),
          ("h5", "q", dt.date(2024, 1, 15), 7, "A"), ("h6", None, dt.date(2024, 1, 1), 1, "A"),
          ("h7", "r", dt.date(2023, 1, 1), 2, "A"), ("h8", "q", dt.date(2023, 12, 1), 6, "B")]
EVENT_SCHEMA = ("historico_id string, produto_id string, valid_from date, custo_padrao_novo decimal(18,2), "
                "motivo_alteracao string")


def events(spark, rows):
    from decimal import Decimal
    return spark.createDataFrame([(h, p, d, Decimal(c), m) for h, p, d, c, m in rows], EVENT_SCHEMA)


@pytest.mark.parametrize("batches", [
    [[0, 1, 2, 3, 4, 5, 6, 7]], [[0], [1], [2], [3], [4], [5], [6], [7]], [[1, 4], [3, 7], [2, 0, 5], [], [6]],
    [[7, 6, 5, 4], [3, 2], [1, 0]]])
def test_history_step_by_step_equals_the_full_build(spark, root, batches):
    store = HistoryStore(root, parts=4)
    for i, own in enumerate(batches):
        part = events(spark, [EVENTS[k] for k in own])
        written = store.apply(part, str(i))
        assert store.apply(part, str(i)) == written and len(written) <= min(4, len(own))
    want = scd2.scd2_build(events(spark, EVENTS))
    assert sorted(map(repr, store.history(spark).select(want.columns).collect())) == sorted(map(repr, want.collect()))


def test_history_writes_only_parts_of_touched_products(spark, root):
    store = HistoryStore(root, parts=8)
    store.apply(events(spark, EVENTS[:7]), "1")

    def files(product):
        return {r[0] for r in store.history(spark).where(F.col("produto_id") == product).select(F.input_file_name()).collect()}

    before = {p: files(p) for p in "pqr"}
    (part,) = store.apply(events(spark, EVENTS[7:]), "2")
    assert files("q") != before["q"]
    others = [p for p in "pr" if spark.range(1).select(F.pmod(F.xxhash64(F.lit(p)), F.lit(8))).first()[0] != part]
    assert all(files(p) == before[p] for p in others)
