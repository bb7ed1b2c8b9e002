"""One key holds a third of all rows: same results as the plain formulation."""

import pytest
from pyspark.sql import functions as F

from castledger.operators import intermediate, marts, quality, scd2

HOT = "id % 3 = 0"


@pytest.fixture(scope="module")
def sales(spark):
    money = "decimal(18,2)"
    return spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("v"), F.col("id"))).otherwise("copied")
        .alias("venda_id"),
        F.when(F.expr(HOT), "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 500)).alias("produto_id"),
        F.when(F.expr(HOT), "LP01").otherwise(F.concat(F.lit("LP0"), F.col("id") % 4 + 1))
        .alias("linha_producao_id"),
        F.date_add(F.lit("2022-01-01").cast("date"), (F.col("id") * 13 % 365).cast("int"))
        .alias("data_emissao"),
        (F.col("id") % 17 + 1).alias("quantidade"),
        (F.col("id") % 1000 / 7).cast(money).alias("valor_bruto"),
        (F.col("id") % 1000 / 9).cast(money).alias("valor_liquido"),
    ).withColumn("ano", F.lit(2022).cast("bigint")).withColumn(
        "mes", F.month("data_emissao").cast("bigint"))


@pytest.fixture(scope="module")
def costs(sales):
    unit = (F.abs(F.hash("produto_id", "mes")) % 5000 / 100).cast("decimal(18,2)")
    known = sales.select("produto_id", "ano", "mes").distinct().where("produto_id <> 'p1'")
    return known.select(
        "*", unit.alias("custo_total_unitario"), unit.alias("custo_materia_prima"),
        unit.alias("custo_mao_obra_direta"), unit.alias("custo_indireto_fabricacao"))


def test_cost_of_goods(sales, costs):
    got = intermediate.int_cmv_mensal(sales, costs).select(
        "ano", "mes", "linha_producao_id", "cmv_total", "qtd_total_vendida", "qtd_produtos")
    want = sales.join(costs, ["produto_id", "ano", "mes"]).groupBy(
        "ano", "mes", "linha_producao_id").agg(
        F.sum(F.col("quantidade") * F.col("custo_total_unitario")).alias("cmv_total"),
        F.sum("quantidade").alias("q"), F.count_distinct("produto_id").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_hot_product_is_folded_before_the_shuffle(sales):
    """After the map-side combine a product is one row per task, month and line."""
    plan = intermediate.product_months(sales)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_sum")  # printed top down


def test_margin_rank(sales, costs, spark):
    products = spark.createDataFrame(
        [], "produto_id string, produto_nome string, linha_producao_nome string, "
        "custo_padrao_unitario decimal(18,2)")
    ranked = marts.mart_margem_produto(marts.product_margins(sales, costs, products))
    by_month = {}
    for r in ranked.collect():
        by_month.setdefault(r.mes, []).append(r)
    for rows in by_month.values():
        want = sorted(rows, key=lambda r: (-r.margem_bruta, r.produto_id, r.linha_producao_id))
        assert [r.ranking_margem_mes for r in want] == list(range(1, len(rows) + 1))


def test_deduplication(sales):
    kept = quality.deduplicate(sales, "venda_id", ["data_emissao", "produto_id"])
    assert kept.count() == sales.select("venda_id").distinct().count()
    first = kept.where("venda_id = 'copied'").first()
    assert first.data_emissao == sales.where("venda_id = 'copied'").agg(
        F.min("data_emissao")).first()[0]


def test_point_in_time_lookup(spark, sales):
    """The hot product also has a new version every day."""
    days = spark.range(365).select(
        F.concat(F.lit("h"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("historico_id"),
        F.lit("hot").alias("produto_id"),
        F.date_add(F.lit("2022-01-01").cast("date"), F.col("id").cast("int")).alias("valid_from"),
        (F.col("id") + 1).cast("decimal(18,2)").alias("custo_padrao_novo"),
    ).withColumn("valid_to", F.col("valid_from"))
    facts = sales.select("venda_id", "produto_id", "data_emissao")
    for lookup in (scd2.lookup_asof, scd2.lookup_between):
        found = lookup(facts, "data_emissao", days)
        assert found.count() == facts.count()
        wrong = found.where(
            (F.col("produto_id") == "hot")
            & (F.col("custo_padrao_vigente") != F.dayofyear("data_emissao")))
        missing = found.where("produto_id = 'hot' and custo_padrao_vigente is null")
        assert wrong.count() == 0 and missing.count() == 0


def test_rows_without_key_are_not_duplicates(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4)], "k string, v int")
    assert sorted(map(tuple, quality.deduplicate(df, "k", ["v"]).collect()), key=repr) == sorted(
        [(None, 1), (None, 2), ("a", 3)], key=repr)


def test_revenue_counts_expand_no_rows(sales):
    columns = sales.withColumns({c: F.lit(1) for c in ("valor_desconto", "devolucao_valor", "cliente_id")})
    plan = intermediate.int_receita_liquida(columns)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
