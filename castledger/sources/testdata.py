"""The nine raw tables derived from the star-schema test files.

The derivations follow FIXTURES.md. Order and customer attributes hang on
left joins to sides that are unique on the join key, so Catalyst drops those
joins from every query that does not read a customer column, just as it would
prune the columns of a stored sales table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from castledger.functions.expr import dec, month_start
from castledger.sources.registry import INGESTED_AT, SPECS, TableSpec

LOAD_DAY = dt.date(2025, 1, 1)
BASE_YEAR = 1995
QUARTERS = 28

# Discontinued products have neither monthly costs nor cost revisions.
_IS_ACTIVE = "p_partkey % 17 <> 0"


def _d2(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def _r2(c: Column) -> Column:
    return F.round(c, 2).cast("decimal(18,2)")


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _line_of(partkey: str) -> Column:
    return F.concat(F.lit("LP0"), (F.col(partkey) % 4 + 1).cast("string"))


def _cents(c: str) -> Column:
    """A two-digit amount as whole cents (the files hold no finer values)."""
    return F.round(F.col(c) * 100).cast("bigint")


def _standard_cents() -> Column:
    """60 % of the list price, rounded to cents."""
    return F.floor((_cents("p_retailprice") * 60 + 50) / 100)


class TestData:
    """Reads ``{folder}/{name}.parquet`` and serves raw tables by name."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def raw(self, table: str) -> DataFrame:
        return getattr(self, table)().withColumn(INGESTED_AT, self._loaded(SPECS[table]).cast("timestamp"))

    def _loaded(self, spec: TableSpec) -> Column:
        """When a row might have been loaded: dated rows after the end of their
        month (a sale without id never was), budgets in the December before, cost
        revisions when they start, master data on days that follow from the key."""
        def after(c: str) -> Column:
            return F.add_months(month_start(c), 1)

        if spec.table == "raw_vendas":
            return F.when(F.col("venda_id").isNotNull(), after("data_emissao"))
        if spec.table == "raw_orcamento":
            return F.make_date(F.col("ano").cast("int") - 1, F.lit(12), F.lit(1))
        if spec.table == "raw_historico_custos":
            return F.col("data_vigencia_inicio").cast("date")
        if spec.table == "raw_commodities":
            return after("mes")
        return after(spec.partition) if spec.partition else F.date_add(F.lit(LOAD_DAY), F.length(spec.key))

    # -- calendar ---------------------------------------------------------

    def _edge(self, pick) -> Column:
        shipped = self.read("lineitem").agg(pick("l_shipdate").cast("date").alias("d"))
        return F.trunc(shipped.scalar(), "month")

    def months(self) -> Column:
        """Array of every month start between the first and last sale."""
        return F.sequence(self._edge(F.min), self._edge(F.max), F.expr("interval 1 month"))

    # -- facts ------------------------------------------------------------

    def raw_vendas(self, line_key_only: bool = False, line_in_product: bool = False,
                   net_of_tax: bool = False) -> DataFrame:
        """Sales lines. Three variants hold faults that checks must find:
        ``line_key_only`` shortens the id to order and line number, which repeats in
        the data; ``line_in_product`` adds the line to the product number, which
        leads past the last product; ``net_of_tax`` takes the tax of returned lines
        off the net value."""
        orders = self.read("orders").groupBy("o_orderkey").agg(
            F.max("o_custkey").alias("o_custkey"))
        customers = self.read("customer").groupBy("c_custkey").agg(
            F.max("c_name").alias("c_name"), F.max("c_mktsegment").alias("c_mktsegment"))
        sales = (
            self.read("lineitem")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
            .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        )

        shipped = F.col("l_shipdate").cast("date")
        id_parts = [_text("l_orderkey"), _text("l_linenumber")]
        if not line_key_only:
            id_parts += [_text("l_partkey"), _text("l_suppkey"), shipped.cast("string")]
        order = F.col("l_orderkey")
        gross = _cents("l_extendedprice")
        discount = F.floor((gross * _cents("l_discount") + 50) / 100)
        returned = F.floor((gross + 5) / 10)
        tax = F.floor((gross * _cents("l_tax") + 50) / 100) if net_of_tax else F.lit(0)
        product = F.col("l_partkey") + F.col("l_linenumber") - 1 if line_in_product else F.col("l_partkey")
        is_returned = F.col("l_returnflag") == "R"
        is_plain = F.col("l_returnflag") == "N"
        return sales.select(
            F.when(order % 103 != 0, F.concat(F.lit("VND-"), F.concat_ws("-", *id_parts)))
            .alias("venda_id"),
            F.concat(F.lit("NF-"), _text("l_orderkey")).alias("nota_fiscal"),
            F.col("l_shipdate").cast("timestamp").alias("data_emissao"),
            _text("o_custkey").alias("cliente_id"),
            F.concat(F.lit(" "), F.lower("c_name"), F.lit(" ")).alias("cliente_nome"),
            F.when(F.col("c_mktsegment") == "AUTOMOBILE", " montadora ")
            .otherwise("distribuidor").alias("tipo_cliente"),
            product.cast("string").alias("produto_id"),
            F.when(order % 97 == 0, F.lit(0.0)).otherwise(F.col("l_quantity")).alias("quantidade"),
            F.col("l_extendedprice").alias("preco_unitario"),
            F.when(order % 101 == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice"))
            .alias("valor_bruto"),
            F.col("l_discount").alias("desconto_percentual"),
            (discount / 100).alias("valor_desconto"),
            F.when(is_returned, F.floor(F.col("l_quantity") / 10).cast("double"))
            .when(is_plain, F.lit(0.0)).alias("devolucao_quantidade"),
            F.when(is_returned, returned / 100).when(is_plain, F.lit(0.0))
            .alias("devolucao_valor"),
            ((gross - discount - F.when(is_returned, returned + tax).otherwise(F.lit(0))) / 100)
            .alias("valor_liquido"),
            _line_of("l_partkey").alias("linha_producao_id"),
        )

    def raw_custos(self) -> DataFrame:
        """Active products times months, in whole cents.

        The file of products is small, its rows times months are not: products
        are dealt out first, and what depends on the month are plain columns,
        as functions of array elements are not compiled.
        """
        part, p, i = F.col("p_partkey"), F.col("p"), F.col("i")
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        index = F.lit(100) + (i * 7 + (part % 4) * 13) % 36
        labour = F.when(i % 3 == 0, 100).when(i % 3 == 1, 107).otherwise(112)
        rows = self.read("part").where(_IS_ACTIVE).select(
            "p_partkey", _standard_cents().alias("p")).repartition(tasks, "p_partkey").select(
            "p_partkey", "p", F.explode(self.months()).alias("m"),
        ).select("p_partkey", "p", "m", ((F.year("m") - BASE_YEAR) * 12 + F.month("m") - 1).alias("i")).select(
            "p_partkey", "p", "m", index.alias("idx"),
            F.floor((p * 60 * index + 5000) / 10000).alias("mp"),
            F.floor((p * 25 * labour + 5000) / 10000).alias("mod"),
            F.floor((p * 15 * (F.lit(1000) + i * 4) + 50000) / 100000).alias("cif"))
        full = "(mp + mod + cif)"
        return rows.selectExpr(
            "cast(p_partkey as string) as produto_id",
            "m as mes_referencia",
            "mp / 100.0D as custo_materia_prima",
            "mod / 100.0D as custo_mao_obra_direta",
            "cif / 100.0D as custo_indireto_fabricacao",
            f"case when p_partkey % 19 = 0 and month(m) = 1 then 0.0D else {full} / 100.0D end "
            "as custo_total_unitario",
            "p / 100.0D as custo_padrao_unitario",
            f"sign({full} - p) * ((20000 * abs({full} - p) + p) div (2 * p)) / 10000.0D "
            "as variacao_custo_pct",
            "idx / 100.0D as indice_commodity",
            "concat('LP0', cast(p_partkey % 4 + 1 as string)) as linha_producao_id",
        )

    def raw_despesas(self) -> DataFrame:
        status = F.col("o_orderstatus")
        priority = F.col("o_orderpriority")
        rank = F.substring(priority, 1, 1)
        return self.read("orders").select(
            F.concat(F.lit("DESP-"), _text("o_orderkey")).alias("despesa_id"),
            month_start("o_orderdate").alias("mes_referencia"),
            F.when(status == "F", "produção").when(status == "O", "comercial ")
            .otherwise("ADMINISTRATIVO").alias("centro_custo_tipo"),
            F.when(priority == "5-LOW", " 5-LOW ")
            .otherwise(F.concat(priority, F.lit(" / "), status)).alias("natureza"),
            F.when(rank == "1", "DESPESA_FABRICA").when(rank == "2", " despesa_vendas")
            .when(rank == "3", "DESPESA_ADMIN").when(rank == "4", "DEPRECIACAO")
            .otherwise("RESULTADO_FINANCEIRO").alias("classificacao_dre"),
            F.when(F.col("o_orderkey") % 89 != 0,
                   F.floor((_cents("o_totalprice") + 1) / 2) / 100).alias("valor"),
        )

    # -- planning data ----------------------------------------------------

    def raw_orcamento(self) -> DataFrame:
        """Next year's budget: this year's cleaned actuals plus ten percent."""
        from castledger.operators.staging import stg_despesas, stg_vendas

        spent = (
            stg_despesas(self.raw("raw_despesas"))
            .groupBy("ano", "mes", "natureza")
            .agg(F.min("centro_custo_tipo").alias("centro_custo_tipo"), F.sum("valor").alias("v"))
            .select("ano", "mes", F.lit("DESPESA").alias("tipo"), "natureza", "centro_custo_tipo",
                    F.when(F.col("natureza").startswith("4") & (F.col("mes") == 2), dec("0.00"))
                    .otherwise(_r2(F.col("v") * dec("1.1"))).alias("v"))
        )
        earned = (
            stg_vendas(self.raw("raw_vendas"))
            .groupBy("ano", "mes").agg(F.sum("valor_bruto").alias("v"))
            .select("ano", "mes", F.lit("RECEITA").alias("tipo"),
                    F.lit("Receita Bruta de Vendas").alias("natureza"),
                    F.lit("COMERCIAL").alias("centro_custo_tipo"),
                    _r2(F.col("v") * dec("1.1")).alias("v"))
        )
        ano = F.col("ano") + 1
        return spent.unionByName(earned).select(
            F.concat(F.lit("ORC-"), F.concat_ws("-", ano.cast("string"), _text("mes"), "natureza"))
            .alias("orcamento_id"),
            ano.alias("ano"), "mes", "tipo", "natureza", "centro_custo_tipo",
            F.col("v").cast("double").alias("valor_orcado"),
        )

    def raw_historico_custos(self) -> DataFrame:
        """Quarterly revisions; skipped quarters leave gaps on purpose. At most
        28 rows per product, so the per-product windows are bounded."""
        revisions = self.read("part").where(_IS_ACTIVE).select(
            "p_partkey", _standard_cents().alias("padrao"),
            F.explode(F.sequence(F.lit(0), F.lit(QUARTERS - 1))).alias("q"),
        ).where("q = 0 or (p_partkey * 7 + q * 3) % 10 < 6")
        start = F.add_months(F.lit(dt.date(BASE_YEAR, 1, 1)), F.col("q") * 3)
        shift = F.when(F.col("q") == 0, F.lit(0)).otherwise(
            (F.col("p_partkey") * 5 + F.col("q") * 7) % 18 - 5)
        priced = revisions.select(
            "p_partkey", "q", start.alias("inicio"),
            (F.floor((F.col("padrao") * (F.lit(100) + shift) + 50) / 100) / 100).alias("novo"))
        by_product = Window.partitionBy("p_partkey").orderBy("q")
        is_last = F.lead("q").over(by_product).isNull()
        return priced.select(
            F.concat_ws("-", F.lit("HIST"), _text("p_partkey"), _text("q")).alias("historico_id"),
            _text("p_partkey").alias("produto_id"),
            F.lag("novo").over(by_product).alias("custo_padrao_anterior"),
            F.col("novo").alias("custo_padrao_novo"),
            F.col("inicio").alias("data_vigencia_inicio"),
            F.when(is_last, F.lit(dt.date(9999, 12, 31)))
            .otherwise(F.date_sub(F.add_months("inicio", 3), 1)).alias("data_vigencia_fim"),
            F.when(F.col("q") == 0, "CUSTO_INICIAL")
            .when(F.col("q") % 4 == 0, "REAJUSTE_COMMODITY")
            .when(F.col("q") % 4 == 1, "REVISAO_TRIMESTRAL")
            .when(F.col("q") % 4 == 2, "RENEGOCIACAO_FORNECEDOR")
            .otherwise("ALTERACAO_PROCESSO").alias("motivo"),
            is_last.alias("is_current"),
        )

    # -- master data ------------------------------------------------------

    def raw_produtos(self) -> DataFrame:
        line = _line_of("p_partkey")
        return self.read("part").select(
            _text("p_partkey").alias("produto_id"),
            F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("produto_nome"),
            line.alias("linha_producao_id"),
            F.lower(line).alias("linha_producao_nome"),
            F.lit(" pç ").alias("unidade_medida"),
            (_standard_cents() / 100).alias("custo_padrao_unitario"),
            F.when(F.col("p_partkey") % 23 == 0, F.lit(0.0)).otherwise(F.col("p_retailprice"))
            .alias("preco_venda_unitario"),
            F.col("p_size").cast("double").alias("peso_kg"),
            F.when(F.expr(_IS_ACTIVE), "ATIVO").otherwise("INATIVO").alias("status"),
            F.lit(dt.date(1994, 1, 1)).alias("data_cadastro"),
            F.concat(F.lit("7000."), _text("p_size")).alias("ncm"),
        )

    def raw_clientes(self) -> DataFrame:
        return self.read("customer").select(
            _text("c_custkey").alias("cliente_id"),
            F.concat(F.lit(" "), F.lower("c_name"), F.lit(" ")).alias("cliente_nome"),
            F.when(F.col("c_mktsegment") == "AUTOMOBILE", " montadora ")
            .otherwise("distribuidor").alias("tipo"),
            (F.abs(_d2("c_acctbal")) * dec("0.0001")).cast("double").alias("peso_volume"),
        )

    def raw_centros_custo(self) -> DataFrame:
        region = F.col("n_regionkey")
        return self.read("nation").select(
            F.concat(F.lit("CC"), _text("n_nationkey")).alias("centro_custo_id"),
            F.col("n_name").alias("centro_custo_nome"),
            F.when(region == 0, "PRODUÇÃO").when(region == 1, "COMERCIAL")
            .when(region == 2, "ADMINISTRATIVO").otherwise("LOGÍSTICA").alias("tipo"),
            F.when(F.col("n_nationkey") < 4,
                   F.concat(F.lit("LP0"), (F.col("n_nationkey") + 1).cast("string")))
            .alias("linha_producao_vinculada"),
            F.col("n_name").alias("responsavel"),
            F.lit(True).alias("ativo"),
        )

    def raw_commodities(self) -> DataFrame:
        names = F.array(*[F.lit(n) for n in ("aco", "aluminio", "polimero", "misto")])
        grid = (
            self.spark.range(1).select(F.explode(self.months()).alias("mes"))
            .select("mes", F.posexplode(names).alias("k", "commodity"))
        )
        i = (F.year("mes") - BASE_YEAR) * 12 + F.month("mes") - 1
        return grid.select(
            "mes", "commodity",
            ((F.lit(100) + (i * 7 + F.col("k") * 13) % 36).cast("decimal(10,0)") * dec("0.01"))
            .cast("double").alias("indice"),
        )
