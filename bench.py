"""Time the headline queries; prints one JSON line: the first run of each query after
a common warm-up, and a second run beside it.

BENCH_SF_DIR   folder of the test tables   (default /root/testdata/sf0.1)
BENCH_CPUS     cores for local mode        (default 8)
BENCH_QUERIES  comma-separated subset      (default: the list below)
"""

from __future__ import annotations

import json
import os
import re
import time

from castledger.plans.queries import queries
from castledger.session import build_session

HEADLINE = (
    "stg_vendas", "stg_custos", "int_receita_liquida", "int_cmv_mensal", "int_despesas_dre",
    "mart_dre_mensal", "mart_margem_produto", "mart_orcado_realizado", "mart_kpis_executivo",
    "scd2_lookup_between", "scd2_lookup_asof", "scd2_build", "dedup_vendas", "dq_relationships",
    "top10_products", "margin_by_line", "budget_phasing", "cost_rollup", "commodity_impact",
)
WARM_UP = "stg_vendas"


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "castledger-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        })
    spark.sparkContext.setLogLevel("ERROR")
    registry = queries()

    def timed(name: str) -> float:
        start = time.perf_counter()
        registry[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    timed(WARM_UP)  # start-up and first compilation count for no query
    seconds: dict[str, float] = {name: timed(name) for name in names}
    second = {name: timed(name) for name in names}
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "second": second,
        "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
