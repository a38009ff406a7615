"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
    BENCH_CPUS    local threads (default 8)

    BENCH_REFRESH=1 also times the steps of a full refresh from CSV files and of reports on the stored
                  fact; they are printed as ``refresh``

Each query runs from the provided tables to its last row. After a warm-up query, every query is
run twice; ``queries`` holds the better time and ``cold`` the first one.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.operators.quality import QualityGateError  # noqa: E402
from tidemark.operators.skew import hot_keys  # noqa: E402
from tidemark.plans import gold, marts  # noqa: E402
from tidemark.plans.pipeline import Run  # noqa: E402
from tidemark.schemas import manifest  # noqa: E402
from tidemark.session import SETTINGS, shared_folder  # noqa: E402
from workload.registry import ANY_VOLUME, QUERIES, Tables, land  # noqa: E402

HEADLINES = (
    "clean_orders",
    "clean_items",
    "clean_reviews",
    "mean_point_geolocation",
    "person_dimension",
    "calendar_dimension",
    "sales_fact",
    "monthly_sales",
    "category_performance",
    "seller_performance",
    "geography_sales",
    "kpi_snapshot",
    "cancellation_rate",
    "payment_mix_per_order",
    "top_categories",
    "quality_report",
)


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def refresh_steps(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Seconds of each step of a refresh, and of single tables from the stored ones."""
    steps: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        try:
            work()
        except QualityGateError:
            pass  # the provided line items repeat keys, which the gate rightly refuses
        steps[name] = round(time.perf_counter() - start, 2)

    def written(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    landing = land(Tables(spark, sf_dir))
    run = Run(spark, shared_folder(spark))
    timed("arrival and bronze", lambda: run.bronze(landing, manifest()))
    timed("silver", run.silver)
    timed("gold", run.gold)
    timed("gate", lambda: run.test(ANY_VOLUME))
    timed("publish", run.publish)
    items, orders_, customers, payments, reviews = (
        run.read(f"silver.{name}") for name in ("itens_pedido", "pedidos", "clientes", "pagamentos", "avaliacoes")
    )
    fact, orders = run.read("gold.fato_vendas"), run.read("gold.pedido_totais")
    sides = (orders_, customers, payments, reviews)
    persons = run.read("silver.pedido_pessoa")
    hot = hot_keys(items, "order_id", 9)  # about one order in a hundred holds more than this
    timed("fact, in buckets", lambda: written(gold.sales_fact(items, *sides, persons=persons)))
    timed("fact, customers joined", lambda: written(gold.sales_fact(items, *sides)))
    timed("fact, orders over 9 items split", lambda: written(gold.sales_fact(items, *sides, hot=hot, hot_rows=9)))
    timed("order totals from the fact", lambda: written(marts.order_totals(fact)))
    timed("monthly sales from order totals", lambda: written(marts.monthly_sales(orders)))
    timed("category sales from the fact", lambda: written(marts.category_performance(fact, run.read("gold.dim_produto"))))
    timed("monthly sales from the fact", lambda: written(marts.monthly_sales(marts.order_totals(fact))))
    return steps


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    seconds(spark, "clean_sellers", sf_dir)
    cold = {name: seconds(spark, name, sf_dir) for name in HEADLINES}
    best = {name: min(cold[name], seconds(spark, name, sf_dir)) for name in HEADLINES}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": best,
        "cold": cold,
        "sf": float(Path(sf_dir).name.removeprefix("sf") or 0),
    }
    if os.environ.get("BENCH_REFRESH"):
        result["refresh"] = refresh_steps(spark, sf_dir)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
