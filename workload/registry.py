"""Every query of the package, runnable over the provided tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import zip_digits
from tidemark.operators import quality
from tidemark.operators.checksum import FIELDS, content
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.distinct import distinct_counts
from tidemark.operators.expectations import Expectation, enforce, unparseable, violations
from tidemark.plans import descriptions, gate, gold, kpis, marts, silver
from tidemark.plans.pipeline import AMOUNTS, LAYOUTS, Run
from tidemark.schemas import manifest, raw_schema
from tidemark.session import shared_folder, side_by_side, tune
from tidemark.sources.bronze import (
    CONTENT,
    ingest_all_string,
    landed_contents,
    reconcile_contents,
    reconcile_counts,
)
from tidemark.sources.csv import LINES, STITCHED, WHOLE
from tidemark.sources.landing import append_arrival_log, arrival_check, drop_name, read_modes
from tidemark.sources.layout import MONTH
from tidemark.sources.tables import delete_folder, write_finding_hot, write_table, write_watched
from workload.raw_tables import FaultyRawTables, RawTables, repeated, table

AS_OF = "2002-01-01"  # fixed "today" so that results repeat
ANY_VOLUME = (1, 10**15)
NO_VOLUME = (1, 2)
REPORT_COLUMNS = (
    "pedido_id",
    "item_id",
    "cliente_id",
    "produto_id",
    "data_compra",
    "cancelado",
    "tempo_entrega_dias",
    "atraso_dias",
    "receita",
    "valor_pago",
    "metodo_pagamento_principal",
    "nota_avaliacao",
)
MONTHLY = ("data_compra", "cancelado")  # what reports by month need of an order
# Sets, whose rows are ranges of numbers; the distinct counts over them are queries of their own.
SETS = ("gold.pessoa_mes", "gold.pedido_categoria_mes")
# Drops of a whole load: text shrinks to a third, and each part file is so small that one task reads it.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 500_000}
HOT_ORDER_ROWS = 8  # small enough that many orders of the provided tables are split

Query = Callable[[SparkSession, str], DataFrame]


def presentable(df: DataFrame) -> DataFrame:
    """Money as double, dates and times as text, so that two engines print them alike."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


class Tables:
    """The retail tables over one data folder, each built (lazily) from the raw ones."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir
        self.raw = RawTables(spark, sf_dir)

    def silver(self, name: str) -> DataFrame:
        return silver.TABLES[name][1](self.raw)

    def persons(self) -> DataFrame:
        return gold.person_dimension(
            self.silver("clientes"),
            self.silver("pedidos"),
            self.silver("itens_pedido"),
            as_of=F.lit(AS_OF).cast("date"),
        )

    def products(self) -> DataFrame:
        return gold.product_dimension(self.silver("produtos"))

    def sellers(self) -> DataFrame:
        return gold.seller_dimension(self.silver("vendedores"))

    def geography(self) -> DataFrame:
        return gold.geography_dimension(self.silver("geolocalizacao"))

    def fact(self, **options) -> DataFrame:
        return gold.sales_fact(
            self.silver("itens_pedido"),
            self.silver("pedidos"),
            self.silver("clientes"),
            self.silver("pagamentos"),
            self.silver("avaliacoes"),
            **options,
        )

    def stored_fact(self, *columns: str) -> DataFrame:
        """Columns of the fact as a table in the shared folder, for queries with several passes."""
        path = f"{shared_folder(self.spark)}/fato_vendas"
        write_table(self.fact().select(*columns), path)
        return self.spark.read.parquet(path)

    def order_totals(self, *values: str) -> DataFrame:
        """With the order-level values that a report needs."""
        return marts.order_totals(self.fact(), values)

    def fact_of_hot_orders(self, hot_rows: int) -> DataFrame:
        """The fact from items that were written first, which tells their hot orders."""
        items = self.silver("itens_pedido")
        path = f"{shared_folder(self.spark)}/itens_pedido"
        _, hot = write_finding_hot(items, path, "order_id", hot_rows, tracked=1_000_000)
        sides = (self.silver(n) for n in ("pedidos", "clientes", "pagamentos", "avaliacoes"))
        return gold.sales_fact(self.spark.read.schema(items.schema).parquet(path), *sides, hot=hot, hot_rows=hot_rows)

    def categories(self, fact: DataFrame | None = None) -> DataFrame:
        return marts.category_performance(
            self.fact() if fact is None else fact, self.products()
        )

    def report(self, volume: tuple[int, int] = gate.FACT_VOLUME) -> DataFrame:
        fact = self.stored_fact(*REPORT_COLUMNS)
        return gate.gate_report(
            fact,
            self.silver("itens_pedido"),
            self.silver("pedidos"),
            self.persons(),
            self.geography(),
            self.categories(fact),
            marts.monthly_sales(marts.order_totals(fact, MONTHLY)),
            fact_volume=volume,
        )


class FaultyTables(Tables):
    """The tables with faults in them, some put in behind the rules that would remove them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self.raw = FaultyRawTables(spark, sf_dir)

    def orders(self) -> DataFrame:
        """Orders of which every seventh got lost after the fact was built."""
        return self.silver("pedidos").filter("cast(order_id AS bigint) % 7 <> 0")

    def known_persons(self) -> DataFrame:
        return self.persons().filter("cast(customer_unique_id AS bigint) % 11 <> 0")

    def short_zips(self) -> DataFrame:
        """The dimension with some codes cut, which the cleaning would have padded."""
        cut = F.when(F.col("cep_prefixo") < "00100", F.col("cep_prefixo").substr(3, 3))
        return self.geography().withColumn("cep_prefixo", F.coalesce(cut, "cep_prefixo"))

    def months(self, fact: DataFrame) -> DataFrame:
        return marts.monthly_sales(marts.order_totals(fact, MONTHLY)).filter("mes <> 5")

    def report(self, volume: tuple[int, int] = gate.FACT_VOLUME) -> DataFrame:
        fact = self.stored_fact(*REPORT_COLUMNS)
        return gate.gate_report(
            fact,
            self.silver("itens_pedido"),
            self.orders(),
            self.known_persons(),
            self.short_zips(),
            self.categories(fact),
            self.months(fact),
            fact_volume=volume,
        )


def query(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: presentable(build(Tables(spark, sf_dir)))


def faulty(build: Callable[[FaultyTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: presentable(build(FaultyTables(spark, sf_dir)))


def latest_line(t: Tables) -> DataFrame:
    """``lineitem`` repeats (order, line) pairs; keep the latest shipped of each."""
    lines = table(t.spark, t.sf_dir, "lineitem")
    others = ("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
    kept = latest_per_key(
        lines, ("l_orderkey", "l_linenumber"), "l_shipdate", (*others, "l_returnflag", "l_linestatus")
    )
    return kept.select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
    )


def source_rows(t: Tables) -> DataFrame:
    """The audit count of every silver table next to the rows it kept."""
    counted = [
        silver.silver_table(name, t.raw).agg(
            F.lit(name).alias("tabela"),
            F.max("_linhas_origem").alias("linhas_origem"),
            F.count(F.lit(1)).alias("linhas"),
        )
        for name in silver.TABLES
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result


def constraint_violations(t: Tables) -> DataFrame:
    result = None
    for name, expectations in gate.CONSTRAINTS.items():
        df = t.fact() if name == "fato_vendas" else t.silver(name)
        found = violations(df, expectations).select(F.lit(name).alias("tabela"), "*")
        result = found if result is None else result.unionByName(found)
    return result


def dated_deliveries(t: Tables) -> DataFrame:
    """Orders without those that claim delivery but carry no date."""
    rule = Expectation("entrega_datada", "NOT entregue OR data_entrega_cliente IS NOT NULL")
    return enforce(t.silver("pedidos"), [rule], "drop").select("order_id", "status")


def short_zips(t: Tables) -> DataFrame:
    """How many digits the raw codes had before padding, which always yields five."""
    raw = t.raw["geolocation"]
    digits = F.length(zip_digits("geolocation_zip_code_prefix")).alias("digitos")
    return raw.groupBy(digits).agg(F.count(F.lit(1)).alias("linhas"))


def unreadable_photos(t: Tables) -> DataFrame:
    return unparseable(t.raw["products"], "product_photos_qty", "int").select(
        "product_id", "product_photos_qty"
    )


def category_total(t: Tables) -> DataFrame:
    fact = t.fact()
    return quality.reconcile_sum(
        "mart_categoria_soma_igual_fato", t.categories(fact), "receita", marts.sold(fact), "receita"
    )


def monthly_total(t: Tables) -> DataFrame:
    fact = t.fact()
    monthly = marts.monthly_sales(marts.order_totals(fact, MONTHLY))
    return quality.reconcile_sum(
        "mart_vendas_mensal_soma_igual_fato", monthly, "receita", marts.sold(fact), "receita"
    )


def key_report(t: Tables) -> DataFrame:
    return gate.key_report(
        {
            "clientes": (t.silver("clientes"), ("customer_id",)),
            "pedidos": (t.silver("pedidos"), ("order_id",)),
            "dim_cliente": (t.persons(), ("customer_unique_id",)),
            "dim_produto": (t.products(), ("product_id",)),
            "dim_vendedor": (t.sellers(), ("seller_id",)),
            "dim_geografia": (t.geography(), ("cep_prefixo",)),
            "fato_vendas": (t.fact(), ("pedido_id", "item_id")),
        }
    )


def faulty_keys(t: FaultyTables) -> DataFrame:
    """Grouped dimensions can't repeat a key by themselves; some of their rows are repeated."""
    third = "cast({} AS bigint) % 3 = 0"
    return gate.key_report(
        {
            "clientes": (t.silver("clientes"), ("customer_id",)),
            "pedidos": (t.silver("pedidos"), ("order_id",)),
            "dim_cliente": (
                repeated(t.persons(), third.format("customer_unique_id")),
                ("customer_unique_id",),
            ),
            "dim_produto": (t.products(), ("product_id",)),
            "dim_vendedor": (t.sellers(), ("seller_id",)),
            "dim_geografia": (
                repeated(t.geography(), third.format("cep_prefixo")),
                ("cep_prefixo",),
            ),
            "fato_vendas": (t.fact(), ("pedido_id", "item_id")),
        }
    )


def write_csv(df: DataFrame, path: str, **options) -> None:
    """A drop of part files in the landing format, text left as it is."""
    df.write.options(
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        emptyValue="",
        **options,
    ).csv(path)


def land(t: Tables, **options) -> str:
    """All nine raw tables as CSV drops in the shared folder."""
    folder = f"{shared_folder(t.spark)}/landing"
    files, raw = manifest(), {name: t.raw[name] for name in manifest()}
    side_by_side(lambda name: write_csv(raw[name], f"{folder}/{files[name]}", **options), files)
    return folder


def arrivals(t: Tables) -> DataFrame:
    return arrival_check(t.spark, land(t), manifest()).select("tabela", "arquivo", "linhas")


def bronze_texts(t: Tables, mode: str = WHOLE, line_breaks: bool = True) -> DataFrame:
    """Whole documents, line breaks and quotes included, as review messages: to CSV and back."""
    path = f"{shared_folder(t.spark)}/order_reviews.csv"
    message = F.col("text") if line_breaks else F.translate("text", "\r\n", "  ")
    documents = table(t.spark, t.sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("review_id"),
        *(F.lit(None).cast("string").alias(c) for c in ("order_id", "review_score")),
        F.col("source").alias("review_comment_title"),
        message.alias("review_comment_message"),
        *(
            F.lit(None).cast("string").alias(c)
            for c in ("review_creation_date", "review_answer_timestamp")
        ),
    )
    write_csv(documents, path)
    message = F.col("review_comment_message")
    return ingest_all_string(t.spark, path, raw_schema("order_reviews"), mode).select(
        "review_id",
        "review_score",
        "review_comment_title",
        F.md5(message).alias("mensagem_md5"),
        F.length(message).alias("mensagem_tamanho"),
    )


def bronze_reconciliation(t: Tables) -> DataFrame:
    """Land, check, log, load and count all nine tables; then compare the counts."""
    landing = land(t)
    folder = landing.removesuffix("/landing")
    log = f"{folder}/log"
    append_arrival_log(arrival_check(t.spark, landing, manifest()), log)
    counts = [
        (
            name,
            write_table(
                ingest_all_string(t.spark, f"{landing}/{file}", raw_schema(name)),
                f"{folder}/bronze/{name}",
            ),
        )
        for name, file in manifest().items()
    ]
    counted = t.spark.createDataFrame(counts, "tabela string, linhas_bronze long")
    return reconcile_counts(t.spark.read.parquet(log), counted)


def whole_load(t: Tables) -> Run:
    """From CSV files to marts. The files go once every row of them is proven to be in bronze."""
    landing = land(t, **PACKED)
    run = Run(t.spark, f"{landing.removesuffix('/landing')}/lake")
    run.bronze(landing, manifest())
    delete_folder(t.spark, landing)
    run.silver()
    run.gold(F.lit(AS_OF).cast("date"))
    return run


def refreshed(t: Tables) -> DataFrame:
    """Rows of every table that a refresh writes, from CSV files to marts."""
    run = whole_load(t)
    rows = {name: n for name, n in run.rows.items() if name not in SETS}
    t.spark.sql(f"DROP SCHEMA {run.schema} CASCADE")  # nobody else reads its tables
    delete_folder(t.spark, run.root)
    return t.spark.createDataFrame(sorted(rows.items()), "tabela string, linhas long")


def bronze_contents(t: Tables, **swapped: tuple[str, str]) -> DataFrame:
    """Checksums of all nine drops against what an ingest wrote; some may have two fields swapped on the way."""
    landing, files = land(t), manifest()
    modes = read_modes(t.spark, landing, list(files.values()))

    def load(name: str) -> tuple:
        rows = ingest_all_string(t.spark, f"{landing}/{files[name]}", raw_schema(name), modes[files[name]])
        if name in swapped:
            a, b = swapped[name]
            rows = rows.withColumns({a: F.col(b), b: F.col(a)})
        path = f"{landing.removesuffix('/landing')}/bronze/{name}"
        seen = write_watched(rows, path, more=content(raw_schema(name).fieldNames()))
        return name, *(seen[c] for c in FIELDS)

    loaded = side_by_side(load, files)
    landed = landed_contents(t.spark, landing, files, modes)
    return reconcile_contents(landed, t.spark.createDataFrame(loaded, CONTENT))


def quarantined(t: Tables) -> DataFrame:
    """Items whose price can't be read are set aside, as they came; the others add up to the rest."""
    raw = t.raw["order_items"]
    spoilt = raw.withColumn(
        "price", F.when(F.expr("cast(order_id AS bigint) % 13 = 0"), F.concat(F.lit("R$ "), "price")).otherwise(F.col("price"))
    )
    run = Run(t.spark, f"{shared_folder(t.spark)}/lake")
    kept = run.set_aside("order_items", spoilt, AMOUNTS["order_items"][1])
    rows = kept.agg(F.count(F.lit(1))).scalar()
    aside = run.read("quarantine.order_items")
    return aside.select("order_id", "order_item_id", "price", "freight_value", rows.alias("linhas_mantidas"))


def log_rows(t: Tables) -> DataFrame:
    """The log after two arrivals; sizes against the bytes of the text lines themselves."""
    landing = land(t)
    log = f"{landing.removesuffix('/landing')}/log"
    for _ in range(2):
        append_arrival_log(arrival_check(t.spark, landing, manifest()), log)
    lines = t.spark.read.option("recursiveFileLookup", "true").text(landing)
    size = F.sum(F.octet_length("value") + 1).alias("lidos")
    read = lines.groupBy(drop_name(F.col("_metadata.file_path"), landing).alias("arquivo")).agg(size)
    logged = t.spark.read.parquet(log).groupBy("tabela", "arquivo", "linhas", "bytes")
    counted = logged.agg(F.count_distinct("conferido_em").alias("conferencias"))
    return counted.join(read, "arquivo").select(
        "tabela", "arquivo", "linhas", "conferencias", (F.col("bytes") == F.col("lidos")).alias("bytes_batem")
    )


@lru_cache(maxsize=8)
def stored_run(spark: SparkSession, sf_dir: str) -> Run:
    """A whole load, from CSV files to marts, kept for the queries that read stored tables."""
    return whole_load(Tables(spark, sf_dir))


def lake(t: Tables) -> Run:
    return stored_run(t.spark, t.sf_dir)


def published_run(t: Tables) -> Run:
    """The same with its names published; another data folder's may have taken their place."""
    run = lake(t)
    name = "gold.fato_vendas"
    shows = t.spark.catalog.tableExists(name) and run.run_id in str(t.spark.sql(f"DESCRIBE EXTENDED {name}").collect())
    if not shows:
        run.publish()
    return run


def view(name: str) -> Query:
    """A published name, read as whoever consumes it does."""
    return query(lambda t: published_run(t).spark.table(name))


def comments(t: Tables) -> DataFrame:
    """What the catalog says about every published table and about the columns that have a note of their own
    (others inherit the note of the column they are made of)."""
    rows = []
    for name in sorted(published_run(t).comments):
        noted = {*descriptions.COLUMNS.get(name, {}), *([MONTH] if name in LAYOUTS and LAYOUTS[name].month else [])}
        rows.append((name, None, t.spark.catalog.getTable(name).description))
        rows += [(name, c.name, c.description) for c in t.spark.catalog.listColumns(name) if c.name in noted]
    return t.spark.createDataFrame(rows, "tabela string, coluna string, comentario string")


def stored_fact_rebuilt(t: Tables) -> DataFrame:
    """The fact joined from the tables in buckets."""
    run = lake(t)
    s = (run.read(f"silver.{n}") for n in ("itens_pedido", "pedidos", "clientes", "pagamentos", "avaliacoes"))
    return gold.sales_fact(*s, persons=run.read("silver.pedido_pessoa"))


def months_of_1995(t: Tables) -> DataFrame:
    """Twelve partitions of the stored rollup, and no others."""
    return marts.monthly_sales(lake(t).read("gold.pedido_totais").filter("ano_mes BETWEEN 199501 AND 199512"))


def persons_by_quarter(t: Tables) -> DataFrame:
    """Different persons of each quarter and state, and of all, merged from monthly sets."""
    sets = lake(t).read("gold.pessoa_mes")
    quarters = sets.selectExpr(
        "cast(ano_mes div 100 AS int) AS ano", "cast((ano_mes % 100 + 2) div 3 AS int) AS trimestre", "uf", "faixa", "bits"
    )
    states = distinct_counts(quarters, "ano", "trimestre", "uf", name="pessoas")
    every = distinct_counts(sets, name="pessoas")
    none = (F.lit(None).cast("int").alias("ano"), F.lit(None).cast("int").alias("trimestre"), F.lit(None).cast("string").alias("uf"))
    return states.unionByName(every.select(*none, "pessoas"))


def orders_by_category(t: Tables) -> DataFrame:
    """Different orders of each category and year, merged from monthly sets."""
    sets = lake(t).read("gold.pedido_categoria_mes")
    return distinct_counts(
        sets.selectExpr("cast(ano_mes div 100 AS int) AS ano", "categoria_en", "faixa", "bits"), "ano", "categoria_en", name="pedidos"
    )


QUERIES: dict[str, Query] = {
    # landing and bronze
    "arrival_check": query(arrivals),
    "bronze_ingest": query(bronze_texts),
    "bronze_ingest_stitched": query(lambda t: bronze_texts(t, STITCHED)),
    "bronze_ingest_lines": query(lambda t: bronze_texts(t, LINES, line_breaks=False)),
    "bronze_reconciliation": query(bronze_reconciliation),
    "bronze_contents": query(bronze_contents),
    "bronze_contents_swapped": query(
        lambda t: bronze_contents(
            t,
            order_payments=("payment_type", "payment_value"),
            orders=("order_approved_at", "order_delivered_carrier_date"),
            customers=("customer_city", "customer_state"),
        )
    ),
    "arrival_log": query(log_rows),
    "quarantined_items": query(quarantined),
    "refresh_tables": query(refreshed),
    # silver
    "clean_customers": query(lambda t: t.silver("clientes")),
    "clean_orders": query(lambda t: t.silver("pedidos")),
    "clean_products": query(lambda t: t.silver("produtos")),
    "clean_sellers": query(lambda t: t.silver("vendedores")),
    "clean_items": query(lambda t: t.silver("itens_pedido")),
    "clean_payments": query(lambda t: t.silver("pagamentos")),
    "clean_reviews": query(lambda t: t.silver("avaliacoes")),
    "mean_point_geolocation": query(lambda t: t.silver("geolocalizacao")),
    "latest_line_per_key": query(latest_line),
    "audit_source_rows": query(source_rows),
    # gold
    "person_dimension": query(lambda t: t.persons()),
    "product_dimension": query(lambda t: t.products()),
    "seller_dimension": query(lambda t: t.sellers()),
    "geography_dimension": query(lambda t: t.geography()),
    "calendar_dimension": query(lambda t: gold.calendar_dimension(t.silver("pedidos"))),
    "sales_fact": query(lambda t: t.fact()),
    "sales_fact_hot_order": query(lambda t: t.fact_of_hot_orders(HOT_ORDER_ROWS)),
    # marts
    "monthly_sales": query(lambda t: marts.monthly_sales(t.order_totals(*MONTHLY))),
    "category_performance": query(lambda t: t.categories()),
    "seller_performance": query(lambda t: marts.seller_performance(t.fact(), t.sellers())),
    "geography_sales": query(lambda t: marts.geography_sales(marts.person_totals(t.order_totals("cliente_id", "cancelado")), t.persons())),
    # business metrics
    "kpi_snapshot": query(lambda t: kpis.kpi_snapshot(marts.person_totals(t.order_totals("cliente_id", "cancelado")))),
    "cancellation_rate": query(lambda t: kpis.cancellation_rate(t.order_totals(*MONTHLY))),
    "cancellation_rate_all_orders": query(
        lambda t: kpis.cancellation_rate(t.silver("pedidos"), "order_id")
    ),
    "payment_mix_per_order": query(lambda t: kpis.payment_mix(t.order_totals("cancelado", "metodo_pagamento_principal", "valor_pago"))),
    "payment_mix_per_item_value": query(
        lambda t: kpis.payment_mix(t.fact(), kpis.PER_ITEM_VALUE)
    ),
    "top_categories": query(lambda t: kpis.top_categories(t.categories())),
    # stored tables: buckets, months, sets, published names
    "sales_fact_in_buckets": query(stored_fact_rebuilt),
    "monthly_sales_1995": query(months_of_1995),
    "distinct_persons_by_quarter": query(persons_by_quarter),
    "distinct_orders_by_category": query(orders_by_category),
    "view_kpi_snapshot": view("gold.vw_metricas_gerais"),
    "view_cancellation_rate": view("gold.vw_taxa_cancelamento"),
    "view_payment_mix_per_item_value": view("gold.vw_metodo_pagamento"),
    "view_payment_mix_per_order": view("gold.vw_metodo_pagamento_por_pedido"),
    "view_top_categories": view("gold.vw_top10_categorias"),
    "published_comments": query(comments),
    # data tests
    "check_revenue_total": query(
        lambda t: quality.reconcile_sum(
            "receita_gold_igual_silver", t.fact(), "receita", t.silver("itens_pedido"), "valor_item"
        )
    ),
    "check_order_orphans": query(
        lambda t: quality.orphans(
            "sem_item_orfao_de_pedido", t.fact(), "pedido_id", t.silver("pedidos"), "order_id"
        )
    ),
    "check_item_orphans": query(
        lambda t: quality.orphans(
            "item_sem_pedido", t.silver("itens_pedido"), "order_id", t.silver("pedidos"), "order_id"
        )
    ),
    "check_person_orphans": query(
        lambda t: quality.orphans(
            "sem_item_orfao_de_cliente", t.fact(), "cliente_id", t.persons(), "customer_unique_id"
        )
    ),
    "check_purchase_date": query(
        lambda t: quality.null_count("data_compra_nao_nula", t.silver("pedidos"), "data_compra")
    ),
    "check_review_score": query(
        lambda t: quality.range_check(
            "nota_avaliacao_entre_1_e_5", t.fact(), "nota_avaliacao", 1, 5
        )
    ),
    "check_fact_volume": query(
        lambda t: quality.volume_check("volume_fato_vendas", t.fact(), *gate.FACT_VOLUME)
    ),
    "check_category_total": query(category_total),
    "check_monthly_total": query(monthly_total),
    "check_zip_format": query(
        lambda t: quality.format_check(
            "cep_prefixo_5_digitos_dim_geografia", t.geography(), "length(cep_prefixo) <> 5"
        )
    ),
    "quality_report": query(lambda t: t.report()),
    "quality_gate": query(lambda t: quality.gate_result(t.report(ANY_VOLUME))),
    "constraint_violations": query(constraint_violations),
    "enforce_by_dropping": query(dated_deliveries),
    "unique_keys": query(key_report),
    # the same checks where there is something to find
    "check_order_orphans_faulty": faulty(
        lambda t: quality.orphans(
            "sem_item_orfao_de_pedido", t.fact(), "pedido_id", t.orders(), "order_id"
        )
    ),
    "check_item_orphans_faulty": faulty(
        lambda t: quality.orphans(
            "item_sem_pedido", t.silver("itens_pedido"), "order_id", t.silver("pedidos"), "order_id"
        )
    ),
    "check_person_orphans_faulty": faulty(
        lambda t: quality.orphans(
            "sem_item_orfao_de_cliente", t.fact(), "cliente_id", t.known_persons(), "customer_unique_id"
        )
    ),
    "check_purchase_date_faulty": faulty(
        lambda t: quality.null_count("data_compra_nao_nula", t.silver("pedidos"), "data_compra")
    ),
    "check_review_score_faulty": faulty(
        lambda t: quality.range_check(
            "nota_avaliacao_entre_1_e_5", t.fact(), "nota_avaliacao", 1, 5
        )
    ),
    "check_zip_format_faulty": faulty(
        lambda t: quality.format_check(
            "cep_prefixo_5_digitos_dim_geografia", t.short_zips(), "length(cep_prefixo) <> 5"
        )
    ),
    "quality_report_faulty": faulty(lambda t: t.report(NO_VOLUME)),
    "quality_gate_faulty": faulty(lambda t: quality.failed_tests(t.report(NO_VOLUME))),
    "constraint_violations_faulty": faulty(constraint_violations),
    "unique_keys_faulty": faulty(faulty_keys),
    "zip_digits_before_padding": query(short_zips),
    "unreadable_numbers": query(unreadable_photos),
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["monthly_sales"](spark, sf_dir)
