"""Refresh of what changed: the drops whose content differs, the orders and persons they touch, and their months.

Each table of the new run is as a full refresh would make it. What the changed drops don't touch isn't read beyond
its keys and checksums, and months without a changed order show the files of the run before.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.audit import stamped
from tidemark.operators.checksum import FIELDS, contents
from tidemark.plans import gate, gold, marts, silver
from tidemark.plans.pipeline import BY_ORDER, Run, published, refresh, side_by_side
from tidemark.schemas import manifest
from tidemark.sources.layout import MONTH

AUDIT = ("_processado_em", "_linhas_origem")
# Raw tables that a silver table reads besides the one it is counted against.
ALSO_READS = {"produtos": ("product_category_translation",)}
ORDER_TABLES = ("pedidos", "itens_pedido", "pagamentos", "avaliacoes", "pedido_pessoa")


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The keys, NULL aside, whose rows differ in number or content; tables in buckets of the key don't move."""
    columns = [c for c in new.columns if c not in AUDIT]
    a, b = (contents(df.filter(F.col(key).isNotNull()), columns, key) for df in (old, new))
    pairs = a.select(key, F.struct(*FIELDS).alias("_old")).join(b.select(key, F.struct(*FIELDS).alias("_new")), key, "full")
    return pairs.filter(~F.col("_old").eqNullSafe(F.col("_new"))).select(key)


class Change:
    """A run built on an earlier one."""

    def __init__(self, run: Run, base: Run):
        self.run, self.base = run, base
        self.new: set[str] = set()  # tables that were written anew

    def put(self, name: str, made, *reads: str) -> None:
        """Write a table if one that it reads is new, and show the earlier one's otherwise."""
        if self.new.intersection(reads):
            self.run.write(name, made())
            self.new.add(name)
        else:
            self.run.reuse(self.base, name)

    def silver(self) -> None:
        raw = {table: self.run.read(f"bronze.{table}") for table in manifest()}
        self.new |= {f"bronze.{t}" for t in raw if f"bronze.{t}" not in self.run.places}

        def build(name: str) -> None:
            reads = (silver.TABLES[name][0], *ALSO_READS.get(name, ()))
            self.put(f"silver.{name}", lambda: silver.silver_table(name, raw), *(f"bronze.{t}" for t in reads))

        side_by_side(build, silver.TABLES)
        orders, customers = self.run.read("silver.pedidos"), self.run.read("silver.clientes")
        self.put(
            "silver.pedido_pessoa", lambda: gold.order_persons(orders, customers), "silver.pedidos", "silver.clientes"
        )

    def touched(self) -> tuple[DataFrame, DataFrame]:
        """Orders, and persons, of which any row differs; stored with the run."""
        run, base = self.run, self.base
        both = lambda name, key: changed_keys(base.read(name), run.read(name), key)
        none = run.read("silver.pedidos").select("order_id").limit(0)
        found = [both(f"silver.{n}", "order_id") for n in ORDER_TABLES if f"silver.{n}" in self.new]
        run.write("mudancas.ids_pedido", reduce(DataFrame.unionByName, found, none).distinct())
        orders = run.read("mudancas.ids_pedido")
        links = [r.read("silver.pedido_pessoa") for r in (base, run)]
        person = [df.join(orders, "order_id", "left_semi").select(F.col("cliente_id").alias("customer_unique_id")) for df in links]
        if "silver.clientes" in self.new:
            person.append(both("silver.clientes", "customer_unique_id"))
        known = reduce(DataFrame.unionByName, person).filter("customer_unique_id IS NOT NULL")
        run.write("mudancas.ids_pessoa", known.distinct())
        return orders, run.read("mudancas.ids_pessoa")

    def fact(self, orders: DataFrame) -> list:
        """The fact with the touched orders made anew; the months that hold or held one."""
        run, base = self.run, self.base
        some = {n: run.read(f"silver.{n}").join(orders, "order_id", "left_semi") for n in ORDER_TABLES}
        fresh = stamped(
            gold.sales_fact(
                some["itens_pedido"], some["pedidos"], run.read("silver.clientes"), some["pagamentos"], some["avaliacoes"],
                persons=some["pedido_pessoa"],
            )
        )
        run.write("mudancas.linhas_fato", fresh.withColumn(MONTH, F.expr("year(data_compra) * 100 + month(data_compra)").cast("int")))
        fresh, old = run.read("mudancas.linhas_fato"), base.read("gold.fato_vendas")
        theirs = orders.select(F.col("order_id").alias("pedido_id"))
        gone = old.join(theirs, "pedido_id", "left_semi")
        months = [r[0] for r in gone.select(MONTH).union(fresh.select(MONTH)).distinct().collect()]  # as many as months
        if not months:
            run.reuse(base, "gold.fato_vendas")
            run.reuse(base, "gold.pedido_totais")
            return []
        kept = old.filter(self.within(months)).join(theirs, "pedido_id", "left_anti")
        run.replace_months(base, "gold.fato_vendas", kept.unionByName(fresh), months)
        totals = marts.order_totals(run.read("gold.fato_vendas").filter(self.within(months)), repeats=True)
        run.replace_months(base, "gold.pedido_totais", totals, months)
        self.new |= {"gold.fato_vendas", "gold.pedido_totais"}
        return months

    @staticmethod
    def within(months: list, column: Column | None = None) -> Column:
        column = F.col(MONTH) if column is None else column
        inside = column.isin([m for m in months if m is not None])
        return F.coalesce(inside, F.lit(None in months))

    def persons(self, persons: DataFrame, as_of: Column | None) -> None:
        """Touched persons are made anew; days without a purchase count up for all."""
        run, base = self.run, self.base
        customers = run.read("silver.clientes").join(persons, "customer_unique_id", "left_semi")
        theirs = run.read("silver.pedido_pessoa").join(
            persons.select(F.col("customer_unique_id").alias("cliente_id")), "cliente_id", "left_semi"
        )
        orders, items = (
            run.read(f"silver.{n}").join(theirs.select("order_id"), "order_id", "left_semi") for n in ("pedidos", "itens_pedido")
        )
        fresh = gold.person_dimension(customers, orders, items, as_of)
        today = F.current_date() if as_of is None else as_of
        kept = base.read("gold.dim_cliente").join(persons, "customer_unique_id", "left_anti")
        kept = kept.withColumn("dias_sem_comprar", F.datediff(today, "data_ultimo_pedido"))
        run.write("gold.dim_cliente", kept.unionByName(fresh))
        if not run.rows["mudancas.ids_pessoa"]:
            run.reuse(base, "gold.pessoa_totais")
            return
        self.new.add("gold.dim_cliente")
        theirs = persons.select(F.col("customer_unique_id").alias("cliente_id"))
        fresh = marts.person_totals(run.read("gold.pedido_totais").join(theirs, "cliente_id", "left_semi"))
        kept = base.read("gold.pessoa_totais").join(theirs, "cliente_id", "left_anti")
        nobody = marts.person_totals(run.read("gold.pedido_totais").filter("cliente_id IS NULL"))
        kept = kept.filter("cliente_id IS NOT NULL").unionByName(nobody)
        run.write("gold.pessoa_totais", kept.unionByName(fresh))
        self.new.add("gold.pessoa_totais")

    def gold(self, as_of: Column | None) -> None:
        run, base = self.run, self.base
        orders, persons = self.touched()
        months = self.fact(orders)
        self.persons(persons, as_of)
        read = run.read
        self.put("gold.dim_produto", lambda: gold.product_dimension(read("silver.produtos")), "silver.produtos")
        self.put("gold.dim_vendedor", lambda: gold.seller_dimension(read("silver.vendedores")), "silver.vendedores")
        self.put("gold.dim_geografia", lambda: gold.geography_dimension(read("silver.geolocalizacao")), "silver.geolocalizacao")
        self.put("gold.dim_calendario", lambda: gold.calendar_dimension(read("silver.pedidos")), "silver.pedidos")
        fact, totals = read("gold.fato_vendas"), read("gold.pedido_totais")
        if months:
            of_row = F.col("ano") * 100 + F.col("mes")
            others = base.read("gold.mart_vendas_mensal").filter(~self.within(months, of_row))
            run.write("gold.mart_vendas_mensal", others.unionByName(marts.monthly_sales(totals.filter(self.within(months)))))
        else:
            run.reuse(base, "gold.mart_vendas_mensal")
        products, sellers, dim = "gold.dim_produto", "gold.dim_vendedor", "gold.dim_cliente"
        sales, sums = "gold.fato_vendas", "gold.pessoa_totais"
        self.put(
            "gold.mart_categoria_performance", lambda: marts.category_performance(fact, read(products)), sales, products
        )
        self.put("gold.mart_vendedor_performance", lambda: marts.seller_performance(fact, read(sellers)), sales, sellers)
        self.put("gold.mart_geografia", lambda: marts.geography_sales(read(sums), read(dim)), sums, dim)
        self.put("gold.pessoa_numero", lambda: marts.person_numbers(read(dim)), dim)
        self.put("gold.pedido_numero", lambda: marts.order_numbers(totals), "gold.pedido_totais")
        self.put("gold.pessoa_mes", lambda: marts.person_sets(totals, read("gold.pessoa_numero")), sales, "gold.pessoa_numero")
        self.put(
            "gold.pedido_categoria_mes",
            lambda: marts.order_sets(fact, read(products), read("gold.pedido_numero")),
            sales, products, "gold.pedido_numero",
        )


def refresh_changed(
    spark: SparkSession,
    landing: str,
    root: str,
    expected: dict[str, str] | None = None,
    fact_volume: tuple[int, int] = gate.FACT_VOLUME,
    as_of: Column | None = None,
    run_id: str | None = None,
) -> Run:
    """``refresh`` built on the published run; nothing is published unless every count, content, constraint and
    test holds. Without a published run, or where one order is too large for a bucket, it is a full refresh."""
    before = published(spark, root)
    base = Run.load(spark, root, before) if before else None
    if base is None or base.hot:
        return refresh(spark, landing, root, expected, fact_volume, as_of, run_id)
    run = Run(spark, root, run_id, base.buckets, base.hot_rows)
    run.comments = dict(base.comments)
    run.bronze(landing, expected or manifest(), base)
    if any(f"bronze.{t}" not in run.places and t in run.hot for t in BY_ORDER):
        return refresh(spark, landing, root, expected, fact_volume, as_of, buckets=base.buckets)
    change = Change(run, base)
    change.silver()
    change.gold(as_of)
    run.test(fact_volume)
    run.publish()
    return run
