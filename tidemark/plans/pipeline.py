"""The full refresh: landing -> bronze -> silver -> gold -> tests -> published tables."""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.audit import stamped, with_comments
from tidemark.operators.checksum import FIELDS, content
from tidemark.operators.quality import quality_gate
from tidemark.operators.skew import HOT_ROWS
from tidemark.plans import descriptions, gate, gold, kpis, marts, silver
from tidemark.schemas import manifest, raw_schema
from tidemark.session import side_by_side, tune
from tidemark.sources.bronze import (
    CONTENT,
    ReconciliationError,
    ingest_all_string,
    landed_contents,
    reconcile_contents,
    reconcile_counts,
    require_contents,
    require_reconciled,
)
from tidemark.sources.landing import append_arrival_log, arrival_check, read_modes
from tidemark.sources.layout import Layout, attach_statements, months_of, partition_of, partition_path, with_month, write_laid_out
from tidemark.sources.tables import (
    delete_folder,
    folders_in,
    name_over_files,
    name_over_query,
    name_over_table,
    read_text,
    write_finding_hot,
    write_table,
    write_text,
    write_watched,
)

# Columns whose text must be an amount, and the silver table that is made of them.
AMOUNTS = {
    "order_items": ("itens_pedido", ("price", "freight_value")),
    "order_payments": ("pagamentos", ("payment_value",)),
}
ON_BAD = ("abort", "quarantine")

# Tables that are joined by order, in buckets of it; those at the grain of sales also by month of purchase.
LAYOUTS = {
    "silver.pedidos": Layout("order_id"),
    "silver.itens_pedido": Layout("order_id"),
    "silver.pagamentos": Layout("order_id"),
    "silver.avaliacoes": Layout("order_id"),
    "silver.pedido_pessoa": Layout("order_id"),
    "gold.fato_vendas": Layout("pedido_id", month="data_compra"),
    "gold.pedido_totais": Layout("pedido_id", month="data_compra"),
    "gold.pedido_numero": Layout("pedido_id"),
}
BUCKET_ROWS = 1_000_000  # one task joins and sorts a bucket of five tables at once
LEAST_BUCKETS = 4
# Raw tables in which one order may have very many rows, and what is made of each by order.
BY_ORDER = {
    "order_items": ("silver.itens_pedido", "gold.fato_vendas"),
    "order_payments": ("silver.pagamentos",),
    "order_reviews": ("silver.avaliacoes",),
}

def readable(columns: Iterable[str]) -> Column:
    """Whether every one of the columns is NULL or an amount."""
    return reduce(
        Column.__and__,
        (F.col(c).isNull() | F.col(c).try_cast("decimal(18,2)").isNotNull() for c in columns),
    )


class Run:
    """One full refresh in its own folder, so readers keep the old tables until it passes.

    Tables joined by order lie in ``buckets`` of the order, as tables of the run's own schema. A raw table with
    a hot order, of over ``hot_rows`` rows, is found while it is written; what is made of it by order is then
    stored without buckets, as one of them would hold all those rows.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        run_id: str | None = None,
        buckets: int | None = None,
        hot_rows: int = HOT_ROWS,
    ):
        self.spark = tune(spark)
        self.root = root.rstrip("/")
        self.run_id = run_id or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        self.log_path = f"{self.root}/bronze/_raw_arquivos"
        self.rows: dict[str, int] = {}
        self.comments = dict(descriptions.TABLES)
        self.fixed_buckets = buckets
        self.hot_rows = hot_rows
        self.hot: dict[str, DataFrame] = {}
        self.laid_out: dict[str, Layout] = {}
        self.contents: dict[str, list] = {}  # checksum of each landed drop
        self.places: dict[str, str] = {}  # of tables whose files are another run's
        self.parts: dict[str, dict[str, str]] = {}  # of tables by month: where each month lies

    @property
    def buckets(self) -> int:
        """As given, or so many that one holds about ``BUCKET_ROWS`` rows of the largest table by order."""
        most = max((self.rows.get(f"bronze.{t}", 0) for t in BY_ORDER), default=0)
        return self.fixed_buckets or max(LEAST_BUCKETS, -(-most // BUCKET_ROWS))

    @property
    def schema(self) -> str:
        return schema_of(self.run_id)

    def many(self, name: str) -> bool:
        """Whether a table has more rows than a bucket: what moves them has the cluster and the disk to itself."""
        return self.rows.get(name, 0) > BUCKET_ROWS

    def path(self, name: str) -> str:
        return f"{self.root}/runs/{self.run_id}/{name.replace('.', '/')}"

    def table(self, name: str) -> str:
        return f"{self.schema}.{name.replace('.', '_')}"

    def read(self, name: str) -> DataFrame:
        if name in self.laid_out:
            return self.spark.table(self.table(name))
        return self.spark.read.parquet(self.place(name))

    def place(self, name: str) -> str:
        return self.places.get(name, self.path(name))

    def layout(self, name: str) -> Layout | None:
        if any(name in made for raw, made in BY_ORDER.items() if raw in self.hot):
            return None
        return LAYOUTS.get(name)

    def write(self, name: str, df: DataFrame, dealt: bool = False) -> int:
        rules = gate.CONSTRAINTS.get(name.split(".")[1], ())
        if name in LAYOUTS:
            df = with_month(df, LAYOUTS[name])
        commented = with_comments(df, descriptions.COLUMNS.get(name, {}))
        if layout := self.layout(name):
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema}")
            self.rows[name] = write_laid_out(
                commented, self.table(name), self.path(name), layout, self.buckets, rules, dealt
            )
            self.laid_out[name] = layout
            if layout.month:
                months = months_of(self.spark, self.table(name))
                self.parts[name] = {m: partition_path(self.path(name), m) for m in months}
        else:
            self.rows[name] = write_table(commented, self.path(name), rules)
        return self.rows[name]

    def write_raw(self, table: str, df: DataFrame) -> tuple[int, str, int]:
        """Write a raw table; its number of rows and the checksum of what was written."""
        name, path = f"bronze.{table}", self.path(f"bronze.{table}")
        sums = content(raw_schema(table).fieldNames())
        if table in BY_ORDER:
            seen, hot = write_finding_hot(df, path, "order_id", self.hot_rows, more=sums)
            if hot is not None:
                self.hot[table] = hot
        else:
            seen = write_watched(df, path, more=sums)
        self.rows[name] = seen["_rows"]
        return tuple(seen[c] for c in FIELDS)

    def bronze(self, landing: str, expected: dict[str, str], base: "Run | None" = None) -> None:
        """Check arrival, load every file as text, and prove that counts and contents are those of the files.

        A drop with the content it had in the run ``base`` isn't loaded again.
        """
        landing = landing.rstrip("/")
        for table, name in expected.items():
            self.comments[f"bronze.{table}"] = descriptions.BRONZE.format(file=name)
        modes = read_modes(self.spark, landing, list(expected.values()))
        append_arrival_log(
            arrival_check(self.spark, landing, expected, modes=modes), self.log_path
        )
        landed = landed_contents(self.spark, landing, expected, modes).collect()  # one row per table
        self.contents = {r["tabela"]: [r[c] for c in FIELDS] for r in landed}
        same = {t for t in expected if base and base.contents.get(t) == self.contents[t]}
        for table in same:
            self.reuse(base, f"bronze.{table}")
        self.load_raw(landing, {t: n for t, n in expected.items() if t not in same}, modes)

    def load_raw(self, landing: str, expected: dict[str, str], modes: dict[str, str]) -> None:
        """Load drops as text and compare number and content with the files'."""
        if not expected:
            return

        def load(table: str) -> tuple:
            name = expected[table]
            df = ingest_all_string(
                self.spark, f"{landing}/{name}", raw_schema(table), modes[name]
            )
            return table, *self.write_raw(table, df)

        loaded = self.spark.createDataFrame(side_by_side(load, expected), CONTENT)
        counts = loaded.select("tabela", F.col("linhas").alias("linhas_bronze"))
        require_reconciled(reconcile_counts(self.spark.read.parquet(self.log_path), counts))
        landed = [(table, *self.contents[table]) for table in expected]
        require_contents(reconcile_contents(self.spark.createDataFrame(landed, CONTENT), loaded))

    def reuse(self, base: "Run", name: str) -> None:
        """Show a table of an earlier run as it is."""
        if name in base.laid_out:
            for statement in base.attach_as(self, name):
                self.spark.sql(statement)
            self.laid_out[name] = base.laid_out[name]
            if name in base.parts:
                self.parts[name] = base.parts[name]
        self.places[name], self.rows[name] = base.place(name), base.rows[name]

    def replace_months(self, base: "Run", name: str, rows: DataFrame, months: list) -> None:
        """A table by month of which the given months are new; the others keep the files they have."""
        self.write(name, rows)
        fresh = {partition_of(m) for m in months}
        self.parts[name] = {**{m: p for m, p in base.parts[name].items() if m not in fresh}, **self.parts[name]}
        table, schema = self.table(name), self.read(name)
        made = attach_statements(schema, table, self.path(name), LAYOUTS[name], self.buckets, self.parts[name])
        self.spark.sql(f"DROP TABLE {table}")  # its files stay
        for statement in made:
            self.spark.sql(statement)
        self.rows[name] = self.read(name).count()

    def silver(self, on_bad: str = "abort") -> None:
        """Clean every table. Unreadable amounts abort the load or, with ``quarantine``, their rows
        are set aside in a table of their own; no row may get lost between the two."""
        raw = {table: self.read(f"bronze.{table}") for table in manifest()}
        if on_bad == "quarantine":
            for table, (_, columns) in AMOUNTS.items():
                raw[table] = self.set_aside(table, raw[table], columns)
        side_by_side(
            lambda name: self.write(f"silver.{name}", silver.silver_table(name, raw)),
            silver.TABLES,
            [name for name, (source, _) in silver.TABLES.items() if self.many(f"bronze.{source}")],
        )
        orders, customers = self.read("silver.pedidos"), self.read("silver.clientes")
        self.write("silver.pedido_pessoa", gold.order_persons(orders, customers))
        for table, (name, _) in AMOUNTS.items():
            kept, aside = self.rows[f"silver.{name}"], self.rows.get(f"quarantine.{table}", 0)
            if kept + aside != self.rows[f"bronze.{table}"]:
                raise ReconciliationError(f"rows of {table} got lost: {kept} kept, {aside} set aside")

    def set_aside(self, table: str, rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
        good = readable(columns)
        name = f"quarantine.{table}"
        self.write(name, rows.filter(~good))
        self.comments[name] = descriptions.QUARANTINE.format(table=table)
        return rows.filter(good)

    def gold(self, as_of: Column | None = None) -> None:
        """Dimensions and fact read only silver; marts and metrics read only gold."""
        s = {name: self.read(f"silver.{name}") for name in silver.TABLES}
        build = {
            "fato_vendas": lambda: stamped(
                gold.sales_fact(
                    s["itens_pedido"],
                    s["pedidos"],
                    s["clientes"],
                    s["pagamentos"],
                    s["avaliacoes"],
                    hot=self.hot.get("order_items"),
                    hot_rows=self.hot_rows,
                    persons=self.read("silver.pedido_pessoa"),
                )
            ),
            "dim_cliente": lambda: gold.person_dimension(
                s["clientes"], s["pedidos"], s["itens_pedido"], as_of
            ),
            "dim_produto": lambda: gold.product_dimension(s["produtos"]),
            "dim_vendedor": lambda: gold.seller_dimension(s["vendedores"]),
            "dim_geografia": lambda: gold.geography_dimension(s["geolocalizacao"]),
            "dim_calendario": lambda: gold.calendar_dimension(s["pedidos"]),
        }
        # the tables it is joined of are dealt by order already
        dealt = not self.hot
        side_by_side(
            lambda name: self.write(f"gold.{name}", build[name](), dealt and name == "fato_vendas"),
            build,
            ["dim_cliente"] if self.many("silver.pedidos") else (),  # moves all orders: before the fact takes its place
        )

        fact = self.read("gold.fato_vendas")
        totals = marts.order_totals(fact, repeats=True)
        self.write("gold.pedido_totais", totals, dealt="gold.fato_vendas" in self.laid_out)
        orders = self.read("gold.pedido_totais")
        self.write("gold.pessoa_totais", marts.person_totals(orders))
        self.write("gold.pessoa_numero", marts.person_numbers(self.read("gold.dim_cliente")))
        self.write("gold.pedido_numero", marts.order_numbers(orders))
        sets = {
            "pessoa_mes": lambda: marts.person_sets(orders, self.read("gold.pessoa_numero")),
            "pedido_categoria_mes": lambda: marts.order_sets(
                fact, self.read("gold.dim_produto"), self.read("gold.pedido_numero")
            ),
        }
        side_by_side(lambda name: self.write(f"gold.{name}", sets[name]()), sets, sets if self.many("gold.fato_vendas") else ())
        reports = {
            "mart_vendas_mensal": lambda: marts.monthly_sales(orders),
            "mart_categoria_performance": lambda: marts.category_performance(
                fact, self.read("gold.dim_produto"), self.read("gold.pedido_categoria_mes")
            ),
            "mart_vendedor_performance": lambda: marts.seller_performance(
                fact, self.read("gold.dim_vendedor")
            ),
            "mart_geografia": lambda: marts.geography_sales(
                self.read("gold.pessoa_totais"), self.read("gold.dim_cliente")
            ),
        }
        side_by_side(lambda name: self.write(f"gold.{name}", reports[name]()), reports)

    def test(self, fact_volume: tuple[int, int] = gate.FACT_VOLUME) -> DataFrame:
        """Compute the report once, keep it, and stop the run if any test failed."""
        s, g = "silver.", "gold."
        report = gate.gate_report(
            self.read(g + "fato_vendas"),
            self.read(s + "itens_pedido"),
            self.read(s + "pedidos"),
            self.read(g + "dim_cliente"),
            self.read(g + "dim_geografia"),
            self.read(g + "mart_categoria_performance"),
            self.read(g + "mart_vendas_mensal"),
            fact_volume,
            totals=self.read(g + "pedido_totais"),
        )
        keys = gate.key_report(
            {
                "clientes": (self.read(s + "clientes"), ("customer_id",)),
                "pedidos": (self.read(s + "pedidos"), ("order_id",)),
                "dim_cliente": (self.read(g + "dim_cliente"), ("customer_unique_id",)),
                "dim_produto": (self.read(g + "dim_produto"), ("product_id",)),
                "dim_vendedor": (self.read(g + "dim_vendedor"), ("seller_id",)),
                "dim_geografia": (self.read(g + "dim_geografia"), ("cep_prefixo",)),
            },
            totals=self.read(g + "pedido_totais"),
        )
        self.write("gold.relatorio_testes", report.unionByName(keys))
        kept = self.read("gold.relatorio_testes").orderBy("teste")
        kept.createOrReplaceTempView("_resultados_testes")
        quality_gate(kept)
        return kept

    def statements(self) -> list[str]:
        """One statement per published name; each replaces its name in one step."""
        views = [f"gold.{name}" for name in kpis.VIEWS]
        names = {n: c for n, c in self.comments.items() if n not in views}
        found = [
            name_over_table(self.spark, self.table(n), n, c)
            if n in self.laid_out
            else name_over_files(self.spark, self.place(n), n, c)
            for n, c in names.items()
        ]
        found.append(
            name_over_files(self.spark, self.log_path, "bronze._raw_arquivos", descriptions.LOG)
        )
        for view in views:
            text, source = kpis.VIEWS[view.removeprefix("gold.")]
            query = text.replace("{rows}", f"gold.{source}")
            found.append(name_over_query(query, view, self.comments[view]))
        return found

    def attach_as(self, other: "Run", name: str, parts: dict[str, str] | None = None) -> list[str]:
        """What makes a table of this run, or one with its files, known to the catalog as ``other``'s."""
        found = parts if parts is not None else self.parts.get(name)
        return attach_statements(
            self.read(name), other.table(name), self.place(name), self.laid_out[name], self.buckets, found
        )

    def attachments(self) -> list[str]:
        """What a catalog that lost them, or never had them, needs to know the run's tables."""
        return [statement for name in self.laid_out for statement in self.attach_as(self, name)]

    def uses(self) -> list[str]:
        """The runs whose files this one shows."""
        paths = [*self.places.values(), *(p for parts in self.parts.values() for p in parts.values())]
        prefix = f"{self.root}/runs/"
        return sorted({p.removeprefix(prefix).split("/")[0] for p in paths} | {self.run_id})

    def save(self) -> None:
        """Keep what a later run needs to build on this one."""
        kept = {
            "rows": self.rows,
            "comments": self.comments,
            "buckets": self.buckets,
            "hot": sorted(self.hot),
            "laid_out": sorted(self.laid_out),
            "contents": self.contents,
            "places": self.places,
            "parts": self.parts,
            "uses": self.uses(),
        }
        write_text(self.spark, f"{self.path('')}run.json", json.dumps(kept))
        write_text(self.spark, f"{self.path('')}tables.json", json.dumps(self.attachments()))

    @classmethod
    def load(cls, spark: SparkSession, root: str, run_id: str) -> "Run":
        """A run that was saved, for reading."""
        kept = json.loads(read_text(spark, f"{root.rstrip('/')}/runs/{run_id}/run.json"))
        run = cls(spark, root, run_id, kept["buckets"])
        for key in ("rows", "comments", "contents", "places", "parts"):
            setattr(run, key, kept[key])
        run.hot = {name: spark.read.parquet(f"{run.path(f'bronze.{name}')}_quentes") for name in kept["hot"]}
        run.laid_out = {name: LAYOUTS[name] for name in kept["laid_out"]}
        attach(spark, run.root, run_id)
        return run

    def publish(self) -> None:
        """Point every name to this run.

        The run's statements are kept with it and the switch is noted first, so that a failure half
        way goes back to the run before, and a lost driver's switch can be completed by ``repair``.
        """
        statements = self.statements()
        write_text(self.spark, f"{self.path('')}names.json", json.dumps(statements))
        self.save()
        for schema in sorted({name.split(".")[0] for name in self.comments}):
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
        before = published(self.spark, self.root)
        write_text(self.spark, f"{self.root}/{STATE}", json.dumps({"run": before, "next": self.run_id}))
        try:
            switch(self.spark, statements)
        except Exception:
            if before:
                attach(self.spark, self.root, before)
                switch(self.spark, names_of(self.spark, self.root, before))
                write_text(self.spark, f"{self.root}/{STATE}", json.dumps({"run": before}))
            raise
        write_text(self.spark, f"{self.root}/{STATE}", json.dumps({"run": self.run_id}))


STATE = "published.json"


def schema_of(run_id: str) -> str:
    return "run_" + "".join(c if c.isalnum() else "_" for c in run_id)


def attach(spark: SparkSession, root: str, run_id: str) -> None:
    """Make a run's tables known again where the catalog has lost them; does nothing where it hasn't."""
    for statement in json.loads(read_text(spark, f"{root}/runs/{run_id}/tables.json") or "[]"):
        spark.sql(statement)


def switch(spark: SparkSession, statements: list[str]) -> None:
    for statement in statements:
        name = statement.split()[4]
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
            spark.sql(f"DROP TABLE {name}")  # published as a table by an earlier version
        spark.sql(statement)


def names_of(spark: SparkSession, root: str, run_id: str) -> list[str]:
    return json.loads(read_text(spark, f"{root}/runs/{run_id}/names.json"))


def published(spark: SparkSession, root: str) -> str | None:
    """The run that all names show."""
    state = read_text(spark, f"{root.rstrip('/')}/{STATE}")
    return json.loads(state)["run"] if state else None


def repair(spark: SparkSession, root: str) -> str | None:
    """Complete a switch whose driver was lost; its run had passed every test. The run shown."""
    root = root.rstrip("/")
    state = json.loads(read_text(spark, f"{root}/{STATE}") or "{}")
    if run_id := state.get("next"):
        attach(spark, root, run_id)
        switch(spark, names_of(spark, root, run_id))
        write_text(spark, f"{root}/{STATE}", json.dumps({"run": run_id}))
        return run_id
    return state.get("run")


def expire_runs(spark: SparkSession, root: str, keep: int = 7) -> list[str]:
    """Delete all but the newest runs; the published one, one being published, and those whose files a staying
    one shows always stay."""
    root = root.rstrip("/")
    state = json.loads(read_text(spark, f"{root}/{STATE}") or "{}")
    runs = folders_in(spark, f"{root}/runs")
    staying = {*runs[max(0, len(runs) - max(keep, 1)) :], state.get("run"), state.get("next")}
    for run in [r for r in staying if r]:  # a run may show files of earlier ones
        staying.update(json.loads(read_text(spark, f"{root}/runs/{run}/run.json") or "{}").get("uses", ()))
    gone = [run for run in runs if run not in staying]
    for run in gone:
        spark.sql(f"DROP SCHEMA IF EXISTS {schema_of(run)} CASCADE")
        delete_folder(spark, f"{root}/runs/{run}")
    return gone


def refresh(
    spark: SparkSession,
    landing: str,
    root: str,
    expected: dict[str, str] | None = None,
    fact_volume: tuple[int, int] = gate.FACT_VOLUME,
    as_of: Column | None = None,
    run_id: str | None = None,
    on_bad: str = "abort",
    buckets: int | None = None,
) -> Run:
    """Do all of it; nothing is published unless every count, constraint and test holds."""
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad is one of {ON_BAD}, not {on_bad!r}")
    run = Run(spark, root, run_id, buckets)
    run.bronze(landing, expected or manifest())
    run.silver(on_bad)
    run.gold(as_of)
    run.test(fact_volume)
    run.publish()
    return run
