"""The registered queries in DuckDB SQL, written from the definitions, not from the Spark code.

``CTES`` is the chain raw table -> silver -> gold; each oracle takes the part it needs.
"""

from __future__ import annotations

import re

from tidemark.plans import descriptions
from tidemark.sources.layout import MONTH, MONTH_NOTE


def stamp(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def zip5(expr: str) -> str:
    return f"lpad(regexp_replace(trim({expr}), '[^0-9]', '', 'g'), 5, '0')"


def initcap(expr: str) -> str:
    words = f"string_split(trim({expr}), ' ')"
    return (
        f"list_aggregate(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), "
        "'string_agg', ' ')"
    )


def parsed(expr: str) -> str:
    return f"try_cast({expr} AS timestamp)"


def days(later: str, earlier: str) -> str:
    return f"cast(datediff('day', {earlier}, {later}) AS int)"


def whole(expr: str) -> str:
    """Spark reads an integer only from an integer literal; DuckDB would also round '12.6'."""
    return f"CASE WHEN regexp_full_match(trim({expr}), '[+-]?[0-9]+') THEN try_cast({expr} AS int) END"


def fixed_mean(expr: str) -> str:
    """Mean of nine-digit numbers: an exact sum, one division."""
    number = f"try_cast({expr} AS decimal(20,9))"
    return f"sum(cast({number} * 1000000000 AS hugeint))::DOUBLE / nullif(count({number})::DOUBLE * 1e9, 0)"


CTES: dict[str, str] = {
    # raw
    "r_customers": """
        SELECT cast(o_orderkey AS varchar) AS customer_id,
               cast(o_custkey AS varchar) AS customer_unique_id,
               ' ' || cast(c_nationkey * 37 + o_orderkey % 7 AS varchar) || '-x ' AS zip,
               '  ' || o_orderpriority || ' ' || c_mktsegment AS city,
               ' ' || lower(c_mktsegment[1:2]) || ' ' AS state
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "r_orders": f"""
        SELECT cast(o_orderkey AS varchar) AS order_id,
               cast(o_orderkey AS varchar) AS customer_id,
               CASE o_orderstatus WHEN 'P' THEN 'canceled' WHEN 'F' THEN 'delivered'
                    ELSE 'shipped' END AS status,
               {stamp("o_orderdate")} AS purchase,
               {stamp("o_orderdate + INTERVAL 1 HOUR")} AS approved,
               CASE WHEN o_orderkey % 5 = 0 THEN ''
                    ELSE {stamp("o_orderdate + to_days(cast(o_orderkey % 3 AS int)) + INTERVAL 2 HOUR")}
               END AS carrier,
               CASE WHEN o_orderstatus <> 'F' THEN NULL
                    WHEN o_orderkey % 97 = 0 THEN 'unknown'
                    ELSE {stamp("o_orderdate + to_days(cast(o_orderkey % 23 AS int)) + INTERVAL 5 HOUR")}
               END AS delivered,
               {stamp("o_orderdate + to_days(cast(10 + o_orderkey % 5 AS int))")} AS estimated
        FROM orders""",
    "r_products": """
        SELECT cast(p_partkey AS varchar) AS product_id,
               CASE WHEN p_partkey % 31 <> 0 THEN p_type || ' ' || p_brand END AS category,
               cast(length(p_name) AS varchar) AS name_length,
               cast(length(p_name) * 10 AS varchar) AS text_length,
               CASE WHEN p_size % 10 = 0 THEN 'many' ELSE cast(p_size % 6 AS varchar) END AS photos,
               cast(p_size * 100 AS varchar) AS weight,
               ' ' || cast(p_size AS varchar) || ' ' AS len,
               CASE WHEN p_size % 7 = 0 THEN '' ELSE cast(p_size + 1 AS varchar) END AS height,
               cast(p_size + 2 AS varchar) AS width
        FROM part""",
    "r_translation": """
        SELECT DISTINCT p_type || ' ' || p_brand AS category,
               lower(p_type || ' ' || p_brand) || '_en' AS english
        FROM part WHERE length(p_type) % 2 = 0""",
    "r_geolocation": """
        SELECT ' ' || cast(c_custkey % 400 AS varchar) || ' ' AS zip,
               CASE WHEN c_custkey % 50 = 0 THEN 'n/a' ELSE cast(c_acctbal AS varchar) END AS lat,
               cast(c_custkey % 180 - 90 AS varchar) AS lng,
               CASE WHEN c_custkey % 3 <> 0 THEN lower(c_mktsegment) || ' city' END AS city,
               lower(c_mktsegment[1:2]) AS state
        FROM customer""",
    # silver
    "clientes": f"""
        SELECT customer_id, customer_unique_id, {zip5("zip")} AS cep_prefixo,
               {initcap("city")} AS cidade, upper(trim(state)) AS uf
        FROM r_customers""",
    "pedidos": f"""
        SELECT order_id, customer_id, status, status = 'canceled' AS cancelado,
               status = 'delivered' AS entregue, {parsed("purchase")} AS data_compra,
               {parsed("approved")} AS data_aprovacao,
               {parsed("carrier")} AS data_envio_transportadora,
               {parsed("delivered")} AS data_entrega_cliente,
               {parsed("estimated")} AS data_estimada_entrega,
               {days(parsed("delivered"), parsed("purchase"))} AS tempo_entrega_dias,
               {days(parsed("delivered"), parsed("estimated"))} AS atraso_dias,
               cast(year({parsed("purchase")}) AS int) AS ano,
               cast(month({parsed("purchase")}) AS int) AS mes
        FROM r_orders""",
    "produtos": f"""
        SELECT product_id, p.category AS categoria, coalesce(english, p.category) AS categoria_en,
               {whole("weight")} AS peso_g, {whole("len")} AS comprimento_cm,
               {whole("height")} AS altura_cm, {whole("width")} AS largura_cm,
               {whole("photos")} AS qtd_fotos, {whole("name_length")} AS tamanho_nome_caracteres,
               {whole("text_length")} AS tamanho_descricao_caracteres
        FROM r_products p LEFT JOIN r_translation t ON t.category = p.category""",
    "vendedores": f"""
        SELECT cast(s_suppkey AS varchar) AS seller_id,
               {zip5("cast(s_nationkey AS varchar) || '.' || cast(s_suppkey AS varchar)")}
                   AS cep_prefixo,
               {initcap("' ' || n_name || ' branch '")} AS cidade, upper(n_name[1:2]) AS uf
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "itens_pedido": """
        SELECT cast(l_orderkey AS varchar) AS order_id, l_linenumber AS item_id,
               cast(l_partkey AS varchar) AS product_id, cast(l_suppkey AS varchar) AS seller_id,
               date_trunc('second', l_shipdate) AS data_limite_envio,
               cast(l_extendedprice AS decimal(18,2)) AS preco,
               cast(cast(l_extendedprice AS decimal(18,2)) * cast(l_tax AS decimal(4,2))
                    AS decimal(18,2)) AS frete,
               preco + frete AS valor_item
        FROM lineitem""",
    "pagamentos": """
        SELECT cast(l_orderkey AS varchar) AS order_id,
               CASE WHEN cast(l_quantity AS int) % 11 <> 0 THEN l_linenumber END AS sequencial,
               l_returnflag AS tipo_pagamento, cast(l_quantity AS int) AS parcelas,
               cast(l_extendedprice AS decimal(18,2)) AS valor_pagamento
        FROM lineitem""",
    "avaliacoes": """
        SELECT * EXCLUDE (n) FROM (
          SELECT *, row_number() OVER (PARTITION BY review_id
                      ORDER BY data_resposta DESC NULLS LAST, data_criacao DESC NULLS LAST,
                               order_id DESC) AS n
          FROM (SELECT cast(user_id AS varchar) || '-' || event_type AS review_id,
                       cast(event_id AS varchar) AS order_id,
                       cast(event_id % 5 + 1 AS int) AS nota,
                       event_type AS titulo_comentario, props AS mensagem_comentario,
                       date_trunc('day', ts) AS data_criacao,
                       CASE WHEN event_id % 13 <> 0 THEN date_trunc('second', ts) END
                           AS data_resposta
                FROM events)) WHERE n = 1""",
    "geolocalizacao": f"""
        SELECT {zip5("zip")} AS cep_prefixo, {fixed_mean("lat")} AS latitude,
               {fixed_mean("lng")} AS longitude,
               min({initcap("city")}) AS cidade, min(upper(trim(state))) AS uf,
               count(*) AS qtd_pontos_origem
        FROM r_geolocation GROUP BY 1""",
    # gold
    "visitas": """
        SELECT c.customer_unique_id, c.cidade, c.uf, c.cep_prefixo, p.order_id, p.data_compra,
               p.cancelado,
               (SELECT sum(valor_item) FROM itens_pedido i WHERE i.order_id = p.order_id) AS valor
        FROM clientes c JOIN pedidos p ON p.customer_id = c.customer_id""",
    "dim_cliente": """
        SELECT h.customer_unique_id, r.cidade, r.uf, r.cep_prefixo, h.primeiro AS data_primeiro_pedido,
               h.ultimo AS data_ultimo_pedido, h.total_pedidos, h.receita_acumulada,
               cast(datediff('day', h.ultimo, timestamp '2002-01-01') AS int) AS dias_sem_comprar
        FROM (SELECT customer_unique_id, count(DISTINCT order_id) AS total_pedidos,
                     sum(CASE WHEN cancelado THEN 0 ELSE coalesce(valor, 0) END) AS receita_acumulada,
                     min(data_compra) FILTER (NOT cancelado) AS primeiro,
                     max(data_compra) FILTER (NOT cancelado) AS ultimo
              FROM visitas GROUP BY 1) h
        JOIN (SELECT *, row_number() OVER (PARTITION BY customer_unique_id
                                           ORDER BY data_compra DESC, order_id DESC) AS n
              FROM visitas) r ON r.customer_unique_id = h.customer_unique_id AND r.n = 1""",
    "pago": """
        SELECT order_id, sum(valor_pagamento) AS valor_pago,
               first(tipo_pagamento ORDER BY sequencial, tipo_pagamento)
                   FILTER (sequencial IS NOT NULL) AS metodo
        FROM pagamentos GROUP BY 1""",
    "fato": """
        SELECT i.order_id AS pedido_id, i.item_id, p.customer_id,
               c.customer_unique_id AS cliente_id, i.product_id AS produto_id,
               i.seller_id AS vendedor_id, p.data_compra, p.status, p.cancelado, p.entregue,
               p.tempo_entrega_dias, p.atraso_dias, i.preco, i.frete, i.valor_item AS receita,
               pago.valor_pago, pago.metodo AS metodo_pagamento_principal,
               a.nota AS nota_avaliacao
        FROM itens_pedido i JOIN pedidos p ON p.order_id = i.order_id
        JOIN clientes c ON c.customer_id = p.customer_id
        LEFT JOIN pago ON pago.order_id = i.order_id
        LEFT JOIN (SELECT order_id, avg(nota) AS nota FROM avaliacoes GROUP BY 1) a
               ON a.order_id = i.order_id""",
    "valido": "SELECT * FROM fato WHERE NOT cancelado",
    "m_mensal": """
        SELECT cast(year(data_compra) AS int) AS ano, cast(month(data_compra) AS int) AS mes,
               count(DISTINCT pedido_id) AS total_pedidos, sum(receita) AS receita,
               round(avg(tempo_entrega_dias), 1) AS tempo_entrega_medio_dias
        FROM valido GROUP BY 1, 2""",
    "m_categoria": """
        SELECT coalesce(d.categoria_en, 'sem_categoria') AS categoria_en, count(*) AS itens_vendidos,
               count(DISTINCT pedido_id) AS pedidos, sum(receita) AS receita,
               round(avg(nota_avaliacao), 2) AS nota_media
        FROM valido LEFT JOIN produtos d ON d.product_id = produto_id GROUP BY 1""",
}

_AFTER_FROM = re.compile(r"\b(?:FROM|JOIN)\s+(\w+)")


def needed(sql: str, ctes: dict[str, str], found: list[str] | None = None) -> list[str]:
    """CTEs the statement reads, dependencies first."""
    found = [] if found is None else found
    for name in _AFTER_FROM.findall(sql):
        if name in ctes and name not in found:
            needed(ctes[name], ctes, found)
            found.append(name)
    return found


def oracle(sql: str, ctes: dict[str, str] = CTES) -> str:
    used = ",\n".join(f"{name} AS ({ctes[name]})" for name in needed(sql, ctes))
    return f"WITH {used}\n{sql}" if used else sql


def money(*columns: str) -> str:
    return ", ".join(f"cast({c} AS double) AS {c}" for c in columns)


def shown(*columns: str) -> str:
    return ", ".join(f"{stamp(c)} AS {c}" for c in columns)


def check(name: str, value: str, expected: str, passed: str) -> str:
    return (
        f"SELECT '{name}' AS teste, cast({value} AS varchar) AS valor, "
        f"cast({expected} AS varchar) AS esperado, coalesce({passed}, false) AS passou"
    )


def amounts(name: str, a: str, b: str) -> str:
    return check(name, f"round(({a}), 2)", f"round(({b}), 2)", f"abs(({a}) - ({b})) <= 0.01")


def none(name: str, count: str) -> str:
    return check(name, f"({count})", "'0'", f"({count}) = 0")


def volume(low: int, high: int) -> str:
    return check(
        "volume_fato_vendas",
        "(SELECT count(*) FROM fato)",
        f"'entre {low} e {high}'",
        f"(SELECT count(*) FROM fato) BETWEEN {low} AND {high}",
    )


CHECKS = {
    "check_revenue_total": amounts(
        "receita_gold_igual_silver",
        "SELECT sum(receita) FROM fato",
        "SELECT sum(valor_item) FROM itens_pedido",
    ),
    "check_order_orphans": none(
        "sem_item_orfao_de_pedido",
        "SELECT count(*) FROM fato WHERE pedido_id NOT IN (SELECT order_id FROM pedidos)",
    ),
    "check_person_orphans": none(
        "sem_item_orfao_de_cliente",
        "SELECT count(*) FROM fato "
        "WHERE cliente_id NOT IN (SELECT customer_unique_id FROM dim_cliente)",
    ),
    "check_purchase_date": none(
        "data_compra_nao_nula", "SELECT count(*) FROM pedidos WHERE data_compra IS NULL"
    ),
    "check_review_score": none(
        "nota_avaliacao_entre_1_e_5",
        "SELECT count(*) FROM fato WHERE nota_avaliacao NOT BETWEEN 1 AND 5",
    ),
    "check_fact_volume": volume(100_000, 120_000),
    "check_category_total": amounts(
        "mart_categoria_soma_igual_fato",
        "SELECT sum(receita) FROM m_categoria",
        "SELECT sum(receita) FROM valido",
    ),
    "check_monthly_total": amounts(
        "mart_vendas_mensal_soma_igual_fato",
        "SELECT sum(receita) FROM m_mensal",
        "SELECT sum(receita) FROM valido",
    ),
    "check_zip_format": none(
        "cep_prefixo_5_digitos_dim_geografia",
        "SELECT count(*) FROM geolocalizacao WHERE length(cep_prefixo) <> 5",
    ),
}

def report_of(low: int, high: int) -> str:
    checks = {**CHECKS, "check_fact_volume": volume(low, high)}
    return " UNION ALL ".join(f"({sql})" for sql in checks.values())


SOURCES = {
    "clientes": ("orders", "clientes"),
    "pedidos": ("orders", "pedidos"),
    "produtos": ("part", "produtos"),
    "vendedores": ("supplier", "vendedores"),
    "itens_pedido": ("lineitem", "itens_pedido"),
    "pagamentos": ("lineitem", "pagamentos"),
    "avaliacoes": ("events", "avaliacoes"),
    "geolocalizacao": ("customer", "geolocalizacao"),
}

CONSTRAINTS = (
    ("clientes", "clientes", "cep_prefixo_5_digitos", "length(cep_prefixo) = 5"),
    ("clientes", "clientes", "uf_2_letras", "length(uf) = 2"),
    ("pedidos", "pedidos", "data_compra_nao_nula", "data_compra IS NOT NULL"),
    ("vendedores", "vendedores", "cep_prefixo_5_digitos", "length(cep_prefixo) = 5"),
    ("itens_pedido", "itens_pedido", "preco_nao_negativo", "preco >= 0"),
    ("avaliacoes", "avaliacoes", "nota_entre_1_e_5", "nota BETWEEN 1 AND 5"),
    ("geolocalizacao", "geolocalizacao", "cep_prefixo_5_digitos", "length(cep_prefixo) = 5"),
    ("fato_vendas", "fato", "grao_item_unico", "pedido_id IS NOT NULL AND item_id IS NOT NULL"),
)

KEYS = {
    "clientes": ("clientes", "customer_id"),
    "pedidos": ("pedidos", "order_id"),
    "dim_cliente": ("dim_cliente", "customer_unique_id"),
    "dim_produto": ("produtos", "product_id"),
    "dim_vendedor": ("vendedores", "seller_id"),
    "dim_geografia": ("geolocalizacao", "cep_prefixo"),
    "fato_vendas": ("fato", "pedido_id, item_id"),
}


def per_order(total: str, orders: str) -> str:
    """Exact half-up cents; DuckDB would divide decimals as doubles."""
    cents = f"cast({total} * 100 AS hugeint)"
    return f"cast((2 * {cents} + {orders}) // (2 * {orders}) AS double) / 100"


def mean_of(column: str, digits: int) -> str:
    return f"round(avg({column}), {digits})"


def cancellation(source: str, key: str) -> str:
    return f"""
        SELECT cast(year(data_compra) AS int) AS ano, cast(month(data_compra) AS int) AS mes,
               count(*) AS total_pedidos, count_if(cancelado) AS pedidos_cancelados,
               cast(round(cast(100.0 * count_if(cancelado) AS decimal(20,6)) / count(*), 2)
                    AS double) AS taxa_cancelamento_pct
        FROM (SELECT DISTINCT {key}, data_compra, cancelado FROM {source}) GROUP BY 1, 2"""


def payments(columns: str) -> str:
    return f"""
        SELECT coalesce(metodo_pagamento_principal, 'nao_informado') AS metodo_pagamento,
               count(*) AS total_pedidos, cast(sum(valor_pago) AS double) AS valor_total_pago
        FROM (SELECT DISTINCT {columns} FROM valido) GROUP BY 1"""


def ingested(message: str) -> str:
    return f"""
        SELECT cast(doc_id AS varchar) AS review_id, cast(NULL AS varchar) AS review_score,
               source AS review_comment_title, md5({message}) AS mensagem_md5,
               cast(length({message}) AS int) AS mensagem_tamanho
        FROM documents"""


RAW_ROWS = {
    "customers": "orders",
    "geolocation": "customer",
    "orders": "orders",
    "order_items": "lineitem",
    "order_payments": "lineitem",
    "order_reviews": "events",
    "products": "part",
    "sellers": "supplier",
    "product_category_translation": "r_translation",
}

GOLD_ROWS = {
    "dim_cliente": "count(*) FROM dim_cliente",
    "dim_produto": "count(*) FROM produtos",
    "dim_vendedor": "count(*) FROM vendedores",
    "dim_geografia": "count(*) FROM geolocalizacao",
    "dim_calendario": "datediff('day', min(data_compra), max(data_compra)) + 1 FROM pedidos",
    "fato_vendas": "count(*) FROM fato",
    "pedido_totais": "count(DISTINCT pedido_id) FROM fato",
    "pessoa_totais": "count(DISTINCT cliente_id) FROM valido",
    "pessoa_numero": "count(*) FROM dim_cliente",
    "pedido_numero": "count(DISTINCT pedido_id) FROM fato",
    "mart_vendas_mensal": "count(*) FROM m_mensal",
    "mart_categoria_performance": "count(*) FROM m_categoria",
    "mart_vendedor_performance": "count(DISTINCT vendedor_id) FROM valido",
    "mart_geografia": """count(DISTINCT d.uf) FROM valido
        JOIN dim_cliente d ON d.customer_unique_id = cliente_id""",
}



def contents_of(name: str, same: bool = True) -> str:
    return (
        f"SELECT '{name}' AS tabela, count(*) AS linhas_raw, count(*) AS linhas_bronze, true AS conta_bate, "
        f"{str(same).lower()} AS conteudo_bate FROM {RAW_ROWS[name]}"
    )


def literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def described() -> list[tuple[str, str | None, str]]:
    """The written descriptions, as the catalog should give them back."""
    rows = [(f"bronze.{name}", None, descriptions.BRONZE.format(file=f"{name}.csv")) for name in RAW_ROWS]
    rows += [(name, None, text) for name, text in descriptions.TABLES.items()]
    rows += [(name, c, text) for name, columns in descriptions.COLUMNS.items() for c, text in columns.items()]
    return rows + [(name, MONTH, MONTH_NOTE) for name in ("gold.fato_vendas", "gold.pedido_totais")]


# Queries that give what another gives, by another way: from tables in buckets, or through published names.
SAME = {
    "sales_fact_in_buckets": "sales_fact",
    "view_kpi_snapshot": "kpi_snapshot",
    "view_cancellation_rate": "cancellation_rate",
    "view_payment_mix_per_item_value": "payment_mix_per_item_value",
    "view_payment_mix_per_order": "payment_mix_per_order",
    "view_top_categories": "top_categories",
}

STATEMENTS: dict[str, str] = {
    "refresh_tables": " UNION ALL ".join(
        [f"SELECT 'bronze.{name}' AS tabela, count(*) AS linhas FROM {source}" for name, source in RAW_ROWS.items()]
        + [f"SELECT 'silver.{name}', count(*) FROM {cte}" for name, (_, cte) in SOURCES.items()]
        + ["SELECT 'silver.pedido_pessoa', count(*) FROM pedidos JOIN clientes USING (customer_id)"]
        + [f"SELECT 'gold.{name}', {rows}" for name, rows in GOLD_ROWS.items()]
    ),
    "arrival_check": " UNION ALL ".join(
        f"SELECT '{name}' AS tabela, '{name}.csv' AS arquivo, count(*) AS linhas FROM {source}"
        for name, source in RAW_ROWS.items()
    ),
    "bronze_ingest": ingested("text"),
    "bronze_ingest_stitched": ingested("text"),
    "bronze_ingest_lines": ingested("translate(text, chr(13) || chr(10), '  ')"),
    "bronze_reconciliation": " UNION ALL ".join(
        f"SELECT '{name}' AS tabela, count(*) AS linhas_bronze, count(*) AS linhas_raw, "
        f"true AS bate FROM {source}"
        for name, source in RAW_ROWS.items()
    ),
    "clean_customers": "SELECT * FROM clientes",
    "clean_orders": "SELECT * REPLACE ("
    + shown(
        "data_compra",
        "data_aprovacao",
        "data_envio_transportadora",
        "data_entrega_cliente",
        "data_estimada_entrega",
    )
    + ") FROM pedidos",
    "clean_products": "SELECT * FROM produtos",
    "clean_sellers": "SELECT * FROM vendedores",
    "clean_items": f"""SELECT * REPLACE ({shown("data_limite_envio")},
        {money("preco", "frete", "valor_item")}) FROM itens_pedido""",
    "clean_payments": f"SELECT * REPLACE ({money('valor_pagamento')}) FROM pagamentos",
    "clean_reviews": f"""SELECT * REPLACE ({shown("data_criacao", "data_resposta")})
        FROM avaliacoes""",
    "mean_point_geolocation": "SELECT * FROM geolocalizacao",
    "latest_line_per_key": f"""
        SELECT l_orderkey, l_linenumber, {stamp("l_shipdate")} AS l_shipdate, l_partkey, l_suppkey,
               l_extendedprice
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS n
              FROM lineitem) WHERE n = 1""",
    "audit_source_rows": " UNION ALL ".join(
        f"SELECT '{name}' AS tabela, (SELECT count(*) FROM {source}) AS linhas_origem, "
        f"(SELECT count(*) FROM {cte}) AS linhas"
        for name, (source, cte) in SOURCES.items()
    ),
    "person_dimension": f"""SELECT * REPLACE (
        {shown("data_primeiro_pedido", "data_ultimo_pedido")}, {money("receita_acumulada")})
        FROM dim_cliente""",
    "product_dimension": """SELECT * EXCLUDE (tamanho_nome_caracteres,
        tamanho_descricao_caracteres) FROM produtos""",
    "seller_dimension": "SELECT * FROM vendedores",
    "geography_dimension": "SELECT * EXCLUDE (qtd_pontos_origem) FROM geolocalizacao",
    "calendar_dimension": """
        SELECT cast(cast(d AS date) AS varchar) AS data, cast(year(d) AS int) AS ano,
               cast(month(d) AS int) AS mes, strftime(d, '%B') AS nome_mes,
               cast(quarter(d) AS int) AS trimestre, strftime(d, '%A') AS dia_semana,
               month(d) IN (5, 8, 11, 12) AS mes_pico_varejo_br
        FROM (SELECT unnest(generate_series(min(data_compra), max(data_compra), INTERVAL 1 DAY)) AS d
              FROM pedidos)""",
    "sales_fact": f"""SELECT * REPLACE ({shown("data_compra")},
        {money("preco", "frete", "receita", "valor_pago")}) FROM fato""",
    "sales_fact_hot_order": f"""SELECT * REPLACE ({shown("data_compra")},
        {money("preco", "frete", "receita", "valor_pago")}) FROM fato""",
    "monthly_sales": f"""SELECT * REPLACE ({money("receita")}),
        {per_order("m_mensal.receita", "total_pedidos")} AS ticket_medio FROM m_mensal""",
    "category_performance": f"SELECT * REPLACE ({money('receita')}) FROM m_categoria",
    "seller_performance": f"""
        SELECT vendedor_id, v.cidade, v.uf, count(*) AS itens_vendidos,
               count(DISTINCT pedido_id) AS pedidos, cast(sum(receita) AS double) AS receita,
               {mean_of("atraso_dias", 1)} AS atraso_medio_dias,
               {mean_of("nota_avaliacao", 2)} AS nota_media
        FROM valido LEFT JOIN vendedores v ON v.seller_id = vendedor_id GROUP BY ALL""",
    "geography_sales": """
        SELECT d.uf, count(DISTINCT cliente_id) AS clientes_unicos,
               count(DISTINCT pedido_id) AS pedidos, cast(sum(receita) AS double) AS receita
        FROM valido JOIN dim_cliente d ON d.customer_unique_id = cliente_id GROUP BY 1""",
    "kpi_snapshot": f"""
        SELECT count(DISTINCT pedido_id) AS total_pedidos,
               count(DISTINCT cliente_id) AS total_clientes, cast(sum(receita) AS double) AS gmv,
               {per_order("sum(receita)", "count(DISTINCT pedido_id)")} AS ticket_medio,
               {mean_of("nota_avaliacao", 2)} AS nota_media,
               {mean_of("tempo_entrega_dias", 1)} AS tempo_entrega_medio_dias,
               {mean_of("atraso_dias", 1)} AS atraso_medio_dias
        FROM valido""",
    "cancellation_rate": cancellation("fato", "pedido_id"),
    "cancellation_rate_all_orders": cancellation("pedidos", "order_id"),
    "payment_mix_per_order": payments("pedido_id, metodo_pagamento_principal, valor_pago"),
    "payment_mix_per_item_value": payments(
        "pedido_id, receita, metodo_pagamento_principal, valor_pago"
    ),
    "top_categories": f"""SELECT * REPLACE ({money("receita")}) FROM m_categoria
        ORDER BY m_categoria.receita DESC, categoria_en LIMIT 10""",
    # stored tables and published names
    "bronze_contents": " UNION ALL ".join(contents_of(name) for name in RAW_ROWS),
    "bronze_contents_swapped": " UNION ALL ".join(
        contents_of(name, name not in ("order_payments", "orders", "customers")) for name in RAW_ROWS
    ),
    "arrival_log": " UNION ALL ".join(
        f"SELECT '{name}' AS tabela, '{name}.csv' AS arquivo, count(*) AS linhas, 2::BIGINT AS conferencias, "
        f"true AS bytes_batem FROM {source}"
        for name, source in RAW_ROWS.items()
    ),
    "quarantined_items": """
        SELECT cast(l_orderkey AS varchar) AS order_id, cast(l_linenumber AS varchar) AS order_item_id,
               'R$ ' || cast(cast(l_extendedprice AS decimal(18,2)) AS varchar) AS price,
               cast(cast(cast(l_extendedprice AS decimal(18,2)) * cast(l_tax AS decimal(4,2)) AS decimal(18,2)) AS varchar)
                   AS freight_value,
               (SELECT count(*) FROM lineitem WHERE l_orderkey % 13 <> 0) AS linhas_mantidas
        FROM lineitem WHERE l_orderkey % 13 = 0""",
    "monthly_sales_1995": f"""SELECT * REPLACE ({money("receita")}),
        {per_order("m_mensal.receita", "total_pedidos")} AS ticket_medio FROM m_mensal WHERE ano = 1995""",
    "distinct_persons_by_quarter": """
        SELECT cast(year(data_compra) AS int) AS ano, cast(quarter(data_compra) AS int) AS trimestre, d.uf,
               count(DISTINCT cliente_id) AS pessoas
        FROM valido JOIN dim_cliente d ON d.customer_unique_id = cliente_id GROUP BY 1, 2, 3
        UNION ALL SELECT NULL, NULL, NULL, count(DISTINCT cliente_id) FROM valido""",
    "distinct_orders_by_category": """
        SELECT cast(year(data_compra) AS int) AS ano, coalesce(d.categoria_en, 'sem_categoria') AS categoria_en,
               count(DISTINCT pedido_id) AS pedidos
        FROM valido LEFT JOIN produtos d ON d.product_id = produto_id GROUP BY 1, 2""",
    "published_comments": "SELECT * FROM (VALUES "
    + ", ".join(f"({', '.join(literal(v) for v in row)})" for row in described())
    + ") AS d(tabela, coluna, comentario)",
    **CHECKS,
    "check_item_orphans": none(
        "item_sem_pedido",
        "SELECT count(*) FROM itens_pedido WHERE order_id NOT IN (SELECT order_id FROM pedidos)",
    ),
    "quality_report": report_of(100_000, 120_000) + " ORDER BY teste",
    "quality_gate": f"""
        SELECT CASE WHEN bool_and(passou) THEN 'TODOS OS ' || count(*) || ' TESTES PASSARAM'
                    ELSE error('a test failed') END AS resultado_final
        FROM ({report_of(1, 10**15)})""",
    "constraint_violations": " UNION ALL ".join(
        f"SELECT '{name}' AS tabela, '{rule}' AS restricao, "
        f"(SELECT count(*) FROM {cte} WHERE NOT coalesce({condition}, false)) AS violacoes"
        for name, cte, rule, condition in CONSTRAINTS
    ),
    "enforce_by_dropping": """
        SELECT order_id, status FROM pedidos
        WHERE NOT (entregue AND data_entrega_cliente IS NULL)""",
    "unique_keys": " UNION ALL ".join(
        "("
        + none(
            f"chave_unica_{name}",
            f"SELECT count(*) - count(DISTINCT ({columns})) FROM {cte}",
        )
        + ")"
        for name, (cte, columns) in KEYS.items()
    ),
    "zip_digits_before_padding": """
        SELECT cast(length(regexp_replace(trim(zip), '[^0-9]', '', 'g')) AS int) AS digitos,
               count(*) AS linhas
        FROM r_geolocation GROUP BY 1""",
    "unreadable_numbers": """
        SELECT product_id, photos AS product_photos_qty FROM r_products
        WHERE photos IS NOT NULL AND try_cast(photos AS int) IS NULL""",
}



def also(sql: str, condition: str) -> str:
    """The rows, and once more those that meet the condition."""
    return f"SELECT * FROM ({sql}) UNION ALL SELECT * FROM ({sql}) WHERE {condition}"


# The same tables with one fault for every rule.
FAULTY_CTES = {
    **CTES,
    "r_customers": also(
        f"""SELECT * REPLACE (
              CASE WHEN cast(customer_unique_id AS bigint) % 17 = 0 THEN ' x ' ELSE state END AS state,
              CASE WHEN cast(customer_unique_id AS bigint) % 19 <> 0 THEN zip END AS zip)
            FROM ({CTES["r_customers"]})""",
        "cast(customer_id AS bigint) % 23 = 0",
    ),
    "r_orders": also(
        f"""SELECT * REPLACE (
              CASE WHEN cast(order_id AS bigint) % 29 = 0 THEN 'soon' ELSE purchase END AS purchase)
            FROM ({CTES["r_orders"]}) WHERE cast(order_id AS bigint) % 31 <> 0""",
        "cast(order_id AS bigint) % 41 = 0",
    ),
    "itens_pedido": f"""
        SELECT * EXCLUDE (signed)
               REPLACE (CASE WHEN cast(order_id AS bigint) % 43 <> 0 THEN item_id END AS item_id,
                        signed AS preco, cast(signed + frete AS decimal(19,2)) AS valor_item)
        FROM (SELECT *, CASE WHEN item_id = 3 AND cast(order_id AS bigint) % 5 = 0 THEN -preco
                             ELSE preco END AS signed FROM ({CTES["itens_pedido"]}))""",
    "avaliacoes": f"""
        SELECT * REPLACE (CASE WHEN cast(order_id AS bigint) % 37 = 0 THEN 7 ELSE nota END AS nota)
        FROM ({CTES["avaliacoes"]})""",
    "vendedores": also(
        f"""SELECT * REPLACE (
              CASE WHEN cast(seller_id AS bigint) % 10 <> 0 THEN cep_prefixo END AS cep_prefixo)
            FROM ({CTES["vendedores"]})""",
        "cast(seller_id AS bigint) % 3 = 0",
    ),
    "r_products": also(CTES["r_products"], "cast(product_id AS bigint) % 37 = 0"),
    "r_geolocation": f"""SELECT * REPLACE (CASE WHEN trim(zip) <> '7' THEN zip END AS zip)
        FROM ({CTES["r_geolocation"]})""",
    # faults behind the rules that would remove them
    "pedidos_restantes": "SELECT * FROM pedidos WHERE cast(order_id AS bigint) % 7 <> 0",
    "pessoas_conhecidas": "SELECT * FROM dim_cliente WHERE cast(customer_unique_id AS bigint) % 11 <> 0",
    "ceps_curtos": """SELECT * REPLACE (CASE WHEN cep_prefixo < '00100' THEN cep_prefixo[3:5]
                                        ELSE cep_prefixo END AS cep_prefixo) FROM geolocalizacao""",
    "meses_restantes": "SELECT * FROM m_mensal WHERE mes <> 5",
}

FAULTY_CHECKS = {
    name: sql
    for name, sql in {**CHECKS, "check_fact_volume": volume(1, 2)}.items()
}
for _name, _good, _bad in (
    ("check_order_orphans", "FROM pedidos", "FROM pedidos_restantes"),
    ("check_person_orphans", "FROM dim_cliente", "FROM pessoas_conhecidas"),
    ("check_purchase_date", "FROM pedidos", "FROM pedidos_restantes"),
    ("check_zip_format", "FROM geolocalizacao", "FROM ceps_curtos"),
    ("check_monthly_total", "FROM m_mensal", "FROM meses_restantes"),
):
    FAULTY_CHECKS[_name] = CHECKS[_name].replace(_good, _bad)


def repeats(source: str, columns: str) -> str:
    return f"SELECT coalesce(sum(n - 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM {source} GROUP BY {columns})"


_FAULTY_REPORT = " UNION ALL ".join(f"({sql})" for sql in FAULTY_CHECKS.values())
_THIRD = "(SELECT * FROM {0} UNION ALL SELECT * FROM {0} WHERE cast({1} AS bigint) % 3 = 0)"
FAULTY_KEYS = {
    **KEYS,
    "dim_cliente": (_THIRD.format("dim_cliente", "customer_unique_id"), "customer_unique_id"),
    "dim_geografia": (_THIRD.format("geolocalizacao", "cep_prefixo"), "cep_prefixo"),
}

FAULTY_STATEMENTS: dict[str, str] = {
    **{
        name: FAULTY_CHECKS[name]
        for name in ("check_order_orphans", "check_person_orphans", "check_review_score", "check_zip_format")
    },
    "check_purchase_date": CHECKS["check_purchase_date"],
    "check_item_orphans": STATEMENTS["check_item_orphans"],
    "quality_report": _FAULTY_REPORT + " ORDER BY teste",
    "quality_gate": f"""
        SELECT string_agg(teste, ', ' ORDER BY teste) FILTER (NOT passou) AS falhas,
               count(*) AS total
        FROM ({_FAULTY_REPORT})""",
    "constraint_violations": STATEMENTS["constraint_violations"],
    "unique_keys": " UNION ALL ".join(
        "(" + none(f"chave_unica_{name}", repeats(cte, columns)) + ")"
        for name, (cte, columns) in FAULTY_KEYS.items()
    ),
}

ORACLES = {name: oracle(sql) for name, sql in STATEMENTS.items()} | {
    f"{name}_faulty": oracle(sql, FAULTY_CTES) for name, sql in FAULTY_STATEMENTS.items()
}
ORACLES |= {name: ORACLES[of] for name, of in SAME.items()}
