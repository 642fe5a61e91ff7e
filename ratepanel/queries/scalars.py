"""Number, date and title functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratepanel.functions import normalize as N
from ratepanel.functions.titles import compose_title, split_title
from ratepanel.plans import metadata
from ratepanel.queries.inputs import QUOTES, comma_text, grouped_text, money, quotes_panel, table
from ratepanel.queries.registry import query
from ratepanel.schemas import TCE

QUOTE_KEYS = ["moneda", "entidad_bancaria", "canal", "flujo", "hora"]


@query("""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
           CAST(CAST(o_orderdate AS DATE) - CASE isodow(o_orderdate) WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END AS DATE) AS previous
    FROM orders
""")
def prev_business_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", day.alias("day"), N.previous_business_day(day).alias("previous")
    )


@query("""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS slashed, CAST(o_orderdate AS DATE) AS iso,
           CAST(NULL AS DATE) AS other, strftime(o_orderdate, '%d/%m/%Y') AS text
    FROM orders
""")
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    text = N.format_date(day)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        N.parse_date_any(text).alias("slashed"),
        N.parse_date_any(day.cast("string")).alias("iso"),
        N.parse_date_any(F.concat(F.lit("al "), text)).alias("other"),
        text.alias("text"),
    )


@query("""
    SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS comma, CAST(o_totalprice AS DECIMAL(18,2)) AS dot,
           CAST(o_totalprice AS DECIMAL(18,2)) AS mixed, CAST(NULL AS DECIMAL(18,2)) AS empty
    FROM orders
""")
def parse_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = money("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        money(N.parse_decimal_comma(comma_text(price))).alias("comma"),
        money(N.parse_decimal_comma(price.cast("string"))).alias("dot"),
        money(N.parse_decimal_mixed(grouped_text(price))).alias("mixed"),
        money(N.parse_decimal_comma(N.empty_to_null(F.repeat("o_orderstatus", F.lit(0))))).alias("empty"),
    )


@query("SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders")
def parse_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = grouped_text(money("o_totalprice"), 7)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", money(N.parse_decimal_grouped(text)).alias("price")
    )


@query("""
    SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '%LOW%' OR o_orderstatus = 'F' THEN NULL
                            ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS price
    FROM orders
""")
def dash_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dashes for low priorities, negative numbers for finished orders."""
    price = money("o_totalprice")
    text = (
        F.when(F.col("o_orderpriority").contains("LOW"), "--------")
        .when(F.col("o_orderstatus") == "F", grouped_text(-price))
        .otherwise(grouped_text(price))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", money(N.parse_decimal_grouped(N.dash_to_null(text))).alias("price")
    )


@query("""
    SELECT l_orderkey, l_linenumber, CAST(CAST(l_discount AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,4)) AS ratio,
           CASE WHEN CAST(l_tax AS DECIMAL(18,2)) = 0 THEN NULL ELSE CAST(l_tax AS DECIMAL(18,2)) END AS tax,
           CASE WHEN CAST(l_tax - 0.03 AS DECIMAL(18,2)) > 0 THEN CAST(l_tax - 0.03 AS DECIMAL(18,2)) END AS over
    FROM lineitem
""")
def percent_to_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discount text as a rate in percent; zero and non-positive taxes hold no data."""
    rate = N.parse_decimal_comma(comma_text(money("l_discount")))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        N.percent_to_ratio(rate).cast("decimal(18,4)").alias("ratio"),
        N.zero_to_null(money("l_tax")).alias("tax"),
        N.nonpositive_to_null(money(F.col("l_tax") - 0.03)).alias("over"),
    )


@query(f"""
    SELECT 'tc_ars_' || moneda || '_' || entidad_bancaria || '_' || canal || '_' || flujo || '_' || hora AS title,
           count(*) AS n, CAST(sum(valor) AS DECIMAL(18,2)) AS total
    FROM ({QUOTES}) GROUP BY 1
""")
def compose_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = quotes_panel(spark, sf_dir).groupBy(*QUOTE_KEYS).agg(
        F.count("*").alias("n"), F.sum("valor").alias("total")
    )
    return counted.select(compose_title(TCE).alias("title"), "n", money("total").alias("total"))


@query(f"SELECT moneda, entidad_bancaria, canal, flujo, hora, count(*) AS n FROM ({QUOTES}) GROUP BY ALL")
def split_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    titled = quotes_panel(spark, sf_dir).groupBy(compose_title(TCE).alias("title")).agg(F.count("*").alias("n"))
    parts = titled.select(split_title("title", 7).alias("p"), "n")
    return parts.select(*[F.col("p")[i + 2].alias(k) for i, k in enumerate(QUOTE_KEYS)], "n")


@query(f"""
    WITH t AS (SELECT DISTINCT moneda, entidad_bancaria, canal, flujo, hora FROM ({QUOTES})),
    c AS (SELECT *, CASE moneda WHEN 'click' THEN 'usd' WHEN 'view' THEN 'eur' WHEN 'error' THEN 'brl'
                    WHEN 'signup' THEN 'uyu' WHEN 'purchase' THEN 'clp' END AS iso FROM t)
    SELECT 'tc_ars_' || moneda || '_' || entidad_bancaria || '_' || canal || '_' || flujo || '_' || hora AS field_title,
           'Tipo de cambio ARS/' || upper(iso) || '. ' || 'Banco ' || upper(entidad_bancaria) || '. '
             || upper(canal[1]) || canal[2:] || '. ' || upper(flujo[1]) || flujo[2:] || '. ' || hora || '.' AS field_description,
           'tc_' || iso || '_' || entidad_bancaria || '_' || canal[1] || flujo[1] || hora[1:2] AS field_id
    FROM c
    UNION ALL SELECT 'indice_tiempo', 'Indice de tiempo.', ''
""")
def series_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = quotes_panel(spark, sf_dir)
    titles = panel.groupBy(compose_title(TCE).alias("title")).agg(F.count("*").alias("n")).select("title")
    entities = panel.select(F.col("entidad_bancaria").alias("key")).distinct()
    entities = entities.select("key", F.concat(F.lit("Banco "), F.upper("key")).alias("title"))
    codes = {"click": "usd", "view": "eur", "error": "brl", "signup": "uyu", "purchase": "clp"}
    return metadata.series_metadata(titles, entities, codes)
