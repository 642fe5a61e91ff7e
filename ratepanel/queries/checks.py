"""Coverage checks, configuration headers and rules on requested ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratepanel.functions.titles import compose_title, join_title
from ratepanel.operators import quality as Q
from ratepanel.operators import reshape as R
from ratepanel.operators.calendar import range_violations as violations_of_range
from ratepanel.operators.calendar import refetch_violations as violations_of_refetch
from ratepanel.operators.calendar import snap_start as snap
from ratepanel.plans.series import daily_series
from ratepanel.queries.inputs import PANEL, QUOTES, TYPES, events_panel, money, quotes_panel, table
from ratepanel.queries.registry import query
from ratepanel.schemas import DATE, TCE
from ratepanel.sources import config as C

# A measure without values, and one coin that lost another measure.
HOLED = f"""
    SELECT indice_tiempo, coin, type,
           CASE WHEN type = 't3' OR (coin = 'view' AND type = 't1') THEN NULL ELSE value END AS value
    FROM ({PANEL})
"""


def _holed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = (F.col("type") == "t3") | ((F.col("coin") == "view") & (F.col("type") == "t1"))
    return events_panel(spark, sf_dir).withColumn("value", F.when(~lost, F.col("value")))


@query(f"SELECT coin || '_' || type AS series FROM ({HOLED}) GROUP BY 1 HAVING count(value) = 0")
def null_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.null_series(_holed(spark, sf_dir), join_title(["coin", "type"]), "value")


@query(f"SELECT 'libor_' || type || '_dias' AS series FROM ({HOLED}) GROUP BY 1 HAVING count(value) = 0")
def null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = R.panel_to_rates(_holed(spark, sf_dir), {t: f"libor_{t}_dias" for t in TYPES})
    return Q.null_columns(wide)


@query(f"""
    SELECT entidad_bancaria, moneda, hora, canal, count(*) AS n_rows,
           count(CASE WHEN canal = 'electronico' AND hora = '13hs' THEN NULL ELSE valor END) AS n_values
    FROM ({QUOTES}) WHERE entidad_bancaria = 'b1' GROUP BY 1, 2, 3, 4
""")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values per coin, hour and channel of one entity, most dates first."""
    lost = (F.col("canal") == "electronico") & (F.col("hora") == "13hs")
    panel = quotes_panel(spark, sf_dir).withColumn("valor", F.when(~lost, F.col("valor")))
    one = R.by_member(panel, "entidad_bancaria", "b1")
    return Q.coverage(one, ["entidad_bancaria", "moneda", "hora", "canal"], "valor")


@query(f"""
    SELECT count(DISTINCT indice_tiempo) AS n_rows, CAST(4 AS BIGINT) AS n_columns,
           count(DISTINCT indice_tiempo) * 4 AS n_cells FROM ({PANEL})
""")
def cell_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = R.panel_to_rates(events_panel(spark, sf_dir), {t: f"libor_{t}_dias" for t in TYPES})
    return Q.cell_count(wide)


def _config_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configuration whose dimensions are those of the events; dear quotes are switched on."""
    flags = quotes_panel(spark, sf_dir).groupBy("entidad_bancaria", "moneda", "hora", "canal").agg(
        (F.max("valor") > 150).alias("active")
    )

    def level(df: DataFrame, keys: list[str], key: str, value: str, name: str) -> DataFrame:
        by_key = lambda a, b: F.when(a[key] < b[key], -1).otherwise(1)
        entries = F.array_sort(F.collect_list(F.struct(key, value)), by_key)
        return df.groupBy(*keys).agg(F.map_from_entries(entries).alias(name))

    hour = F.substring("hora", 1, 2).alias("hora")
    flags = flags.select("entidad_bancaria", "moneda", hour, "canal", "active")
    channels = level(flags, ["entidad_bancaria", "moneda", "hora"], "canal", "active", "channels")
    channels = channels.withColumn("h", F.struct("channels"))
    hours = level(channels, ["entidad_bancaria", "moneda"], "hora", "h", "hours")
    coins = level(hours, ["entidad_bancaria"], "moneda", "hours", "coins")
    named = coins.withColumn(
        "e",
        F.struct(
            F.upper("entidad_bancaria").alias("name"), F.upper("entidad_bancaria").alias("title"), "coins"
        ),
    )
    entities = level(named, [], "entidad_bancaria", "e", "entities")
    return entities.select(F.to_json(F.struct(F.struct("entities").alias("tce"))).alias("json"))


@query(f"""
    WITH f AS (SELECT entidad_bancaria AS e, moneda AS m, hora AS h, canal AS c, max(valor) > 150 AS active
               FROM ({QUOTES}) GROUP BY 1, 2, 3, 4),
    o AS (SELECT *, CAST(dense_rank() OVER (ORDER BY e) - 1 AS INTEGER) AS i,
                 CAST(dense_rank() OVER (PARTITION BY e, m ORDER BY h) - 1 AS INTEGER) AS j,
                 CAST(dense_rank() OVER (PARTITION BY e, m, h ORDER BY c) - 1 AS INTEGER) AS k FROM f),
    w AS (SELECT unnest(['compra', 'venta']) AS flow, unnest([0, 1]) AS l)
    SELECT m AS coin, 'tc_ars_' || m || '_' || e || '_' || c || '_' || flow || '_' || h AS title, i, j, k,
           CAST(l AS INTEGER) AS l
    FROM o CROSS JOIN w WHERE active
""")
def active_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of switched-on quotes with their place in the configuration."""
    config = C.parse_config(_config_json(spark, sf_dir), "tce")
    titles = C.active_columns(C.dim_quote(config))
    return titles.select("coin", "title", *[F.col(f"ord._{n}").alias(n) for n in "ijkl"])


@query(f"""
    WITH f AS (SELECT entidad_bancaria AS e, moneda AS m, hora AS h, canal AS c, max(valor) > 150 AS active
               FROM ({QUOTES}) GROUP BY 1, 2, 3, 4)
    SELECT DISTINCT indice_tiempo, moneda, count(*) AS n, CAST(sum(valor) AS DECIMAL(18,2)) AS total
    FROM ({QUOTES}) JOIN f ON e = entidad_bancaria AND m = moneda AND h = hora AND c = canal
    WHERE active GROUP BY 1, 2
""")
def active_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel rows of switched-on series only."""
    config = C.parse_config(_config_json(spark, sf_dir), "tce")
    titles = C.active_columns(C.dim_quote(config)).select("title")
    kept = quotes_panel(spark, sf_dir).withColumn("title", compose_title(TCE)).join(titles, "title", "left_semi")
    return kept.groupBy(DATE, "moneda").agg(
        F.count("*").alias("n"), F.sum("valor").cast("decimal(18,2)").alias("total")
    )


@query(f"""
    SELECT CAST(d AS DATE) AS indice_tiempo,
           {', '.join(f"(SELECT CAST(nullif(sum(value), 0) AS DECIMAL(18,2)) FROM ({PANEL}) WHERE indice_tiempo = CAST(d AS DATE) AND type = '{t}') AS libor_{t}_dias" for t in TYPES)}
    FROM generate_series(DATE '2024-01-03', DATE '2024-01-11', INTERVAL 1 DAY) AS g(d)
""")
def rate_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily series under the rate header: the date, then the configured columns in file order."""
    panel = events_panel(spark, sf_dir)
    terms = panel.select("type").distinct().groupBy().agg(F.sort_array(F.collect_set("type"), asc=False).alias("terms"))
    rates = F.map_from_entries(F.transform("terms", lambda t: F.struct(t, F.concat(F.lit("libor_"), t, F.lit("_dias")))))
    config = terms.select(F.to_json(F.struct(F.struct(rates.alias("rates")).alias("libor"))).alias("json"))
    dims = C.dims_of(config, "libor")
    start, end = dt.date(2024, 1, 3), dt.date(2024, 1, 11)
    wide = daily_series(panel, dims, start, end)
    return wide.select(DATE, *[money(c).alias(c) for c in dims.header()[1:]])


TODAY = dt.date(2000, 6, 30)
REQUESTS = """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start_date,
           CAST(CAST(o_orderdate AS DATE) + CAST(o_custkey % 11 - 2 AS INTEGER) AS DATE) AS end_date,
           CASE WHEN o_orderpriority LIKE '5%' THEN NULL
                ELSE CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 - 1 AS INTEGER) AS DATE) END AS refetch_start_date,
           CASE WHEN o_orderstatus = 'P' THEN NULL
                ELSE CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 7 AS INTEGER) AS DATE) END AS refetch_end_date
    FROM orders
"""


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    later = lambda days: F.date_add(day, days.cast("int"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        day.alias("start_date"),
        later(F.col("o_custkey") % 11 - 2).alias("end_date"),
        F.when(~F.col("o_orderpriority").startswith("5"), later(F.col("o_orderkey") % 5 - 1)).alias("refetch_start_date"),
        F.when(F.col("o_orderstatus") != "P", later(F.col("o_orderkey") % 7)).alias("refetch_end_date"),
    )


@query(f"""
    SELECT * FROM (SELECT *, CASE WHEN start_date > end_date THEN 'start_after_end'
                                  WHEN end_date > DATE '{TODAY}' THEN 'end_after_today' END AS error
                   FROM ({REQUESTS})) WHERE error IS NOT NULL
""")
def range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violations_of_range(_requests(spark, sf_dir), TODAY)


@query(f"""
    SELECT * FROM (
        SELECT *, CASE WHEN refetch_start_date IS NULL OR refetch_end_date IS NULL THEN NULL
                       WHEN refetch_start_date < start_date THEN 'refetch_before_start'
                       WHEN refetch_end_date > end_date THEN 'refetch_after_end' END AS error
        FROM ({REQUESTS})) WHERE error IS NOT NULL
""")
def refetch_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violations_of_refetch(_requests(spark, sf_dir))


@query(f"""
    WITH offered AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus = 'P')
    SELECT r.*, CASE WHEN o.d IS NOT NULL THEN r.start_date
                     WHEN r.start_date < r.end_date THEN CAST(r.start_date + 1 AS DATE) END AS snapped_start,
           CASE WHEN o.d IS NULL AND r.start_date >= r.end_date THEN 'start_not_before_end' END AS error
    FROM ({REQUESTS}) r LEFT JOIN offered o ON o.d = r.start_date
""")
def snap_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    offered = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    return snap(_requests(spark, sf_dir), offered.select(F.to_date("o_orderdate").alias(DATE)))
