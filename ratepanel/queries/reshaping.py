"""Long and wide forms, calendars and headers."""

from __future__ import annotations

import datetime as dt
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratepanel.functions.titles import compose_title, join_title
from ratepanel.operators import reshape as R
from ratepanel.operators.calendar import calendar, calendar_of, densify, grid, in_range
from ratepanel.queries.inputs import COINS, PANEL, QUOTES, TYPES, events_panel, money, quotes_panel, table
from ratepanel.queries.registry import query
from ratepanel.schemas import DATE, SML, TCE

# The asked range starts before and ends after the data.
START, END = dt.date(2023, 12, 28), dt.date(2024, 2, 2)
DAYS = f"SELECT CAST(d AS DATE) AS indice_tiempo FROM generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY) AS g(d)"


def _sum(condition: str, name: str, value: str = "value") -> str:
    total = f"sum({value}) FILTER (WHERE {condition})"
    return f"CAST(CASE WHEN {total} <> 0 THEN {total} END AS DECIMAL(18,2)) AS {name}"


def _monies(df: DataFrame) -> DataFrame:
    return df.select(DATE, *[money(c).alias(c) for c in R.columns_except(df)])


COIN_SUMS = ", ".join(_sum(f"coin = '{c}'", c) for c in COINS)


@query(f"""
    SELECT d.indice_tiempo, {COIN_SUMS} FROM ({DAYS}) d LEFT JOIN ({PANEL}) p USING (indice_tiempo) GROUP BY 1
""")
def panel_to_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums per coin on a dense calendar."""
    wide = R.pivot_sum(events_panel(spark, sf_dir), F.col("coin"), {c: c for c in COINS}, "value")
    return densify(wide, calendar(spark, START, END))


@query(f"SELECT indice_tiempo, {', '.join(_sum(f'''coin = '{c}' ''', c) for c in COINS)} FROM ({PANEL}) WHERE type = 't1' GROUP BY 1")
def panel_to_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One measure, one column per coin."""
    return R.panel_to_fx(events_panel(spark, sf_dir), "t1", COINS)


@query(f"SELECT indice_tiempo, {', '.join(_sum(f'''type = '{t}' ''', t) for t in TYPES)} FROM ({PANEL}) WHERE coin = 'view' GROUP BY 1")
def panel_to_sml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One coin, one column per measure."""
    return R.panel_to_sml(events_panel(spark, sf_dir), "view", TYPES)


@query(f"""
    SELECT indice_tiempo, {', '.join(_sum(f"type = '{t}'", f"libor_{t}_dias") for t in TYPES)} FROM ({PANEL}) GROUP BY 1
""")
def panel_to_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.panel_to_rates(events_panel(spark, sf_dir), {t: f"libor_{t}_dias" for t in TYPES})


@query(f"""
    SELECT indice_tiempo, {', '.join(_sum(f"coin = '{c}' AND type = '{t}'", f"{c}_{t}") for c in COINS for t in TYPES)}
    FROM ({PANEL}) GROUP BY 1
""")
def panel_to_series_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns are the full product of the coins and measures that occur."""
    panel = events_panel(spark, sf_dir)
    coins, types = R.observed_levels(panel, ["coin", "type"])
    titles = [f"{c}_{t}" for c in coins for t in types]
    return R.pivot_sum(panel, join_title(["coin", "type"]), {t: t for t in titles}, "value")


# Entities, channels, flows and hours, as a configuration would list them.
QUOTE_LEVELS = (
    ("b0", "b1", "b2", "b3", "b4"),
    ("electronico", "mostrador"),
    ("compra", "venta"),
    ("11hs", "13hs", "15hs"),
)
QUOTE_COLUMNS = list(product(*QUOTE_LEVELS))


def _quote_sum(coin: str, combo: tuple[str, str, str, str]) -> str:
    b, c, f, h = combo
    condition = f"moneda = '{coin}' AND entidad_bancaria = '{b}' AND canal = '{c}' AND flujo = '{f}' AND hora = '{h}'"
    return _sum(condition, "_".join(("tc_ars", coin, *combo)), "valor")


@query(f"""
    SELECT indice_tiempo, {', '.join(_quote_sum('view', q) for q in QUOTE_COLUMNS)}
    FROM ({QUOTES}) WHERE moneda = 'view' GROUP BY 1
""")
def panel_to_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One coin's 60 quote columns, the product of the configured levels."""
    return R.panel_to_quotes(quotes_panel(spark, sf_dir), "view", QUOTE_LEVELS)


def _mean(coin: str, kind: str) -> str:
    # Half-up at six decimals in whole numbers: DuckDB's own avg is a double.
    where = f"FILTER (WHERE coin = '{coin}' AND type = '{kind}')"
    cents = f"CAST(sum(value) {where} * 100 AS HUGEINT)"
    n = f"count(*) {where}"
    micros = f"(2 * {cents} * 10000 + {n}) // (2 * {n})"
    return f"CAST(CASE WHEN {n} > 0 THEN CAST({micros} AS DECIMAL(24,0)) * 0.000001 END AS DECIMAL(22,6)) AS {coin}_{kind}"


@query(f"""
    SELECT indice_tiempo, {', '.join(_mean(c, t) for c in COINS for t in TYPES)} FROM ({PANEL}) GROUP BY 1
""")
def panel_to_series_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.panel_to_series_mean(events_panel(spark, sf_dir), join_title(["coin", "type"]), "value")


@query(f"""
    WITH s AS (SELECT indice_tiempo, type, sum(value) AS value FROM ({PANEL}) GROUP BY 1, 2),
    d AS (SELECT DISTINCT indice_tiempo FROM s), k AS (SELECT unnest(['t0', 't1', 't2', 't3']) AS type)
    SELECT d.indice_tiempo, k.type, CAST(nullif(s.value, 0) AS DECIMAL(18,2)) AS value
    FROM d CROSS JOIN k LEFT JOIN s USING (indice_tiempo, type)
""")
def series_to_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide term rates back to (date, term, value)."""
    wide = R.panel_to_rates(events_panel(spark, sf_dir), {t: f"libor_{t}_dias" for t in TYPES})
    return R.rates_to_panel(wide).withColumn("value", money("value"))


@query(f"""
    WITH d AS (SELECT DISTINCT indice_tiempo, type FROM ({PANEL}) WHERE type IN ('t0', 't1')),
    c AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS coin)
    SELECT d.indice_tiempo, c.coin, CASE d.type WHEN 't0' THEN 'tc_local' ELSE 'tp_usd' END AS type,
           CAST((SELECT nullif(sum(value), 0) FROM ({PANEL}) p
                 WHERE p.indice_tiempo = d.indice_tiempo AND p.coin = c.coin AND p.type = d.type) AS DECIMAL(18,2)) AS value
    FROM d CROSS JOIN c
""")
def fx_to_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two wide measures to one panel."""
    panel = events_panel(spark, sf_dir)
    long = R.fx_to_panel(R.panel_to_fx(panel, "t0", COINS), R.panel_to_fx(panel, "t1", COINS))
    return long.withColumn("value", money("value"))


@query(f"SELECT indice_tiempo, coin, type, value FROM ({PANEL}) WHERE FALSE")
def fx_to_panel_one_sided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the second measure there is no panel."""
    panel = events_panel(spark, sf_dir)
    return R.fx_to_panel(R.panel_to_fx(panel, "t0", COINS), R.panel_to_fx(panel, "none", COINS))


@query(f"""
    WITH d AS (SELECT DISTINCT indice_tiempo, coin FROM ({PANEL})),
    k AS (SELECT unnest(['t0', 't1', 't2', 't3']) AS type)
    SELECT d.indice_tiempo, d.coin, k.type,
           CAST((SELECT nullif(sum(value), 0) FROM ({PANEL}) p
                 WHERE p.indice_tiempo = d.indice_tiempo AND p.coin = d.coin AND p.type = k.type) AS DECIMAL(18,2)) AS value
    FROM d CROSS JOIN k
""")
def sml_to_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All coins' wide tables to one panel."""
    panel = events_panel(spark, sf_dir)
    types = {c: TYPES for c in COINS}
    long = R.all_to_panel(R.panel_to_all(panel, SML, types), SML, types)
    return long.withColumn("value", money("value"))


@query(f"""
    WITH d AS (SELECT DISTINCT indice_tiempo, coin FROM ({PANEL}) WHERE coin IN ('click', 'view')),
    k AS (SELECT * FROM (VALUES ('click', 't0'), ('view', 't1'), ('view', 't3')) AS v(coin, type))
    SELECT d.indice_tiempo, d.coin, k.type,
           CAST((SELECT nullif(sum(value), 0) FROM ({PANEL}) p
                 WHERE p.indice_tiempo = d.indice_tiempo AND p.coin = d.coin AND p.type = k.type) AS DECIMAL(18,2)) AS value
    FROM d JOIN k ON k.coin = d.coin
""")
def sml_to_panel_own_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coins with different columns in one table; each gets back its own only."""
    types = {"click": ["t0"], "view": ["t1", "t3"]}
    long = R.all_to_panel(R.panel_to_all(events_panel(spark, sf_dir), SML, types), SML, types)
    return long.withColumn("value", money("value"))


@query(f"""
    WITH s AS (SELECT indice_tiempo, moneda, entidad_bancaria, canal, flujo, hora, sum(valor) AS valor
               FROM ({QUOTES}) GROUP BY ALL),
    d AS (SELECT DISTINCT indice_tiempo, moneda FROM s),
    q AS (SELECT * FROM (SELECT unnest({list(QUOTE_LEVELS[0])}) AS entidad_bancaria) CROSS JOIN (SELECT unnest({list(QUOTE_LEVELS[1])}) AS canal)
          CROSS JOIN (SELECT unnest({list(QUOTE_LEVELS[2])}) AS flujo) CROSS JOIN (SELECT unnest({list(QUOTE_LEVELS[3])}) AS hora))
    SELECT d.indice_tiempo, d.moneda, q.entidad_bancaria, q.canal, q.flujo, q.hora, CAST(nullif(s.valor, 0) AS DECIMAL(18,2)) AS valor
    FROM d CROSS JOIN q
    LEFT JOIN s ON s.indice_tiempo = d.indice_tiempo AND s.moneda = d.moneda AND s.entidad_bancaria = q.entidad_bancaria
      AND s.canal = q.canal AND s.flujo = q.flujo AND s.hora = q.hora
""")
def quotes_to_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every coin's 60 quote columns to the panel, dimensions from the titles."""
    panel = quotes_panel(spark, sf_dir)
    columns = {coin: ["_".join(q) for q in QUOTE_COLUMNS] for coin in COINS}
    long = R.all_to_panel(R.panel_to_all(panel, TCE, columns), TCE, columns)
    return long.withColumn("valor", money("valor"))


@query(f"""
    SELECT indice_tiempo, moneda, entidad_bancaria, canal, flujo, hora, CAST(sum(valor) AS DECIMAL(18,2)) AS valor
    FROM ({QUOTES}) GROUP BY ALL HAVING sum(valor) > 0
""")
def round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long to wide and back gives the same cells."""
    panel = quotes_panel(spark, sf_dir)
    columns = {coin: ["_".join(q) for q in QUOTE_COLUMNS] for coin in COINS}
    back = R.all_to_panel(R.panel_to_all(panel, TCE, columns), TCE, columns)
    return back.where("valor is not null").withColumn("valor", money("valor"))


@query(f"""
    SELECT d.indice_tiempo, c.coin, CAST(sum(p.value) AS DECIMAL(18,2)) AS value
    FROM ({DAYS}) d CROSS JOIN (SELECT DISTINCT coin FROM ({PANEL})) c
    LEFT JOIN ({PANEL}) p ON p.indice_tiempo = d.indice_tiempo AND p.coin = c.coin GROUP BY 1, 2
""")
def dense_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every coin on every day."""
    summed = events_panel(spark, sf_dir).groupBy(DATE, "coin").agg(money(F.sum("value")).alias("value"))
    coins = summed.select("coin").distinct()
    return densify(summed, grid(coins, START, END).select(DATE, "coin"))


@query("""
    WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS z FROM orders),
    d AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS indice_tiempo FROM b)
    SELECT d.indice_tiempo, count(o_orderkey) AS n FROM d
    LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d.indice_tiempo GROUP BY 1
""")
def dense_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days between the first and last order, those without orders included."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias(DATE))
    counted = days.groupBy(DATE).agg(F.count("*").alias("n"))
    return densify(counted, calendar_of(days)).fillna(0, ["n"])


@query(f"""
    SELECT indice_tiempo, moneda, entidad_bancaria, canal, flujo, hora, CAST(sum(valor) AS DECIMAL(18,2)) AS valor
    FROM ({QUOTES}) WHERE indice_tiempo BETWEEN DATE '2024-01-06' AND DATE '2024-01-19' GROUP BY ALL
""")
def rename_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English names to published ones, cut to a date range."""
    english = quotes_panel(spark, sf_dir).withColumnsRenamed({v: k for k, v in R.QUOTE_NAMES.items()})
    renamed = in_range(R.rename_panel(english, R.QUOTE_NAMES, TCE), dt.date(2024, 1, 6), dt.date(2024, 1, 19))
    return renamed.groupBy(DATE, *TCE.dims).agg(money(F.sum("valor")).alias("valor"))


@query(f"SELECT indice_tiempo, {_sum('''coin = 'view' ''', 'view')}, {_sum('''coin = 'click' ''', 'click')} FROM ({PANEL}) GROUP BY 1")
def keep_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series outside the header are dropped, dates are not."""
    wide = R.pivot_sum(events_panel(spark, sf_dir), F.col("coin"), {c: c for c in COINS}, "value")
    return _monies(R.keep_columns(wide, [DATE, "view", "click", "absent"]))


@query(f"""
    SELECT indice_tiempo, {', '.join(_quote_sum(coin, q) for coin in COINS for q in QUOTE_COLUMNS if q[1] == 'mostrador')}
    FROM ({QUOTES}) GROUP BY 1
""")
def active_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the switched-on channel of each coin becomes columns."""
    titles = ["_".join(("tc_ars", coin, *q)) for coin in COINS for q in QUOTE_COLUMNS if q[1] == "mostrador"]
    panel = quotes_panel(spark, sf_dir)
    return _monies(R.pivot_sum(panel, compose_title(TCE), {t: t for t in titles}, "valor"))
