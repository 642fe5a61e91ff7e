"""The panel as a store: hits, misses, trimming, merging and whole runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratepanel.operators import merge as M
from ratepanel.operators.reshape import columns_except
from ratepanel.plans import incremental
from ratepanel.plans.series import daily_series
from ratepanel.queries.inputs import COINS, PANEL, events_panel, fx_html, grouped_text, money
from ratepanel.queries.registry import query
from ratepanel.schemas import DATE, FX, VALUE
from ratepanel.sources.config import Dims

START, END = dt.date(2023, 12, 25), dt.date(2024, 2, 5)
DAYS = f"SELECT CAST(d AS DATE) AS indice_tiempo FROM generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY) AS g(d)"

# Days with a dear click are "stored", days with a dear error "loaded before".
STORED = f"SELECT DISTINCT indice_tiempo FROM ({PANEL}) WHERE coin = 'click' AND value > 120"
LOADED = f"SELECT DISTINCT indice_tiempo FROM ({PANEL}) WHERE coin = 'error' AND value > 150"


def _stored(panel: DataFrame) -> DataFrame:
    return panel.where((F.col("coin") == "click") & (F.col("value") > 120))


def _loaded(panel: DataFrame) -> DataFrame:
    return panel.where((F.col("coin") == "error") & (F.col("value") > 150))


@query(f"SELECT indice_tiempo FROM ({DAYS}) WHERE indice_tiempo IN ({STORED})")
def panel_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.panel_hits(_stored(events_panel(spark, sf_dir)), START, END)


@query(f"""
    SELECT indice_tiempo FROM ({DAYS}) WHERE indice_tiempo NOT IN ({STORED}) AND indice_tiempo NOT IN ({LOADED})
""")
def dates_to_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = events_panel(spark, sf_dir)
    return M.dates_to_load(_stored(panel), START, END, _loaded(panel))


@query(f"""
    SELECT DISTINCT indice_tiempo FROM ({PANEL}) WHERE coin = 'view' AND value > 60
    AND indice_tiempo NOT IN ({LOADED})
""")
def not_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of one coin that an earlier pass did not load for any coin."""
    panel = events_panel(spark, sf_dir)
    days = panel.where((F.col("coin") == "view") & (F.col("value") > 60)).select(DATE).distinct()
    return M.not_loaded(days, _loaded(panel), START, END)


# Stored without values: weekends, and everything after the 24th.
EMPTY_AFTER = dt.date(2024, 1, 24)
GAPPED = f"""
    SELECT indice_tiempo, coin, type,
           CASE WHEN indice_tiempo > DATE '{EMPTY_AFTER}' OR isodow(indice_tiempo) >= 6 THEN NULL
                WHEN coin = 'view' THEN 0 ELSE value END AS value
    FROM ({PANEL})
"""


def _gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = (F.col(DATE) > F.lit(EMPTY_AFTER)) | (F.weekday(DATE) >= 5)
    zero = F.when(F.col("coin") == "view", F.lit(0).cast("decimal(18,2)")).otherwise(F.col("value"))
    return events_panel(spark, sf_dir).withColumn("value", F.when(~empty, zero))


@query(f"SELECT indice_tiempo, bool_or(coalesce(value <> 0, FALSE)) AS has_data FROM ({GAPPED}) GROUP BY 1")
def date_has_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.date_has_data(_gapped(spark, sf_dir), "value")


TRIM = (dt.date(2024, 1, 5), dt.date(2024, 1, 28))
LAST = f"(SELECT max(indice_tiempo) FROM ({GAPPED}) WHERE indice_tiempo BETWEEN DATE '{TRIM[0]}' AND DATE '{TRIM[1]}' AND value <> 0)"


@query(f"SELECT {LAST} AS last_date")
def last_date_with_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.last_date_with_data(_gapped(spark, sf_dir), *TRIM, "value")


@query(f"""
    SELECT indice_tiempo, coin, count(*) AS n, count(value) AS n_values, CAST(sum(value) AS DECIMAL(18,2)) AS total
    FROM ({GAPPED}) WHERE NOT (indice_tiempo BETWEEN DATE '{TRIM[0]}' AND DATE '{TRIM[1]}' AND indice_tiempo > {LAST})
    GROUP BY 1, 2
""")
def trim_trailing_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = M.trim_trailing_empty(_gapped(spark, sf_dir), *TRIM, "value")
    return kept.groupBy(DATE, "coin").agg(
        F.count("*").alias("n"), F.count("value").alias("n_values"), money(F.sum("value")).alias("total")
    )


@query(f"""
    SELECT max(CAST(d AS DATE)) AS refetch_end
    FROM generate_series(DATE '{TRIM[0]}' - 1, DATE '2024-01-27', INTERVAL 1 DAY) AS g(d)
    WHERE CAST(d AS DATE) NOT IN (SELECT indice_tiempo FROM ({GAPPED})
        WHERE indice_tiempo BETWEEN DATE '{TRIM[0]}' AND DATE '{TRIM[1]}' AND indice_tiempo > {LAST})
""")
def refetch_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    trailing = M.trailing_dates(_gapped(spark, sf_dir), *TRIM, "value")
    return M.shrink_refetch_end(trailing, TRIM[0], dt.date(2024, 1, 27))


# The base ends on the 24th, the new dates start on the 20th; one coin sends nothing new.
BASE = f"SELECT * FROM ({PANEL}) WHERE indice_tiempo <= DATE '2024-01-24'"
NEW = f"SELECT indice_tiempo, coin, type, value * 2 AS value FROM ({PANEL}) WHERE indice_tiempo >= DATE '2024-01-20' AND coin <> 'error'"


def _base_and_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    panel = events_panel(spark, sf_dir)
    base = panel.where(F.col(DATE) <= dt.date(2024, 1, 24))
    new = panel.where((F.col(DATE) >= dt.date(2024, 1, 20)) & (F.col("coin") != "error"))
    return base, new.withColumn("value", (F.col("value") * 2).cast("decimal(18,2)"))


def _totals(panel: DataFrame) -> DataFrame:
    return panel.groupBy(DATE, "coin", "type").agg(F.count("*").alias("n"), money(F.sum("value")).alias("total"))


TOTALS = "indice_tiempo, coin, type, count(*) AS n, CAST(sum(value) AS DECIMAL(18,2)) AS total"


@query(f"""
    SELECT {TOTALS} FROM (
        SELECT * FROM ({BASE}) b WHERE NOT EXISTS (
            SELECT 1 FROM ({NEW}) n WHERE n.indice_tiempo = b.indice_tiempo AND n.coin = b.coin)
        UNION ALL SELECT * FROM ({NEW}))
    GROUP BY 1, 2, 3
""")
def upsert_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _totals(M.upsert_by_date(*_base_and_new(spark, sf_dir), [DATE, "coin"]))


@query(f"SELECT {TOTALS} FROM (SELECT * FROM ({BASE}) UNION ALL SELECT * FROM ({NEW})) GROUP BY 1, 2, 3")
def append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _totals(M.append_new(*_base_and_new(spark, sf_dir)))


@query(f"""
    SELECT indice_tiempo, coin, type, max(value) AS value FROM ({PANEL}) p
    WHERE value = (SELECT max(value) FROM ({PANEL}) q
                   WHERE q.indice_tiempo = p.indice_tiempo AND q.coin = p.coin AND q.type = p.type)
    GROUP BY 1, 2, 3
""")
def latest_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the copies of a cell the one that is last in order (here, the dearest)."""
    panel = events_panel(spark, sf_dir).withColumn("order", F.col("value"))
    return M.latest_cells(panel, [DATE, "coin", "type"], ["order"], "value")


# A whole run. Pages: one per coin and day, made from the day's sums. One coin
# has no page on the 25th and an empty one on the 26th. Stored: counts instead
# of sums up to the 20th, without values from the 18th on.
RUN = (dt.date(2024, 1, 5), dt.date(2024, 2, 2))
REFETCH = (dt.date(2024, 1, 10), dt.date(2024, 1, 19))

SUMS = f"""
    SELECT indice_tiempo, coin, sum(value) FILTER (WHERE type IN ('t0', 't2')) AS tp_usd,
           sum(value) FILTER (WHERE type IN ('t1', 't3')) AS tc_local, count(*) AS n
    FROM ({PANEL}) GROUP BY 1, 2
"""
PAGE_CELLS = f"""
    SELECT indice_tiempo, coin, type,
           CASE WHEN coin = 'error' AND indice_tiempo = DATE '2024-01-26' THEN NULL
                WHEN type = 'tp_usd' THEN nullif(tp_usd, 0) ELSE nullif(tc_local, 0) END AS value
    FROM ({SUMS}) CROSS JOIN (SELECT unnest(['tp_usd', 'tc_local']) AS type)
    WHERE NOT (coin = 'error' AND indice_tiempo = DATE '2024-01-25')
"""
STORED_CELLS = f"""
    SELECT indice_tiempo, coin, type, CASE WHEN indice_tiempo < DATE '2024-01-18' THEN CAST(n AS DECIMAL(18,2)) END AS value
    FROM ({SUMS}) CROSS JOIN (SELECT unnest(['tp_usd', 'tc_local']) AS type) WHERE indice_tiempo <= DATE '2024-01-20'
"""


def _run_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, Dims]:
    odd = F.col("type").isin("t1", "t3")
    sums = events_panel(spark, sf_dir).groupBy(DATE, "coin").agg(
        F.sum(F.when(~odd, F.col("value"))).alias("tp_usd"),
        F.sum(F.when(odd, F.col("value"))).alias("tc_local"),
        F.count("*").alias("n"),
    )
    quote = lambda c: F.coalesce(grouped_text(F.col(c)), F.lit("--------"))
    full = fx_html(quote("tp_usd"), quote("tc_local"))
    late = (F.col("coin") == "error") & (F.col(DATE) == dt.date(2024, 1, 26))
    none = (F.col("coin") == "error") & (F.col(DATE) == dt.date(2024, 1, 25))
    pages = sums.where(~none).select(DATE, "coin", F.when(late, "").otherwise(full).alias("html"))
    value = F.when(F.col(DATE) < dt.date(2024, 1, 18), F.col("n").cast(VALUE)).alias("value")
    types = F.explode(F.array(F.lit("tp_usd"), F.lit("tc_local"))).alias("type")
    stored = sums.where(F.col(DATE) <= dt.date(2024, 1, 20)).select(DATE, "coin", types, value)
    return pages, stored, Dims(FX, coins={c: c.title() for c in COINS})


def _after(stored: str, refetch: tuple[dt.date, dt.date] | None) -> str:
    """The panel after a run, in SQL: what stays, what is loaded, and blanks without a page."""
    span = f"indice_tiempo BETWEEN DATE '{RUN[0]}' AND DATE '{RUN[1]}'"
    again = f"indice_tiempo BETWEEN DATE '{refetch[0]}' AND DATE '{refetch[1]}'" if refetch else "FALSE"
    return f"""
        WITH kept AS ({stored}), page AS ({PAGE_CELLS}),
        days AS (SELECT CAST(d AS DATE) AS indice_tiempo
                 FROM generate_series(DATE '{RUN[0]}', DATE '{RUN[1]}', INTERVAL 1 DAY) AS g(d)),
        miss AS (SELECT indice_tiempo FROM days WHERE indice_tiempo NOT IN (SELECT indice_tiempo FROM kept)),
        read AS (SELECT * FROM page WHERE indice_tiempo IN (SELECT indice_tiempo FROM miss) OR {again}),
        blank AS (SELECT indice_tiempo, coin, type, NULL AS value FROM miss
                  CROSS JOIN (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS coin)
                  CROSS JOIN (SELECT unnest(['tp_usd', 'tc_local']) AS type)
                  WHERE (indice_tiempo, coin) NOT IN (SELECT (indice_tiempo, coin) FROM page))
        SELECT indice_tiempo, coin, type, CAST(value AS DECIMAL(18,2)) AS value, {span} AS published FROM (
            SELECT * FROM kept WHERE (indice_tiempo, coin) NOT IN (SELECT (indice_tiempo, coin) FROM read)
            UNION ALL SELECT * FROM read UNION ALL SELECT * FROM blank)
    """


TRIMMED_CELLS = f"""
    SELECT * FROM ({STORED_CELLS}) WHERE NOT (indice_tiempo > DATE '2024-01-17')
"""
NO_CELLS = f"SELECT * FROM ({STORED_CELLS}) WHERE FALSE"


def _marked(run: incremental.Run) -> DataFrame:
    inside = F.col(DATE).between(F.lit(RUN[0]), F.lit(RUN[1]))
    return run.panel.select(DATE, "coin", "type", money("value").alias("value"), inside.alias("published"))


@query(_after(TRIMMED_CELLS, (REFETCH[0], dt.date(2024, 1, 17))))
def incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trim, load the misses, load the refetch range again, merge."""
    return _marked(incremental.incremental_run(*_run_inputs(spark, sf_dir), *RUN, refetch=REFETCH))


@query(_after(STORED_CELLS, None))
def incremental_run_skip_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored dates without data stay and are not loaded."""
    return _marked(incremental.incremental_run(*_run_inputs(spark, sf_dir), *RUN, skip_trim=True))


@query(_after(NO_CELLS, None))
def incremental_run_skip_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every date of the range is loaded from its pages."""
    return _marked(incremental.incremental_run(*_run_inputs(spark, sf_dir), *RUN, skip_panel=True))


@query(f"""
    SELECT indice_tiempo, {', '.join(f"sum(value) FILTER (WHERE coin = '{c}' AND type = 'tc_local') AS {c}" for c in COINS)}
    FROM ({_after(TRIMMED_CELLS, None)}) WHERE published GROUP BY 1
""")
def incremental_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily series that a run publishes for one measure."""
    pages, stored, dims = _run_inputs(spark, sf_dir)
    run = incremental.incremental_run(pages, stored, dims, *RUN)
    wide = daily_series(run.published, dims, *RUN, member="tc_local")
    return wide.select(DATE, *[money(c).alias(c) for c in columns_except(wide)])
