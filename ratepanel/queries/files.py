"""Reading back what was written, and the page stream.

Files go to fresh paths in the session's shared folder. These queries run their
writes when they are called; the rows they return are read from the files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratepanel.operators import reshape as R
from ratepanel.operators.quality import value_count
from ratepanel.plans import incremental
from ratepanel.plans.pages import family_pages, pages_to_panel
from ratepanel.queries.inputs import COINS, PANEL, TYPES, events_panel, fx_html, grouped_text, money
from ratepanel.queries.registry import query
from ratepanel.queries.store import NO_CELLS, REFETCH, RUN, TRIMMED_CELLS, _after, _run_inputs
from ratepanel.schemas import DATE, FX, LIBOR, VALUE
from ratepanel.sources import pages as PG
from ratepanel.sources import panel as PN
from ratepanel.sources import parsed_json as PJ
from ratepanel.sources import series as SR
from ratepanel.sources.config import Dims
from ratepanel.sources.shared import fresh_path
from ratepanel.sources.store import months_between
from ratepanel.streaming import pages as ST

CELLS = f"""
    SELECT indice_tiempo, coin, type, CASE WHEN type <> 't3' THEN CAST(sum(value) AS DECIMAL(18,2)) END AS value
    FROM ({PANEL}) GROUP BY 1, 2, 3
"""


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.sum("value").cast(VALUE)
    summed = events_panel(spark, sf_dir).groupBy(DATE, "coin", "type").agg(total.alias("value"))
    return summed.withColumn("value", F.when(F.col("type") != "t3", F.col("value")))


@query(CELLS)
def panel_file_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A panel through CSV, empty values included."""
    path = fresh_path(spark, "panel")
    PN.write_panel(_cells(spark, sf_dir), path, FX)
    return PN.read_panel(spark, path, FX).withColumn("value", money("value"))


@query(f"SELECT * FROM ({CELLS}) WHERE indice_tiempo BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'")
def panel_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a panel in Parquet; a date range of the newer one."""
    root = fresh_path(spark, "snapshots")
    cells = _cells(spark, sf_dir)
    PN.write_snapshot(cells.where("type = 't0'"), root, FX)
    PN.write_snapshot(cells, root, FX)
    stored = PN.read_snapshot(spark, root, FX, dt.date(2024, 1, 8), dt.date(2024, 1, 21))
    return stored.withColumn("value", money("value"))


@query(f"SELECT indice_tiempo, type, value FROM ({CELLS}) WHERE FALSE")
def missing_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A panel that was never written is empty, and adds nothing to the events' terms."""
    empty = PN.read_panel_or_empty(spark, fresh_path(spark, "absent"), LIBOR)
    stored = _cells(spark, sf_dir).select(DATE, "type", "value").join(empty.select("type"), "type", "left_semi")
    return stored.select(DATE, "type", money("value").alias("value"))


@query(f"""
    SELECT indice_tiempo, {', '.join(f"CAST(nullif(sum(value) FILTER (WHERE type = '{t}'), 0) AS DECIMAL(18,2)) AS libor_{t}_dias" for t in TYPES)},
           CAST(NULL AS DECIMAL(18,2)) AS libor_t9_dias
    FROM ({PANEL}) GROUP BY 1
""")
def series_file_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide series through CSV in date order, with a column that has no data."""
    path = fresh_path(spark, "series")
    wide = R.panel_to_rates(events_panel(spark, sf_dir), {t: f"libor_{t}_dias" for t in TYPES})
    header = [DATE, *[f"libor_{t}_dias" for t in TYPES], "libor_t9_dias"]
    SR.write_series(wide, header, path)
    read = SR.read_series(spark, path, header)
    return read.select(DATE, *[money(c).alias(c) for c in header[1:]])


@query(f"SELECT indice_tiempo, type, CAST(sum(value) AS DECIMAL(18,2)) AS value FROM ({PANEL}) GROUP BY 1, 2 HAVING sum(value) > 0")
def parsed_json_to_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumps of parsed rows, one per day, back to the panel."""
    path = fresh_path(spark, "parsed")
    columns = {t: f"libor_{t}_dias" for t in TYPES}
    wide = R.panel_to_rates(events_panel(spark, sf_dir), columns)
    row = F.struct(DATE, *[F.col(c).cast("string").alias(c) for c in columns.values()])
    days = F.col(DATE).cast("string").alias("day")
    wide.select(days, F.array(row).alias("parsed")).write.partitionBy("day").json(path)
    read = PJ.read_parsed_json(spark, path)
    typed = read.select(F.to_date(DATE).alias(DATE), *[money(c).alias(c) for c in columns.values()])
    return R.rates_to_panel(typed).where("value is not null")


RAGGED = f"""
    SELECT indice_tiempo, count(DISTINCT coin || type) + 1 AS n
    FROM ({PANEL}) WHERE value > 20 * (1 + isodow(indice_tiempo)) GROUP BY 1
"""


@query(f"SELECT count(*) AS n_records, CAST(sum(n) AS BIGINT) AS n_values, CAST(max(n) AS BIGINT) AS most_values FROM ({RAGGED})")
def ragged_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values in dumps whose records have as many as occurred that day, one dump per weekday."""
    path = fresh_path(spark, "ragged")
    weekday = F.weekday(DATE) + 1
    cells = events_panel(spark, sf_dir).where(F.col("value") > 20 * (1 + weekday))
    summed = cells.groupBy(DATE, F.concat("coin", "type").alias("key")).agg(F.sum("value").cast("string").alias("total"))
    pairs = F.collect_list(F.struct("key", F.when(F.col("total") > "5", F.col("total")).alias("total")))
    day = F.map_from_entries(F.array(F.struct(F.lit(DATE).alias("key"), F.col(DATE).cast("string").alias("total"))))
    records = summed.groupBy(DATE).agg(pairs.alias("pairs")).select(
        F.weekday(DATE).alias("day"), F.map_concat(day, F.map_from_entries("pairs")).alias("record")
    )
    dumps = records.groupBy("day").agg(F.to_json(F.struct(F.collect_list("record").alias("parsed")), {"ignoreNullFields": "false"}).alias("value"))
    dumps.write.partitionBy("day").text(path)
    return value_count(PJ.read_ragged(spark, path))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per coin and day with the day's sums."""
    odd = F.col("type").isin("t1", "t3")
    sums = events_panel(spark, sf_dir).groupBy(DATE, "coin").agg(
        F.sum(F.when(~odd, F.col("value"))).alias("tp_usd"), F.sum(F.when(odd, F.col("value"))).alias("tc_local")
    )
    quote = lambda c: F.coalesce(grouped_text(F.col(c)), F.lit("--------"))
    html = fx_html(quote("tp_usd"), quote("tc_local"))
    return sums.select(F.lit(FX.name).alias("source"), "coin", DATE, html.alias("html"))


SUMS = f"""
    WITH s AS (SELECT indice_tiempo, coin, CASE WHEN type IN ('t0', 't2') THEN 'tp_usd' ELSE 'tc_local' END AS type,
                      sum(value) AS value FROM ({PANEL}) GROUP BY 1, 2, 3),
    d AS (SELECT DISTINCT indice_tiempo, coin FROM s)
    SELECT d.indice_tiempo, d.coin, t.type, CAST(nullif(s.value, 0) AS DECIMAL(18,2)) AS value
    FROM d CROSS JOIN (SELECT unnest(['tp_usd', 'tc_local']) AS type) t LEFT JOIN s USING (indice_tiempo, coin, type)
"""
FX_DIMS = Dims(FX, coins={c: c.title() for c in COINS})


@query(SUMS)
def pages_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as HTML text below source, coin and date folders, read back and parsed."""
    root = fresh_path(spark, "pages")
    pages = _pages(spark, sf_dir).withColumnsRenamed({"html": "value"})
    named = pages.select("source", "coin", F.col(DATE).cast("string").alias("day"), "value")
    named.write.partitionBy("source", "coin", "day").text(root)
    name = r"source=([^/]+)/coin=([^/]+)/day=(\d{4}-\d{2}-\d{2})/"
    read = PG.load_page_files(spark, root, name, "*.txt")
    panel = pages_to_panel(family_pages(read, FX_DIMS), FX_DIMS)
    return panel.withColumn("value", money("value"))


@query(SUMS)
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page files as a stream in two rounds; the second corrects every page of the first."""
    inbox, store, state = (fresh_path(spark, n) for n in ("inbox", "store", "state"))
    pages = _pages(spark, sf_dir)
    wrong = fx_html(F.lit("1,00"), F.lit("2,00"))
    for round_ in (pages.withColumn("html", wrong), pages):
        round_.write.mode("append").parquet(inbox)
        ST.store_pages(ST.page_stream(spark, inbox), store, FX_DIMS, state, available_now=True).awaitTermination()
    return ST.read_store(spark, store, FX_DIMS).withColumn("value", money("value"))


@query(f"SELECT * EXCLUDE published FROM ({_after(TRIMMED_CELLS, (REFETCH[0], dt.date(2024, 1, 17)))}) WHERE published")
def incremental_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An incremental run on a stored panel, the new version read back."""
    root = fresh_path(spark, "run")
    pages, stored, dims = _run_inputs(spark, sf_dir)
    PN.write_snapshot(stored, root, dims.family)
    published = incremental.update_store(pages, root, dims, *RUN, refetch=REFETCH)
    return published.withColumn("value", money("value"))


@query(f"SELECT * EXCLUDE published FROM ({_after(NO_CELLS, None)}) WHERE published")
def incremental_store_skip_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that leaves its stored panel aside loads every date from its pages."""
    root = fresh_path(spark, "skipped")
    pages, stored, dims = _run_inputs(spark, sf_dir)
    PN.write_snapshot(stored, root, dims.family)
    published = incremental.update_store(pages, root, dims, *RUN, skip_panel=True)
    return published.withColumn("value", money("value"))


ORDERS = """
    SELECT CAST(o_orderdate AS DATE) AS indice_tiempo, o_orderpriority[1:1] AS type, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS value
    FROM orders GROUP BY 1, 2
"""
SPAN = (dt.date(1993, 11, 16), dt.date(1995, 2, 11))


@query(f"""
    SELECT indice_tiempo, type, CAST(CASE WHEN year(indice_tiempo) = 1994 THEN value * 2 WHEN year(indice_tiempo) = 1993 THEN value + 1 ELSE value END AS DECIMAL(18,2)) AS value
    FROM ({ORDERS}) WHERE indice_tiempo BETWEEN DATE '{SPAN[0]}' AND DATE '{SPAN[1]}'
      AND NOT (year(indice_tiempo) = 1993 AND type = '5')
""")
def store_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writers begin from one version of a store and replace other months; what a range holds afterwards."""
    root = fresh_path(spark, "months")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    keys = (F.to_date("o_orderdate").alias(DATE), F.substring("o_orderpriority", 1, 1).alias("type"))
    panel = orders.groupBy(*keys).agg(F.sum(money("o_totalprice")).cast(VALUE).alias("value"))
    base = PN.write_snapshot(panel, root, LIBOR)
    one, two = (panel.where(F.year(DATE) == y) for y in (1994, 1993))
    raised = F.col("value").cast("decimal(20,2)")
    PN.write_snapshot(one.withColumn("value", (raised * 2).cast(VALUE)), root, LIBOR, months_between(dt.date(1994, 1, 1), dt.date(1994, 12, 1)), base)
    later = two.where("type <> '5'").withColumn("value", (raised + 1).cast(VALUE))
    PN.write_snapshot(later, root, LIBOR, months_between(dt.date(1993, 1, 1), dt.date(1993, 12, 1)), base)
    return PN.read_snapshot(spark, root, LIBOR, *SPAN).withColumn("value", money("value"))


@query(f"SELECT * FROM ({SUMS}) WHERE indice_tiempo BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
def stream_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of pages, merged after every second one; each corrects the days of the one before."""
    store, pages = fresh_path(spark, "merged"), _pages(spark, sf_dir)
    loaded = pages.withColumns({"loaded_at": F.lit(dt.datetime(2024, 2, 1)), "loaded_from": F.lit("made")})
    day = F.dayofmonth(DATE)
    wrong = fx_html(F.lit("1,00"), F.lit("2,00"))
    for batch in range(5):
        first, last = batch * 7, batch * 7 + 7
        right = day.between(first - 6, first)
        own = loaded.where(day.between(first - 6, last))
        ST.store_batch(own.withColumn("html", F.when(right, F.col("html")).otherwise(wrong)), batch, store, FX_DIMS, gather=2)
    panel = ST.read_store(spark, store, FX_DIMS, dt.date(2024, 1, 5), dt.date(2024, 1, 20))
    return panel.withColumn("value", money("value"))
