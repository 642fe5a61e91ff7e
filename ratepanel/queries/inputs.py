"""Panels and pages derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratepanel.schemas import DATE

MONEY = T.DecimalType(18, 2)
COINS = ("click", "error", "purchase", "signup", "view")
TYPES = ("t0", "t1", "t2", "t3")

PANEL = """
    SELECT CAST(ts AS DATE) AS indice_tiempo, event_type AS coin,
           't' || CAST(user_id % 4 AS VARCHAR) AS type, CAST(value AS DECIMAL(18,2)) AS value
    FROM events
"""

QUOTES = """
    SELECT CAST(ts AS DATE) AS indice_tiempo, event_type AS moneda,
           'b' || CAST(user_id % 5 AS VARCHAR) AS entidad_bancaria,
           CASE WHEN user_id % 2 = 0 THEN 'mostrador' ELSE 'electronico' END AS canal,
           CASE WHEN minute(ts) % 2 = 0 THEN 'compra' ELSE 'venta' END AS flujo,
           CASE WHEN hour(ts) < 12 THEN '11hs' WHEN hour(ts) < 14 THEN '13hs' ELSE '15hs' END AS hora,
           CAST(value AS DECIMAL(18,2)) AS valor
    FROM events
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def events_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a quote of its type; users fall into four measures."""
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias(DATE),
        F.col("event_type").alias("coin"),
        F.concat(F.lit("t"), (F.col("user_id") % 4).cast("string")).alias("type"),
        money("value").alias("value"),
    )


def quotes_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a bank quote."""
    hour = F.hour("ts")
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias(DATE),
        F.col("event_type").alias("moneda"),
        F.concat(F.lit("b"), (F.col("user_id") % 5).cast("string")).alias("entidad_bancaria"),
        F.when(F.col("user_id") % 2 == 0, "mostrador").otherwise("electronico").alias("canal"),
        F.when(F.minute("ts") % 2 == 0, "compra").otherwise("venta").alias("flujo"),
        F.when(hour < 12, "11hs").when(hour < 14, "13hs").otherwise("15hs").alias("hora"),
        money("value").alias("valor"),
    )


def comma_text(value: Column) -> Column:
    """``12.50`` as ``12,50``."""
    return F.replace(value.cast("string"), F.lit("."), F.lit(","))


def grouped_text(value: Column, digits: int = 2) -> Column:
    """``1289.63`` as ``1.289,63``."""
    return F.translate(F.format_number(value, digits), ",.", ".,")


def day_text() -> Column:
    return F.date_format(DATE, "dd/MM/yyyy")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def rate_html(term: Column, value: Column) -> Column:
    """Term table: an unknown term, then the asked one twice, the valid value last."""
    return _text(
        "<html><!-- <table><tbody><tr><td>t0</td><td>9,9</td></tr></tbody></table> -->",
        '<table class="table"><thead><tr><th>term</th><th>rate</th></tr></thead><tbody>',
        "<tr><td>zz</td><td>1,5</td></tr><tr><td>",
        term,
        "</td><td>0,01</td></tr><tr class='r'><td>\n",
        term,
        "&nbsp;</td><td><b>",
        comma_text(value),
        "</b></td></tr></tbody></table></html>",
    )


def fx_html(tp_usd: Column, tc_local: Column) -> Column:
    """Dated table: an older row, then the row of the page's date."""
    return _text(
        "<table><thead><tr><td>day</td><td>first</td><td>second</td></tr></thead>",
        "<tbody><tr><td>01/01/1999</td><td>1</td><td>2</td></tr><tr><td>\n",
        day_text(),
        "</td><td>\t",
        tp_usd,
        "</td><td> ",
        tc_local,
        "</td></tr></tbody></table>",
    )


def sml_html(labels: list[str], values: list[Column]) -> Column:
    """Labelled table with one dated row."""
    heads = [f"<th>{label}</th>" for label in labels]
    cells = [p for v in values for p in ("<td>", comma_text(v), "</td>")]
    return _text(
        "<table><thead><tr><th>day</th>",
        *heads,
        "</tr></thead><tbody><tr><td>31/12/1998</td><td>7</td></tr><tr><td>",
        day_text(),
        "</td>",
        *cells,
        "</tr></tbody></table>",
    )


def quote_html(name: Column, values: list[Column]) -> Column:
    """Quote table: another table first, header rows in the body, then one entity."""
    cells = [p for v in values for p in ("<td>", comma_text(v), "</td>")]
    return _text(
        "<table class='nav'><tbody><tr><td>",
        name,
        "</td><td>1</td></tr></tbody></table>",
        '<table class="table  table-quotes"><thead><tr><td>quotes</td></tr></thead>',
        "<tbody><tr><td><b>name</b></td></tr><tr><td>early</td><td>late</td></tr><tr><td>",
        name,
        "</td>",
        *cells,
        "</tr></tbody></table>",
    )
