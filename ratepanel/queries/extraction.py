"""HTML extraction: one page per event, and the web pages themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratepanel.operators import extract as X
from ratepanel.plans.pages import pages_to_panel
from ratepanel.queries.inputs import (
    COINS,
    PANEL,
    QUOTES,
    TYPES,
    comma_text,
    events_panel,
    fx_html,
    grouped_text,
    quote_html,
    quotes_panel,
    rate_html,
    sml_html,
    table,
)
from ratepanel.queries.registry import query
from ratepanel.schemas import DATE, FX, LIBOR, SML, TCE
from ratepanel.sources.config import Dims

RATES = Dims(LIBOR, rates={t: f"libor_{t}_dias" for t in TYPES})
KINDS = "SELECT unnest(['t0', 't1', 't2', 't3']) AS kind"


def _summary(panel: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Cells, values and exact total per group."""
    return panel.groupBy(*keys).agg(
        F.count("*").alias("n_cells"),
        F.count(value).alias("n_values"),
        F.sum(value).cast("decimal(24,6)").alias("total"),
    )


@query(f"""
    SELECT indice_tiempo, coin AS event_type, kind AS type, count(*) AS n_cells,
           count(*) FILTER (WHERE type = kind AND value > 0) AS n_values,
           CAST(sum(value) FILTER (WHERE type = kind AND value > 0) * 0.01 AS DECIMAL(24,6)) AS total
    FROM ({PANEL}) CROSS JOIN ({KINDS}) GROUP BY 1, 2, 3
""")
def extract_rate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term pages: comments ignored, unknown terms dropped, the last row of a term kept."""
    pages = events_panel(spark, sf_dir).select(
        DATE, F.col("coin").alias("event_type"), rate_html(F.col("type"), F.col("value")).alias("html")
    )
    return _summary(pages_to_panel(pages, RATES), [DATE, "event_type", "type"])


@query(f"""
    SELECT 'zz' AS type, coin, count(*) AS n FROM ({PANEL}) GROUP BY 2
""")
def unknown_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms on the pages that the configuration does not have."""
    pages = events_panel(spark, sf_dir).select(
        "coin", rate_html(F.col("type"), F.col("value")).alias("html")
    )
    terms = X.html_table_cells(pages).where("col_idx = 0").select("coin", F.col("text").alias("type"))
    unknown = X.unknown_rates(terms, RATES.rate_frame(spark))
    return unknown.groupBy("type", "coin").agg(F.count("*").alias("n"))


@query(f"""
    WITH v AS (SELECT indice_tiempo, coin, value * 1000 AS tp_usd, CASE WHEN value >= 5 THEN value END AS tc_local FROM ({PANEL})),
    l AS (SELECT indice_tiempo, coin, 'tp_usd' AS type, tp_usd AS value FROM v
          UNION ALL SELECT indice_tiempo, coin, 'tc_local', tc_local FROM v)
    SELECT indice_tiempo, coin, type, count(*) AS n_cells,
           count(value) FILTER (WHERE value > 0) AS n_values, CAST(sum(value) FILTER (WHERE value > 0) AS DECIMAL(24,6)) AS total
    FROM l GROUP BY 1, 2, 3
""")
def extract_date_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated pages: the row of the page's date, grouped numbers, dashes for no quote."""
    value = F.col("value")
    tp_usd = grouped_text((value * 1000).cast("decimal(18,2)"))
    tc_local = F.when(value < 5, "--------").otherwise(comma_text(value))
    pages = events_panel(spark, sf_dir).select(DATE, "coin", fx_html(tp_usd, tc_local).alias("html"))
    return _summary(pages_to_panel(pages, Dims(FX, coins={c: c for c in COINS})), [DATE, "coin", "type"])


LABELS = ["first rate", "second rate", "way there", "way back"]


@query(f"""
    SELECT indice_tiempo, coin, kind AS type, count(*) AS n_cells,
           count(*) FILTER (WHERE v > 0 AND NOT (coin = 'error' AND kind = 't2')) AS n_values,
           CAST(sum(v) FILTER (WHERE v > 0 AND NOT (coin = 'error' AND kind = 't2')) AS DECIMAL(24,6)) AS total
    FROM (SELECT *, value + CAST(kind[2:] AS INTEGER) AS v FROM ({PANEL}) CROSS JOIN ({KINDS})) WHERE NOT (coin = 'click' AND kind = 't3') GROUP BY 1, 2, 3
""")
def extract_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled pages: one coin has a column less, another waits for a label its pages lack."""
    types = [
        (coin, "Otro" if (coin, t) == ("error", "t2") else label, t)
        for coin in COINS
        for label, t in zip(LABELS, TYPES, strict=True)
        if (coin, t) != ("click", "t3")
    ]
    values = [(F.col("value") + i).cast("decimal(18,2)") for i in range(4)]
    pages = events_panel(spark, sf_dir).select(DATE, "coin", sml_html(LABELS, values).alias("html"))
    dims = Dims(SML, coins={c: c for c in COINS}, types=tuple(types))
    return _summary(pages_to_panel(pages, dims), [DATE, "coin", "type"])


@query(f"""
    WITH e AS (SELECT unnest(['b0', 'b1', 'b2', 'b3', 'b4']) AS bank),
    p AS (SELECT canal, flujo, hora, 1 + 2 * (CAST(hora[1:2] AS INTEGER) - 11) + 2 * CAST(canal = 'electronico' AS INTEGER)
                 + CAST(flujo = 'venta' AS INTEGER) AS pos
          FROM (SELECT unnest(['mostrador', 'electronico']) AS canal) CROSS JOIN (SELECT unnest(['compra', 'venta']) AS flujo)
          CROSS JOIN (SELECT unnest(['11hs', '13hs', '15hs']) AS hora)),
    q AS (SELECT indice_tiempo, moneda, entidad_bancaria, valor FROM ({QUOTES}))
    SELECT q.indice_tiempo, q.moneda, e.bank AS entidad_bancaria, p.canal, p.flujo, p.hora, count(*) AS n_cells,
           count(*) FILTER (WHERE bank = q.entidad_bancaria AND NOT (moneda = 'error' AND p.canal = 'electronico')) AS n_values,
           CAST(sum(valor + pos * 0.001) FILTER (WHERE bank = q.entidad_bancaria AND NOT (moneda = 'error' AND p.canal = 'electronico')) AS DECIMAL(24,6)) AS total
    FROM q CROSS JOIN e CROSS JOIN p GROUP BY ALL
""")
def extract_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bank pages: the table of the right class, the entity's row, twelve cells by position."""
    name = F.concat(F.lit("BANCO "), F.upper("entidad_bancaria"), F.lit(" (ARG.) S.A."))
    values = [(F.col("valor") + F.lit(i).cast("decimal(4,0)") * F.expr("0.001BD")).cast("decimal(18,3)") for i in range(1, 13)]
    pages = quotes_panel(spark, sf_dir).select(
        DATE, F.col("moneda").alias("coin"), quote_html(name, values).alias("html")
    )
    banks = [f"b{i}" for i in range(5)]
    dims = Dims(
        TCE,
        coins={c: c for c in COINS},
        entities=tuple((b, f"BANCO {b.upper()} (ARG.) S.A.", b) for b in banks),
        quotes=tuple(
            (coin, b, hour, channel, True)
            for coin in COINS
            for b in banks
            for hour in (11, 13, 15)
            for channel in ("mostrador", "electronico")
            if (coin, channel) != ("error", "electronico")
        ),
        table_class="table table-quotes",
    )
    return _summary(pages_to_panel(pages, dims), [DATE, *TCE.dims], "valor")


def _damaged(html: Column) -> Column:
    """One kind of damage per coin: no page, a notice, no body, no table."""
    return (
        F.when(F.col("coin") == "click", "")
        .when(F.col("coin") == "error", "<p>No existen registros</p>")
        .when(F.col("coin") == "purchase", "<table><thead><tr><th>No existen registros</th></tr></thead></table>")
        .when(F.col("coin") == "signup", F.regexp_replace(html, "</?table[^>]*>", ""))
        .otherwise(html)
    )


@query(f"""
    SELECT indice_tiempo, coin AS event_type, kind AS type, count(*) AS n_cells,
           count(*) FILTER (WHERE type = kind AND coin = 'view' AND value > 0) AS n_values,
           CAST(sum(value) FILTER (WHERE type = kind AND coin = 'view' AND value > 0) * 0.01 AS DECIMAL(24,6)) AS total
    FROM ({PANEL}) CROSS JOIN ({KINDS}) GROUP BY 1, 2, 3
""")
def empty_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged pages still give their full set of null cells."""
    html = rate_html(F.col("type"), F.col("value"))
    pages = events_panel(spark, sf_dir).select(
        DATE, F.col("coin").alias("event_type"), _damaged(html).alias("html")
    )
    return _summary(pages_to_panel(pages, RATES), [DATE, "event_type", "type"])


@query(f"""
    WITH p AS (SELECT indice_tiempo, type, replace(CAST(value AS VARCHAR), '.', ',') AS v FROM ({PANEL})),
    c AS (SELECT indice_tiempo, 0 AS row_idx, 0 AS col_idx, 'zz' AS text FROM p
          UNION ALL SELECT indice_tiempo, 0, 1, '1,5' FROM p
          UNION ALL SELECT indice_tiempo, 1, 0, type FROM p UNION ALL SELECT indice_tiempo, 1, 1, '0,01' FROM p
          UNION ALL SELECT indice_tiempo, 2, 0, type FROM p UNION ALL SELECT indice_tiempo, 2, 1, v FROM p)
    SELECT indice_tiempo, row_idx, col_idx, text, count(*) AS n FROM c GROUP BY 1, 2, 3, 4
""")
def html_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of the first visible table with its place."""
    pages = events_panel(spark, sf_dir).select(DATE, rate_html(F.col("type"), F.col("value")).alias("html"))
    cells = X.html_table_cells(pages)
    return cells.groupBy(DATE, "row_idx", "col_idx", "text").agg(F.count("*").alias("n"))


@query(f"""
    WITH p AS (SELECT indice_tiempo, coin, type, replace(CAST(value AS VARCHAR), '.', ',') AS v FROM ({PANEL})),
    c AS (SELECT indice_tiempo, coin, 0 AS row_idx, unnest([0, 1, 2, 3, 4]) AS col_idx, unnest([coin, type || v, type, v, 'z']) AS text FROM p
          UNION ALL SELECT indice_tiempo, coin, 1, unnest([0, 1]), unnest([type, v]) FROM p
          UNION ALL SELECT indice_tiempo, coin, 2, unnest([0, 1]), unnest(['after', '>' || coin]) FROM p)
    SELECT indice_tiempo, coin, row_idx, col_idx, text, count(*) AS n FROM c GROUP BY ALL
""")
def nested_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows around and inside a table in a table; signs that close no tag in quoted attributes."""
    html = F.concat(
        F.lit("<table id='a>b'><tbody title=\"c>d\"><tr class='e>f'><td title='g>h'>"),
        "coin",
        F.lit("</td><td id=\"i>j\"><table><tbody><tr><td>"),
        "type",
        F.lit("</td><td>"),
        comma_text(F.col("value")),
        F.lit("</td></tr></tbody></table></td><td>z</td></tr><tr><td>after</td><td><b title='>'>&gt;"),
        "coin",
        F.lit("</b></td></tr></tbody></table><table><tbody><tr><td>other</td></tr></tbody></table>"),
    )
    pages = events_panel(spark, sf_dir).select(DATE, "coin", html.alias("html"))
    cells = X.html_table_cells(pages)
    return cells.groupBy(DATE, "coin", "row_idx", "col_idx", "text").agg(F.count("*").alias("n"))


@query(f"""
    SELECT indice_tiempo, coin, concat(CAST(n AS VARCHAR), 'º ', '😀', ' &lt; ', '€ñ ', '&unknown; ', chr(233), '≂̸') AS text, count(*) AS rows
    FROM (SELECT indice_tiempo, coin, day(indice_tiempo) AS n FROM ({PANEL})) GROUP BY ALL
""")
def character_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with references by name and number, one that stands for a reference, one that stands for nothing."""
    said = "&ordm; &#x1F600; &#38;lt; &euro;&ntilde; &unknown; &#233;&nesim;</td></tr></tbody></table>"
    html = F.concat(F.lit("<table><tbody><tr><td> "), F.dayofmonth(DATE).cast("string"), F.lit(said))
    pages = events_panel(spark, sf_dir).select(DATE, "coin", html.alias("html"))
    return X.html_table_cells(pages).groupBy(DATE, "coin", "text").agg(F.count("*").alias("rows"))


TAGS = ("title", "h1", "li", "a", "p")


def _tag_sql(tag: str) -> str:
    pattern = rf"(?is)<{tag}\b[^>]*>(.*?)(?:</{tag}\s*>|\z)"
    return f"SELECT page_id, '{tag}' AS tag, regexp_extract_all(html, '{pattern}', 1) AS items FROM pages"


@query(f"""
    WITH f AS ({' UNION ALL '.join(_tag_sql(t) for t in TAGS)}),
    i AS (SELECT page_id, tag, unnest(items) AS item, CAST(generate_subscripts(items, 1) - 1 AS INTEGER) AS idx FROM f),
    s AS (SELECT page_id, tag, idx, regexp_replace(item, '<[^>]+>', '', 'g') AS t FROM i)
    SELECT page_id, tag, idx, regexp_replace(
             replace(replace(replace(replace(replace(replace(replace(replace(t, '&copy;', '©'), '&middot;', '·'), '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
             '^[\\s\\x{{a0}}]+|[\\s\\x{{a0}}]+$', '', 'g') AS text
    FROM s
""")
def page_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of five kinds of elements of the web pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return X.html_elements(pages, TAGS)


@query(f"""
    SELECT indice_tiempo, coin AS key, count(*) AS n FROM ({PANEL}) WHERE coin <> 'error' GROUP BY 1, 2
""")
def offered_coins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured coins that a page's form offers; one coin on the pages is not configured."""
    form = F.concat(
        F.lit('<form><select name="coin"><option value="0">choose one</option>\n<option value="1"> '),
        F.initcap("coin"),
        F.lit(" (&Ntilde;)</option></select></form>"),
    )
    pages = events_panel(spark, sf_dir).select(DATE, form.alias("html"))
    coins = {c: f"{c.title()} (Ñ)" for c in COINS if c != "error"}
    return X.offered_coins(pages, coins).groupBy(DATE, "key").agg(F.count("*").alias("n"))
