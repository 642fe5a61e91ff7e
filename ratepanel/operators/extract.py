"""Rates out of HTML pages.

Each page is read where it lies: rows, cells and lookups are array expressions
on the page's own row, so extraction needs neither a shuffle nor a Python
worker. Every parser returns the full template of its page: a page that is
empty or malformed gives null cells, never fewer rows. Dimension lists come
from the configuration and travel in the plan as constant arrays.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratepanel.functions import html as H
from ratepanel.functions.normalize import DAY_FORMAT
from ratepanel.functions.sql import name, rows, struct, text
from ratepanel.schemas import CHANNELS, DATE, FLOWS, FX_TYPES, HOURS


def _keys(pages: DataFrame, html: str) -> list[str]:
    return [c for c in pages.columns if c != html]


def _day() -> str:
    return f"date_format({DATE}, {text(DAY_FORMAT)})"


def html_table_rows(
    pages: DataFrame, html: str = "html", part: str = "tbody", tag: str = "t[dh]"
) -> DataFrame:
    """Rows of the first table, those of tables inside it too: page columns, ``row_idx``, ``cells``."""
    keys = [name(k) for k in _keys(pages, html)]
    lines = H.row_texts(H.section(H.first_table(name(html)), part), tag)
    return pages.selectExpr(*keys, f"posexplode({lines}) AS (row_idx, cells)")


def html_table_cells(
    pages: DataFrame, html: str = "html", part: str = "tbody", tag: str = "t[dh]"
) -> DataFrame:
    """Cells of the first table: page columns, ``row_idx``, ``col_idx``, ``text``."""
    lines = html_table_rows(pages, html, part, tag)
    keys = [name(c) for c in lines.columns if c != "cells"]
    return lines.selectExpr(*keys, "posexplode(cells) AS (col_idx, text)")


def html_elements(pages: DataFrame, tags: Sequence[str], html: str = "html") -> DataFrame:
    """Texts of the named elements: page columns, ``tag``, ``idx``, ``text``."""
    keys = [name(k) for k in _keys(pages, html)]
    found = ", ".join(struct({"tag": text(t), "items": H.elements(name(html), t)}) for t in tags)
    return (
        pages.selectExpr(*keys, f"inline(array({found}))")
        .selectExpr(*keys, "tag", "posexplode(items) AS (idx, _item)")
        .selectExpr(*keys, "tag", "idx", f"{H.clean_text('_item')} AS text")
    )


def parse_rate_page(pages: DataFrame, terms: Sequence[str], html: str = "html") -> DataFrame:
    """Term and rate pages: page columns, ``type``, ``raw``.

    Only configured terms are kept; the last row of a term wins.
    """
    keys = [name(k) for k in _keys(pages, html)]
    lines = H.row_texts(H.section(H.first_table(name(html)), "tbody"))
    wanted = rows({"type": t} for t in terms)
    opened = pages.selectExpr(*keys, f"{lines} AS _lines").selectExpr("*", f"inline({wanted})")
    last = "try_element_at(filter(_lines, cells -> try_element_at(cells, 1) = type), -1)"
    return opened.selectExpr(*keys, "type", f"try_element_at({last}, 2) AS raw")


def unknown_rates(cells: DataFrame, dim_rate: DataFrame) -> DataFrame:
    """Page terms (``type``) that the rate dimension (``term``) does not have."""
    return cells.join(dim_rate.select(F.col("term").alias("type")), "type", "left_anti")


def parse_fx_page(pages: DataFrame, html: str = "html") -> DataFrame:
    """Dated rows of two measures: page columns, ``type``, ``raw``.

    The first cell that contains the page's date must be that date alone.
    """
    keys = [name(k) for k in _keys(pages, html)]
    lines = H.row_cells(H.section("tbl", "tbody"))
    first = f"try_element_at(filter({lines}, line -> exists(line.own, c -> contains(c, day))), 1)"
    alone = "CASE WHEN try_element_at(filter(hit.own, c -> contains(c, day)), 1) = day THEN hit.cells END"
    headed = f"CASE WHEN tbl RLIKE '(?i)<thead' THEN {H.let(first, 'hit', alone)} END"
    row = H.let(H.first_table(name(html)), "tbl", H.let(_day(), "day", headed))
    # The second cell is the dollar rate, the third the local one.
    measures = rows({"type": t, "_at": i} for t, i in zip(FX_TYPES, (3, 2), strict=True))
    opened = pages.selectExpr(*keys, f"{row} AS _row").selectExpr("*", f"inline({measures})")
    return opened.selectExpr(*keys, "type", "try_element_at(_row, _at) AS raw")


def parse_sml_page(
    pages: DataFrame, types: Iterable[tuple[str, str, str]], html: str = "html"
) -> DataFrame:
    """Dated row under labelled columns: page columns, ``type``, ``raw``.

    ``types`` lists (coin, header label, column name). Cells 1 to 4 of the row
    take the labels of header cells 1 to 4; a later header row wins.
    """
    keys = [name(k) for k in _keys(pages, html)]
    lines = H.row_cells(H.section("tbl", "tbody"))
    first = f"try_element_at(filter({lines}, line -> exists(line.own, c -> c = day)), 1).cells"
    heads = H.row_texts(H.section("tbl", "thead"), "th")
    zipped = f"flatten(transform({heads}, head -> arrays_zip(slice(head, 2, 4), hit)))"
    labelled = H.let(f"slice({first}, 2, 4)", "hit", zipped)
    pairs = H.let(H.first_table(name(html)), "tbl", H.let(_day(), "day", labelled))
    typed = f"CAST({pairs} AS ARRAY<STRUCT<label: STRING, raw: STRING>>)"
    wanted = rows({"coin": c, "label": label, "type": t} for c, label, t in types)
    opened = pages.selectExpr(*keys, f"{typed} AS _pairs").selectExpr(
        "*", f"explode(filter({wanted}, want -> want.coin = coin)) AS _want"
    )
    last = "try_element_at(filter(_pairs, pair -> pair.label = _want.label), -1)"
    return opened.selectExpr(*keys, "_want.type AS type", f"{last}.raw AS raw")


def _said_keys(entities: Sequence[tuple[str, str]]) -> str:
    """SQL text of the keys of all entities whose names stand in the text ``said``.

    One pattern looks at each place for the longest name that begins there; a
    constant map gives the keys of all names inside that one, so names that
    begin or hold each other are all found.
    """
    names = sorted({legal for _, legal in entities}, key=lambda n: (-len(n), n))
    inside = ", ".join(f"{text(n)}, array({', '.join(text(key) for key, legal in entities if legal in n)})" for n in names)
    pattern = f"(?=({'|'.join(re.escape(n) for n in names)}))"
    found = f"transform(regexp_extract_all(said, {text(pattern)}, 1), legal -> element_at(map({inside}), legal))"
    return f"array_distinct(flatten({found}))"


def entity_rows(lines: str, entities: Iterable[tuple[str, str]]) -> str:
    """For each (key, legal name), the first row with the name inside a cell.

    SQL text of an array of (``key``, ``cells``); ``cells`` is null for an
    entity without a row. Each row is searched once for all names.
    """
    listed = [(key, legal) for key, legal in entities]
    if not listed:
        return "CAST(array() AS ARRAY<STRUCT<key: STRING, cells: ARRAY<STRING>>>)"
    # Cells are joined by a character that no name holds.
    said = H.let(f"array_join(line.own, {text(chr(1))})", "said", _said_keys(listed))
    keyed = f"filter(transform({lines}, line -> {struct({'keys': said, 'cells': 'line.cells'})}), line -> size(line.keys) > 0)"
    found = struct({"key": "bank", "cells": "try_element_at(filter(banked, line -> array_contains(line.keys, bank)), 1).cells"})
    keys = f"array({', '.join(text(key) for key, _ in listed)})"
    return H.let(keyed, "banked", f"transform({keys}, bank -> {found})")


def quote_position(hour: str, channel: str, flow: str) -> str:
    """SQL text of a quote's cell index: four cells per hour, two per channel, one per flow."""
    return (
        f"(1 + 2 * (CAST({hour} AS INT) - 11) + CASE WHEN {channel} = 'electronico' THEN 2 ELSE 0 END"
        f" + CASE WHEN {flow} = 'venta' THEN 1 ELSE 0 END)"
    )


def _configured(quotes: Iterable[tuple[str, str, int, str]]) -> str:
    """Map from ``coin|entity`` to its configured hours and channels."""
    listed: dict[str, list[str]] = {}
    for coin, entity, hour, channel in quotes:
        listed.setdefault(f"{coin}|{entity}", []).append(f"{hour}|{channel}")
    entries = [f"{text(key)}, array({', '.join(map(text, at))})" for key, at in listed.items()]
    return f"map({', '.join(entries)})" if entries else "CAST(NULL AS MAP<STRING, ARRAY<STRING>>)"


def parse_quote_page(
    pages: DataFrame,
    entities: Iterable[tuple[str, str]],
    quotes: Iterable[tuple[str, str, int, str]],
    html: str = "html",
    css: str | None = None,
) -> DataFrame:
    """Bank quote pages: page columns, the four quote dimensions, ``raw``.

    ``entities`` lists (key, legal name), ``quotes`` the configured
    (coin, entity, hour, channel). All twelve cells of an entity are returned;
    those that are not configured for the page's coin are null. With ``css``
    only a table with exactly that class list counts.
    """
    keys = [name(k) for k in _keys(pages, html)]
    table = H.table_with_class(name(html), css) if css else H.first_table(name(html))
    found = H.let(H.row_cells(H.section(table, "tbody")), "lines", entity_rows("lines", entities))
    known = f"try_element_at({_configured(quotes)}, concat_ws('|', coin, _bank.key))"
    banks = pages.selectExpr(*keys, f"explode({found}) AS _bank").selectExpr(
        *keys, "_bank.key AS entidad_bancaria", "_bank.cells AS _cells", f"{known} AS _known"
    )
    slots = ", ".join(
        struct(
            {
                "canal": text(channel),
                "flujo": text(flow),
                "hora": text(f"{hour}hs"),
                "_slot": text(f"{hour}|{channel}"),
                "_at": quote_position(text(hour), text(channel), text(flow)) + " + 1",
            }
        )
        for hour in HOURS
        for channel in CHANNELS
        for flow in FLOWS
    )
    raw = "CASE WHEN array_contains(_known, _slot) THEN try_element_at(_cells, _at) END AS raw"
    opened = banks.selectExpr("*", f"inline(array({slots}))")
    return opened.selectExpr(*keys, "entidad_bancaria", "canal", "flujo", "hora", raw)


def offered_coins(pages: DataFrame, coins: Mapping[str, str], html: str = "html") -> DataFrame:
    """Configured coins whose label is an option of the page: page columns, ``key``, ``label``."""
    keys = [name(k) for k in _keys(pages, html)]
    options = H.clean_texts(H.elements(name(html), "option"))
    listed = rows({"key": k, "label": label} for k, label in coins.items())
    opened = pages.selectExpr(*keys, f"{options} AS _options").selectExpr("*", f"inline({listed})")
    return opened.where("array_contains(_options, label)").drop("_options")
