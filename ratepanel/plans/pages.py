"""Pages of any family to panel rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratepanel.functions.normalize import (
    dash_to_null,
    empty_to_null,
    nonpositive_to_null,
    parse_decimal_comma,
    parse_decimal_grouped,
    parse_decimal_mixed,
    percent_to_ratio,
)
from ratepanel.operators.extract import parse_fx_page, parse_quote_page, parse_rate_page, parse_sml_page
from ratepanel.schemas import DATE, Family
from ratepanel.sources.config import Dims


def parse_pages(pages: DataFrame, dims: Dims) -> DataFrame:
    """The family's parser: page columns, panel dimensions, ``raw`` text.

    ``pages`` has ``indice_tiempo``, ``html`` and, where pages are per coin,
    ``coin``; any other column is carried along.
    """
    match dims.family.name:
        case "libor":
            return parse_rate_page(pages, list(dims.rates))
        case "exchange-rates":
            return parse_fx_page(pages)
        case "sml":
            return parse_sml_page(pages, dims.types)
        case _:
            cells = parse_quote_page(
                pages,
                [(key, name) for key, name, _ in dims.entities],
                [(coin, entity, hour, channel) for coin, entity, hour, channel, _ in dims.quotes],
                css=dims.table_class,
            )
            return cells.withColumnRenamed("coin", "moneda")


def normal_value(raw: Column, family: Family) -> Column:
    """Cell text to an exact decimal, by the family's number format."""
    match family.name:
        case "libor":
            return percent_to_ratio(parse_decimal_comma(empty_to_null(raw)))
        case "exchange-rates":
            return parse_decimal_grouped(dash_to_null(raw))
        case _:
            return parse_decimal_mixed(raw)


def pages_to_panel(pages: DataFrame, dims: Dims) -> DataFrame:
    """Panel rows of the pages, plus any column the pages carry along."""
    family = dims.family
    # A table with pages of several families carries their name.
    cells = parse_pages(pages, dims)
    extra = [c for c in cells.columns if c not in {*family.columns, "raw", "coin", "source"}]
    value = normal_value(F.col("raw"), family)
    valued = cells.select(DATE, *family.dims, value.alias(family.value), *extra)
    return valued.withColumn(family.value, nonpositive_to_null(family.value))


def family_pages(pages: DataFrame, dims: Dims) -> DataFrame:
    """Rows of a shared page table that belong to the family and its configured coins."""
    own = pages.where(F.col("source") == dims.family.name)
    return own.where(F.col("coin").isin(list(dims.coins))) if dims.family.page_dim else own
