"""Scalar normalisation. Every function maps columns to a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratepanel.schemas import VALUE

DAY_FORMAT = "dd/MM/yyyy"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_to_null(text: Column | str) -> Column:
    """An empty string holds no value."""
    return F.nullif(_col(text), F.lit(""))


def dash_to_null(text: Column | str) -> Column:
    """Any text with a dash is a "no quote" mark, negative numbers included."""
    text = _col(text)
    return F.when(~text.contains("-"), text)


def parse_decimal_comma(text: Column | str) -> Column:
    """``43,47830`` or ``43.47830`` to an exact decimal; other text is null."""
    return F.replace(_col(text), F.lit(","), F.lit(".")).try_cast(VALUE)


def parse_decimal_grouped(text: Column | str) -> Column:
    """``1.289,6300000``: dots group thousands, the comma is the decimal mark."""
    ungrouped = F.replace(_col(text), F.lit("."), F.lit(""))
    return F.replace(ungrouped, F.lit(","), F.lit(".")).try_cast(VALUE)


def parse_decimal_mixed(text: Column | str) -> Column:
    """Grouped form when there is a comma, otherwise the dot is the decimal mark."""
    text = _col(text)
    return F.when(text.contains(","), parse_decimal_grouped(text)).otherwise(parse_decimal_comma(text))


def percent_to_ratio(rate: Column | str) -> Column:
    """Exact division by 100 that keeps the value type."""
    return (_col(rate) * F.expr("0.01BD")).cast(VALUE)


def nonpositive_to_null(value: Column | str) -> Column:
    """A panel keeps positive values only."""
    value = _col(value)
    return F.when(value > 0, value)


def zero_to_null(value: Column | str) -> Column:
    """A cell that adds up to zero holds no data."""
    value = _col(value)
    return F.when(value != 0, value)


def parse_date_any(text: Column | str) -> Column:
    """``dd/MM/yyyy`` when there is a slash, otherwise ISO; other text is null."""
    text = _col(text)
    return F.when(text.contains("/"), F.try_to_date(text, DAY_FORMAT)).otherwise(
        F.try_to_date(text, "yyyy-MM-dd")
    )


def format_date(day: Column | str) -> Column:
    """The spelling dates have on the pages."""
    return F.date_format(_col(day), DAY_FORMAT)


def previous_business_day(day: Column | str) -> Column:
    """Weekends only: Monday and Sunday go back to Friday."""
    day = _col(day)
    weekday = F.weekday(day)
    back = F.when(weekday == 0, 3).when(weekday == 6, 2).otherwise(1)
    return F.date_sub(day, back)
