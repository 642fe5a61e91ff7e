"""Panel to the published daily series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ratepanel.operators.calendar import calendar, densify, in_range
from ratepanel.operators.reshape import (
    by_member,
    keep_columns,
    panel_to_fx,
    panel_to_rates,
    panel_to_sml,
    pivot_sum,
)
from ratepanel.functions.titles import compose_title
from ratepanel.sources.config import Dims


def wide_series(panel: DataFrame, dims: Dims, member: str | None = None) -> DataFrame:
    """Series of one member, configured columns only, stored dates only."""
    family = dims.family
    match family.name:
        case "libor":
            return panel_to_rates(panel, dims.rates)
        case "exchange-rates":
            return panel_to_fx(panel, member, dims.series())
        case "sml":
            return panel_to_sml(panel, member, dims.series(member))
        case _:
            titles = {t: t for t in dims.series(member)}
            one = by_member(panel, family.member, member)
            return pivot_sum(one, compose_title(family), titles, family.value)


def daily_series(
    panel: DataFrame, dims: Dims, start: dt.date, end: dt.date, member: str | None = None
) -> DataFrame:
    """``wide_series`` with one row for every day of the range, in header order."""
    wide = wide_series(in_range(panel, start, end), dims, member)
    days = calendar(panel.sparkSession, start, end)
    return keep_columns(densify(wide, days), dims.header(member))
