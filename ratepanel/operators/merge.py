"""The panel as a store: hits, trimming, replacing and appending dates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratepanel.operators.calendar import calendar, in_range, small_dates
from ratepanel.schemas import DATE


def has_data(value: Column | str) -> Column:
    """A value that is neither missing nor zero."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(value != 0, F.lit(False))


def date_has_data(panel: DataFrame, value: str) -> DataFrame:
    """Per stored date, whether any coin and column has data."""
    return panel.groupBy(DATE).agg(F.bool_or(has_data(value)).alias("has_data"))


def last_date_with_data(panel: DataFrame, start: dt.date, end: dt.date, value: str) -> DataFrame:
    """Newest date of the range that has data: one row, null when there is none."""
    return in_range(panel, start, end).where(has_data(value)).agg(F.max(DATE).alias("last_date"))


def _is_trailing(panel: DataFrame, start: dt.date, end: dt.date, value: str) -> Column:
    last = last_date_with_data(panel, start, end, value).scalar()
    inside = F.col(DATE).between(F.lit(start), F.lit(end))
    return inside & (F.col(DATE) > F.coalesce(last, F.date_sub(F.lit(start), 1)))


def trailing_dates(panel: DataFrame, start: dt.date, end: dt.date, value: str) -> DataFrame:
    """Stored dates of the range that come after its last date with data."""
    return panel.where(_is_trailing(panel, start, end, value)).select(DATE).distinct()


def trim_trailing_empty(panel: DataFrame, start: dt.date, end: dt.date, value: str) -> DataFrame:
    """The panel without the range's trailing dates that have no data."""
    return panel.where(~F.coalesce(_is_trailing(panel, start, end, value), F.lit(False)))


def shrink_refetch_end(trailing: DataFrame, start: dt.date, refetch_end: dt.date) -> DataFrame:
    """Newest date up to ``refetch_end`` that was not trimmed: one row.

    Works on the set of trimmed dates, at most one row per day of the range.
    """
    spark = trailing.sparkSession
    before = min(start, refetch_end) - dt.timedelta(days=1)
    days = calendar(spark, before, refetch_end)
    kept = days.join(small_dates(in_range(trailing, before, refetch_end), before, refetch_end), DATE, "left_anti")
    return kept.agg(F.max(DATE).alias("refetch_end"))


def stored_dates(panel: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Distinct dates of the range that the panel holds, for any coin."""
    return small_dates(in_range(panel, start, end).select(DATE).distinct(), start, end)


def panel_hits(panel: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Days of the range that are stored."""
    days = calendar(panel.sparkSession, start, end)
    return days.join(stored_dates(panel, start, end), DATE, "left_semi")


def not_loaded(days: DataFrame, loaded: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Days that an earlier pass did not load for any coin."""
    return days.join(stored_dates(loaded, start, end), DATE, "left_anti")


def dates_to_load(
    panel: DataFrame, start: dt.date, end: dt.date, loaded: DataFrame | None = None
) -> DataFrame:
    """Days of the range that are neither stored nor loaded in an earlier pass."""
    days = calendar(panel.sparkSession, start, end)
    days = days.join(stored_dates(panel, start, end), DATE, "left_anti")
    return days if loaded is None else not_loaded(days, loaded, start, end)


def append_new(base: DataFrame, new: DataFrame) -> DataFrame:
    """Add freshly parsed dates to the panel."""
    return base.unionByName(new)


def upsert_by_date(
    base: DataFrame, new: DataFrame, keys: Sequence[str], replaced: DataFrame | None = None
) -> DataFrame:
    """Whole dates (of a coin) in ``new`` replace those in ``base``.

    Only distinct keys meet the base, so a date with very many rows is reduced
    before the join and its base side may be split by AQE. ``replaced`` gives
    the keys where they are cheaper to have than out of ``new``.
    """
    gone = (new if replaced is None else replaced).select(*keys).distinct()
    return append_new(base.join(gone, list(keys), "left_anti"), new)


def latest_cells(cells: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """One row per cell: the one that comes last in ``order``, null values included.

    A page always yields its full set of cells, so this is "the last page wins".
    Cells combine before the shuffle; the pages themselves never move.
    """
    newest = F.max(F.struct(*order, value)).alias("_last")
    return cells.groupBy(*keys).agg(newest).select(*keys, F.col(f"_last.{value}").alias(value))
