"""One incremental run: trim, find misses, parse, merge, refetch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratepanel.functions.html import named_text, visible
from ratepanel.functions.normalize import DAY_FORMAT
from ratepanel.functions.sql import rows, text
from ratepanel.operators.calendar import check_range, in_range, small_dates, snap_start
from ratepanel.operators.extract import offered_coins
from ratepanel.operators.merge import append_new, date_has_data, upsert_by_date
from ratepanel.plans.pages import pages_to_panel
from ratepanel.schemas import DATE, VALUE
from ratepanel.sources.config import Dims
from ratepanel.sources.panel import empty_panel
from ratepanel.sources.store import (
    StoreConflict,
    commit,
    manifest,
    month_column,
    month_of,
    months_between,
    read_parts,
    write_parts,
)

#: How often a run is computed anew when another one has changed the same months.
TRIES = 5


@dataclass(frozen=True)
class Days:
    """What a run does with each of its days; at most one entry per day of its ranges."""

    misses: tuple[dt.date, ...]
    again: tuple[dt.date, ...]
    trimmed: tuple[dt.date, ...]

    @property
    def wanted(self) -> list[dt.date]:
        return sorted({*self.misses, *self.again})

    @property
    def touched(self) -> list[dt.date]:
        return sorted({*self.wanted, *self.trimmed})


@dataclass(frozen=True)
class Run:
    """``panel`` is everything stored after the run, ``published`` the asked dates of it."""

    panel: DataFrame
    published: DataFrame
    days: Days


def _span(start: dt.date, end: dt.date) -> list[dt.date]:
    return [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]


def plan_days(
    states: Mapping[dt.date, bool], start: dt.date, end: dt.date, refetch: tuple[dt.date, dt.date] | None = None, skip_trim: bool = False
) -> Days:
    """Misses, days to load again and days to trim, all out of one table of stored days.

    ``states`` says of each stored day whether it has data. Days of the range
    after its last one with data are trimmed, and so are misses; the refetch
    range ends at the last day that was not trimmed.
    """
    last = max((d for d, full in states.items() if full and start <= d <= end), default=dt.date.min)
    trimmed = set() if skip_trim else {d for d in states if last < d and start <= d <= end}
    misses = [d for d in _span(start, end) if d not in states or d in trimmed]
    again: list[dt.date] = []
    if refetch:
        again = _span(*refetch)
        # Not below the day before both ranges, which no run trims.
        floor = min(start, refetch[1]) - dt.timedelta(days=1)
        until = max(d for d in _span(floor, refetch[1]) if d not in trimmed)
        again = [d for d in again if d <= until]
    return Days(tuple(misses), tuple(again), tuple(sorted(trimmed)))


def stored_states(panel: DataFrame, first: dt.date, last: dt.date, value: str) -> dict[dt.date, bool]:
    """Each stored day of a range and whether it has data: one aggregate, one row per day."""
    return {r[DATE]: r.has_data for r in date_has_data(in_range(panel, first, last), value).collect()}


def _dates(spark: SparkSession, days: Iterable[dt.date]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in days], f"{DATE} date")


def _blank_cells(days: DataFrame, pages: DataFrame, dims: Dims) -> DataFrame:
    """Null cells for the days (of a coin) without any page."""
    family = dims.family
    coins = ", ".join(text(c) for c in dims.page_coins)
    expected = days.selectExpr(DATE, f"explode(array({coins})) AS coin")
    present = pages.select(*(c for c in expected.columns if family.page_dim or c == DATE)).distinct()
    absent = expected.join(present, present.columns, "left_anti")
    listed: dict[str, list[dict[str, str]]] = {}
    for m in dims.members():
        own = dict(zip(family.dims, m, strict=True))
        listed.setdefault(own.get(family.page_dim, ""), []).append({f"_{d}": v for d, v in own.items()})
    # Each coin's own members, looked up in a constant map.
    by_coin = ", ".join(f"{text(coin)}, {rows(its)}" for coin, its in listed.items())
    cells = absent.selectExpr(DATE, f"inline(try_element_at(map({by_coin}), coalesce(coin, '')))")
    renamed = [f"_{d} AS {d}" for d in family.dims]
    return cells.selectExpr(DATE, *renamed, f"CAST(NULL AS {VALUE.simpleString()}) AS {family.value}")


def incremental_run(
    pages: DataFrame,
    panel: DataFrame | None,
    dims: Dims,
    start: dt.date,
    end: dt.date,
    refetch: tuple[dt.date, dt.date] | None = None,
    skip_panel: bool = False,
    skip_trim: bool = False,
) -> Run:
    """Bring the panel up to date for a range of days.

    ``pages`` holds the family's pages, one per date (and coin). Days that are
    stored already are not parsed, except those of the refetch range, whose
    pages replace what is stored. A day that is loaded for the first time gets
    its full set of cells, null where there is no page or no value.
    """
    family = dims.family
    spark = pages.sparkSession
    first = min(start, refetch[0]) if refetch else start
    last = max(end, refetch[1]) if refetch else end

    # Dates outside the range pass by untouched: only those inside it are joined.
    held = empty_panel(spark, family) if skip_panel or panel is None else panel
    stored = in_range(held, first, last)
    outside = held.where(~F.coalesce(F.col(DATE).between(F.lit(first), F.lit(last)), F.lit(False)))
    states = {} if skip_panel or panel is None else stored_states(held, first, last, family.value)
    days = plan_days(states, start, end, refetch, skip_trim)
    # What is trimmed is all that is stored from its first day to the range's end.
    gone = F.col(DATE).between(F.lit(days.trimmed[0]), F.lit(end)) if days.trimmed else F.lit(False)
    base = stored.where(~F.coalesce(gone, F.lit(False)))

    # Both passes read their pages in one scan: a page of either is parsed once.
    offered = in_range(pages, first, last)
    if family.page_dim:
        offered = offered.where(F.col("coin").isin(list(dims.coins)))
    chosen = offered.join(small_dates(_dates(spark, days.wanted), first, last), DATE, "left_semi")
    parsed = pages_to_panel(chosen, dims)
    new = append_new(parsed.select(*family.columns), _blank_cells(_dates(spark, days.misses), offered, dims))

    # The keys come from the page table, whose HTML need not be read for them.
    replaced = chosen.withColumnRenamed("coin", family.page_dim or "coin")
    merged = upsert_by_date(base.select(*family.columns), new, family.page_key, replaced)
    return Run(append_new(outside.select(*family.columns), merged), in_range(merged, start, end), days)


def offered_start(form: DataFrame, start: dt.date, end: dt.date, field: str) -> dt.date:
    """The start of a run, moved by a day when the form's list of dates (``field``) lacks it."""
    written = f"regexp_extract_all({named_text(visible('html'), field)}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}', 0)"
    days = form.selectExpr(f"explode({written}) AS day").selectExpr(f"try_to_date(day, {text(DAY_FORMAT)}) AS {DATE}")
    request = form.sparkSession.createDataFrame([(start, end)], "start_date date, end_date date")
    row = snap_start(request, days).first()
    if row.error:
        raise ValueError("the start date isn't offered and is the end date")
    return row.snapped_start


def offered_dims(form: DataFrame, dims: Dims) -> Dims:
    """The configuration without the coins that the form doesn't offer."""
    if not dims.family.page_dim:
        return dims
    there = {r.key for r in offered_coins(form, dims.coins).select("key").distinct().collect()}
    return dims.only({c: label for c, label in dims.coins.items() if c in there})


def update_store(
    pages: DataFrame,
    root: str,
    dims: Dims,
    start: dt.date,
    end: dt.date,
    refetch: tuple[dt.date, dt.date] | None = None,
    skip_panel: bool = False,
    skip_trim: bool = False,
    today: dt.date | None = None,
    form: DataFrame | None = None,
) -> DataFrame:
    """``incremental_run`` on a stored panel; returns its asked dates after the run.

    The ranges are checked first. Only the months of the range are read, and
    only those whose days were loaded or trimmed are written again; with
    ``skip_panel`` nothing is, and the store stays as it is. When another run
    has changed the same months meanwhile, this one starts again from theirs.

    ``form`` is the source's page of dates and coins, one row with its ``html``:
    a start that it doesn't offer moves by a day, where the family's form lists
    days, and pages of coins that it doesn't offer aren't read.
    """
    check_range(start, end, today or dt.date.today(), refetch)
    spark, family = pages.sparkSession, dims.family
    if form is not None:
        if family.form_dates:
            start = offered_start(form, start, end, family.form_dates)
        pages = pages.where(F.col("coin").isin(list(offered_dims(form, dims).coins))) if family.page_dim else pages
    if skip_panel:
        return incremental_run(pages, None, dims, start, end, refetch, skip_panel=True, skip_trim=skip_trim).published
    first = min(start, refetch[0]) if refetch else start
    last = max(end, refetch[1]) if refetch else end
    for attempt in range(TRIES):
        base = manifest(spark, root)
        held = {m: base.parts[m] for m in months_between(first, last) if m in base.parts}
        stored = read_parts(spark, root, family, type(base)(base.version, held))
        run = incremental_run(pages, stored, dims, start, end, refetch, skip_trim=skip_trim)
        months = sorted({month_of(d) for d in run.days.touched})
        if not months:
            break
        parts = write_parts(run.panel.where(month_column().isin(months)), root, family)
        try:
            base = commit(spark, root, base, parts, months)
            break
        except StoreConflict:
            if attempt == TRIES - 1:
                raise
    return read_parts(spark, root, family, base, start, end)
