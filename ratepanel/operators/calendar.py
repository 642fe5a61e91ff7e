"""Calendars, grids and date rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratepanel.schemas import DATE

# A set of dates is broadcast when its calendar proves it is at most this long
# (a few MB); a longer one is left to Spark's own size check.
BROADCAST_DAYS = 200_000


def days_between(start: dt.date, end: dt.date) -> int:
    return max((end - start).days + 1, 0)


def _days(start: Column, end: Column) -> Column:
    """Array of days, empty when reversed (``sequence`` alone would count down)."""
    return F.when(start <= end, F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).otherwise(
        F.array().cast("array<date>")
    )


def calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every day from ``start`` to ``end``, both included."""
    return spark.range(1).select(F.explode(_days(F.lit(start), F.lit(end))).alias(DATE))


def calendar_of(df: DataFrame) -> DataFrame:
    """Every day between the first and last date of ``df``."""
    ends = df.agg(F.min(DATE).alias("first"), F.max(DATE).alias("last"))
    return ends.select(F.explode(_days(F.col("first"), F.col("last"))).alias(DATE))


def small_dates(dates: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Mark distinct dates of a known range for broadcast when the range is short."""
    return F.broadcast(dates) if days_between(start, end) <= BROADCAST_DAYS else dates


def grid(members: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Each member row once per day of the range."""
    return members.select(F.explode(_days(F.lit(start), F.lit(end))).alias(DATE), "*")


def densify(df: DataFrame, frame: DataFrame) -> DataFrame:
    """A row for every row of ``frame`` (days, or days with members); absent values are null."""
    return frame.join(df, frame.columns, "left")


def in_range(df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return df.where(F.col(DATE).between(F.lit(start), F.lit(end)))


def range_violation(start: Column, end: Column, today: Column) -> Column:
    """Error label of a requested range, null when it is valid."""
    return F.when(start > end, "start_after_end").when(end > today, "end_after_today")


def range_violations(requests: DataFrame, today: dt.date | Column) -> DataFrame:
    """Requests (``start_date``, ``end_date``) that break a rule, with its ``error``."""
    today = today if isinstance(today, Column) else F.lit(today)
    error = range_violation(F.col("start_date"), F.col("end_date"), today)
    return requests.withColumn("error", error).where("error is not null")


def refetch_violation(start: Column, end: Column, first: Column, last: Column) -> Column:
    """Error label of a refetch range; with one end only there is no refetch to check."""
    both = first.isNotNull() & last.isNotNull()
    return F.when(both & (first < start), "refetch_before_start").when(
        both & (last > end), "refetch_after_end"
    )


def refetch_violations(requests: DataFrame) -> DataFrame:
    """Requests whose refetch range leaves the main range."""
    error = refetch_violation(
        F.col("start_date"),
        F.col("end_date"),
        F.col("refetch_start_date"),
        F.col("refetch_end_date"),
    )
    return requests.withColumn("error", error).where("error is not null")


def check_range(
    start: dt.date, end: dt.date, today: dt.date, refetch: tuple[dt.date, dt.date] | None = None
) -> None:
    """The same rules for one request."""
    if start > end:
        raise ValueError("the start date is after the end date")
    if end > today:
        raise ValueError("the end date is after today")
    if refetch and (refetch[0] < start or refetch[1] > end):
        raise ValueError("the refetch range leaves the main range")


def snap_start(requests: DataFrame, offered: DataFrame) -> DataFrame:
    """Move a start date that is not offered to the next day.

    When there is no next day in the range the request gets an ``error``.
    """
    known = offered.select(F.col(DATE).alias("start_date"), F.lit(True).alias("_offered")).distinct()
    joined = requests.join(known, "start_date", "left")
    missing = F.col("_offered").isNull()
    room = F.col("start_date") < F.col("end_date")
    return joined.select(
        *requests.columns,
        F.when(missing & room, F.date_add("start_date", 1))
        .when(~missing, F.col("start_date"))
        .alias("snapped_start"),
        F.when(missing & ~room, "start_not_before_end").alias("error"),
    )
