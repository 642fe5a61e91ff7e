"""Panels: long CSV files, and versioned Parquet snapshots by month."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratepanel.schemas import Family
from ratepanel.sources.store import Manifest, commit, manifest, read_parts, write_parts


def empty_panel(spark: SparkSession, family: Family) -> DataFrame:
    return spark.createDataFrame([], family.panel_schema)


def read_panel(spark: SparkSession, path: str, family: Family) -> DataFrame:
    """Typed scan of a panel CSV: an empty value is null, others are exact decimals."""
    raw = spark.read.option("header", True).csv(path)
    # By the names in the header; the file's order doesn't matter.
    return raw.select(*[F.nullif(F.col(f.name), F.lit("")).cast(f.dataType).alias(f.name) for f in family.panel_schema])


def _or_none(read):
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_panel_or_empty(spark: SparkSession, path: str, family: Family) -> DataFrame:
    """A panel CSV, or an empty panel when there is no such file."""
    found = _or_none(lambda: read_panel(spark, path, family))
    return empty_panel(spark, family) if found is None else found


def write_panel(panel: DataFrame, path: str, family: Family) -> None:
    """Write the whole long panel as CSV. ``path`` must not be one the panel is read from."""
    panel.select(*family.columns).write.mode("overwrite").option("header", True).csv(path)


def write_snapshot(panel: DataFrame, root: str, family: Family, months: Iterable[str] | None = None, base: Manifest | None = None) -> Manifest:
    """Write a new version of the whole panel, or of the given months only.

    Other months stay where they are, and the version counts only when all of it
    is written, so the panel may be computed from the store itself and a run that
    dies can be repeated. ``base`` is the version that it was computed from.
    """
    spark = panel.sparkSession
    base = manifest(spark, root) if base is None else base
    return commit(spark, root, base, write_parts(panel, root, family), months)


def read_snapshot(
    spark: SparkSession, root: str, family: Family, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """The stored panel, or an empty one; a date range opens the files of its months only."""
    return read_parts(spark, root, family, manifest(spark, root), start, end)
