"""Wide series CSV files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratepanel.schemas import DATE, VALUE


def write_series(series: DataFrame, header: Sequence[str], path: str) -> None:
    """Write the header's columns by date; a column the series lacks gives empty cells."""
    present = set(series.columns)
    columns = [F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in header]
    series.select(*columns).orderBy(DATE).write.mode("overwrite").option("header", True).csv(path)


def read_series(spark: SparkSession, path: str, header: Sequence[str] | None = None) -> DataFrame:
    """Scan a series CSV; with a header its columns are read as exact decimals."""
    raw = spark.read.option("header", True).csv(path)
    if header is None:
        return raw
    # By the names in the file; its order doesn't matter.
    return raw.select(*[F.col(f"`{c}`").cast("date" if c == DATE else VALUE).alias(c) for c in header])
