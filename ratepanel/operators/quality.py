"""Coverage checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratepanel.functions.sql import name, struct, text
from ratepanel.operators.reshape import columns_except
from ratepanel.schemas import DATE


def null_series(panel: DataFrame, title: Column, value: str) -> DataFrame:
    """Series of a long panel in which every value is null."""
    counted = panel.groupBy(title.alias("series")).agg(F.count(value).alias("_n"))
    return counted.where("_n = 0").select("series")


def null_columns(series: DataFrame) -> DataFrame:
    """Columns of a wide table in which every value is null, found in one pass."""
    counts = ", ".join(
        struct({"series": text(c), "_n": f"count({name(c)})"}) for c in columns_except(series)
    )
    long = series.agg(F.expr(f"array({counts})").alias("_counts")).selectExpr("inline(_counts)")
    return long.where("_n = 0").select("series")


def coverage(panel: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows and values per group, the group with most dates first."""
    counted = panel.groupBy(*keys).agg(F.count(DATE).alias("n_rows"), F.count(value).alias("n_values"))
    return counted.orderBy(F.desc("n_rows"), *keys)


def cell_count(series: DataFrame) -> DataFrame:
    """Rows, columns and cells of a wide table: one row."""
    width = len(columns_except(series))
    return series.agg(
        F.count("*").alias("n_rows"),
        F.lit(width).cast("long").alias("n_columns"),
        (F.count("*") * width).alias("n_cells"),
    )


def value_count(records: DataFrame, record: str = "record") -> DataFrame:
    """Records, values in all of them (nulls included) and the widest one's: one row."""
    width = F.size(F.coalesce(F.col(record), F.expr("map()").cast("map<string,string>")))
    return records.agg(
        F.count("*").alias("n_records"),
        F.coalesce(F.sum(width), F.lit(0)).alias("n_values"),
        F.coalesce(F.max(width), F.lit(0)).cast("long").alias("most_values"),
    )
