"""Dumps of parsed rows: ``{"parsed": [{...}, ...]}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parsed_json(
    spark: SparkSession, path: str, record: T.StructType | None = None
) -> DataFrame:
    """Wide records, one row each. A dump is one JSON document, so the unit of work is a file."""
    reader = spark.read.option("multiLine", True)
    if record is not None:
        reader = reader.schema(T.StructType([T.StructField("parsed", T.ArrayType(record))]))
    return reader.json(path).select(F.inline("parsed"))


def read_ragged(spark: SparkSession, path: str) -> DataFrame:
    """``record map<string,string>``: the records of dumps as they are, of whatever width, without looking for a schema."""
    dumps = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", "parsed ARRAY<MAP<STRING, STRING>>")
    return dumps.select(F.explode(parsed["parsed"]).alias("record"))
