"""Pages to parse, from tables or from HTML files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratepanel.schemas import PAGES

# .../{source}/{coin}/{yyyy-MM-dd}.html
FILE_NAME = r"([^/]+)/([^/]+)/(\d{4}-\d{2}-\d{2})\.html$"


def load_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages stored as a Parquet table."""
    return spark.read.schema(PAGES).parquet(path)


def load_page_files(
    spark: SparkSession, path: str, name: str = FILE_NAME, files: str = "*.html"
) -> DataFrame:
    """One page per file; source, coin and date come from the file's path."""
    texts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", files).text(
        path, wholetext=True
    )
    where = F.col("_metadata.file_path")
    part = lambda i: F.regexp_extract(where, name, i)
    return texts.select(
        part(1).alias("source"),
        F.url_decode(part(2)).alias("coin"),
        F.try_to_date(part(3), "yyyy-MM-dd").alias("indice_tiempo"),
        F.col("value").alias("html"),
    )
