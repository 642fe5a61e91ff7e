"""Column helpers that all operators of this package share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratepanel.sources.shared import fresh_path, shared_folder


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="ratepanel-")) / "ratepanel.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, for operators that run this package's code in tasks."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows, written to the checkpoint folder that all executors share."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written as a table in the folder that all executors share."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_where(df: DataFrame, verdict: Column, field: str) -> DataFrame:
    """Rows for which a struct verdict, computed once, has a true field; columns as before."""
    name = fresh(df, "verdict")
    return df.withColumn(name, verdict).where(F.col(f"`{name}`.`{field}`")).drop(name)


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts, for sizing the parts of a shuffle."""
    return df.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
