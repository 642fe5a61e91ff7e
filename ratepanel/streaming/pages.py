"""New page files as a stream into a store of cells.

Each micro-batch parses its pages and writes one directory by month, named after
the batch, so a batch that is run again replaces its own output and nothing
else. Every few batches what has gathered is merged into the monthly parts of a
``sources.store``, whose manifest also tells the last batch that is in them.
Reading opens the asked months of the parts and of the batches behind them; for
a whole date of a coin the last batch wins.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ratepanel.operators.calendar import in_range
from ratepanel.operators.merge import latest_cells
from ratepanel.plans.pages import family_pages, pages_to_panel
from ratepanel.schemas import DATE, PAGES, Family
from ratepanel.sources.config import Dims
from ratepanel.sources.store import (
    MONTH,
    Manifest,
    StoreConflict,
    commit,
    delete,
    listed,
    manifest,
    month_column,
    months_between,
    read_parts,
    write_parts,
)

#: Batches that gather before they are merged.
GATHER = 20


def page_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Page files as they arrive, with the file's time and name."""
    files = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return files.select(
        "*",
        F.col("_metadata.file_modification_time").alias("loaded_at"),
        F.col("_metadata.file_path").alias("loaded_from"),
    )


def batch_cells(pages: DataFrame, dims: Dims) -> DataFrame:
    """Cells of one batch; when a date comes twice the newest file wins."""
    family = dims.family
    cells = pages_to_panel(family_pages(pages, dims), dims)
    newest = latest_cells(cells, [DATE, *family.dims], ["loaded_at", "loaded_from"], family.value)
    return newest.select(*family.columns)


def store_batch(pages: DataFrame, batch: int, store: str, dims: Dims, gather: int = GATHER) -> None:
    """Write the cells of a batch by month, and merge what has gathered every ``gather`` batches."""
    cells = batch_cells(pages, dims).withColumn(MONTH, month_column()).hint("rebalance", MONTH)
    cells.write.mode("overwrite").partitionBy(MONTH).parquet(f"{store}/batches/batch={batch}")
    if (batch + 1) % gather == 0:
        compact_store(pages.sparkSession, store, dims)


def store_pages(
    stream: DataFrame, store: str, dims: Dims, checkpoint: str, available_now: bool = False, gather: int = GATHER
) -> StreamingQuery:
    """Start storing the stream's cells under ``store``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, batch_id, store, dims, gather)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _pending(spark: SparkSession, store: str, held: Manifest, months: list[str] | None = None) -> tuple[int, dict[str, list[str]]]:
    """The last batch, and by month the folders of the batches that aren't merged; few, as they are merged now and then."""
    folder = f"{store}/batches"
    batches = sorted(int(n.split("=")[1]) for n in listed(spark, folder) if n.startswith("batch="))
    found: dict[str, list[str]] = {}
    for batch in (b for b in batches if b > held.merged):
        for name in listed(spark, f"{folder}/batch={batch}"):
            month = name.partition("=")[2]
            if name.startswith(f"{MONTH}=") and (months is None or month in months):
                found.setdefault(month, []).append(f"{folder}/batch={batch}/{name}")
    return max(batches, default=-1), found


def _latest(spark: SparkSession, store: str, family: Family, parts: DataFrame, folders: list[str]) -> DataFrame:
    """Stored cells under those of the given batches: per date and coin, the last batch wins."""
    if not folders:
        return parts.select(*family.columns)
    schema = family.panel_schema.add("batch", T.LongType()).add(MONTH, T.StringType())
    cells = spark.read.schema(schema).option("basePath", f"{store}/batches").parquet(*folders)
    last = cells.groupBy(*family.page_key).agg(F.max("batch").alias("batch"))
    newest = cells.join(last, [*family.page_key, "batch"], "left_semi").select(*family.columns)
    return parts.select(*family.columns).join(last, family.page_key, "left_anti").unionByName(newest)


def read_store(spark: SparkSession, store: str, dims: Dims, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """The panel a store stands for; with a range, only the folders of its months are opened."""
    ranged = start is not None and end is not None
    held, family = manifest(spark, store), dims.family
    _, found = _pending(spark, store, held, months_between(start, end) if ranged else None)
    panel = _latest(spark, store, family, read_parts(spark, store, family, held, start, end), [f for own in found.values() for f in own])
    return in_range(panel, start, end) if ranged else panel


def compact_store(spark: SparkSession, store: str, dims: Dims) -> Manifest:
    """Merge the batches that have gathered into the parts of their months; other months stay where they are.

    Folders of merged batches go with the next merge, so that a reader of the
    version before still finds them.
    """
    held, family = manifest(spark, store), dims.family
    last, found = _pending(spark, store, held)
    if last <= held.merged:
        return held
    own = Manifest(held.version, {m: w for m, w in held.parts.items() if m in found})
    folders = [f for months in found.values() for f in months]
    parts = write_parts(_latest(spark, store, family, read_parts(spark, store, family, own), folders), store, family) if found else {}
    try:
        new = commit(spark, store, held, parts, sorted(found), merged=last)
    except StoreConflict:
        # Another merge was first; what it left is for the next one.
        return manifest(spark, store)
    for name in listed(spark, f"{store}/batches"):
        if name.startswith("batch=") and int(name.split("=")[1]) <= held.merged:
            delete(spark, f"{store}/batches/{name}")
    return new
