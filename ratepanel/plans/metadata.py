"""Catalogue records of published series."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratepanel.functions.titles import ISO_CODES, iso_code, series_description, series_id, split_title
from ratepanel.schemas import DATE


def series_metadata(
    titles: DataFrame, entities: DataFrame, codes: Mapping[str, str] = ISO_CODES
) -> DataFrame:
    """``field_title``, ``field_description``, ``field_id`` of each quote title, and of the date.

    ``titles`` has ``title``, ``entities`` has ``key`` and ``title``.
    """
    named = titles.select("title", split_title("title", 7).alias("_p"))
    parts = named.select(
        F.col("title").alias("field_title"),
        iso_code(F.col("_p")[2], codes).alias("_iso"),
        F.col("_p")[3].alias("_entity"),
        *[F.col("_p")[i].alias(n) for i, n in ((4, "_channel"), (5, "_flow"), (6, "_hour"))],
    )
    names = entities.select(F.col("key").alias("_entity"), F.col("title").alias("_name"))
    channel, flow, hour = F.col("_channel"), F.col("_flow"), F.col("_hour")
    fields = parts.join(names, "_entity", "left").select(
        "field_title",
        series_description(F.col("_iso"), F.col("_name"), channel, flow, hour).alias("field_description"),
        series_id(F.col("_iso"), F.col("_entity"), channel, flow, hour).alias("field_id"),
    )
    date_field = {"field_title": [DATE], "field_description": ["Indice de tiempo."], "field_id": [""]}
    return fields.unionByName(titles.sparkSession.createDataFrame(pa.table(date_field)))
