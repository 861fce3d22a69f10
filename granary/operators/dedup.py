"""Deduplication by key with a stated survivor; null keys are equal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def keep_one(rows: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    place = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("__place", F.row_number().over(place)).where("__place = 1").drop("__place")


def keep_first(rows: DataFrame, key: list[str], position: str) -> DataFrame:
    """The row of each key that comes first in its file."""
    return keep_one(rows, key, F.col(position))


def keep_latest(rows: DataFrame, key: list[str]) -> DataFrame:
    """The newest published version of each key: by ingestion date, then file time, then run."""
    return keep_one(rows, key, F.col("ingestion_date").desc_nulls_last(), F.col("_modified").desc_nulls_last(), F.col("run_id").desc_nulls_last())


def duplicates(key: list[str]) -> Column:
    """An aggregate: rows beyond the first of their key. Alone, on the key's columns: beside others it shuffles their state for each key."""
    return F.count("*") - F.count_distinct(F.struct(*key))
