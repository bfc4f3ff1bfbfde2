"""What the operators of this subpackage share: table reading and the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.sources.scratch import fs_path, scratch, stored

__all__ = ["WS", "fs_path", "scratch", "stored", "table", "words"]

#: Separators of words: the ASCII white space of the contracts.
WS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text in order; none for null or blank texts."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WS, -1), "")
