"""Imaging index and image metadata tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions import clean
from cohortloom.spec import IMAGING_SENTINELS


def clean_index(raw: DataFrame) -> DataFrame:
    """Sentinels to null and person number to integer; other columns pass."""
    rules = {c: clean.sentinel_to_null(c) for c in IMAGING_SENTINELS if c in raw.columns}
    return raw.withColumns({**rules, "person_id": clean.to_nullable_int("person_id")})


def read_imaging_index(spark: SparkSession, path: str) -> DataFrame:
    return clean_index(spark.read.parquet(path))


def read_all_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Every parquet file below a folder, united by column name; missing columns are null."""
    return spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(folder)


def read_meta_csvs(spark: SparkSession, folder: str) -> DataFrame:
    """Every CSV below a folder, as strings."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .option("header", True)
        .csv(folder)
    )


def study_ids_from_log(spark: SparkSession, path: str) -> DataFrame:
    """Fifth blank-separated token of every log line."""
    return spark.read.text(path).select(F.get(F.split("value", " "), F.lit(4)).alias("study_id"))
