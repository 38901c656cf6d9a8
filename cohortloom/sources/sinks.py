"""Writers: materialised tables, CSV exports, patch appends, progress files, sealed mapping."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions.clean import valid_email
from cohortloom.sources import versions


def materialise(df: DataFrame, path: str, refresh: bool = False, keep: int = versions.KEPT) -> DataFrame:
    """Write a table if it is not there yet (or always with `refresh`) and read its last version back.

    Only a finished write counts as being there; until one is, and where it fails, readers keep the version
    before.  The last `keep` versions stay.
    """
    spark = df.sparkSession
    if refresh or not versions.commits(spark, path):
        versions.write_version(df, path)
        versions.vacuum(spark, path, keep)
    return spark.read.schema(df.schema).parquet(versions.data_folder(spark, path))


def export_csv(df: DataFrame, path: str, gzip: bool = False) -> None:
    """CSV with header; nested columns stay behind.  An earlier export is replaced."""
    flat = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    writer = df.select(*[F.col(f"`{c}`") for c in flat]).write.mode("overwrite").option("header", True)
    (writer.option("compression", "gzip") if gzip else writer).csv(path)


def export_emails(mails: DataFrame, path: str) -> None:
    """Valid addresses only.  An earlier export is replaced."""
    mails.select(valid_email("email").alias("email")).dropna().write.mode("overwrite").option("header", True).csv(path)


def append_patch(rows: DataFrame, path: str, batch_size: int) -> None:
    """Append rows, at most `batch_size` per file, each file with its header."""
    rows.write.mode("append").option("header", True).option("maxRecordsPerFile", batch_size).csv(path)


def write_progress(progress: DataFrame, folder: str) -> None:
    """One folder per worker, `worker=<n>/…json` with uploaded and total."""
    progress.select("worker", "uploaded", "total").repartition("worker").write.mode("overwrite").partitionBy(
        "worker"
    ).json(folder)


class BrokenSeal(ValueError):
    pass


def table_checksum(df: DataFrame, columns: list[str]) -> tuple[int, str]:
    """Row count and an order-free checksum over the columns."""
    total = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    row = df.agg(F.count("*").alias("n"), total.alias("s")).first()
    return row.n, str(row.s)


def seal_mapping(mapping: DataFrame, path: str, key: bytes) -> tuple[int, str]:
    """Write an encrypted copy of the mapping, row by row; returns the checksum to keep.

    AES-GCM with a random nonce for every row: nothing about a row can be read or guessed from the
    copy, and a changed row does not open.  The key travels to the tasks in a broadcast and is in no
    plan.
    """
    columns = ["id_bci", "id_random"]
    payload = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary")
    rows = _beside_key(mapping.select(payload.alias("payload")), key)
    rows.select(F.aes_encrypt("payload", "_key", F.lit("GCM")).alias("payload")).write.mode("overwrite").parquet(path)
    return table_checksum(mapping, columns)


def open_mapping(spark: SparkSession, path: str, key: bytes, checksum: tuple[int, str]) -> DataFrame:
    """Decrypt the copy; a row that was changed does not open, a table with other rows is refused."""
    text = F.aes_decrypt("payload", "_key", F.lit("GCM")).cast("string")
    rows = _beside_key(spark.read.parquet(path), key)
    mapping = rows.select(F.from_json(text, "id_bci bigint, id_random bigint").alias("m")).select("m.*")
    if table_checksum(mapping, ["id_bci", "id_random"]) != tuple(checksum):
        raise BrokenSeal(f"{path} is not the expected mapping table")
    return mapping


def _beside_key(rows: DataFrame, key: bytes) -> DataFrame:
    """The rows with the key as column `_key`, handed to the tasks as a broadcast value."""
    shared = rows.sparkSession.sparkContext.broadcast(key)

    def secret(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([shared.value] * batch.num_rows, pa.binary())], names=["_key"])

    one = rows.sparkSession.range(1).mapInArrow(secret, "_key binary")
    return rows.crossJoin(F.broadcast(one))  # one row
