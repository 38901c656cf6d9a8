"""Session settings, shared scratch folders and durable intermediate tables."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from cohortloom.sources import store

_owned: ContextVar[list[str] | None] = ContextVar("owned scratch", default=None)


#: Settings that the operators are written for and that a running session can take on.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM never compiles methods above 8000 bytes; wide projections are split instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "cohortloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config(map=SETTINGS).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def wide_rows(spark: SparkSession) -> SparkSession:
    """Let a session made elsewhere compile wide projections in parts, unless it has its own limit.

    Interpreted, the raw texts of a table and its typing rules take two to three times as long.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, None) in (None, "65535"):  # Spark's default
        spark.conf.set(key, SETTINGS[key])
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can see: the checkpoint folder, or the warehouse where none is named.

    A cluster's warehouse is shared by definition, so no machine-local folder is ever used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return root or spark.conf.get("spark.sql.warehouse.dir")


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_root(spark)}/cohortloom/{label}-{uuid.uuid4().hex}"
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    return path


@contextmanager
def staging(spark: SparkSession):
    """Own all scratch tables named inside: they go at the end, also after a failure.

    What is computed from them has to be written or collected before.  Inside another `staging` the inner
    one removes its own.
    """
    paths: list[str] = []
    token = _owned.set(paths)
    try:
        yield
    finally:
        _owned.reset(token)
        for path in paths:
            spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
            store.remove(spark, path)


def durable(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write the frame to the shared folder and read it back; `staging` says how long it stays.

    The written table cuts the lineage, survives executor loss and guarantees that
    several consumers see the same rows; being parquet it still prunes columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _table_name(path: str) -> str:
    return "cohortloom_" + path.rsplit("-", 1)[-1]


def durable_by(df: DataFrame, key: str, label: str = "stage", buckets: int | None = None, grouped: bool = False) -> DataFrame:
    """`durable`, dealt into buckets by a key, so that joins and groupings by it need no exchange of the table.

    By default there are as many buckets as a join would make partitions.  Rows of one key lie in one bucket
    file: for tables whose key is unique, or has few rows by construction.  `grouped` says that the last exchange of
    the frame was by this key; it is written in that partitioning, not exchanged again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (df if grouped else df.repartition(buckets, key)).write.bucketBy(buckets, key).sortBy(key)
    dealt.option("path", path).format("parquet").saveAsTable(_table_name(path))
    return spark.table(_table_name(path))
