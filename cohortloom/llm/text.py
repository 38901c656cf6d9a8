"""Shared helpers: whole texts as bytes inside Arrow tasks, carried columns, bounded pieces."""

from __future__ import annotations

import contextlib
import ctypes
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that a task works on at once; its arrays are a small multiple of this.
PIECE_BYTES = 1 << 19
#: Bytes of an Arrow batch between Spark and a task's Python worker.
BATCH_BYTES = 4 << 20


def held(df: DataFrame) -> DataFrame:
    """Keep an intermediate table on the executors' disks, in the partitioning it has.

    What a lost executor held is computed again from its inputs; where that would be long, a written
    table (`durable`) cuts it off.  The session frees it with the cache.
    """
    df.sparkSession.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "false")
    return df.persist(StorageLevel.DISK_ONLY)


def few_files(df: DataFrame) -> DataFrame:
    """An eighth of the session's shuffle partitions, or one for each core if that is more.

    For narrow tables that are written as they are: their files follow the size of the job, not of
    every shuffle in it.
    """
    spark = df.sparkSession
    return df.coalesce(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8))


def small_batches(spark) -> None:
    """Arrow batches of BATCH_BYTES at most in this session: texts are wide, the default is meant for narrow rows."""
    for key, most in (("maxBytesPerBatch", BATCH_BYTES), ("maxRecordsPerBatch", 5000)):
        spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def utf8(column: pa.Array) -> list[bytes | None]:
    """Texts as UTF-8 bytes; null stays None."""
    return column.cast(pa.binary()).to_pylist()


def parts(batches, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Record batches in parts of few rows, so few texts at a time become Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back()


def give_back() -> None:
    """Hand freed memory back to the system: a Python worker lives on after its task and serves others."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # no such call outside glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def gathered(batches, limit: int) -> Iterator[pa.RecordBatch]:
    """Record batches put together until they have about `limit` bytes."""
    kept, size = [], 0
    for batch in batches:
        kept.append(batch)
        size += batch.nbytes
        if size >= limit:
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
            kept, size = [], 0
    if kept:
        yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
    kept.clear()
    give_back()


def pieces(texts: list[bytes], limit: int = PIECE_BYTES) -> Iterator[slice]:
    """Slices of neighbouring texts with about `limit` bytes; a longer text makes a piece alone."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def carried(df: DataFrame, carry: list[str] | None, text: str = "text") -> DataFrame:
    """`row`, a struct of the carried columns (all by default), and `text`: other names cannot clash."""
    small_batches(df.sparkSession)
    kept = F.struct(*[F.col(f"`{c}`") for c in (df.columns if carry is None else carry)])
    return df.select(kept.alias("row"), F.col(f"`{text}`").cast("string").alias("text"))


def map_texts(
    df: DataFrame,
    fields: list[tuple[str, T.DataType]],
    start: Callable[[], Callable[[list[bytes | None]], list]],
    text: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """`row` with the carried columns, and the new fields computed from each whole text.

    `start` runs once in a task and gives a function from a list of UTF-8 texts to one list or
    array for each field.
    """
    slim = carried(df, carry, text)
    schema = T.StructType([slim.schema["row"], *[T.StructField(n, t) for n, t in fields]])
    kinds = [_arrow(t) for _, t in fields]
    names = ["row", *[n for n, _ in fields]]

    def run(batches):
        work = start()
        for batch in parts(batches):
            made = work(utf8(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, k) for x, k in zip(made, kinds)]], names=names)

    return slim.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def share_by_hash(place, wanted: int, there: int):
    """Condition that about a third more than `wanted` of `there` rows meet, by their hash `place`.

    In front of a limit it keeps small what tasks send, however many there are.
    """
    share = min(1.0, (1.35 * wanted + 50) / max(1, there))
    return F.pmod(F.xxhash64(place, F.lit("share")), F.lit(1 << 30)) < int(share * (1 << 30)) + 1


def excerpt(text: bytes, most: int, chunk: int = 1024) -> bytes:
    """The text, or if it is longer than `most` bytes, chunks of whole characters chosen by a hash from all of it, in order."""
    if len(text) <= most:
        return text
    chunk, cuts = max(4, min(chunk, most)), [0]
    while cuts[-1] < len(text):
        at = min(len(text), cuts[-1] + chunk)
        while at < len(text) and text[at] & 0xC0 == 0x80 and at > cuts[-1] + 1:
            at -= 1
        cuts.append(at)
    sizes = np.diff(cuts)
    places = np.array([zlib.crc32(text[a:b], k) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))], np.uint64)
    order = np.argsort(mix(places), kind="stable")
    chosen = np.sort(order[np.cumsum(sizes[order]) <= most])
    return b"".join(text[cuts[k] : cuts[k + 1]] for k in chosen)


def level(lengths: list[int], most: int) -> int:
    """The largest length to which texts of these lengths can be bounded so that together they have at most `most`."""
    left = most
    for k, n in enumerate(sorted(lengths)):
        if n * (len(lengths) - k) > left:
            return left // (len(lengths) - k)
        left -= n
    return max(lengths, default=0)


def bounded_rows(rows: DataFrame, kind: str, most: int, order: list[str]) -> list[tuple]:
    """A sample of few rows as (kind, UTF-8 text) in the given order; the texts of a kind have `most` bytes at most.

    No row is left out: where there are more bytes, the longest texts give an `excerpt`, all of the
    same length.  `text` and `kind` are not null.
    """
    small_batches(rows.sparkSession)
    rows = held(rows.select(F.struct(*order).alias("order"), F.col(kind).alias("kind"), "text"))
    lengths: dict = {}
    for r in rows.select("kind", F.octet_length("text").alias("n")).collect():
        lengths.setdefault(r["kind"], []).append(r["n"])
    limits = {k: level(n, most) for k, n in lengths.items()}
    schema = T.StructType([rows.schema["order"], rows.schema["kind"], T.StructField("text", T.BinaryType())])

    def run(batches):
        for batch in parts(batches):
            made = [excerpt(t, limits[k]) for k, t in zip(batch.column(1).to_pylist(), utf8(batch.column(2)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.binary())], names=schema.names)

    return [(r["kind"], bytes(r["text"])) for r in rows.mapInArrow(run, schema).orderBy("order").collect()]


def lower_words(text: bytes) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` with A-Z in lower case; bytes.lower and bytes.split are ASCII only."""
    return text.lower().split()


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mixer, element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def lower_sql(column: str) -> str:
    """A-Z to lower case, everything else as it is; for comparison SQL."""
    return f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
