"""Row numbers and running totals over a global order, without a single-task window."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from cohortloom.session import durable

KEEP = "_piece"
#: Input bytes for which a range of an order is cut, and the most ranges.
PIECE_BYTES, MOST_PIECES = 32 << 20, 20_000
#: Ranges of a histogram of an order, keys drawn for each, and rows below which a range is not cut further.
RANGES, DRAWN, CLOSE = 64, 16, 100_000


def pieces_for(df: DataFrame) -> int:
    """Ranges to cut a frame into, by the size of what it reads; as many as a shuffle has where that is unknown."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    if size >= 1 << 60:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(MOST_PIECES, -(-size // PIECE_BYTES)))


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    group_by: Sequence[str] = (),
    value: str | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Add `position` (1, 2, … in `order_by`, per group) and, for `value`, `running_total`.

    Rows are split into ranges of (group, order); each range is numbered by itself and
    shifted by the size of the ranges before it in its group.  The ranges are written to
    the shared folder first: both passes must see the same split.  `order_by` should be a
    total order, which also lets a large group spread over many ranges.  The number of
    ranges follows the size of the input.
    """
    pieces = pieces or pieces_for(df)
    keys = [*group_by, *order_by]
    amount: Column = F.col(value) if value else F.lit(0)
    placed = durable(
        df.repartitionByRange(pieces, *keys).withColumn(KEEP, F.spark_partition_id()), "numbering"
    )
    sizes = placed.groupBy(*group_by, KEEP).agg(
        F.count("*").alias("_rows"), F.coalesce(F.sum(amount), F.lit(0)).alias("_amount")
    )
    earlier = Window.partitionBy(*group_by).orderBy(KEEP).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group_by)],
        F.col(KEEP).alias("_p"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_amount").over(earlier), F.lit(0)).alias("_amount_before"),
    )
    here = F.col(KEEP) == F.col("_p")
    for i, g in enumerate(group_by):
        here = here & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    inside = Window.partitionBy(*group_by, KEEP).orderBy(*order_by)
    numbered = placed.withColumn("_local", F.row_number().over(inside))
    if value:
        so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        numbered = numbered.withColumn("_local_total", F.sum(amount).over(so_far))
    out = numbered.join(offsets, here, "left").withColumn(
        "position", (F.col("_local") + F.col("_rows_before")).cast("bigint")
    )
    if value:
        out = out.withColumn("running_total", F.col("_local_total") + F.col("_amount_before"))
    names = [*df.columns, "position", *(["running_total"] if value else [])]
    return out.select(*names)


def first_by_total(df: DataFrame, order_by: Sequence[str], value: str, most: int) -> DataFrame:
    """The first rows in an order while the running total of `value` (never negative) is at most `most`.

    Adds `position` and `running_total`.  Only what is taken is numbered: a weighted histogram of the order
    (rows and total of each of RANGES ranges, cut at drawn keys) finds the range in which the total is
    passed, that range is cut again until it has few rows, and rows behind it are left out.  The input is
    read once or twice a round, by order and value only; a round divides what is left by about RANGES.
    """
    keys = list(order_by)
    key = F.struct(*keys)
    slim = df.select(key.alias("key"), F.coalesce(F.col(value), F.lit(0)).alias("value"))
    kinds = [df.schema[k].dataType for k in keys]

    def constant(row: Row) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(k) for k, v, t in zip(keys, row, kinds)])

    def totals(rows: DataFrame) -> Row:
        return rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("value"), F.lit(0)).alias("total")).first()

    here, before, end = slim, 0, None
    found = totals(here)
    if found.total <= most:
        return number_rows(df, keys, value=value)
    while found.n > CLOSE:
        share = min(1.0, RANGES * DRAWN / found.n)
        drawn = here.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select("key").distinct()
        cuts = [r.key for r in drawn.orderBy("key").limit(4 * RANGES * DRAWN).collect()][DRAWN - 1 :: DRAWN]
        if not cuts:
            break
        place = F.lit(len(cuts))
        for i, cut in reversed(list(enumerate(cuts))):
            place = F.when(F.col("key") <= constant(cut), i).otherwise(place)
        sums = here.groupBy(place.alias("place")).agg(F.count("*").alias("n"), F.sum("value").alias("total")).collect()
        for r in sorted(sums, key=lambda r: r.place):
            if before + r.total > most:
                break
            before += r.total
        smaller = r.n < found.n
        found, here = r, here.where(place == r.place)
        if r.place < len(cuts):
            end = cuts[r.place]
        if not smaller:  # one key has all rows
            break
    kept = df if end is None else df.where(key <= constant(end))
    return number_rows(kept, keys, value=value).where(F.col("running_total") <= most)


def permutation_ids(people: DataFrame, key: str, salt: str) -> DataFrame:
    """(key, id_random): a random-looking permutation 0 … n-1 of the distinct keys.

    Keys are ordered by a salted hash.  The hash is uniform, so its first digits cut the
    order into even pieces by themselves; write the result once and keep it.
    """
    hashed = (
        people.select(key)
        .dropna()
        .distinct()
        .withColumn("_h", F.md5(F.concat(F.lit(salt), F.col(key).cast("string"))))
        .withColumn("_cut", F.substring("_h", 1, 3))
    )
    sizes = hashed.groupBy("_cut").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_cut", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_cut").orderBy("_h", key)
    # 4096 pieces at most, hence at most 4096 offsets: bounded by the three hex digits
    return (
        hashed.withColumn("_local", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_cut")
        .select(key, (F.col("_local") - 1 + F.col("_before")).cast("bigint").alias("id_random"))
    )
