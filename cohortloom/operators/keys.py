"""Key quality: null keys, duplicated keys, forced primary keys, foreign keys.

The frames handled here may hold one key value in a third of all rows.  Every
operator therefore reduces per key before the shuffle (partial counts, partial
window limits) or leaves the big side of a join splittable by adaptive skew handling.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.operators import sieve
from cohortloom.session import durable

Keys = str | Sequence[str]


class KeyViolation(ValueError):
    pass


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str


Frame = DataFrame | Callable[[], DataFrame]


class KeyedTable:
    """A table with a unique, non-null key, and the rows set aside on the way, which are planned when asked for."""

    def __init__(self, clean: DataFrame, na: Frame, dup: Frame) -> None:
        self.clean = clean
        self._na, self._dup = na, dup

    @property
    def na(self) -> DataFrame:
        return self._na() if callable(self._na) else self._na

    @property
    def dup(self) -> DataFrame:
        return self._dup() if callable(self._dup) else self._dup

    def with_clean(self, clean: DataFrame) -> "KeyedTable":
        return KeyedTable(clean, self._na, self._dup)


def as_list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def any_null(df: DataFrame, keys: Keys) -> Column:
    def missing(name: str) -> Column:
        c = F.col(name)
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            return c.isNull() | F.isnan(c)
        return c.isNull()

    return reduce(lambda a, b: a | b, [missing(k) for k in as_list(keys)])


def na_rows(df: DataFrame, keys: Keys) -> DataFrame:
    return df.filter(any_null(df, keys))


def notna_rows(df: DataFrame, keys: Keys) -> DataFrame:
    return df.filter(~any_null(df, keys))


def repeated_keys(df: DataFrame, keys: Keys) -> DataFrame:
    """Key values held by more than one row; counted map-side before the shuffle."""
    keys = as_list(keys)
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(*keys)


def dup_rows(df: DataFrame, keys: Keys) -> DataFrame:
    """All members of duplicated keys, in no order: who needs one sorts what is left.

    Semi join against the repeated keys rather than a counting window: a window would
    bring every row of a hot key into one task, a join side can be split.
    """
    keys = as_list(keys)
    return df.join(repeated_keys(df, keys), keys, "left_semi")


def keep_last(df: DataFrame, keys: Keys, order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the last in `order_by`, which has to be a total order.

    `row_number() = 1` is planned with a window limit below the exchange, so each map
    task ships one row per key at most, hot key or not.
    """
    keys = as_list(keys)
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    if not order:
        raise ValueError("keep_last needs an explicit row order")
    latest = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(latest)).filter("_rank = 1").drop("_rank")


def force_key(df: DataFrame, keys: Keys, order_by: Sequence[str | Column]) -> DataFrame:
    return keep_last(notna_rows(df, keys), keys, order_by)


def keyed(df: DataFrame, keys: Keys, order_by: Sequence[str]) -> KeyedTable:
    present = notna_rows(df, keys)
    return KeyedTable(
        clean=keep_last(present, keys, order_by),
        na=lambda: na_rows(df, keys),
        dup=lambda: dup_rows(present, keys),
    )


def keyed_apart(df: DataFrame, keys: Keys, order_by: Sequence[str]) -> KeyedTable:
    """`keyed` for a stored table: where few keys are repeated, rows of all others are in no exchange.

    Repeated keys are counted and written first, as narrow rows.  The clean rows are in no partitioning by the key.
    """
    present = notna_rows(df, keys)
    again = durable(repeated_keys(present, keys), "repeated")
    if again.count() > 8 * sieve.SIEVE:
        return KeyedTable(keep_last(present, keys, order_by), lambda: na_rows(df, keys), lambda: present.join(again, as_list(keys), "left_semi"))
    words = sieve.sieve(again, as_list(keys))
    alone, several = (sieve.sifted(present, as_list(keys), words, how) for how in ("left_anti", "left_semi"))
    return KeyedTable(
        clean=alone.unionByName(keep_last(several, keys, order_by)),
        na=lambda: na_rows(df, keys),
        dup=lambda: several.join(again, as_list(keys), "left_semi"),
    )


def unique_audit(df: DataFrame, keys: Keys) -> tuple[DataFrame, DataFrame]:
    """Null and duplicate rows of a secondary unique key, taken before any key is forced."""
    return na_rows(df, keys), dup_rows(notna_rows(df, keys), keys)


def assert_unique(df: DataFrame, keys: Keys) -> None:
    if not repeated_keys(df, keys).isEmpty():
        raise KeyViolation(f"{as_list(keys)} is not unique")


def distinct_values(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def key_difference(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Distinct non-null child values with no parent; both sides are reduced to keys first."""
    left = child.select(F.col(column).alias("key_value")).dropna().distinct()
    return left.join(parent.select(F.col(key).alias("key_value")), "key_value", "left_anti")


def fk_report(
    tables: Mapping[str, DataFrame], fks: Iterable[ForeignKey], pks: Mapping[str, str]
) -> DataFrame:
    """One row per foreign key: number of orphan values and one example."""
    parts = []
    for fk in fks:
        child, parent, pk = tables[fk.child], tables[fk.parent], pks[fk.parent]
        child_type, parent_type = child.schema[fk.column].dataType, parent.schema[pk].dataType
        if child_type != parent_type:
            raise KeyViolation(
                f"{fk.child}.{fk.column} is {child_type.simpleString()}, "
                f"{fk.parent}.{pk} is {parent_type.simpleString()}"
            )
        orphans = key_difference(child, fk.column, parent, pk)
        parts.append(
            orphans.agg(
                F.count("*").alias("orphans"),
                F.min(F.col("key_value").cast("string")).alias("example"),
            ).select(
                F.lit(f"{fk.child}.{fk.column}").alias("foreign_key"),
                F.lit(f"{fk.parent}.{pk}").alias("references"),
                "orphans",
                "example",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def check_fks(
    tables: Mapping[str, DataFrame], fks: Iterable[ForeignKey], pks: Mapping[str, str]
) -> None:
    """Raise when a foreign key is violated; the report has one row per declared key."""
    for row in fk_report(tables, fks, pks).filter("orphans > 0").collect():
        raise KeyViolation(
            f"{row.foreign_key} -> {row.references}: {row.orphans} unknown values, e.g. {row.example}"
        )


def filled_counts(df: DataFrame, null_tokens: Sequence[str] = ("None",)) -> DataFrame:
    """One row: per column the number of values that are neither null nor a null token."""

    def filled(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        ok = c.isNotNull()
        if isinstance(f.dataType, T.StringType):
            ok = ok & ~c.isin(*null_tokens)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            ok = ok & ~F.isnan(c)
        return F.count_if(ok).alias(f.name)

    return df.agg(*[filled(f) for f in df.schema.fields])


def empty_columns(df: DataFrame, null_tokens: Sequence[str] = ("None",)) -> list[str]:
    counts = filled_counts(df, null_tokens).first().asDict()
    return [name for name, n in counts.items() if n == 0]


def drop_empty_columns(df: DataFrame, null_tokens: Sequence[str] = ("None",)) -> DataFrame:
    return df.drop(*empty_columns(df, null_tokens))
