"""Sieves: which keys a table has, as a bounded bitmap that is broadcast, so that rows of other keys need no exchange."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits in a sieve.
SIEVE = 1 << 18


def _place(keys: str | Sequence[str]):
    """(word, bit) of a key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return F.pmod(F.xxhash64(*keys, F.lit("word")), F.lit(SIEVE)), F.pmod(F.xxhash64(*keys, F.lit("bit")), F.lit(64)).cast("int")


def sieve(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One row for each word that has a key's bit: SIEVE at most, however many keys there are."""
    word, bit = _place(keys)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    return df.select(word.alias("_word"), one.alias("_one")).groupBy("_word").agg(F.bit_or("_one").alias("_bits"))


def sifted(df: DataFrame, keys: str | Sequence[str], words: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose key may be in the sieve, without an exchange; with `left_anti` those whose key is not in it."""
    word, bit = _place(keys)
    there = (F.col("_word") == word) & (F.call_function("shiftrightunsigned", F.col("_bits"), bit).bitwiseAND(F.lit(1)) == 1)
    return df.join(F.broadcast(words), there, how)
