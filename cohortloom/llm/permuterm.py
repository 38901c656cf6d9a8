"""Spelling variants of words by permuterm rotations.

Every word, marked with a terminator, is rotated to each of its places.  A rotation that starts right
behind a letter ends in that letter; its prefix without it (`skip`) says everything about the word but
that letter.  So words that differ in one replaced letter share the prefix of a rotation, and a word
with a letter less is, as a whole rotation (`whole`), the prefix of the longer word's.  Sorted, the
rotations of such words lie side by side: each range of equal prefixes is scanned once and every member
learns how many neighbours it has there and which of them stands first.

A range holds one word as a whole and others that differ in one letter of one place, so it has at most as
many members as the alphabet has letters, and no pairs are made.  A replaced letter has one place, a
missing one can be any of a run of equal letters, so only the first of a run counts for it.

Words travel as their rank by frequency and spelling; what a range hands back is a rank as well.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.text import parts, small_batches, utf8
from cohortloom.operators.numbering import number_rows
from cohortloom.session import durable

#: Words with at least so many letters and occurrences, and how many times as frequent a form must be.
LETTERS, OCCURRENCES, TIMES = 6, 5, 5
#: Rotations of more letters are sorted by length, terminator's place and a fingerprint of 127 bits.
SPELLED = 64
#: Distinct words that a task counts before it hands them on.
COUNTED = 300_000

_TERMINATOR = "$"
_PRIME, _BASE = (1 << 127) - 1, 0x5DEECE66D1B54A32D192ED03A6C8F1B5
_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def worn(word: str, doc_id: str, every: int) -> str:
    """The word, or one letter less where `every` divides the checksum of document and word."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def count_words(docs: DataFrame, every: int = 199, letters: int = LETTERS) -> DataFrame:
    """word, n: runs of letters of all whole texts, worn by `every`, that still have `letters` code points.

    Only A-Z are lower-cased.  A null text has no words, a null id counts as empty, a repeated row counts
    again.  Tasks count before anything is shuffled.
    """
    small_batches(docs.sparkSession)
    slim = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text").cast("string"))

    def rows(total):
        made = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
        total.clear()
        return made

    def run(batches):
        total = Counter()
        for batch in parts(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                for word, n in Counter(_RUN.findall((text or b"").lower().decode(errors="replace"))).items():
                    if len(word := worn(word, doc_id, every)) >= letters:
                        total[word] += n
                if len(total) > COUNTED:
                    yield rows(total)
        yield rows(total)

    return slim.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def rotations(word: str) -> list[tuple[str, bool, bool]]:
    """(prefix, whole, first): all whole rotations, and all that skip a letter; `first`: the first of a run of equal letters."""
    size = len(word)
    if size <= SPELLED:
        whole = [word[i:] + _TERMINATOR + word[:i] for i in range(size + 1)]
        skip = [word[i + 1 :] + _TERMINATOR + word[:i] for i in range(size)]
    else:
        upto, power = [0], [1]
        for letter in word:
            upto.append((upto[-1] * _BASE + ord(letter) + 1) % _PRIME)
            power.append(power[-1] * _BASE % _PRIME)
        whole = [f"{size} {i} {upto[-1]:x}" for i in range(size + 1)]
        if size - 1 <= SPELLED:
            skip = [word[i + 1 :] + _TERMINATOR + word[:i] for i in range(size)]
        else:
            rest = [(upto[-1] - upto[i + 1] * power[size - i - 1]) for i in range(size)]
            skip = [f"{size - 1} {i} {(upto[i] * power[size - i - 1] + rest[i]) % _PRIME:x}" for i in range(size)]
    first = [i == 0 or word[i] != word[i - 1] for i in range(size)]
    return [(key, True, True) for key in whole] + list(zip(skip, [False] * size, first))


def _rotated(ranked: DataFrame) -> DataFrame:
    def run(batches):
        for batch in parts(batches, 2000):
            keys, ranks, whole, first = [], [], [], []
            for word, rank in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for key, w, f in rotations(word):
                    keys.append(key), ranks.append(rank), whole.append(w), first.append(f)
                if len(keys) > 100_000:
                    yield table(keys, ranks, whole, first)
                    keys, ranks, whole, first = [], [], [], []
            yield table(keys, ranks, whole, first)

    def table(keys, ranks, whole, first):
        columns = [pa.array(keys, pa.string()), pa.array(ranks, pa.int64()), pa.array(whole, pa.bool_()), pa.array(first, pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, names=["key", "rank", "whole", "first"])

    return ranked.select("word", "rank").mapInArrow(run, "key string, rank long, whole boolean, first boolean")


def neighbours(ranked: DataFrame) -> DataFrame:
    """rank, n_near, best: how many words differ from this one by one letter, and the least rank among them."""
    group = Window.partitionBy("key")
    skip = ~F.col("whole")
    seen = _rotated(ranked).select(
        "*",
        F.count_if(skip).over(group).alias("skips"),
        F.count_if(skip & F.col("first")).over(group).alias("firsts"),
        F.min(F.when(skip, F.col("rank"))).over(group).alias("best_skip"),
        F.min(F.when(skip & F.col("first"), F.col("rank"))).over(group).alias("best_first"),
        F.min(F.when(F.col("whole"), F.col("rank"))).over(group).alias("shorter"),
    )
    seen = seen.where(F.when(F.col("whole"), F.col("firsts") > 0).otherwise((F.col("skips") > 1) | (F.col("first") & F.col("shorter").isNotNull())))
    second = F.min(F.when(skip & (F.col("rank") > F.col("best_skip")), F.col("rank"))).over(group)
    seen = seen.withColumn("second", second)
    other = F.when(F.col("rank") == F.col("best_skip"), F.col("second")).otherwise(F.col("best_skip"))
    shorter = F.when(F.col("first"), F.col("shorter"))
    near = F.when(F.col("whole"), F.col("firsts")).otherwise(F.col("skips") - 1 + shorter.isNotNull().cast("long"))
    best = F.when(F.col("whole"), F.col("best_first")).otherwise(F.least(other, shorter))
    return seen.select("rank", near.alias("near"), best.alias("best")).groupBy("rank").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """rank, root for links (rank, form): every link is led on to where its chain ends, in doubling steps.

    A form is more frequent than its word by a factor, so chains end, after at most the logarithm of the
    largest count; they need the logarithm of that in steps.
    """
    links = durable(links.select("rank", F.col("form").alias("root")), "forms")
    while not links.join(links.select(F.col("rank").alias("root")), "root", "left_semi").isEmpty():
        further = links.select(F.col("rank").alias("root"), F.col("root").alias("next"))
        links = durable(links.join(further, "root", "left").select("rank", F.coalesce("next", "root").alias("root")), "forms")
    return links


def group_variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n for words with counts (word, n), each word once.

    Near words differ in exactly one inserted, deleted or replaced code point.  The form is the near word
    of largest n, of equals the smallest by code points, if it has `times` the word's n; the root is the
    last of the chain of forms, the word itself where it has none.  Words with null or without letters,
    and an empty table, give no rows; further columns are left out.  A word's rotations are as many as its
    letters and are sorted in the memory of no single task.
    """
    words = words.where((F.length("word") > 0) & F.col("n").isNotNull()).select("word", "n", (-F.col("n")).alias("less"))
    ranked = durable(number_rows(words, ["less", "word"]).select("word", "n", F.col("position").alias("rank")), "words")
    near = neighbours(ranked)
    best = ranked.select(F.col("rank").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    known = ranked.join(near, "rank", "left").join(best, "best", "left")
    is_form = F.col("form_n") >= times * F.col("n")
    known = durable(known.select("rank", "word", "n", "n_near", *[F.when(is_form, F.col(c)).alias(c) for c in ("best", "form", "form_n")]), "variants")
    ends = roots(known.where("best IS NOT NULL").select("rank", F.col("best").alias("form")))
    named = ends.join(ranked.select(F.col("rank").alias("root"), F.col("word").alias("end")), "root").select("rank", "end")
    return known.join(named, "rank", "left").select(
        "word", "form", F.coalesce("end", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )


def spelling_groups(docs: DataFrame, every: int = 199, letters: int = LETTERS, occurrences: int = OCCURRENCES) -> DataFrame:
    """`group_variants` of the worn words of all whole texts that occur often enough."""
    return group_variants(count_words(docs, every, letters).where(F.col("n") >= occurrences))
