"""Benchmark decontamination by Wu-Manber search over words.

The alphabet is the word.  For all patterns of one length the search looks at the last block of two
words under the window: a shift table says how far the window can move without passing an
occurrence; where it says zero, the block selects a bucket, the first block selects within it, and
direct comparison confirms.  Texts are streamed; only the tables of a block of benchmark items of
bounded size are broadcast, and a larger benchmark is searched block after block.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.text import carried, parts, utf8

WINDOW = 10
#: Words of benchmark text whose tables are broadcast at once.
BLOCK_WORDS = 200_000

#: Letters, digits and everything beyond ASCII are word bytes; A-Z become lower case.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class SearchTable:
    """Shift table and buckets for patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple, set[int]]):
        self.length = length
        self.block = min(2, length)
        self.default = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key = self._key(pattern, end)
                self.shift[key] = min(self.shift.get(key, self.default), length - end)
            bucket = self.buckets.setdefault(self._key(pattern, length), {})
            bucket.setdefault(pattern[: self.block], []).append((pattern, tuple(sorted(items))))

    def _key(self, words, end):
        return (words[end - 2], words[end - 1]) if self.block == 2 else words[end - 1]

    def search(self, words: list[bytes]) -> Iterator[tuple[int, tuple]]:
        """Start of each occurrence and the items that hold the pattern."""
        length, block, default, shift, buckets = self.length, self.block, self.default, self.shift.get, self.buckets
        end, n = length, len(words)
        while end <= n:
            key = (words[end - 2], words[end - 1]) if block == 2 else words[end - 1]
            step = shift(key, default)
            if step:
                end += step
                continue
            begin = end - length
            for pattern, items in buckets[key].get(tuple(words[begin : begin + block]), ()):
                if tuple(words[begin:end]) == pattern:
                    yield begin, items
            end += 1


def search_tables(items: list[bytes | None], window: int = WINDOW) -> list[SearchTable]:
    """Tables over all windows of the items; an item shorter than the window is one pattern."""
    by_length: dict[int, dict[tuple, set[int]]] = {}
    for number, text in enumerate(items):
        words = words_of(text or b"")
        size = min(window, len(words))
        for begin in range(len(words) - size + 1 if size else 0):
            by_length.setdefault(size, {}).setdefault(tuple(words[begin : begin + size]), set()).add(number)
    return [SearchTable(length, patterns) for length, patterns in sorted(by_length.items())]


def occurrences(words: list[bytes], tables: list[SearchTable]) -> tuple[list[tuple[int, int]], set[int]]:
    """Maximal runs of words inside any occurrence, and the items found."""
    spans, found = [], set()
    for table in tables:
        for begin, items in table.search(words):
            spans.append((begin, begin + table.length))
            found.update(items)
    return merged(spans), found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _blocks(benchmark: DataFrame, item: str, text: str, block_words: int) -> Iterator[list[tuple[str | None, bytes | None]]]:
    """Benchmark items in blocks of bounded size, never the whole set at once."""
    block, size = [], 0
    rows = benchmark.select(F.col(f"`{item}`").cast("string"), F.col(f"`{text}`").cast("string"))
    for name, words in rows.toLocalIterator():
        own = None if words is None else words.encode()
        block.append((name, own))
        size += 0 if own is None else len(own) // 6 + 1
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    carry: list[str] | None = None,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """`row` (the carried columns), n_words, spans of hit words, items (ids as text, sorted).

    Null and empty texts have no words, spans or items.  Every input row gives one row, repeated
    rows too.  A benchmark row without text or words is no pattern; one without an id marks words
    but is not listed.  With an empty benchmark nothing is hit.  Other columns never clash: they
    stay inside `row`.
    """
    spark = docs.sparkSession
    found = carried(docs, carry, text).select(
        "row",
        "text",
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(T.ArrayType(SPAN)).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    schema = found.schema
    blocks = list(_prepared(spark, benchmark, item, item_text, window, block_words))
    for tables in blocks or [spark.sparkContext.broadcast(([], []))]:
        found = found.mapInArrow(_scanner(tables, schema), schema)
    return found.drop("text")


def _prepared(spark, benchmark, item, item_text, window, block_words):
    for block in _blocks(benchmark, item, item_text, block_words):
        tables = [vars(t) for t in search_tables([words for _, words in block], window)]  # plain values travel
        yield spark.sparkContext.broadcast(([name for name, _ in block], tables))


def _scanner(shared, schema):
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        names, plain = shared.value
        tables = []
        for values in plain:
            tables.append(SearchTable.__new__(SearchTable))
            vars(tables[-1]).update(values)
        for batch in parts(batches):
            texts, before, known = utf8(batch.column(1)), batch.column(3), batch.column(4)
            counts, spans, items = [], [], []
            for i, content in enumerate(texts):
                words = words_of(content or b"")
                own, found = occurrences(words, tables)
                earlier = [(s["start"], s["end"]) for s in before[i].as_py()]
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in (merged(own + earlier) if earlier else own)])
                items.append(sorted({names[k] for k in found if names[k] is not None} | set(known[i].as_py())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(spans, spans_type), pa.array(items, pa.list_(pa.string()))],
                names=schema.names,
            )

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id") -> DataFrame:
    """One row for each document: n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_benchmark(docs, benchmark, carry=[doc])
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        F.col("row").getField(doc).alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
