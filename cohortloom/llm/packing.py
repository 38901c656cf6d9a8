"""Packing token sequences as a cutting-stock problem solved by column generation.

Documents are cut into full sequences and one remainder.  The remainders are counted by size class;
that histogram has a fixed number of bins whatever the corpus, so the linear program over packing
patterns is solved on the driver: the simplex method keeps a basis of patterns, and a knapsack
dynamic program over the bins prices the next pattern.  Rounded pattern counts become a table that
says which ranks of a class go to which sequences, and Spark joins the ranked pieces with it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.text import PIECE_BYTES, carried, gathered
from cohortloom.llm.token_ids import LOT_BYTES, encoder, strings
from cohortloom.session import durable

CAPACITY = 1024
#: Tokens in a size class: a piece takes its length rounded up to this.
GRAIN = 8
END_ID = 0


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Small matrix product without threads of its own, beside those of the driver."""
    return np.einsum("ij,j...->i...", a, b)


def price(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable pattern by the unbounded knapsack: its value and the count of each size."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    useful = values > 1e-12
    size, value, number = sizes[useful], values[useful], np.flatnonzero(useful)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        fits = size <= room
        if fits.any():
            total = best[room - size[fits]] + value[fits]
            k = int(total.argmax())
            if total[k] > best[room] + 1e-15:
                best[room], last[room] = total[k], number[fits][k]
    counts, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            counts[last[room]] += 1
            room -= sizes[last[room]]
    return float(best[capacity]), counts


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int, tolerance: float = 1e-7, rounds: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and their fractional counts for which the linear program is optimal.

    `rounds` bounds the pivots; any basis met on the way is a valid, slightly worse packing.
    """
    m = len(sizes)
    patterns = np.diag(capacity // sizes).astype(float)  # column j: pattern j
    inverse = np.diag(1.0 / np.diag(patterns))
    amount = times(inverse, demand)
    for turn in range(rounds):
        duals = inverse.sum(axis=0)
        value, counts = price(duals, sizes, capacity)
        if value <= 1 + tolerance:
            break
        direction = times(inverse, counts)
        ratio = np.where(direction > 1e-10, amount / np.where(direction > 1e-10, direction, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        amount = amount - step * direction
        amount[out] = step
        patterns[:, out] = counts
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
        if turn % 200 == 199:  # rounding errors do not pile up
            inverse = 2 * inverse - times(inverse, times(patterns, inverse))  # one Newton step to the true inverse
            amount = np.maximum(times(inverse, demand), 0)
    return patterns.T.astype(np.int64), np.maximum(amount, 0)


def rounded(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole patterns with counts that pack exactly the demand: rounded down, the rest first-fit decreasing."""
    patterns, amount = column_generation(sizes, demand.astype(float), capacity)
    left, plan = demand.astype(np.int64).copy(), []
    for pattern, x in sorted(zip(patterns, amount), key=lambda p: -p[1]):
        used = pattern > 0
        times = min(int(np.floor(x + 1e-6)), int((left[used] // pattern[used]).min()) if used.any() else 0)
        if times > 0:
            plan.append((pattern, times))
            left -= times * pattern
    while left.any():
        pattern, room = np.zeros(len(sizes), np.int64), capacity
        for k in np.argsort(-sizes):
            fits = min(int(left[k]), room // int(sizes[k]))
            pattern[k] += fits
            room -= fits * int(sizes[k])
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        plan.append((pattern, times))
        left -= times * pattern
    return plan


def assignment(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (size, first rank, end rank, first sequence, pieces of this size in a sequence, first slot).

    `histogram` counts the pieces of each size.  A size that fills a sequence alone goes first.
    """
    rows, sequence, reached = [], 0, dict.fromkeys(histogram, 0)
    if full := histogram.get(capacity, 0):
        rows.append((capacity, 0, full, 0, 1, 0))
        sequence = full
    sizes = np.array(sorted(s for s in histogram if s < capacity), np.int64)
    if len(sizes) == 0:
        return rows
    for pattern, times in rounded(sizes, np.array([histogram[s] for s in sizes.tolist()]), capacity):
        slot = 0
        for size, each in zip(sizes.tolist(), pattern.tolist()):
            if each:
                rows.append((size, reached[size], reached[size] + each * times, sequence, each, slot))
                reached[size] += each * times
                slot += each
        sequence += times
    return rows


def cut(docs: DataFrame, text: str = "text", carry: list[str] | None = None, capacity: int = CAPACITY, grain: int = GRAIN, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """Pieces of all documents: full sequences and remainders, with crc32 of their ids.

    part and nth rank the pieces of a size class: nth counts within the task that made them.
    """
    slim = carried(docs, carry, text)
    fields = [("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), ("doc_tokens", T.LongType()), ("size", T.IntegerType()), ("part", T.IntegerType()), ("nth", T.LongType())]
    schema = T.StructType([slim.schema["row"], *[T.StructField(n, t) for n, t in fields]])

    def run(batches):
        work, part, seen = encoder(tokenizer), TaskContext.get().partitionId(), {}
        for batch in gathered(batches, LOT_BYTES):
            texts = strings(batch.column(1))
            ids, counts = work.encode(texts)
            ids, first = ids.astype("<u4", copy=False), np.concatenate([[0], np.cumsum(counts)])
            ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
            at = 0
            while at < len(texts):
                upto = max(at + 1, int(np.searchsorted(ends, PIECE_BYTES + (ends[at - 1] if at else 0), "right")))
                yield from made(batch, at, ids[first[at] : first[upto]], counts[at:upto], part, seen)
                at = upto

    def made(batch, at, ids, counts, part, seen):
        rows, columns, begin = [], [[] for _ in fields], 0
        tail = np.array([end_id], "<u4").tobytes()
        for k, n in enumerate(counts.tolist()):
            data = ids[begin : begin + n].tobytes() + tail
            begin += n
            for start in range(0, n + 1, capacity):
                length = min(capacity, n + 1 - start)
                size = -(-length // grain)
                nth = seen[size] = seen.get(size, -1) + 1
                rows.append(at + k)
                for column, x in zip(columns, (start, length, zlib.crc32(data[4 * start : 4 * (start + length)]), n + 1, size, part, nth)):
                    column.append(x)
        kinds = [pa.int32() if isinstance(t, T.IntegerType) else pa.int64() for _, t in fields]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int32())), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=schema.names)

    return slim.mapInArrow(run, schema)


def pack(docs: DataFrame, text: str = "text", carry: list[str] | None = None, capacity: int = CAPACITY, grain: int = GRAIN, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """`row`, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row for each piece.

    Null and empty texts are documents of the end id alone.  Repeated rows are packed each.  An empty
    table gives no rows.  Ties of length are ranked by place in the input.  Other columns stay in `row`.
    """
    spark = docs.sparkSession
    found = durable(cut(docs, text, carry, capacity, grain, end_id, tokenizer), "pieces")
    by_part = found.groupBy("size", "part").agg(F.count("*").alias("n"))
    histogram = {r["size"]: r["n"] for r in by_part.groupBy("size").agg(F.sum("n").alias("n")).collect()}  # capacity / grain rows at most
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = by_part.select("size", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    plan = spark.createDataFrame(assignment(histogram, capacity // grain), "size int, first long, end long, sequence long, each long, slot long")
    ranked = found.join(shift, ["size", "part"]).withColumn("rank", F.col("shift") + F.col("nth"))
    # the plan has at most two rows for each pair of a size and a pattern, and no more patterns than sizes
    placed = ranked.join(F.broadcast(plan), (ranked["size"] == plan["size"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    within = F.col("rank") - F.col("first")
    placed = placed.select(
        "row", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.floor(within / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("slot") + within % F.col("each")).alias("slot"),
    )
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)  # capacity rows at most
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop("slot")


def packed(docs: DataFrame, doc: str = "doc_id") -> DataFrame:
    made = pack(docs, carry=[doc])
    return made.select(F.col("row").getField(doc).alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
