"""Token ids in grammar-compressed shards (Re-Pair), with random access by document.

A shard is a row of a Parquet file: documents in ascending id order, and one binary payload.

    magic "RPR1", then little-endian uint32: documents, rules, symbols, and bytes of a symbol (2, 3 or 4)
    rules      2 symbols each; rule r stands for symbol BASE + r, BASE is the next uint32
    lengths    uint32 for each rule: the number of ids it expands to
    symbols    the documents' symbols, one after the other
    starts     uint64 for each document and one more: its first symbol
    firsts     uint64 for each document and one more: its first id within the shard

No rule spans two documents, as no pair with the end id is replaced; so a document is read alone by
its symbol range, and the lengths lead to a place within it.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.text import gathered, small_batches
from cohortloom.llm.token_ids import LOT_BYTES, encoder
from cohortloom.session import durable

MAGIC = b"RPR1"
END_ID = 2
#: Ids in a shard, about; a longer document is a shard alone.
SHARD_IDS = 1 << 20
#: Each round counts all pairs of a shard and replaces up to ROUND_PAIRS of those seen LEAST_COUNT times or more;
#: rounds go on until no pair is seen so often.
ROUND_PAIRS, LEAST_COUNT = 4096, 16

_HEAD = "<4s5I"


def frequent_pairs(a: np.ndarray, b: np.ndarray, least: int, most: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Of pairs a[i], b[i]: the most frequent such that none overlap, and the other frequent ones.

    A symbol is a left one, a right one, or both in one pair of equals.
    """
    if len(a) == 0:
        return [], []
    kind, bits = (np.uint32, 16) if max(a.max(), b.max()) < 1 << 16 else (np.uint64, 32)
    keys = a.astype(kind) << kind(bits) | b.astype(kind)
    keys.sort()
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    count = np.diff(np.concatenate([edge, [len(keys)]]))
    often = np.flatnonzero(count >= least)
    often = often[np.argsort(-count[often], kind="stable")]
    lefts, rights, chosen, others = set(), set(), [], []
    for key in keys[edge[often]].tolist():
        x, y = key >> bits, key & ((1 << bits) - 1)
        if len(chosen) < most and x not in rights and y not in lefts and (x != y or x not in lefts and x not in rights):
            lefts.add(x)
            rights.add(y)
            chosen.append((x, y))
        else:
            others.append((x, y))
    return chosen, others


def occurrences(a: np.ndarray, b: np.ndarray, at: np.ndarray, pairs: list[tuple[int, int]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places out of `at` where one of the pairs a, b begins, and which one; of a run of equals every second place."""
    lefts, rights = (sorted({p[k] for p in pairs}) for k in (0, 1))
    row, column = np.zeros(size, np.int16), np.zeros(size, np.int16)
    row[lefts] = np.arange(1, len(lefts) + 1)
    column[rights] = np.arange(1, len(rights) + 1)
    grid = np.zeros((len(lefts) + 1, len(rights) + 1), np.int16)
    x, y = np.array(pairs).T
    grid[row[x], column[y]] = np.arange(1, len(pairs) + 1)
    rule = grid[row[a], column[b]]
    found = np.flatnonzero(rule)
    at, rule, equal = at[found], rule[found].astype(np.int64) - 1, a[found] == b[found]
    if equal.any():
        first_of = np.concatenate([[True], (np.diff(at) > 1) | ~(equal[1:] & equal[:-1])])
        begin = np.maximum.accumulate(np.where(first_of, np.arange(len(at)), 0))
        taken = (np.arange(len(at)) - begin) % 2 == 0
        at, rule = at[taken], rule[taken]
    return at, rule


def grammar(symbols: np.ndarray, end_id: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The symbols with frequent pairs replaced, and the rules; rule r is the symbol max + 1 + r.

    A pair of old symbols never becomes more frequent, so after the first round only places count that
    have a new symbol or a pair that was frequent and not replaced.
    """
    first = int(symbols.max()) + 1
    rules: list[tuple[int, int]] = []
    at = np.flatnonzero((symbols[:-1] != end_id) & (symbols[1:] != end_id))
    while True:
        a, b = symbols[at], symbols[at + 1]
        pairs, others = frequent_pairs(a, b, LEAST_COUNT, ROUND_PAIRS)
        if not pairs:
            return symbols, rules
        size = first + len(rules)
        where, rule = occurrences(a, b, at, pairs, size)
        left, right = np.zeros(size, bool), np.zeros(size, bool)
        left[[x for x, _ in others]] = True
        right[[y for _, y in others]] = True
        keep, marked = np.ones(len(symbols), bool), np.zeros(len(symbols), bool)
        keep[where + 1] = False
        # where a place before a new symbol is dropped, the one before it has a new symbol too; before the first is the last, which begins no pair
        marked[where] = marked[where - 1] = True
        marked[at[left[a] & right[b]]] = True
        symbols[where] = size + rule
        rules += pairs
        symbols, marked = symbols[keep], marked[keep]
        at = np.flatnonzero(marked[:-1])
        at = at[(symbols[at] != end_id) & (symbols[at + 1] != end_id)]


def compress(documents: list[np.ndarray], end_id: int = END_ID) -> bytes:
    """One shard of documents, each an array of ids that ends with the end id."""
    symbols = np.concatenate(documents).astype(np.uint32)
    firsts = np.concatenate([[0], np.cumsum([len(d) for d in documents])])
    base = int(symbols.max()) + 1
    symbols, rules = grammar(symbols, end_id)
    lengths = [1] * base
    for x, y in rules:
        lengths.append(lengths[x] + lengths[y])
    lengths = np.array(lengths, np.uint32)
    at = np.concatenate([[0], np.cumsum(lengths[symbols], dtype=np.int64)])
    starts = np.searchsorted(at, firsts)
    width = next(w for w in (2, 3, 4) if base + len(rules) <= 1 << 8 * w)
    return b"".join(
        [
            struct.pack(_HEAD, MAGIC, len(documents), len(rules), len(symbols), width, base),
            _narrow(np.array(rules, "<u4"), width),
            lengths[base:].astype("<u4").tobytes(),
            _narrow(symbols, width),
            starts.astype("<u8").tobytes(),
            firsts.astype("<u8").tobytes(),
        ]
    )


def _narrow(symbols: np.ndarray, width: int) -> bytes:
    """Symbols in `width` bytes each."""
    return np.ascontiguousarray(symbols, "<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


class Shard:
    """A payload, read in place."""

    def __init__(self, payload: bytes):
        magic, self.documents, rules, symbols, width, self.base = struct.unpack_from(_HEAD, payload)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at = struct.calcsize(_HEAD)

        def read(kind, n):
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        def wide(n):
            out = np.zeros((n, 4), np.uint8)
            out[:, :width] = read(np.uint8, n * width).reshape(n, width)
            return out.view("<u4").ravel()

        self.rules = wide(2 * rules).reshape(-1, 2)
        self.lengths = read("<u4", rules)
        self.symbols = wide(symbols)
        self.starts = read("<u8", self.documents + 1).astype(np.int64)
        self.firsts = read("<u8", self.documents + 1).astype(np.int64)
        self._flat()

    def _flat(self) -> None:
        """The expansion of every rule, one after the other; plain ids stand for themselves."""
        flat = [np.arange(self.base, dtype=np.uint32)]
        parts: dict[int, np.ndarray] = {}
        for r, (a, b) in enumerate(self.rules.tolist()):
            parts[self.base + r] = np.concatenate([parts[x] if x >= self.base else flat[0][x : x + 1] for x in (a, b)])
        self.flat = np.concatenate([*flat, *parts.values()]) if parts else flat[0]
        self.size = np.concatenate([np.ones(self.base, np.int64), self.lengths.astype(np.int64)])
        self.begin = np.cumsum(self.size) - self.size

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids of documents first to last - 1, one after the other."""
        symbols = self.symbols[self.starts[first] : self.starts[last]]
        size = self.size[symbols]
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.begin[symbols] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]

    def slice(self, document: int, start: int, stop: int) -> np.ndarray:
        """Ids start to stop - 1 of a document; only symbols that cover them are expanded."""
        symbols = self.symbols[self.starts[document] : self.starts[document + 1]]
        ends = np.cumsum(self.size[symbols])
        a, b = np.searchsorted(ends, start, "right"), min(len(symbols), np.searchsorted(ends, stop, "left") + 1)
        before = int(ends[a - 1]) if a else 0
        own = [self.flat[self.begin[s] : self.begin[s] + self.size[s]] for s in symbols[a:b]]
        return (np.concatenate(own) if own else np.zeros(0, np.uint32))[start - before : stop - before]


def write_shards(docs: DataFrame, doc: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode, sort by document id, compress and write; the written shards are returned.

    part, nth: place of a shard; before: ids of the part before it; tokens; doc_ids; payload.
    A null or empty text is the end id alone; a null id sorts first; equal ids stay neighbours, in no
    given order.  An empty table writes no shard.  Other columns are not read.
    """
    schema = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType()), T.StructField("before", T.LongType()), T.StructField("tokens", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType())]
    )
    small_batches(docs.sparkSession)
    slim = docs.select(F.col(f"`{doc}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches):
        work, part, nth, before = encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        names, kept, size = [], [], 0
        end = np.array([end_id], np.uint32)

        def shard():
            nonlocal names, kept, size, nth, before
            out = pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip((part, nth, before, size, names, compress(kept, end_id)), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()))],
                names=schema.names,
            )
            nth, before = nth + 1, before + size
            names, kept, size = [], [], 0
            return out

        for batch in gathered(batches, LOT_BYTES):
            ids, counts = work.encode(batch.column(1))
            for doc, own in zip(batch.column(0).to_pylist(), np.split(ids, np.cumsum(counts)[:-1])):
                names.append(doc)
                kept.append(np.concatenate([own, end]))
                size += len(own) + 1
                if size >= shard_ids:
                    yield shard()
        if kept:
            yield shard()

    ordered = slim.repartitionByRange("doc").sortWithinPartitions("doc")
    return durable(ordered.mapInArrow(run, schema), "shards")


def read_documents(shards: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 from written shards."""
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("at", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["payload"])
                data = shard.ids(0, shard.documents).astype("<u4")
                sums = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(shard.firsts[:-1], shard.firsts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * shard.documents, pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(row["before"] + shard.firsts[:-1]), pa.array(np.diff(shard.firsts)), pa.array(sums, pa.int64())],
                    names=schema.names,
                )

    found = shards.select("part", "before", "doc_ids", "payload").mapInArrow(run, schema)
    # one row for each writing task; small numbers for any corpus that fits a cluster
    sizes = shards.groupBy("part").agg(F.sum("tokens").alias("ids"))
    earlier = sizes.select("part", F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    return found.join(earlier, "part").select("doc_id", (F.col("earlier") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
