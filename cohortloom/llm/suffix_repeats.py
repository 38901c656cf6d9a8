"""Exact repeated passages by an enhanced suffix array over synchronising positions.

Every window of WIDTH bytes has one synchronising position, chosen by its content (the least hash of
GRAM bytes in it), so two equal windows have it at the same offset.  The suffixes at those positions
are the sparse suffix array; it is dealt out by the GRAM bytes that they begin with.  A task sorts
the suffixes of its share, computes common prefixes of neighbours and stack-scans them: an interval
of the common-prefix tree is a group of suffixes with a common right part.  Its members are compared
by their left extensions; where these differ the group is a maximal repeat, and every occurrence gets
the longest left part that it shares with another one.  All occurrences of a group are reported.

Equal texts are one text with a number of copies, equal surroundings one suffix with a number of
occurrences.  A position whose surroundings vary beyond CROWD ways is replaced by positions eight
bytes apart with short left parts; equal ones are combined before they are dealt out, so a very
common passage does not fill a task either.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.text import few_files, held, mix, parts, small_batches
from cohortloom.session import durable

WIDTH, GRAM = 200, 32
CROWD, STEP = 32_768, 8
#: Bytes of text that are hashed at once; a longer text is hashed in overlapping segments.
SEGMENT = 1 << 18
#: Suffixes in a task, about.
SHARE = 40_000

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


# ---- synchronising positions -------------------------------------------------------------------


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the `gram` (a power of two) bytes at each place, by doubling."""
    h, size = mix(np.arange(256, dtype=np.uint64) + np.uint64(1))[data], 1
    while size < gram:
        h = h[: len(h) - size] * np.uint64(0x9E3779B97F4A7C15 + 2 * size) + h[size:]
        size *= 2
    return mix(h)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[: len(values) - size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def sync_positions(texts: list[bytes], width: int = WIDTH, gram: int = GRAM) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the text, positions, hashes) for each text of at least `width` bytes."""
    group, size = [], 0
    for number, text in enumerate(texts):
        if len(text) < width:
            continue
        if len(text) > SEGMENT:
            places, hashes = [], []
            for begin in range(0, len(text) - width + 1, SEGMENT - width + 1):
                ((_, p, h),) = _sync([(number, text[begin : begin + SEGMENT])], width, gram)
                places.append(p + begin)
                hashes.append(h)
            p, first = np.unique(np.concatenate(places), return_index=True)
            yield number, p, np.concatenate(hashes)[first]
            continue
        if group and size + len(text) > SEGMENT:
            yield from _sync(group, width, gram)
            group, size = [], 0
        group.append((number, text))
        size += len(text)
    if group:
        yield from _sync(group, width, gram)


def _sync(group, width, gram):
    data = np.frombuffer(b"".join(t for _, t in group), np.uint8)
    h = _gram_hashes(data, gram)
    index = np.arange(len(h), dtype=np.uint64)
    # the place is in the low half, counted back: the last of equal hashes wins, in every copy alike
    ranked = (h & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(len(h)) - index)
    least = len(h) - (_least(ranked, width - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    begin = 0
    for number, text in group:
        own = least[begin : begin + len(text) - width + 1]
        own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        yield number, own - begin, h[own]
        begin += len(text)


# ---- enhanced suffix array -----------------------------------------------------------------------


def _padded(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    length = np.fromiter(map(len, parts), np.int64, len(parts))
    data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(len(parts), width)
    return data, length


def _common(data: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows a and rows b."""
    out = np.empty(len(a), np.int64)
    for k in range(0, len(a), 8192):
        differ = data[a[k : k + 8192]] != data[b[k : k + 8192]]
        some = differ.any(axis=1)
        out[k : k + 8192] = np.where(some, differ.argmax(axis=1), data.shape[1])
    return np.minimum(out, np.minimum(length[a], length[b]))


def intervals(common: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, end) of every interval of the common-prefix tree, inner ones first.

    common[i] belongs to the suffixes i - 1 and i; intervals with a shorter prefix than `least` are left out.
    """
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*common.tolist(), -1]):
        first = i - 1
        while stack and stack[-1][0] > value:
            height, first = stack.pop()
            yield height, first, i
        if value >= least and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def repeats(groups: list[int], lefts: list[bytes], rights: list[bytes], copies: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each suffix (what it is dealt by, its left and right surroundings): bytes before and after it that lie in a
    repeat of `width` bytes or more, and the number of a suffix that names its widest group."""
    n = len(lefts)
    before, after, group = np.zeros(n, np.int64), np.zeros(n, np.int64), np.arange(n)
    order = np.array(sorted(range(n), key=lambda i: (groups[i], rights[i])), np.int64)
    dealt = np.array(groups, np.int64)[order]
    right, right_size = _padded([rights[i] for i in order], width)
    back = [lefts[i][::-1] for i in order]
    left, left_size = _padded(back, max(1, max(map(len, back), default=1)))
    rank = np.empty(n, np.int64)
    rank[np.array(sorted(range(n), key=back.__getitem__), np.int64)] = np.arange(n)
    near = np.arange(1, n)
    common = np.concatenate([[0], np.where(dealt[1:] == dealt[:-1], _common(right, right_size, near - 1, near), 0)]) if n else near
    longest = left.shape[1]
    for height, first, end in intervals(common, max(1, width - longest)):
        members = np.arange(first, end)
        members = members[np.argsort(rank[first:end])]
        shared = _common(left, left_size, members[:-1], members[1:])
        if shared.min() + height >= width and shared.min() == shared.max():  # no left diversity worth a look
            own = np.full(len(members), shared[0])
        else:
            own = np.maximum(np.concatenate([[0], shared]), np.concatenate([shared, [0]]))
        fits = own + height >= width
        at = order[members[fits]]
        wider = own[fits] + height > before[at] + after[at]
        group[at[wider]] = order[members[0]]
        before[at] = np.maximum(before[at], own[fits])
        after[at] = np.maximum(after[at], height)
    whole = np.array([len(a) + len(b) >= width for a, b in zip(lefts, rights)], bool) & (copies > 1)
    before[whole] = [len(lefts[i]) for i in np.flatnonzero(whole)]
    after[whole] = [len(rights[i]) for i in np.flatnonzero(whole)]
    return before, after, group


# ---- the job ---------------------------------------------------------------------------------------


def _digest(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"".join(len(p).to_bytes(4, "little") + p for p in parts), digest_size=16).digest()


def _surroundings(text: bytes, at: int, width: int, gram: int) -> tuple[bytes, bytes]:
    return text[max(0, at - (width - gram)) : at], text[at : at + width]


def distinct_texts(docs: DataFrame, text: str = "text") -> tuple[DataFrame, object]:
    """h, copies, z: every distinct text once, compressed, held by its digest; and the digest as a column.

    Later joins by h find the texts where they are and do not move them again.
    """
    small_batches(docs.sparkSession)
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    digest = F.unhex(F.md5(whole.cast("binary")))

    def run(batches):
        for batch in parts(batches):
            pack = zstandard.ZstdCompressor(level=6).compress
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pack(t) for t in batch.column(1).to_pylist()], pa.binary())], names=["h", "z"])

    packed = docs.select(digest.alias("h"), whole.cast("binary").alias("text")).mapInArrow(run, "h binary, z binary")
    return held(packed.groupBy("h").agg(F.count("*").alias("copies"), F.first("z").alias("z"))), digest


def unpacked(column: pa.Array) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(z) for z in column.to_pylist()]


def _positions(texts: DataFrame, width: int, gram: int) -> DataFrame:
    """h, at, key: synchronising positions of every text, as arrays."""

    def run(batches):
        for batch in parts(batches):
            names = batch.column(0)
            for number, at, keys in sync_positions(unpacked(batch.column(1)), width, gram):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[number].as_py()], pa.binary()), pa.array([at.astype(np.int32)], pa.list_(pa.int32())), pa.array([keys.view(np.int64)], pa.list_(pa.int64()))],
                    names=["h", "at", "key"],
                )

    return texts.select("h", "z").mapInArrow(_joined(run), "h binary, at array<int>, key array<long>")


def _joined(run, rows: int = 512):
    """Small record batches put together, so each passes to Spark with others."""

    def wrapped(batches):
        kept = []
        for batch in run(batches):
            kept.append(batch)
            if len(kept) == rows:
                yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
                kept = []
        if kept:
            yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]

    return wrapped


def _occurrences(texts: DataFrame, kept: DataFrame, width: int, gram: int) -> DataFrame:
    """h, at, key, the digest c of the surroundings and how far they reach, for positions whose key occurs again."""

    def run(batches):
        for batch in parts(batches):
            h, copies, places = [], [], batch.column(3).to_pylist()
            at, key, c, lo, hi = [], [], [], [], []
            for name, n, text, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), unpacked(batch.column(2)), places):
                for x in own:
                    h.append(name)
                    copies.append(n)
                    at.append(x["at"])
                    key.append(x["key"])
                    left, right = _surroundings(text, x["at"], width, gram)
                    c.append(_digest(left, right))
                    lo.append(-len(left))
                    hi.append(len(right))
            kinds = (pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((h, copies, at, key, c, lo, hi), kinds)], names=["h", "copies", "at", "key", "c", "lo", "hi"])

    own = kept.groupBy("h").agg(F.collect_list(F.struct("at", "key")).alias("own"))  # as long as the text at most
    joined = texts.join(own, "h").select("h", "copies", "z", "own")
    return joined.mapInArrow(run, "h binary, copies long, at int, key long, c binary, lo int, hi int")


def _crowded_places(text: bytes, x: dict, width: int, gram: int) -> Iterator[tuple[int, int, int, bytes, bytes, bytes]]:
    """For a crowded position: shift, place, group, digest, left and right of the places that stand for it."""
    for shift in range(0, min(x["at"], width - gram) + 1, STEP):
        begin = x["at"] - shift
        body = text[begin : begin + width - STEP]
        if len(body) == width - STEP:  # else the text ends before; places further left have more of it
            left, right = text[max(0, begin - STEP + 1) : begin], text[begin : begin + width]
            yield shift, begin, int.from_bytes(_digest(body)[:8], "little", signed=True), _digest(b"crowded", left, right), left, right


def _with_texts(texts: DataFrame, firsts: DataFrame, rows_of, names: list[str], kinds: list, schema: str) -> DataFrame:
    """Rows made from every text and the surroundings that occur in it first."""

    def run(batches):
        for batch in batches:
            rows = []
            for part in parts([batch]):
                rows += rows_of(zip(unpacked(part.column(0)), part.column(1).to_pylist()))
            columns = zip(*rows) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds)], names=names)

    own = firsts.groupBy("h").agg(F.collect_list(F.struct("at", "key", "c", "n", "crowded")).alias("own"))
    return texts.join(own, "h").select("z", "own").mapInArrow(run, schema)


def _suffixes(texts: DataFrame, firsts: DataFrame, width: int, gram: int) -> DataFrame:
    """Suffixes with their surroundings: g, c, n, left, right.  Equal crowded ones are one row of a batch."""

    def rows_of(pairs):
        rows, seen = [], {}
        for text, own in pairs:
            counted = set()  # places of this text; two positions can lead to the same one
            for x in own:
                if not x["crowded"]:
                    rows.append((x["key"], x["c"], x["n"], *_surroundings(text, x["at"], width, gram)))
                    continue
                for _, begin, g, c, left, right in _crowded_places(text, x, width, gram):
                    if begin not in counted:
                        seen.setdefault(c, [g, c, 0, left, right])[2] += 1
                    counted.add(begin)
        return rows + [tuple(v) for v in seen.values()]

    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
    return _with_texts(texts, firsts, rows_of, ["g", "c", "n", "left", "right"], kinds, "g long, c binary, n long, left binary, right binary")


def _stand_ins(texts: DataFrame, firsts: DataFrame, width: int, gram: int) -> DataFrame:
    """c, origin, shift: which suffixes stand for crowded surroundings that occur once."""

    def rows_of(pairs):
        return [(c, x["c"], shift) for text, own in pairs for x in own for shift, _, _, c, _, _ in _crowded_places(text, x, width, gram)]

    return _with_texts(texts, firsts, rows_of, ["c", "origin", "shift"], [pa.binary(), pa.binary(), pa.int32()], "c binary, origin binary, shift int")


def _search(suffixes: DataFrame, width: int, pieces: int) -> DataFrame:
    """c, before, after, repeat: what lies in a repeat around each suffix, share by share."""

    def run(batches):
        c, n, groups, lefts, rights, known = [], [], [], [], [], {}
        for batch in batches:
            for g, name, count, left, right in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if name in known:  # combined in several tasks
                    n[known[name]] += count
                    continue
                known[name] = len(c)
                c.append(name)
                n.append(count)
                groups.append(g)
                lefts.append(left)
                rights.append(right)
        if not c:
            return
        before, after, group = repeats(groups, lefts, rights, np.array(n, np.int64), width)
        hit = np.flatnonzero(after)
        for k in range(0, len(hit), 10_000):
            at = hit[k : k + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[i] for i in at], pa.binary()), pa.array(before[at]), pa.array(after[at]), pa.array([c[i] for i in group[at]], pa.binary())],
                names=["c", "before", "after", "repeat"],
            )

    dealt = suffixes.repartition(pieces, "g").select("g", "c", "n", "left", "right")
    return dealt.mapInArrow(run, "c binary, before long, after long, repeat binary")


def find_repeats(texts: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """h, start, end, repeat: stretches of each distinct text that lie in a repeat, with their group."""
    spark = texts.sparkSession
    arrays = held(_positions(texts, width, gram))
    places = arrays.select("h", F.explode(F.arrays_zip("at", "key")).alias("x")).select("h", "x.at", "x.key")
    again = places.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    kept = durable(few_files(places.join(again, "key")), "positions")  # the many positions that occur once are let go
    arrays.unpersist()
    found = held(_occurrences(texts, kept, width, gram))
    extent = F.min(F.struct("key", "lo", "hi")).alias("x")  # the same for equal surroundings
    firsts = found.groupBy("c").agg(extent, F.sum("copies").alias("n"), F.min(F.struct("h", "at")).alias("first"))
    firsts = held(firsts.select("c", "x.key", "x.lo", "x.hi", "n", "first.h", "first.at"))
    ways = firsts.groupBy("key").agg(F.count("*").alias("ways")).where("ways > 1")
    varied = held(firsts.join(ways, "key").withColumn("crowded", F.col("ways") > CROWD).select("key", "c", "n", "h", "at", "crowded"))
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions")), varied.count() // SHARE + 1)
    crowded = varied.where("crowded AND n = 1")
    hits = held(_search(_suffixes(texts, varied, width, gram), width, pieces))
    plain = hits.select("c", (F.lit(0) - F.col("before")).alias("lo"), F.col("after").alias("hi"), "repeat")
    moved = _stand_ins(texts, crowded, width, gram).join(hits, "c").select(
        F.col("origin").alias("c"), (F.lit(0) - F.col("shift") - F.col("before")).alias("lo"), (F.col("after") - F.col("shift")).alias("hi"), "repeat"
    )
    # surroundings that occur again as they are need no comparison
    whole = firsts.where((F.col("n") > 1) & (F.col("hi") - F.col("lo") >= width)).select("c", F.col("lo").cast("long"), F.col("hi").cast("long"), F.col("c").alias("repeat"))
    spans = whole.union(plain).union(moved)
    return found.select("h", "at", "c").join(spans, "c").select("h", (F.col("at") + F.col("lo")).alias("start"), (F.col("at") + F.col("hi")).alias("end"), "repeat")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    ends = [0, *[b for _, b in spans]]
    return b"".join(text[a:b] for a, b in zip(ends, [*[a for a, _ in spans], len(text)]))


def kept_characters(text: bytes, spans: list[tuple[int, int]]) -> str:
    """What is left as text: a character goes if all its bytes go."""
    inner = []
    for a, b in spans:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        inner.append((a, b))
    return kept_bytes(text, inner).decode()


def dedup_texts(docs: DataFrame, text: str = "text", width: int = WIDTH, gram: int = GRAM, with_text: bool = True) -> tuple[DataFrame, object]:
    """For each distinct text by its digest h: n_bytes, n_removed, spans, kept_sha256 and, if asked, kept.

    Null counts as empty.  A text that occurs more than once is removed whole if it has `width` bytes.
    Texts shorter than that, and an empty table, have no repeats.  The digest as a column expression
    comes with the table, to join it with any rows that have the text.
    """
    texts, digest = distinct_texts(docs, text)
    found = find_repeats(texts, width, gram).groupBy("h").agg(F.collect_set(F.struct("start", "end")).alias("found"))

    def run(batches):
        for batch in parts(batches):
            out = [[] for _ in range(6)]
            for h, copies, text, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), unpacked(batch.column(2)), batch.column(3).to_pylist()):
                spans = [(0, len(text))] if copies > 1 and len(text) >= width else merged([(s["start"], s["end"]) for s in own or ()])
                values = (h, len(text), sum(b - a for a, b in spans), [{"start": a, "end": b} for a, b in spans], hashlib.sha256(kept_bytes(text, spans)).hexdigest(), kept_characters(text, spans) if with_text else None)
                for column, value in zip(out, values):
                    column.append(value)
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)], names=["h", "n_bytes", "n_removed", "spans", "kept_sha256", "kept"])

    schema = T.StructType([T.StructField("h", T.BinaryType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("spans", SPANS), T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.StringType())])
    joined = texts.join(found, "h", "left").select("h", "copies", "z", "found")
    return joined.mapInArrow(run, schema), digest


def removed(docs: DataFrame, doc: str = "doc_id") -> DataFrame:
    result, digest = dedup_texts(docs, with_text=False)
    slim = docs.select(F.col(f"`{doc}`").alias("doc_id"), digest.alias("h"))
    found = slim.join(result, "h").select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
    return few_files(found)
