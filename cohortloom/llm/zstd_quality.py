"""Quality by compression: zstandard dictionaries of good and of bad text, and a calibrated score.

A text is compressed in chunks with either dictionary; the chunk keeps the dictionary useful however
long the text is, and all chunks count.  The normalised difference of the two sizes says which text
it resembles; two more normalised sizes (with the good dictionary, and of the whole text alone) tell
repetition, which both dictionaries make short.  A logistic curve fitted on labelled rows that no
dictionary has seen turns them into a probability.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.text import bounded_rows, map_texts, share_by_hash

#: The classifier is fitted on at most so many labelled rows and bytes of either class.
SAMPLE_ROWS, SAMPLE_BYTES = 2000, 8_000_000
DICTIONARY_BYTES, CHUNK_BYTES, LEVEL = 112_640, 1024, 3
THRESHOLD = 0.7


def fold(doc: str, parts: int):
    """crc32 of the id as text, modulo the number of parts; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(f"`{doc}`").cast("string"), F.lit(""))) % parts


def _chunks(text: bytes) -> list[bytes]:
    return [text[i : i + CHUNK_BYTES] for i in range(0, len(text), CHUNK_BYTES)]


def dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; where there is too little text to train one, the text itself."""
    chunks = [c for t in texts for c in _chunks(t)]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, chunks)) // 4)), chunks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(chunks)[:DICTIONARY_BYTES]


def measurer(good: bytes, bad: bytes) -> Callable[[bytes], tuple[float, float, float]]:
    """Normalised sizes of a whole text: difference of bad and good, with good, alone."""

    def compressor(data: bytes | None, level: int):
        known = zstandard.ZstdCompressionDict(data) if data else None
        if known is not None:
            known.precompute_compress(level=level)
        return zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=False, write_dict_id=False)

    with_good, with_bad, alone = compressor(good, LEVEL), compressor(bad, LEVEL), compressor(None, 1)

    def measure(text: bytes) -> tuple[float, float, float]:
        n, chunks = len(text) + 16, _chunks(text)
        a = sum(len(with_good.compress(c)) for c in chunks)
        b = sum(len(with_bad.compress(c)) for c in chunks)
        return (b - a) / n, a / n, len(alone.compress(text)) / n

    return measure


def solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Small positive definite system, by elimination."""
    a, b = a.astype(float).copy(), b.astype(float).copy()
    for i in range(len(b)):
        for j in range(i + 1, len(b)):
            f = a[j, i] / a[i, i]
            a[j] -= f * a[i]
            b[j] -= f * b[i]
    for i in reversed(range(len(b))):
        b[i] = (b[i] - (a[i, i + 1 :] * b[i + 1 :]).sum()) / a[i, i]
    return b


def logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and intercept by Newton's method."""
    centre, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = np.column_stack([np.ones(len(features)), (features - centre) / scale])
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip((x * w).sum(axis=1), -40, 40)))
        slope = (x * (p - labels)[:, None]).sum(axis=0) + ridge * w
        curve = np.einsum("ij,ik,i->jk", x, x, p * (1 - p)) + ridge * np.eye(len(w))
        w = w - solve(curve, slope)
    weights = w[1:] / scale
    return weights, float(w[0] - (weights * centre).sum())


class Model:
    """Two dictionaries and a logistic curve; without both classes, a constant."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        """rows: label and text, in an order that does not depend on them; every second one calibrates."""
        good, bad = [t for q, t in rows if q], [t for q, t in rows if not q]
        self.constant = None
        if len(good) < 4 or len(bad) < 4:
            self.constant = (len(good) + 1) / (len(rows) + 2)
            return
        self.good, self.bad = dictionary(good[::2]), dictionary(bad[::2])
        measure = measurer(self.good, self.bad)
        held = [(1, t) for t in good[1::2]] + [(0, t) for t in bad[1::2]]
        self.weights, self.intercept = logistic(np.array([measure(t) for _, t in held]), np.array([q for q, _ in held], float))

    def scorer(self) -> Callable[[bytes], float]:
        if self.constant is not None:
            return lambda text: self.constant
        measure, (a, b, c) = measurer(self.good, self.bad), self.weights.tolist()

        def score(text: bytes) -> float:
            x, y, z = measure(text)
            return float(1 / (1 + np.exp(-np.clip(a * x + b * y + c * z + self.intercept, -40, 40))))

        return score


def labelled_sample(docs: DataFrame, labels: DataFrame, keep, doc: str = "doc_id", text: str = "text", label: str = "quality") -> list[tuple[int, bytes]]:
    """At most SAMPLE_ROWS rows and SAMPLE_BYTES of each class, in the order of a hash of the id.

    Conflicting labels of an id, null labels and null texts are left out; a repeated id counts once.
    A class that has more bytes keeps its rows, with excerpts of its longest texts.
    """
    known = labels.select(F.col(f"`{doc}`").alias("id"), F.col(f"`{label}`").cast("int").alias("q")).where("id IS NOT NULL AND q IS NOT NULL")
    known = known.groupBy("id").agg(F.min("q").alias("q"), F.max("q").alias("top")).where("q = top AND q IN (0, 1)").drop("top")
    known = known.where(keep("id")).withColumn("place", F.xxhash64("id"))
    there = {r["q"]: r["n"] for r in known.groupBy("q").agg(F.count("*").alias("n")).collect()}  # two rows
    first = [known.where((F.col("q") == q) & share_by_hash(F.col("place"), SAMPLE_ROWS, there.get(q, 0))).orderBy("place", "id").limit(SAMPLE_ROWS) for q in (0, 1)]
    picked = first[0].union(first[1])  # 2 * SAMPLE_ROWS rows at most
    texts = docs.select(F.col(f"`{doc}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).where("text IS NOT NULL")
    found = texts.join(F.broadcast(picked), "id").dropDuplicates(["id"])
    return bounded_rows(found, "q", SAMPLE_BYTES, ["place", "id"])


def score_quality(docs: DataFrame, labels: DataFrame, keep=None, doc: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """`row` (the carried columns) and `score`, the probability that the whole text is good.

    `keep` gives the condition, on the name of an id column, under which a label may be learned.
    Null texts count as empty and are scored.  Without labels of both classes every score is the
    smoothed share of good labels.  Repeated rows are scored each; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(vars(Model(labelled_sample(docs, labels, keep or (lambda _: F.lit(True)), doc, text))))

    def start():
        known = Model.__new__(Model)
        vars(known).update(model.value)
        score = known.scorer()
        return lambda texts: [[score(t or b"") for t in texts]]

    return map_texts(docs, [("score", T.DoubleType())], start, text, carry)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_quality(docs, labels, lambda c: fold(c, 4) != 2, carry=["doc_id"])
    doc = F.col("row").getField("doc_id")
    return scored.select(
        doc.alias("doc_id"),
        (F.crc32(F.coalesce(doc.cast("string"), F.lit(""))) % 4 == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
