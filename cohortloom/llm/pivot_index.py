"""Near duplicates of vectors by a pivot-permutation index.

Every vector is described by the ordered list of its nearest pivots.  Inverted lists, one for each
pivot and label, bring together vectors that have the pivot among their nearest; two of them are
candidates if they share enough pivots, or one that both are close to, and candidates are verified by
their cosine.  Pivots keep a distance from each other, so a large group of near copies has few of them
and its members share them.  Equal vectors are one entry.  A long list is cut into chunks that meet in pairs, so no list is gathered whole, and
a task returns link counts and a spanning set of links, not all links.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.graph import components
from cohortloom.llm.text import few_files, held, share_by_hash

COSINE = 0.93
#: Pivots are distinct vectors in the order of a hash, less those close to an earlier one: the square root of their
#: number at most, within these bounds, out of a sample of MOST_PIVOTS.
LEAST_PIVOTS, MOST_PIVOTS = 64, 4096
#: Nearest pivots of a vector, and how many of them two candidates share at least.
NEAREST, SHARED = 8, 3
#: Vectors of an inverted list that a task holds from either side.
CHUNK = 1024


def entries(vectors: DataFrame, vec: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, data: little-endian floats of vectors that can be compared, else null data."""
    slim = vectors.select(F.col(f"`{vec}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)

    def run(batches):
        for batch in batches:
            data = [None if v is None else np.array(v, "<f8").tobytes() for v in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())], names=["vec_id", "label", "data"])

    return slim.select("vec_id", "label", F.when(usable, F.col("v")).alias("v")).mapInArrow(run, "vec_id long, label string, data binary")


def unit(data) -> np.ndarray:
    """Rows of unit length, in double precision; a row is scaled first, so no square overflows or vanishes."""
    v = np.stack([np.frombuffer(d, "<f8") for d in data])
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def close(cosine: float) -> float:
    """Cosine of twice the angle at which vectors are linked: what two vectors linked to a third have at least."""
    return 2 * cosine * cosine - 1 if cosine > 0 else -1.0


def choose_pivots(distinct: DataFrame, number: int | None = None, apart: float = close(COSINE)) -> dict[int, np.ndarray]:
    """Pivots by dimension, `number` at most; no two of a dimension have a cosine of `apart` or more."""
    there = distinct.count()
    number = number or min(MOST_PIVOTS, max(LEAST_PIVOTS, int(there**0.5)))
    drawn = max(number, MOST_PIVOTS)
    rows = distinct.where(share_by_hash(F.col("data"), drawn, there)).orderBy(F.xxhash64("id", "data"), "id").limit(drawn).select("data").collect()
    by_size: dict[int, list] = {}
    for place, row in enumerate(rows):
        by_size.setdefault(len(row["data"]) // 8, []).append((place, row["data"]))
    thinned = []
    for size, own in by_size.items():
        points = unit([data for _, data in own])
        free = np.ones(len(own), bool)
        for k, (place, _) in enumerate(own):
            if free[k]:
                thinned.append((place, size, points[k]))
                free &= points @ points[k] < apart
    pivots: dict[int, list] = {}
    for _, size, point in sorted(thinned, key=lambda t: t[0])[:number]:
        pivots.setdefault(size, []).append(point)
    return {size: np.stack(points) for size, points in pivots.items()}


def describe(distinct: DataFrame, pivots: dict[int, np.ndarray], nearest: int = NEAREST, apart: float = close(COSINE)) -> DataFrame:
    """Adds `near`: numbers of the nearest pivots, the nearest first; and `within`: how many have a cosine of `apart` or more.

    A vector of a dimension without pivots has the one list 0, which finds it as the index would.
    """
    shared = distinct.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        for batch in batches:
            data = batch.column("data").to_pylist()
            near, within = [[0]] * len(data), [0] * len(data)
            for size, points in shared.value.items():
                own = [i for i, d in enumerate(data) if len(d) == 8 * size]
                for k in range(0, len(own), CHUNK):
                    rows = own[k : k + CHUNK]
                    cosines = unit([data[i] for i in rows]) @ points.T
                    order = np.argsort(-cosines, axis=1, kind="stable")[:, :nearest]
                    there = (np.take_along_axis(cosines, order, axis=1) >= apart).sum(axis=1)
                    for i, o, n in zip(rows, order.tolist(), there.tolist()):
                        near[i], within[i] = o, n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.list_(pa.int32())), pa.array(within, pa.int32())], names=[*batch.schema.names, "near", "within"])

    return distinct.mapInArrow(run, "id long, label string, data binary, size int, copies long, near array<int>, within int")


def _links(shared: int, cosine: float):
    """Links of two chunks of an inverted list: for each linked vector its links and the least id of its group.

    A pivot that both vectors are close to counts as `shared` of them, for near copies of a vector
    differ in their further pivots.
    """

    strong = float(np.ceil(shared**0.5))  # its square is `shared` at least

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        pivot, i, j = int(rows["pivot"].iloc[0]), int(rows["i"].iloc[0]), int(rows["j"].iloc[0])
        ids, copies, v = rows["id"].to_numpy(), rows["copies"].to_numpy(), unit(rows["data"])
        marks = np.zeros((len(rows), int(rows["near"].map(max).max()) + 1), np.float32)
        for k, (near, within) in enumerate(zip(rows["near"], rows["within"])):
            marks[k, near] = 1
            marks[k, near[:within]] = strong
        depth = rows["near"].map(len).to_numpy()
        left, right = np.flatnonzero(rows["chunk"] == i), np.flatnonzero(rows["chunk"] == j)
        need = np.minimum(shared, np.minimum(depth[left][:, None], depth[right][None, :]))
        found = (marks[left] @ marks[right].T >= need) & (v[left] @ v[right].T >= cosine)
        a, b = np.nonzero(found)
        a, b = left[a], right[b]
        once = a < b if i == j else a >= 0
        a, b = a[once], b[once]
        if len(a):
            first = np.concatenate([(marks[a[k : k + 4096]] * marks[b[k : k + 4096]]).argmax(axis=1) for k in range(0, len(a), 4096)]) == pivot
            a, b = a[first], b[first]  # a pair counts in the list of its first shared pivot alone
        links = np.zeros(len(rows), np.int64)
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        least = ids.copy()
        while True:
            before = least.copy()
            np.minimum.at(least, a, before[b])
            np.minimum.at(least, b, before[a])
            if (least == before).all():
                break
        at = np.flatnonzero(links)
        return pd.DataFrame({"a": ids[at], "b": least[at], "links": links[at]})

    return run


def near_duplicates(vectors: DataFrame, vec: str = "vec_id", embedding: str = "embedding", label: str = "label", cosine: float = COSINE, pivots: int | None = None, nearest: int = NEAREST, shared: int = SHARED) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for each vector.

    Vectors that are null, zero, or hold null or infinite components, and those without a label or
    an id, link with nothing; neither do vectors of different length.  Equal vectors of a label are
    linked.  A repeated id is one vector each time.  A row without an id has no component and is not
    kept.  An empty table gives no rows.
    """
    every = held(entries(vectors, vec, embedding, label))
    known = every.where("data IS NOT NULL")
    distinct = known.groupBy("label", "data").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    distinct = held(distinct.select("id", "label", "data", (F.octet_length("data") / 8).cast("int").alias("size"), "copies"))
    indexed = held(describe(distinct, choose_pivots(distinct, pivots, close(cosine)), nearest, close(cosine)))
    lists = ["label", "size", "pivot"]
    posted = indexed.withColumn("pivot", F.explode("near"))
    chunks = posted.groupBy(lists).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    posted = posted.join(chunks, lists).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    posted = posted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = posted.withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other")).drop("chunks", "other")
    linked = held(met.groupBy(*lists, "i", "j").applyInPandas(_links(shared, cosine), "a long, b long, links long"))
    counts = linked.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    groups = components(linked).withColumnRenamed("node", "id")
    classes = distinct.join(counts, "id", "left").join(groups, "id", "left")
    classes = classes.select("label", "data", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "id").alias("c"))
    found = known.join(classes, ["label", "data"]).select("vec_id", F.col("n").alias("n_links"), F.col("c").alias("component_id"))
    alone = every.where("data IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = found.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    return few_files(every)
