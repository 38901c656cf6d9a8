"""Jaccard join and vector index against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import graph, jaccard_join, pivot_index
from cohortloom.operators import sieve


def brute_components(sets, percent=80):
    n = len(sets)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


def edited(rng, words, vocabulary):
    out = list(words)
    for _ in range(rng.randint(0, max(1, len(out) // 30))):
        out[rng.randrange(len(out))] = rng.choice(vocabulary)
    return out


def corpus(rng):
    vocabulary = [f"w{i}" for i in range(400)]
    line = "the same line in very many documents of this table".split()
    texts = []
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.choice([1, 3, 5, 7, 12, 30, 80, 300]))
        if rng.random() < 0.5:
            base += line
        for _ in range(rng.choice([1, 1, 2, 6, 14])):
            texts.append(" ".join(edited(rng, base, vocabulary)))
    return texts


@pytest.mark.parametrize(
    "settings",
    [{}, {"SHORT": 2, "BLOCK": 4, "FREQUENT": 0.02}, {"SHORT": 3, "BLOCK": 512, "FREQUENT": 0.3}, {"SHARE": 500}, {"SHARE": 300, "SHORT": 4}],
)
def test_join_equals_brute_force(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(jaccard_join, name, value)
    texts = [*corpus(random.Random(len(settings))), "", None, " \t", "One", "one", "A b"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, class string")
    got = {r["doc_id"]: r for r in jaccard_join.similar(docs).collect()}
    sets = [jaccard_join.exact_set((t or "").encode()) for t in texts]
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, brute_components(sets)))}


def test_similar_sets_share_a_key():
    rng = np.random.default_rng(2)
    for n in [1, 2, 3, 4, 5, 6, 7, 8, 10, 13, 15, 16, 17, 25, 31, 33, 60, 64, 130, 255, 257, 700]:
        for _ in range(60):
            x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            gone = rng.integers(0, n // 5 + 1)
            new = rng.integers(0, n // 5 + 1)
            y = np.unique(np.concatenate([rng.permutation(x)[gone:], rng.integers(0, 1 << 63, new, dtype=np.uint64)]))
            both = len(np.intersect1d(x, y))
            often = np.sort(rng.permutation(x)[: rng.integers(0, len(x) + 1)])
            if 100 * both >= 80 * (len(x) + len(y) - both):
                (a, need_a), (b, need_b) = jaccard_join.keys_of(x, often), jaccard_join.keys_of(y, often)
                assert len(np.intersect1d(a, b)) >= min(need_a, need_b) >= 1


def test_a_pair_is_named_by_few_tasks(spark, monkeypatch):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(4000)]
    texts = []
    for _ in range(40):
        words = rng.choices(vocabulary, k=300)
        texts += [" ".join(words), " ".join([*words[:150], "changed", *words[151:]])]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    tasks, none = 12, np.zeros(0, np.uint64)
    met = jaccard_join._candidates(jaccard_join._keyed(docs, none, tasks, "text", 5, 80), tasks, 80).where("fits").groupBy("a", "b").count()
    rows = [r["count"] for r in met.collect()]
    assert len(rows) >= 40
    assert sum(rows) < 2 * 40


def test_keys_take_few_bytes_however_many_tasks(spark):
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(4000)}" for _ in range(400)) for _ in range(60)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    keys = sum(len(jaccard_join.keys_of(s, np.zeros(0, np.uint64))[0]) for t in texts for s in jaccard_join.shingle_sets([t.encode()]))
    for tasks in (3, 400):
        keyed = jaccard_join._keyed(docs, np.zeros(0, np.uint64), tasks, "text", 5, 80)
        dealt = keyed.select(sum(F.octet_length(c) for c in keyed.columns if c != "task").alias("n")).agg(F.sum("n")).first()[0]
        assert dealt <= 14 * keys


def test_levels_never_lose_a_pair():
    counts = [*range(1, 700), 12_345, 200_000, 10**7]
    names = np.array([jaccard_join._named(bytes(16), n, n) for n in counts], np.uint64)
    assert all(jaccard_join.LEVELS[int(x) & 255] <= n for x, n in zip(names, counts))
    for n, x in zip(counts, names):
        fits = jaccard_join._fitting(np.full(len(names), x), names, 80)
        assert all(f or 100 * min(n, m) < 80 * max(n, m) for f, m in zip(fits, counts))


@pytest.mark.parametrize("words", [1, 1 << 10])
def test_lone_documents_stay_where_they_are(spark, monkeypatch, words):
    monkeypatch.setattr(sieve, "SIEVE", words)
    base = "one two three four five six seven eight nine ten eleven twelve".split()
    rows = [(9, " ".join(base)), (4, " ".join(base)), (4, " ".join(base)), (None, " ".join(base).upper()), (2, "alone here"), (None, "also alone"), (3, None), (3, None)]
    kept = jaccard_join.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted([(4, " ".join(base)), (2, "alone here"), (None, "also alone"), (3, None), (3, None)], key=repr)


def test_shingles_match_words():
    texts = [b"a b c d e f", b"", b"A  B c", b"a b c d e a b c d e", b"\n x" * 700]
    for text, own in zip(texts, jaccard_join.shingle_sets(texts)):
        assert len(own) == len(jaccard_join.exact_set(text))
    assert (jaccard_join.shingle_sets([b"a b C d e"])[0] == jaccard_join.shingle_sets([b"zz", b"A b c d  e"])[1]).all()


def test_join_edge_rows(spark):
    docs = spark.createDataFrame([(None, "same text"), (None, "same text"), (5, "Same  text"), (5, "same text"), (9, None)], "doc_id long, text string")
    rows = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.similar(docs).collect()]
    assert sorted(rows, key=repr) == sorted([(None, 1, 5), (None, 1, 5), (5, 1, 5), (5, 1, 5), (9, 0, 9)], key=repr)
    assert jaccard_join.similar(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 199), (199, 200)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and all(got[k] == 100 for k in range(100, 130)) and got[200] == got[199] == 199


def vectors(rng):
    rows = []
    for c in range(30):
        centre = rng.standard_normal(24)
        for _ in range(rng.integers(1, 12)):
            rows.append(((centre + 0.12 * rng.standard_normal(24)).astype(np.float32).tolist(), int(c % 3)))
    return rows


@pytest.mark.parametrize("chunk", [1024, 8])
def test_index_finds_brute_force_links(spark, monkeypatch, chunk):
    monkeypatch.setattr(pivot_index, "CHUNK", chunk)
    rows = vectors(np.random.default_rng(4))
    rows += rows[:5]
    df = spark.createDataFrame([(i, v, g, "z") for i, (v, g) in enumerate(rows)], "vec_id long, embedding array<float>, label int, data string")
    got = {r["vec_id"]: r for r in pivot_index.near_duplicates(df).collect()}
    v = np.array([r[0] for r in rows], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    label = np.array([r[1] for r in rows])
    linked = (v @ v.T >= 0.93) & (label[:, None] == label[None, :]) & ~np.eye(len(rows), dtype=bool)
    counts = np.array([got[i]["n_links"] for i in range(len(rows))])
    assert len(got) == len(rows) and (counts <= linked.sum(axis=1)).all()
    assert counts.sum() >= 0.9 * linked.sum()
    for i in range(len(rows)):
        assert got[i]["kept"] == (got[i]["component_id"] == i)


@pytest.mark.parametrize("alike", [0.95, 0.92])
def test_index_finds_links_of_a_hot_group(spark, alike):
    """A third of all distinct vectors are near copies of one."""
    rng = np.random.default_rng(7)
    centre = rng.standard_normal(64)
    hot = centre / np.linalg.norm(centre) + (1 / alike - 1) ** 0.5 / 8 * rng.standard_normal((700, 64))
    v = np.concatenate([hot, rng.standard_normal((1400, 64))])
    df = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in pivot_index.near_duplicates(df, pivots=300).collect()}
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    linked = ((v @ v.T >= 0.93) & ~np.eye(len(v), dtype=bool)).sum(axis=1)
    counts = np.array([got[i] for i in range(len(v))])
    assert linked.sum() > 50000 and (counts <= linked).all() and counts.sum() >= 0.95 * linked.sum()
    assert (counts[linked > 0] > 0).all()


def test_index_edge_rows(spark):
    inf = float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1), (7, [inf, 1.0], 1), (8, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (9, [], 1), (10, [3e38, 0.0], 1), (11, [1e-40, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in pivot_index.near_duplicates(df).collect()), key=repr)
    linked = [(1, 4, 1, True), (1, 4, 1, True), (2, 4, 1, False), (10, 4, 1, False), (11, 4, 1, False)]
    alone = [(k, 0, k, True) for k in (3, 4, 5, 6, 7, 8, 9)] + [(None, 0, None, False)]
    assert got == sorted(linked + alone, key=repr)
    assert pivot_index.near_duplicates(df.where(F.lit(False))).count() == 0
