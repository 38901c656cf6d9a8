"""Benchmark search and repeated passages against brute force."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortloom.llm import suffix_repeats, wu_manber

LETTERS = "ab cé \n"


def test_search_equals_brute_force():
    rng = random.Random(1)
    words = [bytes([97 + i]) for i in range(4)]
    for _ in range(200):
        items = [b" ".join(rng.choices(words, k=rng.choice([0, 1, 2, 4, 10, 14]))) for _ in range(rng.randint(0, 4))]
        tables = wu_manber.search_tables(items, 5)
        text = rng.choices(words, k=rng.randint(0, 60))
        spans, found = wu_manber.occurrences(text, tables)
        hit, seen = set(), set()
        for number, item in enumerate(items):
            own = item.split()
            size = min(5, len(own))
            windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
            for i in range(len(text) - size + 1 if size else 0):
                if tuple(text[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    seen.add(number)
        assert {k for a, b in spans for k in range(a, b)} == hit and found == seen


def test_search_edge_cases(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame(
        [(1, f"x, {passage.upper()}! y", "a"), (2, None, "b"), (3, "", "c"), (None, passage, None), (1, "tiny item", "d"), (4, "clean words", "e")],
        "doc_id long, text string, spans string",
    ).withColumn("row", F.lit("clash"))
    bench = spark.createDataFrame([(7, passage), (8, "Tiny"), (9, None), (None, "item"), (10, "..."), (7, passage)], "item_id long, text string")
    for block in (200_000, 1):  # all tables at once, and block after block
        got = {(r["row"]["doc_id"], r["row"]["spans"]): r for r in wu_manber.find_benchmark(docs, bench, block_words=block).collect()}
        assert len(got) == 6
        assert [tuple(s) for s in got[1, "a"]["spans"]] == [(1, 12)] and got[1, "a"]["items"] == ["7"] and got[1, "a"]["n_words"] == 13
        assert got[1, "d"]["items"] == ["8"] and [tuple(s) for s in got[1, "d"]["spans"]] == [(0, 2)]
        assert got[None, None]["items"] == ["7"] and got[1, "a"]["row"]["row"] == "clash"
        assert not got[2, "b"]["spans"] and not got[3, "c"]["spans"] and not got[4, "e"]["spans"]
    assert wu_manber.find_benchmark(docs.limit(0), bench).count() == 0
    assert wu_manber.find_benchmark(docs, bench.limit(0)).where(F.size("spans") > 0).count() == 0


def brute_spans(texts, width):
    count = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    return [suffix_repeats.merged([(i, i + width) for i in range(len(t) - width + 1) if count[t[i : i + width]] > 1]) for t in texts]


def corpus(rng, n):
    shared = ["".join(rng.choices(LETTERS, k=rng.choice([150, 199, 200, 260, 700]))) for _ in range(5)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 3)):
            parts.append("".join(rng.choices(LETTERS, k=rng.randint(0, 300))))
            parts.append(rng.choice(shared) if rng.random() < 0.6 else "z" * rng.randint(0, 260))
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("crowd", [4096, 1])
def test_repeats_equal_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix_repeats, "CROWD", crowd)
    rng = random.Random(crowd)
    texts = [*corpus(rng, 60), "", None, "short", "short", "ß" * 150, "q" + "ß" * 150]
    texts.append(texts[0] + "!")
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, h string")
    got = {r["doc_id"]: r for r in suffix_repeats.removed(docs).collect()}
    raw = [(t or "").encode() for t in texts]
    assert any(brute_spans(raw, 200)) and len(got) == len(texts)
    for i, spans in enumerate(brute_spans(raw, 200)):
        kept = suffix_repeats.kept_bytes(raw[i], spans)
        expected = (len(raw[i]), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
        assert tuple(got[i])[1:] == expected, i


def test_repeat_groups_hold_all_occurrences(spark):
    rng = random.Random(5)
    passage = "".join(rng.choices(LETTERS, k=400))
    texts = ["".join(rng.choices(LETTERS, k=90)) + passage + "".join(rng.choices(LETTERS, k=90)) for _ in range(12)]
    stored, _ = suffix_repeats.distinct_texts(spark.createDataFrame([(t,) for t in texts], "text string"))
    groups = suffix_repeats.find_repeats(stored).groupBy("repeat").agg(F.countDistinct("h").alias("n")).collect()
    assert groups and max(r["n"] for r in groups) == 12


def test_long_text_is_hashed_in_segments(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choices(LETTERS, k=30_000)).encode()
    ((_, whole, keys),) = suffix_repeats.sync_positions([text])
    monkeypatch.setattr(suffix_repeats, "SEGMENT", 1000)
    ((_, cut, cut_keys),) = suffix_repeats.sync_positions([text])
    assert list(whole) == list(cut) and list(keys) == list(cut_keys)


def test_kept_characters_are_whole():
    text = "aéb".encode()
    assert suffix_repeats.kept_characters(text, [(0, 2)]) == "éb"
    assert suffix_repeats.kept_characters(text, [(2, 4)]) == "aé"
    assert suffix_repeats.kept_characters(text, [(1, 3)]) == "ab"


def test_no_rows_no_repeats(spark):
    assert suffix_repeats.removed(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_intervals_of_the_prefix_tree():
    import numpy as np

    # suffixes: aab aac ab b -> common prefixes 2 1 0
    assert list(suffix_repeats.intervals(np.array([0, 2, 1, 0]), 1)) == [(2, 0, 2), (1, 0, 3)]
