import hashlib
import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from cohortloom.functions.uids import pseudo_uid, shard_of
from cohortloom.operators import numbering, shard
from cohortloom.operators.numbering import number_rows, permutation_ids
from cohortloom.session import durable
from cohortloom.sources.cohort_list import prepare_cohort


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(1)
    data = [("hot" if i % 3 == 0 else f"g{rng.randint(0, 5)}" if i % 7 else None, f"k{rng.randint(0, 10**6):07d}", rng.randint(1, 9)) for i in range(900)]
    data = list({d[1]: d for d in data}.values())
    return data, spark.createDataFrame(data, "g string, k string, size int")


def test_global_positions_and_totals(items):
    data, df = items
    got = rows(number_rows(df, ["k"], value="size", pieces=7), "k", "position", "running_total")
    want, total = [], 0
    for i, (_, k, size) in enumerate(sorted(data, key=lambda d: d[1])):
        total += size
        want.append((k, i + 1, total))
    assert got == want


def test_positions_per_group(items):
    data, df = items
    got = {(r.g, r.k): r.position for r in number_rows(df, ["k"], ["g"], pieces=5).collect()}
    want, seen = {}, {}
    for g, k, _ in sorted(data, key=lambda d: d[1]):
        seen[g] = seen.get(g, 0) + 1
        want[g, k] = seen[g]
    assert got == want


@pytest.mark.parametrize("most", [0, 1, 700, 2500, 10**9])
def test_first_rows_by_total(spark, items, monkeypatch, most):
    for name, n in (("RANGES", 4), ("DRAWN", 3), ("CLOSE", 20)):
        monkeypatch.setattr(numbering, name, n)
    written = []
    monkeypatch.setattr(numbering, "durable", lambda df, label: written.append(durable(df, label)) or written[-1])
    data, df = items
    got = rows(numbering.first_by_total(df, ["g", "k"], "size", most), "k", "position", "running_total")
    want, total = [], 0
    for i, (_, k, size) in enumerate(sorted(data, key=lambda d: (d[0] or "", d[1]))):
        total += size
        if total <= most:
            want.append((k, i + 1, total))
    assert got == sorted(want, key=repr)
    if most < 10**9:  # no full copy: what was written is what is taken and a last narrow range
        assert written[0].count() <= len(want) + 120


def test_first_rows_of_equal_keys(spark, monkeypatch):
    monkeypatch.setattr(numbering, "CLOSE", 5)
    same = spark.range(50).select(F.lit("k").alias("k"), F.lit(2).alias("size"))
    assert numbering.first_by_total(same, ["k"], "size", 21).count() == 10
    assert numbering.first_by_total(same.limit(0), ["k"], "size", 21).count() == 0


def test_sizes_decide_pieces(spark, tmp_path, monkeypatch):
    spark.range(4000).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert numbering.pieces_for(table) == 1
    monkeypatch.setattr(numbering, "PIECE_BYTES", 1000)
    assert 3 < numbering.pieces_for(table) < 100
    assert rows(number_rows(table, ["id"]), "id", "position") == rows(table.select("id", F.col("id") + 1))


def test_permutation(spark):
    df = spark.range(3000).select(F.col("id").alias("id_bci"))
    out = permutation_ids(df.union(df), "id_bci", "salt")
    ids = [r.id_random for r in out.orderBy("id_bci").collect()]
    assert sorted(ids) == list(range(3000)) and ids != list(range(3000))
    assert rows(out) == rows(permutation_ids(df, "id_bci", "salt"))


@pytest.mark.parametrize("n", [1, 4, 7, 1000])
def test_shard_equals_whole_number_arithmetic(spark, n):
    uids = [f"1.2.840.{i}" for i in range(60)]
    df = spark.createDataFrame([(u,) for u in uids], "u string").withColumn("s", shard_of("u", n))
    want = {u: int(hashlib.sha512(u.encode()).hexdigest(), 16) % n for u in uids}
    assert {r.u: r.s for r in df.collect()} == want


def test_pseudo_uid(spark):
    df = spark.createDataFrame([(1, "1.2"), (2, "1.2"), (1, "1.3"), (1, None)], "i long, u string")
    out = [r[0] for r in df.select(pseudo_uid("i", "u", "2.25")).collect()]
    assert out[3] is None and len(set(out[:3])) == 3
    digest = hashlib.sha256(b"1|1.2").hexdigest()
    assert out[0] == f"2.25.{int(digest[:15], 16)}.{int(digest[15:30], 16)}"
    assert all(len(u) <= 64 for u in out[:3])


def test_resume_by_position(spark, items):
    _, df = items
    sharded = shard.with_shard(df.select(F.col("k").alias("study_id")), 3)
    progress = spark.createDataFrame([(0, 5), (2, 10**6)], "shard long, uploaded long")
    left = shard.remaining_after(sharded, progress)
    per = {r.shard: r["count"] for r in sharded.groupBy("shard").count().collect()}
    got = {r.shard: r["count"] for r in left.groupBy("shard").count().collect()}
    assert got == {0: per[0] - 5, 1: per[1]}
    assert left.filter("shard = 0").agg(F.min("position")).first()[0] == 6


def test_resume_patch_is_idempotent(spark):
    studies = spark.createDataFrame([(f"s{i}",) for i in range(6)], "study_id string")
    written = spark.createDataFrame([("s0", 1), ("s0", 2), ("s1", 1), ("s2", 1)], "study_id string, image int")
    todo, kept = shard.resume_patch(studies, written, "study_id", ["study_id"])
    assert rows(todo) == [("s2",), ("s3",), ("s4",), ("s5",)] and rows(kept) == [("s0", 1), ("s0", 2), ("s1", 1)]
    nothing, _ = shard.resume_patch(studies, written.limit(0), "study_id", ["study_id"])
    assert nothing.count() == 6


def test_progress_batch_and_pages(spark):
    studies = spark.createDataFrame([(f"s{i}", i % 2, 10) for i in range(10)], "study_id string, shard int, size long")
    done = spark.createDataFrame([("s0",), ("s1",), ("s2",), ("s2",)], "study_id string")
    assert rows(shard.shard_progress(studies, done)) == [(0, 5, 2, 3), (1, 5, 1, 4)]
    assert rows(shard.not_done(studies, done), "study_id") == [(f"s{i}",) for i in range(3, 10)]
    assert shard.next_batch(studies, ["study_id"], "size", 4, 1000).count() == 4
    assert shard.next_batch(studies, ["study_id"], "size", 0, 75, 10).count() == 6
    assert shard.next_batch(studies, ["study_id"], "size", 0, 5).count() == 0
    assert rows(shard.page_of(studies, ["study_id"], 4).groupBy("page").count()) == [(0, 4), (1, 4), (2, 2)]


def test_cohort_list(spark):
    raw = spark.createDataFrame(
        [(70, "04/03/21", "01/02/19", "Oui", "S70", "A70"), (12, "05/03/21", "02/02/19", "Non", "S12", "A12")],
        ["BCI", "Date MG Expér Inca", "Date MG Antériorité", "Antériorité", "study_id", "ant_study_id"],
    )
    df = prepare_cohort(raw)
    assert rows(df, "idFemme", "study_id", "ant_study_id", "source_study_id") == [
        (1, "1_050321", "1_020219", "S12"), (2, "2_040321", "2_010219", "S70"),
    ]
    assert rows(shard.expand_cohort(df)) == [(1, "primary", "S12"), (2, "primary", "S70"), (2, "prior", "A70")]


def test_numbering_has_no_single_task_window(items):
    _, df = items
    text = plan(number_rows(df, ["k"]))
    # the only window without partition is the one over the sizes of the pieces
    assert text.count("SinglePartition") <= 1
