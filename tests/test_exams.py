import datetime as dt
import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from cohortloom.functions import history
from cohortloom.operators import exams, filters
from cohortloom.session import durable_by, staging


def month_gap(a, b):
    return abs((a.year - b.year) * 12 + a.month - b.month)


@pytest.fixture(scope="module")
def world(spark):
    """Random people, one of whom holds a third of all exams and appointments."""
    rng = random.Random(5)
    start = dt.datetime(2015, 1, 1)

    def person():
        return 1 if rng.random() < 0.34 else rng.randint(2, 40)

    appts = [
        (person(), start + dt.timedelta(days=rng.randint(0, 1500), hours=rng.randint(0, 9)), f"u{rng.randint(0, 300)}", f"f{i}")
        for i in range(600)
    ] + [(None, start, "lost", "f")]
    ex = [(i, None if i % 50 == 0 else person(), (start + dt.timedelta(days=rng.randint(0, 1500))).date()) for i in range(400)]
    index = spark.createDataFrame(
        [(p, a.replace(minute=0), u, f) for p, a, u, f in appts],
        "person_id long, appointment_date timestamp_ntz, study_instance_uid string, file_guid string",
    )
    exam_df = spark.createDataFrame(ex, "id_event int, id_bci long, Date_Mammo date")
    return index, exam_df, [(p, a, u) for p, a, u, _ in appts if p], ex


def test_appointments_count_files(world):
    index, _, appts, _ = world
    long = exams.appointments(index)
    assert long.agg(F.sum("files")).first()[0] == len(appts)
    assert long.count() == len(set(appts))


def test_matching_equals_brute_force(world):
    index, exam_df, appts, ex = world
    got = {r.id_event: r.DICOM_Study for r in exams.match_studies(exam_df, exams.appointments(index), "id_bci", "Date_Mammo").collect()}
    assert len(got) == len(ex)
    for event, person, day in ex:
        near = sorted((a, u) for p, a, u in appts if p == person and month_gap(a, day) <= 1)
        assert got[event] == (near[0][1] if near else None)


@pytest.mark.parametrize("size", [201, 50_001])
def test_long_histories_are_whole(spark, size):
    day = dt.datetime(2020, 1, 1)
    index = spark.range(size).select(
        F.lit(1).cast("long").alias("person_id"),
        F.timestamp_add("HOUR", (F.col("id") % (size // 3)).cast("int"), F.lit(day)).cast("timestamp_ntz").alias("appointment_date"),
        F.concat(F.lit("u"), "id").alias("study_instance_uid"),
    )
    appts = exams.appointments(index)
    held = exams.history(appts)
    assert held.count() == held.select("person_id", "appointment_ts").distinct().count() == size // 3
    assert held.agg(F.sum(F.size("uids"))).first()[0] == held.agg(F.sum("file_count")).first()[0] == size
    first = {r.uid for r in exams.first_appointment(appts).collect()}
    assert first == {f"u{k}" for k in range(0, size, size // 3)}
    text = history.appointment_json("appointment_ts", "uids", "file_count")
    back = exams.long_from_json(held.select("person_id", text.alias("j")), "j")
    assert back.exceptAll(appts.select("person_id", "appointment_ts", "uid")).count() == 0 and back.count() == size


def test_mark_history(world):
    index, exam_df, appts, ex = world
    people = {p for p, _, _ in appts}
    marked = {r.id_event: r.has_history for r in exams.mark_history(exam_df, exams.appointments(index), "id_bci").collect()}
    assert marked == {event: person in people for event, person, _ in ex}


def test_json_round_trip(world):
    index, _, _, _ = world
    appts = exams.appointments(index)
    text = history.appointment_json("appointment_ts", "uids", "file_count")
    texts = exams.history(appts).select("person_id", text.alias("j"))
    assert texts.first().j.startswith('{"20')
    assert rows(exams.long_from_json(texts, "j")) == rows(appts.select("person_id", "appointment_ts", "uid"))


@pytest.mark.parametrize("near", [False, True])
@pytest.mark.parametrize("mode", ["all", "last"])
def test_study_lists_equal_brute_force(world, near, mode):
    index, exam_df, appts, ex = world
    held = set(appts)
    if mode == "last":
        best = {}
        for p, a, u in held:
            best[p, a] = max(best.get((p, a), ""), u)
        held = {(p, a, u) for (p, a), u in best.items()}
    want = set()
    for _, person, day in ex:
        want |= {(p * 10, a, u) for p, a, u in held if p == person and (not near or month_gap(a, day) <= 1)}
    people = exam_df.withColumn("id_random", F.col("id_bci") * 10)
    got = exams.build_studies(
        people, exams.appointments(index), "id_bci", "id_random", "Date_Mammo" if near else None, mode
    )
    assert rows(got) == sorted(want, key=repr)


def test_retrieval_order(world):
    index, exam_df, appts, ex = world
    seen, want = set(), {}
    newest_first = sorted((e for e in ex if e[1]), key=lambda e: (-e[2].toordinal(), e[1]))
    for _, person, day in newest_first:
        for a, u in sorted((a, u) for p, a, u in appts if p == person):
            if u not in seen:
                seen.add(u)
                want[u] = day
    got = {r.uid: r.newest_exam for r in exams.retrieval_order(exam_df, exams.appointments(index), "id_bci", "Date_Mammo").collect()}
    assert got == want


def test_dates_without_study(world):
    index, exam_df, appts, ex = world
    held = {(p, a.date()) for p, a, _ in appts}
    want = {}
    for p, day in {(p, day) for _, p, day in ex if p and (p, day) not in held}:
        want[day.year] = want.get(day.year, 0) + 1
    out = exams.dates_without_study(exam_df.withColumn("r", F.col("id_bci")), exams.appointments(index), "id_bci", "r", "Date_Mammo")
    assert {r.year: r.dates for r in out.collect()} == want


def test_no_pairing_of_exams_and_appointments(world):
    index, exam_df, _, _ = world
    text = plan(exams.match_studies(exam_df, exams.appointments(index), "id_bci", "Date_Mammo"))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_filters(spark):
    data = [
        (1, "5", "1", "1", "1", True, 69, True, "u"), (2, "1", "1", "1", "1", True, 69, True, None),
        (3, "1", "1", "1", "5", False, 70, False, "u"), (4, "1", None, "1", "5", None, 69, True, "u"),
    ]
    df = spark.createDataFrame(
        data, "id int, L1_ACR_SD string, L1_ACR_SG string, L2_ACR_SD string, L2_ACR_SG string, L1L2_positif boolean, "
        "Age_Mammo int, has_history boolean, DICOM_Study string",
    )
    assert rows(filters.apply_filter(df), "id") == [(1,), (2,), (4,)]
    assert rows(filters.apply_filter(df, "GET_ACR5"), "id") == [(1,), (4,)]
    assert rows(filters.apply_filter(df, "GET_POSITIVE_WITH_IMG_ONLY"), "id") == [(1,)]
    assert rows(filters.apply_filter(df, "L1L2_positif", "True"), "id") == [(1,), (2,)]
    assert rows(filters.apply_filter(df, "L1L2_positif", "False"), "id") == []
    assert rows(filters.apply_filter(df, "L1_ACR_SD", "1"), "id") == [(2,), (4,)]
    assert rows(filters.test_cohort(df), "id") == [(1,), (4,)]


def test_person_imaging_is_summary_and_match(spark):
    rng = random.Random(4)
    data = [(p, f"20{rng.randint(18, 20)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", f"u{rng.randint(0, 40)}") for p in (1, 1, 1, 2, 3) for _ in range(25)]
    index = spark.createDataFrame(data, "person_id long, d string, study_instance_uid string").withColumn("appointment_date", F.to_date("d"))
    appts = exams.appointments(index)
    people = exams.person_imaging(appts)
    assert rows(people.drop("near_studies")) == rows(exams.person_summary(appts).select(*people.drop("near_studies").columns))
    asked = spark.range(60).select(
        (F.col("id") % 4 + 1).alias("id_bci"), "id", F.add_months(F.lit("2017-10-15").cast("date"), F.col("id").cast("int")).alias("Date_Mammo")
    ).union(spark.sql("SELECT 1L, 99L, CAST(NULL AS DATE)"))
    want = exams.match_studies(asked, appts, "id_bci", "Date_Mammo")
    got = asked.join(people.withColumnRenamed("person_id", "id_bci"), "id_bci", "left").withColumn("DICOM_Study", exams.near_study("Date_Mammo"))
    assert rows(got, "id", "DICOM_Study") == rows(want, "id", "DICOM_Study")


def test_tables_stored_by_person_need_no_exchange(spark):
    tables = lambda: {t.name for t in spark.catalog.listTables()}
    before = tables()
    with staging(spark):
        left = durable_by(spark.range(100).select((F.col("id") % 10).alias("p"), "id"), "p")
        right = durable_by(spark.range(10).select(F.col("id").alias("p")), "p")
        joined = left.hint("merge").join(right, "p").groupBy("p").count()
        assert "Exchange" not in plan(joined)
        assert rows(joined) == [(i, 10) for i in range(10)]
        assert len(tables()) == len(before) + 2
    assert tables() == before
