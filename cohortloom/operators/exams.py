"""Imaging appointments per person, matching with screening exams, study lists.

The working form is long: one row per (person, appointment, study UID) with a file
count.  Matching never pairs all exams of a person with all appointments: exams meet a
table that already holds one row per (person, calendar month).  A history is one row per
appointment, whatever its length; nothing gathers a person's whole history.
"""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.clean import month_index
from cohortloom.functions.history import parse_history


def appointments(index: DataFrame) -> DataFrame:
    """(person_id, appointment_ts, uid, files); rows without person or date drop out."""
    return (
        index.dropna(subset=["person_id", "appointment_date"])
        .groupBy(
            "person_id",
            F.col("appointment_date").cast("timestamp_ntz").alias("appointment_ts"),
            F.col("study_instance_uid").alias("uid"),
        )
        .agg(F.count("*").alias("files"))
    )


def history(appts: DataFrame) -> DataFrame:
    """One row per (person_id, appointment_ts) with its sorted UIDs and number of files."""
    return appts.groupBy("person_id", "appointment_ts").agg(
        F.array_sort(F.collect_set("uid")).alias("uids"), F.sum("files").alias("file_count")
    )


def first_appointment(appts: DataFrame) -> DataFrame:
    """(person_id, appointment_ts, uid): the studies of everyone's first appointment."""
    first = appts.groupBy("person_id").agg(F.min("appointment_ts").alias("appointment_ts"))
    return appts.join(first, ["person_id", "appointment_ts"], "left_semi").select("person_id", "appointment_ts", "uid")


def person_summary(appts: DataFrame) -> DataFrame:
    """One row per person: number of appointments, studies and files, first and last date."""
    per_appointment = appts.groupBy("person_id", "appointment_ts").agg(
        F.count("*").alias("uids"), F.sum("files").alias("files")
    )
    return per_appointment.groupBy("person_id").agg(
        F.count("*").alias("dicom_appointments"),
        F.sum("uids").alias("dicom_uids"),
        F.sum("files").alias("dicom_files"),
        F.min("appointment_ts").alias("dicom_first"),
        F.max("appointment_ts").alias("dicom_last"),
    )


def long_from_history(rows: DataFrame, person: str = "person_id") -> DataFrame:
    """History rows to the long form."""
    return rows.select(person, "appointment_ts", F.explode("uids").alias("uid")).distinct()


def long_from_json(texts: DataFrame, text: str, person: str = "person_id") -> DataFrame:
    """JSON texts, of one appointment or of many, to the long form; texts of one person add up."""
    parsed = texts.select(person, F.explode(parse_history(text)).alias("h")).select(person, "h.appointment_ts", "h.uids")
    return long_from_history(parsed, person)


def near_months(appts: DataFrame) -> DataFrame:
    """Per person and calendar month, the earliest (appointment, uid) at most one month away.

    An appointment is offered to three months and reduced again, hence at most one row
    per (person, month) however many appointments a person has.
    """
    monthly = appts.groupBy("person_id", month_index("appointment_ts").alias("month")).agg(
        F.min(F.struct("appointment_ts", "uid")).alias("found")
    )
    around = F.explode(F.array(F.col("month") - 1, F.col("month"), F.col("month") + 1))
    return (
        monthly.select("person_id", around.alias("near_month"), "found")
        .groupBy("person_id", "near_month")
        .agg(F.min("found").alias("found"))
    )


def person_imaging(appts: DataFrame) -> DataFrame:
    """`person_summary` with `near_studies`, a map from calendar month to the study that an exam of that month matches.

    Appointments are reduced to months before they meet in a row, so a map has an entry for each month of
    the calendar at most, however many appointments a person has.  With it an exam finds its study in
    the join that brings its other columns of the person.
    """
    per_appointment = appts.groupBy("person_id", "appointment_ts").agg(
        F.count("*").alias("uids"), F.sum("files").alias("files"), F.min("uid").alias("uid")
    )
    amounts = ("n", "uids", "files")
    monthly = per_appointment.groupBy("person_id", month_index("appointment_ts").alias("month")).agg(
        F.count("*").alias("n"),
        F.sum("uids").alias("uids"),
        F.sum("files").alias("files"),
        F.min(F.struct("appointment_ts", "uid")).alias("found"),
        F.max("appointment_ts").alias("last"),
    )
    offered = monthly.select("*", F.explode(F.array(*[F.lit(k) for k in (-1, 0, 1)])).alias("off"))
    own = F.col("off") == 0
    near = offered.groupBy("person_id", (F.col("month") + F.col("off")).alias("month")).agg(
        *[F.sum(F.when(own, F.col(a))).alias(a) for a in amounts],
        F.min("found").alias("found"),
        F.min(F.when(own, F.col("found.appointment_ts"))).alias("first"),
        F.max(F.when(own, F.col("last"))).alias("last"),
    )
    return near.groupBy("person_id").agg(
        *[F.sum(a).alias(name) for a, name in zip(amounts, ("dicom_appointments", "dicom_uids", "dicom_files"))],
        F.min("first").alias("dicom_first"),
        F.max("last").alias("dicom_last"),
        F.map_from_entries(F.collect_list(F.struct("month", "found.uid"))).alias("near_studies"),
    )


def near_study(date: str) -> Column:
    """The study that `near_studies` has for the month of an exam."""
    return F.try_element_at("near_studies", month_index(date))


def match_studies(
    exams: DataFrame, appts: DataFrame, person: str, date: str, into: str = "DICOM_Study"
) -> DataFrame:
    """Add the first study within one calendar month of the exam; null when there is none."""
    near = near_months(appts).select(
        F.col("person_id").alias("_person"), F.col("near_month").alias("_month"), F.col("found.uid").alias(into)
    )
    hit = (F.col(person) == F.col("_person")) & (month_index(date) == F.col("_month"))
    return exams.join(near, hit, "left").drop("_person", "_month")


def build_studies(
    exams: DataFrame,
    appts: DataFrame,
    person: str,
    pseudonym: str,
    date: str | None = None,
    mode: Literal["all", "last"] = "all",
) -> DataFrame:
    """Distinct (id_random, date, study_id) of the people in the exam table, no nulls.

    With `date`, only appointments within one calendar month of one of the person's exams
    remain.  Mode `last` keeps the last UID of each appointment, `all` keeps every one.
    """
    source = appts
    if mode == "last":
        source = appts.groupBy("person_id", "appointment_ts").agg(F.max("uid").alias("uid"))
    if date is None:
        people = exams.select(F.col(person).alias("person_id"), F.col(pseudonym).alias("id_random"))
        joined = source.join(people.dropna().distinct(), "person_id")
    else:
        people = (
            exams.select(
                F.col(person).alias("person_id"), F.col(pseudonym).alias("id_random"), month_index(date).alias("_m")
            )
            .dropna()
            .distinct()
            .select(
                "person_id", "id_random",
                F.explode(F.array(F.col("_m") - 1, F.col("_m"), F.col("_m") + 1)).alias("month"),
            )
            .distinct()
        )
        joined = source.withColumn("month", month_index("appointment_ts")).join(people, ["person_id", "month"])
    return (
        joined.select("id_random", F.col("appointment_ts").alias("date"), F.col("uid").alias("study_id"))
        .dropna()
        .distinct()
    )


def retrieval_order(exams: DataFrame, appts: DataFrame, person: str, date: str) -> DataFrame:
    """Each study once, at its first place when exams are walked newest first.

    A study is reached through the newest exam of its person, so one row per person is
    enough on the exam side.
    """
    newest = exams.dropna(subset=[person]).groupBy(F.col(person).alias("person_id")).agg(
        F.max(F.to_date(date)).alias("newest")
    )
    place = F.min(
        F.struct((-F.unix_date("newest")).alias("day"), "person_id", "appointment_ts")
    ).alias("place")
    return (
        appts.join(newest, "person_id")
        .groupBy("uid")
        .agg(place)
        .select(
            "uid",
            F.date_from_unix_date(-F.col("place.day")).alias("newest_exam"),
            F.col("place.person_id").alias("person_id"),
            F.col("place.appointment_ts").alias("appointment_ts"),
        )
    )


def mark_history(exams: DataFrame, appts: DataFrame, person: str, into: str = "has_history") -> DataFrame:
    """Add whether the person has an imaging appointment."""
    people = appts.select(F.col("person_id").alias("_person")).distinct().withColumn(into, F.lit(True))
    marked = exams.join(people, F.col(person) == F.col("_person"), "left").drop("_person")
    return marked.withColumn(into, F.coalesce(into, F.lit(False)))


def with_any_study(exams: DataFrame, appts: DataFrame, person: str) -> DataFrame:
    """Exams of people who have at least one imaging appointment."""
    people = appts.select(F.col("person_id").alias(person)).distinct()
    return exams.join(people, person, "left_semi")


def unmatched_people(appts: DataFrame, exams: DataFrame, person: str) -> DataFrame:
    """People with images who are absent from screening."""
    known = exams.select(F.col(person).alias("person_id"))
    return appts.select("person_id").distinct().join(known, "person_id", "left_anti")


def studies_on_any_date(appts: DataFrame, exams: DataFrame, date: str) -> DataFrame:
    """Distinct studies whose day is the day of any exam of the cohort, whoever it belongs to."""
    days = exams.select(F.to_date(date).alias("day")).dropna().distinct()
    return (
        appts.select("uid", F.to_date("appointment_ts").alias("day"))
        .join(days, "day", "left_semi")
        .select("uid")
        .distinct()
    )


def dates_without_study(
    exams: DataFrame, appts: DataFrame, person: str, pseudonym: str, date: str
) -> DataFrame:
    """Exam days with no appointment of the same person on that day, counted per year."""
    wanted = (
        exams.select(
            F.col(pseudonym).alias("id_random"), F.col(person).alias("person_id"), F.to_date(date).alias("day")
        )
        .dropna()
        .distinct()
    )
    held = appts.select("person_id", F.to_date("appointment_ts").alias("day")).distinct()
    return (
        wanted.join(held, ["person_id", "day"], "left_anti")
        .select("id_random", "day")
        .distinct()
        .groupBy(F.year("day").alias("year"))
        .agg(F.count("*").alias("dates"))
    )
