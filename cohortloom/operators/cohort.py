"""Cohort joins: exam star, refusals, pseudonymised and identity tables."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators import keys
from cohortloom.spec import IDENTITY_COLUMNS, PUBLISHED, describe


def add_mapping(population: DataFrame, mapping: DataFrame, order_by: Sequence[str] = ("id_random",)) -> DataFrame:
    """Give each person the random id of the mapping table, whose key is forced first."""
    unique = keys.force_key(mapping, "id_bci", order_by).select("id_bci", "id_random")
    return population.join(unique, "id_bci", "left")


def refusing_people(population: DataFrame, refusals: DataFrame, column: str = "NIR") -> DataFrame:
    """Random ids of the people on the refusal list."""
    listed = refusals.select(F.col(column).alias("NNI_2")).dropna().distinct()
    return population.join(listed, "NNI_2", "left_semi").select("id_random")


def without_refusals(df: DataFrame, refusing: DataFrame) -> DataFrame:
    """Drop refusing people; rows without an id stay."""
    return df.join(refusing.select("id_random").dropna().distinct(), "id_random", "left_anti")


def code_labels(follow_up: DataFrame, codes: DataFrame) -> DataFrame:
    """The rows of a follow-up with the labels of their two lesion codes."""
    first = codes.select(F.col("code_adicap"), F.col("adicap"))
    second = codes.select(F.col("code_adicap").alias("code_adicap2"), F.col("adicap").alias("adicap2"))
    labelled = follow_up.join(first, F.col("k_adicap") == F.col("code_adicap"), "left")
    return labelled.join(second, F.col("k_adicap2") == F.col("code_adicap2"), "left")


def with_people(exams: DataFrame, population: DataFrame, imaging: DataFrame) -> DataFrame:
    """Exams with the columns of their person and of the person's imaging, one shuffle for both."""
    named = exams.join(population.drop("num_ref", "id_assure"), "id_bci", "left")
    return named.join(imaging.withColumnRenamed("person_id", "id_bci"), "id_bci", "left")


def exam_star(
    screening: DataFrame,
    follow_up: DataFrame,
    risk: DataFrame,
    codes: DataFrame,
    population: DataFrame,
    imaging: DataFrame,
    links: Sequence[str] | None = None,
    chosen: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Screening exams with follow-up, risk, both lesion codes, person and imaging columns.

    Every right side has a unique key, so the row count is that of `screening`; a null key
    matches nothing.  The labels of lesion codes are looked up for the rows of the follow-up, before
    these meet the far wider rows of the exams.  What has the key of the exam is joined next, in the
    partitioning that forcing that key has left; then the exams are shuffled by person once, for both
    tables of people, which need no exchange where they are stored by person.  Adaptive execution can
    split the exam side when one person holds many exams.

    With `links` the exams have a unique key too, `id_event`, without nulls: people and labels are looked up for
    narrow rows, with these columns of the exams and the codes alone, and the wide rows are joined with them by
    `id_event` at the end.  So no wide row is shuffled by person or code, nor by what `chosen` does to the narrow
    exams, which may leave some of them out.
    """
    ids = ("num_ref", "id_assure", "id_bci", "Date_Mammo")
    follow, risks = follow_up.drop(*ids), risk.drop(*ids)
    if links is None:
        joined = screening.join(code_labels(follow, codes), "id_event", "left").join(risks, "id_event", "left")
        return with_people(joined, population, imaging)
    exams = with_people(screening.select(*links), population, imaging)
    labels = code_labels(follow.select("id_event", "k_adicap", "k_adicap2"), codes)
    details = screening.drop(*[c for c in links if c != "id_event"])
    return (
        details.join(follow.drop("k_adicap", "k_adicap2"), "id_event", "left")
        .join(risks, "id_event", "left")
        .join(chosen(exams) if chosen else exams, "id_event")
        .join(labels, "id_event", "left")
    )


def publish(star: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Published columns in published order, each with description and sensitivity metadata.

    Identifying columns are left out because only published ones are selected; the names
    in `extra` are passed on as they are.
    """
    present = set(star.columns)
    return star.select(
        *[
            F.col(source).alias(name, metadata={"description": describe(name), "sensitivity": kind})
            for source, name, kind in PUBLISHED
            if source in present
        ],
        *extra,
    )


def columns_of_class(df: DataFrame, *classes: str) -> list[str]:
    """Names of the columns whose metadata carries one of the sensitivity classes."""
    return [f.name for f in df.schema.fields if f.metadata.get("sensitivity") in classes]


def hide_classes(df: DataFrame, *classes: str) -> DataFrame:
    return df.drop(*columns_of_class(df, *classes))


def column_metadata(df: DataFrame) -> DataFrame:
    """Description and sensitivity of the columns, as a small table (one row per column)."""
    rows = [
        (f.name, f.metadata.get("description", ""), f.metadata.get("sensitivity", ""))
        for f in df.schema.fields
    ]
    return df.sparkSession.createDataFrame(rows, "column string, description string, sensitivity string")


def identity_table(population: DataFrame) -> DataFrame:
    """People with random id, national number and its key."""
    names = [c for c in IDENTITY_COLUMNS if c in population.columns]
    return population.select(*names).dropna(subset=["id_random", "NNI_2", "NNI_2_cle"])


def correspondence_table(population: DataFrame) -> DataFrame:
    return population.select("id_random", "id_bci")


def mail_table(population: DataFrame, refusing: DataFrame | None = None) -> DataFrame:
    """Distinct addresses; people on the refusal list are left out when it is given."""
    people = population if refusing is None else without_refusals(population, refusing)
    return people.select("email").dropna().distinct()


def rebuilt_versus_source(
    source: DataFrame,
    published: DataFrame,
    correspondence: DataFrame,
    identity: DataFrame,
    measure: str,
    order_by: Sequence[str],
) -> DataFrame:
    """Full outer comparison of a measure by (NNI_2, Date_Mammo), source against rebuilt.

    `source` has NNI_2, Date_Mammo and the measure; the rebuilt side goes from the
    published table through correspondence and identity.  Both sides keep one row per key.
    """
    on = ["NNI_2", "Date_Mammo"]
    people = correspondence.select("id_random").join(identity.select("id_random", "NNI_2"), "id_random", "left")
    rebuilt = published.join(people, "id_random", "left")
    left = keys.keep_last(source, on, order_by).select(
        F.col("NNI_2").alias("number_o"), F.col("Date_Mammo").alias("date_o"),
        F.col(measure).alias("original"), F.lit(True).alias("has_o"),
    )
    right = keys.keep_last(rebuilt, on, order_by).select(
        F.col("NNI_2").alias("number_r"), F.col("Date_Mammo").alias("date_r"),
        F.col(measure).alias("rebuilt"), F.lit(True).alias("has_r"),
    )
    same = F.col("number_o").eqNullSafe(F.col("number_r")) & F.col("date_o").eqNullSafe(F.col("date_r"))
    return left.join(right, same, "full_outer").select(
        F.coalesce("number_o", "number_r").alias("NNI_2"),
        F.coalesce("date_o", "date_r").alias("Date_Mammo"),
        "original",
        "rebuilt",
        F.col("has_o").isNotNull().alias("in_source"),
        F.col("has_r").isNotNull().alias("in_rebuilt"),
    )


def round_trip(comparison: DataFrame) -> DataFrame:
    """Share of rows rebuilt, share of rebuilt rows that are equal (null equals nothing)."""
    equal = F.coalesce(F.col("original") == F.col("rebuilt"), F.lit(False))
    counts = comparison.agg(
        F.count_if("in_source").alias("source_rows"),
        F.count_if("in_rebuilt").alias("rebuilt_rows"),
        F.count_if(equal).alias("equal_rows"),
    )
    return counts.select(
        "*",
        F.try_divide(100 * F.col("rebuilt_rows"), F.col("source_rows")).alias("rebuilt_pct"),
        F.try_divide(100 * F.col("equal_rows"), F.col("rebuilt_rows")).alias("equal_pct"),
    )


def refusal_leaks(identity: DataFrame, refusals: DataFrame, column: str = "NIR") -> DataFrame:
    """Number of people on the refusal list still in the identity table."""
    listed = refusals.select(F.col(column).alias("NNI_2")).dropna().distinct()
    return identity.join(listed, "NNI_2", "left_semi").agg(F.count("*").alias("leaks"))
