"""Fixed-width identity file of the national registry: projection, checks, writing, reading.

Record (1-based): 1-5 type `11099`, 6-18 NIR of the holder, 19-26 birth date yyyymmdd,
27 sex, 28-40 NIR of the person, 41-44 blank, 45-49 project name, 50-69 temporary id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions.clean import day_of_year, zero_padded

# Record types, constant blocks and widths of the file layout.
RECORD_TYPE = "11099"
RECORD_WIDTH = 69
ID_WIDTH = 20
PROJECT_WIDTH = 5
HEADER_START = "00000RG00000000080036CRIP          CN00000000001003SNE800362016183201630520161108EI010000V80036"
HEADER_END = "   0000000000000000000000KMLEI       "
TYPE_LINE = "10001H0000001"
LOT_START = "99001NT_LOT    10001"
TRAILER_START = "99900RG00000000080036CRIP          CN00000000001003SNE800362016183201630520161108EI010000V80036"
TRAILER_MIDDLE = "   0"
TRAILER_END = "000000000000KMLEI       "
FRAME_LINES = 4
REGISTRY_COLUMNS = (
    "NIR_du_beneficiaire",
    "Date_de_naissance",
    "Code_sexe",
    "NIR_du_ouvrant_droit",
    "Identifiant_temporaire",
)
SEX_CODE = "2"


def registry_projection(identity: DataFrame) -> DataFrame:
    """Identity table in the column order of the registry."""
    return identity.select(
        F.col("NNI_2").alias("NIR_du_beneficiaire"),
        F.date_format("date_naiss", "dd/MM/yyyy").alias("Date_de_naissance"),
        F.lit(SEX_CODE).alias("Code_sexe"),
        F.col("NNI_2").alias("NIR_du_ouvrant_droit"),
        F.col("id_random").cast("string").alias("Identifiant_temporaire"),
    )


def dummy_identities(people: DataFrame, column: str, as_of: str) -> DataFrame:
    """Invented identity rows for a trial file: one for each of the people, who are known by a number only."""
    number = F.col(column).cast("bigint")
    i = number.cast("string")
    return people.select(
        number.alias("id_random"),
        F.substring(F.concat(F.lit("2"), i, F.lit("12345678901234")), 1, 13).alias("NNI_2"),
        F.concat(F.lit("nom"), i).alias("nom"),
        F.concat(F.lit("nom_jf"), i).alias("nom_jf"),
        F.concat(F.lit("prenom"), i).alias("prenom"),
        F.date_sub(F.lit(as_of).cast("date"), 20000).alias("date_naiss"),
    )


def identity_checks(people: DataFrame) -> DataFrame:
    """Number of offending rows per rule, in one pass plus the distinct count of the ids."""
    def bad(ok: Column) -> Column:
        return F.count_if(~F.coalesce(ok, F.lit(False)))

    blank = F.lit(False)
    for c in REGISTRY_COLUMNS:
        blank = blank | F.col(c).isNull()
    return people.agg(
        F.count_if(blank).alias("rows_with_null"),
        bad(F.length("NIR_du_beneficiaire") == 13).alias("bad_nir"),
        bad(F.length("NIR_du_ouvrant_droit") == 13).alias("bad_holder_nir"),
        bad(F.col("Date_de_naissance").rlike("^[0-9]{2}/[0-9]{2}/[0-9]{4}$")).alias("bad_date"),
        bad(F.col("Code_sexe").isin("1", "2")).alias("bad_sex"),
        bad(F.length("Identifiant_temporaire").between(1, ID_WIDTH)).alias("bad_id"),
        (F.count("Identifiant_temporaire") - F.countDistinct("Identifiant_temporaire")).alias("repeated_ids"),
    )


def record_line(project: str) -> Column:
    born = F.col("Date_de_naissance")
    padded = F.when(F.length("Identifiant_temporaire") < ID_WIDTH, F.rpad("Identifiant_temporaire", ID_WIDTH, " "))
    line = F.concat(
        F.lit(RECORD_TYPE), F.col("NIR_du_ouvrant_droit"),
        F.substring(born, 7, 10), F.substring(born, 4, 2), F.substring(born, 1, 2),
        F.col("Code_sexe"), F.col("NIR_du_beneficiaire"), F.lit("    "), F.lit(project),
        F.coalesce(padded, F.col("Identifiant_temporaire")),
    )
    return F.when(F.length(line) == RECORD_WIDTH, line).otherwise(
        F.raise_error(F.concat(F.lit("a registry record has a width of "), F.coalesce(F.length(line).cast("string"), F.lit("null"))))
    )


class BadIdentities(ValueError):
    pass


def check_identities(people: DataFrame) -> None:
    """Refuse people whose rows do not fit the layout, naming every broken rule and its rows."""
    found = {k: n for k, n in identity_checks(people).first().asDict().items() if n}
    if found:
        raise BadIdentities(", ".join(f"{k}: {n}" for k, n in sorted(found.items())))


def registry_lines(people: DataFrame, deposit: str, project: str, project_number: str) -> DataFrame:
    """All lines of the file as (ord, sort_key, value): header, type, records, two trailers.

    The count in the trailers is an aggregate of the records; no line passes the driver.
    """
    spark = people.sparkSession
    day = F.to_date(F.lit(deposit), "dd/MM/yyyy")
    stamp = F.concat(F.date_format(day, "yyyy"), day_of_year(day), F.lit(project_number))
    frame = spark.range(1)
    head = frame.select(
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("ord"), F.concat(F.lit(HEADER_START), stamp, F.lit(HEADER_END)).alias("value")),
                F.struct(F.lit(1).alias("ord"), F.lit(TYPE_LINE).alias("value")),
            )
        ).alias("l")
    ).select("l.ord", F.lit("").alias("sort_key"), "l.value")
    records = people.select(
        F.lit(2).alias("ord"), F.col("Identifiant_temporaire").alias("sort_key"), record_line(project).alias("value")
    )
    n = F.col("n")
    lot = F.concat(F.lit(LOT_START), zero_padded(n, 8))
    last = F.concat(
        F.lit(TRAILER_START), stamp, F.lit(TRAILER_MIDDLE), zero_padded(n + FRAME_LINES, 9), F.lit(TRAILER_END)
    )
    tail = (
        people.agg(F.count("*").alias("n"))
        .select(
            F.explode(
                F.array(
                    F.struct(F.lit(3).alias("ord"), lot.alias("value")),
                    F.struct(F.lit(4).alias("ord"), last.alias("value")),
                )
            ).alias("l")
        )
        .select("l.ord", F.lit("").alias("sort_key"), "l.value")
    )
    return head.unionByName(records).unionByName(tail)


def write_registry_file(
    people: DataFrame, path: str, deposit: str, project: str, project_number: str
) -> None:
    """Write the file as ordered parts: joined in name order they are the fixed-width file.

    The range sort spreads the lines over as many tasks as needed; nothing is pulled into
    one task just to have one file.  Rows that break a rule of the layout refuse the whole
    file before anything is written.
    """
    check_identities(people)
    if len(project) != PROJECT_WIDTH:
        raise BadIdentities(f"the project name has {len(project)} characters, not {PROJECT_WIDTH}")
    lines = registry_lines(people, deposit, project, project_number)
    lines.orderBy("ord", "sort_key", "value").select("value").write.mode("overwrite").text(path)


def read_registry_file(spark: SparkSession, path: str) -> DataFrame:
    """(id_random, NNI_2) of the records, by fixed offsets."""
    line = F.col("value")
    return (
        spark.read.text(path)
        .filter(line.startswith(RECORD_TYPE))
        .select(
            F.trim(F.substring(line, 50, ID_WIDTH)).cast("bigint").alias("id_random"),
            F.substring(line, 28, 13).alias("NNI_2"),
        )
    )
