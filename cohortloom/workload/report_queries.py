"""Queries for reports, pseudonyms, duplicates, shards, sources, sinks and arrivals."""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import spec
from cohortloom.functions import clean
from cohortloom.functions.uids import pseudo_uid
from cohortloom.operators import cohort, duplicates, images, keys, numbering, profile, reports, shard
from cohortloom.plans.catalog import Cohort
from cohortloom.session import scratch_path
from cohortloom.sources import cohort_list, extracts, imaging, inventory, ledger, pages, patches, registry, sinks, store
from cohortloom.streaming import arrivals
from cohortloom.workload.fixtures import Data
from cohortloom.workload.flow_queries import (
    APPTS, EXAMS, FLAGSHIP_CTES, HISTORY_SQL, NEAR, STUDIES_SQL, WITHOUT_STUDY, appts, exam_rows, history_out,
    population_with_ids, round_trip_rows,
    studies, studies_out,
)
from cohortloom.workload.key_queries import GUID_CLEAN, GUID_KEYED, LINK_SQL
from cohortloom.workload.registry import query

ORG_ROOT = "2.25"

# --- profiles -----------------------------------------------------------------------------


def profile_sql(view: str, columns: dict[str, str], limit: int, hidden: tuple[str, ...] = ()) -> str:
    parts = []
    for c, kind in columns.items():
        listing = (
            f"(SELECT string_agg(v || ': ' || CAST(n AS VARCHAR), ', ' ORDER BY n DESC, v) FROM (SELECT CAST({c} AS VARCHAR) AS v, "
            f"count(*) AS n FROM {view} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 10) t)"
        )
        shown = "'undisclosed'" if kind in hidden else f"CASE WHEN count(DISTINCT {c}) < {limit} THEN {listing} ELSE 'undisclosed' END"
        parts.append(
            f"""SELECT '{c}' AS "column", '{kind}' AS type, round(100.0 * (count(*) - count({c})) / count(*), 2) AS empty_pct,
            CAST(count(DISTINCT {c}) AS BIGINT) AS "unique", round(count({c}) / count(DISTINCT {c}), 2) AS avg_repetition,
            {shown} AS "values" FROM {view}"""
        )
    return " UNION ALL ".join(parts)


POPULATION_TYPES = {
    "id_bci": "bigint", "nni_2": "string", "nni_2_cle": "string", "sexe": "string", "nom": "string", "date_naiss": "date",
    "email": "string", "segment": "string",
}


@query("rpt_01_profile", profile_sql("v_population", POPULATION_TYPES, 100, ("date",)))
def _(d):
    return profile.profile(d.v_population, disclose_limit=100, undisclosed_types=["date"])


@query(
    "rpt_01_profile_with_metadata",
    "SELECT p.*, CASE WHEN p.\"column\" = 'email' THEN 'contact' ELSE 'other' END AS description, "
    "CASE WHEN p.\"column\" = 'segment' THEN 'property' ELSE 'pseudonym' END AS sensitivity FROM ("
    + profile_sql("v_population", {k: POPULATION_TYPES[k] for k in ("email", "segment", "nni_2_cle")}, 50) + ") p",
)
def _(d):
    columns = ("email", "segment", "nni_2_cle")
    tagged = d.v_population.select(
        *[
            F.col(c).alias(
                c,
                metadata={
                    "description": "contact" if c == "email" else "other",
                    "sensitivity": "property" if c == "segment" else "pseudonym",
                },
            )
            for c in columns
        ]
    )
    return profile.profile(tagged, disclose_limit=50, metadata=cohort.column_metadata(tagged))


@query(
    "rpt_02_short_profile",
    f"SELECT \"column\", type, empty_pct, \"unique\", avg_repetition FROM ({profile_sql('v_depistage', {'id_event': 'bigint', 'id_bci': 'bigint', 'l1_acr_sd': 'string', 'ecs': 'string', 'resultat_global': 'string'}, 1)}) p",
)
def _(d):
    return profile.short_profile(d.v_depistage, ("id_event", "id_bci", "l1_acr_sd", "ecs", "resultat_global"))


def tag_profile_sql(columns: tuple[str, ...]) -> str:
    parts = []
    for c in columns:
        value = f"nullif(CAST({c} AS VARCHAR), 'None')"
        parts.append(
            f"""SELECT '{c}' AS "column", round(100.0 * (count(*) - count({value})) / count(*), 2) AS empty_pct,
            CAST(count(DISTINCT {value}) AS BIGINT) AS "unique", round(CASE WHEN count(DISTINCT {value}) > 0 THEN count({value}) / count(DISTINCT {value}) END, 2) AS avg_repetition,
            coalesce(substring((SELECT string_agg(v, ', ' ORDER BY n DESC, v) FROM (SELECT {value} AS v, count(*) AS n FROM v_image_meta
            WHERE {value} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 10) t), 1, 100), '') AS samples FROM v_image_meta"""
        )
    return " UNION ALL ".join(parts)


TAG_COLUMNS = ("study_key", "study_uid", "patient_id", "view_code", "laterality", "modality", "annotation", "operator_name")


@query("rpt_03_tag_profile", tag_profile_sql(TAG_COLUMNS))
def _(d):
    return profile.tag_profile(d.v_image_meta.select(*TAG_COLUMNS))


@query(
    "rpt_04_key_quality",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, CAST(coalesce(sum(CASE WHEN {k} IS NULL THEN n ELSE 0 END), 0) AS BIGINT) AS na_rows,
        CAST(coalesce(sum(CASE WHEN {k} IS NOT NULL AND n > 1 THEN n ELSE 0 END), 0) AS BIGINT) AS dup_rows
        FROM (SELECT {k}, count(*) AS n FROM {v} GROUP BY {k}) t"""
        for t, v, k in (("population", "v_population", "nni_2"), ("suivi", "v_suivi", "id_event"), ("mail", "v_population", "email"))
    ),
)
def _(d):
    return reports.key_quality(
        {"population": (d.v_population, "nni_2"), "suivi": (d.v_suivi, "id_event"), "mail": (d.v_population, "email")}
    )


@query(
    "rpt_05_link_coverage",
    f"""SELECT round(100.0 * count(*) FILTER (NOT {LINK_SQL}) / count(*), 4) AS without_link_pct,
    CAST(count(*) FILTER ({LINK_SQL}) AS BIGINT) AS linked,
    round(100.0 * count(*) FILTER ({LINK_SQL} AND mammogram_date IS NOT NULL) / count(*) FILTER ({LINK_SQL}), 4) AS dated_pct FROM g""",
    GUID_CLEAN,
)
def _(d):
    link = clean.long_link("file_guid", "study_instance_uid", "dicom_study_id")
    return reports.link_coverage(imaging.clean_index(d.v_dicom_guid), link, "mammogram_date")


@query("rpt_06_refusal_leaks", "SELECT CAST(count(*) AS BIGINT) AS leaks FROM v_population WHERE nni_2 IN (SELECT nir FROM v_refusals)")
def _(d):
    return cohort.refusal_leaks(population_with_ids(d), d.v_refusals, "nir")


@query(
    "rpt_07_round_trip",
    """SELECT CAST(count(o_h) AS BIGINT) AS source_rows, CAST(count(r_h) AS BIGINT) AS rebuilt_rows,
    CAST(count(*) FILTER (o_acr = r_acr) AS BIGINT) AS equal_rows, round(100 * count(r_h) / count(o_h), 4) AS rebuilt_pct,
    round(100 * count(*) FILTER (o_acr = r_acr) / count(r_h), 4) AS equal_pct
    FROM (SELECT o.h AS o_h, r.h AS r_h, o.acr AS o_acr, r.acr AS r_acr FROM (SELECT * FROM src WHERE rn = 1) o
    FULL OUTER JOIN (SELECT * FROM reb WHERE rn = 1) r ON o.nni_2 IS NOT DISTINCT FROM r.nni_2 AND o.date_mammo IS NOT DISTINCT FROM r.date_mammo) t""",
    FLAGSHIP_CTES + """, src AS (SELECT pop.nni_2, d.date_mammo, d.l1_acr_sg AS acr, 1 AS h,
      row_number() OVER (PARTITION BY pop.nni_2, d.date_mammo ORDER BY d.id_event DESC) AS rn
      FROM v_depistage d LEFT JOIN pop ON d.id_bci = pop.id_bci),
    reb AS (SELECT pop.nni_2, d.date_mammo, d.l1_acr_sg AS acr, 1 AS h,
      row_number() OVER (PARTITION BY pop.nni_2, d.date_mammo ORDER BY d.id_event DESC) AS rn
      FROM v_depistage d LEFT JOIN pop ON d.id_bci = pop.id_bci
      WHERE pop.id_random IS NULL OR pop.id_random NOT IN (SELECT id_random FROM refused))""",
)
def _(d):
    out = cohort.round_trip(round_trip_rows(d))
    return out.withColumns({c: F.round(c, 4) for c in ("rebuilt_pct", "equal_pct")})


REGISTRY_SQL = """reg AS (SELECT p.nni_2 AS nir, strftime(p.date_naiss, '%d/%m/%Y') AS born, CAST(m.id_random AS VARCHAR) AS tmp
  FROM v_population p JOIN v_mapping m ON p.id_bci = m.id_bci WHERE p.nni_2 IS NOT NULL)"""


def registry_people(d: Data) -> DataFrame:
    return registry.registry_projection(
        cohort.identity_table(population_with_ids(d).withColumnRenamed("nni_2_cle", "NNI_2_cle"))
    )


@query(
    "rpt_08_identity_checks",
    """SELECT CAST(0 AS BIGINT) AS rows_with_null, CAST(count(*) FILTER (length(nir) <> 13) AS BIGINT) AS bad_nir,
    CAST(count(*) FILTER (length(nir) <> 13) AS BIGINT) AS bad_holder_nir, CAST(count(*) FILTER (NOT regexp_matches(born, '^[0-9]{2}/[0-9]{2}/[0-9]{4}$')) AS BIGINT) AS bad_date,
    CAST(0 AS BIGINT) AS bad_sex, CAST(count(*) FILTER (length(tmp) > 20) AS BIGINT) AS bad_id, CAST(count(tmp) - count(DISTINCT tmp) AS BIGINT) AS repeated_ids FROM reg""",
    REGISTRY_SQL,
)
def _(d):
    return registry.identity_checks(registry_people(d))


@query(
    "rpt_10_same_tag_sum",
    """SELECT CAST(sum("RelativeXRayExposure_0x00181405") AS DOUBLE) AS before, CAST(sum("RelativeXRayExposure_0x00181405") AS DOUBLE) AS after, true AS equal FROM v_image_meta""",
)
def _(d):
    before = d.v_image_meta
    after = before.withColumn("sop_uid", pseudo_uid("study_key", "sop_uid", ORG_ROOT)).drop("patient_id", "study_uid")
    out = images.same_tag_sum(before, after, "0x00181405")
    return out.select(F.col("before").cast("double").alias("before"), F.col("after").cast("double").alias("after"), "equal")


@query("rpt_11_unmatched_dates_per_year", WITHOUT_STUDY.format(more="AND e.dicom_study IS NULL"), EXAMS)
def _(d):
    from cohortloom.operators import exams

    rows = exams.match_studies(exams.with_any_study(exam_rows(d), appts(d), "id_bci"), appts(d), "id_bci", "Date_Mammo")
    rows = rows.filter(F.col("DICOM_Study").isNull()).join(d.v_mapping, "id_bci")
    out = exams.dates_without_study(rows, appts(d), "id_bci", "id_random", "Date_Mammo")
    return out.withColumn("year", F.col("year").cast("bigint"))


# --- pseudonyms and duplicates ------------------------------------------------------------


@query(
    "pse_01_permutation_ids",
    "SELECT id_bci, CAST(row_number() OVER (ORDER BY md5('pepper' || CAST(id_bci AS VARCHAR)), id_bci) - 1 AS BIGINT) AS id_random FROM v_population",
)
def _(d):
    return numbering.permutation_ids(d.v_population, "id_bci", "pepper")


@query(
    "pse_01_id_ledger",
    """SELECT id_bci, CAST(row_number() OVER (ORDER BY id_bci % 3 <> 0, md5('pepper' || CAST(id_bci AS VARCHAR)), id_bci) - 1 AS BIGINT) AS id_random
    FROM v_population""",
)
def _(d):
    path = scratch_path(d.spark, "ledger")
    ledger.extend_ledger(d.v_population.filter("id_bci % 3 = 0"), path, "id_bci", "pepper")
    return ledger.extend_ledger(d.v_population, path, "id_bci", "pepper")


def cohort_of(d: Data) -> Cohort:
    """The whole cohort over raw extracts shaped from the test tables."""
    return Cohort(
        {n: d.view(f"r_{n}") for n in spec.COHORT_SOURCES},
        d.v_mapping,
        d.v_refusals.withColumnRenamed("nir", "NIR"),
        d.v_dicom_guid,
        imaging_order=("ord",),
    )


YES_SQL = "CASE WHEN {c} IN ('Oui','O','Positif','+','P') THEN 'true' WHEN {c} IN ('Non','N','Négatif','-') THEN 'false' END"
AGE_SQL = (
    "CASE WHEN TRY_CAST(replace({c}, ',', '.') AS DOUBLE) > 0 AND TRY_CAST(replace({c}, ',', '.') AS DOUBLE) < 120 "
    "THEN CAST(floor(TRY_CAST(replace({c}, ',', '.') AS DOUBLE)) AS BIGINT) END"
)
DATE_SQL = "substring({c}, 7, 4) || '-' || substring({c}, 4, 2) || '-' || substring({c}, 1, 2)"


def last_sql(view: str, key: str) -> str:
    return (
        f'(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "{key}" ORDER BY _file DESC, _block DESC, _line DESC) AS rn '
        f'FROM {view} WHERE "{key}" IS NOT NULL) t WHERE rn = 1)'
    )


def typed_sql(alias: str, table: spec.TableSpec) -> dict[str, str]:
    """Cleaned column -> comparison SQL over the raw one."""
    out = {}
    for c in table.columns:
        ref = f'{alias}."{c}"'
        if c in table.one_hot:
            for value, new in table.one_hot[c].items():
                if new:
                    out[new] = f"CASE WHEN {ref} = '{value}' THEN 'true' ELSE 'false' END"
            continue
        rules = (
            (table.flags, YES_SQL), (table.ages, AGE_SQL), (table.dates, DATE_SQL), (table.blanks, "nullif({c}, ' ')"),
            (table.numbers, "CAST(replace({c}, ',', '.') AS DOUBLE)"), (table.integers, "CAST({c} AS BIGINT)"),
        )
        sql = next((s for cols, s in rules if c in cols), "{c}")
        out[table.rename.get(c, c)] = sql.format(c=ref)
    return out


EXAM_COLUMNS = {
    **typed_sql("d", spec.SCREENING),
    **{k: v for k, v in typed_sql("s", spec.FOLLOW_UP).items() if k not in (*spec.IDS, "id_event", "Date_Mammo")},
    **{k: v for k, v in typed_sql("r", spec.RISK).items() if k not in (*spec.IDS, "id_event", "Date_Mammo")},
    # an exam without follow-up has no flag, neither true nor false
    "KS_confirme": """CASE WHEN s."KS_Confirme" = 'KS_confirmé' THEN 'true' WHEN s.rn IS NOT NULL THEN 'false' END""",
    "id_random": "m.id_random",
    "code_adicap": "a.code", "adicap": "a.libelle", "code_adicap2": "a2.code", "adicap2": "a2.libelle",
}
PSEUDO_SQL = (
    "SELECT "
    + ", ".join(f'{EXAM_COLUMNS[source]} AS "{name}"' for source, name, _ in spec.PUBLISHED if source in EXAM_COLUMNS)
    + f""", {AGE_SQL.format(c='r."Age_Mammo"')} AS "Age_Mammo",
    i.n AS dicom_appointments, i.u AS dicom_uids, i.f AS dicom_files, n.uid AS "DICOM_Study", d._line AS "_l"
    FROM {last_sql('r_depistage', 'Id_event')} d LEFT JOIN {last_sql('r_suivi', 'id_event')} s ON s.id_event = d."Id_event"
    LEFT JOIN {last_sql('r_risque', 'id_event')} r ON r.id_event = d."Id_event"
    LEFT JOIN r_adicap a ON s.k_adicap = a.code LEFT JOIN r_adicap a2 ON s.k_adicap2 = a2.code
    LEFT JOIN r_population p ON p.id_bci = d.id_bci LEFT JOIN v_mapping m ON CAST(m.id_bci AS VARCHAR) = p.id_bci
    LEFT JOIN (SELECT person_id, CAST(count(DISTINCT ts) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS u, CAST(sum(files) AS BIGINT) AS f
      FROM appts GROUP BY 1) i ON CAST(i.person_id AS VARCHAR) = d.id_bci
    LEFT JOIN (SELECT id_event, uid FROM (SELECT e.id_event, a.uid, row_number() OVER (PARTITION BY e.id_event ORDER BY a.ts, a.uid) AS rn
      FROM v_depistage e JOIN appts a ON a.person_id = e.id_bci AND {NEAR}) t WHERE rn = 1) n ON CAST(n.id_event AS VARCHAR) = d."Id_event"
    """
)
PSEUDO_CTES = APPTS + f""",
refused AS (SELECT m.id_random FROM r_population p JOIN v_mapping m ON CAST(m.id_bci AS VARCHAR) = p.id_bci WHERE p."NNI_2" IN (SELECT nir FROM v_refusals)),
pseudo AS ({PSEUDO_SQL})"""


@query(
    "pse_02_pseudonymised_exams",
    """SELECT * EXCLUDE (_l, rn) FROM (SELECT *, row_number() OVER (PARTITION BY id_random, "Date_Mammo" ORDER BY _l DESC) AS rn FROM pseudo
    WHERE id_random IS NOT NULL AND "Date_Mammo" IS NOT NULL AND id_random NOT IN (SELECT id_random FROM refused)) t WHERE rn = 1""",
    PSEUDO_CTES,
)
def _(d):
    table = cohort_of(d).depistage_pseudo()
    shown = {}
    for f in table.schema.fields:
        if isinstance(f.dataType, T.BooleanType):
            shown[f.name] = F.col(f.name).cast("string")
        elif isinstance(f.dataType, T.TimestampNTZType):
            shown[f.name] = F.date_format(f.name, "yyyy-MM-dd")
    return table.withColumns(shown)


@query(
    "pse_02_exam_history",
    f"""SELECT m.id_random, h.ts, h.uids, h.file_count FROM ({HISTORY_SQL}) h JOIN v_mapping m ON m.id_bci = h.person_id
    WHERE CAST(h.person_id AS VARCHAR) IN (SELECT id_bci FROM r_depistage WHERE id_bci IS NOT NULL AND "Id_event" IS NOT NULL)
    AND CAST(h.person_id AS VARCHAR) IN (SELECT id_bci FROM r_population) AND m.id_random NOT IN (SELECT id_random FROM refused)""",
    PSEUDO_CTES,
)
def _(d):
    return history_out(cohort_of(d).exam_history(), "id_random")


def uid_sql(person: str, uid: str) -> str:
    digest = f"sha256(CAST({person} AS VARCHAR) || '|' || {uid})"
    numbers = [f"CAST(CAST('0x' || substring({digest}, {start}, 15) AS BIGINT) AS VARCHAR)" for start in (1, 16)]
    return f"'{ORG_ROOT}.' || {numbers[0]} || '.' || {numbers[1]}"


@query(
    "pse_03_pseudo_uids",
    f"SELECT id_random, {uid_sql('id_random', 'study_id')} AS study_pseudo_id FROM ({STUDIES_SQL.format(source='appts', where='')}) s",
    APPTS,
)
def _(d):
    return studies(d).select("id_random", pseudo_uid("id_random", "study_id", ORG_ROOT).alias("study_pseudo_id"))


@query(
    "pse_04_identity_table",
    """SELECT m.id_random, p."NNI_2" AS nni_2, p.nom, p.prenom, m.id_bci FROM r_population p JOIN v_mapping m ON CAST(m.id_bci AS VARCHAR) = p.id_bci
    WHERE p."NNI_2" IS NOT NULL AND p."NNI_2" NOT IN (SELECT nir FROM v_refusals)""",
)
def _(d):
    c = cohort_of(d)
    return c.cnam().join(c.table_correspondance(), "id_random").select(
        "id_random", F.col("NNI_2").alias("nni_2"), "nom", "prenom", "id_bci"
    )


@query(
    "pse_05_patch_rows",
    "SELECT "
    + ", ".join(
        f'{value} AS "{name}"'
        for value, name in zip(
            (uid_sql("study_key", "study_uid"), uid_sql("study_key", "sop_uid"), "laterality", "view_code", "view_meaning", "view_scheme"),
            images.PATCH_COLUMNS,
        )
    )
    + " FROM v_image_meta",
)
def _(d):
    return images.patch_rows(d.v_image_meta, ORG_ROOT, id_random="study_key")


@query(
    "pse_06_sensitivity_classes",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", '{kind}' AS sensitivity, CAST(count({EXAM_COLUMNS[source]}) AS BIGINT) AS held
        FROM {last_sql('r_depistage', 'Id_event')} d"""
        for source, name, kind in spec.PUBLISHED
        if EXAM_COLUMNS.get(source, "").find('d."') >= 0
    ),
)
def _(d):
    exams_only = Cohort({"depistage": d.r_depistage}, d.v_mapping, d.v_refusals, d.v_dicom_guid).depistage_df()
    published = cohort.publish(exams_only)
    counts = keys.filled_counts(published, null_tokens=())
    long = counts.unpivot([], counts.columns, "column", "held")
    return long.join(cohort.column_metadata(published).select("column", "sensitivity"), "column")


@query("pse_07_sealed_mapping", "SELECT id_bci, id_random FROM v_mapping")
def _(d):
    path, key = scratch_path(d.spark, "sealed"), secrets.token_bytes(16)
    checksum = sinks.seal_mapping(d.v_mapping, path, key)
    return sinks.open_mapping(d.spark, path, key, checksum)


@query(
    "dup_01_duplicates_to_keep",
    """SELECT p.id_bci AS id_random, p.id_bci NOT IN (SELECT drop_pk FROM dropped) AS keep FROM v_population p
    WHERE nni_2 IN (SELECT nni_2 FROM v_population GROUP BY nni_2 HAVING count(*) > 1)""",
    """dropped AS (SELECT a.nni_2, max(a.id_bci) AS drop_pk FROM v_population a JOIN v_population b
    ON a.nni_2 = b.nni_2 AND a.id_bci <> b.id_bci AND abs(date_diff('day', a.date_naiss, b.date_naiss)) < 365 GROUP BY 1)""",
)
def _(d):
    people = d.v_population.withColumnRenamed("id_bci", "id_random")
    return duplicates.duplicates_to_keep(people, "nni_2")


@query(
    "validated_extraction_tables",
    """SELECT 'cnam' AS table_name, CAST(count(*) AS BIGINT) AS n FROM people WHERE "NNI_2" IS NOT NULL
    UNION ALL SELECT 'depistage_pseudo', CAST(count(DISTINCT (id_random, "Date_Mammo")) AS BIGINT) FROM pseudo
      WHERE id_random IS NOT NULL AND "Date_Mammo" IS NOT NULL AND id_random NOT IN (SELECT id_random FROM refused)
    UNION ALL SELECT 'exam_history', CAST(count(DISTINCT (person_id, ts)) AS BIGINT) FROM appts JOIN v_mapping m ON m.id_bci = person_id
      WHERE m.id_random NOT IN (SELECT id_random FROM refused) AND CAST(person_id AS VARCHAR) IN (SELECT id_bci FROM r_population)
      AND CAST(person_id AS VARCHAR) IN (SELECT id_bci FROM r_depistage WHERE id_bci IS NOT NULL AND "Id_event" IS NOT NULL)
    UNION ALL SELECT 'mail', CAST(count(DISTINCT email) AS BIGINT) FROM people
    UNION ALL SELECT 'table_correspondance', CAST(count(*) AS BIGINT) FROM people""",
    PSEUDO_CTES + """, people AS (SELECT p.*, m.id_random AS id_r FROM r_population p JOIN v_mapping m ON CAST(m.id_bci AS VARCHAR) = p.id_bci
      WHERE p."NNI_2" IS NULL OR p."NNI_2" NOT IN (SELECT nir FROM v_refusals))""",
)
def _(d):
    written = cohort_of(d).validated_extraction(scratch_path(d.spark, "validated"))
    out = None
    for name, df in written.items():
        n = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@query(
    "joi_12_column_metadata",
    """SELECT t.c AS "column", t.sensitivity, CAST(t.n AS BIGINT) AS held, t.sensitivity IN ('pseudonym', 'event_date') AS hidden FROM (
    SELECT 'id_random' AS c, 'pseudonym' AS sensitivity, (SELECT count(id_random) FROM v_mapping) AS n
    UNION ALL SELECT 'date_naiss', 'event_date', (SELECT count(date_naiss) FROM v_population)
    UNION ALL SELECT 'segment', 'property', (SELECT count(segment) FROM v_population)) t""",
)
def _(d):
    kinds = {"id_random": "pseudonym", "date_naiss": "event_date", "segment": "property"}
    people = population_with_ids(d)
    tagged = people.select(*[F.col(c).alias(c, metadata={"sensitivity": k}) for c, k in kinds.items()])
    counts = profile.value_counts(tagged).filter(F.col("value").isNotNull())
    held = counts.groupBy("column").agg(F.sum("n").alias("held"))
    described = held.join(cohort.column_metadata(tagged).select("column", "sensitivity"), "column")
    return described.withColumn("hidden", F.col("column").isin(*cohort.columns_of_class(tagged, "pseudonym", "event_date")))


@query(
    "export_studies_flow",
    """SELECT id_random, strftime(ts, '%Y-%m-%d') AS date, CAST(count(*) AS BIGINT) AS studies FROM (
      SELECT DISTINCT p.id_random, a.ts, a.uid FROM pseudo p JOIN v_mapping m ON p.id_random = m.id_random
      JOIN appts a ON a.person_id = m.id_bci WHERE p."Date_Mammo" IS NOT NULL AND p.id_random NOT IN (SELECT id_random FROM refused)) t GROUP BY 1, 2""",
    PSEUDO_CTES,
)
def _(d):
    folder = scratch_path(d.spark, "export")
    cohort_of(d).export_studies(folder, ORG_ROOT, SHARDS)
    written = d.spark.read.schema("id_random bigint, date timestamp_ntz, study_pseudo_id string").option("header", True).csv(
        f"{folder}/studies.csv"
    )
    return written.groupBy("id_random", F.date_format("date", "yyyy-MM-dd").alias("date")).agg(
        F.countDistinct("study_pseudo_id").alias("studies")
    )


@query(
    "export_registry_flow",
    """SELECT m.id_random, p."NNI_2" FROM r_population p JOIN v_mapping m ON CAST(m.id_bci AS VARCHAR) = p.id_bci
    WHERE p."NNI_2" IS NOT NULL AND p."NNI_2" NOT IN (SELECT nir FROM v_refusals)""",
)
def _(d):
    folder = scratch_path(d.spark, "registry-flow")
    cohort_of(d).export_registry(folder, DEPOSIT, PROJECT, PROJECT_NUMBER)
    return registry.read_registry_file(d.spark, f"{folder}/safe")


# --- shards and resume --------------------------------------------------------------------

SHARDS = 4


def arrived_studies(d: Data) -> DataFrame:
    """Distinct studies of the imaging index with files, and the person's remainder as shard."""
    return (
        appts(d).groupBy("uid").agg(F.sum("files").alias("files"), F.min("person_id").alias("person_id"))
        .select(F.col("uid").alias("study_id"), "files", (F.col("person_id") % SHARDS).cast("int").alias("shard"))
    )


STUDY_CTES = APPTS + f""",
st AS (SELECT uid AS study_id, CAST(sum(files) AS BIGINT) AS files, CAST(min(person_id) % {SHARDS} AS INT) AS shard FROM appts GROUP BY 1)"""


@query(
    "shd_01_hash_shards",
    f"SELECT DISTINCT uid AS study_id, CAST(1 AS BIGINT) AS shards, true AS in_range, {SHARDS} AS shards_used FROM appts WHERE uid IS NOT NULL",
    APPTS,
)
def _(d):
    """Every study in exactly one shard, however often and in whatever rows it comes; every shard in use."""
    rows = shard.with_shard(appts(d).select(F.col("uid").alias("study_id")).dropna(), SHARDS)
    again = shard.with_shard(arrived_studies(d).select("study_id").dropna(), SHARDS)
    placed = rows.unionByName(again).groupBy("study_id").agg(
        F.countDistinct("shard").alias("shards"), F.min(F.col("shard").between(0, SHARDS - 1)).alias("in_range")
    )
    used = again.agg(F.countDistinct("shard").cast("int").alias("shards_used"))
    return placed.join(F.broadcast(used))  # one row


@query(
    "shd_02_resume_by_position",
    """SELECT study_id, shard, CAST(rn AS BIGINT) AS position FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY study_id) AS rn,
    count(*) OVER (PARTITION BY shard) // (shard + 2) AS done FROM st) t WHERE rn > CASE WHEN shard = 3 THEN 0 ELSE done END""",
    STUDY_CTES,
)
def _(d):
    sharded = arrived_studies(d)
    progress = (
        sharded.filter(F.col("shard") < 3).groupBy("shard").agg(F.count("*").alias("n"))
        .select("shard", F.floor(F.col("n") / (F.col("shard") + 2)).cast("bigint").alias("uploaded"))
    )
    return shard.remaining_after(sharded, progress).select("study_id", "shard", "position")


@query(
    "shd_03_resume_patch",
    """SELECT study_id FROM st WHERE study_id NOT IN (SELECT study_id FROM st WHERE shard = 0
    AND study_id <> (SELECT max(study_id) FROM st WHERE shard = 0))""",
    STUDY_CTES,
)
def _(d):
    everything = arrived_studies(d)
    written = everything.filter("shard = 0").select("study_id", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("image"))
    todo, _kept = shard.resume_patch(everything, written, "study_id", ["study_id"])
    return todo.select("study_id")


@query(
    "shd_04_shard_progress",
    """SELECT CAST(shard AS BIGINT) AS shard, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (files >= 3) AS BIGINT) AS uploaded,
    CAST(count(*) FILTER (files < 3) AS BIGINT) AS remaining FROM st GROUP BY 1""",
    STUDY_CTES,
)
def _(d):
    everything = arrived_studies(d)
    out = shard.shard_progress(everything, everything.filter("files >= 3"))
    return out.withColumn("shard", F.col("shard").cast("bigint"))


@query(
    "shd_05_next_batch",
    """SELECT study_id, CAST(rn AS BIGINT) AS position, CAST(running AS BIGINT) AS running_total FROM (SELECT study_id,
    row_number() OVER (ORDER BY study_id) AS rn, sum(files) OVER (ORDER BY study_id) AS running FROM st) t WHERE running <= 900 AND rn <= 500""",
    STUDY_CTES,
)
def _(d):
    batch = shard.next_batch(arrived_studies(d), ["study_id"], "files", 500, 1000, 100)
    return batch.select("study_id", "position", F.col("running_total").cast("bigint").alias("running_total"))


@query(
    "shd_05_next_batch_by_space",
    """SELECT study_id, CAST(rn AS BIGINT) AS position, CAST(running AS BIGINT) AS running_total FROM (SELECT study_id,
    row_number() OVER (ORDER BY study_id) AS rn, sum(files) OVER (ORDER BY study_id) AS running FROM st) t WHERE running <= 2500""",
    STUDY_CTES,
)
def _(d):
    batch = shard.next_batch(arrived_studies(d), ["study_id"], "files", 0, 3000, 500)
    return batch.select("study_id", "position", F.col("running_total").cast("bigint").alias("running_total"))


COHORT_LIST_SQL = """cl AS (SELECT id_event AS bci, row_number() OVER (ORDER BY id_event) AS n, date_mammo, id_event % 3 = 0 AS prior,
  'S' || CAST(id_event AS VARCHAR) AS s, 'A' || CAST(id_event AS VARCHAR) AS a FROM v_depistage)"""


def cohort_rows(d: Data) -> DataFrame:
    short = F.date_format("date_mammo", "dd/MM/yy")
    event = F.col("id_event").cast("string")
    return d.v_depistage.select(
        F.col("id_event").alias("BCI"), short.alias("Date MG Expér Inca"), short.alias("Date MG Antériorité"),
        F.when(F.col("id_event") % 3 == 0, "Oui").otherwise("Non").alias("Antériorité"),
        F.concat(F.lit("S"), event).alias("study_id"), F.concat(F.lit("A"), event).alias("ant_study_id"),
    )


@query(
    "shd_06_expand_cohort",
    """SELECT CAST(n AS BIGINT) AS idFemme, 'primary' AS role, s AS study_id FROM cl UNION ALL SELECT CAST(n AS BIGINT), 'prior', a FROM cl WHERE prior""",
    COHORT_LIST_SQL,
)
def _(d):
    return shard.expand_cohort(cohort_list.prepare_cohort(cohort_rows(d)))


# --- sources and sinks: the files are written from the tables by Spark --------------------


def write_bundle(d: Data, names: tuple[str, ...]) -> str:
    """Extract bundle as CSV folders with the expected encodings and names."""
    folder = scratch_path(d.spark, "bundle")
    for name in names:
        s = spec.SOURCES[name]
        (
            d.view(f"r_{name}").select(*[F.col(f"`{c}`") for c in s.columns])
            .write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(f"{folder}/2020 {s.file_suffix.title()}")
        )
    return folder


RAW_SUIVI = {k: v for k, v in typed_sql("s", spec.FOLLOW_UP).items()}
EXTRACT_SQL = (
    "SELECT " + ", ".join(f'{v} AS "{k}"' for k, v in RAW_SUIVI.items()) + " FROM r_suivi s"
)


@query("src_01_read_extract", EXTRACT_SQL)
def _(d):
    df = extracts.read_extract(d.spark, write_bundle(d, ("suivi", "adicap")), "suivi").drop(*extracts.ROW_ORDER)
    shown = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.BooleanType):
            shown[f.name] = F.col(f.name).cast("string")
        elif isinstance(f.dataType, T.TimestampNTZType):
            shown[f.name] = F.date_format(f.name, "yyyy-MM-dd")
    return df.withColumns(shown)


@query("src_02_route_file", "SELECT code AS code_adicap, libelle AS adicap FROM r_adicap")
def _(d):
    folder = write_bundle(d, ("population", "adicap"))
    return extracts.read_extract(d.spark, folder, "adicap").drop(*extracts.ROW_ORDER)


@query(
    "src_03_imaging_index",
    "SELECT ord, person_id, study_instance_uid, dicom_study_id, file_guid, center_name FROM guid",
    GUID_KEYED,
)
def _(d):
    path = scratch_path(d.spark, "index")
    d.v_dicom_guid.write.parquet(path)
    index = imaging.read_imaging_index(d.spark, path)
    return keys.force_key(index, spec.IMAGING_KEY, ["ord"]).select(
        "ord", "person_id", "study_instance_uid", "dicom_study_id", "file_guid", "center_name"
    )


@query(
    "src_04_all_metadata",
    """SELECT sop_uid, modality, NULL AS view_code, laterality FROM v_image_meta WHERE modality = 'US'
    UNION ALL SELECT sop_uid, modality, view_code, NULL FROM v_image_meta WHERE modality <> 'US'""",
)
def _(d):
    folder = scratch_path(d.spark, "metadata")
    us = F.col("modality") == "US"
    d.v_image_meta.filter(us).select("sop_uid", "modality", "laterality").write.parquet(f"{folder}/a/us")
    d.v_image_meta.filter(~us).select("sop_uid", "modality", "view_code").write.parquet(f"{folder}/b/c/other")
    return imaging.read_all_metadata(d.spark, folder).select("sop_uid", "modality", "view_code", "laterality")


PAGE = 500
PAGE_FIELDS = {"id_event": "primary_key", "day": "date", "ecs": "string"}


def write_pages(d: Data) -> str:
    """Paged JSON responses, one page per file, made from the screening rows."""
    folder = scratch_path(d.spark, "pages")
    rows = numbering.number_rows(
        d.v_depistage.select("id_event", F.col("date_mammo").cast("string").alias("day"), "ecs"), ["id_event"]
    )
    total = rows.agg(F.count("*").alias("n")).scalar()
    fields = F.create_map(
        *[x for n, t in PAGE_FIELDS.items() for x in (F.lit(n), F.create_map(F.lit("type"), F.lit(t)))]
    )
    cells = F.create_map(*[x for n in PAGE_FIELDS for x in (F.lit(n), F.col(n).cast("string"))])
    (
        rows.withColumn("page", F.floor((F.col("position") - 1) / PAGE))
        .groupBy("page")
        .agg(F.collect_list(cells).alias("rowdata"))
        .select(
            total.alias("total_rows"), (F.col("page") * PAGE).alias("begin"), F.lit(PAGE).alias("range"),
            F.struct(fields.alias("fields")).alias("metadata"), "rowdata",
        )
        .write.option("maxRecordsPerFile", 1).json(folder)
    )
    return folder


@query("src_05_pages_json", "SELECT id_event, CAST(date_mammo AS VARCHAR) AS day, ecs FROM v_depistage")
def _(d):
    return pages.read_pages_json(d.spark, write_pages(d)).withColumn("day", F.col("day").cast("string"))


@query("src_06_chunks_csv", "SELECT id_bci, nom, segment FROM v_population")
def _(d):
    folder = scratch_path(d.spark, "chunks")
    line = F.concat_ws(";", F.col("id_bci").cast("string"), "nom", "segment")
    lines = numbering.number_rows(d.v_population.select("id_bci", line.alias("line")), ["id_bci"])
    chunked = lines.withColumn("chunk_index", F.floor((F.col("position") - 1) / 200))
    chunks = chunked.agg(F.max("chunk_index") + 1).scalar()
    text = F.concat(F.lit("id_bci;nom;segment\n"), F.array_join(F.collect_list("line"), "\n"), F.lit("\n"))
    (
        chunked.groupBy("chunk_index").agg(text.alias("text"))
        .select(chunks.alias("total_chunks"), "chunk_index", F.base64(F.encode("text", "UTF-8")).alias("content"))
        .write.json(folder)
    )
    schema = T.StructType(
        [T.StructField("id_bci", T.LongType()), T.StructField("nom", T.StringType()), T.StructField("segment", T.StringType())]
    )
    return pages.read_chunks_csv(d.spark, folder, schema)


@query("src_08_refusals", 'SELECT nir AS "NIR", \'x\' AS "Nom Famille", \'1950\' AS "Naiss" FROM v_refusals')
def _(d):
    path = scratch_path(d.spark, "refusals")
    d.v_refusals.select(
        F.col("nir").alias("NIR"), F.lit("x").alias("Nom Famille"), F.lit("1950").alias("Naiss")
    ).write.option("header", True).csv(path)
    missing = extracts.read_refusals(d.spark, scratch_path(d.spark, "absent"))
    return extracts.read_refusals(d.spark, path).unionByName(missing)


@query("src_09_checked_mapping", "SELECT id_bci, id_random FROM v_mapping")
def _(d):
    path = scratch_path(d.spark, "mapping")
    d.v_mapping.write.option("header", True).csv(path)
    return extracts.read_mapping(d.spark, path, extracts.mapping_manifest(d.spark, path))


@query(
    "src_10_dummy_identities",
    """SELECT id_bci AS id_random, substring('2' || CAST(id_bci AS VARCHAR) || '12345678901234', 1, 13) AS nni_2, 'nom' || CAST(id_bci AS VARCHAR) AS nom,
    'nom_jf' || CAST(id_bci AS VARCHAR) AS nom_jf, 'prenom' || CAST(id_bci AS VARCHAR) AS prenom, CAST(DATE '2021-04-06' - 20000 AS VARCHAR) AS date_naiss
    FROM v_population""",
)
def _(d):
    dummy = registry.dummy_identities(d.v_population, "id_bci", "2021-04-06")
    return dummy.withColumnRenamed("NNI_2", "nni_2").withColumn("date_naiss", F.col("date_naiss").cast("string"))


DEPOSIT, PROJECT, PROJECT_NUMBER = "06/04/2021", "PROJT", "042"


def written_registry(d: Data) -> str:
    path = scratch_path(d.spark, "registry")
    registry.write_registry_file(registry_people(d), path, DEPOSIT, PROJECT, PROJECT_NUMBER)
    return path


@query("src_11_read_registry_file", 'SELECT CAST(tmp AS BIGINT) AS id_random, nir AS "NNI_2" FROM reg', REGISTRY_SQL)
def _(d):
    return registry.read_registry_file(d.spark, written_registry(d))


@query(
    "src_12_cohort_csv",
    """SELECT CAST(n AS BIGINT) AS idFemme, strftime(date_mammo, '%d%m%y') AS "DateMG", CASE WHEN prior THEN 'Oui' ELSE 'Non' END AS anteriorite,
    CAST(n AS VARCHAR) || '_' || strftime(date_mammo, '%d%m%y') AS study_id, s AS source_study_id, a AS source_ant_study_id FROM cl""",
    COHORT_LIST_SQL,
)
def _(d):
    path = scratch_path(d.spark, "cohort-list")
    cohort_rows(d).write.option("header", True).csv(path)
    rows = cohort_list.read_cohort_csv(d.spark, path)
    return rows.select("idFemme", "DateMG", "anteriorite", "study_id", "source_study_id", "source_ant_study_id")


@query(
    "src_14_file_inventory",
    """SELECT CAST(count(DISTINCT segment) AS BIGINT) AS files, sum(length(CAST(id_bci AS VARCHAR)) + 1) / 1048576.0 AS total_mb,
    round(sum(length(CAST(id_bci AS VARCHAR)) + 1) / count(DISTINCT segment), 2) AS mean_bytes FROM v_population WHERE segment IS NOT NULL""",
)
def _(d):
    folder = scratch_path(d.spark, "files")
    people = d.v_population.select("id_bci", "segment").dropna()
    people.repartition("segment").write.partitionBy("segment").csv(folder)
    return inventory.file_inventory(d.spark, folder, ".csv")


WORKER_SQL = f"""CAST(id_event % {SHARDS} AS BIGINT)"""


def worker_progress(d: Data) -> DataFrame:
    """Exams per worker: all, and those with a result."""
    worker = (F.col("id_event") % SHARDS).cast("int")
    return exam_rows(d).groupBy(worker.alias("worker")).agg(
        F.count("L1L2_positif").alias("uploaded"), F.count("*").alias("total")
    )


PROGRESS_SQL = f"""wp AS (SELECT {WORKER_SQL} AS worker, CAST(count(CASE WHEN resultat_global IN ('Oui','O','Positif','+','P','Non','N','Négatif','-')
  THEN 1 END) AS BIGINT) AS uploaded, CAST(count(*) AS BIGINT) AS total FROM v_depistage GROUP BY 1)"""


@query("src_15_read_progress", "SELECT worker, uploaded, total FROM wp", PROGRESS_SQL)
def _(d):
    folder = scratch_path(d.spark, "progress")
    sinks.write_progress(worker_progress(d), folder)
    return inventory.read_progress(d.spark, folder).withColumn("worker", F.col("worker").cast("bigint"))


@query("snk_07_write_progress", "SELECT worker, uploaded, total FROM wp", PROGRESS_SQL)
def _(d):
    folder = scratch_path(d.spark, "progress")
    sinks.write_progress(worker_progress(d), folder)
    back = d.spark.read.schema("uploaded bigint, total bigint, worker int").json(folder)
    return back.withColumn("worker", F.col("worker").cast("bigint"))


@query(
    "agg_15_progress_totals",
    "SELECT worker, uploaded, total FROM wp UNION ALL SELECT NULL, CAST(sum(uploaded) AS BIGINT), max(total) FROM wp",
    PROGRESS_SQL,
)
def _(d):
    folder = scratch_path(d.spark, "progress")
    sinks.write_progress(worker_progress(d), folder)
    totals = inventory.progress_totals(inventory.read_progress(d.spark, folder))
    return totals.withColumn("worker", F.col("worker").cast("bigint"))


@query(
    "agg_16_last_modifications",
    """SELECT CAST(user_id % 4 AS BIGINT) AS worker, strftime(max(ts) + INTERVAL 1 HOUR, '%d-%m-%Y %H:%M:%S') AS last_modification FROM events GROUP BY 1""",
)
def _(d):
    folder = scratch_path(d.spark, "progress")
    changes = d.events.groupBy((F.col("user_id") % 4).cast("int").alias("worker")).agg(
        F.count("*").alias("uploaded"), F.count("*").alias("total"), F.max(F.col("ts").cast("timestamp_ntz")).alias("last")
    )
    sinks.write_progress(changes, folder)
    for r in changes.collect():  # a row a worker; the files get the times at which their workers last wrote
        for name in store.children(d.spark, f"{folder}/worker={r.worker}"):
            store.touch(d.spark, f"{folder}/worker={r.worker}/{name}", r["last"])
    out = inventory.last_modifications(inventory.file_listing(d.spark, folder, "*.json"))
    return out.withColumn("worker", F.col("worker").cast("bigint"))


@query("src_16_meta_csvs", 'SELECT CAST(sum("RelativeXRayExposure_0x00181405") AS DOUBLE) AS total, CAST(count(*) AS BIGINT) AS images FROM v_image_meta')
def _(d):
    folder = scratch_path(d.spark, "meta-csv")
    meta = d.v_image_meta.select("sop_uid", "RelativeXRayExposure_0x00181405", "modality")
    meta.write.partitionBy("modality").option("header", True).csv(folder)
    back = imaging.read_meta_csvs(d.spark, folder)
    counted = back.agg(F.count("*").alias("images"))
    total = images.tag_sum(back, "0x00181405").select(F.col("total").cast("double").alias("total")).scalar()
    return counted.select(total.alias("total"), "images")


@query("src_17_study_ids_from_log", "SELECT study_uid AS study_id FROM v_image_meta")
def _(d):
    path = scratch_path(d.spark, "log")
    line = F.concat(F.lit("[2020-01-01 10:00:00] Not OK: "), F.col("study_uid"), F.lit(" | Nb mammograms: 3"))
    d.v_image_meta.select(line.alias("value")).write.text(path)
    return imaging.study_ids_from_log(d.spark, path)


@query("snk_01_materialise", "SELECT id_bci, nom, nni_2 FROM v_population")
def _(d):
    path = scratch_path(d.spark, "table")
    people = d.v_population.select("id_bci", "nom", "nni_2")
    sinks.materialise(people, path)
    return sinks.materialise(people.limit(0), path)


PAD = "rpad(tmp, 20, ' ')"


@query(
    "snk_02_registry_file",
    """SELECT '00000RG00000000080036CRIP          CN00000000001003SNE800362016183201630520161108EI010000V800362021096042   0000000000000000000000KMLEI       ' AS line
    UNION ALL SELECT '10001H0000001' UNION ALL SELECT substring('11099' || nir || substring(born, 7, 4) || substring(born, 4, 2) || substring(born, 1, 2) || '2' || nir ||
      '    PROJT' || rpad(tmp, 20, ' '), 1, 69) FROM reg
    UNION ALL SELECT '99001NT_LOT    10001' || lpad(CAST(count(*) AS VARCHAR), 8, '0') FROM reg
    UNION ALL SELECT '99900RG00000000080036CRIP          CN00000000001003SNE800362016183201630520161108EI010000V800362021096042   0' ||
      lpad(CAST(count(*) + 4 AS VARCHAR), 9, '0') || '000000000000KMLEI       ' FROM reg""",
    REGISTRY_SQL,
)
def _(d):
    return d.spark.read.text(written_registry(d)).withColumnRenamed("value", "line")


@query("snk_03_csv_export", STUDIES_SQL.format(source="appts", where=""), APPTS)
def _(d):
    path = scratch_path(d.spark, "studies")
    sinks.export_csv(studies_out(studies(d)), path, gzip=True)
    return d.spark.read.schema("id_random bigint, date string, study_id string").option("header", True).csv(path)


@query(
    "snk_04_valid_mails",
    r"SELECT DISTINCT email FROM v_population WHERE regexp_matches(email, '^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9.-]+$')",
)
def _(d):
    path = scratch_path(d.spark, "mail")
    sinks.export_emails(cohort.mail_table(d.v_population), path)
    return d.spark.read.schema("email string").option("header", True).csv(path)


@query(
    "snk_05_resumed_patch",
    "SELECT study_uid AS study_id, CAST(count(*) AS BIGINT) AS images FROM v_image_meta WHERE study_uid IS NOT NULL GROUP BY 1",
)
def _(d):
    path = scratch_path(d.spark, "parts")
    studies = d.v_image_meta.select(F.col("study_uid").alias("study_id")).distinct()

    def extract(chosen: DataFrame) -> DataFrame:
        rows = d.v_image_meta.withColumnRenamed("study_uid", "study_id").join(chosen, "study_id", "left_semi")
        return rows.groupBy("study_id").agg(F.count("*").alias("images"))

    some = patches.remaining_studies(studies, path, parts=6).filter("part IN (0, 1, 2)").drop("part")
    patches.write_parts(extract(some), path, [0, 1, 2])  # a run that ended half-way
    return patches.extend_patch(studies, extract, path, parts_a_step=2)


@query("snk_05_append_patch", "SELECT sop_uid, laterality, view_code FROM v_image_meta")
def _(d):
    path = scratch_path(d.spark, "patch")
    rows = d.v_image_meta.select("sop_uid", "laterality", "view_code")
    mg = F.col("modality") == "MG"
    sinks.append_patch(d.v_image_meta.filter(mg).select(*rows.columns), path, 5000)
    sinks.append_patch(d.v_image_meta.filter(~mg).select(*rows.columns), path, 5000)
    return d.spark.read.schema(rows.schema).option("header", True).csv(path)


@query(
    "str_01_arrivals",
    "SELECT DISTINCT study_instance_uid, CAST(appointment_date AS VARCHAR) AS appointment_date, file_guid FROM guid",
    GUID_KEYED,
)
def _(d):
    root = scratch_path(d.spark, "arrivals")
    rows = imaging.clean_index(d.v_dicom_guid).select("ord", *spec.IMAGING_KEY)
    inbox, target, checkpoint = f"{root}/inbox", f"{root}/taken", f"{root}/checkpoint"
    schema = rows.schema
    even = F.col("ord") % 2 == 0
    for part in (rows.filter(even), rows.filter(~even)):
        part.write.mode("append").parquet(inbox)
        arrivals.follow_arrivals(d.spark, inbox, schema, target, checkpoint, list(spec.IMAGING_KEY))
    taken = arrivals.arrived(d.spark, target)
    return taken.select(
        "study_instance_uid", F.col("appointment_date").cast("string").alias("appointment_date"), "file_guid"
    )
