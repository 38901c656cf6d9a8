"""Queries for filters, joins, aggregations, windows, sets and nested histories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import clean, history
from cohortloom.operators import cohort, exams, filters, images, keys, numbering, reports, shard
from cohortloom.plans import requests
from cohortloom.sources.imaging import clean_index
from cohortloom.workload.fixtures import Data
from cohortloom.workload.key_queries import (
    BENIGN_SQL, GUID_CLEAN, GUID_KEYED, LINK_SQL, LOCATION_SQL, MALIGNANT_SQL, METASTASIS_SQL, ANOMALY_SQL, SUIVI_DESC,
    SUIVI_ORDER, care_sql,
)
from cohortloom.workload.registry import query

# --- shared pieces ------------------------------------------------------------------------

APPTS = GUID_KEYED + """,
appts AS (SELECT person_id, appointment_date AS ts, study_instance_uid AS uid, count(*) AS files FROM guid
  WHERE person_id IS NOT NULL GROUP BY 1, 2, 3)"""
NEAR = "abs((year(e.date_mammo) - year(a.ts)) * 12 + month(e.date_mammo) - month(a.ts)) <= 1"
EXAMS = APPTS + f""",
matched AS (SELECT id_event, uid FROM (SELECT e.id_event, a.uid, row_number() OVER (PARTITION BY e.id_event ORDER BY a.ts, a.uid) AS rn
  FROM v_depistage e JOIN appts a ON a.person_id = e.id_bci AND {NEAR}) t WHERE rn = 1),
ex AS (SELECT e.*, m.uid AS dicom_study,
  CASE WHEN resultat_global IN ('Oui','O','Positif','+','P') THEN true WHEN resultat_global IN ('Non','N','Négatif','-') THEN false END AS positif,
  CASE WHEN TRY_CAST(age_raw AS DOUBLE) > 0 AND TRY_CAST(age_raw AS DOUBLE) < 120 THEN CAST(floor(TRY_CAST(age_raw AS DOUBLE)) AS BIGINT) END AS age,
  e.id_bci IN (SELECT person_id FROM appts) AND e.id_bci IS NOT NULL AS has_history,
  CASE WHEN l1_acr_sd IN ('1','2') AND l1_acr_sg IN ('1','2') THEN 'negative' ELSE 'positive' END AS l1_result,
  CASE WHEN l2_acr_sd IN ('1','2') AND l2_acr_sg IN ('1','2') THEN 'negative' ELSE 'positive' END AS l2_result
  FROM v_depistage e LEFT JOIN matched m ON e.id_event = m.id_event)"""
ACR5 = "(l1_acr_sg = '5' OR l1_acr_sd = '5' OR l2_acr_sg = '5' OR l2_acr_sd = '5')"


def appts(d: Data) -> DataFrame:
    return exams.appointments(d.imaging)


def exam_rows(d: Data) -> DataFrame:
    return d.v_depistage.select(
        "id_event", "id_bci", F.col("date_mammo").alias("Date_Mammo"),
        F.col("l1_acr_sd").alias("L1_ACR_SD"), F.col("l1_acr_sg").alias("L1_ACR_SG"),
        F.col("l2_acr_sd").alias("L2_ACR_SD"), F.col("l2_acr_sg").alias("L2_ACR_SG"),
        clean.yes_no("resultat_global").alias("L1L2_positif"), clean.clean_age("age_raw").alias("Age_Mammo"),
    )


def exams_with_history(d: Data) -> DataFrame:
    return exams.mark_history(exam_rows(d), appts(d), "id_bci")


def population_with_ids(d: Data) -> DataFrame:
    return cohort.add_mapping(d.v_population.withColumnRenamed("nni_2", "NNI_2"), d.v_mapping)


# --- flagship -----------------------------------------------------------------------------

FLAGSHIP_SQL = f"""
SELECT l1_result, l2_result, CAST(count(*) AS BIGINT) AS exams, CAST(count(id_random) AS BIGINT) AS with_id,
  CAST(count(adicap) AS BIGINT) AS coded, CAST(count(adicap2) AS BIGINT) AS coded2
FROM (SELECT pop.id_random, a.adicap, a2.adicap AS adicap2,
    CASE WHEN d.l1_acr_sd IN ('1','2') AND d.l1_acr_sg IN ('1','2') THEN 'negative' ELSE 'positive' END AS l1_result,
    CASE WHEN d.l2_acr_sd IN ('1','2') AND d.l2_acr_sg IN ('1','2') THEN 'negative' ELSE 'positive' END AS l2_result
  FROM v_depistage d LEFT JOIN suivi s ON d.id_event = s.id_event
  LEFT JOIN v_adicap a ON s.k_adicap = a.code_adicap LEFT JOIN v_adicap a2 ON s.k_adicap2 = a2.code_adicap
  LEFT JOIN pop ON d.id_bci = pop.id_bci) lev
WHERE NOT EXISTS (SELECT 1 FROM refused r WHERE r.id_random = lev.id_random)
GROUP BY l1_result, l2_result"""
FLAGSHIP_CTES = f"""
pop AS (SELECT p.id_bci, p.nni_2, m.id_random FROM v_population p LEFT JOIN v_mapping m ON p.id_bci = m.id_bci),
refused AS (SELECT DISTINCT pop.id_random FROM pop JOIN v_refusals r ON pop.nni_2 = r.nir),
suivi AS (SELECT id_event, k_adicap, k_adicap2 FROM (SELECT *, row_number() OVER (PARTITION BY id_event ORDER BY {SUIVI_DESC}) AS rn
  FROM v_suivi WHERE id_event IS NOT NULL) t WHERE rn = 1)"""


@query("flagship_result_counts", FLAGSHIP_SQL, FLAGSHIP_CTES)
def _(d):
    people = population_with_ids(d)
    refusing = cohort.refusing_people(people, d.v_refusals, "nir")
    follow_up = keys.force_key(d.v_suivi, "id_event", SUIVI_ORDER).select("id_event", "k_adicap", "k_adicap2")
    first = d.v_adicap
    second = d.v_adicap.select(F.col("code_adicap").alias("code_adicap2"), F.col("adicap").alias("adicap2"))
    star = (
        d.v_depistage.join(follow_up, "id_event", "left")
        .join(first, F.col("k_adicap") == F.col("code_adicap"), "left")
        .join(second, F.col("k_adicap2") == F.col("code_adicap2"), "left")
        .join(people.select("id_bci", "id_random"), "id_bci", "left")
    )
    return (
        cohort.without_refusals(star, refusing)
        .groupBy(
            clean.reader_result("l1_acr_sd", "l1_acr_sg").alias("l1_result"),
            clean.reader_result("l2_acr_sd", "l2_acr_sg").alias("l2_result"),
        )
        .agg(
            F.count("*").alias("exams"), F.count("id_random").alias("with_id"),
            F.count("adicap").alias("coded"), F.count("adicap2").alias("coded2"),
        )
    )


# --- filters ------------------------------------------------------------------------------


@query(
    "flt_01_apply_filter",
    f"""SELECT 'none' AS used, id_event FROM ex WHERE has_history
    UNION ALL SELECT 'acr5', id_event FROM ex WHERE has_history AND {ACR5}
    UNION ALL SELECT 'positive', id_event FROM ex WHERE has_history AND positif AND dicom_study IS NOT NULL
    UNION ALL SELECT 'flag', id_event FROM ex WHERE has_history AND positif = false
    UNION ALL SELECT 'value', id_event FROM ex WHERE has_history AND l1_acr_sg = '3'""",
    EXAMS,
)
def _(d):
    base = exams.match_studies(exams_with_history(d), appts(d), "id_bci", "Date_Mammo")
    used = {
        "none": (None, None), "acr5": ("GET_ACR5", None), "positive": ("GET_POSITIVE_WITH_IMG_ONLY", None),
        "flag": ("L1L2_positif", "False"), "value": ("L1_ACR_SG", "3"),
    }
    return filters.label_matches(base, used).select("used", "id_event")


@query("flt_02_any_acr5", f"SELECT id_event FROM v_depistage WHERE {ACR5}")
def _(d):
    return exam_rows(d).filter(filters.any_acr5()).select("id_event")


@query("flt_03_positive", "SELECT id_event FROM v_depistage WHERE resultat_global IN ('Oui','O','Positif','+','P')")
def _(d):
    return exam_rows(d).filter(filters.positive()).select("id_event")


@query("flt_04_with_images", "SELECT id_event, dicom_study FROM ex WHERE dicom_study IS NOT NULL", EXAMS)
def _(d):
    matched = exams.match_studies(exam_rows(d), appts(d), "id_bci", "Date_Mammo")
    return matched.filter(filters.with_images()).select("id_event", F.col("DICOM_Study").alias("dicom_study"))


@query("flt_05_test_cohort", f"SELECT id_event FROM ex WHERE has_history AND {ACR5} AND age = 69", EXAMS)
def _(d):
    held = exams.with_any_study(exam_rows(d), appts(d), "id_bci")
    return filters.test_cohort(held.withColumn(filters.HISTORY, F.lit(True))).select("id_event")


@query(
    "flt_06_identity_complete",
    """SELECT p.id_bci, m.id_random, p.nni_2 FROM v_population p LEFT JOIN v_mapping m ON p.id_bci = m.id_bci
    WHERE m.id_random IS NOT NULL AND p.nni_2 IS NOT NULL AND p.nni_2_cle IS NOT NULL""",
)
def _(d):
    people = population_with_ids(d).dropna(subset=["id_random", "NNI_2", "nni_2_cle"])
    return people.select("id_bci", "id_random", F.col("NNI_2").alias("nni_2"))


FIRST_DAY, LAST_DAY = "1996-01-01", "1999-12-31"
PERIOD = f"date_mammo BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'"


@query("flt_07_date_range", f"SELECT id_event FROM v_ks WHERE {PERIOD}")
def _(d):
    return requests.exams_between(d.v_ks, FIRST_DAY, LAST_DAY).select("id_event")


@query("flt_08_postcode_area", "SELECT id_data, postcode FROM v_rdv_centre WHERE regexp_matches(postcode, '^(48|30)')")
def _(d):
    return d.v_rdv_centre.filter(requests.in_area("postcode")).select("id_data", "postcode")


@query(
    "flt_09_either_present",
    """SELECT id_centre, num_centre, esis_id_centre, CAST(esis_date AS VARCHAR) AS esis_date, nom FROM v_centre
    WHERE esis_id_centre IS NOT NULL OR esis_date IS NOT NULL""",
)
def _(d):
    return requests.radiology_centres(d.v_centre).withColumn("esis_date", F.col("esis_date").cast("string"))


@query("flt_10_code_list", "SELECT code, libelle FROM v_dico WHERE dico = 'adks'")
def _(d):
    return requests.lesion_codes(d.v_dico)


@query("flt_11_studies_of_patient", "SELECT DISTINCT study_uid FROM v_image_meta WHERE patient_id = 'P7'")
def _(d):
    return images.studies_of_patient(d.v_image_meta, "patient_id", "P7", "study_uid")


@query("flt_12_large_studies", "SELECT study_uid, CAST(count(*) AS BIGINT) AS files FROM v_image_meta GROUP BY 1 HAVING count(*) > 4")
def _(d):
    return images.large_studies(d.v_image_meta, "study_uid")


@query(
    "flt_14_positive_with_images",
    "SELECT id_event, dicom_study, l1_result, l2_result FROM ex WHERE positif AND dicom_study IS NOT NULL",
    EXAMS,
)
def _(d):
    found = filters.positive_with_images(exam_rows(d), appts(d), "id_bci")
    return found.select(
        "id_event", F.col("DICOM_Study").alias("dicom_study"),
        F.col("L1_Result").alias("l1_result"), F.col("L2_Result").alias("l2_result"),
    )


# --- joins --------------------------------------------------------------------------------

SUIVI_CTE = f"""suivi AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_event ORDER BY {SUIVI_DESC}) AS rn
  FROM v_suivi WHERE id_event IS NOT NULL) t WHERE rn = 1)"""


@query(
    "joi_01_star",
    """SELECT d.id_event, CAST(d.date_mammo AS VARCHAR) AS date_mammo, d.ecs, CAST(s.date_anapath AS VARCHAR) AS date_anapath,
    s.trait_radi, a.adicap, a2.adicap AS adicap2, p.nom, r.age_mammo, i.dicom_appointments, i.dicom_uids, i.dicom_files
    FROM v_depistage d LEFT JOIN suivi s ON d.id_event = s.id_event
    LEFT JOIN (SELECT id_event, taille_mm AS age_mammo FROM v_ks) r ON d.id_event = r.id_event
    LEFT JOIN v_adicap a ON s.k_adicap = a.code_adicap LEFT JOIN v_adicap a2 ON s.k_adicap2 = a2.code_adicap
    LEFT JOIN v_population p ON d.id_bci = p.id_bci
    LEFT JOIN (SELECT person_id, CAST(count(DISTINCT ts) AS BIGINT) AS dicom_appointments, CAST(count(*) AS BIGINT) AS dicom_uids,
      CAST(sum(files) AS BIGINT) AS dicom_files FROM appts GROUP BY 1) i ON d.id_bci = i.person_id""",
    APPTS + ", " + SUIVI_CTE,
)
def _(d):
    star = cohort.exam_star(
        d.v_depistage,
        keys.force_key(d.v_suivi, "id_event", SUIVI_ORDER),
        d.v_ks.select("id_event", F.col("taille_mm").alias("age_mammo")),
        d.v_adicap,
        d.v_population.drop("nni_2"),
        exams.person_summary(appts(d)),
    )
    return star.select(
        "id_event", F.col("date_mammo").cast("string").alias("date_mammo"), "ecs",
        F.col("date_anapath").cast("string").alias("date_anapath"), "trait_radi", "adicap", "adicap2", "nom",
        "age_mammo", "dicom_appointments", "dicom_uids", "dicom_files",
    )


@query("joi_03_mapping_lookup", "SELECT p.id_bci, p.nom, m.id_random FROM v_population p LEFT JOIN v_mapping m ON p.id_bci = m.id_bci")
def _(d):
    return cohort.add_mapping(d.v_population, d.v_mapping).select("id_bci", "nom", "id_random")


@query(
    "joi_04_refusing_people",
    """SELECT m.id_random FROM v_population p JOIN v_mapping m ON p.id_bci = m.id_bci WHERE p.nni_2 IN (SELECT nir FROM v_refusals)""",
)
def _(d):
    return cohort.refusing_people(population_with_ids(d), d.v_refusals, "nir")


@query("joi_05_refusal_anti_join", "SELECT id_random, id_bci FROM pop WHERE id_random NOT IN (SELECT id_random FROM refused)", FLAGSHIP_CTES)
def _(d):
    people = population_with_ids(d)
    refusing = cohort.refusing_people(people, d.v_refusals, "nir")
    return cohort.without_refusals(people, refusing).select("id_random", "id_bci")


@query(
    "joi_06_close_births",
    """SELECT a.nni_2 AS number, CAST(max(a.id_bci) AS BIGINT) AS drop_pk FROM v_population a JOIN v_population b
    ON a.nni_2 = b.nni_2 AND a.id_bci <> b.id_bci AND abs(date_diff('day', a.date_naiss, b.date_naiss)) < 365 GROUP BY 1""",
)
def _(d):
    from cohortloom.operators.duplicates import numbers_with_close_births

    return numbers_with_close_births(d.v_population, "nni_2", "date_naiss", "id_bci")


@query(
    "joi_07_imaging_extraction",
    """SELECT p.num_bci AS person_id, CAST(ex.date_mammo AS VARCHAR) AS mammogram_date, CAST(ap.date_heure AS VARCHAR) AS appointment_date,
    m.study_instance_uid, m.dicom_study_id, CAST(m.date_study AS VARCHAR) AS date_study, d.file_guid, ap.id_exam_center, c.name AS center_name
    FROM v_rdv ap JOIN v_rdv_person p ON p.id_data = ap.id_assure LEFT JOIN v_rdv_reading ex ON ap.id_lecture1 = ex.id_data
    LEFT JOIN v_rdv_study m ON m.id_rdv = ap.id_data LEFT JOIN v_rdv_document d ON d.id_study = m.id_data
    LEFT JOIN v_rdv_centre c ON c.id_data = ap.id_exam_center
    WHERE p.num_bci IS NOT NULL AND (c.postcode LIKE '48%' OR c.postcode LIKE '30%')""",
)
def _(d):
    index = requests.imaging_extraction(
        d.v_rdv, d.v_rdv_person, d.v_rdv_reading, d.v_rdv_study, d.v_rdv_document, d.v_rdv_centre
    )
    dates = ("mammogram_date", "appointment_date", "date_study")
    return index.withColumns({c: F.col(c).cast("string") for c in dates})


@query(
    "joi_08_screening_request",
    f"""SELECT a.num_ref, a.id_assure, a.id_bci, k.id_event AS "Id_event", CAST(k.date_mammo AS VARCHAR) AS "Date_Mammo",
    CASE WHEN comp_re_1d = 'S' THEN 'anomalie SD plus suspecte' ELSE ' ' END AS "comparaison_SD",
    CASE WHEN comp_re_1g = 'S' THEN 'anomalie SG plus suspecte' ELSE ' ' END AS "comparaison_SG",
    CASE exam_clini WHEN 'A' THEN 'Anormal' WHEN 'N' THEN 'Normal' WHEN 'R' THEN 'Refusé' ELSE ' ' END AS "ECS",
    acr_sd11 AS "L1_ACR_SD", acr_sg11 AS "L1_ACR_SG",
    {ANOMALY_SQL.format(c='suspec11_d')} AS "L1_Type_Image_SD", {ANOMALY_SQL.format(c='suspec11_g')} AS "L1_Type_Image_SG",
    CASE WHEN echo_l1 = 'O' THEN 'Echo réalisé sur mammo négative' ELSE 'Non' END AS "Echo_L1",
    CASE WHEN echo_l1_suspecte = 'O' THEN 'Echo_L1_Suspecte' ELSE 'Non' END AS "Echo_ECS_L1_Suspecte",
    CASE WHEN bilan_l1 = 'O' THEN 'Bilan immédiat nécessaire' ELSE 'Pas de BDI' END AS "BDI",
    CASE WHEN bi_agrand = 'O' THEN 'BDI_Agrandissement' ELSE 'Non' END AS "BDI_Agrandissement",
    CASE WHEN bi_cyto = 'O' THEN 'BDI_Cytoponction' ELSE 'Non' END AS "BDI_Cytoponction",
    CASE WHEN bi_echo = 'O' THEN 'BDI_Echographie' ELSE 'Non' END AS "BDI_Echographie",
    acr_sd1 AS "BDI_ACR_SD", acr_sg1 AS "BDI_ACR_SG",
    {ANOMALY_SQL.format(c='suspec1_sd')} AS "BDI_Type_Image_SD", {ANOMALY_SQL.format(c='suspec1_sg')} AS "BDI_Type_Image_SG",
    {care_sql('BDI', 'exam_cons1', 'exam_cons_echo_l1')}, acr_sd2 AS "L2_ACR_SD_SD", acr_sg2 AS "L2_ACR_SD_SG",
    {ANOMALY_SQL.format(c='suspec2_sd')} AS "L2_Type_Image_SD", {ANOMALY_SQL.format(c='suspec2_sg')} AS "L2_Type_Image_SG",
    {care_sql('L2', 'exam_cons2')}, resultat AS "resultat_global_L1L2"
    FROM v_assure a JOIN v_ks k USING (id_assure) WHERE {PERIOD}""",
)
def _(d):
    out = requests.screening_records(d.v_assure, d.v_ks, FIRST_DAY, LAST_DAY)
    return out.withColumn("Date_Mammo", F.col("Date_Mammo").cast("string"))


@query(
    "joi_08_diagnoses_request",
    f"""SELECT a.num_ref, a.id_assure, a.id_bci, k.id_event, CAST(k.date_mammo AS VARCHAR) AS "Date_Mammo", malin_t AS "pT", malin_n AS "pN",
    {METASTASIS_SQL} AS "M", taille_mm AS "Taille_en_mm", {LOCATION_SQL} AS localisation, k_adicap, k_adicap2, grade AS "Grade_SBR",
    CASE WHEN k_proges = 'O' AND rh = '+' THEN 'Positif' WHEN k_proges = 'O' AND rh = '-' THEN 'Négatif' ELSE ' ' END AS "RH_Progesterone",
    CASE WHEN k_oestro = 'O' AND rh = '+' THEN 'Positif' WHEN k_oestro = 'O' AND rh = '-' THEN 'Négatif' ELSE ' ' END AS "RH_Oestreogene",
    her2 AS "HER2", {MALIGNANT_SQL} AS "Si_Malin", {BENIGN_SQL} AS "Si_Benin",
    CASE WHEN upper(situation_finale) = 'K' THEN 'KS_confirmé' ELSE ' ' END AS "KS_Confirme",
    CAST(date_bilan AS VARCHAR) AS "Date_Anapath", CAST(date_inter AS VARCHAR) AS "Date_Inter_Chir", trait_radi AS "Trait_Radi",
    CAST(date_radi AS VARCHAR) AS "Date_Radi", trait_horm AS "Trait_Horm", CAST(date_horm AS VARCHAR) AS "Date_Horm",
    trait_chim AS "Trait_Chim", CAST(date_chim AS VARCHAR) AS "Date_Chim"
    FROM v_assure a JOIN v_ks k USING (id_assure) WHERE {PERIOD}""",
)
def _(d):
    out = requests.diagnoses(d.v_assure, d.v_ks, FIRST_DAY, LAST_DAY)
    return out.withColumns({c: F.col(c).cast("string") for c in out.columns if c.startswith("Date_")})


RISK_AGE = "date_diff('day', date_naiss, {c}) / 365.25"
K_D, K_G = "coalesce(upper(maladie_an_d) = '{v}', false)", "coalesce(upper(maladie_an_g) = '{v}', false)"
EITHER_K = f"({K_D.format(v='K')} OR {K_G.format(v='K')})"
BOTH_K = f"({K_D.format(v='K')} AND {K_G.format(v='K')})"
EITHER_E = f"({K_D.format(v='E')} OR {K_G.format(v='E')})"


@query(
    "joi_08_risk_request",
    f"""SELECT a.num_ref, a.id_assure, a.id_bci, k.id_event, CAST(k.date_mammo AS VARCHAR) AS "Date_Mammo",
    round({RISK_AGE.format(c='date_mammo')}, 6) AS "Age_Mammo", CASE WHEN menop_trai = 'O' THEN 'Oui' ELSE 'Non' END AS "THS",
    CASE WHEN {EITHER_K} THEN 'Oui' ELSE 'Non' END AS "ATCD_Cancer",
    CASE WHEN {EITHER_K} THEN round({RISK_AGE.format(c='operation_date')}, 6) END AS "Age_ATCD_Cancer",
    CASE WHEN {BOTH_K} THEN 'Oui' ELSE 'Non' END AS "ATCD_Cancer_Bilateral",
    CASE WHEN {BOTH_K} THEN round({RISK_AGE.format(c='operation_date')}, 6) END AS "Age_ATCD_Cancer_Bilateral",
    CASE WHEN {EITHER_E} THEN 'Oui' ELSE 'Non' END AS "ATCD_Chir_Esth",
    CASE WHEN {EITHER_E} THEN round({RISK_AGE.format(c='operation_date')}, 6) END AS "Age_ATCD_Chir_Esth",
    """
    + ", ".join(
        f"""CASE WHEN ant_age_{r.lower()} = 'O' THEN 'O' ELSE 'N' END AS "ATCD_Famil_{r}",
        CASE WHEN ant_age_{r.lower()} = 'O' THEN age_{r.lower()} END AS "Age_ATCD_Famil_{r}" """
        for r in ("Mere", "Soeur", "Fille", "Autre")
    )
    + f" FROM v_assure a JOIN v_ks k USING (id_assure) WHERE {PERIOD}",
)
def _(d):
    out = requests.women_at_risk(d.v_assure, d.v_ks, FIRST_DAY, LAST_DAY)
    ages = ("Age_Mammo", "Age_ATCD_Cancer", "Age_ATCD_Cancer_Bilateral", "Age_ATCD_Chir_Esth")
    return out.withColumns({c: F.round(c, 6) for c in ages}).withColumn("Date_Mammo", F.col("Date_Mammo").cast("string"))


@query(
    "joi_09_original_vs_rebuilt",
    """SELECT coalesce(o.nni_2, r.nni_2) AS nni_2, CAST(coalesce(o.date_mammo, r.date_mammo) AS VARCHAR) AS date_mammo,
    o.acr AS original, r.acr AS rebuilt, o.h IS NOT NULL AS in_source, r.h IS NOT NULL AS in_rebuilt
    FROM (SELECT * FROM src WHERE rn = 1) o FULL OUTER JOIN (SELECT * FROM reb WHERE rn = 1) r
    ON o.nni_2 IS NOT DISTINCT FROM r.nni_2 AND o.date_mammo IS NOT DISTINCT FROM r.date_mammo""",
    FLAGSHIP_CTES + """, src AS (SELECT pop.nni_2, d.date_mammo, d.l1_acr_sg AS acr, 1 AS h,
      row_number() OVER (PARTITION BY pop.nni_2, d.date_mammo ORDER BY d.id_event DESC) AS rn
      FROM v_depistage d LEFT JOIN pop ON d.id_bci = pop.id_bci),
    reb AS (SELECT pop.nni_2, d.date_mammo, d.l1_acr_sg AS acr, 1 AS h,
      row_number() OVER (PARTITION BY pop.nni_2, d.date_mammo ORDER BY d.id_event DESC) AS rn
      FROM v_depistage d LEFT JOIN pop ON d.id_bci = pop.id_bci
      WHERE pop.id_random IS NULL OR pop.id_random NOT IN (SELECT id_random FROM refused))""",
)
def _(d):
    out = round_trip_rows(d)
    return out.select(
        F.col("NNI_2").alias("nni_2"), F.col("Date_Mammo").cast("string").alias("date_mammo"),
        "original", "rebuilt", "in_source", "in_rebuilt",
    )


def round_trip_rows(d: Data) -> DataFrame:
    people = population_with_ids(d)
    base = exam_rows(d).join(people.select("id_bci", "NNI_2", "id_random"), "id_bci", "left")
    source = base.select("NNI_2", "Date_Mammo", "L1_ACR_SG", "id_event")
    published = cohort.without_refusals(
        base.select("id_random", "Date_Mammo", "L1_ACR_SG", "id_event"),
        cohort.refusing_people(people, d.v_refusals, "nir"),
    )
    return cohort.rebuilt_versus_source(
        source, published, cohort.correspondence_table(people), people, "L1_ACR_SG", ["id_event"]
    )


@query("joi_10_studies_on_any_date", "SELECT DISTINCT uid FROM appts WHERE ts IN (SELECT date_mammo FROM v_depistage)", APPTS)
def _(d):
    return exams.studies_on_any_date(appts(d), exam_rows(d), "Date_Mammo")


@query(
    "joi_11_unmatched_people",
    "SELECT DISTINCT person_id FROM appts WHERE person_id NOT IN (SELECT id_bci FROM v_depistage WHERE id_bci IS NOT NULL)",
    APPTS,
)
def _(d):
    return exams.unmatched_people(appts(d), exam_rows(d), "id_bci")


# --- aggregations -------------------------------------------------------------------------

HISTORY_SQL = """SELECT person_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, string_agg(uid, ',' ORDER BY uid) AS uids,
 CAST(sum(files) AS BIGINT) AS file_count FROM appts GROUP BY person_id, appts.ts"""


def history_out(rows: DataFrame, person: str = "person_id") -> DataFrame:
    return rows.select(
        person, F.date_format("appointment_ts", history.TS_FORMAT).alias("ts"), F.array_join("uids", ",").alias("uids"), "file_count"
    )


@query("agg_01_exam_history", HISTORY_SQL, APPTS)
def _(d):
    return history_out(exams.history(appts(d)))


PERSON = "num_ref, id_assure, id_bci, NNI_2, NNI_2_cle, sexe, nom, nom_jf, prenom, date_naiss, email"


@query(
    "agg_02_women_list",
    f"""SELECT * REPLACE (CAST(date_naiss AS VARCHAR) AS date_naiss) FROM (SELECT {PERSON}, CAST(count(*) AS BIGINT) AS "count(*)"
    FROM v_assure JOIN v_ks USING (id_assure) WHERE {PERIOD} GROUP BY {PERSON}) t""",
)
def _(d):
    out = requests.women_list(d.v_assure, d.v_ks, FIRST_DAY, LAST_DAY)
    return out.withColumn("date_naiss", F.col("date_naiss").cast("string"))


@query("agg_03_distinct_mails", "SELECT DISTINCT email FROM v_population WHERE email IS NOT NULL")
def _(d):
    return cohort.mail_table(d.v_population)


@query(
    "agg_04_per_year",
    f"SELECT CAST(year(appointment_date) AS BIGINT) AS year, CAST(count(person_id) AS BIGINT) AS n FROM guid WHERE {LINK_SQL} GROUP BY 1",
    GUID_KEYED,
)
def _(d):
    out = reports.per_year(linked(d), "appointment_date", "person_id")
    return out.withColumn("year", F.col("year").cast("bigint"))


def linked(d: Data) -> DataFrame:
    return d.imaging.filter(clean.long_link("file_guid", "study_instance_uid", "dicom_study_id"))


@query(
    "agg_05_per_centre",
    f"SELECT center_name, CAST(count(person_id) AS BIGINT) AS n FROM guid WHERE {LINK_SQL} AND center_name IS NOT NULL GROUP BY 1",
    GUID_KEYED,
)
def _(d):
    return reports.per_value(linked(d), "center_name", "person_id")


@query(
    "agg_06_presence_patterns",
    """SELECT CASE WHEN file_guid IS NOT NULL THEN 'Some' ELSE '-' END AS file_guid,
    CASE WHEN study_instance_uid IS NOT NULL THEN 'Some' ELSE '-' END AS study_instance_uid,
    CASE WHEN dicom_study_id IS NOT NULL THEN 'Some' ELSE '-' END AS dicom_study_id, CAST(count(*) AS BIGINT) AS n FROM g GROUP BY 1, 2, 3""",
    GUID_CLEAN,
)
def _(d):
    return reports.presence_patterns(
        clean_index(d.v_dicom_guid), ["file_guid", "study_instance_uid", "dicom_study_id"]
    )


@query(
    "agg_07_images_per_appointment",
    f"""SELECT person_id, CAST(appointment_date AS VARCHAR) AS appointment_date, CAST(count(center_name) AS BIGINT) AS images,
    count(center_name) <= 12 AS small FROM guid WHERE {LINK_SQL} AND person_id IS NOT NULL GROUP BY 1, 2""",
    GUID_KEYED,
)
def _(d):
    counts = reports.images_per_appointment(linked(d))
    return counts.select(
        "person_id", F.col("appointment_date").cast("string").alias("appointment_date"), "images",
        (F.col("images") <= 12).alias("small"),
    )


def histogram_sql(name: str, condition: str, x: str) -> str:
    return f"""SELECT '{name}' AS range, bin, round(lo + (bin - 1) * (hi - lo) / 50, 6) AS bin_start, CAST(count(*) AS BIGINT) AS n FROM (
      SELECT least(CAST(floor(50 * (x - lo) / (hi - lo)) AS BIGINT) + 1, 50) AS bin, lo, hi FROM (
        SELECT {x} AS x, min({x}) OVER () AS lo, max({x}) OVER () AS hi FROM gaps WHERE {condition}) t) u GROUP BY bin, lo, hi"""


@query(
    "agg_08_gap_histograms",
    histogram_sql("negative_years", "m < 0", "m / 12")
    + " UNION ALL " + histogram_sql("ten_years_months", "m >= 0 AND m <= 120", "m")
    + " UNION ALL " + histogram_sql("later_years", "m > 120", "m / 12"),
    GUID_KEYED + f""", gaps AS (SELECT date_diff('day', mammogram_date, appointment_date) / CAST(30.0 AS DOUBLE) AS m FROM guid
      WHERE {LINK_SQL} AND mammogram_date IS NOT NULL AND appointment_date IS NOT NULL)""",
)
def _(d):
    out = reports.gap_histograms(linked(d), "appointment_date", "mammogram_date")
    return out.withColumn("bin_start", F.round("bin_start", 6))


def count_histogram_sql(name: str, condition: str, bins: int) -> str:
    """A range with one value only is widened by a half on both sides."""
    return f"""SELECT '{name}' AS range, bin, round(lo + (bin - 1) * (hi - lo) / {bins}, 6) AS bin_start, CAST(count(*) AS BIGINT) AS n FROM (
      SELECT least(CAST(floor({bins} * (x - lo) / (hi - lo)) AS BIGINT) + 1, {bins}) AS bin, lo, hi FROM (
        SELECT x, CASE WHEN a = b THEN a - 0.5 ELSE a END AS lo, CASE WHEN a = b THEN b + 0.5 ELSE b END AS hi FROM (
          SELECT CAST(images AS DOUBLE) AS x, CAST(min(images) OVER () AS DOUBLE) AS a, CAST(max(images) OVER () AS DOUBLE) AS b
          FROM per_appointment WHERE {condition}) t) u) v GROUP BY bin, lo, hi"""


@query(
    "agg_08_image_count_histograms",
    count_histogram_sql("up_to_12", "images <= 12", 12) + " UNION ALL " + count_histogram_sql("more_than_12", "images > 12", 50),
    GUID_KEYED + f""", per_appointment AS (SELECT person_id, appointment_date, count(center_name) AS images FROM guid
      WHERE {LINK_SQL} AND person_id IS NOT NULL GROUP BY 1, 2)""",
)
def _(d):
    out = reports.image_count_histograms(reports.images_per_appointment(linked(d)))
    return out.withColumn("bin_start", F.round("bin_start", 6))


COHERENCE = (
    ("results", ("positif", "l1_result", "l2_result"), "true"),
    ("results_images", ("has_mammogram", "positif", "l1_result", "l2_result"), "true"),
    ("first_reading", ("l1_result", "l1_acr_sd", "l1_acr_sg"), "positif AND dicom_study IS NOT NULL"),
    ("second_reading", ("l2_result", "l2_acr_sd", "l2_acr_sg"), "positif AND dicom_study IS NOT NULL"),
)


def coherence_sql(name: str, cols: tuple[str, ...], condition: str) -> str:
    label = " || '/' || ".join(
        {"positif": "CAST(positif AS VARCHAR)", "has_mammogram": "CASE WHEN dicom_study IS NULL THEN '0' ELSE '1' END"}.get(c, c)
        for c in cols
    )
    present = " AND ".join(f"{c} IS NOT NULL" for c in cols if c != "has_mammogram")
    return f"""SELECT '{name}' AS report, {label} AS combination, CAST(count(date_mammo) AS BIGINT) AS n FROM ex
      WHERE has_history AND {condition} AND {present} GROUP BY 1, 2"""


@query("agg_09_result_coherence", " UNION ALL ".join(coherence_sql(*c) for c in COHERENCE), EXAMS)
def _(d):
    base = exams.match_studies(exams.with_any_study(exam_rows(d), appts(d), "id_bci"), appts(d), "id_bci", "Date_Mammo")
    rows = filters.with_results(base).withColumn("has_mammogram", F.col("DICOM_Study").isNotNull().cast("int"))
    shown = filters.positive() & filters.with_images()
    return reports.coherence_reports(
        rows,
        {
            "results": (["L1L2_positif", "L1_Result", "L2_Result"], None),
            "results_images": (["has_mammogram", "L1L2_positif", "L1_Result", "L2_Result"], None),
            "first_reading": (["L1_Result", "L1_ACR_SD", "L1_ACR_SG"], shown),
            "second_reading": (["L2_Result", "L2_ACR_SD", "L2_ACR_SG"], shown),
        },
    )


VIEW_COUNTS = """vc AS (SELECT study_uid,
  CAST(count(*) FILTER (view_code = 'R-10242' AND upper(laterality) = 'R') AS BIGINT) AS rcc,
  CAST(count(*) FILTER (view_code = 'R-10242' AND upper(laterality) <> 'R') AS BIGINT) AS lcc,
  CAST(count(*) FILTER (view_code = 'R-10226' AND upper(laterality) = 'R') AS BIGINT) AS rmlo,
  CAST(count(*) FILTER (view_code = 'R-10226' AND upper(laterality) <> 'R') AS BIGINT) AS lmlo,
  CAST(count(*) AS BIGINT) AS images FROM v_image_meta GROUP BY 1)"""
POSITION_COUNTS = VIEW_COUNTS.replace("view_code = 'R-10242'", "upper(view_position) = 'CC'").replace(
    "view_code = 'R-10226'", "upper(view_position) = 'MLO'"
)


def view_counts(d: Data) -> DataFrame:
    return images.view_counts(d.v_image_meta, "study_uid", images.view_label("view_code", "laterality"))


@query("agg_10_view_counts", "SELECT *, least(rcc, lcc, rmlo, lmlo) >= 1 AS complete, greatest(rcc, lcc, rmlo, lmlo) > 1 AS overpopulated FROM vc", VIEW_COUNTS)
def _(d):
    return view_counts(d)


@query("agg_10_view_counts_by_position", "SELECT *, least(rcc, lcc, rmlo, lmlo) >= 1 AS complete, greatest(rcc, lcc, rmlo, lmlo) > 1 AS overpopulated FROM vc", POSITION_COUNTS)
def _(d):
    return images.view_counts(d.v_image_meta, "study_uid", images.position_label("view_position", "laterality"))


@query(
    "agg_11_completeness",
    """SELECT CAST(count(*) FILTER (least(rcc, lcc, rmlo, lmlo) >= 1) AS BIGINT) AS complete_studies, CAST(count(*) AS BIGINT) AS studies,
    round(count(*) FILTER (least(rcc, lcc, rmlo, lmlo) >= 1) / count(*), 6) AS ratio FROM vc""",
    VIEW_COUNTS,
)
def _(d):
    return images.completeness(view_counts(d)).withColumn("ratio", F.round("ratio", 6))


@query(
    "agg_12_overpopulation",
    """SELECT CAST(count(*) FILTER (greatest(rcc, lcc, rmlo, lmlo) > 1) AS BIGINT) AS overpopulated_studies, CAST(count(*) AS BIGINT) AS studies,
    round(100 * count(*) FILTER (greatest(rcc, lcc, rmlo, lmlo) > 1) / count(*), 6) AS frequency_pct FROM vc""",
    VIEW_COUNTS,
)
def _(d):
    return images.overpopulation(view_counts(d)).withColumn("frequency_pct", F.round("frequency_pct", 6))


@query(
    "agg_13_broken_studies",
    """SELECT CAST(count(*) FILTER (n < 4) AS BIGINT) AS fewer_than_4, CAST(count(*) FILTER (n >= 4) AS BIGINT) AS other_causes,
    CAST(sum(us) AS BIGINT) AS us_images, CAST(count(*) FILTER (us > 0) AS BIGINT) AS us_studies FROM (
    SELECT study_uid, count(*) AS n, count(*) FILTER (modality = 'US') AS us FROM v_image_meta GROUP BY 1) t""",
)
def _(d):
    return images.broken_studies(d.v_image_meta, "study_uid", "modality")


@query("agg_14_tag_sum", 'SELECT CAST(sum("RelativeXRayExposure_0x00181405") AS DOUBLE) AS total FROM v_image_meta')
def _(d):
    total = images.tag_sum(d.v_image_meta, "0x00181405")
    return total.select(F.col("total").cast("double").alias("total"))


@query(
    "agg_17_score_totals",
    """SELECT CAST(sum(len(list_filter(string_split(text, ' '), lambda w: length(w) > 4))) AS BIGINT) AS recognized_words,
    CAST(sum(len(string_split(text, ' '))) AS BIGINT) AS total_words,
    CAST(sum(len(list_filter(string_split(text, ' '), lambda w: length(w) > 4))) AS BIGINT) AS tp,
    CAST(sum(CASE WHEN lang = 'en' THEN 1 ELSE 0 END) AS BIGINT) AS tn, CAST(sum(CASE WHEN lang = 'fr' THEN 1 ELSE 0 END) AS BIGINT) AS fp,
    CAST(sum(len(list_filter(string_split(text, ' '), lambda w: length(w) <= 4))) AS BIGINT) AS fn FROM documents""",
)
def _(d):
    return images.score_totals(recognition_results(d))


def recognition_results(d: Data) -> DataFrame:
    """Documents in the shape of text-recognition results: long words count as recognised."""
    words = F.split("text", " ")
    found = F.filter(words, lambda w: F.length(w) > 4)
    return d.table("documents").select(
        found.alias("words"),
        F.size(found).alias("recognized_words"), F.size(words).alias("total_words"), F.size(found).alias("tp"),
        (F.col("lang") == "en").cast("int").alias("tn"), (F.col("lang") == "fr").cast("int").alias("fp"),
        (F.size(words) - F.size(found)).alias("fn"),
    )


@query(
    "agg_17_recognized_words",
    """SELECT word, CAST(count(*) AS BIGINT) AS seen FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) t
    WHERE length(word) > 4 GROUP BY 1""",
)
def _(d):
    return images.recognized_words(recognition_results(d))


@query(
    "agg_18_identity_description",
    """SELECT CAST(count(DISTINCT id_random) AS BIGINT) AS patients, CAST(count(*) AS BIGINT) AS women, CAST(0 AS BIGINT) AS men,
    strftime(min(date_naiss), '%d/%m/%Y') AS oldest, strftime(max(date_naiss), '%d/%m/%Y') AS youngest
    FROM v_population p JOIN v_mapping m ON p.id_bci = m.id_bci WHERE nni_2 IS NOT NULL""",
)
def _(d):
    from cohortloom.sources.registry import registry_projection

    people = cohort.identity_table(population_with_ids(d).withColumnRenamed("nni_2_cle", "NNI_2_cle"))
    return reports.identity_description(registry_projection(people))


# --- windows and limits -------------------------------------------------------------------


@query(
    "win_01_latest_per_person",
    """SELECT id_bci, id_event, CAST(date_mammo AS VARCHAR) AS date_mammo FROM (SELECT *, row_number() OVER (PARTITION BY id_bci
    ORDER BY date_mammo DESC, id_event DESC) AS rn FROM v_depistage WHERE id_bci IS NOT NULL) t WHERE rn = 1""",
)
def _(d):
    last = keys.force_key(exam_rows(d), "id_bci", ["Date_Mammo", "id_event"])
    return last.select("id_bci", "id_event", F.col("Date_Mammo").cast("string").alias("date_mammo"))


@query("win_02_first_study_near_exam", "SELECT id_event, dicom_study FROM ex WHERE has_history", EXAMS)
def _(d):
    imaged = exams.with_any_study(exam_rows(d), appts(d), "id_bci")
    matched = exams.match_studies(imaged, appts(d), "id_bci", "Date_Mammo")
    return matched.select("id_event", F.col("DICOM_Study").alias("dicom_study"))


@query("win_03_renumber", "SELECT id_bci, CAST(row_number() OVER (ORDER BY nom DESC, id_bci) AS BIGINT) AS position FROM v_population")
def _(d):
    people = d.v_population.select("id_bci", (-F.col("id_bci")).alias("_k"), "nom")
    reverse = people.withColumn("_desc", -F.regexp_replace("nom", "[^0-9]", "").cast("bigint"))
    return numbering.number_rows(reverse, ["_desc", "id_bci"]).select("id_bci", "position")


@query(
    "win_04_retrieval_order",
    """SELECT uid, CAST(newest AS VARCHAR) AS newest_exam, person_id, strftime(ts, '%Y-%m-%d') AS first_seen FROM (
    SELECT a.uid, n.newest, a.person_id, a.ts, row_number() OVER (PARTITION BY a.uid ORDER BY n.newest DESC, a.person_id, a.ts) AS rn
    FROM appts a JOIN (SELECT id_bci, max(date_mammo) AS newest FROM v_depistage WHERE id_bci IS NOT NULL GROUP BY 1) n
    ON a.person_id = n.id_bci) t WHERE rn = 1""",
    APPTS,
)
def _(d):
    order = exams.retrieval_order(exam_rows(d), appts(d), "id_bci", "Date_Mammo")
    return order.select(
        "uid", F.col("newest_exam").cast("string").alias("newest_exam"), "person_id",
        F.date_format("appointment_ts", "yyyy-MM-dd").alias("first_seen"),
    )


@query(
    "win_05_pages",
    "SELECT uid, CAST(floor((rn - 1) / 10) AS BIGINT) AS page FROM (SELECT uid, row_number() OVER (ORDER BY uid) AS rn FROM (SELECT DISTINCT uid FROM appts) u) t",
    APPTS,
)
def _(d):
    return shard.page_of(appts(d).select("uid").distinct(), ["uid"], 10)


@query("win_06_limit", "SELECT id_event FROM (SELECT id_event FROM v_depistage ORDER BY date_mammo DESC, id_event LIMIT 25) t")
def _(d):
    return exam_rows(d).orderBy(F.desc("Date_Mammo"), "id_event").limit(25).select("id_event")


@query(
    "win_07_top_values",
    " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS n,
        CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS BIGINT) AS rank FROM v_depistage WHERE {c} IS NOT NULL GROUP BY {c}) t WHERE rank <= 10"""
        for c in ("id_bci", "l1_acr_sd", "ecs", "resultat_global", "age_raw")
    ),
)
def _(d):
    from cohortloom.operators.profile import top_values, value_counts

    columns = ("id_bci", "l1_acr_sd", "ecs", "resultat_global", "age_raw")
    return top_values(value_counts(d.v_depistage, columns)).withColumn("rank", F.col("rank").cast("bigint"))


@query("win_08_sorted", "SELECT id_event, CAST(date_mammo AS VARCHAR) AS date_mammo, id_bci FROM v_depistage ORDER BY date_mammo DESC, id_event")
def _(d):
    return exam_rows(d).orderBy(F.desc("Date_Mammo"), "id_event").select(
        "id_event", F.col("Date_Mammo").cast("string").alias("date_mammo"), "id_bci"
    )


# --- sets ---------------------------------------------------------------------------------


@query(
    "set_01_union_by_name",
    "SELECT id_bci, nom, email, NULL AS id_random FROM v_population UNION ALL SELECT id_bci, NULL, NULL, id_random FROM v_mapping",
)
def _(d):
    people = d.v_population.select("id_bci", "nom", "email")
    return people.unionByName(d.v_mapping, allowMissingColumns=True)


@query(
    "set_02_both_directions",
    """SELECT id_a, id_b FROM (SELECT id_bci AS id_a, id_random AS id_b FROM v_mapping UNION ALL SELECT id_random, id_bci FROM v_mapping) t""",
)
def _(d):
    forward = d.v_mapping.select(F.col("id_bci").alias("id_a"), F.col("id_random").alias("id_b"))
    return forward.unionByName(forward.select(F.col("id_b").alias("id_a"), F.col("id_a").alias("id_b")))


@query("set_03_key_difference", "SELECT DISTINCT k_adicap2 AS key_value FROM v_suivi WHERE k_adicap2 IS NOT NULL AND k_adicap2 NOT IN (SELECT code_adicap FROM v_adicap)")
def _(d):
    return keys.key_difference(d.v_suivi, "k_adicap2", d.v_adicap, "code_adicap")


WITHOUT_STUDY = """SELECT CAST(year(day) AS BIGINT) AS year, CAST(count(*) AS BIGINT) AS dates FROM (
  SELECT DISTINCT m.id_random, e.date_mammo AS day FROM ex e JOIN v_mapping m ON e.id_bci = m.id_bci
  WHERE e.has_history {more} AND NOT EXISTS (SELECT 1 FROM appts a WHERE a.person_id = e.id_bci AND a.ts = e.date_mammo)) t GROUP BY 1"""


@query("set_04_dates_without_study", WITHOUT_STUDY.format(more=""), EXAMS)
def _(d):
    people = d.v_mapping
    rows = exams.with_any_study(exam_rows(d), appts(d), "id_bci").join(people, "id_bci")
    out = exams.dates_without_study(rows, appts(d), "id_bci", "id_random", "Date_Mammo")
    return out.withColumn("year", F.col("year").cast("bigint"))


# --- nested histories ---------------------------------------------------------------------


JSON_SQL = """SELECT person_id, '{"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '": [["' || string_agg(uid, '","' ORDER BY uid) || '"], '
 || CAST(CAST(sum(files) AS BIGINT) AS VARCHAR) || ']}' AS dicom_studies FROM appts GROUP BY person_id, ts"""


def history_texts(d: Data) -> DataFrame:
    text = history.appointment_json("appointment_ts", "uids", "file_count")
    return exams.history(appts(d)).select("person_id", text.alias("dicom_studies"))


@query("jsn_01_history_json", JSON_SQL, APPTS)
def _(d):
    return history_texts(d)


@query("jsn_02_parse_history", HISTORY_SQL, APPTS)
def _(d):
    entries = history_texts(d).select("person_id", F.explode(history.parse_history("dicom_studies")).alias("h"))
    return history_out(entries.select("person_id", "h.*"))


@query("jsn_03_match_studies", "SELECT id_event, dicom_study FROM ex", EXAMS)
def _(d):
    matched = exams.match_studies(exam_rows(d), appts(d), "id_bci", "Date_Mammo")
    return matched.select("id_event", F.col("DICOM_Study").alias("dicom_study"))


STUDIES_SQL = """SELECT DISTINCT m.id_random, strftime(a.ts, '%Y-%m-%d') AS date, a.uid AS study_id
 FROM {source} a JOIN v_depistage e ON a.person_id = e.id_bci JOIN v_mapping m ON m.id_bci = e.id_bci {where}"""


def studies(d: Data, date: str | None = None, mode: str = "all") -> DataFrame:
    people = exam_rows(d).join(d.v_mapping, "id_bci")
    return exams.build_studies(people, appts(d), "id_bci", "id_random", date, mode)


def studies_out(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("jsn_04_build_studies", STUDIES_SQL.format(source="appts", where=""), APPTS)
def _(d):
    return studies_out(studies(d))


@query("jsn_04_build_studies_near_exam", STUDIES_SQL.format(source="appts", where=f"WHERE {NEAR}"), APPTS)
def _(d):
    return studies_out(studies(d, "Date_Mammo"))


@query(
    "jsn_04_build_studies_last",
    STUDIES_SQL.format(source="(SELECT person_id, ts, max(uid) AS uid FROM appts GROUP BY 1, 2)", where=""),
    APPTS,
)
def _(d):
    return studies_out(studies(d, mode="last"))


@query(
    "jsn_05_first_appointment",
    """SELECT person_id, string_agg(uid, ',' ORDER BY uid) AS uids FROM appts a
    WHERE ts = (SELECT min(ts) FROM appts b WHERE b.person_id = a.person_id) GROUP BY 1""",
    APPTS,
)
def _(d):
    first = exams.first_appointment(appts(d)).groupBy("person_id").agg(F.array_sort(F.collect_set("uid")).alias("uids"))
    return first.select("person_id", F.array_join("uids", ",").alias("uids"))


@query("jsn_06_flatten_uids", "SELECT person_id, uid FROM appts", APPTS)
def _(d):
    return exams.history(appts(d)).select("person_id", F.explode("uids").alias("uid"))


@query("jsn_07_distinct_uids", "SELECT DISTINCT person_id, uid FROM appts", APPTS)
def _(d):
    doubled = exams.history(appts(d)).withColumn("uids", F.concat("uids", "uids"))
    return exams.long_from_history(doubled).select("person_id", "uid").distinct()
