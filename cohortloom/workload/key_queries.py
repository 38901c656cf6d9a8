"""Queries for keys and column rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.functions import clean
from cohortloom.operators import cohort, keys
from cohortloom.plans import requests
from cohortloom.sources.imaging import clean_index
from cohortloom.spec import IMAGING_KEY
from cohortloom.workload.registry import query

SUIVI_ORDER = ("date_anapath", "ligne", "k_adicap", "k_adicap2", "taille_en_mm", "montant", "remise", "taxe", "trait_radi", "her2")
SUIVI_DESC = ", ".join(f"{c} DESC NULLS LAST" for c in SUIVI_ORDER)
SUIVI_OUT = "id_event, CAST(date_anapath AS VARCHAR) AS date_anapath, k_adicap, k_adicap2, taille_en_mm, CAST(ligne AS BIGINT) AS ligne, montant"

# Imaging index as the reference SQL sees it: sentinels removed, complete key, last row per key.
GUID_CLEAN = """
g AS (SELECT ord, person_id, appointment_date, mammogram_date,
  CASE WHEN study_instance_uid NOT IN ('', 'None') THEN study_instance_uid END AS study_instance_uid,
  CASE WHEN dicom_study_id NOT IN ('', 'None') THEN dicom_study_id END AS dicom_study_id,
  CASE WHEN file_guid NOT IN ('', 'None') THEN file_guid END AS file_guid,
  CASE WHEN center_name NOT IN ('', 'None') THEN center_name END AS center_name
  FROM v_dicom_guid)"""
GUID_KEYED = GUID_CLEAN + """,
guid AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY study_instance_uid, appointment_date, file_guid
  ORDER BY ord DESC) AS rn FROM g WHERE study_instance_uid IS NOT NULL AND appointment_date IS NOT NULL
  AND file_guid IS NOT NULL) t WHERE rn = 1)"""


def suivi_out(df):
    return df.select(
        "id_event", F.col("date_anapath").cast("string").alias("date_anapath"), "k_adicap", "k_adicap2",
        "taille_en_mm", F.col("ligne").cast("bigint").alias("ligne"), "montant",
    )


@query("key_01_na_rows", "SELECT id_bci, nom FROM v_population WHERE nni_2 IS NULL OR email IS NULL")
def _(d):
    return keys.na_rows(d.v_population, ["nni_2", "email"]).select("id_bci", "nom")


@query("key_02_notna_rows", "SELECT id_bci, nom FROM v_population WHERE nni_2 IS NOT NULL AND email IS NOT NULL")
def _(d):
    return keys.notna_rows(d.v_population, ["nni_2", "email"]).select("id_bci", "nom")


@query(
    "key_03_dup_rows",
    f"SELECT {SUIVI_OUT} FROM v_suivi WHERE id_event IN (SELECT id_event FROM v_suivi GROUP BY id_event HAVING count(*) > 1)",
)
def _(d):
    return suivi_out(keys.dup_rows(keys.notna_rows(d.v_suivi, "id_event"), "id_event"))


@query(
    "key_04_keep_last",
    f"SELECT {SUIVI_OUT} FROM (SELECT *, row_number() OVER (PARTITION BY id_event ORDER BY {SUIVI_DESC}) AS rn FROM v_suivi) t WHERE rn = 1",
)
def _(d):
    return suivi_out(keys.keep_last(d.v_suivi, "id_event", SUIVI_ORDER))


@query(
    "key_05_force_pk",
    "SELECT ord, person_id, CAST(appointment_date AS VARCHAR) AS appointment_date, study_instance_uid, file_guid, center_name FROM guid",
    extra=GUID_KEYED,
)
def _(d):
    forced = keys.force_key(clean_index(d.v_dicom_guid), IMAGING_KEY, ["ord"])
    return forced.select(
        "ord", "person_id", F.col("appointment_date").cast("string").alias("appointment_date"),
        "study_instance_uid", "file_guid", "center_name",
    )


@query(
    "key_06_unique_audit",
    """SELECT 'na' AS kind, id_bci, nni_2 FROM v_population WHERE nni_2 IS NULL
    UNION ALL SELECT 'dup' AS kind, id_bci, nni_2 FROM v_population
    WHERE nni_2 IN (SELECT nni_2 FROM v_population GROUP BY nni_2 HAVING count(*) > 1)""",
)
def _(d):
    na, dup = keys.unique_audit(d.v_population, "nni_2")
    parts = [df.select(F.lit(kind).alias("kind"), "id_bci", "nni_2") for kind, df in (("na", na), ("dup", dup))]
    return parts[0].unionByName(parts[1])


@query(
    "key_07_check_fks",
    """SELECT 'suivi.id_event' AS foreign_key, 'depistage.id_event' AS "references", CAST(count(*) AS BIGINT) AS orphans,
      min(CAST(k AS VARCHAR)) AS example FROM (SELECT DISTINCT id_event AS k FROM v_suivi WHERE id_event IS NOT NULL) c
      WHERE k NOT IN (SELECT id_event FROM v_depistage)
    UNION ALL SELECT 'suivi.k_adicap', 'adicap.code_adicap', CAST(count(*) AS BIGINT), min(k) FROM
      (SELECT DISTINCT k_adicap AS k FROM v_suivi WHERE k_adicap IS NOT NULL) c WHERE k NOT IN (SELECT code_adicap FROM v_adicap)
    UNION ALL SELECT 'suivi.k_adicap2', 'adicap.code_adicap', CAST(count(*) AS BIGINT), min(k) FROM
      (SELECT DISTINCT k_adicap2 AS k FROM v_suivi WHERE k_adicap2 IS NOT NULL) c WHERE k NOT IN (SELECT code_adicap FROM v_adicap)
    UNION ALL SELECT 'depistage.id_bci', 'population.id_bci', CAST(count(*) AS BIGINT), min(CAST(k AS VARCHAR)) FROM
      (SELECT DISTINCT id_bci AS k FROM v_depistage WHERE id_bci IS NOT NULL) c WHERE k NOT IN (SELECT id_bci FROM v_population)""",
)
def _(d):
    tables = {"suivi": d.v_suivi, "depistage": d.v_depistage, "adicap": d.v_adicap, "population": d.v_population}
    fks = [
        keys.ForeignKey("suivi", "id_event", "depistage"),
        keys.ForeignKey("suivi", "k_adicap", "adicap"),
        keys.ForeignKey("suivi", "k_adicap2", "adicap"),
        keys.ForeignKey("depistage", "id_bci", "population"),
    ]
    return keys.fk_report(tables, fks, {"depistage": "id_event", "adicap": "code_adicap", "population": "id_bci"})


@query("key_09_distinct_values", "SELECT DISTINCT study_instance_uid FROM guid", extra=GUID_KEYED)
def _(d):
    return keys.distinct_values(d.imaging, "study_instance_uid")


@query(
    "key_10_empty_columns",
    """SELECT study_key, sop_uid, laterality, operator_name FROM v_image_meta""",
)
def _(d):
    meta = d.v_image_meta.select("study_key", "sop_uid", "laterality", "annotation", "operator_name")
    return keys.drop_empty_columns(meta)


# --- column rules -------------------------------------------------------------------------


@query(
    "col_01_yes_no",
    """SELECT id_event, resultat_global, CASE WHEN resultat_global IN ('Oui','O','Positif','+','P') THEN 'true'
    WHEN resultat_global IN ('Non','N','Négatif','-') THEN 'false' END AS flag FROM v_depistage""",
)
def _(d):
    return d.v_depistage.select(
        "id_event", "resultat_global", clean.yes_no("resultat_global").cast("string").alias("flag")
    )


@query(
    "col_02_clean_age",
    """SELECT id_event, age_raw, CASE WHEN TRY_CAST(age_raw AS DOUBLE) > 0 AND TRY_CAST(age_raw AS DOUBLE) < 120
    THEN CAST(floor(TRY_CAST(age_raw AS DOUBLE)) AS BIGINT) END AS age FROM v_depistage""",
)
def _(d):
    return d.v_depistage.select("id_event", "age_raw", clean.clean_age("age_raw").alias("age"))


@query(
    "col_03_blank_to_null",
    "SELECT id_event, nullif(resultat_global, ' ') AS value FROM v_depistage",
)
def _(d):
    return d.v_depistage.select("id_event", clean.blank_to_null("resultat_global").alias("value"))


@query("col_04_sentinel_to_null", "SELECT ord, study_instance_uid, dicom_study_id, file_guid, center_name FROM g", extra=GUID_CLEAN)
def _(d):
    return clean_index(d.v_dicom_guid).select("ord", "study_instance_uid", "dicom_study_id", "file_guid", "center_name")


@query(
    "col_05_nullable_int",
    "SELECT ord, CASE WHEN person_text NOT IN ('', 'None') THEN CAST(nullif(nullif(person_text, ''), 'None') AS BIGINT) END AS person_id FROM v_dicom_guid",
)
def _(d):
    return d.v_dicom_guid.select("ord", clean.to_nullable_int("person_text").alias("person_id"))


@query(
    "col_06_one_hot",
    """SELECT id_event, CASE WHEN ecs = 'Normal' THEN 1 ELSE 0 END AS normal,
    CASE WHEN ecs = 'Anormal' THEN 1 ELSE 0 END AS anormal, CASE WHEN ecs = 'Refusé' THEN 1 ELSE 0 END AS refus FROM v_depistage""",
)
def _(d):
    names = {"Normal": "normal", "Anormal": "anormal", "Refusé": "refus"}
    flags = clean.one_hot(d.v_depistage.select("id_event", "ecs"), "ecs", names)
    return flags.select("id_event", *[F.col(c).cast("int").alias(c) for c in names.values()])


@query("col_07_rename", "SELECT code_adicap AS Anapath_code_adicap, adicap AS Anapath_adicap FROM v_adicap")
def _(d):
    return d.v_adicap.withColumnsRenamed({"code_adicap": "Anapath_code_adicap", "adicap": "Anapath_adicap"})


@query(
    "col_08_strict_date",
    "SELECT id_event, strftime(strptime(date_text, '%d/%m/%Y'), '%Y-%m-%d %H:%M:%S') AS parsed FROM v_depistage",
)
def _(d):
    return d.v_depistage.select(
        "id_event", F.date_format(clean.strict_date("date_text"), "yyyy-MM-dd HH:mm:ss").alias("parsed")
    )


@query(
    "col_09_drop_identifying",
    """SELECT ligne_a AS id_event, ecs, segment FROM (SELECT d.id_event AS ligne_a, d.ecs, p.segment
    FROM v_depistage d LEFT JOIN v_population p ON d.id_bci = p.id_bci) t""",
)
def _(d):
    tagged = {
        "nni_2": "identifier", "nni_2_cle": "identifier", "sexe": "identifier", "nom": "identifier",
        "date_naiss": "identifier", "email": "identifier", "id_bci": "technical_id",
    }
    joined = d.v_depistage.select("id_event", "id_bci", "ecs").join(d.v_population, "id_bci", "left")
    marked = joined.select(
        *[F.col(c).alias(c, metadata={"sensitivity": tagged.get(c, "property")}) for c in joined.columns]
    )
    return cohort.hide_classes(marked, "identifier", "technical_id")


@query(
    "col_10_month_distance",
    """SELECT ord, CAST(abs((year(appointment_date) - year(mammogram_date)) * 12 + month(appointment_date)
    - month(mammogram_date)) AS BIGINT) AS months FROM v_dicom_guid""",
)
def _(d):
    return d.v_dicom_guid.select(
        "ord", clean.month_distance("appointment_date", "mammogram_date").cast("bigint").alias("months")
    )


@query(
    "col_11_age_years",
    """SELECT k.id_event, round(date_diff('day', a.date_naiss, k.date_mammo) / 365.25, 6) AS age_mammo,
    round(CASE WHEN upper(k.maladie_an_d) = 'K' THEN date_diff('day', a.date_naiss, k.operation_date) / 365.25 END, 6) AS age_cancer
    FROM v_ks k JOIN v_assure a ON k.id_assure = a.id_assure""",
)
def _(d):
    return d.v_ks.join(d.v_assure, "id_assure").select(
        "id_event",
        F.round(clean.age_years("date_mammo", "date_naiss"), 6).alias("age_mammo"),
        F.round(
            F.when(F.upper("maladie_an_d") == "K", clean.age_years("operation_date", "date_naiss")), 6
        ).alias("age_cancer"),
    )


ANOMALY_SQL = """CASE {c} WHEN 'A' THEN 'Opacité à contour spiculé' WHEN 'B' THEN 'Opacité à contour non spiculé'
 WHEN 'C' THEN 'Microcalcifications' WHEN 'D' THEN 'Opacité avec Microcalcifications' WHEN 'E' THEN 'Anomalie Architecturale'
 WHEN 'F' THEN 'Densité focale Asymétrique' WHEN 'G' THEN 'Autres anomalie' ELSE ' ' END"""
METASTASIS_SQL = """CASE malin_m WHEN '1' THEN 'Mx Inconnues' WHEN '2' THEN 'M0, pas de metastases ou polypectomie par voie naturelle'
 WHEN '3' THEN 'M1, metastases a distance (dont ganglions sus claviculaire)' ELSE ' ' END"""
LOCATION_SQL = """CASE s_lesloc WHEN '509' THEN 'Sein SAI' WHEN '508' THEN 'Lésion étendue du sein' WHEN '506' THEN 'Prolongement axillaire'
 WHEN '505' THEN 'QIE' WHEN '504' THEN 'QSE' WHEN '503' THEN 'QII' WHEN '502' THEN 'QSI' WHEN '501' THEN 'Région centrale du sein' ELSE '' END"""
MALIGNANT_SQL = """CASE malin_type WHEN '1' THEN 'In Situ Canalaire' WHEN '2' THEN 'In Situ Lobulaire' WHEN '3' THEN 'Invasif'
 WHEN '6' THEN 'Micro-invasif' ELSE ' ' END"""
BENIGN_SQL = """CASE benin_type WHEN '1' THEN 'Fibroadénome' WHEN '2' THEN 'Kyste solitaire' WHEN '3' THEN 'Adénose Sclérosante'
 WHEN '4' THEN 'Galactophorite-Ectasie' WHEN '5' THEN 'papillome' WHEN '6' THEN 'Dystrophie-Mastose fibrokystique'
 WHEN '7' THEN 'Prolifération épithéliale' WHEN '8' THEN 'Paget' ELSE ' ' END"""


@query(
    "col_12_label_chains",
    f"""SELECT id_event, {ANOMALY_SQL.format(c='suspec11_d')} AS anomaly, {METASTASIS_SQL} AS metastasis,
    {LOCATION_SQL} AS location, {MALIGNANT_SQL} AS malignant, {BENIGN_SQL} AS benign FROM v_ks""",
)
def _(d):
    label = clean.label_of
    return d.v_ks.select(
        "id_event",
        label("suspec11_d", requests.ANOMALY, " ").alias("anomaly"),
        label("malin_m", requests.METASTASIS, " ").alias("metastasis"),
        label("s_lesloc", requests.LOCATION, "").alias("location"),
        label("malin_type", requests.MALIGNANT, " ").alias("malignant"),
        label("benin_type", requests.BENIGN, " ").alias("benign"),
    )


CARE_SQL = {
    "Surveillance": ("'S03','S04','S05','S06','S09','S12','S18','S24'", "Surveillance"),
    "Cytoponction": ("'PCY'", "Exam_Cytoponction"),
    "Microbiopsie": ("'PMI'", "Exam_Microbiopsie"),
    "Macrobiopsie": ("'PMA'", "Exam_Macrobiopsie"),
    "AutrePEC": ("'AUT','IRM','PCH','PRP'", "Autre Prise en Charge"),
}


def care_sql(prefix: str, *columns: str) -> str:
    return ", ".join(
        "CASE WHEN " + " OR ".join(f"{c} IN ({codes})" for c in columns) + f" THEN '{label}' ELSE 'Non' END AS {prefix}_CAT_{name}"
        for name, (codes, label) in CARE_SQL.items()
    )


@query(
    "col_13_flag_in_lists",
    f"SELECT id_event, {care_sql('BDI', 'exam_cons1', 'exam_cons_echo_l1')}, {care_sql('L2', 'exam_cons2')} FROM v_ks",
)
def _(d):
    columns = {
        **requests.care_columns("BDI", "exam_cons1", "exam_cons_echo_l1"),
        **requests.care_columns("L2", "exam_cons2"),
    }
    return d.v_ks.select("id_event", *[c.alias(n) for n, c in columns.items()])


@query(
    "col_14_compact_date",
    """SELECT id_event, strftime(date_mammo, '%d%m%y') AS compact,
    CAST(id_event AS VARCHAR) || '_' || strftime(date_mammo, '%d%m%y') AS label FROM v_depistage""",
)
def _(d):
    short = F.concat(F.substring("date_text", 1, 6), F.substring("date_text", 9, 2))
    compact = d.v_depistage.select("id_event", clean.compact_date(short).alias("compact"))
    return compact.withColumn("label", clean.study_label("id_event", "compact"))


@query(
    "col_15_typed_parse",
    """SELECT id_event, CAST(id_event AS BIGINT) AS as_key, CASE WHEN id_event % 9 = 0 THEN NULL ELSE CAST(date_mammo AS VARCHAR) END AS as_date,
    CASE WHEN id_event % 9 = 1 THEN NULL ELSE CAST(date_mammo AS VARCHAR) || ' 08:30:00' END AS as_datetime, ecs AS as_text FROM v_depistage""",
)
def _(d):
    from cohortloom.sources.pages import typed_value

    ninth = F.col("id_event") % 9
    day = F.col("date_mammo").cast("string")
    raw_day = F.when(ninth == 0, F.lit("0000-00-00")).otherwise(day)
    raw_moment = F.when(ninth == 1, F.lit("2400-01-01 00:00:00")).otherwise(F.concat(day, F.lit(" 08:30:00")))
    return d.v_depistage.select(
        "id_event",
        typed_value(F.col("id_event").cast("string"), "primary_key").alias("as_key"),
        typed_value(raw_day, "date").cast("string").alias("as_date"),
        typed_value(raw_moment, "datetime").cast("string").alias("as_datetime"),
        typed_value(F.col("ecs"), "fkey_dico_ext").alias("as_text"),
    )


LEVEL = "CASE WHEN regexp_matches({c}, '^[0-9]+$') THEN CAST({c} AS INT) ELSE 0 END"


@query("col_16_acr_level", f"SELECT id_event, CAST({LEVEL.format(c='l1_acr_sd')} AS BIGINT) AS level FROM (SELECT id_event, CASE WHEN l1_acr_sd = 'x' THEN NULL ELSE l1_acr_sd END AS l1_acr_sd FROM v_depistage) t")
def _(d):
    return d.v_depistage.select("id_event", clean.acr_level("l1_acr_sd").cast("bigint").alias("level"))


RESULTS_SQL = """CASE WHEN l1_acr_sd IN ('1','2') AND l1_acr_sg IN ('1','2') THEN 'negative' ELSE 'positive' END AS l1_result,
 CASE WHEN l2_acr_sd IN ('1','2') AND l2_acr_sg IN ('1','2') THEN 'negative' ELSE 'positive' END AS l2_result"""


@query("col_17_reader_result", f"SELECT id_event, {RESULTS_SQL} FROM v_depistage")
def _(d):
    return d.v_depistage.select(
        "id_event",
        clean.reader_result("l1_acr_sd", "l1_acr_sg").alias("l1_result"),
        clean.reader_result("l2_acr_sd", "l2_acr_sg").alias("l2_result"),
    )


@query(
    "col_18_highest_acr",
    """SELECT id_event, CAST(greatest(CASE WHEN l1_acr_sd IN ('0','1','2','3','4','5') THEN CAST(nullif(l1_acr_sd, 'x') AS INT) ELSE 0 END,
    CAST(l1_acr_sg AS INT), CAST(l2_acr_sd AS INT), CAST(l2_acr_sg AS INT)) AS BIGINT) AS highest FROM v_depistage""",
)
def _(d):
    highest = clean.highest_acr("l1_acr_sd", "l1_acr_sg", "l2_acr_sd", "l2_acr_sg")
    return d.v_depistage.select("id_event", highest.cast("bigint").alias("highest"))


@query(
    "col_19_valid_email",
    r"SELECT id_bci, email FROM v_population WHERE regexp_matches(email, '^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9.-]+$')",
)
def _(d):
    return d.v_population.select("id_bci", clean.valid_email("email").alias("email")).dropna(subset=["email"])


@query(
    "col_20_registry_projection",
    """SELECT p.nni_2 AS NIR_du_beneficiaire, strftime(p.date_naiss, '%d/%m/%Y') AS Date_de_naissance, '2' AS Code_sexe,
    p.nni_2 AS NIR_du_ouvrant_droit, CAST(m.id_random AS VARCHAR) AS Identifiant_temporaire
    FROM v_population p JOIN v_mapping m ON p.id_bci = m.id_bci WHERE p.nni_2 IS NOT NULL""",
)
def _(d):
    from cohortloom.sources.registry import registry_projection

    people = cohort.add_mapping(d.v_population, d.v_mapping).withColumnsRenamed({"nni_2": "NNI_2", "nni_2_cle": "NNI_2_cle"})
    return registry_projection(cohort.identity_table(people))


@query(
    "col_21_padded_numbers",
    """SELECT id_event, strftime(date_mammo, '%j') AS day_of_year, lpad(CAST(id_event AS VARCHAR), 9, '0') AS padded FROM v_depistage""",
)
def _(d):
    return d.v_depistage.select(
        "id_event", clean.day_of_year("date_mammo").alias("day_of_year"),
        clean.zero_padded(F.col("id_event"), 9).alias("padded"),
    )


@query("col_22_strip_time", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def _(d):
    return d.events.select("event_id", clean.strip_time("ts").cast("string").alias("day"))


LINK_SQL = "(length(file_guid) > 10 OR length(study_instance_uid) > 10 OR length(dicom_study_id) > 10)"


@query("col_23_link_flag", f"SELECT ord, CAST({LINK_SQL} AS VARCHAR) AS linked FROM g", extra=GUID_CLEAN)
def _(d):
    link = clean.long_link("file_guid", "study_instance_uid", "dicom_study_id")
    return clean_index(d.v_dicom_guid).select("ord", link.cast("string").alias("linked"))


@query(
    "col_24_presence_label",
    "SELECT ord, CASE WHEN dicom_study_id IS NOT NULL THEN 'Some' ELSE '-' END AS held FROM g",
    extra=GUID_CLEAN,
)
def _(d):
    return clean_index(d.v_dicom_guid).select("ord", clean.presence("dicom_study_id").alias("held"))


VIEW_SQL = """CASE WHEN view_code IS NULL OR laterality IS NULL THEN 'N/A'
 WHEN view_code = 'R-10226' THEN CASE WHEN upper(laterality) = 'R' THEN 'rmlo' ELSE 'lmlo' END
 WHEN view_code = 'R-10242' THEN CASE WHEN upper(laterality) = 'R' THEN 'rcc' ELSE 'lcc' END
 WHEN view_code = 'R-10224' THEN 'ml' END"""


@query("col_25_view_label", f"SELECT sop_uid, {VIEW_SQL} AS view FROM v_image_meta")
def _(d):
    from cohortloom.operators.images import view_label

    return d.v_image_meta.select("sop_uid", view_label("view_code", "laterality").alias("view"))


@query("col_26_has_value", "SELECT ord, CAST(CASE WHEN mammogram_date IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS has_mammogram FROM v_dicom_guid")
def _(d):
    return d.v_dicom_guid.select("ord", F.col("mammogram_date").isNotNull().cast("bigint").alias("has_mammogram"))


@query(
    "col_27_receptor_label",
    """SELECT id_event, CASE WHEN k_proges = 'O' AND rh = '+' THEN 'Positif' WHEN k_proges = 'O' AND rh = '-' THEN 'Négatif' END AS progesterone,
    CASE WHEN k_oestro = 'O' AND rh = '+' THEN 'Positif' WHEN k_oestro = 'O' AND rh = '-' THEN 'Négatif' END AS oestrogen FROM v_ks""",
)
def _(d):
    return d.v_ks.select(
        "id_event",
        clean.receptor_label("k_proges", "rh").alias("progesterone"),
        clean.receptor_label("k_oestro", "rh").alias("oestrogen"),
    )
