"""The extraction requests: source-database tables to the extracts of the cohort.

Column names are those of the source database (lower case); the results have the column
names of the extracts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.clean import age_years, flag_in, label_of, receptor_label

# ---------------------------------------------------------------------------
# Codes of the source database and their labels.
# ---------------------------------------------------------------------------
ANOMALY = {
    "A": "Opacité à contour spiculé",
    "B": "Opacité à contour non spiculé",
    "C": "Microcalcifications",
    "D": "Opacité avec Microcalcifications",
    "E": "Anomalie Architecturale",
    "F": "Densité focale Asymétrique",
    "G": "Autres anomalie",
}
CLINICAL_EXAM = {"A": "Anormal", "N": "Normal", "R": "Refusé"}
METASTASIS = {
    "1": "Mx Inconnues",
    "2": "M0, pas de metastases ou polypectomie par voie naturelle",
    "3": "M1, metastases a distance (dont ganglions sus claviculaire)",
}
LOCATION = {
    "509": "Sein SAI",
    "508": "Lésion étendue du sein",
    "506": "Prolongement axillaire",
    "505": "QIE",
    "504": "QSE",
    "503": "QII",
    "502": "QSI",
    "501": "Région centrale du sein",
}
MALIGNANT = {"1": "In Situ Canalaire", "2": "In Situ Lobulaire", "3": "Invasif", "6": "Micro-invasif"}
BENIGN = {
    "1": "Fibroadénome",
    "2": "Kyste solitaire",
    "3": "Adénose Sclérosante",
    "4": "Galactophorite-Ectasie",
    "5": "papillome",
    "6": "Dystrophie-Mastose fibrokystique",
    "7": "Prolifération épithéliale",
    "8": "Paget",
}
SURVEILLANCE = ("S03", "S04", "S05", "S06", "S09", "S12", "S18", "S24")
FINE_NEEDLE = ("PCY",)
CORE_BIOPSY = ("PMI",)
VACUUM_BIOPSY = ("PMA",)
OTHER_CARE = ("AUT", "IRM", "PCH", "PRP")
CARE = {
    "Surveillance": (SURVEILLANCE, "Surveillance"),
    "Cytoponction": (FINE_NEEDLE, "Exam_Cytoponction"),
    "Microbiopsie": (CORE_BIOPSY, "Exam_Microbiopsie"),
    "Macrobiopsie": (VACUUM_BIOPSY, "Exam_Macrobiopsie"),
    "AutrePEC": (OTHER_CARE, "Autre Prise en Charge"),
}
LESION_DICTIONARY = "adks"
POSTCODES = "(^48.*)|(^30.*)"
# End of fixed values.

PERSON_COLUMNS = (
    "num_ref", "id_assure", "id_bci", "NNI_2", "NNI_2_cle", "sexe", "nom", "nom_jf", "prenom", "date_naiss", "email",
)
ID_COLUMNS = ("num_ref", "id_assure", "id_bci")


def exams_between(ks: DataFrame, first: str, last: str) -> DataFrame:
    return ks.filter(F.col("date_mammo").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def insured_exams(assure: DataFrame, ks: DataFrame, first: str, last: str) -> DataFrame:
    """Exams of the period with the insured person; the date filter reaches the scan."""
    return exams_between(ks, first, last).join(assure, "id_assure")


def women_list(assure: DataFrame, ks: DataFrame, first: str, last: str) -> DataFrame:
    """People with exams in the period and their number of exams.

    Exams are counted per insured number before the join, so persons meet one row each.
    """
    counts = exams_between(ks, first, last).groupBy("id_assure").agg(F.count("*").alias("_n"))
    joined = assure.join(counts, "id_assure")
    return joined.groupBy(*PERSON_COLUMNS).agg(F.sum("_n").alias("count(*)"))


def oui_non(condition: Column, yes: str = "Oui", no: str = "Non") -> Column:
    return F.when(condition, yes).otherwise(no)


def women_at_risk(assure: DataFrame, ks: DataFrame, first: str, last: str) -> DataFrame:
    """Declared history; codes are compared without regard to case, an absent age is null."""
    right, left = F.upper("maladie_an_d"), F.upper("maladie_an_g")
    either = F.coalesce(right == "K", F.lit(False)) | F.coalesce(left == "K", F.lit(False))
    both = F.coalesce(right == "K", F.lit(False)) & F.coalesce(left == "K", F.lit(False))
    cosmetic = F.coalesce(right == "E", F.lit(False)) | F.coalesce(left == "E", F.lit(False))
    operated = age_years("operation_date", "date_naiss")
    columns = {
        "Age_Mammo": age_years("date_mammo", "date_naiss"),
        "THS": oui_non(F.upper("menop_trai") == "O"),
        "ATCD_Cancer": oui_non(either),
        "Age_ATCD_Cancer": F.when(either, operated),
        "ATCD_Cancer_Bilateral": oui_non(both),
        "Age_ATCD_Cancer_Bilateral": F.when(both, operated),
        "ATCD_Chir_Esth": oui_non(cosmetic),
        "Age_ATCD_Chir_Esth": F.when(cosmetic, operated),
    }
    for relative in ("Mere", "Soeur", "Fille", "Autre"):
        declared = F.upper(f"ant_age_{relative.lower()}") == "O"
        columns[f"ATCD_Famil_{relative}"] = oui_non(declared, "O", "N")
        columns[f"Age_ATCD_Famil_{relative}"] = F.when(declared, F.col(f"age_{relative.lower()}"))
    return insured_exams(assure, ks, first, last).select(
        *ID_COLUMNS, "id_event", F.col("date_mammo").alias("Date_Mammo"), *[c.alias(n) for n, c in columns.items()]
    )


def care_columns(prefix: str, *codes: str) -> dict[str, Column]:
    return {f"{prefix}_CAT_{name}": flag_in(codes, values, label) for name, (values, label) in CARE.items()}


def screening_records(assure: DataFrame, ks: DataFrame, first: str, last: str) -> DataFrame:
    def anomaly(c: str) -> Column:
        return label_of(c, ANOMALY, " ")

    columns = {
        "Id_event": F.col("id_event"),
        "Date_Mammo": F.col("date_mammo"),
        "comparaison_SD": oui_non(F.col("comp_re_1d") == "S", "anomalie SD plus suspecte", " "),
        "comparaison_SG": oui_non(F.col("comp_re_1g") == "S", "anomalie SG plus suspecte", " "),
        "ECS": label_of("exam_clini", CLINICAL_EXAM, " "),
        "L1_ACR_SD": F.col("acr_sd11"),
        "L1_ACR_SG": F.col("acr_sg11"),
        "L1_Type_Image_SD": anomaly("suspec11_d"),
        "L1_Type_Image_SG": anomaly("suspec11_g"),
        "Echo_L1": oui_non(F.col("echo_l1") == "O", "Echo réalisé sur mammo négative"),
        "Echo_ECS_L1_Suspecte": oui_non(F.col("echo_l1_suspecte") == "O", "Echo_L1_Suspecte"),
        "BDI": oui_non(F.col("bilan_l1") == "O", "Bilan immédiat nécessaire", "Pas de BDI"),
        "BDI_Agrandissement": oui_non(F.col("bi_agrand") == "O", "BDI_Agrandissement"),
        "BDI_Cytoponction": oui_non(F.col("bi_cyto") == "O", "BDI_Cytoponction"),
        "BDI_Echographie": oui_non(F.col("bi_echo") == "O", "BDI_Echographie"),
        "BDI_ACR_SD": F.col("acr_sd1"),
        "BDI_ACR_SG": F.col("acr_sg1"),
        "BDI_Type_Image_SD": anomaly("suspec1_sd"),
        "BDI_Type_Image_SG": anomaly("suspec1_sg"),
        **care_columns("BDI", "exam_cons1", "exam_cons_echo_l1"),
        "L2_ACR_SD_SD": F.col("acr_sd2"),
        "L2_ACR_SD_SG": F.col("acr_sg2"),
        "L2_Type_Image_SD": anomaly("suspec2_sd"),
        "L2_Type_Image_SG": anomaly("suspec2_sg"),
        **care_columns("L2", "exam_cons2"),
        "resultat_global_L1L2": F.col("resultat"),
    }
    return insured_exams(assure, ks, first, last).select(*ID_COLUMNS, *[c.alias(n) for n, c in columns.items()])


def diagnoses(assure: DataFrame, ks: DataFrame, first: str, last: str) -> DataFrame:
    columns = {
        "Date_Mammo": F.col("date_mammo"),
        "pT": F.col("malin_t"),
        "pN": F.col("malin_n"),
        "M": label_of("malin_m", METASTASIS, " "),
        "Taille_en_mm": F.col("taille_mm"),
        "localisation": label_of("s_lesloc", LOCATION, ""),
        "k_adicap": F.col("k_adicap"),
        "k_adicap2": F.col("k_adicap2"),
        "Grade_SBR": F.col("grade"),
        "RH_Progesterone": F.coalesce(receptor_label("k_proges", "rh"), F.lit(" ")),
        "RH_Oestreogene": F.coalesce(receptor_label("k_oestro", "rh"), F.lit(" ")),
        "HER2": F.col("her2"),
        "Si_Malin": label_of("malin_type", MALIGNANT, " "),
        "Si_Benin": label_of("benin_type", BENIGN, " "),
        "KS_Confirme": oui_non(F.upper("situation_finale") == "K", "KS_confirmé", " "),
        "Date_Anapath": F.col("date_bilan"),
        "Date_Inter_Chir": F.col("date_inter"),
        "Trait_Radi": F.col("trait_radi"),
        "Date_Radi": F.col("date_radi"),
        "Trait_Horm": F.col("trait_horm"),
        "Date_Horm": F.col("date_horm"),
        "Trait_Chim": F.col("trait_chim"),
        "Date_Chim": F.col("date_chim"),
    }
    return insured_exams(assure, ks, first, last).select(
        *ID_COLUMNS, "id_event", *[c.alias(n) for n, c in columns.items()]
    )


def lesion_codes(dictionary: DataFrame, name: str = LESION_DICTIONARY) -> DataFrame:
    return dictionary.filter(F.col("dico") == name).select("code", "libelle")


def radiology_centres(centres: DataFrame) -> DataFrame:
    return centres.filter(F.col("esis_id_centre").isNotNull() | F.col("esis_date").isNotNull()).select(
        "id_centre", "num_centre", "esis_id_centre", "esis_date", "nom"
    )


def in_area(postcode: str) -> Column:
    return F.col(postcode).rlike(POSTCODES)


def imaging_extraction(
    appointments: DataFrame,
    people: DataFrame,
    readings: DataFrame,
    studies: DataFrame,
    documents: DataFrame,
    centres: DataFrame,
    limit: int | None = None,
) -> DataFrame:
    """Imaging index: appointment with person, reading, study, document and centre.

    The area condition rejects unknown centres, so people and centres act as filters and
    come first; studies and documents multiply the rows and come last.
    """
    ap, p, ex = appointments.alias("ap"), people.alias("p"), readings.alias("ex")
    m, d, c = studies.alias("m"), documents.alias("d"), centres.alias("c")
    joined = (
        ap.join(c.filter(in_area("c.postcode")), F.col("c.id_data") == F.col("ap.id_exam_center"))
        .join(p.filter(F.col("p.num_bci").isNotNull()), F.col("p.id_data") == F.col("ap.id_assure"))
        .join(ex, F.col("ap.id_lecture1") == F.col("ex.id_data"), "left")
        .join(m, F.col("m.id_rdv") == F.col("ap.id_data"), "left")
        .join(d, F.col("d.id_study") == F.col("m.id_data"), "left")
    )
    out = joined.select(
        F.col("p.num_bci").alias("person_id"),
        F.col("ex.date_mammo").alias("mammogram_date"),
        F.col("ap.date_heure").alias("appointment_date"),
        "m.study_instance_uid", "m.dicom_study_id", "m.date_study", "d.file_guid", "ap.id_exam_center",
        F.col("c.name").alias("center_name"),
    )
    return out if limit is None else out.limit(limit)
