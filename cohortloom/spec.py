"""Declarative description of the cohort tables: columns, keys, typing rules, sensitivity."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import types as T

from cohortloom.operators.keys import ForeignKey


@dataclass(frozen=True)
class TableSpec:
    """How one raw, all-string extract becomes a typed table."""

    name: str
    key: str
    file_suffix: str
    columns: Sequence[str]
    integers: Sequence[str] = ()
    numbers: Sequence[str] = ()
    dates: Sequence[str] = ()
    flags: Sequence[str] = ()
    ages: Sequence[str] = ()
    blanks: Sequence[str] = ()
    one_hot: Mapping[str, Mapping[str, str | None]] = field(default_factory=dict)
    rename: Mapping[str, str] = field(default_factory=dict)

    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


# ---------------------------------------------------------------------------
# Names of extract columns, their codes and the derived names.
# ---------------------------------------------------------------------------
IDS = ("num_ref", "id_assure", "id_bci")

POPULATION = TableSpec(
    name="population",
    key="id_bci",
    file_suffix="population.csv",
    columns=(*IDS, "NNI_2", "NNI_2_cle", "sexe", "nom", "nom_jf", "prenom", "date_naiss", "email", "count(*)"),
    integers=(*IDS, "count(*)"),
    dates=("date_naiss",),
    rename={"count(*)": "count"},
)

RISK = TableSpec(
    name="risque",
    key="id_event",
    file_suffix="risque ks.csv",
    columns=(
        *IDS, "id_event", "Date_Mammo", "Age_Mammo", "THS", "ATCD_Cancer", "Age_ATCD_Cancer",
        "ATCD_Cancer_Bilateral", "Age_ATCD_Cancer_Bilateral", "ATCD_Chir_Esth", "Age_ATCD_Chir_Esth",
        "ATCD_Famil_Mere", "Age_ATCD_Famil_Mere", "ATCD_Famil_Soeur", "Age_ATCD_Famil_Soeur",
        "ATCD_Famil_Fille", "Age_ATCD_Famil_Fille", "ATCD_Famil_Autre", "Age_ATCD_Famil_Autre",
    ),
    integers=(*IDS, "id_event"),
    dates=("Date_Mammo",),
    flags=(
        "THS", "ATCD_Cancer", "ATCD_Cancer_Bilateral", "ATCD_Chir_Esth", "ATCD_Famil_Mere",
        "ATCD_Famil_Soeur", "ATCD_Famil_Fille", "ATCD_Famil_Autre",
    ),
    ages=(
        "Age_Mammo", "Age_ATCD_Cancer", "Age_ATCD_Cancer_Bilateral", "Age_ATCD_Chir_Esth",
        "Age_ATCD_Famil_Mere", "Age_ATCD_Famil_Soeur", "Age_ATCD_Famil_Fille", "Age_ATCD_Famil_Autre",
    ),
)

SCREENING = TableSpec(
    name="depistage",
    key="id_event",
    file_suffix="dépistages.csv",
    columns=(
        *IDS, "Id_event", "Date_Mammo", "comparaison_SD", "comparaison_SG", "ECS", "L1_ACR_SD", "L1_ACR_SG",
        "L1_Type_Image_SD", "L1_Type_Image_SG", "Echo_L1", "Echo_ECS_L1_Suspecte", "BDI",
        "BDI_Agrandissement", "BDI_Cytoponction", "BDI_Echographie", "BDI_ACR_SD", "BDI_ACR_SG",
        "BDI_Type_Image_SD", "BDI_Type_Image_SG", "BDI_CAT_Surveillance", "BDI_CAT_Cytoponction",
        "BDI_CAT_Microbiopsie", "BDI_CAT_Macrobiopsie", "BDI_CAT_AutrePEC", "L2_ACR_SD_SD", "L2_ACR_SD_SG",
        "L2_Type_Image_SD", "L2_Type_Image_SG", "L2_CAT_Surveillance", "L2_CAT_Cytoponction",
        "L2_CAT_Microbiopsie", "L2_CAT_Macrobiopsie", "L2_CAT_AutrePEC", "resultat_global_L1L2",
    ),
    integers=(*IDS, "Id_event"),
    dates=("Date_Mammo",),
    flags=("resultat_global_L1L2",),
    blanks=(
        "L1_Type_Image_SD", "L1_Type_Image_SG", "BDI_Type_Image_SG", "BDI_Type_Image_SD",
        "L2_Type_Image_SD", "L2_Type_Image_SG",
    ),
    one_hot={
        "BDI": {"Bilan immédiat nécessaire": "BDI", "Pas de BDI": None},
        "comparaison_SD": {"anomalie SD plus suspecte": "comparaison_SD_plus_suspecte"},
        "comparaison_SG": {"anomalie SG plus suspecte": "comparaison_SG_plus_suspecte"},
        "ECS": {
            "Normal": "Examen_Clinique_Sein_Normal",
            "Anormal": "Examen_Clinique_Sein_Anormal",
            "Refusé": "Examen_Clinique_Sein_Refus",
        },
        "Echo_L1": {"Echo réalisé sur mammo négative": "Echo_L1_Negative", "Non": None},
        "Echo_ECS_L1_Suspecte": {"Echo_L1_Suspecte": "Echo_L1_Suspecte", "Non": None},
        "BDI_Agrandissement": {"BDI_Agrandissement": "BDI_Agrandissement", "Non": None},
        "BDI_Cytoponction": {"BDI_Cytoponction": "BDI_Cytoponction", "Non": None},
        "BDI_Echographie": {"BDI_Echographie": "BDI_Echographie", "Non": None},
        "BDI_CAT_Surveillance": {"Surveillance": "L1_Conduite_a_tenir_Surveillance", "Non": None},
        "BDI_CAT_Cytoponction": {"Exam_Cytoponction": "L1_Conduite_a_tenir_Cytoponction", "Non": None},
        "BDI_CAT_Microbiopsie": {"Exam_Microbiopsie": "L1_Conduite_a_tenir_Microbiopsie", "Non": None},
        "BDI_CAT_Macrobiopsie": {"Exam_Macrobiopsie": "L1_Conduite_a_tenir_Macrobiopsie", "Non": None},
        "BDI_CAT_AutrePEC": {"Autre Prise en Charge": "L1_Conduite_a_tenir_Autre", "Non": None},
        "L2_CAT_Surveillance": {"Surveillance": "L2_Conduite_a_tenir_Surveillance", "Non": None},
        "L2_CAT_Cytoponction": {"Exam_Cytoponction": "L2_Conduite_a_tenir_Cytoponction", "Non": None},
        "L2_CAT_Microbiopsie": {"Exam_Microbiopsie": "L2_Conduite_a_tenir_Microbiopsie", "Non": None},
        "L2_CAT_Macrobiopsie": {"Exam_Macrobiopsie": "L2_Conduite_a_tenir_Macrobiopsie", "Non": None},
        "L2_CAT_AutrePEC": {"Autre Prise en Charge": "L2_Conduite_a_tenir_Autre", "Non": None},
    },
    rename={"L2_ACR_SD_SD": "L2_ACR_SD", "L2_ACR_SD_SG": "L2_ACR_SG", "Id_event": "id_event"},
)

FOLLOW_UP = TableSpec(
    name="suivi",
    key="id_event",
    file_suffix="suivi.csv",
    columns=(
        *IDS, "id_event", "Date_Mammo", "pT", "pN", "M", "Taille_en_mm", "localisation", "k_adicap",
        "k_adicap2", "Grade_SBR", "RH_Progesterone", "RH_Oestreogene", "HER2", "Si_Malin", "Si_Benin",
        "KS_Confirme", "Date_Anapath", "Date_Inter_Chir", "Trait_Radi", "Date_Radi", "Trait_Horm",
        "Date_Horm", "Trait_Chim", "Date_Chim",
    ),
    integers=(*IDS, "id_event"),
    numbers=("Taille_en_mm",),
    dates=("Date_Mammo", "Date_Anapath", "Date_Inter_Chir", "Date_Radi", "Date_Horm", "Date_Chim"),
    flags=("RH_Progesterone", "RH_Oestreogene", "Trait_Radi", "Trait_Chim", "Trait_Horm", "HER2"),
    blanks=("M", "Si_Malin", "Si_Benin"),
    one_hot={"KS_Confirme": {"KS_confirmé": "KS_confirme"}},
)

LESION_CODES = TableSpec(
    name="adicap",
    key="code_adicap",
    file_suffix="adicap ks.csv",
    columns=("code", "libelle"),
    rename={"code": "code_adicap", "libelle": "adicap"},
)

# Key and file name only: the centre list has no typing rules and is not part of the cohort.
CENTRES = TableSpec(
    name="cim",
    key="id_centre",
    file_suffix="liste cim.csv",
    columns=("id_centre", "num_centre", "esis_id_centre", "esis_date", "nom"),
)

SOURCES = {s.name: s for s in (POPULATION, RISK, SCREENING, FOLLOW_UP, LESION_CODES, CENTRES)}
COHORT_SOURCES = ("population", "risque", "depistage", "suivi", "adicap")

SOURCE_KEYS = {name: SOURCES[name].key for name in SOURCES}
SOURCE_FKS = (
    ForeignKey("suivi", "id_event", "depistage"),
    ForeignKey("suivi", "k_adicap", "adicap"),
    ForeignKey("suivi", "k_adicap2", "adicap"),
    ForeignKey("risque", "id_event", "depistage"),
    ForeignKey("depistage", "id_bci", "population"),
)

COHORT_KEYS = {
    "depistage_pseudo": ("id_random", "Date_Mammo"),
    "cnam": ("id_random",),
    "table_correspondance": ("id_random",),
    "mail": ("email",),
}
COHORT_UNIQUE = {"cnam": (("NNI_2",),)}
COHORT_FKS = (
    ForeignKey("depistage_pseudo", "id_random", "table_correspondance"),
    ForeignKey("cnam", "id_random", "table_correspondance"),
)

# Imaging index: key and the columns in which '' and 'None' stand for null.
IMAGING_KEY = ("study_instance_uid", "appointment_date", "file_guid")
IMAGING_SENTINELS = ("center_name", "dicom_study_id", "file_guid", "study_instance_uid")
IMAGING_SCHEMA = T.StructType(
    [
        T.StructField("person_id", T.StringType()),
        T.StructField("mammogram_date", T.TimestampNTZType()),
        T.StructField("appointment_date", T.TimestampNTZType()),
        T.StructField("study_instance_uid", T.StringType()),
        T.StructField("dicom_study_id", T.StringType()),
        T.StructField("date_study", T.StringType()),
        T.StructField("file_guid", T.StringType()),
        T.StructField("id_exam_center", T.StringType()),
        T.StructField("center_name", T.StringType()),
    ]
)

REFUSAL_COLUMNS = ("NIR", "Nom Famille", "Naiss")
IDENTITY_COLUMNS = ("id_random", "NNI_2", "NNI_2_cle", "sexe", "nom", "nom_jf", "prenom", "date_naiss")

# Exam table: cleaned name -> published name, in published order, with sensitivity class.
EVENT_DATE, PROPERTY, PSEUDONYM, TECHNICAL = "event_date", "property", "pseudonym", "technical_id"

PUBLISHED: tuple[tuple[str, str, str], ...] = (
    ("id_random", "id_random", PSEUDONYM),
    ("Date_Mammo", "Date_Mammo", EVENT_DATE),
    ("L1_ACR_SD", "L1_ACR_SD", PROPERTY),
    ("L1_ACR_SG", "L1_ACR_SG", PROPERTY),
    ("L1_Type_Image_SD", "L1_Type_Anomalie_SD", PROPERTY),
    ("L1_Type_Image_SG", "L1_Type_Anomalie_SG", PROPERTY),
    ("comparaison_SD_plus_suspecte", "L1_comparaison_SD_plus_suspecte", PROPERTY),
    ("comparaison_SG_plus_suspecte", "L1_comparaison_SG_plus_suspecte", PROPERTY),
    ("Examen_Clinique_Sein_Normal", "L1_Examen_Clinique_Sein_Normal", PROPERTY),
    ("Examen_Clinique_Sein_Anormal", "L1_Examen_Clinique_Sein_Anormal", PROPERTY),
    ("Examen_Clinique_Sein_Refus", "L1_Examen_Clinique_Sein_Refus", PROPERTY),
    ("BDI", "BDI", PROPERTY),
    ("BDI_Agrandissement", "BDI_Agrandissement", PROPERTY),
    ("BDI_Cytoponction", "BDI_Cytoponction", PROPERTY),
    ("BDI_Echographie", "BDI_Echographie", PROPERTY),
    ("BDI_ACR_SD", "BDI_ACR_SD", PROPERTY),
    ("BDI_ACR_SG", "BDI_ACR_SG", PROPERTY),
    ("BDI_Type_Image_SD", "BDI_Type_Anomalie_SD", PROPERTY),
    ("BDI_Type_Image_SG", "BDI_Type_Anomalie_SG", PROPERTY),
    ("Echo_L1_Negative", "L1_Echo_Negative", PROPERTY),
    ("Echo_L1_Suspecte", "L1_Echo_Suspecte", PROPERTY),
    ("L1_Conduite_a_tenir_Surveillance", "L1_Conduite_a_tenir_Surveillance", PROPERTY),
    ("L1_Conduite_a_tenir_Cytoponction", "L1_Conduite_a_tenir_Cytoponction", PROPERTY),
    ("L1_Conduite_a_tenir_Microbiopsie", "L1_Conduite_a_tenir_Microbiopsie", PROPERTY),
    ("L1_Conduite_a_tenir_Macrobiopsie", "L1_Conduite_a_tenir_Macrobiopsie", PROPERTY),
    ("L1_Conduite_a_tenir_Autre", "L1_Conduite_a_tenir_Autre", PROPERTY),
    ("L2_Type_Image_SD", "L2_Type_Anomalie_SD", PROPERTY),
    ("L2_Type_Image_SG", "L2_Type_Anomalie_SG", PROPERTY),
    ("L2_Conduite_a_tenir_Surveillance", "L2_Conduite_a_tenir_Surveillance", PROPERTY),
    ("L2_Conduite_a_tenir_Cytoponction", "L2_Conduite_a_tenir_Cytoponction", PROPERTY),
    ("L2_Conduite_a_tenir_Microbiopsie", "L2_Conduite_a_tenir_Microbiopsie", PROPERTY),
    ("L2_Conduite_a_tenir_Macrobiopsie", "L2_Conduite_a_tenir_Macrobiopsie", PROPERTY),
    ("L2_Conduite_a_tenir_Autre", "L2_Conduite_a_tenir_Autre", PROPERTY),
    ("L2_ACR_SD", "L2_ACR_SD", PROPERTY),
    ("L2_ACR_SG", "L2_ACR_SG", PROPERTY),
    ("resultat_global_L1L2", "L1L2_positif", PROPERTY),
    ("pT", "Anapath_TNM_T", PROPERTY),
    ("pN", "Anapath_TNM_N", PROPERTY),
    ("M", "Anapath_TNM_M", PROPERTY),
    ("Taille_en_mm", "Anapath_taille_en_mm", PROPERTY),
    ("localisation", "Anapath_localisation", PROPERTY),
    ("code_adicap", "Anapath_code_adicap", PROPERTY),
    ("adicap", "Anapath_adicap", PROPERTY),
    ("code_adicap2", "Anapath_code_adicap2", PROPERTY),
    ("adicap2", "Anapath_adicap2", PROPERTY),
    ("Grade_SBR", "Anapath_Grade_SBR", PROPERTY),
    ("RH_Progesterone", "Anapath_RH_Progesterone", PROPERTY),
    ("RH_Oestreogene", "Anapath_RH_Oestrogene", PROPERTY),
    ("HER2", "Anapath_HER2", PROPERTY),
    ("Si_Malin", "Anapath_Type_Si_Malin", PROPERTY),
    ("Si_Benin", "Anapath_Type_Si_Benin", PROPERTY),
    ("Date_Anapath", "Anapath_Date", EVENT_DATE),
    ("Date_Inter_Chir", "Trait_Date_Inter_Chir", EVENT_DATE),
    ("Trait_Radi", "Trait_Radiotherapie", PROPERTY),
    ("Date_Radi", "Trait_Date_Radiotherapie", EVENT_DATE),
    ("Trait_Horm", "Trait_Hormonotherapie", PROPERTY),
    ("Date_Horm", "Trait_Date_Hormonotherapie", EVENT_DATE),
    ("Trait_Chim", "Trait_Chimiotherapie", PROPERTY),
    ("Date_Chim", "Trait_Date_Chimiotherapie", EVENT_DATE),
    ("KS_confirme", "Anapath_Cancer_Confirme", PROPERTY),
    ("THS", "ATCD_THS", PROPERTY),
    ("ATCD_Cancer", "ATCD_Cancer", PROPERTY),
    ("Age_ATCD_Cancer", "ATCD_Age_Cancer", PROPERTY),
    ("ATCD_Cancer_Bilateral", "ATCD_Cancer_Bilateral", PROPERTY),
    ("Age_ATCD_Cancer_Bilateral", "ATCD_Age_Cancer_Bilateral", PROPERTY),
    ("ATCD_Chir_Esth", "ATCD_Chir_Esth", PROPERTY),
    ("Age_ATCD_Chir_Esth", "ATCD_Age_Chir_Esth", PROPERTY),
    ("ATCD_Famil_Mere", "ATCD_Cancer_Mere", PROPERTY),
    ("Age_ATCD_Famil_Mere", "ATCD_Age_Cancer_Mere", PROPERTY),
    ("ATCD_Famil_Soeur", "ATCD_Cancer_Soeur", PROPERTY),
    ("Age_ATCD_Famil_Soeur", "ATCD_Age_Cancer_Soeur", PROPERTY),
    ("ATCD_Famil_Fille", "ATCD_Cancer_Fille", PROPERTY),
    ("Age_ATCD_Famil_Fille", "ATCD_Age_Cancer_Fille", PROPERTY),
    ("ATCD_Famil_Autre", "ATCD_Cancer_Autre", PROPERTY),
    ("Age_ATCD_Famil_Autre", "ATCD_Age_Cancer_Autre", PROPERTY),
)
# End of fixed values.

SIDES = {"SD": "right breast", "SG": "left breast"}
STAGES = {"L1": "first reading", "L2": "second reading", "BDI": "immediate assessment",
          "ATCD": "declared history", "Anapath": "pathology", "Trait": "treatment"}


def describe(column: str) -> str:
    """Readable description put together from the parts of a published name."""
    parts = column.split("_")
    stage = STAGES.get(parts[0])
    side = SIDES.get(parts[-1])
    middle = parts[1:] if stage else parts
    middle = middle[:-1] if side else middle
    text = " ".join(middle) or column
    return ", ".join(x for x in (text, stage, side) if x)


def sensitivity() -> dict[str, str]:
    return {published: kind for _, published, kind in PUBLISHED}
