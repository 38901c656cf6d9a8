"""Cohort-shaped views over the test tables.

One list of expressions per view serves both engines: Spark evaluates it with
`selectExpr`, the comparison SQL gets it as a common table expression.  Nulls, duplicates,
sentinels and orphans come from arithmetic on keys; every view keeps all rows of its table
except where leaving rows out is its meaning (refusal list, code list with gaps).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.sources import store
from cohortloom.spec import FOLLOW_UP, POPULATION, RISK, SCREENING

#: Bytes of a table's files for a part of a raw view; neighbouring rows that are dealt together, as a power of two.
PART_BYTES, RUN_BITS = 16 << 20, 9

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def pick(expr: str, *values: str | None) -> str:
    """One of the values by remainder."""
    cases = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else chr(39) + v + chr(39)}" for i, v in enumerate(values)
    )
    return f"(CASE ({expr}) % {len(values)} {cases} END)"


def french_date(ts: str) -> str:
    return (
        f"lpad(CAST(day({ts}) AS STRING), 2, '0') || '/' || lpad(CAST(month({ts}) AS STRING), 2, '0') || '/' || "
        f"CAST(year({ts}) AS STRING)"
    )


NNI = (
    "CASE WHEN c_custkey % 97 = 0 THEN NULL "
    "WHEN c_custkey % 500 = 2 THEN '2' || lpad(CAST(c_custkey - 2 AS STRING), 12, '0') "
    "WHEN c_custkey % 50 = 1 THEN '2' || lpad(CAST(c_custkey - 1 AS STRING), 12, '0') "
    "ELSE '2' || lpad(CAST(c_custkey AS STRING), 12, '0') END"
)
NNI_KEY = "lpad(CAST(c_custkey % 97 AS STRING), 2, '0')"
BIRTH = (
    "DATE '1940-01-01' + CAST((c_custkey * 37 + CASE WHEN c_custkey % 100 = 51 THEN 700 ELSE 0 END) % 9000 AS INT)"
)
EMAIL = (
    "CASE WHEN c_custkey % 10 = 3 THEN NULL WHEN c_custkey % 10 = 7 THEN 'bad address' "
    "WHEN c_custkey % 10 = 8 THEN 'shared' || CAST(c_custkey % 30 AS STRING) || '@mail.example.org' "
    "ELSE lower(replace(c_name, '#', '.')) || '@mail.example.org' END"
)
ORDER_DAY = "CAST(o_orderdate AS DATE)"
PERSON_OF_EXAM = "CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_custkey END"
APPOINTMENT = "DATE '1995-01-01' + CAST((event_id % 12) * 200 AS INT)"

VIEWS: dict[str, tuple[str, dict[str, str], str | None]] = {
    "v_population": (
        "customer",
        {
            "id_bci": "c_custkey",
            "nni_2": NNI,
            "nni_2_cle": NNI_KEY,
            "sexe": "'2'",
            "nom": "c_name",
            "date_naiss": BIRTH,
            "email": EMAIL,
            "segment": "c_mktsegment",
        },
        None,
    ),
    "v_mapping": ("customer", {"id_bci": "c_custkey", "id_random": "c_custkey * 7 + 1000000"}, None),
    "v_refusals": ("customer", {"nir": "'2' || lpad(CAST(c_custkey AS STRING), 12, '0')"}, "c_acctbal < -700"),
    "v_depistage": (
        "orders",
        {
            "id_event": "o_orderkey",
            "id_bci": PERSON_OF_EXAM,
            "date_mammo": ORDER_DAY,
            "l1_acr_sd": "CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'x' "
            "ELSE CAST(o_orderkey % 6 AS STRING) END",
            "l1_acr_sg": "CAST(o_orderkey % 5 AS STRING)",
            "l2_acr_sd": "CAST((o_orderkey * 7) % 6 AS STRING)",
            "l2_acr_sg": "CAST((o_orderkey * 3) % 5 AS STRING)",
            "ecs": "CASE o_orderstatus WHEN 'F' THEN 'Normal' WHEN 'O' THEN 'Anormal' ELSE 'Refusé' END",
            "resultat_global": "CASE WHEN o_orderkey % 17 = 0 THEN ' ' WHEN o_orderkey % 19 = 0 THEN NULL "
            "WHEN o_orderkey % 23 = 0 THEN '?' WHEN o_orderkey % 3 = 0 THEN 'P' "
            "WHEN o_orderkey % 3 = 1 THEN 'Non' ELSE '-' END",
            "age_raw": "CASE WHEN o_orderkey % 29 = 0 THEN ' ' WHEN o_orderkey % 31 = 0 THEN '0.5' "
            "ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 140 AS STRING) || '.7' END",
            "date_text": french_date("o_orderdate"),
        },
        None,
    ),
    "v_suivi": (
        "lineitem",
        {
            "id_event": "CASE WHEN l_partkey % 211 = 0 THEN NULL ELSE l_orderkey END",
            "date_anapath": "CAST(l_shipdate AS DATE)",
            "k_adicap": "'C' || CAST(l_partkey AS STRING)",
            "k_adicap2": "CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE 'C' || CAST(l_suppkey AS STRING) END",
            "trait_radi": "l_returnflag",
            "her2": "l_linestatus",
            "taille_en_mm": "l_quantity",
            "ligne": "l_linenumber",
            "montant": "l_extendedprice",
            "remise": "l_discount",
            "taxe": "l_tax",
        },
        None,
    ),
    "v_adicap": (
        "part",
        {"code_adicap": "'C' || CAST(p_partkey AS STRING)", "adicap": "p_name"},
        "p_size <> 7",
    ),
    "v_dicom_guid": (
        "events",
        {
            "ord": "event_id",
            "person_id": "CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 83 = 0 THEN 9000000 + event_id % 7 "
            "ELSE user_id END",
            "person_text": "CASE WHEN event_id % 89 = 0 THEN 'None' WHEN event_id % 83 = 0 THEN '' "
            "ELSE CAST(user_id AS STRING) END",
            "appointment_date": APPOINTMENT,
            "mammogram_date": "CASE WHEN event_id % 19 = 0 THEN NULL ELSE DATE '1995-01-01' + "
            "CAST((event_id % 12) * 200 + (event_id * 13) % 9000 - 4500 AS INT) END",
            "study_instance_uid": "CASE WHEN event_id % 71 = 0 THEN 'None' ELSE '1.2.826.' || "
            "CAST(user_id AS STRING) || '.' || CAST((event_id % 12) * 200 AS STRING) || '.' || "
            "CAST(event_id % 2 AS STRING) END",
            "dicom_study_id": "CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 5 = 0 THEN 'None' "
            "ELSE 's' || CAST(event_id % 997 AS STRING) END",
            "file_guid": "CASE WHEN event_id % 53 = 0 THEN '' WHEN event_id % 3 = 0 THEN 'short' "
            "ELSE 'file-guid-' || CAST(event_id % 5 AS STRING) END",
            "center_name": "CASE WHEN event_id % 37 = 0 THEN 'None' ELSE 'centre-' || CAST(user_id % 7 AS STRING) END",
        },
        None,
    ),
    "v_image_meta": (
        "lineitem",
        {
            "study_key": "l_orderkey",
            "study_uid": "'1.2.840.' || CAST(l_orderkey AS STRING)",
            "sop_uid": "'1.2.840.' || CAST(l_orderkey AS STRING) || '.' || CAST(l_partkey AS STRING) || '.' || "
            "CAST(l_suppkey AS STRING) || '.' || CAST(l_linenumber AS STRING)",
            "patient_id": "'P' || CAST(l_suppkey AS STRING)",
            "view_code": "CASE WHEN l_partkey % 23 = 0 THEN NULL WHEN l_partkey % 2 = 0 THEN 'R-10226' "
            "WHEN l_partkey % 9 = 1 THEN 'R-10224' ELSE 'R-10242' END",
            "view_meaning": "CASE WHEN l_partkey % 2 = 0 THEN 'medio-lateral oblique' ELSE 'cranio-caudal' END",
            "view_scheme": "'SNM3'",
            "view_position": "CASE WHEN l_partkey % 23 = 0 THEN NULL WHEN l_partkey % 2 = 0 THEN 'MLO' "
            "WHEN l_partkey % 9 = 1 THEN 'ML' ELSE 'cc' END",
            "laterality": "CASE WHEN l_suppkey % 2 = 0 THEN 'R' ELSE 'l' END",
            "modality": "CASE WHEN l_suppkey % 31 = 0 THEN 'US' ELSE 'MG' END",
            "annotation": "CASE WHEN l_orderkey % 2 = 0 THEN 'None' ELSE NULL END",
            "operator_name": "CASE WHEN l_orderkey % 3 = 0 THEN 'None' WHEN l_orderkey % 7 = 0 THEN NULL "
            "ELSE 'op' || CAST(l_suppkey % 12 AS STRING) END",
            "RelativeXRayExposure_0x00181405": "CAST(l_tax * 100 AS DECIMAL(12, 2))",
        },
        None,
    ),
    # source database
    "v_assure": (
        "customer",
        {
            "num_ref": "c_custkey + 500000",
            "id_assure": "c_custkey + 1000000",
            "id_bci": "c_custkey",
            "NNI_2": NNI,
            "NNI_2_cle": NNI_KEY,
            "sexe": "'2'",
            "nom": "c_name",
            "nom_jf": "c_mktsegment",
            "prenom": "'p' || CAST(c_nationkey AS STRING)",
            "date_naiss": BIRTH,
            "email": EMAIL,
        },
        None,
    ),
    "v_ks": (
        "orders",
        {
            "id_assure": "o_custkey + 1000000",
            "id_event": "o_orderkey",
            "date_mammo": ORDER_DAY,
            "menop_trai": pick("o_orderkey", "O", "N", None),
            "maladie_an_d": pick("o_orderkey", "k", "K", "E", None, " "),
            "maladie_an_g": pick("o_orderkey + o_custkey", "K", "E", None, " "),
            "operation_date": "CAST(o_orderdate AS DATE) - CAST(o_orderkey % 4000 AS INT)",
            **{f"ant_age_{r}": pick(f"o_orderkey + {i}", "O", "N", None) for i, r in enumerate(("mere", "soeur", "fille", "autre"))},
            **{f"age_{r}": f"CAST(30 + (o_orderkey * {i + 2}) % 60 AS BIGINT)" for i, r in enumerate(("mere", "soeur", "fille", "autre"))},
            "comp_re_1d": pick("o_orderkey", "S", "A", None),
            "comp_re_1g": pick("o_orderkey + 1", "S", "A", None, " "),
            "exam_clini": pick("o_orderkey", "A", "N", "R", " ", None),
            "acr_sd11": text("o_orderkey % 6"),
            "acr_sg11": text("o_orderkey % 5"),
            "acr_sd1": text("(o_orderkey + 1) % 6"),
            "acr_sg1": text("(o_orderkey + 1) % 5"),
            "acr_sd2": text("(o_orderkey * 7) % 6"),
            "acr_sg2": text("(o_orderkey * 3) % 5"),
            **{
                c: pick(f"o_orderkey + {i}", "A", "B", "C", "D", "E", "F", "G", "H", None)
                for i, c in enumerate(("suspec11_d", "suspec11_g", "suspec1_sd", "suspec1_sg", "suspec2_sd", "suspec2_sg"))
            },
            **{
                c: pick(f"o_orderkey + {i}", "O", "N", None)
                for i, c in enumerate(("echo_l1", "echo_l1_suspecte", "bilan_l1", "bi_agrand", "bi_cyto", "bi_echo"))
            },
            **{
                c: pick(f"o_orderkey * 3 + {i}", "S03", "S24", "PCY", "PMI", "PMA", "AUT", "IRM", "PRP", "XXX", None, "S01")
                for i, c in enumerate(("exam_cons1", "exam_cons_echo_l1", "exam_cons2"))
            },
            "resultat": pick("o_orderkey", "P", "N", " "),
            "malin_t": pick("o_orderkey", "T0", "T1", "T2", None),
            "malin_n": pick("o_orderkey", "N0", "N1", None),
            "malin_m": pick("o_orderkey", "1", "2", "3", "4", None),
            "taille_mm": "CAST(o_orderkey % 80 AS BIGINT)",
            "s_lesloc": pick("o_orderkey", "501", "502", "503", "504", "505", "506", "507", "508", "509", None),
            "k_adicap": "'C' || CAST(o_orderkey % 2000 AS STRING)",
            "k_adicap2": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'C' || CAST(o_orderkey % 100 AS STRING) END",
            "grade": pick("o_orderkey", "I", "II", "III", None),
            "k_proges": pick("o_orderkey", "O", "N", None),
            "k_oestro": pick("o_orderkey + 1", "O", "O", "N", None),
            "rh": pick("o_orderkey", "+", "-", " ", None),
            "her2": pick("o_orderkey", "+", "-", None),
            "malin_type": pick("o_orderkey", "1", "2", "3", "6", "7", None),
            "benin_type": pick("o_orderkey", "1", "2", "3", "4", "5", "6", "7", "8", "9", None),
            "situation_finale": pick("o_orderkey", "K", "k", "N", None),
            **{
                c: f"CASE WHEN o_orderkey % {i + 3} = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + {10 * (i + 1)} END"
                for i, c in enumerate(("date_bilan", "date_inter", "date_radi", "date_horm", "date_chim"))
            },
            "trait_radi": pick("o_orderkey", "O", "N", None),
            "trait_horm": pick("o_orderkey + 1", "O", "N", None),
            "trait_chim": pick("o_orderkey + 2", "O", "N", None),
        },
        None,
    ),
    "v_dico": (
        "part",
        {
            "dico": "CASE WHEN p_size < 25 THEN 'adks' ELSE 'other' END",
            "code": "'C' || CAST(p_partkey AS STRING)",
            "libelle": "p_name",
        },
        None,
    ),
    "v_centre": (
        "supplier",
        {
            "id_centre": "s_suppkey",
            "num_centre": "s_suppkey + 100",
            "esis_id_centre": "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_suppkey + 700 END",
            "esis_date": "CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE DATE '2010-01-01' + CAST(s_suppkey % 900 AS INT) END",
            "nom": "s_name",
        },
        None,
    ),
    "v_rdv": (
        "orders",
        {
            "id_data": "o_orderkey",
            "id_assure": "o_custkey",
            "id_lecture1": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey * 2 END",
            "date_heure": ORDER_DAY,
            "id_exam_center": "o_custkey % 90",
        },
        None,
    ),
    "v_rdv_person": (
        "customer",
        {"id_data": "c_custkey", "num_bci": "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_custkey END"},
        None,
    ),
    "v_rdv_reading": ("orders", {"id_data": "o_orderkey * 2", "date_mammo": ORDER_DAY}, None),
    "v_rdv_study": (
        "lineitem",
        {
            "id_data": "l_orderkey * 1000 + l_linenumber",
            "id_rdv": "l_orderkey",
            "study_instance_uid": "'1.2.' || CAST(l_orderkey AS STRING) || '.' || CAST(l_partkey AS STRING)",
            "dicom_study_id": "'d' || CAST(l_suppkey AS STRING)",
            "date_study": "CAST(l_shipdate AS DATE)",
        },
        None,
    ),
    "v_rdv_document": (
        "orders",
        {"id_study": "o_orderkey * 1000 + o_orderkey % 7 + 1", "file_guid": "'guid-' || CAST(o_orderkey AS STRING)"},
        None,
    ),
    "v_rdv_centre": (
        "supplier",
        {
            "id_data": "s_suppkey",
            "postcode": pick("s_suppkey", "48000", "30100", "34000", "04830", None),
            "name": "s_name",
        },
        None,
    ),
}

# Raw extracts: every column text, as in the CSV files, with the row position.
YES_NO_PICK = ("Oui", "Non", " ", None, "O", "N", "+", "-", "9")
RAW_DATE = french_date("o_orderdate")


def raw_population() -> dict[str, str]:
    day = "lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0')"
    month = "lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0')"
    year = "CAST(1940 + c_custkey % 25 AS STRING)"
    values = {
        "num_ref": text("c_custkey + 500000"),
        "id_assure": text("c_custkey + 1000000"),
        "id_bci": text("c_custkey"),
        "NNI_2": NNI,
        "NNI_2_cle": NNI_KEY,
        "sexe": "'2'",
        "nom": "c_name",
        "nom_jf": "c_mktsegment",
        "prenom": "'p' || CAST(c_nationkey AS STRING)",
        "date_naiss": f"{day} || '/' || {month} || '/' || {year}",
        "email": EMAIL,
        "count(*)": text("1 + c_custkey % 9"),
    }
    return {c: values[c] for c in POPULATION.columns}


def raw_screening() -> dict[str, str]:
    one_hot_values = {source: tuple(names) for source, names in SCREENING.one_hot.items()}
    types = ("Microcalcifications", "Autres anomalie", " ", None)
    out = {}
    for i, c in enumerate(SCREENING.columns):
        if c in ("num_ref", "id_assure"):
            out[c] = text(f"o_custkey + {500000 if c == 'num_ref' else 1000000}")
        elif c == "id_bci":
            out[c] = text(f"{PERSON_OF_EXAM}")
        elif c == "Id_event":
            out[c] = text("o_orderkey")
        elif c == "Date_Mammo":
            out[c] = RAW_DATE
        elif c in one_hot_values:
            out[c] = pick(f"o_orderkey + {i}", *one_hot_values[c], " ")
        elif "ACR" in c:
            out[c] = f"CASE WHEN (o_orderkey + {i}) % 11 = 0 THEN NULL ELSE CAST((o_orderkey + {i}) % 6 AS STRING) END"
        elif "Type_Image" in c:
            out[c] = pick(f"o_orderkey + {i}", *types)
        else:
            out[c] = pick("o_orderkey", *YES_NO_PICK)
    return out


def raw_risk() -> dict[str, str]:
    out = {}
    for i, c in enumerate(RISK.columns):
        if c in ("num_ref", "id_assure", "id_bci"):
            out[c] = text("o_custkey")
        elif c == "id_event":
            out[c] = text("CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_orderkey - o_orderkey % 2 END")
        elif c == "Date_Mammo":
            out[c] = RAW_DATE
        elif c in RISK.ages:
            out[c] = (
                f"CASE WHEN (o_orderkey + {i}) % 7 = 0 THEN NULL WHEN (o_orderkey + {i}) % 9 = 0 THEN ' ' "
                f"ELSE CAST((o_orderkey * {i}) % 130 AS STRING) || ',5' END"
            )
        else:
            out[c] = pick(f"o_orderkey + {i}", *YES_NO_PICK)
    return out


def raw_follow_up() -> dict[str, str]:
    out = {}
    for i, c in enumerate(FOLLOW_UP.columns):
        if c in ("num_ref", "id_assure", "id_bci"):
            out[c] = text("l_suppkey")
        elif c == "id_event":
            out[c] = text("CASE WHEN l_partkey % 211 = 0 THEN NULL ELSE l_orderkey END")
        elif c.startswith("Date_"):
            out[c] = f"CASE WHEN (l_partkey + {i}) % 5 = 0 THEN NULL ELSE {french_date('l_shipdate')} END"
        elif c in ("k_adicap", "k_adicap2"):
            key = "l_partkey" if c == "k_adicap" else "l_suppkey"
            out[c] = f"CASE WHEN {key} % 4 = 1 THEN NULL ELSE 'C' || CAST({key} AS STRING) END"
        elif c == "Taille_en_mm":
            out[c] = "CAST(l_partkey % 80 AS STRING) || ',5'"
        elif c in FOLLOW_UP.flags:
            out[c] = pick(f"l_partkey + {i}", *YES_NO_PICK)
        elif c in FOLLOW_UP.blanks:
            out[c] = pick(f"l_partkey + {i}", "Invasif", " ", None, "Paget")
        elif c == "KS_Confirme":
            out[c] = pick("l_partkey", "KS_confirmé", " ")
        else:
            out[c] = pick(f"l_partkey + {i}", "a", "b", None)
    return out


#: The date of a table that several columns of its raw view show.
DAYS = {"lineitem": french_date("l_shipdate"), "orders": RAW_DATE}

RAW_POSITIONS = {
    "customer": {"_file": "'f'", "_block": "0", "_line": "c_custkey"},
    "orders": {"_file": "'f'", "_block": "0", "_line": "o_orderkey"},
    "part": {"_file": "'f'", "_block": "0", "_line": "p_partkey"},
    "lineitem": {
        "_file": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
        "_block": "l_partkey * 1000000 + l_suppkey",
        "_line": "l_linenumber",
    },
}
for _name, _table, _columns in (
    ("r_population", "customer", raw_population()),
    ("r_depistage", "orders", raw_screening()),
    ("r_risque", "orders", raw_risk()),
    ("r_suivi", "lineitem", raw_follow_up()),
    ("r_adicap", "part", {"code": "'C' || CAST(p_partkey AS STRING)", "libelle": "p_name"}),
):
    VIEWS[_name] = (_table, {**_columns, **RAW_POSITIONS[_table]}, None)


@dataclass
class Data:
    """Frames of one data folder, by view or table name."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.view(name)
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)

    def view(self, name: str) -> DataFrame:
        table, columns, condition = VIEWS[name]
        df = self.table(table)
        if name.startswith("r_"):  # text of every column is made per row
            df = self.dealt(df, table)
        if condition:
            df = df.filter(condition)
        day = DAYS.get(table)
        if day and name.startswith("r_"):  # made once for all columns that show it
            df = df.withColumn("_day", F.expr(day))
            columns = {n: e.replace(day, "_day") for n, e in columns.items()}
        return df.selectExpr(*[f"{e} AS `{n}`" for n, e in columns.items()])

    def dealt(self, df: DataFrame, table: str) -> DataFrame:
        """The rows in parts of about PART_BYTES of the table's files, one for each core at least.

        A raw row is many times as wide as what it is made of, so a part sorts in memory.  Runs of
        neighbouring rows stay together, as in a file: rows of one key that follow each other meet in a task.
        """
        parts = max(self.spark.sparkContext.defaultParallelism, -(-store.size(self.spark, f"{self.folder}/{table}.parquet") // PART_BYTES))
        return df.withColumn("_run", F.shiftright(F.monotonically_increasing_id(), RUN_BITS)).repartition(parts, "_run").drop("_run")

    @cached_property
    def imaging(self) -> DataFrame:
        """Imaging index, cleaned and with its key forced."""
        from cohortloom.operators.keys import force_key
        from cohortloom.sources.imaging import clean_index
        from cohortloom.spec import IMAGING_KEY

        return force_key(clean_index(self.view("v_dicom_guid")), IMAGING_KEY, ["ord"])


def view_sql(name: str) -> str:
    table, columns, condition = VIEWS[name]
    body = ", ".join(f'{e} AS "{n}"' for n, e in columns.items())
    return f"SELECT {body} FROM {table}" + (f" WHERE {condition}" if condition else "")


def with_views(body: str, extra: str = "") -> str:
    """Put the views a statement mentions in front of it; `extra` are further CTEs."""
    names = [n for n in VIEWS if re.search(rf"\b{n}\b", body + extra)]
    ctes = [f"{n} AS ({view_sql(n)})" for n in names]
    if extra:
        ctes.append(extra)
    return ("WITH " + ", ".join(ctes) + " " if ctes else "") + body
