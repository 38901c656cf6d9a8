import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortloom import spec
from cohortloom.operators import cohort, keys
from cohortloom.plans.catalog import Cohort
from cohortloom.sources import extracts

BLANK_SCREENING = {c: " " for c in spec.SCREENING.columns}


def write_csv(path, columns, records):
    lines = [";".join(columns)] + [";".join(str(r.get(c, "")) for c in columns) for r in records]
    path.write_bytes(("\n".join(lines) + "\n").encode("latin-1"))


@pytest.fixture(scope="module")
def study(spark, tmp_path_factory):
    """Small study in files: four people, one refusing, one exam twice in the file."""
    root = tmp_path_factory.mktemp("study")
    bundle = root / "bundle"
    bundle.mkdir()
    people = [
        {"num_ref": i, "id_assure": i, "id_bci": i, "NNI_2": f"2{i:012d}", "NNI_2_cle": "11", "sexe": 2, "nom": f"Né{i}",
         "date_naiss": "1/2/1950", "email": f"p{i}@x.fr", "count(*)": "1 000"}
        for i in (1, 2, 3, 4)
    ]
    people.append({**people[0], "nom": "Last"})  # same key again, later in the file
    write_csv(bundle / "2020 Population.csv", spec.POPULATION.columns, people)
    screening = [
        {**BLANK_SCREENING, "num_ref": 1, "id_assure": 1, "id_bci": p, "Id_event": e, "Date_Mammo": day, "L1_ACR_SD": a,
         "L1_ACR_SG": "2", "ECS": "Refusé", "BDI": "Bilan immédiat nécessaire", "resultat_global_L1L2": "P"}
        for e, p, day, a in ((10, 1, "03/05/2018", 5), (11, 2, "04/05/2018", 1), (12, 3, "05/05/2018", 1), (13, "", "06/05/2018", 1), (11, 2, "04/06/2018", 2))
    ]
    write_csv(bundle / "2020 Dépistages.csv", spec.SCREENING.columns, screening)
    write_csv(bundle / "risque KS.csv", spec.RISK.columns, [{"id_event": 10, "Date_Mammo": "03/05/2018", "Age_Mammo": "68,9", "THS": "Oui"}])
    follow = {"id_event": 10, "k_adicap": "A1", "Taille_en_mm": "12,5", "KS_Confirme": "KS_confirmé", "Date_Anapath": "01/07/2018", "HER2": "+"}
    write_csv(bundle / "Suivi.csv", spec.FOLLOW_UP.columns, [follow])
    write_csv(bundle / "adicap ks.csv", spec.LESION_CODES.columns, [{"code": "A1", "libelle": "lésion"}])
    mapping = root / "mapping-table.csv"
    mapping.write_text("id_bci,id_random\n" + "".join(f"{i},{100 + i}\n" for i in (1, 2, 3, 4)))
    refusals = root / "refusing-list.csv"
    refusals.write_text(f"NIR,Nom Famille,Naiss\n2{2:012d},x,1950\n")
    index = [("1", "2018-05-20", "u1", "f1"), ("1", "2018-05-20", "u1", "f2"), ("3", "2010-01-01", "u3", "f3"), ("None", "2010-01-01", "u4", "f4"), ("2", "2018-05-04", "u2", "f5")]
    (
        spark.createDataFrame(index, "person_id string, d string, study_instance_uid string, file_guid string")
        .select(
            "person_id", F.lit(None).cast("timestamp_ntz").alias("mammogram_date"), F.col("d").cast("timestamp_ntz").alias("appointment_date"),
            "study_instance_uid", F.lit("None").alias("dicom_study_id"), F.lit("x").alias("date_study"), "file_guid",
            F.lit("1").alias("id_exam_center"), F.lit("c").alias("center_name"),
        )
        .write.parquet(str(root / "index"))
    )
    manifest = extracts.mapping_manifest(spark, str(mapping))
    args = (str(bundle), str(mapping), manifest, str(refusals), str(root / "index"))
    return root, args, Cohort.from_folders(spark, *args)


def test_sources_from_files(study):
    c = study[2]
    people = {r.id_bci: r for r in c.population_df().collect()}
    assert people[1].nom == "Last" and people[2].nom == "Né2" and people[1]["count"] == 1000 and people[1].id_random == 101
    assert c.source("population").dup.count() == 2
    exam = {r.id_event: r for r in c.depistage_df().collect()}
    assert str(exam[11].Date_Mammo)[:10] == "2018-06-04"  # the later row
    assert exam[10].Examen_Clinique_Sein_Refus and exam[10].BDI and exam[10].resultat_global_L1L2
    follow = c.suivi_df().first()
    assert follow.Taille_en_mm == 12.5 and follow.KS_confirme and follow.HER2
    assert c.risque_df().first().Age_Mammo == 68
    c.check_source_fks()


def test_exam_table(study):
    c = study[2]
    assert c.star().count() == c.depistage_df().count()
    out = {r.id_random: r for r in c.depistage_pseudo().collect()}
    assert set(out) == {101, 103}  # 102 refuses, the exam without person has no key
    assert rows(c.exam_history(), "id_random", "uids", "file_count") == [(101, ["u1"], 2), (103, ["u3"], 1)]
    assert out[101].DICOM_Study == "u1" and out[101].dicom_files == 2 and out[101].Anapath_adicap == "lésion"
    assert out[103].DICOM_Study is None and out[103].dicom_appointments == 1 and out[103].Anapath_adicap is None
    assert c.table("depistage_pseudo").na.count() == 1
    names = c.depistage_pseudo().columns
    assert not set(names) & {"num_ref", "id_assure", "id_bci", "id_event", "NNI_2", "nom", "prenom", "date_naiss", "email", "person_id"}
    published = [n for _, n, _ in spec.PUBLISHED]
    assert names[: len(published)] == published
    assert cohort.columns_of_class(c.depistage_pseudo(), "pseudonym") == ["id_random"]
    assert "Date_Mammo" not in cohort.hide_classes(c.depistage_pseudo(), "event_date").columns


def test_derived_tables(study):
    c = study[2]
    assert rows(c.cnam(), "id_random") == [(101,), (103,), (104,)]
    assert rows(c.table_correspondance(), "id_random", "id_bci") == [(101, 1), (103, 3), (104, 4)]
    assert rows(c.mail()) == [("p1@x.fr",), ("p3@x.fr",), ("p4@x.fr",)]
    assert rows(c.refusing_random_ids()) == [(102,)]
    assert rows(c.studies(), "id_random", "study_id") == [(101, "u1"), (103, "u3")]
    assert rows(c.studies(near_exam_only=True), "id_random", "study_id") == [(101, "u1")]
    assert cohort.refusal_leaks(c.cnam(), c.refusing_list()).first().leaks == 0
    assert rows(c.dicom_instance_uid()) == [("u1",), ("u2",), ("u3",), ("u4",)]


def test_written_flows(study, spark, tmp_path):
    c = study[2]
    written = c.validated_extraction(str(tmp_path / "v"))
    assert written["depistage_pseudo"].count() == 2 and written["cnam"].count() == 3
    shards = c.export_studies(str(tmp_path / "e"), "2.25", 2)
    assert shards.count() == 2
    exported = spark.read.option("header", True).csv(str(tmp_path / "e" / "studies.csv"))
    assert exported.columns == ["id_random", "date", "study_pseudo_id"] and exported.first().study_pseudo_id.startswith("2.25.")
    c.export_registry(str(tmp_path / "r"), "06/04/2021", "PROJT", "042")
    assert spark.read.text(str(tmp_path / "r" / "safe")).count() == 7


def test_missing_parts(study, spark, tmp_path):
    root, args, _ = study
    with pytest.raises(extracts.MissingExtract):
        extracts.route_file(spark, str(root / "bundle"), "cim")
    with pytest.raises(extracts.ChecksumMismatch):
        Cohort.from_folders(spark, args[0], args[1], "0" * 32, args[3], args[4])
    none = Cohort.from_folders(spark, *args[:3], str(tmp_path / "absent.csv"), args[4])
    assert none.refusing_list().count() == 0 and none.cnam().count() == 4


def test_null_ids_stay_when_refusals_leave(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id_random long")
    gone = spark.createDataFrame([(2,), (None,)], "id_random long")
    assert rows(cohort.without_refusals(df, gone)) == [(1,), (None,)]


def test_star_keeps_rows_and_null_keys_match_nothing(spark):
    screening = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id_event long, id_bci long")
    follow = spark.createDataFrame([(1, "A", None), (9, "B", "A")], "id_event long, k_adicap string, k_adicap2 string")
    risk = spark.createDataFrame([(2, 50)], "id_event long, Age_Mammo int")
    codes = spark.createDataFrame([("A", "a"), (None, "nothing")], "code_adicap string, adicap string")
    people = spark.createDataFrame([(5, "x"), (None, "nobody")], "id_bci long, nom string")
    imaging = spark.createDataFrame([(6, 2)], "person_id long, dicom_files long")
    star = cohort.exam_star(screening, follow, risk, codes, people, imaging)
    assert rows(star, "id_event", "adicap", "adicap2", "Age_Mammo", "nom", "dicom_files") == [
        (1, "a", None, None, "x", None), (2, None, None, 50, None, 2), (3, None, None, None, None, None),
    ]


def test_round_trip_is_complete_without_refusals(spark):
    people = spark.createDataFrame([(i, f"n{i}", 100 + i) for i in range(20)], "id_bci long, NNI_2 string, id_random long")
    base = spark.range(60).select(
        F.col("id").alias("id_event"), (F.col("id") % 20).alias("id_bci"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("Date_Mammo"), (F.col("id") % 5).cast("string").alias("acr"),
    ).join(people, "id_bci")
    compare = cohort.rebuilt_versus_source(
        base.select("NNI_2", "Date_Mammo", "acr", "id_event"), base.select("id_random", "Date_Mammo", "acr", "id_event"),
        people.select("id_random", "id_bci"), people, "acr", ["id_event"],
    )
    row = cohort.round_trip(compare).first()
    assert (row.source_rows, row.rebuilt_rows, row.equal_rows, row.rebuilt_pct, row.equal_pct) == (60, 60, 60, 100.0, 100.0)


def test_fk_between_derived_tables(study):
    study[2].check_fks()
    assert keys.repeated_keys(study[2].depistage_pseudo(), ["id_random", "Date_Mammo"]).isEmpty()


def test_labels_are_looked_up_for_the_follow_up(spark):
    """Exams, which are far wider, are not shuffled by lesion code."""
    screening = spark.createDataFrame([(1, 5)], "id_event long, id_bci long")
    follow = spark.createDataFrame([(1, "A", "B")], "id_event long, k_adicap string, k_adicap2 string")
    risk = spark.createDataFrame([(2, 50)], "id_event long, Age_Mammo int")
    codes = spark.createDataFrame([("A", "a"), ("B", "b")], "code_adicap string, adicap string")
    people = spark.createDataFrame([(5, "x")], "id_bci long, nom string")
    imaging = spark.createDataFrame([(6, 2)], "person_id long, dicom_files long")
    star = cohort.exam_star(screening, follow, risk, codes, people, imaging)
    assert rows(star, "adicap", "adicap2") == [("a", "b")]
    joins = [line for line in star._jdf.queryExecution().analyzed().toString().splitlines() if "Join LeftOuter" in line]
    assert [("k_adicap" in line) for line in joins] == [False, False, False, False, True, True]  # outermost first


def test_sources_are_typed_and_written_once(study, spark, tmp_path):
    c = Cohort.from_folders(spark, *study[1])
    c.stage(str(tmp_path / "s"))
    for name in spec.COHORT_SOURCES:
        assert c.typed(name).inputFiles() and all("/typed_" in f for f in c.typed(name).inputFiles())
    assert c.source("population").dup.count() == 2 and c.source_df("population").count() == 4


def test_raw_views_are_dealt_in_parts(spark, tmp_path, monkeypatch):
    from cohortloom.workload import fixtures

    orders = "/root/testdata/sf0.001/orders.parquet"
    spark.read.parquet(orders).write.parquet(str(tmp_path / "orders.parquet"))
    d = fixtures.Data(spark, str(tmp_path))
    whole = rows(d.r_depistage)
    monkeypatch.setattr(fixtures, "PART_BYTES", 1 << 10)
    parts = d.r_depistage
    made = parts._jdf.queryExecution().optimizedPlan().toString()
    n = -(-fixtures.store.size(spark, str(tmp_path / "orders.parquet")) // (1 << 10))
    assert n > spark.sparkContext.defaultParallelism and f", {n}" in made and rows(parts) == whole


def test_wide_projections_are_split_in_any_session(spark):
    from cohortloom.session import wide_rows

    key, before = "spark.sql.codegen.hugeMethodLimit", spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        spark.conf.set(key, "65535")
        assert wide_rows(spark).conf.get(key) == "8000"
        spark.conf.set(key, "7000")
        assert wide_rows(spark).conf.get(key) == "7000"
    finally:
        spark.conf.set(key, before)


def shuffled_columns(df):
    """Number of columns of every shuffle in the plan of a frame."""
    found, plans = [], [df._jdf.queryExecution().sparkPlan()]
    execution = df.sparkSession._jvm.org.apache.spark.sql.execution
    prepared = execution.QueryExecution.prepareExecutedPlan(df.sparkSession._jsparkSession, plans[0])
    plans = [prepared.inputPlan() if "Adaptive" in prepared.nodeName() else prepared]
    while plans:
        plan = plans.pop()
        if plan.nodeName() == "Exchange":
            found.append(plan.output().size())
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
    return found


def test_wide_exams_are_not_shuffled_by_person_code_or_final_key(study, spark):
    c = Cohort.from_folders(spark, *study[1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = c.depistage_pseudo()
        widths = shuffled_columns(table)
        assert widths and max(widths) <= 12 < len(table.columns)
        got = sorted(str(r) for r in table.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    kept = keys.force_key(c.kept("depistage_pseudo"), spec.COHORT_KEYS["depistage_pseudo"], extracts.ROW_ORDER)
    assert got == sorted(str(r) for r in kept.drop(*extracts.ROW_ORDER).collect())


def test_narrow_and_wide_star_are_the_same(spark):
    screening = spark.createDataFrame([(1, 5, "a"), (2, 6, "b"), (3, None, "c"), (4, 6, None)], "id_event long, id_bci long, wide string")
    follow = spark.createDataFrame([(1, "A", None, "x"), (9, "B", "A", "y"), (4, "B", "A", None)], "id_event long, k_adicap string, k_adicap2 string, size string")
    risk = spark.createDataFrame([(2, 50)], "id_event long, Age_Mammo int")
    codes = spark.createDataFrame([("A", "a"), (None, "nothing")], "code_adicap string, adicap string")
    people = spark.createDataFrame([(5, "x"), (None, "nobody")], "id_bci long, nom string")
    imaging = spark.createDataFrame([(6, 2)], "person_id long, dicom_files long")
    whole = cohort.exam_star(screening, follow, risk, codes, people, imaging)
    narrow = cohort.exam_star(screening, follow, risk, codes, people, imaging, ["id_event", "id_bci"])
    assert rows(narrow, *whole.columns) == rows(whole, *whole.columns) and len(narrow.columns) == len(whole.columns)
    some = cohort.exam_star(screening, follow, risk, codes, people, imaging, ["id_event", "id_bci"], lambda x: x.where("id_event > 3"))
    assert rows(some, "id_event", "code_adicap", "adicap2", "dicom_files") == [(4, None, "a", 2)]
