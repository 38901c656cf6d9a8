import base64
import datetime as dt
import json
import re
from collections import Counter

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions.uids import pseudo_uid
from cohortloom.operators import images, profile, reports
from cohortloom.session import durable, staging
from cohortloom.sources import extracts, imaging, inventory, ledger, pages, patches, registry, sinks, store, versions
from cohortloom.streaming import arrivals


# --- registry file ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def people(spark):
    return registry.registry_projection(
        registry.dummy_identities(spark.range(25), "id", "2021-04-06")
    )


def test_registry_file(spark, people, tmp_path):
    path = str(tmp_path / "safe")
    registry.write_registry_file(people, path, "06/04/2021", "PROJT", "042")
    parts = sorted((tmp_path / "safe").glob("part-*"))
    lines = "".join(p.read_text() for p in parts).splitlines()
    assert len(lines) == 29
    assert lines[0].startswith("00000RG") and lines[0][len(registry.HEADER_START) :].startswith("2021096042   0") and lines[1] == "10001H0000001"
    assert all(len(line) == 69 and line.startswith("11099") for line in lines[2:-2])
    assert lines[-2] == "99001NT_LOT    1000100000025" and lines[-1].endswith("   0000000029000000000000KMLEI       ")
    first = lines[2]
    assert first[5:18] == first[27:40] and first[18:27] == "196607042" and first[40:49] == "    PROJT" and first[49:].strip() == "0"
    back = registry.read_registry_file(spark, path)
    want = people.select(F.col("Identifiant_temporaire").cast("bigint").alias("id"), "NIR_du_beneficiaire")
    assert rows(back, "id_random", "NNI_2") == rows(want)


def test_identity_checks(spark, people):
    assert set(registry.identity_checks(people).first()) == {0}
    bad = spark.createDataFrame(
        [("1" * 12, "1/2/2020", "3", "1" * 13, "x" * 21), ("1" * 13, None, "1", "1" * 13, "a"), ("1" * 13, "01/02/1990", "2", "1" * 13, "a")],
        list(registry.REGISTRY_COLUMNS),
    )
    row = registry.identity_checks(bad).first().asDict()
    assert row == {
        "rows_with_null": 1, "bad_nir": 1, "bad_holder_nir": 0, "bad_date": 2, "bad_sex": 1, "bad_id": 1, "repeated_ids": 1,
    }


def test_identity_description_compares_dates(spark):
    data = [("a", "2", "31/01/1950"), ("b", "1", "01/12/1949"), ("b", "2", "02/01/1960")]
    df = spark.createDataFrame(data, "Identifiant_temporaire string, Code_sexe string, Date_de_naissance string")
    assert tuple(reports.identity_description(df).first()) == (2, 2, 1, "01/12/1949", "02/01/1960")


# --- pages and chunks ---------------------------------------------------------------------


def page(total, begin, size, rows_):
    fields = {"id": {"type": "primary_key"}, "day": {"type": "date"}, "name": {"type": False}}
    return {"total_rows": total, "begin": begin, "range": size, "metadata": {"fields": fields}, "rowdata": rows_}


def test_pages(spark, tmp_path):
    data = [{"id": i, "day": "0000-00-00" if i == 2 else "2020-01-0%d" % (i + 1), "name": f"n{i}"} for i in range(5)]
    for begin in (0, 2, 4):
        (tmp_path / f"p{begin}.json").write_text(json.dumps(page(5, begin, 2, data[begin : begin + 2]), indent=1))
    df = pages.read_pages_json(spark, str(tmp_path))
    assert df.schema["id"].dataType == T.LongType() and df.schema["day"].dataType == T.DateType()
    assert [(r.id, r.name) for r in df.orderBy("id").collect()] == [(i, f"n{i}") for i in range(5)]
    assert df.filter("day IS NULL").count() == 1
    (tmp_path / "p2.json").write_text(json.dumps(page(5, 3, 2, data[2:4])))
    with pytest.raises(pages.BrokenPages):
        pages.read_pages_json(spark, str(tmp_path))
    (tmp_path / "p2.json").unlink()
    with pytest.raises(pages.BrokenPages):
        pages.read_pages_json(spark, str(tmp_path))


def test_chunks(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    for i, text in enumerate(("id;name\n1;é\n2;b\n", "id;name\n3;c\n")):
        content = base64.b64encode(text.encode()).decode()
        (tmp_path / f"c{i}.json").write_text(json.dumps({"total_chunks": 2, "chunk_index": i, "content": content}))
    assert rows(pages.read_chunks_csv(spark, str(tmp_path), schema)) == [(1, "é"), (2, "b"), (3, "c")]
    quoted = base64.b64encode('id;name\n3;"c\nd"\n4;e\n'.encode()).decode()
    (tmp_path / "c1.json").write_text(json.dumps({"total_chunks": 2, "chunk_index": 1, "content": quoted}))
    assert rows(pages.read_chunks_csv(spark, str(tmp_path), schema)) == [(1, "é"), (2, "b"), (3, "c\nd"), (4, "e")]
    (tmp_path / "c2.json").write_text(json.dumps({"total_chunks": 2, "chunk_index": 1, "content": quoted}))
    with pytest.raises(pages.BrokenPages):  # a chunk twice
        pages.read_chunks_csv(spark, str(tmp_path), schema)
    (tmp_path / "c1.json").unlink()
    (tmp_path / "c2.json").unlink()
    with pytest.raises(pages.BrokenPages):
        pages.read_chunks_csv(spark, str(tmp_path), schema)


# --- other sources and sinks --------------------------------------------------------------


def test_latin1_positions(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_bytes("code;libelle\nA;première\nB;deuxième\n".encode("latin-1"))
    from cohortloom.spec import LESION_CODES

    df = extracts.read_csv_text(spark, str(path), LESION_CODES.raw_schema())
    got = [r.libelle for r in df.orderBy(*extracts.ROW_ORDER).collect()]
    assert got == ["première", "deuxième"]


def test_metadata_union(spark, tmp_path):
    spark.createDataFrame([("a", "1")], "sop string, x string").write.parquet(str(tmp_path / "d" / "one"))
    spark.createDataFrame([("b", "2")], "sop string, y string").write.parquet(str(tmp_path / "d" / "e" / "two"))
    df = imaging.read_all_metadata(spark, str(tmp_path / "d"))
    assert rows(df, "sop", "x", "y") == [("a", "1", None), ("b", None, "2")]


def test_logs_inventory_progress(spark, tmp_path):
    (tmp_path / "log").write_text("[2020 10:00] Not OK: 1.2.3 | Nb\nshort line\n")
    assert rows(imaging.study_ids_from_log(spark, str(tmp_path / "log")))[0] == ("1.2.3",)
    deep = tmp_path / "png" / "a" / "b"
    deep.mkdir(parents=True)
    (deep / "x.png").write_bytes(b"0" * 10)
    (tmp_path / "png" / "y.png").write_bytes(b"0" * 21)
    (deep / "note.txt").write_bytes(b"0" * 1000)
    row = inventory.file_inventory(spark, str(tmp_path / "png"), ".png").first()
    assert (row.files, row.mean_bytes) == (2, 15.5) and row.total_mb == pytest.approx(31 / 1048576)
    progress = tmp_path / "progress"
    progress.mkdir()
    for w in (0, 11):
        (progress / f"worker{w}_progress.json").write_text(json.dumps({"uploaded": 3 + w, "total": 40}))
    found = inventory.read_progress(spark, str(progress))
    assert rows(found) == [(0, 3, 40), (11, 14, 40)]
    assert [tuple(r) for r in inventory.progress_totals(found).filter("worker IS NULL").collect()] == [(None, 17, 40)]
    changes = inventory.last_modifications(inventory.file_listing(spark, str(progress)))
    assert sorted(r.worker for r in changes.collect()) == [0, 11]


def test_last_modification_in_summer(spark):
    df = spark.sql("SELECT '/p/worker2_progress.json' AS path, TIMESTAMP_NTZ'2021-07-01 22:30:00' AS modificationTime")
    assert tuple(inventory.last_modifications(df).first()) == (2, "02-07-2021 00:30:00")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        zoned = spark.sql("SELECT '/p/worker2_progress.json' AS path, TIMESTAMP'2021-07-01 22:30:00Z' AS modificationTime")
        assert tuple(inventory.last_modifications(zoned).first()) == (2, "02-07-2021 00:30:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_materialise_keeps_or_refreshes(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.materialise(spark.range(3), path).count() == 3
    assert sinks.materialise(spark.range(5), path).count() == 3
    assert sinks.materialise(spark.range(5), path, refresh=True).count() == 5


def test_a_failed_refresh_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    old = sinks.materialise(spark.range(30), path)
    broken = spark.range(0, 40, numPartitions=4).select(F.when(F.col("id") < 35, F.col("id")).otherwise(F.raise_error(F.lit("half-way")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="half-way"):
        sinks.materialise(broken, path, refresh=True)
    assert versions.commits(spark, path) == [1] and len(list((tmp_path / "t" / "data").iterdir())) == 1
    assert rows(versions.read_version(spark, path)) == rows(old) and old.count() == 30


def test_versions_of_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(versions.NoVersion):
        versions.read_version(spark, path)
    first = sinks.materialise(spark.range(1), path)
    second = sinks.materialise(first.union(first), path, refresh=True)  # rebuilt from itself
    assert (first.count(), second.count()) == (1, 2)  # who has begun to read the first goes on
    sinks.materialise(second.union(second), path, refresh=True)
    assert versions.commits(spark, path) == [2, 3]
    assert versions.read_version(spark, path, 2).count() == 2 and versions.read_version(spark, path).count() == 4
    with pytest.raises(versions.NoVersion):
        versions.read_version(spark, path, 1)
    spark.range(9).write.parquet(f"{path}/data/orphan")
    versions.vacuum(spark, path, keep=1, orphans_after_s=3600)
    assert (tmp_path / "t" / "data" / "orphan").exists()
    versions.vacuum(spark, path, keep=1, orphans_after_s=-5)
    assert versions.commits(spark, path) == [3] and len(list((tmp_path / "t" / "data").iterdir())) == 1
    with pytest.raises(ValueError):
        versions.vacuum(spark, path, keep=0)


def test_two_writers_take_two_numbers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.write_version(spark.range(1), path)
    known, looks = versions.commits, [[]]  # the first look is older than the other writer's commit
    monkeypatch.setattr(versions, "commits", lambda *a: looks.pop() if looks else known(*a))
    assert versions.write_version(spark.range(2), path) == 2
    assert [versions.read_version(spark, path, n).count() for n in (1, 2)] == [1, 2]
    assert not store.write_text_once(spark, f"{path}/versions/00000001", "x", f"{path}/versions/_draft")
    assert not (tmp_path / "t" / "versions" / "_draft").exists()


def test_staging_removes_its_tables(spark, tmp_path):
    with pytest.raises(ZeroDivisionError), staging(spark):
        outer = durable(spark.range(3))
        with staging(spark):
            inner = durable(spark.range(4))
            assert inner.count() == 4
        assert outer.count() == 3
        places = [f.inputFiles()[0].rsplit("/", 1)[0] for f in (outer,)]
        assert store.path_exists(spark, places[0])
        raise ZeroDivisionError
    assert not store.path_exists(spark, places[0])


def test_export_leaves_nested_columns_out(spark, tmp_path):
    df = spark.range(2).withColumn("DICOM_Studies", F.array(F.lit(1)))
    sinks.export_csv(df, str(tmp_path / "c"), gzip=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["id"]
    assert list((tmp_path / "c").glob("*.gz"))


def test_sealed_mapping(spark, tmp_path):
    mapping = spark.createDataFrame([(1, 10), (2, None)], "id_bci long, id_random long")
    path, key = str(tmp_path / "s"), b"k" * 16
    checksum = sinks.seal_mapping(mapping, path, key)
    assert b"id_bci\":1" not in b"".join(p.read_bytes() for p in (tmp_path / "s").glob("*.parquet"))
    assert rows(sinks.open_mapping(spark, path, key, checksum)) == rows(mapping)
    with pytest.raises(sinks.BrokenSeal):
        sinks.open_mapping(spark, path, key, (3, "0"))
    with pytest.raises(Exception):
        sinks.open_mapping(spark, path, b"x" * 16, checksum)
    other = str(tmp_path / "t")
    flipped = F.concat(F.substring("payload", 1, 20), F.unhex(F.lit("00")), F.substring("payload", 22, 1000))
    spark.read.parquet(path).select(flipped.alias("payload")).write.parquet(other)
    with pytest.raises(Exception):  # a changed row does not open
        sinks.open_mapping(spark, other, key, checksum)
    assert spark.read.parquet(path).columns == ["payload"]
    assert "6b6b6b" not in plan(sinks.open_mapping(spark, path, key, checksum)).lower().replace(" ", "")


def test_mapping_manifest(spark, tmp_path):
    folder = tmp_path / "m"
    (folder / "sub").mkdir(parents=True)
    (folder / "a.csv").write_text("id_bci,id_random\n1,10\n")
    (folder / "sub" / "a.csv").write_text("id_bci,id_random\n2,20\n")
    manifest = extracts.mapping_manifest(spark, str(folder))
    assert sorted(manifest) == ["a.csv", "sub/a.csv"]
    assert rows(extracts.read_mapping(spark, str(folder), manifest)) == [(1, 10), (2, 20)]
    (folder / "evil.txt").write_text("id_bci,id_random\n1,99\n")
    with pytest.raises(extracts.ChecksumMismatch):
        extracts.read_mapping(spark, str(folder), manifest)
    (folder / "evil.txt").unlink()
    (folder / "a.csv").write_text("id_bci,id_random\n1,11\n")
    with pytest.raises(extracts.ChecksumMismatch):
        extracts.read_mapping(spark, str(folder), manifest)
    with pytest.raises(extracts.ChecksumMismatch):
        extracts.read_mapping(spark, str(tmp_path / "nothing"), {})


def test_several_files_for_a_table(spark, tmp_path):
    for name in ("a adicap ks.csv", "b adicap ks.csv"):
        (tmp_path / name).write_text("code;libelle\n")
    with pytest.raises(extracts.SeveralExtracts):
        extracts.route_file(spark, str(tmp_path), "adicap")


def test_long_root_is_refused(spark):
    uid = pseudo_uid(F.col("id"), F.lit("1.2"), "1" * 24)
    made = spark.range(200).select(uid.alias("u"), F.length(uid).alias("n"))
    assert made.select("u").distinct().count() == 200 and made.agg(F.max("n")).first()[0] <= 64
    with pytest.raises(ValueError):
        pseudo_uid("id", "uid", "1" * 25)


def test_registry_refuses_what_does_not_fit(spark, people, tmp_path):
    for column, value in (("Identifiant_temporaire", "x" * 23), ("NIR_du_beneficiaire", "1" * 12), ("Date_de_naissance", "1/2/1950")):
        with pytest.raises(registry.BadIdentities):
            registry.write_registry_file(people.withColumn(column, F.lit(value)), str(tmp_path / column), "06/04/2021", "PROJT", "042")
        assert not (tmp_path / column).exists()
    with pytest.raises(registry.BadIdentities):
        registry.write_registry_file(people, str(tmp_path / "p"), "06/04/2021", "PROJECT", "042")


def test_exports_can_be_repeated(spark, tmp_path):
    mails = spark.createDataFrame([("a@b.fr",), ("bad",)], "email string")
    for _ in range(2):
        sinks.export_csv(spark.range(3), str(tmp_path / "c"))
        sinks.export_emails(mails, str(tmp_path / "m"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 3
    assert spark.read.option("header", True).csv(str(tmp_path / "m")).count() == 1


def test_patch_batches(spark, tmp_path):
    path = str(tmp_path / "patch")
    sinks.append_patch(spark.range(25).coalesce(1), path, 10)
    assert len(list((tmp_path / "patch").glob("part-*"))) == 3
    sinks.append_patch(spark.range(25, 30).coalesce(1), path, 10)
    assert spark.read.option("header", True).csv(path).count() == 30


# --- images -------------------------------------------------------------------------------


def test_view_counts(spark):
    views = {
        "full": ["rmlo", "lmlo", "rcc", "lcc"], "missing": ["rmlo", "lmlo", "rcc", "ml"],
        "double": ["rmlo", "rmlo", "lmlo", "rcc", "lcc"], "few": ["rcc", None],
    }
    df = spark.createDataFrame([(s, v) for s, vs in views.items() for v in vs], "study string, view string")
    counts = images.view_counts(df, "study", F.col("view"))
    assert {r.study: (r.complete, r.overpopulated, r.images) for r in counts.collect()} == {
        "full": (True, False, 4), "missing": (False, False, 4), "double": (True, True, 5), "few": (False, False, 2),
    }
    assert tuple(images.completeness(counts).first()) == (2, 4, 0.5)
    assert tuple(images.overpopulation(counts).first()) == (1, 4, 25.0)
    broken = images.broken_studies(df.withColumn("m", F.when(F.col("view").isNull(), "US").otherwise("MG")), "study", "m")
    assert tuple(broken.first()) == (1, 3, 1, 1)


def test_tag_sums(spark):
    df = spark.createDataFrame([("1.5",), ("2",), (None,)], "Relative_0x00181405 string")
    assert float(images.tag_sum(df, "0x00181405").first().total) == 3.5
    with pytest.raises(ValueError):
        images.tag_sum(df, "0x1234")
    assert images.same_tag_sum(df, df, "0x00181405").first().equal
    assert not images.same_tag_sum(df, df.limit(1), "0x00181405").first().equal


def test_patch_rows(spark):
    df = spark.createDataFrame(
        [(1, "s", "i", "R", "R-10242", "cc", "SNM3")],
        "id_random long, study_uid string, sop_uid string, laterality string, view_code string, view_meaning string, view_scheme string",
    )
    row = images.patch_rows(df, "2.25").first()
    assert row[0].startswith("2.25.") and row[1].startswith("2.25.") and tuple(row[2:]) == ("R", "R-10242", "cc", "SNM3")


# --- profiles and histograms --------------------------------------------------------------


@pytest.mark.parametrize("tied", [10_000, 2])
def test_frequent_values_of_wide_columns(spark, monkeypatch, tied):
    for name, n in (("FEW", 5), ("TIED", tied), ("BUCKETS", 64), ("ROUND", 16)):
        monkeypatch.setattr(profile, name, n)
    data = [(f"u{i:04d}", f"d{i // 2:03d}" if i < 400 else f"a{i:04d}", "hot" if i % 3 == 0 else f"h{i}", None if i % 2 else i % 3) for i in range(700)]
    data += [(None, "None", "h1", 0)] * 3
    df = spark.createDataFrame(data, "alone string, twice string, hot string, few int").repartition(5)
    got = {r["column"]: r for r in profile.tag_profile(df).collect()}
    for i, name in enumerate(df.columns):
        values = Counter(str(d[i]) for d in data if d[i] not in (None, "None"))
        best = sorted(values.items(), key=lambda v: (-v[1], v[0]))[:10]
        assert got[name].samples == ", ".join(v for v, _ in best)[:100]
        assert got[name].unique == len(values)
        assert got[name].empty_pct == round(100 * (len(data) - sum(values.values())) / len(data), 2)


def test_values_of_wide_columns_are_not_shuffled(spark):
    df = spark.range(50).select(F.concat(F.lit("v"), "id").alias("wide"))
    steps = plan(profile.short_profile(df))
    assert "hashpartitioning(column" in steps and not re.search(r"hashpartitioning\([^)]*(wide|value)#", steps)


def test_sketches_merge(spark):
    df = spark.range(6000).select((F.col("id") % 900).alias("v"), F.when(F.col("id") % 4 != 0, F.lit("same")).alias("s"))
    parts = [profile.sketches(p) for p in (df.where("v < 500"), df.where("v >= 400"), df.limit(0))]
    got = {r["column"]: r for r in profile.estimated_profile(profile.merged_sketches(parts[0].union(parts[1]).union(parts[2])), k=2).collect()}
    assert abs(got["v"].about_unique - 900) < 30 and got["v"].empty_pct == 0
    assert got["s"].about_unique == 1 and got["s"].empty_pct == 25.0 and len(got["s"].heaviest) == 1


def test_profile(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 2.0, None), ("b", float("nan"), None), (None, 2.0, None)], "s string, d double, e int")
    out = {r["column"]: r for r in profile.profile(df, disclose_limit=2, undisclosed_types=["double"]).collect()}
    assert (out["s"].empty_pct, out["s"].unique, out["s"].avg_repetition, out["s"]["values"]) == (25.0, 2, 1.5, "undisclosed")
    assert (out["d"].empty_pct, out["d"].unique, out["d"]["values"]) == (25.0, 2, "undisclosed")
    assert (out["e"].empty_pct, out["e"].unique, out["e"].avg_repetition, out["e"]["values"]) == (100.0, 0, None, "")
    shown = {r["column"]: r["values"] for r in profile.profile(df, disclose_limit=3).collect()}
    assert shown["s"] == "a: 2, b: 1"
    tags = profile.tag_profile(spark.createDataFrame([("None",), ("x" * 200,)], "t string")).first()
    assert tags.empty_pct == 50.0 and tags.samples == "x" * 100


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 5, 9.99, 10)], "x double")
    assert rows(reports.histogram(df, "x", 10), "bin", "n") == [(1, 1), (10, 2), (2, 1), (6, 1)]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert reports.histogram(flat, "x", 4).agg(F.sum("n")).first()[0] == 2
    assert reports.histogram(flat.limit(0), "x", 4).count() == 0


def test_coherence_leaves_null_keys_out(spark):
    df = spark.createDataFrame([("a", "d"), ("a", None), (None, "d")], "k string, Date_Mammo string")
    assert rows(reports.coherence(df, ["k"])) == [("a", 1)]


# --- arrivals -----------------------------------------------------------------------------


def test_arrivals_once_each(spark, tmp_path):
    inbox, target, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "k string, v int"
    first = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1), (None, 1)], schema)
    first.write.mode("append").parquet(inbox)
    run = lambda: arrivals.follow_arrivals(spark, inbox, first.schema, target, check, ["k"])
    run()
    assert rows(arrivals.arrived(spark, target), "k") == [("a",), ("b",)]
    spark.createDataFrame([("b", 2), ("c", 2)], schema).write.mode("append").parquet(inbox)
    run()
    run()
    assert rows(arrivals.arrived(spark, target), "k", "v") == [("a", 1), ("b", 1), ("c", 2)]
    again = spark.createDataFrame([("b", 2), ("c", 2)], schema)
    stream = arrivals.arrived(spark, target).first().stream
    arrivals.take_over(again, target, ["k"], 1, stream)  # a repeated batch changes nothing
    assert rows(arrivals.arrived(spark, target), "k", "v") == [("a", 1), ("b", 1), ("c", 2)]


def test_arrivals_with_a_new_checkpoint(spark, tmp_path):
    inbox, target = (str(tmp_path / n) for n in ("in", "out"))
    first = spark.createDataFrame([("a", 1, "x"), ("b", 5, "y"), ("b", 5, "z"), ("b", 1, "zz")], "k string, v int, w string")
    first.write.parquet(inbox)
    for check in ("one", "two"):  # the second one sees every file again, as its own batch 0
        arrivals.follow_arrivals(spark, inbox, first.schema, target, str(tmp_path / check), ["k"])
        assert rows(arrivals.arrived(spark, target), "k", "v", "w") == [("a", 1, "x"), ("b", 5, "z")]
    first.limit(0).union(spark.createDataFrame([("c", 9, "n")], first.schema)).write.mode("append").parquet(inbox)
    arrivals.follow_arrivals(spark, inbox, first.schema, target, str(tmp_path / "two"), ["k"])
    assert rows(arrivals.arrived(spark, target), "k", "v", "w") == [("a", 1, "x"), ("b", 5, "z"), ("c", 9, "n")]


def test_a_batch_reads_its_own_buckets_only(spark, tmp_path):
    target, layout = str(tmp_path / "out"), arrivals.Layout(buckets=32, filter_bits=1 << 10)
    numbers = spark.range(400).select(F.col("id").cast("string").alias("k"), F.lit("wide").alias("v"))
    arrivals.take_over(numbers, target, ["k"], 0, "s", layout)
    assert arrivals.arrived(spark, target).count() == 400
    batch = spark.createDataFrame([("7", "again"), ("new", "x")], "k string, v string")
    staged = batch.withColumn("bucket", layout.place(["k"]))
    own = {r.bucket for r in staged.collect()}
    fresh = arrivals.unseen(staged, target, ["k"], 0, "t", layout)
    assert rows(fresh, "k") == [("new",)]
    read = {re.search(r"/rows/bucket=(\d+)/", f) for f in fresh.inputFiles()}
    assert {int(m[1]) for m in read if m} <= own and any(read)
    only_new = spark.createDataFrame([("quite new", "x")], "k string, v string").withColumn("bucket", layout.place(["k"]))
    wide = arrivals.Layout(buckets=32, filter_bits=1 << 20)
    arrivals.take_over(numbers, str(tmp_path / "wide"), ["k"], 0, "s", wide)
    fresh = arrivals.unseen(only_new, str(tmp_path / "wide"), ["k"], 0, "t", wide)
    assert fresh.count() == 1 and not [f for f in fresh.inputFiles() if "/rows/" in f]  # the filter alone decides


@pytest.mark.parametrize("bits", [64, 1 << 16])
def test_filters_only_save_work(spark, tmp_path, bits):
    target, layout = str(tmp_path / "out"), arrivals.Layout(buckets=3, filter_bits=bits)
    for batch in range(4):
        part = spark.range(batch * 60, batch * 60 + 100).select(F.col("id").alias("a"), (F.col("id") % 7).cast("string").alias("b"), F.lit(batch).alias("v"))
        for _ in range(2 if batch == 2 else 1):  # one batch is repeated
            arrivals.take_over(part, target, ["a", "b"], batch, "s", layout)
    got = rows(arrivals.arrived(spark, target), "a", "v")
    assert got == sorted(((i, min(max(0, (i - 40) // 60), 3)) for i in range(280)), key=repr)
    with pytest.raises(ValueError):
        arrivals.layout_of(spark, target, arrivals.Layout(buckets=4))


def test_an_interrupted_batch_starts_over(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "out")
    first = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    arrivals.take_over(first, target, ["k"], 0, "s")
    second = spark.createDataFrame([("b", 2), ("c", 2), ("d", 2)], "k string, v int")
    arrivals.take_over(second, target, ["k"], 1, "s")
    gone = [p for p in (tmp_path / "out" / "rows").glob("bucket=*/stream=s/batch=1")]
    assert len(gone) == 2
    store.remove(spark, str(gone[0]))  # as if it had stopped between two buckets
    arrivals.take_over(second, target, ["k"], 1, "s")
    assert rows(arrivals.arrived(spark, target), "k", "v") == [("a", 1), ("b", 1), ("c", 2), ("d", 2)]
    with pytest.raises(ValueError):
        arrivals.take_over(first.withColumnRenamed("v", "bucket"), target, ["k"], 2, "s")


# --- patches and ledgers ------------------------------------------------------------------


def test_an_interrupted_patch_goes_on(spark, tmp_path):
    studies = spark.range(60).select(F.concat(F.lit("s"), "id").alias("study_id"))
    asked = []

    def extract(chosen):
        asked.append(chosen.count())
        if len(asked) == 3:
            raise OSError("interrupted")
        return chosen.select("study_id", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("image")).where("study_id <> 's7'")

    path = str(tmp_path / "p")
    with pytest.raises(OSError):
        patches.extend_patch(studies, extract, path, parts=8, parts_a_step=2)
    assert len(patches.done_parts(spark, path)) == 4
    broken = patches.with_part(studies.select("study_id", F.lit(99).alias("image")), "study_id", 8)
    left = min(set(range(8)) - set(patches.done_parts(spark, path)))
    broken.where(F.col("part") == left).write.mode("append").partitionBy("part").parquet(path)  # as if half-written
    out = patches.extend_patch(studies, extract, path, parts_a_step=2)
    want = [(f"s{i}", k) for i in range(60) if i != 7 for k in (1, 2)]
    assert rows(out) == sorted(want, key=repr)
    assert sum(asked) == 60 + asked[2]  # nothing whole was asked for again
    steps = len(asked)
    assert rows(patches.extend_patch(studies, extract, path)) == rows(out) and len(asked) == steps + 1  # only its columns
    assert patches.remaining_studies(studies, path).count() == 0
    with pytest.raises(ValueError):
        patches.parts_of(spark, path, 9)
    assert patches.extend_patch(studies.limit(0), lambda s: s, str(tmp_path / "none"), parts=2).count() == 0


def test_ids_stay_when_people_are_added(spark, tmp_path):
    path = str(tmp_path / "l")
    people = spark.range(300).select(F.col("id").alias("id_bci"))
    first = dict(rows(ledger.extend_ledger(people.where("id_bci % 2 = 0").union(people.where("id_bci < 3")), path, "id_bci", "a")))
    assert sorted(first.values()) == list(range(151)) and list(first.values()) != sorted(first.values())
    assert dict(rows(ledger.extend_ledger(people.where("id_bci < 9 AND id_bci % 2 = 0"), path, "id_bci", "a"))) == first
    spark.range(5).write.parquet(f"{path}/rows/abandoned")  # rows without an entry count for nothing
    nobody = spark.sql("SELECT CAST(NULL AS BIGINT) AS id_bci")
    second = dict(rows(ledger.extend_ledger(people.union(nobody), path, "id_bci", "a")))
    assert {k: second[k] for k in first} == first and sorted(second.values()) == list(range(300))
    assert len(ledger.entries(spark, path)) == 2


def test_a_ledger_that_grew_meanwhile(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "l")
    people = spark.range(20).select(F.col("id").alias("id_bci"))
    ledger.extend_ledger(people.where("id_bci < 10"), path, "id_bci", "a")
    seen, looks = ledger.entries, [[]]  # this run looked before the other one's entry
    monkeypatch.setattr(ledger, "entries", lambda *a: looks.pop() if looks else seen(*a))
    out = rows(ledger.extend_ledger(people, path, "id_bci", "a"), "id_random")
    assert sorted(r[0] for r in out) == list(range(20))


def test_inventory_and_times_of_real_files(spark, tmp_path):
    folder = str(tmp_path / "w")
    sinks.write_progress(spark.createDataFrame([(0, 1, 2), (1, 5, 6)], "worker int, uploaded long, total long"), folder)
    for p in (tmp_path / "w").rglob("*.json"):
        store.touch(spark, str(p), dt.datetime(2021, 7, 1, 22, 30))
    assert {tuple(r) for r in inventory.last_modifications(inventory.file_listing(spark, folder, "*.json")).collect()} == {
        (0, "02-07-2021 00:30:00"), (1, "02-07-2021 00:30:00")
    }
    sizes = [p.stat().st_size for p in (tmp_path / "w").rglob("*.json")]
    found = inventory.file_inventory(spark, folder, ".json").first()
    assert (found.files, found.total_mb, found.mean_bytes) == (2, sum(sizes) / 1048576, round(sum(sizes) / 2, 2))
