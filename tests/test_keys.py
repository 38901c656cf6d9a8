import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from cohortloom.operators import keys


@pytest.fixture(scope="module")
def df(spark):
    data = [(1, "a", 1), (1, "b", 2), (2, "c", 3), (None, "d", 4), (3, "e", 5), (3, "f", 6), (3, "g", 7)]
    return spark.createDataFrame(data, "k int, v string, ord int")


def test_na_and_notna_partition_the_rows(df):
    assert rows(keys.na_rows(df, "k"), "v") == [("d",)]
    assert keys.notna_rows(df, ["k", "v"]).count() + keys.na_rows(df, ["k", "v"]).count() == df.count()


def test_nan_key_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "k double")
    assert keys.na_rows(df, "k").count() == 2


def test_dup_rows_has_all_members_sorted(df):
    out = sorted(tuple(r) for r in keys.dup_rows(keys.notna_rows(df, "k"), "k").collect())
    assert out == [(1, "a", 1), (1, "b", 2), (3, "e", 5), (3, "f", 6), (3, "g", 7)]


def test_keep_last_follows_the_order(df):
    assert rows(keys.force_key(df, "k", ["ord"]), "k", "v") == [(1, "b"), (2, "c"), (3, "g")]
    with pytest.raises(ValueError):
        keys.keep_last(df, "k", [])


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("ord"))
    out = keys.keep_last(df, "k", ["ord"])
    assert "WindowGroupLimit" in plan(out) and "Partial" in plan(out)
    assert out.filter("k = 7").first().ord == 19998


def test_counts_add_up(df):
    t = keys.keyed(df, "k", ["ord"])
    dropped = t.dup.count() - t.dup.select("k").distinct().count()
    assert t.clean.count() + t.na.count() + dropped == df.count()
    keys.assert_unique(t.clean, "k")
    with pytest.raises(keys.KeyViolation):
        keys.assert_unique(df, "k")


def test_unique_audit(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, "y")], "id int, u string")
    na, dup = keys.unique_audit(df, "u")
    assert rows(na, "id") == [(3,)] and rows(dup, "id") == [(1,), (2,)]


def test_foreign_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (9,), (9,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    fks = [keys.ForeignKey("child", "fk", "parent")]
    report = keys.fk_report({"child": child, "parent": parent}, fks, {"parent": "pk"}).first()
    assert (report.orphans, report.example) == (1, "9")
    with pytest.raises(keys.KeyViolation, match="1 unknown values, e.g. 9"):
        keys.check_fks({"child": child, "parent": parent}, fks, {"parent": "pk"})
    keys.check_fks({"child": child.filter("fk < 5"), "parent": parent}, fks, {"parent": "pk"})
    text = parent.select(F.col("pk").cast("string"))
    with pytest.raises(keys.KeyViolation, match="is int"):
        keys.fk_report({"child": child, "parent": text}, fks, {"parent": "pk"})


def test_empty_columns(spark):
    df = spark.createDataFrame([(1, "None", None, "a"), (2, None, None, None)], "k int, t string, n double, s string")
    assert keys.empty_columns(df) == ["t", "n"]
    assert keys.drop_empty_columns(df).columns == ["k", "s"]


@pytest.mark.parametrize("words", [1 << 10, 1, 0])
def test_keyed_apart_equals_keyed(spark, monkeypatch, words):
    monkeypatch.setattr(keys.sieve, "SIEVE", words)
    values = [(1, "a", 1), (1, "b", 2), (None, "c", 3), (2, "d", 4), (3, None, 5), (3, "e", 6), (3, "e", 7), *((k, "x", k) for k in range(10, 60))]
    df = spark.createDataFrame(values, "k long, v string, place long")
    apart, plain = keys.keyed_apart(df, "k", ["place"]), keys.keyed(df, "k", ["place"])
    for a, b in ((apart.clean, plain.clean), (apart.na, plain.na), (apart.dup, plain.dup)):
        assert rows(a) == rows(b)
    if words > 1:  # what is in an exchange by key is one of the two branches, that of rows which may be repeated
        assert "LeftAnti" in plan(apart.clean) and "BroadcastHashJoin" in plan(apart.clean)
    two = keys.keyed_apart(df, ["k", "v"], ["place"])
    assert rows(two.dup) == rows(keys.keyed(df, ["k", "v"], ["place"]).dup) and len(rows(two.dup)) == 2
