import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import clean
from cohortloom.operators import images
from cohortloom.sources.pages import typed_value


def apply(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_yes_no(spark):
    values = ["Oui", "O", "Positif", "+", "P", "Non", "N", "Négatif", "-", "I", "A", "9", " ", "what", None]
    assert apply(spark, values, "string", clean.yes_no("c")) == [True] * 5 + [False] * 4 + [None] * 6


def test_age(spark):
    values = ["45.9", "0", "0.5", "119.9", "120", "-3", " ", "NaN", None]
    assert apply(spark, values, "string", clean.clean_age("c")) == [45, None, 0, 119, None, None, None, None, None]


def test_blank_and_sentinels(spark):
    assert apply(spark, [" ", "", "a", None], "string", clean.blank_to_null("c")) == [None, "", "a", None]
    assert apply(spark, ["", "None", "a", None], "string", clean.sentinel_to_null("c")) == [None, None, "a", None]
    assert apply(spark, ["", "None", "12", None], "string", clean.to_nullable_int("c")) == [None, None, 12, None]
    assert apply(spark, ["NA", "", "null", "x", " "], "string", clean.csv_null("c")) == [None, None, None, "x", " "]


def test_numbers(spark):
    assert apply(spark, ["1 234,5", "7", "x", "NaN", None], "string", clean.decimal_comma("c")) == [1234.5, 7.0, None, None, None]
    assert apply(spark, ["1 234", "12.0", "x", None], "string", clean.whole_number("c")) == [1234, 12, None, None]


def test_strict_date(spark):
    day = dt.datetime(2020, 2, 1)
    assert apply(spark, ["01/02/2020", "1/2/2020", None], "string", clean.strict_date("c")) == [day, day, None]
    assert apply(spark, ["31/02/2020"], "string", clean.tolerant_date("c")) == [None]
    with pytest.raises(Exception):
        apply(spark, ["31/02/2020"], "string", clean.strict_date("c"))


def test_one_hot(spark):
    df = spark.createDataFrame([("a",), ("b",), (" ",)], "BDI string")
    out = clean.one_hot(df, "BDI", {"a": "bdi", "b": None})
    assert out.columns == ["bdi"] and [r[0] for r in out.collect()] == [True, False, False]
    for unknown in ("z", None):
        bad = clean.one_hot(spark.createDataFrame([(unknown,)], "s string"), "s", {"a": "x"})
        with pytest.raises(Exception, match="unlisted"):
            bad.collect()
    loose = clean.one_hot(spark.createDataFrame([("z",), (None,)], "s string"), "s", {"a": "x"}, strict=False)
    assert [r[0] for r in loose.collect()] == [False, False]


@pytest.mark.parametrize(
    "a, b, months",
    [("2020-01-31", "2019-12-01", 1), ("2020-03-01", "2020-01-31", 2), ("2020-05-01", "2020-05-31", 0), ("2019-12-31", "2021-01-01", 13)],
)
def test_month_distance(spark, a, b, months):
    df = spark.sql(f"SELECT DATE '{a}' a, DATE '{b}' b")
    assert df.select(clean.month_distance("a", "b")).first()[0] == months


def test_acr(spark):
    assert apply(spark, ["1", "5", "x", "", "2.5", None], "string", clean.acr_level("c")) == [1, 5, 0, 0, 0, 0]
    df = spark.createDataFrame([("1", "2"), ("1", "3"), ("x", "1"), (None, "2"), ("2", "2")], "r string, l string")
    assert [r[0] for r in df.select(clean.reader_result("r", "l")).collect()] == [
        "negative", "positive", "positive", "positive", "negative",
    ]
    assert df.select(clean.highest_acr("r", "l")).collect()[1][0] == 3


def test_email(spark):
    values = ["a.b+c@d-e.fr", "a@b", "a@@b.c", "a b@c.fr", None]
    assert apply(spark, values, "string", clean.valid_email("c")) == ["a.b+c@d-e.fr", None, None, None, None]


def test_links_are_three_valued(spark):
    df = spark.createDataFrame([("x" * 11, None), ("x", None), ("x", "y"), (None, "y" * 12)], "a string, b string")
    assert [r[0] for r in df.select(clean.long_link("a", "b")).collect()] == [True, None, False, True]


def test_labels(spark):
    df = spark.createDataFrame([("O", "+"), ("O", "-"), ("N", "+"), (None, "+"), ("O", " ")], "e string, r string")
    assert [r[0] for r in df.select(clean.receptor_label("e", "r")).collect()] == ["Positif", "Négatif", None, None, None]
    assert apply(spark, ["a", "z", None], "string", clean.label_of("c", {"a": "A"}, "-")) == ["A", "-", "-"]
    assert apply(spark, ["04/03/21"], "string", clean.compact_date("c")) == ["040321"]
    assert apply(spark, [3, 123456789], "int", clean.zero_padded(F.col("c"), 8)) == ["00000003", "123456789"]


def test_views(spark):
    data = [("R-10226", "R"), ("R-10226", "l"), ("R-10242", "r"), ("R-10242", "X"), ("R-1022A", "L"), (None, "R"), ("R-10242", None)]
    df = spark.createDataFrame(data, "code string, lat string")
    assert [r[0] for r in df.select(images.view_label("code", "lat")).collect()] == ["rmlo", "lmlo", "rcc", "lcc", "xccl", "N/A", "N/A"]
    with pytest.raises(Exception, match="unlisted view code"):
        spark.createDataFrame([("R-0", "R")], "code string, lat string").select(images.view_label("code", "lat")).collect()


def test_declared_types(spark):
    assert apply(spark, ["0000-00-00", "2020-01-02", "2400-01-01", None], "string", typed_value(F.col("c"), "date")) == [
        None, dt.date(2020, 1, 2), None, None,
    ]
    assert apply(spark, ["2020-01-02 03:04:05", "1500-01-01 00:00:00"], "string", typed_value(F.col("c"), "datetime")) == [
        dt.datetime(2020, 1, 2, 3, 4, 5), None,
    ]
    assert apply(spark, ["12"], "string", typed_value(F.col("c"), "fkey_varset")) == [12]
    assert apply(spark, ["12"], "string", typed_value(F.col("c"), "false")) == ["12"]
    with pytest.raises(NotImplementedError):
        typed_value(F.col("c"), "geo")
