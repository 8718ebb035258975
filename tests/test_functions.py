"""Column helpers reproduce Python/pandas string and parsing semantics (traps of the survey)."""

from pyspark.sql import functions as F

from starloom.functions import (
    date_key,
    dim_date_columns,
    lenient_double,
    lenient_int,
    lenient_timestamp,
    na_to_null,
    strip_ws,
    title_case,
    zfill,
)


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_title_case_matches_python(spark):
    values = ["santa bárbara d'oeste", "embu-guaçu", "4-NOT SPECIFIED", "customer#0001x", "", None, "ÁGUA  doce"]
    got = one_col(spark, values, title_case)
    assert got == [v.title() if v is not None else None for v in values]


def test_initcap_differs_where_title_case_must_not(spark):
    got = one_col(spark, ["d'oeste"], F.initcap)
    assert got == ["D'oeste"]  # why title_case exists


def test_strip_removes_unicode_whitespace(spark):
    values = ["  a b ", "\tx\n", " y ", "z", None]
    assert one_col(spark, values, strip_ws) == [v.strip() if v is not None else None for v in values]


def test_zfill_matches_python(spark):
    values = ["1310", "01310", "123456", "-12", "+7", "", "ab"]
    assert one_col(spark, values, lambda c: zfill(c, 5)) == [v.zfill(5) for v in values]


def test_na_tokens(spark):
    values = ["NA", "null", "N/A", "", "NaN", "-", "nil", "x", None]
    assert one_col(spark, values, na_to_null) == [None, None, None, None, None, "-", "nil", "x", None]


def test_lenient_numbers(spark):
    values = ["12.5", " 7 ", "NaN", "1,000", "1e3", "abc", None, "-5", "1d", "2.5f", "0x1p3", ".5", "5.", "-inf", "+1E-2", "1_0"]
    want = [12.5, 7.0, None, None, 1000.0, None, None, -5.0, None, None, None, 0.5, 5.0, float("-inf"), 0.01, None]
    assert one_col(spark, values, lenient_double) == want
    assert one_col(spark, values, lambda c: lenient_double(c, 0.0)) == [0.0 if v is None else v for v in want]


def test_lenient_int_truncates_and_defaults(spark):
    values = ["2.7", "3", "x", None, "NaN", "1e10", "-1.9", "3000000000", "9007199254740993", "1e30", "7d", "inf"]
    want = [2, 3, 1, 1, 1, 10**10, -1, 3_000_000_000, 9007199254740993, 1, 1, 1]
    assert one_col(spark, values, lambda c: lenient_int(c, 1)) == want


def test_lenient_timestamp_formats(spark):
    import datetime as dt

    values = ["2017-10-02 10:56:33", "2017-10-02T10:56:33", "2017-10-02", " 2018-02-01 00:00:00",
              "10:00", "not a date", None, "2017-10-02 10:56", "2017/10/02 10:56:33", "2017-10-02T10:56:33.123",
              "2017-10-02T10:56:33Z", "2017-10-02 10:56:33.123456789", "10/02/2017", "13/02/2017", "2017-02-30",
              "2017-10-02T10:56:33+0530", "2017-10-02 10:56:33 and more", "9/3/2018 7:05"]
    got = one_col(spark, values, lenient_timestamp)
    assert got == [
        dt.datetime(2017, 10, 2, 10, 56, 33),
        dt.datetime(2017, 10, 2, 10, 56, 33),
        dt.datetime(2017, 10, 2),
        dt.datetime(2018, 2, 1),
        None,
        None,
        None,
        dt.datetime(2017, 10, 2, 10, 56),
        dt.datetime(2017, 10, 2, 10, 56, 33),
        dt.datetime(2017, 10, 2, 10, 56, 33, 123000),
        dt.datetime(2017, 10, 2, 10, 56, 33),
        dt.datetime(2017, 10, 2, 10, 56, 33, 123456),
        dt.datetime(2017, 10, 2),  # month first
        None,  # no thirteenth month
        None,
        dt.datetime(2017, 10, 2, 10, 56, 33),  # wall-clock time of its zone
        None,
        dt.datetime(2018, 9, 3, 7, 5),
    ]
    assert one_col(spark, ["02.10.2017"], lambda c: lenient_timestamp(c, ["dd.MM.yyyy"])) == [dt.datetime(2017, 10, 2)]


def test_date_key_and_dim_columns(spark):
    df = spark.createDataFrame([("2017-10-02",), ("2018-06-10",)], "s string").select(F.to_date("s").alias("d"))
    rows = df.select(*dim_date_columns("d")).collect()
    assert [tuple(r) for r in rows] == [
        (20171002, "2017-10-02", 2017, 10, 2, 4, "Monday"),
        (20180610, "2018-06-10", 2018, 6, 10, 2, "Sunday"),
    ]
    assert df.select(date_key(F.lit(None).cast("timestamp"))).first()[0] is None
