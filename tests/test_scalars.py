import datetime as dt

from pyspark.sql import functions as F

from fieldload.functions import scalars as S


def col_values(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_resolve_site_cases(spark):
    raw = ["12", "12_old", " 12 ", "12 _x", "x_12", "", "-5", "12.0", "None", "_12", "12_", "12_a\nb", "\t12\n"]
    want = [12, 12, 12, None, None, None, None, None, None, None, 12, 12, 12]
    assert col_values(spark, raw, S.resolve_site) == want


def test_resolve_site_null_and_overflow(spark):
    assert col_values(spark, [None, "99999999999999999999999"], S.resolve_site) == [None, None]


def test_round_half_even(spark):
    got = col_values(spark, [0.5, 1.5, 2.5, -0.5], lambda c: S.pixel_bound(c, F.lit(1)), "double")
    assert got == [0, 2, 2, 0]


def test_parse_timestamps(spark):
    raw = [
        "2021-03-04T05:06:07.123456Z",
        "2021-03-04 05:06:07+02:00",
        "2021-03-04",
        "04/03/2021",
        "Mar 4 2021 5pm",
        "20210304T050607",
        "junk",
        None,
    ]
    got = col_values(spark, raw, S.parse_ts)
    assert got[0] == dt.datetime(2021, 3, 4, 5, 6, 7, 123456)
    assert got[1] == dt.datetime(2021, 3, 4, 3, 6, 7)
    assert got[2] == dt.datetime(2021, 3, 4)
    assert got[3] == dt.datetime(2021, 4, 3)  # month first
    assert got[4] == dt.datetime(2021, 3, 4, 17)
    assert got[5] == dt.datetime(2021, 3, 4, 5, 6, 7)
    assert got[6] is None and got[7] is None


def test_optional_timestamp_blank_is_not_error(spark):
    df = spark.createDataFrame([("",), (None,), ("junk",), ("2021-01-01",)], "v string")
    value, err = S.optional_ts("v")
    rows = df.select(value.alias("t"), err.alias("e")).collect()
    assert [r.e for r in rows] == [False, False, True, False]


def test_hidden_null_is_false(spark):
    assert col_values(spark, ["nothing", "click", None], S.hidden) == [True, False, False]


def test_json_valid(spark):
    assert col_values(spark, ['{"k": 1}', "{bad", None, "[]"], S.json_valid) == [True, False, False, True]


def test_extra_json_keeps_null_keys(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b string")
    assert df.select(S.extra_json("a", "b")).first()[0] == '{"a":1.0,"b":null}'
