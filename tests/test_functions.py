from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from incident_mart import functions as X
from incident_mart.operators import with_surrogate_key


def apply(spark, kind, inputs, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_int_or_zero_truncates_and_fills(spark):
    texts = ["2.9", "-1.5", "x", None, "NaN", "1e2", "", "7", "1.5d", " 4 "]
    assert apply(spark, "string", texts, X.int_or_zero) == [2, -1, 0, 0, 0, 100, 0, 7, 0, 4]


def test_int_or_zero_rejects_infinity(spark):
    with pytest.raises(PySparkException):
        apply(spark, "string", ["inf"], X.int_or_zero)


def test_timestamp_or_null(spark):
    texts = ["2023-09-05T19:05:00.000", "2023-09-05", "2023-09-05 19:05:00", "bad", None, "19:05"]
    at = datetime(2023, 9, 5, 19, 5)
    want = [at, datetime(2023, 9, 5), at, None, None, None]
    assert apply(spark, "string", texts, X.timestamp_or_null) == want


@pytest.mark.parametrize("text", ["x", "12.5", "12.0", ""])
def test_strict_int_raises(spark, text):
    with pytest.raises(PySparkException, match="not a whole number"):
        apply(spark, "string", [text], X.strict_int)


def test_strict_casts_pass(spark):
    assert apply(spark, "string", ["12", "-3", None, "007"], X.strict_int) == [12, -3, None, 7]
    assert apply(spark, "string", ["41.9", "1e3", None], X.strict_float) == [41.9, 1000.0, None]


@pytest.mark.parametrize("text", ["x", "", "1.5d", "2F"])
def test_strict_float_raises(spark, text):
    with pytest.raises(PySparkException, match="not a number"):
        apply(spark, "string", [text], X.strict_float)


def test_strict_casts_raise_without_ansi_too(spark, conf):
    conf("spark.sql.ansi.enabled", "false")
    with pytest.raises(PySparkException, match="not a whole number"):
        apply(spark, "string", ["x"], X.strict_int)


def test_unreadable_agrees_with_strict(spark):
    texts = ["12", "12.5", "x", None, "inf", "nan", "1.5f"]
    want = {
        "int": [False, True, True, False, True, True, True],
        "float": [False, False, True, False, False, False, True],
        "text": [False] * 7,
        "timestamp": [False] * 7,
    }
    for reads_as, flags in want.items():
        assert apply(spark, "string", texts, lambda c, r=reads_as: X.unreadable(c, r)) == flags


def test_infinite_count_is_unreadable(spark):
    flags = apply(spark, "string", ["inf", "x", "2"], lambda c: X.unreadable(c, "int_or_zero"))
    # Text that is no number counts as 0; only a number without a whole part is an error.
    assert flags == [True, False, False]


def test_fills(spark):
    texts = [None, "", "BELT"]
    assert apply(spark, "string", texts, X.fill_safety_equipment) == ["USAGE UNKNOWN", "", "BELT"]
    assert apply(spark, "string", texts, X.fill_pedestrian) == ["PEDESTRAIN", "", "BELT"]
    assert apply(spark, "string", texts, X.blank_to_null) == [None, None, "BELT"]


def test_id_or_one(spark):
    assert apply(spark, "string", ["", None, "7"], X.id_or_one) == [1, 1, 7]
    with pytest.raises(PySparkException, match="not a whole number"):
        apply(spark, "string", ["x"], X.id_or_one)


def test_month_name(spark):
    got = apply(spark, "bigint", [0, 1, 12, 13, -1, None, 9], X.month_name)
    unknown = "Unknown"
    assert got == [unknown, "January", "December", unknown, unknown, unknown, "September"]


def test_calendar_parts_in_utc(spark):
    at = ["2024-12-31 23:59:59", "2025-01-01 00:00:00", None]
    number = apply(spark, "string", at, lambda c: X.month_number(c.cast("timestamp")))
    year = apply(spark, "string", at, lambda c: X.year_number(c.cast("timestamp")))
    assert (number, year) == ([12, 1, None], [2024, 2025, None])


def points(spark, rows, expression):
    numbered = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(numbered, "i int, lon double, lat double")
    shown = df.orderBy("i").select(expression(F.col("lon"), F.col("lat")))
    return [r[0] for r in shown.collect()]


def test_geo_points(spark):
    places = [(-87.6, 41.9), (5.0, -7.0), (None, 1.0), (1.0, None), (190.0, 0.00005)]
    assert points(spark, places, X.geo_wkt) == [
        "POINT(-87.6 41.9)",
        "POINT(5 -7)",
        None,
        None,
        "POINT(-170 0.00005)",
    ]
    got = points(spark, places, X.geo_point)
    assert [g and tuple(g) for g in got] == [
        (-87.6, 41.9),
        (5.0, -7.0),
        None,
        None,
        (-170.0, 0.00005),
    ]


def test_bad_latitude_raises(spark):
    for expression in (X.geo_point, X.geo_wkt):
        with pytest.raises(PySparkException, match="latitude outside"):
            points(spark, [(1.0, 91.0)], expression)


def hexes(df):
    return [r[0] for r in df.select(F.lower(F.hex("unique_id"))).collect()]


def test_key_without_separator_may_collide(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "x string, y string")
    assert len(set(hexes(with_surrogate_key(df, ["x", "y"])))) == 1
    assert len(set(hexes(with_surrogate_key(df, ["x", "y"], separator="|")))) == 2


def test_key_of_nulls_is_key_of_empty_text(spark):
    df = spark.createDataFrame([(None, None)], "x string, y double")
    assert hexes(with_surrogate_key(df, ["x", "y"])) == ["d41d8cd98f00b204e9800998ecf8427e"]


def test_key_text_of_timestamps(spark):
    df = spark.sql("select timestamp '2023-09-05 19:05:00' as t, '7' as x")
    plain = spark.sql("select md5('72023-09-05 19:05:00') as k").first().k
    zoned = spark.sql("select md5('72023-09-05 19:05:00+00') as k").first().k
    assert hexes(with_surrogate_key(df, ["x", "t"])) == [plain]
    assert hexes(with_surrogate_key(df, ["x", "t"], timestamp_suffix="+00")) == [zoned]


def test_key_comes_first_and_needs_its_columns(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    assert with_surrogate_key(df, ["x"]).columns == ["unique_id", "x", "y"]
    with pytest.raises(ValueError, match="z"):
        with_surrogate_key(df, ["z"])
