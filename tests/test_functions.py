from __future__ import annotations

import datetime as dt

import pytest

from emporia import functions as fn


def test_clean_text_strips_spaces_only_and_lowercases(spark):
    df = spark.createDataFrame([("  Sao Paulo  ",), (" RJ\t",), (None,)], "s string")
    out = [r[0] for r in df.select(fn.clean_text("s")).collect()]
    assert out == ["sao paulo", "rj\t", None]


def test_strip_spaces_keeps_case_and_tabs(spark):
    df = spark.createDataFrame([("  Good Product ",), ("text\t",), ("\nline ",)], "s string")
    out = [r[0] for r in df.select(fn.strip_spaces("s")).collect()]
    assert out == ["Good Product", "text\t", "\nline"]


def test_safe_int_nulls_bad_scores(spark):
    df = spark.createDataFrame([("5",), (" 4 ",), ("abc",), ("1.5",), (None,)], "s string")
    out = [r[0] for r in df.select(fn.safe_int("s")).collect()]
    assert out == [5, 4, None, None, None]


def test_to_double_raises_on_text_under_ansi(spark):
    df = spark.createDataFrame([("12.5",), ("abc",)], "s string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(fn.to_double("s")).collect()


def test_wall_clock_ts_parses_text_and_passes_timestamps(spark):
    df = spark.createDataFrame([("2017-10-02 10:56:33",), (None,)], "s string")
    out = [r[0] for r in df.select(fn.wall_clock_ts("s").alias("t")).collect()]
    assert out == [dt.datetime(2017, 10, 2, 10, 56, 33), None]
    assert df.select(fn.wall_clock_ts("s").alias("t")).schema["t"].dataType.typeName() == "timestamp_ntz"
    bad = spark.createDataFrame([("not a time",)], "s string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.select(fn.wall_clock_ts("s")).collect()


def test_delivery_days_calendar_difference(spark):
    df = spark.createDataFrame(
        [
            ("2018-01-01 23:59:00", "2018-01-02 00:01:00"),  # next calendar day
            ("2018-01-10 08:00:00", "2018-01-05 08:00:00"),  # delivered before purchase
            ("2018-01-10 08:00:00", None),  # not delivered
        ],
        "created string, delivered string",
    )
    out = df.select(
        fn.delivery_days(fn.wall_clock_ts("delivered"), fn.wall_clock_ts("created")).alias("d")
    ).collect()
    assert [r.d for r in out] == [1, -5, None]


def test_equals_flag_is_never_null(spark):
    df = spark.createDataFrame([("delivered",), ("shipped",), (None,)], "s string")
    out = [r[0] for r in df.select(fn.equals_flag("s", "delivered")).collect()]
    assert out == [True, False, False]


def test_line_total_null_propagates(spark):
    df = spark.createDataFrame([(10.0, 2.5), (10.0, None)], "p double, f double")
    assert [r[0] for r in df.select(fn.line_total("p", "f")).collect()] == [12.5, None]


def test_zip_key_pads_short_and_keeps_long(spark):
    df = spark.createDataFrame([("1151",), ("01151",), (" 9790 ",), ("123456",), (None,), ("",), ("  ",), ("ab",)], "z string")
    out = [r[0] for r in df.select(fn.zip_key("z")).collect()]
    assert out == ["01151", "01151", "09790", "123456", None, "", "  ", "ab"]
    ints = spark.createDataFrame([(1151,)], "z int")
    assert ints.select(fn.zip_key("z")).first()[0] == "01151"
