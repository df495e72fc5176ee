import datetime as dt

from pyspark.sql import functions as F

from quarry.functions.text import capitalize, regex_rules, truncate_width
from quarry.functions.times import (cutoff_parts, epoch_ms_to_text, epoch_ms_to_timestamp,
                                    epoch_ms_to_timestamp_exact, epoch_millis_ntz)


def test_capitalize_folds_only_eleven_letters(spark):
    df = spark.createDataFrame([("áéíóúçõâãôê àüñè straße",)], "t string")
    out = capitalize(df, ["t"]).first().t
    assert out == "AEIOUCOAAOE ÀÜÑÈ STRASSE"


def test_capitalize_changes_number_to_string(spark):
    df = spark.createDataFrame([(12,)], "n int")
    out = capitalize(df, ["n"])
    assert out.schema["n"].dataType.simpleString() == "string"


def test_regex_rules_in_sequence_with_groups(spark):
    df = spark.createDataFrame([("1-URGENT job 1-URGENT",)], "t string")
    rules = [{"field": "t", "pattern": r"(\d)-(\w+)", "replacement": "$2/$1"},
             {"field": "t", "pattern": "/", "replacement": "#"}]
    assert regex_rules(df, rules).first().t == "URGENT#1 job URGENT#1"


def test_truncate_width_counts_characters(spark):
    df = spark.createDataFrame([("ÀÉÎÕÜ-long",)], "t string")
    assert truncate_width(df, {"t": 5}).first().t == "ÀÉÎÕÜ"


def test_epoch_conversion_truncates_toward_zero(spark):
    df = spark.createDataFrame([(-1500,), (1500,), (1704067207179,)], "ms bigint")
    out = df.select(epoch_ms_to_text(F.col("ms")).alias("t"),
                    epoch_ms_to_timestamp_exact(F.col("ms")).cast("timestamp_ntz").alias("e"),
                    epoch_ms_to_timestamp(F.col("ms")).cast("timestamp_ntz").alias("p")).collect()
    assert [r.t for r in out] == ["1969-12-31 23:59:59", "1970-01-01 00:00:01", "2024-01-01 00:00:07"]
    assert out[2].p == dt.datetime(2024, 1, 1, 0, 0, 7)
    assert out[2].e == dt.datetime(2024, 1, 1, 0, 0, 7, 179000)


def test_epoch_millis_of_ntz(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),)], "ts timestamp_ntz")
    assert df.select(epoch_millis_ntz(F.col("ts")).alias("m")).first().m == 1704067207179


def test_cutoff_parts_zero_padded():
    assert cutoff_parts(dt.date(2022, 3, 1), 1) == ("2022", "02", "28")
    assert cutoff_parts(dt.date(2024, 1, 2), 2) == ("2023", "12", "31")


def test_epoch_millis_ntz_ignores_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 7, 1, 12, 0, 0, 500000),), (dt.datetime(2024, 1, 1),)],
                               "ts timestamp_ntz")
    expect = [1719835200500, 1704067200000]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [r.m for r in df.select(epoch_millis_ntz(F.col("ts")).alias("m")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == expect


def test_parity_epoch_conversion_picks_wrong_instant_in_repeated_hour(spark):
    # 2022-11-06 06:00Z is 01:00 EST, the second 01:00 of that night in New York.
    ms = 1667714400000
    df = spark.createDataFrame([(ms,)], "ms bigint")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = df.select(F.unix_millis(epoch_ms_to_timestamp(F.col("ms"))).alias("parity"),
                      F.unix_millis(epoch_ms_to_timestamp_exact(F.col("ms"))).alias("exact")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r.exact == ms
    assert r.parity == ms - 3600 * 1000  # the text round trip lands on the first 01:00 (EDT)
    utc = df.select(F.unix_millis(epoch_ms_to_timestamp(F.col("ms"))).alias("p")).first().p
    assert utc == ms


def test_capitalize_on_array_fails(spark):
    import pytest

    df = spark.createDataFrame([(["a"],)], "xs array<string>")
    with pytest.raises(Exception):
        capitalize(df, ["xs"]).collect()
