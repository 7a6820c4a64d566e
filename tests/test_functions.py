import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugewright.functions.colours import hex_to_rgb
from gaugewright.functions.numbers import nan_to_null, number_text, round_half_even
from gaugewright.functions.text import hashed_id, message_json
from gaugewright.functions.times import local_time_text, stamp, utc_instant, utc_wall_clock


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first()["c"]


def test_rounding_equals_numpy(spark):
    values = np.round(np.random.default_rng(7).uniform(-50, 50, 20_000), 3)
    values = np.concatenate([values, [0.125, 1.005, -0.125, 2.675, 1e12 + 0.005]])
    got = spark.createDataFrame(pd.DataFrame({"i": range(len(values)), "v": values})).select(
        "i", round_half_even(F.col("v")).alias("r")).orderBy("i").toPandas()["r"]
    assert (got.to_numpy() == pd.Series(values).round(2).to_numpy()).all()


def test_nan_to_null(spark):
    rows = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "v double").select(
        nan_to_null(F.col("v")).alias("v")).collect()
    assert [r["v"] for r in rows] == [1.5, None, None]


@pytest.mark.parametrize("value, text", [
    (1.0, "1"), (0.5, "0.5"), (0.25, "0.25"), (100.0, "100"), (-10.5, "-10.5"), (0.0, "0"),
    (12345678.9, "12345678.9"),
])
def test_number_text(spark, value, text):
    assert one(spark, number_text(F.lit(value))) == text


def test_number_text_of_what_has_no_digits(spark):
    assert one(spark, number_text(F.lit(float("inf")))) == "Infinity"
    assert one(spark, number_text(F.lit(None).cast("double"))) is None


@pytest.mark.parametrize("colour, rgb", [
    ("#05a300", [5, 163, 0]), ("#0033ff", [0, 51, 255]), ("#ff0000", [255, 0, 0]),
    ("0A0B0C", [10, 11, 12]),
])
def test_hex_to_rgb(spark, colour, rgb):
    assert one(spark, hex_to_rgb(F.lit(colour))) == rgb


@pytest.mark.parametrize("utc, local", [
    ("2024-07-01 12:00:00", "2024-07-01 14:00"),
    ("2024-03-31 00:59:59", "2024-03-31 01:59"),
    ("2024-03-31 01:00:00", "2024-03-31 03:00"),
    ("2024-10-27 00:30:00", "2024-10-27 02:30"),
    ("2024-10-27 01:30:00", "2024-10-27 02:30"),
])
def test_local_time(spark, utc, local):
    assert one(spark, local_time_text(F.to_timestamp_ntz(F.lit(utc)))) == local


def test_local_time_that_the_session_zone_skips(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        text = one(spark, local_time_text(F.to_timestamp_ntz(F.lit("2024-03-10 01:30:00"))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert text == "2024-03-10 02:30"


def test_local_time_in_another_pattern(spark):
    text = one(spark, local_time_text(F.to_timestamp_ntz(F.lit("2024-07-01 12:00:00")),
                                      "Europe/London", "dd.MM.yyyy HH:mm:ss"))
    assert text == "01.07.2024 13:00:00"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_utc_wall_clock_under_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # In New York both of these are 01:30 on the day the clocks go back.
        df = spark.range(2).select(F.timestamp_seconds(F.lit(1730611800) + F.col("id") * 3600)
                                   .alias("t"))
        got = {r["t"] for r in df.select(utc_wall_clock(df, "t").cast("string").alias("t"))
               .collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == {"2024-11-03 05:30:00", "2024-11-03 06:30:00"}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_utc_instant_under_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in New York on this day.
        df = spark.range(1).select(
            F.to_timestamp_ntz(F.lit("2024-03-10 02:30:00.000007")).alias("t"))
        micros = df.select(F.unix_micros(utc_instant(df, "t")).alias("t")).first()["t"]
        back = df.select(utc_instant(df, "t").alias("t"))
        text = back.select(utc_wall_clock(back, "t").cast("string").alias("t")).first()["t"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert micros == 1710037800000007 and text == "2024-03-10 02:30:00.000007"


def test_stamps_of_later_rows_are_later(spark):
    base = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    rows = spark.range(3).select(stamp(base, F.col("id")).cast("string").alias("t")).collect()
    assert [r["t"] for r in rows] == [
        "2024-01-01 00:00:00", "2024-01-01 00:00:00.000001", "2024-01-01 00:00:00.000002"]


def test_message_json_writes_nulls_and_microseconds(spark):
    row = F.struct(F.lit("a").alias("id"), F.lit(None).cast("double").alias("value"),
                   F.to_timestamp(F.lit("2023-12-01 12:00:00.123456")).alias("t"))
    assert one(spark, message_json(row)) == (
        '{"id":"a","value":null,"t":"2023-12-01 12:00:00.123456"}')


def test_hashed_id_is_a_uuid(spark):
    import uuid
    text = one(spark, hashed_id(F.lit("stations"), F.lit("0"), F.lit("17")))
    assert str(uuid.UUID(text)) == text and uuid.UUID(text).version == 8
    assert text != one(spark, hashed_id(F.lit("stations"), F.lit("0"), F.lit("18")))
