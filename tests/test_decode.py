import datetime

import pytest
from pyspark.sql import functions as F

from gaugewright.operators.decode import accepted, decode, message_errors, rejects
from gaugewright.schemas import MEASUREMENTS, STATIONS, WIDE_COLUMN, message_schema
from tests.conftest import plan

FULL = ('{"id":"a","datetime":"2023-12-01T12:00:00Z","value":0.123,"unit":"m",'
        '"last_update":"2023-12-01 12:00:00.123456"}')


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string").select(
        F.col("value").cast("binary"))


def only(spark, text):
    [row] = accepted(decode(messages(spark, text), MEASUREMENTS)).collect()
    return row


def test_full_message(spark):
    row = only(spark, FULL)
    assert row["id"] == "a" and row["unit"] == "m"
    assert row["value"] == 0.12300000339746475  # float on the wire, double in the table
    assert row["datetime"] == datetime.datetime(2023, 12, 1, 12)
    assert row["last_update"] == datetime.datetime(2023, 12, 1, 12, 0, 0, 123456)


@pytest.mark.parametrize("value", ['"0.5"', "[0.1,0.2]"])
def test_unreadable_number_becomes_null(spark, value):
    row = only(spark, f'{{"id":"a","value":{value}}}')
    assert row["value"] is None and row["id"] == "a"


def test_nested_value_in_text_field_is_its_json(spark):
    row = only(spark, '{"id":["a","b"],"unit":{"x":1}}')
    assert row["id"] == '["a","b"]' and row["unit"] == '{"x":1}'


def test_unreadable_time_becomes_null(spark):
    row = only(spark, '{"id":"a","datetime":"nope","value":2}')
    assert row["datetime"] is None and row["value"] == 2.0


@pytest.mark.parametrize("text, reason", [
    ('{"id":"a", oops', "malformed message"),
    ('[{"id":"z1"},{"id":"z2"}]', "malformed message"),
    ("{}", "no known field"),
    ('{"ID":"A","Value":3}', "no known field"),
    ('{"value":[1,2]}', "no readable field"),
    ('5', "malformed message"),
    (None, "empty message"),
    ("", "empty message"),
])
def test_rejects_keep_the_text(spark, text, reason):
    decoded = decode(messages(spark, text), MEASUREMENTS)
    assert accepted(decoded).count() == 0
    [row] = rejects(decoded).collect()
    assert (row["reject_reason"], row["reject_value"]) == (reason, text)


def test_zone_less_time_is_utc_in_any_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        seconds = accepted(decode(messages(spark, FULL), MEASUREMENTS)).select(
            F.unix_seconds("last_update").alias("s"), F.unix_seconds("datetime").alias("d")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seconds["s"] == seconds["d"] == 1701432000


def test_wide_column_layout(spark):
    rows = accepted(decode(messages(spark, FULL), MEASUREMENTS, WIDE_COLUMN))
    assert rows.columns == ["uuid", "id", "stationreference", "datetime", "value", "unit"]
    assert rows.first()["datetime"] == "2023-12-01T12:00:00Z"
    assert dict(rows.dtypes)["value"] == "float"


def test_hashed_id_repeats_and_random_id_does_not(spark):
    def ids(kind):
        return accepted(decode(messages(spark, FULL, FULL), MEASUREMENTS, WIDE_COLUMN, kind))

    assert len({r["uuid"] for r in ids("hashed").collect()}) == 1
    assert len({r["uuid"] for r in ids("random").collect()}) == 2


def test_id_from_topic_position(spark):
    placed = spark.createDataFrame([(FULL, 0, 1), (FULL, 0, 2), (FULL, 1, 1)],
                                   "value string, partition int, offset long")
    rows = accepted(decode(placed, MEASUREMENTS)).collect()
    assert len({r["pk_id"] for r in rows}) == 3
    assert sorted(r["sequence"] for r in rows) == [1, 1, 2]


def test_unknown_topic_is_an_error(spark):
    with pytest.raises(ValueError, match="tides"):
        message_schema("tides")
    with pytest.raises(ValueError, match="tides"):
        decode(messages(spark, FULL), "tides")


def test_messages_are_parsed_once(spark):
    text = plan(accepted(decode(messages(spark, FULL), STATIONS)))
    generators = [line for line in text.splitlines() if "inline(array(from_json" in line]
    assert generators
    assert text.count("from_json") == len(generators)
    assert "PythonUDF" not in text
    # A filter parses only what has an unreadable field and no readable one, as its last resort.
    filters = [line for line in text.splitlines() if line.startswith("Condition") and "parse_json" in line]
    assert all(f.index("isnull(_corrupt_record") < f.index("parse_json") for f in filters)


def test_fields_that_were_lost_are_named(spark):
    found = message_errors(messages(
        spark, FULL, '{"id":"a","value":"0.5","datetime":"nope","unit":null}', '{"id":["a"],"value":[1]}', "broken", "{}"),
        MEASUREMENTS).select("field", "message").collect()
    assert sorted((r["field"], r["message"][:10]) for r in found) == [
        ("datetime", '{"id":"a",'), ("value", '{"id":"a",'), ("value", '{"id":["a"')]
