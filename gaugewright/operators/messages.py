"""Flat rows to topic messages."""

from pyspark.sql import functions as F

from gaugewright.functions.text import message_json
from gaugewright.functions.times import stamp, utc_instant
from gaugewright.schemas import message_schema


def with_stamp(rows, fetched_at="fetched_at"):
    """Adds ``last_update``: the fetch time, advanced by the row's place in its document."""
    place = F.col("item_pos") * F.col("width")
    if "measure_pos" in rows.columns:
        place = place + F.col("measure_pos")
    return rows.withColumn("last_update", stamp(utc_instant(rows, fetched_at), place))


def to_messages(rows, topic, key="raw"):
    """``key, value`` messages; the key is the raw item, or another column such as the id.

    With many topic partitions prefer the station or measure id as key: it keeps the rows
    of one key in order and the topic small.
    """
    fields = message_schema(topic).names
    return rows.select(
        F.col(key).cast("string").alias("key"),
        message_json(F.struct(*fields)).alias("value"),
    )
