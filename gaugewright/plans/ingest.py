"""Documents to messages."""

from pyspark.sql import functions as F

from gaugewright.functions.text import message_json
from gaugewright.operators.enrich import enrich_stage_scale
from gaugewright.operators.messages import to_messages, with_stamp
from gaugewright.operators.unnest import (
    flat_measurement,
    flat_station,
    matching,
    measurement_items,
    station_items,
    unnest_measures,
    with_reading,
)
from gaugewright.schemas import MEASUREMENTS, STATIONS, message_schema

REJECTS_SUFFIX = "-rejects"


def _reason():
    """Why an item cannot give messages; NULL if it can."""
    return (
        F.when(F.col("bad").isNotNull(), F.col("bad"))
        .when(F.col("item.stageScale").isNull(), "no stage scale link")
        .when(~F.col("scale_found"), "stage scale not found")
        .when(F.col("item.measures").isNull(), "no list of measures")
    )


def station_rows(documents, stage_scale, strict=False):
    """Flat, stamped station rows, one per measure, with the raw item."""
    items = enrich_stage_scale(station_items(documents), stage_scale, strict=strict)
    found = items.where(F.col("scale_found") & F.col("item.measures").isNotNull())
    return with_stamp(flat_station(unnest_measures(found)))


def station_rejects(documents, stage_scale):
    """Items that give no rows because something is missing: ``reject_reason, raw``."""
    items = enrich_stage_scale(station_items(documents), stage_scale)
    flagged = items.select(_reason().alias("reject_reason"), "raw")
    return flagged.where(F.col("reject_reason").isNotNull())


def _output(rows, topic, key="raw"):
    """Rows to ``topic, key, value``; those with a ``reject_reason`` go to the rejects topic,
    keyed by their reason. ``key`` is the raw item or another column."""
    rejected = F.col("reject_reason").isNotNull()
    message = message_json(F.struct(*message_schema(topic).names))
    return rows.select(
        F.when(rejected, topic + REJECTS_SUFFIX).otherwise(topic).alias("topic"),
        F.when(rejected, F.col("reject_reason")).otherwise(F.col(key).cast("string")).alias("key"),
        F.when(rejected, F.col("raw")).otherwise(message).alias("value"),
    )


def station_output(documents, stage_scale, wanted=None, key="raw", strict=False):
    """Messages and rejects together, as ``topic, key, value``, from one pass over the
    documents. ``wanted`` selects items by raw attributes; ``strict`` fails the job on an item
    without a stage scale."""
    items = matching(station_items(documents), wanted or {})
    items = enrich_stage_scale(items, stage_scale, strict=strict)
    reason = _reason()
    measures = F.when(reason.isNull(), F.col("item.measures"))
    rows = items.select(
        *items.columns,
        reason.alias("reject_reason"),
        F.posexplode_outer(measures).alias("measure_pos", "measure"),
    ).where(F.col("reject_reason").isNotNull() | F.col("measure_pos").isNotNull())
    rows = rows.withColumn("measures_id", F.col("measure.`@id`")).drop("measure")
    return _output(with_stamp(flat_station(rows)), STATIONS, key)


def measurement_rows(documents):
    """Flat, stamped measurement rows of the items that have a reading."""
    return with_stamp(flat_measurement(with_reading(measurement_items(documents))))


def measurement_rejects(documents):
    """Items that could not be read: ``reject_reason, raw``."""
    items = measurement_items(documents).where(F.col("bad").isNotNull())
    return items.select(F.col("bad").alias("reject_reason"), "raw")


def station_messages(documents, stage_scale, key="raw", strict=False):
    return to_messages(station_rows(documents, stage_scale, strict), STATIONS, key)


def measurement_messages(documents, key="raw"):
    return to_messages(measurement_rows(documents), MEASUREMENTS, key)


def measurement_output(documents, wanted=None, key="raw"):
    """Messages and rejects of measurement documents together, as for stations."""
    items = matching(measurement_items(documents), wanted or {})
    rows = items.where(F.col("bad").isNotNull() | F.col("item.latestReading").isNotNull())
    rows = rows.withColumn("reject_reason", F.col("bad"))
    return _output(with_stamp(flat_measurement(rows)), MEASUREMENTS, key)
