"""Fixed schemas: landed documents, topic messages, history tables and views."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Landed documents. Items are read as text first, so a message key can hold the whole raw
# item, with fields the item schemas below do not name. The providers' field names.
DOCUMENT = "items ARRAY<STRING>"
CORRUPT = "_corrupt_record"
STATION_ITEM = (
    "RLOIid STRING, label STRING, notation STRING, riverName STRING, stageScale STRING, "
    "town STRING, lat DOUBLE, long DOUBLE, measures ARRAY<STRUCT<`@id`: STRING>>"
)
MEASUREMENT_ITEM = (
    "`@id` STRING, stationReference STRING, unit STRING, "
    "latestReading STRUCT<dateTime: STRING, value DOUBLE>"
)
STAGE_SCALE_DOCUMENT = (
    "url STRING, items STRUCT<typicalRangeHigh: DOUBLE, typicalRangeLow: DOUBLE>"
)
# The same before its numbers are read, each by itself.
STAGE_SCALE_TEXT = "url STRING, items STRING"

STATIONS = "stations"
MEASUREMENTS = "measurements"
RELATIONAL = "relational"
WIDE_COLUMN = "wide_column"
TOPIC_KEYS = {STATIONS: "rloiid", MEASUREMENTS: "id"}

# The fields of each topic, per sink layout.
_MESSAGES = {
    (STATIONS, RELATIONAL): (
        "rloiid STRING, label STRING, measures_id STRING, notation STRING, rivername STRING, "
        "typicalrangehigh FLOAT, typicalrangelow FLOAT, town STRING, lat FLOAT, long FLOAT, "
        "last_update TIMESTAMP"
    ),
    (MEASUREMENTS, RELATIONAL): (
        "id STRING, stationreference STRING, datetime TIMESTAMP, value FLOAT, unit STRING, "
        "last_update TIMESTAMP"
    ),
    (STATIONS, WIDE_COLUMN): (
        "rloiid STRING, label STRING, measures_id STRING, notation STRING, rivername STRING, "
        "typicalrangehigh FLOAT, typicalrangelow FLOAT, town STRING, lat FLOAT, long FLOAT"
    ),
    (MEASUREMENTS, WIDE_COLUMN): (
        "id STRING, stationreference STRING, datetime STRING, value FLOAT, unit STRING"
    ),
}

# Columns of the history tables: message fields with FLOAT widened to DOUBLE, after the
# row's id. ``sequence`` is the topic offset where the source has one.
_TABLES = {
    (STATIONS, RELATIONAL): (
        "pk_id STRING, rloiid STRING, label STRING, measures_id STRING, notation STRING, "
        "rivername STRING, typicalrangehigh DOUBLE, typicalrangelow DOUBLE, town STRING, "
        "lat DOUBLE, long DOUBLE, last_update TIMESTAMP, sequence BIGINT"
    ),
    (MEASUREMENTS, RELATIONAL): (
        "pk_id STRING, id STRING, stationreference STRING, datetime TIMESTAMP, value DOUBLE, "
        "unit STRING, last_update TIMESTAMP, sequence BIGINT"
    ),
    (STATIONS, WIDE_COLUMN): (
        "uuid STRING, rloiid STRING, label STRING, measures_id STRING, notation STRING, "
        "rivername STRING, typicalrangehigh FLOAT, typicalrangelow FLOAT, town STRING, "
        "lat FLOAT, long FLOAT"
    ),
    (MEASUREMENTS, WIDE_COLUMN): (
        "uuid STRING, id STRING, stationreference STRING, datetime STRING, value FLOAT, "
        "unit STRING"
    ),
}

# The views' columns.
LATEST_MEASUREMENTS_COLUMNS = ["id", "last_update", "stationreference", "datetime", "value", "unit"]
LATEST_STATIONS_COLUMNS = [
    "pk_id", "rloiid", "label", "measures_id", "notation", "rivername",
    "typicalrangehigh", "typicalrangelow", "town", "lat", "long", "last_update",
]


def _lookup(table, kind, topic, layout):
    ddl = table.get((topic, layout))
    if ddl is None:
        known = ", ".join(sorted(f"{t}/{l}" for t, l in table))
        raise ValueError(f"no {kind} for topic {topic!r} in layout {layout!r}; known: {known}")
    return StructType.fromDDL(ddl)


def message_schema(topic, layout=RELATIONAL) -> StructType:
    """The fields of a topic's messages; an unknown topic is an error."""
    return _lookup(_MESSAGES, "message schema", topic, layout)


def table_schema(topic, layout=RELATIONAL) -> StructType:
    """The columns of the table that holds a topic."""
    return _lookup(_TABLES, "table schema", topic, layout)


def create_tables(spark, database, location=None, layout=RELATIONAL):
    """Create the two tables of a layout as Parquet tables; those with an ingestion stamp
    are split by its date."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for topic in (STATIONS, MEASUREMENTS):
        columns, split = _TABLES[(topic, layout)], ""
        if "last_update" in message_schema(topic, layout).names:
            columns, split = f"{columns}, ingest_date DATE", " PARTITIONED BY (ingest_date)"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{topic} ({columns}) USING parquet{split}")
