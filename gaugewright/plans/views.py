"""Latest rows and the joined view."""

from pyspark.sql import functions as F

from gaugewright.operators.joins import same_key
from gaugewright.operators.latest import latest_by_key
from gaugewright.schemas import (
    LATEST_MEASUREMENTS_COLUMNS,
    LATEST_STATIONS_COLUMNS,
    MEASUREMENTS,
    STATIONS,
    TOPIC_KEYS,
)


# Output name and source of the joined view's columns, s. stations, m. measurements.
JOINED_COLUMNS = {
    "station_id": "s.rloiid",
    "station_notation": "s.notation",
    "station_name": "s.label",
    "river_name": "s.rivername",
    "town": "s.town",
    "latitude": "s.lat",
    "longitude": "s.long",
    "last_update": "m.datetime",
    "value": "m.value",
    "unit": "m.unit",
    "typical_range_low": "s.typicalrangelow",
    "typical_range_high": "s.typicalrangehigh",
}


def _tiebreak(df):
    """Present columns that order equal stamps; databases give their names in other cases."""
    return [c for name in ("sequence", "pk_id") for c in df.columns if c.lower() == name]


def latest_measurements(history, latest=latest_by_key, columns=None):
    """The last ingested row per measure; ``latest`` picks the form of the operator."""
    return latest(history, "id", "last_update", _tiebreak(history),
                  columns or LATEST_MEASUREMENTS_COLUMNS)


def latest_stations(history, latest=latest_by_key, columns=None):
    """The last ingested row per station."""
    return latest(history, "rloiid", "last_update", _tiebreak(history),
                  columns or LATEST_STATIONS_COLUMNS)


def join_current(stations, measurements):
    """Stations with their measure's current reading; ``last_update`` is the reading's time.

    A measure named by several stations gives a row for each.
    """
    s, m = stations.alias("s"), measurements.alias("m")
    return s.join(m, same_key(F.col("s.measures_id"), F.col("m.id"))).select(
        *[F.col(column).alias(name) for name, column in JOINED_COLUMNS.items()]
    )


def stations_measurements(stations, measurements, latest=latest_by_key):
    """The joined view over both histories; only the columns it shows are aggregated."""
    used = {side: [c[2:] for c in JOINED_COLUMNS.values() if c.startswith(side)]
            for side in ("s.", "m.")}
    return join_current(
        latest_stations(stations, latest, used["s."] + ["measures_id"]),
        latest_measurements(measurements, latest, ["id"] + used["m."]),
    )


def register_views(stations, measurements):
    """Temporary views ``latest_stations``, ``latest_measurements``, ``stationsmeasurements``.

    They are plans, not copies: each query sees the history as it is then.
    """
    latest_stations(stations).createOrReplaceTempView("latest_stations")
    latest_measurements(measurements).createOrReplaceTempView("latest_measurements")
    stations_measurements(stations, measurements).createOrReplaceTempView("stationsmeasurements")


def create_views(spark, database):
    """The three views as lasting SQL views over the database's history tables."""
    columns = {STATIONS: LATEST_STATIONS_COLUMNS, MEASUREMENTS: LATEST_MEASUREMENTS_COLUMNS}
    for topic, names in columns.items():
        key = TOPIC_KEYS[topic]
        rest = [n for n in names if n != key]
        shown = ", ".join(n if n == key else f"latest.{n}" for n in names)
        spark.sql(f"""
            CREATE OR REPLACE VIEW {database}.latest_{topic} AS
            SELECT {shown} FROM (
                SELECT {key}, max_by(struct({", ".join(rest)}),
                                     struct(last_update, sequence, pk_id)) AS latest
                FROM {database}.{topic}
                WHERE {key} IS NOT NULL AND last_update IS NOT NULL
                GROUP BY {key})
        """)
    shown = ", ".join(f"{column} AS {name}" for name, column in JOINED_COLUMNS.items())
    spark.sql(f"""
        CREATE OR REPLACE VIEW {database}.stationsmeasurements AS
        SELECT {shown} FROM {database}.latest_stations s JOIN {database}.latest_measurements m
        ON s.measures_id = m.id AND xxhash64(s.measures_id) = xxhash64(m.id)
    """)


def refresh_latest(previous, added, topic, latest=latest_by_key):
    """The latest rows after new history came in, from the previous latest rows and the new
    rows only; the full history is not read again. Both have the history's columns."""
    rows = previous.unionByName(added.select(*previous.columns))
    return latest(rows, TOPIC_KEYS[topic], "last_update", _tiebreak(rows), previous.columns)
