"""The test tables seen as gauge data.

``events`` stand for measurements, ``orders`` for the station history (with real ties),
``customer`` for listed stations and ``supplier`` for stage-scale documents. Every view is
a projection: documents are built row by row, so nothing is gathered. What documents are made of is dealt out first:
a table of few row groups would otherwise be built, parsed and sent by as few tasks.
"""

from pyspark.sql import functions as F

from gaugewright.operators.enrich import stage_scale_table
from gaugewright.sources.documents import parse_documents, parse_stage_scales

METER = "http://qudt.org/1.1/vocab/unit#Meter"
# A Monday, 03:00 UTC.
STATIONS_FETCHED = "2024-01-01 03:00:00"
# Fewer tasks than this are not worth a cluster, and before its executors have come it counts none.
LEAST_TASKS = 4
# Tasks per core, so that an uneven one does not hold up the rest.
TASKS_PER_CORE = 2


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cores(spark):
    """The cores that Spark knows of."""
    return max(LEAST_TASKS, spark.sparkContext.defaultParallelism)


def _dealt(spark, sf_dir, name, *columns):
    """Columns of a table, its rows dealt out evenly to all cores, whatever files, row groups and keys they come in."""
    return table(spark, sf_dir, name).select(*columns).repartition(TASKS_PER_CORE * cores(spark))


def _unit():
    return (
        F.when(F.col("event_type") == "purchase", METER)
        .when(F.col("event_type") == "signup", "see " + METER)
        .otherwise("mASD")
    )


def measurement_history(spark, sf_dir):
    """Ingested at the event's time; the reading itself is of the full hour before."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("pk_id"),
        F.concat(F.lit("measure/"), "user_id").alias("id"),
        F.col("user_id").cast("string").alias("stationreference"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("datetime"),
        "value",
        _unit().alias("unit"),
        F.col("ts").alias("last_update"),
        F.col("event_id").alias("sequence"),
    )


def station_history(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("pk_id"),
        F.col("o_custkey").cast("string").alias("rloiid"),
        F.concat(F.lit("Station "), "o_custkey").alias("label"),
        F.concat(F.lit("measure/"), "o_custkey").alias("measures_id"),
        F.concat(F.lit("N"), "o_orderkey").alias("notation"),
        F.col("o_orderstatus").alias("rivername"),
        (F.col("o_totalprice") / 4000.0).alias("typicalrangehigh"),
        (F.col("o_totalprice") / 20000.0).alias("typicalrangelow"),
        F.col("o_orderpriority").alias("town"),
        (F.lit(50.0) + (F.col("o_orderkey") % 800) / 100.0).alias("lat"),
        (F.lit(-5.0) + (F.col("o_orderkey") % 500) / 100.0).alias("long"),
        F.col("o_orderdate").alias("last_update"),
        F.col("o_orderkey").alias("sequence"),
    )


def measurement_document_texts(spark, sf_dir):
    """One document per event with two items, the second without a reading; an ``error``
    event has none either."""
    reading = F.when(
        F.col("event_type") != "error",
        F.struct(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("dateTime"),
            F.col("value"),
        ),
    )

    def item(prefix, latest):
        return F.struct(
            F.concat(F.lit(prefix), "user_id").alias("@id"),
            F.col("user_id").cast("string").alias("stationReference"),
            F.col("event_type").alias("notes"),
            _unit().alias("unit"),
            latest.alias("latestReading"),
        )

    nothing = F.when(F.lit(False), reading)
    items = F.array(item("measure/", reading), item("spare/", nothing))
    events = _dealt(spark, sf_dir, "events", "ts", "user_id", "event_type", "value")
    return events.select(
        F.to_json(F.struct(items.alias("items"))).alias("document"),
        F.col("ts").alias("fetched_at"),
    )


def _with_fetch_time(fetched_at):
    """The document's text with the time of its fetch as one more field."""
    return F.concat(
        F.expr("left(document, length(document) - 1)"),
        F.lit(',"fetched":"'), fetched_at.cast("string"), F.lit('"}'),
    ).alias("value")


def land_measurement_documents(spark, sf_dir, path, files=None):
    """Write the documents as files, one per line, each with the time of its fetch."""
    lines = measurement_document_texts(spark, sf_dir).select(_with_fetch_time(F.col("fetched_at")))
    (lines.repartition(files, F.xxhash64("value")) if files else lines).write.text(path)


def measurement_documents(spark, sf_dir):
    return parse_documents(measurement_document_texts(spark, sf_dir))


def station_document_texts(spark, sf_dir):
    """One document per customer with two items: a station with none, one or two measures,
    and a station without a list of measures."""
    def measure(suffix):
        return F.struct(F.concat(F.lit("measure/"), "c_custkey", F.lit(suffix)).alias("@id"))

    count = (F.col("c_custkey") % 3).cast("int")
    measures = F.slice(F.array(measure("/backup"), measure("")), F.lit(3) - count, count)

    def item(prefix, listed):
        return F.struct(
            F.concat(F.lit(prefix), "c_custkey").alias("RLOIid"),
            F.col("c_name").alias("label"),
            F.col("c_mktsegment").alias("notation"),
            F.lit("Active").alias("status"),
            F.concat(F.lit("stageScale/"), "c_nationkey").alias("stageScale"),
            F.concat(F.lit("Town "), "c_nationkey").alias("town"),
            (F.lit(50.0) + F.col("c_nationkey") / 4.0).alias("lat"),
            (F.lit(-5.0) + F.col("c_nationkey") / 8.0).alias("long"),
            listed.alias("measures"),
        )

    items = F.array(item("", measures), item("spare-", F.when(F.lit(False), measures)))
    customers = _dealt(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return customers.select(
        F.to_json(F.struct(items.alias("items"))).alias("document"),
        F.to_timestamp_ntz(F.lit(STATIONS_FETCHED)).alias("fetched_at"),
    )


def station_lines(spark, sf_dir):
    """``nation, value``: station documents one per line, with the time of their fetch."""
    nation = F.get_json_object("document", "$.items[0].stageScale")
    return station_document_texts(spark, sf_dir).select(
        F.regexp_extract(nation, "([0-9]+)$", 1).cast("int").alias("nation"),
        _with_fetch_time(F.col("fetched_at")))


def station_documents(spark, sf_dir):
    return parse_documents(station_document_texts(spark, sf_dir))


def _stage_scale_texts(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    scale = F.struct(
        F.concat(F.lit("stageScale/"), "s_nationkey").alias("url"),
        F.struct(
            F.abs("s_acctbal").alias("typicalRangeHigh"),
            (F.col("s_nationkey") + 0.5).alias("typicalRangeLow"),
        ).alias("items"),
    )
    return supplier.select(
        F.to_json(scale).alias("document"), F.col("s_suppkey").alias("fetched_at"),
        F.col("s_nationkey").alias("nation"),
    )


def stage_scale_lines(spark, sf_dir):
    """``nation, value``: stage-scale documents one per line, with the time of their fetch."""
    fetched = F.timestamp_seconds(F.col("fetched_at"))
    return _stage_scale_texts(spark, sf_dir).select("nation", _with_fetch_time(fetched))


def stage_scale_documents(spark, sf_dir):
    """One document per supplier; the suppliers of a nation are fetches of one URL."""
    return parse_stage_scales(_stage_scale_texts(spark, sf_dir).drop("nation"))


def stage_scales(spark, sf_dir):
    return stage_scale_table(stage_scale_documents(spark, sf_dir))
