"""Batch queries."""

from functools import partial

from pyspark.sql import Window, functions as F

from gaugewright.functions.colours import hex_to_rgb, range_colour
from gaugewright.functions.numbers import round_half_even
from gaugewright.functions.times import utc_date, utc_instant, utc_wall_clock
from gaugewright.operators.decode import accepted, decode, expand, message_errors, parse, rejects
from gaugewright.operators.enrich import enrich_stage_scale
from gaugewright.operators.latest import (
    distinct_on,
    grouped_max,
    join_on_max,
    latest_by_key,
    latest_by_key_two_pass,
)
from gaugewright.operators.present import (
    add_position,
    add_tooltip,
    classify,
    relabel_units,
    round_columns,
    show_local_time,
)
from gaugewright.operators.unnest import (
    flat_measurement,
    matching,
    measurement_items,
    station_items,
    unnest_measures,
    with_reading,
)
from gaugewright.plans.current import compact_current, current_rows, two_pass_by_date, write_snapshot
from gaugewright.plans.ingest import (
    REJECTS_SUFFIX,
    measurement_messages,
    measurement_output,
    measurement_rows,
    station_messages,
    station_output,
    station_rejects,
    station_rows,
)
from gaugewright.plans.maintained import JoinedView
from gaugewright.plans.status import map_rows, present, station_status
from gaugewright.plans.views import (
    create_views,
    join_current,
    latest_measurements,
    latest_stations,
    refresh_latest,
    register_views,
    stations_measurements,
)
from gaugewright.registry.fixtures import (
    land_measurement_documents,
    measurement_document_texts,
    measurement_documents,
    measurement_history,
    stage_scales,
    station_documents,
    station_history,
    table,
)
from gaugewright.schemas import MEASUREMENTS, STATIONS, WIDE_COLUMN, create_tables
from gaugewright.session import RUNTIME_FILTER, SCAN_THRESHOLD, work_database, work_path
from gaugewright.sinks.history import HistorySink, TableSink, compact_history, rewrite_by_date
from gaugewright.sources.documents import parse_documents, read_documents, read_items
from gaugewright.sources.history import read_dated, read_history
from gaugewright.sources.topics import FileTopics

REFRESH_FROM = "2024-01-16 00:00:00"


def _zone_less(df, *columns):
    return df.withColumns({c: utc_wall_clock(df, c) for c in columns})


def _joined(spark, sf_dir):
    return stations_measurements(
        station_history(spark, sf_dir), measurement_history(spark, sf_dir)
    )


def _with_range(spark, sf_dir):
    """Readings beside a range, as the joined view names them."""
    return measurement_history(spark, sf_dir).select(
        "sequence", "value", "unit", "last_update",
        (F.col("sequence") % 40 + 0.125).alias("typical_range_low"),
        (F.col("sequence") % 90 + 0.375).alias("typical_range_high"),
    )


# Whole plans ---------------------------------------------------------------------------

def status(spark, sf_dir):
    """By the form that batch jobs use: no sort of the whole history."""
    return station_status(
        station_history(spark, sf_dir), measurement_history(spark, sf_dir),
        latest=latest_by_key_two_pass,
    )


def status_one_pass(spark, sf_dir):
    """By the lazy form, as views and streams use it."""
    return station_status(station_history(spark, sf_dir), measurement_history(spark, sf_dir))


def status_missing(spark, sf_dir):
    """Readings and ranges that are NULL or NaN, through the whole presentation."""
    measurements = measurement_history(spark, sf_dir)
    stations = station_history(spark, sf_dir)
    return station_status(
        stations.withColumns({
            "typicalrangelow": _with_gaps("typicalrangelow", "sequence", 5),
            "typicalrangehigh": _with_gaps("typicalrangehigh", "sequence", 7)}),
        measurements.withColumn("value", _with_gaps("value", "sequence", 4)),
    )


def _with_gaps(column, number, every):
    """NULL in every n-th row, NaN in the row after."""
    place = F.col(number) % every
    return F.when(place == 1, float("nan")).when(place != 0, F.col(column))


def documents_to_status(spark, sf_dir):
    """Documents to messages to history rows to status, without a topic between."""
    stations = station_messages(station_documents(spark, sf_dir), stage_scales(spark, sf_dir))
    measurements = measurement_messages(measurement_documents(spark, sf_dir))
    return station_status(
        accepted(decode(stations, STATIONS)), accepted(decode(measurements, MEASUREMENTS))
    )


def _history_sinks(spark, sf_dir, base):
    """Sinks of both topics, with all stations written."""
    sinks = {topic: HistorySink(f"{base}/{topic}", topic) for topic in (STATIONS, MEASUREMENTS)}
    stations = station_messages(station_documents(spark, sf_dir), stage_scales(spark, sf_dir))
    sinks[STATIONS](stations, "load", 0)
    return sinks


def _measurement_batches(spark, sf_dir):
    """Measurement messages in three batches. Every fifth document comes late, in the last batch,
    whenever it was fetched."""
    documents = measurement_documents(spark, sf_dir)
    since = F.to_timestamp_ntz(F.lit(REFRESH_FROM))
    late = F.pmod(F.hash("fetched_at"), F.lit(5)) == 0
    early = F.col("fetched_at") < since
    for wanted in (early & ~late, ~early & ~late, late):
        yield measurement_messages(documents.where(wanted))


def status_from_snapshot(spark, sf_dir):
    """Status from a snapshot of a part of the history and the epochs since, which hold rows
    stamped before the snapshot's."""
    base = work_path(spark, "snapshot")
    sinks = _history_sinks(spark, sf_dir, base)
    first, *later = _measurement_batches(spark, sf_dir)
    sinks[MEASUREMENTS](first, "load", 0)
    for topic, sink in sinks.items():
        write_snapshot(spark, sink.path, topic, f"{base}/snapshot/{topic}")
    for epoch, messages in enumerate(later, 1):
        sinks[MEASUREMENTS](messages, "load", epoch)
    return map_rows(join_current(*[
        current_rows(spark, sink.path, topic, f"{base}/snapshot/{topic}", two_pass_by_date)
        for topic, sink in sinks.items()
    ]))


def status_incremental(spark, sf_dir):
    """Status from the joined view after four refreshes, with a base between. Stations and measures change in each: a
    third of the stations come with every refresh, and with the second a third of them under another measure for a time."""
    base = work_path(spark, "incremental")
    histories = {topic: f"{base}/{topic}" for topic in (STATIONS, MEASUREMENTS)}
    sinks = {topic: HistorySink(path, topic) for topic, path in histories.items()}
    view = JoinedView(spark, histories, f"{base}/view", buckets=8, compact_every=3)
    stations = station_messages(station_documents(spark, sf_dir), stage_scales(spark, sf_dir))
    # Written once: each epoch takes its part of them, and its part of those that are elsewhere.
    stations.write.parquet(f"{base}/messages")
    stations = spark.read.parquet(f"{base}/messages")
    part = F.pmod(F.xxhash64(F.get_json_object("value", "$.rloiid")), F.lit(3))
    # Stamped long before the rest, whatever epoch it comes in.
    elsewhere = stations.select("key", F.regexp_replace(
        F.regexp_replace("value", '"last_update":"2024', '"last_update":"2020'),
        '"measures_id":"measure/[^"]*"', '"measures_id":"measure/1"').alias("value"))
    for epoch, messages in enumerate(_measurement_batches(spark, sf_dir)):
        moved = elsewhere.where(part == (epoch + 1) % 3) if epoch < 2 else elsewhere.where(part < 0)
        sinks[STATIONS](stations.where(part == epoch).unionByName(moved), "load", epoch)
        sinks[MEASUREMENTS](messages, "load", epoch)
        view.refresh()
    sinks[STATIONS](elsewhere, "load", 3)
    view.refresh()
    return map_rows(view.read())


def history_compacted(spark, sf_dir):
    """Status from a compacted generation and two epochs written after it."""
    base = work_path(spark, "compacted")
    sinks = _history_sinks(spark, sf_dir, base)
    first, *later = _measurement_batches(spark, sf_dir)
    sinks[MEASUREMENTS](first, "load", 0)
    for topic, sink in sinks.items():
        compact_history(spark, sink.path, topic)
    for epoch, messages in enumerate(later, 1):
        sinks[MEASUREMENTS](messages, "load", epoch)
    return map_rows(join_current(*[
        current_rows(spark, sink.path, topic, latest=two_pass_by_date)
        for topic, sink in sinks.items()
    ]))


def status_clustered(spark, sf_dir):
    """Status from two compactions that keep the latest rows in buckets, and an epoch written after them. The last epochs
    hold rows stamped before the kept ones."""
    base = work_path(spark, "clustered")
    sinks = _history_sinks(spark, sf_dir, base)
    for epoch, messages in enumerate(_measurement_batches(spark, sf_dir)):
        sinks[MEASUREMENTS](messages, "load", epoch)
        if epoch < 2:
            for topic, sink in sinks.items():
                compact_current(spark, sink.path, topic, buckets=8, drop=True)
    return map_rows(join_current(*[current_rows(spark, sink.path, topic) for topic, sink in sinks.items()]))


# Sources and ingest --------------------------------------------------------------------

def landed_documents(spark, sf_dir):
    """Documents written as files, one per line, and read back as a landing folder."""
    path = work_path(spark, "landing")
    land_measurement_documents(spark, sf_dir, path)
    documents = read_documents(spark, path, multi_line=False, fetched_at="fetched")
    rows = measurement_rows(documents)
    return _zone_less(rows, "last_update").select(
        "id", "stationreference", "datetime", "value", "unit", "last_update"
    )


def document_rejects(spark, sf_dir):
    """Prose among the documents: kept whole, beside the messages of the good ones."""
    good = measurement_document_texts(spark, sf_dir)
    prose = table(spark, sf_dir, "documents").select(
        F.col("text").alias("document"), F.lit(None).cast("timestamp_ntz").alias("fetched_at")
    )
    return measurement_output(parse_documents(good.unionByName(prose), on_bad="keep"))


def item_rejects(spark, sf_dir):
    """Items that cannot be read, among good ones: text, a number, NULL, a reading of another
    type, and a broken line of an items file."""
    readings = table(spark, sf_dir, "events").select("event_id", F.to_json(F.struct(
        F.concat(F.lit("m"), "event_id").alias("@id"),
        F.struct(F.col("value")).alias("latestReading"))).alias("good"))
    bad = ['"junk"', F.col("event_id").cast("string"), "null", '{"@id":"odd","latestReading":"oops"}']
    texts = readings.select(
        F.concat(F.lit('{"items":['), F.col("good"), *[
            part for item in bad for part in (F.lit(","), F.lit(item) if isinstance(item, str) else item)
        ], F.lit("]}")).alias("document"),
        F.lit(None).cast("timestamp_ntz").alias("fetched_at"))
    path = work_path(spark, "item-lines")
    readings.select(F.concat(F.lit("{broken "), "event_id")).write.text(path)
    documents = measurement_output(parse_documents(texts, on_bad="keep"))
    lines = measurement_output(read_items(spark, path, on_bad="keep"))
    return documents.unionByName(lines).withColumn(
        "value", F.when(F.col("topic") == MEASUREMENTS, F.get_json_object("value", "$.id"))
        .otherwise(F.col("value")))


def _odd_items(spark, sf_dir):
    """Documents in which the reading's value, the unit or the id has another type, by the event's number."""
    kind = F.col("event_id") % 6
    value = (
        F.when(kind == 0, F.concat(F.lit("["), "value", F.lit(",1]")))
        .when(kind == 1, F.concat(F.lit('"'), "value", F.lit('"')))
        .when(kind == 2, F.concat(F.lit('{"x":'), "value", F.lit("}")))
        .when(kind == 3, F.lit("true")).otherwise(F.col("value").cast("string")))
    unit = F.when(kind == 0, F.lit('["m","n"]')).when(kind == 4, F.lit("null")).otherwise(F.lit('"m"'))
    name = F.when(kind == 2, F.col("event_id").cast("string")).otherwise(F.concat(F.lit('"m'), "event_id", F.lit('"')))
    return parse_documents(table(spark, sf_dir, "events").select(
        F.concat(F.lit('{"items":[{"@id":'), name, F.lit(',"unit":'), unit, F.lit(',"latestReading":{"value":'), value,
                 F.lit("}}]}")).alias("document"), F.col("ts").alias("fetched_at")))


def item_field_nulls(spark, sf_dir):
    """Items with a list, a text, an object or a truth value for a number: all go on, without that field."""
    rows = flat_measurement(with_reading(measurement_items(_odd_items(spark, sf_dir)).withColumn(
        "fields", F.array_join("odd", " "))))
    return rows.select("id", "value", "unit", "fields")


def message_field_nulls(spark, sf_dir):
    """The same items as messages: what a consumer's row lacks, by field."""
    messages = measurement_messages(_odd_items(spark, sf_dir)).select(
        F.regexp_replace("value", '"value":null', '"value":[0.5]').alias("value"))
    return message_errors(messages, MEASUREMENTS).select(
        "field", F.get_json_object("message", "$.id").alias("id"))


def landed_items(spark, sf_dir):
    """Items written one per line and read back; files split between any two lines."""
    path = work_path(spark, "items")
    items = measurement_items(measurement_documents(spark, sf_dir))
    items.select("raw").write.text(path)
    return flat_measurement(with_reading(measurement_items(read_items(spark, path)))).select(
        "raw", "id", "stationreference", "datetime", "value", "unit"
    )


def measurement_items_flat(spark, sf_dir):
    return flat_measurement(measurement_items(measurement_documents(spark, sf_dir))).select(
        "item_pos", "id", "stationreference", "datetime", "value", "unit"
    )


def not_null_filter(spark, sf_dir):
    items = with_reading(measurement_items(measurement_documents(spark, sf_dir)))
    return flat_measurement(items).select("id", "datetime", "value")


def matching_items(spark, sf_dir):
    items = matching(measurement_items(measurement_documents(spark, sf_dir)), {"notes": "click"})
    return items.select("item_pos", "raw")


def unnest_measures_rows(spark, sf_dir):
    return unnest_measures(station_items(station_documents(spark, sf_dir))).select(
        F.col("item.RLOIid").alias("rloiid"), "item_pos", "measure_pos", "measures_id"
    )


def station_rows_flat(spark, sf_dir):
    rows = station_rows(station_documents(spark, sf_dir), stage_scales(spark, sf_dir))
    return _zone_less(rows, "last_update").select(
        "rloiid", "label", "measures_id", "notation", "rivername", "typicalrangehigh",
        "typicalrangelow", "town", "lat", "long", "last_update",
    )


def station_message_rows(spark, sf_dir):
    return station_messages(station_documents(spark, sf_dir), stage_scales(spark, sf_dir))


def station_reject_rows(spark, sf_dir):
    return station_rejects(station_documents(spark, sf_dir), stage_scales(spark, sf_dir))


def station_output_rows(spark, sf_dir):
    """Messages and rejects written to their topics in one pass, and read from both."""
    topics = FileTopics(work_path(spark, "station-output"))
    topics.write_all(station_output(station_documents(spark, sf_dir), stage_scales(spark, sf_dir)))
    return topics.read(spark, STATIONS).withColumn("topic", F.lit(STATIONS)).unionByName(
        topics.read(spark, STATIONS + REJECTS_SUFFIX).withColumn(
            "topic", F.lit(STATIONS + REJECTS_SUFFIX))
    )


def measurement_message_rows(spark, sf_dir):
    return measurement_messages(measurement_documents(spark, sf_dir))


def keyed_messages(spark, sf_dir):
    """Messages keyed by measure id instead of the raw item."""
    return measurement_messages(measurement_documents(spark, sf_dir), key="id")


def topic_files(spark, sf_dir):
    """Messages written to a topic and read from it."""
    topics = FileTopics(work_path(spark, "topics"))
    topics.write(measurement_messages(measurement_documents(spark, sf_dir)), MEASUREMENTS)
    return topics.read(spark, MEASUREMENTS)


def stage_scale_latest(spark, sf_dir):
    return stage_scales(spark, sf_dir)


def stage_scale_enrich(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("stageScale/"), "c_nationkey").alias("link")
    )
    return enrich_stage_scale(customers, stage_scales(spark, sf_dir), link="link")


# Decode --------------------------------------------------------------------------------

def _messages(spark, sf_dir):
    return measurement_messages(measurement_documents(spark, sf_dir)).withColumn(
        "value", F.col("value").cast("binary")
    )


def json_decode(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(
        "event_id", F.col("props").cast("binary").cast("string").alias("text")
    )
    return parse(raw, "k INT", "text").drop("text")


def struct_expand(spark, sf_dir):
    parsed = table(spark, sf_dir, "events").select(
        F.struct("event_id", "user_id", "value").alias("topic")
    )
    return expand(parsed, "topic")


def topic_decode(spark, sf_dir):
    rows = accepted(decode(_messages(spark, sf_dir), MEASUREMENTS))
    return _zone_less(rows, "datetime", "last_update").drop("pk_id", "sequence")


def decode_rejects(spark, sf_dir):
    """Good messages, messages with other fields, and texts that are no messages at all."""
    other = table(spark, sf_dir, "events").select(F.col("props").cast("binary").alias("value"))
    prose = table(spark, sf_dir, "documents").select(F.col("text").cast("binary").alias("value"))
    mixed = _messages(spark, sf_dir).select("value").unionByName(other).unionByName(prose)
    return rejects(decode(mixed, MEASUREMENTS))


def surrogate_id(spark, sf_dir):
    return accepted(decode(_messages(spark, sf_dir), MEASUREMENTS, WIDE_COLUMN)).withColumn(
        "value", F.col("value").cast("double")
    )


def surrogate_id_by_offset(spark, sf_dir):
    """Ids from topic positions, as a broker gives them."""
    placed = table(spark, sf_dir, "events").select(
        F.to_json(F.struct(F.col("event_type").alias("unit"))).alias("value"),
        F.col("user_id").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    return accepted(decode(placed, MEASUREMENTS)).select("pk_id", "sequence", "unit")


def surrogate_id_random(spark, sf_dir):
    """Rows with whether their random id is a version 4 UUID, and no other row's."""
    rows = accepted(decode(_messages(spark, sf_dir), MEASUREMENTS, WIDE_COLUMN, ids="random"))
    form = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return rows.withColumns({
        "well_formed": F.col("uuid").rlike(form),
        "only_one": F.count(F.lit(1)).over(Window.partitionBy("uuid")) == 1,
    }).drop("uuid")


# Aggregates, latest rows, views ----------------------------------------------------------

def max_last_update(spark, sf_dir):
    return grouped_max(table(spark, sf_dir, "events"), "user_id", "ts", "max_last_update")


def latest_self_join(spark, sf_dir):
    return join_on_max(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


def distinct_on_rows(spark, sf_dir):
    return distinct_on(
        table(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"], [F.asc("o_orderkey")]
    )


def latest_order(spark, sf_dir):
    return latest_by_key(
        table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", ["o_orderkey"]
    )


def latest_order_two_pass(spark, sf_dir):
    return latest_by_key_two_pass(
        table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", ["o_orderkey"]
    )


def latest_order_filtered(spark, sf_dir):
    """Beyond the broadcast bound, with a runtime filter although the table is small.

    The settings are those of a session of its own beside the caller's.
    """
    own = spark.newSession()
    partitions = "spark.sql.shuffle.partitions"
    own.conf.set(partitions, spark.conf.get(partitions))
    small = {SCAN_THRESHOLD: "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in {**RUNTIME_FILTER, **small}.items():
        own.conf.set(name, value)
    return latest_by_key_two_pass(
        table(own, sf_dir, "orders"), "o_custkey", "o_orderdate", ["o_orderkey"], broadcast_bytes=0
    )


def latest_measurement_rows(spark, sf_dir):
    return latest_measurements(measurement_history(spark, sf_dir))


def latest_station_rows(spark, sf_dir):
    return latest_stations(station_history(spark, sf_dir))


def latest_by_date_two_pass(spark, sf_dir):
    """The two-pass form over a stored history, whose second scan skips dates."""
    sink = HistorySink(work_path(spark, "stored"), MEASUREMENTS)
    sink(measurement_messages(measurement_documents(spark, sf_dir)), "load", 0)
    history = read_history(spark, sink.path, MEASUREMENTS)
    form = partial(latest_by_key_two_pass, date="ingest_date")
    return _zone_less(latest_measurements(history, form), "datetime", "last_update")


def latest_refresh(spark, sf_dir):
    """Earlier rows as the previous state, later ones as what came in since."""
    history = measurement_history(spark, sf_dir)
    since = F.to_timestamp_ntz(F.lit(REFRESH_FROM))
    earlier = history.where(F.col("last_update") < since)
    previous = latest_by_key(earlier, "id", "last_update", ["sequence", "pk_id"])
    return refresh_latest(previous, history.where(F.col("last_update") >= since), MEASUREMENTS)


def latest_joined(spark, sf_dir):
    return _joined(spark, sf_dir)


def _from_views(spark, sf_dir, read):
    """What ``read`` makes of the registered views, which are removed again: its plan holds them."""
    register_views(station_history(spark, sf_dir), measurement_history(spark, sf_dir))
    try:
        return read()
    finally:
        for view in ("latest_stations", "latest_measurements", "stationsmeasurements"):
            spark.catalog.dropTempView(view)


def view_read(spark, sf_dir):
    return _from_views(
        spark, sf_dir, lambda: spark.sql("SELECT * FROM stationsmeasurements"))


def history_by_date(spark, sf_dir):
    """History rewritten into date folders and read back."""
    path = work_path(spark, "by-date")
    history = measurement_history(spark, sf_dir)
    history = history.withColumns({
        c: utc_instant(history, c) for c in ("datetime", "last_update")
    })
    rewrite_by_date(history.withColumn("ingest_date", utc_date("last_update")), path)
    return _zone_less(read_dated(spark, path, MEASUREMENTS), "datetime", "last_update")


def sql_views(spark, sf_dir):
    """History tables and lasting views in a database of the catalog."""
    path = work_path(spark, "gauges")
    database = work_database(path.rsplit("/", 1)[1].replace("-", "_"))
    create_tables(spark, database, path)
    stations = station_messages(station_documents(spark, sf_dir), stage_scales(spark, sf_dir))
    TableSink(database, STATIONS, f"{path}-rejects/stations")(stations, "load", 0)
    TableSink(database, MEASUREMENTS, f"{path}-rejects/measurements")(
        measurement_messages(measurement_documents(spark, sf_dir)), "load", 0
    )
    create_views(spark, database)
    return _zone_less(spark.table(f"{database}.stationsmeasurements"), "last_update")


# Presentation --------------------------------------------------------------------------

def local_time(spark, sf_dir):
    return show_local_time(
        measurement_history(spark, sf_dir).select("sequence", "last_update")
    )


def unit_relabel(spark, sf_dir):
    return relabel_units(measurement_history(spark, sf_dir).select("sequence", "unit"))


def rounded(spark, sf_dir):
    """Rounding of line prices, on values with halves in the third digit."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        round_half_even(F.col("l_extendedprice") / 8).alias("price"),
    )


def range_class(spark, sf_dir):
    return classify(round_columns(_with_range(spark, sf_dir))).drop("last_update", "unit")


def range_class_missing(spark, sf_dir):
    """Readings and bounds that are NULL or NaN."""
    rows = _with_range(spark, sf_dir)
    gaps = {"value": 4, "typical_range_low": 5, "typical_range_high": 7}
    return classify(round_columns(rows.withColumns({
        c: _with_gaps(c, "sequence", every) for c, every in gaps.items()
    }))).drop("last_update", "unit")


def range_class_rgb(spark, sf_dir):
    colour = range_colour(
        F.col("value"), F.col("typical_range_low"), F.col("typical_range_high")
    )
    return _with_range(spark, sf_dir).select("sequence", hex_to_rgb(colour).alias("color"))


def position(spark, sf_dir):
    return add_position(_joined(spark, sf_dir)).select("station_id", "position")


def tooltip(spark, sf_dir):
    return add_tooltip(present(_joined(spark, sf_dir))).select("station_id", "tooltip")


def table_rows(spark, sf_dir):
    return present(_joined(spark, sf_dir))


def view_map_rows(spark, sf_dir):
    return _from_views(spark, sf_dir, lambda: map_rows(spark.table("stationsmeasurements")))


QUERIES = {
    "station_status": status,
    "station_status_one_pass": status_one_pass,
    "station_status_two_pass": status,
    "station_status_missing": status_missing,
    "documents_to_status": documents_to_status,
    "status_from_snapshot": status_from_snapshot,
    "history_compacted": history_compacted,
    "status_clustered": status_clustered,
    "status_incremental": status_incremental,
    "landed_documents": landed_documents,
    "document_rejects": document_rejects,
    "landed_items": landed_items,
    "item_rejects": item_rejects,
    "item_field_nulls": item_field_nulls,
    "message_field_nulls": message_field_nulls,
    "document_explode": measurement_items_flat,
    "not_null_filter": not_null_filter,
    "matching_items": matching_items,
    "unnest_measures": unnest_measures_rows,
    "station_rows": station_rows_flat,
    "station_messages": station_message_rows,
    "station_rejects": station_reject_rows,
    "station_output": station_output_rows,
    "measurement_messages": measurement_message_rows,
    "keyed_messages": keyed_messages,
    "topic_files": topic_files,
    "stage_scale_latest": stage_scale_latest,
    "stage_scale_enrich": stage_scale_enrich,
    "json_decode": json_decode,
    "struct_expand": struct_expand,
    "topic_decode": topic_decode,
    "decode_rejects": decode_rejects,
    "surrogate_id": surrogate_id,
    "surrogate_id_by_offset": surrogate_id_by_offset,
    "surrogate_id_random": surrogate_id_random,
    "max_last_update": max_last_update,
    "latest_self_join": latest_self_join,
    "distinct_on": distinct_on_rows,
    "latest_order": latest_order,
    "latest_order_two_pass": latest_order_two_pass,
    "latest_order_filtered": latest_order_filtered,
    "latest_measurements": latest_measurement_rows,
    "latest_stations": latest_station_rows,
    "latest_by_date_two_pass": latest_by_date_two_pass,
    "latest_refresh": latest_refresh,
    "latest_joined": latest_joined,
    "view_read": view_read,
    "view_map_rows": view_map_rows,
    "history_by_date": history_by_date,
    "sql_views": sql_views,
    "local_time": local_time,
    "unit_relabel": unit_relabel,
    "round_half_even": rounded,
    "range_class": range_class,
    "range_class_rgb": range_class_rgb,
    "range_class_missing": range_class_missing,
    "position": position,
    "tooltip": tooltip,
    "table_rows": table_rows,
}
