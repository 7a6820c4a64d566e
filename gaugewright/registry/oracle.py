"""For each query, SQL over the same tables that must give the same rows."""

from gaugewright.functions.colours import BELOW_RANGE, IN_RANGE, OTHER
from gaugewright.functions.times import LOCAL_ZONE
from gaugewright.registry.fixtures import METER, STATIONS_FETCHED

# The test tables as gauge data -----------------------------------------------------------

_UNIT = f"""CASE event_type WHEN 'purchase' THEN '{METER}'
    WHEN 'signup' THEN 'see {METER}' ELSE 'mASD' END"""

_MEASUREMENT_HISTORY = f"""measurement_history AS (
  SELECT CAST(event_id AS VARCHAR) AS pk_id, 'measure/' || user_id AS id,
    CAST(user_id AS VARCHAR) AS stationreference,
    CAST(date_trunc('hour', ts) AS TIMESTAMP) AS datetime, value, {_UNIT} AS unit,
    ts AS last_update, event_id AS sequence
  FROM events)"""

_STATION_HISTORY = """station_history AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS pk_id, CAST(o_custkey AS VARCHAR) AS rloiid,
    'Station ' || o_custkey AS label, 'measure/' || o_custkey AS measures_id,
    'N' || o_orderkey AS notation, o_orderstatus AS rivername,
    o_totalprice / 4000.0::DOUBLE AS typicalrangehigh,
    o_totalprice / 20000.0::DOUBLE AS typicalrangelow, o_orderpriority AS town,
    50.0::DOUBLE + (o_orderkey % 800) / 100.0::DOUBLE AS lat,
    -5.0::DOUBLE + (o_orderkey % 500) / 100.0::DOUBLE AS long,
    o_orderdate AS last_update, o_orderkey AS sequence
  FROM orders)"""

# Equal times go to the larger sequence.
_LATEST_MEASUREMENTS = """latest_measurements AS (
  SELECT id, last_update, stationreference, datetime, value, unit
  FROM measurement_history WHERE id IS NOT NULL AND last_update IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY last_update DESC, sequence DESC) = 1)"""

_LATEST_STATIONS = """latest_stations AS (
  SELECT * EXCLUDE (sequence)
  FROM station_history WHERE rloiid IS NOT NULL AND last_update IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY rloiid ORDER BY last_update DESC, sequence DESC) = 1)"""

_JOINED = """joined AS (
  SELECT s.rloiid AS station_id, s.notation AS station_notation, s.label AS station_name,
    s.rivername AS river_name, s.town AS town, s.lat AS latitude, s.long AS longitude,
    m.datetime AS last_update, m.value AS value, m.unit AS unit,
    s.typicalrangelow AS typical_range_low, s.typicalrangehigh AS typical_range_high
  FROM latest_stations s JOIN latest_measurements m ON s.measures_id = m.id)"""


def _round(column):
    return f"round_even({column} * 100, 0) / 100"


def _local(column):
    return (f"strftime(({column} AT TIME ZONE 'UTC') AT TIME ZONE '{LOCAL_ZONE}', "
            "'%Y-%m-%d %H:%M')")


_COLOUR = f"""CASE
    WHEN value >= typical_range_low AND value <= typical_range_high THEN '{IN_RANGE}'
    WHEN value < typical_range_low THEN '{BELOW_RANGE}' ELSE '{OTHER}' END"""


def _rgb(colour):
    parts = ", ".join(f"CAST('0x' || substr({colour}, {at}, 2) AS INTEGER)" for at in (2, 4, 6))
    return f"[{parts}]"


_PRESENTED = f"""rounded AS (
  SELECT station_id, station_notation, station_name, river_name, town, latitude, longitude,
    {_local('last_update')} AS last_update, {_round('value')} AS value,
    CASE WHEN unit = '{METER}' THEN 'm' ELSE unit END AS unit,
    {_round('typical_range_low')} AS typical_range_low,
    {_round('typical_range_high')} AS typical_range_high
  FROM joined),
coloured AS (SELECT *, {_COLOUR} AS hex FROM rounded),
presented AS (SELECT * EXCLUDE (hex), {_rgb('hex')} AS color FROM coloured)"""


def _gaps(column, number, every):
    """NULL where the test data has NULL or NaN."""
    return f"CASE WHEN {number} % {every} > 1 THEN {column} END"


def _shown(column):
    return f"coalesce({column}, 'null')"


def _number(column):
    plain = f"regexp_replace(CAST(CAST({column} AS DECIMAL(38, 2)) AS VARCHAR), '\\.?0+$', '')"
    return _shown(plain)


_TOOLTIP = f"""'<b>Station:</b> ' || {_shown('station_name')}
    || ' (id: ' || {_shown('station_notation')} || ')<br>'
    || '<b>River:</b> ' || {_shown('river_name')} || '<br>'
    || '<b>Town:</b> ' || {_shown('town')} || '<br>'
    || '<b>Updated:</b> ' || {_shown('last_update')} || '<br>'
    || '<b>Measurement:</b> ' || {_number('value')} || ' ' || {_shown('unit')} || '<br>'
    || '<b>Typical range:</b> ' || {_number('typical_range_low')} || ' ' || {_shown('unit')}
    || ' - ' || {_number('typical_range_high')} || ' ' || {_shown('unit')}"""

_VIEWS = f"{_MEASUREMENT_HISTORY}, {_STATION_HISTORY}, {_LATEST_MEASUREMENTS}, " \
         f"{_LATEST_STATIONS}, {_JOINED}"

_MAP_ROWS = f"SELECT *, [longitude, latitude] AS position, {_TOOLTIP} AS tooltip FROM presented"

_STATUS = f"WITH {_VIEWS}, {_PRESENTED} {_MAP_ROWS}"

_STATUS_MISSING = f"""WITH {_MEASUREMENT_HISTORY}, {_STATION_HISTORY},
{_LATEST_MEASUREMENTS.replace('datetime, value, unit', "datetime, "
                              + _gaps('value', 'sequence', 4) + " AS value, unit")},
{_LATEST_STATIONS.replace('SELECT * EXCLUDE (sequence)', "SELECT * EXCLUDE (sequence) REPLACE ("
                          + _gaps('typicalrangelow', 'sequence', 5) + " AS typicalrangelow, "
                          + _gaps('typicalrangehigh', 'sequence', 7) + " AS typicalrangehigh)")},
{_JOINED}, {_PRESENTED} {_MAP_ROWS}"""

# Documents -------------------------------------------------------------------------------

_READINGS = f"""readings AS (
  SELECT event_id, 'measure/' || user_id AS id, CAST(user_id AS VARCHAR) AS stationreference,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS datetime, value, {_UNIT} AS unit,
    ts AS last_update, event_type,
    '{{"@id":"measure/' || user_id || '","stationReference":"' || user_id || '","notes":"'
      || event_type || '","unit":"' || {_UNIT} || '"'
      || CASE WHEN event_type <> 'error' THEN ',"latestReading":{{"dateTime":"'
        || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '","value":' || value || '}}' ELSE '' END
      || '}}' AS raw,
    '{{"@id":"spare/' || user_id || '","stationReference":"' || user_id || '","notes":"'
      || event_type || '","unit":"' || {_UNIT} || '"}}' AS spare_raw
  FROM events)"""

_MEASUREMENT_VALUE = """'{"id":"' || id || '","stationreference":"' || stationreference
    || '","datetime":"' || datetime || '","value":' || value || ',"unit":"' || unit
    || '","last_update":"' || strftime(last_update, '%Y-%m-%d %H:%M:%S.%f') || '"}'"""

_MEASUREMENT_MESSAGES = f"""measurement_messages AS (
  SELECT *, raw AS key, {_MEASUREMENT_VALUE} AS message
  FROM readings WHERE event_type <> 'error')"""

_SCALES = """scales AS (
  SELECT DISTINCT ON (s_nationkey) 'stageScale/' || s_nationkey AS url,
    abs(s_acctbal) AS high, s_nationkey + 0.5::DOUBLE AS low
  FROM supplier ORDER BY s_nationkey, s_suppkey DESC)"""

# A customer's list of measures: none, the measure, or the backup and the measure.
_MEASURES = """list_slice(['measure/' || c_custkey || '/backup', 'measure/' || c_custkey],
    CAST(3 - c_custkey % 3 AS BIGINT), 2)"""

_LISTED = f"""listed AS (
  SELECT *, {_MEASURES} AS measures, 'stageScale/' || c_nationkey AS link,
    '"label":"' || c_name || '","notation":"' || c_mktsegment
      || '","status":"Active","stageScale":"stageScale/' || c_nationkey || '","town":"Town '
      || c_nationkey || '","lat":' || (50.0::DOUBLE + c_nationkey / 4.0::DOUBLE)
      || ',"long":' || (-5.0::DOUBLE + c_nationkey / 8.0::DOUBLE) AS body
  FROM customer)"""

_RAW_STATION = """'{"RLOIid":"' || c_custkey || '",' || body || ',"measures":['
    || coalesce(list_aggregate(list_transform(measures, lambda m: '{"@id":"' || m || '"}'),
      'string_agg', ','), '') || ']}'"""

_MEASURE_ROWS = """measure_rows AS (
  SELECT *, unnest(measures) AS measures_id,
    unnest(generate_series(0, len(measures) - 1)) AS measure_pos
  FROM listed WHERE len(measures) > 0)"""

_STATION_ROWS = f"""station_rows AS (
  SELECT CAST(c_custkey AS VARCHAR) AS rloiid, c_name AS label, measures_id,
    c_mktsegment AS notation, CAST(NULL AS VARCHAR) AS rivername, high AS typicalrangehigh,
    low AS typicalrangelow, 'Town ' || c_nationkey AS town,
    50.0::DOUBLE + c_nationkey / 4.0::DOUBLE AS lat,
    -5.0::DOUBLE + c_nationkey / 8.0::DOUBLE AS long,
    TIMESTAMP '{STATIONS_FETCHED}' + to_microseconds(measure_pos) AS last_update,
    {_RAW_STATION} AS key
  FROM measure_rows JOIN scales ON link = url)"""

_STATION_VALUE = """'{"rloiid":"' || rloiid || '","label":"' || label || '","measures_id":"'
    || measures_id || '","notation":"' || notation || '","rivername":null,"typicalrangehigh":'
    || typicalrangehigh || ',"typicalrangelow":' || typicalrangelow || ',"town":"' || town
    || '","lat":' || lat || ',"long":' || long || ',"last_update":"'
    || strftime(last_update, '%Y-%m-%d %H:%M:%S.%f') || '"}'"""

_STATION_CTES = f"""{_SCALES}, {_LISTED}, {_MEASURE_ROWS}, {_STATION_ROWS},
station_messages AS (SELECT key, {_STATION_VALUE} AS value FROM station_rows),
station_rejects AS (
  SELECT 'stage scale not found' AS reject_reason, {_RAW_STATION} AS raw FROM listed
  WHERE link NOT IN (SELECT url FROM scales)
  UNION ALL SELECT CASE WHEN link IN (SELECT url FROM scales) THEN 'no list of measures'
      ELSE 'stage scale not found' END,
    '{{"RLOIid":"spare-' || c_custkey || '",' || body || '}}' FROM listed)"""

_DOCUMENT_HISTORIES = f"""measurement_history AS (
  SELECT id, stationreference, CAST(strptime(datetime, '%Y-%m-%dT%H:%M:%SZ') AS TIMESTAMP)
    AS datetime, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value, unit, last_update,
    event_id AS sequence
  FROM readings WHERE event_type <> 'error'),
station_history AS (
  SELECT key AS pk_id, rloiid, label, measures_id, notation, rivername,
    CAST(CAST(typicalrangehigh AS FLOAT) AS DOUBLE) AS typicalrangehigh,
    CAST(CAST(typicalrangelow AS FLOAT) AS DOUBLE) AS typicalrangelow, town,
    CAST(CAST(lat AS FLOAT) AS DOUBLE) AS lat, CAST(CAST(long AS FLOAT) AS DOUBLE) AS long,
    last_update, 0 AS sequence
  FROM station_rows)"""

_DOCUMENT_CTES = f"{_READINGS}, {_SCALES}, {_LISTED}, {_MEASURE_ROWS}, {_STATION_ROWS}, " \
                 f"{_DOCUMENT_HISTORIES}"

_DOCUMENT_STATUS = f"WITH {_DOCUMENT_CTES}, {_LATEST_MEASUREMENTS}, {_LATEST_STATIONS}, " \
                   f"{_JOINED}, {_PRESENTED} {_MAP_ROWS}"

_DECODED = f"WITH {_DOCUMENT_CTES} SELECT * EXCLUDE (sequence) FROM measurement_history"

_DOCUMENT_LATEST = f"""WITH {_DOCUMENT_CTES}, {_LATEST_MEASUREMENTS}
    SELECT * FROM latest_measurements"""


def _hashed_id(text):
    h = f"sha256({text})"
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-8' || substr({h}, 14, 3) "
            f"|| '-8' || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)")


_RANGES = f"""ranges AS (
  SELECT event_id AS sequence, value, event_id % 40 + 0.125::DOUBLE AS typical_range_low,
    event_id % 90 + 0.375::DOUBLE AS typical_range_high
  FROM events)"""

_LATEST_ORDER = """SELECT * FROM orders
  WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL QUALIFY
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""

ORACLES = {
    "station_status": _STATUS,
    "station_status_one_pass": _STATUS,
    "station_status_two_pass": _STATUS,
    "station_status_missing": _STATUS_MISSING,
    "view_map_rows": _STATUS,
    "documents_to_status": _DOCUMENT_STATUS,
    "landed_documents": f"""WITH {_READINGS} SELECT id, stationreference, datetime, value, unit,
        last_update FROM readings WHERE event_type <> 'error'""",
    "document_explode": f"""WITH {_READINGS}
        SELECT CAST(0 AS INTEGER) AS item_pos, id, stationreference,
          CASE WHEN event_type <> 'error' THEN datetime END AS datetime,
          CASE WHEN event_type <> 'error' THEN value END AS value, unit FROM readings
        UNION ALL SELECT 1, 'spare/' || stationreference, stationreference, NULL, NULL, unit
        FROM readings""",
    "not_null_filter": f"""WITH {_READINGS} SELECT id, datetime, value FROM readings
        WHERE event_type <> 'error'""",
    "matching_items": f"""WITH {_READINGS}
        SELECT CAST(0 AS INTEGER) AS item_pos, raw FROM readings WHERE event_type = 'click'
        UNION ALL SELECT 1, spare_raw FROM readings WHERE event_type = 'click'""",
    "unnest_measures": f"""WITH {_LISTED}, {_MEASURE_ROWS}
        SELECT CAST(c_custkey AS VARCHAR) AS rloiid, CAST(0 AS INTEGER) AS item_pos,
          CAST(measure_pos AS INTEGER) AS measure_pos, measures_id FROM measure_rows""",
    "station_rows": f"""WITH {_SCALES}, {_LISTED}, {_MEASURE_ROWS}, {_STATION_ROWS}
        SELECT * EXCLUDE (key) FROM station_rows""",
    "station_messages": f"WITH {_STATION_CTES} SELECT key, value FROM station_messages",
    "station_rejects": f"WITH {_STATION_CTES} SELECT reject_reason, raw FROM station_rejects",
    "station_output": f"""WITH {_STATION_CTES}
        SELECT 'stations' AS topic, key, value FROM station_messages UNION ALL
        SELECT 'stations-rejects', reject_reason, raw FROM station_rejects""",
    "measurement_messages": f"""WITH {_READINGS}, {_MEASUREMENT_MESSAGES}
        SELECT key, message AS value FROM measurement_messages""",
    "keyed_messages": f"""WITH {_READINGS}, {_MEASUREMENT_MESSAGES}
        SELECT id AS key, message AS value FROM measurement_messages""",
    "topic_files": f"""WITH {_READINGS}, {_MEASUREMENT_MESSAGES}
        SELECT key, message AS value FROM measurement_messages""",
    "document_rejects": f"""WITH {_READINGS}, {_MEASUREMENT_MESSAGES}
        SELECT 'measurements' AS topic, key, message AS value FROM measurement_messages
        UNION ALL SELECT 'measurements-rejects', 'malformed document', text FROM documents""",
    "station_ingest_stream": f"""WITH {_STATION_CTES}
        SELECT 'stations' AS topic, key, value FROM station_messages UNION ALL
        SELECT 'stations-rejects', reject_reason, raw FROM station_rejects""",
    "ingest_stream": f"""WITH {_READINGS}, {_MEASUREMENT_MESSAGES}
        SELECT key, message AS value FROM measurement_messages""",
    "stage_scale_latest": f"WITH {_SCALES} SELECT * FROM scales",
    "stage_scale_enrich": f"""WITH {_SCALES}
        SELECT c_custkey, 'stageScale/' || c_nationkey AS link, high, low,
          url IS NOT NULL AS scale_found
        FROM customer LEFT JOIN scales ON url = 'stageScale/' || c_nationkey""",
    "json_decode": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events""",
    "struct_expand": "SELECT event_id, user_id, value FROM events",
    "topic_decode": _DECODED,
    "decode_rejects": """SELECT 'no known field' AS reject_reason, props AS reject_value
        FROM events UNION ALL
        SELECT CASE WHEN trim(text) = '' THEN 'empty message' ELSE 'malformed message' END, text
        FROM documents""",
    "surrogate_id": f"""WITH {_READINGS}, {_MEASUREMENT_MESSAGES}
        SELECT {_hashed_id("'measurements|' || message")} AS uuid, id, stationreference, datetime,
          CAST(CAST(value AS FLOAT) AS DOUBLE) AS value, unit FROM measurement_messages""",
    "surrogate_id_by_offset": f"""SELECT
          {_hashed_id("'measurements|' || user_id || '|' || event_id")} AS pk_id,
          event_id AS sequence, event_type AS unit FROM events""",
    "surrogate_id_random": f"""WITH {_READINGS}, {_MEASUREMENT_MESSAGES}
        SELECT id, stationreference, datetime, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value, unit,
          true AS well_formed, true AS only_one FROM measurement_messages""",
    "max_last_update": "SELECT user_id, max(ts) AS max_last_update FROM events GROUP BY user_id",
    "latest_self_join": """SELECT * FROM orders
        WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL QUALIFY
        rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1""",
    "distinct_on": """SELECT DISTINCT ON (o_custkey, o_orderdate) * FROM orders
        ORDER BY o_custkey, o_orderdate, o_orderkey""",
    "latest_order": _LATEST_ORDER,
    "latest_order_two_pass": _LATEST_ORDER,
    "latest_order_filtered": _LATEST_ORDER,
    "latest_measurements": f"""WITH {_MEASUREMENT_HISTORY}, {_LATEST_MEASUREMENTS}
        SELECT * FROM latest_measurements""",
    "latest_stations": f"""WITH {_STATION_HISTORY}, {_LATEST_STATIONS}
        SELECT * FROM latest_stations""",
    "latest_refresh": f"""WITH {_MEASUREMENT_HISTORY}
        SELECT DISTINCT ON (id) * FROM measurement_history
        ORDER BY id, last_update DESC, sequence DESC""",
    "latest_joined": f"WITH {_VIEWS} SELECT * FROM joined",
    "view_read": f"WITH {_VIEWS} SELECT * FROM joined",
    "sql_views": f"""WITH {_DOCUMENT_CTES}, {_LATEST_MEASUREMENTS}, {_LATEST_STATIONS}, {_JOINED}
        SELECT * FROM joined""",
    "history_by_date": f"""WITH {_MEASUREMENT_HISTORY}
        SELECT *, CAST(last_update AS DATE) AS ingest_date FROM measurement_history""",
    "local_time": f"SELECT event_id AS sequence, {_local('ts')} AS last_update FROM events",
    "unit_relabel": f"""WITH {_MEASUREMENT_HISTORY}
        SELECT sequence, CASE WHEN unit = '{METER}' THEN 'm' ELSE unit END AS unit
        FROM measurement_history""",
    "round_half_even": f"""SELECT l_orderkey, l_linenumber,
        {_round('(l_extendedprice / 8::DOUBLE)')} AS price FROM lineitem""",
    "range_class": f"""WITH {_RANGES}, rounded AS (
          SELECT sequence, {_round('value')} AS value,
            {_round('typical_range_low')} AS typical_range_low,
            {_round('typical_range_high')} AS typical_range_high FROM ranges)
        SELECT *, {_COLOUR} AS color FROM rounded""",
    "range_class_rgb": f"""WITH {_RANGES}, coloured AS (
          SELECT sequence, {_COLOUR} AS hex FROM ranges)
        SELECT sequence, {_rgb('hex')} AS color FROM coloured""",
    "range_class_missing": f"""WITH {_RANGES}, gaps AS (SELECT sequence,
            {_gaps('value', 'sequence', 4)} AS value,
            {_gaps('typical_range_low', 'sequence', 5)} AS typical_range_low,
            {_gaps('typical_range_high', 'sequence', 7)} AS typical_range_high FROM ranges),
          rounded AS (
          SELECT sequence, {_round('value')} AS value,
            {_round('typical_range_low')} AS typical_range_low,
            {_round('typical_range_high')} AS typical_range_high FROM gaps)
        SELECT *, {_COLOUR} AS color FROM rounded""",
    "position": f"""WITH {_VIEWS} SELECT station_id, [longitude, latitude] AS position
        FROM joined""",
    "tooltip": f"""WITH {_VIEWS}, {_PRESENTED}
        SELECT station_id, {_TOOLTIP} AS tooltip FROM presented""",
    "table_rows": f"WITH {_VIEWS}, {_PRESENTED} SELECT * FROM presented",
    "history_stream": f"""WITH {_DOCUMENT_CTES}
        SELECT * EXCLUDE (sequence), CAST(last_update AS DATE) AS ingest_date
        FROM measurement_history""",
    "latest_by_date_two_pass": _DOCUMENT_LATEST,
    "latest_measurements_stream": _DOCUMENT_LATEST,
    "latest_state_stream": _DOCUMENT_LATEST,
    "status_stream": _DOCUMENT_STATUS,
    "status_from_state": _DOCUMENT_STATUS,
    "status_from_checkpoint": _DOCUMENT_STATUS,
    "status_from_snapshot": _DOCUMENT_STATUS,
    "history_compacted": _DOCUMENT_STATUS,
    "status_incremental": _DOCUMENT_STATUS,
    "status_clustered": _DOCUMENT_STATUS,
    "item_rejects": """SELECT 'measurements' AS topic,
          '{"@id":"m' || event_id || '","latestReading":{"value":' || value || '}}' AS key,
          'm' || event_id AS value FROM events
        UNION ALL SELECT 'measurements-rejects', 'malformed item', unnest(['junk',
          CAST(event_id AS VARCHAR), NULL, '{"@id":"odd","latestReading":"oops"}',
          '{broken ' || event_id]) FROM events""",
    "item_field_nulls": """SELECT CASE WHEN event_id % 6 = 2 THEN '' ELSE 'm' END || event_id AS id,
          CASE WHEN event_id % 6 > 3 THEN value END AS value,
          CASE event_id % 6 WHEN 0 THEN '["m","n"]' WHEN 4 THEN NULL ELSE 'm' END AS unit,
          concat_ws(' ', CASE WHEN event_id % 6 = 2 THEN '@id' END, CASE WHEN event_id % 6 = 0 THEN 'unit' END,
            CASE WHEN event_id % 6 < 4 THEN 'latestReading.value' END) AS fields FROM events""",
    "message_field_nulls": """SELECT 'value' AS field,
          CASE WHEN event_id % 6 = 2 THEN '' ELSE 'm' END || event_id AS id FROM events WHERE event_id % 6 < 4""",
    "landed_items": f"""WITH {_READINGS} SELECT raw, id, stationreference, datetime, value, unit
        FROM readings WHERE event_type <> 'error'""",
    "batch_metrics": f"""WITH {_READINGS}, parts AS (SELECT unnest(range(5)) AS epoch),
        accepted AS (SELECT day(last_update) % 5 AS epoch, count(*) AS n, min(last_update) AS first_stamp,
            max(last_update) AS last_stamp FROM readings WHERE event_type <> 'error' GROUP BY 1),
        rejected AS (SELECT doc_id % 5 AS epoch, count(*) AS n FROM documents GROUP BY 1)
        SELECT 'measurements' AS topic, epoch, coalesce(accepted.n, 0) AS accepted,
          coalesce(rejected.n, 0) AS rejected, first_stamp, last_stamp
        FROM parts LEFT JOIN accepted USING (epoch) LEFT JOIN rejected USING (epoch)""",
    "rejects_stream": """SELECT
          CASE WHEN trim(text) = '' THEN 'empty message' ELSE 'malformed message' END
            AS reject_reason, text AS reject_value FROM documents""",
}
