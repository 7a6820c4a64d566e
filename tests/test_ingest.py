import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gaugewright.operators.decode import accepted, decode
from gaugewright.operators.enrich import stage_scale_table
from gaugewright.operators.unnest import field_errors, matching, measurement_items
from gaugewright.plans.ingest import (
    measurement_messages,
    measurement_output,
    measurement_rejects,
    measurement_rows,
    station_messages,
    station_output,
    station_rejects,
    station_rows,
)
from gaugewright.plans.views import latest_stations
from gaugewright.schemas import STATIONS
from gaugewright.sources.documents import (
    parse_documents,
    parse_stage_scales,
    read_documents,
    read_items,
    read_stage_scales,
)

# What a failed job raises depends on where it failed.
JOB_ERRORS = (PySparkException, Py4JJavaError)

TWO = {"RLOIid": "1", "label": ["a", "b"], "stageScale": "u1", "lat": 1.5, "extra": {"x": 1},
       "measures": [{"@id": "m0"}, {"@id": "m1"}]}
EMPTY = {"RLOIid": "2", "stageScale": "u1", "measures": []}
NO_SCALE = {"RLOIid": "3", "stageScale": "nope", "measures": [{"@id": "q"}]}
NO_LIST = {"RLOIid": "4", "stageScale": "u1"}
NO_LINK = {"RLOIid": "5", "measures": [{"@id": "q"}]}
AGAIN = {"RLOIid": "1", "stageScale": "u2", "measures": [{"@id": "m9"}]}
from tests.conftest import plan


def documents(spark, *documents):
    rows = [(json.dumps({"items": d}),) for d in documents]
    return parse_documents(spark.createDataFrame(rows, "document string").withColumn(
        "fetched_at", F.to_timestamp(F.lit("2024-01-01 00:00:00"))))


@pytest.fixture(scope="module")
def scales(spark):
    return spark.createDataFrame([("u1", 1.0, 0.5), ("u2", None, 0.25)],
                                 "url string, high double, low double")


def test_one_row_per_measure_none_for_an_empty_list(spark, scales):
    rows = station_rows(documents(spark, [TWO, EMPTY]), scales).orderBy("measures_id").collect()
    assert [(r["rloiid"], r["measures_id"]) for r in rows] == [("1", "m0"), ("1", "m1")]
    assert (rows[0]["typicalrangehigh"], rows[0]["typicalrangelow"]) == (1.0, 0.5)


def test_missing_bound_is_null(spark, scales):
    [row] = station_rows(documents(spark, [AGAIN]), scales).collect()
    assert row["typicalrangehigh"] is None and row["typicalrangelow"] == 0.25


def test_rejects(spark, scales):
    rows = station_rejects(documents(spark, [TWO, EMPTY, NO_SCALE, NO_LIST, NO_LINK]), scales)
    assert {(json.loads(r["raw"])["RLOIid"], r["reject_reason"]) for r in rows.collect()} == {
        ("3", "stage scale not found"), ("4", "no list of measures"),
        ("5", "no stage scale link")}


def test_output_holds_messages_and_rejects_of_one_pass(spark, scales):
    docs = documents(spark, [TWO, EMPTY, NO_SCALE, NO_LIST, NO_LINK], [AGAIN])
    out = station_output(docs, scales)
    good = out.where("topic = 'stations'").select("key", "value")
    assert sorted(map(tuple, good.collect())) == sorted(
        map(tuple, station_messages(docs, scales).collect()))
    bad = out.where("topic = 'stations-rejects'").select("key", "value")
    assert sorted(map(tuple, bad.collect())) == sorted(
        map(tuple, station_rejects(docs, scales).collect()))


@pytest.mark.parametrize("item", [NO_SCALE, NO_LINK])
def test_strict_fails_on_a_missing_scale(spark, scales, item):
    assert station_rows(documents(spark, [TWO]), scales, strict=True).count() == 2
    with pytest.raises(JOB_ERRORS, match="no stage scale document"):
        station_rows(documents(spark, [TWO, item]), scales, strict=True).collect()


def test_message_key_is_the_whole_raw_item(spark, scales):
    row = station_messages(documents(spark, [TWO]), scales).first()
    assert json.loads(row["key"]) == TWO
    value = json.loads(row["value"])
    assert list(value) == ["rloiid", "label", "measures_id", "notation", "rivername",
                           "typicalrangehigh", "typicalrangelow", "town", "lat", "long",
                           "last_update"]
    assert value["label"] == '["a","b"]' and value["town"] is None


def test_key_can_be_the_station(spark, scales):
    rows = station_messages(documents(spark, [TWO]), scales, key="rloiid").collect()
    assert {r["key"] for r in rows} == {"1"}


def test_last_measure_of_a_station_wins(spark, scales):
    def latest(*docs):
        rows = accepted(decode(station_messages(documents(spark, *docs), scales), STATIONS))
        return [(r["rloiid"], r["measures_id"]) for r in latest_stations(rows).collect()]

    assert latest([TWO]) == [("1", "m1")]
    # A later item of one station beats an earlier one with more measures.
    assert latest([TWO, AGAIN]) == [("1", "m9")]
    assert latest([AGAIN, TWO]) == [("1", "m1")]


def test_measurements_need_a_reading(spark):
    items = [{"@id": "a", "latestReading": {"dateTime": "2024-01-01T00:00:00Z", "value": 0.5}},
             {"@id": "b"}, {"@id": "c", "latestReading": None},
             {"@id": "d", "unit": "m", "latestReading": {}}]
    docs = documents(spark, items)
    rows = {r["id"]: r for r in measurement_rows(docs).collect()}
    assert set(rows) == {"a", "d"}
    assert rows["a"]["value"] == 0.5 and rows["d"]["value"] is None
    value = json.loads(measurement_messages(docs).where("key like '%\"a\"%'").first()["value"])
    assert value == {"id": "a", "stationreference": None, "datetime": "2024-01-01T00:00:00Z",
                     "value": 0.5, "unit": None, "last_update": "2024-01-01 00:00:00.000000"}


def test_matching_raw_attributes(spark):
    docs = documents(spark, [{"@id": "a", "status": "Active"}, {"@id": "b", "status": "Closed"},
                             {"@id": "c"}])
    rows = matching(measurement_items(docs), {"status": "Active"}).collect()
    assert [r["item"]["@id"] for r in rows] == ["a"]


def test_a_document_without_items_fails_the_job(spark):
    def rows(text):
        texts = spark.createDataFrame([(text,)], "document string").withColumn(
            "fetched_at", F.current_timestamp())
        return measurement_rows(parse_documents(texts)).count()

    assert rows('{"items":[]}') == 0
    for text in ("{}", '{"items":null}'):
        with pytest.raises(JOB_ERRORS, match="no items"):
            rows(text)


def test_output_of_wanted_items_keeps_malformed_documents(spark, scales):
    items = [dict(TWO, status="Active"), dict(AGAIN, status="Closed"), AGAIN]
    texts = spark.createDataFrame([(json.dumps({"items": items}),), ("broken",)],
                                  "document string").withColumn("fetched_at", F.current_timestamp())
    docs = parse_documents(texts, on_bad="keep")
    rows = station_output(docs, scales, {"status": "Active"}).collect()
    assert sorted(r["topic"] for r in rows) == ["stations", "stations", "stations-rejects"]
    assert station_output(docs, scales).where("topic = 'stations'").count() == 4


@pytest.mark.parametrize("text", ["broken", "", "{}", '{"items":null}', '{"items":[1', "[]"])
def test_bad_documents_can_be_kept_as_rejects(spark, scales, text):
    good = json.dumps({"items": [dict(TWO, latestReading={"value": 1.0})]})
    texts = spark.createDataFrame([(good,), (text,)], "document string").withColumn(
        "fetched_at", F.current_timestamp())
    docs = parse_documents(texts, on_bad="keep")
    for output, topic, messages in ((station_output(docs, scales), "stations", 2),
                                    (measurement_output(docs), "measurements", 1)):
        assert output.where(F.col("topic") == topic).count() == messages
        bad = output.where(F.col("topic") == f"{topic}-rejects").collect()
        assert [(r["key"], r["value"]) for r in bad] == [("malformed document", text)]
    assert measurement_rows(docs).count() == 1
    assert station_rejects(docs, scales).count() == 1


def test_a_broken_document_fails_the_job(spark):
    texts = spark.createDataFrame([("not json",)], "document string")
    with pytest.raises(JOB_ERRORS):
        parse_documents(texts).collect()


def test_landed_files(spark, tmp_path):
    item = {"@id": "a", "latestReading": {"dateTime": "2024-01-01T00:00:00Z", "value": 1.0}}
    (tmp_path / "one.json").write_text(json.dumps({"items": [item, item]}, indent=2))
    (tmp_path / "two.json").write_text(json.dumps({"items": [item]}, indent=2))
    docs = read_documents(spark, str(tmp_path))
    assert measurement_rows(docs).count() == 3
    assert docs.where("fetched_at is null").count() == 0
    streamed = read_documents(spark, str(tmp_path), stream=True)
    assert streamed.isStreaming and set(streamed.columns) == {"items", "fetched_at"}


def test_landed_lines_with_fetch_time_and_bad_document(spark, tmp_path):
    lines = [json.dumps({"items": [{"@id": "a", "latestReading": {"value": 1.0}}],
                         "fetched": "2024-01-01 00:00:05"}), "{broken"]
    (tmp_path / "docs.json").write_text("\n".join(lines))
    kept = read_documents(spark, str(tmp_path), multi_line=False, on_bad="keep",
                          fetched_at="fetched")
    rows = measurement_rows(kept).collect()
    assert [str(r["last_update"]) for r in rows] == ["2024-01-01 00:00:05"]
    bad = measurement_output(kept).where("topic = 'measurements-rejects'").collect()
    assert [r["value"] for r in bad] == ["{broken"]
    with pytest.raises(JOB_ERRORS):
        read_documents(spark, str(tmp_path), multi_line=False).collect()
    with pytest.raises(ValueError):
        read_documents(spark, str(tmp_path), on_bad="maybe")


def test_landed_items_one_per_line(spark, tmp_path):
    lines = [json.dumps({"@id": i, "latestReading": {"value": 1.0}}) for i in "abc"]
    (tmp_path / "items.json").write_text("\n".join(lines))
    rows = measurement_rows(read_items(spark, str(tmp_path))).collect()
    assert sorted(r["id"] for r in rows) == ["a", "b", "c"]
    assert {r["raw"] for r in rows} == set(lines)
    (tmp_path / "items.json").write_text('{"@id":"a","latestReading":{"value":NaN,"x":[-Infinity]}}\n')
    items = measurement_items(read_items(spark, str(tmp_path)))
    assert [r["value"] for r in measurement_rows(read_items(spark, str(tmp_path))).collect()] == [None]
    assert field_errors(items).count() == 0


GOOD = {"@id": "a", "latestReading": {"value": 1.0}}
BAD_ITEMS = ['"junk"', "5", "null", '{"@id":"b","latestReading":"oops"}',
             '{"@id":"b","latestReading":[1]}', "[1]"]


@pytest.mark.parametrize("item", BAD_ITEMS)
def test_items_that_cannot_be_read_are_rejects_or_fail(spark, scales, item):
    text = f'{{"items":[{json.dumps(GOOD)},{item},{{"@id":"silent"}}]}}'
    texts = spark.createDataFrame([(text,)], "document string").withColumn("fetched_at", F.current_timestamp())
    kept = parse_documents(texts, on_bad="keep")
    for wanted in (None, {"@id": "a"}):
        rows = measurement_output(kept, wanted).collect()
        assert sorted(r["topic"] for r in rows) == ["measurements", "measurements-rejects"]
        [bad] = [r for r in rows if r["topic"] == "measurements-rejects"]
        assert bad["key"] == "malformed item" and bad["value"] == {"null": None, '"junk"': "junk"}.get(item, item)
    assert measurement_rejects(kept).count() == 1 and measurement_rows(kept).count() == 1
    with pytest.raises(JOB_ERRORS, match="malformed item"):
        measurement_rows(parse_documents(texts)).collect()


def test_station_items_that_cannot_be_read(spark, scales):
    text = json.dumps({"items": [TWO, "junk", {"RLOIid": "x", "measures": "none"}]})
    texts = spark.createDataFrame([(text,)], "document string").withColumn("fetched_at", F.current_timestamp())
    rejected = station_rejects(parse_documents(texts, on_bad="keep"), scales).collect()
    assert [r["reject_reason"] for r in rejected] == ["malformed item"] * 2
    with pytest.raises(JOB_ERRORS, match="malformed item"):
        station_output(parse_documents(texts), scales).collect()


def test_a_broken_line_of_items(spark, tmp_path):
    (tmp_path / "items.json").write_text(json.dumps(GOOD) + "\n\n{broken\n")
    rows = measurement_output(read_items(spark, str(tmp_path), on_bad="keep")).collect()
    assert sorted((r["topic"], r["value"]) for r in rows)[1] == ("measurements-rejects", "{broken")
    assert len(rows) == 2
    with pytest.raises(JOB_ERRORS, match="broken"):
        measurement_rows(read_items(spark, str(tmp_path))).collect()


def test_stage_scale_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(
        {"url": "u1", "items": {"typicalRangeHigh": 2.0, "typicalRangeLow": 1.0}}))
    (tmp_path / "b.json").write_text(json.dumps({"url": "u2", "items": {"typicalRangeLow": 3}}))
    (tmp_path / "c.json").write_text(json.dumps({"url": "u3"}))
    rows = stage_scale_table(read_stage_scales(spark, str(tmp_path))).collect()
    assert {tuple(r) for r in rows} == {("u1", 2.0, 1.0), ("u2", None, 3.0)}


def test_latest_fetch_of_a_scale_counts(spark):
    docs = spark.createDataFrame(
        [("u1", (2.0, 1.0), 1), ("u1", (9.0, 8.0), 2)],
        "url string, items struct<typicalRangeHigh double, typicalRangeLow double>, "
        "fetched_at int")
    assert [tuple(r) for r in stage_scale_table(docs).collect()] == [("u1", 9.0, 8.0)]


ODD_ITEMS = {
    '{"@id":"b","latestReading":{"value":[0.1,0.2],"dateTime":"2024-01-01T00:00:00Z"},"unit":"m"}': ("b", None, "m", ["latestReading.value"]),
    '{"@id":"b","latestReading":{"value":"0.5"},"unit":["m","n"]}': ("b", None, '["m","n"]', ["unit", "latestReading.value"]),
    '{"@id":7,"latestReading":{"value":{"x":1}},"unit":{"a":1}}': ("7", None, '{"a":1}', ["@id", "unit", "latestReading.value"]),
    '{"@id":"b","latestReading":{"value":true},"unit":null}': ("b", None, None, ["latestReading.value"]),
    # Taking the items apart puts the word in quotes.
    '{"@id":"b","latestReading":{"value":NaN}}': ("b", None, None, ["latestReading.value"]),
    '{"@id":"b","latestReading":{"value":2},"unit":1.5}': ("b", 2.0, "1.5", ["unit"]),
    '{"@id":"b","latestReading":{},"extra":[1]}': ("b", None, None, []),
    '{"@id":"b","latestReading":{"value":1e-7}}': ("b", 1e-7, None, []),
}


@pytest.mark.parametrize("item", ODD_ITEMS)
@pytest.mark.parametrize("on_bad", ["fail", "keep"])
def test_a_field_of_another_type_costs_that_field_only(spark, item, on_bad):
    """As a provider's ``.get`` passes it on, and the typed message makes it NULL or its text."""
    text = f'{{"items":[{json.dumps(GOOD)},{item}]}}'
    texts = spark.createDataFrame([(text,)], "document string").withColumn("fetched_at", F.current_timestamp())
    documents = parse_documents(texts, on_bad=on_bad)
    name, value, unit, odd = ODD_ITEMS[item]
    rows = measurement_rows(documents).where("id <> 'a'").collect()
    assert [(r["id"], r["value"], r["unit"]) for r in rows] == [(name, value, unit)]
    assert {r["topic"] for r in measurement_output(documents).collect()} == {"measurements"}
    found = field_errors(measurement_items(documents)).collect()
    assert sorted(r["field"] for r in found) == sorted(odd) and all(r["item_pos"] == 1 for r in found)


def test_odd_station_fields_and_scales(spark):
    station = {"RLOIid": 12, "label": ["River", "Town"], "lat": "50.1", "long": -1.5, "stageScale": "u",
               "measures": [{"@id": 5}, {"@id": "m"}, {}]}
    texts = spark.createDataFrame([(json.dumps({"items": [station]}),)], "document string").withColumn(
        "fetched_at", F.current_timestamp())
    scale_texts = spark.createDataFrame(
        [('{"url":"u","items":{"typicalRangeHigh":[3.1],"typicalRangeLow":0.25}}', 1),
         ('{"url":"v","items":{"typicalRangeHigh":"3.1"}}', 1)], "document string, fetched_at int")
    scales = stage_scale_table(parse_stage_scales(scale_texts))
    assert sorted(map(tuple, scales.collect())) == [("u", None, 0.25), ("v", None, None)]
    rows = station_rows(parse_documents(texts), scales).collect()
    assert [(r["rloiid"], r["label"], r["lat"], r["long"], r["measures_id"], r["typicalrangehigh"], r["typicalrangelow"])
            for r in sorted(rows, key=lambda r: r["measure_pos"])] == [
        ("12", '["River","Town"]', None, -1.5, m, None, 0.25) for m in ("5", "m", None)]
    odd = spark.createDataFrame([('{"url":"u","items":[1]}', 1)], "document string, fetched_at int")
    with pytest.raises(JOB_ERRORS, match="malformed stage scale"):
        parse_stage_scales(odd).collect()


def test_items_are_parsed_once(spark):
    """Only a generator parses; fields and filters read its value."""
    texts = spark.createDataFrame([('{"items":[]}',)], "document string").withColumn("fetched_at", F.current_timestamp())
    for rows in (measurement_rows(parse_documents(texts)), measurement_output(parse_documents(texts, on_bad="keep"))):
        lines = [line for line in plan(rows).splitlines() if "parse_json" in line.lower() or "parsejson" in line.lower()]
        assert lines and all(line.startswith("Arguments: inline(") or line.startswith("+- ") for line in lines), lines
