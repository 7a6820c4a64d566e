import gzip
import hashlib
import os
import re
from collections import Counter

import pytest

from gaugewright.llm.common import BATCH_ROWS
from gaugewright.llm.oracle import ORACLES
from gaugewright.llm.queries import QUERIES
from gaugewright.llm.warc import (
    Captures, _captures, archive_and_read_back, build_index, line_key, look_up, parse_record, record, url_key, write_archive,
)
from tests.compare import differences, duck

PAGE = "<p>" + "The river rose by four feet. " * 60
PAGES = [
    (1, "http://www.Example.org/a?x=1", PAGE), (2, "https://example.org/b", PAGE), (3, None, PAGE),
    (4, "http://example.org/c", None), (5, "not a url\n\t", "short"), (6, "http://[bad/", "short"),
    (7, "http://example.org:8080/é", PAGE + "é漢\U0001F600"), (7, "http://example.org:8080/é", PAGE + "é漢\U0001F600"),
    (None, "http://example.org/n", PAGE), (9, "http://example.org/a", "\r\n\r\nWARC/1.1\r\n\r\n" * 90),
]
SCHEMA = "page_id long, url string, html string, row long, key string, kind string, file string, digest binary, size int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, 5, "k", "response", "f", b"d", 1) for r in rows], SCHEMA)


def expected(rows):
    out, groups = [], {}
    for i, _, html in rows:
        groups.setdefault(html or "", []).append(i)
    taken = set()
    for i, _, html in rows:
        raw = (html or "").encode()
        last = max(groups[html or ""], key=lambda x: -1 if x is None else x)
        first = len(raw) < 1000 or (i == last and (html, i) not in taken)
        taken.add((html, i))
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if first else "revisit", None if first else last))
    return Counter(out)


def test_url_keys():
    assert url_key("http://www.Example.org/a?x=1") == "org,example,www)/a?x=1"
    assert url_key("https://u@example.org:8443") == "org,example:8443)/"
    assert url_key(None) == ")/" and "\n" not in url_key("a\nb")
    assert line_key("k", None) < line_key("k", -5) < line_key("k", 0) < line_key("k", 12)


def test_records_read_back():
    payload = b"\r\n\r\nbody\r\n\r\n"
    headers, back = parse_record(record("response", "http://a/", 3, payload, hashlib.sha1(payload).digest()))
    assert back == payload and headers["WARC-Type"] == "response" and headers["WARC-Page-ID"] == "3"
    headers, back = parse_record(record("revisit", "http://a/", 3, payload, b"d", 9, "http://b/"))
    assert back == b"" and headers["WARC-Refers-To-Page-ID"] == "9"
    with pytest.raises(ValueError):
        parse_record(record("response", "u", 1, payload, b"d")[:-3])


def test_awkward_rows(spark):
    rows = archive_and_read_back(pages(spark, PAGES).repartition(3)).collect()
    got = Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows)
    assert got == expected(PAGES)
    assert archive_and_read_back(pages(spark, [])).count() == 0


A, B, C = (f"<p>{c} " + "and so on it went. " * 80 for c in "ABC")
U = "http://example.org/u"


@pytest.mark.parametrize("rows", [
    [(None, U, B), (None, U, A), (None, U, A)],
    [(None, U, A), (None, U, B), (None, U, C), (None, U, B), (None, U, A), (None, U, C)],
    [(7, U, c) for c in (A, B, C)] * 3 + [(3, U, A), (9, U, B)],
    [(i, f"http://example.org/{url}", A) for i, url in enumerate(["plain", "a\tb"])],
    [(i, f"http://example.org/{url}", A) for i, url in enumerate(["plain", "a\nb\r"])],
    [(1, U, A), (2, " http://example.org/lead", A)], [(1, U, A), (2, "http://example.org/trail \x00", A)],
    [(1, U, A), (2, "\n", A)], [(1, U, A), (2, "http://[bad/\t", A)],
])
def test_revisits_of_shared_ids_and_odd_urls(spark, rows):
    rows_back = archive_and_read_back(pages(spark, rows).repartition(2)).collect()
    got = Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows_back)
    assert got == expected(rows)


def test_look_ups_over_many_blocks_and_files(spark, tmp_path):
    rows = [(i, f"http://h{i % 5}.example.org/{i % 37}", f"page {i} " * (200 if i % 3 else 1)) for i in range(400)]
    rows += [(77, "http://hot.example.org/", "same")] * 300
    folder, manifest = write_archive(pages(spark, rows).repartition(4), str(tmp_path / "warc"), file_bytes=4000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        root = build_index(folder, manifest, block_lines=7)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert manifest.select("file").distinct().count() > 8 and len(root) > 1
    found = look_up(manifest.where("page_id % 10 = 7 OR page_id = 3"), folder, root).collect()
    assert Counter(r["page_id"] for r in found) == Counter(i for i, _, _ in rows if i % 10 == 7 or i == 3)
    captures = Captures(folder, root)
    assert list(captures.find("org,example,h0)/nowhere", 5)) == list(captures.find("zzz)", 5)) == []
    assert len(list(captures.find(url_key("http://hot.example.org/"), 77))) == 300
    # Every archive is a chain of gzip members that can be read without the index.
    total, ids = 0, []
    for name in os.listdir(folder):
        if name.endswith(".warc.gz"):
            data = gzip.open(os.path.join(folder, name)).read()
            total += data.count(b"WARC/1.1\r\nWARC-Type: ")
            ids += re.findall(rb"WARC-Record-ID: <([^>]*)>", data)
    assert total == len(rows) == len(set(ids))


def test_a_row_repeated_over_and_over_is_read_by_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = [(i, f"http://example.org/{i}", "short") for i in range(50)] + [(77, U, A)] * 3000
    folder, manifest = write_archive(pages(spark, rows).repartition(4), str(tmp_path / "warc"))
    root = build_index(folder, manifest)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = look_up(manifest, folder, root).where("page_id = 77").select(F.spark_partition_id().alias("task"), "record_type").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert Counter(r["record_type"] for r in found) == {"response": 1, "revisit": 2999}
    assert max(Counter(r["task"] for r in found).values()) < 2000
    # Without the manifest's rows, one key gives them all, in small batches.
    batches = list(_captures(folder, root)(manifest.where("page_id = 77").select("key", "page_id").distinct().toArrow().to_batches()))
    assert sum(b.num_rows for b in batches) == 3000 and max(b.num_rows for b in batches) <= BATCH_ROWS


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    assert differences(QUERIES["op9_warc_index"](spark, sf_dir), duck(sf_dir), ORACLES["op9_warc_index"]) is None
