import hashlib
import random
import re
from collections import Counter

import pandas as pd
import pytest

from gaugewright.llm.exact_dedup import exact_dedup, exact_groups, heavy_values, misra_gries
from tests.compare import differences, duck
from tests.llm.rows import AWKWARD, documents


def expected(rows):
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for i, t, _ in rows:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        ids = [x for x in groups[text] if x is not None]
        out.append((i, min(ids) if ids else None, len(groups[text]), hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("counters", [1, 2, 1024])
def test_awkward_rows(spark, counters):
    rows = AWKWARD + [(100 + i, "copied  text", "a") for i in range(300)] + [(9, "copied text", "a")] * 200
    docs = documents(spark, rows)
    groups = exact_groups(docs, counters=counters).collect()
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in groups)
    assert got == expected(rows)
    kept = [r for r in groups if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in groups})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    stayed = exact_dedup(docs, counters=counters)
    assert stayed.schema == docs.schema
    assert Counter(r["doc_id"] for r in stayed.collect()) == Counter(r["doc_id"] for r in kept)


def test_empty_table(spark):
    docs = documents(spark, [])
    assert exact_groups(docs).count() == 0 and exact_dedup(docs).count() == 0


def test_misra_gries_keeps_what_is_frequent():
    values = ["a"] * 40 + [f"x{i}" for i in range(50)] + ["b"] * 30
    batches = [pd.Series(values[i:i + 7]) for i in range(0, len(values), 7)]
    found = misra_gries(batches, 5)
    assert {"a", "b"} <= set(found) and len(found) <= 5
    assert found["a"] <= 40


def test_heavy_values_are_exact(spark):
    df = spark.createDataFrame([("a",)] * 400 + [(f"x{i}",) for i in range(500)] + [(None,)] * 300, "v string")
    rows = heavy_values(df.repartition(5), "v", 8).collect()
    assert {(r["value"], r["n"]) for r in rows} == {("a", 400)}


@pytest.mark.parametrize("seed", range(3))
def test_no_value_just_over_the_threshold_is_missed(spark, seed):
    chance = random.Random(seed)
    counters = 4
    # Three values hold just a quarter each, in a few tasks only, beside values that fill each task's summary.
    rows = [v for v in "abc" for _ in range(250)] + [f"x{i}" for i in range(50) for _ in range(5)]
    chance.shuffle(rows)
    rows.sort(key=lambda v: (v in "abc") * chance.random())
    df = spark.createDataFrame([(v,) for v in rows], "v string").coalesce(1).repartitionByRange(7, "v")
    for tasks in (df, spark.createDataFrame([(v,) for v in rows], "v string")):
        found = heavy_values(tasks, "v", counters).collect()
        assert sorted((r["value"], r["n"]) for r in found) == [("a", 250), ("b", 250), ("c", 250)]


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, sf_dir):
    from gaugewright.llm.oracle import ORACLES
    from gaugewright.llm.queries import QUERIES

    name = "op2_exact_dedup"
    assert differences(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLES[name]) is None
