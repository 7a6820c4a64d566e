from collections import Counter, defaultdict

import pytest

from gaugewright.llm.mixing import mix_documents, mix_report
from gaugewright.llm.queries import op10_mixing
from tests.conftest import plan
from tests.llm.rows import AWKWARD, LINE, documents


def plain_targets(sizes):
    """{source: target} by resharing until no target is above three times its source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in capped]
        share = (total - sum(capped.values())) / (sum(weight[s] for s in open_) or 1)
        above = [s for s in open_ if share * weight[s] > 3 * sizes[s]]
        if not above:
            return capped | {s: share * weight[s] for s in open_}
        capped |= {s: 3 * sizes[s] for s in above}


def check(rows, report):
    """rows: (doc_id, size, source)."""
    sizes = defaultdict(int)
    for _, size, source in rows:
        sizes[source] += size
    targets, source_of = plain_targets(sizes), {}
    for i, size, source in rows:
        source_of.setdefault((i, size), set()).add(source)
    taken, largest = defaultdict(int), defaultdict(int)
    assert Counter((r["doc_id"], r["size"]) for r in report) == Counter((i, s) for i, s, _ in rows)
    for r in report:
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        of = next(s for s in source_of[r["doc_id"], r["size"]]
                  if sizes[s] == r["source_size"] and abs(targets[s] - r["target"]) <= 1e-9 * max(1, targets[s]))
        taken[of] += r["taken"]
        largest[of] = max(largest[of], r["size"])
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 1.1 * largest[s] + 1
    return taken


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_meets_the_targets(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()
    rows = [(d["doc_id"], len((d["text"] or "").encode().split()), d["source"]) for d in docs]
    report = op10_mixing(spark, f"/root/testdata/{sf}").collect()
    check(rows, report)
    again = op10_mixing(spark, f"/root/testdata/{sf}").collect()
    assert sorted(map(tuple, report)) == sorted(map(tuple, again))


def test_awkward_rows_and_a_source_at_its_cap(spark):
    rows = AWKWARD + [(100 + i, LINE * (1 + i % 7), "hot") for i in range(400)] + [(900, "two words", "tiny")]
    docs = documents(spark, rows)
    report = mix_report(docs).collect()
    taken = check([(i, len((t or "").encode().split()), s) for i, t, s in rows], report)
    assert taken["tiny"] == 6
    mixed = mix_documents(docs)
    assert mixed.schema == docs.schema
    copies = Counter()
    for r in report:
        copies[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in mixed.collect()) == +copies


def test_empty_and_wordless_tables(spark):
    assert mix_report(documents(spark, [])).count() == 0 and mix_documents(documents(spark, [])).count() == 0
    report = mix_report(documents(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in report] == [(0, 0.0, 0)] * 2


def test_copies_of_one_size_share_the_rate(spark):
    docs = documents(spark, [(i, LINE, "a") for i in range(1000)] + [(5000 + i, LINE, "b") for i in range(200)])
    report = mix_report(docs).collect()
    check([(r["doc_id"], 15, "a" if r["doc_id"] < 5000 else "b") for r in report], report)


def test_no_python_in_the_plan(spark):
    text = plan(mix_report(documents(spark, AWKWARD)))
    assert not any(word in text for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
