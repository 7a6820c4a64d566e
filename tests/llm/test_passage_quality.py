import random

import numpy as np
import pyarrow as pa
import pytest

from gaugewright.llm import passage_quality as pq
from gaugewright.llm.passage_quality import (
    Model, passage_cuts, passage_quality, score, score_of, train, training_bags,
)
from gaugewright.llm.queries import op11_quality_model
from tests.llm.rows import AWKWARD, documents


def cut(text):
    data = np.frombuffer(text.encode(), np.uint8)
    limits = np.r_[passage_cuts(data), len(data)]
    return [data[a:b].tobytes().decode(errors="replace") for a, b in zip(limits, limits[1:])]


def test_passages_cover_whole_texts(monkeypatch):
    text = " ".join(f"word{i}" for i in range(500)) + "\n" + "x" * 5000 + " end  "
    parts = cut(text)
    assert "".join(parts) == text
    assert all(len(p.split()) <= pq.PASSAGE_WORDS + 1 and len(p) <= pq.PASSAGE_BYTES for p in parts)
    assert cut("") == [""] and cut(" \n ") == [" \n "]
    monkeypatch.setattr(pq, "PIECE", 3000)
    assert "".join(cut(text)) == text


def test_gradients_equal_differences():
    chance = np.random.default_rng(1)
    bags = [pq._counted([b"a first passage, GOOD", b"!! ** bad"]), pq._counted([b"third"]), pq._counted([b"x y x y", b"", b"z"])]
    labels, weights = np.array([1, 0, 1], np.float64), np.array([0.5, 2, 1])
    model, heard = Model(3), np.ones(pq.FEATURES)
    for name in Model.NAMES:
        setattr(model, name, getattr(model, name).astype(np.float64))

    def loss():
        total = 0
        for bag, label, weight in zip(bags, labels, weights):
            rows = np.zeros((len(bag), pq.FEATURES))
            for i, (features, shares) in enumerate(bag):
                rows[i, features] = shares
            attention, value = model.heads(np.tanh(rows @ model.vectors + model.shift))
            p = score_of(attention, value, model.bias[0])
            total -= weight * (label * np.log(p) + (1 - label) * np.log(1 - p)) / len(bags)
        return total

    found = pq._gradients(model, bags, labels, weights, heard)
    for name in Model.NAMES:
        value = getattr(model, name)
        places = [tuple(chance.integers(0, n) for n in value.shape) for _ in range(4)]
        if name == "vectors":
            places = [(int(f), 1) for f in bags[0][0][0][:4]]
        for place in places:
            before = value[place]
            value[place] = before + 1e-4
            high = loss()
            value[place] = before - 1e-4
            low = loss()
            value[place] = before
            assert found[name][place] == pytest.approx((high - low) / 2e-4, rel=2e-3, abs=2e-6), (name, place)


TEXTS = ["", "a", "ab", "One short text.", " \n ", "é" * 40, "word " * 700 + "end", "x" * 9000, "Mixed 12 !! text\n" * 60, "z"]


def test_scores_do_not_depend_on_neighbours_or_pieces(monkeypatch):
    model = Model(5)
    alone = [pq._scores(model, pa.array([t]))[0] for t in TEXTS]
    together = pq._scores(model, pa.array([*TEXTS, None]))
    assert np.allclose(together[:-1], alone, atol=1e-6) and together[-1] == pytest.approx(alone[0], abs=1e-6)
    monkeypatch.setattr(pq, "PIECE", 2500)
    monkeypatch.setattr(pq, "BYTES_AT_ONCE", 300)
    assert np.allclose(pq._scores(model, pa.array([*TEXTS, None])), together, atol=1e-5)


def test_attention_finds_the_passage_that_decides():
    chance = random.Random(2)
    good = [" ".join("".join(chance.choice("abcdeilnorst") for _ in range(5)) for _ in range(40)) for _ in range(900)]
    bags, labels = [], []
    for i in range(300):
        bag = [g.encode() for g in good[3 * i:3 * i + 3]]
        if i % 3 == 0:
            bag[i % 2] = b"$$ ## BUY!! NOW!! " * 12
        bags.append(bag)
        labels.append(int(i % 3 != 0))
    model = train(bags[:240], labels[:240])
    hits = 0
    for bag, label in zip(bags[240:], labels[240:]):
        limits = np.cumsum([0] + [len(p) for p in bag])
        data = np.frombuffer(b"".join(bag), np.uint8)
        attention, value = model.passages(data, limits[:-1], limits[-1:])
        assert (score_of(attention, value, model.bias[0]) >= 0.5) == label
        hits += label or int(attention.argmax()) == [b"$$" in p for p in bag].index(True)
    assert hits >= 57


def test_degenerate_labels(spark):
    docs = documents(spark, AWKWARD)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in passage_quality(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(9)] + [(3, None), (None, 0)], "doc_id long, quality int")
    rows = passage_quality(docs, ones).collect()
    assert {(r["score"], r["predicted"]) for r in rows} == {(1.0, 1)} and len(rows) == len(AWKWARD)
    assert passage_quality(documents(spark, []), ones).collect() == []


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)] * 3 + [(2, 1)] * 5, "doc_id long, quality int")
    rows = passage_quality(documents(spark, AWKWARD), labels).collect()
    assert len(rows) == len(AWKWARD)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert len({round(r["score"], 5) for r in rows if r["doc_id"] == 2}) == 1


def test_sample_is_bounded_and_drops_copies(spark):
    rows = [(i, f"text {i} " * 30, "s") for i in range(300)] + [(7, "text 7 " * 30, "s")] * 500 + [(9, "other", "s")]
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(300)], "doc_id long, quality int")
    docs = documents(spark, rows).select("doc_id", "text")
    bags, found, share = training_bags(docs, labels, most=100)
    assert len(bags) == 100 and share == pytest.approx(0.8) and 40 <= sum(found) <= 60
    assert len({tuple(b) for b in bags}) == 100
    assert training_bags(docs.repartition(5), labels, most=100) == (bags, found, share)


def test_held_out_accuracy_by_language(spark):
    """Rows that were not learned, in each language; and what is held out does not change a score."""
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = op11_quality_model(spark, sf_dir).join(docs, "doc_id").join(labels, "doc_id").where("held_out").toPandas()
    assert set(rows["lang"]) == {"en", "de", "fr", "es"} and len(rows) > 1000
    for _, group in rows.groupby("lang"):
        for value in (0, 1):
            labelled = group[group["quality"] == value]
            assert (labelled["predicted"] == value).mean() > 0.9
    assert score(spark.createDataFrame([], "doc_id long, text string"), Model()).collect() == []
