import itertools
import math
import random

import numpy as np
import pytest

from gaugewright.llm.language import Tagger, fit, forward_backward, languages, predict, quotas, spliced, training_sample
from gaugewright.llm.queries import op6_language
from tests.llm.rows import AWKWARD, documents

SYLLABLES = {"en": "the ing ea sh wh".split(), "de": "sch keit ung ü ei".split(), "fr": "eau é que ç oi".split()}


def some_text(chance, lang, n=40):
    return " ".join("".join(chance.choice(SYLLABLES[lang]) for _ in range(chance.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    chance = random.Random(1)
    return fit([(some_text(chance, lang), lang) for lang in SYLLABLES for _ in range(60)])


def plain_posteriors(scores, transitions, start):
    """By listing all label sequences."""
    n, k = scores.shape
    out, total = np.zeros((n, k)), 0.0
    for path in itertools.product(range(k), repeat=n):
        weight = start[path[0]] + sum(scores[t, y] for t, y in enumerate(path))
        weight = math.exp(weight + sum(transitions[a, b] for a, b in zip(path, path[1:])))
        total += weight
        for t, y in enumerate(path):
            out[t, y] += weight
    return out / total


def test_forward_backward_equals_all_paths():
    chance = np.random.default_rng(3)
    lengths = [5, 3, 3, 1]
    scores, transitions, start = chance.normal(size=(12, 3)), chance.normal(size=(3, 3)), chance.normal(size=3)
    posterior, pairs, starts = forward_backward(scores, transitions, start, lengths)
    at, begins = 0, np.zeros(3)
    for n in lengths:
        want = plain_posteriors(scores[at:at + n], transitions, start)
        assert np.allclose(posterior[at:at + n], want)
        begins += want[0]
        at += n
    assert np.allclose(starts, begins) and np.isclose(pairs.sum(), sum(n - 1 for n in lengths))


def test_very_long_texts_do_not_underflow(model):
    chance = random.Random(2)
    text = some_text(chance, "de", 60_000)
    assert Tagger(model).texts([text, "the", None]) [0][0] == "de"


def test_words_of_code_switched_text(model):
    chance = random.Random(4)
    text = some_text(chance, "en", 15) + " 12 -- " + some_text(chance, "fr", 15)
    labels = [lang for _, lang in Tagger(model).words(text)]
    assert len(labels) == 30
    assert labels[:12] == ["en"] * 12 and labels[-12:] == ["fr"] * 12
    assert Tagger(model).words(" ") == []


def test_remembered_tokens_do_not_change_the_result(model, monkeypatch):
    chance = random.Random(6)
    texts = [some_text(chance, chance.choice(list(SYLLABLES)), chance.randint(1, 50)) for _ in range(40)]
    once = Tagger(model).texts(texts)
    monkeypatch.setattr("gaugewright.llm.language.REMEMBERED_TOKENS", 5)
    monkeypatch.setattr("gaugewright.llm.language.WORDS_AT_ONCE", 30)
    few = Tagger(model).texts(texts)
    assert [o[0] for o in once] == [f[0] for f in few]
    assert np.allclose([o[1] for o in once], [f[1] for f in few], atol=1e-4)


def test_sequences_switch_languages():
    chance = random.Random(5)
    sequences = spliced([(some_text(chance, lang, 200), lang) for lang in SYLLABLES])
    assert any(len({label for _, label in s}) > 1 for s in sequences)
    assert sum(map(len, sequences)) == 600


def test_awkward_rows(spark, model):
    docs = documents(spark, AWKWARD + [(60, "123 456 --- ١", "a"), (61, "schkeit", "a")])
    rows = predict(docs, model).collect()
    assert len(rows) == len(AWKWARD) + 2
    for r in rows:
        empty = r["doc_id"] in (3, 4, 5, 60)
        assert 0 <= r["score"] <= 1
        assert empty == (r["lang_pred"] == "und" and r["score"] == 0) or r["doc_id"] is None
    assert {r["lang_pred"] for r in rows if r["doc_id"] == 61} == {"de"}
    assert {r["lang_pred"] for r in languages(docs.selectExpr("doc_id", "text", "string(null) AS lang")).collect()} == {"und"}
    assert languages(documents(spark, [])).count() == 0
    assert fit([("12 34", "en")]) is None


def test_quotas():
    assert quotas({"a": 5000, "b": 7, "c": 5000}, 3000, 200) == {"a": 1496, "b": 7, "c": 1497}
    assert quotas({str(i): 1000 for i in range(50)}, 3000, 200) == {str(i): 200 for i in range(50)}
    assert quotas({"a": 3}, 3000, 200) == {"a": 3} and quotas({}, 3000, 200) == {}


def test_copies_and_rare_languages_in_the_sample(spark):
    chance = random.Random(8)
    rows = [(i, some_text(chance, "en"), "en") for i in range(3000)]
    rows += [(i, some_text(chance, "de"), "de") for i in range(20)]
    copies = [(9000 + i, some_text(chance, "fr"), "fr") for i in range(3)] * 700
    schema = "doc_id long, text string, lang string"
    once = sorted(training_sample(spark.createDataFrame(rows + copies[:3], schema), most=100, least=10))
    counts = {lang: sum(x == lang for _, x in once) for lang in SYLLABLES}
    assert counts == {"en": 77, "de": 20, "fr": 3} and len(set(once)) == 100
    for order in (copies + rows, rows[::-1] + copies):  # neither copies nor the order of rows change it
        assert sorted(training_sample(spark.createDataFrame(order, schema).repartition(3), most=100, least=10)) == once
    got = languages(spark.createDataFrame(copies + rows, schema)).collect()
    assert {r["lang_pred"] for r in got if r["doc_id"] >= 9000} == {"fr"}
    assert len(got) == len(copies + rows)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    import zlib

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = op6_language(spark, sf_dir).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
