import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from gaugewright.llm import ranked_search
from gaugewright.llm.oracle import ORACLES
from gaugewright.llm.queries import QUERIES
from gaugewright.llm.ranked_search import Best, Shard, item_blocks, ranked, search, summed, terms_of
from tests.compare import differences, duck
from tests.llm.rows import AWKWARD, LINE, documents

QUERY = "op12_ranked_search"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def expected(docs, items, most=50):
    """Rows (item_id, rank, doc_id, score), by scoring every document."""
    docs = [(i, plain_terms(t)) for i, t in docs]
    docs = [(i, t) for i, t in docs if t]
    total = sum(len(t) for _, t in docs)
    df = Counter(term for _, terms in docs for term in set(terms))
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(plain_terms(text))
    out = []
    for item, terms in wanted.items():
        found = []
        for name, words in docs:
            counts, m, score = Counter(words), 100 - 50 + 50 * len(words) * len(docs) // total, 0
            for term in terms:
                if counts[term]:
                    w = math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[term] + 1)))
                    score += w * (1000000000 * counts[term] // (1000 * counts[term] + 20 * m))
            if score > 0:
                found.append((-score, name is None, name or 0, name))
        for rank, (less, _, _, name) in enumerate(sorted(found, key=lambda f: f[:3])[:most], 1):
            out.append((item, rank, name, -less))
    return sorted(out, key=repr)


def as_rows(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


def items(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "item_id long, text string, rank int, doc_id string")


ITEMS = [
    (1, "The river rose overnight"), (2, "ONE long é 漢字 tail"), (3, None), (4, ""), (5, "nothing_like:this"),
    (6, "morning"), (6, "river one"), (None, "extra words"), (7, "É \U0001F600 x"), (8, "the the THE"),
]


def test_terms():
    text = "A-b_c É漢字 x y \U0001F600z 0\t\x7f9\nÀé"
    assert [t.decode() for t in terms_of(text)] == plain_terms(text)


@pytest.mark.parametrize("block_terms", [500_000, 3])
def test_equals_brute_force_on_awkward_rows(spark, block_terms):
    got = ranked(documents(spark, AWKWARD), items(spark, ITEMS), block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert as_rows(got) == expected([(i, t) for i, t, _ in AWKWARD], ITEMS)


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force_with_ties_and_many_shards(spark, monkeypatch, small):
    chance = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(chance.choice(words, 1 + i % 17, p=np.arange(60, 0, -1) / 1830)), "s") for i in range(1500)]
    rows += [(2000 + i, "w59 w58 w3", "s") for i in range(300)] + [(9999, "w59 w57", "s")] * 200
    wanted = [(i, " ".join(chance.choice(words, 8))) for i in range(20)] + [(100, " ".join(words))]
    docs = documents(spark, rows).repartition(3)
    if small:
        # Another number of documents to a shard, block and window must not change a thing; in this process only.
        _in_process(monkeypatch, rows, wanted)
    else:
        assert as_rows(ranked(docs, items(spark, wanted))) == expected([(i, t) for i, t, _ in rows], wanted)


def _in_process(monkeypatch, rows, wanted):
    monkeypatch.setattr(ranked_search, "BLOCK_BITS", 2)
    monkeypatch.setattr(ranked_search, "WINDOW_BLOCKS", 3)
    docs = [(i, plain_terms(t)) for i, t, _ in rows]
    vocabulary = {t: n for n, t in enumerate(sorted({t for _, text in wanted for t in plain_terms(text)}))}
    total, df = sum(len(t) for _, t in docs), Counter(t for _, terms in docs for t in set(terms))
    weights = np.array([ranked_search.weight(len(docs), df[t]) for t in vocabulary], np.int64)
    best, read, postings = {item: Best() for item, _ in wanted}, 0, 0
    for first in range(0, len(docs), 250):
        part = docs[first:first + 250]
        counted = [Counter(vocabulary[t] for t in terms if t in vocabulary) for _, terms in part]
        norms = np.array([50 + 50 * len(t) * len(docs) // total for _, t in part], np.int64)
        shard = Shard(norms, np.array([len(c) for c in counted]), np.array([t for c in counted for t in c]),
                      np.array([n for c in counted for n in c.values()]), weights)
        for item, text in wanted:
            terms = [vocabulary[t] for t in set(plain_terms(text))]
            postings += sum(len(shard.posting(t)[0]) for t in terms)
            read += search(shard, [i for i, _ in part], terms, best[item])
    got = sorted(((item, rank, e[2], -e[0]) for item, b in best.items() for rank, e in enumerate(b.entries, 1)), key=repr)
    assert got == expected([(i, t) for i, t, _ in rows], wanted)
    assert read <= postings


def test_long_lists_are_skipped_once_they_cannot_make_an_entry():
    n = 20_000
    rare = np.arange(n) % 97 == 0
    lengths = 2 + rare
    terms = np.concatenate([[0, 1, 2] if r else [0, 1] for r in rare])
    shard = Shard(np.full(n, 100), lengths, terms, np.ones(len(terms), np.int64), np.array([3, 5, 4000]))
    best = Best()
    assert search(shard, list(range(n)), [0, 1, 2], best) < 0.1 * len(terms)
    one = 1_000_000_000 // (1000 + 2000)
    assert [(e[2], -e[0]) for e in best.entries] == [(97 * i, 4008 * one) for i in range(50)]


def test_accumulators_are_a_list_with_bounds():
    docs, impacts, blocks, highest = summed([
        (np.array([1, 5, 300]), np.array([2, 3, 4]), None, None), (np.array([5, 299]), np.array([10, 20]), None, None)])
    assert docs.tolist() == [1, 5, 299, 300] and impacts.tolist() == [2, 13, 20, 4]
    assert blocks.tolist() == [0, 2] and highest.tolist() == [13, 20]


def test_blocks_of_items(spark):
    blocks = list(item_blocks(items(spark, ITEMS).select("item_id", "text"), 4))
    assert sum(len(b) for b in blocks) == len({i for i, t in ITEMS if plain_terms(t)})
    assert all(len(b) == 1 or sum(len(t) for _, t in b) <= 4 for b in blocks) and len(blocks) > 2


def test_empty_tables(spark):
    none = documents(spark, [])
    assert ranked(none, items(spark, ITEMS)).collect() == []
    assert ranked(documents(spark, AWKWARD), items(spark, [])).collect() == []
    assert ranked(documents(spark, [(1, None, "a"), (2, "?!", "a")]), items(spark, ITEMS)).collect() == []


def test_frequent_row_and_sql(spark):
    rows = [(i, LINE * (1 + i % 4) + f"only{i % 50}", "s") for i in range(400)] + [(7, "river bank", "s")] * 700
    wanted = [(1, "river bank only7"), (2, "only3 only4 fell"), (3, "bank")]
    got = ranked(documents(spark, rows), items(spark, wanted))
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, t, _ in rows])
    connection.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO benchmark VALUES (?, ?)", wanted)
    assert differences(got, connection, ORACLES[QUERY]) is None


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, sf_dir):
    assert differences(QUERIES[QUERY](spark, sf_dir), duck(sf_dir), ORACLES[QUERY]) is None
