import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from gaugewright.llm import suffix_dedup
from gaugewright.llm.suffix_dedup import (
    LENGTH, PrefixHash, cut, merged, repeated_windows, runs_of, suffix_order, without_repeats,
)
from tests.llm.rows import AWKWARD, LINE, documents


def plain(texts, length):
    """(n_bytes, n_removed, n_spans, kept) of each text, by counting all windows."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(hashlib.md5(r[i:i + length]).digest() for r in raws for i in range(len(r) - length + 1))
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[hashlib.md5(raw[i:i + length]).digest()] > 1:
                gone[i:i + length] = b"\1" * length
        n_spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(raw), sum(gone), n_spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def test_prefix_hashes_and_common_extension():
    data = np.frombuffer(b"abracadabra abracadabrb" * 3, np.uint8)
    prefix = PrefixHash(data)
    a, b = np.array([0, 0, 7, 12]), np.array([12, 7, 14, 12])
    raw = data.tobytes()

    def plain_common(x, y):
        n = 0
        while n < 20 and x + n < len(raw) and y + n < len(raw) and raw[x + n] == raw[y + n]:
            n += 1
        return n

    assert prefix.common(a, b, 20).tolist() == [plain_common(x, y) for x, y in zip(a, b)]
    assert prefix.grams(5)[3] == prefix.of(np.array([3]), 5)[0]


@pytest.mark.parametrize("seed", range(4))
def test_suffix_order_sorts_segments(seed):
    chance = random.Random(seed)
    data = np.array([chance.choice(b"ab") for _ in range(600)], np.uint8)
    sizes = [1, 2, 3, 7, 64, 100]
    places = np.array([chance.randrange(570) for _ in range(sum(sizes))])
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    size = np.repeat(sizes, sizes)
    order = suffix_order(PrefixHash(data), places, first, size, 30)
    raw, at = data.tobytes(), 0
    for n in sizes:
        want = sorted(raw[p:p + 30] for p in places[at:at + n])
        assert [raw[p:p + 30] for p in order[at:at + n]] == want
        assert sorted(order[at:at + n]) == sorted(places[at:at + n])
        at += n


def test_equal_windows_elect_the_same_anchor():
    chance = random.Random(5)
    shared = bytes(chance.choice(b"abcdefgh ") for _ in range(60))
    texts = [bytes(chance.choice(b"abcdefgh ") for _ in range(n)) for n in (100, 37, 0, 80)]
    texts = [t + shared + t[::-1] for t in texts]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    seen = {}
    for t, s, e, p, h in zip(*runs_of(data, starts, ends, 24, 8)):
        assert starts[t] <= s <= e and e + 24 <= ends[t]
        for i in range(s, e + 1):
            window = data[i:i + 24].tobytes()
            assert seen.setdefault(window, (p - i, h)) == (p - i, h)
    assert len(seen) > 200


def test_a_hash_collision_is_found_and_mended(monkeypatch):
    contexts = [b"x" * 10 + bytes([c]) * 30 for c in b"ababc"]
    right = [f.tolist() for f in repeated_windows(contexts, [5] * 5, [0] * 5, 20)]
    monkeypatch.setattr(PrefixHash, "of", lambda self, start, length: np.zeros(len(start), np.uint64))
    wrong_hashes = [f.tolist() for f in repeated_windows(contexts, [5] * 5, [0] * 5, 20)]
    assert wrong_hashes == right
    assert any(right[0]) and not all(right[4])


def test_spans_and_cut():
    assert merged([(5, 9), (1, 3), (3, 4), (8, 12)]) == [[1, 4], [5, 12]]
    assert cut(b"0123456789abcdef", [[1, 4], [5, 12]]) == b"04cdef"


def random_texts(seed, n=60):
    chance = random.Random(seed)
    words = ["".join(chance.choice("abcdeé") for _ in range(chance.randint(1, 7))) for _ in range(150)]
    passages = [" ".join(chance.choice(words) for _ in range(chance.randint(3, 14))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [" ".join(chance.choice(words) for _ in range(chance.randint(0, 25))) for _ in range(3)]
        for _ in range(chance.randint(0, 2)):
            parts.insert(chance.randint(0, len(parts)), chance.choice(passages))
        texts.append(" ".join(parts))
    texts += texts[:5] + ["a" * 300, "ab" * 120, "abc" * 50, "z" * 39, "z" * 40]
    edited = list(texts[7])
    if edited:
        edited[len(edited) // 2] = "#"
    return texts + ["".join(edited)]


@pytest.mark.parametrize("seed,large", [(1, 2048), (2, 2048), (3, 1)])
def test_all_windows_of_small_texts(spark, seed, large):
    texts = random_texts(seed)
    docs = documents(spark, [(i, t, "a") for i, t in enumerate(texts)]).repartition(3)
    rows = {r["doc_id"]: r for r in without_repeats(docs, length=40, large=large).collect()}
    for i, want in enumerate(plain(texts, 40)):
        r = rows[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want, texts[i]
        assert sum(b - a for a, b in r["spans"]) == r["n_removed"]


def test_awkward_rows(spark):
    rows = AWKWARD + [(20, "A" * 399, "a"), (21, "A" * 400, "a"), (22, "B" * 401, "a"), (23, "y" * 1_000_000, "a")]
    got = without_repeats(documents(spark, rows), digests=True).collect()
    want = plain([t for i, t, _ in rows if i != 23], LENGTH) + [(1_000_000, 1_000_000, 1, b"")]
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted(
        (n, gone, spans, hashlib.sha256(kept).hexdigest()) for n, gone, spans, kept in want)
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _, _ in rows)
    assert without_repeats(documents(spark, []), digests=True).count() == 0


def test_many_documents_share_a_passage(spark):
    chance = random.Random(8)
    passage = (LINE * 6)[:420]

    def filler():
        return "".join(chance.choice("abcdefghij ") for _ in range(500))

    texts = [filler() + passage + filler() for _ in range(300)]
    for large in (10, suffix_dedup.LARGE):
        docs = documents(spark, [(i, t, "a") for i, t in enumerate(texts)])
        rows = sorted(without_repeats(docs, large=large).collect())
        assert [(r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows] == plain(texts, LENGTH)


def test_query_equals_all_windows(spark):
    from gaugewright.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = {r["doc_id"]: r for r in QUERIES["op1_suffix_dedup"](spark, "/root/testdata/sf0.001").collect()}
    assert len(rows) == len(docs)
    for d, (n, gone, spans, kept) in zip(docs, plain([d["text"] for d in docs], LENGTH)):
        r = rows[d["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (n, gone, spans)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    assert any(r["n_removed"] for r in rows.values())
