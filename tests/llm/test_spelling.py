import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gaugewright.llm.oracle import ORACLES
from gaugewright.llm.queries import QUERIES
from gaugewright.llm.spelling import (
    LONG, Filter, Layout, by_length, deletions, edits_known, hashes, near_pairs, replacements, roots, spelling_variants,
)
from tests.compare import differences, duck
from tests.llm.rows import AWKWARD, documents

QUERY = "op13_spelling_variants"


def plain_words(rows):
    counts = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            code = zlib.crc32(f"{'' if name is None else name}:{word}".encode())
            if code % 97 == 0:
                place = code % len(word)
                word = word[:place] + word[place + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(rows):
    words, near = plain_words(rows), defaultdict(list)
    for a in words:
        for b in words:
            if abs(len(a) - len(b)) <= 1 and near_one(a, b):
                near[a].append(b)
    form = {}
    for word, n in words.items():
        best = min(near[word], key=lambda w: (-words[w], w), default=None)
        form[word] = best if best is not None and words[best] >= 2 * n else None
    out = {}
    for word, n in words.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out[word] = (form[word], root, n, len(near[word]), words.get(form[word]))
    return out


def as_dict(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


VARIANTS = [
    (1, "spelling " * 40 + "speling " * 9 + "spelin " * 4 + "spelinge " * 3 + "Spélling " * 3 + "ÿelling " * 3),
    (2, "colour " * 12 + "color " * 6 + "colours " * 6 + "cólour " * 3 + "COLOUR " * 2 + "  colourful " * 3),
    (3, "aaaaa " * 20 + "aaaaaa " * 10 + "aaaaaaa " * 4 + "×÷×÷× " * 3),
    (4, ("a" * (LONG + 9) + " ") * 8 + ("a" * (LONG + 8) + " ") * 3 + ("a" * (LONG + 7) + "b ") * 3),
    (None, "spelling colour"), (5, None), (6, ""), (6, ""), (7, "漢字 naïveté " * 5 + "naïvete " * 2 + "Naïvete"),
]


def test_equals_brute_force_on_awkward_rows(spark):
    rows = [(i, t, "s") for i, t, _ in AWKWARD] + [(i, t, "s") for i, t in VARIANTS] * 2
    got = as_dict(spelling_variants(documents(spark, rows)))
    want = expected([(i, t) for i, t, _ in rows])
    assert got == want
    assert any(form not in (None, root) for form, root, *_ in got.values())
    assert got["color"][0] == "colour" and got["aaaaaaa"][1] == "aaaaa"


@pytest.mark.parametrize("bits, filter_bytes", [(1, 1 << 20), (24, 64), (4, 200)])
def test_false_positives_and_passes_change_nothing(spark, bits, filter_bytes):
    rows = [(i, t, "s") for i, t in VARIANTS]
    got = as_dict(spelling_variants(documents(spark, rows), bits=bits, filter_bytes=filter_bytes))
    assert got == expected(VARIANTS)


def test_empty_tables(spark):
    assert spelling_variants(documents(spark, [])).collect() == []
    result = spelling_variants(documents(spark, [(1, None, "a"), (2, "too few words", "b")]))
    assert result.collect() == []
    assert result.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_edits_hash_like_the_words_they_make():
    words = ["aabbc", "abcde", "éaaaz"]
    alphabet = np.array(sorted({ord(c) for w in words for c in w}), np.uint8)
    (_, letters), = by_length(words)

    def plain(word):
        return int(np.bitwise_xor.reduce(hashes(np.frombuffer(word.encode("latin-1"), np.uint8)[None, :]), axis=1)[0])

    made = set()
    for row, place, value in zip(*(x.tolist() for x in deletions(letters))):
        edit = words[row][:place] + words[row][place + 1:]
        assert plain(edit) == value
        made.add((row, edit))
    assert made == {(r, w[:i] + w[i + 1:]) for r, w in enumerate(words) for i in range(5)}
    made = set()
    for part in replacements(letters, alphabet):
        for row, place, letter, value in zip(*(x.tolist() for x in part)):
            edit = words[row][:place] + chr(letter) + words[row][place + 1:]
            assert plain(edit) == value
            made.add((row, edit))
    assert made == {(r, w[:i] + chr(c) + w[i + 1:]) for r, w in enumerate(words) for i in range(5)
                    for c in alphabet.tolist() if c > ord(w[i])}


def test_filters_have_every_word_and_few_others():
    chance = np.random.default_rng(3)
    words = sorted({"".join(map(chr, row)) for row in chance.integers(97, 123, (20_000, 7))})
    layout = Layout({7: len(words)})
    (_, letters), = by_length(words)
    address, mask = layout.addresses(7, np.bitwise_xor.reduce(hashes(letters), axis=1))
    blocks = np.zeros(layout.total, np.uint64)
    np.bitwise_or.at(blocks, address, mask)
    known = Filter(layout, 0, blocks)
    assert known.test(7, np.bitwise_xor.reduce(hashes(letters), axis=1)).all()
    others = chance.integers(97, 123, (50_000, 7)).astype(np.uint8)
    assert known.test(7, np.bitwise_xor.reduce(hashes(others), axis=1)).mean() < 0.01
    # Only positives leave the task: far fewer than the edits.
    assert len(list(edits_known(words[:500], known, np.arange(97, 123, dtype=np.uint8)))) < 500 * 7 * 13 * 0.02


def test_pairs_come_once(spark):
    words = spark.createDataFrame([("abcde", 3), ("abcdf", 4), ("abcd", 9), ("abcdee", 5)], "word string, n long")
    found = sorted(tuple(sorted((r["word"], r["near"]))) for r in near_pairs(words).collect())
    assert found == [("abcd", "abcde"), ("abcd", "abcdf"), ("abcde", "abcdee"), ("abcde", "abcdf")]


def test_long_chains_of_forms(spark):
    chain = [(f"w{i:02}", f"w{i + 1:02}") for i in range(45)] + [("w45", None)]
    found = {r["word"]: r["root"] for r in roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert found == {f"w{i:02}": "w45" for i in range(45)}


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, sf_dir):
    assert differences(QUERIES[QUERY](spark, sf_dir), duck(sf_dir), ORACLES[QUERY]) is None
