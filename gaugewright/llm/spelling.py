"""Spelling variants of a corpus' words, found by Bloom-guided neighbourhoods.

Words are counted in the tasks first, so the shuffle carries one row per task and word. Each word of the vocabulary
then generates its deletions and its replacements by a later letter (an insertion is the other word's deletion,
and a replacement the other way is the other word's as well). The edits are probed against broadcast blocked Bloom filters of the
vocabulary, sharded by length; only positives are written out and meet the vocabulary in an exact join, which removes
what the filters let through. So every pair of near words is found once and no other pair is.

A word's hash is the exclusive-or of one 64-bit number per place and letter: an edit's hash comes from the word's
own in constant time, for a whole batch of words at once, and no edited string is built unless the filter knows it.

The filters of all lengths share one space of 64-bit blocks, ``BITS`` bits for each word, and at most ``FILTER_BYTES`` of it are
collected and broadcast at a time. A vocabulary that needs more is probed in several passes over those words whose
edits fall into the pass's range; nothing is dropped at any size.

Defined cases: a NULL text has no words; a NULL id counts as empty text in the rule of deletions. Repeated rows count as often as
they occur. Very long texts are read whole; very long words probe their edits piece by piece. Ties go to the
smaller word in code-point order. An empty table, or one without frequent words, gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gaugewright.llm.common import map_batches, stage
from gaugewright.operators.joins import same_key

LEAST_LENGTH = 5
LEAST_OCCURRENCES = 3
DELETE_ONE_IN = 97       # runs whose hash this divides lose a code point
TIMES_AS_FREQUENT = 2    # a form is at least so many times as frequent as its word

BITS = 24                # of filter for each word
SET_BITS = 5             # of a word within its block of 64
FILTER_BYTES = 32 << 20  # collected and broadcast at a time
LONG = 32                # words longer than this share a shard
KEYS_AT_ONCE = 300_000   # words that a task counts before it passes them on
PROBES_AT_ONCE = 1 << 20

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(run):
    """A run with A-Z in lower case, as UTF-8; other letters stay as they are."""
    return run.encode().lower()


def altered(run, start):
    """The run's word: lower case, less one code point where the hash says so.

    ``start`` is the CRC-32 of the document's id and a colon, from which the run's is carried on.
    """
    word = lowered(run)
    code = zlib.crc32(word, start)
    word = word.decode()
    if code % DELETE_ONE_IN:
        return word
    place = code % len(word)
    return word[:place] + word[place + 1:]


def word_counts(docs, doc_id="doc_id", text="text", least=LEAST_OCCURRENCES):
    """A staged table (word, n) of the words that are long and frequent enough."""

    def batch_of(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def count(batches):
        counts = Counter()
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = zlib.crc32(f"{name}:".encode())
                for run, n in Counter(_RUN.findall(body)).items():
                    if len(run) >= LEAST_LENGTH:
                        counts[altered(run, start)] += n
                if len(counts) >= KEYS_AT_ONCE:
                    yield batch_of(counts)
                    counts.clear()
        yield batch_of(counts)

    texts = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text")
    ).where(F.col("text").isNotNull())
    counted = map_batches(texts, count, "word string, n long").where(F.length("word") >= LEAST_LENGTH)
    return stage(counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "words")


def _mixed(values):
    """64-bit numbers that look random, from different small ones (the finishing steps of splitmix64)."""
    values = (values + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _numbers(first, last, letters):
    """The number of every letter at each place from ``first`` up to ``last``."""
    places = np.arange(first, last, dtype=np.uint64)[:, None] << np.uint64(8)
    return _mixed(places | letters[None, :].astype(np.uint64))


def hashes(words, shift=0):
    """For equally long words, as rows of letters: each letter's number, ``shift`` places on."""
    places = np.arange(words.shape[1], dtype=np.uint64) + np.uint64(shift)
    return _mixed((places << np.uint64(8))[None, :] | words.astype(np.uint64))


def by_length(words):
    """(indexes, letters as rows) for every length among ``words``; their letters are below U+0100."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        letters = "".join([words[i] for i in at]).encode("latin-1")
        yield at, np.frombuffer(letters, np.uint8).reshape(len(at), length)


class Layout:
    """Where the blocks of each length's filter begin in the common space of blocks."""

    def __init__(self, counts, bits=BITS):
        """``counts``: number of words by length, all above ``LONG`` under that length."""
        self.begin, self.blocks, self.total = {}, {}, 0
        for shard in sorted(counts):
            self.begin[shard], self.blocks[shard] = self.total, max(1, -(-counts[shard] * bits // 64))
            self.total += self.blocks[shard]

    def addresses(self, length, values):
        """The blocks of words' hashes, and the bits within."""
        shard = min(length, LONG)
        high = values >> np.uint64(32)
        block = (high * np.uint64(self.blocks[shard])) >> np.uint64(32)
        mask = np.zeros(len(values), np.uint64)
        for k in range(SET_BITS):
            mask |= np.uint64(1) << ((values >> np.uint64(6 * k)) & np.uint64(63))
        return block.astype(np.int64) + self.begin[shard], mask

    def has(self, length):
        return min(length, LONG) in self.begin

    def lengths(self, first, last):
        """The shards with blocks from ``first`` up to ``last``."""
        return [s for s in self.begin if self.begin[s] < last and self.begin[s] + self.blocks[s] > first]


def filter_blocks(words, layout):
    """(address, mask) of the vocabulary's filters, set bits of one block merged."""

    def masks(batches):
        for batch in batches:
            texts, found = batch.column(0).to_pylist(), []
            for _, letters in by_length(texts):
                values = np.bitwise_xor.reduce(hashes(letters), axis=1)
                found.append(layout.addresses(letters.shape[1], values))
            for address, mask in found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(address), pa.array(mask.view(np.int64))], ["address", "mask"])

    return (map_batches(words.select("word"), masks, "address long, mask long")
            .groupBy("address").agg(F.bit_or("mask").alias("mask")))


class Filter:
    """The blocks from ``first`` on, and a test for hashes. Blocks out of range say no: another pass has them."""

    def __init__(self, layout, first, blocks):
        self.layout, self.first, self.blocks = layout, first, blocks

    def test(self, length, values):
        if not self.layout.has(length) or not len(values):
            return np.zeros(len(values), bool)
        address, mask = self.layout.addresses(length, values)
        address -= self.first
        inside = (address >= 0) & (address < len(self.blocks))
        if inside.all():
            return (self.blocks[address] & mask) == mask
        found = np.zeros(len(values), bool)
        found[inside] = (self.blocks[address[inside]] & mask[inside]) == mask[inside]
        return found


def deletions(letters):
    """(row, place, hash) of every different word with one letter less."""
    n, length = letters.shape
    here, before = hashes(letters), np.zeros((n, length), np.uint64)
    np.bitwise_xor.accumulate(here[:, :-1], axis=1, out=before[:, 1:])
    moved, after = hashes(letters[:, 1:]), np.zeros((n, length), np.uint64)
    after[:, :-1] = np.bitwise_xor.accumulate(moved[:, ::-1], axis=1)[:, ::-1]
    # Within a run of one letter every deletion gives the same word; the last stands for all.
    different = np.ones((n, length), bool)
    different[:, :-1] = letters[:, :-1] != letters[:, 1:]
    row, place = np.nonzero(different)
    return row, place, (before ^ after)[row, place]


def replacements(letters, alphabet):
    """(row, place, letter, hash) of every word with one letter replaced by a later one of ``alphabet``, in pieces."""
    here = hashes(letters)
    whole = np.bitwise_xor.reduce(here, axis=1)
    step = max(1, PROBES_AT_ONCE // max(1, len(letters) * len(alphabet)))
    for first in range(0, letters.shape[1], step):
        part = letters[:, first:first + step]
        numbers = _numbers(first, first + part.shape[1], alphabet)
        row, place, letter = np.nonzero(part[:, :, None] < alphabet[None, None, :])
        values = (whole[:, None] ^ here[:, first:first + step])[row, place] ^ numbers[place, letter]
        yield row, place + first, alphabet[letter], values


def edits_known(words, known, alphabet):
    """(index, edit) of the edits of ``words`` that the filter ``known`` has."""
    for at, letters in by_length(words):
        length = letters.shape[1]
        rows = max(1, PROBES_AT_ONCE // (length * max(1, len(alphabet))))
        for first in range(0, len(at), rows):
            part, index = letters[first:first + rows], at[first:first + rows]
            row, place, values = deletions(part)
            hit = known.test(length - 1, values)
            for r, p in zip(row[hit].tolist(), place[hit].tolist()):
                word = words[index[r]]
                yield index[r], word[:p] + word[p + 1:]
            for row, place, letter, values in replacements(part, alphabet):
                hit = known.test(length, values)
                for r, p, c in zip(row[hit].tolist(), place[hit].tolist(), letter[hit].tolist()):
                    word = words[index[r]]
                    yield index[r], word[:p] + chr(c) + word[p + 1:]


def _positives(words, shared, alphabet):
    """(word, n, near): edits that the broadcast filter has."""

    def probe(batches):
        for batch in batches:
            texts, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            index, near = [], []
            for i, edit in edits_known(texts, shared.value, alphabet):
                index.append(i)
                near.append(edit)
            yield pa.RecordBatch.from_arrays(
                [pa.array([texts[i] for i in index], pa.string()),
                 pa.array(counts[np.array(index, np.int64)], pa.int64()), pa.array(near, pa.string())],
                ["word", "n", "near"])

    return map_batches(words.select("word", "n"), probe, "word string, n long, near string")


def near_pairs(words, bits=BITS, filter_bytes=FILTER_BYTES):
    """Every pair of near words of a staged table (word, n), once: word, n, near, near_n."""
    spark = words.sparkSession
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter"))
    # At most the letters of the rule for words, whatever the vocabulary.
    alphabet = np.array(sorted({ord(r["letter"]) for r in letters.distinct().collect()}), np.uint8)
    lengths = words.groupBy(F.least(F.length("word"), F.lit(LONG)).alias("shard")).count()
    layout = Layout({r["shard"]: r["count"] for r in lengths.collect()}, bits)
    vocabulary = words.select(F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    blocks = stage(filter_blocks(words, layout), "filters") if layout.total else None
    pairs = spark.createDataFrame([], "word string, n long, near string, near_n long")
    for first in range(0, layout.total, max(1, filter_bytes // 8)):
        last = min(layout.total, first + max(1, filter_bytes // 8))
        held = blocks.where((F.col("address") >= first) & (F.col("address") < last)).toArrow()
        table = np.zeros(last - first, np.uint64)
        table[held.column("address").to_numpy() - first] = held.column("mask").to_numpy().view(np.uint64)
        shared = spark.sparkContext.broadcast(Filter(layout, first, table))
        shards = layout.lengths(first, last)
        # A word's replacements are of its length, its deletions one letter shorter.
        able = words.where(F.least(F.length("word"), F.lit(LONG)).isin(shards)
                           | F.least(F.length("word") - 1, F.lit(LONG)).isin(shards))
        found = _positives(able, shared, alphabet).join(vocabulary, same_key(F.col("near"), F.col("near_word")))
        pairs = pairs.unionByName(stage(found.select("word", "n", "near", "near_n"), "pairs"))
    return pairs


def forms(words, pairs, times=TIMES_AS_FREQUENT):
    """Words that have near ones: word, n_near, and form and form_n, NULL where no near word is frequent enough."""
    both = pairs.unionByName(pairs.select(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    grouped = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best)
    enough = -F.col("best.less") >= times * F.col("n")
    return grouped.select(
        "word", "n_near", F.when(enough, F.col("best.form")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"))


def roots(formed, most_rounds=70):
    """(word, root): the last form from each word that has one, by doubling the steps in every round.

    Counts at least double from a word to its form, so chains are short and never closed.
    """
    found = stage(formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    for _ in range(most_rounds):
        further = found.select(F.col("word").alias("reached"), F.col("root").alias("further"))
        found = stage(
            found.join(further, same_key(F.col("root"), F.col("reached")), "left")
            .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "roots")
        if not found.where("moved").take(1):
            return found.select("word", "root")
        found = found.drop("moved")
    raise RuntimeError(f"roots did not settle in {most_rounds} rounds")


def spelling_variants(docs, doc_id="doc_id", text="text", bits=BITS, filter_bytes=FILTER_BYTES):
    """One row per frequent word of ``docs``: word, form, root, n, n_near, form_n."""
    words = word_counts(docs, doc_id, text)
    formed = stage(forms(words, near_pairs(words, bits, filter_bytes)), "forms")
    ends = roots(formed)
    named = formed.join(ends.withColumnRenamed("word", "rooted"), F.col("word") == F.col("rooted"), "left")
    named = named.select(F.col("word").alias("known"), "n_near", "form", "form_n", "root")
    return words.join(named, F.col("word") == F.col("known"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
