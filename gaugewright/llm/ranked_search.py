"""Ranked lexical search of many items over all documents, by a hybrid of term-at-a-time and document-at-a-time.

One pass over the texts keeps, for each document, its length and the frequencies of the terms that any item has; the
numbers of documents and terms come from there. The second pass cuts each task's documents into shards of inverted
lists. For an item, a shard's short lists are summed term-at-a-time into accumulators. These are from then on one
list among the long ones, with a bound for each block of documents, and all are read document-at-a-time:
a block whose bounds do not add up to the score an entry needs is skipped, within a window of live blocks lists are read from the
highest bound down, and as soon as no document outside the candidates can make it, the lists are only probed for these.
The needed score is the last of the item's best so far, which a task carries from shard to shard, or of as many accumulators. A skipped document scores
strictly less than 50 others, so results are exact.

A task passes on its best for every item; these meet in two windows, the first one salted. Items come in blocks of at most
``BLOCK_TERMS`` terms (one item with more is a block of its own), whose terms are broadcast; each block is a pass over the documents.

Defined cases: a NULL or empty text has no terms; such documents do not count, and such items have no results. A repeated
document row ranks as often as it occurs. Rows of the item table with one id (or with a NULL id) are one item with the
terms of all of them. Equal scores go by ascending id, NULL last. Long texts are read whole. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gaugewright.llm.common import map_batches, stage

BEST = 50
BLOCK_TERMS = 500_000       # entries (item, term) of a block of items
SHARD_DOCUMENTS = 16_384
SHARD_POSTINGS = 4_000_000
BLOCK_BITS = 7              # a block is 128 documents
WINDOW_BLOCKS = 16          # read together
SHORT_SHARE = 4             # short lists together have at most one posting for so many documents
SALTS = 64

# What is not a term becomes a space; of letters, only A-Z are lowered. All bytes of other scripts belong to terms.
_TERMS = bytes(
    code + 32 if 65 <= code <= 90 else code if code >= 128 or 48 <= code <= 57 or 97 <= code <= 122 else 32
    for code in range(256))


def terms_of(text):
    """The terms of a text in order, as UTF-8."""
    return text.encode().translate(_TERMS).split()


def weight(n_documents, with_term):
    """A term's weight from the number of documents, and of those that have it."""
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * with_term + 1)))


def item_blocks(items, most=BLOCK_TERMS):
    """Blocks of (item id, its terms), streamed to the driver one after the other."""

    def found(batches):
        for batch in batches:
            pairs = {(i, t) for i, text in zip(*(batch.column(k).to_pylist() for k in (0, 1)))
                     for t in set(terms_of(text))}
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], batch.schema.field(0).type), pa.array([p[1] for p in pairs], pa.binary())],
                ["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    pairs = map_batches(items.where(F.col("text").isNotNull()), found, f"item_id {kind}, term binary").distinct()
    block, size, last, having = [], 0, None, []
    for row in stage(pairs.orderBy("item_id", "term"), "items").orderBy("item_id", "term").toLocalIterator():
        if having and row["item_id"] != last:
            if block and size + len(having) > most:
                yield block
                block, size = [], 0
            block.append((last, having))
            size += len(having)
            having = []
        last = row["item_id"]
        having.append(bytes(row["term"]))
    if having:
        if block and size + len(having) > most:
            yield block
            block = []
        block.append((last, having))
    if block:
        yield block


def forward_index(docs, vocabulary):
    """A staged table (doc_id, n, terms, counts): every document with a term, and the numbers of those in ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def index(batches):
        number = shared.value.get
        for batch in batches:
            rows, lengths, ends, terms, counts = [], [], [0], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                words = terms_of(text)
                if words:
                    found = Counter(map(number, words))
                    found.pop(None, None)
                    terms.extend(found)
                    counts.extend(found.values())
                    rows.append(row)
                    lengths.append(len(words))
                    ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))], ["doc_id", "n", "terms", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    return stage(map_batches(
        rows, index, f"doc_id {kind}, n long, terms array<int>, counts array<long>"), "forward")


class Shard:
    """Inverted lists of some documents; document numbers ascend in each, and their impacts are the terms' parts of the score."""

    def __init__(self, norms, lengths, terms, counts, weights):
        """By document: ``norms`` (m) and the ``lengths`` of its stretch of ``terms`` and ``counts``. ``weights`` by term."""
        self.size = len(norms)
        docs = np.repeat(np.arange(self.size), lengths)
        order = np.argsort(terms, kind="stable")
        terms, counts, self.docs = terms[order], counts[order], docs[order]
        self.impacts = weights[terms] * (1_000_000_000 * counts // (1000 * counts + 20 * norms[self.docs]))
        self.starts = np.searchsorted(terms, np.arange(len(weights) + 1))
        # The highest impact in every block that a list has.
        blocks = self.docs >> BLOCK_BITS
        fresh = np.flatnonzero(np.r_[True, (terms[1:] != terms[:-1]) | (blocks[1:] != blocks[:-1])][:len(terms)])
        self.blocks = blocks[fresh]
        self.highest = np.maximum.reduceat(self.impacts, fresh) if len(fresh) else self.impacts
        self.block_starts = np.searchsorted(fresh, self.starts)

    def posting(self, term):
        part = slice(self.starts[term], self.starts[term + 1])
        bounds = slice(self.block_starts[term], self.block_starts[term + 1])
        return self.docs[part], self.impacts[part], self.blocks[bounds], self.highest[bounds]


def summed(postings):
    """The accumulators of some lists, in the form of a list."""
    docs = np.concatenate([p[0] for p in postings])
    order = np.argsort(docs, kind="stable")
    docs, impacts = docs[order], np.concatenate([p[1] for p in postings])[order]
    fresh = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
    docs, impacts = docs[fresh], np.add.reduceat(impacts, fresh)
    blocks = docs >> BLOCK_BITS
    fresh = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
    return docs, impacts, blocks[fresh], np.maximum.reduceat(impacts, fresh)


class Best:
    """An item's best documents so far, and the score that an entry needs."""

    def __init__(self, most=BEST):
        self.most, self.entries, self.needed = most, [], 1

    def offer(self, ids, scores):
        """Documents with at least the needed score."""
        if len(scores) > self.most:
            last = np.partition(scores, len(scores) - self.most)[-self.most]
            chosen = np.flatnonzero(scores >= last)
            ids, scores = [ids[i] for i in chosen], scores[chosen]
        self.entries = sorted(
            self.entries + [(-s, i is None, i) for i, s in zip(ids, scores.tolist())],
            key=lambda e: (e[0], e[1], 0 if e[2] is None else e[2]))[:self.most]
        if len(self.entries) == self.most:
            self.needed = max(self.needed, -self.entries[-1][0])


def search(shard, ids, terms, best):
    """Offer ``best`` every document of the shard that can be among them. Returns the number of postings read."""
    lists = [p for p in map(shard.posting, terms) if len(p[0])]
    if not lists:
        return 0
    lists.sort(key=lambda p: len(p[0]))
    sizes = np.cumsum([len(p[0]) for p in lists])
    short = max(1, int(np.searchsorted(sizes, shard.size // SHORT_SHARE, "right")))
    lists = [summed(lists[:short]), *lists[short:]]
    read = int(sizes[short - 1])
    sums = lists[0][1]
    if len(sums) >= best.most:
        # So many documents score at least their accumulator, and all of them are still to be offered.
        best.needed = max(best.needed, int(np.partition(sums, len(sums) - best.most)[-best.most]))
    bounds = np.zeros((shard.size >> BLOCK_BITS) + 1, np.int64)
    for _, _, blocks, highest in lists:
        bounds[blocks] += highest
    lists.sort(key=lambda p: -int(p[3].max()))
    for first in range(0, len(bounds), WINDOW_BLOCKS):
        live = np.flatnonzero(bounds[first:first + WINDOW_BLOCKS] >= best.needed)
        if len(live):
            read += _window(lists, ids, (first + live[0]) << BLOCK_BITS, (first + live[-1] + 1) << BLOCK_BITS, best)
    return read


def _window(lists, ids, low, high, best):
    """Read documents ``low`` up to ``high`` of all lists together."""
    parts, highest, read = [], [], 0
    for docs, impacts, blocks, tops in lists:
        first, last = np.searchsorted(docs, (low, high))
        if first < last:
            near = slice(*np.searchsorted(blocks, (low >> BLOCK_BITS, high >> BLOCK_BITS)))
            parts.append((docs[first:last], impacts[first:last]))
            highest.append(int(tops[near].max()))
    rest, at = sum(highest), 0
    scores = np.zeros(high - low, np.int64)
    # While a document that no list has named yet could still be an entry, lists are read whole.
    while at < len(parts) and rest >= best.needed:
        docs, impacts = parts[at]
        scores[docs - low] += impacts
        rest, at, read = rest - highest[at], at + 1, read + len(docs)
    candidates = np.flatnonzero(scores + rest >= best.needed)
    scores = scores[candidates]
    for (docs, impacts), top in zip(parts[at:], highest[at:]):
        if not len(candidates):
            return read
        place = np.minimum(np.searchsorted(docs, candidates + low), len(docs) - 1)
        scores += np.where(docs[place] == candidates + low, impacts[place], 0)
        rest, read = rest - top, read + min(len(candidates), len(docs))
        able = scores + rest >= best.needed
        candidates, scores = candidates[able], scores[able]
    if len(candidates):
        best.offer([ids[i] for i in (candidates + low).tolist()], scores)
    return read


def _shards(batches, most_documents, most_postings):
    held, documents, postings = [], 0, 0
    for batch in batches:
        if held and (documents + len(batch) > most_documents or postings >= most_postings):
            yield pa.concat_batches(held)
            held, documents, postings = [], 0, 0
        held.append(batch)
        documents, postings = documents + len(batch), postings + len(batch.column(2).flatten())
    if held:
        yield pa.concat_batches(held)


def best_of_tasks(index, block, weights, n_documents, n_terms, kind, most=BEST):
    """(item_id, doc_id, score): each task's best documents of every item of ``block`` (item id, term numbers)."""
    shared = index.sparkSession.sparkContext.broadcast((block, weights))
    types = kind, index.schema["doc_id"].dataType
    arrow = [to_arrow_type(t) for t in types]

    def searched(batches):
        block, weights = shared.value
        best = [Best(most) for _ in block]
        for batch in _shards(batches, SHARD_DOCUMENTS, SHARD_POSTINGS):
            # Whole numbers of any size: the product can be beyond 64 bits before it is divided.
            norms = np.array([50 + 50 * n * n_documents // n_terms for n in batch.column(1).to_pylist()], np.int64)
            terms, counts = batch.column(2), batch.column(3)
            shard = Shard(
                norms, np.diff(terms.offsets.to_numpy()), terms.flatten().to_numpy(), counts.flatten().to_numpy(), weights)
            ids = batch.column(0).to_pylist()
            for (_, wanted), found in zip(block, best):
                search(shard, ids, wanted, found)
        rows = [(item, e[2], -e[0]) for (item, _), found in zip(block, best) for e in found.entries]
        for first in range(0, len(rows), 10_000):
            columns = zip(*rows[first:first + 10_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, [*arrow, pa.int64()])], ["item_id", "doc_id", "score"])

    return map_batches(
        index, searched, f"item_id {types[0].simpleString()}, doc_id {types[1].simpleString()}, score long")


def _first(rows, most, *keys):
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(
        F.col("rank") <= most)


def ranked(docs, items, most=BEST, block_terms=BLOCK_TERMS):
    """item_id, rank, doc_id, score: the ``most`` best of ``docs`` (doc_id, text) for each of ``items`` (item_id, text)."""
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType
    out = spark.createDataFrame([], f"item_id {kind.simpleString()}, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
    for block in item_blocks(items, block_terms):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in block for t in terms}))}
        index = forward_index(docs, vocabulary)
        size = index.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
        if not size["documents"]:
            break
        having = np.zeros(len(vocabulary), np.int64)
        for row in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            having[row["term"]] = row["count"]
        weights = np.array([weight(size["documents"], n) for n in having.tolist()], np.int64)
        numbered = [(item, [vocabulary[t] for t in terms]) for item, terms in block]
        found = best_of_tasks(index, numbered, weights, size["documents"], size["terms"], kind, most)
        out = out.unionByName(stage(found, "best"))
    # Tasks' best meet in two steps, so that no task gets the entries of all tasks for an item.
    salted = out.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    few = _first(salted, most, "item_id", "salt").drop("rank")
    return _first(few, most, "item_id").select("item_id", "rank", "doc_id", "score")
