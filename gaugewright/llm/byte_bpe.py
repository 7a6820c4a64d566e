"""Byte-level BPE encoding and decoding.

Each match of the split pattern is merged by itself. A segment tree over its byte positions holds
the leftmost pair of lowest rank; a merge changes the pairs of the two live neighbours only, which
are point updates of logarithmic cost, so a match of any length is merged in O(n log n).
Merged matches are remembered up to a fixed number of bytes in each worker.

Defined cases: a NULL text counts as empty and gives no ids. Special tokens are ordinary text.
Repeated rows are encoded alike, each by itself, and texts of any length whole. An empty table gives no rows. One pass
without a shuffle.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from array import array

import pyarrow as pa

from gaugewright.llm.common import map_batches

# Of matches and their ids, in each Python worker; tasks that run in one worker share them.
REMEMBERED_BYTES = 160 << 20
# Above every rank.
NO_PAIR = 1 << 62


def read_ranks(path):
    """{token bytes: rank} of a ranks file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece, ranks):
    """The ids of one match's bytes."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    size = 1
    while size < n:
        size *= 2
    # tree[size + i]: rank of the pair that starts at byte i; an inner node holds the least of its two.
    tree = [NO_PAIR] * (2 * size)
    end = list(range(1, n + 1))     # end[i]: where the token that starts at i ends
    before = list(range(-1, n - 1))  # before[i]: where the token before it starts
    find = ranks.get
    for i in range(n - 1):
        tree[size + i] = find(piece[i:i + 2], NO_PAIR)
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left <= right else right

    def put(i, rank):
        node = size + i
        tree[node] = rank
        node //= 2
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            least = left if left <= right else right
            if tree[node] == least:
                break
            tree[node] = least
            node //= 2

    while tree[1] != NO_PAIR:
        least, node = tree[1], 1
        while node < size:  # ties go left
            node *= 2
            if tree[node] != least:
                node += 1
        i = node - size
        gone = end[i]
        end[i] = end[gone]
        if end[i] < n:
            before[end[i]] = i
        put(gone, NO_PAIR)
        put(i, find(piece[i:end[end[i]]], NO_PAIR) if end[i] < n else NO_PAIR)
        if before[i] >= 0:
            put(before[i], find(piece[before[i]:end[i]], NO_PAIR))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return ids


class _Merged(dict):
    """Ids of a match as little-endian unsigned 32-bit integers, merged on first use."""

    def __init__(self, ranks):
        super().__init__()
        self.ranks, self.held = ranks, 0

    def __missing__(self, match):
        ids = array("I", merge(match.encode(), self.ranks)).tobytes()
        if self.held > REMEMBERED_BYTES:
            self.clear()
            self.held = 0
        if len(ids) <= 1 << 12:
            self.held += len(match) + len(ids) + 220
            self[match] = ids
        return ids


class Codec:
    """Encodes texts to ids, as bytes, and back."""

    def __init__(self, ranks, pattern):
        import regex

        self.split = regex.compile(pattern)
        self.merged = _Merged(ranks)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def encode(self, text):
        found = self.merged
        return b"".join([found[m] for m in self.split.findall(text)])

    def decode(self, ids):
        return b"".join(map(self.tokens.__getitem__, array("I", ids)))


_codecs = {}


def _codec(shared, pattern):
    """The worker's codec for a broadcast vocabulary; a new vocabulary replaces it."""
    key = (shared.value["id"], pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(shared.value["ranks"], pattern)
    return _codecs[key]


def _shared(spark, ranks):
    return spark.sparkContext.broadcast({"id": uuid.uuid4().hex, "ranks": ranks})


def encode_documents(docs, ranks, pattern, doc_id="doc_id", text="text", digests=False):
    """One row per document: doc_id, n_tokens and ids, or with ``digests`` the SHA-256 of the ids
    and of the bytes that decoding them gives.

    ``ranks`` is a vocabulary of fixed size and is broadcast.
    """
    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    shared = _shared(docs.sparkSession, ranks)

    def encode(batches):
        codec = _codec(shared, pattern)
        for batch in batches:
            ids = [codec.encode(t or "") for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array([len(i) // 4 for i in ids], pa.int64())]
            if digests:
                columns += [
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(codec.decode(i)).hexdigest() for i in ids], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                columns.append(pa.array([array("I", i).tolist() for i in ids], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids"])

    out = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>"
    return map_batches(docs.select(doc_id, text), encode, f"doc_id {kind}, n_tokens long, {out}")


def decode_documents(encoded, ranks, ids="ids"):
    """``encoded`` with a binary column ``decoded``: the bytes of each row's ids; NULL ids give none."""
    from pyspark.sql import functions as F
    from pyspark.sql.functions import pandas_udf

    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    @pandas_udf("binary")
    def decoded(column):
        tokens = {rank: token for token, rank in shared.value.items()}
        return column.map(lambda row: b"".join(tokens[int(i)] for i in row) if row is not None else b"")

    return encoded.withColumn("decoded", decoded(F.col(ids)))
