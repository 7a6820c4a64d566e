"""SimHash near-dedup by covering locality-sensitive hashing.

Each bit of a fingerprint gets a vector of radius + 1 bits, and each non-zero vector v of that length a table. The
table's mask keeps the bits whose vector is not orthogonal to v (mod 2). The vectors of at most ``radius`` differing bits
do not span the space, so some v is orthogonal to all of them; its mask keeps none of these bits, and the pair meets
in its table. No pair is missed.

Only distinct fingerprints enter the tables. Within a bucket a breadth-first search compares
fingerprints in blocks and gives one link for each fingerprint it reaches, so a bucket of n gives
at most n - 1 links, never all pairs. Crowded buckets are covered again over their free bits. Components come from alternating large-star and
small-star rounds, each written to the shared folder.

Defined cases: a NULL text counts as empty; texts without a word have fingerprint zero, and link
like any other. Documents with fewer words than a shingle have one, of all their words.
Long texts are read whole. Repeated rows share a fingerprint. An empty table gives no rows. The component's id is its smallest document id; NULL ids count only
where a component has no other.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gaugewright.llm.common import keep_keys, map_batches, row_key, stage
from gaugewright.operators.joins import same_key

SHINGLE = 4
RADIUS = 4
SEED = 42
BLOCK = 1 << 20  # fingerprint pairs compared at once
LARGEST_BUCKET = 20_000  # fingerprints that are searched together; more are dealt out over finer tables
LONG = 1 << 14   # shingles of a text whose bits are counted at once


def fingerprint(text, shingle=SHINGLE):
    """The 64-bit SimHash of a text, as an unsigned integer."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII white space are meant
    if not words:
        return 0
    whole = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    starts, ends = starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    hashes = np.array([digest(whole[a:b], SEED) for a, b in zip(starts, ends)], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), LONG):
        bits = np.unpackbits(hashes[at:at + LONG].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def covering_masks(radius=RADIUS, bits=64, seed=SEED):
    """The masks of all tables, as signed 64-bit integers.

    Every non-zero vector of radius + 1 bits is dealt out about equally often over the bit positions.
    """
    return _covering(range(bits), radius, seed)


def _covering(positions, radius, seed):
    positions = list(positions)
    vectors = [1 + i % (2 ** (radius + 1) - 1) for i in range(len(positions))]
    random.Random(seed).shuffle(vectors)
    masks = []
    for v in range(1, 2 ** (radius + 1)):
        mask = sum(1 << at for at, m in zip(positions, vectors) if (m & v).bit_count() % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def finer_masks(radius=RADIUS, bits=64, seed=SEED):
    """For every table its finer ones: (table, number, mask). The mask keeps the table's bits and covers its free ones.

    Fingerprints of one bucket that are within the radius differ in free bits only, so they meet in some finer bucket.
    """
    out = []
    for table, mask in enumerate(covering_masks(radius, bits, seed)):
        free = [i for i in range(bits) if not mask >> i & 1]
        for finer in _covering(free, radius, seed):
            out.append((table, len(out), mask | finer))
    return out


def bucket_links(values, radius):
    """Links that connect all fingerprints of a bucket that reach each other, as two arrays.

    Breadth-first: what the frontier reaches leaves the rest, so in a bucket of near copies few
    comparisons remain after the first step. The search starts at the fingerprint nearest to the majority bits.
    """
    left = np.unique(values)
    if len(left) > 2:
        bits = np.unpackbits(left.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        centre = np.packbits(2 * bits.sum(axis=0) > len(left), bitorder="little").view("<u8")[0]
        left = left[np.argsort(np.bitwise_count(left ^ centre), kind="stable")]
    sources, targets = [], []
    while len(left) > 1:
        frontier, left = left[:1], left[1:]
        while len(frontier) and len(left):
            parent = np.full(len(left), -1, np.int64)
            step = max(1, BLOCK // len(left))
            for at in range(0, len(frontier), step):
                open_ = np.flatnonzero(parent < 0)
                if not len(open_):
                    break
                near = np.bitwise_count(frontier[at:at + step, None] ^ left[None, open_]) <= radius
                reached = near.any(axis=0)
                parent[open_[reached]] = at + near[:, reached].argmax(axis=0)
            found = parent >= 0
            sources.append(frontier[parent[found]])
            targets.append(left[found])
            frontier, left = left[found], left[~found]
    if not sources:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(sources), np.concatenate(targets)


def near_links(fingerprints, radius=RADIUS, largest=LARGEST_BUCKET):
    """Links (a, b), a > b, that connect all distinct fingerprints within ``radius`` bits.

    ``fingerprints`` has one signed 64-bit column ``fingerprint`` without repeats. A bucket holds all that agree on its
    mask's bits, about 32, near each other or not. One of more than ``largest`` is not searched, which would be quadratic,
    but dealt out again over the finer tables of its free bits, where only those that agree on about 48 bits meet:
    65,536 at most or so. No link is lost, since the finer tables cover the radius too.
    """
    masks = covering_masks(radius)
    tables = F.explode(F.array(*[
        F.struct(F.lit(t).alias("table"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("kept"))
        for t, m in enumerate(masks)
    ])).alias("bucket")
    rows = fingerprints.select("fingerprint", tables).select("bucket.table", "bucket.kept", "fingerprint")
    found = stage(_searched(rows, radius, largest), "bucket-links")
    links = found.where("b IS NOT NULL").select("a", "b")
    crowded = found.where("b IS NULL").select("table", F.col("a").alias("fingerprint"))
    if crowded.take(1):
        finer = fingerprints.sparkSession.createDataFrame(finer_masks(radius), "of int, number int, mask long")
        # Some thousand rows at most, whatever the data.
        dealt = crowded.join(F.broadcast(finer), F.col("table") == F.col("of")).select(
            F.col("number").alias("table"), F.col("fingerprint").bitwiseAND(F.col("mask")).alias("kept"), "fingerprint")
        links = links.unionByName(_searched(dealt, radius, None).select("a", "b"))
    return links.distinct()


def _searched(rows, radius, largest):
    """(a, b, table) of rows (table, kept, fingerprint): links, and where b is NULL the members of buckets left out."""

    def left_out(table, values):
        yield pa.RecordBatch.from_arrays(
            [pa.array(values), pa.nulls(len(values), pa.int64()), pa.array(table)], ["a", "b", "table"])

    def search(batches):
        held, crowded = None, None
        for batch in batches:
            part = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)]
            if not len(part[0]):
                continue
            if crowded is not None:  # the bucket that goes on is left out whole
                same = (part[0] == crowded[0]) & (part[1] == crowded[1])
                yield from left_out(part[0][same], part[2][same])
                if same.all():
                    continue
                crowded, part = None, [column[~same] for column in part]
            if held is not None:
                part = [np.concatenate(pair) for pair in zip(held, part)]
            table, kept, values = part
            cut = np.flatnonzero((np.diff(table) != 0) | (np.diff(kept) != 0)) + 1
            last = int(cut[-1]) if len(cut) else 0  # the last bucket may go on in the next batch
            held = [column[last:] for column in part]
            yield from _buckets(table[:last], values[:last], cut[:-1] if len(cut) else cut)
            if largest and len(held[0]) > largest:
                yield from left_out(held[0], held[2])
                crowded, held = (held[0][0], held[1][0]), None
        if held is not None and len(held[0]):
            yield from _buckets(held[0], held[2], np.zeros(0, np.int64))

    def _buckets(table, values, cuts):
        starts, ends = np.append(0, cuts), np.append(cuts, len(values))
        if largest:
            for i in np.flatnonzero(ends - starts > largest):
                yield from left_out(table[starts[i]:ends[i]], values[starts[i]:ends[i]])
            few = ends - starts <= largest
            starts, ends = starts[few], ends[few]
        yield from _links(values, starts, ends, radius)

    return (
        rows.repartition("table", "kept").sortWithinPartitions("table", "kept")
        .mapInArrow(search, "a long, b long, table int")
    )


def _links(values, starts, ends, radius):
    """Links of the buckets of ``values`` from ``starts`` to ``ends``."""
    values = np.ascontiguousarray(values).view(np.uint64)
    several = np.flatnonzero(ends - starts > 1)
    found = [bucket_links(values[starts[i]:ends[i]], radius) for i in several]
    if not found:
        return
    a = np.concatenate([f[0] for f in found]).view(np.int64)
    b = np.concatenate([f[1] for f in found]).view(np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b)), pa.nulls(len(a), pa.int32())], ["a", "b", "table"])


def components(links, most_rounds=60):
    """(node, root) for every node of ``links`` (a > b); root is the least node it reaches.

    A large-star round hangs each node's larger neighbours under its least neighbour, a small-star
    round its smaller ones; they stop when a round changes nothing.
    """
    links, before = stage(links, "links"), None
    for _ in range(most_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b_least"))
        least = least.select("node", F.least("node", "b_least").alias("root"))
        large = (
            both.join(least, same_key(F.col("a"), F.col("node"))).where("b > a")
            .select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()
        )
        links = stage(large, "links")
        least = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        hung = links.join(least, same_key(F.col("a"), F.col("node")))
        small = (
            hung.where("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
            .unionByName(least.select(F.col("node").alias("a"), F.col("root").alias("b")))
            .where("a <> b").distinct()
        )
        links = stage(small, "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        before = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def simhash_rows(docs, doc_id="doc_id", text="text", shingle=SHINGLE):
    """A staged table with one row per document: doc_id, text_sha256 (NULL of NULL), fingerprint (signed)."""
    kind = docs.select(doc_id).schema[0].dataType.simpleString()

    def prints(batches):
        for batch in batches:
            values = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            column = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), column], ["doc_id", "row_key", "fingerprint"])

    keyed = docs.select(doc_id, text, row_key(F.col(doc_id), F.col(text)).alias("row_key"))
    return stage(
        map_batches(keyed, prints, f"doc_id {kind}, row_key string, fingerprint long"), "fingerprints")


def near_groups(docs, doc_id="doc_id", text="text", shingle=SHINGLE, radius=RADIUS):
    """One row per document: doc_id, fingerprint (hex), component_id, row_key, kept.

    ``kept`` holds for one document of each component, the one whose id the component bears (of repeated
    rows with equal texts, for all of them; they share a ``row_key``).
    """
    rows = simhash_rows(docs, doc_id, text, shingle)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first")
    nodes = stage(rows.groupBy("fingerprint").agg(first), "nodes")
    rooted = components(near_links(nodes.select("fingerprint"), radius))
    grouped = stage(
        nodes.join(rooted, F.col("fingerprint") == F.col("node"), "left")
        .select("fingerprint", F.coalesce("root", "fingerprint").alias("root"), "first"), "grouped")
    heads = grouped.groupBy("root").agg(F.min("first").alias("head"))
    named = stage(
        grouped.join(heads.withColumnRenamed("root", "head_root"),
                     same_key(F.col("root"), F.col("head_root"))).select("fingerprint", "head"), "named")
    hexed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return rows.join(named, "fingerprint").select(
        "doc_id",
        hexed.alias("fingerprint"),
        F.col("head.doc_id").alias("component_id"),
        "row_key",
        (F.col("row_key") == F.col("head.row_key")).alias("kept"),
    )


def near_dedup(docs, doc_id="doc_id", text="text", shingle=SHINGLE, radius=RADIUS):
    """``docs`` with one document of each component of near copies, all columns unchanged."""
    keys = near_groups(docs, doc_id, text, shingle, radius).where("kept")
    keys = keys.select(F.col("row_key").alias("key")).distinct()
    return keep_keys(docs, row_key(F.col(doc_id), F.col(text)), keys)
