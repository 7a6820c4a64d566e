"""Suffix-array dedup: remove every byte inside a string of ``length`` bytes that starts elsewhere too.

1. *Anchors.* Each window of ``length`` bytes elects the leftmost of its ``gram``-byte strings of least
   hash. Equal windows elect the same place, so consecutive windows with one anchor form a run, and a
   window can only be repeated by a run whose anchor has the same hash. About one byte in 170 is an
   anchor; those with a hash of their own are dropped after one count.
2. *Classes.* Runs with equal bytes around the anchor (128-bit digest, anchor place included) are one
   class, counted with partial sums in the tasks: copies, however many, become one row. All
   windows of a class of two or more runs are repeated.
3. *Suffix sort.* Where a hash has several classes, one run of each brings its bytes. The suffixes at its
   window starts are mergesorted, compared by prefix polynomial hashes: a binary search finds the
   common extension in O(log length). Neighbours that agree over ``length`` bytes are verified byte by
   byte; where the check fails, the suffixes are sorted by their bytes. A hash with more than
   ``LARGE`` classes is too much for one task: its runs are cut into pieces, whose windows share all but a few
   bytes, and go by the hash of what they share; classes are formed again, and sorted again. What is still too
   large then, texts that differ just outside such a shared string, has its windows counted by 128-bit digest.
4. The spans come back to the texts by a key of the text, are merged and cut out.

Defined cases: a NULL text counts as empty. Texts shorter than ``length`` keep all bytes. Repeated rows
and equal texts of at least ``length`` bytes lose all their bytes, the first one too. Spans are in bytes
of UTF-8 and may cut a character. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gaugewright.llm.common import map_batches, stage, utf8
from gaugewright.operators.joins import same_key

LENGTH = 400
GRAM = 64
CHUNK = 2 << 20  # bytes looked at together
LARGE = 2048
PAIRS = 1 << 14  # neighbours verified at once

_BASE = 0x9E3779B97F4A7C15
_powers = {}


def _power(base, n):
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _powers[base] = known
    return known[:n]


class PrefixHash:
    """Polynomial hashes, modulo 2 ** 64, of any substring from sums over prefixes."""

    def __init__(self, data):
        n = len(data)
        self.data = data
        self.powers = _power(_BASE, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        inverse = _power(pow(_BASE, -1, 1 << 64), n)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * inverse, out=self.sums[1:])

    def of(self, start, length):
        return (self.sums[start + length] - self.sums[start]) * self.powers[start]

    def grams(self, length):
        """The hashes of all substrings of one length."""
        return (self.sums[length:] - self.sums[:-length]) * self.powers[:len(self.sums) - length]

    def common(self, a, b, most):
        """The length, at most ``most``, over which the suffixes at ``a`` and ``b`` agree."""
        reach = np.zeros(len(a), np.int64)
        step = 1 << (most.bit_length() - 1)
        while step:
            fits = np.flatnonzero(reach + step <= most)
            x, y = a[fits] + reach[fits], b[fits] + reach[fits]
            reach[fits[self.of(x, step) == self.of(y, step)]] += step
            step >>= 1
        return reach


def _scrambled(h):
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _sliding_least(keys, width):
    """The least of each ``width`` consecutive keys, from least values before and after block borders."""
    n = len(keys)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).reshape(-1)
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def runs_of(data, starts, ends, length=LENGTH, gram=GRAM):
    """The runs of the texts data[starts[i]:ends[i]], which follow each other without a gap.

    Arrays: text number, first and last window start and anchor (places in ``data``), anchor hash.
    """
    at = int(starts[0])
    data, starts, ends = data[at:int(ends[-1])], starts - at, ends - at
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none.astype(np.uint64)
    hashes = _scrambled(PrefixHash(data).grams(gram))
    keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (_sliding_least(keys, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    lengths = ends - starts
    text = np.repeat(np.arange(len(starts)), lengths)[:n - length + 1]
    inside = np.flatnonzero(np.arange(n - length + 1) + length <= ends[text])
    anchor, text = anchor[inside], text[inside]
    if not len(inside):
        return none, none, none, none, none.astype(np.uint64)
    new = np.flatnonzero(np.append(True, (np.diff(anchor) != 0) | (np.diff(text) != 0)))
    last = np.append(new[1:] - 1, len(inside) - 1)
    return text[new], inside[new] + at, inside[last] + at, anchor[new] + at, hashes[anchor[new]]


def _chunks(starts, ends, most):
    """Ranges of consecutive texts of about ``most`` bytes together."""
    first = 0
    for i in range(len(starts)):
        if i > first and ends[i] - starts[first] > most:
            yield first, i
            first = i
    if first < len(starts):
        yield first, len(starts)


ANCHORS = "t1 long, t2 int, s int, e int, off int, hash long, c1 long, c2 long"


def _anchors(length, gram):
    import xxhash

    def anchors(batches):
        for batch in batches:
            data, starts, ends = utf8(batch.column(2))
            view = memoryview(np.ascontiguousarray(data))
            for a, b in _chunks(starts, ends, CHUNK):
                text, s, e, p, h = runs_of(data, starts[a:b], ends[a:b], length, gram)
                if not len(text):
                    continue
                off = p - s
                digests = b"".join([
                    xxhash.xxh3_128_digest(view[i:j + length], o)
                    for i, j, o in zip(s.tolist(), e.tolist(), off.tolist())])
                digests = np.frombuffer(digests, "<i8").reshape(-1, 2)
                row = text + a
                base = starts[row]
                taken = pa.array(row)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(taken), batch.column(1).take(taken),
                    pa.array((s - base).astype(np.int32)), pa.array((e - base).astype(np.int32)),
                    pa.array(off.astype(np.int32)), pa.array(h.view(np.int64)),
                    pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                ], ["t1", "t2", "s", "e", "off", "hash", "c1", "c2"])

    return anchors


def suffix_order(prefix, places, first, size, length):
    """Mergesort of suffixes by their first ``length`` bytes, within segments.

    ``places`` holds the suffixes segment by segment; ``first`` and ``size`` give, for each, where its segment
    begins and how many it has. All segments are merged level by level: each suffix finds by binary search
    how many of the sibling run go before it. Returns the places in order.
    """
    order, here = places.copy(), np.arange(len(places))
    end, width = first + size, 1
    while width < (size.max() if len(size) else 0):
        run = (here - first) // width
        own, sibling = first + run * width, first + (run ^ 1) * width
        low = np.minimum(sibling, end)
        high = np.minimum(sibling + width, end)
        begin, later = low.copy(), (run & 1) == 1
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            x, y = order[middle], order[open_]
            reach = prefix.common(x, y, length)
            differ = reach < length
            step = np.minimum(reach, length - 1)
            before = np.where(differ, prefix.data[x + step] < prefix.data[y + step], later[open_])
            low[open_[before]] = middle[before] + 1
            high[open_[~before]] = middle[~before]
            open_ = open_[low[open_] < high[open_]]
        to = np.where(later, sibling, own) + (here - own) + (low - begin)
        merged = np.empty_like(order)
        merged[to] = order
        order, width = merged, width * 2
    return order


def repeated_windows(contexts, offsets, buckets, length=LENGTH):
    """For each context whether each of its windows occurs in another context of its bucket.

    A context is the bytes of a run; ``offsets`` says how far after its first window the anchor is. Equal
    windows have the anchor at the same place, so only those suffixes are sorted together.
    """
    data = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    base = np.cumsum(sizes) - sizes
    n_windows = sizes - length + 1
    row = np.repeat(np.arange(len(contexts)), n_windows)
    begin = np.cumsum(n_windows) - n_windows
    k = np.arange(len(row)) - begin[row]
    places = base[row] + k
    anchor = np.asarray(offsets)[row] - k
    by = np.lexsort((anchor, np.asarray(buckets)[row]))
    bucket, anchor = np.asarray(buckets)[row][by], anchor[by]
    new = np.append(True, (np.diff(bucket) != 0) | (np.diff(anchor) != 0))
    segment = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(by)))
    several = size[segment] > 1
    repeated = np.zeros(len(data) + 1, bool)
    by, segment = by[several], segment[several]
    if len(by):
        new = np.append(True, np.diff(segment) != 0)
        start = np.flatnonzero(new)
        count = np.diff(np.append(start, len(by)))
        within = np.cumsum(new) - 1
        prefix = PrefixHash(data)
        order = suffix_order(prefix, places[by], start[within], count[within], length)
        pair = np.flatnonzero(within[1:] == within[:-1])
        pair = pair[prefix.common(order[pair], order[pair + 1], length) == length]
        if _verified(data, order[pair], order[pair + 1], length):
            repeated[order[pair]] = repeated[order[pair + 1]] = True
        else:
            for a, b in zip(start, np.append(start[1:], len(by))):
                _mark_by_bytes(data, places[by[a:b]], length, repeated)
    flags = repeated[places]
    return np.split(flags, begin[1:])


def _verified(data, a, b, length):
    span = np.arange(length)
    return all(
        np.array_equal(data[a[i:i + PAIRS, None] + span], data[b[i:i + PAIRS, None] + span])
        for i in range(0, len(a), PAIRS))


def _mark_by_bytes(data, places, length, repeated):
    """What the sort by hashes does, after a collision, by comparing bytes."""
    texts = sorted((data[p:p + length].tobytes(), p) for p in places.tolist())
    for (x, p), (y, q) in zip(texts, texts[1:]):
        if x == y:
            repeated[p] = repeated[q] = True


def _spans(flags):
    """First and last of each stretch of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return edges[::2], edges[1::2] - 1


SPANS = "t1 long, t2 int, a int, b int"


def _span_batch(t1, t2, a, b):
    return pa.RecordBatch.from_arrays(
        [pa.array(t1, pa.int64()), pa.array(t2, pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32())],
        ["t1", "t2", "a", "b"])


def _sorted_spans(length):
    """Rows sorted by hash -> spans of the runs that stand for themselves alone."""

    def flush(rows):
        out = [[], [], [], []]
        if len(rows) > 1:
            # Only buckets with a run that is not settled yet are sorted.
            found = repeated_windows([r[6] for r in rows], [r[4] for r in rows], [r[0] for r in rows], length)
            for row, flags in zip(rows, found):
                if row[5] == 1 and flags.any():
                    for i, j in zip(*_spans(flags)):
                        for column, value in zip(out, (row[1], row[2], row[3] + int(i), row[3] + int(j) + length)):
                            column.append(value)
        return _span_batch(*out)

    def spans(batches):
        rows, held = [], 0
        for batch in batches:
            names = ("hash", "t1", "t2", "s", "off", "n", "context")
            for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names)):
                if held > CHUNK and row[0] != rows[-1][0]:
                    yield flush(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[6])
        yield flush(rows)

    return spans


PIECES = "hash long, c1 long, c2 long, t1 long, t2 int, s int, off int, n long, context binary"


def _pieces(length):
    """Runs -> pieces of windows whose anchors lie equally far on, by the hash of the bytes that all windows
    of the piece share. Equal windows fall into pieces of one hash, also where a text's end cuts a piece short."""
    import xxhash

    width = max(1, length // 16)

    def pieces(batches):
        for batch in batches:
            out = [[] for _ in range(9)]
            for t1, t2, s, off, n, context in zip(*(
                    batch.column(batch.schema.get_field_index(c)).to_pylist()
                    for c in ("t1", "t2", "s", "off", "n", "context"))):
                last = len(context) - length
                for number in range((off - last) // width, off // width + 1):
                    far = number * width  # windows whose anchor is far .. far + width - 1 bytes on
                    first, final = max(0, off - far - width + 1), min(last, off - far)
                    shared = context[off - far:off - far - width + 1 + length]
                    part = context[first:final + length]
                    digest = xxhash.xxh3_128_digest(part, off - first)
                    row = (xxhash.xxh3_64_intdigest(shared, far) - (1 << 63), int.from_bytes(digest[:8], "little", signed=True),
                           int.from_bytes(digest[8:], "little", signed=True), t1, t2, s + first, off - first, n, part)
                    for column, value in zip(out, row):
                        column.append(value)
            kinds = [pa.int64()] * 4 + [pa.int32()] * 3 + [pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)],
                ["hash", "c1", "c2", "t1", "t2", "s", "off", "n", "context"])

    return pieces


def _window_digests(length):
    import xxhash

    def digests(batches):
        for batch in batches:
            for t1, t2, s, off, n, context in zip(*(
                    batch.column(batch.schema.get_field_index(c)).to_pylist()
                    for c in ("t1", "t2", "s", "off", "n", "context"))):
                view = memoryview(context)
                m = len(context) - length + 1
                found = np.frombuffer(
                    b"".join([xxhash.xxh3_128_digest(view[k:k + length], off - k) for k in range(m)]),
                    "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(m, t1, np.int64)), pa.array(np.full(m, t2, np.int32)),
                    pa.array(np.arange(s, s + m, dtype=np.int32)), pa.array(np.full(m, n, np.int64)),
                    pa.array(found[:, 0]), pa.array(found[:, 1])], ["t1", "t2", "a", "n", "w1", "w2"])

    return digests


def _contexts(length):
    """(text, runs) -> one row per run with its bytes."""
    names = ["hash", "t1", "t2", "s", "off", "n", "classes"]

    def contexts(batches):
        for batch in batches:
            for text, t1, t2, runs in zip(*(batch.column(i).to_pylist() for i in range(4))):
                raw = text.encode()
                columns = [[r["hash"] for r in runs], [t1] * len(runs), [t2] * len(runs), [r["s"] for r in runs],
                           [r["off"] for r in runs], [r["n"] for r in runs], [r["classes"] for r in runs]]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)]
                    + [pa.array([raw[r["s"]:r["e"] + length] for r in runs], pa.binary())], [*names, "context"])

    return contexts


def repeated_spans(texts, length=LENGTH, gram=GRAM, large=LARGE):
    """A staged table (t1, t2, spans) of the repeated byte ranges of ``texts`` (t1, t2, text)."""
    anchors = stage(map_batches(texts.select("t1", "t2", "text"), _anchors(length, gram), ANCHORS), "anchors")
    twice = anchors.groupBy(F.col("hash").alias("again")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Copies of a text give the same runs: one row with their number, summed in the tasks first. Dealt out by
    # text and place, the runs of a frequent class come from all files, and its join can be split.
    shared = stage(
        anchors.join(twice, same_key(F.col("hash"), F.col("again")), "left_semi")
        .groupBy("t1", "t2", "s", "e", "off", "hash", "c1", "c2").agg(F.count(F.lit(1)).alias("copies")), "shared")
    classes = stage(
        shared.groupBy("hash", "c1", "c2").agg(
            F.sum("copies").alias("n"), F.min(F.struct("t1", "t2", "s", "e", "off")).alias("run")), "classes")
    whole = shared.join(classes.where("n > 1").select("hash", "c1", "c2"), ["hash", "c1", "c2"], "left_semi")
    whole = whole.select("t1", "t2", F.col("s").alias("a"), (F.col("e") + length).cast("int").alias("b"))

    # A hash all of whose classes are repeated needs no sort: nothing is left to settle there.
    counts = classes.groupBy(F.col("hash").alias("again")).agg(
        F.count(F.lit(1)).alias("classes"), F.count_if(F.col("n") == 1).alias("single"))
    mixed = (
        classes.join(counts.where("classes > 1 AND single > 0"), same_key(F.col("hash"), F.col("again")))
        .select("run.t1", "run.t2", F.struct("hash", "run.s", "run.e", "run.off", "n", "classes").alias("r"))
        .groupBy("t1", "t2").agg(F.collect_list("r").alias("runs")))
    once = texts.select("t1", "t2", "text").dropDuplicates(["t1", "t2"])
    contexts = stage(
        map_batches(
            once.join(mixed, ["t1", "t2"]).select("text", "t1", "t2", "runs"), _contexts(length),
            "hash long, t1 long, t2 int, s int, off int, n long, classes long, context binary"), "contexts")
    spans = whole.unionByName(_sorted(contexts.where(F.col("classes") <= large), length))
    spans = spans.unionByName(_large(contexts.where(F.col("classes") > large), length, large)).distinct()
    return stage(
        spans.groupBy("t1", "t2").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "spans")


def _sorted(contexts, length):
    return (
        contexts.repartition("hash").sortWithinPartitions("hash").mapInArrow(_sorted_spans(length), SPANS))


def _large(contexts, length, large):
    """Spans of runs whose anchor hash has too many classes for one task."""
    pieces = stage(map_batches(contexts, _pieces(length), PIECES), "pieces")
    size = F.octet_length("context")
    classes = stage(
        pieces.groupBy("hash", "c1", "c2").agg(
            F.sum("n").alias("n"), F.min(F.struct("t1", "t2", "s")).alias("run")), "classes")
    again = classes.where("n > 1").select(F.col("hash").alias("h"), F.col("c1").alias("d1"), F.col("c2").alias("d2"))
    whole = pieces.where("n = 1").join(
        again, same_key(F.col("hash"), F.col("h")) & (F.col("c1") == F.col("d1")) & (F.col("c2") == F.col("d2")),
        "left_semi").select("t1", "t2", F.col("s").alias("a"), (F.col("s") + size).cast("int").alias("b"))
    counts = classes.groupBy(F.col("hash").alias("again")).agg(
        F.count(F.lit(1)).alias("classes"), F.count_if(F.col("n") == 1).alias("single"))
    mixed = classes.join(
        counts.where("classes > 1 AND single > 0"), same_key(F.col("hash"), F.col("again"))
    ).select(F.struct("hash", "run.t1", "run.t2", "run.s").alias("one"), F.col("n").alias("total"), "classes")
    chosen = stage(
        pieces.withColumn("one", F.struct("hash", "t1", "t2", "s")).join(mixed, "one")
        .select("hash", "t1", "t2", "s", "off", F.col("total").alias("n"), "classes", "context"), "contexts")
    few = _sorted(chosen.where(F.col("classes") <= large), length)
    windows = map_batches(
        chosen.where(F.col("classes") > large), _window_digests(length),
        "t1 long, t2 int, a int, n long, w1 long, w2 long")
    often = windows.groupBy(F.col("w1").alias("v1"), F.col("w2").alias("v2")).agg(
        F.count(F.lit(1)).alias("times")).where("times > 1")
    many = windows.where("n = 1").join(
        often, same_key(F.col("w1"), F.col("v1")) & (F.col("w2") == F.col("v2")), "left_semi")
    many = many.select("t1", "t2", "a", (F.col("a") + length).cast("int").alias("b"))
    return whole.unionByName(few).unionByName(many)


def merged(spans):
    """Sorted, disjoint byte ranges that cover the same bytes."""
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def cut(raw, spans):
    """The bytes outside disjoint, sorted ranges."""
    at, parts = 0, []
    for a, b in spans:
        parts.append(raw[at:a])
        at = b
    parts.append(raw[at:])
    return b"".join(parts)


def without_repeats(docs, doc_id="doc_id", text="text", length=LENGTH, digests=False, large=LARGE):
    """One row per document: doc_id, n_bytes, n_removed, n_spans, and the removed ranges with the bytes that
    stay (``spans``, ``kept``) or, with ``digests``, their SHA-256 (``kept_sha256``)."""
    text = F.coalesce(F.col(text), F.lit(""))
    docs = docs.select(F.col(doc_id).alias("doc_id"), text.alias("text"))
    docs = docs.withColumns({"t1": F.xxhash64("text"), "t2": F.hash("text")})
    spans = repeated_spans(docs, length, GRAM if length >= 2 * GRAM else max(1, length // 4), large)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut_out(batches):
        for batch in batches:
            ids, texts, found = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            n_bytes, removed, kept, ranges = [], [], [], []
            for value, parts in zip(texts, found):
                raw = value.encode()
                parts = merged((p["a"], p["b"]) for p in parts or ())
                rest = cut(raw, parts)
                n_bytes.append(len(raw))
                removed.append(len(raw) - len(rest))
                kept.append(hashlib.sha256(rest).hexdigest() if digests else rest)
                ranges.append(parts)
            columns = [ids, pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
                       pa.array([len(r) for r in ranges], pa.int64()),
                       pa.array(kept, pa.string() if digests else pa.binary())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256" if digests else "kept"]
            if not digests:
                columns.append(pa.array(ranges, pa.list_(pa.list_(pa.int32()))))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(columns, names)

    out = "kept_sha256 string" if digests else "kept binary, spans array<array<int>>"
    return map_batches(
        docs.join(spans, ["t1", "t2"], "left").select("doc_id", "text", "spans"), cut_out,
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, {out}")
