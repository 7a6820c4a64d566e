"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages, stretches of ``PASSAGE_WORDS`` words that cover the whole text. Each passage is encoded: the mean of
learned vectors of its byte trigrams (letters folded) and of its runs of four character classes, and learned vectors of how often its words
repeat, through a tanh. Gated attention (tanh times sigmoid of two projections) gives each passage a weight among the document's passages, a
softmax makes them sum to one, and the weighted mean of the passages' vectors is the document's, which a logistic unit
scores. Labels are of documents only; which passages matter is learned with the rest, by Adam on hand-written gradients.

The model is fitted on the driver on a bounded sample: at most ``TRAIN_DOCUMENTS`` different labelled texts, in even shares by label as far as
there are so many, of each at most ``TRAIN_PASSAGES`` passages, spread over the whole text. Weights restore the labels' shares.
Its size is fixed (below 1 MB), and it is broadcast. Scoring is one pass without a shuffle over whole texts: attention needs
two numbers of each passage, so a text of any length takes bounded memory.

Defined cases: a NULL text counts as empty; an empty text, or one of white space, is one empty passage and gets the score that the
model gives to that. Without labels every score is 0.5; with labels of one value only, that value. Repeated
rows score alike; repeated labels of an id, and copies of a text with different labels, go by their mean. Repeated texts train once. An empty table gives no rows.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gaugewright.llm.common import map_batches, stage, utf8

TRAIN_DOCUMENTS = 4000
TRAIN_PASSAGES = 12
RANGE = 1 << 40           # of the hashes that draw them
PASSAGE_WORDS = 48
PASSAGE_BYTES = 1024      # a longer passage is cut there
TRIGRAM_BITS = 12
CLASS_BITS = 11
REPEATS = 9               # steps of the share of words that repeat within a passage
WIDTH = 24                # of a passage's vector
GATES = 12
SCALE = 24.0              # of the mean of a passage's vectors, so that one of its grams can be heard
REPEAT_SCALE = 8.0        # of the vector of its repeated words
DROPPED = 0.5             # share of the trigrams that a training step leaves out, so that texts are not learned by heart
EPOCHS = 6
BAGS = 48                 # of a training step
RATE = 0.004
DECAY = 1e-5
THRESHOLD = 0.5
BYTES_AT_ONCE = 1 << 19   # whose vectors are gathered together
PIECE = 1 << 20           # of a long text, cut into passages at once

_N_GRAMS = (1 << TRIGRAM_BITS) + (1 << CLASS_BITS)
PADDING = _N_GRAMS + REPEATS
FEATURES = PADDING + 1

# White space of the words; classes: small letters, capitals, digits, spaces, line ends, other bytes from 0x80 on, signs.
_SPACE = np.array([code == 32 or 9 <= code <= 13 for code in range(256)])
_FOLDED = np.array([code + 32 if 65 <= code <= 90 else code for code in range(256)], np.uint32)


def _class(code):
    if 97 <= code <= 122:
        return 0
    if 65 <= code <= 90:
        return 1
    if 48 <= code <= 57:
        return 2
    if code == 10:
        return 4
    if code <= 32 or code == 127:
        return 3
    if code >= 128:
        return 5
    return 6 + code % 58


_CLASSES = np.array([_class(code) for code in range(256)], np.uint32)


def passage_cuts(data):
    """Where the passages of a text (an array of bytes) start; at least one."""
    cuts, first = [], 0
    while True:
        piece = data[first:first + PIECE]
        space = _SPACE[piece]
        starts = np.flatnonzero(~space & np.r_[True, space[:-1]]) if len(piece) else np.zeros(0, np.int64)
        found = [0]
        for start in starts[PASSAGE_WORDS::PASSAGE_WORDS].tolist():
            found.extend(range(found[-1] + PASSAGE_BYTES, start, PASSAGE_BYTES))
            found.append(start)
        found.extend(range(found[-1] + PASSAGE_BYTES, len(piece), PASSAGE_BYTES))
        if first + len(piece) >= len(data):
            cuts.extend(first + c for c in found)
            return np.array(cuts, np.int64)
        # The last passage may go on in the next piece. One is never as long as a piece.
        cuts.extend(first + c for c in found[:-1])
        first += found[-1]


def gram_numbers(data, ends):
    """For each byte, the numbers of the trigram and of the run of classes that start there; ``ends`` of the texts.

    Grams do not reach over the end of a text: there, the number is that of nothing.
    """
    padded = np.zeros(len(data) + 3, np.uint8)
    padded[:len(data)] = data
    folded, classes = _FOLDED[padded], _CLASSES[padded]
    three = folded[:-3] | folded[1:-2] << np.uint32(8) | folded[2:-1] << np.uint32(16)
    four = classes[:-3] | classes[1:-2] << np.uint32(6) | classes[2:-1] << np.uint32(12) | classes[3:] << np.uint32(18)
    three = (three * np.uint32(2654435761)) >> np.uint32(32 - TRIGRAM_BITS)
    four = ((four * np.uint32(2654435761)) >> np.uint32(32 - CLASS_BITS)) + np.uint32(1 << TRIGRAM_BITS)
    for back in (1, 2, 3):
        at = ends - back
        at = at[at >= 0]
        four[at] = PADDING
        if back < 3:
            three[at] = PADDING
    return three.astype(np.int32), four.astype(np.int32)


def repeat_steps(data, cuts):
    """For each passage, which step of the share of its words that occur in it before."""
    space = _SPACE[data]
    before = np.r_[True, space[:-1]]
    before[cuts[cuts < len(data)]] = True
    starts = np.flatnonzero(~space & before)
    out = np.zeros(len(cuts), np.int64)
    if not len(starts):
        return out
    # A word's hash: its folded bytes, each mixed with its place in the word.
    word = np.cumsum(~space & before) - 1
    place = (np.arange(len(data)) - starts[np.maximum(word, 0)]).astype(np.uint64)
    mixed = (_FOLDED[data].astype(np.uint64) + (place << np.uint64(8))) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed[space] = 0
    hashes = np.add.reduceat(mixed, starts)
    passage = np.searchsorted(cuts, starts, "right") - 1
    order = np.lexsort((hashes, passage))
    again = (np.diff(passage[order], prepend=-1) == 0) & (np.diff(hashes[order], prepend=np.uint64(0)) == 0)
    words = np.bincount(passage, minlength=len(cuts))
    repeated = np.bincount(passage[order][again], minlength=len(cuts))
    return np.minimum(REPEATS - 1, repeated * REPEATS // np.maximum(1, words))


class Model:
    """Vectors of the features, and the parameters above them."""

    def __init__(self, seed=11, constant=None):
        made = np.random.default_rng(seed)
        self.id, self.constant = uuid.uuid4().hex, constant
        self.vectors = (made.standard_normal((FEATURES, WIDTH)) * 0.05).astype(np.float32)
        self.vectors[PADDING] = 0
        self.shift = np.zeros(WIDTH, np.float32)
        self.content = (made.standard_normal((WIDTH, GATES)) * 0.3).astype(np.float32)
        self.gate = (made.standard_normal((WIDTH, GATES)) * 0.3).astype(np.float32)
        self.attention = (made.standard_normal(GATES) * 0.3).astype(np.float32)
        self.out = (made.standard_normal(WIDTH) * 0.3).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    NAMES = ("vectors", "shift", "content", "gate", "attention", "out", "bias")

    def heads(self, encoded):
        """Attention before the softmax, and value, of encoded passages."""
        gated = np.tanh(encoded @ self.content) / (1 + np.exp(-(encoded @ self.gate)))
        return gated @ self.attention, encoded @ self.out

    def passages(self, data, cuts, ends):
        """Attention and value of every passage of some texts in ``data``; ``cuts`` start with 0."""
        if not len(data):
            encoded = np.tanh(REPEAT_SCALE * self.vectors[[_N_GRAMS] * len(cuts)] + self.shift)
            return self.heads(encoded)
        three, four = gram_numbers(data, ends)
        sums = np.zeros((len(cuts), WIDTH), np.float32)
        limits = np.r_[cuts, len(data)]
        filled = np.flatnonzero(limits[1:] > limits[:-1])
        first = 0
        while first < len(filled):
            last = max(first + 1, int(np.searchsorted(limits[filled], limits[filled[first]] + BYTES_AT_ONCE)))
            low, high = limits[filled[first]], limits[filled[min(last, len(filled)) - 1] + 1]
            gathered = self.vectors[three[low:high]] + self.vectors[four[low:high]]
            sums[filled[first:last]] = np.add.reduceat(gathered, limits[filled[first:last]] - low, axis=0)
            first = last
        lengths = np.maximum(1, limits[1:] - limits[:-1])[:, None]
        repeats = np.float32(REPEAT_SCALE) * self.vectors[_N_GRAMS + repeat_steps(data, cuts)]
        return self.heads(np.tanh(sums * (SCALE / lengths).astype(np.float32) + repeats + self.shift))


def score_of(attention, value, bias):
    """A document's probability from the attention and value of its passages."""
    weights = np.exp(attention - attention.max())
    logit = float(weights @ value / weights.sum()) + float(bias)
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def train(bags, labels, shares=None, seed=11):
    """A model of ``bags`` (lists of passages, as bytes) with labels of 0 and 1.

    ``shares`` are the labels' shares where the bags were drawn from.
    """
    labels = np.asarray(labels, np.float32)
    if not len(labels):
        return Model(constant=0.5)
    if labels.min() == labels.max():
        return Model(constant=float(labels[0]))
    drawn = labels.mean()
    positive = drawn if shares is None else shares
    weights = np.where(labels > 0, positive / drawn, (1 - positive) / (1 - drawn)).astype(np.float32)
    model, made = Model(seed), np.random.default_rng(seed)
    inputs = [_counted(bag) for bag in bags]
    first = {n: np.zeros_like(getattr(model, n)) for n in Model.NAMES}
    second = {n: np.zeros_like(getattr(model, n)) for n in Model.NAMES}
    steps, total = 0, EPOCHS * -(-len(bags) // BAGS)
    for _ in range(EPOCHS):
        order = made.permutation(len(bags))
        for at in range(0, len(order), BAGS):
            chosen = order[at:at + BAGS]
            heard = np.ones(FEATURES, np.float32)
            heard[:1 << TRIGRAM_BITS] = (made.random(1 << TRIGRAM_BITS) >= DROPPED) / (1 - DROPPED)
            gradients = _gradients(model, [inputs[i] for i in chosen], labels[chosen], weights[chosen], heard)
            steps += 1
            rate = RATE * (1 - steps / (total + 1))
            for name, gradient in gradients.items():
                value = getattr(model, name)
                gradient += DECAY * value
                first[name] += 0.1 * (gradient - first[name])
                second[name] += 0.001 * (gradient * gradient - second[name])
                moved = np.sqrt(second[name] / (1 - 0.999 ** steps)) + 1e-8
                value -= rate * first[name] / (1 - 0.9 ** steps) / moved
            model.vectors[PADDING] = 0
    return model


def _counted(bag):
    """(features, shares) of every passage of a bag."""
    out = []
    for passage in bag:
        data = np.frombuffer(passage, np.uint8)
        ends = np.array([len(data)])
        numbers = np.concatenate(gram_numbers(data, ends)) if len(data) else np.zeros(0, np.int32)
        features, counts = np.unique(numbers, return_counts=True)
        step = repeat_steps(data, np.zeros(1, np.int64))[0] if len(data) else 0
        out.append((
            np.r_[features, _N_GRAMS + step].astype(np.int32),
            np.r_[counts * (SCALE / max(1, len(data))), REPEAT_SCALE].astype(np.float32)))
    return out


def _gradients(model, bags, labels, weights, heard):
    """Gradients of the mean weighted loss of some bags; ``heard`` scales the features."""
    sizes = np.array([len(b) for b in bags])
    bag_of, starts = np.repeat(np.arange(len(bags)), sizes), np.cumsum(sizes) - sizes
    passages = [p for b in bags for p in b]
    given = np.zeros((len(passages), FEATURES), np.float32)
    for row, (features, shares) in enumerate(passages):
        given[row, features] = shares * heard[features]
    encoded = np.tanh(given @ model.vectors + model.shift)
    content, gate = np.tanh(encoded @ model.content), 1 / (1 + np.exp(-(encoded @ model.gate)))
    raw = (content * gate) @ model.attention
    raw = np.exp(raw - np.maximum.reduceat(raw, starts)[bag_of])
    weight = raw / np.add.reduceat(raw, starts)[bag_of]
    value = encoded @ model.out
    pooled = np.add.reduceat(weight * value, starts)
    predicted = 1 / (1 + np.exp(-np.clip(pooled + model.bias, -60, 60)))
    error = (weights * (predicted - labels) / len(bags)).astype(np.float32)
    by_passage = error[bag_of]
    to_value = by_passage * weight
    to_raw = to_value * (value - pooled[bag_of])
    to_gated = to_raw[:, None] * model.attention
    to_content = to_gated * gate * (1 - content * content)
    to_gate = to_gated * content * gate * (1 - gate)
    to_encoded = to_value[:, None] * model.out + to_content @ model.content.T + to_gate @ model.gate.T
    to_sum = to_encoded * (1 - encoded * encoded)
    return {
        "vectors": given.T @ to_sum, "shift": to_sum.sum(axis=0),
        "content": encoded.T @ to_content, "gate": encoded.T @ to_gate,
        "attention": (content * gate).T @ to_raw, "out": encoded.T @ to_value,
        "bias": np.array([error.sum()], np.float32),
    }


def training_bags(docs, labels, most=TRAIN_DOCUMENTS, passages=TRAIN_PASSAGES):
    """(bags, labels, share of label 1 in ``labels``): the bounded sample, the same for any order of files.

    ``docs`` (doc_id, text), ``labels`` (doc_id, quality). At most ``most`` ids of each label are drawn by their hash and broadcast;
    of the texts found, each once, the ``most`` of smallest hash are collected, half of each label if there are so many.
    """
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.avg(F.col("quality").cast("double")) >= 0.5).cast("int").alias("label"))
    usable = stage(usable, "labels")
    counts = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    if not counts:
        return [], [], 0.5
    usable = usable.withColumn("place", F.pmod(F.xxhash64("doc_id", F.lit("bags")), F.lit(RANGE)))
    drawn = []
    for label, n in sorted(counts.items()):
        # Hashes spread evenly: below this bound are the ``most`` smallest, and a few more.
        bound = min(RANGE, int((most + 6 * most ** 0.5 + 6) / n * RANGE))
        near = usable.where((F.col("label") == label) & (F.col("place") < bound))
        drawn.append(near.orderBy("place", "doc_id").limit(most).select(F.col("doc_id").alias("label_id"), "label"))
    chosen = stage(drawn[0] if len(drawn) == 1 else drawn[0].unionByName(drawn[1]), "drawn")

    def cut(batches):
        for batch in batches:
            data, starts, ends = utf8(batch.column(0))
            bags = []
            for start, end in zip(starts, ends):
                text = data[start:end]
                limits = np.r_[passage_cuts(text), len(text)]
                n = len(limits) - 1
                taken = np.unique(np.linspace(0, n - 1, min(n, passages)).astype(np.int64))
                bags.append([text[limits[i]:limits[i + 1]].tobytes() for i in taken])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(bags, pa.list_(pa.binary()))], ["digest", "label", "bag"])

    found = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select(
        F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("digest"), "label")
    bags = map_batches(found, cut, "digest long, label int, bag array<binary>").groupBy("digest").agg(
        (F.avg("label") >= 0.5).cast("int").alias("label"), F.min("bag").alias("bag"))
    bags = stage(bags, "bags")
    per_label = {r["label"]: r["count"] for r in bags.groupBy("label").count().collect()}
    takes = {label: max(min(n, most // 2), min(n, most - sum(per_label.values()) + n)) for label, n in per_label.items()}
    rows = [r for label, n in sorted(takes.items())
            for r in bags.where(F.col("label") == label).orderBy("digest").limit(n).collect()]
    rows.sort(key=lambda r: r["digest"])
    return [[bytes(p) for p in r["bag"]] for r in rows], [r["label"] for r in rows], counts.get(1, 0) / sum(counts.values())


def _scores(model, texts):
    """Scores of an Arrow array of texts; texts are encoded together up to a number of bytes, long ones in pieces."""
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    data, starts, ends = utf8(texts)
    out, first = np.zeros(len(texts)), 0
    while first < len(texts):
        if ends[first] - starts[first] > PIECE:
            out[first] = _score_long(model, data[starts[first]:ends[first]])
            first += 1
            continue
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + PIECE, "right")))
        low = starts[first]
        cuts = [passage_cuts(data[s:e]) for s, e in zip(starts[first:last], ends[first:last])]
        begins = np.cumsum([0] + [len(c) for c in cuts])
        joined = np.concatenate([c + s - low for c, s in zip(cuts, starts[first:last])])
        attention, value = model.passages(data[low:ends[last - 1]], joined, ends[first:last] - low)
        for i in range(last - first):
            part = slice(begins[i], begins[i + 1])
            out[first + i] = score_of(attention[part], value[part], model.bias[0])
        first = last
    return out


def _score_long(model, data):
    limits, found, first = np.r_[passage_cuts(data), len(data)], [], 0
    while first < len(limits) - 1:
        last = max(first + 1, int(np.searchsorted(limits[:-1], limits[first] + PIECE)))
        low, high = limits[first], limits[last]
        # A passage's last grams reach into the next one, as they do in a short text.
        reach = min(len(data), high + 3)
        cuts = limits[first:last + (reach > high)] - low
        ends = np.array([reach - low] if reach == len(data) else [], np.int64)
        attention, value = model.passages(data[low:reach], cuts, ends)
        found.append((attention[:last - first], value[:last - first]))
        first = last
    return score_of(*(np.concatenate(f) for f in zip(*found)), model.bias[0])


def score(docs, model, text="text", columns=("doc_id",)):
    """``columns`` of ``docs`` with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*columns)

    def scored(batches):
        for batch in batches:
            scores = _scores(shared.value, batch.column(len(columns)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(columns))]
                + [pa.array(scores, pa.float64()), pa.array((scores >= THRESHOLD).astype(np.int32))],
                [*columns, "score", "predicted"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
    return map_batches(
        docs.select(*columns, F.col(text)), scored, ", ".join([*fields, "score double", "predicted int"]))


def held_out(doc_id):
    """Whether crc32 of the id's text leaves 1 modulo 3; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def passage_quality(docs, labels, doc_id="doc_id", text="text"):
    """One row per document: doc_id, held_out, score, predicted. Learns labels of rows that are not held out."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out(F.col(doc_id)).alias("held_out"))
    known = labels.select("doc_id", "quality").where(~held_out(F.col("doc_id")))
    bags, found, share = training_bags(rows.select("doc_id", "text"), known)
    return score(rows, train(bags, found, share), columns=("doc_id", "held_out"))
