"""Language ID of code-switched text by a linear-chain conditional random field.

Every word has a label, its language. Scores of a word come from its affixes, character n-grams and the lexicon
of frequent training words; learned transition weights tie neighbours together. Training maximises the
likelihood of spliced sequences (stretches of documents of different languages) with Adagrad on
forward-backward gradients. Prediction runs forward-backward over all words of a text; the text's
language is the one with the largest sum of word posteriors, the score its mean posterior.

The model is fitted on the driver on a bounded sample: ``TRAIN_DOCUMENTS`` different labelled texts in even shares by
language, or ``LEAST_OF_LANGUAGE`` of each if that is more, of each at most ``TRAIN_CHARS`` characters from the middle.
So a rare language is learned as well as its texts allow. The model's size is bounded by ``MOST_FEATURES`` times the number of languages, and it
is broadcast. Prediction is one pass without a shuffle over whole texts.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0, as are all texts if there is nothing to
learn from. Words without a letter carry no evidence and no vote. With one language learned, every other text is of it.
Repeated rows are predicted alike. An empty table gives no rows.
"""

from __future__ import annotations

import random
import re
import uuid
from collections import Counter
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gaugewright.llm.common import map_batches

TRAIN_DOCUMENTS = 3000
TRAIN_CHARS = 1200
LEAST_OF_LANGUAGE = 200  # texts of each language, if it has them, however many languages there are
RANGE = 1 << 40          # of the hashes that draw them
MOST_FEATURES = 60_000
LEXICON = 20_000        # words of the training sample that are features of their own
LEAST_COUNT = 3         # times a feature must occur in it
SEQUENCE = 64           # words of a training sequence
BATCH = 64              # sequences of a gradient step
EPOCHS = 4
RATE = 0.25
DECAY = 1e-6
UNKNOWN = "und"

REMEMBERED_TOKENS = 600_000
TOKENS_AT_ONCE = 50_000
WORDS_AT_ONCE = 400_000
BYTES_AT_ONCE = 16 << 20

_LETTER = re.compile(r"[^\W\d_]")
_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def core(token):
    """A token in lower case without what is not a letter at its ends; empty if it has no letter."""
    token = token.lower()
    return token if token.isalpha() else _EDGES.sub("", token)


def features(word):
    """Names of the features of a non-empty core word: itself, its affixes, its inner n-grams."""
    edged = f"<{word}>"
    n = len(edged)
    return [
        "=" + word, edged[:2], edged[:3], edged[:4], edged[:5], edged[-2:], edged[-3:], edged[-4:], edged[-5:],
        *[edged[i:i + 2] for i in range(1, n - 2)], *[edged[i:i + 3] for i in range(1, n - 3)]]


class Model:
    """Weights of a linear chain over ``languages``; ``index`` numbers the features."""

    def __init__(self, languages, index):
        k = len(languages)
        self.languages, self.index = languages, index
        self.weights = np.zeros((len(index) + 1, k), np.float32)  # the last row stays zero
        self.transitions = np.zeros((k, k))
        self.start = np.zeros(k)
        self.id = uuid.uuid4().hex

    def numbers(self, word):
        """Rows of ``weights`` for a word's features; the zero row for unknown ones and for no word."""
        zero = len(self.index)
        return list(map(self.index.get, features(word), repeat(zero))) if word else [zero]


def forward_backward(scores, transitions, start, lengths):
    """Posteriors of labels, and for training the summed posteriors of transitions and starts.

    ``scores`` has the word scores of all sequences one after the other, longest sequence first. All sequences
    advance together; at step t only those that have a word t take part.
    """
    lengths = np.asarray(lengths)
    base = np.cumsum(lengths) - lengths
    k = scores.shape[1]
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    potentials = np.exp(scores - scores.max(axis=1, keepdims=True))
    step = np.exp(transitions - transitions.max())
    alpha, scale = np.empty_like(potentials), np.empty(len(scores), potentials.dtype)
    now = potentials[base] * np.exp(start - start.max())
    for t, n in enumerate(active):
        at = base[:n] + t
        if t:
            now = (now[:n] @ step) * potentials[at]
        total = now.sum(axis=1)
        now = now / total[:, None]
        alpha[at], scale[at] = now, total
    posterior = np.empty_like(alpha)
    pairs = np.zeros((k, k))
    beta = np.ones((len(lengths), k), potentials.dtype)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = base[:n] + t
        posterior[at] = alpha[at] * beta[:n]
        if t:
            ahead = beta[:n] * potentials[at] / scale[at][:, None]
            pairs += (alpha[at - 1].T @ ahead) * step
            beta[:n] = ahead @ step.T
    posterior /= posterior.sum(axis=1, keepdims=True)
    return posterior, pairs, posterior[base].sum(axis=0)


def spliced(texts, seed=7):
    """Training sequences of (word, label): stretches of texts of random languages, several to a sequence."""
    chance = random.Random(seed)
    stretches = []
    for text, label in texts:
        words = [w for w in map(core, text.split()) if w]
        at = 0
        while at < len(words):
            n = chance.choice((6, 12, 24, 48))
            stretches.append([(w, label) for w in words[at:at + n]])
            at += n
    chance.shuffle(stretches)
    sequences, now = [], []
    for stretch in stretches:
        now += stretch
        if len(now) >= SEQUENCE:
            sequences.append(now[:SEQUENCE])
            now = now[SEQUENCE:]
    return sequences + ([now] if now else [])


def fit(texts, seed=7):
    """A model from (text, language) pairs; None if there are none with letters."""
    sequences = spliced(sorted(texts), seed)
    if not sequences:
        return None
    languages = sorted({label for s in sequences for _, label in s})
    words = Counter(w for s in sequences for w, _ in s)
    lexicon = {w for w, n in sorted(words.items(), key=lambda x: (-x[1], x[0]))[:LEXICON] if n >= LEAST_COUNT}
    counts = Counter()
    for word, n in words.items():
        for name in features(word):
            if name[0] != "=" or word in lexicon:
                counts[name] += n
    common = sorted((name for name, n in counts.items() if n >= LEAST_COUNT), key=lambda f: (-counts[f], f))
    model = Model(languages, {name: i for i, name in enumerate(common[:MOST_FEATURES])})
    if len(languages) > 1:
        _train(model, sequences, seed)
    return model


def _train(model, sequences, seed):
    chance = random.Random(seed)
    label_of = {name: i for i, name in enumerate(model.languages)}
    numbers = {w: np.array(model.numbers(w), np.int64) for s in sequences for w, _ in s}
    k = len(model.languages)
    gathered = np.full(model.weights.shape, 1e-6, np.float32)
    moved, begun = np.full((k, k), 1e-6), np.full(k, 1e-6)
    for _ in range(EPOCHS):
        chance.shuffle(sequences)
        for at in range(0, len(sequences), BATCH):
            batch = sorted(sequences[at:at + BATCH], key=len, reverse=True)
            rows = [numbers[w] for s in batch for w, _ in s]
            gold = np.array([label_of[label] for s in batch for _, label in s])
            lengths = [len(s) for s in batch]
            owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
            flat = np.concatenate(rows)
            scores = np.stack([
                np.bincount(owner, model.weights[flat, c], len(rows)) for c in range(k)], axis=1)
            posterior, pairs, starts = forward_backward(scores, model.transitions, model.start, lengths)
            error = posterior.copy()
            error[np.arange(len(gold)), gold] -= 1
            used, place = np.unique(flat, return_inverse=True)
            grad = np.stack([np.bincount(place, error[owner, c], len(used)) for c in range(k)], axis=1)
            grad = (grad + DECAY * model.weights[used]).astype(np.float32)
            gathered[used] += grad ** 2
            model.weights[used] -= RATE * grad / np.sqrt(gathered[used])
            model.weights[-1] = 0
            ends = np.cumsum(lengths)
            inner = np.setdiff1d(np.arange(1, len(gold)), ends[:-1])
            pairs -= np.bincount(gold[inner - 1] * k + gold[inner], minlength=k * k).reshape(k, k)
            starts = starts - np.bincount(gold[ends - lengths], minlength=k)
            moved += pairs ** 2
            begun += starts ** 2
            model.transitions -= RATE * pairs / np.sqrt(moved)
            model.start -= RATE * starts / np.sqrt(begun)


class _Numbers(dict):
    """Numbers tokens in the order in which they first come."""

    def __missing__(self, token):
        self[token] = n = len(self)
        return n


class Tagger:
    """Scores words and texts with a model; remembers the scores of tokens, up to a number."""

    def __init__(self, model):
        self.model = model
        self.forget()

    def forget(self):
        self.number, self.size = _Numbers(), 0
        self.scores = np.zeros((1024, len(self.model.languages)), np.float32)
        self.lettered = np.zeros(1024, bool)

    def _learn(self):
        """Score the tokens that have a number but no score yet."""
        tokens = list(islice(self.number, self.size, None))
        while len(self.number) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.lettered = np.concatenate([self.lettered, np.zeros_like(self.lettered)])
        for at in range(0, len(tokens), TOKENS_AT_ONCE):
            words = list(map(core, tokens[at:at + TOKENS_AT_ONCE]))
            rows = list(map(self.model.numbers, words))
            sizes = np.fromiter(map(len, rows), np.int64, len(rows))
            flat = np.fromiter(chain.from_iterable(rows), np.int64, int(sizes.sum()))
            to = slice(self.size, self.size + len(words))
            self.scores[to] = np.add.reduceat(self.model.weights[flat], np.cumsum(sizes) - sizes, axis=0)
            self.lettered[to] = list(map(bool, words))
            self.size += len(words)

    def _posteriors(self, texts):
        """For texts with words, longest first: posteriors of all words, and which words have a letter."""
        if self.size > REMEMBERED_TOKENS:
            self.forget()
        lengths = list(map(len, texts))
        ids = np.fromiter(map(self.number.__getitem__, chain.from_iterable(texts)), np.int64, sum(lengths))
        self._learn()
        posterior = forward_backward(
            self.scores[ids], self.model.transitions.astype(np.float32), self.model.start.astype(np.float32),
            lengths)[0]
        return posterior, self.lettered[ids]

    def words(self, text):
        """(token, language) of each word with a letter."""
        tokens = text.split()
        if not tokens:
            return []
        posterior, lettered = self._posteriors([tokens])
        best = posterior.argmax(axis=1)
        return [(t, self.model.languages[b]) for t, b, has in zip(tokens, best, lettered) if has]

    def texts(self, texts):
        """(language, score) of each text."""
        out = [(UNKNOWN, 0.0)] * len(texts)
        split = {i: t.split() for i, t in enumerate(texts) if t and _LETTER.search(t)}
        order = sorted(split, key=lambda i: -len(split[i]))
        at = 0
        while at < len(order):
            to, held = at, 0
            while to < len(order) and (to == at or held + len(split[order[to]]) <= WORDS_AT_ONCE):
                held += len(split[order[to]])
                to += 1
            part = [split[i] for i in order[at:to]]
            posterior, lettered = self._posteriors(part)
            begin = np.cumsum([0] + [len(t) for t in part[:-1]])
            votes = np.add.reduceat(posterior * lettered[:, None], begin, axis=0, dtype=np.float64)
            voters = np.add.reduceat(lettered.astype(np.int64), begin)
            for i, vote, n in zip(order[at:to], votes, voters):
                best = int(vote.argmax())
                out[i] = (self.model.languages[best], min(1.0, float(vote[best] / n)))
            at = to
        return out


def quotas(counts, most, least):
    """How many of each language's ``counts`` texts to take: even shares of ``most``, what a language lacks going to the
    others, and at least ``least``."""
    out, left, open_ = {}, most, len(counts)
    for lang, n in sorted(counts.items(), key=lambda x: (x[1], x[0])):
        out[lang] = min(n, max(least, left // open_))
        left, open_ = max(0, left - out[lang]), open_ - 1
    return out


def training_sample(docs, text="text", lang="lang", most=TRAIN_DOCUMENTS, chars=TRAIN_CHARS, least=LEAST_OF_LANGUAGE):
    """(text, language) pairs: of each language the different texts of smallest hash, by ``quotas``.

    At most ``max(most, least * languages)`` pairs. A text's copies count once, so neither they nor the order of
    files change the sample. Only hashes are shuffled, and the texts that are drawn.
    """
    digest = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(RANGE))
    half = F.greatest(F.lit(0), ((F.length("text") - chars) / 2).cast("int"))
    labelled = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        "lang", digest.alias("digest"), F.substring("text", half + 1, F.lit(chars)).alias("part"))
    counts = {r["lang"]: r["count"] for r in labelled.select("lang", "digest").distinct().groupBy("lang").count().collect()}
    if not counts:
        return []
    takes = quotas(counts, most, least)
    # Hashes spread evenly: below this bound are the quota's smallest, and a few more that the driver drops.
    bounds = [(name, RANGE if n == counts[name] else min(RANGE, int((n + 6 * n ** 0.5 + 6) / counts[name] * RANGE)))
              for name, n in takes.items()]
    bounds = docs.sparkSession.createDataFrame(bounds, "bound_lang string, bound long")
    drawn = (
        labelled.join(F.broadcast(bounds), (F.col("lang") == F.col("bound_lang")) & (F.col("digest") < F.col("bound")))
        .groupBy("lang", "digest").agg(F.min("part").alias("part")).collect())
    out, taken = [], Counter()
    for row in sorted(drawn):
        if taken[row["lang"]] < takes[row["lang"]]:
            taken[row["lang"]] += 1
            out.append((row["part"], row["lang"]))
    return out


_taggers = {}


def _tagger(model):
    if model.id not in _taggers:
        _taggers.clear()
        _taggers[model.id] = Tagger(model)
    return _taggers[model.id]


def predict(docs, model, text="text", columns=("doc_id",)):
    """``columns`` of ``docs`` with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*columns)

    def flush(held):
        model, batch = shared.value, pa.concat_batches(held)
        texts = batch.column(len(columns)).to_pylist()
        found = _tagger(model).texts(texts) if model else [(UNKNOWN, 0.0)] * len(texts)
        return pa.RecordBatch.from_arrays(
            [batch.column(i) for i in range(len(columns))]
            + [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            [*columns, "lang_pred", "score"])

    def predicted(batches):
        held = []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) >= BYTES_AT_ONCE:  # many texts together fill the steps of the chain
                yield flush(held)
                held = []
        if held:
            yield flush(held)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
    return map_batches(
        docs.select(*columns, F.col(text)), predicted, ", ".join([*fields, "lang_pred string", "score double"]))


def held_out(doc_id, parts, part):
    """Whether crc32 of the id's text leaves ``part`` modulo ``parts``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts == part


def languages(docs, doc_id="doc_id", text="text", lang="lang"):
    """One row per document: doc_id, held_out, lang_pred, score. Learns from rows that are not held out."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"),
                       held_out(F.col(doc_id), 3, 1).alias("held_out"))
    model = fit(training_sample(rows.where(~F.col("held_out"))))
    return predict(rows, model, columns=("doc_id", "held_out"))
