"""Toxicity by a weighted finite-state pattern grammar.

A lexical step turns every word into a symbol: insult, threat, target, negation, reported speech, intent, harm, other, and the
end of a clause. Small transducers over these symbols are composed into one machine that is run over each clause: an intent
makes a threat of a harmful act that follows it within a few words, negation
rewrites what follows it within a few words, reported speech what follows it in the clause, the target
transducer marks an insult or threat in a clause that also addresses someone. The machine's outputs are matched
patterns, not words; their weights give the text's score.

Insult words come from a short list and from labels: stems and words that toxic texts of the sample have far more often
than others, by log-likelihood ratio. Pattern weights are fitted by logistic regression, near prior weights, on
half of the sample with the words learned from the other half, so they do not trust words too much. The sample has
about ``TRAIN_DOCUMENTS`` labelled rows and the lexicon at most ``LEXICON`` entries; both bound what is broadcast. Scoring
is one pass without a shuffle over whole texts.

Defined cases: a NULL or empty text has no pattern and gets the score of such texts. NULL labels teach nothing;
a document with several labels is toxic if one says so. Without labels the prior weights hold. Repeated
rows are scored alike. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gaugewright.llm.common import map_batches, stage
from gaugewright.llm.language import held_out

TRAIN_DOCUMENTS = 20_000
LEXICON = 5_000
STEMS = (4, 5, 6, 7, 8)  # lengths of word beginnings that may be learned
LEAST_DOCUMENTS = 4      # and as many different neighbourhoods
LEAST_PRECISION = 0.9
LEAST_RATIO = 8.0        # natural logarithm of the likelihood ratio; fitted weights make up for chance finds
THRESHOLD = 0.3
NEGATION_REACH = 3
INTENT_REACH = 6
REMEMBERED_TOKENS = 600_000
REMEMBERED_CLAUSES = 50_000

INSULT, THREAT, TARGET, NEGATION, REPORT, INTENT, HARM, OTHER, END = "ITPNRWHo|"

# Words of four languages.
INSULTS = frozenset(
    "idiot idiots moron morons imbecile imbeciles stupid scum loser losers bastard bastards worthless pathetic disgusting "
    "idioten dummkopf trottel arschloch abschaum versager "
    "imbécile abruti abrutis connard connards salaud crétin crétins "
    "idiota idiotas imbécil estúpido estúpida cabrón escoria".split())
THREATS = frozenset(
    "kill murder strangle töten umbringen ermorden erwürgen tuer assassiner étrangler matar asesinar estrangular".split())
INTENTS = frozenset(
    "will ll gonna going want should werde wirst wollen soll sollte vais allons veux voy vamos quiero".split())
HARMS = frozenset(
    "hurt hunt burn beat break destroy shoot stab punch cut crush smash verletzen verprügeln verbrennen schlagen zerstören "
    "blesser brûler frapper détruire casser herir quemar golpear destruir romper".split())
TARGETS = frozenset(
    "you your yours yourself youre ya du dich dir dein deine euch ihr tu toi te ton ta vous votre tú ti tus usted ustedes "
    "vosotros he she they him them".split())
NEGATIONS = frozenset(
    "not no never isn aren wasn don doesn didn nor neither nicht kein keine keinen nie niemals ne pas jamais aucun nunca "
    "jamás ningún tampoco".split())
REPORTS = frozenset(
    "said says wrote writes called claimed reported quoted sagte schrieb nannte behauptete dit écrit appelé dijo escribió "
    "llamó".split())

_WORD = re.compile(r"[^\W\d_]+|[.!?;:,()\[\]\"“”«»]")


class Transducer:
    """A deterministic transducer: ``step(state, symbol)`` gives the next state and the output symbol."""

    def __init__(self, start, step):
        self.start, self.step = start, step

    def then(self, other):
        """The composition: what this one puts out is read by ``other``."""

        def step(state, symbol):
            first, between = self.step(state[0], symbol)
            second, out = other.step(state[1], between)
            return (first, second), out

        return Transducer((self.start, other.start), step)

    def compiled(self, symbols):
        """The same machine as tables over its reachable states."""
        numbers, arcs, todo = {self.start: 0}, [], [self.start]
        while todo:
            state, todo = todo[0], todo[1:]
            row = {}
            for symbol in symbols:
                after, out = self.step(state, symbol)
                if after not in numbers:
                    numbers[after] = len(numbers)
                    todo.append(after)
                row[symbol] = (numbers[after], out)
            arcs.append(row)
        return arcs


def _threatened(left, symbol):
    """An act that hurts is a threat a few words after somebody's intent; by itself it is a word like any other."""
    if symbol == INTENT:
        return INTENT_REACH, OTHER
    if symbol == HARM:
        return left, THREAT if left else OTHER
    return max(0, left - 1), symbol


def _negation(left, symbol):
    if symbol == NEGATION:
        return NEGATION_REACH, symbol
    out = symbol + "-" if left and symbol in (INSULT, THREAT) else symbol
    return max(0, left - 1), out


def _reported(inside, symbol):
    if symbol == REPORT:
        return True, symbol
    return inside, symbol + "\"" if inside and symbol in (INSULT, THREAT) else symbol


def _directed(state, symbol):
    """``state``: the addressed, and the open insult or threat of the clause."""
    addressed, open_ = state
    if symbol == TARGET:
        return (True, None), open_ + ">" if open_ else symbol
    if symbol in (INSULT, THREAT):
        return (addressed, None if addressed else symbol), symbol + ">" if addressed else symbol
    return state, symbol


MACHINE = (
    Transducer(0, _threatened).then(Transducer(0, _negation)).then(Transducer(False, _reported))
    .then(Transducer((False, None), _directed)).compiled((INSULT, THREAT, TARGET, NEGATION, REPORT, INTENT, HARM, OTHER)))

# What the machine puts out, as features, with their prior weights. A directed insult that came before its
# target has been counted as plain already.
PATTERNS = {
    INSULT: 4.5, INSULT + ">": 6.0, INSULT + "-": 1.0, INSULT + "\"": 1.5, INSULT + "-\"": 0.5,
    THREAT: 2.0, THREAT + ">": 5.0, THREAT + "-": 0.5, THREAT + "\"": 0.5, THREAT + "-\"": 0.2,
}
_NUMBER = {pattern: i for i, pattern in enumerate(PATTERNS)}
PRIOR = np.array([*PATTERNS.values(), -3.5])  # and the score of a text without patterns
PRIOR_STRENGTH = 2.0


def clause_patterns(clause):
    """Numbers of the patterns that the machine finds in a clause of symbols."""
    state, found = 0, []
    for symbol in clause:
        state, out = MACHINE[state][symbol]
        if out in _NUMBER:
            found.append(_NUMBER[out])
    return found


def grams(word):
    """What may be learned of a word: itself and its beginnings."""
    return [word + "$", *[word[:n] for n in STEMS if n < len(word)]]


class Grammar:
    """A lexicon of insults and the patterns' weights."""

    def __init__(self, learned=(), weights=PRIOR):
        self.learned, self.weights, self.id = frozenset(learned), np.asarray(weights), uuid.uuid4().hex

    def symbol(self, word):
        if word in INSULTS or any(g in self.learned for g in grams(word)):
            return INSULT
        for words, symbol in ((THREATS, THREAT), (HARMS, HARM), (INTENTS, INTENT), (TARGETS, TARGET), (NEGATIONS, NEGATION),
                              (REPORTS, REPORT)):
            if word in words:
                return symbol
        return OTHER

    def symbols(self, token):
        """The symbols of a token: one for each word in it, and clause ends for punctuation."""
        return "".join(
            self.symbol(w) if w[0].isalpha() else END if w not in "()[]\"“”«»" else "" for w in _WORD.findall(token.lower()))


class _Symbols(dict):
    def __init__(self, grammar):
        super().__init__()
        self.grammar = grammar

    def __missing__(self, token):
        if len(self) >= REMEMBERED_TOKENS:
            self.clear()
        self[token] = symbols = self.grammar.symbols(token)
        return symbols


class Scorer:
    def __init__(self, grammar):
        self.grammar, self.symbols, self.clauses = grammar, _Symbols(grammar), {}

    def features(self, text):
        """For each pattern the logarithm of one plus its number in the text; then 1."""
        found = np.zeros(len(PATTERNS) + 1)
        found[-1] = 1.0
        symbols = "".join(map(self.symbols.__getitem__, (text or "").split()))
        if INSULT in symbols or THREAT in symbols or HARM in symbols:
            counts = found[:-1]
            for clause in symbols.split(END):
                if INSULT in clause or THREAT in clause or HARM in clause:
                    patterns = self.clauses.get(clause)
                    if patterns is None:
                        patterns = clause_patterns(clause)
                        if len(self.clauses) < REMEMBERED_CLAUSES:
                            self.clauses[clause] = patterns
                    for p in patterns:
                        counts[p] += 1
            np.log1p(counts, out=counts)
        return found

    def score(self, text):
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, float(self.features(text) @ self.grammar.weights)))))


_scorers = {}


def _scorer(grammar):
    if grammar.id not in _scorers:
        _scorers.clear()
        _scorers[grammar.id] = Scorer(grammar)
    return _scorers[grammar.id]


def sample(docs, labels, most=TRAIN_DOCUMENTS):
    """A staged table (text, toxic, half) of about ``most`` labelled texts, each once; halves by a hash of the text.

    ``docs`` (doc_id, text); ``labels`` (doc_id, toxic). The chosen labels, at most half as many again as ``most``, are
    broadcast; of the texts found, copies and repeated rows are one, and no more than that many are kept, by their hash.
    """
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    share = min(1.0, most / max(1, usable.count()))
    chosen = usable.where(
        F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    chosen = stage(
        chosen.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id").limit(int(1.5 * most)), "labels")
    found = stage(
        docs.where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
        .groupBy(F.xxhash64("text").alias("digest")).agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")), "sample")
    share = min(1.0, 1.5 * most / max(1, found.count()))
    kept = F.pmod(F.xxhash64("digest"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
    return found.where(kept).select("text", "toxic", F.pmod("digest", F.lit(2)).cast("int").alias("half"))


def _ratio(toxic, clean, rate):
    """Log-likelihood ratio of a gram's counts against the share ``rate`` of toxic texts; and its precision."""
    share = F.col(toxic) / (F.col(toxic) + F.col(clean))
    ratio = F.col(toxic) * F.log(share / rate) + F.when(
        F.col(clean) > 0, F.col(clean) * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    return ratio, share


def _by_part(counted, rate):
    """Grams that pass in one half or in both, with counts for each: part, gram, ratio."""
    parts = []
    for part, halves in ((0, (0,)), (1, (1,)), (2, (0, 1))):
        sums = {t: sum((F.col(f"n{h}{t}") for h in halves), F.lit(0)) for t in (0, 1)}
        found = counted.select(
            F.lit(part).alias("part"), "gram", sums[1].alias("toxic"), sums[0].alias("clean")
        ).where(f"toxic >= {LEAST_DOCUMENTS}")
        ratio, share = _ratio("toxic", "clean", rate)
        parts.append(found.withColumn("ratio", ratio).where(
            (share >= LEAST_PRECISION) & (F.col("ratio") >= LEAST_RATIO)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _pivoted(rows, value):
    return rows.groupBy("gram").agg(*[
        value(F.when((F.col("half") == h) & (F.col("toxic") == t), F.col("n"))).alias(f"n{h}{t}")
        for h in (0, 1) for t in (0, 1)]).na.fill(0)


def learned_words(rows, most=LEXICON):
    """{0, 1 or None for a half or all of the sample: grams of toxic texts}.

    First by texts that have the gram, counted in the tasks and summed; of what passes, at most ``2 * most``
    grams, the neighbouring words are counted: copies of one toxic text repeat all its words, but always
    between the same neighbours.
    """
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = {0: [], 1: [], None: []}
    if len(sizes) < 2:
        return out
    rate = sizes[1] / (sizes[0] + sizes[1])

    def words_of(text):
        return [w for w in _WORD.findall(text.lower()) if w[0].isalpha()]

    def count(batches):
        counts = Counter()
        for batch in batches:
            for text, toxic, half in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for gram in {g for w in set(words_of(text)) for g in grams(w)}:
                    counts[gram, half, toxic] += 1
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([k[2] for k in keys], pa.int32()), pa.array(list(counts.values()), pa.int64())],
            ["gram", "half", "toxic", "n"])

    texts = _pivoted(map_batches(rows, count, "gram string, half int, toxic int, n long"), F.sum)
    named = _by_part(texts, rate).groupBy("gram").agg(F.max("ratio").alias("ratio"))
    candidates = frozenset(
        r["gram"] for r in named.orderBy(F.desc("ratio"), "gram").limit(2 * most).collect())
    shared = rows.sparkSession.sparkContext.broadcast(candidates)

    def neighbours(batches):
        import xxhash

        wanted, known = shared.value, {}
        for batch in batches:
            found = set()
            known.clear()
            for text, toxic, half in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = ["", *words_of(text), ""]
                for before, word, after in zip(words, words[1:], words[2:]):
                    having = known.get(word)
                    if having is None:
                        known[word] = having = tuple(wanted.intersection(grams(word)))
                    for gram in having:
                        found.add((gram, half, toxic, xxhash.xxh3_64_intdigest(f"{before} {after}") >> 1))
            columns = list(zip(*found)) or [(), (), (), ()]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["gram", "half", "toxic", "n"])

    places = map_batches(rows, neighbours, "gram string, half int, toxic int, n long").distinct()
    passed = stage(_by_part(_pivoted(places, F.count), rate), "grams")
    for part in (0, 1, 2):
        best = passed.where(F.col("part") == part).orderBy(F.desc("ratio"), "gram").limit(most)
        out[None if part == 2 else part] = [r["gram"] for r in best.collect()]
    return out


def pattern_rows(rows, grammar):
    """Features and label of each sampled row, as an array."""
    shared = rows.sparkSession.sparkContext.broadcast(grammar)
    n = len(PATTERNS) + 1

    def featured(batches):
        for batch in batches:
            scorer = _scorer(shared.value)
            found = np.array([scorer.features(t) for t in batch.column(0).to_pylist()]).reshape(-1, n)
            counts = Counter(zip(map(tuple, found), batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([
                pa.array([list(f) for f, _ in counts], pa.list_(pa.float64())),
                pa.array([t for _, t in counts], pa.int32()), pa.array(list(counts.values()), pa.int64())],
                ["features", "toxic", "n"])

    found = map_batches(
        rows.select("text", "toxic"), featured, "features array<double>, toxic int, n long").collect()
    return (np.array([r["features"] for r in found]).reshape(-1, n),
            np.array([r["toxic"] for r in found], float), np.array([r["n"] for r in found], float))


def fit_weights(features, toxic, n, steps=50):
    """Logistic regression with a normal prior around ``PRIOR``, by Newton steps; no pattern speaks for clean text."""
    weights = PRIOR.copy()
    strength = np.full(len(PRIOR), PRIOR_STRENGTH)
    strength[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -500, 500)))
        gradient = features.T @ (n * (p - toxic)) + strength * (weights - PRIOR)
        curved = (features * (n * p * (1 - p))[:, None]).T @ features + np.diag(strength)
        step = np.linalg.solve(curved, gradient)
        weights -= step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        weights[:-1] = np.maximum(weights[:-1], 0.0)
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(docs, labels, most=TRAIN_DOCUMENTS):
    """A grammar learned from documents (doc_id, text) and labels (doc_id, toxic)."""
    rows = sample(docs, labels, most)
    words = learned_words(rows)
    parts = [pattern_rows(rows.where(F.col("half") == 1 - half), Grammar(words[half])) for half in (0, 1)]
    features, toxic, n = (np.concatenate([p[i] for p in parts]) for i in range(3))
    weights = fit_weights(features, toxic, n) if n.sum() else PRIOR
    return Grammar(words[None], weights)


def score(docs, grammar, text="text", columns=("doc_id",)):
    """``columns`` of ``docs`` with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)
    kept = docs.select(*columns)

    def scored(batches):
        for batch in batches:
            scorer = _scorer(shared.value)
            scores = [scorer.score(t) for t in batch.column(len(columns)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(columns))]
                + [pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32())],
                [*columns, "score", "predicted"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
    return map_batches(
        docs.select(*columns, F.col(text)), scored, ", ".join([*fields, "score double", "predicted int"]))


def toxicity(docs, labels, doc_id="doc_id", text="text"):
    """One row per document: doc_id, held_out, score, predicted. Learns labels of rows that are not held out."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       held_out(F.col(doc_id), 4, 2).alias("held_out"))
    known = labels.select("doc_id", "toxic").where(~held_out(F.col("doc_id"), 4, 2))
    grammar = fit(rows.select("doc_id", "text"), known)
    return score(rows, grammar, columns=("doc_id", "held_out"))
