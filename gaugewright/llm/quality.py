"""Quality rules, lines first.

Each line of a text is judged by rules for punctuation, navigation and boilerplate; failing lines
are removed, and a document that loses too much of its text that way is rejected. Beside this
stand counts over the whole text and the base limits on words and repetition.

Defined cases: a NULL text has no words and fails. An empty table gives no rows. Lines without a word are never judged and
weigh nothing. Repeated rows are judged alike, each by itself. Any length of text is taken whole.
One pass without a shuffle; a task holds one Arrow batch.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa

from gaugewright.llm.common import map_batches

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# The line rules; patterns mean the same to Python's re and to RE2.
MAX_SYMBOL_PERCENT = 30     # symbol characters for every 100 words of the line
MAX_SHOUT_PERCENT = 30      # runs of two or more ! or ? for every 100 words
MIN_SEPARATORS = 3          # stand-alone separators from which a line is a menu ...
MIN_SEPARATOR_PERCENT = 20  # ... if they make up this share of its words
SHOUT = r"[!?]{2,}"
SEPARATOR = r"(?:^|[\x20\x09-\x0D])[|>/\\~-]+(?:[\x20\x09-\x0D]|$)"
# Phrases of page furniture in four languages.
BOILERPLATE = (
    r"(?i)(?:all rights reserved|privacy policy|terms of (?:use|service)|cookie policy|accept cookies|"
    r"enable javascript|click here|sign up for|subscribe to|log in to|back to top|skip to content|"
    r"share this|read more|lorem ipsum|"
    r"alle rechte vorbehalten|impressum|datenschutzerklärung|nutzungsbedingungen|cookies (?:akzeptieren|zulassen)|"
    r"javascript aktivieren|hier klicken|jetzt anmelden|newsletter abonnieren|nach oben|zum inhalt springen|weiterlesen|mehr lesen|"
    r"tous droits réservés|politique de confidentialité|mentions légales|accepter les cookies|activer javascript|"
    r"cliquez ici|abonnez-vous|se connecter|haut de page|aller au contenu|lire la suite|"
    r"todos los derechos reservados|política de privacidad|aviso legal|términos de (?:uso|servicio)|aceptar (?:las )?cookies|"
    r"haga clic aquí|haz clic aquí|suscríbete|iniciar sesión|volver arriba|ir al contenido|leer más)"
)
MAX_BOILERPLATE_WORDS = 20  # a longer line only mentions the phrase

# A document is rejected if less than this share of its word characters is on passing lines.
MIN_KEPT_PERCENT = 50

_shout, _separator, _boilerplate = re.compile(SHOUT), re.compile(SEPARATOR), re.compile(BOILERPLATE)


def line_fails(line):
    """Why a line with a word is removed: ``punctuation``, ``navigation``, ``boilerplate``, or None."""
    raw = line.encode()
    n = len(raw.split())
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    separators = len(_separator.findall(line))
    if separators >= MIN_SEPARATORS and 100 * separators >= MIN_SEPARATOR_PERCENT * n:
        return "navigation"
    if 100 * symbols > MAX_SYMBOL_PERCENT * n:
        return "punctuation"
    if ("!" in line or "?" in line) and 100 * len(_shout.findall(line)) > MAX_SHOUT_PERCENT * n:
        return "punctuation"
    if n <= MAX_BOILERPLATE_WORDS and _boilerplate.search(line):
        return "boilerplate"
    return None


def _word_chars(text, raw):
    return len(text) - (len(raw) - len(raw.translate(None, SPACES)))


def repeated_words(words):
    """How many words lie in a window of three that is found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    total, reach = 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            total += at + 3 - max(at, reach)
            reach = at + 3
    return total


def measure(text):
    """The counts and both verdicts of one text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n_words, n_repeat = len(words), repeated_words(words)
    seen, n_dup, kept_chars, n_removed = set(), 0, 0, 0
    for line in text.split("\n"):
        line_raw = line.encode()
        if not line_raw.split(None, 1):
            continue
        if line in seen:
            n_dup += 1
        seen.add(line)
        if line_fails(line):
            n_removed += 1
        else:
            kept_chars += _word_chars(line, line_raw)
    word_chars = _word_chars(text, raw)
    base_failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": len(raw) - len(raw.translate(None, SYMBOLS)),
        "n_dup_lines": n_dup,
        "n_repeat_words": n_repeat,
        "base_failed": base_failed,
        "kept": not base_failed and 100 * kept_chars >= MIN_KEPT_PERCENT * word_chars,
        "n_removed_lines": n_removed,
        "kept_word_chars": kept_chars,
    }


def clean_text(text):
    """The text without its failing lines."""
    return "\n".join(
        line for line in (text or "").split("\n") if not line.encode().split(None, 1) or not line_fails(line)
    )


def quality_report(docs, doc_id="doc_id", text="text"):
    """One row per document: doc_id, the counts, base_failed and kept."""
    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    extra = ("n_removed_lines", "kept_word_chars")

    def report(batches):
        for batch in batches:
            found = [measure(t) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0)]
            columns += [pa.array([f[c] for f in found], pa.int64()) for c in counts]
            columns += [pa.array([f[c] for f in found], pa.bool_()) for c in ("base_failed", "kept")]
            columns += [pa.array([f[c] for f in found], pa.int64()) for c in extra]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *counts, "base_failed", "kept", *extra])

    fields = [f"doc_id {kind}", *[f"{c} long" for c in counts], "base_failed boolean", "kept boolean",
              *[f"{c} long" for c in extra]]
    return map_batches(docs.select(doc_id, text), report, ", ".join(fields))


def good_documents(docs, text="text"):
    """The rows of ``docs`` whose text passes, without its failing lines; all other columns unchanged."""

    def passing(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = batch.column(at).to_pylist()
            found = [measure(t) for t in texts]
            cleaned = [clean_text(t) if f["n_removed_lines"] else t for t, f in zip(texts, found) if f["kept"]]
            kept = batch.filter(pa.array([f["kept"] for f in found], pa.bool_()))
            columns = [*kept.columns[:at], pa.array(cleaned, batch.schema.field(at).type), *kept.columns[at + 1:]]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_batches(docs, passing, docs.schema)
