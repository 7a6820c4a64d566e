"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from gaugewright.llm import quality, spelling

EXACT_DEDUP = r"""
WITH digests AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       text_sha256
FROM digests
WINDOW same AS (PARTITION BY text_sha256)
"""

WARC = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
    FROM pages
), captures AS (
    SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest)
              ELSE page_id END AS response
    FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM captures
"""

QUALITY = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), worded AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts
), windows AS (
    SELECT row, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS three
    FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM worded WHERE len(words) >= 3)
), again AS (
    SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, three) > 1
), repeated AS (
    SELECT row, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY row
), split AS (
    SELECT row, unnest(string_split(text, chr(10))) AS line FROM texts
), lines AS (
    SELECT row, line,
           len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
           length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
           length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS symbols,
           len(regexp_extract_all(line, '{quality.SHOUT}')) AS shouts,
           len(regexp_extract_all(line, '{quality.SEPARATOR}')) AS separators,
           regexp_matches(line, '{quality.BOILERPLATE}') AS furniture
    FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), judged AS (
    SELECT row, chars,
           100 * symbols > {quality.MAX_SYMBOL_PERCENT} * n OR 100 * shouts > {quality.MAX_SHOUT_PERCENT} * n
           OR separators >= {quality.MIN_SEPARATORS} AND 100 * separators >= {quality.MIN_SEPARATOR_PERCENT} * n
           OR n <= {quality.MAX_BOILERPLATE_WORDS} AND furniture AS failed
    FROM lines
), summed AS (
    SELECT row, count(*) FILTER (failed) AS n_removed_lines, coalesce(sum(chars) FILTER (NOT failed), 0) AS kept_word_chars
    FROM judged GROUP BY row
), doubled AS (
    SELECT row, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY row
), measured AS (
    SELECT doc_id, len(words) AS n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(doubled.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
           coalesce(n_removed_lines, 0) AS n_removed_lines,
           coalesce(kept_word_chars, 0)::BIGINT AS kept_word_chars
    FROM worded LEFT JOIN repeated USING (row) LEFT JOIN doubled USING (row) LEFT JOIN summed USING (row)
), based AS (
    SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed
    FROM measured
)
SELECT *, NOT base_failed AND 100 * kept_word_chars >= {quality.MIN_KEPT_PERCENT} * word_chars AS kept FROM based
"""

RANKED_SEARCH = r"""
WITH worded AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), sized AS (
    SELECT count(*)::BIGINT AS documents, sum(len(terms))::BIGINT AS terms FROM worded WHERE len(terms) > 0
), wanted AS (
    SELECT DISTINCT item_id, term FROM (
        SELECT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark)
), postings AS (
    SELECT row, doc_id, n, term, count(*) AS tf
    FROM (SELECT row, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM worded)
    WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(sized.documents) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM postings, sized GROUP BY term
), impacts AS (
    SELECT row, doc_id, term,
           w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * sized.documents) // sized.terms))) AS impact
    FROM postings JOIN weights USING (term), sized
), scored AS (
    SELECT item_id, row, doc_id, sum(impact)::BIGINT AS score
    FROM wanted JOIN impacts USING (term) GROUP BY ALL HAVING sum(impact) > 0
)
SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score FROM scored
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST)
QUALIFY rank <= 50
"""

SPELLING = rf"""
WITH RECURSIVE steps AS (
    SELECT i::BIGINT AS byte, i::BIGINT AS code, 0 AS step FROM range(256) AS t(i)
    UNION ALL
    SELECT byte, CASE WHEN code % 2 = 1 THEN xor(code >> 1, 3988292384) ELSE code >> 1 END, step + 1 FROM steps WHERE step < 8
), crc_table AS (
    SELECT list(code ORDER BY byte) AS codes FROM steps WHERE step = 8
), runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM (SELECT coalesce(doc_id::VARCHAR, '') AS doc_id,
                 unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents)
    GROUP BY ALL
), hashed AS (
    SELECT run, n, xor(list_reduce(
        list_transform(string_split(doc_id || ':' || run, ''), lambda letter: unicode(letter)::BIGINT).list_transform(
            lambda code: CASE WHEN code < 128 THEN [code] ELSE [192 + (code >> 6), 128 + code % 64] END).flatten(),
        lambda crc, byte: xor(crc >> 8, codes[xor(crc % 256, byte) + 1]), 4294967295), 4294967295) AS h
    FROM runs, crc_table WHERE length(run) >= {spelling.LEAST_LENGTH}
), words AS (
    SELECT CASE WHEN h % {spelling.DELETE_ONE_IN} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
           ELSE run END AS word, sum(n)::BIGINT AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= {spelling.LEAST_LENGTH} AND sum(n) >= {spelling.LEAST_OCCURRENCES}
), gaps AS (
    SELECT word, left(word, i - 1) || '_' || substr(word, i + 1) AS gap, left(word, i - 1) || substr(word, i + 1) AS less
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), shorter AS (
    SELECT DISTINCT gaps.word, words.word AS near FROM gaps JOIN words ON gaps.less = words.word
), near AS (
    SELECT a.word, b.word AS near FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.word <> b.word
    UNION ALL SELECT word, near FROM shorter UNION ALL SELECT near, word FROM shorter
), best AS (
    SELECT near.word, count(*) AS n_near, max(words.n) AS best_n,
           min(near.near) FILTER (words.n = most.n) AS best_word
    FROM near JOIN words ON near.near = words.word
    JOIN (SELECT near.word, max(words.n) AS n FROM near JOIN words ON near.near = words.word GROUP BY 1) most
    ON near.word = most.word GROUP BY 1
), formed AS (
    SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN best_n >= {spelling.TIMES_AS_FREQUENT} * words.n THEN best_word END AS form,
           CASE WHEN best_n >= {spelling.TIMES_AS_FREQUENT} * words.n THEN best_n END AS form_n
    FROM words LEFT JOIN best USING (word)
), chain AS (
    SELECT word, word AS reached, 0 AS step FROM formed
    UNION ALL
    SELECT chain.word, formed.form, step + 1 FROM chain JOIN formed ON formed.word = chain.reached WHERE formed.form IS NOT NULL
), ends AS (
    SELECT word, arg_max(reached, step) AS root FROM chain GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""

ORACLES = {
    "op2_exact_dedup": EXACT_DEDUP,
    "op5_quality_rules": QUALITY,
    "op9_warc_index": WARC,
    "op12_ranked_search": RANKED_SEARCH,
    "op13_spelling_variants": SPELLING,
}
