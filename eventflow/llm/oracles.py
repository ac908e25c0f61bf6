"""The same results in DuckDB's SQL, where SQL can express them."""

from eventflow.llm.licenses import RULES, SAID, SEE, SENTENCES, pattern

OP10_EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""

OP6_DECONTAMINATION = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(list_slice(w, k, k + least(10, len(w)) - 1), ' ') AS phrase
  FROM (SELECT *, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS k FROM item_words WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, k, size, array_to_string(list_slice(w, k, k + size - 1), ' ') AS phrase
  FROM (SELECT *, unnest(generate_series(1, len(w) - size + 1)) AS k FROM words, sizes WHERE len(w) >= size)
), found AS (
  SELECT doc_id, item_id, k, p.size FROM places p JOIN windows n ON p.phrase = n.phrase AND p.size = n.size
), hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(generate_series(k, k + size - 1)) AS place FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP11_LEXICAL_SEARCH = r"""
WITH words AS (
  SELECT r, doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS r, * FROM documents)
), item_words AS (
  SELECT item, item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS item, * FROM benchmark)
), asked AS (SELECT item, item_id, term, count(*) AS times FROM item_words GROUP BY ALL
), lengths AS (SELECT r, count(*) AS n FROM words GROUP BY r
), totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths
), counted AS (
  SELECT r, doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, totals GROUP BY term, docs
), worth AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms))) AS v
  FROM counted JOIN lengths USING (r) JOIN weights USING (term), totals
), scores AS (
  SELECT item, item_id, r, doc_id, sum(v * times)::BIGINT AS score FROM worth JOIN asked USING (term) GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def _crc32_table() -> list[int]:
    """The checksum of each byte, by its polynomial."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    return table


OP12_SPELLING_VARIANTS = rf"""
WITH RECURSIVE runs AS (
  SELECT doc, run, count(*) AS times, hex(doc || ':' || run) AS written FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{{7,}}')) AS run
    FROM documents) GROUP BY ALL
), hashed AS (
  SELECT run, times, xor(list_reduce(
    list_transform(generate_series(1, length(written) - 1, 2), lambda k: ('0x' || substr(written, k, 2))::BIGINT),
    lambda crc, byte: xor(crc >> 8, list_extract({_crc32_table()}::BIGINT[], (xor(crc, byte) & 255) + 1)),
    4294967295::BIGINT), 4294967295) AS h FROM runs
), damaged AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times
  FROM hashed
), words AS (
  SELECT word, sum(times)::BIGINT AS n FROM damaged WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
), shorter AS (
  SELECT word, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest
  FROM (SELECT word, unnest(generate_series(1, length(word))) AS k FROM words)
), pairs AS (
  SELECT a.word, b.word AS other FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION SELECT s.word, w.word FROM shorter s JOIN words w ON s.rest = w.word
  UNION SELECT w.word, s.word FROM shorter s JOIN words w ON s.rest = w.word
), near AS (
  SELECT p.word, other, o.n AS other_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY o.n DESC, other) AS place
  FROM pairs p JOIN words o ON p.other = o.word
), forms AS (
  SELECT word, n, n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM words LEFT JOIN (SELECT * FROM near WHERE place = 1) USING (word)
), chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.root, f.n, coalesce(f.n_near, 0)::BIGINT AS n_near, f.form_n
FROM forms f JOIN chain c USING (word) JOIN forms e ON c.root = e.word WHERE e.form IS NULL
"""


def _licenses() -> str:
    """The rules one after the other; each takes its sentences away."""
    known = ", ".join(f"('{sentence}', '{name}')" for sentence, name in SENTENCES.items())
    steps = "".join(
        f"""), s{k + 1} AS (
  SELECT doc_id, r, sentence_ids, CASE WHEN regexp_matches(rest, '{pattern(rule)}')
         THEN list_append(names, '{name}') ELSE names END AS names,
         regexp_replace(rest, '{pattern(rule)}', ',', 'g') AS rest FROM s{k}
"""
        for k, (name, rule) in enumerate(RULES)
    )
    return rf"""
WITH v AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_replace(coalesce(text, ''),
    '\b([vV]|[vV]er)\.([\x20\x09-\x0D]+[0-9])', '\1' || chr(2) || '\2', 'g') AS text FROM documents
), d AS (
  SELECT doc_id, r, list_transform(string_split(regexp_replace(text,
    '([.!?;:])[\x20\x09-\x0D]+|\n[\x20\x09-\x0D]*\n', '\1' || chr(1), 'g'), chr(1)), lambda p: replace(p, chr(2), '.')) AS parts FROM v
), c AS (
  SELECT doc_id, r, flatten(list_transform(parts, lambda p: CASE WHEN contains(p, chr(10))
    THEN list_concat([p], string_split(p, chr(10))) ELSE [p] END)) AS parts FROM d
), e AS (
  SELECT r, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM c
), n AS (
  SELECT r, place, regexp_replace(regexp_replace(
    translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9.]+', ' ', 'g'),
    '^[ .]+|[ .]+$', '', 'g') AS sentence FROM e
), p AS (
  SELECT *, regexp_replace(regexp_replace(sentence, '{SAID}', 'licensed under '), '{SEE}', '') AS plain FROM n
), k(sentence, name) AS (VALUES {known}
), f AS (
  SELECT r, string_agg(coalesce(k.name, l.name), ',' ORDER BY place) AS sentence_ids
  FROM p LEFT JOIN k USING (sentence) LEFT JOIN k AS l ON p.plain = l.sentence
  WHERE k.name IS NOT NULL OR l.name IS NOT NULL GROUP BY r
), s0 AS (
  SELECT doc_id, r, coalesce(sentence_ids, '') AS sentence_ids, []::VARCHAR[] AS names,
         ',' || coalesce(sentence_ids, '') || ',' AS rest FROM d LEFT JOIN f USING (r)
{steps})
SELECT doc_id, sentence_ids, array_to_string(list_sort(list_distinct(names)), ',') AS licenses FROM s{len(RULES)}
"""


OP8_LICENSES = _licenses()
