"""SQL twins of the queries that SQL can express on whole tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_COPIES = f"""WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
shingled AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(words) < 2 THEN words
    ELSE list_transform(generate_series(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1]) END)) AS shingles
  FROM worded),
classes AS (
  SELECT min(doc_id) AS id, shingles, len(shingles) AS n FROM shingled WHERE len(shingles) > 0 GROUP BY shingles),
single AS (SELECT id, n, unnest(shingles) AS shingle FROM classes),
links AS MATERIALIZED (
  SELECT a.id AS a, b.id AS b FROM single a JOIN single b ON a.shingle = b.shingle AND a.id <> b.id
    AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached AS (
  SELECT id, id AS other FROM classes UNION SELECT r.id, l.b FROM reached r JOIN links l ON r.other = l.a),
least AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)
SELECT d.doc_id, CAST(len(d.shingles) AS BIGINT) AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id,
  coalesce(l.component_id, d.doc_id) = d.doc_id AS kept
FROM shingled d LEFT JOIN classes c ON c.shingles = d.shingles LEFT JOIN least l ON l.id = c.id"""


def _shingles(name: str, source: str, key: str, text: str) -> str:
    """CTE of the distinct five-term shingles of each text; a shorter text is one shingle."""
    return f"""{name}_terms AS (
  SELECT {key}, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+') AS terms FROM {source}),
{name} AS (
  SELECT DISTINCT {key}, unnest(CASE WHEN len(terms) = 0 THEN [] WHEN len(terms) < 5 THEN [array_to_string(terms, ' ')]
    ELSE list_transform(generate_series(1, len(terms) - 4), lambda i: array_to_string(terms[i:i + 4], ' ')) END) AS shingle
  FROM {name}_terms)"""


def _covered(part: str) -> str:
    """CTEs of the number of shingles of a part and of those that each document holds; short ones are looked for as phrases."""
    return f"""{part}_sizes AS (SELECT item_id, count(*) AS n FROM {part} GROUP BY item_id),
{part}_found AS (
  SELECT doc_id, item_id, count(*) AS hits FROM (
    SELECT doc_id, p.item_id, p.shingle FROM doc_grams d JOIN {part} p ON d.shingle = p.shingle
    UNION ALL SELECT doc_id, p.item_id, p.shingle FROM {part} p JOIN doc_terms d ON contains(d.joined, ' ' || p.shingle || ' ')
    WHERE len(string_split(p.shingle, ' ')) < 5) GROUP BY ALL)"""


LEAKS = f"""WITH items AS (
  SELECT item_id, text, split_part(trim(text, ' '), chr(10), 1) AS question,
    substring(trim(text, ' '), length(split_part(trim(text, ' '), chr(10), 1)) + 2) AS answer FROM benchmark),
{_shingles('whole', 'items', 'item_id', 'text')},
{_shingles('question', 'items', 'item_id', 'question')},
{_shingles('answer', 'items', 'item_id', 'answer')},
doc_terms AS (
  SELECT doc_id, terms, ' ' || array_to_string(terms, ' ') || ' ' AS joined
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS terms FROM documents)),
doc_grams AS (
  SELECT DISTINCT doc_id, unnest(list_transform(generate_series(1, len(terms) - 4),
    lambda i: array_to_string(terms[i:i + 4], ' '))) AS shingle FROM doc_terms),
{_covered('whole')}, {_covered('question')}, {_covered('answer')},
shares AS (
  SELECT w.doc_id, w.item_id, w.hits / ws.n AS overlap, coalesce(q.hits / qs.n, CASE WHEN qs.n IS NULL THEN 1.0 ELSE 0.0 END) AS question_overlap,
    coalesce(a.hits / an.n, CASE WHEN an.n IS NULL THEN 1.0 ELSE 0.0 END) AS answer_overlap
  FROM whole_found w JOIN whole_sizes ws USING (item_id)
  LEFT JOIN question_sizes qs ON qs.item_id = w.item_id LEFT JOIN question_found q ON q.doc_id = w.doc_id AND q.item_id = w.item_id
  LEFT JOIN answer_sizes an ON an.item_id = w.item_id LEFT JOIN answer_found a ON a.doc_id = w.doc_id AND a.item_id = w.item_id)
SELECT doc_id, item_id, round(overlap, 6) AS overlap, round(question_overlap, 6) AS question_overlap,
  round(answer_overlap, 6) AS answer_overlap
FROM shares WHERE overlap >= 0.8 OR (question_overlap >= 0.8 AND answer_overlap >= 0.8)"""

EXACT_COPIES = f"""SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY lowered ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(lowered) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS lowered FROM documents)
WINDOW same AS (PARTITION BY lowered)"""

#: The polynomial of crc32, bit by bit; near pairs share what is left after a deletion, and replacements are told apart from moves by position.
SPELLING = f"""WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, '{_UPPER}', '{_LOWER}') AS run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
bytes AS (
  SELECT run, times, length(run) AS size, hex(encode(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || run)) AS digits FROM runs),
hashed AS (
  SELECT run, times, size, xor(list_reduce(list_prepend(4294967295, list_transform(generate_series(1, len(digits), 2),
    lambda i: CAST('0x' || substring(digits, i, 2) AS BIGINT))), lambda c, b: list_reduce(
      [xor(c, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda a, _: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) AS h FROM bytes),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, h % size) || substring(run, h % size + 2) ELSE run END AS word, times FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
less AS (
  SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest FROM (
    SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN less b ON a.word = b.rest),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS other_n, arg_min(other, (-other_n, other)) AS other FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 10 * w.n THEN b.other END AS form,
    CASE WHEN b.other_n >= 10 * w.n THEN b.other_n END AS form_n FROM words w LEFT JOIN best b USING (word)),
steps AS (
  SELECT word, word AS root FROM forms UNION SELECT s.word, f.form FROM steps s JOIN forms f ON s.root = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT s.word, s.root FROM steps s JOIN forms f ON s.root = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""

ORACLE_SQL: dict[str, str] = {
    "op8_minhash_near_copies": NEAR_COPIES,
    "op10_benchmark_leaks": LEAKS,
    "op11_block_names": EXACT_COPIES,
    "op12_spelling_groups": SPELLING,
}
