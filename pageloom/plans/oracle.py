"""The registered queries as SQL for an independent engine, run on the same tables."""

from __future__ import annotations

from pageloom.functions import nesting
from pageloom.functions import tokens as tk
from pageloom.functions import wikitext as wt
from pageloom.plans.relations import CHAIN_COLUMNS, MARKUP_COLUMNS, NESTED_COLUMNS, PAGE_COLUMNS, REPORTS, SHARED_COLUMNS

_SPECIAL_LINKS = "^(" + "|".join(wt.EXCLUDED_LINK_NAMESPACES) + ")"


def _text(value: str) -> str:
    """A SQL string expression; line ends are spelled chr(10)."""
    quoted = value.replace("'", "''")
    return "'" + quoted.replace("\n", "' || chr(10) || '") + "'" if value != "\n" else "chr(10)"


def _words(words: list[str]) -> str:
    return ", ".join(_text(word) for word in words)


# --- pages, arrays, cleaned text -----------------------------------------------------

WIKI = f"wiki AS (SELECT {', '.join(PAGE_COLUMNS)} FROM documents)"
SHARED = f"wiki AS (SELECT {', '.join(SHARED_COLUMNS)} FROM documents)"
CHAINS = f"wiki AS (SELECT {', '.join(CHAIN_COLUMNS)} FROM documents)"
DEEP = f"wiki AS (SELECT {', '.join(NESTED_COLUMNS)} FROM documents)"
MARKUP = f"wiki AS (SELECT {', '.join(MARKUP_COLUMNS)} FROM documents)"


def _captured(name: str, pattern: str, source: str = "wiki", key: str = "id", text: str = "text_raw") -> str:
    """CTEs with the distinct trimmed captures of each page in order: key, value, pos."""
    found = f"regexp_extract_all({text}, {_text(pattern)}, 1)"
    value = "trim(regexp_replace(value, '^:+', ''))" if name == "links" else "trim(value)"
    kept = f"AND NOT regexp_matches(lower(value), '{_SPECIAL_LINKS}')" if name == "links" else ""
    return f"""{name}_all AS (
  SELECT {key}, {value} AS value, place FROM (
    SELECT {key}, unnest({found}) AS value, generate_subscripts({found}, 1) AS place FROM {source})),
{name} AS (
  SELECT {key}, value, CAST(row_number() OVER (PARTITION BY {key} ORDER BY min(place)) - 1 AS INTEGER) AS pos
  FROM {name}_all WHERE value <> '' {kept} GROUP BY {key}, value)"""


CATEGORIES = _captured("categories", wt.CATEGORY_PATTERN)
TEMPLATES = _captured("templates", wt.TEMPLATE_PATTERN)
EXTERNAL_LINKS = _captured("external_links", wt.EXTERNAL_LINK_PATTERN)
LINKS = _captured("links", wt.LINK_PATTERN)


def _cleaned(text: str, compat: bool = False) -> str:
    sql = f"coalesce({text}, '')"
    for pattern, replacement in wt.cleaning_steps(compat):
        sql = f"regexp_replace({sql}, {_text(pattern)}, {_text(replacement.replace('$1', chr(92) + '1'))}, 'g')"
    return sql


def _unnested(name: str, source: str, pair: tuple[str, str], begins: str = "", replacement: str = "") -> str:
    """CTEs of ``id, text`` without nested pairs: depths as running sums over the parts, lifted where they would fall below 0."""
    opening, closing = (_text(mark) for mark in pair)
    part = f"'(\\Q{pair[0]}\\E|\\Q{pair[1]}\\E|[^{''.join(sorted({chr(92) + m[0] for m in pair}))}]+|.)'"
    way = "PARTITION BY id ORDER BY pos"
    opens = f"AND regexp_matches(coalesce(o.next, ''), '{begins}')" if begins else ""
    inside = "depth > 0 OR before > 0"
    dropped = ""
    if begins:
        inside = f"EXISTS (SELECT 1 FROM {name}_pairs p WHERE p.id = d.id AND d.pos BETWEEN p.first AND p.last)"
        dropped = f"""{name}_pairs AS (
  SELECT o.id, o.pos AS first, min(c.pos) AS last FROM {name}_depths o JOIN {name}_depths c ON c.id = o.id AND c.pos > o.pos AND c.before < o.before
  WHERE o.before > o.depth {opens} GROUP BY ALL),
"""
    # before: the depth to the right of a part; depth: the depth to its left, both as read from the right.
    return f"""{name}_parts AS (
  SELECT id, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos FROM (SELECT id, regexp_extract_all(text, {part}, 0, 's') AS parts FROM {source})),
{name}_signs AS (
  SELECT id, part, pos, CASE part WHEN {opening} THEN 1 WHEN {closing} THEN -1 ELSE 0 END AS sign FROM {name}_parts),
{name}_sums AS (SELECT *, sum(sign) OVER ({way}) AS total FROM {name}_signs),
{name}_lifted AS (SELECT *, total - least(0, min(total) OVER ({way})) AS forth FROM {name}_sums),
{name}_closed AS (
  SELECT id, part, pos, CASE WHEN sign = -1 AND coalesce(lag(forth) OVER ({way}), 0) = 0 THEN 0 ELSE sign END AS sign,
    lead(part) OVER ({way}) AS next FROM {name}_lifted),
{name}_back AS (SELECT *, sum(-sign) OVER ({way} DESC) AS total FROM {name}_closed),
{name}_low AS (SELECT *, total - least(0, min(total) OVER ({way} DESC)) AS depth FROM {name}_back),
{name}_depths AS (SELECT *, coalesce(lead(depth) OVER ({way}), 0) AS before FROM {name}_low),
{dropped}{name}_cut AS (SELECT id, part, pos, {inside} AS inside FROM {name}_depths d),
{name}_shown AS (
  SELECT id, pos, CASE WHEN NOT inside THEN part WHEN NOT coalesce(lag(inside) OVER ({way}), false) THEN {_text(replacement) if replacement else "''"} ELSE '' END AS part FROM {name}_cut),
{name} AS (SELECT s.id, coalesce(string_agg(part, '' ORDER BY pos), any_value(s.text)) AS text FROM {source} s LEFT JOIN {name}_shown USING (id) GROUP BY s.id)"""


def _deep_cleaned() -> str:
    """CTEs of the nested cleaning, cut at the two steps that are no patterns."""
    ctes, source, sql = [DEEP, "step0 AS (SELECT id, coalesce(text_raw, '') AS text FROM wiki)"], "step0", "text"
    for step in wt.nested_steps():
        if isinstance(step, str):
            ctes.append(f"{step}_before AS (SELECT id, {sql} AS text FROM {source})")
            pair, begins, new = (nesting.LINK, nesting.MEDIA, " ") if step == "media" else (nesting.TEMPLATE, "", "")
            ctes.append(_unnested(step, f"{step}_before", pair, begins, new))
            source, sql = step, "text"
        else:
            sql = f"regexp_replace({sql}, {_text(step[0])}, {_text(step[1].replace('$1', chr(92) + '1'))}, 'g')"
    return f"WITH {', '.join(ctes)} SELECT id, {sql} AS text FROM {source}"


PAGES = f"{WIKI},\npages_clean AS (SELECT *, {_cleaned('text_raw')} AS text FROM wiki)"
ARTICLE = "ns = 0 AND redirect IS NULL"
DOCS = f"{PAGES},\ndocs AS (SELECT id, title, text FROM pages_clean WHERE {ARTICLE} AND length(text) > 500)"

_BLANK = "trim({0}, ' ') = ''"


def _size(name: str) -> str:
    return f"CAST(coalesce({name}_n.n, 0) AS INTEGER)"


def _sizes(name: str) -> str:
    return f"{name}_n AS (SELECT id, count(*) AS n FROM {name} GROUP BY id)"


FACTS = f"""{PAGES}, {CATEGORIES}, {TEMPLATES}, {LINKS}, {_sizes('categories')}, {_sizes('templates')}, {_sizes('links')},
facts AS (
  SELECT p.id, title, ns, redirect, ({ARTICLE}) AS is_article, CAST(length(text) AS INTEGER) AS text_len,
    {_BLANK.format('text')} AS is_blank, {_size('links')} AS link_count, {_size('categories')} AS category_count,
    {_size('templates')} AS template_count
  FROM pages_clean p LEFT JOIN links_n USING (id) LEFT JOIN categories_n USING (id) LEFT JOIN templates_n USING (id)),
counted AS (
  SELECT id, title, text_len, link_count, category_count, template_count,
    CASE WHEN text_len > 0 THEN link_count / (text_len / 1000.0::DOUBLE) ELSE 0.0::DOUBLE END AS links_per_kchar
  FROM facts WHERE is_article)"""


def _length_summary(value: str) -> str:
    whole = [("min", f"min({value})")]
    whole += [(name, f"quantile_disc({value}, {share})") for name, share in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99))]
    whole += [("max", f"max({value})")]
    real = [("avg", f"avg({value})"), ("stddev", f"stddev_samp({value})")]
    parts = [f'CAST(coalesce({sql}, 0) AS BIGINT) AS "{name}"' for name, sql in whole]
    parts += [f'round(coalesce({sql}, 0.0), 6) AS "{name}"' for name, sql in real]
    return ", ".join(parts)


OVERVIEW = f"""{FACTS},
overview AS (
  SELECT count(*) AS total_pages, count(redirect) AS redirect_pages, count(DISTINCT title) AS distinct_titles,
    count(*) FILTER (title IS NULL OR {_BLANK.format('title')}) AS missing_titles,
    (SELECT count(*) FROM (SELECT title FROM facts GROUP BY title HAVING count(*) > 1)) AS duplicate_title_groups,
    count(*) FILTER (is_article) AS articles_count, count(*) FILTER (is_blank) AS empty_text_global,
    count(*) FILTER (is_blank AND is_article) AS empty_text_articles
  FROM facts)"""

# --- terms -----------------------------------------------------------------------------

TERMS = f"""{DOCS},
raw AS (SELECT id, list_filter(regexp_split_to_array(lower(text), '{tk.LETTERS_ONLY}'),
  lambda t: length(t) >= {tk.MIN_TOKEN_LENGTH}) AS tokens_raw FROM docs),
clean AS (SELECT id, tokens_raw, list_filter(tokens_raw, lambda t: t NOT IN ({{stop}})) AS tokens FROM raw),
paired AS (SELECT id, tokens_raw, tokens, list_transform(generate_series(1, len(tokens) - 1),
  lambda i: tokens[i] || ' ' || tokens[i + 1]) AS bigrams FROM clean),
arrays AS (SELECT *, list_concat(tokens, bigrams) AS terms FROM paired)"""

VOCABULARY = """{terms},
frequency AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(terms) AS term FROM arrays) GROUP BY id, term),
size AS (SELECT count(*) AS n FROM docs),
ranked_terms AS (
  SELECT term, CAST(sum(tf) AS BIGINT) AS total_count, count(*) AS doc_freq FROM frequency GROUP BY term
  HAVING count(*) BETWEEN 20 AND 0.6 * (SELECT n FROM size)),
vocabulary AS (
  SELECT CAST(row_number() OVER (ORDER BY total_count DESC, term) - 1 AS INTEGER) AS term_index, term, total_count,
    doc_freq FROM ranked_terms ORDER BY total_count DESC, term LIMIT 50000),
weights AS (
  SELECT term, doc_freq, CASE WHEN doc_freq >= 10 THEN ln((n + 1) / (doc_freq + 1)) ELSE 0.0 END AS idf
  FROM vocabulary, size)"""

# --- graph -------------------------------------------------------------------------------


def _norm(title: str) -> str:
    return f"lower(regexp_replace(trim({title}, ' '), '[\\s_]+', ' ', 'g'))"


GRAPH = f"""{WIKI}, {CATEGORIES}, {LINKS},
articles AS (SELECT * FROM wiki WHERE {ARTICLE} AND id IS NOT NULL AND nullif(trim(title, ' '), '') IS NOT NULL),
page_vertices AS (
  SELECT id, min(trim(title, ' ')) AS title, 'page' AS kind FROM articles GROUP BY id),
mentions AS (
  SELECT l.id AS src_id, {_norm('l.value')} AS title_norm FROM links l JOIN articles a ON a.id = l.id),
joined AS (
  SELECT src_id, v.id AS dst_id FROM mentions m JOIN page_vertices v ON m.title_norm = {_norm('v.title')}),
link_edges AS (
  SELECT src_id, dst_id, count(*) AS weight, 'link' AS edge_type FROM joined WHERE src_id <> dst_id
  GROUP BY src_id, dst_id),
category_edges AS (
  SELECT DISTINCT c.id AS src_id, 'Category:' || c.value AS title, CAST(1 AS BIGINT) AS weight,
    'has_category' AS edge_type FROM categories c JOIN articles a ON a.id = c.id),
category_vertices AS (SELECT DISTINCT title, 'category' AS kind FROM category_edges),
vertices AS (
  SELECT 'p' || id AS node, id AS page_id, title, kind FROM page_vertices
  UNION ALL SELECT 'c' || title, NULL, title, kind FROM category_vertices),
edges AS (
  SELECT 'p' || src_id AS src, 'p' || dst_id AS dst FROM link_edges
  UNION ALL SELECT 'p' || src_id, 'c' || title FROM category_edges)"""


def _pagerank(rounds: int = 10, tables: str = GRAPH) -> str:
    steps = [
        tables,
        "degrees AS (SELECT src, count(*) AS degree FROM edges GROUP BY src)",
        "linked AS MATERIALIZED (SELECT e.src, e.dst, d.degree FROM edges e JOIN degrees d ON e.src = d.src)",
        "r0 AS (SELECT node, CAST(1.0 AS DOUBLE) AS rank FROM vertices)",
    ]
    for step in range(rounds):
        steps.append(
            f"""r{step + 1} AS MATERIALIZED (
  SELECT v.node, 0.15 + 0.85 * coalesce(sum(r.rank / l.degree), 0.0) AS rank FROM vertices v
  LEFT JOIN linked l ON l.dst = v.node LEFT JOIN r{step} r ON r.node = l.src GROUP BY v.node)"""
        )
    steps.append(
        f"""ranked AS (
  SELECT page_id, title, kind, rank * (SELECT count(*) / sum(rank) FROM r{rounds}) AS pagerank
  FROM vertices JOIN r{rounds} USING (node))"""
    )
    return ",\n".join(steps)


_SHARED_GRAPH = GRAPH.replace(WIKI, SHARED)

#: The walk is cut off beyond the longest chain; titles whose walk goes on from there are on circles.
REDIRECTS = f"""{CHAINS},
titled AS (SELECT {_norm('title')} AS title_norm, {_norm("split_part(redirect, '#', 1)")} AS target FROM wiki WHERE ns = 0),
steps AS (
  SELECT title_norm, min(target) AS target FROM titled GROUP BY title_norm HAVING count(*) = count(target)),
walk AS (
  SELECT title_norm, target AS place, CAST(1 AS BIGINT) AS hops FROM steps
  UNION ALL SELECT w.title_norm, s.target, w.hops + 1 FROM walk w JOIN steps s ON w.place = s.title_norm WHERE w.hops < 60),
reached AS (SELECT title_norm, place, hops FROM walk WHERE place NOT IN (SELECT title_norm FROM steps)),
ends AS (SELECT s.title_norm, r.place AS "end", r.hops FROM steps s LEFT JOIN reached r USING (title_norm))"""

# --- vectors ------------------------------------------------------------------------------

_VECTORS = "vectors AS (SELECT vec_id AS id, 'vec ' || vec_id AS title, embedding AS v, label FROM embeddings)"
_DOMINANT = f"""{_VECTORS},
dominant AS (SELECT id, title, CAST(list_position(v, list_max(v)) - 1 AS INTEGER) AS topic FROM vectors),
names AS (SELECT DISTINCT label AS topic, 'group ' || label AS topic_name FROM embeddings)"""


def oracle_sql() -> dict[str, str]:
    terms = TERMS.replace("{stop}", _words(tk.extended_stop_words()))
    vocabulary = VOCABULARY.format(terms=terms)
    pagerank = _pagerank()

    def term_column(name: str, glue: str) -> str:
        return f"WITH {terms} SELECT id, CAST(len({name}) AS INTEGER) AS n, array_to_string({name}, '{glue}') AS {name} FROM arrays"

    def joined(name: str) -> str:
        return (
            f"coalesce((SELECT string_agg(value, '|' ORDER BY pos) FROM {name} x WHERE x.id = p.id), '') AS {name}"
        )

    def token_counts(source: str, stop: list[str]) -> str:
        return f"""SELECT token, count(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]+')) AS token FROM {source})
WHERE length(token) >= {tk.MIN_TOKEN_LENGTH} AND token NOT IN ({_words(stop)}) GROUP BY token"""

    def markup_count(pattern: str) -> str:
        return f"CAST(len(regexp_extract_all(text_raw, {_text(pattern)})) AS INTEGER)"

    def split_counts(*names: str) -> str:
        patterns = (wt.LINK_MARKUP, wt.CATEGORY_MARKUP, wt.TEMPLATE_MARKUP)
        return ", ".join(f"{markup_count(pattern)} AS {name}" for pattern, name in zip(patterns, names))

    def percentile_rows(source: str, wanted: dict[str, tuple[str, list[float]]]) -> str:
        return " UNION ALL ".join(
            f"SELECT '{name}' AS measure, CAST({share} AS DOUBLE) AS share, round(CAST(quantile_disc({value}, {share}) AS DOUBLE), 6) AS value FROM {source}"
            for name, (value, shares) in wanted.items()
            for share in shares
        )

    projection = "SELECT title, CAST(ns AS INTEGER) AS ns, id, redirect, revision_id, timestamp, text_raw FROM wiki"
    extracted = {
        "categories": CATEGORIES,
        "templates": TEMPLATES,
        "external_links": EXTERNAL_LINKS,
        "links": LINKS,
    }

    sql = {
        "xml_pages": f"WITH {WIKI} {projection}",
        "page_projection": f"WITH {WIKI} {projection}",
        "rejected_pages": "SELECT doc_id AS id FROM documents WHERE doc_id % 40 IN (7, 11)",
        "kept_pages": """SELECT doc_id AS id, 'Doc ' || doc_id AS title, CAST(0 AS INTEGER) AS ns, text AS text_raw
FROM documents WHERE doc_id % 40 NOT IN (7, 11)""",
        "revision_time": f"WITH {WIKI} SELECT id, timestamp, strftime(CAST(timestamp AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS revision_time FROM wiki",
        "parse_pages": f"""WITH {PAGES}, {CATEGORIES}, {TEMPLATES}, {EXTERNAL_LINKS}, {LINKS}
SELECT title, CAST(ns AS INTEGER) AS ns, id, redirect, revision_id, timestamp, text_raw, text, {joined('categories')},
  {joined('templates')}, {joined('external_links')}, {joined('links')} FROM pages_clean p""",
        "sample_page": f"""WITH {PAGES} SELECT id, title, CAST(ns AS INTEGER) AS ns, CAST(length(text) AS INTEGER) AS text_length,
  substring(text_raw, 1, 500) AS raw_head FROM pages_clean WHERE ns = 0 AND text_raw IS NOT NULL ORDER BY id LIMIT 1""",
        "url_external_links": "WITH "
        + _captured("external_links", wt.EXTERNAL_LINK_PATTERN, "pages", "page_id", "url || chr(10) || html")
        + " SELECT page_id, pos, value FROM external_links",
        "clean_array": """WITH parts AS (
  SELECT doc_id, trim(unnest(string_split(text, '.')), ' ') AS value,
    generate_subscripts(string_split(text, '.'), 1) AS place FROM documents)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY min(place)) - 1 AS INTEGER) AS pos, value
FROM parts WHERE value <> '' GROUP BY doc_id, value""",
        "markup_counts": f"WITH {WIKI} SELECT id, {split_counts('links', 'categories', 'templates')} FROM wiki",
        "clean_text": f"WITH {WIKI} SELECT id, {_cleaned('text_raw')} AS text FROM wiki",
        "clean_text_compat": f"WITH {WIKI} SELECT id, {_cleaned('text_raw', compat=True)} AS text FROM wiki",
        "clean_markup": f"WITH {MARKUP} SELECT id, {_cleaned('text_raw')} AS text FROM wiki",
        "clean_markup_compat": f"WITH {MARKUP} SELECT id, {_cleaned('text_raw', compat=True)} AS text FROM wiki",
        "clean_html": f"SELECT page_id, {_cleaned('html')} AS text FROM pages",
        "clean_nested": _deep_cleaned(),
        "without_templates": f"WITH {DEEP}, step0 AS (SELECT id, text_raw AS text FROM wiki), {_unnested('cut', 'step0', nesting.TEMPLATE)} SELECT id, text FROM cut",
        "article_filter": f"WITH {WIKI} SELECT id, title, CAST(ns AS INTEGER) AS ns FROM wiki WHERE {ARTICLE}",
        "nlp_docs": f"WITH {DOCS} SELECT id, title, text FROM docs",
        "text_head": f"WITH {DOCS} SELECT title, substring(text, 1, 240) AS text_head FROM docs ORDER BY id LIMIT 3",
        "non_empty_title": """SELECT doc_id, CAST(place - 1 AS INTEGER) AS pos, nullif(trim(sentence, ' '), '') AS title FROM (
  SELECT doc_id, unnest(string_split(text, '.')) AS sentence, generate_subscripts(string_split(text, '.'), 1) AS place FROM documents)""",
        "norm_title": f"SELECT doc_id, {_norm(chr(39) + ' ' + chr(39) + ' || translate(text, ' + chr(39) + '.' + chr(39) + ', ' + chr(39) + '_' + chr(39) + ')')} AS title_norm FROM documents",
        "page_counts": f"WITH {WIKI} SELECT count(*) AS total_pages, count(redirect) AS redirect_pages FROM wiki",
        "title_stats": f"""WITH {WIKI} SELECT count(DISTINCT title) AS distinct_titles,
  count(*) FILTER (title IS NULL OR {_BLANK.format('title')}) AS missing_titles FROM wiki""",
        "duplicate_titles": f"""WITH {WIKI} SELECT count(*) AS duplicate_title_groups
FROM (SELECT title FROM wiki GROUP BY title HAVING count(*) > 1)""",
        "namespace_distribution": f"WITH {WIKI} SELECT ns, count(*) AS count FROM wiki GROUP BY ns",
        "top_namespaces": f"WITH {WIKI} SELECT ns, count(*) AS count FROM wiki GROUP BY ns ORDER BY count DESC, ns LIMIT 25",
        "text_length_global": f"""WITH {FACTS} SELECT 'global' AS scope, count(*) FILTER (is_blank) AS empty_text,
  {_length_summary('text_len')} FROM facts""",
        "text_length_articles": f"""WITH {FACTS} SELECT 'articles' AS scope, count(*) AS articles_count,
  count(*) FILTER (is_blank) AS empty_text, {_length_summary('text_len')} FROM facts WHERE is_article""",
        "length_summary": f"SELECT 'documents' AS scope, {_length_summary('n_chars')} FROM documents",
        "link_counts": f"""WITH {FACTS} SELECT id, title, text_len, link_count, category_count, template_count,
  round(links_per_kchar, 6) AS links_per_kchar FROM counted""",
        "link_counts_from_markup": f"""WITH {WIKI},
counted AS (SELECT id, title, CAST(length(text_raw) AS INTEGER) AS text_len,
  {split_counts('link_count', 'category_count', 'template_count')} FROM wiki WHERE {ARTICLE})
SELECT *, round(CASE WHEN text_len > 0 THEN link_count / (text_len / 1000.0::DOUBLE) ELSE 0.0 END, 6) AS links_per_kchar
FROM counted""",
        "link_density_summary": f"""WITH {FACTS} SELECT min(link_count) AS min_links,
  quantile_disc(link_count, 0.5) AS p50_links, quantile_disc(link_count, 0.9) AS p90_links, max(link_count) AS max_links,
  round(avg(links_per_kchar), 6) AS avg_links_per_kchar,
  round(quantile_disc(links_per_kchar, 0.9), 6) AS p90_links_per_kchar,
  round(avg(category_count), 6) AS avg_categories, round(avg(template_count), 6) AS avg_templates FROM counted""",
        "exact_lengths": f"WITH {FACTS} " + percentile_rows("facts", {"text_len": ("text_len", [0.0, 0.01, 0.5, 0.9, 0.99, 1.0]), "kchars": ("text_len / 1000.0::DOUBLE", [0.25, 0.5, 0.9, 0.999])}),
        "exact_link_density": f"WITH {FACTS} " + percentile_rows("counted", {"link_count": ("link_count", [0.5, 0.9]), "links_per_kchar": ("links_per_kchar", [0.5, 0.9])}),
        "top_most_linked": f"""WITH {FACTS} SELECT title, text_len, link_count, round(links_per_kchar, 6) AS links_per_kchar,
  category_count, template_count FROM counted ORDER BY link_count DESC, id, title LIMIT 200""",
        "top_tokens": f"""WITH {PAGES}, articles AS (SELECT text FROM pages_clean WHERE {ARTICLE}),
counts AS ({token_counts('articles', tk.english_stop_words())}) SELECT token, count FROM counts ORDER BY count DESC, token LIMIT 25""",
        "conversation_tokens": token_counts("conversations", tk.english_stop_words()),
        "overview": f"WITH {OVERVIEW} SELECT * FROM overview",
        "overview_ratios": f"""WITH {OVERVIEW} SELECT
  round(coalesce(redirect_pages / nullif(total_pages, 0), 0.0), 6) AS redirect_ratio,
  round(coalesce(empty_text_global / nullif(total_pages, 0), 0.0), 6) AS empty_text_global_ratio,
  round(coalesce(articles_count / nullif(total_pages, 0), 0.0), 6) AS article_ratio,
  round(coalesce(empty_text_articles / nullif(articles_count, 0), 0.0), 6) AS empty_text_articles_ratio
FROM overview""",
        "tokens_nlp": term_column("tokens_raw", " "),
        "tokens_clean": term_column("tokens", " "),
        "bigrams": term_column("bigrams", "|"),
        "terms": term_column("terms", "|"),
        "vocabulary": f"WITH {vocabulary} SELECT * FROM vocabulary",
        "vocabulary_sketched": f"WITH {vocabulary} SELECT * FROM vocabulary",
        "idf_weights": f"WITH {vocabulary} SELECT term, doc_freq, round(idf, 6) AS idf FROM weights",
        "tfidf_features": f"""WITH {vocabulary},
tfidf AS (SELECT id, term, tf * idf AS w FROM frequency JOIN weights USING (term)),
norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM tfidf GROUP BY id)
SELECT id, term, round(w / norm, 6) AS weight FROM tfidf JOIN norms USING (id) WHERE w <> 0""",
        "label_from_terms": """SELECT doc_id, coalesce(nullif(array_to_string(list_filter(list_transform(
  string_split(text, ' '), lambda t: trim(replace(t, '_', ' '), ' ')), lambda t: t <> '')[1:3], ' / '), ''),
  '(unlabeled)') AS label FROM documents""",
        "vector_argmax": "SELECT vec_id AS id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS position FROM embeddings",
        "top_topics": f"""WITH {_DOMINANT},
entries AS (SELECT id, title, unnest(v) AS weight, generate_subscripts(v, 1) - 1 AS topic FROM vectors),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY weight DESC, topic) AS topic_rank FROM entries)
SELECT id, title, CAST(r.topic AS INTEGER) AS topic, topic_name, round(CAST(weight AS DOUBLE), 6) AS topic_weight,
  CAST(topic_rank AS INTEGER) AS topic_rank FROM ranked r LEFT JOIN names n ON r.topic = n.topic WHERE topic_rank <= 3""",
        "embedding_group_sizes": """SELECT label AS cluster, 'group ' || label AS cluster_name, count(*) AS count
FROM embeddings GROUP BY label""",
        "embedding_topic_prevalence": f"""WITH {_DOMINANT} SELECT d.topic, topic_name, count(*) AS count
FROM dominant d LEFT JOIN names n ON d.topic = n.topic GROUP BY ALL""",
        "embedding_labels": f"""WITH {_DOMINANT} SELECT d.topic, id, title, topic_name
FROM dominant d LEFT JOIN names n ON d.topic = n.topic""",
        "page_vertices": f"WITH {GRAPH} SELECT id, title, kind, {_norm('title')} AS title_norm FROM page_vertices",
        "category_vertices": f"WITH {GRAPH} SELECT title, kind, {_norm('title')} AS title_norm FROM category_vertices",
        "stable_node_id": f"""WITH {GRAPH} SELECT title, CAST(1 AS BIGINT) AS ids, 1 AS negative, count(*) AS pages
FROM category_edges GROUP BY title""",
        "link_title_join": f"WITH {GRAPH} SELECT * FROM joined",
        "link_edges": f"WITH {GRAPH} SELECT * FROM link_edges",
        "redirect_ends": f'WITH RECURSIVE {REDIRECTS} SELECT title_norm, "end", hops FROM ends',
        "resolved_link_edges": f"""WITH RECURSIVE {REDIRECTS}, {LINKS},
articles AS (SELECT id, {_norm('title')} AS title_norm FROM wiki WHERE {ARTICLE}),
mentions AS (SELECT l.id AS src_id, {_norm('l.value')} AS title_norm FROM links l JOIN articles a ON a.id = l.id),
followed AS (
  SELECT src_id, CASE WHEN e.title_norm IS NULL THEN m.title_norm ELSE e."end" END AS title_norm
  FROM mentions m LEFT JOIN ends e ON e.title_norm = m.title_norm)
SELECT src_id, a.id AS dst_id, count(*) AS weight, 'link' AS edge_type FROM followed f JOIN articles a ON a.title_norm = f.title_norm
WHERE src_id <> a.id GROUP BY ALL""",
        "grouped_links": f"""WITH {_SHARED_GRAPH},
groups AS (SELECT {_norm('title')} AS title_norm, min(id) AS group_id FROM page_vertices GROUP BY ALL)
SELECT src_id, group_id, count(*) AS weight, 'link' AS edge_type FROM mentions JOIN groups USING (title_norm) GROUP BY ALL""",
        "expanded_links": f"WITH {_SHARED_GRAPH} SELECT * FROM link_edges",
        "grouped_pagerank": f"WITH {_pagerank(tables=_SHARED_GRAPH)} SELECT page_id, title, kind, round(pagerank, 6) AS pagerank FROM ranked",
        "dense_node_ids": """SELECT title, CAST(-row_number() OVER (ORDER BY title) AS BIGINT) AS id FROM (
  SELECT DISTINCT unnest(string_split(text, '.')) AS title FROM documents)""",
        "id_collisions": """SELECT doc_id % 97 AS id, count(DISTINCT doc_id) AS names, min('Doc ' || doc_id) AS first_name, max('Doc ' || doc_id) AS last_name
FROM documents GROUP BY ALL HAVING count(DISTINCT doc_id) > 1""",
        "mention_edges": f"""WITH {GRAPH},
every AS (
  SELECT l.id AS src_id, {_norm('l.value')} AS title_norm, count(*) AS weight
  FROM links_all l JOIN articles a ON a.id = l.id
  WHERE l.value <> '' AND NOT regexp_matches(lower(l.value), '{_SPECIAL_LINKS}') GROUP BY ALL)
SELECT src_id, v.id AS dst_id, weight, 'link' AS edge_type
FROM every e JOIN page_vertices v ON e.title_norm = {_norm('v.title')} WHERE src_id <> v.id""",
        "category_edges": f"WITH {GRAPH} SELECT * FROM category_edges",
        "graph_vertices": f"WITH {GRAPH} SELECT page_id, title, kind FROM vertices",
        "graph_edges": f"""WITH {GRAPH}
SELECT src_id, dst_id AS dst_page_id, title AS dst_title, weight, edge_type FROM link_edges e
JOIN page_vertices v ON v.id = e.dst_id
UNION ALL SELECT src_id, NULL, title, weight, edge_type FROM category_edges""",
        "graph_counts": f"""WITH {GRAPH} SELECT 'vertices' AS part, kind, count(*) AS count FROM vertices GROUP BY kind
UNION ALL SELECT 'edges', 'link', count(*) FROM link_edges
UNION ALL SELECT 'edges', 'has_category', count(*) FROM category_edges""",
        "nodes_csv": f"WITH {GRAPH} SELECT page_id, title, kind FROM vertices",
        "edges_csv": f"""WITH {GRAPH}
SELECT src_id, dst_id AS dst_page_id, weight, edge_type FROM link_edges
UNION ALL SELECT src_id, NULL, weight, edge_type FROM category_edges""",
        "pagerank": f"WITH {pagerank} SELECT page_id, title, kind, round(pagerank, 6) AS pagerank FROM ranked",
        "pagerank_top_pages": f"""WITH {pagerank} SELECT page_id AS id, title, kind, round(pagerank, 6) AS pagerank
FROM ranked WHERE kind = 'page' ORDER BY ranked.pagerank DESC, page_id LIMIT 10""",
        "pagerank_top_categories": f"""WITH {pagerank} SELECT title, kind, round(pagerank, 6) AS pagerank
FROM ranked WHERE kind = 'category' ORDER BY ranked.pagerank DESC, title LIMIT 10""",
    }
    def read_back(tables: dict[str, tuple[str, str]]) -> str:
        return " UNION ALL ".join(
            f"SELECT '{name}' AS name, count(*) AS rows, CAST(coalesce(sum({measure}), 0) AS BIGINT) AS checksum FROM ({sql[query]})" for name, (query, measure) in tables.items()
        )

    queries = {"text_length_summary_global": "text_length_global", "text_length_summary_articles": "text_length_articles"}
    sql["report_outputs"] = read_back({name: (queries.get(name, name), measure) for name, measure in REPORTS.items()})

    def covered(facts: str) -> str:
        return f"WITH {DOCS} SELECT id, title, {facts} FROM docs"

    sql["cluster_outputs"] = sql["topic_outputs_labeled"] = covered("true AS known, true AS named")
    # A document without any term of the vocabulary has no topic to give weight to.
    sql["topic_outputs"] = f"""WITH {vocabulary} SELECT id, title, CAST(10 AS INTEGER) AS topics, true AS largest,
  CASE WHEN id IN (SELECT f.id FROM frequency f JOIN vocabulary v ON f.term = v.term) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS total FROM docs"""
    sql["predicted_clusters_again"] = sql["predicted_topics_again"] = covered("true AS same")
    kinds = "(SELECT unnest(['cluster', 'topic']) AS kind), (SELECT unnest(range(10)) AS number)"
    sql["label_outputs"] = f"SELECT kind, number, true AS from_terms, CAST(15 AS INTEGER) AS terms, CAST(0 AS BIGINT) AS alien FROM {kinds}"
    sql["term_report_outputs"] = f"SELECT kind, number, true AS same FROM {kinds}"
    sql["group_size_outputs"] = f"WITH {DOCS} SELECT unnest(['cluster', 'topic']) AS kind, count(*) AS documents, CAST(0 AS BIGINT) AS unnamed FROM docs"
    sql["top_topic_outputs"] = f"WITH {DOCS} SELECT id, CAST(3 AS INTEGER) AS ranks, true AS falling, true AS own_first FROM docs"
    sql["stage_bundle"] = sql["terms"]
    sql["graph_outputs"] = f"""WITH {GRAPH} SELECT 'vertices' AS name, count(*) AS rows FROM vertices
UNION ALL SELECT 'edges', count(*) FROM edges UNION ALL SELECT 'pagerank', count(*) FROM vertices
UNION ALL SELECT 'top_pages', least(10, count(*)) FROM page_vertices UNION ALL SELECT 'top_categories', least(10, count(*)) FROM category_vertices"""
    sql["full_job"] = read_back(
        {"pages": ("page_projection", "id"), "clusters/assignments": ("nlp_docs", "id"), "topics/assignments_labeled": ("nlp_docs", "id"), "top_tokens": ("top_tokens", "count * length(token)")}
    ) + " UNION ALL SELECT 'rejected_pages', 0, 0"
    for name, cte in extracted.items():
        sql[f"extract_{name}"] = f"WITH {WIKI}, {cte} SELECT id, pos, value FROM {name}"
        sql[f"markup_{name}"] = f"WITH {MARKUP}, {cte} SELECT id, pos, value FROM {name}"
    return sql
