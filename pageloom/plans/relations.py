"""Wiki-shaped pages projected from the given tables.

The given tables hold no wikitext, so every document becomes one page. The
expressions run unchanged in Spark SQL and in the checking engine, which is why
they are text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import wikitext
from pageloom.storage import durable

# Every fiftieth page shares its title with one other; links stay within runs of 200 pages, so edges grow with the pages.
_TITLE = "CASE WHEN doc_id % 50 = 49 THEN concat('Doc ', CAST(doc_id - 48 AS STRING)) ELSE concat('Doc ', CAST(doc_id AS STRING)) END"
_REDIRECT = "CASE WHEN doc_id % 13 = 12 THEN concat('Doc ', CAST(doc_id % 7 AS STRING)) END"

PAGE_COLUMNS = [
    "doc_id AS id",
    f"{_TITLE} AS title",
    "CASE WHEN doc_id % 11 = 10 THEN 10 ELSE 0 END AS ns",
    f"{_REDIRECT} AS redirect",
    "doc_id + 100000 AS revision_id",
    "'2024-01-01 00:00:00' AS timestamp",
    """concat('{{Infobox place', chr(10), '| name = ', lang, chr(10), '}}', chr(10), text,
  '<ref name="a">note</ref>', chr(10), '== Links ==', chr(10),
  '* [[Doc ', CAST(doc_id - doc_id % 200 + (doc_id * 7 + 3) % 200 AS STRING), '|see]] and [[doc_',
  CAST(doc_id - doc_id % 200 + (doc_id * 7 + 3) % 200 AS STRING),
  '#top]] and [[Doc_', CAST(doc_id - doc_id % 200 + (doc_id + 1) % 200 AS STRING), ']]', chr(10),
  '[http://example.org/', CAST(doc_id AS STRING), ' site] {{cite web|title=x}}', chr(10),
  '[[Category:', source, ']] [[Category:Lang ', lang, ']]') AS text_raw""",
]

# The same documents wrapped in the markup that the pages above leave out.
MARKUP_COLUMNS = [
    "doc_id AS id",
    """concat('{|  class=wide', chr(10), '|+ ', lang, chr(10), '|-', chr(10), '| c1 || c2', chr(10), '|}', chr(10),
  'A <ref name="x"/> kept <ref>n ', CAST(doc_id AS STRING), '</ref> <gallery>', chr(10), 'f.jpg|c', chr(10),
  '</gallery> b<br/>c<BR>d <script>v', CAST(doc_id AS STRING), '</script>', chr(10),
  '{{Box', chr(10), '| a = {{date|', CAST(doc_id AS STRING), '}}', chr(10), '| b = 1}}', chr(10),
  '{{a {{b {{c}} x}} y}} {{{p}}} {{#if:x}} [[File:a.jpg|thumb|see [[Beta]] x]] [[:Category:', source, ']]', chr(10),
  '=== ', lang, ' ===', chr(10), '''''''bold''''''  ''''it'''' http://a.b/', CAST(doc_id AS STRING), ' [https://q.r]',
  ' [http://x.y/z lab el]', chr(10), chr(10), '  ', chr(10), '*# item', chr(9), 'end ', chr(10),
  '[[category: ', source, ' |key]] [[ :Foo]] [[_Bar_]] [[', lang, ']] [[', lang, ']]', chr(10), text, ' ') AS text_raw""",
]

# Few titles, each shared by many pages and linked by many.
SHARED_COLUMNS = [
    "doc_id AS id",
    "concat('Topic ', CAST(doc_id % 97 AS STRING)) AS title",
    "CASE WHEN doc_id % 11 = 10 THEN 10 ELSE 0 END AS ns",
    "CASE WHEN doc_id % 13 = 12 THEN 'Topic 1' END AS redirect",
    """concat('[[Topic ', CAST((doc_id * 7 + 3) % 89 AS STRING), ']] [[topic_', CAST((doc_id * 7 + 3) % 89 AS STRING), '#top]] [[Topic ',
  CAST((doc_id + doc_id % 2) % 97 AS STRING), '|x]] [[Doc]] [[Category:', source, ']] [[Category:Lang ', lang, ']]') AS text_raw""",
]

# Runs of forty pages with a chain of ten redirects, circles, and redirects to nowhere.
CHAIN_COLUMNS = [
    "doc_id AS id",
    "concat('Doc ', CAST(doc_id AS STRING)) AS title",
    "CASE WHEN doc_id % 37 = 36 THEN 10 ELSE 0 END AS ns",
    """CASE WHEN doc_id % 40 BETWEEN 1 AND 10 OR doc_id % 40 IN (15, 19) THEN concat('doc_', CAST(doc_id - 1 AS STRING), '#top')
  WHEN doc_id % 40 IN (12, 13) THEN concat('Doc ', CAST(doc_id + 1 AS STRING))
  WHEN doc_id % 40 = 14 THEN concat('DOC ', CAST(doc_id - 2 AS STRING)) WHEN doc_id % 40 = 17 THEN concat('Doc ', CAST(doc_id AS STRING))
  WHEN doc_id % 40 = 18 THEN concat('Nowhere ', CAST(doc_id AS STRING)) END AS redirect""",
    """concat('[[Doc ', CAST(doc_id - doc_id % 40 + (doc_id * 7 + 3) % 40 AS STRING), ']] [[doc_',
  CAST(doc_id - doc_id % 40 + (doc_id + 5) % 40 AS STRING), '#top]] [[Doc ', CAST(doc_id - doc_id % 40 + 10 AS STRING), '|x]]') AS text_raw""",
]

# Templates up to twenty deep, media links in media links, and delimiters without a partner.
NESTED_COLUMNS = [
    "doc_id AS id",
    """concat('{{Box|a=', repeat('{{d|', CAST(doc_id % 20 AS INT)), lang, repeat('}}', CAST(doc_id % 20 AS INT)), '|b=1}} after ',
  CASE doc_id % 6 WHEN 1 THEN '{{open ' WHEN 2 THEN 'stray}} ' WHEN 3 THEN '}}{{a}}{{' WHEN 4 THEN '{{{p}}} {one} ' ELSE '' END,
  '[[File:a.jpg|thumb|see [[Beta]] and [[Image:q|[[Gamma|', source, ']] ]] x]] [[Alpha|', lang, ']] [[ category: C]] ',
  CASE doc_id % 5 WHEN 1 THEN '[[File:open ' WHEN 2 THEN 'stray]] [[x]]' ELSE '[[Delta]]' END, chr(10), '== ', lang, ' ==', chr(10), text) AS text_raw""",
]

#: What is summed over a written report to compare it as a whole.
REPORTS = {
    "overview": "total_pages + 2 * articles_count + 3 * distinct_titles",
    "namespace_distribution": "count * (ns + 1)",
    "text_length_summary_global": "min + 2 * p50 + 3 * p90 + 5 * p99 + 7 * max",
    "text_length_summary_articles": "min + 2 * p50 + 3 * p90 + 5 * p99 + 7 * max + articles_count",
    "link_density_summary": "min_links + 2 * p50_links + 3 * p90_links + 5 * max_links",
    "top_most_linked": "text_len + 2 * link_count + 3 * template_count",
    "top_tokens": "count * length(token)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A scan with fewer splits than cores, dealt out more finely; a larger one as it is.

    A small file with one row group would otherwise keep the whole text work in
    one task.
    """
    cores, splits = scan.sparkSession.sparkContext.defaultParallelism, scan.rdd.getNumPartitions()
    return scan if splits >= cores else scan.repartition(min(cores, 8 * splits))


def wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(*PAGE_COLUMNS)


def wiki_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages for work on their whole text."""
    return spread(table(spark, sf_dir, "documents")).selectExpr(*PAGE_COLUMNS)


def markup_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).selectExpr(*MARKUP_COLUMNS)


def _linked(pages: DataFrame, categories: bool = True) -> DataFrame:
    """Pages with the arrays that the graph is made of, written once."""
    arrays = {"links": wikitext.links(F.col("text_raw"))} | ({"categories": wikitext.categories(F.col("text_raw"))} if categories else {})
    return durable(pages.withColumns(arrays), "linked_pages")


def shared_title_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linked(table(spark, sf_dir, "documents").selectExpr(*SHARED_COLUMNS))


def redirect_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linked(table(spark, sf_dir, "documents").selectExpr(*CHAIN_COLUMNS), categories=False)


def deep_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).selectExpr(*NESTED_COLUMNS)


def nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages in the nested shape of an XML dump."""
    page = F.col
    return wiki_texts(spark, sf_dir).select(
        "title",
        "ns",
        "id",
        F.when(page("redirect").isNotNull(), F.struct(page("redirect").alias("_title"))).alias("redirect"),
        F.struct(
            page("revision_id").alias("id"),
            "timestamp",
            F.struct(F.length("text_raw").alias("_bytes"), page("text_raw").alias("_VALUE")).alias("text"),
        ).alias("revision"),
    )
