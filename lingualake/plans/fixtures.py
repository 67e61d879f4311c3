"""Localization tables derived from the given tables. The same SQL runs in Spark and in the checking engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import SECTIONS
from ..sources.tables import read

CATALOG = """
WITH loc AS (SELECT 'es' AS l, 1 AS k UNION ALL SELECT 'fr', 2 UNION ALL SELECT 'de', 3)
SELECT concat('p', CAST(p_partkey AS STRING)) AS id, 'en' AS _locale, p_partkey AS _parent_id, p_name AS title, p_brand AS brand, p_type AS kind
FROM part
UNION ALL
SELECT concat('p', CAST(p_partkey AS STRING), '_', l), l, p_partkey,
       CASE WHEN (p_partkey + k) % 4 = 1 THEN p_name WHEN (p_partkey + k) % 4 = 2 THEN concat('humano ', p_name) ELSE '' END, p_brand, p_type
FROM part CROSS JOIN loc
WHERE (p_partkey + k) % 4 <> 0"""
NUMBERED = """
WITH loc AS (SELECT 'es' AS l, 1 AS k UNION ALL SELECT 'fr', 2 UNION ALL SELECT 'de', 3)
SELECT p_partkey * 10 AS id, CASE WHEN p_partkey % 2 = 0 THEN concat('u', CAST(p_partkey AS STRING)) END AS _uuid, 'en' AS _locale, p_partkey AS _parent_id, p_name AS title
FROM part
UNION ALL
SELECT p_partkey * 10 + k, CASE WHEN (p_partkey + k) % 5 < 2 THEN concat('u', CAST(p_partkey AS STRING), '_', l) END, l,
       CASE WHEN p_partkey % 3 = 0 THEN p_partkey + 1 ELSE p_partkey END, concat(l, ' ', p_name)
FROM part CROSS JOIN loc
WHERE (p_partkey + k) % 4 <> 0"""
_BODY = '''concat('{"root":{"type":"root","children":[{"type":"text","text":"', {a}, '"},{"type":"paragraph","children":[{"text":"', {b}, '","type":"text"},{"type":"text","text":" "}]},{"type":"text","text":"https://a.example/x"},{"type":"text","text":"', {a}, '"}]}}')'''
_OTHER_ORDER = _BODY.replace('{"root":{"type":"root","children":', '{"root":{"children":').replace("}]}}')", "}],\"type\":\"root\"}}')")
_LONG = "concat(p_name, ' and ', p_type)"
#: A table with a JSON column of rich text. Targets by (p_partkey + k) % 6: 0 none, 1 empty, 2 the source with its keys in another
#: order, 3 translated, 4 translated but for one long leaf, 5 no rich text.
RICH = f"""
WITH loc AS (SELECT 'es' AS l, 1 AS k UNION ALL SELECT 'fr', 2 UNION ALL SELECT 'de', 3)
SELECT concat('p', CAST(p_partkey AS STRING)) AS id, 'en' AS _locale, p_partkey AS _parent_id, p_name AS title, {_BODY.replace("{a}", "p_name").replace("{b}", _LONG)} AS body
FROM part
UNION ALL
SELECT concat('p', CAST(p_partkey AS STRING), '_', l), l, p_partkey, CASE WHEN (p_partkey + k) % 6 = 1 THEN '' ELSE concat('[', l, '] ', p_name) END,
       CASE (p_partkey + k) % 6 WHEN 1 THEN NULL WHEN 2 THEN {_OTHER_ORDER.replace("{a}", "p_name").replace("{b}", _LONG)}
       WHEN 3 THEN {_BODY.replace("{a}", "concat('[', l, '] ', p_name)").replace("{b}", f"concat('[', l, '] ', {_LONG})")}
       WHEN 4 THEN {_BODY.replace("{a}", "concat('[', l, '] ', p_name)").replace("{b}", _LONG)} ELSE '{{"a":1}}' END
FROM part CROSS JOIN loc
WHERE (p_partkey + k) % 6 <> 0"""
TM = """
SELECT 'en' AS source_locale, l AS target_locale, src, CASE WHEN length(src) % 5 = 0 THEN src ELSE concat('[', l, '] ', src) END AS tgt
FROM (SELECT DISTINCT p_name AS src FROM part) s
CROSS JOIN (SELECT 'es' AS l UNION ALL SELECT 'fr' UNION ALL SELECT 'de' UNION ALL SELECT 'ar') loc
WHERE length(src) % 7 <> 0"""
CHANGES = """
SELECT event_id AS job_id, 'collection' AS entity_type, 'pages' AS slug, user_id AS doc_id,
       CASE WHEN event_id % 5 = 0 THEN 'fr' WHEN event_id % 11 = 0 THEN NULL ELSE 'en' END AS locale,
       CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete' ELSE 'update' END AS operation,
       CASE WHEN event_id % 7 = 0 THEN 'draft' WHEN event_id % 13 = 0 THEN NULL ELSE 'published' END AS status,
       event_id % 17 = 0 AS is_auto, ts, props AS data
FROM events"""
REDIRECTS = """
SELECT concat('/p/', CAST(p_partkey AS STRING)) AS from_path,
       concat('/p/', CAST(CASE WHEN p_partkey % 10 < 9 THEN p_partkey + 1 ELSE p_partkey - 7 END AS STRING)) AS to_path
FROM part
WHERE p_partkey % 10 < 9 OR CAST(floor(p_partkey / 10) AS BIGINT) % 7 = 0"""
SLUG_PARENTS = "SELECT p_partkey AS id, concat(replace(p_name, ' ', '-'), '-', CAST(p_partkey AS STRING)) AS slug FROM part"
SLUG_ROWS = """
WITH loc AS (SELECT 'en' AS l, 0 AS k UNION ALL SELECT 'es', 1 UNION ALL SELECT 'fr', 2)
SELECT p_partkey AS _parent_id, l AS _locale, CASE WHEN (p_partkey + k) % 3 = 0 THEN NULL ELSE concat(replace(p_name, ' ', '-'), '-', CAST(p_partkey % 50 AS STRING)) END AS slug
FROM part CROSS JOIN loc WHERE (p_partkey + k) % 2 = 0"""

#: The slug dictionary as a table; items below two of its sections; paths into them in all its locales.
PAGES = " UNION ALL ".join(f"SELECT '{k}' AS key, '{lo}' AS locale, '{slug}' AS slug" for k, by in SECTIONS.items() for lo, slug in by.items())
ITEMS = """
WITH loc AS (SELECT 'en' AS l UNION ALL SELECT 'es' UNION ALL SELECT 'ja')
SELECT CASE WHEN p_partkey % 2 = 0 THEN 'solutions' ELSE 'blog' END AS section, concat('item-', CAST(p_partkey AS STRING)) AS key, l AS locale,
       CASE WHEN l = 'en' THEN concat('item-', CAST(p_partkey AS STRING)) ELSE concat(l, '-', replace(p_name, ' ', '-'), '-', CAST(p_partkey AS STRING)) END AS slug
FROM part CROSS JOIN loc WHERE p_partkey % 5 < 4"""
PATHS = f"""
WITH d AS (SELECT slug, row_number() OVER (ORDER BY key, locale) - 1 AS i FROM ({PAGES}) x), l AS (SELECT locale, row_number() OVER (ORDER BY locale) - 1 AS j FROM (SELECT DISTINCT locale FROM ({PAGES}) y) z)
SELECT p_partkey AS id, locale, concat('/', slug, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN concat('/item-', CAST(p_partkey AS STRING), '/')
       WHEN 2 THEN concat('/es-', replace(p_name, ' ', '-'), '-', CAST(p_partkey AS STRING)) ELSE '/a/b' END) AS path
FROM part JOIN d ON p_partkey % 45 = i JOIN l ON (p_partkey + CAST(floor(p_partkey / 45) AS BIGINT)) % 9 = j"""


#: Rows of part in a task: each becomes several rows of a table, and a file of few MB holds millions of them.
PARTS_IN_TASK = 25_000
#: Tasks at most: to more of them (Spark's bypassMergeThreshold) the one task that reads a small file would hold all its rows in memory to sort them.
MOST_TASKS = 200


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table part, dealt out by its number of rows: its files are so small that one task would read them all."""
    part = read(spark, sf_dir, "part")
    n = min(-(-part.count() // PARTS_IN_TASK), MOST_TASKS)
    return part.repartition(n, "p_partkey") if n > 1 else part


def fixture(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    for name in ("part", "events"):
        if f"FROM {name}" in sql:
            plain = sql.replace("{", "{{").replace("}", "}}")
            return spark.sql(plain.replace(f"FROM {name}", "FROM {src}"), src=parts(spark, sf_dir) if name == "part" else read(spark, sf_dir, name))
    raise ValueError(sql)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Three localized tables with schemas of their own; the last has no rows in the source locale."""
    part = parts(spark, sf_dir)
    return {
        "catalog": fixture(spark, sf_dir, CATALOG),
        "catalog_texts": fixture(spark, sf_dir, RICH).select("id", "_locale", "_parent_id", "title", "body"),
        "imported": part.select(F.concat(F.lit("i"), F.col("p_partkey").cast("string"), F.lit("_es")).alias("id"), F.lit("es").alias("_locale"), F.col("p_partkey").alias("_parent_id"), F.col("p_name").alias("label")),
    }


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", "lang", F.explode(F.split("text", "\n")).alias("src"))


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents and URLs of pages: what the value rules are tried on."""
    return segments(spark, sf_dir).select(F.col("doc_id").alias("id"), F.col("src").alias("value")).unionByName(read(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("value")))
