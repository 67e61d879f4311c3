"""Registered queries of the library and their checking SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import filters, keys, text, urls
from ..operators import backfill as B
from ..operators import database as DB
from ..operators import documents as D
from ..operators import seo, strings
from ..operators import typed as Y
from ..operators.sync import SyncOptions
from ..sources.sinks import document_store, write_changes
from ..sources.store import KeyedStore
from ..sources.tables import columns_of, localized_tables, read, settled, workspace
from ..streaming import changes as C
from . import fixtures as X

LOCALES = ["es", "fr", "de"]
FIELDS = ["title", "brand", "kind"]

# --- SQL pieces shared by several checks -------------------------------------------------------------------------------
_CAT = f"cat AS ({X.CATALOG})"
_TM = f"tm AS ({X.TM})"
_CH = f"ch AS ({X.CHANGES})"
_ADM = "adm AS (SELECT * FROM ch WHERE coalesce(is_auto, false) = false AND coalesce(locale, 'en') IN ('', 'en') AND operation IN ('create', 'update'))"
_SEG = "seg AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS src FROM documents)"
_VAL = f"{_SEG}, val AS (SELECT doc_id AS id, src AS value FROM seg UNION ALL SELECT page_id, url FROM pages)"


def _t(c: str) -> str:
    return rf"regexp_replace({c}, '^{filters.JS_SPACE}+|{filters.JS_SPACE}+\z', '', 'g')"


def _list(xs) -> str:
    return ", ".join("'" + x + "'" for x in xs)


def _reason(c: str, custom: str = "") -> str:
    t = _t(c)
    links = " OR ".join(f"starts_with({t}, '{p}')" for p in filters.PROTOCOLS)
    rest = " ".join(f"WHEN regexp_matches({t}, '{p}') THEN '{n}'" for n, p in (("id", filters.ID_VALUE), ("mail", filters.MAIL_VALUE), ("number", filters.NUMBER_VALUE), ("file", filters.FILE_VALUE), ("asset", filters.ASSET_VALUE), ("colour", filters.COLOUR_VALUE)))
    return f"CASE WHEN {c} IS NULL OR {t} = '' THEN 'blank' WHEN {links} THEN 'link' WHEN lower({t}) IN ({_list(filters.SYSTEM_VALUES)}) THEN 'system' {custom.replace('$t', t)} {rest} END"


def _need(f: str) -> str:
    return f"({_reason('s_' + f)} IS NULL AND (coalesce(t_{f}, '') = '' OR t_{f} = s_{f}))"


_BASE = r"regexp_replace({}, '(_[a-z]{{2}}(-[A-Z]{{2}})?)+\z', '')"
_MATCH = f"""{_CAT}, src AS (SELECT {_BASE.format('id')} AS key, _parent_id AS parent, title AS s_title, brand AS s_brand, kind AS s_kind, unnest(['es', 'fr', 'de']) AS locale FROM cat WHERE _locale = 'en'),
tgt AS (SELECT {_BASE.format('id')} AS key, _locale AS locale, max(id) AS target_id, arg_max(title, id) AS t_title, arg_max(brand, id) AS t_brand, arg_max(kind, id) AS t_kind FROM cat WHERE _locale <> 'en' GROUP BY 1, 2),
m AS (SELECT s.*, t.target_id IS NOT NULL AS has_target, t.target_id, t_title, t_brand, t_kind FROM src s LEFT JOIN tgt t USING (key, locale)),
n AS (SELECT *, {_need('title')} AS n_title, {_need('brand')} AS n_brand, {_need('kind')} AS n_kind FROM m)"""
_NEEDS = "(n_title OR n_brand OR n_kind)"
_LONG = "SELECT target_id, locale, unnest(['title', 'brand', 'kind']) AS field, unnest([s_title, s_brand, s_kind]) AS src, unnest([n_title, n_brand, n_kind]) AS need FROM n WHERE has_target"
_UPD = f"upd AS (SELECT l.target_id, l.locale, l.field, coalesce(nullif(tgt, ''), l.src) AS value FROM ({_LONG}) l LEFT JOIN tm ON tm.target_locale = l.locale AND tm.src = l.src WHERE need)"


def _new(f: str) -> str:
    return f"CASE WHEN {_reason('s_' + f)} IS NOT NULL THEN s_{f} ELSE coalesce((SELECT max(nullif(tgt, '')) FROM tm WHERE target_locale = locale AND tm.src = s_{f}), s_{f}) END AS {f}"


_INS = f"ins AS (SELECT concat(key, '_', locale) AS id, locale AS _locale, locale AS published_locale, parent AS _parent_id, {_new('title')}, {_new('brand')}, {_new('kind')} FROM n WHERE NOT has_target AND locale IN (SELECT locale FROM n WHERE {_NEEDS}))"
_TITLE = "page AS (SELECT page_id, url, regexp_extract(url, '^(https?://[^/]+)', 1) AS site, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages)"


_NUM = f"""num AS ({X.NUMBERED}), s AS (SELECT id, _uuid, _parent_id, title AS s_title, unnest(['es', 'fr', 'de']) AS locale FROM num WHERE _locale = 'en'),
m AS (SELECT s.id, any_value(s._uuid) AS _uuid, any_value(s._parent_id) AS _parent_id, any_value(s_title) AS s_title, s.locale, max(t.id) AS target_id, arg_max(t.title, t.id) AS t_title
FROM s LEFT JOIN num t ON t._locale = s.locale AND CASE WHEN s._uuid IS NOT NULL THEN {_BASE.format('t._uuid')} = s._uuid ELSE t._parent_id = s._parent_id END GROUP BY s.id, s.locale)"""


_RICH = f"""rich AS ({X.RICH}), {_TM}, rs AS (SELECT id AS key, _parent_id, title, locale, CAST(_parent_id + k AS BIGINT) % 6 AS r FROM rich CROSS JOIN (SELECT 'es' AS locale, 1 AS k UNION ALL SELECT 'fr', 2 UNION ALL SELECT 'de', 3) WHERE _locale = 'en'),
rt AS (SELECT rs.*, coalesce(nullif(tgt, ''), title) AS v, concat(title, ' and ', p_type) AS long, r IN (0, 1, 2, 5) OR r = 4 AND length(concat(title, ' and ', p_type)) >= 20 AS need FROM rs JOIN part ON p_partkey = _parent_id LEFT JOIN tm ON target_locale = locale AND src = title)"""
_LEAVES = "unnest([0, 1, 2, 3]) AS pos, unnest([v, long, 'https://a.example/x', v]) AS leaf"


# --- Spark sides ---------------------------------------------------------------------------------------------------------
def _catalog(s, d) -> DataFrame:
    return X.fixture(s, d, X.CATALOG)


def _tm(s, d) -> DataFrame:
    return X.fixture(s, d, X.TM)


def _matched(s, d) -> DataFrame:
    return B.with_needs(B.match_target_rows(_catalog(s, d), LOCALES, FIELDS), FIELDS)


def _numbered(s, d) -> DataFrame:
    """A table with numeric ids: half of its source rows have a _uuid, the others only their parent."""
    return B.match_target_rows(X.fixture(s, d, X.NUMBERED), LOCALES, ["title"])


def _rich(s, d) -> DataFrame:
    """A table with rich text in a JSON column."""
    return B.with_needs(B.match_target_rows(X.fixture(s, d, X.RICH), LOCALES, ["title", "body"], rich=["body"]), ["title", "body"], ["body"])


def _leaves(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, F.posexplode(D.richtext_strings("body")).alias("pos", "leaf"))


def _stored(s, d) -> DataFrame:
    """The catalog after its change set went into a keyed store twice and the store was compacted."""
    table, m, tm = _catalog(s, d), settled(_matched(s, d)), strings.memory(_tm(s, d))
    store = KeyedStore(s, workspace(s), ["id"], 8)
    store.create(table)
    for _ in range(2):
        write_changes(store, 0, B.update_rows(m, tm, FIELDS).drop("_parent_id", "_locale"), B.build_inserts(m, tm, FIELDS))
    store.compact(keep=0)
    return store.read()


def _stored_without_id(s, d) -> DataFrame:
    """A table that has no ids, by parent and locale: one change set, written twice."""
    table = _catalog(s, d).drop("id")
    m = settled(B.with_needs(B.match_target_rows(table, LOCALES, FIELDS), FIELDS))
    store = KeyedStore(s, workspace(s), ["_parent_id", "_locale"], 8)
    store.create(table)
    tm = strings.memory(_tm(s, d))
    for _ in range(2):
        write_changes(store, 0, B.update_rows(m, tm, FIELDS), B.build_inserts(m, tm, FIELDS))
    return store.read()


def _streamed(s, d) -> DataFrame:
    """The conversations as a stream of changed documents in three files, and what the store holds after it."""
    changes, existing = _document_changes(s, d)
    top, inbox = workspace(s), workspace(s)
    end = changes.limit(1).withColumn("doc_id", F.lit(-1).cast("long")).withColumn("ts", F.to_timestamp(F.lit("2020-01-01")))  # ends the other sessions
    for k in range(3):
        part = changes.where(F.col("doc_id") % 3 == k)
        (part.unionByName(end) if k == 2 else part).write.mode("append").parquet(inbox)
    store = document_store(s, f"{top}/documents", 8, existing)
    C.continuous_sync(C.read_changes(s, inbox, files=1000), store, _memory(s, d), SyncOptions(("es",)), f"{top}/job", "1 second", "3650 days").awaitTermination()
    return _rebuilt(store.read().where("doc IS NOT NULL AND ts IS NOT NULL"), "key", "locale")


def _database(s, d) -> DB.Backfill:
    tables = {name: DB.Table(df, ("body",) if "body" in df.columns else ()) for name, df in X.tables(s, d).items()}
    return DB.plan_backfill(tables, LOCALES, _tm(s, d))


def _database_changes(s, d) -> DataFrame:
    plan, out = _database(s, d).whole(), None
    for name in plan.matched:
        for op, df in zip(("update", "insert"), DB.change_sets(plan, name)):
            part = df.select(F.lit(name).alias("table"), F.lit(op).alias("op"), "id", F.col("_locale").alias("locale"))
            out = part if out is None else out.unionByName(part)
    return out


def _database_run(s, d) -> DataFrame:
    plan, top = _database(s, d), workspace(s)
    stores = {name: KeyedStore(s, f"{top}/{name}", ["id"], 8) for name in plan.matched}
    for name, store in stores.items():
        store.create(plan.tables[name].rows)
    return DB.run_backfill(plan, stores, 0, f"{top}-log").select("table", "status", "updated", "inserted")


def _changes(s, d) -> DataFrame:
    return X.fixture(s, d, X.CHANGES)


def _pages(s, d) -> DataFrame:
    p = read(s, d, "pages")
    return p.select("page_id", "url", F.regexp_extract("url", "^(https?://[^/]+)", 1).alias("site"), F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"))


def _routes(s, d) -> DataFrame:
    return seo.localized_routes(X.fixture(s, d, X.SLUG_PARENTS).select(F.col("id").alias("doc_id"), "slug"), "solutions", LOCALES)


def _per_page(out: str, f):
    def run(s: SparkSession, d: str) -> DataFrame:
        return _pages(s, d).select("page_id", f().alias(out))

    return run


def _blocks(s, d) -> DataFrame:
    """Source and existing documents with one block a turn, as JSON."""
    c = read(s, d, "conversations")
    block = F.struct(F.col("turn"), F.concat(F.lit("b"), F.col("turn").cast("string")).alias("id"), F.col("role").alias("blockType"), F.col("text").alias("body"))
    new = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(block)).alias("b"))
    old = F.reverse(F.transform("b", lambda x: F.struct(F.concat(x["id"], F.lit("_es")).alias("id"), x["blockType"].alias("blockType"), F.when(x["turn"] % 2 == 0, "").otherwise(F.concat(F.lit("es "), x["body"])).alias("body"))))
    src = F.transform("b", lambda x: F.struct(x["id"].alias("id"), x["blockType"].alias("blockType"), x["body"].alias("body")))
    keep = {"ignoreNullFields": "false"}
    return new.select("conv_id", F.to_json(F.struct(src.alias("sections")), keep).alias("new"), F.to_json(F.struct(old.alias("sections")), keep).alias("old"))


def _merged(s, d) -> DataFrame:
    out = _blocks(s, d).withColumn("doc", F.from_json(D.merge_documents("new", "old"), "sections array<struct<id:string,blockType:string,body:string>>"))
    return out.select(F.col("conv_id").alias("doc_id"), F.posexplode("doc.sections").alias("pos", "x")).select("doc_id", "pos", "x.id", "x.blockType", "x.body")


def _jsonld(s, d) -> DataFrame:
    p = X.parts(s, d)
    page = F.struct(F.lit("WebPage").alias("@type"), F.col("p_name").alias("name"), F.concat(F.lit("About "), F.col("p_type")).alias("description"))
    product = F.struct(F.lit("Product").alias("@type"), F.col("p_name").alias("name"), F.struct(F.lit("Brand").alias("@type"), F.col("p_brand").alias("name")).alias("brand"))
    return p.select(F.col("p_partkey").alias("page_id"), F.concat(F.lit('{"@context":"https://schema.org","@graph":['), F.to_json(page), F.lit(","), F.to_json(product), F.lit("]}")).alias("schema"))


def _jsonld_strings(s, d) -> DataFrame:
    rows = _jsonld(s, d).select("page_id", F.explode(D.jsonld_strings("schema")).alias("src"))
    return rows.where(~filters.should_skip_value(F.col("src")))


def _documents(s, d) -> DataFrame:
    return _blocks(s, d).select(F.col("conv_id").alias("doc_id"), F.col("new").alias("doc"))


def _memory(s, d) -> DataFrame:
    """Translations of a third of the turns, into two locales."""
    c = read(s, d, "conversations").where("length(text) % 3 = 0").select("text").distinct()
    return c.select(F.explode(F.array(F.lit("es"), F.lit("fr"))).alias("target_locale"), F.col("text").alias("src")).withColumn("tgt", F.concat(F.lit("["), "target_locale", F.lit("] "), "src"))


_SECTIONS = "sections array<struct<id:string,blockType:string,body:string>>"


def _typed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("doc", F.from_json("doc", _SECTIONS))


def _typed_merge(s, d) -> DataFrame:
    b = _blocks(s, d).select(F.col("conv_id").alias("doc_id"), F.from_json("new", _SECTIONS).alias("new"), F.from_json("old", _SECTIONS).alias("old"))
    one = b.select("doc_id", Y.merged(F.col("new"), F.col("old"), b.schema["new"].dataType).alias("doc"))
    return one.select("doc_id", F.posexplode("doc.sections").alias("pos", "x")).select("doc_id", "pos", "x.*")


def _rebuilt(docs: DataFrame, *keys: str) -> DataFrame:
    out = docs.withColumn("doc", F.from_json("doc", _SECTIONS))
    return out.select(*keys, F.posexplode("doc.sections").alias("pos", "x")).select(*keys, "pos", "x.id", "x.blockType", "x.body")


def _document_changes(s, d) -> tuple[DataFrame, DataFrame]:
    """Each conversation as a changed document; half of them have a translation already."""
    b = _blocks(s, d)
    changes = b.select(F.col("conv_id").alias("job_id"), F.lit("collection").alias("entity_type"), F.lit("pages").alias("slug"), F.col("conv_id").alias("doc_id"), F.lit("en").alias("locale"), F.lit("update").alias("operation"), F.lit("published").alias("status"), F.lit(False).alias("is_auto"), F.timestamp_seconds("conv_id").alias("ts"), F.col("new").alias("data"))
    existing = b.where("conv_id % 2 = 0").select(F.concat(F.lit("collection:pages:"), F.col("conv_id").cast("string")).alias("key"), F.lit("es").alias("locale"), F.col("old").alias("doc"))
    return changes, existing


def _synced(s, d) -> DataFrame:
    return _rebuilt(C.synced_documents(*_document_changes(s, d), _memory(s, d), ["es"]), "key", "locale")


def _jsonld_page(s, d) -> DataFrame:
    p = X.parts(s, d)
    url = F.concat(F.lit("https://www.example.com/p/"), F.col("p_partkey").cast("string"))
    page = F.struct(F.lit("WebPage").alias("@type"), F.concat(url, F.lit("#page")).alias("@id"), url.alias("url"), F.col("p_name").alias("name"), F.array(F.col("p_type")).alias("about"))
    schema = F.concat(F.lit('{"@graph":['), F.to_json(page), F.lit("]}"))
    return p.select(F.col("p_partkey").alias("page_id"), schema.alias("schema"), F.when(F.col("p_partkey") % 3 == 0, F.lit('{"kept":true}')).alias("existing"))


def _localized_jsonld(overwrite: bool):
    def run(s: SparkSession, d: str) -> DataFrame:
        out = D.localize_jsonld(_jsonld_page(s, d), _tm(s, d), "es", "https://www.example.com", overwrite)
        parts = {"name": "$['@graph'][0].name", "url": "$['@graph'][0].url", "at_id": "$['@graph'][0]['@id']", "lang": "$['@graph'][0].inLanguage", "about": "$['@graph'][0].about[0]", "context": "$['@context']", "kept": "$.kept"}
        return out.select("page_id", *(F.get_json_object("schema", v).alias(k) for k, v in parts.items()))

    return run


def _jsonld_sql(overwrite: bool) -> str:
    def cols(some: str, kept: str) -> str:
        return f"SELECT page_id, {some}, {kept} AS kept FROM p"

    full = "coalesce(nullif(tgt, ''), p_name) AS name, concat('https://www.example.com/es/p/', page_id) AS url, concat('https://www.example.com/es/p/', page_id, '#page') AS at_id, 'es' AS lang, p_type AS about, 'https://schema.org' AS context"
    none = "NULL AS name, NULL AS url, NULL AS at_id, NULL AS lang, NULL AS about, NULL AS context"
    every = cols(full, "NULL")
    rest = "" if overwrite else f" WHERE page_id % 3 <> 0 UNION ALL {cols(none, chr(39) + 'true' + chr(39))} WHERE page_id % 3 = 0"
    return f"WITH {_TM}, p AS (SELECT p_partkey AS page_id, p_name, p_type, tgt FROM part LEFT JOIN tm ON target_locale = 'es' AND src = p_name) {every}{rest}"


def _fields(s, d) -> DataFrame:
    return read(s, d, "part").select(F.col("p_brand").alias("collection"), F.explode(F.array(F.lit("title"), F.lit("notes"), F.lit("body"))).alias("field"), F.col("p_partkey").alias("id"))


def _translated(s, d) -> DataFrame:
    return _tm(s, d).select(F.col("target_locale").alias("locale"), F.initcap("src").alias("src"), F.when(F.length("tgt") % 2 == 0, F.initcap("src")).otherwise(F.col("tgt")).alias("tgt"))


_TRANSLATED = f"{_TM}, tr AS (SELECT target_locale AS locale, array_to_string(list_transform(string_split(src, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS src, tgt FROM tm), tr2 AS (SELECT locale, src, CASE WHEN length(tgt) % 2 = 0 THEN src ELSE tgt END AS tgt FROM tr)"
_ECHO = r"(tgt IS NULL OR trim(tgt) = '' OR tgt = src OR (locale = 'ar' AND NOT regexp_matches(tgt, '[\x{0600}-\x{06FF}\x{0750}-\x{077F}]') AND regexp_matches(tgt, '[A-Za-z]{3,}')))"
_HEAD = r"(length(src) >= 8 AND contains(src, ' ') AND len(list_filter(regexp_split_to_array(src, '\s+'), lambda w: regexp_matches(w, '^[A-Za-z]'))) >= 2 AND len(list_filter(regexp_split_to_array(src, '\s+'), lambda w: regexp_matches(w, '^[A-Z]'))) >= 0.6 * len(list_filter(regexp_split_to_array(src, '\s+'), lambda w: regexp_matches(w, '^[A-Za-z]'))))"


def _slug_sql(c: str) -> str:
    h = rf"regexp_replace(regexp_replace(lower(strip_accents({c})), '[^a-z0-9]+', '-', 'g'), '^-+|-+\z', '', 'g')"
    cut = f"left({h}, 40)"
    last = f"(length({cut}) - strpos(reverse({cut}), '-'))"
    return rf"CASE WHEN length({h}) > 40 THEN regexp_replace(CASE WHEN contains({cut}, '-') AND {last} > 12 THEN left({cut}, {last}) ELSE {cut} END, '-+\z', '') ELSE {h} END"


_PATH = "regexp_extract(url, '^https?://[^/]+([^?#]*)', 1)"
_FRAG = "regexp_extract(url, '(#.*)$', 1)"
_BARE = f"(CASE WHEN regexp_matches({_PATH}, '^/[A-Za-z]{{2}}(/|$)') THEN substr({_PATH}, 4) ELSE {_PATH} END)"

_TRANSLATED_DOCS = f"WITH t AS (SELECT *, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos, unnest(['es', 'fr']) AS locale FROM conversations) SELECT conv_id AS doc_id, locale, pos, concat('b', turn, '_', locale) AS id, role AS blockType, CASE WHEN length(text) % 3 = 0 AND {_reason('text')} IS NULL THEN concat('[', locale, '] ', text) ELSE text END AS body FROM t"
_MERGED_BLOCKS = "SELECT conv_id AS doc_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos, concat('b', turn) AS id, role AS blockType, CASE WHEN turn % 2 <> 0 THEN concat('es ', text) ELSE text END AS body FROM conversations"
_APPLIED = f"WITH {_MATCH}, {_TM}, {_UPD}, {_INS} SELECT c.id, _locale, _parent_id, coalesce((SELECT max(value) FROM upd WHERE target_id = c.id AND field = 'title'), title) AS title, coalesce((SELECT max(value) FROM upd WHERE target_id = c.id AND field = 'brand'), brand) AS brand, coalesce((SELECT max(value) FROM upd WHERE target_id = c.id AND field = 'kind'), kind) AS kind FROM cat c UNION ALL SELECT id, _locale, _parent_id, title, brand, kind FROM ins"
_SYNC_SQL = f"SELECT concat('collection:pages:', conv_id) AS key, 'es' AS locale, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos, concat('b', turn, '_es') AS id, role AS blockType, CASE WHEN conv_id % 2 = 0 AND turn % 2 <> 0 THEN concat('es ', text) WHEN length(text) % 3 = 0 AND {_reason('text')} IS NULL THEN concat('[es] ', text) ELSE text END AS body FROM conversations"

#: name: (Spark query, checking SQL or None)
ENTRIES: dict = {
    "read_localized": (lambda s, d: _catalog(s, d).where("_locale = 'en'").select("id", "_parent_id", "title"), f"WITH {_CAT} SELECT id, _parent_id, title FROM cat WHERE _locale = 'en'"),
    "should_skip_value": (lambda s, d: X.values(s, d).where(filters.should_skip_value(F.col("value"))).select("id", "value"), f"WITH {_VAL} SELECT id, value FROM val WHERE {_reason('value')} IS NOT NULL"),
    "skip_reason": (lambda s, d: X.values(s, d).groupBy(F.coalesce(filters.skip_reason(F.col("value")), F.lit("translate")).alias("reason")).agg(F.count("*").alias("n")), f"WITH {_VAL} SELECT coalesce({_reason('value')}, 'translate') AS reason, count(*) AS n FROM val GROUP BY 1"),
    "custom_value_patterns": (lambda s, d: X.values(s, d).groupBy(F.coalesce(filters.skip_reason(F.col("value"), patterns=[r"^the\b"]), F.lit("translate")).alias("reason")).agg(F.count("*").alias("n")), f"""WITH {_VAL} SELECT coalesce({_reason('value', "WHEN regexp_matches($t, '(?i)^the[^a-zA-Z0-9_]|(?i)^the$') THEN 'custom_pattern'")}, 'translate') AS reason, count(*) AS n FROM val GROUP BY 1"""),
    "custom_value_exclusions": (lambda s, d: _catalog(s, d).where(filters.should_skip_value(F.col("brand"), exact=["Brand#11", "Brand#23"])).select("id", "brand"), f"WITH {_CAT} SELECT id, brand FROM cat WHERE brand IN ('Brand#11', 'Brand#23')"),
    "translatable_fields": (lambda s, d: strings.long_form(_catalog(s, d), ["id"], ["_locale", "_parent_id", "title", "brand", "kind"]).where(filters.translatable_field(F.col("field"), excluded=["kind"])).groupBy("field").agg(F.count("*").alias("n")), f"WITH {_CAT} SELECT unnest(['title', 'brand']) AS field, count(*) AS n FROM cat GROUP BY 1"),
    "admit_changes": (lambda s, d: _changes(s, d).where(C.admitted(drafts=False)).select("job_id", "doc_id"), f"WITH {_CH} SELECT job_id, doc_id FROM ch WHERE NOT is_auto AND coalesce(locale, 'en') = 'en' AND operation IN ('create', 'update') AND coalesce(status, '') <> 'draft'"),
    "loop_guard": (lambda s, d: _changes(s, d).where(~F.coalesce("is_auto", F.lit(False))).select("job_id"), f"WITH {_CH} SELECT job_id FROM ch WHERE NOT is_auto"),
    "fan_out_locales": (lambda s, d: B.fan_out_locales(_catalog(s, d).where("_locale = 'en'"), LOCALES).select("id", "locale"), f"WITH {_CAT} SELECT id, unnest(['es', 'fr', 'de']) AS locale FROM cat WHERE _locale = 'en'"),
    "match_target_rows": (lambda s, d: B.match_target_rows(_catalog(s, d), LOCALES, FIELDS).select("key", "locale", "has_target", "target_id", "t_title"), f"WITH {_MATCH} SELECT key, locale, has_target, target_id, t_title FROM m"),
    "match_target_rows_numbered": (lambda s, d: _numbered(s, d).select("key", "locale", "has_target", F.col("target_id").cast("string").alias("target_id"), "t_title"), f"WITH {_NUM} SELECT CAST(id AS VARCHAR) AS key, locale, target_id IS NOT NULL AS has_target, CAST(target_id AS VARCHAR) AS target_id, t_title FROM m"),
    "build_inserts_numbered": (lambda s, d: B.build_inserts(B.with_needs(_numbered(s, d), ["title"]), _tm(s, d), ["title"], every=True).select("_uuid", "_locale", "_parent_id", "title"), f"WITH {_NUM}, {_TM} SELECT CASE WHEN _uuid IS NOT NULL THEN concat(_uuid, '_', locale) END AS _uuid, locale AS _locale, _parent_id, {_new('title')} FROM m WHERE target_id IS NULL"),
    "parent_key_rewrite": (lambda s, d: _catalog(s, d).select("id", keys.parent_key(F.concat(F.lit("c"), F.col("_parent_id").cast("string"), F.lit("_en")), F.col("_locale"), True, True).alias("_parent_id")), f"WITH {_CAT} SELECT id, concat('c', _parent_id, '_', _locale) AS _parent_id FROM cat"),
    "missing_rows": (lambda s, d: B.match_target_rows(_catalog(s, d), LOCALES, FIELDS).where("NOT has_target").select("key", "locale"), f"WITH {_MATCH} SELECT key, locale FROM m WHERE NOT has_target"),
    "tables_with_source": (lambda s, d: _database(s, d).whole().gate, f"WITH {_MATCH}, {_RICH} SELECT DISTINCT 'catalog' AS \"table\", locale FROM n WHERE {_NEEDS} UNION ALL SELECT DISTINCT 'catalog_texts', locale FROM rt WHERE need"),
    "database_strings": (lambda s, d: _database(s, d).whole().strings.select("locale", "src").distinct(), f"WITH {_MATCH}, {_RICH}, l AS (SELECT locale, unnest([s_title, s_brand, s_kind]) AS src, unnest([n_title, n_brand, n_kind]) AS need FROM n UNION ALL SELECT locale, unnest([title, long, title]), unnest([need, need, r IN (0, 1)]) FROM rt) SELECT DISTINCT locale, src FROM l WHERE need AND {_reason('src')} IS NULL"),
    "database_changes": (_database_changes, f"WITH {_MATCH}, {_RICH}, {_UPD}, {_INS} SELECT DISTINCT 'catalog' AS \"table\", 'update' AS op, target_id AS id, locale FROM upd UNION ALL SELECT 'catalog', 'insert', id, _locale FROM ins UNION ALL SELECT 'catalog_texts', CASE r WHEN 0 THEN 'insert' ELSE 'update' END, concat(key, '_', locale), locale FROM rt WHERE need OR r = 0"),
    "backfill_report": (lambda s, d: DB.backfill_report(_database(s, d).whole()), f"""WITH {_MATCH}, {_RICH}, a AS (SELECT 'catalog' AS t, locale, has_target, {_NEEDS} AS needs FROM n UNION ALL SELECT 'catalog_texts', locale, r <> 0, need FROM rt),
w AS (SELECT t, locale, bool_or(needs) AS work FROM a GROUP BY 1, 2), c AS (SELECT t, locale, count(*) AS rows_seen, count(*) FILTER (work AND NOT has_target) AS to_insert, count(*) FILTER (work AND has_target AND needs) AS to_update, count(*) FILTER (NOT work OR has_target AND NOT needs) AS skipped FROM a JOIN w USING (t, locale) GROUP BY 1, 2),
l AS (SELECT 'catalog' AS t, locale, unnest([s_title, s_brand, s_kind]) AS src, unnest([n_title, n_brand, n_kind]) AS need FROM n UNION ALL SELECT 'catalog_texts', locale, unnest([title, long, title]), unnest([need, need, r IN (0, 1)]) FROM rt),
e AS (SELECT DISTINCT t, locale, src FROM l WHERE need AND {_reason('src')} IS NULL), s AS (SELECT e.t, e.locale, count(*) AS strings, count(*) FILTER (tgt <> e.src) AS translated FROM e LEFT JOIN tm ON target_locale = e.locale AND tm.src = e.src GROUP BY 1, 2)
SELECT t AS "table", locale, coalesce(strings, 0) AS strings, coalesce(translated, 0) AS translated, CAST(0 AS BIGINT) AS failed, rows_seen, to_insert, to_update, skipped FROM c LEFT JOIN s USING (t, locale)"""),
    "backfill_run": (_database_run, f"WITH {_MATCH}, {_RICH}, {_UPD}, {_INS} SELECT 'catalog' AS \"table\", 'completed' AS status, (SELECT count(DISTINCT target_id) FROM upd) AS updated, (SELECT count(*) FROM ins) AS inserted UNION ALL SELECT 'catalog_texts', 'completed', count(*) FILTER (need AND r <> 0), count(*) FILTER (r = 0) FROM rt UNION ALL SELECT 'imported', 'completed', 0, 0"),
    "locale_gate": (lambda s, d: _matched(s, d).groupBy("locale").agg(F.count_if("needs").alias("n_needs")).where("n_needs > 0"), f"WITH {_MATCH} SELECT locale, count(*) AS n_needs FROM n WHERE {_NEEDS} GROUP BY 1"),
    "tm_lookup": (lambda s, d: strings.tm_lookup(B.fan_out_locales(_catalog(s, d).where("_locale = 'en'"), LOCALES), _tm(s, d), "title", "locale").select("id", "locale", "translated"), f"WITH {_CAT}, {_TM} SELECT c.id, c.locale, coalesce(nullif(tgt, ''), title) AS translated FROM (SELECT id, title, unnest(['es', 'fr', 'de']) AS locale FROM cat WHERE _locale = 'en') c LEFT JOIN tm ON target_locale = c.locale AND src = title"),
    "field_needs_translation": (lambda s, d: _matched(s, d).select("key", "locale", "n_title", "n_brand"), f"WITH {_MATCH} SELECT key, locale, n_title, n_brand FROM n"),
    "needs_translation_rows": (lambda s, d: _matched(s, d).where("needs").select("key", "locale"), f"WITH {_MATCH} SELECT key, locale FROM n WHERE {_NEEDS}"),
    "collect_missing_strings": (lambda s, d: B.missing_strings(_matched(s, d), FIELDS), f"WITH {_MATCH}, l AS (SELECT locale, unnest([s_title, s_brand, s_kind]) AS src, unnest([n_title, n_brand, n_kind]) AS need FROM n) SELECT DISTINCT locale, src FROM l WHERE need"),
    "build_updates": (lambda s, d: B.build_updates(_matched(s, d), _tm(s, d), FIELDS), f"WITH {_MATCH}, {_TM}, {_UPD} SELECT * FROM upd"),
    "build_inserts": (lambda s, d: B.build_inserts(_matched(s, d), _tm(s, d), FIELDS), f"WITH {_MATCH}, {_TM}, {_INS} SELECT * FROM ins"),
    "apply_changes": (lambda s, d: B.apply_changes(_catalog(s, d), B.build_updates(m := _matched(s, d), t := _tm(s, d), FIELDS), B.build_inserts(m, t, FIELDS), FIELDS), _APPLIED),
    "write_changes": (_stored, _APPLIED),
    "write_changes_without_id": (_stored_without_id, _APPLIED.replace("c.id, _locale", "_locale").replace("SELECT id, _locale", "SELECT _locale")),
    "richtext_needs": (lambda s, d: _rich(s, d).select("key", "locale", "n_body", "needs"), f"WITH {_RICH} SELECT key, locale, need AS n_body, need AS needs FROM rt"),
    "collect_missing_leaves": (lambda s, d: B.missing_strings(_rich(s, d), ["title", "body"], ["body"]), f"WITH {_RICH}, l AS (SELECT locale, unnest([title, long]) AS src FROM rt WHERE need) SELECT DISTINCT locale, src FROM l WHERE {_reason('src')} IS NULL"),
    "build_updates_richtext": (lambda s, d: _leaves(B.update_rows(_rich(s, d), _tm(s, d), ["title", "body"], ["body"]).withColumn("changed", F.array_join("changed", ",")), "id", "_locale", "changed", "title"), f"WITH {_RICH} SELECT concat(key, '_', locale) AS id, locale AS _locale, CASE r WHEN 1 THEN 'title,body' ELSE 'body' END AS changed, CASE r WHEN 1 THEN v END AS title, {_LEAVES} FROM rt WHERE need AND r <> 0"),
    "build_inserts_richtext": (lambda s, d: _leaves(B.build_inserts(_rich(s, d), _tm(s, d), ["title", "body"], rich=["body"]), "id", "_locale", "_parent_id", "title"), f"WITH {_RICH} SELECT concat(key, '_', locale) AS id, locale AS _locale, _parent_id, v AS title, {_LEAVES} FROM rt WHERE r = 0"),
    "union_changes": (lambda s, d: B.build_updates(m := _matched(s, d), t := _tm(s, d), FIELDS).select(F.lit("update").alias("op"), F.col("target_id").alias("id"), F.col("locale")).unionByName(B.build_inserts(m, t, FIELDS).select(F.lit("insert").alias("op"), "id", F.col("_locale").alias("locale"))), f"WITH {_MATCH}, {_TM}, {_UPD}, {_INS} SELECT 'update' AS op, target_id AS id, locale FROM upd UNION ALL SELECT 'insert', id, _locale FROM ins"),
    "backfill_plan": (lambda s, d: B.dry_run_plan(_matched(s, d)), f"WITH {_MATCH} SELECT locale, CASE WHEN NOT has_target THEN 'insert' WHEN {_NEEDS} THEN 'update' ELSE 'keep' END AS op, count(*) AS n FROM n GROUP BY 1, 2"),
    "backfill_summary": (lambda s, d: B.summary(_matched(s, d), "catalog"), f"WITH {_MATCH} SELECT table_name, locale, count(*) AS rows_seen, count(*) FILTER (NOT has_target) AS to_insert, count(*) FILTER (has_target AND {_NEEDS}) AS to_update, count(*) FILTER (has_target AND NOT {_NEEDS}) AS skipped FROM (SELECT 'catalog' AS table_name, * FROM n) GROUP BY ROLLUP (table_name, locale)"),
    "locale_coverage": (lambda s, d: B.coverage(_matched(s, d), FIELDS), f"WITH {_MATCH}, l AS (SELECT locale, unnest(['title', 'brand', 'kind']) AS field, unnest([s_title, s_brand, s_kind]) AS src, unnest([n_title, n_brand, n_kind]) AS need FROM n) SELECT locale, field, count(*) AS n, count(*) FILTER (NOT need) AS done FROM l WHERE {_reason('src')} IS NULL GROUP BY 1, 2"),
    "distinct_strings": (lambda s, d: strings.distinct_strings(X.segments(s, d).where(~filters.should_skip_value(F.col("src"))), ["lang"]), f"WITH {_SEG} SELECT DISTINCT lang, src FROM seg WHERE {_reason('src')} IS NULL"),
    "except_translated": (lambda s, d: strings.except_translated(B.missing_strings(_matched(s, d), FIELDS), _tm(s, d)), f"WITH {_MATCH}, {_TM}, l AS (SELECT locale, unnest([s_title, s_brand, s_kind]) AS src, unnest([n_title, n_brand, n_kind]) AS need FROM n) SELECT DISTINCT locale, src FROM l WHERE need AND NOT EXISTS (SELECT 1 FROM tm WHERE target_locale = locale AND tm.src = l.src)"),
    "batch_assign": (lambda s, d: strings.batch_assign(strings.distinct_strings(X.segments(s, d).where(~filters.should_skip_value(F.col("src"))), ["lang"]), ["lang"]).groupBy("lang", "bucket", "batch").agg(F.count("*").alias("n"), F.sum(F.length("src")).cast("long").alias("chars")), f"WITH RECURSIVE {_SEG}, s AS (SELECT DISTINCT lang, src FROM seg WHERE {_reason('src')} IS NULL), b AS (SELECT lang, CAST(('0x' || substr(md5(src), 1, 4)) AS INTEGER) % 32 AS bucket, length(src) AS len, row_number() OVER (PARTITION BY lang, CAST(('0x' || substr(md5(src), 1, 4)) AS INTEGER) % 32 ORDER BY src) AS rn FROM s), w AS (SELECT lang, bucket, rn, len, len AS total, 1 AS n, 0 AS batch FROM b WHERE rn = 1 UNION ALL SELECT b.lang, b.bucket, b.rn, b.len, CASE WHEN w.n >= 15 OR w.total + b.len > 6000 THEN b.len ELSE w.total + b.len END, CASE WHEN w.n >= 15 OR w.total + b.len > 6000 THEN 1 ELSE w.n + 1 END, w.batch + CASE WHEN w.n >= 15 OR w.total + b.len > 6000 THEN 1 ELSE 0 END FROM w JOIN b ON b.lang IS NOT DISTINCT FROM w.lang AND b.bucket = w.bucket AND b.rn = w.rn + 1) SELECT lang, bucket, batch, count(*) AS n, CAST(sum(len) AS BIGINT) AS chars FROM w GROUP BY 1, 2, 3"),
    "retry_candidates": (lambda s, d: strings.retry_candidates(_translated(s, d)), f"WITH {_TRANSLATED} SELECT locale, src, upper(src[1]) || lower(src[2:]) AS retry FROM tr2 WHERE {_ECHO} AND {_HEAD}"),
    "retried": (lambda s, d: strings.retried(_translated(s, d), _tm(s, d).select(F.col("target_locale").alias("locale"), text.sentence_case(F.col("src")).alias("src"), "tgt")), f"WITH {_TRANSLATED}, e AS (SELECT *, {_ECHO} AS echo, {_HEAD} AS head, upper(src[1]) || lower(src[2:]) AS form FROM tr2), g AS (SELECT target_locale AS locale, upper(src[1]) || lower(src[2:]) AS src, max(tgt) AS tgt FROM tm GROUP BY 1, 2), h AS (SELECT locale, src AS form, tgt AS second FROM g WHERE NOT {_ECHO}) SELECT e.locale, src, CASE WHEN NOT echo THEN tgt WHEN head AND second IS NOT NULL THEN second ELSE src END AS tgt, echo AND NOT (head AND second IS NOT NULL) AS failed FROM e LEFT JOIN h ON h.locale = e.locale AND h.form = e.form"),
    "is_echo": (lambda s, d: _translated(s, d).where(text.is_echo(F.col("tgt"), F.col("src"), F.col("locale"))).groupBy("locale").agg(F.count("*").alias("n")), f"WITH {_TRANSLATED} SELECT locale, count(*) AS n FROM tr2 WHERE {_ECHO} GROUP BY 1"),
    "is_title_case": (lambda s, d: _translated(s, d).groupBy(text.is_title_case(F.col("src")).alias("title_case")).agg(F.count("*").alias("n")), f"WITH {_TRANSLATED} SELECT {_HEAD} AS title_case, count(*) AS n FROM tr2 GROUP BY 1"),
    "sentence_case": (lambda s, d: _catalog(s, d).select("id", text.sentence_case(F.col("title")).alias("title")), f"WITH {_CAT} SELECT id, upper(trim(title)[1]) || lower(trim(title)[2:]) AS title FROM cat"),
    "translate_map": (lambda s, d: strings.tm_lookup(_catalog(s, d).where("_locale = 'en'").select("id", F.explode(F.create_map(F.lit("title"), F.col("title"), F.lit("brand"), F.col("brand"))).alias("k", "src")).withColumn("locale", F.lit("fr")), _tm(s, d), "src", "locale", "value").select("id", "k", "value"), f"WITH {_CAT}, {_TM} SELECT c.id, k, coalesce(nullif(tgt, ''), c.src) AS value FROM (SELECT id, unnest(['title', 'brand']) AS k, unnest([title, brand]) AS src FROM cat WHERE _locale = 'en') c LEFT JOIN tm ON target_locale = 'fr' AND tm.src = c.src"),
    "decode_entities": (_per_page("title", lambda: text.decode_entities(F.col("title"))), f"""WITH {_TITLE} SELECT page_id, replace(replace(replace(replace(replace(replace(replace(title, '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' ') AS title FROM page"""),
    "slugify_latin": (_per_page("slug", lambda: text.slugify(F.col("title"), "fr", most=40)), f"WITH {_TITLE} SELECT page_id, {_slug_sql('title')} AS slug FROM page"),
    "slugify_unicode": (_per_page("slug", lambda: text.slugify(F.col("title"), "ru", latin_only=False, most=500)), rf"WITH {_TITLE} SELECT page_id, regexp_replace(regexp_replace(lower(nfc_normalize(title)), '[^\p{{L}}\p{{N}}]+', '-', 'g'), '^-+|-+\z', '', 'g') AS slug FROM page"),
    "localized_slug": (lambda s, d: _catalog(s, d).select("id", text.localized_slug(F.lit(""), F.col("kind"), [F.col("title"), F.col("brand")], "es").alias("slug")), rf"WITH {_CAT} SELECT id, regexp_replace(regexp_replace(lower(strip_accents(coalesce(nullif(title, ''), brand))), '[^a-z0-9]+', '-', 'g'), '^-+|-+\z', '', 'g') AS slug FROM cat"),
    "localize_id": (lambda s, d: _catalog(s, d).select("id", keys.base_id(F.col("id")).alias("base"), keys.localize_id(F.col("id"), F.lit("pt-BR")).alias("new_id")), f"WITH {_CAT} SELECT id, {_BASE.format('id')} AS base, concat({_BASE.format('id')}, '_pt-BR') AS new_id FROM cat"),
    "id_collisions": (lambda s, d: _catalog(s, d).groupBy(keys.base_id(F.col("id")).alias("base_key")).agg(F.countDistinct("id").alias("n_ids")).where("n_ids > 1"), f"WITH {_CAT} SELECT {_BASE.format('id')} AS base_key, count(DISTINCT id) AS n_ids FROM cat GROUP BY 1 HAVING count(DISTINCT id) > 1"),
    "last_row_wins": (lambda s, d: _catalog(s, d).groupBy(keys.base_id(F.col("id")).alias("base_key")).agg(F.max_by("title", "id").alias("title")), f"WITH {_CAT} SELECT {_BASE.format('id')} AS base_key, arg_max(title, id) AS title FROM cat GROUP BY 1"),
    "localize_url": (_per_page("url", lambda: urls.localize_url(F.col("url"), F.lit("es"), F.col("site"))), f"WITH {_TITLE} SELECT page_id, CASE WHEN lower({_FRAG}) IN ('#organization', '#website', '#logo') OR regexp_matches({_PATH}, '(?i)\\.(png|jpe?g|webp|svg|gif|avif|ico|pdf|mp4|mov|webm)$') OR starts_with({_PATH}, '/images/') THEN url WHEN {_BARE} IN ('', '/') THEN concat(site, '/es', {_FRAG}) ELSE concat(site, '/es', {_BARE}, {_FRAG}) END AS url FROM page"),
    "localize_path": (_per_page("path", lambda: urls.localize_path(F.concat(F.lit("/solutions/"), F.col("page_id").cast("string"), F.lit("/")), F.lit("de"))), "SELECT page_id, concat('/de/loesungen/', page_id) AS path FROM pages"),
    "dict_join": (lambda s, d: urls.localized_paths(X.fixture(s, d, X.PATHS), "path", "locale", s.sql(X.PAGES), X.fixture(s, d, X.ITEMS)), f"""WITH pg AS ({X.PAGES}), it AS ({X.ITEMS}), pa AS ({X.PATHS}), x AS (SELECT *, string_split(trim(path, '/'), '/') AS w FROM pa), y AS (SELECT *, w[1] AS a, w[2] AS b FROM x),
rev AS (SELECT slug, min(key) AS key FROM pg GROUP BY 1), k AS (SELECT y.*, coalesce(rev.key, a) AS key FROM y LEFT JOIN rev ON rev.slug = a),
f AS (SELECT k.*, coalesce(pg.slug, a) AS first FROM k LEFT JOIN pg ON pg.key = k.key AND pg.locale = k.locale),
g AS (SELECT f.*, coalesce(r.key, b) AS item FROM f LEFT JOIN (SELECT DISTINCT section, slug, key FROM it) r ON r.section = f.key AND r.slug = b),
h AS (SELECT g.*, coalesce(it.slug, b) AS second FROM g LEFT JOIN it ON it.section = g.key AND it.key = item AND it.locale = g.locale)
SELECT id, locale, path, concat(CASE locale WHEN 'en' THEN '' ELSE concat('/', locale) END, '/', CASE WHEN len(w) = 1 THEN first WHEN len(w) = 2 AND key IN ('blog', 'solutions') THEN concat(CASE locale WHEN 'en' THEN key ELSE first END, '/', second) ELSE array_to_string(w, '/') END) AS localized FROM h"""),
    "internal_link": (_per_page("link", lambda: urls.internal_link(F.concat(F.lit("www.example.com/blog/"), F.col("page_id").cast("string")), "example.com", F.lit("fr"))), "SELECT page_id, concat('/fr/blog/', page_id) AS link FROM pages"),
    "contact_link": (lambda s, d: read(s, d, "customer").select("c_custkey", urls.contact_link(F.concat(F.lit("Tel: +"), F.translate(F.lit("86-177-868-5586"), "-", ""), F.col("c_custkey").cast("string"))).alias("link")), "SELECT c_custkey, concat('tel:+861778685586', c_custkey) AS link FROM customer"),
    "merge_scalar": (lambda s, d: B.match_target_rows(_catalog(s, d), LOCALES, FIELDS).select("key", "locale", D.merge_scalar(F.col("t_title"), F.col("s_title")).alias("title")), f"WITH {_MATCH} SELECT key, locale, CASE WHEN t_title IS NULL OR trim(t_title) = '' THEN s_title ELSE t_title END AS title FROM m"),
    "merge_blocks": (_merged, _MERGED_BLOCKS),
    "extract_document_strings": (lambda s, d: D.document_strings(_documents(s, d)), f"SELECT DISTINCT conv_id AS doc_id, text AS src FROM conversations WHERE {_reason('text')} IS NULL"),
    "apply_document_translations": (lambda s, d: _rebuilt(D.translate_documents(_documents(s, d), _memory(s, d), ["es", "fr"]), "doc_id", "locale"), _TRANSLATED_DOCS),
    "continuous_sync": (_synced, _SYNC_SQL),
    "continuous_sync_stream": (_streamed, _SYNC_SQL),
    "localize_jsonld": (_localized_jsonld(True), _jsonld_sql(True)),
    "jsonld_job": (_localized_jsonld(False), _jsonld_sql(False)),
    "collection_filter": (lambda s, d: read(s, d, "customer").select("c_custkey", F.lower("c_mktsegment").alias("slug")).where(filters.collection_enabled(F.col("slug"), {"building": False, "machinery": True})), "SELECT c_custkey, lower(c_mktsegment) AS slug FROM customer WHERE lower(c_mktsegment) <> 'building'"),
    "excluded_fields_by_collection": (lambda s, d: filters.without_excluded(_fields(s, d), s.createDataFrame([("Brand#11", "title"), ("Brand#23", "body"), (None, "notes")], "collection string, field string")), "SELECT p_brand AS collection, field, p_partkey AS id FROM (SELECT *, unnest(['title', 'notes', 'body']) AS field FROM part) WHERE field <> 'notes' AND NOT (p_brand = 'Brand#11' AND field = 'title') AND NOT (p_brand = 'Brand#23' AND field = 'body')"),
    "strip_system_fields": (lambda s, d: D.strip_system_fields(read(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("createdAt"), F.col("o_orderdate").alias("updatedAt"), F.col("o_orderstatus").alias("_status"), "o_orderpriority", "o_custkey")), "SELECT o_orderpriority, o_custkey FROM orders"),
    "sync_override_flag": (lambda s, d: read(s, d, "orders").select("o_orderkey", D.sync_override_flag(F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 2), F.col("o_orderkey") % 5 == 0).alias("flag")), "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 2 = 1 ELSE o_orderkey % 5 = 0 END AS flag FROM orders"),
    "discover_localized_tables": (lambda s, d: _catalog(s, d).select(F.lit("catalog").alias("table"), "id").join(localized_tables(s.createDataFrame(columns_of({"catalog": _catalog(s, d), "_catalog_v_locales": _catalog(s, d), "parts": read(s, d, "part")}), "table string, column string, type string"), only=["catalog"]), "table", "left_semi"), f"WITH {_CAT} SELECT 'catalog' AS \"table\", id FROM cat"),
    "pending_replacement": (lambda s, d: C.latest(_changes(s, d).where(C.admitted())).join(_changes(s, d).where(C.admitted()).groupBy(C.document_key().alias("key")).agg((F.count("*") - 1).alias("replaced")), "key").select("key", "job_id", "replaced"), f"WITH {_CH}, {_ADM}, k AS (SELECT *, concat(entity_type, ':', slug, ':', coalesce(CAST(doc_id AS VARCHAR), 'global')) AS key FROM adm) SELECT key, arg_max(job_id, (ts, job_id)) AS job_id, count(*) - 1 AS replaced FROM k GROUP BY 1"),
    "extract_jsonld_strings": (_jsonld_strings, f"WITH l AS (SELECT p_partkey AS page_id, unnest([p_name, concat('About ', p_type)]) AS src FROM part) SELECT DISTINCT page_id, src FROM l WHERE {_reason('src')} IS NULL"),
    "latest_per_document": (lambda s, d: C.latest(_changes(s, d)), f"WITH {_CH} SELECT concat(entity_type, ':', slug, ':', coalesce(CAST(doc_id AS VARCHAR), 'global')) AS key, arg_max(job_id, (ts, job_id)) AS job_id, max(ts) AS ts FROM ch GROUP BY 1"),
    "debounce_changes": (lambda s, d: C.debounce(_changes(s, d).where(C.admitted()), "30 minutes"), f"WITH {_CH}, {_ADM}, g AS (SELECT *, concat(entity_type, ':', slug, ':', coalesce(CAST(doc_id AS VARCHAR), 'global')) AS key FROM adm), o AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY key ORDER BY ts, job_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM g), i AS (SELECT *, sum(opens) OVER (PARTITION BY key ORDER BY ts, job_id) AS island FROM o) SELECT key, arg_max(job_id, (ts, job_id)) AS job_id, max(ts) AS ts, count(*) AS n FROM i GROUP BY key, island"),
    "job_stats": (lambda s, d: C.job_stats(_changes(s, d).select(F.coalesce("status", F.lit("queued")).alias("state"), "ts", "job_id", F.when(F.col("operation") == "delete", F.concat(F.lit("gone: "), F.col("doc_id").cast("string"))).alias("error"))), f"WITH {_CH} SELECT coalesce(status, 'queued') AS state, count(*) AS n, max(ts) AS last_ts, arg_max(job_id, (ts, job_id)) AS last_job, arg_max(concat('gone: ', doc_id), (ts, job_id)) FILTER (operation = 'delete') AS last_error FROM ch GROUP BY 1"),
    "slug_backfill": (lambda s, d: seo.slug_backfill(X.fixture(s, d, X.SLUG_PARENTS), X.fixture(s, d, X.SLUG_ROWS)), f"WITH p AS ({X.SLUG_PARENTS}), r AS ({X.SLUG_ROWS}) SELECT _parent_id, _locale, coalesce(r.slug, p.slug) AS slug FROM r LEFT JOIN p ON id = _parent_id UNION ALL SELECT id, 'en', slug FROM p WHERE id NOT IN (SELECT _parent_id FROM r WHERE _locale = 'en')"),
    "slug_uniqueness": (lambda s, d: seo.slug_conflicts(X.fixture(s, d, X.SLUG_ROWS)), f"WITH r AS ({X.SLUG_ROWS}) SELECT _locale, slug, count(*) AS n FROM r WHERE slug IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1"),
    "slug_nulls": (lambda s, d: seo.slug_nulls(X.fixture(s, d, X.SLUG_ROWS)), f"WITH r AS ({X.SLUG_ROWS}) SELECT _locale, count(*) AS n FROM r WHERE slug IS NULL GROUP BY 1"),
    "slug_reverse": (lambda s, d: seo.slug_reverse(X.fixture(s, d, X.SLUG_PARENTS), X.fixture(s, d, X.SLUG_ROWS)), f"WITH p AS ({X.SLUG_PARENTS}), r AS ({X.SLUG_ROWS}) SELECT id, coalesce((SELECT max(slug) FROM r WHERE _parent_id = id AND _locale = 'en'), slug) AS slug FROM p"),
    "head_links": (lambda s, d: seo.head_links(_routes(s, d).select("doc_id", "lang", F.concat("path", F.lit("/")).alias("url"))).select("doc_id", "canonical", F.explode("alternates").alias("lang", "href")), f"WITH p AS ({X.SLUG_PARENTS}), x AS (SELECT id AS doc_id, unnest(['es', 'fr', 'de']) AS lang, unnest(['soluciones', 'solutions', 'loesungen']) AS sec, slug FROM p), y AS (SELECT doc_id, lang, concat('/', lang, '/', sec, '/', slug) AS url FROM x) SELECT a.doc_id, a.url AS canonical, b.lang, b.url AS href FROM y a JOIN y b USING (doc_id)"),
    "typed_document_strings": (lambda s, d: Y.typed_strings(_typed(_documents(s, d))), f"SELECT DISTINCT conv_id AS doc_id, text AS src FROM conversations WHERE {_reason('text')} IS NULL"),
    "typed_document_translations": (lambda s, d: Y.translate_typed(_typed(_documents(s, d)), _memory(s, d), ["es", "fr"]).select("doc_id", "locale", F.posexplode("doc.sections").alias("pos", "x")).select("doc_id", "locale", "pos", "x.*"), _TRANSLATED_DOCS),
    "typed_merge_blocks": (lambda s, d: _typed_merge(s, d), _MERGED_BLOCKS),
    "localized_routes": (_routes, f"WITH p AS ({X.SLUG_PARENTS}), x AS (SELECT id AS doc_id, unnest(['es', 'fr', 'de']) AS lang, unnest(['soluciones', 'solutions', 'loesungen']) AS section_slug, slug FROM p) SELECT *, concat('/', lang, '/', section_slug, '/', slug) AS path FROM x"),
    "route_collisions": (lambda s, d: seo.route_collisions(seo.localized_routes(X.fixture(s, d, X.SLUG_ROWS).where("slug IS NOT NULL").select(F.col("_parent_id").alias("doc_id"), "slug"), "blog", ["de"])), f"WITH r AS ({X.SLUG_ROWS}) SELECT concat('/de/blog/', slug) AS path, count(*) AS n, min(_parent_id) AS first_doc FROM r WHERE slug IS NOT NULL GROUP BY 1 HAVING count(*) > 1"),
    "redirect_rules": (lambda s, d: seo.redirect_rules(_routes(s, d), "solutions"), f"WITH p AS ({X.SLUG_PARENTS}), x AS (SELECT unnest(['es', 'fr', 'de']) AS lang, unnest(['soluciones', 'solutions', 'loesungen']) AS sec, slug FROM p), y AS (SELECT unnest([concat('/', lang, '/solutions/', slug), concat('/', sec, '/', slug), concat('/', lang, '/', slug)]) AS from_path, concat('/', lang, '/', sec, '/', slug) AS to_path FROM x) SELECT from_path, min(to_path) AS to_path FROM y WHERE from_path <> to_path GROUP BY 1"),
    "redirect_rules_old_slugs": (lambda s, d: seo.redirect_rules(_routes(s, d), "solutions", X.fixture(s, d, X.SLUG_PARENTS).where("id % 3 = 0").select(F.col("id").alias("doc_id"), F.concat(F.lit("old-"), F.col("id").cast("string")).alias("old_slug"))), f"WITH p AS ({X.SLUG_PARENTS}), x AS (SELECT id, unnest(['es', 'fr', 'de']) AS lang, unnest(['soluciones', 'solutions', 'loesungen']) AS sec, slug FROM p), y AS (SELECT unnest([concat('/', lang, '/solutions/', slug), concat('/', sec, '/', slug), concat('/', lang, '/', slug), CASE WHEN id % 3 = 0 THEN concat('/', lang, '/', sec, '/old-', id) END]) AS from_path, concat('/', lang, '/', sec, '/', slug) AS to_path FROM x) SELECT from_path, min(to_path) AS to_path FROM y WHERE from_path <> to_path GROUP BY 1"),
    "flatten_redirects": (lambda s, d: seo.flatten_redirects(X.fixture(s, d, X.REDIRECTS)), f"WITH RECURSIVE e AS ({X.REDIRECTS}), w AS (SELECT from_path, to_path AS node, [from_path] AS seen FROM e UNION ALL SELECT w.from_path, e.to_path, list_append(seen, e.to_path) FROM w JOIN e ON e.from_path = w.node WHERE NOT list_contains(seen, e.to_path)) SELECT from_path, arg_max(node, len(seen)) AS to_path FROM w GROUP BY 1"),
    "hreflang_groups": (lambda s, d: seo.alternates(_routes(s, d).select("doc_id", "lang", F.col("path").alias("url"))).select("doc_id", F.explode("alternates").alias("lang", "url")), f"WITH p AS ({X.SLUG_PARENTS}), x AS (SELECT id AS doc_id, unnest(['es', 'fr', 'de']) AS lang, unnest(['soluciones', 'solutions', 'loesungen']) AS sec, slug FROM p) SELECT doc_id, lang, concat('/', lang, '/', sec, '/', slug) AS url FROM x"),
    "sitemap": (lambda s, d: seo.sitemap(_routes(s, d).select("doc_id", "lang", F.concat("path", F.lit("/")).alias("url"))), f"WITH p AS ({X.SLUG_PARENTS}), x AS (SELECT id AS doc_id, unnest(['es', 'fr', 'de']) AS lang, unnest(['soluciones', 'solutions', 'loesungen']) AS sec, slug FROM p), y AS (SELECT doc_id, lang, concat('/', lang, '/', sec, '/', slug) AS url FROM x) SELECT a.url AS loc, b.lang, b.url AS href FROM y a JOIN y b USING (doc_id)"),
}


def queries() -> dict:
    return {k: v[0] for k, v in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in ENTRIES.items() if v[1]}
