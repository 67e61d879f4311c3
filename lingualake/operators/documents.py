"""Nested documents: strings of JSON trees, merges that keep human edits, JSON-LD."""

from __future__ import annotations

import hashlib
import json
import re
import sys
from collections import defaultdict, deque
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.filters import is_blank, is_translatable_field, should_skip_value
from ..functions.urls import localize_url
from ..sources.tables import dealt
from .strings import tm_lookup

_SUFFIX = re.compile(r"(_[a-z]{2}(-[A-Z]{2})?)+\Z")
# Fixed values
JSONLD_TEXT = "description headline alternativeHeadline caption text keywords articleBody disambiguatingDescription reviewBody serviceType slogan areaServed award abstract".split()
JSONLD_ENTITIES = "Organization Corporation Brand LocalBusiness Person EducationalOccupationalCredential".split()
#: How deep a document may nest.
DEPTH = 20_000
SYSTEM_ROOT = "id createdAt updatedAt _status".split()
JSONLD_LANGUAGE = "WebPage WebSite Article FAQPage AboutPage ContactPage".split()


def guarded(f: Callable) -> Callable:
    """f as a function that gives its result and no error, or no result and what was wrong with its row.

    Malformed JSON, another shape than asked for, and nesting beyond DEPTH are a row's errors: they never end a job.
    """

    def run(*values):
        sys.setrecursionlimit(max(sys.getrecursionlimit(), DEPTH))
        try:
            return f(*values), None
        except (ValueError, TypeError, KeyError, AttributeError, RecursionError) as e:
            return None, f"{type(e).__name__}: {e}"[:200]

    return run


def _per_row(f: Callable, *columns: pd.Series) -> pd.Series:
    """f of each row; null where a row is malformed."""
    one = guarded(f)
    return pd.Series([one(*row)[0] for row in zip(*columns)], dtype=object)


def dumps(node) -> str:
    return json.dumps(node, ensure_ascii=False)


def merge_scalar(existing: Column, new: Column) -> Column:
    return F.when(is_blank(existing), new).otherwise(existing)


def _empty(v) -> bool:
    return v is None or isinstance(v, str) and not v.strip() or isinstance(v, list) and not v


def _base(item) -> str | None:
    return _SUFFIX.sub("", str(item["id"])) if isinstance(item, dict) and item.get("id") else None


def merge_values(new, old):
    """Two JSON values as one: what a person has filled in stays, what is empty takes the new side."""
    if new is None or old is None:
        return new
    if isinstance(new, list) or isinstance(old, list):
        return merge_blocks(new, old) if isinstance(new, list) and isinstance(old, list) else new
    if not (isinstance(new, dict) and isinstance(old, dict)):
        return new if _empty(old) else old
    out = {}
    for k in [*new, *(k for k in old if k not in new)]:
        if not is_translatable_field(k):
            out[k] = new[k] if k in new else old[k]
        elif k not in old or _empty(old[k]):
            if k in new:
                out[k] = new[k]
        elif isinstance(new.get(k), dict | list) and isinstance(old[k], dict | list):
            out[k] = merge_values(new[k], old[k])
        else:
            out[k] = old[k]
    return out


def merge_blocks(new: list, old: list) -> list:
    """Items in the new order, each merged with the unused old item of its base id, else of its type and place."""
    if not old or not new:
        return new or old
    if not isinstance(new[0], dict | list):
        return old
    used: set = set()
    by_base, by_kind = defaultdict(deque), defaultdict(deque)  # unused old items by base id and by type, in order
    kinds = [o.get("blockType") if isinstance(o, dict) else None for o in old]
    for k, o in enumerate(old):
        by_base[_base(o)].append(k)
        by_kind[kinds[k]].append(k)

    def first(queue: deque) -> int | None:
        while queue and queue[0] in used:
            queue.popleft()
        return queue[0] if queue else None

    def partner(i: int, item: dict | list) -> int | None:
        if (base := _base(item)) and (k := first(by_base[base])) is not None:
            return k
        here, kind = i < len(old) and i not in used, item.get("blockType") if isinstance(item, dict) else None
        if here and (kinds[i] == kind if kind else not kinds[i]):
            return i
        return first(by_kind[kind]) if kind else None

    out = []
    for i, item in enumerate(new):
        k = partner(i, item) if isinstance(item, dict | list) else None
        out.append(item if k is None else merge_values(item, old[k]))
        used.add(k)
    return out


@F.pandas_udf(T.StringType())
def merge_documents(new: pd.Series, old: pd.Series) -> pd.Series:
    """JSON documents: the merged one (the new one where there is no old; null where one is malformed)."""
    return _per_row(lambda n, o: n if o is None or n is None else dumps(merge_values(json.loads(n), json.loads(o))), new, old)


def is_richtext(v) -> bool:
    root = v.get("root") if isinstance(v, dict) else None
    return isinstance(root, dict) and (root.get("type") == "root" or isinstance(root.get("children"), list))


def _leaves(node, out: list) -> None:
    if isinstance(node, dict):
        if node.get("type") == "text" and isinstance(node.get("text"), str):
            out.append(node["text"])
        for v in node.values():
            _leaves(v, out)
    elif isinstance(node, list):
        for v in node:
            _leaves(v, out)


def _leaf_slots(node):
    """Nodes of a rich text that hold a text, depth first."""
    if isinstance(node, dict) and node.get("type") == "text" and isinstance(node.get("text"), str):
        yield node, "text"
    for v in node.values() if isinstance(node, dict) else node if isinstance(node, list) else ():
        yield from _leaf_slots(v)


def richtext_leaves(node) -> list | None:
    """The texts of a rich text's leaves that are not blank, in order: a leaf is known by its number here. None: no rich text."""
    return [at[k] for at, k in _leaf_slots(node) if not _empty(at[k])] if is_richtext(node) else None


@F.pandas_udf(T.ArrayType(T.StringType()))
def richtext_strings(s: pd.Series) -> pd.Series:
    """Text leaves of rich-text JSON in depth-first order; null for what is not rich text."""
    return _per_row(lambda x: None if x is None else richtext_leaves(json.loads(x)), s)


@F.pandas_udf(T.StructType().add("present", "boolean").add("leaves", T.ArrayType(T.StringType())).add("form", "string"))
def richtext_parts(s: pd.Series) -> pd.DataFrame:
    """Of JSON values: whether there is one (not null, false, 0 or empty), its leaves (null: no rich text), and the hash of a form
    that equal values share whatever the order of their keys. Malformed JSON is present, without leaves, in the form it has."""

    def of(x):
        v = None if x is None else json.loads(x)
        return v not in (None, False, 0, ""), richtext_leaves(v), None if v is None else json.dumps(v, sort_keys=True)

    def whole(x):
        present, leaves, form = guarded(of)(x)[0] or (x is not None, None, x)
        return present, leaves, form and hashlib.sha256(form.encode("utf-8", "surrogatepass")).hexdigest()

    done = {x: whole(x) for x in set(s)}  # equal values of a batch are parsed once
    return pd.DataFrame([done[x] for x in s], columns=["present", "leaves", "form"])


@F.pandas_udf(T.StringType())
def placed_leaves(doc: pd.Series, texts: pd.Series) -> pd.Series:
    """Rich-text JSON with its leaves replaced by number (null: as it is); structure untouched. Other JSON stays as it is."""

    def put(d, t):
        if d is None or t is None:
            return d
        node = json.loads(d)
        for (at, k), new in zip([x for x in _leaf_slots(node) if not _empty(x[0][x[1]])], t):
            at[k] = new or at[k]
        return dumps(node)

    return pd.Series([guarded(put)(d, t)[0] or d for d, t in zip(doc, texts)], dtype=object)


@F.pandas_udf(T.StringType())
def apply_richtext(doc: pd.Series, by: pd.Series) -> pd.Series:
    """Rich-text JSON with its leaves replaced by a JSON object's values, by text; structure untouched."""

    def put(d, b):
        if d is None:
            return None
        node, texts = json.loads(d), json.loads(b or "{}")
        for at, k in list(_leaf_slots(node)):
            at[k] = texts.get(at[k]) or at[k]
        return dumps(node)

    return _per_row(put, doc, by)


def _jsonld_slots(node):
    """(holder, key, kind) of every place of a JSON-LD value that is to change, in document order: a text, a link, a language, a page
    (a node that has a language of its own) or a graph (a node that keeps its context and graph alone)."""
    if isinstance(node, list):
        for x in node:
            yield from _jsonld_slots(x)
    if not isinstance(node, dict):
        return
    if isinstance(node.get("@graph"), list):
        yield node, "@graph", "graph"
        yield from _jsonld_slots(node["@graph"])
        return
    entity = not _types(node).isdisjoint(JSONLD_ENTITIES)
    for k, v in list(node.items()):
        texts = k in JSONLD_TEXT or k in ("knowsAbout", "about") and isinstance(v, list)
        if k == "inLanguage":
            yield node, k, "language"
        elif k in ("url", "item", "@id") and isinstance(v, str):
            yield node, k, "link"
        elif texts and isinstance(v, list):
            for i, x in enumerate(v):
                if isinstance(x, str):
                    yield v, i, "text"
                elif k not in JSONLD_TEXT and isinstance(x, dict | list):
                    yield from _jsonld_slots(x)
        elif (texts or k == "name" and not entity) and isinstance(v, str):
            yield node, k, "text"
        elif not texts and k not in ("name", "knowsAbout", "about"):
            yield from _jsonld_slots(v)
    if not _types(node).isdisjoint(JSONLD_LANGUAGE):
        yield node, "inLanguage", "page"


def _types(node: dict) -> set:
    kind = node.get("@type")
    return set(map(str, kind)) if isinstance(kind, list) else {str(kind)}


def jsonld_texts(node, kind: str = "text") -> list:
    """What stands in a JSON-LD value's slots of a kind, each once, in document order."""
    return list(dict.fromkeys(at[k] for at, k, found in _jsonld_slots(node) if found == kind))


@F.pandas_udf(T.ArrayType(T.StringType()))
def jsonld_strings(s: pd.Series) -> pd.Series:
    """Candidate strings of JSON-LD; the value rules are a filter on the exploded column, inside the JVM."""
    return _per_row(lambda x: None if x is None else jsonld_texts(json.loads(x)), s)


@F.pandas_udf(T.ArrayType(T.StructType().add("kind", "string").add("src", "string")))
def jsonld_slots(s: pd.Series) -> pd.Series:
    """What stands in the texts and links of JSON-LD, each once: one parse gives both."""
    return _per_row(lambda x: None if x is None else [dict(kind=k, src=t) for n in [json.loads(x)] for k in ("text", "link") for t in jsonld_texts(n, k)], s)


def localized_jsonld(node, texts: dict, links: dict, locale: str):
    """A JSON-LD value in another locale: texts and links replaced, languages set, pages given one.

    A node with a graph keeps its context (https://schema.org if it has none) and graph alone, at any depth.
    """
    for at, k, kind in list(_jsonld_slots(node)):
        if kind == "graph":
            context, graph = at.get("@context") or "https://schema.org", at["@graph"]
            at.clear()
            at |= {"@context": context, "@graph": graph}
        elif kind in ("language", "page"):
            at[k] = locale if kind == "language" else at.get(k) or locale
        else:
            at[k] = (links if kind == "link" else texts).get(at[k]) or at[k]
    return node


def text_maps(slots: DataFrame, keys: list[str], tm: DataFrame, site: str | None = None, path_hook: Callable | None = None, share: int | None = None, rows: int = 0, **rules) -> DataFrame:
    """(keys, texts, links): JSON objects of what the strings of slots (keys with locale, kind, src) become; slots hold each once.

    A text is looked up in the memory unless a value rule skips it (share: see tm_lookup; a menu's label stands in every document); a
    link follows the URL rule. What stays as it is is left out. rows: about how many the keys are dealt out for.
    """
    kept = slots.where((F.col("kind") == "link") | ~should_skip_value(F.col("src"), **rules))
    done = tm_lookup(kept, tm, "src", "locale", share=share)
    if site is not None:
        done = done.withColumn("translated", F.when(F.col("kind") == "link", localize_url(F.col("src"), F.col("locale"), F.lit(site), path_hook)).otherwise(F.col("translated")))

    def objects(kind: str) -> Column:
        pairs = F.collect_list(F.when(F.col("kind") == kind, F.struct("src", "translated")))
        return F.to_json(F.map_from_entries(pairs))

    return dealt(done.where("src <> translated"), rows, *keys).groupBy(*keys).agg(objects("text").alias("texts"), objects("link").alias("links"))


def localize_jsonld(pages: DataFrame, tm: DataFrame, locale: str, site: str, overwrite: bool = False, path_hook: Callable | None = None, **rules) -> DataFrame:
    """(page_id, schema, error) of pages (page_id, schema, existing): the schema in the locale, or the existing one where there is one.

    Strings and links are taken out, looked up (memory, URL rule) as columns, and put back: the helper only walks the tree. A page with
    malformed JSON has no schema and says why. Pages with one schema share its lookups, so page_id may repeat. rules are
    the value rules' custom exclusions, path_hook as for localize_url.
    """
    todo = pages if overwrite else pages.where(is_blank(F.col("existing")))
    n = todo.count() * 4
    slots = dealt(todo.select(F.sha2("schema", 256).alias("h"), F.explode(jsonld_slots("schema")).alias("x")).select("h", "x.*"), n, "h").distinct()
    maps = text_maps(slots.withColumn("locale", F.lit(locale)), ["h"], tm, site, path_hook, rows=n, **rules)

    @F.pandas_udf("schema string, error string")
    def put(schema: pd.Series, text: pd.Series, link: pd.Series) -> pd.DataFrame:
        one = guarded(lambda s, t, u: None if s is None else dumps(localized_jsonld(json.loads(s), json.loads(t or "{}"), json.loads(u or "{}"), locale)))
        return pd.DataFrame([one(*row) for row in zip(schema, text, link)], columns=["schema", "error"], dtype=object)

    done = dealt(todo.select("page_id", "schema", F.sha2("schema", 256).alias("h")), n, "h").join(maps.hint("merge"), "h", "left").select("page_id", put("schema", "texts", "links").alias("x")).select("page_id", "x.*")
    return done if overwrite else done.unionByName(pages.where(~is_blank(F.col("existing"))).select("page_id", F.col("existing").alias("schema"), F.lit(None).cast("string").alias("error")))


def _slots(node, excluded=(), bare: bool = False):
    """(holder, key) of every text under a translatable field at any depth; texts that stand in an array only if `bare`."""
    if is_richtext(node):
        yield from _leaf_slots(node)
    elif isinstance(node, list):
        for i, x in enumerate(node):
            if isinstance(x, str):
                if bare:
                    yield node, i
            else:
                yield from _slots(x, excluded, bare)
    elif isinstance(node, dict):
        for k, v in node.items():
            if is_translatable_field(k, excluded):
                if isinstance(v, str):
                    yield node, k
                else:
                    yield from _slots(v, excluded, bare)


def document_texts(node, excluded=()) -> list:
    return list(dict.fromkeys(at[k] for at, k in _slots(node, excluded)))


def translated_document(node, texts: dict, excluded=()):
    for at, k in list(_slots(node, excluded, bare=True)):
        at[k] = texts.get(at[k]) or at[k]
    return node


def translated_richtext(values: DataFrame, tm: DataFrame, share: int | None = None, **rules) -> DataFrame:
    """(locale, h, value): the rich texts of values (locale, src) with their leaves translated; h is src's SHA-256.

    Equal rich texts of a locale are worked once. Their leaves become rows (text, number, leaf), are looked up in one join, and go
    back by number. Leaves that a value rule skips stay, as does JSON that is not rich text.
    """
    each = values.where("src IS NOT NULL").select("locale", "src", F.sha2("src", 256).alias("h")).distinct()
    leaves = each.select("locale", "h", F.posexplode(richtext_strings("src")).alias("n", "leaf")).where(~should_skip_value(F.col("leaf"), **rules))
    found = tm_lookup(leaves, tm, "leaf", "locale", "to", share).groupBy("locale", "h").agg(F.map_from_entries(F.collect_list(F.struct("n", "to"))).alias("m"))
    by_number = F.transform(F.sequence(F.lit(0), F.array_max(F.map_keys("m"))), lambda n: F.try_element_at("m", n))
    return each.join(found.hint("merge"), ["locale", "h"], "left").select("locale", "h", placed_leaves("src", by_number).alias("value"))


def localized_ids(node, locale: str):
    """Every id of a document with the locale's suffix alone; numeric ids are dropped, the database gives new ones."""
    todo = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            if isinstance(x.get("id"), str) and x["id"]:
                x["id"] = f"{_SUFFIX.sub('', x['id'])}_{locale}"
            elif isinstance(x.get("id"), (int, float)) and not isinstance(x["id"], bool):
                del x["id"]
            todo += [v for k, v in x.items() if k not in ("blockType", "blockName")]
        elif isinstance(x, list):
            todo += x
    return node


def document_strings(docs: DataFrame, excluded=(), **rules) -> DataFrame:
    """(doc_id, src): the distinct strings of each JSON document (doc_id, doc) that are to be translated; malformed ones have none."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def texts(s: pd.Series) -> pd.Series:
        return _per_row(lambda x: None if x is None else document_texts(json.loads(x), excluded), s)

    return docs.select("doc_id", F.explode(texts("doc")).alias("src")).where(~should_skip_value(F.col("src"), **rules))


def translate_documents(docs: DataFrame, tm: DataFrame, locales: list[str], excluded=(), share: int | None = None, **rules) -> DataFrame:
    """(doc_id, locale, doc, error): each JSON document in each locale, its strings looked up in the memory, its ids localized.

    A document that is malformed has no doc and says why. Documents are known by what they hold, so a doc_id may repeat, with one text
    or several, and equal documents are looked up once.
    """
    h = F.sha2("doc", 256)
    each = F.explode(F.array(*(F.lit(x) for x in locales)))
    needed = document_strings(docs.select(h.alias("doc_id"), "doc"), excluded).distinct()
    slots = needed.select(F.col("doc_id").alias("h"), F.lit("text").alias("kind"), "src").withColumn("locale", each)
    maps = text_maps(slots, ["h", "locale"], tm, share=share, **rules)

    @F.pandas_udf("doc string, error string")
    def put(doc: pd.Series, text: pd.Series, locale: pd.Series) -> pd.DataFrame:
        one = guarded(lambda d, t, lo: None if d is None else dumps(localized_ids(translated_document(json.loads(d), json.loads(t or "{}"), excluded), lo)))
        return pd.DataFrame([one(*row) for row in zip(doc, text, locale)], columns=["doc", "error"], dtype=object)

    rows = docs.select("doc_id", "doc", h.alias("h")).withColumn("locale", each).join(maps, ["h", "locale"], "left")
    return rows.select("doc_id", "locale", put("doc", "texts", "locale").alias("x")).select("doc_id", "locale", "x.*")


@F.pandas_udf(T.StringType())
def localized(doc: pd.Series, locale: pd.Series) -> pd.Series:
    """JSON documents with their ids in the locale."""
    return _per_row(lambda d, lo: None if d is None else dumps(localized_ids(json.loads(d), lo)), doc, locale)


@F.pandas_udf(T.StringType())
def stripped(doc: pd.Series) -> pd.Series:
    """JSON documents without the fields that the database keeps itself."""
    return _per_row(lambda d: None if d is None else dumps({k: v for k, v in json.loads(d).items() if k not in SYSTEM_ROOT}), doc)


def sync_override_flag(source: Column, target: Column) -> Column:
    """The source's flag where it has one."""
    return F.when(source.isNotNull(), source.cast("boolean")).otherwise(target)


def strip_system_fields(docs: DataFrame) -> DataFrame:
    """Typed documents without the fields that the database keeps itself."""
    return docs.drop(*SYSTEM_ROOT)
