"""What a changed document makes of its translations: strings, merge, slug, JSON-LD, override flag and ids, for each locale."""

from __future__ import annotations

import json
from collections.abc import Callable, Collection
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.filters import should_skip_value
from ..functions.text import localized_slug
from ..sources import tables
from ..sources.tables import dealt, settled
from . import documents as D
from .strings import except_translated, translate

#: Where the flag that switches the default schema off may stand. Fixed values
FLAGS = ("seo.overrideDefaultSchema", "meta.overrideDefaultSchema", "overrideDefaultSchema")


@dataclass(frozen=True)
class SyncOptions:
    """How documents are translated.

    slugs: collections whose slug is translated; title_field: the field it is made of first; slugify(title, locale, source slug)
    and localize_path(path, locale) are hooks over columns. schema switches JSON-LD on: its fields, the site, whether a
    translation's own schema is replaced, whether the override flag follows the source.
    """

    locales: tuple[str, ...]
    source: str = "en"
    excluded: tuple[str, ...] = ()
    exact: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()
    slugs: Collection[str] = ()
    title_field: str | None = None
    latin_only: bool = True
    slugify: Callable[[Column, Column, Column], Column] | None = None
    schema: bool = False
    schema_paths: tuple[str, ...] = ("seo.schema", "meta.schema", "schema")
    site: str = ""
    overwrite: bool = False
    sync_flag: bool = True
    localize_path: Callable[[Column, Column], Column] | None = None

    def fields_left(self) -> tuple[str, ...]:
        """Fields that are not translated as text; a schema has its own rules."""
        return (*self.excluded, *(("schema", "overrideDefaultSchema", *self.schema_paths) if self.schema else ()))


def _at(node, path: str):
    for part in path.split("."):
        node = node.get(part) if isinstance(node, dict) else None
    return node


def _put(node: dict, path: str, value) -> None:
    *outer, last = path.split(".")
    for part in outer:
        if not isinstance(node.get(part), dict):
            node[part] = {}
        node = node[part]
    node[last] = value


def _document(text: str) -> dict:
    node = json.loads(text)
    if not isinstance(node, dict):
        raise ValueError("the document is no object")
    return node


def _schemas(node: dict, options: SyncOptions) -> dict:
    found = {p: _at(node, p) for p in options.schema_paths} if options.schema else {}
    return {p: v for p, v in found.items() if isinstance(v, dict | list) and v}


def document_slots(options: SyncOptions):
    """A column function: the texts and links of a JSON document, each once (null where it is malformed)."""
    left = options.fields_left()

    def of(text):
        node = _document(text)
        parts = list(_schemas(node, options).values())
        texts = [*D.document_texts(node, left), *(t for p in parts for t in D.jsonld_texts(p))]
        links = [t for p in parts for t in D.jsonld_texts(p, "link")]
        return [dict(kind=k, src=t) for k, some in (("text", texts), ("link", links)) for t in dict.fromkeys(some)]

    @F.pandas_udf("array<struct<kind:string,src:string>>")
    def slots(s: pd.Series) -> pd.Series:
        return pd.Series([D.guarded(of)(x)[0] for x in s], dtype=object)

    return slots


def _translated(options: SyncOptions):
    """A column function: a document with its texts replaced, its title, and what its schemas and flags become."""
    left = options.fields_left()
    titles = [*([options.title_field] if options.title_field else []), "title", "name"]

    def of(text, texts, links, locale):
        source, texts, links = _document(text), json.loads(texts or "{}"), json.loads(links or "{}")
        node = D.translated_document(_document(text), texts, left)
        first = [options.title_field] if options.title_field else []
        order = [*((node, t) for t in first), *((source, t) for t in first), *((node, t) for t in titles), *((source, t) for t in titles)]
        title = next((v for n, t in order if isinstance(v := n.get(t), str) and v), None)
        schemas = {p: D.localized_jsonld(v, texts, links, locale) for p, v in _schemas(source, options).items()}
        flags = {p: bool(_at(source, p)) for p in FLAGS if _has(source, p)} if options.schema and options.sync_flag else {}
        return D.dumps(node), title, D.dumps({"schemas": schemas, "flags": flags})

    @F.pandas_udf("doc string, title string, more string, error string")
    def put(*columns: pd.Series) -> pd.DataFrame:
        rows = [D.guarded(of)(*row) for row in zip(*columns)]
        return pd.DataFrame([(*(r or (None,) * 3), e) for r, e in rows], columns=["doc", "title", "more", "error"], dtype=object)

    return put


def _has(node, path: str) -> bool:
    *outer, last = path.split(".")
    for part in outer:
        node = node.get(part) if isinstance(node, dict) else None
    return isinstance(node, dict) and last in node


def _finished(options: SyncOptions):
    """A column function: the translated document merged into the existing one, with slug, schemas, flags and ids of the locale."""

    def of(doc, old, more, slug, locale):
        new, old, more = json.loads(doc), _document(old) if old else {}, json.loads(more)
        out = D.merge_values(new, old) if old else new
        if slug is not None:
            out["slug"] = slug
        elif old.get("slug"):
            out["slug"] = old["slug"]
        for path, value in more["schemas"].items():
            if options.overwrite or not _at(old, path):
                _put(out, path, value)
            else:
                _put(out, path, _at(old, path))
        for path, value in more["flags"].items():
            _put(out, path, value)
        return D.dumps(D.localized_ids({k: v for k, v in out.items() if k not in D.SYSTEM_ROOT}, locale))

    @F.pandas_udf("doc string, error string")
    def put(doc: pd.Series, *columns: pd.Series) -> pd.DataFrame:
        rows = [D.guarded(of)(*row) if row[0] is not None else (None, None) for row in zip(doc, *columns)]
        return pd.DataFrame(rows, columns=["doc", "error"], dtype=object)

    return put


def with_translator(slots: DataFrame, tm: DataFrame, options: SyncOptions, call: Callable[[list[str], str], list[str]]) -> DataFrame:
    """The memory and, for strings of slots (locale, kind, src) that it lacks, what the translator gives."""
    needed = slots.where("kind = 'text'").where(~should_skip_value(F.col("src"), exact=options.exact, patterns=options.patterns)).select("locale", "src").distinct()
    fresh = translate(except_translated(needed, tm), call).where("NOT failed")
    return tm.select("target_locale", "src", "tgt").unionByName(fresh.select(F.col("locale").alias("target_locale"), "src", "tgt"))


def synced(changes: DataFrame, existing: DataFrame, tm: DataFrame, options: SyncOptions, call: Callable[[list[str], str], list[str]] | None = None) -> DataFrame:
    """(key, locale, ts, draft, doc, error) of changes (key, entity_type, slug, ts, status, data: the source document as JSON), one a key.

    existing (key, locale, doc) are the present translations: what people have filled in stays. A document or translation that is
    malformed gives an error for its own locale alone, the others go on. Equal documents are looked up once; strings that the memory
    lacks go to `call`, if there is one, and else stay as they are. Documents are dealt out by their bytes; changes are read three times, so they had better be settled.
    """
    each = F.explode(F.array(*(F.lit(x) for x in options.locales)))
    h = F.sha2("data", 256)
    size = changes.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    docs = dealt(changes.select("key", "data"), size, "key", most=tables.TASK_BYTES)
    slots = docs.select(h.alias("h"), F.explode(document_slots(options)("data")).alias("x")).select("h", "x.*").distinct().withColumn("locale", each)
    if call is not None:
        slots = settled(slots)
        tm = settled(with_translator(slots, tm, options, call))
    maps = D.text_maps(slots, ["h", "locale"], tm, options.site, options.localize_path, exact=options.exact, patterns=options.patterns)
    rows = changes.select("key", "entity_type", "slug", "ts", "status", "data", h.alias("h")).withColumn("locale", each).join(maps, ["h", "locale"], "left")
    rows, old = (dealt(df, size * len(options.locales), "key", "locale", most=tables.TASK_BYTES) for df in (rows, existing.select("key", "locale", F.col("doc").alias("old"))))
    rows = rows.join(old.hint("merge"), ["key", "locale"], "left")
    rows = rows.withColumn("x", _translated(options)("data", "texts", "links", "locale"))

    own = F.lit(None).cast("string")
    if options.slugs:
        of, to = F.get_json_object("data", "$.slug"), F.get_json_object("old", "$.slug")
        for lo in options.locales:
            own = F.when(F.col("locale") == lo, localized_slug(to, of, [F.col("x.title")], lo, options.latin_only, options.slugify)).otherwise(own)
        own = F.when((F.col("entity_type") == "collection") & F.col("slug").isin(list(options.slugs)), own)
    done = rows.withColumn("y", _finished(options)("x.doc", "old", "x.more", own, "locale"))
    error = F.coalesce("x.error", "y.error")
    return done.select("key", "locale", "ts", F.col("status").eqNullSafe("draft").alias("draft"), F.when(error.isNull(), F.col("y.doc")).alias("doc"), error.alias("error"))
