"""Documents whose schema is known: extraction, translation, merge and ids as column expressions compiled from the schema, without Python.

They equal the JSON helpers on documents of that schema, a null field being one that is not there. Rich text, which nests without a
bound, has no schema and stays with the helpers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.filters import is_blank, is_translatable_field, should_skip_value
from ..functions.keys import base_id, localize_id
from .strings import tm_lookup


def _none(kind: T.DataType) -> Column:
    return F.lit(None).cast(kind)


def _struct(col: Column, schema: T.StructType, cell) -> Column:
    """A struct with each field made anew; null stays null."""
    made = F.struct(*(cell(f).cast(f.dataType).alias(f.name) for f in schema))
    return F.when(col.isNotNull(), made)


def strings(col: Column, schema: T.DataType, excluded=()) -> Column:
    """array<string> of the texts under translatable fields, at any depth; bare strings of arrays are left out."""
    none = F.array().cast("array<string>")
    if isinstance(schema, T.ArrayType):
        if isinstance(schema.elementType, T.StructType | T.ArrayType):
            return F.coalesce(F.flatten(F.transform(col, lambda x: strings(x, schema.elementType, excluded))), none)
        return none
    parts = []
    for f in schema:
        if is_translatable_field(f.name, excluded):
            if isinstance(f.dataType, T.StringType):
                parts.append(F.array_compact(F.array(col[f.name])))
            elif isinstance(f.dataType, T.StructType | T.ArrayType):
                parts.append(strings(col[f.name], f.dataType, excluded))
    return F.coalesce(F.concat(*parts), none) if parts else none


def translated(col: Column, schema: T.DataType, texts: Column, excluded=()) -> Column:
    """col with its translatable texts, bare strings of arrays among them, replaced by what a map has for them."""

    def word(x: Column) -> Column:
        return F.coalesce(F.nullif(F.try_element_at(texts, x), F.lit("")), x)

    if isinstance(schema, T.ArrayType):
        if isinstance(schema.elementType, T.StringType):
            return F.transform(col, word)
        if isinstance(schema.elementType, T.StructType | T.ArrayType):
            return F.transform(col, lambda x: translated(x, schema.elementType, texts, excluded))
        return col

    def cell(f: T.StructField) -> Column:
        if not is_translatable_field(f.name, excluded):
            return col[f.name]
        if isinstance(f.dataType, T.StringType):
            return word(col[f.name])
        return translated(col[f.name], f.dataType, texts, excluded) if isinstance(f.dataType, T.StructType | T.ArrayType) else col[f.name]

    return _struct(col, schema, cell)


def merged(new: Column, old: Column, schema: T.DataType) -> Column:
    """Two values of one schema as one: what a person has filled in stays, what is empty takes the new side."""
    if isinstance(schema, T.ArrayType):
        return merged_blocks(new, old, schema)
    if isinstance(schema, T.StringType):
        return F.when(is_blank(old), new).otherwise(old)
    if not isinstance(schema, T.StructType):
        return F.coalesce(old, new)

    def cell(f: T.StructField) -> Column:
        if not is_translatable_field(f.name):
            return F.coalesce(new[f.name], old[f.name])
        return merged(new[f.name], old[f.name], f.dataType)

    made = F.struct(*(cell(f).cast(f.dataType).alias(f.name) for f in schema))
    return F.when(new.isNull(), old).when(old.isNull(), new).otherwise(made)


def merged_blocks(new: Column, old: Column, schema: T.ArrayType) -> Column:
    """Items in the new order, each merged with the unused old item of its base id, else of its type and place.

    Old items are looked up through two maps from base id and from type to their places, so an item costs its own candidates.
    """
    item = schema.elementType
    if not isinstance(item, T.StructType):
        return F.when(F.coalesce(F.size(old), F.lit(0)) > 0, old).otherwise(new)
    names = item.fieldNames()

    def base(x: Column) -> Column:
        raw = x["id"].cast("string") if "id" in names else _none(T.StringType())
        return F.when(raw != "", base_id(raw))

    def kind(x: Column) -> Column:
        return F.nullif(x["blockType"], F.lit("")) if "blockType" in names else _none(T.StringType())

    def places(key) -> Column:
        """Map from key to the places of the old items that have it."""
        each = F.transform(old, lambda o, k: F.struct(key(o).alias("key"), k.alias("k")))
        keys = F.array_distinct(F.array_compact(F.transform(old, key)))
        return F.map_from_arrays(keys, F.transform(keys, lambda x: F.transform(F.filter(each, lambda e: e["key"] == x), lambda e: e["k"])))

    maps = F.struct(places(base).alias("base"), places(kind).alias("kind"))

    def run(m: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            it, i = x["it"], x["i"]

            def first(found: Column) -> Column:
                return F.get(F.filter(found, lambda k: ~F.array_contains(acc["used"], k)), F.lit(0))

            there = F.get(old, i)
            same = F.when(kind(it).isNotNull(), kind(there).eqNullSafe(kind(it))).otherwise(kind(there).isNull())
            here = F.when((i < F.size(old)) & ~F.array_contains(acc["used"], i) & same, i)
            k = F.coalesce(first(F.try_element_at(m["base"], base(it))), here, first(F.try_element_at(m["kind"], kind(it))))
            one = F.when(k.isNull(), it).otherwise(merged(it, F.get(old, k), item)).cast(item)
            used = F.when(k.isNull(), acc["used"]).otherwise(F.concat(acc["used"], F.array(k)))
            return F.struct(used.alias("used"), F.concat(acc["out"], F.array(one)).alias("out"))

        zero = F.struct(F.array().cast("array<int>").alias("used"), F.array().cast(schema).alias("out"))
        return F.aggregate(F.transform(new, lambda x, i: F.struct(x.alias("it"), i.alias("i"))), zero, step, lambda acc: acc["out"])

    done = F.transform(F.array(maps), run)[0]  # the maps are made once
    empty = F.lit(0)
    return F.when(F.coalesce(F.size(old), empty) == 0, new).when(F.coalesce(F.size(new), empty) == 0, old).otherwise(done)


def localized(col: Column, schema: T.DataType, locale: Column) -> Column:
    """col with every id in the locale; ids that are numbers are dropped (null)."""
    if isinstance(schema, T.ArrayType):
        return F.transform(col, lambda x: localized(x, schema.elementType, locale)) if isinstance(schema.elementType, T.StructType | T.ArrayType) else col

    def cell(f: T.StructField) -> Column:
        x = col[f.name]
        if f.name == "id" and isinstance(f.dataType, T.StringType):
            return F.when(x == "", x).otherwise(localize_id(x, locale))
        if f.name == "id" and isinstance(f.dataType, T.NumericType):
            return _none(f.dataType)
        return localized(x, f.dataType, locale) if f.name not in ("blockType", "blockName") and isinstance(f.dataType, T.StructType | T.ArrayType) else x

    return _struct(col, schema, cell)


def typed_strings(docs: DataFrame, excluded=(), **rules) -> DataFrame:
    """(doc_id, src): the distinct strings of each document (doc_id, doc: a struct) that are to be translated."""
    found = F.explode(F.array_distinct(strings(F.col("doc"), docs.schema["doc"].dataType, excluded)))
    return docs.select("doc_id", found.alias("src")).where(~should_skip_value(F.col("src"), **rules))


def translate_typed(docs: DataFrame, tm: DataFrame, locales: list[str], excluded=(), share: int | None = None, **rules) -> DataFrame:
    """(doc_id, locale, doc): each document (doc_id, doc: a struct) in each locale; no row leaves the JVM.

    Documents are known by a hash of what they hold, so a doc_id may repeat, and equal documents are looked up once.
    """
    kind = docs.schema["doc"].dataType
    each = F.explode(F.array(*(F.lit(x) for x in locales)))
    rows = docs.withColumn("h", F.sha2(F.to_json("doc"), 256))
    needed = typed_strings(rows.select(F.col("h").alias("doc_id"), "doc"), excluded, **rules).distinct().withColumn("locale", each)
    maps = tm_lookup(needed, tm, "src", "locale", share=share).where("src <> translated").groupBy(F.col("doc_id").alias("h"), "locale").agg(F.map_from_entries(F.collect_list(F.struct("src", "translated"))).alias("texts"))
    out = rows.withColumn("locale", each).join(maps, ["h", "locale"], "left")
    texts = F.coalesce("texts", F.create_map().cast("map<string,string>"))
    return out.select("doc_id", "locale", localized(translated(F.col("doc"), kind, texts, excluded), kind, F.col("locale")).alias("doc"))
