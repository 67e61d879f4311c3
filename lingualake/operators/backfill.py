"""Bulk backfill of localized tables: what each locale lacks, and the changes that fill it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.filters import is_missing, should_skip_value
from ..functions.keys import base_id, localize_id, match_key, parent_key, target_keys
from ..sources.tables import dealt
from .documents import richtext_parts, translated_richtext
from .strings import tm_lookup


def fan_out_locales(source: DataFrame, locales: list[str]) -> DataFrame:
    """Every source row for every target locale: an explode of a short literal, no join."""
    return source.withColumn("locale", F.explode(F.array(*(F.lit(x) for x in locales))))


def match_target_rows(table: DataFrame, locales: list[str], fields: list[str], source: str = "en", parent_localized: bool = False, others: Sequence[str] = (), rich: Sequence[str] = ()) -> DataFrame:
    """(key, locale, parent, s_<field>..., o_<other>..., has_target, target_id, t_<field>...): source rows with their target rows.

    A source row with a string id is matched by it, else by its _uuid, else by its parent (a localized parent's string id
    without its suffix); a rule that finds nothing is not followed by the next. Of several target rows with one key the last by
    id counts (in a table without id, the greatest by its fields). key is the base of a string id, else the id as text, else the uuid's
    or the parent's base; tables with a _uuid give its base as uuid. others are columns that new rows take over from their source. rich are those of
    the fields that hold JSON: each is parsed where it is read, a source's once for all locales, and gives sp_<field> and tp_<field>.
    """
    has_id = "id" in table.columns
    parent = F.col("_parent_id").cast("string")
    if parent_localized and _is_text(table, "_parent_id"):
        parent = base_id(parent)
    text_id = has_id and _is_text(table, "id")
    id_ = F.col("id") if text_id else F.lit(None).cast("string")
    uuid = [F.col("_uuid")] if "_uuid" in table.columns else []
    key = base_id(F.col("id")) if text_id else F.col("id").cast("string") if has_id else F.coalesce(*(base_id(F.nullif(u, F.lit(""))) for u in uuid), parent)
    own = F.col("id") if has_id else F.lit(None).cast("string")
    kept = ["key", "parent", *("uuid" for _ in uuid), *(f"s_{f}" for f in fields), *(f"sp_{f}" for f in rich), *(f"o_{x}" for x in others)]
    rows = table.where(F.col("_locale") == source).select(match_key(id_, parent, *uuid).alias("__by"), key.alias("key"), F.col("_parent_id").alias("parent"), *(base_id(u).alias("uuid") for u in uuid), *(F.col(f).alias(f"s_{f}") for f in fields), *(richtext_parts(f).alias(f"sp_{f}") for f in rich), *(F.col(x).alias(f"o_{x}") for x in others))
    cells = [F.struct(own.alias("target_id"), *(F.col(f).alias(f"t_{f}") for f in fields), *(F.col(f"tp_{f}") for f in rich))]
    last = F.max_by(*cells, F.struct("id") if has_id else F.struct(*fields))
    targets = table.where(F.col("_locale").isin(locales)).select(*(["id"] if has_id else []), F.col("_locale").alias("locale"), *fields, *(richtext_parts(f).alias(f"tp_{f}") for f in rich), F.explode(target_keys(id_, parent, *uuid)).alias("__by"))
    n, by = table.count() * (1 + len(rich)), ["__by", "locale"]
    found = dealt(targets, n, *by).groupBy(*by).agg(last.alias("t"))
    # not by broadcast: of tables in files, Spark knows the compressed bytes alone
    out = dealt(fan_out_locales(rows, locales), n, *by).join(found.hint("merge"), by, "left")
    return out.select(kept[0], "locale", *kept[1:], F.col("t").isNotNull().alias("has_target"), "t.target_id", *(f"t.t_{f}" for f in fields), *(f"t.tp_{f}" for f in rich))


def _is_text(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.simpleString() == "string"


def needs(source: Column, target: Column, **rules) -> Column:
    """A text field needs translation: its source counts, and its target is missing or the source again."""
    return (is_missing(target) | target.eqNullSafe(source)) & ~should_skip_value(source, **rules)  # the value rules cost most: asked last


def richtext_writes(source: Column, target: Column, **rules) -> Column:
    """Rich text, by its parts, is to be written: the source is there, and the target is missing, the same, no rich text, or still holds
    a leaf of the source: one that counts, of 20 characters or more with a space."""
    long = F.filter(source["leaves"], lambda x: (F.length(x) >= 20) & x.contains(" ") & ~should_skip_value(x, **rules))
    left = F.when(source["leaves"].isNull(), False).when(target["leaves"].isNull(), True).otherwise(F.arrays_overlap(long, target["leaves"]))
    return F.coalesce(source["present"] & (_same(source, target) | left), F.lit(False))


def richtext_needs(source: Column, target: Column, **rules) -> Column:
    """Rich text needs translation: it is to be written, and if the target is missing or the same, it has a leaf that counts."""
    counts = F.exists(source["leaves"], lambda x: ~should_skip_value(x, **rules))
    return richtext_writes(source, target, **rules) & F.coalesce(F.when(_same(source, target), counts).otherwise(True), F.lit(False))


def _same(source: Column, target: Column) -> Column:
    return ~F.coalesce(target["present"], F.lit(False)) | target["form"].eqNullSafe(source["form"])


def with_needs(matched: DataFrame, fields: list[str], rich: Sequence[str] = (), **rules) -> DataFrame:
    """matched with n_<field> (needs translation), w_<field> for rich fields (is to be written), and needs, if any field does."""
    out = matched
    for f in fields:
        if f in rich:
            parts = F.col(f"sp_{f}"), F.col(f"tp_{f}")
            out = out.withColumn(f"n_{f}", richtext_needs(*parts, **rules)).withColumn(f"w_{f}", richtext_writes(*parts, **rules))
        else:
            out = out.withColumn(f"n_{f}", needs(F.col(f"s_{f}"), F.col(f"t_{f}"), **rules))
    return out.withColumn("needs", reduce(lambda a, b: a | b, (F.col(f"n_{f}") for f in fields)))


def missing_strings(matched: DataFrame, fields: list[str], rich: Sequence[str] = (), **rules) -> DataFrame:
    """(locale, src): each string, or leaf of rich text, that some target field still needs, once for each locale."""
    plain = [F.array(F.when(F.col(f"n_{f}"), F.col(f"s_{f}"))) for f in fields if f not in rich]
    leaves = [F.when(F.col(f"n_{f}"), F.filter(F.col(f"sp_{f}.leaves"), lambda x: ~should_skip_value(x, **rules))) for f in rich]
    every = F.concat(*(F.coalesce(x, F.array().cast("array<string>")) for x in (*plain, *leaves)))
    return matched.select("locale", F.explode(every).alias("src")).where("src IS NOT NULL").distinct()


def locale_gate(matched: DataFrame) -> DataFrame:
    """Locales with at least one string to translate."""
    return matched.where("needs").select("locale").distinct()


def build_updates(matched: DataFrame, tm: DataFrame, fields: list[str]) -> DataFrame:
    """(target_id, locale, field, value): the fields of existing rows that change."""
    some = matched.where("has_target AND needs")
    pairs = F.array(*(F.when(F.col(f"n_{f}"), F.struct(F.lit(f).alias("field"), F.col(f"s_{f}").alias("src"))) for f in fields))
    rows = some.select("target_id", "locale", F.explode(pairs).alias("x")).where("x IS NOT NULL").select("target_id", "locale", "x.field", "x.src")
    return tm_lookup(rows, tm, "src", "locale", "value").select("target_id", "locale", "field", "value")


def translated_fields(rows: DataFrame, tm: DataFrame, fields: list[str], rich: Sequence[str] = (), share: int | None = None, **rules) -> DataFrame:
    """rows (locale, s_<field>...) with v_<field>: texts that count by the memory, rich texts with their leaves so, all else as it is.

    One join with the memory serves the text fields of all columns, another the leaves of rich texts. All lookups, those of
    build_updates too, read one exchange of the memory, which is laid out by their key. A job of several actions gives memory(tm).
    """
    plain = [f for f in fields if f not in rich]
    if len(plain) > 1:
        rows = _looked_up(rows, tm, plain, share, **rules)
    for f in plain:
        if len(plain) == 1:
            rows = tm_lookup(rows, tm, f"s_{f}", "locale", f"v_{f}", share)
        rows = rows.withColumn(f"v_{f}", F.when(should_skip_value(F.col(f"s_{f}"), **rules), F.col(f"s_{f}")).otherwise(F.col(f"v_{f}")))
    if rich:
        every = F.array(*(F.col(f"s_{f}") for f in rich))
        done = translated_richtext(rows.select("locale", F.explode(every).alias("src")), tm, share, **rules)
        for f in rich:
            rows = rows.withColumn("h", F.sha2(f"s_{f}", 256)).join(done.select("locale", "h", F.col("value").alias(f"v_{f}")).hint("merge"), ["locale", "h"], "left").drop("h")
    return rows


def _looked_up(rows: DataFrame, tm: DataFrame, fields: list[str], share: int | None = None, **rules) -> DataFrame:
    """rows (locale, s_<field>...) with v_<field> by the memory: the rows themselves move once, whatever the number of fields.

    Their strings are looked up in long form and come back as one map for the texts of a row. A map is found by a hash of the texts;
    it is asked for a string, so texts that share a hash (and locale) do no harm, and rows with equal texts share one map.
    """
    texts = [F.col(f"s_{f}") for f in fields]
    rows = rows.withColumn("__texts", F.xxhash64(*texts))
    counts = F.array_compact(F.array(*(F.when(~should_skip_value(x, **rules), x) for x in texts)))
    long = rows.select("locale", "__texts", F.explode(F.array_distinct(counts)).alias("src"))
    pairs = F.collect_set(F.struct("src", "value"))
    found = tm_lookup(long, tm, "src", "locale", "value", share).where("value <> src").groupBy("locale", "__texts").agg(F.map_from_entries(pairs).alias("__found"))
    out = rows.join(found.hint("merge"), ["locale", "__texts"], "left")
    return out.select(*(c for c in rows.columns if c != "__texts"), *(F.coalesce(F.try_element_at("__found", x), x).alias(f"v_{f}") for f, x in zip(fields, texts)))


def build_inserts(matched: DataFrame, tm: DataFrame, fields: list[str], every: bool = False, parent_localized: bool = False, others: Sequence[str] = (), rich: Sequence[str] = (), **rules) -> DataFrame:
    """New rows for source rows without a target, in locales with any string to translate (or in all).

    Ids that are not strings stay null for the database to give, a table without id gets none; a _uuid gets the locale, and so does a
    localized parent's id. others (as given to match_target_rows) are taken over as they are.
    """
    new = matched.where("NOT has_target")
    if not every:
        new = new.join(F.broadcast(locale_gate(matched)), "locale", "left_semi")
    new = translated_fields(new, tm, fields, rich, **rules)
    lo = F.col("locale")
    id_ = localize_id(F.col("key"), lo) if _is_text(matched, "target_id") else F.lit(None).cast(matched.schema["target_id"].dataType)
    uuid = [F.when(F.col("uuid") != "", localize_id(F.col("uuid"), lo)).alias("_uuid")] if "uuid" in matched.columns else []
    parent = parent_key(F.col("parent"), lo, _is_text(matched, "parent"), parent_localized)
    return new.select(id_.alias("id"), *uuid, lo.alias("_locale"), lo.alias("published_locale"), parent.alias("_parent_id"), *(F.col(f"v_{f}").alias(f) for f in fields), *(F.col(f"o_{x}").alias(x) for x in others))


def update_rows(matched: DataFrame, tm: DataFrame, fields: list[str], rich: Sequence[str] = (), parent_localized: bool = False, gated: bool = False, **rules) -> DataFrame:
    """(id, _parent_id, _locale, changed, <field>...): the changes of existing rows, a row each, for a keyed store.

    Only the fields in `changed` count. A row is known by its id, in a table without one by its parent and locale. Rich text is also
    written where it has nothing to translate but the target lacks it, in locales with any string to translate (gated: matched holds no others).
    """
    write = {f: F.col(f"w_{f}") if f in rich else F.col(f"n_{f}") for f in fields}
    some = matched.where(F.col("has_target") & reduce(lambda a, b: a | b, write.values()))
    if rich and not gated:
        some = some.join(F.broadcast(locale_gate(matched)), "locale", "left_semi")
    done = translated_fields(some, tm, fields, rich, **rules)
    changed = F.array_compact(F.array(*(F.when(w, F.lit(f)) for f, w in write.items())))
    parent = parent_key(F.col("parent"), F.col("locale"), _is_text(matched, "parent"), parent_localized)
    return done.select(F.col("target_id").alias("id"), parent.alias("_parent_id"), F.col("locale").alias("_locale"), changed.alias("changed"), *(F.when(w, F.col(f"v_{f}")).alias(f) for f, w in write.items()))


def apply_changes(table: DataFrame, updates: DataFrame, inserts: DataFrame, fields: list[str]) -> DataFrame:
    """The table after the changes: updated columns replaced, new rows added unless their id is there already."""
    wide = updates.groupBy(F.col("target_id").alias("id")).agg(*(F.max(F.when(F.col("field") == f, F.col("value"))).alias(f"u_{f}") for f in fields))
    old = table.join(wide.hint("merge"), "id", "left").select(*(F.coalesce(f"u_{c}", c).alias(c) if c in fields else F.col(c) for c in table.columns))
    new = inserts
    if _is_text(inserts, "id"):  # other ids are the database's to give: nothing to compare yet
        new = inserts.dropDuplicates(["id"]).join(table.select("id").hint("merge"), "id", "left_anti")
    return old.unionByName(new.select(*table.columns))


def dry_run_plan(matched: DataFrame) -> DataFrame:
    """(locale, op, n): what a live run would write. Nothing is translated."""
    op = F.when(~F.col("has_target"), "insert").when(F.col("needs"), "update").otherwise("keep")
    return matched.groupBy("locale", op.alias("op")).agg(F.count("*").alias("n"))


def summary(matched: DataFrame, table: str) -> DataFrame:
    """Counts by table and locale, with totals (null keys), from the change set."""
    rows = matched.withColumn("table_name", F.lit(table))
    return rows.rollup("table_name", "locale").agg(
        F.count("*").alias("rows_seen"),
        F.count_if(~F.col("has_target")).alias("to_insert"),
        F.count_if(F.col("has_target") & F.col("needs")).alias("to_update"),
        F.count_if(F.col("has_target") & ~F.col("needs")).alias("skipped"),
    )


def coverage(matched: DataFrame, fields: list[str]) -> DataFrame:
    """(locale, field, n, done): how many translatable fields of each locale are translated."""
    rows = matched.select("locale", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"n_{f}").alias("n"), should_skip_value(F.col(f"s_{f}")).alias("skip")) for f in fields))).alias("x"))
    return rows.where("NOT x.skip").groupBy("locale", "x.field").agg(F.count("*").alias("n"), F.count_if(~F.col("x.n")).alias("done"))
