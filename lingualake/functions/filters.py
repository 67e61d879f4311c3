"""Which fields and values are translatable."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark import SparkContext
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values -----------------------------------------------------------------------------------------------------
#: White space that a JavaScript trim removes.
JS_SPACE = r"[\x09-\x0D\x20\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
PROTOCOLS = ["/", "http://", "https://", "mailto:", "tel:", "data:"]
SYSTEM_VALUES = (
    "en es fr ar pt de ru ja zh it nl ko tr pl centered left right top bottom grid list full banner columns default primary secondary "
    "dark light none auto contain cover solid dashed dotted medium large small md lg sm xs xl 2xl 3xl true false null undefined"
).split()
SYSTEM_FIELDS = (
    "id _locale _parent_id _order _path block_name created_at updated_at createdAt updatedAt blockType blockName layout status alignment "
    "color theme icon anchor_id type mode format direction style variant size display_type displayType action_type actionType target "
    "position shape fit aspect_ratio email href url link slug"
).split()
FIELD_ENDINGS = ["_id", "Id", "_href", "Href", "_url", "Url", "_link", "Link"]
ID_VALUE = r"^(?:[0-9a-fA-F]{24}|[0-9a-fA-F-]{36})\z"
MAIL_VALUE = r"^[^\s@]+@[^\s@]+\.[^\s@]+\z"
NUMBER_VALUE = r"^[0-9\-+.,%/ ()#]+\z"
FILE_VALUE = r"(?i)\.(?:png|jpe?g|webp|svg|gif|avif|ico|pdf|mp4|mov|webm|css|js|json|xml|zip|tar|gz)\z"
ASSET_VALUE = r"(?i)^(?:img|image|photo|picture|placeholder|icon|logo|file)(?:\s*\d+)?(?:\.[a-z0-9]+)?\z"
COLOUR_VALUE = r"^#(?:[0-9a-fA-F]{3}|[0-9a-fA-F]{6}|[0-9a-fA-F]{8})\z"
IGNORED_COLLECTIONS = ["media", "users", "payload-preferences", "payload-migrations", "submissions"]
# ------------------------------------------------------------------------------------------------------------------


def js_trim(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{JS_SPACE}+|{JS_SPACE}+\z", "")


def is_blank(c: Column) -> Column:
    """Null, empty, or white space only."""
    return c.isNull() | (js_trim(c) == "")


def is_missing(c: Column) -> Column:
    """Null or empty; white space counts as a value."""
    return c.isNull() | (c == "")


def _pattern(p: str) -> str | None:
    """A custom pattern as Java reads it: `/re/flags` keeps its own flags, others ignore case; None if it does not compile."""
    form = re.fullmatch(r"/(.+)/([a-z]*)", p, re.S)
    flags = "".join(f for f in form[2] if f in "ims") if form else "" if p.startswith("(?") else "i"
    p = (f"(?{flags})" if flags else "") + (form[1] if form else p)
    return p if _compiles(p) else None


def _compiles(p: str) -> bool:
    """Whether the engine that is to match the pattern takes it: the JVM's, not Python's."""
    try:
        SparkContext.getOrCreate()._jvm.java.util.regex.Pattern.compile(p)
    except IllegalArgumentException:
        return False
    return True


def skip_reason(value: Column, exact: Sequence[str] = (), patterns: Sequence[str] = ()) -> Column:
    """The first rule that keeps a value from being translated; null if it is to be translated. Invalid patterns are ignored."""

    def rule(t: Column) -> Column:
        chain = F.when(t.isNull() | (t == ""), "blank")
        starts = F.lit(False)
        for p in PROTOCOLS:
            starts = starts | t.startswith(p)
        chain = chain.when(starts, "link").when((F.length(t) <= 16) & F.lower(t).isin(SYSTEM_VALUES), "system")
        if exact:
            chain = chain.when(t.isin(*exact) | F.lower(t).isin(*exact), "custom_value")
        for p in filter(None, map(_pattern, patterns)):
            chain = chain.when(t.rlike(p), "custom_pattern")
        for name, p in (("id", ID_VALUE), ("mail", MAIL_VALUE), ("number", NUMBER_VALUE), ("file", FILE_VALUE), ("asset", ASSET_VALUE), ("colour", COLOUR_VALUE)):
            short = F.length(t).isin(24, 36) if name == "id" else F.length(t) <= 9 if name == "colour" else F.lit(True)
            chain = chain.when(short & t.rlike(p), name)
        return chain

    # the trimmed value is bound once, as a lambda's argument: as a filter the chain would trim it anew for every rule
    return F.transform(F.array(js_trim(value)), rule)[0]


def should_skip_value(value: Column, exact: Sequence[str] = (), patterns: Sequence[str] = ()) -> Column:
    return skip_reason(value, exact, patterns).isNotNull()


def translatable_field(name: Column, excluded: Sequence[str] = (), allow_slug: bool = False) -> Column:
    ends = F.lit(False)
    for e in FIELD_ENDINGS:
        ends = ends | name.endswith(e)
    return F.when(name == "slug", F.lit(allow_slug)).otherwise(~(name.isin(SYSTEM_FIELDS) | name.isin(list(excluded)) | name.startswith("_") | ends))


def is_translatable_field(name: str, excluded: Sequence[str] = (), allow_slug: bool = False) -> bool:
    """The same rule for one name, for schema loops and the JSON helpers."""
    if name == "slug":
        return allow_slug
    return not (name in SYSTEM_FIELDS or name in excluded or name.startswith("_") or name.endswith(tuple(FIELD_ENDINGS)))


def collection_enabled(slug: Column, config: dict[str, bool] | None = None, is_global: Column | None = None) -> Column:
    """A collection takes part unless it is switched off; without any configuration the system's own stay out. Globals
    stay in unless switched off."""
    off = [k for k, on in (config or {}).items() if on is False]
    chosen = ~slug.isin(off) if off else F.lit(True)
    if config:
        return chosen
    own = ~slug.isin(IGNORED_COLLECTIONS)
    return own if is_global is None else is_global | own


def without_excluded(fields: DataFrame, exclusions: DataFrame) -> DataFrame:
    """fields (collection, field, ...) without those that exclusions (collection, field) name; a null collection is all of them."""
    out = fields.join(exclusions.where("collection IS NOT NULL").select("collection", "field"), ["collection", "field"], "left_anti")
    return out.join(exclusions.where("collection IS NULL").select("field"), "field", "left_anti").select(*fields.columns)
