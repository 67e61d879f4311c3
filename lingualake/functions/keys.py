"""Ids with locale suffixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SUFFIX = r"(_[a-z]{2}(-[A-Z]{2})?)+\z"


def base_id(c: Column, locales: Sequence[str] | None = None) -> Column:
    """The id without its locale suffixes; with locales given, only those count as suffixes."""
    return F.regexp_replace(c, SUFFIX if locales is None else rf"(_({'|'.join(locales)}))+\z", "")


def localize_id(c: Column, locale: Column) -> Column:
    return F.concat(base_id(c), F.lit("_"), locale)


def match_key(id_: Column, parent: Column | None = None, uuid: Column | None = None) -> Column:
    """What a row is matched by: its string id, else its uuid, else its parent; a prefix keeps the three apart."""
    key = F.when(id_.isNotNull(), F.concat(F.lit("i:"), base_id(id_)))
    if uuid is not None:
        key = key.when(~(F.coalesce(uuid, F.lit("")) == ""), F.concat(F.lit("u:"), base_id(uuid)))
    return key.otherwise(F.concat(F.lit("p:"), parent.cast("string"))) if parent is not None else key


def target_keys(id_: Column, parent: Column, uuid: Column | None = None) -> Column:
    """The keys that a target row answers to: its string id alone, else its uuid and its parent, as far as it has them."""
    none = F.lit(None).cast("string")
    rest = [match_key(none, none, uuid)] if uuid is not None else []
    return F.when(id_.isNotNull(), F.array(match_key(id_))).otherwise(F.array_compact(F.array(*rest, match_key(none, parent))))


def parent_key(parent: Column, locale: Column, is_string: bool, parent_localized: bool) -> Column:
    return localize_id(parent, locale) if is_string and parent_localized else parent
