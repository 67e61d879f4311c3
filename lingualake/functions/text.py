"""Slugs, entities, echo tests and letter case, as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .filters import is_blank, js_trim

# Fixed values
NON_LATIN = "ar ru ja zh ko he fa hi th el uk bg".split()
GERMAN = {"ä": "ae", "ö": "oe", "ü": "ue", "Ä": "ae", "Ö": "oe", "Ü": "ue", "ß": "ss"}
SCRIPTS = {"ar": r"[\x{0600}-\x{06FF}\x{0750}-\x{077F}]", "ru": r"[\x{0400}-\x{04FF}]", "ja": r"[\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}]"}
ENTITIES = [("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " ")]


def _accents() -> tuple[str, str]:
    """Characters that decompose to one ASCII letter or digit (or to nothing), and what is left of each."""
    plain, gone = {}, []
    for i in range(0x80, 0x10000):
        left = "".join(c for c in unicodedata.normalize("NFD", chr(i)) if not 0x300 <= ord(c) <= 0x36F)
        if left == "":
            gone.append(chr(i))
        elif len(left) == 1 and left.isascii() and left.isalnum():
            plain[chr(i)] = left
    return "".join(plain) + "".join(gone), "".join(plain.values())


ACCENTED, BASE = _accents()


def decode_entities(c: Column) -> Column:
    """Named references in the fixed order, then numeric ones (only rows that hold any leave the JVM)."""
    for a, b in ENTITIES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.when(c.rlike(r"&#(?:\d+|x[0-9a-fA-F]+);"), _numeric(c)).otherwise(c)


@F.pandas_udf(T.StringType())
def _numeric(s: pd.Series) -> pd.Series:
    def point(m) -> str:
        n = int(m[1]) if m[1] else int(m[2], 16)
        return chr(n) if n < 0x110000 and not 0xD800 <= n < 0xE000 else "\ufffd"

    return s.str.replace(r"&#(?:(\d+)|x([0-9a-fA-F]+));", point, regex=True)


def slug_truncate(c: Column, most: int = 120) -> Column:
    cut = F.substring(c, 1, most)
    last = F.length(cut) - F.instr(F.reverse(cut), "-")  # position from 0 of the last hyphen
    word = F.when(cut.contains("-") & (last > most * 3 // 10), F.substring(cut, F.lit(1), last)).otherwise(cut)
    return F.when(F.length(c) > most, F.regexp_replace(word, r"-+\z", "")).otherwise(c)


def _hyphens(c: Column, keep: str) -> Column:
    return F.regexp_replace(F.regexp_replace(c, f"[^{keep}]+", "-"), r"^-+|-+\z", "")


def slugify_latin(c: Column, locale: str = "en", most: int = 120) -> Column:
    c = js_trim(F.coalesce(c, F.lit("")))
    if locale == "de":
        for a, b in GERMAN.items():
            c = F.replace(c, F.lit(a), F.lit(b))
    return slug_truncate(_hyphens(F.lower(F.translate(c, ACCENTED, BASE)), "a-z0-9"), most)


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFC")


def slugify_unicode(c: Column, locale: str, most: int = 120) -> Column:
    c = js_trim(F.coalesce(c, F.lit("")))
    if locale == "ar":
        c = F.regexp_replace(c, r"[\x{064B}-\x{0652}\x{0670}]", "")
    c = F.when(c.rlike(r"^\p{ASCII}*\z"), c).otherwise(_nfc(c))
    return slug_truncate(_hyphens(F.lower(c), r"\p{L}\p{N}"), most)


def slugify(c: Column, locale: str = "en", latin_only: bool = True, most: int = 120) -> Column:
    """Empty for a non-Latin locale while only Latin slugs are wanted: the caller keeps the source's."""
    if locale not in NON_LATIN:
        return slugify_latin(c, locale, most)
    return F.lit("") if latin_only else slugify_unicode(c, locale, most)


def is_echo(value: Column, source: Column, locale: Column) -> Column:
    """A translation that is blank, the source again, or in Latin letters where the locale has another script."""
    wrong = F.lit(False)
    for code, script in SCRIPTS.items():
        wrong = wrong | ((locale == code) & ~value.rlike(script) & value.rlike("[A-Za-z]{3,}"))
    return is_blank(value) | value.eqNullSafe(source) | wrong


def is_title_case(c: Column) -> Column:
    words = F.filter(F.split(c, r"[\s\x{00A0}\x{FEFF}]+"), lambda w: w.rlike("^[A-Za-z]"))
    capital = F.filter(words, lambda w: w.rlike("^[A-Z]"))
    return F.coalesce((F.length(c) >= 8) & c.contains(" ") & (F.size(words) >= 2) & (F.size(capital) >= 0.6 * F.size(words)), F.lit(False))


def sentence_case(c: Column) -> Column:
    t = js_trim(c)
    return F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, F.lit(2), F.length(t))))


def localized_slug(target_slug: Column, source_slug: Column, titles: list[Column], locale: str, latin_only: bool = True, hook: Callable[[Column, Column, Column], Column] | None = None) -> Column:
    """The slug of the first title that is there, only where the target has no slug of its own; 'home' never changes.

    hook(title, locale, source slug) makes the slug in place of the rule: column functions, or a pandas UDF.
    """
    title = F.coalesce(*(F.nullif(t, F.lit("")) for t in titles), F.lit(""))
    slug = hook(title, F.lit(locale), source_slug) if hook is not None else slugify(title, locale, latin_only)
    made = F.coalesce(F.nullif(slug, F.lit("")), source_slug)
    own = ~(F.coalesce(target_slug, F.lit("")) == "") & ~target_slug.eqNullSafe(source_slug)
    return F.when(source_slug == "home", source_slug).when(own, target_slug).otherwise(made)
