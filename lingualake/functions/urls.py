"""URLs and paths of localized sites."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import js_trim

# Fixed values
GLOBAL_FRAGMENTS = ["#organization", "#website", "#logo"]
ASSETS = r"(?i)\.(?:png|jpe?g|webp|svg|gif|avif|ico|pdf|mp4|mov|webm)\z"
#: Sections with slugs of their own in each locale.
SECTIONS = {
    "about": {"en": "about", "es": "sobre-nosotros", "fr": "a-propos", "de": "ueber-uns", "it": "chi-siamo", "pt": "sobre-nos", "ar": "من-نحن", "ru": "о-нас", "ja": "会社概要"},
    "contact": {"en": "contact", "es": "contacto", "fr": "contact", "de": "kontakt", "it": "contatto", "pt": "contato", "ar": "اتصل-بنا", "ru": "контакты", "ja": "お問い合わせ"},
    "blog": {"en": "blog", "es": "blog", "fr": "blog", "de": "blog", "it": "blog", "pt": "blog", "ar": "المدونة", "ru": "блог", "ja": "ブログ"},
    "solutions": {"en": "solutions", "es": "soluciones", "fr": "solutions", "de": "loesungen", "it": "soluzioni", "pt": "solucoes", "ar": "حلول", "ru": "решения", "ja": "ソリューション"},
    "products": {"en": "products", "es": "productos", "fr": "produits", "de": "produkte", "it": "prodotti", "pt": "produtos", "ar": "منتجات", "ru": "продукция", "ja": "製品"},
}


def localize_url(url: Column, locale: Column, site: Column, path_hook: Callable[[Column, Column], Column] | None = None) -> Column:
    """The URL under the locale's path; other sites, global fragments and assets stay; the query is dropped.

    path_hook(path, locale) gives the localized path in place of the rule: column functions, or a pandas UDF. The path begins with `/`.
    """
    rest = F.substring(url, F.length(site) + 1, F.length(url))
    ours = url.startswith(site) & rest.rlike(r"^(?:[/?#]|\z)")
    fragment = F.regexp_extract(rest, r"(#.*)\z", 1)
    fragment = F.when(fragment == "#", "").otherwise(fragment)
    path = F.regexp_extract(rest, r"^([^?#]*)", 1)
    bare = F.when(path.rlike(r"^/[A-Za-z]{2}(?:/|\z)"), F.substring(path, F.lit(4), F.length(path))).otherwise(path)
    keep = F.lower(fragment).isin(GLOBAL_FRAGMENTS) | path.rlike(ASSETS) | path.startswith("/images/")
    moved = F.when(bare.isin("", "/"), F.concat(site, F.lit("/"), locale, fragment)).otherwise(F.concat(site, F.lit("/"), locale, bare, fragment))
    if path_hook is not None:
        moved = F.concat(site, path_hook(F.when(path == "", "/").otherwise(path), locale), fragment)
    return F.when(~ours | keep, url).otherwise(moved)


def section_key(slug: Column) -> Column:
    """The section that a slug names in any locale, else the slug."""
    table = {s: k for k, by in SECTIONS.items() for s in by.values()}
    out = F.create_map(*(F.lit(x) for p in table.items() for x in p))
    return F.coalesce(F.try_element_at(out, slug), slug)


def section_slug(key: Column, locale: Column, otherwise: Column) -> Column:
    out = F.create_map(*(F.lit(x) for k, by in SECTIONS.items() for lo, s in by.items() for x in (f"{lo}/{k}", s)))
    return F.coalesce(F.try_element_at(out, F.concat(locale, F.lit("/"), key)), otherwise)


def localize_path(path: Column, locale: Column, source: str = "en") -> Column:
    clean = F.regexp_replace(path, r"^/+|/+\z", "")
    parts = F.split(clean, "/")
    one = section_slug(section_key(parts[0]), locale, parts[0])
    key = section_key(F.get(parts, F.lit(0)))
    parent = F.when(locale == source, key).otherwise(section_slug(key, locale, F.get(parts, F.lit(0))))
    inner = F.when(F.size(parts) == 1, one).when((F.size(parts) == 2) & key.isin("blog", "solutions"), F.concat(parent, F.lit("/"), F.get(parts, F.lit(1)))).otherwise(clean)
    prefix = F.when(locale == source, F.lit("")).otherwise(F.concat(F.lit("/"), locale))
    external = path.isNull() | (path == "") | path.startswith("http://") | path.startswith("https://") | path.startswith("//")
    home = F.when(locale == source, F.lit("/")).otherwise(prefix)
    return F.when(external, path).when(clean == "", home).otherwise(F.concat(prefix, F.lit("/"), inner))


def named_keys(slugs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., slug, key): what each slug of a dictionary (by..., key, locale, slug) names in any locale.

    A slug that names two keys is the one's whose source it is (key and slug are equal), else the least key's.
    """
    best = F.min_by("key", F.struct((F.col("key") != F.col("slug")).alias("other"), "key"))
    return slugs.groupBy(*by, "slug").agg(best.alias("key"))


def localized_paths(df: DataFrame, path: str, locale: str, pages: DataFrame, items: DataFrame, out: str = "localized", source: str = "en") -> DataFrame:
    """df with the localized form of its internal paths, by dictionaries that are tables.

    pages (key, locale, slug) holds the sections, items (section, key, locale, slug) what stands below some of them. One segment is
    looked up in any locale and given in the asked one; of two, the first one is too if its section has items, and the second by its
    section's; other paths get the locale alone. Without an entry a segment stays. External and empty paths stay, the source locale has no
    prefix. A row stays a row whatever the dictionaries repeat.
    """
    p, lo = F.col(path), F.col(locale)
    clean = F.regexp_replace(p, r"^/+|/+\z", "")
    parts = F.split(clean, "/")
    few = F.size(parts) <= 2
    rows = df.withColumns({"__a": F.when(few, parts[0]), "__b": F.when(F.size(parts) == 2, F.get(parts, F.lit(1))), "__lo": lo})
    rows = rows.join(named_keys(pages).select(F.col("slug").alias("__a"), F.col("key").alias("__k")), "__a", "left").withColumn("__k", F.coalesce("__k", "__a"))
    rows = rows.join(pages.groupBy(F.col("key").alias("__k"), F.col("locale").alias("__lo")).agg(F.min("slug").alias("__s")), ["__k", "__lo"], "left")
    rows = rows.join(items.select(F.col("section").alias("__k"), F.lit(True).alias("__has")).distinct(), "__k", "left")
    rows = rows.join(named_keys(items, ("section",)).select(F.col("section").alias("__k"), F.col("slug").alias("__b"), F.col("key").alias("__i")), ["__k", "__b"], "left").withColumn("__i", F.coalesce("__i", "__b"))
    rows = rows.join(items.groupBy(F.col("section").alias("__k"), F.col("key").alias("__i"), F.col("locale").alias("__lo")).agg(F.min("slug").alias("__t")), ["__k", "__i", "__lo"], "left")
    first, second = F.coalesce("__s", "__a"), F.coalesce("__t", "__b")
    inner = F.when(F.col("__b").isNull() & few, first).when(F.col("__has"), F.concat(F.when(lo == source, F.col("__k")).otherwise(first), F.lit("/"), second)).otherwise(clean)
    prefix = F.when(lo == source, F.lit("")).otherwise(F.concat(F.lit("/"), lo))
    external = p.isNull() | (p == "") | p.startswith("http://") | p.startswith("https://") | p.startswith("//")
    done = F.when(external, p).when(clean == "", F.when(lo == source, F.lit("/")).otherwise(prefix)).otherwise(F.concat(prefix, F.lit("/"), inner))
    return rows.select(*(c for c in df.columns if c != out), done.alias(out))


def internal_link(url: Column, domain: str, locale: Column) -> Column:
    """A link to the own domain, with or without protocol, as a localized path; others as localize_path has them."""
    own = rf"(?i)^(?:https?://)?(?:www\.)?{domain.replace('.', chr(92) + '.')}(/.*)?\z"
    path = F.when(url.rlike(own), F.coalesce(F.nullif(F.regexp_extract(url, own, 1), F.lit("")), F.lit("/"))).otherwise(url)
    return localize_path(path, locale)


def contact_link(url: Column) -> Column:
    clean = js_trim(F.coalesce(url, F.lit("")))
    mail = F.concat(F.lit("mailto:"), js_trim(F.regexp_replace(clean, r"(?i)^(?:mailto:\s*|correo a:\s*|ميلتو:\s*)", "")))
    tel = F.concat(F.lit("tel:"), js_trim(F.regexp_replace(clean, r"^[^\d+]+", "")))
    return F.when(clean.contains("@") & ~clean.startswith("mailto:"), mail).when(clean.rlike(r"[\d+]{7,}") & ~clean.startswith("tel:") & ~clean.startswith("http"), tel).otherwise(clean)
