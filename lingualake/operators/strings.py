"""Distinct strings, translation memory, batches and the injected translator."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_echo, is_title_case, sentence_case
from ..sources.tables import settled


def long_form(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One row for each field of each row: keys, field, value."""
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields))
    return df.select(*keys, F.explode(pairs).alias("x")).select(*keys, "x.field", "x.value")


def distinct_strings(df: DataFrame, by: list[str], value: str = "src") -> DataFrame:
    """Each string once for each group; repeated lines combine before the shuffle."""
    return df.select(*by, value).distinct()


def memory(tm: DataFrame) -> DataFrame:
    """The translation memory with one row for each locale and string, written once for all lookups of a job."""
    return settled(_one_each(tm))


def _one_each(tm: DataFrame) -> DataFrame:
    if tm.columns == ["__l", "__s", "__t"]:
        return tm
    return tm.groupBy(F.col("target_locale").alias("__l"), F.col("src").alias("__s")).agg(F.max("tgt").alias("__t"))


def heavy_strings(df: DataFrame, src: str, locale: str, share: int = 1000) -> DataFrame:
    """(__l, __s): strings that more than one row in `share` has, so fewer than `share` whatever the size of df."""
    n = df.where(F.col(src).isNotNull()).groupBy(F.col(locale).alias("__l"), F.col(src).alias("__s")).agg(F.count("*").alias("n"))
    return n.join(F.broadcast(n.agg(F.sum("n").alias("all"))), F.col("n") * share > F.col("all")).select("__l", "__s")


def tm_lookup(df: DataFrame, tm: DataFrame, src: str, locale: str, out: str = "translated", share: int | None = None) -> DataFrame:
    """df with the memory's translation, or the string itself where there is none or an empty one. tm: as given, or memory(tm).

    With share, strings of more than one row in so many (and rows without a string) do not go through the shuffle: they are
    looked up first, fewer than share of them, and sent to the rows where those are.
    """
    one = _one_each(tm)
    to = F.coalesce(F.nullif("__t", F.lit("")), F.col(src)).alias(out)

    def looked(rows: DataFrame, known: DataFrame) -> DataFrame:
        return rows.join(known, (rows[locale] == F.col("__l")) & (rows[src] == F.col("__s")), "left")

    names = [c for c in df.columns if c != out]
    if share is None:
        return looked(df, one).select(*names, to)
    heavy = settled(heavy_strings(df, src, locale, share).join(one, ["__l", "__s"], "left"))
    marked = looked(df, F.broadcast(heavy))
    apart = F.col(src).isNull() | F.col("__s").isNotNull()
    rest = looked(marked.where(~apart).drop("__l", "__s", "__t"), one).select(*names, to)
    return marked.where(apart).select(*names, to).unionByName(rest)


def except_translated(needed: DataFrame, tm: DataFrame) -> DataFrame:
    known = tm.where("tgt IS NOT NULL AND tgt <> ''").select(F.col("target_locale").alias("locale"), "src")
    return needed.join(known, ["locale", "src"], "left_anti")


def batch_assign(strings: DataFrame, by: list[str], most: int = 15, chars: int = 6000, buckets: int = 32) -> DataFrame:
    """Batches of at most `most` strings and `chars` characters, in string order within each hash bucket of a group.

    A longer string is a batch of its own. The bucket, not the partition, decides, so reruns and other cluster sizes agree.
    """
    rows = strings.withColumn("bucket", (F.conv(F.substring(F.md5("src"), 1, 4), 16, 10).cast("int") % buckets))
    keys = [*by, "bucket"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, batch, n, total = None, 0, 0, 0
        for pdf in batches:
            out = []
            for row in zip(*(pdf[k] for k in keys), pdf["src"].str.len()):
                key, size = row[:-1], row[-1]
                if key != at:
                    at, batch, n, total = key, 0, 0, 0
                elif n >= most or total + size > chars:
                    batch, n, total = batch + 1, 0, 0
                n, total = n + 1, total + size
                out.append(batch)
            yield pdf.assign(batch=out)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.repartition(*keys).sortWithinPartitions(*keys, "src").mapInPandas(run, f"{fields}, batch int")


def translate(strings: DataFrame, call: Callable[[list[str], str], list[str]], size: int = 15) -> DataFrame:
    """(locale, src, tgt, failed): an injected translator over distinct strings, in small lists.

    A list that fails or comes back with another length is tried again, then string by string; what still fails
    keeps its original and counts as failed.
    """

    def one(batch: list[str], locale: str) -> list[str | None]:
        for _ in range(2):
            try:
                got = call(batch, locale)
                if len(got) == len(batch):
                    return got
            except Exception:  # noqa: BLE001  the translator is foreign code
                continue
        return [None] if len(batch) == 1 else [x for s in batch for x in one([s], locale)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for locale, g in pdf.groupby("locale", sort=False):
                src = g["src"].tolist()
                got = [x for k in range(0, len(src), size) for x in one(src[k : k + size], locale)]
                yield pd.DataFrame({"locale": locale, "src": src, "tgt": [t if t is not None else s for s, t in zip(src, got)], "failed": [t is None for t in got]})

    return strings.select("locale", "src").mapInPandas(run, "locale string, src string, tgt string, failed boolean")


def retry_form(src: Column, strategy: str = "sentence") -> Column:
    return sentence_case(src) if strategy == "sentence" else F.lower(src)


def retry_candidates(translated: DataFrame) -> DataFrame:
    """Echoed title-case strings (locale, src, tgt) with the form in which they are to be looked up again."""
    echo = is_echo(F.col("tgt"), F.col("src"), F.col("locale")) & is_title_case(F.col("src"))
    return translated.where(echo).select("locale", "src", retry_form(F.col("src")).alias("retry"))


def retried(translated: DataFrame, again: DataFrame, strategy: str = "sentence") -> DataFrame:
    """(locale, src, tgt, failed): translated (locale, src, tgt) after a second lookup of its echoed title-case strings.

    again (locale, src, tgt) holds translations of their retry forms; one that echoes its own form does not count. What stays
    an echo keeps its original and counts as failed.
    """
    form = retry_form(F.col("src"), strategy)
    echo = F.coalesce(is_echo(F.col("tgt"), F.col("src"), F.col("locale")), F.lit(False))
    rows = translated.select("locale", "src", "tgt", echo.alias("echo"), F.when(echo & is_title_case(F.col("src")), form).alias("form"))
    found = again.groupBy("locale", F.col("src").alias("form")).agg(F.max("tgt").alias("second"))
    found = found.where(~is_echo(F.col("second"), F.col("form"), F.col("locale")))
    out = rows.join(found, ["locale", "form"], "left")
    tgt = F.when(~F.col("echo"), F.col("tgt")).otherwise(F.coalesce("second", "src"))
    return out.select("locale", "src", tgt.alias("tgt"), (F.col("echo") & F.col("second").isNull()).alias("failed"))
