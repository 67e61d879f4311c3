"""Quality rules by distribution divergence, with DataFrame functions alone.

A document's histogram of character classes and of common words is compared with its language's reference by
Jensen-Shannon distance. The references are sums over all documents of the language. Texts below a minimum
length are not compared: so few counts say nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, cut, whole, word_array

#: Frequent function words of each language whose share is compared; other languages use them all.
COMMON = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "with", "on"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un"],
}
#: (class, what to delete so that only the class is left)
CLASSES = {"upper": r"[^\p{Lu}]+", "lower": r"[^\p{Ll}]+", "digit": r"[^\p{Nd}]+", "symbol": r"[^\p{S}#%&*@|\\/<>!]+", "other": r"[^\p{P}]+"}
SYMBOLS = "#*$%&|<>"
N_WORDS = 12
#: A text has too few of its language's common words with less than one in LEAST of the language's share of them; which of
#: them it has is compared from HITS on.
LEAST, HITS = 4, 20


def repeat_words(words: Column) -> Column:
    """How many words stand in 5-word windows that occur twice or more in the text."""
    windows = F.when(F.size(words) < 5, F.array().cast("array<long>")).otherwise(F.transform(F.sequence(F.lit(1), F.size(words) - 4), lambda i: F.xxhash64(F.slice(words, i, 5))))

    def covered(hashes: Column) -> Column:
        order = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        # neighbours in hash order tell which windows occur again; the array is bound once, as a lambda's argument
        twice = F.flatten(F.transform(F.array(order), lambda s: F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))))
        at = F.array_sort(F.transform(twice, lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(at, zero, lambda acc, i: F.struct((i + 5).alias("end"), (acc["n"] + 5 - F.greatest(F.lit(0), acc["end"] - i)).alias("n")), lambda acc: acc["n"])

    def counted(bound: Column) -> Column:
        return F.when(F.size(F.array_distinct(bound)) == F.size(bound), F.lit(0)).otherwise(F.coalesce(covered(bound), F.lit(0)))

    return F.transform(F.array(windows), counted)[0]


def _measures(docs: DataFrame) -> DataFrame:
    text = whole(F.col("text"))
    rows = docs.select("doc_id", F.when(F.col("lang").isin(*COMMON), F.col("lang")).otherwise("other").alias("lang"), text.alias("text"), word_array(text).alias("w"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    every = sorted({w for ws in COMMON.values() for w in ws})
    lists = F.create_map(*(x for k, ws in (COMMON | {"other": every[:N_WORDS]}).items() for x in (F.lit(k), F.array(*(F.lit(w) for w in ws)))))
    hits = F.filter(F.transform("w", lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?"))), lambda w: w.isin(*every))
    classes = [F.length(F.regexp_replace("text", p, "")).cast("double") for p in CLASSES.values()]
    return rows.select(
        "doc_id",
        "lang",
        F.length("text").cast("long").alias("n_chars"),
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.transform(F.array(lines), lambda a: F.size(a) - F.size(F.array_distinct(a)))[0].cast("long").alias("n_dup_lines"),
        F.transform(F.array("w"), repeat_words)[0].cast("long").alias("n_repeat_words"),
        F.array(*classes).alias("chars"),
        F.transform(F.array(hits), lambda h: F.transform(F.element_at(lists, F.col("lang")), lambda k: F.size(F.filter(h, lambda x: x == k)).cast("double")))[0].alias("common"),
    )


def js_distance(a: Column, b: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two histograms of counts; 0 if either is empty."""

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda t, v: t + v)

    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    def of(x: Column, y: Column) -> Column:
        p, q = F.transform(x, lambda v: v / total(x)), F.transform(y, lambda v: v / total(y))
        terms = F.zip_with(p, q, lambda u, v: part(u, (u + v) / 2) + part(v, (u + v) / 2))
        return F.sqrt(F.greatest(F.lit(0.0), total(terms) / 2))

    return F.when((total(a) > 0) & (total(b) > 0), of(a, b)).otherwise(0.0)


def _fence(bins: list[tuple[int, int]]) -> float:
    """Third quartile and three quartile ranges of distances counted in hundredths."""
    bins, total = sorted(bins), sum(c for _, c in bins)

    def quartile(q: int) -> int:
        seen = 0
        for b, c in bins:
            seen += c
            if 4 * seen >= q * total:
                return b
        return 100

    return (quartile(3) + 3 * (quartile(3) - quartile(1))) / 100


def quality_rules(docs: DataFrame, min_chars: int = 200, min_words: int = 40, most_chars: float = 0.35, most_words: float = 0.75) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, char_distance,
    word_distance, char_failed, word_failed) for every row of docs (doc_id, text, lang).

    Base rules: base_failed if there are fewer than 10 words, or more than a fifth of them stand in repeated windows. Of the
    others a text of at least min_chars characters is kept if its character classes are within most_chars of its language's,
    and one of at least min_words words if besides its common words (with the other words as one more bin) are within
    most_words, their share is no less than a quarter of its language's, and among themselves they are, from HITS on,
    within the upper fence (third quartile and three quartile ranges) of the distances of all its language's documents.
    The last two need a known language. A null text has no words; a null or unknown language is compared with the other such documents; rows that
    repeat are each judged; other columns are not read.
    """
    rows = cut(_measures(docs))
    with_rest = F.concat("common", F.array(F.col("n_words") - F.aggregate("common", F.lit(0.0), lambda t, v: t + v)))
    n = len(CLASSES)
    sums = rows.withColumn("common", with_rest).groupBy("lang").agg(*(F.sum(F.col("chars")[i]).alias(f"c{i}") for i in range(n)), *(F.sum(F.col("common")[i]).alias(f"w{i}") for i in range(N_WORDS + 1)))
    found = sums.collect()  # five rows at most
    if not found:
        found = [{"lang": "other"} | {f"c{i}": 0.0 for i in range(n)} | {f"w{i}": 0.0 for i in range(N_WORDS + 1)}]

    def reference(name: str, size: int) -> Column:
        return F.element_at(F.create_map(*(x for r in found for x in (F.lit(r["lang"]), F.array(*(F.lit(float(r[f"{name}{i}"])) for i in range(size)))))), F.col("lang"))

    rows = rows.withColumn("char_distance", js_distance(F.col("chars"), reference("c", n))).withColumn("word_distance", js_distance(with_rest, reference("w", N_WORDS + 1)))
    hits = F.aggregate("common", F.lit(0.0), lambda t, v: t + v)
    known, enough = F.col("lang").isin(*COMMON), F.col("n_words") >= min_words
    rows = rows.withColumn("among", F.when(known & enough & (hits >= HITS), js_distance(F.col("common"), reference("w", N_WORDS))))
    counted = rows.where("among IS NOT NULL").groupBy("lang", F.ceil(F.col("among") * 100).alias("bin")).agg(F.count("*").alias("n")).collect()  # 404 rows at most
    fence = F.create_map(*(F.lit(x) for k in COMMON for x in (k, _fence([(r["bin"], r["n"]) for r in counted if r["lang"] == k]))))
    wanted = F.create_map(*(F.lit(x) for r in [*found, {"lang": ""} | {f"w{i}": 0.0 for i in range(N_WORDS + 1)}] for x in (r["lang"], sum(r[f"w{i}"] for i in range(N_WORDS)) / max(1.0, sum(r[f"w{i}"] for i in range(N_WORDS + 1))))))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    few = known & (LEAST * hits < F.element_at(wanted, F.col("lang")) * F.col("n_words"))
    others = F.coalesce(F.col("among") > F.element_at(fence, F.col("lang")), F.lit(False))
    rows = rows.withColumn("char_failed", (F.col("n_chars") >= min_chars) & (F.col("char_distance") > most_chars))
    rows = rows.withColumn("word_failed", enough & ((F.col("word_distance") > most_words) | few | others))
    kept = ~failed & ~F.col("char_failed") & ~F.col("word_failed")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), kept.alias("kept"), "char_distance", "word_distance", "char_failed", "word_failed")
