"""Personal data: generators of high recall propose overlapping spans, boosted trees score them, calibrated thresholds
select redactions. DataFrame functions only.

There is no table of labelled spans, so format and context label candidates. A base match is positive if it passes its check
(range, digit count, check sum, letters at the end of a host), else negative. A loose candidate (spelt-out address, telephone
number without a country code or after a word that announces one, long IP address) is negative if its form cannot be one,
positive if it can and a word before it says so, and open otherwise. The trees see neither check, only lengths, signs,
neighbours and context. The threshold of a kind is the lowest at which its labelled candidates in a held-out fold reach the asked precision.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, whole
from .spans import char_class, spans
from .trees import boost, expression, value

KINDS = ("email", "ip", "card", "phone")
# The base patterns, written so that no run is scanned twice: a match starts where a run starts (or a match ended).
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
LOOSE_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]++(?:\x20?(?:[(\[]dot[)\]]|\.)\x20?[A-Za-z0-9-]++)++"
LOOSE_PHONE = r"(?<![0-9A-Za-z+.(-])(?<!\+[0-9]{1,3}[\x20.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z.-])|(?<=(?i:tel|phone|mobile|fax|call)[:.]?\x20)\(?[0-9](?:[()\x20./-]*+[0-9])++"
LONG_IP = r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:{1,2}){2,7}+[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"
#: (kind, pattern, what a text with a match contains, base), by generator; the loose ones are the last three.
GENERATORS = ((0, EMAIL, "@", True), (1, IP, ".", True), (2, CARD, None, True), (3, PHONE, "+", True), (0, LOOSE_EMAIL, "at", False), (3, LOOSE_PHONE, None, False), (1, LONG_IP, ":", False))
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CONTEXT = r"(?i)(?:mail|contact|phone|tel|call|mobile|fax|card|visa|pay|host|server|addr|write)"
FEATURES = ("gen", "digits", "marks", "before", "after", "context", "tail")
_TYPE = "array<struct<kind:int,start:int,end:int,base:boolean,label:int," + ",".join(f"{x}_bin:int" for x in FEATURES) + ">>"


def _valid(kind: int, v: Column) -> Column:
    digits = F.length(F.regexp_replace(v, "[^0-9]+", ""))
    if kind == 1:
        return v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}\z")
    if kind == 2:
        return digits.between(14, 19) & F.call_function("luhn_check", F.substring(F.translate(v, " -", ""), 1, 19))
    if kind == 3:
        return digits.between(10, 15)
    return F.lit(True)


def _sound(gen: int, v: Column) -> Column:
    """Whether a candidate of a generator can be what its kind says, by form alone."""
    if gen in (0, 4):
        return v.rlike(r"[A-Za-z]{2,}\z")
    if gen == 5:
        digits = F.regexp_replace(v, "[^0-9]+", "")
        grouped = v.rlike(r"^\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}\z")
        return F.when(grouped, digits.rlike("^[2-9][0-9]{2}[2-9]")).otherwise(F.length(digits).between(7, 15))
    if gen == 6:
        groups, gaps = F.size(F.split(v, ":+")), F.size(F.split(v, "::")) - 1
        return (groups == 8) & (gaps == 0) | (groups >= 3) & (groups < 8) & (gaps == 1)
    return _valid(gen, v)


def _binned(text: Column, gen: int, kind: int, base: bool):
    """What turns a span of one generator into a candidate with its bins."""

    def one(s: Column) -> Column:
        v = s["value"]
        n = F.length(F.regexp_replace(v, "[^0-9]+", ""))
        left = F.when(s["start"] > 0, F.substring(text, s["start"], F.lit(1))).otherwise("")
        near = F.substring(text, F.greatest(F.lit(1), s["start"] - 23), F.least(F.lit(24), s["start"]))
        bins = {
            "gen": F.lit(gen),
            "digits": F.when(n < 7, 0).when(n < 10, 1).when(n < 12, 2).when(n < 14, 3).when(n < 16, 4).when(n < 20, 5).otherwise(6),
            "marks": F.when(v.rlike(r"[()]"), 2).when(v.rlike(r"[\x20.-]"), 1).otherwise(0),
            "before": char_class(left),
            "after": char_class(F.substring(text, s["end"] + 1, F.lit(1))),
            "context": near.rlike(CONTEXT).cast("int"),
            "tail": F.when(v.rlike(r"\.[A-Za-z]{2,6}\z"), 1).when(v.rlike(r"[A-Za-z]\z"), 2).otherwise(0),
        }
        ok = _valid(kind, v) if base else F.lit(False)
        sound = _sound(gen, v)
        label = sound.cast("int") if base else F.when(~sound, 0).when(near.rlike(CONTEXT), 1)
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), ok.alias("base"), label.alias("label"), *(bins[x].cast("int").alias(f"{x}_bin") for x in FEATURES))

    return one


def candidates(text: Column) -> Column:
    """All generators' spans of a text with their bins; label 1 or 0 where format and context decide, else null."""
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    parts = []
    for gen, (kind, pattern, needs, base) in enumerate(GENERATORS):
        found = spans(text, pattern)
        found = F.when(text.contains(needs), found).otherwise(empty) if needs else found
        parts.append(F.transform(found, _binned(text, gen, kind, base)).cast(_TYPE))
    return F.concat(*parts)


def detect_pii(docs: DataFrame, precision: float = 0.98, rounds: int = 12) -> DataFrame:
    """(doc_id, spans) for every row of docs (doc_id, text): spans sorted by start, then kind, each (kind, start, end,
    base, score). Base spans are all kept; others are those of a form that can be one which the trees score at the threshold of
    their kind or above and that overlap no base span; a generator without a positive example adds none. Null and empty texts have none; rows that repeat are each searched; other columns are not read.
    """
    rows = cut(docs.select("doc_id", candidates(whole(F.col("text"))).alias("found")))
    one = rows.select("doc_id", F.explode("found").alias("c")).where("c.label IS NOT NULL")
    fold = F.pmod(F.xxhash64("doc_id", "c.start", "c.end", "c.gen_bin"), F.lit(4))
    names = [f"c.{x}_bin" for x in FEATURES]
    counted = one.groupBy(*names, (fold == 0).alias("held")).agg(F.sum("c.label").alias("pos"), F.sum(1 - F.col("c.label")).alias("neg")).collect()  # as many rows as bins at most
    x = np.array([list(r)[: len(FEATURES)] for r in counted], int).reshape(len(counted), len(FEATURES))
    order = np.lexsort(x.T) if len(x) else []
    x = x[order] if len(x) else x
    held, pos, neg = (np.array([r[k] for r in counted], float)[order] if len(counted) else np.zeros(0) for k in ("held", "pos", "neg"))
    fit = held == 0
    trees, threshold, taught = [], [np.inf] * len(KINDS), []
    if pos[fit].sum() and neg[fit].sum():
        trees = boost(x[fit], pos[fit], neg[fit], rounds)
        score = sum(value(t, x) for t in trees)
        taught = [g for g in range(len(GENERATORS)) if pos[fit & (x[:, 0] == g)].sum()]
        kinds = np.array([g[0] for g in GENERATORS])[x[:, 0]]
        for k in range(len(KINDS)):
            apart = ~fit & (kinds == k)
            for s in np.unique(score[apart])[::-1]:
                on = (score >= s) & apart
                if pos[on].sum() >= precision * (pos[on] + neg[on]).sum() and s > 0:
                    threshold[k] = float(s)
    base = F.filter("found", lambda c: c["base"])

    def scored(c: Column) -> Column:
        s = expression(trees, [c[f"{f}_bin"] for f in FEATURES]) if trees else F.lit(0.0)
        return F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), c["base"].alias("base"), s.alias("score"))

    rows = rows.select("doc_id", F.transform(base, scored).alias("sure"), F.transform(F.filter("found", lambda c: c["gen_bin"].isin([g for g in taught if not GENERATORS[g][3]]) & (F.coalesce(c["label"], F.lit(1)) == 1)), scored).alias("more"))
    least = F.array(*(F.lit(t) for t in threshold))
    clear = F.filter("more", lambda c: (c["score"] >= F.element_at(least, c["kind"] + 1)) & ~F.exists("sure", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return rows.select("doc_id", F.array_sort(F.concat("sure", clear)).alias("spans"))


def pii_digest(found: DataFrame) -> DataFrame:
    """The contract's columns of detect_pii's rows."""
    name = F.array(*(F.lit(k) for k in KINDS))
    base = F.filter("spans", lambda s: s["base"])

    def joined(spans_: Column) -> Column:
        return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(i: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == i))).cast("long")

    counts = [number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
