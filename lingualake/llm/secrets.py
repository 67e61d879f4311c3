"""Secret scan: generators propose tokens, random forests remove false findings. DataFrame functions only.

There is no table of labelled findings; two views of a candidate label it for each other. Where the surroundings are plain
(a credential word assigns it; or it stands in a plain sentence) they label it for a forest that sees the form alone:
length, character transitions, dictionary coverage, path, symbols. Where the form is plain (a provider's prefix, the
length of a digest, a word of the dictionary) it labels the candidate for a forest that sees the neighbouring words and
signs alone. No forest sees what its own labels were made from. A candidate stays if the geometric mean of both forests
reaches the threshold, or if its format leaves no doubt. The dictionary is what the corpus itself says most often.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, whole
from .spans import char_class, redact, spans
from .trees import expression, forest

_WORDS = r"token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|private[_-]?key|credential|bearer|auth"
_KEY = rf"(?i:{_WORDS})[\"']?\s{{0,3}}[:=]\s{{0,3}}"
#: A run that could be a credential: not inside a longer run, nor the slashes of a URL (a login may follow).
TOKEN = r"(?<![A-Za-z0-9+/_-])(?!(?<=:)//)[A-Za-z0-9+/_-]{16,}+={0,2}"
_SIGN = r"[:=]\s{0,3}"
#: What a credential word assigns: a quoted value, or one up to a space, quote, comma or semicolon; of any characters.
#: The sign alone is looked for first: it is there before few words, and the words before it cost far more to match.
ASSIGNED = rf"(?<=[\"'])(?<={_SIGN}[\"'])(?<={_KEY}[\"'])[^\"'\r\n]{{6,}}+(?=[\"'])|(?<=[:=\s])(?<={_SIGN})(?<={_KEY})[^\s\"',;]{{5,}}[^\s\"',;.:!?)\]}}]"
#: What a sentence says that a credential is. Neither view labels it by itself: the forests decide.
TOLD = rf"(?<=\sis\s)(?<=(?i:{_WORDS})\sis\s)[^\s\"',;]{{5,}}[^\s\"',;.:!?)\]}}]"
_BLOCK = r"[A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
#: A key block of any length up to its end, headers included (hyphens of up to 200 header words; base64 has none); without an end, header
#: lines and what base64 follows them.
PEM = rf"-----BEGIN {_BLOCK}(?:[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+){{0,200}}+-----END {_BLOCK}|(?:[\r\n]++[A-Za-z-]{{1,30}}: [^\r\n]*+){{0,20}}+[A-Za-z0-9+/=\r\n\\]*+)"
JWT = r"(?=eyJ)(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+(?:\.[A-Za-z0-9_-]++)?"
#: User and password of a URL.
LOGIN = r"(?<=://)[^\s/:@\"']++:[^\s/@\"']{3,}+(?=@)"
#: None but a key block starts inside a word; that test comes first, as most places fail it.
GENERATORS = f"{PEM}|(?<![A-Za-z0-9])(?:{'|'.join((JWT, LOGIN, ASSIGNED, TOLD, TOKEN))})"
#: Formats that leave no doubt: key blocks, signed tokens, fixed prefixes with their fixed lengths; so does a URL's login.
CERTAIN = r"^(?:-----BEGIN|eyJ[A-Za-z0-9_-]{8,}\.eyJ|(?:AKIA|ASIA)[0-9A-Z]{16}\z|gh[pos]_[A-Za-z0-9]{36}\z|xox[abprs]-|AIza[A-Za-z0-9_-]{35}\z|sk_live_)"
#: Passwords of a login that stand for one: then the forests decide.
STAND_IN = r"(?i):(?:pass(?:word|wd|phrase)?|pwd|secret|token|x{3,}|\*+|\.{3}|<.*>|\$.*|%.*|\{.*\}|\[.*\])\z"
FORM = ("length", "turns", "covered", "path", "digits", "hex", "symbols")
NEAR = ("cue", "sign", "before", "after")
_TYPE = "array<struct<start:int,end:int,sure:boolean,by_near:int,by_form:int," + ",".join(f"{x}_bin:int" for x in FORM + NEAR) + ">>"


def dictionary(docs: DataFrame, size: int = 300) -> str:
    """The `size` words (4 to 12 small letters) that the most texts hold, as a pattern: longest first."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(whole(F.col("text"))), F.lit(r"(?<![a-z0-9])[a-z]{4,12}(?![a-z0-9])"), F.lit(0)))
    counted = docs.select(F.explode(words).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    found = [r["w"] for r in counted.orderBy(F.desc("n"), "w").limit(size).collect()]  # the dictionary's size, whatever the corpus
    return "|".join(sorted(found, key=lambda w: (-len(w), w))) or r"\z."


def candidates(text: Column, words: str) -> Column:
    """Every generator's spans with their bins, and the labels that each view gives (null: undecided)."""

    def one(s: Column) -> Column:
        v = s["value"]
        n = F.length(v)
        near = F.substring(text, F.greatest(F.lit(1), s["start"] - 31), F.least(F.lit(32), s["start"]))
        turns = F.regexp_count(v, F.lit(r"(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]")) / n
        covered = 1 - F.length(F.regexp_replace(F.lower(v), words, "")) / n
        digits = n - F.length(F.translate(v, "0123456789", ""))
        is_hex = v.rlike(r"^[0-9a-f]+\z")
        adjacent = near.rlike(rf"(?i)(?:{_WORDS})[\"']?\s{{0,3}}[:=]?\s{{0,3}}[\"']?\z")
        cue = F.when(adjacent, 3).when(near.rlike(rf"(?i)(?:{_WORDS}|key)"), 2).when(near.rlike(r"(?i)(?:commit|sha|md5|hash|checksum|digest|version|file|path|uuid|href|http)"), 1).otherwise(0)
        sign = F.when(near.rlike(r"[\"']\z"), 3).when(near.rlike(r"=\s?\z") | near.rlike(r"://\z"), 2).when(near.rlike(r":\s{0,3}\z"), 1).otherwise(0)
        fixed = v.rlike(CERTAIN)
        login = near.endswith("://") & (F.substring(text, s["end"] + 1, F.lit(1)) == "@") & ~v.rlike(STAND_IN)
        bins = {
            "length": F.when(n < 8, 0).when(n < 16, 1).when(n < 20, 2).when(n < 32, 3).when(n < 40, 4).when(n < 48, 5).otherwise(6),
            "turns": F.when(turns == 0, 0).when(turns < 0.1, 1).when(turns < 0.3, 2).otherwise(3),
            "covered": F.when(covered < 0.2, 0).when(covered < 0.5, 1).when(covered < 0.8, 2).otherwise(3),
            "path": F.when(v.contains("/"), 1).otherwise(0),
            "digits": F.when(digits == 0, 0).when(digits < n, 1).otherwise(2),
            "hex": is_hex.cast("int"),
            "symbols": v.rlike(r"[^A-Za-z0-9+/_=-]").cast("int"),
            "cue": cue,
            "sign": sign,
            "before": char_class(F.substring(near, -1, 1)),
            "after": char_class(F.substring(text, s["end"] + 1, F.lit(1))),
        }
        by_near = F.when((cue == 3) & (sign >= 2), 1).when((cue <= 1) & (sign == 0) | (cue == 3) & (sign == 1), 0)
        by_form = F.when(fixed | is_hex & (digits > 0) & (digits < n) & n.isin(32, 40, 64) | (n >= 16) & (turns >= 0.3) & (covered < 0.2), 1).when((digits == 0) | (digits == n) | (covered >= 0.8), 0)
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), (fixed | login).alias("sure"), by_near.cast("int").alias("by_near"), by_form.cast("int").alias("by_form"), *(bins[x].cast("int").alias(f"{x}_bin") for x in FORM + NEAR))

    return F.transform(spans(text, GENERATORS), one).cast(_TYPE)


def _trained(rows: DataFrame) -> list[tuple[tuple, list]]:
    """The forests that have labels of both kinds to learn from: (features, trees)."""
    out = []
    for names, label in ((FORM, "by_near"), (NEAR, "by_form")):
        one = rows.select(F.explode("found").alias("c")).where(f"c.{label} IS NOT NULL")
        counted = one.groupBy(*(f"c.{x}_bin" for x in names)).agg(F.sum(f"c.{label}").alias("pos"), F.sum(1 - F.col(f"c.{label}")).alias("neg")).collect()  # as many rows as bins at most
        table = np.array(sorted(tuple(r) for r in counted), float).reshape(len(counted), len(names) + 2)
        pos, neg = table[:, -2], table[:, -1]
        if pos.sum() and neg.sum():
            out.append((names, forest(table[:, :-2].astype(int), pos, neg)))
    return out


def _score(forests: list[tuple[tuple, list]], c: Column) -> Column:
    parts = [expression(trees, [c[f"{f}_bin"] for f in names], mean=True) for names, trees in forests]
    learned = F.sqrt(parts[0] * parts[1]) if len(parts) == 2 else parts[0] if parts else F.coalesce(c["by_near"], c["by_form"], F.lit(0)).cast("double")
    return F.when(c["sure"], 1.0).otherwise(learned)


def find_secrets(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, n_candidates, found) for every row of docs (doc_id, text); found: spans (start, end, score) that stay.

    Null and empty texts have none; rows that repeat are each searched; where the labels of one view are all alike, the other
    forest decides alone, without either the labels themselves; other columns are not read.
    """
    rows = cut(docs.select("doc_id", candidates(whole(F.col("text")), dictionary(docs)).alias("found")))
    forests = _trained(rows)
    scored = F.transform("found", lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), _score(forests, c).alias("score")))
    return rows.select("doc_id", F.size("found").cast("long").alias("n_candidates"), F.filter(scored, lambda c: c["score"] >= threshold).alias("found"))


def redact_secrets(docs: DataFrame, threshold: float = 0.5, mark: str = "<SECRET>") -> DataFrame:
    """docs with every secret of its text replaced by a mark, and n_chars (where there is one) set anew.

    Each row is searched once and written down with its candidates; the forests are fitted over all of them, and the rows
    are then rewritten as they are read again, without a join.
    """
    text = whole(F.col("text"))
    at = "__found"
    while at in docs.columns:
        at += "_"
    rows = cut(docs.withColumn(at, candidates(text, dictionary(docs))))
    forests = _trained(rows.select(F.col(at).alias("found")))
    out = rows.withColumn(at, F.filter(at, lambda c: _score(forests, c) >= threshold))
    out = out.withColumn("text", F.when(F.size(at) == 0, F.col("text")).otherwise(redact(text, F.col(at), mark)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(at) == 0, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)
