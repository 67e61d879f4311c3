"""Where a pattern matches in a text, with DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,value:string>>"


def spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (start, end, value); code points, end exclusive.

    What lies between the matches and the matches themselves, in turn, give every position by adding lengths up.
    """
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        first = acc["at"] + F.length(x["b"])
        last = first + F.length(x["m"])
        one = F.struct(first.cast("int").alias("start"), last.cast("int").alias("end"), x["m"].alias("value"))
        return F.when(x["m"].isNull(), acc).otherwise(F.struct(last.cast("int").alias("at"), F.concat(acc["out"], F.array(one)).alias("out")))

    def placed(found: Column) -> Column:
        zipped = F.arrays_zip(F.split(text, pattern, -1).alias("b"), found.alias("m"))
        return F.when(F.size(found) == 0, F.array().cast(SPAN)).otherwise(F.aggregate(zipped, start, step, lambda acc: acc["out"]))

    # the matches are bound once, as a lambda's argument: written out they would be searched for anew at each mention
    return F.transform(F.array(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), placed)[0]


def redact(text: Column, found: Column, mark: Column | str) -> Column:
    """text with each of the spans (sorted, not overlapping) replaced by a mark."""
    mark = F.lit(mark) if isinstance(mark, str) else mark
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        return F.struct(x["end"].cast("int").alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), mark).alias("out"))

    done = F.aggregate(found, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(found) == 0, text).otherwise(done)


def char_class(c: Column) -> Column:
    """0: none or white space, 1: letter or digit, 2: other."""
    return F.when(c.rlike(r"^[\p{L}\p{N}]$"), 1).when((c == "") | c.rlike(r"^\s$"), 0).otherwise(2)
