"""Loose candidates of personal data: what the trees accept and what they refuse."""

from pyspark.sql import functions as F

from lingualake.llm import pii


def _corpus(extra):
    rows = []
    for i in range(240):
        rows.append(f"write to user{i}@site{i}.example.org or tel: 555-{200 + i}-{4000 + i} today, mail me: bob{i} [at] site{i} [dot] org please")
        rows.append(f"order {100 + i % 90}-{100 + i % 80}-{1000 + i} shipped at 10:{10 + i % 50}:{10 + i % 40}, see v{i} 999.{i}.1.1 and {i % 9 + 1}234 5678 9012 345{i % 10}")
        rows.append(f"call +1 555 {100 + i} {2000 + i}, host 10.0.{i % 250}.1 and server 2001:db8::{i + 1:x}")
    return [(i, t) for i, t in enumerate([*rows, *extra])], len(rows)


def test_trees_accept_and_refuse_loose_candidates(spark):
    accepted = ["reach us, tel: 555-867-5309 or so", "mail: eve [at] home [dot] net now", "the server fe80:0:0:0:1:2:3:4 is up"]
    refused = ["part 155-067-5309 is out of stock", "it was 12:30:45 then", "look (at) this . it", ""]
    rows, n = _corpus([*accepted, *refused])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [(s["start"], s["kind"], s["end"]) for s in r["spans"]] for r in pii.detect_pii(df).where(F.col("doc_id") >= n).collect()}
    assert [got[n + k] for k in range(3)] == [[(15, 3, 27)], [(6, 0, 29)], [(11, 1, 29)]]
    assert all(got[n + 3 + k] == [] for k in range(len(refused)))


def test_every_generator_has_labels_of_both_kinds(spark):
    rows, _ = _corpus(["a@b.c1 and +12 3", "mail x [at] y . 12"])
    df = spark.createDataFrame(rows, "doc_id long, text string").select(F.explode(pii.candidates(F.col("text"))).alias("c"))
    seen = {(r[0], r[1]) for r in df.select("c.gen_bin", "c.label").distinct().collect() if r[1] is not None}
    assert seen == {(g, y) for g in range(len(pii.GENERATORS)) for y in (0, 1)}
