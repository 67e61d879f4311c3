"""License scans: planted notices, edited wordings, a brute-force search, odd rows."""

from __future__ import annotations

import random
import re

from lingualake.llm.licenses import PART, TEMPLATES, Scanner, _norm, scan_licenses
from lingualake.llm.queries_text import op7_licenses

NOTICE = [t for t in TEMPLATES if len(t[2].split()) < 14]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def nearest(words):
    """The license of the template that lies nearest to any part of the words, by trying every part."""
    best = []
    for name, keys, wording in TEMPLATES:
        pattern = [w for w in map(_norm, wording.split()) if w]
        for a in range(len(words)):
            for b in range(a + 1, min(len(words), a + len(pattern) * 6 // 5 + 1) + 1):
                if set(keys.split()) <= set(words[a:b]) and (d := distance(pattern, words[a:b])) * PART <= len(pattern):
                    best.append((d / len(pattern), -len(pattern), a, b, name))
    return min(best)[-1] if best else None


def test_against_brute_force():
    rng = random.Random(5)
    scanner = Scanner()
    for _ in range(40):
        words = rng.choice(NOTICE)[2].split()
        if rng.random() < 0.7:
            words[rng.randrange(len(words))] = rng.choice(["license", "other", "BY", "MIT", "2.0"])
        text = " ".join(["some", "words", *words, "and", "more"])
        want = nearest([_norm(w) for w in text.split()])
        got = [f["license"] for f in scanner.scan(text)]
        assert got[:1] == ([want] if want else []), (text, got, want)


def test_long_wording_with_edits_and_wrapping():
    wording = TEMPLATES[6][2]
    text = "Intro text.\n\n" + wording.replace("Software", "Program", 2).replace(" ", "\n") + "\n\nOutro."
    (found,) = Scanner().scan(text)
    assert found["license"] == "MIT" and found["differences"] == 2
    assert text[found["start"] :].startswith("Permission\nis") and text[: found["stop"]].endswith("conditions:")
    (found,) = Scanner().scan("é𝄞 word " * 5000 + wording + " word" * 5000)
    assert found["differences"] == 0 and found["start"] == 8 * 5000


def test_many_notices_and_clean_texts():
    text = "Released under the MIT License.\n" * 400
    assert [f["differences"] for f in Scanner().scan(text)] == [0] * 400
    for clean in ["", " \n", "license " * 2000, "A licensed driver needs permission and a warranty.", "Released under the Foo License."]:
        assert Scanner().scan(clean) == []


def test_rows(spark):
    rows = [(1, None, 7), (2, "", 7), (3, "Licensed under CC BY-NC 4.0.", 7), (3, "Licensed under CC BY-NC 4.0.", 7), (None, "Released under the MIT License.", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, licenses int")
    got = sorted(((r[0] or 0, [f["license"] for f in r[1]]) for r in scan_licenses(docs).collect()))
    assert got == [(0, ["MIT"]), (1, []), (2, []), (3, ["CC-BY-NC-4.0"]), (3, ["CC-BY-NC-4.0"])]
    assert scan_licenses(docs.limit(0)).count() == 0


def test_query_finds_every_planted_notice(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in op7_licenses(spark, folder).collect()}
    assert got.keys() == texts.keys()
    exact = "|".join(re.escape(w) for *_, w in NOTICE)
    for i, text in texts.items():
        want = {m.span() for m in re.finditer(exact, text)}
        spans = {tuple(map(int, f.split(":")[1:3])) for f in got[i]["findings"].split(",") if f}
        assert {(a, b) for a, b in want} <= spans, i


def test_every_template_in_its_own_wording():
    for name, _, wording in TEMPLATES:
        found = Scanner().scan("Some words before.\n\n" + wording + "\n\nSome words after it.")
        assert name in [f["license"] for f in found] and found[0]["differences"] == 0, name


def test_other_savings_hide_no_notice():
    free = [t[2] for t in TEMPLATES if t[0] in ("GPL-3.0", "GPL-2.0", "LGPL-2.1", "AGPL-3.0")]
    rest = " ".join(w.split(" version")[0].split("; either")[0].split(", either")[0] for w in free)
    found = Scanner().scan(f"{rest} Released under the MIT License.")
    assert [f["license"] for f in found] == ["MIT"]
