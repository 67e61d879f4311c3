"""The corpus pipeline, stage by stage, against brute force on a small fixture."""

import collections
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __rid long, score double, key string"
COLUMNS = [x.split()[0] for x in SCHEMA.split(", ")]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rng = np.random.default_rng(5)
    vocab = [f"w{i}x" for i in range(300)]
    rows = []
    for i in range(150):
        words = list(rng.choice(vocab, 40 + i % 60))
        text = " ".join(words) if i % 5 else "!!! ".join(w.upper() for w in words)  # every fifth is bad
        if i % 10 == 1:
            text += f' the token = "{"".join(rng.choice(list("0123456789abcdef"), 40))}" here'
        rows.append((i, text))
    rows += [(1000 + i, rows[i][1]) for i in (1, 2, 3)] + [(1010, rows[4][1] + " one")] + [(7, rows[11][1]), (None, rows[12][1]), (2000, None), (2001, ""), (2002, " \n")]
    rows = [(i, t, "en", "abc"[k % 3] if k % 7 else None, None if t is None else len(t), 3, 0.5, "z") for k, (i, t) in enumerate(rows)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(0, 140)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def shingles(t, k=5):
    w = WORDS.findall((t or "").lower())
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def test_stages(spark, made):
    import corpus_pipeline as C
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{made}/documents.parquet")
    seen = [docs]
    for k, (_, stage) in enumerate(C.STAGES):
        path = f"{made}/stage{k}"
        stage(spark, seen[-1], made).write.parquet(path)
        seen.append(spark.read.parquet(path))
        assert k == 4 or seen[-1].columns == COLUMNS
    raw, good, single, clean, mixed, packed = ([tuple(r) for r in d.collect()] for d in seen)

    bad = {t for i, t, *_ in raw if i is not None and i < 150 and i % 5 == 0}
    assert not bad & {r[1] for r in good} and {r[1] for r in raw if r[1] and WORDS.search(r[1])} - bad <= {r[1] for r in good}

    sets = [shingles(r[1]) for r in good]
    comp = list(range(len(good)))
    for a, b in itertools.combinations(range(len(good)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            comp = [comp[a] if c == comp[b] else c for c in comp]
    best = {}
    for k, r in enumerate(good):
        best[comp[k]] = min(best.get(comp[k], (True, 0)), (r[0] is None, r[0] or 0))
    assert collections.Counter(r[0] for r in single) == collections.Counter(None if none else i for none, i in best.values())

    token = re.compile(r'(the token = ")[0-9a-f]{40}(")')
    want = collections.Counter((r[0], token.sub(r"\1<SECRET>\2", r[1]) if r[1] else r[1]) for r in single)
    assert collections.Counter((r[0], r[1]) for r in clean) == want and all(r[4] is None or r[4] == len(r[1]) for r in clean if r[1] is not None)

    from lingualake.llm.mixing import mix_sources

    taken = collections.Counter()
    for r in mix_sources(seen[3]).collect():
        taken[r["source"]] += r["taken"]
    got = collections.Counter()
    for r in mixed:
        got[r[3]] += len(WORDS.findall(r[1]))
    assert got == +taken

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for r in mixed:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [0]
        assert len(ids) <= 2048
        want[r[0], 0, 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert collections.Counter(r[:5] for r in packed) == want


def test_run_and_empty_tables(spark, made, tmp_path):
    import corpus_pipeline as C

    assert C.run(spark, made).count() > 0
    for name in ("documents", "labels"):
        spark.read.parquet(f"{made}/{name}.parquet").where(F.lit(False)).write.parquet(f"{tmp_path}/{name}.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0
