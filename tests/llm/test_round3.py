"""Winnowing, alignment and periodic runs against brute force: nulls, empty and long texts, ties, repeats, clashing columns."""

import collections
import glob
import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from lingualake.llm import alignment, periods, queries_text, registry, winnow

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, row long, w string, n_hit long, chunk long, keys string, runs string, n long"
RND = random.Random(5)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 9, "x", 8, 7, "k", "r", 6) for i, t in rows], DOCS).repartition(3)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def prose(n, of=400):
    return " ".join(f"w{RND.randrange(of)}" for _ in range(n))


# --- winnowing -------------------------------------------------------------------------------------------------------
def by_hand(docs, items, size=10):
    out = collections.Counter()
    for doc_id, text in docs:
        w, hit, ids = words_of(text), set(), set()
        for item_id, t in items:
            x = words_of(t)
            m = min(size, len(x))
            windows = {tuple(x[i : i + m]) for i in range(len(x) - m + 1)} if x else set()
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in windows:
                    hit |= set(range(i, i + m))
                    ids |= {str(item_id)} if item_id is not None else {None}
        ids.discard(None)
        out[doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)] += 1
    return out


ITEMS = "item_id long, text string, fp long, words string"


def test_contamination(spark, monkeypatch):
    monkeypatch.setattr(winnow, "BLOCK", 300)
    monkeypatch.setattr(winnow, "SLICE", 40)
    passage, other, tail = prose(60), prose(14), prose(10)
    items = [(1, passage), (2, other), (10, passage), (3, "Short   ITEM here"), (4, "Ünïcode"), (5, None), (6, ""), (7, " .,! "), (None, tail), (8, " ".join(passage.split()[20:31]) + " z"), (9, "rep rep rep rep"), (9, "rep rep rep rep")]
    p = passage.split()
    docs = [(1, prose(50) + " " + passage.upper().replace(" ", ", ") + " " + prose(9)), (2, " ".join(p[5:14])), (3, " ".join(p[5:15])), (4, "a short\nitem. HERE and short item there"), (5, None), (6, ""), (7, "ünïcode ÜNÏCODE"), (8, tail), (8, tail), (None, other + " " + tail), (11, prose(3000) + " " + other), (12, "rep " * 50), (13, " ".join(p[:9]) + " q " + " ".join(p[9:18])), (14, "... ---")]
    docs += [(20 + k, " ".join(p[k : k + 12])) for k in range(40)] + [(100 + k, prose(30) + " " + passage) for k in range(30)]
    got = winnow.contamination(frame(spark, docs), spark.createDataFrame([(i, t, 5, "q") for i, t in items], ITEMS)).drop("items")
    assert collections.Counter(map(tuple, got.collect())) == by_hand(docs, items)


def test_contamination_empty(spark):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, prose(20), 0, "")], ITEMS)
    assert winnow.contamination(frame(spark, []), some).count() == 0
    assert [tuple(r)[1:4] for r in winnow.contamination(frame(spark, [(1, "a b")]), none).collect()] == [(2, 0, 0)]


def test_every_shared_window_has_a_shared_fingerprint():
    rng = np.random.default_rng(1)
    for _ in range(50):
        span = rng.integers(0, 2**63, 10, dtype=np.uint64)
        a, b = (np.concatenate([rng.integers(0, 2**63, k, dtype=np.uint64), span, rng.integers(0, 2**63, 7, dtype=np.uint64)]) for k in (3, 11))
        assert winnow.fingerprints(a, 10, 6)[3] == winnow.fingerprints(b, 10, 6)[11] == winnow.fingerprints(span, 10, 6)[0]


def test_op11_equals_its_sql(spark):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    got = queries_text.op11_winnowing(spark, SF)
    want = con.execute(registry.oracle_sql()["op11_winnowing"])
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


# --- alignment -------------------------------------------------------------------------------------------------------
def test_gustavson_equals_a_dense_product(monkeypatch):
    rng = np.random.default_rng(2)
    for block in (1, 5, 1 << 20):
        monkeypatch.setattr(alignment, "ENTRIES", block)
        for _ in range(30):
            a, b = rng.integers(0, 2, (rng.integers(1, 9), 7)), rng.integers(0, 2, (rng.integers(1, 9), 7))
            csr = [alignment.Csr(np.concatenate([[0], np.cumsum(x.sum(1))]), np.nonzero(x)[1], 7) for x in (a, b)]
            out = np.zeros((len(a), len(b)), int)
            for r, c, v in alignment.gustavson(csr[0], csr[1].transposed()):
                out[r, c] = v
            assert (out == a @ b.T).all()


def aligned_by_hand(docs):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    level = alignment._byte_level()
    count, rows = collections.Counter(), []
    for doc_id, text in docs:
        links, groups, n_a, n_b = [], [], 0, 0
        if text:
            x = [(k, bytes(level[c] for c in t.id_to_token(k))) for k in t.encode(" " + text, add_special_tokens=False).ids]
            y = [(k, bytes([int(p[3:5], 16)]) if sp.is_byte(k) else p.replace("▁", " ").encode()) for k in sp.encode(text) for p in [sp.id_to_piece(k)]]
            want = (" " + text).encode()
            if b"".join(p for _, p in x) == want == b"".join(p for _, p in y):
                n_a, n_b = len(x), len(y)
                spans = []
                for side in (x, y):
                    at, out = 0, []
                    for k, p in side:
                        out.append((at, at + len(p), k))
                        at += len(p)
                    spans.append(out)
                links = [(a[2], b[2]) for a in spans[0] for b in spans[1] if a[0] < b[1] and b[0] < a[1]]
                ends = sorted({a[1] for a in spans[0]} & {b[1] for b in spans[1]})
                groups = [([a[2] for a in spans[0] if lo < a[1] <= hi], [b[2] for b in spans[1] if lo < b[1] <= hi]) for lo, hi in zip([0, *ends], ends)]
        count.update(set(links))
        rows.append((doc_id, n_a, n_b, groups, links))
    best = collections.defaultdict(int)
    for (a, _), c in count.items():
        best[a] = max(best[a], c)
    out = collections.Counter()
    for doc_id, n_a, n_b, groups, links in rows:
        s = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out[doc_id, n_a, n_b, len(groups), len(links), sum(len(a) * len(b) for a, b in groups), sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links), hashlib.sha256(s.encode()).hexdigest() if s else ""] += 1
    return out


def test_align(spark, monkeypatch):
    import public_tokenizers

    rows = [(1, "Hello world, an <|endoftext|> and </s> <unk> text."), (2, None), (3, ""), (4, "ünïcode 日本語 text ▁ with a real U+2581"), (5, "  two  spaces\n\nand\tlines "), (6, "x"), (6, "x"), (None, "antidisestablishmentarianism 123456789"), (7, "é ﬁ   \x00 \x01"), (8, "aaaaaaaaaaaaaaaaaaaaaaaa" * 20), (9, " "), (10, "😀 emoji \U0001f469‍\U0001f4bb")]
    rows += [(20 + k, " ".join(RND.choice(["token", "align", "the", "Überraschung", "qzxv", "1,234.5"]) for _ in range(40))) for k in range(12)]
    for sizes in ((1 << 20, 5000), (60, 4)):
        monkeypatch.setattr(alignment, "TOKENS", sizes[0])
        monkeypatch.setattr(alignment, "DOCS", sizes[1])
        a, b = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
        got = alignment.align(frame(spark, rows), a, b)
        assert collections.Counter(map(tuple, got.collect())) == aligned_by_hand(rows)
    assert alignment.align(frame(spark, []), a, b).count() == 0
    assert [tuple(r)[1:8] for r in alignment.align(frame(spark, [(1, None)]), a, b).collect()] == [(0,) * 7]


def test_long_texts_get_the_same_ids(monkeypatch):
    import public_tokenizers

    v = alignment.byte_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b " * 50, " " * 3000, "wörd\n" * 99, "x" * 5000]
    short = list(v.encode(texts))
    monkeypatch.setattr(alignment, "LONG_TEXT", 0)
    assert list(v.encode(texts)) == short


# --- periodic runs ---------------------------------------------------------------------------------------------------
def runs_by_hand(w, shortest=12):
    n, best = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, 2 * q):
                best.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in best.items())


def test_runs_of_random_words():
    for _ in range(400):
        k = RND.choice([1, 2, 2, 3, 6])
        w = [RND.randrange(k) for _ in range(RND.randrange(70))]
        if RND.random() < 0.5:
            p = [RND.randrange(9) for _ in range(RND.randrange(1, 12))]
            w = w[:10] + (p * 9)[: RND.randrange(70)] + w[10:]
        for least in (12, 5, 2):
            assert periods.runs_of([w, [1, 2], [], w], least) == [runs_by_hand(w, least), [], [], runs_by_hand(w, least)]


def test_long_runs_end_soon():
    assert periods.runs_of([[b"a"] * 200_000]) == [[(0, 200_000, 1)]]
    w = [b"%d" % (i % 4001) for i in range(100_000)]
    assert periods.runs_of([[b"x", *w]]) == [[(1, 100_000, 4001)]]
    line = [b"%d" % (i % 10) if i % 10 else b"n%d" % RND.randrange(10**6) for i in range(100_000)]  # one line, each time between other words
    assert periods.runs_of([line]) == [[]]


def test_op13(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(periods, "CHUNK", 150)
    tenth = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c " * 9), (5, "a b c " * 9), (None, "x y " * 12), (7, " a b" * 8), (8, prose(2000)), (9, ("p q r s t u " * 3 + prose(20) + " ") * 3)]
    rows += [(i, prose(RND.randrange(1, 90), 40)) for i in tenth] + [(i, t) for i, t in zip(tenth[:3], (None, "", "solo"))]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    want = collections.Counter()
    for doc_id, text in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and w:
            n, g = len(w), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs = runs_by_hand(w)
        drop = {i for s, n, q in runs for i in range(s + q, s + n)}
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(x for i, x in enumerate(w) if i not in drop)
        best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
        want[doc_id, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()] += 1
    got = queries_text.op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert collections.Counter(map(tuple, got.collect())) == want
    assert periods.periodic_runs(frame(spark, [])).count() == 0
