"""Repeated byte strings against a table of all windows."""

import collections
import hashlib
import random

from snapstats.llm import suffix_dedup as sd


def brute(rows, size):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(t[a:a + size] for _, t in texts for a in range(len(t) - size + 1))
    out = []
    for i, t in texts:
        mask = [False] * len(t)
        for a in range(len(t) - size + 1):
            if seen[t[a:a + size]] > 1:
                mask[a:a + size] = [True] * size
        kept = bytes(b for b, m in zip(t, mask) if not m)
        runs = sum(m and not (k and mask[k - 1]) for k, m in enumerate(mask))
        out.append((-1 if i is None else i, len(t), sum(mask), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(spark, rows, size, schema="doc_id bigint, text string"):
    df = sd.suffix_dedup(spark.createDataFrame(rows, schema), threshold=size).drop("kept")
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, df.collect()))


def test_random_texts(spark):
    rng = random.Random(8)
    for size, letters in ((5, "ab"), (12, "abc"), (30, "abcdefé"), (100, "abcdefghij")):
        parts = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 3 * size))) for _ in range(5)] + ["a" * (2 * size)]
        rows = []
        for i in range(50):
            made = ""
            for _ in range(rng.randint(0, 4)):
                p = rng.choice(parts)
                a = rng.randrange(len(p))
                made += rng.choice([p, p[a:], p[:a], "".join(rng.choice(letters) for _ in range(rng.randint(0, size)))])
            rows.append((i, made))
        assert got(spark, rows, size) == brute(rows, size)


def test_edges(spark):
    long = "".join(str(i) for i in range(600))
    rows = [(1, long), (1, long), (2, None), (3, ""), (None, "日" + long[:500]), (4, "x" * 399), (5, "x" * 399), (6, "y" * 900), (7, "z" + long[100:900] + "é")]
    extra = [r + ("a", 1, 2, None) for r in rows]
    assert got(spark, extra, 400, "doc_id bigint, text string, _id string, c int, kept int, n_bytes int") == brute(rows, 400)
    assert got(spark, [], 400) == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], sd.THRESHOLD)
    assert sorted(map(tuple, sd.op2_suffix_dedup(docs).collect())) == want and any(r[2] for r in want)
