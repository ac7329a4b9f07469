"""Substring dedup against a scan of all windows."""

import hashlib
import random
import re

from snapstats.llm import substring_dedup as sd


def brute(rows, size):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for a in range(len(w) - size + 1):
            k = tuple(w[a:a + size])
            if i is not None:
                first[k] = min(i, first.get(k, i))
    out = []
    for i, w in words:
        mask = [False] * len(w)
        for a in range(len(w) - size + 1):
            if i is not None and first[tuple(w[a:a + size])] < i:
                mask[a:a + size] = [True] * size
        kept = " ".join(x for x, m in zip(w, mask) if not m)
        out.append((i if i is not None else -1, len(w), sum(mask), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def got(spark, rows, size, schema="doc_id bigint, text string"):
    df = sd.substring_dedup(spark.createDataFrame(rows, schema), window=size).drop("kept")
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, df.collect()))


def test_random_texts(spark):
    rng = random.Random(4)
    for size in (7, 8, 50):
        parts = [[rng.choice("abcdefg") + str(rng.randrange(30)) for _ in range(rng.randint(3, 2 * size))] for _ in range(6)]
        rows = []
        for i in range(60):
            words = []
            for _ in range(rng.randint(0, 5)):
                p = rng.choice(parts)
                a = rng.randrange(len(p))
                words += p[a:] if rng.random() < .5 else [str(rng.random()) for _ in range(rng.randint(1, 9))] + p
            rows.append((i * 37 % 101, rng.choice([" ", "\n", "  "]).join(words)))
        assert got(spark, rows, size) == brute(rows, size)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(120))
    rows = [(5, long), (3, long), (3, long), (5, "x " + long), (None, long), (7, None), (8, ""), (9, "é日 " + long + " z"), (9, long), (1, " ".join(["r"] * 300)),
            (2, " ".join(["r"] * 70))]
    extra = [r + (1, "x", 2, None) for r in rows]
    assert got(spark, extra, 50, "doc_id bigint, text string, _id int, kept string, n_words int, h int") == brute(rows, 50)
    assert got(spark, [], 50) == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], sd.WINDOW)
    assert sorted(map(tuple, sd.op4_substring_dedup(docs).collect())) == want and any(r[2] for r in want)
