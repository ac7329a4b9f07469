"""Near-duplicate components against all pairs."""

import random
import re

import numpy as np

from snapstats.llm import minhash
from snapstats.llm.components import components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    return sorted((i if i is not None else -1, len(s), find(i) if i is not None else None, i is None or find(i) == i) for i, s in sets)


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_shingles int, a int, key string, root int, c int, _id int") if rows and len(rows[0]) > 2 \
        else spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [tuple(r) for r in minhash.near_duplicates(df).collect()]
    assert sorted((-1 if g[0] is None else g[0], *g[1:]) for g in got) == brute([r[:2] for r in rows])


def test_groups_of_edited_copies(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, k = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(6, 160))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((k * 7 % 1009, " ".join(copy)))
            k += 1
    check(spark, rows)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(120))
    other = " ".join(f"v{i}" for i in range(120))
    check(spark, [r + (1, 2, "x", 3, 4, 5) for r in [
        (5, long), (3, long.upper()), (9, other), (3, other), (7, None), (8, ""), (8, " \n\t"), (None, long), (11, "a b"), (12, "A  B"),
        (13, "a b c"), (14, "same"), (14, "same"), (20, long + " tail")]])
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted(tuple(r) for r in minhash.op6_minhash(docs).collect())
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got == want and any(not r[3] for r in got)


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(7)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(90):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(copy)))
    check(spark, rows)


def test_products_count_like_sets():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(5, 50)).astype(np.uint64)) for _ in range(40)]
    roots = rng.integers(0, 30, 40)
    for left, right in ((np.arange(0, 20), np.arange(20, 40)), (np.arange(40),) * 2):
        want = {(i, j) for x, i in enumerate(left) for y, j in enumerate(right) if roots[i] != roots[j] and (left is not right or x < y)
                and 100 * len(np.intersect1d(sets[i], sets[j])) >= 40 * len(np.union1d(sets[i], sets[j]))}
        assert set(minhash.similar(sets, roots, left, right, 40)) == want and want


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100 + i, 100) for i in range(50)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(30)]
    root = {n: n for e in edges for n in e}
    for _ in range(300):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()) == {n: r for n, r in root.items() if n in linked}


def test_stars_settle_in_one_step(spark, tmp_path):
    """A graph that is a star already takes one aggregation; links that add nothing start no new round."""
    edges = spark.createDataFrame([(n, 1) for n in range(2, 50)] + [(n, 100) for n in range(101, 120)], "a bigint, b bigint")
    tracker, names = spark.sparkContext.statusTracker(), []
    spark.sparkContext.setJobGroup("stars", "stars")
    try:
        roots = components(edges)
        names = tracker.getJobIdsForGroup("stars")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert len(names) <= 8
    assert minhash._merged(roots, edges.limit(0)) is roots
    assert dict(roots.collect()) == {n: 1 if n < 50 else 100 for n in [*range(1, 50), *range(100, 120)]}
    joined = minhash._merged(roots, spark.createDataFrame([(119, 3)], "a bigint, b bigint"))
    assert set(dict(joined.collect()).values()) == {1}
