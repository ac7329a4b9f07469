"""Runs against the definition, the digests against SQL, and odd rows."""

import hashlib
import random
import re
import zlib

import check_queries
import numpy as np
import pytest

from snapstats.llm import periodic_runs as pr
from snapstats.llm import queries


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(w, shortest=12):
    """Runs by trying every period; a period is the smallest if no smaller one fits the stretch."""
    out = set()
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(shortest, 2 * q) and j > i:
                x = w[i:j + q]
                if not any(all(a == b for a, b in zip(x, x[r:])) for r in range(1, q)):
                    out.add((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def random_words(rng):
    w = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(0, 50))]
    if rng.random() < .6:
        period = [rng.randrange(3) for _ in range(rng.randint(1, 14))]
        w = w[:rng.randint(0, 6)] + (period * 12)[:rng.randint(10, 50)] + w[6:]
    return w


@pytest.mark.parametrize("shortest", [2, 5, 12])
def test_runs(shortest):
    rng = random.Random(shortest)
    for _ in range(600):
        w = random_words(rng)
        want = brute(w, shortest)
        assert pr.runs_of(w, shortest) == sorted(want)
        inside = [(s + a, n, q) for a, b in pr.stretches(np.array(w, np.int64), np.array([0, len(w)]), shortest) for s, n, q in pr.runs_of(w[a:b], shortest)]
        assert sorted(inside) == sorted(want)


def test_stretches_end_with_their_text():
    codes = np.array([1, 2, 3, 4, 5, 6] * 4)
    assert pr.stretches(codes, np.array([0, 12, 24])) == [(0, 12), (12, 24)]
    assert pr.stretches(codes, np.array([0, 6, 12, 18, 24])) == []


def test_rows(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{x}" for x in random_words(rng)), 1, "x", 2) for i in range(200)]
    rows += [(900, None, 1, "x", 2), (901, "", 1, "x", 2), (902, " \t\n\x0b\x0c\r", 1, "x", 2), (None, "ab " * 20, 1, "x", 2), (5, rows[5][1], 1, "x", 2),
             (903, "a b c d " * 9, 1, "x", 2), (904, "Æ\x1cé " * 13, 1, "x", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words int, runs string, _doc int")
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in pr.periodic_runs(docs).collect()), key=repr)
    want = sorted(((i is not None, i or 0, len(words(t)), brute(words(t)), collapsed(words(t), brute(words(t)))) for i, t, *_ in rows), key=repr)
    assert got == want and sum(len(g[3]) for g in got) > 80
    assert pr.periodic_runs(docs.limit(0)).count() == 0


def test_query_on_odd_rows(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("abcdefghij") for _ in range(rng.randint(0, 90)))) for i in range(300)] + [(None, "x " * 30), (-7, None), (11, None), (3, "")]
    got = pr.op11_periodic_runs(spark.createDataFrame([r + (0,) for r in rows], "doc_id bigint, text string, _h int"))
    want, planted = [], 0
    for i, t in rows:
        w = words(t)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            planted += 1
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k if k < a else a + (k - a) % p] for k in range(n)]
        runs = brute(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), collapsed(w, runs))]
        want.append((i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr) and planted > 10
    assert got.dtypes == [("doc_id", "bigint"), ("n_runs", "bigint"), ("start", "bigint"), ("length", "bigint"), ("period", "bigint"),
                          ("exponent_milli", "bigint"), ("runs_sha256", "string"), ("collapsed_sha256", "string")]


def test_long_texts(spark):
    """Texts of a megabyte and more: one word over and over, a long period, and nothing repeated."""
    spam, period, plain = "spam " * 250_000, " ".join(f"p{i}" for i in range(60_000)), " ".join(f"u{i}" for i in range(200_000))
    rows = [(1, spam), (2, f"{period} {period} {period} p0 p1 end"), (3, plain)]
    got = {r.doc_id: r for r in pr.periodic_runs(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 250_000, 1)] and got[1].collapsed == "spam"
    assert [tuple(x) for x in got[2].runs] == [(0, 180_002, 60_000)] and got[2].collapsed == f"{period} end"
    assert got[3].runs == [] and got[3].collapsed == plain


def test_whole_table_against_sql(spark):
    result = check_queries.compare(spark, "/root/testdata/sf0.001", "op11", queries.queries()["op11_periodic_runs"], pr.oracle())
    assert result.startswith("ok") and "differ" not in result, result
