"""Quality rules against plain counting and the same hashes in Python."""

import collections
import math
import re
import struct

import xxhash

from snapstats.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def word_hash(w):
    return signed(xxhash.xxh64(w.encode(), seed=42).intdigest())


def pair_hash(a, b):
    first = xxhash.xxh64(struct.pack("<q", a), seed=42).intdigest()
    return signed(xxhash.xxh64(struct.pack("<q", b), seed=first).intdigest())


def buckets(text):
    h = [word_hash(w) for w in WORD.findall(text or "")]
    return [x % qr.BUCKETS for x in h] + [pair_hash(a, b) % qr.BUCKETS for a, b in zip(h, h[1:])]


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    marked = set()
    times = collections.Counter(windows)
    for i, w in enumerate(windows):
        if times[w] > 1:
            marked.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(marked) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked), failed)


def expected(rows, trusted):
    raw, target = [qr.SMOOTHING] * qr.BUCKETS, [qr.SMOOTHING] * qr.BUCKETS
    for i, t in rows:
        for b in buckets(t):
            raw[b] += 1
            target[b] += i in trusted and i is not None
    r, t = sum(raw), sum(target)
    trained = t > qr.SMOOTHING * qr.BUCKETS
    out = []
    for i, text in rows:
        bs = buckets(text)
        score = (math.fsum(math.log(target[b] / t) - math.log(raw[b] / r) for b in bs) / len(bs) if trained else 0.0) if bs else None
        counts = base(text)
        out.append((i, *counts, score, not counts[-1] and score is not None and score >= qr.THRESHOLD))
    return out


def check(spark, rows, trusted, docs=None):
    docs = docs if docs is not None else spark.createDataFrame([r + (1, "x", 2.0) for r in rows], "doc_id bigint, text string, n_words int, bucket string, _h double")
    got = qr.quality_rules(docs, spark.createDataFrame([(t,) for t in trusted], "k bigint")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, repr(r[1:7]))
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(expected(rows, set(trusted)), key=key), strict=True):
        assert a[:7] == b[:7] and a[8] == b[8], (a, b)
        assert (a[7] is None) == (b[7] is None) and (a[7] is None or abs(a[7] - b[7]) < 1e-9), (a, b)


def test_edges(spark):
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(1, words), (2, None), (3, ""), (4, "a b c d e " * 8), (None, words + "\nline one\nline one\n \n\n"), (5, "é日 #*$%&|<> x\x1cy\x0bz " + words), (1, words),
            (6, "one"), (7, "same " * 12), (8, words + " " + words[:14]), (9, "\t\n ")]
    check(spark, rows, [1, 5, None, 1, 99])
    check(spark, rows, [])
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert qr.quality_rules(empty, empty.select("doc_id")).count() == 0
    docs = spark.createDataFrame([r + (1,) for r in rows], "doc_id bigint, text string, kept int")
    left = qr.quality_filter(docs, docs.where("doc_id = 1").select("doc_id"))
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} <= {1, None, 5, 8}


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    trusted = [r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").collect()]
    check(spark, [(r.doc_id, r.text) for r in docs.collect()], trusted, docs)


def test_plan_is_native(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("documents", "labels"))
    plan = qr.op3_quality_rules(docs, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
