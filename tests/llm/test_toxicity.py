"""The toxicity classifier: n-grams and scores against a plain version, held-out quality, and odd rows."""

import zlib

import numpy as np

from snapstats.llm import nbsvm
from snapstats.llm import toxicity as tox

MASK = (1 << 64) - 1


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def plain_buckets(text):
    """Buckets of all n-grams of one text, character by character."""
    chars = [" " if c.lower().isspace() else c.lower() if len(c.lower()) == 1 and ord(c) < 0x10000 else c for c in text or ""]
    found = set()
    for size in tox.SIZES:
        for k in range(len(chars) - size + 1):
            code = mixed(ord(chars[k]) + 0x2545F491)
            for c in chars[k + 1:k + size]:
                code = code * 0x9E3779B97F4A7C15 + mixed(ord(c) + 0x2545F491) & MASK
                code ^= code >> 32
            found.add((code * 0xBF58476D1CE4E5B9 & MASK) >> 64 - (tox.BUCKETS.bit_length() - 1))
    return sorted(found)


TEXTS = ["You IDIOT, you\tidiot!", "", "ab", "abc", "Ünïcode Straße İ 日本語 😀😀😀 x", "a b c d", "the same", "the same"]


def test_ngrams():
    raw = [t.encode() for t in TEXTS * 20]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    got = [[] for _ in raw]
    for first, doc, bucket in tox.ngrams(np.frombuffer(b"".join(raw), np.uint8), offsets):
        for d, b in zip(doc.tolist(), bucket.tolist()):
            got[first + d].append(b)
    assert got == [plain_buckets(t) for t in TEXTS * 20]


def sample_rows(n=400):
    rng = np.random.default_rng(3)
    clean = ["river", "morning", "letters", "garden", "idiom", "walking", "clouds", "theory", "moraine"]
    insults = ["idiot", "moron", "idiots", "moronic"]
    rows = []
    for i in range(n):
        words = list(rng.choice(clean, 15))
        if i % 5 == 0:
            words[rng.integers(15)] = str(rng.choice(insults))
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    return rows


def test_scores_against_plain_version(spark):
    """Counts, ratios, fit and score from plain sets; only the solver and the curve are shared (tested on their own)."""
    rows = sample_rows()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    got = {r.doc_id: r for r in tox.op13_toxicity(docs, labels).collect()}
    taught = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    sets = {i: np.array(plain_buckets(t), np.int64) for i, t, _ in rows}
    counts = np.ones((2, tox.BUCKETS))
    for i, _, y in taught:
        counts[y, sets[i]] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    marks = {r.doc_id: r.m for r in docs.select("doc_id", tox.F.xxhash64("doc_id", tox.F.lit(13)).alias("m")).collect()}
    taught.sort(key=lambda r: marks[r[0]])
    fitted = [r for r in taught if marks[r[0]] % 4]
    rest = [r for r in taught if not marks[r[0]] % 4]
    w, bias = nbsvm.dual_coordinate_descent([sets[i] for i, _, _ in fitted], np.array([y for _, _, y in fitted]), ratios, cost=tox.COST)
    margin = {i: float((w[s] * ratios[s]).sum() + bias) for i, s in sets.items()}
    y = np.array([y for _, _, y in rest])
    slope, offset = nbsvm.calibrate(np.array([margin[i] for i, _, _ in rest]), y)
    share = (sum(y for _, _, y in taught) + 1) / (len(taught) + 2)
    offset += np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
    for i, _, y in rows:
        want = 1 / (1 + np.exp(-(slope * margin[i] + offset)))
        assert abs(got[i].score - want) < 1e-6 and got[i].predicted == int(got[i].score >= 0.5), i
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    held = [(r[2], got[r[0]].predicted) for r in rows if got[r[0]].held_out]
    assert np.mean([a == b for a, b in held]) > 0.95


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    got = tox.op13_toxicity(docs, labels)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = got.join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    toxic, clean = ([r.score for r in rows if r.held_out and r.toxic == k] for k in (1, 0))
    auc = np.mean([[1.0 if a > b else 0.5 if a == b else 0.0 for b in clean] for a in toxic])
    assert auc > 0.98 and np.mean([s >= 0.5 for s in toxic]) > 0.7 and np.mean([s < 0.5 for s in clean]) > 0.99


def test_odd_rows(spark):
    rows = [(i, t, "x", 1) for i, t, _ in sample_rows(100)] + [(None, "you idiot", "x", 1), (200, None, "x", 1), (201, "", "x", 1), (202, "ab", "x", 1), (3, "again", "x", 1),
                                                              (203, "idiot " * 200_000, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _label string, score int")
    labels = spark.createDataFrame([(i, 0, y) for i, _, y in sample_rows(100)] + [(None, 0, 1), (6, 0, None), (6, 0, 0), (777, 0, 1)], "doc_id bigint, quality int, toxic int")
    got = tox.op13_toxicity(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[200] == by[201] == by[202] < by[203]
    for part in (labels.limit(0), labels.where("toxic = 1"), labels.where("toxic = 0")):
        scores = {r.score for r in tox.op13_toxicity(docs, part).collect()}
        assert len(scores) == 1 and 0 < scores.pop() < 1
    assert tox.op13_toxicity(docs.limit(0), labels).count() == 0
