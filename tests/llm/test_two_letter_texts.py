"""Texts of two letters in Thue-Morse order, which sums modulo a power of two cannot tell apart, in every operator that compares by hash."""

import hashlib

import numpy as np
import pytest
from test_suffix_dedup import brute as suffix_brute

from snapstats.llm import bpe, decontaminate, minhash, scan, substring_dedup, suffix_dedup

ORDER = np.array([bin(i).count("1") & 1 for i in range(4096)])
SIZES = (1024, 2048, 4096)


def two(n, letters="ab"):
    """The first n places of the order over two letters, and their complement."""
    text = "".join(letters[k] for k in ORDER[:n])
    return text, text.translate(str.maketrans(letters, letters[::-1]))


def table(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts, 1)), "doc_id bigint, text string")


@pytest.mark.parametrize("lane", [0, 1])
def test_hash_is_a_polynomial_modulo_a_prime(lane):
    rng = np.random.default_rng(8)
    base = scan.BASES[lane]
    values = rng.integers(0, scan.PRIME, 70, dtype=np.uint64)
    a, b = values[:35] + np.uint64(scan.PRIME), values[35:]
    assert scan.multiply(a, b).tolist() == [int(x) * int(y) % scan.PRIME for x, y in zip(a, b)]
    for small in (False, True):
        own = values >> np.uint64(32) if small else values
        sums = scan.running(own, small, lane)
        for s, e in ((0, 70), (3, 3), (5, 41)):
            want = sum(int(v) * pow(base, k, scan.PRIME) for k, v in enumerate(own[s:e])) % scan.PRIME
            assert scan.spans_hash(sums, np.array([s]), np.array([e]), lane)[0] == scan.mix(np.array([want], np.uint64))[0]


@pytest.mark.parametrize("n", SIZES)
def test_words_differ(n):
    one, other = two(n)
    words = scan.Words(np.frombuffer(f"{one} {other}".encode(), np.uint8), np.array([0, 2 * n + 1]))
    assert len(set(words.hash.tolist())) == 2
    letters = scan.Words(np.frombuffer(" ".join(one + other).encode(), np.uint8), np.array([0, 4 * n - 1]))
    at, hashes = letters.windows(n)
    assert hashes[0] != hashes[n]


def test_op2_suffix_dedup(spark):
    texts = [t for n in SIZES for t in two(n)]
    got = sorted(tuple(r)[:5] for r in suffix_dedup.op2_suffix_dedup(table(spark, *texts)).collect())
    assert got == sorted(suffix_brute(list(enumerate(texts, 1)), 400))
    one, other = two(512)
    fresh = [f"{one}{'x' * 300}", f"{'y' * 300}{other}"]
    got = suffix_dedup.op2_suffix_dedup(table(spark, *fresh)).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(suffix_brute(list(enumerate(fresh, 1)), 400))


def test_op4_substring_dedup(spark):
    for n in SIZES:
        one, other = two(n)
        same = " ".join(f"w{i}" for i in range(49))
        got = {r.doc_id: r.n_removed for r in substring_dedup.op4_substring_dedup(table(spark, f"{same} {one}", f"{same} {other}", f"{same} {one}")).collect()}
        assert got == {1: 0, 2: 0, 3: 50}


def test_op6_minhash(spark):
    texts = [t for n in SIZES for t in two(n)]
    got = sorted(tuple(r) for r in minhash.op6_minhash(table(spark, *texts, texts[0])).collect())
    assert got == [(i, 1, i, True) for i in range(1, 7)] + [(7, 1, 1, False)]


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_op7_bpe(spark, most):
    texts = [t for n in SIZES for t in two(n)] + [f"x {two(1024)[1]} y {two(1024)[0]}"]
    enc = bpe.encoding(tuple(bpe.read_ranks()))
    got = {r.doc_id: r for r in bpe.round_trip(table(spark, *texts), most_hot=most, keep_ids=True).collect()}
    for i, t in enumerate(texts, 1):
        assert list(got[i].ids) == enc.encode_ordinary(t) and got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_op9_decontaminate(spark):
    one, other = two(1024)
    item = " ".join(f"q{i}" for i in range(4)) + f" {one} " + " ".join(f"r{i}" for i in range(3))
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    docs = table(spark, f"before {item} after", f"before {item.replace(one, other)} after")
    assert [(r.doc_id, r.item_id, r.distance) for r in decontaminate.op9_decontaminate(docs, items).collect()] == [(1, 1, 0)]
