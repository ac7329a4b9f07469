"""Global word encoding against the library's own, text by text, and the round trip."""

import hashlib
import random

import pytest

from snapstats.llm import bpe


def want(rows):
    enc = bpe.encoding(tuple(bpe.read_ranks()))
    return sorted((-1 if i is None else i, enc.encode_ordinary(t or "")) for i, t in rows)


ROWS = [(1, "Hello world, hello  worlds!\n\n It's we're I'LL 'street"), (2, None), (3, ""), (None, "é 日本 😀 \x1c a\x85b <|endoftext|>"), (1, "x"), (1, "x"),
        (4, "word " * 2000), (5, " "), (6, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa 1234567 \t\t x")]


@pytest.mark.parametrize("most", [0, 3, 1 << 20])
def test_ids(spark, most):
    df = spark.createDataFrame([r + (1, "x") for r in ROWS], "doc_id bigint, text string, _id int, ids string")
    got = bpe.encode(df, most_hot=most)
    assert sorted((-1 if r.doc_id is None else r.doc_id, list(r.ids)) for r in got.collect()) == want(ROWS)
    back = sorted((-1 if r.doc_id is None else r.doc_id, bytes(r.decoded)) for r in bpe.decode(got).collect())
    assert back == sorted((-1 if i is None else i, (t or "").encode()) for i, t in ROWS)


def test_random_texts(spark):
    rng = random.Random(1)
    parts = list("ab1 2\n\t'.,!é日٣½ _") + ["'s", "'re", "the", " the", "tion", "  ", "\x1c", "😀"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))) for i in range(800)]
    got = bpe.encode(spark.createDataFrame(rows, "doc_id bigint, text string"), most_hot=50)
    assert sorted((r.doc_id, list(r.ids)) for r in got.collect()) == want(rows)
    assert bpe.encode(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    texts = dict(rows)
    expected = [(i, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((texts[i] or "").encode()).hexdigest())
                for i, x in want(rows)]
    assert sorted(map(tuple, bpe.op7_bpe(docs).collect())) == expected
