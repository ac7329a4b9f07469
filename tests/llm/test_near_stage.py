"""The near-duplicate stage links pairs from a similarity of 0.80 on."""

import corpus_pipeline as cp
import test_minhash


def pair(words, changed):
    """A text and a copy whose last `changed` words differ."""
    base = [f"w{i}" for i in range(words)]
    return " ".join(base), " ".join(base[:words - changed] + [f"x{i}" for i in range(changed)])


def test_stage_takes_pairs_between_80_and_85(spark):
    rows, similarity = [], []
    for k, changed in enumerate((9, 10, 11, 12)):
        texts = [f"{t} g{k}" for t in pair(100, changed)]
        texts = [" ".join(f"p{k}{w}" for w in t.split()) for t in texts]
        a, b = map(test_minhash.shingles, texts)
        similarity.append(len(a & b) / len(a | b))
        rows += [(2 * k, texts[0], "en", "s", 0), (2 * k + 1, texts[1], "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r.doc_id for r in cp.near_duplicates(spark, docs, "").collect()}
    near = [s >= 0.80 for s in similarity]
    assert any(0.80 <= s < 0.85 for s in similarity) and not all(near)
    assert kept == {2 * k for k in range(4)} | {2 * k + 1 for k in range(4) if not near[k]}
