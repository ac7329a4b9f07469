"""The pipeline against plain Python over the same table, stage by stage."""

import collections
import hashlib

import corpus_pipeline as cp
import test_decontaminate
import test_minhash
import test_quality_rules

from snapstats.llm import bpe, line_dedup

FOLDER = "/root/testdata/sf0.001"


def test_run(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    trusted = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
    verdict = test_quality_rules.expected([(d["doc_id"], d["text"]) for d in docs], trusted)
    docs = [d for d, v in zip(docs, verdict) if v[-1]]
    pages, totals = collections.Counter(), collections.Counter(d["source"] for d in docs)
    for d in docs:
        pages.update((d["source"], x) for x in set(d["text"].split("\n")) if test_quality_rules.WORD.search(x))
    bad = {k for k, n in pages.items() if n >= line_dedup.MIN_PAGES and n * 100 > totals[k[0]] * line_dedup.BOILERPLATE_PERCENT}
    for d in docs:
        d["text"] = "\n".join(x for x in d["text"].split("\n") if (d["source"], x) not in bad)
    kept = {g[0] for g in test_minhash.brute([(d["doc_id"], d["text"]) for d in docs], cp.NEAR_PERCENT) if g[3]}
    docs = [d for d in docs if d["doc_id"] in kept]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    texts = [(d["doc_id"], d["text"]) for d in docs]
    leaked = set()
    for i, t in texts:
        w = test_decontaminate.words(t)
        grams = {tuple(w[a:a + 4]) for a in range(len(w) - 3)}
        for k, x in items:
            q = test_decontaminate.words(x)
            # A match shares a run of four words with its item; the distance is worked out around that run only.
            if i in leaked or not any(tuple(q[a:a + 4]) in grams for a in range(len(q) - 3)):
                continue
            shared = {tuple(q[a:a + 4]) for a in range(len(q) - 3)}
            at = [a for a in range(len(w) - 3) if tuple(w[a:a + 4]) in shared]
            if any(test_decontaminate.brute([(i, " ".join(w[max(0, a - 80):a + 80]))], [(k, x)]) for a in at):
                leaked.add(i)
    enc = bpe.encoding(tuple(bpe.read_ranks()))
    want = sorted((d["doc_id"], enc.encode_ordinary(d["text"]), hashlib.sha256(d["text"].encode()).hexdigest()) for d in docs if d["doc_id"] not in leaked)
    got = sorted((r.doc_id, list(r.ids), r.decoded_sha256) for r in cp.run(spark, FOLDER).collect())
    assert got == want and len(got) > 50


def test_stages_on_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, "en", "s", 5), (1, text, "en", "s", 5), (2, text.upper(), "en", "s", 5), (None, text, None, None, None), (3, None, "en", "s", 0), (4, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        if name == "minhash":
            assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 1, 3, 4]
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    assert cp.STAGES[-1][1](spark, docs, FOLDER).count() == len(rows)
