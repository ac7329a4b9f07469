"""Edit-aware counts against encoding the edited text anew."""

import random

from pyspark.sql import functions as F

from snapstats.llm import bpe, token_counts as tc

PARTS = list("ab1 2\n\t'.,!é日٣½ _") + ["'s", "'re", "the", " the", "tion", "  ", "\n\n", "\x1c", "😀", "it's", " word" * 30]


def edited(text, edits):
    text = text or ""
    for e in edits or ():
        if e is None or e[0] is None:
            continue
        at = min(max(e[0], 0), len(text))
        text = text[:at] + (e[2] or "") + text[min(at + max(e[1] or 0, 0), len(text)):]
    return text


def test_random_edits(spark):
    rng = random.Random(9)
    make = lambda n: "".join(rng.choice(PARTS) for _ in range(rng.randint(0, n)))
    rows = []
    for i in range(500):
        text = make(rng.choice([5, 40, 300]))
        edits = [(rng.randint(-3, len(text) + 5), rng.choice([0, 0, 1, 2, 5, 50, 4000]), rng.choice(["", " ", "'", "\n", make(6)])) for _ in range(rng.randint(0, 6))]
        rows.append((i, text, edits))
    rows += [(1000, None, [(0, 1, "new text")]), (1001, "", None), (None, "keep it", [(None, 1, "x"), None, (2, None, None)]), (1000, None, [(5, 1, None)])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, e array<struct<at:int,cut:int,put:string>>").withColumn("n_tokens", F.lit(1)).withColumn("_doc", F.lit("x"))
    got = tc.edited_counts(df, F.col("e"), keep_trees=True).collect()
    enc = bpe.encoding(tuple(bpe.read_ranks()))
    key = lambda r: (-1 if r[0] is None else r[0], r[2])
    want = sorted(((i, len(enc.encode_ordinary(t or "")), len(enc.encode_ordinary(edited(t, e))), edited(t, e)) for i, t, e in rows), key=lambda r: (-1 if r[0] is None else r[0], r[3]))
    have = sorted(((r.doc_id, r.n_before, r.n_tokens, r.text) for r in got), key=lambda r: (-1 if r[0] is None else r[0], r[3]))
    assert have == want, key
    for r in got:
        assert [len(w) for w in tc.SPLIT.findall(r.text)] == list(r.lengths) and sum(r.counts) == r.n_tokens and len(r.counts) == r.n_pretokens


def test_only_the_touched_part_is_encoded(spark):
    text = "some words of a long text " * 4000
    row = tc.edited_counts(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), F.array(F.struct(F.lit(50000).alias("at"), F.lit(3).alias("cut"), F.lit("xy").alias("put")))).first()
    assert row.n_encoded < 12 and row.n_pretokens > 20000


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    enc = bpe.encoding(tuple(bpe.read_ranks()))
    want = {}
    for r in docs.collect():
        n = len(r.text)
        new = edited(r.text, [(n // 2, 0, f"\nSource: {r.source}\n"), (n // 4, 40, ""), (0, 0, f"{r.lang}: ")])
        want[r.doc_id] = (len(enc.encode_ordinary(r.text)), len(enc.encode_ordinary(new)))
    assert {r.doc_id: (r.n_before, r.n_tokens) for r in tc.op5_token_counts(docs).collect()} == want
    empty = tc.op5_token_counts(docs.limit(0))
    assert empty.count() == 0


def test_later_edits_use_the_kept_trees(spark):
    rng = random.Random(19)
    make = lambda n: "".join(rng.choice(PARTS) for _ in range(rng.randint(0, n)))
    edits = lambda n: [(rng.randint(-3, n + 5), rng.choice([0, 1, 5, 50]), rng.choice(["", " ", make(6)])) for _ in range(rng.randint(0, 4))]
    rows = [(i, make(rng.choice([5, 300])), edits(900), edits(900)) for i in range(200)]
    rows += [(None, None, None, None), (500, "", None, [(0, 0, "put")]), (501, "whole", [None], None), (501, "whole", [None], None)]
    kind = "array<struct<at:int,cut:int,put:string>>"
    df = spark.createDataFrame(rows, f"doc_id bigint, text string, e {kind}, f {kind}").withColumn("lengths", F.lit("x")).withColumn("carried", F.lit(1))
    kept = tc.edited_counts(df, F.col("e"), keep_trees=True, carry=F.struct("f", F.lit(None).cast("int").alias("nothing")))
    twice = tc.apply_edits(kept, F.col("carried.f"), keep_trees=True, carry=F.col("carried.nothing")).collect()
    enc = bpe.encoding(tuple(bpe.read_ranks()))
    order = lambda r: (-1 if r[0] is None else r[0], r[-1])
    want = [(i, len(enc.encode_ordinary(edited(t, e))), len(enc.encode_ordinary(edited(edited(t, e), f))), edited(edited(t, e), f)) for i, t, e, f in rows]
    assert sorted(((r.doc_id, r.n_before, r.n_tokens, r.text) for r in twice), key=order) == sorted(want, key=order)
    for r in twice:
        assert [len(w) for w in tc.SPLIT.findall(r.text)] == list(r.lengths) and sum(r.counts) == r.n_tokens
    still = tc.apply_edits(kept.where("doc_id IS NOT NULL"), F.lit(None)).agg(F.sum("n_encoded"), F.count("*")).first()
    assert tuple(still) == (0, len(rows) - 1)
    assert tc.apply_edits(kept.limit(0), F.col("carried.f")).count() == 0


def test_kept_tree_of_a_long_text(spark):
    text = "some words of a long text " * 60000
    edit = lambda at: F.array(F.struct(F.lit(at).alias("at"), F.lit(3).alias("cut"), F.lit("xy").alias("put")))
    kept = tc.edited_counts(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), edit(50000), keep_trees=True)
    row = tc.apply_edits(kept, edit(900000)).first()
    new = edited(edited(text, [(50000, 3, "xy")]), [(900000, 3, "xy")])
    assert row.n_encoded < 12 and row.n_tokens == len(bpe.encoding(tuple(bpe.read_ranks())).encode_ordinary(new))


def test_rows_without_a_fitting_tree_are_encoded_whole(spark):
    rows = [(1, "a few words", None, None), (2, "a few words", [1], [1]), (3, "a few words", [1, 4, 6], [1, 1, None]), (4, None, None, [1]), (5, "ab", [2], [1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lengths array<int>, counts array<int>")
    got = {r.doc_id: (r.n_before, r.n_tokens, r.n_encoded) for r in tc.apply_edits(df, F.lit(None)).collect()}
    assert got == {1: (3, 3, 3), 2: (3, 3, 3), 3: (3, 3, 3), 4: (0, 0, 0), 5: (1, 1, 0)}
