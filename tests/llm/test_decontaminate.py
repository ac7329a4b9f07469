"""Benchmark leaks against the edit distance of every item to every text."""

import random
import re

import numpy as np

from snapstats.llm import decontaminate as dc
from snapstats.llm import scan


def words(text):
    return re.findall(r"[A-Za-z0-9\x80-\U0010FFFF]+", (text or "").lower())


def distance(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def brute(rows, items):
    found = set()
    for i, t in rows:
        w = words(t)
        for k, x in items:
            q = words(x)
            if len(q) >= dc.GRAM and w:
                d = distance(q, w)
                if d <= dc.tolerance(len(q)):
                    found.add((i, k, d))
    return found


def edited(rng, item, edits, vocabulary):
    item = list(item)
    for _ in range(edits):
        a = rng.randrange(len(item))
        kind = rng.randrange(3)
        if kind == 0:
            item[a] = rng.choice(vocabulary)
        elif kind == 1:
            item.insert(a, rng.choice(vocabulary))
        else:
            del item[a]
    return item


def test_recall_of_edited_items():
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randint(14, 60))] for _ in range(150)]
    texts, want = [], set()
    for k, item in enumerate(items):
        for _ in range(4):
            leak = edited(rng, item, rng.randint(0, dc.tolerance(len(item))), vocabulary)
            around = [[rng.choice(vocabulary) for _ in range(rng.randint(0, 80))] for _ in range(2)]
            texts.append(" ".join(around[0] + leak + around[1]))
            want.add((len(texts) - 1, k))
    data = [t.encode() for t in texts]
    w = scan.Words(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]), True, scan.ALPHANUMERIC)
    got = {(d, k) for d, k, *_ in dc.Items(list(range(len(items))), [" ".join(i) for i in items]).matches(w)}
    assert len(got & want) / len(want) >= dc.TARGET_RECALL and not got - want


def test_rows(spark):
    item = "The quick brown fox, jumps over the lazy dog and runs far away home."
    changed = item.replace("lazy", "sleepy")
    rows = [(1, "é日 before. " + item.upper() + " after"), (2, changed), (3, None), (4, ""), (None, "x " + item), (1, "clean text of many words here that holds nothing"),
            (5, "the quick brown fox jumps"), (6, "one two three four"), (7, item), (7, item)]
    items = [(10, item), (11, None), (12, ""), (13, "two words"), (14, "one two three four"), (15, item), (None, item)]
    docs = spark.createDataFrame([r + (1, "x", 2) for r in rows], "doc_id bigint, text string, item_id int, start string, _bad_id int")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = dc.op9_decontaminate(docs, bench).collect()
    assert {(r.doc_id, r.item_id, r.distance) for r in got} == brute(rows, [i for i in items if i[0] is not None])
    place = next(r for r in got if r.doc_id == 1 and r.item_id == 10)
    assert rows[0][1][place.start:place.end] == item.upper().rstrip(".")
    many = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, bench, block=2).collect()}
    assert many == {(r.doc_id, r.item_id) for r in got}
    left = dc.decontaminate(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 3, 4, 5]
    assert dc.op9_decontaminate(docs.limit(0), bench).count() == 0 and dc.op9_decontaminate(docs, bench.limit(0)).count() == 0


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs, bench = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "benchmark"))
    items = [(r.item_id, r.text) for r in bench.collect()]
    grams = {tuple(words(t)[a:a + dc.GRAM]) for _, t in items for a in range(len(words(t)) - dc.GRAM + 1)}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # A match shares a run of GRAM words with an item, so other texts need no distance.
    rows = [(i, t) for i, t in rows if any(tuple(words(t)[a:a + dc.GRAM]) in grams for a in range(len(words(t)) - dc.GRAM + 1)) and len(words(t)) < 1500]
    known = {i for i, _ in rows}
    got = {(r.doc_id, r.item_id, r.distance) for r in dc.op9_decontaminate(docs, bench).collect() if r.doc_id in known}
    assert got == brute(rows, items) and got
