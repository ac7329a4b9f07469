"""Cuts, forms and the way back, against plain Python and SQL."""

import hashlib
import random
import re

import check_queries
import numpy as np
import pytest

from snapstats.llm import fill_in_middle as fm
from snapstats.llm import queries


def brute(i, text, epoch=1, unit="token", moved=90, spm=20):
    text = text or ""
    parts = re.findall(r"[A-Za-z]+|[^A-Za-z]", text) if unit == "token" else list(text)
    digest = hashlib.sha256(f"{epoch}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted(x % (len(parts) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= moved:
        return i, len(parts), "plain", None, None, text
    form = "spm" if h[3] % 100 < spm else "psm"
    out = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    return i, len(parts), form, len(prefix), len(middle), out


def texts():
    rng = random.Random(2)
    parts = list("ab Z1\n.é日😀<>PSM") + ["word", "<P", "S>", "ü", "́"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(700)]
    return rows + [(None, "abc déf"), (800, None), (801, ""), (802, "a <P> b"), (803, "x<M>"), (804, "a<"), (805, "<<"), (806, ">S>"), (5, "repeated"), (5, "repeated"), (807, "Z" * 50)]


@pytest.mark.parametrize("unit,epoch,moved,spm", [("token", 1, 90, 20), ("char", 7, 100, 50), ("token", 2, 0, 0)])
def test_rows(spark, unit, epoch, moved, spm):
    rows = texts()
    docs = spark.createDataFrame([r + (1, "x") for r in rows], "doc_id bigint, text string, n int, form string")
    got = fm.fill_in_middle(docs, epoch=epoch, unit=unit, moved_percent=moved, spm_percent=spm).withColumn("back", fm.restored(fm.F.col("output"), fm.F.col("form")))
    want = [(*brute(i, t, epoch, unit, moved, spm), t or "") for i, t in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert fm.fill_in_middle(docs.limit(0)).count() == 0
    if moved:
        assert {w[2] for w in want} == {"plain", "psm", "spm"}
    with pytest.raises(ValueError):
        fm.fill_in_middle(docs, unit="line")


def test_index_goes_both_ways():
    for text in ("", "abc", "é", "aé日😀b" * 5, "😀😀x"):
        data = np.frombuffer(text.encode(), np.uint8)
        index = fm.ExceptionIndex(data)
        places = [len(text[:k].encode()) for k in range(len(text) + 1)]
        assert index.to_bytes(np.arange(len(text) + 1)).tolist() == places
        assert index.to_points(np.array(places)).tolist() == list(range(len(text) + 1))


def test_long_texts(spark):
    rows = [(1, "wörd 日本 " * 150_000), (2, "a" * 3_000_000), (3, "😀" * 400_000)]
    got = fm.fill_in_middle(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, got.collect())) == [brute(i, t) for i, t in rows]


def test_whole_table_against_sql(spark):
    result = check_queries.compare(spark, "/root/testdata/sf0.001", "op12", queries.queries()["op12_fill_in_middle"], fm.oracle())
    assert result.startswith("ok") and "differ" not in result, result
