"""Documents that hold a benchmark item without an id are removed as well."""

from snapstats.llm import decontaminate as dc


def test_unnamed_items_are_searched(spark):
    item = "the quick brown fox jumps over the lazy dog and runs far away home"
    docs = spark.createDataFrame([(1, "before " + item), (2, "clean text of many words that holds nothing at all")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(None, item), (None, None)], "item_id bigint, text string")
    assert [r.doc_id for r in dc.decontaminate(docs, bench).collect()] == [2]
    assert [(r.doc_id, r.item_id) for r in dc.contaminated(docs, bench, block=1, unnamed=True).collect()] == [(1, None)]
    assert dc.op9_decontaminate(docs, bench).count() == 0
