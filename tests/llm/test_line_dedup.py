"""Line dedup against SQL and on odd rows."""

from check_queries import compare

from snapstats.llm import line_dedup as ld
from snapstats.llm import queries


def test_matches_sql(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        result = compare(spark, folder, "op1", queries.queries()["op1_line_dedup"], queries.oracle_sql()["op1_line_dedup"])
        assert result.startswith("ok") and "differ" not in result, result


def test_edges(spark):
    rows = [(i, f"menu\nbody {i}\nmenu\n\n  \nfooter{i % 2}", "a") for i in range(10)] + [
        (20, "menu\nonly here", "b"), (21, None, "a"), (22, "", "a"), (23, "menu", None), (24, "menu", "a"), (None, "menu\nx", "a"), (0, "menu\nbody 0\nmenu\n\n  \nfooter0", "a")]
    df = spark.createDataFrame([r + (7, "k", 1) for r in rows], "doc_id bigint, text string, source string, n_lines int, _boiler string, _on int")
    got = ld.line_dedup(df, percent=60, min_pages=5)
    assert set(got.columns) == set(df.columns) | {"n_dropped"}
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append((r.text, r.n_lines, r.n_dropped, r._boiler))
    assert by[3] == [("body 3\n\n  \nfooter1", 6, 2, "k")] and by[0] == [("body 0\n\n  \nfooter0", 6, 2, "k")] * 2
    assert by[20][0][0] == "menu\nonly here" and by[21][0][:3] == (None, 0, 0) and by[22][0][:3] == ("", 1, 0)
    assert by[23][0][0] == "menu" and by[24][0][:3] == ("", 1, 1) and by[None][0][0] == "x"
    assert ld.line_dedup(df.limit(0)).count() == 0


def test_plan_is_native(spark):
    plan = ld.op1_line_dedup(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
