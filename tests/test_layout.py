"""The stored layout: months and buckets prune reads, merges rewrite only what they touch."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from test_sources import database, write_lines  # noqa: F401

from snapstats.operators import maintenance, reports
from snapstats.plans.jobs import Run
from snapstats.schemas import table_schema
from snapstats.sources import tables


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def scan_filters(df):
    return [line.split("PartitionFilters: ")[1].split(", PushedFilters")[0] for line in plan_of(df).splitlines() if "PartitionFilters: " in line]


def files_of(spark, name):
    """Data files of a table with their times, by partition folder."""
    root = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"].removeprefix("file:")
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def rows_read(df):
    """Rows that the scans of a finished query gave out."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    todo = [plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        name = node.getClass().getSimpleName()
        kids = [node.plan()] if name.endswith("QueryStageExec") else [node.children().apply(i) for i in range(node.children().size())]
        todo += kids
    return total


@pytest.fixture
def small(spark, folder):
    """Tables of 16 buckets."""
    name = "db_" + os.path.basename(folder).replace("-", "_").lower()
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/{name}'")
    tables.create_tables(spark, name, buckets=16)
    return name


def snapshots(spark, table):
    key = {"video_stats": "video_id", "channel_stats": "channel_id", "comments": "video_id"}[table]
    rows = spark.range(400).select(
        F.concat(F.lit("k"), F.col("id") % 40).alias(key), F.concat(F.lit("c"), "id").alias("comment_id"),
        F.make_timestamp(F.lit(2025), 1 + F.col("id").cast("int") % 12, F.lit(3), F.lit(4), F.lit(5), F.lit(0)).alias("fetched_at"),
        F.col("id").alias("view_count"), F.col("id").alias("subscriber_count"))
    return tables.conform(table, rows.withColumn("published_at", F.col("fetched_at")))


@pytest.mark.parametrize("report,table", [("growth", "video_stats"), ("subscriber-growth", "channel_stats"), ("comment-velocity", "comments")])
def test_reports_skip_months(spark, small, rows, report, table):
    tables.append(table, snapshots(spark, table), small)
    plain = tables.load_catalog(spark, small)
    laid = tables.load_catalog(spark, small, layout=True)
    day = "2025-06-05 00:00:00"
    df = reports.run_report(report, laid, day)
    assert any("fetched_month" in f and ">=" in f for f in scan_filters(df))
    assert rows(df) == rows(reports.run_report(report, plain, day))
    window = tables.load_window(spark, table, day, 4, small)
    assert window.columns == table_schema(table).fieldNames() and window.count() > 0
    assert rows_read(window) < 400


@pytest.mark.parametrize("table", ["video_stats", "channel_stats"])
def test_key_checks_read_the_months_of_the_batch(spark, small, rows, table):
    """M04, M05: nothing but the batch's month (and buckets) is opened, and the result is that of the whole table."""
    tables.append(table, snapshots(spark, table), small)
    batch = snapshots(spark, table).where("month(fetched_at) = 3").limit(5)
    more = batch.withColumn("fetched_at", F.col("fetched_at") + F.expr("interval 1 day"))
    batch = spark.createDataFrame(batch.unionByName(more).collect(), batch.schema)
    part = tables.part_for(spark, table, batch, small)
    new = maintenance.new_stats(table, part, batch)
    whole = maintenance.new_stats(table, tables.load_catalog(spark, small, [table])[table], batch)
    assert rows(new) == rows(whole) and new.count() == 5
    assert all("fetched_month" in f for f in scan_filters(new)) and scan_filters(new)
    assert rows_read(new) < 60


def test_comment_check_grows_with_the_batch(spark, small):
    """M07: the rows read for a batch do not grow with the table, once keys outside it lie in other buckets or row groups."""
    base = snapshots(spark, "comments")
    read = []
    batch = spark.createDataFrame([("c3", "k3"), ("new", "k3")], "comment_id string, video_id string")
    for k in range(2):
        tables.append("comments", base.withColumn("comment_id", F.concat(F.lit("x" * k), "comment_id")), small)
        part = tables.part_for(spark, "comments", batch, small, ["comment_id"])
        new = maintenance.new_comments(part, tables.conform("comments", batch))
        assert [r.comment_id for r in new.collect()] == ["new"]
        read.append(rows_read(new))
    assert read[0] == read[1] < 30


def test_bloom_filters_are_written(spark, small):
    import pyarrow.parquet as pq
    tables.append("comments", snapshots(spark, "comments"), small)
    path = next(iter(files_of(spark, f"{small}.comments")))
    assert pq.ParquetFile(path).metadata.num_rows > 0
    # A key the statistics cannot rule out is ruled out by the filter.
    part = tables.load_catalog(spark, small, ["comments"])["comments"].where("comment_id = 'c1a'")
    assert rows_read(part) == 0


def test_merges_touch_their_buckets_only(spark, small, folder, rows):
    """M01-M03, M06, M11: untouched buckets keep their files, and the table equals the plain merge."""
    base = spark.range(200).select(F.concat(F.lit("v"), "id").alias("video_id"), F.lit("c").alias("channel_id"), F.lit("old").alias("title"))
    tables.append("videos", base, small)
    before = files_of(spark, f"{small}.videos")
    run = Run(spark, "r1", f"{folder}/runs", small, "2026-01-01 00:00:00")
    batch = run.staged("batch", spark.createDataFrame([("v7", "d", "new"), ("v8", "d", "new"), ("fresh", "d", "new")], "video_id string, channel_id string, title string"))
    whole = maintenance.upsert_videos(tables.load_catalog(spark, small, ["videos"])["videos"], batch, as_of=run.as_of)
    want = rows(whole)
    parts = tables.parts_of(spark, "videos", batch, small)
    assert 1 <= len(parts) <= 3
    run.merge("videos", batch, lambda part: maintenance.upsert_videos(part, batch, as_of=run.as_of))
    after = files_of(spark, f"{small}.videos")
    assert rows(tables.load_catalog(spark, small, ["videos"])["videos"]) == want
    touched = tuple(f"key_bucket={p[0]}/" for p in parts)
    untouched = {f: t for f, t in before.items() if not any(k in f for k in touched)}
    assert untouched and untouched.items() <= after.items()
    assert {f for f in before if f not in untouched}.isdisjoint(after)
    # Repeated, the run puts the same rows in place; an older one does not.
    run.merge("videos", batch, lambda part: pytest.fail("merged again"))
    assert rows(tables.load_catalog(spark, small, ["videos"])["videos"]) == want
    late = Run(spark, "r2", f"{folder}/runs", small, "2026-01-02 00:00:00")
    late.merge("videos", batch, lambda part: part.withColumn("title", F.lit("later")))
    run.merge("videos", batch, lambda part: part)
    assert tables.load_catalog(spark, small, ["videos"])["videos"].where("title = 'later'").count() > 0


def test_emptied_parts_are_emptied(spark, small, rows):
    at = dt.datetime(2025, 5, 5)
    chapters = spark.createDataFrame([(f"v{i}", 0, "t", 0, 1) for i in range(30)], table_schema("chapters"))
    tables.append("chapters", chapters, small)
    parts = tables.parts_of(spark, "chapters", chapters.where("video_id in ('v1', 'v2')"), small)
    tables.replace_parts("chapters", chapters.limit(0), parts, small)
    left = tables.load_catalog(spark, small, ["chapters"])["chapters"]
    gone = {tuple(p) for p in parts}
    kept = tables.laid_out(spark, "chapters", chapters, small)
    assert rows(left, "video_id") == rows(kept.where(~F.col("key_bucket").isin([p[0] for p in gone])), "video_id")
    stats = spark.createDataFrame([("a", at, 1, 0, 0), ("b", dt.datetime(2025, 6, 5), 1, 0, 0)], table_schema("video_stats"))
    tables.append("video_stats", stats, small)
    tables.replace_parts("video_stats", stats.limit(0), tables.parts_of(spark, "video_stats", stats.where("video_id = 'a'"), small), small)
    assert rows(tables.load_catalog(spark, small, ["video_stats"])["video_stats"], "video_id") == [("b",)]
    with pytest.raises(ValueError):
        tables.replace_parts("chapters", chapters, parts, small)


def test_old_runs_are_forgotten(spark, small, folder):
    batch = spark.createDataFrame([("v", "t")], "video_id string, title string")
    runs = [Run(spark, f"r{k}", f"{folder}/runs", small, "2026-01-01 00:00:00") for k in range(4)]
    for run in runs:
        staged = run.staged("batch", batch)
        run.merge("videos", staged, lambda part, n=run.run_id: maintenance.upsert_videos(part, batch.withColumn("title", F.lit(n))))
    assert runs[-1].forget(2) == ["r0", "r1"]
    assert sorted(os.listdir(f"{folder}/runs/r0")) == ["base"] and "staged" in os.listdir(f"{folder}/runs/r2")
    runs[0].merge("videos", batch, lambda part: pytest.fail("an old run came back"))
    assert tables.load_catalog(spark, small, ["videos"])["videos"].first()["title"] == "r3"


def test_latest_rows_need_no_sort_aggregate(spark):
    stats = snapshots(spark, "video_stats")
    videos = spark.createDataFrame([("k1", "c", "t")], "video_id string, channel_id string, title string").withColumns(
        {"published_at": F.current_timestamp(), "duration_seconds": F.lit(5).cast("bigint")})
    channels = spark.createDataFrame([("c", "t")], "channel_id string, title string")
    named = {"video_stats": stats, "channel_stats": snapshots(spark, "channel_stats"), "videos": videos, "channels": channels,
             "transcripts": spark.createDataFrame([], "video_id string")}
    frames = [reports.run_report(n, named) for n in ("channels", "top-videos", "engagement-rate", "video-length-performance", "recent-uploads")]
    summary = spark.createDataFrame([], table_schema("video_comment_summary"))
    frames += [reports.latest_video_stats(named, "view_count"), maintenance.summary_after_stats(summary, stats),
               maintenance.summary_after_stats(summary, stats, whole_table=True),
               maintenance.summary_backfill(videos, snapshots(spark, "comments"), stats, summary)]
    for df in frames:
        assert "SortAggregate" not in plan_of(df)


def test_late_statistics_do_not_move_a_video_back(spark, rows):
    day = lambda d: dt.datetime(2025, 1, d)
    summary = spark.createDataFrame([("a", 3, None, 50, day(9)), ("b", 1, None, 5, day(1)), ("c", 2, None, None, None)], table_schema("video_comment_summary"))
    batch = spark.createDataFrame([(v, day(d), 0, 0, n) for v, d, n in (("a", 4, 20), ("b", 4, 7), ("b", 2, 99), ("c", 4, 1), ("d", 4, 2), ("d", 4, 3))], table_schema("video_stats"))
    want = [("a", 3, 50, 9), ("b", 1, 7, 4), ("c", 2, 1, 4), ("d", 0, 3, 4)]
    for whole in (False, True):
        got = maintenance.summary_after_stats(summary, batch, whole_table=whole)
        assert rows(got, "video_id", "stored_comment_count", "latest_youtube_comment_count", F.dayofmonth("last_stats_fetch")) == want
