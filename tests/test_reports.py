"""Reports on hand-made rows, ad-hoc SQL, quota rules and the shape of the plans."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from snapstats.operators import planning, reports, usage
from snapstats.operators.maintenance import purge_deleted
from snapstats.plans.driver_tables import DriverTables
from snapstats.plans.registry import oracle_sql, queries

SMALL = "/root/testdata/sf0.001"
NOW = "2026-01-08 00:00:00"


def at(day, hour=0):
    return dt.datetime(2026, 1, day, hour)


@pytest.fixture(scope="module")
def tiny(spark):
    def frame(ddl, *entries):
        return spark.createDataFrame(list(entries), ddl)
    return {
        "channels": frame("channel_id int, title string", (1, "One"), (2, "Two"), (3, "No videos")),
        "videos": frame("video_id int, channel_id int, title string, published_at timestamp, duration_seconds bigint",
                        (1, 1, "a", at(1), 59), (2, 1, "b", at(2), 60), (3, 2, "c", at(3), None), (4, 9, "orphan", at(4), 10),
                        (5, 2, "no stats", at(5), 3600)),
        "video_stats": frame("video_id int, fetched_at timestamp, view_count bigint, like_count bigint, comment_count bigint",
                             (1, at(1), 0, 0, 0), (1, at(3), 500, 5, 1), (1, at(2), 700, 9, 9), (2, at(1, 1), None, 3, 1),
                             (3, at(1), 2000, 20, 5), (3, at(2), 2000, 21, 5), (4, at(1), 9000, 9, 9), (7, at(1), 5, 5, 5)),
        "transcripts": frame("video_id int", (1,), (8,)),
    }


def test_growth_uses_extremes_not_ends(tiny, rows):
    got = rows(reports.growth(tiny, NOW))
    assert got == [("a", "One", 700, 0, 700, 70000.0, at(1))]


def test_growth_window_is_exact(tiny, rows):
    assert reports.growth(tiny, "2026-01-09 00:00:00", days=7).count() == 1
    assert reports.growth(tiny, "2026-01-09 00:00:01", days=7).count() == 0


def test_top_videos_sorts_missing_counts_last(tiny):
    got = [(r["title"], r["view_count"], r["duration_mins"]) for r in reports.top_videos(tiny).collect()]
    assert got == [("c", 2000, None), ("a", 500, 0), ("b", None, 1)]


def test_recent_uploads_keeps_videos_without_stats(tiny):
    got = [(r["title"], r["view_count"], r["has_transcript"]) for r in reports.recent_uploads(tiny).collect()]
    assert got == [("no stats", None, "No"), ("c", 2000, "No"), ("b", None, "No"), ("a", 500, "Yes")]


def test_length_buckets_are_ordered(tiny):
    got = [(r["length_bucket"], r["video_count"], r["avg_views"], r["avg_like_rate"])
           for r in reports.video_length_performance(tiny).collect()]
    assert got == [("< 1 min", 2, 4750.0, 0.55), ("1-5 min", 1, None, None)]


def test_coverage_drops_channels_without_videos(tiny):
    assert [tuple(r) for r in reports.transcript_coverage(tiny).collect()] == [("One", 2, 1, 50.0), ("Two", 2, 0, 0.0)]


def test_unknown_report(tiny, spark):
    with pytest.raises(ValueError):
        reports.run_report("nonsense", tiny)
    assert reports.list_reports(spark).count() == 12


@pytest.mark.parametrize("text", ["DROP TABLE videos", "insert into videos select 1", "", "  ",
                                  "with x as (select 1 as i) insert into videos select i from x", "-- hi\nDROP TABLE x"])
def test_ad_hoc_refuses_writes(spark, tiny, text):
    reports.register_views({"videos": tiny["videos"]})
    with pytest.raises(Exception):
        reports.run_query(spark, text)


def test_ad_hoc_reads(spark, tiny, rows):
    reports.register_views({"videos": tiny["videos"]})
    assert rows(reports.run_query(spark, " select count(*) from videos; ")) == [(5,)]
    assert rows(reports.run_query(spark, "WITH v AS (SELECT * FROM videos) SELECT max(video_id) FROM v ORDER BY 1")) == [(5,)]


def test_quota_borders(spark, rows):
    days = spark.createDataFrame([(1, 7999), (2, 8000), (3, 9499), (4, 9500), (5, 10500)], "date int, used bigint")
    got = rows(usage.quota_status(days, 10_000, planned_cost=1), "date", "state", "remaining", "can_afford", "would_abort")
    assert got == [(1, "ok", 2001, True, False), (2, "warning", 2000, True, False), (3, "warning", 501, True, False),
                   (4, "critical", 500, False, True), (5, "critical", 0, False, True)]


@pytest.mark.parametrize("n, expected", [(0, 5), (49, 5 + 49), (50, 7 + 50), (120, 9 + 120)])
def test_channel_cost(spark, n, expected):
    df = spark.createDataFrame([(1, n)], "channel_id int, video_count bigint")
    assert usage.estimate_channel_costs(df).first()["total"] == expected
    assert usage.estimate_channel_costs(df, fetch_comments=False).first()["total"] == expected - n


def test_unknown_operations_cost_one(spark, rows):
    log = spark.createDataFrame([(1, "search.list", 2), (1, "captions.list", 1), (1, "new.call", 3)],
                                "date int, operation string, calls bigint")
    assert rows(usage.operation_usage(log)) == [(1, "captions.list", 50), (1, "new.call", 3), (1, "search.list", 200)]


# --- plans ----------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def driver(spark):
    return DriverTables(spark, SMALL)


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_names_agree():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_rows_and_no_pair_products(spark, name):
    plan = plan_of(queries()[name](spark, SMALL))
    assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|CartesianProduct|BroadcastNestedLoopJoin", plan)


@pytest.mark.parametrize("name", ["r03_growth", "r04_top_videos", "r05_recent_uploads", "r06_comment_velocity",
                                  "r07_engagement_rate", "r10_popular_commenters", "r12_fetch_history",
                                  "p06_videos_needing_transcripts"])
def test_top_lists_do_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in plan_of(queries()[name](spark, SMALL))


@pytest.mark.parametrize("name", ["p05_videos_without_transcripts", "p13_new_video_ids", "s03_sync_incremental"])
def test_missing_rows_are_anti_joins(spark, name):
    assert "LeftAnti" in plan_of(queries()[name](spark, SMALL))


def test_latest_reads_the_snapshots_once(spark, driver, folder):
    driver["video_stats"].write.parquet(f"{folder}/s")
    stats = spark.read.parquet(f"{folder}/s")
    plan = plan_of(reports.latest_video_stats({"video_stats": stats}, "view_count"))
    assert plan.count("FileScan") == 1 and "like_count" not in plan


@pytest.mark.parametrize("query", ["p02_videos_needing_comments", "p16_listing_cap", "x11_choose_track"])
def test_ranks_are_cut_before_the_shuffle(spark, query):
    plan = plan_of(queries()[query](spark, SMALL))
    assert re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*WindowGroupLimit", plan)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_windows_reach_the_scan(spark, folder, kind):
    spark.sql(f"select 1 as video_id, cast('2026-01-01' as {kind}) as fetched_at, 1L as view_count").write.parquet(f"{folder}/t")
    stats = spark.read.parquet(f"{folder}/t")
    tables = {"video_stats": stats, "videos": spark.createDataFrame([], "video_id int, channel_id int, title string, published_at timestamp"),
              "channels": spark.createDataFrame([], "channel_id int, title string")}
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(fetched_at", plan_of(reports.growth(tables, NOW)))


def test_hot_channel_needs_no_window_over_it(spark):
    """The stop point of a listing is aggregated; the only windows are the two cuts, in slices of a channel and in the channel."""
    listing = spark.range(100).select((F.col("id") % 3).alias("channel_id"), F.col("id").alias("video_id"), F.col("id").alias("position"))
    plan = plan_of(planning.before_first_known(listing, spark.range(5).select(F.col("id").alias("video_id")), 10))
    assert "WindowGroupLimit" in plan and plan.count("Window [") == 2 and "_slice" in plan


def test_purge_reads_no_more_than_it_keeps(driver):
    assert "LeftAnti" in plan_of(purge_deleted({"videos": driver["videos"], "video_stats": driver["video_stats"]})["video_stats"])
