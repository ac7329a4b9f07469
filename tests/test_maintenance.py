"""Keyed merges: edge rows, and properties that must hold for any input."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from snapstats.operators import keyed, maintenance, sync

NOW = "2026-01-31 00:00:00"
CLOCK = dt.datetime(2026, 1, 31)
few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
table = st.dictionaries(st.integers(0, 12), st.tuples(st.integers(0, 9), st.none() | st.integers(0, 9)), max_size=10)


def frame(spark, data, ddl="k int, a int, b int"):
    return spark.createDataFrame([(k, *v) for k, v in data.items()], ddl)


@few
@given(current=table, incoming=table)
def test_merge_is_idempotent_and_partial(spark, current, incoming):
    cur, inc = frame(spark, current), frame(spark, incoming)
    once = keyed.merge_by_key(cur, inc, ["k"], ["b"])
    expected = {k: (current.get(k, v)[0], v[1]) for k, v in incoming.items()}
    assert {r["k"]: (r["a"], r["b"]) for r in once.collect()} == current | expected
    whole = keyed.merge_by_key(cur, inc, ["k"], ["b"], whole_table=True)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, once.collect()))
    twice = keyed.merge_by_key(once, inc, ["k"], ["b"])
    assert sorted(map(repr, twice.collect())) == sorted(map(repr, once.collect()))


@few
@given(current=table, incoming=table)
def test_insert_ignore_never_changes_rows(spark, current, incoming):
    cur, inc = frame(spark, current), frame(spark, incoming)
    result = keyed.insert_ignore(cur, inc, ["k"])
    assert {r["k"]: (r["a"], r["b"]) for r in result.collect()} == incoming | current
    assert result.count() == len(incoming | current)


@few
@given(current=table, incoming=table)
def test_sync_twice_finds_nothing(spark, current, incoming):
    src, dst = frame(spark, incoming), frame(spark, current)
    new = sync.missing_rows(src, dst, ["k"])
    assert {r["k"] for r in new.collect()} == set(incoming) - set(current)
    assert sync.missing_rows(src, dst.unionByName(new), ["k"]).isEmpty()


@few
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 99), st.integers(0, 9)), max_size=12, unique_by=lambda r: r[1]))
def test_batch_duplicates_apply_in_order(spark, batch):
    inc = spark.createDataFrame([(k, v, v, seq) for k, seq, v in batch], "k int, a int, b int, seq int")
    cur = spark.createDataFrame([(0, -1, -1)], "k int, a int, b int")
    expected = {0: (-1, -1)}
    for k, _, v in sorted(batch, key=lambda r: r[1]):
        expected[k] = (expected[k][0] if k in expected else v, v)
    merged = keyed.merge_by_key(cur, inc, ["k"], ["b"], order="seq")
    assert {r["k"]: (r["a"], r["b"]) for r in merged.collect()} == expected


def test_latest_keeps_one_whole_row_on_ties(spark):
    df = spark.createDataFrame([(1, 5, 1, 9), (1, 5, 2, 0), (1, 4, 9, 9), (2, 1, None, None)], "k int, t int, a int, b int")
    got = {tuple(r) for r in keyed.latest_per_key(df, ["k"], "t", ["a", "b"]).collect()}
    assert got == {(1, 5, 2, 0), (2, 1, None, None)}


@few
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 99)), max_size=30, unique=True), st.integers(1, 5))
def test_salted_top_equals_plain(spark, entries, n):
    df = spark.createDataFrame(entries, "k int, v int")
    salted = keyed.top_per_key(df, ["k"], [F.desc("v")], n, ["v"]).collect()
    plain = {k: sorted((v for key, v in entries if key == k), reverse=True)[:n] for k, _ in entries}
    assert sorted(map(tuple, salted)) == sorted((k, v) for k, values in plain.items() for v in values)


def test_video_upsert_stamps_and_keeps(spark):
    ddl = "video_id int, channel_id int, title string, embeddable boolean, has_chapters boolean, first_seen_at timestamp, updated_at timestamp"
    old = dt.datetime(2020, 1, 1)
    cur = spark.createDataFrame([(1, 7, "old", True, False, old, old)], ddl)
    inc = spark.createDataFrame([(1, 8, "new", None, True), (2, 9, "fresh", None, None)],
                                "video_id int, channel_id int, title string, embeddable boolean, has_chapters boolean")
    got = {r["video_id"]: tuple(r)[1:] for r in maintenance.upsert_videos(cur, inc, as_of=NOW).collect()}
    assert got == {1: (7, "new", True, True, old, CLOCK), 2: (9, "fresh", False, False, CLOCK, CLOCK)}


def test_stats_fill_missing_counts(spark, rows):
    ddl = "video_id int, fetched_at timestamp, view_count bigint, like_count bigint, comment_count bigint"
    t = dt.datetime(2026, 1, 1)
    cur = spark.createDataFrame([(1, t, 5, 5, 5)], ddl)
    batch = spark.createDataFrame([(1, t, 9, 9, 9), (2, t, 7, None, None)], ddl)
    assert rows(maintenance.new_stats("video_stats", cur, batch)) == [(2, t, 7, 0, 0)]
    assert rows(maintenance.insert_stats("video_stats", cur, batch)) == [(1, t, 5, 5, 5), (2, t, 7, 0, 0)]


SUMMARY = ("video_id int, stored_comment_count bigint, last_comment_fetch timestamp, "
           "latest_youtube_comment_count bigint, last_stats_fetch timestamp")


def test_increments_equal_a_recount(spark, rows):
    """Two batches of comments and statistics, counted up, give what a backfill from scratch gives."""
    t1, t2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    comment = "comment_id int, video_id int, like_count bigint, fetched_at timestamp"
    stat = "video_id int, fetched_at timestamp, view_count bigint, like_count bigint, comment_count bigint"
    videos = spark.createDataFrame([(1,), (2,), (3,), (4,)], "video_id int")
    summary, comments = spark.createDataFrame([], SUMMARY), spark.createDataFrame([], comment)
    stats = spark.createDataFrame([], stat)
    for at, added, measured in (
            (t1, [(10, 1), (11, 1), (20, 2)], [(1, 2), (2, 1), (3, 0)]),
            (t2, [(11, 1), (12, 1), (12, 1), (20, 2), (21, 2)], [(1, 3), (2, 2), (3, 4)])):
        batch = spark.createDataFrame([(c, v, 0, at) for c, v in added], comment)
        numbers = spark.createDataFrame([(v, at, 0, 0, n) for v, n in measured], stat)
        inserted = maintenance.new_comments(comments, batch)
        summary = maintenance.summary_after_comments(summary, inserted, batch, at)
        summary = maintenance.summary_after_stats(summary, numbers)
        comments = maintenance.insert_comments(comments, batch)
        stats = maintenance.insert_stats("video_stats", stats, numbers)
    recount = maintenance.summary_backfill(videos, comments, stats, spark.createDataFrame([], SUMMARY))
    columns = ["video_id", "stored_comment_count", "latest_youtube_comment_count", "last_stats_fetch"]
    assert rows(summary, *columns) == rows(recount, *columns)
    assert rows(recount, "video_id", "stored_comment_count") == [(1, 3), (2, 2), (3, 0)]
    assert maintenance.summary_backfill(videos, comments, stats, summary).isEmpty()


def test_summary_takes_the_latest_count_in_small_parts(spark, rows):
    summary = spark.createDataFrame([(1, 1, None, 3, dt.datetime(2024, 1, 2))], SUMMARY)
    day = dt.datetime(2024, 1, 3)
    batch = spark.createDataFrame([(1, day, 5), (1, day, 8), (1, day, None), (2, day, None), (3, None, 4), (1, dt.datetime(2024, 1, 1), 90)],
                                  "video_id int, fetched_at timestamp, comment_count bigint")
    after = maintenance.summary_after_stats(summary, batch, whole_table=True)
    assert rows(after, "video_id", "latest_youtube_comment_count", "last_stats_fetch") == [(1, 8, day), (2, 0, day), (3, None, None)]
    # A task holds several hash maps of its part of the batch: parts of Spark's 64 MB took 2 GB of memory.
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_rows_folded_before_are_not_folded_again(spark, rows):
    ids = "video_id int, comment_id int, fetched_at timestamp, comment_count bigint, like_count bigint"
    batch = spark.createDataFrame([(1, 1, dt.datetime(2024, 1, 1), None, None), (2, 2, dt.datetime(2024, 1, 2), 4, 5)], ids)
    current = batch.filter("video_id = 1")
    for new in (lambda **how: maintenance.new_stats("video_stats", current, batch, **how), lambda **how: maintenance.new_comments(current, batch, **how),
                lambda **how: maintenance.new_transcripts(current, batch, **how)):
        assert rows(new(unique=True)) == rows(new())
        assert "Aggregate" not in new(unique=True)._jdf.queryExecution().optimizedPlan().toString()
    assert spark.conf.get("spark.sql.parquet.compression.codec") == "zstd"


def test_known_comments_still_mark_the_visit(spark, rows):
    comments = spark.createDataFrame([(1, 5, None)], "comment_id int, video_id int, like_count bigint")
    summary = spark.createDataFrame([(5, 1, None, 3, None), (6, 2, None, 9, None)], SUMMARY)
    none_new = maintenance.new_comments(comments, comments)
    raised = maintenance.summary_after_comments(summary, none_new, comments, NOW)
    assert rows(raised, "video_id", "stored_comment_count", "last_comment_fetch") == [(5, 1, CLOCK), (6, 2, None)]


def test_chapters_lost_are_removed(spark, rows):
    ddl = "video_id int, chapter_index int, title string"
    cur = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c"), (3, 0, "d")], ddl)
    inc = spark.createDataFrame([(1, 0, "new")], ddl)
    done = spark.createDataFrame([(1,), (2,)], "video_id int")
    assert rows(maintenance.replace_chapters(cur, inc, done)) == [(1, 0, "new"), (3, 0, "d")]


def test_purge_cascades_to_every_table(spark, rows):
    old, fresh = CLOCK - dt.timedelta(days=30, seconds=1), CLOCK - dt.timedelta(days=30)
    videos = spark.createDataFrame(
        [(1, "t", 1, "deleted", old), (2, "t", 1, "deleted", fresh), (3, "t", 2, "public", old), (4, "t", 2, "deleted", old)],
        "video_id int, title string, channel_id int, privacy_status string, updated_at timestamp")
    tables = {n: spark.createDataFrame([(1, n), (1, n), (2, n), (3, n)], "video_id int, x string")
              for n in maintenance.VIDEO_TABLES if n != "videos"} | {"videos": videos}
    left = maintenance.purge_deleted(tables, NOW)
    assert rows(left["videos"], "video_id") == [(2,), (3,)]
    assert all(rows(left[n], "video_id") == [(2,), (3,)] for n in left)
    assert set(left) == set(maintenance.VIDEO_TABLES)
    counts = dict(rows(maintenance.purge_counts(tables, NOW)))
    assert counts["videos"] == 2 and counts["comments"] == 2 and counts["video_comment_summary"] == 2
    assert rows(maintenance.purge_victims(videos, NOW, channel_id=2)) == [(4,)]


def test_marking_again_is_the_callers_choice(spark, rows):
    videos = spark.createDataFrame([(1, "public", None), (2, "deleted", CLOCK)],
                                   "video_id int, privacy_status string, updated_at timestamp")
    ids = spark.createDataFrame([(1,), (1,), (9,)], "video_id int")
    later = dt.datetime(2026, 2, 1)
    assert rows(maintenance.mark_deleted(videos, ids, later)) == [(1, "deleted", later), (2, "deleted", CLOCK)]


def test_run_log_joins_first_ten_errors(spark):
    runs = spark.createDataFrame([(1, 7, "backfill"), (2, 8, "incremental")], "fetch_id bigint, channel_id int, fetch_type string")
    closed = spark.createDataFrame([(1, 3, 4, 0, [f"e{i}" for i in range(12)], "failed")],
                                   "fetch_id bigint, videos_fetched bigint, comments_fetched bigint, "
                                   "transcripts_fetched bigint, errors array<string>, status string")
    log = {r["fetch_id"]: r for r in maintenance.fetch_log_from_events(
        maintenance.open_runs(runs, NOW), maintenance.close_runs(closed, "2026-01-31 01:00:00")).collect()}
    assert log[1]["errors"] == "; ".join(f"e{i}" for i in range(10)) and log[1]["status"] == "failed"
    assert log[2]["status"] == "running" and log[2]["completed_at"] is None and log[2]["started_at"] == CLOCK


def test_progress_resumes(spark, rows):
    done = spark.createDataFrame([(1, "videos", 10), (1, "comments", 11)], "channel_id int, operation string, video_id int")
    todo = spark.createDataFrame([(1, 10), (1, 11), (2, 10)], "channel_id int, video_id int")
    assert rows(maintenance.remaining_ids(todo, done, "videos")) == [(1, 11), (2, 10)]
    more = maintenance.save_progress(done, todo, "videos")
    assert rows(more) == [(1, "videos", 11), (2, "videos", 10)]
    all_done = done.unionByName(more)
    assert maintenance.remaining_ids(todo, all_done, "videos").isEmpty()
    one = spark.createDataFrame([(1,)], "channel_id int")
    assert rows(maintenance.clear_progress(all_done, one)) == [(2, "videos", 10)]
    assert rows(maintenance.clear_progress(all_done, one, "videos")) == [(1, "comments", 11), (2, "videos", 10)]


def test_progress_folded_before_is_not_folded_again(spark, rows):
    done = spark.createDataFrame([("c", "v1", 1), ("c", "v2", 1)], "channel_id string, video_id string, fetch_id bigint")
    known = done.filter("video_id = 'v1'").withColumn("operation", F.lit("videos"))
    once = maintenance.save_progress(known, done, "videos", unique=True)
    assert rows(once) == rows(maintenance.save_progress(known, done, "videos"))
    assert "Aggregate" not in once._jdf.queryExecution().optimizedPlan().toString()


def test_grouped_sources_are_stored_before_a_sync(spark, folder, rows):
    from snapstats.plans import store_queries
    from snapstats.plans.driver_tables import DriverTables
    spark.createDataFrame([(1, 2, 3, 4, "N"), (1, 2, 5, 6, "R"), (7, 1, None, None, None)],
                          "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string").write.parquet(f"{folder}/lineitem.parquet")
    t = DriverTables(spark, folder)
    stored = store_queries._stored_view(t, "chapters", folder)
    assert rows(stored) == rows(t["chapters"]) and stored.columns == t["chapters"].columns
    assert "Aggregate" not in stored._jdf.queryExecution().optimizedPlan().toString()
