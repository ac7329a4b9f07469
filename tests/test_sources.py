"""Tables, landing files, exports, streams and store-to-store sync on a real folder."""

import datetime as dt
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from snapstats.operators import shaping, sync, usage
from snapstats.schemas import PRIMARY_KEYS, SYNC_TABLES, TABLE_DDL, table_schema
from snapstats.sources import exports, landing, tables
from snapstats.streaming import ingest

T1, T2 = dt.datetime(2026, 1, 1, 5), dt.datetime(2026, 1, 2, 5)


@pytest.fixture
def database(spark, folder):
    name = f"db_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/{name}'")
    tables.create_tables(spark, name, buckets=4)
    return name


def stats(spark, *entries):
    return spark.createDataFrame([(v, at, n, 0, 0) for v, at, n in entries], table_schema("video_stats"))


def test_every_table_has_its_keys(spark):
    assert set(TABLE_DDL) == set(PRIMARY_KEYS) and len(SYNC_TABLES) == 11
    for name, keys in PRIMARY_KEYS.items():
        assert set(keys) <= set(table_schema(name).fieldNames())


def test_create_append_publish(spark, database, folder, rows):
    tables.append("video_stats", stats(spark, ("a", T1, 1), ("b", T2, 2)), database)
    tables.create_tables(spark, database)  # again: nothing is lost
    tables.append("video_stats", stats(spark, ("a", T2, 3)), database)
    stored = tables.load_catalog(spark, database, ["video_stats"])["video_stats"]
    assert rows(stored, "video_id", "view_count") == [("a", 1), ("a", 3), ("b", 2)]
    assert stored.columns == table_schema("video_stats").fieldNames()

    videos = spark.createDataFrame([("a", "c1")], "video_id string, channel_id string")
    tables.append("videos", videos, database)
    current = tables.load_catalog(spark, database, ["videos"])["videos"]
    tables.publish("videos", current.withColumn("title", F.lit("new")), f"{folder}/videos-2", database)
    assert rows(spark.table(f"{database}.videos"), "video_id", "title") == [("a", "new")]
    with pytest.raises(Exception):
        tables.publish("videos", current, f"{folder}/videos-2", database)


def test_time_window_reads_only_its_months(spark, database, rows):
    tables.append("video_stats", stats(spark, ("a", T1, 1), ("a", dt.datetime(2026, 2, 2), 2), ("a", dt.datetime(2026, 2, 9), 3)),
                  database)
    window = tables.load_window(spark, "video_stats", "2026-02-10 00:00:00", 2, database)
    assert rows(window, "view_count") == [(3,)]
    plan = window._sc._jvm.PythonSQLUtils.explainString(window._jdf.queryExecution(), "simple")
    assert "PartitionFilters: [isnotnull(fetched_month" in plan


def test_load_folder(spark, folder, rows):
    stats(spark, ("a", T1, 1)).write.parquet(f"{folder}/video_stats")
    assert rows(tables.load_tables(spark, folder, ["video_stats"])["video_stats"], "video_id") == [("a",)]
    assert tables.empty_table(spark, "videos").isEmpty()


def test_jdbc_options():
    options = tables.jdbc_options("jdbc:x", "comments", "id", (0, 100), 8)
    assert options["numPartitions"] == "8" and options["upperBound"] == "100" and options["dbtable"] == "comments"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "comments", "id")


def test_exports(spark, folder, rows):
    videos = spark.createDataFrame([("a", 'say "hi",\nthere', ["x", "y"])], "video_id string, title string, tags array<string>")
    done = exports.export_tables({"videos": videos, "chapters": tables.empty_table(spark, "chapters"),
                                  "fetch_log": tables.empty_table(spark, "fetch_log")}, folder)
    assert set(done) == {"videos", "chapters"} and not os.path.exists(done["chapters"])
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(done["videos"])
    assert rows(back) == [("a", 'say "hi",\nthere', '["x","y"]')]


def write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines) + "\n")


def test_landing_sets_corrupt_lines_aside(spark, folder, rows):
    write_lines(folder, "a.json", [{"id": "v1", "snippet": {"title": "t"}, "extra": 1}, "{broken", {"id": "v2"}])
    landed = landing.read_landing(spark, folder, "video")
    assert rows(landing.readable(landed).select("item.id")) == [("v1",), ("v2",)]
    assert rows(landing.corrupt(landed), landing.CORRUPT) == [("{broken",)]
    assert rows(shaping.video_rows(landing.readable(landed)), "video_id", "title") == [("v1", "t"), ("v2", None)]


@pytest.mark.parametrize("form", ["json", "csv"])
def test_channel_options(spark, folder, rows, form):
    kinds = {"max_replies_per_comment": "int", "max_comment_videos": "int"}
    if form == "json":
        write_lines(folder, "list.json", [{"identifier": "@a"}, {"identifier": "@b", "max_comment_videos": 5}])
    else:
        write_lines(folder, "list.csv", ["identifier,max_comment_videos", "@a,", "@b,5"])
    listed = landing.read_channel_options(spark, f"{folder}/list.{form}", kinds)
    resolved = usage.resolve_options(listed.select("identifier"), listed, {"max_replies_per_comment": 3, "max_comment_videos": 7})
    assert rows(resolved, "identifier", "max_replies_per_comment", "max_comment_videos", "min_new_comments") == [
        ("@a", 3, 7, 10), ("@b", 3, 5, 10)]


@pytest.mark.parametrize("incremental", [True, False])
def test_sync_stores(spark, folder, rows, incremental):
    source = {"video_stats": stats(spark, ("a", T1, 1), ("b", T1, 2)),
              "videos": spark.createDataFrame([("a", "new", 1), ("b", "b", 2)], "video_id string, title string, extra int")}
    destination = {"video_stats": stats(spark, ("a", T1, 9)),
                   "videos": spark.createDataFrame([("a", "old", "kept")], "video_id string, title string, own string"),
                   "comments": None}
    source["comments"] = tables.empty_table(spark, "comments")
    written = {}
    results = sync.sync_stores(spark, source, destination, lambda t, df, append: written.update({t: (df, append)}),
                               ["videos", "video_stats", "comments", "playlists", "nonsense"], incremental)
    got = {r["table"]: (r["status"], r["synced"], r["skipped"]) for r in results.collect()}
    assert got["comments"][0] == "error" and got["playlists"][0] == "skipped" and "nonsense" not in got
    videos, append = written["videos"]
    assert append is incremental
    if incremental:
        assert got["videos"] == ("success", 1, 1) and rows(videos) == [("b", "b")]
        assert rows(written["video_stats"][0], "video_id") == [("b",)]
    else:
        assert got["videos"] == ("success", 2, 0) and rows(videos) == [("a", "new", "kept"), ("b", "b", None)]
    assert sync.sync_totals(results).first()["status"] == "partial"


def test_sync_dry_run_writes_nothing(spark, rows):
    side = {"video_stats": stats(spark, ("a", T1, 1))}
    results = sync.sync_stores(spark, side, side, lambda *_: pytest.fail("wrote"), ["video_stats"], True, dry_run=True)
    assert rows(results, "status", "source_count", "synced") == [("dry_run", 1, 0)]


def thread(key, fetched, text="t"):
    return {"video_id": "v", "fetched_at": fetched, "id": key,
            "snippet": {"topLevelComment": {"snippet": {"textDisplay": text, "publishedAt": "2026-01-01T00:00:00Z"}}},
            "replies": {"comments": [{"id": f"{key}.0", "snippet": {"textDisplay": "r"}}]}}


def test_streams_append_each_row_once(spark, database, folder, rows):
    write_lines(f"{folder}/in", "1.json", [thread("a", "2026-01-01T06:00:00Z"), thread("b", "2026-01-01T06:00:00Z")])
    for _ in range(2):
        ingest.ingest_comments(spark, f"{folder}/in", f"{folder}/cp", database).awaitTermination()
    write_lines(f"{folder}/in", "2.json", [thread("b", "2026-01-02T06:00:00Z", "later"), thread("c", "2026-01-02T06:00:00Z")])
    ingest.ingest_comments(spark, f"{folder}/in", f"{folder}/cp", database).awaitTermination()
    # The same files seen by a fresh checkpoint change nothing either.
    ingest.ingest_comments(spark, f"{folder}/in", f"{folder}/cp2", database).awaitTermination()
    got = rows(spark.table(f"{database}.comments"), "comment_id", "text", F.dayofmonth("fetched_at"))
    assert got == [("a", "t", 1), ("a.0", "r", 1), ("b", "t", 1), ("b.0", "r", 1), ("c", "t", 2), ("c.0", "r", 2)]

    item = {"id": "v", "fetched_at": "2026-01-01T06:00:00Z", "statistics": {"viewCount": "5"}}
    write_lines(f"{folder}/videos", "1.json", [item, {**item, "fetched_at": "2026-01-02T06:00:00Z"}, item, {"snippet": {}}])
    ingest.ingest_video_stats(spark, f"{folder}/videos", f"{folder}/cp3", database).awaitTermination()
    assert rows(spark.table(f"{database}.video_stats"), "video_id", "view_count", F.dayofmonth("fetched_at")) == [
        ("v", 5, 1), ("v", 5, 2)]


def test_a_run_brings_every_table_up_to_date(spark, database, folder, rows):
    from snapstats.plans.jobs import Run, apply_landing

    def land(day, title, views, comments):
        root = f"{folder}/landing-{day}"
        write_lines(f"{root}/channel", "1.json", [{"id": "c", "snippet": {"title": title}, "statistics": {"videoCount": "1"}}])
        write_lines(f"{root}/video", "1.json", [
            {"id": v, "snippet": {"channelId": "c", "title": title, "description": "0:00 Start" if day == 1 else "none"},
             "statistics": {"viewCount": str(views), "commentCount": str(comments)}} for v in ("v", "w")] + ["{broken"])
        write_lines(f"{root}/playlist", "1.json", [{"id": "p", "channel_id": "c", "snippet": {"title": title}}])
        write_lines(f"{root}/comment_thread", "1.json", [
            {"id": f"k{i}", "video_id": "v", "snippet": {"topLevelComment": {"snippet": {"textDisplay": title}}}}
            for i in range(comments)])
        return {k: f"{root}/{k}" for k in ("channel", "video", "playlist", "comment_thread")}

    def table(name):
        return tables.load_catalog(spark, database, [name])[name]

    first = Run(spark, "run-1", f"{folder}/runs", database, "2026-01-01 06:00:00")
    assert rows(apply_landing(first, land(1, "old", 10, 2)), "fetch_type", "videos_fetched", "comments_fetched", "status") == [
        ("backfill", 2, 2, "completed")]
    assert rows(table("chapters"), "video_id", "title") == [("v", "Start"), ("w", "Start")]
    assert "video: 1 unreadable lines, 0 rows without a key" in table("fetch_log").first()["errors"]
    assert spark.read.parquet(f"{folder}/runs/run-1/staged/quarantine/video/lines").first()[0] == "{broken"
    second = Run(spark, "run-2", f"{folder}/runs", database, "2026-01-02 06:00:00")
    landing_2 = land(2, "new", 25, 3)
    for _ in range(2):  # the same run again changes nothing
        log = apply_landing(second, landing_2)
        assert rows(log, "fetch_type", "comments_fetched") == [("incremental", 3)]
        assert rows(table("videos"), "video_id", "title", F.dayofmonth("first_seen_at"), F.dayofmonth("updated_at")) == [
            ("v", "new", 1, 2), ("w", "new", 1, 2)]
        assert rows(table("video_stats"), "video_id", "view_count") == [("v", 10), ("v", 25), ("w", 10), ("w", 25)]
        assert rows(table("comments"), "comment_id", "text") == [("k0", "old"), ("k1", "old"), ("k2", "new")]
        assert rows(table("video_comment_summary"), "video_id", "stored_comment_count", "latest_youtube_comment_count") == [
            ("v", 3, 3), ("w", 0, 3)]
        assert table("chapters").isEmpty() and table("playlists").count() == 1
        assert table("channel_stats").count() == 2 and table("fetch_log").count() == 2
    # An older run repeated does not bring its versions back.
    apply_landing(first, {k: f"{folder}/landing-1/{k}" for k in ("channel", "video", "playlist", "comment_thread")})
    assert rows(table("videos"), "video_id", "title") == [("v", "new"), ("w", "new")]


def test_only_finished_stages_are_taken_up(spark, folder, rows):
    import os

    from snapstats.plans.jobs import Run

    run, full = Run(spark, "r", folder), spark.range(100).repartition(4)
    path = f"{folder}/r/staged/x"
    full.limit(50).write.parquet(path)
    os.remove(f"{path}/_SUCCESS")
    assert run.staged("x", full).count() == 100
    assert run.staged("x", full.limit(1)).count() == 100
