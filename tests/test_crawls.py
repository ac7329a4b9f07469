"""Several crawls in one landing, and bad lines in the streams."""

from pyspark.sql import functions as F
from test_sources import database, write_lines  # noqa: F401

from snapstats.plans.jobs import Run, apply_landing
from snapstats.sources import tables
from snapstats.streaming import ingest

DAY1, DAY2 = "2026-01-01T06:00:00Z", "2026-01-02T06:00:00Z"


def test_two_crawls_in_one_landing(spark, database, folder, rows):  # noqa: F811
    def video(at, title, views, published):
        return {"id": "v", "fetched_at": at, "snippet": {"channelId": "c", "title": title, "publishedAt": published},
                "statistics": {"viewCount": str(views), "commentCount": str(views)}}

    root = f"{folder}/landing"
    # The later crawl lies first; of two lines of one time the second is the newer, and the first is the snapshot.
    write_lines(f"{root}/video", "1.json", [video(DAY2, "newer", 50, "2025-02-02T00:00:00Z"), video(DAY2, "newest", 40, "2025-03-03T00:00:00Z"),
                                            video(DAY1, "older", 5, "2025-01-01T00:00:00Z")])
    write_lines(f"{root}/channel", "1.json", [{"id": "c", "fetched_at": at, "snippet": {"title": t}, "statistics": {"viewCount": str(n)}}
                                              for at, t, n in ((DAY2, "newer", 9), (DAY1, "older", 3))])
    write_lines(f"{root}/playlist", "1.json", [{"id": "p", "fetched_at": at, "channel_id": "c", "snippet": {"title": t}, "contentDetails": {"itemCount": n}}
                                               for at, t, n in ((DAY1, "older", 1), (DAY2, "newer", 2))])
    write_lines(f"{root}/comment_thread", "1.json", [
        {"id": "k", "video_id": "v", "fetched_at": at, "snippet": {"topLevelComment": {"snippet": {"textDisplay": t, "publishedAt": p}}}}
        for at, t, p in ((DAY1, "first", DAY2), (DAY2, "edited", DAY1))])
    run = Run(spark, "r", f"{folder}/runs", database, "2026-01-03 06:00:00")

    def table(name):
        return tables.load_catalog(spark, database, [name])[name]

    for _ in range(2):
        log = apply_landing(run, {k: f"{root}/{k}" for k in ("video", "channel", "playlist", "comment_thread")})
        assert rows(log, "videos_fetched", "comments_fetched") == [(1, 1)]
        assert rows(table("videos"), "title", F.month("published_at")) == [("newest", 1)]
        assert rows(table("video_stats"), F.dayofmonth("fetched_at"), "view_count") == [(1, 5), (2, 50)]
        assert rows(table("channels"), "title") == [("newer",)]
        assert rows(table("channel_stats"), F.dayofmonth("fetched_at"), "view_count") == [(1, 3), (2, 9)]
        assert rows(table("playlists"), "title", "item_count") == [("newer", 2)]
        assert rows(table("comments"), "text", F.dayofmonth("fetched_at")) == [("first", 1)]
        assert rows(table("video_comment_summary"), "latest_youtube_comment_count", F.dayofmonth("last_stats_fetch")) == [(50, 2)]


def test_streams_set_bad_lines_aside(spark, database, folder, rows, caplog):  # noqa: F811
    item = {"id": "v", "fetched_at": DAY1, "statistics": {"viewCount": "5"}}
    write_lines(f"{folder}/in", "1.json", [item, "{broken", {"snippet": {}}])
    ingest.ingest_video_stats(spark, f"{folder}/in", f"{folder}/cp", database).awaitTermination()
    assert rows(spark.table(f"{database}.video_stats"), "video_id", "view_count") == [("v", 5)]
    assert spark.read.parquet(f"{folder}/cp-quarantine/0/lines").first()[0] == "{broken"
    assert spark.read.parquet(f"{folder}/cp-quarantine/0/rows").count() == 1
    assert "1 unreadable lines, 1 rows without a key" in caplog.text
