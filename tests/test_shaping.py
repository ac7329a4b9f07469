"""Payloads, comment threads and transcript tracks against plain Python."""

import json

import pytest

from snapstats.operators import shaping


def threads_frame(spark, threads):
    raw = spark.createDataFrame([(v, p, json.dumps(t)) for v, p, t in threads], "video_id int, position int, json string")
    return shaping.parsed(raw, "comment_thread")


def thread(key, replies=0, at="2026-01-01T00:00:00Z", author="a"):
    snippet = {"textDisplay": key, "likeCount": 2, "publishedAt": at}
    if author:
        snippet["authorChannelId"] = {"value": author}
    item = {"id": key, "snippet": {"topLevelComment": {"snippet": snippet}}}
    if replies:
        item["replies"] = {"comments": [
            {"id": f"{key}.{i}", "snippet": {"textDisplay": "r", "publishedAt": "2020-01-01T00:00:00Z"}} for i in range(replies)]}
    return item


def test_threads_to_rows(spark, rows):
    df = threads_frame(spark, [(1, 0, thread("a", 3)), (1, 1, thread("b", author=None))])
    got = rows(shaping.comment_rows(df, 2), "comment_id", "parent_comment_id", "author_channel_id", "like_count")
    assert got == [("a", None, "a", 2), ("a.0", "a", None, 0), ("a.1", "a", None, 0), ("b", None, None, 2)]


def test_since_keeps_old_replies_of_new_threads(spark, rows):
    df = threads_frame(spark, [(1, 0, thread("new", 1)), (1, 1, thread("same", at="2025-12-31T00:00:00Z")),
                               (1, 2, thread("undated", at=None)), (2, 0, thread("first"))])
    latest = spark.sql("select 1 as video_id, timestamp '2025-12-31 00:00:00' as latest_comment_at")
    kept = shaping.comment_rows(shaping.threads_since(df, latest))
    assert rows(kept, "comment_id") == [("first",), ("new",), ("new.0",), ("undated",)]


@pytest.mark.parametrize("cap", [1, 3, 4, 100])
def test_cap_matches_a_walk(spark, rows, cap):
    threads = [(v, p, thread(f"{v}-{p}", (v * p) % 4)) for v in (1, 2) for p in range(8)]
    expected = []
    for video in (1, 2):
        taken = 0
        for v, _, t in (x for x in threads if x[0] == video):
            if taken >= cap:
                break
            expected.append((t["id"],))
            taken += 1 + min(2, len(t.get("replies", {}).get("comments", [])))
    got = shaping.capped_threads(threads_frame(spark, threads), cap, 2).select("item.id")
    assert rows(got) == sorted(expected, key=repr)


def test_track_choice(spark, rows):
    tracks = spark.createDataFrame([
        (1, "German", "de", False, True, 0), (1, "English", "en", True, True, 1), (1, "UK", "en-GB", False, True, 2),
        (2, "US", "en-US", True, False, 0), (2, "English", "en", True, False, 1),
        (3, "French", "fr", True, False, 0), (3, "Thai", "th", True, True, 1), (3, "Dutch", "nl", False, True, 2),
        (4, "French", "fr", False, False, 0)],
        "video_id int, language string, language_code string, is_generated boolean, is_translatable boolean, position int")
    chosen = shaping.choose_track(tracks)
    assert rows(chosen, "video_id", "transcript_type", "language", "language_code", "original_language_code") == [
        (1, "manual", "UK", "en-GB", None), (2, "auto-generated", "English", "en", None),
        (3, "translated", "English (translated)", "en", "th")]
    assert rows(shaping.success_breakdown(chosen)) == [("auto-generated", 1), ("manual", 1), ("translated", 1)]


def test_transcript_segments(spark):
    df = spark.createDataFrame([(1, [(0.0, 1.5, "a"), (1.5, 2.0, "b c")]), (2, [])],
                               "video_id int, segments array<struct<start: double, duration: double, text: string>>")
    got = {r["video_id"]: r for r in shaping.transcript_rows(df).collect()}
    assert got[1]["full_text"] == "a b c" and got[1]["snippet_count"] == 2
    assert [e["end"] for e in got[1]["entries"]] == [1.5, 3.5]
    assert got[2]["full_text"] == "" and got[2]["snippet_count"] == 0


def test_video_payload_defaults(spark):
    raw = [json.dumps(p) for p in (
        {"id": "v1"}, {"id": ""}, {"snippet": {"title": "no id"}},
        {"id": "v2", "contentDetails": {"caption": "true", "duration": "P1D"}, "statistics": {"viewCount": "7", "likeCount": "x"},
         "snippet": {"thumbnails": {"default": {"url": "d"}}, "description": "0:00 a", "tags": ["t"]},
         "status": {"embeddable": True}})]
    items = shaping.parsed(spark.createDataFrame([(r,) for r in raw], "json string"), "video")
    videos = shaping.video_rows(items)
    good = {r["video_id"]: r for r in shaping.valid_rows(videos, "video_id").collect()}
    assert set(good) == {"v1", "v2"} and shaping.rejected_rows(videos, "video_id").count() == 2
    one, two = good["v1"], good["v2"]
    assert (one["tags"], one["view_count"], one["embeddable"], one["caption_available"], one["has_chapters"]) == ([], 0, False, False, False)
    assert (one["duration_iso"], one["duration_seconds"], one["thumbnail_url"]) == ("", None, None)
    assert (two["tags"], two["view_count"], two["like_count"], two["embeddable"], two["caption_available"]) == (["t"], 7, 0, True, True)
    assert (two["duration_seconds"], two["thumbnail_url"], two["has_chapters"]) == (None, "d", True)


def test_listing_pages(spark, rows):
    pages = [(1, 1, {"items": [{"contentDetails": {"videoId": "c"}}]}),
             (1, 0, {"items": [{"contentDetails": {"videoId": "b"}}, {"contentDetails": {}}, {}, {"contentDetails": {"videoId": "a"}}]})]
    raw = spark.createDataFrame([(c, n, json.dumps(p)) for c, n, p in pages], "channel_id int, page_number int, json string")
    ids = shaping.listed_ids(shaping.parsed(raw, "playlist_page")).orderBy("position")
    assert [r["video_id"] for r in ids.collect()] == ["b", "a", "c"]


def test_outcomes(spark, rows):
    df = spark.createDataFrame(
        [(i, False, True, "Too Many requests") for i in range(7)]
        + [(10, True, False, "manual (en)"), (11, False, False, "Transcripts disabled by uploader"),
           (12, False, False, "Video unavailable"), (13, False, True, "reset by peer"), (14, False, False, None)],
        "video_id int, available boolean, failed boolean, reason string")
    classed = shaping.classify_outcomes(df)
    assert rows(shaping.outcome_totals(classed)) == [(12, 1, 2, 1, 7, 1, 8.3)]
    shown = {r["outcome"]: [e["video_id"] for e in r["examples"]] for r in shaping.failure_breakdown(classed).collect()}
    assert shown == {"blocked": [0, 1, 2], "disabled": [11], "unavailable": [12, 14], "error": [13]}


def test_cap_settles_on_keys_only(spark):
    plan = shaping.capped_threads(threads_frame(spark, [(1, 0, thread("a"))]), 3)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window" in line]
    assert windows and not any("item" in line for line in windows)
