"""Work planning: tier borders, listings, identifiers."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from snapstats.operators import planning

NOW = "2026-01-31 00:00:00"


def ago(**delta):
    return dt.datetime(2026, 1, 31) - dt.timedelta(**delta)


def videos_at(spark, *times):
    return spark.createDataFrame([(i, 1, t) for i, t in enumerate(times)],
                                 "video_id bigint, channel_id bigint, published_at timestamp_ntz")


def test_tier_borders(spark):
    df = videos_at(spark, ago(days=-1), ago(days=2), ago(days=2, seconds=1), ago(days=7), ago(days=7, seconds=1),
                   ago(days=30), ago(days=30, seconds=1), None)
    clock = planning.moment_for(df, "published_at", NOW)
    for tiers, otherwise, expected in (
            (planning.COMMENT_TIERS, 168, [6, 6, 12, 12, 48, 48, 168, 168]),
            (planning.STATS_TIERS, 24, [0, 0, 6, 6, 12, 12, 24, 24])):
        hours = planning.refresh_hours(F.col("published_at"), clock, tiers, otherwise)
        assert [r[0] for r in df.orderBy("video_id").select(hours).collect()] == expected


SUMMARY = ("video_id bigint, stored_comment_count bigint, last_comment_fetch timestamp_ntz, "
           "latest_youtube_comment_count bigint, last_stats_fetch timestamp_ntz")


def test_comments_due(spark, rows):
    videos = videos_at(spark, *[ago(days=1)] * 6)
    summary = spark.createDataFrame([
        (0, 5, None, 8, None),               # never fetched
        (1, 5, ago(hours=6), 8, None),       # exactly six hours: not yet
        (2, 5, ago(hours=6, seconds=1), 8, None),
        (3, 8, None, 8, None),               # nothing new
        (4, None, None, 1, None),            # only one new
    ], SUMMARY)
    assert rows(planning.videos_needing_comments(videos, summary, NOW), "video_id") == [(0,), (2,), (4,)]
    assert rows(planning.videos_needing_comments(videos, summary, NOW, min_new_comments=3), "video_id") == [(0,), (2,)]
    assert rows(planning.videos_needing_comments(videos, summary, NOW, limit=1), "video_id") == [(0,)]
    assert rows(planning.videos_needing_comments(videos, summary, NOW, channel_id=2)) == []


def test_stats_due(spark, rows):
    videos = videos_at(spark, ago(days=1), ago(days=3), ago(days=3), ago(days=3))
    summary = spark.createDataFrame([
        (0, 0, None, 0, ago(seconds=1)), (1, 0, None, 0, ago(hours=6)), (2, 0, None, 0, ago(hours=7))], SUMMARY)
    due = planning.videos_needing_stats(videos, summary, NOW)
    assert rows(due, "video_id") == [(0,), (2,), (3,)]
    assert rows(planning.tier_breakdown(due)) == [(1, 0, 1), (1, 6, 2)]


def test_refresh_flags(spark, rows):
    channels = spark.createDataFrame([(1,), (2,), (3,)], "channel_id bigint")
    stats = spark.createDataFrame([(1, ago(hours=6)), (2, ago(hours=6, seconds=1)), (2, ago(days=9))],
                                  "channel_id bigint, fetched_at timestamp")
    lists = spark.createDataFrame([(1, ago(hours=25)), (3, ago(hours=24))], "channel_id bigint, updated_at timestamp")
    flags = planning.channel_refresh_flags(channels, stats, lists, NOW)
    assert rows(flags, "channel_id", "stats_due", "playlists_due") == [(1, False, True), (2, True, True), (3, True, False)]


def stored(spark, *entries):
    return spark.createDataFrame(list(entries), "channel_id bigint, video_id bigint, privacy_status string")


def test_discovery_ignores_deleted_rows(spark, rows):
    videos = stored(spark, (1, 10, "public"), (1, 11, "deleted"), (2, 20, None))
    remote = spark.createDataFrame([(1, 1), (2, 2), (3, 0), (4, None)], "channel_id bigint, video_count bigint")
    assert rows(planning.discovery_needed(remote, videos), "channel_id", "needs_discovery") == [
        (1, False), (2, True), (3, True), (4, True)]
    assert all(r["needs_discovery"] for r in planning.discovery_needed(remote, videos, backfill=True).collect())


def test_vanished_only_from_complete_listings(spark, rows):
    videos = stored(spark, (1, 10, "public"), (1, 11, "public"), (1, 12, "deleted"), (2, 20, "public"))
    listing = spark.createDataFrame([(1, 10)], "channel_id bigint, video_id bigint")
    complete = spark.createDataFrame([(1,)], "channel_id bigint")
    assert rows(planning.vanished_video_ids(videos, listing, complete)) == [(1, 11)]
    assert rows(planning.new_video_ids(listing, videos)) == []


@pytest.mark.parametrize("limit", [None, 2])
def test_prefix_before_known_matches_a_walk(spark, rows, limit):
    listing = [(c, c * 100 + i, ago(hours=i), i) for c in (1, 2, 3) for i in range(6)]
    known = {103, 105, 200}
    expected = []
    for channel, entries in itertools.groupby(listing, key=lambda e: e[0]):
        fresh = list(itertools.takewhile(lambda e: e[1] not in known, entries))
        expected += [(channel, e[1]) for e in fresh[:limit]]
    df = spark.createDataFrame(listing, "channel_id bigint, video_id bigint, published_at timestamp_ntz, position int")
    have = spark.createDataFrame([(k,) for k in known], "video_id bigint")
    assert rows(planning.before_first_known(df, have, limit), "channel_id", "video_id") == expected
    assert rows(planning.before_first_known(df.drop("position"), have, limit), "channel_id", "video_id") == expected


def test_recent_only_keeps_undated(spark, rows):
    texts = spark.createDataFrame([(1, "2026-01-30T00:00:00Z"), (2, "2020-01-01"), (3, "someday"), (4, None), (5, "")],
                                  "video_id int, published_at string")
    assert rows(planning.recent_only(texts, 30, NOW), "video_id") == [(1,), (3,), (4,), (5,)]


def test_resolve_against_brute_force(spark):
    channels = [(str(i), f"@{w}_{i}", t) for i, (w, t) in enumerate([
        ("alpha", "Alpha Beta"), ("beta", "100% Sure"), ("gamma", None), ("Delta", "a_b"), ("eps", "aXb"), ("ab", "É")])]
    channels.append(("77", None, "Unnamed"))
    given = ["@alpha", "BETA", "100%", "a_b", "a", "_", "zz", "3", "@", "ALPHA BETA", "é", "77", "gamma_2x", "@@eps"]

    def fold(value):
        return "".join(c.lower() if c.isascii() else c for c in value)

    def brute(identifier):
        if identifier in {c[0] for c in channels}:
            return identifier
        needle = fold(identifier.lstrip("@"))
        hits = [c[0] for c in channels for value in c[1:] if value is not None and needle in fold(value)]
        return min(hits, default=None)

    found = planning.resolve_channels(
        spark.createDataFrame([(g,) for g in given], "identifier string"),
        spark.createDataFrame(channels, "channel_id string, custom_url string, title string")).collect()
    assert {r["identifier"]: r["channel_id"] for r in found} == {g: brute(g) for g in given}


def test_parts_of_names_are_dealt_over_all_tasks(spark, rows):
    channels = spark.range(40).coalesce(1).select(F.col("id").alias("channel_id"), F.concat(F.lit("@name_"), F.col("id")).alias("custom_url"),
                                                  F.lit("Shared title").alias("title"))
    given = spark.createDataFrame([("@name_3",), ("AME_39",), ("ed",), ("title x",), ("7",), ("\u00e9",)], "identifier string")
    found = planning.resolve_channels(given, channels)
    assert dict(rows(found)) == {"@name_3": 3, "AME_39": 39, "ed": 0, "title x": None, "7": 7, "\u00e9": None}
    # A list of channels in one file used to be unfolded by one task.
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().toString()


def test_large_limits_take_the_salted_path(spark, rows):
    listing = spark.range(5000).select(F.lit(1).alias("channel_id"), F.col("id").alias("video_id"), F.col("id").alias("position"))
    first = planning.first_listed(listing, 1500)
    assert rows(first.agg(F.count("*"), F.max("position"))) == [(1500, 1499)]
