"""The canned reports. Each takes the tables by name and an as-of time and returns a DataFrame.

Column names are those a reader of the reports knows. Every cut to a top list ends its sort on the
primary key, so the result is the same on every run.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapstats.functions.numeric import at_least, percent, whole_div
from snapstats.functions.timeutil import AsOf, since
from snapstats.operators.keyed import latest_per_key

Tables = Mapping[str, DataFrame]

# Report labels and their upper bounds in seconds (fixed values, in reading order).
LENGTH_BUCKETS = [("< 1 min", 60), ("1-5 min", 300), ("5-10 min", 600), ("10-20 min", 1200), ("20-60 min", 3600)]
LAST_BUCKET = "60+ min"


def latest_video_stats(tables: Tables, *columns: str) -> DataFrame:
    return latest_per_key(tables["video_stats"], ["video_id"], "fetched_at", columns, unique=True)


def latest_channel_stats(tables: Tables, *columns: str) -> DataFrame:
    return latest_per_key(tables["channel_stats"], ["channel_id"], "fetched_at", columns, unique=True)


def _channel_titles(tables: Tables) -> DataFrame:
    return tables["channels"].select("channel_id", F.col("title").alias("channel"))


def _videos(tables: Tables, *columns: str) -> DataFrame:
    return tables["videos"].select("video_id", "channel_id", *columns)


def summary(tables: Tables, as_of: AsOf = None) -> DataFrame:
    """Row counts of the main tables and the span of the video snapshots, in one row."""
    counts = {"channels": "total_channels", "videos": "total_videos",
              "comments": "total_comments", "transcripts": "total_transcripts"}
    parts = [tables[t].agg(F.count(F.lit(1)).alias(name)) for t, name in counts.items()]
    parts.append(tables["video_stats"].agg(
        F.min("fetched_at").alias("earliest_data"), F.max("fetched_at").alias("latest_data")))
    # Each part is one row with its own columns; folding the union puts them side by side.
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def channels(tables: Tables, as_of: AsOf = None) -> DataFrame:
    """All channels that have statistics, with the latest ones."""
    stats = latest_channel_stats(tables, "subscriber_count", "view_count", "video_count")
    return (
        tables["channels"].select("channel_id", "title").join(stats, "channel_id")
        .orderBy(F.desc_nulls_last("subscriber_count"), F.asc("channel_id"))
        .select("title", "channel_id", "subscriber_count", "view_count", "video_count",
                F.col("fetched_at").alias("last_updated"))
    )


def growth(tables: Tables, as_of: AsOf = None, days: int = 7, limit: int = 50) -> DataFrame:
    """Videos by growth between the smallest and largest view count of the window."""
    stats = tables["video_stats"]
    spans = (
        stats.filter(since(stats, "fetched_at", as_of, days))
        .groupBy("video_id")
        .agg(F.min("view_count").alias("_start"), F.max("view_count").alias("_end"),
             F.count(F.lit(1)).alias("_snapshots"))
        .filter((F.col("_snapshots") >= 2) & (F.col("_end") > F.col("_start")))
    )
    gain = F.col("_end") - F.col("_start")
    return (
        spans.join(_videos(tables, "title", "published_at"), "video_id")
        .join(_channel_titles(tables), "channel_id")
        .orderBy(gain.desc(), F.asc("video_id")).limit(limit)
        .select("title", "channel", gain.alias("view_growth"), F.col("_start").alias(f"views_{days}d_ago"),
                F.col("_end").alias("views_now"), percent(gain, F.col("_start"), 2).alias("growth_pct"),
                "published_at")
    )


def top_videos(tables: Tables, as_of: AsOf = None, limit: int = 50) -> DataFrame:
    """Videos by current view count."""
    return (
        _videos(tables, "title", "published_at", "duration_seconds")
        .join(latest_video_stats(tables, "view_count", "like_count", "comment_count"), "video_id")
        .join(_channel_titles(tables), "channel_id")
        .orderBy(F.desc_nulls_last("view_count"), F.asc("video_id")).limit(limit)
        .select("title", "channel", "view_count", "like_count", "comment_count", "published_at",
                whole_div(F.col("duration_seconds"), 60).alias("duration_mins"))
    )


def recent_uploads(tables: Tables, as_of: AsOf = None, limit: int = 50) -> DataFrame:
    """Newest videos with their latest statistics, whether or not they have any.

    The statistics and transcripts add columns but never rows, so the list is cut first and the large
    tables are only filtered by its ids.
    """
    order = [F.desc_nulls_last("published_at"), F.asc("video_id")]
    recent = (
        _videos(tables, "title", "published_at", "duration_seconds")
        .join(_channel_titles(tables), "channel_id").orderBy(*order).limit(limit)
    )
    ids = recent.select("video_id")
    stats = latest_per_key(tables["video_stats"].join(ids, "video_id", "left_semi"), ["video_id"], "fetched_at",
                           ["view_count", "like_count"], unique=True).drop("fetched_at")
    spoken = (tables["transcripts"].select("video_id").join(ids, "video_id", "left_semi").distinct()
              .withColumn("_has", F.lit(True)))
    return (
        recent.join(stats, "video_id", "left").join(spoken, "video_id", "left").orderBy(*order)
        .select("title", "channel", "published_at", "view_count", "like_count",
                whole_div(F.col("duration_seconds"), 60).alias("duration_mins"),
                F.when(F.col("_has"), "Yes").otherwise("No").alias("has_transcript"))
    )


def comment_velocity(tables: Tables, as_of: AsOf = None, days: int = 7, limit: int = 30) -> DataFrame:
    """Videos by comments published in the window. Comments are counted before any join."""
    comments = tables["comments"]
    counts = (
        comments.filter(since(comments, "published_at", as_of, days))
        .groupBy("video_id").agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        counts.join(_videos(tables, "title", "published_at"), "video_id")
        .join(_channel_titles(tables), "channel_id")
        .orderBy(F.desc("_n"), F.asc("video_id")).limit(limit)
        .select("title", "channel", F.col("_n").alias(f"new_comments_{days}d"),
                F.round(F.col("_n") / F.lit(float(days)), 1).alias("comments_per_day"), "published_at")
    )


def engagement_rate(tables: Tables, as_of: AsOf = None, min_views: int = 1000, limit: int = 50) -> DataFrame:
    """Videos by likes and comments per view, among those with enough views."""
    rate = percent(F.col("like_count") + F.col("comment_count"), F.col("view_count"), 4)
    return (
        latest_video_stats(tables, "view_count", "like_count", "comment_count")
        .filter(F.col("view_count") > min_views)
        .withColumn("engagement_rate", rate)
        .join(_videos(tables, "title", "published_at"), "video_id")
        .join(_channel_titles(tables), "channel_id")
        .orderBy(F.desc_nulls_last("engagement_rate"), F.asc("video_id")).limit(limit)
        .select("title", "channel", "view_count", "like_count", "comment_count", "engagement_rate", "published_at")
    )


def subscriber_growth(tables: Tables, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """Highest subscriber count per channel and day of the window."""
    stats = tables["channel_stats"]
    daily = (
        stats.filter(since(stats, "fetched_at", as_of, days))
        .groupBy("channel_id", F.to_date("fetched_at").alias("day"))
        .agg(F.max("subscriber_count").alias("subscribers"))
    )
    return (
        daily.join(_channel_titles(tables), "channel_id")
        .orderBy("channel", "day", "channel_id").select("channel", "day", "subscribers")
    )


def transcript_coverage(tables: Tables, as_of: AsOf = None) -> DataFrame:
    """Share of each channel's videos that have a transcript."""
    spoken = tables["transcripts"].select("video_id", F.col("video_id").alias("_spoken"))
    counts = (
        _videos(tables).join(spoken, "video_id", "left")
        .groupBy("channel_id")
        .agg(F.count("video_id").alias("total_videos"), F.count("_spoken").alias("with_transcript"))
    )
    return (
        counts.join(_channel_titles(tables), "channel_id")
        .orderBy(F.desc("total_videos"), F.asc("channel_id"))
        .select("channel", "total_videos", "with_transcript",
                percent(F.col("with_transcript"), F.col("total_videos"), 1).alias("coverage_pct"))
    )


def popular_commenters(tables: Tables, as_of: AsOf = None, min_comments: int = 5, limit: int = 50) -> DataFrame:
    """Most active named commenters; the count of videos is exact."""
    return (
        tables["comments"].filter(F.col("author_display_name").isNotNull())
        .groupBy("author_display_name", "author_channel_id")
        .agg(F.count(F.lit(1)).alias("comment_count"), F.countDistinct("video_id").alias("videos_commented"),
             F.sum("like_count").alias("total_likes_received"), F.min("published_at").alias("first_comment"),
             F.max("published_at").alias("last_comment"))
        .filter(F.col("comment_count") >= min_comments)
        .orderBy(F.desc("comment_count"), F.asc("author_display_name"), F.asc("author_channel_id")).limit(limit)
    )


def length_bucket(seconds: Column) -> Column:
    label = F
    for name, below in LENGTH_BUCKETS:
        label = label.when(seconds < below, name)
    return label.otherwise(LAST_BUCKET)


def video_length_performance(tables: Tables, as_of: AsOf = None) -> DataFrame:
    """Average views, likes and like rate per length bucket, shortest first."""
    names = [name for name, _ in LENGTH_BUCKETS] + [LAST_BUCKET]
    position = F.array_position(F.lit(names), F.col("length_bucket"))
    like_rate = F.lit(100.0) * F.col("like_count") / at_least(F.col("view_count"), 1)
    return (
        tables["videos"].filter(F.col("duration_seconds").isNotNull())
        .select("video_id", length_bucket(F.col("duration_seconds")).alias("length_bucket"))
        .join(latest_video_stats(tables, "view_count", "like_count"), "video_id")
        .groupBy("length_bucket")
        .agg(F.count(F.lit(1)).alias("video_count"), F.round(F.avg("view_count")).alias("avg_views"),
             F.round(F.avg("like_count")).alias("avg_likes"), F.round(F.avg(like_rate), 2).alias("avg_like_rate"))
        .orderBy(position)
    )


def fetch_history(tables: Tables, as_of: AsOf = None, limit: int = 50) -> DataFrame:
    """Latest runs. The log is cut first: naming the channel adds no rows."""
    wanted = ["fetch_type", "started_at", "completed_at", "videos_fetched", "comments_fetched",
              "transcripts_fetched", "status", "errors"]
    log = tables["fetch_log"]
    order = [F.desc_nulls_last("started_at"), F.asc("fetch_id")]
    return (
        log.orderBy(*order).limit(limit).join(_channel_titles(tables), "channel_id", "left").orderBy(*order)
        .select("fetch_id", "channel", *[c for c in wanted if c in log.columns])
    )


@dataclass(frozen=True)
class Report:
    description: str
    build: Callable[..., DataFrame]
    tables: tuple[str, ...]


REPORTS: dict[str, Report] = {
    "summary": Report("Row counts and the span of the snapshots", summary,
                      ("channels", "videos", "comments", "transcripts", "video_stats")),
    "channels": Report("Channels with their newest statistics", channels, ("channels", "channel_stats")),
    "growth": Report("Views gained per video within the window", growth, ("video_stats", "videos", "channels")),
    "top-videos": Report("Most viewed videos by their newest snapshot", top_videos, ("videos", "channels", "video_stats")),
    "recent-uploads": Report("Newest videos, with statistics where there are any", recent_uploads,
                             ("videos", "channels", "video_stats", "transcripts")),
    "comment-velocity": Report("Videos by comments published within the window", comment_velocity,
                               ("comments", "videos", "channels")),
    "engagement-rate": Report("Likes and comments per hundred views", engagement_rate,
                              ("videos", "channels", "video_stats")),
    "subscriber-growth": Report("Highest subscriber count per channel and day", subscriber_growth,
                                ("channel_stats", "channels")),
    "transcript-coverage": Report("Share of each channel's videos with a transcript", transcript_coverage,
                                  ("channels", "videos", "transcripts")),
    "popular-commenters": Report("Commenters by number of comments", popular_commenters, ("comments",)),
    "video-length-performance": Report("Average views and likes by length of video", video_length_performance,
                                       ("videos", "video_stats")),
    "fetch-history": Report("Latest runs of the crawl", fetch_history, ("fetch_log", "channels")),
}


def run_report(name: str, tables: Tables, as_of: AsOf = None, **options) -> DataFrame:
    if name not in REPORTS:
        raise ValueError(f"Unknown report {name!r}; known: {', '.join(REPORTS)}")
    return REPORTS[name].build(tables, as_of, **options)


def list_reports(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, r.description) for n, r in REPORTS.items()], "report string, description string")


def register_views(tables: Tables) -> None:
    """Make the tables visible to ad-hoc SQL under their own names, for this session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_query(spark: SparkSession, query: str, allow_unsafe: bool = False) -> DataFrame:
    """Ad-hoc SQL over the registered views; reading only, unless `allow_unsafe`.

    The check comes before anything is run. `WITH` may also open a write, so such a text must be
    usable as a subquery, which only a read is.
    """
    text = query.strip().rstrip(";").rstrip()
    if not allow_unsafe:
        word = text.split(None, 1)[0].upper() if text else ""
        if word not in ("SELECT", "WITH"):
            raise ValueError("Only SELECT queries are allowed; pass allow_unsafe=True for other statements.")
        if word == "WITH":
            spark.sql(f"SELECT * FROM (\n{text}\n)")
    return spark.sql(text)
