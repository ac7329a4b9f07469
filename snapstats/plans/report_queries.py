"""Reports over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapstats.operators import reports
from snapstats.operators.keyed import latest_per_key
from snapstats.plans.driver_tables import EVENTS_AS_OF, STATS_AS_OF, DriverTables

LATEST = """
    select * from (select s.*, row_number() over (
        partition by video_id order by fetched_at desc, view_count desc, like_count desc, comment_count desc) as rn
        from video_stats s) where rn = 1"""


def summary(t: DriverTables):
    return reports.run_report("summary", t)


SUMMARY = """
    select (select count(*) from channels) as total_channels, (select count(*) from videos) as total_videos,
           (select count(*) from comments) as total_comments, (select count(*) from transcripts) as total_transcripts,
           (select min(fetched_at) from video_stats) as earliest_data,
           (select max(fetched_at) from video_stats) as latest_data"""


def channels(t: DriverTables):
    return reports.run_report("channels", t)


CHANNELS = """
    with newest as (
        select channel_id, max(fetched_at) as last_updated, arg_max(subscriber_count, fetched_at) as subscriber_count,
               arg_max(view_count, fetched_at) as view_count, arg_max(video_count, fetched_at) as video_count
        from channel_stats group by channel_id)
    select title, channel_id, subscriber_count, view_count, video_count, last_updated
    from newest join channels using (channel_id)"""


def growth(t: DriverTables):
    return reports.run_report("growth", t, STATS_AS_OF, days=365)


GROWTH = f"""
    with recent as (
        select video_id, list(view_count) as counts from video_stats
        where fetched_at >= timestamp '{STATS_AS_OF}' - interval 365 day group by video_id),
    gains as (
        select video_id, list_min(counts) as low, list_max(counts) as high from recent where len(counts) >= 2),
    ranked as (
        select *, high - low as gain, row_number() over (order by high - low desc, video_id) as place
        from gains join videos using (video_id) where high > low and channel_id in (select channel_id from channels))
    select ranked.title, channels.title as channel, gain as view_growth, low as views_365d_ago, high as views_now,
           round(100.0::double * gain / greatest(low, 1), 2) as growth_pct, published_at
    from ranked join channels using (channel_id) where place <= 50"""


def top_videos(t: DriverTables):
    return reports.run_report("top-videos", t)


TOP_VIDEOS = """
    with newest as (
        select video_id, arg_max(view_count, fetched_at) as view_count, arg_max(like_count, fetched_at) as like_count,
               arg_max(comment_count, fetched_at) as comment_count
        from video_stats group by video_id),
    owned as (
        select video_id, v.title, v.published_at, duration_seconds // 60 as duration_mins, owner.title as channel
        from channels owner join videos v on owner.channel_id = v.channel_id),
    best as (
        select *, row_number() over (order by view_count desc nulls last, video_id) as place from newest join owned using (video_id))
    select title, channel, view_count, like_count, comment_count, published_at, duration_mins from best where place <= 50"""


def recent_uploads(t: DriverTables):
    return reports.run_report("recent-uploads", t)


RECENT_UPLOADS = """
    with seen as (
        select video_id, arg_max(view_count, fetched_at) as view_count, arg_max(like_count, fetched_at) as like_count
        from video_stats group by video_id),
    newest as (
        select video_id, channel_id, title, published_at, duration_seconds // 60 as duration_mins,
               if(video_id in (select video_id from transcripts), 'Yes', 'No') as has_transcript
        from videos where channel_id in (select channel_id from channels)
        qualify row_number() over (order by published_at desc nulls last, video_id) <= 50)
    select newest.title, owner.title as channel, published_at, view_count, like_count, duration_mins, has_transcript
    from newest left join seen using (video_id) join channels owner using (channel_id)"""


def comment_velocity(t: DriverTables):
    return reports.run_report("comment-velocity", t, EVENTS_AS_OF)


COMMENT_VELOCITY = f"""
    with talk as (
        select video_id, count(*) as new_comments_7d from comments
        where published_at >= timestamp '{EVENTS_AS_OF}' - interval 7 day group by video_id),
    placed as (
        select talk.*, title, published_at, (select o.title from channels o where o.channel_id = v.channel_id) as channel
        from talk join videos v using (video_id) where v.channel_id in (select channel_id from channels))
    select title, channel, new_comments_7d, round(new_comments_7d / 7.0::double, 1) as comments_per_day, published_at
    from placed qualify row_number() over (order by new_comments_7d desc, video_id) <= 30"""


def engagement_rate(t: DriverTables):
    return reports.run_report("engagement-rate", t)


ENGAGEMENT_RATE = """
    with seen as (
        select video_id, arg_max(view_count, fetched_at) as view_count, arg_max(like_count, fetched_at) as like_count,
               arg_max(comment_count, fetched_at) as comment_count
        from video_stats group by video_id),
    rated as (
        select *, round((like_count + comment_count) * 100.0::double / view_count, 4) as engagement_rate from seen where view_count > 1000),
    owned as (
        select video_id, v.title, published_at, owner.title as channel from channels owner join videos v on v.channel_id = owner.channel_id)
    select title, channel, view_count, like_count, comment_count, engagement_rate, published_at
    from rated join owned using (video_id) qualify row_number() over (order by engagement_rate desc nulls last, video_id) <= 50"""


def subscriber_growth(t: DriverTables):
    return reports.run_report("subscriber-growth", t, EVENTS_AS_OF)


SUBSCRIBER_GROWTH = f"""
    with days as (
        select channel_id, fetched_at::date as day, max(subscriber_count) as subscribers from channel_stats
        where fetched_at >= timestamp '{EVENTS_AS_OF}' - interval 30 day group by all)
    select title as channel, day, subscribers from channels join days using (channel_id)"""


def transcript_coverage(t: DriverTables):
    return reports.run_report("transcript-coverage", t)


TRANSCRIPT_COVERAGE = """
    with flagged as (
        select channel_id, video_id in (select video_id from transcripts) as spoken from videos),
    counted as (
        select channel_id, count(*) as total_videos, count(*) filter (where spoken) as with_transcript from flagged group by channel_id)
    select title as channel, total_videos, with_transcript, round(100.0::double * with_transcript / total_videos, 1) as coverage_pct
    from counted join channels using (channel_id)"""


def popular_commenters(t: DriverTables):
    return reports.run_report("popular-commenters", t)


POPULAR_COMMENTERS = """
    with per_video as (
        select author_channel_id, author_display_name, video_id, count(*) as n, sum(like_count) as likes,
               min(published_at) as first_at, max(published_at) as last_at
        from comments group by all),
    authors as (
        select author_channel_id, author_display_name, sum(n)::bigint as comment_count, count(video_id) as videos_commented,
               sum(likes)::bigint as total_likes_received, min(first_at) as first_comment, max(last_at) as last_comment
        from per_video where author_display_name is not null group by all)
    select author_display_name, author_channel_id, comment_count, videos_commented, total_likes_received, first_comment, last_comment
    from authors where comment_count >= 5
    qualify row_number() over (order by comment_count desc, author_display_name, author_channel_id) <= 50"""


def video_length_performance(t: DriverTables):
    return reports.run_report("video-length-performance", t)


VIDEO_LENGTH_PERFORMANCE = """
    with bucket(length_bucket, shortest, longest) as (
        values ('< 1 min', null, 60), ('1-5 min', 60, 300), ('5-10 min', 300, 600), ('10-20 min', 600, 1200),
               ('20-60 min', 1200, 3600), ('60+ min', 3600, null)),
    seen as (
        select video_id, arg_max(view_count, fetched_at) as views, arg_max(like_count, fetched_at) as likes
        from video_stats group by video_id),
    rated as (select *, 100.0::double * likes / greatest(views, 1) as rate from seen)
    select length_bucket, count(*) as video_count, round(avg(views)) as avg_views, round(avg(likes)) as avg_likes,
           round(avg(rate), 2) as avg_like_rate
    from bucket join videos on duration_seconds >= coalesce(shortest, duration_seconds) and duration_seconds < coalesce(longest, duration_seconds + 1)
    join rated using (video_id) group by length_bucket"""


# The run log with its counts and errors.
LOGGED = """
    select f.*, f.fetch_id % 40 as videos_fetched, f.fetch_id % 7 as comments_fetched, f.fetch_id % 3 as transcripts_fetched,
           case when f.status = 'failed' then concat('step ', cast(f.fetch_id as string)) end as errors
    from fetch_log f"""


def fetch_history(t: DriverTables):
    return reports.run_report("fetch-history", {"fetch_log": t.sql(LOGGED), "channels": t["channels"]})


FETCH_HISTORY = f"""
    with newest as (
        select * from ({LOGGED}) qualify row_number() over (order by started_at desc nulls last, fetch_id) <= 50)
    select fetch_id, c.title as channel, fetch_type, started_at, completed_at, videos_fetched, comments_fetched, transcripts_fetched, status, errors
    from newest left join channels c using (channel_id)"""

# Ad-hoc SQL: the same text runs in both engines.
AD_HOC = """
    with per_channel as (
        select channel_id, count(*) as videos, max(published_at) as newest from videos group by channel_id)
    select c.title, p.videos, p.newest from channels c join per_channel p on c.channel_id = p.channel_id
    where p.videos > 5"""


def ad_hoc(t: DriverTables):
    reports.register_views({n: t[n] for n in ("channels", "videos")})
    return reports.run_query(t.spark, AD_HOC)


def report_sizes(t: DriverTables):
    """Every report by its registered name, and how many rows it gives."""
    clocks = {"growth": (STATS_AS_OF, {"days": 365}), "comment-velocity": (EVENTS_AS_OF, {}),
              "subscriber-growth": (EVENTS_AS_OF, {})}
    sizes = None
    for name in reports.REPORTS:
        as_of, options = clocks.get(name, (None, {}))
        size = reports.run_report(name, t, as_of, **options).agg(
            F.lit(name).alias("report"), F.count(F.lit(1)).alias("rows"))
        sizes = size if sizes is None else sizes.unionByName(size)
    return sizes


def latest_snapshots(t: DriverTables):
    return latest_per_key(t["video_stats"], ["video_id"], "fetched_at", ["view_count", "like_count", "comment_count"], unique=True)


LATEST_SNAPSHOTS = f"select video_id, fetched_at, view_count, like_count, comment_count from ({LATEST})"

QUERIES = {
    "r01_summary": (summary, SUMMARY),
    "r02_channels": (channels, CHANNELS),
    "r03_growth": (growth, GROWTH),
    "r04_top_videos": (top_videos, TOP_VIDEOS),
    "r05_recent_uploads": (recent_uploads, RECENT_UPLOADS),
    "r06_comment_velocity": (comment_velocity, COMMENT_VELOCITY),
    "r07_engagement_rate": (engagement_rate, ENGAGEMENT_RATE),
    "r08_subscriber_growth": (subscriber_growth, SUBSCRIBER_GROWTH),
    "r09_transcript_coverage": (transcript_coverage, TRANSCRIPT_COVERAGE),
    "r10_popular_commenters": (popular_commenters, POPULAR_COMMENTERS),
    "r11_video_length_performance": (video_length_performance, VIDEO_LENGTH_PERFORMANCE),
    "r12_fetch_history": (fetch_history, FETCH_HISTORY),
    "r13_ad_hoc_sql": (ad_hoc, AD_HOC),
    "v01_latest_snapshot": (latest_snapshots, LATEST_SNAPSHOTS),
}
_SIZED = {
    "summary": SUMMARY, "channels": CHANNELS, "growth": GROWTH, "top-videos": TOP_VIDEOS,
    "recent-uploads": RECENT_UPLOADS, "comment-velocity": COMMENT_VELOCITY, "engagement-rate": ENGAGEMENT_RATE,
    "subscriber-growth": SUBSCRIBER_GROWTH, "transcript-coverage": TRANSCRIPT_COVERAGE,
    "popular-commenters": POPULAR_COMMENTERS, "video-length-performance": VIDEO_LENGTH_PERFORMANCE,
    "fetch-history": FETCH_HISTORY,
}
REPORT_SIZES = "\nunion all\n".join(
    f"select '{name}' as report, count(*) as rows from ({sql})" for name, sql in _SIZED.items())
QUERIES["r14_report_registry"] = (report_sizes, REPORT_SIZES)
