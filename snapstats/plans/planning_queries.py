"""Work planning over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapstats.operators import planning
from snapstats.plans.driver_tables import EVENTS_AS_OF, PLAN_AS_OF, DriverTables

NOW = f"timestamp '{PLAN_AS_OF}'"
REMAINING_QUOTA = 40


def _hours(tiers: list, otherwise: int, column: str = "v.published_at") -> str:
    """The tier rule spelled out for the default tiers: 2, 7 and 30 days."""
    first, second, third, last = [h for _, h in tiers]
    return f"""case when {column} >= {NOW} - interval 2 day then {first}
             when {column} < {NOW} - interval 2 day and {column} >= {NOW} - interval 7 day then {second}
             when {column} < {NOW} - interval 7 day and {column} >= {NOW} - interval 30 day then {third}
             when {column} < {NOW} - interval 30 day then {last} else {otherwise} end"""


COMMENT_HOURS = _hours(planning.COMMENT_TIERS, planning.COMMENT_HOURS_OTHERWISE)
STATS_HOURS = _hours(planning.STATS_TIERS, planning.STATS_HOURS_OTHERWISE)


def refresh_hours(t: DriverTables):
    v = t["videos"]
    clock = planning.moment_for(v, "published_at", PLAN_AS_OF)
    tiers = {"comment_hours": (planning.COMMENT_TIERS, planning.COMMENT_HOURS_OTHERWISE),
             "stats_hours": (planning.STATS_TIERS, planning.STATS_HOURS_OTHERWISE)}
    return v.select("video_id", *[planning.refresh_hours(F.col("published_at"), clock, *rule).alias(name)
                                  for name, rule in tiers.items()])


REFRESH_HOURS = f"select v.video_id, {COMMENT_HOURS} as comment_hours, {STATS_HOURS} as stats_hours from videos v"


def needing_comments(t: DriverTables):
    return planning.videos_needing_comments(t["plan_videos"], t["plan_summary"], PLAN_AS_OF, min_new_comments=2, limit=3)


def _needing_comments_sql(minimum: int) -> str:
    return f"""
    select v.video_id, v.channel_id, v.published_at, coalesce(s.latest_youtube_comment_count, 0) as listed_count,
           coalesce(s.stored_comment_count, 0) as stored_count, {COMMENT_HOURS} as tier_refresh_hours
    from plan_videos v left join plan_summary s on v.video_id = s.video_id
    where coalesce(s.latest_youtube_comment_count, 0) > coalesce(s.stored_comment_count, 0)
      and coalesce(s.latest_youtube_comment_count, 0) - coalesce(s.stored_comment_count, 0) >= {minimum}
      and (s.last_comment_fetch is null or s.last_comment_fetch < {NOW} - to_hours({COMMENT_HOURS}))"""


NEEDING_COMMENTS = f"""
    select video_id, channel_id, published_at, listed_count, stored_count, tier_refresh_hours from (
        select *, row_number() over (partition by channel_id order by published_at desc nulls last, video_id) as rn
        from ({_needing_comments_sql(2)})) where rn <= 3"""


def needing_stats(t: DriverTables):
    return planning.videos_needing_stats(t["plan_videos"], t["plan_summary"], PLAN_AS_OF)


NEEDING_STATS = f"""
    select v.video_id, v.channel_id, v.published_at, {STATS_HOURS} as tier_refresh_hours
    from plan_videos v left join plan_summary s on v.video_id = s.video_id
    where s.last_stats_fetch is null or s.last_stats_fetch < {NOW} - to_hours({STATS_HOURS})"""


def tier_breakdown(t: DriverTables):
    return planning.tier_breakdown(needing_stats(t))


TIER_BREAKDOWN = f"""
    select channel_id, tier_refresh_hours, count(*) as videos from ({NEEDING_STATS})
    group by channel_id, tier_refresh_hours"""


def without_transcripts(t: DriverTables):
    return planning.videos_without_transcripts(t["videos"], t["transcripts"])


WITHOUT_TRANSCRIPTS = """
    select v.video_id, v.channel_id from videos v left join transcripts t on v.video_id = t.video_id
    where t.video_id is null"""


def needing_transcripts(t: DriverTables):
    return planning.videos_needing_transcripts(t["videos"], t["channels"], t["transcripts"], limit=100)


NEEDING_TRANSCRIPTS = """
    select video_id, title, channel from (
        select v.video_id, v.title, c.title as channel, v.published_at
        from videos v join channels c on v.channel_id = c.channel_id
        left join transcripts t on v.video_id = t.video_id where t.video_id is null
        order by v.published_at desc nulls last, v.video_id limit 100)"""


def last_fetch(t: DriverTables):
    return planning.last_fetch_times(t["channels"], t["fetch_log"])


LAST_FETCH = """
    select c.channel_id, max(f.completed_at) as last_fetch,
           case when max(f.completed_at) is null then 'backfill' else 'incremental' end as fetch_type
    from channels c left join fetch_log f on c.channel_id = f.channel_id and f.status = 'completed'
    group by c.channel_id"""


def latest_publish(t: DriverTables):
    return planning.latest_publish_dates(t["videos"])


LATEST_PUBLISH = "select channel_id, max(published_at) as latest_published_at from videos group by channel_id"


def stored_ids(t: DriverTables):
    return planning.stored_video_ids(t["videos"])


STORED_IDS = "select channel_id, video_id from videos"


def latest_comments(t: DriverTables):
    return planning.latest_comment_times(t["comments"])


LATEST_COMMENTS = "select video_id, max(published_at) as latest_comment_at from comments group by video_id"


# Playlists looked at some hours ago.
LISTS_SEEN = f"""
    select p_partkey as playlist_id, p_partkey % 100 as channel_id,
           timestamp '{EVENTS_AS_OF}' - cast(p_size as int) * interval '1' hour as updated_at
    from part"""


def refresh_flags(t: DriverTables):
    return planning.channel_refresh_flags(t["channels"], t["channel_stats"], t.sql(LISTS_SEEN), EVENTS_AS_OF)


REFRESH_FLAGS = f"""
    with stats as (select channel_id, max(fetched_at) as last_stats from channel_stats group by channel_id),
    lists as (select channel_id, max(updated_at) as last_playlists from ({LISTS_SEEN}) group by channel_id)
    select channel_id, last_stats, coalesce(last_stats < timestamp '{EVENTS_AS_OF}' - interval 6 hour, true) as stats_due,
           last_playlists, coalesce(last_playlists < timestamp '{EVENTS_AS_OF}' - interval 24 hour, true) as playlists_due
    from channels left join stats using (channel_id) left join lists using (channel_id)"""


def _remote_counts(t: DriverTables):
    return t["listing"].groupBy("channel_id").agg(F.count(F.lit(1)).alias("video_count"))


REMOTE = "select channel_id, count(*) as video_count from listing group by channel_id"


def discovery(t: DriverTables):
    return planning.discovery_needed(_remote_counts(t), t["stored_videos"])


DISCOVERY = f"""
    select r.channel_id, r.video_count as remote_count, coalesce(s.n, 0) as stored_count,
           not (r.video_count = coalesce(s.n, 0) and coalesce(s.n, 0) > 0) as needs_discovery
    from ({REMOTE}) r left join (
        select channel_id, count(*) as n from stored_videos where privacy_status <> 'deleted' group by channel_id) s
    on r.channel_id = s.channel_id"""


def new_ids(t: DriverTables):
    return planning.new_video_ids(t["listing"], t["stored_videos"])


NEW_IDS = """
    select channel_id, video_id from listing where video_id not in (select video_id from stored_videos)"""


def vanished_ids(t: DriverTables):
    """Listings of building-trade customers are taken to be cut short."""
    complete = t["channels"].filter(F.col("country") != "BUILDING")
    return planning.vanished_video_ids(t["stored_videos"], t["listing"], complete)


VANISHED_IDS = """
    select channel_id, video_id from stored_videos
    where privacy_status <> 'deleted' and video_id not in (select video_id from listing)
      and channel_id in (select channel_id from channels where country <> 'BUILDING')"""


def before_known(t: DriverTables):
    listing = t["listing"].drop("position")
    return planning.before_first_known(listing, t["stored_videos"].filter(F.col("privacy_status") == "deleted"), limit=5)


BEFORE_KNOWN = """
    select channel_id, video_id, published_at from (
        select l.*, row_number() over w as rn,
               max(case when s.video_id is null then 0 else 1 end) over (w rows unbounded preceding) as seen
        from listing l left join (select video_id from stored_videos where privacy_status = 'deleted') s
          on l.video_id = s.video_id
        window w as (partition by l.channel_id order by l.published_at desc nulls last, l.video_id desc))
    where seen = 0 and rn <= 5"""


def listing_cap(t: DriverTables):
    return planning.first_listed(t["listing"], 3)


LISTING_CAP = """
    select channel_id, video_id, published_at, position from (
        select *, row_number() over (partition by channel_id order by position, video_id) as rn from listing)
    where rn <= 3"""


def recent_videos(t: DriverTables):
    return planning.recent_only(t["videos"].select("video_id", "published_at"), 730, PLAN_AS_OF)


RECENT_VIDEOS = f"""
    select video_id, published_at from videos
    where published_at is null or published_at >= {NOW} - interval 730 day"""

# Every channel is looked for by id, by handle and by a word no or many channels have.
IDENTIFIERS = """
    select custom_url as identifier from channels union all select cast(channel_id as string) from channels
    union all select n_name from nation union all select p_type from part"""


def resolve(t: DriverTables):
    return planning.resolve_channels(t.sql(IDENTIFIERS), t["channels"])


RESOLVE = f"""
    with wanted as (select distinct identifier from ({IDENTIFIERS})),
    exact as (select w.identifier, c.channel_id from wanted w join channels c on w.identifier = cast(c.channel_id as varchar)),
    contained as (
        select w.identifier, min(c.channel_id) as channel_id
        from (select identifier, lower(ltrim(identifier, '@')) as needle from wanted
              where identifier not in (select identifier from exact)) w
        join channels c on contains(lower(c.custom_url), w.needle) or contains(lower(c.title), w.needle)
        group by w.identifier)
    select w.identifier, coalesce(e.channel_id, k.channel_id) as channel_id
    from wanted w left join exact e on w.identifier = e.identifier left join contained k on w.identifier = k.identifier"""


def _remote_channels(t: DriverTables):
    return t["channels"].select("channel_id", "title").join(_remote_counts(t), "channel_id")


def dry_run(t: DriverTables):
    return planning.dry_run(_remote_channels(t), t["plan_videos"], t["transcripts"], t["plan_summary"],
                            REMAINING_QUOTA, PLAN_AS_OF)


DRY_RUN = f"""
    with remote as (
        select c.channel_id, c.title, l.video_count from channels c join ({REMOTE}) l on c.channel_id = l.channel_id),
    stored as (
        select v.channel_id, count(*) as n, count(*) filter (where t.video_id is null) as silent
        from plan_videos v left join transcripts t on v.video_id = t.video_id group by v.channel_id),
    due as (select channel_id, count(*) as n from ({_needing_comments_sql(0)}) group by channel_id),
    plan as (
        select r.channel_id, r.title as channel_title, r.video_count as videos_listed, coalesce(s.n, 0) as videos_stored,
               coalesce(s.silent, 0) as transcripts_needed, coalesce(d.n, 0) as comments_needed,
               greatest(0, r.video_count - coalesce(s.n, 0)) as new_videos_estimate,
               1 + 2 + 2 * (r.video_count // 50 + 1) + r.video_count as estimated_quota,
               cast({REMAINING_QUOTA} as bigint) as quota_remaining
        from remote r left join stored s on r.channel_id = s.channel_id left join due d on r.channel_id = d.channel_id)
    select *, estimated_quota <= quota_remaining as can_complete from plan"""


def dry_run_totals(t: DriverTables):
    return planning.dry_run_totals(dry_run(t))


DRY_RUN_TOTALS = f"""
    select count(*) as channels, cast(sum(estimated_quota) as bigint) as total_estimated_quota,
           cast(sum(new_videos_estimate) as bigint) as new_videos_estimate,
           cast(sum(comments_needed) as bigint) as comments_needed,
           cast(sum(transcripts_needed) as bigint) as transcripts_needed,
           count(*) filter (where can_complete) as can_complete
    from ({DRY_RUN})"""

QUERIES = {
    "p01_refresh_hours": (refresh_hours, REFRESH_HOURS),
    "p02_videos_needing_comments": (needing_comments, NEEDING_COMMENTS),
    "p03_videos_needing_stats": (needing_stats, NEEDING_STATS),
    "p04_tier_breakdown": (tier_breakdown, TIER_BREAKDOWN),
    "p05_videos_without_transcripts": (without_transcripts, WITHOUT_TRANSCRIPTS),
    "p06_videos_needing_transcripts": (needing_transcripts, NEEDING_TRANSCRIPTS),
    "p07_last_fetch_time": (last_fetch, LAST_FETCH),
    "p08_latest_publish_date": (latest_publish, LATEST_PUBLISH),
    "p09_stored_video_ids": (stored_ids, STORED_IDS),
    "p10_latest_comment_time": (latest_comments, LATEST_COMMENTS),
    "p11_channel_refresh_flags": (refresh_flags, REFRESH_FLAGS),
    "p12_discovery_needed": (discovery, DISCOVERY),
    "p13_new_video_ids": (new_ids, NEW_IDS),
    "p14_vanished_video_ids": (vanished_ids, VANISHED_IDS),
    "p15_before_first_known": (before_known, BEFORE_KNOWN),
    "p16_listing_cap": (listing_cap, LISTING_CAP),
    "p17_recent_videos": (recent_videos, RECENT_VIDEOS),
    "p18_resolve_channels": (resolve, RESOLVE),
    "p19_dry_run": (dry_run, DRY_RUN),
    "p19_dry_run_totals": (dry_run_totals, DRY_RUN_TOTALS),
}
