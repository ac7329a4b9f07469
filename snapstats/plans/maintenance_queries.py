"""Table upkeep and sync over the test tables. Two roles of one table are told apart by its attributes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from snapstats.operators import maintenance, shaping, sync
from snapstats.plans.driver_tables import EVENTS_AS_OF, PLAN_AS_OF, DriverTables

# --- metadata -------------------------------------------------------------------------------------

CHANNEL_BATCH = """
    select p_partkey as channel_id, p_name as title, concat('@', lower(p_brand)) as custom_url, p_type as country
    from part"""


def upsert_channels(t: DriverTables):
    return maintenance.upsert_channels(t["channels"], t.sql(CHANNEL_BATCH))


UPSERT_CHANNELS = f"""
    select coalesce(c.channel_id, i.channel_id) as channel_id, coalesce(i.title, c.title) as title,
           coalesce(i.custom_url, c.custom_url) as custom_url,
           case when c.channel_id is null then i.country else c.country end as country
    from channels c full join ({CHANNEL_BATCH}) i on c.channel_id = i.channel_id"""

STORED_CLIPS = """
    select event_id as video_id, user_id as channel_id, event_type as title, props as description, ts as published_at,
           'public' as privacy_status, ts as updated_at
    from events"""
# Several rows per key, applied in the order of these columns.
CLIP_BATCH = """
    select l_orderkey as video_id, l_suppkey as channel_id, concat('Line ', cast(l_linenumber as string)) as title,
           l_returnflag as description, l_shipdate as published_at, l_linestatus as privacy_status,
           l_shipdate as updated_at, l_linenumber, l_partkey, l_extendedprice
    from lineitem"""
CLIP_ORDER = ["updated_at", "l_linenumber", "l_partkey", "channel_id", "l_extendedprice"]


def upsert_videos(t: DriverTables):
    return maintenance.upsert_videos(t.sql(STORED_CLIPS), t.sql(CLIP_BATCH), order=F.struct(*CLIP_ORDER), whole_table=True)


UPSERT_VIDEOS = f"""
    with ranked as (
        select i.*, row_number() over (partition by video_id order by {", ".join(CLIP_ORDER)}) as first_rn,
               row_number() over (partition by video_id order by {", ".join(c + " desc" for c in CLIP_ORDER)}) as last_rn
        from ({CLIP_BATCH}) i),
    folded as (
        select f.video_id, f.channel_id, f.published_at, l.title, l.description, l.privacy_status, l.updated_at
        from ranked f join ranked l on f.video_id = l.video_id where f.first_rn = 1 and l.last_rn = 1)
    select coalesce(c.video_id, i.video_id) as video_id, coalesce(c.channel_id, i.channel_id) as channel_id,
           coalesce(i.title, c.title) as title, coalesce(i.description, c.description) as description,
           coalesce(c.published_at, i.published_at) as published_at,
           coalesce(i.privacy_status, c.privacy_status) as privacy_status,
           coalesce(i.updated_at, c.updated_at) as updated_at
    from ({STORED_CLIPS}) c full join folded i on c.video_id = i.video_id"""

STORED_LISTS = """
    select s_suppkey as playlist_id, cast(s_nationkey as bigint) as channel_id, s_name as title,
           cast(0 as bigint) as item_count
    from supplier"""


def upsert_playlists(t: DriverTables):
    return maintenance.upsert_playlists(t.sql(STORED_LISTS), t["playlists"])


UPSERT_PLAYLISTS = f"""
    select coalesce(c.playlist_id, i.playlist_id) as playlist_id, coalesce(c.channel_id, i.channel_id) as channel_id,
           coalesce(i.title, c.title) as title, coalesce(i.item_count, c.item_count) as item_count
    from ({STORED_LISTS}) c full join playlists i on c.playlist_id = i.playlist_id"""

# --- snapshots ------------------------------------------------------------------------------------

CHANNEL_STATS_STORED = """
    select user_id as channel_id, ts as fetched_at, cast(floor(value*100) as bigint) as subscriber_count,
           event_id % 500 as video_count
    from events where event_type <> 'purchase'"""
CHANNEL_STATS_BATCH = """
    select user_id as channel_id, ts as fetched_at, nullif(cast(floor(value*10) as bigint), 100) as subscriber_count,
           nullif(event_id % 50, 7) as video_count
    from events where event_type <> 'view'"""


def insert_channel_stats(t: DriverTables):
    return maintenance.insert_stats("channel_stats", t.sql(CHANNEL_STATS_STORED), t.sql(CHANNEL_STATS_BATCH))


INSERT_CHANNEL_STATS = f"""
    with stored as ({CHANNEL_STATS_STORED})
    select * from stored union all
    select channel_id, fetched_at, coalesce(subscriber_count, 0), coalesce(video_count, 0)
    from ({CHANNEL_STATS_BATCH}) b
    where not exists (select 1 from stored s where s.channel_id = b.channel_id and s.fetched_at = b.fetched_at)"""

VIDEO_STATS_STORED = """
    select l_orderkey as video_id, l_shipdate as fetched_at, max(cast(floor(l_extendedprice) as bigint)) as view_count,
           max(cast(l_quantity as bigint)) as like_count, max(cast(l_linenumber as bigint)) as comment_count
    from lineitem where l_linestatus = 'F' group by l_orderkey, l_shipdate"""
VIDEO_STATS_BATCH = """
    select l_orderkey as video_id, l_shipdate as fetched_at, cast(floor(l_extendedprice) as bigint) as view_count,
           nullif(cast(l_quantity as bigint), 13) as like_count, cast(l_linenumber as bigint) as comment_count,
           l_extendedprice, l_partkey, l_suppkey
    from lineitem"""
STATS_ORDER = ["l_extendedprice", "l_partkey", "l_suppkey", "comment_count"]


def insert_video_stats(t: DriverTables):
    return maintenance.insert_stats("video_stats", t.sql(VIDEO_STATS_STORED), t.sql(VIDEO_STATS_BATCH),
                                    order=F.struct(*STATS_ORDER))


INSERT_VIDEO_STATS = f"""
    with stored as ({VIDEO_STATS_STORED})
    select * from stored union all
    select video_id, fetched_at, view_count, coalesce(like_count, 0), comment_count from (
        select b.*, row_number() over (partition by video_id, fetched_at order by {", ".join(STATS_ORDER)}) as rn
        from ({VIDEO_STATS_BATCH}) b) b
    where rn = 1
      and not exists (select 1 from stored s where s.video_id = b.video_id and s.fetched_at = b.fetched_at)"""


def summary_after_stats(t: DriverTables):
    return maintenance.summary_after_stats(t["plan_summary"], t["video_stats"], whole_table=True)


SUMMARY_AFTER_STATS = """
    with latest as (
        select video_id, fetched_at, comment_count from (
            select v.*, row_number() over (partition by video_id order by fetched_at desc, comment_count desc) as rn
            from video_stats v) where rn = 1)
    select coalesce(s.video_id, l.video_id) as video_id,
           case when s.video_id is null then 0 else s.stored_comment_count end as stored_comment_count,
           s.last_comment_fetch, coalesce(l.comment_count, s.latest_youtube_comment_count) as latest_youtube_comment_count,
           coalesce(l.fetched_at, s.last_stats_fetch) as last_stats_fetch
    from plan_summary s full join latest l on s.video_id = l.video_id"""

# --- comments and transcripts ---------------------------------------------------------------------

COMMENTS_STORED = """
    select event_id as comment_id, event_id % 1000 as video_id, props as text, cast(floor(value) as bigint) as like_count,
           ts as fetched_at
    from events where event_type <> 'purchase'"""
COMMENTS_BATCH = """
    select event_id as comment_id, event_id % 1000 as video_id, concat(props, ' again') as text,
           nullif(cast(floor(value) as bigint), 3) as like_count, ts as fetched_at
    from events where event_type <> 'view'"""


def insert_comments(t: DriverTables):
    return maintenance.insert_comments(t.sql(COMMENTS_STORED), t.sql(COMMENTS_BATCH))


INSERT_COMMENTS = f"""
    with stored as ({COMMENTS_STORED})
    select * from stored union all
    select comment_id, video_id, text, coalesce(like_count, 0), fetched_at from ({COMMENTS_BATCH}) b
    where comment_id not in (select comment_id from stored)"""

# Videos seen so far: those a click came from.
SUMMARY_STORED = """
    select event_id % 1000 as video_id, count(*) as stored_comment_count, max(ts) as last_comment_fetch,
           cast(null as bigint) as latest_youtube_comment_count
    from events where event_type = 'click' group by event_id % 1000"""


def summary_after_comments(t: DriverTables):
    batch = t.sql(COMMENTS_BATCH)
    inserted = maintenance.new_comments(t.sql(COMMENTS_STORED), batch)
    return maintenance.summary_after_comments(t.sql(SUMMARY_STORED), inserted, batch, EVENTS_AS_OF)


SUMMARY_AFTER_COMMENTS = f"""
    with stored as ({COMMENTS_STORED}),
    visits as (
        select b.video_id, count(*) filter (where s.comment_id is null) as added
        from ({COMMENTS_BATCH}) b left join stored s on b.comment_id = s.comment_id group by b.video_id)
    select coalesce(m.video_id, v.video_id) as video_id,
           coalesce(m.stored_comment_count, 0) + coalesce(v.added, 0) as stored_comment_count,
           case when v.video_id is null then m.last_comment_fetch else timestamp '{EVENTS_AS_OF}' end as last_comment_fetch,
           m.latest_youtube_comment_count
    from ({SUMMARY_STORED}) m full join visits v on m.video_id = v.video_id"""

TRANSCRIPTS_STORED = """
    select doc_id as video_id, lang as language_code, source as language, text as full_text
    from documents where lang = 'en'"""
TRANSCRIPTS_BATCH = """
    select doc_id as video_id, lang as language_code, 'second' as language, text as full_text from documents"""


def insert_transcripts(t: DriverTables):
    return maintenance.insert_transcripts(t.sql(TRANSCRIPTS_STORED), t.sql(TRANSCRIPTS_BATCH))


INSERT_TRANSCRIPTS = f"""
    {TRANSCRIPTS_STORED} union all
    select * from ({TRANSCRIPTS_BATCH}) b where video_id not in (select doc_id from documents where lang = 'en')"""

SUMMARIES_KNOWN = "select * from plan_summary where last_comment_fetch is null"


def summary_backfill(t: DriverTables):
    return maintenance.summary_backfill(t["videos"], t["comments"], t["video_stats"], t.sql(SUMMARIES_KNOWN))


SUMMARY_BACKFILL = f"""
    with latest as (
        select video_id, fetched_at, comment_count from (
            select v.*, row_number() over (partition by video_id order by fetched_at desc, comment_count desc) as rn
            from video_stats v) where rn = 1),
    counted as (select video_id, count(*) as n, max(fetched_at) as last_fetch from comments group by video_id)
    select v.video_id, coalesce(c.n, 0) as stored_comment_count, c.last_fetch as last_comment_fetch,
           l.comment_count as latest_youtube_comment_count, l.fetched_at as last_stats_fetch
    from videos v left join counted c on v.video_id = c.video_id left join latest l on v.video_id = l.video_id
    where v.video_id not in (select video_id from ({SUMMARIES_KNOWN}))
      and (c.n > 0 or l.comment_count is not null)"""

# --- chapters and deletion ------------------------------------------------------------------------

CHAPTERS_STORED = """
    select l_orderkey as video_id, l_linenumber as chapter_index, l_returnflag as title, l_partkey as start_seconds,
           l_suppkey as end_seconds
    from lineitem"""


def replace_chapters(t: DriverTables):
    """Finished orders are looked at again; only the urgent ones still have chapters."""
    finished = t["orders"].filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("video_id"), "o_orderpriority")
    urgent = finished.filter(F.col("o_orderpriority") == "1-URGENT")
    batch = shaping.chapter_rows(t["videos"].join(urgent.select("video_id"), "video_id", "left_semi"))
    return maintenance.replace_chapters(t.sql(CHAPTERS_STORED), batch, finished)


REPLACE_CHAPTERS = f"""
    select s.* from ({CHAPTERS_STORED}) s
    where video_id not in (select o_orderkey from orders where o_orderstatus = 'F')
    union all
    select o_orderkey, n.i, n.title, n.start_seconds, case n.i when 0 then 30 + 60 * (1 + o_orderkey % 9)
           when 1 then 3723 else nullif(cast(floor(o_totalprice) as bigint) % 7200, 0) end
    from (select *, unnest([{{'i': 0, 'title': 'Intro', 'start_seconds': 0::bigint}},
                            {{'i': 1, 'title': 'Middle', 'start_seconds': (60 * (1 + o_orderkey % 9) + 30)::bigint}},
                            {{'i': 2, 'title': 'End', 'start_seconds': 3723::bigint}}]) as n from orders
          where o_orderstatus = 'F' and o_orderpriority = '1-URGENT')"""


def mark_deleted(t: DriverTables):
    unseen = t["videos"].select("video_id").join(
        t["lineitem"].select(F.col("l_orderkey").alias("video_id")), "video_id", "left_anti")
    return maintenance.mark_deleted(t["videos"], unseen, PLAN_AS_OF).select("video_id", "privacy_status", "updated_at")


MARK_DELETED = f"""
    select video_id, case when l.k is null then 'deleted' else privacy_status end as privacy_status,
           case when l.k is null then timestamp '{PLAN_AS_OF}' else updated_at end as updated_at
    from videos left join (select distinct l_orderkey as k from lineitem) l on video_id = l.k"""


def deleted_videos(t: DriverTables):
    return maintenance.deleted_videos(t["videos"])


DELETED_VIDEOS = "select video_id, title, channel_id, updated_at from videos where privacy_status = 'deleted'"


def _purgeable(t: DriverTables):
    return {n: t[n] for n in ("video_stats", "chapters", "transcripts", "comments", "videos")} | {
        "video_comment_summary": t["plan_summary"]}


VICTIMS = f"""
    select video_id from videos
    where privacy_status = 'deleted' and updated_at < timestamp '{PLAN_AS_OF}' - interval 30 day"""


def purge_counts(t: DriverTables):
    return maintenance.purge_counts(_purgeable(t), PLAN_AS_OF)


PURGE_COUNTS = " union all ".join(
    f"""select '{name}' as "table", count(*) as purged from {source} where video_id in ({VICTIMS})"""
    for name, source in (("video_stats", "video_stats"), ("chapters", "chapters"), ("transcripts", "transcripts"), ("comments", "comments"),
                         ("video_comment_summary", "plan_summary"), ("videos", "videos")))


# What a row left over is known by, per table.
LEFT_OVER = {"video_stats": "view_count", "chapters": "chapter_index", "transcripts": "language_code", "comments": "comment_id",
             "video_comment_summary": "stored_comment_count", "videos": "title"}


def purge_rest(t: DriverTables):
    """What the purge leaves of every table."""
    left = maintenance.purge_deleted(_purgeable(t), PLAN_AS_OF)
    parts = [left[n].select(F.lit(n).alias("table"), "video_id", F.col(c).cast("string").alias("content")) for n, c in LEFT_OVER.items()]
    return reduce(DataFrame.unionByName, parts)


PURGE_REST = " union all ".join(
    f"""select '{n}' as "table", video_id, cast({c} as varchar) as content from {'plan_summary' if n == 'video_comment_summary' else n}
    where video_id not in ({VICTIMS})""" for n, c in LEFT_OVER.items())

# --- run log and progress -------------------------------------------------------------------------


def run_log(t: DriverTables):
    events = t["events"]
    runs = events.select(F.col("event_id").alias("fetch_id"), F.col("user_id").alias("channel_id"),
                         F.col("event_type").alias("fetch_type"))
    ended = events.filter(F.col("event_type") != "signup").select(
        F.col("event_id").alias("fetch_id"), F.floor("value").alias("videos_fetched"),
        F.floor(F.col("value") * 2).alias("comments_fetched"), F.lit(0).cast("bigint").alias("transcripts_fetched"),
        F.when(F.col("event_type") == "error", F.split("props", " ")).alias("errors"),
        F.when(F.col("event_type") == "error", "failed").otherwise("completed").alias("status"))
    opened = maintenance.open_runs(runs, PLAN_AS_OF)
    return maintenance.fetch_log_from_events(opened, maintenance.close_runs(ended, EVENTS_AS_OF))


RUN_LOG = f"""
    select event_id as fetch_id, user_id as channel_id, event_type as fetch_type, timestamp '{PLAN_AS_OF}' as started_at,
           case when event_type <> 'signup' then timestamp '{EVENTS_AS_OF}' end as completed_at,
           case when event_type <> 'signup' then cast(floor(value) as bigint) end as videos_fetched,
           case when event_type <> 'signup' then cast(floor(value * 2) as bigint) end as comments_fetched,
           case when event_type <> 'signup' then cast(0 as bigint) end as transcripts_fetched,
           case when event_type = 'error' then array_to_string(string_split(props, ' ')[1:10], '; ') end as errors,
           case event_type when 'signup' then 'running' when 'error' then 'failed' else 'completed' end as status
    from events"""

# One progress row per event, each with a list of two finished ids.
PROGRESS = "select user_id as channel_id, event_type as operation, event_id, event_id % 100 as v from events"


def _processed(t: DriverTables):
    progress = t.sql(PROGRESS).withColumn("processed_ids", F.array(F.col("v"), F.col("v") + 100))
    return maintenance.processed_ids(progress)


def remaining_ids(t: DriverTables):
    todo = t.sql("select distinct user_id as channel_id, event_id % 200 as video_id from events")
    return maintenance.remaining_ids(todo, _processed(t), "click")


REMAINING_IDS = f"""
    select distinct user_id as channel_id, event_id % 200 as video_id from events e
    where not exists (select 1 from ({PROGRESS}) p where p.operation = 'click' and p.channel_id = e.user_id
                      and e.event_id % 200 in (p.v, p.v + 100))"""


def save_progress(t: DriverTables):
    done = t.sql("select user_id as channel_id, event_id % 300 as video_id from events")
    return maintenance.save_progress(_processed(t), done, "click")


SAVE_PROGRESS = f"""
    select distinct user_id as channel_id, 'click' as operation, event_id % 300 as video_id from events e
    where not exists (select 1 from ({PROGRESS}) p where p.operation = 'click' and p.channel_id = e.user_id
                      and e.event_id % 300 in (p.v, p.v + 100))"""


def clear_progress(t: DriverTables):
    """Channels without any error are finished with their clicks."""
    with_error = t["events"].filter(F.col("event_type") == "error").select(F.col("user_id").alias("channel_id"))
    finished = t["channels"].select("channel_id").join(with_error, "channel_id", "left_anti")
    return maintenance.clear_progress(_processed(t), finished, "click")


CLEAR_PROGRESS = f"""
    select channel_id, operation, unnest([v, v + 100]) as video_id from ({PROGRESS}) p
    where not (operation = 'click'
               and channel_id in (select c_custkey from customer)
               and channel_id not in (select user_id from events where event_type = 'error'))"""

# --- sync -----------------------------------------------------------------------------------------


def common_columns(t: DriverTables):
    shared, _ = sync.common_columns(t["videos"], t["stored_videos"])
    return t["videos"].select(*shared)


COMMON_COLUMNS = "select video_id, channel_id, title, published_at, privacy_status, updated_at from videos"


def count_rows(t: DriverTables):
    return sync.count_rows(t["lineitem"])


def sync_missing(t: DriverTables):
    return sync.missing_rows(t["videos"], t["stored_videos"], ["video_id"])


SYNC_MISSING = f"{COMMON_COLUMNS} where video_id not in (select video_id from stored_videos)"


def sync_full(t: DriverTables):
    return sync.full_merge(t["stored_videos"], t["videos"], ["video_id"])


SYNC_FULL = """
    select v.video_id, v.channel_id, coalesce(s.title, v.title) as title, v.published_at, v.duration_seconds,
           v.duration_iso, v.description, coalesce(s.privacy_status, v.privacy_status) as privacy_status, v.updated_at
    from videos v left join stored_videos s on v.video_id = s.video_id"""

DESTINATIONS = {
    "channels": "select * from channels where country <> 'BUILDING'",
    "channel_stats": CHANNEL_STATS_STORED,
    "videos": "select * from stored_videos",
    "video_stats": VIDEO_STATS_STORED,
    "chapters": "select * from chapters where chapter_index < 3",
    "comments": "select comment_id, video_id, text, like_count from comments where comment_id % 3 <> 0",
    "transcripts": TRANSCRIPTS_STORED,
    "playlists": STORED_LISTS,
    "fetch_log": "select * from fetch_log where status = 'completed'",
    "fetch_progress": "select * from fetch_progress where operation <> 'click'",
    "quota_usage": "select * from quota_usage where used % 2 = 0",
}


def sync_report(t: DriverTables):
    return sync.sync_report({n: t[n] for n in DESTINATIONS}, {n: t.sql(q) for n, q in DESTINATIONS.items()}, incremental=True)


def _sync_sql(name: str) -> str:
    keys = sync.PRIMARY_KEYS[name]
    match = " and ".join(f"d.{k} = s.{k}" for k in keys)
    return f"""
    select '{name}' as "table", 'success' as status, count(*) as source_count,
           count(*) filter (where d.{keys[0]} is null) as synced, count(*) filter (where d.{keys[0]} is not null) as skipped
    from {name} s left join ({DESTINATIONS[name]}) d on {match}"""


SYNC_REPORT = " union all ".join(_sync_sql(n) for n in DESTINATIONS)


def sync_one(t: DriverTables):
    return sync.sync_counts("video_stats", t["video_stats"], t.sql(VIDEO_STATS_STORED), ["video_id", "fetched_at"],
                            incremental=True)


def sync_dry_run(t: DriverTables):
    return sync.sync_counts("videos", t["videos"], t["stored_videos"], ["video_id"], incremental=True, dry_run=True)


SYNC_DRY_RUN = """
    select 'videos' as "table", 'dry_run' as status, count(*) as source_count, cast(0 as bigint) as synced,
           cast(0 as bigint) as skipped, (select count(*) from stored_videos) as dest_count
    from videos"""


def sync_totals(t: DriverTables):
    return sync.sync_totals(sync_report(t), EVENTS_AS_OF)


SYNC_TOTALS = f"""
    select count(*) as tables, cast(sum(source_count) as bigint) as source_count, cast(sum(synced) as bigint) as synced,
           cast(sum(skipped) as bigint) as skipped, 'success' as status, timestamp '{EVENTS_AS_OF}' as completed_at
    from ({SYNC_REPORT})"""

QUERIES = {
    "m01_upsert_channels": (upsert_channels, UPSERT_CHANNELS),
    "m02_upsert_videos": (upsert_videos, UPSERT_VIDEOS),
    "m03_upsert_playlists": (upsert_playlists, UPSERT_PLAYLISTS),
    "m04_insert_channel_stats": (insert_channel_stats, INSERT_CHANNEL_STATS),
    "m05_insert_video_stats": (insert_video_stats, INSERT_VIDEO_STATS),
    "m06_summary_after_stats": (summary_after_stats, SUMMARY_AFTER_STATS),
    "m07_insert_comments": (insert_comments, INSERT_COMMENTS),
    "m08_summary_after_comments": (summary_after_comments, SUMMARY_AFTER_COMMENTS),
    "m09_insert_transcripts": (insert_transcripts, INSERT_TRANSCRIPTS),
    "m10_summary_backfill": (summary_backfill, SUMMARY_BACKFILL),
    "m11_replace_chapters": (replace_chapters, REPLACE_CHAPTERS),
    "m12_mark_deleted": (mark_deleted, MARK_DELETED),
    "m13_deleted_videos": (deleted_videos, DELETED_VIDEOS),
    "m14_purge_counts": (purge_counts, PURGE_COUNTS),
    "m14_purge_rest": (purge_rest, PURGE_REST),
    "m15_run_log": (run_log, RUN_LOG),
    "m16_remaining_ids": (remaining_ids, REMAINING_IDS),
    "m16_save_progress": (save_progress, SAVE_PROGRESS),
    "m16_clear_progress": (clear_progress, CLEAR_PROGRESS),
    "s01_common_columns": (common_columns, COMMON_COLUMNS),
    "s02_count_rows": (count_rows, "select count(*) as rows from lineitem"),
    "s03_sync_incremental": (sync_missing, SYNC_MISSING),
    "s04_sync_full": (sync_full, SYNC_FULL),
    "s05_sync_table_counts": (sync_one, _sync_sql("video_stats")),
    "s05_sync_dry_run": (sync_dry_run, SYNC_DRY_RUN),
    "s06_sync_report": (sync_report, SYNC_REPORT),
    "s06_sync_totals": (sync_totals, SYNC_TOTALS),
}
