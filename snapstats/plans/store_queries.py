"""Stored tables over the test tables: written by bucket and month, changed, reloaded and compared.

Each query works in a database of its own, stores its result and drops the database again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, functions as F

from snapstats.operators import maintenance, planning, reports, shaping, sync
from snapstats.plans import jobs, maintenance_queries as upkeep, report_queries, shaping_queries
from snapstats.plans.driver_tables import EVENTS_AS_OF, PLAN_AS_OF, STATS_AS_OF, VIEWS, DriverTables
from snapstats.schemas import SYNC_TABLES
from snapstats.session import shared_folder
from snapstats.sources import tables
from snapstats.streaming import ingest

# Few, as the test tables spread over many months and few rows.
BUCKETS = 2


def in_store(t: DriverTables, names: Iterable[str], work: Callable[[str, str], DataFrame]) -> DataFrame:
    """What `work(database, folder)` returns, worked out over fresh stored tables, which are dropped afterwards."""
    database = f"snap_{uuid.uuid4().hex}"
    folder = f"{shared_folder(t.spark).rstrip('/')}/{database}"
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/store'")
    try:
        tables.create_tables(t.spark, database, buckets=BUCKETS, tables=names)
        rows = work(database, folder)
        rows.write.parquet(f"{folder}/result")
    finally:
        t.spark.sql(f"DROP DATABASE {database} CASCADE")
    return t.spark.read.schema(rows.schema).parquet(f"{folder}/result")


def _run(t: DriverTables, database: str, folder: str, name: str = "run-1", as_of: str = PLAN_AS_OF) -> jobs.Run:
    return jobs.Run(t.spark, name, f"{folder}/runs", database, as_of)


def _load(t: DriverTables, database: str, name: str) -> DataFrame:
    return tables.load_catalog(t.spark, database, [name])[name]


# --- reports over pruned months -------------------------------------------------------------------

def _report(name: str, sources: list[str], as_of: str, **options):
    def build(t: DriverTables):
        def work(database: str, _: str):
            for source in sources:
                tables.append(source, t[source], database)
            return reports.run_report(name, tables.load_catalog(t.spark, database, sources, layout=True), as_of, **options)
        return in_store(t, sources, work)
    return build


growth = _report("growth", ["video_stats", "videos", "channels"], STATS_AS_OF, days=90, limit=1_000_000)
GROWTH = f"""
    with span as (
        select video_id, min(view_count) as low, max(view_count) as high, count(*) as n from video_stats
        where fetched_at >= timestamp '{STATS_AS_OF}' - interval 90 day group by video_id)
    select v.title, c.title as channel, high - low as view_growth, low as views_90d_ago, high as views_now,
           round(100.0::double * (high - low) / greatest(low, 1), 2) as growth_pct, cast(v.published_at as timestamp) as published_at
    from span join videos v using (video_id) join channels c on c.channel_id = v.channel_id where n > 1 and high > low"""

comment_velocity = _report("comment-velocity", ["comments", "videos", "channels"], EVENTS_AS_OF, days=7, limit=1_000_000)
COMMENT_VELOCITY = f"""
    with talk as (
        select video_id, count(*) as n from comments where published_at >= timestamp '{EVENTS_AS_OF}' - interval 7 day group by video_id)
    select v.title, c.title as channel, n as new_comments_7d, round(n / 7.0::double, 1) as comments_per_day,
           cast(v.published_at as timestamp) as published_at
    from talk join videos v using (video_id) join channels c on c.channel_id = v.channel_id"""

subscriber_growth = _report("subscriber-growth", ["channel_stats", "channels"], EVENTS_AS_OF)

# --- merges by bucket -----------------------------------------------------------------------------


def merged_videos(t: DriverTables):
    """The upsert of videos through stored buckets, and the same run once more."""
    def work(database: str, folder: str):
        tables.append("videos", t.sql(upkeep.STORED_CLIPS), database)
        run = _run(t, database, folder)
        batch = run.staged("batch", t.sql(upkeep.CLIP_BATCH).withColumn("video_id", F.col("video_id").cast("string")))
        for _ in range(2):
            run.merge("videos", batch, lambda part: maintenance.upsert_videos(part, batch, order=F.struct(*upkeep.CLIP_ORDER)))
        return _load(t, database, "videos").select(
            "video_id", "channel_id", "title", "description", "published_at", "privacy_status", "updated_at")
    return in_store(t, ["videos"], work)


MERGED_VIDEOS = f"""
    select cast(video_id as varchar) as video_id, cast(channel_id as varchar) as channel_id, title, description,
           cast(published_at as timestamp) as published_at, privacy_status, cast(updated_at as timestamp) as updated_at
    from ({upkeep.UPSERT_VIDEOS})"""

# Statistics up to a day before the summary's own: they are late for most videos.
LATE_STATS = "select * from video_stats where fetched_at <= date '2001-03-01'"


def late_stats(t: DriverTables):
    def work(database: str, folder: str):
        tables.append("video_comment_summary", t["plan_summary"], database)
        run = _run(t, database, folder)
        batch = run.staged("batch", tables.conform("video_stats", t.sql(LATE_STATS)))
        run.merge("video_comment_summary", batch, lambda part: maintenance.summary_after_stats(part, batch))
        return _load(t, database, "video_comment_summary")
    return in_store(t, ["video_comment_summary"], work)


LATE_SUMMARY = f"""
    with late as (
        select video_id, max(fetched_at) as late_at, arg_max(comment_count, fetched_at) as n from ({LATE_STATS}) group by video_id),
    both_sides as (
        select coalesce(s.video_id, l.video_id) as id, s.*, l.late_at, l.n, s.video_id is null or s.last_stats_fetch is null or l.late_at >= s.last_stats_fetch as wins
        from plan_summary s full join late l on s.video_id = l.video_id)
    select cast(id as varchar) as video_id, coalesce(stored_comment_count, 0) as stored_comment_count,
           cast(last_comment_fetch as timestamp) as last_comment_fetch,
           case when wins then n else latest_youtube_comment_count end as latest_youtube_comment_count,
           cast(case when wins then late_at else last_stats_fetch end as timestamp) as last_stats_fetch
    from both_sides"""


def stored_chapters(t: DriverTables):
    """Finished orders are looked at again; only the urgent ones still have chapters."""
    def work(database: str, folder: str):
        tables.append("chapters", t.sql(upkeep.CHAPTERS_STORED), database)
        run = _run(t, database, folder)
        finished = t["orders"].filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").cast("string").alias("video_id"), "o_orderpriority")
        finished = run.staged("finished", finished)
        urgent = finished.filter(F.col("o_orderpriority") == "1-URGENT").select("video_id")
        batch = shaping.chapter_rows(t["videos"].withColumn("video_id", F.col("video_id").cast("string")).join(urgent, "video_id", "left_semi"))
        run.merge("chapters", finished, lambda part: maintenance.replace_chapters(part, batch, finished))
        return _load(t, database, "chapters")
    return in_store(t, ["chapters"], work)


STORED_CHAPTERS = f"""
    select cast(video_id as varchar) as video_id, cast(chapter_index as integer) as chapter_index, title, start_seconds, end_seconds
    from ({upkeep.REPLACE_CHAPTERS})"""


def stored_comments(t: DriverTables):
    """A batch checked against the buckets of its videos only, twice."""
    def work(database: str, folder: str):
        tables.append("comments", t.sql(upkeep.COMMENTS_STORED), database)
        run = _run(t, database, folder)
        batch = run.staged("batch", tables.conform("comments", t.sql(upkeep.COMMENTS_BATCH)))
        for _ in range(2):
            tables.append("comments", maintenance.new_comments(run.part("comments", batch, ["comment_id"]), batch), database)
        return _load(t, database, "comments").select("comment_id", "video_id", "text", "like_count", "fetched_at")
    return in_store(t, ["comments"], work)


STORED_COMMENTS = f"""
    select cast(comment_id as varchar) as comment_id, cast(video_id as varchar) as video_id, text, like_count, fetched_at
    from ({upkeep.INSERT_COMMENTS})"""

# --- progress -------------------------------------------------------------------------------------

# Two runs report finished work, in part the same; a third asks what is left, and finished channels are cleared.
DONE_1 = "select user_id as channel_id, event_id % 100 as video_id from events where event_type = 'click'"
DONE_2 = "select user_id as channel_id, event_id % 150 as video_id from events where event_type = 'view'"
TODO = "select distinct user_id as channel_id, event_id % 200 as video_id from events"
FINISHED = "select distinct user_id as channel_id from events where event_type = 'error'"


def stored_progress(t: DriverTables):
    def work(database: str, folder: str):
        def ids(run, name, query):
            rows = t.sql(query)
            return run.staged(name, rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns]))
        first, second, third = (_run(t, database, folder, f"run-{k}") for k in (1, 2, 3))
        done = ids(first, "done", DONE_1)
        for _ in range(2):  # the same run again notes nothing twice
            jobs.save_progress(first, done, "videos")
        jobs.save_progress(second, ids(second, "done", DONE_2), "videos")
        jobs.save_progress(second, ids(second, "others", DONE_1), "comments")
        todo = ids(third, "todo", TODO)
        left = jobs.resumed(third, todo, "videos").select(F.lit("left").alias("state"), "channel_id", "video_id", F.lit(None).cast("bigint").alias("n"))
        totals = maintenance.progress_totals(_load(t, database, "fetch_progress"), todo.withColumn("operation", F.lit("videos")))
        totals = third.staged("totals", totals).select(F.lit("total").alias("state"), "channel_id", F.lit(None).cast("string").alias("video_id"),
                                                       (F.col("total_count") * 1000 + F.col("remaining_count")).alias("n"))
        left = third.staged("left", left)
        jobs.clear_progress(third, ids(third, "finished", FINISHED), "videos")
        stored = _load(t, database, "fetch_progress").select(F.concat(F.lit("stored "), "operation").alias("state"), "channel_id", "video_id",
                                                             F.lit(None).cast("bigint").alias("n"))
        return stored.unionByName(left).unionByName(totals)
    return in_store(t, ["fetch_progress"], work)


STORED_PROGRESS = f"""
    with done as (select * from ({DONE_1}) union select * from ({DONE_2})),
    todo as ({TODO}),
    left_over as (select * from todo except select * from done),
    shown as (
        select 'left' as state, channel_id, video_id, cast(null as bigint) as n from left_over
        union all select 'stored videos', channel_id, video_id, null from done where channel_id not in ({FINISHED})
        union all select 'stored comments', channel_id, video_id, null from (select distinct * from ({DONE_1}))
        union all select 'total', t.channel_id, null, count(*) * 1000 + count(l.video_id)
        from todo t left join left_over l on l.channel_id = t.channel_id and l.video_id = t.video_id group by t.channel_id)
    select state, cast(channel_id as varchar) as channel_id, cast(video_id as varchar) as video_id, n from shown"""

# --- sync -----------------------------------------------------------------------------------------

# What a row says of itself, in text that both engines write alike.
CONTENTS = {
    "channels": ["channel_id", "title", "custom_url", "country"],
    "channel_stats": ["channel_id", "cast(fetched_at as date)", "subscriber_count", "video_count"],
    "videos": ["video_id", "channel_id", "title", "privacy_status", "cast(published_at as date)"],
    "video_stats": ["video_id", "cast(fetched_at as date)", "view_count", "like_count", "comment_count"],
    "chapters": ["video_id", "chapter_index", "title", "start_seconds", "end_seconds"],
    "transcripts": ["video_id", "language_code", "language", "full_text"],
    "comments": ["comment_id", "video_id", "text", "like_count"],
    "playlists": ["playlist_id", "channel_id", "title", "item_count"],
    "fetch_log": ["fetch_id", "channel_id", "fetch_type", "status", "cast(started_at as date)"],
    "fetch_progress": ["channel_id", "operation", "video_id", "fetch_id"],
    "quota_usage": ["date", "used"],
}
HELD = upkeep.DESTINATIONS


def content(columns: list[str], number: str) -> list[str]:
    """Row count and a sum over digests of the rows, as expressions; `number` reads hexadecimal digits in one engine's way."""
    text = "concat_ws('|', " + ", ".join(f"coalesce(cast({c} as string), '')" for c in columns) + ")"
    return ["count(*) as rows", f"cast(sum({number.format(f'substr(md5({text}), 1, 7)')}) as bigint) as checksum"]


def _stored_view(t: DriverTables, name: str, folder: str) -> DataFrame:
    """A table of the source store. One that is grouped out of a base table is stored first: the sync reads it four times."""
    if "group by" not in VIEWS[name]:
        return t[name]
    t[name].write.parquet(f"{folder}/source/{name}")
    return t.spark.read.schema(t[name].schema).parquet(f"{folder}/source/{name}")


def synced_tables(t: DriverTables):
    """All tables carried by missing key into a store that holds part of them, and carried again."""
    def work(database: str, folder: str):
        source = {n: tables.conform(n, _stored_view(t, n, folder)) for n in SYNC_TABLES}
        for name, held in HELD.items():
            tables.append(name, t.sql(held), database)
        write = sync.store_sink(database, f"{folder}/versions")
        done = sync.sync_stores(t.spark, source, tables.load_catalog(t.spark, database, SYNC_TABLES), write, incremental=True)
        again = sync.sync_stores(t.spark, source, tables.load_catalog(t.spark, database, SYNC_TABLES), write, incremental=True)
        stored = None
        for name, df in tables.load_catalog(t.spark, database, SYNC_TABLES).items():
            row = df.selectExpr(*content(CONTENTS[name], "cast(conv({}, 16, 10) as bigint)")).select(F.lit(name).alias("table"), "rows", "checksum")
            stored = row if stored is None else stored.unionByName(row)
        return (done.select("table", "status", "source_count", "synced", "skipped").join(again.select("table", F.col("synced").alias("synced_again")), "table")
                .join(stored, "table"))
    return in_store(t, SYNC_TABLES, work)


def _synced_sql(name: str) -> str:
    keys = sync.PRIMARY_KEYS[name]
    match = " and ".join(f"d.{k} = s.{k}" for k in keys)
    return f"""
    select m.*, c.rows, c.checksum from ({upkeep._sync_sql(name)}) m, (
        select {', '.join(content(CONTENTS[name], "cast('0x' || {} as bigint)"))} from (
            select * from ({HELD[name]}) union all by name
            select s.* from {name} s where not exists (select 1 from ({HELD[name]}) d where {match}))) c"""


SYNCED_TABLES = 'select *, cast(0 as bigint) as synced_again from (' + " union all ".join(_synced_sql(n) for n in HELD) + ")"


def synced_whole(t: DriverTables):
    """Videos carried whole: the store's version is replaced, its rows that the source lacks stay."""
    def work(database: str, folder: str):
        tables.append("videos", t["stored_videos"], database)
        write = sync.store_sink(database, f"{folder}/versions")
        sync.sync_stores(t.spark, {"videos": tables.conform("videos", t["videos"])}, tables.load_catalog(t.spark, database, ["videos"]), write, ["videos"])
        return _load(t, database, "videos").select("video_id", "channel_id", "title", "privacy_status", "published_at", "description")
    return in_store(t, ["videos"], work)


SYNCED_WHOLE = """
    select cast(video_id as varchar) as video_id, cast(channel_id as varchar) as channel_id, title, privacy_status,
           cast(published_at as timestamp) as published_at, description
    from videos
    union all select cast(video_id as varchar), cast(channel_id as varchar), title, privacy_status, cast(published_at as timestamp), null
    from stored_videos where video_id not in (select video_id from videos)"""

# --- runs -----------------------------------------------------------------------------------------

DAY_1, DAY_2 = "2024-02-01 06:00:00", "2024-02-02 06:00:00"


def _videos_landed(title: str, factor: int, where: str) -> str:
    return f"""
    select to_json(named_struct('id', cast(o_orderkey as string),
        'snippet', named_struct('channelId', cast(o_custkey as string), 'title', concat('{title} ', o_orderkey), 'description', '0:00 Start'),
        'statistics', named_struct('viewCount', cast(cast(floor(o_totalprice) as bigint) * {factor} as string), 'commentCount', '7'))) as value
    from orders where {where}"""


CRAWLS = [(DAY_1, _videos_landed("First", 1, "true")), (DAY_2, _videos_landed("Again", 2, "o_orderstatus <> 'F'"))]


def landing_runs(t: DriverTables):
    """Two crawls of videos with broken lines and items without a key; the second run is repeated, then the first."""
    def work(database: str, folder: str):
        runs = []
        for k, (day, query) in enumerate(CRAWLS, 1):
            path = f"{folder}/landing-{k}"
            broken = t["supplier"].select(F.concat(F.lit("{broken "), "s_name").alias("value"))
            keyless = t["nation"].select(F.to_json(F.struct(F.struct(F.col("n_name").alias("title")).alias("snippet"))).alias("value"))
            t.sql(query).unionByName(broken).unionByName(keyless).write.text(path)
            runs.append((_run(t, database, folder, f"run-{k}", day), {"video": path}))
        for run, landing in (*runs, runs[1], runs[0]):
            jobs.apply_landing(run, landing, resumable=True)
        shown = {
            "videos": ("video_id", "title", F.lit(0).cast("bigint"), "updated_at"),
            "video_stats": ("video_id", F.lit(None).cast("string"), "view_count", "fetched_at"),
            "video_comment_summary": ("video_id", F.lit(None).cast("string"), "latest_youtube_comment_count", "last_stats_fetch"),
            "chapters": ("video_id", "title", "start_seconds", F.lit(None).cast("timestamp")),
            "fetch_log": ("channel_id", F.concat_ws(" / ", "fetch_type", "status", "errors"), "videos_fetched", "completed_at"),
            "fetch_progress": ("channel_id", F.concat("operation", F.lit(" "), "video_id"), F.lit(0).cast("bigint"), "last_updated"),
        }
        parts = [_load(t, database, name).select(F.lit(name).alias("table"), *[(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(
            columns, ("key", "text", "number", "moment"))]) for name, columns in shown.items()]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows
    return in_store(t, ["videos", "video_stats", "video_comment_summary", "chapters", "fetch_log", "fetch_progress", "comments"], work)


LANDING_RUNS = f"""
    with seen as (select *, o_orderstatus <> 'F' as twice from orders),
    bad as (select concat('video: ', (select count(*) from supplier), ' unreadable lines, ', (select count(*) from nation), ' rows without a key') as text),
    rows_of as (
        select 'videos' as "table", o_orderkey as key, concat(case when twice then 'Again ' else 'First ' end, o_orderkey) as text, 0 as number,
               case when twice then timestamp '{DAY_2}' else timestamp '{DAY_1}' end as moment from seen
        union all select 'video_stats', o_orderkey, null, floor(o_totalprice), timestamp '{DAY_1}' from seen
        union all select 'video_stats', o_orderkey, null, floor(o_totalprice) * 2, timestamp '{DAY_2}' from seen where twice
        union all select 'video_comment_summary', o_orderkey, null, 7, case when twice then timestamp '{DAY_2}' else timestamp '{DAY_1}' end from seen
        union all select 'chapters', o_orderkey, 'Start', 0, null from seen
        union all select 'fetch_log', o_custkey, concat('backfill / completed / ', (select text from bad)), count(*), timestamp '{DAY_1}' from seen group by o_custkey
        union all select 'fetch_log', o_custkey, concat('incremental / completed / ', (select text from bad)), count(*), timestamp '{DAY_2}' from seen
        where twice group by o_custkey
        union all select 'fetch_progress', o_custkey, concat('videos ', o_orderkey), 0, timestamp '{DAY_1}' from seen)
    select "table", cast(key as varchar) as key, text, cast(number as bigint) as number, moment from rows_of"""

# An attempt per document: the lines as segments, a track by language; every fifth failed, every seventh has no segments.
ATTEMPTS = """
    select to_json(named_struct('video_id', cast(doc_id as string),
        'tracks', array(named_struct('language', 'other', 'language_code', 'xx', 'is_generated', false, 'is_translatable', lang = 'de'),
                        named_struct('language', source, 'language_code', lang, 'is_generated', doc_id % 2 = 1, 'is_translatable', false)),
        'segments', case when doc_id % 7 <> 0 then transform(split(text, chr(10)), (l, i) ->
            named_struct('start', i * 2.5d, 'duration', 2.5d, 'text', l)) end,
        'failed', doc_id % 5 = 0 and doc_id % 7 = 0, 'reason', case when doc_id % 2 = 0 then 'HTTP 429' else 'Transcripts disabled' end)) as value
    from documents"""


def landed_transcripts(t: DriverTables):
    """Raw attempts to the stored table, segments and all; a transcript stored before stays as it is."""
    def work(database: str, folder: str):
        path = f"{folder}/landing"
        t.sql(ATTEMPTS).write.text(path)
        tables.append("transcripts", t.sql("select doc_id as video_id, 'kept' as language, 'kept' as full_text from documents where doc_id % 11 = 1"), database)
        run = _run(t, database, folder, as_of=DAY_1)
        for _ in range(2):
            jobs.apply_landing(run, {"transcript": path})
        return _load(t, database, "transcripts").select(
            "video_id", "language", "language_code", "transcript_type", "full_text", F.posexplode_outer("entries").alias("place", "entry"), "fetched_at").select(
            "video_id", "language", "language_code", "transcript_type", "full_text", "place", "entry.*", "fetched_at")
    return in_store(t, ["transcripts", "videos", "fetch_log", "comments", "video_comment_summary"], work)


LANDED_TRANSCRIPTS = f"""
    with usable as (
        select *, case when lang = 'en' and doc_id % 2 = 0 then 'manual' when lang = 'en' then 'auto-generated' when lang = 'de' then 'translated' end as kind
        from documents where doc_id % 7 <> 0 and doc_id % 11 <> 1),
    spoken as (select *, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as spot
               from usable where kind is not null)
    select cast(doc_id as varchar) as video_id, case kind when 'translated' then 'English (translated)' else source end as language, 'en' as language_code,
           kind as transcript_type, replace(text, chr(10), ' ') as full_text, cast(spot as integer) as place, spot * 2.5::double as start,
           2.5::double as duration, spot * 2.5::double + 2.5 as "end", line as text, timestamp '{DAY_1}' as fetched_at
    from spoken
    union all select cast(doc_id as varchar), 'kept', null, null, 'kept', null, null, null, null, null, null from documents where doc_id % 11 = 1"""



def streamed_comments(t: DriverTables):
    """Threads that land in two lots, streamed into the stored table lot by lot, and all of them once more from the start."""
    def work(database: str, folder: str):
        start = F.concat(F.lit('{"video_id":"'), "video_id", F.lit('","fetched_at":"2024-02-01T06:00:00Z",'))
        lines = t.sql(shaping_queries.THREAD_JSON).select("position", F.concat(start, F.expr("substr(json, 2)")).alias("value"))
        broken = t["supplier"].select(F.concat(F.lit("{broken "), "s_name").alias("value"))
        for lot in (0, 1):
            lines.filter(F.col("position") % 2 == lot).select("value").unionByName(broken).write.mode("append").text(f"{folder}/in")
            ingest.ingest_comments(t.spark, f"{folder}/in", f"{folder}/checkpoint", database, shaping_queries.MAX_REPLIES).awaitTermination()
        ingest.ingest_comments(t.spark, f"{folder}/in", f"{folder}/again", database, shaping_queries.MAX_REPLIES).awaitTermination()
        return _load(t, database, "comments").select(
            "video_id", "comment_id", "parent_comment_id", "author_display_name", "author_channel_id", "text", "like_count", "published_at")
    return in_store(t, ["comments"], work)


# What went wrong, per channel: errors, signups and purchases end a run in one way each, views only warn.
KIND = "case event_type when 'error' then 'failed' when 'signup' then 'timeout' when 'purchase' then 'quota_exhausted' else 'warning' end"
EVENTS_LANDED = f"""
    select to_json(named_struct('channel_id', cast(user_id as string), 'kind', {KIND}, 'reason', concat(event_type, ' ', event_id),
                                'fetched_at', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))) as value
    from events where event_type <> 'click'"""


def run_outcomes(t: DriverTables):
    """Landed events to the run log: one of four statuses and the first ten reasons of every channel."""
    def work(database: str, folder: str):
        path = f"{folder}/landing"
        t.sql(EVENTS_LANDED).write.text(path)
        jobs.apply_landing(_run(t, database, folder, as_of=DAY_1), {"outcome": path})
        return _load(t, database, "fetch_log").select("channel_id", "fetch_type", "started_at", "completed_at", "videos_fetched", "errors", "status")
    return in_store(t, ["fetch_log", "videos"], work)


RUN_OUTCOMES = f"""
    with told as (
        select user_id as channel_id, {KIND} as kind, concat(event_type, ' ', event_id) as reason, ts, event_id from events where event_type <> 'click'),
    ended as (select channel_id, arg_min(kind, ts) as status from told where kind <> 'warning' group by channel_id),
    first_ten as (select *, row_number() over (partition by channel_id order by ts, event_id) as place from told)
    select cast(channel_id as varchar) as channel_id, 'backfill' as fetch_type, timestamp '{DAY_1}' as started_at, timestamp '{DAY_1}' as completed_at,
           cast(0 as bigint) as videos_fetched, string_agg(reason, '; ' order by place) as errors, coalesce(any_value(status), 'completed') as status
    from first_ten left join ended using (channel_id) where place <= 10 group by channel_id"""

# A later listing: urgent orders are gone from it, and listings of some customers are cut short (their announced number is higher).
LISTED = "select o_custkey as channel_id, o_orderkey as video_id from orders where o_orderpriority <> '1-URGENT'"
DECLARED = """
    select o_custkey as channel_id, count(*) filter (where o_orderpriority <> '1-URGENT') + case when o_custkey % 3 = 0 then 1 else 0 end as total
    from orders group by o_custkey"""
LATER = "2001-10-01 00:00:00"
LIFE_TABLES = ["videos", "video_stats", "chapters", "transcripts", "comments", "video_comment_summary"]
TALK = "select l_orderkey * 10 + l_linenumber as comment_id, l_orderkey as video_id, l_returnflag as text, l_shipdate as fetched_at from lineitem"
SPOKEN = "select doc_id as video_id, lang as language_code, text as full_text from documents"


def deletion_runs(t: DriverTables):
    """Complete listings mark what they no longer have, twice; a later purge takes the videos deleted before, from all six tables."""
    def work(database: str, folder: str):
        for name, rows in (("videos", t["videos"]), ("video_stats", t["video_stats"]), ("chapters", t["chapters"]), ("transcripts", t.sql(SPOKEN)),
                           ("comments", t.sql(TALK)), ("video_comment_summary", t["plan_summary"])):
            tables.append(name, rows, database)
        text = lambda rows: rows.select(*[F.col(c).cast("string" if c != "total" else "bigint").alias(c) for c in rows.columns])
        run, late = _run(t, database, folder, "run-1"), _run(t, database, folder, "run-2", LATER)
        for _ in range(2):
            jobs.apply_listing(run, text(t.sql(LISTED)), text(t.sql(DECLARED)))
        purged = jobs.purge(late)
        left = None
        for name in LIFE_TABLES:
            df = _load(t, database, name)
            own = {"videos": ("privacy_status", "updated_at"), "video_stats": ("view_count", "fetched_at"), "chapters": ("title", None),
                   "transcripts": ("language_code", None), "comments": ("comment_id", "fetched_at"), "video_comment_summary": ("stored_comment_count", "last_stats_fetch")}[name]
            part = df.select(F.lit(name).alias("table"), "video_id", F.col(own[0]).cast("string").alias("text"),
                             (F.col(own[1]) if own[1] else F.lit(None)).cast("timestamp").alias("moment"))
            left = part if left is None else left.unionByName(part)
        counts = purged.select(F.concat(F.lit("purged "), "table").alias("table"), F.lit(None).cast("string").alias("video_id"),
                               F.col("purged").cast("string").alias("text"), F.lit(None).cast("timestamp").alias("moment"))
        return left.unionByName(counts)
    return in_store(t, LIFE_TABLES, work)


DELETION_RUNS = f"""
    with proof as (
        select d.channel_id from ({DECLARED}) d left join (select channel_id, count(distinct video_id) as n from ({LISTED}) group by channel_id) l
        on d.channel_id = l.channel_id where coalesce(l.n, 0) >= d.total),
    marked as (
        select video_id, privacy_status = 'deleted' as before,
               privacy_status <> 'deleted' and channel_id in (select channel_id from proof)
               and video_id not in (select video_id from ({LISTED})) as gone, privacy_status, updated_at
        from videos),
    after as (
        select video_id, case when gone then 'deleted' else privacy_status end as privacy_status,
               case when gone then timestamp '{PLAN_AS_OF}' else cast(updated_at as timestamp) end as updated_at from marked),
    victims as (select video_id from after where privacy_status = 'deleted' and updated_at < timestamp '{LATER}' - interval 30 day),
    spread as (
        select 'videos' as "table", video_id, privacy_status as text, updated_at as moment from after
        union all select 'video_stats', video_id, cast(view_count as varchar), fetched_at from video_stats
        union all select 'chapters', video_id, title, null from chapters
        union all select 'transcripts', video_id, language_code, null from ({SPOKEN})
        union all select 'comments', video_id, cast(comment_id as varchar), fetched_at from ({TALK})
        union all select 'video_comment_summary', video_id, cast(stored_comment_count as varchar), last_stats_fetch from plan_summary)
    select "table", cast(video_id as varchar) as video_id, text, cast(moment as timestamp) as moment from spread where video_id not in (select video_id from victims)
    union all select concat('purged ', "table"), null, cast(count(v.video_id) as varchar), null
    from spread s left join victims v on s.video_id = v.video_id group by "table" """

# --- search listings ------------------------------------------------------------------------------

# A page of hits per order: a video with a date, one without, and a channel.
SEARCH_PAGES = """
    select o_custkey as channel_id, o_orderkey as page_number, to_json(named_struct('items', array(
        named_struct('id', named_struct('videoId', concat('a', o_orderkey)), 'snippet', named_struct('publishedAt', concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T12:00:00Z'))),
        named_struct('id', case when o_orderstatus <> 'P' then named_struct('videoId', concat('b', o_orderkey)) end, 'snippet', null),
        named_struct('id', named_struct('videoId', ''), 'snippet', null)))) as json
    from orders"""
NEWEST = "select o_custkey as channel_id, max(o_orderdate) as latest_published_at from orders where o_orderdate < date '1998-01-01' group by o_custkey"


def searched_ids(t: DriverTables):
    """Search pages to new ids: after the channel's newest stored date, up to the first stored id."""
    pages = shaping.parsed(t.sql(SEARCH_PAGES), "search_page")
    listing = shaping.searched_ids(pages, t.sql(NEWEST))
    known = t.sql("select concat('b', o_orderkey) as video_id from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'O'")
    return planning.before_first_known(listing, known).select("channel_id", "video_id", "published_at", "position.page", F.col("position.at").alias("place"))


SEARCHED_IDS = f"""
    with hits as (
        select o_custkey as channel_id, concat('a', o_orderkey) as video_id, cast(o_orderdate as timestamp) + interval 12 hour as published_at, o_orderkey as page, 0 as place from orders
        union all select o_custkey, concat('b', o_orderkey), null, o_orderkey, 1 from orders where o_orderstatus <> 'P'),
    recent as (
        select h.* from hits h left join ({NEWEST}) n on h.channel_id = n.channel_id
        where n.channel_id is null or h.published_at is null or h.published_at > n.latest_published_at),
    stop as (
        select channel_id, min(page * 2 + place) as first_known from recent
        where video_id in (select concat('b', o_orderkey) from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'O') group by channel_id)
    select r.channel_id, r.video_id, r.published_at, r.page, r.place from recent r left join stop s on r.channel_id = s.channel_id
    where s.first_known is null or r.page * 2 + r.place < s.first_known"""

QUERIES = {
    "r03_growth_stored": (growth, GROWTH),
    "r06_comment_velocity_stored": (comment_velocity, COMMENT_VELOCITY),
    "r08_subscriber_growth_stored": (subscriber_growth, report_queries.SUBSCRIBER_GROWTH),
    "p15_searched_ids": (searched_ids, SEARCHED_IDS),
    "m02_merged_videos": (merged_videos, MERGED_VIDEOS),
    "m06_late_stats": (late_stats, LATE_SUMMARY),
    "m07_stored_comments": (stored_comments, STORED_COMMENTS),
    "m11_stored_chapters": (stored_chapters, STORED_CHAPTERS),
    "m16_stored_progress": (stored_progress, STORED_PROGRESS),
    "s04_synced_whole": (synced_whole, SYNCED_WHOLE),
    "s06_synced_tables": (synced_tables, SYNCED_TABLES),
    "j01_landing_runs": (landing_runs, LANDING_RUNS),
    "j02_landed_transcripts": (landed_transcripts, LANDED_TRANSCRIPTS),
    "j03_deletion_runs": (deletion_runs, DELETION_RUNS),
    "j05_streamed_comments": (streamed_comments, shaping_queries.COMMENT_THREADS),
    "j04_run_outcomes": (run_outcomes, RUN_OUTCOMES),
}
