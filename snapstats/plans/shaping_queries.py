"""Payload shaping and quota analytics over the test tables.

Raw payloads are JSON text that Spark writes from the tables, row by row; the checking SQL goes
straight from the tables to the expected rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from snapstats.functions.numeric import count_or_zero
from snapstats.functions.text import count_label, iso_duration_seconds, json_to_list, json_to_map, list_to_json
from snapstats.operators import planning, shaping, usage
from snapstats.plans.driver_tables import EVENTS_AS_OF, DriverTables

# --- metadata payloads ----------------------------------------------------------------------------

CHANNEL_JSON = """
    select to_json(named_struct(
        'id', cast(c_custkey as string),
        'snippet', named_struct('title', c_name, 'customUrl', concat('@', lower(c_mktsegment)), 'country', c_mktsegment,
            'publishedAt', '2020-02-03T04:05:06Z',
            'thumbnails', named_struct(
                'high', case when c_acctbal > 0 then named_struct('url', concat('h/', c_name)) end,
                'default', case when c_nationkey > 3 then named_struct('url', concat('d/', c_name)) end)),
        'statistics', named_struct('subscriberCount', cast(cast(floor(c_acctbal) as bigint) as string),
            'viewCount', cast(c_acctbal as string)),
        'topicDetails', case when c_nationkey > 12 then named_struct('topicCategories', array(c_mktsegment, c_name)) end,
        'contentDetails', named_struct('relatedPlaylists', named_struct('uploads', concat('UU', c_name))))) as json
    from customer"""


def channel_payload(t: DriverTables):
    rows = shaping.channel_rows(shaping.parsed(t.sql(CHANNEL_JSON), "channel"))
    return rows.withColumn("topic_categories", list_to_json(F.col("topic_categories")))


CHANNEL_PAYLOAD = """
    select cast(c_custkey as varchar) as channel_id, c_name as title, cast(null as varchar) as description,
           concat('@', lower(c_mktsegment)) as custom_url, c_mktsegment as country,
           timestamp '2020-02-03 04:05:06' as published_at,
           case when c_acctbal > 0 then concat('h/', c_name) when c_nationkey > 3 then concat('d/', c_name) end as thumbnail_url,
           cast(null as varchar) as banner_url, cast(null as varchar) as keywords,
           case when c_nationkey > 12 then concat('["', c_mktsegment, '","', c_name, '"]') else '[]' end as topic_categories,
           concat('UU', c_name) as uploads_playlist_id, cast(floor(c_acctbal) as bigint) as subscriber_count,
           cast(0 as bigint) as view_count, cast(0 as bigint) as video_count
    from customer"""

VIDEO_JSON = """
    select to_json(named_struct(
        'id', case when o_orderstatus = 'P' and o_totalprice < 100000 then '' else cast(o_orderkey as string) end,
        'snippet', named_struct('channelId', cast(o_custkey as string), 'title', concat('Order ', o_orderkey),
            'description', concat('0:00 Intro', chr(10), cast(1 + o_orderkey % 9 as string), ':30 - Middle'),
            'publishedAt', case when o_orderpriority <> '5-LOW' then concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T10:00:00+02:00')
                           else 'unknown' end,
            'tags', case when o_orderstatus = 'F' then array(o_orderpriority, o_orderstatus) end),
        'contentDetails', named_struct('duration', concat('PT', cast(o_custkey as string), 'M'),
            'caption', case when o_orderstatus = 'O' then 'true' else 'false' end, 'definition', 'hd'),
        'status', named_struct('privacyStatus', 'public', 'embeddable', case when o_orderstatus = 'O' then true end),
        'statistics', named_struct('viewCount', cast(cast(floor(o_totalprice) as bigint) as string),
            'likeCount', cast(o_totalprice as string)))) as json
    from orders"""


def _video_items(t: DriverTables):
    return shaping.video_rows(shaping.parsed(t.sql(VIDEO_JSON), "video"))


def video_payload(t: DriverTables):
    return shaping.valid_rows(_video_items(t), "video_id").select(
        "video_id", "channel_id", "title", "published_at", "duration_seconds", list_to_json(F.col("tags")).alias("tags"),
        "thumbnail_url", "caption_available", "definition", "privacy_status", "embeddable", "made_for_kids",
        "has_chapters", "view_count", "like_count", "comment_count")


VALID_ORDER = "not (o_orderstatus = 'P' and o_totalprice < 100000)"
VIDEO_PAYLOAD = f"""
    select cast(o_orderkey as varchar) as video_id, cast(o_custkey as varchar) as channel_id,
           concat('Order ', o_orderkey) as title,
           case when o_orderpriority <> '5-LOW' then date_trunc('day', o_orderdate) + interval 8 hour end as published_at,
           o_custkey * 60 as duration_seconds,
           case when o_orderstatus = 'F' then concat('["', o_orderpriority, '","F"]') else '[]' end as tags,
           cast(null as varchar) as thumbnail_url, o_orderstatus = 'O' as caption_available, 'hd' as definition,
           'public' as privacy_status, o_orderstatus = 'O' as embeddable, false as made_for_kids, true as has_chapters,
           cast(floor(o_totalprice) as bigint) as view_count,
           case when regexp_full_match(cast(o_totalprice as varchar), '[0-9]+') then cast(o_totalprice as bigint)
                else 0 end as like_count, cast(0 as bigint) as comment_count
    from orders where {VALID_ORDER}"""


def rejected_payload(t: DriverTables):
    """Items without an id, set aside."""
    return shaping.rejected_rows(_video_items(t), "video_id").select("channel_id", "title")


REJECTED_PAYLOAD = f"""
    select cast(o_custkey as varchar) as channel_id, concat('Order ', o_orderkey) as title
    from orders where not {VALID_ORDER}"""

PLAYLIST_JSON = """
    select p_size as channel_id, to_json(named_struct(
        'id', cast(p_partkey as string),
        'snippet', named_struct('title', p_name, 'publishedAt', '2021-01-01T00:00:00Z'),
        'contentDetails', case when p_size > 10 then named_struct('itemCount', p_size) end,
        'status', named_struct('privacyStatus', p_type))) as json
    from part"""


def playlist_payload(t: DriverTables):
    return shaping.playlist_rows(shaping.parsed(t.sql(PLAYLIST_JSON), "playlist"))


PLAYLIST_PAYLOAD = """
    select cast(p_partkey as varchar) as playlist_id, p_size as channel_id, p_name as title,
           cast(null as varchar) as description, timestamp '2021-01-01 00:00:00' as published_at,
           cast(null as varchar) as thumbnail_url, case when p_size > 10 then p_size else 0 end::bigint as item_count,
           p_type as privacy_status
    from part"""

THUMBNAIL_JSON = CHANNEL_JSON


def thumbnails(t: DriverTables):
    items = shaping.parsed(t.sql(THUMBNAIL_JSON), "channel")
    return items.select(F.col("item.id").alias("id"), shaping.thumbnail(F.col("item.snippet")).alias("thumbnail_url"))


THUMBNAILS = """
    select cast(c_custkey as varchar) as id, coalesce(case when c_acctbal > 0 then concat('h/', c_name) end,
           case when c_nationkey > 3 then concat('d/', c_name) end) as thumbnail_url
    from customer"""


def counts(t: DriverTables):
    """Counts delivered as text: whole, padded, fractional and no number at all."""
    text = {"size": F.col("p_size").cast("string"), "padded": F.concat(F.lit("  "), F.col("p_size").cast("string"), F.lit(" ")),
            "price": F.col("p_retailprice").cast("string"), "kind": F.col("p_type")}
    return t["part"].select("p_partkey", *[count_or_zero(c).alias(n) for n, c in text.items()])


COUNTS = """
    select p_partkey, cast(p_size as bigint) as size, cast(p_size as bigint) as padded, cast(0 as bigint) as price,
           cast(0 as bigint) as kind
    from part"""


def durations(t: DriverTables):
    return t["videos"].select("video_id", iso_duration_seconds(F.col("duration_iso")).alias("seconds"),
                              iso_duration_seconds(F.col("title")).alias("no_duration"))


DURATIONS = r"""
    select video_id, cast(regexp_extract(duration_iso, 'PT(\d+)H', 1) as bigint) * 3600
           + cast(regexp_extract(duration_iso, 'H(\d+)M', 1) as bigint) * 60 as seconds,
           cast(null as bigint) as no_duration
    from videos"""


def chapters(t: DriverTables):
    return shaping.chapter_rows(t["videos"])


CHAPTERS = r"""
    with lines as (
        select video_id, duration_seconds, unnest(string_split(description, chr(10))) as line,
               generate_subscripts(string_split(description, chr(10)), 1) as spot
        from videos),
    found as (
        select *, regexp_extract(line, '^(?:(\d{1,2}):)?(\d{1,2}):(\d{2})[\s\-:]+(.+)$', ['h', 'm', 's', 'title']) as p
        from lines where regexp_matches(line, '^(?:(\d{1,2}):)?(\d{1,2}):(\d{2})[\s\-:]+(.+)$')),
    timed as (
        select video_id, duration_seconds, spot, p.title as title,
               coalesce(try_cast(p.h as bigint), 0) * 3600 + cast(p.m as bigint) * 60 + cast(p.s as bigint) as start_seconds
        from found)
    select video_id, cast(row_number() over w - 1 as integer) as chapter_index, title, start_seconds,
           coalesce(lead(start_seconds) over w, nullif(duration_seconds, 0)) as end_seconds
    from timed window w as (partition by video_id order by spot)"""

# --- comments -------------------------------------------------------------------------------------

# A document is a thread: its first line the comment, the further lines its replies.
THREAD_JSON = """
    select source as video_id, doc_id as position, to_json(named_struct(
        'id', cast(doc_id as string),
        'snippet', named_struct('topLevelComment', named_struct('snippet', named_struct(
            'authorDisplayName', lang, 'authorChannelId', case when lang <> 'de' then named_struct('value', lang) end,
            'textDisplay', lines[0], 'likeCount', n_chars,
            'publishedAt', case when lang <> 'fr' then cast(timestamp '2024-01-01 00:00:00' + doc_id * interval '1' minute as string) end))),
        'replies', case when size(lines) > 1 then named_struct('comments', transform(slice(lines, 2, size(lines)), (l, i) ->
            named_struct('id', concat(doc_id, '.', i), 'snippet', named_struct('authorDisplayName', 'reply', 'textDisplay', l)))) end)) as json
    from (select *, split(text, chr(10)) as lines from documents)"""
MAX_REPLIES = 3


def _threads(t: DriverTables):
    return shaping.parsed(t.sql(THREAD_JSON), "comment_thread")


def comment_threads(t: DriverTables):
    return shaping.comment_rows(_threads(t), MAX_REPLIES).drop("updated_at")


COMMENT_THREADS = f"""
    select source as video_id, case when spot = 1 then cast(doc_id as varchar) else concat(doc_id, '.', spot - 2) end as comment_id,
           case when spot > 1 then cast(doc_id as varchar) end as parent_comment_id,
           case when spot = 1 then lang else 'reply' end as author_display_name,
           case when spot = 1 and lang <> 'de' then lang end as author_channel_id, line as text,
           case when spot = 1 then n_chars else 0 end as like_count,
           case when spot = 1 and lang <> 'fr' then timestamp '2024-01-01 00:00:00' + to_minutes(doc_id) end as published_at
    from (select *, unnest(string_split(text, chr(10))) as line,
                 generate_subscripts(string_split(text, chr(10)), 1) as spot from documents)
    where spot <= 1 + {MAX_REPLIES}"""

# Comments stored so far: the documents of each source that are labelled toxic, English ones apart.
SEEN = """
    select d.source as video_id, timestamp '2024-01-01 00:00:00' + d.doc_id * interval '1' minute as published_at
    from documents d join labels l on d.doc_id = l.doc_id where l.toxic = 1 and d.lang <> 'en'"""


def threads_since(t: DriverTables):
    latest = planning.latest_comment_times(t.sql(SEEN))
    fresh = shaping.threads_since(_threads(t), latest)
    return fresh.select("video_id", F.col("item.id").alias("thread_id"))


THREADS_SINCE = """
    with latest as (
        select d.source as video_id, max(d.doc_id) as newest from documents d join labels l on d.doc_id = l.doc_id
        where l.toxic = 1 and d.lang <> 'en' group by d.source)
    select d.source as video_id, cast(d.doc_id as varchar) as thread_id
    from documents d left join latest l on d.source = l.video_id
    where l.newest is null or d.lang = 'fr' or d.doc_id > l.newest"""

MAX_RESULTS = 60


def capped_threads(t: DriverTables):
    return shaping.capped_threads(_threads(t), MAX_RESULTS, MAX_REPLIES).select(
        "video_id", F.col("item.id").alias("thread_id"))


CAPPED_THREADS = f"""
    select video_id, thread_id from (
        select source as video_id, cast(doc_id as varchar) as thread_id,
               coalesce(sum(least(len(string_split(text, chr(10))), 1 + {MAX_REPLIES}))
                        over (partition by source order by doc_id rows between unbounded preceding and 1 preceding), 0) as taken
        from documents)
    where taken < {MAX_RESULTS}"""

# --- transcripts ----------------------------------------------------------------------------------

TRACKS = """
    select doc_id % 50 as video_id, source as language, case lang when 'de' then 'en-GB' else lang end as language_code,
           n_chars % 2 = 1 as is_generated, n_chars % 3 = 0 as is_translatable, doc_id as position
    from documents"""


def choose_track(t: DriverTables):
    return shaping.choose_track(t.sql(TRACKS))


CHOOSE_TRACK = f"""
    with ranked as (
        select *, case when list_contains(['en', 'en-US', 'en-GB'], language_code) and not is_generated then 'manual'
                       when list_contains(['en', 'en-US', 'en-GB'], language_code) then 'auto-generated'
                       when is_translatable then 'translated' end as transcript_type
        from ({TRACKS})),
    best as (
        select *, row_number() over (partition by video_id order by
            case transcript_type when 'manual' then 1 when 'auto-generated' then 2 else 3 end,
            case when transcript_type <> 'translated' then list_position(['en', 'en-US', 'en-GB'], language_code) end,
            position) as rn
        from ranked where transcript_type is not null)
    select video_id, transcript_type,
           case transcript_type when 'translated' then 'English (translated)' else language end as language,
           case transcript_type when 'translated' then 'en' else language_code end as language_code, is_generated,
           case transcript_type when 'translated' then language end as original_language,
           case transcript_type when 'translated' then language_code end as original_language_code
    from best where rn = 1"""


def transcript_segments(t: DriverTables):
    """A document's lines as segments of two and a half seconds."""
    lines = F.split("text", "\n")
    segments = F.transform(lines, lambda line, i: F.struct(
        (i * 2.5).alias("start"), F.lit(2.5).alias("duration"), line.alias("text")))
    rows = shaping.transcript_rows(t["documents"].select(F.col("doc_id").alias("video_id"), segments.alias("segments")))
    return rows.select("video_id", F.md5("full_text").alias("full_text"), "snippet_count", F.posexplode("entries").alias("place", "entry")).select(
        "video_id", "full_text", "snippet_count", "place", "entry.*")


TRANSCRIPT_SEGMENTS = """
    with spoken as (
        select doc_id, text, string_split(text, chr(10)) as lines, generate_subscripts(string_split(text, chr(10)), 1) - 1 as spot from documents)
    select doc_id as video_id, md5(replace(text, chr(10), ' ')) as full_text, cast(len(lines) as integer) as snippet_count,
           cast(spot as integer) as place, spot * 2.5::double as start, 2.5::double as duration, spot * 2.5::double + 2.5 as "end",
           lines[spot + 1] as text
    from spoken"""

OUTCOMES = """
    select event_id as video_id, event_type = 'purchase' as available, event_type in ('error', 'signup') as failed,
           case event_type when 'purchase' then 'manual (en)' when 'view' then 'Transcripts disabled by uploader'
                when 'click' then 'Video unavailable' when 'error' then concat('HTTP 429 ', props)
                else 'unreadable reply' end as reason
    from events"""
OUTCOME = "case event_type when 'purchase' then 'success' when 'view' then 'disabled' when 'click' then 'unavailable' " \
          "when 'error' then 'blocked' else 'error' end"


def _outcomes(t: DriverTables):
    return shaping.classify_outcomes(t.sql(OUTCOMES))


def outcomes(t: DriverTables):
    return _outcomes(t).select("video_id", "outcome")


OUTCOMES_SQL = f"select event_id as video_id, {OUTCOME} as outcome from events"


def outcome_totals(t: DriverTables):
    return shaping.outcome_totals(_outcomes(t))


OUTCOME_TOTALS = f"""
    select count(*) as total, count(*) filter (where o = 'success') as success,
           count(*) filter (where o = 'unavailable') as unavailable, count(*) filter (where o = 'disabled') as disabled,
           count(*) filter (where o = 'blocked') as blocked, count(*) filter (where o = 'error') as error,
           round(100.0::double * count(*) filter (where o = 'success') / count(*), 1) as found_pct
    from (select {OUTCOME} as o from events)"""


def failure_breakdown(t: DriverTables):
    found = shaping.failure_breakdown(_outcomes(t))
    return found.select("outcome", "videos", F.posexplode("examples").alias("at", "example")).select(
        "outcome", "videos", "at", "example.video_id", "example.reason")


FAILURE_BREAKDOWN = f"""
    select outcome, videos, cast(rn - 1 as integer) as at, video_id, reason from (
        select o.video_id, o.reason, {OUTCOME} as outcome, row_number() over (partition by event_type order by event_id) as rn,
               count(*) over (partition by event_type) as videos
        from events e join ({OUTCOMES}) o on e.event_id = o.video_id where event_type <> 'purchase')
    where rn <= case when videos <= 5 then 5 else 3 end"""


def success_breakdown(t: DriverTables):
    return shaping.success_breakdown(choose_track(t))


SUCCESS_BREAKDOWN = f"select transcript_type, count(*) as videos from ({CHOOSE_TRACK}) group by transcript_type"

# --- identifiers, listings, lists, labels ---------------------------------------------------------

IDENTIFIERS = """
    select concat('@', replace(p_name, ' ', '.')) as identifier from part
    union all select concat('https://www.youtube.com/@', replace(c_name, '#', '-'), '/videos') from customer
    union all select concat('https://www.youtube.com/channel/UC', lpad(cast(s_suppkey as string), 22, '0')) from supplier
    union all select concat('UC', lpad(cast(o_orderkey as string), 22, '0')) from orders
    union all select concat('  ', n_name, ' ') from nation
    union all select concat('https://www.youtube.com/channel/', r_name) from region"""


def identifiers(t: DriverTables):
    return shaping.parse_identifiers(t.sql(IDENTIFIERS))


IDENTIFIERS_SQL = """
    select concat('@', replace(p_name, ' ', '.')) as identifier, 'handle' as kind, replace(p_name, ' ', '.') as value from part
    union all select concat('https://www.youtube.com/@', replace(c_name, '#', '-'), '/videos'), 'handle', replace(c_name, '#', '-')
        from customer
    union all select concat('https://www.youtube.com/channel/UC', lpad(cast(s_suppkey as varchar), 22, '0')), 'id',
        concat('UC', lpad(cast(s_suppkey as varchar), 22, '0')) from supplier
    union all select concat('UC', lpad(cast(o_orderkey as varchar), 22, '0')), 'id',
        concat('UC', lpad(cast(o_orderkey as varchar), 22, '0')) from orders
    union all select concat('  ', n_name, ' '), 'handle', n_name from nation
    union all select concat('https://www.youtube.com/channel/', r_name), null, null from region"""

# A page of a listing: three entries, the middle one blank where the order is closed.
PAGES = """
    select o_custkey as channel_id, o_orderkey as page_number, to_json(named_struct('items', array(
        named_struct('contentDetails', named_struct('videoId', concat('a', o_orderkey))),
        named_struct('contentDetails', named_struct('videoId', case when o_orderstatus <> 'F' then concat('b', o_orderkey) else '' end)),
        named_struct('contentDetails', case when o_orderstatus <> 'P' then named_struct('videoId', concat('c', o_orderkey)) end)))) as json
    from orders"""


def listed_ids(t: DriverTables):
    listing = shaping.listed_ids(shaping.parsed(t.sql(PAGES), "playlist_page"))
    return listing.select("channel_id", "video_id", "position.page", "position.at")


LISTED_IDS = """
    select o_custkey as channel_id, concat('a', o_orderkey) as video_id, o_orderkey as page, 0 as at from orders
    union all select o_custkey, concat('b', o_orderkey), o_orderkey, 1 from orders where o_orderstatus <> 'F'
    union all select o_custkey, concat('c', o_orderkey), o_orderkey, 2 from orders where o_orderstatus <> 'P'"""


def json_lists(t: DriverTables):
    """Lists to JSON and back, and the stored objects read as maps."""
    tags = F.split("p_name", " ")
    back = t["part"].select(F.col("p_partkey").alias("id"), list_to_json(tags).alias("json"))
    back = back.withColumn("items", F.size(json_to_list(F.col("json")))).withColumn(
        "first", json_to_list(F.col("json"))[0]).withColumn("k", F.lit(None).cast("bigint"))
    props = t["events"].select(
        F.col("event_id").alias("id"), F.col("props").alias("json"), F.size(json_to_map(F.col("props"))).alias("items"),
        F.lit(None).cast("string").alias("first"), F.element_at(json_to_map(F.col("props")), "k").alias("k"))
    return back.unionByName(props)


JSON_LISTS = """
    select p_partkey as id, concat('["', replace(p_name, ' ', '","'), '"]') as json,
           cast(len(string_split(p_name, ' ')) as integer) as items, string_split(p_name, ' ')[1] as first,
           cast(null as bigint) as k
    from part union all
    select event_id, props, 1, null, cast(json_extract(props, '$.k') as bigint) from events"""


def labels(t: DriverTables):
    count = F.floor(F.col("o_totalprice") * 7).cast("bigint")
    return t["orders"].select("o_orderkey", count.alias("subscribers"), count_label(count).alias("label"),
                              count_label(F.col("o_custkey")).alias("small_label"))


LABELS = """
    select o_orderkey, n as subscribers,
           case when n >= 1000000 then format('{:.1f}M', n / 1000000.0::double)
                when n >= 1000 then printf('%.0fk', round_even(n / 1000, 0)) else cast(n as varchar) end as label,
           case when o_custkey >= 1000 then printf('%.0fk', round_even(o_custkey / 1000, 0))
                else cast(o_custkey as varchar) end as small_label
    from (select *, cast(floor(o_totalprice * 7) as bigint) as n from orders)"""

# --- quota and runs -------------------------------------------------------------------------------

# Units per call in these queries; 'error' is left out and takes the one unit of the unknown.
COSTS = {"view": 1, "click": 1, "purchase": 100, "signup": 50}
COST_SQL = "case operation when 'purchase' then 100 when 'signup' then 50 else 1 end"
BY_OPERATION = f"""
    select date, operation, cast(sum({COST_SQL} * calls) as bigint) as units from op_log group by date, operation"""
BY_DAY = f"select date, cast(sum(units) as bigint) as used from ({BY_OPERATION}) group by date"
DAY_LIMIT = 10_000


def channel_costs(t: DriverTables):
    counts = t["videos"].groupBy("channel_id").agg((F.count(F.lit(1)) * 40).alias("video_count"))
    return usage.estimate_channel_costs(counts, max_videos=500, max_comments_per_video=250)


CHANNEL_COSTS = """
    select channel_id, cast(1 as bigint) as channels_list, cast(2 as bigint) as playlists_list,
           n // 50 + 1 as "playlistItems_list", n // 50 + 1 as videos_list, n * 2 as "commentThreads_list",
           1 + 2 + 2 * (n // 50 + 1) + n * 2 as total
    from (select channel_id, least(count(*) * 40, 500) as n from videos group by channel_id)"""


def operation_usage(t: DriverTables):
    return usage.operation_usage(t["op_log"], COSTS)


def _days(t: DriverTables):
    return usage.daily_usage(t["op_log"], COSTS, EVENTS_AS_OF)


def saved_usage(t: DriverTables):
    """Days with their operation maps, merged over an earlier state and read back."""
    early = usage.daily_usage(t["op_log"].filter(F.col("operation") != "purchase"), COSTS, EVENTS_AS_OF)
    saved = usage.save_usage(early, _days(t))
    return usage.usage_by_operation(saved).join(saved.select("date", "used"), "date")


SAVED_USAGE = f"""
    select o.date, o.operation, o.units, d.used from ({BY_OPERATION}) o join ({BY_DAY}) d on o.date = d.date"""


def quota_status(t: DriverTables):
    return usage.quota_status(_days(t), DAY_LIMIT, planned_cost=500)


QUOTA_STATUS = f"""
    select date, used, greatest(0, {DAY_LIMIT} - used) as remaining, used / {DAY_LIMIT} as used_fraction,
           case when used / {DAY_LIMIT} >= 0.95 then 'critical' when used / {DAY_LIMIT} >= 0.8 then 'warning' else 'ok' end as state,
           used + 500 <= {DAY_LIMIT} * 0.95::double as can_afford,
           (greatest(0, {DAY_LIMIT} - used) < 500 or (used + 500) / {DAY_LIMIT} > 0.95::double) as would_abort
    from ({BY_DAY})"""


def quota_summary(t: DriverTables):
    days = usage.quota_summary(t["op_log"], COSTS, DAY_LIMIT)
    return days.select("date", "used", "remaining", "limit", "used_fraction",
                       F.posexplode("by_operation").alias("place", "_o")).select(
        "date", "used", "remaining", "limit", "used_fraction", "place", "_o.operation", "_o.units")


QUOTA_SUMMARY = f"""
    select d.date, d.used, greatest(0, {DAY_LIMIT} - d.used) as remaining, cast({DAY_LIMIT} as bigint) as "limit",
           d.used / {DAY_LIMIT} as used_fraction,
           cast(row_number() over (partition by d.date order by o.units desc, o.operation desc) - 1 as integer) as place,
           o.operation, o.units
    from ({BY_DAY}) d join ({BY_OPERATION}) o on d.date = o.date"""


def run_totals(t: DriverTables):
    n = F.floor("value")
    return usage.run_totals(t["events"].select(
        (F.col("event_type") == "error").alias("skipped"), n.alias("videos_fetched"), (n % 5).alias("videos_new"),
        (n % 7).alias("videos_stats_updated"), (n * 3).alias("comments_fetched"), F.lit(0).cast("bigint").alias("transcripts_fetched"),
        F.when(F.col("event_type") == "error", F.split("props", " ")).otherwise(F.array().cast("array<string>")).alias("errors")))


RUN_TOTALS = """
    select count(*) filter (where event_type <> 'error') as channels,
           count(*) filter (where event_type = 'error') as channels_skipped,
           cast(sum(n) as bigint) as videos, cast(sum(n % 5) as bigint) as videos_new,
           cast(sum(n % 7) as bigint) as videos_stats_updated, cast(sum(n * 3) as bigint) as comments,
           cast(0 as bigint) as transcripts,
           cast(sum(case when event_type = 'error' then len(string_split(props, ' ')) else 0 end) as bigint) as errors
    from (select *, cast(floor(value) as bigint) as n from events)"""


def channel_options(t: DriverTables):
    """Each channel's options: its own, else the settings', else the default."""
    listed = t["customer"].select(
        F.col("c_name").alias("identifier"),
        F.when(F.col("c_nationkey") < 5, F.col("c_nationkey")).alias("max_replies_per_comment"),
        F.when(F.col("c_acctbal") < 0, F.lit("playlist")).alias("video_discovery_mode"),
        F.when(F.col("c_acctbal") > 9000, F.col("c_custkey")).alias("max_videos"))
    wanted = t["customer"].select(F.col("c_name").alias("identifier"))
    return usage.resolve_options(wanted, listed, {"max_comment_videos": 50}, {"fetch_comments": False})


CHANNEL_OPTIONS = """
    select c_name as identifier, false as fetch_comments, case when c_acctbal > 9000 then c_custkey end as max_videos,
           cast(null as bigint) as max_video_age_days, 100 as max_comments_per_video,
           case when c_nationkey < 5 then c_nationkey else 10 end as max_replies_per_comment, 50 as max_comment_videos,
           10 as min_new_comments, 6 as stats_update_hours,
           case when c_acctbal < 0 then 'playlist' else 'auto' end as video_discovery_mode, 5 as comment_workers
    from customer"""


def fetch_costs(t: DriverTables):
    counts = t["lineitem"].groupBy("l_suppkey").agg(
        (F.count(F.lit(1)) - 600).alias("comments"), F.countDistinct("l_orderkey").alias("videos"))
    return usage.fetch_costs(counts.withColumn("comments", F.greatest(F.lit(0), "comments")))


FETCH_COSTS = """
    select *, case when comments > 0 then comments // 100 + 1 else 1 end as comment_units,
           cast(ceil(videos / 50) as bigint) as video_calls
    from (select l_suppkey, greatest(0, count(*) - 600) as comments, count(distinct l_orderkey) as videos
          from lineitem group by l_suppkey)"""

QUERIES = {
    "x01_channel_payload": (channel_payload, CHANNEL_PAYLOAD),
    "x02_video_payload": (video_payload, VIDEO_PAYLOAD),
    "x03_playlist_payload": (playlist_payload, PLAYLIST_PAYLOAD),
    "x04_thumbnail_choice": (thumbnails, THUMBNAILS),
    "x05_count_validation": (counts, COUNTS),
    "x05_rejected_items": (rejected_payload, REJECTED_PAYLOAD),
    "x06_iso_duration": (durations, DURATIONS),
    "x07_chapters": (chapters, CHAPTERS),
    "x08_comment_threads": (comment_threads, COMMENT_THREADS),
    "x09_threads_since": (threads_since, THREADS_SINCE),
    "x10_capped_threads": (capped_threads, CAPPED_THREADS),
    "x11_choose_track": (choose_track, CHOOSE_TRACK),
    "x12_transcript_segments": (transcript_segments, TRANSCRIPT_SEGMENTS),
    "x13_outcome_class": (outcomes, OUTCOMES_SQL),
    "x14_outcome_totals": (outcome_totals, OUTCOME_TOTALS),
    "x14_failure_breakdown": (failure_breakdown, FAILURE_BREAKDOWN),
    "x14_success_breakdown": (success_breakdown, SUCCESS_BREAKDOWN),
    "x15_parse_identifiers": (identifiers, IDENTIFIERS_SQL),
    "x16_listed_ids": (listed_ids, LISTED_IDS),
    "x17_json_lists": (json_lists, JSON_LISTS),
    "x18_count_label": (labels, LABELS),
    "q01_channel_cost": (channel_costs, CHANNEL_COSTS),
    "q02_operation_usage": (operation_usage, BY_OPERATION),
    "q03_saved_usage": (saved_usage, SAVED_USAGE),
    "q04_quota_status": (quota_status, QUOTA_STATUS),
    "q05_quota_summary": (quota_summary, QUOTA_SUMMARY),
    "q06_run_totals": (run_totals, RUN_TOTALS),
    "q07_channel_options": (channel_options, CHANNEL_OPTIONS),
    "q08_fetch_costs": (fetch_costs, FETCH_COSTS),
}
