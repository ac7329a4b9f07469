"""The tracker's tables as views over the test tables. The text is valid in Spark SQL and in the check tool."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from snapstats.session import configure

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Clocks of the test data: the last day of the snapshots, of the events, and one inside the publish dates.
STATS_AS_OF = "2001-11-04 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"
PLAN_AS_OF = "2001-08-01 00:00:00"

VIEWS = {
    "channels": """
        select c_custkey as channel_id, c_name as title,
               concat('@', lower(c_mktsegment), '_', cast(c_custkey as string)) as custom_url,
               c_mktsegment as country
        from customer""",
    "channel_stats": """
        select user_id as channel_id, ts as fetched_at, cast(floor(value*100) as bigint) as subscriber_count,
               cast(floor(value*1000) as bigint) as view_count, event_id % 500 as video_count
        from events""",
    "videos": """
        select o_orderkey as video_id, o_custkey as channel_id,
               concat('Order ', cast(o_orderkey as string)) as title, o_orderdate as published_at,
               cast(floor(o_totalprice) as bigint) % 7200 as duration_seconds,
               concat('PT', cast(cast(floor(o_totalprice) as bigint) % 3 as string), 'H',
                      cast(cast(floor(o_totalprice) as bigint) % 60 as string), 'M') as duration_iso,
               concat('0:00 Intro', chr(10), cast(1 + o_orderkey % 9 as string), ':30 - Middle', chr(10),
                      'see links below', chr(10), '1:02:03 End') as description,
               case o_orderstatus when 'P' then 'deleted' else 'public' end as privacy_status,
               o_orderdate as updated_at
        from orders""",
    "video_stats": """
        select l_orderkey as video_id, l_shipdate as fetched_at,
               max(cast(floor(l_extendedprice) as bigint)) as view_count,
               max(cast(l_quantity as bigint)) as like_count, max(cast(l_linenumber as bigint)) as comment_count
        from lineitem group by l_orderkey, l_shipdate""",
    "comments": """
        select event_id as comment_id, event_id % 100 as video_id,
               case when event_id % 4 = 0 then event_id - 4 end as parent_comment_id,
               user_id as author_channel_id, concat('user', cast(user_id as string)) as author_display_name,
               props as text, cast(floor(value) as bigint) as like_count, ts as published_at, ts as fetched_at
        from events""",
    "transcripts": """
        select doc_id as video_id, lang as language_code, source as language, text as full_text from documents""",
    "playlists": """
        select p_partkey as playlist_id, p_partkey % 100 as channel_id, p_name as title,
               cast(p_size as bigint) as item_count
        from part""",
    "fetch_log": """
        select event_id as fetch_id, user_id as channel_id, event_type as fetch_type, ts as started_at,
               ts as completed_at, case when event_type = 'error' then 'failed' else 'completed' end as status
        from events""",
    "chapters": """
        select l_orderkey as video_id, l_linenumber as chapter_index, max(concat('Part ', l_returnflag)) as title,
               min(l_partkey) as start_seconds, max(l_suppkey) as end_seconds
        from lineitem group by l_orderkey, l_linenumber""",
    "fetch_progress": """
        select user_id as channel_id, event_type as operation, event_id % 100 as video_id, max(event_id) as fetch_id,
               max(ts) as last_updated
        from events group by user_id, event_type, event_id % 100""",
    "quota_usage": """
        select cast(ts as date) as date, count(*) as used, max(ts) as last_updated from events group by cast(ts as date)""",
    "op_log": """
        select cast(ts as date) as date, event_type as operation, 1 as calls from events""",
    # State of the comment summary at PLAN_AS_OF, and the videos published by then.
    "plan_videos": """
        select video_id, channel_id, title, published_at from videos where published_at <= date '2001-08-01'""",
    "plan_summary": """
        select video_id, min(comment_count) as stored_comment_count,
               case when max(like_count) < 40 then max(fetched_at) end as last_comment_fetch,
               max(comment_count) as latest_youtube_comment_count, max(fetched_at) as last_stats_fetch
        from video_stats where fetched_at <= date '2001-08-01' group by video_id""",
    # Two sides of the planning and sync operators: what a listing shows, what is stored.
    "listing": """
        select o_custkey as channel_id, o_orderkey as video_id, o_orderdate as published_at, o_orderkey as position
        from orders where o_orderpriority <> '5-LOW'""",
    "stored_videos": """
        select o_orderkey as video_id, o_custkey as channel_id, concat('Stored ', cast(o_orderkey as string)) as title,
               o_orderdate as published_at, case o_orderstatus when 'P' then 'deleted' else 'public' end as privacy_status,
               o_orderdate as updated_at
        from orders where o_orderpriority <> '1-URGENT'""",
}


class DriverTables(Mapping):
    """Base tables and views by name, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.folder = sf_dir.rstrip("/")
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in BASE_TABLES:
                self._built[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            elif name in VIEWS:
                self._built[name] = self.sql(VIEWS[name])
            else:
                raise KeyError(name)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter([*BASE_TABLES, *VIEWS])

    def __len__(self) -> int:
        return len(BASE_TABLES) + len(VIEWS)

    def sql(self, text: str) -> DataFrame:
        """SQL over the tables it names."""
        for name in _named(text):
            self[name].createOrReplaceTempView(name)
        return self.spark.sql(text)


def _named(text: str) -> list[str]:
    words = set(re.findall(r"(?:from|join)\s+([a-z_]+)", text.lower()))
    return [n for n in [*BASE_TABLES, *VIEWS] if n in words]


def with_views(query: str) -> str:
    """The query preceded by the views it needs, for an engine that only has the base tables."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _named(text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(query)
    if not needed:
        return query.strip()
    ctes = [f"{n} as ({VIEWS[n].strip()})" for n in needed]
    body = query.strip()
    if body.lower().startswith("with "):
        return "with " + ",\n".join(ctes) + ",\n" + body[5:]
    return "with " + ",\n".join(ctes) + "\n" + body
