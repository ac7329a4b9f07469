"""API quota and run totals, as aggregations over a log of operations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from snapstats.functions.numeric import whole_div
from snapstats.functions.timeutil import AsOf, moment
from snapstats.operators.keyed import merge_by_key
from snapstats.schemas import PRIMARY_KEYS, UPDATE_COLUMNS

# Units per call of each operation; fixed values. Anything else costs one unit.
OPERATION_COSTS = {
    "channels.list": 1,
    "playlists.list": 1,
    "playlistItems.list": 1,
    "videos.list": 1,
    "commentThreads.list": 1,
    "comments.list": 1,
    "search.list": 100,
    "captions.list": 50,
}
DAILY_LIMIT = 10_000
WARN_SHARE = 0.8
ABORT_SHARE = 0.95
IDS_PER_CALL = 50
COMMENTS_PER_CALL = 100

# Options a channel entry may set, with the value used when nothing else does.
CHANNEL_OPTIONS = {
    "fetch_comments": True,
    "max_videos": None,
    "max_video_age_days": None,
    "max_comments_per_video": 100,
    "max_replies_per_comment": 10,
    "max_comment_videos": 200,
    "min_new_comments": 10,
    "stats_update_hours": 6,
    "video_discovery_mode": "auto",
    "comment_workers": 5,
}
# Not taken from the general settings: only the run or the channel itself sets them.
CHANNEL_ONLY_OPTIONS = ["fetch_comments", "max_videos", "max_video_age_days"]


def channel_cost(videos: Column, fetch_comments: bool = True, max_comments_per_video: int = 100) -> dict[str, Column]:
    """Estimated units to fetch a channel of `videos` videos, by operation and in total."""
    pages = whole_div(videos, IDS_PER_CALL) + 1
    cost = {
        "channels.list": F.lit(1).cast("bigint"),
        "playlists.list": F.lit(2).cast("bigint"),
        "playlistItems.list": pages,
        "videos.list": pages,
    }
    if fetch_comments:
        cost["commentThreads.list"] = videos * max(1, max_comments_per_video // COMMENTS_PER_CALL)
    total = None
    for part in cost.values():
        total = part if total is None else total + part
    return {**cost, "total": total}


def estimate_channel_costs(channels: DataFrame, max_videos: int | None = None, fetch_comments: bool = True,
                           max_comments_per_video: int = 100) -> DataFrame:
    """Cost estimate per channel from its video count, held to `max_videos` if that is given."""
    videos = F.least(F.col("video_count"), F.lit(max_videos).cast("bigint")) if max_videos else F.col("video_count")
    cost = channel_cost(videos, fetch_comments, max_comments_per_video)
    return channels.select("channel_id", *[value.alias(name.replace(".", "_")) for name, value in cost.items()])


def _unit_cost(operation: Column, costs: Mapping[str, int]) -> Column:
    if not costs:
        return F.lit(1).cast("bigint")
    table = F.create_map(*[F.lit(x) for pair in costs.items() for x in pair])
    return F.coalesce(F.element_at(table, operation), F.lit(1)).cast("bigint")


def operation_usage(op_log: DataFrame, costs: Mapping[str, int] = OPERATION_COSTS) -> DataFrame:
    """Units per day and operation. The cost table is a constant of the expression, not a join."""
    return op_log.groupBy("date", "operation").agg(
        F.sum(_unit_cost(F.col("operation"), costs) * F.col("calls")).alias("units"))


def daily_usage(op_log: DataFrame, costs: Mapping[str, int] = OPERATION_COSTS, as_of: AsOf = None) -> DataFrame:
    """One row per day: units used and the map from operation to units (as long as the operations are many)."""
    return (
        operation_usage(op_log, costs).groupBy("date")
        .agg(F.sum("units").alias("used"),
             F.map_from_entries(F.sort_array(F.collect_list(F.struct("operation", "units")))).alias("operations"))
        .withColumn("last_updated", moment(as_of))
    )


def save_usage(current: DataFrame, days: DataFrame) -> DataFrame:
    """Quota table with the given days replaced or added."""
    return merge_by_key(current, days, PRIMARY_KEYS["quota_usage"], UPDATE_COLUMNS["quota_usage"])


def usage_by_operation(quota_usage: DataFrame) -> DataFrame:
    """The stored maps read back as rows."""
    return quota_usage.select("date", F.explode("operations").alias("operation", "units"))


def quota_status(days: DataFrame, limit: int = DAILY_LIMIT, warn: float = WARN_SHARE, abort: float = ABORT_SHARE,
                 planned_cost: int = 0) -> DataFrame:
    """State of each day's quota, and whether `planned_cost` more units stay under the abort line.

    `would_abort` is the stricter check before a large operation: enough units left, and still under the line.
    """
    share = F.col("used") / F.lit(float(limit))
    remaining = F.greatest(F.lit(0).cast("bigint"), F.lit(limit).cast("bigint") - F.col("used"))
    projected = F.col("used") + F.lit(planned_cost).cast("bigint")
    return days.select(
        "date", "used", remaining.alias("remaining"), share.alias("used_fraction"),
        F.when(share >= abort, "critical").when(share >= warn, "warning").otherwise("ok").alias("state"),
        (projected <= F.lit(limit * abort)).alias("can_afford"),
        ((remaining < planned_cost) | (projected / F.lit(float(limit)) > abort)).alias("would_abort"),
    )


def quota_summary(op_log: DataFrame, costs: Mapping[str, int] = OPERATION_COSTS, limit: int = DAILY_LIMIT) -> DataFrame:
    """Per day the totals, and its operations from the dearest down as one array."""
    by_operation = F.sort_array(
        F.collect_list(F.struct(F.col("units"), F.col("operation"))), asc=False)
    days = operation_usage(op_log, costs).groupBy("date").agg(
        F.sum("units").alias("used"), by_operation.alias("_ops"))
    return days.select(
        "date", "used",
        F.greatest(F.lit(0).cast("bigint"), F.lit(limit).cast("bigint") - F.col("used")).alias("remaining"),
        F.lit(limit).cast("bigint").alias("limit"),
        (F.col("used") / F.lit(float(limit))).alias("used_fraction"),
        F.transform("_ops", lambda o: F.struct(o["operation"].alias("operation"), o["units"].alias("units"))
                    ).alias("by_operation"),
    ).orderBy("date")


def run_totals(results: DataFrame) -> DataFrame:
    """Totals over the per-channel results of a run; `errors` is a list per channel."""
    return results.agg(
        F.count_if(~F.col("skipped")).alias("channels"), F.count_if("skipped").alias("channels_skipped"),
        *[F.sum(source).alias(name) for name, source in (
            ("videos", "videos_fetched"), ("videos_new", "videos_new"),
            ("videos_stats_updated", "videos_stats_updated"), ("comments", "comments_fetched"),
            ("transcripts", "transcripts_fetched"))],
        F.sum(F.size("errors").cast("bigint")).alias("errors"),
    )


def resolve_options(channels: DataFrame, channel_options: DataFrame, settings: Mapping[str, object],
                    run_options: Mapping[str, object] | None = None) -> DataFrame:
    """Options per channel: those of this run, else the channel's own, else the setting, else the default."""
    run_options = run_options or {}
    joined = channels.select("identifier").join(channel_options, "identifier", "left")
    resolved = []
    for name, default in CHANNEL_OPTIONS.items():
        if name not in CHANNEL_ONLY_OPTIONS:
            default = settings.get(name, default)
        value = F.lit(None).cast("bigint") if default is None else F.lit(default)
        if run_options.get(name) is not None:
            value = F.lit(run_options[name])
        elif name in channel_options.columns:
            value = F.coalesce(F.col(name), value)
        resolved.append(value.alias(name))
    return joined.select("identifier", *resolved)


def comment_fetch_cost(comments: Column) -> Column:
    """Units spent on fetching so many comments of a video."""
    return F.when(comments > 0, whole_div(comments, COMMENTS_PER_CALL) + 1).otherwise(F.lit(1).cast("bigint"))


def call_batches(ids: Column) -> Column:
    """Calls needed for so many ids."""
    return whole_div(ids + (IDS_PER_CALL - 1), IDS_PER_CALL)


def fetch_costs(counts: DataFrame) -> DataFrame:
    """Comment cost and id batches per row of (key columns, comments, videos)."""
    return counts.withColumns({
        "comment_units": comment_fetch_cost(F.col("comments")), "video_calls": call_batches(F.col("videos"))})
