"""Work planning for all channels at once: what is new, gone, or due for a refresh.

A limit is per channel, as each channel has its own budget. `channel_id` narrows any plan to one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from snapstats.functions.numeric import flag
from snapstats.functions.text import fold_case
from snapstats.functions.timeutil import AsOf, days_before, hours_before, moment, moment_for, parse_timestamp
from snapstats.operators.keyed import top_per_key
from snapstats.operators.usage import channel_cost

# (max_age_days, refresh_hours); fixed values. The last tier has no upper age.
Tier = tuple["int | None", int]
COMMENT_TIERS: list[Tier] = [(2, 6), (7, 12), (30, 48), (None, 168)]
STATS_TIERS: list[Tier] = [(2, 0), (7, 6), (30, 12), (None, 24)]
COMMENT_HOURS_OTHERWISE = 168
STATS_HOURS_OTHERWISE = 24
# So many first characters of a sought name are compared before whole names are; few enough for a small list of them.
NEEDLE_START = 4


def _newest_first() -> list[Column]:
    return [F.desc_nulls_last("published_at"), F.asc("video_id")]


def _for_channel(df: DataFrame, channel_id) -> DataFrame:
    return df if channel_id is None else df.filter(F.col("channel_id") == channel_id)


def refresh_hours(published_at: Column, clock: Column, tiers: Sequence[Tier], otherwise: int) -> Column:
    """Hours between refreshes by age: the first tier whose age range holds the video.

    A missing date fits no tier and takes `otherwise`.
    """
    rule, younger = F, 0
    for max_age, hours in tiers:
        older_than = published_at < days_before(clock, younger)
        if max_age is None:
            rule = rule.when(older_than, hours)
        elif younger == 0:
            rule = rule.when(published_at >= days_before(clock, max_age), hours)
        else:
            rule = rule.when(older_than & (published_at >= days_before(clock, max_age)), hours)
        younger = max_age or 0
    return rule.otherwise(otherwise)


def _due(videos: DataFrame, last_fetch: str, clock: Column, limit: int | None) -> DataFrame:
    stale = F.col(last_fetch).isNull() | (F.col(last_fetch) < hours_before(clock, F.col("tier_refresh_hours")))
    due = videos.filter(stale)
    return due if limit is None else top_per_key(due, ["channel_id"], _newest_first(), limit, ["video_id"])


def videos_needing_comments(videos: DataFrame, summary: DataFrame, as_of: AsOf = None,
                            tiers: Sequence[Tier] = COMMENT_TIERS, limit: int | None = None,
                            min_new_comments: int = 0, channel_id=None) -> DataFrame:
    """Videos with more comments than are stored, not fetched within their tier's period.

    A video without a summary row has no known comments, so only summary rows with a surplus matter:
    they are filtered first and joined inner.
    """
    clock = moment_for(videos, "published_at", as_of)
    listed = F.coalesce("latest_youtube_comment_count", F.lit(0))
    stored = F.coalesce("stored_comment_count", F.lit(0))
    behind = (
        summary.filter((listed > stored) & (listed - stored >= min_new_comments))
        .select("video_id", listed.alias("listed_count"), stored.alias("stored_count"), "last_comment_fetch")
    )
    candidates = (
        _for_channel(videos, channel_id).select("video_id", "channel_id", "published_at")
        .join(behind, "video_id")
        .withColumn("tier_refresh_hours",
                    refresh_hours(F.col("published_at"), clock, tiers, COMMENT_HOURS_OTHERWISE))
    )
    return _due(candidates, "last_comment_fetch", moment_for(summary, "last_comment_fetch", as_of), limit).select(
        "video_id", "channel_id", "published_at", "listed_count", "stored_count", "tier_refresh_hours")


def videos_needing_stats(videos: DataFrame, summary: DataFrame, as_of: AsOf = None,
                         tiers: Sequence[Tier] = STATS_TIERS, limit: int | None = None,
                         channel_id=None) -> DataFrame:
    """Videos never measured, or not within their tier's period."""
    clock = moment_for(videos, "published_at", as_of)
    candidates = (
        _for_channel(videos, channel_id).select("video_id", "channel_id", "published_at")
        .join(summary.select("video_id", "last_stats_fetch"), "video_id", "left")
        .withColumn("tier_refresh_hours", refresh_hours(F.col("published_at"), clock, tiers, STATS_HOURS_OTHERWISE))
    )
    return _due(candidates, "last_stats_fetch", moment_for(summary, "last_stats_fetch", as_of), limit).select(
        "video_id", "channel_id", "published_at", "tier_refresh_hours")


def tier_breakdown(due: DataFrame) -> DataFrame:
    """Due videos per channel and tier, for either of the two plans above."""
    return due.groupBy("channel_id", "tier_refresh_hours").agg(F.count(F.lit(1)).alias("videos"))


def videos_without_transcripts(videos: DataFrame, transcripts: DataFrame, channel_id=None) -> DataFrame:
    return (
        _for_channel(videos, channel_id).select("video_id", "channel_id")
        .join(transcripts.select("video_id"), "video_id", "left_anti")
    )


def videos_needing_transcripts(videos: DataFrame, channels: DataFrame, transcripts: DataFrame,
                               limit: int | None = None, channel_id=None) -> DataFrame:
    """Videos without a transcript on known channels, newest first; `limit` is over the whole list."""
    todo = (
        _for_channel(videos, channel_id).select("video_id", "channel_id", "title", "published_at")
        .join(transcripts.select("video_id"), "video_id", "left_anti")
        .join(channels.select("channel_id", F.col("title").alias("channel")), "channel_id")
        .orderBy(*_newest_first())
    )
    return (todo if limit is None else todo.limit(limit)).select("video_id", "title", "channel")


def last_fetch_times(channels: DataFrame, fetch_log: DataFrame) -> DataFrame:
    """Latest completed run per channel and the kind of run that is next."""
    last = (
        fetch_log.filter(F.col("status") == "completed")
        .groupBy("channel_id").agg(F.max("completed_at").alias("last_fetch"))
    )
    return channels.select("channel_id").join(last, "channel_id", "left").withColumn(
        "fetch_type", F.when(F.col("last_fetch").isNull(), "backfill").otherwise("incremental"))


def latest_publish_dates(videos: DataFrame) -> DataFrame:
    return videos.groupBy("channel_id").agg(F.max("published_at").alias("latest_published_at"))


def stored_video_ids(videos: DataFrame, channel_id=None) -> DataFrame:
    return _for_channel(videos, channel_id).select("channel_id", "video_id")


def latest_comment_times(comments: DataFrame) -> DataFrame:
    return comments.groupBy("video_id").agg(F.max("published_at").alias("latest_comment_at"))


def channel_refresh_flags(channels: DataFrame, channel_stats: DataFrame, playlists: DataFrame | None = None,
                          as_of: AsOf = None, stats_hours: int = 6, playlist_hours: int = 24) -> DataFrame:
    """Which channels want new statistics and a new look at their playlists."""
    plan = channels.select("channel_id")
    sides = [(channel_stats, "fetched_at", "last_stats", "stats_due", stats_hours)]
    if playlists is not None:
        sides.append((playlists, "updated_at", "last_playlists", "playlists_due", playlist_hours))
    for table, at, last, due, hours in sides:
        newest = table.groupBy("channel_id").agg(F.max(at).alias(last))
        older = F.col(last) < hours_before(moment_for(table, at, as_of), hours)
        plan = plan.join(newest, "channel_id", "left").withColumn(due, F.col(last).isNull() | older)
    return plan


def discovery_needed(remote_counts: DataFrame, videos: DataFrame, backfill: bool = False) -> DataFrame:
    """Channels whose published count differs from the stored one (deleted videos do not count as stored)."""
    stored = (
        videos.filter(~F.col("privacy_status").eqNullSafe("deleted"))
        .groupBy("channel_id").agg(F.count(F.lit(1)).alias("stored_count"))
    )
    counts = (
        remote_counts.select("channel_id", F.col("video_count").alias("remote_count"))
        .join(stored, "channel_id", "left")
        .withColumn("stored_count", F.coalesce("stored_count", F.lit(0)))
    )
    unchanged = F.col("remote_count").eqNullSafe(F.col("stored_count")) & (F.col("stored_count") > 0)
    return counts.withColumn("needs_discovery", F.lit(backfill) | ~unchanged)


def new_video_ids(listing: DataFrame, videos: DataFrame) -> DataFrame:
    new = listing.select("channel_id", "video_id").join(videos.select("video_id"), "video_id", "left_anti")
    return new.select("channel_id", "video_id")


def complete_listings(listing: DataFrame, declared: DataFrame) -> DataFrame:
    """Channels (channel_id) whose listing brought as many different videos as it `declared` (channel_id, total)."""
    seen = listing.groupBy("channel_id").agg(F.count_distinct("video_id").alias("_seen"))
    return (declared.join(seen, "channel_id", "left").filter(F.coalesce("_seen", F.lit(0)) >= F.col("total")).select("channel_id"))


def vanished_video_ids(videos: DataFrame, listing: DataFrame, complete_channels: DataFrame) -> DataFrame:
    """Stored, not yet deleted videos that a complete listing of their channel no longer has.

    Channels whose listing was cut short are left alone: absence proves nothing there.
    """
    return (
        videos.filter(~F.col("privacy_status").eqNullSafe("deleted")).select("channel_id", "video_id")
        .join(complete_channels.select("channel_id"), "channel_id", "left_semi")
        .join(listing.select("video_id"), "video_id", "left_anti")
        .select("channel_id", "video_id")
    )


def before_first_known(listing: DataFrame, known: DataFrame, limit: int | None = None) -> DataFrame:
    """Each channel's listing up to, not including, the first stored video, then cut to `limit`.

    Listing order is `position` where the listing has one, else newest first. The stopping point is found
    by aggregation, so no channel's listing is walked in order; the cut comes first, as the result is a
    prefix either way and the join then meets at most `limit` rows of a channel.
    """
    if "position" in listing.columns:
        order, place, first = [F.asc("position")], F.col("position"), F.min
        before = F.col("_place") < F.col("_stop")
    else:
        order = [F.desc_nulls_last("published_at"), F.desc("video_id")]
        place, first = F.struct("published_at", "video_id"), F.max
        before = F.col("_place") > F.col("_stop")
    stop = (
        listing.join(known.select("video_id"), "video_id", "left_semi")
        .groupBy("channel_id").agg(first(place).alias("_stop"))
    )
    head = listing if limit is None else top_per_key(listing, ["channel_id"], order, limit, ["video_id"])
    return (
        head.withColumn("_place", place).join(stop, "channel_id", "left")
        .filter(F.col("_stop").isNull() | before)
        .select(*listing.columns)
    )


def first_listed(listing: DataFrame, limit: int, key: str = "channel_id") -> DataFrame:
    """The first `limit` entries of each listing by position."""
    return top_per_key(listing, [key], [F.asc("position"), F.asc("video_id")], limit, ["video_id"])


def recent_only(videos: DataFrame, days: int, as_of: AsOf = None, column: str = "published_at") -> DataFrame:
    """Drop videos older than `days`; those without a readable date stay."""
    is_text = videos.schema[column].dataType.typeName() == "string"
    published = parse_timestamp(F.col(column)) if is_text else F.col(column)
    clock = moment(as_of) if is_text else moment_for(videos, column, as_of)
    return videos.filter(published.isNull() | (published >= days_before(clock, days)))


def resolve_channels(identifiers: DataFrame, channels: DataFrame) -> DataFrame:
    """Channel id per identifier: the exact id, else the smallest id whose handle or title contains it.

    Containment is settled without comparing pairs: the parts of every text that are as long as some needle are
    joined with the needles and reduced to the smallest id before they meet an identifier, so the work is linear in the
    texts. The case of plain letters does not matter.
    """
    wanted = identifiers.select(F.col("identifier").cast("string").alias("identifier")).distinct()
    keyed = channels.select("channel_id", F.col("channel_id").cast("string").alias("identifier"))
    exact = wanted.join(keyed, "identifier")

    needles = (
        wanted.join(keyed, "identifier", "left_anti")
        .withColumn("needle", fold_case(F.ltrim("identifier", F.lit("@"))))
    )
    texts = channels.select("channel_id", F.explode(F.array("custom_url", "title")).alias("_text"))
    texts = texts.filter(F.col("_text").isNotNull()).withColumn("_text", fold_case(F.col("_text")))
    # Every text contains the empty needle.
    anything = needles.filter(F.col("needle") == "").select("identifier")
    needles = needles.filter(F.col("needle") != "")

    # Containing a needle is having a part of its length that equals it, so only parts of those lengths are looked at, at places
    # where some needle can begin. A text unfolds to many parts: the texts, often one small file, are dealt over all tasks first.
    sizes = needles.agg(F.coalesce(F.collect_set(F.length("needle")), F.array().cast("array<int>")).alias("all"),
                        F.least(F.min(F.length("needle")), F.lit(NEEDLE_START)).alias("start"))
    lengths, start = sizes.select("all").scalar(), F.coalesce(sizes.select("start").scalar(), F.lit(0))
    starts = needles.select(F.substring(F.col("needle"), F.lit(1), start).alias("_start")).distinct()
    spread = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = (
        texts.groupBy("_text").agg(F.min("channel_id").alias("channel_id")).repartition(spread)
        .select("channel_id", "_text", F.explode(F.sequence(F.lit(1), F.greatest(F.length("_text"), F.lit(1)))).alias("_at"))
        .select("channel_id", F.substring(F.col("_text"), F.col("_at"), F.array_max(lengths)).alias("_end"))
        .withColumn("_start", F.substring(F.col("_end"), F.lit(1), start)).join(starts, "_start", "left_semi")
    )
    contained = (
        ends.select("channel_id", "_end", F.explode(lengths).alias("_n")).filter(F.col("_n") <= F.length("_end"))
        .select("channel_id", F.substring(F.col("_end"), F.lit(1), F.col("_n")).alias("needle"))
        .join(needles.select("needle").distinct(), "needle", "left_semi")
        .groupBy("needle").agg(F.min("channel_id").alias("channel_id"))
        .join(needles, "needle").select("identifier", "channel_id")
    )
    smallest = texts.agg(F.min("channel_id").alias("channel_id")).scalar()
    found = (
        exact.unionByName(contained)
        .unionByName(anything.select("identifier", smallest.alias("channel_id")))
    )
    return wanted.join(found, "identifier", "left").select("identifier", "channel_id")



def dry_run(remote: DataFrame, videos: DataFrame, transcripts: DataFrame, summary: DataFrame,
            quota_remaining: int, as_of: AsOf = None, max_videos: int | None = None,
            fetch_comments: bool = True, max_comments_per_video: int = 100) -> DataFrame:
    """What a run would do per channel, and whether the remaining quota covers it.

    `remote` has channel_id, title and video_count as just read.
    """
    spoken = transcripts.select("video_id", F.lit(True).alias("_spoken"))
    stored = (
        videos.select("video_id", "channel_id").join(spoken, "video_id", "left")
        .groupBy("channel_id")
        .agg(F.count(F.lit(1)).alias("videos_stored"), F.count_if(~flag(F.col("_spoken"))).alias("transcripts_needed"))
    )
    plan = remote.select("channel_id", F.col("title").alias("channel_title"), F.col("video_count").alias("videos_listed"))
    plan = plan.join(stored, "channel_id", "left")
    if fetch_comments:
        due = videos_needing_comments(videos, summary, as_of).groupBy("channel_id").agg(
            F.count(F.lit(1)).alias("comments_needed"))
        plan = plan.join(due, "channel_id", "left")
    else:
        plan = plan.withColumn("comments_needed", F.lit(0).cast("bigint"))
    plan = plan.na.fill(0, ["videos_stored", "transcripts_needed", "comments_needed"])
    to_scan = F.lit(max_videos).cast("bigint") if max_videos else F.col("videos_listed")
    cost = channel_cost(to_scan, fetch_comments, max_comments_per_video)["total"]
    return (
        plan.withColumn("new_videos_estimate", F.greatest(F.lit(0), to_scan - F.col("videos_stored")))
        .withColumn("estimated_quota", cost)
        .withColumn("quota_remaining", F.lit(quota_remaining).cast("bigint"))
        .withColumn("can_complete", F.col("estimated_quota") <= F.col("quota_remaining"))
    )


def dry_run_totals(plan: DataFrame) -> DataFrame:
    return plan.agg(
        F.count(F.lit(1)).alias("channels"), F.sum("estimated_quota").alias("total_estimated_quota"),
        F.sum("new_videos_estimate").alias("new_videos_estimate"), F.sum("comments_needed").alias("comments_needed"),
        F.sum("transcripts_needed").alias("transcripts_needed"), F.count_if("can_complete").alias("can_complete"),
    )
