"""Keyed upkeep of the tables: (current rows, incoming rows) to the next rows.

Rows to append are returned apart from whole tables wherever the sink can append; `as_of` stands for
"now" and is written to the columns that record it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from snapstats.functions.numeric import flag
from snapstats.functions.timeutil import AsOf, days_before, moment, moment_for
from snapstats.operators.keyed import (
    first_per_key, insert_ignore, latest_per_key, merge_by_key, replace_by_parent, rows_missing, top_per_key,
)
from snapstats.schemas import PRIMARY_KEYS, UPDATE_COLUMNS

STAT_COUNTS = ["subscriber_count", "view_count", "like_count", "comment_count", "video_count"]
VIDEO_FLAGS = ["caption_available", "embeddable", "made_for_kids", "has_chapters"]
# Tables that hold rows of a video and lose them when it is purged.
VIDEO_TABLES = ["video_stats", "chapters", "transcripts", "comments", "video_comment_summary", "videos"]
MAX_LOGGED_ERRORS = 10
# Statuses of a run that ended before its time (fixed values).
ENDINGS = ("quota_exhausted", "timeout", "failed")


# --- metadata -------------------------------------------------------------------------------------

def upsert(table: str, current: DataFrame, incoming: DataFrame, order: Column | str | None = None,
           as_of: AsOf = None, whole_table: bool = False) -> DataFrame:
    """Merge channels, videos or playlists by their key and update list.

    With `as_of`, incoming rows are stamped: `updated_at` always, `first_seen_at` for new videos.
    """
    if as_of is not None:
        for stamp in ("updated_at", "first_seen_at"):
            if stamp in current.columns:
                incoming = incoming.withColumn(stamp, moment_for(current, stamp, as_of))
    if table == "videos":
        for name in (c for c in VIDEO_FLAGS if c in incoming.columns):
            incoming = incoming.withColumn(name, flag(F.col(name)))
    return merge_by_key(current, incoming, PRIMARY_KEYS[table], UPDATE_COLUMNS[table], order, whole_table)


def upsert_channels(current: DataFrame, incoming: DataFrame, **how) -> DataFrame:
    """Country, publish date and uploads list keep their first value."""
    return upsert("channels", current, incoming, **how)


def upsert_videos(current: DataFrame, incoming: DataFrame, **how) -> DataFrame:
    """Channel, dates, duration and format keep their first value."""
    return upsert("videos", current, incoming, **how)


def upsert_playlists(current: DataFrame, incoming: DataFrame, **how) -> DataFrame:
    """Channel and publish date keep their first value."""
    return upsert("playlists", current, incoming, **how)


# --- snapshots ------------------------------------------------------------------------------------

def _counts_filled(stats: DataFrame) -> DataFrame:
    return stats.na.fill(0, [c for c in STAT_COUNTS if c in stats.columns])


def new_stats(table: str, current: DataFrame, batch: DataFrame, order: Column | str | None = None, unique: bool = False) -> DataFrame:
    """Snapshot rows to append: missing counts are 0, known (key, time) pairs are left out. `unique` promises that no two rows
    of the batch share a key, as in one folded and stored before; then it is not folded again (so in the next three too)."""
    keys, filled = PRIMARY_KEYS[table], _counts_filled(batch)
    return rows_missing(filled if unique else first_per_key(filled, keys, order), current, keys)


def insert_stats(table: str, current: DataFrame, batch: DataFrame, order: Column | str | None = None) -> DataFrame:
    return insert_ignore(current, _counts_filled(batch), PRIMARY_KEYS[table], order)


def summary_after_stats(summary: DataFrame, batch: DataFrame, whole_table: bool = False) -> DataFrame:
    """Comment summary with the listed count and time of each video's latest row in the batch.

    A batch that arrives late does not move a video back: the newer of summary and batch stays. Of rows of one video and time the
    largest count holds.
    """
    counted = _counts_filled(batch).groupBy("video_id", "fetched_at").agg(F.max("comment_count").alias("comment_count"))
    latest = latest_per_key(counted, ["video_id"], "fetched_at", ["comment_count"], unique=True).select(
        "video_id", F.lit(0).cast("bigint").alias("stored_comment_count"),
        F.col("comment_count").alias("latest_youtube_comment_count"), F.col("fetched_at").alias("last_stats_fetch"))
    return merge_by_key(summary, latest, ["video_id"], ["latest_youtube_comment_count", "last_stats_fetch"],
                        whole_table=whole_table, not_older="last_stats_fetch")


# --- comments and transcripts ---------------------------------------------------------------------

def new_comments(current: DataFrame, batch: DataFrame, order: Column | str | None = None, unique: bool = False) -> DataFrame:
    """Comments to append; the first text and like count seen of a comment stay."""
    filled = batch.na.fill(0, ["like_count"]) if "like_count" in batch.columns else batch
    return rows_missing(filled if unique else first_per_key(filled, ["comment_id"], order), current, ["comment_id"])


def insert_comments(current: DataFrame, batch: DataFrame, order: Column | str | None = None) -> DataFrame:
    return current.unionByName(new_comments(current, batch, order), allowMissingColumns=True)


def summary_after_comments(summary: DataFrame, inserted: DataFrame, batch: DataFrame,
                           as_of: AsOf = None) -> DataFrame:
    """Comment summary raised by the rows really inserted, for every video of the batch.

    A video whose comments were all known is marked as visited; one without comments is not in the
    batch and stays due.
    """
    added = inserted.groupBy("video_id").agg(F.count(F.lit(1)).alias("_added"))
    visits = batch.select("video_id").distinct().join(added, "video_id", "left").select(
        "video_id", F.coalesce("_added", F.lit(0)).alias("_added"))
    clock = moment_for(summary, "last_comment_fetch", as_of)
    raised = (
        summary.join(visits, "video_id", "left")
        .withColumn("stored_comment_count",
                    F.when(F.col("_added").isNull(), F.col("stored_comment_count"))
                    .otherwise(F.coalesce("stored_comment_count", F.lit(0)) + F.col("_added")))
        .withColumn("last_comment_fetch", F.when(F.col("_added").isNotNull(), clock).otherwise(F.col("last_comment_fetch")))
        .select(*summary.columns)
    )
    fresh = rows_missing(visits, summary, ["video_id"]).select(
        "video_id", F.col("_added").alias("stored_comment_count"), clock.alias("last_comment_fetch"))
    return raised.unionByName(fresh, allowMissingColumns=True)


def new_transcripts(current: DataFrame, batch: DataFrame, order: Column | str | None = None, unique: bool = False) -> DataFrame:
    """Transcripts to append: a stored transcript is never replaced."""
    return rows_missing(batch if unique else first_per_key(batch, ["video_id"], order), current, ["video_id"])


def insert_transcripts(current: DataFrame, batch: DataFrame, order: Column | str | None = None) -> DataFrame:
    return insert_ignore(current, batch, ["video_id"], order)


def summary_backfill(videos: DataFrame, comments: DataFrame, video_stats: DataFrame, summary: DataFrame) -> DataFrame:
    """Summary rows for videos that have comments or a listed count but no summary yet."""
    todo = videos.select("video_id").join(summary.select("video_id"), "video_id", "left_anti")
    counted = comments.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("_stored"), F.max("fetched_at").alias("last_comment_fetch"))
    listed = latest_per_key(video_stats, ["video_id"], "fetched_at", ["comment_count"], unique=True).select(
        "video_id", F.col("comment_count").alias("latest_youtube_comment_count"),
        F.col("fetched_at").alias("last_stats_fetch"))
    return (
        todo.join(counted, "video_id", "left").join(listed, "video_id", "left")
        .filter((F.col("_stored") > 0) | F.col("latest_youtube_comment_count").isNotNull())
        .select("video_id", F.coalesce("_stored", F.lit(0)).alias("stored_comment_count"), "last_comment_fetch",
                "latest_youtube_comment_count", "last_stats_fetch")
    )


# --- chapters -------------------------------------------------------------------------------------

def replace_chapters(current: DataFrame, incoming: DataFrame, processed: DataFrame) -> DataFrame:
    """Chapters of every processed video are those of the batch, also when it has none left."""
    return replace_by_parent(current, incoming, "video_id", processed)


# --- deletion -------------------------------------------------------------------------------------

def mark_deleted(videos: DataFrame, ids: DataFrame, as_of: AsOf = None) -> DataFrame:
    gone = ids.select("video_id").distinct().withColumn("_gone", F.lit(True))
    hit = F.col("_gone").isNotNull()
    return (
        videos.join(gone, "video_id", "left")
        .withColumn("privacy_status", F.when(hit, "deleted").otherwise(F.col("privacy_status")))
        .withColumn("updated_at", F.when(hit, moment_for(videos, "updated_at", as_of)).otherwise(F.col("updated_at")))
        .select(*videos.columns)
    )


def deleted_videos(videos: DataFrame, channel_id=None) -> DataFrame:
    gone = videos.filter(F.col("privacy_status") == "deleted")
    if channel_id is not None:
        gone = gone.filter(F.col("channel_id") == channel_id)
    return gone.select("video_id", "title", "channel_id", "updated_at")


def purge_victims(videos: DataFrame, as_of: AsOf = None, older_than_days: int = 30, channel_id=None) -> DataFrame:
    """Videos deleted longer ago than the grace period."""
    cutoff = days_before(moment_for(videos, "updated_at", as_of), older_than_days)
    return deleted_videos(videos, channel_id).filter(F.col("updated_at") < cutoff).select("video_id")


def purge_deleted(tables: Mapping[str, DataFrame], as_of: AsOf = None, older_than_days: int = 30,
                  channel_id=None) -> dict[str, DataFrame]:
    """What is left of every table that holds rows of a purged video (the summary included)."""
    victims = purge_victims(tables["videos"], as_of, older_than_days, channel_id)
    return {
        name: tables[name].join(victims, "video_id", "left_anti").select(*tables[name].columns)
        for name in VIDEO_TABLES if name in tables
    }


def purge_counts(tables: Mapping[str, DataFrame], as_of: AsOf = None, older_than_days: int = 30,
                 channel_id=None) -> DataFrame:
    """Rows a purge removes, per table."""
    victims = purge_victims(tables["videos"], as_of, older_than_days, channel_id)
    counts = None
    for name in (n for n in VIDEO_TABLES if n in tables):
        part = tables[name].select("video_id").join(victims, "video_id", "left_semi").agg(
            F.lit(name).alias("table"), F.count(F.lit(1)).alias("purged"))
        counts = part if counts is None else counts.unionByName(part)
    return counts


# --- run log and progress -------------------------------------------------------------------------

def error_text(errors: Column) -> Column:
    """The first errors of a run on one line; NULL when there were none."""
    line = F.array_join(F.slice(errors, 1, MAX_LOGGED_ERRORS), "; ")
    return F.when(F.size(F.coalesce(errors, F.array().cast("array<string>"))) > 0, line)


def run_outcomes(events: DataFrame, order: str) -> DataFrame:
    """How the run of each channel ended: (channel_id, status, errors), from its events (channel_id, kind, reason) in `order`.

    The first event of a kind in ENDINGS ended the run and gives the status; without one it was completed, whatever else went
    wrong. The first reasons are kept, of all kinds.
    """
    ended = F.col("kind").isin(*ENDINGS)
    status = events.groupBy("channel_id").agg(F.min_by(F.when(ended, F.col("kind")), F.when(ended, F.col(order))).alias("status"))
    shown = top_per_key(events.select("channel_id", order, "reason"), ["channel_id"], [F.asc(order)], MAX_LOGGED_ERRORS, [order])
    reasons = shown.groupBy("channel_id").agg(F.sort_array(F.collect_list(F.struct(order, "reason"))).alias("_all"))
    return status.join(reasons, "channel_id").select(
        "channel_id", F.coalesce("status", F.lit("completed")).alias("status"), F.col("_all.reason").alias("errors"))


def open_runs(runs: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Log events for runs that start: fetch_id, channel_id and fetch_type given, state 'running'."""
    return runs.select("fetch_id", "channel_id", "fetch_type").withColumns(
        {"at": moment(as_of), "status": F.lit("running")})


def close_runs(results: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Log events for runs that end: counts, a list of errors and a status given."""
    counts = ["videos_fetched", "comments_fetched", "transcripts_fetched"]
    return results.select("fetch_id", *counts, error_text(F.col("errors")).alias("errors"), "status").withColumn(
        "at", moment(as_of))


def fetch_log_from_events(opened: DataFrame, closed: DataFrame) -> DataFrame:
    """One log row per run out of its two events; a run without a closing event is still running."""
    start = F.col("_opened").isNotNull()
    events = opened.withColumn("_opened", F.lit(True)).unionByName(closed, allowMissingColumns=True)
    return events.groupBy("fetch_id").agg(
        F.max(F.when(start, F.col("channel_id"))).alias("channel_id"),
        F.max(F.when(start, F.col("fetch_type"))).alias("fetch_type"),
        F.max(F.when(start, F.col("at"))).alias("started_at"),
        F.max(F.when(~start, F.col("at"))).alias("completed_at"),
        F.max("videos_fetched").alias("videos_fetched"), F.max("comments_fetched").alias("comments_fetched"),
        F.max("transcripts_fetched").alias("transcripts_fetched"), F.max("errors").alias("errors"),
        F.coalesce(F.max(F.when(~start, F.col("status"))), F.lit("running")).alias("status"),
    )


def processed_ids(progress: DataFrame) -> DataFrame:
    """Id lists of finished work, as a crawl reports them, as rows of (channel_id, operation, video_id)."""
    return progress.select("channel_id", "operation", F.explode("processed_ids").alias("video_id"))


def progress_totals(processed: DataFrame, todo: DataFrame) -> DataFrame:
    """Per channel and operation: all there is to do, what is done of it and what is left.

    `todo` has (channel_id, operation, video_id). Finished work that is no longer wanted counts nowhere.
    """
    keys = ["channel_id", "operation", "video_id"]
    done = processed.select(*keys).distinct().withColumn("_done", F.lit(True))
    return (todo.select(*keys).distinct().join(done, keys, "left").groupBy("channel_id", "operation")
            .agg(F.count(F.lit(1)).alias("total_count"), F.count("_done").alias("processed_count"))
            .withColumn("remaining_count", F.col("total_count") - F.col("processed_count")))


def remaining_ids(todo: DataFrame, processed: DataFrame, operation: str) -> DataFrame:
    """Work left to do: `todo` (channel_id, video_id) without what any earlier run has done."""
    done = processed.filter(F.col("operation") == operation).select("channel_id", "video_id")
    return todo.join(done, ["channel_id", "video_id"], "left_anti")


def save_progress(processed: DataFrame, done: DataFrame, operation: str, unique: bool = False) -> DataFrame:
    """Progress rows to append: ids done and not yet recorded. Columns of `done` beside the ids (run, time) are kept."""
    keys = ["channel_id", "operation", "video_id"]
    rows = done.withColumn("operation", F.lit(operation))
    rest = [c for c in rows.columns if c not in keys]
    rows = rows.select(*keys, *rest)
    rows = rows if unique else first_per_key(rows, keys, None)
    return rows_missing(rows, processed, keys)


def clear_progress(processed: DataFrame, channels: DataFrame, operation: str | None = None) -> DataFrame:
    """Progress without the finished channels, for one operation or all."""
    finished = channels.select("channel_id").distinct()
    if operation is None:
        return processed.join(finished, "channel_id", "left_anti").select(*processed.columns)
    finished = finished.withColumn("operation", F.lit(operation))
    return processed.join(finished, ["channel_id", "operation"], "left_anti").select(*processed.columns)
