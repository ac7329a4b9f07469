"""One run over everything a crawl has landed: shape, merge, log.

Each shaped batch is written to the run's folder before any table changes, so it is computed once and
survives lost executors. A run repeated under the same id takes up those files, puts the same rows in
place and appends nothing twice. Merges read and rewrite only the buckets that hold keys of the batch.

A landing may hold several crawls of one key. Their order is the time an item was fetched (its own `fetched_at`, else the
run's time), then file and line: metadata folds by it, and every (key, fetched_at) is a snapshot.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapstats.functions.timeutil import AsOf, moment
from snapstats.operators import maintenance, planning, shaping
from snapstats.operators.keyed import first_per_key, latest_per_key
from snapstats.sources.landing import CORRUPT, PLACE, corrupt, read_landing, readable
from snapstats.sources.tables import (
    all_parts, append, conform, in_parts, layout_columns, load_catalog, part_for, parts_of, property_of, qualified, replace_parts, rows_in,
)


RUN_PROPERTY = "snapstats.run"
# More ids than this are hashed where their rows are, not broadcast (a broadcast lies in the driver too) nor sorted.
HASHED_IDS = 1_000_000
# A stored batch of more rows is shuffled and sorted for its joins, never broadcast. Spark guesses a broadcast from the bytes of the files
# and the widths of the columns: ids that compress well, beside many columns, take a hundred times that in the driver.
SORTED_ROWS = 100_000


@dataclass(frozen=True)
class Run:
    """Where a run reads, writes and what it calls now. `folder` must be shared by all executors."""
    spark: SparkSession
    run_id: str
    folder: str
    database: str | None = None
    as_of: AsOf = None

    def table(self, name: str) -> DataFrame:
        return load_catalog(self.spark, self.database, [name])[name]

    def part(self, name: str, batch: DataFrame, by: list[str] | None = None) -> DataFrame:
        """What a table holds where the keys of a stored batch belong."""
        return part_for(self.spark, name, batch, self.database, by)

    def staged(self, name: str, rows: DataFrame | Callable[[], DataFrame]) -> DataFrame:
        """A stored batch, for joins with it as well: one of many rows is not broadcast, whatever its files weigh."""
        batch = self._stored(name, rows)
        return batch.hint("merge") if batch.count() > SORTED_ROWS else batch

    def _stored(self, name: str, rows: DataFrame | Callable[[], DataFrame]) -> DataFrame:
        return self._kept(f"{self.folder}/{self.run_id}/staged/{name}", rows)

    def merge(self, name: str, batch: DataFrame, change: Callable[[DataFrame], DataFrame], step: str = "merged") -> None:
        """Replace the parts of a table that hold keys of a stored batch by what `change` makes of them.

        The new rows are stored before the table changes. A repeated run puts the same rows in place again, unless a later
        run has moved the table on: the run that changes a table signs it, and the signature a run found is noted first.
        A run that changes a table twice gives each change a `step`.
        """
        if self._claims(name):
            parts = all_parts(parts_of(self.spark, name, batch, self.database))
            rows = self._stored(f"{step}/{name}", lambda: conform(name, change(rows_in(self.spark, name, parts, self.database))))
            if parts:
                replace_parts(name, rows, parts, self.database)

    def drop(self, name: str, batch: DataFrame, keep: Callable[[DataFrame], DataFrame], step: str = "dropped") -> DataFrame:
        """Leave out of a table the rows that `keep` leaves out, all of which have keys of a stored batch; returns how many, by part.

        The table is joined once: counts before and after tell the parts that lost rows, and only those are replaced. What is left is
        stored before the table changes, and a repeated run does what it does in `merge`.
        """
        columns, claimed = layout_columns(name), self._claims(name)

        def stored() -> DataFrame:
            return part_for(self.spark, name, batch, self.database, layout=True)

        def counts(rows: DataFrame) -> DataFrame:
            return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
        held = self._stored(f"{step}/held/{name}", lambda: counts(stored()))
        rest = self._stored(f"{step}/{name}", lambda: keep(stored()))
        change = held.unionByName(counts(rest).withColumn("n", -F.col("n")))
        lost = self._stored(f"{step}/lost/{name}", lambda: change.groupBy(*columns).agg(F.sum("n").alias("n")).where("n > 0"))
        parts = all_parts([tuple(r) for r in lost.select(*columns).collect()])
        if claimed and parts:
            replace_parts(name, in_parts(name, rest, parts), parts, self.database)
        return lost

    def _claims(self, name: str) -> bool:
        table = qualified(name, self.database)
        stands = property_of(self.spark, table, RUN_PROPERTY) or ""
        note = self.spark.range(1, numPartitions=1).select(F.lit(stands).alias("run"))
        base = self._kept(f"{self.folder}/{self.run_id}/base/{name}", note).first()["run"]
        if stands not in (base, self.run_id):
            return False
        self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{RUN_PROPERTY}' = '{self.run_id}')")
        return True

    def _kept(self, path: str, rows: DataFrame | Callable[[], DataFrame]) -> DataFrame:
        """What an earlier attempt finished writing (it left its completion mark), else written now."""
        if not finished(self.spark, path):
            (rows() if callable(rows) else rows).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def forget(self, keep: int) -> list[str]:
        """Remove the stored rows of all but the last `keep` runs in the folder; what they found (`base`) stays, so that none of
        them can bring its rows back. Returns the runs that were cleared."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        runs = sorted(files.listStatus(root), key=lambda f: (f.getModificationTime(), f.getPath().getName()))
        done = []
        for run in runs[:max(0, len(runs) - keep)]:
            staged = self.spark._jvm.org.apache.hadoop.fs.Path(run.getPath(), "staged")
            if run.getPath().getName() != self.run_id and files.exists(staged):
                files.delete(staged, True)
                done.append(run.getPath().getName())
        return done


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to `path` ended: the committer's mark is its last file."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


# Place of a row among the crawls of a landing.
ORDER = "_order"


def _shaped(run: Run, landing: Mapping[str, str], kind: str, key: str, shape: Callable[[DataFrame, list[str]], DataFrame], extra: str = "",
            bad: list[str] | None = None) -> DataFrame:
    """Rows with a key of one landing folder, every crawl of it, with `fetched_at` and ORDER. Unreadable lines and rows
    without a key are set aside in the run's folder, and `bad` gets a line that counts them."""
    landed = read_landing(run.spark, landing[kind], kind, f"{extra}, fetched_at timestamp" if extra else "fetched_at timestamp", place=True)
    landed = run._stored(f"landed/{kind}", landed)  # parsed once for the three ways its lines go
    rows = shape(readable(landed), ["fetched_at", PLACE])
    lines = run._stored(f"quarantine/{kind}/lines", corrupt(landed).select(CORRUPT)).count()
    keyless = run._stored(f"quarantine/{kind}/rows", shaping.rejected_rows(rows, key)).count()
    if bad is not None and lines + keyless:
        bad.append(f"{kind}: {lines} unreadable lines, {keyless} rows without a key")
    fetched = F.coalesce("fetched_at", moment(run.as_of)).alias("fetched_at")
    rows = shaping.valid_rows(rows, key).select("*", F.struct(fetched, PLACE).alias(ORDER)).drop("fetched_at", PLACE)
    return rows.withColumn("fetched_at", F.col(ORDER)["fetched_at"])


def _last(rows: DataFrame, key: str) -> DataFrame:
    return latest_per_key(rows, [key], ORDER, [c for c in rows.columns if c not in (key, ORDER)])


def apply_landing(run: Run, landing: Mapping[str, str], max_replies: int = 10, resumable: bool = False) -> DataFrame:
    """Bring the tables up to what lies in the landing folders, and log the run per channel.

    `landing` names a folder for any of channel, video, playlist and outcome (with channel_id), comment_thread and transcript
    (with video_id). Lines that cannot be read and rows without a key are set aside and counted in the log. With `resumable` the
    landed videos are noted as done, so that the next plan leaves them out. Returns the log rows of the run.
    """
    videos = last_videos = comments = spoken = None
    bad: list[str] = []
    if "channel" in landing:
        _apply_channels(run, landing, bad)
    if "playlist" in landing:
        lists = _shaped(run, landing, "playlist", "playlist_id", shaping.playlist_rows, "channel_id string", bad)
        lists = run.staged("playlist_crawls", lists)
        run.merge("playlists", lists, lambda part: maintenance.upsert_playlists(part, lists, order=ORDER, as_of=run.as_of))
    if "video" in landing:
        videos = run.staged("video_crawls", _shaped(run, landing, "video", "video_id", shaping.video_rows, bad=bad))
        run.merge("videos", videos, lambda part: maintenance.upsert_videos(part, videos, order=ORDER, as_of=run.as_of, whole_table=True))
        last_videos = run.staged("videos", _last(videos, "video_id"))
        run.merge("chapters", last_videos, lambda part: maintenance.replace_chapters(part, shaping.chapter_rows(last_videos), last_videos))
    if "comment_thread" in landing:
        shaped = _shaped(run, landing, "comment_thread", "comment_id", lambda items, keep: shaping.comment_rows(items, max_replies, keep),
                         "video_id string", bad)
        comments = run.staged("comments", first_per_key(shaped, ["comment_id"], F.struct(ORDER, "published_at", "text")))
    _apply_counts(run, videos, comments)
    if "transcript" in landing:
        spoken = _apply_transcripts(run, landing, bad)
    outcomes = None
    if "outcome" in landing:
        events = run.staged("outcomes", _shaped(run, landing, "outcome", "channel_id", shaping.outcome_rows, "channel_id string", bad))
        outcomes = run.staged("endings", maintenance.run_outcomes(events, ORDER))
    if resumable and last_videos is not None:
        save_progress(run, last_videos.select("channel_id", "video_id"), "videos")
    return _log(run, last_videos, comments, spoken, outcomes, bad)


def _apply_channels(run: Run, landing: Mapping[str, str], bad: list[str]) -> None:
    channels = run.staged("channel_crawls", _shaped(run, landing, "channel", "channel_id", shaping.channel_rows, bad=bad))
    run.merge("channels", channels, lambda part: maintenance.upsert_channels(part, channels, order=ORDER, as_of=run.as_of))
    stats = channels.select("channel_id", "fetched_at", "subscriber_count", "view_count", "video_count", ORDER)
    append("channel_stats", maintenance.new_stats("channel_stats", run.part("channel_stats", stats), stats, ORDER), run.database)


def _apply_counts(run: Run, videos: DataFrame | None, comments: DataFrame | None) -> None:
    """Snapshots and comments, and the summary that counts them. The new comments are settled first, so a
    repeated run raises the summary by the same rows."""
    stats = inserted = None
    touched = []
    if videos is not None:
        stats = videos.select("video_id", "fetched_at", "view_count", "like_count", "comment_count", ORDER)
        stats = run.staged("stats", first_per_key(stats, ["video_id", "fetched_at"], ORDER).drop(ORDER))  # read four times
        touched.append(videos.select("video_id"))
    if comments is not None:
        inserted = run.staged("new_comments", maintenance.new_comments(run.part("comments", comments, ["comment_id"]), comments, ORDER))
        touched.append(comments.select("video_id"))

    def counted(summary: DataFrame) -> DataFrame:
        if stats is not None:
            summary = maintenance.summary_after_stats(summary, stats, whole_table=True)
        return summary if inserted is None else maintenance.summary_after_comments(summary, inserted, comments, run.as_of)
    if touched:
        run.merge("video_comment_summary", reduce(DataFrame.union, touched), counted)
    if stats is not None:
        append("video_stats", maintenance.new_stats("video_stats", run.part("video_stats", stats), stats, unique=True), run.database)
    if inserted is not None:
        append("comments", maintenance.new_comments(run.part("comments", inserted, ["comment_id"]), inserted, unique=True), run.database)


def _apply_transcripts(run: Run, landing: Mapping[str, str], bad: list[str]) -> DataFrame:
    """Transcripts of the videos that had none; the first attempt of the landing that found one counts. Returns those that were new.

    Attempts without a transcript are counted in the log by the class of their outcome.
    """
    attempts = run.staged("attempts", _shaped(run, landing, "transcript", "video_id", shaping.transcript_attempts, "video_id string", bad))
    failed = attempts.filter(F.col("outcome") != "success").groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    bad += [f"transcript: {r['n']} {r['outcome']}" for r in failed.orderBy("outcome").collect()]
    found = attempts.filter(F.col("outcome") == "success").drop("outcome", "reason")
    new = run.staged("new_transcripts", maintenance.new_transcripts(run.part("transcripts", found), found, ORDER))
    append("transcripts", maintenance.new_transcripts(run.part("transcripts", new), new, unique=True), run.database)
    return new


# --- progress -------------------------------------------------------------------------------------

def save_progress(run: Run, done: DataFrame, operation: str) -> None:
    """Note finished work (channel_id, video_id), once, under the run and its time."""
    rows = done.withColumns({"fetch_id": F.xxhash64(F.lit(run.run_id), "channel_id"), "last_updated": moment(run.as_of)})
    rows = run.staged(f"progress/{operation}", first_per_key(rows, ["channel_id", "video_id"], None))
    append("fetch_progress", maintenance.save_progress(run.part("fetch_progress", rows), rows, operation, unique=True), run.database)


def resumed(run: Run, todo: DataFrame, operation: str) -> DataFrame:
    """What is left to do of a stored `todo` (channel_id, video_id); only its channels' buckets are read."""
    return maintenance.remaining_ids(todo, run.part("fetch_progress", todo), operation)


def clear_progress(run: Run, channels: DataFrame, operation: str | None = None) -> None:
    """Forget the progress of the finished channels of a stored list, for one operation or all."""
    run.merge("fetch_progress", channels, lambda part: maintenance.clear_progress(part, channels, operation), f"cleared-{operation or 'all'}")


# --- vanished, deleted, purged --------------------------------------------------------------------

def apply_listing(run: Run, listing: DataFrame, declared: DataFrame) -> DataFrame:
    """Mark the videos that a complete listing no longer has as deleted; returns them.

    `listing` has (channel_id, video_id), `declared` the number of videos each channel's listing announced. A listing proves
    absence only if it brought as many different ids as announced. A video that is deleted already keeps its date.
    """
    gone = run.staged("vanished", lambda: planning.vanished_video_ids(
        run.table("videos"), listing, planning.complete_listings(listing, declared)))
    run.merge("videos", gone, lambda part: maintenance.mark_deleted(part, gone, run.as_of), "deleted")
    return gone


def purge(run: Run, older_than_days: int = 30, channel_id: str | None = None) -> DataFrame:
    """Remove the videos deleted longer ago than the grace period, with all rows that belong to them; returns (table, purged).

    Only partitions that hold such rows are rewritten. The videos themselves go last, so a run that was cut short finds them again.
    """
    victims = run._stored("victims", lambda: maintenance.purge_victims(run.table("videos"), run.as_of, older_than_days, channel_id))
    ids = victims.hint("shuffle_hash") if victims.count() > HASHED_IDS else victims
    counts = []
    for name in maintenance.VIDEO_TABLES:
        lost = run.drop(name, victims, lambda part: part.join(ids, "video_id", "left_anti"), "purged")
        counts.append(lost.agg(F.lit(name).alias("table"), F.coalesce(F.sum("n"), F.lit(0)).alias("purged")))
    return reduce(DataFrame.unionByName, counts)


# --- log ------------------------------------------------------------------------------------------

def _log(run: Run, videos: DataFrame | None, comments: DataFrame | None, spoken: DataFrame | None, outcomes: DataFrame | None,
         bad: list[str]) -> DataFrame:
    """A log row per channel touched: how its run ended and what went wrong, its own events first, then what the whole run
    had to set aside. Its id follows from the run and the channel."""
    owners = run.table("videos").select("video_id", "channel_id")
    counts = []
    if videos is not None:
        counts.append(videos.groupBy("channel_id").agg(F.count(F.lit(1)).alias("videos_fetched")))
    if comments is not None:
        per_video = comments.groupBy("video_id").agg(F.count(F.lit(1)).alias("_n"))
        counts.append(per_video.join(owners, "video_id").groupBy("channel_id").agg(F.sum("_n").alias("comments_fetched")))
    if spoken is not None:
        counts.append(spoken.select("video_id").join(owners, "video_id").groupBy("channel_id").agg(F.count(F.lit(1)).alias("transcripts_fetched")))
    if outcomes is not None:
        counts.append(outcomes.withColumnsRenamed({"status": "_status", "errors": "_errors"}))
    if not counts:
        return run.table("fetch_log").limit(0)
    together = counts[0]
    for more in counts[1:]:
        together = together.join(more, "channel_id", "full")
    fetch_id = F.xxhash64(F.lit(run.run_id), "channel_id").alias("fetch_id")
    kinds = planning.last_fetch_times(together, run.table("fetch_log"))
    runs = together.select("channel_id", fetch_id).join(kinds.select("channel_id", "fetch_type"), "channel_id")

    def count(name: str):
        return F.coalesce(name, F.lit(0)).alias(name) if name in together.columns else F.lit(0).cast("bigint").alias(name)

    set_aside = F.array(*map(F.lit, bad)).cast("array<string>")
    errors = set_aside if outcomes is None else F.concat(F.coalesce("_errors", F.array().cast("array<string>")), set_aside)
    results = together.select(
        fetch_id, count("videos_fetched"), count("comments_fetched"), count("transcripts_fetched"),
        errors.alias("errors"), (F.coalesce("_status", F.lit("completed")) if outcomes is not None else F.lit("completed")).alias("status"))
    log = maintenance.fetch_log_from_events(maintenance.open_runs(runs, run.as_of), maintenance.close_runs(results, run.as_of))
    log = run.staged("fetch_log", conform("fetch_log", log))
    append("fetch_log", maintenance.rows_missing(log, run.table("fetch_log"), ["fetch_id"]), run.database)
    return log
