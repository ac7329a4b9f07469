"""Raw payloads to typed rows: column expressions over nested JSON, one pass per landing table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapstats.functions.numeric import count_or_zero, flag, percent
from snapstats.functions.text import (
    chapter_marks, has_chapter_line, identifier_kind, identifier_value, iso_duration_seconds,
)
from snapstats.functions.timeutil import parse_timestamp
from snapstats.operators.keyed import top_per_key
from snapstats.schemas import PAYLOAD_DDL

# Transcript languages in order of preference (fixed values).
LANGUAGES = ["en", "en-US", "en-GB"]
# Marks of a refused request in an error text (fixed values).
BLOCK_MARKS = ["blocked", "ip", "429", "too many"]


def parsed(raw: DataFrame, payload: str, column: str = "json") -> DataFrame:
    """JSON text of a landing table as a nested `item`; other columns are kept."""
    return raw.withColumn("item", F.from_json(F.col(column), PAYLOAD_DDL[payload])).drop(column)


def thumbnail(snippet: Column) -> Column:
    """Address of the large picture if there is one, else of the default one; NULL where that has none."""
    pictures = snippet["thumbnails"]
    return F.when(pictures["high"].isNotNull(), pictures["high"]["url"]).otherwise(pictures["default"]["url"])


def _list(items: Column) -> Column:
    return F.coalesce(items, F.array().cast("array<string>"))


def valid_rows(rows: DataFrame, key: str) -> DataFrame:
    return rows.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")


def rejected_rows(rows: DataFrame, key: str) -> DataFrame:
    """Rows without a key: kept aside, the rest of the batch goes on."""
    return rows.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) == "")


def channel_rows(items: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Channel items (column `item`) to metadata and counts."""
    item = F.col("item")
    snippet, counts = item["snippet"], item["statistics"]
    return items.select(
        item["id"].alias("channel_id"), snippet["title"].alias("title"), snippet["description"].alias("description"),
        snippet["customUrl"].alias("custom_url"), snippet["country"].alias("country"),
        parse_timestamp(snippet["publishedAt"]).alias("published_at"), thumbnail(snippet).alias("thumbnail_url"),
        item["brandingSettings"]["image"]["bannerExternalUrl"].alias("banner_url"),
        item["brandingSettings"]["channel"]["keywords"].alias("keywords"),
        _list(item["topicDetails"]["topicCategories"]).alias("topic_categories"),
        item["contentDetails"]["relatedPlaylists"]["uploads"].alias("uploads_playlist_id"),
        count_or_zero(counts["subscriberCount"]).alias("subscriber_count"),
        count_or_zero(counts["viewCount"]).alias("view_count"), count_or_zero(counts["videoCount"]).alias("video_count"), *keep,
    )


def video_rows(items: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Video items to metadata and counts, with the `keep` columns; chapters come from `chapter_rows`."""
    item = F.col("item")
    snippet, content, status, counts = (item[p] for p in ("snippet", "contentDetails", "status", "statistics"))
    return items.select(
        *keep, item["id"].alias("video_id"), snippet["channelId"].alias("channel_id"), snippet["title"].alias("title"),
        snippet["description"].alias("description"), parse_timestamp(snippet["publishedAt"]).alias("published_at"),
        iso_duration_seconds(content["duration"]).alias("duration_seconds"),
        F.coalesce(content["duration"], F.lit("")).alias("duration_iso"), snippet["categoryId"].alias("category_id"),
        snippet["defaultLanguage"].alias("default_language"),
        snippet["defaultAudioLanguage"].alias("default_audio_language"), _list(snippet["tags"]).alias("tags"),
        thumbnail(snippet).alias("thumbnail_url"), flag(content["caption"] == "true").alias("caption_available"),
        content["definition"].alias("definition"), content["dimension"].alias("dimension"),
        content["projection"].alias("projection"), status["privacyStatus"].alias("privacy_status"),
        status["license"].alias("license"), flag(status["embeddable"]).alias("embeddable"),
        flag(status["madeForKids"]).alias("made_for_kids"),
        _list(item["topicDetails"]["topicCategories"]).alias("topic_categories"),
        count_or_zero(counts["viewCount"]).alias("view_count"), count_or_zero(counts["likeCount"]).alias("like_count"),
        count_or_zero(counts["commentCount"]).alias("comment_count"),
        flag(has_chapter_line(snippet["description"])).alias("has_chapters"),
    )


def playlist_rows(items: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Playlist items (columns `channel_id`, `item`) to rows."""
    item = F.col("item")
    snippet = item["snippet"]
    return items.select(
        item["id"].alias("playlist_id"), "channel_id", snippet["title"].alias("title"),
        snippet["description"].alias("description"), parse_timestamp(snippet["publishedAt"]).alias("published_at"),
        thumbnail(snippet).alias("thumbnail_url"), count_or_zero(item["contentDetails"]["itemCount"]).alias("item_count"),
        item["status"]["privacyStatus"].alias("privacy_status"), *keep,
    )


def chapter_rows(videos: DataFrame) -> DataFrame:
    """Chapters of each video: one per chapter-like line of the description, in line order.

    A chapter ends where the next begins; the last ends with the video, or is open without a duration.
    The marks sit in one array of the row, so looking at the next one needs no window and no shuffle.
    """
    duration, marks = F.col("duration_seconds"), F.col("_marks")
    return (
        videos.select("video_id", duration, chapter_marks(F.col("description")).alias("_marks"))
        .select("video_id", duration, marks, F.posexplode(marks).alias("chapter_index", "_mark"))
        .select(
            "video_id", "chapter_index", F.col("_mark.title").alias("title"),
            F.col("_mark.start_seconds").alias("start_seconds"),
            F.when(F.col("chapter_index") < F.size(marks) - 1, F.get(marks, F.col("chapter_index") + 1)["start_seconds"])
            .when(duration != 0, duration).alias("end_seconds"),
        )
    )


def _comment(snippet: Column, comment_id: Column, parent: Column) -> Column:
    return F.struct(
        comment_id.alias("comment_id"), parent.alias("parent_comment_id"),
        snippet["authorDisplayName"].alias("author_display_name"),
        snippet["authorChannelId"]["value"].alias("author_channel_id"), snippet["textDisplay"].alias("text"),
        count_or_zero(snippet["likeCount"]).alias("like_count"),
        parse_timestamp(snippet["publishedAt"]).alias("published_at"),
        parse_timestamp(snippet["updatedAt"]).alias("updated_at"),
    )


def kept_replies(thread: Column, max_replies: int) -> Column:
    replies = F.coalesce(thread["replies"]["comments"],
                         F.array().cast("array<struct<id: string, snippet: struct<authorDisplayName: string, "
                                        "authorChannelId: struct<value: string>, textDisplay: string, "
                                        "likeCount: string, publishedAt: string, updatedAt: string>>>"))
    return F.slice(replies, 1, max_replies)


def comment_rows(threads: DataFrame, max_replies: int = 10, keep: Sequence[str] = ()) -> DataFrame:
    """Comment threads (columns `video_id`, `item`) to rows: the top comment, then its first replies.

    Further columns of the thread named in `keep` go to each of its rows.
    """
    item = F.col("item")
    top = _comment(item["snippet"]["topLevelComment"]["snippet"], item["id"], F.lit(None).cast("string"))
    replies = F.transform(kept_replies(item, max_replies), lambda r: _comment(r["snippet"], r["id"], item["id"]))
    everything = F.explode(F.concat(F.array(top), replies)).alias("_c")
    return threads.select("video_id", *keep, everything).select("video_id", *keep, "_c.*")


def threads_since(threads: DataFrame, latest: DataFrame) -> DataFrame:
    """Threads newer than the newest stored comment of their video (`latest_comment_times`).

    Replies come with their thread whatever their own date; a thread without a date is kept.
    """
    published = parse_timestamp(F.col("item.snippet.topLevelComment.snippet.publishedAt"))
    known = F.col("latest_comment_at").cast("timestamp")
    return (
        threads.join(latest.select("video_id", "latest_comment_at"), "video_id", "left")
        .filter(known.isNull() | published.isNull() | (published > known))
        .select(*threads.columns)
    )


def capped_threads(threads: DataFrame, max_results: int = 500, max_replies: int = 10) -> DataFrame:
    """Threads of each video, by `position`, until `max_results` comments are reached.

    A thread is taken whole while fewer were taken before it, so the cap may be passed by its replies.
    Every thread counts at least one, so the first `max_results` threads are enough to decide. That is settled on keys and sizes;
    the threads themselves only meet the keys that stay. Threads that share video and position stay or go together.
    """
    keys = ["video_id", "position"]
    sizes = threads.groupBy(*keys).agg(F.sum(F.size(kept_replies(F.col("item"), max_replies)) + 1).alias("_size"))
    head = top_per_key(sizes, ["video_id"], [F.asc("position")], max_results, keys)
    window = Window.partitionBy("video_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    kept = head.withColumn("_taken", F.coalesce(F.sum("_size").over(window), F.lit(0))).filter(F.col("_taken") < max_results)
    kept = kept.select(*(F.col(k).alias(f"_{k}") for k in keys))
    same = [threads[k].eqNullSafe(kept[f"_{k}"]) for k in keys]
    return threads.join(kept, same[0] & same[1], "left_semi")


def choose_track(tracks: DataFrame, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """One transcript track per video: written by hand in a preferred language, else generated in one,
    else the first that can be translated. The order of languages settles ties, then `position`.
    """
    preference = F.array_position(F.lit(list(languages)), F.col("language_code"))
    n = len(languages)
    rank = (
        F.when((preference > 0) & ~F.col("is_generated"), preference)
        .when((preference > 0) & F.col("is_generated"), preference + n)
        .when(F.col("is_translatable"), F.lit(2 * n + 1))
    )
    best = top_per_key(tracks.withColumn("_rank_in_list", rank).filter(F.col("_rank_in_list").isNotNull()),
                       ["video_id"], [F.asc("_rank_in_list"), F.asc("position")], 1, ["video_id", "position"])
    translated = F.col("_rank_in_list") > 2 * n
    return best.select(
        "video_id",
        F.when(translated, "translated").when(F.col("is_generated"), "auto-generated").otherwise("manual")
        .alias("transcript_type"),
        F.when(translated, "English (translated)").otherwise(F.col("language")).alias("language"),
        F.when(translated, "en").otherwise(F.col("language_code")).alias("language_code"),
        "is_generated",
        F.when(translated, F.col("language")).alias("original_language"),
        F.when(translated, F.col("language_code")).alias("original_language_code"),
    )


def best_track(tracks: Column, languages: Sequence[str] = LANGUAGES) -> Column:
    """The track of one video's array by the rule of `choose_track`, with its `rank`; NULL if none will do."""
    n = len(languages)

    def ranked(track: Column, at: Column) -> Column:
        preference = F.array_position(F.lit(list(languages)), track["language_code"])
        rank = (F.when((preference > 0) & ~track["is_generated"], preference).when((preference > 0) & track["is_generated"], preference + n)
                .when(track["is_translatable"], F.lit(2 * n + 1).cast("bigint")))
        return F.struct(rank.alias("rank"), at.alias("at"), track.alias("track"))
    return F.array_min(F.filter(F.transform(tracks, ranked), lambda r: r["rank"].isNotNull()))


def transcript_attempts(items: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Landed attempts (`video_id`, `item`) to transcript rows with their outcome class; an attempt succeeds if it has a
    usable track and its segments. The track is chosen inside the row, so nothing is shuffled.
    """
    best, n = best_track(F.col("item.tracks")), len(LANGUAGES)
    translated = F.col("_best.rank") > 2 * n
    found = F.col("_best").isNotNull() & (F.coalesce(F.size("item.segments"), F.lit(0)) > 0)
    rows = items.withColumn("_best", best).select(
        "video_id", *keep,
        F.when(translated, "English (translated)").otherwise(F.col("_best.track.language")).alias("language"),
        F.when(translated, "en").otherwise(F.col("_best.track.language_code")).alias("language_code"),
        F.when(translated, "translated").when(F.col("_best.track.is_generated"), "auto-generated").otherwise("manual").alias("transcript_type"),
        F.col("item.segments").alias("segments"), found.alias("available"),
        F.coalesce("item.failed", F.lit(False)).alias("failed"), F.coalesce("item.reason", F.lit("")).alias("reason"))
    return classify_outcomes(transcript_rows(rows)).drop("available", "failed", "snippet_count")


def transcript_rows(transcripts: DataFrame) -> DataFrame:
    """Segments of each transcript with their ends, the whole text, and how many there are."""
    return transcripts.withColumns({
        "entries": F.transform("segments", lambda s: F.struct(
            s["start"].alias("start"), s["duration"].alias("duration"), (s["start"] + s["duration"]).alias("end"),
            s["text"].alias("text"))),
        "full_text": F.array_join(F.transform("segments", lambda s: s["text"]), " "),
        "snippet_count": F.size("segments"),
    }).drop("segments")


def looks_blocked(reason: Column) -> Column:
    text = F.lower(reason)
    hit = F.lit(False)
    for mark in BLOCK_MARKS:
        hit = hit | text.contains(mark)
    return flag(hit)


def classify_outcomes(outcomes: DataFrame) -> DataFrame:
    """Class of each transcript attempt (columns `available`, `failed`, `reason`).

    A failed attempt whose text speaks of a refused request is 'blocked', any other failure 'error';
    without a failure the uploader has 'disabled' them or they are 'unavailable'.
    """
    reason = F.col("reason")
    return outcomes.withColumn(
        "outcome",
        F.when(F.col("available"), "success")
        .when(F.col("failed") & looks_blocked(reason), "blocked")
        .when(F.col("failed"), "error")
        .when(F.lower(reason).contains("disabled"), "disabled")
        .otherwise("unavailable"))


def outcome_rows(items: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Landed events of a channel's crawl: (channel_id, kind, reason)."""
    return items.select("channel_id", F.col("item.kind").alias("kind"), F.coalesce("item.reason", F.lit("")).alias("reason"), *keep)


def outcome_totals(outcomes: DataFrame) -> DataFrame:
    """How many attempts succeeded, and each other class."""
    def n(name: str) -> Column:
        return F.count_if(F.col("outcome") == name).alias(name)
    totals = outcomes.agg(F.count(F.lit(1)).alias("total"),
                          *[n(c) for c in ("success", "unavailable", "disabled", "blocked", "error")])
    return totals.withColumn("found_pct", percent(F.col("success"), F.col("total"), 1))


def failure_breakdown(outcomes: DataFrame, all_up_to: int = 5, else_first: int = 3) -> DataFrame:
    """Failed attempts per class with examples: all of a small class, the first few of a larger one."""
    failed = outcomes.filter(F.col("outcome") != "success")
    counts = failed.groupBy("outcome").agg(F.count(F.lit(1)).alias("videos"))
    shown = top_per_key(failed.select("outcome", "video_id", "reason"), ["outcome"], [F.asc("video_id")], all_up_to,
                        ["video_id"])
    examples = shown.groupBy("outcome").agg(F.sort_array(F.collect_list(F.struct("video_id", "reason"))).alias("_all"))
    show = F.when(F.col("videos") <= all_up_to, F.lit(all_up_to)).otherwise(F.lit(else_first))
    return counts.join(examples, "outcome").select("outcome", "videos", F.slice("_all", F.lit(1), show).alias("examples"))


def success_breakdown(chosen: DataFrame) -> DataFrame:
    """Found transcripts per type."""
    return chosen.groupBy("transcript_type").agg(F.count(F.lit(1)).alias("videos"))


def parse_identifiers(identifiers: DataFrame) -> DataFrame:
    """What each channel identifier is, a channel id or a handle, and its bare value."""
    text = F.col("identifier")
    return identifiers.select("identifier", identifier_kind(text).alias("kind"), identifier_value(text).alias("value"))


def searched_ids(pages: DataFrame, after: DataFrame | None = None, page_number: str = "page_number") -> DataFrame:
    """Search pages (columns `channel_id`, page number, `item`) to video ids in listing order; other kinds of hits drop out.

    A search is asked for what was published after a channel's newest stored video; `after` (channel_id, latest_published_at) drops
    hits that an answer brings all the same. Hits without a readable date stay.
    """
    entries = pages.select("channel_id", page_number, F.posexplode("item.items").alias("_at", "_entry")).select(
        "channel_id", F.col("_entry.id.videoId").alias("video_id"), parse_timestamp(F.col("_entry.snippet.publishedAt")).alias("published_at"),
        F.struct(F.col(page_number).alias("page"), F.col("_at").alias("at")).alias("position"))
    entries = valid_rows(entries, "video_id")
    if after is None:
        return entries
    known = after.select("channel_id", F.col("latest_published_at").alias("_after"))
    return (entries.join(known, "channel_id", "left")
            .filter(F.col("_after").isNull() | F.col("published_at").isNull() | (F.col("published_at") > F.col("_after"))).drop("_after"))


def listed_ids(pages: DataFrame, page_number: str = "page_number") -> DataFrame:
    """Playlist pages (columns `channel_id`, page number, `item`) to video ids in listing order; blanks drop out.

    `position` orders a channel's entries across its pages without counting them.
    """
    entries = pages.select("channel_id", page_number, F.posexplode("item.items").alias("_at", "_entry")).select(
        "channel_id", F.col("_entry.contentDetails.videoId").alias("video_id"),
        F.struct(F.col(page_number).alias("page"), F.col("_at").alias("at")).alias("position"))
    return valid_rows(entries, "video_id")
