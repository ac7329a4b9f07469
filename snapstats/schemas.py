"""Tables, keys and update rules, and the nested payloads they are filled from.

Column names, keys and update lists are fixed values: the stored tables and the payloads have them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Table definitions as Spark DDL.
TABLE_DDL = {
    "channels": (
        "channel_id string, title string, description string, custom_url string, country string, "
        "published_at timestamp, thumbnail_url string, banner_url string, keywords string, "
        "topic_categories array<string>, uploads_playlist_id string, updated_at timestamp"
    ),
    "channel_stats": (
        "channel_id string, fetched_at timestamp, subscriber_count bigint, view_count bigint, video_count bigint"
    ),
    "videos": (
        "video_id string, channel_id string, title string, description string, published_at timestamp, "
        "duration_seconds bigint, duration_iso string, category_id string, default_language string, "
        "default_audio_language string, tags array<string>, thumbnail_url string, caption_available boolean, "
        "definition string, dimension string, projection string, privacy_status string, license string, "
        "embeddable boolean, made_for_kids boolean, topic_categories array<string>, has_chapters boolean, "
        "first_seen_at timestamp, updated_at timestamp"
    ),
    "video_stats": "video_id string, fetched_at timestamp, view_count bigint, like_count bigint, comment_count bigint",
    "chapters": "video_id string, chapter_index int, title string, start_seconds bigint, end_seconds bigint",
    "transcripts": (
        "video_id string, language string, language_code string, transcript_type string, full_text string, "
        "entries array<struct<start: double, duration: double, end: double, text: string>>, fetched_at timestamp"
    ),
    "comments": (
        "comment_id string, video_id string, parent_comment_id string, author_display_name string, "
        "author_channel_id string, text string, like_count bigint, published_at timestamp, "
        "updated_at timestamp, fetched_at timestamp"
    ),
    "playlists": (
        "playlist_id string, channel_id string, title string, description string, published_at timestamp, "
        "thumbnail_url string, item_count bigint, privacy_status string, updated_at timestamp"
    ),
    "fetch_log": (
        "fetch_id bigint, channel_id string, fetch_type string, started_at timestamp, completed_at timestamp, "
        "videos_fetched bigint, comments_fetched bigint, transcripts_fetched bigint, errors string, status string"
    ),
    "fetch_progress": "channel_id string, operation string, video_id string, fetch_id bigint, last_updated timestamp",
    "quota_usage": "date date, used bigint, operations map<string, bigint>, last_updated timestamp",
    "video_comment_summary": (
        "video_id string, stored_comment_count bigint, last_comment_fetch timestamp, "
        "latest_youtube_comment_count bigint, last_stats_fetch timestamp"
    ),
}

PRIMARY_KEYS = {
    "channels": ["channel_id"],
    "channel_stats": ["channel_id", "fetched_at"],
    "videos": ["video_id"],
    "video_stats": ["video_id", "fetched_at"],
    "chapters": ["video_id", "chapter_index"],
    "transcripts": ["video_id"],
    "comments": ["comment_id"],
    "playlists": ["playlist_id"],
    "fetch_log": ["fetch_id"],
    "fetch_progress": ["channel_id", "operation", "video_id"],
    "quota_usage": ["date"],
    "video_comment_summary": ["video_id"],
}

# Columns an incoming row overwrites; every other column keeps its first value.
UPDATE_COLUMNS = {
    "channels": [
        "title", "description", "custom_url", "thumbnail_url", "banner_url", "keywords",
        "topic_categories", "updated_at",
    ],
    "videos": [
        "title", "description", "tags", "thumbnail_url", "caption_available", "privacy_status",
        "has_chapters", "updated_at",
    ],
    "playlists": ["title", "description", "thumbnail_url", "item_count", "privacy_status", "updated_at"],
    "quota_usage": ["used", "operations", "last_updated"],
}

# Tables carried between stores (the comment summary is derived again at the destination).
SYNC_TABLES = [name for name in TABLE_DDL if name != "video_comment_summary"]

# Tables that may be written out as CSV.
EXPORT_TABLES = [
    "channels", "channel_stats", "videos", "video_stats", "chapters", "transcripts", "comments", "playlists",
]

# Layout columns of the stored tables; they follow from the rows and belong to no schema.
MONTH_COLUMN, BUCKET_COLUMN = "fetched_month", "key_bucket"

# Append-only tables laid out by month, so that time windows prune whole folders. Within a month every run
# writes its own files with a narrow range of times, which the file statistics prune further.
MONTH_PARTITIONED = {"channel_stats": "fetched_at", "video_stats": "fetched_at", "comments": "fetched_at"}

# Tables laid out by a hash of this column, so that a batch reads and rewrites the buckets of its keys only. All
# rows of a video lie in the bucket of its id.
BUCKETED = {
    "channels": "channel_id", "videos": "video_id", "video_stats": "video_id", "chapters": "video_id", "transcripts": "video_id",
    "comments": "video_id", "playlists": "playlist_id", "fetch_progress": "channel_id", "video_comment_summary": "video_id",
}

# Keys that are looked up one by one get Bloom filters in the files.
BLOOM_FILTERED = {"comments": "comment_id"}


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLE_DDL[name])


_THUMBNAILS = "thumbnails: struct<high: struct<url: string>, default: struct<url: string>>"
_COMMENT = (
    "authorDisplayName: string, authorChannelId: struct<value: string>, textDisplay: string, "
    "likeCount: string, publishedAt: string, updatedAt: string"
)

# Payloads: only the paths that are read. Counts arrive as text.
PAYLOAD_DDL = {
    "channel": (
        "id string, snippet struct<title: string, description: string, customUrl: string, country: string, "
        f"publishedAt: string, {_THUMBNAILS}>, "
        "statistics struct<subscriberCount: string, viewCount: string, videoCount: string>, "
        "brandingSettings struct<image: struct<bannerExternalUrl: string>, channel: struct<keywords: string>>, "
        "topicDetails struct<topicCategories: array<string>>, "
        "contentDetails struct<relatedPlaylists: struct<uploads: string>>"
    ),
    "video": (
        "id string, snippet struct<channelId: string, title: string, description: string, publishedAt: string, "
        "categoryId: string, defaultLanguage: string, defaultAudioLanguage: string, tags: array<string>, "
        f"{_THUMBNAILS}>, "
        "contentDetails struct<duration: string, caption: string, definition: string, dimension: string, "
        "projection: string>, "
        "status struct<privacyStatus: string, license: string, embeddable: boolean, madeForKids: boolean>, "
        "statistics struct<viewCount: string, likeCount: string, commentCount: string>, "
        "topicDetails struct<topicCategories: array<string>>"
    ),
    "playlist": (
        f"id string, snippet struct<title: string, description: string, publishedAt: string, {_THUMBNAILS}>, "
        "contentDetails struct<itemCount: string>, status struct<privacyStatus: string>"
    ),
    "playlist_page": "items array<struct<contentDetails: struct<videoId: string>>>, nextPageToken string",
    "search_page": "items array<struct<id: struct<videoId: string>, snippet: struct<publishedAt: string>>>, nextPageToken string",
    "comment_thread": (
        f"id string, snippet struct<topLevelComment: struct<snippet: struct<{_COMMENT}>>>, "
        f"replies struct<comments: array<struct<id: string, snippet: struct<{_COMMENT}>>>>"
    ),
    # What went wrong while a channel was crawled.
    "outcome": "kind string, reason string",
    # An attempt at a video's transcript: the tracks on offer, the segments of the chosen one, or what went wrong.
    "transcript": (
        "tracks array<struct<language: string, language_code: string, is_generated: boolean, is_translatable: boolean>>, "
        "segments array<struct<start: double, duration: double, text: string>>, failed boolean, reason string"
    ),
}


def payload_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(PAYLOAD_DDL[name])
