"""New landing files into the append-only tables, each file once.

The stream only finds what is new; the work on it is the batch operators'. A batch replayed after a
failure finds its keys stored already and appends nothing, so the tables see every row once.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from snapstats.operators.maintenance import new_comments, new_stats
from snapstats.operators.shaping import comment_rows, rejected_rows, valid_rows, video_rows
from snapstats.schemas import BLOOM_FILTERED
from snapstats.sources.landing import CORRUPT, PLACE, corrupt, parse_lines, readable, with_line
from snapstats.sources.tables import append, part_for, qualified

_log = logging.getLogger(__name__)


def landing_stream(spark: SparkSession, path: str, payload: str, extra: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of landed items with their `extra` fields (DDL), unreadable lines and places, as `parse_lines` gives them."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return parse_lines(lines, payload, extra, place=True)


def _run(spark: SparkSession, stream: DataFrame, checkpoint: str, table: str, database: str | None, key: str,
         shape: Callable[[DataFrame], DataFrame], pick: Callable[[DataFrame, DataFrame], DataFrame]) -> StreamingQuery:
    """Process what has landed since the last run, then stop.

    Unreadable lines and rows without a key go to `<checkpoint>-quarantine/<batch>/{lines,rows}`, and a warning counts them.
    """
    def aside(rows: DataFrame, number: int, what: str) -> int:
        # A replayed batch writes the same folder again.
        path = f"{checkpoint.rstrip('/')}-quarantine/{number}/{what}"
        rows.write.mode("overwrite").parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path).count()

    def work(batch: DataFrame, number: int) -> None:
        # A batch has a session of its own, with its own list of the table's files.
        batch = batch.withColumn(PLACE, with_line(F.col(PLACE))).persist()
        shaped = shape(readable(batch))
        bad = aside(corrupt(batch).select(CORRUPT), number, "lines"), aside(rejected_rows(shaped, key), number, "rows")
        if any(bad):
            _log.warning("%s, batch %d: %d unreadable lines, %d rows without a key", table, number, *bad)
        rows = valid_rows(shaped, key).persist()
        current = part_for(batch.sparkSession, table, rows, database, [key] if table in BLOOM_FILTERED else None)
        append(table, pick(current, rows), database)
        rows.unpersist()
        batch.unpersist()
        spark.catalog.refreshTable(qualified(table, database))

    return (stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def ingest_comments(spark: SparkSession, path: str, checkpoint: str, database: str | None = None,
                    max_replies: int = 10) -> StreamingQuery:
    """Landed comment threads into `comments`; a known comment keeps its first text."""
    stream = landing_stream(spark, path, "comment_thread", "video_id string, fetched_at timestamp")
    return _run(spark, stream, checkpoint, "comments", database, "comment_id",
                lambda batch: comment_rows(batch, max_replies, ["fetched_at", PLACE]),
                lambda current, rows: new_comments(current, rows, order=F.struct("fetched_at", PLACE, "published_at", "text")))


def ingest_video_stats(spark: SparkSession, path: str, checkpoint: str, database: str | None = None) -> StreamingQuery:
    """Counts of landed video items into `video_stats`, one snapshot per video and fetch time."""
    columns = ["video_id", "fetched_at", "view_count", "like_count", "comment_count"]
    return _run(spark, landing_stream(spark, path, "video", "fetched_at timestamp"), checkpoint, "video_stats", database, "video_id",
                lambda batch: video_rows(batch, ["fetched_at", PLACE]).select(*columns, PLACE),
                lambda current, rows: new_stats("video_stats", current, rows, order=PLACE))
