"""Raw responses as they were landed, and the channel list with its options."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from snapstats.schemas import PAYLOAD_DDL, payload_schema

CORRUPT = "_corrupt_record"
# Where a line stood in the landing: file, split of the file, line in the split; sorts in that order.
PLACE = "_place"


def read_landing(spark: SparkSession, path: str, payload: str, extra: str = "", place: bool = False) -> DataFrame:
    """JSON lines of one payload as a nested `item`; a line that cannot be read is kept as text.

    `extra` names further top-level fields in DDL, e.g. the video a thread belongs to; `place` adds PLACE. The lines are
    read as text and parsed by expression: the JSON reader refuses to look at the unreadable lines by themselves.
    """
    return parse_lines(spark.read.text(path), payload, extra, place)


def parse_lines(lines: DataFrame, payload: str, extra: str = "", place: bool = False) -> DataFrame:
    """Lines of text files, read or streamed, as `read_landing` gives them."""
    names = payload_schema(payload).fieldNames()
    own = T.StructType.fromDDL(extra).fieldNames() if extra else []
    ddl = ", ".join([PAYLOAD_DDL[payload], *([extra] if extra else []), f"{CORRUPT} string"])
    line = F.from_json("value", ddl, {"columnNameOfCorruptRecord": CORRUPT})
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))
    at = at if lines.isStreaming else with_line(at)  # a stream can number its lines only batch by batch
    placed = [at.alias(PLACE)] if place else []
    rows = lines.filter(F.col("value") != "").select(line.alias("_line"), *placed).select("_line.*", *[PLACE for _ in placed])
    return rows.select(F.struct(*names).alias("item"), *own, CORRUPT, *[PLACE for _ in placed])


def with_line(place: Column) -> Column:
    """PLACE with a number that grows from line to line of a split."""
    return F.struct(place["file"].alias("file"), place["split"].alias("split"), F.monotonically_increasing_id().alias("line"))


def readable(landed: DataFrame) -> DataFrame:
    return landed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt(landed: DataFrame) -> DataFrame:
    """Lines set aside."""
    return landed.filter(F.col(CORRUPT).isNotNull())


def read_channel_options(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame:
    """Channel list from JSON lines (`{"identifier": "@x", "max_videos": 500}`) or CSV with a header.

    `options` gives the type of each option; an entry that leaves one out has NULL there.
    """
    ddl = ", ".join(["identifier string", *[f"{name} {kind}" for name, kind in options.items()]])
    reader = spark.read.schema(ddl)
    if path.endswith(".csv"):
        # By name rather than by place, so a list may leave options out.
        listed = spark.read.option("header", True).csv(path)
        types = T.StructType.fromDDL(ddl)
        return listed.select(*[
            (F.col(f.name) if f.name in listed.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in types.fields])
    return reader.json(path)
