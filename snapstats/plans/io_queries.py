"""Sources and sinks: what was written is read back and compared. Files go to the shared folder."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from snapstats.operators import reports, usage
from snapstats.plans import report_queries, shaping_queries
from snapstats.plans.driver_tables import BASE_TABLES, EVENTS_AS_OF, DriverTables
from snapstats.plans.store_queries import CONTENTS, content, in_store
from snapstats.schemas import EXPORT_TABLES, PRIMARY_KEYS
from snapstats.session import shared_folder
from snapstats.sources import exports, landing, tables


def _fresh(t: DriverTables, kind: str) -> str:
    return f"{shared_folder(t.spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


# A column of every table whose sum its rows are known by.
SUMMED = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
    "lineitem": "l_partkey", "events": "event_id", "documents": "length(text)", "embeddings": "1", "pages": "length(html)",
    "benchmark": "length(text)", "labels": "doc_id", "conversations": "length(text)",
}


def load_tables(t: DriverTables):
    """Every table read, its rows counted and one of its columns summed."""
    loaded = tables.load_tables(t.spark, t.folder, BASE_TABLES, layout="{root}/{table}.parquet")
    parts = [loaded[n].selectExpr(f"'{n}' as table", "count(*) as rows", f"cast(sum({SUMMED[n]}) as bigint) as total") for n in BASE_TABLES]
    return reduce(DataFrame.unionByName, parts)


LOAD_TABLES = " union all ".join(
    f"""select '{n}' as "table", count(*) as rows, cast(sum({SUMMED[n]}) as bigint) as total from {n}""" for n in BASE_TABLES)


# What a stored row is known by: all tables are filled, appended to twice, read back.
STORED = {**CONTENTS, "video_comment_summary": ["video_id", "stored_comment_count", "latest_youtube_comment_count"]}


def _source(name: str) -> str:
    return "plan_summary" if name == "video_comment_summary" else name


def stored_tables(t: DriverTables):
    """All twelve tables created, filled in two appends and created again, then read back."""
    def work(database: str, _: str):
        parts = []
        for name in STORED:
            rows = tables.conform(name, t[_source(name)])
            key = F.pmod(F.xxhash64(*PRIMARY_KEYS[name]), F.lit(2))
            for half in (0, 1):
                tables.append(name, rows.filter(key == half), database)
        tables.create_tables(t.spark, database)
        for name, df in tables.load_catalog(t.spark, database).items():
            parts.append(df.selectExpr(*content(STORED[name], "cast(conv({}, 16, 10) as bigint)")).select(F.lit(name).alias("table"), "rows", "checksum"))
        return reduce(DataFrame.unionByName, parts)
    return in_store(t, STORED, work)


STORED_TABLES = " union all ".join(
    f"""select '{n}' as "table", {', '.join(content(c, "cast('0x' || {} as bigint)"))} from {_source(n)}""" for n, c in STORED.items())

EXPORTED = {n: CONTENTS[n] for n in EXPORT_TABLES}


def exported_tables(t: DriverTables):
    """All tables that may leave, written as CSV with quoted line breaks, read back by name and compared by content."""
    done = exports.export_tables({n: t[n] for n in [*EXPORTED, "fetch_log"]}, _fresh(t, "export"))
    reader = t.spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    parts = [reader.csv(path).selectExpr(*content(EXPORTED[n], "cast(conv({}, 16, 10) as bigint)")).select(F.lit(n).alias("table"), "rows", "checksum")
             for n, path in done.items()]
    return reduce(DataFrame.unionByName, parts)


EXPORTED_TABLES = " union all ".join(
    f"""select '{n}' as "table", {', '.join(content(c, "cast('0x' || {} as bigint)"))} from {n}""" for n, c in EXPORTED.items())


def exported_result(t: DriverTables):
    """A report written as CSV and read back in its own types."""
    result = reports.run_report("subscriber-growth", t, EVENTS_AS_OF)
    path = exports.export_csv(result, _fresh(t, "result"))
    return t.spark.read.schema(result.schema).option("header", True).csv(path)


def landed_options(t: DriverTables):
    """The channel list written as JSON lines, read with its options and resolved."""
    path = _fresh(t, "options")
    t["customer"].select(F.to_json(F.struct(
        F.col("c_name").alias("identifier"),
        F.when(F.col("c_nationkey") < 5, F.col("c_nationkey")).alias("max_replies_per_comment"),
        F.when(F.col("c_acctbal") < 0, F.lit("playlist")).alias("video_discovery_mode"),
        F.when(F.col("c_acctbal") > 9000, F.col("c_custkey")).alias("max_videos"))).alias("value")).write.text(path)
    listed = landing.read_channel_options(t.spark, path, {
        "max_replies_per_comment": "int", "video_discovery_mode": "string", "max_videos": "bigint"})
    return usage.resolve_options(listed.select("identifier"), listed, {"max_comment_videos": 50}, {"fetch_comments": False})


def landed_items(t: DriverTables):
    """Raw items and broken lines landed together; the broken ones are kept as text."""
    path = _fresh(t, "landing")
    good = t.sql(shaping_queries.CHANNEL_JSON).select(F.col("json").alias("value"))
    bad = t["supplier"].select(F.concat(F.lit("{broken "), "s_name").alias("value"))
    good.unionByName(bad).write.text(path)
    landed = landing.read_landing(t.spark, path, "channel")
    return landing.readable(landed).select(
        F.col("item.id").alias("id"), F.col("item.snippet.title").alias("title"), F.lit(None).cast("string").alias("line")
    ).unionByName(landing.corrupt(landed).select(
        F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("title"), F.col(landing.CORRUPT).alias("line")))


LANDED_ITEMS = """
    select cast(c_custkey as varchar) as id, c_name as title, cast(null as varchar) as line from customer
    union all select null, null, concat('{broken ', s_name) from supplier"""

QUERIES = {
    "io1_load_tables": (load_tables, LOAD_TABLES),
    "io2_stored_tables": (stored_tables, STORED_TABLES),
    "io3_exported_tables": (exported_tables, EXPORTED_TABLES),
    "io4_exported_result": (exported_result, report_queries.SUBSCRIBER_GROWTH),
    "io5_channel_options": (landed_options, shaping_queries.CHANNEL_OPTIONS),
    "io6_landed_items": (landed_items, LANDED_ITEMS),
}
