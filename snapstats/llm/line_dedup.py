"""Line dedup by site-relative frequency, in DataFrame functions only.

Per host, the pages that contain a line are divided by all pages of the host; lines above the boilerplate
share are dropped from every page of that host. Pages are counted once per line however often they repeat it.
Lines travel as 128-bit hashes and are summed before the shuffle; what is left of them after the cut is
bounded per host by (lines of a page) / share, so one short list per host is joined back to the pages.

Edge cases: a NULL or empty text has no lines and stays as it is; a NULL host is no site, its pages are
unchanged; lines without a word are layout and are never counted or dropped; repeated rows are separate pages;
a page all of whose lines go keeps an empty text; columns named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import hinted, stored

# A line on more than this share of a host's pages is boilerplate; it must repeat, so that a site of one page keeps its text.
BOILERPLATE_PERCENT = 5
MIN_PAGES = 2
HAS_WORD = r"[^\x20\x09-\x0D]"


def _worded(lines: Column) -> Column:
    return F.filter(lines, lambda line: line.rlike(HAS_WORD))


def _line_id(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", percent: int = BOILERPLATE_PERCENT,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(_host, _boiler): the ids of the boilerplate lines of each host that has any."""
    pages = docs.select(F.col(host).alias("_host"), F.col(text).alias("_text")).where(F.col("_host").isNotNull())
    totals = pages.groupBy("_host").agg(F.count(F.lit(1)).alias("_pages"))
    lines = pages.select("_host", F.explode(F.array_distinct(_worded(F.split("_text", "\n")))).alias("_line"))
    counts = (lines.groupBy("_host", F.xxhash64("_line").alias("_a"), F.xxhash64(F.lit(1), F.col("_line")).alias("_b"))
              .agg(F.count(F.lit(1)).alias("_on")).where(F.col("_on") >= min_pages))
    return (counts.join(totals, "_host").where(F.col("_on") * 100 > F.col("_pages") * percent)
            .groupBy("_host").agg(F.collect_list(F.struct(F.col("_a").alias("a"), F.col("_b").alias("b"))).alias("_boiler")))


def line_dedup(docs: DataFrame, host: str = "source", text: str = "text", percent: int = BOILERPLATE_PERCENT,
               min_pages: int = MIN_PAGES) -> DataFrame:
    """`docs` with boilerplate lines cut from `text`, and n_lines, n_dropped (bigint)."""
    # Stored, so that its size is known: few lines are boilerplate, and then the texts need no shuffle by host.
    found = stored(boilerplate(docs, host, text, percent, min_pages), "boilerplate")
    size = found.agg(F.coalesce(F.sum(F.size("_boiler") + 1), F.lit(0))).first()[0]
    lines = F.split(F.col("_text"), "\n")
    kept = F.filter(lines, lambda line: ~(line.rlike(HAS_WORD) & F.array_contains(F.col("_boiler"), _line_id(line))))
    made = (
        docs.select(F.struct("*").alias("_row"), F.col(host).alias("_site"), F.col(text).alias("_text"))
        .join(hinted(found, size), F.col("_site") == F.col("_host"), "left")
        .withColumn("_kept", F.when(F.col("_boiler").isNotNull(), kept)))
    others = [F.col("_row")[c].alias(c) for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    return made.select(
        *others, F.coalesce(F.array_join("_kept", "\n"), F.col("_text")).alias(text),
        F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(lines) - F.size("_kept"), F.lit(0)).cast("bigint").alias("n_dropped"))


def oracle(percent: int = BOILERPLATE_PERCENT, min_pages: int = MIN_PAGES) -> str:
    """SQL for the digest of `documents` by source."""
    return f"""
    with pages as (select doc_id, source, text, row_number() over () as page from documents),
    lines as (
        select page, source, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as ix
        from pages where text is not null),
    shares as (
        select source, line, count(distinct page) as pages_with from lines
        where source is not null and regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by source, line),
    sites as (select source, count(*) as pages_all from pages group by source),
    boiler as (
        select source, line from shares join sites using (source)
        where pages_with >= {min_pages} and pages_with * 100 > pages_all * {percent}),
    marked as (
        select l.page, l.ix, l.line, b.line is not null as gone
        from lines l left join boiler b on l.source = b.source and l.line = b.line),
    summed as (
        select page, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
               coalesce(string_agg(line, chr(10) order by ix) filter (where not gone), '') as cleaned
        from marked group by page)
    select doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_dropped, 0) as n_dropped,
           case when text is not null then sha256(cleaned) end as text_sha256
    from pages left join summed using (page)"""


def op1_line_dedup(docs: DataFrame) -> DataFrame:
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
