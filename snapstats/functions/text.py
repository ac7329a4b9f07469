"""Text formats: durations, chapter lines, identifiers, labels, JSON lists."""

from __future__ import annotations

import string

from pyspark.sql import Column, functions as F

# Fixed formats. White space is listed: the regex flag for Unicode classes costs several times as much.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
DURATION = r"(?s)^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?.*$"
_IN_LINE = WHITE_SPACE.replace("\n", "")
# A line of the text, from the break before it to its last character that is no white space. Groups: hours, minutes, seconds, title, and
# the title of a line that ends in marks only. No part is tried twice over the same characters, so long lines cost linear time.
CHAPTER_LINE = (
    rf"(?:^|\n)[{_IN_LINE}•\-\*]*+([0-9]{{1,2}}:)?([0-9]{{1,2}}):([0-9]{{2}})"
    rf"(?:[{_IN_LINE}\-:]++([^{WHITE_SPACE}\-:](?:[^\n]*[^{WHITE_SPACE}])?)|[{_IN_LINE}\-:]+([\-:])(?=[{_IN_LINE}]*+(?:\n|\z)))"
)
CHANNEL_KEY_LENGTH = 24
CHANNEL_KEY_PREFIX = "UC"
SITE_HANDLE = r"(?U)youtube\.com/@([\w.-]+)"
SITE_CHANNEL = r"youtube\.com/channel/(UC[\w-]{22})"


def strip(value: Column) -> Column:
    """Drop surrounding white space of every kind, not only blanks."""
    return F.trim(value, F.lit(WHITE_SPACE))


def fold_case(value: Column) -> Column:
    """Lower case for A to Z only, the letters a `LIKE` comparison treats alike."""
    return F.translate(value, string.ascii_uppercase, string.ascii_lowercase)


def _number(text: Column) -> Column:
    # An unmatched group is ''. It must not reach the cast: a failing cast costs an exception per row.
    return F.coalesce(F.nullif(text, F.lit("")).try_cast("bigint"), F.lit(0))


def iso_duration_seconds(value: Column) -> Column:
    """`PT1H2M3S` to seconds. Matches a prefix; NULL unless the text starts with `PT`."""
    parts = F.split(F.regexp_replace(value, DURATION, "$1:$2:$3"), ":")
    seconds = F.aggregate(parts, F.lit(0).cast("bigint"), lambda total, part: total * 60 + _number(part))
    return F.when(value.startswith("PT"), seconds)


def chapter_lines(description: Column) -> Column:
    """The lines of a description that look like chapters, in order, found in one pass."""
    return F.when(description.contains(":"), F.regexp_extract_all(description, F.lit(CHAPTER_LINE), F.lit(0)))


def has_chapter_line(description: Column) -> Column:
    return description.contains(":") & description.rlike(CHAPTER_LINE)


def chapter_mark(line: Column) -> Column:
    """(title, start_seconds) of one of the lines."""
    # Its groups side by side, the title last because it may hold anything.
    g = F.split(F.regexp_replace(line, CHAPTER_LINE, "$1|$2|$3|$4$5"), r"\|", 4)
    hours = F.when(g[0] != "", F.rtrim(g[0], F.lit(":")).cast("bigint")).otherwise(F.lit(0))
    seconds = hours * 3600 + g[1].cast("bigint") * 60 + g[2].cast("bigint")
    return F.struct(g[3].alias("title"), seconds.alias("start_seconds"))


def chapter_marks(description: Column) -> Column:
    """Array of (title, start_seconds), one per chapter-like line, in the order of the lines; NULL without any place for one."""
    return F.transform(chapter_lines(description), chapter_mark)


def identifier_kind(identifier: Column) -> Column:
    """`id` when the text names a channel key, `handle` when a handle, NULL when it is neither."""
    text = strip(identifier)
    return (
        F.when(_is_key(text), "id")
        .when(text.startswith("@"), F.when(F.ltrim(text, F.lit("@")) != "", "handle"))
        .when(text.contains("youtube.com/@"), F.when(text.rlike(SITE_HANDLE), "handle"))
        .when(text.contains("youtube.com/channel/"), F.when(text.rlike(SITE_CHANNEL), "id"))
        .when(text != "", "handle")
    )


def identifier_value(identifier: Column) -> Column:
    """The key or handle inside a channel identifier, matching `identifier_kind`."""
    text = strip(identifier)
    value = (
        F.when(_is_key(text), text)
        .when(text.startswith("@"), F.ltrim(text, F.lit("@")))
        .when(text.contains("youtube.com/@"), F.regexp_extract(text, SITE_HANDLE, 1))
        .when(text.contains("youtube.com/channel/"), F.regexp_extract(text, SITE_CHANNEL, 1))
        .otherwise(text)
    )
    return F.nullif(value, F.lit(""))


def _is_key(text: Column) -> Column:
    return text.startswith(CHANNEL_KEY_PREFIX) & (F.length(text) == CHANNEL_KEY_LENGTH)


def count_label(count: Column) -> Column:
    """`1.2M`, `34k` or the plain number, rounded as the binary quotient is: what looks like a half in print may lie
    just above or below it, and true halves go to the even digit."""
    tenths, rest = F.floor(count / 100_000).cast("bigint"), count % 100_000
    quotient = count / 1_000_000
    # The fraction of the quotient in units of 2^-52 against the half it stands beside, both times 20.
    fraction = ((quotient - F.floor(quotient)) * F.lit(float(1 << 52))).cast("bigint") * 20
    half = F.floor((count % 1_000_000) / 50_000).cast("bigint") * (1 << 52)
    up = F.when(rest != 50_000, rest > 50_000).when(fraction != half, fraction > half).otherwise(tenths % 2 == 1)
    rounded = tenths + up.cast("bigint")
    return (
        F.when(count >= 1_000_000, F.format_string("%d.%dM", F.floor(rounded / 10), rounded % 10))
        .when(count >= 1_000, F.format_string("%.0fk", F.bround(count / 1_000, 0)))
        .otherwise(count.cast("string"))
    )


def list_to_json(items: Column) -> Column:
    """Array to JSON text; a missing list is stored as an empty one."""
    return F.coalesce(F.to_json(items), F.lit("[]"))


def json_to_list(text: Column, element_type: str = "string") -> Column:
    """JSON text to array; missing, empty or unreadable text gives an empty array."""
    return F.coalesce(F.from_json(text, f"array<{element_type}>"), F.array().cast(f"array<{element_type}>"))


def json_to_map(text: Column, value_type: str = "bigint") -> Column:
    return F.coalesce(
        F.from_json(text, f"map<string,{value_type}>"),
        F.create_map().cast(f"map<string,{value_type}>"),
    )
