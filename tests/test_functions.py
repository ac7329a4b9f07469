"""Column expressions on hand-made edge values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapstats.functions import numeric, text, timeutil
from snapstats.operators import shaping


def evaluate(spark, values, ddl, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_at_least_keeps_null(spark):
    assert evaluate(spark, [None, 0, 5], "bigint", lambda c: numeric.at_least(c, 1)) == [None, 1, 5]


def test_percent_is_floating_and_rounds_half_away(spark):
    df = spark.createDataFrame([(1, 8), (0, 0), (3, None)], "a bigint, b bigint")
    assert [r[0] for r in df.select(numeric.percent(F.col("a"), F.col("b"), 1)).collect()] == [12.5, 0.0, None]
    assert dict(df.select(numeric.percent(F.col("a"), F.col("b"), 1).alias("p")).dtypes)["p"] == "double"


def test_counts_as_delivered(spark):
    values = ["12", "12.5", "", " 12 ", None, "many", "-3", "99999999999999999999"]
    assert evaluate(spark, values, "string", numeric.count_or_zero) == [12, 0, 0, 12, 0, 0, -3, 0]


def test_durations(spark):
    values = ["PT1H2M3S", "PT", "P1DT2H", "", None, "PTx", "PT45S", "PT2Hrest", "xPT1H"]
    assert evaluate(spark, values, "string", text.iso_duration_seconds) == [
        3723, 0, None, None, None, 0, 45, 7200, None]


@pytest.mark.parametrize("line, expected", [
    ("0:00 Intro", ("Intro", 0)),
    ("  • 1:02:03 - The end  ", ("The end", 3723)),
    ("* 12:34:  Title | with bar", ("Title | with bar", 754)),
    ("0:00:00", ("00", 0)),
    (" 1:05 Hard blanks　", ("Hard blanks", 65)),
    ("see 1:00 here", None),
    ("1:5 short", None),
    ("1:05", None),
])
def test_chapter_lines(spark, line, expected):
    marks = evaluate(spark, [line], "string", text.chapter_marks)[0]
    assert [tuple(m) for m in marks] == ([expected] if expected else [])
    assert evaluate(spark, [line], "string", text.has_chapter_line) == [expected is not None]


def test_chapter_ends(spark, rows):
    df = spark.createDataFrame([
        (1, "5:00 late\nnoise\n1:00 early\n", 600), (2, "0:00 only", None), (3, "0:00 zero", 0), (4, "nothing", 60),
        (5, None, 60)], "video_id int, description string, duration_seconds bigint")
    assert rows(shaping.chapter_rows(df)) == [
        (1, 0, "late", 300, 60), (1, 1, "early", 60, 600), (2, 0, "only", 0, None), (3, 0, "zero", 0, None)]


def test_timestamps_are_utc(spark):
    values = ["2026-01-01T03:00:00Z", "2026-01-01T03:00:00+02:00", "2026-01-01T03:00:00", "soon", "", None]
    assert evaluate(spark, values, "string", lambda c: F.date_format(timeutil.parse_timestamp(c), "HH:mm")) == [
        "03:00", "01:00", "03:00", None, None, None]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("as_of", ["2026-01-08 12:00:00", dt.datetime(2026, 1, 8, 12), "2026-01-08T14:00:00+02:00",
                                   dt.datetime(2026, 1, 8, 14, tzinfo=dt.timezone(dt.timedelta(hours=2)))])
def test_cutoff_is_exact(spark, kind, as_of):
    df = spark.sql(f"""select cast(v as {kind}) as t from values
        ('2026-01-01 03:00:00'), ('2026-01-01 12:00:00'), ('2026-01-01 11:59:59') as x(v)""")
    kept = df.filter(timeutil.since(df, "t", as_of, 7)).select(F.date_format("t", "HH:mm:ss")).collect()
    assert [r[0] for r in kept] == ["12:00:00"]


def test_identifiers(spark, rows):
    given = ["UC" + "a" * 22, " @Name ", "https://www.youtube.com/@na.me-1/videos",
             "https://youtube.com/channel/UC" + "b" * 22 + "?x", "https://youtube.com/channel/other", "bare", "@", ""]
    df = spark.createDataFrame([(v,) for v in given], "identifier string")
    found = {r["identifier"]: (r["kind"], r["value"]) for r in shaping.parse_identifiers(df).collect()}
    assert [found[v] for v in given] == [
        ("id", "UC" + "a" * 22), ("handle", "Name"), ("handle", "na.me-1"), ("id", "UC" + "b" * 22),
        (None, None), ("handle", "bare"), (None, None), (None, None)]


def test_labels_match_binary_formatting(spark):
    values = [999, 1000, 1500, 2500, 34_499, 999_499, 1_250_000, 1_350_000, 12_345_678, 2_450_000, 1_150_000, 1_750_000, 9_950_000,
              *range(1_050_000, 40_000_000, 100_000), 123_456_789_050_000, 999_950_000]
    expected = [str(v) if v < 1000 else f"{v / 1e6:.1f}M" if v >= 1_000_000 else f"{v / 1e3:.0f}k" for v in values]
    assert evaluate(spark, values, "bigint", text.count_label) == expected


def test_json_lists(spark):
    assert evaluate(spark, ['["a","b"]', "[]", "", None, "broken"], "string", text.json_to_list) == [
        ["a", "b"], [], [], [], []]
    assert evaluate(spark, [["a"], [], None], "array<string>", text.list_to_json) == ['["a"]', "[]", "[]"]
    assert evaluate(spark, ['{"a": 1}', "", None], "string", text.json_to_map) == [{"a": 1}, {}, {}]


def test_chapter_lines_against_plain_lines(spark):
    import random
    import re
    rng = random.Random(5)
    bits = ["0:00", "12:34", "1:02:03", "5", ":", "-", "•", "*", " ", "\t", "\r", "\x85", " ", "　", "\n", "\n", "x", "title|", "é", "--", " - "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + [None, "", "0:00" + " " * 50_000, "0:00 -" + " " * 50_000 + "\n1:00 -- -"]
    white = text.WHITE_SPACE
    line_form = re.compile(rf"[{white}•\-*]*([0-9]{{1,2}}:)?([0-9]{{1,2}}):([0-9]{{2}})[{white}\-:]+(.+?)\Z", re.S)

    def plain(value):
        found = [m for line in value.split("\n") if len(line) < 100 or line.strip(white) == "0:00 -" for m in [line_form.match(line.strip(white))] if m]
        return [(m[4], int((m[1] or "0:")[:-1]) * 3600 + int(m[2]) * 60 + int(m[3])) for m in found]
    got = evaluate(spark, texts, "string", text.chapter_marks)
    for value, marks in zip(texts, got):
        assert ([tuple(m) for m in marks] if marks else []) == (plain(value) if value else []), repr(value)
    flags = evaluate(spark, texts, "string", text.has_chapter_line)
    assert [bool(f) for f in flags] == [bool(m) for m in got]
