"""Quality rules: base counts, then a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Words and word pairs are hashed into BUCKETS; their counts in the trusted target and in the raw corpus give two
smoothed multinomials. A document's score is the mean over its n-grams of log(p_target / p_raw), so length drops
out, and every document with a score under the fixed threshold is rejected: the verdict of a document
depends on the counts alone, never on chance. Counts are summed before the shuffle into at most BUCKETS rows, a bound
that does not grow with the corpus, and reach the scoring pass as one array.

Edge cases: NULL and empty texts have no words, fail the base rules and are rejected with a NULL score; an empty
target (no trusted rows) leaves every ratio 0, so only the base rules decide; trusted rows are told by id, NULL
ids are never trusted; repeated rows count as often as they stand there; columns of `docs` other than id and text
are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import WORD_SPLIT, hinted, row_key, stored

BUCKETS = 1 << 16
SMOOTHING = 1.0
# Mean log ratio under which a document is rejected.
THRESHOLD = -0.25
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_SPLIT), "")


def _buckets(hashes: Column) -> Column:
    """Bucket of every word and of every pair of neighbours."""
    at = F.sequence(F.lit(1), F.size(hashes) - 1)
    pairs = F.when(F.size(hashes) > 1, F.transform(at, lambda i: F.pmod(F.xxhash64(F.get(hashes, i - 1), F.get(hashes, i)), F.lit(BUCKETS))))
    singles = F.transform(hashes, lambda h: F.pmod(h, F.lit(BUCKETS)))
    return F.concat(singles, F.coalesce(pairs, F.array().cast("array<bigint>"))).cast("array<int>")


def _hashed(text: str) -> Column:
    return F.transform(words(F.coalesce(F.col(text), F.lit(""))), lambda w: F.xxhash64(w))


def bucket_counts(docs: DataFrame, text: str, name: str) -> DataFrame:
    """(bucket, `name`): n-grams of all documents by bucket."""
    hashed = docs.select(_hashed(text).alias("_h"))
    return (hashed.select(F.explode(_buckets(F.col("_h"))).alias("bucket"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias(name)))


def log_ratios(raw: DataFrame, target: DataFrame) -> DataFrame:
    """One row: `ratios`, the array of log(p_target / p_raw) by bucket."""
    spark = raw.sparkSession
    buckets = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    table = (buckets.join(raw, "bucket", "left").join(target, "bucket", "left")
             .select("bucket", *(F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in ("raw", "target"))))
    rows = table.agg(F.sum("raw").alias("r"), F.sum("target").alias("t"),
                     F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("b"))
    ratio = lambda x: F.log((x["target"] + SMOOTHING) / (F.col("t") + SMOOTHING * BUCKETS)) - F.log(
        (x["raw"] + SMOOTHING) / (F.col("r") + SMOOTHING * BUCKETS))
    return rows.select(F.when(F.col("t") > 0, F.transform("b", ratio)).otherwise(F.array_repeat(F.lit(0.0), BUCKETS)).alias("ratios"))


VERDICTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def _judged(docs: DataFrame, trusted_ids: DataFrame, id_col: str, text: str, threshold: float) -> DataFrame:
    """Every row of `docs` as `_row`, its id as `_id`, and its VERDICTS."""
    key = trusted_ids.columns[0]
    trusted = trusted_ids.select(F.col(key).alias("_tid")).where(F.col("_tid").isNotNull()).distinct()
    body = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    target = body.join(hinted(trusted), F.col("_id") == F.col("_tid"), "left_semi")
    ratios = log_ratios(bucket_counts(body, "_text", "raw"), bucket_counts(target, "_text", "target"))

    full = F.coalesce(F.col("_text"), F.lit(""))
    lines = F.filter(F.split(full, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    h = F.col("_h")
    windows = F.when(F.size(h) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW)))))
    counted = (
        body.select(
            "_row", "_id", _hashed("_text").alias("_h"), lines.alias("_lines"),
            F.length(F.regexp_replace(full, WORD_SPLIT, "")).cast("bigint").alias("word_chars"),
            (F.length(full) - F.length(F.regexp_replace(full, SYMBOLS, ""))).cast("bigint").alias("n_symbols"))
        .select("*", windows.alias("_w"))
        .select("*", F.when(F.size(F.array_distinct("_w")) < F.size("_w"), F.sort_array(
            F.transform("_w", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("_sorted")))
    ordered = F.col("_sorted")
    repeated = lambda x, i: (
        F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)))
    counted = counted.select("*", F.sort_array(F.transform(F.filter(ordered, repeated), lambda x: x["i"])).alias("_starts"))
    starts = F.col("_starts")
    cover = F.aggregate(
        F.transform(starts, lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW)))),
        F.lit(0), lambda total, c: total + c)
    counted = counted.select(
        "_row", "_id", "_h", F.size("_h").cast("bigint").alias("n_words"), "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(cover, F.lit(0)).cast("bigint").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    table = ratios.scalar()
    buckets = F.col("_b")
    return (
        counted.select("*", failed.alias("base_failed"), _buckets(F.col("_h")).alias("_b"), table.alias("_r"))
        .select("*", (F.aggregate(buckets, F.lit(0.0), lambda total, b: total + F.get(F.col("_r"), b))
                      / F.nullif(F.size(buckets), F.lit(0))).alias("score"))
        .select("_row", "_id", *VERDICTS[:-1], (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept")))


def quality_rules(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: id and VERDICTS; `trusted_ids` holds the ids of the target documents in its first column."""
    return _judged(docs, trusted_ids, id_col, text, threshold).select(F.col("_id").alias(id_col), *VERDICTS)


def quality_filter(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that are kept, unchanged."""
    # Stored before it filters: a filter would be pushed below the columns it is made of, which would then be worked out
    # anew inside every lambda.
    judged = _judged(docs.select(id_col, text), trusted_ids, id_col, text, threshold)
    marks = stored(judged.select(*row_key(F.col("_row")[id_col], F.col("_row")[text]), "kept"), "verdicts")
    rejected = marks.where("not kept").select(F.col("_id").alias("_bad_id"), F.col("_th").alias("_bad_th")).distinct()
    return (docs.select(F.struct("*").alias("_row"), *row_key(F.col(id_col), F.col(text)))
            .join(hinted(rejected), (F.col("_id") == F.col("_bad_id")) & (F.col("_th") == F.col("_bad_th")), "left_anti").select("_row.*"))


def op3_quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return quality_rules(docs, labels.where("quality = 1").select("doc_id"))
