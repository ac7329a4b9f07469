"""Toxicity classifier: a linear model over character n-grams whose values are naive Bayes log-count ratios.

Features are indicators of hashed n-grams of SIZES characters (code points) in the lower-cased text, white space counting as one blank, so
an n-gram sees where words begin and end and insults are met in any inflection or spelling that shares their letters. The class
counts of every bucket come from all labelled training rows, added up per task and then per bucket (at most BUCKETS rows reach the driver).
The linear model is fitted to the scaled indicators on at most SAMPLE_ROWS labelled rows, half of them toxic if there are as many; a quarter of
those fits the curve from margins to probabilities, set back to the share of toxic rows among all labels. Scoring is one pass over the texts.

Only the text enters a score. Edge cases: NULL and empty texts have no n-grams and get the model's prior, texts of one or two characters likewise;
very long texts are one piece of array work, about 100 bytes a byte; labels that are NULL or whose id is NULL teach nothing; of labels that
repeat an id the largest counts; without labels, or with one class only, every score is the smoothed share of toxic labels; rows with a
NULL id are scored and not held out; repeated rows and texts are scored alike; empty tables give no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm import scan
from snapstats.llm.common import hinted, ship, stored, text_pieces
from snapstats.llm.nbsvm import calibrate, dual_coordinate_descent, held_out

SIZES = (3, 4, 5, 6)
BUCKETS = 1 << 18
SAMPLE_ROWS = 5_000
SMOOTHING = 1.0
COST = 0.1
PREDICT_AT = 0.5
_DOCS_AT_ONCE = 64


@lru_cache(1)
def _folded() -> np.ndarray:
    """What each code point counts as: one lower-case character, or a blank."""
    table = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for c in range(0x10000):
        if 0xD800 <= c < 0xE000:
            continue
        low = chr(c).lower()
        if low.isspace():
            table[c] = 0x20
        elif len(low) == 1:
            table[c] = ord(low)
    return table


def ngrams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For some texts at a time: number of the first, text (from it) and bucket of every n-gram that occurs, each once."""
    for first in range(0, len(offsets) - 1, _DOCS_AT_ONCE):
        ends = offsets[first:first + _DOCS_AT_ONCE + 1]
        part = data[ends[0]:ends[-1]]
        count = len(ends) - 1
        points = np.frombuffer(part.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        if len(points) == len(part):
            borders = ends - ends[0]
        else:
            borders = np.searchsorted(np.flatnonzero((part & 0xC0) != 0x80), ends - ends[0])
        values = scan.mix(_folded()[points].astype(np.uint64) + np.uint64(0x2545F491))
        owner = np.repeat(np.arange(count, dtype=np.int64) * BUCKETS, np.diff(borders))
        flags = np.zeros(count * BUCKETS, bool)
        code = values
        for size in range(2, max(SIZES) + 1):
            if len(points) < size:
                break
            code = code[:-1] * np.uint64(0x9E3779B97F4A7C15) + values[size - 1:]
            code ^= code >> np.uint64(32)
            if size in SIZES:
                whole = owner[:-size + 1] == owner[size - 1:]
                bucket = (code * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
                flags[(owner[:-size + 1] + bucket)[whole]] = True
        at = np.flatnonzero(flags)
        yield first, at // BUCKETS, at % BUCKETS


class Model:
    """Weights by bucket, bias, and the logistic curve through the margins."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.weights, self.bias, self.slope, self.offset = weights, bias, slope, offset

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        margins = np.full(len(offsets) - 1, self.bias)
        for first, doc, bucket in ngrams(data, offsets):
            count = min(_DOCS_AT_ONCE, len(margins) - first)
            margins[first:first + count] += np.bincount(doc, self.weights[bucket], count)
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -35, 35)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each class that hold a bucket's n-grams, over one task."""
    counts = np.zeros((2, BUCKETS), np.int64)
    for rows, data, offsets in text_pieces(batches, "_text"):
        label = rows.column("_label").to_numpy(zero_copy_only=False).astype(np.int64)
        for first, doc, bucket in ngrams(data, offsets):
            toxic = label[first + doc] == 1
            counts[1] += np.bincount(bucket[toxic], minlength=BUCKETS)
            counts[0] += np.bincount(bucket[~toxic], minlength=BUCKETS)
    at = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[0, at]), pa.array(counts[1, at])], ["bucket", "clean", "toxic"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_pieces(batches, "_text"):
        for first, doc, bucket in ngrams(data, offsets):
            count = min(_DOCS_AT_ONCE, rows.num_rows - first)
            ends = np.searchsorted(doc, np.arange(count + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows.column("_mark").slice(first, count), rows.column("_label").slice(first, count),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(bucket.astype(np.int32)))], ["mark", "label", "set"])


def log_ratios(clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Log of each bucket's smoothed share of the toxic counts over that of the clean counts."""
    clean, toxic = clean + SMOOTHING, toxic + SMOOTHING
    return np.log(toxic / toxic.sum()) - np.log(clean / clean.sum())


def fit(sets: list[np.ndarray], labels: np.ndarray, marks: np.ndarray, ratios: np.ndarray, share: float) -> Model:
    """Model from the sample's sets of buckets; `share` is the part of toxic rows among all labels."""
    if not (labels == 1).any() or not (labels == 0).any():
        return Model(np.zeros(BUCKETS), 0.0, 0.0, float(np.log(share / (1 - share))))
    fitted = marks % 4 != 0
    if min((labels[fitted] == k).sum() for k in (0, 1)) == 0 or min((labels[~fitted] == k).sum() for k in (0, 1)) < 5:
        fitted[:] = True
    w, bias = dual_coordinate_descent([s for s, f in zip(sets, fitted) if f], labels[fitted], ratios, cost=COST)
    weights = w * ratios
    rest = ~fitted if not fitted.all() else fitted
    margins = np.array([weights[s].sum() + bias for s, r in zip(sets, rest) if r])
    slope, offset = calibrate(margins, labels[rest])
    sampled = labels[rest].mean()
    return Model(weights, bias, slope, offset + float(np.log(share / (1 - share)) - np.log(sampled / (1 - sampled))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label_id: str = "doc_id",
          label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model from the rows of `docs` that have a label: all of them for the ratios, a bounded sample for the weights."""
    known = stored(labels.select(F.col(label_id).alias("_lid"), F.col(label).cast("int").alias("_label"))
                   .where(F.col("_lid").isNotNull() & F.col("_label").isin(0, 1)).groupBy("_lid").agg(F.max("_label").alias("_label")), "labels")
    totals = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    share = (totals.get(1, 0) + SMOOTHING) / (sum(totals.values()) + 2 * SMOOTHING)
    body = ship(docs).select(F.col(id_col).alias("_lid"), F.col(text).alias("_text"))
    counted = (body.join(hinted(known, sum(totals.values())), "_lid").select("_label", "_text").mapInArrow(_count, "bucket bigint, clean bigint, toxic bigint")
               .groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow())
    counts = np.zeros((2, BUCKETS))
    for k, name in enumerate(("clean", "toxic")):
        counts[k, counted.column("bucket").to_numpy()] = counted.column(name).to_numpy()
    ratios = log_ratios(*counts)

    mark = F.xxhash64("_lid", F.lit(13))
    of = lambda k: known.where(F.col("_label") == k).orderBy(mark, "_lid")
    toxic_rows = min(totals.get(1, 0), sample_rows // 2)
    sample = of(1).limit(toxic_rows).unionAll(of(0).limit(sample_rows - toxic_rows))
    # Repeated ids could bring more rows than the sample has labels; the same bound holds for them.
    picked = (body.join(F.broadcast(sample), "_lid").withColumn("_mark", mark).select("_mark", "_label", "_text")
              .mapInArrow(_sets, "mark bigint, label int, set array<int>").orderBy("mark").limit(sample_rows).toArrow())
    sets = [values.values.to_numpy() for values in picked.column("set")]
    return fit(sets, picked.column("label").to_numpy(), picked.column("mark").to_numpy().copy(), ratios, share)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score): one row per row of `docs`."""
    shared = ship(docs).sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches, "_text"):
            yield pa.RecordBatch.from_arrays([rows.column("_doc"), pa.array(shared.value.scores(data, offsets))], ["_doc", "score"])
    return (docs.select(F.col(id_col).cast("bigint").alias("_doc"), F.col(text).alias("_text")).mapInArrow(run, "_doc bigint, score double")
            .withColumnRenamed("_doc", id_col))


def op13_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))
