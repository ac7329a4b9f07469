"""Quality classifier: naive Bayes log-count ratios as feature scales, a hinge-loss linear model on top.

Features of a text are indicators of its hashed n-grams: words, word pairs, byte triples, and runs of one
word (which share a feature by length). Class counts
come from all labelled training rows, summed per task and then by bucket, so they are bounded by BUCKETS rows. The linear model is
fitted by dual coordinate descent on a sample of at most SAMPLE_ROWS labelled rows (the smallest id hashes), a part of which fits
the margin's scale to probabilities. Every text is scored in one pass with the BUCKETS weights.

Only the text enters a score. Edge cases: NULL and empty texts have no features and get the model's prior; labels that are NULL, or whose id
is NULL, teach nothing; of labels that repeat an id the largest counts; without labels every score is 0.5; rows with a NULL id are
scored and not held out; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstats.llm import scan
from snapstats.llm.common import hinted, ship, stored, text_pieces

BUCKETS = 1 << 16
SAMPLE_ROWS = 8_000
SMOOTHING = 1.0
# Share of the fitted weights; the rest is their mean size, as the sum of scaled log ratios.
INTERPOLATION = 0.25
COST = 1.0
EPOCHS = 20
FOLDS = 5
PREDICT_AT = 0.3
RUNS = (3, 4, 6, 8, 12)
_DOCS_AT_ONCE = 256


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For some texts at a time: number of the first, text (from it) and bucket of every indicator that is set."""
    words = scan.Words(data, offsets)
    pair, pairs = words.windows(2)
    same = words.hash[pair] == words.hash[pair + 1] if len(pair) else np.zeros(0, bool)
    pairs = np.where(same, np.uint64(0x5A5A), pairs)
    triple = np.arange(max(0, len(data) - 2))
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    triple = triple[owner[triple] == owner[triple + 2]]
    codes = data[triple].astype(np.uint64) | data[triple + 1].astype(np.uint64) << np.uint64(8) | data[triple + 2].astype(np.uint64) << np.uint64(16)
    groups = [(words.doc, words.hash, 1), (words.doc[pair], pairs, 2), (owner[triple], codes, 3)]
    # Longer word n-grams are too rare to learn from, except those of one word over and over, which share a feature by length.
    for size in RUNS:
        at, _ = words.windows(size)
        equal = np.append(0, np.cumsum(words.hash[1:] == words.hash[:-1]))
        at = at[equal[at + size - 1] - equal[at] == size - 1] if len(at) else at
        groups.append((words.doc[at], np.full(len(at), size, np.uint64), 4))
    made = [(doc, (scan.mix(h + np.uint64(kind * 0x632BE59BD9B4E019 % 2**64)) & np.uint64(BUCKETS - 1)).astype(np.int64)) for doc, h, kind in groups]
    for first in range(0, len(offsets) - 1, _DOCS_AT_ONCE):
        count = min(_DOCS_AT_ONCE, len(offsets) - 1 - first)
        flags = np.zeros(count * BUCKETS, bool)
        for doc, bucket in made:
            a, b = np.searchsorted(doc, [first, first + count])
            flags[(doc[a:b] - first) * BUCKETS + bucket[a:b]] = True
        at = np.flatnonzero(flags)
        yield first, at // BUCKETS, at % BUCKETS


def dual_coordinate_descent(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, cost: float = COST,
                            epochs: int = EPOCHS, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and bias of min |w|^2 / 2 + cost * sum of hinge losses, rows being the set features with values `scale`."""
    w, bias = np.zeros(len(scale)), 0.0
    y = np.where(labels > 0, 1.0, -1.0)
    norms = np.array([(scale[r] ** 2).sum() + 1.0 for r in rows])
    alpha = np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            r = rows[i]
            gradient = y[i] * (w[r] @ scale[r] + bias) - 1.0
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                worst = max(worst, abs(step) * norms[i])
                w[r] += step * scale[r]
                bias += step
                alpha[i] = new
        if worst < 1e-3:
            break
    return w, bias


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the margins, with smoothed targets; the slope is never negative."""
    good = int((labels > 0).sum())
    bad = len(labels) - good
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -35, 35)))
        g = np.array([((p - target) * margins).sum() + 1e-3 * (a - 1), (p - target).sum()])
        s = p * (1 - p)
        h = np.array([[(s * margins * margins).sum() + 1e-3, (s * margins).sum()], [(s * margins).sum(), s.sum() + 1e-9]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = max(a - step[0], 1e-3), b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return a, b


class Model:
    def __init__(self, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.weights, self.bias, self.slope, self.offset = weights, bias, slope, offset

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.full(len(offsets) - 1, self.bias)
        for first, doc, bucket in features(data, offsets):
            count = min(_DOCS_AT_ONCE, len(out) - first)
            out[first:first + count] += np.bincount(doc, self.weights[bucket], count)
        return out

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(data, offsets) + self.offset, -35, 35)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each class that set a bucket, over one task; bucket -1 counts the texts."""
    counts, texts = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
    for rows, data, offsets in text_pieces(batches, "_text"):
        label = rows.column("_label").to_numpy(zero_copy_only=False).astype(np.int64)
        texts += np.bincount(label, minlength=2)
        for first, doc, bucket in features(data, offsets):
            for k in (0, 1):
                counts[k] += np.bincount(bucket[label[first + doc] == k], minlength=BUCKETS)
    at = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(-1, at), pa.int64()), pa.array(np.append(texts[0], counts[0, at]), pa.int64()), pa.array(np.append(texts[1], counts[1, at]), pa.int64())],
        ["bucket", "bad", "good"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_pieces(batches, "_text"):
        for first, doc, bucket in features(data, offsets):
            count = min(_DOCS_AT_ONCE, rows.num_rows - first)
            ends = np.searchsorted(doc, np.arange(count + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows.column("_mark").slice(first, count), rows.column("_label").slice(first, count),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(bucket.astype(np.int32)))], ["mark", "label", "set"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label_id: str = "doc_id",
          label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model from the rows of `docs` that have a label, all of them for the counts and a bounded sample for the weights."""
    known = stored(labels.select(F.col(label_id).alias("_lid"), F.col(label).cast("int").alias("_label"))
                   .where(F.col("_lid").isNotNull() & F.col("_label").isin(0, 1)).groupBy("_lid").agg(F.max("_label").alias("_label")), "labels")
    body = ship(docs).select(F.col(id_col).alias("_lid"), F.col(text).alias("_text"))
    counted = (body.join(hinted(known), "_lid").select("_label", "_text").mapInArrow(_count, "bucket bigint, bad bigint, good bigint")
               .groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toArrow())
    bucket = counted.column("bucket").to_numpy()
    counts = np.full((2, BUCKETS), SMOOTHING)
    for k, name in enumerate(("bad", "good")):
        values = counted.column(name).to_numpy()
        counts[k, bucket[bucket >= 0]] += values[bucket >= 0]
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())

    mark = F.xxhash64("_lid")
    sample = known.orderBy(mark, "_lid").limit(sample_rows)
    # Repeated ids could bring more rows than the sample has labels; the same bound holds for them.
    picked = (body.join(F.broadcast(sample), "_lid").withColumn("_mark", mark).select("_mark", "_label", "_text")
              .mapInArrow(_rows, "mark bigint, label int, set array<int>").orderBy("mark").limit(sample_rows).toArrow())
    sets = [s.values.to_numpy() for s in picked.column("set")]
    y, marks = picked.column("label").to_numpy(), picked.column("mark").to_numpy()
    if not len(y):
        return Model(np.zeros(BUCKETS), 0.0, 1.0, 0.0)
    fit = np.ones(len(y), bool) if len(y) < 20 else marks % 4 != 0
    w, bias = dual_coordinate_descent([s for s, f in zip(sets, fit) if f], y[fit], ratios)
    weights = ((1 - INTERPOLATION) * np.abs(w).mean() + INTERPOLATION * w) * ratios
    margins = np.array([weights[s].sum() + bias for s in sets])
    rest = ~fit if not fit.all() else fit
    slope, offset = calibrate(margins[rest], y[rest])
    return Model(weights, bias, slope, offset)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score): one row per row of `docs`."""
    share = ship(docs).sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches, "_text"):
            yield pa.RecordBatch.from_arrays([rows.column("_doc"), pa.array(share.value.scores(data, offsets))], ["_doc", "score"])
    return (docs.select(F.col(id_col).cast("bigint").alias("_doc"), F.col(text).alias("_text")).mapInArrow(run, "_doc bigint, score double")
            .select(F.col("_doc").alias(id_col), "score"))


def op10_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))
