"""Substring dedup with fixed-block anchors.

Any WINDOW consecutive words of a text contain a whole block of BLOCK words of that text's fixed, non-overlapping grid
(WINDOW >= 2 * BLOCK - 1). So the grid blocks of all texts are indexed by hash, and every rolling window of BLOCK words of
every text probes the index. A repeat between two texts is hit in both of them: in each by the other's grid.
Hits are extended: all windows of WINDOW words around a hit are compared by their own hash across texts, and
consecutive repeated windows are the maximal repeats. The smallest id of each window decides which words go, so no pairs
of documents are formed and a passage shared by a third of the corpus is one row per task.

Most rolling windows hit nothing and are dropped where they are read, by a filter of bounded size (see bitmap.py); the
equi joins behind it are exact. Copies of a whole text are told by hash beforehand: only the first one is scanned.

Windows are judged on the input, by a hash of 61 bits for blocks (anchors, which only bring windows to the comparison) and one of 122 bits
for windows. Edge cases: NULL and empty texts have no words; very long texts are one piece of array work (see scan.py);
a row with a NULL id keeps its words and removes no other's; rows with equal ids never remove each other's words; the rest of
`docs` is ignored, whatever its names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm import scan
from snapstats.llm.bitmap import bitmap_of
from snapstats.llm.common import hinted, ship, stored, text_pieces

WINDOW = 50
KEY = ["_id", "_th"]


def _body(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    full = F.coalesce(F.col(text), F.lit(""))
    return ship(docs).select(F.col(id_col).cast("bigint").alias("_id"), full.alias("_text"), F.xxhash64(full).alias("_th"))


def _info(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_pieces(batches, "_text"):
        words = [data[a:b].tobytes().split() for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [rows.column("_id"), rows.column("_th"), rows.column("_t2"), pa.array([len(w) for w in words], pa.int64()),
             pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words])], ["_id", "_th", "_t2", "_n", "_sha"])


def _long(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of `docs`: id, n_words, n_removed, kept_sha256, kept (text of the kept words, NULL if none was removed)."""
    block = (window + 1) // 2
    body = _body(docs, id_col, text)
    info = stored(body.withColumn("_t2", F.xxhash64(F.lit(1), F.col("_text"))).mapInArrow(
        _info, "_id bigint, _th bigint, _t2 bigint, _n bigint, _sha string"), "info")
    able = info.where(F.col("_id").isNotNull() & (F.col("_n") >= window))
    # Stored, so that the join meets two plain shuffles, whose large partitions Spark splits.
    firsts = stored(able.groupBy("_th", "_t2").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows")).where("_rows > 1"), "copied")
    copies = stored(able.join(firsts, ["_th", "_t2"]).where("_id > _first").select(*KEY).distinct(), "copies")
    scanned = body.where(F.col("_id").isNotNull()).join(hinted(copies), KEY, "left_anti")

    def grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches, "_text"):
            words = scan.Words(data, offsets)
            at, hashes = words.windows(block)
            doc = words.doc[at]
            own = ((at - words.offsets[doc]) % block == 0) & (np.diff(words.offsets)[doc] >= window)
            yield pa.RecordBatch.from_arrays([_long(hashes[own]), rows.column("_id").take(pa.array(doc[own]))], ["h", "id"])

    blocks = (scanned.mapInArrow(grid, "h bigint, id bigint").groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi")))
    index = stored(blocks, "blocks")
    share = body.sparkSession.sparkContext.broadcast(bitmap_of(index, "h", index.count()))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches, "_text"):
            words = scan.Words(data, offsets)
            at, hashes = words.windows(block)
            doc = words.doc[at]
            # Grid windows are in the index already.
            at = ((at - words.offsets[doc]) % block != 0) & (np.diff(words.offsets)[doc] >= window)
            hashes, doc = hashes[at], doc[at]
            hit = share.value.hits(hashes)
            yield pa.RecordBatch.from_arrays([_long(hashes[hit]), rows.column("_id").take(pa.array(doc[hit]))], ["h", "id"])

    probes = (scanned.mapInArrow(probe, "h bigint, id bigint").groupBy("h").agg(F.min("id").alias("plo"), F.max("id").alias("phi")))
    anchors = stored(
        index.join(probes, "h", "left").where(F.least("lo", "plo") < F.greatest("hi", "phi")).select("h"), "anchors")
    live = body.sparkSession.sparkContext.broadcast(bitmap_of(anchors, "h", anchors.count()))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches, "_text"):
            words = scan.Words(data, offsets)
            at, hashes = words.windows(block)
            hits = np.zeros(len(words.start) + 1, np.int64)
            hits[at + 1] = live.value.hits(hashes)
            hits = np.cumsum(hits)
            at, hashes = words.windows(window)
            near = hits[at + window - block + 1] > hits[at]
            at, hashes = at[near], hashes[near]
            second = scan.spans_hash(scan.running(words.hash, lane=1), at, at + window, lane=1)
            doc = words.doc[at]
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [_long(hashes), _long(second), rows.column("_id").take(take), rows.column("_th").take(take),
                 pa.array((at - words.offsets[doc]).astype(np.int32))], ["w", "w2", "_id", "_th", "at"])

    windows = scanned.mapInArrow(extend, "w bigint, w2 bigint, _id bigint, _th bigint, at int")
    # Stored for the same reason.
    least = stored(windows.groupBy("w", "w2").agg(F.min("_id").alias("lo"), F.max("_id").alias("hi")).where("lo < hi").select("w", "w2", "lo"), "least")
    gone = stored(windows.join(least, ["w", "w2"]).where("_id > lo").groupBy(*KEY).agg(F.collect_set("at").alias("_at")), "gone")
    cut = body.join(hinted(gone.select(*KEY)), KEY, "left_semi").distinct().join(gone, KEY)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches, "_text"):
            kept, removed = [], []
            for d, starts in enumerate(rows.column("_at")):
                words = data[offsets[d]:offsets[d + 1]].tobytes().split()
                mask = scan.covered(np.array(starts.values, np.int64), window, len(words))
                kept.append(b" ".join(w for w, m in zip(words, mask.tolist()) if not m))
                removed.append(int(mask.sum()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("_id"), rows.column("_th"), pa.array(removed, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                 pa.array([k.decode() for k in kept])], ["_id", "_th", "_cut", "_csha", "_kept"])

    cut = cut.mapInArrow(apply, "_id bigint, _th bigint, _cut bigint, _csha string, _kept string")
    whole = copies.select(*KEY, F.lit(True).alias("_copy"))
    none = hashlib.sha256(b"").hexdigest()
    return (info.join(cut, KEY, "left").join(whole, KEY, "left").select(
        F.col("_id").alias(id_col), F.col("_n").alias("n_words"),
        F.when(F.col("_copy"), F.col("_n")).otherwise(F.coalesce("_cut", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(F.col("_copy"), F.lit(none)).otherwise(F.coalesce("_csha", "_sha")).alias("kept_sha256"),
        F.when(F.col("_copy"), F.lit("")).otherwise(F.col("_kept")).alias("kept")))


def op4_substring_dedup(docs: DataFrame) -> DataFrame:
    return substring_dedup(docs).drop("kept")
