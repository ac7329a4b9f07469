"""Exact dedup of repeated byte strings by a depth-limited, most-significant-digit-first radix sort of suffixes.

A suffix matters only through its first THRESHOLD bytes, its window; equal windows are exactly the repeated strings. Windows are
sorted by hashed digits, in passes that drop every group of one, until the depth is reached:
 1. The first digit is the window's minimiser: its smallest GRAM-byte gram (leftmost of equals). It is a function of the window alone,
    so equal windows agree on it and on its place, and neighbouring windows share it: one row stands for some 170 suffixes.
    (Taken left to right, the first digits of natural text keep nearly all suffixes alive.) Minimisers seen once are dropped.
 2. The second digit is all the bytes of the run of neighbouring windows that share a minimiser, their stretch. A stretch that occurs
    twice settles all its windows at once; a minimiser with a single stretch needs no further pass.
 3. Stretches still open are cut into strips of up to STRIP windows, at fixed places from the minimiser. The third digit of a strip is its core, the bytes
    all its windows share: a core seen once ends the strip, none of its windows repeats. A whole strip that occurs twice settles all of them.
 4. The last digit is the rest of the window up to the threshold, for one copy of every strip that differs from another of its core.
Each pass is an aggregation summed before the shuffle, so a string shared by a third of the corpus is one row per task. Whole copies
are told by hash beforehand and only one of them is sorted.

Edge cases: NULL and empty texts have no bytes; every row is a document, also with a repeated or NULL id, so repeated rows of THRESHOLD
bytes or more are removed entirely; shorter texts have no window; overlapping repeats count; the rest of `docs` is ignored,
whatever its names. Digits are hashes of 61 bits, the last digit and whole texts of 122 and 128. kept is binary: a cut may fall inside a character.
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
from snapstats.llm.common import hinted, packed, row_key, ship, stored, text_pieces, unpacked

THRESHOLD = 400
GRAM = 64
STRIP = 16
KEY = ["_id", "_th"]
_PLACE = np.uint64(0xFFFFFFFF)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


class Stretches:
    """Runs of windows that share a minimiser: gram hash, stretch hash, first and last window start (byte positions), text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, threshold: int, gram: int):
        lengths = np.maximum(np.diff(offsets) - threshold + 1, 0)
        at = scan.concat_ranges(offsets[:-1], lengths)
        sums = scan.byte_sums(data)
        if not len(at):
            self.gram = self.stretch = np.zeros(0, np.uint64)
            self.lo = self.hi = self.place = self.doc = np.zeros(0, np.int64)
            return
        n = len(data) - gram + 1
        ends = np.arange(gram, len(data) + 1)
        grams = scan.spans_hash(sums, ends - gram, ends)
        least = _sliding_min((grams & ~_PLACE) | np.arange(n, dtype=np.uint64), threshold - gram + 1)
        place = (least[at] & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        self.lo, self.hi = at[first], at[np.append(first[1:], len(at)) - 1]
        self.place = place = place[first]
        self.gram = grams[place]
        shape = ((place - self.lo).astype(np.uint64) << np.uint64(32)) | (self.hi - self.lo).astype(np.uint64)
        self.stretch = scan.mix(scan.spans_hash(sums, self.lo, self.hi + threshold) + scan.mix(shape + np.uint64(1)))
        self.doc = np.searchsorted(offsets, self.lo, "right") - 1


def _long(hashes: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(hashes).view(np.int64))


def _info(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_pieces(batches, "_text"):
        marks = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [rows.column(c) for c in ("_doc", "_id", "_th", "_t2")] + [pa.array(np.diff(offsets)), pa.array(marks)],
            ["_doc", "_id", "_th", "_t2", "_n", "_sha"])


def repeated_starts(scanned: DataFrame, threshold: int, gram: int, strip: int) -> DataFrame:
    """(_id, _th, spans): per text with repeats, intervals [first, last] of the starts of repeated windows."""
    spark = scanned.sparkSession

    def leading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in text_pieces(batches, "_text"):
            yield pa.RecordBatch.from_arrays([_long(Stretches(data, offsets, threshold, gram).gram)], ["a"])

    # Pass 1: minimisers seen at least twice.
    repeated = stored(scanned.mapInArrow(leading, "a bigint").groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a"), "digit1")
    share = spark.sparkContext.broadcast(bitmap_of(repeated, "a", repeated.count()))

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches, "_text"):
            s = Stretches(data, offsets, threshold, gram)
            hit = share.value.hits(s.gram)
            base, take = offsets[s.doc[hit]], pa.array(s.doc[hit])
            yield pa.RecordBatch.from_arrays(
                [_long(s.gram[hit]), _long(s.stretch[hit]), rows.column("_id").take(take), rows.column("_th").take(take),
                 *(pa.array((x[hit] - base).astype(np.int32)) for x in (s.lo, s.hi, s.place))], ["a", "c", *KEY, "lo", "hi", "place"])

    # Pass 2: stretches, and one holder of each.
    held = stored(scanned.mapInArrow(stretches, "a bigint, c bigint, _id bigint, _th bigint, lo int, hi int, place int"), "digit2")
    kinds = stored(held.groupBy("a", "c").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("_id")), "stretches")
    open_ = kinds.groupBy("a").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).where("c1 <> c2").select("a")
    still = kinds.join(open_, "a")
    # The first place of the stretch in the text of its smallest id.
    holder = (held.join(still.select("a", "c", "_id"), ["a", "c", "_id"])
              .groupBy("a", "c").agg(F.min(F.struct("_id", "_th", "lo", "hi", "place")).alias("h")).select("a", "c", "h.*"))
    jobs = stored(holder.groupBy(*KEY).agg(F.collect_list(F.struct("a", "c", "lo", "hi", "place")).alias("_jobs")), "open")

    def strips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(unpacked(batches), "_text"):
            sums = scan.byte_sums(data)
            jobs, doc = _flat(rows.column("_jobs"))
            lo, hi, place = (jobs[k] + offsets[doc] for k in ("lo", "hi", "place"))
            first = (place - hi) // strip
            count = (place - lo) // strip - first + 1
            job = np.repeat(np.arange(len(lo)), count)
            group = scan.concat_ranges(first, count)
            top = place[job] - group * strip
            a, b = np.maximum(lo[job], top - strip + 1), np.minimum(hi[job], top)
            gram_of = jobs["a"].view(np.uint64)[job] + group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            core = scan.mix(scan.spans_hash(sums, top, top - strip + 1 + threshold) + scan.mix(gram_of))
            shape = ((top - a).astype(np.uint64) << np.uint64(32)) | (top - b).astype(np.uint64)
            whole = scan.mix(scan.spans_hash(sums, a, b + threshold) + scan.mix(shape + np.uint64(1)))
            take = pa.array(doc[job])
            yield pa.RecordBatch.from_arrays(
                [_long(core), _long(whole), pa.array(jobs["c"][job]), rows.column("_id").take(take), rows.column("_th").take(take),
                 pa.array((a - offsets[doc[job]]).astype(np.int32)), pa.array((b - a + 1).astype(np.int32)), pa.array((a - lo[job]).astype(np.int32))],
                ["core", "whole", "c", *KEY, "at", "n", "off"])

    # Pass 3: strips by core, then whole.
    picked = packed(scanned).join(jobs, KEY).select(*KEY, "_z", "_jobs")
    cut = stored(picked.mapInArrow(strips, "core bigint, whole bigint, c bigint, _id bigint, _th bigint, at int, n int, off int"), "digit3")
    strip_kinds = stored(cut.groupBy("core", "whole").agg(F.count(F.lit(1)).alias("times"), F.min("c").alias("c")), "strips")
    repeated_strips = stored(strip_kinds.where("times > 1").select("core", "whole"), "settled-strips")
    settled = cut.join(repeated_strips, ["core", "whole"], "left_semi").select("c", F.col("off").alias("first"), (F.col("off") + F.col("n") - 1).alias("last"))
    mixed = stored(strip_kinds.groupBy("core").agg(F.min("whole").alias("w1"), F.max("whole").alias("w2")).where("w1 <> w2").select("core"), "mixed")
    # One copy of each strip that shares its core with a different one; only those that occur once still need an answer.
    last = cut.join(strip_kinds.join(mixed, "core").select("core", "whole", "times", F.col("c").alias("rep")), ["core", "whole"]).where("c = rep")
    tail = stored(last.groupBy(*KEY).agg(F.collect_list(F.struct("c", "at", "n", "off", (F.col("times") == 1).cast("int").alias("ask"))).alias("_jobs")), "open-strips")

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(unpacked(batches), "_text"):
            sums, second = scan.byte_sums(data), scan.byte_sums(data, lane=1)
            jobs, doc = _flat(rows.column("_jobs"))
            lo = jobs["at"] + offsets[doc]
            at = scan.concat_ranges(lo, jobs["n"])
            job = np.repeat(np.arange(len(lo)), jobs["n"])
            yield pa.RecordBatch.from_arrays(
                [_long(scan.spans_hash(sums, at, at + threshold)), _long(scan.spans_hash(second, at, at + threshold, lane=1)), pa.array(jobs["c"][job]), pa.array((at - lo[job] + jobs["off"][job]).astype(np.int32)),
                 pa.array(jobs["ask"][job].astype(bool))], ["w", "w2", "c", "o", "ask"])

    # Pass 4: the windows of mixed strips to the full depth.
    ends = packed(scanned).join(tail, KEY).select(*KEY, "_z", "_jobs")
    windows = stored(ends.mapInArrow(rest, "w bigint, w2 bigint, c bigint, o int, ask boolean"), "windows")
    # Stored, so that the join meets two plain shuffles, whose large partitions Spark splits.
    groups = stored(windows.groupBy("w", "w2").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("w", "w2"), "digit4")
    single_windows = windows.where("ask").join(groups, ["w", "w2"], "left_semi").select("c", F.col("o").alias("first"), F.col("o").alias("last"))
    found = stored(settled.unionByName(single_windows).groupBy("c").agg(F.collect_list(F.struct("first", "last")).alias("offs")), "found")
    many = stored(kinds.where("n > 1").select("c").distinct(), "settled")
    inside = F.explode(F.transform("offs", lambda o: F.struct((F.col("lo") + o["first"]).alias("first"), (F.col("lo") + o["last"]).alias("last"))))
    place = held.join(many, "c", "left_semi").select(*KEY, F.struct(F.col("lo").alias("first"), F.col("hi").alias("last")).alias("s"))
    single = held.join(many, "c", "left_anti").join(found, "c").select(*KEY, inside.alias("s"))
    return place.unionByName(single).groupBy(*KEY).agg(F.collect_list("s").alias("_spans"))


def _flat(column: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Fields of an array<struct> column as arrays, and the row of each entry."""
    counts = np.diff(column.offsets.to_numpy())
    values = column.flatten()
    fields = {f.name: values.field(f.name).to_numpy(zero_copy_only=False) for f in values.type}
    return {k: v.astype(np.int64) for k, v in fields.items()}, np.repeat(np.arange(len(column)), counts)


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes, NULL if none was removed)."""
    gram, strip = max(1, min(GRAM, threshold // 6)), max(1, min(STRIP, threshold // 4))
    full = F.coalesce(F.col(text), F.lit(""))
    body = ship(docs).select(F.col(id_col).cast("bigint").alias("_doc"), full.alias("_text"), *row_key(F.col(id_col), F.col(text)))
    info = stored(body.withColumn("_t2", F.xxhash64(F.lit(1), "_text")).mapInArrow(
        _info, "_doc bigint, _id bigint, _th bigint, _t2 bigint, _n bigint, _sha string"), "info")
    texts = info.where(F.col("_n") >= threshold).groupBy("_th", "_t2").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    texts = stored(texts, "copied")
    later = stored(info.join(texts, ["_th", "_t2"]).where("_id > _first").select(*KEY).distinct(), "copies")
    scanned = body.select(*KEY, "_text").join(hinted(later), KEY, "left_anti")
    spans = stored(repeated_starts(scanned, threshold, gram, strip), "spans")
    cut = packed(body.select(*KEY, "_text")).join(spans, KEY).select(*KEY, "_z", "_spans")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(unpacked(batches), "_text"):
            spans, doc = _flat(rows.column("_spans"))
            bounds = np.searchsorted(doc, np.arange(rows.num_rows + 1))
            removed, runs, marks, kept = [], [], [], []
            for d in range(rows.num_rows):
                own = slice(bounds[d], bounds[d + 1])
                n = int(offsets[d + 1] - offsets[d])
                steps = np.zeros(n + 1, np.int64)
                np.add.at(steps, spans["first"][own], 1)
                np.add.at(steps, spans["last"][own] + threshold, -1)
                mask = np.cumsum(steps[:-1]) > 0
                left = data[offsets[d]:offsets[d + 1]][~mask].tobytes()
                removed.append(int(mask.sum()))
                runs.append(int(np.count_nonzero(np.diff(mask.astype(np.int8), prepend=0) == 1)))
                marks.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [rows.column("_id"), rows.column("_th"), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(marks), pa.array(kept, pa.binary())],
                ["_id", "_th", "_cut", "_runs", "_csha", "_kept"])

    cut = cut.mapInArrow(apply, "_id bigint, _th bigint, _cut bigint, _runs bigint, _csha string, _kept binary").dropDuplicates(KEY)
    copied = F.col("_rows").isNotNull()
    none = hashlib.sha256(b"").hexdigest()
    return (info.join(texts, ["_th", "_t2"], "left").join(cut, KEY, "left").select(
        F.col("_doc").alias(id_col), F.col("_n").alias("n_bytes"),
        F.when(copied, F.col("_n")).otherwise(F.coalesce("_cut", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copied, F.lit(1)).otherwise(F.coalesce("_runs", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(copied, F.lit(none)).otherwise(F.coalesce("_csha", "_sha")).alias("kept_sha256"),
        F.when(copied, F.lit(b"")).otherwise(F.col("_kept")).alias("kept")))


def op2_suffix_dedup(docs: DataFrame) -> DataFrame:
    return suffix_dedup(docs).drop("kept")
