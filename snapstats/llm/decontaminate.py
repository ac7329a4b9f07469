"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit verification.

Texts and items are sequences of lower-cased alphanumeric words. The CGK embedding walks over a window: at step j it emits the
current word and moves on if a random bit of (j, word) says so; two windows at edit distance e fall into step again
after about e^2 steps, so their embeddings are near in Hamming distance. SAMPLES coordinates of an embedding are a bucket
key; REPEATS independent walks and samples bring the chance to meet an item within the tolerance over TARGET_RECALL (measured in
the tests). Items are embedded by windows side by side and one at their end, texts by windows of the item's size class
(shorter at the end of a text, by as many words as a leak may have lost).
Windows hold at most LARGEST words: over longer ones the walks of an item with many edits fall out of step for good, while some
window of LARGEST words always has no more than its share of the edits.
Every pair that meets in a bucket is verified by the exact edit distance of the whole item to the text around the window.

A window within the tolerance shares GRAM consecutive words with the item (the matching words fall into at most e + 1 runs), so
only windows around such a shared run are embedded; nothing within the tolerance is lost by that.
Items are read in blocks of ITEM_BLOCK, each block sent to all tasks and searched in one pass over the texts.

Edge cases: NULL and empty texts and items match nothing; items under GRAM words match nothing (chance would); items
under 9 words match exactly only; rows with a NULL or repeated id are searched row by row; items that repeat are found under each id;
items with a NULL id are searched by decontaminate() but not listed by the query;
the rest of `docs` is ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm import scan
from snapstats.llm.common import hinted, row_key, ship, stored, text_pieces

TOLERANCE_PERCENT = 15
GRAM = 4
SAMPLES, REPEATS = 3, 24
TARGET_RECALL = 0.98
ITEM_BLOCK = 50_000
LARGEST = 32
CLASSES = np.unique((4 * 2 ** (np.arange(0, 40) / 2)).astype(np.int64))
_rng = np.random.default_rng(40961)
_SEEDS = _rng.integers(1, 1 << 63, (REPEATS, 4096), dtype=np.uint64)
KEY = ["_id", "_th"]


def tolerance(words: int) -> int:
    return words * TOLERANCE_PERCENT // 100 if words >= 9 else 0


def size_class(words: int) -> int:
    return min(LARGEST, int(CLASSES[np.searchsorted(CLASSES, words, "right") - 1]))


def window_places(words: int, size: int) -> list[int]:
    """Where the windows of an item begin: side by side, the last one at the item's end."""
    return [*range(0, words - size, size), words - size]


def bucket_keys(words: np.ndarray, starts: np.ndarray, size: int, ends: np.ndarray | None = None) -> np.ndarray:
    """REPEATS keys (columns) of the windows words[s:s + size], cut off at `ends`; the walk of up to 2 * size steps stays
    inside a window and reads the word 0 behind it."""
    length = np.full(len(starts), size, np.int64) if ends is None else np.minimum(ends - starts, size)
    keys = np.empty((len(starts), REPEATS), np.uint64)
    steps = min(2 * size, _SEEDS.shape[1])
    for r in range(REPEATS):
        sampled = set(np.random.default_rng([r, size]).choice(steps, min(SAMPLES, steps), replace=False).tolist())
        at = np.zeros(len(starts), np.int64)
        key = np.full(len(starts), (r << 20) + size, np.uint64)
        for j in range(max(sampled) + 1):
            word = np.where(at < length, words[starts + np.minimum(at, length - 1)], np.uint64(0))
            if j in sampled:
                key = scan.mix(key * np.uint64(0x9E3779B97F4A7C15) + word)
            at += (scan.mix(word ^ _SEEDS[r, j]) & np.uint64(1)).astype(np.int64)
        keys[:, r] = key
    return keys


def fit(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(distance, first, end): the part of `text` nearest to `item` in edits; the shortest such part that ends first."""
    def last_row(a: np.ndarray, b: np.ndarray, free_start: bool) -> np.ndarray:
        row = np.zeros(len(b) + 1, np.int64) if free_start else np.arange(len(b) + 1)
        slope = np.arange(len(b) + 1)
        for i, x in enumerate(a, 1):
            new = np.append(i, np.minimum(row[:-1] + (b != x), row[1:] + 1))
            row = np.minimum.accumulate(new - slope) + slope
        return row
    ends = last_row(item, text, True)
    end = int(ends.argmin())
    best = int(ends[end])
    back = last_row(item[::-1], text[:end][::-1], False)
    return best, end - int(np.flatnonzero(back == best)[0]), end


class Items:
    """Items' words, their grams with size classes, and their bucket keys."""

    def __init__(self, ids: list, texts: list[str | None]):
        data = [(t or "").encode() for t in texts]
        joined = np.frombuffer(b"".join(data), np.uint8)
        words = scan.Words(joined, np.cumsum([0, *map(len, data)]), True, scan.ALPHANUMERIC)
        self.ids, self.hash, self.offsets = ids, words.hash, words.offsets
        counts = np.diff(words.offsets)
        usable = counts >= GRAM
        classes = np.array([size_class(n) if n >= GRAM else 0 for n in counts], np.int64)
        self.longest = int(counts.max(initial=0))
        at, grams = words.windows(GRAM)
        kinds, which = np.unique(classes[words.doc[at]], return_inverse=True)
        self.classes = kinds
        self.grams, back = np.unique(grams, return_inverse=True)
        self.of_class = np.zeros((len(self.grams), len(kinds)), bool)
        self.of_class[back, which] = True
        keys, items, offs = [], [], []
        for c in kinds:
            own = np.flatnonzero(usable & (classes == c))
            places = [window_places(int(n), int(c)) for n in counts[own]]
            off = np.array([p for row in places for p in row], np.int64)
            own = np.repeat(own, [len(row) for row in places])
            keys.append(bucket_keys(words.hash, words.offsets[own] + off, int(c)).ravel())
            items.append(np.repeat(own, REPEATS))
            offs.append(np.repeat(off, REPEATS))
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.item = np.concatenate(items)[order] if keys else np.zeros(0, np.int64)
        self.off = np.concatenate(offs)[order] if keys else np.zeros(0, np.int64)

    def candidates(self, words: scan.Words) -> np.ndarray:
        """Distinct (text, item, place of the item's start among the words) that meet in a bucket."""
        at, hashes = words.windows(GRAM)
        if not len(self.grams) or not len(at):
            return np.zeros((0, 3), np.int64)
        place = np.minimum(np.searchsorted(self.grams, hashes), len(self.grams) - 1)
        hit = self.grams[place] == hashes
        found = []
        for k, c in enumerate(self.classes.tolist()):
            seeds = at[hit][self.of_class[place[hit], k]]
            # Any window of the class that holds the shared run, and windows that begin in it.
            near = scan.covered(np.maximum(seeds - c - tolerance(2 * c), words.offsets[words.doc[seeds]]), c + tolerance(2 * c) + GRAM, len(words.start))
            starts = np.flatnonzero(near)
            # A leak that has lost words may be shorter than the window and end with the text.
            starts = starts[starts + c - tolerance(2 * c) <= words.offsets[words.doc[starts] + 1]]
            for piece in range(0, len(starts), 1 << 16):
                part = starts[piece:piece + (1 << 16)]
                keys = bucket_keys(words.hash, part, c, words.offsets[words.doc[part] + 1])
                lo, hi = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
                row, _ = np.nonzero(hi > lo)
                lo, hi = lo[hi > lo], hi[hi > lo]
                entry = scan.concat_ranges(lo, hi - lo)
                start = np.repeat(part[row], hi - lo)
                found.append(np.column_stack([words.doc[start], self.item[entry], start - self.off[entry]]))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)

    def matches(self, words: scan.Words) -> list[tuple[int, int, int, int, int]]:
        """(text, item, distance, first word, end word): the best match of each item within the tolerance in each text."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for doc, item, start in self.candidates(words).tolist():
            own = self.hash[self.offsets[item]:self.offsets[item + 1]]
            slack = tolerance(len(own))
            a = max(start - 2 * slack - 1, int(words.offsets[doc]))
            b = min(start + len(own) + 2 * slack + 1, int(words.offsets[doc + 1]))
            known = best.get((doc, item))
            if b <= a or known and known[0] == 0:
                continue
            distance, first, end = fit(own, words.hash[a:b])
            if distance <= slack and (known is None or (distance, a + first) < known[:2]):
                best[doc, item] = (distance, a + first, a + end)
        return [(*k, *v) for k, v in sorted(best.items())]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", block: int = ITEM_BLOCK, unnamed: bool = False) -> DataFrame:
    """(_id, _th, id, item_id, distance, start, end): matched items per row of `docs`; places in code points, end exclusive.

    Items with a NULL id are searched if `unnamed`, and reported with item_id NULL.
    """
    items = benchmark.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).alias("t"))
    items = items if unnamed else items.where("i is not null")
    blocks = max(1, -(-items.count() // block))
    body = ship(docs).select(F.col(id_col).cast("bigint").alias("_doc"), F.coalesce(F.col(text), F.lit("")).alias("_text"), *row_key(F.col(id_col), F.col(text)))
    schema = "_doc bigint, _id bigint, _th bigint, item_id bigint, distance int, start int, end int"
    found = None
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).toArrow()
        share = body.sparkSession.sparkContext.broadcast(Items(rows.column("i").to_pylist(), rows.column("t").to_pylist()))

        def search(batches: Iterator[pa.RecordBatch], share=share) -> Iterator[pa.RecordBatch]:
            known = share.value
            for rows, data, offsets in text_pieces(batches, "_text"):
                words = scan.Words(data, offsets, True, scan.ALPHANUMERIC)
                hits = known.matches(words)
                take = pa.array([h[0] for h in hits], pa.int64())
                points = [
                    (int(np.count_nonzero((data[offsets[d]:words.start[a]] & 0xC0) != 0x80)), int(np.count_nonzero((data[offsets[d]:words.end[b - 1]] & 0xC0) != 0x80)))
                    for d, _, _, a, b in hits]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(c).take(take) for c in ("_doc", *KEY)]
                    + [pa.array([known.ids[h[1]] for h in hits], pa.int64()), pa.array([h[2] for h in hits], pa.int32()),
                       pa.array([p[0] for p in points], pa.int32()), pa.array([p[1] for p in points], pa.int32())],
                    ["_doc", *KEY, "item_id", "distance", "start", "end"])
        part = body.mapInArrow(search, schema)
        found = part if found is None else found.unionByName(part)
    return found.withColumnRenamed("_doc", id_col)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that hold no benchmark item, with or without an id."""
    bad = stored(contaminated(docs, benchmark, id_col, text, unnamed=True).select(F.col("_id").alias("_bad_id"), F.col("_th").alias("_bad_th")).distinct(), "contaminated")
    return (docs.select(F.struct("*").alias("_row"), *row_key(F.col(id_col), F.col(text)))
            .join(hinted(bad), (F.col("_id") == F.col("_bad_id")) & (F.col("_th") == F.col("_bad_th")), "left_anti").select("_row.*"))


def op9_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark).drop(*KEY)
