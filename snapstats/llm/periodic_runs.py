"""Periodic runs of words inside a text, found by a suffix automaton whose link tree is accessed word by word.

A run is a stretch of consecutive words with smallest period q, at least max(MIN_WORDS, 2 * q) long, that no neighbouring word
extends keeping that period. Per stretch of candidate words:

1. The suffix automaton is built word by word; its suffix links form a tree whose paths to the root are the suffixes of a prefix.
2. For every word i in order, the path from the state of prefix i to the root is accessed in a link-cut tree. The pieces of the path are
   the preferred paths of earlier accesses, each with one colour: the word at which its strings last ended. A piece of colour e and
   length L (its deepest string) with d = i - e <= L is a square: the last L + d words have period d. Then the whole path takes colour i.
3. The squares of one start and period grow by a word at a time; the last of them is the run.

All runs lie in the candidates: a run of 12 words and period q repeats at least max(12 - q, q) >= 6 words at distance q, and such windows of
6 words cover it. So only words covered by a window that occurs twice in its text enter the automaton; window values are sums that
may collide, which lets needless words in and keeps none out. Words are compared as numbers given to distinct texts, never by a hash.

Every text is worked on by one task as a whole (a run may be as long as the text); stretches take about 150 bytes a word beside the
text. Edge cases: NULL and empty texts have no words, no runs and an empty collapsed text; a NULL id is kept; repeated rows
give repeated results; an empty table gives no rows; ties between runs of equal length go to the smallest start, then period; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstats.llm import scan
from snapstats.llm.common import WORD_SPLIT, ship, text_pieces

MIN_WORDS = 12
_RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def link_tree(words: list[int]) -> tuple[array, array, array]:
    """Suffix automaton of `words`: link and longest length of every state (state 1 is the root), and the state of each prefix.

    Most states have one transition, which is kept in two flat arrays; further ones are in a dictionary of their state.
    """
    n = len(words)
    link, length, word, target = (array("i", bytes(8 * n + 16)) for _ in range(4))
    more: dict[int, dict[int, int]] = {1: {}}
    prefix = array("i", bytes(4 * n))
    word[1] = -1
    last, states = 1, 1
    for i, c in enumerate(words):
        states += 1
        new = states
        length[new] = i + 1
        word[new] = -1
        p = last
        while p:
            if word[p] == c:
                break
            extra = more.get(p)
            if extra is not None and c in extra:
                break
            if word[p] < 0:
                word[p], target[p] = c, new
            elif extra is None:
                more[p] = {c: new}
            else:
                extra[c] = new
            p = link[p]
        if not p:
            link[new] = 1
        else:
            q = target[p] if word[p] == c else more[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                states += 1
                clone = states
                length[clone] = length[p] + 1
                word[clone], target[clone], link[clone] = word[q], target[q], link[q]
                if q in more:
                    more[clone] = dict(more[q])
                while p:
                    if word[p] == c:
                        if target[p] != q:
                            break
                        target[p] = clone
                    else:
                        extra = more.get(p)
                        if extra is None or extra.get(c) != q:
                            break
                        extra[c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        prefix[i] = last = new
    return link, length, prefix


def runs_of(words: list[int], shortest: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of `words`."""
    up, length, prefix = link_tree(words)
    # Splay trees over the preferred paths, keyed by depth; the parent of a tree's root leads to the next path above.
    left, right, colour = (array("i", bytes(4 * len(up))) for _ in range(3))
    found: dict[tuple[int, int], int] = {}
    for i, state in enumerate(prefix, 1):
        below, y = 0, state
        while y:
            # Splay y to the root of its tree; the tree's colour travels with its root.
            p = up[y]
            while p and (left[p] == y or right[p] == y):
                g = up[p]
                if g and (left[g] == p or right[g] == p):
                    top = up[g]
                    zigzig = (left[g] == p) == (left[p] == y)
                    if top:
                        if left[top] == g:
                            left[top] = y
                        elif right[top] == g:
                            right[top] = y
                        else:
                            colour[y] = colour[g]
                    else:
                        colour[y] = colour[g]
                    if zigzig:
                        if left[p] == y:
                            b, c = right[y], right[p]
                            left[p], right[y], left[g], right[p] = b, p, c, g
                        else:
                            b, c = left[y], left[p]
                            right[p], left[y], right[g], left[p] = b, p, c, g
                        if b:
                            up[b] = p
                        if c:
                            up[c] = g
                        up[g], up[p] = p, y
                    else:
                        b, c = left[y], right[y]
                        if right[p] == y:
                            right[p], left[g], left[y], right[y] = b, c, p, g
                            if b:
                                up[b] = p
                            if c:
                                up[c] = g
                        else:
                            left[p], right[g], left[y], right[y] = c, b, g, p
                            if c:
                                up[c] = p
                            if b:
                                up[b] = g
                        up[p] = up[g] = y
                    up[y] = top
                    p = top
                else:
                    colour[y] = colour[p]
                    if left[p] == y:
                        b = right[y]
                        left[p], right[y] = b, p
                    else:
                        b = left[y]
                        right[p], left[y] = b, p
                    if b:
                        up[b] = p
                    up[p], up[y] = y, g
                    p = g
            e = colour[y]
            if e:
                d, size = i - e, length[y]
                if d <= size and d + size >= shortest:
                    found[i - d - size, d] = i
            cut = right[y]
            if cut:
                colour[cut] = e
            right[y] = below
            below, y = y, up[y]
        colour[below] = i
    return sorted((start, end - start, period) for (start, period), end in found.items())


def stretches(codes: np.ndarray, offsets: np.ndarray, shortest: int = MIN_WORDS) -> list[tuple[int, int]]:
    """[start, end) of the stretches covered by windows of half the shortest run that occur twice in their text."""
    size = (shortest + 1) // 2
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.arange(max(0, len(codes) - size + 1))
    at = at[doc[at] == doc[at + size - 1]] if len(at) else at
    if not len(at):
        return []
    values = scan.mix(codes.astype(np.uint64))
    key = doc[at].astype(np.uint64)
    for k in range(size):
        key = key * np.uint64(0x9E3779B97F4A7C15) + values[at + k]
        key ^= key >> np.uint64(29)
    order = np.argsort(key)
    ranked = key[order]
    same = np.zeros(len(at) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    at = at[order[same[1:] | same[:-1]]]
    if not len(at):
        return []
    mask = scan.covered(at, size, len(codes))
    # Stretches of two texts that touch are two.
    step = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]])) != 0)
    out = []
    for a, b in zip(step[::2].tolist(), step[1::2].tolist()):
        inner = offsets[(offsets > a) & (offsets < b)] if doc[a] != doc[b - 1] else ()
        edges = [a, *(int(x) for x in inner), b]
        out += [(x, y) for x, y in zip(edges[:-1], edges[1:]) if y > x]
    return out


def _piece(data: np.ndarray, offsets: np.ndarray, shortest: int) -> tuple[list[int], list[list[tuple[int, int, int]]], list[bytes]]:
    """Per text: number of words, runs, and the words kept when every run is cut to its first period."""
    known: dict[bytes, int] = {}
    raw = data.tobytes()
    texts = [raw[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    codes = np.array([known.setdefault(w, len(known)) for words in texts for w in words], np.int64)
    starts = np.concatenate([[0], np.cumsum([len(words) for words in texts])]).astype(np.int64)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in stretches(codes, starts, shortest):
        doc = int(np.searchsorted(starts, a, "right")) - 1
        names: dict[int, int] = {}
        shift = a - int(starts[doc])
        runs[doc] += [(s + shift, n, q) for s, n, q in runs_of([names.setdefault(c, len(names)) for c in codes[a:b].tolist()], shortest)]
    kept = []
    for words, some in zip(texts, runs):
        if some:
            some.sort(key=lambda r: (r[0], r[2]))
            steps = np.zeros(len(words) + 1, np.int64)
            table = np.array(some)
            np.add.at(steps, table[:, 0] + table[:, 2], 1)
            np.add.at(steps, table[:, 0] + table[:, 1], -1)
            words = [words[k] for k in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]
        kept.append(b" ".join(words))
    return [len(words) for words in texts], runs, kept


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shortest: int = MIN_WORDS) -> DataFrame:
    """(id, n_words, runs, collapsed): all runs by start, then period, and the words without the repetitions, joined by one space.

    A word is left out of `collapsed` if any run contains it after that run's first period.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches, "_text"):
            counts, runs, kept = _piece(data, offsets, shortest)
            ends = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
            flat = np.array([x for r in runs for x in r], np.int64).reshape(-1, 3)
            parts = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [rows.column("_doc"), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), parts), pa.array([k.decode() for k in kept], pa.string())],
                ["_doc", "n_words", "runs", "collapsed"])
    return (ship(docs).select(F.col(id_col).cast("bigint").alias("_doc"), F.col(text).alias("_text"))
            .mapInArrow(run, f"_doc bigint, n_words bigint, runs {_RUN}, collapsed string").withColumnRenamed("_doc", id_col))


def longest_run(runs: Column) -> Column:
    """The run of greatest length (ties: smallest start, then period) of an array of runs; NULL if there is none."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    return F.when(best.isNotNull(), F.struct((-best.start).alias("start"), best.length.alias("length"), (-best.period).alias("period")))


def with_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth text by the checksum of its id becomes periodic from some word on, so that runs of all lengths occur."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("_text", WORD_SPLIT), lambda w: w != "")
    rows = docs.select("doc_id", F.col("text").alias("_text"), h.alias("_h"), g.alias("_g"))
    # Other rows get no word list: split and transform are worked out for the chosen texts only.
    picked = F.coalesce(F.col("_h") % 10 == 0, F.lit(False))
    n = F.size("_words")
    a = F.col("_g") % n
    p = 1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8))
    at = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
    chosen = (rows.where(picked).withColumn("_words", F.coalesce(words, F.array().cast("array<string>"))).withColumn("_a", F.when(n > 0, a))
              .withColumn("_p", p)
              .select("doc_id", F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("_words", at(i).cast("int"))), " "))
                      .otherwise("").alias("text")))
    return rows.where(~picked).select("doc_id", F.col("_text").alias("text")).unionAll(chosen)


def op11_periodic_runs(docs: DataFrame) -> DataFrame:
    best = longest_run(F.col("runs"))
    line = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    return (periodic_runs(with_periods(docs)).withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("_best.start").alias("start"), F.col("_best.length").alias("length"),
        F.col("_best.period").alias("period"), F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def oracle() -> str:
    """DuckDB SQL for op11_periodic_runs: windows of six words equal at a distance, joined to stretches that agree word by word."""
    return r"""
WITH bits AS (
    SELECT list(list_reduce(list_prepend(k, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY k) AS crc
    FROM range(256) r(k)),
hashed AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
           xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
                                       lambda s, c: xor(s >> 8, crc[(xor(s, c) & 255) + 1]))) AS h
    FROM documents, bits),
start_at AS (
    SELECT doc_id, words, len(words) AS n, h % 10 = 0 AS planted, (h // 10) % 8 AS cut, CASE WHEN len(words) > 0 THEN (h // 10) % len(words) END AS a
    FROM hashed),
word AS (
    SELECT doc_id, n, i, CASE WHEN planted AND i >= a THEN words[a + (i - a) % (1 + (n - a) // (3 + cut)) + 1] ELSE words[i + 1] END AS w
    FROM (SELECT *, unnest(range(n)) AS i FROM start_at)),
six AS (
    SELECT doc_id, i, concat_ws(' ', w, lead(w) OVER p, lead(w, 2) OVER p, lead(w, 3) OVER p, lead(w, 4) OVER p, lead(w, 5) OVER p) AS six
    FROM word WINDOW p AS (PARTITION BY doc_id ORDER BY i) QUALIFY lead(w, 5) OVER p IS NOT NULL),
repeated AS (SELECT doc_id, i, dense_rank() OVER (ORDER BY doc_id, six) AS g FROM six QUALIFY count(*) OVER (PARTITION BY doc_id, six) > 1),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM repeated x JOIN repeated y ON x.g = y.g AND x.i < y.i),
islands AS (
    SELECT doc_id, q, min(i) AS start, max(i) - min(i) + 6 + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs) GROUP BY doc_id, q, island),
long AS (SELECT * FROM islands WHERE length >= greatest(12, 2 * q)),
runs AS (
    SELECT * FROM long r WHERE NOT EXISTS (
        SELECT 1 FROM long o WHERE o.doc_id = r.doc_id AND o.q < r.q AND o.start <= r.start AND o.start + o.length >= r.start + r.length)),
per_doc AS (
    SELECT doc_id, count(*) AS n_runs, arg_min({'start': start, 'length': length, 'period': q}, (-length, start, q)) AS best,
           string_agg(concat(start, ',', length, ',', q, chr(10)), '' ORDER BY start, q) AS listing
    FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS body FROM word ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
       1000 * best.length // best.period AS exponent_milli, sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM documents d LEFT JOIN per_doc USING (doc_id) LEFT JOIN kept USING (doc_id)"""
