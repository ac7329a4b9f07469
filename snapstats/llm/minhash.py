"""Near-duplicate links and components by min-max hashing.

A document is the set of its distinct five-word shingles (64-bit hashes of the lower-cased words). Under each of
PERMUTATIONS hash functions both the smallest and the largest value are kept, so 2 * PERMUTATIONS signature values cost
half the evaluations of plain min-hashing; each agrees between two sets with probability equal to their
similarity. BANDS bands of ROWS values make a pair at the threshold of 0.85 miss all buckets with probability 8e-7.

Equal sets are one class from the start (by a 128-bit digest), so copies cost one aggregation however many there are.
Classes that share a bucket are compared in rounds, and only while they are not in one component yet:
 1. every class with its likeliest leader (of all its buckets' leaders, the one it shares most buckets with);
 2. every class with all leaders of its buckets;
 3. all classes of a bucket that are still in different components, block against block.
The leader of a bucket is the class with the most bucket mates, which in a group of edited copies is their source.
After a round, links are confirmed on the full sets, components are formed and settled pairs fall away. Links inside a
component are not needed for its id, and no link between components is left out, so the result is whole.

Edge cases: NULL, empty and wordless texts have no set (n_shingles 0) and are linked with nothing; fewer than five
words are one shingle; a NULL id is a row that cannot be named: component_id is NULL and it is kept; rows that repeat an id
are one node, linked by any of their texts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapstats.llm import scan
from snapstats.llm.common import hinted, ship, stored, text_pieces
from snapstats.llm.components import components

SHINGLE = 5
PERCENT = 85
ROWS, BANDS = 5, 24
PERMUTATIONS = ROWS * BANDS // 2
_rng = np.random.default_rng(6021023)
_MULTIPLY = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# Classes compared with one another at once.
BLOCK = 512


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    words = scan.Words(data, offsets, lower=True)
    at, hashes = words.windows(SHINGLE)
    bounds = np.searchsorted(at, words.offsets)
    sums = scan.running(words.hash)
    sets = []
    for d in range(len(offsets) - 1):
        first, last = words.offsets[d], words.offsets[d + 1]
        if 0 < last - first < SHINGLE:
            # The count is mixed in, so a short text equals only a text of the same words.
            own = scan.mix(scan.spans_hash(sums, np.array([first]), np.array([last])) + np.uint64(last - first))
        else:
            own = np.unique(hashes[bounds[d]:bounds[d + 1]])
        sets.append(own)
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """BANDS bucket keys of each (non-empty) set from its minima and maxima under all permutations."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    values = np.empty((len(sets), PERMUTATIONS, 2), np.uint64)
    for p in range(PERMUTATIONS):
        # Shingles are mixed hashes already: an odd factor permutes them.
        x = flat * _MULTIPLY[p]
        values[:, p, 0], values[:, p, 1] = np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)
    rows = values.reshape(len(sets), BANDS, ROWS)
    keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(sets), 1))
    for r in range(ROWS):
        keys = scan.mix(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, r])
    return keys.view(np.int64)


def digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, from its size and two independent sums over it."""
    a = scan.mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    b = scan.mix(scan.mix(shingles + np.uint64(0x632BE59BD9B4E019))).sum(dtype=np.uint64)
    return int(np.array(a, np.uint64).view(np.int64)), int(np.array(b, np.uint64).view(np.int64))


def _class_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_pieces(batches, "_text"):
        sets = shingle_sets(data, offsets)
        marks = [digest(s) if len(s) else (None, None) for s in sets]
        full = [s for s in sets if len(s)]
        made = iter(signatures(full)) if full else iter(())
        keys = [next(made) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [rows.column("_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([m[0] for m in marks], pa.int64()),
             pa.array([m[1] for m in marks], pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["_id", "_n", "_d1", "_d2", "_keys"])


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_pieces(batches, "_text"):
        sets = [s.view(np.int64) for s in shingle_sets(data, offsets)]
        yield pa.RecordBatch.from_arrays([rows.column("_id"), pa.array(sets, pa.list_(pa.int64()))], ["_id", "_set"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar on their full sets."""
    left = sets.select(F.col("_id").alias("a"), F.col("_set").alias("_sa"))
    right = sets.select(F.col("_id").alias("b"), F.col("_set").alias("_sb"))
    shared = F.size(F.array_intersect("_sa", "_sb"))
    return (pairs.join(left, "a").join(right, "b")
            .where(F.least(F.size("_sa"), F.size("_sb")) * 100 >= F.greatest(F.size("_sa"), F.size("_sb")) * percent)
            .where(shared * 100 >= (F.size("_sa") + F.size("_sb") - shared) * percent).select("a", "b"))


def _bucket_members(classes: DataFrame) -> DataFrame:
    """(key, c, n, mates): classes by shared bucket. A class that several texts of an id bring to a bucket may stand there again."""
    entries = classes.select(F.explode("_keys").alias("key"), F.col("_c").alias("c"), F.col("_n").alias("n"))
    # Stored, so that the join meets two plain shuffles, whose large partitions Spark splits.
    shared = stored(entries.groupBy("key").agg(F.count(F.lit(1)).alias("mates")).where("mates > 1"), "shared")
    return entries.join(shared, "key").select("key", "c", "n", "mates")


def _sizes_fit(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _unsettled(pairs: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Pairs whose ends are in different components so far."""
    if roots is None:
        return pairs
    a, b = (roots.select(F.col("node").alias(c), F.col("root").alias(f"_{c}")) for c in "ab")
    return (pairs.join(a, "a", "left").join(b, "b", "left")
            .where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).drop("_a", "_b"))


def similar(sets: list[np.ndarray], roots: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs (i of left, j of right, i < j if they are the same block) of different roots that are similar."""
    sizes = np.array([len(s) for s in sets])
    a, b = sizes[left][:, None], sizes[right][None, :]
    wanted = (roots[left][:, None] != roots[right][None, :]) & (np.minimum(a, b) * 100 >= np.maximum(a, b) * percent)
    if left is right:
        wanted &= np.arange(len(left))[:, None] < np.arange(len(right))[None, :]
    x, y = np.nonzero(wanted)
    if not len(x):
        return []
    if len(x) <= 64:
        shared = np.array([len(np.intersect1d(sets[left[i]], sets[right[j]], assume_unique=True)) for i, j in zip(x, y)])
    else:
        # Shared shingles of all pairs as a product of 0/1 matrices, some columns at a time.
        flat = [np.concatenate([sets[k] for k in side]) for side in (left, right)]
        owner = [np.repeat(np.arange(len(side)), sizes[side]) for side in (left, right)]
        columns = np.intersect1d(flat[0], flat[1]) if left is not right else np.unique(flat[0])
        places = [np.searchsorted(columns, f) for f in flat]
        found = [(p < len(columns)) & (columns[np.minimum(p, len(columns) - 1)] == f) if len(columns) else np.zeros(len(f), bool) for p, f in zip(places, flat)]
        counts = np.zeros((len(left), len(right)), np.float32)
        for first in range(0, len(columns), 4096):
            parts = []
            for p, f, o, side in zip(places, found, owner, (left, right)):
                own = f & (p >= first) & (p < first + 4096)
                m = np.zeros((len(side), 4096), np.float32)
                m[o[own], p[own] - first] = 1
                parts.append(m)
            counts += parts[0] @ parts[1].T
        shared = counts[x, y].astype(np.int64)
    close = shared * 100 >= (sizes[left[x]] + sizes[right[y]] - shared) * percent
    return list(zip(left[x[close]].tolist(), right[y[close]].tolist()))


def _compare(percent: int):
    """Arrow function over rows sorted by (key, i, j): the similar pairs of each pair of blocks."""
    def group(table: pa.Table) -> list[tuple[int, int]]:
        c = table.column("c").to_numpy()
        sets = [s.values.to_numpy().view(np.uint64) for s in table.column("_set")]
        roots, block = table.column("root").to_numpy(), table.column("block").to_numpy()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        left = np.flatnonzero(block == i)
        right = left if i == j else np.flatnonzero(block == j)
        return [(int(c[a]), int(c[b])) for a, b in similar(sets, roots, left, right, percent)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        last = None

        def flush() -> pa.RecordBatch:
            pairs = group(pa.concat_tables(held))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([max(p) for p in pairs], pa.int64()), pa.array([min(p) for p in pairs], pa.int64())], ["a", "b"])
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            marks = np.column_stack([table.column(k).to_numpy() for k in ("key", "i", "j")])
            cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), len(marks)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if held and tuple(marks[a]) != last:
                    yield flush()
                held.append(table.slice(a, b - a))
                last = tuple(marks[a])
        if held:
            yield flush()
    return run


def _across(members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components inside buckets.

    A bucket is dealt into blocks of about BLOCK classes and every two blocks meet in a task, so a bucket of any size is neither
    gathered in one place nor written out as pairs.
    """
    marked = (members.join(roots.withColumnRenamed("node", "c"), "c", "left")
              .select("key", "c", "mates", F.coalesce("root", "c").alias("root")))
    apart = stored(marked.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key"), "apart")
    blocks = F.ceil(F.col("mates") / BLOCK).cast("int")
    dealt = (marked.join(apart, "key", "left_semi")
             .select("key", "c", "root", F.pmod(F.xxhash64("c"), blocks).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("o"))
             .select("key", "c", "root", "block", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j")))
    return (dealt.join(sets.withColumnRenamed("_id", "c"), "c").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .select("key", "c", "root", "block", "i", "j", "_set").mapInArrow(_compare(percent), "a bigint, b bigint"))


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Roots after more links; the components so far stand for the links that made them."""
    if links.isEmpty():
        return roots
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links))


def _roots(body: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(node, root) of all classes that are linked, by confirmed links that connect all similar classes."""
    members = stored(_bucket_members(classes), "members")
    # How many bucket mates a class has, over all its buckets.
    mass = stored(members.groupBy("c").agg(F.sum(F.col("mates") - 1).alias("mass")), "mass")
    sets = stored(body.join(hinted(mass.select(F.col("c").alias("_id"))), "_id", "left_semi").mapInArrow(_sets_of, "_id bigint, _set array<bigint>"), "full-sets")

    leaders = stored(members.join(mass, "c").groupBy("key").agg(F.max(F.struct("mass", (-F.col("c")).alias("m"), F.col("n").alias("ln"))).alias("l")), "leaders")
    stars = stored(
        members.join(leaders, "key").select("c", "n", (-F.col("l.m")).alias("lead"), F.col("l.ln").alias("ln"))
        .where("c <> lead").where(_sizes_fit("n", "ln", percent))
        .groupBy(F.greatest("c", "lead").alias("a"), F.least("c", "lead").alias("b"), "c").agg(F.count(F.lit(1)).alias("times")), "stars")
    best = stars.groupBy("c").agg(F.max(F.struct("times", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
    roots = components(stored(_confirmed(best, sets, percent), "links"))
    rest = _unsettled(stars.select("a", "b").distinct(), roots)
    roots = _merged(roots, stored(_confirmed(rest, sets, percent), "links"))
    return _merged(roots, stored(_across(members, roots, sets, percent), "links"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of `docs`: id, n_shingles, component_id (smallest id reachable), kept."""
    body = ship(docs).select(F.col(id_col).cast("bigint").alias("_id"), F.col(text).alias("_text"))
    rows = stored(body.mapInArrow(_class_rows, "_id bigint, _n bigint, _d1 bigint, _d2 bigint, _keys array<bigint>"), "sets")
    named = rows.where("_n > 0 and _id is not null")
    # Rows of a class have the same set, so any of them tells its size and keys.
    classes = stored(named.groupBy("_d1", "_d2").agg(F.min("_id").alias("_c"), F.first("_n").alias("_n"), F.first("_keys").alias("_keys")), "classes")
    of_ids = stored(named.select("_id", "_d1", "_d2").join(classes.select("_d1", "_d2", "_c"), ["_d1", "_d2"]).select("_id", "_c"), "of-ids")
    # An id that repeats with different texts joins their classes.
    several = of_ids.groupBy("_id").agg(F.min("_c").alias("b"), F.max("_c").alias("_hi")).where("b <> _hi").select("_id", "b")
    several = stored(of_ids.join(several, "_id").select(F.col("_c").alias("a"), "b"), "several")
    roots = _merged(_roots(body, classes, percent), several)
    placed = (of_ids.distinct().join(roots, F.col("_c") == F.col("node"), "left")
              .groupBy("_id").agg(F.min(F.coalesce("root", "_c")).alias("_root")))
    component = F.coalesce("_root", "_id")
    return rows.select("_id", "_n").join(placed, "_id", "left").select(
        F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """`docs` with one row of every component: the one with its smallest id (of rows that repeat it, the one of the smallest text).

    Rows with a NULL id, and rows without words unless their id repeats, all stay.
    """
    found = stored(near_duplicates(docs, id_col, text, percent).where(F.col(id_col).isNotNull())
                   .groupBy(F.col(id_col).alias("_nid")).agg(F.min("kept").alias("_kept"), F.count(F.lit(1)).alias("_rows")), "verdicts")
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("bigint").alias("_id"), F.col(text).alias("_text"))
    out = found.where("not _kept or _rows > 1")
    single = rows.join(hinted(out.select("_nid")), F.col("_id") == F.col("_nid"), "left_anti").select("_row")
    first = (rows.join(hinted(found.where("_kept and _rows > 1").select("_nid")), F.col("_id") == F.col("_nid"), "left_semi")
             .withColumn("_place", F.row_number().over(Window.partitionBy("_id").orderBy("_text"))).where("_place = 1").select("_row"))
    return single.unionByName(first).select("_row.*")


def op6_minhash(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
