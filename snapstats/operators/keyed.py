"""Per-key building blocks: latest row, top rows, and merges without a table format.

None of them gathers a whole key into one task. Latest and first/last are aggregates with map-side
combine; top rows use a rank filter, which Spark also applies before the shuffle; merges join on
unique keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Slices of a key that are cut to the wanted rank on their own before the key is.
SALTS = 64


def latest_per_key(df: DataFrame, keys: Sequence[str], at: str, columns: Sequence[str], unique: bool = False) -> DataFrame:
    """Newest row per key: `keys`, `at` and `columns`.

    One pass over the table. Ties on `at` are settled by the remaining columns, so the result is one whole row even where the (key, time)
    uniqueness is violated. `unique` promises that it is not, as the stored snapshot tables do: then columns of fixed width are
    picked by time alone, in a hash aggregate, where comparing whole rows takes two sorts.
    """
    if unique:
        newest = [F.max(at).alias(at), *(F.max_by(c, at).alias(c) for c in columns)]
        return df.groupBy(*keys).agg(*newest)
    newest = F.max(F.struct(at, *columns))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                salt_by: Sequence[str], rank: str | None = None) -> DataFrame:
    """The first `n` rows of each key by `order`; `salt_by` are the columns that identify a row.

    A key is first cut to `n` rows in each of `SALTS` slices, so the final sort of a key sees at most
    `n * SALTS` rows however many it has.
    """
    def cut(frame: DataFrame, by: Sequence[str], name: str) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order)
        return frame.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)

    df = df.withColumn("_slice", F.pmod(F.xxhash64(*salt_by), F.lit(SALTS)))
    df = cut(df, [*keys, "_slice"], "_rank").drop("_slice", "_rank")
    ranked = cut(df, keys, rank or "_rank")
    return ranked if rank else ranked.drop("_rank")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Column | str | None) -> DataFrame:
    """One row per key: the first by `order`; without one the smallest by all columns, so that the choice is the same on every run."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*rest) if order is None else order).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def rows_missing(incoming: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not in `current`, for a batch that is small beside the table.

    The stored keys are first reduced to those of the batch: with a batch that fits a broadcast the
    table is read (keys only) and never shuffled. A partition column that follows from the key may be
    passed as one more key to prune the read. The batch is read twice, so one that is dear to compute
    should be written first.
    """
    wanted = incoming.select(*keys)
    known = current.select(*keys).join(wanted, list(keys), "left_semi")
    return incoming.join(known, list(keys), "left_anti")


def insert_ignore(current: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  order: Column | str | None = None) -> DataFrame:
    """`current` plus the incoming rows with new keys; existing rows never change."""
    new = rows_missing(first_per_key(incoming, keys, order), current, keys)
    return current.unionByName(new.select(*_shared(current, new)), allowMissingColumns=True)


def merge_by_key(current: DataFrame, incoming: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
                 order: Column | str | None = None, whole_table: bool = False, not_older: str | None = None) -> DataFrame:
    """Partial-column upsert.

    Known keys take `update_cols` from the incoming row and keep the rest; new keys are inserted whole.
    Rows of one batch that share a key apply in `order`: kept columns from the first, updated columns
    from the last. Without `order` the incoming keys must be unique. Incoming columns the table lacks
    are ignored; table columns the batch lacks stay as they are, or NULL in new rows. With `not_older`, a time among
    the updated columns, a known key is updated only by a row that is not older than the stored one.

    A batch is joined left and its new rows added: one that fits a broadcast updates the table along its
    scan, without shuffling it. `whole_table` says the incoming side is of the table's own size; then one
    full outer join reads and shuffles either side once.
    """
    keys = list(keys)
    columns = _shared(current, incoming)
    updates = [c for c in update_cols if c in columns]
    if order is None:
        incoming = incoming.select(*columns)
    else:
        incoming = _fold_batch(incoming, keys, [c for c in columns if c not in keys], updates, order)
    brought = [c for c in columns if c not in keys] if whole_table else updates
    new = F.struct(F.lit(True).alias("_hit"), *brought).alias("_new")
    hit = F.col("_new").isNotNull()
    wins = hit if not_older is None else hit & (F.col(not_older).isNull() | (F.col("_new")[not_older] >= F.col(not_older)))
    updated = [F.when(wins, F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in updates else F.col(c)
               for c in current.columns]
    if not whole_table:
        joined = current.join(incoming.select(*keys, new), keys, "left").select(*updated)
        return joined.unionByName(rows_missing(incoming, current, keys), allowMissingColumns=True)
    joined = current.withColumn("_old", F.lit(True)).join(incoming.select(*keys, new), keys, "full")
    return joined.select(*[
        F.when(F.col("_old").isNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c)
        if c in brought and c not in updates else value
        for c, value in zip(current.columns, updated)])


def replace_by_parent(current: DataFrame, incoming: DataFrame, parent: str, parents: DataFrame) -> DataFrame:
    """Drop every row of the processed `parents`, then add the incoming rows."""
    kept = current.join(parents.select(parent).distinct(), [parent], "left_anti")
    return kept.unionByName(incoming.select(*_shared(current, incoming)), allowMissingColumns=True)


def _fold_batch(incoming: DataFrame, keys: list[str], columns: list[str], updates: list[str],
                order: Column | str) -> DataFrame:
    kept = [c for c in columns if c not in updates]
    parts = []
    if kept:
        parts.append(F.min_by(F.struct(*kept), order).alias("_first"))
    if updates:
        parts.append(F.max_by(F.struct(*updates), order).alias("_last"))
    if not parts:
        return incoming.select(*keys).distinct()
    return incoming.groupBy(*keys).agg(*parts).select(
        *keys,
        *[F.col("_first")[c].alias(c) for c in kept],
        *[F.col("_last")[c].alias(c) for c in updates],
    )


def _shared(current: DataFrame, incoming: DataFrame) -> list[str]:
    return [c for c in current.columns if c in incoming.columns]
