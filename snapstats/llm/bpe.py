"""Byte-level BPE over a corpus by one global shuffle of distinct words, and decoding.

 1. Pre-tokens are counted per task, summed over the corpus, and each distinct word is encoded once.
 2. Pre-tokens are exploded with their positions and joined with their ids. The HOT_WORDS most frequent words (a fixed bound)
    are joined where the text is read, from a broadcast table; only the other words travel as (row, position, word) to an equi
    join. Frequent words, which would be the skewed keys, thus never shuffle.
 3. Ids are put together by position. A document meets its rare words as the row of its frequent words' ranks (1 to 3 bytes each, 0
    for a rare word), compressed, so neither texts nor frequent words' positions travel.
Decoding looks every id up in the token-byte table, whose size is that of the vocabulary, and joins the bytes by position.

Edge cases: NULL and empty texts have no tokens; special tokens are ordinary text; repeated rows and NULL ids come back row by row;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm import scan
from snapstats.llm.common import row_key, ship, stored, text_pieces
from snapstats.llm.pretokens import PreTokens

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
HOT_WORDS = 3 << 18
# Distinct words a task holds before it hands its counts on.
FLUSH_WORDS = 200_000
KEY = ["_id", "_th"]


def read_ranks(path: str | None = None) -> list[tuple[bytes, int]]:
    with open(path or public_tokenizers.path(RANK_FILE), "rb") as lines:
        return [(base64.b64decode(a), int(b)) for a, b in map(bytes.split, lines)]


@lru_cache(2)
def encoding(ranks: tuple[tuple[bytes, int], ...]) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=dict(ranks), special_tokens={})


def distinct_words(body: DataFrame) -> DataFrame:
    """(word, n): the corpus's pre-tokens (bytes) and their counts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        words: dict[int, bytes] = {}

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(words.values()), pa.binary()), pa.array([counts[h] for h in words], pa.int64())], ["word", "n"])
        for _, data, offsets in text_pieces(batches, "_text"):
            p = PreTokens(data, offsets)
            hashes, first, n = np.unique(p.hash, return_index=True, return_counts=True)
            raw = data.tobytes()
            for h, a, b, c in zip(hashes.tolist(), p.start[first].tolist(), p.end[first].tolist(), n.tolist()):
                if h in counts:
                    counts[h] += c
                else:
                    counts[h] = c
                    words[h] = raw[a:b]
            if len(words) > FLUSH_WORDS:
                yield rows()
                counts.clear()
                words.clear()
        yield rows()
    return body.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def word_ids(words: DataFrame, ranks: list[tuple[bytes, int]]) -> DataFrame:
    """(word, n, ids): every distinct word encoded once."""
    table = words.sparkSession.sparkContext.broadcast(tuple(ranks))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoding(table.value)._encode_single_piece
        for batch in batches:
            ids = [one(w) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(ids, pa.list_(pa.int32()))], ["word", "n", "ids"])
    return words.mapInArrow(encode, "word binary, n bigint, ids array<int>")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, n, ids): words by their hash as PreTokens gives it."""
    for batch in batches:
        own = batch.column("word").to_pylist()
        hashes = PreTokens(np.frombuffer(b"".join(own), np.uint8), np.cumsum([0, *map(len, own)])).hash
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), batch.column("n"), batch.column("ids")], ["h", "n", "ids"])


class HotWords:
    """Ids of the frequent words by hash and by rank, the most frequent first."""

    def __init__(self, rows: pa.Table):
        hashes = rows.column("h").to_numpy().view(np.uint64)
        lists = rows.column("ids").combine_chunks()
        ends = lists.offsets.to_numpy().astype(np.int64) if len(lists) else np.zeros(1, np.int64)
        by_rank = np.lexsort((hashes, -rows.column("n").to_numpy()))
        self.count = np.diff(ends)[by_rank].astype(np.int32)
        self.ids = lists.values.to_numpy()[scan.concat_ranges(ends[:-1][by_rank], self.count.astype(np.int64))] if len(lists) else np.zeros(0, np.int32)
        self.start = (np.cumsum(self.count, dtype=np.int64) - self.count).astype(np.int32)
        order = np.argsort(hashes[by_rank])
        self.hash, self.rank = hashes[by_rank][order], order.astype(np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of each hash, or -1."""
        if not len(self.hash) or not len(hashes):
            return np.full(len(hashes), -1)
        seen, back = np.unique(hashes, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hash, seen), len(self.hash) - 1)
        return np.where(self.hash[at] == seen, self.rank[at], -1)[back]


def write_codes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers under 2^21 as one to three bytes each, seven bits a byte, lowest first; and where each number's bytes end."""
    size = 1 + (values >= 1 << 7).astype(np.int64) + (values >= 1 << 14)
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(3):
        own = size > k
        out[ends[own] - size[own] + k] = ((values[own] >> (7 * k)) & 127) | ((size[own] > k + 1) << 7)
    return out, ends


def read_codes(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data < 128)
    first = np.append(0, last[:-1] + 1) if len(last) else last
    values = np.zeros(len(last), np.int64)
    for k in range(3):
        own = first + k <= last
        values[own] |= (data[first[own] + k] & 127).astype(np.int64) << (7 * k)
    return values


def split_hot(words: DataFrame, most: int = HOT_WORDS) -> tuple[DataFrame, DataFrame]:
    """The words of the highest counts, at most `most` of them, and the others: one count, which a small histogram gives, parts them."""
    level = F.floor(F.log2("n") * 4)
    total, cut = 0, None
    for row in sorted(words.groupBy(level.alias("level")).count().collect(), reverse=True):
        total += row["count"]
        if total > most:
            break
        cut = row["level"]
    if cut is None:
        return words.limit(0), words
    return words.where(level >= cut), words.where(level < cut)


def _met(docs: DataFrame, id_col: str, text: str, rank_path: str | None, most_hot: int) -> tuple[DataFrame, Broadcast]:
    """Every document's row of ranks, with the ids and positions of its rare words; and the table of the others."""
    spark, ranks = docs.sparkSession, read_ranks(rank_path)
    body = ship(docs).select(F.col(id_col).cast("bigint").alias("_doc"), F.coalesce(F.col(text), F.lit("")).alias("_text"), *row_key(F.col(id_col), F.col(text)))
    words = stored(word_ids(distinct_words(body.select("_text")), ranks), "words")
    frequent, others = split_hot(words, most_hot)
    hot = spark.sparkContext.broadcast(HotWords(frequent.mapInArrow(_hashed, "h bigint, n bigint, ids array<int>").toArrow()))

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches, "_text"):
            p = PreTokens(data, offsets)
            at = np.flatnonzero(hot.value.find(p.hash) < 0)
            doc = np.searchsorted(p.offsets, at, "right") - 1
            raw, take = data.tobytes(), pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [rows.column("_id").take(take), rows.column("_th").take(take), pa.array((at - p.offsets[doc]).astype(np.int32)),
                 pa.array([raw[a:b] for a, b in zip(p.start[at].tolist(), p.end[at].tolist())], pa.binary())], [*KEY, "at", "word"])

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(3)
        for rows, data, offsets in text_pieces(batches, "_text"):
            p = PreTokens(data, offsets)
            codes, ends = write_codes(hot.value.find(p.hash) + 1)
            ends = np.append(0, ends)[p.offsets]
            small = [squeeze.compress(codes[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([rows.column(c) for c in ("_doc", *KEY)] + [pa.array(small, pa.binary())], ["_doc", *KEY, "_z"])

    tails = (body.mapInArrow(rare, "_id bigint, _th bigint, at int, word binary").join(others.select("word", "ids"), "word")
             .groupBy(*KEY).agg(F.collect_list(F.struct("at", "ids")).alias("_tail")))
    none = F.array().cast("array<struct<at:int,ids:array<int>>>")
    return body.mapInArrow(ranked, "_doc bigint, _id bigint, _th bigint, _z binary").join(tails, KEY, "left").select("_doc", "_z", F.coalesce("_tail", none).alias("_tail")), hot


def _assemble(batches: Iterator[pa.RecordBatch], table: HotWords, rows_at_once: int = 300) -> Iterator[pa.RecordBatch]:
    """(_doc, ids) of documents that met their rare words."""
    widen = zstandard.ZstdDecompressor()
    for batch in batches:
        for first in range(0, batch.num_rows, rows_at_once):
            rows = batch.slice(first, rows_at_once)
            ranks = [read_codes(np.frombuffer(widen.decompress(z), np.uint8)) for z in rows.column("_z").to_pylist()]
            offsets = np.cumsum([0, *map(len, ranks)])
            place = np.concatenate(ranks) - 1
            rare = place < 0
            counts, starts = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
            counts[~rare], starts[~rare] = table.count[place[~rare]], table.start[place[~rare]]
            tail = rows.column("_tail")
            values = tail.flatten()
            own = values.field("ids")
            sizes = np.diff(own.offsets.to_numpy())
            doc = np.repeat(np.arange(rows.num_rows), np.diff(tail.offsets.to_numpy()))
            at = offsets[doc] + values.field("at").to_numpy()
            counts[at] = sizes
            starts[at] = np.cumsum(sizes) - sizes
            if (counts == 0).any():
                raise ValueError("a word has no ids")
            ids = np.empty(int(counts.sum()), np.int32)
            of_rare = np.repeat(rare, counts)
            ids[~of_rare] = table.ids[scan.concat_ranges(starts[~rare], counts[~rare])]
            ids[of_rare] = own.flatten().to_numpy()[scan.concat_ranges(starts[rare], counts[rare])]
            ends = np.append(0, np.cumsum(counts))[offsets]
            yield pa.RecordBatch.from_arrays([rows.column("_doc"), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))], ["_doc", "ids"])


def encode(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rank_path: str | None = None, most_hot: int = HOT_WORDS) -> DataFrame:
    """(id, ids array<int>): one row per row of `docs`."""
    met, hot = _met(docs, id_col, text, rank_path, most_hot)
    return met.mapInArrow(lambda batches: _assemble(batches, hot.value), "_doc bigint, ids array<int>").select(F.col("_doc").alias(id_col), "ids")


class TokenBytes:
    """The token-byte table as one array."""

    def __init__(self, ranks: list[tuple[bytes, int]]):
        parts = [b""] * (max((i for _, i in ranks), default=-1) + 1)
        for token, i in ranks:
            parts[i] = token
        self.size = np.array([len(t) for t in parts], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids one after another, and where each id's bytes end."""
        return self.data[scan.concat_ranges(self.start[ids], self.size[ids])], np.cumsum(self.size[ids])


def _id_pieces(batches: Iterator[pa.RecordBatch], size: int = 500_000) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows in pieces, with the ids of all their lists and the offsets of the rows."""
    for batch in batches:
        ends = np.cumsum([0, *(len(x) if x.is_valid else 0 for x in batch.column("ids"))])
        row = 0
        while row < batch.num_rows:
            stop = max(row + 1, int(np.searchsorted(ends, ends[row] + size, "right")) - 1)
            part = batch.slice(row, stop - row)
            yield part, part.column("ids").flatten().to_numpy(zero_copy_only=False), ends[row:stop + 1] - ends[row]
            row = stop


def decode(encoded: DataFrame, id_col: str = "doc_id", rank_path: str | None = None) -> DataFrame:
    """(id, decoded binary) of rows (id, ids)."""
    table = ship(encoded).sparkSession.sparkContext.broadcast(TokenBytes(read_ranks(rank_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, offsets in _id_pieces(batches):
            data, ends = table.value.decode(ids)
            ends = np.concatenate([[0], ends])[offsets]
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [rows.column("_doc"), pa.array([raw[a:b] for a, b in zip(ends[:-1], ends[1:])], pa.binary())], ["_doc", "decoded"])
    return (encoded.select(F.col(id_col).cast("bigint").alias("_doc"), "ids").mapInArrow(run, "_doc bigint, decoded binary")
            .select(F.col("_doc").alias(id_col), "decoded"))


def round_trip(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rank_path: str | None = None, most_hot: int = HOT_WORDS,
               keep_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every text encoded and its ids decoded, in one pass; with `keep_ids` also the ids."""
    met, hot = _met(docs, id_col, text, rank_path, most_hot)
    table = docs.sparkSession.sparkContext.broadcast(TokenBytes(read_ranks(rank_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal = [str(i) for i in range(len(table.value.size))]
        for rows, ids, offsets in _id_pieces(_assemble(batches, hot.value)):
            data, ends = table.value.decode(ids)
            ends = np.concatenate([[0], ends])[offsets]
            names = [decimal[i] for i in ids.tolist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column("_doc"), pa.array(np.diff(offsets), pa.int64()),
                 pa.array([hashlib.sha256(",".join(names[a:b]).encode()).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])]),
                 pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:])])] + [rows.column("ids")] * keep_ids,
                ["_doc", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids)
    extra = ", ids array<int>" if keep_ids else ""
    return met.mapInArrow(run, f"_doc bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string{extra}").withColumnRenamed("_doc", id_col)


def op7_bpe(docs: DataFrame) -> DataFrame:
    return round_trip(docs)
