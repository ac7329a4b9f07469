"""Edit-aware token counts: a segment tree over the pre-tokens of every document.

A leaf is a pre-token with its length and its number of tokens; leaves lie in blocks of BLOCK and a binary tree sums the blocks, so
the document's count is the root. An edit re-reads from the last pre-token that cannot have seen it (a pre-token depends on nothing
further than one character behind its end) until a border falls on an old border behind the edit: from there on old and new
text split alike. Only these pre-tokens are encoded again, their leaves replaced and the sums above them updated.

Edits are an array column of structs (at, cut, put) in code points: cut characters at `at` are replaced by `put`, one edit after
another on the result so far. Positions and lengths outside the text are clipped to it. Trees can be kept as a table (the text and
its leaves); later edits (`apply_edits`) start from there.

Edge cases: NULL and empty texts are a tree without leaves and count 0; NULL edits, and an edit with a NULL position, change nothing; NULL cut or put
are 0 and ''; repeated rows and NULL ids are documents of their own; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstats.llm.bpe import encoding, read_ranks
from snapstats.llm.common import ship, stored, text_pieces
from snapstats.llm.pretokens import PreTokens

BLOCK = 64
CACHE_WORDS = 1_000_000
# The module's \s takes four separator characters that the tokenizer's does not.
SPLIT = regex.compile(public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]")
                      .replace(r"\s+(?!\S)|\s+", r"\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"))


class Tree:
    """Sums over the pre-tokens of one text."""

    def __init__(self, text: str, lengths: np.ndarray, counts: np.ndarray, count: Callable[[str], int]):
        self.count, self.encoded = count, 0
        n = max(1, -(-len(lengths) // BLOCK))
        edges = np.arange(0, len(lengths), BLOCK)
        chars = np.add.reduceat(lengths, edges) if len(lengths) else np.zeros(1, np.int64)
        tokens = np.add.reduceat(counts, edges) if len(lengths) else np.zeros(1, np.int64)
        self.lengths = [lengths[i * BLOCK:(i + 1) * BLOCK] for i in range(n)]
        self.counts = [counts[i * BLOCK:(i + 1) * BLOCK] for i in range(n)]
        ends = np.cumsum(chars).tolist()
        self.texts = [text[a:b] for a, b in zip([0, *ends], ends)]
        self.size = 1 << (n - 1).bit_length()
        self.chars, self.tokens = (self._sums(x) for x in (chars, tokens))

    def _sums(self, leaves: np.ndarray) -> list[int]:
        level = np.zeros(self.size, np.int64)
        level[:len(leaves)] = leaves
        levels = [level]
        while len(level) > 1:
            level = level.reshape(-1, 2).sum(axis=1)
            levels.append(level)
        return [0, *np.concatenate(levels[::-1]).tolist()]

    def total(self) -> int:
        return self.tokens[1]

    def _leaf(self, at: int) -> tuple[int, int, int]:
        """Block, leaf in it and start of the pre-token that holds position `at` (the place behind all of them at the end)."""
        if at >= self.chars[1]:
            last = len(self.texts) - 1
            return last, len(self.lengths[last]), self.chars[1]
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if at - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        block = node - self.size
        for k, n in enumerate(self.lengths[block].tolist()):
            if at < start + n:
                return block, k, start
            start += n
        raise AssertionError("sums do not fit the leaves")

    def _block_start(self, block: int) -> int:
        node, start = block + self.size, 0
        while node > 1:
            if node & 1:
                start += self.chars[node - 1]
            node >>= 1
        return start

    def text(self, a: int, b: int) -> str:
        if a >= b:
            return ""
        block = self._leaf(a)[0]
        start, parts = self._block_start(block), []
        while block < len(self.texts) and start < b:
            own = self.texts[block]
            parts.append(own[max(0, a - start):b - start])
            start += len(own)
            block += 1
        return "".join(parts)

    def _borders(self, at: int) -> Iterator[tuple[int, int, int]]:
        """(position, block, leaf) of the old borders from `at` on, each before the leaf named."""
        block, leaf, start = self._leaf(at)
        if start >= at:
            yield start, block, leaf
        while block < len(self.lengths):
            own = self.lengths[block]
            for k in range(leaf, len(own)):
                start += int(own[k])
                if start >= at:
                    yield start, block, k + 1
            block, leaf = block + 1, 0

    def edit(self, at: int, cut: int, put: str) -> None:
        n = self.chars[1]
        at = min(max(at, 0), n)
        end = min(at + max(cut, 0), n)
        if at == end and not put:
            return
        b0, leaf0, restart = self._leaf(min(max(at - 2, 0), max(n - 1, 0)))
        head = self.text(restart, at) + put
        width = 64
        while True:
            reach = min(end + width, n)
            text, complete = head + self.text(end, reach), reach == n
            borders = self._borders(end)
            border = next(borders)
            made, synced = [], None
            if not text:
                synced = border
            for m in SPLIT.finditer(text):
                # A match that comes near the end of what was read could be longer.
                if not complete and m.end() + 2 > len(text):
                    break
                made.append(m[0])
                old = m.end() - len(head) + end
                while border[0] < old:
                    border = next(borders, (n + 1, 0, 0))
                if m.end() >= len(head) and border[0] == old:
                    synced = border
                    break
            if synced:
                break
            width *= 8
        position, b1, leaf1 = synced
        lengths = np.array([len(p) for p in made], np.int64)
        counts = np.array([self.count(p) for p in made], np.int64)
        self.encoded += len(made)
        before = self.texts[b0][:restart - self._block_start(b0)]
        after = self.texts[b1][position - self._block_start(b1):]
        self.texts[b0], tail = before + "".join(made) + after, (self.lengths[b1][leaf1:], self.counts[b1][leaf1:])
        self.lengths[b0] = np.concatenate([self.lengths[b0][:leaf0], lengths, tail[0]])
        self.counts[b0] = np.concatenate([self.counts[b0][:leaf0], counts, tail[1]])
        for b in range(b0 + 1, b1 + 1):
            self.texts[b], self.lengths[b], self.counts[b] = "", self.lengths[b][:0], self.counts[b][:0]
        for b in range(b0, b1 + 1):
            node = b + self.size
            self.chars[node], self.tokens[node] = len(self.texts[b]), int(self.counts[b].sum())
            while node > 1:
                node >>= 1
                self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
                self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]


class Counter:
    """Tokens of a pre-token, each distinct one encoded once while it is remembered."""

    def __init__(self, ranks):
        self.one, self.known = encoding(ranks)._encode_single_piece, {}

    def of_text(self, piece: str) -> int:
        return len(self.one(piece))

    def of_all(self, p: PreTokens, raw: bytes) -> np.ndarray:
        hashes, first, back = np.unique(p.hash, return_index=True, return_inverse=True)
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known, counts = self.known, []
        for h, a, b in zip(hashes.tolist(), p.start[first].tolist(), p.end[first].tolist()):
            n = known.get(h)
            if n is None:
                n = known[h] = len(self.one(raw[a:b]))
            counts.append(n)
        return np.array(counts, np.int64)[back] if counts else np.zeros(0, np.int64)


def _apply(rows: pa.RecordBatch, trees: Iterator[Tree], keep_trees: bool) -> pa.RecordBatch:
    """The edits of every row applied to its tree."""
    out = []
    for tree, changes in zip(trees, rows.column("_edits").to_pylist()):
        before = tree.total()
        for change in changes or ():
            if change is not None and change["at"] is not None:
                tree.edit(change["at"], change["cut"] or 0, change["put"] or "")
        row = [before, tree.total(), sum(map(len, tree.counts)), tree.encoded]
        if keep_trees:
            row += ["".join(tree.texts), np.concatenate(tree.lengths), np.concatenate(tree.counts)]
        out.append(row)
    kinds = [pa.int64()] * 4 + ([pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())] if keep_trees else [])
    names = ["n_before", "n_tokens", "n_pretokens", "n_encoded"] + (["text", "lengths", "counts"] if keep_trees else [])
    carried = ["carried"] if "carried" in rows.schema.names else []
    return pa.RecordBatch.from_arrays([rows.column("_doc"), *(rows.column(c) for c in carried), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))],
                                      ["_doc", *carried, *names])


def _picked(docs: DataFrame, edits: Column, id_col: str, carry: Column | None, **more: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("_doc"), edits.cast("array<struct<at:int,cut:int,put:string>>").alias("_edits"),
                       *(F.col(c).alias(name) for name, c in more.items()), *([] if carry is None else [carry.alias("carried")]))


def _schema(picked: DataFrame, keep_trees: bool) -> str:
    carried = f", carried {picked.schema['carried'].dataType.simpleString()}" if "carried" in picked.columns else ""
    return (f"_doc bigint{carried}, n_before bigint, n_tokens bigint, n_pretokens bigint, n_encoded bigint"
            + (", text string, lengths array<int>, counts array<int>" if keep_trees else ""))


def edited_counts(docs: DataFrame, edits: Column, id_col: str = "doc_id", text: str = "text", rank_path: str | None = None,
                  keep_trees: bool = False, carry: Column | None = None) -> DataFrame:
    """One row per row of `docs`: id, n_before, n_tokens (after the edits), n_pretokens, n_encoded (pre-tokens encoded again); with
    `keep_trees` also the edited text and its leaves, lengths and counts, for `apply_edits`. `carry` is returned as `carried`.
    """
    table = ship(docs).sparkSession.sparkContext.broadcast(tuple(read_ranks(rank_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(table.value)
        for rows, data, offsets in text_pieces(batches, "_text"):
            p = PreTokens(data, offsets)
            raw = data.tobytes()
            counts = counter.of_all(p, raw)
            yield _apply(rows, (Tree(raw[offsets[d]:offsets[d + 1]].decode(), p.points[own], counts[own], counter.of_text)
                                for d in range(rows.num_rows) for own in (slice(p.offsets[d], p.offsets[d + 1]),)), keep_trees)

    picked = _picked(docs, edits, id_col, carry, _text=text)
    return picked.mapInArrow(run, _schema(picked, keep_trees)).withColumnRenamed("_doc", id_col)


def apply_edits(kept: DataFrame, edits: Column, id_col: str = "doc_id", rank_path: str | None = None, keep_trees: bool = False,
                carry: Column | None = None) -> DataFrame:
    """Edits on trees kept by an earlier call: columns as of `edited_counts`, whose text, lengths and counts `kept` has.

    The sums are rebuilt from the leaves and nothing is split or encoded but what the edits touch. A row whose leaves are NULL
    or do not make up its text has no tree; its text is encoded whole, which n_encoded counts.
    """
    table = ship(kept).sparkSession.sparkContext.broadcast(tuple(read_ranks(rank_path)))

    def grown(data: np.ndarray, counter: Counter) -> Tree:
        p = PreTokens(data, np.array([0, len(data)]))
        tree = Tree(data.tobytes().decode(), p.points, counter.of_all(p, data.tobytes()), counter.of_text)
        tree.encoded = len(p.points)
        return tree

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(table.value)

        def trees(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> Iterator[Tree]:
            for d, (lengths, counts) in enumerate(zip(rows.column("_lengths"), rows.column("_counts"))):
                part = data[offsets[d]:offsets[d + 1]]
                own = part.tobytes().decode()
                if lengths.values is None or counts.values is None or lengths.values.null_count or counts.values.null_count:
                    yield grown(part, counter)
                    continue
                n, tokens = (x.values.to_numpy(zero_copy_only=False).astype(np.int64) for x in (lengths, counts))
                fits = len(n) == len(tokens) and n.sum() == len(own) and (n > 0).all()
                yield Tree(own, n, tokens, counter.of_text) if fits else grown(part, counter)

        for rows, data, offsets in text_pieces(batches, "_text"):
            yield _apply(rows, trees(rows, data, offsets), keep_trees)

    picked = _picked(kept, edits, id_col, carry, _text="text", _lengths="lengths", _counts="counts")
    return picked.mapInArrow(run, _schema(picked, keep_trees)).withColumnRenamed("_doc", id_col)


def op5_token_counts(docs: DataFrame) -> DataFrame:
    """Counts of every document before and after three edits that its own row gives: a source line in the middle, then, on the
    stored trees, a cut of 40 characters at a quarter and the language put before the text."""
    n = F.length("text")
    first = F.array(F.struct(F.floor(n / 2).alias("at"), F.lit(0).alias("cut"), F.concat(F.lit("\nSource: "), F.col("source"), F.lit("\n")).alias("put")))
    trees = stored(edited_counts(docs, first, keep_trees=True, carry=F.struct(n.alias("n"), F.col("lang").alias("lang"))), "trees", "zstd")
    later = F.array(
        F.struct(F.floor(F.col("carried.n") / 4).alias("at"), F.lit(40).alias("cut"), F.lit("").alias("put")),
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("cut"), F.concat(F.col("carried.lang"), F.lit(": ")).alias("put")))
    return apply_edits(trees, later, carry=F.struct("n_before", "n_encoded")).select(
        "doc_id", F.col("carried.n_before").alias("n_before"), "n_tokens", "n_pretokens", (F.col("carried.n_encoded") + F.col("n_encoded")).alias("n_encoded"))
