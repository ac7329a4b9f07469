"""Fill-in-the-middle documents: a text cut in three, its middle moved to the end behind markers.

Texts are cut between units: tokens (a run of ASCII letters, or any other single character) or characters. Everything happens on the
UTF-8 bytes of many texts at once. Between bytes and code points stands a sparse index: it records the position and the excess bytes of
multibyte characters only, so one binary search converts a cut either way and ASCII stretches in between are plain arithmetic.

Forms: `psm` is <P>prefix<S>suffix<M>middle, `spm` is <S>suffix<P>prefix<M>middle, `plain` is the text as it was. A text that is empty or
holds a marker stays plain, so the others can be rebuilt from output and form alone; `restored` does that with SQL functions.

A text's choices come from the SHA-256 of `<epoch>:<id>`, so a run can be repeated and another epoch cuts elsewhere. Edge cases: NULL texts
count as empty; a NULL id is hashed as the empty string; very long texts are one piece of array work, about 12 bytes a byte; repeated rows
give repeated results; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import ship, text_pieces

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MOVED_PERCENT = 90
SPM_PERCENT = 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


class ExceptionIndex:
    """Multibyte characters of a byte array: where they are, and how many bytes beyond one each they and all before them take."""

    def __init__(self, data: np.ndarray):
        self.bytes_at = np.flatnonzero(data >= 0xC0)
        lead = data[self.bytes_at]
        self.excess = np.concatenate([[0], np.cumsum(1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0))])
        self.points_at = self.bytes_at - self.excess[:-1]

    def to_points(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before each byte position (of a character's first byte)."""
        return cuts - self.excess[np.searchsorted(self.bytes_at, cuts)]

    def to_bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Byte position of each code point number."""
        return cuts + self.excess[np.searchsorted(self.points_at, cuts)]


def token_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where a token begins; a token does not reach over a text's end."""
    letter = _LETTER[data]
    start = (data & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    start[inner] = True
    return np.flatnonzero(start)


def _cut(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: units, byte positions and code point numbers (rows: begin, first cut, second cut) in the whole array."""
    index = ExceptionIndex(data)
    begin, end = offsets[:-1], offsets[1:]
    if unit == "token":
        starts = np.append(token_starts(data, offsets), len(data))
        first = np.searchsorted(starts, begin)
        n = np.searchsorted(starts, end) - first
    else:
        first = index.to_points(begin)
        n = index.to_points(end) - first
    chosen = np.sort(draws % (n + 1), axis=0)
    at = first + np.vstack([np.zeros_like(n), chosen])
    if unit == "token":
        cuts = np.where(at < first + n, starts[np.minimum(at, len(starts) - 1)], end)
        return n, cuts, index.to_points(cuts)
    return n, index.to_bytes(at), at


def draws(id_col: Column, epoch: int = 1) -> list[Column]:
    """Four numbers of 32 bits from the hash of epoch and id."""
    digest = F.sha2(F.concat(F.lit(f"{epoch}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text: str = "text", epoch: int = 1, unit: str = "token",
                   moved_percent: int = MOVED_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output): one row per row of `docs`; the lengths (code points) are NULL for plain rows."""
    if unit not in ("token", "char"):
        raise ValueError(f"unit must be token or char, not {unit}")
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches, "_text"):
            two = np.vstack([rows.column(f"_h{k}").to_numpy() for k in (1, 2)])
            n, cuts, points = _cut(data, offsets, two, unit)
            wanted = rows.column("_form").to_pylist()
            raw = data.tobytes()
            forms, outputs = [], []
            for form, a, b, c, d in zip(wanted, *cuts.tolist(), offsets[1:].tolist()):
                body = raw[a:d]
                if form == "plain" or not body or any(mark in body for mark in marks):
                    forms.append("plain")
                    outputs.append(body)
                    continue
                prefix, middle, suffix = raw[a:b], raw[b:c], raw[c:d]
                forms.append(form)
                outputs.append(b"".join((p, prefix, s, suffix, m, middle) if form == "psm" else (s, suffix, p, prefix, m, middle)))
            plain = np.array([f == "plain" for f in forms])
            yield pa.RecordBatch.from_arrays(
                [rows.column("_doc"), pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(points[1] - points[0], pa.int64(), mask=plain),
                 pa.array(points[2] - points[1], pa.int64(), mask=plain), pa.array([o.decode() for o in outputs], pa.string())],
                ["_doc", "n", "form", "prefix_chars", "middle_chars", "output"])

    h = draws(F.col(id_col), epoch)
    form = F.when(h[2] % 100 >= moved_percent, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    return (ship(docs).select(F.col(id_col).cast("bigint").alias("_doc"), F.col(text).alias("_text"), h[0].alias("_h1"), h[1].alias("_h2"), form.alias("_form"))
            .mapInArrow(run, "_doc bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
            .withColumnRenamed("_doc", id_col))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    part = F.split(output, "<[PSM]>", -1)
    return (F.when(form == "plain", output).when(form == "psm", F.concat(part[1], part[3], part[2])).otherwise(F.concat(part[2], part[3], part[1])))


def op12_fill_in_middle(docs: DataFrame) -> DataFrame:
    return fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


def oracle() -> str:
    """DuckDB SQL for op12_fill_in_middle."""
    return """
WITH token AS (
    SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
    FROM documents),
drawn AS (
    SELECT doc_id, body, tokens, len(tokens) AS n,
           CAST('0x' || digest[1:8] AS BIGINT) % (len(tokens) + 1) AS u, CAST('0x' || digest[9:16] AS BIGINT) % (len(tokens) + 1) AS v,
           CAST('0x' || digest[17:24] AS BIGINT) % 100 AS moved, CAST('0x' || digest[25:32] AS BIGINT) % 100 AS turned
    FROM token),
parts AS (
    SELECT doc_id, n, body,
           CASE WHEN body = '' OR regexp_matches(body, '<[PSM]>') OR moved >= 90 THEN 'plain' WHEN turned < 20 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(tokens[1:least(u, v)], '') AS head, array_to_string(tokens[least(u, v) + 1:greatest(u, v)], '') AS middle,
           array_to_string(tokens[greatest(u, v) + 1:], '') AS tail
    FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(head) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || middle
                        ELSE '<S>' || tail || '<P>' || head || '<M>' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts"""
