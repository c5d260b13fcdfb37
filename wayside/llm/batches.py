"""Text columns as Arrow batches, and their words as numpy hash arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wayside.shipping import ship_package

#: Bytes of text that one numpy pass takes at most, unless a single text is longer.
PASS_BYTES = 1 << 20

SPACES = bytes([0x20, *range(0x09, 0x0E)])

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BYTE_VALUES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def by_batch(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """mapInArrow with the package on the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(work, schema)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty); any other column, whatever its name, stays behind."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def run_hashes(hashes: np.ndarray, of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k words in a row, within one text each, and where they start."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    whole = np.flatnonzero(of[:n] == of[k - 1 :])
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = total * _MULTIPLIER + hashes[i : i + n]
    return mix(total[whole]), whole


class Words:
    """Hashes of the words of several texts, in order.

    hashes: one per word; of: index of its text; first: index of the first word of
    each text, with one more entry for the end; starts, ends: byte range of the word in
    the UTF-8 bytes of its text.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: bytes = SPACES, lower: bool = True):
        n = len(data)
        apart = np.zeros(256, bool)
        apart[list(separators)] = True
        inside = ~apart[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.empty(n, bool)
        before[1:] = inside[:-1]
        before[:1] = False
        before &= ~edge[:n]
        begins = inside & ~before
        after = np.empty(n, bool)
        after[:-1] = inside[1:]
        after[n - 1 :] = False
        after &= ~edge[1:]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(inside & ~after) + 1
        if len(starts):
            place = np.arange(n)
            place -= np.maximum.accumulate(np.where(begins, place, 0))
            place[~inside] = 0
            powers = np.cumprod(np.full(int((ends - starts).max()) + 1, _MULTIPLIER, np.uint64))
            value = _BYTE_VALUES[_LOWER[data] if lower else data] * powers[place]
            value[~inside] = 0
            self.hashes = mix(np.add.reduceat(value, starts))
        else:
            self.hashes = np.empty(0, np.uint64)
        self.first = np.searchsorted(starts, offsets)
        self.of = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.starts = starts - offsets[:-1][self.of]
        self.ends = ends - offsets[:-1][self.of]

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and the words that have k before their text ends."""
        return run_hashes(self.hashes, self.of, k)

    def whole(self, text: int) -> int:
        """Hash of all words of one text, told apart from runs of another length."""
        total, (a, b) = 0, self.first[text : text + 2]
        for h in self.hashes[a:b].tolist():
            total = (total * int(_MULTIPLIER) + h) % 2**64
        return int(mix(np.array([total ^ (int(b - a) << 56)], np.uint64))[0])


def passes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about PASS_BYTES."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < n:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PASS_BYTES, "right")) - 1)
        yield row, data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        row = to
