"""Vectorised words, hashes and word n-grams over Arrow batches of texts.

Texts are handled as UTF-8 bytes of a whole slice of a batch, so that no Python loop
runs over words. White space is space and the bytes 0x09 to 0x0D, which cannot be part
of a longer UTF-8 sequence. Hashes are polynomials over the bytes, modulo 2**64, passed
through a mixer; they depend on nothing but the bytes, so every task and every retry
gives the same values.
"""

from __future__ import annotations

import sys
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 2 << 20  # a longer text is a slice of its own

NEAR = 1 << 15  # bytes whose 64-bit values stay in the processor's cache

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))


class Cache(dict):
    """What a process has made for itself; it never travels with a job."""

    def __reduce__(self):
        return Cache, ()


_powers = Cache()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after another, and where each begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    _, starts, data = column.buffers()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    at = np.frombuffer(starts, np.int64 if wide else np.int32) if starts else np.zeros(1, np.int32)
    at = at[column.offset: column.offset + len(column) + 1].astype(np.int64)
    if not len(at):
        at = np.zeros(1, np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0]: at[-1]], at - at[0]


class Texts:
    """Some texts and what the operators need to know of them, made when first asked for."""

    def __init__(self, data: np.ndarray, at: np.ndarray, lower: bool = False):
        self.data = data | ((data - np.uint8(0x41) < 26).view(np.uint8) << np.uint8(5)) if lower else data
        self.at = at
        self.rows = len(at) - 1

    def per_row(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text the mask marks."""
        total = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return total[self.at[1:]] - total[self.at[:-1]]

    @cached_property
    def in_word(self) -> np.ndarray:
        return (self.data != 0x20) & (self.data - np.uint8(0x09) > 4)

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte and end of each word, and the first word of each text."""
        inside = self.in_word
        if not len(inside):
            empty = np.zeros(0, np.int64)
            return empty, empty, np.zeros(self.rows + 1, np.int64)
        border = np.zeros(len(inside) + 1, bool)
        border[self.at] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | border[1:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | border[1:-1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        return starts, ends, np.searchsorted(starts, self.at)

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.diff(self.words[2])

    @cached_property
    def sums(self) -> np.ndarray:
        """Running polynomial sum before each byte."""
        up, _ = powers(len(self.data))
        out = np.zeros(len(self.data) + 1, _U)
        for i in range(0, len(self.data), NEAR):
            part = np.take(_BYTE, self.data[i: i + NEAR])
            part *= up[i: i + NEAR]
            part[:1] += out[i: i + 1]
            np.cumsum(part, out=out[i + 1: i + 1 + len(part)])
        return out

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of byte spans; equal bytes give equal hashes wherever they stand."""
        _, down = powers(len(self.data) + 1)
        value = (self.sums[ends] - self.sums[starts]) * down[starts]
        return mix(value + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))

    def run_hash(self, n: int) -> np.ndarray:
        """Hashes of all runs of ``n`` bytes."""
        if len(self.data) < n:
            return np.zeros(0, _U)
        _, down = powers(len(self.data))
        value = self.sums[n:] - self.sums[:-n]
        value *= down[: len(value)]
        value ^= value >> _U(29)
        value *= _U(0xBF58476D1CE4E5B9)
        value ^= value >> _U(32)
        return value

    @cached_property
    def word_hash(self) -> np.ndarray:
        return self.span_hash(*self.words[:2])

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.n_words)

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of runs of ``n`` words within a text, and the word each begins at."""
        h, first = self.word_hash, self.words[2]
        if len(h) < n:
            return np.zeros(0, _U), np.zeros(0, np.int64)
        last = np.repeat(first[1:], self.n_words)  # end of the text each word is in
        begin = np.flatnonzero(np.arange(len(h)) + n <= last)
        value = np.full(len(begin), n, _U)
        for k in range(n):
            value = (value ^ h[begin + k]) * _U(_BASE) + _U(k)
            value ^= value >> _U(29)
        return mix(value), begin


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES):
    """Cut a batch between rows so that each part holds about ``limit`` bytes of text."""
    _, at = unpack(batch.column(batch.schema.get_field_index(column)))
    row = 0
    while row < batch.num_rows:
        end = int(np.searchsorted(at, at[row] + limit, "right")) - 1
        end = min(max(end, row + 1), batch.num_rows)
        yield batch.slice(row, end - row)
        row = end


def texts(batch: pa.RecordBatch, column: str = "text", lower: bool = False) -> Texts:
    return Texts(*unpack(batch.column(batch.schema.get_field_index(column))), lower=lower)


_chosen = {"10000"}  # Spark's default, and what was set here


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """Have Spark hand texts to Python in batches of few rows.

    The default of 10,000 rows is meant for numbers; so many texts would take more memory
    than the work on them. A session that sets another number keeps it.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(setting) in _chosen:
        _chosen.add(str(rows))
        df.sparkSession.conf.set(setting, str(rows))
    return df


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
