"""Helpers of the llm operators: packed word hashes and a filter of bounded size.

Word and shingle hashes are computed for whole Arrow batches at once. A word's hash is a polynomial over its bytes, taken
from prefix sums modulo 2**64 (the base is odd, so a power can be undone), and then mixed; a shingle folds its words'
hashes in order. Text is cut into slices of ``SLICE_BYTES``, so memory follows the slice and the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 2_000_000
SPACE = bytes(b"\x20\x09\x0a\x0b\x0c\x0d")
#: All ASCII bytes but letters and digits.
PUNCTUATION = bytes(b for b in range(128) if not chr(b).isalnum())
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@cache
def _byte_values() -> np.ndarray:
    """One odd 64-bit value per byte; A-Z share those of a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
    values[65:91] = values[97:123]
    return values


_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, size: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or table.size < size:
        table = np.full(max(size, SLICE_BYTES + 1), base, dtype=np.uint64)
        table[0] = 1
        _powers[base] = table = np.cumprod(table, dtype=np.uint64)
    return table[:size]


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, byte offsets starting at 0, bytes) of runs of up to ``most`` texts of at most ``limit`` bytes, or of one longer text.

    A null counts as an empty text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offset_buffer, data = texts.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    content = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), row + most, len(texts))
        yield row, offsets[row : end + 1] - offsets[row], content[offsets[row] : offsets[end]]
        row = end


def word_spans(offsets: np.ndarray, content: np.ndarray, between: bytes = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word (runs of bytes other than ``between``; texts are apart)."""
    blank = np.zeros(256, dtype=bool)
    blank[list(between)] = True
    inside = ~blank[content]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < content.size)]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(content: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, A-Z lower-cased."""
    sums = np.zeros(content.size + 1, dtype=np.uint64)
    np.cumsum(_byte_values()[content] * _power_table(_BASE, content.size), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power_table(_INVERSE, content.size + 1)[starts])


def fold(words: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words that begin at each position of ``first``."""
    out = words[first] + np.uint64(length)
    for step in range(1, length):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + words[first + step])
    return mix(out)


def shingles(offsets: np.ndarray, content: np.ndarray, size: int, between: bytes = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word shingle in text order; a text of fewer words gives its whole sequence, if any."""
    starts, ends, rows = word_spans(offsets, content, between)
    words = word_hashes(content, starts, ends)
    counts = np.bincount(rows, minlength=offsets.size - 1)
    first = np.cumsum(counts) - counts
    if words.size >= size:
        whole = np.flatnonzero(rows[: words.size - size + 1] == rows[size - 1 :])
    else:
        whole = np.empty(0, dtype=np.int64)
    parts = [(rows[whole], fold(words, whole, size))]
    for length in range(1, size):
        short = np.flatnonzero(counts == length)
        if short.size:
            parts.append((short, fold(words, first[short], length)))
    if len(parts) == 1:
        return parts[0]
    row, value = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(row, kind="stable")
    return row[order], value[order]


def distinct_sorted(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (row, value) pairs by row and value."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    fresh = np.ones(rows.size, dtype=bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[fresh], values[fresh]


def packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary column: row i holds the bytes of ``values[bounds[i]:bounds[i + 1]]``."""
    width = values.dtype.itemsize
    data = np.ascontiguousarray(values).view(np.uint8)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), bounds.size - 1, [None, pa.py_buffer((bounds * width).astype(np.int64)), pa.py_buffer(data)]
    ).cast(pa.binary())


def mark_probable(frame: DataFrame, key: Column, keys: DataFrame, bits: int, name: str) -> DataFrame:
    """Add boolean ``name``: false only if ``key`` is surely not among ``keys`` (one column), at most ``bits`` / 64 rows broadcast.

    ``keys`` set bits of a table of fixed size, which is broadcast whatever the input's size. Beyond a tenth of ``bits``
    keys more rows are marked in vain; that costs the caller time and never changes a result.
    """
    if bits % 64:
        raise ValueError("The number of bits must be a multiple of 64")
    place = F.pmod(F.xxhash64(keys[keys.columns[0]]), F.lit(bits))
    words = (
        keys.select(place.alias("__place"))
        .groupBy((F.col("__place") / 64).cast("long").alias("__slot"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(__place % 64 as int))")).alias("__bits"))
    )
    placed = frame.withColumn("__at", F.pmod(F.xxhash64(key), F.lit(bits)))
    found = placed.join(F.broadcast(words), (F.col("__at") / 64).cast("long") == F.col("__slot"), "left")
    bit = F.expr("coalesce(getbit(__bits, cast(__at % 64 as int)) = 1, false)")
    return found.withColumn(name, bit).drop("__at", "__slot", "__bits")


def in_draw(key: Column, total: Column, wanted: int) -> Column:
    """A deterministic draw of about ``4 * wanted`` of ``total`` rows by key hash (all, if there are fewer).

    It is taken before the exact choice of ``wanted`` rows, so what meets in one task doesn't grow with the input.
    """
    share = F.least(F.lit(1.0), F.lit(4.0 * wanted) / total)
    return F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 30)) < share * F.lit(float(1 << 30))


def shuffle_width(frame: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
