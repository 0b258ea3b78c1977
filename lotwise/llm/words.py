"""Hashes of words and word n-grams of many texts at once, as array arithmetic.

Words are runs of bytes that a table of 256 entries does not map to 0. All rules
here separate words at ASCII bytes only, so working on UTF-8 bytes gives the same
words as working on characters. Hashes have 64 bits; equal words have equal hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_SPACES = [0x20, *range(0x09, 0x0E)]
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_CHUNK = 1 << 20


def _table(lower: bool) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[ord("A") : ord("Z") + 1] += 32
    return table


#: Words are runs without ASCII blanks; letters as they are, or A-Z in lower case.
PLAIN = _table(lower=False)
PLAIN[[0, *_SPACES]] = [1, *[0] * len(_SPACES)]  # byte 0 is part of a word; it shares the code of byte 1
LOWER = _table(lower=True)
LOWER[[0, *_SPACES]] = [1, *[0] * len(_SPACES)]

_rng = np.random.default_rng(20240131)
_BYTE = _rng.integers(1, 2**63, 257, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GRAM = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_arrays(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd multiplier and of its inverse modulo 2**64."""
    if len(_powers[0]) < size:
        for k, base in enumerate((_MULTIPLIER, pow(_MULTIPLIER, -1, 2**64))):
            column = np.full(size, base, np.uint64)
            column[0] = 1
            _powers[k] = np.multiply.accumulate(column)
    return _powers[0][:size], _powers[1][:size]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the offsets of the texts in them (one more than texts)."""
    counts = np.zeros(len(texts) + 1, np.int64)
    parts = []
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) < _CHUNK):
            size += len(texts[last]) + 1
            last += 1
        hashes, ends = _chunk_hashes(texts[first:last], table)
        parts.append(hashes)
        counts[first + 1 : last + 1] = np.diff(ends, prepend=0)
        first = last
    hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return hashes, np.cumsum(counts)


def _chunk_hashes(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    codes = table[raw]
    # The byte code of 0 and 1 must differ although both are inside words.
    inside = codes != 0
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _power_arrays(len(raw))
    values = _BYTE[codes]
    if len(zero := np.flatnonzero(raw == 0)):
        values[zero] = _BYTE[256]
    values *= power
    totals = np.cumsum(values)
    hashes = mix((totals[ends - 1] - totals[starts - 1]) * inverse[starts])
    text_ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    return hashes, np.searchsorted(starts, text_ends, side="right")


def grams(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each position on; the caller masks those that cross texts."""
    size = len(hashes) - width + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    if width > len(_GRAM):
        raise ValueError(f"at most {len(_GRAM)} words")
    total = np.zeros(size, np.uint64)
    for k in range(width):
        total += hashes[k : k + size] * _GRAM[k]
    return mix(total)


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) over ``width`` neighbours from each position on."""
    reach = 1
    while reach * 2 <= width:
        values = pick(values[:-reach], values[reach:]) if len(values) > reach else values[:0]
        reach *= 2
    rest = width - reach
    if rest:
        values = pick(values[:-rest], values[rest:]) if len(values) > rest else values[:0]
    return values


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts batches into pieces of about ``size`` bytes, at least one row each."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * size / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def with_columns(docs: DataFrame, schema: str, compute: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """``docs`` and the columns of ``schema`` that ``compute`` makes of each batch; columns of these names are replaced."""
    added = StructType.fromDDL(schema)
    rows = docs.drop(*added.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, *compute(batch)], [*batch.schema.names, *added.names])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, *added.fields]))


def chosen_texts(rows: DataFrame, limit: int) -> DataFrame:
    """(h, ...) of at most ``limit`` different texts of ``rows`` (text and any others), those with the smallest hashes.

    Only hashes are sorted; then one row of each chosen text stays, however often it occurs (the least values of the other columns).
    """
    hashed = rows.withColumn("h", F.xxhash64("text"))
    last = hashed.select("h").distinct().orderBy("h").limit(limit).agg(F.max("h")).first()[0]
    near = hashed.where(F.col("h") <= F.lit(last)) if last is not None else hashed.where(F.lit(False))
    return near.groupBy("h").agg(*[F.min(c).alias(c) for c in rows.columns])
