"""Removal of passages that occur more than once, with a count-min prefilter.

A window is ``width`` consecutive words of one document. The key of a window is the smallest
hash of its 8-word grams, so equal windows have equal keys, and the places where keys sit are
few. The first pass counts these places in sketches, one per task, which are merged: the
count of a window's key is never below that of the window. The second pass takes only windows
whose key is estimated repeated and groups them exactly. Too small a sketch costs time, not results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm import words as W
from lotwise.sources.staging import stage

#: Words of the grams that give a window its key.
GRAM = 8
#: Sketch: rows, and cells of a row. A table of K keys gets 8 K cells, at most 2**MAX_BITS (128 MB for both rows).
ROWS = 2
MIN_BITS, MAX_BITS = 20, 29
#: Windows that a task groups at once; bytes of text that it hashes at once, and of a batch that it sends.
FLUSH = 1 << 18
SLICE, SENT = 2 << 20, 4 << 20


def _cells(keys: np.ndarray, row: int) -> np.ndarray:
    """Cell at the finest width; a coarser sketch drops low bits."""
    return (W.mix(keys + np.uint64(row * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(64 - MAX_BITS)).astype(np.int64)


def _keys(hashes: np.ndarray, offsets: np.ndarray, width: int):
    """Starts of all windows, their keys, and the keys at the places where they sit (each place once)."""
    size = len(hashes) - width + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    inside = np.zeros(size + 1, np.int64)
    first, last = offsets[:-1], offsets[1:] - width + 1
    full = last > first
    inside[first[full]] += 1
    inside[last[full]] -= 1
    inside = np.cumsum(inside[:-1]) > 0
    gram = W.grams(hashes, min(GRAM, width))
    reach = width - min(GRAM, width) + 1
    least = W.sliding(gram, reach, np.minimum)
    valid = np.where(inside, least, np.uint64(0))
    # A gram is a place if a window over it has that gram's hash as its least one.
    padded = np.concatenate([np.zeros(reach - 1, np.uint64), valid, np.zeros(reach - 1, np.uint64)])
    place = (W.sliding(padded, reach, np.maximum) == gram) & (gram > 0)
    return np.flatnonzero(inside), least[inside], gram[place]


def _sketch_pass(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            every = np.concatenate(keys)
            out = {"row": [], "segment": [], "cells": [], "keys": []}
            for row in range(ROWS):
                cells, counts = np.unique(_cells(every, row), return_counts=True)
                packed = (cells << 1 | (counts > 1)).astype(np.uint32)
                segment = cells >> (MAX_BITS - 6)
                cuts = np.searchsorted(segment, np.arange(65))
                for k in range(64):
                    out["row"].append(row)
                    out["segment"].append(k)
                    out["cells"].append(packed[cuts[k] : cuts[k + 1]].tobytes())
                    out["keys"].append(int(cuts[k + 1] - cuts[k]) if row == 0 else 0)
            return pa.RecordBatch.from_pydict({
                "row": pa.array(out["row"], pa.int32()), "segment": pa.array(out["segment"], pa.int32()),
                "cells": pa.array(out["cells"], pa.binary()), "keys": pa.array(out["keys"], pa.int64()),
            })

        for batch in W.slices(batches, SLICE):
            hashes, offsets = W.word_hashes(W.texts_of(batch.column("text")), W.PLAIN)
            keys.append(_keys(hashes, offsets, width)[2])
            held += len(keys[-1])
            if held > FLUSH:
                yield flush()
                keys, held = [], 0
        if held:
            yield flush()

    return run


def _merge_sketch(bits: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The repeated cells of each segment as a bitmap, whose size is that of the sketch."""
        held: dict[tuple[int, int], list[np.ndarray]] = {}
        for frame in frames:
            for row, segment, blob in zip(frame["row"], frame["segment"], frame["cells"]):
                held.setdefault((row, segment), []).append(np.frombuffer(blob, np.uint32))
        for (row, segment), parts in held.items():
            packed = np.concatenate(parts)
            cells = (packed >> 1 >> (MAX_BITS - bits)).astype(np.int64) - (segment << (bits - 6))
            counts = np.bincount(cells, weights=1 + (packed & 1), minlength=1 << (bits - 6))
            yield pd.DataFrame({"row": [row], "segment": [segment], "bitmap": [np.packbits(counts > 1, bitorder="little").tobytes()]})

    return run


def _window_pass(width: int, sketch, bits: int, buckets: int):
    """(bucket, hashes, docs, starts): windows estimated repeated; those repeated within the task come once, without a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = [np.frombuffer(b, np.uint8) for b in sketch.value]
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            h, d, s = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(h, kind="stable")
            h, d, s = h[order], d[order], s[order]
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            heads = np.flatnonzero(new)
            many = np.diff(heads, append=len(h)) > 1
            local = np.repeat(many, np.diff(heads, append=len(h)))
            names, starts, ends = _runs(d[local], s[local], width)
            h, d, s = h[new], np.where(many, 0, d[new]), np.where(many, -1, s[new]).astype(np.int32)
            where = (h >> np.uint64(40)).astype(np.int64) % buckets
            order = np.argsort(where, kind="stable")
            h, d, s, where = h[order], d[order], s[order], where[order]
            ids, firsts = np.unique(where, return_index=True)
            cuts = [*firsts.tolist(), len(h)]
            spans = list(zip(cuts, cuts[1:]))
            return pa.RecordBatch.from_pydict({
                "bucket": pa.array([*ids.tolist(), -1], pa.int64()),
                "hashes": pa.array([*(h[a:b].tobytes() for a, b in spans), names.tobytes()], pa.binary()),
                "docs": pa.array([*(d[a:b].tobytes() for a, b in spans), starts.tobytes()], pa.binary()),
                "starts": pa.array([*(s[a:b].tobytes() for a, b in spans), ends.tobytes()], pa.binary()),
            })

        for batch in W.slices(batches, SLICE):
            hashes, offsets = W.word_hashes(W.texts_of(batch.column("text")), W.PLAIN)
            at, keys, _ = _keys(hashes, offsets, width)
            likely = np.ones(len(at), bool)
            for row, bitmap in enumerate(bitmaps):
                cells = _cells(keys, row) >> (MAX_BITS - bits)
                likely &= (bitmap[cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)
            at = at[likely]
            if len(at):
                document = np.searchsorted(offsets, at, side="right") - 1
                rows = np.asarray(batch.column("key").to_numpy(zero_copy_only=False), np.int64)
                held.append((W.grams(hashes, width)[at], rows[document], (at - offsets[document]).astype(np.int32)))
                size += len(at)
            if size > FLUSH:
                yield from W.slices(iter([flush()]), SENT)
                held, size = [], 0
        if size:
            yield from W.slices(iter([flush()]), SENT)

    return run


def _runs(docs: np.ndarray, starts: np.ndarray, width: int):
    """(document, first word, word after the last) of the union of windows."""
    order = np.lexsort((starts, docs))
    docs, starts = docs[order], starts[order].astype(np.int64)
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (starts[1:] > starts[:-1] + width)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(docs)) - 1 if len(docs) else heads
    return docs[heads], starts[heads], starts[tails] + width


def _group_windows(width: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Runs of words covered by windows that another task, or this one, has seen elsewhere."""
        held: dict[int, list] = {}
        for frame in frames:
            for bucket, *blobs in zip(frame["bucket"], frame["hashes"], frame["docs"], frame["starts"]):
                held.setdefault(bucket, []).append(
                    (np.frombuffer(blobs[0], np.uint64), np.frombuffer(blobs[1], np.int64), np.frombuffer(blobs[2], np.int32))
                )
        for parts in held.values():
            h, d, s = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h, kind="stable")
            h, d, s = h[order], d[order], s[order]
            heads = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            sizes = np.diff(heads, append=len(h))
            repeated = np.repeat((sizes > 1) | (np.minimum.reduceat(s, heads) < 0), sizes) & (s >= 0)
            docs, starts, ends = _runs(d[repeated], s[repeated], width)
            yield pd.DataFrame({"key": docs, "first": starts, "last": ends})

    return run


def _unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for blobs in zip(frame["hashes"], frame["docs"], frame["starts"]):
            key, first, last = (np.frombuffer(b, np.int64) for b in blobs)
            yield pd.DataFrame({"key": key, "first": first, "last": last})


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        kept, words, removed = [], [], []
        for text, runs in zip(frame["text"], frame["runs"]):
            parts = (text or "").encode().split()
            left = parts
            if runs is not None:
                depth = np.zeros(len(parts) + 1, np.int64)
                for first, last in runs:
                    depth[first] += 1
                    depth[last] -= 1
                left = [w for w, k in zip(parts, np.cumsum(depth).tolist()) if not k]
            kept.append(b" ".join(left).decode())
            words.append(len(parts))
            removed.append(len(parts) - len(left))
        yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "kept": kept, "n_words": words, "n_removed": removed})


def remove_repeats(docs: DataFrame, width: int = 35) -> DataFrame:
    """(doc_id, kept, n_words, n_removed) for every row of ``docs`` (doc_id, text; other columns are ignored).

    ``kept`` has the words not covered by a repeated window, joined by one space. A null text has
    no words; a text shorter than a window is kept whole. Repeated rows repeat each other's windows,
    so both lose them. An empty table gives no rows. Null doc_id is a document like any other.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("key", F.xxhash64(F.isnull("doc_id"), "doc_id", "text"))
    parts = stage(docs.select("text").mapInArrow(_sketch_pass(width), "row int, segment int, cells binary, keys long"))
    keys = parts.agg(F.sum("keys")).first()[0] or 0
    bits = min(MAX_BITS, max(MIN_BITS, int(8 * keys).bit_length()))
    bitmaps = [bytearray(1 << (bits - 3)) for _ in range(ROWS)]
    merged = parts.repartition(64, "row", "segment").mapInPandas(_merge_sketch(bits), "row int, segment int, bitmap binary")
    for found in merged.toLocalIterator():
        at = found["segment"] << (bits - 9)
        bitmaps[found["row"]][at : at + (1 << (bits - 9))] = found["bitmap"]
    sketch = spark.sparkContext.broadcast([bytes(b) for b in bitmaps])
    buckets = max(64, -(-keys // 50_000))
    windows = stage(
        docs.select("key", "text").mapInArrow(_window_pass(width, sketch, bits, buckets), "bucket long, hashes binary, docs binary, starts binary")
    )
    spans = "key long, first long, last long"
    found = windows.where("bucket >= 0").repartition(buckets, "bucket").mapInPandas(_group_windows(width), spans)
    local = windows.where("bucket < 0").mapInPandas(_unpack, spans)
    runs = found.union(local).groupBy("key").agg(F.collect_set(F.array("first", "last")).alias("runs"))
    # The runs of a document cannot outnumber its words.
    return docs.join(runs, "key", "left").select("doc_id", "text", "runs").mapInPandas(
        _cut, "doc_id long, kept string, n_words long, n_removed long"
    )

