"""Packing by powers of two: every sequence holds one piece of one document and needs no padding.

A document of n tokens is cut into as many full sequences as fit and, for the rest, one piece for
each binary digit of its length, longest first. Pieces of one length form a bucket; a sequence is
one piece, so none crosses documents and none is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm import words as W
from lotwise.llm.tokens import encoder, text_groups


def binary_lengths(n: int, most: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens; ``most`` is a power of two."""
    rest = n % most
    return [most] * (n // most) + [1 << k for k in range(most.bit_length() - 2, -1, -1) if rest >> k & 1]


def _pack(path: str, most: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        in_bucket = [0] * most.bit_length()
        for batch in W.slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            docs = batch.column("doc_id").to_pylist()
            for a, b in text_groups(texts):
                rows: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id")}
                for doc, ids in zip(docs[a:b], coder.encode(texts[a:b])):
                    data = np.append(ids, np.uint32(end_id)).astype("<u4").tobytes()
                    start = 0
                    for length in binary_lengths(len(ids) + 1, most):
                        bucket = length.bit_length() - 1
                        piece = data[4 * start : 4 * (start + length)]
                        rows["doc_id"].append(doc)
                        rows["start"].append(start)
                        rows["length"].append(length)
                        rows["ids"].append(piece if with_ids else None)
                        rows["ids_crc32"].append(zlib.crc32(piece))
                        rows["doc_tokens"].append(len(ids) + 1)
                        # Bucket, partition, number there: distinct over the cluster, the same when a task is repeated.
                        rows["sequence_id"].append(bucket << 58 | part << 34 | in_bucket[bucket])
                        in_bucket[bucket] += 1
                        start += length
                kinds = {k: pa.binary() if k == "ids" else pa.int64() for k in rows}
                yield pa.RecordBatch.from_pydict({k: pa.array(v, kinds[k]) for k, v in rows.items()})

    return run


def pack(docs: DataFrame, tokenizer: str, most: int = 4096, end_id: int = 2, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset), one row for each piece.

    ``docs`` has doc_id and text; other columns are ignored. A null or empty text is the end id alone.
    ``ids`` are little-endian unsigned 32-bit numbers (null without ``with_ids``); the highest
    bits of sequence_id name the bucket, that is the length. Rows that repeat are packed each. No
    shuffle is needed; an empty table gives no rows. ``most`` must be a power of two up to 2**15.
    """
    if most & (most - 1) or not 1 <= most <= 1 << 15:
        raise ValueError("most must be a power of two up to 32768")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = rows.mapInArrow(
        _pack(tokenizer, most, end_id, with_ids),
        "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long",
    )
    return made.withColumn("offset", F.lit(0).cast("long"))
