"""Quality by compression: texts are compressed with a dictionary of good and one of bad labelled text.

A dictionary is labelled text itself, a slice of each chosen document, which zstandard may refer back to. The
bytes that the good dictionary saves over the bad one, divided by the square root of the text's length, are
the one feature; a logistic curve fitted on labelled documents outside the dictionaries makes it a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm import words as W
from lotwise.sources.staging import stage

#: Bounds of the labelled rows used: documents in all, characters of each dictionary, least characters of one document's slice.
TRAIN_DOCS = 20_000
DICTIONARY = 256 << 10
LEAST_SLICE = 128
LEVEL = 5


@dataclass(frozen=True)
class Model:
    good: bytes = field(repr=False)
    bad: bytes = field(repr=False)
    weight: float
    bias: float


class _Sizes:
    """Compressed sizes of texts with one dictionary."""

    def __init__(self, content: bytes) -> None:
        options = {"level": LEVEL, "write_content_size": False, "write_dict_id": False}
        if len(content) >= 8:  # shorter ones are no dictionary
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=LEVEL)
            options["dict_data"] = known
        self.compressor = zstandard.ZstdCompressor(**options)

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        return np.array([len(self.compressor.compress(t)) for t in texts], float)


def _differences(good: bytes, bad: bytes):
    by_good, by_bad = _Sizes(good), _Sizes(bad)

    def difference(texts: list[bytes]) -> np.ndarray:
        # Empty texts have no bytes to save: 0.
        length = np.array([max(1, len(t)) for t in texts], float)
        return (by_bad(texts) - by_good(texts)) / np.sqrt(length)

    return difference


def differences(rows: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    """``rows`` and ``difference``: normalised bytes saved by the good dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = _differences(good, bad)
        for batch in W.slices(batches, 2 << 20):
            others = [n for n in batch.schema.names if n != "text"]
            made = pa.array(measure(W.texts_of(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in others], made], [*others, "difference"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(run, f"{kept}, difference double")


def _dictionary(rows: DataFrame, quality: int) -> bytes:
    """Slices of the labelled texts, as long as the number of texts allows, the first ones by hash last (nearest to the text)."""
    some = rows.where(F.col("quality") == quality)
    share = max(LEAST_SLICE, DICTIONARY // max(1, some.count()))
    slices = some.select("h", F.substring("text", 1, share).alias("slice")).orderBy("h", "slice").limit(DICTIONARY // LEAST_SLICE).collect()
    return "\n".join(r["slice"] for r in reversed(slices)).encode()[-DICTIONARY:]


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Weight and bias of one feature by Newton steps; a small penalty keeps separable data finite. Scaled inside."""
    scale = float(np.std(x)) or 1.0
    data = np.column_stack([x / scale, np.ones(len(x))])
    penalty, w = np.array([1e-2, 1e-4]), np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(data @ w, -30, 30)))
        slope = data.T @ (p - y) + penalty * w
        curve = (data * (p * (1 - p))[:, None]).T @ data + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality 0 or 1; other values and nulls are ignored).

    The rows of up to ``TRAIN_DOCS`` labelled ids with the smallest hashes are used; the hash of a text decides whether it is for the
    dictionaries or for the curve, so copies are on one side. An id that is labelled both ways counts as bad. Without labels, or with
    labels of one kind only, every score is 0.5 or near the one label.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    # At most ``TRAIN_DOCS`` rows of two numbers are broadcast.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(F.length("text") > 0)
    sample = stage(texts.join(F.broadcast(chosen), "doc_id").select("text", "quality", F.xxhash64("text").alias("h")))
    first = sample.where(F.col("h") % 2 == 0)
    good, bad = _dictionary(first, 1), _dictionary(first, 0)
    rest = differences(sample.where(F.col("h") % 2 != 0).select("text", "quality"), good, bad)
    pairs = rest.orderBy("difference", "quality").collect()
    x, y = (np.array([r[k] for r in pairs], float) for k in ("difference", "quality"))
    weight, bias = logistic(x, y) if len(x) else (0.0, 0.0)
    return Model(good, bad, weight, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` and ``score``: the probability of good text, from all of its bytes; a column of that name is replaced.

    Null and empty texts have the difference 0. Repeated rows score alike; an empty table gives no rows.
    """
    measure: list = []

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        if not measure:
            measure.append(_differences(model.good, model.bad))
        values = measure[0](W.texts_of(batch.column("text")))
        return [pa.array(1 / (1 + np.exp(-np.clip(model.weight * values + model.bias, -700, 700))))]

    return W.with_columns(docs, "score double", compute)
