"""Exact top-k by inner product, selected by distributed histograms of the scores.

Every vector is scored against a block of queries. A histogram of the scores of each query, summed over the
cluster, tells the bin of its kth value; the bin is cut again until it holds one score. Then the
rows above it pass, and of those equal to it the ones with the smallest ids. Queries are a given set and go
block by block, each block of a fixed size sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.sources.staging import small_table

#: Queries of a block, rows scored at once in a task, and bins of a histogram.
QUERIES = 4096
ROWS = 1024
BINS = 256


def integer_vectors(vectors: DataFrame, scale: float) -> DataFrame:
    """(vec_id, v): components floor(scale * x); vectors that are null, empty or hold null or non-finite components are left out."""
    x = F.col("embedding").cast("array<double>")
    good = F.col("vec_id").isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))
    )
    return vectors.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale)).alias("v"))


def _matrix(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length of the vectors: their rows, and the integers as a matrix."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy(zero_copy_only=False)
    starts = column.offsets.to_numpy()[:-1]
    return {
        int(n): (rows := np.flatnonzero(sizes == n), flat[starts[rows][:, None] + np.arange(n)]) for n in np.unique(sizes).tolist()
    }


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T: by floating point where no partial sum can leave the 53 bits, else by integers of any size."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    if max(abs(x) for x in exact.ravel().tolist()) >= 2**63:
        raise OverflowError("a score does not fit 64 bits")
    return exact.astype(np.int64)


def _scores(sent, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(query numbers, row ids, scores, what takes part) of pieces of the table."""
    by_length: dict[int, list[int]] = {}
    for q, (_, v) in enumerate(sent.value):
        by_length.setdefault(len(v), []).append(q)
    ids = np.array([i for i, _ in sent.value], np.int64)
    queries = {n: (np.array(qs), np.array([sent.value[q][1] for q in qs], np.int64)) for n, qs in by_length.items()}
    for batch in batches:
        names = batch.column("vec_id").to_numpy()
        for n, (rows, matrix) in _matrix(batch.column("v")).items():
            if n not in queries:
                continue
            numbers, wanted = queries[n]
            for at in range(0, len(rows), ROWS):
                part = names[rows[at : at + ROWS]]
                yield numbers, part, _product(wanted, matrix[at : at + ROWS]), ids[numbers][:, None] != part[None, :]


def _ranges(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(sent.value)
        low, high, count = np.full(n, 2**62), np.full(n, -(2**62)), np.zeros(n, np.int64)
        for numbers, _, scores, ok in _scores(sent, batches):
            low[numbers] = np.minimum(low[numbers], np.where(ok, scores, 2**62).min(axis=1))
            high[numbers] = np.maximum(high[numbers], np.where(ok, scores, -(2**62)).max(axis=1))
            count[numbers] += ok.sum(axis=1)
        yield pa.RecordBatch.from_pydict({"q": pa.array(range(n), pa.int32()), "low": low, "high": high, "n": count})

    return run


def _histogram(sent, bounds, k: int):
    """Counts of the bins that can hold the kth value: those down to where the task itself has k scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, top, width, need = bounds.value
        counts = np.zeros((len(sent.value), BINS), np.int64)
        for numbers, _, scores, ok in _scores(sent, batches):
            place = (scores - low[numbers][:, None]) // width[numbers][:, None]
            # What lies above the range was counted before and takes no part here.
            ok = ok & (place >= 0) & (scores < top[numbers][:, None]) & (need[numbers] > 0)[:, None]
            flat = (np.arange(len(numbers))[:, None] * BINS + place)[ok]
            counts[numbers] += np.bincount(flat, minlength=len(numbers) * BINS).reshape(-1, BINS)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        q, b = np.nonzero((counts > 0) & (above < need[:, None]))
        yield pa.RecordBatch.from_pydict({"q": q.astype(np.int32), "bin": b.astype(np.int32), "n": counts[q, b]})

    return run


def _passing(sent, limits, k: int):
    """Rows above the kth value, and for each query the k smallest ids of those equal to it in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kth = limits.value
        ties: dict[int, np.ndarray] = {}

        def rows(q, ids, score) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"q": np.asarray(q, np.int32), "vec_id": np.asarray(ids, np.int64), "score": np.asarray(score, np.int64)})

        for numbers, ids, scores, ok in _scores(sent, batches):
            limit = kth[numbers][:, None]
            q, c = np.nonzero(ok & (scores > limit))
            yield rows(numbers[q], ids[c], scores[q, c])
            q, c = np.nonzero(ok & (scores == limit))
            for number, first, last in zip(*_groups(q)):
                key = int(numbers[number])
                both = np.concatenate([ties.get(key, ids[:0]), ids[c[first:last]]])
                ties[key] = np.sort(both)[:k]
        if ties:
            q = np.repeat(list(ties), [len(x) for x in ties.values()])
            yield rows(q, np.concatenate(list(ties.values())), kth[q])

    return run


def _groups(sorted_numbers: np.ndarray):
    values, firsts = np.unique(sorted_numbers, return_index=True)
    return values.tolist(), firsts.tolist(), [*firsts.tolist()[1:], len(sorted_numbers)]


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest scores of every query row among all rows with another vec_id.

    ``vectors`` has vec_id and embedding; other columns are ignored. Components become floor(scale * x), scores are
    integer inner products, ties go to the smaller vec_id. Vectors that are null, empty or hold null or non-finite components, and rows with a
    null vec_id, take no part; vectors of another length than the query's are no candidates. Repeated rows are candidates
    each, and repeated query rows give their results each. A score beyond 64 bits raises an error.
    """
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, scale)
    queries = integer_vectors(vectors.where(is_query), scale).orderBy("vec_id").toLocalIterator()
    out = None
    while block := [(r["vec_id"], r["v"]) for r in islice(queries, QUERIES)]:
        found = _block(rows, block, k)
        out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")


def _block(rows: DataFrame, block: list[tuple[int, list[int]]], k: int) -> DataFrame:
    context = rows.sparkSession.sparkContext
    sent = context.broadcast(block)
    n = len(block)
    low, high, count = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    ranges = rows.mapInArrow(_ranges(sent), "q int, low long, high long, n long").groupBy("q")
    for r in ranges.agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).where("n > 0").collect():
        low[r["q"]], high[r["q"]], count[r["q"]] = r["low"], r["high"], r["n"]
    need = np.minimum(count, k)  # ranks that the current range still has to give
    top = high + 1
    width = np.maximum(1, -(-(top - low) // BINS))
    while True:
        bounds = context.broadcast((low, top, width, need))
        counts = rows.mapInArrow(_histogram(sent, bounds, k), "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        above = F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("bin"))) - F.col("n")
        wanted = small_table(rows.sparkSession, list(enumerate(need.tolist())), "q int, need long")
        placed = counts.withColumn("above", above).join(wanted, "q")
        # One row for each query: the bin with its kth value.
        for r in placed.where("above < need AND need <= above + n").select("q", "bin", "above").collect():
            low[r["q"]] += r["bin"] * width[r["q"]]
            need[r["q"]] -= r["above"]
        if (width == 1).all():
            break
        top = low + width
        width = np.maximum(1, -(-width // BINS))
    low[count == 0] = 2**62
    limits = context.broadcast(low)
    passing = rows.mapInArrow(_passing(sent, limits, k), "q int, vec_id long, score long")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    names = small_table(rows.sparkSession, [(q, i) for q, (i, _) in enumerate(block)], "q int, query_id long")
    best = passing.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(names, "q").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
