"""Language of texts by a small byte convolutional network, trained in numpy on labelled texts.

The network: filters over 2, 3 and 4 bytes of a window of ``WINDOW`` bytes, rectified maximum
over the window for each filter, then softmax. As bytes are one-hot inputs, a filter is a table of weights by
position and byte. A text is cut into windows from start to end (the last one reaches back, so that
it is full where the text is long enough), and its log-probabilities are the mean over all windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm import words as W

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 12  # of each width
#: Bound of the training sample: documents, and windows of each.
TRAIN_DOCS = 4000
TRAIN_WINDOWS = 3
_LANES = 512


class ByteConvNet:
    """Tables of the filters by width (position, byte, filter), and the output layer."""

    def __init__(self, labels: list[str], seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.filters = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(labels))).astype(np.float32)
        self.out_bias = np.zeros(len(labels), np.float32)

    def pooled(self, grid: np.ndarray) -> np.ndarray:
        """Maximum of every filter for each column of ``grid`` (bytes by place, then window)."""
        steps, lanes = grid.shape
        # Tables for pairs of bytes: one look-up for the first two places of all filters.
        if not hasattr(self, "_pairs"):
            heads = [(f[0][:, None, :] + f[1][None, :, :]).reshape(65536, FILTERS) for f in self.filters]
            self._pairs = np.concatenate(heads, axis=1)
            self._tail = (self.filters[2][2][:, None, :] + self.filters[2][3][None, :, :]).reshape(65536, FILTERS)
            self._third = self.filters[1][2]
        best = np.full((lanes, len(WIDTHS) * FILTERS), -np.inf, np.float32)
        wide = grid.astype(np.int32)
        pairs = wide[:-1] * 256 + wide[1:]
        for at in range(steps - 1):
            score = self._pairs[pairs[at]]
            if at + 2 < steps:
                score[:, FILTERS : 2 * FILTERS] += self._third[wide[at + 2]]
            else:
                score[:, FILTERS:] = -np.inf
            if at + 3 < steps:
                score[:, 2 * FILTERS :] += self._tail[pairs[at + 2]]
            else:
                score[:, 2 * FILTERS :] = -np.inf
            np.maximum(best, score, out=best)
        return best

    def log_probabilities(self, grid: np.ndarray) -> np.ndarray:
        hidden = np.maximum(self.pooled(grid) + self.bias, 0)
        logits = hidden @ self.out + self.out_bias
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def train(self, rows: np.ndarray, targets: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 11) -> None:
        """Adam on the cross entropy; gradients of a filter go to the place of its maximum only."""
        rng = np.random.default_rng(seed)
        params = [*self.filters, self.bias, self.out, self.out_bias]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for first in range(0, len(order), batch):
                part = order[first : first + batch]
                grads = self._gradients(rows[part], targets[part])
                step += 1
                for p, g, (m, v) in zip(params, grads, moments):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        self.__dict__.pop("_pairs", None)

    def _gradients(self, rows: np.ndarray, targets: np.ndarray) -> list[np.ndarray]:
        n = len(rows)
        places, values = [], []
        for f, width in zip(self.filters, WIDTHS):
            count = rows.shape[1] - width + 1
            score = f[0][rows[:, :count]]
            for k in range(1, width):
                score = score + f[k][rows[:, k : k + count]]
            places.append(score.argmax(axis=1))
            values.append(score.max(axis=1))
        raw = np.concatenate(values, axis=1) + self.bias
        hidden = np.maximum(raw, 0)
        logits = hidden @ self.out + self.out_bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(n), targets] -= 1
        p /= n
        back = (p @ self.out.T) * (raw > 0)
        grads = []
        for i, (f, width) in enumerate(zip(self.filters, WIDTHS)):
            g = np.zeros_like(f)
            own = back[:, i * FILTERS : (i + 1) * FILTERS]
            for k in range(width):
                byte = np.take_along_axis(rows, places[i] + k, axis=1)
                np.add.at(g[k], (byte, np.arange(FILTERS)[None, :]), own)
            grads.append(g)
        return [*grads, back.sum(axis=0), hidden.T @ p, p.sum(axis=0)]


def cut(text: bytes, size: int = WINDOW) -> np.ndarray:
    """Windows that cover the whole text; a text shorter than one is repeated until it is full."""
    raw = np.frombuffer(text, np.uint8)
    if len(raw) < size:
        return np.resize(raw, (1, size)) if len(raw) else np.zeros((0, size), np.uint8)
    full = len(raw) // size
    rows = raw[: full * size].reshape(full, size)
    return rows if full * size == len(raw) else np.concatenate([rows, raw[None, -size:]])


def fit(labelled: DataFrame, docs: int = TRAIN_DOCS, windows: int = TRAIN_WINDOWS) -> ByteConvNet | None:
    """Trains on at most ``docs`` texts of ``labelled`` (text, lang), chosen by a hash of the text; None without rows.

    Rows with a null or empty text or a null lang are left out. Only ``windows`` windows of a chosen text, spread
    over it, come to the driver.
    """
    rows = labelled.where("lang IS NOT NULL AND length(text) > 0").select("text", F.col("lang").cast("string").alias("lang"))
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = [], []
            for text, lang in zip(W.texts_of(batch.column("text")), batch.column("lang").to_pylist()):
                grid = cut(text)
                for k in np.unique(np.linspace(0, len(grid) - 1, windows).astype(int)):
                    texts.append(grid[k].tobytes())
                    langs.append(lang)
            yield pa.RecordBatch.from_pydict({"bytes": pa.array(texts, pa.binary()), "lang": pa.array(langs, pa.string())})

    sample = W.chosen_texts(rows, docs).select("lang", "text")
    got = sample.mapInArrow(pick, "bytes binary, lang string").collect()
    pairs = sorted((bytes(r["bytes"]), r["lang"]) for r in got)
    if not pairs:
        return None
    labels = sorted({lang for _, lang in pairs})
    net = ByteConvNet(labels)
    grid = np.stack([np.frombuffer(b, np.uint8) for b, _ in pairs])
    net.train(grid, np.array([labels.index(lang) for _, lang in pairs]))
    return net


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode())


def _predict(sent):
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        net: ByteConvNet = sent.value
        texts = W.texts_of(batch.column("text"))
        grids = [cut(t if _has_letter(t) else b"") for t in texts]
        counts = np.array([len(g) for g in grids], np.int64)
        grid = np.concatenate([np.zeros((0, WINDOW), np.uint8), *grids])
        sums = np.zeros((len(grid) + 1, len(net.labels)))
        for a in range(0, len(grid), _LANES):
            sums[a + 1 : a + 1 + _LANES] = net.log_probabilities(np.ascontiguousarray(grid[a : a + _LANES].T))
        sums = np.cumsum(sums, axis=0)
        ends = np.cumsum(counts)
        mean = (sums[ends] - sums[ends - counts]) / np.maximum(counts, 1)[:, None]
        p = np.exp(mean - mean.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        names = [net.labels[b] if n else "und" for b, n in zip(p.argmax(axis=1).tolist(), counts.tolist())]
        return [pa.array(names, pa.string()), pa.array(np.where(counts > 0, p.max(axis=1), 0.0))]

    return compute


def predict(docs: DataFrame, net: ByteConvNet | None) -> DataFrame:
    """Adds lang_pred and score to every row of ``docs`` (text and any others; columns of these names are replaced).

    ``und`` with score 0 where the text is null or has no letter, and everywhere without a network. ``score`` is the
    probability that the network gives the language. An empty table gives no rows; repeated rows are predicted each.
    """
    rows = docs.withColumn("text", F.col("text").cast("string"))
    if net is None:
        return rows.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    sent = docs.sparkSession.sparkContext.broadcast(net)
    return W.with_columns(rows, "lang_pred string, score double", _predict(sent))
