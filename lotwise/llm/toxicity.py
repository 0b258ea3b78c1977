"""Toxicity by a weighted lexicon that is matched after folding disguises.

Folding: lower case, letters that look like Latin ones, and digits or ``@``/``$`` used as letters inside
words. The lexicon has whole words and beginnings of words with the log-odds of toxic against other documents,
learned from labelled rows. One Aho-Corasick automaton finds the entries and the exception phrases;
entries inside such a phrase do not count. The sum of weights, by itself and divided by the
square root of the number of words, goes through a logistic curve fitted on the same rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm import words as W
from lotwise.sources.staging import stage

#: Bound of the training sample in documents, of candidate entries, and of the lexicon.
TRAIN_DOCS = 20_000
CANDIDATES = 50_000
ENTRIES = 2_000
MIN_TOXIC = 6
MIN_WEIGHT = 2.5
PREFIXES = range(3, 11)
#: Harmless phrases with words that a lexicon may hold.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "circus clown", "sore loser")

_LOOKALIKES = str.maketrans("аеорсухкмтнвіјѕԁԛԝαεορτυνκικχıɡ", "aeopcyxkmthbijsdqwaeoptuvkikxig")
_DIGITS = str.maketrans("013457", "oieast")
_SIGNS = str.maketrans("@$", "as")
_WITH_DIGIT = re.compile(r"\w*\d\w*")
_SIGN_INSIDE = re.compile(r"(?<=[^\W\d_])[@$]+(?=[^\W\d_])")
_HAS_LETTER = re.compile(r"[^\W\d_]")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> list[str]:
    """Words of letters after folding."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(_LOOKALIKES)
    if "@" in text or "$" in text:
        text = _SIGN_INSIDE.sub(lambda m: m[0].translate(_SIGNS), text)
    text = _WITH_DIGIT.sub(lambda m: m[0].translate(_DIGITS) if _HAS_LETTER.search(m[0]) else m[0], text)
    return _WORD.findall(text)


def features(words: Sequence[str]) -> set[str]:
    """Whole words (with a blank at the end) and beginnings of words."""
    found = set()
    for word in set(words):
        found.add(word + " ")
        found.update(word[:n] for n in PREFIXES if n <= len(word))
    return found


@dataclass
class Lexicon:
    """Weights of entries: ``word `` matches a whole word, ``beg`` the beginning of one."""

    weights: dict[str, float]
    exceptions: Sequence[str] = EXCEPTIONS
    curve: tuple[float, float, float] = (-3.0, 1.0, 1.0)
    _machine: object = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_machine": None}

    def machine(self):
        if self._machine is None:
            self._machine = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                self._machine.add_word(" " + entry, (len(entry), weight))
            for phrase in self.exceptions:
                folded = " ".join(fold(phrase))
                self._machine.add_word(f" {folded} ", (len(folded) + 1, None))
            if len(self._machine):
                self._machine.make_automaton()
        return self._machine

    def total(self, words: Sequence[str]) -> float:
        """Sum of the weights of the entries found outside exception phrases."""
        machine = self.machine()
        if not words or not len(machine):
            return 0.0
        hits, excused = [], []
        for end, (size, weight) in machine.iter(f" {' '.join(words)} "):
            (excused if weight is None else hits).append((end - size, end, weight))
        return sum(w for a, b, w in hits if not any(x <= a and b <= y for x, y, _ in excused))

    def probability(self, words: np.ndarray, totals: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        return 1 / (1 + np.exp(-np.clip(a + b * np.log1p(totals) + c * totals / np.sqrt(words + 1), -30, 30)))


def _count(wanted, toxic: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found = features(fold(text or ""))
                counts.update(found if wanted is None else found & wanted.value)
            if len(counts) > 500_000:
                yield pa.RecordBatch.from_pydict({"entry": list(counts), "n": pa.array(counts.values(), pa.int64())})
                counts = Counter()
        yield pa.RecordBatch.from_pydict({"entry": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    return run


def _totals(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            folded = [fold(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                batch.schema.names[0]: batch.column(0),
                "words": pa.array([len(w) for w in folded], pa.int64()),
                "total": pa.array([sent.value.total(w) for w in folded], pa.float64()),
            })

    return run


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS, exceptions: Sequence[str] = EXCEPTIONS) -> Lexicon:
    """Learns from at most ``limit`` rows of ``labels`` (doc_id, toxic 0/1), chosen by a hash of doc_id.

    Rows with a null doc_id or toxic are left out. Without toxic or without other rows the lexicon is empty.
    """
    spark = docs.sparkSession
    rows = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    # At most ``limit`` rows of two numbers are broadcast.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = stage(texts.join(F.broadcast(chosen), "doc_id").select("toxic", "text"))
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Lexicon({}, exceptions)

    def counted(toxic: int, wanted) -> DataFrame:
        part = sample.where(F.col("toxic") == toxic).select("text")
        return part.mapInArrow(_count(wanted, toxic), "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))

    often = counted(1, None).where(F.col("n") >= MIN_TOXIC).orderBy(F.desc("n"), "entry").limit(CANDIDATES)
    in_toxic = {r["entry"]: r["n"] for r in often.collect()}
    wanted = spark.sparkContext.broadcast(frozenset(in_toxic))
    in_other = {r["entry"]: r["n"] for r in counted(0, wanted).collect()}
    odds = {
        e: float(np.log((n + 0.5) / (sizes[1] + 1)) - np.log((in_other.get(e, 0) + 0.5) / (sizes[0] + 1))) for e, n in in_toxic.items()
    }
    weights: dict[str, float] = {}
    # Strong entries first, short ones before longer ones of like weight; one is left out where a beginning of it was taken.
    for entry in sorted((e for e in odds if odds[e] >= MIN_WEIGHT), key=lambda e: (-int(2 * odds[e]), len(e), e)):
        if not any(entry[:n] in weights for n in range(min(PREFIXES), len(entry))):
            weights[entry] = odds[entry]
    kept = sorted(weights, key=lambda e: (-weights[e], e))[:ENTRIES]
    lexicon = Lexicon({e: weights[e] for e in kept}, exceptions)

    sent = spark.sparkContext.broadcast(lexicon)
    scored = sample.mapInArrow(_totals(sent), "toxic int, words long, total double").toPandas()  # at most ``limit`` rows, and repeats
    x = np.column_stack([np.ones(len(scored)), np.log1p(scored["total"]), scored["total"] / np.sqrt(scored["words"] + 1)])
    lexicon.curve = _logistic(x, scored["toxic"].to_numpy(float))
    return lexicon


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, ...]:
    """Newton steps for a penalised logistic fit."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(beta)), x.T @ (y - p) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(beta.tolist())


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, score, total, words) for every row of ``docs`` (doc_id, text; other columns are ignored).

    A null or empty text has no words and the score of a text without hits. Repeated rows are scored each.
    """
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _totals(sent)(batches):
            p = sent.value.probability(batch.column("words").to_numpy(), batch.column("total").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], ["doc_id", "words", "total", "score"])

    return rows.mapInArrow(run, "doc_id long, words long, total double, score double")
