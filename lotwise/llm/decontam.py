"""Benchmark passages in documents, by one Aho-Corasick automaton over all items.

Texts are normalised to words joined by one blank; patterns are the windows of every item with a blank on both
sides, so a match starts and ends at words. Each text is scanned once; a match is mapped back to
the numbers of its words, and from them to the place in the text.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm import words as W

#: Bytes of item texts that one automaton may hold; more items are scanned for in several passes of the patterns.
AUTOMATON_BYTES = 64 << 20
_SEPARATORS = {*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)} - {*range(0x41, 0x5B)}
_FOLD = bytes(0x20 if b in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters a-z (A-Z in lower case) and bytes of other characters."""
    return text.translate(_FOLD).split(b" ")


def normal(text: bytes) -> bytes:
    return b" " + b" ".join(w for w in words_of(text) if w) + b" "


def windows(text: bytes, width: int) -> set[bytes]:
    words = normal(text).split()
    if not words:
        return set()
    return {b" " + b" ".join(words[i : i + width]) + b" " for i in range(max(1, len(words) - width + 1))}


def automatons(items: list[tuple[str, bytes]], width: int) -> list[ahocorasick.Automaton]:
    """Usually one; item sets above AUTOMATON_BYTES give several, each of bounded size."""
    out, owners, held = [], {}, 0

    def close() -> None:
        machine = ahocorasick.Automaton()
        for pattern, names in owners.items():
            machine.add_word(pattern.decode("latin-1"), (pattern.count(b" ") - 1, tuple(sorted(names))))
        machine.make_automaton()
        out.append(machine)

    for name, text in items:
        if held > AUTOMATON_BYTES:
            close()
            owners, held = {}, 0
        for pattern in windows(text, width):
            owners.setdefault(pattern, set()).add(name)
        held += len(text)
    if owners:
        close()
    return out


def scan(text: bytes, machines: list) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, merged runs [first, last) of hit words, and the items that occur."""
    folded = normal(text)
    plain = folded.decode("latin-1")
    n_words = folded.count(b" ") - 1 if len(folded) > 2 else 0
    ends: list[int] = []
    sizes: list[int] = []
    items: set[str] = set()
    for machine in machines:
        for end, (size, names) in machine.iter(plain):
            ends.append(end)
            sizes.append(size)
            items.update(names)
    if not ends:
        return n_words, [], items
    blanks = np.flatnonzero(np.frombuffer(folded, np.uint8) == 32)
    last = np.searchsorted(blanks, np.array(ends))  # the blank that ends word number last - 1
    runs: list[tuple[int, int]] = []
    for first, stop in sorted(zip((last - np.array(sizes)).tolist(), last.tolist())):
        if runs and first <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(stop, runs[-1][1]))
        else:
            runs.append((first, stop))
    return n_words, runs, items


def original_spans(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as [start, end) in code points of the text."""
    if not runs:
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    return [tuple(len(text[:at].decode()) for at in (places[a][0], places[b - 1][1])) for a, b in runs]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _scan(sent, width: int):
    machines: list = []

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        if not machines:
            machines.extend(automatons(sent.value, width))
        texts = W.texts_of(batch.column("text"))
        found = [scan(t, machines) for t in texts]
        spans = [[{"start": a, "end": b} for a, b in original_spans(t, f[1])] for t, f in zip(texts, found)]
        return [
            pa.array([f[0] for f in found], pa.int64()),
            pa.array([sum(b - a for a, b in f[1]) for f in found], pa.int64()),
            pa.array([sorted(f[2]) for f in found], pa.list_(pa.string())),
            pa.array(spans, _SPANS),
        ]

    return compute


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Adds n_words, n_hit, items and spans to every row of ``docs`` (text and any others; columns of these names are replaced).

    ``items`` are the ids, as sorted strings, of the items of ``benchmark`` (item_id, text) with a window in the text;
    ``spans`` are the hit passages in code points of the original text. The benchmark is a given set of
    questions and is sent to every task; in a task it takes memory in proportion to its text. A null text has no
    words; items without words have no windows; a null item_id is named ''. Repeated rows are
    scanned each; an empty table on either side gives no rows or no hits.
    """
    item = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    items = benchmark.where("text IS NOT NULL").select(item, F.col("text").cast("string")).toLocalIterator()
    sent = docs.sparkSession.sparkContext.broadcast([(name, text.encode()) for name, text in items])
    rows = docs.withColumn("text", F.col("text").cast("string"))
    schema = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"
    return W.with_columns(rows, schema, _scan(sent, width))
