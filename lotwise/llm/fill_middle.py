"""Fill-in-the-middle texts: documents cut at hashed code points, found through remembered chunks.

A rolling hash of 16 bytes cuts texts into chunks that depend on their content only, so passages that repeat
give the same chunks. A chunk seen before is recognised by its bytes, which are compared, and brings its summary: its
number of code points, whether a mark lies inside, and its first and last bytes, which tell of a mark across
two chunks. Running sums of the counts lead to the chunk of each cut; only that chunk is looked into.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm import words as W

#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Least and most bytes of a chunk, and the share of places (1 of 256) where a cut is allowed.
LEAST, MOST, SHIFT = 64, 2048, 56
#: Bytes of chunks remembered between turnovers; those seen since the last one stay.
REMEMBERED = 16 << 20

_BYTE = np.random.default_rng(20250311).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = 0x9E3779B97F4A7C15 | 1

Summary = tuple[int, bool, bytes, bytes]


def places(raw: np.ndarray) -> np.ndarray:
    """Offsets behind 16 bytes whose hash allows a cut, ascending."""
    if len(raw) < 16:
        return np.zeros(0, np.int64)
    rolled, width = _BYTE[raw], 1
    while width < 16:  # the hash of twice as many bytes from two neighbours
        rolled = rolled[:-width] * np.uint64(pow(_FACTOR, width, 2**64)) + rolled[width:]
        width *= 2
    return np.flatnonzero(rolled >> np.uint64(SHIFT) == 0) + 16


def chunk_ends(text: bytes, allowed: Sequence[int]) -> Iterator[int]:
    """Ends of the chunks of a text: allowed places, with the least and most bytes kept, before the start of a character."""
    start, size = 0, len(text)
    for place in (*allowed, size):
        while place - start >= LEAST or (place == size and start < size):
            end = min(place, start + MOST)
            while end < size and text[end] & 0xC0 == 0x80:
                end += 1
            yield end
            start = end


class Chunks:
    """Summaries of chunks by their bytes, in two generations."""

    def __init__(self, marks: Sequence[str]) -> None:
        self.marks = [m.encode() for m in marks]
        self.reach = max(map(len, self.marks)) - 1
        if not 1 <= self.reach < 16 or any(not m for m in self.marks):
            raise ValueError("marks must have 2 to 16 bytes")
        self.young: dict[bytes, Summary] = {}
        self.old: dict[bytes, Summary] = {}
        self.held = 0

    def summary(self, chunk: bytes) -> Summary:
        found = self.young.get(chunk)
        if found is None:
            found = self.old.get(chunk) or self._look(chunk)
            if self.held > REMEMBERED:
                self.old, self.young, self.held = self.young, {}, 0
            self.young[chunk] = found
            self.held += len(chunk)
        return found

    def _look(self, chunk: bytes) -> Summary:
        codes = np.frombuffer(chunk, np.uint8)
        starts = len(chunk) if chunk.isascii() else int(np.count_nonzero(codes & 0xC0 != 0x80))
        return starts, self.marked(chunk), chunk[: self.reach], chunk[-self.reach :]

    def marked(self, piece: bytes) -> bool:
        return any(m in piece for m in self.marks)


def text_chunks(chunks: Chunks, text: bytes, allowed: Sequence[int]) -> tuple[list[int], list[int], bool]:
    """(byte offsets, code points before them) of the chunk borders, from 0 on, and whether a mark occurs."""
    offsets, counts, marked, tail = [0], [], False, b""
    for end in chunk_ends(text, allowed):
        count, inside, head, last = chunks.summary(text[offsets[-1] : end])
        # The last chunk may be shorter than a mark, so what comes before it is carried on.
        marked = marked or inside or chunks.marked(tail + head)
        tail = (tail + last)[-chunks.reach :]
        offsets.append(end)
        counts.append(count)
    return offsets, [0, *accumulate(counts)], marked


def byte_offset(text: bytes, offsets: list[int], before: list[int], place: int) -> int:
    """The byte offset of code point ``place``."""
    k = min(bisect_right(before, place) - 1, len(offsets) - 2) if len(offsets) > 1 else 0
    rest = place - before[k]
    if rest == 0:
        return offsets[k]
    chunk = text[offsets[k] : offsets[k + 1]]
    return offsets[k] + (rest if len(chunk) == before[k + 1] - before[k] else len(chunk.decode()[:rest].encode()))


def _run(marks: tuple[str, str, str], seed: int, percent: int, suffix_first: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks(marks)
        before_prefix, before_suffix, before_middle = chunks.marks
        for batch in W.slices(batches, 1 << 20):
            texts = W.texts_of(batch.column("text"))
            joined = np.frombuffer(b"".join(texts), np.uint8)
            ends = np.cumsum([len(t) for t in texts])
            # A window that reaches into the text before ends within the least bytes of a chunk and counts for nothing.
            allowed = places(joined)
            parts = np.searchsorted(allowed, ends - [len(t) for t in texts], side="right"), np.searchsorted(allowed, ends, side="right")
            rows: dict[str, list] = {k: [] for k in ("n", "form", "prefix_chars", "middle_chars", "output")}
            for doc, text, end, a, b in zip(batch.column("doc_id").to_pylist(), texts, ends.tolist(), *map(np.ndarray.tolist, parts)):
                offsets, before, marked = text_chunks(chunks, text, (allowed[a:b] - (end - len(text))).tolist())
                n = before[-1]
                digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
                h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
                first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
                if n == 0 or marked or h3 % 100 >= percent:
                    form, output = "plain", text
                else:
                    x, y = (byte_offset(text, offsets, before, p) for p in (first, second))
                    if h4 % 100 < suffix_first:
                        form, output = "spm", b"".join((before_suffix, text[y:], before_prefix, text[:x], before_middle, text[x:y]))
                    else:
                        form, output = "psm", b"".join((before_prefix, text[:x], before_suffix, text[y:], before_middle, text[x:y]))
                rows["n"].append(n)
                rows["form"].append(form)
                rows["prefix_chars"].append(None if form == "plain" else first)
                rows["middle_chars"].append(None if form == "plain" else second - first)
                rows["output"].append(output)
            kinds = {k: pa.int64() for k in rows} | {"form": pa.string()}
            made = [pa.array(rows[k], pa.binary()).cast(pa.string()) if k == "output" else pa.array(rows[k], kinds[k]) for k in rows]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], ["doc_id", *rows])

    return run


def fill_in_middle(
    docs: DataFrame, marks: tuple[str, str, str] = MARKS, seed: int = 1, percent: int = 90, suffix_first: int = 20
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), one row for each row of ``docs`` (doc_id, text).

    The cuts follow from the hash of ``seed`` and doc_id, so repeated rows give equal rows; a null doc_id counts as
    an empty name. ``percent`` of the texts are rearranged, ``suffix_first`` percent of those with the suffix in
    front (spm, otherwise psm). A null text is empty; texts that are empty or hold a mark stay plain, with null
    lengths. Other columns are ignored, an empty table gives no rows; nothing is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _run(tuple(marks), seed, percent, suffix_first),
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def restore(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``output`` was made of. No mark occurs in it, so the first of each kind is the one that was put in."""

    def cut(column: Column, mark: str) -> Column:
        return F.split(column, rf"\Q{mark}\E", 2)

    before_prefix, before_suffix, before_middle = marks
    psm = cut(F.substr(output, F.lit(len(before_prefix) + 1)), before_suffix)
    psm_rest = cut(psm[1], before_middle)
    spm = cut(F.substr(output, F.lit(len(before_suffix) + 1)), before_prefix)
    spm_rest = cut(spm[1], before_middle)
    return (
        F.when(form == "psm", F.concat(psm[0], psm_rest[1], psm_rest[0]))
        .when(form == "spm", F.concat(spm_rest[0], spm_rest[1], spm[0]))
        .otherwise(output)
    )
