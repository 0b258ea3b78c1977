"""Alignment of the tokens of two tokenizers by the bytes that they cover.

The tokens of both are sorted by their start; the running maximum of their ends shows where both kinds end, and there
a group ends. Inside a group every token of A is linked with every token of B. Both tokenizers treat a word behind a
single space apart from what is around it, so a task aligns each distinct word once and puts texts together from words.

How many documents hold a pair of ids linked is counted over all documents. Texts are dealt in blocks with one list
of distinct pairs each: lists are counted and looked up by joins, so no task or driver holds the counts of the
whole corpus.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm import words as W
from lotwise.sources.staging import staging_path

#: Words (and characters of words) remembered by a task; beyond that those not seen again are forgotten.
WORDS, CHARACTERS = 400_000, 16 << 20
#: Bytes of text in a block.
BLOCK = 12 << 20
#: Groups with more links than this are counted by distinct ids instead of being spelled out.
SPELLED = 1 << 12

_APART = re.compile(r"(?<=[^ ]) (?=\S)")
#: First bytes of blanks in UTF-8; the last four also begin other characters.
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = True


def byte_level_entries(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary file, special tokens left out (empty)."""
    # Byte-level entries write each byte as one printable character: itself, or the next one from 256 on.
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)).difference(shown)))}
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    vocabulary, special = content["model"]["vocab"], {t["content"] for t in content["added_tokens"]}
    entries = [b""] * (1 + max(vocabulary.values()))
    for text, number in vocabulary.items():
        if text not in special:
            entries[number] = bytes(byte[c] for c in text)
    merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in content["model"]["merges"]]
    if merged != sorted(merged) or not {bytes([b]) for b in range(256)}.issubset(entries):
        raise ValueError(f"{path}: bytes are missing, or merges are not in the order of their ids")
    return entries


class Tokenizers:
    """A: a byte-level vocabulary over space and text; B: a piece model that adds the space itself."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.bytes_a = byte_level_entries(path_a)
        ranks = {entry: number for number, entry in enumerate(self.bytes_a) if entry}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b, mixed = [], False
        for number in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(number)
            mixed = mixed or "▁" in piece.lstrip("▁")
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode())
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        #: Words are independent where no piece goes on behind a word, and blanks are kept as they are.
        self.apart = not mixed and self.b.encode("a  b ") == [*self.b.encode("a"), *self.b.encode(" b ")][: len(self.b.encode("a  b "))]

    def words(self, texts: list[str]) -> list[list[str]]:
        """Parts of each text that are tokenized alike wherever they stand; a space goes before each one."""
        if not self.apart:
            return [[t] if t else [] for t in texts]
        # A space may stand between words where no blank is beside it.
        raw = [t.encode() for t in texts]
        codes = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
        ends = np.cumsum([len(r) + 1 for r in raw])
        twice = np.flatnonzero((codes[:-1] == 0x20) & _BLANK[codes[1:]]) + 1
        odd = np.searchsorted(ends, twice, side="right").tolist()
        # A blank at the end of a text stands at the space between texts, in front of its end.
        odd += np.flatnonzero([bool(t) and (t[0].isspace() or t[-1] == " ") for t in texts]).tolist()
        split = [t.split(" ") if t else [] for t in texts]
        for k in set(odd):
            if k < len(texts) and texts[k]:
                split[k] = _APART.split(texts[k])
        return split

    def encode(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(ids, numbers of ids of each word) of A and of B; none where the bytes of either differ from space and word."""
        expected = (" " + " ".join(words)).encode()
        starts = np.flatnonzero(np.frombuffer(expected, np.uint8) == 0x20)
        if len(starts) != len(words) or not self.apart or any(not w or w[0].isspace() for w in words):
            return self._encode_each(words)
        ids = [np.array(self.a.encode_ordinary(expected.decode()), np.int64)]
        coded = self.b.encode(words, num_threads=1)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        ids.append(np.fromiter(chain.from_iterable(coded), np.int64, int(sizes.sum())))
        if b"".join(map(self.bytes_b.__getitem__, ids[1].tolist())) != expected:
            return self._encode_each(words)
        # Tokens that start in a word belong to it.
        stops = np.searchsorted(np.cumsum(self.length_a[ids[0]]), np.append(starts[1:], len(expected)), side="right")
        return ids, [np.diff(stops, prepend=0), sizes]

    def _encode_each(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        coded = [self.a.encode_ordinary(" " + w) for w in words], self.b.encode(words, num_threads=1)
        for k, word in enumerate(words):
            expected = (" " + word).encode()
            if not word or b"".join(map(self.bytes_b.__getitem__, coded[1][k])) != expected:
                coded[0][k], coded[1][k] = [], []
        sizes = [np.array([len(x) for x in c], np.int64) for c in coded]
        return [np.fromiter(chain.from_iterable(c), np.int64, int(n.sum())) for c, n in zip(coded, sizes)], sizes


def coalesce(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B. A group ends where a start reaches the running maximum of the ends."""
    start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    kind = np.repeat(np.array([0, 1], np.int8), [len(start_a), len(start_b)])
    order = np.lexsort((kind, start))
    reached = np.maximum.accumulate(end[order])
    group = np.zeros(len(order), np.int64)
    group[1:] = np.cumsum(start[order][1:] >= reached[:-1])
    by_token = np.empty_like(group)
    by_token[order] = group
    return by_token[: len(start_a)], by_token[len(start_a) :]


def spread(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def sorted_sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their values."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values[order], first) if len(keys) else values[:0]


def links(ids_a: np.ndarray, group_a: np.ndarray, ids_b: np.ndarray, group_b: np.ndarray, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair, times): linked pairs ``a * size_b + b`` of each group; groups ascend from 0, tokens in their order."""
    groups = 1 + max(group_a[-1] if len(group_a) else -1, group_b[-1] if len(group_b) else -1)
    n_a, n_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    first_b = np.cumsum(n_b) - n_b
    few = n_a * n_b <= SPELLED
    chosen = few[group_a] if len(group_a) else np.zeros(0, bool)
    partners = n_b[group_a[chosen]]
    b_at = np.repeat(first_b[group_a[chosen]], partners) + spread(partners)
    parts = [(np.repeat(group_a[chosen], partners), np.repeat(ids_a[chosen], partners) * size_b + ids_b[b_at], np.ones(len(b_at), np.int64))]
    first_a = np.cumsum(n_a) - n_a
    for g in np.flatnonzero(~few):
        a, times_a = np.unique(ids_a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
        b, times_b = np.unique(ids_b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
        pairs = (a[:, None] * size_b + b).reshape(-1)
        parts.append((np.full(len(pairs), g), pairs, (times_a[:, None] * times_b).reshape(-1)))
    return tuple(np.concatenate(p) for p in zip(*parts))


class Aligner:
    """Aligned words, each learned once. Of a full store those words stay that were met again since the last turnover."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.coder = Tokenizers(path_a, path_b)
        self.size_b = len(self.coder.bytes_b)
        self.spelling = [f"{k}{end}" for t, ends in ((self.coder.bytes_a, ",|"), (self.coder.bytes_b, ",;")) for k in range(len(t)) for end in ends]
        self.spelling_length = np.array([len(x) for x in self.spelling], np.int64)
        self.known: dict[str, int] = {}
        self.texts: list[str] = []
        #: n_a, n_b, n_groups, n_links, unusable; then distinct pairs of the words one after the other.
        self.figures = np.zeros((0, 5), np.int32)
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.starts = np.zeros(1, np.int64)
        self.again = np.zeros(0, bool)
        self.characters = 0

    def _turn_over(self) -> None:
        kept = np.flatnonzero(self.again)
        if len(kept) > WORDS // 2:
            kept = kept[:0]
        sizes = np.diff(self.starts)[kept]
        at = np.repeat(self.starts[kept], sizes) + spread(sizes)
        names = list(self.known)
        self.known = {names[k]: n for n, k in enumerate(kept.tolist())}
        self.characters = sum(map(len, self.known))
        self.texts = [self.texts[k] for k in kept.tolist()]
        self.figures, self.pairs, self.times = self.figures[kept], self.pairs[at], self.times[at]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.again = np.zeros(len(kept), bool)

    def _learn(self, words: list[str]) -> None:
        flat, sizes = self.coder.encode(words)
        ends = [np.cumsum(t[x]) for t, x in zip((self.coder.length_a, self.coder.length_b), flat)]
        owners = [np.repeat(np.arange(len(words)), n) for n in sizes]
        # Both cover the same bytes of every word, so words follow each other at the same offsets.
        starts = [e - t[x] for e, t, x in zip(ends, (self.coder.length_a, self.coder.length_b), flat)]
        group_a, group_b = coalesce(starts[0], ends[0], starts[1], ends[1])
        n_groups = 1 + (group_a[-1] if len(group_a) else -1)
        owner = np.zeros(n_groups, np.int64)
        owner[group_a] = owners[0]
        group, pairs, times = links(flat[0], group_a, flat[1], group_b, self.size_b)
        space = len(self.coder.bytes_a) * self.size_b
        codes, times = sorted_sums(owner[group] * space + pairs, times)
        by_word = np.bincount(codes // space, minlength=len(words))
        figures = np.zeros((len(words), 5), np.int32)
        figures[:, 0], figures[:, 1] = sizes
        figures[:, 2] = np.bincount(owner, minlength=len(words))
        figures[:, 3] = np.bincount(owner, np.bincount(group_a, minlength=n_groups) * np.bincount(group_b, minlength=n_groups), len(words))
        figures[:, 4] = sizes[0] == 0
        first = len(self.known)
        self.known.update(zip(words, range(first, first + len(words))))
        self.characters += sum(map(len, words))
        self.texts += self._spelled(flat, (group_a, group_b), owners, len(words))
        self.figures = np.concatenate([self.figures, figures])
        self.pairs, self.times = np.concatenate([self.pairs, codes % space]), np.concatenate([self.times, times])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(by_word)])
        self.again = np.concatenate([self.again, np.zeros(len(words), bool)])

    def _spelled(self, ids, groups, owners, n: int) -> list[str]:
        """``a1,a2|b1;a3|b2,b3;`` for each word."""
        # Every id is followed by a comma, or by the sign that ends the tokens of its kind in the group.
        last = [np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in groups]
        code = np.concatenate([2 * ids[0] + last[0], 2 * len(self.coder.bytes_a) + 2 * ids[1] + last[1]])
        code = code[np.argsort(2 * np.concatenate(groups) + np.repeat([0, 1], [len(x) for x in ids]), kind="stable")]
        shown = "".join(map(self.spelling.__getitem__, code.tolist()))
        owner = np.sort(np.concatenate(owners), kind="stable")
        stops = np.concatenate([[0], np.cumsum(self.spelling_length[code])])[np.searchsorted(owner, np.arange(n), side="right")].tolist()
        return [shown[a:b] for a, b in zip([0, *stops], stops)]

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Figures (n_a, n_b, n_groups, n_links) and group texts of each text, then (text, pair, times) in order."""
        if len(self.known) > WORDS or self.characters > CHARACTERS:
            self._turn_over()
        split = self.coder.words(texts)
        flat = list(chain.from_iterable(split))
        index = np.array(list(map(self.known.get, flat, repeat(-1))), np.int64)
        self.again[index[index >= 0]] = True
        missing = np.flatnonzero(index < 0).tolist()
        if missing:
            words = [flat[k] for k in missing]
            self._learn(list(dict.fromkeys(words)))
            index[missing] = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        counts = np.array([len(s) for s in split], np.int64)
        owner = np.repeat(np.arange(len(texts)), counts)
        figures = np.zeros((len(texts), 5), np.int64)
        stops = np.cumsum(counts)
        if len(index):
            figures[counts > 0] = np.add.reduceat(self.figures[index], (stops - counts)[counts > 0], axis=0, dtype=np.int64)
        usable = figures[:, 4] == 0
        figures[~usable] = 0
        numbers = index.tolist()
        shown = ["".join(map(self.texts.__getitem__, numbers[b - c : b]))[:-1] if u else "" for b, c, u in zip(stops.tolist(), counts.tolist(), usable.tolist())]
        if not usable.all():
            index, owner = index[usable[owner]], owner[usable[owner]]
        sizes = self.starts[index + 1] - self.starts[index]
        at = np.repeat(self.starts[index], sizes) + spread(sizes)
        space = len(self.coder.bytes_a) * self.size_b
        codes, times = sorted_sums(np.repeat(owner, sizes) * space + self.pairs[at], self.times[at])
        return figures[:, :4], shown, codes // space, codes % space, times


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(path_a: str, path_b: str) -> Aligner:
    """One for each worker process and pair of files."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


_ROW = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, places binary, times binary"


def _align_blocks(path_a: str, path_b: str, with_groups: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        context = TaskContext.get()
        block = (context.partitionId() if context else 0) << 32
        held: list[tuple] = []
        size = 0
        for batch in W.slices(batches, 1 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            held.append((batch.column("doc_id"), *aligner.align(texts)))
            size += batch.nbytes
            if size > BLOCK:
                yield from _block(block, held, with_groups)
                block, held, size = block + 1, [], 0
        if held:
            yield from _block(block, held, with_groups)

    return run


def _block(block: int, held: list[tuple], with_groups: bool) -> Iterator[pa.RecordBatch]:
    """The rows of a block in batches, then one row with its distinct pairs and how many of its documents hold each."""
    pairs, place = np.unique(np.concatenate([h[4] for h in held]), return_inverse=True)
    documents = np.bincount(place, minlength=len(pairs))
    none = pa.nulls
    names = [c.split()[0] for c in _ROW.split(", ")] + ["pairs", "documents"]
    at = 0
    for doc_ids, figures, shown, text, _, times in held:
        n = len(shown)
        of_text = np.searchsorted(text, np.arange(n + 1))
        # Places ascend within a text; their steps are small numbers, which compress well.
        steps = place[at : at + len(text)].astype(np.int64)
        first = of_text[:-1][of_text[1:] > of_text[:-1]]
        moved = np.diff(steps, prepend=0)
        moved[first] = steps[first]
        at += len(text)
        columns = [_binary(v.astype("<i4"), of_text) for v in (moved, times)]
        digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in shown]
        made = [pa.array(figures[:, k]) for k in range(4)]
        shown_column = pa.array(shown, pa.string()) if with_groups else none(n, pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, block)), doc_ids, *made, shown_column, pa.array(digests, pa.string()), *columns, none(n, pa.list_(pa.int64())), none(n, pa.list_(pa.int64()))],
            names,
        )
    for a in range(0, len(pairs), 1 << 16):
        one = [pa.array([pairs[a : a + (1 << 16)]], pa.list_(pa.int64())), pa.array([documents[a : a + (1 << 16)]], pa.list_(pa.int64()))]
        empty = [none(1, pa.int64()), *[pa.array([a], pa.int64())], *[none(1, pa.int64()) for _ in range(3)], none(1, pa.string()), none(1, pa.string()), none(1, pa.binary()), none(1, pa.binary())]
        yield pa.RecordBatch.from_arrays([pa.array([block]), *empty, *one], names)


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of 32-bit numbers as one binary column."""
    offsets = pa.py_buffer((4 * ends).astype("<i4").tobytes())
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, pa.py_buffer(values.tobytes())])


def align_blocks(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = True) -> DataFrame:
    """The aligned documents in blocks, as a written table: rows of documents, and rows with the distinct pairs of a block.

    A row of a document has the steps between the places of its pairs in the list of its block and how often it holds each; a row of a
    list (``pairs`` not null) has its first place in ``n_a``.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = rows.mapInArrow(_align_blocks(path_a, path_b, with_groups), f"{_ROW}, pairs array<long>, documents array<long>")
    path = staging_path(spark)
    made.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def _listed(blocks: DataFrame) -> DataFrame:
    """(block, place, pair, documents)."""
    lists = blocks.where(F.col("pairs").isNotNull())
    exploded = lists.select("block", F.col("n_a").alias("first"), F.posexplode(F.arrays_zip("pairs", "documents")).alias("at", "entry"))
    return exploded.select("block", (F.col("first") + F.col("at")).cast("int").alias("place"), "entry.pairs", "entry.documents")


def link_counts(blocks: DataFrame, size_b: int) -> DataFrame:
    """(a, b, documents, best): how many documents hold the ids linked, and whether no other b has a higher count with a.

    Written as a table; sums of the blocks are added up before and after the shuffle.
    """
    spark = blocks.sparkSession
    path = staging_path(spark)
    _listed(blocks).groupBy("pairs").agg(F.sum("documents").alias("documents")).write.option("compression", "zstd").parquet(path)
    counts = spark.read.parquet(path).select(F.expr(f"pairs div {size_b}").alias("a"), F.expr(f"pairs % {size_b}").alias("b"), "documents")
    highest = counts.groupBy("a").agg(F.max("documents").alias("highest"))
    return counts.join(highest, "a").select("a", "b", "documents", (F.col("documents") == F.col("highest")).alias("best"))


def _sums(left: pa.Table, right: pa.Table) -> pa.Table:
    """Counts and bests of the documents of one block."""
    counts = np.zeros(right.num_rows, np.int64)
    best = np.zeros(right.num_rows, np.int64)
    place = right["place"].to_numpy()
    counts[place] = right["count"].to_numpy()
    best[place] = right["best"].to_numpy(zero_copy_only=False)
    sums, bests = [], []
    for steps, times in zip(left["places"].to_pylist(), left["times"].to_pylist()):
        at = np.cumsum(np.frombuffer(steps, "<i4"), dtype=np.int64)
        held = np.frombuffer(times, "<i4").astype(np.int64)
        sums.append(int(counts[at] @ held))
        bests.append(int(best[at] @ held))
    kept = left.drop_columns(["block", "places", "times"])
    return kept.append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))


def align(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = True) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, groups_sha256, n_best, count_sum), one row for each row of ``docs`` (doc_id, text).

    ``groups`` is ``a1,a2|b1;a3|b2,b3`` in decimal ids (null without ``with_groups``), groups_sha256 its hash in hex.
    n_links counts all pairs of tokens that share a group; count_sum adds up the document counts of their ids, n_best
    counts those with the highest count of their A id, ties included. Null and empty texts, and texts that either
    tokenizer changes, have no tokens: zeros and empty strings. Rows that repeat count as a document each. Other columns are
    ignored; an empty table gives no rows.
    """
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    blocks = align_blocks(docs, path_a, path_b, with_groups)
    counts = link_counts(blocks, size_b).select((F.col("a") * size_b + F.col("b")).alias("pairs"), F.col("documents").alias("count"), "best")
    found = _listed(blocks).select("block", "place", "pairs").join(counts, "pairs").select(F.col("block").alias("in_block"), "place", "count", "best")
    rows = blocks.where(F.col("pairs").isNull()).drop("pairs", "documents")
    schema = _ROW.removeprefix("block long, ").removesuffix(", places binary, times binary") + ", n_best long, count_sum long"
    return rows.groupBy("block").cogroup(found.groupBy("in_block")).applyInArrow(_sums, schema)
