"""Token ids in coded files: a context-mixing range coder over independently reset, checksummed blocks.

A file is a sequence of chunks. A chunk holds whole documents: a header, the doc_ids and their
token counts, and the concatenated ids in blocks of ``BLOCK``. Each block is coded on its own from a fresh model and
carries its number of words and the CRC-32 of its ids, which is tested when it is read. The last block of a chunk is
filled up with zeros, so that all blocks have the same steps.

The model of a block predicts the id from the last two ids and from the last one, by what followed them
before. How often that was right, by how sure it was, gives their shares of the code space, mixed where both
predict the same id. The rest goes by order 0, the adaptive frequencies of the number of bits of an id, whose
lower bits follow plainly. The shares drive a 64-bit range coder. All blocks of a chunk advance
together as arrays, so that a step of the coder is a few array operations.

Chunks are rows of a Parquet table (shard, before, tokens, content), which Spark writes and reads
on any store; ``content`` is the format above.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm import words as W
from lotwise.llm.tokens import encoder, text_groups
from lotwise.sources.staging import small_table

MAGIC = b"LTK2"
BLOCK = 2048
#: Tokens after which a chunk ends with the document (a longer document is one chunk).
CHUNK_TOKENS = 1 << 23
#: Tokens of the documents that leave a chunk together when it is read.
BATCH_TOKENS = 1 << 20
SLOTS = 512
#: Steps after which the shares are made anew, and how many steps before them are counted.
REFRESH = frozenset((32, 64, 128, 256, 512, 1024, 1536))
WINDOW = 64
COUNTED = frozenset(step for r in REFRESH for step in range(max(r - WINDOW, 0) + 1, r + 1))
_HALF, _SIXTEEN, _FULL, _LOWER, _LAST = np.uint64(32), np.uint64(16), np.uint64(2**32), np.uint64(2**32 - 1), np.uint64(65535)
_ONE, _CARRY = np.int64(1), np.uint32(1)
#: Places of contexts: the highest bits of a product.
_MIX, _MIX_BEFORE, _TOP = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(32 - SLOTS.bit_length() + 1)


class _Model:
    """Predictions and frequencies of many blocks at once; coder and decoder run the same steps.

    A table entry is the id that followed a context last, and above it how often in a row that was right (0 to 3). The shares follow
    at the steps ``REFRESH`` from what was counted in the ``WINDOW`` steps before each.
    """

    def __init__(self, lanes: int, decodes: bool = False) -> None:
        self.lanes, self.decodes = lanes, decodes
        lane = np.arange(lanes)
        self.lane17, self.lane256 = lane * 17, lane * 256
        self.base, self.lane32 = (lane * SLOTS).astype(np.uint32), (lane * 32).astype(np.int32)
        self.tables = [np.zeros(lanes * SLOTS, np.int32) for _ in range(2)]
        self.prev = np.zeros(lanes, np.uint32)
        self.before = np.zeros(lanes, np.uint32)
        self.counts = [np.tile(np.array([2, 1]), (lanes, 4, 1)) for _ in range(2)]  # wrong, right
        self.classes = np.zeros((lanes, 17), np.int64)
        self.step = 0
        self.seen: list[tuple[np.ndarray, ...]] = []
        self._refresh()

    def _refresh(self) -> None:
        if self.seen:
            state, hit2, hit1, more = (np.stack(x) for x in zip(*self.seen))
            size = self.lanes * 8
            self.counts[0] += np.bincount((state >> 3 << 1 | hit2).ravel(), minlength=size).reshape(-1, 4, 2)
            self.counts[1] += np.bincount((state >> 5 << 3 | state & 6 | hit1).ravel(), minlength=size).reshape(-1, 4, 2)
            keys = (more + self.lane17)[~(hit2 | hit1)]
            self.classes += np.bincount(keys, minlength=self.lanes * 17).reshape(-1, 17)
            self.seen.clear()
        p2, p1 = ((c[..., 1] << 16) // c.sum(axis=2) for c in self.counts)
        # By sureness of order 2, of order 1, and whether they agree on the id: mixed where they do.
        first = np.empty((self.lanes, 4, 4, 2), np.int64)
        first[..., 0] = p2[:, :, None]
        first[..., 1] = (3 * p2[:, :, None] + p1[:, None, :]) >> 2
        first = first.clip(512, 60_000)
        second = first + ((65536 - first) * p1[:, None, :, None] >> 16).clip(512)
        second[..., 1] = first[..., 1]
        self.bounds = (second.clip(None, 65536 - 2048) << 16 | first).reshape(-1).astype(np.uint32)
        # Order 0: how many bits the id has. Of 256 parts every number of bits keeps one; the most frequent has what is left over.
        share = 1 + 239 * (8 * self.classes + 1) // (8 * self.classes.sum(axis=1, keepdims=True) + 17)
        share[np.arange(self.lanes), share.argmax(axis=1)] += 256 - share.sum(axis=1)
        ends = np.cumsum(share, axis=1)
        self.parts = (ends << 16 | ends - share).reshape(-1).astype(np.int32)
        if self.decodes:
            self.part_of = np.repeat(np.tile(np.arange(17, dtype=np.uint8), self.lanes), share.reshape(-1))

    def predict(self):
        """The ids of both contexts, and the bounds of their shares in 65536."""
        mixed = self.prev * _MIX
        self.at2 = ((mixed + self.before >> _TOP) + self.base).astype(np.int64)
        self.at1 = ((mixed >> _TOP) + self.base).astype(np.int64)
        self.before = mixed * _MIX_BEFORE
        self.entry2, self.entry1 = e2, e1 = self.tables[0].take(self.at2), self.tables[1].take(self.at1)
        c2, c1 = e2 & 0xFFFF, e1 & 0xFFFF
        self.state = (self.lane32 + (e2 >> 13 & 24) + (e1 >> 15 & 6) + (c1 == c2).astype(np.int32)).astype(np.int64)
        bounds = self.bounds.take(self.state)
        return c2, c1, (bounds & 0xFFFF).view(np.int32), (bounds >> 16).view(np.int32)

    def spread(self, second: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bounds of a number of bits in what the contexts leave."""
        parts, rest = self.parts.take(more + self.lane17), 65536 - second
        return second + (rest * (parts & 0xFFFF) >> 8), second + (rest * (parts >> 16) >> 8)

    def update(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray, more: np.ndarray) -> None:
        for table, at, entry, hit in ((self.tables[0], self.at2, self.entry2, hit2), (self.tables[1], self.at1, self.entry1, hit1)):
            table[at] = np.where(hit, np.minimum(entry + 65536, entry | 0x30000), ids)
        self.step += 1
        if self.step in COUNTED:
            self.seen.append((self.state, hit2, hit1, more))
            if self.step in REFRESH:
                self._refresh()
        self.prev = ids.view(np.uint32)


_MORE = np.array([(i + 1).bit_length() - 1 for i in range(65536)], np.uint8)


def _turned(grid: np.ndarray, kind) -> np.ndarray:
    """The transpose, a few columns at a time, so that what is read and written stays in the caches."""
    out = np.empty(grid.shape[::-1], kind)
    for a in range(0, len(out), 32):
        out[a : a + 32] = grid[:, a : a + 32].T
    return out


def encode_blocks(blocks: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Codes rows of ``blocks`` (ids below 65536), of which the first ``sizes`` ids count; zeros are coded behind them."""
    lanes, steps = blocks.shape
    if not lanes:
        return []
    columns = _turned(blocks, np.int32)
    for lane in np.flatnonzero(sizes < steps):
        columns[sizes[lane] :, lane] = 0
    out = np.zeros((steps + 3) * lanes, np.uint32)
    place = np.arange(lanes)
    low = np.zeros(lanes, np.uint64)
    span = np.full(lanes, 2**64 - 1, np.uint64)
    model = _Model(lanes)
    for ids in columns:
        more = _MORE.take(ids.astype(np.int64)).astype(np.int64)
        c2, c1, first, second = model.predict()
        hit2, hit1 = c2 == ids, c1 == ids
        hit = hit2 | hit1
        lowest, highest = model.spread(second, more)
        start = np.where(hit, np.where(hit2, 0, first), lowest)
        stop = np.where(hit, np.where(hit2, first, second), highest)
        part = span >> _SIXTEEN
        # An id told by its number of bits: the bits below the highest one follow as they are.
        span = part * (stop - start).astype(np.uint64) >> np.where(hit, 0, more).view(np.uint64)
        tail = np.where(hit, 0, ids + 1 - (_ONE << more))
        added = low + (part * start.astype(np.uint64) + span * tail.view(np.uint64))
        to = place.take((added < low).nonzero()[0]) - lanes  # a carry into the word before, and on where that overflows
        while len(to):
            more_by_one = out.take(to) + _CARRY
            out[to] = more_by_one
            to = to[more_by_one == 0] - lanes
        low = added
        at = (span < _FULL).nonzero()[0]
        word, to = low.take(at), place.take(at)
        out[to] = word >> _HALF
        place[at] = to + lanes
        low[at] = word << _HALF
        span[at] = span.take(at) << _HALF
        model.update(ids, hit2, hit1, more)
    for word in (low >> _HALF, low & _LOWER):
        out[place] = word
        place += lanes
    used = place // lanes
    words = _turned(out.reshape(-1, lanes)[: int(used.max())], "<u4")
    return [words[i, :n].tobytes() for i, n in enumerate(used.tolist())]


def decode_blocks(codes: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """The ids of blocks as rows as long as the largest of ``sizes``."""
    lanes, steps = len(codes), int(sizes.max(initial=0))
    if not lanes:
        return np.zeros((0, 0), np.int32)
    widest = max((len(c) for c in codes), default=0) // 4
    words = np.zeros((lanes, widest + 3), np.uint32)
    for i, code in enumerate(codes):
        words[i, : len(code) // 4] = np.frombuffer(code, "<u4")
    words = _turned(words, np.uint32)
    value = words[0].astype(np.uint64) << _HALF | words[1]
    last = (widest + 2) * lanes
    words = words.reshape(-1)
    place = np.arange(lanes) + 2 * lanes
    ids_out = np.zeros((steps, lanes), np.int32)
    span = np.full(lanes, 2**64 - 1, np.uint64)
    model = _Model(lanes, decodes=True)
    for step in range(steps):
        c2, c1, first, second = model.predict()
        part = span >> _SIXTEEN
        # A damaged block may point behind the last share.
        target = np.minimum(value // part, _LAST).astype(np.int32)
        hit2, hit = target < first, target < second
        # The number of bits is the last whose lower bound, scaled to what is left, does not pass the target.
        scaled = (((target - second + 1 << 8) - 1) / (65536 - second)).astype(np.int64)
        more = model.part_of.take(scaled + model.lane256, mode="clip").astype(np.int64)
        lowest, highest = model.spread(second, more)
        start = np.where(hit, np.where(hit2, 0, first), lowest)
        stop = np.where(hit, np.where(hit2, first, second), highest)
        below = np.where(hit, 0, more)
        value -= part * start.astype(np.uint64)
        span = part * (stop - start).astype(np.uint64) >> below.view(np.uint64)
        tail = value // span
        value -= span * tail
        at = (span < _FULL).nonzero()[0]
        to = place.take(at)
        value[at] = value.take(at) << _HALF | words.take(to, mode="clip")
        place[at] = to + lanes
        span[at] = span.take(at) << _HALF
        ids = np.where(hit, np.where(hit2, c2, c1), ((_ONE << below) - 1 + tail.view(np.int64)).astype(np.int32))
        ids_out[step] = ids
        model.update(ids, hit2, c1 == ids, more)
    return _turned(ids_out, np.int32)


def encode_chunk(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """The bytes of one chunk. ``ids`` are those of all documents, below 65536."""
    if len(ids) and int(ids.max()) > 0xFFFF:
        raise ValueError("the format holds ids below 65536")
    cuts = range(0, len(ids), BLOCK)
    sizes = np.array([min(BLOCK, len(ids) - at) for at in cuts], np.int64)
    padded = np.zeros(len(sizes) * BLOCK, "<u4")
    padded[: len(ids)] = ids
    grid = padded.reshape(-1, BLOCK)[:, : int(sizes.max(initial=0))]
    codes = encode_blocks(grid, sizes)
    sums = [zlib.crc32(row) for row in grid]
    known = np.array([d is not None for d in doc_ids], np.uint8)
    return b"".join([
        MAGIC, struct.pack("<III", len(doc_ids), len(ids), len(sizes)),
        known.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array(counts, "<u4").tobytes(),
        np.array([len(c) for c in codes], "<u4").tobytes(), np.array(sums, "<u4").tobytes(), *codes,
    ])


def decode_chunk(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc_ids, counts, ids) of a chunk; raises ValueError where a block's checksum does not hold."""
    if data[:4] != MAGIC:
        raise ValueError("not a chunk of token ids")
    docs, total, blocks = struct.unpack_from("<III", data, 4)
    at = 16

    def column(kind: str, size: int) -> np.ndarray:
        nonlocal at
        values = np.frombuffer(data, kind, size, at)
        at += values.nbytes
        return values

    known, names, counts = column("u1", docs), column("<i8", docs), column("<u4", docs)
    lengths, sums = column("<u4", blocks), column("<u4", blocks)
    ends = at + np.cumsum(lengths, dtype=np.int64)
    codes = [data[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist())]
    sizes = np.full(blocks, BLOCK, np.int64)
    if blocks:
        sizes[-1] = total - BLOCK * (blocks - 1)
    grid = decode_blocks(codes, sizes).astype("<u4", copy=False)
    for k, (row, want) in enumerate(zip(grid, sums.tolist())):
        if zlib.crc32(row) != want:
            raise ValueError(f"block {k} is damaged")
    return [n if k else None for n, k in zip(names.tolist(), known.tolist())], counts, grid.reshape(-1)[:total]


def _write(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        context = TaskContext.get()
        shard, before = context.partitionId() if context else 0, 0
        docs: list[int | None] = []
        parts: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            content = encode_chunk(docs, [len(p) for p in parts], ids)
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "before": pa.array([before], pa.int64()),
                "tokens": pa.array([len(ids)], pa.int64()), "content": pa.array([content], pa.binary()),
            })

        for batch in W.slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            names = batch.column("doc_id").to_pylist()
            for a, b in text_groups(texts):
                for name, ids in zip(names[a:b], coder.encode(texts[a:b])):
                    docs.append(name)
                    parts.append(np.append(ids, np.uint32(end_id)))
                    held += len(ids) + 1
                    if held >= CHUNK_TOKENS:
                        yield flush()
                        docs, parts, held, before = [], [], 0, before + held
        if docs:
            yield flush()

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, content in zip(batch.column("start"), batch.column("content")):
            docs, counts, ids = decode_chunk(content.as_py())
            counts = counts.astype(np.int64)
            ends = np.cumsum(counts)
            # A chunk leaves in several batches, each of whole documents.
            cuts = [0, *(np.flatnonzero(np.diff(ends // BATCH_TOKENS)) + 1).tolist(), len(docs)]
            for a, b in zip(cuts, cuts[1:]):
                pieces = [ids[e - n : e].tobytes() for e, n in zip(ends[a:b].tolist(), counts[a:b].tolist())]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(docs[a:b], pa.int64()), "start": pa.array(start.as_py() + ends[a:b] - counts[a:b], pa.int64()),
                    "n_tokens": pa.array(counts[a:b]), "ids": pa.array(pieces, pa.binary()),
                    "ids_crc32": pa.array([zlib.crc32(p) for p in pieces], pa.int64()),
                })


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Writes the ids of all texts of ``docs`` (doc_id, text; other columns are ignored) in ascending doc_id order.

    A null or empty text is the end id alone. Null doc_ids come first; rows with one doc_id are ordered by a hash of
    the text, and repeated rows are written each. An empty table makes an empty folder of files.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    made = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _write(tokenizer, end_id), "shard int, before long, tokens long, content binary"
    )
    made.write.parquet(path)


def read_tokens(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids, ids_crc32) of written files; ``ids`` are little-endian unsigned 32-bit."""
    spark = files.sparkSession
    bases, total = [], 0
    for row in files.groupBy("shard").agg(F.sum("tokens").alias("tokens")).orderBy("shard").collect():  # a row for each file
        bases.append((row["shard"], total))
        total += row["tokens"]
    base = small_table(spark, bases, "shard int, base long")
    chunks = files.join(base, "shard").select((F.col("base") + F.col("before")).alias("start"), "content")
    return chunks.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long")
