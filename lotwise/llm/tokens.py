"""Token ids of whole texts by a public tokenizer file, each distinct word encoded once."""

from __future__ import annotations

from itertools import chain

import numpy as np
from tokenizers import Tokenizer

from lotwise.llm import words as W

#: Words kept between texts; beyond that those not met again since the last turnover are forgotten.
WORDS = 500_000
#: Longest word in bytes that the table holds; longer ones have a dictionary.
SHORT = 15
#: Bytes of text handled at once.
SLICE = 1 << 20
#: Marks that may follow a word and are encoded on their own then.
_TRAIL = b".,;:!?#$%&*|"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MARK = np.zeros(256, bool)
_MARK[list(_TRAIL)] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*b"0123456789abcdefghijklmnopqrstuvwxyz"]] = True
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _last_unmarked(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The last place up to each of ``at`` whose byte is no mark; 0 if there is none."""
    inner = at.copy()
    left = np.flatnonzero(_MARK[raw[inner]])
    for _ in range(4):  # words end in a few marks, if in any
        inner[left] -= 1
        left = left[_MARK[raw[inner[left]]]]
    if len(left):
        inner[left] = np.maximum.accumulate(np.where(_MARK[raw], 0, np.arange(len(raw))))[inner[left]]
    return inner


class WordTable:
    """Numbers of short words in open addressing: 15 bytes and the length are the key, so equal keys are equal words."""

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.keys = np.zeros((2, 1 << bits), np.uint64)
        self.numbers = np.full(1 << bits, -1, np.int32)

    def _slots(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return (W.mix(first + second * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The number of each word, or -1."""
        slots = self._slots(first, second)
        found = self.numbers[slots]
        left = np.flatnonzero((found >= 0) & ((self.keys[0][slots] != first) | (self.keys[1][slots] != second)))
        while len(left):
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)
            at = slots[left]
            found[left] = self.numbers[at]
            left = left[(found[left] >= 0) & ((self.keys[0][at] != first[left]) | (self.keys[1][at] != second[left]))]
        return found

    def add(self, first: np.ndarray, second: np.ndarray, numbers: np.ndarray) -> None:
        """Distinct words that are not in the table."""
        slots, left = self._slots(first, second), np.arange(len(first))
        while len(left):
            at = slots[left]
            free = self.numbers[at] < 0
            self.numbers[at[free]] = numbers[left[free]]
            # Of several words for one free slot, the last one has got it.
            mine = self.numbers[at] == numbers[left]
            self.keys[0][at[mine]], self.keys[1][at[mine]] = first[left[mine]], second[left[mine]]
            left = left[~mine]
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)


class WordEncoder:
    """Encodes like ``Tokenizer.encode`` without added special tokens.

    It is for tokenizers that ignore case, treat blanks as borders and drop them, and separate letters and
    digits from marks; a few probes test that. Then the ids of a text are those of its
    words one after the other. Words are separated at ASCII blanks; words share an entry whatever the case of their ASCII letters,
    and the marks behind them are a word of their own.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        # Byte-level entries write each byte as one printable character: itself, or the next one from 256 on.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        self.shown = {b: 256 + k for k, b in enumerate(sorted(set(range(256)).difference(shown)))}
        # Word 0 is empty. ``keys`` are those of short words; a long one has its name in ``long``.
        self.table = WordTable((2 * WORDS).bit_length())
        self.long: dict[bytes, int] = {}
        self.keys = np.zeros((2, 1), np.uint64)
        self.again = np.ones(1, bool)
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(2, np.int64)
        for probe in ("a b", "One,\ttwo.\nThree 4\r\n", " é Ü... x1$$$ ", "<|endoftext|>, <|X", "straße NAÏVE Ærø ﬁn 日本 İx Σίσυφος"):
            if self.encode([probe])[0].tolist() != self.tokenizer.encode(probe, add_special_tokens=False).ids:
                raise ValueError(f"{path} does not treat words apart")

    def _turn_over(self) -> None:
        """Keeps the words met again since the last turnover."""
        self.again[0] = True
        kept = np.flatnonzero(self.again)
        if len(kept) > WORDS // 2:
            kept = kept[:1]
        moved = np.full(len(self.again), -1, np.int64)
        moved[kept] = np.arange(len(kept))
        self.long = {w: int(moved[k]) for w, k in self.long.items() if moved[k] >= 0}
        self.keys = self.keys[:, kept]
        sizes = np.diff(self.starts)[kept]
        ends = np.cumsum(sizes)
        self.ids = self.ids[np.arange(ends[-1]) + np.repeat(self.starts[kept] - (ends - sizes), sizes)]
        self.starts = np.concatenate([[0], ends])
        self.again = np.zeros(len(kept), bool)
        self._fill_table()

    def _fill_table(self) -> None:
        """A table with the short words, half full at most."""
        short = np.flatnonzero(self.keys[1] > 0)
        self.table = WordTable((2 * max(WORDS, len(short))).bit_length())
        self.table.add(self.keys[0][short], self.keys[1][short], short.astype(np.int32))

    def _coded(self, words: list[bytes]) -> list[list[int]]:
        """Ids of distinct words. Words of letters are one piece to the model, which is asked directly."""
        coded: list = [None] * len(words)
        tokenize = self.tokenizer.model.tokenize
        others, rest = [], []
        for k, w in enumerate(words):
            if w.isalpha():
                coded[k] = [t.id for t in tokenize(w.decode())]
            elif w.isascii():
                rest.append((k, w.decode()))
            else:
                text = w.decode()
                # Blanks beyond ASCII would be cut.
                (others if text.split() == [text] else rest).append((k, text))
        # The tokenizer's own form of all at once.
        formed = self.tokenizer.normalizer.normalize_str("\n".join(t for _, t in others)).split(" ") if others else []
        for (k, text), form in zip(others, formed, strict=True):
            if form.isalpha():
                coded[k] = [t.id for t in tokenize(form.encode().decode("latin-1").translate(self.shown))]
            else:
                rest.append((k, text))
        for (k, _), c in zip(rest, self.tokenizer.encode_batch_fast([t for _, t in rest], add_special_tokens=False)):
            coded[k] = c.ids
        return coded

    def _learn(self, words: list[bytes], keys: np.ndarray) -> np.ndarray:
        coded = self._coded(words)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        numbers = np.arange(len(self.again), len(self.again) + len(words))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(coded), np.uint32, int(sizes.sum()))])
        self.keys = np.concatenate([self.keys, keys], axis=1)
        self.again = np.concatenate([self.again, np.zeros(len(words), bool)])
        return numbers

    def _numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words and the marks behind them, two for each word, and how many words come before each text's end."""
        joined = b" ".join(texts)
        raw = np.frombuffer(b" " + joined.lower() + b" " + bytes(16), np.uint8)
        size = len(joined) + 2
        blank = _SPACE[raw[:size]]
        edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        inner = _last_unmarked(raw[:size], ends - 1)
        cut = np.where((inner >= starts) & _ALNUM[raw[inner]], inner + 1, ends)
        signs = np.flatnonzero((raw[: size - 1] == 0x3C) & (raw[1:size] == 0x7C))
        control = np.unique(np.searchsorted(starts, signs, side="right") - 1)
        cut[control] = ends[control]
        first, last = np.stack([starts, cut], 1).reshape(-1), np.stack([cut, ends], 1).reshape(-1)
        # Most words have no marks behind them; what is empty is word 0 and not looked for.
        places = np.flatnonzero(last > first)
        total, control = len(first), np.searchsorted(places, 2 * control)
        first, last = first[places], last[places]
        length = last - first
        eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
        keys = np.empty((2, len(first)), np.uint64)
        keys[0] = eight[first] & _MASK[np.minimum(length, 8)]
        keys[1] = eight[np.minimum(first + 8, len(eight) - 1)] & _MASK[np.clip(length - 8, 0, 7)] | length.astype(np.uint64) << np.uint64(56)
        numbers = self.table.find(*keys).astype(np.int64)
        apart = length > SHORT
        apart[control] = True
        numbers[apart] = -1
        self.again[numbers[numbers >= 0]] = True
        if len(new := np.flatnonzero((numbers < 0) & ~apart)):
            order = np.lexsort(keys[:, new])
            key = keys[:, new[order]]
            head = np.ones(len(new), bool)
            head[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
            which = new[order[head]]
            names = raw.tobytes()
            learned = self._learn([names[a:b] for a, b in zip(first[which].tolist(), last[which].tolist())], key[:, head])
            if 2 * len(self.again) > 1 << self.table.bits:
                self._fill_table()
            else:
                self.table.add(*key[:, head], learned.astype(np.int32))
            numbers[new[order]] = learned[np.cumsum(head) - 1]
        if len(others := np.flatnonzero(apart)):
            # Control tokens keep their case: only their exact spelling is one.
            exact, lowered = b" " + joined + b" ", raw.tobytes()
            is_control = np.zeros(len(length), bool)
            is_control[control] = True
            names = [(exact if c else lowered)[a:b] for c, a, b in zip(is_control[others].tolist(), first[others].tolist(), last[others].tolist())]
            missing = [w for w in dict.fromkeys(names) if w not in self.long]
            if missing:
                self.long.update(zip(missing, self._learn(missing, np.zeros((2, len(missing)), np.uint64)).tolist()))
            numbers[others] = [self.long[w] for w in names]
            self.again[numbers[others]] = True
        found = np.zeros(total, np.int64)
        found[places] = numbers
        return found, np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]), side="right")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        raw = [t.encode() for t in texts]
        out: list[np.ndarray] = []
        first = 0
        while first < len(raw):
            last, held = first, 0
            while last < len(raw) and (last == first or held + len(raw[last]) < SLICE):
                held += len(raw[last])
                last += 1
            if len(self.again) > WORDS:
                self._turn_over()
            numbers, stops = self._numbers(raw[first:last])
            starts = self.starts[numbers]
            sizes = self.starts[numbers + 1] - starts
            ends = np.cumsum(sizes)
            flat = self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]
            out += np.split(flat, np.concatenate([[0], ends])[2 * stops[:-1]])
            first = last
        return out


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One for each worker process and file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def text_groups(texts: list[str], size: int = 1 << 20):
    """(first, last) of runs of texts of about ``size`` characters."""
    first, held = 0, 0
    for at, text in enumerate(texts):
        if held and held + len(text) > size:
            yield first, at
            first, held = at, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)
