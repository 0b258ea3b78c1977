"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

BLANKS = re.compile("[^\x20\x09-\x0d]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text: str | None, width: int = 5) -> frozenset:
    words = BLANKS.findall((text or "").translate(UPPER))
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def jaccard(rows: list[tuple[int, str | None]], threshold: int = 75) -> list[tuple[int, int, int]]:
    sets = [shingles(text) for _, text in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= threshold * len(a | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {g: min(rows[i][0] for i in range(len(rows)) if group[i] == g) for g in group}
    return sorted((rows[i][0], len(sets[i]), least[group[i]]) for i in range(len(rows)))


def without_repeats(rows: list[tuple[int, str | None]], width: int = 35) -> list[tuple[int, str, int, int]]:
    words = [BLANKS.findall(text or "") for _, text in rows]
    places: dict[tuple, list] = {}
    for d, w in enumerate(words):
        for i in range(len(w) - width + 1):
            places.setdefault(tuple(w[i : i + width]), []).append((d, i))
    gone = {(d, i + k) for found in places.values() if len(found) > 1 for d, i in found for k in range(width)}
    out = []
    for d, w in enumerate(words):
        kept = [x for i, x in enumerate(w) if (d, i) not in gone]
        out.append((rows[d][0], " ".join(kept), len(w), len(w) - len(kept)))
    return sorted(out)


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def hits(text: str | None, items: list[tuple[str, str | None]], width: int = 10) -> tuple[int, set[int], set[str]]:
    words = WORD.findall((text or "").translate(UPPER))
    hit, found = set(), set()
    for name, item in items:
        w = WORD.findall((item or "").translate(UPPER))
        for i in range(max(1, len(w) - width + 1) if w else 0):
            window = w[i : i + width]
            for at in range(len(words) - len(window) + 1):
                if words[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    found.add(name)
    return len(words), hit, found


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)


def base_secrets(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, a, b) for a, _, b, k in sorted(found)]


def ids(text: str | None, end: int) -> list[int]:
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, end]


def crc(numbers: list[int]) -> int:
    return zlib.crc32(b"".join(n.to_bytes(4, "little") for n in numbers))


ENTRIES = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ENTRIES.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def _piece_bytes(number: int) -> bytes:
    piece = PIECES.id_to_piece(number)
    return bytes([int(piece[3:5], 16)]) if PIECES.is_byte(number) else piece.replace("▁", " ").encode()


def token_groups(text: str | None) -> list[tuple[list[int], list[int]]]:
    """Whole texts through both tokenizers, cut where both have a token's end."""
    if not text:
        return []
    coded = ENTRIES.encode(" " + text, add_special_tokens=False)
    # Offsets are in characters; a character whose bytes are split shows up in several tokens, so lengths come from the entries.
    byte = {c: bytes([b]) for b, c in _shown().items()}
    first = [(i, b"".join(byte[c] for c in t)) for i, t in zip(coded.ids, coded.tokens)]
    second = [(i, _piece_bytes(i)) for i in PIECES.encode(text)]
    whole = (" " + text).encode()
    if any(b"".join(x for _, x in t) != whole for t in (first, second)):
        return []
    groups, a, b, at_a, at_b = [([], [])], 0, 0, 0, 0
    while a < len(first) or b < len(second):
        if at_a == at_b and groups[-1] != ([], []):
            groups.append(([], []))
        if at_a <= at_b:
            groups[-1][0].append(first[a][0])
            at_a, a = at_a + len(first[a][1]), a + 1
        else:
            groups[-1][1].append(second[b][0])
            at_b, b = at_b + len(second[b][1]), b + 1
    return groups


def _shown() -> dict[int, str]:
    same = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in same]
    return {b: chr(b) for b in same} | {b: chr(256 + k) for k, b in enumerate(rest)}


def alignments(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, groups_sha256, n_best, count_sum)."""
    held = [token_groups(t) for _, t in rows]
    linked = [Counter((a, b) for g in groups for a in g[0] for b in g[1]) for groups in held]
    counts = Counter(pair for pairs in linked for pair in pairs)
    highest: dict[int, int] = {}
    for (a, _), n in counts.items():
        highest[a] = max(n, highest.get(a, 0))
    out = []
    for (doc, _), groups, pairs in zip(rows, held, linked):
        shown = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((
            doc, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(pairs.values()), shown, sha(shown) if groups else "",
            sum(n for p, n in pairs.items() if counts[p] == highest[p[0]]), sum(n * counts[p] for p, n in pairs.items()),
        ))
    return out


def middle_filled(doc: int | None, text: str | None, percent: int = 90, suffix_first: int = 20) -> tuple:
    """(n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    digest = sha(f"1:{'' if doc is None else doc}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(text) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(text), "plain", None, None, text
    if h[3] % 100 < suffix_first:
        return len(text), "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return len(text), "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"
