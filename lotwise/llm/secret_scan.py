"""Secrets in texts: fixed patterns, and strings that look random to character Markov models.

Everything is DataFrame expressions. A regular expression's matches and the pieces between
them (``regexp_extract_all`` and ``split`` by the same pattern) give the places in code points by adding up lengths.

Two order-1 Markov models, of random strings and of ordinary identifiers, are counted from labelled samples. A string
of enough characters is suspicious if the mean log-likelihood ratio of its transitions passes a
threshold. The ratios are one array in the plan, indexed by the two characters.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.words import chosen_texts

#: Fixed patterns: kind, expression, the group whose length counts, and its least length.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    # The maximal runs of [0-9a-f]+ that are long enough.
    ("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
)
MARKOV = "markov"
#: Strings that the models judge: characters, and least length.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_="
CANDIDATE = "[A-Za-z0-9+/_=]"
MIN_LENGTH = 20
#: Mean log-likelihood ratio per transition (in nats) from which a string is suspicious.
THRESHOLD = 0.7
#: Bound of the training sample, in texts.
TRAIN_DOCS = 2_000
#: Weight of a character's overall frequency in its transitions, and what every character is counted in addition.
BACK_OFF, RARE = 16.0, 0.1


_SPAN = "array<struct<start:int,end:int,kind:string>>"


def _run(letters: str, least: int) -> str:
    """The maximal runs of ``letters`` with at least so many; no match begins inside a run."""
    return f"(?<!{letters}){letters}{{{least},}}"


#: Matches whose places are added up in one array.
BLOCK = 128
_PARTS = "array<struct<gap:int,size:int,holds:boolean>>"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, also where lambdas repeat it."""
    return F.transform(F.array(value), use)[0]


def _spans(text: Column, kind: str, pattern: str, holds: Callable[[Column], Column], group: int = 0) -> Column:
    """Array of (start, end, kind) of the leftmost non-overlapping matches for whose group ``holds`` is true."""
    parts = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length).alias("size"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), holds).alias("holds"),
    )
    end = lambda part: part["gap"] + F.coalesce(part["size"], F.lit(0))
    none = F.array().cast(_SPAN)

    def step(state: Column, part: Column) -> Column:
        start, stop = state["at"] + part["gap"], state["at"] + end(part)
        hit = F.array(F.struct(start.alias("start"), stop.alias("end"), F.lit(kind).alias("kind")))
        return F.struct(stop.alias("at"), F.when(part["holds"], F.concat(state["found"], hit)).otherwise(state["found"]).alias("found"))

    def located(block: Column) -> Column:
        return F.aggregate(block["parts"], F.struct(block["first"].alias("at"), none.alias("found")), step, lambda state: state["found"])

    # An array that grows by one is copied each time, so it only grows within a block, and the offsets of the blocks in one of their own.
    def cut(all_parts: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(all_parts) - 1, F.lit(BLOCK)), lambda i: F.slice(all_parts, i + 1, BLOCK))

    def joined_blocks(blocks: Column) -> Column:
        sizes = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda total, part: total + end(part)))
        firsts = F.aggregate(sizes, F.array(F.lit(0)), lambda held, size: F.concat(held, F.array(F.element_at(held, -1) + size)))
        zipped = F.zip_with(blocks, firsts, lambda block, first: F.struct(F.coalesce(block, F.array().cast(_PARTS)).alias("parts"), first.alias("first")))
        return F.flatten(F.transform(zipped, located))

    found = _once(_once(parts, cut), joined_blocks)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """All spans of the fixed patterns by start, then kind as listed; texts must not be null."""
    def long_enough(least: int) -> Callable[[Column], Column]:
        return lambda value: F.length(value) >= least

    found = (_spans(text, kind, pattern, long_enough(least), group) for kind, pattern, group, least in KINDS)
    return _ordered(F.concat(*found))


def _ordered(spans: Column) -> Column:
    """By start, then kind as listed; the kinds happen to need an order of their own."""
    order = {k: i for i, k in enumerate((*(k[0] for k in KINDS), MARKOV))}
    ranks = F.create_map(*(x for k, i in order.items() for x in (F.lit(k), F.lit(i))))
    ranked = F.transform(spans, lambda s: F.struct(s["start"], ranks[s["kind"]].alias("rank"), s["end"], s["kind"]))
    return F.transform(F.array_sort(ranked), lambda s: F.struct(s["start"], s["end"], s["kind"]))


def joined(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _codes(text: Column) -> Column:
    """Character codes; texts hold ASCII characters only."""
    return F.transform(F.split(text, ""), F.ascii)


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios of transitions, at index 128 * first + second character code.

    ``samples`` has text and random (boolean). Transitions are counted over all rows; characters outside the alphabet
    are left out, as are null rows. Without samples all ratios are 0.
    """
    codes = F.filter(_codes(F.regexp_replace("text", f"[^{ALPHABET}]", "")), lambda c: c > 0)
    pairs = F.when(
        F.size(codes) > 1,
        F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1), lambda a, b: a * 128 + b),
    )
    counted = (
        samples.where("text IS NOT NULL AND random IS NOT NULL").select("random", F.explode(pairs).alias("pair"))
        .groupBy("random", "pair").count().collect()  # two tables of the alphabet's square at most
    )
    letters = [ord(c) for c in ALPHABET]
    models = [_transitions({r["pair"]: r["count"] for r in counted if r["random"] is kind}, letters) for kind in (True, False)]
    ratios = [0.0] * (128 * 128)
    for pair, p in models[0].items():
        ratios[pair] = math.log(p / models[1][pair])
    return ratios


def _transitions(counts: dict[int, int], letters: list[int]) -> dict[int, float]:
    """Probability of the second character after the first; characters seldom seen first fall back to all that were seen."""
    second = {b: sum(counts.get(a * 128 + b, 0) for a in letters) for b in letters}
    total = sum(second.values())
    alone = {b: (second[b] + RARE) / (total + RARE * len(letters)) for b in letters}
    out = {}
    for a in letters:
        n = sum(counts.get(a * 128 + b, 0) for b in letters)
        for b in letters:
            out[a * 128 + b] = (counts.get(a * 128 + b, 0) + BACK_OFF * alone[b]) / (n + BACK_OFF)
    return out


def labelled_samples(docs: DataFrame, limit: int = TRAIN_DOCS) -> DataFrame:
    """(text, random): digests in hexadecimal and base 64 against the words of at most ``limit`` texts.

    The texts are chosen by a hash. What the fixed patterns find in them counts as random; every other word of
    at least four characters as ordinary.
    """
    chosen = chosen_texts(docs.where("text IS NOT NULL").select(F.col("text").cast("string").alias("text")), limit)
    values = F.concat(
        F.regexp_extract_all("text", F.lit(KINDS[0][1]), F.lit(2)),
        F.regexp_extract_all("text", F.lit(KINDS[1][1]), F.lit(0)),
        F.regexp_extract_all("text", F.lit(KINDS[2][1]), F.lit(0)),
    )
    digest = F.sha2(F.concat(F.lit("sample "), F.col("h").cast("string")), 256)
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(_run(CANDIDATE, 4)), F.lit(0)))
    # A step of its own, so that the patterns are not searched again for every word.
    parts = chosen.select(digest.alias("digest"), values.alias("found"), words.alias("words"))
    random = F.concat(F.filter("found", lambda v: F.length(v) >= MIN_LENGTH), F.array("digest", F.base64(F.unhex("digest"))))
    ordinary = F.filter("words", lambda w: ~F.exists("found", lambda v: F.contains(v, w) | F.contains(w, v)))
    both = F.concat(
        F.transform(random, lambda t: F.struct(t.alias("text"), F.lit(True).alias("random"))),
        F.transform(ordinary, lambda t: F.struct(t.alias("text"), F.lit(False).alias("random"))),
    )
    return parts.select(F.explode(both).alias("s")).select("s.*")


def _uncovered(start: Column, end: Column, base: Column) -> Column:
    """Array of (start, end) of the parts of a range that no span of ``base`` (sorted by start) covers."""
    gap = "array<struct<start:int,end:int>>"
    touching = F.filter(base, lambda b: (b["start"] < end) & (start < b["end"]))
    state = F.struct(start.alias("at"), F.array().cast(gap).alias("gaps"))

    def one(a: Column, b: Column) -> Column:
        return F.when(a < b, F.array(F.struct(a.alias("start"), b.alias("end")))).otherwise(F.array().cast(gap))

    def step(seen: Column, b: Column) -> Column:
        gaps = F.concat(seen["gaps"], one(seen["at"], b["start"]))
        return F.struct(F.greatest(seen["at"], b["end"]).alias("at"), gaps.alias("gaps"))

    return F.aggregate(touching, state, step, lambda seen: F.concat(seen["gaps"], one(seen["at"], end)))


def markov_spans(text: Column, ratios: list[float], base: Column, least: int = MIN_LENGTH, threshold: float = THRESHOLD) -> Column:
    """Spans of strings that look random: what is left of the candidates outside the spans of ``base``, where long enough.

    Every part is judged by its own characters. ``base`` is sorted by start.
    """
    table = F.split(F.lit(",".join(f"{r:.6g}" for r in ratios)), ",").cast("array<double>")

    def random(value: Column) -> Column:
        codes = _codes(value)
        pairs = F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1), lambda a, b: table[a * 128 + b])
        return F.aggregate(pairs, F.lit(0.0), lambda x, y: x + y) > threshold * F.size(pairs)

    candidates = _spans(text, MARKOV, _run(CANDIDATE, least), lambda value: F.lit(True))
    parts = F.flatten(F.transform(candidates, lambda s: _uncovered(s["start"], s["end"], base)))
    long_enough = F.filter(parts, lambda s: s["end"] - s["start"] >= least)
    found = F.filter(long_enough, lambda s: random(F.substring(text, s["start"] + 1, s["end"] - s["start"])))
    return F.transform(found, lambda s: F.struct(s["start"], s["end"], F.lit(MARKOV).alias("kind")))


def scan(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """Adds base and spans (arrays of start, end, kind in code points) to ``docs``; a null text is empty.

    Columns of these names in ``docs`` are replaced. Nothing is shuffled; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumn("base", base_spans(text))
    return rows.withColumn("spans", _ordered(F.concat("base", markov_spans(text, ratios, F.col("base")))))


def redact(text: Column, spans: Column, mark: str = "<secret>") -> Column:
    """The text with every span replaced; overlapping spans are replaced as one."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        before = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        out = F.when(fresh, F.concat(state["out"], before, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    tail = lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, tail))
