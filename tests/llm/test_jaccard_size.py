"""Groups of sets that met by chance are taken apart before any text is moved, and whole rows are shuffled once."""

import random

import numpy as np
import pytest

import corpus_pipeline as P
from lotwise.llm import jaccard as J
from tests.llm import brute


def _chained(n: int) -> list[tuple[int, str]]:
    """Texts that share five words with the next one, which is far from a link, and a near copy of every tenth."""
    rng = random.Random(3)
    texts = [[f"t{i}_{rng.random()}" for _ in range(40)] for i in range(n)]
    for a, b in zip(texts, texts[1:]):
        b[:5] = a[-5:]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    return rows + [(1000 + i, " ".join([*t[:-1], "other"])) for i, t in enumerate(texts) if i % 10 == 0]


def test_chance_groups_move_no_text(spark, monkeypatch):
    rows, seen, blocks = _chained(60), [], J._blocks
    # All n-grams of a sketch of 64 cells look alike, as those of a large table do in the largest one.
    monkeypatch.setattr(J, "MAX_BITS", 8)
    monkeypatch.setattr(J, "_blocks", lambda clusters: seen.append({r["node"] for r in clusters.collect()}) or blocks(clusters))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in J.jaccard_components(docs).collect()) == brute.jaccard(rows)
    assert len(seen[0]) == 12


@pytest.mark.parametrize("threshold", [60, 75, 100])
def test_large_groups_are_dealt_by_size(spark, monkeypatch, threshold):
    monkeypatch.setattr(J, "MAX_BITS", 8)
    monkeypatch.setattr(J, "BITS_BLOCK", 4)
    rng = random.Random(threshold)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[: rng.randrange(8, 60)] + [f"n{rng.randrange(5)}"])) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in J.jaccard_components(docs, threshold=threshold).collect()) == brute.jaccard(rows, threshold)


def test_bits_lose_no_link():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(20):
        base = rng.integers(1, 2**62, rng.integers(1, 3000), dtype=np.uint64)
        sets += [np.unique(np.r_[base[: rng.integers(1, len(base) + 1)], rng.integers(1, 2**62, 9, dtype=np.uint64)]) for _ in range(5)]
    sizes = np.array([len(s) for s in sets])
    pairs = J.close_pairs([J.odd_cells(s) for s in sets], sizes, 75)
    group = list(range(len(sets)))
    for a, b in pairs:
        group = [group[a] if g == group[b] else g for g in group]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b)):
                assert group[i] == group[j]


def test_whole_rows_are_shuffled_once(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "g h i j k l"), (3, "a b c d e f"), (None, None)], "doc_id long, text string")
    kept = P.near_duplicates(spark, docs, "")
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == ["1", "2", "None"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert sum("hashpartitioning(doc_id" in line for line in plan.splitlines()) == 0
