"""Fill-in-middle, alignment and quality: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import alignment, chat, fill_middle, quality, secret_scan
from lotwise.llm.queries import BYTE_LEVEL, PIECES
from lotwise.sources.staging import stage
from tests.llm import brute

EXTRA = "n long, form string, output string, block long, groups string, score string, quality string, h long, pairs int, difference string"


def _docs(spark, rows):
    more = (7, "f", "o", 2, "g", "s", "q", 3, 4, "d")
    return spark.createDataFrame([(*r, *more) for r in rows], f"doc_id long, text string, {EXTRA}").repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    parts = [" ", "  ", "a", "The", "é", "\n", "\t", "\r\n", "　", "'s", "12", "!?", "日", "🙂", "▁", "\x00", "<", "P>", "<P", "S>", "▁x"]
    out = [(1, None), (2, ""), (3, " "), (4, "x"), (5, "a  b "), (6, "<|endoftext|> <s> <0x41>"), (7, "x<P>y"), (8, "<S"), (9, "a▁b")]
    out += [(20 + i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 60)))) for i in range(60)]
    shared = " ".join(f"word{rng.randint(0, 900)}" for _ in range(400))
    out += [(100 + i, f"start {i} " + shared + f" end {i}") for i in range(4)] + [(110, shared), (111, shared)]
    out += [(200, " ".join(rng.choice(["größe", "naïve", "plain", "日本語テキスト"]) for _ in range(30_000))), (201, "y" * 50_000), (202, " " * 3000 + "z")]
    return [*out, (None, "no name"), (None, None), (4, "x"), (4, "another text of that id"), (-3, "negative id")]


def test_chunks_count_and_cut_like_the_text(rows):
    chunks = fill_middle.Chunks(fill_middle.MARKS)
    for _, text in rows:
        raw = (text or "").encode()
        offsets, before, marked = fill_middle.text_chunks(chunks, raw, fill_middle.places(np.frombuffer(raw, np.uint8)).tolist())
        assert before[-1] == len(text or "") and marked == any(m in (text or "") for m in fill_middle.MARKS)
        for place in {0, 1, len(text or "") // 2, len(text or "")} & set(range(len(text or "") + 1)):
            assert fill_middle.byte_offset(raw, offsets, before, place) == len((text or "")[:place].encode())


def test_shared_passages_share_chunks():
    rng = random.Random(3)
    passage = " ".join(f"w{rng.randint(0, 99999)}" for _ in range(2000))
    held = []
    for head in ("one ", "another beginning, "):
        raw = (head + passage).encode()
        ends = [0, *fill_middle.chunk_ends(raw, fill_middle.places(np.frombuffer(raw, np.uint8)).tolist())]
        held.append({raw[a:b] for a, b in zip(ends, ends[1:])})
        assert ends[-1] == len(raw) and all(b - a <= fill_middle.MOST + 3 for a, b in zip(ends, ends[1:]))
    assert len(held[0] & held[1]) > 0.9 * len(held[0])


def test_forgotten_chunks_give_the_same(monkeypatch, rows):
    monkeypatch.setattr(fill_middle, "REMEMBERED", 500)
    test_chunks_count_and_cut_like_the_text(rows)


@pytest.mark.parametrize("mark", fill_middle.MARKS)
def test_marks_across_chunks_are_seen(mark):
    chunks = fill_middle.Chunks(fill_middle.MARKS)
    for at in range(60, 70):
        raw = b"q" * at + mark.encode() + b"r" * 70
        for cut in range(64, at + 4):
            assert fill_middle.text_chunks(chunks, raw, [cut, cut + 64])[2]
            assert not fill_middle.text_chunks(chunks, raw.replace(b">", b")"), [cut, cut + 64])[2]
        assert fill_middle.text_chunks(chunks, raw[: at + 3], [at + 1])[2]


def test_fill_in_middle(spark, rows):
    made = fill_middle.fill_in_middle(_docs(spark, rows))
    found = made.select("*", fill_middle.restore(F.col("output"), F.col("form")).alias("back")).collect()
    expected = [(doc, *brute.middle_filled(doc, text), text or "") for doc, text in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(_docs(spark, [])).count() == 0
    everything = fill_middle.fill_in_middle(_docs(spark, rows), percent=100, suffix_first=100).collect()
    assert {r["form"] for r in everything if r["output"]} == {"plain", "spm"}


def test_other_marks(spark, rows):
    marks = ("[[pre", "]]suffix", "<é>")
    made = fill_middle.fill_in_middle(_docs(spark, rows), marks=marks)
    back = made.select("n", fill_middle.restore(F.col("output"), F.col("form"), marks).alias("back")).collect()
    assert sorted(r["back"] for r in back) == sorted(t or "" for _, t in rows)


def test_alignment(spark, rows):
    found = [tuple(r) for r in alignment.align(_docs(spark, rows), BYTE_LEVEL, PIECES).collect()]
    assert sorted(found, key=repr) == sorted(brute.alignments(rows), key=repr)
    assert alignment.align(_docs(spark, []), BYTE_LEVEL, PIECES).count() == 0


def test_small_blocks_and_short_memory_give_the_same(monkeypatch, rows):
    monkeypatch.setattr(alignment, "WORDS", 50)
    aligner = alignment.Aligner(BYTE_LEVEL, PIECES)
    expected = brute.alignments(rows)
    for at in range(0, len(rows), 7):
        figures, shown, text, pairs, times = aligner.align([t or "" for _, t in rows[at : at + 7]])
        for k, e in enumerate(expected[at : at + 7]):
            assert (*figures[k].tolist(), shown[k]) == (*e[1:5], e[5])
            assert int(times[text == k].sum()) == e[4]


def test_large_groups_are_counted_by_distinct_ids(monkeypatch):
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 5, 40), rng.integers(0, 7, 30)
    group_a, group_b = np.sort(rng.integers(0, 3, 40)), np.sort(rng.integers(0, 3, 30))
    plain = alignment.sorted_sums(*_coded(alignment.links(a, group_a, b, group_b, 7)))
    monkeypatch.setattr(alignment, "SPELLED", 0)
    short = alignment.sorted_sums(*_coded(alignment.links(a, group_a, b, group_b, 7)))
    assert all(np.array_equal(x, y) for x, y in zip(plain, short))


def _coded(found):
    group, pair, times = found
    return group * 100 + pair, times


def test_coalesce_breaks_where_a_start_reaches_the_running_end():
    a, b = coalesced = alignment.coalesce(np.array([0, 2, 5, 9]), np.array([2, 5, 9, 10]), np.array([0, 5, 6]), np.array([5, 6, 10]))
    assert [x.tolist() for x in coalesced] == [[0, 0, 1, 1], [0, 1, 1]]


def test_quality_edges(spark):
    rng = random.Random(2)
    words = [f"{a}{b}" for a in "bcdfg" for b in ("ara", "olen", "iti", "umo")]
    rows = [(i, " ".join(rng.choice(words) + ("" if i % 3 else "###") for _ in range(60))) for i in range(240)]
    labels = [(i, int(i % 3 > 0)) for i in range(200)] + [(5, 1), (6, 0), (None, 1), (7, None), (8, 9), (999, 0)]
    more = [(300, None), (301, ""), (302, " "), (303, rows[1][1] * 300), (304, rows[0][1] * 300), (None, rows[1][1]), (5, rows[5][1])]
    docs = _docs(spark, rows + more)
    marked = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.fit(docs, marked)
    assert quality.fit(docs.repartition(7), marked) == model
    scored = quality.score(docs, model)
    assert scored.columns == ["doc_id", "text", "n", "form", "output", "block", "groups", "quality", "h", "pairs", "difference", "score"]
    found = {r["doc_id"]: r["score"] for r in scored.collect() if r["doc_id"] is not None}
    assert scored.count() == len(rows + more) and all(0 <= s <= 1 for s in found.values())
    good, bad = ([found[i] for i in range(200, 240) if (i % 3 > 0) == kind] for kind in (True, False))
    assert np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad]) > 0.85
    assert found[300] == found[301]
    assert quality.score(_docs(spark, []), model).count() == 0


def test_quality_without_labels(spark):
    docs = _docs(spark, [(1, "some text"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in quality.score(docs, quality.fit(docs, none)).collect()] == [0.5, 0.5]
    one_kind = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert all(0 <= r["score"] <= 1 for r in quality.score(docs, quality.fit(docs, one_kind)).collect())


def _seconds(make) -> float:
    make().write.format("noop").mode("overwrite").save()
    start = time.time()
    make().write.format("noop").mode("overwrite").save()
    return time.time() - start


def test_many_matches_and_turns_cost_in_proportion(spark):
    """Four times the length costs about four times, and places stay right across blocks of matches."""
    matches = {n: spark.createDataFrame([(1, "token=abcdef1 " * n)], "doc_id long, text string") for n in (8_000, 32_000)}
    spans = {n: (lambda d=d: d.select(secret_scan.base_spans(F.col("text")).alias("s"))) for n, d in matches.items()}
    found = spans[8_000]().first()["s"]
    assert [(s["start"], s["end"]) for s in found] == [(14 * k, 14 * k + 13) for k in range(8_000)]
    assert _seconds(spans[32_000]) < 7 * _seconds(spans[8_000]) + 2

    def turns(n):
        rows = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.lit("ok").alias("text"))
        nodes = chat.turns_as_trees(rows)
        return stage(chat.reply_paths(nodes)), stage(nodes)

    made = {n: turns(n) for n in (2_000, 8_000)}
    formatted = chat.format_paths(*made[2_000]).first()
    assert [formatted["formatted"][a:b] for a, b in formatted["mask"]] == ["ok"] * 2_000
    assert _seconds(lambda: chat.format_paths(*made[8_000])) < 7 * _seconds(lambda: chat.format_paths(*made[2_000])) + 2
