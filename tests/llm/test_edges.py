"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import math
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lotwise.llm import chat, decontam, langid, secret_scan, token_store, toxicity
from lotwise.llm.components import components
from lotwise.llm.jaccard import divide_skip, jaccard_components
from lotwise.llm.packing import binary_lengths, pack
from lotwise.llm.queries import TOKENIZER
from lotwise.llm.substring_dedup import remove_repeats
from lotwise.llm.tokens import WordEncoder
from lotwise.llm.topk import top_k
from lotwise.sources.staging import staging_path
from tests.llm import brute

WORDS = [f"w{i}" for i in range(400)] + ["Ünïcode", "日本語", "A,b", "x\x00y"]
EXTRA = "node long, n long, key string, items string, spans int, base string, score string, words int, root int, start int"
SCHEMA = f"doc_id long, text string, {EXTRA}"


def _docs(spark, rows):
    """Documents with more columns, named like those that operators make."""
    more = (7, 7, "k", "i", 1, "b", "s", 3, 4, 5)
    return spark.createDataFrame([(*r, *more) for r in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = [rng.choice(WORDS) for _ in range(120)]
    out = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two three four"), (7, "a b c d e f")]
    out += [(10 + i, " ".join(base[:i] + ["x", f"new{i}"] + base[i + 1 :])) for i in range(0, 120, 7)]
    out += [(200, " ".join(base)), (201, "  ".join(base)), (202, " ".join(base).upper()), (300, " ".join(rng.choice(WORDS) for _ in range(30_000)))]
    shared = " ".join(rng.choice(WORDS) for _ in range(60))
    out += [(400 + i, " ".join(rng.choice(WORDS) for _ in range(50)) + " " + shared) for i in range(6)]
    out += [(500, "la " * 300), (501, " ".join(base[:70])), (502, " ".join(base[:70]))]
    return out


def test_jaccard(spark, rows):
    found = sorted(tuple(r) for r in jaccard_components(_docs(spark, rows)).collect())
    assert found == brute.jaccard(rows)


def test_jaccard_of_repeated_rows_nulls_and_nothing(spark, rows):
    twice = rows[:12] + rows[:12] + [(None, rows[11][1]), (None, None), (None, "nobody else says this")]
    found = [tuple(r) for r in jaccard_components(_docs(spark, twice)).collect()]
    assert len(found) == len(twice)
    assert sorted(r for r in found if r[0] is not None) == sorted(2 * brute.jaccard(rows[:12]))
    assert sorted((str(r[2]) for r in found if r[0] is None)) == sorted([str(dict((a, c) for a, _, c in brute.jaccard(rows[:12]))[rows[11][0]]), "None", "None"])
    empty = jaccard_components(_docs(spark, []))
    assert empty.columns == ["doc_id", "n_shingles", "component_id"] and empty.count() == 0


def test_divide_skip_on_blocks():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 60, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, rng.integers(20, 50))) for _ in range(60)]

    def roots(pairs):
        group = list(range(60))
        for a, b in pairs:
            old, new = group[a], group[b]
            group = [new if g == old else g for g in group]
        return {frozenset(i for i in range(60) if group[i] == g) for g in group}

    def linked(a, b):
        common = len(np.intersect1d(a, b))
        return 100 * common >= 45 * (len(a) + len(b) - common)

    pairs = [(a, b) for b in range(60) for a in range(b) if linked(sets[a], sets[b])]
    assert pairs and roots(divide_skip(sets, 45)) == roots(pairs)
    across = [(a, b) for a, b in pairs if a < 25 <= b]
    assert roots(divide_skip(sets, 45, 25)) == roots(across)


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 5), (5, 5), (4, None), (11, 11), *[(100 + i, 101 + i) for i in range(40)]]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 5: 5, 7: 5, 8: 5, 9: 5, 11: 11, **{100 + i: 100 for i in range(41)}}


def test_repeats(spark, rows):
    more = rows + [(None, rows[-1][1]), (4, "one"), (200, rows[25][1])]
    found = [tuple(r) for r in remove_repeats(_docs(spark, more)).collect()]
    assert sorted(found, key=repr) == sorted(brute_repeats(more), key=repr)
    assert remove_repeats(_docs(spark, [])).count() == 0


def brute_repeats(rows):
    numbered = brute.without_repeats([(i, t) for i, (_, t) in enumerate(rows)])
    return [(rows[i][0], *rest) for i, *rest in numbered]


def test_contamination(spark, rows):
    base = next(t for d, t in rows if d == 200).split()
    items = [("b", " ".join(base[20:45])), ("a", "Three, four"), ("c", None), ("d", "...") , (None, "e f"), ("e", " ".join(base[20:45]))]
    bench = spark.createDataFrame(items, "item_id string, text string")
    more = [*rows, (600, "one two three four; THREE?four a"), (601, "Ünïcode: " + "! ".join(base[22:40]))]
    found = decontam.contamination(_docs(spark, more), bench).collect()
    assert len(found) == len(more)
    texts = dict(more)
    for r in found:
        n, hit, names = brute.hits(texts[r["doc_id"]], [(i or "", t) for i, t in items])
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, len(hit), sorted(names))
        text = texts[r["doc_id"]] or ""
        words = [m.span() for m in brute.WORD.finditer(text.translate(brute.UPPER))]
        covered = {i for i, (a, b) in enumerate(words) for s in r["spans"] if s["start"] <= a and b <= s["end"]}
        assert covered == hit
    assert decontam.contamination(_docs(spark, []), bench).count() == 0
    clean = decontam.contamination(_docs(spark, rows[:3]), bench.limit(0)).collect()
    assert [r["n_hit"] for r in clean] == [0, 0, 0]


def test_small_automatons_find_the_same(monkeypatch):
    items = [(str(i), f"q{i} r{i} s{i}") for i in range(20)]
    text = b"x q3 r3 s3 y q19 r19 s19"
    one = decontam.automatons([(n, t.encode()) for n, t in items], 2)
    monkeypatch.setattr(decontam, "AUTOMATON_BYTES", 30)
    many = decontam.automatons([(n, t.encode()) for n, t in items], 2)
    assert len(one) == 1 < len(many) and decontam.scan(text, one) == decontam.scan(text, many) == (8, [(1, 4), (5, 8)], {"3", "19"})


SECRETS = [
    (1, None), (2, ""), (3, "é Token = 'abcdef' PASSWORD:abc secret=passwd=abcdefgh"), (4, "passwd:token:abcdefgh api_key  : \"Zz09+/_.=-x"),
    (5, "AKIA" + "A" * 15 + " AKIA" + "Z" * 16 + " AKIAAKIA" + "9" * 20), (6, "😀 " + "0123456789abcdef" * 2 + "g" + "a" * 23),
    (7, "plain " * 5000 + "token=abcdef0123456789abcdef0123 " + "x" * 3000), (8, "apikey=\"0123456789abcdef01234567\" token==abcdef"),
]


def _ratios(spark):
    rng = random.Random(1)
    letters = secret_scan.ALPHABET
    random_ones = [("".join(rng.choice(letters) for _ in range(40)), True) for _ in range(300)]
    plain = [("".join(rng.choice(["ter", "ing", "sch", "ver", "tion"]) for _ in range(8)), False) for _ in range(300)]
    return secret_scan.train(spark.createDataFrame([*random_ones, *plain, (None, True), ("é", None), ("", False)], "text string, random boolean"))


def test_secret_spans(spark):
    ratios = _ratios(spark)
    token = "q8ZrT2xLwv0KdPb7NcYhJm3E"
    more = [*SECRETS, (9, f"see {token} and vertionschingterverschtioning"), (10, f"token={token}")]
    found = {r["doc_id"]: r for r in secret_scan.scan(_docs(spark, more), ratios).collect()}
    for d, text in more:
        base = brute.base_secrets(text)
        assert [(s["kind"], s["start"], s["end"]) for s in found[d]["base"]] == base
        assert set(base) <= {(s["kind"], s["start"], s["end"]) for s in found[d]["spans"]}
    assert [(s["kind"], s["start"], s["end"]) for s in found[9]["spans"]] == [("markov", 4, 4 + len(token))]
    assert [s["kind"] for s in found[10]["spans"]] == ["assign"]
    assert secret_scan.scan(_docs(spark, []), ratios).count() == 0
    assert secret_scan.train(spark.createDataFrame([], "text string, random boolean"))[ord("a") * 129] == 0.0


def test_rest_of_a_string_beside_a_fixed_pattern_is_judged(spark):
    key, plain = "pLIix6MEOLeMa61EqJomTEI1JEzO3joO", "vertionschingterverschtioning"
    hexes, access = "507f1f77bcf86cd799439011", "AKIA" + "Q7" * 8
    rows = [(1, f"at {hexes}/{key}"), (2, f"{access}{key.lower()}"), (3, f"{key}_token=abcdef"), (4, f"{hexes}/{plain}"), (5, f"{key}{hexes}{key}"), (6, f"{hexes}/{key[:12]}")]
    found = secret_scan.scan(_docs(spark, rows), _ratios(spark))
    spans = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in found.collect()}
    assert spans[1] == [("hex", 3, 27), ("markov", 27, 60)]
    assert spans[2] == [("access", 0, 20), ("markov", 20, 52)]
    assert spans[3] == [("markov", 0, 33), ("assign", 33, 45)]
    assert spans[4] == [("hex", 0, 24)] and spans[6] == [("hex", 0, 24)]
    assert spans[5] == [("markov", 0, 32), ("hex", 32, 56), ("markov", 56, 88)]
    clean = {r["doc_id"]: r["t"] for r in found.select("doc_id", secret_scan.redact(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert clean[1] == "at <secret><secret>" and key not in clean[3] and key not in clean[5]


def test_redaction(spark):
    found = secret_scan.scan(_docs(spark, SECRETS), [0.0] * 128 * 128)
    clean = {r["doc_id"]: r["t"] for r in found.select("doc_id", secret_scan.redact(F.col("text"), F.col("spans")).alias("t")).collect()}
    for d, text in SECRETS:
        expected, at = "", 0
        for _, a, b in brute.base_secrets(text):
            if a >= at:
                expected += text[at:a] + "<secret>"
            at = max(at, b)
        assert clean[d] == (None if text is None else expected + text[at:])


def test_language_edges(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("der die das und ein " * 20, "de"), ("the and of to is in " * 20, "en")] * 30)]
    net = langid.fit(spark.createDataFrame([*rows, (1, None, "de"), (2, "x", None), (3, "", "en")], "doc_id long, text string, lang string"))
    tests = [(1, None), (2, ""), (3, "123 ..."), (4, "d"), (5, "und das ein die " * 4000), (6, "THE AND of to"), (6, "the and of to"), (None, "日本")]
    found = langid.predict(_docs(spark, tests), net).collect()
    named = {r["doc_id"]: r["lang_pred"] for r in found}
    assert len(found) == 8 and [named[i] for i in (1, 2, 3)] == ["und"] * 3 and named[5] == "de"
    assert all(r["score"] == 0 for r in found if r["lang_pred"] == "und") and named[None] in ("de", "en")
    assert langid.predict(_docs(spark, []), net).count() == 0
    assert langid.fit(spark.createDataFrame([], "text string, lang string")) is None
    assert {r["lang_pred"] for r in langid.predict(_docs(spark, tests), None).collect()} == {"und"}


def test_windows_cover_the_text():
    text = bytes(range(256)) * 3
    grid = langid.cut(text, 100)
    assert grid.shape == (8, 100) and b"".join(r.tobytes() for r in grid[:7]) + grid[7].tobytes()[-68:] == text
    assert langid.cut(b"ab", 5).tobytes() == b"ababa" and langid.cut(b"", 5).shape == (0, 5)


def test_gradients_follow_the_loss():
    rng = np.random.default_rng(0)
    net = langid.ByteConvNet(["a", "b"])
    net.filters = [f.astype(float) for f in net.filters]
    net.out = net.out.astype(float)
    rows, targets = rng.integers(0, 256, (6, 20)).astype(np.uint8), np.array([0, 1, 0, 1, 1, 0])

    def loss():
        net.__dict__.pop("_pairs", None)
        return -net.log_probabilities(rows.T)[np.arange(6), targets].mean()

    grads = net._gradients(rows, targets)
    k, byte, unit = 1, int(rows[2, 5]), 3
    place = max(((k, int(b), u) for k in range(2) for b in np.unique(rows) for u in range(3)), key=lambda p: abs(grads[0][p]))
    for table, grad, at in ((net.filters[0], grads[0], place), (net.out, grads[4], (4, 1))):
        table[at] += 1e-3
        up = loss()
        table[at] -= 2e-3
        assert (up - loss()) / 2e-3 == pytest.approx(grad[at], rel=0.05, abs=1e-4)
        table[at] += 1e-3


def test_toxicity_folding_and_exceptions(spark):
    assert toxicity.fold("ТRASH tr4sh tr@$h 1d10t x5 $$$") == ["trash", "trash", "trash", "idiot", "xs"]
    lexicon = toxicity.Lexicon({"trash ": 4.0, "idio": 3.0}, ("trash can",), (-3.0, 2.0, 1.0))
    rows = [(1, None), (2, ""), (3, "a trash can"), (4, "TR4SH"), (5, "idiotic trashy"), (6, "word " * 20000 + "trash"), (6, "x")]
    found = {r["doc_id"]: r for r in toxicity.score(_docs(spark, rows), lexicon).collect()}
    assert [found[i]["total"] for i in (1, 2, 3, 4, 5)] == [0, 0, 0, 4, 3]
    assert found[1]["score"] == found[2]["score"] == pytest.approx(1 / (1 + math.exp(3)))
    assert found[4]["score"] > 0.5 and toxicity.score(_docs(spark, []), lexicon).count() == 0
    nothing = toxicity.fit(_docs(spark, rows), spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int"))
    assert nothing.weights == {} and toxicity.score(_docs(spark, rows), nothing).count() == 7


def test_toxicity_learns_its_words(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(WORDS[:50]) + "abc" for _ in range(30)) + (" blarg" if i % 5 == 0 else "")) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(150)], "doc_id long, toxic int")
    lexicon = toxicity.fit(_docs(spark, rows), labels)
    found = {r["doc_id"]: r["score"] for r in toxicity.score(_docs(spark, rows), lexicon).collect()}
    assert all((found[i] >= 0.5) == (i % 5 == 0) for i in range(150, 200))


TEXTS = [
    (3, None), (1, ""), (None, "null id"), (2, "Hello, WORLD's end. <|endoftext|> <|ENDOFTEXT|>"), (2, "again"), (2, "again"),
    (-5, "İstanbul é́ 日本 \x00 ①"), (9, "word " * 9000), (8, "the the the " * 50),
]


def test_token_files(spark):
    path = staging_path(spark)
    token_store.write_tokens(_docs(spark, TEXTS), path, TOKENIZER)
    found = token_store.read_tokens(spark.read.parquet(path)).orderBy("start").collect()
    expected = [(d, brute.ids(t, 1)) for d, t in TEXTS]
    assert [r["doc_id"] for r in found] == [None, -5, 1, 2, 2, 2, 3, 8, 9]
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, np.frombuffer(r["ids"], "<u4").tolist()) for r in found))
    assert got == sorted((d is not None, d or 0, i) for d, i in expected)
    starts = np.cumsum([0] + [r["n_tokens"] for r in found])[:-1]
    assert [r["start"] for r in found] == starts.tolist() and all(r["ids_crc32"] == brute.crc(np.frombuffer(r["ids"], "<u4").tolist()) for r in found)
    none = staging_path(spark)
    token_store.write_tokens(_docs(spark, []), none, TOKENIZER)
    files = spark.read.schema("shard int, before long, tokens long, content binary").parquet(none)
    assert token_store.read_tokens(files).count() == 0


@pytest.mark.parametrize("size", [0, 1, 2047, 2048, 2049, 10_000])
def test_coder_round_trip(size):
    rng = np.random.default_rng(size)
    ids = np.where(rng.random(size) < 0.5, rng.integers(0, 65536, size), rng.integers(0, 4, size)).astype(np.uint32)
    ids[: size // 3] = 65535
    docs, counts, back = token_store.decode_chunk(token_store.encode_chunk([4, None], [size, 0], ids))
    assert docs == [4, None] and counts.tolist() == [size, 0] and (back == ids).all()


def test_blocks_of_many_sizes():
    rng = np.random.default_rng(9)
    sizes = np.sort(rng.integers(0, 90, 400))[::-1].copy()
    blocks = np.where(rng.random((400, 90)) < 0.3, 65535, rng.integers(0, 65536, (400, 90)))
    back = token_store.decode_blocks(token_store.encode_blocks(blocks, sizes), sizes)
    assert all((back[i, :n] == blocks[i, :n]).all() for i, n in enumerate(sizes.tolist()))


def test_coder_compresses_and_notices_damage():
    ids = np.tile(np.arange(300, dtype=np.uint32), 40)
    data = bytearray(token_store.encode_chunk([1], [len(ids)], ids))
    assert len(data) < len(ids)
    data[-5] ^= 1
    with pytest.raises(ValueError):
        token_store.decode_chunk(bytes(data))
    with pytest.raises(ValueError):
        token_store.decode_chunk(b"none" + bytes(20))
    with pytest.raises(ValueError):
        token_store.encode_chunk([1], [1], np.array([65536], np.uint32))


def test_coder_settles_carries_and_checks_what_fills_the_last_block():
    rng = np.random.default_rng(3)
    for _ in range(20):  # sure blocks and plain ids in turn, whose sums overflow now and then
        ids = np.where(rng.random(6000) < 0.7, 65535, rng.integers(0, 65536, 6000)).astype(np.uint32)
        assert (token_store.decode_chunk(token_store.encode_chunk([1], [6000], ids))[2] == ids).all()
    # The last word tells of the zeros behind the end only.
    data = bytearray(token_store.encode_chunk([1], [6000], ids))
    data[-8] ^= 255
    data[-5] ^= 255
    with pytest.raises(ValueError):
        token_store.decode_chunk(bytes(data))


def test_a_step_of_the_coder_is_few_array_operations():
    """Time of both directions in plain operations on one number for each block, the best of three."""
    lanes, steps = 1024, 512
    blocks = np.minimum(np.random.default_rng(1).zipf(1.3, (lanes, steps)), 50_000)
    sizes = np.full(lanes, steps)
    a, b, hit = np.arange(lanes), np.arange(lanes)[::-1].copy(), np.arange(lanes) % 3 == 0
    taken, unit = [], []
    for _ in range(3):
        start = time.process_time()
        for _ in range(20_000):
            np.where(hit, a, b)
        unit.append((time.process_time() - start) / 20_000)
        start = time.process_time()
        assert (token_store.decode_blocks(token_store.encode_blocks(blocks, sizes), sizes) == blocks).all()
        taken.append((time.process_time() - start) / steps)
    assert min(taken) / min(unit) < 280  # 350 before tables of shares and of bounds were made once for many steps


def test_chunks_leave_in_batches_of_whole_documents(monkeypatch):
    monkeypatch.setattr(token_store, "BATCH_TOKENS", 10)
    counts = [3, 1, 25, 1, 9, 2, 40, 1]
    ids = np.arange(sum(counts), dtype=np.uint32)
    content = token_store.encode_chunk([None, *range(7)], counts, ids)
    batches = list(token_store._read(iter([pa.RecordBatch.from_pydict({"start": [100], "content": [content]})])))
    assert len(batches) > 3 and max(b.num_rows for b in batches) < 8
    rows = [r for b in batches for r in b.to_pylist()]
    assert [r["doc_id"] for r in rows] == [None, *range(7)] and [r["n_tokens"] for r in rows] == counts
    assert [r["start"] for r in rows] == (100 + np.cumsum([0, *counts[:-1]])).tolist()
    assert b"".join(r["ids"] for r in rows) == ids.astype("<u4").tobytes()


def test_words_are_encoded_like_texts():
    coder, rng = WordEncoder(TOKENIZER), random.Random(4)
    texts = ["".join(rng.choice("aB.,'$1 \n\t\r<|>é́ß İσς-") for _ in range(60)) for _ in range(500)]
    assert [x.tolist() for x in coder.encode(texts)] == [brute.ids(t, 0)[:-1] for t in texts]


def test_packing_pieces(spark):
    assert binary_lengths(4096 * 2 + 5, 4096) == [4096, 4096, 4, 1] and binary_lengths(4096, 4096) == [4096]
    found = pack(_docs(spark, TEXTS), TOKENIZER, most=64).collect()
    by_doc: dict = {}
    for r in found:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert len({r["sequence_id"] for r in found}) == len(found) and set(by_doc) == {d for d, _ in TEXTS}
    for d in (None, -5, 1, 3, 8, 9):
        parts = sorted(by_doc[d], key=lambda r: r["start"])
        joined = b"".join(r["ids"] for r in parts)
        assert np.frombuffer(joined, "<u4").tolist() == brute.ids(dict(TEXTS)[d], 2)
    assert pack(_docs(spark, []), TOKENIZER).count() == 0
    with pytest.raises(ValueError):
        pack(_docs(spark, []), TOKENIZER, most=100)


def _vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, score int, rank int").repartition(3)


def test_top_k(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 4).astype(np.float32)]) for i in range(120)]
    rows += [(i, rows[7][1]) for i in range(200, 240)]  # ties
    rows += [(300, None), (320, [1.0, None, 0.0, 0.0]), (340, [float("nan"), 0.0, 0.0, 0.0]), (360, [float("inf"), 0.0, 0.0, 0.0]), (None, [9.0] * 4), (380, []), (400, [1.0, 2.0]), (401, [3.0, 4.0]), (5, rows[5][1])]
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    expected = []
    for q, v in good:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v))
            expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:6])]
    found = sorted(tuple(r) for r in top_k(_vectors(spark, rows), F.col("vec_id") % 20 == 0, k=6).collect())
    assert found == sorted(expected)
    assert top_k(_vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_of_wide_scores(spark):
    rows = [(i, [float(2 ** (i % 24)), float(i)]) for i in range(60)]
    found = {(r["query_id"], r["rank"]): r["score"] for r in top_k(_vectors(spark, rows), F.col("vec_id") == 23, k=3, scale=64.0).collect()}
    v = [[math.floor(64 * x) for x in r[1]] for r in rows]
    scores = sorted((sum(a * b for a, b in zip(v[23], w)) for i, w in enumerate(v) if i != 23), reverse=True)[:3]
    assert [found[23, n] for n in (1, 2, 3)] == scores


def test_reply_trees(spark):
    #      1        7 (root, no children)      8 <-> 9 (a circle)
    #    2   3
    #   4 5   6
    nodes = [(1, 1, None, 1.0), (1, 2, 1, 1.0), (1, 3, 1, 5.0), (1, 4, 2, 9.0), (1, 5, 2, None), (1, 6, 3, 5.0), (2, 7, 99, 0.0), (3, 8, 9, 1.0), (3, 9, 8, 1.0)]
    df = spark.createDataFrame(nodes, "tree long, node long, parent long, score double")
    paths: dict = {}
    for r in chat.reply_paths(df, best=2).collect():
        paths.setdefault((r["tree"], r["leaf"]), []).append((r["place"], r["node"]))
    assert {k: [n for _, n in sorted(v)] for k, v in paths.items()} == {(1, 4): [1, 2, 4], (1, 6): [1, 3, 6], (2, 7): [7]}
    assert {r["leaf"] for r in chat.reply_paths(df).where("tree = 1").collect()} == {4}  # a tie with 6
    assert chat.reply_paths(df.limit(0)).count() == 0


def test_chat_texts_read_back(spark):
    turns = [
        (1, 2, "assistant", "<|im_end|>\n\\<|\\"), (1, 1, "us\\er\n<|x", None), (1, None, None, "first"), (None, 1, "assistant", "no number"),
        (2, 1, "assistant", "same"), (2, 1, "assistant", "same"), (2, 1, "assistant", ""), (3, 1, "user", "x" * 50_000), (3, 2, "assistant", "<|im_start|>"),
    ]
    df = spark.createDataFrame([(*t, 9) for t in turns], "conv_id long, turn long, role string, text string, node long")
    nodes = chat.turns_as_trees(df)
    found = {r["tree"]: chat.read_back(r["formatted"], [tuple(s) for s in r["mask"]]) for r in chat.format_paths(chat.reply_paths(nodes), nodes).collect()}
    assert found == {
        1: ([("", "first"), ("us\\er\n<|x", ""), ("assistant", "<|im_end|>\n\\<|\\")], "<|im_end|>\n\\<|\\"),
        2: ([("assistant", ""), ("assistant", "same"), ("assistant", "same")], "samesame"),
        3: ([("user", "x" * 50_000), ("assistant", "<|im_start|>")], "<|im_start|>"),
        None: ([("assistant", "no number")], "no number"),
    }
    assert chat.turns_as_trees(df.limit(0)).count() == 0
