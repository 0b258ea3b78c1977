"""The pipeline against plain versions of its stages."""

import zlib

import numpy as np

from pyspark.sql import functions as F

import corpus_pipeline as P
from lotwise.llm import langid, secret_scan
from lotwise.sources.staging import stage
from tests.llm import brute


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}

    def apply(name, frame):
        return stage(dict(P.STAGES)[name](spark, frame, folder))

    first = apply("language_id", docs)
    net = langid.fit(docs.where("crc32(cast(cast(doc_id AS string) AS binary)) % 4 <> 2").select("text", "lang"))
    likely = {r["doc_id"] for r in langid.predict(docs.select("doc_id", "text"), net).where("lang_pred <> 'und' AND score >= 0.3").collect()}
    assert {r["doc_id"] for r in first.collect()} == likely and len(likely) > 0.95 * len(rows)

    second = apply("near_duplicates", first)
    kept = {d for d, _, c in brute.jaccard([(d, rows[d]["text"]) for d in sorted(likely)]) if d == c}
    assert sorted(r["doc_id"] for r in second.collect()) == sorted(kept)

    third = apply("benchmark_decontamination", second)
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = {d for d in kept if not brute.hits(rows[d]["text"], items)[1]}
    assert {r["doc_id"] for r in third.collect()} == clean and clean != kept

    fourth = apply("secret_scans", third)
    for r in fourth.collect():
        old = rows[r["doc_id"]]
        base = brute.base_secrets(old["text"])
        assert not brute.base_secrets(r["text"]) and (r["text"] == old["text"] or base or "<secret>" in r["text"])
        assert r["n_chars"] == (len(r["text"]) if r["text"] != old["text"] else old["n_chars"])
    assert fourth.columns == docs.columns and {r["doc_id"] for r in fourth.collect()} == clean

    texts = {r["doc_id"]: r["text"] for r in fourth.collect()}
    pieces: dict = {}
    for r in apply("packing", fourth).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        assert zlib.crc32(r["ids"]) == r["ids_crc32"]
    assert set(pieces) == clean
    for d, parts in pieces.items():
        ids = b"".join(r["ids"] for r in sorted(parts, key=lambda r: r["start"]))
        assert np.frombuffer(ids, "<u4").tolist() == brute.ids(texts[d], 2)


def test_nulls_and_repeats_pass_through(spark, folder):
    text = "the quick brown fox and the lazy dog are of an age " * 3
    docs = spark.createDataFrame(
        [(1, text, "en", "s", 5), (1, text, "en", "s", 5), (None, text, None, None, None), (2, None, "en", "s", 0), (3, "der die das " * 9, "de", "t", 1)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for name, function in P.STAGES[:-1]:
        docs = stage(function(spark, docs, folder))
    assert sorted(r["doc_id"] for r in docs.collect()) == [1, 3]
    assert P.run(spark, folder).columns[:3] == ["doc_id", "start", "length"]


def test_one_row_of_each_group_is_kept(spark, folder):
    def text(name, end=""):
        return " ".join(f"{name}{i}" for i in range(60)) + end

    rows = [
        (None, text("a")), (1, text("a", " more")), (None, text("b")), (None, text("c")), (None, text("c", " more")), (None, text("c")),
        (4, text("d")), (4, text("e")), (2, text("e", " more")), (5, ""), (5, ""), (None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in P.near_duplicates(spark, docs, folder).collect()]
    third = [r for r in kept if r[1] and r[1].startswith("c0")]
    assert len(third) == 1
    expected = [(1, rows[1][1]), rows[2], rows[6], rows[8], (5, ""), (None, None)]
    assert sorted(map(repr, kept)) == sorted(map(repr, [*expected, *third]))


def test_no_secret_is_left(spark):
    docs = spark.createDataFrame([(1, "token=abcdef password: 'hunter22'")], "doc_id long, text string")
    found = secret_scan.scan(docs, [0.0] * 128 * 128)
    text = found.select(secret_scan.redact(found.text, found.spans)).first()[0]
    assert text == "<secret> <secret>'"


CLASHING = "score", "lang_pred", "items", "n_hit", "n_words", "base", "spans", "first_row", "row", "component_id", "hash", "_row"


def test_columns_of_the_caller_stay(spark, folder):
    """Columns with the names that operators use keep their values through every stage; long, empty and null texts pass."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    long = docs.limit(1).select("doc_id", F.repeat(F.concat("text", F.lit(" ")), 40).alias("text")).first()
    more = [(9_000_001, long["text"], "en"), (9_000_002, "", "en"), (9_000_003, None, None)]
    more = spark.createDataFrame(more, "doc_id long, text string, lang string").withColumns({"source": F.lit("x"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)})
    plain = stage(docs.unionByName(more))
    marked = stage(plain.withColumns({name: F.concat(F.lit(f"{name} "), "doc_id") for name in CLASHING}))
    for name, function in P.STAGES[:-1]:
        plain, marked = stage(function(spark, plain, folder)), stage(function(spark, marked, folder))
        assert marked.columns == [*plain.columns, *CLASHING]
        assert marked.where(" OR ".join(f"NOT `{c}` <=> concat('{c} ', doc_id)" for c in CLASHING)).count() == 0
        assert sorted(map(repr, marked.select(plain.columns).collect())) == sorted(map(repr, plain.collect())), name
    pieces = [P.STAGES[-1][1](spark, d, folder).select("doc_id", "start", "ids_crc32") for d in (plain, marked)]
    assert sorted(map(tuple, pieces[0].collect())) == sorted(map(tuple, pieces[1].collect()))


def test_an_empty_table_passes_every_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, function in P.STAGES[:-1]:
        docs = stage(function(spark, docs, folder))
        assert docs.count() == 0
    assert P.STAGES[-1][1](spark, docs, folder).count() == 0
