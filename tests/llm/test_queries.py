"""The registered queries against their SQL, or against plain versions where SQL has none."""

import zlib

import numpy as np
import pytest

from lotwise.llm.queries import QUERIES, SQL
from tests.compare import differences
from tests.llm import brute


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, folder, name):
    assert not differences(QUERIES[name](spark, folder), duck.execute(SQL[name]).df())


@pytest.fixture(scope="module")
def texts(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang").collect()
    return {r["doc_id"]: r for r in rows}


def test_secrets(spark, folder, texts):
    found = QUERIES["op2_secret_scans"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        base = brute.base_secrets(texts[r["doc_id"]]["text"])
        assert r["base_sha256"] == brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in base))
        assert [r[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(b[0] == k for b in base) for k in ("assign", "access", "hex")]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r["spans"].split(",")) | {""}


def test_languages_of_held_out_documents(spark, folder, texts):
    found = QUERIES["op3_language_id"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in texts if zlib.crc32(str(d).encode()) % 4 == 2}
    assert np.mean([r["lang_pred"] == texts[r["doc_id"]]["lang"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"  # the smaller tables have too few toxic documents to learn from
    texts = {r[0] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id").collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = QUERIES["op7_toxicity"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    seen = [(toxic[r["doc_id"]], r["score"]) for r in found if r["doc_id"] in toxic]
    high, low = [s for y, s in seen if y], [s for y, s in seen if not y]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in high for b in low]) > 0.8


def test_token_ids(spark, folder, texts):
    found = sorted(QUERIES["op8_token_ids"](spark, folder).collect())
    start = 0
    for r, d in zip(found, sorted(texts), strict=True):
        ids = brute.ids(texts[d]["text"], 1)
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d, start, len(ids), brute.crc(ids))
        start += len(ids)


def test_packing(spark, folder, texts):
    found = QUERIES["op9_packing"](spark, folder).collect()
    assert len({r["sequence_id"] for r in found}) == len(found) and {r["offset"] for r in found} == {0}
    pieces: dict[int, list] = {}
    for r in found:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(texts)
    for d, parts in pieces.items():
        ids, at = brute.ids(texts[d]["text"], 2), 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["length"] <= 4096 and r["length"] & (r["length"] - 1) == 0
            assert r["ids_crc32"] == brute.crc(ids[at : at + r["length"]])
            at += r["length"]
        assert at == len(ids)


def test_alignment(spark, folder, texts):
    found = sorted(tuple(r) for r in QUERIES["op12_token_alignment"](spark, folder).collect())
    expected = brute.alignments([(d, texts[d]["text"]) for d in sorted(texts)])
    assert found == [(*r[:5], *r[6:]) for r in expected]
    assert any(r[3] for r in found) and {len(r[5]) for r in found} <= {0, 64}


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"  # the smaller tables have too few labels to learn from
    texts = {r[0] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id").collect()}
    good = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = QUERIES["op13_quality"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    seen = [(good[r["doc_id"]], r["score"]) for r in found if r["doc_id"] in good and r["held_out"]]
    high, low = [s for y, s in seen if y], [s for y, s in seen if not y]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in high for b in low]) > 0.9
    assert np.mean([s >= 0.3 for s in high]) > 0.95
