"""The registered queries on the smallest tables: SQL where there is some, else brute force."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm.queries import ORACLES, QUERIES
from tools.compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), duck(SF), ORACLES[name]) == ""


def test_packing(spark, texts):
    got = QUERIES["op1_best_fit_packing"](spark, SF).toPandas()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, g in got.sort_values("piece").groupby("doc_id"):
        ids = np.array(tok.encode(texts[i], add_special_tokens=False).ids + [0], dtype="<u4")
        assert [zlib.crc32(ids[s:s + n].tobytes()) for s, n in zip(g.start, g.length)] == list(g.ids_crc32) and g.length.sum() == len(ids)
    assert set(got.doc_id) == set(texts) and got.sequence_id.nunique() <= got.length.sum() / 2048 + 2


def test_mix(spark, texts):
    got = QUERIES["op2_source_mix"](spark, SF).toPandas()
    assert len(got) == len(texts) and (got["taken"] <= 2 * got["size"]).all()
    by = got.groupby("source_size").agg(t=("target", "first"), k=("taken", "sum"), n=("target", "nunique"))
    assert ((by.t - by.k).abs()[by.n == 1] <= 64).all()


def test_shards(spark, texts):
    got = QUERIES["op3_shards"](spark, SF).toPandas()
    assert {(r.doc_id, r.size, r.text_crc32) for r in got.itertuples()} == {(i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts.items()}
    n = got.groupby("shard").slot.agg(["count", "min", "max", "nunique"])
    assert len(n) == 16 and n["count"].max() - n["count"].min() <= 1 and (n["min"] == 0).all() and (n["nunique"] == n["max"] + 1).all()


def test_scores(spark, texts):
    got = QUERIES["op4_nnpu_toxicity"](spark, SF).toPandas()
    assert set(got.doc_id) == set(texts) and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(got.doc_id, got.held_out))


def test_fingerprints(spark, texts):
    got = QUERIES["op5_multiset_hash"](spark, SF).toPandas()
    assert len(got) == len(texts) and got.near_edited.mean() > 0.6 > 0.2 > got.near_next.mean()
    assert got.groupby(got.doc_id.map(texts)).fingerprint.nunique().max() == 1


def test_token_counts(spark, texts):
    got = QUERIES["op6_token_counts"](spark, SF).toPandas()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got.itertuples()} == {
        (i, len(t.encode()), n := len(tok.encode(t, add_special_tokens=False).ids), n > 2048) for i, t in texts.items()}


def test_verdicts(spark, texts):
    got = QUERIES["op8_decision_list"](spark, SF).toPandas()
    assert set(got.doc_id) == set(texts) and not (got.base_failed & got.kept).any()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().merge(got[~got.base_failed], on="doc_id")
    assert (labels.kept == (labels.quality == 1)).mean() > 0.9
