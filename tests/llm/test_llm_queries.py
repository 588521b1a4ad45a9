"""The queries' contracts on the smallest tables, and the pipeline against its parts."""

import hashlib
import zlib
from collections import Counter

import corpus_pipeline
import pytest
import regex
from test_operators import plain_spans

from dqspark.llm import secrets
from dqspark.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def test_thirteen_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def test_pii_digests(spark, sf_dir, documents):
    for r in QUERIES["op1_pii"](spark, sf_dir).collect():
        spans = plain_spans(documents[r.doc_id].text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        assert set(joined.split(",")) <= set(r.spans.split(","))


def test_secrets_query(spark, sf_dir, documents):
    """The findings of a plain scan, all judged, none where the table has none."""
    runs = regex.compile(secrets.CANDIDATE, regex.ASCII)
    wanted = Counter((r.doc_id, m.start(), m.end(), m[0]) for r in documents.values() for m in runs.finditer(r.text or ""))
    found = QUERIES["op2_secrets"](spark, sf_dir).collect()
    assert Counter((r.doc_id, r.start, r.end, r.value) for r in found) == wanted
    assert all(0 <= r.score <= 1 for r in found)


@pytest.mark.parametrize("name", ["op3_decontamination", "op4_lm_scoring"])
def test_queries_run(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


@pytest.mark.parametrize(
    "name, columns",
    {
        "op5_simhash": "doc_id:bigint fingerprint:string component_id:bigint",
        "op6_sharding": "doc_id:bigint size:bigint text_crc32:bigint law:string shard:int slot:bigint grown_shard:int",
        "op7_quality": "doc_id:bigint held_out:boolean score:double predicted:int",
        "op8_mixing": "doc_id:bigint size:bigint source_size:bigint target:double taken:bigint shards:array<int>",
        "op9_embeddings": "vec_id:bigint n_links:bigint component_id:bigint kept:boolean",
        "op10_urls": "page_id:bigint host:string path:string rule:string verdict:string",
    }.items(),
)
def test_columns(spark, sf_dir, name, columns):
    assert " ".join(f"{n}:{t}" for n, t in QUERIES[name](spark, sf_dir).dtypes) == columns


def test_pipeline(spark, sf_dir, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near duplicates", "decontamination", "mixture", "shards"]
    docs, counts = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        counts.append(docs.count())
    assert len(documents) >= counts[0] >= counts[1] >= counts[2] > len(documents) / 2
    kept = {r.doc_id for r in docs.collect()}
    done = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in done} <= kept
    for r in done:
        assert r.text == documents[r.doc_id].text and r.text_crc32 == zlib.crc32(r.text.encode())
    slots = {}
    for r in done:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
