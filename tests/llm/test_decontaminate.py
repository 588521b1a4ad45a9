"""The latent cosine decides which passages are compared; an index serves only those it cannot serve."""

from functools import partial

import numpy as np
import pyarrow as pa
import pytest

from dqspark.llm import decontaminate
from dqspark.llm.common import mapped


@pytest.fixture(scope="module")
def planted(spark, sf_dir):
    """Passages whole, with a fifth of their words lost, and with half of them, in texts of the given documents."""
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    known = decontaminate.passages(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    word_of = {code: word.decode() for word, code in known.vocabulary.items()}
    hosts = [h for r in given if len(h := (r.text or "").split()) > 60]
    rng, texts = np.random.default_rng(4), [r.text for r in given]
    for codes in known.codes:
        for kept in decontaminate._keeping(codes, np.ones(len(word_of)), 1, rng):
            host = hosts[rng.integers(len(hosts))]
            own = [word_of[c] if k else str(rng.choice(host)) for c, k in zip(codes.tolist(), kept[0])]
            at = int(rng.integers(len(host)))
            texts.append(" ".join([*host[:at], *own, *host[at:]]))
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(4)
    encode = partial(decontaminate._encode, known.vocabulary)
    encoded = mapped(
        frame.selectExpr("id", "xxhash64(text) AS hash", "text"), encode, "id long, hash long, codes binary"
    )
    return encoded, known, *decontaminate.latent_space(encoded, known)


def _found(planted, least):
    encoded, known, idf, space = planted
    search = partial(decontaminate._search, known.codes, idf, space, least=least)
    rows = mapped(encoded, search, "id long, hash long, passage int, share double").collect()
    return {(r.id, r.passage): r.share for r in rows}


def test_the_cosine_finds_the_leaks(planted):
    """Beside the result of comparing every window that can count: next to all of it, and nothing else."""
    encoded, known, idf, space = planted
    least = decontaminate.needed_cosines(encoded, known, idf, space)
    every, by_cosine = _found(planted, None), _found(planted, least)
    assert len(every) >= 2 * len(known.codes)
    assert by_cosine.items() <= every.items()
    assert len(by_cosine) >= 0.99 * len(every)
    served = least >= decontaminate.FLOOR
    assert served.mean() > 0.5
    alone = [key for key in every if served[key[1]]]
    assert sum(key in by_cosine for key in alone) >= 0.99 * len(alone)


def test_nothing_is_found_without_the_cosine(planted):
    """Passages that the cosine serves have no other way; those that it does not serve do not need it."""
    encoded, known, idf, space = planted
    least = decontaminate.needed_cosines(encoded, known, idf, space)
    served = least >= decontaminate.FLOOR
    off = _found(planted, np.where(served, 2.0, least))
    assert off == {key: share for key, share in _found(planted, None).items() if not served[key[1]]}


def test_cosines_follow_from_all_windows(spark):
    """Moments as over all windows at once, however the documents are split; one document more changes them."""
    rng = np.random.default_rng(5)
    texts = [rng.integers(-1, 50, rng.integers(0, 90)).astype(np.int32) for _ in range(700)]
    space = np.vstack([rng.standard_normal((50, 6)), np.zeros((1, 6))]).astype(np.float32)

    def found(texts):
        frame = spark.createDataFrame([(bytearray(t.tobytes()),) for t in texts], "codes binary").repartition(3)
        return decontaminate.all_windows(frame, space)

    n = decontaminate.PASSAGE
    places = np.array([space[t[i : i + 2 * n]].sum(axis=0) for t in texts for i in range(0, len(t), n)], dtype=np.float64)
    lengths, moments = (places**2).sum(axis=1), found(texts)
    assert np.allclose(moments.mean, places.mean(axis=0), atol=1e-4)
    assert np.allclose(moments.spread, np.cov(places.T, bias=True), atol=1e-3)
    assert np.isclose(moments.length, lengths.mean()) and np.isclose(moments.length_spread, lengths.var(), rtol=1e-4)
    assert found([*texts, np.full(90, 7, dtype=np.int32)]).length > moments.length
    assert found([]).length == 0


def test_power_is_that_of_the_whole_matrix(monkeypatch):
    """Words counted in pairs, also when a task holds few: as the blocks' matrix multiplied out."""
    rng = np.random.default_rng(6)
    blocks = rng.integers(-1, 40, (300, decontaminate.PASSAGE)).astype(np.int32)
    idf = np.append(rng.random(38), [0, 0])
    weighted = np.vstack([rng.standard_normal((40, 5)) * idf[:, None], np.zeros((1, 5))]).astype(np.float32)
    has = np.zeros((300, 41))
    np.add.at(has, (np.repeat(np.arange(300), decontaminate.PASSAGE), blocks.ravel()), 1)
    has[:, -1] = 0
    whole = (has.T @ (has @ weighted))[:40] * idf[:, None]
    for held in (4_000_000, 100):
        monkeypatch.setattr(decontaminate, "HELD", held)
        batch = pa.RecordBatch.from_pydict({"codes": [b.tobytes() for b in blocks]})
        (out,) = decontaminate._power(weighted, idf, iter([batch.slice(0, 90), batch.slice(90)]))
        total = np.zeros((40, 5))
        total[out["code"].to_numpy()] = out["row"].to_pylist()
        assert np.allclose(total, whole, rtol=1e-4, atol=1e-3)


def test_marks_meet_in_pieces(monkeypatch):
    """A word that marks every passage, in every window: as found at once, piece by piece."""
    codes_of = [np.array([0, i, i + 1], dtype=np.int32) for i in range(1, 60, 2)]
    idf = np.append(5.0, np.ones(60))
    space = np.vstack([np.diag(idf), np.zeros((1, 61))]).astype(np.float32)
    held = [np.concatenate([c, np.full(20, 0, dtype=np.int32)]) for c in codes_of]
    batch = pa.RecordBatch.from_pydict(
        {"id": list(range(30)), "hash": [0] * 30, "codes": [h.tobytes() for h in held]}
    )

    def found():
        (out,) = decontaminate._search(codes_of, idf, space, iter([batch]))
        return sorted(zip(out["id"].to_pylist(), out["passage"].to_pylist()))

    whole = found()
    assert {(i, i) for i in range(30)} <= set(whole)
    monkeypatch.setattr(decontaminate, "PIECE", 7)
    assert found() == whole
