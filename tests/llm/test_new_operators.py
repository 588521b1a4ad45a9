"""Whitening, spelling variants and packing against plain Python, with nulls, empties, ties and repeated rows."""

import bisect
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from compare import connect, differences
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dqspark.llm import packing, spelling, whitening
from dqspark.llm.queries import ORACLES, QUERIES

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ODD_TEXTS = [
    None,
    "",
    " \t\n",
    "<|endoftext|> a<|startoftext|>b <| |>",
    "a\x1cb c\x85d e\xa0f ''s 'S's'tx 1'23,.- _a_ \x00\x01 a\x00b",
    "ΑΣ ΟΔΟΣ İ é ́a don't I'LL 3rd 日本語 😀x ×÷ ªº µ",
    "word " * 30000,
    "x" * 5000,
    "Straße straßen STRASSE Éa éa ÉÀ",
]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    given_ = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = [(9000 + i, text) for i, text in enumerate(ODD_TEXTS)]
    odd += [(None, "lettre lettres letter"), (None, "lettre lettres letter"), (9005, "Letter"), (9005, "Letter")]
    odd += [(9100 + i, "the very same copy of a text that many have") for i in range(150)]
    clashing = {n: F.lit(-1) for n in ("id", "word", "n", "x", "v", "index", "length", "start", "a.b")}
    together = given_.unionByName(spark.createDataFrame(odd, given_.schema))
    return together.withColumns(clashing).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


# Whitening


def plain_whitening(vectors, components=16):
    """From a dict of vectors: n, deviations, projections, shares."""
    x = {k: np.floor(64 * np.array(v, dtype=float)).astype(np.int64) + 1_000_000 for k, v in vectors.items()}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    covariance = centred.T @ centred / n
    e, axes = np.linalg.eigh(covariance)
    order = np.argsort(-e)[:components]
    order = order[e[order] > 1e-9 * e.max()] if e.max() > 0 else order[:0]
    apart = {k: n * v - sums for k, v in x.items()}
    white = {k: a / n @ axes[:, order] / np.sqrt(e[order]) for k, a in apart.items()}
    return n, {k: int((a * a).sum()) for k, a in apart.items()}, white, e[order] / np.trace(covariance)


def same_up_to_sign(found, wanted):
    """Components may be turned, each for all rows alike."""
    a, b = np.array(found), np.array(wanted)
    signs = np.sign((a * b).sum(axis=0))
    assert np.allclose(a * signs, b, atol=1e-8)


def test_whitening_query(spark, sf_dir):
    given_ = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    n, deviations, white, shares = plain_whitening(given_)
    rows = defaultdict(dict)
    for r in QUERIES["op11_whitening"](spark, sf_dir).collect():
        rows[r.vec_id][r.component] = r
    assert set(rows) == set(given_) and all(sorted(c) == list(range(1, 17)) for c in rows.values())
    ids = sorted(given_)
    assert all(r.n == n and r.deviation == deviations[i] for i in ids for r in rows[i].values())
    same_up_to_sign([[rows[i][c].whitened for c in range(1, 17)] for i in ids], [white[i] for i in ids])
    for c in range(1, 17):
        assert math.isclose(rows[ids[0]][c].explained, shares[c - 1], rel_tol=1e-8)
        assert rows[ids[0]][c].identity_error < 1e-9


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = {i: (rng.normal(size=5) * [5, 4, 3, 2, 1]).tolist() for i in range(60)}
    good |= {100 + i: [1.0, 2.0, 3.0, 4.0, 5.0] for i in range(200)}
    bad = [
        (900, None),
        (901, []),
        (902, [None] + [1.0] * 4),
        (903, [math.nan] + [1.0] * 4),
        (904, [math.inf] * 5),
        (905, [1e300] * 5),
        (906, [1.0, 2.0]),
        (907, None),
    ]
    rows = [*good.items(), *bad, (5, good[5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.withColumns({n: F.lit("mine") for n in ("x", "v", "index", "id", "n", "whitened")})
    n, deviations, white, shares = plain_whitening(good)
    found = whitening.whiten(df).collect()
    assert Counter(r.id for r in found) == Counter([*good, 5]) and n == 61
    assert all(r.n == n and r.deviation == deviations[r.id] and len(r.whitened) == 5 for r in found)
    same_up_to_sign([r.whitened for r in found], [white[r.id] for r in found])
    assert np.allclose(found[0].explained, shares, rtol=1e-9)


def test_whitening_without_spread(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [None])], schema)).collect() == []
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25]), (None, [0.5, 0.25])], schema)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 0, [], [])] * 2
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), float(2 * i)]) for i in range(9)], schema)).collect()
    assert {len(r.whitened) for r in line} == {1} and math.isclose(line[0].explained[0], 1.0)
    huge = whitening.whiten(spark.createDataFrame([(1, [1e13, 0.0]), (2, [0.0, 0.0])], schema)).collect()
    assert {r.deviation for r in huge} == {None} and all(math.isclose(abs(r.whitened[0]), 1.0) for r in huge)


# Spelling


def plain_words(rows, typo_every=97, shortest=5, fewest=3):
    n = Counter()
    for name, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if name is None else name}:{w}".encode())
            if typo_every and h % typo_every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= shortest and c >= fewest}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words, near):
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def rows_of(df):
    return Counter((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_spelling_query_equals_sql(spark, sf_dir):
    assert differences(QUERIES["op12_spelling"](spark, sf_dir), connect(sf_dir), ORACLES["op12_spelling"]) is None


def test_vocabulary(spark, docs, none):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for every, shortest, fewest in ((97, 5, 3), (None, 1, 1)):
        found = spelling.vocabulary(docs, typo_every=every, shortest=shortest, fewest=fewest).collect()
        assert {r.word: r.n for r in found} == plain_words(rows, every, shortest, fewest) and len(found) > 10
    assert spelling.vocabulary(none).collect() == []


def test_variants_in_rounds(spark, monkeypatch):
    """Filters in many small slices and rounds, full of errors, give what comparing all pairs gives."""
    rng = random.Random(3)
    base = ["".join(rng.choice("abéz") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    words = {w: rng.randint(1, 40) for w in base + ["y" * 3000, "y" * 2999 + "z", "y" * 2999, "日本", "日木", "", "aaaa", "aaaaa"]}
    rows = [*words.items(), (None, 3), ("null", None), ("aaaa", 7)]
    words["aaaa"] += 7
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    wanted = Counter(plain_variants(words, near))
    df = spark.createDataFrame(rows, "word string, n long").withColumn("near", F.lit(1))
    assert rows_of(spelling.variants(df)) == wanted
    for name, value in (("SLICE", 16), ("BLOCKS", 1), ("BITS", 8), ("BROADCAST", 64)):
        monkeypatch.setattr(spelling, name, value)
    assert rows_of(spelling.variants(df)) == wanted


def test_chains_of_forms_and_no_words(spark):
    chain = {"a" * i: 2**i for i in range(5, 25)}
    near = {w: [o for o in chain if one_edit(w, o)] for w in chain}
    assert rows_of(spelling.variants(spark.createDataFrame(list(chain.items()), "word string, n long"))) == Counter(
        plain_variants(chain, near)
    )
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).collect() == []
    assert spelling.variants(spark.createDataFrame([(None, None)], "word string, n long")).collect() == []


# Packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.integers(1, 16))
def test_best_fit_takes_the_tightest(lengths, window):
    lengths = [n for n in lengths if n <= window]
    windows, offsets = packing.best_fit(lengths, window)
    free, wanted = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect.bisect_left(free, lengths[i])
        room = free.pop(at) if at < len(free) else window
        wanted[i] = room - lengths[i]
        if wanted[i]:
            bisect.insort(free, wanted[i])
    assert [window - o - n for o, n in zip(offsets, lengths)] == [wanted[i] for i in range(len(lengths))]
    places = sorted((w, o, n) for w, o, n in zip(windows, offsets, lengths))
    assert all(b[1] == (a[1] + a[2] if a[0] == b[0] else 0) for a, b in zip(places, places[1:]))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=50), st.integers(1, 32), st.sampled_from([0.0, 0.01, 1.0]))
def test_pieces_cover_documents_and_windows(lengths, window, padding):
    pieces = packing.packed(lengths, window, padding)
    at, fill = Counter(), Counter()
    for document, start, length, _, _ in pieces:
        assert start == at[document] and length > 0
        at[document] += length
    for _, _, length, place, offset in sorted(pieces, key=lambda p: (p[3], p[4])):
        assert offset == fill[place]
        fill[place] += length
    assert list(at.values()) == lengths and max(fill.values()) <= window
    if padding == 0.0:
        emptiest = sorted(fill.values())[0]
        assert sum(window - f for f in fill.values()) - (window - emptiest) < emptiest or all(
            f == window or f & (f - 1) == 0 for f in fill.values()
        )


def test_copies_of_one_length_leave_little_padding():
    pieces = packing.packed([1300] * 1000, 2048)
    windows = len({p[3] for p in pieces})
    assert 1 - 1300 * 1000 / (2048 * windows) <= packing.PADDING + 2048 / (1300 * 1000)


def test_ids_of_whole_texts(docs, monkeypatch):
    reader, words = Tokenizer.from_file(TOKENIZER), packing.Words(TOKENIZER)
    for small in (False, True):
        if small:
            monkeypatch.setattr(packing, "SLICE", 40)
            monkeypatch.setattr(packing, "REMEMBERED", 30)
        for r in docs.select("text").distinct().limit(60 if small else 1000).collect():
            found = [i for part in words.ids(r.text or "") for i in part.tolist()]
            assert found == reader.encode(r.text or "", add_special_tokens=False).ids


def test_packing_round_trip(docs, none):
    reader = Tokenizer.from_file(TOKENIZER)
    pieces = packing.pack(docs, TOKENIZER, window=512, end=1).collect()
    wanted = Counter(
        (r.doc_id, tuple(reader.encode(r.text or "", add_special_tokens=False).ids) + (1,)) for r in docs.collect()
    )
    held, rest = Counter(), defaultdict(list)
    for p in pieces:
        ids = struct.unpack(f"<{p.length}I", p.ids)
        rest[p.id].append((p.start, p.doc_tokens, ids))
    for name, parts in rest.items():
        if name is None or name == 9005:  # several documents of one id, each of one piece here
            held.update((name, ids) for _, _, ids in parts)
            continue
        parts.sort()
        assert [s for s, _, _ in parts] == [sum(len(i) for _, _, i in parts[:k]) for k in range(len(parts))]
        whole = tuple(i for _, _, ids in parts for i in ids)
        assert {t for _, t, _ in parts} == {len(whole)}
        held[name, whole] += 1
    assert held == wanted
    fill = Counter()
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == fill[p.sequence_id]
        fill[p.sequence_id] += p.length
    for p in pieces:
        total = fill[p.sequence_id]
        assert total <= 512 and p.padded == (total if total & (total - 1) == 0 else 512)
    assert packing.pack(none, TOKENIZER).collect() == []


def test_sequences(docs):
    pieces = packing.pack(docs, TOKENIZER, window=512)
    rows = sorted(pieces.collect(), key=lambda p: (p.sequence_id, p.offset))
    wanted = defaultdict(bytes)
    for p in rows:
        wanted[p.sequence_id] += p.ids
    found = packing.sequences(pieces).collect()
    assert {r.sequence_id: bytes(r.ids) for r in found} == wanted
    assert all(len(r.ids) <= 4 * r.padded and r.starts[0] == 0 for r in found)


def test_packing_query(spark, sf_dir):
    reader = Tokenizer.from_file(TOKENIZER)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    at, kinds = Counter(), QUERIES["op13_packing"](spark, sf_dir)
    assert " ".join(f"{n}:{t}" for n, t in kinds.dtypes) == (
        "doc_id:bigint start:bigint length:bigint ids_crc32:bigint doc_tokens:bigint sequence_id:bigint offset:bigint"
    )
    rows = sorted(kinds.collect(), key=lambda r: (r.doc_id, r.start))
    ids = {k: reader.encode(t or "", add_special_tokens=False).ids + [1] for k, t in texts.items()}
    for r in rows:
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        at[r.doc_id] += r.length
    assert at == {k: len(v) for k, v in ids.items()}
    fill = Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    padding = sum(0 if f & (f - 1) == 0 else 2048 - f for f in fill.values())
    assert max(fill.values()) <= 2048 and padding < 0.02 * sum(fill.values())
