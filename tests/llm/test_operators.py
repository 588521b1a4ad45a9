"""The training-data operators against plain Python on small tables with nulls, empties, ties and repeated rows."""

import math
import re
import zlib
from collections import Counter, defaultdict
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from dqspark.llm import decontaminate, embeddings, masked_lm, mixing, pii, quality, secrets, sharding, simhash, urls
from dqspark.llm.common import mapped, word_count
from dqspark.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    """The given documents, and awkward ones; with columns named like those that operators add or use."""
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*[c.split()[0] for c in SCHEMA.split(", ")])
    odd = [
        (9001, None, None, None, None),
        (9002, "", "en", None, 0),
        (9003, " \t\n", "en", "src0", 3),
        (9004, "word " * 30000, "en", "src1", None),
        (9005, "one two three", "en", "src1", 13),
        (9005, "one two three", "en", "src1", 13),
        (None, "a text without an id", "en", "src1", 20),
        (None, "a text without an id", "en", "src1", 20),
        (9006, "x" * 50000, None, "src2", 1),
    ]
    odd += [(9100 + i, "the very same copy of a text that many have", "en", "hot", 1) for i in range(100)]
    together = given.unionByName(spark.createDataFrame(odd, SCHEMA))
    clashing = {n: F.lit(-1) for n in ("size", "shard", "slot", "score", "fp", "root", "c0", "pii", "key", "rank", "a.b")}
    return together.withColumns(clashing).repartition(4)


@pytest.fixture(scope="module")
def rows(docs):
    return [r.asDict() for r in docs.collect()]


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def plain_spans(text):
    def digits(s):
        return re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) < 256 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    }
    return [
        (k, m.start(), m.end()) for k, (rx, ok) in kinds.items() for m in re.finditer(rx, text or "") if ok(m.group())
    ]


PII_TEXTS = [
    "a@b.c_d@e.f, x@y.z.w-@q.r a@b a@b. @c.d é.x@y.z",
    "1.2.3.4.5.6.7.8 999.1.2.3.4 0001.002.3.255 1.2.3.256 1..2.3.4 1.2.3",
    "4111111111111111 4111 1111-1111 1111 41111111111111112 1 2 3 4111-1111-1111-1111-4  4111111111111111",
    "+1 (743) 555-3824 +12 +1234567 +1234567890123456 ++49 30 1234567- +4 .. +1+2 345 6789",
    "日本 😀 mail: a@b.co, 10.0.0.1 😀 10.0.0.2 +49 (30) 1234567",
    "a@" * 500 + "b.c",
    "1-" * 5000,
    "%" * 20000 + "@x.y",
]


def test_pii(spark, docs, rows):
    extra = spark.createDataFrame([(i, t) for i, t in enumerate(PII_TEXTS)], "doc_id long, text string")
    for frame in (docs, extra):
        for r in pii.find(frame).select("doc_id", "text", "pii").collect():
            base = [(s.kind, s.start, s.end) for s in r.pii if s.kind in ("email", "ip", "card", "phone")]
            assert base == plain_spans(r.text)
            assert all(r.text[s.start : s.end] == s.text for s in r.pii)


def test_pii_further_kinds(spark):
    texts = ["my iban GB82 WEST 1234 5698 7654 32.", "GB82 WEST 1234 5698 7654 33", "ssn 123-45-6789", "123-45-6789",
             "amex card 378282246310005", "378282246310005"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [[s.kind for s in r.pii] for r in pii.find(frame).collect()] == [["iban"], [], ["ssn"], [], ["shortcard"], []]
    clean = pii.masked(spark.createDataFrame([("mail a@b.co now", 1), (None, 2)], "text string, n int")).collect()
    assert [r.text for r in clean] == ["mail [email] now", None]


def test_words(docs):
    for r in docs.select("text", word_count(F.col("text")).alias("n")).collect():
        assert r.n == len(WS.findall(r.text or ""))


def plain_fingerprint(text):
    words = WS.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_fingerprint_is_sparks_hash(spark):
    one = spark.createDataFrame([("one two three four",)], "t string").select(F.xxhash64("t")).first()[0]
    assert simhash.fingerprint(b"One two THREE four") == one % (1 << 64)


def grouped(ids, linked):
    root = {i: i for i in range(len(ids))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        root[max(find(a), find(b))] = min(find(a), find(b))
    members = defaultdict(list)
    for i in range(len(ids)):
        members[find(i)].append(i)
    least = {}
    for group in members.values():
        known = [ids[i] for i in group if ids[i] is not None]
        least |= {i: min(known, default=None) for i in group}
    return least


def test_simhash(docs, rows, none):
    found = simhash.near_duplicates(docs).collect()
    fps = [plain_fingerprint(r["text"]) for r in found]
    assert [r["fingerprint"] for r in found] == [f"{fp:016x}" for fp in fps]
    values = np.array(fps, dtype=np.uint64)
    near = [(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[:i]) <= 4).tolist()]
    least = grouped([r["doc_id"] for r in found], near)
    assert [r["component_id"] for r in found] == [least[i] for i in range(len(found))]
    kept = simhash.one_of_each(docs).collect()
    assert len(kept) == len({(least[i], fps[i] if least[i] is None else 0) for i in range(len(fps))})
    assert simhash.one_of_each(none).count() == 0 == simhash.near_duplicates(none).count()


def test_dense_fingerprints(spark, monkeypatch):
    """A large group of close fingerprints, cut into small parts: every link is found, few leave a task."""
    monkeypatch.setattr(simhash, "GROUP", 64)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 5, dtype=np.int64)
    fps = {int(b) ^ sum(1 << int(x) for x in rng.choice(62, k, replace=False)) for b in base for k in range(6) for _ in range(60)}
    fps = sorted(fps | {int(x) for x in rng.integers(-(2**62), 2**62, 300)})
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = {r.fp: r.root for r in simhash.component_table(frame).collect()}
    values = np.array(fps, dtype=np.int64).view(np.uint64)
    near = [(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[:i]) <= 4).tolist()]
    assert {f: found.get(f, f) for f in fps} == {fps[i]: r for i, r in grouped(fps, near).items()}
    assert simhash.links(frame).count() < 15 * 30 * len(fps)


def test_components_of_a_chain(spark):
    chain = spark.range(1, 400).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    loops = spark.createDataFrame([(7, 7), (5, 4), (1000, 2000)], "a long, b long")
    found = {r.node: r.root for r in components(chain.union(loops)).collect()}
    assert found == {i: 0 for i in range(400)} | {1000: 1000, 2000: 1000}


def test_sharding(docs, rows, none):
    found = sharding.shard(docs, shards=24).collect()
    assert len(found) == len(rows) and "a.b" in found[0]
    slots = defaultdict(list)
    for r in found:
        data = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(24))
    assert sharding.shard(none).count() == 0


def test_shards_are_even_and_copies_stay(spark):
    """With a hot text, of a third of all rows, shards are even; smaller groups of copies are in one shard."""
    frame = spark.range(60000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot text " * 5).otherwise(F.concat(F.lit("text "), (F.col("id") / 9).cast("int"))).alias("text"),
    )
    found = sharding.shard(frame, shards=8).toPandas()
    sizes = found.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() < 1.03 * sizes.mean() and sizes.min() > 0.97 * sizes.mean()
    others = found[found.doc_id % 3 != 0].groupby("text_crc32")["shard"].nunique()
    assert others.max() == 1


def test_targets():
    assert mixing.targets([10, 10, 10], [3, 1, 2], 1.5, 2) == [20, pytest.approx(25 / 3), pytest.approx(50 / 3)]
    assert mixing.targets([], [], 1.5, 2) == [] and mixing.targets([0, 5], [1, 1], 1.5, 2) == [0, 7.5]


def test_split_is_exact():
    parts = mixing.split([100, 0, 37, 5], 7, np.random.default_rng(0))
    assert parts.sum(axis=0).tolist() == [100, 0, 37, 5] and set(parts.sum(axis=1).tolist()) <= {20, 21}


def test_mixing(docs, rows, none):
    found = mixing.plan(docs).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in found:
        assert r["size"] == len(WS.findall(r["text"] or "")) and len(r["shards"]) == r["copies"] <= 2
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = mixing.targets([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5, 2.0)
    assert [target[s] for s in order] == pytest.approx(wanted)
    largest = defaultdict(int)
    for r in found:
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in sizes)
    again = mixing.plan(docs.repartition(3)).collect()
    assert Counter((r["doc_id"], r["copies"]) for r in again) == Counter((r["doc_id"], r["copies"]) for r in found)
    assert mixing.mix(docs).count() == sum(r["copies"] for r in found)
    assert mixing.mix(none).count() == 0


def test_mix_comes_near_its_targets(spark):
    frame = spark.range(20000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("w "), (F.pmod(F.xxhash64("id"), F.lit(50)) + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "a").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
    )
    found = mixing.plan(frame).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"))
    assert all(abs(r.taken - r.target) <= 2 for r in found.collect())


def test_quality(spark, sf_dir, docs, none):
    given = spark.read.parquet(f"{sf_dir.rsplit('/', 1)[0]}/sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir.rsplit('/', 1)[0]}/sf0.01/labels.parquet")
    odd = spark.createDataFrame([(None, 1, 1), (0, None, None), (-5, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(given, labels.union(odd))
    held = [i for i in (r.doc_id for r in labels.collect()) if zlib.crc32(str(i).encode()) % 5 == 0]
    scored = quality.scored(given, model).join(labels, "doc_id").filter(F.col("doc_id").isin(held)).collect()
    ranks = [(r.score, r.quality) for r in scored]
    pairs = [(a > b) + 0.5 * (a == b) for a, x in ranks if x for b, y in ranks if not y]
    assert sum(pairs) / len(pairs) > 0.95
    assert sum(r.predicted == r.quality for r in scored) / len(scored) > 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in quality.scored(docs, model).collect())
    assert quality.scored(none, model).count() == 0
    blank = quality.train(none.select("doc_id", "text"), labels)
    assert [r["score"] for r in quality.scored(docs, blank).limit(1).collect()] == [0.5]


def test_features_of_empty_and_long():
    assert all(math.isfinite(v) for t in (b"", b" ", b"\xff", b"a" * 10**6, b"\n" * 9) for v in quality.features(t))


@pytest.fixture(scope="module")
def benchmark(spark, sf_dir):
    odd = [(900, None), (901, ""), (None, "an item without an id but with a handful of words in it")]
    given = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return given.union(spark.createDataFrame(odd, "item_id long, text string"))


def test_common_subsequence():
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = row[:]
            for j, y in enumerate(b):
                row[j + 1] = before[j] + 1 if x == y else max(row[j], before[j + 1])
        return row[-1]

    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = (rng.integers(0, 6, rng.integers(1, 30)).tolist() for _ in range(2))
        assert decontaminate.common_subsequence(a, b) == slow(a, b)


def test_decontamination(spark, docs, rows, none, benchmark):
    items = {r.item_id: r.text for r in benchmark.collect() if r.text and r.item_id is not None}
    texts = list(items.items())
    words = [t.split() for _, t in texts]
    mild = [w for i, w in enumerate(words[0]) if i % 8]
    planted = [
        (8001, " ".join(["unrelated"] * 50 + words[1] + ["unrelated"] * 70), texts[1][0]),
        (8002, texts[2][1].upper().replace(" ", " ***\n"), texts[2][0]),
        (8003, " ".join(["filler"] * 7 + mild + ["filler"] * 90), texts[0][0]),
    ]
    extra = spark.createDataFrame([(i, t, "en", "src0", 1) for i, t, _ in planted], SCHEMA)
    both = docs.unionByName(extra, allowMissingColumns=True)
    found = {(r.id, r.item_id) for r in decontaminate.leaks(both, benchmark).collect()}
    assert {(i, item) for i, _, item in planted} <= found
    exact = {(r["doc_id"], i) for r in rows for i, t in texts if t in (r["text"] or "")}
    assert exact <= found
    loose = {r["doc_id"]: decontaminate.words((r["text"] or "").encode()) for r in rows} | {i: decontaminate.words(t.encode()) for i, t, _ in planted}
    for doc, item in found:
        own = decontaminate.words(items[item].encode())
        codes = {w: i for i, w in enumerate({*own, *loose[doc]})}
        share = decontaminate.common_subsequence([codes[w] for w in own], [codes[w] for w in loose[doc]])
        assert share >= min(8, len(own) / 2)
    clean = decontaminate.clean(both, benchmark)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in both.collect()} - {i for i, _ in found}
    assert clean.columns == both.columns
    assert decontaminate.leaks(none, benchmark).count() == 0 == decontaminate.leaks(docs, benchmark.limit(0)).count()


def test_passages_in_pieces(monkeypatch):
    rng = np.random.default_rng(5)
    codes_of = [rng.integers(0, 300, n).astype(np.int32) for n in (16, 16, 3, 16, 9, 1, 16)]
    held = [rng.integers(-1, 300, n).astype(np.int32) for n in (0, 5, 400, 90)]
    held += [np.concatenate([held[2][:21], c, held[3][:40]]) for c in codes_of]
    idf = rng.random(300) + 0.1
    space = np.vstack([np.diag(idf), np.zeros((1, 300))]).astype(np.float32)  # no dimension left out: true cosines
    batch = pa.RecordBatch.from_pydict(
        {"id": list(range(len(held))), "hash": [0] * len(held), "codes": [c.tobytes() for c in held]}
    )

    def found():
        (out,) = decontaminate._search(codes_of, idf, space, iter([batch]))
        return sorted(zip(*[out[n].to_pylist() for n in ("id", "passage", "share")]))

    whole = found()
    assert {(4 + i, i) for i, c in enumerate(codes_of) if len(c) > 8} <= {(d, p) for d, p, _ in whole}
    monkeypatch.setattr(decontaminate, "SLICE", 3)
    monkeypatch.setattr(decontaminate, "PIECE", 2)
    assert found() == whole


def test_passages_far_in_the_latent_space():
    """Hosts made of the benchmark's own words, few dimensions: what is found is what brute force finds."""
    rng = np.random.default_rng(8)
    codes_of = [rng.integers(0, 400, n).astype(np.int32) for n in (16, 16, 12, 9, 16, 5, 16, 16, 7, 16) * 4]
    idf = np.where(np.arange(400) < 40, 0, rng.random(400) + 0.1)
    space = np.vstack([rng.standard_normal((400, 2)) * idf[:, None], np.zeros((1, 2))]).astype(np.float32)
    held = []
    for c in codes_of:
        for share in (0, 0.15, 0.45):
            answer = np.isin(c, decontaminate._answers(c, idf))
            changed = np.where(~answer & (rng.random(len(c)) < share), rng.integers(0, 400, len(c)), c).astype(np.int32)
            held.append(np.concatenate([rng.integers(0, 400, rng.integers(0, 50)), changed, rng.integers(0, 400, 60)]).astype(np.int32))
    batch = pa.RecordBatch.from_pydict(
        {"id": list(range(len(held))), "hash": [0] * len(held), "codes": [h.tobytes() for h in held]}
    )
    (out,) = decontaminate._search(codes_of, idf, space, iter([batch]))
    found = dict(zip(zip(out["id"].to_pylist(), out["passage"].to_pylist()), out["share"].to_pylist()))
    wanted = {}
    for d, h in enumerate(held):
        for start in range(0, len(h), decontaminate.PASSAGE):
            window = h[start : start + 2 * decontaminate.PASSAGE].tolist()
            for p, c in enumerate(codes_of):
                share = decontaminate.common_subsequence(c.tolist(), window) / len(c)
                answered = set(decontaminate._answers(c, idf).tolist()) <= set(window)
                if share >= decontaminate.COPY or answered and share >= decontaminate.PARAPHRASE:
                    wanted[d, p] = max(share, wanted.get((d, p), 0))
    assert found == wanted and len(wanted) >= 2 * len(codes_of)


def test_lm_gradients():
    rng = np.random.default_rng(0)
    net = {k: v.astype(np.float64) for k, v in masked_lm.initial().items()}
    around, token = rng.integers(0, masked_lm.EDGE + 1, (40, 4)), rng.integers(0, masked_lm.EDGE, 40)
    grads = masked_lm.gradients(net, around, token)
    for name in net:
        at = np.unravel_index(np.abs(grads[name]).argmax(), net[name].shape)
        value, step = net[name][at], 1e-5
        sides = []
        for moved in (value + step, value - step):
            net[name][at] = moved
            sides.append(-masked_lm.log_probabilities(net, around, token).mean())
        net[name][at] = value
        assert grads[name][at] == pytest.approx((sides[0] - sides[1]) / 2 / step, rel=1e-3)


def test_lm_probabilities_sum_to_one():
    net, token = masked_lm.initial(), np.arange(masked_lm.EDGE)
    found = masked_lm.log_probabilities(net, np.tile([1, 5, 7, 9], (len(token), 1)), token)
    assert np.exp(found).sum() == pytest.approx(1, abs=1e-4)


def test_lm_scores(spark, docs, rows, none):
    found = masked_lm.scores(docs).collect()
    wanted = sorted((r["doc_id"] is None, r["doc_id"] or 0, len((r["text"] or "").encode().lower().split())) for r in rows)
    assert sorted((r.id is None, r.id or 0, r.tokens) for r in found) == wanted
    for r in found:
        assert r.mean is None and r.log_likelihood == 0 if not r.tokens else r.mean == pytest.approx(r.log_likelihood / r.tokens)
    untrained = {r.id: r.mean for r in masked_lm.scores(docs, rounds=0).collect() if r.tokens}
    trained = {r.id: r.mean for r in found if r.tokens}
    assert sum(trained.values()) > sum(untrained.values())
    assert masked_lm.scores(none).count() == 0


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_lm_learns_from_every_position(spark, docs, rows, rounds):
    """The rounds together predict each token of each document once, whatever the tasks."""
    encoded, net = masked_lm.encode(docs.selectExpr("doc_id AS id", "text").repartition(3)), masked_lm.initial()
    schema = "chunk int, task long, n long, weights binary"
    learnt = 0
    for round_ in range(rounds):
        parts = mapped(encoded.select("codes"), partial(masked_lm._train, net, round_, rounds), schema)
        learnt += sum(r.n for r in parts.filter("chunk = 0").collect())
    assert learnt == sum(len((r["text"] or "").encode().lower().split()) for r in rows) > 0


def test_lm_uses_both_sides(spark):
    """Words in a fixed round are told from their neighbours, far better than by how common they are; mixed ones are not."""
    n, words = 24, [f"w{i}" for i in range(24)]
    rng = np.random.default_rng(7)
    texts = [" ".join(words[(k + j) % n] for j in range(200)) for k in range(1500)]
    mixed = [" ".join(rng.choice(words, 200)) for _ in range(20)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts + mixed)], "doc_id long, text string").repartition(4)
    mean = {r.id: r.mean for r in masked_lm.scores(frame).collect()}
    assert min(mean[i] for i in range(1500)) > -math.log(n) / 2
    assert max(mean[i] for i in range(1500, 1520)) < -math.log(n)


def test_lm_tells_rare_words_apart(spark):
    """Words outside the vocabulary, of one shape in the same place: their scores differ as their counts do."""
    common = [f"c{i}" for i in range(masked_lm.WORDS)]
    rare = [f"rare{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]
    texts = [" ".join(common * 20)] + [f"c1 c2 {w} c3 c4" for i, w in enumerate(rare) for _ in range(1 + i % 7)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    found = {r.id: r.log_likelihood for r in masked_lm.scores(frame).collect()}
    counts = Counter(t.split()[2] for t in texts[1:])
    apart = [found[i] - math.log(counts[texts[i].split()[2]]) for i in range(1, len(texts))]
    assert len(found) == len(texts) and max(apart) - min(apart) < 1e-4


def test_secrets(spark, sf_dir, docs, none):
    larger = spark.read.parquet(f"{sf_dir.rsplit('/', 1)[0]}/sf0.01/documents.parquet")
    docs = docs.select(*larger.columns).filter("doc_id > 9000 OR doc_id IS NULL").union(larger)
    found = secrets.scan(docs).collect()
    text_of = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(text_of[r.id][r.start : r.end] == r.value for r in found)
    named = {(r.id, r.start) for r in found if re.search(r'token = "$', text_of[r.id][: r.start])}
    assert named and named <= {(r.id, r.start) for r in found if r.secret}
    assert secrets.scan(none).count() == 0


def test_secrets_match_a_text_once(spark):
    """No filter that Spark infers matches the pattern again; spans are those of the pattern without its short cuts."""
    names = "token|secret|passw|pwd|api.?key|auth|credential|bearer|private"
    plain = regex.compile(
        rf"""(?<=(?i:{names})[A-Za-z_]{{0,12}}["']?\s{{0,2}}[:=]\s{{0,2}}["']?)[^\s"'<>(){{}}\[\],;]{{4,}}+"""
        r"|(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}+",
        regex.ASCII,
    )
    parts = ["token", "API-key", "Auth_x", "pwd", "=", ":", '"', "'", " ", "  ", "\n", "ab12", "é", "-_/+", "x" * 9, "Q7" * 8, ";", "😀"]
    rng = np.random.default_rng(7)
    texts = ["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(800)] + [None, "", "token_aaaaaaaaaaaaaaaa=abcd"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets.candidates(docs, path=None)
    wanted = [(i, m.start(), m.end(), m[0]) for i, t in enumerate(texts) for m in plain.finditer(t or "")]
    assert len(wanted) > 800 and sorted((r.id, r.start, r.end, r.value) for r in found.collect()) == wanted
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert [plan.count(f"{f}(") for f in ("rlike", "regexp_extract_all", "split")] == [1, 1, 1]


def test_secrets_seeds(spark):
    """Words near a secret do not make it a placeholder; runs that are no keys are there to learn from."""
    key = "269b58ed0c1f4a7e93d2b6a8f05c7d1e4b3a2960"
    texts = [f'a@mail6.example.com token = "{key}"', f'Asanstestion it token = "{key}"', 'token = "example-key-12345678"',
             f"commit {key}", f"some {key} there", "a line --------------------", "internationalization-of-all",
             'password = "hunter2!x"', "secret: Tr0ub4dor&3zz9", "the secret: patience", f"api_key={key[:6]}"]
    docs = spark.createDataFrame([(i, t, "src") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    found = secrets.measured(secrets.candidates(docs), [])
    assert {r.id: r.label for r in secrets.seeds(found).collect()} == dict(enumerate([1, 1, 0, 0, None, 0, 0, 1, 1, 0, 1]))
    values = {r.id: r.value for r in secrets.scan(docs).collect()}
    assert values.keys() == set(range(11))
    assert [values[i] for i in (0, 6, 7, 8, 9, 10)] == [
        key, "internationalization-of-all", "hunter2!x", "Tr0ub4dor&3zz9", "patience", key[:6]
    ]
    many = [(i, f'the token = "{key[i % 9:]}{i}"' if i % 2 else "a line --------------------", "src") for i in range(80)]
    many += [(100 + i, f"commit {key}", "src") for i in range(40)]
    judged = secrets.scan(spark.createDataFrame(many, "doc_id long, text string, source string")).collect()
    assert len(judged) == 120 and all(r.secret == (r.id < 100 and r.id % 2 == 1) for r in judged)


def test_secrets_alike_in_signs(spark):
    """Identifiers of dictionary words, and keys made of the very same signs in another order, after the same names: the
    forest tells them apart by order, words and neighbours, on findings that it has not learnt from."""
    rng = np.random.default_rng(5)
    words = ["release", "build", "version", "stable", "candidate", "server", "client", "update"]
    rows, labels = [(i, " ".join(words * 3), "src") for i in range(1000, 1050)], []
    for i in range(600):
        name = "-".join(rng.choice(words, 3)) + str(rng.integers(1000, 9999))
        key = "".join(rng.permutation(list(name)))
        value = key if i % 2 else name
        text = f'auth = "{value}"' if i % 3 else f"token: {value}"
        rows.append((i, f"see the {text} here", "src"))
        labels.append((i, rows[-1][1].index(value), rows[-1][1].index(value) + len(value), i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = secrets.scan(docs, spark.createDataFrame(labels, "id long, start int, end int, label int")).collect()
    held = [r for r in found if zlib.crc32(str(r.id).encode()) % 5 == 0]
    right = sum(r.secret and r.id % 2 == 1 for r in held)
    assert len(found) == 600 and len(held) > 80
    assert right / sum(r.secret for r in held) >= 0.95 and right / sum(r.id % 2 for r in held) >= 0.95


def test_secrets_from_given_labels(spark):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(400):
        key = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 32))
        name = "-".join(["release", "build", "version", str(i)])
        text = f"api_key: {key}" if i % 2 else f"download of {name} is there"
        rows.append((i, text, "src"))
        start = text.index(key if i % 2 else name)
        labels.append((i, start, start + len(key if i % 2 else name), i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = secrets.scan(docs, spark.createDataFrame(labels, "id long, start int, end int, label int")).collect()
    held = [r for r in found if zlib.crc32(str(r.id).encode()) % 5 == 0]
    assert len(found) == 400 and all(r.secret == bool(r.id % 2) for r in held)


def test_embeddings(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((300, 16))
    vectors = [c + rng.standard_normal(16) * 0.03 for c in centres for _ in range(4)] + [centres[0]] * 40
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0, 2.0]]
    odd_rows = [(9000 + i, v) for i, v in enumerate(odd)] + [(None, [1.0] * 16)]
    frame = spark.createDataFrame(rows + odd_rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in embeddings.near_duplicates(frame.repartition(5)).collect()}
    unit = np.array(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    counts = np.array([found[i].n_links for i in range(len(vectors))])
    assert (counts <= near.sum(axis=1)).all() and counts.sum() >= 0.98 * near.sum()
    least = grouped(list(range(len(vectors))), [(i, j) for i, j in zip(*np.nonzero(near)) if j < i])
    same = sum(found[i].component_id == least[i] for i in range(len(vectors)))
    assert same >= 0.98 * len(vectors) and found[0].n_links >= 40
    for i in range(len(odd)):
        assert (found[9000 + i].n_links, found[9000 + i].component_id, found[9000 + i].kept) == (0, 9000 + i, True)
    assert len(found) == len(vectors) + len(odd) + 1 and found[None].n_links == 0
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_embeddings_in_parts(spark, monkeypatch):
    """A dense group cut into small parts gives the same links, each counted once."""
    monkeypatch.setattr(embeddings, "GROUP", 32)
    rng = np.random.default_rng(6)
    vectors = np.vstack([np.ones(8) + rng.standard_normal((150, 8)) * 0.1, rng.standard_normal((100, 8))])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in embeddings.near_duplicates(frame).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    counts = np.array([found[i] for i in range(len(vectors))])
    assert (counts <= near).all() and counts.sum() >= 0.98 * near.sum()


def plain_verdict(url, rules):
    head = (url or "").split("://", 1)
    rest = head[1] if len(head) == 2 else ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0] if len(head) == 2 else ""
    host = host.translate({i: i + 32 for i in range(65, 91)})
    fit = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


URLS = [
    "http://a.NET/x", "https://example.net/en/1", "https://x.example.net/en", "https://example.net?en/", "http://net/",
    "http://notnet/", "http://x.org/fr/é?q#f", "http://example.com/de/", "http://EXAMPLE.com/de", "no url", "", None,
    "a://b://c.net/d", "http://user@x.net:80/", "http://.net/", "http://x.net./", "://example.net/en/#/x", "http://x.net#/en/",
    "http://É.NET/a", "HTTP://a.b.c.d.example.com/de/x/y", "http://x.net\n/en/",
]


def test_urls(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
             ("x.net", "/en", "block"), ("x.net", "/en", "allow"), ("c.d.example.com", "", "allow"), ("b", "", "block")]
    listed = spark.createDataFrame([*rules, (None, "/", "block"), ("org", "/", None)], "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS + URLS)], "page_id long, url string, host string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, listed).collect()}
    assert found == {i: plain_verdict(u, rules) for i, u in enumerate(URLS + URLS)}
    assert {r.verdict for r in urls.judge(pages, listed.limit(0), default="block").collect()} == {"block"}
    assert urls.judge(pages.limit(0), listed).count() == 0


def test_lm_gradients_are_those_of_plain_sums():
    """Each token's and class's gradient against sums over single positions; neighbours stay numbers of two bytes."""
    rng = np.random.default_rng(1)
    net = {k: v.astype(np.float64) for k, v in masked_lm.initial().items()}
    codes = rng.integers(0, 40, 300).astype(np.int16)
    at = np.arange(masked_lm.SIDE, len(codes) - masked_lm.SIDE)
    around, token = masked_lm._around(codes, at), codes[at].astype(np.int64)
    assert around.dtype == np.int16
    together = masked_lm.gradients(net, around, token)
    alone = [masked_lm.gradients(net, around[i : i + 1], token[i : i + 1]) for i in range(len(token))]
    for name, found in together.items():
        assert np.allclose(found, sum(g[name] for g in alone) / len(token), atol=1e-12), name


def test_lm_shapes():
    words = [b"ab", b"a1", b"a.", b"a/", b"a:", b"\xc3\xa9", b"1.", b"x" * 40]
    assert [(masked_lm.shape(w) - masked_lm.WORDS) % 4 for w in words] == [0, 1, 2, 2, 3, 3, 1, 0]
