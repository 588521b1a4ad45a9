"""Documents scored by masked pseudo-likelihood: a small network predicts every token from both sides."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from dqspark.llm.common import mapped, quoted, texts
from dqspark.session import stored

#: Words of the vocabulary, and tokens of one class in the two steps of the output (class, then token).
WORDS, CLASS = 992, 32
#: Tokens that stand for words outside the vocabulary, by length and kind of signs; one for the ends of a text.
SHAPES, EDGE = 32, WORDS + 32
#: Tokens on either side, numbers of a token's embedding, and of the hidden layer.
SIDE, EMBEDDED, HIDDEN = 2, 16, 32
#: Positions of a training step and of a scoring batch, and training rounds: each position is predicted in one of them.
STEP, BATCH, ROUNDS = 4096, 4096, 2
RATE, CHUNK, FAN = 0.1, 4096, 64
#: Different words after which a task ends a chunk of texts, and the place of texts behind the words of their chunk.
HELD, LAST = 400_000, (1 << 31) - 1
NUMBERED = "chunk at id codes word n shape".split()


def words(text: bytes) -> list[bytes]:
    return text.lower().split()


def shape(word: bytes) -> int:
    """The token of a word outside the vocabulary: of eight lengths, and four kinds of signs."""
    kind = 0 if word.isalpha() else 1 if word.translate(None, b"0123456789") != word else 2 if min(word) < 48 else 3
    return WORDS + min(len(word) - 1, 15) // 2 * 4 + kind


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in chunks: first a chunk's words, a row each with its number and count, then its texts as such numbers."""
    places: defaultdict[bytes, int] = defaultdict()
    places.default_factory = places.__len__
    ids: list[pa.Array] = []
    codes: list[np.ndarray] = []
    chunk = TaskContext.get().partitionId() << 32

    def out() -> Iterator[pa.RecordBatch]:
        n, own = len(places), pa.concat_arrays(ids)
        counts = np.bincount(np.concatenate(codes), minlength=n)
        at, kinds = np.arange(n, dtype=np.int32), np.fromiter(map(shape, places), np.int16, n)
        of_words = [np.full(n, chunk), at, pa.nulls(n, own.type), pa.nulls(n, pa.binary()), pa.array(places, pa.binary()), counts, kinds]
        planes = pa.array([_planes(c, n) for c in codes], pa.binary())
        rest = [pa.nulls(len(own), kind) for kind in (pa.binary(), pa.int64(), pa.int16())]
        of_texts = [np.full(len(own), chunk), np.full(len(own), LAST, dtype=np.int32), own, planes, *rest]
        for columns in (of_words, of_texts):
            yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=NUMBERED)

    for batch in batches:
        first = 0
        for i, text in enumerate(texts(batch["text"])):
            own = words(text)
            codes.append(np.fromiter(map(places.__getitem__, own), np.int32, len(own)))
            if len(places) > HELD:
                ids.append(batch["id"].slice(first, i + 1 - first))
                yield from out()
                places.clear()
                ids, codes, first, chunk = [], [], i + 1, chunk + 1
        ids.append(batch["id"].slice(first))
    if codes:
        yield from out()


def _planes(codes: np.ndarray, n: int) -> bytes:
    """Numbers below ``n`` as bytes: all lowest bytes, then the next, as many as ``n`` needs; the high ones compress well."""
    return codes.astype("<i4").view(np.uint8).reshape(-1, 4)[:, : -(-max(1, n.bit_length()) // 8)].T.tobytes()


def _from_planes(value: np.ndarray, n: int) -> np.ndarray:
    planes = value.reshape(-(-max(1, n.bit_length()) // 8), -1)
    full = np.zeros((planes.shape[1], 4), dtype=np.uint8)
    full[:, : len(planes)] = planes.T
    return full.view("<i4")[:, 0]


def _tokens(known: dict[bytes, int], shapes: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as tokens, and the sum of log P(word | shape) of their words outside the vocabulary.

    Rows come sorted: a chunk's words in their order, each with its shape and its count in all documents (the commonest
    also with the word itself), then the chunk's texts.
    """
    at, tokens, rare = None, np.zeros(0, dtype=np.int16), np.zeros(0)
    for batch in batches:
        chunks, texts_ = batch["chunk"].to_numpy(), batch["at"].to_numpy() == LAST
        starts = np.flatnonzero(np.append(True, (chunks[1:] != chunks[:-1]) | (texts_[1:] != texts_[:-1])))
        for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), len(chunks)]):
            part = batch.slice(begin, end - begin)
            if chunks[begin] != at:
                at, tokens, rare = chunks[begin], tokens[:0], rare[:0]
            if not texts_[begin]:
                found, logs = part["shape"].to_numpy().copy(), np.zeros(part.num_rows)
                for i in np.flatnonzero(part["word"].is_valid().to_numpy(zero_copy_only=False)).tolist():
                    found[i] = known.get(part["word"][i].as_py(), found[i])
                outside = found >= WORDS
                logs[outside] = np.log(part["n"].to_numpy()[outside] / shapes[found[outside] - WORDS])
                tokens, rare = np.append(tokens, found), np.append(rare, logs)
                continue
            codes = [_from_planes(np.frombuffer(v.as_buffer(), dtype=np.uint8), len(tokens)) for v in part["codes"]]
            yield pa.RecordBatch.from_arrays(
                [part["id"], pa.array([tokens[c].tobytes() for c in codes], pa.binary()), pa.array([rare[c].sum() for c in codes])],
                names=["id", "codes", "rare"],
            )


def encode(rows: DataFrame) -> DataFrame:
    """``(id, codes, rare)`` per row: its words as tokens, and the sum of log P(word | shape) of those outside the vocabulary.

    The vocabulary is the ``WORDS`` commonest words of all texts. All words are counted, over all documents; that table
    grows with the input and stays with Spark: the counts return to the chunks of texts that have the word, at most
    a row for each word of a chunk. The driver gets the vocabulary, and how often words outside it have each shape.
    """
    kind = dict(rows.dtypes)["id"]
    schema = f"chunk long, at int, id {kind}, codes binary, word binary, n long, shape short"
    numbered = stored(mapped(rows, _numbered, schema), "words")
    of_word = Window.partitionBy("word")
    first = (F.col("chunk") == F.min("chunk").over(of_word)).alias("first")
    own = numbered.filter("word IS NOT NULL").select("chunk", "at", "word", "shape", F.sum("n").over(of_word).alias("n"), first)
    counted = stored(own, "counted")
    every = counted.filter("first")
    top = every.select("word", "n", "shape").orderBy(F.desc("n"), "word").limit(WORDS).collect()
    known, shapes = {bytes(r["word"]): i for i, r in enumerate(top)}, np.zeros(SHAPES)
    for r in every.groupBy("shape").agg(F.sum("n").alias("n")).collect():
        shapes[r["shape"] - WORDS] = r["n"]
    for r in top:
        shapes[r["shape"] - WORDS] -= r["n"]
    common = F.when(F.col("n") >= min((r["n"] for r in top), default=0), F.col("word")).alias("word")
    texts_ = numbered.select("chunk", "at", "id", "codes").filter("codes IS NOT NULL")
    both = texts_.unionByName(counted.select("chunk", "at", common, "n", "shape"), allowMissingColumns=True)
    dealt = both.repartition("chunk").sortWithinPartitions("chunk", "at")
    return stored(mapped(dealt, partial(_tokens, known, shapes), f"id {kind}, codes binary, rare double"), "tokens")


SIZES = {
    "embed": (EDGE + 1, EMBEDDED),
    "inner": (2 * SIDE * EMBEDDED, HIDDEN),
    "bias": (HIDDEN,),
    "classes": (HIDDEN, EDGE // CLASS),
    "class_bias": (EDGE // CLASS,),
    "tokens": (EDGE // CLASS, HIDDEN, CLASS),
    "token_bias": (EDGE // CLASS, CLASS),
}


def initial(seed: int = 4) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {
        name: (rng.standard_normal(size) * (0 if "bias" in name else size[-2] ** -0.5 if name != "embed" else 0.3)).astype(
            np.float32
        )
        for name, size in SIZES.items()
    }


def _sums(x: np.ndarray) -> np.ndarray:
    """Of each row: a product is faster than a sum over rows as short as these."""
    return x @ np.ones(x.shape[1], x.dtype)


def _softmax(x: np.ndarray) -> np.ndarray:
    """Rows of ``x`` in place as probabilities."""
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= _sums(x)[:, None]
    return x


def _log_softmax_at(x: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The log-probability of one place in each row of ``x``, which is used up."""
    x -= x.max(axis=1, keepdims=True)
    found = x[np.arange(len(x)), place]
    return found - np.log(_sums(np.exp(x, out=x)))


def _hidden(net: dict[str, np.ndarray], around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    seen = net["embed"].take(around, axis=0).reshape(len(around), -1)
    hidden = seen @ net["inner"]
    hidden += net["bias"]
    return seen, np.tanh(hidden, out=hidden)


def _by_class(token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, slice]]]:
    """An order of the tokens by class; their classes and places in these, so ordered; and the rows of each class met."""
    group, member = np.divmod(token, CLASS)
    order = np.argsort(group.astype(np.uint8), kind="stable")
    group = group[order]
    bounds = np.searchsorted(group, np.arange(EDGE // CLASS + 1)).tolist()
    met = [(g, slice(begin, end)) for g, (begin, end) in enumerate(zip(bounds, bounds[1:])) if begin < end]
    return order, group, member[order], met


def _inside(net: dict[str, np.ndarray], hidden: np.ndarray, group: np.ndarray, met: list[tuple[int, slice]]) -> np.ndarray:
    """What the softmax over the tokens of each row's class is made from."""
    scores = net["token_bias"].take(group, axis=0)
    for g, rows in met:
        scores[rows] += hidden[rows] @ net["tokens"][g]
    return scores


def log_probabilities(net: dict[str, np.ndarray], around: np.ndarray, token: np.ndarray) -> np.ndarray:
    """log P(token | the tokens around it): of its class, and of itself in the class."""
    order, group, member, met = _by_class(token)
    _, hidden = _hidden(net, around[order])
    found = _log_softmax_at(hidden @ net["classes"] + net["class_bias"], group)
    found += _log_softmax_at(_inside(net, hidden, group, met), member)
    back = np.empty_like(found)
    back[order] = found
    return back


def gradients(net: dict[str, np.ndarray], around: np.ndarray, token: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean negative log-probability, by backpropagation."""
    n, each = len(token), np.arange(len(token))
    grads = {name: np.zeros_like(net[name]) for name in ("embed", "tokens", "token_bias")}
    order, group, member, met = _by_class(token)
    around = around[order]
    seen, hidden = _hidden(net, around)
    error = _softmax(hidden @ net["classes"] + net["class_bias"])
    error[each, group] -= 1
    error /= n
    grads["classes"], grads["class_bias"] = hidden.T @ error, error.sum(axis=0)
    back = error @ net["classes"].T
    error = _softmax(_inside(net, hidden, group, met))
    error[each, member] -= 1
    error /= n
    for g, rows in met:
        grads["tokens"][g] = hidden[rows].T @ error[rows]
        back[rows] += error[rows] @ net["tokens"][g].T
    grads["token_bias"][[g for g, _ in met]] = np.add.reduceat(error, [rows.start for _, rows in met], axis=0)
    back *= 1 - hidden * hidden
    grads["inner"], grads["bias"] = seen.T @ back, back.sum(axis=0)
    # Each place's share goes to the token there: places are sorted by token, and a token's places added up.
    places = around.ravel()
    sort = np.argsort(places.astype(np.int16), kind="stable")
    places = places[sort]
    first = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
    shares = (back @ net["inner"].T).reshape(-1, EMBEDDED).take(sort, axis=0)
    grads["embed"][places[first]] = np.add.reduceat(shares, first, axis=0)
    return grads


def _around(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The tokens on both sides of positions in a padded sequence."""
    return codes[at[:, None] + np.array([o for o in range(-SIDE, SIDE + 1) if o])]


def _sequences(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Texts on end, ``SIDE`` edge tokens after each, some 100,000 tokens at a time: tokens, lengths, first row."""
    edge, held, first = np.full(SIDE, EDGE, dtype=np.int16), [], 0
    for i, value in enumerate(batch["codes"]):
        held.append(np.frombuffer(value.as_buffer(), dtype=np.int16))
        if sum(map(len, held)) > 100_000 or i == batch.num_rows - 1:
            padded = np.concatenate([edge, *[x for own in held for x in (own, edge)]])
            yield padded, np.array([len(own) for own in held]), first
            first, held = i + 1, []


def _train(
    net: dict[str, np.ndarray], round_: int, rounds: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """One task's training: from the common weights, over this round's positions of all its texts; then its weights.

    A text's first position is the first round's, the next one the second's and so on, so the rounds miss none.
    """
    net = {name: value.copy() for name, value in net.items()}
    squares = {name: np.full_like(value, 1e-6) for name, value in net.items()}
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    steps, seen, rng = 0, 0, np.random.default_rng([4, round_])

    def learn(least: int) -> None:
        nonlocal steps, waiting
        around, token = (np.concatenate(x) for x in zip(*waiting))
        order = rng.permutation(len(token))
        end = len(order) - len(order) % STEP if least else len(order)
        for begin in range(0, end, STEP):
            rows = order[begin : begin + STEP]
            for name, gradient in gradients(net, around[rows], token[rows]).items():
                squares[name] += gradient * gradient
                net[name] -= RATE * gradient / np.sqrt(squares[name])
            steps += 1
        waiting = [(around[order[end:]], token[order[end:]])]

    for batch in batches:
        for codes, lengths, _ in _sequences(batch):
            place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            at = np.flatnonzero(codes != EDGE)[place % rounds == round_]
            waiting.append((_around(codes, at), codes[at].astype(np.int64)))
            seen += len(at)
            if sum(len(t) for _, t in waiting) > 8 * STEP:
                learn(STEP)
    if waiting:
        learn(0)
    flat = np.concatenate([net[name].ravel() for name in SIZES]).astype(np.float64) * seen
    parts = np.array_split(flat, -(-len(flat) // CHUNK))
    if seen:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(len(parts), dtype=np.int32)),
                pa.array(np.full(len(parts), TaskContext.get().partitionId(), dtype=np.int64)),
                pa.array(np.full(len(parts), seen, dtype=np.int64)),
                pa.array([p.tobytes() for p in parts], pa.binary()),
            ],
            names=["chunk", "task", "n", "weights"],
        )


def _sum(table: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(v.as_buffer(), dtype=np.float64) for v in table["weights"]], axis=0)
    n, task = sum(table["n"].to_pylist()), min(table["task"].to_pylist())
    return pa.table(
        {
            "chunk": table["chunk"].slice(0, 1),
            "task": pa.array([task // FAN], pa.int64()),
            "n": pa.array([n], pa.int64()),
            "weights": pa.array([total.tobytes()], pa.binary()),
        }
    )


def train(encoded: DataFrame, seed: int = 4, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Train over all texts: in a round each task starts from the common weights, and the results are averaged.

    In the rounds together each task predicts every position of its own part once. Weights
    meet by number of positions, in pieces, along a tree: no group sums over ``FAN`` tasks' pieces in its first steps.
    The driver gets one set of weights a round, whose size is fixed.
    """
    net = initial(seed)
    schema = "chunk int, task long, n long, weights binary"
    for round_ in range(rounds):
        parts = mapped(encoded.select("codes"), partial(_train, net, round_, rounds), schema)
        for _ in range(2):
            parts = parts.groupBy("chunk", F.floor(F.col("task") / FAN).alias("branch")).applyInArrow(_sum, schema)
        parts = parts.groupBy("chunk").applyInArrow(_sum, schema)
        found = sorted(parts.collect(), key=lambda r: r["chunk"])
        if not found:
            return net
        flat = np.concatenate([np.frombuffer(bytes(r["weights"]), dtype=np.float64) / r["n"] for r in found])
        ends = np.cumsum([int(np.prod(size)) for size in SIZES.values()])
        pieces = np.split(flat.astype(np.float32), ends[:-1])
        net = {name: piece.reshape(size) for (name, size), piece in zip(SIZES.items(), pieces)}
    return net


def _score(net: dict[str, np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, tokens = np.zeros(batch.num_rows), np.zeros(batch.num_rows, dtype=np.int64)
        for codes, lengths, first in _sequences(batch):
            at = np.flatnonzero(codes != EDGE)
            found = np.empty(len(at))
            for begin in range(0, len(at), BATCH):
                own = at[begin : begin + BATCH]
                found[begin : begin + BATCH] = log_probabilities(net, _around(codes, own), codes[own].astype(np.int64))
            rows = np.repeat(np.arange(len(lengths)), lengths)
            total[first : first + len(lengths)] = np.bincount(rows, found, len(lengths))
            tokens[first : first + len(lengths)] = lengths
        total += batch["rare"].to_numpy()
        mean = pa.array(np.divide(total, tokens, out=np.zeros(len(total)), where=tokens > 0), mask=tokens == 0)
        yield pa.RecordBatch.from_arrays(
            [batch["id"], pa.array(tokens), pa.array(total), mean], names=["id", "tokens", "log_likelihood", "mean"]
        )


def scores(docs: DataFrame, id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``(id, tokens, log_likelihood, mean)`` per document: the sum of log P(token | both sides), and its mean.

    Tokens are words, A-Z as a-z. The network predicts the commonest of all documents themselves, of others the shape;
    for those P(token) is P(shape | both sides) P(word | shape), the latter by the counts of all words of all documents.
    So the probabilities of all words of the documents add up to 1. The vocabulary, the counts and the network are
    learnt from all documents, then every token of every document is predicted from its neighbours.

    Null and empty texts have no tokens, a sum of 0 and a null mean. Null ids are kept; repeated rows score alike. Other
    columns are left out. No rows give none.
    """
    rows = docs.select(quoted(id).alias("id"), quoted(text).alias("text"))
    kind = dict(rows.dtypes)["id"]
    encoded = encode(rows)
    net = train(encoded, rounds=rounds)
    return mapped(encoded, partial(_score, net), f"id {kind}, tokens long, log_likelihood double, mean double")
