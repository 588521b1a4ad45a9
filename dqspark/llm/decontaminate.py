"""Benchmark passages in documents: latent semantic retrieval, then common subsequences and answer words."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dqspark.llm.common import Rows, mapped, quoted, texts
from dqspark.session import stored

#: Words of a benchmark passage at most. A document's windows have twice as many and begin at every such number
#: of words, so that any passage lies in one of them whole.
PASSAGE = 16
#: Dimensions of the latent space at least and for each doubling of the vocabulary, and how common a word may be to count.
RANK, DOUBLING, COMMON = 64, 16, 0.02
#: How many standard deviations under its mean the cosine of a planted passage may lie, and the cosine below which it tells
#: too little: passages that need less go by an index of rare words.
SPREADS, FLOOR = 3.0, 0.15
#: Share of a passage's words, in order, that makes a copy; and a paraphrase, if the answer words are there too.
COPY, PARAPHRASE, ANSWER = 0.8, 0.5, 5
#: Windows, and passages, that are compared at once; pairs of them that are counted at once; blocks that are added up at
#: once; and pairs of words that a task holds before it multiplies them out.
SLICE, PIECE, ADDED, HELD = 4096, 100_000, 2048, 4_000_000
#: Places of the membership table for each word of each passage, and the odd numbers that spread them.
PLACES, SPREAD = 32, (2654435761, 2246822519)

_KEEP = set(range(48, 58)) | set(range(97, 123)) | set(range(128, 256))
_WORDS = bytes(i if i in _KEEP else i + 32 if 65 <= i <= 90 else 32 for i in range(256))


def words(text: bytes) -> list[bytes]:
    """Runs of letters and digits, A-Z as a-z."""
    return text.translate(_WORDS).split()


def cut(items: list[bytes]) -> list[list[bytes]]:
    """An item's passages: pieces of ``PASSAGE`` words, the last moved back so that none is short if the item isn't."""
    if len(items) <= PASSAGE:
        return [items] if items else []
    starts = [*range(0, len(items) - PASSAGE, PASSAGE), len(items) - PASSAGE]
    return [items[s : s + PASSAGE] for s in starts]


@dataclass(frozen=True)
class Passages:
    """The benchmark: a code per word, and for each passage its item and codes."""

    vocabulary: dict[bytes, int]
    item: list
    codes: list[np.ndarray]


def passages(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> Passages:
    """The benchmark read to the driver: a set of questions whose size the user states, not one of documents."""
    found = benchmark.select(quoted(item).alias("item"), quoted(text).cast("binary").alias("text")).distinct().collect()
    vocabulary: dict[bytes, int] = {}
    items, codes = [], []
    for row in sorted(found, key=lambda r: (r["item"] is None, r["item"], r["text"] or b"")):
        for piece in cut(words(bytes(row["text"] or b""))):
            items.append(row["item"])
            codes.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in piece], dtype=np.int32))
    return Passages(vocabulary, items, codes)


def _encode(vocabulary: dict[bytes, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    of = vocabulary.get
    for batch in batches:
        codes = [np.array([of(w, -1) for w in words(t)], dtype=np.int32).tobytes() for t in texts(batch["text"])]
        yield pa.RecordBatch.from_arrays([batch["id"], batch["hash"], pa.array(codes, pa.binary())], names=["id", "hash", "codes"])


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of some documents on end, and where each begins, about 200,000 words at a time."""
    held, n = [], 0
    for value in batch["codes"]:
        held.append(np.frombuffer(value.as_buffer(), dtype=np.int32))
        n += len(held[-1])
        if n > 200_000:
            yield _on_end(held)
            held, n = [], 0
    if held:
        yield _on_end(held)


def _on_end(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(held), np.cumsum([0, *map(len, held)])


def _blocks(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents' blocks of ``PASSAGE`` words: a row of codes each, -1 after the end, and its document."""
    n = -(-np.diff(ends) // PASSAGE)
    document = np.repeat(np.arange(len(n)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    places = (ends[:-1][document] + at * PASSAGE)[:, None] + np.arange(PASSAGE)
    inside = places < ends[1:][document][:, None]
    return np.where(inside, codes[np.minimum(places, max(0, len(codes) - 1))], -1), document


def _frequencies(n_words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many blocks each word is, and the number of blocks as one word more."""
    counts = np.zeros(n_words + 1, dtype=np.int64)
    for batch in batches:
        for codes, ends in _documents(batch):
            blocks = np.sort(_blocks(codes, ends)[0], axis=1)
            once = blocks >= 0
            once[:, 1:] &= blocks[:, 1:] != blocks[:, :-1]
            counts[:-1] += np.bincount(blocks[once], minlength=n_words)
            counts[-1] += len(blocks)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["code", "n"])


def _block_sums(blocks: np.ndarray, weighted: np.ndarray) -> np.ndarray:
    """Each block's words' rows of ``weighted`` added up, but rows of zeros, such as the last, for -1."""
    sums, heavy = np.zeros((len(blocks), weighted.shape[1]), dtype=np.float32), weighted.any(axis=1)
    for begin in range(0, len(blocks), ADDED):
        piece = blocks[begin : begin + ADDED]
        light = ~heavy[piece]
        n = piece.shape[1] - light.sum(axis=1)
        order = np.argsort(-n, kind="stable")
        firsts = np.take_along_axis(piece, np.argsort(light, axis=1, kind="stable"), axis=1)[order]
        own = np.zeros((len(piece), weighted.shape[1]), dtype=np.float32)
        for place, rows in enumerate(np.searchsorted(-n[order], -np.arange(n.max(initial=0)))):
            own[:rows] += weighted[firsts[:rows, place]]
        sums[begin + order] = own
    return sums


def _power(weighted: np.ndarray, idf: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """This task's part of A'A W for TF-IDF passages A: a row per word, one number for each column of the sketch.

    A'A is counted first: how often two words with weight are in a block together. Of these pairs a task holds ``HELD`` or
    somewhat more, and multiplies them out a few words at a time.
    """
    total = np.zeros((len(idf), weighted.shape[1]), dtype=np.float64)
    heavy, counted, n = np.append(idf != 0, False), [], 0
    for batch in batches:
        for codes, ends in _documents(batch):
            counted.append(_together(_blocks(codes, ends)[0], heavy, len(idf)))
            n += len(counted[-1][0])
            if n > HELD:
                counted = [_merged(counted)]
                n = len(counted[0][0])
            if n > HELD / 2 and len(counted) == 1:
                _multiply(total, weighted, *counted[0])
                counted, n = [], 0
    if counted:
        _multiply(total, weighted, *_merged(counted))
    seen = np.flatnonzero(total.any(axis=1))
    rows = pa.array(list(total[seen] * idf[seen, None]), pa.list_(pa.float64()))
    yield pa.RecordBatch.from_arrays([pa.array(seen), rows], names=["code", "row"])


def _together(blocks: np.ndarray, heavy: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the blocks' words with weight, as one number each, and how often a block has them; with itself a word too."""
    block, place = np.nonzero(heavy[blocks])
    code = blocks[block, place].astype(np.int64)
    size = np.bincount(block, minlength=len(blocks))
    others = size[block]
    nth = np.arange(others.sum()) - np.repeat(np.cumsum(others) - others, others)
    other = code[np.repeat((np.cumsum(size) - size)[block], others) + nth]
    return np.unique(np.repeat(code, others) * n_words + other, return_counts=True)


def _merged(counted: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, at = np.unique(np.concatenate([p for p, _ in counted]), return_inverse=True)
    return pairs, np.bincount(at, np.concatenate([n for _, n in counted]), len(pairs)).astype(np.int64)


def _multiply(total: np.ndarray, weighted: np.ndarray, pairs: np.ndarray, n: np.ndarray) -> None:
    """Add to each word's row of ``total`` the rows of ``weighted`` of the words beside it, as often as they are."""
    code, other = np.divmod(pairs, len(total))
    for first in range(0, len(total), ADDED // 4):
        begin, end = np.searchsorted(code, [first, first + ADDED // 4])
        if begin < end:
            rows, row = np.unique(code[begin:end], return_inverse=True)
            beside, column = np.unique(other[begin:end], return_inverse=True)
            dense = np.zeros((len(rows), len(beside)), dtype=np.float32)
            dense[row, column] = n[begin:end]
            total[rows] += dense @ weighted[beside]


def latent_space(encoded: DataFrame, known: Passages, rank: int | None = None, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Inverse block frequencies of the words, and weighted coordinates of the words in the latent space.

    The matrix A has a row for each block of the documents and a column for each word of the benchmark; no
    other word can be common to both. Its frequencies, and the randomised SVD, are taken over all blocks: a
    random sketch W of the words goes out, each task adds up its part of A'A W, Spark sums the parts word by
    word, and the orthonormal basis of the sum spans the main right singular vectors (one power iteration). Cosines
    do not depend on which basis of that space is used. A word's coordinates are brought to length one before they are weighted:
    rare words have next to none in the main directions, and passages are told apart by rare words. The space has ``DOUBLING`` dimensions for each doubling of the
    vocabulary, unless ``rank`` is given. What is gathered has the size of the benchmark's vocabulary.
    """
    n_words = len(known.vocabulary)
    rank = max(RANK, DOUBLING * n_words.bit_length()) if rank is None else rank
    counted = mapped(encoded.select("codes"), partial(_frequencies, n_words), "code long, n long")
    counts = np.zeros(n_words + 1)
    for row in counted.groupBy("code").agg(F.sum("n").alias("n")).collect():
        counts[row["code"]] = row["n"]
    idf = np.log((counts[-1] + 1) / (counts[:-1] + 1))
    idf[counts[:-1] > COMMON * max(1, counts[-1])] = 0
    rank = min(rank, n_words)
    sketch = np.random.default_rng(seed).standard_normal((n_words, rank))
    if idf.any():
        weighted = _weighted(sketch, idf)
        total = _added_up(encoded, partial(_power, weighted, idf), n_words, rank)
        sketch = total if total.any() else sketch
    basis = _unit(np.linalg.qr(sketch)[0])
    return idf, _weighted(basis, idf)


def _weighted(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of words by their weight, and a row of zeros for words the benchmark does not have."""
    return np.vstack([rows * idf[:, None], np.zeros((1, rows.shape[1]))]).astype(np.float32)


def _added_up(encoded: DataFrame, part: Callable, n_rows: int, n_columns: int) -> np.ndarray:
    """The matrix whose rows are the sums of the rows of that number which the tasks give."""
    parts = mapped(encoded.select("codes"), part, "code long, row array<double>")
    sums = [F.sum(F.col("row")[i]).alias(f"r{i}") for i in range(n_columns)]
    total = np.zeros((n_rows, n_columns))
    for row in parts.groupBy("code").agg(F.array(*sums).alias("row")).collect():
        total[row["code"]] = row["row"]
    return total


def _windows(codes: np.ndarray, ends: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The documents' windows, a block and the next one: a row of codes each, its words' sum in the space, its document."""
    blocks, document = _blocks(codes, ends)
    follows = np.append(document[1:] == document[:-1], False) if len(document) else np.zeros(0, dtype=bool)
    own, after = _block_sums(blocks, space), np.full_like(blocks, -1)
    sums = own.copy()
    sums[follows] += own[1:][follows[:-1]]
    after[follows] = blocks[1:][follows[:-1]]
    return np.hstack([blocks, after]), sums, document


def _moments(space: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Products of the windows' places in the space, one, and their squared length, each with each, added up."""
    total = np.zeros((space.shape[1] + 2, space.shape[1] + 2))
    for batch in batches:
        for codes, ends in _documents(batch):
            _, sums, _ = _windows(codes, ends, space)
            lengths = np.einsum("ij,ij->i", sums, sums)
            for begin in range(0, len(sums), SLICE):
                own, length = sums[begin : begin + SLICE], lengths[begin : begin + SLICE].astype(np.float64)
                total[:-2, :-2] += own.T @ own
                total[-2, :-2] += own.sum(axis=0, dtype=np.float64)
                total[-2, -2] += len(own)
                total[-1, -2] += length.sum()
                total[-1, -1] += length @ length
    rows = pa.array(list(total), pa.list_(pa.float64()))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), rows], names=["code", "row"])


@dataclass(frozen=True)
class Windows:
    """All windows of all documents in the latent space: mean place, how places spread, and squared lengths."""

    mean: np.ndarray
    spread: np.ndarray
    length: float
    length_spread: float


def all_windows(encoded: DataFrame, space: np.ndarray) -> Windows:
    """Moments over every window of every document; what the driver gets has the size of the space squared."""
    size = space.shape[1] + 2
    total = _added_up(encoded, partial(_moments, space), size, size)
    total /= max(1.0, total[-2, -2])
    mean, length = total[-2, :-2], total[-1, -2]
    spread = total[:-2, :-2] - np.outer(mean, mean)
    return Windows(mean, spread, length, total[-1, -1] - length**2)


def _kinds(codes: np.ndarray, idf: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """The least that counts as a leak: places that it has in any case, and how many it has; whole, copy, paraphrase."""
    size, none = len(codes), np.zeros(0, dtype=np.int64)
    yield none, size
    yield none, next(k for k in range(size + 1) if k / size >= COPY)
    first = np.array([np.flatnonzero(codes == a)[0] for a in np.unique(_answers(codes, idf))])
    yield first, max(len(first), next(k for k in range(size + 1) if k / size >= PARAPHRASE))


def _keeping(codes: np.ndarray, idf: np.ndarray, n: int, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """Which of a passage's words each of ``n`` plants has: all, those of the least copy, those of the least paraphrase."""
    for always, kept in _kinds(codes, idf):
        chance = rng.random((n, len(codes)))
        chance[:, always] -= 1
        yield chance.argsort(axis=1).argsort(axis=1) < kept


def _least_cosine(codes: np.ndarray, idf: np.ndarray, space: np.ndarray, hosts: Windows) -> float:
    """The least cosine expected of a passage that is planted in a window, over the kinds of leaks.

    Of the plant's words some are the passage's, which of them is chance, and the rest a window's, as many as a window
    has beside them. What the words add along the passage, and the plant's squared length, have their mean and spread from
    the passage's words and from ``hosts``; either is taken ``SPREADS`` standard deviations to the bad.
    """
    vectors = space[codes].astype(np.float64)
    query = _unit(vectors.sum(axis=0, keepdims=True))[0]
    found = []
    for always, kept in _kinds(codes, idf):
        loose = np.delete(vectors, always, axis=0)
        drawn, n = kept - len(always), len(loose)
        own = vectors[always].sum(axis=0) + (drawn / n * loose.sum(axis=0) if n else 0)
        apart = loose - loose.mean(axis=0) if n else loose
        chance = drawn * (n - drawn) / (n * (n - 1)) if n > 1 else 0.0
        share = 1 - kept / (2 * PASSAGE)
        along = query @ (own + share * hosts.mean)
        along_spread = chance * ((apart @ query) ** 2).sum() + share * (query @ hosts.spread @ query)
        length = own @ own + chance * (apart * apart).sum() + 2 * share * own @ hosts.mean + share * hosts.length
        length_spread = 4 * chance * ((apart @ own) ** 2).sum() + share * (4 * own @ hosts.spread @ own + hosts.length_spread)
        least, most = along - SPREADS * max(0.0, along_spread) ** 0.5, length + SPREADS * max(0.0, length_spread) ** 0.5
        found.append(least / max(most, 1e-12) ** 0.5)
    return max(0.0, min(found))


def _needed(
    codes_of: list[np.ndarray], idf: np.ndarray, space: np.ndarray, hosts: Windows, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        least = [_least_cosine(codes_of[number], idf, space, hosts) for number in batch["id"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(least, pa.float64())], names=["id", "least"])


def needed_cosines(encoded: DataFrame, known: Passages, idf: np.ndarray, space: np.ndarray) -> np.ndarray:
    """For each passage the cosine that a leak of it has with next to no exception, by all windows of all documents.

    Planted in thought are the whole passage, the least copy and the least paraphrase that would count as leaks, so the
    cosine follows from the passage's own words, all documents' windows and the space. Nothing is drawn.
    """
    search = partial(_needed, known.codes, idf, space, all_windows(encoded, space))
    found = mapped(encoded.sparkSession.range(len(known.codes)), search, "id long, least double").collect()
    least = np.zeros(len(known.codes))
    for row in found:
        least[row["id"]] = row["least"]
    return least


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a machine word's bits at a time."""
    places: dict[int, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    row = mask = (1 << len(a)) - 1
    for word in b:
        if here := places.get(word):
            match = row & here
            row = ((row + match) | (row - match)) & mask
    return len(a) - row.bit_count()


def _answers(codes: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The rarest words of a passage; the rarest again where it has fewer."""
    own = np.unique(codes)
    rarest = own[np.argsort(-idf[own], kind="stable")[:ANSWER]]
    return np.append(rarest, np.full(ANSWER - len(rarest), rarest[0]))


def _marks(codes: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Words of a passage of which every leak has one: the rarest, one place more than a copy may lack.

    A paraphrase has the rarest word, as that is one of the answer's.
    """
    least = next(n for n in range(len(codes) + 1) if n / len(codes) >= COPY)
    places = np.argsort(-idf[codes], kind="stable")[: len(codes) - least + 1]
    return np.unique(np.append(codes[places], _answers(codes, idf)[0]))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _search(
    codes_of: list[np.ndarray],
    idf: np.ndarray,
    space: np.ndarray,
    batches: Iterator[pa.RecordBatch],
    least: np.ndarray | None = None,
) -> Iterator[pa.RecordBatch]:
    """For each document the passages found in it, with the share of their words in order.

    Compared are pairs whose latent cosine is what the passage needs (``least``). Passages that need less than ``FLOOR``, and
    all where ``least`` is not given, are compared with every window that has one of their marks, as every leak has.
    No subsequence is longer than the number of a window's words that the passage has, which spares most of the
    work: a table of hashed places bounds that number from above, then it is counted. What a task holds is in
    proportion to the benchmark's words.
    """
    sizes, lists = np.array([len(c) for c in codes_of]), [c.tolist() for c in codes_of]
    queries = _unit(np.array([space[c].sum(axis=0) for c in codes_of], dtype=np.float32))
    padded = np.array([np.append(c, np.full(PASSAGE - len(c), -2)) for c in codes_of], dtype=np.int32)
    places = int(PLACES * sizes.sum() - 1).bit_length()
    of_passage, of_code = (np.arange(n, dtype=np.uint32) * np.uint32(k) for n, k in zip((len(sizes), len(space)), SPREAD))
    holds, right = np.zeros(1 << places, dtype=bool), np.uint32(32 - places)
    for i, c in enumerate(codes_of):
        holds[(of_passage[i] ^ of_code[c]) >> right] = True
    answers = np.array([_answers(c, idf) for c in codes_of])
    least = np.zeros(len(sizes)) if least is None else least
    indexed = least < FLOOR
    least = np.where(indexed, np.inf, least).astype(np.float32)
    marks = [_marks(c, idf) if own else c[:0] for c, own in zip(codes_of, indexed)]
    marked, n_marks = np.concatenate(marks), np.array([len(m) for m in marks])
    order = np.argsort(marked, kind="stable")
    marks_of = np.repeat(np.arange(len(marks)), n_marks)[order]  # by word: the passages it marks
    mark_starts = np.searchsorted(marked[order], np.arange(len(space) + 1))
    mark_counts = np.append(np.diff(mark_starts)[:-1], 0)  # the last, for -1, marks nothing

    def by_cosine(unit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for first in range(0, len(sizes), SLICE):
            close = unit @ queries[first : first + SLICE].T >= least[first : first + SLICE]
            window, passage = np.divmod(np.flatnonzero(close), close.shape[1])
            for begin in range(0, len(window), PIECE):
                yield window[begin : begin + PIECE], passage[begin : begin + PIECE] + first

    def by_mark(windows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        at, place = np.nonzero(mark_counts[windows])
        code = windows[at, place]
        n = mark_counts[code]
        total = np.cumsum(n)
        cuts = np.unique(np.append(np.searchsorted(total, np.arange(0, total[-1] if len(n) else 0, PIECE)), len(n)))
        for begin, end in zip(cuts[:-1], cuts[1:]):
            own = n[begin:end]
            nth = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            passage = marks_of[np.repeat(mark_starts[code[begin:end]], own) + nth]
            yield np.divmod(np.unique(np.repeat(at[begin:end], own) * len(sizes) + passage), len(sizes))

    def candidates(windows: np.ndarray, sums: np.ndarray) -> Iterator[tuple[int, int, bool]]:
        spread, inside = of_code[windows], windows >= 0
        for w, p in chain(by_cosine(_unit(sums)), by_mark(windows)):
            most = (holds[(of_passage[p][:, None] ^ spread[w]) >> right] & inside[w]).sum(axis=1)
            enough = most >= PARAPHRASE * sizes[p]
            yield from worth_comparing(windows, w[enough], p[enough])

    def worth_comparing(windows: np.ndarray, w: np.ndarray, p: np.ndarray) -> Iterator[tuple[int, int, bool]]:
        shared = (windows[w][:, :, None] == padded[p][:, None, :]).any(axis=2).sum(axis=1)
        enough = shared >= PARAPHRASE * sizes[p]
        w, p, shared = w[enough], p[enough], shared[enough]
        answered = (windows[w][:, :, None] == answers[p][:, None, :]).any(axis=1).all(axis=1)
        worth = answered | (shared >= COPY * sizes[p])
        yield from zip(w[worth].tolist(), p[worth].tolist(), answered[worth].tolist())

    for batch in batches:
        base, best = 0, {}
        for codes, ends in _documents(batch):
            windows, sums, document = _windows(codes, ends, space)
            for begin in range(0, len(windows), SLICE):
                piece = windows[begin : begin + SLICE]
                for w, p, answered in candidates(piece, sums[begin : begin + SLICE]):
                    share = common_subsequence(lists[p], piece[w].tolist()) / len(lists[p])
                    if share >= COPY or answered and share >= PARAPHRASE:
                        key = (base + int(document[begin + w]), p)
                        best[key] = max(share, best.get(key, 0.0))
            base += len(ends) - 1
        own = batch.take(pa.array([d for d, _ in best], pa.int64()))
        found, shares = pa.array([p for _, p in best], pa.int32()), pa.array(list(best.values()), pa.float64())
        yield pa.RecordBatch.from_arrays([own["id"], own["hash"], found, shares], names=["id", "hash", "passage", "share"])


def leaks(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """``(id, hash, item_id, share)``: which documents hold which benchmark items; ``hash`` is that of the text.

    Items are cut into passages, documents into overlapping windows that can hold a passage whole. Windows that have with
    a passage the latent cosine it needs are candidates: what its least copies and paraphrases have in the documents'
    windows with next to no exception (``needed_cosines``). For passages that need less than ``FLOOR``, such as those of
    common or very few words, all windows with one of their rarest words are. A candidate is a leak if the longest common
    subsequence has ``COPY`` of the passage's words, or ``PARAPHRASE`` of them and its rarest words, its answer, are
    all there. ``share`` is the best of an item's passages. All windows of all documents are searched.

    The benchmark is the stated query set, held by each task; the documents go through once each for encoding,
    frequencies, sketch, windows' moments and search, and are shuffled never. Null and empty texts hold nothing; items without
    words, or with a null text, are held by nothing; null ids are ids like others; repeated rows give one row an
    item for each. An empty benchmark or no documents give no rows.
    """
    known = passages(benchmark, item)
    rows = docs.select(quoted(id).alias("id"), F.xxhash64(quoted(text)).alias("hash"), quoted(text).alias("text"))
    kind = dict(rows.dtypes)["id"]
    if not known.codes:
        kinds = dict(benchmark.dtypes)
        empty = rows.limit(0).select("id", "hash")
        return empty.withColumns({"item_id": F.lit(None).cast(kinds[item]), "share": F.lit(0.0)})
    encoded = stored(mapped(rows, partial(_encode, known.vocabulary), f"id {kind}, hash long, codes binary"), "codes")
    idf, space = latent_space(encoded, known)
    search = partial(_search, known.codes, idf, space, least=needed_cosines(encoded, known, idf, space))
    found = mapped(encoded, search, f"id {kind}, hash long, passage int, share double")
    items = docs.sparkSession.createDataFrame(
        list(enumerate(known.item)), f"passage int, item_id {dict(benchmark.dtypes)[item]}"
    )
    return found.join(items, "passage").groupBy("id", "hash", "item_id").agg(F.max("share").alias("share"))


def clean(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """The documents that hold no benchmark item, with their own columns, whatever their names.

    Null and empty texts hold nothing and stay; rows that repeat an id and a text stay or go together; a null id is an id
    like others. Without documents there are no rows, without items all stay.
    """
    rows = Rows(docs)
    found = leaks(docs, benchmark, id, text, item).select("id", "hash").distinct()
    same = F.col(rows.of[id]).eqNullSafe(F.col("id")) & (F.xxhash64(rows.of[text]) == F.col("hash"))
    return rows.back(rows.frame.join(found, same, "left_anti"))
