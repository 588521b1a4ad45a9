"""Spelling variants: words one edit apart, found by probing edits against Bloom filters, and the form each goes by."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from dqspark.llm.common import mapped, quoted, texts
from dqspark.session import stored

#: Runs of these letters are words; A-Z are lower-cased and no others.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: Words and signs a task counts before it hands them on; longer texts are not cut into a list of words.
COUNTED, SIGNS, LONG = 1 << 17, 1 << 24, 1 << 20
#: Words of one filter, bits for each of them, and the least size of a filter in 64-bit blocks.
SLICE, BITS, BLOCKS = 1 << 18, 24, 256
#: Bytes of filters that are broadcast at once; more go in rounds.
BROADCAST = 1 << 25
#: Edits that are probed at once.
PROBED = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def vocabulary(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    typo_every: int | None = None,
    shortest: int = 5,
    fewest: int = 3,
) -> DataFrame:
    """Words of all texts with their number of occurrences: ``word``, ``n``.

    A word is a maximal run of ``LETTERS``, A-Z lower-cased, with at least ``shortest`` code points and ``fewest``
    occurrences. ``typo_every`` plants typing errors, to measure by: where it divides the CRC-32 of ``<id>:<run>``, the
    code point at CRC-32 modulo the run's length is left out. Null and empty texts have no words, a null id counts as
    empty text, equal rows count each. Words are counted in the tasks before they are shuffled, so a word that makes
    up much of the table is a few rows.
    """
    rows = docs.select(quoted(id_column).cast("string").alias("id"), quoted(text_column).alias("text"))
    counted = mapped(rows, partial(_count, typo_every, shortest), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest)


def _count(typo_every: int | None, shortest: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run, counts, signs = re.compile(LETTERS), Counter(), 0
    for batch in batches:
        for name, raw in zip(batch["id"], texts(batch["text"])):
            text = raw.lower().decode()  # of bytes: A-Z alone
            found = run.findall(text) if len(text) < LONG else (m[0] for m in run.finditer(text))
            start = zlib.crc32(f"{name.as_py() or ''}:".encode())
            for word, n in Counter(found).items():
                if len(word) < shortest:
                    continue
                if typo_every:
                    crc = zlib.crc32(word.encode(), start)
                    if crc % typo_every == 0:
                        word = word[: crc % len(word)] + word[crc % len(word) + 1 :]
                        if len(word) < shortest:
                            continue
                if word not in counts:
                    signs += len(word)
                counts[word] += n
            if len(counts) >= COUNTED or signs >= SIGNS:
                yield _counted(counts)
                counts, signs = Counter(), 0
    if counts:
        yield _counted(counts)


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
    )


def variants(words: DataFrame) -> DataFrame:
    """For each word of a vocabulary ``(word, n)`` the commoner form it is a variant of.

    Words are near if exactly one inserted, deleted or replaced code point tells them apart. Columns: ``word``; ``form``,
    the near word of largest ``n`` (ties: first by code points) if that is at least twice the word's, else null;
    ``root``, the last word on the way over forms, itself if there is none; ``n``; ``n_near``; ``form_n``.

    Every word's replacements and deletions are hashed and looked up in Bloom filters of the vocabulary, cut by word
    length and hash and broadcast; at most ``BROADCAST`` bytes at once, in as many rounds as that takes. Insertions are
    the deletions of the other word, and of two replacements one is enough. What a filter admits is joined with the
    vocabulary, which removes its errors; a filter misses nothing, so the result is exact.

    Rows with a null word or count go, repeated words are summed; other columns are not read. Words may be of any length:
    edits are probed in pieces. The driver holds a row per word length, the code points that occur, and a round's filters.
    """
    known = stored(
        words.filter("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n")), "words"
    )
    near = _near(known)
    first = F.min(F.when(F.col("near").isNotNull(), F.struct(-F.col("near_n"), F.col("near"))))
    best = near.unionByName(known, allowMissingColumns=True).groupBy("word", "n").agg(
        F.count("near").alias("n_near"), first.alias("b")
    )
    strong = -F.col("b.col1") >= 2 * F.col("n")
    formed = stored(
        best.select(
            "word",
            "n",
            "n_near",
            F.when(strong, F.col("b.near")).alias("form"),
            F.when(strong, -F.col("b.col1")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    together = formed.join(roots.withColumnRenamed("word", "of"), F.col("word") == F.col("of"), "left")
    return together.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """The last word from each word on. Every round doubles the way, and n doubles with each step, so rounds are few."""
    ahead = stored(forms, "roots")
    while True:
        step = ahead.select(F.col("word").alias("via"), F.col("root").alias("further"))
        moved = ahead.join(step, F.col("root") == F.col("via"), "left")
        ahead = stored(
            moved.select("word", F.coalesce("further", "root").alias("root"), F.isnotnull("further").alias("moved")), "roots"
        )
        if ahead.filter("moved").isEmpty():
            return ahead.select("word", "root")


def _near(known: DataFrame) -> DataFrame:
    """All near words, in both directions: ``word``, ``n``, ``near``, ``near_n``."""
    by_length = known.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("words")).collect()
    slices = {r.length: -(-r.words // SLICE) for r in by_length}
    signs = mapped(known.select("word"), _signs, "sign int").distinct().collect()
    alphabet = np.array(sorted(r.sign for r in signs), dtype=np.uint64)
    hashed = mapped(known.select("word"), partial(_shards, slices), "length int, slice int, hash long")
    filters = stored(
        hashed.groupBy("length", "slice").applyInArrow(_filter, "length int, slice int, size long, bits binary"), "filters"
    )
    sizes = filters.select("length", "slice", "size").orderBy("length", "slice").collect()  # a row per filter
    found = known.limit(0).select("word", "n", F.col("word").alias("other"))
    for chosen in _rounds([(r.length, r.slice, r.size) for r in sizes]):
        found = found.union(_admitted(known, filters, chosen, slices, alphabet))
    vocabulary = known.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    links = stored(found.join(vocabulary, F.col("other") == F.col("near")).select("word", "n", "near", "near_n"), "near")
    return links.union(links.select("near", "near_n", "word", "n"))


def _rounds(sizes: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Filters in order, as many at a time as may be broadcast."""
    chosen, held = [], 0
    for length, slice_, size in sizes:
        if chosen and held + size > BROADCAST:
            yield chosen
            chosen, held = [], 0
        chosen.append((length, slice_))
        held += size
    if chosen:
        yield chosen


def _admitted(
    known: DataFrame, filters: DataFrame, chosen: list[tuple[int, int]], slices: dict[int, int], alphabet: np.ndarray
) -> DataFrame:
    """Edits that the chosen filters admit: ``word``, ``n``, ``other``. Only words of fitting lengths are read."""
    (low, low_slice), (high, high_slice) = chosen[0], chosen[-1]
    within = F.struct("length", "slice").between(_pair(low, low_slice), _pair(high, high_slice))
    rows = filters.filter(within).select("length", "slice", "bits").collect()  # BROADCAST bytes, or one filter
    held = {(r.length, r.slice): np.frombuffer(r.bits, dtype=np.uint64) for r in rows}
    shared = known.sparkSession.sparkContext.broadcast(held)
    probed = known.filter(F.length("word").between(low, high + 1))
    admitted = stored(
        mapped(probed, partial(_probe, shared, slices, alphabet), "word string, n long, other string"), "admitted"
    )
    shared.unpersist()
    return admitted


def _pair(length: int, slice_: int) -> Column:
    return F.struct(F.lit(length).alias("length"), F.lit(slice_).alias("slice"))


def _codes(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), -1).astype(np.uint64)


def _powers(length: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(length, _BASE, dtype=np.uint64))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _MIX
    return values ^ (values >> np.uint64(29))


def _slice_of(mixed: np.ndarray, slices: int) -> np.ndarray:
    return (((mixed >> np.uint64(16)) & np.uint64(0xFFFF)) * np.uint64(slices)) >> np.uint64(16)


def _masks() -> np.ndarray:
    """Four of 64 bits for each value of 16 bits."""
    bits = np.random.default_rng(64).permuted(np.tile(np.arange(64, dtype=np.uint64), (1 << 16, 1)), axis=1)[:, :4]
    return np.bitwise_or.reduce(np.uint64(1) << bits, axis=1)


def _places(mixed: np.ndarray, blocks: int, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block of each value, by its upper half, and the bits set there, by its lowest 16."""
    return ((mixed >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32), masks[mixed & np.uint64(0xFFFF)]


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """The words of a batch by length, with their places there; ``SIGNS`` signs, or one word, at a time."""
    words = column.to_pylist()
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        for piece in np.array_split(at, -(-len(at) * max(length, 1) // (SIGNS >> 4))) if length else [at]:
            if len(piece):
                yield length, piece, [words[i] for i in piece.tolist()]


def _signs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        signs = sorted({ord(sign) for word in batch["word"] for sign in set(word.as_py())})
        yield pa.RecordBatch.from_arrays([pa.array(signs, pa.int32())], names=["sign"])


def _shards(slices: dict[int, int], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length, slice and hash of every word."""
    for batch in batches:
        for length, _, words in _by_length(batch["word"]):
            mixed = _mixed((_codes(words) * _powers(length)).sum(axis=1, dtype=np.uint64))
            columns = [
                np.full(len(mixed), length, dtype=np.int32),
                _slice_of(mixed, slices[length]).astype(np.int32),
                mixed.view(np.int64),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["length", "slice", "hash"])


def _filter(group: pa.Table) -> pa.Table:
    """The filter of one slice's words."""
    mixed = group["hash"].to_numpy().view(np.uint64)
    blocks = np.zeros(max(BLOCKS, len(mixed) * BITS // 64), dtype=np.uint64)
    at, bits = _places(mixed, len(blocks), _masks())
    np.bitwise_or.at(blocks, at.astype(np.int64), bits)
    row = {
        "length": group["length"][:1],
        "slice": group["slice"][:1],
        "size": pa.array([blocks.nbytes], pa.int64()),
        "bits": pa.array([blocks.tobytes()], pa.binary()),
    }
    return pa.table(row)


def _probe(
    shared: Broadcast, slices: dict[int, int], alphabet: np.ndarray, batches: Iterable[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    filters, masks = shared.value, _masks()
    lengths = {length for length, _ in filters}

    def admits(length: int, hashes: np.ndarray) -> np.ndarray:
        """Which of the hashes of words of this length a filter of the round holds."""
        mixed = _mixed(hashes)
        of = _slice_of(mixed, slices[length]) if slices[length] > 1 else None
        found = np.zeros(len(mixed), dtype=bool)
        for slice_ in range(slices[length]):
            blocks = filters.get((length, slice_))
            if blocks is None:
                continue
            at = slice(None) if of is None else np.flatnonzero(of == slice_)
            block, bits = _places(mixed[at], len(blocks), masks)
            found[at] = blocks[block] & bits == bits
        return found

    for batch in batches:
        for length, rows, words in _by_length(batch["word"]):
            counts = batch["n"].take(pa.array(rows))
            for edited in _edits(words, length, alphabet, lengths, admits):
                row = pa.array([r for r, _ in edited])
                others = pa.array([other for _, other in edited], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch["word"].take(pa.array(rows).take(row)), counts.take(row), others], names=["word", "n", "other"]
                )


def _edits(words: list[str], length: int, alphabet: np.ndarray, lengths: set[int], admits) -> Iterator[list[tuple[int, str]]]:
    """Admitted edits of words of one length as (row, edited word), in lists of some million signs."""
    codes, powers, held, signs = _codes(words), _powers(length), [], 0
    for row, at, sign in _hits(codes, powers, length, alphabet, lengths, admits):
        word = words[row]
        held.append((row, word[:at] + (chr(sign) if sign >= 0 else "") + word[at + 1 :]))
        signs += 2 * length
        if signs > SIGNS >> 2:
            yield held
            held, signs = [], 0
    if held:
        yield held


def _hits(
    codes: np.ndarray, powers: np.ndarray, length: int, alphabet: np.ndarray, lengths: set[int], admits
) -> Iterator[tuple[int, int, int]]:
    """(row, place, code point put there, or -1 if one is taken out) of the admitted edits.

    A word's hash is the sum of its code points times a power for each place, so an edit's hash takes a difference or
    two partial sums, not the edited word. Of two words that one replacement tells apart the one with the lower code
    point is edited; of equal neighbouring signs the first is taken out.
    """
    weighted = codes * powers
    if length in lengths:
        whole = weighted.sum(axis=1, dtype=np.uint64)
        wide = max(1, PROBED // len(alphabet))
        for low in range(0, codes.size, wide):
            flat = np.arange(low, min(low + wide, codes.size))
            row, at = flat // length, flat % length
            old = codes[row, at]
            higher = len(alphabet) - np.searchsorted(alphabet, old, "right")
            one = np.repeat(np.arange(len(flat)), higher)
            sign = alphabet[len(alphabet) - np.repeat(np.cumsum(higher), higher) + np.arange(len(one))]
            hashes = whole[row[one]] + (sign - old[one]) * powers[at[one]]
            for hit in np.flatnonzero(admits(length, hashes)).tolist():
                yield int(row[one[hit]]), int(at[one[hit]]), int(sign[hit])
    if length - 1 in lengths:
        before = np.cumsum(weighted, axis=1, dtype=np.uint64) - weighted
        moved = np.zeros_like(codes)
        moved[:, :-1] = codes[:, 1:] * powers[:-1]
        after = np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
        first = np.ones(codes.shape, dtype=bool)
        first[:, 1:] = codes[:, 1:] != codes[:, :-1]
        row, at = np.nonzero(first)
        for hit in np.flatnonzero(admits(length - 1, (before + after)[row, at])).tolist():
            yield int(row[hit]), int(at[hit]), -1
