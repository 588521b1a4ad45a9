"""Documents packed into token windows by best-fit decreasing; overlong ones are first cut into full windows."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from dqspark.llm.common import mapped, quoted

#: Tokens that are packed together in one task, signs that are tokenized at once, and words a task remembers.
CHUNK, SLICE, REMEMBERED = 1 << 22, 1 << 20, 1 << 19
#: A chunk with a larger share of padding gives up its emptiest windows to fill the holes of others.
PADDING = 0.005

_BREAK = re.compile("[ \t\n\x0b\f\r]")
_WORD = re.compile("[^ \t\n\x0b\f\r]+")
#: How the tokenizer cuts a word of these letters and ASCII signs, once lower-cased; fixed by its file.
_LATIN = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]+")
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class Words:
    """Token ids of texts, word by word, for a tokenizer that drops white space, lets no token cross it and marks the
    ends of its pieces with ``</w>``.

    Ids are asked for once a word and remembered. Many words occur once (numbers, keys, junk); those of Latin letters
    and ASCII signs are cut into the pieces that the tokenizer would cut, which recur, and only new pieces are asked for,
    many at a time. Other words, and those with a special token's beginning, are asked for whole. A memory that is full is
    emptied.
    """

    def __init__(self, path: str):
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        vocabulary = self._tokenizer.get_vocab()
        self._last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # For pieces, which are in their final form: the same merges without normalizing and cutting again.
        self._merges = Tokenizer.from_file(path)
        self._merges.normalizer = normalizers.Sequence([])
        self._merges.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self._words: dict[str, bytes] = {}  # ids as little-endian unsigned 32-bit numbers
        self._pieces: dict[str, bytes] = {}

    def ids(self, text: str) -> list[np.ndarray]:
        """The ids of a whole text, in slices that end at white space, so that one text's words are never all held."""
        return [self._slice(part) for part in _slices(text)]

    def _slice(self, text: str) -> np.ndarray:
        words = _WORD.findall(text)
        if len(self._words) > REMEMBERED:
            self._words.clear()
        if new := set(words).difference(self._words):
            self._learn(new)
        return np.frombuffer(b"".join(map(self._words.__getitem__, words)), dtype="<u4")

    def _learn(self, words: set[str]) -> None:
        cut, whole = {}, []
        for word in words:
            if not _LATIN.fullmatch(word) or "<|" in word:
                whole.append(word)
            else:
                low = word.lower()
                cut[word] = (low,) if low.isalpha() else _PIECE.findall(low)
        known = self._pieces
        if len(known) > REMEMBERED:
            known.clear()
        if new := list({p for pieces in cut.values() for p in pieces}.difference(known)):
            self._ask(new)
        for word, pieces in cut.items():
            self._words[word] = known[pieces[0]] if len(pieces) == 1 else b"".join([known[p] for p in pieces])
        for word, found in zip(whole, self._tokenizer.encode_batch(whole, add_special_tokens=False)):
            self._words[word] = np.array(found.ids, dtype="<u4").tobytes()

    def _ask(self, pieces: list[str]) -> None:
        """Tokenize pieces as one text, and cut it after each piece's last token."""
        found = self._merges.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0]
        ids = np.array(found.ids, dtype="<u4")
        raw, low = ids.tobytes(), 0
        for piece, high in zip(pieces, (4 * (np.flatnonzero(self._last[ids]) + 1)).tolist(), strict=True):
            self._pieces[piece] = raw[low:high]
            low = high


@lru_cache(maxsize=1)
def _words(path: str) -> Words:
    """One memory for all tasks that a worker process runs one after the other."""
    return Words(path)


def _slices(text: str) -> Iterator[str]:
    start = 0
    while start < len(text):
        end = start + SLICE
        cut = _BREAK.search(text, end) if end < len(text) else None
        yield text[start : cut.start() if cut else len(text)]
        start = cut.end() if cut else len(text)


class OpenWindows:
    """Windows by remaining capacity: a segment tree says which capacities occur, so the tightest takes log steps."""

    def __init__(self, window: int):
        self._leaves = 1 << window.bit_length()
        self._occurs = [0] * (2 * self._leaves)
        self._at: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, window: int, capacity: int) -> None:
        if not self._at[capacity]:
            self._count(capacity, 1)
        self._at[capacity].append(window)

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return the window with the least capacity that holds the length, and that capacity."""
        node = self._leaves + length
        if not self._occurs[node]:
            while node & 1 or not self._occurs[node + 1]:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self._leaves:
                node = 2 * node if self._occurs[2 * node] else 2 * node + 1
        capacity = node - self._leaves
        window = self._at[capacity].pop()
        if not self._at[capacity]:
            self._count(capacity, -1)
        return window, capacity

    def _count(self, capacity: int, by: int) -> None:
        node = self._leaves + capacity
        while node:
            self._occurs[node] += by
            node >>= 1


def best_fit(lengths: Sequence[int], window: int) -> tuple[list[int], list[int]]:
    """The window of every piece, and its place there, longest pieces first, each into the tightest open window."""
    windows, offsets, opened = [0] * len(lengths), [0] * len(lengths), 0
    free = OpenWindows(window)
    for piece in np.argsort(-np.asarray(lengths, dtype=np.int64), kind="stable").tolist():
        length = lengths[piece]
        found = free.take(length)
        if found is None:
            found, opened = (opened, window), opened + 1
        windows[piece], capacity = found
        offsets[piece] = window - capacity
        if capacity > length:
            free.add(windows[piece], capacity - length)
    return windows, offsets


def _padded(fill: int, window: int) -> int:
    """What a sequence of ``fill`` tokens is padded to: a power of two stays."""
    return fill if fill & (fill - 1) == 0 else window


def packed(lengths: Sequence[int], window: int, padding: float = PADDING) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, window, offset)`` of documents of these lengths, by document and start.

    Documents of a window or more give full windows first; what is left of them and the others are packed by
    ``best_fit``. Are more than ``padding`` of the places then padding, the emptiest windows go one by one and their
    pieces are cut into the holes of the others, as long as the holes take a window whole.
    """
    done, rest = [], []
    windows = 0
    for document, length in enumerate(lengths):
        for start in range(0, length - window + 1, window):
            done.append((document, start, window, windows, 0))
            windows += 1
        if length % window:
            rest.append((document, length - length % window, length % window))
    places, offsets = best_fit([length for _, _, length in rest], window)
    members: dict[int, list[int]] = {}
    for piece, place in enumerate(places):
        members.setdefault(place, []).append(piece)
    fill = {place: sum(rest[p][2] for p in pieces) for place, pieces in members.items()}
    fullest = sorted(fill, key=lambda place: (-fill[place], place))
    total = sum(lengths)
    holes = sum(window - f for f in fill.values())
    waste = sum(_padded(f, window) - f for f in fill.values())
    given_up: list[int] = []
    while fullest and waste > padding * (total + waste):
        last = fullest[-1]
        if holes - (window - fill[last]) < fill[last]:
            break
        holes -= window
        waste = holes
        given_up.append(fullest.pop())
    for place in fullest:
        done += [(*rest[p], windows + place, offsets[p]) for p in members[place]]
    loose = [rest[p] for place in given_up for p in members[place]]
    room = [(place, window - fill[place]) for place in reversed(fullest) if fill[place] < window]
    while loose:
        document, start, length = loose.pop()
        place, free = room.pop()
        taken = min(length, free)
        done.append((document, start, taken, windows + place, window - free))
        if taken < length:
            loose.append((document, start + taken, length - taken))
        if taken < free:
            room.append((place, free - taken))
    return sorted(done)


def pack(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", window: int = 2048, end: int = 1
) -> DataFrame:
    """Pack documents into sequences of at most ``window`` tokens. One row per piece of a document.

    ``tokenizer`` is the file of a tokenizer that drops white space (as ``word_bpe_49k.json`` does), on every machine.
    A document is the ids of its whole text followed by ``end``. Columns: ``id``, ``start`` (the document's ids before
    the piece), ``length``, ``ids`` (little-endian unsigned 32-bit numbers), ``doc_tokens``, ``sequence_id``,
    ``offset`` (place in the sequence, without gaps from 0), ``padded`` (the sequence's length once padded: the window,
    or its own length if that is a power of two).

    Every task packs what it reads, ``CHUNK`` tokens at a time, and no row is moved: a chunk is large against a
    window, so packing it alone costs nothing, and the task's number makes sequence ids unique. The packing depends on
    how the input is split into tasks; write the result before using it twice.

    A null or empty text is ``end`` alone. Equal ids, equal rows and null ids are documents of their own. No documents
    give no rows. Only the two columns are read; others may have any names.
    """
    rows = docs.select(quoted(id_column).alias("id"), quoted(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, padded long"
    return mapped(rows, partial(_pack, tokenizer, window, end), schema)


def _pack(tokenizer: str, window: int, end: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, first = _words(tokenizer), TaskContext.get().partitionId() << 40
    known: dict[str, np.ndarray] = {}  # texts of this chunk: copies are tokenized once
    ids: list[np.ndarray] = []
    names: list[pa.Array] = []
    held = 0
    for batch in batches:
        start = 0
        for row, text in enumerate(batch["text"]):
            text = text.as_py() or ""
            if text not in known:
                known[text] = np.concatenate([*words.ids(text), np.array([end], dtype=np.uint32)])
            ids.append(known[text])
            held += len(ids[-1])
            if held >= CHUNK:
                names.append(batch["id"].slice(start, row + 1 - start))
                first = yield from _chunk(names, ids, window, first)
                ids, names, known, held, start = [], [], {}, 0, row + 1
        names.append(batch["id"].slice(start))
    if ids:
        yield from _chunk(names, ids, window, first)


def _chunk(names: list[pa.Array], ids: list[np.ndarray], window: int, first: int) -> Iterator[pa.RecordBatch]:
    """The pieces of one chunk in batches of about ``CHUNK`` tokens; returns the next free sequence id."""
    lengths = np.array([len(i) for i in ids], dtype=np.int64)
    pieces = np.array(packed(lengths.tolist(), window), dtype=np.int64)
    document, start, length, place, offset = pieces.T
    fill = np.bincount(place, weights=length).astype(np.int64)
    padded = np.array([_padded(int(f), window) for f in fill], dtype=np.int64)
    taken = pa.concat_arrays(names).take(pa.array(document))
    ends = np.append(0, np.cumsum(length))
    tokens = np.concatenate(ids)
    columns = [start, length, None, lengths[document], first + place, offset, padded[place]]
    low = 0
    while low < len(pieces):
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + CHUNK, "right")) - 1)
        cuts = pa.py_buffer(((ends[low : high + 1] - ends[low]) * 4).astype(np.int32))
        data = pa.py_buffer(tokens[ends[low] : ends[high]].astype("<u4"))
        binary = pa.Array.from_buffers(pa.binary(), high - low, [None, cuts, data])
        arrays = [taken.slice(low, high - low)] + [binary if c is None else pa.array(c[low:high]) for c in columns]
        yield pa.RecordBatch.from_arrays(
            arrays, names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "padded"]
        )
        low = high
    return first + len(fill)


def sequences(pieces: DataFrame) -> DataFrame:
    """The sequences of written pieces: ``sequence_id``, ``ids`` without padding, ``padded``, and the pieces' ``starts``.

    ``ids`` are little-endian unsigned 32-bit numbers, as in the pieces. A group is one sequence, of a window at most.
    """
    members = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = pieces.groupBy("sequence_id").agg(members.alias("m"), F.first("padded").alias("padded"))
    ids = F.aggregate("m", F.lit(b""), lambda held, piece: F.concat(held, piece["ids"]))
    return joined.select("sequence_id", ids.alias("ids"), "padded", F.col("m.offset").alias("starts"))
