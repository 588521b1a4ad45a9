"""Document quality by a generalised additive model with pairwise interactions."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from dqspark.llm.common import Rows, mapped, texts

#: Labelled rows the model learns from, at most.
SAMPLE = 50_000
#: Bins of a feature, and of each side of a pair; rounds over the features and the pairs; pairs chosen.
BINS, PAIR_BINS, ROUNDS, PAIR_ROUNDS, PAIRS = 48, 12, 150, 60, 8
RATE, PENALTY, LEAST_ROWS = 0.1, 1.0, 5

_LETTERS = bytes(i for i in range(256) if chr(i).isascii() and chr(i).isalpha() or i >= 128)
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_PROSE = b".,;:!?'\"()-"
_SIGNS = bytes(i for i in range(33, 127) if not chr(i).isalnum() and i not in _PROSE)

FEATURES = (
    "log_bytes log_words word_bytes letters upper digits prose_signs other_signs spaces log_lines line_words "
    "repeated_lines longest_line distinct_words commonest_word repeated_pairs words_with_signs words_with_digits "
    "longest_word short_words words_per_stop upper_words"
).split()


def features(text: bytes) -> list[float]:
    """What ``FEATURES`` names, of a whole UTF-8 text; all shares lie in 0 to 1, an empty text has zeros."""
    words, size = text.split(), len(text)
    if not words:
        return [math.log1p(size)] + [0.0] * (len(FEATURES) - 1)
    n = len(words)

    def of(signs: bytes) -> int:
        return size - len(text.translate(None, signs))

    letters, upper, prose, other = of(_LETTERS), of(_UPPER), of(_PROSE), of(_SIGNS)
    lines = [line for line in text.split(b"\n") if line.strip()]
    counts = Counter(words)
    with_signs = sum(c for w, c in counts.items() if len(w) != len(w.translate(None, _SIGNS)))
    with_digits = sum(c for w, c in counts.items() if len(w) != len(w.translate(None, _DIGITS)))
    pairs = len(set(zip(words, words[1:])))
    return [
        math.log1p(size),
        math.log1p(n),
        sum(map(len, words)) / n,
        letters / size,
        upper / max(1, letters),
        of(_DIGITS) / size,
        prose / size,
        other / size,
        of(b" \t\n\r\x0b\x0c") / size,
        math.log1p(len(lines)),
        n / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        max(map(len, lines), default=0) / size,
        len(counts) / n,
        max(counts.values()) / n,
        1 - pairs / max(1, n - 1) if n > 1 else 0.0,
        with_signs / n,
        with_digits / n,
        min(200, max(map(len, counts))) / 200,
        sum(c for w, c in counts.items() if len(w) < 3) / n,
        n / (1 + text.count(b".") + text.count(b"!") + text.count(b"?")),
        sum(c for w, c in counts.items() if w.isupper()) / n,
    ]


@dataclass
class Model:
    """A sum of lookup tables: one per feature over its bins, and one per chosen pair over its coarser bins."""

    start: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """P(label 1) of rows of features: a bin and an addition per table, over all rows at once."""
        total = np.full(len(x), self.start)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            a, b = (np.searchsorted(self.coarse[k], x[:, k], side="right") for k in (i, j))
            total += table[a, b]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _step(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The leaf values of a shallow tree over ordered bins: the best cut, and the best one in each half."""
    values = np.zeros(len(gradient))

    def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return g * g / (h + PENALTY)

    def cut(begin: int, end: int) -> int:
        g, h = np.cumsum(gradient[begin:end]), np.cumsum(weight[begin:end])
        if end - begin < 2:
            return begin
        gains = gain(g[:-1], h[:-1]) + gain(g[-1] - g[:-1], h[-1] - h[:-1]) - gain(g[-1], h[-1])
        return begin + 1 + int(gains.argmax()) if gains.max() > 1e-9 else begin

    middle = cut(0, len(gradient))
    bounds = sorted({0, cut(0, middle), middle, cut(middle, len(gradient)), len(gradient)})
    for begin, end in zip(bounds[:-1], bounds[1:]):
        values[begin:end] = gradient[begin:end].sum() / (weight[begin:end].sum() + PENALTY)
    return values


def _corners(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a pair's bins into four corners: its gain, and the value of each cell."""
    g, h = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    inner, whole = np.s_[:-1, :-1], (g[-1, -1], h[-1, -1])
    low, left, top = (g[inner], h[inner]), (g[:-1, -1:], h[:-1, -1:]), (g[-1:, :-1], h[-1:, :-1])
    parts = [low, *[tuple(side[k] - low[k] for k in (0, 1)) for side in (left, top)]]
    parts.append(tuple(whole[k] - left[k] - top[k] + low[k] for k in (0, 1)))
    gains = sum(a * a / (b + PENALTY) for a, b in parts)
    i, j = np.unravel_index(gains.argmax(), gains.shape)
    values = np.empty_like(g)
    places = (np.s_[: i + 1, : j + 1], np.s_[: i + 1, j + 1 :], np.s_[i + 1 :, : j + 1], np.s_[i + 1 :, j + 1 :])
    for (a, b), place in zip(parts, places):
        values[place] = a[i, j] / (b[i, j] + PENALTY)
    return float(gains[i, j]), values


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting: features take turns with a small step each, so none hides another; then pairs.

    Pairs are chosen by what the best four corners of their bins still explain. Without rows, or with one label
    only, the model is the smoothed share of label 1 for any text.
    """
    start = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    if len(y) < 2 * LEAST_ROWS or len(np.unique(y)) < 2:
        return Model(start)
    edges = [_edges(column, BINS) for column in x.T]
    coarse = [_edges(column, PAIR_BINS) for column in x.T]
    bins = [np.searchsorted(e, column, side="right") for e, column in zip(edges, x.T)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(y), start)

    def wrong() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for own, table in zip(bins, tables):
            gradient, weight = wrong()
            g, h = (np.bincount(own, w, len(table)) for w in (gradient, weight))
            step = RATE * _step(g, h)
            table += step
            total += step[own]
    rough = [np.searchsorted(e, column, side="right") for e, column in zip(coarse, x.T)]

    def cells(i: int, j: int) -> tuple[np.ndarray, tuple[int, int]]:
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        return rough[i] * shape[1] + rough[j], shape

    gradient, weight = wrong()
    found = []
    for i, j in combinations(range(x.shape[1]), 2):
        at, shape = cells(i, j)
        g, h = (np.bincount(at, w, shape[0] * shape[1]).reshape(shape) for w in (gradient, weight))
        found.append((_corners(g, h)[0], i, j))
    pairs = [(i, j) for _, i, j in sorted(found, reverse=True)[:PAIRS]]
    pair_tables = [np.zeros(cells(*pair)[1]) for pair in pairs]
    for _ in range(PAIR_ROUNDS):
        for pair, table in zip(pairs, pair_tables):
            gradient, weight = wrong()
            at, shape = cells(*pair)
            g, h = (np.bincount(at, w, shape[0] * shape[1]).reshape(shape) for w in (gradient, weight))
            step = RATE * _corners(g, h)[1]
            table += step
            total += step.ravel()[at]
    return Model(start, edges, tables, coarse, pairs, pair_tables)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array([features(t) for t in texts(column)], dtype=np.float64).reshape(-1, len(FEATURES))


def held_out(id: Column) -> Column:
    """Whether a row's label is kept from the model: the checksum of its id as text is a multiple of 5."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> Model:
    """Learn from the labelled documents that are not held out: ``sample`` labels at most, taken by hash of the id.

    The sampled labels are broadcast, so labelled texts are picked without a shuffle; the driver gets their features.
    An id with several labels has the commoner, label 1 if as many. Null ids and null labels are left out.
    """
    known = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("double").alias("label")).dropna()
    known = known.groupBy("id").agg((F.avg("label") >= 0.5).cast("double").alias("label")).filter(~held_out(F.col("id")))
    chosen = F.broadcast(known.orderBy(F.xxhash64("id"), "id").limit(sample))
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")).join(chosen, "id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch["text"])
            yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in x.T], batch["label"]], names=[*FEATURES, "label"])

    schema = StructType([StructField(name, DoubleType()) for name in [*FEATURES, "label"]])
    found = mapped(rows.select("label", "text"), measure, schema).toArrow()
    data = np.column_stack([found[name].to_numpy() for name in [*FEATURES, "label"]])
    data = data[np.lexsort(data.T)]
    return fit(data[:, :-1], data[:, -1])


def scored(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The documents with ``score`` (0 to 1, of label 1) and ``predicted``: 1 if the score reaches the threshold.

    Only the text is looked at, whole; null counts as empty, and empty texts have a score too. Repeated rows score
    alike; input columns with the added names are replaced; no rows give none.
    """
    rows = Rows(docs)
    own = rows.of[text]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(model.score(_matrix(batch[own])))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=[*batch.schema.names, "score"])

    schema = StructType([*rows.frame.schema.fields, StructField("score", DoubleType())])
    found = mapped(rows.frame, add, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    return rows.back(found, "score", "predicted")
