"""Near-duplicate documents by SimHash fingerprints and a hierarchical index in Gray order."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from dqspark.llm.common import Rows, group_starts, mapped, meeting, merged, texts, whole_groups
from dqspark.llm.components import components
from dqspark.operators.joins import join_reduced
from dqspark.session import stored

#: Rows of equal masked bits that meet in one task, and children of an index node.
GROUP, FAN = 4096, 16
#: Pairs of a fingerprint and an index node that are looked at together.
FRONTIER = 1_000_000


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """The 64 bits of a UTF-8 text: a bit is 1 if over half the shingles' hashes have it set.

    A-Z become a-z, words are cut at ASCII white space. Shingles are ``shingle`` words joined by a space,
    repeats included, hashed by XXH64 with seed 42. Fewer words are one shingle, no words give 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - shingle + 1)
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest, set_bits, shift = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64), len(words) - n
    for first in range(0, n, 65536):
        last = min(n, first + 65536)
        ends = starts[first + shift + 1 : last + shift + 1]
        hashes = np.array([digest(line[s : e - 1], 42) for s, e in zip(starts[first:last], ends)], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def fingerprinted(rows: DataFrame, text: str, shingle: int = 4) -> DataFrame:
    """The rows with a column ``fp``, the fingerprint as a signed long; a null text counts as empty."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, shingle) for t in texts(batch[text])), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found.view(np.int64))], names=[*batch.schema.names, "fp"]
            )

    return mapped(rows, add, StructType([*rows.schema.fields, StructField("fp", LongType())]))


def _gray_rank(fp: Column) -> Column:
    """The place of a fingerprint among all, ordered so that neighbours differ in one bit (inverse Gray code)."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def _masks(distance: int) -> list[int]:
    """Masks of 64 bits of which any two fingerprints within the distance share at least one's bits.

    The bits are cut into distance + 2 blocks; differing bits spoil ``distance`` of them at most,
    so two blocks are equal whole. Signed, as Spark has it.
    """
    blocks = np.array_split(np.arange(64), distance + 2)
    masks = [sum(1 << int(i) for block in two for i in block) for two in combinations(blocks, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fingerprints: DataFrame, distance: int = 4) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct fingerprints ``fp`` within ``distance`` bits of each other.

    Any two such fingerprints are connected, by one link or a path of links each within the distance; a
    group of n close ones gives about n links, not n squared. No candidate is left out: see ``_masks``.

    Each mask's bits are an upper node of the index; Spark deals the fingerprints out by mask and masked
    bits and sorts them by Gray rank, so that neighbours share most bits. ``_search`` builds the nodes below.
    """
    masks = F.array(*[F.struct(F.lit(i).alias("mask"), F.lit(m).alias("bits")) for i, m in enumerate(_masks(distance))])
    rows = fingerprints.select("fp", F.explode(masks).alias("m")).select(
        "fp",
        F.xxhash64("m.mask", F.col("fp").bitwiseAND(F.col("m.bits"))).alias("node"),
        _gray_rank(F.col("fp")).alias("rank"),
    )
    dealt = meeting(rows, "node", F.col("fp"), GROUP, ["rank"])
    return mapped(dealt.select("node", "low", "high", "part", "fp"), partial(_search, distance), "a long, b long")


def _search(distance: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = ["node", "low", "high"]
    for table in whole_groups(batches, keys, 4 * GROUP):
        fp = table["fp"].to_numpy().view(np.uint64)
        part = np.where(table["low"].to_numpy() == table["high"].to_numpy(), -1, table["part"].to_numpy())
        labels = np.arange(len(fp))
        for a, b in pairs_within(fp, group_starts(table, keys), distance):
            across = (part[a] < 0) | (part[a] != part[b])
            labels = merged(labels, a[across], b[across])
        linked = np.flatnonzero(labels != np.arange(len(fp)))
        signed = fp.view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(signed[linked]), pa.array(signed[labels[linked]])], names=["a", "b"])


def _levels(fp: np.ndarray, starts: np.ndarray) -> list[dict[str, np.ndarray]]:
    """The index over rows sorted by Gray rank within groups, lowest level first.

    A node covers up to ``FAN`` neighbours of the level below and holds, as mask and bits, what all its
    fingerprints share. The last level has one node for each group.
    """
    levels, ones = [], fp
    zeros, sizes = ~fp, np.diff(np.append(starts, len(fp)))
    while not levels or (sizes > 1).any():
        nodes = -(-sizes // FAN)
        group = np.repeat(np.arange(len(sizes)), nodes)
        at = np.arange(len(group)) - np.repeat(np.cumsum(nodes) - nodes, nodes)
        first = (np.cumsum(sizes) - sizes)[group] + at * FAN
        ones, zeros = np.bitwise_and.reduceat(ones, first), np.bitwise_and.reduceat(zeros, first)
        children = np.minimum(FAN, sizes[group] - at * FAN)
        levels.append({"first": first, "children": children, "bits": ones, "mask": ones | zeros})
        sizes = nodes
    return levels


def pairs_within(fp: np.ndarray, starts: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows a < b of one group within the distance, in pieces of bounded size.

    From the groups' top nodes down, a fingerprint's differing bits are counted in those bits that a node's
    rows share and its parent's do not; a whole node goes once the sum over its ancestors exceeds the distance.
    """
    levels = _levels(fp, starts)
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(fp))))
    width = np.diff(np.append(starts, len(fp)))[group]
    pieces = np.searchsorted(np.cumsum(width), np.arange(FRONTIER, width.sum() + FRONTIER, FRONTIER))
    cuts = np.unique(np.clip(np.concatenate([[0], pieces + 1]), 0, len(fp)))
    for begin, end in zip(cuts[:-1], cuts[1:]):
        query = np.arange(begin, end)
        node, differing = group[query], np.zeros(end - begin, dtype=np.int64)
        for depth in range(len(levels) - 1, -1, -1):
            level, n = levels[depth], levels[depth]["children"][node]
            seen = level["mask"][node]
            offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            child = np.repeat(level["first"][node], n) + offset
            query, differing, seen = np.repeat(query, n), np.repeat(differing, n), np.repeat(seen, n)
            below = levels[depth - 1] if depth else {"bits": fp, "mask": np.full(len(fp), ~np.uint64(0))}
            unlike = (fp[query] ^ below["bits"][child]) & below["mask"][child] & ~seen
            differing = differing + np.bitwise_count(unlike)
            near = differing <= distance
            query, node, differing = query[near], child[near], differing[near]
        later = node > query
        yield query[later], node[later]


def component_table(fingerprints: DataFrame, distance: int = 4) -> DataFrame:
    """``(fp, root)`` of the distinct fingerprints that have a link; root is one fingerprint of the component."""
    return components(links(fingerprints.select("fp").distinct(), distance)).toDF("fp", "root")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4) -> DataFrame:
    """The documents with ``fingerprint`` (16 hex digits) and ``component_id``.

    Documents link if their fingerprints differ in ``distance`` bits or fewer; ``component_id`` is the smallest
    id reachable over links, the own one included.

    A null text is an empty one: fingerprint zero, linked like any other. A null id does not count as
    smallest; a component of null ids alone has a null ``component_id``. Repeated rows are one component.
    Columns of the input that have the names added here are replaced. No rows give no rows.
    """
    rows = Rows(docs)
    found = _grouped(rows, id, text, shingle, distance)
    found = found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0")))
    return rows.back(found, "fingerprint", "component_id")


def _grouped(docs: Rows, id: str, text: str, shingle: int, distance: int) -> DataFrame:
    rows = stored(fingerprinted(docs.frame, docs.of[text], shingle), "fingerprints")
    smallest = rows.groupBy("fp").agg(F.min(docs.of[id]).alias("least"))
    ids = smallest.join(component_table(rows, distance), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = ids.groupBy("root").agg(F.min("least").alias("component_id"))
    least = least.withColumnRenamed("root", "of")
    of_fp = stored(join_reduced(ids, least, "root", "of").select("fp", "root", "component_id"), "components")
    return rows.join(of_fp, "fp")


def one_of_each(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4
) -> DataFrame:
    """The documents but for near duplicates, with their own columns.

    Of each component one row stays, which has the smallest id; among rows that repeat that id, the one whose
    text hashes lowest, then the first by all other columns that have an order, a value before null. Null ids come last:
    a component of null ids alone keeps one. Null texts are empty ones. No rows give no rows. Only rows with the smallest id are ranked, so a large component is no large group.
    """
    rows = Rows(docs)
    own = _grouped(rows, id, text, shingle, distance).filter(F.col(rows.of[id]).eqNullSafe(F.col("component_id")))
    ordered = [c for c, kind in rows.frame.dtypes if not re.search("map<|variant|interval|void", kind)]
    order = [F.xxhash64(rows.of[text]), *[F.col(c).asc_nulls_last() for c in ordered]]
    first = Window.partitionBy("root").orderBy(*order)
    return rows.back(own.withColumn("rank", F.row_number().over(first)).filter("rank = 1"))
