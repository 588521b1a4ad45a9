"""Shards of near equal bytes by sampled splitters."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from dqspark.llm.common import Rows

#: Ranges per shard at least, sampled keys per range, and bytes of a range about which more ranges are made: they steer
#: how even and how large the ranges are, not the result's law.
RANGES, SAMPLE, RANGE_BYTES = 64, 8, 1 << 29
_HALF, _LOW = 1 << 31, (1 << 32) - 1
#: Bytes a record takes besides its text.
OVERHEAD = 8


def _longs(values: Sequence[int]) -> Column:
    """A constant array; as one text, since thousands of literals would slow the planner."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _keyed(rows: Rows, id: str, text: str) -> DataFrame:
    """Rows with size, checksum and key: by checksum of the text first, so equal texts are neighbours, then by id."""
    own = F.coalesce(F.col(rows.of[text]), F.lit(""))
    low = F.xxhash64(rows.of[id]).bitwiseAND(F.lit(_LOW))
    return (
        rows.frame.withColumn("size", F.octet_length(own).cast("long") + OVERHEAD)
        .withColumn("crc", F.crc32(own.cast("binary")))
        .withColumn("key", F.shiftleft(F.col("crc") - F.lit(_HALF), 32).bitwiseOR(low))
    )


def _splitters(keyed: DataFrame, total: int, ranges: int, sample: int, seed: int) -> list[int]:
    """Quantiles of a size-weighted sample of keys.

    A key is drawn with the chance 1 - exp(-size * rate): its draw -ln(u) / size falls below a rate that makes
    ``ranges * sample`` draws expected at most, however many tasks there are. u is a hash of the key: reruns agree.
    """
    if not total:
        return []
    u = (F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 52)) + 1) / float(1 << 52)
    drawn = keyed.filter(-F.log(u) / F.col("size") < ranges * sample / total)
    keys = sorted(r["key"] for r in drawn.select("key").collect())
    return sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)} if keys else [])


def _at_edges(splitters: list[int], most: int) -> tuple[list[int], list[int]]:
    """Splitters moved to where a checksum starts, so that equal texts stay in one range; and what is subdivided.

    Checksums that hold ``most`` splitters or more would make ranges overfull: they keep theirs.
    """
    counts = Counter(s >> 32 for s in splitters)
    hot = {c for c, n in counts.items() if n >= most}
    moved, last = [], None
    for s in splitters:
        if s >> 32 != last:
            moved.append((s >> 32) << 32)
        elif s >> 32 in hot:
            moved.append(s)
        last = s >> 32
    return moved, sorted(c + _HALF for c in hot)


def _range_of(splitters: list[int]) -> Column:
    """How many splitters the key has reached, by halving: as many steps as the count has binary digits."""
    steps = [1 << i for i in reversed(range(len(splitters).bit_length()))]
    if not steps:
        return F.lit(0)
    every = _longs([*splitters, *[(1 << 63) - 1] * (2 * steps[0] - 1 - len(splitters))])
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda reached, step: F.when(F.element_at(every, reached + step) <= F.col("key"), reached + step).otherwise(
            reached
        ),
    )


def _first_of_each(values: dict[int, int], n: int) -> list[int]:
    total, before = 0, []
    for i in range(n):
        before.append(total)
        total += values.get(i, 0)
    return [*before, total]


def shard(
    docs: DataFrame,
    shards: int = 24,
    id: str = "doc_id",
    text: str = "text",
    ranges: int = RANGES,
    sample: int = SAMPLE,
    seed: int = 6,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """The documents with ``size`` (bytes of the text and ``OVERHEAD``), ``text_crc32``, ``shard`` and ``slot``.

    Shards have near equal bytes. Documents are ordered by a checksum of their text, then by id. Splitters from
    a size-weighted sample cut that order into ``ranges * shards`` ranges, or as many more as make them ``range_bytes`` each;
    their exact bytes, a row each, are added up, and a running sum within the range gives each row its place in the whole order. A row goes to the
    shard in which its place lies. Equal texts share the place of their middle, and so the shard; but texts with a
    sixteenth of a shard's bytes or more (so many splitters lie among them), or with those of so many ranges where
    ``range_bytes`` makes them smaller, divide by id, over ranges and shards.
    ``slot`` counts the rows of a shard in that order, from 0 without gaps.

    No task holds more than a range, and their number follows from the exact bytes of the input. The driver gets the
    sample and a few numbers per range. The input is scanned five times, its columns shuffled once.

    A null text is an empty one; a null id is an id like others. Rows that repeat a text and an id are
    neighbours in one range and get slots of their own. No rows give no rows. Input columns with the names of
    the added ones are replaced.
    """
    rows = Rows(docs)
    keyed = _keyed(rows, id, text)
    total = keyed.agg(F.sum("size")).first()[0] or 0
    many = max(ranges, -(-total // (shards * range_bytes)))
    splitters, hot = _at_edges(_splitters(keyed, total, many * shards, sample, seed), max(2, ranges // 16))
    keyed = keyed.withColumn("range", _range_of(splitters))
    narrow = keyed.select("range", "key", "crc", "size", F.col(rows.of[id]).alias("id"))
    totals = narrow.groupBy("range").agg(F.sum("size").alias("size")).collect()
    begins = _first_of_each({r["range"]: r["size"] for r in totals}, len(splitters) + 2)
    placed = _placed(narrow, begins, hot, shards)
    counts = placed.groupBy("range", "shard").agg(F.count(F.lit(1)).alias("n")).collect()
    moves, starts, lowest = _moves({(r["range"], r["shard"]): r["n"] for r in counts}, len(splitters) + 2, shards)
    wide = _placed(keyed.withColumn("id", F.col(rows.of[id])), begins, hot, shards)
    entry = F.get(_longs(starts), F.col("range")) + F.col("shard") - F.get(_longs(lowest), F.col("range"))
    move = F.get(_longs(moves), entry.cast("int"))
    done = wide.withColumns({"slot": F.col("row") - 1 + move, "text_crc32": F.col("crc")})
    return rows.back(done, "size", "text_crc32", "shard", "slot")


def _placed(keyed: DataFrame, begins: list[int], hot: list[int], shards: int) -> DataFrame:
    """Rows with their number in the range, and their shard, which never falls along the order."""
    order = Window.partitionBy("range").orderBy("crc", "key", "id")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    alike = Window.partitionBy("range", "crc")
    middle = F.min("before").over(alike) + F.floor(F.sum("size").over(alike) / 2)
    divided = F.array_contains(_longs(hot), F.col("crc")) if hot else F.lit(False)
    place = F.get(_longs(begins), F.col("range")) + F.when(divided, F.col("before")).otherwise(middle)
    return (
        keyed.withColumn("before", F.sum("size").over(so_far) - F.col("size"))
        .withColumn("row", F.row_number().over(order).cast("long"))
        .withColumn("shard", F.least(F.floor(place * shards / max(1, begins[-1])), F.lit(shards - 1)).cast("int"))
    )


def _moves(counts: dict[tuple[int, int], int], ranges: int, shards: int) -> tuple[list[int], list[int], list[int]]:
    """What turns a row's number in its range into its slot: for each shard of each range, in one list.

    Also where a range's part of that list starts and which shard that is for. The list has about as many
    entries as there are ranges and shards, as the shards of a range follow each other.
    """
    seen, moves, starts, lowest = [0] * shards, [], [], []
    own: dict[int, dict[int, int]] = {}
    for (at, shard_), n in counts.items():
        own.setdefault(at, {})[shard_] = n
    for at in range(ranges):
        held = own.get(at, {0: 0})
        starts.append(len(moves))
        lowest.append(min(held))
        earlier = 0
        for s in range(min(held), max(held) + 1):
            moves.append(seen[s] - earlier)
            seen[s] += held.get(s, 0)
            earlier += held.get(s, 0)
    return moves, starts, lowest
