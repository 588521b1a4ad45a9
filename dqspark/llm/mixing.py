"""A mix of sources by weight: a hypergeometric splitting tree deals whole blocks of documents to output shards."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from dqspark.llm.common import Rows, word_count
from dqspark.session import stored

#: Blocks of a source at most while the input has no more than ``FULL`` documents for each, documents of a block at least,
#: and sources whose table may be broadcast.
BLOCKS, FULL, BLOCK_ROWS, BROADCAST = 1024, 4096, 64, 100_000


def targets(sizes: Sequence[float], weights: Sequence[float], share: float, most: float) -> list[float]:
    """The words each source should give: ``share`` of all, by weight, but no more than ``most`` times its size.

    What a source cannot take is shared by weight among those that still can, until none is above its limit.
    """
    left, open_, found = share * sum(sizes), list(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        given = {i: left * weights[i] / total for i in open_}
        above = [i for i in open_ if given[i] > most * sizes[i]]
        for i in above or open_:
            found[i] = most * sizes[i] if above else given[i]
            left -= found[i]
        open_ = [i for i in open_ if i not in set(above)] if above else []
    return found


def split(quotas: Sequence[int], shards: int, rng: np.random.Generator) -> np.ndarray:
    """Deal ``quotas`` blocks of each source to shards: one row per shard, columns add up to the quotas exactly.

    A binary tree: at each node the blocks of the left half are drawn without replacement from the node's, so
    their numbers per source are multivariate hypergeometric. Shards have equal blocks, but for one.
    """
    if shards == 1:
        return np.array([quotas], dtype=np.int64)
    left = shards // 2
    drawn = _draw(np.asarray(quotas, dtype=np.int64), int(sum(quotas)) * left // shards, rng)
    return np.vstack([split(drawn, left, rng), split(np.asarray(quotas) - drawn, shards - left, rng)])


def _draw(quotas: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    if not quotas.sum():
        return np.zeros_like(quotas)
    return rng.multivariate_hypergeometric(quotas, n, method="marginals")


def _coprime(n: int, rng: np.random.Generator) -> int:
    while math.gcd(step := int(rng.integers(1, max(2, n))), max(1, n)) != 1:
        pass
    return step


def plan(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    shards: int = 16,
    seed: int = 8,
) -> DataFrame:
    """The documents with ``size`` (words), ``source_size``, ``target``, ``copies`` and ``shards``, one per copy.

    ``weights`` go to the sources in the order of their code points, null last, and repeat. A source's documents
    fall into blocks by hash. It gives whole passes over all blocks, as its target allows, and of a last pass
    as many blocks as fit; of the block that does not fit, documents while they do, and then the one
    document whose size comes nearest to what is missing, if that is nearer than none. So a document has at most
    ``ceil(most)`` copies, and only whole ones. The blocks drawn are dealt to the output shards by ``split``; a
    shard's blocks of a source are those at its places in a permutation of all, so no block of a pass is
    dealt twice.

    The driver gets a row per source, and the tree its block counts. A source has ``BLOCKS`` blocks at most, and twice as many
    whenever the input outgrows ``FULL`` documents for each, so that the last block of a pass, which one task orders, stays
    small. The statistics have a row per block, summed before the shuffle: a source with most of the rows is no large group. Everything random
    is a hash or comes from ``seed``: reruns agree.

    A null text has no words; rows of size 0 go along with their block. Repeated rows fall into one block and
    count each. Null ids are ids like others. No rows give no rows; input columns named as the added are replaced.
    """
    rows = Rows(docs)
    rng = np.random.default_rng(seed)
    most_blocks = block_limit(docs.count())
    hashed = F.xxhash64(F.lit(seed), F.col(rows.of[id]), F.col(rows.of[text]))
    frame = rows.frame.withColumns(
        {
            "size": word_count(F.col(rows.of[text])),
            "source": F.col(rows.of[source]).cast("string"),
            "hash": hashed,
            "cell": F.pmod(hashed, F.lit(most_blocks)).cast("int"),
        }
    )
    cells = stored(frame.groupBy("source", "cell").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")), "cells")
    listed = _sources(cells, weights, share, most, most_blocks)
    of_source = _places(cells, listed, shards, most_blocks, rng)
    joined = _with(frame, of_source).withColumn("block", _block(most_blocks))
    last = joined.filter("block = edge").transform(_fitting)
    other = joined.filter("block != edge").withColumn("more", (F.col("block") < F.col("edge")).cast("int"))
    drawn = last.select(*other.columns).union(other).withColumn("copies", F.col("passes") + F.col("more"))
    dealt = F.expr("CASE WHEN copies > 0 THEN sequence(0, copies - 1) ELSE array() END").cast("array<int>")
    placed = F.transform(
        dealt,
        lambda copy: F.size(
            F.filter(
                "ends",
                lambda end: end
                <= F.pmod((F.col("block") + F.col("blocks") * copy) * F.col("step") + F.col("shift"), F.col("quota")),
            )
        ),
    )
    done = drawn.withColumn("shards", placed)
    return rows.back(done, "size", "source_size", "target", "copies", "shards")


def block_limit(rows: int) -> int:
    """Blocks of a source at most, a power of two that grows with the rows of the input."""
    limit = BLOCKS
    while limit * FULL < rows:
        limit *= 2
    return limit


def _block(most_blocks: int) -> Column:
    """A row's block: neighbouring cells, of which there are ``most_blocks``, make one."""
    return F.expr(f"cast(cast(cell as bigint) * blocks div {most_blocks} as bigint)")


def _with(frame: DataFrame, of_source: DataFrame) -> DataFrame:
    """Each row with what holds for its source, null being a source too."""
    named = of_source.withColumnRenamed("source", "of")
    return frame.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of")


def _sources(cells: DataFrame, weights: Sequence[float], share: float, most: float, most_blocks: int) -> list[dict]:
    totals = cells.groupBy("source").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect()
    ordered = sorted(totals, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in ordered]
    found = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, most)
    listed = []
    for row, target in zip(ordered, found):
        passes = min(int(target // row["size"]), math.ceil(most)) if row["size"] else 0
        blocks = min(most_blocks, 1 << max(0, (row["n"] // BLOCK_ROWS).bit_length() - 1))
        room = target - passes * row["size"]
        listed.append(
            {"source": row["source"], "source_size": row["size"], "target": float(target), "passes": passes,
             "blocks": blocks, "room": float(room)}
        )
    return listed


def _places(cells: DataFrame, listed: list[dict], shards: int, most_blocks: int, rng: np.random.Generator) -> DataFrame:
    """A row per source: where its last pass ends, and how its blocks go to the shards."""
    spark = cells.sparkSession
    fields = "source string, source_size long, target double, passes int, blocks long, room double"
    known = spark.createDataFrame([tuple(x.values()) for x in listed], fields)
    sizes = _with(cells, known).withColumn("block", _block(most_blocks)).groupBy("source", "block", "room").agg(F.sum("size").alias("size"))
    along = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = sizes.withColumn("end", F.sum("size").over(along)).filter("end > room")
    edges = ends.groupBy("source").agg(
        F.min("block").alias("edge"), F.min_by(F.col("end") - F.col("size"), "block").alias("before")
    )
    edge_of = {r["source"]: (r["edge"], r["before"]) for r in edges.collect()}
    quotas = []
    for x in listed:
        x["edge"], before = edge_of.get(x["source"], (x["blocks"], 0))
        x["space"] = x.pop("room") - before
        quotas.append(x["passes"] * x["blocks"] + min(x["edge"] + 1, x["blocks"]))
    ends_at = np.cumsum(split(quotas, shards, rng), axis=0) if quotas else np.zeros((shards, 0), dtype=np.int64)
    for i, x in enumerate(listed):
        x |= {"quota": quotas[i], "step": _coprime(quotas[i], rng), "shift": int(rng.integers(0, quotas[i]))}
        x["ends"] = [int(e) for e in ends_at[:, i]]
    fields = (
        "source string, source_size long, target double, passes int, blocks long, edge long, space double, "
        "quota long, step long, shift long, ends array<long>"
    )
    table = spark.createDataFrame([tuple(x.values()) for x in listed], fields)
    return F.broadcast(table) if len(listed) <= BROADCAST else table


def _fitting(rows: DataFrame) -> DataFrame:
    """Of the block in which a source's last pass ends: the documents that fit, and the nearest one more."""
    order = Window.partitionBy("source").orderBy("hash")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("source")
    taken = rows.withColumn("end", F.sum("size").over(so_far)).withColumn("row", F.row_number().over(order))
    taken = taken.withColumn("fits", F.col("end") <= F.col("space"))
    missing = F.col("space") - F.coalesce(F.max(F.when(F.col("fits"), F.col("end"))).over(whole), F.lit(0))
    taken = taken.withColumn("missing", missing)
    off = F.abs(F.col("missing") - F.col("size"))
    nearest = F.when(~F.col("fits") & (off < F.col("missing")), F.struct(off.alias("off"), F.col("row")))
    taken = taken.withColumn("nearest", F.min(nearest).over(whole))
    one = F.coalesce(F.col("nearest.row") == F.col("row"), F.lit(False))
    return taken.withColumn("more", (F.col("fits") | one).cast("int")).drop("end", "row", "fits", "missing", "nearest")


def mix(docs: DataFrame, seed: int = 8, **options) -> DataFrame:
    """The mix: a row for each copy, with the documents' own columns and ``shard``, the output shard.

    Input columns named ``shard`` or as those that ``plan`` adds are not returned; give them other names to keep them.

    A shard's rows are shuffled: they stand in the order of a hash of the copy, which Spark deals out by range, so a task
    holds a piece of a shard, however large that is. See ``plan`` for the rest; rows without copies are not in the mix.
    """
    added = ["size", "source_size", "target", "copies", "shards"]
    rows = Rows(plan(docs, seed=seed, **options))
    copies = rows.frame.select("*", F.posexplode(rows.of["shards"]).alias("copy", "shard"))
    own = [rows.of[n] for n in rows.names if n not in added]
    copies = copies.withColumn("place", F.xxhash64(F.lit(seed + 1), "copy", *own))
    dealt = copies.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place")
    return dealt.select(*[F.col(rows.of[n]).alias(n) for n in rows.names if n not in added], "shard")
