"""Near-duplicate vectors by collision counting over one-dimensional projections."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from dqspark.llm.common import group_starts, mapped, meeting, merged, quoted, whole_groups
from dqspark.llm.components import components
from dqspark.session import stored

#: Vectors of one cell that meet in one task, and pairs that are counted together.
GROUP, PIECE = 2048, 200_000
#: Projections on which collisions are counted, and half the width of the query's window.
COUNTED, HALF_WINDOW = 64, 0.5
#: Width of the cells, how many unlike vectors a vector should meet in a cell, and the recall aimed at.
CELL, MEETINGS, RECALL = 2.0, 32, 0.995


def _inside(half: float, spread: float) -> float:
    """P(|x| <= half) for a normal x of that spread."""
    return math.erf(half / spread / math.sqrt(2))


def _same_cell(spread: float) -> float:
    """P(two values whose difference is normal with that spread fall into one cell at a random offset)."""
    tail = spread * math.sqrt(2 / math.pi) * (1 - math.exp(-((CELL / spread) ** 2) / 2))
    return _inside(CELL, spread) - tail / CELL


def plan(vectors: int, least: float) -> dict[str, int]:
    """Projections per cell, number of tables and the count to pass, from the number of distinct vectors.

    Two unit vectors of cosine c have projections whose difference is normal with variance 2 - 2c. Cells of k
    projections keep about ``MEETINGS`` unlike vectors each, whatever the size of the input; so many tables
    that a pair at the threshold misses all with a chance of 1 - RECALL at most. The count is the highest
    that such a pair reaches with the chance of RECALL or more (binomial).
    """
    near, far = math.sqrt(2 - 2 * least), math.sqrt(2)
    k = max(1, math.ceil(math.log(max(2.0, vectors / MEETINGS)) / -math.log(_same_cell(far))))
    tables = math.ceil(math.log(1 - RECALL) / math.log(1 - _same_cell(near) ** k))
    p, below, count = _inside(HALF_WINDOW, near), 0.0, 0
    while (below := below + math.comb(COUNTED, count) * p**count * (1 - p) ** (COUNTED - count)) <= 1 - RECALL:
        count += 1
    return {"k": k, "tables": tables, "count": count}


@lru_cache(maxsize=8)
def _directions(dim: int, k: int, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([20, dim, k, tables])
    return rng.standard_normal((dim, tables * k)), rng.uniform(0, CELL, tables * k), rng.standard_normal((dim, COUNTED))


def _cells(unit: np.ndarray, k: int, tables: int) -> np.ndarray:
    """The cell of each vector in each table: its k projections cut into windows, as one number."""
    across, offsets, _ = _directions(unit.shape[1], k, tables)
    windows = np.floor((unit @ across + offsets) / CELL).astype(np.int64).reshape(len(unit), tables, k)
    odd = np.random.default_rng(21).integers(1, 2**62, k) * 2 + 1
    with np.errstate(over="ignore"):
        return (windows * odd).sum(axis=2) * tables + np.arange(tables) + unit.shape[1]


def _unit(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _by_dim(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.diff(column.offsets.to_numpy())
    for dim in np.unique(sizes):
        yield int(dim), np.flatnonzero(sizes == dim)


def _deal(k: int, tables: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        for dim, rows in _by_dim(batch["vector"]):
            for piece in np.array_split(rows, -(-len(rows) // 2000)):
                own = batch.take(pa.array(piece))
                cells = _cells(_unit(own["vector"], dim), k, tables)
                for table in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [*own.columns, pa.array(cells[:, table]), pa.array(np.full(len(piece), table, dtype=np.int32))],
                        names=["node", "weight", "vector", "cell", "table"],
                    )


def _pairs(starts: np.ndarray, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs a < b of rows of one group, in pieces."""
    ends = np.append(starts[1:], rows)
    after = np.repeat(ends, ends - starts) - np.arange(rows) - 1
    total = np.cumsum(after)
    cuts = np.unique(np.append(np.searchsorted(total, np.arange(0, int(total[-1]) + 1, PIECE), side="left"), rows))
    for begin, end in zip(cuts[:-1], cuts[1:]):
        n = after[begin:end]
        a = np.repeat(np.arange(begin, end), n)
        yield a, a + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _count_and_check(
    least: float, k: int, tables: int, count: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Pairs of a cell: count window collisions, check the cosine of those that pass.

    A pair may share cells of several tables; it is looked at in the first. So each vector's links are added up
    here, and only these sums and about one link per vector leave the task, however dense the cell is.
    """
    keys = ["cell", "table", "low", "high"]
    for table in whole_groups(batches, keys, 4 * GROUP):
        node, weight = table["node"].to_numpy(), table["weight"].to_numpy()
        which, part = table["table"].to_numpy(), table["part"].to_numpy()
        part = np.where(table["low"].to_numpy() == table["high"].to_numpy(), -1, part)
        starts = group_starts(table, keys)
        dims = np.diff(table["vector"].combine_chunks().offsets.to_numpy())
        links, labels = np.zeros(len(node), dtype=np.int64), np.arange(len(node))
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            unit = _unit(table["vector"].take(pa.array(rows)), int(dim))
            cells = _cells(unit, k, tables)
            across = (unit @ _directions(int(dim), k, tables)[2]).astype(np.float32)
            group = np.searchsorted(starts, rows, side="right")
            for a, b in _pairs(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(rows)):
                meant = (part[rows[a]] < 0) | (part[rows[a]] != part[rows[b]])
                a, b = a[meant], b[meant]
                collisions = (np.abs(across[a] - across[b]) <= HALF_WINDOW).sum(axis=1)
                a, b = a[collisions >= count], b[collisions >= count]
                first = (cells[a] == cells[b]).argmax(axis=1) == which[rows[a]]
                a, b = a[first], b[first]
                alike = np.einsum("ij,ij->i", unit[a], unit[b]) >= least
                a, b = rows[a[alike]], rows[b[alike]]
                np.add.at(links, a, weight[b])
                np.add.at(links, b, weight[a])
                labels = merged(labels, a, b)
        found, linked = np.flatnonzero(links), np.flatnonzero(labels != np.arange(len(node)))
        a = np.concatenate([node[found], node[linked]])
        b = pa.array(np.concatenate([node[found], node[labels[linked]]]))
        n = np.concatenate([links[found], np.zeros(len(linked), dtype=np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(n)], names=["a", "b", "n"])


def _usable(id: Column, vector: Column) -> Column:
    """Vectors that can link: no null or non-finite component, and not all zero; and with an id."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x))
    return F.coalesce(id.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", least: float = 0.95) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row: vectors link at a cosine of ``least`` or more.

    Equal vectors are one class, counted before any shuffle of vectors, so copies never meet in pairs. Classes
    that share a cell of any table have their collisions counted: projections on which the other lies in the
    query's window. Pairs with enough collisions are checked by cosine in double precision. See ``plan`` for the
    chances; no link below ``least`` is made, and a pair at exactly ``least`` is missed at about 1 in 100.

    ``n_links`` counts other rows linked directly, ``component_id`` is the smallest id reachable, ``kept`` tells
    if that is the row's own. Vectors that are null, zero or hold null or non-finite components, and rows with a
    null id, link with nothing and are kept. Vectors of unlike length never link. Other columns are left out.
    """
    narrow = rows.select(quoted(id).cast("long").alias("vec_id"), quoted(vector).alias("vector"))
    narrow = narrow.withColumn("usable", _usable(F.col("vec_id"), F.col("vector")))
    classes = narrow.filter("usable").groupBy("vector").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight")
    )
    classes = stored(classes.select("node", "weight", "vector"), "vectors")
    made = plan(classes.count(), least)
    dealt = mapped(
        classes, partial(_deal, made["k"], made["tables"]),
        StructType([*classes.schema.fields, StructField("cell", LongType()), StructField("table", IntegerType())]),
    )
    met = meeting(dealt, "cell", F.col("node"), GROUP, ["node"])
    met = met.select("cell", "table", "low", "high", "part", "node", "weight", "vector")
    check = partial(_count_and_check, least, made["k"], made["tables"], made["count"])
    found = stored(mapped(met, check, "a long, b long, n long"), "vector-links")
    roots = components(found.filter("a != b").select("a", "b"))
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    of_class = classes.join(links, "node", "left").join(roots, "node", "left").select(
        F.col("vector"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("component_id"),
    )
    linked = narrow.filter("usable").select("vec_id", "vector").join(of_class, "vector").select(
        "vec_id", "n_links", "component_id"
    )
    alone = narrow.filter("NOT usable").select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
