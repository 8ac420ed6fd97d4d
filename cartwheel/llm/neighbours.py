"""Exact near-duplicate vectors by a metric range join.

The angle between vectors is a metric.  Pivots split the vectors into cells:
each vector lives in the cell of its nearest pivot and visits every other cell
that a partner within the radius could live in.  A partner of ``x`` in the cell
of pivot ``p`` is at least as near to ``p`` as to ``x``'s own pivot ``h``, so it
lies beyond the great circle between the two; the triangle inequality then asks
that ``x`` is within the radius of that circle:
``(x.h - x.p) / |h - p| <= sin(radius)``.

Cells are joined on their own, visitors against inhabitants, so each link is
met exactly once from either end.  Large cells are cut into blocks of bounded
size on both sides and every pair of blocks is a task of its own.  A task gives
the number of links of each visitor and a spanning forest of the links, not the
links themselves, so a group of n copies gives n rows.

Pruning needs structure: vectors in general position of many dimensions are
close to no pivot, visit most cells, and the join approaches all blocks against
all blocks.  Results are exact either way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.components import connected_components
from cartwheel.session import checkpoint_dir, ship_package

SIMILARITY = 0.9
# Inhabitants that a cell should have, and the bound on pivots (they are broadcast).
CELL_ROWS = 8192
MAX_PIVOTS = 1024
# Bound on each side of a task, and on the rows of a product held at a time.
BLOCK_ROWS = 16_384
TILE = (512, 4096)
# Products in single precision decide except this close to the limit.
_DOUBT = 1e-4


def valid_vector(vector: Column) -> Column:
    """The vector in double precision, or null if it is null, empty, zero or has
    null or non-finite components."""
    v = vector.cast("array<double>")
    ok = (F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
          & F.exists(v, lambda x: F.coalesce(x != 0, F.lit(False))))
    return F.when(F.coalesce(ok, F.lit(False)), v)


def choose_pivots(vectors: DataFrame, count: int) -> np.ndarray:
    """At most ``count`` (bounded) unit vectors: the farthest of a seeded sample of
    four times as many, each from those chosen before."""
    rows = vectors.orderBy(F.xxhash64("node")).limit(4 * count).select("v").collect()
    x = _unit(np.array([r.v for r in rows], dtype=float))
    chosen = [0]
    best = x @ x[0]
    while len(chosen) < min(count, len(x)):
        far = int(best.argmin())
        if best[far] > 1 - 1e-9:
            break
        chosen.append(far)
        best = np.maximum(best, x @ x[far])
    return x[chosen]


def _unit(x: np.ndarray) -> np.ndarray:
    # Scale first: squares of very large or small components leave the range.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column, rows: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _block(node: np.ndarray, blocks: int) -> np.ndarray:
    mixed = node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(blocks)).astype(np.int64)


def _visits(u: np.ndarray, pivots: np.ndarray, gaps: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """The home of each vector and the (vector, cell) visits, the home included."""
    near = u @ pivots.T
    home = near.argmax(axis=1)
    short = near[np.arange(len(u)), home][:, None] - near
    return home, short <= reach * gaps[home] + 1e-9


def _deal(pivots, similarity: float, blocks: dict[int, tuple[int, int]] | None):
    """Rows of vectors to rows of (cell, blocks, role); without ``blocks``, to counts."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        gaps = np.sqrt(np.maximum(2 - 2 * (p @ p.T), 0))
        reach = float(np.sqrt(1 - similarity ** 2)) if similarity > 0 else 2.0
        counts = np.zeros((2, len(p)), np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                u = _unit(_matrix(part.column("v"), part.num_rows))
                home, visits = _visits(u, p, gaps, reach)
                if blocks is None:
                    counts[0] += np.bincount(home, minlength=len(p))
                    counts[1] += visits.sum(axis=0)
                    continue
                node = part.column("node").to_numpy(zero_copy_only=False)
                row, cell = np.nonzero(visits)
                at = [(home, np.arange(len(u)), 0), (cell, row, 1)]
                for cells, rows, role in at:
                    sides = np.array([blocks[c] for c in range(len(p))])
                    own = _block(node[rows], sides[cells, role])
                    other = sides[cells, 1 - role]
                    # Each row meets every block of the other side.
                    take = np.repeat(np.arange(len(rows)), other)
                    turn = np.arange(len(take)) - np.repeat(np.cumsum(other) - other, other)
                    mine, theirs = own[take], turn
                    for start in range(0, len(take), 8192):
                        s = slice(start, start + 8192)
                        chosen = pa.array(rows[take[s]])
                        yield pa.RecordBatch.from_arrays([
                            pa.array(cells[take[s]], pa.int32()),
                            pa.array((mine if role == 0 else theirs)[s], pa.int32()),
                            pa.array((theirs if role == 0 else mine)[s], pa.int32()),
                            pa.array(np.full(len(chosen), role), pa.int32()),
                            part.column("node").take(chosen), part.column("copies").take(chosen),
                            part.column("v").take(chosen)],
                            names=["cell", "home_block", "visit_block", "role", "node", "copies", "v"])
        if blocks is None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(p)), pa.int32()), pa.array(counts[0]), pa.array(counts[1])],
                names=["cell", "homes", "visitors"])
    return deal


_DEALT = ("cell int, home_block int, visit_block int, role int, node bigint, copies bigint, v array<double>")
_FOUND = "node bigint, links bigint, root bigint"
_FOUND_ARROW = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _forest(edges_a: np.ndarray, edges_b: np.ndarray, n: int) -> np.ndarray:
    """Least member of each node's component (pointer jumping over given edges)."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[edges_a], label[edges_b])
        np.minimum.at(label, edges_a, low)
        np.minimum.at(label, edges_b, low)
        np.minimum.at(label, before, label)
        label = label[label]
        if (label == before).all():
            return label


def _linked(tile: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what a 0/1 tile connects: rows plus columns of them, not its ones."""
    r, c = np.flatnonzero(tile.any(axis=1)), np.flatnonzero(tile.any(axis=0))
    if not len(r):
        return rows[:0], rows[:0]
    tile, rows, cols = tile[np.ix_(r, c)], rows[r], cols[c]
    if tile.sum() <= 4 * (len(rows) + len(cols)):
        i, j = np.nonzero(tile)
        return rows[i], cols[j]
    big = np.iinfo(np.int64).max
    row_label, col_label = np.arange(len(rows)), np.full(len(cols), big)
    while True:
        new_col = np.where(tile, row_label[:, None], big).min(axis=0)
        new_row = np.where(tile, new_col[None, :], big).min(axis=1)
        if (new_row == row_label).all() and (new_col == col_label).all():
            break
        row_label, col_label = new_row, new_col
    return (np.concatenate([rows, cols]), np.concatenate([rows[row_label], rows[col_label]]))


def _join_blocks(similarity: float):
    def join(table: pa.Table) -> pa.Table:
        role = table.column("role").to_numpy()
        at = [np.flatnonzero(role == k) for k in (0, 1)]
        if not len(at[0]) or not len(at[1]):
            return _FOUND_ARROW.empty_table()
        node = table.column("node").to_numpy()
        copies = table.column("copies").to_numpy()
        u = _unit(_matrix(table.column("v"), table.num_rows))
        small = u.astype(np.float32)
        names, index = np.unique(node, return_inverse=True)
        links = np.zeros(len(names), np.int64)
        ends: list[tuple[np.ndarray, np.ndarray]] = []
        for vlo in range(0, len(at[1]), TILE[0]):
            v = at[1][vlo:vlo + TILE[0]]
            for hlo in range(0, len(at[0]), TILE[1]):
                h = at[0][hlo:hlo + TILE[1]]
                product = small[v] @ small[h].T
                # One pass finds the few visitors that come near the limit at all.
                near = np.flatnonzero(product.max(axis=1) >= similarity - _DOUBT)
                if not len(near):
                    continue
                rows, product = v[near], product[near]
                tile = product >= similarity + _DOUBT
                i, j = np.nonzero((product >= similarity - _DOUBT) & ~tile)
                for lo in range(0, len(i), 65_536):
                    a, b = i[lo:lo + 65_536], j[lo:lo + 65_536]
                    tile[a, b] = (u[rows[a]] * u[h[b]]).sum(axis=1) >= similarity
                tile &= node[rows][:, None] != node[h][None, :]
                if tile.any():
                    links += np.bincount(index[rows], weights=tile @ copies[h], minlength=len(names)).astype(np.int64)
                    ends.append(_linked(tile, index[rows], index[h]))
        if not ends:
            return _FOUND_ARROW.empty_table()
        a, b = (np.concatenate([e[k] for e in ends]) for k in (0, 1))
        label = _forest(a, b, len(names))
        out = np.flatnonzero((links > 0) | (label != np.arange(len(names))))
        return pa.table([pa.array(names[out]), pa.array(links[out]), pa.array(names[label[out]])], schema=_FOUND_ARROW)
    return join


def near_duplicates(df: DataFrame, key: str, vector: str, similarity: float = SIMILARITY,
                    cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows ``(key, n_links, component_id, kept)``, one for each row of ``df``.

    ``n_links`` counts the other rows with cosine of ``similarity`` (above 0) or
    more, ``component_id`` is the least key reachable by links.  Vectors that are
    null, empty, zero or hold null or non-finite components link with nothing.
    Equal vectors are joined once and count as many links as there are rows; of
    vectors of different lengths the shorter counts as followed by zeros.  Rows
    with a null key take part; the least key of their component is the least
    non-null one (null if none) and they are not kept.  Repeated rows are linked
    rows.  Other columns are ignored; an empty table gives an empty result.
    """
    spark = df.sparkSession
    ship_package(spark)
    checkpoint_dir(spark)
    rows = df.select(F.col(key).alias("_id"), valid_vector(F.col(vector)).alias("v"))
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    padded = F.when(F.size("v") < width, F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v")))).otherwise(F.col("v"))
    rows = rows.select("_id", F.when(F.col("v").isNotNull(), padded).alias("v"))
    distinct = (rows.where("v IS NOT NULL").groupBy("v")
                .agg(F.min("_id").alias("first"), F.count(F.lit(1)).alias("copies"))
                .withColumn("node", F.monotonically_increasing_id()).checkpoint())
    total = distinct.count()
    if total == 0:
        return _result(rows.select(F.col("_id"), F.lit(0).cast("bigint").alias("n_links"),
                                   F.col("_id").alias("component_id")), key)
    pivots = spark.sparkContext.broadcast(
        choose_pivots(distinct, max(1, min(MAX_PIVOTS, -(-total // cell_rows)))))
    given = distinct.select("node", "copies", "v")
    # One row for each pivot: how many blocks its cell is cut into.
    sizes = (given.mapInArrow(_deal(pivots, similarity, None), "cell int, homes bigint, visitors bigint")
             .groupBy("cell").agg(F.sum("homes").alias("homes"), F.sum("visitors").alias("visitors")).collect())
    blocks = {r.cell: (max(1, -(-r.homes // block_rows)), max(1, -(-r.visitors // block_rows))) for r in sizes}
    found = (given.mapInArrow(_deal(pivots, similarity, blocks), _DEALT)
             .groupBy("cell", "home_block", "visit_block").applyInArrow(_join_blocks(similarity), _FOUND).checkpoint())
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))
                                 .where("a <> b")).withColumnRenamed("node", "member")
    marked = (distinct.join(parts, distinct["node"] == parts["member"], "left")
              .select("v", "node", "first", "copies", F.coalesce("root", "node").alias("root")))
    least = marked.groupBy("root").agg(F.min("first").alias("component_id"))
    known = (marked.join(least, "root").join(links, "node", "left")
             .select(F.col("v").alias("_v"), "component_id",
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    joined = rows.join(known, rows["v"] == known["_v"], "left")
    return _result(joined.select("_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                                 F.when(F.col("v").isNull(), F.col("_id")).otherwise(F.col("component_id"))
                                 .alias("component_id")), key)


def _result(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col("_id").alias(key), "n_links", "component_id",
                       F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept"))
