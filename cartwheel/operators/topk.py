"""Exact maximum-inner-product top-k, pruned by norms.

``score = bias + bias + <vec, vec>`` is the inner product of the left vector
extended by 1 and the right vector extended by its bias, plus the left bias; by
Cauchy-Schwarz it is at most the left bias plus the product of both norms.

1. The right table is numbered by falling norm and cut into blocks; the driver
   holds one number for each block, its greatest norm.
2. Every left row is scored against the first block where it lies, without a
   shuffle (a block is ``block_rows`` rows, a size that does not grow).  Its k-th
   score so far says which blocks can still hold a better one: the first ``need``.
   Rows that need no other block are done.
3. The others are numbered by ``need`` and cut into left blocks, so that rows of
   like need lie together.  A left block meets the right blocks that it needs, in
   order of falling norm; the left block stays in memory, right rows stream past
   it, and tiles that no row's k-th score admits are skipped.  Only where there are
   many right blocks is a left block dealt to several tasks, one for each
   ``GROUP_BLOCKS`` of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.operators.ranking import dense_codes, global_row_number
from cartwheel.operators.similarity import top_k_per_group
from cartwheel.operators.sizing import materialize
from cartwheel.session import ship_package

# Rows of a right block; a left block holds LEFT_BLOCKS times as many.
BLOCK_ROWS = 8192
LEFT_BLOCKS = 4
# Right blocks that one task streams past a left block.
GROUP_BLOCKS = 16
# Rows of either side that are multiplied at a time.
_TILE = 1024
# Rounding of scores and norms must not prune a block.
_SLACK = 1e-9


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), float)


def _reach(left_norm: np.ndarray, left_bias: np.ndarray, right_norm) -> np.ndarray:
    """Upper bound of a left row's score against right rows of at most that norm."""
    bound = left_bias + left_norm * right_norm
    return bound + _SLACK * (1 + np.abs(left_bias) + left_norm * right_norm)


def _best(row: np.ndarray, score: np.ndarray, code: np.ndarray, k: int) -> np.ndarray:
    """Indices of the first k of each row by falling score, then code; sorted by row."""
    order = np.lexsort((code, -score, row))
    first = np.searchsorted(row[order], row[order], "left")
    return order[np.arange(len(order)) - first < k]


class _Rows:
    """Left rows in memory with their best scores so far."""

    def __init__(self, vectors: np.ndarray, bias: np.ndarray, k: int, kth: np.ndarray | None = None):
        self.vectors, self.bias, self.k = vectors, bias, k
        self.norm = np.sqrt((vectors * vectors).sum(axis=1) + 1.0)
        self.kth = np.full(len(bias), -np.inf) if kth is None else kth
        self.row, self.score = np.zeros(0, np.int64), np.zeros(0)
        self.code, self.key = np.zeros(0, np.int64), np.zeros(0, object)

    def see(self, key: np.ndarray, code: np.ndarray, bias: np.ndarray, vectors: np.ndarray, norm: np.ndarray) -> None:
        """Right rows by falling norm; what cannot reach a row's k-th score is skipped."""
        for lo in range(0, len(key), _TILE):
            hi = lo + _TILE
            live = np.flatnonzero(_reach(self.norm, self.bias, norm[lo]) >= self.kth)
            found = []
            for at in range(0, len(live), _TILE):
                some = live[at:at + _TILE]
                product = self.vectors[some] @ vectors[lo:hi].T
                product += self.bias[some][:, None] + bias[lo:hi][None, :]
                limit = self.kth[some]
                if product.shape[1] > self.k:  # the tile's own k-th score is a limit, too
                    limit = np.maximum(limit, np.partition(product, -self.k, axis=1)[:, -self.k])
                i, j = np.nonzero(product >= limit[:, None])
                found.append((some[i], product[i, j], code[lo:hi][j], key[lo:hi][j]))
            if found:
                self._add(*(np.concatenate(c) for c in zip(*found)))

    def _add(self, row, score, code, key) -> None:
        row, score = np.concatenate([self.row, row]), np.concatenate([self.score, score])
        code, key = np.concatenate([self.code, code]), np.concatenate([self.key, key])
        keep = _best(row, score, code, self.k)
        self.row, self.score, self.code, self.key = row[keep], score[keep], code[keep], key[keep]
        ends = np.flatnonzero(np.append(self.row[1:] != self.row[:-1], True)) if len(self.row) else np.zeros(0, np.int64)
        full = ends[np.diff(np.append(-1, ends)) == self.k]
        self.kth[self.row[full]] = np.maximum(self.kth[self.row[full]], self.score[full])


@dataclass(frozen=True)
class _Seeded:
    """``rows``: left rows (``key``, ``bias``, ``vec``) with ``need``, ``kth`` and ``best``
    against the first block; ``right``: ``key``, ``code``, ``bias``, ``vec``, ``norm``,
    ``place``, ``block``; ``tops``: the blocks' greatest norms."""
    rows: DataFrame
    right: DataFrame
    tops: np.ndarray


def _seeded(left: DataFrame, right: DataFrame, k: int, block_rows: int) -> _Seeded:
    ship_package(left.sparkSession)
    lk, rk = left.columns[0], right.columns[0]
    named = right.select(F.col(rk).alias("key"), "bias", "vec")
    codes = dense_codes(named, "key", "code")
    norm = F.sqrt(F.aggregate("vec", F.col("bias") * F.col("bias"), lambda s, x: s + x * x))
    placed = global_row_number(named.join(codes, "key").withColumn("norm", norm), [F.desc("norm"), F.asc("code")], out="place")
    blocks = materialize(placed.withColumn("block", F.floor((F.col("place") - 1) / block_rows).cast("int")))
    tops = np.array([r["top"] for r in blocks.groupBy("block").agg(F.max("norm").alias("top")).orderBy("block").collect()])
    first = blocks.where("block = 0").orderBy("place").toPandas()
    first_vectors = _matrix(first["vec"]) if len(first) else np.zeros((0, 0))
    kind = right.schema[rk].dataType
    best = T.ArrayType(T.StructType([T.StructField("other", kind), T.StructField("score", T.DoubleType())]))
    schema = T.StructType([T.StructField("key", left.schema[lk].dataType), T.StructField("bias", T.DoubleType()),
                           T.StructField("vec", T.ArrayType(T.DoubleType())), T.StructField("need", T.IntegerType()),
                           T.StructField("kth", T.DoubleType()), T.StructField("best", best)])

    def seed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in parts:
            for lo in range(0, len(whole), _TILE):
                part = whole.iloc[lo:lo + _TILE].reset_index(drop=True)
                rows = _Rows(_matrix(part["vec"]), part["bias"].to_numpy(float), k)
                if len(first):
                    rows.see(first["key"].to_numpy(object), first["code"].to_numpy(), first["bias"].to_numpy(),
                             first_vectors, first["norm"].to_numpy())
                reach = _reach(rows.norm[:, None], rows.bias[:, None], tops[None, :])
                part["need"] = np.maximum((reach >= rows.kth[:, None]).sum(axis=1), min(1, len(tops))).astype("int32")
                part["kth"] = rows.kth
                cuts = np.searchsorted(rows.row, np.arange(len(part) + 1))
                pairs = [{"other": o, "score": s} for o, s in zip(rows.key.tolist(), rows.score.tolist())]
                part["best"] = [pairs[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
                yield part

    rows = left.select(F.col(lk).alias("key"), F.col("bias").cast("double").alias("bias"),
                       F.col("vec").cast("array<double>").alias("vec")).mapInPandas(seed, schema)
    return _Seeded(materialize(rows), blocks, tops)


def _met(seeded: _Seeded, k: int, block_rows: int) -> DataFrame | None:
    """``key``, ``other``, ``score`` from the blocks after the first, or None."""
    spark = seeded.rows.sparkSession
    open_rows = seeded.rows.where("need > 1").select("key", "bias", "vec", "need", "kth")
    if len(seeded.tops) < 2 or open_rows.limit(1).count() == 0:
        return None
    placed = global_row_number(open_rows, [F.col("need"), F.col("key")], out="place")
    placed = materialize(placed.withColumn("lb", F.floor((F.col("place") - 1) / (block_rows * LEFT_BLOCKS)).cast("int")))
    needs = placed.groupBy("lb").agg(F.max("need").alias("block_need"))
    # One number for each left block: needs rise with the block.
    by_block = np.array([r["block_need"] for r in needs.orderBy("lb").collect()])
    group = lambda block: F.floor((block - 1) / GROUP_BLOCKS).cast("int")
    a = placed.join(needs, "lb").select(
        "lb", F.explode(F.sequence(F.lit(0), group(F.col("block_need") - 1))).alias("g"), F.lit(0).alias("side"), "place",
        "key", F.lit(None).cast(seeded.right.schema["key"].dataType).alias("other"), F.lit(None).cast("bigint").alias("code"),
        "bias", "vec", F.col("kth").alias("bound"))
    starts = [(j, int(np.searchsorted(by_block, j, "right"))) for j in range(1, len(seeded.tops))]
    wanted = spark.createDataFrame([(j, s) for j, s in starts if s < len(by_block)], "block int, first_lb int")
    b = seeded.right.join(wanted, "block").select(
        F.explode(F.sequence(F.col("first_lb"), F.lit(len(by_block) - 1))).alias("lb"), group(F.col("block")).alias("g"),
        F.lit(1).alias("side"), "place", F.lit(None).cast(open_rows.schema["key"].dataType).alias("key"),
        F.col("key").alias("other"), "code", "bias", "vec", F.col("norm").alias("bound"))
    cells = a.unionByName(b).repartition("lb", "g").sortWithinPartitions("lb", "g", "side", "place")
    schema = T.StructType([T.StructField("key", open_rows.schema["key"].dataType),
                           T.StructField("other", seeded.right.schema["key"].dataType), T.StructField("score", T.DoubleType())])

    def stream(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, held, rows = None, [], None

        def result() -> Iterator[pd.DataFrame]:
            if rows is not None and len(rows.row):
                yield pd.DataFrame({"key": keys[rows.row], "other": rows.key, "score": rows.score})

        for part in parts:
            marks = part[["lb", "g", "side"]].to_numpy()
            cuts = np.flatnonzero(np.append(True, (marks[1:] != marks[:-1]).any(axis=1)))
            for lo, hi in zip(cuts, np.append(cuts[1:], len(part))):
                some, own = part.iloc[lo:hi], tuple(marks[lo][:2])
                if own != cell:
                    yield from result()
                    cell, held, rows = own, [], None
                if marks[lo][2] == 0:
                    held.append(some)
                    continue
                if rows is None:
                    block = pd.concat(held, ignore_index=True)
                    keys, held = block["key"].to_numpy(object), []
                    rows = _Rows(_matrix(block["vec"]), block["bias"].to_numpy(float), k, block["bound"].to_numpy(float).copy())
                rows.see(some["other"].to_numpy(object), some["code"].to_numpy(np.int64), some["bias"].to_numpy(float),
                         _matrix(some["vec"]), some["bound"].to_numpy(float))
        yield from result()

    return cells.mapInPandas(stream, schema)


def score_top_k(left: DataFrame, right: DataFrame, k: int = 10, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """J8 + W1: the ``k`` best right keys of every left key, ``(left, rank, right, score)``.

    Both tables are ``(key, bias, vec)`` with unique keys; the output has the names
    and types of their keys.  ``score = bias + bias + <vec, vec>``; ties go to the
    smaller right key.  The result does not depend on ``block_rows``.
    """
    lk, rk = left.columns[0], right.columns[0]
    seeded = _seeded(left, right, k, block_rows)
    found = seeded.rows.select("key", F.explode("best").alias("b")).select("key", "b.other", "b.score")
    more = _met(seeded, k, block_rows)
    if more is not None:
        found = found.unionByName(more)
    ranked = top_k_per_group(found, "key", [F.desc("score"), F.asc("other")], k)
    return ranked.select(F.col("key").alias(lk), "rank", F.col("other").alias(rk), "score")


def pruning_report(left: DataFrame, right: DataFrame, k: int = 10, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row: ``row_blocks`` ((left row, right block) pairs), ``needed`` (those that the
    bound after the first block admits) and ``skipped_share``."""
    seeded = _seeded(left, right, k, block_rows)
    n = len(seeded.tops)
    return seeded.rows.agg((F.count(F.lit(1)) * n).alias("row_blocks"), F.coalesce(F.sum("need"), F.lit(0)).alias("needed")).select(
        "row_blocks", "needed", F.when(F.col("row_blocks") > 0, 1 - F.col("needed") / F.col("row_blocks")).alias("skipped_share"))
