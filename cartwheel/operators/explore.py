"""Exploratory aggregates (A1–A28, O1–O5) — the data behind the reference's
charts, as DataFrames.  Histograms and densities are computed with partial
aggregation; nothing is collected to the driver."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions import text as TX
from cartwheel.session import ship_package


def counts_by(df: DataFrame, *keys, order_by_count: bool = False) -> DataFrame:
    """A1/A5: ``groupBy(keys).count()`` (partial + final hash aggregate).

    ``order_by_count`` sorts by count desc, then keys (O2 with a tie-break).
    """
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    if order_by_count:
        out = out.orderBy(F.desc("count"), *[F.asc(k) for k in keys])
    return out


def daily_counts(df: DataFrame, time: str = "event_time", out: str = "event_date") -> DataFrame:
    """A1 + O1: events per calendar day, ordered by day."""
    return (df.groupBy(F.to_date(F.col(time)).alias(out)).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(out))


def daily_average(df: DataFrame, value: str, time: str, out: str = "date") -> DataFrame:
    """A10: average of ``value`` per day (``time`` may be text in ``yyyy-MM-dd HH:mm:ss``)."""
    t = F.col(time)
    day = F.to_date(t) if dict(df.dtypes)[time] != "string" else \
        F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss")).cast("date")
    return (df.groupBy(day.alias(out)).agg(F.avg(F.col(value).try_cast("double")).alias(f"avg_{value}"))
              .orderBy(out))


def avg_and_count(df: DataFrame, key: str, value: str) -> DataFrame:
    """Average and non-NULL count of ``value`` per ``key``."""
    v = F.col(value).try_cast("double")
    return df.groupBy(key).agg(F.avg(v).alias(f"avg_{value}"), F.count(v).alias(f"n_{value}"))


def top_n(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """O3: ``n`` most frequent keys (TakeOrderedAndProject), ties by key."""
    return counts_by(df, key).orderBy(F.desc("count"), F.asc(key)).limit(n)


def describe_long(df: DataFrame, cols: list) -> DataFrame:
    """Count, mean, sample stddev, min, max per column, long form with doubles
    (``describe`` returns strings)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    stacked = F.stack(F.lit(len(cols)), *[
        x for c in cols for x in (F.lit(c), F.col(f"{c}__count"), F.col(f"{c}__mean"),
                                  F.col(f"{c}__stddev"), F.col(f"{c}__min"), F.col(f"{c}__max"))])
    return wide.select(stacked.alias("column", "count", "mean", "stddev", "min", "max"))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Numpy-style fixed-width histogram ``(bin, lo, hi, count)`` with every bin.

    Edges span [min, max]; the last bin is closed; a constant column uses
    [v − 0.5, v + 0.5].  min/max are scalar subqueries; counts are a partial
    aggregate; the bin list is generated from the one-row stats.
    """
    x = F.col(col).cast("double")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    stats = vals.agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
    lo = stats.select(F.when(F.col("mx") == F.col("mn"), F.col("mn") - 0.5).otherwise(F.col("mn"))).scalar()
    hi = stats.select(F.when(F.col("mx") == F.col("mn"), F.col("mx") + 0.5).otherwise(F.col("mx"))).scalar()
    b = F.least(F.floor((F.col("x") - lo) / (hi - lo) * F.lit(bins)).cast("int"), F.lit(bins - 1))
    # The bin is projected first: grouping by an expression that holds scalar
    # subqueries is rejected when the input lineage is non-deterministic.
    counts = vals.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    edges = (stats.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
                  .select("bin", (lo + (hi - lo) * F.col("bin") / F.lit(bins)).alias("lo"),
                          (lo + (hi - lo) * (F.col("bin") + 1) / F.lit(bins)).alias("hi")))
    return (edges.join(counts, "bin", "left")
                 .select("bin", F.round("lo", 9).alias("lo"), F.round("hi", 9).alias("hi"),
                         F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def _kernel_sums(grid_size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the task's Gaussian kernels at each grid point; nothing without values or
    spread."""
    total = None
    for batch in batches:
        x, h, start, step = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        for lo in range(0, len(x), 4096):
            if not h[lo] > 0:
                continue
            z = ((start[lo] + step[lo] * np.arange(grid_size))[None, :] - x[lo:lo + 4096, None]) / h[lo]
            part = np.exp(-0.5 * z * z).sum(axis=0)
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["k"])


def kde(df: DataFrame, col: str, grid_size: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on a ``grid_size``-point grid over
    [min − cut·h, max + cut·h], bandwidth ``h = σ·n^(-1/5)`` (Scott's rule).

    Each task adds up the kernels of its values at the grid points and returns one
    vector; the tasks' vectors are summed by point.  No value is shuffled.
    """
    ship_package(df.sparkSession)
    x = F.col(col).cast("double")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull())
    stats = vals.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
                     F.min("x").alias("mn"), F.max("x").alias("mx"))
    spread = F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    low, high = F.col("mn") - F.lit(cut) * spread, F.col("mx") + F.lit(cut) * spread
    one = stats.select(F.struct("n", spread.alias("h"), low.alias("start"), ((high - low) / F.lit(grid_size - 1)).alias("step")).alias(
        "s")).scalar()
    n, h, start, step = (one[c] for c in ("n", "h", "start", "step"))
    placed = vals.select("x", h.alias("h"), start.alias("start"), step.alias("step"))
    kernels = placed.mapInArrow(functools.partial(_kernel_sums, grid_size), "k array<double>")
    total = kernels.select(F.posexplode("k").alias("point", "s")).groupBy("point").agg(F.sum("s").alias("s"))
    norm = F.try_divide(F.lit(1.0 / math.sqrt(2.0 * math.pi)), n * h)
    return total.select("point", F.round(start + step * F.col("point"), 9).alias("x"),
                        F.round(F.col("s") * norm, 9).alias("density"))


def word_frequencies(df: DataFrame, text: str, n: int = 20, tokens: Column | None = None) -> DataFrame:
    """The ``n`` most frequent whitespace tokens (ties by word)."""
    toks = tokens if tokens is not None else TX.ws_tokens(text)
    words = df.select(F.explode(toks).alias("word"))
    return (words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
                 .orderBy(F.desc("count"), F.asc("word")).limit(n))


def lemma_word_counts(df: DataFrame, text: str, n: int = 20, stop_words=None, lemmas=None) -> DataFrame:
    """A15 over the archived text features: the ``n`` most frequent lemmas of the
    stop-word-free letter tokens.  Tokens are exploded first, so stop-word
    filtering (hash-set ``InSet``) and the lemma lookup run as codegen'd column
    expressions with a partial aggregate before the shuffle."""
    lemmas = lemmas or TX.LEMMAS
    keys = sorted(lemmas)
    m = TX.lemma_map(lemmas)
    w = F.col("w")
    words = (df.select(F.explode(TX.letter_tokens(text)).alias("w"))
               .where(~w.isin(list(stop_words or TX.STOP_WORDS)))
               .select(F.when(w.isin(keys), F.element_at(m, w)).otherwise(w).alias("word")))
    return (words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
                 .orderBy(F.desc("count"), F.asc("word")).limit(n))


def pivot_counts(df: DataFrame, row: str, col: str, values: list, prefix: str) -> DataFrame:
    """Counts of ``row × col`` as a matrix; the column values are given so no
    extra job is needed to discover them, and absent cells are 0."""
    aggs = [F.count(F.when(F.col(col) == v, 1)).alias(f"{prefix}{v}") for v in values]
    return df.groupBy(row).agg(*aggs)


def basket_quantities(df: DataFrame, basket: str, item: str, qty: str) -> DataFrame:
    """Quantity per (basket, item), duplicates summed (sparse; no dense unstack)."""
    return df.groupBy(basket, item).agg(F.sum(qty).alias("qty"))


def correlations(df: DataFrame, cols: list, digits: int = 9) -> DataFrame:
    """Pearson correlation of every column pair, one aggregate, long form."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
                    for a, b in pairs])
    stacked = F.stack(F.lit(len(pairs)), *[x for a, b in pairs
                                            for x in (F.lit(a), F.lit(b), F.col(f"{a}__{b}"))])
    return wide.select(stacked.alias("col_a", "col_b", "corr")).withColumn(
        "corr", F.round("corr", digits))


# Registers of a distinct-count sketch: 2^12, for a standard error of 1.04 / 2^6.
SKETCH_BITS = 12


def distinct_sketches(df: DataFrame, group: str, value: str, bits: int = SKETCH_BITS) -> DataFrame:
    """A4, mergeable: one HyperLogLog sketch of the distinct ``value`` for each ``group``
    (``group``, ``sketch`` binary of bounded size), to be stored and merged later.
    Null values are not counted."""
    return df.groupBy(group).agg(F.hll_sketch_agg(F.col(value), bits).alias("sketch"))


def merged_distinct(sketches: DataFrame, *keys, sketch: str = "sketch") -> DataFrame:
    """Distinct counts over groups of stored sketches: ``keys`` and ``estimate``."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias("estimate"))
