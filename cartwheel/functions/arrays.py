"""Array / struct / vector functions (F14–F21, F24, F28) as higher-order
expressions — no Python UDFs for vector arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zeros(dim: int) -> Column:
    """constant zero vector ``array<float>`` of length ``dim``."""
    return F.array_repeat(F.lit(0.0).cast("float"), dim)


def null_to_zeros(c, dim: int) -> Column:
    """NULL vector → zeros."""
    return F.coalesce(_col(c), zeros(dim))


def guard_dim(c, dim: int) -> Column:
    """keep the vector only when it is non-NULL with exactly ``dim`` entries."""
    v = _col(c)
    return F.when(v.isNotNull() & (F.size(v) == dim), v).otherwise(zeros(dim))


def mean_arrays(*cols, dim: int) -> Column:
    """element-wise mean of the non-NULL, non-empty inputs; zeros when all are empty.

    Inputs of unequal length raise an error instead of being truncated.  One
    fold over the inputs: each of them is evaluated once, however it is made.
    """
    arrs = F.filter(F.array(*[_col(c).cast("array<double>") for c in cols]),
                    lambda a: a.isNotNull() & (F.size(a) > 0))
    unequal = F.raise_error(F.lit("mean_arrays: vectors of unequal length")).cast("array<double>")

    def add(acc: Column, a: Column) -> Column:
        total = (F.when(acc["n"] == 0, a).when(F.size(acc["s"]) != F.size(a), unequal)
                  .otherwise(F.zip_with(acc["s"], a, lambda x, y: x + y)))
        return F.struct((acc["n"] + 1).alias("n"), total.alias("s"))

    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<double>").alias("s"))
    return F.aggregate(arrs, start, add, lambda acc: F.when(acc["n"] == 0, zeros(dim)).otherwise(
        F.transform(acc["s"], lambda x: x / acc["n"]).cast("array<float>")))


def explode_nonempty(c) -> Column:
    """one row per element; NULL and empty arrays give no row."""
    return F.explode(_col(c))


def struct_field(c, field: str) -> Column:
    """``transform(arr, s -> s.field)``."""
    return F.transform(_col(c), lambda s: s[field])


def join_words(c, sep: str = " ") -> Column:
    """F16: array → text; NULL array → ''."""
    return F.concat_ws(sep, _col(c))


def keep_scored(labels, scores, threshold: float) -> Column:
    """labels whose paired score is strictly above ``threshold``."""
    zipped = F.arrays_zip(_col(labels).alias("label"), _col(scores).alias("score"))
    return F.transform(F.filter(zipped, lambda x: x["score"] > threshold), lambda x: x["label"])


def overlap_size(a, b) -> Column:
    """size of the set intersection."""
    return F.size(F.array_intersect(_col(a), _col(b)))


def at_least_pairs(c, n: int = 2) -> Column:
    """itemset size filter."""
    return F.size(_col(c)) >= n


def items_text(c) -> Column:
    """Array → ``[a b c]`` text (CSV form of an itemset, sorted)."""
    return F.concat(F.lit("["), F.array_join(F.array_sort(_col(c)).cast("array<string>"), " "),
                    F.lit("]"))
