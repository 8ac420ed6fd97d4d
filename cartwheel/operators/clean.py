"""Projections, filters, NULL handling, de-duplication and sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.operators.ranking import global_row_number
from cartwheel.sources.schemas import VALID_EVENTS


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename columns; names that are absent are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def sanitize_names(df: DataFrame) -> DataFrame:
    """Spaces and dots in column names become underscores."""
    return df.toDF(*[c.replace(" ", "_").replace(".", "_") for c in df.columns])


def positive(df: DataFrame, col: str = "price", above: float = 0) -> DataFrame:
    """Keep rows with ``col > above`` (NULL is dropped too)."""
    return df.where(F.col(col) > above)


def of_type(df: DataFrame, value: str = "purchase", col: str = "event_type") -> DataFrame:
    """Equality filter."""
    return df.where(F.col(col) == value)


def valid_events(df: DataFrame, col: str = "event_type", allowed=None) -> DataFrame:
    """P5: membership filter on the allowed event types."""
    return df.where(F.col(col).isin(list(allowed or VALID_EVENTS)))


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns; missing ones are ignored."""
    return df.drop(*cols)


def fill_nulls(df: DataFrame, values: dict) -> DataFrame:
    """Per-column NULL replacement."""
    return df.fillna({k: v for k, v in values.items() if k in df.columns})


def drop_null_rows(df: DataFrame, subset: list | None = None) -> DataFrame:
    """P8 (any column) / P9 (subset)."""
    return df.na.drop(how="any", subset=subset)


def exact_dedup(df: DataFrame) -> DataFrame:
    """P10: exact row de-duplication (partial aggregate before the shuffle)."""
    return df.dropDuplicates()


def key_dedup(df: DataFrame, keys: list, order: list) -> DataFrame:
    """One row per key — the row that is smallest in ``order``.

    Written as ``min_by`` over a struct, which aggregates partially on the map
    side, so a hot key sends one row per task instead of being sorted whole in
    one task as a window would.  A struct buffer makes Spark plan a sort
    aggregate: each task sorts its rows by key before the partial aggregate.
    """
    rest = [c for c in df.columns if c not in keys]
    order_key = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    best = F.min_by(F.struct(*[F.col(c) for c in rest]), order_key).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def with_constant(df: DataFrame, name: str = "product_quantity", value=1) -> DataFrame:
    """P12."""
    return df.withColumn(name, F.lit(value))


def distinct_pairs(df: DataFrame, *cols: str) -> DataFrame:
    """P14."""
    return df.select(*cols).distinct()


def non_null_values(df: DataFrame, col: str) -> DataFrame:
    """The non-NULL values of one column."""
    return df.select(col).where(F.col(col).isNotNull())


def outliers_removed(df: DataFrame, col: str, n_sigma: float = 3.0) -> DataFrame:
    """Keep ``mean − nσ < x < mean + nσ`` (strict, sample stddev).

    The mean and σ are scalar subqueries: Spark runs the one-row aggregate
    once and filters with the result — no collect, no join.
    """
    stats = df.select(F.avg(col).alias("m"), F.stddev_samp(col).alias("s"))
    mean = stats.select("m").scalar()
    sd = stats.select("s").scalar()
    x = F.col(col)
    return df.where((x > mean - F.lit(n_sigma) * sd) & (x < mean + F.lit(n_sigma) * sd))


def split_random(df: DataFrame, weights=(0.8, 0.2), seed: int = 42):
    """Bernoulli split per partition (``randomSplit``)."""
    return df.randomSplit(list(weights), seed=seed)


def hash_order(*keys) -> Column:
    """Deterministic pseudo-random order key: md5 of the key columns."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def stratified_sample(df: DataFrame, strata: str, fractions: dict, key_cols: list,
                      seed: int = 42) -> DataFrame:
    """Keep ``round(f·n)`` rows of each stratum, chosen in md5(seed|key) order.

    Strata missing from ``fractions`` are kept whole.  The count is exact and
    the choice reproducible across partitionings.
    """
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key_cols]))
    frac_map = F.create_map(*[x for k, v in fractions.items() for x in (F.lit(k), F.lit(float(v)))])
    ranked = global_row_number(df.withColumn("_o", order), [F.col("_o")] + [F.col(k) for k in key_cols],
                               [strata], out="_rn")
    sizes = df.groupBy(strata).agg(F.count(F.lit(1)).alias("_n"))
    frac = F.coalesce(F.try_element_at(frac_map, F.col(strata)), F.lit(1.0))
    return (ranked.join(sizes, strata)
                  .where(F.col("_rn") <= F.bround(frac * F.col("_n")))
                  .drop("_o", "_rn", "_n"))


def require_columns(df: DataFrame, *cols: str) -> DataFrame:
    """P20: eager schema check (no Spark job)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the frame has {df.columns}")
    return df


def with_truth(df: DataFrame, truth: DataFrame, key: str) -> DataFrame:
    """Rows whose key has ground truth (semi-join)."""
    return df.join(truth.select(key).distinct(), key, "left_semi")
