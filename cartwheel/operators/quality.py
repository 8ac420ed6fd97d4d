"""Data-quality checks (Q1–Q11).

Every check returns a tidy DataFrame ``(check, target, status, value,
threshold, detail)``; checks over data are single aggregates (one job for
all columns), schema checks read only metadata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT = T.StructType([
    T.StructField("check", T.StringType(), False),
    T.StructField("target", T.StringType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("threshold", T.DoubleType(), True),
    T.StructField("detail", T.StringType(), True),
])


def _rows(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame(rows, RESULT)


def schema_check(df: DataFrame, expected: T.StructType, strict: bool = False) -> DataFrame:
    """Q1: field count, then per position name, type class and nullability.

    ``strict=False`` compares type classes (array vs array) like the reference;
    ``strict=True`` compares full types.
    """
    rows = []
    actual = df.schema.fields
    if len(actual) != len(expected.fields):
        rows.append(("schema_field_count", None, "fail", float(len(actual)),
                     float(len(expected.fields)), "field count differs"))
    for pos, (a, e) in enumerate(zip(actual, expected.fields)):
        same_type = a.dataType == e.dataType if strict else type(a.dataType) is type(e.dataType)
        ok = a.name == e.name and same_type and a.nullable == e.nullable
        rows.append(("schema_field", e.name, "pass" if ok else "fail", float(pos), None,
                     f"{a.name}:{a.dataType.simpleString()}:{a.nullable} vs "
                     f"{e.name}:{e.dataType.simpleString()}:{e.nullable}"))
    return _rows(df.sparkSession, rows)


def type_check(df: DataFrame, expected: dict) -> DataFrame:
    """Q4: expected type per column name; missing columns are reported."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for name, typ in expected.items():
        if name not in actual:
            rows.append(("data_type", name, "fail", None, None, "missing column"))
        else:
            rows.append(("data_type", name, "pass" if actual[name] == typ else "fail", None, None,
                         f"{actual[name]} vs {typ}"))
    return _rows(df.sparkSession, rows)


def null_fractions(df: DataFrame, threshold: float = 0.5, cols: list | None = None) -> DataFrame:
    """Q2: NULL fraction of every column in one aggregate; ``> threshold`` fails.

    An empty table yields status ``empty`` (the reference only warns).
    """
    cols = cols or df.columns
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    long = wide.unpivot([], cols, "target", "value")
    return long.select(
        F.lit("null_fraction").alias("check"), "target",
        F.when(F.col("value").isNull(), F.lit("empty"))
         .when(F.col("value") > threshold, F.lit("fail")).otherwise(F.lit("pass")).alias("status"),
        F.col("value"), F.lit(float(threshold)).alias("threshold"),
        F.lit(None).cast("string").alias("detail"))


def duplicate_count(df: DataFrame, subset: list | None = None) -> DataFrame:
    """Q3: ``rows − distinct rows`` over ``subset`` in one aggregation job.

    NULL keys group together, as in ``dropDuplicates``.  Text is grouped by its
    SHA-256, so no whole text is shuffled.
    """
    subset = subset or df.columns
    keys = [F.sha2(F.col(c), 256).alias(c) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c)
            for c in subset]
    per_key = df.select(*keys).groupBy(*subset).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct")).select(
        F.coalesce(F.col("n_rows"), F.lit(0)).cast("long").alias("n_rows"),
        F.col("n_distinct"),
        (F.coalesce(F.col("n_rows"), F.lit(0)) - F.col("n_distinct")).cast("long").alias("duplicates"))


def row_count(df: DataFrame, min_count: int = 1) -> DataFrame:
    """Q5: row-count floor."""
    return df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("row_count").alias("check"), F.lit(None).cast("string").alias("target"),
        F.when(F.col("n") >= min_count, "pass").otherwise("fail").alias("status"),
        F.col("n").cast("double").alias("value"), F.lit(float(min_count)).alias("threshold"),
        F.lit(None).cast("string").alias("detail"))


def range_checks(df: DataFrame, date_rules: dict | None = None, numeric_rules: dict | None = None,
                 date_format: str | None = None) -> DataFrame:
    """Q6/Q7: per rule, the number of values that are unparsable or out of range.

    ``date_rules``: column → (low, high) dates; ``numeric_rules``: column → (low, high).
    All rules are evaluated in a single aggregate; NULL values are not counted.
    """
    aggs, names = [], []
    for c, (lo, hi) in (date_rules or {}).items():
        v = F.col(c)
        if date_format is not None:
            parsed = F.try_to_timestamp(v.cast("string"), F.lit(date_format))
        else:
            parsed = F.col(c).cast("timestamp")
        d = F.to_date(parsed)
        bad = F.when(v.isNotNull() & (parsed.isNull() | (d < F.lit(lo).cast("date"))
                                      | (d > F.lit(hi).cast("date"))), 1)
        aggs += [F.count(bad).alias(f"bad_{len(names)}"), F.count(v).alias(f"n_{len(names)}")]
        names.append(("date_range", c, f"{lo}..{hi}"))
    for c, (lo, hi) in (numeric_rules or {}).items():
        v = F.col(c).try_cast("double")
        bad = F.when(F.col(c).isNotNull() & (v.isNull() | (v < lo) | (v > hi)), 1)
        aggs += [F.count(bad).alias(f"bad_{len(names)}"), F.count(F.col(c)).alias(f"n_{len(names)}")]
        names.append(("numeric_range", c, f"{lo}..{hi}"))
    wide = df.agg(*aggs)
    parts = [wide.select(F.lit(chk).alias("check"), F.lit(col).alias("target"),
                         F.when(F.col(f"bad_{i}") == 0, "pass").otherwise("fail").alias("status"),
                         F.col(f"bad_{i}").cast("double").alias("value"),
                         F.col(f"n_{i}").cast("double").alias("threshold"),
                         F.lit(detail).alias("detail"))
             for i, (chk, col, detail) in enumerate(names)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _columns_check(df: DataFrame, name: str, required: list) -> list:
    missing = sorted(set(required) - set(df.columns))
    return [(name, ",".join(required), "pass" if not missing else "fail", float(len(missing)), 0.0,
             "missing: " + ",".join(missing) if missing else None)]


def cosine_output_check(wide: DataFrame, k: int = 10, key: str = "item") -> DataFrame:
    """Q8: non-empty, key NULLs, key duplicates, Rec/Score columns, NULLs per Rec,
    numeric Scores — data checks in one aggregate."""
    spark = wide.sparkSession
    rec_cols = [f"Rec_{i}" for i in range(1, k + 1)]
    score_cols = [f"Score_{i}" for i in range(1, k + 1)]
    meta = _columns_check(wide, "cosine_columns", [key] + rec_cols + score_cols)
    non_numeric = [c for c in score_cols if c in wide.columns
                   and not isinstance(wide.schema[c].dataType, T.NumericType)]
    meta.append(("cosine_score_types", None, "pass" if not non_numeric else "fail",
                 float(len(non_numeric)), 0.0, ",".join(non_numeric) or None))
    present = [c for c in rec_cols if c in wide.columns]
    stats = wide.agg(F.count(F.lit(1)).alias("n"), F.count(F.col(key)).alias("n_key"),
                     F.count_distinct(F.col(key)).alias("n_distinct"),
                     *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in present])
    checks = [stats.select(F.lit("non_empty").alias("check"), F.lit(None).cast("string").alias("target"),
                           F.when(F.col("n") > 0, "pass").otherwise("fail").alias("status"),
                           F.col("n").cast("double").alias("value"), F.lit(1.0).alias("threshold"),
                           F.lit(None).cast("string").alias("detail")),
              stats.select(F.lit("key_nulls"), F.lit(key),
                           F.when(F.col("n") == F.col("n_key"), "pass").otherwise("fail"),
                           (F.col("n") - F.col("n_key")).cast("double"), F.lit(0.0),
                           F.lit(None).cast("string")),
              stats.select(F.lit("key_duplicates"), F.lit(key),
                           F.when(F.col("n_key") == F.col("n_distinct"), "pass").otherwise("fail"),
                           (F.col("n_key") - F.col("n_distinct")).cast("double"), F.lit(0.0),
                           F.lit(None).cast("string"))]
    checks += [stats.select(F.lit("rec_nulls"), F.lit(c), F.lit("info"),
                            F.col(f"null_{c}").cast("double"), F.lit(None).cast("double"),
                            F.lit(None).cast("string")) for c in present]
    out = _rows(spark, meta)
    for c in checks:
        out = out.union(c)
    return out


def model_output_check(df: DataFrame, name: str, required: list) -> DataFrame:
    """Q9/Q10/Q11: required columns and non-empty output (FP-Growth, ALS, NCF)."""
    meta = _rows(df.sparkSession, _columns_check(df, f"{name}_columns", required))
    non_empty = df.limit(1).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(f"{name}_non_empty").alias("check"), F.lit(None).cast("string").alias("target"),
        F.when(F.col("n") > 0, "pass").otherwise("fail").alias("status"),
        F.col("n").cast("double").alias("value"), F.lit(1.0).alias("threshold"),
        F.lit(None).cast("string").alias("detail"))
    return meta.union(non_empty)
