"""Quality checks and exploratory aggregates."""

import math

import numpy as np
from pyspark.sql import functions as F

from cartwheel.operators import explore as X
from cartwheel.operators import quality as Q
from cartwheel.sources import schemas


def test_null_fractions_one_job_and_empty(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = {r.target: (r.status, round(r.value, 6)) for r in Q.null_fractions(df, 0.5).collect()}
    assert got == {"a": ("pass", round(1 / 3, 6)), "b": ("fail", round(2 / 3, 6))}
    empty = df.limit(0)
    assert {r.status for r in Q.null_fractions(empty).collect()} == {"empty"}


def test_duplicates_with_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (None, None), (2, "b")], "x int, y string")
    r = Q.duplicate_count(df).first()
    assert (r.n_rows, r.n_distinct, r.duplicates) == (5, 3, 2)


def test_schema_and_type_checks(spark):
    df = spark.createDataFrame([], schemas.MAPPING)
    assert {r.status for r in Q.schema_check(df, schemas.MAPPING).collect()} == {"pass"}
    other = spark.createDataFrame([(1,)], "x long")
    statuses = [r.status for r in Q.schema_check(other, schemas.MAPPING).collect()]
    assert "fail" in statuses
    tc = {r.target: r.status for r in Q.type_check(other, {"x": "bigint", "y": "int"}).collect()}
    assert tc == {"x": "pass", "y": "fail"}


def test_range_checks_and_row_count(spark):
    df = spark.createDataFrame([("2024-01-05 00:00:00", 5.0), ("1999-01-01 00:00:00", -1.0), (None, None)],
                               "t string, v double").withColumn("t", F.to_timestamp("t"))
    got = {r.target: r.value for r in Q.range_checks(df, {"t": ("2024-01-01", "2024-12-31")},
                                                        {"v": (0.0, 10.0)}).collect()}
    assert got == {"t": 1.0, "v": 1.0}
    assert Q.row_count(df, 4).first().status == "fail"


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(0)
    vals = rng.gamma(2.0, 3.0, 500).round(2)
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "x double")
    got = [r["count"] for r in X.histogram(df, "x", 50).orderBy("bin").collect()]
    exp, _ = np.histogram(vals, bins=50)
    assert got == exp.tolist()
    const = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    h = X.histogram(const, "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in h] == [0, 0, 2, 0] and h[0].lo == 1.5


def test_kde_matches_formula(spark):
    vals = [1.0, 2.0, 2.0, 4.0, 7.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    out = X.kde(df, "x", grid_size=11).orderBy("point").collect()
    n, sd = len(vals), float(np.std(vals, ddof=1))
    h = sd * n ** -0.2
    for r in out:
        exp = sum(math.exp(-0.5 * ((r.x - v) / h) ** 2) for v in vals) / (n * h * math.sqrt(2 * math.pi))
        assert abs(r.density - exp) < 1e-8


def test_word_frequencies_ties_by_word(spark):
    df = spark.createDataFrame([("b a c",), ("a b",), (None,)], "t string")
    got = [(r.word, r["count"]) for r in X.word_frequencies(df, "t", 2).collect()]
    assert got == [("a", 2), ("b", 2)]


def test_describe_pivot_corr(spark):
    df = spark.createDataFrame([(1, "x", 1.0, 2.0), (2, "y", 2.0, 4.0), (3, "x", 3.0, 6.5)],
                               "id int, k string, a double, b double")
    d = {r.column: r for r in X.describe_long(df, ["a"]).collect()}
    assert d["a"]["count"] == 3 and d["a"].mean == 2.0 and d["a"].stddev == 1.0
    p = {r.k: (r.v_1, r.v_2) for r in X.pivot_counts(df.withColumn("v", F.col("id") % 2 + 1), "k", "v",
                                                      [1, 2], "v_").collect()}
    assert p == {"x": (0, 2), "y": (1, 0)}
    c = X.correlations(df, ["a", "b"]).first()
    assert (c.col_a, c.col_b) == ("a", "b") and c.corr > 0.99


def test_kde_of_many_parts_of_constant_and_of_no_values(spark):
    rng = np.random.default_rng(1)
    vals = rng.normal(size=9000)
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "x double").repartition(5)
    out = X.kde(df, "x").orderBy("point").collect()
    h = float(np.std(vals, ddof=1)) * len(vals) ** -0.2
    want = [np.exp(-0.5 * ((r.x - vals) / h) ** 2).sum() / (len(vals) * h * math.sqrt(2 * math.pi)) for r in out]
    assert len(out) == 200 and np.allclose([r.density for r in out], want, atol=1e-8)
    assert X.kde(df.limit(0), "x").count() == 0
    assert X.kde(spark.createDataFrame([(2.0,)] * 3, "x double"), "x").count() == 0


def test_sketches_merge_to_the_distinct_count_of_the_range(spark):
    df = spark.range(60_000).selectExpr("id % 7 AS day", "id % 20000 AS user", "id % 3 AS week")
    daily = X.distinct_sketches(df.unionByName(df), "day", "user")
    assert daily.count() == 7
    whole = X.merged_distinct(daily).first().estimate
    assert abs(whole - 20_000) <= 3 * 1.04 / 64 * 20_000
    by_half = {r.late: r.estimate for r in X.merged_distinct(daily, (F.col("day") > 3).alias("late")).collect()}
    exact = {late: len({i % 20000 for i in range(60_000) if (i % 7 > 3) == late}) for late in (False, True)}
    assert all(abs(by_half[k] - n) <= 3 * 1.04 / 64 * n for k, n in exact.items())
    nulls = spark.createDataFrame([(1, None), (1, 5), (2, None)], "day int, user bigint")
    assert X.merged_distinct(X.distinct_sketches(nulls, "day", "user")).first().estimate == 1
