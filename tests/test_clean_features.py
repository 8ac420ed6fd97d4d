"""Cleaning operators, features and global ranking on hand-made frames."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.operators import clean as C
from cartwheel.operators import features as FE
from cartwheel.operators.ranking import dense_codes, global_row_number


def test_rename_sanitize_drop(spark):
    df = spark.createDataFrame([(1, 2.0)], "`product id` int, `a.b` double")
    out = C.sanitize_names(df)
    assert out.columns == ["product_id", "a_b"]
    assert C.rename(out, {"product_id": "pid", "missing": "x"}).columns == ["pid", "a_b"]
    assert C.drop_columns(out, "a_b", "missing").columns == ["product_id"]


def test_filters_and_nulls(spark):
    df = spark.createDataFrame([(1, 5.0, "view"), (2, 0.0, "cart"), (3, None, "signup"), (4, -1.0, None)],
                               "id int, price double, event_type string")
    assert [r.id for r in C.positive(df).collect()] == [1]
    assert sorted(r.id for r in C.valid_events(df).collect()) == [1, 2]
    assert C.drop_null_rows(df).count() == 2
    assert C.drop_null_rows(df, ["price"]).count() == 3
    filled = C.fill_nulls(df, {"event_type": "none", "nope": 1}).where("id = 4").first()
    assert filled.event_type == "none"


def test_key_dedup_is_deterministic(spark):
    rows = [(1, "a", 3, "x"), (1, "a", 1, "y"), (1, "a", 2, "z"), (2, "b", 5, "w"), (None, None, 0, "n")]
    df = spark.createDataFrame(rows, "k1 int, k2 string, t int, v string").repartition(3)
    out = {(r.k1, r.k2): (r.t, r.v) for r in C.key_dedup(df, ["k1", "k2"], ["t"]).collect()}
    assert out == {(1, "a"): (1, "y"), (2, "b"): (5, "w"), (None, None): (0, "n")}


def test_outliers_removed_strict(spark):
    vals = [10.0] * 20 + [1000.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    kept = [r.x for r in C.outliers_removed(df, "x").collect()]
    assert 1000.0 not in kept and len(kept) == 20


def test_stratified_sample_exact_counts(spark):
    df = spark.createDataFrame([(i, 1 if i % 3 else 3) for i in range(300)], "id int, score int")
    out = C.stratified_sample(df, "score", {1: 0.1}, ["id"])
    counts = {r.score: r["count"] for r in out.groupBy("score").count().collect()}
    assert counts == {1: 20, 3: 100}
    again = sorted(r.id for r in C.stratified_sample(df.repartition(7), "score", {1: 0.1}, ["id"]).collect())
    assert again == sorted(r.id for r in out.collect())


def test_global_row_number_equals_window(spark):
    df = spark.createDataFrame([(i % 4, (i * 37) % 101, i) for i in range(400)], "g int, o int, id int")
    got = global_row_number(df, [F.col("o"), F.col("id")], ["g"], num_partitions=5)
    w = Window.partitionBy("g").orderBy("o", "id")
    exp = df.withColumn("rn", F.row_number().over(w))
    assert sorted(map(tuple, got.select("id", "rn").collect())) == sorted(map(tuple, exp.select("id", "rn").collect()))


def test_dense_codes_sorted(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "u string")
    codes = {r.u: r.u_code for r in dense_codes(df, "u").collect()}
    assert codes == {"a": 0, "b": 1, "c": 2}


def test_engagement_index_ties_alphabetical_and_null_raises(spark):
    df = spark.createDataFrame([("view",), ("view",), ("cart",), ("purchase",)], "event_type string")
    idx = {r.event_type: r.event_type_index for r in FE.engagement_index(df).collect()}
    assert idx == {"view": 0.0, "cart": 1.0, "purchase": 2.0}
    fixed = FE.engagement_index(df, mapping={"view": 0, "cart": 1, "remove_from_cart": 2, "purchase": 3})
    assert {r.event_type: r.event_type_index for r in fixed.collect()}["purchase"] == 3.0
    bad = spark.createDataFrame([("view",), (None,)], "event_type string")
    with pytest.raises(Exception):
        FE.engagement_index(bad).collect()


def test_predictor_features_null_session(spark):
    rows = [("s1", 1, "c1", "purchase", "2024-01-30 10:00:00"), ("s1", 2, "c2", "view", "2024-01-30 11:00:00"),
            ("s1", 1, None, "view", "2024-01-29 11:00:00"), (None, 3, "c3", "view", "2024-01-28 00:00:00")]
    df = spark.createDataFrame(rows, "user_session string, product_id int, category_code string, "
                                     "event_type string, t string").withColumn("event_time", F.to_timestamp("t"))
    out = FE.predictor_features(df, as_of="2024-02-01").orderBy("t").collect()
    null_row = out[0]
    assert null_row.user_session is None and null_row.frequency is None and null_row.session_diversity is None
    s1 = [r for r in out if r.user_session == "s1"]
    assert {r.frequency for r in s1} == {3} and {r.session_diversity for r in s1} == {2}
    assert {r.product_id: r.popularity for r in out}[2] is None
    assert {r.product_id: r.popularity for r in out}[1] == 1
    assert out[-1].recency == 2


def test_price_scaled_unit_variance_and_constant(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "price double")
    vals = [r.price_scaled for r in FE.price_scaled(df).orderBy("price").collect()]
    assert [round(v, 9) for v in vals] == [1.0, 2.0, 3.0]  # sample stddev = 1, no centring
    const = spark.createDataFrame([(5.0,), (5.0,)], "price double")
    assert [r.price_scaled for r in FE.price_scaled(const).collect()] == [0.0, 0.0]


def test_type_reviews_bad_text_is_null(spark):
    df = spark.createDataFrame([("12.5", "abc", "3", "7")], "mrp string, review_price string, "
                                                             "product_rating string, product_rating_count string")
    r = FE.type_reviews(df).first()
    assert (r.mrp, r.review_price, r.product_rating, r.product_rating_count) == (12.5, None, 3.0, 7)


def test_require_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        C.require_columns(df, "cosmetic_price")


def test_mapped_first_events_equals_join_then_dedup(spark):
    reviews = spark.createDataFrame([(10, 1, "r10"), (11, 1, "r11"), (12, 2, "r12"), (13, 9, "r13")],
                                    "review_id int, product_id int, t string")
    mapping = spark.createDataFrame([(5, 1), (5, 1), (6, 2), (7, 2)], "product_id_events int, product_id_reviews int")
    events = spark.createDataFrame(
        [(100, 5, "view", "2024-01-02 00:00:00"), (101, 5, "cart", "2024-01-01 00:00:00"),
         (102, 5, "purchase", "2024-01-01 00:00:00"), (103, 6, "view", "2024-01-03 00:00:00"),
         (104, None, "view", "2024-01-01 00:00:00")],
        "event_id int, product_id int, event_type string, ts string").withColumn("event_time", F.to_timestamp("ts"))
    got = {(r.review_product_id, r.cosmetic_product_id): (r.review_id, r.event_id)
           for r in FE.mapped_first_events(reviews, mapping, events, ["review_id"],
                                           ["event_id", "event_type", "event_time"]).collect()}
    joined = FE.mapped_reviews(reviews, mapping, events)
    brute = C.key_dedup(joined.select("review_product_id", "cosmetic_product_id", "review_id", "event_id",
                                      "event_time"),
                        ["review_product_id", "cosmetic_product_id"], ["event_time", "event_id", "review_id"])
    exp = {(r.review_product_id, r.cosmetic_product_id): (r.review_id, r.event_id) for r in brute.collect()}
    assert got == exp == {(1, 5): (10, 101), (2, 6): (12, 103)}


def test_predictor_features_approximate_diversity(spark):
    rows = [("s1", 1, f"c{i % 5}", "view", "2024-01-30 10:00:00") for i in range(20)]
    df = spark.createDataFrame(rows, "user_session string, product_id int, category_code string, "
                                     "event_type string, t string").withColumn("event_time", F.to_timestamp("t"))
    out = FE.predictor_features(df, as_of="2024-02-01", approximate_diversity=True).first()
    assert out.session_diversity == 5 and out.frequency == 20


def test_pairs_values_splits_and_truth(spark):
    from cartwheel.operators import clean as C
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    assert sorted(map(tuple, C.distinct_pairs(df, "k", "v").collect()), key=str) == [(1, "a"), (2, None), (3, "c")]
    assert sorted(r.v for r in C.non_null_values(df, "v").collect()) == ["a", "a", "c"]
    assert sorted(r.k for r in C.with_truth(df, spark.createDataFrame([(1,), (1,), (3,)], "k int"), "k").collect()) == [1, 1, 3]
    big = spark.range(4000).repartition(4)
    train, test = C.split_random(big, (0.8, 0.2), seed=1)
    assert train.count() + test.count() == 4000 and train.intersect(test).count() == 0
    assert 600 < test.count() < 1000


def test_csv_scan_with_declared_schema(spark, scratch_dir):
    import os

    from cartwheel.sources import schemas, tables
    path = os.path.join(scratch_dir, "mapping.csv")
    with open(path, "w") as f:
        f.write("product_id_events,product_id_reviews\n7,12\n,3\n")
    declared = tables.read_csv(spark, path, schemas.MAPPING)
    assert declared.schema == schemas.MAPPING
    assert sorted(map(tuple, declared.collect()), key=str) == [(7, 12), (None, 3)]
    assert tables.read_csv(spark, path).dtypes == [("product_id_events", "int"), ("product_id_reviews", "int")]


def test_null_sessions_get_null_features(spark):
    import datetime

    from cartwheel.operators import features as FE
    day = datetime.datetime(2024, 1, 1)
    rows = [("s", 1, "c", day, "view"), ("s", 1, None, day, "purchase"), (None, 1, "c", day, "view"), (None, 2, "d", day, "view")]
    df = spark.createDataFrame(rows, "user_session string, product_id int, category_code string, event_time timestamp, event_type string")
    out = FE.predictor_features(df, as_of="2024-01-03")
    got = sorted(((r.user_session, r.product_id, r.frequency, r.session_diversity, r.popularity, r.recency) for r in out.collect()), key=str)
    assert got == sorted([("s", 1, 2, 1, 1, 2), ("s", 1, 2, 1, 1, 2), (None, 1, None, None, 1, 2), (None, 2, None, None, None, 2)], key=str)
    assert sorted(out.columns) == sorted([*df.columns, "recency", "frequency", "session_diversity", "popularity"])


def test_mapped_reviews_lie_event_by_event(spark, scratch_dir):
    n = 20
    reviews = spark.range(2000).select(F.col("id").alias("review_id"), F.col("id").alias("product_id"))
    reviews = reviews.unionByName(spark.createDataFrame([(5000, None), (1, 1)], "review_id long, product_id long"))
    mapping = spark.range(2000).select((F.col("id") % n).alias("product_id_events"), F.col("id").alias("product_id_reviews"))
    events = spark.range(2000).select(F.col("id").alias("event_id"), (F.col("id") * 7919 % n).alias("product_id"))
    events = events.unionByName(spark.createDataFrame([(9000, None), (9001, 99), (3, 1)], "event_id long, product_id long"))
    out = FE.mapped_reviews(reviews, mapping, events, review_rows=40, event_rows=60)
    assert out.columns == ["cosmetic_product_id", "review_product_id", "review_id", "event_id"]
    rows = [tuple(r) for r in out.select("cosmetic_product_id", "review_id", "event_id").collect()]
    ids = list(range(2000))
    exp = [(p, r, e) for p in range(n)
           for r in [i for i in ids + [1] if i % n == p]
           for e in [i for i in ids if i * 7919 % n == p] + ([3] if p == 1 else [])]
    assert sorted(rows) == sorted(exp)
    # Neighbouring rows share their event: few changes for many rows.
    changes = sum(a[2] != b[2] for a, b in zip(rows, rows[1:]))
    assert changes < len(rows) / 10
    path = f"{scratch_dir}/mapped_reviews"
    FE.mapped_reviews(reviews, mapping, events).select("review_id", "cosmetic_product_id", "event_id").write.parquet(path)
    held = sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path))
    assert held < 0.7 * len(rows)
