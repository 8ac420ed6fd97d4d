"""Factor models, text scoring and embeddings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.operators import factors as FA
from cartwheel.operators import textops as TO
from cartwheel.operators import vectors as VE


def _ratings(spark):
    rng = np.random.default_rng(1)
    rows = [(f"u{u}", f"i{(u * 3 + j) % 12}", float(rng.integers(0, 3))) for u in range(30) for j in range(5)]
    return spark.createDataFrame(rows, "user string, item string, score double")


@pytest.mark.parametrize("block_rows", [3, 7, 8192])
def test_score_top_k_matches_brute_force(spark, block_rows):
    rng = np.random.default_rng(0)
    users = [(i, float(rng.normal()), rng.normal(size=4).tolist()) for i in range(20)]
    items = [(f"i{i}", float(rng.normal()), rng.normal(size=4).tolist()) for i in range(15)]
    items += [("j0", *items[0][1:]), ("a9", *items[0][1:])]  # ties go to the smaller key
    got = FA.score_top_k(spark.createDataFrame(users, "user bigint, bias double, vec array<double>"),
                         spark.createDataFrame(items, "item string, bias double, vec array<double>"), 3, block_rows)
    assert got.dtypes == [("user", "bigint"), ("rank", "int"), ("item", "string"), ("score", "double")]
    want = {}
    for u, ub, uv in users:
        scored = sorted(((-(ub + ib + float(np.dot(uv, iv))), i) for i, ib, iv in items))
        best = sorted(((round(s, 9), i) for s, i in scored))[:3]
        want[u] = [i for _, i in best]
    rows = got.collect()
    assert len(rows) == 60 and all(want[r.user][r.rank - 1] == r.item for r in rows)


def test_als_recs_shape(spark):
    model = FA.fit_als(_ratings(spark), rank=4, max_iter=5)
    per_user = {}
    for r in FA.recommend_items(model, 4).collect():
        per_user.setdefault(r.user, []).append(r.rank)
    assert len(per_user) == 30
    assert all(sorted(v) == [1, 2, 3, 4] for v in per_user.values())
    assert FA.recommend_users(model, 4).select("item").distinct().count() == 12


def test_biased_model_beats_constant_and_keeps_id_types(spark):
    rng = np.random.default_rng(2)
    rows = [(u, 10 + i, 1.0 + 0.5 * (u % 3) + 0.4 * (i % 4) + 0.05 * float(rng.normal()))
            for u in range(40) for i in range(12) if (u + i) % 5]
    data = spark.createDataFrame(rows, "user bigint, item int, score double")
    features = spark.createDataFrame([(10 + i, [float(i % 4), 1.0]) for i in range(10)], "item int, features array<double>")
    base = data.select(F.stddev_pop("score")).first()[0]
    for kw in ({}, {"item_features": features}):
        model = FA.fit_biased(data, rank=4, **kw)
        pred = FA.predict(model, data)
        rmse = pred.select(F.sqrt(F.avg((F.col("score") - F.col("prediction")) ** 2))).first()[0]
        assert rmse < base / 2
        recs = FA.recommend_items(model, 5)
        assert recs.dtypes[0] == ("user", "bigint") and recs.dtypes[2] == ("item", "int")
        assert recs.groupBy("user").count().where("count <> 5").count() == 0
    cold = FA.predict(model, spark.createDataFrame([(999, 999)], "user bigint, item int")).first()
    assert cold.prediction == model.mean


def test_stratified_split_exact(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(100)], "id int, label int")
    out = FA.stratified_split(df, "label", ["id"], 0.2)
    counts = {(r.label, r.is_test): r["count"] for r in out.groupBy("label", "is_test").count().collect()}
    assert counts[(0, True)] == 7 and counts[(1, True)] == 7 and counts[(2, True)] == 7  # round(6.6)
    assert out.count() == 100


def test_topics_and_sentiment(spark):
    df = spark.createDataFrame([(1, "Great price, cheap and good value. Delivery was late."),
                                (2, "The packaging box was broken"), (3, ""), (4, None), (5, "nothing here")],
                               "id int, review_text string")
    out = {r.id: r for r in TO.process_reviews(df).collect()}
    assert out[1].topics == ["price"]  # price 4 of 6 hits, delivery 2 of 6
    assert out[2].topics == ["packaging"]  # packaging 2/3, quality 1/3
    assert out[3].topics == [] and out[4].topics == [] and out[5].topics == []
    assert out[1].sentiment[0].label == "POSITIVE"
    assert out[2].sentiment[0].label == "NEGATIVE"
    assert out[3].sentiment == [] and out[4].sentiment == []
    assert out[5].sentiment[0].score == 0.5


def test_analyze_topics_counts(spark):
    df = spark.createDataFrame([(["price", "delivery"], "view"), (["price"], "view"), ([], "cart")],
                               "topics array<string>, event_type string")
    got = [(r.topic, r.event_type, r["count"]) for r in TO.analyze_topics(df).collect()]
    assert got == [("price", "view", 2), ("delivery", "view", 1)]


def test_embedding_chain(spark):
    df = spark.createDataFrame([(1, "Nice bottle", "great product, love it"), (2, "", None)],
                               "review_id int, review_title string, review_text string")
    df = TO.process_reviews(df)
    e = VE.review_embeddings(df, dim=16)
    e = VE.combine_review_embeddings(e, dim=16)
    e = VE.topic_sentiment_embeddings(e, dim=16)
    e = VE.merge_embeddings(e, dim=16)
    e = VE.clean_embeddings(e, "final_embedding", 16)
    rows = {r.review_id: r for r in e.collect()}
    assert len(rows[1].title_embedding) == 16 and rows[2].title_embedding == []
    assert abs(sum(x * x for x in rows[1].text_embedding) - 1.0) < 1e-5
    assert len(rows[1].final_embedding) == 16 and len(rows[2].final_embedding) == 16
    assert rows[2].final_embedding == [0.0] * 16


def test_word2vec_query_has_the_default_width(spark):
    from cartwheel.plans.catalog_vectors import word2vec_embedding
    from conftest import SF_SMALL
    rows = word2vec_embedding(spark, SF_SMALL).collect()
    assert len(rows) == 200 and {len(r.embedding) for r in rows} == {VE.DEFAULT_DIM}


def test_zero_fallback_reproduces_reference(spark):
    df = spark.createDataFrame([([3.0, 3.0], [0.0, 3.0])], "title_embedding array<float>, text_embedding array<float>")
    ref = VE.combine_review_embeddings(df, dim=2, zero_fallback=True).first().combined_embedding
    ours = VE.combine_review_embeddings(df, dim=2).first().combined_embedding
    assert list(ref) == [1.0, 2.0] and list(ours) == [1.5, 3.0]


def test_mean_embedding(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (1, []), (2, None)],
                               "label int, embedding array<float>")
    got = {r.label: list(r.mean_embedding) for r in VE.mean_embedding(df, "label", "embedding").collect()}
    assert got == {1: [2.0, 3.0]}


def test_als_scoring_equals_spark_recommend_for_all(spark):
    from pyspark.ml.recommendation import ALS

    from cartwheel.operators.ranking import dense_codes
    data = _ratings(spark)
    model = FA.fit_als(data, rank=4, max_iter=5)
    ours, ours_items = FA.recommend_items(model, 3, block_rows=7).collect(), FA.recommend_users(model, 3, block_rows=7).collect()
    u, i = dense_codes(data, "user", "_u"), dense_codes(data, "item", "_i")
    coded = (data.groupBy("user", "item").agg(F.sum("score").alias("_r")).join(u, "user").join(i, "item")
             .select(F.col("_u").cast("int").alias("_u"), F.col("_i").cast("int").alias("_i"), F.col("_r").cast("float").alias("_r")))
    spark_model = ALS(userCol="_u", itemCol="_i", ratingCol="_r", rank=4, maxIter=5, regParam=0.1,
                      implicitPrefs=True, seed=42).fit(coded)
    u_codes, i_codes = {r._u: r.user for r in u.collect()}, {r._i: r.item for r in i.collect()}
    ref = {u_codes[r["_u"]]: [round(x["rating"], 3) for x in r.recommendations]
           for r in spark_model.recommendForAllUsers(3).collect()}
    ref_i = {i_codes[r["_i"]]: [round(x["rating"], 3) for x in r.recommendations]
             for r in spark_model.recommendForAllItems(3).collect()}
    got, got_i = {}, {}
    for r in sorted(ours, key=lambda r: (r.user, r.rank)):
        got.setdefault(r.user, []).append(round(r.score, 3))
    for r in sorted(ours_items, key=lambda r: (r.item, r.rank)):
        got_i.setdefault(r.item, []).append(round(r.score, 3))
    assert got == ref and got_i == ref_i


def test_model_hook_loads_once_per_worker_and_checks_types(spark, scratch_dir):
    import os
    import uuid

    folder = os.path.join(scratch_dir, "loads")
    os.makedirs(folder)

    def counting():
        with open(os.path.join(folder, f"{os.getpid()}-{uuid.uuid4().hex}"), "w"):
            pass
        return lambda texts: texts.map(lambda t: [] if not t else [float(len(t))])

    rows = [(i, None if i % 7 == 0 else "x" * i) for i in range(48)]
    df = spark.createDataFrame(rows, "i int, t string").repartition(24)
    got = {r.i: r.v for r in df.select("i", TO.model_column(counting, "array<float>", "t").alias("v")).collect()}
    assert got == {i: [float(len(t))] if t else [] for i, t in rows}
    loads = [name.split("-")[0] for name in os.listdir(folder)]
    assert len(loads) == len(set(loads)) < 24  # 24 tasks, one load in each worker process

    def wrong():
        return lambda texts: texts.map(lambda t: "not a vector")

    for on_error in ("raise", "empty"):
        with pytest.raises(Exception, match="not array<float>"):
            df.select(TO.model_column(wrong, "array<float>", "t", on_error=on_error)).collect()


def test_model_hook_on_error_empty(spark):
    def fragile():
        def one(t):
            if t == "bad":
                raise ValueError("model failed")
            return [1.0, 2.0]
        return lambda texts: texts.map(one)

    df = spark.createDataFrame([("ok",), ("bad",), ("fine",)], "t string").coalesce(1)
    got = [r.v for r in df.select(TO.model_column(fragile, "array<float>", "t", on_error="empty").alias("v")).collect()]
    assert got == [[1.0, 2.0], [], [1.0, 2.0]]
    with pytest.raises(Exception, match="model failed"):
        df.select(TO.model_column(fragile, "array<float>", "t")).collect()
