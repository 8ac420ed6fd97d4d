"""Work that grew faster than the input: shuffles of the metrics, vectors, word vectors, model hook."""

import re
import threading

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cartwheel.operators import baskets as B
from cartwheel.operators import evaluate as EV
from cartwheel.operators import factors as FA
from cartwheel.operators import similarity as sim
from cartwheel.operators import textops as TO
from cartwheel.operators import vectors as VE
from cartwheel.operators import wordvectors as WV
from cartwheel.plans import flows as FL


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_basket_candidates_are_shuffled_once(spark):
    recs = spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.5), (2, 1, 0.5), (2, 4, 0.9)], "item long, rec_item long, score double")
    bl = spark.createDataFrame([(7, 1), (7, 1), (7, 2), (8, 2), (9, None), (None, 1)], "basket long, item long")
    out = EV.basket_recs_from_item_recs(recs, bl.where("basket IS NOT NULL"), k=2)
    assert _shuffles(out) <= 3
    assert sorted(tuple(r) for r in out.select("basket", "rank", "item", "score").collect()) == [
        (7, 1, 4, 0.9), (7, 2, 1, 0.5), (8, 1, 4, 0.9), (8, 2, 1, 0.5)]


def test_itemset_candidates_are_shuffled_once(spark, monkeypatch):
    sets = spark.createDataFrame([(["a"], 9), (["b"], 7), (["a", "b"], 5)], "items array<string>, freq long")
    bl = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (4, None)], "basket long, item string")
    want = [(1, "a", 9), (1, "b", 5), (2, "a", 5), (2, "b", 7)]
    out = B.itemset_candidates(sets, bl, k=10)
    assert _shuffles(sim.top_k_per_group(out, "basket", [F.desc("score"), F.asc("item")], 10)) == 1
    assert sorted(tuple(r) for r in out.select("basket", "item", "score").collect()) == want
    monkeypatch.setattr(B, "BROADCAST_PARTNERS", 0)
    assert sorted(tuple(r) for r in B.itemset_candidates(sets, bl, k=10).select("basket", "item", "score").collect()) == want


def test_precision_recall_needs_one_row_a_user(spark):
    recs = spark.createDataFrame([(1, 5, 1), (1, 6, 2), (1, None, 3), (2, 5, 1), (9, 5, 1)], "user long, item long, rank int")
    truth = spark.createDataFrame([(1, 5), (1, 5), (1, None), (2, 7), (3, 5), (None, 5)], "user long, item long")
    out = EV.precision_recall_at_k(recs, truth, 10)
    assert _shuffles(out) <= 2
    r = out.first()
    assert (r.n_users, round(r.precision_at_k, 9), round(r.recall_at_k, 9)) == (3, round(1 / 9, 9), round(1 / 9, 9))
    d = EV.precision_recall_at_k(recs, truth, 10, recall_denominator="distinct", population="recs").first()
    assert (d.n_users, round(d.precision_at_k, 9), d.recall_at_k) == (2, round(1 / 6, 9), 0.5)


def test_cosine_pairs_with_and_without_large_baskets(spark):
    rng = np.random.default_rng(3)
    rows = [(int(b), int(i), 1.0 + int(i) % 3) for b in range(20) for i in rng.choice(12, 1 + b % 6, replace=False)]
    df = spark.createDataFrame(rows, "basket long, item long, qty double")
    plain = sorted(tuple(r) for r in sim.cosine_topk(df, k=3).collect())
    assert plain and plain == sorted(tuple(r) for r in sim.cosine_topk(df, k=3, block_items=2).collect())


def test_long_vectors_are_computed_once(spark):
    df = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "k long, t string")
    out = VE.to_long(VE.hash_embed(df, "t", "v", 8), "k", "v")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("vector_to_array") + plan.count("UDF(_nv") <= 1 and "Filter ((size(" not in plan
    assert {r.k for r in out.collect()} == {1} and out.count() == 8


def test_products_send_the_dense_matrix_once_for_a_group_of_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    n, block, width = 37, 4, 6
    m = np.triu(rng.random((n, n)) * (rng.random((n, n)) < 0.3))
    m = m + m.T
    entries = spark.createDataFrame([(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))], "i int, j int, v double")
    x = rng.standard_normal((n, width))
    batches = [WV._dense_batch(b, x[b * block:(b + 1) * block]) for b in range(-(-n // block))]
    dense = spark.createDataFrame(pa.Table.from_batches(batches).to_pandas(), WV._DENSE)
    chunks = WV.packed_entries(entries, block)
    monkeypatch.setattr(WV, "materialize", lambda df: df)
    out = WV.multiply(chunks, dense, n, block, width)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"RepartitionByExpression \[group#\d+\], 1\n", plan)
    got = {r.block * block + r["at"]: np.frombuffer(r["data"], "<f8").reshape(-1, width) for r in out.collect()}
    assert np.allclose(np.concatenate([got[k] for k in sorted(got)]), m @ x)
    assert out.rdd.getNumPartitions() == -(-n // block)


def test_model_errors_cost_few_further_calls(spark):
    def counting_model():
        calls = [0]

        def model(texts):
            calls[0] += 1
            if (texts == "bad").any():
                raise ValueError("bad")
            return texts.map(lambda t, n=calls[0]: [float(n)])
        return model

    df = spark.range(256).select("id", F.when(F.col("id") == 100, "bad").otherwise("good").alias("t")).coalesce(1)
    rows = df.select("id", TO.model_column(counting_model, "array<float>", "t", on_error="empty").alias("v")).collect()
    assert [r.id for r in rows if not r.v] == [100]
    assert max(r.v[0] for r in rows if r.v) <= 40


def test_review_texts_are_split_once_for_stems_and_lemmas(spark):
    df = spark.createDataFrame([("Loved it", "The days were\u00a0long"), (None, ""), ("", None)], "review_title string, review_text string")
    out = FL.process_reviews_text(df).select("stemmed_title", "lemmatized_title", "stemmed_text", "lemmatized_text")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 4
    assert [tuple(r) for r in out.collect()] == [
        ("lov", "love", "day lon", "day long"), ("tit", "title", "", ""), ("", "", "rev", "review")]


def test_als_computes_its_ratings_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def name(n):
        seen.add(1)
        return f"u{n % 7}"

    rows = spark.range(60).select(F.udf(name, "string")("id").alias("user"), (F.col("id") % 5).alias("item"), F.lit(1.0).alias("score"))
    model = FA.fit_als(rows, rank=2, max_iter=1)
    assert seen.value == 60
    assert {r.user for r in model.users.collect()} == {f"u{n}" for n in range(7)} and model.items.count() == 5


def test_model_output_checks_fit_the_models_side_by_side(spark, scratch_dir, monkeypatch):
    from cartwheel.plans import catalog_quality as CQ
    both = threading.Barrier(3, timeout=60)

    def meet(f):
        def run(*args, **kw):
            both.wait()
            return f(*args, **kw)
        return run

    monkeypatch.setattr("cartwheel.operators.baskets.fit_fpgrowth", meet(B.fit_fpgrowth))
    monkeypatch.setattr(FA, "fit_biased", meet(FA.fit_biased))
    plain = FA.fit_als
    monkeypatch.setattr(FA, "fit_als", lambda *a, **kw: meet(plain)(*a, **kw) if kw.get("implicit", True) else plain(*a, **kw))
    spark.range(60).selectExpr("id div 3 AS l_orderkey", "id % 3 AS l_partkey", "1.0D AS l_quantity").write.parquet(f"{scratch_dir}/outputs/lineitem.parquet")
    spark.range(3).selectExpr("id AS p_partkey", "concat('b', id) AS p_brand").write.parquet(f"{scratch_dir}/outputs/part.parquet")
    spark.range(60).selectExpr("id AS event_id", "TIMESTAMP_NTZ'2024-01-02 00:00:00' AS ts", "id % 7 AS user_id",
                               "if(id % 2 = 0, 'purchase', 'view') AS event_type", "1.0D AS value",
                               "concat('{\"k\": ', id % 5, '}') AS props").write.parquet(f"{scratch_dir}/outputs/events.parquet")
    rows = CQ.model_output_checks(spark, f"{scratch_dir}/outputs").collect()
    assert len(rows) == 10 and {r.status for r in rows} == {"pass"}
