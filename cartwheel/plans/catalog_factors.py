"""Step 8 queries: splits, interaction preparation, ALS and the biased factor model (M8, M9a–i, E5, E6).

Model outputs depend on floating-point training order, so the recommendations
are rows-only (no oracle); what every result must satisfy has one, and tests
compare scoring with brute force.
"""

from pyspark.sql import functions as F

from cartwheel.functions import scalar as S
from cartwheel.operators import clean as C
from cartwheel.operators import evaluate as EV
from cartwheel.operators import factors as FA
from cartwheel.operators import vectors as VE
from cartwheel.operators.ranking import dense_codes
from cartwheel.plans import oracle_views as V
from cartwheel.plans.registry import register
from cartwheel.sources import tables


@register("stratified_split", V.with_(V.INTERACTIONS, """s AS (
  SELECT event_id, CASE event_type WHEN 'purchase' THEN 3 WHEN 'cart' THEN 2 WHEN 'view' THEN 1 END AS score
  FROM interactions
)""", """r AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY score ORDER BY md5('42|' || CAST(event_id AS VARCHAR)), event_id) AS rn,
         COUNT(*) OVER (PARTITION BY score) AS n
  FROM s WHERE score IS NOT NULL
)""") + "SELECT event_id, score, rn <= round_even(0.2 * n, 0) AS is_test FROM r")
def stratified_split(spark, sf_dir):
    ev = tables.interactions(spark, sf_dir, with_attributes=False)
    scored = ev.select("event_id", S.engagement_score().alias("score")).where(F.col("score").isNotNull())
    return FA.stratified_split(scored, "score", ["event_id"], 0.2, seed=42).select("event_id", "score", "is_test")


def _ncf_rows(spark, sf_dir):
    ev = C.valid_events(tables.interactions(spark, sf_dir, with_attributes=False))
    return FA.ncf_interactions(ev, user="user_id", item="product_id")


@register("ncf_prep", V.with_(V.INTERACTIONS, """x AS (
  SELECT event_id, user_id AS "user", product_id AS item,
         CASE WHEN event_type = 'purchase' THEN 2.0 WHEN event_type = 'cart' THEN 1.0 ELSE 0.0 END AS score
  FROM interactions
  WHERE event_type IN ('view', 'cart', 'remove_from_cart', 'purchase') AND user_id IS NOT NULL AND product_id IS NOT NULL
)""", """uc AS (SELECT "user", CAST(ROW_NUMBER() OVER (ORDER BY "user") - 1 AS BIGINT) AS user_code FROM (SELECT DISTINCT "user" FROM x))""",
    """ic AS (SELECT item, CAST(ROW_NUMBER() OVER (ORDER BY item) - 1 AS BIGINT) AS item_code FROM (SELECT DISTINCT item FROM x))""") + """
SELECT x.event_id, x."user", x.item, CAST(x.score AS DOUBLE) AS score, uc.user_code, ic.item_code
FROM x JOIN uc USING ("user") JOIN ic USING (item)""")
def ncf_prep(spark, sf_dir):
    """M9d: F7 scores with dense user/item codes (LabelEncoder order)."""
    ev = C.valid_events(tables.interactions(spark, sf_dir, with_attributes=False))
    x = ev.where(F.col("user_id").isNotNull() & F.col("product_id").isNotNull()).select(
        "event_id", F.col("user_id").alias("user"), F.col("product_id").alias("item"),
        S.ncf_score().alias("score"))
    return (x.join(dense_codes(x, "user", "user_code"), "user")
             .join(dense_codes(x, "item", "item_code"), "item")
             .select("event_id", "user", "item", "score", "user_code", "item_code"))


@register("balanced_prep", V.with_(V.INTERACTIONS, """s AS (
  SELECT event_id, user_id AS "user", product_id AS item,
         CASE event_type WHEN 'purchase' THEN 3 WHEN 'cart' THEN 2 WHEN 'view' THEN 1 END AS score
  FROM interactions WHERE user_id IS NOT NULL AND product_id IS NOT NULL
)""", """r AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY score ORDER BY md5('42|' || CAST(event_id AS VARCHAR)), event_id) AS rn,
         COUNT(*) OVER (PARTITION BY score) AS n
  FROM s WHERE score IS NOT NULL
)""") + """
SELECT event_id, "user", item, score FROM r WHERE rn <= CASE WHEN score = 1 THEN round_even(0.1 * n, 0) ELSE n END""")
def balanced_prep(spark, sf_dir):
    """M9g: F8 scores with views down-sampled to 10% (exact, md5 order)."""
    ev = tables.interactions(spark, sf_dir, with_attributes=False)
    return FA.balanced_interactions(ev).select("event_id", "user", "item", "score")


def _purchases(spark, sf_dir):
    ev = C.of_type(tables.interactions(spark, sf_dir, with_attributes=False), "purchase")
    return C.with_constant(ev, "product_quantity", 1).select(
        F.col("user_session").alias("user"), F.col("product_id").alias("item"),
        F.col("product_quantity").alias("score")).where(F.col("item").isNotNull())


@register("als_user_recs")
def als_user_recs(spark, sf_dir):
    """M9a/b: implicit ALS (rank 10, 10 iterations, reg 0.1) on purchases, top-10 per session."""
    return FA.recommend_items(FA.fit_als(_purchases(spark, sf_dir)), 10)


@register("als_item_recs")
def als_item_recs(spark, sf_dir):
    """Top-10 sessions per product."""
    return FA.recommend_users(FA.fit_als(_purchases(spark, sf_dir)), 10)


@register("als_rec_ranks", V.with_(V.INTERACTIONS, """p AS (
  SELECT DISTINCT user_session, product_id FROM interactions
  WHERE event_type = 'purchase' AND user_session IS NOT NULL AND product_id IS NOT NULL
)""") + """
SELECT user_session AS "user", least(10, (SELECT COUNT(DISTINCT product_id) FROM p)) AS n_recs, 1 AS first_rank,
       CAST(least(10, (SELECT COUNT(DISTINCT product_id) FROM p)) AS INTEGER) AS last_rank,
       least(10, (SELECT COUNT(DISTINCT product_id) FROM p)) AS n_known_items, TRUE AS in_score_order
FROM (SELECT DISTINCT user_session FROM p)""")
def als_rec_ranks(spark, sf_dir):
    """What every ALS result must satisfy: each session has its k ranks, known
    products and scores that fall with the rank."""
    bought = _purchases(spark, sf_dir)
    recs = FA.recommend_items(FA.fit_als(bought), 10)
    known = bought.select("item").distinct().withColumn("known", F.lit(True))
    return recs.join(known, "item", "left").groupBy("user").agg(
        F.count(F.lit(1)).alias("n_recs"), F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"),
        F.count_distinct(F.when(F.col("known"), F.col("item"))).alias("n_known_items"),
        (F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"])
         == F.sort_array(F.collect_list("score"), asc=False)).alias("in_score_order"))


def _item_features(spark, sf_dir):
    """Mean embedding of each product (the embeddings' label is the product id)."""
    emb = tables.table(spark, sf_dir, "embeddings")
    return VE.mean_embedding(emb, "label", "embedding", "features").withColumnRenamed("label", "item")


@register("fm_recs")
def fm_recs(spark, sf_dir):
    """M9e/f: factor-model recommender (width 64), top-10 products per user."""
    return FA.recommend_items(FA.fit_biased(_ncf_rows(spark, sf_dir), reg=0.1), 10)


@register("fm_eval")
def fm_eval(spark, sf_dir):
    """E5: RMSE and precision/recall at 1.5 on the training rows."""
    rows = _ncf_rows(spark, sf_dir)
    pred = FA.predict(FA.fit_biased(rows, reg=0.1), rows).select(F.col("score").cast("double").alias("label"), "prediction")
    return EV.side_by_side(EV.rmse(pred), EV.binary_precision_recall(pred, 1.5))


def _embedded(spark, sf_dir):
    """M9h: the model on the 80% stratified part of the balanced data, with item
    embeddings as features; and the split."""
    ev = tables.interactions(spark, sf_dir, with_attributes=False)
    split = FA.stratified_split(FA.balanced_interactions(ev), "score", ["event_id"], 0.2, seed=42)
    train = split.where(~F.col("is_test"))
    return FA.fit_biased(train, item_features=_item_features(spark, sf_dir)), split


@register("fm_embedded_eval")
def fm_embedded_eval(spark, sf_dir):
    """M9h + E6: RMSE and weighted P/R/F1 at 2 on the held-out 20%."""
    model, split = _embedded(spark, sf_dir)
    pred = FA.predict(model, split.where(F.col("is_test"))).select(
        F.col("score").cast("double").alias("label"), "prediction")
    w = EV.weighted_prf(pred.select(S.binarize("label", 2).alias("label"),
                                    S.binarize("prediction", 2).alias("prediction")))
    return EV.side_by_side(EV.rmse(pred), w)


@register("fm_embedded_recs")
def fm_embedded_recs(spark, sf_dir):
    """M9i: ``(user, item, rank)`` from the model trained on the 80% part."""
    model, _ = _embedded(spark, sf_dir)
    return FA.recommend_items(model, 10).select("user", "item", "rank")


@register("precision_recall_als")
def precision_recall_als(spark, sf_dir):
    """ALS top-10 per session against the session's purchases, population =
    sessions in the recommendations that have truth; real ids (defect D3 avoided)."""
    truth = _purchases(spark, sf_dir)
    recs = FA.recommend_items(FA.fit_als(truth), 10)
    return EV.precision_recall_at_k(recs, truth, 10, recall_denominator="rows", population="recs")
