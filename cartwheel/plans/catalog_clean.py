"""Step 2 queries: cleaning and scalar functions."""

from pyspark.sql import functions as F

from cartwheel.functions import scalar as S
from cartwheel.functions import text as TX
from cartwheel.operators import clean as C
from cartwheel.operators import features as FE
from cartwheel.plans import oracle_views as V
from cartwheel.plans.registry import register
from cartwheel.sources import tables

R = V.with_(V.REVIEWS)
I = V.with_(V.INTERACTIONS)


@register("clean_title", R + f"SELECT review_id, {V.sql_clean_title('product_title')} AS title_clean FROM reviews")
def clean_title(spark, sf_dir):
    return tables.reviews(spark, sf_dir).select("review_id", TX.clean_title("product_title").alias("title_clean"))


@register("clean_text_stop",
          R + f"SELECT review_id, {V.sql_clean_text_stop('review_text')} AS text_clean FROM reviews")
def clean_text_stop(spark, sf_dir):
    return tables.reviews(spark, sf_dir).select(
        "review_id", TX.clean_text_stop("review_text").alias("text_clean"))


@register("stem3", R + f"SELECT review_id, {V.sql_stem3(V.sql_clean_text_stop('review_text'))} AS stemmed_text "
          "FROM reviews")
def stem3(spark, sf_dir):
    return tables.reviews(spark, sf_dir).select(
        "review_id", TX.stem3(TX.clean_text_stop("review_text")).alias("stemmed_text"))


@register("lemmas", R + f"SELECT review_id, {V.sql_lemmatize(V.sql_clean_text_stop('review_text'))} "
          "AS lemmatized_text FROM reviews")
def lemmas(spark, sf_dir):
    return tables.reviews(spark, sf_dir).select(
        "review_id", TX.lemmatize(TX.clean_text_stop("review_text")).alias("lemmatized_text"))


@register("fallback_title", I + "SELECT event_id, coalesce(category_code, brand) AS title FROM interactions")
def fallback_title(spark, sf_dir):
    return tables.interactions(spark, sf_dir).select(
        "event_id", S.fallback_title("category_code", "brand").alias("title"))


@register("positive_price", I + "SELECT event_id, price FROM interactions WHERE price > 20")
def positive_price(spark, sf_dir):
    return C.positive(tables.interactions(spark, sf_dir, with_attributes=False), "price", above=20.0).select(
        "event_id", "price")


@register("valid_events", I + "SELECT event_id, event_type FROM interactions "
          "WHERE event_type IN ('view', 'cart', 'remove_from_cart', 'purchase')")
def valid_events(spark, sf_dir):
    return C.valid_events(tables.interactions(spark, sf_dir, with_attributes=False)).select(
        "event_id", "event_type")


_MAPPED_SQL = V.with_(V.INTERACTIONS, V.REVIEWS, V.MAPPING, """joined AS (
  SELECT r.review_id, r.product_id AS review_product_id, i.product_id AS cosmetic_product_id,
         i.event_id, i.event_type, i.event_time
  FROM reviews r
  JOIN mapping m ON m.product_id_reviews = r.product_id
  JOIN interactions i ON i.product_id = m.product_id_events
)""")


@register("key_dedup", _MAPPED_SQL + """, ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY review_product_id, cosmetic_product_id
                               ORDER BY event_time, event_id, review_id) AS rn
  FROM joined
)
SELECT review_product_id, cosmetic_product_id, review_id, event_id, event_type, event_time
FROM ranked WHERE rn = 1""")
def key_dedup(spark, sf_dir):
    """P11 over the J1 join: first event and review per product pair (pre-aggregated)."""
    out = FE.mapped_first_events(tables.reviews(spark, sf_dir), tables.mapping(spark, sf_dir),
                                 tables.interactions(spark, sf_dir, with_attributes=False),
                                 ["review_id"], ["event_id", "event_type", "event_time"])
    return out.select("review_product_id", "cosmetic_product_id", "review_id", "event_id", "event_type",
                      "event_time")


@register("outlier_3sigma", """
WITH s AS (SELECT avg(n_chars) AS m, stddev_samp(n_chars) AS sd FROM documents)
SELECT doc_id, n_chars FROM documents, s WHERE n_chars > m - 3 * sd AND n_chars < m + 3 * sd""")
def outlier_3sigma(spark, sf_dir):
    return C.outliers_removed(tables.table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars")


@register("typed_reviews", R + """
SELECT review_id, TRY_CAST(product_rating AS DOUBLE) AS product_rating,
       TRY_CAST(product_rating_count AS INTEGER) AS product_rating_count,
       TRY_CAST(price AS DOUBLE) AS review_price
FROM reviews""")
def typed_reviews(spark, sf_dir):
    typed = FE.type_reviews(C.rename(tables.reviews(spark, sf_dir), {"price": "review_price"}))
    return typed.select("review_id", "product_rating", "product_rating_count", "review_price")


@register("review_dates", R + """
SELECT review_id, strftime(CAST(try_strptime(review_date, '%Y-%m-%d %H:%M:%S') AS DATE), '%Y-%m-%d') AS review_day FROM reviews""")
def review_dates(spark, sf_dir):
    """text dates parsed, bad ones NULL."""
    return tables.reviews(spark, sf_dir).select(
        "review_id", S.parse_date("review_date").cast("string").alias("review_day"))


@register("class_sample", I + """, scored AS (
  SELECT event_id, CASE event_type WHEN 'purchase' THEN 3 WHEN 'cart' THEN 2 WHEN 'view' THEN 1 END AS score
  FROM interactions
), ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY score ORDER BY md5('42|' || CAST(event_id AS VARCHAR)), event_id) AS rn,
         COUNT(*) OVER (PARTITION BY score) AS n
  FROM scored WHERE score IS NOT NULL
)
SELECT event_id, score FROM ranked
WHERE rn <= CASE WHEN score = 1 THEN round_even(0.1 * n, 0) ELSE n END""")
def class_sample(spark, sf_dir):
    ev = tables.interactions(spark, sf_dir, with_attributes=False)
    scored = ev.select("event_id", S.engagement_score().alias("score")).where(F.col("score").isNotNull())
    return C.stratified_sample(scored, "score", {1: 0.1}, ["event_id"]).select("event_id", "score")
