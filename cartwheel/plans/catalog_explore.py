"""Step 5 queries: exploratory aggregates A1–A28, O1–O5."""

from pyspark.sql import functions as F

from cartwheel.operators import explore as X
from cartwheel.plans import oracle_views as V
from cartwheel.plans.registry import register
from cartwheel.sources import tables

I = V.with_(V.INTERACTIONS)
R = V.with_(V.REVIEWS)
_LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("daily_engagement", I + "SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_date, COUNT(*) AS count "
          "FROM interactions GROUP BY 1")
def daily_engagement(spark, sf_dir):
    out = X.daily_counts(tables.interactions(spark, sf_dir, with_attributes=False))
    return out.withColumn("event_date", F.col("event_date").cast("string"))


@register("event_type_counts", I + "SELECT event_type, COUNT(*) AS count FROM interactions GROUP BY 1")
def event_type_counts(spark, sf_dir):
    return X.counts_by(tables.interactions(spark, sf_dir, with_attributes=False), "event_type",
                       order_by_count=True)


@register("events_per_session", I + "SELECT user_session, COUNT(*) AS count FROM interactions GROUP BY 1")
def events_per_session(spark, sf_dir):
    return X.counts_by(tables.interactions(spark, sf_dir, with_attributes=False), "user_session")


@register("avg_by_brand", R + """
SELECT brand_name, AVG(TRY_CAST(product_rating AS DOUBLE)) AS avg_product_rating,
       COUNT(TRY_CAST(product_rating AS DOUBLE)) AS n_product_rating
FROM reviews GROUP BY brand_name""")
def avg_by_brand(spark, sf_dir):
    return X.avg_and_count(tables.reviews(spark, sf_dir), "brand_name", "product_rating")


@register("daily_rating", I + "SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS date, ROUND(AVG(price), 9) AS avg_price "
          "FROM interactions GROUP BY 1")
def daily_rating(spark, sf_dir):
    """A10 on the event table: daily average of the event value."""
    out = X.daily_average(tables.interactions(spark, sf_dir, with_attributes=False), "price", "event_time")
    return out.withColumn("date", F.col("date").cast("string")).withColumn("avg_price", F.round("avg_price", 9))


@register("describe_long", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", COUNT({c}) AS count, ROUND(AVG({c}), 9) AS mean, "
    f"ROUND(STDDEV_SAMP({c}), 9) AS stddev, "
    f"CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max FROM lineitem" for c in _LI_COLS))
def describe_long(spark, sf_dir):
    out = X.describe_long(tables.table(spark, sf_dir, "lineitem"), _LI_COLS)
    return out.withColumn("mean", F.round("mean", 9)).withColumn("stddev", F.round("stddev", 9))


@register("histogram_price", I + """, v AS (SELECT CAST(price AS DOUBLE) AS x FROM interactions
                  WHERE price IS NOT NULL AND NOT isnan(price)),
s AS (SELECT CASE WHEN max(x) = min(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
             CASE WHEN max(x) = min(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v),
c AS (SELECT LEAST(CAST(floor((x - lo) / (hi - lo) * 50) AS INTEGER), 49) AS bin, COUNT(*) AS count
      FROM v, s GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin, ROUND(lo + (hi - lo) * b.bin / 50, 9) AS lo,
       ROUND(lo + (hi - lo) * (b.bin + 1) / 50, 9) AS hi, COALESCE(c.count, 0) AS count
FROM (SELECT range AS bin FROM range(0, 50)) b CROSS JOIN s LEFT JOIN c ON c.bin = b.bin""")
def histogram_price(spark, sf_dir):
    return X.histogram(tables.interactions(spark, sf_dir, with_attributes=False), "price", 50)


@register("kde_price", I + """, v AS (SELECT CAST(price AS DOUBLE) AS x FROM interactions WHERE price IS NOT NULL),
s AS (SELECT COUNT(*) AS n, STDDEV_SAMP(x) * POW(CAST(COUNT(*) AS DOUBLE), -0.2) AS h,
             MIN(x) AS mn, MAX(x) AS mx FROM v),
g AS (SELECT range AS point, (mn - 3.0 * h) + ((mx + 3.0 * h) - (mn - 3.0 * h)) / 199 * range AS gx
      FROM range(0, 200), s),
w AS (SELECT x, COUNT(*) AS w FROM v GROUP BY x)
SELECT CAST(g.point AS INTEGER) AS point, ROUND(g.gx, 9) AS x,
       ROUND(SUM(w.w * EXP(-0.5 * ((g.gx - w.x) / s.h) * ((g.gx - w.x) / s.h))) * (1.0 / SQRT(2 * PI())) / (s.n * s.h), 9) AS density
FROM g CROSS JOIN w CROSS JOIN s GROUP BY g.point, g.gx, s.n, s.h""")
def kde_price(spark, sf_dir):
    return X.kde(tables.interactions(spark, sf_dir, with_attributes=False), "price", 200)


@register("word_top20", R + f""", toks AS (
  SELECT unnest({V.sql_ws_tokens(V.sql_lemmatize(V.sql_clean_text_stop('review_text')))}) AS word FROM reviews
)
SELECT word, COUNT(*) AS count FROM toks GROUP BY word ORDER BY count DESC, word LIMIT 20""")
def word_top20(spark, sf_dir):
    return X.lemma_word_counts(tables.reviews(spark, sf_dir), "review_text", 20)


@register("label_rating_counts", R + "SELECT review_label, product_rating, COUNT(*) AS count FROM reviews GROUP BY 1, 2")
def label_rating_counts(spark, sf_dir):
    return X.counts_by(tables.reviews(spark, sf_dir), "review_label", "product_rating")


@register("label_rating_pivot", R + """
SELECT review_label, COUNT(CASE WHEN product_rating = '0' THEN 1 END) AS rating_0,
       COUNT(CASE WHEN product_rating = '1' THEN 1 END) AS rating_1
FROM reviews GROUP BY review_label""")
def label_rating_pivot(spark, sf_dir):
    return X.pivot_counts(tables.reviews(spark, sf_dir), "review_label", "product_rating", ["0", "1"], "rating_")


@register("corr_matrix", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, ROUND(CORR({a}, {b}), 9) AS corr FROM lineitem"
    for i, a in enumerate(_LI_COLS) for b in _LI_COLS[i + 1:]))
def corr_matrix(spark, sf_dir):
    return X.correlations(tables.table(spark, sf_dir, "lineitem"), _LI_COLS)


@register("top_products", I + """
SELECT product_id, COUNT(*) AS count FROM interactions GROUP BY product_id
ORDER BY count DESC, product_id LIMIT 10""")
def top_products(spark, sf_dir):
    return X.top_n(tables.interactions(spark, sf_dir, with_attributes=False), "product_id", 10)


@register("basket_quantities", """
SELECT l_orderkey AS basket, l_partkey AS item, SUM(l_quantity) AS qty FROM lineitem GROUP BY 1, 2""")
def basket_quantities(spark, sf_dir):
    li = tables.table(spark, sf_dir, "lineitem")
    return X.basket_quantities(li.select(F.col("l_orderkey").alias("basket"),
                                         F.col("l_partkey").alias("item"), "l_quantity"),
                               "basket", "item", "l_quantity")


# Three standard errors of a sketch of 2^12 registers.
_SKETCH_BOUND = 3 * 1.04 / 64


@register("weekly_users_sketch", I + """
SELECT CAST(CAST(date_trunc('week', event_time) AS DATE) AS VARCHAR) AS week, COUNT(DISTINCT user_id) AS users, TRUE AS within_bound
FROM interactions GROUP BY 1""")
def weekly_users_sketch(spark, sf_dir):
    """A4: distinct users of a week merged from the days' sketches, held against the exact count."""
    ev = tables.interactions(spark, sf_dir, with_attributes=False).select("user_id", F.to_date("event_time").alias("day"))
    week = F.to_date(F.date_trunc("week", F.col("day"))).cast("string").alias("week")
    merged = X.merged_distinct(X.distinct_sketches(ev, "day", "user_id"), week)
    exact = ev.groupBy(week).agg(F.count_distinct("user_id").alias("users"))
    off = F.abs(F.col("estimate") - F.col("users"))
    return exact.join(merged, "week").select("week", "users", (off <= F.col("users") * _SKETCH_BOUND).alias("within_bound"))
