"""Queries of tables and files written and read again (S1-S13), and of the row and
column operators that the other queries do not show on their own (P2, P8-P10, P14,
P15, P18, P20, P21, F21, F24, F25, F27, U3, M19)."""

import uuid

from pyspark.sql import functions as F

from cartwheel.functions import arrays as A
from cartwheel.functions import scalar as S
from cartwheel.operators import clean as C
from cartwheel.operators import explore as X
from cartwheel.operators import features as FE
from cartwheel.plans import flows as FL
from cartwheel.plans import oracle_views as V
from cartwheel.plans.registry import register
from cartwheel.session import scratch_path
from cartwheel.sources import sinks, snapshots, tables

I = V.with_(V.INTERACTIONS)
R = V.with_(V.REVIEWS)


def _events(spark, sf_dir):
    return tables.interactions(spark, sf_dir, with_attributes=False)


@register("csv_round_trip", I + """
SELECT user_session, '[' || array_to_string(list_sort(list(product_id)), ' ') || ']' AS items, COUNT(*) AS n
FROM interactions WHERE user_session IS NOT NULL AND product_id IS NOT NULL GROUP BY user_session""")
def csv_round_trip(spark, sf_dir):
    """Session lists written as CSV (arrays as text) and read with a declared schema."""
    lists = FE.session_item_lists(_events(spark, sf_dir)).withColumn("n", F.size("items"))
    path = scratch_path(spark, "session-csv")
    sinks.write_csv(lists, path)
    return tables.read_csv(spark, path, "user_session string, items string, n bigint")


@register("table_versions", """
SELECT p_partkey, p_brand, p_retailprice, CASE WHEN p_retailprice >= 1500 THEN 'high' ELSE 'low' END AS price_class FROM part""")
def table_versions(spark, sf_dir):
    """A table overwritten, appended to, and overwritten by a plan that reads it,
    with another schema; the newest version."""
    part = tables.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice", "p_size")
    path = scratch_path(spark, "part-versions")
    snapshots.write(part.where("p_size <= 25"), path)
    snapshots.write(part.where("p_size > 25 OR p_size IS NULL"), path, "append")
    price_class = F.when(F.col("p_retailprice") >= 1500, F.lit("high")).otherwise(F.lit("low"))
    snapshots.write(snapshots.read(spark, path).drop("p_size").withColumn("price_class", price_class), path)
    return snapshots.read(spark, path)


@register("daily_counts_on_disk", I + """
SELECT strftime(CAST(event_time AS DATE), '%Y-%m-%d') AS day, event_type, COUNT(*) AS count FROM interactions
WHERE event_time IS NOT NULL GROUP BY 1, 2""")
def daily_counts_on_disk(spark, sf_dir):
    """An aggregate saved below a path, loaded again and written as Parquet."""
    daily = _events(spark, sf_dir).where("event_time IS NOT NULL").groupBy(
        F.to_date("event_time").cast("string").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("count"))
    first, second = scratch_path(spark, "daily-path"), scratch_path(spark, "daily-parquet")
    sinks.save_path(daily, first)
    sinks.write_parquet(sinks.load_path(spark, first), second)
    return spark.read.parquet(second)


@register("logged_metrics", I + """
SELECT 'events' AS run, 'rows' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM interactions UNION ALL
SELECT 'events', 'users', CAST(COUNT(DISTINCT user_id) AS DOUBLE) FROM interactions UNION ALL
SELECT 'events', 'purchases', CAST(COUNT(*) AS DOUBLE) FROM interactions WHERE event_type = 'purchase'""")
def logged_metrics(spark, sf_dir):
    """Metrics of a run appended to a metrics table and read back."""
    ev = _events(spark, sf_dir)
    found = ev.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("user_id").alias("users"),
                   F.count(F.when(F.col("event_type") == "purchase", 1)).alias("purchases")).first().asDict()
    name = f"run_metrics_{uuid.uuid4().hex[:12]}"
    sinks.log_metrics(spark, "events", found, table=name)
    return sinks.read_table(spark, name).select("run", "metric", "value")


@register("dearest_parts", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 5")
def dearest_parts(spark, sf_dir):
    """A preview of five rows."""
    part = tables.table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return sinks.preview(part.orderBy(F.desc("p_retailprice"), "p_partkey"), 5)


@register("complete_reviews", R + """
SELECT DISTINCT brand_name, lang AS review_lang, product_rating AS rating_raw, review_label FROM reviews
WHERE brand_name IS NOT NULL AND lang IS NOT NULL AND product_rating IS NOT NULL AND review_label IS NOT NULL""")
def complete_reviews(spark, sf_dir):
    """Names cleaned, rows with any null left out, equal rows once."""
    rv = tables.reviews(spark, sf_dir).select(
        "brand_name", F.col("lang").alias("review lang"), F.col("product_rating").alias("rating.raw"), "review_label")
    return C.exact_dedup(C.drop_null_rows(C.sanitize_names(rv)))


@register("titled_reviews", R + "SELECT review_id, review_label FROM reviews WHERE review_title IS NOT NULL AND price IS NOT NULL")
def titled_reviews(spark, sf_dir):
    """Rows with a null in some columns left out; nulls elsewhere stay."""
    return C.drop_null_rows(tables.reviews(spark, sf_dir), ["review_title", "price"]).select("review_id", "review_label")


@register("bought_by_users", I + """
SELECT user_id, product_id, (SELECT COUNT(product_id) FROM interactions) AS n_values FROM (
  SELECT DISTINCT user_id, product_id FROM interactions WHERE event_type = 'purchase')""")
def bought_by_users(spark, sf_dir):
    """Distinct (user, product) pairs; how many events name a product."""
    ev = _events(spark, sf_dir)
    values = C.non_null_values(ev, "product_id").agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return C.distinct_pairs(C.of_type(ev, "purchase"), "user_id", "product_id").withColumn("n_values", values)


@register("events_with_truth", I + """
SELECT event_id, user_session FROM interactions WHERE user_session IN (
  SELECT user_session FROM interactions WHERE event_type = 'purchase')""")
def events_with_truth(spark, sf_dir):
    """Events of the sessions that bought something."""
    ev = C.require_columns(_events(spark, sf_dir), "event_id", "user_session", "event_type")
    return C.with_truth(ev, C.of_type(ev, "purchase"), "user_session").select("event_id", "user_session")


@register("random_split_parts", """
SELECT COUNT(*) AS n_rows, TRUE AS complete, TRUE AS disjoint, TRUE AS near_weights FROM events""")
def random_split_parts(spark, sf_dir):
    """What every random split must satisfy: its parts hold each row once, in about
    the shares asked for (six standard deviations)."""
    ev = _events(spark, sf_dir).select("event_id")
    train, test = C.split_random(ev, (0.8, 0.2), 7)
    both = train.withColumn("part", F.lit(0)).unionByName(test.withColumn("part", F.lit(1)))
    each = both.groupBy("event_id").agg(F.count(F.lit(1)).alias("times"), F.max("part").alias("part"))
    total = ev.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    off = F.abs(F.sum("part") - F.lit(0.2) * F.count(F.lit(1)))
    return each.agg(F.sum("times").alias("n_rows"), (F.count(F.lit(1)) == total).alias("complete"),
                    (F.max("times") == 1).alias("disjoint"),
                    (off <= 6 * F.sqrt(F.count(F.lit(1)) * F.lit(0.16))).alias("near_weights"))


@register("session_overlap", I + """, s AS (
  SELECT user_session, COUNT(*) FILTER (WHERE event_type = 'view') AS v, COUNT(*) FILTER (WHERE event_type = 'cart') AS c,
         COUNT(*) FILTER (WHERE event_type = 'purchase') AS p,
         COALESCE(list_distinct(list(product_id) FILTER (WHERE event_type = 'view' AND product_id IS NOT NULL)), []) AS seen,
         COALESCE(list_distinct(list(product_id) FILTER (WHERE event_type = 'purchase' AND product_id IS NOT NULL)), []) AS bought
  FROM interactions WHERE user_session IS NOT NULL GROUP BY user_session)
SELECT user_session, CAST(len(list_intersect(seen, bought)) AS INTEGER) AS n_both, CAST(p >= 1 AS INTEGER) AS has_bought,
  array_to_string(list_filter(['view', 'cart', 'purchase'], lambda x: CASE x WHEN 'view' THEN v WHEN 'cart' THEN c ELSE p END
    > 0.4 * (v + c + p)), '|') AS main_types, TRUE AS in_the_past FROM s""")
def session_overlap(spark, sf_dir):
    """Products both seen and bought in a session, whether it bought
    anything, and the event types with more than 40% of its events."""
    ev = _events(spark, sf_dir).where("user_session IS NOT NULL")
    of = lambda t: F.col("event_type") == t
    types = ["view", "cart", "purchase"]
    per = ev.groupBy("user_session").agg(
        F.collect_set(F.when(of("view"), F.col("product_id"))).alias("seen"),
        F.collect_set(F.when(of("purchase"), F.col("product_id"))).alias("bought"),
        *(F.count(F.when(of(t), 1)).alias(t) for t in types), F.max("event_time").alias("latest"))
    total = F.col("view") + F.col("cart") + F.col("purchase")
    shares = F.array(*(F.when(total > 0, F.col(t) / total).otherwise(F.lit(0.0)) for t in types))
    labelled = per.withColumn("labels", F.array(*map(F.lit, types))).withColumn("shares", shares)
    return labelled.select(
        "user_session", A.overlap_size("seen", "bought").alias("n_both"), S.presence("purchase").alias("has_bought"),
        F.array_join(A.keep_scored("labels", "shares", 0.4), "|").alias("main_types"),
        (F.col("latest").cast("timestamp") <= S.now()).alias("in_the_past"))


@register("eda_frames", V.with_(V.INTERACTIONS, V.REVIEWS) + """
SELECT 'daily_engagement' AS name, COUNT(*) AS n_rows FROM (SELECT DISTINCT CAST(event_time AS DATE) FROM interactions WHERE event_time IS NOT NULL) UNION ALL
SELECT 'price_histogram', 50 UNION ALL
SELECT 'sentiment_counts', COUNT(*) FROM (SELECT DISTINCT review_label FROM reviews) UNION ALL
SELECT 'sentiment_rating', COUNT(*) FROM (SELECT DISTINCT review_label, product_rating FROM reviews) UNION ALL
SELECT 'top_products', 10""")
def eda_frames(spark, sf_dir):
    """The data behind the exploratory charts; rows of each frame."""
    bundle = FL.eda_bundle(_events(spark, sf_dir), tables.reviews(spark, sf_dir), price="price")
    names = ["daily_engagement", "price_histogram", "sentiment_counts", "sentiment_rating", "top_products"]
    out = None
    for name in names:
        one = bundle[name].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out
