"""Step 4 queries: data-quality checks Q1–Q11."""

import functools
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.operators import clean as C
from cartwheel.operators import quality as Q
from cartwheel.operators import similarity as sim
from cartwheel.plans import oracle_views as V
from cartwheel.plans.catalog_baskets import MIN_CONFIDENCE, MIN_SUPPORT
from cartwheel.plans.catalog_recs import COSINE_WIDE_SQL
from cartwheel.plans.registry import register
from cartwheel.session import checkpoint_dir, ship_package
from cartwheel.sources import schemas, tables

_REVIEW_COLS = ["review_id", "product_id", "brand_name", "review_title", "review_text", "lang",
                "product_title", "product_rating", "review_label", "product_rating_count", "price", "review_date"]


@register("null_fraction", V.with_(V.REVIEWS) + "\nUNION ALL\n".join(
    f"SELECT 'null_fraction' AS \"check\", '{c}' AS target, "
    f"CASE WHEN v IS NULL THEN 'empty' WHEN v > 0.5 THEN 'fail' ELSE 'pass' END AS status, "
    f"ROUND(v, 9) AS value, 0.5 AS threshold, CAST(NULL AS VARCHAR) AS detail "
    f"FROM (SELECT AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS v FROM reviews)"
    for c in _REVIEW_COLS))
def null_fraction(spark, sf_dir):
    return Q.null_fractions(tables.reviews(spark, sf_dir), 0.5).withColumn("value", F.round("value", 9))


@register("duplicate_count", """
SELECT CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) AS n_distinct, CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicates
FROM (SELECT text, COUNT(*) AS n FROM documents GROUP BY text)""")
def duplicate_count(spark, sf_dir):
    return Q.duplicate_count(tables.table(spark, sf_dir, "documents"), ["text"])


@register("range_checks", V.with_(V.INTERACTIONS, """agg AS (
  SELECT COUNT(CASE WHEN event_time IS NOT NULL AND (CAST(event_time AS DATE) < DATE '2024-01-01'
                     OR CAST(event_time AS DATE) > DATE '2024-01-31') THEN 1 END) AS bad_0,
         COUNT(event_time) AS n_0,
         COUNT(CASE WHEN price IS NOT NULL AND (price < 0.0 OR price > 50.0) THEN 1 END) AS bad_1,
         COUNT(price) AS n_1
  FROM interactions
)""") + """
SELECT 'date_range' AS "check", 'event_time' AS target, CASE WHEN bad_0 = 0 THEN 'pass' ELSE 'fail' END AS status,
       CAST(bad_0 AS DOUBLE) AS value, CAST(n_0 AS DOUBLE) AS threshold, '2024-01-01..2024-01-31' AS detail FROM agg
UNION ALL
SELECT 'numeric_range', 'price', CASE WHEN bad_1 = 0 THEN 'pass' ELSE 'fail' END,
       CAST(bad_1 AS DOUBLE), CAST(n_1 AS DOUBLE), '0.0..50.0' FROM agg""")
def range_checks(spark, sf_dir):
    ev = tables.interactions(spark, sf_dir, with_attributes=False)
    return Q.range_checks(ev, date_rules={"event_time": ("2024-01-01", "2024-01-31")},
                          numeric_rules={"price": (0.0, 50.0)})


@register("row_count", "SELECT 'row_count' AS \"check\", CAST(NULL AS VARCHAR) AS target, "
          "CASE WHEN COUNT(*) >= 1 THEN 'pass' ELSE 'fail' END AS status, CAST(COUNT(*) AS DOUBLE) AS value, "
          "1.0 AS threshold, CAST(NULL AS VARCHAR) AS detail FROM events")
def row_count(spark, sf_dir):
    return Q.row_count(tables.table(spark, sf_dir, "events"), 1)


_INTERACTION_COLUMNS = ["event_id", "event_time", "event_type", "product_id", "price", "user_id", "user_session",
                        "category_code", "brand"]
# The frame's columns by position against the declared ones: name, type, nullability.
_EXPECTED_FIELDS = [
    ("event_time", 0, "event_id:bigint:True vs event_time:timestamp:True"),
    ("event_type", 1, "event_time:timestamp_ntz:True vs event_type:string:True"),
    ("product_id", 2, "event_type:string:True vs product_id:int:True"),
    ("category_id", 3, "product_id:int:True vs category_id:bigint:True"),
    ("category_code", 4, "price:double:True vs category_code:string:True"),
    ("brand", 5, "user_id:bigint:True vs brand:string:True"),
    ("price", 6, "user_session:string:True vs price:double:True"),
    ("user_id", 7, "category_code:string:True vs user_id:int:True"),
    ("user_session", 8, "brand:string:True vs user_session:string:True")]
_SCHEMA_ROWS = ", ".join(
    [f"('schema_field', '{n}', 'fail', {i}.0, '{d}')" for n, i, d in _EXPECTED_FIELDS]
    + ["('data_type', 'event_time', 'fail', NULL, 'timestamp_ntz vs timestamp')",
       "('data_type', 'price', 'pass', NULL, 'double vs double')", "('data_type', 'product_id', 'pass', NULL, 'int vs int')"])


@register("schema_check", V.with_(V.INTERACTIONS, f"""c("check", target, status, value, detail) AS (VALUES {_SCHEMA_ROWS})""",
          "n AS (" + " UNION ALL ".join(f"SELECT '{c}' AS target, COUNT({c}) AS observed FROM interactions"
                                        for c in _INTERACTION_COLUMNS) + ")") + """
SELECT c."check", c.target, c.status, CAST(c.value AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS threshold, c.detail, COALESCE(n.observed, 0) AS observed
FROM c LEFT JOIN n USING (target)""")
def schema_check(spark, sf_dir):
    """Q1/Q4 of the interaction table against the declared schema, with the number
    of values that each checked column holds."""
    ev = tables.interactions(spark, sf_dir)
    checks = Q.schema_check(ev, schemas.INTERACTIONS).unionByName(
        Q.type_check(ev, {"event_time": "timestamp", "price": "double", "product_id": "int"}))
    held = ev.agg(*(F.count(c).alias(c) for c in ev.columns)).unpivot([], ev.columns, "target", "observed")
    return checks.join(held, "target", "left").withColumn("observed", F.coalesce("observed", F.lit(0)))


_RECS, _SCORES = [f"Rec_{i}" for i in range(1, 11)], [f"Score_{i}" for i in range(1, 11)]
_CHECK = 'SELECT {} AS "check", {} AS target, {} AS status, CAST({} AS DOUBLE) AS value, CAST({} AS DOUBLE) AS threshold, CAST(NULL AS VARCHAR) AS detail'


@register("cosine_output_check", "WITH wide AS (" + COSINE_WIDE_SQL + ")\n" + "\nUNION ALL\n".join(
    [_CHECK.format("'cosine_columns'", "'" + ",".join(["item", *_RECS, *_SCORES]) + "'", "'pass'", 0, 0),
     _CHECK.format("'cosine_score_types'", "NULL", "'pass'", 0, 0),
     _CHECK.format("'non_empty'", "NULL", "CASE WHEN COUNT(*) > 0 THEN 'pass' ELSE 'fail' END", "COUNT(*)", 1) + " FROM wide",
     _CHECK.format("'key_nulls'", "'item'", "CASE WHEN COUNT(*) = COUNT(item) THEN 'pass' ELSE 'fail' END",
                   "COUNT(*) - COUNT(item)", 0) + " FROM wide",
     _CHECK.format("'key_duplicates'", "'item'", "CASE WHEN COUNT(item) = COUNT(DISTINCT item) THEN 'pass' ELSE 'fail' END",
                   "COUNT(item) - COUNT(DISTINCT item)", 0) + " FROM wide"]
    + [_CHECK.format("'rec_nulls'", f"'{c}'", "'info'", f"COUNT(*) - COUNT({c})", "NULL") + " FROM wide" for c in _RECS]))
def cosine_output_check(spark, sf_dir):
    """Q8 on the wide cosine recommendations."""
    wide = sim.cosine_wide(sim.cosine_topk(tables.order_baskets(spark, sf_dir)))
    return Q.cosine_output_check(wide, 10, "item")


_MODEL_OUTPUTS = {"fp_itemsets": ["items", "freq"], "fp_rules": ["antecedent", "consequent", "confidence"],
                  "als_user_recs": ["user", "rank", "item", "score"], "als_item_recs": ["item", "rank", "user", "score"],
                  "ncf_recs": ["user", "rank", "item", "score"]}


@register("model_output_checks", "\nUNION ALL\n".join(
    part for name, cols in _MODEL_OUTPUTS.items() for part in (
        _CHECK.format(f"'{name}_columns'", f"'{','.join(cols)}'", "'pass'", 0, 0),
        _CHECK.format(f"'{name}_non_empty'", "NULL", "CASE WHEN COUNT(*) > 0 THEN 'pass' ELSE 'fail' END",
                      "least(COUNT(*), 1)", 1) + (" FROM lineitem" if name.startswith("fp") else " FROM events"))))
def model_output_checks(spark, sf_dir):
    """Q9–Q11: itemsets, rules, ALS and factor-model recommendations have their
    required columns and are not empty."""
    from cartwheel.operators import baskets as B
    from cartwheel.operators import factors as FA
    ev = tables.interactions(spark, sf_dir, with_attributes=False)

    def itemsets():
        baskets = B.build_baskets(tables.order_baskets(spark, sf_dir, item="brand"))
        model = B.fit_fpgrowth(baskets, MIN_SUPPORT, MIN_CONFIDENCE)
        return {"fp_itemsets": B.frequent_itemsets(model), "fp_rules": B.association_rules(model)}

    def als():
        purchases = ev.where(F.col("event_type") == "purchase").select(
            F.col("user_session").alias("user"), F.col("product_id").alias("item"), F.lit(1.0).alias("score")
        ).where(F.col("item").isNotNull())
        model = FA.fit_als(purchases)
        return {"als_user_recs": FA.recommend_items(model, 10), "als_item_recs": FA.recommend_users(model, 10)}

    def ncf():
        model = FA.fit_biased(FA.ncf_interactions(C.valid_events(ev), user="user_id"))
        return {"ncf_recs": FA.recommend_items(model, 10)}

    # The three models do not need each other; each is many small jobs, so they run side by side.
    checkpoint_dir(spark)
    ship_package(spark)
    with ThreadPoolExecutor(3) as pool:
        models = [pool.submit(inheritable_thread_target(spark)(f)) for f in (itemsets, als, ncf)]
        frames = {name: frame for m in models for name, frame in m.result().items()}
    checks = [Q.model_output_check(frames[name], name, cols) for name, cols in _MODEL_OUTPUTS.items()]
    return functools.reduce(DataFrame.unionByName, checks)
