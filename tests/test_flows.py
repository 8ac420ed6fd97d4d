"""Composed flows (M18), the EDA bundle (M19) and the evaluation table."""

from pyspark.sql import functions as F

from cartwheel.operators import evaluate as EV
from cartwheel.operators import features as FE
from cartwheel.plans import flows as FL
from cartwheel.sources import sinks, tables

from conftest import SF_SMALL


def test_clean_flows(spark):
    ev = tables.interactions(spark, SF_SMALL)
    cleaned = FL.clean_cosmetic(ev)
    assert {"cosmetic_product_id", "cosmetic_price", "cosmetic_product_title_clean"} <= set(cleaned.columns)
    assert cleaned.where("cosmetic_price <= 0").count() == 0
    rv = FL.process_reviews_text(FL.clean_reviews(tables.reviews(spark, SF_SMALL)))
    assert {"review_product_id", "review_price", "lemmatized_text", "stemmed_title"} <= set(rv.columns)
    assert rv.where(F.col("review_text_clean").isNull()).count() == 0


def test_mapping_flows(spark):
    m = spark.createDataFrame([(1, 10), (1, 10), (2, None), (3, 30), (4, 40)],
                              "product_id_events int, product_id_reviews int")
    cleaned = FL.clean_mapping(m)
    assert cleaned.count() == 3 and cleaned.columns == ["cosmetic_product_id", "review_product_id"]
    out = FL.transform_mapping(cleaned)
    assert "mapping_scaled_features" in out.columns and out.count() == 3


def test_eda_bundle(spark):
    ev = FE.engagement_index(FL.clean_cosmetic(tables.interactions(spark, SF_SMALL)))
    rv = FL.process_reviews_text(FL.clean_reviews(tables.reviews(spark, SF_SMALL)))
    bundle = FL.eda_bundle(ev, rv, rating="cosmetic_price")
    assert {"summary", "daily_engagement", "sentiment_counts", "sentiment_rating", "top_products",
            "event_type_counts", "price_histogram", "rating_density", "top_words"} <= set(bundle)
    assert bundle["price_histogram"].count() == 50
    assert bundle["top_words"].count() <= 20
    assert sum(r["count"] for r in bundle["daily_engagement"].collect()) == ev.count()


def test_metrics_table_append_and_view(spark):
    pr = spark.createDataFrame([(0.5, 0.25)], "precision_at_k double, recall_at_k double")
    table = EV.metrics_table({"cosine": pr, "als": pr}, 10)
    assert [f.nullable for f in table.schema.fields] == [False] * 5
    sinks.append_table(table, "model_evaluation")
    view = sinks.evaluation_view(spark, "model_evaluation")
    assert view.columns == ["model_type", "top_k", "precision_at_k", "recall_at_k", "evaluation_timestamp"]
    assert view.count() >= 2
