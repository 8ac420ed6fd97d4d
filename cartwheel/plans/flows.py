"""Composed flows of the reference (M18) and the EDA bundle."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartwheel.functions import scalar as S
from cartwheel.functions import text as TX
from cartwheel.operators import clean as C
from cartwheel.operators import explore as X
from cartwheel.operators import features as FE


# What the reference fills missing texts with.
MISSING_TITLE = "No title"
MISSING_TEXT = "No review"


def clean_cosmetic(df: DataFrame) -> DataFrame:
    """Live ``clean_cosmetic_df``: fallback title (F6), renames, positive price."""
    out = df.withColumn("cosmetic_product_title_clean", S.fallback_title("category_code", "brand"))
    out = C.rename(out, {"product_id": "cosmetic_product_id", "price": "cosmetic_price"})
    return C.positive(out, "cosmetic_price")


def clean_reviews(df: DataFrame) -> DataFrame:
    """Live ``clean_reviews_df``: cleaned product title (F1) and renames."""
    out = df.withColumn("review_product_title_clean", TX.clean_title("product_title"))
    return C.rename(out, {"product_id": "review_product_id", "price": "review_price"})


def process_reviews_text(df: DataFrame) -> DataFrame:
    """Live ``process_reviews_df`` (P7) plus the archived text features the EDA
    reads (F2 cleaning, F3 stems, F4 lemmas — defect D8 restored)."""
    out = C.fill_nulls(df, {"review_title": MISSING_TITLE, "review_text": MISSING_TEXT})
    out = out.withColumn("review_title_clean", TX.clean_text_stop("review_title")).withColumn(
        "review_text_clean", TX.clean_text_stop("review_text"))
    out = C.fill_nulls(out, {"review_title_clean": MISSING_TITLE, "review_text_clean": MISSING_TEXT})
    # Each text is split into tokens once, for its stems and its lemmas.
    out = out.withColumn("_title", TX.ws_tokens(TX.safe_text("review_title_clean"))).withColumn(
        "_text", TX.ws_tokens(TX.safe_text("review_text_clean")))
    return (out.withColumn("stemmed_title", TX.stem3_tokens("_title"))
               .withColumn("lemmatized_title", TX.lemmatize_tokens("_title"))
               .withColumn("stemmed_text", TX.stem3_tokens("_text"))
               .withColumn("lemmatized_text", TX.lemmatize_tokens("_text")).drop("_title", "_text"))


def clean_mapping(df: DataFrame) -> DataFrame:
    """Archived mapping clean: exact de-dup, renames, rows with NULLs dropped."""
    out = C.exact_dedup(df)
    out = C.rename(out, {"product_id_events": "cosmetic_product_id",
                         "product_id_reviews": "review_product_id"})
    return C.drop_null_rows(out)


def transform_mapping(df: DataFrame) -> DataFrame:
    """Archived mapping transform: int casts, 3σ filter on the review id, scaling (M4)."""
    out = df.withColumns({"cosmetic_product_id": S.to_int("cosmetic_product_id"),
                          "review_product_id": S.to_int("review_product_id")})
    out = C.outliers_removed(out, "review_product_id")
    return FE.scale_columns(out, ["cosmetic_product_id", "review_product_id"], "mapping_scaled_features")


def eda_bundle(combined: DataFrame, reviews: DataFrame, price: str = "cosmetic_price",
               review_price: str = "review_price", rating: str = "product_rating",
               time: str = "event_time", review_rating: str = "product_rating") -> dict:
    """M19 ``perform_eda``: the data behind every chart, as lazy DataFrames."""
    numeric = [c for c in dict.fromkeys((price, review_price, rating, "product_rating_count"))
               if c in combined.columns]
    typed = combined.withColumns({c: S.to_double_or_zero(c) for c in numeric})
    out = {
        "summary": X.describe_long(typed, numeric),
        "daily_engagement": X.daily_counts(combined, time),
        "sentiment_counts": X.counts_by(reviews, "review_label"),
        "sentiment_rating": X.counts_by(reviews, "review_label", review_rating),
        "top_products": X.top_n(reviews, "product_title", 10),
    }
    if "event_type_index" in combined.columns:
        out["event_type_counts"] = X.counts_by(combined, "event_type_index")
    if price in typed.columns:
        out["price_histogram"] = X.histogram(typed, price, 50)
    if review_price in typed.columns:
        out["review_price_histogram"] = X.histogram(typed, review_price, 50)
    if rating in typed.columns:
        out["rating_histogram"] = X.histogram(typed, rating, 10)
        out["rating_density"] = X.kde(typed, rating)
    if "lemmatized_text" in reviews.columns:
        out["top_words"] = X.word_frequencies(reviews, "lemmatized_text", 20)
    return out
