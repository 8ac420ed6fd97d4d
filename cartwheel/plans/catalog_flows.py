"""Step 11 queries: the reference's composed cleaning flows (M18) and sinks."""


from cartwheel.plans import flows as FL
from cartwheel.plans import oracle_views as V
from cartwheel.plans.registry import register
from cartwheel.sources import tables


@register("cleaned_events", V.with_(V.INTERACTIONS) + """
SELECT event_id, product_id AS cosmetic_product_id, price AS cosmetic_price,
       COALESCE(category_code, brand) AS cosmetic_product_title_clean
FROM interactions WHERE price > 0""")
def cleaned_events(spark, sf_dir):
    """M18 ``clean_cosmetic_df`` on the event table."""
    out = FL.clean_cosmetic(tables.interactions(spark, sf_dir))
    return out.select("event_id", "cosmetic_product_id", "cosmetic_price", "cosmetic_product_title_clean")


def _cleaned(column: str, missing: str) -> str:
    filled = f"COALESCE({column}, '{missing}')"
    return f"COALESCE({V.sql_clean_text_stop(filled)}, '{missing}')"


_TITLE, _TEXT = _cleaned("review_title", "No title"), _cleaned("review_text", "No review")


@register("processed_titles", V.with_(V.REVIEWS) + f"""
SELECT review_id, {V.sql_stem3(_TITLE)} AS stemmed_title, {V.sql_lemmatize(_TITLE)} AS lemmatized_title,
       {V.sql_stem3(_TEXT)} AS stemmed_text, {V.sql_lemmatize(_TEXT)} AS lemmatized_text,
       {V.sql_clean_title('product_title')} AS review_product_title_clean
FROM reviews""")
def processed_titles(spark, sf_dir):
    """M18 ``clean_reviews_df`` + ``process_reviews_df`` with the archived title and text features."""
    out = FL.process_reviews_text(FL.clean_reviews(tables.reviews(spark, sf_dir)))
    return out.select("review_id", "stemmed_title", "lemmatized_title", "stemmed_text", "lemmatized_text",
                      "review_product_title_clean")
