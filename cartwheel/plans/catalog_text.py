"""Step 9 queries: topics, sentiment, topic engagement."""

from pyspark.sql import functions as F

from cartwheel.functions import text as TX
from cartwheel.operators import features as FE
from cartwheel.operators import learned as LE
from cartwheel.operators import lemmatiser as LM
from cartwheel.operators import textops as TO
from cartwheel.plans import oracle_views as V
from cartwheel.plans.registry import register
from cartwheel.sources import tables


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(V._q(str(x)) for x in r) + ")" for r in rows)


# The driver's texts are invented prose, in which the operators' own lexicons find
# nothing.  The queries pass lexicons of words that do occur.
TERMS = {"product quality": ["the", "ci"], "packaging": ["of", "que"], "price": ["and", "der"],
         "customer service": ["to", "le"], "delivery": ["in", "la"], "ingredients": ["de"],
         "effectiveness": ["is", "en"]}
POSITIVE = ["the", "der", "la", "ci"]
NEGATIVE = ["of", "and", "to", "de", "le", "und"]
_TOPIC_LEX = _values([(t, lbl) for lbl, ts in TERMS.items() for t in ts])
_SENT_LEX = _values([(t, "POSITIVE") for t in POSITIVE] + [(t, "NEGATIVE") for t in NEGATIVE])

TOPIC_CTE = V.with_(V.REVIEWS, f"""lex(term, label) AS (VALUES {_TOPIC_LEX})""",
                    f"""toks AS (SELECT review_id, unnest({V.sql_letter_tokens('review_text')}) AS term FROM reviews)""",
                    """hits AS (SELECT t.review_id, l.label, COUNT(*) AS c FROM toks t JOIN lex l USING (term)
                  GROUP BY t.review_id, l.label)""",
                    """tot AS (SELECT review_id, SUM(c) AS total FROM hits GROUP BY review_id)""",
                    """kept AS (SELECT h.review_id, h.label, h.c / t.total AS share FROM hits h JOIN tot t USING (review_id)
                  WHERE h.c / t.total > 0.4)""",
                    """topics AS (
  SELECT r.review_id, COALESCE(string_agg(k.label, '|' ORDER BY k.share DESC, k.label), '') AS topics
  FROM reviews r LEFT JOIN kept k USING (review_id) GROUP BY r.review_id
)""")


@register("topic_tags", TOPIC_CTE + "SELECT review_id, topics FROM topics")
def topic_tags(spark, sf_dir):
    rv = TO.process_reviews(tables.reviews(spark, sf_dir).select("review_id", "review_text"), terms=TERMS)
    return rv.select("review_id", F.array_join("topics", "|").alias("topics"))


SENTIMENT_CTE = V.with_(V.REVIEWS) + f"""sent_lex(term, label) AS (VALUES {_SENT_LEX}),
sent_toks AS (SELECT review_id, unnest({V.sql_letter_tokens('review_text')}) AS term FROM reviews),
sent_c AS (SELECT t.review_id, COUNT(CASE WHEN l.label = 'POSITIVE' THEN 1 END) AS pos,
                  COUNT(CASE WHEN l.label = 'NEGATIVE' THEN 1 END) AS neg
           FROM sent_toks t JOIN sent_lex l USING (term) GROUP BY t.review_id),
sentiment AS (
  SELECT r.review_id,
         CASE WHEN r.review_text IS NULL OR length(r.review_text) = 0 THEN NULL
              WHEN COALESCE(pos, 0) >= COALESCE(neg, 0) THEN 'POSITIVE' ELSE 'NEGATIVE' END AS sentiment_label,
         CASE WHEN r.review_text IS NULL OR length(r.review_text) = 0 THEN NULL
              WHEN COALESCE(pos, 0) + COALESCE(neg, 0) = 0 THEN 0.5
              ELSE ROUND(GREATEST(pos, neg) / (pos + neg), 9) END AS sentiment_score
  FROM reviews r LEFT JOIN sent_c USING (review_id))
"""


@register("sentiment", SENTIMENT_CTE.replace("WITH " + V.REVIEWS, "WITH " + V.REVIEWS + ",")
          + "SELECT review_id, sentiment_label, sentiment_score FROM sentiment")
def sentiment(spark, sf_dir):
    # Texts are scored where they are read; only the scores meet the labels, which say
    # how often a document is a review.
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("_tok", F.coalesce(TX.letter_tokens("text"), F.array().cast("array<string>")))
    docs = TO.add_sentiment(docs, "_tok", "text", "s", POSITIVE, NEGATIVE).select("doc_id", F.get("s", F.lit(0)).alias("s"))
    rv = tables.labelled(spark, sf_dir, docs)
    return rv.select(F.col("doc_id").alias("review_id"), F.col("s.label").alias("sentiment_label"),
                     F.round("s.score", 9).alias("sentiment_score"))


@register("topic_engagement", (TOPIC_CTE + """, joined AS (
  SELECT r.review_id, r.product_id AS review_product_id, i.product_id AS cosmetic_product_id,
         i.event_id, i.event_type, i.event_time
  FROM reviews r JOIN mapping m ON m.product_id_reviews = r.product_id
  JOIN interactions i ON i.product_id = m.product_id_events
), ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY review_product_id, cosmetic_product_id
                               ORDER BY event_time, event_id, review_id) AS rn
  FROM joined
), one AS (SELECT * FROM ranked WHERE rn = 1)
SELECT k.label AS topic, o.event_type, COUNT(*) AS count
FROM one o JOIN kept k ON k.review_id = o.review_id GROUP BY k.label, o.event_type""").replace(
    "WITH ", "WITH " + V.INTERACTIONS + ",\n" + V.MAPPING + ",\n", 1))
def topic_engagement(spark, sf_dir):
    """M17 on the de-duplicated review↔event rows (D5 fixed with a deterministic pick)."""
    rv = TO.process_reviews(tables.reviews(spark, sf_dir).select("review_id", "product_id", "review_text"),
                            terms=TERMS)
    one = FE.mapped_first_events(rv, tables.mapping(spark, sf_dir),
                                 tables.interactions(spark, sf_dir, with_attributes=False),
                                 ["review_id", "topics"], ["event_id", "event_type", "event_time"])
    return TO.analyze_topics(one)


# Deterministic stand-ins for a topic model, a sentiment model and embedders.
def toy_topics():
    return lambda texts: texts.map(lambda t: [] if not t else [
        "long" if len(t) > 1500 else "short", *([] if t.isascii() else ["accents"])])


def toy_sentiment():
    def score(t):
        if not t:
            return []
        a, e = t.count("a"), t.count("e")
        return [{"label": "POSITIVE" if a >= e else "NEGATIVE", "score": max(a, e) / (a + e) if a + e else 0.5}]
    return lambda texts: texts.map(score)


def toy_embedder():
    return lambda texts: texts.map(lambda t: [] if not t else [float(len(t)), float(t.count(" ")), float(t.count("e"))])


def failing_embedder():
    def embed(t):
        if t and "\u00df" in t:
            raise ValueError("unknown character")
        return [] if not t else [float(len(t))]
    return lambda texts: texts.map(embed)


@register("model_hook", """
WITH d AS (SELECT doc_id, text, length(text) AS n, length(text) - length(replace(text, 'a', '')) AS a,
  length(text) - length(replace(text, 'e', '')) AS e, length(text) - length(replace(text, ' ', '')) AS s,
  regexp_matches(text, '[^\x00-\x7F]') AS accents FROM documents)
SELECT doc_id, CASE WHEN n = 0 OR n IS NULL THEN '' ELSE (CASE WHEN n > 1500 THEN 'long' ELSE 'short' END)
         || (CASE WHEN accents THEN '|accents' ELSE '' END) END AS topics,
       CASE WHEN n > 0 THEN CASE WHEN a >= e THEN 'POSITIVE' ELSE 'NEGATIVE' END END AS sentiment_label,
       CASE WHEN n > 0 THEN CASE WHEN a + e > 0 THEN ROUND(greatest(a, e) / (a + e), 9) ELSE 0.5 END END AS sentiment_score,
       CASE WHEN n > 0 THEN CAST(n AS VARCHAR) || ' ' || CAST(s AS VARCHAR) || ' ' || CAST(e AS VARCHAR) ELSE '' END AS embedding,
       CAST(CASE WHEN n > 0 AND NOT contains(text, 'ß') THEN 1 ELSE 0 END AS INTEGER) AS embedded
FROM d""")
def model_hook(spark, sf_dir):
    """User models through the Arrow-batched hook."""
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = docs.select(
        "doc_id", TO.model_column(toy_topics, "array<string>", "text").alias("t"),
        TO.model_column(toy_sentiment, TO.SENTIMENT_TYPE, "text").alias("s"),
        TO.model_column(toy_embedder, "array<float>", "text").alias("v"),
        TO.model_column(failing_embedder, "array<float>", "text", on_error="empty").alias("w"))
    return out.select(
        "doc_id", F.array_join("t", "|").alias("topics"), F.get("s", F.lit(0))["label"].alias("sentiment_label"),
        F.round(F.get("s", F.lit(0))["score"], 9).alias("sentiment_score"),
        F.array_join(F.transform("v", lambda x: x.cast("bigint").cast("string")), " ").alias("embedding"),
        F.size("w").alias("embedded"))


@register("learned_topics")
def learned_topics(spark, sf_dir):
    """M10 from data: a topic model of all reviews, and each review's topics above 0.4 (rows-only)."""
    rv = tables.reviews(spark, sf_dir).select("review_id", "review_text")
    model = LE.fit_topics(rv, "review_text", max_iter=10)
    return LE.add_learned_topics(rv, model, "review_text").select("review_id", F.array_join("topics", "|").alias("topics"))


@register("learned_sentiment")
def learned_sentiment(spark, sf_dir):
    """M11 from labels: fitted on the rated reviews, given for all (rows-only)."""
    rv = tables.reviews(spark, sf_dir).select("review_id", "review_text", F.col("product_rating").cast("int").alias("rating"))
    out = LE.add_learned_sentiment(rv, LE.fit_sentiment(rv, "review_text", "rating"), "review_text")
    return out.select("review_id", F.get("sentiment", F.lit(0))["label"].alias("sentiment_label"),
                      F.round(F.get("sentiment", F.lit(0))["score"], 9).alias("sentiment_score"))


@register("learned_lemmas", V.with_(V.REVIEWS, LM.lemmas_sql(
    TX.LEMMAS, "review_id", V.sql_ws_tokens(V.sql_clean_text_stop("review_text")), "reviews", "lemmatized_text")))
def learned_lemmas(spark, sf_dir):
    """F4 by suffix rules learned from the lemma pairs, over whole cleaned texts."""
    rv = tables.reviews(spark, sf_dir).select("review_id", "review_text")
    pairs = spark.createDataFrame(sorted(TX.LEMMAS.items()), "word string, lemma string")
    rules, exceptions = LM.learn_rules(pairs)
    out = LM.lemmatize_texts(rv, TX.clean_text_stop("review_text"), rules, exceptions, "lemmatized_text")
    return out.select("review_id", "lemmatized_text")
