"""Topic tagging, sentiment and topic engagement (M10, M11, M17; card C5).

No model weights are available offline, so the built-in scorer is a lexicon:
each document's tokens are looked up in a fixed term → label table, label
shares are normalised to sum 1 and labels with share above the threshold are
kept (the reference's zero-shot call is single-label softmax, so at most two
labels pass 0.4).  Scoring is a per-row higher-order expression — no explode,
no shuffle — so it scales linearly with the text.  A real model can be
plugged in through :func:`model_column` (Arrow-batched ``pandas_udf``, model
loaded once per Python worker).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cartwheel.functions.arrays import explode_nonempty
from cartwheel.functions.text import letter_tokens

# The reference's topic labels, in its order.
TOPIC_LABELS = ["product quality", "packaging", "price", "customer service", "delivery",
                "ingredients", "effectiveness"]

# Our topic lexicon (term → label).
TOPIC_TERMS = {
    "product quality": ["quality", "durable", "sturdy", "flimsy", "broken", "defective", "texture",
                        "smell", "consistency", "lasting"],
    "packaging": ["packaging", "package", "box", "bottle", "seal", "sealed", "wrapped", "container",
                  "jar", "tube"],
    "price": ["price", "expensive", "cheap", "affordable", "cost", "value", "overpriced", "money",
              "worth", "discount"],
    "customer service": ["service", "support", "refund", "customer", "staff", "helpful", "response",
                         "replacement", "complaint", "agent"],
    "delivery": ["delivery", "shipping", "shipped", "arrived", "late", "courier", "delivered",
                 "delay", "tracking", "dispatch"],
    "ingredients": ["ingredients", "ingredient", "natural", "chemical", "formula", "paraben",
                    "fragrance", "oil", "vitamin", "organic"],
    "effectiveness": ["effective", "works", "worked", "results", "difference", "improved", "useless",
                      "effect", "noticeable", "helps"],
}

# Our sentiment lexicon.
POSITIVE_TERMS = ["good", "great", "love", "excellent", "amazing", "perfect", "happy", "best", "nice",
                  "recommend", "wonderful", "awesome", "fantastic", "pleased", "satisfied"]
NEGATIVE_TERMS = ["bad", "poor", "terrible", "awful", "hate", "worst", "disappointed", "waste",
                  "horrible", "broken", "useless", "refund", "return", "cheap", "annoying"]

SENTIMENT_TYPE = T.ArrayType(T.StructType([T.StructField("label", T.StringType()),
                                           T.StructField("score", T.DoubleType())]))


def _term_map(terms: dict) -> tuple[Column, list]:
    pairs = sorted((t, label) for label, ts in terms.items() for t in ts)
    keys = [t for t, _ in pairs]
    return F.map_from_arrays(F.array(*[F.lit(t) for t, _ in pairs]),
                             F.array(*[F.lit(lbl) for _, lbl in pairs])), keys


def _empty(type_str: str) -> Column:
    return F.array().cast(type_str)


def add_topics(df: DataFrame, tokens: str, out: str = "topics", threshold: float = 0.4,
               terms: dict | None = None, labels: list | None = None) -> DataFrame:
    """M10 on a token column, in staged projections: the lexicon hits are computed
    once per row (Catalyst keeps the stage because the hits are referenced by
    every label; higher-order functions are not common-subexpression
    eliminated)."""
    terms = terms or TOPIC_TERMS
    labels = labels or TOPIC_LABELS
    m, keys = _term_map(terms)
    tmp = df.withColumn("_hits", F.transform(F.filter(tokens, lambda t: t.isin(keys)),
                                             lambda t: F.element_at(m, t)))
    tmp = tmp.withColumn("_n", F.size("_hits"))
    shares = F.transform(
        F.array(*[F.lit(lbl) for lbl in labels]),
        lambda lbl: F.struct((-(F.size(F.filter("_hits", lambda h: h == lbl)) / F.col("_n"))).alias("k"),
                             lbl.alias("label")))
    tmp = tmp.withColumn("_s", F.when(F.col("_n") > 0, shares).otherwise(
        _empty("array<struct<k:double,label:string>>")))
    kept = F.array_sort(F.filter("_s", lambda s: -s["k"] > threshold))
    return tmp.withColumn(out, F.transform(kept, lambda s: s["label"])).drop("_hits", "_n", "_s")


def add_sentiment(df: DataFrame, tokens: str, text: str, out: str = "sentiment",
                  positive: list | None = None, negative: list | None = None) -> DataFrame:
    """M11 on a token column (staged: positive/negative hit counts once per row)."""
    pos_terms = positive or POSITIVE_TERMS
    neg_terms = negative or NEGATIVE_TERMS
    tmp = (df.withColumn("_pos", F.size(F.filter(tokens, lambda t: t.isin(pos_terms))).cast("double"))
             .withColumn("_neg", F.size(F.filter(tokens, lambda t: t.isin(neg_terms))).cast("double")))
    pos, neg = F.col("_pos"), F.col("_neg")
    label = F.when(pos >= neg, F.lit("POSITIVE")).otherwise(F.lit("NEGATIVE"))
    score = F.when(pos + neg == 0, F.lit(0.5)).otherwise(F.greatest(pos, neg) / (pos + neg))
    t = F.col(text)
    return tmp.withColumn(out, F.when(t.isNull() | (F.length(t) == 0), _empty(SENTIMENT_TYPE.simpleString()))
                          .otherwise(F.array(F.struct(label.alias("label"), score.alias("score"))))
                          ).drop("_pos", "_neg")


def process_reviews(df: DataFrame, text: str = "review_text", terms: dict | None = None,
                    positive: list | None = None, negative: list | None = None,
                    threshold: float = 0.4) -> DataFrame:
    """M10 + M11 on a review frame: adds ``topics`` and ``sentiment``; the text is
    tokenised once for both."""
    tmp = df.withColumn("_tok", F.coalesce(letter_tokens(text), _empty("array<string>")))
    tagged = add_topics(tmp, "_tok", threshold=threshold, terms=terms)
    return add_sentiment(tagged, "_tok", text, positive=positive, negative=negative).drop("_tok")


def analyze_topics(df: DataFrame, topics: str = "topics", event_type: str = "event_type") -> DataFrame:
    """``(topic, event_type, count)`` ordered by count desc (ties by keys)."""
    return (df.select(explode_nonempty(topics).alias("topic"), event_type)
              .groupBy("topic", event_type).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), "topic", event_type))


# Models that this Python worker process has built, by their factory's code.
_MODELS: dict[str, Callable] = {}


def _loaded(key: str, model_factory: Callable) -> Callable:
    """The model of this worker process.  (A module-level function: the hook's own
    closure is pickled by value and would carry a copy of the table.)"""
    if key not in _MODELS:
        _MODELS[key] = model_factory()
    return _MODELS[key]


def model_column(model_factory: Callable, return_type, col: str, on_error: str = "raise") -> Column:
    """Score ``col`` with a user model in Arrow batches.

    ``model_factory() -> callable(pd.Series) -> pd.Series`` is called once in
    each Python worker process; empty/NULL text must map to an empty result.
    The model's output is checked against ``return_type`` (a Spark type or its
    DDL).  ``on_error="empty"`` gives rows that the model fails on an empty array
    (NULL for other types) instead of failing the job.
    """
    if on_error not in ("raise", "empty"):
        raise ValueError("on_error is 'raise' or 'empty'")
    declared = T._parse_datatype_string(return_type) if isinstance(return_type, str) else return_type
    arrow = to_arrow_type(declared)
    key = hashlib.sha256(cloudpickle.dumps(model_factory)).hexdigest()
    blank: list | None = [] if isinstance(declared, T.ArrayType) else None

    def checked(model: Callable, values: pd.Series) -> pd.Series:
        out = pd.Series(model(values))
        if len(out) != len(values):
            raise ValueError(f"the model gave {len(out)} results for {len(values)} rows")
        try:
            pa.array(out, type=arrow, from_pandas=True)
        except (pa.ArrowInvalid, pa.ArrowTypeError) as exc:
            raise TypeError(f"the model's output is not {declared.simpleString()}: {exc}") from exc
        return out

    def halved(model: Callable, values: pd.Series) -> list:
        """Results of a batch that may hold rows the model fails on: halves are scored
        whole where they can be, down to the rows that fail."""
        try:
            return checked(model, values).tolist()
        except TypeError:
            raise
        except Exception:  # noqa: BLE001 - whatever a user's model raises
            if len(values) == 1:
                return [blank]
        half = len(values) // 2
        return halved(model, values.iloc[:half]) + halved(model, values.iloc[half:])

    @F.pandas_udf(declared)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            model = _loaded(key, model_factory)
            if on_error == "raise":
                yield checked(model, values)
                continue
            yield pd.Series(halved(model, values), dtype=object)

    return apply(F.col(col))
