"""Topics and sentiment learned from data.

The word lists of ``textops`` need no training data; where there is some, topics
are a topic model of the corpus itself and sentiment is fitted on labelled rows.
Both give the same columns as the word lists, so they take their place.

* Topics: online variational inference over word counts (Spark ML's LDA): each
  iteration sends the topics to the tasks and adds up their statistics in a tree.
  A document's shares of the topics sum to 1.
* Sentiment: hashed words and word pairs, with words under a negation marked, and a
  logistic curve fitted by tree aggregation.  Both classes weigh the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.text import STOP_WORDS, letter_tokens
from cartwheel.operators.sizing import materialize
from cartwheel.operators.textops import SENTIMENT_TYPE

# English words that turn the meaning of what follows.
NEGATIONS = ["not", "no", "never", "none", "nor", "cannot", "without", "hardly", "barely"]
# Words after a negation that it reaches, unless punctuation ends it.
SCOPE = 3
FEATURES = 1 << 16
N_TOPICS = 7
# Topic names: this many of the topic's most probable words.
NAME_WORDS = 3


# --- topics --------------------------------------------------------------

@dataclass(frozen=True)
class TopicModel:
    counter: CountVectorizerModel
    topics: LDAModel
    names: list[str]

    def save(self, path: str) -> None:
        """Store the model below ``path``."""
        PipelineModel([self.counter, self.topics]).write().overwrite().save(path)


def load_topics(path: str) -> TopicModel:
    counter, topics = PipelineModel.load(path).stages
    return TopicModel(counter, topics, _names(counter, topics))


def _names(counter: CountVectorizerModel, topics: LDAModel) -> list[str]:
    """One name for each topic; a bounded number of words comes to the driver."""
    rows = topics.describeTopics(NAME_WORDS).orderBy("topic").select("termIndices").collect()
    words = counter.vocabulary
    return [" ".join(words[i] for i in r["termIndices"]) for r in rows]


def _topic_words(df: DataFrame, text: str, out: str) -> DataFrame:
    words = F.coalesce(letter_tokens(text), F.array().cast("array<string>"))
    return df.withColumn(out, F.filter(words, lambda w: ~w.isin(STOP_WORDS)))


def fit_topics(df: DataFrame, text: str, k: int = N_TOPICS, max_iter: int = 20, min_docs: int = 2,
               vocabulary: int = 1 << 16, seed: int = 42) -> TopicModel:
    """Topic model of a text column.  ``vocabulary`` bounds the model to the most
    frequent words that at least ``min_docs`` texts have; stop words are left out."""
    # The filter comes after the words are stored: before, it would split each text again.
    words = materialize(_topic_words(df, text, "_words").select("_words")).where(F.size("_words") > 0)
    counter = CountVectorizer(inputCol="_words", outputCol="_counts", minDF=float(min_docs), vocabSize=vocabulary).fit(words)
    lda = LDA(k=k, maxIter=max_iter, optimizer="online", featuresCol="_counts", topicDistributionCol="_shares", seed=seed)
    topics = lda.fit(counter.transform(words))
    return TopicModel(counter, topics, _names(counter, topics))


def topic_shares(df: DataFrame, model: TopicModel, text: str, out: str = "shares") -> DataFrame:
    """Add each text's shares of the topics, in the order of ``model.names``; they sum
    to 1.  Texts without a known word have none (``[]``)."""
    counted = model.counter.transform(_topic_words(df, text, "_words"))
    shared = model.topics.transform(counted).withColumn("_list", vector_to_array("_shares"))
    known = F.aggregate("_list", F.lit(0.0), lambda s, x: s + x) > 0
    return shared.withColumn(out, F.when(known, F.col("_list")).otherwise(F.array().cast("array<double>"))).drop(
        "_words", "_counts", "_shares", "_list")


def add_learned_topics(df: DataFrame, model: TopicModel, text: str, out: str = "topics", threshold: float = 0.4) -> DataFrame:
    """Names of the topics whose share is above ``threshold``, greatest first (equal
    shares by name)."""
    names = F.array(*[F.lit(n) for n in model.names])
    shared = topic_shares(df, model, text, "_s")
    named = F.zip_with("_s", names, lambda s, n: F.struct((-s).alias("k"), n.alias("name")))
    kept = F.array_sort(F.filter(named, lambda x: (x["k"] < -threshold) & x["name"].isNotNull()))
    return shared.withColumn(out, F.transform(kept, lambda x: x["name"])).drop("_s")


def likelihood_per_word(df: DataFrame, model: TopicModel, text: str) -> float:
    """Lower bound of the texts' log-likelihood for each counted word."""
    counted = materialize(model.counter.transform(_topic_words(df, text, "_words")).select("_counts"))
    total = counted.select(F.sum(F.aggregate(vector_to_array("_counts"), F.lit(0.0), lambda s, x: s + x))).first()[0]
    return model.topics.logLikelihood(counted) / total if total else 0.0


# --- sentiment -----------------------------------------------------------

@dataclass(frozen=True)
class SentimentModel:
    hashed: PipelineModel
    curve: LogisticRegressionModel

    def save(self, path: str) -> None:
        """Store the model below ``path``."""
        PipelineModel([*self.hashed.stages, self.curve]).write().overwrite().save(path)


def load_sentiment(path: str) -> SentimentModel:
    *stages, curve = PipelineModel.load(path).stages
    return SentimentModel(PipelineModel(stages), curve)


def with_negated_words(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add the lower-cased words of a text; those that a negation reaches carry ``not_``.

    A negation reaches the next ``SCOPE`` words unless punctuation comes first.  The
    words are a column of their own, so that a word's neighbours are looked up, not
    extracted again.
    """
    pattern = F.lit(r"(\p{L}+(?:'\p{L}+)?|[.,;:!?])")
    staged = df.withColumn("_marks", F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), pattern, 1))

    def is_word(w: Column) -> Column:
        return ~w.isin(list(".,;:!?"))

    def turns(w: Column) -> Column:
        return w.isin(NEGATIONS) | w.endswith("n't")

    # 0 punctuation, 1 word, 2 negation; null where a text has no negation to reach a word.
    kinds = F.transform("_marks", lambda w: F.when(turns(w), F.lit(2)).otherwise(is_word(w).cast("int")))
    staged = staged.withColumn("_kinds", F.when(F.exists("_marks", turns), kinds))

    def reached(i: Column) -> Column:
        hit, open_ = F.lit(False), F.lit(True)
        for back in range(1, SCOPE + 1):
            before = F.get("_kinds", i - back)
            hit = hit | (open_ & (before == 2))
            open_ = open_ & (before > 0)
        return F.coalesce(hit, F.lit(False))

    marked = F.transform("_marks", lambda w, i: F.when((F.get("_kinds", i) > 0) & reached(i), F.concat(F.lit("not_"), w)).otherwise(w))
    words = F.filter(F.when(F.col("_kinds").isNull(), F.col("_marks")).otherwise(marked), is_word)
    return staged.withColumn(out, words).drop("_marks", "_kinds")


def _features(features: int) -> PipelineModel:
    return PipelineModel([NGram(n=2, inputCol="_words", outputCol="_pairs"),
                          HashingTF(numFeatures=features, binary=True, inputCol="_grams", outputCol="_x")])


def _hashed(df: DataFrame, stages: PipelineModel, text: str) -> DataFrame:
    pairs, hashing = stages.stages
    with_pairs = pairs.transform(with_negated_words(df, text, "_words"))
    return hashing.transform(with_pairs.withColumn("_grams", F.concat("_words", "_pairs"))).drop("_words", "_pairs", "_grams")


def fit_sentiment(df: DataFrame, text: str, positive: str, features: int = FEATURES, reg: float = 0.05,
                  max_iter: int = 50) -> SentimentModel:
    """Fit on the rows whose 0/1 column ``positive`` is not null."""
    stages = _features(features)
    rows = df.where(F.col(positive).isNotNull()).withColumn("_y", F.col(positive).cast("double"))
    rows = materialize(_hashed(rows, stages, text).select("_x", "_y"))
    counts = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = F.when(F.col("_y") > 0.5, F.lit(1.0 / max(1, counts.get(1.0, 0)))).otherwise(F.lit(1.0 / max(1, counts.get(0.0, 0))))
    curve = LogisticRegression(featuresCol="_x", labelCol="_y", weightCol="_weight", regParam=reg, maxIter=max_iter,
                               standardization=False, predictionCol="_p", rawPredictionCol="_raw", probabilityCol="_prob")
    total = sum(counts.values())
    return SentimentModel(stages, curve.fit(rows.withColumn("_weight", weight * F.lit(total / 2.0))))


def add_learned_sentiment(df: DataFrame, model: SentimentModel, text: str, out: str = "sentiment") -> DataFrame:
    """``[{label, score}]`` as the word list gives it; ``[]`` for null and empty texts."""
    scored = model.curve.transform(_hashed(df, model.hashed, text)).withColumn("_share", vector_to_array("_prob")[1])
    label = F.when(F.col("_share") >= 0.5, F.lit("POSITIVE")).otherwise(F.lit("NEGATIVE"))
    score = F.greatest(F.col("_share"), 1 - F.col("_share"))
    given = F.array(F.struct(label.alias("label"), score.alias("score")))
    blank = F.col(text).isNull() | (F.length(text) == 0)
    return scored.withColumn(out, F.when(blank, F.array().cast(SENTIMENT_TYPE)).otherwise(given)).drop(
        "_x", "_raw", "_prob", "_p", "_share")
