"""Topics and sentiment learned from data."""

import os
import random

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import learned as L
from cartwheel.operators import textops as TO
from cartwheel.sources import tables

from conftest import SF_ORACLE

THEMES = {"cream": "cream skin face soft dry moist lotion", "courier": "courier parcel late box street van driver",
          "money": "price money cheap discount sale coupon cost"}


def corpus(spark, seed, n=150):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        theme = rnd.choice(list(THEMES))
        words = rnd.choices(THEMES[theme].split(), k=rnd.randint(15, 40)) + rnd.choices(["thing", "day", "the"], k=4)
        rnd.shuffle(words)
        rows.append((i, theme, " ".join(words)))
    return spark.createDataFrame(rows, "id int, theme string, body string")


@pytest.fixture(scope="module")
def topics(spark):
    return L.fit_topics(corpus(spark, 1), "body", k=3, max_iter=40)


def test_topics_follow_the_themes_and_shares_sum_to_one(spark, topics):
    held_out = corpus(spark, 2, 60)
    shares = L.topic_shares(held_out, topics, "body").collect()
    assert all(abs(sum(r.shares) - 1) < 1e-9 and len(r.shares) == 3 for r in shares)
    by_theme = {}
    for r in L.add_learned_topics(held_out, topics, "body").collect():
        assert 1 <= len(r.topics) <= 2
        by_theme.setdefault(r.theme, []).append(r.topics[0])
    best = {t: max(set(v), key=v.count) for t, v in by_theme.items()}
    assert len(set(best.values())) == 3
    right = sum(x == best[t] for t, v in by_theme.items() for x in v)
    assert right / 60 > 0.9
    assert all(set(best[t].split()) <= set(THEMES[t].split()) for t in THEMES)


def test_topics_explain_held_out_texts_better_than_one_topic(spark, topics):
    held_out = corpus(spark, 3, 80)
    single = L.fit_topics(corpus(spark, 1), "body", k=2, max_iter=1)
    assert L.likelihood_per_word(held_out, topics, "body") > L.likelihood_per_word(held_out, single, "body") + 0.1


def test_topic_cases_and_storage(spark, topics, scratch_dir):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "unheard of"), (4, "cream skin " * 4000)], "id int, body string")
    got = {r.id: r.topics for r in L.add_learned_topics(df, topics, "body").collect()}
    assert got[1] == got[2] == got[3] == [] and len(got[4]) == 1
    path = os.path.join(scratch_dir, "topics")
    topics.save(path)
    again = L.load_topics(path)
    assert again.names == topics.names
    assert [r.topics for r in L.add_learned_topics(df, again, "body").orderBy("id").collect()] == [got[i] for i in (1, 2, 3, 4)]
    assert L.add_learned_topics(df.limit(0), topics, "body").count() == 0


@pytest.mark.parametrize("text, words", [
    ("I do not like this. Good price!", "i do not not_like not_this good price"),
    ("never a good day for it", "never not_a not_good not_day for it"),
    ("it isn't bad, really", "it isn't not_bad really"),
    ("not, good", "not good"), ("", ""), (None, ""), ("Été sans fin", "été sans fin"),
])
def test_negation_scope(spark, text, words):
    row = L.with_negated_words(spark.createDataFrame([(text,)], "t string"), "t", "w").first()
    assert row.w == words.split()


def test_negation_changes_the_learned_sentiment(spark):
    rnd = random.Random(4)
    rows = []
    for _ in range(300):
        good, neg = rnd.random() < 0.5, rnd.random() < 0.5
        filler = " ".join(rnd.choices(["box", "cream", "day", "shop"], k=4))
        word = rnd.choice(["lovely", "fine"] if good else ["awful", "nasty"])
        rows.append((f"{filler}. it is {'not ' if neg else ''}{word}. {filler}", int(good != neg)))
    df = spark.createDataFrame(rows, "body string, y int")
    model = L.fit_sentiment(df.limit(200), "body", "y")
    out = L.add_learned_sentiment(df, model, "body").collect()
    right = sum((r.sentiment[0].label == "POSITIVE") == bool(r.y) for r in out[200:])
    assert right >= 97 and all(0.5 <= r.sentiment[0].score <= 1 for r in out)


def test_learned_sentiment_beats_the_word_list_on_held_out_labels(spark, scratch_dir):
    rows = tables.reviews(spark, SF_ORACLE).select(
        "review_id", "review_text", F.col("product_rating").cast("int").alias("y")).where("y IS NOT NULL")
    held = F.pmod(F.xxhash64("review_id"), F.lit(3)) == 0
    model = L.fit_sentiment(rows.where(~held), "review_text", "y")

    def balanced(df):
        found = df.where(held).select("y", (F.col("sentiment")[0]["label"] == "POSITIVE").cast("int").alias("p")).collect()
        share = {y: [r.p == y for r in found if r.y == y] for y in (0, 1)}
        return sum(sum(v) / len(v) for v in share.values()) / 2

    learned = balanced(L.add_learned_sentiment(rows, model, "review_text"))
    listed = balanced(TO.process_reviews(rows))
    assert learned > 0.75 and learned > listed + 0.2
    path = os.path.join(scratch_dir, "sentiment")
    model.save(path)
    assert balanced(L.add_learned_sentiment(rows, L.load_sentiment(path), "review_text")) == learned


def test_sentiment_cases(spark):
    df = spark.createDataFrame([("good", 1), ("bad", 0), (None, None), ("", None), ("good " * 20_000, None)], "body string, y int")
    model = L.fit_sentiment(df, "body", "y")
    out = {(r.body or "")[:5] if r.body else r.body: r.sentiment for r in L.add_learned_sentiment(df, model, "body").collect()}
    assert out[None] == [] and out[""] == [] and out["good "][0].label == "POSITIVE"
