"""Cost of the learned topics and lemmas: each text is split once, and cheaply; tokens are shuffled once."""

import random
import re

import pytest
from pyspark.sql import functions as F

from cartwheel.functions import text as TX
from cartwheel.operators import learned as L
from cartwheel.operators import lemmatiser as LM

PAIRS = [("cats", "cat"), ("dogs", "dog"), ("hats", "hat"), ("is", "be"), ("men", "man")]


def test_white_space_is_not_a_class_of_ranges(spark):
    spaces = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
    texts = [f"A{c}b-1{c}{c} cé {c}" for c in spaces] + [spaces, "", None, "a​b퟿c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", TX.ws_tokens("t").alias("w"), TX.letter_tokens("t").alias("l"))
    assert r"\x{2000}" not in df._jdf.queryExecution().optimizedPlan().toString()
    for r in df.collect():
        want = None if r.t is None else r.t.split()
        assert r.w == want
        letters = None if r.t is None else ["".join(c for c in w.lower() if "a" <= c <= "z") for w in want]
        assert r.l == (None if letters is None else [w for w in letters if w])


def test_topics_split_each_text_once(spark, monkeypatch):
    plans = []
    real = L.materialize
    monkeypatch.setattr(L, "materialize", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df))
    df = spark.createDataFrame([("cream skin",), ("cream face",), ("the",), ("",), (None,)], "t string").cache()
    model = L.fit_topics(df, "t", k=2, max_iter=1, min_docs=1)
    assert set(model.counter.vocabulary) == {"cream", "skin", "face"}
    assert plans[0].count("split(") == 1


@pytest.mark.parametrize("limit", [LM.BROADCAST_WORDS, 0])
def test_lemmas_are_merged_by_place(spark, monkeypatch, limit):
    monkeypatch.setattr(LM, "BROADCAST_WORDS", limit)
    rules, exceptions = LM.learn_rules(spark.createDataFrame(PAIRS, "word string, lemma string"))
    rows = [(1, "cats x is x cats men"), (1, "cats x is x cats men"), (2, "x y"), (3, ""), (None, None),
            (4, "men " * 3000 + "y")]
    df = spark.createDataFrame(rows, "id int, t string")
    out = LM.lemmatize_texts(df, F.col("t"), rules, exceptions, "l")
    got = sorted(((r.id or 0, r.t, r.l) for r in out.collect()), key=lambda r: r[0])
    assert [(i, x) for i, _, x in got] == [(0, ""), (1, "cat x be x cat man"), (1, "cat x be x cat man"), (2, "x y"),
                                           (3, ""), (4, "man " * 3000 + "y")]
    assert [t for _, t, _ in got] == [None, rows[0][1], rows[0][1], "x y", "", rows[5][1]]
    if limit:
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(word" not in plan


def _negated(text):
    """The rule word by word: a negation reaches three words unless punctuation ends it."""
    marks = re.findall(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.,;:!?]", text.lower())
    out = []
    for i, w in enumerate(marks):
        if w in ".,;:!?":
            continue
        before = marks[max(0, i - L.SCOPE):i]
        open_ = next((n for n, b in enumerate(reversed(before)) if b in ".,;:!?"), len(before))
        near = before[len(before) - open_:]
        out.append("not_" * any(b in L.NEGATIONS or b.endswith("n't") for b in near) + w)
    return out


def test_negations_are_classified_once_a_word(spark):
    rnd = random.Random(5)
    texts = [" ".join(rnd.choices(["not", "isn't", "a", "b", "no", ",", ".", "été", "won't.", "n't", "x!no"], k=rnd.randint(0, 12)))
             for _ in range(300)] + ["a b, c.", "not", ", not , a", "no no no no a b c d", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).cache()
    out = L.with_negated_words(df, "t", "w")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("InMemoryRelation")[0].count("EndsWith(") <= 2
    assert plan.count("regexp_extract_all") == 1
    assert [(r.t, r.w) for r in out.collect()] == [(t, _negated(t)) for t in texts]
