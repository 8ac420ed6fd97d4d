"""suffix rules learned from word-lemma pairs."""

import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import lemmatiser as LM

PAIRS = {"tries": "try", "cries": "cry", "flies": "fly", "boxes": "box", "taxes": "tax", "foxes": "fox", "cats": "cat",
         "dogs": "dog", "days": "day", "running": "run", "sitting": "sit", "walked": "walk", "talked": "talk", "went": "go",
         "feet": "foot", "bus": "bus", "this": "this", "glass": "glass", "grass": "grass", "houses": "house"}


def brute_rules(pairs):
    votes, totals = defaultdict(Counter), Counter()
    for w, lemma in pairs.items():
        n = len(os.path.commonprefix([w, lemma]))
        cut, add = len(w) - n, lemma[n:]
        for k in range(1, min(LM.MAX_SUFFIX, len(w) - 1) + 1):
            totals[w[-k:]] += 1
            if k >= cut and len(w) - cut >= LM.MIN_STEM:
                votes[w[-k:]][cut, add] += 1
    rules = {}
    for s, v in votes.items():
        (cut, add), n = min(v.items(), key=lambda x: (-x[1], x[0]))
        if n >= LM.MIN_SUPPORT and n >= totals[s] * LM.MIN_SHARE:
            rules[s] = (cut, add, n)
    return rules


def brute_lemma(word, rules):
    for k in range(min(LM.MAX_SUFFIX, len(word) - 1), 0, -1):
        rule = rules.get(word[-k:])
        if rule and len(word) - rule[0] >= LM.MIN_STEM:
            return word[:len(word) - rule[0]] + rule[1]
    return word


def sample(seed):
    rnd = random.Random(seed)
    out = dict(PAIRS)
    for _ in range(200):
        stem = "".join(rnd.choices("abdeilnrt", k=rnd.randint(1, 6)))
        suffix, add = rnd.choice([("s", ""), ("ies", "y"), ("ing", ""), ("ed", "e"), ("est", ""), ("x", "x"), ("", "")])
        out.setdefault(stem + suffix, stem + add)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_rules_exceptions_and_lemmas_equal_brute_force(spark, seed):
    pairs = sample(seed)
    rules, exceptions = LM.learn_rules(spark.createDataFrame(list(pairs.items()) * 2, "word string, lemma string"))
    want = brute_rules(pairs)
    assert {r.suffix: (r.cut, r.add, r.support) for r in rules.collect()} == want
    assert {r.word: r.lemma for r in exceptions.collect()} == {w: x for w, x in pairs.items() if brute_lemma(w, want) != x}
    fresh = ["babies", "a", "bes", "relatedness", "s", "étés", *pairs]
    got = {r.word: r.lemma for r in LM.lemma_table(spark.createDataFrame([(w,) for w in fresh], "word string").distinct(),
                                                   rules, exceptions).collect()}
    assert got == {w: pairs.get(w, brute_lemma(w, want)) for w in fresh}


def test_learned_examples(spark):
    rules, exceptions = LM.learn_rules(spark.createDataFrame(list(PAIRS.items()), "word string, lemma string"))
    words = spark.createDataFrame([(w,) for w in ("spies", "axes", "went", "bus", "jumped", "class")], "word string")
    got = {r.word: r.lemma for r in LM.lemma_table(words, rules, exceptions).collect()}
    assert got == {"spies": "spy", "axes": "ax", "went": "go", "bus": "bus", "jumped": "jump", "class": "class"}


def test_texts_keep_rows_order_and_columns(spark):
    rules, exceptions = LM.learn_rules(spark.createDataFrame(list(PAIRS.items()), "word string, lemma string"))
    rows = [(1, "the cats went home", "x"), (1, "the cats went home", "x"), (2, None, "y"), (3, "", "z"),
            (None, "dogs " * 3000 + "cats", "w"), (4, "  foxes\tcats ", "v")]
    df = spark.createDataFrame(rows, "id int, word string, lemma string")
    out = LM.lemmatize_texts(df, F.col("word"), rules, exceptions, "out")
    assert out.columns == ["id", "word", "lemma", "out"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    want = ["the cat go home", "the cat go home", "", "", "dog " * 3000 + "cat", "fox cat"]
    assert got == sorted(((*r, w) for r, w in zip(rows, want)), key=str)
    assert LM.lemmatize_texts(df.limit(0), F.col("word"), rules, exceptions).count() == 0
    none = LM.learn_rules(spark.createDataFrame([], "word string, lemma string"))
    assert [r.lemmas for r in LM.lemmatize_texts(df.where("id = 4"), F.col("word"), *none).collect()] == ["foxes cats"]
