"""Lemmas by suffix rules learned from word-lemma pairs.

A pair says which suffix is cut off and what is added (``tries`` -> ``try``: cut 3,
add ``y``).  For every suffix of a word, up to ``MAX_SUFFIX`` letters, the most
frequent change among the pairs with that suffix becomes a rule, if enough pairs
agree.  A word takes the rule of its longest suffix that has one; pairs that the
rules get wrong are exceptions, looked up by the word itself.

Pairs, rules and exceptions are tables of any size and meet the words in equi-joins.
A lemma is found once for each distinct word of the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.text import safe_text, ws_tokens
from cartwheel.operators.sizing import materialize

MAX_SUFFIX = 6
MIN_SUPPORT = 2
MIN_SHARE = 0.6
# Letters that a rule must leave of a word.
MIN_STEM = 2
# Changed words that every task may hold; a larger table meets the words in a shuffle.
BROADCAST_WORDS = 200_000


def _suffixes(df: DataFrame, shortest: Column, max_suffix: int) -> DataFrame:
    """``df`` with ``length`` and ``suffix`` for each proper suffix of ``word``."""
    longest = F.least(F.lit(max_suffix), F.length("word") - 1)
    lengths = F.when(longest >= shortest, F.sequence(shortest, longest)).otherwise(F.array().cast("array<int>"))
    return df.withColumn("length", F.explode(lengths)).withColumn("suffix", F.expr("right(word, length)"))


def learn_rules(pairs: DataFrame, max_suffix: int = MAX_SUFFIX, min_support: int = MIN_SUPPORT,
                min_share: float = MIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """From ``pairs`` (``word``, ``lemma``; repeated pairs count once, of several lemmas
    of a word the least is taken) to ``rules`` (``suffix``, ``cut``, ``add``, ``support``)
    and ``exceptions`` (``word``, ``lemma``)."""
    known = materialize(pairs.where("word <> '' AND lemma IS NOT NULL").groupBy("word").agg(F.min("lemma").alias("lemma")))
    shared = F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.length("word"), F.length("lemma")))),
                             lambda i: F.substring("word", 1, i) == F.substring("lemma", 1, i)))
    changes = known.select("word", "lemma", shared.alias("n")).select(
        "word", (F.length("word") - F.col("n")).alias("cut"), F.expr("substring(lemma, n + 1)").alias("add"))
    every = _suffixes(changes, F.lit(1), max_suffix)
    total = every.groupBy("suffix").agg(F.count(F.lit(1)).alias("total"))
    fitting = every.where((F.col("length") >= F.col("cut")) & (F.length("word") - F.col("cut") >= MIN_STEM))
    votes = fitting.groupBy("suffix", "cut", "add").agg(F.count(F.lit(1)).alias("support"))
    order = Window.partitionBy("suffix").orderBy(F.desc("support"), "cut", "add")
    best = votes.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k").join(total, "suffix")
    rules = materialize(best.where((F.col("support") >= min_support) & (F.col("support") >= F.col("total") * min_share)).drop("total"))
    given = by_rules(known.select("word"), rules, max_suffix)
    exceptions = known.join(given.withColumnRenamed("lemma", "given"), "word").where("lemma <> given").select("word", "lemma")
    return rules, materialize(exceptions)


def by_rules(words: DataFrame, rules: DataFrame, max_suffix: int = MAX_SUFFIX) -> DataFrame:
    """``word`` and ``lemma`` of distinct ``words`` by the longest suffix that has a rule;
    words without one are their own lemma."""
    met = _suffixes(words.select("word"), F.lit(1), max_suffix).join(rules, "suffix").where(
        F.length("word") - F.col("cut") >= MIN_STEM)
    longest = met.groupBy("word").agg(F.max_by(F.struct("cut", "add"), "length").alias("rule"))
    return words.select("word").join(longest, "word", "left").select("word", F.coalesce(
        F.expr("concat(left(word, length(word) - rule.cut), rule.add)"), F.col("word")).alias("lemma"))


def lemma_table(words: DataFrame, rules: DataFrame, exceptions: DataFrame) -> DataFrame:
    """``word`` and ``lemma`` of distinct ``words``: exceptions first, then rules."""
    ruled = by_rules(words, rules)
    own = exceptions.select("word", F.col("lemma").alias("own"))
    return ruled.join(own, "word", "left").select("word", F.coalesce("own", "lemma").alias("lemma"))


def lemmatize_texts(df: DataFrame, text: Column, rules: DataFrame, exceptions: DataFrame, out: str = "lemmas") -> DataFrame:
    """Add the text of lemmas, joined by one space (null and empty texts: ``''``).  All
    columns of ``df`` are kept, repeated rows as well.

    Only the words that have another lemma are looked up in the texts; what is found is
    merged into the text's own words by place."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    rows = materialize(df.select(F.struct(*columns).alias("row"), F.monotonically_increasing_id().alias("id"),
                                 ws_tokens(safe_text(text)).alias("tokens")))
    table = lemma_table(rows.select(F.explode("tokens").alias("word")).distinct(), rules, exceptions)
    changed = materialize(table.where("lemma <> word"))
    if changed.count() <= BROADCAST_WORDS:
        changed = F.broadcast(changed)
    met = rows.select("id", F.posexplode("tokens").alias("at", "word")).join(changed, "word")
    found = met.groupBy("id").agg(F.collect_list(F.struct("at", F.lit(0).alias("own"), F.col("lemma").alias("word"))).alias("found"))
    # By place, a lemma before the word it stands for; both lists are sorted, so this is a merge.
    own = F.transform("tokens", lambda w, i: F.struct(i.alias("at"), F.lit(1).alias("own"), w.alias("word")))
    merged = rows.join(found, "id", "left").withColumn(
        "merged", F.when(F.col("found").isNotNull(), F.sort_array(F.concat(own, F.sort_array("found")))))
    first = F.filter("merged", lambda x, i: (x["own"] == 0) | (i == 0) | (F.get("merged", i - 1)["at"] < x["at"]))
    words = F.when(F.col("merged").isNull(), F.col("tokens")).otherwise(F.transform(first, lambda x: x["word"]))
    return merged.select("row.*", F.array_join(words, " ").alias(out))


def lemmas_sql(pairs: dict, key: str, tokens: str, source: str, out: str) -> str:
    """DuckDB SQL (after ``WITH``) for ``lemmatize_texts`` over ``source``, with the list
    expression ``tokens``."""
    values = ", ".join(f"('{w}', '{x}')" for w, x in sorted(pairs.items()))
    return f"""pairs(word, lemma) AS (VALUES {values}),
changes AS (SELECT word, lemma, length(word) - n AS cut, lemma[n + 1:] AS "add" FROM (
  SELECT word, lemma, len(list_filter(range(1, least(length(word), length(lemma)) + 1), lambda i: word[:i] = lemma[:i])) AS n FROM pairs)),
every AS (SELECT *, right(word, k) AS suffix FROM (SELECT *, unnest(range(1, least({MAX_SUFFIX}, length(word) - 1) + 1)) AS k FROM changes)),
totals AS (SELECT suffix, count(*) AS total FROM every GROUP BY suffix),
votes AS (SELECT suffix, cut, "add", count(*) AS support FROM every WHERE k >= cut AND length(word) - cut >= {MIN_STEM} GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY suffix ORDER BY support DESC, cut, "add") AS place FROM votes),
rules AS MATERIALIZED (SELECT suffix, cut, "add" FROM best JOIN totals USING (suffix)
  WHERE place = 1 AND support >= {MIN_SUPPORT} AND support >= total * {MIN_SHARE}),
toks AS MATERIALIZED (SELECT {key}, unnest(t) AS word, unnest(range(len(t))) AS place FROM (SELECT {key}, {tokens} AS t FROM {source})),
words AS (SELECT word FROM toks UNION SELECT word FROM pairs),
tails AS (SELECT word, k, right(word, k) AS suffix FROM (SELECT word, unnest(range(1, least({MAX_SUFFIX}, length(word) - 1) + 1)) AS k FROM words)),
ruled AS (SELECT word, arg_max(word[:length(word) - cut] || "add", k) AS lemma FROM tails JOIN rules USING (suffix)
  WHERE length(word) - cut >= {MIN_STEM} GROUP BY word),
table_ AS (SELECT word, coalesce(pairs.lemma, ruled.lemma, word) AS lemma FROM words LEFT JOIN ruled USING (word) LEFT JOIN pairs USING (word)),
texts AS (SELECT {key}, string_agg(lemma, ' ' ORDER BY place) AS lemmas FROM toks JOIN table_ USING (word) GROUP BY {key})
SELECT {key}, coalesce(lemmas, '') AS {out} FROM {source} LEFT JOIN texts USING ({key})"""
