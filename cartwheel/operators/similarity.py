"""M6 — item-to-item cosine similarity and top-k recommendations (card C1).

The reference densifies a session×product matrix on the driver and calls a
P×P cosine routine.  Here the matrix stays a long ``(basket, item, q)``
DataFrame:

1. duplicates are summed per ``(basket, item)`` (map-side partial aggregate);
2. every item column is scaled to unit L2 norm (norms are a ``groupBy``; the
   join back is broadcast by AQE only when the runtime size allows it);
3. the dot products are sums over the pairs of a basket's list, first in the same
   stage over a group of baskets, so only partial sums of distinct unordered
   pairs are shuffled, each pair once; a large basket is cut into blocks of items, joined on
   (basket, block, block), whose pairs are keys of bounded size;
4. the top-k per item is ``row_number() <= k``, which Spark plans as a partial
   ``WindowGroupLimit`` before the exchange: a hot item never sends more than
   ``k`` rows per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def basket_matrix(triples: DataFrame, basket: str = "basket", item: str = "item",
                  qty: str = "qty") -> DataFrame:
    """Sparse basket×item matrix ``(basket, item, q)``: NULL keys dropped, duplicates summed."""
    return (triples
            .where(F.col(basket).isNotNull() & F.col(item).isNotNull())
            .groupBy(F.col(basket).alias("basket"), F.col(item).alias("item"))
            .agg(F.sum(F.col(qty).cast("double")).alias("q")))


def basket_sparsity(triples: DataFrame, basket: str = "basket", item: str = "item",
                    qty: str = "qty") -> DataFrame:
    """``100·(1 − nnz/(S·P))`` rounded to 2 dp, with S, P and nnz."""
    a = basket_matrix(triples, basket, item, qty)
    return (a.agg(F.count_distinct("basket").alias("n_baskets"),
                  F.count_distinct("item").alias("n_items"),
                  F.count(F.when(F.col("q") != 0, True)).alias("nnz"))
             .withColumn("sparsity", F.round(
                 F.lit(100.0) * (F.lit(1.0) - F.col("nnz") / (F.col("n_baskets") * F.col("n_items"))), 2)))


def top_k_per_group(df: DataFrame, group: str, order_cols: list, k: int,
                    rank_col: str = "rank") -> DataFrame:
    """First ``k`` rows per group with an explicit 1-based rank.

    ``row_number() <= k`` is planned as a partial WindowGroupLimit before the
    shuffle, so a hot group sends at most k rows per map task.
    """
    w = Window.partitionBy(group).orderBy(*order_cols)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) <= k)
              .withColumn(rank_col, F.col(rank_col).cast("int")))


# Items of a block: a basket with more distinct items is cut into blocks, and
# every pair of its blocks is joined under a key of its own.
BLOCK_ITEMS = 1000
# Baskets of an item whose pairs are summed in one task.
ITEM_BASKETS = 100_000


def cosine_topk(triples: DataFrame, k: int = 10, basket: str = "basket", item: str = "item",
                qty: str = "qty", digits: int = 9, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Top-k most similar items per item, long form ``(item, rank, rec_item, score)``.

    Scores are rounded to ``digits`` before ranking; ties go to the smaller id.
    Every two items that share a basket have a score, also a zero or negative
    one.  Items without any co-occurring partner get no rows (the reference
    padded them with zero scores).  ``block_items`` has no effect on results.
    """
    from cartwheel.operators.sizing import materialize
    # The de-duplicated matrix feeds the sizes, the norms and both join sides:
    # it is materialised once instead of re-scanning and re-aggregating.
    a = materialize(basket_matrix(triples, basket, item, qty).where(F.col("q") != 0))
    # Both directions are shuffled with the score as a whole number of its last digit,
    # half as long as a double and just as exact.
    pairs = _pair_scores(a, digits, block_items).select("item", "rec_item", score_code("score", digits).alias("code"))
    scores = pairs.select(F.explode(F.array(
        F.struct("item", "rec_item", "code"),
        F.struct(F.col("rec_item").alias("item"), F.col("item").alias("rec_item"), "code"))).alias("p")).select("p.*")
    ranked = top_k_per_group(scores, "item", [F.desc("code"), F.asc("rec_item")], k)
    return ranked.select("item", "rank", "rec_item", coded_score("code", digits).alias("score"))


def _code_type(digits: int) -> tuple[str, int]:
    return ("int", (1 << 31) - 1) if digits <= 9 else ("bigint", (1 << 63) - 1)


def score_code(score: str, digits: int) -> Column:
    """A cosine rounded to ``digits`` (15 at most) as a whole number; NaN, the largest
    double, as the largest number."""
    kind, largest = _code_type(digits)
    return F.when(F.isnan(score), F.lit(largest).cast(kind)).otherwise(F.round(F.col(score) * F.lit(10.0 ** digits)).cast(kind))


def coded_score(code: str, digits: int) -> Column:
    """The score of a code: the quotient of two exact numbers is the double nearest to it."""
    _, largest = _code_type(digits)
    return F.when(F.col(code) == largest, F.lit(float("nan"))).otherwise(F.col(code).cast("double") / F.lit(10.0 ** digits))


def _pair_scores(a: DataFrame, digits: int, block_items: int) -> DataFrame:
    """Dot products of unit item columns (``item`` < ``rec_item``: each pair is summed and
    shuffled once).

    A basket of up to ``block_items`` items is one list, whose pairs are made where it
    lies.  A larger one is cut by a hash of the item: each row meets every block of its own basket once, so
    one basket with a third of all rows is many keys of bounded size.  Products
    are summed in the join stage before the shuffle.  Without such a basket, the sums are
    dealt out by ``item``, an item of many baskets in several parts, so that the ranks'
    partial limit leaves few rows of this direction.
    """
    from cartwheel.operators.sizing import materialize
    norms = a.groupBy("item").agg(F.sqrt(F.sum(F.col("q") * F.col("q"))).alias("norm"),
                                  F.ceil(F.count(F.lit(1)) / F.lit(ITEM_BASKETS)).cast("int").alias("parts"))
    unit = a.join(norms, "item").select("basket", "item", "parts", (F.col("q") / F.col("norm")).alias("w"))
    large = materialize(a.groupBy("basket").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_items)).cast("bigint").alias("blocks"))
                        .where(F.col("blocks") > 1))
    if large.limit(1).count() > 0:
        pairs = _within_baskets(unit.join(large, "basket", "left_anti")).select("item", "rec_item", "p").unionByName(
            _between_blocks(unit.join(large, "basket")))
        return pairs.groupBy("item", "rec_item").agg(F.round(F.sum("p"), digits).alias("score"))
    part = F.pmod(F.xxhash64("rec_item"), F.col("parts")).cast("int")
    sums = _within_baskets(unit).groupBy("bucket", "item", "rec_item", part.alias("part")).agg(F.sum("p").alias("p"))
    return (sums.select("item", "part", "rec_item", "p").repartition("item", "part").groupBy("item", "part", "rec_item")
            .agg(F.round(F.sum("p"), digits).alias("score")).drop("part"))


def _within_baskets(unit: DataFrame) -> DataFrame:
    """Products of the pairs of baskets of one block: the rows are shuffled once, by groups
    of baskets (``bucket``)."""
    buckets = 64 * int(unit.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = unit.withColumn("bucket", F.pmod(F.xxhash64("basket"), F.lit(buckets)).cast("int")).repartition("bucket")
    lists = dealt.groupBy("bucket", "basket").agg(F.collect_list(F.struct("item", "w", "parts")).alias("l"))
    pairs = lists.select("bucket", F.explode("l").alias("x"), "l").select("bucket", "x", F.explode("l").alias("y"))
    return pairs.where(F.col("x.item") < F.col("y.item")).select(
        "bucket", F.col("x.item").alias("item"), F.col("x.parts").alias("parts"), F.col("y.item").alias("rec_item"),
        (F.col("x.w") * F.col("y.w")).alias("p"))


def _between_blocks(cut: DataFrame) -> DataFrame:
    """Products of the pairs of larger baskets, by an equi-join on (basket, block, block)."""
    cut = cut.withColumn("own", F.pmod(F.xxhash64("item"), F.col("blocks")))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    left = cut.select("basket", "item", "w", F.col("own").alias("b1"), every.alias("b2"))
    right = cut.select("basket", F.col("item").alias("rec_item"), F.col("w").alias("rw"),
                       F.col("own").alias("b2"), every.alias("b1"))
    return left.join(right, ["basket", "b1", "b2"]).where(F.col("item") < F.col("rec_item")).select(
        "item", "rec_item", (F.col("w") * F.col("rw")).alias("p"))


def cosine_wide(recs: DataFrame, k: int = 10) -> DataFrame:
    """Wide view ``item, Rec_1..Rec_k, Score_1..Score_k``; missing slots are NULL.

    Conditional aggregation on the item column, which is already the
    partitioning of the top-k output, so no extra shuffle is planned.
    """
    rec_cols = [F.max(F.when(F.col("rank") == r, F.col("rec_item"))).alias(f"Rec_{r}")
                for r in range(1, k + 1)]
    score_cols = [F.max(F.when(F.col("rank") == r, F.col("score"))).alias(f"Score_{r}")
                  for r in range(1, k + 1)]
    return recs.groupBy("item").agg(*rec_cols, *score_cols)
