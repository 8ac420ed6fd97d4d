"""Round 4: what large tables need, on rows made here."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.operators import evaluate as EV
from cartwheel.operators import similarity as sim
from cartwheel.plans import catalog_text


def test_sentiment_scores_texts_before_they_meet_labels(spark, tmp_path):
    d = str(tmp_path)
    docs = [(1, "the la der"), (2, "of and the"), (3, ""), (4, None), (5, "xyz"), (None, "the"), (1, "of of the")]
    spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in docs],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 1), (None, 1, 1), (9, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(
        f"{d}/labels.parquet")
    out = catalog_text.sentiment(spark, d)
    want = [(1, "POSITIVE", 1.0), (1, "NEGATIVE", 0.666666667), (2, "NEGATIVE", 0.666666667), (2, "NEGATIVE", 0.666666667),
            (3, None, None), (4, None, None), (5, "POSITIVE", 0.5), (None, "POSITIVE", 1.0)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    join = re.search(r"(?s)\+?-? ?Join LeftOuter.*", plan).group(0)
    assert "translate" in join and "translate" not in plan[:plan.index(join)]


def _triples(spark, shift=0):
    rows = [(b, (b * 7 + t * t) % 23 + shift, 1.0 + (b * t) % 5) for b in range(60) for t in range(6)]
    return spark.createDataFrame(rows, "basket long, item long, qty double").repartition(3)


@pytest.mark.parametrize("item_baskets", [1, 3, 100_000])
def test_cosine_sums_are_dealt_out_by_item(spark, monkeypatch, item_baskets):
    df = _triples(spark)
    monkeypatch.setattr(sim, "ITEM_BASKETS", item_baskets)
    got = sim.cosine_topk(df, k=4)
    # One direction of every pair already lies with its item: ranks cut it before the shuffle.
    assert re.search(r"RepartitionByExpression \[item#\d+L?, part#\d+\]", got._jdf.queryExecution().optimizedPlan().toString())
    q = collections.Counter()
    for r in df.collect():
        q[r.basket, r.item] += r.qty
    m = np.zeros((60, 23))
    for (b, i), v in q.items():
        m[b, i] = v
    m /= np.linalg.norm(m, axis=0)
    c = m.T @ m
    want = {}
    for i in range(23):
        met = [j for j in range(23) if j != i and (m[:, i] * m[:, j]).any()]
        want[i] = sorted((-round(float(c[i, j]), 9), j) for j in met)[:4]
    rows = sorted((r.item, r["rank"], -r.score, r.rec_item) for r in got.collect())
    assert [(i, [(s, j) for x, _, s, j in rows if x == i]) for i in range(23)] == [(i, want[i]) for i in range(23)]


def test_scores_survive_as_whole_numbers(spark):
    values = [0.0, 1.0, -1.0, 0.123456789, 1e-9, -1e-9, 0.999999999, 0.707106781, 1.000000001, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "s double")
    for digits in (9, 12):
        out = df.select("s", sim.score_code("s", digits).alias("c")).select("s", "c", sim.coded_score("c", digits).alias("t"))
        assert all(r.s == r.t or (math.isnan(r.s) and math.isnan(r.t)) for r in out.collect())
        assert out.orderBy(F.desc("c")).first().s != out.orderBy(F.desc("s")).first().t  # NaN comes first in both


@pytest.mark.parametrize("shift", [0, (1 << 31) - 10, 1 << 40, -(1 << 31) - 12])
def test_basket_lists_travel_in_few_bytes(spark, shift):
    df = _triples(spark, shift)
    recs = sim.cosine_topk(df, k=5, digits=9)
    recs = recs.unionByName(spark.createDataFrame([(shift, 6, 7, float("nan")), (shift + 1, 6, None, 0.5)], recs.schema))
    want, got = (sorted(map(str, EV.basket_recs_from_item_recs(recs, df, 4, digits=d).select(
        "basket", "item", "score", "rank").collect())) for d in (None, 9))
    assert want == got and len(got) == 240
    plan = EV.basket_recs_from_item_recs(recs, df, 4, digits=9)._jdf.queryExecution().analyzed().toString()
    assert "as array<int>" in plan
