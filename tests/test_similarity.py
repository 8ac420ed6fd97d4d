"""Cosine top-k against a brute-force NumPy computation (card C1)."""

import numpy as np
import pytest

from cartwheel.operators import similarity as sim


def _fixture(spark):
    rows = [(1, "a", 1.0), (1, "b", 2.0), (1, "a", 1.0),  # duplicate (1, a) is summed
            (2, "a", 1.0), (2, "c", 1.0), (3, "b", 1.0), (3, "c", 3.0), (3, "d", 1.0),
            (4, "e", 1.0), (None, "a", 5.0), (5, None, 1.0)]
    return spark.createDataFrame(rows, "basket int, item string, qty double")


def _brute(rows, k):
    rows = [r for r in rows if r[0] is not None and r[1] is not None]
    baskets = sorted({r[0] for r in rows})
    items = sorted({r[1] for r in rows})
    m = np.zeros((len(baskets), len(items)))
    for b, i, q in rows:
        m[baskets.index(b), items.index(i)] += q
    norms = np.linalg.norm(m, axis=0)
    together = (m != 0).T.astype(int) @ (m != 0)
    sim_m = (m.T @ m) / np.outer(norms, norms)
    out = {}
    for a, ia in enumerate(items):
        cands = [(round(sim_m[a, b], 9) + 0.0, ib) for b, ib in enumerate(items) if b != a and together[a, b]]
        cands.sort(key=lambda x: (-x[0], x[1]))
        out[ia] = cands[:k]
    return out


def test_cosine_topk_matches_brute_force(spark):
    df = _fixture(spark)
    expected = _brute([tuple(r) for r in df.collect()], 2)
    got = {}
    for r in sim.cosine_topk(df, k=2).orderBy("item", "rank").collect():
        got.setdefault(r.item, []).append((r.score, r.rec_item))
    assert got == {k: v for k, v in expected.items() if v}


def test_cosine_properties(spark):
    recs = sim.cosine_topk(_fixture(spark), k=10).collect()
    pairs = {(r.item, r.rec_item): r.score for r in recs}
    for (a, b), s in pairs.items():
        assert 0 < s <= 1 + 1e-12 and a != b
        assert abs(pairs[(b, a)] - s) < 1e-9  # symmetric (all partners kept at k=10)
    per_item = {}
    for r in recs:
        per_item.setdefault(r.item, []).append(r.rank)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in per_item.values())


def test_wide_view_and_sparsity(spark):
    df = _fixture(spark)
    wide = sim.cosine_wide(sim.cosine_topk(df, k=3), k=3)
    assert wide.columns == ["item", "Rec_1", "Rec_2", "Rec_3", "Score_1", "Score_2", "Score_3"]
    sp = sim.basket_sparsity(df).first()
    assert (sp.n_baskets, sp.n_items, sp.nnz) == (4, 5, 8)
    assert sp.sparsity == round(100 * (1 - 8 / 20), 2)


def test_topk_plans_partial_group_limit(spark):
    recs = sim.cosine_topk(_fixture(spark), k=2)
    plan = recs._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan


def test_cosine_with_hot_basket_matches_brute_force(spark):
    # One basket holds about a third of all rows; results must stay exact.
    rows = [(0, f"i{j}", 1.0 + (j % 3)) for j in range(60)]
    rows += [(b, f"i{(b * 7 + t) % 60}", 1.0) for b in range(1, 41) for t in range(3)]
    df = spark.createDataFrame(rows, "basket int, item string, qty double").repartition(5)
    expected = _brute(rows, 5)
    got = {}
    for r in sim.cosine_topk(df, k=5).orderBy("item", "rank").collect():
        got.setdefault(r.item, []).append((r.score, r.rec_item))
    assert got == {k: v for k, v in expected.items() if v}


def _got(df, k, **kw):
    got = {}
    for r in sim.cosine_topk(df, k=k, **kw).orderBy("item", "rank").collect():
        got.setdefault(r.item, []).append((r.score + 0.0, r.rec_item))
    return got


@pytest.mark.parametrize("block_items", [1, 3, 8, 1000])
def test_large_baskets_in_any_number_of_blocks(spark, block_items):
    rows = [(0, f"i{j}", 1.0 + (j % 4)) for j in range(40)]
    rows += [(1, f"i{j}", 2.0) for j in range(5, 35, 2)]
    rows += [(b, f"i{(b * 7 + t) % 50}", 1.0) for b in range(2, 60) for t in range(3)]
    rows += [(60, "x1", 1.0), (60, "x2", 1.0)]
    rows += [(70, f"n{j}", -1.0 if j % 2 else 1.0) for j in range(12)]           # negative scores
    df = spark.createDataFrame(rows, "basket int, item string, qty double").repartition(4)
    assert _got(df, 4, block_items=block_items) == {i: v for i, v in _brute(rows, 4).items() if v}


@pytest.mark.parametrize("block_items", [2, 1000])
def test_scores_that_round_to_zero_are_kept(spark, block_items):
    # Eight items share one basket with tiny weights and have a large one each.
    rows = [(0, f"z{j}", 1e-6) for j in range(8)] + [(j + 1, f"z{j}", 1e3) for j in range(8)]
    df = spark.createDataFrame(rows, "basket int, item string, qty double")
    got = _got(df, 5, block_items=block_items)
    assert got == {i: v for i, v in _brute(rows, 5).items() if v}
    assert sum(map(len, got.values())) == 40 and {s for v in got.values() for s, _ in v} == {0.0}
