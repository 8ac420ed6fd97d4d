"""Exact top-k by inner product with norm bounds."""

import numpy as np
import pytest

from cartwheel.operators import topk

SCHEMA = "{} bigint, bias double, vec array<double>"


def tables(spark, n_left, n_right, dim, seed, spread=1.0, whole=False):
    rng = np.random.default_rng(seed)

    def rows(n, start):
        scale = np.exp(rng.normal(size=n) * spread)
        vec = rng.normal(size=(n, dim)) * scale[:, None]
        bias = rng.normal(size=n)
        if whole:  # many ties, exact in floating point
            vec, bias = np.round(vec), np.round(bias)
        return [(start + i, float(b), v.tolist()) for i, (b, v) in enumerate(zip(bias, vec))]

    left, right = rows(n_left, 0), rows(n_right, 1000)
    return left, right, spark.createDataFrame(left, SCHEMA.format("u")), spark.createDataFrame(right, SCHEMA.format("i"))


def brute(left, right, k):
    out = {}
    for u, ub, uv in left:
        scored = sorted((-(ub + ib + float(np.dot(uv, iv))), i) for i, ib, iv in right)
        out[u] = [(i, -s) for s, i in scored[:k]]
    return out


def check(got, want):
    found = {}
    for r in got.orderBy("u", "rank").collect():
        found.setdefault(r.u, []).append((r.i, r.score))
        assert r.rank == len(found[r.u])
    assert found.keys() == want.keys()
    for u, pairs in want.items():
        assert [i for i, _ in found[u]] == [i for i, _ in pairs]
        assert np.allclose([s for _, s in found[u]], [s for _, s in pairs], rtol=1e-9)


@pytest.mark.parametrize("block_rows", [2, 5, 16, 64, 8192])
@pytest.mark.parametrize("n_left, n_right", [(90, 70), (3, 150), (150, 3)])
def test_equal_brute_force_for_any_block_size(spark, block_rows, n_left, n_right):
    left, right, lf, rf = tables(spark, n_left, n_right, 3, block_rows + n_left)
    check(topk.score_top_k(lf, rf, 4, block_rows), brute(left, right, 4))


@pytest.mark.parametrize("block_rows", [4, 9])
def test_ties_go_to_the_smaller_key_across_blocks(spark, block_rows):
    left, right, lf, rf = tables(spark, 40, 60, 2, 3, whole=True)
    assert len({tuple(v) for _, _, v in right}) < 50
    check(topk.score_top_k(lf, rf, 5, block_rows), brute(left, right, 5))


def test_fewer_right_rows_than_k_zero_vectors_and_empty_sides(spark):
    lf = spark.createDataFrame([(1, 0.5, [0.0, 0.0]), (2, -1.0, [1.0, 0.0])], SCHEMA.format("u"))
    rf = spark.createDataFrame([(7, 0.0, [0.0, 0.0]), (8, 0.0, [0.0, 0.0]), (9, 2.0, [-3.0, 0.0])], SCHEMA.format("i"))
    got = {(r.u, r.rank): (r.i, r.score) for r in topk.score_top_k(lf, rf, 10, 2).collect()}
    assert got == {(1, 1): (9, 2.5), (1, 2): (7, 0.5), (1, 3): (8, 0.5), (2, 1): (7, -1.0), (2, 2): (8, -1.0), (2, 3): (9, -2.0)}
    assert topk.score_top_k(lf.limit(0), rf, 3).count() == 0 and topk.score_top_k(lf, rf.limit(0), 3).count() == 0


def test_bounds_skip_blocks(spark):
    left, right, lf, rf = tables(spark, 60, 400, 4, 11, spread=1.5)
    report = topk.pruning_report(lf, rf, 3, 20).first()
    assert report.row_blocks == 60 * 20 and 60 <= report.needed < 600 and report.skipped_share > 0.5
    check(topk.score_top_k(lf, rf, 3, 20), brute(left, right, 3))


def test_tiles_inside_a_block_are_skipped():
    rng = np.random.default_rng(0)
    rows = topk._Rows(rng.normal(size=(5, 3)), np.zeros(5), 2)
    vec = rng.normal(size=(3000, 3))
    vec[:1024] *= 100
    norm = np.sqrt((vec * vec).sum(axis=1))
    order = np.argsort(-norm)
    rows.see(np.arange(3000).astype(object)[order], np.arange(3000)[order], np.zeros(3000), vec[order], norm[order])
    want = np.argsort(-(rows.vectors @ vec.T), axis=1)[:, :2]
    assert rows.key.reshape(5, 2).tolist() == want.tolist()
