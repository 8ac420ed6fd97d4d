"""Driver contract: every registered query vs its DuckDB oracle (sf0.001 here;
the driver runs sf0.01), and the smoke entry."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle import canon, duck

NAMES = sorted(E.queries())
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["item", "rank", "rec_item", "score"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(NAMES)
    assert len(NAMES) >= 70


FORBIDDEN_PLAN_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in FORBIDDEN_PLAN_NODES), f"{name} plans a cross join"
    left = df.toPandas()
    if name not in ORACLES:
        assert len(left.columns) > 0
        return
    right = con.execute(ORACLES[name]).fetchdf()
    lc, lr = canon(left)
    rc, rr = canon(right)
    assert lc == rc
    assert len(lr) == len(rr)
    assert lr == rr


def test_filters_and_columns_reach_the_scan(spark):
    df = E.queries()["positive_price"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(value,20.0)" in plan
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan


def test_cosine_plans_partial_topk_and_partial_sums(spark):
    df = E.queries()["cosine_topk"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "partial_sum" in plan


# Columns that must take more than one value on the fixture, and whether NULLs must
# occur: otherwise the operator behind them would not be exercised.
SIGNAL = {
    "topic_tags": ("topics", False), "sentiment": ("sentiment_label", False), "topic_engagement": ("count", False),
    "typed_reviews": ("review_price", True), "fallback_title": ("title", False), "review_dates": ("review_day", True),
    "model_hook": ("embedded", False), "frequent_itemsets": ("size", False), "rules_lift": ("lift", False),
    "processed_titles": ("stemmed_text", False), "null_fraction": ("value", False), "cosine_topk": ("score", False),
    "schema_check": ("status", False), "hash_embedding": ("value", False), "review_embeddings": ("value", False),
    "clean_title": ("title_clean", False), "positive_price": ("price", False), "baseline_eval": (None, False),
}


@pytest.mark.parametrize("name", sorted(SIGNAL))
def test_oracle_results_carry_signal(con, name):
    rows = con.execute(ORACLES[name]).fetchdf()
    assert len(rows) > 0
    column, nulls = SIGNAL[name]
    if column:
        assert rows[column].nunique() > 1
        assert rows[column].isna().any() == nulls or not nulls


def test_filters_cut_rows_and_titles_are_filled(con):
    events = con.execute("SELECT COUNT(*) FROM events").fetchone()[0]
    assert 0 < len(con.execute(ORACLES["positive_price"]).fetchdf()) < events
    missing = con.execute("SELECT COUNT(*) FROM (" + ORACLES["processed_titles"] + ") WHERE stemmed_title = 'tit' OR lemmatized_title LIKE '%title%'").fetchone()[0]
    assert missing > 0


def test_no_oracle_is_empty(con):
    empty = [n for n, sql in ORACLES.items() if not con.execute(f"SELECT COUNT(*) FROM ({sql})").fetchone()[0]]
    assert empty == []
