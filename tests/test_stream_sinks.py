"""Batch = stream for T1–T3, and sink round trips."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import explore as X
from cartwheel.sources import sinks, tables
from cartwheel.streaming import events as ST

from conftest import SF_SMALL

EV_GLOB = f"{SF_SMALL}/events*.parquet"


@pytest.fixture(scope="module", params=["one file", "newest first", "oldest first", "mixed"])
def event_files(request, spark, tmp_path_factory):
    """The events in one file, or in six files by time that arrive in some order."""
    if request.param == "one file":
        return EV_GLOB
    folder = tmp_path_factory.mktemp("events")
    rows = spark.read.parquet(EV_GLOB).orderBy("ts").toPandas()
    parts = [rows.iloc[i * len(rows) // 6:(i + 1) * len(rows) // 6] for i in range(6)]
    order = {"newest first": [5, 4, 3, 2, 1, 0], "oldest first": [0, 1, 2, 3, 4, 5], "mixed": [3, 0, 5, 1, 4, 2]}
    for turn, i in enumerate(order[request.param]):
        path = os.path.join(str(folder), f"part-{i}.parquet")
        parts[i].to_parquet(path, index=False, coerce_timestamps="us")
        os.utime(path, (1_700_000_000 + turn * 60,) * 2)
    return str(folder) + "/*.parquet"


def test_stream_daily_counts_equal_batch(spark, event_files):
    res = ST.stream_daily_counts(ST.event_stream(spark, event_files, 1))
    got = {(str(r.day), r.event_type): r["count"] for r in res.collect()}
    ev = tables.interactions(spark, SF_SMALL, with_attributes=False)
    exp = {(str(r.d), r.event_type): r["count"] for r in
           X.counts_by(ev.withColumn("d", F.to_date("event_time")), "d", "event_type").collect()}
    assert got == exp


def test_stream_sessions_equal_batch_gap_rule(spark):
    res = ST.run_available(ST.session_counts(ST.event_stream(spark, EV_GLOB)), "t2")
    got = sorted((r.user_id, r["count"]) for r in res.collect())
    ev = tables.table(spark, SF_SMALL, "events").select("user_id", "ts").collect()
    watermark = max(r.ts for r in ev) - datetime.timedelta(days=1)
    per_user = {}
    for r in ev:
        per_user.setdefault(r.user_id, []).append(r.ts)
    exp = []
    for u, ts in per_user.items():
        ts.sort()
        count = 1
        for a, b in zip(ts, ts[1:]):
            if (b - a).total_seconds() >= 1800:
                if a + datetime.timedelta(minutes=30) <= watermark:
                    exp.append((u, count))
                count = 1
            else:
                count += 1
        if ts[-1] + datetime.timedelta(minutes=30) <= watermark:
            exp.append((u, count))
    assert got == sorted(exp)


def test_stream_dedup_equal_batch(spark, event_files):
    subset = ["user_id", "event_type", "product_id"]
    res = ST.stream_dedup(ST.event_stream(spark, event_files, 1), subset)
    got = sorted(map(tuple, res.select(F.col("day").cast("string"), *subset).collect()), key=str)
    ev = tables.interactions(spark, SF_SMALL, with_attributes=False)
    want = ev.select(F.to_date("event_time").cast("string"), *subset).distinct().collect()
    assert got == sorted(map(tuple, want), key=str)


def test_staged_overwrite_of_self_read_table(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    sinks.save_table(df, "t_self")
    again = sinks.read_table(spark, "t_self").withColumn("w", F.upper("v"))
    sinks.save_table(again, "t_self")  # schema change + reads itself
    assert sinks.read_table(spark, "t_self").columns == ["id", "v", "w"]
    fresh = sinks.read_table(spark, "t_self")  # the old files are gone after the swap
    sinks.append_table(fresh, "t_self")
    assert spark.table("t_self").count() == 4


def test_a_swap_cut_off_between_its_renames_is_finished(spark):
    old, new = (spark.createDataFrame([(i,)], "id int") for i in (1, 2))
    sinks.save_table(old, "t_cut")
    new.write.saveAsTable("t_cut__staged")
    spark.sql("ALTER TABLE t_cut RENAME TO t_cut__old")  # here the driver is lost
    sinks.append_table(spark.createDataFrame([(3,)], "id int"), "t_cut")
    assert sorted(r.id for r in sinks.read_table(spark, "t_cut").collect()) == [2, 3]
    assert not spark.catalog.tableExists("t_cut__old") and not spark.catalog.tableExists("t_cut__staged")
    new.write.saveAsTable("t_cut__staged")  # lost before the first rename: the table is still the old one
    sinks.save_table(old, "t_cut")
    assert [r.id for r in sinks.read_table(spark, "t_cut").collect()] == [1]


def test_versioned_tables_by_name(spark):
    name = "t_versions"
    first = sinks.save_versioned(spark.createDataFrame([(1,)], "id int"), name)
    sinks.save_versioned(spark.createDataFrame([(2,)], "id int"), name, "append")
    sinks.save_versioned(sinks.read_versioned(spark, name).withColumn("twice", F.col("id") * 2), name)
    assert sorted(map(tuple, sinks.read_versioned(spark, name).collect())) == [(1, 2), (2, 4)]
    assert [tuple(r) for r in sinks.read_versioned(spark, name, first).collect()] == [(1,)]


def test_csv_arrays_and_paths(spark, scratch_dir):
    df = spark.createDataFrame([([3, 1], 5, {"a": 1})], "items array<int>, freq long, m map<string,int>")
    path = os.path.join(scratch_dir, "fi_csv")
    sinks.write_csv(df, path)
    back = spark.read.option("header", True).csv(path).first()
    assert back["items"] == "[3 1]" and back["m"] == '{"a":1}'
    p2 = os.path.join(scratch_dir, "pq")
    sinks.save_path(df, p2)
    assert sinks.load_path(spark, p2).count() == 1


def test_run_metrics_and_model_roundtrip(spark, scratch_dir):
    sinks.log_metrics(spark, "run1", {"sparsity": 99.5, "n_rules": 3}, table="run_metrics_t")
    assert spark.table("run_metrics_t").count() == 2
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer
    df = spark.createDataFrame([("a",), ("b",)], "x string")
    model = Pipeline(stages=[StringIndexer(inputCol="x", outputCol="y")]).fit(df)
    path = os.path.join(scratch_dir, "model")
    sinks.save_model(model, path)
    assert sinks.load_pipeline(path).transform(df).count() == 2
    assert sinks.preview(df, 1).count() == 1


def test_stream_day_windows_ignore_session_time_zone(spark):
    import __spark_entry__ as E
    q = E.queries()["stream_daily_counts"]
    base = {(r.day, r.event_type): r["count"] for r in q(spark, SF_SMALL).collect()}
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        shifted = {(r.day, r.event_type): r["count"] for r in q(spark, SF_SMALL).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert shifted == base


def test_ship_package_is_idempotent_and_importable_on_workers(spark):
    from cartwheel import session as S
    S.ship_package(spark)
    S.ship_package(spark)
    assert spark.sparkContext.applicationId in S._SHIPPED

    def probe(batches):
        import pandas as pd
        import cartwheel.operators.topk as tk  # imported on the Python worker
        for b in batches:
            yield pd.DataFrame({"ok": [hasattr(tk, "score_top_k")] * len(b)})

    out = spark.range(4).mapInPandas(probe, "ok boolean").collect()
    assert all(r.ok for r in out)
