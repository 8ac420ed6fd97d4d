"""The session store gives the batch sessions for any order and cut of the input."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from cartwheel.streaming import events as ST
from cartwheel.streaming import sessions as SE

from conftest import SF_SMALL

GAP = 1800


def brute(rows, gap=GAP):
    """(user, second) rows to sorted (user, start, last, count)."""
    out, per_user = [], {}
    for user, at in rows:
        if at is not None:
            per_user.setdefault(user, []).append(at)
    for user, times in per_user.items():
        times.sort()
        run = [times[0]]
        for a, b in zip(times, times[1:]):
            if b - a >= gap:
                out.append((user, run[0], run[-1], len(run)))
                run = []
            run.append(b)
        out.append((user, run[0], run[-1], len(run)))
    return sorted(out, key=str)


def frame(spark, rows):
    shaped = spark.createDataFrame(rows, "user_id bigint, at bigint")
    return shaped.select("user_id", F.timestamp_seconds("at").alias("event_time"))


def plain(sessions):
    return sorted(((r.user, r.start // 10**6, r.last // 10**6, r["count"]) for r in sessions.collect()), key=str)


def sample(seed, n=400):
    rnd = random.Random(seed)
    hot = [(1, rnd.randrange(200_000)) for _ in range(n // 2)]
    rest = [(rnd.choice([2, 3, None]), rnd.randrange(400_000)) for _ in range(n // 2)]
    edges = [(9, 0), (9, GAP), (9, 2 * GAP - 1), (9, -5), (9, None), (8, 86_399), (8, 86_400 + GAP - 2)]
    return hot + rest + edges


@pytest.mark.parametrize("seed", range(2))
def test_batch_sessions_equal_the_gap_rule(spark, seed):
    rows = sample(seed)
    assert plain(SE.batch_sessions(frame(spark, rows))) == brute(rows)


@pytest.mark.parametrize("order", ["by time", "newest first", "mixed", "repeated keys"])
def test_merged_batches_equal_the_whole(spark, scratch_dir, order):
    rows = sample(7)
    if order in ("by time", "newest first"):
        rows.sort(key=lambda r: (r[1] is None, r[1] or 0), reverse=order == "newest first")
    cuts = [rows[i::4] if order == "mixed" else rows[i * len(rows) // 4:(i + 1) * len(rows) // 4] for i in range(4)]
    if order == "repeated keys":
        cuts[2] = cuts[0]
    folder = os.path.join(scratch_dir, f"sessions-{order.replace(' ', '-')}")

    def run(i):
        (SE.merged_batch(frame(spark, cuts[i]), i, folder).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(folder))

    for i in range(4):
        run(i)
    store = lambda: SE.live_sessions(spark.read.schema(SE._schema(frame(spark, []).schema["user_id"].dataType)).parquet(folder))
    want = brute([r for c in cuts for r in c])
    assert plain(store()) == want
    run(3)  # a replayed batch replaces what it wrote
    assert plain(store()) == want


def test_a_late_row_joins_two_stored_sessions(spark, scratch_dir):
    folder = os.path.join(scratch_dir, "sessions-late")
    for i, rows in enumerate([[(1, 0), (1, 3000)], [(2, 100_000)], [(1, 1500)]]):
        (SE.merged_batch(frame(spark, rows), i, folder).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(folder))
    rows = spark.read.parquet(folder)
    assert plain(SE.live_sessions(rows.withColumn("taken_from", F.col("taken_from").cast("int")))) == [
        (1, 0, 3000, 3), (2, 100_000, 100_000, 1)]
    assert rows.where("taken_from IS NOT NULL").count() == 2


@pytest.mark.parametrize("order", [None, [5, 4, 3, 2, 1, 0], [3, 0, 5, 1, 4, 2]])
def test_stream_sessions_equal_batch_sessions(spark, order, tmp_path):
    path = f"{SF_SMALL}/events*.parquet"
    table = spark.read.parquet(path)
    if order:
        rows = table.orderBy("ts").toPandas()
        for turn, i in enumerate(order):
            name = str(tmp_path / f"part-{i}.parquet")
            rows.iloc[i * len(rows) // 6:(i + 1) * len(rows) // 6].to_parquet(name, index=False, coerce_timestamps="us")
            os.utime(name, (1_700_000_000 + turn * 60,) * 2)
        path = str(tmp_path / "*.parquet")
    out = SE.stream_sessions(ST.event_stream(spark, path, 1))
    epoch = datetime.datetime(1970, 1, 1)
    want = brute([(r.user_id, (r.ts - epoch) / datetime.timedelta(microseconds=1)) for r in table.collect()], GAP * 10**6)
    got = sorted(((r.user_id, r.start, r.end, r["count"]) for r in out.select(
        "user_id", F.unix_micros("start").alias("start"), F.unix_micros("end").alias("end"), "count").collect()), key=str)
    assert [(u, s, e - GAP * 10**6, n) for u, s, e, n in got] == [(u, int(a), int(b), n) for u, a, b, n in want]
