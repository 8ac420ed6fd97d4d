"""Activity sessions of a stream, complete at any time.

A session is a user's events with less than ``gap`` between neighbours.  Events
are first added up in slots of the gap's width: events in one slot always belong
together, so a user has at most one piece for each slot of time, however many
events, and the pieces are partial aggregates.  Pieces and sessions are both
intervals with a count; merging is the union of intervals that touch.

The store is a Parquet folder partitioned by micro-batch.  A batch writes the
sessions of its own rows, united with the stored sessions that they touch, and a
mark for each stored session that went into one of them.  The live sessions are
those without a mark.  There is no watermark: open sessions are in the result, a
late row extends or joins the sessions it touches, and the result depends neither
on the order of the files nor on how they are cut into batches.  A batch reads
only batches before its own and replaces only its own rows, so it can be replayed.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.session import checkpoint_dir
from cartwheel.streaming.events import _batches

GAP = timedelta(minutes=30)
_DAY = 86_400_000_000


def _micros(gap: timedelta) -> int:
    return gap // timedelta(microseconds=1)


def session_pieces(events: DataFrame, user: str = "user_id", time: str = "event_time", gap: timedelta = GAP) -> DataFrame:
    """``user``, ``start`` and ``last`` (microseconds) and ``count`` of each slot that has
    events; rows without a time are left out."""
    at = F.unix_micros(F.col(time))
    rows = events.where(F.col(time).isNotNull()).select(F.col(user).alias("user"), at.alias("at"))
    return rows.groupBy("user", F.floor(F.col("at") / F.lit(_micros(gap))).alias("slot")).agg(
        F.min("at").alias("start"), F.max("at").alias("last"), F.count(F.lit(1)).alias("count")).drop("slot")


def merge_touching(pieces: DataFrame, gap: timedelta = GAP) -> DataFrame:
    """Unite the pieces of a user that are less than ``gap`` apart (or overlap)."""
    order = Window.partitionBy("user").orderBy("start", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    first = F.when(F.col("start") < reach + F.lit(_micros(gap)), 0).otherwise(1)
    numbered = pieces.withColumn("_first", first).withColumn("_session", F.sum("_first").over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy("user", "_session").agg(
        F.min("start").alias("start"), F.max("last").alias("last"), F.sum("count").alias("count")).drop("_session")


def batch_sessions(events: DataFrame, user: str = "user_id", time: str = "event_time", gap: timedelta = GAP) -> DataFrame:
    """Sessions of a table: ``user``, ``start``, ``last`` (microseconds), ``count``."""
    return merge_touching(session_pieces(events, user, time, gap), gap)


def _days(gap: timedelta) -> Column:
    """The days that a session and the gap after it reach into."""
    day = lambda at: F.floor(at / F.lit(_DAY))
    return F.explode(F.sequence(day(F.col("start")), day(F.col("last") + F.lit(_micros(gap) - 1))))


def touched(stored: DataFrame, fresh: DataFrame, gap: timedelta = GAP) -> DataFrame:
    """The rows of ``stored`` that are less than ``gap`` from a session of ``fresh``.

    Both sides meet by user and day, so a user's sessions are not compared with
    one another all over.
    """
    near = fresh.select(F.col("user").alias("n_user"), F.col("start").alias("n_start"), F.col("last").alias("n_last"),
                        _days(gap).alias("n_day"))
    width = F.lit(_micros(gap))
    return stored.withColumn("_day", _days(gap)).join(
        near, F.col("user").eqNullSafe(F.col("n_user")) & (F.col("_day") == F.col("n_day"))
        & (F.col("start") < F.col("n_last") + width) & (F.col("n_start") < F.col("last") + width), "left_semi").drop(
        "_day").dropDuplicates(["user", "start", "batch"])


def live_sessions(rows: DataFrame) -> DataFrame:
    """Sessions of the store that no later batch has taken up."""
    gone = rows.where("taken_from IS NOT NULL").select(
        F.col("user").alias("g_user"), F.col("start").alias("g_start"), F.col("taken_from").alias("g_batch"))
    return rows.where("taken_from IS NULL").drop("taken_from").join(
        gone, F.col("user").eqNullSafe(F.col("g_user")) & (F.col("start") == F.col("g_start"))
        & (F.col("batch") == F.col("g_batch")), "left_anti")


def _schema(user: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("user", user), T.StructField("start", T.LongType()), T.StructField("last", T.LongType()),
                         T.StructField("count", T.LongType()), T.StructField("taken_from", T.IntegerType()),
                         T.StructField("batch", T.IntegerType())])


def merged_batch(events: DataFrame, batch_id: int, folder: str, user: str = "user_id", time: str = "event_time",
                 gap: timedelta = GAP) -> DataFrame:
    """What batch ``batch_id`` adds to the store: its sessions, united with the stored
    ones they touch (``taken_from`` null), and a mark for each of those."""
    spark = events.sparkSession
    checkpoint_dir(spark)
    fresh = batch_sessions(events, user, time, gap).checkpoint()
    here = F.lit(batch_id)
    plain = F.lit(None).cast("int")
    bounds = fresh.agg(F.min("start"), F.max("last")).first()
    if batch_id == 0 or bounds[0] is None:
        return fresh.select("*", plain.alias("taken_from"), here.alias("batch"))
    rows = spark.read.schema(_schema(events.schema[user].dataType)).parquet(folder).where(F.col("batch") < batch_id)
    width = _micros(gap)
    # Parquet's statistics leave out row groups of other times.
    around = rows.where((F.col("last") > bounds[0] - width) & (F.col("start") < bounds[1] + width))
    old = touched(live_sessions(around), fresh, gap).checkpoint()
    union = merge_touching(fresh.unionByName(old.drop("batch")), gap)
    marks = old.select("user", "start", "last", "count", F.col("batch").alias("taken_from"), here.alias("batch"))
    return union.select("*", plain.alias("taken_from"), here.alias("batch")).unionByName(marks)


def stream_sessions(events: DataFrame, user: str = "user_id", time: str = "event_time", gap: timedelta = GAP) -> DataFrame:
    """All sessions of all available input, open ones included: ``user``, ``start``
    and ``end`` (timestamps; the end is the last event plus the gap), ``count``."""
    spark = events.sparkSession
    folder = _batches(events, "sessions", lambda batch, batch_id, out: merged_batch(batch, batch_id, out, user, time, gap))
    found = live_sessions(spark.read.schema(_schema(events.schema[user].dataType)).parquet(folder))
    return found.select(F.col("user").alias(user), F.timestamp_micros("start").alias("start"),
                        F.timestamp_micros(F.col("last") + F.lit(_micros(gap))).alias("end"), "count")
