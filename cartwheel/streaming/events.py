"""The batch event aggregates re-expressed on ``readStream``.

Event time must be a ``timestamp`` (watermarks reject ``timestamp_ntz``), so
the source casts it.  Results go to parquet folders under the shared
checkpoint folder; each query has its own checkpoint location, so a restarted
driver or lost executor resumes from the last committed micro-batch.

Daily counts (T1), sessions (T2, in ``sessions.py``) and de-duplication (T3) keep
no watermark and lose no late row.  ``session_counts`` is Spark's own session
window for consumers that want closed sessions only, once each: it has a
watermark, and rows that arrive more than its delay behind the newest event are
left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.session import scratch_path
from cartwheel.sources.tables import session_key


def event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet event files as a stream in the interaction shape (``event_time`` as timestamp).

    ``path`` is a folder or a glob of files; new files are picked up as they land.
    """
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    ev = reader.parquet(path)
    return ev.select(
        "event_id", utc_instant(F.col("ts"), spark).alias("event_time"), "user_id",
        F.when(F.col("event_type") == "click", F.lit("cart")).otherwise(F.col("event_type")).alias("event_type"),
        F.get_json_object("props", "$.k").try_cast("int").alias("product_id"),
        F.col("value").alias("price"), session_key(F.col("user_id"), F.col("ts")).alias("user_session"))


def utc_instant(ntz, spark: SparkSession):
    """``timestamp_ntz`` wall clock read as UTC, whatever the session time zone
    (a plain cast would read it in the session zone and shift the day windows)."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ntz).cast("timestamp")


def utc_wall_clock(ts, spark: SparkSession):
    """A ``timestamp`` instant as its UTC wall clock (``timestamp_ntz``)."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), ts.cast("timestamp_ntz"))


def daily_type_counts(events: DataFrame, spark: SparkSession, time: str = "event_time") -> DataFrame:
    """T1, one batch: events per type and UTC calendar day."""
    day = F.to_date(utc_wall_clock(F.col(time), spark))
    return events.where(F.col(time).isNotNull()).groupBy(day.alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("count"))


def stream_daily_counts(events: DataFrame, time: str = "event_time") -> DataFrame:
    """Counts per type and day of all available input.

    Every micro-batch stores its partial counts in a folder of its own, which a
    replayed batch overwrites; readers add them up.  There is no state and no
    watermark, so a late row counts like any other: the result depends neither
    on the order of the files nor on how they are cut into batches.
    """
    spark = events.sparkSession
    out = _batches(events, "daily-counts",
                   lambda batch, batch_id, _: daily_type_counts(batch, spark, time).withColumn("batch", F.lit(batch_id)))
    return spark.read.parquet(out).groupBy("day", "event_type").agg(F.sum("count").alias("count"))


def stream_dedup(events: DataFrame, subset: list, time: str = "event_time") -> DataFrame:
    """The distinct ``(day, *subset)`` of all available input, each written once.

    The result table itself, partitioned by event day, is the memory: a batch
    adds the keys that earlier batches have not written, and reads only the days
    that occur in it.  Late rows are treated like any other.
    """
    spark = events.sparkSession
    keys = ["day", *subset]

    def fresh(batch: DataFrame, batch_id: int, out: str) -> DataFrame:
        rows = batch.where(F.col(time).isNotNull()).select(
            F.to_date(utc_wall_clock(F.col(time), spark)).alias("day"), *subset).distinct()
        if batch_id > 0:
            # A replayed batch must not see what it wrote itself.
            known = spark.read.schema(_with_batch(rows)).parquet(out).where(F.col("batch") < batch_id)
            # The days of the batch are a small key set: they prune the table's partitions.
            known = known.join(rows.select("day").distinct(), "day", "left_semi")
            same = [F.col(f"r.{c}").eqNullSafe(F.col(f"k.{c}")) for c in keys]
            rows = rows.alias("r").join(known.alias("k"), same, "left_anti")
        return rows.withColumn("batch", F.lit(batch_id))

    out = _batches(events, "dedup", fresh, ["day"])
    return spark.read.parquet(out).select(*keys)


def _with_batch(rows: DataFrame) -> T.StructType:
    return T.StructType([*rows.schema.fields, T.StructField("batch", T.IntegerType())])


def _batches(events: DataFrame, name: str, build, partition_by: list | None = None) -> str:
    """Run ``build(batch, batch id, folder)`` on every micro-batch and write its rows
    below the returned folder, partitioned by batch; a replayed batch replaces
    only its own rows."""
    spark = events.sparkSession
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")

    def write(batch: DataFrame, batch_id: int) -> None:
        (build(batch, batch_id, out).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch", *(partition_by or [])).parquet(out))

    query = (events.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
             .foreachBatch(write).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return out


def session_counts(events: DataFrame, user: str = "user_id", time: str = "event_time",
                   gap: str = "30 minutes", delay: str = "1 day") -> DataFrame:
    """Closed sessions only: events per session window with a ``gap``, in append mode."""
    return (events.withWatermark(time, delay)
                  .groupBy(F.session_window(time, gap).alias("s"), user)
                  .agg(F.count(F.lit(1)).alias("count")))


def run_available(query_df: DataFrame, name: str) -> DataFrame:
    """Run an append-mode streaming query over all available input and return its
    result table (the parquet file sink is exactly-once through the checkpoint)."""
    spark = query_df.sparkSession
    out = scratch_path(spark, f"{name}-out")
    q = (query_df.writeStream.option("checkpointLocation", scratch_path(spark, f"{name}-ckpt"))
         .trigger(availableNow=True).outputMode("append").format("parquet").option("path", out).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out)
