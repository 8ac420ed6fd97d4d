"""Step 12 queries: streaming twins of the event aggregates."""

from pyspark.sql import functions as F

from cartwheel.plans.registry import register
from cartwheel.streaming import events as ST
from cartwheel.streaming import sessions as SE

_TS = "strftime({e}, '%Y-%m-%d %H:%M:%S.%f')"


def _path(sf_dir):
    # A glob keeps the stream source on the events file(s) only.
    return f"{sf_dir.rstrip('/')}/events*.parquet"


@register("stream_daily_counts", """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day,
       CASE WHEN event_type = 'click' THEN 'cart' ELSE event_type END AS event_type, COUNT(*) AS count
FROM events WHERE ts IS NOT NULL GROUP BY 1, 2""")
def stream_daily_counts(spark, sf_dir):
    ev = ST.event_stream(spark, _path(sf_dir))
    return ST.stream_daily_counts(ev).select(F.col("day").cast("string").alias("day"), "event_type", "count")


@register("stream_sessions", f"""
WITH ev AS (SELECT user_id, ts FROM events WHERE ts IS NOT NULL),
g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 30 MINUTE
                               THEN 1 ELSE 0 END AS new_session
      FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, SUM(new_session) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, {_TS.format(e='MIN(ts)')} AS session_start,
       {_TS.format(e="MAX(ts) + INTERVAL 30 MINUTE")} AS session_end, COUNT(*) AS count
FROM s GROUP BY user_id, sid""")
def stream_sessions(spark, sf_dir):
    """Every session of the stream, the open ones of the last day and late rows included."""
    res = SE.stream_sessions(ST.event_stream(spark, _path(sf_dir)))
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return res.select("user_id", F.date_format(ST.utc_wall_clock(F.col("start"), spark), fmt).alias("session_start"),
                      F.date_format(ST.utc_wall_clock(F.col("end"), spark), fmt).alias("session_end"), "count")


@register("stream_dedup", """
SELECT DISTINCT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, user_id, CASE WHEN event_type = 'click' THEN 'cart' ELSE event_type END AS event_type,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS product_id
FROM events WHERE ts IS NOT NULL""")
def stream_dedup(spark, sf_dir):
    ev = ST.event_stream(spark, _path(sf_dir))
    res = ST.stream_dedup(ev, ["user_id", "event_type", "product_id"])
    return res.select(F.col("day").cast("string").alias("day"), "user_id", "event_type", "product_id")
