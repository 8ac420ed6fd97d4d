"""Global, partition-parallel ranking.

``row_number()`` over a window with no or few partition keys moves a whole
group into one task.  Here rows are range-partitioned on ``(group, order)``,
numbered inside each partition, and shifted by the row counts of earlier
partitions of the same group.  The per-partition count table has at most
``#partitions + #groups`` rows, so every step is bounded per task.
The range-partitioned rows are checkpointed (reliable checkpoint in
``spark.checkpoint.dir``) so both passes see the same partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.session import checkpoint_dir


def global_row_number(df: DataFrame, order_cols: list, group_cols: list | None = None,
                      out: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based ``out`` column: the row's position in ``order_cols`` order within
    its ``group_cols`` group.  ``order_cols`` must make rows unique for a
    deterministic numbering."""
    group_cols = list(group_cols or [])
    keys = [F.col(c) if isinstance(c, str) else c for c in group_cols + list(order_cols)]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    # Range bounds are sampled with a seed that changes per evaluation, and the
    # two passes below (counts, numbering) may be planned with different
    # column pruning, so the partitioned rows are materialised once in the
    # shared checkpoint folder (this also cuts the lineage).
    checkpoint_dir(df.sparkSession)
    ranged = ranged.checkpoint(eager=True)
    stats = ranged.groupBy("_pid", *group_cols).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    # Window over the tiny stats table: rows of one group across partitions.
    w = Window.partitionBy(*group_cols).orderBy("_pid") if group_cols else Window.orderBy("_pid")
    offsets = stats.withColumn(
        "_off", F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    offsets = offsets.select("_pid", *group_cols, "_off", "_first")
    if not group_cols:
        # One row per partition: a size bounded by the partition count.
        offsets = F.broadcast(offsets)
    joined = ranged.join(offsets, ["_pid", *group_cols])
    return (joined.withColumn(out, F.col("_off") + (F.col("_mid") - F.col("_first")) + 1)
                  .drop("_pid", "_mid", "_off", "_first"))


def dense_codes(df: DataFrame, id_col: str, out: str | None = None) -> DataFrame:
    """Distinct ids numbered ``0..n-1`` in sorted id order (LabelEncoder)."""
    out = out or f"{id_col}_code"
    ids = df.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    return (global_row_number(ids, [F.col(id_col)], out="_rn")
            .select(id_col, (F.col("_rn") - 1).alias(out)))
