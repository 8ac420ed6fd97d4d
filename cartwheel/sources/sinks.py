"""Table, file and model sinks (S3–S14) and their readers.

The reference wrote Delta tables; without a Delta jar the default format is
parquet.  Overwriting a table that the same plan reads is rejected by Spark
for non-Delta sources, so :func:`save_table` stages the result under a new
name and swaps it in; :func:`save_versioned` keeps snapshots and commits in one
step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.sources import snapshots
from cartwheel.sources.schemas import RUN_METRICS


def _serialise_arrays(df: DataFrame) -> DataFrame:
    """CSV has no arrays/structs: arrays of atoms become ``[a b c]``, other
    nested values JSON text."""
    cols = []
    for f in df.schema.fields:
        dt = f.dataType
        if isinstance(dt, T.ArrayType) and not isinstance(dt.elementType, (T.ArrayType, T.StructType, T.MapType)):
            cols.append(F.concat(F.lit("["), F.array_join(F.col(f.name).cast("array<string>"), " "),
                                 F.lit("]")).alias(f.name))
        elif isinstance(dt, (T.ArrayType, T.StructType, T.MapType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def save_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite",
               partition_by: list | None = None) -> None:
    """Write a managed table; an overwrite may change the schema.

    The data is first written to ``<name>__staged``, the present table becomes
    ``<name>__old``, the staged one takes the name and the old one goes.  A plan
    that reads ``name`` can overwrite it, and whenever the driver is lost the data
    is still there under one of the three names (a metastore without
    transactions cannot swap two names at once); the next writer finishes the swap.
    ``save_versioned`` commits in one step.
    """
    spark = df.sparkSession
    staged = f"{name}__staged"
    _finish_swap(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode == "append":
        writer = df.write.mode("append").format(fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(name)
        return
    writer.saveAsTable(staged)
    old = f"{name}__old"
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def _finish_swap(spark: SparkSession, name: str) -> None:
    """Complete a swap whose driver was lost between the two renames: the old table is
    renamed only when the staged one is complete, so the staged one takes the name."""
    staged, old = f"{name}__staged", f"{name}__old"
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(old):
        newest = staged if spark.catalog.tableExists(staged) else old
        spark.sql(f"ALTER TABLE {newest} RENAME TO {name}")
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def versioned_path(spark: SparkSession, name: str) -> str:
    """The folder of a versioned table, in the warehouse."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/versioned/{name}"


def save_versioned(df: DataFrame, name: str, mode: str = "overwrite", partition_by: list | None = None) -> int:
    """S3-S5 with atomic commits: overwrite (the schema may change) or append to a table
    that ``read_versioned`` reads; the new version."""
    return snapshots.write(df, versioned_path(df.sparkSession, name), mode, partition_by)


def read_versioned(spark: SparkSession, name: str, version: int | None = None) -> DataFrame:
    """The newest version of a table, or an older one."""
    return snapshots.read(spark, versioned_path(spark, name), version)


def append_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """S5."""
    _finish_swap(df.sparkSession, name)
    df.write.mode("append").format(fmt).saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S7."""
    return spark.read.table(name)


def save_path(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """S6 (write)."""
    df.write.mode(mode).format(fmt).save(path)


def load_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S6 (read)."""
    return spark.read.format(fmt).load(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; arrays serialised as ``[a b c]``, structs as JSON."""
    _serialise_arrays(df).write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S9."""
    df.write.mode(mode).parquet(path)


def frame(spark: SparkSession, rows: list, schema) -> DataFrame:
    """Small metric rows → DataFrame with an explicit schema."""
    return spark.createDataFrame(rows, schema)


def evaluation_view(spark: SparkSession, table: str = "model_evaluation") -> DataFrame:
    """The dashboard's projection over the evaluation table."""
    return spark.sql(f"SELECT model_type, top_k, precision_at_k, recall_at_k, evaluation_timestamp "
                     f"FROM {table} ORDER BY evaluation_timestamp DESC, model_type")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows (a limit, not a collect)."""
    return df.limit(n)


def log_metrics(spark: SparkSession, run: str, metrics: dict, table: str = "run_metrics",
                step: int | None = None) -> DataFrame:
    """Append ``(run, metric, value, step, ts)`` rows to a metrics table."""
    rows = [(run, k, None if v is None else float(v), step) for k, v in metrics.items()]
    df = spark.createDataFrame(rows, "run string, metric string, value double, step long").withColumn(
        "ts", F.current_timestamp())
    df = df.select([F.col(f.name).cast(f.dataType) for f in RUN_METRICS.fields])
    append_table(df, table)
    return df


def save_model(model, path: str) -> None:
    """Persist a fitted Spark ML model or pipeline."""
    model.write().overwrite().save(path)


def load_pipeline(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
