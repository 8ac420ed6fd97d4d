"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of a text: runs of anything but the six ASCII white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, read by Spark alone (any store that Spark can reach)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def per_text(df: DataFrame, inputs: list[Column], fn: Callable[..., tuple], schema: str,
             rows_per_batch: int = 256) -> DataFrame:
    """Run ``fn`` on every row of ``inputs`` and return its tuples under ``schema``.

    Rows travel as Arrow batches and leave in batches of ``rows_per_batch``, so
    a worker holds a bounded number of results.  ``fn`` may be a factory marked
    with ``per_worker``: it is then called once for each task.
    """
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = fn() if getattr(fn, "per_worker", False) else fn
        for batch in batches:
            for lo in range(0, batch.num_rows, rows_per_batch):
                part = batch.slice(lo, rows_per_batch)
                rows = [call(*values) for values in zip(*(c.to_pylist() for c in part.columns))]
                columns = list(zip(*rows)) if rows else [[] for _ in arrow]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return df.select(*inputs).mapInArrow(run, schema)


def per_worker(factory: Callable) -> Callable:
    factory.per_worker = True
    return factory


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def null_to_empty(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))
