"""Materialised intermediate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartwheel.session import checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint in ``spark.checkpoint.dir`` (idempotent): cuts the
    lineage, so that an expensive producer runs once."""
    if getattr(df, "_cartwheel_materialized", False):
        return df
    checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    out._cartwheel_materialized = True
    return out
