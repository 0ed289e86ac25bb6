"""Inputs that come in too few pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Spread an input over the cores by the hash of ``columns`` if Spark reads it in fewer tasks than that.

    A file of one row group, a compressed text or a multi-line document is one task however many cores there are;
    row-wise work on it would run alone. Inputs in enough pieces, as large ones are, pass through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *columns)
