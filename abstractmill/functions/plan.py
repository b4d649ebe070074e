"""Help for Catalyst."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pin(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a costly column that a later filter may test.

    A filter is pushed below the projection that makes its columns, which then are
    computed once for the filter and once for the result. It is not pushed through a
    generator, so the column goes through one that yields each value as it is.
    """
    kept = [c for c in df.columns if c != name]
    return df.select(*kept, F.explode(F.array(column)).alias(name))


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan of few large row groups, dealt to all cores; a scan of many stays as it is.

    For a scan with costly columns above it: one row group is one task. Not for plans with a
    shuffle, which would be run to count their partitions.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
