"""Table scans: one parquet table of a data folder, with only the columns asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LEAST_SPREAD, MOST_SPREAD = 1_000_000, 1 << 30


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where a scan of a few megabytes to MOST_SPREAD gives fewer partitions than there are.

    A single file of one row group is such a scan. Larger tables are never shuffled here:
    their row groups make partitions enough, or the session's settings of file partitions do.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if LEAST_SPREAD < size <= MOST_SPREAD and df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The parquet table ``name`` below ``folder``; ``columns`` prune the scan."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(df.select(*columns) if columns else df)
