"""Running totals and ranks that never put one group into one task.

Rows are cut into blocks of the order key. A window runs inside each block only; the
totals of the blocks, one row each, are summed by a second window and joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.session import checkpointed


def running_total(df: DataFrame, group: list[str], order: str, value: Column, name: str, block: int = 100_000) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of the group before this one (0 for the first).

    ``order`` is an integer column, unique within a group; a null value counts as 0.
    """
    rows = df.withColumn("_v", F.coalesce(value, F.lit(0))).withColumn("_b", F.floor(F.col(order) / block))
    inside = Window.partitionBy(*group, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*group, "_b").agg(F.sum("_v").alias("_s"))
    across = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*group, "_b", F.coalesce(F.sum("_s").over(across), F.lit(0)).alias("_before"))
    part = rows.withColumn("_in", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    same = [part[g].eqNullSafe(before[g]) for g in [*group, "_b"]]
    out = part.join(before, same)
    return out.select(*[part[c] for c in df.columns], (F.col("_in") + F.col("_before")).alias(name))


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``: each row's place in the order of the whole table, from 1.

    Rows are range-partitioned by the order and numbered within partitions; the sizes of
    the partitions before, one row each, are added. The order should be unique.
    """
    keys = [f"_o{i}" for i in range(len(order))]
    rows = df.select("*", *[c.alias(k) for k, c in zip(keys, order)])
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = checkpointed(rows.repartitionByRange(parts, *keys).withColumn("_p", F.spark_partition_id()))
    sizes = cut.groupBy("_p").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_p", before.alias("_before"))
    ranked = cut.withColumn("_in", F.row_number().over(Window.partitionBy("_p").orderBy(*keys))).join(F.broadcast(starts), "_p")
    return ranked.select(*df.columns, (F.col("_in") + F.col("_before")).alias(name))
