"""Deterministic sampling, quotas and splits by hashed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def hashed_key(seed: str, *columns: str) -> Column:
    """A reproducible random order: md5 of the seed and the key."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in columns]))


def bottom_k(df: DataFrame, group: list[str], key: str, k: Column, seed: str) -> DataFrame:
    """The ``k`` rows of each group that come first in hashed order, with their rank ``rn``.

    Spark keeps only the first rows of each group per task before it shuffles (window group limit) where k is a constant.
    """
    order = Window.partitionBy(*group).orderBy(hashed_key(seed, key), key)
    return df.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= k)


def quotas(n: int, shares: list[tuple[str, float]], pad: str) -> list[tuple[str, int, int]]:
    """(name, first rank, last rank): whole-number quotas of n, half to even, padded with ``pad`` and cut at n."""
    out, at = [], 0
    for name, share in shares:
        size = min(round(n * share), n - at)
        if size > 0:
            out.append((name, at + 1, at + size))
            at += size
    if at < n:
        out.append((pad, at + 1, n))
    return out


def held_out(df: DataFrame, key: str, share: float, seed: str) -> DataFrame:
    """``df`` with ``split``: the first max(1, floor(n share)) rows in hashed order are 'val'.

    The rank is only needed of the smallest hashes: the validation ids are taken with a
    limit, which Spark computes by a partial top-k in every task.
    """
    n = df.count()
    size = max(1, int(n * share)) if n else 0
    val = df.select(key).orderBy(hashed_key(seed, key), key).limit(size).select(key, F.lit("val").alias("_split"))
    return df.join(val, key, "left").withColumn("split", F.coalesce("_split", F.lit("train"))).drop("_split")
