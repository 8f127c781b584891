"""Token streams cut into fixed windows, their split and their index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.operators.running import running_total


def pack(docs: DataFrame, group: list[str], order: str, tokens: str, size: int) -> DataFrame:
    """``group``, ``win`` and ``tokens`` (``size`` of them) of each full window of the groups' streams.

    Documents are laid end to end in ``order``; the last part window is dropped. Each
    document gives one slice a window it reaches, so tokens travel in arrays.
    """
    placed = running_total(docs.withColumn("_n", F.size(tokens)), group, order, F.col("_n"), "_at").filter("_n > 0")
    first, last = F.floor(F.col("_at") / size), F.floor((F.col("_at") + F.col("_n") - 1) / size)
    cut = placed.select(*group, order, tokens, "_at", "_n", F.explode(F.sequence(first, last)).alias("win"))
    begin = F.greatest(F.lit(0), F.col("win") * size - F.col("_at"))
    end = F.least(F.col("_n"), (F.col("win") + 1) * size - F.col("_at"))
    part = cut.select(*group, "win", F.struct(F.col(order).alias("o"), F.slice(tokens, (begin + 1).cast("int"), (end - begin).cast("int")).alias("t")).alias("p"))
    whole = part.groupBy(*group, "win").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    return whole.select(*group, "win", F.flatten(F.transform("ps", lambda p: p["t"])).alias("tokens")).filter(F.size("tokens") == size)


def split_windows(win: Column, every: int = 100) -> Column:
    """Every hundredth window of a stream, window 0 first, is for validation."""
    return F.when(win % every == 0, "val").otherwise("train")


def located(files: DataFrame, ids: DataFrame) -> DataFrame:
    """``id``, ``file`` and ``offset``: global window ids found by the files' cumulative counts.

    ``files`` has file and n; it is an index with a row a file.
    """
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = files.withColumn("begin", before)
    return ids.join(F.broadcast(spans), (F.col("id") >= F.col("begin")) & (F.col("id") < F.col("begin") + F.col("n"))).select("id", "file", (F.col("id") - F.col("begin")).alias("offset"))
