"""Training-metric arithmetic as column expressions and roll-ups."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.operators.running import running_total


def _cosine(progress: Column, high: float, low: float) -> Column:
    return F.lit(low) + 0.5 * (high - low) * (1.0 + F.cos(math.pi * progress))


def rate_by_tokens(tokens: Column, total: int, warmup: int, high: float, low: float) -> Column:
    """Linear warm-up over tokens, then a cosine to the lowest rate."""
    progress = (tokens - warmup) / float(max(1, total - warmup))
    return F.when(tokens < warmup, high * tokens / float(max(1, warmup))).when(tokens >= total, F.lit(low)).otherwise(_cosine(progress, high, low))


def rate_by_steps(step: Column, total: int, warmup: int, high: float, low: float) -> Column:
    """Linear warm-up over steps, the first above zero, then a cosine clipped to its range."""
    progress = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (step - warmup) / float(max(1, total - warmup))))
    return F.when(step < warmup, high * (step + 1) / float(max(1, warmup))).otherwise(_cosine(progress, high, low))


def perplexity(loss: Column) -> Column:
    """exp of the loss, at most exp 20."""
    return F.exp(F.least(F.lit(20.0), loss))


def shifted_sum(values: Column, mask: Column) -> Column:
    """The sum of token scores where the mask, one place later, is set."""
    later = F.slice(mask, F.lit(2), F.size(mask))
    return F.aggregate(F.zip_with(F.slice(values, F.lit(1), F.greatest(F.size(mask) - 1, F.lit(0))), later, lambda v, m: v * m), F.lit(0.0), lambda a, b: a + b)


def preference_loss(pi_c: Column, pi_r: Column, ref_c: Column, ref_r: Column, beta: float) -> tuple[Column, Column, Column]:
    """Loss, whether the chosen answer is rewarded more, and the margin."""
    margin = beta * ((pi_c - ref_c) - (pi_r - ref_r))
    loss = F.log1p(F.exp(-F.abs(margin))) + F.greatest(-margin, F.lit(0.0))
    return loss, (margin > 0).cast("double"), margin


def best_so_far(df: DataFrame, group: list[str], order: str, value: str) -> DataFrame:
    """``df`` with ``best``: whether the value is below every earlier one of its run (runs are short series)."""
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    least = F.min(value).over(before)
    return df.withColumn("best", least.isNull() | (F.col(value) < least))


def until_spent(df: DataFrame, group: list[str], order: str, value: Column, cap: float) -> DataFrame:
    """The rows of each run up to and with the one whose running sum of ``value`` reaches ``cap``."""
    spent = running_total(df, group, order, value, "_spent")
    return spent.filter(F.col("_spent") < cap).drop("_spent")


def quality_verdict(ratio: Column) -> Column:
    return F.when(ratio < 1.10, "OK").when(ratio < 2.0, "DEGRADED").otherwise("BROKEN")


def parameter_count(vocab: int, hidden: int, inner: int, layers: int, heads: int, kv_heads: int) -> int:
    """Parameters of a gated transformer with tied embeddings."""
    kv = kv_heads * (hidden // heads)
    return vocab * hidden + layers * (2 * hidden * hidden + 2 * hidden * kv + 3 * hidden * inner + 2 * hidden)
