"""Queries of the training-metric roll-ups, and their SQL.

Embedding values stand for token scores, event values for losses and timings.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.operators import metrics as M
from corpusmill.plans.instruct import PAIRS_SQL, pairs
from corpusmill.sources.tables import table

PI = "3.141592653589793::DOUBLE"


def _scores(spark, d):  # noqa: ANN001, ANN202
    rows = table(spark, d, "embeddings", "vec_id", "embedding")
    values = F.transform("embedding", lambda x: -F.abs(x.cast("double")))
    mask = F.transform(F.sequence(F.lit(1), F.size("embedding")), lambda i: F.when(i > F.size("embedding") / 2, 1).otherwise(0))
    return rows.select("vec_id", M.shifted_sum(values, mask).alias("logp"))


def _losses(spark, d):  # noqa: ANN001, ANN202
    return table(spark, d, "events", "event_id", "event_type", "value").filter("value is not null").select("event_id", "event_type", (F.col("event_id") % 50).alias("batch"), (F.col("value") / 100).alias("loss"))


def dpo_logps(spark, d):  # noqa: ANN001, ANN201
    return _scores(spark, d).select("vec_id", F.bround("logp", 6).alias("logp"))


def dpo_loss(spark, d):  # noqa: ANN001, ANN201
    rows = _scores(spark, d).withColumn("q", F.floor(F.col("vec_id") / 4)).withColumn("s", F.col("vec_id") % 4)
    quad = rows.groupBy("q").agg(*[F.max(F.when(F.col("s") == i, F.col("logp"))).alias(f"x{i}") for i in range(4)]).dropna()
    loss, acc, margin = M.preference_loss(F.col("x0"), F.col("x1"), F.col("x2"), F.col("x3"), 0.1)
    return quad.select("q", F.bround(loss, 6).alias("loss"), acc.alias("accuracy"), F.bround(margin, 6).alias("margin"))


def lr_schedule_tokens(spark, d):  # noqa: ANN001, ANN201
    t = spark.range(0, 120).select((F.col("id") * 1000).alias("tokens"))
    return t.select("tokens", F.bround(M.rate_by_tokens(F.col("tokens"), 100_000, 10_000, 6e-4, 6e-5), 9).alias("lr"))


def lr_schedule_steps(spark, d):  # noqa: ANN001, ANN201
    t = spark.range(0, 130).select(F.col("id").alias("step"))
    return t.select("step", F.bround(M.rate_by_steps(F.col("step"), 120, 12, 2e-5, 2e-6), 12).alias("lr"))


def perplexity(spark, d):  # noqa: ANN001, ANN201
    return _losses(spark, d).select("event_id", F.bround(M.perplexity(F.col("loss")), 4).alias("ppl"))


def loss_batch_mean(spark, d):  # noqa: ANN001, ANN201
    by = _losses(spark, d).groupBy("event_type", "batch").agg(F.avg("loss").alias("m"))
    return by.groupBy("event_type").agg(F.bround(F.avg("m"), 6).alias("loss"))


def loss_token_mean(spark, d):  # noqa: ANN001, ANN201
    n = 1 + F.col("event_id") % 7
    return _losses(spark, d).groupBy("event_type").agg(F.bround(F.sum(F.col("loss") * n) / F.sum(n), 6).alias("loss"))


def best_checkpoint(spark, d):  # noqa: ANN001, ANN201
    steps = _losses(spark, d).groupBy("event_type", "batch").agg(F.bround(F.avg("loss"), 6).alias("loss"))
    return M.best_so_far(steps, ["event_type"], "batch", "loss").filter("best").select("event_type", "batch", "loss")


def bench_summary(spark, d):  # noqa: ANN001, ANN201
    rows = _losses(spark, d)
    by = rows.groupBy("event_type").agg(F.count("*").alias("n"), F.bround(F.median("loss"), 6).alias("median_s"), F.bround(F.stddev_pop("loss"), 6).alias("stdev_s"))
    slowest = F.max("median_s").over(Window.partitionBy())  # of a few event types
    return by.select("event_type", "n", "median_s", "stdev_s", F.bround(F.try_divide(slowest, F.col("median_s")), 4).alias("speedup"))


def quality_verdict(spark, d):  # noqa: ANN001, ANN201
    base = F.min("loss").over(Window.partitionBy())  # of a few event types
    rows = loss_token_mean(spark, d).select("event_type", F.try_divide(F.col("loss"), base).alias("r"))
    return rows.select("event_type", F.bround("r", 4).alias("ratio"), M.quality_verdict(F.col("r")).alias("verdict"))


def run_cutoff(spark, d):  # noqa: ANN001, ANN201
    """The steps of each run until 97 % of a cap is used up."""
    return M.until_spent(_losses(spark, d), ["event_type"], "event_id", F.floor(F.col("loss") * 1000).cast("bigint"), 0.97 * 200_000).select("event_type", "event_id")


def usage_totals(spark, d):  # noqa: ANN001, ANN201
    """Estimated tokens that went to and came from the models, by task."""
    est = lambda c: F.ceil(F.length(c) / 4.0)
    rows = pairs(spark, d).select("task", est("user").alias("i"), est("answer").alias("o"))
    return rows.groupBy("task").agg(F.count("*").alias("n_calls"), F.sum("i").alias("tokens_in"), F.sum("o").alias("tokens_out"))


def param_count(spark, d):  # noqa: ANN001, ANN201
    return spark.createDataFrame([(h, M.parameter_count(16384, h, 2048, 12, 12, 12)) for h in (384, 768, 1536)], "hidden int, params bigint")


QUERIES = {f.__name__: f for f in (dpo_logps, dpo_loss, lr_schedule_tokens, lr_schedule_steps, perplexity, loss_batch_mean, loss_token_mean, best_checkpoint, bench_summary, quality_verdict, run_cutoff, usage_totals, param_count)}

SCORES = "scores AS (SELECT vec_id, list_sum(list_transform(range(1, len(embedding)), lambda i: CASE WHEN i + 1 > len(embedding) / 2.0 THEN -abs(CAST(embedding[i] AS DOUBLE)) ELSE 0.0::DOUBLE END)) AS logp FROM embeddings)"
LOSSES = "losses AS (SELECT event_id, event_type, event_id % 50 AS batch, value / 100 AS loss FROM events WHERE value IS NOT NULL)"
TOKEN = "t AS (SELECT event_type, round_even(sum(loss * (1 + event_id % 7)) / sum(1 + event_id % 7), 6) AS loss FROM losses GROUP BY event_type)"

SQL = {
    "dpo_logps": f"WITH {SCORES} SELECT vec_id, round_even(logp, 6) AS logp FROM scores",
    "dpo_loss": f"""WITH {SCORES}, q AS (SELECT vec_id // 4 AS q, max(logp) FILTER (vec_id % 4 = 0) AS a, max(logp) FILTER (vec_id % 4 = 1) AS b, max(logp) FILTER (vec_id % 4 = 2) AS c, max(logp) FILTER (vec_id % 4 = 3) AS d FROM scores GROUP BY 1),
m AS (SELECT q, 0.1::DOUBLE * ((a - c) - (b - d)) AS m FROM q WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AND d IS NOT NULL) SELECT q, round_even(ln(1 + exp(-abs(m))) + greatest(-m, 0.0::DOUBLE), 6) AS loss, CASE WHEN m > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS accuracy, round_even(m, 6) AS margin FROM m""",
    "lr_schedule_tokens": f"SELECT tokens, round_even(CASE WHEN tokens < 10000 THEN 6e-4::DOUBLE * tokens / 10000.0::DOUBLE WHEN tokens >= 100000 THEN 6e-5::DOUBLE ELSE 6e-5::DOUBLE + 0.5::DOUBLE * (6e-4::DOUBLE - 6e-5::DOUBLE) * (1.0::DOUBLE + cos({PI} * ((tokens - 10000) / 90000.0::DOUBLE))) END, 9) AS lr FROM (SELECT i * 1000 AS tokens FROM range(120) r(i))",
    "lr_schedule_steps": f"SELECT step, round_even(CASE WHEN step < 12 THEN 2e-5::DOUBLE * (step + 1) / 12.0::DOUBLE ELSE 2e-6::DOUBLE + 0.5::DOUBLE * (2e-5::DOUBLE - 2e-6::DOUBLE) * (1.0::DOUBLE + cos({PI} * least(1.0::DOUBLE, greatest(0.0::DOUBLE, (step - 12) / 108.0::DOUBLE)))) END, 12) AS lr FROM range(130) r(step)",
    "perplexity": f"WITH {LOSSES} SELECT event_id, round_even(exp(least(20.0::DOUBLE, loss)), 4) AS ppl FROM losses",
    "loss_batch_mean": f"WITH {LOSSES}, b AS (SELECT event_type, batch, avg(loss) AS m FROM losses GROUP BY ALL) SELECT event_type, round_even(avg(m), 6) AS loss FROM b GROUP BY event_type",
    "loss_token_mean": f"WITH {LOSSES}, {TOKEN} SELECT event_type, loss FROM t",
    "best_checkpoint": f"WITH {LOSSES}, b AS (SELECT event_type, batch, round_even(avg(loss), 6) AS loss FROM losses GROUP BY ALL), w AS (SELECT *, min(loss) OVER (PARTITION BY event_type ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM b) SELECT event_type, batch, loss FROM w WHERE before IS NULL OR loss < before",
    "bench_summary": f"WITH {LOSSES}, b AS (SELECT event_type, count(*) AS n, round_even(median(loss), 6) AS median_s, round_even(stddev_pop(loss), 6) AS stdev_s FROM losses GROUP BY event_type) SELECT event_type, n, median_s, stdev_s, round_even(max(median_s) OVER () / nullif(median_s, 0), 4) AS speedup FROM b",
    "quality_verdict": f"WITH {LOSSES}, {TOKEN}, r AS (SELECT event_type, loss / nullif(min(loss) OVER (), 0) AS ratio FROM t) SELECT event_type, round_even(ratio, 4) AS ratio, CASE WHEN ratio < 1.10 THEN 'OK' WHEN ratio < 2.0 THEN 'DEGRADED' ELSE 'BROKEN' END AS verdict FROM r",
    "run_cutoff": f"WITH {LOSSES}, w AS (SELECT event_type, event_id, coalesce(sum(CAST(floor(loss * 1000) AS BIGINT)) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM losses) SELECT event_type, event_id FROM w WHERE spent < 194000",
    "usage_totals": f"WITH {PAIRS_SQL} SELECT task, count(*) AS n_calls, CAST(sum(ceil(length(user) / 4.0)) AS BIGINT) AS tokens_in, CAST(sum(ceil(length(answer) / 4.0)) AS BIGINT) AS tokens_out FROM pairs GROUP BY task",
    "param_count": "SELECT CAST(h AS INTEGER) AS hidden, CAST(16384 * h + 12 * (2 * h * h + 2 * h * (12 * (h // 12)) + 3 * h * 2048 + 2 * h) AS BIGINT) AS params FROM (VALUES (384), (768), (1536)) v(h)",
}
