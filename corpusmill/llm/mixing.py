"""Problem 9: mixing sources to target weights.

The documents' tokens are summed over cells of source, language and topic. Iterative
proportional fitting rakes the cells' weights to the target shares of the sources and to
the corpus' own shares of languages and topics, with every weight capped by its source's
largest number of repeats. Documents are then drawn with the weights as expected numbers
of copies: whole copies are certain, the fraction is drawn by a hash of the id, and the
cut of each source is calibrated so that the tokens drawn meet its target.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.tokens import token_counts
from corpusmill.session import checkpointed
from corpusmill.sources.tables import table

ROUNDS = 200
BINS = 4096
SEED = 9

# Words that tell a topic.
TOPICS = {
    "law": "court|tribunal|appellant|statute|plaintiff|defendant|judgment|counsel|verdict|witness|tenant|landlord|lease|contract",
    "finance": "revenue|equity|dividend|filing|shareholder|portfolio|currency|audit|earnings|borrowing|valuation|asset",
    "science": "experiment|planet|molecule|equation|fossil|glacier|protein|telescope|habitat|hypothesis|enzyme|theorem",
}


def topic_of(text: Column) -> Column:
    """The topic whose words a text holds most, 'other' of none; ties go to the first named."""
    low = F.lower(F.coalesce(text, F.lit("")))
    counts = [F.regexp_count(low, F.lit(rf"\b(?:{words})\b")) for words in TOPICS.values()]
    most = F.greatest(*counts)
    out = F.lit("other")
    for name, n in reversed(list(zip(TOPICS, counts))):
        out = F.when((n == most) & (most > 0), name).otherwise(out)
    return out


def rake(cells: list[dict], shares: dict[str, float], repeats: dict[str, int]) -> tuple[list[float], float]:
    """The weight of each cell (source, lang, topic, tokens), and the tokens of the whole mix.

    The mix is as large as the shares and repeats allow. Weights never exceed a source's
    repeats; where caps bind, sources come before languages and topics, so the source
    shares are met to rounding and the others as nearly as the caps leave room for.
    """
    source = np.array([c["source"] for c in cells])
    tokens = np.array([float(c["tokens"]) for c in cells])
    cap = np.array([float(repeats.get(s, 0)) for s in source])
    have = {s: float((tokens * cap)[source == s].sum()) for s in shares}
    possible = [have[s] / p for s, p in shares.items() if p > 0]
    total = min(possible) if possible else 0.0
    weight = np.where(cap > 0, 1.0, 0.0)
    if not total:
        return [0.0] * len(cells), 0.0
    every = tokens * (cap > 0)
    targets = [(source == s, p * total) for s, p in shares.items()]
    for column in ("topic", "lang"):
        value = np.array([c[column] for c in cells])
        targets = [(value == v, total * every[value == v].sum() / every.sum()) for v in sorted(set(value))] + targets
    for _ in range(ROUNDS):
        moved = 0.0
        for mask, goal in targets:
            for _ in range(8):  # a capped cell leaves its share to the others
                now = float((weight * tokens)[mask].sum())
                free = mask & (weight < cap) & (weight > 0)
                room = float((weight * tokens)[free].sum())
                if now <= 0 or abs(now - goal) <= 1e-9 * max(goal, 1):
                    break
                if now > goal:
                    factor, part = goal / now, mask
                elif room > 0:
                    factor, part = (goal - (now - room)) / room, free
                else:
                    break
                weight[part] = np.minimum(weight[part] * factor, cap[part])
                moved = max(moved, abs(factor - 1))
        if moved < 1e-10:
            break
    return weight.tolist(), total


def mix(docs: DataFrame, targets: DataFrame, key: str, source: str, lang: str, topic: str, tokens: str) -> DataFrame:
    """``key``, ``source``, ``lang``, ``topic``, ``n_tokens``, ``weight`` and ``copies`` of every document of a target source.

    ``targets`` has source, target_share and max_repeats, a row a source. Documents of other
    or null sources are left out; those without tokens get no copy. The cells (sources by
    languages by topics) and the histograms of the calibration are small tables of fixed
    size; documents are only joined with them. A null language or topic is a value of its own.
    """
    spark = docs.sparkSession
    wanted = {r["source"]: (r["target_share"], r["max_repeats"]) for r in targets.toLocalIterator() if r["source"] is not None}
    rows = docs.select(F.col(key).alias("id"), F.col(source).alias("source"), F.coalesce(lang, F.lit("")).alias("lang"), F.coalesce(topic, F.lit("")).alias("topic"), F.col(tokens).alias("tokens"))
    rows = checkpointed(rows.filter(F.col("source").isin(*wanted) if wanted else F.lit(False)))
    cells = [r.asDict() for r in rows.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")).collect()]
    weights, _ = rake(cells, {s: w[0] for s, w in wanted.items()}, {s: w[1] for s, w in wanted.items()})
    fitted = spark.createDataFrame([(c["source"], c["lang"], c["topic"], w) for c, w in zip(cells, weights)], "source string, lang string, topic string, weight double")
    weighed = rows.join(F.broadcast(fitted), ["source", "lang", "topic"])
    whole = F.floor(F.col("weight") + 1e-9)
    part = F.greatest(F.col("weight") - whole, F.lit(0.0))
    u = (F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    drawn = weighed.withColumn("whole", whole).withColumn("part", F.when(part > 1e-6, part).otherwise(0.0)).withColumn("place", F.when(F.col("part") > 0, u / F.col("part")))
    bins = drawn.filter("part > 0").groupBy("source", F.least(F.floor(F.col("place") * (BINS / 2)), F.lit(BINS)).alias("bin")).agg(F.sum("tokens").alias("t"), F.sum(F.col("tokens") * F.col("part")).alias("goal"))
    goals: dict[str, float] = {}
    by: dict[str, dict[int, float]] = {}
    for r in bins.collect():  # at most BINS + 1 rows a source
        goals[r["source"]] = goals.get(r["source"], 0.0) + r["goal"]
        by.setdefault(r["source"], {})[r["bin"]] = float(r["t"])
    cuts = []
    for s, goal in goals.items():
        run, cut = 0.0, 0.0
        for b in sorted(by[s]):
            if run + by[s][b] >= goal:
                cut = (b + (goal - run) / max(by[s][b], 1.0)) / (BINS / 2)
                break
            run += by[s][b]
            cut = (b + 1) / (BINS / 2)
        cuts.append((s, cut))
    limits = spark.createDataFrame(cuts, "source string, cut double")
    joined = drawn.join(F.broadcast(limits), "source", "left")
    copies = F.when(F.col("tokens") > 0, F.col("whole") + F.when(F.col("place") < F.col("cut"), 1).otherwise(0)).otherwise(0)
    return joined.select(F.col("id").alias(key), "source", "lang", "topic", F.col("tokens").alias("n_tokens"), F.round("weight", 9).alias("weight"), copies.cast("int").alias("copies"))


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "text")
    counted = token_counts(docs.withColumn("topic", topic_of(F.col("text"))).withColumn("lang", F.lower("lang")), ["doc_id", "source", "lang", "topic"], "text")
    return mix(counted, table(spark, sf_dir, "mix_targets"), "doc_id", "source", "lang", "topic", "n_tokens")


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = _mixed(spark, sf_dir)
    by = mixed.groupBy("source").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"), F.sum("copies").alias("documents"), F.max("copies").alias("most_copies"))
    total = by.agg(F.sum("tokens").alias("_total"))
    targets = table(spark, sf_dir, "mix_targets")
    out = targets.join(by, "source", "left").join(F.broadcast(total))
    return out.select("source", "target_share", F.coalesce(F.try_divide("tokens", "_total"), F.lit(0.0)).alias("reached_share"), "tokens", "documents", "most_copies", "max_repeats")


def p9_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``marginal``, ``value``, ``corpus_share`` and ``reached_share`` of the tokens of each source, language and topic, before and after mixing."""
    mixed = checkpointed(_mixed(spark, sf_dir).withColumn("drawn", F.col("copies") * F.col("n_tokens")))
    total = mixed.agg(F.sum("n_tokens").alias("n"), F.sum("drawn").alias("d")).first()
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("marginal"), F.col(c).alias("value")) for c in ("source", "lang", "topic")])).alias("m")
    by = mixed.select(values, "n_tokens", "drawn").groupBy("m.marginal", "m.value").agg(F.sum("n_tokens").alias("n"), F.sum("drawn").alias("d"))
    share = lambda c, whole: F.col(c) / float(whole or 1)
    return by.select("marginal", "value", share("n", total["n"]).alias("corpus_share"), share("d", total["d"]).alias("reached_share"))
