"""Problem 1: the share of repeated content inside each document.

The named method hashes normalised lines, counts the documents of a host that hold each,
removes lines above limits and rejects depleted documents; ``line_frequency`` is that. It
cannot see a passage that one record repeats and no other holds, nor a repeat that doesn't
fill lines. ``repeated_share`` therefore applies the same steps with another unit and
scope: the unit is a window of five words, hashed, the scope is the record, windows met
more than once are marked, and records of which too much would go are reported.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.arrow import map_arrow
from corpusmill.sources.tables import table

WINDOW = 5
MIN_SHARE = 0.30
WORD = re.compile(r"[^\W_]+")
MIX = np.uint64(0x9E3779B97F4A7C15)


def covered_by_repeats(ids: np.ndarray, window: int = WINDOW) -> int:
    """How many positions of ``ids`` lie in a window of values that occurs at least twice."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    h = ids[:n].astype(np.uint64)
    for k in range(1, window):
        h = (h ^ (h >> np.uint64(29))) * MIX + ids[k : k + n].astype(np.uint64)
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(n + window, np.int32)
    edge[:n] += twice
    edge[window : window + n] -= twice
    return int((np.cumsum(edge)[: len(ids)] > 0).sum())


def repeated_share(df: DataFrame, keys: list[str], text: str, window: int = WINDOW) -> DataFrame:
    """``keys``, ``n_words``, ``n_repeated`` and ``share`` of every row.

    Words are runs of letters and digits, case ignored; a word is repeated when it stands
    in ``window`` or more words that occur again in the same row, all occurrences counted.
    Null and empty texts and texts under ``window`` words have share 0. One narrow stage,
    linear in the text but for a sort of each row's own windows; no shuffle, so hot keys
    and copies cost nothing extra.
    """
    picked = df.select(*keys, F.col(text).alias("_text"))

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            numbers: dict[str, int] = {}
            number, find = numbers.setdefault, WORD.findall
            total, repeated = [], []
            for t in batch.column(len(keys)).to_pylist():
                words = find(t.lower()) if t else []
                total.append(len(words))
                repeated.append(covered_by_repeats(np.array([number(w, len(numbers)) for w in words], np.int64), window) if len(words) > window else 0)
            share = [r / n if n else 0.0 for r, n in zip(repeated, total)]
            return {k: batch.column(i) for i, k in enumerate(keys)} | {"n_words": total, "n_repeated": repeated, "share": share}

        return work

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return map_arrow(picked, make, f"{kinds}, n_words int, n_repeated int, share double")


def line_frequency(df: DataFrame, key: str, host: str, text: str, min_docs: int = 5, min_share: float = 0.4, max_removed: float = 0.5) -> DataFrame:
    """The named method: ``key``, ``n_lines``, ``n_removed`` and ``rejected`` of every row.

    A line (trimmed, lower case, white space collapsed) is removed where at least
    ``min_docs`` documents and the share ``min_share`` of its host's documents hold it; a
    document is rejected where more than ``max_removed`` of its lines go. Rows with a null
    host have no host and lose nothing; blank lines don't count. Each document gives each
    line once, so the counts are partially aggregated before the shuffle however hot the
    host; the join back is salted by the document's key.
    """
    salts = 16
    docs = df.select(F.col(key).alias("_k"), F.col(host).alias("_h"), F.col(text).alias("_t")).filter("_t is not null")
    line = F.trim(F.regexp_replace(F.lower(F.col("_l")), r"\s+", " "))
    lines = docs.select("_k", "_h", F.explode(F.split("_t", "\n")).alias("_l")).select("_k", "_h", line.alias("_l")).filter("_l <> ''")
    lines = lines.select("_k", F.xxhash64("_h", "_l").alias("_x"), "_h", F.pmod(F.xxhash64("_k"), F.lit(salts)).cast("int").alias("_s"))
    sizes = docs.filter("_h is not null").groupBy("_h").agg(F.count("*").alias("_n"))
    often = lines.filter("_h is not null").groupBy("_k", "_h", "_x").agg(F.count("*").alias("_c"))
    often = often.groupBy("_h", "_x").agg(F.count("*").alias("_d")).filter(F.col("_d") >= min_docs)
    often = often.join(sizes, "_h").filter(F.col("_d") >= F.col("_n") * min_share).select("_x", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_s"), F.lit(1).alias("_gone"))
    marked = lines.join(often, ["_x", "_s"], "left").groupBy("_k").agg(F.count("*").alias("n_lines"), F.count("_gone").alias("n_removed"))
    out = df.select(F.col(key).alias("_k")).join(marked, "_k", "left")
    n, gone = F.coalesce("n_lines", F.lit(0)), F.coalesce("n_removed", F.lit(0))
    return out.select(F.col("_k").alias(key), n.alias("n_lines"), gone.alias("n_removed"), (gone > n * max_removed).alias("rejected"))


def records(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """``source``, ``rec_id`` and ``text`` of the raw tables named."""
    columns = {"case-law": ("case_law", "case_id", "document"), "sec": ("sec", "sec_id", "text"), "fineweb-edu": ("fineweb_edu", "web_id", "text")}
    parts = []
    for name in names:
        where, key, text = columns[name]
        parts.append(table(spark, sf_dir, where, key, text).select(F.lit(name).alias("source"), F.col(key).alias("rec_id"), F.col(text).alias("text")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = repeated_share(records(spark, sf_dir, "case-law", "sec"), ["source", "rec_id"], "text")
    return shares.filter(F.col("share") >= MIN_SHARE).select("source", "rec_id")


def p1_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_share(records(spark, sf_dir, "case-law", "sec"), ["source", "rec_id"], "text")


def p1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The named method over both tables; the host is a filing's filer and an opinion's court."""
    parts = [
        table(spark, sf_dir, name, key, host, text).select(F.concat(F.lit(f"{source}/"), F.col(key)).alias("rec"), F.concat(F.lit(f"{source}/"), F.col(host)).alias("host"), F.col(text).alias("text"))
        for source, name, key, host, text in (("sec", "sec", "sec_id", "filer", "text"), ("case-law", "case_law", "case_id", "court", "document"))
    ]
    return line_frequency(parts[0].unionByName(parts[1]), "rec", "host", "text")
