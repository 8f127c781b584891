"""Queries of packing, splitting, sampling and vocabulary, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import packing as P
from corpusmill.operators import sampling as S
from corpusmill.operators import vocabulary as V
from corpusmill.operators.running import global_rank
from corpusmill.plans.cleaning import DOCS, docs, sql_collapsed
from corpusmill.plans.dedup import RAW, raw
from corpusmill.session import checkpointed

SIZE = 256


def _streams(spark, d):  # noqa: ANN001, ANN202
    return docs(spark, d).select("doc_id", "source", "shard", F.concat(T.tokens(F.col("text")), F.array(F.lit("<eos>"))).alias("toks"))


def _windows(spark, d):  # noqa: ANN001, ANN202
    return P.pack(_streams(spark, d), ["source", "shard"], "doc_id", "toks", SIZE)


def pack_windows(spark, d):  # noqa: ANN001, ANN201
    return _windows(spark, d).select("source", "shard", "win", F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


def split_windows(spark, d):  # noqa: ANN001, ANN201
    return _windows(spark, d).select("source", "shard", "win", P.split_windows(F.col("win")).alias("split"))


def token_index(spark, d):  # noqa: ANN001, ANN201
    by = _windows(spark, d).groupBy(P.split_windows(F.col("win")).alias("split")).agg(F.count("*").alias("windows"))
    return by.select("split", "windows", (F.col("windows") * SIZE).alias("tokens"))


def window_locate(spark, d):  # noqa: ANN001, ANN201
    files = _windows(spark, d).groupBy(F.concat_ws("/", "source", "shard").alias("file")).agg(F.count("*").alias("n"))
    files = checkpointed(files)  # an index of a row a file
    total = files.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    return P.located(files, spark.range(total))


def epoch_shard(spark, d):  # noqa: ANN001, ANN201
    world = 4
    rows = global_rank(docs(spark, d).select("doc_id"), [S.hashed_key("epoch-0", "doc_id"), F.col("doc_id")], "rn").withColumn("rn", F.col("rn") - 1)
    n = docs(spark, d).count()
    return rows.filter(F.col("rn") < n - n % world).select("doc_id", (F.col("rn") % world).alias("rank"), F.floor(F.col("rn") / world).alias("at"))


def shard_assign(spark, d):  # noqa: ANN001, ANN201
    """The worker of each document: its place in its shard, which starts at 0 in every shard."""
    return raw(spark, d).select("doc_key", F.pmod("idx", F.lit(7)).alias("worker"))


def pretoken_counts(spark, d):  # noqa: ANN001, ANN201
    return docs(spark, d).select(F.explode(T.tokens(F.col("text"))).alias("token")).groupBy(F.md5("token").alias("token_md5")).agg(F.count("*").alias("n"))


def encode_docs(spark, d):  # noqa: ANN001, ANN201
    out = V.encoded(docs(spark, d), "doc_id", "text", eos=50256)
    return out.select("doc_id", F.size("ids").alias("n_ids"), F.md5(F.array_join(F.transform("ids", lambda x: x.cast("string")), " ")).alias("ids_md5"))


def bpe_roundtrip(spark, d):  # noqa: ANN001, ANN201
    return V.roundtrip(docs(spark, d), "doc_id", "text")


def vocab_usage(spark, d):  # noqa: ANN001, ANN201
    return V.used_vocabulary(docs(spark, d), "text")


TOKS = f"toks AS (SELECT doc_id, source, shard, list_append(list_filter(string_split({sql_collapsed('text')}, ' '), lambda w: w <> ''), '<eos>') AS t FROM docs)"
WIN = f"""flat AS (SELECT source, shard, doc_id, unnest(t) AS tok, unnest(range(len(t))) AS i FROM toks),
pos AS (SELECT source, shard, tok, row_number() OVER (PARTITION BY source, shard ORDER BY doc_id, i) - 1 AS p FROM flat),
win AS (SELECT source, shard, p // {SIZE} AS win, string_agg(tok, ' ' ORDER BY p) AS s FROM pos GROUP BY ALL HAVING count(*) = {SIZE})"""
SPLIT = "CASE WHEN win % 100 = 0 THEN 'val' ELSE 'train' END"

QUERIES = {f.__name__: f for f in (pack_windows, split_windows, token_index, window_locate, epoch_shard, shard_assign, pretoken_counts, encode_docs, bpe_roundtrip, vocab_usage)}

SQL = {
    "pack_windows": f"WITH {DOCS}, {TOKS}, {WIN} SELECT source, shard, win, md5(s) AS tokens_md5 FROM win",
    "split_windows": f"WITH {DOCS}, {TOKS}, {WIN} SELECT source, shard, win, {SPLIT} AS split FROM win",
    "token_index": f"WITH {DOCS}, {TOKS}, {WIN} SELECT {SPLIT} AS split, count(*) AS windows, count(*) * {SIZE} AS tokens FROM win GROUP BY 1",
    "window_locate": f"WITH {DOCS}, {TOKS}, {WIN}, f AS (SELECT concat_ws('/', source, shard) AS file, win FROM win), r AS (SELECT file, row_number() OVER (ORDER BY file, win) - 1 AS id, row_number() OVER (PARTITION BY file ORDER BY win) - 1 AS o FROM f) SELECT id, file, o AS offset FROM r",
    "epoch_shard": f"WITH {DOCS}, r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('epoch-0|' || doc_id), doc_id) - 1 AS rn, count(*) OVER () AS n FROM docs) SELECT doc_id, rn % 4 AS rank, rn // 4 AS at FROM r WHERE rn < n - n % 4",
    "shard_assign": f"WITH {RAW} SELECT doc_key, idx % 7 AS worker FROM docs",
    "pretoken_counts": f"WITH {DOCS}, t AS (SELECT unnest(list_filter(string_split({sql_collapsed('text')}, ' '), lambda w: w <> '')) AS token FROM docs) SELECT md5(token) AS token_md5, count(*) AS n FROM t GROUP BY token",
}
