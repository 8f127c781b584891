"""Queries over streams, drained, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.plans.cleaning import SOFT, sql_collapsed
from corpusmill.streaming import cleaning as L


def stream_clean(spark, d):  # noqa: ANN001, ANN201
    rows = L.parquet_stream(spark, f"{d}/documents.parquet").filter("source is not null").select("doc_id", "text")
    return L.drained(L.clean_stream(rows, "doc_id", "text").select("doc_id", "reason", "clean_chars"), spark)


def stream_first_seen(spark, d):  # noqa: ANN001, ANN201
    """Each normalized text once, by the state of the stream alone: copies within 60 days of event time are dropped as they arrive."""
    rows = L.parquet_stream(spark, f"{d}/documents.parquet").filter("ingested_at is not null").select("doc_id", "text", F.col("ingested_at").cast("timestamp").alias("ingested_at"))
    return L.drained(L.first_seen(rows, "text", "ingested_at", "60 days").select(F.md5(T.normalized(F.col("text"))).alias("text_md5")), spark)


QUERIES = {f.__name__: f for f in (stream_clean, stream_first_seen)}
SQL = {
    "stream_clean": f"{SOFT} SELECT doc_id, reason, CAST(clean_chars AS INTEGER) AS clean_chars FROM chain",
    "stream_first_seen": f"SELECT DISTINCT md5({sql_collapsed("lower(coalesce(text, ''))")}) AS text_md5 FROM documents WHERE ingested_at IS NOT NULL",
}
