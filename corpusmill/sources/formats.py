"""Files between stages: one document a line, JSON lines, and packed windows as bytes."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusmill.functions import text as T
from corpusmill.functions.arrow import map_arrow


def write_corpus_lines(df: DataFrame, text: str, path: str, *partitions: str) -> None:
    """One document a line, white space collapsed; documents that are blank are left out."""
    lines = df.select(*partitions, T.collapsed(T.text_or_empty(F.col(text))).alias("value")).filter("value <> ''")
    lines.write.partitionBy(*partitions).text(path) if partitions else lines.write.text(path)


def read_corpus_lines(spark: SparkSession, path: str) -> DataFrame:
    """``text`` and ``file`` of every line that isn't blank."""
    return spark.read.text(path).select(F.col("value").alias("text"), F.input_file_name().alias("file")).filter(F.trim("text") != "")


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines; rows of differing keys are merged, missing ones null."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report of few rows as one file of JSON lines, in place of an earlier one."""
    df.coalesce(1).write.mode("overwrite").json(path)


def append_metrics(df: DataFrame, path: str) -> None:
    """Metric rows added to a folder of JSON lines; rows may have keys of their own, nulls aren't written."""
    write_json_lines(df, path, "append")


def write_signatures(df: DataFrame, shard: str, path: str) -> None:
    """MinHash signatures as parquet, a folder a shard; shards written again replace only themselves."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(shard).parquet(path)


def read_signatures(spark: SparkSession, path: str) -> DataFrame:
    """Signatures written before; a filter on their shard reads only its folder."""
    return spark.read.parquet(path)


def windows_to_bytes(df: DataFrame, keys: list[str], ids: str, width: int = 2) -> DataFrame:
    """``keys`` and ``data``: each window's ids as little-endian unsigned numbers of ``width`` bytes."""
    picked = df.select(*keys, F.col(ids).alias("_ids"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])

    def make() -> Callable[[pa.RecordBatch], dict]:
        kind = np.dtype(f"<u{width}")
        return lambda batch: {k: batch.column(i) for i, k in enumerate(keys)} | {"data": [None if x is None else np.array(x, kind).tobytes() for x in batch.column(len(keys)).to_pylist()]}

    return map_arrow(picked, make, f"{kinds}, data binary")


def bytes_to_windows(df: DataFrame, keys: list[str], data: str, width: int = 2) -> DataFrame:
    """The inverse of ``windows_to_bytes``: ``keys`` and ``ids``."""
    picked = df.select(*keys, F.col(data).alias("_data"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])

    def make() -> Callable[[pa.RecordBatch], dict]:
        kind = np.dtype(f"<u{width}")
        return lambda batch: {k: batch.column(i) for i, k in enumerate(keys)} | {"ids": [None if x is None else np.frombuffer(x, kind).tolist() for x in batch.column(len(keys)).to_pylist()]}

    return map_arrow(picked, make, f"{kinds}, ids array<int>")
