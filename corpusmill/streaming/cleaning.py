"""The cleaning chain over a growing folder, and copies dropped as they arrive."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import cleaning as C
from corpusmill.session import shared_folder


def folder_of(spark: SparkSession) -> str:
    """A fresh folder in the cluster's shared one."""
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def clean_stream(rows: DataFrame, key: str, text: str) -> DataFrame:
    """The stateless gates of the chain; works on streams and tables alike."""
    return C.clean(rows, key, text)


def first_seen(rows: DataFrame, text: str, time: str, delay: str) -> DataFrame:
    """Rows whose normalized text wasn't seen within ``delay`` of event time; state is dropped with the watermark."""
    keyed = rows.withColumn("_h", F.md5(T.normalized(F.col(text))))
    return keyed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["_h"]).drop("_h")


def drained(stream: DataFrame, spark: SparkSession) -> DataFrame:
    """Run a stream over what is there now into a shared folder and read the result."""
    out = folder_of(spark)
    stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/state").option("path", f"{out}/rows").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def parquet_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream over the files of a parquet table, a folder or a single file."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    whole = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return reader.parquet(path) if whole else reader.option("pathGlobFilter", where.getName()).parquet(str(where.getParent().toString()))
