"""Sources of many parquet files: the shards of a configuration and split, each row with its place in its shard."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shard_files(spark: SparkSession, root: str, config: str | None = None, split: str = "train") -> list[str]:
    """The parquet files below ``root`` that hold the split of a configuration, in order of name.

    A file belongs to a split if a folder on its way, or the part of its name before the
    first '-' or '.', is the split's name; to a configuration if a folder on its way has its
    name. Without ``config`` all configurations count. Only names are listed, by the
    file system of the folder's scheme.
    """
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(root)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(at, True)
    base, out = None, []
    while files.hasNext():
        path = files.next().getPath().toString()
        if base is None:
            base = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/")
        if not path.endswith(".parquet"):
            continue
        *folders, name = path[len(base) :].strip("/").split("/")
        if config is not None and config not in folders:
            continue
        if split in folders or re.split(r"[-.]", name)[0] == split:
            out.append(path)
    return sorted(out)


def read_shards(spark: SparkSession, files: list[str], *columns: str, first: int | None = None) -> DataFrame:
    """``columns``, ``shard`` and ``idx`` (from 0) of the rows of parquet files; ``first`` keeps that many files.

    ``shard`` is the file's name without its ending, ``idx`` the row's place in the file,
    so neither depends on how the scan is cut. No files give an error.
    """
    picked = files if first is None else files[:first]
    if not picked:
        raise ValueError("no file holds this configuration and split")
    rows = spark.read.parquet(*picked)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[a-z]+)*$", 1)
    own = [F.col(c) for c in columns] if columns else [F.col(c) for c in rows.columns if c not in ("shard", "idx")]
    return rows.select(*own, name.alias("shard"), F.col("_metadata.row_index").alias("idx"))
