"""The registered queries of the core and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusmill.plans import cleaning, dedup, instruct, metrics, packing, streams

MODULES = (cleaning, dedup, packing, instruct, metrics, streams)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL: dict[str, str] = {k: v for m in MODULES for k, v in m.SQL.items()}
