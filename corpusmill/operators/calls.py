"""Calls of a model that the caller injects: retries with growing pauses, several replies a row."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.arrow import slices


class Fatal(Exception):
    """What a model raises where trying again is useless, as for a used-up quota; it ends the job."""


def tried(call: Callable[[str, int], str], prompt: str, copy: int, tries: int, first_pause: float, longest_pause: float) -> tuple[str | None, int, str | None]:
    """(reply, tries taken, error) of one call; pauses double from the first to the longest, with jitter."""
    pause = first_pause
    for n in range(1, tries + 1):
        try:
            return call(prompt, copy), n, None
        except Fatal:
            raise
        except Exception as e:  # noqa: BLE001
            if n == tries:
                return None, n, f"{type(e).__name__}: {e}"[:200]
            time.sleep(pause * (0.5 + random.random() / 2))
            pause = min(longest_pause, 2 * pause)
    raise ValueError("tries must be 1 or more")


def replies(
    df: DataFrame, key: str, prompt: str, model: Callable[[], Callable[[str, int], str]], copies: int = 1, tries: int = 8, first_pause: float = 2.0, longest_pause: float = 60.0, threads: int = 6
) -> DataFrame:
    """``key``, ``copy``, ``reply``, ``tries`` and ``error``: ``copies`` replies of a model to each prompt.

    ``model`` is called once a task and gives the function of prompt and copy number. Each
    task keeps ``threads`` calls under way. A row whose calls all fail has a null reply and
    the last error; ``Fatal`` ends the job. A null prompt isn't sent: reply and error are null, with 0 tries.
    Repeated rows are sent again each.
    """
    kind = df.select(F.col(key)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = model()
        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                for part in slices(batch):
                    jobs = [(i, c, p) for i, p in enumerate(part.column(1).to_pylist()) for c in range(copies)]
                    one = lambda j: (None, 0, None) if j[2] is None else tried(call, j[2], j[1], tries, first_pause, longest_pause)
                    got = list(pool.map(one, jobs))
                    keys = part.column(0).take(pa.array([i for i, _, _ in jobs], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [keys, pa.array([c for _, c, _ in jobs], pa.int32()), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.int32()), pa.array([g[2] for g in got], pa.string())],
                        ["k", "copy", "reply", "tries", "error"],
                    )

    out = df.select(F.col(key).alias("k"), F.col(prompt).cast("string").alias("p")).mapInArrow(run, f"k {kind}, copy int, reply string, tries int, error string")
    return out.withColumnRenamed("k", key)
