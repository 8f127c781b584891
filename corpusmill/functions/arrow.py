"""Arrow-batched maps for logic that Spark's built-in expressions cannot state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


#: A function is given at most so many bytes of rows at once, or one row.
SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in order in parts of at most ``most`` bytes; a part of one row may be larger."""
    if batch.num_rows <= 1 or batch.nbytes <= most:
        if batch.num_rows:
            yield batch
        return
    half = batch.num_rows // 2
    yield from slices(batch.slice(0, half), most)
    yield from slices(batch.slice(half), most)


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str) -> DataFrame:
    """Map every Arrow batch of ``df`` with the function that ``make`` returns once a task.

    The function takes a record batch and returns a dict of columns (lists or arrays). It
    gets batches cut by bytes, so a task's memory doesn't follow the length of its texts.
    """

    parsed = _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    target = to_arrow_schema(parsed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch):
                out = work(part)
                arrays = [v if isinstance(v := out[f.name], pa.Array) else pa.array(v, f.type) for f in target]
                yield pa.RecordBatch.from_arrays([a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, target)], schema=target)

    return df.mapInArrow(run, schema)
