"""Encoding with a byte-level vocabulary file by the tokenizers library, batch by batch.

Vocabularies are public files; none is trained. The library is imported by the tasks, so
everything else works without it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.arrow import map_arrow

DEFAULT_FILE = "/opt/tokenizers/byte_bpe_50k.json"


def _loaded(data: str):  # noqa: ANN202
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(data)
    t.encode_special_tokens = True
    return t


def _shared(df: DataFrame, file: str):  # noqa: ANN202
    with open(file, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encoded(df: DataFrame, key: str, text: str, eos: int | None = None, file: str = DEFAULT_FILE) -> DataFrame:
    """``key`` and ``ids``: each text's token ids and, if given, the end-of-document id."""
    data = _shared(df, file)
    end = [] if eos is None else [eos]

    def make() -> Callable[[pa.RecordBatch], dict]:
        tok = _loaded(data.value)

        def work(batch: pa.RecordBatch) -> dict:
            out = tok.encode_batch_fast([t or "" for t in batch.column(1).to_pylist()], add_special_tokens=False)
            return {"k": batch.column(0), "ids": [e.ids + end for e in out]}

        return work

    kind = df.select(F.col(key)).schema[0].dataType.simpleString()
    return map_arrow(df.select(F.col(key).alias("k"), F.col(text).alias("t")), make, f"k {kind}, ids array<int>").withColumnRenamed("k", key)


def roundtrip(df: DataFrame, key: str, text: str, file: str = DEFAULT_FILE) -> DataFrame:
    """``key`` and ``same``: whether decoding gives the text back."""
    data = _shared(df, file)

    def make() -> Callable[[pa.RecordBatch], dict]:
        tok = _loaded(data.value)

        def work(batch: pa.RecordBatch) -> dict:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            back = tok.decode_batch([e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)], skip_special_tokens=False)
            return {"k": batch.column(0), "same": [a == b for a, b in zip(texts, back)]}

        return work

    kind = df.select(F.col(key)).schema[0].dataType.simpleString()
    return map_arrow(df.select(F.col(key).alias("k"), F.col(text).alias("t")), make, f"k {kind}, same boolean").withColumnRenamed("k", key)


def used_vocabulary(df: DataFrame, text: str, file: str = DEFAULT_FILE) -> DataFrame:
    """``id``, ``token`` and ``n``: the entries of the vocabulary that the corpus uses, with their counts."""
    data = _shared(df, file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, seen = _loaded(data.value), Counter()
        for batch in batches:
            for e in tok.encode_batch_fast([t or "" for t in batch.column(0).to_pylist()], add_special_tokens=False):
                seen.update(e.ids)
        ids = list(seen)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array([tok.id_to_token(i) for i in ids], pa.string()), pa.array([seen[i] for i in ids], pa.int64())], ["id", "token", "n"])

    return df.select(text).mapInArrow(run, "id int, token string, n bigint").groupBy("id", "token").agg(F.sum("n").alias("n"))
