"""Problem 8: encode a whole corpus with a public byte-level BPE vocabulary.

Each pre-token is merged over a contiguous rank array: the boundaries of its parts and the
ranks of adjacent pairs lie side by side in two flat lists, the smallest rank is found by
scanning, its right boundary is deleted and the two neighbouring ranks are refreshed. Words
too long for scanning go through a heap over the same boundaries, so a text of one
unbroken run stays at n log n.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.arrow import map_arrow
from corpusmill.sources.tables import table

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the vocabulary's published pre-token pattern.
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NO_RANK = 1 << 30
SCAN_LIMIT = 96
CACHE_WORDS = 400_000


def load_ranks(data: bytes) -> dict[bytes, int]:
    """The merge ranks of a tiktoken file: token bytes to rank, the rank being the id."""
    ranks = {}
    for line in data.splitlines():
        if line:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return ranks


def merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of a short word by scanning a contiguous array of adjacent ranks."""
    n = len(word)
    if n == 1:
        return [ranks[word]]
    find = ranks.get
    starts = list(range(n + 1))
    pair = [find(word[i : i + 2], NO_RANK) for i in range(n - 1)]
    while pair:
        best = min(pair)
        if best == NO_RANK:
            break
        i = pair.index(best)
        del starts[i + 1]
        del pair[i]
        if i < len(pair):
            pair[i] = find(word[starts[i] : starts[i + 2]], NO_RANK)
        if i:
            pair[i - 1] = find(word[starts[i - 1] : starts[i + 1]], NO_RANK)
    return [ranks[word[a:b]] for a, b in zip(starts, starts[1:])]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for long words: a heap of (rank, start) over linked boundaries."""
    n = len(word)
    find = ranks.get
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := find(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, middle, end = heapq.heappop(heap)
        if not alive[i] or after[i] != middle or middle >= n or not alive[middle] or after[middle] != end:
            continue
        alive[middle] = False
        after[i] = end
        if end < n:
            before[end] = i
            if (r := find(word[i : after[end]])) is not None:
                heapq.heappush(heap, (r, i, end, after[end]))
        if i and (p := before[i]) >= 0 and (r := find(word[p:end])) is not None:
            heapq.heappush(heap, (r, p, i, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : after[i]]])
        i = after[i]
    return out


def encoder(data: bytes, pattern: str = PRETOKEN) -> Callable[[str], list[int]]:
    """A function from text to ids, with a bounded memory of words met before."""
    ranks = load_ranks(data)
    words = regex.compile(pattern).findall
    memory: dict[str, list[int]] = {}

    class Words(dict):
        def __missing__(self, word: str) -> list[int]:
            raw = word.encode("utf-8", "surrogatepass")
            whole = ranks.get(raw)
            ids = [whole] if whole is not None else merge_short(raw, ranks) if len(raw) <= SCAN_LIMIT else merge_long(raw, ranks)
            if len(self) < CACHE_WORDS and len(raw) <= SCAN_LIMIT:
                self[word] = ids
            return ids

    memory = Words()

    def encode(text: str) -> list[int]:
        out: list[int] = []
        extend = out.extend
        for word in words(text):
            extend(memory[word])
        return out

    return encode


def encode_column(df: DataFrame, key: str, text: str, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``key`` and ``ids array<int>`` of every row; null and empty texts give an empty list.

    Whole texts are encoded in place, one narrow stage without a shuffle. Other columns of
    the input, whatever their names, are not read. Repeated rows come out repeated. The
    vocabulary (under 1 MB, a fixed file) is read on the driver and broadcast.
    """
    with open(vocabulary, "rb") as file:
        data = df.sparkSession.sparkContext.broadcast(file.read())

    def make() -> Callable[[pa.RecordBatch], dict]:
        encode = encoder(data.value)

        def work(batch: pa.RecordBatch) -> dict:
            offsets, parts = [0], []
            for text in batch.column(1).to_pylist():
                ids = np.array(encode(text) if text else [], np.int32)
                parts.append(ids)
                offsets.append(offsets[-1] + len(ids))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(parts)))
            return {"k": batch.column(0), "ids": ids}

        return work

    kind = df.select(F.col(key)).schema[0].dataType.simpleString()
    return map_arrow(df.select(F.col(key).alias("k"), F.col(text).alias("t")), make, f"k {kind}, ids array<int>").withColumnRenamed("k", key)


def token_counts(df: DataFrame, keys: list[str], text: str, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``keys`` and ``n_tokens int`` of every row, without shipping the ids through Spark."""
    with open(vocabulary, "rb") as file:
        data = df.sparkSession.sparkContext.broadcast(file.read())
    picked = df.select(*keys, F.col(text).alias("_text"))

    def make() -> Callable[[pa.RecordBatch], dict]:
        encode = encoder(data.value)

        def work(batch: pa.RecordBatch) -> dict:
            out = {k: batch.column(i) for i, k in enumerate(keys)}
            return out | {"n_tokens": [len(encode(t)) if t else 0 for t in batch.column(len(keys)).to_pylist()]}

        return work

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return map_arrow(picked, make, f"{kinds}, n_tokens int")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_column(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")
