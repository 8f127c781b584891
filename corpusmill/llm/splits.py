"""Problem 5: the same or nearly the same records across splits.

An exact prefix-filter join: every text is a set of word shingles in one global order from
rare to common. Two sets of Jaccard similarity t or more must share a shingle among their
first ``n - ceil(t n) + 1``, and one more of them for
every further shingle of the prefix; the prefixes are taken three longer, joined,
evaluation against training, and pairs with fewer than four shared shingles dropped.
Length and position filters drop what can't reach t, and the survivors are aligned word
by word, passage against passage and question against question.

The order needs only to be the same everywhere: rarity is read from a table of hashed
counts of fixed size, filled from all evaluation texts; a training shingle whose place in
it is empty stands in none of them and isn't joined. Copies are joined once, as a class,
and expanded at the end.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.arrow import map_arrow
from corpusmill.session import checkpointed

SHINGLE = 3
SIMILARITY = 0.65
SHARED = 4
#: Sets of ids are broadcast up to so many, some 16 MB.
BROADCAST_IDS = 1_000_000
COUNT_BITS = 21
BLOCK = 1 << 14
WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
MIX = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Hashes of a text's distinct word shingles; words met are remembered."""

    def __init__(self, size: int = SHINGLE) -> None:
        self.size, self.words = size, {}

    def of(self, text: str) -> np.ndarray:
        known = self.words
        if len(known) > 500_000:
            known.clear()
        ids = []
        for w in WORD.findall(text.lower()):
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            ids.append(h)
        if not ids:
            return np.empty(0, np.uint64)
        a = np.array(ids, np.uint64)
        k = min(self.size, len(a))
        h = a[: len(a) - k + 1].copy()
        for i in range(1, k):
            h = (h ^ (h >> np.uint64(31))) * MIX + a[i : len(a) - k + 1 + i]
        h ^= h >> np.uint64(33)
        return np.unique(h)


def hashed_counts(texts: DataFrame, column: str) -> np.ndarray:
    """How many texts hold shingles of each hash class: 2**COUNT_BITS counts, from all rows of ``texts``.

    Each task fills its own table and ships it in blocks, which are added up before the
    driver gets the one table, whose size is fixed.
    """
    slots = 1 << COUNT_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, shingler = np.zeros(slots, np.int64), Shingler()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                table[(shingler.of(text) & np.uint64(slots - 1)).astype(np.int64)] += 1
        used = np.flatnonzero(table.reshape(-1, BLOCK).any(axis=1))
        data = [table[b * BLOCK : (b + 1) * BLOCK].tobytes() for b in used]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(data, pa.binary())], ["block", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(data, np.int64)
                sums[b] = sums[b] + part if b in sums else part
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["block", "data"])

    parts = texts.select(column).mapInArrow(count, "block int, data binary")
    whole = parts.repartition(16, "block").mapInArrow(add, "block int, data binary")
    out = np.zeros(slots, np.int64)
    for r in whole.collect():  # slots / BLOCK rows, whatever the corpus
        out[r.block * BLOCK : (r.block + 1) * BLOCK] += np.frombuffer(r.data, np.int64)
    return out


def prefixes(texts: DataFrame, counts: np.ndarray, similarity: float) -> DataFrame:
    """``id``, ``held``, ``n``, ``pos`` and shingle ``h`` of every text's prefix, rare first."""
    shared = texts.sparkSession.sparkContext.broadcast(counts.astype(np.int32) if counts.max(initial=0) < 1 << 31 else counts)

    def make() -> Callable[[pa.RecordBatch], dict]:
        shingler = Shingler()
        mask = np.uint64((1 << COUNT_BITS) - 1)

        def work(batch: pa.RecordBatch) -> dict:
            ids, held, sizes, places, hashes = [], [], [], [], []
            for i, t, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                h = shingler.of(t)
                n = len(h)
                if not n:
                    continue
                first = min(n, n - int(np.ceil(similarity * n - 1e-9)) + SHARED)
                often = shared.value[(h & mask).astype(np.int64)]
                order = np.argsort(often, kind="stable")[:first]  # of sorted hashes: ties in the order of hashes
                used = np.flatnonzero(often[order])
                hashes.append(h[order[used]].view(np.int64))
                ids.append(np.full(len(used), i, np.int64))
                held.append(np.full(len(used), s, bool))
                sizes.append(np.full(len(used), n, np.int32))
                places.append(used.astype(np.int32))
            cat = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
            return {"id": pa.array(cat(ids, np.int64)), "held": pa.array(cat(held, bool)), "n": pa.array(cat(sizes, np.int32)), "pos": pa.array(cat(places, np.int32)), "h": pa.array(cat(hashes, np.int64))}

        return work

    return map_arrow(texts.select("id", "text", "held"), make, "id bigint, held boolean, n int, pos int, h bigint")


def candidates(texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs (``a`` of training, ``b`` held out) that the prefix, length and position filters leave."""
    counts = hashed_counts(texts.filter("held"), "text")
    rows = prefixes(texts, counts, similarity)
    left = rows.filter("not held").select("h", F.col("id").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"))
    right = rows.filter("held").select("h", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"))
    least = F.ceil((F.col("na") + F.col("nb")) * (similarity / (1 + similarity)) - 1e-6)
    lengths = (F.col("na") >= F.col("nb") * similarity - 1e-6) & (F.col("nb") >= F.col("na") * similarity - 1e-6)
    before, after = F.least("pa", "pb"), F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    met = left.join(right, "h").filter(lengths & (before + after >= least))
    return met.groupBy("a", "b").agg(F.count("*").alias("shared"), F.max(least).alias("least")).filter(F.col("shared") >= F.least("least", F.lit(SHARED))).select("a", "b")


def close(a: str, b: str) -> bool:
    """Whether two words are one but for a typing error."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 2 or min(len(a), len(b)) < 2:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or len(x) > 1 and len(y) > 1 and x[0] == y[1] and x[1] == y[0] and x[2:] == y[2:]


def agree(a: list[str], b: list[str], share: float = 0.15) -> bool:
    """Whether two word lists are the same but for words round them, typing errors and a few changed or lost words."""
    if a == b:
        return True
    if not a or not b:
        return False
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    x, y = a[lo : len(a) - hi], b[lo : len(b) - hi]
    changed, around = 0, 0
    for tag, i, j, k, m in SequenceMatcher(None, x, y, autojunk=False).get_opcodes():
        if tag == "equal":
            continue
        p, q = x[i:j], y[k:m]
        if tag == "replace":
            if "".join(p) == "".join(q) or close("".join(p), "".join(q)):
                continue
            if len(p) == len(q):
                wrong = sum(not close(u, v) for u, v in zip(p, q))
            else:
                wrong = max(len(p), len(q)) - sum(any(close(u, v) for v in q) for u in p)
            if wrong >= 3 and min(len(p), len(q)) >= 2:
                return False
            changed += wrong
        elif lo + i == 0 or j == len(x) and not hi:
            around += len(p) + len(q)
        else:
            if len(p) + len(q) > 3 + len(a) // 20:
                return False
            changed += len(p) + len(q)
    size = min(len(a), len(b))
    return changed <= max(1, share * size) and around <= max(4, 0.25 * size)


def parts(user: str) -> tuple[list[str], list[str]]:
    """The words of the passage and of the question; the question follows the last blank line."""
    pieces = [WORD.findall(p.lower()) for p in re.split(r"\n\s*\n", user.strip())]
    pieces = [p for p in pieces if p]
    if not pieces:
        return [], []
    passage = [w for p in pieces[:-1] for w in p]
    while passage and passage[0] in ("context", "passage", "text", "document"):
        passage = passage[1:]
    return passage, pieces[-1]


def of_ids(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``rows`` with ('left_semi') or without ('left_anti') the ids; these are broadcast up to a checked number."""
    ids = checkpointed(ids)
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", how)


def overlaps(rows: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``row_a``, ``row_b`` of every overlap of a training and a held-out row.

    ``rows`` has row_id, split and user. Rows with a null split, a null text or no word
    are never part of an overlap; 'train' is the training split, every other one is held
    out. Equal texts form a class that is joined once; the rows of matched classes are paired at the end, since the result
    is one of pairs.
    """
    usable = rows.filter("split is not null and user is not null").select(F.col("row_id").alias("id"), F.col("split"), (F.col("split") != "train").alias("held"), F.col("user").alias("text"))
    keyed = usable.withColumn("cls", F.md5("text"))
    members = checkpointed(keyed.select("id", "held", F.unhex("cls").alias("cls")))
    heads = members.groupBy("held", "cls").agg(F.min("id").alias("head"))
    of = checkpointed(members.join(heads, ["held", "cls"]).select("id", "head"))
    texts = of_ids(usable.select("id", "held", "text"), of.filter("id <> head").select("id"), "left_anti")
    pairs = checkpointed(candidates(texts, similarity))
    needed = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = of_ids(usable.select("id", "text"), needed, "left_semi")
    both = pairs.join(wanted.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(wanted.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            keep = []
            for ta, tb in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                (pa_, qa), (pb_, qb) = parts(ta), parts(tb)
                keep.append(agree(qa, qb) and agree(pa_, pb_))
            mask = pa.array(keep, pa.bool_())
            return {"a": batch.column(0).filter(mask), "b": batch.column(1).filter(mask)}

        return work

    same = map_arrow(both.select("a", "b", "ta", "tb"), make, "a bigint, b bigint")
    wide = same.join(of.select(F.col("head").alias("a"), F.col("id").alias("ida")), "a").join(of.select(F.col("head").alias("b"), F.col("id").alias("idb")), "b")
    return wide.select(F.least("ida", "idb").alias("row_a"), F.greatest("ida", "idb").alias("row_b")).distinct()


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusmill.llm.pairs import chat_turns

    return overlaps(chat_turns(spark, sf_dir))


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping held-out rows per split and source of the held-out row."""
    from corpusmill.llm.pairs import chat_turns
    from corpusmill.sources.tables import table

    found = overlaps(chat_turns(spark, sf_dir))
    rows = table(spark, sf_dir, "chat_rows", "row_id", "split", F.col("meta.source").alias("source")).filter("split <> 'train'")
    ids = found.select(F.explode(F.array("row_a", "row_b")).alias("row_id")).groupBy("row_id").agg(F.count("*").alias("n"))
    return rows.join(ids, "row_id", "left").groupBy("split", "source").agg(F.count("*").alias("n_rows"), F.count("n").alias("n_overlapping"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"))
