"""Problem 2: lines that one source repeats through its documents.

Each wording's documents are kept as compressed bitmaps, cut into containers of 65,536
positions: a sorted array of 16-bit positions while sparse, a bit set once dense. Variants
of a wording (one word lost or changed) meet in the ties that remain when a word is left
out; their bitmaps are united, and exact cardinalities decide. Lines are then deleted by
looking their wording up.

Before bitmaps are built, a count keeps only wordings that can qualify: a single changed
word leaves the first or the last half of a wording whole, so one of the two must stand
in half the documents the threshold asks for, in lines or pairs of lines.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

from corpusmill.functions.arrow import map_arrow, slices
from corpusmill.session import checkpointed
from corpusmill.sources.tables import table

MIN_DOCS = 5
MIN_SHARE = 0.4
VARIANT_WORDS = 4
ORDINAL_BUCKETS = 64
DENSE = 4096
#: Bits of the filter for each of its keys, and the least and most of all, as powers of two; the most takes 32 MB.
FILTER_BITS, FILTER_LEAST, FILTER_MOST = 16, 16, 28
#: Odd factors that spread a key's places in the filter.
PROBES = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))

# Month names and their short forms, which stand in filled-in dates.
MONTHS = "january february march april may june july august september october november december jan feb mar apr jun jul aug sep sept oct nov dec"


MONTH_SET = frozenset(MONTHS.split())
WORD = re.compile(r"[^\W_]+")
HASH = xxhash.xxh3_64_intdigest


def wording(line: str) -> list[str]:
    """A line's words, lower case, without marks, numbers and the names of months."""
    return [w for w in WORD.findall(line) if w.isalpha() and w not in MONTH_SET]


def halves(seed: int, words: list[str]) -> list[int]:
    """Keys of the beginnings and ends that a wording shares, with its source, with every wording of which one word is lost or changed.

    Two such wordings of which the longer has n words agree in the first or the last n // 2
    words. A wording may be the longer or the shorter one, so it has two lengths if its
    size is odd; under VARIANT_WORDS only the second can differ in a word. ``seed`` tells the source.
    """
    n = (len(words) + 1) // 2
    out = [HASH(" ".join(words[:n]), seed), HASH(" ".join(words[-n:]), seed + 1)]
    if len(words) & 1 and len(words) >= VARIANT_WORDS:
        n -= 1
        out += [HASH(" ".join(words[:n]), seed), HASH(" ".join(words[-n:]), seed + 1)]
    return out


def units(text: str, host: str) -> Iterator[tuple[int, list[str], int, list[int]]]:
    """(line number, words, words of the second line, halves) of every line and every two neighbouring lines that aren't blank."""
    before: list[str] = []
    seed = HASH(host) >> 1
    for n, line in enumerate(text.lower().split("\n")):
        words = wording(line)
        if words:
            if before:
                both = before + words
                yield n - 1, both, len(words), halves(seed, both)
            yield n, words, 0, halves(seed, words)
        before = words


def half_counts(docs: DataFrame) -> DataFrame:
    """``host``, ``half`` and ``n``: the documents that hold each half in a line or two.

    Documents are added up within a batch, so a half of a large source is few rows.
    """

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            seen: dict[str, Counter[int]] = {}
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own: set[int] = set()
                for _, _, _, keys in units(text, host):
                    own.update(keys)
                seen.setdefault(host, Counter()).update(own)
            half = np.fromiter((k for c in seen.values() for k in c), np.uint64, sum(map(len, seen.values()))).view(np.int64)
            return {"host": [h for h, c in seen.items() for _ in c], "half": pa.array(half), "n": pa.array([n for c in seen.values() for n in c.values()], pa.int64())}

        return work

    return map_arrow(docs.select("host", "text"), make, "host string, half bigint, n bigint")


def slots(half: np.ndarray, bits: int) -> np.ndarray:
    """The places of each half in a filter of 2**bits bits, a row a probe."""
    h = half.view(np.uint64)
    return np.stack([(h * m >> np.uint64(64 - bits)).astype(np.int64) for m in PROBES])


def half_filter(usual: DataFrame) -> np.ndarray:
    """A bit set with the places of the ``half`` column: FILTER_BITS bits a row, 32 MB at the most.

    It only spares work: what passes it by chance is counted exactly later on. Its parts
    are made as containers in the tasks, and the driver gets these.
    """
    usual = checkpointed(usual)
    bits = min(FILTER_MOST, max(FILTER_LEAST, (FILTER_BITS * usual.count()).bit_length()))

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            at = np.unique(slots(batch.column(0).to_numpy(), bits))
            return {"key": np.zeros(len(at), np.int64), "chunk": (at >> 16).astype(np.int32), "low": (at & 65535).astype(np.int32)}

        return work

    places = map_arrow(usual.select("half"), make, "key bigint, chunk int, low int")
    out = np.zeros(1 << bits, bool)
    for r in bitmaps(places).select("chunk", "bitmap").toLocalIterator():
        out[(r.chunk << 16) + unpack(bytes(r.bitmap))] = True
    return np.packbits(out, bitorder="little")


def line_units(docs: DataFrame, usual: np.ndarray) -> DataFrame:
    """The wordings of lines and of pairs of neighbouring lines of which a half is in the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(usual)
    bits = (len(usual) * 8).bit_length() - 1
    kind = docs.schema["id"].dataType.simpleString()

    def make() -> Callable[[pa.RecordBatch], dict]:
        table_ = shared.value

        def work(batch: pa.RecordBatch) -> dict:
            rows, half, of = [], [], []
            for i, host, text in zip(*(batch.column(c).to_pylist() for c in range(3))):
                for n, words, second, keys in units(text, host):
                    half += keys
                    of += [len(rows)] * len(keys)
                    rows.append((i, host, n, words, second))
            at = slots(np.array(half, np.uint64), bits)
            hit = np.unique(np.array(of, np.int64)[(table_[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=0)]).tolist()
            kept = [rows[k] for k in hit]
            return {
                "id": [r[0] for r in kept], "host": [r[1] for r in kept], "line_no": [r[2] for r in kept], "lines": [1 + (r[4] > 0) for r in kept], "w": [" ".join(r[3]) for r in kept],
            }

        return work

    return map_arrow(docs.select("id", "host", "text"), make, f"id {kind}, host string, line_no int, lines int, w string")


def pack(places: np.ndarray) -> bytes:
    """A container's bytes: b'a' and sorted 16-bit positions, or b'b' and a bit set."""
    places = np.unique(places)
    if len(places) <= DENSE:
        return b"a" + places.astype("<u2").tobytes()
    bits = np.zeros(65536, bool)
    bits[places] = True
    return b"b" + np.packbits(bits, bitorder="little").tobytes()


def pack_list(places: list[int]) -> bytes:
    return pack(np.array(places, np.int64))


def unpack(data: bytes) -> np.ndarray:
    """The sorted positions of a container."""
    if data[:1] == b"a":
        return np.frombuffer(data, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=1), bitorder="little"))


def unite(parts: list[bytes]) -> bytes:
    """The union of containers; dense ones are joined bit by bit."""
    if len(parts) == 1:
        return parts[0]
    if sum(len(p) for p in parts) <= 4 * DENSE:
        return pack(np.concatenate([unpack(p) for p in parts]))
    bits = np.zeros(65536, bool)
    for p in parts:
        bits[unpack(p)] = True
    return pack(np.flatnonzero(bits))


def cardinality(data: bytes) -> int:
    return (len(data) - 1) // 2 if data[:1] == b"a" else int(np.unpackbits(np.frombuffer(data, np.uint8, offset=1)).sum())


def _grouped(df: DataFrame, merge: Callable[[list], bytes], value: str, most: int) -> DataFrame:
    """Merge ``value`` of the rows of each (key, chunk), which come sorted and are merged one group at a time.

    A group of more than ``most`` rows is merged in parts, so none is held whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        parts: list = []
        done: list[bytes] = []

        def closed() -> bytes:
            whole = [*done, merge(parts)] if parts else done
            return whole[0] if len(whole) == 1 else unite(whole)

        for batch in (x for b in batches for x in slices(b)):
            out: list[tuple[tuple, bytes]] = []
            for k, c, v in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (k, c) != at:
                    if at is not None:
                        out.append((at, closed()))
                    at, parts, done = (k, c), [], []
                elif len(parts) >= most:
                    done = [unite([*done, merge(parts)])]
                    parts = []
                parts.append(v)
            yield rows_of(out)
        if at is not None:
            yield rows_of([(at, closed())])

    def rows_of(out: list[tuple[tuple, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([g[0] for g, _ in out], pa.int64()), pa.array([g[1] for g, _ in out], pa.int32()), pa.array([v for _, v in out], pa.binary())], ["key", "chunk", "bitmap"])

    ordered = df.select("key", "chunk", value).repartition("key", "chunk").sortWithinPartitions("key", "chunk")
    return ordered.mapInArrow(run, "key bigint, chunk int, bitmap binary")


def bitmaps(places: DataFrame) -> DataFrame:
    """(key, chunk, low) rows to one container each (key, chunk)."""
    return _grouped(places, pack_list, "low", 100_000)


def united(parts: DataFrame) -> DataFrame:
    """(key, chunk, bitmap) rows to the union of each (key, chunk)."""
    return _grouped(parts, unite, "bitmap", 500)


def cardinalities(maps: DataFrame) -> DataFrame:
    """The exact number of documents in each key's bitmap."""
    count = lambda batches: (
        pa.RecordBatch.from_arrays([b.column(0), pa.array([cardinality(x) for x in b.column(1).to_pylist()], pa.int64())], ["key", "n"]) for x in batches for b in slices(x)
    )
    return maps.select("key", "bitmap").mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def ordinals(docs: DataFrame) -> DataFrame:
    """Dense numbers of each host's documents, from 0: ``id``, ``host``, ``chunk`` and ``low``.

    Hosts are numbered in hash buckets with offsets, so that no host is sorted in one task.
    """
    b = docs.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(ORDINAL_BUCKETS)).cast("int"))
    sizes = b.groupBy("host", "b").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("host").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("host", "b", before.alias("before"))
    numbered = b.select("id", "host", "b", (F.row_number().over(Window.partitionBy("host", "b").orderBy("id")) - 1).alias("at")).join(offsets, ["host", "b"])
    place = F.col("at") + F.col("before")
    return numbered.select("id", "host", F.shiftright(place, 16).cast("int").alias("chunk"), place.bitwiseAND(65535).cast("int").alias("low"))


def variants(vocabulary: DataFrame) -> DataFrame:
    """``key`` and ``tie``: what is left of each wording without one of its words, and the whole.

    Wordings of one host that differ by one word lost or changed share a tie. The ties are
    sums of word hashes weighted by place, so all of a wording's take linear time.
    """

    def make() -> Callable[[pa.RecordBatch], dict]:
        known: dict[str, int] = {}
        base = np.uint64(0x9E3779B97F4A7C15)

        def work(batch: pa.RecordBatch) -> dict:
            keys, ties = [], []
            for k, host, w in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = w.split(" ")
                for x in words:
                    if x not in known:
                        if len(known) > 300_000:
                            known.clear()
                        known[x] = xxhash.xxh3_64_intdigest(x)
                h = np.array([known[x] if x in known else xxhash.xxh3_64_intdigest(x) for x in words], np.uint64)
                power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(h), base, np.uint64)]), dtype=np.uint64)
                own = np.uint64(xxhash.xxh3_64_intdigest(host))
                at = np.concatenate([[np.uint64(0)], np.cumsum(h * power[:-1], dtype=np.uint64)])
                whole = at[-1:] ^ own
                if len(words) >= VARIANT_WORDS:
                    moved = np.concatenate([[np.uint64(0)], np.cumsum(h[1:] * power[:-2], dtype=np.uint64)])
                    whole = np.unique(np.concatenate([whole, (at[:-1] + moved[-1] - moved) ^ own]))
                ties.append(whole.view(np.int64))
                keys.append(np.full(len(whole), k, np.int64))
            return {"key": pa.array(np.concatenate(keys)), "tie": pa.array(np.concatenate(ties))}

        return work

    return map_arrow(vocabulary.select("key", "host", "w"), make, "key bigint, tie bigint")


def reaching(vocabulary: DataFrame, ties: DataFrame, maps: DataFrame) -> DataFrame:
    """``key`` of the wordings whose documents, with those of the wordings they share a tie with, are ``need`` or more.

    ``vocabulary`` has key, own and need, ``ties`` only those several wordings share. Ties
    are united once each. A tie that alone has enough documents decides, and so does too
    small a sum over a wording's ties; only wordings between the two have their ties
    united, once for all that have the same ties.
    """
    by_tie = checkpointed(united(ties.join(maps, "key").select(F.col("tie").alias("key"), "chunk", "bitmap")).withColumnRenamed("key", "tie"))
    sizes = cardinalities(by_tie.withColumnRenamed("tie", "key")).withColumnRenamed("key", "tie")
    about = ties.join(sizes, "tie").groupBy("key").agg(F.max("n").alias("most"), F.sum("n").alias("sum"), F.count("*").alias("k"))
    judged = checkpointed(vocabulary.join(about.withColumnRenamed("key", "of"), F.col("key") == F.col("of"), "left").select("key", "own", "need", "most", "sum", "k"))
    sure = judged.filter(F.greatest("own", "most") >= F.col("need"))
    between = judged.filter((F.coalesce(F.greatest("own", "most"), "own") < F.col("need")) & (F.col("sum") - (F.col("k") - 1) * F.col("own") >= F.col("need")))
    sets = checkpointed(ties.join(between, "key").groupBy("key", "need").agg(F.sort_array(F.collect_set("tie")).alias("ties")).withColumn("set", F.xxhash64("ties")))
    once = sets.groupBy("set").agg(F.first("ties").alias("ties")).select("set", F.explode("ties").alias("tie"))
    both = cardinalities(united(once.join(by_tie, "tie").select(F.col("set").alias("key"), "chunk", "bitmap"))).withColumnRenamed("key", "set")
    return sure.select("key").unionByName(sets.join(both, "set").filter(F.col("n") >= F.col("need")).select("key"))


def without_companions(rows: DataFrame, standing: DataFrame) -> DataFrame:
    """``rows`` without the pairs that hold a line whose wording is among ``standing``, unless the pair's own is too.

    Such a pair is a standing line and whatever stands beside it.
    """
    firm = rows.filter("lines = 1").join(standing, "key", "left_semi").select("id", "line_no")
    beside = firm.unionByName(firm.select("id", (F.col("line_no") - 1).alias("line_no"))).distinct()
    pairs = rows.filter("lines = 2")
    broken = pairs.join(standing, "key", "left_anti").join(beside, ["id", "line_no"], "left_anti").select(*rows.columns)
    return rows.filter("lines = 1").unionByName(pairs.join(standing, "key", "left_semi").select(*rows.columns)).unionByName(broken)


def standing_lines(df: DataFrame, key: str, host: str, text: str, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """``key`` and ``line_no`` of every line with wording of at least ``min_docs`` and ``min_share`` of its host's documents.

    Wording is compared without case, spacing, marks, numbers and dates, and with one word
    lost or changed where it has VARIANT_WORDS or more; a wording broken over two lines
    counts and both lines are named. Documents with a null text don't count; those of a
    null host have no host and no such lines. Blank lines and lines without words never
    qualify. Rows repeated under one key count once.
    """
    docs = df.select(F.col(key).alias("id"), F.col(host).alias("host"), F.col(text).alias("text")).filter("text is not null and host is not null")
    sizes = docs.select("id", "host").distinct().groupBy("host").agg(F.count("*").alias("docs"))
    need = F.greatest(F.lit(min_docs), F.ceil(F.col("docs") * min_share - 1e-9)).cast("long")
    wanted = sizes.filter(F.col("docs") >= min_docs).select("host", need.alias("need"))
    often = half_counts(docs).groupBy("half").agg(F.sum("n").alias("n"), F.min("host").alias("host")).filter(F.col("n") * 2 >= min_docs)
    usual = half_filter(often.join(wanted, "host").filter(F.col("n") * 2 >= F.col("need")).select("half"))
    chosen = checkpointed(line_units(docs, usual).withColumn("key", F.xxhash64("host", "w")))

    words = chosen.groupBy("key").agg(F.first("host").alias("host"), F.first("w").alias("w"))
    counts = chosen.select("id", "key").distinct().groupBy("key").agg(F.count("*").alias("docs"))
    vocabulary = checkpointed(words.join(wanted, "host").join(counts, "key"))
    held = checkpointed(without_companions(chosen.select("id", "line_no", "lines", "key"), vocabulary.filter("docs >= need").select("key")))

    places = held.select("id", "key").distinct().join(ordinals(docs.select("id", "host").distinct()).drop("host"), "id")
    maps = checkpointed(bitmaps(places))
    vocabulary = checkpointed(vocabulary.join(cardinalities(maps).withColumnRenamed("n", "own"), "key"))
    ties = checkpointed(variants(vocabulary))
    meeting = ties.groupBy("tie").agg((F.min("key") != F.max("key")).alias("several")).filter("several").select("tie")
    ties = checkpointed(ties.join(meeting, "tie"))
    known = vocabulary.select("key", "own", "need")
    centre = checkpointed(reaching(known, ties, maps))

    centres = ties.join(known.join(centre, "key"), "key").groupBy("tie").agg(F.max("own").alias("most"))
    beside = ties.join(centres, "tie").groupBy("key").agg(F.max("most").alias("most"))
    near = known.join(beside.select(F.col("key").alias("of"), "most"), F.col("key") == F.col("of")).filter(F.col("most") >= F.col("own"))
    found = checkpointed(near.select("of").unionByName(centre.select(F.col("key").alias("of"))).distinct().join(known, F.col("of") == F.col("key")).select("of", "own"))
    hits = checkpointed(held.join(found, F.col("key") == F.col("of")).select("id", "line_no", "lines", "own"))

    one = hits.filter("lines = 1").select("id", "line_no", "own").distinct()
    # a pair is a broken line unless one of its lines is itself a wording more usual than both
    two = hits.filter("lines = 2").select("id", "line_no", "own").distinct()
    alone = one.select("id", "line_no", F.col("own").alias("alone")).unionByName(one.select("id", (F.col("line_no") - 1).alias("line_no"), F.col("own").alias("alone")))
    two = two.join(alone.groupBy("id", "line_no").agg(F.max("alone").alias("alone")), ["id", "line_no"], "left").filter(F.coalesce("alone", F.lit(0)) < F.col("own"))
    one = one.select("id", "line_no")
    both = two.select("id", F.explode(F.array(F.col("line_no"), F.col("line_no") + 1)).alias("line_no"))
    return one.unionByName(both).distinct().select(F.col("id").alias(key), "line_no")


@arrow_udf(StringType())
def without_lines(texts: pa.Array, gone: pa.Array) -> pa.Array:
    """Each text without the lines whose numbers are set in its container; a null container takes none."""
    out = []
    for t, bits in zip(texts.to_pylist(), gone.to_pylist()):
        if t is not None and bits is not None:
            lines = t.split("\n")
            keep = np.ones(max(len(lines), 65536 * (1 + len(lines) // 65536)), bool)
            for chunk, data in ((b["chunk"], b["bitmap"]) for b in bits):
                keep[(chunk << 16) + unpack(data)] = False
            t = "\n".join([x for x, k in zip(lines, keep.tolist()) if k])
        out.append(t)
    return pa.array(out, pa.string())


def cleaned(df: DataFrame, key: str, host: str, text: str) -> DataFrame:
    """``key`` and ``text`` of every row, without its standing lines, which are looked up in a bitmap of each row's line numbers."""
    lines = checkpointed(standing_lines(df, key, host, text).select(F.col(key).alias("_k"), F.xxhash64(key).alias("key"), "line_no"))
    parts = bitmaps(lines.select("key", F.shiftright("line_no", 16).alias("chunk"), F.col("line_no").bitwiseAND(65535).alias("low")))
    gone = parts.groupBy("key").agg(F.collect_list(F.struct("chunk", "bitmap")).alias("_gone"))
    named = lines.select("_k", "key").distinct().join(gone, "key").drop("key")
    out = df.select(F.col(key), F.col(text)).join(named, F.col(key) == F.col("_k"), "left")
    return out.select(key, without_lines(F.col(text), F.col("_gone")).alias(text))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standing_lines(table(spark, sf_dir, "sec", "sec_id", "filer", "text"), "sec_id", "filer", "text")


def p2_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(table(spark, sf_dir, "sec", "sec_id", "filer", "text"), "sec_id", "filer", "text")
