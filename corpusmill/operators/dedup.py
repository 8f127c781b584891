"""Exact and near duplicates, evaluation overlap and the verdict of each document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions import text as T
from corpusmill.session import checkpointed

PRIME = (1 << 31) - 1
# Shingle words, hash functions, bands of the signature and their rows, and the words of an evaluation run.
SHINGLE_WORDS, HASHES, BANDS, BAND_ROWS, EVAL_WORDS = 5, 32, 3, 10, 13
# Sources in which near duplicates are sought, and those compared with evaluation texts.
NEAR_SOURCES, EVAL_SOURCES = ("case-law",), ("case-law", "sec")


def permutation(i: int) -> tuple[int, int]:
    """The i-th hash function a * h + b modulo PRIME, from a rule both engines can state."""
    return (1_103_515_245 * (i + 1) + 12_345) % PRIME | 1, (69_069 * (i + 1) + 907_633_385) % PRIME


def shingle_hashes(text: Column, k: int = SHINGLE_WORDS) -> Column:
    """28-bit hashes of a text's distinct shingles."""
    return F.transform(T.shingles(T.words(text), k), lambda s: F.conv(F.substring(F.md5(s), 1, 7), 16, 10).cast("bigint"))


def signature(hashes: Column, permutations: int = HASHES) -> Column:
    """The least value of each hash function; PRIME throughout for a text without words."""
    least = lambda own, a, b: F.coalesce(F.array_min(F.transform(own, lambda h: (h * a + b) % PRIME)), F.lit(PRIME))
    return T.let(hashes, lambda own: F.array(*[least(own, *permutation(i)) for i in range(permutations)]))


def bands(sig: Column, n_bands: int = BANDS, rows: int = BAND_ROWS) -> Column:
    """A key a band of the signature."""
    return F.array(*[F.concat_ws("-", F.lit(str(b)), *[F.get(sig, b * rows + i) for i in range(rows)]) for b in range(n_bands)])


def classes(sigs: DataFrame, key: str, sig: str) -> DataFrame:
    """``id``, ``head`` and ``keys``: each document, the first of its equal signatures and that class' band keys."""
    rows = checkpointed(sigs.select(F.col(key).alias("id"), F.col(sig).alias("sig")))
    heads = rows.groupBy("sig").agg(F.min("id").alias("head"))
    return rows.join(heads, "sig").select("id", "head", bands(F.col("sig")).alias("keys"))


def class_links(sigs: DataFrame, key: str, sig: str) -> DataFrame:
    """``id``, ``class_id`` and ``n_links``: the first document of equal signatures, and how many other classes share a band with it.

    No pair is formed: the classes in any of the bands are counted by inclusion and
    exclusion over the groups that agree in each set of bands.
    """
    of = checkpointed(classes(sigs, key, sig))
    heads = of.filter("id = head").select("head", "keys")
    sets = [[i for i in range(BANDS) if s >> i & 1] for s in range(1, 1 << BANDS)]
    part = [F.struct(F.lit((-1) ** (len(s) + 1)).alias("sign"), F.concat_ws("|", *[F.get("keys", F.lit(i)) for i in s]).alias("k")) for s in sets]
    rows = heads.select("head", F.explode(F.array(*part)).alias("p")).select("head", "p.sign", "p.k")
    sizes = rows.groupBy("k").agg(F.count("*").alias("n"))
    n = rows.join(sizes, "k").groupBy("head").agg((F.sum(F.col("sign") * F.col("n")) - 1).alias("n_links"))
    return of.join(n, "head").select("id", F.col("head").alias("class_id"), "n_links")


def greedy_in_groups(members: DataFrame) -> DataFrame:
    """``id`` of the members dropped when each, in order, goes if a smaller kept one is in one of its groups.

    ``members`` has id and group. A round needs only each group's smallest kept and smallest
    undecided member, so a group of any size costs no more than its rows.
    """
    every = members.select("id", "group").distinct()
    shared = every.groupBy("group").agg((F.min("id") != F.max("id")).alias("several")).filter("several").select("group")
    of = checkpointed(every.join(shared, "group").select("id", "group"))  # a group of one drops nothing
    nodes = checkpointed(of.select("id").distinct().withColumn("state", F.lit("open")))
    while True:
        seen = of.join(nodes, "id")
        least = seen.groupBy("group").agg(*[F.min(F.when(F.col("state") == s, F.col("id"))).alias(s) for s in ("kept", "open")])
        near = seen.filter("state = 'open'").select("id", "group").join(least, "group").groupBy("id").agg(F.min("kept").alias("kept"), F.min("open").alias("first"))
        nodes = checkpointed(
            nodes.join(near, "id", "left").select(
                "id", F.when(F.col("state") != "open", F.col("state")).when(F.col("kept") < F.col("id"), "dropped").when(F.col("first") >= F.col("id"), "kept").otherwise("open").alias("state")
            )
        )
        if nodes.filter("state = 'open'").isEmpty():
            return nodes.filter("state = 'dropped'").select("id")


def greedy(links: DataFrame) -> DataFrame:
    """``id`` of the nodes dropped when each, in order, goes if a smaller kept node is linked to it.

    Rounds to the fixpoint: a node without an undecided or kept smaller neighbour is kept,
    one with a kept smaller neighbour is dropped. Each round is checkpointed.
    """
    edges = checkpointed(links)
    nodes = checkpointed(edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("state", F.lit("open")))
    while True:
        of = edges.join(nodes.select(F.col("id").alias("a"), F.col("state").alias("s")), "a").groupBy(F.col("b").alias("id")).agg(
            F.max((F.col("s") == "kept").cast("int")).alias("near_kept"), F.max((F.col("s") == "open").cast("int")).alias("near_open")
        )
        step = nodes.join(of, "id", "left").select(
            "id",
            F.when(F.col("state") != "open", F.col("state")).when(F.coalesce("near_kept", F.lit(0)) == 1, "dropped").when(F.coalesce("near_open", F.lit(0)) == 0, "kept").otherwise("open").alias("state"),
        )
        nodes = checkpointed(step)
        if nodes.filter("state = 'open'").isEmpty():
            return nodes.filter("state = 'dropped'").select("id")


def near_duplicates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id`` of the documents a greedy pass in key order drops as near duplicates.

    Members of a signature class after its first go with it or, since they share its
    every band, because of it: in either case they are dropped. Rows of one key count once.
    """
    sigs = docs.select(F.col(key).alias("id"), signature(shingle_hashes(F.col(text))).alias("sig"))
    of = checkpointed(classes(sigs, "id", "sig"))
    members = of.filter("id = head").select("id", F.explode("keys").alias("group"))
    return greedy_in_groups(members).unionByName(of.filter("id > head").select("id"))


def exact_duplicates(docs: DataFrame, key: str, shard: str, text: str) -> DataFrame:
    """``key`` and ``is_dup``: whether the shard holds the same normalized text under a smaller key."""
    hashed = docs.select(F.col(key), F.col(shard), F.md5(T.normalized(F.col(text))).alias("_h"))
    first = hashed.groupBy(shard, "_h").agg(F.min(key).alias("_first"))
    return hashed.join(first, [shard, "_h"]).select(key, (F.col(key) > F.col("_first")).alias("is_dup"))


def eval_grams(items: DataFrame, columns: list[str], n: int = EVAL_WORDS) -> DataFrame:
    """``gram``: the distinct runs of ``n`` words of the items' fields, joined by a space."""
    whole = F.concat_ws(" ", *columns)
    return items.select(F.explode(F.array_distinct(T.grams(T.words(whole), n))).alias("gram")).distinct()


def contaminated(docs: DataFrame, key: str, text: str, grams: DataFrame, n: int = EVAL_WORDS) -> DataFrame:
    """``key`` of the documents that share a run of ``n`` words with ``grams``."""
    own = docs.select(F.col(key), F.explode(F.array_distinct(T.grams(T.words(F.col(text)), n))).alias("gram"))
    return own.join(grams, "gram", "left_semi").select(key).distinct()


def verdicts(docs: DataFrame, key: str, source: str, shard: str, text: str, grams: DataFrame) -> DataFrame:
    """``key``, ``source``, ``shard`` and ``verdict``: near_dup, contaminated, exact_dup or kept.

    Near duplicates are sought in the strict sources, overlap in the decontaminated ones;
    exact copies count within a source's shard among the documents neither removes.
    """
    rows = docs.select(key, source, shard, text)
    near = near_duplicates(rows.filter(F.col(source).isin(*NEAR_SOURCES)), key, text).select(F.col("id").alias(key), F.lit(1).alias("_near"))
    leak = contaminated(rows.filter(F.col(source).isin(*EVAL_SOURCES)), key, text, grams).withColumn("_leak", F.lit(1))
    rows = rows.join(near, key, "left").join(leak, key, "left").withColumn("_h", F.md5(T.normalized(F.col(text))))
    free = rows.filter("_near is null and _leak is null").groupBy(source, shard, "_h").agg(F.min(key).alias("_first"))
    same = rows.join(free, [source, shard, "_h"], "left")
    verdict = F.when(F.col("_near") == 1, "near_dup").when(F.col("_leak") == 1, "contaminated").when(F.col(key) > F.col("_first"), "exact_dup").otherwise("kept")
    return same.select(key, source, shard, verdict.alias("verdict"))
