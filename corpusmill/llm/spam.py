"""Problem 10: keyword-stuffed and link-list pages.

A page is cut into blocks of segments (sentences, lines, list entries) of the same kind.
Each block's compression ratio is divided by the median ratio that the whole corpus shows
for blocks of that language and length, so that short blocks and languages with a small
vocabulary aren't taken for spam (host names and numbers, random in link lists, count as
one). A page is a candidate when half of it or more is redundant beyond what such blocks
are; it is confirmed if a fair part of it stands outside punctuated, ordinary sentences.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions.arrow import map_arrow
from corpusmill.session import checkpointed
from corpusmill.sources.tables import table

BLOCK_CHARS = 1000
MIN_CHARS = 150
#: A block is redundant below this part of the median of its language and length, and a page if this share of it is.
REDUNDANT, MIN_REDUNDANT = 0.90, 0.5
RATIO_DECIMALS = 3
HOT_SHARE = 0.06
TERM_SHARE = 0.2
MIN_STUFFED = 0.3

# Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and a an in to is was that it for on with as by at from this be are or which not each its under after during before",
    "de": "der die das und den dem des ein eine einer einem nicht mit von zu im am auf für ist wegen nach über ohne trotz",
    "fr": "le la les des du de et un une en dans pour par sur ne pas est au aux que qui malgré après sans lors",
    "es": "el la los las de del y un una en para por con no es al que se sin tras durante",
    "it": "il lo la gli le di del della e un una in per con non è al che si senza dopo nella alla",
}
LANGUAGE_OF = {lang: frozenset(words.split()) for lang, words in FUNCTION_WORDS.items()}
LANGUAGES_OF_WORD = {w: tuple(lang for lang, own in LANGUAGE_OF.items() if w in own) for w in frozenset().union(*LANGUAGE_OF.values())}

WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
SEGMENT = re.compile(r"(?:[^.!?。！？…\n]|[.!?…](?=\w)|\n(?=[a-zß-ÿ]))+[.!?。！？…]*[\"'”’»)\]]*|[.!?。！？…]+")
LINKED = re.compile(r"https?://|www\.|\]\(|<\s*/?\w|\.(?:com|org|net|info|example|test|invalid)\b")
PARTING = re.compile(r"[|»·•>#/;\t]|(?:^|\s)[-–—*](?=\s)")
HOST = re.compile(r"(?:https?://|www\.)?[\w-]+(?:\.[\w-]+)*\.[a-z]{2,7}/")
DIGITS = re.compile(r"\d+")
ENDED = re.compile(r"[.!?。！？…][\"'”’»)\]]*$")


def language(words: list[str]) -> str:
    """The language whose function words take the largest share, or '' below one in ten; ties go to the first listed."""
    votes = dict.fromkeys(LANGUAGE_OF, 0)
    for langs in [LANGUAGES_OF_WORD[w] for w in words if w in LANGUAGES_OF_WORD]:
        for lang in langs:
            votes[lang] += 1
    best = max(votes, key=lambda lang: votes[lang])
    return best if votes[best] > 0.1 * max(1, len(words)) else ""


def masked(block: str) -> bytes:
    """A block's bytes with one host name for all and 0 for every number."""
    if "/" in block and "." in block:
        block = HOST.sub("/", block)
    return DIGITS.sub("0", block).encode("utf-8", "surrogatepass")


def hot_terms(words: list[str]) -> frozenset[str]:
    """The content words that each take HOT_SHARE of a page's words, met at least five times."""
    least = max(5.0, HOT_SHARE * len(words))
    return frozenset(w for w, n in Counter(words).items() if n >= least and len(w) > 2 and w not in LANGUAGES_OF_WORD)


def kind_of(segment: str, hot: frozenset[str]) -> str:
    """'sentence', 'stuffed' (a sentence that hot terms fill) or 'other' (caption, list, link)."""
    words = WORD.findall(segment.lower())
    if len(words) < 4 or not ENDED.search(segment) or LINKED.search(segment):
        return "other"
    if len(PARTING.findall(segment)) > len(words) / 12 or segment.count(",") > len(words) / 3:
        return "other"
    return "stuffed" if hot and sum(w in hot for w in words) >= TERM_SHARE * len(words) else "sentence"


def blocks(text: str) -> list[tuple[str, str]]:
    """(kind, text) of the page's blocks, each of segments of one kind and about BLOCK_CHARS."""
    out: list[tuple[str, str]] = []
    kind, parts, size = "", [], 0
    hot = hot_terms(WORD.findall(text.lower()))
    for piece in SEGMENT.findall(text.replace("\r\n", "\n")):
        s = piece.strip()
        if not s:
            continue
        k = kind_of(s, hot)
        if parts and (k != kind or size + len(s) > BLOCK_CHARS):
            out.append((kind, "\n".join(parts)))
            parts, size = [], 0
        kind = k
        parts.append(s)
        size += len(s) + 1
        while size > 2 * BLOCK_CHARS:  # an unbroken run is cut into equal blocks
            whole = "\n".join(parts)
            out.append((kind, whole[:BLOCK_CHARS]))
            parts, size = [whole[BLOCK_CHARS:]], len(whole) - BLOCK_CHARS
    if parts:
        out.append((kind, "\n".join(parts)))
    return out


def block_statistics(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row a block: ``key``, language, length step, compression ratio and kind.

    Null, empty and white-space texts give no row.
    """

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c: [] for c in ("k", "lang", "step", "chars", "ratio", "kind")}
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for kind, block in blocks(t) if t else ():
                    raw = masked(block)
                    words = WORD.findall(block.lower())
                    out["k"].append(k)
                    out["lang"].append(language(words))
                    out["step"].append(len(raw).bit_length() * 4 + (len(raw) * 4 >> len(raw).bit_length() - 1 & 3))
                    out["chars"].append(len(block))
                    out["ratio"].append(round(len(zlib.compress(raw, 1)) / len(raw), RATIO_DECIMALS))
                    out["kind"].append(kind)
            return out

        return work

    kind = df.select(F.col(key)).schema[0].dataType.simpleString()
    schema = f"k {kind}, lang string, step int, chars int, ratio double, kind string"
    return map_arrow(df.select(F.col(key).alias("k"), F.col(text).alias("t")), make, schema)


def medians(blocks: DataFrame, by: list[str], name: str, least: int = 1) -> DataFrame:
    """``by`` and ``name``, the exact lower median of the ratios of each group of ``least`` blocks or more.

    Ratios have RATIO_DECIMALS decimals, so a group's counts are some thousand rows at most
    and the result doesn't depend on the order of the work.
    """
    counts = blocks.groupBy(*by, "ratio").agg(F.count("*").alias("n"))
    own = Window.partitionBy(*by)
    run = counts.withColumn("upto", F.sum("n").over(own.orderBy("ratio"))).withColumn("all", F.sum("n").over(own))
    return run.filter((F.col("all") >= least) & (F.col("upto") * 2 >= F.col("all"))).groupBy(*by).agg(F.min("ratio").alias(name))


def stuffed_pages(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``chars``, ``redundancy``, ``redundant`` and ``stuffed`` of every page of MIN_CHARS or more.

    ``redundancy`` is the lowest normalised ratio of its blocks and ``redundant`` the share
    of characters in blocks whose ratio is below REDUNDANT; ``stuffed`` is the share of
    characters outside ordinary sentences, or in sentences that the page's few hot terms
    fill. Medians are those of blocks of sentences, of the length step alone where a
    language has fewer than 20; they have a row a language and length step (a few hundred
    at most), whatever the corpus. Pages of repeated rows of one key are judged as one page.
    """
    parts = checkpointed(block_statistics(df, key, text))
    prose = parts.filter("kind = 'sentence'")
    norm = parts.join(F.broadcast(medians(prose, ["lang", "step"], "usual", 20)), ["lang", "step"], "left").join(F.broadcast(medians(prose, ["step"], "any")), "step", "left")
    norm = norm.withColumn("norm", F.col("ratio") / F.coalesce("usual", "any", F.lit(1.0)))
    stuffed = F.when(F.col("kind") != "sentence", F.col("chars")).otherwise(0)
    redundant = F.when(F.col("norm") < REDUNDANT, F.col("chars")).otherwise(0)
    share = lambda c: F.sum(c) / F.sum("chars")
    pages = norm.groupBy("k").agg(F.sum("chars").alias("chars"), F.min("norm").alias("redundancy"), share(redundant).alias("redundant"), share(stuffed).alias("stuffed"))
    return pages.filter(F.col("chars") >= MIN_CHARS).withColumnRenamed("k", key)


def is_stuffed():  # noqa: ANN201
    """Pages whose redundancy makes them candidates and whose missing sentences confirm it."""
    return (F.col("redundant") >= MIN_REDUNDANT) & (F.col("stuffed") >= MIN_STUFFED)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuffed_pages(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text").filter(is_stuffed()).select("doc_id")


def p10_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuffed_pages(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")
