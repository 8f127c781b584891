"""The cleaning chain: line filter, boilerplate, length, repetition, language and OCR gates."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from corpusmill.functions import text as T
from corpusmill.operators.running import running_total
from corpusmill.session import checkpointed

# The thresholds of the gates.
SHORTEST_LINE, MOST_SIGNS = 40, 0.30
SHORTEST_TEXT = 600
RUN_WORDS, TOP_RUNS, MOST_REPEATED = 4, 10, 0.50
HEAD_CHARS, ASCII_SURE, ASCII_NEVER, ASCII_DOUBTFUL = 5000, 0.99, 0.90, 0.95
FEWEST_WORDS, MOST_UNKNOWN = 50, 0.20
TOKEN_CHARS = 4.0
# Whole-line boilerplate, case ignored.
BOILERPLATE = (
    r"^\s*form\s+10[-\s]?[kq]\b.*$",
    r"^\s*page\s+\d+\s+of\s+\d+\s*$",
    r"^\s*table\s+of\s+contents\s*$",
    r"^\s*/s/\s*.*$",
    r"^\s*all\s+rights\s+reserved.*$",
    r"^\s*united\s+states\s+securities\s+and\s+exchange\s+commission\s*$",
    r"^\s*securities\s+and\s+exchange\s+commission\s*$",
    r"^\s*washington,?\s+d\.?\s?c\.?\s+\d{5}\s*$",
    r"^\s*\[?\s*x\s*\]?\s*$",
)
BOILER = "(?i)" + "|".join(BOILERPLATE)
# English function words, which take this share of running English text.
ENGLISH_WORDS = "the of and a an in to is was that it for on with as by at from this be are or which not each its under after during before"
ENGLISH_SHARE = 0.12
#: A dictionary of up to so many letters is sent to all machines; a larger one is joined.
DICTIONARY_CHARS = 32_000_000


def filter_lines(c: Column, shortest: int = SHORTEST_LINE, signs: float = MOST_SIGNS) -> Column:
    """The text's lines, white space collapsed, without short lines and lines mostly of signs."""
    rows = F.transform(T.lines(T.text_or_empty(c)), T.collapsed)
    return F.array_join(F.filter(rows, lambda x: (F.length(x) >= shortest) & (T.nonalnum_ratio(x) <= signs)), "\n")


def strip_boilerplate(c: Column) -> Column:
    """The text without lines that are boilerplate as a whole."""
    return F.array_join(F.filter(T.lines(c), lambda x: ~x.rlike(BOILER)), "\n")


def is_english(c: Column, detector: Column | None = None) -> Column:
    """By the share of ASCII characters of the first characters; ``detector`` decides the middle band if given."""
    ratio = T.ascii_ratio(F.substring(c, 1, HEAD_CHARS))
    middle = detector if detector is not None else ratio > ASCII_DOUBTFUL
    return F.when(ratio >= ASCII_SURE, True).when(ratio < ASCII_NEVER, False).otherwise(middle)


def english_words(c: Column) -> Column:
    """A detector for the middle band: whether English function words take ENGLISH_SHARE of the first characters' words."""
    words = T.words(F.substring(c, 1, HEAD_CHARS))
    share = lambda w: F.try_divide(F.size(F.filter(w, lambda x: x.isin(*ENGLISH_WORDS.split()))).cast("double"), F.size(w))
    return F.coalesce(T.let(words, share) >= ENGLISH_SHARE, F.lit(False))


def repetition(c: Column, run: int = RUN_WORDS, top: int = TOP_RUNS) -> Column:
    """The share of word runs that the most frequent ones take; 0 under twice the run's length of words."""
    share = lambda w: F.when(F.size(w) < 2 * run, F.lit(0.0)).otherwise(T.top_run_share(T.grams(w, run), top))
    return T.let(T.tokens(c), share)


def nonword_ratio(df: DataFrame, key: str, text: str, dictionary: DataFrame, fewest: int = FEWEST_WORDS) -> DataFrame:
    """``key``, ``n_tokens``, ``n_unknown`` and ``ratio``: words of three or more letters not in ``dictionary``.

    The ratio is 0 with an empty dictionary or under the least number of tokens. A text's
    words are grouped inside the row; the dictionary (column ``word``) is joined by AQE's
    choice, broadcast where it is small.
    """
    found = F.regexp_extract_all(F.lower(T.text_or_empty(F.col(text))), F.lit("([a-z]{3,})"), F.lit(1))
    docs = df.select(F.col(key), found.alias("_w"))
    known = dictionary.select(F.lower("word").alias("_word")).distinct().withColumn("_known", F.lit(1))
    rows = docs.select(key, F.explode("_w").alias("_word")).groupBy(key, "_word").agg(F.count("*").alias("_n")).join(known, "_word", "left")
    unknown = rows.groupBy(key).agg(F.sum(F.when(F.col("_known").isNull(), F.col("_n")).otherwise(0)).alias("n_unknown"))
    empty = known.isEmpty()
    out = docs.select(key, F.size("_w").alias("n_tokens")).join(unknown, key, "left")
    n = F.coalesce("n_unknown", F.lit(0))
    ratio = F.when((F.col("n_tokens") >= fewest) & F.lit(not empty), n.cast("double") / F.col("n_tokens")).otherwise(0.0)
    return out.select(key, "n_tokens", n.alias("n_unknown"), ratio.alias("ratio"))


def word_tester(dictionary: DataFrame):  # noqa: ANN201
    """A function of a text column to a struct of ``n_tokens`` and ``n_unknown``, or None for a dictionary over DICTIONARY_CHARS.

    The counts are those of ``nonword_ratio``; a null text has null counts.
    """
    words = dictionary.select(F.lower("word").alias("w")).filter("w is not null").distinct()
    size = words.agg(F.coalesce(F.sum(F.length("w")), F.lit(0)).alias("n")).first()["n"]
    if size > DICTIONARY_CHARS:
        return None
    known = dictionary.sparkSession.sparkContext.broadcast(frozenset(r.w for r in words.toLocalIterator()))

    @arrow_udf("struct<n_tokens int, n_unknown int>")
    def count(texts: pa.Array) -> pa.Array:
        find, have = re.compile("[a-z]{3,}").findall, known.value
        total, bad = [], []
        for t in texts:
            t = t.as_py()
            own = Counter(find(t.lower())) if t is not None else None
            total.append(None if own is None else own.total())
            bad.append(None if own is None else sum(n for w, n in own.items() if w not in have))
        return pa.StructArray.from_arrays([pa.array(total, pa.int32()), pa.array(bad, pa.int32())], ["n_tokens", "n_unknown"])

    return count


def clean(df: DataFrame, key: str, text: str, strict: Column | None = None, dictionary: DataFrame | None = None, detector: Callable[[Column], Column] | None = None) -> DataFrame:
    """``df`` with ``clean_text``, ``reason``, ``raw_chars`` and ``clean_chars``.

    The first failing check names the reason: too_short, repetitive, non_english, ocr, else
    kept. ``clean_chars`` is given for dropped texts too, ``clean_text`` is then empty. A
    null text is an empty one. The OCR gate runs on rows where ``strict`` holds and only
    if a dictionary that isn't empty is given; only texts that pass the other checks reach
    it. ``detector`` of the cleaned text decides the middle band of the language gate.
    """

    def judged(body: Column) -> Column:
        english = is_english(body, detector(body) if detector is not None else None)
        reason = F.when(F.length(body) < SHORTEST_TEXT, "too_short").when(repetition(body) > MOST_REPEATED, "repetitive").when(~english, "non_english").otherwise("kept")
        return F.struct(body.alias("body"), reason.alias("reason"), F.length(body).alias("chars"))

    # a generator of one row keeps later filters from repeating the chain's expressions
    once = T.let(strip_boilerplate(filter_lines(F.col(text))), judged)
    rows = df.select("*", F.length(T.text_or_empty(F.col(text))).alias("raw_chars"), F.explode(F.array(once)).alias("_c"))
    rows = rows.select("*", F.col("_c.chars").alias("clean_chars"), F.col("_c.body").alias("_body"), F.col("_c.reason").alias("reason")).drop("_c")
    if dictionary is not None and not dictionary.isEmpty():
        gate = (F.col("reason") == "kept") & (strict if strict is not None else F.lit(True))
        count = word_tester(dictionary)
        if count is not None:
            rows = rows.withColumn("_n", count(F.when(gate, F.col("_body"))))
            bad = (F.col("_n.n_tokens") >= FEWEST_WORDS) & (F.col("_n.n_unknown") / F.col("_n.n_tokens") > MOST_UNKNOWN)
            rows = rows.withColumn("reason", F.when(bad, "ocr").otherwise(F.col("reason"))).drop("_n")
        else:
            rows = checkpointed(rows)  # read by the gate's branch and by the result
            bad = nonword_ratio(rows.filter(gate), key, "_body", dictionary).filter(F.col("ratio") > MOST_UNKNOWN).select(F.col(key).alias("_cleankey"), F.lit(1).alias("_bad"))
            rows = rows.join(bad, rows[key] == bad["_cleankey"], "left").withColumn("reason", F.when(F.col("_bad") == 1, "ocr").otherwise(F.col("reason"))).drop("_bad", "_cleankey")
    return rows.withColumn("clean_text", F.when(F.col("reason") == "kept", F.col("_body")).otherwise("")).drop("_body")


def within_budget(cleaned: DataFrame, group: list[str], order: str, cap: float) -> DataFrame:
    """Rows up to and with the kept one that fills ``cap`` estimated tokens of its group."""
    spent = running_total(cleaned, group, order, F.when(F.col("reason") == "kept", F.col("clean_chars")), "_spent")
    return spent.filter(F.col("_spent") / TOKEN_CHARS < cap).drop("_spent")


def report(cleaned: DataFrame, source: str, shard: str) -> DataFrame:
    """Rows a source and reason, with estimated tokens cut to whole numbers a shard first."""
    by = cleaned.groupBy(source, shard, "reason").agg(F.count("*").alias("n"), F.sum("clean_chars").alias("chars"))
    est = F.when(F.col("reason") == "kept", F.floor(F.col("chars") / TOKEN_CHARS)).otherwise(0)
    return by.groupBy(source, "reason").agg(F.sum("n").alias("n"), F.sum(est).cast("bigint").alias("est_tokens"))
