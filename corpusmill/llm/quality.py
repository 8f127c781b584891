"""Problem 6: text statistics of each record, and whether it is natural prose.

Each statistic's exact empirical distribution over the records that hold prose is computed
per language: values are counted first (so ties cost nothing), sorted by range
partitioning, and every partition adds the number of records in the partitions before it
to its own running counts. A record's tail probabilities among these are combined into an
outlier score, which decides; as junk isn't part of the distributions, it stands out
however common it is. An outlier must also hold text that isn't sentences, apart from a
source's standing lines and one opening sentence: prose that is merely odd is none.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions.arrow import map_arrow
from corpusmill.llm.repetition import records
from corpusmill.llm.standing import standing_lines
from corpusmill.session import checkpointed
from corpusmill.sources.tables import table

MIN_SCORE = 2.5
MAX_PROSE = 0.6
MIN_REST_WORDS = 8
#: Records of this share of prose make the distributions; a language of fewer than LEAST_RECORDS of them is ranked among those of all.
HOLDS_PROSE, LEAST_RECORDS = 0.5, 30
STATISTICS = ("mean_word_length", "symbol_ratio", "digit_ratio", "ended_share", "common_share", "words_per_line", "prose_share")
DECIMALS = 3

# Frequent function words by language; "of" and its like also stand in list entries and don't tell sentences.
COMMON = {
    "en": "the and a an in to is was that it for on with as by at from this be are or which not each its under after during before most also their has have had but he she they his her were been than when where while because although some later already however thus such there then into",
    "de": "der die das und den dem ein eine einer einem nicht mit zu im am auf für ist wegen nach über ohne trotz dass sich auch wurde",
    "fr": "le la les du un une dans pour par sur ne pas est au aux que qui malgré après sans lors il elle ce cette",
    "es": "el la los las del un una en para por con no es al que se sin tras durante lo su",
    "it": "il lo la gli del della un una in per con non è al che si senza dopo nella alla",
}
LANGUAGE_BIT = {lang: 1 << k for k, lang in enumerate(COMMON)}
BITS: dict[str, int] = {}
for _lang, _words in COMMON.items():
    for _w in _words.split():
        BITS[_w] = BITS.get(_w, 0) | LANGUAGE_BIT[_lang]

WORD = re.compile(r"[^\W\d_]+")
END = re.compile(r"[.!?…。！？][\"'”’»)\]]*(?=\s|$)")
LINE_FIELDS = ("line_no", "words", "letters", "chars", "digits", "symbols", "common", "ended", "prose", "first")


def line_numbers(text: str) -> tuple[list[tuple[int, ...]], str]:
    """The LINE_FIELDS of every non-blank line, and the text's language ('en' if no other shows).

    ``prose`` holds the words of a line that reads as running text, judged with its
    neighbours; ``first`` its words up to the first sentence end, -1 where no sentence ends.
    """
    votes = dict.fromkeys(COMMON, 0)
    rows: list[list[int]] = []
    for n, line in enumerate(text.split("\n")):
        s = line.strip()
        if not s:
            continue
        words = WORD.findall(s.lower())
        bits = [BITS[w] for w in words if w in BITS]
        letters = sum(map(len, words))
        digits = sum(map(s.count, "0123456789"))
        spaces = s.count(" ") + s.count("\t")
        for lang, bit in LANGUAGE_BIT.items():
            votes[lang] += sum(1 for b in bits if b & bit)
        end = END.search(s)
        first = len(WORD.findall(s[: end.end()])) if end else -1
        rows.append([n, len(words), letters, len(s), digits, max(0, len(s) - letters - digits - spaces), len(bits), int(s[-1] in ".!?…。！？" or s[-1] in "\"'”’»)" and s[-2:-1] in ".!?…"), 0, first])
    lang = max(votes, key=lambda x: votes[x])
    if votes[lang] < 1.5 * votes["en"] + 2 or votes[lang] < 0.15 * sum(r[1] for r in rows):
        lang = "en"
    for k, r in enumerate(rows):
        around = rows[max(0, k - 1) : k + 2]
        words, common = sum(x[1] for x in around), sum(x[6] for x in around)
        marks = r[4] + r[5] > 0.35 * r[3]
        own = r[6] >= 0.12 * r[1] and r[1] >= 4 and r[6] >= 1
        near = common >= 0.18 * words and words >= 8 and r[1] >= 1 and (r[6] >= 1 or r[1] <= 8)
        r[8] = r[1] if (own or near) and not marks else 0
    return [tuple(r) for r in rows], lang


def line_statistics(df: DataFrame) -> DataFrame:
    """``source``, ``rec_id``, ``lang`` and an array a LINE_FIELD of every row with a text."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select("source", "rec_id").schema)

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            langs, parts = [], []
            for t in batch.column(2).to_pylist():
                rows, lang = line_numbers(t or "")
                langs.append(lang)
                parts.append(np.array(rows, np.int32).reshape(-1, len(LINE_FIELDS)))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in parts])]), pa.int32())
            flat = np.concatenate(parts)
            arrays = {f: pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(flat[:, k]), pa.int32())) for k, f in enumerate(LINE_FIELDS)}
            return {"source": batch.column(0), "rec_id": batch.column(1), "lang": langs} | arrays

        return work

    return map_arrow(df.select("source", "rec_id", "text"), make, f"{kinds}, lang string, " + ", ".join(f"{f} array<int>" for f in LINE_FIELDS))


def record_statistics(lines: DataFrame) -> DataFrame:
    """A row a record: word count, the STATISTICS and the share of prose in what is left.

    ``lines`` has the columns of line_statistics and ``gone``, the numbers of standing
    lines or null. ``n_words`` and the STATISTICS describe the record without these lines;
    ``prose_share`` also leaves out one opening sentence. All are 0 for an empty record.
    """
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lines.select("source", "rec_id").schema)

    def make() -> Callable[[pa.RecordBatch], dict]:
        def judge(gone: list[int] | None, c: dict[str, np.ndarray]) -> list[float]:
            keep = ~np.isin(c["line_no"], gone) if gone else np.ones(len(c["line_no"]), bool)
            c = {k: v[keep] for k, v in c.items()}
            words, chars, lines = int(c["words"].sum()), int(c["chars"].sum()), len(c["line_no"])
            prose, opening = int(c["prose"].sum()), 0
            for p, w, f in zip(c["prose"].tolist(), c["words"].tolist(), c["first"].tolist()):
                if not p:
                    break
                opening += f if f >= 0 else w
                if f >= 0 or opening > 60:
                    break
            if opening > 60:
                opening = 0
            # what isn't words counts by its length, so tables and codes weigh what they show
            other = sum(max(w, n / 6) for w, n, p in zip(c["words"].tolist(), c["chars"].tolist(), c["prose"].tolist()) if not p)
            left = max(0, prose - opening)
            div = lambda a, b: round(a / b, DECIMALS) if b else 0.0
            return [
                words,
                min(100.0, round(div(int(c["letters"].sum()), words), 2)),
                div(int(c["symbols"].sum()), chars),
                div(int(c["digits"].sum()), chars),
                div(int(c["ended"].sum()), lines),
                div(int(c["common"].sum()), words),
                min(1000.0, round(div(words, lines), 1)),
                div(left, left + other),
                left + other,
            ]

        def work(batch: pa.RecordBatch) -> dict:
            columns = {f: batch.column(batch.schema.get_field_index(f)) for f in LINE_FIELDS}
            offsets = columns["line_no"].offsets.to_numpy()
            # each list column of a batch may start at its own place
            values = {f: a.values.to_numpy(zero_copy_only=False) for f, a in columns.items()}
            starts = {f: a.offsets.to_numpy() for f, a in columns.items()}
            gone = batch.column(batch.schema.get_field_index("gone")).to_pylist()
            out = [judge(gone[r], {f: values[f][starts[f][r] : starts[f][r + 1]] for f in LINE_FIELDS}) for r in range(len(offsets) - 1)]
            names = ("n_words", *STATISTICS, "rest")
            return {k: batch.column(batch.schema.get_field_index(k)) for k in ("source", "rec_id", "lang")} | {k: [float(o[i]) for o in out] for i, k in enumerate(names)}

        return work

    return map_arrow(lines.select("source", "rec_id", "lang", *LINE_FIELDS, "gone"), make, f"{kinds}, lang string, n_words double, " + ", ".join(f"{s} double" for s in STATISTICS) + ", rest double")


def distributions(stats: DataFrame) -> DataFrame:
    """Exact ranks: ``lang``, ``stat``, ``value``, ``below`` (prose records with at most it), ``above`` (with at least it) and their ``total``.

    Values of all records are listed, but only those that hold prose are counted. Values
    are counted, range-partitioned by (lang, stat, value) and sorted; running counts
    are kept within partitions and completed by the counts of the (lang, stat) groups in
    the partitions before, of which there is one row a partition and group. All records
    are ranked once more under the language '', among the prose of all languages.
    """
    prose = (F.col("prose_share") >= HOLDS_PROSE) & (F.col("rest") >= MIN_REST_WORDS)
    long = stats.select(F.explode(F.array("lang", F.lit(""))).alias("lang"), prose.cast("bigint").alias("n"), F.array(*[F.struct(F.lit(s).alias("stat"), F.col(s).alias("value")) for s in STATISTICS]).alias("xs"))
    long = long.select("lang", "n", F.explode("xs").alias("x"))
    counted = long.select("lang", "x.stat", "x.value", "n").groupBy("lang", "stat", "value").agg(F.sum("n").alias("n"))
    parts = max(2, int(stats.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = counted.repartitionByRange(parts, "lang", "stat", "value").sortWithinPartitions("lang", "stat", "value")

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, sums = TaskContext.get().partitionId(), {}
        for batch in batches:
            langs, stats_, counts, upto = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), []
            for g in zip(langs, stats_, counts):
                sums[g[:2]] = sums.get(g[:2], 0) + g[2]
                upto.append(sums[g[:2]])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto, pa.int64()), pa.array([part] * len(upto), pa.int32())], ["lang", "stat", "value", "n", "upto", "part"])

    ranked = checkpointed(ordered.mapInArrow(running, "lang string, stat string, value double, n bigint, upto bigint, part int"))
    sizes = ranked.groupBy("lang", "stat", "part").agg(F.sum("n").alias("size"))
    w = Window.partitionBy("lang", "stat")
    offsets = sizes.select(
        "lang", "stat", "part", F.coalesce(F.sum("size").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("size").over(w).alias("total")
    )
    joined = ranked.join(offsets, ["lang", "stat", "part"])
    below = F.col("upto") + F.col("before")
    return joined.select("lang", "stat", "value", below.alias("below"), (F.col("total") - below + F.col("n")).alias("above"), "total")


def outlier_scores(stats: DataFrame) -> DataFrame:
    """``stats`` with ``score`` and ``most``: the mean and largest of minus the logs of its tail probabilities among prose.

    Tails are two-sided, for the share of prose that of low values; a record counts as one
    of those it is ranked among. A typical record has a mean of about 1. The statistics
    have two or three decimals, or one and an upper bound (100 letters a word, 1,000 words
    a line), so a distribution has at most 10,001 values a language whatever the number of
    records, and its rows are broadcast.
    """
    tails = checkpointed(distributions(stats))
    least = F.least("below", "above") + 1
    p = F.when(F.col("stat") == "prose_share", (F.col("below") + 1) / (F.col("total") + 1)).otherwise(2 * least / (F.col("total") + 1))
    tails = tails.select("lang", "stat", "value", "total", (-F.log(F.least(F.lit(1.0), p))).alias("t"))
    own = tails.groupBy("lang").agg(F.max("total").alias("total"))
    out = stats.join(F.broadcast(own), "lang", "left").withColumn("among", F.when(F.col("total") >= LEAST_RECORDS, F.col("lang")).otherwise("")).drop("total")
    for s in STATISTICS:
        one = tails.filter(F.col("stat") == s).select(F.col("lang").alias("among"), F.col("value").alias(s), F.col("t").alias(f"_{s}"))
        out = out.join(F.broadcast(one), ["among", s], "left")
    score = sum((F.col(f"_{s}") for s in STATISTICS), F.lit(0.0)) / len(STATISTICS)
    most = F.greatest(*[F.col(f"_{s}") for s in STATISTICS])
    return out.withColumn("score", F.round(score, 6)).withColumn("most", F.round(most, 6)).select(*stats.columns, "score", "most")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and outlier scores of the records of the three raw tables."""
    lines = line_statistics(records(spark, sf_dir, "fineweb-edu", "sec", "case-law"))
    gone = standing_lines(table(spark, sf_dir, "sec", "sec_id", "filer", "text"), "sec_id", "filer", "text")
    gone = gone.groupBy(F.col("sec_id").alias("rec_id")).agg(F.collect_set("line_no").alias("gone")).withColumn("source", F.lit("sec"))
    stats = checkpointed(record_statistics(lines.join(gone, ["source", "rec_id"], "left")))
    return outlier_scores(stats)


def p6_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).withColumn("is_prose", ~junk()).drop("rest")


def junk():  # noqa: ANN201
    """Records that stand out from prose and whose text isn't sentences alone."""
    return (F.col("score") >= MIN_SCORE) & (F.col("prose_share") <= MAX_PROSE) & (F.col("rest") >= MIN_REST_WORDS)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).filter(junk()).orderBy(F.desc("score"), "source", "rec_id").select("source", "rec_id")
