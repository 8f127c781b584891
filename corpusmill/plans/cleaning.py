"""Queries of the cleaning operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions import text as T
from corpusmill.operators import cleaning as C
from corpusmill.sources.tables import table

SHARDS = 4
CAP = 20_000.0
SLICE = "sec-train-00000"


def docs(spark: SparkSession, d: str) -> DataFrame:
    shard = F.pmod(F.col("doc_id"), F.lit(SHARDS)).cast("int").alias("shard")
    return table(spark, d, "documents", "doc_id", "source", "text").filter("source is not null").select("doc_id", "source", "text", shard)


def chain(spark: SparkSession, d: str, ocr: bool = True) -> DataFrame:
    words = table(spark, d, "wordlist", "word") if ocr else None
    return C.clean(docs(spark, d), "doc_id", "text", F.col("source") == "case-law", words)


def clean_line_stats(spark, d):  # noqa: ANN001, ANN201
    rows = docs(spark, d).select("doc_id", F.posexplode(F.transform(T.lines(T.text_or_empty(F.col("text"))), T.collapsed)).alias("line_no", "line"))
    return rows.select("doc_id", "line_no", F.length("line").alias("n_chars"), F.bround(T.nonalnum_ratio(F.col("line")), 6).alias("ratio"))


def clean_filter_lines(spark, d):  # noqa: ANN001, ANN201
    return docs(spark, d).select("doc_id", F.md5(C.filter_lines(F.col("text"))).alias("text_md5"))


def clean_strip_boilerplate(spark, d):  # noqa: ANN001, ANN201
    return docs(spark, d).select("doc_id", F.md5(C.strip_boilerplate(T.text_or_empty(F.col("text")))).alias("text_md5"))


def clean_length_gate(spark, d):  # noqa: ANN001, ANN201
    n = docs(spark, d).select("doc_id", F.length(C.strip_boilerplate(C.filter_lines(F.col("text")))).alias("clean_chars"))
    return n.withColumn("too_short", F.col("clean_chars") < C.SHORTEST_TEXT)


def clean_repetition(spark, d):  # noqa: ANN001, ANN201
    r = docs(spark, d).select("doc_id", C.repetition(C.strip_boilerplate(C.filter_lines(F.col("text")))).alias("r"))
    return r.select("doc_id", F.bround("r", 6).alias("top_share"), (F.col("r") > C.MOST_REPEATED).alias("repetitive"))


def clean_ascii_ratio(spark, d):  # noqa: ANN001, ANN201
    return docs(spark, d).select("doc_id", F.bround(T.ascii_ratio(T.text_or_empty(F.col("text"))), 6).alias("ratio"))


def clean_language_gate(spark, d):  # noqa: ANN001, ANN201
    return docs(spark, d).select("doc_id", C.is_english(C.strip_boilerplate(C.filter_lines(F.col("text")))).alias("english"))


def clean_language_detect(spark, d):  # noqa: ANN001, ANN201
    """The language gate with a detector for its middle band."""
    body = C.strip_boilerplate(C.filter_lines(F.col("text")))
    return docs(spark, d).select("doc_id", T.let(body, lambda b: C.is_english(b, C.english_words(b))).alias("english"), T.let(body, C.english_words).alias("detected"))


def clean_ocr_ratio(spark, d):  # noqa: ANN001, ANN201
    out = C.nonword_ratio(docs(spark, d), "doc_id", "text", table(spark, d, "wordlist", "word"))
    return out.select("doc_id", "n_tokens", "n_unknown", F.bround("ratio", 6).alias("ratio"))


def clean_chain(spark, d):  # noqa: ANN001, ANN201
    return chain(spark, d).select("doc_id", "reason", "raw_chars", "clean_chars", F.md5("clean_text").alias("text_md5"))


def clean_budget(spark, d):  # noqa: ANN001, ANN201
    return C.within_budget(chain(spark, d), ["source", "shard"], "doc_id", CAP).select("doc_id", "source", "shard", "reason")


def clean_report(spark, d):  # noqa: ANN001, ANN201
    return C.report(chain(spark, d), "source", "shard")


def firsts(spark, d, n):  # noqa: ANN001, ANN201
    """The rows of each source's ``n`` smallest ids; only ids are ranked, and every task passes on no more than ``n`` of them a source."""
    order = Window.partitionBy("source").orderBy("doc_id")
    ids = table(spark, d, "documents", "doc_id", "source").filter("source is not null").withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= n)
    return docs(spark, d).join(ids.select("doc_id"), "doc_id", "left_semi")


def smoke_excerpt(spark, d):  # noqa: ANN001, ANN201
    rows = C.clean(firsts(spark, d, 10), "doc_id", "text")
    flat = lambda c, n: F.replace(F.substring(c, 1, n), F.lit("\n"), F.lit(" "))
    shown = F.when(F.col("reason") == "kept", flat(F.col("clean_text"), 240)).otherwise(flat(T.text_or_empty(F.col("text")), 160))
    return rows.select("doc_id", "source", "reason", F.md5(shown).alias("excerpt_md5"))


def source_yield(spark, d):  # noqa: ANN001, ANN201
    by = chain(spark, d, ocr=False).groupBy("source").agg(
        F.count("*").alias("n"), F.sum((F.col("reason") == "kept").cast("int")).alias("kept"), F.sum("raw_chars").alias("raw"), F.sum(F.when(F.col("reason") == "kept", F.col("clean_chars")).otherwise(0)).alias("clean")
    )
    return by.select("source", "n", "kept", F.bround(F.col("raw") / F.col("n"), 3).alias("avg_raw"), F.bround(F.col("clean") / F.col("n"), 3).alias("avg_clean"), F.floor(F.col("clean") / 4).alias("est_tokens"))


def _ocr(spark, d):  # noqa: ANN001, ANN202
    """``source``, ``ratio`` to six decimals and the number ``n`` of kept texts that have it: at most a million rows a source."""
    count = C.word_tester(table(spark, d, "wordlist", "word"))
    kept = chain(spark, d, ocr=False).filter("reason = 'kept'").select("source", count(F.col("clean_text")).alias("c")).filter(F.col("c.n_tokens") >= C.FEWEST_WORDS)
    ratio = F.col("c.n_unknown").cast("double") / F.col("c.n_tokens")
    return kept.select("source", ratio.alias("exact"), F.bround(ratio, 6).alias("ratio"))


def ocr_percentiles(spark, d):  # noqa: ANN001, ANN201
    by = _ocr(spark, d).groupBy("source", "ratio").agg(F.count("*").alias("n"))
    w = Window.partitionBy("source")
    rows = by.withColumn("upto", F.sum("n").over(w.orderBy("ratio"))).withColumn("total", F.sum("n").over(w))
    at = F.floor(F.col("p") / 100 * (F.col("total") - 1)) + 1
    ranks = rows.select("*", F.explode(F.array(*[F.lit(p) for p in (50, 75, 90, 95, 99)])).alias("p"))
    return ranks.filter((F.col("upto") >= at) & (F.col("upto") - F.col("n") < at)).select("source", "p", "ratio")


def ocr_thresholds(spark, d):  # noqa: ANN001, ANN201
    over = [F.sum((F.col("exact") > t / 100).cast("int")).alias(f"over_{t}") for t in (3, 5, 10, 20)]
    return _ocr(spark, d).groupBy("source").agg(F.count("*").alias("n"), *over)


def scan_sample(spark, d):  # noqa: ANN001, ANN201
    return firsts(spark, d, 20).select("source", "doc_id", F.length(T.text_or_empty(F.col("text"))).alias("n_chars"))


def scan_shard_slice(spark, d):  # noqa: ANN001, ANN201
    """One shard of one source; the shard's name is pushed to the scan."""
    return table(spark, d, "sec", "sec_id", "shard", "idx").filter(F.col("shard") == SLICE).select("sec_id", "idx")


def scan_sources(spark, d):  # noqa: ANN001, ANN201
    """Documents and characters by source and shard over all raw tables."""
    from corpusmill.plans.dedup import raw

    return raw(spark, d).groupBy("source", "shard").agg(F.count("*").alias("n"), F.sum(F.length(T.text_or_empty(F.col("text")))).alias("chars"))


def scan_lines(spark, d):  # noqa: ANN001, ANN201
    rows = docs(spark, d).select("doc_id", F.posexplode(T.lines(T.text_or_empty(F.col("text")))).alias("idx", "line"))
    return rows.filter(T.collapsed(F.col("line")) != "").select("doc_id", "idx", F.md5("line").alias("line_md5"))


def sink_corpus_line(spark, d):  # noqa: ANN001, ANN201
    rows = chain(spark, d).filter("reason = 'kept'")
    return rows.select("doc_id", F.md5(T.collapsed(F.col("clean_text"))).alias("line_md5"))


# ---- SQL -------------------------------------------------------------------------------

WS, EOL = T.SPACE, T.LINE_END
BOILER = C.BOILER
DOCS = f"docs AS (SELECT doc_id, source, coalesce(text, '') AS text, CAST(doc_id % {SHARDS} AS INTEGER) AS shard FROM documents WHERE source IS NOT NULL)"


def sql_collapsed(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def sql_ratio(x: str) -> str:
    return f"(CASE WHEN length({x}) = 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - CAST(length(regexp_replace({x}, '[^A-Za-z0-9]', '', 'g')) AS DOUBLE) / length({x}) END)"


def sql_lines(x: str) -> str:
    return f"string_split_regex({x}, '{EOL}')"


FILTERED = f"list_filter(list_transform({sql_lines('text')}, lambda x: {sql_collapsed('x')}), lambda x: length(x) >= 40 AND {sql_ratio('x')} <= 0.30::DOUBLE)"
BODY = f"body AS (SELECT doc_id, source, shard, text, array_to_string(list_filter({FILTERED}, lambda x: NOT regexp_matches(x, '{BOILER}')), chr(10)) AS body FROM docs)"
ASCII = "coalesce(CAST(length(regexp_replace({0}, '[^\\x00-\\x7f]', '', 'g')) AS DOUBLE) / nullif(length({0}), 0), 0.0::DOUBLE)"
ENGLISH = f"english AS (SELECT doc_id, {ASCII.format('substr(body, 1, 5000)')} AS a FROM body)"
GRAMS = f"toks AS (SELECT doc_id, list_filter(string_split({sql_collapsed('body')}, ' '), lambda w: w <> '') AS w FROM body)"
REP = """grams AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) AS g FROM toks WHERE len(w) >= 8),
counted AS (SELECT doc_id, g, count(*) AS c FROM grams GROUP BY ALL),
ranked AS (SELECT doc_id, c, row_number() OVER (PARTITION BY doc_id ORDER BY c DESC) AS rn, sum(c) OVER (PARTITION BY doc_id) AS total FROM counted),
reps AS (SELECT doc_id, CAST(sum(c) FILTER (rn <= 10) AS DOUBLE) / any_value(total) AS share FROM ranked GROUP BY doc_id),
rep AS (SELECT toks.doc_id, coalesce(share, 0.0::DOUBLE) AS share FROM toks LEFT JOIN reps USING (doc_id))"""
FIRST = """first AS (SELECT body.*, length(body) AS clean_chars, length(text) AS raw_chars,
  CASE WHEN length(body) < 600 THEN 'too_short' WHEN share > 0.5::DOUBLE THEN 'repetitive'
       WHEN NOT (CASE WHEN a >= 0.99::DOUBLE THEN true WHEN a < 0.90::DOUBLE THEN false ELSE a > 0.95::DOUBLE END) THEN 'non_english' ELSE 'kept' END AS reason0
  FROM body JOIN rep USING (doc_id) JOIN english USING (doc_id))"""
OCR = """ocrw AS (SELECT doc_id, unnest(regexp_extract_all(lower({0}), '[a-z]{{3,}}')) AS w FROM {1}),
ocr AS (SELECT doc_id, count(*) AS n, count(*) FILTER (w NOT IN (SELECT lower(word) FROM wordlist WHERE word IS NOT NULL)) AS bad FROM ocrw GROUP BY doc_id)"""
CHAIN = f"""WITH {DOCS}, {BODY}, {ENGLISH}, {GRAMS}, {REP}, {FIRST}, {OCR.format('body', "(SELECT * FROM first WHERE reason0 = 'kept' AND source = 'case-law')")},
chain AS (SELECT first.*, CASE WHEN reason0 = 'kept' AND source = 'case-law' AND n >= 50 AND CAST(bad AS DOUBLE) / n > 0.20::DOUBLE THEN 'ocr' ELSE reason0 END AS reason FROM first LEFT JOIN ocr USING (doc_id))"""
SOFT = f"WITH {DOCS}, {BODY}, {ENGLISH}, {GRAMS}, {REP}, {FIRST}, chain AS (SELECT *, reason0 AS reason FROM first)"
RATIOS = SOFT + ", kept AS (SELECT * FROM chain WHERE reason = 'kept'), " + OCR.format("body", "kept") + ", ratios AS (SELECT source, doc_id, CAST(bad AS DOUBLE) / n AS ratio FROM ocr JOIN kept USING (doc_id) WHERE n >= 50)"

QUERIES = {
    f.__name__: f
    for f in (
        clean_line_stats, clean_filter_lines, clean_strip_boilerplate, clean_length_gate, clean_repetition, clean_ascii_ratio, clean_language_gate, clean_ocr_ratio, clean_chain, clean_budget,
        clean_report, smoke_excerpt, source_yield, ocr_percentiles, ocr_thresholds, scan_sample, scan_shard_slice, scan_sources, scan_lines, sink_corpus_line, clean_language_detect,
    )
}

SQL = {
    "clean_line_stats": f"WITH {DOCS}, l AS (SELECT doc_id, list_transform({sql_lines('text')}, lambda x: {sql_collapsed('x')}) AS ls FROM docs), u AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM l) SELECT doc_id, CAST(i AS INTEGER) AS line_no, CAST(length(line) AS INTEGER) AS n_chars, round_even({sql_ratio('line')}, 6) AS ratio FROM u",
    "clean_filter_lines": f"WITH {DOCS} SELECT doc_id, md5(array_to_string({FILTERED}, chr(10))) AS text_md5 FROM docs",
    "clean_strip_boilerplate": f"WITH {DOCS} SELECT doc_id, md5(array_to_string(list_filter({sql_lines('text')}, lambda x: NOT regexp_matches(x, '{BOILER}')), chr(10))) AS text_md5 FROM docs",
    "clean_length_gate": f"WITH {DOCS}, {BODY} SELECT doc_id, CAST(length(body) AS INTEGER) AS clean_chars, length(body) < 600 AS too_short FROM body",
    "clean_repetition": f"WITH {DOCS}, {BODY}, {GRAMS}, {REP} SELECT doc_id, round_even(share, 6) AS top_share, share > 0.5::DOUBLE AS repetitive FROM rep",
    "clean_ascii_ratio": f"WITH {DOCS} SELECT doc_id, round_even({ASCII.format('text')}, 6) AS ratio FROM docs",
    "clean_language_gate": f"WITH {DOCS}, {BODY}, {ENGLISH} SELECT doc_id, CASE WHEN a >= 0.99::DOUBLE THEN true WHEN a < 0.90::DOUBLE THEN false ELSE a > 0.95::DOUBLE END AS english FROM english",
    "clean_ocr_ratio": f"WITH {DOCS}, {OCR.format('text', 'docs')} SELECT doc_id, CAST(coalesce(n, 0) AS INTEGER) AS n_tokens, CAST(coalesce(bad, 0) AS BIGINT) AS n_unknown, round_even(CASE WHEN n >= 50 THEN CAST(bad AS DOUBLE) / n ELSE 0.0 END, 6) AS ratio FROM docs LEFT JOIN ocr USING (doc_id)",
    "clean_chain": f"{CHAIN} SELECT doc_id, reason, CAST(raw_chars AS INTEGER) AS raw_chars, CAST(clean_chars AS INTEGER) AS clean_chars, md5(CASE WHEN reason = 'kept' THEN body ELSE '' END) AS text_md5 FROM chain",
    "clean_budget": f"{CHAIN}, run AS (SELECT *, coalesce(sum(CASE WHEN reason = 'kept' THEN clean_chars END) OVER (PARTITION BY source, shard ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM chain) SELECT doc_id, source, shard, reason FROM run WHERE spent / 4.0::DOUBLE < {CAP}",
    "clean_report": f"{CHAIN}, g AS (SELECT source, shard, reason, count(*) AS n, sum(clean_chars) AS c FROM chain GROUP BY ALL), s AS (SELECT *, CASE WHEN reason = 'kept' THEN floor(c / 4.0::DOUBLE) ELSE 0 END AS est FROM g) SELECT source, reason, CAST(sum(n) AS BIGINT) AS n, CAST(sum(est) AS BIGINT) AS est_tokens FROM s GROUP BY ALL",
    "smoke_excerpt": f"{SOFT}, r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM chain) SELECT doc_id, source, reason, md5(replace(CASE WHEN reason = 'kept' THEN substr(body, 1, 240) ELSE substr(text, 1, 160) END, chr(10), ' ')) AS excerpt_md5 FROM r WHERE rn <= 10",
    "source_yield": f"{SOFT}, s AS (SELECT source, count(*) AS n, CAST(count(*) FILTER (reason = 'kept') AS BIGINT) AS kept, sum(raw_chars) AS raw, coalesce(sum(clean_chars) FILTER (reason = 'kept'), 0) AS clean FROM chain GROUP BY source) SELECT source, n, kept, round_even(CAST(raw AS DOUBLE) / n, 3) AS avg_raw, round_even(CAST(clean AS DOUBLE) / n, 3) AS avg_clean, CAST(floor(clean / 4.0::DOUBLE) AS BIGINT) AS est_tokens FROM s",
    "ocr_percentiles": f"{RATIOS}, r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ratio, doc_id) AS rn, count(*) OVER (PARTITION BY source) AS n FROM ratios), p AS (SELECT unnest([50, 75, 90, 95, 99]) AS p) SELECT source, CAST(p AS INTEGER) AS p, round_even(ratio, 6) AS ratio FROM r JOIN p ON rn = floor(p / 100.0::DOUBLE * (n - 1)) + 1",
    "ocr_thresholds": f"{RATIOS} SELECT source, count(*) AS n, " + ", ".join(f"count(*) FILTER (ratio > {t / 100}::DOUBLE) AS over_{t}" for t in (3, 5, 10, 20)) + " FROM ratios GROUP BY source",
    "scan_sample": f"WITH {DOCS}, r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM docs) SELECT source, doc_id, CAST(length(text) AS INTEGER) AS n_chars FROM r WHERE rn <= 20",
    "scan_shard_slice": f"SELECT sec_id, idx FROM sec WHERE shard = '{SLICE}'",
    "scan_sources": "SELECT source, shard, count(*) AS n, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS chars FROM (SELECT 'case-law' AS source, shard, document AS text FROM case_law UNION ALL SELECT 'sec', shard, text FROM sec UNION ALL SELECT 'fineweb-edu', shard, text FROM fineweb_edu) GROUP BY ALL",
    "clean_language_detect": f"WITH {DOCS}, {BODY}, {ENGLISH}, w AS (SELECT doc_id, regexp_extract_all(lower(substr(body, 1, 5000)), '[a-z0-9]+') AS w FROM body), d AS (SELECT doc_id, coalesce(CAST(len(list_filter(w, lambda x: x IN ({', '.join(repr(x) for x in C.ENGLISH_WORDS.split())}))) AS DOUBLE) / nullif(len(w), 0) >= {C.ENGLISH_SHARE}::DOUBLE, false) AS detected FROM w) SELECT doc_id, CASE WHEN a >= 0.99::DOUBLE THEN true WHEN a < 0.90::DOUBLE THEN false ELSE detected END AS english, detected FROM english JOIN d USING (doc_id)",
    "scan_lines": f"WITH {DOCS}, u AS (SELECT doc_id, unnest({sql_lines('text')}) AS line, unnest(range(len({sql_lines('text')}))) AS i FROM docs) SELECT doc_id, CAST(i AS INTEGER) AS idx, md5(line) AS line_md5 FROM u WHERE {sql_collapsed('line')} <> ''",
    "sink_corpus_line": f"{CHAIN} SELECT doc_id, md5({sql_collapsed('body')}) AS line_md5 FROM chain WHERE reason = 'kept'",
}
