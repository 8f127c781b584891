"""Queries of the duplicate and overlap operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import dedup as D
from corpusmill.plans.cleaning import sql_collapsed
from corpusmill.sources.tables import table

# The raw tables by source, with the columns of key and text.
RAW_TABLES = {"case-law": ("case_law", "case_id", "document"), "sec": ("sec", "sec_id", "text"), "fineweb-edu": ("fineweb_edu", "web_id", "text")}


def raw(spark, d, *sources):  # noqa: ANN001, ANN201
    """``doc_key``, ``source``, ``shard``, ``idx`` and ``text`` of the raw tables.

    ``doc_key`` orders documents by source, shard, place in the shard and id, as strings;
    documents delivered twice under one place get keys of their own.
    """
    out = None
    for source, (name, key, text) in RAW_TABLES.items():
        if sources and source not in sources:
            continue
        place = [F.lpad(F.col(c).cast("string"), 15, "0") for c in ("idx", key)]
        part = table(spark, d, name, key, "shard", "idx", text).select(F.concat_ws("/", F.lit(source), "shard", *place).alias("doc_key"), F.lit(source).alias("source"), "shard", "idx", F.col(text).alias("text"))
        out = part if out is None else out.unionByName(part)
    return out


def _case(spark, d):  # noqa: ANN001, ANN202
    return raw(spark, d, "case-law")


def _sigs(spark, d):  # noqa: ANN001, ANN202
    return _case(spark, d).select("doc_key", D.signature(D.shingle_hashes(F.col("text"))).alias("sig"))


def _grams(spark, d):  # noqa: ANN001, ANN202
    return D.eval_grams(table(spark, d, "eval_items", "prompt", "answer"), ["prompt", "answer"])


def dedup_normalize(spark, d):  # noqa: ANN001, ANN201
    return raw(spark, d).select("doc_key", F.length(T.normalized(F.col("text"))).alias("n_chars"))


def dedup_words(spark, d):  # noqa: ANN001, ANN201
    w = raw(spark, d).select("doc_key", T.words(F.col("text")).alias("w"))
    return w.select("doc_key", F.size("w").alias("n_words"), F.md5(F.array_join("w", " ")).alias("words_md5"))


def dedup_hash(spark, d):  # noqa: ANN001, ANN201
    return raw(spark, d).select("doc_key", F.md5(T.normalized(F.col("text"))).alias("hash"))


def dedup_ngrams(spark, d):  # noqa: ANN001, ANN201
    g = raw(spark, d).select("doc_key", F.array_sort(F.array_distinct(T.grams(T.words(F.col("text")), D.EVAL_WORDS))).alias("g"))
    return g.select("doc_key", F.size("g").alias("n_grams"), F.md5(F.array_join("g", "|")).alias("grams_md5"))


def dedup_shingles(spark, d):  # noqa: ANN001, ANN201
    g = raw(spark, d).select("doc_key", F.array_sort(T.shingles(T.words(F.col("text")), D.SHINGLE_WORDS)).alias("g"))
    return g.select("doc_key", F.size("g").alias("n_shingles"), F.md5(F.array_join("g", "|")).alias("shingles_md5"))


def minhash_sig(spark, d):  # noqa: ANN001, ANN201
    return _sigs(spark, d).select("doc_key", F.array_join(F.transform("sig", lambda x: x.cast("string")), "-").alias("sig"))


def lsh_candidates(spark, d):  # noqa: ANN001, ANN201
    """Every document with its signature class and how many other classes share a band with that."""
    return D.class_links(_sigs(spark, d), "doc_key", "sig").select(F.col("id").alias("doc_key"), "class_id", "n_links")


def near_dup_greedy(spark, d):  # noqa: ANN001, ANN201
    return D.near_duplicates(_case(spark, d), "doc_key", "text").select(F.col("id").alias("doc_key"))


def exact_dup(spark, d):  # noqa: ANN001, ANN201
    rows = raw(spark, d).withColumn("part", F.concat_ws("/", "source", "shard"))
    return D.exact_duplicates(rows, "doc_key", "part", "text").filter("is_dup").select("doc_key")


def eval_ngrams(spark, d):  # noqa: ANN001, ANN201
    return _grams(spark, d)


def decontam(spark, d):  # noqa: ANN001, ANN201
    return D.contaminated(raw(spark, d, *D.EVAL_SOURCES), "doc_key", "text", _grams(spark, d))


def corpus_verdict(spark, d):  # noqa: ANN001, ANN201
    return D.verdicts(raw(spark, d), "doc_key", "source", "shard", "text", _grams(spark, d)).select("doc_key", "verdict")


def corpus_report(spark, d):  # noqa: ANN001, ANN201
    rows = raw(spark, d)
    v = D.verdicts(rows, "doc_key", "source", "shard", "text", _grams(spark, d))
    sized = v.join(rows.select("doc_key", F.length(T.text_or_empty(F.col("text"))).alias("n")), "doc_key")
    kept = F.when(F.col("verdict") == "kept", F.col("n")).otherwise(0)
    by = [F.sum((F.col("verdict") == r).cast("int")).alias(r) for r in ("kept", "near_dup", "contaminated", "exact_dup")]
    return sized.groupBy("source").agg(*by, F.floor(F.sum(kept) / 4.0).alias("est_tokens"))


RAW = "docs AS (" + " UNION ALL ".join(
    f"SELECT '{s}/' || shard || '/' || lpad(CAST(idx AS VARCHAR), 15, '0') || '/' || lpad(CAST({k} AS VARCHAR), 15, '0') AS doc_key, '{s}' AS source, shard, idx, coalesce({t}, '') AS text FROM {n}" for s, (n, k, t) in RAW_TABLES.items()
) + ")"
WORDS = "words AS (SELECT doc_key, source, shard, text, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM docs)"


def sql_grams(w: str, n: int) -> str:
    return f"list_transform(range(1, len({w}) - {n} + 2), lambda i: array_to_string({w}[i:i+{n - 1}], ' '))"


SHINGLES = f"sh AS (SELECT doc_key, source, shard, CASE WHEN len(w) >= 5 THEN list_distinct({sql_grams('w', 5)}) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE CAST([] AS VARCHAR[]) END AS g FROM words)"
HASHES = "hs AS (SELECT doc_key, source, shard, list_transform(g, lambda s: CAST('0x' || substr(md5(s), 1, 7) AS BIGINT)) AS h FROM sh WHERE source = 'case-law')"
SIGS = "sigs AS (SELECT doc_key, [" + ", ".join(f"coalesce(list_min(list_transform(h, lambda x: (x * {a} + {b}) % {D.PRIME})), {D.PRIME})" for a, b in (D.permutation(i) for i in range(D.HASHES))) + "] AS sig FROM hs)"
BASE = f"{RAW}, {WORDS}, {SHINGLES}, {HASHES}, {SIGS}"
LINKS = f"""heads AS (SELECT sig, min(doc_key) AS head FROM sigs GROUP BY sig),
keyed AS (SELECT head, b, sig[b * 10 + 1:b * 10 + 10] AS band FROM heads, range({D.BANDS}) t(b)),
links AS (SELECT DISTINCT x.head AS a, y.head AS b FROM keyed x JOIN keyed y ON x.b = y.b AND x.band = y.band AND x.head < y.head)"""
GREEDY = """nodes AS (SELECT b AS id, list(a) AS smaller FROM links GROUP BY b),
ordered AS (SELECT *, row_number() OVER (ORDER BY id) AS rn FROM nodes),
walk AS (SELECT CAST(0 AS BIGINT) AS rn, CAST([] AS VARCHAR[]) AS gone
  UNION ALL SELECT o.rn, CASE WHEN len(list_filter(o.smaller, lambda x: NOT list_contains(walk.gone, x))) > 0 THEN list_append(walk.gone, o.id) ELSE walk.gone END FROM walk JOIN ordered o ON o.rn = walk.rn + 1),
near AS (SELECT unnest(gone) AS id FROM (SELECT gone FROM walk ORDER BY rn DESC LIMIT 1) UNION SELECT doc_key FROM sigs JOIN heads USING (sig) WHERE doc_key > head)"""
EVAL = f"ev AS (SELECT regexp_extract_all(lower(concat_ws(' ', prompt, answer)), '[a-z0-9]+') AS w FROM eval_items), eg AS (SELECT DISTINCT unnest({sql_grams('w', 13)}) AS gram FROM ev WHERE len(w) >= 13)"
LEAK = f"own AS (SELECT doc_key, unnest(list_distinct({sql_grams('w', 13)})) AS gram FROM words WHERE len(w) >= 13 AND source IN ('case-law', 'sec')), leak AS (SELECT DISTINCT doc_key FROM own WHERE gram IN (SELECT gram FROM eg))"
VERDICT = f"""flagged AS (SELECT d.doc_key, d.source, d.shard, d.text, md5({sql_collapsed('lower(text)')}) AS h, near.id IS NOT NULL AS is_near, leak.doc_key IS NOT NULL AS is_leak
  FROM docs d LEFT JOIN near ON near.id = d.doc_key LEFT JOIN leak ON leak.doc_key = d.doc_key),
verdict AS (SELECT doc_key, source, text, CASE WHEN is_near THEN 'near_dup' WHEN is_leak THEN 'contaminated'
  WHEN doc_key > min(CASE WHEN NOT is_near AND NOT is_leak THEN doc_key END) OVER (PARTITION BY source, shard, h) THEN 'exact_dup' ELSE 'kept' END AS verdict FROM flagged)"""
WHOLE = f"WITH RECURSIVE {BASE}, {LINKS}, {GREEDY}, {EVAL}, {LEAK}, {VERDICT}"

QUERIES = {f.__name__: f for f in (dedup_normalize, dedup_words, dedup_hash, dedup_ngrams, dedup_shingles, minhash_sig, lsh_candidates, near_dup_greedy, exact_dup, eval_ngrams, decontam, corpus_verdict, corpus_report)}

SQL = {
    "dedup_normalize": f"WITH {RAW} SELECT doc_key, CAST(length({sql_collapsed('lower(text)')}) AS INTEGER) AS n_chars FROM docs",
    "dedup_words": f"WITH {RAW}, {WORDS} SELECT doc_key, CAST(len(w) AS INTEGER) AS n_words, md5(coalesce(array_to_string(w, ' '), '')) AS words_md5 FROM words",
    "dedup_hash": f"WITH {RAW} SELECT doc_key, md5({sql_collapsed('lower(text)')}) AS hash FROM docs",
    "dedup_ngrams": f"WITH {RAW}, {WORDS}, g AS (SELECT doc_key, list_sort(list_distinct({sql_grams('w', 13)})) AS g FROM words) SELECT doc_key, CAST(len(g) AS INTEGER) AS n_grams, md5(coalesce(array_to_string(g, '|'), '')) AS grams_md5 FROM g",
    "dedup_shingles": f"WITH {RAW}, {WORDS}, {SHINGLES} SELECT doc_key, CAST(len(g) AS INTEGER) AS n_shingles, md5(coalesce(array_to_string(list_sort(g), '|'), '')) AS shingles_md5 FROM sh",
    "minhash_sig": f"WITH {BASE} SELECT doc_key, array_to_string(sig, '-') AS sig FROM sigs",
    "lsh_candidates": f"WITH {BASE}, {LINKS}, n AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY id) SELECT doc_key, head AS class_id, coalesce(n, 0) AS n_links FROM sigs JOIN heads USING (sig) LEFT JOIN n ON n.id = head",
    "near_dup_greedy": f"WITH RECURSIVE {BASE}, {LINKS}, {GREEDY} SELECT id AS doc_key FROM near",
    "exact_dup": f"WITH {RAW}, r AS (SELECT doc_key, row_number() OVER (PARTITION BY source, shard, md5({sql_collapsed('lower(text)')}) ORDER BY doc_key) AS rn FROM docs) SELECT doc_key FROM r WHERE rn > 1",
    "eval_ngrams": f"WITH {EVAL} SELECT gram FROM eg",
    "decontam": f"WITH {RAW}, {WORDS}, {EVAL}, {LEAK} SELECT doc_key FROM leak",
    "corpus_verdict": f"{WHOLE} SELECT doc_key, verdict FROM verdict",
    "corpus_report": f"{WHOLE} SELECT source, " + ", ".join(f"count(*) FILTER (verdict = '{r}') AS {r}" for r in ("kept", "near_dup", "contaminated", "exact_dup")) + ", CAST(floor(coalesce(sum(length(text)) FILTER (verdict = 'kept'), 0) / 4.0::DOUBLE) AS BIGINT) AS est_tokens FROM verdict GROUP BY source",
}
