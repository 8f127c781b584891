"""The registered queries of this subpackage and the SQL that checks those SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import leaks, mixing, pairs, quality, repetition, scans, spam, splits, standing, tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": repetition.p1_found,
    "p1_shares": repetition.p1_shares,
    "p1_line_frequency": repetition.p1_line_frequency,
    "p2_found": standing.p2_found,
    "p2_cleaned": standing.p2_cleaned,
    "p3_found": leaks.p3_found,
    "p3_matches": leaks.p3_matches,
    "p3_item_matches": leaks.p3_item_matches,
    "p3_cleaned": leaks.p3_cleaned,
    "p4_found": scans.p4_found,
    "p4_repaired": scans.p4_repaired,
    "p5_found": splits.p5_found,
    "p5_report": splits.p5_report,
    "p6_found": quality.p6_found,
    "p6_statistics": quality.p6_statistics,
    "p7_found": pairs.p7_found,
    "p8_ids": tokens.p8_ids,
    "p9_mix": mixing.p9_mix,
    "p9_shares": mixing.p9_shares,
    "p9_marginals": mixing.p9_marginals,
    "p10_found": spam.p10_found,
    "p10_pages": spam.p10_pages,
}

_RECORDS = "recs AS (SELECT 'case-law' AS source, case_id AS rec_id, document AS text FROM case_law UNION ALL SELECT 'sec', sec_id, text FROM sec)"
_WINDOWS = f"""{_RECORDS}, w AS (SELECT source, rec_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM recs),
g AS (SELECT source, rec_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS g, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5),
twice AS (SELECT source, rec_id, i FROM (SELECT *, count(*) OVER (PARTITION BY source, rec_id, g) AS c FROM g) WHERE c > 1),
hit AS (SELECT source, rec_id, count(DISTINCT i + k) AS n FROM twice, range(5) r(k) GROUP BY ALL),
shares AS (SELECT source, rec_id, CAST(len(w) AS INTEGER) AS n_words, CAST(coalesce(n, 0) AS INTEGER) AS n_repeated, CASE WHEN len(w) > 0 THEN CAST(coalesce(n, 0) AS DOUBLE) / len(w) ELSE 0.0::DOUBLE END AS share FROM w LEFT JOIN hit USING (source, rec_id))"""
_LINES = """r AS (SELECT 'sec/' || sec_id AS rec, 'sec/' || filer AS host, text FROM sec UNION ALL SELECT 'case-law/' || case_id, 'case-law/' || court, document FROM case_law),
l AS (SELECT rec, host, unnest(string_split(text, chr(10))) AS raw FROM r WHERE text IS NOT NULL),
n AS (SELECT rec, host, trim(regexp_replace(lower(raw), '[\\t-\\r ]+', ' ', 'g')) AS line FROM l),
c AS (SELECT host, line, count(DISTINCT rec) AS d FROM n WHERE line <> '' AND host IS NOT NULL GROUP BY ALL),
f AS (SELECT host, count(*) AS size FROM r WHERE text IS NOT NULL AND host IS NOT NULL GROUP BY host),
often AS (SELECT host, line, 1 AS gone FROM c JOIN f USING (host) WHERE d >= 5 AND d >= size * 0.4::DOUBLE),
m AS (SELECT rec, count(*) AS n_lines, count(gone) AS n_removed FROM n LEFT JOIN often USING (host, line) WHERE line <> '' GROUP BY rec)"""

# The other queries' rules are no SQL; they are tested against brute force and planted cases.
SQL: dict[str, str] = {
    "p1_shares": f"WITH {_WINDOWS} SELECT * FROM shares",
    "p1_found": f"WITH {_WINDOWS} SELECT source, rec_id FROM shares WHERE share >= 0.30::DOUBLE",
    "p1_line_frequency": f"WITH {_LINES} SELECT rec, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_removed, 0) > coalesce(n_lines, 0) * 0.5 AS rejected FROM r LEFT JOIN m USING (rec)",
}
