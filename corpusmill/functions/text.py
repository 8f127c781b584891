"""Column builders for text, JVM-side: lines, white space, words, n-grams and ratios.

White space and line ends follow Unicode, as the cleaning rules ask; the classes are
spelled out so that other regular-expression engines can share them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space and line ends.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computed once a row: a lambda would compute what it captures for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_or_empty(c: Column) -> Column:
    """A null text counts as the empty text."""
    return F.coalesce(c, F.lit(""))


def lines(c: Column) -> Column:
    """The lines of a text."""
    return F.split(c, LINE_END)


def collapsed(c: Column) -> Column:
    """Runs of white space as one space, none at either end."""
    return F.trim(F.regexp_replace(c, SPACE + "+", " "))


def normalized(c: Column) -> Column:
    """Lower case with white space collapsed: the key of exact copies."""
    return collapsed(F.lower(text_or_empty(c)))


def tokens(c: Column) -> Column:
    """White-space words; an empty array for blank texts."""
    return F.filter(F.split(collapsed(text_or_empty(c)), " "), lambda w: w != "")


def words(c: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit("([a-z0-9]+)"), F.lit(1))


def grams(items: Column, n: int) -> Column:
    """All runs of ``n`` items, joined by spaces, in order; none where there are fewer items."""
    none = F.array().cast("array<string>")

    def of(w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) >= n, every).otherwise(none)

    return let(items, of)


def shingles(items: Column, k: int = 5) -> Column:
    """Distinct runs of ``k`` words; all words joined where there are fewer; none of none."""
    none = F.array().cast("array<string>")
    return let(items, lambda w: F.when(F.size(w) >= k, F.array_distinct(grams(w, k))).when(F.size(w) > 0, F.array(F.array_join(w, " "))).otherwise(none))


def nonalnum_ratio(c: Column) -> Column:
    """1 minus the share of ASCII letters and digits; 1 for the empty text."""
    return F.when(F.length(c) == 0, F.lit(1.0)).otherwise(F.lit(1.0) - F.try_divide(F.length(F.regexp_replace(c, "[^A-Za-z0-9]", "")).cast("double"), F.length(c)))


def ascii_ratio(c: Column) -> Column:
    """The share of ASCII characters; 0 for the empty text."""
    return F.coalesce(F.try_divide(F.length(F.regexp_replace(c, r"[^\x00-\x7f]", "")).cast("double"), F.length(c)), F.lit(0.0))


def top_run_share(items: Column, top: int) -> Column:
    """The share of ``items`` that their ``top`` most frequent values take; null of none.

    Values are sorted inside the row and their runs measured, so nothing is shuffled.
    """

    def share(ranked: Column) -> Column:
        n = F.size(ranked)
        starts = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: (i == 1) | (F.get(ranked, i - 1) != F.get(ranked, i - 2)))
        runs = let(starts, lambda s: F.zip_with(s, F.concat(F.slice(s, F.lit(2), F.size(s)), F.array(n + 1)), lambda a, b: b - a))
        mass = F.aggregate(F.slice(F.sort_array(runs, asc=False), 1, top), F.lit(0), lambda a, b: a + b)
        return F.when(n > 0, mass.cast("double") / n)

    return let(F.array_sort(items), share)
