"""Problem 3: evaluation texts that stand in training texts.

Every Arrow batch of training texts is a shard with its own suffix array over words: word
numbers are packed into sort keys of four words, the positions are sorted by
them, and every suffix of every test text is looked up by binary search. However many items
share a suffix, all of them are counted: of each record and item, the words of the item that
lie in any match are added up first, each suffix once, so a common phrase costs one sort and
only items with enough such words get their places in the record.
Matches that follow each other on a diagonal make the longest verbatim matches, which are
given with their places; a record whose verbatim matches with an item lie close enough
together is then aligned with it word by word, which bridges changed words, scanning
damage and page furniture.

Numbers of words come from the test texts alone, so words no test text holds end suffixes
early and need no room.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.arrow import map_arrow
from corpusmill.llm.repetition import records
from corpusmill.sources.tables import table

DEPTH = 4
MIN_RUN = 25
NEAR = 8
MIN_SEEDED = 10
#: About so many pairs of a record's match and an item's suffix are held at once; more are worked off in portions.
PAIRS = 1 << 20
MAX_STEP = 20
MIN_MATCHED = 0.75
ITEM_BLOCK = 20_000
SPLIT_WORD = re.compile(r"(?<=\w)[-¬­‐]\s*\r?\n\s*(?=\w)|­")
NOISE = {ord(c): None for c in "!\"#$%&'()*+,./:;<=>?@[\\]^_`{|}~·•¬­§©®¶†‡“”‘’«»…°¦¤"} | {ord(c): " " for c in "-–—‐/"}


def words_of(text: str) -> list[str]:
    """Lower-case words without marks; words parted at a line end are joined."""
    if "\n" in text or "­" in text:
        text = SPLIT_WORD.sub("", text)
    return text.lower().translate(NOISE).split()


def packed(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each position, the first three word numbers and the next DEPTH - 3, in two keys."""
    n = len(ids)
    tail = np.concatenate([ids, np.zeros(DEPTH, np.int64)])
    hi = (tail[:n] << 42) | (tail[1 : n + 1] << 21) | tail[2 : n + 2]
    lo = np.zeros(n, np.int64)
    for k in range(3, DEPTH):
        lo = (lo << 21) | tail[k : n + k]
    return hi, lo


def ranges(hi: np.ndarray, lo: np.ndarray, want_hi: np.ndarray, want_lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each wanted pair of keys, where its matches begin and end in the sorted keys."""
    left, right = np.searchsorted(hi, want_hi, "left"), np.searchsorted(hi, want_hi, "right")

    def bound(after: bool) -> np.ndarray:
        a, b = left.copy(), right.copy()
        while True:
            open_ = a < b
            if not open_.any():
                return a
            mid = (a + b) // 2
            value = lo[np.minimum(mid, len(lo) - 1)] if len(lo) else np.zeros(len(mid), np.int64)
            go = open_ & ((value <= want_lo) if after else (value < want_lo))
            a = np.where(go, mid + 1, a)
            b = np.where(open_ & ~go, mid, b)

    return bound(False), bound(True)


def grouped(names: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of each name 0 to ``n`` - 1 in order, and where each name's begin; -1 is no name."""
    order = np.argsort(names, kind="stable")
    return order, np.searchsorted(names[order], np.arange(n + 1))


def spread_out(groups: tuple[np.ndarray, np.ndarray], names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``names`` all places of its group: (index into ``names``, place)."""
    order, start = groups
    n = start[names + 1] - start[names]
    at = np.repeat(np.arange(len(names)), n)
    step = np.arange(len(at)) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n, n)
    return at, order[start[names][at] + step]


class Items:
    """The test texts: word numbers, their concatenated suffixes and the words of each."""

    def __init__(self, texts: dict[int, str]) -> None:
        self.words = {k: words_of(t) for k, t in texts.items()}
        self.number: dict[str, int] = {}
        ids, item, place = [], [], []
        for k, words in self.words.items():
            for i, w in enumerate(words):
                ids.append(self.number.setdefault(w, len(self.number) + 1))
                item.append(k)
                place.append(i)
            ids.append(0)
            item.append(-1)
            place.append(0)
        if len(self.number) >= 1 << 21:
            raise ValueError("a block of test texts holds over two million words; use smaller blocks")
        self.item, self.place = np.array(item, np.int64), np.array(place, np.int64)
        hi, lo = packed(np.array(ids, np.int64))
        tail = np.concatenate([np.array(ids, np.int64), np.zeros(DEPTH, np.int64)])
        whole = np.ones(len(ids), bool)
        for k in range(DEPTH):
            whole &= tail[k : len(ids) + k] > 0
        self.item, self.place, self.hi, self.lo = self.item[whole], self.place[whole], hi[whole], lo[whole]
        #: equal suffixes of different items are searched once
        keys = np.stack([self.hi, self.lo], 1)
        unique, self.of = np.unique(keys, axis=0, return_inverse=True) if len(keys) else (keys, np.empty(0, np.int64))
        self.search_hi, self.search_lo = unique[:, 0].copy(), unique[:, 1].copy()
        self.groups = grouped(self.of, len(unique))
        least = {k: least_seeded(len(w)) for k, w in self.words.items()}
        #: of each suffix, how many words of its item must lie in matches
        self.least = np.array([least[k] for k in self.item.tolist()], np.int64)
        self.few: dict[int, dict[tuple[str, ...], list[int]]] = {}
        for k, words in self.words.items():
            if 0 < len(words) < DEPTH:
                self.few.setdefault(len(words), {}).setdefault(tuple(words), []).append(k)


def near_word(a: str, b: str) -> bool:
    """Whether two words are one but for misread letters."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 2 or max(len(a), len(b)) < 3:
        return False
    # no more letters can match than the other word holds at all
    if 2.0 * min(sum(map(b.__contains__, a)), sum(map(a.__contains__, b))) / (len(a) + len(b)) < 0.7:
        return False
    return SequenceMatcher(None, a, b, autojunk=False).ratio() >= 0.7


def longest_run(item: list[str], window: list[str]) -> tuple[int, int]:
    """(running item words, of them matched) of the best local alignment of item and window.

    A matched word counts one, a word of the item that the record hasn't takes one off, and
    words of the record that the item hasn't take off a third each, at most three at a place.
    """
    known = set(item)
    blocks = SequenceMatcher(None, item, window, autojunk=False).get_matching_blocks()
    hits: list[tuple[int, int]] = []
    i0 = j0 = 0
    for b in blocks:
        # between blocks, words that are the same but for misread letters
        i, j = i0, j0
        while i < b.a and j < b.b:
            if window[j] not in known and near_word(item[i], window[j]):
                hits.append((i, j))
                i, j = i + 1, j + 1
            elif j + 1 < b.b and near_word(item[i], window[j] + window[j + 1]):
                hits.append((i, j))
                i, j = i + 1, j + 2
            elif b.a - i > b.b - j:
                i += 1
            elif b.a - i < b.b - j:
                j += 1
            else:
                i, j = i + 1, j + 1
        hits.extend((b.a + k, b.b + k) for k in range(b.size))
        i0, j0 = b.a + b.size, b.b + b.size
    best, best_run, score, start, matched = 0.0, (0, 0), 0.0, 0, 0
    before = None
    for i, j in hits:
        if before is not None:
            lost = i - before[0] - 1
            extra = max(0, j - before[1] - 1 - lost)
            score -= lost + min(3.0, extra / 3) + (6.0 if extra > 40 else 0.0)
        if before is None or score <= 0:
            score, start, matched = 0.0, i, 0
        score += 1
        matched += 1
        if score > best:
            best, best_run = score, (i - start + 1, matched)
        before = (i, j)
    return best_run


def cuts(group: np.ndarray, weight: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of the sorted ``group`` that part no group and weigh at most ``most`` together, or are one group."""
    edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])) if len(group) else np.zeros(1, np.int64)
    upto = np.concatenate([[0], np.cumsum(weight)])[edges]
    at = 0
    while at < len(edges) - 1:
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + most, "right")) - 1)
        yield slice(int(edges[at]), int(edges[to]))
        at = to


def paired(row: np.ndarray, name: np.ndarray, where: np.ndarray, items: Items) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place in the shard, item suffix) of all matches of each row and item that share enough words, in portions.

    No row and item is spread over two portions. An item is left out of a row only where its
    words in all matches of the row together are fewer than ``least_seeded``.
    """
    order = np.lexsort((where, name, row))
    row, name, where = row[order], name[order], where[order]
    # every name once a row, with its places there
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (name[1:] != name[:-1])
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, len(row)))
    once_row, once_name = row[first], name[first]
    start = items.groups[1]
    for part in cuts(once_row, start[once_name + 1] - start[once_name], PAIRS):
        at, entry = spread_out(items.groups, once_name[part])
        at += part.start
        # suffixes are numbered by item and place
        order = np.argsort(once_row[at] * len(items.of) + entry, kind="stable")
        at, entry = at[order], entry[order]
        r, item, place = once_row[at], items.item[entry], items.place[entry]
        same = (r[1:] == r[:-1]) & (item[1:] == item[:-1])
        words = np.append(np.where(same, np.minimum(place[1:] - place[:-1], DEPTH), DEPTH), DEPTH)
        starts = np.flatnonzero(np.concatenate([[True], ~same]))
        enough_words = np.add.reduceat(words, starts) >= items.least[entry[starts]]
        size = np.diff(np.append(starts, len(at)))
        keep = np.repeat(enough_words, size)
        group = np.repeat(np.arange(len(starts)), size)[keep]
        at, entry = at[keep], entry[keep]
        for few in cuts(group, count[at], PAIRS):
            n = count[at[few]]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(once_row[at[few]], n), where[np.repeat(first[at[few]], n) + step], np.repeat(entry[few], n)


def longest_match(diagonal: np.ndarray, place: np.ndarray) -> tuple[int, int]:
    """(words, place in the record) of the longest verbatim match of one cluster, sorted by diagonal and place."""
    fresh = np.ones(len(place), bool)
    fresh[1:] = (diagonal[1:] != diagonal[:-1]) | (place[1:] != place[:-1] + 1)
    starts = np.flatnonzero(fresh)
    sizes = np.diff(np.append(starts, len(place)))
    k = int(np.argmax(sizes))
    return int(sizes[k]) + DEPTH - 1, int(diagonal[starts[k]] + place[starts[k]])


def least_seeded(size: int) -> int:
    """How many words of an item of ``size`` words must lie in verbatim matches of DEPTH before it is aligned.

    Each word of a short item that may be another, and one that is misread, takes the
    words beside it that are too few for a match with it.
    """
    return min(MIN_SEEDED, max(DEPTH, size - DEPTH * (1 + size // 10)))


Match = tuple[int, int, int, int]


def search(texts: list[str | None], items: Items, min_run: int = MIN_RUN) -> list[tuple[int, int, int, int, int, int]]:
    """(row, item, running words, matched words, words of the longest verbatim match, its place) of the rows of one shard that hold seeds of an item close together."""
    number = items.number.get
    rows = [words_of(t) if t else [] for t in texts]
    best: dict[tuple[int, int], Match] = {}
    ranks: dict[tuple[int, int], tuple[bool, int, int]] = {}
    for size, phrases in items.few.items():
        heads = {p[0] for p in phrases}
        for r, words in enumerate(rows):
            if not heads.isdisjoint(words):
                for i in range(len(words) - size + 1):
                    for k in phrases.get(tuple(words[i : i + size]), ()):
                        best.setdefault((r, k), (size, size, size, i))
    sizes = np.array([len(r) + 1 for r in rows])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.zeros(begin[-1], np.int64)
    for r, at in zip(rows, begin):
        ids[at : at + len(r)] = [number(w, 0) for w in r]
    tail = np.concatenate([ids, np.zeros(DEPTH, np.int64)])
    whole = np.ones(len(ids), bool)
    for k in range(DEPTH):
        whole &= tail[k : len(ids) + k] > 0
    at = np.flatnonzero(whole)
    hi, lo = packed(ids)
    hi, lo = hi[at], lo[at]
    order = np.lexsort((lo, hi))  # the shard's suffix array, as deep as two keys
    at, hi, lo = at[order], hi[order], lo[order]
    first, last = ranges(hi, lo, items.search_hi, items.search_lo)
    found = np.flatnonzero(last > first)
    if len(found):
        n = (last - first)[found]
        own = np.repeat(found, n)
        where = at[np.repeat(first[found], n) + np.arange(len(own)) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)]
        row = np.searchsorted(begin, where, "right") - 1
        for row, where, entry in paired(row, own, where, items):
            item, place = items.item[entry], items.place[entry]
            diagonal = where - begin[row] - place
            order = np.lexsort((place, diagonal, item, row))
            row, item, diagonal, place, entry = row[order], item[order], diagonal[order], place[order], entry[order]
            # clusters: same row and item, diagonals that follow each other closely
            fresh = np.ones(len(row), bool)
            fresh[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > MAX_STEP)
            starts = np.flatnonzero(fresh)
            ends = np.append(starts[1:], len(row))
            some = (ends - starts) * DEPTH >= items.least[entry[starts]]
            for s, e in zip(starts[some].tolist(), ends[some].tolist()):
                seeded = {p + k for p in place[s:e].tolist() for k in range(DEPTH)}
                if len(seeded) < items.least[entry[s]]:
                    continue
                r, words = int(row[s]), items.words[int(item[s])]
                low = max(0, int(diagonal[s:e].min()) - NEAR)
                high = int(diagonal[s:e].max()) + len(words) + NEAR + 40
                run = longest_run(words, rows[r][low:high])
                key = (r, int(item[s]))
                # one that gives the item away stands before a longer one that doesn't
                rank = (enough(*run, len(words), min_run), *run)
                if rank > ranks.get(key, (False, 0, 0)):
                    ranks[key] = rank
                    best[key] = (*run, *longest_match(diagonal[s:e], place[s:e]))
    return [(r, k, *m) for (r, k), m in best.items()]


def enough(run: int, matched: int, size: int, min_run: int) -> bool:
    """Whether a run gives an item of ``size`` words away: ``min_run`` words, or a shorter item whole but for one word in ten."""
    if size >= min_run:
        return run >= min_run and matched >= MIN_MATCHED * run
    return run >= size - size // 10 and matched >= size - size // 10


def leaks(df: DataFrame, keys: list[str], text: str, items: dict[int, str], min_run: int = MIN_RUN) -> DataFrame:
    """``keys``, ``item_id``, ``run``, ``matched``, ``longest`` and ``word_at`` of every row that gives an item away.

    ``longest`` is the longest verbatim match in words and ``word_at`` its place among the
    words of the row. A row gives an item away when ``min_run`` running words of the item, or a shorter one whole but
    for one word in ten, stand in it. Null and empty rows and items never match. Items with equal
    text are all named. One narrow stage a block of ITEM_BLOCK items; the corpus isn't shuffled.
    """
    groups: dict[str, list[int]] = defaultdict(list)
    for k, t in items.items():
        if t and words_of(t):
            groups[" ".join(words_of(t))].append(k)
    heads = {ids[0]: text for text, ids in groups.items()}
    picked = df.select(*keys, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    out = None
    every = sorted(heads)
    for at in range(0, max(1, len(every)), ITEM_BLOCK):
        shared = df.sparkSession.sparkContext.broadcast({k: heads[k] for k in every[at : at + ITEM_BLOCK]})

        def make(shared=shared) -> Callable[[pa.RecordBatch], dict]:  # noqa: ANN001
            index = Items(shared.value)

            def work(batch: pa.RecordBatch) -> dict:
                texts = batch.column(len(keys)).to_pylist()
                found = []
                for a in range(0, len(texts), 1000):
                    found += [(a + f[0], *f[1:]) for f in search(texts[a : a + 1000], index, min_run)]
                found = [f for f in found if enough(f[2], f[3], len(index.words[f[1]]), min_run)]
                pick = pa.array([f[0] for f in found], pa.int32())
                return {k: batch.column(i).take(pick) for i, k in enumerate(keys)} | {c: [f[i] for f in found] for i, c in enumerate(("head", "run", "matched", "longest", "word_at"), 1)}

            return work

        part = map_arrow(picked, make, f"{kinds}, head bigint, run int, matched int, longest int, word_at int")
        out = part if out is None else out.unionByName(part)
    spread = [(ids[0], i) for ids in groups.values() for i in ids]
    names = df.sparkSession.createDataFrame(spread or [(-1, -1)], "head bigint, item_id bigint")
    return out.join(F.broadcast(names), "head").select(*keys, "item_id", "run", "matched", "longest", "word_at").distinct()


def eval_texts(spark: SparkSession, sf_dir: str, *columns: str) -> dict[int, str]:
    """The ``columns`` of eval_items joined by a space, a table of fixed size; null parts are left out."""
    rows = table(spark, sf_dir, "eval_items", "item_id", *columns).select("item_id", F.concat_ws(" ", *columns).alias("t"))
    return {r.item_id: r.t for r in rows.toLocalIterator() if r.t}


def p3_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and the prompts they give away, with the longest verbatim match and its place."""
    return leaks(records(spark, sf_dir, "case-law", "sec"), ["source", "rec_id"], "text", eval_texts(spark, sf_dir, "prompt"))


def p3_item_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``p3_matches``, of the whole items: prompt and answer."""
    return leaks(records(spark, sf_dir, "case-law", "sec"), ["source", "rec_id"], "text", eval_texts(spark, sf_dir, "prompt", "answer"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_matches(spark, sf_dir).select("source", "rec_id", "item_id").distinct()


def p3_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source``, ``rec_id`` and ``text`` of the records that give no item's prompt away."""
    return records(spark, sf_dir, "case-law", "sec").join(p3_found(spark, sf_dir).select("source", "rec_id").distinct(), ["source", "rec_id"], "left_anti")
