"""Problem 4: text from scanned pages.

A frequency lexicon of the whole corpus tells words from damage. Strings outside it are
matched with it through a symmetric-delete index: both sides give the hashes of what is
left without up to two letters and meet in them, as a join. Candidates are weighed by an
edit distance in which letter shapes that readers confuse cost little; among close
candidates the word seen more often after the preceding word wins. Running headers,
footers and page numbers, and words parted at a line end, are found from the page's own
layout and the lexicon.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.arrow import map_arrow
from corpusmill.session import checkpointed
from corpusmill.sources.tables import table

#: A string is a word of the lexicon from this share of all words on, so at most 1 / LEXICON_SHARE words are broadcast.
LEXICON_SHARE = 2e-5
LEXICON_LEAST = 4
#: Names are rarer than words; they only serve as candidates for strings with signs inside.
NAME_SHARE = 5e-7
NAME_LEAST = 3
MAX_WEIGHT = 1.05
RATIO = 10
#: Lines in capitals that come back so often in one opinion, mostly amid sentences, are running headers.
HEADER_TIMES, HEADER_CHARS = 3, 60

# Shapes that readers of scanned pages confuse (read -> printed).
CONFUSED = (
    "c e,e c,l i,i l,f t,t f,cl d,d cl,ii u,u ii,rn m,m rn,q g,g q,li h,h li,vv w,w vv,1 l,1 i,0 o,5 s,8 b,6 b,9 g,ä a,ö o,ü u,á a,é e,h b,b h,n u,u n,o c,c o,a o,o a,v y,y v,r n,in m,m in,ni m,nn m,fi h,ri n,tl d,iii m"
)
PAIRS = frozenset(tuple(p.split(" ")) for p in CONFUSED.split(","))
MONTHS = frozenset("january february march april may june july august september october november december".split())
#: Words after which a number alone on the next line still belongs to the sentence.
LEADS = MONTHS | frozenset("page pages no some volume vol chapter section rep ald § article para paragraph v".split())

STRIP = ".,;:()[]\"“”?!—–‘’'…«»"
POSSESSIVE = re.compile(r"['’]s?$")
HYPHEN = "-¬­‐"
PAGE = re.compile(r"^\W*(?:p(?:age|g)?\.?\s*)?[\[(*\-–—~\s]*[\dlIOSo]{1,4}[\])*\-–—~.\s]*$", re.I)
PAGE_WORD = re.compile(r"^\W*(?:page|pg|p)\b\W*[\dlIOS]{1,4}(?:\s+of\s+\d+)?\W*$", re.I)
CITE = re.compile(r"^\W*[CG][il1!]t[ec]\s+as\b.*\d\W*$", re.I)
REPORTS = re.compile(r"^\W*\d+\s+.*\bREP[O0]RTS\W*$|\bREP[O0]RTS\s+\d+\W*$", re.I)
TERM = re.compile(r"\b(?:T[EF]RM|Term)\b.*[\dlIO]{4}\W*$")
VERSUS = re.compile(r"\b[vV][.,_]?\s")
#: How every line that the patterns above can match begins or ends: a figure, or a letter read for one, or a versus in it.
FIGURE = re.compile(r"\d|\b[vV][.,_]?(?:\s|$)|[lIOSo]\W*$")


def letters(s: str) -> str:
    return "".join(c for c in s.lower() if c.isalpha())


def base(token: str) -> str:
    """A token without the punctuation round it and without a possessive ending."""
    t = token.strip(STRIP)
    return POSSESSIVE.sub("", t) if t[-2:-1] in ("'", "’") and t[-1:] in ("s", "S") or t[-1:] in ("'", "’") else t


# ---- furniture -------------------------------------------------------------------------


def is_furniture(line: str, title: str, before: str, after: str) -> bool:
    """Whether a line is only a running header, footer or page number.

    ``title`` is the letters of the title at the opinion's head, ``before`` and ``after``
    the nearest lines of text.
    """
    s = line.strip()
    if not FIGURE.search(s):
        return False
    digits = sum(c.isdigit() for c in s)
    bare = letters(s)
    if digits and len(s) <= 14 and not bare.strip("lios") and PAGE.match(s):
        if re.fullmatch(r"\(\d{1,2}\)", s):
            return False
        last = before.split()[-1].strip(STRIP).lower() if before.split() else ""
        if s[0].isdigit() and not line.startswith("   ") and (last in LEADS or last.endswith("no")):
            return False
        if re.fullmatch(r"\d{1,2}[.)]", line.rstrip()) and int(re.sub(r"\D", "", s)) <= 12 and (not before or before.rstrip()[-1:] in ".?!:"):
            return False
        return True
    if PAGE_WORD.match(s) or CITE.match(s) and len(s) < 60 or REPORTS.search(s) and len(s) < 50:
        return True
    if TERM.search(s) and len(s) < 70 and ("court" in s.lower() or "c0urt" in s.lower() or s.upper() == s):
        return True
    if title and VERSUS.search(s + " ") and len(bare) <= len(title) * 1.6 + 6:
        part = re.sub(r"(?i)[,.]?\s*n[o0]\s*[.,]?\s*[\dlIOS][\dlIOS/-]*\W*$", "", s)
        got = letters(part)
        if got and SequenceMatcher(None, title, got, autojunk=False).ratio() >= 0.8:
            return True
    return False


# ---- lexicon ---------------------------------------------------------------------------


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """``word``, ``n`` and ``upper`` (times capitalised) of the corpus; parted words are joined."""
    joined = re.compile(rf"(?<=\w)[{HYPHEN}]\s*\n\s*(?=[a-z])")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw: Counter[str] = Counter()
            for t in batch.column(0).to_pylist():
                if t:
                    raw.update(joined.sub("", t).split())
            low: Counter[str] = Counter()
            up: Counter[str] = Counter()
            for token, n in raw.items():
                b = base(token)
                if b and b.replace("-", "").replace("'", "").isalpha():
                    low[b.lower()] += n
                    if b[0].isupper():
                        up[b.lower()] += n
            words = list(low)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([low[w] for w in words], pa.int64()), pa.array([up[w] for w in words], pa.int64())], ["word", "n", "upper"])

    parts = df.select(text).mapInArrow(run, "word string, n bigint, upper bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("upper").alias("upper"))


def lexicon(counts: DataFrame) -> tuple[dict[str, int], DataFrame, int]:
    """The words (broadcast size, at most 1 / LEXICON_SHARE of them), the words and names as a table, and the number of all words."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    least, least_name = max(LEXICON_LEAST, LEXICON_SHARE * total), max(NAME_LEAST, NAME_SHARE * total)
    lower = F.col("n") - F.col("upper")
    words = counts.filter((lower >= least) | (F.col("n") >= least) & (lower * 2 >= F.col("n")))
    known = {r.word: r.n for r in words.toLocalIterator()}
    name = (F.col("upper") >= least_name) & (F.col("upper") * 2 > F.col("n"))
    pool = counts.filter((lower >= least) | name).select("word", "n", (~(lower >= least)).alias("name"))
    return known, pool, total


# ---- lines -----------------------------------------------------------------------------


class Reader:
    """Judges one text after another against a lexicon; tokens met before are remembered."""

    def __init__(self, known: dict[str, int]) -> None:
        self.known = known
        self.memory: dict[str, str] = {}

    def state(self, token: str) -> str:
        """'' for a token in order, else the string that needs a look ('Xyz' for a name to judge)."""
        got = self.memory.get(token)
        if got is None:
            if len(self.memory) > 400_000:
                self.memory.clear()
            got = self.memory[token] = self._state(token)
        return got

    def _state(self, token: str) -> str:
        b = base(token)
        n = sum(c.isalpha() for c in b)
        if n < 2 or len(b) > 40:
            return ""
        if b.lower() in self.known and (b.islower() or b.isupper() or b[0].isupper() and b[1:].islower() or "-" in b):
            return ""
        if b.isalpha() and b.isascii():
            if b.islower():
                return b if n >= 3 else ""
            if b.isupper():
                return ""
            return b
        if "-" in b:
            parts = [p for p in b.split("-") if p]
            bad = [s for p in parts if (s := self._state(p))]
            return bad[0] if bad and all(c.isalpha() or c in "-'’" for c in b) is False else ""
        if sum(c.isdigit() for c in b) > max(2, n // 2) or b[0] in "$§#*<=@{\\/" or "/" in b or "=" in b or "(" in b:
            return ""
        odd = sum(not c.isalpha() or not c.isascii() for c in b)
        return b if n >= 2 and odd <= max(2, len(b) // 4) else ""

    def lines(self, text: str) -> tuple[list[tuple[int, str]], list[tuple[int, str, str]]]:
        """(line, kind) of what is certain and (line, string, word before) of what needs a look."""
        raw = text.split("\n")
        rows = [x.strip("\r") for x in raw]
        filled = [k for k, x in enumerate(rows) if x.strip()]
        if not filled:
            return [], []
        head = next((rows[k] for k in filled[:3] if VERSUS.search(rows[k]) and len(rows[k]) < 90), "")
        title = letters(head)
        sure: list[tuple[int, str]] = []
        body: list[int] = []
        capitals: dict[str, list[tuple[int, bool]]] = {}
        for at, k in enumerate(filled):
            x = rows[k]
            if len(x) <= 90 and at > 0 and rows[k] is not head:
                before = rows[body[-1]] if body else ""
                after = rows[filled[at + 1]] if at + 1 < len(filled) else ""
                if is_furniture(x, title, before, after):
                    sure.append((k, "furniture"))
                    continue
                if len(x) <= HEADER_CHARS and x.isupper():
                    capitals.setdefault(letters(x), []).append((k, bool(before) and before.rstrip()[-1:] not in ".?!:;"))
            body.append(k)
        headers = {k for name, own in capitals.items() if len(name) > 5 and len(own) >= HEADER_TIMES and sum(amid for _, amid in own) * 2 > len(own) for k, _ in own}
        if headers:
            sure += [(k, "furniture") for k in sorted(headers)]
            body = [k for k in body if k not in headers]
        look: list[tuple[int, str, str]] = []
        known = self.known
        split_first = False
        for at, k in enumerate(body):
            tokens = rows[k].split()
            start, stop = 0, len(tokens)
            if split_first:  # its first string ends the word of the line before
                start = 1
            split_first = False
            if at + 1 < len(body) and tokens:
                nxt = rows[body[at + 1]].split()
                if nxt and self.parted(tokens[-1], nxt[0], tokens[-2] if len(tokens) > 1 else ""):
                    sure.append((k, "broken_word"))
                    split_first = True
                    stop -= 1
            misread = False
            i = start
            while i < stop:
                s = self.state(tokens[i])
                if s:
                    a = base(tokens[i]).lower()
                    if i + 1 < stop and a.isalpha() and tokens[i][-1:].isalpha():
                        b = base(tokens[i + 1]).lower()
                        if b.isalpha() and known.get(a + b, 0) and (a not in known or b not in known):
                            misread = True
                            i += 2
                            continue
                    if i > start and a.isalpha() and tokens[i - 1][-1:].isalpha():
                        b = base(tokens[i - 1]).lower()
                        if b.isalpha() and known.get(b + a, 0) and len(b) > 0:
                            misread = True
                            i += 1
                            continue
                    look.append((k, s, base(tokens[i - 1]).lower() if i else ""))
                i += 1
            if misread:
                sure.append((k, "misread"))
        return sure, look

    def parted(self, left: str, right: str, before: str) -> bool:
        """Whether the last string of a line and the first of the next are one word."""
        a, b = left.lstrip(STRIP), base(right)
        if not a or not b or not b[0].isalpha():
            return False
        known = self.known
        mark = a[-1] in HYPHEN
        stem = a.rstrip(HYPHEN)
        if mark:
            if not stem or not stem[-1].isalpha() or left.strip() in HYPHEN:
                return False
            if a[-1] in "¬­":
                return True
            first = b.split("-")[0].lower()
            last = stem.split("-")[-1].lower()
            whole = known.get((last + first), 0)
            compound = known.get((stem + "-" + b).lower(), 0) or known.get((last + "-" + first), 0)
            if compound > whole:
                return False
            if whole:
                return True
            if b[0].isupper():
                return False
            return not (last in known and first in known and len(last) > 2 and len(first) > 2)
        if not a.isalpha() or not right[0].isalpha() or right[0].isupper() or left[-1] in STRIP:
            return False
        x, y = a.lower(), b.lower()
        if not y.isalpha():
            return False
        whole = known.get(x + y, 0)
        return bool(whole) and (x not in known or y not in known)


def read_lines(df: DataFrame, key: str, text: str, known: dict[str, int]) -> DataFrame:
    """(``id``, ``line_no``, ``kind``, ``string``, ``before``): certain kinds, or a string to look up."""
    shared = df.sparkSession.sparkContext.broadcast(known)
    kind = df.select(F.col(key)).schema[0].dataType.simpleString()

    def make() -> Callable[[pa.RecordBatch], dict]:
        reader = Reader(shared.value)

        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c: [] for c in ("id", "line_no", "kind", "string", "before")}
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not t:
                    continue
                sure, look = reader.lines(t)
                for k, what in sure:
                    for c, v in zip(out, (i, k, what, None, None)):
                        out[c].append(v)
                for k, s, before in look:
                    for c, v in zip(out, (i, k, None, s, before)):
                        out[c].append(v)
            return out

        return work

    return map_arrow(df.select(F.col(key).alias("id"), F.col(text).alias("t")), make, f"id {kind}, line_no int, kind string, string string, before string")


# ---- repairs ---------------------------------------------------------------------------


def deletes(word: str, most: int) -> set[str]:
    """The word and what is left of it without up to ``most`` letters."""
    out, level = {word}, {word}
    for _ in range(most):
        level = {w[:i] + w[i + 1 :] for w in level for i in range(len(w)) if len(w) > 1}
        out |= level
    return out


def delete_keys(words: DataFrame, column: str) -> DataFrame:
    """``column`` and ``key``: hashes of each word's deletes; signs inside a string are left out first."""

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            out, keys = [], []
            for w in batch.column(0).to_pylist():
                low = w.lower()
                plain = "".join(c for c in low if c.isalpha() and c.isascii())
                odd = len(low) - len(plain)
                own = {xxhash.xxh3_64_intdigest(d) for d in (deletes(plain, 2 if not odd else 1))}
                keys.extend(k - (1 << 64) if k >> 63 else k for k in own)
                out.extend([w] * len(own))
            return {column: out, "key": keys}

        return work

    return map_arrow(words.select(column), make, f"{column} string, key bigint")


PAIR_SHAPES = {read: tuple(p for r, p in PAIRS if r == read) for read, _ in PAIRS}


def weight(read: str, printed: str, most: float = 9.0) -> float:
    """Weighted edit distance from what was read to a word; confused shapes and signs cost 0.5, and ``most`` or more counts as 9.

    The same beginning and end are left out but for two characters, in which shapes of
    several letters may begin or end.
    """
    if abs(len(read) - len(printed)) > 2:
        return 9.0
    short = min(len(read), len(printed))
    head = 0
    while head < short and read[head] == printed[head]:
        head += 1
    if head == len(read) == len(printed):
        return 0.0
    tail = 0
    while tail < short - head and read[-1 - tail] == printed[-1 - tail]:
        tail += 1
    head, tail = max(0, head - 2), max(0, tail - 2)
    a, b = read[head : len(read) - tail], printed[head : len(printed) - tail]
    inf = 9.0
    rows = [[inf] * (len(b) + 1) for _ in range(len(a) + 1)]
    rows[0][0] = 0.0
    for i in range(len(a) + 1):
        x = a[i : i + 1]
        low = x.lower()
        sign = not (x.isalpha() and x.isascii())
        shapes = [(len(r), len(p), p) for m in (1, 2, 3) if i + m <= len(a) for r in (a[i : i + m].lower(),) for p in PAIR_SHAPES.get(r, ()) if len(r) + len(p) > 2]
        row = rows[i]
        for j in range(max(0, i - 3), min(len(b), i + 3) + 1):
            d = row[j]
            if d >= most:
                continue
            if x and j < len(b):
                y = b[j]
                cost = d if x == y else d + 0.3 if low == y else d + 0.5 if sign or (low, y) in PAIRS else d + 1.5
                if cost < rows[i + 1][j + 1]:
                    rows[i + 1][j + 1] = cost
            for m, n, p in shapes:
                if b.startswith(p, j) and d + 0.5 < rows[i + m][j + n]:
                    rows[i + m][j + n] = d + 0.5
            if x and d + 1.5 < rows[i + 1][j]:
                rows[i + 1][j] = d + 1.5
            if j < len(b) and d + 1.5 < row[j + 1]:
                row[j + 1] = d + 1.5
    return rows[-1][-1] if rows[-1][-1] < most else 9.0


def repairs(strings: DataFrame, pool: DataFrame) -> DataFrame:
    """``string``, ``repair``, ``cost`` and ``n``: candidates of each string that are close enough and frequent enough.

    ``strings`` has ``string`` and ``seen``, ``pool`` ``word``, ``n`` and ``name``. Names
    are candidates only of strings with signs inside or capitals amid letters.
    """
    left = delete_keys(strings, "string")
    right = delete_keys(pool.filter(F.length("word") >= 3), "word")
    met = left.join(right, "key").select("string", "word").distinct()
    met = met.join(pool, "word").join(strings, "string")

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            keep, costs = [], []
            for s, w, n, name, seen in zip(*(batch.column(i).to_pylist() for i in range(5))):
                plain = s.isalpha() and s.isascii() and (s.islower() or s[1:].islower())
                read = s if s[:1].islower() or not s[1:].islower() else s[:1].lower() + s[1:]
                if s[:1].isupper() and not plain:
                    read = s[:1].lower() + s[1:]
                cost = weight(read, w, MAX_WEIGHT + 0.01)
                ok = cost <= MAX_WEIGHT and n >= RATIO * seen if plain else cost <= MAX_WEIGHT
                if name and plain:
                    ok = False
                if plain and s[:1].isupper() and (cost > 0.55 or len(s) < 4):
                    ok = False
                if not plain and s.lower() == w and not any(c.islower() for c in s[1:]):
                    ok = False
                keep.append(ok)
                costs.append(cost)
            mask = pa.array(keep, pa.bool_())
            return {"string": batch.column(0).filter(mask), "repair": batch.column(1).filter(mask), "n": batch.column(2).filter(mask), "cost": pa.array(costs, pa.float64()).filter(mask)}

        return work

    # few bytes but much work a row: without this, they are one partition
    met = met.repartition(max(2, int(strings.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "string", "word")
    return map_arrow(met.select("string", "word", "n", "name", "seen"), make, "string string, repair string, n bigint, cost double")


def damage(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``line_no`` and ``kind`` of every line with damage of page or reader.

    Null and empty texts have none. Line numbers count the pieces between newlines. A line
    that is furniture has no other kind. Repeated keys give each line once.
    """
    counts = checkpointed(word_counts(df, text))
    known, pool, _ = lexicon(counts)
    found = checkpointed(read_lines(df, key, text, known))
    looked = found.filter("string is not null").withColumn("before", F.coalesce("before", F.lit("")))
    picked = chosen_repairs(df, text, found, pool, known)
    misread = looked.join(picked, ["string", "before"]).select("id", "line_no", F.lit("misread").alias("kind"))
    sure = found.filter("kind is not null").select("id", "line_no", "kind")
    return sure.unionByName(misread).distinct().withColumnRenamed("id", key)


def contexts(df: DataFrame, text: str, before: set[str], words: set[str]) -> DataFrame:
    """How often each of ``words`` follows each of ``before`` in the corpus; both are parts of the lexicon."""
    shared = df.sparkSession.sparkContext.broadcast((before, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = shared.value
        for batch in batches:
            seen: Counter[tuple[str, str]] = Counter()
            for t in batch.column(0).to_pylist():
                words_ = [x.strip(STRIP) for x in t.lower().split()] if t else []
                seen.update(p for p in zip(words_, words_[1:]) if p[1] in second and p[0] in first)
            pairs = list(seen)
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string()), pa.array([seen[p] for p in pairs], pa.int64())], ["before", "repair", "c"])

    return df.select(text).mapInArrow(run, "before string, repair string, c bigint").groupBy("before", "repair").agg(F.sum("c").alias("c"))


def chosen_repairs(df: DataFrame, text: str, found: DataFrame, pool: DataFrame, known: dict[str, int]) -> DataFrame:
    """``string``, ``before`` and the ``repair`` picked: lowest weight, then context, then frequency."""
    from pyspark.sql import Window

    uses = found.filter("string is not null").groupBy("string", F.coalesce("before", F.lit("")).alias("before")).agg(F.count("*").alias("uses"))
    strings = uses.groupBy("string").agg(F.sum("uses").alias("seen"))
    options = checkpointed(repairs(strings, pool))
    least = F.min("cost").over(Window.partitionBy("string"))
    close = options.withColumn("least", least).filter(F.col("cost") <= F.col("least") + 0.25)
    unsure = close.withColumn("k", F.count("*").over(Window.partitionBy("string"))).filter("k > 1").select("repair").distinct()
    words = {r.repair for r in unsure.toLocalIterator() if r.repair in known}
    befores = {w for w in known} if words else set()
    seen = contexts(df, text, befores, words)
    ranked = uses.join(close, "string").join(seen, ["before", "repair"], "left")
    order = Window.partitionBy("string", "before").orderBy(F.col("cost") - F.least(F.lit(0.3), F.log1p(F.coalesce("c", F.lit(0))) / 10), F.desc("n"), "repair")
    return ranked.withColumn("rn", F.row_number().over(order)).filter("rn = 1").select("string", "before", "repair")


def rebuild(text: str, marks: dict[int, set[str]], fixes: dict[tuple[int, str], str], reader: Reader) -> str:
    """The text as paragraphs: without furniture, with parted and split words joined and repairs put in."""
    known = reader.known
    paragraphs: list[str] = []
    parts: list[str] = []
    carry = ""
    blank = False
    width = max((len(x) for x in text.split("\n")), default=0)
    for k, raw in enumerate(text.split("\n")):
        line = raw.strip("\r")
        kinds = marks.get(k, set())
        if "furniture" in kinds:
            continue
        if not line.strip():
            blank = True
            continue
        starts = parts and not carry and (blank or line[:1] in " \t" or len(parts[-1]) < 0.55 * width and parts[-1][-1:] in ".?!:")
        blank = False
        if starts:
            paragraphs.append(" ".join(parts))
            parts = []
        tokens = line.split()
        out: list[str] = []
        i = 0
        while i < len(tokens):
            t = tokens[i]
            if i == 0 and carry:
                t, carry = carry + t, ""
            if i + 1 < len(tokens) and t[-1:].isalpha():
                a, b = base(t).lower(), base(tokens[i + 1]).lower()
                if a.isalpha() and b.isalpha() and known.get(a + b) and (a not in known or b not in known):
                    t, i = t + tokens[i + 1], i + 1
            s = base(t)
            fix = fixes.get((k, reader.state(t))) if s else None
            if fix:
                bad = reader.state(t)
                fix = fix.upper() if s.isupper() else fix[:1].upper() + fix[1:] if s[:1].isupper() and s[1:2].islower() else fix
                t = t.replace(bad, fix)
            out.append(t)
            i += 1
        if "broken_word" in kinds and out:
            carry = out.pop().rstrip(HYPHEN)
        if out:
            parts.append(" ".join(out))
    if carry:
        parts.append(carry)
    if parts:
        paragraphs.append(" ".join(parts))
    return "\n\n".join(paragraphs)


def repaired(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and ``text`` of every row, as continuous paragraphs without the damage found.

    Null texts stay null, empty ones empty. A text without damage is only unwrapped. Each
    text's marks and repairs are gathered by its key and joined to it.
    """
    known, pool, _ = lexicon(checkpointed(word_counts(df, text)))
    found = checkpointed(read_lines(df, key, text, known))
    picked = chosen_repairs(df, text, found, pool, known)
    looked = found.filter("string is not null").withColumn("before", F.coalesce("before", F.lit("")))
    fixes = looked.join(picked, ["string", "before"]).select("id", F.struct("line_no", F.lit(None).cast("string").alias("kind"), "string", "repair").alias("m"))
    kinds = found.filter("kind is not null").select("id", F.struct("line_no", "kind", F.lit(None).cast("string").alias("string"), F.lit(None).cast("string").alias("repair")).alias("m"))
    marks = fixes.unionByName(kinds).groupBy("id").agg(F.collect_set("m").alias("marks"))
    whole = df.select(F.col(key).alias("id"), F.col(text).alias("t")).join(marks, "id", "left")
    shared = df.sparkSession.sparkContext.broadcast(known)

    def make() -> Callable[[pa.RecordBatch], dict]:
        reader = Reader(shared.value)

        def work(batch: pa.RecordBatch) -> dict:
            out = []
            for t, m in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                kinds_, fixes_ = {}, {}
                for x in m or ():
                    if x["kind"]:
                        kinds_.setdefault(x["line_no"], set()).add(x["kind"])
                    else:
                        fixes_[x["line_no"], x["string"]] = x["repair"]
                out.append(None if t is None else rebuild(t, kinds_, fixes_, reader))
            return {"id": batch.column(0), "t": out}

        return work

    kind = whole.schema["id"].dataType.simpleString()
    return map_arrow(whole.select("id", "t", "marks"), make, f"id {kind}, t string").select(F.col("id").alias(key), F.col("t").alias(text))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damage(table(spark, sf_dir, "case_law", "case_id", "document"), "case_id", "document")


def p4_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(table(spark, sf_dir, "case_law", "case_id", "document"), "case_id", "document")
