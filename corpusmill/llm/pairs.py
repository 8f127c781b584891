"""Problem 7: broken prompt and response pairs, each with its defect.

Responses are sorted by text over the whole cluster, letters before marks, and each is
compared with its neighbour: a response that its successor continues in the middle of a
word is a shortened version, and one that another response to the same prompt continues
at a word's end is too. Lengths at which unfinished responses pile up are length limits.
The rules for copies, refusals, languages and unfinished ends then decide, the neighbours,
the prompt's longer words and a share over the whole table settling whether a last word is
a fragment.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string
from pyspark.sql.window import Window

from corpusmill.functions import text as T
from corpusmill.functions.arrow import map_arrow, slices
from corpusmill.session import checkpointed
from corpusmill.sources.tables import table

# Fillers, words no finished sentence ends with, and how refusals begin.
FILLERS = frozenset("n/a na null none nil undefined tbd todo ? - -- --- . .. ... … [no response] no response [no answer] no answer [empty] empty [blank]".split() + ["no response", "[no response]", "no answer", "[no answer]", "(no response)", "(none)", "<empty>"])
CONNECTORS = frozenset(
    "because while but which although and or nor the a an of in to with whereas as at by for from that if when where who whom whose its his her their "
    "each this these those since unless until so than through during under over between into onto upon without within against about besides despite "
    "toward towards including regarding concerning following across beyond after before is was were are be been being has had have would".split()
)
REFUSAL = re.compile(
    r"(?i)^\W*(?:(?:i[' ]?a?m|we[' ]?a?re)\s+(?:very\s+|truly\s+)?(?:sorry|afraid|unable|not able|not in a position)|(?:my\s+)?apolog\w+|sorry\b|unfortunately\b"
    r"|as an? (?:ai|artificial|language|assistant|large)|(?:i|we)\s+(?:can\s*not|can[’']?t|could not|couldn[’']t|won[’']?t|will not|do not|don[’']t|am unable|am not able|must decline|decline|have to decline|have no)\b"
    r"|(?:that|this|it|the answer|the information)\s+(?:is|was|are)\s+(?:not|n[’']t|nowhere)\s+(?:stated|given|mentioned|specified|provided|found|available|in the|contained|answerable|clear from|disclosed|something)"
    r"|the\s+(?:context|passage|text|document|excerpt|source)\s+(?:does\s*n[o’']t|doesn[’']?t|says nothing|is silent|gives no|contains no|provides no|offers no|never|has no)"
    r"|(?:no|not enough|insufficient)\s+(?:information|answer|context|data)\b|there is (?:no|not enough|insufficient)\s+(?:information|answer|context|data|mention)\b|(?:it is )?(?:impossible|not possible) to\b|nothing in the (?:context|passage|text)\b"
    r"|(?:my|our)\s+(?:guidelines|policy|policies|instructions|programming)\b|i[’']?(?:d| would| must)\s+(?:rather|prefer)\s+not\b|i\s+(?:refuse|decline)\b|i must (?:refuse|decline)\b)"
)
REFUSAL_CORE = re.compile(r"(?i)\b(?:i (?:can\s*not|can[’']?t|am unable to|am not able to|won[’']?t|must decline to)|(?:this|that) falls outside|(?:is|are) not (?:stated|given|mentioned) in the|am (?:unable|not able) to|consult a qualified)\b")
FUNCTION_WORDS = {
    "en": "the of and a an in to is was that it for on with as by at from this be are or which not each its under after during before i you",
    "de": "der die das und den dem des ein eine einer einem nicht mit von zu im am auf für fur ist wegen nach über uber ohne trotz wahrend während",
    "fr": "le la les des du de et un une en dans pour par sur pas est au aux que qui malgré malgre après apres sans lors à",
    "es": "el la los las de del y un una en para por con al que se sin tras durante fue",
    "it": "il lo la gli le di del della e un una in per con non è al che si senza dopo nella alla",
    "pt": "o a os as de do da e um uma em para por com não ao que se sem após durante",
    "nl": "de het een en van in op te met voor niet is aan bij na zonder door",
}
ASKING = frozenset("who what which when where why how whose whom".split())
LANGUAGES = {lang: frozenset(words.split()) for lang, words in FUNCTION_WORDS.items()}
SPOKEN = {w: tuple(lang for lang, own in LANGUAGES.items() if w in own) for w in frozenset().union(*LANGUAGES.values())}

WORD = re.compile(r"[^\W_]+")
LETTERS = re.compile(r"[^\W\d_]+(?:[’'-][^\W\d_]+)*")
FINISHED = re.compile(r"[.!?…。！？:;}\])\"'”’»]$")
ABBREVIATED = re.compile(r"(?:\bv|\bNo|\bRep|\bAld|\bpp?|\be\.g|\bi\.e)\.$")
BULLET = re.compile(r"(?m)^\s*(?:[-*•]|\d+[.)])\s")
INFLECTION = re.compile(r"(?:[’']?s|es|e?d|ing|ly)")
# A last word is a word where it is met inside sentences this often for each answer that ends on it.
TIMES_INSIDE = 8
SHORT_WORDS = 4


def script(text: str) -> str:
    """'latin' or the Unicode block name of most letters outside it."""
    if text.isascii():
        return "latin"
    letters = [c for c in text if c.isalpha()]
    other = [c for c in letters if ord(c) > 0x24F]
    if len(other) * 2 <= len(letters):
        return "latin"
    return unicodedata.name(other[0], "other").split()[0].lower()


def tongue(text: str) -> str:
    """The script, or for Latin letters the language with most function words, '' if unsure."""
    kind = script(text)
    if kind != "latin":
        return kind
    words = LETTERS.findall(text.lower())
    if len(words) < 3:
        return ""
    counts = Counter(w for w in words if w in SPOKEN)
    votes = dict.fromkeys(LANGUAGES, 0)
    for w, n in counts.items():
        for lang in SPOKEN[w]:
            votes[lang] += n
    best = max(votes, key=lambda lang: votes[lang])
    return best if votes[best] >= 0.15 * len(words) and votes[best] >= 1.5 else ""


def question_of(user: str) -> str:
    """The question or instruction: what follows the last blank line."""
    return re.split(r"\n\s*\n", user.strip())[-1].strip()


def aligned(a: list[str], b: list[str]) -> int:
    """Words that two texts have in common in order: the same beginning and end, and the blocks between."""
    short = min(len(a), len(b))
    head = next((i for i in range(short) if a[i] != b[i]), short)
    tail = next((i for i in range(short - head) if a[-1 - i] != b[-1 - i]), short - head)
    match = SequenceMatcher(None, a[head : len(a) - tail], b[head : len(b) - tail], autojunk=False)
    return head + tail + sum(m.size for m in match.get_matching_blocks())


def copies(answer: str, user: str) -> bool:
    """Whether the answer is the question, or the whole prompt, once or more times over, and next to nothing else.

    A few words may stand round it or be changed; words before the question, as 'Please
    answer', needn't come back.
    """
    said = [w.lower() for w in WORD.findall(answer)]
    size = next((n for n in range(3, len(said) // 2 + 1) if len(said) % n == 0 and said[n] == said[0] and said == said[:n] * (len(said) // n)), len(said))
    said = said[:size]
    question = question_of(user)
    lead, _, bare = question.partition(":")
    for asked in (question, bare if len(lead.split()) <= 3 else "", user):
        once = [w.lower() for w in WORD.findall(asked)]
        if len(once) < 3 or once[0] in ASKING and once[0] not in said:  # an answer puts its subject there
            continue
        for q in (once, once * max(1, round(len(said) / len(once)))):  # copies that differ are no exact repeats
            if not len(q) * 0.75 <= len(said) <= len(q) * 1.2 + 5:
                continue

            def enough(same: int, q: list[str] = q) -> bool:
                round_it = same >= 0.88 * len(q) and len(said) - same <= max(4, 0.15 * len(q))
                return round_it or said[0] in q and same >= 0.75 * len(q) and len(said) - same <= max(1, 0.1 * len(said))

            # no alignment has more words in common than the two hold, whatever their order
            if enough((Counter(q) & Counter(said)).total()) and enough(aligned(q, said)):
                return True
    return False


def unfinished(answer: str, user: str) -> tuple[str, str]:
    """('', '') for a finished answer, ('cut', '') for one surely cut, else ('open', last word), or ('loose', '') if only a full stop is missing.

    An answer of more than SHORT_WORDS words is cut where its last word begins a longer word
    of the prompt, unless that is an inflected form of it.
    """
    a = answer.rstrip()
    if a[:1] in "{[" and len(a) > 1 and BULLET.match(a) is None:
        depth = sum(a.count(c) for c in "{[") - sum(a.count(c) for c in "}]")
        return ("cut", "") if depth > 0 or a.count('"') % 2 else ("", "")
    if a.endswith(","):
        return "cut", ""
    if FINISHED.search(a) and not ABBREVIATED.search(a):
        return "", ""
    words = LETTERS.findall(a)
    if not words or not a[-1].isalnum():
        return "", ""
    last = re.split(r"\s", a)[-1].lower()
    last = LETTERS.findall(last)[-1] if LETTERS.findall(last) else last
    if last in CONNECTORS:
        return "cut", ""
    plain = last.replace("’", "'")
    own = {w.lower().replace("’", "'") for w in LETTERS.findall(user)}
    if plain in own or plain.removesuffix("'s") in own or not last.isalpha() and "'" not in plain:
        before = words[-2].lower() if len(words) > 1 else ""
        flow = [w.lower() for w in LETTERS.findall(user)]
        follow = {flow[i + 1] for i in range(len(flow) - 1) if flow[i] == before}
        if last not in follow and any(f.startswith(last) for f in follow):
            return "cut", ""
        return "loose", ""
    head = words[-1]
    if len(words) > SHORT_WORDS and len(head) > 1 and last == head.lower():
        longer = [w for w in LETTERS.findall(user) if len(w) > len(head) and w[1:].startswith(head[1:]) and w[0].lower() == head[0].lower()]
        if any(not INFLECTION.fullmatch(w[len(head) :].lower()) for w in longer):
            return "cut", ""
    return "open", last


def judged(df: DataFrame, key: str, user: str, answer: str, kind: str) -> DataFrame:
    """What the rules say of each row: ``defect`` ('' for none yet), ``loose``, ``last``, ``answer`` and ``asked``, the prompt's hash.

    ``last`` is the last word of an answer whose end is open; ``loose`` tells answers that end on a word of the prompt, without a stop.
    """

    def make() -> Callable[[pa.RecordBatch], dict]:
        def judge(u: str | None, a: str | None, k: str | None) -> tuple[str, str, bool]:
            if a is None or not a.strip("​﻿ \t\r\n\xa0") or not a.strip() or a.strip().lower() in FILLERS or not any(c.isalnum() for c in a):
                return "empty", "", False
            u = u or ""
            if copies(a, u):
                return "copies_question", "", False
            mine = tongue(a)
            if mine:
                theirs = tongue(u)
                if theirs and mine != theirs:
                    return "other_language", "", False
            if REFUSAL.search(a) or len(a) < 300 and REFUSAL_CORE.search(a):
                return "" if k == "unanswerable" else "refusal", "", False
            state, last = unfinished(a, u)
            return "truncated" if state == "cut" else "", last, state == "loose"

        def work(batch: pa.RecordBatch) -> dict:
            found = [judge(u, a, k) for u, a, k in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))]
            return {"k": batch.column(0), "defect": [f[0] for f in found], "last": [f[1] or None for f in found], "loose": [f[2] for f in found], "answer": batch.column(2), "asked": batch.column(4)}

        return work

    t = df.select(F.col(key)).schema[0].dataType.simpleString()
    picked = df.select(F.col(key).alias("k"), F.col(user).alias("u"), F.col(answer).alias("a"), F.col(kind).alias("t"), F.when(F.col(user).isNotNull(), F.xxhash64(user)).alias("asked"))
    return map_arrow(picked, make, f"k {t}, defect string, last string, loose boolean, answer string, asked bigint")


def sorted_neighbours(texts: DataFrame, columns: list[str]) -> DataFrame:
    """The ``columns`` of each row and ``following``, the answer of the next row in order.

    The rows are distinct and range-partitioned by their last column, or by both: a prompt
    and then the answer, in which letters and digits come before other characters, so that
    of all texts that go on from one, those that do so inside a word come next to it. A
    partition's last row meets the next partition's first through a table of a row each.
    """
    parts = max(2, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = F.regexp_replace("answer", r"([^\p{L}\p{N}])", "\ufffd$1")
    rows = texts.select(*columns).distinct().withColumn("_o", order)
    by = [*columns[:-1], "_o"]
    ordered = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_o")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at, before, first = TaskContext.get().partitionId(), None, True
        for batch in (x for b in batches for x in slices(b)):
            own = list(zip(*(c.to_pylist() for c in batch.columns)))
            pairs = list(zip([before, *own[:-1]] if before is not None else own[:-1], own if before is not None else own[1:]))
            out = [(*a, b[-1], at, "pair") for a, b in pairs if a[:-1] == b[:-1] and a[-1] and b[-1].startswith(a[-1])]
            out += [(*own[0], None, at, "first")] if first else []
            before, first = own[-1], False
            yield rows_of(out)
        if before is not None:
            yield rows_of([(*before, None, at, "last")])

    target = to_arrow_schema(_parse_datatype_string(f"{kinds}, following string, part int, role string"))

    def rows_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(target)], schema=target)

    met = checkpointed(ordered.mapInArrow(compare, f"{kinds}, following string, part int, role string"))
    # a row a partition; empty partitions leave gaps
    ends = met.filter("role <> 'pair'").withColumn("next", F.lead(F.struct(*columns)).over(Window.orderBy("part", "role")))
    on = [F.col("next")[c].eqNullSafe(F.col(c)) for c in columns[:-1]]
    across = ends.filter(F.col("role") == "last").filter(F.startswith(F.col("next.answer"), F.col("answer")))
    for c in on:
        across = across.filter(c)
    found = met.filter("role = 'pair'").select(*columns, "following")
    return found.unionByName(across.select(*columns, F.col("next.answer").alias("following")))


def shortened(answers: DataFrame) -> DataFrame:
    """``answer`` texts that some other answer goes on from inside a word, and ``longer``, whether that isn't an inflected form of its last word.

    ``longer`` is told of answers of more than SHORT_WORDS words only.
    """
    met = sorted_neighbours(answers, ["answer"]).filter(F.length("following") > F.length("answer")).withColumn("rest", F.expr("substr(following, length(answer) + 1)"))
    met = met.filter(F.col("rest").rlike(r"^[\p{L}\p{N}]") & F.col("answer").rlike(r"[\p{L}\p{N}]$"))
    longer = ~F.col("rest").rlike(rf"^{INFLECTION.pattern}(?:[^\p{{L}}\p{{N}}]|$)") & (F.size(F.split("answer", r"\s+")) > SHORT_WORDS)
    return met.groupBy("answer").agg(F.max(longer).alias("longer"))


def shortened_for_prompt(answers: DataFrame) -> DataFrame:
    """``asked`` and ``answer`` of more than SHORT_WORDS words from which another answer to the same prompt goes on with a further word."""
    goes_on = F.substring("following", F.length("answer") + 1, F.lit(2)).rlike(r"^\s?[\p{L}\p{N}]") & (F.size(F.split("answer", r"\s+")) > SHORT_WORDS)
    return sorted_neighbours(answers, ["asked", "answer"]).filter(goes_on).select("asked", "answer").distinct()


def length_limits(rows: DataFrame, times: float = 6.0, deviations: float = 8.0) -> DataFrame:
    """Lengths at which different unfinished answers pile up: ``size`` met ``times`` as often as the mean of the ten lengths round it.

    The surplus must also be ``deviations`` times what chance makes of such a mean, so the
    rule asks for the same evidence at every size of the table.
    """
    sizes = rows.filter("last is not null").select("answer").distinct().groupBy(F.length("answer").alias("size")).agg(F.count("*").alias("n"))
    near = sizes.select(F.explode(F.sequence(F.col("size") - 5, F.col("size") + 5)).alias("size"), F.col("n").alias("m"), F.col("size").alias("other"))
    mean = near.filter("size <> other").groupBy("size").agg((F.sum("m") / 10).alias("mean"))
    usual = F.coalesce("mean", F.lit(0.0))
    return sizes.join(mean, "size", "left").filter((F.col("n") > times * usual) & (F.col("n") - usual > deviations * F.sqrt(usual + 1))).select("size")


def finished_words(texts: DataFrame, open_rows: DataFrame) -> DataFrame:
    """The ``last`` words that are met TIMES_INSIDE times inside ``texts`` for each different answer that ends on them.

    Both counts grow with the table, so the rule is the same at every size. A word that
    its text breaks off on isn't counted. An answer given to several prompts counts as
    whole, so labels are words even where no sentence holds them.
    """
    # the last piece is what follows the last separator: empty, or the word the text ends on
    pieces = T.let(F.split(F.lower("t"), r"[^\p{L}'’-]+"), lambda w: F.slice(w, F.lit(1), F.size(w) - 1))
    inside = texts.filter("t is not null").select(F.explode(pieces).alias("last")).groupBy("last").agg(F.count("*").alias("inside"))
    given = open_rows.select("last", "answer", "asked").distinct().groupBy("last", "answer").agg(F.count("*").alias("n"))
    ends = given.groupBy("last").agg(F.count("*").alias("ends"), F.sum(F.col("n") - 1).alias("again"))
    return ends.join(inside, "last", "left").filter(F.coalesce("inside", F.lit(0)) + F.col("again") >= TIMES_INSIDE * F.col("ends")).select("last")


def defects(df: DataFrame, key: str, user: str, answer: str, kind: str) -> DataFrame:
    """``key`` and ``defect`` of every defective row, one defect a row.

    Order of the rules: empty, copies_question, other_language, refusal, truncated. A null
    answer is empty; a null user text can't be copied nor set a language. ``kind`` equal to
    'unanswerable' excuses a refusal. Repeated rows are judged alike.
    """
    rows = checkpointed(judged(df, key, user, answer, kind))
    texts = df.select(F.col(user).alias("t")).unionByName(rows.filter("defect = ''").select(F.col("answer").alias("t")))
    known = finished_words(texts, rows.filter("last is not null")).withColumn("known", F.lit(True))
    sound = rows.filter("answer is not null and defect = ''")
    short = shortened(sound).select("answer", F.lit(True).alias("short"), "longer")
    version = shortened_for_prompt(sound.filter("asked is not null")).withColumn("version", F.lit(True))
    limit = length_limits(rows).withColumn("limit", F.lit(True))
    ends = rows.filter("last is not null or loose").withColumn("size", F.length("answer"))
    settled = ends.join(known, "last", "left").join(short, "answer", "left").join(version, ["asked", "answer"], "left").join(limit, "size", "left")
    cut = F.when(F.col("loose"), F.col("longer") | F.col("version")).otherwise(F.col("known").isNull() | F.col("short") | F.col("version") | F.col("limit"))
    cut = settled.filter(cut).select("k", F.lit("truncated").alias("defect"))
    return rows.filter("defect <> ''").select("k", "defect").unionByName(cut).select(F.col("k").alias(key), "defect")


def chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id``, ``split``, ``user``, ``assistant`` and ``kind`` of chat_rows with messages."""
    rows = table(spark, sf_dir, "chat_rows", "row_id", "split", "messages", F.col("meta.type").alias("kind")).filter("messages is not null")
    turn = lambda role: F.element_at(F.filter("messages", lambda m: m["role"] == role), -1)["content"]
    has = F.exists("messages", lambda m: m["role"] == "user")
    pick = lambda role: F.when(F.exists("messages", lambda m: m["role"] == role), turn(role))
    return rows.select("row_id", "split", pick("user").alias("user"), pick("assistant").alias("assistant"), "kind", has.alias("asked"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects(chat_turns(spark, sf_dir), "row_id", "user", "assistant", "kind").distinct()
