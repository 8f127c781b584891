"""Queries of the instruction- and preference-data operators, and their SQL.

Models are injected (``operators.calls``); here stand-ins give scores, candidates and
replies, derived from md5 of the row's key or text, the same in both engines.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions import text as T
from corpusmill.operators import instruct as I
from corpusmill.operators import sampling as S
from corpusmill.operators.calls import replies
from corpusmill.operators.dedup import contaminated, eval_grams
from corpusmill.plans.cleaning import DOCS, docs, sql_collapsed
from corpusmill.plans.dedup import EVAL, sql_grams
from corpusmill.sources.tables import table

# Shares of sources and of tasks, numbers of passages and prompts, and the longest sequence.
MIX = [("case-law", 0.5), ("sec", 0.35), ("fineweb-edu", 0.15)]
TASKS = [("grounded_qa", 0.5), ("summarization", 0.2), ("extraction", 0.15), ("rewrite", 0.15)]
N = 2500
PROMPTS = 500
LONGEST = 1024
TEMPLATES = [("grounded_qa", "Ask and answer: {passage}"), ("summarization", "Summarize: {passage}"), ("extraction", "Extract: {passage}"), ("rewrite", "Rewrite: {passage}")]
REFUSED = "(?i)not stated in the context"
SYSTEM = "Answer from the context only."


def digit(seed, mod, *cols):  # noqa: ANN001, ANN201
    """A stable number below ``mod`` from md5 of seed and key."""
    return F.conv(F.substring(S.hashed_key(seed, *cols), 1, 7), 16, 10).cast("bigint") % mod


def pairs(spark, d):  # noqa: ANN001, ANN201
    rows = table(spark, d, "chat_rows", "row_id", "pid", "split", "messages", "meta").filter("messages is not null")
    user = F.coalesce(I.role(F.col("messages"), "user"), F.lit(""))
    cut = rows.select("row_id", "pid", "meta", F.coalesce(I.role(F.col("messages"), "assistant"), F.lit("")).alias("answer"), F.split(user, "\n\n").alias("p"), user.alias("user"))
    passage = F.array_join(F.slice("p", F.lit(1), F.greatest(F.size("p") - 1, F.lit(0))), "\n\n")
    return cut.select("row_id", "pid", F.col("meta.source").alias("source"), F.col("meta.task").alias("task"), F.col("meta.type").alias("type"), "user", passage.alias("passage"), F.element_at("p", -1).alias("question"), "answer")


def judged(spark, d):  # noqa: ANN001, ANN201
    return pairs(spark, d).withColumn("score", 1 + digit("judge", 5, "row_id"))


def sft_targets(spark, d):  # noqa: ANN001, ANN201
    return spark.createDataFrame([(s, n, float(x)) for n in (25, 50, 2500) for s, x in MIX], "source string, n int, share double").select("source", "n", F.bround(F.col("n") * F.col("share")).cast("bigint").alias("target"))


def _sampled(spark, d):  # noqa: ANN001, ANN202
    want = {s: 3 * round(N * x) for s, x in MIX}
    k = F.coalesce(*[F.when(F.col("source") == s, v) for s, v in want.items()])
    long = docs(spark, d).filter(F.col("source").isin(*want) & (F.length("text") >= 800))
    return S.bottom_k(long, ["source"], "doc_id", k, "sft")


def sft_sample(spark, d):  # noqa: ANN001, ANN201
    return _sampled(spark, d).select("source", "doc_id", "rn")


def _chunks(spark, d):  # noqa: ANN001, ANN202
    toks = _sampled(spark, d).select("source", "doc_id", "rn", F.slice(T.tokens(F.col("text")), 1, 500).alias("t"))
    kept = toks.filter(F.size("t") >= 200)
    want = F.coalesce(*[F.when(F.col("source") == s, 2 * round(N * x)) for s, x in MIX])
    return kept.withColumn("at", F.row_number().over(Window.partitionBy("source").orderBy("rn"))).filter(F.col("at") <= want)


def sft_chunk(spark, d):  # noqa: ANN001, ANN201
    return _chunks(spark, d).select("source", "doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("passage_md5"))


def _tasks(spark, d):  # noqa: ANN001, ANN202
    want = F.coalesce(*[F.when(F.col("source") == s, round(N * x)) for s, x in MIX])
    few = _chunks(spark, d).filter(F.col("at") <= want).select("source", "doc_id", "t")
    ranked = few.withColumn("pid", F.row_number().over(Window.orderBy(S.hashed_key("task", "doc_id"), "doc_id")))  # at most N rows
    n = ranked.count()
    spans = spark.createDataFrame(S.quotas(n, TASKS, "grounded_qa"), "task string, lo int, hi int")
    return ranked.join(F.broadcast(spans), (F.col("pid") >= F.col("lo")) & (F.col("pid") <= F.col("hi")))


def sft_tasks(spark, d):  # noqa: ANN001, ANN201
    return _tasks(spark, d).select("pid", "doc_id", "source", "task")


def sft_passage_report(spark, d):  # noqa: ANN001, ANN201
    rows = _tasks(spark, d).select("source", "task", F.size("t").alias("n_tok"))
    by = rows.groupingSets([["source"], ["task"], []], "source", "task").agg(F.count("*").alias("n"), F.bround(F.avg("n_tok"), 3).alias("avg_tokens"))
    return by.select(F.coalesce("source", F.lit("")).alias("source"), F.coalesce("task", F.lit("")).alias("task"), "n", "avg_tokens")


def sft_prompt(spark, d):  # noqa: ANN001, ANN201
    t = spark.createDataFrame(TEMPLATES, "task string, template string")
    text = F.replace("template", F.lit("{passage}"), F.array_join("t", " "))
    return _tasks(spark, d).join(F.broadcast(t), "task").select("pid", "task", F.md5(text).alias("prompt_md5"))


def sft_temperature(spark, d):  # noqa: ANN001, ANN201
    p = table(spark, d, "chat_rows", "pid").filter("pid is not null").distinct()
    return p.select("pid", F.bround(0.75 + 0.35 * ((F.col("pid") * 7919) % 100) / 100, 6).alias("temperature"))


def _raw(spark, d):  # noqa: ANN001, ANN202
    """Generated texts as a model would give them: plain JSON, JSON in prose, or none."""
    p = pairs(spark, d)
    body = F.to_json(F.struct(F.array(F.struct("question", "answer")).alias("pairs")))
    kind = F.col("row_id") % 4
    return p.select("row_id", F.when(kind == 0, body).when(kind == 1, F.concat(F.lit("Here you are: "), body, F.lit(" Done."))).when(kind == 2, F.lit("no json")).otherwise(F.concat(F.lit("} {"), F.lit("x"))).alias("raw"))


def json_salvage(spark, d):  # noqa: ANN001, ANN201
    return _raw(spark, d).select("row_id", I.salvaged(F.col("raw"), I.PAIRS).isNotNull().alias("parsed"))


def sft_pairs(spark, d):  # noqa: ANN001, ANN201
    got = _raw(spark, d).select("row_id", F.explode(I.salvaged(F.col("raw"), I.PAIRS)["pairs"]).alias("p"))
    rows = got.select("row_id", T.collapsed(F.col("p.question")).alias("question"), T.collapsed(F.col("p.answer")).alias("answer"))
    return rows.filter((F.length("question") >= 10) & (F.length("answer") >= 2)).select("row_id", F.md5("question").alias("question_md5"), F.md5("answer").alias("answer_md5"))


def _stub():  # noqa: ANN202
    """A model's stand-in: the first try of every other prompt fails, the reply is a hash of prompt and copy."""
    import hashlib

    seen = set()

    def call(prompt, copy):  # noqa: ANN001, ANN202
        key = (prompt, copy)
        if len(prompt) % 2 and key not in seen:
            seen.add(key)
            raise TimeoutError("no reply")
        return hashlib.md5(f"{copy}|{prompt}".encode()).hexdigest()

    return call


def model_replies(spark, d):  # noqa: ANN001, ANN201
    """Four replies to each question of an injected model that fails now and then."""
    rows = pairs(spark, d).select("row_id", "question")
    return replies(rows, "row_id", "question", _stub, copies=4, first_pause=0.0).select("row_id", "copy", "reply", "error")


def sft_missing(spark, d):  # noqa: ANN001, ANN201
    return pairs(spark, d).select("row_id").join(sft_pairs(spark, d).select("row_id"), "row_id", "left_anti")


def judge_listing(spark, d):  # noqa: ANN001, ANN201
    ranked = pairs(spark, d).withColumn("i", F.row_number().over(Window.partitionBy("pid").orderBy("row_id")))
    item = F.struct("i", F.concat(F.col("i").cast("string"), F.lit(". "), F.col("question")).alias("s"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["s"]), "\n")
    return ranked.groupBy("pid").agg(F.count("*").alias("n"), F.md5(text).alias("listing_md5"))


def judge_join(spark, d):  # noqa: ANN001, ANN201
    p = pairs(spark, d).select("row_id", "pid")
    scores = judged(spark, d).filter(F.col("row_id") % 3 != 0).select("row_id", "score", F.substring("answer", 1, 200).alias("reason"))
    return p.join(scores, "row_id", "left").select("row_id", F.coalesce("score", F.lit(0)).alias("score"), F.md5(F.coalesce("reason", F.lit(""))).alias("reason_md5"))


def gate_judge(spark, d):  # noqa: ANN001, ANN201
    return judged(spark, d).filter("score >= 4").select("row_id")


def _grounded(rows):  # noqa: ANN001, ANN202
    g = rows.withColumn("g", I.grounding(F.col("answer"), F.col("passage"))).withColumn("no", F.col("answer").rlike(REFUSED))
    return g.filter(F.col("no") | (F.col("g") >= 0.35)).withColumn("grounding", F.when(~F.col("no"), F.bround("g", 3)))


def gate_grounding(spark, d):  # noqa: ANN001, ANN201
    return _grounded(pairs(spark, d)).select("row_id", "grounding")


def _length():  # noqa: ANN202
    rendered = F.concat(F.lit("<bos> <system> " + SYSTEM + " <user> Context: "), "passage", F.lit(" "), "question", F.lit(" <assistant> "), "answer", F.lit(" <eos>"))
    return F.size(T.tokens(rendered))


def gate_length(spark, d):  # noqa: ANN001, ANN201
    return pairs(spark, d).select("row_id", _length().alias("n_tokens")).filter(F.col("n_tokens") <= LONGEST)


def gate_cosine(spark, d):  # noqa: ANN001, ANN201
    rows = pairs(spark, d).select("row_id", F.concat_ws(" ", "question", "answer").alias("t"))
    return I.drop_similar(rows, "row_id", "t", 0.95).select("row_id")


def gate_decontam(spark, d):  # noqa: ANN001, ANN201
    g = eval_grams(table(spark, d, "eval_items", "prompt", "answer"), ["prompt", "answer"], 13)
    rows = pairs(spark, d).select("row_id", F.concat_ws(" ", "question", "answer").alias("t"))
    return rows.join(contaminated(rows, "row_id", "t", g, 13), "row_id", "left_anti").select("row_id")


def sft_split(spark, d):  # noqa: ANN001, ANN201
    return S.held_out(pairs(spark, d).select("row_id"), "row_id", 0.02, "split")


def _built(spark, d):  # noqa: ANN001, ANN202
    return _grounded(judged(spark, d).filter("score >= 4"))


def chat_rows(spark, d):  # noqa: ANN001, ANN201
    m = lambda r, c: F.struct(F.lit(r).alias("role"), c.alias("content"))
    user = F.concat(F.lit("Context:\n"), "passage", F.lit("\n\n"), "question")
    chat = F.array(m("system", F.lit(SYSTEM)), m("user", user), m("assistant", F.col("answer")))
    flat = F.array_join(F.transform(chat, lambda x: F.concat(x["role"], F.lit("="), x["content"])), "|")
    return _built(spark, d).select("row_id", "source", "task", "type", "score", "grounding", F.md5(flat).alias("messages_md5"))


def _sequences(spark, d):  # noqa: ANN001, ANN202
    prompt = F.concat(F.array(F.lit("<bos>"), F.lit("<system>")), T.tokens(F.lit(SYSTEM)), F.array(F.lit("<user>")), T.tokens(F.col("user")), F.array(F.lit("<assistant>")))
    return pairs(spark, d).select("row_id", prompt.alias("prompt"), F.concat(T.tokens(F.col("answer")), F.array(F.lit("<eos>"))).alias("answer"))


def loss_mask(spark, d):  # noqa: ANN001, ANN201
    ids, mask = I.masked(F.col("prompt"), F.col("answer"), LONGEST)
    rows = _sequences(spark, d).filter(F.size("prompt") + F.size("answer") <= LONGEST).select("row_id", ids.alias("ids"), mask.alias("mask"))
    return rows.select("row_id", F.md5(F.array_join("ids", " ")).alias("ids_md5"), F.aggregate("mask", F.lit(0), lambda a, b: a + b).alias("n_loss"), F.array_position("mask", 1).alias("first_loss"))


def sft_labels(spark, d):  # noqa: ANN001, ANN201
    ids, mask = I.masked(F.col("prompt"), F.col("answer"), LONGEST)
    rows = _sequences(spark, d).filter(F.size("prompt") + F.size("answer") <= LONGEST).select("row_id", ids.alias("ids"), mask.alias("mask"))
    labels = F.zip_with("ids", "mask", lambda i, m: F.when(m == 1, i).otherwise("-100"))
    return rows.select("row_id", F.md5(F.array_join(labels, " ")).alias("labels_md5"))


def sft_report(spark, d):  # noqa: ANN001, ANN201
    rows = _built(spark, d).withColumn("n_tok", _length())
    by = rows.groupingSets([["task"], ["source"], ["type"], []], "task", "source", "type").agg(F.count("*").alias("n"), F.bround(F.avg("n_tok"), 3).alias("avg_tokens"))
    e = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return by.select(e("task"), e("source"), e("type"), "n", "avg_tokens")


# ---- preferences -----------------------------------------------------------------------


def pref_prompts(spark, d):  # noqa: ANN001, ANN201
    rows = table(spark, d, "chat_rows", "row_id", "messages").filter("messages is not null")
    rows = rows.select("row_id", F.coalesce(I.role(F.col("messages"), "system"), F.lit(SYSTEM)).alias("system"), I.role(F.col("messages"), "user").alias("user")).filter("user is not null")
    first = rows.orderBy(S.hashed_key("pref", "row_id"), "row_id").limit(PROMPTS)
    return first.withColumn("pid", F.row_number().over(Window.orderBy(S.hashed_key("pref", "row_id"), "row_id"))).select("pid", "row_id", F.md5("system").alias("system_md5"), F.md5("user").alias("user_md5"))


def _candidates(spark, d):  # noqa: ANN001, ANN202
    """Answers to one passage stand for a prompt's candidates; their order is that of row_id."""
    c = pairs(spark, d).select("pid", "row_id", T.collapsed(F.col("answer")).alias("c"))
    kept = c.filter(F.length("c") >= 2)
    rows = kept.withColumn("i", F.row_number().over(Window.partitionBy("pid").orderBy("row_id")) - 1).withColumn("k", F.count("*").over(Window.partitionBy("pid")))
    return rows.filter("k >= 2").withColumn("score", digit("score", 10, "row_id"))


def pref_candidates(spark, d):  # noqa: ANN001, ANN201
    return _candidates(spark, d).select("pid", "i", "row_id", F.md5("c").alias("text_md5"))


def _best(spark, d):  # noqa: ANN001, ANN202
    by = Window.partitionBy("pid")
    r = _candidates(spark, d).withColumn("hi", F.row_number().over(by.orderBy(F.desc("score"), "i"))).withColumn("lo", F.row_number().over(by.orderBy("score", "i")))
    pick = lambda rank, c: F.max(F.when(F.col(rank) == 1, F.col(c)))
    out = r.groupBy("pid").agg(pick("hi", "row_id").alias("chosen"), pick("lo", "row_id").alias("rejected"), pick("hi", "score").alias("chosen_score"), pick("lo", "score").alias("rejected_score"), pick("hi", "c").alias("ct"), pick("lo", "c").alias("rt"))
    return out.filter(F.col("chosen_score") - F.col("rejected_score") >= 2)


def pref_best_worst(spark, d):  # noqa: ANN001, ANN201
    return _best(spark, d).select("pid", "chosen", "rejected", "chosen_score", "rejected_score")


def _verified(spark, d):  # noqa: ANN001, ANN202
    """The stub's winner is A, B or a tie; the pair stays if it names the side where the chosen one stood."""
    r = _best(spark, d).withColumn("flip", digit("flip", 2, "pid") == 1).withColumn("w", digit("winner", 3, "pid"))
    return r.filter(F.when(F.col("flip"), F.col("w") == 1).otherwise(F.col("w") == 0))


def pref_verify(spark, d):  # noqa: ANN001, ANN201
    return _verified(spark, d).select("pid", "chosen", "rejected")


def pref_degenerate(spark, d):  # noqa: ANN001, ANN201
    rows = _best(spark, d).select("pid", F.explode(F.array(F.struct(F.lit(0).alias("s"), F.col("ct").alias("t")), F.struct(F.lit(1).alias("s"), F.col("rt").alias("t")))).alias("x"))
    g = rows.select("pid", "x.s", F.explode(I.gram_vector(F.col("x.t"))).alias("k")).groupBy("pid", "k").agg(F.sum(1 - F.col("s")).cast("double").alias("c"), F.sum("s").cast("double").alias("r"))
    cos = g.groupBy("pid").agg(F.try_divide(F.sum(F.col("c") * F.col("r")), F.sqrt(F.sum(F.col("c") * F.col("c"))) * F.sqrt(F.sum(F.col("r") * F.col("r")))).alias("cos"))
    return cos.select("pid", F.bround(F.coalesce("cos", F.lit(0.0)), 6).alias("cosine"), (F.coalesce("cos", F.lit(0.0)) > 0.95).alias("degenerate"))


def pref_split(spark, d):  # noqa: ANN001, ANN201
    return S.held_out(_best(spark, d).select("pid"), "pid", 0.05, "pref-split")


def pref_report(spark, d):  # noqa: ANN001, ANN201
    return _best(spark, d).agg(F.count("*").alias("n"), F.bround(F.avg(F.col("chosen_score") - F.col("rejected_score")), 2).alias("avg_margin"))


def _dpo(spark, d):  # noqa: ANN001, ANN202
    users = pairs(spark, d).groupBy("pid").agg(F.min_by("user", "row_id").alias("user"))
    prompt = F.concat(F.array(F.lit("<bos>"), F.lit("<user>")), T.tokens(F.col("user")), F.array(F.lit("<assistant>")))
    end = lambda c: F.concat(T.tokens(F.col(c)), F.array(F.lit("<eos>")))
    rows = _best(spark, d).join(users, "pid").select("pid", F.size(prompt).alias("n_prompt"), F.concat(prompt, end("ct")).alias("chosen"), F.concat(prompt, end("rt")).alias("rejected"))
    return rows.filter((F.size("chosen") <= LONGEST) & (F.size("rejected") <= LONGEST))


def dpo_sequences(spark, d):  # noqa: ANN001, ANN201
    return _dpo(spark, d).select("pid", "n_prompt", F.size("chosen").alias("n_chosen"), F.size("rejected").alias("n_rejected"), F.md5(F.array_join("chosen", " ")).alias("chosen_md5"), F.md5(F.array_join("rejected", " ")).alias("rejected_md5"))


def dpo_collate(spark, d):  # noqa: ANN001, ANN201
    rows = _dpo(spark, d).withColumn("batch", F.floor(F.col("pid") / 64)).withColumn("m", F.greatest(F.size("chosen"), F.size("rejected")))
    wide = rows.withColumn("width", F.max("m").over(Window.partitionBy("batch")))
    return wide.select("pid", "batch", "width", F.md5(F.array_join(F.concat("chosen", F.array_repeat(F.lit("<pad>"), F.col("width") - F.size("chosen"))), " ")).alias("padded_md5"))


QUERIES = {
    f.__name__: f
    for f in (
        sft_targets, sft_sample, sft_chunk, sft_tasks, sft_passage_report, sft_prompt, sft_temperature, json_salvage, sft_pairs, model_replies, sft_missing, judge_listing, judge_join, gate_judge, gate_grounding,
        gate_length, gate_cosine, gate_decontam, sft_split, chat_rows, loss_mask, sft_labels, sft_report, pref_prompts, pref_candidates, pref_best_worst, pref_verify, pref_degenerate, pref_split,
        pref_report, dpo_sequences, dpo_collate,
    )
}

# ---- SQL -------------------------------------------------------------------------------


def sql_digit(seed: str, mod: int, key: str) -> str:
    return f"(CAST('0x' || substr(md5('{seed}|' || {key}), 1, 7) AS BIGINT) % {mod})"


def sql_tokens(x: str) -> str:
    return f"list_filter(string_split({sql_collapsed(x)}, ' '), lambda w: w <> '')"


def sql_role(r: str) -> str:
    return f"list_filter(messages, lambda m: m.role = '{r}')[-1].content"


def sql_vector(x: str) -> str:
    t = sql_collapsed(f"lower({x})")
    return f"(SELECT list_transform(range(1, length(z.t) - 2), lambda i: substr(md5(substr(z.t, i, 4)), 1, 3)) FROM (SELECT {t} AS t) z)"


SEP = "chr(10) || chr(10)"
PAIRS_SQL = f"""raw AS (SELECT row_id, pid, meta, messages, coalesce({sql_role('user')}, '') AS user, coalesce({sql_role('assistant')}, '') AS answer FROM chat_rows WHERE messages IS NOT NULL),
pairs AS (SELECT row_id, pid, meta.source AS source, meta.task AS task, meta.type AS type, user, answer, coalesce(array_to_string(string_split(user, {SEP})[:-2], {SEP}), '') AS passage, string_split(user, {SEP})[-1] AS question FROM raw)"""
JUDGED = f"{PAIRS_SQL}, judged AS (SELECT *, 1 + {sql_digit('judge', 5, 'row_id')} AS score FROM pairs)"
GROUND = """aw AS (SELECT *, list_distinct(regexp_extract_all(lower(answer), '[a-z0-9]+')) AS a, list_distinct(regexp_extract_all(lower(passage), '[a-z0-9]+')) AS p, regexp_matches(answer, '(?i)not stated in the context') AS no FROM {0}),
gr AS (SELECT *, CASE WHEN len(a) > 0 THEN CAST(len(list_intersect(a, p)) AS DOUBLE) / len(a) END AS g FROM aw),
built AS (SELECT *, CASE WHEN NOT no THEN round_even(g, 3) END AS grounding FROM gr WHERE no OR g >= 0.35::DOUBLE)"""
LENGTH = f"len({sql_tokens(chr(39) + '<bos> <system> ' + SYSTEM + ' <user> Context: ' + chr(39) + ' || passage || ' + chr(39) + ' ' + chr(39) + ' || question || ' + chr(39) + ' <assistant> ' + chr(39) + ' || answer || ' + chr(39) + ' <eos>' + chr(39))})"
WANT = "CASE source " + " ".join(f"WHEN '{s}' THEN {round(N * x)}" for s, x in MIX) + " END"
SAMPLED = f"sampled AS (SELECT * FROM (SELECT source, doc_id, text, row_number() OVER (PARTITION BY source ORDER BY md5('sft|' || doc_id), doc_id) AS rn FROM docs WHERE source IN ('case-law', 'sec', 'fineweb-edu') AND length(text) >= 800) WHERE rn <= 3 * {WANT})"
CHUNKS = f"chunks AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY rn) AS nth FROM (SELECT source, doc_id, rn, {sql_tokens('text')}[1:500] AS t FROM sampled) WHERE len(t) >= 200) WHERE nth <= 2 * {WANT})"
QUOTA = "greatest(0, least(CAST(round_even(n * {0}::DOUBLE, 0) AS BIGINT), n - {1}))"
TASKED = f"""few AS (SELECT source, doc_id, t, row_number() OVER (ORDER BY md5('task|' || doc_id), doc_id) AS pid, count(*) OVER () AS n FROM chunks WHERE nth <= {WANT}),
q AS (SELECT *, {QUOTA.format(0.5, 0)} AS q1 FROM few), q2 AS (SELECT *, q1 + {QUOTA.format(0.2, 'q1')} AS e2 FROM q), q3 AS (SELECT *, e2 + {QUOTA.format(0.15, 'e2')} AS e3 FROM q2), q4 AS (SELECT *, e3 + {QUOTA.format(0.15, 'e3')} AS e4 FROM q3),
tasked AS (SELECT *, CASE WHEN pid <= q1 THEN 'grounded_qa' WHEN pid <= e2 THEN 'summarization' WHEN pid <= e3 THEN 'extraction' WHEN pid <= e4 THEN 'rewrite' ELSE 'grounded_qa' END AS task FROM q4)"""
PASSAGES = f"WITH {DOCS}, {SAMPLED}, {CHUNKS}, {TASKED}"
CANDS = f"""{PAIRS_SQL}, kept AS (SELECT pid, row_id, {sql_collapsed('answer')} AS c FROM pairs WHERE length({sql_collapsed('answer')}) >= 2),
cands AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY row_id) - 1 AS i, count(*) OVER (PARTITION BY pid) AS k, {sql_digit('score', 10, 'row_id')} AS score FROM kept) WHERE k >= 2)"""
BEST = f"""{CANDS}, r AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY score DESC, i) AS hi, row_number() OVER (PARTITION BY pid ORDER BY score, i) AS lo FROM cands),
best AS (SELECT x.pid, x.row_id AS chosen, y.row_id AS rejected, x.score AS chosen_score, y.score AS rejected_score, x.c AS ct, y.c AS rt FROM r x JOIN r y ON x.pid IS NOT DISTINCT FROM y.pid AND x.hi = 1 AND y.lo = 1 WHERE x.score - y.score >= 2)"""
SEQ = f"""seq AS (SELECT row_id, list_concat(['<bos>', '<system>'], {sql_tokens(chr(39) + SYSTEM + chr(39))}, ['<user>'], {sql_tokens('user')}, ['<assistant>']) AS p, list_append({sql_tokens('answer')}, '<eos>') AS a FROM pairs),
fit AS (SELECT *, {LONGEST} - len(p) - len(a) AS pad FROM seq WHERE len(p) + len(a) <= {LONGEST})"""
DPO = f"""users AS (SELECT pid, arg_min(user, row_id) AS user FROM pairs GROUP BY pid),
pr AS (SELECT best.pid, list_concat(['<bos>', '<user>'], {sql_tokens('user')}, ['<assistant>']) AS p, list_append({sql_tokens('ct')}, '<eos>') AS c, list_append({sql_tokens('rt')}, '<eos>') AS r FROM best JOIN users USING (pid)),
dpo AS (SELECT pid, len(p) AS np, list_concat(p, c) AS chosen, list_concat(p, r) AS rejected FROM pr WHERE len(p) + len(c) <= {LONGEST} AND len(p) + len(r) <= {LONGEST})"""
RAW = f"""j AS (SELECT row_id, question, answer FROM pairs WHERE row_id % 4 IN (0, 1)), tidy AS (SELECT row_id, {sql_collapsed('question')} AS q, {sql_collapsed('answer')} AS a FROM j), good AS (SELECT * FROM tidy WHERE length(q) >= 10 AND length(a) >= 2)"""


def sql_held(base: str, rows: str, key: str, share: float, seed: str) -> str:
    return f"WITH {base}, h AS (SELECT {key}, row_number() OVER (ORDER BY md5('{seed}|' || {key}), {key}) AS rn, count(*) OVER () AS n FROM {rows}) SELECT {key}, CASE WHEN rn <= greatest(1, floor(n * {share}::DOUBLE)) THEN 'val' ELSE 'train' END AS split FROM h"


SQL = {
    "sft_targets": "SELECT source, CAST(n AS INTEGER) AS n, CAST(round_even(n * share, 0) AS BIGINT) AS target FROM (VALUES " + ", ".join(f"('{s}', {x}::DOUBLE)" for s, x in MIX) + ") m(source, share), (VALUES (25), (50), (2500)) k(n)",
    "sft_sample": f"WITH {DOCS}, {SAMPLED} SELECT source, doc_id, CAST(rn AS INTEGER) AS rn FROM sampled",
    "sft_chunk": f"WITH {DOCS}, {SAMPLED}, {CHUNKS} SELECT source, doc_id, CAST(len(t) AS INTEGER) AS n_tokens, md5(array_to_string(t, ' ')) AS passage_md5 FROM chunks",
    "sft_tasks": f"{PASSAGES} SELECT CAST(pid AS INTEGER) AS pid, doc_id, source, task FROM tasked",
    "sft_passage_report": f"{PASSAGES} SELECT coalesce(source, '') AS source, coalesce(task, '') AS task, count(*) AS n, round_even(avg(len(t)), 3) AS avg_tokens FROM tasked GROUP BY GROUPING SETS ((source), (task), ())",
    "sft_prompt": f"{PASSAGES}, m AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in TEMPLATES) + ") v(task, template)) SELECT CAST(pid AS INTEGER) AS pid, task, md5(replace(template, '{passage}', array_to_string(t, ' '))) AS prompt_md5 FROM tasked JOIN m USING (task)",
    "sft_temperature": "SELECT DISTINCT pid, round_even(0.75::DOUBLE + 0.35::DOUBLE * ((pid * 7919) % 100) / 100, 6) AS temperature FROM chat_rows WHERE pid IS NOT NULL",
    "json_salvage": f"WITH {PAIRS_SQL} SELECT row_id, row_id % 4 IN (0, 1) AS parsed FROM pairs",
    "sft_pairs": f"WITH {PAIRS_SQL}, {RAW} SELECT row_id, md5(q) AS question_md5, md5(a) AS answer_md5 FROM good",
    "model_replies": f"WITH {PAIRS_SQL} SELECT row_id, CAST(k AS INTEGER) AS copy, md5(k || '|' || question) AS reply, CAST(NULL AS VARCHAR) AS error FROM pairs, range(4) r(k)",
    "sft_missing": f"WITH {PAIRS_SQL}, {RAW} SELECT row_id FROM pairs WHERE row_id NOT IN (SELECT row_id FROM good)",
    "judge_listing": f"WITH {PAIRS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY row_id) AS i FROM pairs) SELECT pid, count(*) AS n, md5(string_agg(i || '. ' || question, chr(10) ORDER BY i)) AS listing_md5 FROM r GROUP BY pid",
    "judge_join": f"WITH {JUDGED} SELECT row_id, CASE WHEN row_id % 3 <> 0 THEN score ELSE 0 END AS score, md5(CASE WHEN row_id % 3 <> 0 THEN substr(answer, 1, 200) ELSE '' END) AS reason_md5 FROM judged",
    "gate_judge": f"WITH {JUDGED} SELECT row_id FROM judged WHERE score >= 4",
    "gate_grounding": f"WITH {PAIRS_SQL}, {GROUND.format('pairs')} SELECT row_id, grounding FROM built",
    "gate_length": f"WITH {PAIRS_SQL} SELECT row_id, CAST(n AS INTEGER) AS n_tokens FROM (SELECT row_id, {LENGTH} AS n FROM pairs) WHERE n <= {LONGEST}",
    "gate_decontam": f"WITH {PAIRS_SQL}, {EVAL}, w AS (SELECT row_id, regexp_extract_all(lower(question || ' ' || answer), '[a-z0-9]+') AS w FROM pairs), g AS (SELECT row_id, unnest({sql_grams('w', 13)}) AS gram FROM w WHERE len(w) >= 13) SELECT row_id FROM pairs WHERE row_id NOT IN (SELECT row_id FROM g WHERE gram IN (SELECT gram FROM eg))",
    "gate_cosine": f"""WITH RECURSIVE {PAIRS_SQL}, t AS (SELECT row_id, {sql_collapsed("lower(question || ' ' || answer)")} AS t FROM pairs),
g AS (SELECT row_id, unnest(list_transform(range(1, length(t) - 2), lambda i: substr(md5(substr(t, i, 4)), 1, 3))) AS k FROM t WHERE length(t) >= 4),
c AS (SELECT row_id, k, CAST(count(*) AS DOUBLE) AS n FROM g GROUP BY ALL), v AS (SELECT row_id, k, n / sqrt(sum(n * n) OVER (PARTITION BY row_id)) AS w FROM c),
e AS (SELECT x.row_id AS a, y.row_id AS b FROM v x JOIN v y ON x.k = y.k AND x.row_id < y.row_id GROUP BY ALL HAVING sum(x.w * y.w) > 0.95::DOUBLE),
o AS (SELECT b AS id, list(a) AS smaller, row_number() OVER (ORDER BY b) AS rn FROM e GROUP BY b),
walk AS (SELECT CAST(0 AS BIGINT) AS rn, CAST([] AS BIGINT[]) AS gone UNION ALL SELECT o.rn, CASE WHEN len(list_filter(o.smaller, lambda x: NOT list_contains(walk.gone, x))) > 0 THEN list_append(walk.gone, o.id) ELSE walk.gone END FROM walk JOIN o ON o.rn = walk.rn + 1),
gone AS (SELECT unnest(gone) AS id FROM (SELECT gone FROM walk ORDER BY rn DESC LIMIT 1)) SELECT row_id FROM pairs WHERE row_id NOT IN (SELECT id FROM gone)""",
    "sft_split": sql_held(PAIRS_SQL, "pairs", "row_id", 0.02, "split"),
    "chat_rows": f"WITH {JUDGED}, j4 AS (SELECT * FROM judged WHERE score >= 4), {GROUND.format('j4')} SELECT row_id, source, task, type, score, grounding, md5('system={SYSTEM}|user=Context:' || chr(10) || passage || {SEP} || question || '|assistant=' || answer) AS messages_md5 FROM built",
    "loss_mask": f"WITH {PAIRS_SQL}, {SEQ} SELECT row_id, md5(array_to_string(list_concat(p, a, list_transform(range(pad), lambda i: '<pad>')), ' ')) AS ids_md5, CAST(len(a) AS INTEGER) AS n_loss, CAST(len(p) + 1 AS BIGINT) AS first_loss FROM fit",
    "sft_labels": f"WITH {PAIRS_SQL}, {SEQ} SELECT row_id, md5(array_to_string(list_concat(list_transform(p, lambda x: '-100'), a, list_transform(range(pad), lambda i: '-100')), ' ')) AS labels_md5 FROM fit",
    "sft_report": f"WITH {JUDGED}, j4 AS (SELECT * FROM judged WHERE score >= 4), {GROUND.format('j4')} SELECT coalesce(task, '') AS task, coalesce(source, '') AS source, coalesce(type, '') AS type, count(*) AS n, round_even(avg({LENGTH}), 3) AS avg_tokens FROM built GROUP BY GROUPING SETS ((task), (source), (type), ())",
    "pref_prompts": f"WITH r AS (SELECT row_id, coalesce({sql_role('system')}, '{SYSTEM}') AS system, {sql_role('user')} AS user FROM chat_rows WHERE messages IS NOT NULL), k AS (SELECT *, row_number() OVER (ORDER BY md5('pref|' || row_id), row_id) AS pid FROM r WHERE user IS NOT NULL) SELECT CAST(pid AS INTEGER) AS pid, row_id, md5(system) AS system_md5, md5(user) AS user_md5 FROM k WHERE pid <= {PROMPTS}",
    "pref_candidates": f"WITH {CANDS} SELECT pid, CAST(i AS INTEGER) AS i, row_id, md5(c) AS text_md5 FROM cands",
    "pref_best_worst": f"WITH {BEST} SELECT pid, chosen, rejected, chosen_score, rejected_score FROM best",
    "pref_verify": f"WITH {BEST} SELECT pid, chosen, rejected FROM best WHERE CASE WHEN {sql_digit('flip', 2, 'pid')} = 1 THEN {sql_digit('winner', 3, 'pid')} = 1 ELSE {sql_digit('winner', 3, 'pid')} = 0 END",
    "pref_degenerate": f"""WITH {BEST}, t AS (SELECT pid, 0 AS s, {sql_collapsed('lower(ct)')} AS t FROM best UNION ALL SELECT pid, 1, {sql_collapsed('lower(rt)')} FROM best),
g AS (SELECT pid, s, unnest(list_transform(range(1, length(t) - 2), lambda i: substr(md5(substr(t, i, 4)), 1, 3))) AS k FROM t WHERE length(t) >= 4),
c AS (SELECT pid, k, CAST(count(*) FILTER (s = 0) AS DOUBLE) AS c, CAST(count(*) FILTER (s = 1) AS DOUBLE) AS r FROM g GROUP BY ALL),
x AS (SELECT pid, coalesce(sum(c * r) / nullif(sqrt(sum(c * c)) * sqrt(sum(r * r)), 0), 0.0::DOUBLE) AS cos FROM c GROUP BY pid) SELECT pid, round_even(cos, 6) AS cosine, cos > 0.95::DOUBLE AS degenerate FROM x""",
    "pref_split": sql_held(BEST, "best", "pid", 0.05, "pref-split"),
    "pref_report": f"WITH {BEST} SELECT count(*) AS n, round_even(avg(chosen_score - rejected_score), 2) AS avg_margin FROM best",
    "dpo_sequences": f"WITH {BEST}, {DPO} SELECT pid, CAST(np AS INTEGER) AS n_prompt, CAST(len(chosen) AS INTEGER) AS n_chosen, CAST(len(rejected) AS INTEGER) AS n_rejected, md5(array_to_string(chosen, ' ')) AS chosen_md5, md5(array_to_string(rejected, ' ')) AS rejected_md5 FROM dpo",
    "dpo_collate": f"WITH {BEST}, {DPO}, b AS (SELECT *, pid // 64 AS batch, max(greatest(len(chosen), len(rejected))) OVER (PARTITION BY pid // 64) AS width FROM dpo) SELECT pid, batch, CAST(width AS INTEGER) AS width, md5(array_to_string(list_concat(chosen, list_transform(range(width - len(chosen)), lambda i: '<pad>')), ' ')) AS padded_md5 FROM b",
}
