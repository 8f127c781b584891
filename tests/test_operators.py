"""The rules restated in plain Python, and the edges the tables don't hold."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import cleaning, dedup, instruct, packing, sampling
from corpusmill.operators.running import global_rank, running_total


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def test_lines_follow_python(spark):
    text = "a\r\nb\rc\x0bd\x0ce\x1cf\x85g h i\n"
    assert one(spark, T.lines(F.col("t")), t=text)[:9] == text.splitlines()


def test_collapse_follows_python(spark):
    text = "  a  b\t\nc  "
    assert one(spark, T.collapsed(F.col("t")), t=text) == " ".join(text.split())


@pytest.mark.parametrize("text", ["", "one two three four five six seven", "a b c d " * 5, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 2])
def test_repetition(spark, text):
    words = text.split()
    grams = [tuple(words[i : i + 4]) for i in range(len(words) - 3)]
    want = 0.0 if len(words) < 8 else sum(c for _, c in Counter(grams).most_common(10)) / len(grams)
    assert one(spark, cleaning.repetition(F.col("t")), t=text) == pytest.approx(want)


def test_line_filter_edges(spark):
    keep = "x" * 40
    mixed = "a" * 28 + "." * 12
    text = "\n".join(["x" * 39, keep, mixed])
    assert one(spark, cleaning.filter_lines(F.col("t")), t=text) == keep
    assert one(spark, cleaning.filter_lines(F.col("t")), t=None) == ""


def test_language_edges(spark):
    for share, want in ((100, True), (99, True), (95, False), (96, True), (90, False), (89, False)):
        text = "a" * share + "é" * (100 - share)
        assert one(spark, cleaning.is_english(F.col("t")), t=text) is want


def test_shingles(spark):
    get = lambda t: one(spark, T.shingles(T.words(F.col("t")), 5), t=t)
    assert get("") == [] and get(None) == [] and get("a b c d") == ["a b c d"]
    assert sorted(get("a b c d e f a b c d e")) == sorted({"a b c d e", "b c d e f", "c d e f a", "d e f a b", "e f a b c", "f a b c d"})


def test_greedy_keeps_after_a_dropped_one(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (5, 6)], "a bigint, b bigint")
    assert sorted(r.id for r in dedup.greedy(links).collect()) == [2, 6]
    assert dedup.greedy(links.limit(0)).count() == 0


def test_greedy_in_groups_and_links_against_brute_force(spark):
    rng = random.Random(21)
    for _ in range(3):
        sigs = [(i, [rng.randint(0, 2) for _ in range(dedup.BANDS * dedup.BAND_ROWS)]) for i in range(40)]
        sigs = [(i, [s[b * dedup.BAND_ROWS] for b in range(dedup.BANDS) for _ in range(dedup.BAND_ROWS)] if i % 9 else sigs[0][1]) for i, s in sigs]
        key = lambda s, b: (b, tuple(s[b * dedup.BAND_ROWS : (b + 1) * dedup.BAND_ROWS]))
        keys = {i: {key(s, b) for b in range(dedup.BANDS)} for i, s in sigs}
        head = {i: min(j for j, t in sigs if t == s) for i, s in sigs}
        df = spark.createDataFrame(sigs, "k bigint, s array<bigint>")
        got = {r.id: (r.class_id, r.n_links) for r in dedup.class_links(df, "k", "s").collect()}
        assert got == {i: (head[i], sum(1 for j in set(head.values()) if j != head[i] and keys[j] & keys[i])) for i in keys}
        kept = []
        for i in sorted(keys):
            if not any(keys[i] & keys[j] for j in kept):
                kept.append(i)
        members = spark.createDataFrame([(i, str(g)) for i, gs in keys.items() for g in gs], "id bigint, group string")
        assert {r.id for r in dedup.greedy_in_groups(members).collect()} == set(keys) - set(kept)
    assert dedup.greedy_in_groups(members.limit(0)).count() == 0


def test_batches_are_cut_by_bytes():
    import pyarrow as pa

    from corpusmill.functions.arrow import slices

    texts = ["x" * n for n in (5, 0, 400, 9, 9, 9, 100_000, 1)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    parts = list(slices(batch, 1000))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts
    assert all(p.num_rows == 1 or p.nbytes <= 1000 for p in parts) and len(parts) < len(texts)
    assert list(slices(batch.slice(0, 0))) == []


def test_model_calls(spark):
    from corpusmill.operators.calls import Fatal, replies

    def model():
        tries = Counter()

        def call(prompt, copy):
            tries[prompt, copy] += 1
            if prompt == "never" or prompt == "twice" and tries[prompt, copy] < 3:
                raise TimeoutError("busy")
            return f"{prompt}-{copy}"

        return call

    df = spark.createDataFrame([(1, "a"), (2, "twice"), (3, "never"), (4, None)], "k bigint, p string").withColumn("copy", F.lit(9)).coalesce(1)
    got = {(r.k, r["copy"]): (r.reply, r.tries, r.error) for r in replies(df, "k", "p", model, copies=2, tries=3, first_pause=0.0).collect()}
    assert got[1, 1] == ("a-1", 1, None) and got[2, 0] == ("twice-0", 3, None) and got[3, 0] == (None, 3, "TimeoutError: busy") and got[4, 1] == (None, 0, None) and len(got) == 8

    def broke():
        def call(prompt, copy):
            raise Fatal("quota")

        return call

    with pytest.raises(Exception, match="quota"):
        replies(df, "k", "p", broke, first_pause=0.0).collect()
    assert replies(df.limit(0), "k", "p", model).count() == 0


def test_shards_of_many_files(spark, tmp_path):
    from corpusmill.sources import shards

    for name, n in (("en/train/part-00001", 3), ("en/train/part-00000", 2), ("en/test/part-00000", 1), ("de/train-00000-of-1", 4)):
        at = tmp_path / name
        at.parent.mkdir(parents=True, exist_ok=True)
        spark.range(n).selectExpr("cast(id as string) as text", "id as idx").toPandas().to_parquet(f"{at}.parquet")
    files = shards.shard_files(spark, str(tmp_path), "en")
    assert [f.rsplit("/", 1)[1] for f in files] == ["part-00000.parquet", "part-00001.parquet"]
    assert len(shards.shard_files(spark, str(tmp_path))) == 3 and len(shards.shard_files(spark, str(tmp_path), split="test")) == 1
    rows = sorted((r.shard, r.idx, r.text) for r in shards.read_shards(spark, files).collect())
    assert rows == [("part-00000", i, str(i)) for i in range(2)] + [("part-00001", i, str(i)) for i in range(3)]
    assert shards.read_shards(spark, files, "text", first=1).count() == 2
    with pytest.raises(ValueError):
        shards.read_shards(spark, shards.shard_files(spark, str(tmp_path), "fr"))


def test_stores_and_reports(spark, tmp_path):
    from corpusmill.sources import formats

    sigs = spark.createDataFrame([("a", 1, [1, 2]), ("b", 2, [3])], "shard string, k bigint, sig array<bigint>")
    formats.write_signatures(sigs, "shard", str(tmp_path / "sigs"))
    formats.write_signatures(sigs.filter("shard = 'b'").withColumn("k", F.lit(7).cast("bigint")), "shard", str(tmp_path / "sigs"))
    assert sorted((r.shard, r.k) for r in formats.read_signatures(spark, str(tmp_path / "sigs")).collect()) == [("a", 1), ("b", 7)]
    for step in (1, 2):
        formats.append_metrics(spark.createDataFrame([(step, None)], "step int, val double"), str(tmp_path / "metrics"))
    assert sorted(r.step for r in formats.read_json_lines(spark, str(tmp_path / "metrics")).collect()) == [1, 2]
    for _ in range(2):
        formats.write_report(sigs.groupBy("shard").count(), str(tmp_path / "report"))
    assert formats.read_json_lines(spark, str(tmp_path / "report")).count() == 2


def test_large_dictionaries_are_joined(spark, monkeypatch):
    words = spark.createDataFrame([("alpha",), ("Beta",), (None,)], "word string")
    line = "alpha beta gamma delta alpha beta alpha beta orange table "
    rows = [(1, "\n".join(line * 2 + str(i) for i in range(20))), (2, "\n".join("alpha beta " * 6 + f"x{i}" for i in range(20))), (3, None)]
    df = spark.createDataFrame(rows, "k bigint, t string").withColumn("_key", F.lit(0))
    read = lambda: {r.k: r.reason for r in cleaning.clean(df, "k", "t", None, words).collect()}
    monkeypatch.setattr(cleaning, "MOST_REPEATED", 2.0)
    small = read()
    monkeypatch.setattr(cleaning, "DICTIONARY_CHARS", 1)
    assert read() == small == {1: "ocr", 2: "kept", 3: "too_short"}


def test_vocabulary_against_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    from corpusmill.operators import vocabulary

    if not __import__("os").path.exists(vocabulary.DEFAULT_FILE):
        pytest.skip("no vocabulary here")
    lib = tokenizers.Tokenizer.from_file(vocabulary.DEFAULT_FILE)
    lib.encode_special_tokens = True
    texts = [None, "", "Hi there", "<|endoftext|> x", "é漢🙂" * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "k bigint, t string").withColumn("ids", F.lit(0))
    want = {i: lib.encode(t or "", add_special_tokens=False).ids + [9] for i, t in enumerate(texts)}
    assert {r.k: r.ids for r in vocabulary.encoded(df, "k", "t", eos=9).collect()} == want
    assert all(r.same for r in vocabulary.roundtrip(df, "k", "t").collect())
    used = {r.id: r.n for r in vocabulary.used_vocabulary(df, "t").collect()}
    assert used == Counter(x for ids in want.values() for x in ids[:-1])


def test_near_duplicates_of_empty_texts_and_copies(spark):
    docs = spark.createDataFrame([(1, ""), (2, None), (3, "a b c d e f"), (4, "a b c d e f"), (5, "u v w x y z")], "k bigint, t string")
    assert sorted(r.id for r in dedup.near_duplicates(docs, "k", "t").collect()) == [2, 4]


def test_verdicts_order(spark):
    gram = " ".join(f"w{i}" for i in range(13))
    rows = [(1, "sec", 0, gram), (2, "sec", 0, gram), (3, "sec", 0, "other text"), (4, "sec", 0, "Other  TEXT"), (5, "sec", 1, "other text"), (6, "x", 0, gram), (7, "x", 0, None), (8, "x", 0, "")]
    docs = spark.createDataFrame(rows, "k bigint, source string, shard int, t string")
    grams = dedup.eval_grams(spark.createDataFrame([(gram, None)], "p string, a string"), ["p", "a"])
    got = {r.k: r.verdict for r in dedup.verdicts(docs, "k", "source", "shard", "t", grams).collect()}
    assert got == {1: "contaminated", 2: "contaminated", 3: "kept", 4: "exact_dup", 5: "kept", 6: "kept", 7: "kept", 8: "exact_dup"}


def test_running_total_and_rank(spark):
    rng = random.Random(1)
    rows = [(g, i, rng.randint(0, 9)) for g in ("a", None) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, i bigint, v int")
    got = {(r.g, r.i): r.s for r in running_total(df, ["g"], "i", F.col("v"), "s", block=7).collect()}
    for g in ("a", None):
        total = 0
        for _, i, v in [r for r in rows if r[0] == g]:
            assert got[g, i] == total
            total += v
    ranks = [(r.i, r.rn) for r in global_rank(df.filter("g = 'a'"), [F.col("i")], "rn").collect()]
    assert sorted(ranks) == [(i, i + 1) for i in range(50)]


@pytest.mark.parametrize("n,windows", [(15, 0), (16, 1), (17, 1), (40, 2)])
def test_packing_drops_the_tail(spark, n, windows):
    df = spark.createDataFrame([("s", 1, [str(i) for i in range(n - 3)]), ("s", 2, []), ("s", 3, ["x", "y", "z"])], "g string, i bigint, t array<string>")
    out = packing.pack(df, ["g"], "i", "t", 16).orderBy("win").collect()
    assert len(out) == windows
    flat = [str(i) for i in range(n - 3)] + ["x", "y", "z"]
    assert [x for r in out for x in r.tokens] == flat[: windows * 16]


def test_quotas_and_split(spark):
    assert sampling.quotas(5, [("a", 0.5), ("b", 0.5)], "a") == [("a", 1, 2), ("b", 3, 4), ("a", 5, 5)]
    for n, want in ((1, 1), (49, 1), (50, 1), (100, 2)):
        df = spark.range(n).select(F.col("id").alias("k"))
        assert sampling.held_out(df, "k", 0.02, "s").filter("split = 'val'").count() == want
    assert sampling.held_out(spark.range(0).select(F.col("id").alias("k")), "k", 0.02, "s").count() == 0


@pytest.mark.parametrize("text,ok", [('{"pairs": []}', True), ('so: {"pairs": [{"question": "q", "answer": "a"}]} end', True), ("none", False), ("} {", False), ("[1]", False), (None, False)])
def test_json_salvage(spark, text, ok):
    assert one(spark, instruct.salvaged(F.col("t"), instruct.PAIRS).isNotNull(), t=text) is ok


def test_similar_pairs_against_brute_force(spark):
    rng = random.Random(3)
    base = ["the quick brown fox jumps over the lazy dog near the old mill", "every court held that the lease was void under the statute"]
    texts = [b if k == 0 else re.sub(r"o", "0", b, count=k) for b in base for k in range(4)] + ["".join(rng.choice("abcdef ") for _ in range(60)) for _ in range(10)]
    df = spark.createDataFrame(list(enumerate(texts)), "k bigint, t string")

    def vec(t):
        import hashlib

        t = " ".join(t.lower().split())
        return Counter(hashlib.md5(t[i : i + 4].encode()).hexdigest()[:3] for i in range(len(t) - 3))

    def cos(a, b):
        dot = sum(a[x] * b[x] for x in a)
        return dot / (sum(v * v for v in a.values()) * sum(v * v for v in b.values())) ** 0.5

    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if cos(vec(texts[i]), vec(texts[j])) > 0.7}
    assert {(r.a, r.b) for r in instruct.similar_pairs(df, "k", "t", 0.7).collect()} == want


def grams_of(t):
    import hashlib

    t = " ".join(t.lower().split())
    return Counter(hashlib.md5(t[i : i + 4].encode()).hexdigest()[:3] for i in range(len(t) - 3))


def stays(rows, cosine):
    """Keys that stay in order; products are added one by one, as SQL adds them."""
    kept = []
    for key, t in rows:
        v = grams_of(t)
        length = sum(n * n for n in v.values()) ** 0.5
        own = {k: n / length for k, n in v.items()}
        for _, other in kept:
            total = 0.0
            for k in sorted(own.keys() & other.keys()):
                total += own[k] * other[k]
            if total > cosine:
                break
        else:
            kept.append((key, own))
    return [k for k, _ in kept]


@pytest.mark.parametrize("block", [7, 1000])
def test_drop_similar_against_brute_force(spark, monkeypatch, block):
    from corpusmill.operators import similar

    monkeypatch.setattr(similar, "BLOCK_ROWS", block)
    monkeypatch.setattr(similar, "TILE", (5, 3))
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(60)]
    texts = []
    for _ in range(12):  # chains: each differs by a word or two from the one before
        t = [rng.choice(words) for _ in range(30)]
        for _ in range(6):
            t = [*t]
            t[rng.randrange(30)] = rng.choice(words)
            texts.append(" ".join(t))
    texts += ["ab ab ab " * 200, "ab ab ab " * 150 + "tail", "x" * 300, "x" * 299 + "y", "abc", "abc", "", "\u6cd5\u5ead\u306f\u5951\u7d04", "\U0001f600" * 5, texts[3], texts[3].upper()]
    texts += ["abcdefghijklmnopqrstuvw", "abcdefghijklmnopqrstuvz"]  # 19 of 20 grams: as near 0.95 as can be
    rng.shuffle(texts)
    rows = [(k * 7 % 1009, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "k bigint, t string")
    got = sorted(r.k for r in instruct.drop_similar(df, "k", "t", 0.95).collect())
    assert got == sorted(stays(sorted(rows), 0.95)) and len(got) < len(rows)
    empty = instruct.drop_similar(df.filter("k < 0"), "k", "t", 0.95)
    assert empty.count() == 0 and empty.columns == ["k", "t"]


def test_drop_similar_stores_no_pairs(spark):
    """Texts that share most grams, all similar or all not, are shuffled by their size, not by that of their pairs."""
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(80)]
    near = "the tenant of the mill paid the rent that the lease of the old river house names each month "
    rows = [(k, near * 2 + str(k)) for k in range(1500)] + [(k, " ".join(rng.choice(words) for _ in range(30))) for k in range(1500, 3000)]
    store = spark.sparkContext._jsc.sc().statusStore()

    def written():
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
        return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}

    before = written()
    kept = instruct.drop_similar(spark.createDataFrame(rows, "k bigint, t string").repartition(4), "k", "t", 0.95).count()
    assert 1 <= kept <= 1501
    assert sum(n for k, n in written().items() if k not in before) < 4 * sum(len(t) for _, t in rows)


def test_formats(spark, tmp_path):
    from corpusmill.sources import formats

    df = spark.createDataFrame([(1, "a\nb  c"), (2, ""), (3, None)], "k bigint, t string")
    formats.write_corpus_lines(df, "t", str(tmp_path / "lines"))
    assert [r.text for r in formats.read_corpus_lines(spark, str(tmp_path / "lines")).collect()] == ["a b c"]
    formats.write_json_lines(df, str(tmp_path / "json"))
    assert formats.read_json_lines(spark, str(tmp_path / "json")).count() == 3
    ids = spark.createDataFrame([(1, [0, 65535, 7]), (2, [])], "k bigint, ids array<int>")
    back = formats.bytes_to_windows(formats.windows_to_bytes(ids, ["k"], "ids"), ["k"], "data")
    assert sorted((r.k, r.ids) for r in back.collect()) == [(1, [0, 65535, 7]), (2, [])]


def test_entry(spark, tiny):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
