"""Each operator against brute force or planted cases, and on edge tables."""

import random

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import leaks, mixing, pairs, quality, repetition, scans, spam, splits, standing, tokens

NOUNS = "court lease tenant verdict statute agency harbour orchard mill ferry witness magistrate clause record parcel surety".split()
ADJS = "binding quiet early formal private rural severe tacit upper vested western written minor lasting final current".split()
VERBS = "reviewed granted declined settled upheld opened signed traced valued weighed barred closed drafted earned funded handled".split()


def sentence(rng):
    return f"The {rng.choice(ADJS)} {rng.choice(NOUNS)} {rng.choice(VERBS)} each {rng.choice(NOUNS)} in the {rng.choice(ADJS)} {rng.choice(NOUNS)} of the {rng.choice(NOUNS)}."


def prose(rng, n):
    return " ".join(sentence(rng) for _ in range(n))


EDGES = ["", " ", "\n\n", None, "x", "a" * 300_000, "the " * 60_000, "⚖️ ok", "<|endoftext|>", "\r\n\t \x0b", "é ü ﬁ 漢字 🙂"]


# ---- tokens ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    with open(tokens.DEFAULT_VOCABULARY, "rb") as f:
        return f.read()


def test_merges_equal_the_library(vocabulary):
    tiktoken = pytest.importorskip("tiktoken")
    other = tiktoken.Encoding("own", pat_str=tokens.PRETOKEN, mergeable_ranks=tokens.load_ranks(vocabulary), special_tokens={})
    encode = tokens.encoder(vocabulary)
    rng = random.Random(1)
    texts = [t or "" for t in EDGES] + ["".join(rng.choice("abcdeé漢 \n'sTHE0123🙂") for _ in range(rng.randint(1, 400))) for _ in range(60)]
    for t in texts:
        assert encode(t) == other.encode_ordinary(t)


def test_short_and_long_merges_agree(vocabulary):
    ranks = tokens.load_ranks(vocabulary)
    rng = random.Random(2)
    for _ in range(200):
        word = "".join(rng.choice("aabcdeinorst") for _ in range(rng.randint(1, 90))).encode()
        assert tokens.merge_short(word, ranks) == tokens.merge_long(word, ranks)


def test_ids_of_null_and_clashing_columns(spark):
    rows = spark.createDataFrame([(1, None, 5, "z"), (2, "", 6, "z"), (3, "Hi", 7, "z"), (3, "Hi", 7, "z")], "doc_id bigint, text string, ids int, k string")
    got = sorted((r.doc_id, r.ids) for r in tokens.encode_column(rows, "doc_id", "text").collect())
    assert got == [(1, []), (2, []), (3, [17250]), (3, [17250])]
    assert tokens.encode_column(rows.limit(0), "doc_id", "text").count() == 0


# ---- repetition ------------------------------------------------------------------------


def brute_share(text, window=5):
    words = repetition.WORD.findall((text or "").lower())
    grams = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    seen = {g for g in grams if grams.count(g) > 1}
    hit = set()
    for i, g in enumerate(grams):
        if g in seen:
            hit.update(range(i, i + window))
    return len(hit) / len(words) if words else 0.0


def test_repeated_share_against_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", "one", "a b c d e", "a b c d e a b c d e", "A b, c d; e. a B c d e f"] + [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 60))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "rec_id bigint, text string").withColumn("source", F.lit("x")).withColumn("share", F.lit(9))
    got = {r.rec_id: r.share for r in repetition.repeated_share(df, ["source", "rec_id"], "text").collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(brute_share(t)), t


def test_line_frequency(spark):
    rows = [(i, "h", f"Legal  Notice\nbody {i}\n") for i in range(6)] + [(10, None, "Legal Notice"), (11, "h", None), (12, "g", "Legal notice")]
    df = spark.createDataFrame(rows, "k bigint, host string, t string")
    got = {r.k: (r.n_lines, r.n_removed) for r in repetition.line_frequency(df, "k", "host", "t").collect()}
    assert got[0] == (2, 1) and got[10] == (1, 0) and got[11] == (0, 0) and got[12] == (1, 0)


# ---- standing lines --------------------------------------------------------------------


def test_containers_round_trip():
    rng = random.Random(5)
    for n in (0, 1, 50, 4096, 4097, 30_000):
        places = sorted(rng.sample(range(65536), n))
        import numpy as np

        data = standing.pack(np.array(places, np.int64))
        assert standing.unpack(data).tolist() == places and standing.cardinality(data) == n
    a, b = standing.pack(np.array([1, 2, 3])), standing.pack(np.array([3, 4]))
    assert standing.unpack(standing.unite([a, b])).tolist() == [1, 2, 3, 4]


def test_standing_lines(spark):
    rng = random.Random(6)
    rows, want = [], set()
    line = "Document control no. {}: the quiet committee, as Ostkoham noted, reviewed the bitter audit"
    for i in range(10):
        body = [prose(rng, 3), prose(rng, 2)]
        if i < 3:
            body.insert(1, line.format(i))
            want.add((i, 1))
        elif i == 3:
            body.insert(0, ("> " + line.format("7-2012")).upper())
            want.add((i, 0))
        elif i == 4:
            body.insert(0, line.format(3).replace("bitter", "novel"))
            want.add((i, 0))
        elif i == 5:
            body[1:1] = ["Document control no. 5: the quiet committee,", "as Ostkoham noted, reviewed the bitter audit"]
            want.update({(i, 1), (i, 2)})
        rows.append((i, "f", "\n".join(body)))
    rows += [(20, "g", line.format(1)), (21, None, line.format(1)), (22, "f", None), (23, "e", "")]
    df = spark.createDataFrame(rows, "sec_id bigint, filer string, text string").withColumn("id", F.lit(1)).withColumn("host", F.lit("z"))
    got = {(r.sec_id, r.line_no) for r in standing.standing_lines(df, "sec_id", "filer", "text").collect()}
    assert got == want
    cleaned = {r.sec_id: r.text for r in standing.cleaned(df, "sec_id", "filer", "text").collect()}
    assert "Ostkoham" not in cleaned[0] and cleaned[22] is None and cleaned[20] == line.format(1) and len(cleaned) == len(rows)
    assert standing.standing_lines(df.limit(0), "sec_id", "filer", "text").count() == 0


def test_the_filter_only_spares_work(spark, monkeypatch):
    rng = random.Random(16)
    rows = [(i, "f", f"Filed for the upper registrar of Ostholt on 2001-0{i + 1}-01\n{prose(rng, 3)}") for i in range(6)]
    df = spark.createDataFrame(rows, "sec_id bigint, filer string, text string")
    find = lambda: {(r.sec_id, r.line_no) for r in standing.standing_lines(df, "sec_id", "filer", "text").collect()}
    assert find() == {(i, 0) for i in range(6)}
    # a filter so small that all wordings pass it gives the same lines
    monkeypatch.setattr(standing, "FILTER_LEAST", 16)
    monkeypatch.setattr(standing, "half_filter", lambda usual: __import__("numpy").full(1 << 13, 255, "uint8"))
    assert find() == {(i, 0) for i in range(6)}


def test_short_and_broken_standing_lines(spark):
    rng = random.Random(26)
    rows, want = [], set()
    for i in range(10):
        body = [prose(rng, 2), "Confidential" if i < 6 else prose(rng, 1), prose(rng, 2)]
        if i < 6:
            want.add((i, 1))
        if i < 4:
            body.append(f"Printed June {i}, 2001 for Ostkoham Lines, sheet {i}")
            want.add((i, 3))
        elif i < 6:
            body += [f"Printed June {i}, 2001 for", f"Ostkoham Lines, sheet {i} of 9".replace(" of 9", "")]
            want.update({(i, 3), (i, 4)})
        rows.append((i, "f", "\n".join(body)))
    df = spark.createDataFrame(rows, "sec_id bigint, filer string, text string")
    assert {(r.sec_id, r.line_no) for r in standing.standing_lines(df, "sec_id", "filer", "text").collect()} == want


def test_variants_reach_the_threshold_only_together(spark):
    """Bitmaps united over ties decide: no wording alone is in enough documents, all of them together are."""
    rng = random.Random(27)
    tail = "quiet committee of the upper harbour reviewed the bitter audit"
    rows = [(i, "f", f"{NOUNS[i]} {tail}\n{prose(rng, 2)}") for i in range(6)] + [(i, "f", prose(rng, 3)) for i in range(6, 14)]
    df = spark.createDataFrame(rows, "sec_id bigint, filer string, text string")
    assert {(r.sec_id, r.line_no) for r in standing.standing_lines(df, "sec_id", "filer", "text").collect()} == {(i, 0) for i in range(6)}
    rows[0] = (0, "f", "entirely other words stand here instead of those\n" + prose(rng, 2))
    df = spark.createDataFrame(rows, "sec_id bigint, filer string, text string")
    assert standing.standing_lines(df, "sec_id", "filer", "text").count() == 0


def test_groups_are_merged_in_parts(spark):
    rng = random.Random(28)
    rows = [(k, c, rng.randrange(65536)) for k in range(3) for c in range(2) for _ in range(500)]
    df = spark.createDataFrame(rows, "key bigint, chunk int, low int").distinct()
    whole = standing._grouped(df, standing.pack_list, "low", 7)
    got = {(r.key, r.chunk): standing.unpack(bytes(r.bitmap)).tolist() for r in whole.collect()}
    assert got == {g: sorted({low for k, c, low in rows if (k, c) == g}) for g in {r[:2] for r in rows}}


def test_one_large_filer_with_a_changing_word_grows_in_proportion(spark):
    import time

    def seconds(n):
        rows = spark.range(n).selectExpr(
            "id as sec_id", "'f' as filer",
            "concat('The quiet committee of Ostholt reviewed word', translate(cast(id as string), '0123456789', 'abcdefghij'), ' for the upper registrar of the harbour\n', translate(md5(cast(id as string)), '0123456789', 'ghijklmnop')) as text",
        )
        began = time.time()
        assert standing.standing_lines(rows, "sec_id", "filer", "text").count() == n
        return time.time() - began

    seconds(200)
    small, large = seconds(2_000), seconds(20_000)
    assert large < 6 * small + 10


# ---- leaks -----------------------------------------------------------------------------


def test_leaks(spark):
    rng = random.Random(7)
    items = {k: prose(rng, 4) for k in range(5)}
    items[5] = items[0]
    items[6], items[7] = None, ""
    items[8] = "the zylor quonked nine vermilion pelts"
    w = items[1].split()
    noisy = [x if i % 11 else "xx" for i, x in enumerate(items[2].split())]
    texts = {
        0: prose(rng, 3) + " " + items[0].upper() + " " + prose(rng, 3),
        1: prose(rng, 2) + " " + " ".join(w[5:35]).replace(" ", "  \n"),
        2: prose(rng, 2) + " " + " ".join(noisy) + prose(rng, 2),
        3: prose(rng, 2) + " " + " ".join(w[5:17]) + " " + prose(rng, 2),
        4: None,
        5: "",
        6: "he said " + items[8].upper() + " again",
    }
    df = spark.createDataFrame(list(texts.items()), "rec_id bigint, text string").withColumn("head", F.lit(0)).withColumn("item_id", F.lit(0))
    got = {(r.rec_id, r.item_id) for r in leaks.leaks(df.drop("item_id"), ["rec_id"], "text", items).collect()}
    assert got == {(0, 0), (0, 5), (1, 1), (2, 2), (6, 8)}
    assert leaks.leaks(df.limit(0), ["rec_id"], "text", items).count() == 0
    assert leaks.leaks(df, ["rec_id"], "text", {}).count() == 0


def test_common_phrases_pair_nothing_and_longest_matches_are_exact(spark):
    rng = random.Random(31)
    phrase = "which of the following statements is true under the"
    items = {k: f"{phrase} {' '.join(rng.choice(ADJS + NOUNS + VERBS) + str(rng.randrange(99)) for _ in range(30))}" for k in range(200)}
    items[500] = "two words"
    index = leaks.Items(items)
    texts = [f"{prose(rng, 1)} {phrase} harbour" for _ in range(50)] + [f"{prose(rng, 2)} {items[7]} {prose(rng, 1)}", "he gave two words only", None, ""]
    seen = []
    keep = leaks.longest_run
    leaks.longest_run = lambda *a: seen.append(a) or keep(*a)
    try:
        out = leaks.search(texts, index)
    finally:
        leaks.longest_run = keep
    hits = [m for m in out if leaks.enough(m[2], m[3], len(index.words[m[1]]), leaks.MIN_RUN)]
    assert {(m[0], m[1]) for m in hits} == {(50, 7), (51, 500)} and len(seen) < 100
    row, item, _, _, longest, at = next(m for m in hits if m[1] == 7)
    words = leaks.words_of(texts[50])
    assert longest == len(index.words[7]) and words[at : at + longest] == index.words[7]


def test_passages_that_many_items_share_give_all_of_them_away():
    rng = random.Random(41)
    frame = [f"frame{i}" for i in range(28)]
    own = lambda k, n: [f"own{k}x{i}" for i in range(n)]
    items = {k: " ".join(frame + own(k, 12)) for k in range(80)}
    # a template with a word of its own after every six, and short prompts with one in the middle
    gaps = [f"gap{i}" for i in range(36)]
    items |= {100 + k: " ".join(w for i in range(0, 36, 6) for w in [*gaps[i : i + 6], f"own{k}y{i}"]) for k in range(80)}
    items |= {200 + k: " ".join(["s1 s2 s3 s4 s5 s6", f"own{k}z", "s7 s8 s9 s10 s11"]) for k in range(80)}
    texts = [
        f"{prose(rng, 1)} {' '.join(frame)} {prose(rng, 1)}",
        f"{prose(rng, 1)} {' '.join(w for i in range(0, 36, 6) for w in [*gaps[i : i + 6], 'other'])} {prose(rng, 1)}",
        "he said s1 s2 s3 s4 s5 s6 other s7 s8 s9 s10 s11 again",
        f"{prose(rng, 1)} {' '.join(frame[:9])} {' '.join(gaps[:6])} {prose(rng, 1)}",
    ]
    index = leaks.Items(items)

    def hits():
        return sorted(m for m in leaks.search(texts, index) if leaks.enough(m[2], m[3], len(index.words[m[1]]), leaks.MIN_RUN))

    found = hits()
    assert [m[:2] for m in found] == [(0, k) for k in range(80)] + [(1, 100 + k) for k in range(80)] + [(2, 200 + k) for k in range(80)]
    assert {m[4] for m in found if m[0] == 0} == {28} and {m[5] for m in found if m[0] == 0} == {len(leaks.words_of(texts[0])) - len(leaks.words_of(texts[0].split(frame[0])[1])) - 1}
    # portions change nothing
    keep, leaks.PAIRS = leaks.PAIRS, 50
    try:
        assert hits() == found
    finally:
        leaks.PAIRS = keep


def test_a_longer_run_that_gives_nothing_away_hides_no_other():
    words = [f"w{i}" for i in range(60)]
    loose = [w if i < 10 or i % 3 else "zzzzz" for i, w in enumerate(words)]
    far = " ".join(f"far{i}" for i in range(200))
    index = leaks.Items({1: " ".join(words)})
    for text in (f"{' '.join(loose)} {far} {' '.join(words[32:58])}", f"{' '.join(words[32:58])} {far} {' '.join(loose)}"):
        assert [leaks.enough(m[2], m[3], 60, leaks.MIN_RUN) for m in leaks.search([text], index)] == [True]


def test_pairing_equals_counting_every_pair():
    import numpy as np

    rng = random.Random(47)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60))) for _ in range(12)]
    items = {k: " ".join(rng.choice("abcd") for _ in range(rng.randint(4, 30))) for k in range(90)}
    index = leaks.Items(items)
    n = len(index.search_hi)
    row, name, where = (np.array([rng.randrange(m) for _ in range(400)]) for m in (12, n, 10_000))
    every = {}
    for r, g, p in {*zip(row.tolist(), name.tolist(), where.tolist())}:
        for e in np.flatnonzero(index.of == g).tolist():
            every.setdefault((r, int(index.item[e])), set()).add((p, e))
    want = {(r, *m) for (r, k), ms in every.items() if len({int(index.place[e]) + d for _, e in ms for d in range(4)}) >= leaks.least_seeded(len(index.words[k])) for m in ms}
    keep = leaks.PAIRS
    try:
        for leaks.PAIRS in (1, 300, keep):
            got = [t for part in leaks.paired(row, name, where, index) for t in zip(*(x.tolist() for x in part))]
            assert set(got) == want
    finally:
        leaks.PAIRS = keep


def test_one_changed_word_in_a_short_prompt():
    words = [f"w{c}" for c in "abcdefghijklmn"]
    index = leaks.Items({1: " ".join(words), 2: "the quiet mill closed in early spring"})
    for at in (2, 3, 7, 11):
        other = [*words]
        other[at] = "zz"
        found = leaks.search(["he said " + " ".join(other) + " again"], index)
        assert [(m[1], leaks.enough(m[2], m[3], 14, 25)) for m in found] == [(1, True)]
    assert [m[1] for m in leaks.search(["so the quiet mi1l closed in early spring again"], index)] == [2]


def test_binary_search_finds_every_suffix():
    rng = random.Random(8)
    item = " ".join(rng.choice("abcdef") for _ in range(200))
    text = " ".join(rng.choice("abcdef") for _ in range(3000))
    import numpy as np

    index = leaks.Items({1: item})
    ids = np.array([index.number.get(x, 0) for x in text.split()], np.int64)
    hi, lo = leaks.packed(ids)
    whole = np.arange(len(ids) - leaks.DEPTH + 1)
    order = np.lexsort((lo[whole], hi[whole]))
    a, b = leaks.ranges(hi[whole][order], lo[whole][order], index.search_hi, index.search_lo)
    words = text.split()
    d = leaks.DEPTH
    grams = [tuple(words[i : i + d]) for i in range(len(words) - d + 1)]
    mine = {tuple(item.split()[i : i + d]) for i in range(200 - d + 1)}
    assert int((b - a).sum()) == sum(g in mine for g in grams)


# ---- scans -----------------------------------------------------------------------------


def test_scan_damage_and_repair(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, 60)) for i in range(40)]
    damaged = "\n".join(
        [
            "Fenham v. Norwick",
            "The quiet court revi-",
            "ewed each lease in the we5tern mill of the record.",
            "   [211]",
            "FENHAM V. NORWICK",
            "The b|nding tenant granted each ver",
            "dict in the written agency of the long-",
            "term parcel. The sev ere ferry closed each clause in",
            "the final statute of the surety.",
            "II.",
            "Each witness signed.",
        ]
    )
    rows += [(100, damaged), (101, None), (102, ""), (103, "a long-term view of the long-term parcel")] + [(104 + i, "the long-term parcel") for i in range(6)]
    df = spark.createDataFrame(rows, "case_id bigint, document string").withColumn("id", F.lit("z")).withColumn("t", F.lit("z"))
    got = {(r.line_no, r.kind) for r in scans.damage(df, "case_id", "document").collect() if r.case_id == 100}
    assert got == {(1, "broken_word"), (2, "misread"), (3, "furniture"), (4, "furniture"), (5, "broken_word"), (5, "misread"), (7, "misread")}
    text = {r.case_id: r.document for r in scans.repaired(df, "case_id", "document").collect()}
    assert text[101] is None and text[102] == "" and len(text) == len(rows)
    for part in ("reviewed each lease in the western mill", "The binding tenant granted each verdict in", "The severe ferry"):
        assert part in text[100]
    assert "211" not in text[100]
    assert scans.damage(df.limit(0), "case_id", "document").count() == 0


def test_weights_prefer_confused_shapes():
    assert scans.weight("bcfore", "before") == scans.weight("clanger", "danger") == 0.5
    assert scans.weight("vvestern", "western") == 0.5 and scans.weight("re~uced", "reduced") == 0.5
    assert scans.weight("before", "before") == 0 and scans.weight("bxfore", "before") > 1


def whole_weight(read, printed):
    """The distance over the whole words, by every way to part them."""
    from functools import cache

    @cache
    def of(i, j):
        if i == len(read) and j == len(printed):
            return 0.0
        best = 9.0
        if i < len(read) and j < len(printed):
            x, y = read[i], printed[j]
            cost = 0.0 if x == y else 0.3 if x.lower() == y else 0.5 if (x.lower(), y) in scans.PAIRS or not (x.isalpha() and x.isascii()) else 1.5
            best = cost + of(i + 1, j + 1)
        for m in (1, 2, 3):
            for n in (1, 2):
                if m + n > 2 and (read[i : i + m].lower(), printed[j : j + n]) in scans.PAIRS and i + m <= len(read) and j + n <= len(printed):
                    best = min(best, 0.5 + of(i + m, j + n))
        if i < len(read):
            best = min(best, 1.5 + of(i + 1, j))
        return min(best, 1.5 + of(i, j + 1)) if j < len(printed) else best

    return of(0, 0)


def test_weights_against_all_ways_to_part_the_words():
    rng = random.Random(32)
    for _ in range(3000):
        word = rng.choice(["court", "modern", "clinging", "dirndl", "million", "illness", "corner"])
        read = list(word)
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(read))
            read[i] = rng.choice(["c", "e", "rn", "m", "ii", "cl", "d", "1", "~", "B", "li", "h", ""])
        read = "".join(read)
        want = whole_weight(read, word)
        got = scans.weight(read, word, 1.06)
        assert got == pytest.approx(want) if want < 1.06 else got == 9.0


def test_plain_running_headers_and_bad_scans(spark):
    rng = random.Random(33)
    rows = [(i, prose(rng, 60)) for i in range(40)]
    page = lambda: "\n".join(f"the quiet court reviewed each lease of the {rng.choice(ADJS)}" for _ in range(3))
    rows.append((100, f"{page()}\nOPINION OF THE COURT\n{page()}\nOPINION OF THE COURT\n{page()}\nOPINION OF THE COURT\n{page()}"))
    bad = " ".join("we5tern" if i % 2 else "qzxv" + NOUNS[i % 16][::-1] for i in range(30))
    rows.append((101, bad))
    df = spark.createDataFrame(rows, "case_id bigint, document string")
    got = {(r.case_id, r.line_no, r.kind) for r in scans.damage(df, "case_id", "document").collect()}
    assert {g for g in got if g[0] == 100} == {(100, n, "furniture") for n in (3, 7, 11)} and (101, 0, "misread") in got


# ---- splits ----------------------------------------------------------------------------


def test_overlaps_against_all_pairs(spark):
    rng = random.Random(10)
    rows = []
    for k in range(30):
        passage, question = prose(rng, 6), f"What did the {rng.choice(ADJS)} {rng.choice(NOUNS)} of {k} decide about the {rng.choice(NOUNS)}?"
        rows.append((10 * k, "train", f"Context:\n{passage}\n\n{question}"))
        if k % 3 == 0:
            words = passage.split()
            words[7] = "novel"
            rows.append((10 * k + 1, "test", f"CONTEXT\n\n{' '.join(words).lower()}\n\nPlease answer: {question}"))
        if k % 3 == 1:
            rows.append((10 * k + 2, "val", f"Context:\n{passage}\n\nSummarize the passage in two short sentences."))
    rows += [(900, "train", None), (901, "test", None), (902, None, rows[0][2]), (903, "train", rows[0][2]), (904, "test", ""), (905, "train", ""), (906, "val", "Hi"), (907, "train", "Hi")]
    df = spark.createDataFrame(rows, "row_id bigint, split string, user string").withColumn("id", F.lit(0)).withColumn("held", F.lit(0))
    got = {(r.row_a, r.row_b) for r in splits.overlaps(df).collect()}
    want = set()
    for a, sa, ua in rows:
        for b, sb, ub in rows:
            if sa == "train" and sb in ("val", "test") and ua and ub:
                (pa, qa), (pb, qb) = splits.parts(ua), splits.parts(ub)
                if qa and splits.agree(qa, qb) and (splits.agree(pa, pb) or pa == pb):
                    want.add((min(a, b), max(a, b)))
    assert got == want and (0, 1) in got and (1, 903) in got and (10, 12) not in got and (906, 907) in got
    assert splits.overlaps(df.limit(0)).count() == 0


# ---- pairs -----------------------------------------------------------------------------


def test_defects(spark):
    rng = random.Random(11)
    p = prose(rng, 5)
    q = f"Context:\n{p}\n\nWhich party reviewed the early mill?"
    cases = {
        1: (q, None, "lookup", "empty"),
        2: (q, " \xa0", "lookup", "empty"),
        3: (q, "N/A", "lookup", "empty"),
        4: (q, "Which party reviewed the early mill", "lookup", "copies_question"),
        5: (q, "I'm sorry, but I can't help with that request.", "lookup", "refusal"),
        6: (q, "This is not stated in the context.", "unanswerable", None),
        7: (q, "Le tribunal examina la décision dans la salle et le comité reporta les débats pour les parties.", "lookup", "other_language"),
        8: (q, "The court granted the lease because the", "reasoning", "truncated"),
        9: (q, '{"facts": ["the court granted', "extract", "truncated"),
        10: (q, "The early mill", "lookup", None),
        11: (q, p.split(".")[0] + ".", "lookup", None),
        12: (None, "The court granted the lease.", "lookup", None),
        13: (q, p[: p.rindex(" ", 0, 60) + 3], "lookup", "truncated"),
    }
    df = spark.createDataFrame([(k, u, a, t) for k, (u, a, t, _) in cases.items()], "row_id bigint, user string, assistant string, kind string").withColumn("k", F.lit(0)).withColumn("answer", F.lit(""))
    got = {r.row_id: r.defect for r in pairs.defects(df, "row_id", "user", "assistant", "kind").collect()}
    assert got == {k: d for k, (_, _, _, d) in cases.items() if d}
    assert pairs.defects(df.limit(0), "row_id", "user", "assistant", "kind").count() == 0


def test_long_copies_with_words_round_them():
    rng = random.Random(16)
    asked = prose(rng, 80)
    words = asked.split(" ")
    assert len(words) > 420
    changed = " ".join("other" if i % 20 == 7 else w for i, w in enumerate(words))
    shuffled = " ".join(rng.sample(words, len(words)))
    assert pairs.copies(asked, asked) and pairs.copies(f"Question: {asked}", asked) and pairs.copies(changed, asked)
    assert not pairs.copies(shuffled, asked) and not pairs.copies(prose(rng, 80), asked)


def test_copies_given_more_than_once():
    q = "Context:\nThe early mill closed.\n\nPlease answer: Who later restored the slender pulley of the mill?"
    asked = "Who later restored the slender pulley of the mill?"
    assert pairs.copies(asked, q) and pairs.copies(f"{asked} {asked} {asked}", q) and pairs.copies(f"The question is: {asked}", q)
    assert not pairs.copies("Ostholt later restored the slender pulley of the mill.", q) and not pairs.copies("The early mill", q)


def test_neighbours_and_length_limits_decide(spark):
    """Answers that the rules alone take for finished: removing the sorted run or the pile-ups changes the rows."""
    q = "Context:\nThe upper mill stood up in 1984 with a quiet harbour, closed.\n\nWhat came of mill {}?"
    rows = [(1, q.format(1), "The clerk found that the harbour stood up", "lookup"), (2, q.format(2), "The clerk found that the harbour stood upper mill then.", "lookup")]
    rows += [(3, q.format(3), "The quiet upper mill stood up in the harbour", "lookup"), (4, q.format(3), "The quiet upper mill stood up in the harbour with a closed gate.", "lookup"), (5, q.format(5), "The quiet harbour", "lookup")]
    words = [a + b for a in ADJS for b in NOUNS]
    piled = [f"Of {w} the registry then said {'z' * (30 - len(w))}" for w in words[:100]]
    rows += [(100 + i, q.format(i), t, "lookup") for i, t in enumerate(piled)]
    rows += [(300 + i, q.format(i), f"It held {'z' * (30 - len(w))} {w} in all. {'z' * (30 - len(w))} was said.", "lookup") for i in range(20) for w in words[:100:5]]
    df = spark.createDataFrame(rows, "row_id bigint, user string, assistant string, kind string")
    found = lambda: {r.row_id for r in pairs.defects(df, "row_id", "user", "assistant", "kind").collect()}
    whole = found()
    assert {1, 3} <= whole and not {2, 4, 5} & whole
    keep = pairs.sorted_neighbours
    pairs.sorted_neighbours = lambda t, c: keep(t, c).limit(0)
    try:
        assert not {1, 3} & found()
    finally:
        pairs.sorted_neighbours = keep
    limits = pairs.length_limits(spark.createDataFrame([("x", f"{i:040d}") for i in range(60)] + [("x", "z" * 33)] * 60 + [("x", "y" * n) for n in range(20, 70)], "last string, answer string"))
    assert [r.size for r in limits.collect()] == [40]


def test_languages_are_compared_both_ways(spark):
    french = "Le tribunal examina la décision dans la salle et le comité reporta les débats pour les parties."
    english = "The court reviewed the decision in the hall and the committee put off the hearing for the parties."
    df = spark.createDataFrame([(1, french, english, "x"), (2, english, french, "x"), (3, french, "Les parties ne sont pas dans la salle, et le comité est pour une décision.", "x")], "row_id bigint, user string, assistant string, kind string")
    assert {r.row_id: r.defect for r in pairs.defects(df, "row_id", "user", "assistant", "kind").collect()} == {1: "other_language", 2: "other_language"}


def test_fragments_stay_fragments_as_the_table_grows(spark):
    q = "Context:\nThe finally heard appeal closed in 1984.\n\nWhat came of appeal {}?"
    rows = [(i, q.format(i), f"In matter {i} the clerk went to Ostv", "lookup") for i in range(40)]
    rows += [(100 + i, q.format(i), f"The appeal came before court {i} and was fin", "lookup") for i in range(40)]
    rows += [(200 + i, q.format(i), "Upheld", "lookup") for i in range(20)]
    rows += [(300 + i, q.format(i), f"The registry noted that it was closed in {i} days.", "lookup") for i in range(40)]
    rows += [(400, q.format(0), "An old registry", "lookup")]
    df = spark.createDataFrame(rows, "row_id bigint, user string, assistant string, kind string")
    got = {r.row_id: r.defect for r in pairs.defects(df, "row_id", "user", "assistant", "kind").collect()}
    assert got == {i: "truncated" for i in [*range(40), *range(100, 140)]}


def test_shortened_against_all_pairs(spark):
    rng = random.Random(12)
    texts = {"".join(rng.choice("ab ") for _ in range(rng.randint(1, 9))) for _ in range(300)}
    got = {r.answer for r in pairs.shortened(spark.createDataFrame([(t,) for t in texts], "answer string")).collect()}
    assert got == {a for a in texts if a[-1:].isalnum() and any(b != a and b.startswith(a) and b[len(a)].isalnum() for b in texts)}
    assert pairs.shortened(spark.createDataFrame([], "answer string")).count() == 0


# ---- quality and spam ------------------------------------------------------------------


def test_distributions_are_exact(spark):
    rng = random.Random(13)
    rows = [("en" if i % 3 else "de", *[round(rng.random(), 1) for _ in quality.STATISTICS], 9.0) for i in range(200)]
    df = spark.createDataFrame(rows, "lang string, " + ", ".join(f"{s} double" for s in quality.STATISTICS) + ", rest double")
    of_prose = [r for r in rows if r[1 + quality.STATISTICS.index("prose_share")] >= quality.HOLDS_PROSE]
    for r in quality.distributions(df).collect():
        at = 1 + quality.STATISTICS.index(r.stat)
        values = [x[at] for x in of_prose if r.lang in ("", x[0])]
        assert (r.below, r.above, r.total) == (sum(v <= r.value for v in values), sum(v >= r.value for v in values), len(values))


def test_the_outlier_score_decides(spark):
    """Removing the score adds rows: text that isn't sentences by the confirming rule alone, but of usual statistics."""
    base = {"mean_word_length": 5.0, "symbol_ratio": 0.02, "digit_ratio": 0.01, "ended_share": 0.8, "common_share": 0.3, "words_per_line": 12.0, "prose_share": 0.9}
    rng = random.Random(41)
    rows = [(i, *[round(v * rng.uniform(0.5, 1.1), 3) for v in base.values()], 90.0) for i in range(300)]
    rows += [(1000, *{**base, "prose_share": 0.55}.values(), 90.0), (1001, 5.0, 0.3, 0.4, 0.0, 0.0, 3.0, 0.1, 90.0)]
    df = spark.createDataFrame(rows, "rec_id bigint, " + ", ".join(f"{s} double" for s in base) + ", rest double").withColumn("lang", F.lit("en"))
    out = quality.outlier_scores(df)
    confirmed = {r.rec_id for r in out.filter((F.col("prose_share") <= quality.MAX_PROSE) & (F.col("rest") >= quality.MIN_REST_WORDS)).collect()}
    found = {r.rec_id for r in out.filter(quality.junk()).collect()}
    assert found == {1001} and {1000, 1001} <= confirmed


def test_junk_and_prose(spark):
    rng = random.Random(14)
    table_text = "\n".join(f"Core audit | {rng.randint(1000, 9999)} | {rng.random():.2f} | -" for _ in range(30))
    rows = [(i, prose(rng, 10)) for i in range(60)] + [(100, table_text), (101, sentence(rng) + "\n" + table_text), (102, prose(rng, 8).upper()), (103, prose(rng, 10) + "\n" + table_text[:90]), (104, None), (105, "")]
    df = spark.createDataFrame(rows, "rec_id bigint, text string").withColumn("source", F.lit("x"))
    lines = quality.line_statistics(df).withColumn("gone", F.lit(None).cast("array<int>"))
    out = quality.outlier_scores(quality.checkpointed(quality.record_statistics(lines)))
    assert {r.rec_id for r in out.filter(quality.junk()).collect()} == {100, 101}
    assert out.count() == len(rows)


def test_common_junk_is_found(spark):
    rng = random.Random(15)
    tables = ["\n".join(f"Core audit | {rng.randint(1000, 9999)} | {rng.random():.2f} | -" for _ in range(30)) for _ in range(40)]
    rows = [(i, prose(rng, 10)) for i in range(60)] + [(100 + i, t) for i, t in enumerate(tables)]
    df = spark.createDataFrame(rows, "rec_id bigint, text string").withColumn("source", F.lit("x"))
    lines = quality.line_statistics(df).withColumn("gone", F.lit(None).cast("array<int>"))
    out = quality.outlier_scores(quality.checkpointed(quality.record_statistics(lines)))
    assert {r.rec_id for r in out.filter(quality.junk()).collect()} == set(range(100, 140))


def test_stuffed_pages(spark):
    rng = random.Random(15)
    keywords = " | ".join(rng.choice(["cheap will kit", "will kit Ostholt", "best will kit online", "will kit free"]) for _ in range(80))
    rows = [(i, prose(rng, 12)) for i in range(60)] + [(100, keywords), (101, prose(rng, 3) + "\n" + keywords), (102, prose(rng, 30) + "\n" + keywords[:60]), (103, None), (104, ""), (105, "will kit will kit")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("k", F.lit(0)).withColumn("chars", F.lit(0))
    got = {r.doc_id for r in spam.stuffed_pages(df, "doc_id", "text").filter(spam.is_stuffed()).collect()}
    assert got == {100, 101}
    assert spam.stuffed_pages(df.limit(0), "doc_id", "text").count() == 0


def test_redundancy_decides_and_medians_are_exact(spark):
    """A page of captions as varied as prose isn't stuffed; removing the compression ratio would name it."""
    rng = random.Random(42)
    stuffed = " | ".join(rng.choice(["cheap will kit", "will kit Ostholt", "best will kit online"]) for _ in range(80))
    varied = "\n".join(f"{rng.choice(ADJS)} {rng.choice(NOUNS)} {''.join(rng.choice('abcdefghijklmnopqrstuvwxyz') for _ in range(14))}" for _ in range(30))
    df = spark.createDataFrame([(i, prose(rng, 12)) for i in range(60)] + [(100, stuffed), (101, varied)], "doc_id bigint, text string")
    out = spam.stuffed_pages(df, "doc_id", "text")
    assert {r.doc_id for r in out.filter(F.col("stuffed") >= spam.MIN_STUFFED).collect()} == {100, 101}
    assert {r.doc_id for r in out.filter(spam.is_stuffed()).collect()} == {100}
    blocks = [("en", rng.randrange(3), round(rng.random(), 2)) for _ in range(300)]
    got = {r.step: r.m for r in spam.medians(spark.createDataFrame(blocks, "lang string, step int, ratio double"), ["step"], "m").collect()}
    assert got == {s: sorted(r for _, t, r in blocks if t == s)[(sum(t == s for _, t, _ in blocks) - 1) // 2] for s in range(3)}


# ---- mixing ----------------------------------------------------------------------------


def test_raking_meets_sources_and_caps():
    cells = [{"source": s, "lang": x, "topic": t, "tokens": n} for s, n in (("a", 900), ("b", 300), ("c", 30)) for x in ("en", "de") for t in ("law", "other")]
    weights, total = mixing.rake(cells, {"a": 0.5, "b": 0.4, "c": 0.1}, {"a": 1, "b": 2, "c": 3})
    sums = {s: sum(w * c["tokens"] for w, c in zip(weights, cells) if c["source"] == s) for s in "abc"}
    assert total == pytest.approx(3600) and [sums[s] / total for s in "abc"] == pytest.approx([0.5, 0.4, 0.1], abs=1e-6)
    assert all(w <= {"a": 1, "b": 2, "c": 3}[c["source"]] + 1e-9 for w, c in zip(weights, cells))
    assert mixing.rake(cells, {"z": 1.0}, {"z": 1})[1] == 0.0


def test_mix_reaches_shares(spark):
    rng = random.Random(17)
    rows = [(i, "ab"[i % 2] if i % 10 else "c", rng.choice(["en", None]), rng.choice(["law", "other"]), rng.randint(0, 400)) for i in range(4000)] + [(9000, None, None, None, 5), (9001, "zz", None, None, 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, topic string, n int").withColumn("weight", F.lit(0)).withColumn("id", F.lit(0))
    targets = spark.createDataFrame([("a", 0.4, 1), ("b", 0.3, 2), ("c", 0.3, 3)], "source string, target_share double, max_repeats int")
    out = mixing.mix(df, targets, "doc_id", "source", "lang", "topic", "n").collect()
    assert {r.source for r in out} == {"a", "b", "c"} and len(out) == 4000
    total = sum(r.copies * r.n_tokens for r in out)
    for s, share, most in (("a", 0.4, 1), ("b", 0.3, 2), ("c", 0.3, 3)):
        assert sum(r.copies * r.n_tokens for r in out if r.source == s) / total == pytest.approx(share, abs=0.01)
        assert max(r.copies for r in out if r.source == s) <= most
    assert mixing.mix(df.limit(0), targets, "doc_id", "source", "lang", "topic", "n").count() == 0


# ---- edges -----------------------------------------------------------------------------


def test_edge_texts_crash_nothing(spark):
    df = spark.createDataFrame([(i, "s", "h", t) for i, t in enumerate(EDGES + EDGES[:3])], "rec_id bigint, source string, host string, text string")
    assert repetition.repeated_share(df, ["source", "rec_id"], "text").count() == df.count()
    assert tokens.token_counts(df, ["rec_id"], "text").count() == df.count()
    spam.stuffed_pages(df, "rec_id", "text").collect()
    scans.damage(df, "rec_id", "text").collect()
    standing.standing_lines(df, "rec_id", "host", "text").collect()
    quality.record_statistics(quality.line_statistics(df).withColumn("gone", F.lit(None).cast("array<int>"))).collect()
    leaks.leaks(df, ["rec_id"], "text", {1: "the " * 30, 2: "x"}).collect()


@pytest.mark.parametrize("name", ["p1_found", "p2_found", "p3_found", "p3_matches", "p3_item_matches", "p3_cleaned", "p4_found", "p5_found", "p5_report", "p6_found", "p7_found", "p8_ids", "p9_shares", "p9_marginals", "p10_found"])
def test_queries_run(spark, tiny, name):
    from corpusmill.llm.queries import QUERIES

    out = QUERIES[name](spark, tiny)
    rows = out.collect()
    assert len(rows) == len(set(map(str, rows)))
