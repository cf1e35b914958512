"""Steps on literal texts with known results."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import aggregate, content, dedup, enrich, metadata, modify, ngram_dedup, relational, repetition, sampling, split, tokenize
from textloom.plans import pipeline, presets
from textloom.registry import STEPS, load
from textloom.sources import files


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "text string").select(f(F.col("text"))).first()[0]


def kept(spark, text, f):
    return bool(one(spark, text, f))


@pytest.mark.parametrize(
    "text, by_line, by_char",
    [("Quick, brown!\nQuick, brown!\n\nFoxes", 2 / 3, 26 / 31)],
)
def test_line_repetition(spark, text, by_line, by_char):
    assert one(spark, text, lambda t: repetition.segment_fraction(t, "line", False)) == pytest.approx(by_line)
    assert one(spark, text, lambda t: repetition.segment_fraction(t, "line", True)) == pytest.approx(by_char)


def test_paragraph_repetition(spark):
    text = "\n\n".join(["Quick, brown!"] * 3) + "\nFoxes"
    assert one(spark, text, lambda t: repetition.segment_fraction(t, "paragraph", False)) == pytest.approx(2 / 3)
    assert one(spark, text, lambda t: repetition.segment_fraction(t, "paragraph", True)) == pytest.approx(26 / 45)


def test_ngram_repetition():
    words = "seven eight seven three eight seven eight seven".split()
    assert repetition.ngram_fractions(words)[0] == pytest.approx(30 / 40)
    assert repetition.ngram_fractions(["x", "y"] * 3 + ["xy", "zw"] * 3 + ["xyz", "uvw"] * 2)[0] == pytest.approx(12 / 30)
    assert repetition.ngram_fractions("seven eight seven eight seven three eight seven eight seven eight seven eight".split())[3] == pytest.approx(60 / 65)
    assert repetition.ngram_fractions([]) == [0.0] * 9


def test_greedy_duplicates():
    assert repetition.greedy_duplicates("a b a b a b".split(), 2) == 4


def test_filters(spark):
    assert kept(spark, "The best of the best", content.stop_word_filter)
    assert not kept(spark, "The best of the best", lambda t: content.stop_word_filter(t, True, 3))
    assert not kept(spark, "The cat in the hat", lambda t: content.word_length_filter(t, 3))
    assert kept(spark, "#hashtags #on #every #word", lambda t: content.symbol_ratio_filter(t, 1.0))
    assert not kept(spark, "#hashtags #on #every #word", content.symbol_ratio_filter)
    assert not kept(spark, " ", content.symbol_ratio_filter)
    text = "One of these eleven or so words is <2,000 and >7."
    assert kept(spark, text, content.alphabetic_word_ratio_filter) and not kept(spark, text, lambda t: content.alphabetic_word_ratio_filter(t, 0.1))
    bullets = "● a\n* b\nc"
    assert kept(spark, bullets, lambda t: content.bullet_count_filter(t, 0.67)) and not kept(spark, bullets, lambda t: content.bullet_count_filter(t, 0.66))


def test_word_removal(spark):
    df = spark.createDataFrame([(100, 95), (100, 94), (0, 0)], "a int, b int")
    assert [r[0] for r in df.select(content.word_removal_ratio_filter(F.lit(""), "a", "b")).collect()] == [True, False, False]


def test_modifiers(spark):
    lines = "Two words\n\nk j i h g f e d c b a\n  this one has ten words and that is its end\nNo"
    assert one(spark, lines, lambda t: modify.line_length_modifier(t, 2, 10)) == "Two words\n\n  this one has ten words and that is its end"
    assert one(spark, "Hello\n\n\n\n\nWorld", modify.newline_removal_modifier) == "Hello\n\nWorld"
    assert one(spark, "Main content\n\\appendix\nmore", modify.arxiv_appendix_modifier) == "Main content\n"
    assert one(spark, "Content before % Comment\nx", modify.arxiv_comment_modifier) == "Content before\nx"
    macro = "\\newcommand{\\mac}{Long Name}\nThe \\mac stands."
    assert one(spark, macro, modify.arxiv_macro_modifier) == "\\newcommand{Long Name}{Long Name}\nThe Long Name stands."
    assert one(spark, "pre \\section*{A} b", modify.arxiv_section_strip_modifier) == "\\section*{A} b"
    assert one(spark, "a\nA \n\n\nb", modify.within_page_dedup) == "a\n\n\nb"
    assert one(spark, "3.2k likes\nreal line", modify.counter_line_modifier) == "real line"
    assert one(spark, "ok.\nnot\nyes…", modify.punctuation_line_modifier) == "ok.\nyes…"
    assert one(spark, "mail a.b@c.org or 555-123-4567 now", modify.email_and_phone_removal_modifier) == "mail  or  now"
    assert one(spark, "see http://x.com/a and 1.2.3.4 end", modify.url_removal_modifier) == "see and end"


def test_question_format(spark):
    df = spark.createDataFrame([(("Why?",), [("Since", 2), ("Maybe", 1), ("So", 5)])], "question struct<text:string>, answers array<struct<text:string,score:int>>")
    out = modify.stackexchange_qa_formatter(modify.stackexchange_answer_sort_modifier(df), remove_qa=True)
    assert out.first()["text"] == "Q: Why?\nA: So\nA: Since\nA: Maybe"


def test_repo_split(spark):
    df = spark.createDataFrame([("r", [(f"f{i}", "x") for i in range(30)], "t")], "repo_name string, files array<struct<filename:string,text:string>>, text string")
    assert [len(r["files"]) for r in split.starcoder_v2_repo_splitter(df, max_files=10).collect()] == [10, 10, 10]


def test_percentiles(spark):
    r = aggregate.percentiles(spark.createDataFrame([(i,) for i in range(1, 6)], "v int"), "v").first()
    assert (r["min"], r["max"], r["median"], r["p25"], r["p75"], r["p90"]) == (1, 5, 3, 2, 4, 5)


def test_normalizers(spark):
    assert one(spark, "https://jobs.x.ca/job/?feedId=4&utm_source=Indeed", T.normalize_url) == one(spark, "https://jobs.x.ca/job/", T.normalize_url)
    assert one(spark, "０２３ ; hèllo", T.normalize_loose) == "000 ; hello"


def test_annotate_agrees_with_drop(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    dropped = pipeline.run(df, presets.PAGE_RULES)[0]
    marked = pipeline.run(df, presets.PAGE_RULES, annotate=True)[0]
    assert marked.count() == df.count()
    assert marked.filter("filter_reason IS NULL").count() == dropped.count()


def test_step_statistics(spark):
    df = spark.createDataFrame([(1, "a b c."), (2, "")], "doc_id long, text string")
    out, seen = pipeline.run(df, [{"func": "page_length_filter", "length_type": "word"}], stats=True)
    out.write.format("noop").mode("overwrite").save()
    assert pipeline.counts(seen) == [{"name": "page_length_filter", "pages_in": 2, "pages_out": 1, "removed": 1}]


def test_yaml(spark):
    steps = pipeline.parse("- source: cc\n  steps:\n    - func: line_length_modifier\n      min_length: 2\n    - commit\n")["cc"]
    df = spark.createDataFrame([("a b\nc",)], "text string")
    assert pipeline.run(df, steps)[0].first()[0] == "a b"


def test_every_preset_has_known_steps():
    for steps in presets.PRESETS.values():
        for s in steps:
            assert load(s["func"] if isinstance(s, dict) else s)
    assert len(STEPS) > 55
    with pytest.raises(KeyError):
        load("nothing_like_it")


def test_unit_dedup(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["B", "c"]), (3, ["a"])], "doc_id long, text array<string>")
    out = dedup.exact_dedup(df, normalize="normalize_whitespace_and_lowercase")
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: ["a", "b"], 2: ["c"]}


def test_selection_key(spark):
    df = spark.createDataFrame([(1, "x", 5), (2, "x", 9), (3, "y", 1)], "doc_id long, text string, score int")
    assert {r[0] for r in dedup.exact_dedup(df, selection_key="score", selection_reverse=True).select("doc_id").collect()} == {2, 3}


WORDS = [f"w{i}" for i in range(40)]


@pytest.mark.parametrize("same, gone", [(33, True), (30, False)])
def test_document_ngrams(spark, same, gone):
    """28 grams of 13 words; the second text shares same - 12 of them."""
    a, b = " ".join(WORDS), " ".join(WORDS[:same] + [f"z{i}" for i in range(same, 37)])
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    shared, total = same - 12, max(same, 37) - 12
    assert (shared / total > 0.8) == gone
    assert ngram_dedup.ngram_dedup(df, mode="document").count() == (1 if gone else 2)


def test_dedup_ignores_own_repeats_and_short_units(spark):
    df = spark.createDataFrame([(1, "a b c d e f " * 5), (2, "a b")], "doc_id long, text string")
    assert ngram_dedup.ngram_dedup(df, mode="document").count() == 2


def test_fixpoint_lets_units_of_removed_texts_stay(spark):
    x, y = " ".join(WORDS[:20]), " ".join(WORDS[20:])
    df = spark.createDataFrame([(1, x), (2, x), (3, x), (4, y)], "doc_id long, text string")
    assert {r[0] for r in ngram_dedup.ngram_dedup(df, mode="document", rounds=5).select("doc_id").collect()} == {1, 4}


@pytest.mark.parametrize("mode", ["document", "paragraph", "old-both"])
def test_chains_of_versions_go_as_in_sequence(spark, mode):
    """Each version shares over 80 % with the one before; only n-grams of kept units count as seen."""
    rows = [(i, "\n".join(" ".join(f"{p}{j}" for j in range(8 * i, 8 * i + 90)) for p in "pq"[: 1 if mode == "document" else 2])) for i in range(9)]
    seen, want = set(), {}
    for i, text in rows:
        left, shared, total = [], 0, 0
        for unit in text.split("\n"):
            ws = unit.split()
            grams = [tuple(ws[k : k + 13]) for k in range(len(ws) - 12)]
            hits = sum(g in seen for g in grams)
            shared, total = shared + hits, total + len(grams)
            if hits / len(grams) <= 0.8:
                left.append(unit)
                seen.update(grams)
        if left and (mode != "old-both" or shared / total <= 0.8):
            want[i] = text if mode == "document" else "\n".join(left)
    got = {r["doc_id"]: r["text"] for r in ngram_dedup.ngram_dedup(spark.createDataFrame(rows, "doc_id long, text string"), mode=mode).collect()}
    assert got == want and 1 < len(got) < 9


@pytest.mark.parametrize("table", [0, 1 << 26])
@pytest.mark.parametrize("mode", ["document", "paragraph", "old-both", "both"])
def test_ngrams_in_many_chunks_and_parts(spark, monkeypatch, mode, table):
    """Against the rule in sequence, with texts that meet in other chunks, parts and joins."""
    for name, value in (("CHUNK", 300), ("PART_CHARS", 4000), ("TABLE_GRAMS", table), ("SENT_UNITS", 0 if table else 1_000_000)):
        monkeypatch.setattr(ngram_dedup, name, value)
    draw = random.Random(7)
    pool = [[draw.choice("abcdefgh") + str(draw.randint(0, 60)) for _ in range(40)] for _ in range(12)]
    lines = lambda: [" ".join([w if draw.random() > 0.015 else "z" + str(draw.randint(0, 3)) for w in draw.choice(pool)] + ["y"] * draw.randint(0, 9)) for _ in range(draw.randint(1, 3))]
    rows = [(i * 7 - 100, "\n".join(lines())) for i in range(90)]

    def judged(units, limit):
        """Indices of the units (words) that go, and the hits of each."""
        seen, gone, hits = set(), [], []
        for i, ws in enumerate(units):
            grams = [tuple(ws[k : k + 13]) for k in range(len(ws) - 12)] or ([tuple(ws)] if len(ws) >= 5 else [])
            hits.append((sum(g in seen for g in grams), len(grams)))
            if grams and limit(hits[-1][0] / len(grams)):
                gone.append(i)
            else:
                seen.update(grams)
        return set(gone), hits

    over = (lambda x: x >= 0.8) if mode == "both" else (lambda x: x > 0.8)
    texts = judged([t.split() for _, t in rows], over)[0]
    units = [(i, u) for i, (_, t) in enumerate(rows) for u in t.split("\n")]
    gone, hits = judged([u.split() for _, u in units], over)
    share = lambda i: sum(h for (j, _), (h, _) in zip(units, hits) if j == i) / sum(n for (j, _), (_, n) in zip(units, hits) if j == i)
    bad = {i for i in range(len(rows)) if share(i) > 0.8} if mode == "old-both" else texts if mode == "both" else set()
    if mode == "document":
        want = {k: t for i, (k, t) in enumerate(rows) if i not in texts}
    else:
        # a first line that goes leaves the line feed of the second
        left = {i: "".join(("\n" if n else "") + u for n, (at, u) in enumerate((at, u) for at, (j, u) in enumerate(units) if j == i) if at not in gone) for i in range(len(rows))}
        want = {rows[i][0]: t for i, t in left.items() if t and i not in bad}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["text"] for r in ngram_dedup.ngram_dedup(df, mode=mode).collect()}
    assert got == want and 5 < len(got) < 90


@pytest.mark.parametrize("rounds", [1, None])
def test_ngrams_are_shuffled_in_few_bytes(spark, tmp_path, rounds):
    """Under 20 bytes for each n-gram, where rows of n-grams took over 40."""
    draw = random.Random(3)
    texts = [" ".join(f"{draw.getrandbits(24):x}" for _ in range(200)) for _ in range(1000)]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:50])], "doc_id long, text string").write.parquet(f"{tmp_path}/in")

    def written():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}

    before = written()
    assert ngram_dedup.ngram_dedup(spark.read.parquet(f"{tmp_path}/in"), mode="document", rounds=rounds).count() == 1000
    assert sum(n for k, n in written().items() if k not in before) < 20 * 188 * 1050


def test_substring_dedup_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(ngram_dedup, "CHUNK", 200)
    monkeypatch.setattr(ngram_dedup, "PART_CHARS", 2000)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join([*(f"{i}a{k}" for k in range(30 + i)), passage, *(f"{i}b{k}" for k in range(20))])) for i in range(20)]
    rows += [(20, passage + " " + passage), (21, " ".join(passage.split()[:49]) + " end")]
    got = {r["doc_id"]: r["text"] for r in ngram_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got[0] == rows[0][1] and got[21] == rows[21][1]
    assert all(got[i] == rows[i][1].replace(passage, "") for i in range(1, 20)) and not got.get(20, "").strip()


AWKWARD = ["", " ", "\n", "a\x1cb \x0b\f c\r", "\u00a0x y\u2003", " \t\n x  y\n \nz \r\n", "A.B ÀB ǅ 12٣ _x -y 'z", "Items in cart\n \nkeep me", "x\n   \ny", "5., Likes\nok", "7 views", "(12k\u00a0views)"]


def test_text_helpers_are_as_their_patterns(spark):
    """White space, words and counts against the expressions that are interpreted for each element."""
    df = spark.createDataFrame([(t,) for t in [*AWKWARD, None]], "t string")
    t = F.col("t")
    old = F.filter(F.split(t, r"\s+"), lambda x: x != "")
    pairs = [(T.strip(t), F.regexp_replace(t, r"\A\s+|\s+\z", "")), (T.tokens(t), old), (T.words(t), F.filter(old, lambda w: w.rlike(r"\A[\p{L}\p{N}]"))), (T.lines(t), F.split(t, "\\n"))]
    for new, want in pairs:
        assert df.filter(~new.eqNullSafe(want)).count() == 0


def test_rules_leave_texts_without_their_pattern(spark):
    """As line by line: a blank line goes where substrings are cut, counters and addresses go, others stay."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(AWKWARD)], "i int, t string")
    t = F.col("t")
    cart = modify.substring_line_modifier(t, "items in cart", max_length=10, remove_substring_only=True)
    got = {r[0]: tuple(r)[1:] for r in df.select("i", cart, modify.counter_line_modifier(t), modify.word_length_modifier(t, 3)).collect()}
    assert [got[i][0] for i in (7, 8, 5)] == ["keep me", "x\ny", "x  y\nz"]
    assert [got[i][1] for i in (8, 9, 10, 11)] == ["x\n   \ny", "ok", "", "(12k\u00a0views)"]
    assert got[7][2] == " " and got[9][2] == "ok"
    mail = spark.createDataFrame([("write to a.b@c.org or 555-123-4567 now",), ("no [such] 123 thing",), ("see http://1.2.3.4/x and www.example.com/y",)], "t string")
    assert [r[0] for r in mail.select(modify.email_and_phone_removal_modifier(modify.url_removal_modifier(t))).collect()] == ["write to or  now", "no [such] 123 thing", "see and"]


def test_batches_of_words_are_read_a_few_at_a_time():
    """All words of a batch as Python strings took hundreds of MB."""
    import tracemalloc

    import pyarrow as pa

    arr = pa.array([[f"word{i}_{k}" for k in range(200)] for i in range(2000)])
    tracemalloc.start()
    assert sum(len(x) for x in repetition.values(arr)) == 400_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4_000_000 and list(repetition.values(arr)) == arr.to_pylist()


def test_columns_that_clash_and_wide_ids(spark):
    """Columns named like the operator's own, ids near the largest, texts of very many lines."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(2**62 + i, f"{text}\n{'x ' * 3}" if i < 3 else "short", 1, 2, 3, 4) for i in range(5)] + [(-7, text, 1, 2, 3, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id int, at int, gone int, gone_id int")
    for mode, kept in (("document", {-7, 2**62 + 3, 2**62 + 4}), ("paragraph", {r[0] for r in rows}), ("both", {-7, 2**62 + 3, 2**62 + 4})):
        got = ngram_dedup.ngram_dedup(df, mode=mode)
        assert got.columns == df.columns and {r["doc_id"] for r in got.collect()} == kept
    lines = "\n".join(" ".join(f"q{i}_{k}" for k in range(6)) for i in range(3000))
    many = spark.createDataFrame([(0, lines), (1, lines)], "doc_id long, text string")
    assert [(r["doc_id"], len(r["text"])) for r in ngram_dedup.ngram_dedup(many).collect()] == [(0, len(lines))]


def test_both_counts_ngrams_across_paragraphs(spark):
    """Lines too short for n-grams of their own: the whole text goes in mode both, and stays in old-both."""
    text = "\n".join(f"a{i} b{i}" for i in range(20))
    df = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    assert {r["doc_id"] for r in ngram_dedup.ngram_dedup(df, mode="both").collect()} == {1}
    assert {r["doc_id"] for r in ngram_dedup.ngram_dedup(df, mode="old-both").collect()} == {1, 2}


def test_shards_meet_only_themselves(spark):
    text = " ".join(WORDS[:30])
    df = spark.createDataFrame([(i, text) for i in range(12)], "doc_id long, text string")
    kept = ngram_dedup.ngram_dedup(df, mode="document", shards=3)
    assert kept.count() == kept.select(F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("k")).distinct().count() == df.select(F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("k")).distinct().count()


def reasons(spark, texts, make):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r[1] for r in df.select("i", make(F.col("text")).alias("x")).orderBy("i").collect()]


def test_page_rules_in_the_order_of_the_reference(spark):
    prose = "word " * 60
    texts = [
        "the " * 5 + prose,  # one stop word, five times
        "the " + prose,  # one stop word
        "# " * 30 + prose,  # no stop word comes before hashes
        "the of " + "# " * 30 + prose,
        "\n".join(["* the of some words in lines"] * 12),  # asterisks aren't bullets
        "\n".join(["  - the of some words in lines"] * 12),
        "\n".join(["- the of some words in lines"] * 12 + [""] * 3),  # blank lines count
        "the of " + "word ... " * 60,
        "\n".join(["the of item " * 5 + "..."] * 5 + ["the of item " * 10] * 5),
        "\n".join(["the of item " * 10 + "…  "] * 5 + ["the of item " * 10] * 2),
        "the of " + "12 " * 20 + "word " * 50,
        "the of " + "12 " * 10 + "word " * 50,
        "the of " + "!!! " * 9 + "word " * 47,  # punctuation alone doesn't count as words of the text
    ]
    want = [None, "gopher_enough_stop_words", "gopher_enough_stop_words", "gopher_too_many_hashes", None, "gopher_too_many_bullets", None, "gopher_too_many_ellipsis", "gopher_too_many_end_ellipsis", "gopher_too_many_end_ellipsis", "gopher_below_avg_threshold", None, "gopher_short_doc"]
    want[10] = "gopher_below_alpha_threshold"
    assert reasons(spark, texts, content.gopher_quality_reason) == want
    assert reasons(spark, texts[5:6], lambda t: content.gopher_quality_reason(t, all_bullets=True)) == ["bullet_lines_check"]
    assert reasons(spark, texts[10:11], lambda t: content.gopher_quality_reason(t, whitelist=["(", ")"])) == [None]


def test_line_rules_take_lines_as_they_stand(spark):
    texts = ["end. \nend. ", "end.\nmore", "fin。\nslut؟", 'say "x"\nno', " " * 40 + "a\n" + "b" * 31, "", "\n \n"]
    assert reasons(spark, texts, lambda t: content.line_punct_ratio_filter(t, 0.5)) == [False, True, True, False, False, False, False]
    assert reasons(spark, texts[:1], lambda t: content.line_punct_ratio_filter(t, 0.5, True)) == [True]
    assert reasons(spark, texts, content.short_line_ratio_filter)[4:] == [True, False, False]
    assert reasons(spark, ["abc\nabc ", "abc\nabc", "a" * 50 + "\nb\nb"], content.char_dup_ratio_filter) == [True, False, True]


def test_c4_judges_line_by_line(spark):
    texts = [
        "lorem ipsum\nthis line stays here",  # two words: skipped before its words are read
        "this is lorem ipsum text",
        "no javascript { here\nthis line stays here",  # skipped before its bracket counts
        "use cookies { of this\nthis line stays here",  # a bracket comes before policies
        "one two [3]\nthis line [12] stays here [edit]",  # citations count as words
        "a b\r\nthis line stays here\u2028and this one too",
        "x" * 1001 + " lorem ipsum { and more\nthis line stays here",
    ]
    judged = reasons(spark, texts, lambda t: F.concat_ws("|", content.c4_reason(content.c4_lines(t), -1), content.c4_text(content.c4_lines(t))))
    line = "this line stays here"
    assert judged == [line, "lorem_ipsum|", line, f"curly_bracket|{line}", "one two \nthis line  stays here", f"{line}\nand this one too", line]
    df = spark.createDataFrame([(1, "One here now. Two here now. Three here. Four here now. Five here now."), (2, "Only one sentence here.")], "i int, text string")
    assert [r["i"] for r in content.fineweb_c4_filter(df).collect()] == [1]
    assert [tuple(r) for r in content.fineweb_c4_filter(df, annotate=True).select("i", "filter_reason").orderBy("i").collect()] == [(1, None), (2, "too_few_sentences")]
    assert [r["i"] for r in content.fineweb_c4_filter(df, split_paragraph=False, min_num_sentences=4).collect()] == [1]


def test_web_repetition_divides_by_the_whole_text():
    name = "massive_web_repetition_filters:"
    assert repetition.gopher_repetition("") == name + "empty_text"
    assert repetition.gopher_repetition("\n".join(["same line"] * 4)) == name + "line"
    assert repetition.gopher_repetition("p\n\np\n\np") == name + "paragraph"
    assert repetition.gopher_repetition("one two") == name + "2_gram"  # its only pair is the text
    assert repetition.gopher_repetition(" " * 40 + "one two") is None  # shares are of the text as it stands


def test_substring(spark):
    long = " ".join(f"s{i}" for i in range(60))
    df = spark.createDataFrame([(1, long), (2, f"before it {long} and after"), (3, " ".join(f"s{i}" for i in range(40)))], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in ngram_dedup.substring_dedup(df).collect()}
    assert got[1] == long and got[2] == "before it  and after" and len(got[3].split()) == 40


def test_intervals():
    assert ngram_dedup.merge_intervals([(3, 5), (0, 2), (4, 8), (2, 3)]) == [(0, 8)]
    assert ngram_dedup.invert_intervals([(1, 2), (4, 6)], 8) == [(0, 1), (2, 4), (6, 8)]
    assert ngram_dedup.sandwich_intervals([(0, 10), (11, 20)], 0.9) == [(0, 20)]
    bits, k = ngram_dedup.bloom_size(1000, 0.01)
    assert k == 7 and ngram_dedup.bloom_fp_rate(bits, k, 1000) < 0.0101


def test_known_ngrams(spark):
    docs = spark.createDataFrame([(1, " ".join(WORDS)), (2, "short text")], "doc_id long, text string")
    tests = spark.createDataFrame([(" ".join(WORDS[5:25]),)], "text string")
    assert [tuple(r) for r in ngram_dedup.decontamination_overlap(docs, tests).collect()] == [(1, 8)]


def test_quotas():
    assert sampling.balanced_quotas({"a": 10, "b": 100, "c": 100}, 110) == {"a": 10.0, "b": 50.0, "c": 50.0}
    assert sampling.proportional_quotas({"a": 1, "b": 3}, 8) == {"a": 2.0, "b": 6.0}


def test_contexts_hold_every_token(spark):
    df = spark.createDataFrame([(i, "s", " ".join(f"w{j}" for j in range(i))) for i in range(30)], "doc_id long, source string, text string")
    ctx = tokenize.contexts(tokenize.with_tokens(df), seqlen=16)
    own = [x for r in ctx.orderBy("context").collect() for x in r["tokens"]]
    want = [x for r in tokenize.with_tokens(df).orderBy("doc_id").collect() for x in r["tokens"]]
    assert own[: len(want)] == want and set(own[len(want) :]) <= {tokenize.VOCABULARY + 2} and len(own) % 16 == 0
    chunks = tokenize.shuffle_chunks(ctx, chunk=4, cells=2)
    assert chunks.count() == ctx.count()
    assert max(r["num_sequences"] for r in tokenize.manifest(chunks).collect()) <= 4


def test_url_filters(spark):
    df = spark.createDataFrame([(1, "https://www.badword123-badword2.com"), (2, None), (3, "http://fine.org/x")], "id int, url string")
    keep = lambda **kw: {r[0] for r in df.filter(metadata.url_substring_filter(F.lit(""), **kw)).select("id").collect()}
    assert keep(banlist=["badword"]) == {2, 3}
    assert keep(banlist=["badword123", "badword2"], num_banned_substrs=3) == {1, 2, 3}
    assert keep(banlist=["fine.org"], exact_domain_match=True) == {1, 2}
    assert keep(banlist=["badword"], match_substrings=False) == {1, 2, 3}


def test_language(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("n_chars > 200")
    r = df.select((enrich.top_language(enrich.language_shares(F.col("text"))) == F.col("lang")).cast("int").alias("x")).agg(F.avg("x")).first()[0]
    assert r > 0.9


def test_classifier(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    _, held = enrich.train_fasttext_classifier(docs, labels, valid_share=0.3)
    assert held["P@1"] > 0.8


def test_predicates(spark):
    df = spark.createDataFrame([("m-7b", 7e9), ("m-1b", 1e9)], "name string, params double")
    assert [r[0] for r in relational.where(df, "params>=5B").collect()] == ["m-7b"]
    assert [r[0] for r in relational.where(df, "name=1b$").collect()] == ["m-1b"]
    assert relational.lead_columns(df, "par").columns == ["params", "name"]


def test_files(spark, tmp_path):
    import zstandard

    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string")
    files.write_jsonl(df, str(tmp_path / "j"))
    assert files.read_jsonl(spark, str(tmp_path / "j"), "id int, text string").drop("shard").count() == 2
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "x.jsonl.zstd").write_bytes(zstandard.compress(b'{"id": 5, "text": "q"}\n'))
    assert files.read_zstd_jsonl(spark, str(tmp_path / "z"), "id int, text string").first()["id"] == 5
    body = b"HTTP/1.1 200 OK\r\n\r\n<p>hi</p>"
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://a.org\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc").write_bytes(record * 2)
    assert [r["html"] for r in files.read_warc(spark, str(tmp_path / "w")).collect()] == ["<p>hi</p>"] * 2
    assert len(files.list_shard_files(spark, str(tmp_path / "w"), file_range=(0, -1))) == 1


def test_stream(spark, tmp_path):
    from textloom.streaming import stream

    spark.createDataFrame([("a b c",), ("a",)], "text string").write.json(str(tmp_path / "in"))
    s = stream.process(stream.read_stream(spark, str(tmp_path / "in"), "text string"), [{"func": "page_length_filter", "min_length": 2}])
    q = s.writeStream.format("memory").queryName("streamed").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT text FROM streamed").collect()[0][0] == "a b c"


def test_tokenizers(spark):
    from textloom.functions import tokenizers

    assert tokenizers.load_word_tokenizer("eng")("it's 1.4 points.") == ["it's", "1.4", "points", "."]
    assert list(tokenizers.chunk_text_on_bytes("aéb", 2)) == ["a", "é", "b"]
    with pytest.raises(ValueError):
        tokenizers.load_word_tokenizer("qq")
    assert one(spark, "a b", lambda t: tokenizers.words_of(t)) == ["a", "b"]


def test_fused_chain(spark):
    from textloom.operators import fused

    good = "\n".join(f"The line number {i} of this text is here and it {chr(97 + i)} has words that stay to the end." for i in range(12))
    df = spark.createDataFrame([(1, good), (2, "short text only"), (3, None), (4, "\n".join(["the same line is here and again that."] * 20))], "doc_id long, text string")
    got = {r["doc_id"]: r["reason"] for r in fused.fused_quality(df, drop=False).collect()}
    assert got == {1: got[1], 2: "quality_short", 3: "empty", 4: "repetition_line"}


def test_parts(spark):
    assert one(spark, "a\n \nb\nc", lambda t: T.split_into_parts(t, "paragraphs")) == ["a\n \n", "b\n", "c"]
    assert one(spark, "Héllo, 12 Things!", T.simplify_text) == "hello 00 things"


def test_user_mappers(spark):
    from textloom.registry import map_pages

    df = spark.createDataFrame([("a b", 1), (None, 2), ("c", 3)], "text string, n int")
    split_ = lambda page: [{**page, "text": w} for w in page["text"].split()]
    assert sorted(tuple(r) for r in map_pages(df, split_).collect()) == [("a", 1), ("b", 1), ("c", 3)]
    assert map_pages(df, lambda least: (lambda page: [page] if page["n"] >= least else []), factory=True, least=2).count() == 2


def test_aggregate_hook(spark):
    found = {}
    df = spark.createDataFrame([("a b",), ("a b c",), ("d e",)], "text string")
    pipeline.run(df, [{"func": "word_counter_enricher", "_aggregate": {"key": "word_count", "type": "percentiles"}}], aggregates=found)
    assert found["0_word_counter_enricher"].first()["max"] == 3


def test_storage_and_chunks(spark, tmp_path):
    import tarfile

    from textloom.plans import tasks
    from textloom.sources import storage

    df = spark.createDataFrame([(i, "s", f"w{i} x") for i in range(6)], "doc_id long, source string, text string")
    chunks = tokenize.shuffle_chunks(tokenize.contexts(tokenize.with_tokens(df, bos=9), seqlen=5), chunk=2, cells=1)
    made = storage.write_files(storage.tar_chunks(chunks), str(tmp_path / "tars")).collect()
    assert sum(len(tarfile.open(tmp_path / "tars" / r["name"]).getnames()) for r in made) == chunks.count()
    assert storage.exists(spark, str(tmp_path / "tars")) and len(storage.list_dir(spark, str(tmp_path / "tars"))) >= len(made)
    assert storage.size(spark, str(tmp_path / "tars")) >= sum(r["bytes"] for r in made)
    assert tasks.dataset_card("n", "http://x/y", tokenize.manifest(chunks), seqlen=5)["num_tokens"] == 5 * chunks.count()
    assert storage.delete(spark, str(tmp_path / "tars")) and not storage.exists(spark, str(tmp_path / "tars"))
    todo = tasks.tasks(spark, ["a/b/1", "a/b/2", "a/b/3", "a/c/1"], chunk=2)
    assert sorted(len(r["files"]) for r in todo.collect()) == [1, 1, 2]
    assert tasks.left_over(todo, todo.limit(1)).count() == 2


def test_vocabulary_file(spark):
    ids = one(spark, "hello there", lambda t: tokenize.file_tokens(t, "/opt/tokenizers/byte_bpe_50k.json"))
    assert len(ids) >= 2


def test_cached_words_are_read_until_they_are_dropped(spark):
    """The rules read the words of the text as it was when they were cached."""
    df = spark.createDataFrame([(1, "the of " + "word " * 60)], "doc_id long, text string")
    cached = pipeline.run(df, ["cache_split_words_modifier"])[0].withColumn("text", F.lit("too short"))
    assert pipeline.run(cached, ["fineweb_gopher_quality_filter"])[0].count() == 1
    assert pipeline.run(cached, ["uncache_split_words_modifier", "fineweb_gopher_quality_filter"])[0].count() == 0
    both = pipeline.run(df, ["cache_split_words_modifier", "massive_web_repetition_filters", "fineweb_quality_filter", "uncache_split_words_modifier"])[0]
    assert both.columns == ["doc_id", "text"]


def test_list_files(spark, tmp_path):
    path = tmp_path / "list.txt"
    path.write_text("# ours\ncasino\n\npoker\n")
    df = spark.createDataFrame([(1, "a casino here", "http://x.com/a"), (2, "clean", "http://poker.com/b"), (3, "clean", None)], "doc_id long, text string, url string")
    ids = lambda steps: [r["doc_id"] for r in pipeline.run(df, steps)[0].orderBy("doc_id").collect()]
    assert ids([{"func": "substring_filter", "banlist_file": str(path)}]) == [2, 3]
    assert ids([{"func": "url_substring_filter", "banlist_file": str(path)}]) == [1, 3]
    cut = pipeline.run(df, [{"func": "bad_words_modifier", "banned_file": str(path), "remove_word": True}])[0]
    assert cut.filter("doc_id = 1").first()["text"] == "a  here"
    assert presets.make(presets.Lists(bad_words=str(path)))["c4"][-1] == {"func": "substring_filter", "banlist_file": str(path), "exact_word": True}


def test_running_sums_by_ranges(spark):
    from textloom.functions import running

    rows = [(i % 3 if i % 7 else None, i, i % 5) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, i int, n int").repartition(7)
    got = {(r["k"], r["i"]): r["before"] for r in running.before(df, ["k"], ["i"], F.col("n"), "before").collect()}
    sums, want = {}, {}
    for k, i, n in rows:
        want[k, i] = sums.get(k, 0)
        sums[k] = sums.get(k, 0) + n
    assert got == want
    assert sum(r["before"] for r in running.before(df, [], ["i"], F.lit(1), "before").collect()) == sum(range(500))
