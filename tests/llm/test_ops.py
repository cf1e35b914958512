"""Operators against brute force, exact round trips and labels."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.llm import arrays, op1_pitman_yor, op2_quality, op3_decontaminate, op4_suffix, op5_html, op6_license, op7_token_counts, op8_simhash, op9_toxicity, op10_pack, tokenizer
from textloom.llm.licenses import TEMPLATES
from textloom.llm.scratch import Scratch

SF = "/root/testdata/sf0.001"
WORD = re.compile(arrays.WORD)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def words(text):
    return WORD.findall((text or "").lower())


def test_words_agree_with_the_pattern(texts):
    t = arrays.words(pa.array(list(texts.values())))
    data = bytes(t.data)
    for k, text in enumerate(texts.values()):
        own = [data[a:b].decode() for a, b in zip(t.starts[t.first[k] : t.first[k + 1]], t.ends[t.first[k] : t.first[k + 1]])]
        assert own == words(text)


# 1
def exact_tables(c, others, p, d, theta):
    """P(t) by listing every way to seat c customers."""
    weight = Counter()

    def seat(tables, w):
        n = sum(tables)
        if n == c:
            weight[len(tables)] += w
            return
        for i, s in enumerate(tables):
            seat([*tables[:i], s + 1, *tables[i + 1 :]], w * (s - d))
        seat([*tables, 1], w * (theta + d * (others + len(tables))) * p)

    seat([], 1.0)
    total = sum(weight.values())
    return [weight[t] / total for t in range(1, c + 1)]


@pytest.mark.parametrize("c, others, p", [(2, 3, 0.2), (4, 0, 0.6), (5, 10, 0.05)])
def test_table_draws(c, others, p):
    n = 40_000
    got = op1_pitman_yor.draw_tables(np.full(n, c), np.full(n, others), np.full(n, p), 0.75, 0.5, np.random.default_rng(1))
    share = np.bincount(got, minlength=c + 1)[1:] / n
    assert np.abs(share - exact_tables(c, others, p, 0.75, 0.5)).max() < 0.015


def test_many_customers_go_on_from_the_exact_draw():
    n = 4000
    rng = np.random.default_rng(2)
    got = op1_pitman_yor.draw_tables(np.full(n, 400), np.full(n, 50), np.full(n, 0.05), 0.5, 1.0, rng).mean()
    one = []
    for _ in range(1500):
        t = op1_pitman_yor.draw_tables(np.full(1, 40), np.full(1, 50), np.full(1, 0.05), 0.5, 1.0, rng)[0]
        for i in range(40, 400):
            new = (1 + 0.5 * (50 + t)) * 0.05
            t += rng.random() < new / (new + i - 0.5 * t)
        one.append(t)
    assert got == pytest.approx(np.mean(one), rel=0.05)


def test_predictive_sums_to_one():
    """Over all words, those of the context and those only the parent knows."""
    text = pa.array(["a b a c a b a d", "b c b a", "d a b"])
    b = pa.record_batch([pa.array([1, 2, 3]), pa.array([1, 2, 3]), text], ["row_key", "doc_id", "text"])
    blobs = [x for out in op1_pitman_yor._segment(iter([b]), 1, (np.zeros(0, np.uint64), np.zeros(0, np.uint64))) for x in out["blob"].to_pylist()]
    r = op1_pitman_yor.Restaurants(blobs)
    parent = np.full(len(r.dishes), 1 / len(r.dishes))
    p = r.predictive(parent, 0, 2, 1)
    rng_t = op1_pitman_yor.Restaurants(blobs)
    for room in range(len(r.rooms)):
        own = r.room == room
        # mass of the words that the context lacks is (theta + d T) / (theta + C) times their parent mass
        inside = p[own].sum()
        rest = 1 - parent[r.dish[own]].sum()
        low, high = (inside - 1) / 1, inside
        backoff = [(op1_pitman_yor.STRENGTH + op1_pitman_yor.DISCOUNT * t) / (op1_pitman_yor.STRENGTH + r.total[room]) for t in range(own.sum(), r.customers[own].sum() + 1)]
        assert any(abs(high + x * rest - 1) < 1e-9 for x in backoff), (low, high)
    assert len(rng_t.customers) == len(p)


def exchange(texts, shards, hot, parts, turns):
    """Yields the seatings of all shards after each exchange with the parent, and what they asked."""
    b = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["row_key", "doc_id", "text"])
    seg = pa.Table.from_batches(list(op1_pitman_yor._segment(iter([b]), shards, hot)))
    pick = lambda t, c, k: t.filter(pa.compute.equal(t[c], k))
    left = {s: pick(seg, "shard", s) for s in sorted(set(seg["shard"].to_pylist()))}
    asks = pa.Table.from_batches([x for s in left for x in op1_pitman_yor._begin(iter(left[s].to_batches()), parts, hot[0])])
    for turn in range(turns):
        answers = pa.concat_tables([op1_pitman_yor._parent(pick(asks, "part", k), parts, turn) for k in range(parts)])
        yield [op1_pitman_yor.Seating(left[s], pick(answers, "shard", s), hot[0]) for s in left], asks
        asks = pa.concat_tables([op1_pitman_yor._turn(left[s], pick(answers, "shard", s), parts, hot[0], turn) for s in left])


def test_parent_is_seated_on_sampled_tables(texts):
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    for turn, (seatings, asks) in enumerate(exchange(list(texts.values()), 3, none, 2, 6)):
        asked = sum(int(op1_pitman_yor._unpack(x, *op1_pitman_yor._ASK_TYPES)[1].sum()) for x in asks["ask"].to_pylist())
        tables, types = (sum(int(x) for x in y) for y in ((s.t.sum() for s in seatings), (len(s.t) for s in seatings)))
        assert asked == tables and (tables == types if turn == 0 else tables > 1.02 * types)
        words, p = np.concatenate([s.r.dishes for s in seatings]), np.concatenate([s.parent for s in seatings])
        order = np.argsort(words)
        same = words[order][1:] == words[order][:-1]
        assert (p[order][1:][same] == p[order][:-1][same]).all()  # one parent for all shards
        kept = [len(s.parents) for s in seatings]
        assert kept == [max(0, turn - 1 - op1_pitman_yor.BURN_IN)] * len(seatings)


def test_parts_of_a_split_context_share_its_tables(texts):
    """Every part knows the whole restaurant's tables, so the context's probabilities add up to one."""
    text = list(texts.values())
    context, n = np.unique(op1_pitman_yor.pairs(pa.array(text, pa.string()))[0], return_counts=True)
    top = np.sort(context[np.argsort(-n)[:5]])
    for turn, (seatings, _) in enumerate(exchange(text, 6, (top, np.full(5, 6, np.uint64)), 2, 4)):
        for c in top:
            own = [(s, np.flatnonzero(s.r.rooms == c)[0]) for s in seatings if c in s.r.rooms]
            real = sum(int(s.t[s.r.room == k].sum()) for s, k in own)
            customers = sum(int(s.r.customers[s.r.room == k].sum()) for s, k in own)
            assert len(own) > 1 and {int(s.r.tables(s.t)[k]) for s, k in own} == {real} and {int(s.r.total[k]) for s, k in own} == {customers}
            mass, parent = 0.0, 0.0
            for s, k in own:
                of = s.r.room == k
                mass += s.r.probability(s.t, s.r.tables(s.t), s.parent[s.r.dish].astype(float))[of].sum()
                parent += s.parent[s.r.dish[of]].astype(float).sum()
            rest = (op1_pitman_yor.STRENGTH + op1_pitman_yor.DISCOUNT * real) / (op1_pitman_yor.STRENGTH + customers) * (1 - parent)
            assert mass + rest == pytest.approx(1, abs=1e-9)


def test_scores_grow_surer_with_repeats_and_match_by_shards(spark, docs, monkeypatch):
    one = {r["doc_id"]: r for r in op1_pitman_yor.score(docs).collect()}
    monkeypatch.setattr(op1_pitman_yor, "SHARD_BYTES", 40_000)
    many = {r["doc_id"]: r for r in op1_pitman_yor.score(docs).collect()}
    assert set(one) == set(many) and all(one[k]["n_words"] == many[k]["n_words"] for k in one)
    ratio = np.array([many[k]["perplexity"] / one[k]["perplexity"] for k in one if one[k]["n_words"] > 20])
    assert 0.97 < np.median(ratio) < 1.03 and 0.8 < ratio.min() and ratio.max() < 1.25
    assert all(r["n_words"] == len(words(t)) for r, t in ((one[k], t) for k, t in {r["doc_id"]: r["text"] for r in docs.collect()}.items()))


# 2
def test_em_finds_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.8
    votes = np.stack([np.where(rng.random(20_000) < 0.2, 0, np.where(np.where(rng.random(20_000) < a, good, ~good), 2, 1)) for a in [0.95, 0.9, 0.97] + [0.85] * 9], 1)
    rows, counts = np.unique(votes, axis=0, return_counts=True)
    m = op2_quality.fit(rows, counts.astype(float))
    assert m.prior == pytest.approx(0.8, abs=0.03)
    assert m.on_bad[0] == pytest.approx(0.95, abs=0.04) and m.on_good[1] == pytest.approx(0.9, abs=0.04)


def test_posterior_is_bayes(docs):
    m = op2_quality.train(docs)
    for r in op2_quality.quality(docs).collect():
        odds = math.log(m.prior / (1 - m.prior)) + sum({"0": 0.0, "1": math.log((1 - g) / b), "2": math.log(g / (1 - b))}[v] for v, b, g in zip(r["votes"], m.on_bad, m.on_good))
        assert r["posterior"] == pytest.approx(1 / (1 + math.exp(-odds)), abs=2e-6)
        assert r["keep"] == (r["posterior"] >= 0.5)


def test_quality_against_labels(spark):
    d = "/root/testdata/sf0.1"
    got = op2_quality.quality(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    n = {(r["keep"], r["quality"]): r["count"] for r in got.groupBy("keep", "quality").count().collect()}
    right = n.get((True, 1), 0) + n.get((False, 0), 0)
    assert right / sum(n.values()) > 0.9


def plain_votes(text):
    """The twelve rules on one text, without arrays."""
    text = text or ""
    raw, w = text.encode(), words(text)
    n, lines = len(w), [x for x in raw.split(b"\n") if x]
    letters = [c for c in text if c.isascii() and c.isalpha()]
    wide = sum(x >= 0xC3 for x in raw)
    upper = sum(c.isupper() for c in letters) + sum(raw[i - 1] == 0xC3 and raw[i] < 0x9F for i in range(1, len(raw)))
    symbols = sum(chr(x) in "#$%&*|@^~<>{}\\=+_[]`" for x in raw)
    share = lambda k, of: k / max(of, 1)
    distinct = share(sum(len(set(w[i : i + op2_quality.STRETCH])) for i in range(0, n, op2_quality.STRETCH)), n)
    stop, again = share(sum(x in op2_quality.STOP for x in w), n), share(sum(a == b for a, b in zip(w, w[1:])), n)
    mean, points = share(sum(len(x.encode()) for x in w), n), share(sum(text.count(c) for c in ".!?"), n)
    closed = share(sum(x[-1:] in b".!?\":" for x in lines), len(lines))
    copies = share(len(lines) - len(set(lines)), len(lines))
    rules = [
        (True, n >= 3, n < 3),
        (n >= 8, stop >= 0.12, n >= 25 and stop < 0.04),
        (n > 0, True, share(symbols, n) >= 0.3),
        (n > 0, True, share(symbols, len(raw)) >= 0.04),
        (n >= 8, True, again >= 0.2),
        (len(letters) + wide >= 20, True, share(upper, len(letters) + wide) >= 0.5),
        (n >= 8, True, share(text.count("!"), n) >= 0.3),
        (n >= 30, distinct >= 0.35, distinct < 0.2),
        (n >= 40, True, points < 0.004 or points > 0.8),
        (n >= 8, True, mean < 2 or mean > 12),
        (n >= 8, closed >= 0.6, len(lines) >= 3 and closed < 0.1),
        (len(lines) >= 4, True, copies >= 0.4),
    ]
    return "".join("0" if not asked else "1" if bad else "2" if good else "0" for asked, good, bad in rules)


def test_votes_and_posteriors_against_brute_force(docs, texts):
    """Votes are recomputed text by text, the model by expectation-maximisation over single documents."""
    want = {d: plain_votes(t) for d, t in texts.items()}
    got = {r["doc_id"]: r for r in op2_quality.quality(docs).collect()}
    assert {d: r["votes"] for d, r in got.items()} == want
    every = list(want.values())
    p = [0.1 if "1" in v else 0.95 for v in every]
    for _ in range(500):
        good = [(sum(q for v, q in zip(every, p) if v[j] == "2") + 9.9) / (sum(q for v, q in zip(every, p) if v[j] != "0") + 10) for j in range(12)]
        bad = [(sum(1 - q for v, q in zip(every, p) if v[j] == "1") + 1) / (sum(1 - q for v, q in zip(every, p) if v[j] != "0") + 2) for j in range(12)]
        prior = min(0.99, max(0.01, sum(p) / len(p)))
        odds = [math.log(prior / (1 - prior)) + sum(0 if x == "0" else math.log((1 - g) / b) if x == "1" else math.log(g / (1 - b)) for x, g, b in zip(v, good, bad)) for v in every]
        new = [1 / (1 + math.exp(-x)) for x in odds]
        moved, p = max(abs(x - y) for x, y in zip(new, p)), new
        if moved < 1e-10:
            break
    assert max(abs(q - got[d]["posterior"]) for d, q in zip(want, p)) < 2e-5


def test_long_texts_are_judged_for_variety():
    cycle, fresh = " ".join(f"the w{i % 40}" for i in range(4000)), " ".join(f"the w{i}" for i in range(4000))
    at = op2_quality.RULES.index("variety")
    assert op2_quality.votes(pa.array([cycle, fresh]))[:, at].tolist() == [op2_quality.BAD, op2_quality.GOOD]


# 3
def test_phrases_against_brute_force(spark, docs, texts):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = op3_decontaminate.matches(docs, items).collect()
    grams = defaultdict(set)
    for r in items.collect():
        w = words(r["text"])
        for i in range(max(0, len(w) - 12)):
            grams[tuple(w[i : i + 13])].add(r["item_id"])
    want = {(d, x, i) for d, t in texts.items() for w in [words(t)] for i in range(len(w) - 12) for x in grams.get(tuple(w[i : i + 13]), ())}
    phrase = [r for r in got if r["kind"] == "phrase"]
    assert {(d, x) for d, x, _ in want} == {(r["doc_id"], r["item_id"]) for r in phrase}
    first = {k: min(i for d, x, i in want if (d, x) == k) for k in {(d, x) for d, x, _ in want}}
    assert all(first[r["doc_id"], r["item_id"]] == r["first_word"] for r in phrase)


def test_proximity_by_brute_force(spark):
    rng = random.Random(1)
    vocabulary = [f"v{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    tests = [(i, " ".join(rng.sample(vocabulary, 8))) for i in range(12)]
    got = op3_decontaminate.matches(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(tests, "item_id long, text string")).collect()
    want = set()
    for d, t in rows:
        w = words(t)
        for x, item in tests:
            terms = set(words(item))
            width = math.ceil(1.5 * len(words(item)))
            if any(len(terms & set(w[i : i + width])) >= math.ceil(0.8 * len(terms)) for i in range(len(w))):
                want.add((d, x))
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and want


def test_short_items_match_as_phrases(spark):
    rows, tests = [(1, "the answer is forty two indeed"), (2, "two forty is the answer")], [(1, "forty two"), (2, "answer"), (3, "no such")]
    got = op3_decontaminate.matches(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(tests, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"], r["kind"]) for r in got) == [(1, 1, "phrase"), (1, 2, "phrase"), (2, 2, "phrase")]


# 4
@pytest.mark.parametrize("least", [50, 20])
def test_repeats_against_brute_force(docs, texts, least):
    seen = defaultdict(list)
    for d in sorted(texts):
        w = words(texts[d])
        for i in range(len(w) - least + 1):
            seen[tuple(w[i : i + least])].append((d, i))
    cut, kept = set(), set()
    for places in seen.values():
        if len(places) > 1:
            for k, (d, i) in enumerate(sorted(places)):
                (cut if k else kept).update((d, j) for j in range(i, i + least))
    got = op4_suffix.repeats(docs, least=least).collect()
    mine = {c: {(r["doc_id"], j) for r in got if r["cut"] == c for j in range(r["start_word"], r["end_word"])} for c in (True, False)}
    assert mine[True] == cut and mine[False] == kept and cut


def test_ranges_are_chained(spark, tmp_path):
    """Ranks of sorted ranges that cut keys anywhere are those of the whole."""
    rng = random.Random(12)
    for _ in range(200):
        rows = sorted((rng.choice([1, 1, 1, 2, 3, 4, 5, 9]), rng.randrange(50), i) for i in range(rng.randint(1, 30)))
        cuts = sorted(rng.randint(0, len(rows)) for _ in range(rng.randint(0, 5)))
        want, count = {}, Counter(r[0] for r in rows)
        for r in rows:
            if count[r[0]] > 1:
                want[r[1:]] = (sorted(count).index(r[0]), r != min(x for x in rows if x[0] == r[0]))
        got, edges, parts = {}, [], []
        for part, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
            own = rows[lo:hi]
            step = rng.randint(1, 4)
            batches = [pa.record_batch([pa.array([r[k] for r in own[i : i + step]], pa.int32() if k == 2 else pa.int64()) for k in range(3)], ["key", "cid", "pos"]) for i in range(0, len(own), step)]
            for b in op4_suffix._ranked(iter(batches), part):
                for r in b.to_pylist():
                    edges.append((part, r["edge"])) if r["edge"] else parts.append((part, r))
        ends = {x[0]: x[1:] for x in op4_suffix._chained(edges)}
        for part, r in parts:
            start, keys, first_alone, last_alone, goes_on = ends[part]
            if not (r["local"] == 0 and first_alone) and not (r["local"] == keys - 1 and last_alone):
                got[r["cid"], r["pos"]] = (start + r["local"], r["later"] or (r["local"] == 0 and goes_on))
        assert got == want


def test_a_passage_of_many_copies_is_spread(spark):
    """Most documents carry one passage: no range of the sort holds all its copies, and all but the first are cut."""
    passage = " ".join(f"p{i}" for i in range(52))
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("own"), "id", F.lit(f" {passage} tail"), "id").alias("text"))
    got = op4_suffix.repeats(df).groupBy("cut", "start_word", "end_word").count().collect()
    assert {tuple(r) for r in got} == {(False, 1, 53, 1), (True, 1, 53, 2999)}


def test_cutting_leaves_first_copies(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    df = spark.createDataFrame([(1, f"one {passage} end.", 9), (2, f"two {passage} fin.", 9), (3, passage, 9), (4, "clean text", 10)], "doc_id long, text string, n_chars int")
    got = {r["doc_id"]: r for r in op4_suffix.cut_repeats(df).collect()}
    assert got[1]["text"] == f"one {passage} end." and got[2]["text"] == "two  fin." and 3 not in got
    assert got[2]["n_chars"] == 9 and got[4]["n_chars"] == 10


# 5
PAGE = """<html><head><title>No</title><script>var t="</p>";</script></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav>
<h1>Head line</h1><p>{good}</p><p>short one</p><p>{good}<br><br>{near}</p><!-- <p>no</p> --><div>ad</div><footer>&copy; 2020 all rights are reserved by the owner of this site and that is all there is to say</footer>"""


def test_html_rules():
    good = "The house of the man was in that town and it is for us to be with them on the way. " * 4
    near = "It was the best of days and it was the end of the road for us, that we know."
    text, n, kept = op5_html.extract(PAGE.format(good=good, near=near))
    assert text.split("\n\n") == ["Head line", good.strip(), "short one", good.strip(), near]
    assert "©" not in text and "Home" not in text and n == 8 and kept == 5
    assert op5_html.extract(None) == ("", 0, 0) == op5_html.extract("")


def test_silent_elements_that_never_end():
    page = "<p>one</p><svg/><p>two</p><object><p>three</p><noscript><p>no</p></noscript><p>four<script>x<p>no</p>"
    assert [b.text for b in op5_html.blocks(page)] == ["one", "two", "three", "four"]
    assert op5_html.extract("<svg>" * 100_000 + "<svg " * 100_000)[2] == 0


def plain_kinds(found):
    """Both passes by looking up and down from every block."""
    first = []
    for b in found:
        w = re.findall(r"[^\W\d_]+", b.text.lower())
        stops = sum(x in op5_html._STOP for x in w) / max(1, len(w))
        if b.link_chars > 0.2 * len(b.text) or "©" in b.text:
            first.append("bad")
        elif len(b.text) < 70:
            first.append("bad" if b.link_chars else "short")
        else:
            first.append("bad" if stops < 0.1 else "near" if stops < 0.14 or len(b.text) <= 200 else "good")
    own = list(first)
    for i, b in enumerate(found):
        if first[i] == "short" and b.heading:
            far = 0
            for j in range(i + 1, len(found)):
                if first[j] in ("good", "near"):
                    own[i] = "good" if far <= 200 else own[i]
                    break
                far += len(found[j].text)
    out = []
    for i, k in enumerate(own):
        sides = []
        for side in (own[:i][::-1], own[i + 1 :]):
            at = next((j for j, x in enumerate(side) if x in ("good", "bad")), None)
            sides.append((side[at] if at is not None else "bad", "near" in (side[:at] if at is not None else side)))
        (p, p_near), (q, q_near) = sides
        if k in ("good", "bad"):
            out.append(k)
        elif p == q:
            out.append(p)
        else:
            out.append("good" if k == "near" or (p == "bad" and p_near) or (q == "bad" and q_near) else "bad")
    return out


def test_block_rules_against_brute_force(spark):
    rng = random.Random(4)
    filler = ["the of and house in that was town it", "xylophone quartz jumble vex", "word and other"]
    pages = []
    for _ in range(300):
        parts = []
        for _ in range(rng.randint(0, 12)):
            text = " ".join(rng.choice(filler) for _ in range(rng.choice([1, 1, 3, 6, 12])))
            tag = rng.choice(["p", "p", "h2", "div"])
            parts.append(f"<{tag}>{'<a href=x>' if rng.random() < 0.2 else ''}{text}</a></{tag}>")
        pages.append("".join(parts))
    pages += [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    kinds = Counter()
    for page in pages:
        found = op5_html.blocks(page)
        want = plain_kinds(found)
        op5_html.classify(found)
        assert [b.kind for b in found] == want
        kinds.update(want)
    assert min(kinds["good"], kinds["bad"]) > 100
    rows = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    for r in op5_html.main_text(rows).collect():
        found = op5_html.blocks(pages[r["page_id"]])
        assert r["text"] == "\n\n".join(b.text for b, k in zip(found, plain_kinds(found)) if k == "good")


def test_html_time_is_linear():
    assert op5_html.extract("<a" * 200_000)[1] == 1
    assert op5_html.extract("<p>" * 200_000) == ("", 0, 0)


def test_html_keeps_articles(spark):
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        long = [re.sub(r"\s+", " ", re.sub("<[^>]+>", " ", p)).strip() for p in re.findall(r"<p>([^<]{400,})</p>", article)]
        text = op5_html.extract(r["html"])[0]
        import html

        plain = [p for p in map(html.unescape, long) if sum(w in op5_html._STOP for w in op5_html._WORD.findall(p.lower())) >= 0.16 * len(op5_html._WORD.findall(p.lower()))]
        assert all(p in text for p in plain) and "&middot;" not in text and "track(" not in text


# 6
def lcs(a, b):
    n = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            n[i][j] = n[i - 1][j - 1] + 1 if x == y else max(n[i - 1][j], n[i][j - 1])
    return n[-1][-1]


def test_alignment():
    rng = random.Random(5)
    for _ in range(200):
        a = [rng.randint(0, 8) for _ in range(rng.randint(0, 15))]
        b = [rng.randint(0, 8) for _ in range(rng.randint(0, 15))]
        got = op6_license.align(a, b)
        assert all(a[i] == b[j] for i, j in got) and all(p < q and r < s for (p, r), (q, s) in zip(got, got[1:]))
        assert len(got) <= lcs(a, b)
        assert len(op6_license.common(a, b)) == lcs(a, b)
        assert op6_license.align(a, a) == [(i, i) for i in range(len(a))]
        if a:
            assert [a[i] for i in op6_license.increasing(a)] == sorted(set(a[i] for i in op6_license.increasing(a)))


NOTICE = {t.license: t.text for t in reversed(TEMPLATES)}
WHOLE = {t.license: t.text for t in TEMPLATES}


def scan(texts):
    return list(op6_license.Scanner(TEMPLATES).scan(pa.array(texts, pa.string())))


def test_licenses_are_found(spark, texts):
    isc, mit = WHOLE["isc"], NOTICE["mit"]
    rows = [(1, f"some words. {isc} more words " + "the of and " * 500), (2, isc.replace("purpose", "aim").replace("hereby", "")), (3, "use copy modify " * 30), (4, f"{mit} and {mit}"), (5, "released under the old license mit")]
    got = sorted(tuple(r)[:3] for r in op6_license.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert [x[:2] for x in got] == [(1, "isc"), (2, "isc"), (4, "mit"), (4, "mit")] and got[0][2] == 1.0 and 0.8 <= got[1][2] < 1
    found = {(r["doc_id"], r["license"]) for r in op6_license.licenses(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    want = {(d, k) for d, t in texts.items() for k in ("mit", "apache-2.0", "gpl-3.0", "cc-by-nc-4.0") if NOTICE[k].lower() in t.lower()}
    assert found == want


def test_every_template_is_told_from_its_kin():
    for t in TEMPLATES:
        n = len(words(t.text))
        assert [x[1:] for x in scan([f"before. {t.text} after"])] == [(t.license, 1.0, 1, n)]
    near = ["Licensed under the MIT License", "Released under MIT license", "Licensed under CC BY 4.0", "Licensed under CC BY-NC 4.0", "Licensed under the GNU General Public License, version 2."]
    assert [(x[0], x[1]) for x in scan(near)] == [(0, "mit"), (1, "mit"), (2, "cc-by-4.0"), (3, "cc-by-nc-4.0")]


def test_coverage_counts_what_is_left():
    """Words that occur once in a template: taking k away leaves (n - k) / n, foreign words between change nothing."""
    rng = random.Random(6)
    for t in TEMPLATES:
        w = words(t.text)
        if len(w) < 30:
            continue
        single = [i for i, x in enumerate(w) if w.count(x) == 1 and x not in t.keys and 0 < i < len(w) - 1]
        gone = set(rng.sample(single, min(len(single), len(w) // 10)))
        left = [x for i, x in enumerate(w) if i not in gone]
        spread = [y for x in left for y in ([x, f"foreign{rng.random()}"] if rng.random() < 0.2 else [x])]
        for text in (left, spread):
            got = [x for x in scan([" ".join(text)]) if x[1] == t.license]
            assert [round(x[2], 9) for x in got] == [round(len(left) / len(w), 9)], t.license


def test_scans_against_trying_every_place():
    rng = random.Random(8)
    some = [op6_license.Template("x", "alpha beta gamma delta beta eta", ("gamma",)), op6_license.Template("y", "one two three four")]
    vocabulary = "alpha beta gamma delta eta one two three four other".split()
    for _ in range(400):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(0, 25))]
        for t in some:
            w, want, at = words(t.text), [], 0
            for i in range(len(text)):
                if i < at:
                    continue
                got = op6_license.align(w, text[i : i + math.ceil(1.5 * len(w))])
                if got and len(got) >= math.ceil(0.8 * len(w)) and got[0][1] == 0 and set(t.keys) <= {w[a] for a, _ in got}:
                    want.append((round(len(got) / len(w), 9), i, i + got[-1][1]))
                    at = i + got[-1][1] + 1
            mine = [(round(x[2], 9), *x[3:]) for x in op6_license.Scanner([t]).scan(pa.array([" ".join(text)]))]
            assert mine == want


# 7
def test_edits_keep_counts():
    rng = random.Random(3)
    pieces = ["a", "word", " ", "  ", "\n", "é", "12", ".", "'s", " the", "😀", "\t", " x "]
    for k in range(400):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 120)))
        tree = op7_token_counts.Tree(text, leaf=rng.choice([2, 4, 9, 30]))
        for _ in range(4):
            a = rng.randint(0, len(text))
            b = min(len(text), a + rng.choice([0, 0, 1, 3, 20]))
            new = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 5)))
            tree.edit(a, b, new)
            text = text[:a] + new + text[b:]
            assert tree.text() == text and tree.total == tokenizer.count(text) and tree.chars[1] == len(text)


def test_recounts_encode_little(docs, texts):
    for r in op7_token_counts.token_counts(docs).collect():
        text = texts[r["doc_id"]]
        edits = op7_token_counts.redactions(text)
        new = text
        for a, b, x in reversed(edits):
            new = new[:a] + x + new[b:]
        assert (r["n_tokens"], r["n_tokens_after"], r["n_edits"]) == (tokenizer.count(text), tokenizer.count(new), len(edits))
        assert r["n_encoded"] <= 4 * op7_token_counts.LEAF * len(edits) + 2048 * (r["n_edits"] > 0)


def test_stored_trees_take_edits_again_and_again():
    rng, text = random.Random(9), "some words and others. " * 200
    tree = op7_token_counts.Tree(text)
    for _ in range(30):
        a = rng.randrange(len(text))
        text = text[:a] + "new" + text[a + 20 :]
        tree.edit(a, a + 20, "new")
        kept = tree.text(), tree.lengths(), tree.counts()
        tree = op7_token_counts.Tree.stored(*kept)
        assert tree.encoded == 0 and tree.total == tokenizer.count(text) and (tree.text(), tree.lengths(), tree.counts()) == kept


@pytest.mark.parametrize("sent", [1 << 20, -1])
def test_edits_table(spark, monkeypatch, sent):
    """Edits in any order, overlapping, behind the end, null and of no document; sent to the scan or joined by a shuffle."""
    monkeypatch.setattr(op7_token_counts, "SENT_BYTES", sent)
    text = "The quick brown fox jumps over the lazy dog. " * 100
    docs = spark.createDataFrame([(1, text), (2, text), (3, None), (None, text)], "doc_id long, text string")
    edits = spark.createDataFrame([(1, 4, 9, "slow"), (1, 900, 1000, None), (1, 5, 7, "lost"), (1, 10**6, 10**6 + 5, " end"), (3, 0, 0, "born anew"), (9, 0, 1, "x"), (None, 0, 3, "x")], "doc_id long, start int, end int, new string")
    got = {r["doc_id"]: r for r in op7_token_counts.token_counts(docs, edits=edits).collect()}
    new = text[:4] + "slow" + text[9:900] + text[1000:] + " end"
    n = tokenizer.count(text)
    assert tuple(got[1])[1:4] == (n, 3, tokenizer.count(new)) and 0 < got[1]["n_encoded"] <= 6 * op7_token_counts.LEAF
    assert tuple(got[2])[1:] == (n, 0, n, 0) == tuple(got[None])[1:]
    assert tuple(got[3])[1:4] == (0, 1, tokenizer.count("born anew"))


# 8
def brute_groups(texts):
    ids = sorted(texts)
    sig, _, size = op8_simhash.signatures(pa.array([texts[i] for i in ids]))
    sets = []
    for i in ids:
        w = words(texts[i])
        sets.append({tuple(w[k : k + 3]) for k in range(len(w) - 2)} or ({tuple(w)} if w else set()))
    pairs = set()
    for i, j in itertools.combinations(range(len(ids)), 2):
        if texts[ids[i]] == texts[ids[j]]:
            pairs.add((ids[i], ids[j]))
        elif size[i] and size[j] and op8_simhash.hamming(sig[i], sig[j]) <= op8_simhash.DISTANCE:
            if len(sets[i] & sets[j]) >= op8_simhash.JACCARD * len(sets[i] | sets[j]):
                pairs.add((ids[i], ids[j]))
    return pairs


def test_near_copies_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    df = spark.read.parquet(f"{d}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    pairs = brute_groups(texts)
    top = {}
    for r in op8_simhash.duplicates(df).collect():
        top[r["doc_id"]] = r["kept_id"]
    joined = [top.get(a, a) == top.get(b, b) for a, b in pairs]
    assert sum(joined) >= 0.9 * len(pairs) and pairs
    linked = {x for p in pairs for x in p}
    assert set(top) | set(top.values()) <= linked  # nobody is taken for a copy who isn't one


def noisy(rng, heads, each, bits):
    sigs = np.repeat(rng.integers(0, 2**63, (heads, 2), dtype=np.uint64), each, axis=0)
    for k in range(len(sigs)):
        for bit in rng.choice(128, bits, replace=False):
            sigs[k, bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    return np.unique(sigs, axis=0)


def test_graph_recall():
    """Groups of six, and pairs beside one large group, which an average over all pairs would hide."""
    rng = np.random.default_rng(7)
    for sigs in (noisy(rng, 300, 6, 8), np.concatenate([noisy(rng, 1, 1500, 8), noisy(rng, 400, 2, 8)])):
        queries = sigs[::50] ^ np.array([1, 2], np.uint64)
        label, a, b, (audited, found, _) = op8_simhash.joined(sigs, queries, 32)
        assert audited > 100 and found >= 0.9
        both = np.concatenate([sigs, queries])
        assert (op8_simhash.hamming(both[a], both[b]) <= 32).all()  # every edge is a hit, and they make a forest
        assert (op8_simhash.roots(len(both), a, b) == label).all() and len(a) == len(both) - len(np.unique(label))
        _, every = op8_simhash.recall(both, len(sigs), label, 32, 10**6)
        assert every >= 0.9


def test_components_of_one_task_and_of_rounds(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(1000 + i, 1001 + i) for i in range(40)]
    df = spark.createDataFrame(edges, "a long, b long")
    scratch = Scratch(spark)
    one = {tuple(r) for r in op8_simhash.components(df, scratch, "one").collect()}
    many = {tuple(r) for r in op8_simhash.components(df, scratch, "many", most=0).collect()}
    scratch.drop()
    assert one == many and (1040, 1000) in one


def family(spark, n, changes):
    """n texts that share all but ``changes`` of 60 words, and as many strangers."""
    rng = random.Random(n)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(n):
        w = list(base)
        for k in rng.sample(range(60), changes):
            w[k] = f"x{rng.random()}"
        rows += [(i, " ".join(w)), (10**6 + i, " ".join(f"s{i}_{k}" for k in range(30)))]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_hot_min_hashes_are_split(spark):
    """One family many times a shard: no shard or task of pairs holds it, and it is one group all the same."""
    df = family(spark, 600, 2)
    top = {r["kept_id"] for r in op8_simhash.duplicates(df, shard_rows=40).collect()}
    assert top == {0} and op8_simhash.duplicates(df, shard_rows=40).count() == 599
    sizes = [r["rows"] for r in op8_simhash.audits(df, shard_rows=40).collect()]
    assert sum(sizes) < 30 * 1200 and max(sizes) < 40 * 5 + op8_simhash.PIVOTS * 2


def test_pairs_of_blocks_join_what_failed_edges_parted(spark, monkeypatch):
    """Hits that don't verify part a component; all pairs between its groups are tried, in blocks of any size."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {tuple(r) for r in op8_simhash.duplicates(docs, distance=44).collect()}
    monkeypatch.setattr(op8_simhash, "BLOCK_ROWS", 3)
    assert {tuple(r) for r in op8_simhash.duplicates(docs, distance=44).collect()} == want and want


def crowd(n, near, seed):
    """n strangers of 40 words that begin alike, and ``near`` copies of some that share one min-hash with them, which more strangers have."""
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(10)]
    texts = {i: " ".join([*common, *(f"w{rng.random()}" for _ in range(30))]) for i in range(n)}
    copies, of = [], np.repeat(np.arange(n), 6)
    for i in of.tolist():
        w = texts[i].split()
        for k in rng.sample(range(10, 40), 3):
            w[k] = f"x{rng.random()}"
        copies.append(" ".join(w))
    sig, mins, _ = op8_simhash.signatures(pa.array([*texts.values(), *copies]))
    same = mins[of] == mins[n:]
    often = (mins[:n, None] == mins[None, :n]).sum(1) > 50
    fits = (same.sum(1) == 1) & (same & often[of]).any(1) & (op8_simhash.hamming(sig[of], sig[n:]) <= op8_simhash.DISTANCE)
    picked = np.flatnonzero(fits)[:near].tolist()
    assert len(picked) == near
    return texts | {n + i: copies[i] for i in picked}


def met(texts, pairs):
    """Of pairs those with a min-hash in common."""
    ids = sorted(texts)
    mins = dict(zip(ids, op8_simhash.signatures(pa.array([texts[i] for i in ids]))[1]))
    return {(a, b) for a, b in pairs if (mins[a] == mins[b]).any()}


@pytest.mark.parametrize("block", [32_768, 30])
def test_hot_min_hashes_lose_no_pair(spark, monkeypatch, block):
    """Pairs among the strangers of hot min-hashes, beside a family that fills blocks of its own: all that share a min-hash are joined."""
    monkeypatch.setattr(op8_simhash, "REST_ROWS", block)
    texts = crowd(800, 15, 5)
    base = texts[0].split()
    texts |= {10_000 + i: " ".join([*base[:-1], f"y{i}"]) for i in range(60)}
    pairs = brute_groups(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    top = {r["doc_id"]: r["kept_id"] for r in op8_simhash.duplicates(df, shard_rows=8).collect()}
    lost = {(a, b) for a, b in met(texts, pairs) if top.get(a, a) != top.get(b, b)}
    assert not lost and len(met(texts, pairs)) > 1000
    assert set(top) | set(top.values()) <= {x for p in pairs for x in p}


# 9
def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(0)
    usual, bad = [f"w{i}" for i in range(200)], ["vile", "nasty", "rotten"]
    rows = []
    for i in range(1200):
        w = [rng.choice(usual) for _ in range(rng.randint(20, 200))]
        if i % 3 == 0:
            for _ in range(2):
                w[rng.randrange(len(w))] = rng.choice(bad)
        rows.append((i, " ".join(w), int(i % 3 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    marks = df.filter("doc_id < 800").select("doc_id", "toxic")
    got = op9_toxicity.toxicity(df.select("doc_id", "text"), marks).filter("doc_id >= 800").collect()
    right = sum(r["toxic"] == (r["doc_id"] % 3 == 0) for r in got)
    assert right >= 0.97 * len(got)


def test_toxicity_models_are_normalised():
    rng = random.Random(2)
    make = lambda extra: [" ".join(rng.choice([f"w{i}" for i in range(12)] + extra) for _ in range(rng.randint(1, 30))) for _ in range(80)]
    texts = {1: pa.array(make(["vile"] * 3)), 0: pa.array(make([]))}
    m = op9_toxicity.train(texts)
    of = {int(k): i for i, k in enumerate(m.words)}
    pair = {int(k): i for i, k in enumerate(m.pairs)}
    for c in range(2):
        uni = np.exp(m.unigram[c].astype(float))
        assert uni.sum() + math.exp(m.unseen[c]) == pytest.approx(1, abs=1e-5)
        for before in m.words:
            w = np.exp(m.backoff[c][of[int(before)]].astype(float))
            keys = op9_toxicity._key(np.full(len(m.words), before), m.words)
            p = [math.exp(m.bigram[c][pair[int(k)]]) if int(k) in pair else w * uni[i] for i, k in enumerate(keys)]
            assert sum(p) + w * math.exp(m.unseen[c]) == pytest.approx(1, abs=1e-4)


def test_toxicity_against_brute_force():
    """Both models from dictionaries of counts, word by word."""
    rng = random.Random(3)
    make = lambda extra, n: [" ".join(rng.choice([f"w{i}" for i in range(9)] + extra) for _ in range(rng.randint(1, 12))) for _ in range(n)]
    texts = {1: make(["vile", "vile"], 60), 0: make(["fine"], 90)}
    size = {c: len(t) for c, t in texts.items()}
    single, double = ({c: Counter(x for t in texts[c] for x in set(f(words(t)))) for c in texts} for f in (lambda w: w, lambda w: list(zip(["<s>", *w], w))))

    def told(counts):
        out = {0: {}, 1: {}}
        for x in counts[0] | counts[1]:
            n = {c: counts[c][x] for c in counts}
            rate = sum(n.values()) / sum(size.values())
            ratio = 2 * sum((n[c] * math.log(n[c] / size[c] / rate) if n[c] else 0) + ((size[c] - n[c]) * math.log((1 - n[c] / size[c]) / (1 - rate)) if n[c] < size[c] else 0) for c in n)
            for c in n:
                out[c][x] = n[c] * sum(size.values()) / size[c] if ratio >= op9_toxicity.SURE else sum(n.values())
        return out

    def discounts(counts):
        n = Counter(min(x, 4) for x in (counts[0] + counts[1]).values())
        n = {k: n[k] + 1 for k in (1, 2, 3, 4)}
        y = n[1] / (n[1] + 2 * n[2])
        return {x: min(max(min(k, 3) - (min(k, 3) + 1) * y * n[min(k, 3) + 1] / n[min(k, 3)], 0.3 * min(k, 3)), 0.95 * min(k, 3)) for x, k in (counts[0] + counts[1]).items()}

    one, two, less1, less2 = told(single), told(double), discounts(single), discounts(double)
    seen = Counter(b for _, b in double[0] | double[1])
    model = op9_toxicity.train({c: pa.array(t) for c, t in texts.items()})
    tests = make(["vile", "fine", "stranger"], 30)
    got = model.score(pa.array(tests))
    for c, mine in ((1, got[0]), (0, got[1])):
        total = sum(one[c].values())
        kept = {w: max(k - less1[w], 0) / total for w, k in one[c].items()}
        uni = lambda w: kept.get(w, 0) + (1 - sum(kept.values())) * (seen[w] if w in seen else 1) / (sum(seen.values()) + 1)  # noqa: B023, E731
        for text, value in zip(tests, mine):
            logs = []
            for a, b in zip(["<s>", *words(text)], words(text)):
                after = {x: k for (h, x), k in two[c].items() if h == a}
                all_ = sum(after.values())
                full = {x: max(k - less2[a, x], 0) / all_ for x, k in after.items() if all_}
                logs.append(math.log(full.get(b, 0) + (1 - sum(full.values())) * uni(b)))
            assert value == pytest.approx(sum(logs) / len(logs), abs=1e-4)


def test_toxicity_precision_on_rows_not_trained_on(spark):
    d = "/root/testdata/sf0.1"
    marks = spark.read.parquet(f"{d}/labels.parquet")
    known, unknown = marks.filter("doc_id % 3 > 0"), marks.filter("doc_id % 3 = 0").select("doc_id", F.col("toxic").alias("y"))
    got = op9_toxicity.toxicity(spark.read.parquet(f"{d}/documents.parquet"), known)
    n = {(r["y"], r["toxic"]): r["count"] for r in got.join(unknown, "doc_id").groupBy("y", "toxic").count().collect()}
    assert n[1, True] / (n[1, True] + n.get((0, True), 0)) > 0.9 and n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.7


# 10
def test_packing_places_everything_once(docs, texts):
    got = op10_pack.pack_texts(docs).collect()
    want = {d: (n + 1 if n else 0) for d, t in texts.items() for n in [tokenizer.count(t)]}
    sums = Counter()
    bins = defaultdict(list)
    for r in got:
        sums[r["doc_id"]] += r["n_tokens"]
        if r["bin_id"] is not None:
            bins[r["bin_id"]].append((r["bin_offset"], r["n_tokens"]))
    assert {d: sums[d] for d in want} == want
    for parts in bins.values():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at <= op10_pack.CAPACITY
    assert len(bins) <= 1.05 * sum(want.values()) / op10_pack.CAPACITY + 1


def test_exact_complements():
    patterns = op10_pack.plan({60: 2, 40: 1, 30: 1, 10: 1, 25: 4}, 100)
    assert sum(p.count for p in patterns if sum(a * b for a, b in p.items) == 100) == 3
    for lengths in ({7: 3, 5: 9, 3: 20, 1: 2}, {100: 4}, {}, {51: 5}):
        used = Counter()
        for p in op10_pack.plan(lengths, 100):
            assert sum(a * b for a, b in p.items) <= 100
            for a, b in p.items:
                used[a] += b * p.count
        assert {k: v for k, v in used.items() if v} == lengths


def plain_plan(lengths, capacity):
    """The same rules on single pieces: one bin after the other, everything searched for anew."""
    left = Counter({k: v for k, v in lengths.items() if v})
    bins = []

    def take(*parts):
        ok = all(left[p] >= parts.count(p) for p in parts)
        while ok and all(left[p] >= parts.count(p) for p in parts):
            left.subtract(parts)
            bins.append(sorted(parts))

    for first in range(capacity, 0, -1):
        gap = capacity - first
        if gap == 0:
            take(first)
        for n in (1, 2, 3):
            parts = [p for p in itertools.combinations_with_replacement(range(1, gap + 1), n) if sum(p) == gap]
            for p in sorted(parts, reverse=True):
                take(first, *p)
    rest = []
    for length in sorted(left.elements(), reverse=True):
        fits = [b for b in rest if sum(b) + length <= capacity]
        if fits:
            max(fits, key=sum).append(length)
        else:
            rest.append([length])
    return bins, rest


def test_packing_against_brute_force():
    rng = random.Random(11)
    for capacity in (6, 9, 13):
        for _ in range(60):
            lengths = {k: rng.choice([0, 0, 1, 2, 5]) for k in range(1, capacity + 1)}
            exact, rest = plain_plan(lengths, capacity)
            got = [(sorted(x for a, b in p.items for x in [a] * b)) for p in op10_pack.plan({k: v for k, v in lengths.items() if v}, capacity) for _ in range(p.count)]
            full = [b for b in got if sum(b) == capacity]
            assert Counter(map(tuple, exact)) <= Counter(map(tuple, full))
            assert len(got) == len(exact) + len(rest) and sum(map(sum, got)) == sum(k * v for k, v in lengths.items())


def test_packing_is_the_same_in_buckets(spark, monkeypatch):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), (F.pmod(F.col("id"), F.lit(3)) * 700 + 5).alias("n"))
    want = sorted(map(tuple, op10_pack.pack(docs, F.col("n")).collect()))
    monkeypatch.setattr(op10_pack, "RANK_ROWS", 90)
    assert sorted(map(tuple, op10_pack.pack(docs, F.col("n")).collect())) == want
