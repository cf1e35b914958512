"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns, for every operator and stage."""

from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textloom.llm import arrays, op1_pitman_yor, op2_quality, op3_decontaminate, op4_suffix, op5_html, op6_license, op7_token_counts, op8_simhash, op9_toxicity, op10_pack
from textloom.llm.scratch import made, shared_dir

EXTRA = ["row_key", "key", "text_", "votes", "code", "quality_votes", "hash_a", "hash_b", "cid", "pair", "cut", "cuts", "left", "n", "n_tokens", "toxic", "label_id", "mark", "bucket", "shard", "segment", "blob", "got", "item_id", "item_key", "top_key", "gone_key"]
BASE = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = " ".join(f"the word{i} of {i * 7 % 100} and it was in that" for i in range(60)) + "."


def table(spark, rows):
    df = spark.createDataFrame(rows, BASE)
    return df.select("*", *[F.lit("x").alias(c) for c in EXTRA])


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    texts = [PROSE, PROSE, None, "", " \n\t ", "x", "one two", "é " * 40, "a" * 200_000, " " * 150_000, "\n".join(["same line here."] * 500), "word " * 60_000, PROSE + " tail", "\x00 zero ퟿", "Released under the MIT License."]
    rows = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in enumerate(texts)]
    rows += [(0, PROSE, "en", "s", len(PROSE)), (None, PROSE, None, None, None), (None, None, None, None, None)]
    path = str(tmp_path_factory.mktemp("awkward") / "documents.parquet")
    table(spark, rows).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, " ".join(PROSE.split()[20:50])), (2, None), (3, ""), (None, "no such words anywhere at all here")], "item_id long, text string").select("*", F.lit(1).alias("row_key"), F.lit(2).alias("doc_id"))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(0, 0), (12, 1), (6, 0), (None, 1), (7, None), (999, 1)], "doc_id long, toxic int").withColumn("text", F.lit("z")).withColumn("label_id", F.lit(1))


OPS = {
    "op1": (lambda d, i, l: op1_pitman_yor.score(d), True),
    "op2": (lambda d, i, l: op2_quality.quality(d), True),
    "op3": (lambda d, i, l: op3_decontaminate.matches(d, i), False),
    "op4": (lambda d, i, l: op4_suffix.repeats(d), False),
    "op5": (lambda d, i, l: op5_html.main_text(d, "doc_id", "text"), True),
    "op6": (lambda d, i, l: op6_license.licenses(d), False),
    "op7": (lambda d, i, l: op7_token_counts.token_counts(d), True),
    "op8": (lambda d, i, l: op8_simhash.duplicates(d), False),
    "op9": (lambda d, i, l: op9_toxicity.toxicity(d, l), True),
    "op10": (lambda d, i, l: op10_pack.pack_texts(d), False),
}


@pytest.mark.parametrize("name", OPS)
def test_awkward_rows(awkward, items, labels, name):
    f, every_row = OPS[name]
    got = f(awkward, items, labels).collect()
    if every_row:
        assert len(got) == awkward.count()


@pytest.mark.parametrize("name", OPS)
def test_empty_table(empty, items, labels, name):
    assert OPS[name][0](empty, items, labels).count() == 0


def test_no_items(awkward, items, labels):
    assert op3_decontaminate.matches(awkward, items.limit(0)).count() == 0
    assert op9_toxicity.toxicity(awkward, labels.limit(0)).filter("toxic").count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, awkward, empty, items, tmp_path, name, stage):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    out = stage(spark, awkward, str(tmp_path))
    rows = out.collect()
    if name != "packing":
        assert out.columns == awkward.columns and out.schema.simpleString() == awkward.schema.simpleString()
        assert len(rows) <= awkward.count()
    assert stage(spark, empty, str(tmp_path)).count() == 0


def test_toxicity_of_awkward_rows(spark, awkward):
    bad = spark.createDataFrame([(100 + i, f"the word of it and {'vile nasty' if i % 2 else 'house'} was {i}") for i in range(200)], "doc_id long, text string")
    docs = awkward.select("doc_id", "text").unionByName(bad).unionByName(bad.limit(1))
    marks = bad.select("doc_id", F.pmod("doc_id", F.lit(2)).alias("toxic"))
    got = op9_toxicity.toxicity(docs, marks).collect()
    assert len(got) == docs.count()
    for r in got:
        if r["doc_id"] in (2, 3, 4):
            assert r["score"] == 0 and not r["toxic"]
        if (r["doc_id"] or 0) >= 100:
            assert r["toxic"] == (r["doc_id"] % 2 == 1)


def test_stages_leave_no_tables(spark, awkward, items, tmp_path):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    root = Path(shared_dir(spark).removeprefix("file:"))
    before = set(root.glob("scratch-*/*"))
    for name, stage in corpus_pipeline.STAGES:
        with made():
            stage(spark, awkward, str(tmp_path)).write.parquet(str(tmp_path / name))
    for f in (OPS[k][0] for k in ("op1", "op2", "op3", "op4", "op7", "op8", "op10")):
        f(awkward, items, None).count()
    assert set(root.glob("scratch-*/*")) == before


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://there:7077"
        getConf = staticmethod(lambda: {})

        class _jsc:
            sc = staticmethod(lambda: type("J", (), {"getCheckpointDir": staticmethod(lambda: type("O", (), {"isDefined": staticmethod(lambda: False)}))}))

    session = type("S", (), {"sparkContext": Context, "conf": type("C", (), {"get": staticmethod(lambda k, d: d)})})
    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(session)


def test_defined_results(awkward, items):
    gone = {(r["doc_id"], r["kept_id"]) for r in op8_simhash.duplicates(awkward).collect()}
    assert (1, 0) in gone and (12, 0) in gone and (None, 0) in gone and not any(a == 2 for a, _ in gone)
    found = [r for r in op6_license.licenses(awkward).collect()]
    assert [(r["doc_id"], r["license"], r["coverage"]) for r in found] == [(14, "mit", 1.0)]
    packed = op10_pack.pack_texts(awkward).collect()
    assert {r["doc_id"] for r in packed if r["bin_id"] is None} >= {2, 3}
    assert {r["doc_id"] for r in op3_decontaminate.matches(awkward, items).collect()} == {0, 1, 12, None}
    assert {r["kind"] for r in op3_decontaminate.matches(awkward, items).collect()} == {"phrase"}
    votes = {r["doc_id"]: r for r in op2_quality.quality(awkward).collect()}
    for d in (2, 3, 4):  # no words: the length rule alone votes, for bad
        assert votes[d]["votes"] == "1" + "0" * 11 and not votes[d]["keep"]
    assert votes[0]["posterior"] == votes[1]["posterior"] and votes[0]["votes"] == votes[1]["votes"]
    spans = op4_suffix.repeats(awkward).collect()
    n = len(arrays.words(pa.array([PROSE])).starts)
    whole = sorted((str(r["doc_id"]), r["cut"]) for r in spans if (r["start_word"], r["end_word"]) == (0, n))
    assert whole == [("0", False), ("0", True), ("1", True), ("12", True), ("None", True)]  # the first of the repeated rows stays
    assert {r["doc_id"] for r in spans} == {0, 1, 10, 11, 12, None}  # repeats within one text count too
    main = {r["page_id"]: r for r in op5_html.main_text(awkward, "doc_id", "text").collect()}
    assert all(main[d]["text"] == "" and main[d]["n_blocks"] == 0 for d in (2, 3, 4)) and main[0]["text"] == PROSE
    counts = {r["doc_id"]: r for r in op7_token_counts.token_counts(awkward).collect()}
    assert all(tuple(counts[d])[1:] == (0, 0, 0, 0) for d in (2, 3)) and counts[12]["n_tokens"] > counts[0]["n_tokens"] == counts[1]["n_tokens"]
    scores = {r["doc_id"]: r for r in op1_pitman_yor.score(awkward).collect()}
    assert scores[2]["n_words"] == 0 and scores[2]["perplexity"] is None and scores[3]["log_prob"] == 0
