"""The corpus pipeline, stage by stage on what the stage before kept."""

import random
from functools import partial

import numpy as np
import pyarrow as pa

import corpus_pipeline
from tests.llm.test_ops import brute_groups, crowd, met
from textloom.llm import op2_quality, op4_suffix, op8_simhash, tokenizer

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        kept[name] = before, docs = docs, spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == before.columns
            assert 0 < docs.count() <= before.count()
    good = {r["doc_id"] for r in op2_quality.quality(kept["quality"][0]).filter("keep").collect()}
    assert {r["doc_id"] for r in kept["quality"][1].collect()} == good
    assert op8_simhash.duplicates(kept["near_duplicates"][1]).count() == 0
    assert op4_suffix.repeats(kept["repeated_passages"][1]).filter("cut").count() <= op4_suffix.repeats(kept["repeated_passages"][0]).filter("cut").count() // 4
    texts = {r["doc_id"]: r["text"] for r in kept["packing"][0].collect()}
    sums = {}
    for r in docs.collect():
        sums[r["doc_id"]] = sums.get(r["doc_id"], 0) + r["n_tokens"]
    assert sums == {d: (n + 1 if n else 0) for d, t in texts.items() for n in [tokenizer.count(t)]}


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "bin_id"} <= set(out.columns)


def test_near_duplicates_of_hot_min_hashes(spark, monkeypatch):
    """However small the shards, of two near copies that share a min-hash one goes."""
    monkeypatch.setattr(op8_simhash, "keep_one", partial(op8_simhash.keep_one, shard_rows=8))
    texts = crowd(800, 15, 6)
    every = brute_groups(texts)
    pairs = met(texts, every)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, df, SF).collect()}
    assert not [p for p in pairs if kept.issuperset(p)] and len(pairs) >= 15
    assert kept >= {i for i in texts if not any(i in p for p in every)}


def couples(n, changes, seed):
    """(texts, sharing): n strangers of 40 words, each with a copy n further that differs in some words and is a hit; min-hashes they share."""
    rng = random.Random(seed)
    one = [[f"w{rng.random()}" for _ in range(40)] for _ in range(n)]
    other = [list(w) for w in one]
    for w in other:
        for k in rng.sample(range(40), changes):
            w[k] = f"x{rng.random()}"
    texts = [" ".join(w) for w in [*one, *other]]
    sig, mins, _ = op8_simhash.signatures(pa.array(texts))
    hit = np.flatnonzero(op8_simhash.hamming(sig[:n], sig[n:]) <= op8_simhash.DISTANCE).tolist()
    return {k: texts[k] for i in hit for k in (i, n + i)}, dict(zip(hit, (mins[:n] == mins[n:]).sum(1)[hit].tolist()))


def test_near_duplicates_of_many_strangers(spark):
    """A shard's graph doesn't find some of the pairs of strangers; of two near copies that share a min-hash one goes all the same."""
    texts, sharing = couples(4000, 3, 8)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, df, SF).collect()}
    pairs = [i for i, k in sharing.items() if k]
    assert not [i for i in pairs if i + 4000 in kept] and len(pairs) > 1000
    assert kept.issuperset(sharing)
