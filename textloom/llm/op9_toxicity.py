"""Toxicity by class-conditional Kneser-Ney models.

A bigram model of toxic and one of ordinary text, with modified Kneser-Ney discounts: pairs back off to the class's words, and
words to one distribution that both classes share, the continuation counts of words over both. Each model is normalised. A text
counts an expression once, so that one text which repeats a word doesn't make a class. An expression on which the classes don't
surely differ (a likelihood-ratio test), as all rare ones, has the shared count in both, so that only expressions with evidence
tell the classes apart. A text's score is the mean over its words of the difference of the two log-likelihoods; the threshold is
the one that separates held-out labelled rows best (F1).

Labelled rows are cut by a hash of the id: seven tenths train, of these at most ``TRAIN_ROWS`` a class; of the rest at most
``TRAIN_ROWS`` are held out. Scoring covers every document. The model is sent to the workers; its size is bounded by the
training rows' words.

Contract: a label is toxic where ``toxic`` is 1, ordinary where it is 0, and left out where it is null, as are labels without a
document and null texts. Repeated rows count as often as they occur. A text without words has score 0 and isn't toxic. With no
labelled rows of one class nothing is toxic. An empty table gives no rows. Other columns don't matter, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import arrays

TRAIN_ROWS = 3000
#: Log-likelihood ratio (chi-square, one degree) from which a word or pair has counts of its own in each class.
SURE = 16.0
_START = np.uint64(0x5851F42D4C957F2D)


def _pairs(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous word or start, word, text) of every word."""
    t = arrays.words(text)
    h = t.hashes()
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[t.first[:-1][np.diff(t.first) > 0]] = _START
    return before, h, t.doc_of()


def _key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return arrays.mix(before * np.uint64(31) ^ word)


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more."""
    n = np.bincount(np.minimum(counts, 4).astype(np.int64), minlength=5).astype(float) + np.array([0, 1, 1, 1, 1])
    y = n[1] / (n[1] + 2 * n[2])
    return np.array([0.0, *(np.clip(c - (c + 1) * y * n[c + 1] / n[c], 0.3 * c, 0.95 * c) for c in (1, 2, 3))])


@dataclass
class Model:
    """Log-likelihood tables: of words and of seen pairs by class (toxic, ordinary), and back-off weights after each word."""

    words: np.ndarray
    unigram: np.ndarray
    backoff: np.ndarray
    pairs: np.ndarray
    bigram: np.ndarray
    unseen: np.ndarray
    threshold: float = float("inf")

    def score(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mean log-likelihood of each text's words under both models, and number of words."""
        if not hasattr(self, "_find"):
            self._find = arrays.Lookup(self.words), arrays.Lookup(self.pairs)
        before, word, doc = _pairs(text)
        w, p = self._find[0].find(word), self._find[1].find(_key(before, word))
        b = np.empty_like(w)
        b[1:] = w[:-1]
        start = before == _START
        b[start] = self._find[0].find(np.array([_START]))[0]
        n = np.bincount(doc, minlength=len(text)).astype(float)
        out = []
        for c in range(2):
            value = np.where(w < 0, self.unseen[c], self.unigram[c][w]) + np.where(b < 0, 0.0, self.backoff[c][b])
            value = np.where(p < 0, value, self.bigram[c][p]) if len(self.pairs) else value
            out.append(np.bincount(doc, value, minlength=len(text)) / np.maximum(n, 1))
        return out[0], out[1], n


def _tell(n1: np.ndarray, n0: np.ndarray, t1: int, t0: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts a class (toxic, ordinary) on the scale of all texts: its own where the classes differ surely, else the shared one."""
    all_, texts = n1 + n0, t1 + t0

    def part(n: np.ndarray, rate: np.ndarray, t: int) -> np.ndarray:
        return n * np.log(np.maximum(n, 1e-9) / (t * rate)) + (t - n) * np.log(np.maximum(t - n, 1e-9) / np.maximum(t * (1 - rate), 1e-9))

    rate = np.clip(all_ / texts, 1e-12, 1 - 1e-12)
    differ = 2 * (part(n1, rate, t1) + part(n0, rate, t0)) >= SURE
    return np.where(differ, n1 * (texts / t1), all_), np.where(differ, n0 * (texts / t0), all_)


def train(texts: dict[int, pa.Array]) -> Model:
    """Fits both models; class 1 is toxic. Each is normalised: probabilities of all words and of a stranger add up to one."""
    keys, befores, afters, of = [], [], [], []
    for c in (1, 0):
        parts = [_once(p) for p in arrays.pieces(texts[c])]
        k, before, after, single = (np.concatenate(x) if parts else np.zeros(0, np.uint64) for x in (zip(*parts) if parts else [()] * 4))
        keys.append(k)
        befores.append(before)
        afters.append(after)
        of.append(np.unique(single, return_counts=True))
    t1, t0 = len(texts[1]), len(texts[0])
    pairs, at, which = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    before, after = np.concatenate(befores)[at], np.concatenate(afters)[at]
    m1, m0 = (np.bincount(w, minlength=len(pairs)).astype(float) for w in (which[: len(keys[0])], which[len(keys[0]) :]))
    words = np.unique(np.concatenate([np.array([_START]), *(w for w, _ in of)]))
    find = arrays.Lookup(words)
    n1, n0 = np.zeros(len(words)), np.zeros(len(words))
    n1[find.find(of[0][0])], n0[find.find(of[1][0])] = of[0][1], of[1][1]
    context, target = find.find(before), find.find(after)
    # Shared: in how many contexts a word stands, over both classes, as lower orders count; one more place for strangers.
    seen = np.bincount(target, minlength=len(words)).astype(float)
    shared, stranger = seen / (seen.sum() + 1), 1 / (seen.sum() + 1)
    unigram, bigram, backoff, unseen = [], [], [], []
    for n, m in zip(_tell(n1, n0, t1, t0), _tell(m1, m0, t1, t0)):
        total = max(n.sum(), 1e-9)
        kept = np.maximum(n - _less(n1 + n0), 0) / total
        left = 1 - kept.sum()
        uni = kept + left * shared
        size = np.bincount(context, m, minlength=len(words))
        full = np.maximum(m - _less(m1 + m0), 0) / np.maximum(size, 1e-9)[context]
        weight = np.where(size > 0, np.maximum(1 - np.bincount(context, full, minlength=len(words)), 1e-6), 1.0)
        bigram.append(np.log(np.maximum(full + weight[context] * uni[target], 1e-300)).astype(np.float32))
        unigram.append(np.log(np.maximum(uni, 1e-300)).astype(np.float32))  # the start has no counts and is never asked for
        backoff.append(np.log(weight).astype(np.float32))
        unseen.append(np.log(left * stranger))
    return Model(words, np.stack(unigram), np.stack(backoff), pairs, np.stack(bigram), np.array(unseen))


def _once(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pair, its first word, its second) of each text once, and each text's words once."""
    before, word, doc = _pairs(text)
    key, salt = _key(before, word), arrays.mix(doc.astype(np.uint64))
    pair = np.unique(arrays.mix(key ^ salt), return_index=True)[1]
    single = np.unique(arrays.mix(word ^ salt), return_index=True)[1]
    return key[pair], before[pair], word[pair], word[single]


def _less(counts: np.ndarray) -> np.ndarray:
    """The discount of each count."""
    some = counts > 0
    return _discounts(counts[some])[np.minimum(counts, 3).astype(int)] * some if some.any() else np.zeros(len(counts))


def best_threshold(score: np.ndarray, toxic: np.ndarray) -> float:
    """Midpoint between neighbouring scores at which calling higher ones toxic gives the best F1."""
    order = np.argsort(-score, kind="stable")
    s, hits = score[order], np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, len(s) + 1) + toxic.sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    k = int(np.argmax(f1))
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k]) - 1e-9


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> Model | None:
    """Trains on at most ``train_rows`` labelled rows a class and sets the threshold on as many others (natural shares)."""
    marks = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("toxic")).filter("toxic in (0, 1)")
    cut = F.xxhash64(F.lit("toxicity"), "label_id")
    train_part = F.pmod(cut, F.lit(10)) < 7
    order = (F.xxhash64("label_id", F.lit(9)), "label_id")
    chosen = None
    for c in (1, 0):
        part = marks.filter(train_part & (F.col("toxic") == c)).orderBy(*order).limit(train_rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    held = marks.filter(~train_part).orderBy(*order).limit(train_rows)
    named = docs.select(F.col(id_col).alias("label_id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())

    def rows(part: DataFrame) -> pa.Table:
        return named.join(F.broadcast(part), "label_id").select("toxic", "text").toArrow()  # at most 2 * train_rows ids

    t = rows(chosen)
    texts = {c: t.filter(pa.compute.equal(t["toxic"], c))["text"].combine_chunks() for c in (1, 0)}
    if not len(texts[0]) or not len(texts[1]):
        return None
    model = train(texts)
    h = rows(held)
    if h.num_rows and 0 < pa.compute.sum(h["toxic"]).as_py() < h.num_rows:
        score, toxic = [], h["toxic"].to_numpy()
        for p in arrays.pieces(h["text"].combine_chunks()):
            a, b, _ = model.score(p)
            score.append(a - b)
        model.threshold = best_threshold(np.concatenate(score), toxic)
        del model._find  # made anew by each worker, not sent
    else:
        model.threshold = 0.05
    return model


def scores(text: Column, model: Model, spark: SparkSession) -> Column:
    """Struct of the mean log-likelihoods (toxic, ordinary) of a text's words, and their number."""
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("toxic_ll double, ordinary_ll double, n_words int")
    def score(arr: pa.Array) -> pa.Array:
        got = [sent.value.score(p) for p in arrays.pieces(arr)]
        cols = [np.concatenate([g[k] for g in got]) if got else np.zeros(0) for k in range(3)]
        return pa.StructArray.from_arrays([pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2].astype(np.int32))], ["toxic_ll", "ordinary_ll", "n_words"])

    return score(text)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, toxic_ll, ordinary_ll, score, toxic) of every row."""
    model = fit(docs, labels, id_col, text_col, label_col, train_rows)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if model is None:
        zero = F.lit(0.0)
        return rows.select("doc_id", zero.alias("toxic_ll"), zero.alias("ordinary_ll"), zero.alias("score"), F.lit(False).alias("toxic"))
    got = rows.select("doc_id", scores(F.col("text"), model, docs.sparkSession).alias("s"))
    diff = F.col("s.toxic_ll") - F.col("s.ordinary_ll")
    toxic = (F.col("s.n_words") > 0) & (diff > model.threshold)
    return got.select("doc_id", F.round("s.toxic_ll", 6).alias("toxic_ll"), F.round("s.ordinary_ll", 6).alias("ordinary_ll"), F.round(diff, 6).alias("score"), toxic.alias("toxic"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op9_toxicity": op9_toxicity}
SQL: dict[str, str] = {}
