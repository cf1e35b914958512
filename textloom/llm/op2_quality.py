"""Quality rules by weak supervision.

Twelve rules read a text and vote good, bad or abstain. Votes of all documents are counted by pattern (at most 3**12 rows,
whatever the corpus), expectation-maximisation on those counts estimates the share of good documents and each rule's
accuracy, and a document's posterior probability of being good replaces the all-must-pass filter.

Contract: a null or empty text has no words, so only the length rule votes on it (bad). Repeated rows each count and each get a
row. An empty table gives no rows. Ties at ``keep_at`` are kept. Other columns of the input don't matter, whatever their
names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import arrays
from textloom.llm.scratch import Scratch, fresh

ABSTAIN, BAD, GOOD = 0, 1, 2
#: Words of a stretch whose share of distinct words is measured; a text has the mean over its stretches.
STRETCH = 1000
RULES = ("length", "stop_words", "symbols", "symbol_share", "repeats", "shouting", "exclaiming", "variety", "punctuation", "word_length", "line_ends", "repeated_lines")
STOP = """the of and to in that is was he for it with as his on be at by this had not are but from or have an they which
you were her all she there would their le la les de des du un une et est en que qui dans pour pas sur au avec ce il
der die das und ist von den zu mit sich auf für nicht ein eine als auch dem im el los las y por con una se del no su""".split()
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*|@^~<>{}\\=+_[]`"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True


def _per_text(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return (total[off[1:]] - total[off[:-1]]).astype(float)


def features(arr: pa.Array) -> dict[str, np.ndarray]:
    """Counts and shares of each text."""
    data, off = arrays.raw(arr)
    t = arrays.words(arr)
    h, first = t.hashes(), t.first
    n = np.diff(first).astype(float)
    some = np.maximum(n, 1)
    length = np.concatenate([[0], np.cumsum(t.ends - t.starts)])
    stop = np.isin(h, _stop_hashes())
    doc = t.doc_of()
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    part = (np.arange(len(h)) - first[doc]) // STRETCH
    begins = np.zeros(len(h), bool)
    begins[1:] = (part[1:] != part[:-1]) | (doc[1:] != doc[:-1])
    part = np.cumsum(begins)
    order = np.lexsort((h, part))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (part[order][1:] != part[order][:-1])
    nonascii = data >= 0xC3
    upper2 = np.zeros(len(data), bool)
    upper2[1:] = (data[:-1] == 0xC3) & (data[1:] < 0x9F)
    letters = _per_text(_LETTER[data] | nonascii, off)
    newline = data == 10
    inner = np.zeros(len(data) + 1, bool)  # positions after which a line ends
    inner[np.flatnonzero(newline)] = True
    inner[off[1:]] = True
    ends = np.flatnonzero(inner)
    starts = np.concatenate([[0], ends[:-1] + (newline[ends[:-1]] if len(ends) > 1 else 0)]) if len(ends) else ends
    full = ends > starts
    starts, ends = starts[full], ends[full]
    which = np.searchsorted(off, starts, "right") - 1
    up, down = arrays._powers(arrays._P, len(data) + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
    key = (total[ends] - total[starts]) * down[starts]
    lo = np.lexsort((key, which))
    again = np.zeros(len(key), bool)
    again[1:] = (key[lo][1:] == key[lo][:-1]) & (which[lo][1:] == which[lo][:-1])
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    k = len(n)
    lines = np.bincount(which, minlength=k).astype(float) if len(which) else np.zeros(k)
    return {
        "words": n,
        "stop": _per_text(stop, first) / some,
        "distinct": np.bincount(doc[order][new], minlength=k) / some if len(h) else np.zeros(k),
        "repeat": _per_text(same, first) / some,
        "mean_len": (length[first[1:]] - length[first[:-1]]) / some,
        "symbol": _per_text(_SYMBOL[data], off) / some,
        "symbol_share": _per_text(_SYMBOL[data], off) / np.maximum(np.diff(off), 1),
        "exclaim": _per_text(data == 33, off) / some,
        "upper": _per_text(_UPPER[data] | upper2, off) / np.maximum(letters, 1),
        "letters": letters,
        "points": _per_text((data == 46) | (data == 33) | (data == 63), off) / some,
        "lines": lines,
        "closed": (np.bincount(which[np.isin(last, [46, 33, 63, 34, 58])], minlength=k) if len(which) else np.zeros(k)) / np.maximum(lines, 1),
        "line_again": (np.bincount(which[lo][again], minlength=k) if len(which) else np.zeros(k)) / np.maximum(lines, 1),
    }


_stops: list[np.ndarray] = []


def _stop_hashes() -> np.ndarray:
    if not _stops:
        _stops.append(np.unique(arrays.words(pa.array(STOP)).hashes()))
    return _stops[0]


def votes(arr: pa.Array) -> np.ndarray:
    """Votes of each rule on each text: shape (texts, rules)."""
    f = features(arr)
    n = f["words"]

    def vote(asked: np.ndarray, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
        return np.where(asked & bad, BAD, np.where(asked & good, GOOD, ABSTAIN))

    some = n >= 8
    out = [
        vote(n >= 0, ~(n < 3), n < 3),
        vote(some, f["stop"] >= 0.12, (n >= 25) & (f["stop"] < 0.04)),
        vote(n > 0, ~(f["symbol"] >= 0.3), f["symbol"] >= 0.3),
        vote(n > 0, ~(f["symbol_share"] >= 0.04), f["symbol_share"] >= 0.04),
        vote(some, ~(f["repeat"] >= 0.2), f["repeat"] >= 0.2),
        vote(f["letters"] >= 20, ~(f["upper"] >= 0.5), f["upper"] >= 0.5),
        vote(some, ~(f["exclaim"] >= 0.3), f["exclaim"] >= 0.3),
        vote(n >= 30, f["distinct"] >= 0.35, f["distinct"] < 0.2),
        vote(n >= 40, ~((f["points"] < 0.004) | (f["points"] > 0.8)), (f["points"] < 0.004) | (f["points"] > 0.8)),
        vote(some, ~((f["mean_len"] < 2) | (f["mean_len"] > 12)), (f["mean_len"] < 2) | (f["mean_len"] > 12)),
        vote(some, f["closed"] >= 0.6, (f["lines"] >= 3) & (f["closed"] < 0.1)),
        vote(f["lines"] >= 4, ~(f["line_again"] >= 0.4), f["line_again"] >= 0.4),
    ]
    return np.stack(out, axis=1).astype(np.int8) if len(n) else np.zeros((0, len(RULES)), np.int8)


_BASE = 3 ** np.arange(len(RULES))


def code_column(text: Column) -> Column:
    """The vote pattern of a text as one integer, rule j being digit j to base 3."""

    @F.arrow_udf("int")
    def code(arr: pa.Array) -> pa.Array:
        parts = [votes(p) @ _BASE for p in arrays.pieces(arr)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.int32())

    return code(text)


@dataclass(frozen=True)
class Model:
    """Prior share of good documents and each rule's accuracies: how often it votes bad on bad and good on good documents."""

    prior: float
    on_bad: tuple[float, ...]
    on_good: tuple[float, ...]

    def weights(self) -> np.ndarray:
        """Log-odds that each vote adds, by rule and vote (abstain, bad, good)."""
        return _weights(np.array(self.on_bad), np.array(self.on_good))


def _weights(on_bad: np.ndarray, on_good: np.ndarray) -> np.ndarray:
    return np.stack([np.zeros(len(on_bad)), np.log((1 - on_good) / on_bad), np.log(on_good / (1 - on_bad))], axis=1)


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> Model:
    """Expectation-maximisation (Dawid and Skene) over vote patterns (rows of digits) with their counts.

    Votes are independent given the class; an abstaining rule is a missing vote. It starts from patterns without a bad vote as
    good ones. Pseudo-votes (one right and one wrong on bad, 9.9 right and 0.1 wrong on good documents) keep accuracies from
    0 and 1.
    """
    rules, total = patterns.shape[1], float(counts.sum())
    bad, good = (patterns == BAD).astype(float), (patterns == GOOD).astype(float)
    p = np.where(bad.any(1), 0.1, 0.95)
    prior, on_bad, on_good = 0.9, np.full(rules, 0.5), np.full(rules, 0.99)
    for _ in range(rounds if total else 0):
        g, b = (counts * p)[:, None], (counts * (1 - p))[:, None]
        on_good = ((g * good).sum(0) + 9.9) / ((g * (good + bad)).sum(0) + 10)
        on_bad = ((b * bad).sum(0) + 1) / ((b * (good + bad)).sum(0) + 2)
        prior = float(np.clip((counts * p).sum() / total, 0.01, 0.99))
        w = _weights(on_bad, on_good)
        odds = math.log(prior / (1 - prior)) + bad @ w[:, BAD] + good @ w[:, GOOD]
        new = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        moved, p = np.abs(new - p).max(), new
        if moved < 1e-10:
            break
    return Model(prior, tuple(map(float, on_bad)), tuple(map(float, on_good)))


def digits(codes: np.ndarray) -> np.ndarray:
    return (codes[:, None] // _BASE[None, :]) % 3


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Fits the model to the votes on every document; only pattern counts reach the driver (3**12 at most)."""
    return _fit(docs.select(code_column(F.col(text_col)).alias("code")).groupBy("code").count())


def _fit(counted: DataFrame) -> Model:
    rows = counted.orderBy("code").collect()
    return fit(digits(np.array([r["code"] for r in rows], np.int64)), np.array([r["count"] for r in rows], float))


def posterior(code: Column, model: Model) -> Column:
    """P(good | votes) as a native expression of the vote pattern."""
    total = F.lit(math.log(model.prior / (1 - model.prior)))
    for j, (abstain, bad, good) in enumerate(model.weights()):
        digit = F.pmod(F.floor(code / F.lit(int(_BASE[j]))), F.lit(3))
        total = total + F.when(digit == GOOD, float(good)).when(digit == BAD, float(bad)).otherwise(float(abstain))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_at: float = 0.5) -> DataFrame:
    """(doc_id, votes, posterior, keep) of every row; ``votes`` has a digit a rule: 0 abstains, 1 bad, 2 good; checkpointed.

    Texts are read once: their votes are stored, and the model and the posteriors are made from these.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.table("codes", docs.select(F.col(id_col).alias("doc_id"), code_column(F.col(text_col)).alias("code")))
    model = _fit(rows.groupBy("code").count())
    shown = F.concat(*[F.pmod(F.floor(F.col("code") / F.lit(int(b))), F.lit(3)).cast("string") for b in _BASE])
    p = F.round(posterior(F.col("code"), model), 6)
    return scratch.result(rows.select("doc_id", shown.alias("votes"), p.alias("posterior"), (p >= keep_at).alias("keep")))


def keep_good(docs: DataFrame, text_col: str = "text", keep_at: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose posterior is at least ``keep_at``, columns unchanged."""
    model, name = train(docs, text_col), fresh(docs, "quality_votes")
    with_code = docs.withColumn(name, code_column(F.col(text_col)))
    return with_code.filter(F.round(posterior(F.col(name), model), 6) >= keep_at).drop(name)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op2_quality": op2_quality}
SQL: dict[str, str] = {}
