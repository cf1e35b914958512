"""Licence scans by patience alignment.

A text's words are aligned with a template's: words that are unique in both are anchors, the longest increasing subsequence of
anchors is kept, and the gaps between them are aligned in the same way; a gap without anchors gets the longest common
subsequence. Coverage is the share of the template's words that are aligned within ``SPREAD`` times its length of consecutive
text words. A template whose key words (a licence's name and version) aren't all aligned isn't found. Templates of all lengths,
brief notices and whole texts, follow the same rule.

Every text is read whole. A template is tried at each place of a text where a stretch of that length has enough of the
template's words (counted with their multiplicity), which any stretch with enough coverage has. Where finds of several templates
overlap, the one with most aligned words is kept, then the one with most coverage, the shortest, the first by name.

Contract: one row for every licence found (doc_id, license, coverage, first_word, last_word), in each text without overlap;
last_word is included. Texts without words (null or empty) have none. Repeated rows each get theirs; null ids are carried. An
empty table gives no rows. Other columns of the input don't matter, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import arrays
from textloom.llm.licenses import TEMPLATES, Template

COVERAGE, SPREAD = 0.8, 1.5


def increasing(places: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence (patience sorting)."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, x in enumerate(places):
        k = bisect_left(tops, x)
        back.append(at[k - 1] if k else -1)
        if k == len(tops):
            tops.append(x)
            at.append(i)
        else:
            tops[k], at[k] = x, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """A longest common subsequence as pairs of places."""
    n = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    other = np.array(b)
    for i, x in enumerate(a, 1):
        n[i, 1:] = np.maximum.accumulate(np.maximum(n[i - 1, 1:], n[i - 1, :-1] + (other == x)))
    out, i, j = [], len(a), len(b)
    while i and j:
        if n[i, j] == n[i - 1, j]:
            i -= 1
        elif n[i, j] == n[i, j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return out[::-1]


def align(template: list[int], text: list[int]) -> list[tuple[int, int]]:
    """Aligned (template place, text place), increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(template), 0, len(text))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(template[a0:a1]), Counter(text[b0:b1])
        where = {w: j for j, w in enumerate(text[b0:b1], b0) if in_b[w] == 1}
        anchors = [(i, where[w]) for i, w in enumerate(template[a0:a1], a0) if in_a[w] == 1 and w in where]
        if not anchors:
            out += [(a0 + i, b0 + j) for i, j in common(template[a0:a1], text[b0:b1])]
            continue
        kept = [anchors[k] for k in increasing([j for _, j in anchors])]
        out += kept
        ends = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:])]
    return sorted(out)


class Scanner:
    """Templates ready for scanning."""

    def __init__(self, templates: Iterable[Template]):
        given = list(templates)
        t = arrays.words(pa.array([x.text for x in given], pa.string()))
        own = [t.hashes()[a:b] for a, b in zip(t.first, t.first[1:])]
        self.names = [x.license for x, w in zip(given, own) if len(w)]
        self.vocabulary = np.unique(t.hashes())
        self.find = arrays.Lookup(self.vocabulary)
        self.words = [np.searchsorted(self.vocabulary, w).tolist() for w in own if len(w)]
        self.counts = [np.bincount(w, minlength=len(self.vocabulary)) for w in self.words]
        self.need = [ceil(COVERAGE * len(w)) for w in self.words]
        keys = [self.find.find(arrays.words(pa.array([" ".join(x.keys)], pa.string())).hashes()) for x, w in zip(given, own) if len(w)]
        self.keys = [np.unique(k) for k in keys]

    def scan(self, text: pa.Array) -> Iterator[tuple[int, str, float, int, int]]:
        """(text, licence, coverage, first word, last word); words count from the text's first."""
        t = arrays.words(text)
        ids = self.find.find(t.hashes())
        hits = np.flatnonzero(ids >= 0)
        kinds = len(self.vocabulary)
        if not len(hits):
            return
        doc = np.searchsorted(t.first, hits, "right") - 1
        some, row = np.unique(doc, return_inverse=True)
        have = np.bincount(row * kinds + ids[hits], minlength=len(some) * kinds).reshape(len(some), kinds)
        found: dict[int, list[tuple[int, float, int, int, str]]] = {}
        for k, name in enumerate(self.names):
            ok = (np.minimum(have, self.counts[k]).sum(axis=1) >= self.need[k]) & (have[:, self.keys[k]] > 0).all(axis=1)
            for d in some[ok]:
                found.setdefault(int(d), []).extend((-n, -n / len(self.words[k]), b - a, a, name) for n, a, b in self._in_text(k, ids[t.first[d] : t.first[d + 1]]))
        for d in sorted(found):
            kept: list[tuple[int, int, str, float]] = []
            for _, share, length, a, name in sorted(found[d]):
                if all(a > hi or a + length < lo for lo, hi, *_ in kept):
                    kept.append((a, a + length, name, -share))
            yield from ((d, name, share, lo, hi) for lo, hi, name, share in sorted(kept))

    def _in_text(self, k: int, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(aligned words, first word, last word) from left to right without overlap."""
        words, need, most, keys = self.words[k], self.need[k], self.counts[k], self.keys[k]
        span = ceil(SPREAD * len(words))
        mine = np.flatnonzero((ids >= 0) & (most[ids] > 0))
        last = np.searchsorted(mine, mine + span)  # hits of the stretch that begins at a hit
        at = 0
        for i in np.flatnonzero(last - np.arange(len(mine)) >= need):
            if mine[i] < at:
                continue
            stretch = np.bincount(ids[mine[i : last[i]]], minlength=len(most))
            if np.minimum(stretch, most).sum() < need or not stretch[keys].all():
                continue
            got = align(words, ids[mine[i] : mine[i] + span].tolist())
            # where the first word isn't aligned, a later start has the same words
            if len(got) >= need and got[0][1] == 0 and np.isin(keys, [words[a] for a, _ in got]).all():
                yield len(got), int(mine[i]), int(mine[i] + got[-1][1])
                at = mine[i] + got[-1][1] + 1


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Iterable[Template] = TEMPLATES) -> DataFrame:
    """(doc_id, license, coverage, first_word, last_word) of every licence in every text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    given = tuple(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(given)
        for b in arrays.slices(batches, "text"):
            got = list(scanner.scan(b["text"]))
            if got:
                at, name, share, lo, hi = zip(*got)
                yield pa.record_batch(
                    [b["doc_id"].take(pa.array(at)), pa.array(name), pa.array([round(x, 6) for x in share]), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())],
                    ["doc_id", "license", "coverage", "first_word", "last_word"],
                )

    return rows.mapInArrow(run, "doc_id long, license string, coverage double, first_word int, last_word int")


def op6_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op6_license": op6_license}
SQL: dict[str, str] = {}
