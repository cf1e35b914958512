"""Benchmark decontamination on a distributed positional inverted index.

The corpus is indexed in segments of consecutive documents, as search engines do: a segment holds, for every term of its
documents, the ascending positions of the term (delta-coded), and where each document begins. Segments are one row each of
a stored table. A test item is looked up segment by segment:

* *phrase*: for each run of ``phrase`` words of the item (the whole item where it is shorter), the posting list of the rarest
  term is shifted by the term's offset in the run and intersected with the shifted lists of the other terms, rarest first.
* *proximity*: at least ``share`` of the item's distinct terms within ``slack`` times the item's length of consecutive words,
  in any order. Anchors are the occurrences of the rarest terms, so many of them that no match can be without one.

An item with fewer than ``least`` words is sought as a phrase only: any one or two words in any order are no match.

Contract: null or empty texts have no words. Repeated rows each get
their matches; a document matching several items has a row for each. Null ids are carried. Empty tables on either side give
no rows. Other columns of the inputs don't matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import arrays
from textloom.llm.scratch import Scratch, keyed, text_key

PHRASE, LEAST, SHARE, SLACK = 13, 5, 0.8, 1.5
#: Bytes of text in a segment, and of test items that are looked up together.
SEGMENT_BYTES, ITEM_BYTES = 4 << 20, 8 << 20
INDEX = "rows binary, terms binary, lists binary, deltas binary, first binary"
FOUND = "row_key long, item_key long, kind string, hits int, first_word int, last_word int"


@dataclass
class Segment:
    """Terms ascending; the positions of term i are ``at(i)``; document j has the positions ``first[j]`` to ``first[j + 1]``."""

    rows: np.ndarray
    terms: np.ndarray
    lists: np.ndarray
    deltas: np.ndarray
    first: np.ndarray

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Index of each term, -1 where the segment doesn't have it."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        i = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[i] == terms, i, -1)

    def at(self, i: int) -> np.ndarray:
        return np.cumsum(self.deltas[self.lists[i] : self.lists[i + 1]], dtype=np.int64)


def build(keys: np.ndarray, text: pa.Array) -> Segment:
    t = arrays.words(text)
    h = t.hashes()
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    start = np.flatnonzero(new)
    deltas = np.diff(order, prepend=0)
    deltas[start] = order[start]
    return Segment(keys, s[start], np.append(start, len(s)).astype(np.uint32), deltas.astype(np.uint32), t.first.astype(np.uint32))


_TYPES = (np.int64, np.uint64, np.uint32, np.uint32, np.uint32)


def _index(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for b in arrays.slices(batches, "text", most):
        seg = build(b["row_key"].to_numpy(), b["text"])
        cells = [seg.rows, seg.terms, seg.lists, seg.deltas, seg.first]
        yield pa.record_batch([pa.array([np.ascontiguousarray(c, t).tobytes()], pa.binary()) for c, t in zip(cells, _TYPES)], ["rows", "terms", "lists", "deltas", "first"])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[Segment]:
    for b in batches:
        for i in range(b.num_rows):
            yield Segment(*[np.frombuffer(b[k][i].as_buffer(), t) for k, t in enumerate(_TYPES)])


@dataclass
class Item:
    """A test item: its words, and the distinct ones."""

    key: int
    words: np.ndarray
    distinct: np.ndarray


def read_items(keys: list[int], texts: list[str | None]) -> list[Item]:
    t = arrays.words(pa.array(texts, pa.string()))
    h = t.hashes()
    own = [h[a:b] for a, b in zip(t.first, t.first[1:])]
    return [Item(k, w, np.unique(w)) for k, w in zip(keys, own) if len(w)]


def phrases(seg: Segment, words: np.ndarray, found: np.ndarray, size: np.ndarray, n: int, lists: dict[int, np.ndarray]) -> list[np.ndarray]:
    """Start positions of each run of n of ``words``; runs with a term that the segment lacks have none."""

    def at(i: int) -> np.ndarray:
        if i not in lists:
            lists[i] = seg.at(i)
        return lists[i]

    out = []
    missing = np.concatenate([[0], np.cumsum(found < 0)])
    for j in np.flatnonzero(missing[n:] == missing[:-n]):
        run = found[j : j + n]
        order = np.argsort(size[j : j + n], kind="stable")
        start = at(run[order[0]]) - order[0]
        start = start[start >= 0]
        for o in order[1:]:
            if not len(start):
                break
            p = at(run[o])
            k = np.minimum(np.searchsorted(p, start + o), len(p) - 1)
            start = start[p[k] == start + o]
        doc = np.searchsorted(seg.first, start, "right") - 1
        start = start[start + n <= seg.first[doc + 1]]
        if len(start):
            out.append(start)
    return out


def widest(positions: np.ndarray, which: np.ndarray, width: int, kinds: int) -> tuple[int, int, int]:
    """Most distinct ``which`` in a window of ``width`` positions, and the first and last position of the first such window."""
    seen, count, best, left = np.zeros(kinds, int), 0, (0, 0, 0), 0
    for right in range(len(positions)):
        count += not seen[which[right]]
        seen[which[right]] += 1
        while positions[right] - positions[left] >= width:
            seen[which[left]] -= 1
            count -= not seen[which[left]]
            left += 1
        if count > best[0]:
            best = (count, int(positions[left]), int(positions[right]))
    return best


def match(seg: Segment, items: list[Item], phrase: int, least: int, share: float, slack: float) -> Iterator[tuple[int, int, str, int, int, int]]:
    """(row key, item key, kind, hits, first word, last word); words count from the document's start, the last is included.

    ``hits`` is the number of positions at which a run of the item begins, or of distinct terms in the window. A document
    with a phrase match of an item gets no proximity row for it.
    """
    if not items:
        return
    size_of = np.diff(seg.lists.astype(np.int64))
    every = np.concatenate([i.words for i in items])
    found_all, at = seg.find(every), 0
    lists: dict[int, np.ndarray] = {}
    for item in items:
        found = found_all[at : at + len(item.words)]
        at += len(item.words)
        if (found < 0).all():
            continue
        size = np.where(found < 0, 0, size_of[found])
        n = min(phrase, len(item.words))
        done: set[int] = set()
        hits = phrases(seg, item.words, found, size, n, lists)
        if hits:
            p = np.unique(np.concatenate(hits))
            doc = np.searchsorted(seg.first, p, "right") - 1
            for d in np.unique(doc):
                own = p[doc == d] - int(seg.first[d])
                done.add(int(d))
                yield int(seg.rows[d]), item.key, "phrase", len(own), int(own[0]), int(own[-1]) + n - 1
        if len(item.words) < least:
            continue
        m = len(item.distinct)
        need = max(1, int(np.ceil(share * m - 1e-9)))
        idx = seg.find(item.distinct)
        have = np.flatnonzero(idx >= 0)
        if len(have) < need:
            continue
        order = have[np.argsort(size_of[idx[have]], kind="stable")]
        postings = {}
        for k in order[: len(order) - need + 1]:
            i = int(idx[k])
            if i not in lists:
                lists[i] = seg.at(i)
            postings[int(k)] = lists[i]
        anchors = np.unique(np.concatenate(list(postings.values())))
        docs = np.unique(np.searchsorted(seg.first, anchors, "right") - 1)
        docs = np.array([d for d in docs if int(d) not in done], np.int64)
        if not len(docs):
            continue
        for k in order[len(order) - need + 1 :]:
            i = int(idx[k])
            if i not in lists:
                lists[i] = seg.at(i)
            postings[int(k)] = lists[i]
        start, end = seg.first[docs].astype(np.int64), seg.first[docs + 1].astype(np.int64)
        cuts = {k: (np.searchsorted(p, start), np.searchsorted(p, end)) for k, p in postings.items()}
        enough = sum((b > a).astype(int) for a, b in cuts.values()) >= need
        for j in np.flatnonzero(enough):
            pos = [postings[k][a[j] : b[j]] for k, (a, b) in cuts.items()]
            which = np.repeat(np.arange(len(pos)), [len(p) for p in pos])
            pos = np.concatenate(pos)
            o = np.argsort(pos)
            best, lo, hi = widest(pos[o], which[o], int(np.ceil(slack * len(item.words))), m)
            if best >= need:
                yield int(seg.rows[docs[j]]), item.key, "proximity", best, lo - int(start[j]), hi - int(start[j])


def _search(batches: Iterator[pa.RecordBatch], items: list[Item], phrase: int, least: int, share: float, slack: float) -> Iterator[pa.RecordBatch]:
    for seg in _segments(batches):
        rows = list(match(seg, items, phrase, least, share, slack))
        if rows:
            cols = list(zip(*rows))
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32()))],
                ["row_key", "item_key", "kind", "hits", "first_word", "last_word"],
            )


def store_index(rows: DataFrame, scratch: Scratch, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Writes the index of (row_key, text) and returns the stored table."""
    return scratch.table("index", rows.select("row_key", "text").mapInArrow(partial(_index, most=segment_bytes), INDEX))


def search(index: DataFrame, items: DataFrame, scratch: Scratch, phrase: int = PHRASE, least: int = LEAST, share: float = SHARE, slack: float = SLACK) -> DataFrame:
    """Matches of (item_key, text) in the index.

    Test items go to the workers in rounds of at most about ``ITEM_BYTES`` of text, so that what is sent at once stays bounded
    whatever their number.
    """
    spark = index.sparkSession
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    rounds = max(1, -(-size // ITEM_BYTES))
    out = []
    for r in range(rounds):
        part = items if rounds == 1 else items.filter(F.pmod(F.hash("item_key"), F.lit(rounds)) == r)
        got = part.orderBy("item_key").collect()
        ready = read_items([x["item_key"] for x in got], [x["text"] for x in got])
        sent = spark.sparkContext.broadcast(ready)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            return _search(batches, sent.value, phrase, least, share, slack)

        out.append(index.mapInArrow(run, FOUND))
        if rounds > 1:
            out[-1] = scratch.table(f"found{r}", out[-1])
    found = out[0]
    for x in out[1:]:
        found = found.unionByName(x)
    return found


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", **how) -> DataFrame:
    """(doc_id, item_id, kind, hits, first_word, last_word) of every match; checkpointed, as the index is removed."""
    scratch = Scratch(docs.sparkSession)
    rows = keyed(docs, "row_key", scratch, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tests = keyed(items, "item_key", scratch, F.col(item_col).alias("item_id"), F.col(item_text).alias("text"))
    found = scratch.table("found", search(store_index(rows, scratch), tests, scratch, **how))
    hit = found.select("row_key").distinct()
    ids = rows.select("row_key", "doc_id").join(hit, "row_key", "left_semi")
    named = found.join(ids, "row_key").join(tests.select("item_key", "item_id"), "item_key")
    return scratch.result(named.select("doc_id", "item_id", "kind", "hits", "first_word", "last_word"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without a match, columns unchanged; texts are matched once each by their 128-bit hash."""
    scratch = Scratch(docs.sparkSession)
    rows = keyed(docs, "row_key", scratch, F.col(text_col).alias("text"))
    tests = keyed(items, "item_key", scratch, F.col(item_text).alias("text"))
    found = scratch.table("found", search(store_index(rows, scratch), tests, scratch, **how))
    scratch.remove("index")
    bad = rows.join(found.select("row_key").distinct(), "row_key", "left_semi").select(*text_key(F.col("text"))).distinct()
    bad = scratch.table("bad", bad)
    scratch.only("bad")
    hash_a, hash_b = text_key(docs[text_col])
    return docs.join(bad, (hash_a == bad["hash_a"]) & (hash_b == bad["hash_b"]), "left_anti")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op3_decontaminate": op3_decontaminate}
SQL: dict[str, str] = {}
