"""Edit-aware token counts.

A text's tokens are counted by leaves of about ``LEAF`` characters, cut where the pre-tokeniser always has a boundary, so that
the leaves' counts add up to the text's. A segment tree over the leaves holds sums of characters and tokens. An edit replaces
a range of characters: the leaves that it touches, and neighbours as far as the pre-token boundary between them is no longer
sure, are joined, encoded anew and their sums updated up to the root; no other leaf is read.

Trees are kept: ``trees`` is a table with a row a document (its text, and characters and tokens of each leaf), ``edited`` takes
such a table and one of edits and gives the edited documents' new rows, encoding only what the edits touch. The query stores the
trees of all documents, makes a table of edits that redact mail addresses, IPv4 addresses, phone numbers and web addresses,
applies it to the stored trees and returns the counts before and after.

Contract: one row a document (doc_id, n_tokens, n_edits, n_tokens_after, n_encoded), the last being the characters that the edits had
encoded anew. Edits of a text are given in places of the original, in any order; of overlapping ones the first is made, of those
that begin together the longest; places behind the end are the end, a null new text is an empty one. Edits of no document are
ignored. A null text counts as an empty one. Repeated rows each get a row; null ids are carried. An empty table gives no rows.
Other columns don't matter, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import arrays, tokenizer
from textloom.llm.scratch import Scratch, keyed, sent

LEAF = 512
#: (needed character, pattern, replacement); each scan takes time in proportion to the text (mail names and labels have 64 characters at most).
RULES = (
    ("@", re.compile(r"[\w.+-]{1,64}@[\w-]{1,64}(?:\.[\w-]{1,64}){1,8}"), "<mail>"),
    ("://", re.compile(r"https?://[^\s<>\"]+"), "<web>"),
    (".", re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.])"), "<ip>"),
    ("-", re.compile(r"(?<![\d-])\d{3}-\d{3,4}-\d{4}(?![\d-])"), "<phone>"),
)


class Tree:
    """Leaves of a text and sums over them; ``chars[1]`` and ``tokens[1]`` are the whole text's."""

    def __init__(self, text: str, vocabulary: str = tokenizer.VOCABULARY, counts: list[int] | None = None, leaf: int = LEAF, leaves: list[str] | None = None):
        self.vocabulary, self.leaf, self.encoded = vocabulary, leaf, 0
        self.leaves = tokenizer.blocks(text, leaf) if leaves is None else leaves
        self.size = 1 << max(0, len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        if counts is None:
            counts = [tokenizer.count(x, vocabulary) for x in self.leaves]
        self.chars[self.size : self.size + len(self.leaves)] = map(len, self.leaves)
        self.tokens[self.size : self.size + len(self.leaves)] = counts
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @classmethod
    def stored(cls, text: str, chars: list[int], tokens: list[int], vocabulary: str = tokenizer.VOCABULARY, leaf: int = LEAF) -> "Tree":
        """A tree as it was kept: the text, and characters and tokens of each leaf."""
        ends = [0, *accumulate(chars)]
        return cls(text, vocabulary, tokens, leaf, [text[a:b] for a, b in zip(ends, ends[1:])])

    def counts(self) -> list[int]:
        """Tokens of each leaf."""
        return self.tokens[self.size : self.size + len(self.leaves)]

    def lengths(self) -> list[int]:
        """Characters of each leaf."""
        return self.chars[self.size : self.size + len(self.leaves)]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.leaves)

    def locate(self, at: int) -> tuple[int, int]:
        """Leaf that holds character ``at`` and the characters before that leaf; the last leaf with text for the end."""
        i, before = 1, 0
        at = min(at, max(0, self.chars[1] - 1))
        while i < self.size:
            i *= 2
            if at - before >= self.chars[i]:
                before += self.chars[i]
                i += 1
        return min(i - self.size, len(self.leaves) - 1), before

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        i = leaf + self.size
        self.leaves[leaf] = text
        more, gain = len(text) - self.chars[i], tokens - self.tokens[i]
        while i:
            self.chars[i] += more
            self.tokens[i] += gain
            i //= 2

    def _neighbour(self, leaf: int, step: int) -> int:
        leaf += step
        while 0 <= leaf < len(self.leaves) and not self.leaves[leaf]:
            leaf += step
        return leaf if 0 <= leaf < len(self.leaves) else -1

    @staticmethod
    def _sure(left: str, right: str) -> bool:
        """Whether a token boundary is sure between two texts: before a single space between characters that aren't space."""
        return not left[-1].isspace() and right[0] == " " and len(right) > 1 and not right[1].isspace()

    def edit(self, start: int, end: int, new: str) -> None:
        """Replaces the characters from ``start`` to ``end`` (excluded), in places of the present text."""
        lo, before = self.locate(start)
        hi, _ = self.locate(max(start, end - 1))
        while start == before and self._neighbour(lo, -1) >= 0:  # the place before the edit's first character is context
            lo = self._neighbour(lo, -1)
            before -= len(self.leaves[lo])
        text = "".join(self.leaves[lo : hi + 1])
        text = text[: start - before] + new + text[end - before :]
        while (k := self._neighbour(hi, 1)) >= 0 and not (text and self._sure(text, self.leaves[k])):
            text, hi = text + self.leaves[k], k
        while (k := self._neighbour(lo, -1)) >= 0 and not (text and self._sure(self.leaves[k], text)):
            text, lo = self.leaves[k] + text, k
        parts = tokenizer.blocks(text, self.leaf)
        room = hi - lo + 1
        if len(parts) > room:
            parts = [*parts[: room - 1], "".join(parts[room - 1 :])]
        parts += [""] * (room - len(parts))
        for k, part in enumerate(parts):
            if part != self.leaves[lo + k]:
                self.encoded += len(part)
                self._set(lo + k, part, tokenizer.count(part, self.vocabulary) if part else 0)


def apart(edits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Edits in order, without those that overlap one before."""
    out, at = [], 0
    for start, end, new in sorted(edits, key=lambda e: (e[0], -e[1])):
        if start >= at:
            out.append((start, end, new))
            at = max(end, start)
    return out


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Edits (start, end, new) of a text, ordered and apart."""
    return apart([(m.start(), m.end(), new) for need, pattern, new in RULES if need in text for m in pattern.finditer(text)])


TREES = "row_key long, doc_id long, text string, leaf_chars array<int>, leaf_tokens array<int>"
EDITED = f"{TREES}, n_tokens long, n_edits long, n_encoded long"
#: Bytes of edits up to which they are sent to the scan of the stored trees; more are joined by a shuffle.
SENT_BYTES = 64 << 20


def _plant(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    ints = pa.list_(pa.int32())
    for b in arrays.slices(batches, "text"):
        made = [Tree(t or "", vocabulary) for t in b["text"].to_pylist()]
        cols = [b["row_key"], b["doc_id"], b["text"], pa.array([t.lengths() for t in made], ints), pa.array([t.counts() for t in made], ints)]
        yield pa.record_batch(cols, ["row_key", "doc_id", "text", "leaf_chars", "leaf_tokens"])


def trees(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = tokenizer.VOCABULARY) -> DataFrame:
    """A stored tree of every document."""
    rows = keyed(docs, "row_key", scratch, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return scratch.table("trees", rows.mapInArrow(lambda it: _plant(it, vocabulary), TREES))


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in arrays.slices(batches, "text"):
        found = [(k, *e) for k, t in zip(b["row_key"].to_pylist(), b["text"].to_pylist()) if t for e in redactions(t)]
        if found:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int32(), pa.int32(), pa.string()))], ["row_key", "start", "end", "new"])


def redaction_edits(stored: DataFrame, scratch: Scratch) -> DataFrame:
    """A stored table of edits (row_key, start, end, new)."""
    return scratch.table("edits", stored.select("row_key", "text").mapInArrow(_redact, "row_key long, start int, end int, new string"))


def _edit(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    ints, names = pa.list_(pa.int32()), [x.split()[0] for x in EDITED.split(", ")]
    for b in arrays.slices(batches, "text"):
        out = []
        for row in b.to_pylist():
            tree = Tree.stored(row["text"] or "", row["leaf_chars"], row["leaf_tokens"], vocabulary)
            before, size = tree.total, tree.chars[1]
            edits = apart([(max(0, min(e["start"], size)), max(0, min(e["end"], size)), e["new"] or "") for e in row["edits"]])
            for start, end, new in reversed(edits):  # from the end, so that places stay those of the original
                tree.edit(start, max(start, end), new)
            out.append((row["row_key"], row["doc_id"], tree.text(), tree.lengths(), tree.counts(), before, len(edits), tree.encoded))
        kinds = (pa.int64(), pa.int64(), pa.string(), ints, ints, pa.int64(), pa.int64(), pa.int64())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)


def edited(stored: DataFrame, edits: DataFrame, vocabulary: str = tokenizer.VOCABULARY) -> DataFrame:
    """The new trees of the documents with edits, with the tokens before, the number of edits and the characters encoded anew."""
    per_text = edits.filter("start IS NOT NULL AND end IS NOT NULL").groupBy(F.col("row_key").alias("edit_key")).agg(F.collect_list(F.struct("start", "end", "new")).alias("edits"))
    size = edits.agg(F.coalesce(F.sum(F.octet_length("new") + 32), F.lit(0))).first()[0]
    per_text = F.broadcast(per_text) if size <= SENT_BYTES else per_text
    both = stored.join(per_text, stored["row_key"] == per_text["edit_key"]).drop("edit_key")
    return both.mapInArrow(lambda it: _edit(it, vocabulary), EDITED)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = tokenizer.VOCABULARY, edits: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_edits, n_tokens_after, n_encoded) of every document; checkpointed.

    ``edits`` has (doc_id, start, end, new), for every row with that id; without it the redactions are made.
    """
    scratch = Scratch(docs.sparkSession)
    stored = trees(docs, scratch, id_col, text_col, vocabulary)
    if edits is None:
        made = redaction_edits(stored, scratch)
    else:
        given = edits.select(F.col("doc_id").alias("edit_id"), "start", "end", "new")
        made = scratch.table("edits", stored.select("row_key", "doc_id").join(given, F.col("doc_id") == F.col("edit_id")).select("row_key", "start", "end", "new"))
    total = F.aggregate("leaf_tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    new = scratch.table("new", edited(stored, made, vocabulary).select("row_key", "n_tokens", "n_edits", total.alias("n_tokens_after"), "n_encoded"))
    new = sent(new)
    old = stored.select("row_key", "doc_id", total.alias("before"))
    both = old.join(new, "row_key", "left")
    return scratch.result(
        both.select("doc_id", F.col("before").alias("n_tokens"), *[F.coalesce(c, F.lit(d).cast("long") if isinstance(d, int) else F.col(d)).alias(c) for c, d in (("n_edits", 0), ("n_tokens_after", "before"), ("n_encoded", 0))])
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op7_token_counts": op7_token_counts}
SQL: dict[str, str] = {}
