"""Best-fit packing by exact-complement hashing.

A document's tokens fill whole bins of ``capacity``; its remainder is packed with others. The plan is made on the histogram
of lengths (at most ``capacity`` numbers, whatever the corpus): from the longest length down, sums of one, two and three
lengths that exactly complement it are looked up and consumed under their availability counts; what is left is packed
best-fit in decreasing length. Documents are then ranked within their length and take the slots planned for it.

Contract: one row a piece (doc_id, chunk, n_tokens, bin_id, bin_offset); pieces are numbered from 0 in text order, the
remainder last. A text without tokens (null or empty) takes no space: one row with chunk 0, n_tokens 0 and a null bin.
Repeated rows are packed each. Equal lengths take slots in the order of a hash of (doc_id, chunk), then of doc_id, nulls
first. An empty table gives no rows. Other columns of the input don't matter, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm import tokenizer
from textloom.llm.scratch import Scratch

CAPACITY = 2048
#: Rows of one length that are ranked together; a length with more rows is ranked in several ranges of the hash, in the same order.
RANK_ROWS = 1_000_000


@dataclass(frozen=True)
class Pattern:
    """``count`` bins that each hold ``items``: (length, how many)."""

    count: int
    items: tuple[tuple[int, int], ...]


def plan(lengths: dict[int, int], capacity: int) -> list[Pattern]:
    """Bins for so many pieces of each length; every piece is placed once.

    There are at most four patterns a length, whatever the counts: each complement uses up one length, and best-fit opens at
    most three patterns for one.
    """
    avail = np.zeros(capacity + 1, np.int64)
    for length, n in lengths.items():
        avail[length] += n
    out: list[Pattern] = []

    def take(*parts: int) -> None:
        need = {p: parts.count(p) for p in parts}
        n = min(int(avail[p]) // q for p, q in need.items())
        for p, q in need.items():
            avail[p] -= n * q
        out.append(Pattern(n, tuple(sorted(need.items(), reverse=True))))

    def fits(*parts: int) -> bool:
        return all(avail[p] >= parts.count(p) for p in parts)

    for first in range(capacity, 0, -1):
        gap = capacity - first
        if avail[first] and gap == 0:
            take(first)
        if avail[first] and gap and fits(first, gap):
            take(first, gap)
        if avail[first] and gap >= 2:
            a = np.arange(1, gap // 2 + 1)
            for x in a[(avail[a] > 0) & (avail[gap - a] > 0)][::-1].tolist():
                if fits(first, x, gap - x):
                    take(first, x, gap - x)
                if not avail[first]:
                    break
        if avail[first] and gap >= 3:
            for x in (np.flatnonzero(avail[1 : gap // 3 + 1]) + 1)[::-1].tolist():
                b = np.arange(x, (gap - x) // 2 + 1)
                for y in b[(avail[b] > 0) & (avail[gap - x - b] > 0)][::-1].tolist():
                    if fits(first, x, y, gap - x - y):
                        take(first, x, y, gap - x - y)
                    if not avail[first]:
                        break
                if not avail[first]:
                    break
    by_gap: dict[int, list[tuple[int, dict[int, int]]]] = {}
    for length in range(capacity, 0, -1):
        left = int(avail[length])
        while left:
            gaps = sorted(g for g in by_gap if g >= length)
            if gaps:
                gap, each = gaps[0], gaps[0] // length
                n, items = by_gap[gap].pop()
                if not by_gap[gap]:
                    del by_gap[gap]
            else:
                gap, each, items = capacity, capacity // length, {}
                n = max(1, left // each)
            full = min(n, left // each)
            parts = [(full, each), (1, left - full * each)] if full < n and left > full * each else [(full, each)]
            used = 0
            for m, q in parts:
                if m and q:
                    by_gap.setdefault(gap - q * length, []).append((m, {**items, length: q}))
                    left -= m * q
                    used += m
            if n > used and items:
                by_gap.setdefault(gap, []).append((n - used, items))
    for gap in sorted(by_gap):
        out += [Pattern(n, tuple(items.items())) for n, items in by_gap[gap]]
    return out


def slots(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first bin, how many a bin, offset): ranks of a length take bins in turn."""
    out, used, base = [], {}, 0
    for p in patterns:
        offset = 0
        for length, q in p.items:
            start = used.get(length, 0)
            used[length] = start + p.count * q
            out.append((length, start, used[length], base, q, offset))
            offset += q * length
        base += p.count
    return out


def pack(docs: DataFrame, lengths: Column, id_col: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Packs the rows of ``docs``, ``lengths`` being their token counts (null counts as 0); checkpointed."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    sized = scratch.table("sized", docs.select(F.col(id_col).alias("doc_id"), F.coalesce(lengths.cast("long"), F.lit(0)).alias("n")))
    cut = F.when(F.col("n") <= 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), ((F.col("n") - 1) / capacity).cast("int")))
    pieces = sized.select("doc_id", F.explode(cut).alias("chunk"), "n").select(
        "doc_id", "chunk", F.greatest(F.lit(0), F.least(F.lit(capacity), F.col("n") - F.col("chunk").cast("long") * capacity)).cast("int").alias("n_tokens")
    )
    filled = F.col("n_tokens") > 0
    counts = {r["n_tokens"]: r["count"] for r in pieces.filter(filled).groupBy("n_tokens").count().collect()}
    where = T.StructType([T.StructField(c, T.LongType()) for c in ("n_tokens", "from_rank", "to_rank", "first_bin", "each", "at")])
    table = spark.createDataFrame(slots(plan(counts, capacity)), where)
    buckets = max(1, -(-max(counts.values(), default=1) // RANK_ROWS))
    mark = F.xxhash64("doc_id", "chunk")
    ranked = pieces.filter(filled).withColumn("mark", mark).withColumn("bucket", F.floor((F.col("mark") / 2.0**64 + 0.5) * buckets))
    within = Window.partitionBy("n_tokens", "bucket").orderBy("mark", "doc_id", "chunk")
    ranked = ranked.withColumn("rank", F.row_number().over(within) - F.lit(1).cast("long"))
    if buckets > 1:
        sums = ranked.groupBy("n_tokens", "bucket").count()
        before = Window.partitionBy("n_tokens").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("n_tokens", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("skip"))
        ranked = ranked.join(sums, ["n_tokens", "bucket"]).withColumn("rank", F.col("rank") + F.col("skip"))
    table = F.broadcast(table.withColumnRenamed("n_tokens", "slot_tokens"))  # bounded by the capacity, see plan()
    hit = ranked.join(table, (F.col("n_tokens") == F.col("slot_tokens")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")))
    nth = F.col("rank") - F.col("from_rank")
    placed = hit.select(
        "doc_id", "chunk", "n_tokens", (F.col("first_bin") + F.floor(nth / F.col("each"))).alias("bin_id"), (F.col("at") + F.pmod(nth, F.col("each")) * F.col("n_tokens")).alias("bin_offset")
    )
    none = F.lit(None).cast("long")
    return scratch.result(placed.unionByName(pieces.filter(~filled).select("doc_id", "chunk", "n_tokens", none.alias("bin_id"), none.alias("bin_offset"))))


def token_count(text: Column, vocabulary: str = tokenizer.VOCABULARY) -> Column:
    """Byte-pair tokens of a text; null for null."""

    @F.arrow_udf("long")
    def count(arr: pa.Array) -> pa.Array:
        return pa.array(tokenizer.counts(arr, vocabulary), pa.int64())

    return count(text)


def pack_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str = tokenizer.VOCABULARY) -> DataFrame:
    """Packs texts by their byte-pair tokens and one end-of-text token each; a text without tokens takes none."""
    n = token_count(F.col(text_col), vocabulary)
    return pack(docs.select(F.col(id_col).alias("doc_id"), n.alias("n_text")), F.when(F.col("n_text") > 0, F.col("n_text") + 1), capacity=capacity)


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op10_pack": op10_pack}
SQL: dict[str, str] = {}
