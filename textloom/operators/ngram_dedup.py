"""N-gram deduplication by first occurrences.

The sequential rule "a unit goes if more than ``threshold`` of its n-grams were inserted by units before it" becomes an exchange of
arrays: each task hashes n-grams of up to ``CHUNK`` at a time, settles those that an earlier unit of the same chunk has, and
sends one posting of each other n-gram to the n-gram's part; the part tells which have an earlier unit elsewhere, and the counts
meet again by unit. In one round every earlier unit counts. Of the sequential result that gives most: what stays then stays
anyway, what goes by n-grams of such units alone goes. Only units between the two (``_settled``) send their n-grams once more,
and bounds from both sides close in on them, round by round, until none is open. Units are ordered by (id, unit number); ids are
integers.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.lineage import cut
from textloom.functions.ngrams import grams_of, joined, mix, pack, small, unpack
from textloom.registry import fresh, step

_WORD = re.compile(r"[^\W_]+|[^\w\s]|_")
#: N-grams of a list that are sent to the workers; a longer list is joined by a shuffle.
SENT_GRAMS = 1_000_000
#: Units of a stored table up to which it is sent to the texts; the texts are shuffled to a longer one.
SENT_UNITS = 1_000_000
#: N-grams that a task looks at together, and characters of text for each part of the n-grams.
CHUNK, PART_CHARS = 1 << 20, 1 << 24
#: Bits of the table of n-grams of open units, and their n-grams up to which it is made.
TABLE_BITS, TABLE_GRAMS = 28, 1 << 26
BLOBS = "part int, judged boolean, data binary"
GRAMS = "id long, at int, k int, gram long, total int, doc_total int"


def _named(df: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"), *more).filter("id IS NOT NULL AND text IS NOT NULL")


def _grams(df: DataFrame, mode: str, low: int, high: int, id_col: str = "doc_id", text_col: str = "text", only: np.ndarray | None = None) -> DataFrame:
    """(id, at, k, gram, total, doc_total): n-grams of each unit with their place, and the numbers of n-grams of unit and text.

    ``only``: sorted n-grams, of which others are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, at, total, whole, unit, place, gram in grams_of(batches, mode == "paragraph", low, high):
            gram = gram.view(np.int64)
            if only is not None:
                keep = only[np.minimum(np.searchsorted(only, gram), len(only) - 1)] == gram if len(only) else np.zeros(len(gram), bool)
                unit, place, gram = unit[keep], place[keep], gram[keep]
            for lo in range(0, len(gram), 1 << 17):
                u, here = unit[lo : lo + (1 << 17)], slice(lo, lo + (1 << 17))
                yield pa.record_batch([pa.array(c) for c in (ids[u], at[u], place[here], gram[here], total[u].astype(np.int32), whole[u].astype(np.int32))], ["id", "at", "k", "gram", "total", "doc_total"])

    return _named(df, id_col, text_col).mapInArrow(run, GRAMS)


def _by_id(units: DataFrame, *cols: Column) -> DataFrame:
    """A stored table of units by id, to be sent if it is small."""
    out = units.groupBy("id").agg(*cols)
    return F.broadcast(out) if units.count() <= SENT_UNITS else out


def _parts(df: DataFrame, text_col: str) -> int:
    """Parts of the n-grams: in proportion to the characters."""
    return 1 + (df.agg(F.sum(F.length(f"`{text_col}`").cast("long"))).first()[0] or 0) // PART_CHARS


def _order(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each unit's rank by (id, at); equal ones have the same."""
    by = np.lexsort((at, ids))
    new = np.ones(len(by), bool)
    new[1:] = (ids[by[1:]] != ids[by[:-1]]) | (at[by[1:]] != at[by[:-1]])
    rank = np.empty(len(by), np.int64)
    rank[by] = np.cumsum(new) - 1
    return rank


def _runs(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal sorted keys."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of ``n``."""
    by = np.argsort(key, kind="stable")
    at = _runs(key[by])
    return key[by][at], np.add.reduceat(n[by], at) if len(at) else n[:0]


def _chunks(batches: Iterator[pa.RecordBatch], by_line: bool, low: int, high: int, most: int, marks: Callable | None = None) -> Iterator[tuple]:
    """(units, unit, place, gram) of about ``most`` n-grams: units that have some as ids, numbers, n-grams, n-grams of the text and marks."""
    seen: list[pa.RecordBatch] = []

    def noted() -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen[:] = [b]
            yield b

    held, size = [], 0

    def whole() -> tuple:
        first = np.cumsum([0, *(len(x[0][0]) for x in held)])
        return [np.concatenate(c) for c in zip(*(x[0] for x in held))], np.concatenate([x[1] + f for x, f in zip(held, first)]), np.concatenate([x[2] for x in held]), np.concatenate([x[3] for x in held])

    for row, ids, at, total, doc_total, unit, place, gram in grams_of(noted(), by_line, low, high):
        mark = marks(seen[0], row, at) if marks else np.zeros(len(ids), np.uint8)
        has = total > 0
        held.append(([c[has] for c in (ids, at, total, doc_total, mark)], (np.cumsum(has) - 1)[unit], place, gram))
        size += len(gram)
        if size >= most:
            yield whole()
            held, size = [], 0
    if size:
        yield whole()


def _cut_up(part: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(part, slice) of the runs of sorted parts."""
    at = _runs(part)
    yield from ((int(part[a]), slice(a, b)) for a, b in zip(at.tolist(), [*at[1:].tolist(), len(part)]))


def _blobs(rows: list[tuple[int, bool, bytes]]) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(rows), 256):
        part, judged, data = zip(*rows[lo : lo + 256])
        yield pa.record_batch([pa.array(part, pa.int32()), pa.array(judged), pa.array(data, pa.binary())], ["part", "judged", "data"])


def _by_gram(gram: np.ndarray, parts: int) -> np.ndarray:
    return ((gram >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _sent(units: list[np.ndarray], gram: np.ndarray, unit: np.ndarray, more: list[np.ndarray], parts: int) -> list[tuple[int, bool, bytes]]:
    """Postings sorted by n-gram, for the parts of the n-grams."""
    rows = []
    for p, here in _cut_up(_by_gram(gram, parts)):
        used, index = np.unique(unit[here], return_inverse=True)
        rows.append((p, False, pack(np.diff(gram[here], prepend=np.uint64(0)), small(index), *(small(m[here]) for m in more), *(c[used] for c in units))))
    return rows


def _judged(ids: np.ndarray, cols: list[np.ndarray], parts: int) -> list[tuple[int, bool, bytes]]:
    """Rows of what is known of units, for the parts of their ids."""
    part = (mix(ids.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
    by = np.argsort(part, kind="stable")
    return [(p, True, pack(ids[by[here]], *(c[by[here]] for c in cols))) for p, here in _cut_up(part[by])]


def _received(table: pa.Table, more: int) -> tuple[np.ndarray, ...]:
    """N-gram, index of the unit and ``more`` columns of the postings of a part, and the columns of the units."""
    got = [unpack(x) for x in table["data"].to_pylist()]
    first = np.cumsum([0, *(len(r[-1]) for r in got)])
    gram = np.concatenate([np.cumsum(r[0]) for r in got])
    unit = np.concatenate([r[1].astype(np.int64) + f for r, f in zip(got, first)])
    return gram, unit, [joined(got, 2 + k) for k in range(more)], [np.concatenate([r[k] for r in got]) for k in range(2 + more, len(got[0]))]


def _firsts(gram: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the postings by n-gram, and the least rank that has the n-gram of each, in that order."""
    by = np.argsort(gram)
    at = _runs(gram[by])
    return by, np.repeat(np.minimum.reduceat(rank[by], at) if len(at) else rank[:0], np.diff(at, append=len(by)))


def _exchange(df: DataFrame, by_line: bool, low: int, high: int, parts: int, id_col: str, text_col: str, edges: bool, places: bool = False) -> DataFrame:
    """Packed rows by part of the units' ids: units with n-grams that an earlier one has. Each with its n-grams, those of the text
    and the number seen, by earlier unit with ``edges``; with ``places`` (id, place) instead."""
    most = CHUNK

    def found(cols: list[np.ndarray], rank: np.ndarray, unit: np.ndarray, first: np.ndarray, n: np.ndarray) -> list[tuple[int, bool, bytes]]:
        """``unit``: indices; ``first``: ranks, which come before."""
        if places:
            return _judged(cols[0][unit], [n.astype(np.int32)], parts)
        of = np.empty(int(rank.max(initial=-1)) + 1, np.int64)
        of[rank] = np.arange(len(rank))
        key, n = _summed(rank[unit] * len(of) + (first if edges else 0), n)
        u, f = of[key // max(1, len(of))], of[key % max(1, len(of))] if len(of) else key
        return _judged(cols[0][u], [cols[1][u], small(cols[2][u]), small(cols[3][u]), small(n), *([cols[0][f], cols[1][f]] if edges else [])], parts)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, unit, place, gram in _chunks(batches, by_line, low, high, most):
            cols = cols[:4]
            rank = _order(cols[0], cols[1])
            by, first = _firsts(gram, rank[unit])
            unit, gram = unit[by], gram[by]
            late = rank[unit] > first
            more = place[by] if places else np.ones(len(by), np.int64)
            yield from _blobs(found(cols, rank, unit[late], first[late], more[late]))
            unit, gram, more = unit[~late], gram[~late], more[~late]
            if not places and len(gram):  # one posting for each n-gram, with the times it occurs
                at = _runs(gram)
                unit, gram, more = unit[at], gram[at], np.add.reduceat(more, at)
            yield from _blobs(_sent(cols[:1] if places else cols, gram, unit, [more], parts))

    def met(table: pa.Table) -> pa.Table:
        mine = table["judged"].to_numpy(zero_copy_only=False)
        out = [(int(p), True, d) for p, d in zip(table["part"].filter(mine).to_pylist(), table["data"].filter(mine).to_pylist())]
        if not mine.all():
            gram, unit, (more,), cols = _received(table.filter(~mine), 1)
            rank = _order(cols[0], np.zeros(len(cols[0]), np.int32) if places else cols[1])
            by, first = _firsts(gram, rank[unit])
            unit, more = unit[by], more[by]
            late = rank[unit] > first
            out += found(cols, rank, unit[late], first[late], more[late])
        return pa.Table.from_batches(_blobs(out), BLOB_SCHEMA)

    return _named(df, id_col, text_col).mapInArrow(hashed, BLOBS).groupBy("part").applyInArrow(met, BLOBS)


BLOB_SCHEMA = pa.schema([("part", pa.int32()), ("judged", pa.bool_()), ("data", pa.binary())])
UNITS = "id long, at int, total long, doc_total long, seen long, firsts array<struct<id:long,at:int,n:long>>"


def _counts(blobs: DataFrame, edges: bool, gone: Callable) -> DataFrame:
    """``UNITS``: a row for each unit, with the earlier units that it shares n-grams with if it goes and ``edges`` are wanted."""

    def run(table: pa.Table) -> pa.Table:
        got = [unpack(x) for x in table["data"].to_pylist()]
        ids, at, total, doc_total, n = (joined(got, k, np.int32 if k == 1 else np.int64) for k in range(5))
        rank = _order(ids, at)
        by = np.argsort(rank, kind="stable")
        start = _runs(rank[by])
        one = by[start]
        seen = np.add.reduceat(n[by], start)
        cols = [pa.array(ids[one]), pa.array(at[one]), pa.array(total[one]), pa.array(doc_total[one]), pa.array(seen)]
        if edges:
            goes = gone(seen, total[one])
            keep = by[np.repeat(goes, np.diff(start, append=len(by)))]
            size = np.where(goes, np.diff(start, append=len(by)), 0)
            values = pa.StructArray.from_arrays([pa.array(joined(got, 5)[keep]), pa.array(joined(got, 6, np.int32)[keep]), pa.array(n[keep])], ["id", "at", "n"])
            cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), values))
        else:
            cols.append(pa.nulls(len(one), pa.list_(pa.struct([("id", pa.int64()), ("at", pa.int32()), ("n", pa.int64())]))))
        return pa.table(cols, ["id", "at", "total", "doc_total", "seen", "firsts"])

    return blobs.groupBy("part").applyInArrow(run, UNITS)


INSERTS, ASKS = 1, 2
ASKED = "gram long, id long, at int, total long, n long"


def _asked(df: DataFrame, marks: DataFrame, by_line: bool, low: int, high: int, parts: int, id_col: str, text_col: str, count: bool, only: np.ndarray | None = None) -> DataFrame:
    """``ASKED``, of units that ``marks`` (id, at, mark) lets ask: without n-gram the number of those that a unit which inserts has
    before; unless ``count`` is set, also the others that another unit which asks has, by n-gram. Units without a mark insert.

    ``only``: a table of bits without which no n-gram is asked for.
    """
    most = CHUNK
    by_id = _by_id(marks, F.collect_list(F.struct("at", "mark")).alias("marks"))
    given = _named(df, id_col, text_col).join(by_id, "id", "left").select("id", "text", F.col("marks.at").alias("mark_at"), F.col("marks.mark").alias("mark"))

    def marked(b: pa.RecordBatch, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.full(len(row), INSERTS, np.uint8)
        mine = b["mark_at"].slice(int(row[0]), int(row[-1] - row[0]) + 1), b["mark"].slice(int(row[0]), int(row[-1] - row[0]) + 1)
        begin = np.searchsorted(row, np.arange(row[0], row[-1] + 2))
        for k, (ats, ms) in enumerate(zip(*(m.to_pylist() for m in mine))):
            if ats:
                out[begin[k] + np.array(ats)] = ms
        return out

    def rows(gram, cols, u, n) -> pa.RecordBatch:
        grams = pa.nulls(len(u), pa.int64()) if gram is None else pa.array(gram.view(np.int64))
        return pa.record_batch([grams, pa.array(cols[0][u]), pa.array(cols[1][u].astype(np.int32)), pa.array(cols[2][u].astype(np.int64)), pa.array(n.astype(np.int64))], ["gram", "id", "at", "total", "n"])

    def least(gram: np.ndarray, rank: np.ndarray, inserts: np.ndarray) -> np.ndarray:
        """Of sorted n-grams, the least rank of a unit that inserts."""
        at = _runs(gram)
        return np.repeat(np.minimum.reduceat(np.where(inserts, rank, np.iinfo(np.int64).max), at), np.diff(at, append=len(gram))) if len(at) else rank

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, unit, _, gram in _chunks(batches, by_line, low, high, most, marked):
            mark = cols[4][unit]
            use = mark > 0
            if only is not None:
                use &= (only[(gram >> np.uint64(67 - TABLE_BITS)).astype(np.int64)] >> ((gram >> np.uint64(64 - TABLE_BITS)) & np.uint64(7)).astype(np.uint8) & 1) > 0
            unit, gram, mark = unit[use], gram[use], mark[use]
            rank = _order(cols[0], cols[1])
            by = np.lexsort((rank[unit], gram))
            unit, gram, mark = unit[by], gram[by], mark[by]
            one = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (rank[unit[1:]] != rank[unit[:-1]])])) if len(gram) else np.zeros(0, np.int64)
            n = np.diff(one, append=len(gram))
            unit, gram, mark = unit[one], gram[one], mark[one]
            first = least(gram, rank[unit], mark & INSERTS > 0)
            asks, known = mark & ASKS > 0, rank[unit] > first
            key, sure = _summed(unit[asks & known], n[asks & known])
            yield from _blobs(_judged(cols[0][key], [cols[1][key], small(cols[2][key]), small(sure)], parts))
            send = (asks & ~known) | (rank[unit] == first)
            asks = asks & ~known
            kind = asks * ASKS + (rank[unit] == first) * INSERTS
            yield from _blobs(_sent(cols[:3], gram[send], unit[send], [n[send], kind[send]], parts))

    def met(table: pa.Table) -> pa.Table:
        mine = table["judged"].to_numpy(zero_copy_only=False)
        out = []
        for x in table["data"].filter(mine).to_pylist():
            *cols, sure = unpack(x)
            out.append(rows(None, cols, np.arange(len(sure)), sure))
        if not mine.all():
            gram, unit, (n, kind), cols = _received(table.filter(~mine), 2)
            by = np.argsort(gram)
            gram, unit, n, kind = gram[by], unit[by], n[by], kind[by]
            rank = _order(cols[0], cols[1])[unit]
            first = least(gram, rank, kind & INSERTS > 0)
            asks, known = kind & ASKS > 0, rank > first
            key, sure = _summed(unit[asks & known], n[asks & known])
            out.append(rows(None, cols, key, sure))
            if not count:
                left = asks & ~known
                gram, unit, n = gram[left], unit[left], n[left]
                at = _runs(gram)
                size = np.diff(at, append=len(gram))
                several = np.repeat(size > 1, size)  # an n-gram of one unit alone is seen by none
                out.append(rows(gram[several], cols, unit[several], n[several]))
        return pa.Table.from_batches(out)

    return given.mapInArrow(hashed, BLOBS).groupBy("part").applyInArrow(met, ASKED)


def _table(df: DataFrame, open_: DataFrame, by_line: bool, low: int, high: int, id_col: str, text_col: str) -> np.ndarray | None:
    """Bits, by their first bits, of the n-grams of open units, unless these are too many."""
    if (open_.agg(F.sum("total")).first()[0] or 0) > TABLE_GRAMS:
        return None
    ids = open_.select(F.col("id").alias("open_id")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *_, gram in grams_of(batches, by_line, low, high):
            yield from _blobs([(0, False, pack(np.diff(np.unique(gram >> np.uint64(64 - TABLE_BITS)).astype(np.uint32), prepend=np.uint32(0))))])

    out = np.zeros(1 << (TABLE_BITS - 3), np.uint8)
    for r in _named(df, id_col, text_col).join(ids, F.col("id") == F.col("open_id"), "left_semi").mapInArrow(run, BLOBS).select("data").toLocalIterator():
        bits = np.cumsum(unpack(bytes(r[0]))[0], dtype=np.int64)
        np.bitwise_or.at(out, bits >> 3, np.uint8(1) << (bits & 7).astype(np.uint8))
    return out


def _settled(asked: DataFrame, open_: DataFrame, goes: Callable[[Column, Column], Column], rounds: int | None) -> DataFrame:
    """(id, at) of the open units (id, at, total) that go. Each round judges by the units that stay for sure and by all that may
    stay; the first open unit is always settled."""
    unit = ("id", "at")
    sure = asked.filter("gram IS NULL").groupBy(*unit).agg(F.sum("n").alias("base"))
    state = cut(open_.select(*unit, "total").join(sure, [*unit], "left").select(*unit, "total", F.coalesce("base", F.lit(0)).alias("base"), F.lit(None).cast("boolean").alias("gone")))
    rows, turn = asked.filter("gram IS NOT NULL").select("gram", *unit, "n"), 1
    while (rounds is None or turn < rounds) and state.filter("gone IS NULL").limit(1).count():
        alive = rows.join(state.filter("gone IS NULL OR NOT gone").select(*unit, F.col("gone").isNotNull().alias("stays")), [*unit])
        place = F.struct(*unit)
        least = alive.groupBy("gram").agg(F.min(place).alias("may"), F.min(F.when(F.col("stays"), place)).alias("must"))
        both = alive.filter("NOT stays").join(least, "gram").withColumn("place", place)
        n = lambda c: F.sum(F.when(F.col(c) < F.col("place"), F.col("n")).otherwise(0))
        now = state.join(both.groupBy(*unit).agg(n("must").alias("least"), n("may").alias("most")), [*unit], "left")
        low, high = (F.col("base") + F.coalesce(c, F.lit(0)) for c in ("least", "most"))
        judged = F.when(F.col("gone").isNotNull(), F.col("gone")).when(goes(low, F.col("total")), True).when(~goes(high, F.col("total")), False)
        state, turn = cut(now.select(*unit, "total", "base", judged.alias("gone"))), turn + 1
    return state.filter("gone").select(*unit)


def unit_shares(df: DataFrame, mode: str, low: int, high: int, threshold: float, rounds: int | None = None, strict: bool = True, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """(id, at, total, doc_total, seen, gone) of every unit that shares n-grams with earlier ones; ``known`` is a table of n-grams
    that count as seen.

    ``rounds``: with 1 every earlier unit counts; beyond that it caps the rounds over open units, which stay if still open. In
    several rounds ``seen`` is an upper bound, exact with ``whole`` for texts of which it tells whether they go.
    """
    by_line = mode == "paragraph"

    def goes(seen, total):
        return seen / total > threshold if strict else seen / total >= threshold

    if known is not None:
        rows = _grams(df, mode, low, high, id_col, text_col).join(cut(known.select("gram").distinct()), "gram", "left_semi")
        out = rows.groupBy("id", "at", "total", "doc_total").agg(F.count("*").alias("seen"))
        return cut(out.withColumn("gone", goes(F.col("seen"), F.col("total"))))
    parts = _parts(df, text_col)
    how = dict(by_line=by_line, low=low, high=high, id_col=id_col, text_col=text_col)
    many = rounds != 1
    found = cut(_counts(_exchange(df, parts=parts, edges=many, **how), many, goes).withColumn("gone", goes(F.col("seen"), F.col("total"))))
    if not many:
        return found.drop("firsts")
    unit = ("id", "at")
    maybe = found.filter("gone")
    edges = maybe.select(*unit, "total", F.explode("firsts").alias("first")).select(*unit, "total", F.col("first.id").alias("first_id"), F.col("first.at").alias("first_at"), "first.n")
    others = maybe.select(F.col("id").alias("first_id"), F.col("at").alias("first_at"))
    sure = edges.join(others, ["first_id", "first_at"], "left_anti").groupBy(*unit).agg(F.sum("n").alias("sure"))
    maybe = cut(maybe.select(*unit, "total").join(sure, [*unit], "left").withColumn("gone", F.coalesce(goes(F.col("sure"), F.col("total")), F.lit(False))))
    open_, gone = maybe.filter("NOT gone"), maybe.filter("gone").select(*unit)
    if open_.limit(1).count():
        marks = maybe.select(*unit, F.when(F.col("gone"), 0).otherwise(ASKS).alias("mark"))
        asked = cut(_asked(df, marks, parts=parts, count=False, only=_table(df, open_, **how), **how))
        gone = gone.unionByName(_settled(asked, open_, goes, rounds))
    gone = gone.withColumn("gone", F.lit(True))
    out = found.select(*unit, "total", "doc_total", "seen").join(gone, [*unit], "left").withColumn("gone", F.coalesce("gone", F.lit(False)))
    if not whole:
        return cut(out)
    out = cut(out)
    texts = out.groupBy("id").agg(F.sum("seen").alias("most"), F.max("doc_total").alias("of")).filter(goes(F.col("most"), F.col("of"))).select("id")
    asks = out.join(texts, "id", "left_semi").select(*unit, F.when(F.col("gone"), ASKS).otherwise(INSERTS | ASKS).alias("mark"))
    marks = asks.unionByName(out.filter("gone").join(texts, "id", "left_anti").select(*unit, F.lit(0).alias("mark")))
    seen = _asked(df, marks, parts=parts, count=True, **how).groupBy(*unit).agg(F.sum("n").alias("exact"))
    exact = asks.select(*unit).join(seen, [*unit], "left").select(*unit, F.coalesce("exact", F.lit(0)).alias("exact"))
    return cut(out.join(exact, [*unit], "left").withColumn("seen", F.coalesce("exact", "seen")).drop("exact"))


def _rebuild(df: DataFrame, units: DataFrame, id_col: str, text_col: str, annotate: bool) -> DataFrame:
    """``df`` without units (id, at), and without the texts of which a unit is null; or with the numbers of the units."""
    key, cuts, bad = fresh(df, "gone_id"), fresh(df, "gone_units"), fresh(df, "gone_text")
    by_id = _by_id(units, F.array_sort(F.collect_list("at")).alias(cuts), F.max(F.col("at").isNull()).alias(bad)).withColumnRenamed("id", key)
    out = df.join(by_id, F.col(f"`{id_col}`") == F.col(key), "left").filter(~F.coalesce(F.col(bad), F.lit(False))).drop(key, bad)
    if annotate:
        return out.withColumnRenamed(cuts, "duplicate_units")
    text = F.col(f"`{text_col}`")
    left = F.array_join(F.filter(F.split(text, r"(?=\n)"), lambda x, i: ~F.array_contains(cuts, i)), "")
    return out.withColumn(text_col, F.when(F.col(cuts).isNull(), text).otherwise(left)).drop(cuts).filter(F.col(f"`{text_col}`") != "")


def _without(df: DataFrame, bad: DataFrame, id_col: str, annotate: bool) -> DataFrame:
    """``df`` without the rows whose id is in ``bad``, or with a mark."""
    key, mark = fresh(df, "bad_id"), fresh(df, "bad")
    by_id = _by_id(bad, F.lit(True).alias(mark)).withColumnRenamed("id", key)
    if not annotate:
        return df.join(by_id, F.col(f"`{id_col}`") == F.col(key), "left_anti")
    out = df.join(by_id, F.col(f"`{id_col}`") == F.col(key), "left").drop(key)
    return out.withColumn("duplicate", F.coalesce(mark, F.lit(False))).drop(mark)


@step("global")
def ngram_dedup(df: DataFrame, text_col: str = "text", mode: str = "paragraph", min_ngram_size: int = 5, max_ngram_size: int = 13, threshold: float = 0.8, id_col: str = "doc_id", annotate_only: bool = False, rounds: int | None = None, known: DataFrame | None = None, shards: int = 1) -> DataFrame:
    """``mode``: exact, paragraph, document, both (paragraphs by the share of their own n-grams, and whole texts by the n-grams of
    the whole text, those across paragraphs too, at least the threshold), naive-both (texts, then paragraphs of the rest),
    old-both (paragraphs; a text whose share of its paragraphs' n-grams is over the threshold goes). Texts meet only within the
    shard, one of ``shards`` by a hash of the id, that they fall into."""
    if shards > 1:
        out = None
        for k in range(shards):
            part = ngram_dedup(df.filter(F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("long")), F.lit(shards)) == k), text_col, mode, min_ngram_size, max_ngram_size, threshold, id_col, annotate_only, rounds, known)
            out = part if out is None else out.unionByName(part)
        return out
    how = dict(low=min_ngram_size, high=max_ngram_size, threshold=threshold, rounds=rounds, known=known, id_col=id_col, text_col=text_col)
    if mode == "exact":
        key, first = fresh(df, "text_md5"), fresh(df, "first_id")
        firsts = df.groupBy(F.md5(text_col).alias(key)).agg(F.min(id_col).alias(first))
        out = df.join(firsts, F.md5(F.col(text_col)) == F.col(key)).withColumn("exact_duplicate", F.col(first) < F.col(id_col)).drop(key, first)
        return out if annotate_only else out.filter(~F.col("exact_duplicate")).drop("exact_duplicate")
    if mode == "naive-both":
        kept = ngram_dedup(df, text_col, "document", min_ngram_size, max_ngram_size, threshold, id_col, rounds=rounds, known=known)
        return ngram_dedup(kept, text_col, "paragraph", min_ngram_size, max_ngram_size, threshold, id_col, annotate_only, rounds, known)
    if mode == "document":
        return _without(df, unit_shares(df, "document", **how).filter("gone"), id_col, annotate_only)
    if mode not in ("paragraph", "both", "old-both"):
        raise ValueError(f"unknown mode {mode}")
    found = unit_shares(df, "paragraph", strict=mode != "both", whole=mode == "old-both", **how)
    gone = found.filter("gone").select("id", "at")
    if annotate_only or mode == "paragraph":
        return _rebuild(df, gone, id_col, text_col, annotate_only)
    if mode == "old-both":
        whole = found.groupBy("id").agg(F.sum("seen").alias("seen"), F.max("doc_total").alias("doc_total"))
        bad = whole.filter(F.col("seen") / F.col("doc_total") > threshold)
    else:
        bad = unit_shares(df, "document", strict=False, **how).filter("gone")
    return _rebuild(df, cut(gone.unionByName(bad.select("id", F.lit(None).cast("int").alias("at")))), id_col, text_col, False)


def merge_intervals(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open intervals."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def invert_intervals(spans: list[tuple[int, int]], end: int) -> list[tuple[int, int]]:
    """What merged ``spans`` leave of 0..end."""
    out, at = [], 0
    for a, b in spans:
        if a > at:
            out.append((at, a))
        at = b
    return out + ([(at, end)] if at < end else [])


def sandwich_intervals(spans: list[tuple[int, int]], share: float) -> list[tuple[int, int]]:
    """Joins neighbouring intervals while they make up at least ``share`` of what they span together."""
    out: list[list[int]] = []
    for a, b in merge_intervals(spans):
        if out and out[-1][2] + b - a >= share * (b - out[-1][0]):
            out[-1][1], out[-1][2] = b, out[-1][2] + b - a
        else:
            out.append([a, b, b - a])
    return [(a, b) for a, b, _ in out]


@step("global")
def substring_dedup(df: DataFrame, text_col: str = "text", ngram_size: int = 13, least_tokens: int = 50, share: float = 1.0, id_col: str = "doc_id", annotate_only: bool = False) -> DataFrame:
    """Cuts stretches of at least ``least_tokens`` words whose n-grams all (``share`` of them) stood in an earlier text."""
    spans_col, key = fresh(df, "seen_spans"), fresh(df, "seen_id")

    def gathered(table: pa.Table) -> pa.Table:
        """Merged stretches of each text; where all of the words count, only those that are long enough."""
        got = [unpack(x) for x in table["data"].to_pylist()]
        ids, at = joined(got, 0), joined(got, 1)
        by = np.lexsort((at, ids))
        ids, at = ids[by], at[by]
        new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (at[1:] - at[:-1] > ngram_size)])
        start = np.flatnonzero(new)
        a, b, ids = at[start], at[np.append(start[1:], len(at)) - 1] + ngram_size, ids[start]
        keep = (b - a >= least_tokens) | (share < 1)
        flat, ids = np.stack([a[keep], b[keep]], 1).reshape(-1), ids[keep]
        of = _runs(ids)
        return pa.table([pa.array(ids[of]), pa.ListArray.from_arrays(pa.array(2 * np.append(of, len(ids)).astype(np.int32)), pa.array(flat.astype(np.int32)))], [key, spans_col])

    blobs = _exchange(df, False, ngram_size, ngram_size, _parts(df, text_col), id_col, text_col, edges=False, places=True)
    seen = blobs.groupBy("part").applyInArrow(gathered, f"`{key}` long, `{spans_col}` array<int>")
    both = df.join(seen, F.col(f"`{id_col}`") == F.col(key), "left").drop(key)

    def spans(text: str, at) -> list[tuple[int, int]]:
        places = [m.span() for m in _WORD.finditer(text)]
        found = [(int(a), int(b)) for a, b in zip(at[::2], at[1::2])]
        found = sandwich_intervals(found, share) if share < 1 else found
        return [(places[a][0], places[min(b, len(places)) - 1][1]) for a, b in found if b - a >= least_tokens]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cuts = [spans(t, s) if s is not None and t is not None else [] for t, s in zip(pdf[text_col], pdf[spans_col])]
            pdf = pdf.drop(columns=spans_col)
            if annotate_only:
                pdf["duplicate_spans"] = [[list(c) for c in x] for x in cuts]
            else:
                pdf[text_col] = [t if not x else "".join(t[a:b] for a, b in invert_intervals(x, len(t))) for t, x in zip(pdf[text_col], cuts)]
                pdf = pdf[[not (x and not t.strip()) for t, x in zip(pdf[text_col], cuts)]]
            yield pdf

    schema = df.schema.add("duplicate_spans", "array<array<int>>") if annotate_only else df.schema
    return both.mapInPandas(run, schema)


def decontamination_overlap(docs: DataFrame, tests: DataFrame, ngram_size: int = 13, id_col: str = "doc_id", text_col: str = "text", test_text: str = "text") -> DataFrame:
    """(id, overlap) of documents that share n-grams with the tests.

    Up to ``SENT_GRAMS`` test n-grams go to the workers, which then emit no others; more are joined by a shuffle.
    """
    known = cut(_grams(tests.select(F.monotonically_increasing_id().alias("doc_id"), F.col(f"`{test_text}`").alias("text")), "document", ngram_size, ngram_size).select("gram").distinct())
    if known.count() <= SENT_GRAMS:
        only = np.sort(np.array([r[0] for r in known.collect()], np.int64))
        hit = _grams(docs, "document", ngram_size, ngram_size, id_col, text_col, only)
    else:
        hit = _grams(docs, "document", ngram_size, ngram_size, id_col, text_col).join(known, "gram", "left_semi")
    return hit.groupBy(F.col("id").alias(id_col)).agg(F.countDistinct("gram").alias("overlap"))


def bloom_size(n: int, fp_rate: float) -> tuple[int, int]:
    """(bits, hashers) of a filter for ``n`` items, by the closed form."""
    from math import ceil, log

    bits = ceil(-n * log(fp_rate) / log(2) ** 2) if n else 0
    return bits, max(1, round(bits / n * log(2))) if n else 1


def bloom_fp_rate(bits: int, hashers: int, n: int) -> float:
    return (1 - (1 - 1 / bits) ** (hashers * n)) ** hashers


def bloom_bytes(n: int, fp_rate: float) -> int:
    """Memory that a filter for ``n`` items takes, in whole 64-bit words."""
    return -(-bloom_size(n, fp_rate)[0] // 64) * 8


def most_items(memory: int, fp_rate: float) -> int:
    """Items that a filter of so many bytes holds at that rate."""
    from math import log

    return int(memory * 8 * log(2) ** 2 / -log(fp_rate))
