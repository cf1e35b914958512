"""Repeated passages by distributed prefix doubling.

A position is ranked by the words that follow it: equal ranks mean equal prefixes. Spark sorts the positions by the 64-bit hash of
their first words (a quarter of the threshold), then by a 64-bit hash of pairs (rank here, rank at the offset), the offset growing as the ranked
prefix doubles: 13, 26 and 50 words for a threshold of 50. After each sort positions get dense ranks in the sorted order, and
those whose key is unique drop out, until the threshold is passed.

The sort is by ranges of (key, document, position), so that the copies of a passage, however many, are spread over tasks, which
read them as a stream. Of each task's range the first and last key are told to the driver (one row a task): it chains keys that
go on in the next range and gives each range the rank of its first key.

Of equal texts the first alone takes part: all of any other one repeats it, and the first's positions that nothing else repeats
are first copies. So the copies of a document, however many, cost nothing but their keys.

Before the first sort an exact filter drops positions that can't repeat: each prefix of ``least`` words has the least hash of
its word runs of ``GRAM`` (a winnowing fingerprint), which any other copy of the prefix has too; where that hash occurs once
in the corpus, the prefix does.

A repeated position covers ``least`` words. Overlapping ones merge to spans, apart for first copies and for others: of equal
prefixes the first by (doc_id, position) is the copy that stays.

Contract: doc ids are integers, null ones come last, equal ones in the order of their row keys. Repeated rows are documents of
their own, so all but one are cut. Texts with fewer than ``least`` words, empty and null ones have no repeats. Repeats within
one text count. An empty table gives no rows. Other columns of the input don't matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import arrays
from textloom.llm.scratch import Scratch, filed, fresh, keyed, sent, sent_bytes, text_key

LEAST, GRAM = 50, 16
#: Bytes of spans up to which they are sent to the scan of the texts; more are joined by a shuffle.
SENT_SPANS = 32 << 20


def least_places(h: np.ndarray, first: np.ndarray, least: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start words of all prefixes of ``least`` words, place of the least ``gram``-run hash in each (the leftmost), and that hash.

    Equal prefixes have it at the same offset, so two of them have it at two places even where they overlap.
    """
    if len(h) < least:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    runs = arrays.grams(h, gram)
    at = np.flatnonzero(arrays.inside(first, least, len(h)))
    place = arrays.window_argmin(runs, least - gram + 1)[at]
    return at, place, runs[place]


def _fingerprints(batches: Iterator[pa.RecordBatch], least: int, gram: int) -> Iterator[pa.RecordBatch]:
    """(row_key, print, n): winnowing fingerprints of each text; n is 2 where the text holds one at several places, else 1."""
    for b in arrays.slices(batches, "text"):
        t = arrays.words(b["text"])
        _, place, low = least_places(t.hashes(), t.first, least, gram)
        if not len(place):
            continue
        new = np.append(True, place[1:] != place[:-1])  # places don't descend
        place, low = place[new], low[new]
        doc = np.searchsorted(t.first, place, "right") - 1
        order = np.lexsort((low, doc))
        low, doc = low[order], doc[order]
        start = np.flatnonzero(np.append(True, (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])))
        n = np.minimum(2, np.diff(np.append(start, len(low))))
        yield pa.record_batch([pa.array(b["row_key"].to_numpy()[doc[start]]), pa.array(low[start].view(np.int64)), pa.array(n.astype(np.int32))], ["row_key", "print", "n"])


def steps(least: int) -> list[int]:
    """Lengths of the ranked prefixes: a quarter of the threshold, then doubled up to it."""
    out = [-(-least // 4)]
    while out[-1] < least:
        out.append(min(2 * out[-1], least))
    return out


def _first_keys(batches: Iterator[pa.RecordBatch], least: int, gram: int) -> Iterator[pa.RecordBatch]:
    """(key, cid, pos) of the positions that may repeat and of those behind them whose ranks they need."""
    lengths = steps(least)
    ahead = [0]
    for short, long in zip(lengths, lengths[1:]):
        ahead += [x + long - short for x in ahead]
    for b in arrays.slices(batches, "text"):
        t = arrays.words(b["text"])
        h = t.hashes()
        at, _, low = least_places(h, t.first, least, gram)
        doc = np.searchsorted(t.first, at, "right") - 1
        hot = b["prints"]
        flat = hot.flatten().to_numpy().view(np.uint64)
        of = np.repeat(np.arange(len(hot)), np.diff(hot.offsets.to_numpy()))
        at = at[np.isin(arrays.mix(low ^ _salt(doc)), arrays.mix(flat ^ _salt(of)))]
        at = np.unique(np.concatenate([at + x for x in ahead]))
        if not len(at):
            continue
        key = arrays.grams(h, lengths[0])[at]
        doc = np.searchsorted(t.first, at, "right") - 1
        cells = key.view(np.int64), b["cid"].to_numpy()[doc], (at - t.first[doc]).astype(np.int32)
        yield pa.record_batch([pa.array(c) for c in cells], ["key", "cid", "pos"])


def _salt(i: np.ndarray) -> np.ndarray:
    return arrays.mix(i.astype(np.uint64) + np.uint64(1))


def _groups(part: dict[str, np.ndarray], *keys: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each row is first of its group, its group's number, and whether the group has several rows."""
    n = len(part[keys[0]])
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= part[k][1:] != part[k][:-1]
    which = np.cumsum(new) - 1
    return new, which, np.bincount(which)[which] > 1


_RANKED = "part int, local long, cid long, pos int, later boolean, edge array<long>"


def _ranked(batches: Iterator[pa.RecordBatch], part: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted range with the number of their key in it; those of keys that have one row go, but for the first and last key.

    ``later``: the key has a row before in this range. The last row has ``edge`` instead: first and last key, their rows, keys.
    """
    part = TaskContext.get().partitionId() if part is None else part
    names = [x.split()[0] for x in _RANKED.split(", ")]
    longs = pa.list_(pa.int64())

    def out(local: np.ndarray, cid: np.ndarray, pos: np.ndarray, later: np.ndarray) -> pa.RecordBatch:
        n = len(local)
        return pa.record_batch([pa.array(np.full(n, part, np.int32)), pa.array(local.astype(np.int64)), pa.array(cid), pa.array(pos), pa.array(later), pa.nulls(n, longs)], names)

    first = last = held = None
    at, rows, n_first = -1, 0, 0  # number and rows of the key that is still open, rows of the first one
    for x in batches:
        if not x.num_rows:
            continue
        key, cid, pos = (x[c].to_numpy() for c in ("key", "cid", "pos"))
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        new[0] = int(key[0]) != last
        seg = np.cumsum(new)
        count = np.bincount(seg)
        count[0] += rows if not new[0] else 0
        first = int(key[0]) if first is None else first
        local = at + seg
        if held is not None and not new[0]:
            yield out(*held)
        held = None
        keep = (count[seg] > 1) | (local == 0)
        if new[-1] and not keep[-1]:  # perhaps the next batch has more of it
            held = local[-1:], cid[-1:], pos[-1:], np.zeros(1, bool)
        if keep.any():
            yield out(local[keep], cid[keep], pos[keep], ~new[keep])
        n_first += int((local == 0).sum())
        at, rows, last = int(local[-1]), int(count[-1]), int(key[-1])
    if first is not None:
        if held is not None:
            yield out(*held)
        edge = pa.array([[first, last, n_first, rows, at + 1]], longs)
        yield pa.record_batch([pa.array([part], pa.int32()), *(pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.bool_())), edge], names)


def _chained(edges: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, bool, bool, bool]]:
    """(part, rank of its first key, keys, whether its first key has one row in all, its last, whether the first goes on from before)."""
    out, rank = [], 0
    sizes: list[int] = []  # rows of each key at an edge; a key that goes on is one entry
    for part, (first, last, n_first, n_last, keys) in edges:
        joined = bool(out) and out[-1][-1] == first
        if joined:
            sizes[-1] += n_first
        else:
            sizes.append(n_first)
        at = len(sizes) - 1
        if keys > 1:
            sizes.append(n_last)
        start = rank - joined
        rank = start + keys
        out.append((part, start, keys, at, len(sizes) - 1, joined, last))
    return [(part, start, keys, sizes[i] == 1, sizes[j] == 1, joined) for part, start, keys, i, j, joined, _ in out]


def ranks(keyed_: DataFrame, name: str, scratch: Scratch, first_copies: bool) -> DataFrame:
    """(rank, cid, pos, cut) of the rows of (key, cid, pos) whose key isn't unique; ranks are dense and follow the keys' order.

    With ``first_copies`` ``cut`` holds for all but the first row of a key by (cid, pos); the order within keys costs a slower sort.
    """
    order = ("key", "cid", "pos")
    sorted_ = keyed_.repartitionByRange(*order).sortWithinPartitions(*(order if first_copies else order[:1]))
    sorted_ = scratch.table(name, sorted_.mapInArrow(lambda it: _ranked(it), _RANKED))
    edges = [(r["part"], list(r["edge"])) for r in sorted_.filter("edge IS NOT NULL").select("part", "edge").orderBy("part").collect()]
    ends = keyed_.sparkSession.createDataFrame(_chained(edges), "part int, start long, keys long, first_alone boolean, last_alone boolean, goes_on boolean")
    both = sorted_.filter("edge IS NULL").join(F.broadcast(ends), "part")  # one row a task
    both = both.filter("NOT (local = 0 AND first_alone) AND NOT (local = keys - 1 AND last_alone)")
    return both.select((F.col("start") + F.col("local")).alias("rank"), "cid", "pos", (F.col("later") | ((F.col("local") == 0) & F.col("goes_on"))).alias("cut"))


def _next_keys(batches: Iterator[pa.RecordBatch], offset: int) -> Iterator[pa.RecordBatch]:
    """(key, cid, pos) of positions in order of their document: the hash of the pair (rank here, rank at the offset)."""
    for part in arrays.whole(batches, "cid"):
        order = np.lexsort((part["pos"], part["cid"]))
        part = {c: v[order] for c, v in part.items()}
        _, which, _ = _groups(part, "cid")
        code = which * (1 << 40) + part["pos"]
        k = np.searchsorted(code, code + offset)
        ok = np.append(code, -1)[k] == code + offset
        if ok.any():
            here, there = (part["rank"][x].astype(np.uint64) for x in (ok, k[ok]))
            key = arrays.mix(here * np.uint64(0xD6E8FEB86659FD93) ^ arrays.mix(there))
            yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(part["cid"][ok]), pa.array(part["pos"][ok])], ["key", "cid", "pos"])


def _merged(pos: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans of words that ascending positions cover."""
    start = np.append(True, pos[1:] > pos[:-1] + least)[: len(pos)]
    s = np.flatnonzero(start)
    return pos[s], pos[np.append(s[1:], len(pos)) - 1] + least if len(pos) else pos


def _spans(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(cid, spans, runs) of each document: spans (cut, start, end) of words, and runs [from, to) of the positions that are cut."""
    pair = pa.list_(pa.list_(pa.int32()))
    for part in arrays.whole(batches, "cid"):
        order = np.lexsort((part["pos"], part["cut"], part["cid"]))
        part = {c: v[order] for c, v in part.items()}
        new, _, _ = _groups(part, "cid")
        ids, spans, runs = [], [], []
        at = np.append(np.flatnonzero(new), len(new))
        for a, b in zip(at, at[1:]):
            pos, cut = part["pos"][a:b], part["cut"][a:b]
            ids.append(part["cid"][a])
            spans.append([[int(c), int(s), int(e)] for c in (0, 1) for s, e in zip(*_merged(pos[cut == c], least))])
            s, e = _merged(pos[cut], 1)
            runs.append(list(map(list, zip(s.tolist(), e.tolist()))))
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(spans, pair), pa.array(runs, pair)], ["cid", "spans", "runs"])


_PLACED = "row_key long, doc_id long, cut boolean, start_word int, end_word int, start_char int, end_char int"


def _places(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Spans of words as spans of characters too, of single texts, of the first of equal ones (``head``) and of its copies (``copy``)."""
    for b in arrays.slices(batches, "text"):
        t = arrays.words(b["text"], lower=False)
        chars = np.concatenate([[0], np.cumsum((t.data & 0xC0) != 0x80)])
        size = np.diff(t.first)
        doc, found = [], []
        for i, (kind, spans, runs) in enumerate(zip(b["kind"].to_pylist(), b["spans"].to_pylist(), b["runs"].to_pylist())):
            own = spans or []
            if kind == "copy":
                own = [[1, 0, int(size[i])]] if size[i] >= least else []
            elif kind == "head":
                kept = np.ones(max(0, int(size[i]) - least + 1), bool)
                for s, e in runs or []:
                    kept[s:e] = False
                own = [x for x in own if x[0]] + [[0, int(s), int(e)] for s, e in zip(*_merged(np.flatnonzero(kept), least))]
            doc += [i] * len(own)
            found += own
        if not found:
            continue
        at = np.array(doc)
        cut, s, e = np.array(found, np.int64).T
        from_char = chars[t.starts[t.first[at] + s]] - chars[t.offsets[at]]
        to_char = chars[t.ends[t.first[at] + e - 1]] - chars[t.offsets[at]]
        take = pa.array(at)
        yield pa.record_batch(
            [b["row_key"].take(take), b["doc_id"].take(take), pa.array(cut.astype(bool)), *(pa.array(x.astype(np.int32)) for x in (s, e, from_char, to_char))],
            [x.split()[0] for x in _PLACED.split(", ")],
        )


def equal_texts(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(row_key, kind) of the rows whose text another one has: the first is the head, the others are copies."""
    keys = scratch.table("keys", rows.filter("text IS NOT NULL").select("row_key", "doc_id", *text_key(F.col("text"))))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")).alias("first")
    groups = scratch.table("groups", keys.groupBy("hash_a", "hash_b").agg(first, F.count("*").alias("n")).filter("n > 1").select("hash_a", "hash_b", F.col("first.row_key").alias("head_key")))
    kind = F.when(F.col("row_key") == F.col("head_key"), "head").otherwise("copy").alias("kind")
    out = scratch.table("equal", keys.join(sent(groups), ["hash_a", "hash_b"]).select("row_key", kind))
    scratch.remove("keys")
    scratch.remove("groups")
    return out


def spans(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """(row_key, doc_id, cut, start_word, end_word, start_char, end_char) of every repeated span; ends are excluded."""
    if not 0 < gram <= least:
        raise ValueError("the gram must not be longer than the threshold")
    rows = keyed(docs, "row_key", scratch, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    equal = equal_texts(rows, scratch)
    kinds = sent(equal).withColumnRenamed("row_key", "equal_key")
    known = rows.join(kinds, F.col("row_key") == F.col("equal_key"), "left").drop("equal_key")
    single = known.filter("kind IS NULL OR kind = 'head'")
    prints = scratch.table("prints", single.select("row_key", "text").mapInArrow(lambda it: _fingerprints(it, least, gram), "row_key long, print long, n int"))
    # A table of its own: both sides of the join are then shuffled by it, and a print of very many texts can be split.
    hot = scratch.table("hot", prints.groupBy("print").agg(F.sum("n").alias("n")).filter("n > 1").select("print"))
    mine = prints.join(hot, "print", "left_semi").groupBy("row_key").agg(F.collect_set("print").alias("prints"))
    order = (F.col("doc_id").isNull(), "doc_id", "row_key")
    chosen = rows.join(mine, "row_key").repartitionByRange(*order).sortWithinPartitions(*order)
    # Numbers given after the sort and written with the rows: their order is that of (doc_id, row_key).
    cand = scratch.table("cand", chosen.withColumn("cid", F.monotonically_increasing_id()))
    scratch.remove("prints")
    scratch.remove("hot")
    keys = scratch.table("keys0", cand.select("cid", "text", "prints").mapInArrow(lambda it: _first_keys(it, least, gram), "key long, cid long, pos int"))
    lengths = steps(least)
    for k, (short, long) in enumerate(zip(lengths, [*lengths[1:], 0])):
        ranked = ranks(keys, f"ranked{k}", scratch, not long)
        scratch.remove(f"keys{k}")
        if long:
            near = ranked.select("rank", "cid", "pos").repartition("cid").sortWithinPartitions("cid")
            keys = scratch.table(f"keys{k + 1}", near.mapInArrow(lambda it, offset=long - short: _next_keys(it, offset), "key long, cid long, pos int"))
            scratch.remove(f"ranked{k}")
    again = ranked.select("cid", "pos", "cut").repartition("cid").sortWithinPartitions("cid")
    merged = again.mapInArrow(lambda it: _spans(it, least), "cid long, spans array<array<int>>, runs array<array<int>>")
    named = scratch.table("merged", merged.join(cand.select("cid", F.col("row_key").alias("span_key")), "cid").drop("cid"))
    scratch.remove(f"ranked{len(lengths) - 1}")
    scratch.remove("cand")
    # Every row that has spans: of the sorted ones, and all of equal texts.
    some = named.join(equal, named["span_key"] == equal["row_key"], "full").select(F.coalesce("span_key", "row_key").alias("span_key"), "kind", "spans", F.when(F.col("kind") == "head", F.col("runs")).alias("runs"))
    some = scratch.table("some", some)
    size = 64 + 24 * F.coalesce(F.size("spans"), F.lit(0)) + 20 * F.coalesce(F.size("runs"), F.lit(0))
    placed = rows.join(sent_bytes(some, size, SENT_SPANS), F.col("row_key") == F.col("span_key")).select("row_key", "doc_id", "text", "kind", "spans", "runs")
    return placed.mapInArrow(lambda it: _places(it, least), _PLACED)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(doc_id, cut, start_word, end_word, start_char, end_char) of every repeated span; checkpointed."""
    scratch = Scratch(docs.sparkSession)
    return scratch.result(spans(docs, scratch, id_col, text_col, least).drop("row_key"))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars", least: int = LEAST) -> DataFrame:
    """``docs`` with every later copy of a repeated span cut from its text, and ``size_col`` (if there) set anew.

    A row of whose text no word is left goes; rows without repeats stay as they are, null and empty texts included.
    """
    scratch = Scratch(docs.sparkSession)
    docs = filed(docs, scratch)
    cut = spans(docs, scratch, id_col, text_col, least).filter("cut")
    cut = scratch.table("cuts", cut.groupBy("row_key").agg(F.array_sort(F.collect_list(F.struct("start_char", "end_char"))).alias("cuts")))
    scratch.only("cuts")
    cut = sent_bytes(cut, 64 + 24 * F.size("cuts"), SENT_SPANS)
    key, cuts, gap = (fresh(docs, c) for c in ("row_key", "cuts", "left"))
    own = keyed(docs, key, scratch, *[F.col(f"`{c}`") for c in docs.columns])
    both = own.join(cut.select(F.col("row_key").alias("cut_key"), F.col("cuts").alias(cuts)), F.col(key) == F.col("cut_key"), "left").drop("cut_key")
    before = f"CASE WHEN i = 0 THEN 0 ELSE `{cuts}`[i - 1].end_char END"
    until = f"CASE WHEN i = size(`{cuts}`) THEN length(`{text_col}`) ELSE `{cuts}`[i].start_char END"
    left = F.expr(f"array_join(transform(sequence(0, size(`{cuts}`)), i -> substring(`{text_col}`, {before} + 1, {until} - {before})), '')")
    both = both.withColumn(gap, F.when(F.col(cuts).isNotNull(), left).otherwise(F.col(f"`{text_col}`")))
    both = both.filter(F.col(cuts).isNull() | F.col(gap).rlike("[\\p{L}\\p{N}]"))
    size = F.when(F.col(cuts).isNull(), F.col(f"`{size_col}`")).otherwise(F.length(gap)) if size_col in docs.columns else None
    made = {text_col: F.col(gap)} | ({size_col: size.cast(docs.schema[size_col].dataType)} if size is not None else {})
    return both.select(*[made[c].alias(c) if c in made else F.col(f"`{c}`") for c in docs.columns])


def op4_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op4_suffix": op4_suffix}
SQL: dict[str, str] = {}
