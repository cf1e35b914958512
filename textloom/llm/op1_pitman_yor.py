"""Language-model scores by a hierarchical Pitman-Yor model of words.

Restaurants: one for each preceding word (or the text's start), all with one parent, the restaurant of single words, whose base
is uniform over ``BASE_WORDS`` words. A customer at the parent is a table of a context restaurant.

The corpus is cut into segments; each sends, to the shard that owns a context, the context's words with the texts they stand
in. A shard therefore holds whole context restaurants. In one plan, on one shuffle of those postings:

1. shards report the tables of every word (at first the least seating, one for each context) to the parent's parts, which add
   them up, seat the parent on them by Gibbs sampling and answer each shard with the words' parent probabilities;
2. shards sample the number of tables of every (context, word) by a Gibbs sweep: P(t | rest) is proportional to
   S_d(c, t) (theta + d T)...(theta + d (T + t - 1)) P_parent(w)**t, with S_d generalised Stirling numbers; beyond ``EXACT``
   customers the seating goes on from an exact draw for the first ``EXACT``, in blocks that double;
3. both repeat: after each sweep the parent is seated anew on the sampled tables. The parent's parts know each other's tables
   as of one exchange before;
4. after the burn-in, predictive probabilities are averaged over samples (each with the parent's answers to that very seating),
   and their logarithms added up by text.

A context that alone would fill over half a shard is a hot one: a pass before counts contexts, segment by segment, and names
them with their numbers of parts (at most ``HOT`` contexts, whatever the corpus). Its words are spread over so many shards by a
hash; all parts use the restaurant's exact numbers of customers and tables, which are added up at each exchange. Within a sweep
a part sees the tables of the other parts as they were at the last exchange.

Contract: a text without words (null or empty) has n_words 0, log_prob 0 and a null perplexity. Repeated rows each count and
each get a row; null ids are carried. An empty table gives no rows. Draws are seeded by shard, so results don't depend on
retries. Other columns of the input don't matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import arrays
from textloom.llm.scratch import Scratch, keyed

DISCOUNT, STRENGTH, PARENT_DISCOUNT, PARENT_STRENGTH, BASE_WORDS = 0.75, 0.5, 0.75, 1.0, 1 << 24
BURN_IN, SAMPLES, EXACT = 3, 3, 40
#: Bytes of text in a segment, and of text whose postings one shard gets.
SEGMENT_BYTES, SHARD_BYTES = 16 << 20, 12 << 20
#: Most contexts whose restaurants are split.
HOT = 1 << 17
_WORD = np.uint64((1 << 40) - 1)
_START = np.uint64(0x5851F42D4C957F2D)


def _pack(*cells: np.ndarray) -> bytes:
    head = np.array([len(cells), *(c.nbytes for c in cells)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(np.ascontiguousarray(c).tobytes() for c in cells))


def _unpack(blob: bytes, *types: type) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    size = np.frombuffer(data, np.int64, n, 8)
    at = 8 + 8 * n + np.concatenate([[0], np.cumsum(size)])
    return [np.frombuffer(data[at[i] : at[i + 1]], t) for i, t in enumerate(types)]


def _five(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].T)


def _from_five(b: np.ndarray) -> np.ndarray:
    out = np.zeros((b.size // 5, 8), np.uint8)
    out[:, :5] = b.reshape(5, -1).T
    return out.view("<u8")[:, 0]


def pairs(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, word, text) of every word; hashes of 40 bits, the context of a text's first word is the start."""
    out, base = [], 0
    for p in arrays.pieces(text):
        t = arrays.words(p)
        h = t.hashes()
        before = np.empty_like(h)
        before[1:] = h[:-1]
        before[t.first[:-1][np.diff(t.first) > 0]] = _START
        out.append((before & _WORD, h & _WORD, (t.doc_of() + base).astype(np.int32)))
        base += len(p)
    return tuple(np.concatenate(x) for x in zip(*out))


def _busy(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """(context, n, words): contexts that have a share of an eighth of a shard or more of a segment's words."""
    for b in arrays.slices(batches, "text", SEGMENT_BYTES):
        context = np.sort(pairs(b["text"])[0])
        at = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(context) else np.zeros(0, np.int64)
        n = np.diff(np.append(at, len(context)))
        some = n * 8 * shards >= max(1, len(context))
        yield pa.record_batch(
            [pa.array(np.append(context[at[some]], np.uint64(0)).view(np.int64)), pa.array(np.append(n[some], len(context)).astype(np.int64)), pa.array(np.append(np.zeros(some.sum(), bool), True))], ["context", "n", "all_words"]
        )


def busy_contexts(rows: DataFrame, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts that fill over half a shard, and in how many parts each is split."""
    seen = rows.select("text").mapInArrow(lambda it: _busy(it, shards), "context long, n long, all_words boolean")
    sums = seen.groupBy("all_words", "context").agg(F.sum("n").alias("n"))
    total = sums.filter("all_words").select(F.col("n").alias("total"))
    hot = sums.filter("NOT all_words").crossJoin(F.broadcast(total)).withColumn("parts", F.ceil(F.col("n") * 2 * shards / F.col("total")))
    got = hot.filter("parts > 1").orderBy(F.col("n").desc(), "context").limit(HOT).select("context", "parts").collect()
    context, parts = np.array([r[0] for r in got], np.int64).view(np.uint64), np.array([r[1] for r in got], np.uint64)
    order = np.argsort(context)
    return context[order], parts[order]


def homes(context: np.ndarray, word: np.ndarray, shards: int, hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The shard of each (context, word)."""
    key = context
    if len(hot[0]):
        at = np.minimum(np.searchsorted(hot[0], context), len(hot[0]) - 1)
        split = hot[0][at] == context
        key = np.where(split, context ^ (arrays.mix(word) % np.where(split, hot[1][at], np.uint64(1)) << np.uint64(41)), context)
    return (arrays.mix(key) % np.uint64(shards)).astype(np.uint32)


def _segment(batches: Iterator[pa.RecordBatch], shards: int, hot: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(shard, segment, blob): contexts, words in each, their words, tokens of each, the text of each token, and the texts' ids.

    Texts are numbered within their segment; ids and word counts of all of them go to the first shard only.
    """
    for b in arrays.slices(batches, "text", SEGMENT_BYTES):
        segment = b["row_key"][0].as_py()
        context, word, doc = pairs(b["text"])
        size = np.bincount(doc, minlength=b.num_rows).astype(np.uint32)
        shard = homes(context, word, shards, hot)
        key = (shard.astype(np.uint64) << np.uint64(40)) | ((context & np.uint64(0xFFFF)) << np.uint64(24)) | (word >> np.uint64(16))
        order = np.argsort(key, kind="stable")
        del key
        context, word, doc, shard = context[order], word[order], doc[order], shard[order]
        new_word = np.ones(len(word), bool)
        new_word[1:] = (word[1:] != word[:-1]) | (context[1:] != context[:-1])
        at = np.flatnonzero(new_word)
        count = np.diff(np.append(at, len(word)))
        own, type_shard = context[at], shard[at]
        new_context = np.ones(len(own), bool)
        new_context[1:] = own[1:] != own[:-1]
        ids = b["doc_id"].cast(pa.int64())
        null = np.array(ids.is_null())
        ids = ids.fill_null(0).to_numpy()
        some = np.unique(np.append(shard, np.uint32(0)))  # never more blobs than words
        token_cut = np.append(np.searchsorted(shard, some), len(shard))
        type_cut = np.append(np.searchsorted(type_shard, some), len(type_shard))
        out = []
        for i, s in enumerate(some.tolist()):
            t, k = slice(type_cut[i], type_cut[i + 1]), slice(token_cut[i], token_cut[i + 1])
            start = np.flatnonzero(new_context[t])
            runs = np.diff(np.append(start, t.stop - t.start))
            first = slice(0, b.num_rows if s == 0 else 0)
            cells = own[t][start], runs.astype(np.uint32), _five(word[at[t]]), count[t].astype(np.uint32), _five(doc[k].astype(np.uint64))[:3], ids[first], null[first], size[first]
            out.append(_pack(*cells))
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array([segment] * len(out), pa.int64()), pa.array(out, pa.binary())], ["shard", "segment", "blob"])


_TYPES = (np.uint64, np.uint32, np.uint8, np.uint32, np.uint8, np.int64, np.bool_, np.uint32)


class Restaurants:
    """The restaurants of one shard: for each type (context, word) its customers; ``of`` finds each blob's types."""

    def __init__(self, blobs: list[bytes]):
        parts = [_unpack(x, *_TYPES) for x in blobs]
        contexts = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
        words = np.concatenate([_from_five(p[2]) for p in parts])
        count = np.concatenate([p[3] for p in parts]).astype(np.int64)
        key = arrays.mix(contexts * np.uint64(31) ^ arrays.mix(words))
        _, at, self.of = np.unique(key, return_index=True, return_inverse=True)
        self.customers = np.bincount(self.of, count, minlength=len(at)).astype(np.int64)
        self.rooms, self.room = np.unique(contexts[at], return_inverse=True)
        self.dishes, self.dish = np.unique(words[at], return_inverse=True)
        self.total = np.bincount(self.room, self.customers, minlength=len(self.rooms))
        self.elsewhere = np.zeros(len(self.rooms))
        self.parts = parts

    def contexts_of(self) -> np.ndarray:
        """In how many contexts each dish stands."""
        return np.bincount(self.dish, minlength=len(self.dishes))

    def split_of(self, hot: np.ndarray) -> np.ndarray:
        """The restaurants of which only a part may be here."""
        return np.flatnonzero(np.isin(self.rooms, hot))

    def complete(self, here: np.ndarray, customers: np.ndarray, tables: np.ndarray, t: np.ndarray) -> None:
        """Tells the customers and tables of whole restaurants of which only a part is here, seated as ``t``."""
        self.total[here] = customers
        self.elsewhere[here] = tables - np.bincount(self.room, t, minlength=len(self.rooms))[here]

    def tables(self, t: np.ndarray) -> np.ndarray:
        """Tables of each restaurant."""
        return np.bincount(self.room, t, minlength=len(self.rooms)) + self.elsewhere

    def sweep(self, t: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> None:
        """Draws the tables ``t`` of all types anew, a quarter of them at a time."""
        open_ = np.flatnonzero(self.customers > 1)
        quarters = rng.integers(0, 4, len(open_))
        for q in range(4):
            pick = open_[quarters == q]
            if len(pick):
                tables = self.tables(t)
                t[pick] = draw_tables(self.customers[pick], tables[self.room[pick]] - t[pick], p[pick], DISCOUNT, STRENGTH, rng)

    def probability(self, t: np.ndarray, tables: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Predictive probability of each type, given tables of types and of restaurants."""
        return ((self.customers - DISCOUNT * t) + (STRENGTH + DISCOUNT * tables[self.room]) * p) / (STRENGTH + self.total[self.room])

    def predictive(self, parent: np.ndarray, seed: int, burn_in: int, samples: int) -> np.ndarray:
        """Averaged predictive probability of each type under a parent that stays; ``parent`` is the parent's of each dish."""
        rng = np.random.default_rng(seed)
        p, t = parent[self.dish], np.ones(len(self.customers), np.int64)
        total = np.zeros(len(t))
        for sweep in range(burn_in + samples):
            self.sweep(t, p, rng)
            if sweep >= burn_in:
                total += self.probability(t, self.tables(t), p)
        return total / samples


@lru_cache(4)
def log_stirling(most: int, d: float) -> np.ndarray:
    """log S_d(c, t) for c and t up to ``most``: ways to seat c customers at t tables, weighted by table sizes."""
    out = np.full((most + 1, most + 2), -np.inf)
    out[0, 0] = 0
    for c in range(most):
        t = np.arange(1, c + 2)
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = np.where(c - d * t > 0, np.log(np.maximum(c - d * t, 1e-300)), -np.inf) + out[c, t]
        out[c + 1, t] = np.logaddexp(out[c, t - 1], stay)
    return out


def draw_tables(c: np.ndarray, others: np.ndarray, p: np.ndarray, d: float, theta: float, rng: np.random.Generator) -> np.ndarray:
    """A draw of the number of tables of each type given the other tables of its restaurant."""
    out = np.ones(len(c), np.int64)
    stirling = log_stirling(EXACT, d)
    few = np.minimum(c, EXACT)
    order = np.argsort(few, kind="stable")
    cut = np.searchsorted(few[order], np.arange(2, EXACT + 2))
    for n in range(2, EXACT + 1):
        own = order[cut[n - 2] : cut[n - 1]]
        for lo in range(0, len(own), 200_000):
            i = own[lo : lo + 200_000]
            steps = np.log(theta + d * (others[i][:, None] + np.arange(n))) + np.log(p[i])[:, None]
            w = np.cumsum(steps, axis=1) + stirling[n, 1 : n + 1]
            w = np.exp(w - w.max(axis=1, keepdims=True))
            w = np.cumsum(w, axis=1)
            out[i] = 1 + (rng.random(len(i))[:, None] * w[:, -1:] > w[:, :-1]).sum(axis=1)
    i, seated = np.flatnonzero(c > EXACT), EXACT
    while len(i):
        block = np.minimum(c[i], 2 * seated) - seated
        new = (theta + d * (others[i] + out[i])) * p[i]
        out[i] += rng.binomial(block, np.clip(new / (new + seated + block / 2 - d * out[i]), 0, 1))
        seated *= 2
        i = i[c[i] > seated]
    return out


_ASK = "part int, shard int, ask binary, state binary"
_ASK_TYPES = (np.uint8, np.uint32, np.int64, np.uint64, np.int64, np.int64)
_ANSWER_TYPES = (np.float32, np.int64, np.int64, np.int64)
_STATE_TYPES = (np.uint32, np.float32, np.float64)


def _asks(r: Restaurants, shard: int, parts: int, hot: np.ndarray, t: np.ndarray, seated: np.ndarray, state: bytes | None) -> pa.RecordBatch:
    """(part, shard, ask, state): to each part of the parent its words' tables here, all tables here, the parent's tables in its
    other parts (``seated``: of each part, empty if not known yet), and customers and tables of the hot contexts that it adds up.

    The shard's own state goes to one part, which hands it back.
    """
    n = np.bincount(r.dish, t, minlength=len(r.dishes)).astype(np.uint32)
    own = np.bincount(r.room, t, minlength=len(r.rooms)).astype(np.int64)
    customers = np.bincount(r.room, r.customers, minlength=len(r.rooms)).astype(np.int64)
    here, part, hot_part = _places(r, parts, hot)
    rows = []
    for k in range(parts):
        mine, h = part == k, here[hot_part == k]
        others = seated.sum() - seated[k] if len(seated) else -1
        rows.append((k, shard, _pack(_five(r.dishes[mine]), n[mine], np.array([t.sum(), others], np.int64), r.rooms[h], customers[h], own[h]), state if k == shard % parts else None))
    return pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["part", "shard", "ask", "state"])


def _places(r: Restaurants, parts: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Split restaurants; the parent's part of each dish; the part that adds up each split restaurant."""
    here = r.split_of(hot)
    return here, (arrays.mix(r.dishes) % np.uint64(parts)).astype(np.int64), (arrays.mix(r.rooms[here]) % np.uint64(parts)).astype(np.int64)


def _begin(batches: Iterator[pa.RecordBatch], parts: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What each shard asks at the least seating, one table for each type."""
    held: dict[int, list[bytes]] = {}
    for b in batches:
        for s, x in zip(b["shard"].to_pylist(), b["blob"].to_pylist()):
            held.setdefault(s, []).append(x)
    for s, blobs in held.items():
        r = Restaurants(blobs)
        yield _asks(r, s, parts, hot, np.ones(len(r.customers), np.int64), np.zeros(0, np.int64), None)


def _parent(table: pa.Table, parts: int, turn: int) -> pa.Table:
    """(shard, part, answer, state): the parent's probability of each word asked for, seated on the tables of all shards; the
    part's own tables; customers and tables of the whole hot contexts asked for."""
    table = table.sort_by("shard")
    got = [_unpack(x, *_ASK_TYPES) for x in table["ask"].to_pylist()]
    words = [_from_five(g[0]) for g in got]
    every, of = np.unique(np.concatenate(words), return_inverse=True)
    c = np.bincount(of, np.concatenate([g[1] for g in got]), minlength=len(every)).astype(np.int64)
    part = int(table["part"][0].as_py())
    rng = np.random.default_rng((part, turn))
    base, t = np.full(len(every), 1 / BASE_WORDS), np.ones(len(every), np.int64)
    total = np.zeros(len(every))
    customers, others = sum(int(g[2][0]) for g in got), int(got[0][2][1])
    tables = lambda: t.sum() + others if others >= 0 else t.sum() * parts  # noqa: E731  # words are spread over the parts by a hash
    for sweep in range(BURN_IN + SAMPLES):
        t = draw_tables(c, np.maximum(tables() - t, 0), base, PARENT_DISCOUNT, PARENT_STRENGTH, rng)
        if sweep >= BURN_IN:
            total += (c - PARENT_DISCOUNT * t + (PARENT_STRENGTH + PARENT_DISCOUNT * tables()) * base) / (PARENT_STRENGTH + customers)
    p = (total / SAMPLES).astype(np.float32)
    rooms, room = np.unique(np.concatenate([g[3] for g in got]), return_inverse=True)
    in_all = [np.bincount(room, np.concatenate([g[k] for g in got]), minlength=len(rooms)).astype(np.int64) for k in (4, 5)]
    cut, room_cut = np.cumsum([0, *map(len, words)]), np.cumsum([0, *(len(g[3]) for g in got)])
    own = np.array([t.sum()], np.int64)
    answers = [_pack(p[of[a:b]], own, *(x[room[i:j]] for x in in_all)) for a, b, i, j in zip(cut, cut[1:], room_cut, room_cut[1:])]
    return pa.table({"shard": table["shard"], "part": table["part"], "answer": pa.array(answers, pa.binary()), "state": table["state"]})


class Seating:
    """A shard's restaurants as its last sweep left them, with the parent's answers to that."""

    def __init__(self, left: pa.Table, right: pa.Table, hot: np.ndarray):
        r = self.r = Restaurants(left["blob"].to_pylist())
        right = right.sort_by("part")
        got = [_unpack(x, *_ANSWER_TYPES) for x in right["answer"].to_pylist()]
        here, part, hot_part = _places(r, len(got), hot)
        self.parent, self.seated = np.zeros(len(r.dishes), np.float32), np.array([g[1][0] for g in got])
        customers, tables = np.zeros((2, len(here)), np.int64)
        for k, (p, _, n, m) in enumerate(got):
            self.parent[part == k], customers[hot_part == k], tables[hot_part == k] = p, n, m
        state = next((x for x in right["state"].to_pylist() if x is not None), None)
        t, p, sums = _unpack(state, *_STATE_TYPES) if state else (np.ones(len(r.customers)), np.zeros(0, np.float32), np.zeros(0))
        # the sums are of tables by type, then for each sample the tables of restaurants
        self.t = t.astype(np.int64)
        n = len(p) // max(1, len(r.dishes))
        self.parents = list(p.reshape(n, -1)) if n else []
        self.sum_t = sums[: len(self.t)] if n else np.zeros(len(self.t))
        self.rooms = list(sums[len(self.t) :].reshape(n, -1)) if n else []
        r.complete(here, customers, tables, self.t)

    def take(self) -> None:
        """Takes a sample."""
        self.parents.append(self.parent)
        self.rooms.append(self.r.tables(self.t))
        self.sum_t = self.sum_t + self.t

    def state(self) -> bytes:
        sums = np.concatenate([self.sum_t, *self.rooms]) if self.parents else np.zeros(0)
        return _pack(self.t.astype(np.uint32), np.concatenate(self.parents) if self.parents else np.zeros(0, np.float32), sums)

    def predictive(self) -> np.ndarray:
        """The samples' averaged predictive probability of each type."""
        r, n = self.r, len(self.parents)
        total = r.customers * n - DISCOUNT * self.sum_t
        for p, tables in zip(self.parents, self.rooms):
            total += (STRENGTH + DISCOUNT * tables[r.room]) * p.astype(float)[r.dish]
        return total / n / (STRENGTH + r.total[r.room])


def _turn(left: pa.Table, right: pa.Table, parts: int, hot: np.ndarray, turn: int) -> pa.Table:
    """A sweep under the parent's last answers, and what the shard then asks."""
    s, shard = Seating(left, right, hot), left["shard"][0].as_py()
    if turn > BURN_IN:
        s.take()
    s.r.sweep(s.t, s.parent[s.r.dish].astype(float), np.random.default_rng((shard, turn)))
    return pa.Table.from_batches([_asks(s.r, shard, parts, hot, s.t, s.seated, s.state())])


def _score(left: pa.Table, right: pa.Table, hot: np.ndarray) -> pa.Table:
    """(segment, blob): log-likelihoods of each segment's texts in this shard, and ids and word counts from the first shard."""
    s = Seating(left, right, hot)
    s.take()
    r = s.r
    log_p = np.log(s.predictive())
    at, out = 0, []
    for _, _, _, count, doc, ids, null, size in r.parts:
        types = r.of[at : at + len(count)]
        at += len(count)
        of = doc.reshape(3, -1).astype(np.int64)
        of = of[0] | of[1] << 8 | of[2] << 16
        sums = np.bincount(of, np.repeat(log_p[types], count))
        some = np.flatnonzero(sums)
        out.append(_pack(np.diff(some, prepend=0).astype(np.uint32), sums[some].astype(np.float32), ids, null, size))
    return pa.table({"segment": left["segment"], "blob": pa.array(out, pa.binary())})


def _join(table: pa.Table) -> pa.Table:
    """(doc_id, ll, n) of the texts of one segment."""
    parts = [_unpack(x, np.uint32, np.float32, np.int64, np.bool_, np.uint32) for x in table["blob"].to_pylist()]
    ids, null, size = next(p[2:] for p in parts if len(p[4]))
    ll = np.zeros(len(size))
    for gaps, sums, *_ in sorted(parts, key=lambda p: (len(p[0]), p[1].tobytes())):  # one order of adding in every run
        ll[np.cumsum(gaps, dtype=np.int64)] += sums
    return pa.table({"doc_id": pa.array(ids, mask=null), "ll": ll, "n_words": size.astype(np.int64)})


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, log_prob, perplexity) of every row under the model of all rows."""
    scratch = Scratch(docs.sparkSession)
    rows = keyed(docs, "row_key", scratch, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    shards = max(1, -(-size // SHARD_BYTES))
    parts = max(1, shards // 4)
    hot = busy_contexts(rows, shards)
    seg = rows.mapInArrow(lambda it: _segment(it, shards, hot), "shard int, segment long, blob binary")
    home = seg.repartition(shards, "shard")
    asks = home.mapInArrow(lambda it: _begin(it, parts, hot[0]), _ASK)
    seat = lambda turn: lambda t: _parent(t, parts, turn)
    sweep = lambda turn: lambda x, y: _turn(x, y, parts, hot[0], turn)
    for turn in range(BURN_IN + SAMPLES + 1):
        answers = asks.repartition(parts, "part").groupBy("part").applyInArrow(seat(turn), "shard int, part int, answer binary, state binary")
        both = home.groupBy("shard").cogroup(answers.repartition(shards, "shard").groupBy("shard"))
        if turn < BURN_IN + SAMPLES:
            asks = both.applyInArrow(sweep(turn), _ASK)
    got = both.applyInArrow(lambda x, y: _score(x, y, hot[0]), "segment long, blob binary")
    sums = got.groupBy("segment").applyInArrow(_join, "doc_id long, ll double, n_words long")
    return sums.select("doc_id", "n_words", F.round("ll", 4).alias("log_prob"), F.when(F.col("n_words") > 0, F.round(F.exp(-F.col("ll") / F.col("n_words")), 4)).alias("perplexity"))


def op1_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op1_pitman_yor": op1_pitman_yor}
SQL: dict[str, str] = {}
