"""Near-duplicate removal: SimHash, navigable small-world graphs per shard, verified edges unioned.

1. Each text gets a 128-bit SimHash of its word pairs and ``ROUTES`` min-hashes of its word triples. Equal texts become one
   node (by a 128-bit hash of the text), however many they are.
2. Nodes are spread over shards of about ``SHARD_ROWS``: those with the same min-hash in one of the routes share a shard. A
   min-hash that more nodes have (boilerplate) is hot: its nodes are spread anew by every second min-hash that they share with it,
   and where that is hot too, by every third. What is still hot is cut into shards by a hash, and about ``PIVOTS`` of its nodes
   are broadcast as queries to all its cuts. This finds the large groups of a hot min-hash in shards of a bounded size; ``unmet``
   then compares every pair of its nodes that no hits connect, exactly, in tasks of two blocks of about ``REST_ROWS`` signatures.
   So two texts meet if they share a min-hash, hot or not: with Jaccard similarity J with probability 1 - (1 - J)**ROUTES.
3. A shard builds a navigable small-world graph over Hamming distance and searches it for every node and query, with a beam that
   expands while it is full of hits. Recall is audited against exact search on some nodes and queries of each shard (the mean over
   those with neighbours); a shard below ``LEAST_RECALL``, and a query whose beam outgrows ``MOST_BEAM``, is searched exactly.
   ``audits`` returns what the audits found. As recall is a mean below 1, ``within`` then compares every pair of a min-hash that
   isn't hot (at most ``SHARD_ROWS`` nodes) and that the graph left apart.
4. A shard returns a least spanning forest of its hits. Each of its edges is verified by the Jaccard similarity of the two texts'
   word triples, and connected components of verified edges are groups. Where nodes that hits connect are in several groups,
   all pairs between these are tried, in tasks of two blocks of at most ``BLOCK_ROWS`` texts.

Contract: null texts are nobody's copies. Texts without words are copies only of equal texts. Of a group the row with the
least id stays (null ids last, then by row key); repeated rows are a group. An empty table gives no rows. Other columns of the
input don't matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import arrays
from textloom.llm.scratch import SENT_KEYS, Scratch, filed, fresh, keyed, sent, text_key

BITS, DISTANCE, JACCARD, ROUTES = 128, 32, 0.5, 5
SHARD_ROWS, LINKS, SLOTS, BEAM, MOST_BEAM = 16_384, 10, 32, 32, 512
AUDIT, LEAST_RECALL, PIVOTS, DEEP = 256, 0.9, 64, 3
#: Texts, and their bytes, in a block of a group whose pairs are all tried.
BLOCK_ROWS, BLOCK_BYTES = 4096, 32 << 20
#: Signatures in a block of a hot min-hash, and comparisons of a step.
REST_ROWS, STEP = 32_768, 1 << 18
_SALTS = arrays.mix(np.arange(1, 65, dtype=np.uint64))


def shingles(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word n-runs of each text and where each text's begin; a shorter text has one for the whole of it."""
    g, ok = arrays.grams(h, n), arrays.inside(first, n, len(h))
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    own, of = g[ok], doc[: len(g)][ok]
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < n))
    if len(short):
        whole = np.array([arrays.grams(h[first[i] : first[i + 1]], first[i + 1] - first[i])[0] for i in short], np.uint64)
        own, of = np.concatenate([own, whole]), np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        own, of = own[order], of[order]
    return own, np.searchsorted(of, np.arange(len(first)))


def signatures(text: pa.Array, routes: int = ROUTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """SimHash halves (texts, 2), min-hashes (texts, routes) and number of words of each text; zeros without words."""
    t = arrays.words(text)
    h, n = t.hashes(), len(t.first) - 1
    sig, mins = np.zeros((n, 2), np.uint64), np.zeros((n, routes), np.uint64)
    size = np.diff(t.first)
    some = np.flatnonzero(size)
    if not len(some):
        return sig, mins, size
    pairs, at = shingles(h, t.first, 2)
    start, length = at[some], at[some + 1] - at[some]
    parts = -(-length // 255)  # byte counters hold 255 words
    ahead = np.cumsum(parts) - parts
    begin = np.repeat(start, parts) + 255 * (np.arange(parts.sum()) - np.repeat(ahead, parts))
    lanes = np.uint64(0x0101010101010101)
    for half in range(2):
        x = pairs if half == 0 else arrays.mix(pairs ^ _SALTS[40])
        counts = np.empty((len(begin), 8, 8), np.int32)
        for bit in range(8):
            counts[:, :, bit] = np.add.reduceat((x >> np.uint64(bit)) & lanes, begin).astype("<u8").view(np.uint8).reshape(-1, 8)
        total = np.add.reduceat(counts.reshape(-1, 64), ahead, axis=0)
        up = (2 * total > length[:, None]).astype(np.uint8)
        sig[some, half] = np.packbits(up, axis=1, bitorder="little").view("<u8")[:, 0]
    triples, at = shingles(h, t.first, 3)
    for j in range(routes):
        mins[some, j] = np.minimum.reduceat(triples * (_SALTS[j] | np.uint64(1)), at[some])
    return sig, mins, size


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of two arrays of signatures, broadcast over all but the last axis."""
    x = np.bitwise_count(a ^ b)
    return x[..., 0].astype(np.int16) + x[..., 1]


def _near(distance: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k least of each row."""
    return np.argpartition(distance, k - 1, axis=1)[:, :k] if distance.shape[1] > k else np.broadcast_to(np.arange(distance.shape[1]), distance.shape)


class Graph:
    """A navigable small-world graph over distinct signatures; queries are searched in step with each other.

    A node is a query when it is inserted: ``label`` joins it with the nodes before it that are found within ``most``, by the
    nearest pairs in ``edges``.
    """

    FAR = 999

    def __init__(self, sigs: np.ndarray, most: int, links: int = LINKS, slots: int = SLOTS):
        self.sigs, self.most, self.links, self.slots = sigs, most, links, slots
        self.nbr = np.full((len(sigs), slots), -1, np.int32)
        self.deg = np.zeros(len(sigs), np.int32)
        self.label = np.arange(len(sigs))
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.n = 0
        step = 64
        while self.n < len(sigs):
            self._insert(min(len(sigs), self.n + step))
            step = min(512, step * 2)

    def _insert(self, to: int) -> None:
        new = np.arange(self.n, to)
        q = self.sigs[new]
        near = hamming(q[:, None], q[None])
        a, b = np.nonzero(np.tril(near <= self.most, -1))
        pairs = [nearest(new[a], new[b], near[a, b], self.label)]
        near[new - self.n, new - self.n] = self.FAR
        ids = np.broadcast_to(new, near.shape)
        if self.n:
            old, far = self.search(q, BEAM)
            pairs += [nearest(new[a], b, hamming(q[a], self.sigs[b]), self.label) for a, b in self.expand(q, old, far)]
            ids, near = np.concatenate([ids, old], 1), np.concatenate([near, far], 1)
        self.label, kept = forest(*(np.concatenate(x) for x in zip(*pairs)), self.label)
        self.edges.append(kept)
        k = min(self.links, ids.shape[1] - (not self.n))
        if k > 0:
            pick = _near(near, k)
            to_id, d = np.take_along_axis(ids, pick, 1), np.take_along_axis(near, pick, 1)
            a, b, d = np.repeat(new, to_id.shape[1]), to_id.ravel(), d.ravel()
            ok = (b >= 0) & (d < self.FAR)
            self._link(a[ok], b[ok], d[ok])
            self._link(b[ok], a[ok], d[ok])
        self.n = to

    def expand(self, q: np.ndarray, ids: np.ndarray, far: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) within ``most``; a beam more than half full of hits is widened, at last to all nodes."""
        todo = np.arange(len(q))
        while True:
            ok = (ids >= 0) & (far <= self.most)
            full = (ok.sum(1) * 2 > ids.shape[1]) & (ids.shape[1] < self.n)
            a, b = np.nonzero(ok & ~full[:, None])
            yield todo[a], ids[a, b]
            todo = todo[full]
            if not len(todo):
                return
            if ids.shape[1] * 4 > MOST_BEAM:
                for lo in range(0, len(todo), 64):
                    a, b = _exact(self.sigs[: self.n], q[todo[lo : lo + 64]], self.most)
                    yield todo[lo : lo + 64][a], b
                return
            ids, far = self.search(q[todo], ids.shape[1] * 4)

    def _link(self, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> None:
        order = np.lexsort((d, a))
        a, b, d = a[order], b[order], d[order]
        start = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        slot = self.deg[a] + np.arange(len(a)) - np.repeat(start, np.diff(np.append(start, len(a))))
        fits = slot < self.slots
        self.nbr[a[fits], slot[fits]] = b[fits]
        np.maximum.at(self.deg, a[fits], slot[fits] + 1)
        a, b, d = a[~fits], b[~fits], d[~fits]  # a full node keeps its old, long links and trades a later one for a nearer one
        if len(a):
            half = self.slots // 2
            slot = half + (b % half)
            now = hamming(self.sigs[a], self.sigs[self.nbr[a, slot]])
            better = d < now
            self.nbr[a[better], slot[better]] = b[better]

    def search(self, q: np.ndarray, beam: int, wide: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1 for none) and distances of about the ``beam`` nearest nodes of each query."""
        rows = np.arange(len(q))[:, None]
        start = np.arange(min(self.n, max(beam, 64)))
        seen = np.zeros((len(q), self.n + 1), bool)
        seen[:, start] = True
        seen[:, self.n] = True
        d = hamming(q[:, None], self.sigs[None, start])
        pick = _near(d, min(beam, len(start)))
        ids, far = np.broadcast_to(start, d.shape)[rows, pick].astype(np.int32), d[rows, pick]
        if ids.shape[1] < beam:
            pad = beam - ids.shape[1]
            ids, far = np.pad(ids, ((0, 0), (0, pad)), constant_values=-1), np.pad(far, ((0, 0), (0, pad)), constant_values=self.FAR)
        fresh_ = ids >= 0
        active = np.arange(len(q))
        out_ids, out_far = ids.copy(), far.copy()
        while len(active):
            todo = np.where(fresh_, far, self.FAR + 1)
            pick = _near(todo, wide)
            row = np.arange(len(active))[:, None]
            valid = np.take_along_axis(todo, pick, 1) <= self.FAR
            fresh_[row, pick] = False
            nb = self.nbr[np.take_along_axis(ids, pick, 1)]
            nb = np.where(valid[:, :, None], nb, -1).reshape(len(active), -1)
            nb = np.sort(nb, axis=1)
            nb[:, 1:][nb[:, 1:] == nb[:, :-1]] = -1
            nb = np.where(nb < self.n, nb, -1)
            known = seen[active[:, None], nb]  # -1 reads the last column, which is always set
            seen[active[:, None], nb] = True
            nd = hamming(q[active][:, None], self.sigs[nb])
            nd[known] = self.FAR
            ids2, far2 = np.concatenate([ids, np.where(known, -1, nb).astype(np.int32)], 1), np.concatenate([far, nd], 1)
            fresh2 = np.concatenate([fresh_, ~known], 1)
            keep = _near(far2, beam)
            ids, far, fresh_ = ids2[row, keep], far2[row, keep], fresh2[row, keep]
            out_ids[active], out_far[active] = ids, far
            more = (fresh_ & (far < self.FAR)).any(1)
            active, ids, far, fresh_ = active[more], ids[more], far[more], fresh_[more]
        return out_ids, out_far


def _exact(sigs: np.ndarray, q: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(hamming(q[:, None], sigs[None]) <= most)


def nearest(a: np.ndarray, b: np.ndarray, d: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs in order of ``a`` the nearest ``b`` of each label, for each ``a``."""
    if len(a) < 2:
        return a, b, d
    own = label[b]
    if (own == own[0]).all():
        start = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        least = np.flatnonzero(d == np.repeat(np.minimum.reduceat(d, start), np.diff(np.append(start, len(a)))))
        pick = least[np.append(True, a[least][1:] != a[least][:-1])]
    else:
        order = np.lexsort((d, own, a))
        pick = order[np.append(True, (a[order][1:] != a[order][:-1]) | (own[order][1:] != own[order][:-1]))]
    return a[pick], b[pick], d[pick]


def forest(a: np.ndarray, b: np.ndarray, d: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Labels joined by edges (a, b) of length d, and the edges of a least spanning forest of the labels (Boruvka)."""
    kept_a, kept_b = [], []
    rank = np.lexsort((b, a, d))
    a, b = a[rank], b[rank]  # the first edge of a label is its least
    while True:
        la, lb = label[a], label[b]
        out = la != lb
        a, b, la, lb = a[out], b[out], la[out], lb[out]
        if not len(a):
            return label, (np.concatenate([*kept_a, a]), np.concatenate([*kept_b, b]))
        pick = np.unique(np.unique(np.stack([la, lb], 1).ravel(), return_index=True)[1] // 2)
        kept_a.append(a[pick])
        kept_b.append(b[pick])
        label = roots(len(label), a[pick], b[pick], label)


def joined(sigs: np.ndarray, queries: np.ndarray, most: int, audit: int = AUDIT) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[int, float, bool]]:
    """Component labels of ``sigs`` followed by ``queries``, joined where the search finds them within ``most``; the edges
    (a, b) that join them; and the audit: nodes and queries with neighbours, recall, whether the shard was searched exactly.
    """
    n, k = len(sigs), len(queries)
    label, none = np.arange(n + k), np.zeros(0, np.int64)
    if not n:
        return label, none, none, (0, 1.0, False)
    order = np.argsort(arrays.mix(sigs[:, 0] ^ sigs[:, 1]), kind="stable")  # insertion in an order without meaning
    graph = Graph(np.ascontiguousarray(sigs[order]), most)
    edges = [(order[a], order[b]) for a, b in graph.edges]
    label = roots(n + k, *(np.concatenate(x) for x in zip(*edges)), label)

    def take(found: Iterator[tuple[np.ndarray, np.ndarray]], q: np.ndarray, at: int) -> None:
        nonlocal label
        for a, b in found:
            by = np.argsort(a, kind="stable")
            a, b = a[by], b[by]
            label, kept = forest(*nearest(a + at, b, hamming(q[a], sigs[b]), label), label)
            edges.append(kept)

    for lo in range(0, k, 256):
        q = queries[lo : lo + 256]
        take(((a, order[b]) for a, b in graph.expand(q, *graph.search(q, BEAM))), q, n + lo)
    both = np.concatenate([sigs, queries])
    audited, found = recall(both, n, label, most, audit)
    exact = found < LEAST_RECALL
    for lo in range(0, n + k if exact else 0, 256):
        take([_exact(sigs, both[lo : lo + 256], most)], both[lo : lo + 256], lo)
    a, b = (np.concatenate(x) for x in zip(*edges))
    return label, a, b, (audited, found, exact)


def within(sigs: np.ndarray, of: np.ndarray, bucket: np.ndarray, label: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) that join components ``label`` of signatures: of all pairs within ``most`` whose rows ``of`` share a bucket."""
    order = np.lexsort((of, bucket))
    at, bucket = of[order], bucket[order]
    once = np.append(True, (at[1:] != at[:-1]) | (bucket[1:] != bucket[:-1]))
    at, bucket = at[once], bucket[once]
    rows = np.arange(len(at))
    start = np.maximum.accumulate(np.where(np.append(True, bucket[1:] != bucket[:-1]), rows, 0))
    ends = np.append(0, np.cumsum(rows - start))  # each row meets those before it in its bucket
    out = [np.zeros((2, 0), np.int64)]
    lo = 0
    while lo < len(at):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + STEP, "right")) - 1)
        i = np.repeat(rows[lo:hi], (rows - start)[lo:hi])
        j = start[i] + ends[lo] + np.arange(len(i)) - ends[i]
        a, b = at[i], at[j]
        new = label[a] != label[b]
        a, b = a[new], b[new]
        d = hamming(sigs[a], sigs[b])
        near = d <= most
        if near.any():
            label, kept = forest(a[near], b[near], d[near], label)
            out.append(np.stack(kept))
        lo = hi
    return tuple(np.concatenate(out, axis=1))


def recall(sigs: np.ndarray, n: int, label: np.ndarray, most: int, audit: int = AUDIT) -> tuple[int, float]:
    """Evenly spaced rows that have true neighbours within ``most`` among the first n, and the mean share that was joined with them."""
    at = np.arange(0, len(sigs), max(1, len(sigs) // max(1, audit)))
    shares: list[np.ndarray] = []
    for lo in range(0, len(at), 64):
        a, b = _exact(sigs[:n], sigs[at[lo : lo + 64]], most)
        other = at[lo + a] != b
        a, b = a[other], b[other]
        size = np.bincount(a, minlength=64)
        right = np.bincount(a, label[at[lo + a]] == label[b], minlength=64)
        shares.append(right[size > 0] / size[size > 0])
    every = np.concatenate(shares) if shares else np.zeros(0)
    return len(every), float(every.mean()) if len(every) else 1.0


def roots(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Least member of each one's connected component."""
    label = np.arange(n) if label is None else label
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


_FOUND = "a long, b long, rows int, audited int, recall double, exact boolean"


def _shard(table: pa.Table, most: int) -> pa.Table:
    """A least spanning forest (a, b) of the hits in a shard, and a row for its audit; no hit of one min-hash is left out."""
    key = table["key"].to_numpy()
    sig = np.stack([table["sig_a"].to_numpy(), table["sig_b"].to_numpy()], 1).astype(np.int64).view(np.uint64)
    node = table["is_node"].to_numpy()
    order = np.lexsort((key, ~node))
    key, sig, node = key[order], sig[order], node[order]
    every, first, of = np.unique(sig, axis=0, return_index=True, return_inverse=True)
    of = of.ravel()
    is_node = np.zeros(len(every), bool)
    is_node[of[node]] = True
    at = np.concatenate([np.flatnonzero(is_node), np.flatnonzero(~is_node)])
    label, a, b, (audited, found, exact) = joined(every[is_node], every[~is_node], most)
    if table["level"][0].as_py() == 1:  # all rows are nodes; those of further levels are left to ``unmet``
        more_a, more_b = within(every, of, table["bucket"].to_numpy()[order], label, most)
        a, b = np.concatenate([a, more_a]), np.concatenate([b, more_b])
    head = key[first]
    same = np.flatnonzero(head[of] != key)  # texts with one signature
    a, b = np.concatenate([head[at[a]], head[of[same]]]), np.concatenate([head[at[b]], key[same]])
    n = len(a)
    names, kinds = zip(*(x.split() for x in _FOUND.split(", ")))
    cells = ([*a, None], [*b, None], [None] * n + [len(key)], [None] * n + [audited], [None] * n + [found], [None] * n + [exact])
    types = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
    return pa.table([pa.array(c, types[t]) for c, t in zip(cells, kinds)], names=list(names))


def components(edges: DataFrame, scratch: Scratch, name: str = "tops", most: int = SENT_KEYS) -> DataFrame:
    """(key, top): the least key connected with each key of the stored edges (a, b).

    Up to ``most`` edges go through one task; more through rounds of joins, every one written, which cuts lineage.
    """
    edges = edges.select("a", "b").filter("a <> b")
    if edges.count() <= most:

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [(b["a"].to_numpy(), b["b"].to_numpy()) for b in batches if b.num_rows]
            if parts:
                a, b = (np.concatenate(x) for x in zip(*parts))
                key, of = np.unique(np.concatenate([a, b]), return_inverse=True)
                label = roots(len(key), of[: len(a)], of[len(a) :])
                yield pa.record_batch([pa.array(key), pa.array(key[label])], ["key", "top"])

        return scratch.table(name, edges.repartition(1).mapInArrow(join, "key long, top long"))
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = scratch.table(f"{name}-links", both.distinct())
    now = scratch.table(f"{name}0", both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.col("key")).alias("top")))
    k = 0
    while True:
        k += 1
        seen = both.join(now, both["b"] == now["key"]).groupBy("a").agg(F.min("top").alias("low"))
        low = now.join(seen, now["key"] == seen["a"]).select("key", F.least("low", "top").alias("mid"), "top")
        up = now.select(F.col("key").alias("mid"), F.col("top").alias("jump"))
        new = scratch.table(f"{name}{k}", low.join(up, "mid", "left").select("key", F.least("mid", F.coalesce("jump", "mid")).alias("new"), "top"))
        moved = new.filter("new <> top").limit(1).count()
        scratch.remove(f"{name}{k - 1}")
        now = new.select("key", F.col("new").alias("top"))
        if not moved:
            scratch.remove(f"{name}-links")
            return now


def _sets(texts: pa.Array) -> list[np.ndarray]:
    """Distinct word triples of each text, ascending."""
    out = []
    for part in arrays.pieces(texts):
        t = arrays.words(part)
        g, at = shingles(t.hashes(), t.first, 3)
        out += [np.unique(g[a:b]) for a, b in zip(at, at[1:])]
    return out


def _alike(x: np.ndarray, y: np.ndarray, jaccard: float) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= jaccard * (len(x) + len(y) - both)


def _verify(batches: Iterator[pa.RecordBatch], jaccard: float) -> Iterator[pa.RecordBatch]:
    """The edges (a, b) whose texts are similar."""
    for b in arrays.slices(batches, "text_a"):
        ok = np.array([_alike(x, y, jaccard) for x, y in zip(_sets(b["text_a"]), _sets(b["text_b"]))])
        if ok.any():
            yield pa.record_batch([pa.array(b[c].to_numpy()[ok]) for c in ("a", "b")], ["a", "b"])


def _between(table: pa.Table, most: int, jaccard: float) -> pa.Table:
    """Verified edges that join the groups of two blocks (or of one); ``side`` is -1 for the first block and 1 for the other, 0 for one."""
    key, group, side = (table[c].to_numpy() for c in ("key", "group", "side"))
    sig = np.stack([table["sig_a"].to_numpy(), table["sig_b"].to_numpy()], 1).astype(np.int64).view(np.uint64)
    texts = table["text"].combine_chunks()
    order = np.argsort(key, kind="stable")
    key, group, side, sig, texts = key[order], group[order], side[order], sig[order], texts.take(pa.array(order))
    sets = _sets(texts)
    _, label = np.unique(group, return_inverse=True)
    out: list[tuple[int, int]] = []
    for i in range(1, len(key)):
        d = hamming(sig[:i], sig[i][None])
        near = np.flatnonzero((d <= most) & (label[:i] != label[i]) & ((side[:i] != side[i]) | (side[i] == 0)))
        for j in near[np.argsort(d[near], kind="stable")].tolist():
            if label[j] != label[i] and _alike(sets[j], sets[i], jaccard):
                label[label == label[j]] = label[i]
                out.append((key[j], key[i]))
    return pa.table([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _unmet(table: pa.Table, most: int) -> pa.Table:
    """Hits (a, b) that join the components ``top`` of two blocks (or of one), of all pairs; ``side`` as in ``_between``."""
    order = np.argsort(table["key"].to_numpy(), kind="stable")
    key, top, side = (table[c].to_numpy()[order] for c in ("key", "top", "side"))
    sig_a, sig_b = (table[c].to_numpy()[order].astype(np.int64).view(np.uint64) for c in ("sig_a", "sig_b"))
    _, first, of = np.unique(top, return_index=True, return_inverse=True)
    label = first[of]
    one, other = np.flatnonzero(side <= 0), np.flatnonzero(side >= 0)
    step = max(1, STEP // max(1, len(other)))
    out = [np.zeros((2, 0), np.int64)]
    for lo in range(0, len(one), step):
        a, b = one[lo : lo + step], other if side[0] else other[lo:]
        d = np.bitwise_count(sig_a[a, None] ^ sig_a[b]) + np.bitwise_count(sig_b[a, None] ^ sig_b[b])
        i, j = np.nonzero(d <= most)
        new = label[a[i]] != label[b[j]]
        i, j = i[new], j[new]
        if len(i):
            label, kept = forest(*nearest(a[i], b[j], d[i, j].astype(np.int16), label), label)
            out.append(np.stack(kept))
    a, b = np.concatenate(out, axis=1)
    return pa.table([pa.array(key[a], pa.int64()), pa.array(key[b], pa.int64())], names=["a", "b"])


def unmet(crowded: DataFrame, reach: DataFrame, scratch: Scratch, most: int) -> DataFrame:
    """Hits (a, b) between the nodes of each hot min-hash that are in different components of ``reach``: no pair of these is left out.

    A component of more than half a block has blocks of its own, and no task for pairs of these; the others share blocks.
    """
    rows = scratch.table("labelled", crowded.join(reach, "key", "left").withColumn("top", F.coalesce("top", "key")))
    parts = rows.groupBy("bucket", "top").agg(F.count("*").alias("size"))
    parts = scratch.table("parts", parts.withColumn("large", F.col("size") * 2 > REST_ROWS))
    blocks = lambda size: F.ceil(size / REST_ROWS).cast("long")
    mixed = parts.groupBy("bucket").agg(F.count("*").alias("tops"), blocks(F.sum(F.when(F.col("large"), 0).otherwise(F.col("size")))).alias("shared"))
    mixed = scratch.table("mixed", mixed.filter("tops > 1").select("bucket", "shared"))
    large = parts.filter("large").select("bucket", "top", blocks(F.col("size")).alias("own")).join(mixed.select("bucket"), "bucket", "left_semi")
    large = scratch.table("large", large)
    part = F.pmod(F.xxhash64("key"), F.coalesce("own", "shared"))
    placed = rows.join(sent(mixed), "bucket").join(sent(large), ["bucket", "top"], "left")
    placed = placed.select("bucket", "key", "top", "sig_a", "sig_b", F.when(F.col("own").isNotNull(), F.col("top")).alias("home"), part.alias("part"))
    placed = scratch.table("placed", placed.withColumn("at", F.struct(F.col("home").isNotNull().alias("large"), F.coalesce("home", F.lit(0)).alias("home"), "part")).drop("home", "part"))
    held = placed.select("bucket", "at").distinct()
    held = scratch.table("held", held)
    x, y = held.select("bucket", F.col("at").alias("x")), held.select("bucket", F.col("at").alias("y"))
    pairs = x.join(y, "bucket").filter("x <= y AND NOT (x.large AND y.large AND x.home = y.home)")
    pairs = scratch.table("pairs", pairs.withColumn("at", F.explode(F.array_distinct(F.array("x", "y")))))
    side = F.when(F.col("x") == F.col("y"), 0).when(F.col("at") == F.col("x"), -1).otherwise(1)
    tasks = max(1, min(int(crowded.sparkSession.conf.get("spark.sql.shuffle.partitions")), pairs.count()))
    both = placed.join(sent(pairs), ["bucket", "at"]).select("bucket", "x", "y", side.alias("side"), "key", "top", "sig_a", "sig_b")
    both = both.repartition(tasks, "bucket", "x", "y").groupBy("bucket", "x", "y")  # by number, as in ``hits``
    return scratch.table("unmet", both.applyInArrow(lambda t: _unmet(t, most), "a long, b long"))


def spread(worded: DataFrame, scratch: Scratch, routes: int, shard_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """(level, block, cut, bucket, key, sig_a, sig_b, is_node): the rows of every shard; (bucket, key, sig_a, sig_b): those of hot min-hashes, if any."""
    crowded = None
    left = worded.select("key", "sig_a", "sig_b", "mins", F.explode(F.array(*[F.array(F.lit(j)) for j in range(routes)])).alias("combo"))
    out = None
    for level in range(1, DEEP + 1):
        bucket = F.xxhash64("combo", F.transform("combo", lambda j: F.get("mins", j))).alias("bucket")
        rows = scratch.table(f"level{level}", left.select("key", "sig_a", "sig_b", "mins", "combo", bucket))
        sizes = scratch.table(f"hot{level}", rows.groupBy("bucket").count().filter(F.col("count") > shard_rows).withColumnRenamed("count", "size"))
        crowd = sent(sizes)  # at most one bucket for shard_rows rows
        blocks = max(1, -(-rows.count() // shard_rows))
        cool = rows.join(crowd, "bucket", "left_anti").select(
            F.lit(level).alias("level"), F.pmod(F.xxhash64("bucket"), F.lit(blocks)).alias("block"), F.lit(0).cast("long").alias("cut"), "bucket", "key", "sig_a", "sig_b", F.lit(True).alias("is_node")
        )
        out = cool if out is None else out.unionByName(cool)
        hot = rows.join(crowd, "bucket")
        if level == 1 and not sizes.isEmpty():
            crowded = scratch.table("crowded", hot.select("bucket", "key", "sig_a", "sig_b"))
        if level < min(DEEP, routes):
            more = F.filter(F.array(*map(F.lit, range(routes))), lambda j: ~F.array_contains("combo", j))
            wider = hot.select("key", "sig_a", "sig_b", "mins", F.explode(F.transform(more, lambda j: F.array_sort(F.concat("combo", F.array(j))))).alias("combo"))
            left = wider.dropDuplicates(["key", "combo"])
            continue
        cuts = F.ceil(F.col("size") / shard_rows).cast("long")
        own = F.pmod(F.xxhash64("key", F.lit(level)), cuts)
        pivot = F.pmod(F.xxhash64("key", "bucket"), F.col("size")) < PIVOTS
        at = F.when(pivot, F.sequence(F.lit(0).cast("long"), cuts - 1)).otherwise(F.array(own))
        cut = hot.withColumn("own", own).withColumn("cut", F.explode(at))
        last = cut.select(F.lit(level + 1).alias("level"), F.col("bucket").alias("block"), "cut", "bucket", "key", "sig_a", "sig_b", (F.col("cut") == F.col("own")).alias("is_node"))
        return out.unionByName(last), crowded
    return out, crowded


def hits(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, routes: int = ROUTES, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """(rows, signed rows, nodes, what the shards found, nodes of hot min-hashes if any)."""
    rows = keyed(docs, "row_key", scratch, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.filter(F.col("text").isNotNull())
    schema = "row_key long, doc_id long, hash_a long, hash_b long, sig_a long, sig_b long, mins array<long>, n_words int"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrays.slices(batches, "text"):
            sig, mins, size = signatures(b["text"], routes)
            s = sig.view(np.int64)
            flat = pa.array(mins.view(np.int64).ravel())
            cells = [b[c] for c in ("row_key", "doc_id", "hash_a", "hash_b")] + [pa.array(s[:, 0]), pa.array(s[:, 1])]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, routes), pa.int32()), flat)
            yield pa.record_batch([*cells, lists, pa.array(size, pa.int32())], ["row_key", "doc_id", "hash_a", "hash_b", "sig_a", "sig_b", "mins", "n_words"])

    signed = scratch.table("signed", rows.select("row_key", F.col("doc_id").cast("long").alias("doc_id"), *text_key(F.col("text")), "text").mapInArrow(sign, schema))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")).alias("first")
    equal = signed.groupBy("hash_a", "hash_b").agg(first, F.first("sig_a").alias("sig_a"), F.first("sig_b").alias("sig_b"), F.first("mins").alias("mins"), F.first("n_words").alias("n_words"), F.count("*").alias("copies"))
    nodes = scratch.table("nodes", equal.select(F.col("first.row_key").alias("key"), F.col("first.doc_id").alias("rank"), "hash_a", "hash_b", "sig_a", "sig_b", "mins", "n_words", "copies"))
    shards, crowded = spread(nodes.filter("n_words > 0"), scratch, routes, shard_rows)
    tasks = max(1, min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-nodes.count() * routes // shard_rows)))
    # By number, as a shard takes seconds whatever its bytes, and small partitions would be put together.
    shards = shards.repartition(tasks, "level", "block", "cut").groupBy("level", "block", "cut")
    found = scratch.table("found", shards.applyInArrow(lambda t: _shard(t, distance), _FOUND))
    for level in range(1, DEEP + 1):
        scratch.remove(f"level{level}")
        scratch.remove(f"hot{level}")
    return rows, signed, nodes, found, crowded


def audits(docs: DataFrame, **how) -> DataFrame:
    """(rows, audited, recall, exact) of every shard; checkpointed. Where ``exact`` holds, the shard was searched exactly for it."""
    scratch = Scratch(docs.sparkSession)
    return scratch.result(hits(docs, scratch, **how)[3].filter("rows IS NOT NULL").select("rows", "audited", "recall", "exact"))


def groups(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, jaccard: float = JACCARD, routes: int = ROUTES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(row_key, doc_id, top_key, top_id) of every row in a group of two or more; ``top_key`` is the row that stays."""
    rows, signed, nodes, found, crowded = hits(docs, scratch, id_col, text_col, distance, routes, shard_rows)
    edges = found.filter("a IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = scratch.table("forest", edges)
    scratch.remove("found")
    if crowded is not None:
        edges = edges.unionByName(unmet(crowded, components(edges, scratch, "near"), scratch, distance))
        for name in ("crowded", "labelled", "parts", "mixed", "large", "placed", "held", "pairs"):
            scratch.remove(name)
    reach = components(edges, scratch, "reach")
    texts = rows.select(F.col("row_key").alias("key"), "text").join(sent(reach.select(F.col("key").alias("reach_key"))), F.col("key") == F.col("reach_key"), "left_semi")
    texts = scratch.table("texts", texts)
    end = lambda c: texts.select(F.col("key").alias(c), F.col("text").alias(f"text_{c}"))
    both = edges.join(end("a"), "a").join(end("b"), "b").select("a", "b", "text_a", "text_b")
    sure = scratch.table("sure", both.mapInArrow(lambda it: _verify(it, jaccard), "a long, b long"))
    apart = components(sure, scratch, "apart").withColumnsRenamed({"key": "apart_key", "top": "group"})
    grouped = reach.join(apart, reach["key"] == apart["apart_key"], "left").select("key", "top", F.coalesce("group", "key").alias("group"))
    grouped = scratch.table("grouped", grouped)
    several = grouped.groupBy("top").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low < high").select("top")
    rest = grouped.join(scratch.table("several", several), "top", "left_semi")
    rest = scratch.table("rest", rest.join(texts, "key").join(nodes.select("key", "sig_a", "sig_b"), "key"))
    size = rest.groupBy("top").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum(F.octet_length("text")) / BLOCK_BYTES)).cast("long").alias("blocks"))
    in_blocks = rest.join(scratch.table("blocks", size), "top").withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    pairs = in_blocks.select("*", other).select("top", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.signum(F.col("own") - F.col("other")).cast("int").alias("side"), "key", "group", "sig_a", "sig_b", "text")
    late = scratch.table("late", pairs.groupBy("top", "i", "j").applyInArrow(lambda t: _between(t, distance, jaccard), "a long, b long"))
    classes = components(scratch.table("verified", sure.unionByName(late)), scratch, "classes").withColumnsRenamed({"key": "class_key", "top": "class"})
    classed = nodes.join(classes, nodes["key"] == classes["class_key"], "left").select("key", "rank", "hash_a", "hash_b", "copies", F.coalesce("class", "key").alias("class"))
    classed = scratch.table("classed", classed)
    head = F.min(F.struct(F.col("rank").isNull().alias("last"), "rank", "key")).alias("head")
    heads = classed.groupBy("class").agg(head, F.sum("copies").alias("rows")).filter("rows > 1").select("class", F.col("head.key").alias("top_key"), F.col("head.rank").alias("top_id"))
    named = classed.join(scratch.table("heads", heads), "class").select("hash_a", "hash_b", "top_key", "top_id")
    named = scratch.table("named", named)
    return signed.select("row_key", "doc_id", "hash_a", "hash_b").join(named, ["hash_a", "hash_b"]).select("row_key", "doc_id", "top_key", "top_id")


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(doc_id, kept_id): every row that goes, with the row that stays for it; checkpointed."""
    scratch = Scratch(docs.sparkSession)
    g = groups(docs, scratch, id_col, text_col, **how)
    return scratch.result(g.filter("row_key <> top_key").select("doc_id", F.col("top_id").alias("kept_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` but for those that go, columns unchanged."""
    scratch = Scratch(docs.sparkSession)
    docs = filed(docs, scratch)
    gone = groups(docs, scratch, id_col, text_col, **how).filter("row_key <> top_key").select(F.col("row_key").alias("gone_key"))
    gone = scratch.table("gone", gone)
    scratch.only("gone")
    gone = sent(gone)
    name = fresh(docs, "row_key")
    own = keyed(docs, name, scratch, *[F.col(f"`{c}`") for c in docs.columns])
    return own.join(gone, own[name] == gone["gone_key"], "left_anti").drop(name)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op8_simhash": op8_simhash}
SQL: dict[str, str] = {}
