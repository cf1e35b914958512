"""Vectorised tokenising and hashing over Arrow string buffers.

A *word* is a maximal run of ASCII letters and digits and of non-ASCII characters outside the Latin-1, general and CJK
punctuation blocks, after lower-casing. ``WORD`` is the same rule as a regular expression (for tests and brute force).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = "[0-9a-zÀ-῿⁰-⿿぀-\U0010ffff]+"
CHUNK_BYTES = 2 << 20
_P, _Q = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xD6E8FEB86659FD93 | 1)
_LUT = np.zeros(256, bool)
_LUT[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_ANY_CASE = _LUT.copy()
_ANY_CASE[65:91] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n."""
    have = _POWERS.get(int(base))
    if have is None or len(have[0]) < n:
        n = max(n, 1 << 16)
        out = []
        for b in (int(base), pow(int(base), -1, 1 << 64)):
            a = np.full(n, b, np.uint64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        have = _POWERS[int(base)] = (out[0], out[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def raw(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string array; nulls count as empty."""
    arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    data = np.frombuffer(arr.buffers()[2] or b"", np.uint8)[off[0] : off[-1]] if off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


@dataclass
class Tokens:
    """Words of several texts: ``starts``/``ends`` are byte positions in ``data``, ``first`` the index of each text's first word."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        n = len(self.data)
        up, down = _powers(_P, n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        return mix((total[self.ends] - total[self.starts]) * down[self.starts])

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(arr: pa.Array, lower: bool = True) -> Tokens:
    """Words of each text; without ``lower`` the same words as they stand, for their places in the text."""
    data, off = raw(pc.utf8_lower(arr) if lower else arr)
    is_word = (_LUT if lower else _ANY_CASE)[data]
    if len(data) and data.max() >= 0xC2:
        lead = np.flatnonzero(data == 0xC2)
        is_word[lead] = False
        is_word[lead + 1] = False
        lead = np.flatnonzero((data == 0xE2) | (data == 0xE3))
        if len(lead):
            second = data[lead + 1]
            bad = lead[((data[lead] == 0xE2) & ((second == 0x80) | ((second == 0x81) & (data[lead + 2] < 0xB0)))) | ((data[lead] == 0xE3) & (second == 0x80))]
            for k in range(3):
                is_word[bad + k] = False
    before = np.zeros(len(data), bool)
    before[1:] = is_word[:-1]
    before[off[:-1][off[:-1] < len(data)]] = False
    starts = np.flatnonzero(is_word & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = is_word[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    ends = np.flatnonzero(is_word & ~after) + 1
    return Tokens(data, off, starts, ends, np.searchsorted(starts, off))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive token hashes (length ``len(h) - n + 1``); runs that cross texts are the caller's to mask."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    if n <= 4:
        out = h[:m].copy()
        for k in range(1, n):
            out = out * _Q + h[k : k + m]
        return mix(out)
    up, down = _powers(_Q, len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[: len(h)], out=total[1:])
    return mix((total[n : n + m] - total[:m]) * down[:m])


def inside(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Mask over starts 0..total-n: True where the n-run lies within one text."""
    m = total - n + 1
    if m <= 0:
        return np.zeros(0, bool)
    ok = np.ones(m, bool)
    for k in range(1, n):
        cut = first[1:-1] - k
        ok[cut[(cut >= 0) & (cut < m)]] = False
    return ok


def window_argmin(x: np.ndarray, w: int) -> np.ndarray:
    """Place of the leftmost minimum of each run of w values."""
    have, at = 1, np.arange(len(x))
    low = x
    while have < w:
        step = min(have, w - have)
        right = low[step:] < low[:-step]
        low, at = np.where(right, low[step:], low[:-step]), np.where(right, at[step:], at[:-step])
        have += step
    return at


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that each holds about ``most`` bytes of ``column``; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            base = size[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(size, base + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def pieces(arr: pa.Array, most: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    batch = pa.record_batch([arr], ["x"])
    for b in slices(iter([batch]), "x", most):
        yield b["x"]


def whole(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[dict[str, np.ndarray]]:
    """Columns of sorted batches, cut only between different values of ``keys``."""
    held: list[dict[str, np.ndarray]] = []
    for b in batches:
        if not b.num_rows:
            continue
        now = {c: b[c].to_numpy(zero_copy_only=False) for c in b.schema.names}
        same = np.ones(b.num_rows, bool)
        for k in keys:
            same &= now[k] == now[k][-1]
        cut = b.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
        joins = bool(held) and all(held[0][k][0] == now[k][0] for k in keys)
        if held and (cut or not joins):
            if joins:
                held.append({c: v[:cut] for c, v in now.items()})
                now, cut = {c: v[cut:] for c, v in now.items()}, 0
                yield {c: np.concatenate([h[c] for h in held]) for c in now}
                held = []
            else:
                yield {c: np.concatenate([h[c] for h in held]) for c in now}
                held = []
        if cut:
            yield {c: v[:cut] for c, v in now.items()}
            now = {c: v[cut:] for c, v in now.items()}
        held.append(now)
    if held:
        yield {c: np.concatenate([h[c] for h in held]) for c in held[0]}


class Lookup:
    """A fixed hash table from distinct 64-bit hashes to their indices."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.ascontiguousarray(keys, np.uint64)
        bits = max(4, int(2 * len(self.keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slot = np.full(1 << bits, -1, np.int32)
        at, todo = self._home(self.keys), np.arange(len(self.keys))
        while len(todo):
            free = self.slot[at[todo]] < 0
            self.slot[at[todo[free]]] = todo[free]  # of several the last wins
            todo = todo[self.slot[at[todo]] != todo]
            at[todo] = (at[todo] + 1) & self.mask

    def _home(self, h: np.ndarray) -> np.ndarray:
        return ((h * np.uint64(0x9FB21C651E98DF25)) >> self.shift).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash among the keys, -1 for strangers."""
        out = np.full(len(h), -1, np.int32)
        if not len(self.keys):
            return out
        at = self._home(h)
        got = self.slot[at]
        hit = (got >= 0) & (self.keys[got] == h)
        out[hit] = got[hit]
        todo = np.flatnonzero((got >= 0) & ~hit)
        at = at[todo]
        while len(todo):
            at = (at + 1) & self.mask
            got = self.slot[at]
            hit = (got >= 0) & (self.keys[got] == h[todo])
            out[todo[hit]] = got[hit]
            go = (got >= 0) & ~hit
            todo, at = todo[go], at[go]
        return out
