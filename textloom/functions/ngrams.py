"""Words of many texts at once and hashes of their runs, on arrays of code points; and arrays as bytes for a shuffle."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters that are looked at together, unless one text has more.
CHARS = 1 << 20
_CODES = 0x110000
_P, _Q = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Of each code point: 0 for white space, 1 in words, 2 for a sign that stands alone; and a random number."""
    kinds = np.fromiter((1 if c.isalnum() else 0 if c.isspace() else 2 for c in map(chr, range(_CODES))), np.uint8, _CODES)
    return kinds, mix(np.arange(1, _CODES + 1, dtype=np.uint64) * np.uint64(_P))


def _of_runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial modulo 2**64 of each run of ``values``, by running sums."""
    n = len(values)
    if base not in _powers or len(_powers[base][0]) <= n:
        made = [np.full(max(n + 1, CHARS + CHARS // 4), b, np.uint64) for b in (base, pow(base, -1, 1 << 64))]
        for a in made:
            a[0] = 1
        _powers[base] = tuple(np.multiply.accumulate(a) for a in made)
    up, down = _powers[base]
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=total[1:])
    if n > 4 * CHARS:
        del _powers[base]
    return (total[ends] - total[starts]) * down[starts]


def word_spans(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of letters and digits, and of every other character that is no white space."""
    kinds = _tables()[0][codes]
    word, sign = kinds == 1, kinds == 2
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    return np.flatnonzero(first | sign), np.flatnonzero(last | sign) + 1


def gram_hashes(words: np.ndarray, sizes: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, place, hash) of the runs of ``high`` words of each unit; a shorter unit of ``low`` words or more is one run."""
    starts = np.cumsum(sizes) - sizes
    count = np.where(sizes >= high, sizes - high + 1, (sizes >= low).astype(np.int64))
    unit = np.repeat(np.arange(len(sizes), dtype=np.int32), count)
    place = np.arange(len(unit)) - np.repeat(np.cumsum(count) - count, count)
    at, length = starts[unit] + place, np.minimum(sizes, high)[unit]
    return unit, place.astype(np.int32), mix(_of_runs(words, at, at + length, _Q) + length.astype(np.uint64) * np.uint64(_P))


def grams_of(batches: Iterator[pa.RecordBatch], by_line: bool, low: int, high: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Over batches of (id, text), some texts at a time: the row's number in its batch, id, number in the text, n-grams and n-grams
    of the whole text of each unit (a line, or a text); unit, place and hash of each n-gram."""
    for b in batches:
        ids, column = b["id"].to_numpy(zero_copy_only=False), b["text"]
        upto = np.cumsum(pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        lo = 0
        while lo < len(ids):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + CHARS, "right")))
            texts = [t.lower() for t in column.slice(lo, hi - lo).to_pylist()]
            begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
            codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
            bounds = np.concatenate([[0], np.flatnonzero(codes == 10) + 1]) if by_line else begin
            starts, ends = word_spans(codes)
            words = mix(_of_runs(_tables()[1][codes], starts, ends, _P))
            doc = np.searchsorted(begin, bounds[:-1], "right") - 1
            number = np.arange(len(doc)) - np.searchsorted(doc, doc)
            unit, place, gram = gram_hashes(words, np.diff(np.searchsorted(starts, bounds)), low, high)
            total = np.bincount(unit, minlength=len(doc))
            whole = np.bincount(doc, total, len(texts)).astype(np.int64)
            yield doc + lo, ids[lo:hi][doc], number.astype(np.int32), total, whole[doc], unit, place, gram
            lo = hi


def small(a: np.ndarray) -> np.ndarray:
    """Numbers from 0 in as few bytes as the largest needs."""
    return a.astype(np.min_scalar_type(int(a.max(initial=0))))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: the first bytes of all numbers of one, then the second ones, which compresses better."""
    head = np.array([len(arrays), *(x for a in arrays for x in (ord(a.dtype.char), len(a)))], np.int64)
    return head.tobytes() + b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)


def unpack(data: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    head, at, out = np.frombuffer(data, np.int64, 2 * n, 8), 8 + 16 * n, []
    for char, size in head.reshape(n, 2).tolist():
        kind = np.dtype(chr(char))
        out.append(np.ascontiguousarray(np.frombuffer(data, np.uint8, size * kind.itemsize, at).reshape(kind.itemsize, size).T).reshape(-1).view(kind))
        at += size * kind.itemsize
    return out


def joined(rows: list[list[np.ndarray]], k: int, kind: type = np.int64) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(r[k].astype(kind, copy=False) for r in rows)])
