"""Repetition rules. Line and paragraph rules are native; n-gram rules count word ids with NumPy in an Arrow UDF."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.registry import step

_WORD = re.compile(r"[^\W_]+(?:['’.][^\W_]+)*")
TOP = {2: 0.2, 3: 0.18, 4: 0.16}
ALL = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.1}
SEGMENTS = (("line", 0.3, False), ("paragraph", 0.3, False), ("line", 0.2, True), ("paragraph", 0.2, True))


def values(arr: pa.Array) -> Iterator:
    """The values of a batch, few of them as Python objects at a time."""
    for lo in range(0, len(arr), 64):
        yield from arr.slice(lo, 64).to_pylist()


def segment_fraction(text: Column, granularity: str = "line", count_characters: bool = True, ignore_case: bool = False) -> Column:
    """Share of lines or paragraphs (or of their characters) that occur more than once, all copies counted; null without any."""
    parts = T.paragraphs(F.lower(text) if ignore_case else text, "\\n" if granularity == "line" else "\\n\\n")

    def share(xs: Column) -> Column:
        again = F.filter(xs, lambda x, i: ((i > 0) & (F.get(xs, i - 1) == x)) | F.coalesce(F.get(xs, i + 1) == x, F.lit(False)))
        return F.when(F.size(xs) > 0, T.total(again) / T.total(xs) if count_characters else F.size(again) / F.size(xs))

    return T.let(F.array_sort(parts), share)


def _grams(ids: np.ndarray, kinds: int, upto: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each n the gram number at each place, and how often each gram occurs; beyond 4 only while one repeats before."""
    out, now = {}, ids
    for n in range(2, upto + 1):
        if len(ids) < n:
            break
        _, now, count = np.unique(now[: len(ids) - n + 1] * kinds + ids[n - 1 :], return_inverse=True, return_counts=True)
        out[n] = now, count
        if n >= 4 and count.max() < 2:
            break  # nor does any longer one repeat
    return out


def ngram_fractions(words: list[str], upto: int = 10, in_bytes: bool = False) -> list[float]:
    """For n = 2, 3, 4 the characters of the most frequent n-gram (the longest of ties), from 5 on those of all words in
    repeated n-grams, as shares of the words' characters. 0 where nothing repeats."""
    if not words:
        return [0.0] * (upto - 1)
    table: dict[str, int] = {}
    ids = np.array([table.setdefault(w, len(table)) for w in words], np.int64)
    size = np.fromiter((len(w.encode()) for w in words) if in_bytes else map(len, words), np.int64, len(words))
    ends = np.concatenate([[0], np.cumsum(size)])
    out = []
    for n in range(2, upto + 1):
        out.append(0.0)
    for n, (at, count) in _grams(ids, len(table), upto).items():
        most = count.max()
        if most < 2:
            continue
        if n <= 4:
            length = ends[n:] - ends[:-n]
            out[n - 2] = float(length[count[at] == most].max() * most / ends[-1])
        else:
            hit = np.concatenate([count[at] > 1, np.zeros(n - 1, bool)])
            steps = np.zeros(len(words) + 1, np.int64)
            np.add.at(steps, np.flatnonzero(hit), 1)
            np.add.at(steps, np.flatnonzero(hit) + n, -1)
            out[n - 2] = float(size[np.cumsum(steps[:-1]) > 0].sum() / ends[-1])
    return out


def ngram_shares(text: Column, in_bytes: bool = False, words: Column | None = None) -> Column:
    """Nine shares a text, for n from 2 to 10; of characters or of UTF-8 bytes. ``words`` are words made before."""

    given = words is not None

    @F.arrow_udf("array<double>")
    def run(arr: pa.Array) -> pa.Array:
        return pa.array([None if t is None else ngram_fractions(t if given else _WORD.findall(t), in_bytes=in_bytes) for t in values(arr)], pa.list_(pa.float64()))

    return run(words if given else text)


@step("filter")
def repetition_filter(text: Column, granularity: str | int = "line", max_fraction: float = 0.3, count_characters: bool = True, ignore_case: bool = False) -> Column:
    """Lines, paragraphs or n-grams; without any segment a text is removed."""
    if isinstance(granularity, int):
        return F.get(ngram_shares(F.lower(text) if ignore_case else text), F.lit(granularity - 2)) <= max_fraction
    return F.coalesce(segment_fraction(text, granularity, count_characters, ignore_case) <= max_fraction, F.lit(False))


def massive_web_reason(text: Column, shares: Column, skip_paragraph: bool = False) -> Column:
    """The first rule that fails, null for none; ``shares`` is ``ngram_shares(text)`` as a column made before."""
    why = None
    for kind, most, chars in SEGMENTS:
        if skip_paragraph and kind == "paragraph":
            continue
        bad = ~F.coalesce(segment_fraction(text, kind, chars) <= most, F.lit(False))
        name = f"massive_web:{kind}{'_char' if chars else ''}"
        why = F.when(bad, name) if why is None else why.when(bad, name)
    for n, most in (TOP | ALL).items():
        why = why.when(F.get(shares, F.lit(n - 2)) > most, f"massive_web:{n}_gram")
    return why


@step("filter")
def massive_web_repetition_filters(text: Column, skip_paragraph: bool = False, use_fineweb_implementation: bool = False, words: Column | None = None) -> Column:
    if use_fineweb_implementation:
        return fineweb_gopher_repetition_filter(text)
    shares = ngram_shares(text, words=words)
    return massive_web_reason(text, shares, skip_paragraph).isNull()


def greedy_duplicates(found: list[str], size: int) -> int:
    """Characters of runs of ``size`` words met before, moving on behind each."""
    ids, lengths, kinds = _numbered(found)
    grams = _grams(ids, kinds, size)
    return _greedy(*grams[size], lengths, size) if size in grams else 0


def _numbered(words: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    table: dict[str, int] = {}
    ids = np.array([table.setdefault(w, len(table)) for w in words], np.int64)
    return ids, np.fromiter(map(len, words), np.int64, len(words)), len(table)


def _greedy(at: np.ndarray, count: np.ndarray, lengths: np.ndarray, size: int) -> int:
    if not len(count) or count.max() < 2:
        return 0
    ends = np.concatenate([[0], np.cumsum(lengths)])
    chars = (ends[size:] - ends[:-size]).tolist()
    seen, out, i, runs = set(), 0, 0, at.tolist()
    while i < len(runs):
        if runs[i] in seen:
            out += chars[i]
            i += size
        else:
            seen.add(runs[i])
            i += 1
    return out


def gopher_repetition(text: str) -> str | None:
    """The first rule of the web variant that fails: extra copies of paragraphs and lines, top and greedy n-grams.

    Paragraphs are those of the stripped text, lines those of the text as it stands; all shares divide by its length.
    """
    name = "massive_web_repetition_filters:{}".format
    if not text:
        return name("empty_text")
    for parts, kind in ((re.split(r"\n{2,}", text.strip()), "paragraph"), (re.split(r"\n+", text), "line")):
        extra = Counter(parts)
        again, chars = sum(c - 1 for c in extra.values()), sum((c - 1) * len(p) for p, c in extra.items())
        if again / len(parts) > 0.3:
            return name(kind)
        if chars / len(text) > 0.2:
            return name(f"{kind}_char")
    words = _WORD.findall(text)
    ids, lengths, kinds = _numbered(words)
    grams = _grams(ids, kinds, max(ALL))
    ends = np.concatenate([[0], np.cumsum(lengths)])
    for n, most in TOP.items():
        if n in grams:
            top = grams[n][1].max()  # a text without repeats has its first n-gram at the top
            at = int(np.argmax(grams[n][1][grams[n][0]] == top))  # of ties the first
            if (ends[at + n] - ends[at] + n - 1) * top / len(text) > most:
                return name(f"{n}_gram")
    for n, most in ALL.items():
        if n in grams and _greedy(*grams[n], lengths, n) / len(text) > most:
            return name(f"{n}_gram")
    return None


def gopher_repetition_reason(text: Column) -> Column:
    @F.arrow_udf("string")
    def run(arr: pa.Array) -> pa.Array:
        return pa.array(["massive_web_repetition_filters:empty_text" if t is None else gopher_repetition(t) for t in values(arr)], pa.string())

    return run(text)


@step("filter")
def fineweb_gopher_repetition_filter(text: Column) -> Column:
    return gopher_repetition_reason(text).isNull()
