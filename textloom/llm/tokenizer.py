"""Byte-pair counts with a public vocabulary file, per worker.

The vocabulary path is a parameter. A text is cut into blocks at places where the pre-tokeniser always has a boundary: before
a single space between two characters that aren't white space.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
_KINDS = (r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]")
PATTERN = "|".join(["'(?:[sdmt]|ll|ve|re)", *(f" ?{k}+" for k in _KINDS), r"\s+(?!\S)", r"\s+"])
_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
BLOCK = 1 << 16
LONG = 100_000
_SPACES = re.compile(r"\s{%d}" % (LONG // 2))


@lru_cache(4)
def encoding(vocabulary: str) -> tiktoken.Encoding:
    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def blocks(text: str, size: int) -> list[str]:
    """Consecutive parts of about ``size`` characters whose tokens together are the text's tokens."""
    out, at = [], 0
    while len(text) - at > size:
        m = _BOUNDARY.search(text, at + size - 1)
        if not m:
            break
        out.append(text[at : m.start()])
        at = m.start()
    out.append(text[at:])
    return out


def ids(text: str, vocabulary: str = VOCABULARY) -> list[int]:
    """Token ids; a block with more white space in a row than the library's regular expression bears goes piece by piece."""
    enc, out = encoding(vocabulary), []
    for block in blocks(text, BLOCK):
        if len(block) < LONG or not _SPACES.search(block):
            out += enc.encode_ordinary(block)
        else:
            for m in regex.finditer(PATTERN, block):
                out += enc._core_bpe.encode_single_piece(m.group().encode("utf-8", "replace"))
    return out


def count(text: str, vocabulary: str = VOCABULARY) -> int:
    return len(ids(text, vocabulary))


def counts(arr: pa.Array, vocabulary: str = VOCABULARY) -> list[int | None]:
    return [None if t is None else count(t, vocabulary) for t in arr.to_pylist()]
