"""Word tokenizers by language. Register your own; unknown languages raise an error."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

Tokenizer = Callable[[str], list[str]]
_WORD = re.compile(r"[^\W_]+(?:['’.][^\W_]+)*|[^\w\s]|_")
_SYLLABLES = re.compile(r"[^་།\s]+")


def whitespace(text: str) -> list[str]:
    return text.split()


def breaks(text: str) -> list[str]:
    """Runs of letters and digits, and single signs."""
    return _WORD.findall(text)


def characters(text: str) -> list[str]:
    """Single characters of scripts without spaces, words of others."""
    return re.findall(r"[฀-໿က-႟ក-៿぀-ヿ一-鿿가-힯]|[^\W_]+|[^\w\s]", text)


TOKENIZERS: dict[str, Tokenizer] = {k: breaks for k in "en de fr es it pt nl pl ru sv da no fi cs ro hu el tr uk bg hr".split()}
TOKENIZERS |= {k: characters for k in "zh ja th lo km my ko".split()} | {"bo": _SYLLABLES.findall, "xx": whitespace}
#: Three-letter codes and the two-letter ones that stand for them.
CODES = {"eng": "en", "deu": "de", "fra": "fr", "spa": "es", "ita": "it", "zho": "zh", "jpn": "ja", "tha": "th", "kor": "ko"}


def register(language: str, tokenizer: Tokenizer) -> None:
    TOKENIZERS[language] = tokenizer


def load_word_tokenizer(language: str) -> Tokenizer:
    language = CODES.get(language, language)
    if language not in TOKENIZERS:
        raise ValueError(f"no tokenizer for {language}")
    return TOKENIZERS[language]


def chunk_text_on_bytes(text: str, most: int) -> Iterator[str]:
    """Parts of at most ``most`` bytes, cut between characters; a character that is longer comes alone."""
    at, size = 0, 0
    for i, c in enumerate(text):
        n = len(c.encode())
        if size + n > most and i > at:
            yield text[at:i]
            at, size = i, 0
        size += n
    if at < len(text):
        yield text[at:]


def words_of(text: Column, language: str = "en") -> Column:
    tokenizer = load_word_tokenizer(language)

    @F.arrow_udf("array<string>")
    def run(arr: pa.Array) -> pa.Array:
        return pa.array([None if t is None else tokenizer(t) for t in arr.to_pylist()], pa.list_(pa.string()))

    return run(text)
