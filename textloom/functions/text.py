"""Native text helpers: every one maps a Column to a Column, so that plans stay in the JVM."""

from __future__ import annotations

import calendar

from pyspark.sql import Column
from pyspark.sql import functions as F

PUNCT = r"[^\p{L}\p{N}]"
#: Code points that end sentences, over all scripts, and those of punctuation and control characters.
_ENDS = """21 2e 3f 589 61d-61f 6d4 700-702 7f9 837 839 83d-83e 964-965 104a-104b 1362 1367-1368 166e 1735-1736 17d4-17d6 17d9-17da 1803
1809 1944-1945 1aa8-1aab 1b5a-1b5b 1b5e-1b5f 1b7d-1b7e 1c3b-1c3c 1c7e-1c7f 203c-203d 2047-2049 2e2e 2e3c 2e53-2e54 3002 a4ff a60e-a60f
a6f3 a6f7 a876-a877 a8ce-a8cf a92f a9c8-a9c9 aa5d-aa5f aaf0-aaf1 abeb fe52 fe56-fe57 ff01 ff0e ff1f ff61 10a56-10a57 10f55-10f59
10f86-10f89 11047-11048 110be-110c1 11141-11143 111c5-111c6 111cd 111de-111df 11238-11239 1123b-1123c 112a9 1144b-1144c 115c2-115c3
115c9-115d7 11641-11642 1173c-1173e 11944 11946 11a42-11a43 11a9b-11a9c 11c41-11c42 11ef7-11ef8 11f43-11f44 16a6e-16a6f 16af5
16b37-16b38 16b44 16e98 1bc9f 1da88"""
_MARKS = """0-8 b-1f 21-2f 3a-40 5b-60 7b-9f ab b4 bb 2013-2014 2019 201c-201e 2026 2236 2501 25ba 3001-3002 3008-300d 3010-3011 ff01 ff05
ff08-ff09 ff0c ff0e ff11 ff1a-ff1b ff1f ff5e"""


def char_class(ranges: str) -> str:
    """The inside of a character class of hexadecimal ranges, for the JVM's patterns and for RE2."""
    return "".join("-".join(rf"\x{{{x}}}" for x in part.split("-")) for part in ranges.split())


TERMINAL = f"[{char_class(_ENDS)}]\\z"
#: A character that is neither punctuation nor a sentence's end.
SYMBOL_FREE = f"[^{char_class(_ENDS)}{char_class(_MARKS)}]"
LINE_BREAK = r"\r\n|[\n\x0B\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: a column used within lambdas is else computed again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))  # what \s stands for in the JVM's patterns


def lines(c: Column, sep: str = "\n") -> Column:
    """Parts between line feeds, empty ones included."""
    return F.split(c, sep)  # a single character, unlike the pattern for it, is split at without a regular expression


def split_lines(c: Column) -> Column:
    """As lines, without the empty part after a final line break, and without any part of an empty text."""
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(c, rf"(?:{LINE_BREAK})\z", ""), LINE_BREAK))


def full_lines(c: Column) -> Column:
    """Lines as they stand, but for those of white space."""
    return F.filter(lines(c), lambda x: strip(x) != "")


def paragraphs(c: Column, end: str = "\\n", remove_empty: bool = True) -> Column:
    parts = F.split(c, "\n" if end == "\\n" else end)
    return F.filter(F.transform(parts, strip), lambda x: x != "") if remove_empty else parts


def tokens(c: Column) -> Column:
    """Words between white space."""
    return F.regexp_extract_all(c, F.lit(r"\S+"), F.lit(0))


def words(c: Column, model: str = "split", ignore_punctuation: bool = True) -> Column:
    """Words by ``model``: split (white space), regex (runs of letters and digits), uniseg (the JVM's word breaks), fasttext.

    Tokens whose first character isn't a letter or digit are dropped where ``ignore_punctuation`` holds.
    """
    if model == "split" and ignore_punctuation:
        return F.regexp_extract_all(c, F.lit(r"(?<!\S)[\p{L}\p{N}]\S*"), F.lit(0))
    if model == "split":
        found = tokens(c)
    elif model == "fasttext":
        found = tokens(F.regexp_replace(c, r"([^\p{L}\p{N}\s])", " $1 "))
    elif model == "regex":
        found = F.regexp_extract_all(c, F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}\s])"))
    elif model in ("uniseg", "fineweb"):
        found = F.flatten(F.sentences(c))
    else:
        raise ValueError(f"unknown word model {model}")
    return F.filter(found, lambda w: w.rlike(r"\A[\p{L}\p{N}]")) if ignore_punctuation else found


def n_sentences(c: Column) -> Column:
    return F.size(F.sentences(c))


def ngrams(ws: Column, n: int) -> Column:
    def runs(ws: Column) -> Column:
        return F.when(F.size(ws) >= n, F.transform(F.sequence(F.lit(1), F.size(ws) - n + 1), lambda i: F.array_join(F.slice(ws, i, n), " "))).otherwise(F.array().cast("array<string>"))

    return let(ws, runs)


def total(xs: Column, of=F.length) -> Column:
    """Sum of a measure of the elements."""
    return F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + of(x))


def mean_length(xs: Column) -> Column:
    return let(xs, lambda v: F.when(F.size(v) > 0, total(v) / F.size(v)))


def share(xs: Column, hit) -> Column:
    """Share of elements for which ``hit`` holds; null without elements."""
    return let(xs, lambda v: F.when(F.size(v) > 0, F.size(F.filter(v, hit)) / F.size(v)))


def within(value: Column, low: float, high: float) -> Column:
    """Whether a value, computed once, lies between two bounds; an infinite one doesn't count."""
    if high == float("inf"):
        return value >= low
    return let(value, lambda v: (v >= low) & (v <= high))


def read_list(items: list[str] | str | None = None, path: str | None = None) -> list[str]:
    """The entries of a list file (one a line, blank lines and comments left out) after those given."""
    out = [items] if isinstance(items, str) else list(items or [])
    if path:
        with open(path, encoding="utf-8") as f:
            out += [x.strip() for x in f if x.strip() and not x.startswith("#")]
    return [x for x in out if x]


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def if_found(c: Column, pattern: str, changed: Column, same: Column) -> Column:
    """``changed`` only for texts in which ``pattern`` occurs: a rule that needs it leaves others the ``same``."""
    return F.when(c.rlike(pattern), changed).otherwise(same)


def first_index(keys: Column) -> Column:
    """Places (from 0) at which an element occurs for the first time, as an array."""
    return F.filter(F.sequence(F.lit(0), F.size(keys) - 1), lambda i: F.array_position(keys, keys[i]) == i + 1)


# Normalisers of exact deduplication.
def normalize_url(c: Column) -> Column:
    x = F.regexp_replace(F.lower(strip(c)), r"\A(https?://)?(www\.)?", "")
    x = F.regexp_replace(x, r"[?&](utm_|ref|feed).*\z", "")
    return F.regexp_replace(x, r"/+\z", "")


def normalize_space(c: Column) -> Column:
    return F.lower(strip(F.regexp_replace(c, r"\s+", " ")))


def normalize_time(c: Column) -> Column:
    """Seconds since 1970 (UTC), -1 for what isn't a time."""
    return F.coalesce(F.expr(f"unix_timestamp(try_to_timestamp({_name(c)}))").cast("double"), F.lit(-1.0))


def _name(c: Column) -> str:
    return str(c._jc.toString()) if hasattr(c, "_jc") else str(c)


_FOLD_FROM = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ０１２３４５６７８９"
_FOLD_TO = "aaaaaaceeeeiiiinooooouuuuyy0123456789"


def normalize_loose(c: Column) -> Column:
    """Lower case, digits to 0, no punctuation or control characters, Latin letters without accents."""
    x = F.translate(F.lower(c), _FOLD_FROM, _FOLD_TO)
    x = F.regexp_replace(x, r"\p{Nd}", "0")
    return F.regexp_replace(x, r"[^\p{L}\p{N}\s|;]|[\x00-\x08\x0e-\x1f\x7f]", "")


NORMALIZERS = {
    "normalize_url": normalize_url,
    "normalize_timestamps": normalize_time,
    "normalize_whitespace_and_lowercase": normalize_space,
    "hash_text": F.md5,
    "ccnet_dedup_normalizer": normalize_loose,
}


def split_sentences(c: Column) -> Column:
    """Sentences by the JVM's breaks, each as its words joined."""
    return F.transform(F.sentences(c), lambda s: F.array_join(s, " "))


def join_sentences(xs: Column, sep: str = " ") -> Column:
    return F.array_join(xs, sep)


def join_paragraphs(xs: Column, sep: str = "\n") -> Column:
    return F.array_join(xs, sep)


def split_into_parts(c: Column, mode: str = "document") -> Column:
    """document, words, sentences or paragraphs; lines of white space belong to the paragraph before."""
    if mode == "document":
        return F.array(c)
    if mode == "words":
        return words(c, "uniseg", False)
    if mode == "sentences":
        return F.split(c, r"(?<=[.!?…])(?=\s+\p{Lu})")
    if mode == "paragraphs":
        return F.split(c, r"(?<=\n)(?=[^\n]*\S)")
    raise ValueError(f"unknown mode {mode}")


def simplify_text(c: Column, lowercase: bool = True, norm_numbers: bool = True, norm_days: bool = False, remove_punctuation: bool = True, norm_whitespace: bool = True, unicode_accents: bool = True) -> Column:
    """A text for comparisons: lower case, digits as 0, no punctuation, single spaces, no accents on Latin letters."""
    if lowercase:
        c = F.lower(c)
    if norm_numbers:
        c = F.regexp_replace(c, r"\p{Nd}", "0")
    if norm_days:
        c = F.regexp_replace(c, r"(?i)\b(mon|tues|wednes|thurs|fri|satur|sun)day\b", "WEEKDAY")
        c = F.regexp_replace(c, rf"(?i)\b({'|'.join(calendar.month_name[1:])})\b", "MONTH")
    if remove_punctuation:
        c = F.regexp_replace(c, r"[^\p{L}\p{N}\p{M}\s]", " ")
    if norm_whitespace:
        c = strip(F.regexp_replace(c, r"\s+", " "))
    return F.translate(c, _FOLD_FROM, _FOLD_TO) if unicode_accents else c
