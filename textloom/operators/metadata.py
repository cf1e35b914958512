"""Row predicates over metadata."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.registry import fresh, step


@step("filter")
def random_sampling_filter(text: Column, keep_probability: float = 0.1, seed: int = 0, id_col: str | None = None) -> Column:
    """Keeps a share of rows; with ``id_col`` by a hash of it, the same rows in every run."""
    if not 0 <= keep_probability <= 1:
        raise ValueError("a probability lies between 0 and 1")
    if id_col:
        return F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(1 << 20)) < int(keep_probability * (1 << 20))
    return F.rand(seed) < keep_probability


@step("filter")
def language_filter(text: Column, keep_languages: list[str] = ("en",), key: str = "language_id", threshold: float = 0.0) -> Column:
    """Keeps rows with a probability over ``threshold`` for a wanted language (column: map of language to probability)."""
    if isinstance(keep_languages, str):
        raise TypeError("keep_languages is a list")
    return F.when(F.col(key).isNotNull(), F.exists(F.array(*map(F.lit, keep_languages)), lambda x: F.coalesce(F.col(key)[x] > threshold, F.lit(False))))


def language_filter_v2(df: DataFrame, keep_languages: list[str], key: str = "language_id", threshold: float = 0.0, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(kept rows, all rows without their text): the second is a side output for statistics."""
    return df.filter(language_filter(F.col(text_col), keep_languages, key, threshold)), df.drop(text_col)


@step("filter")
def quality_filter(text: Column, key: str, threshold: float, lower_better: bool = False, key_must_exist: bool = True) -> Column:
    """A score of at least (or at most) ``threshold``; a missing one is an error or, with ``key_must_exist`` off, removed."""
    score = F.col(key).cast("double")
    if not key_must_exist:
        score = F.coalesce(score, F.lit(float("inf") if lower_better else float("-inf")))
    return score <= threshold if lower_better else score >= threshold


@step("filter")
def url_substring_filter(text: Column, banlist: list[str] | None = None, url_col: str = "url", ignore_chars: list[str] = (), num_banned_substrs: int = 1, exact_domain_match: bool = False, match_substrings: bool = True, case_sensitive: bool = False, banlist_file: str | None = None) -> Column:
    """Rows without a url stay; else it must have fewer than so many distinct banned substrings (of a file too), or another domain."""
    url, banlist = F.col(url_col), T.read_list(banlist, banlist_file)
    for c in ignore_chars:
        url = F.replace(url, F.lit(c), F.lit(""))
    if not case_sensitive:
        url, banlist = F.lower(url), [b.lower() for b in banlist]
    if exact_domain_match:
        return F.coalesce(~F.parse_url(url, F.lit("HOST")).isin(list(banlist)), F.lit(True))
    if match_substrings:
        hits = F.filter(F.array(*map(F.lit, banlist)), lambda b: F.contains(url, b))
    else:
        pattern = r"(?<![\p{L}\p{N}_])(" + "|".join(re.escape(b) for b in sorted(banlist, key=len, reverse=True)) + r")(?![\p{L}\p{N}_])"
        hits = F.array_distinct(F.regexp_extract_all(url, F.lit(pattern)))
    return F.coalesce(F.size(hits) < num_banned_substrs, F.lit(True)) | F.col(url_col).isNull()


def url_domain_filter(df: DataFrame, banned: DataFrame, url_col: str = "url", domain_col: str = "domain") -> DataFrame:
    """An anti join for domain lists of any length; AQE broadcasts the list only where its measured size allows."""
    domain, name = F.lower(F.parse_url(F.col(f"`{url_col}`"), F.lit("HOST"))), fresh(df, "banned_domain")
    return df.join(banned.select(F.lower(domain_col).alias(name)).distinct(), domain == F.col(name), "left_anti")
