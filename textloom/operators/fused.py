"""The fused quality chain: line removal, repetition, page quality and line quality in one plan, the first failure named.

It differs from the single steps: lengths are bytes, shares of repeated lines divide by distinct lines, lines need three words,
there are more bullet signs, and the punctuation and short-line rules always hold. Words are counted once for all rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import modify, repetition
from textloom.operators.content import STOP_WORDS
from textloom.registry import computed, fresh, step

BULLETS = "[●•*·‣▪▫◦◆◇■□–-]"


def repeated_share(parts: Column, by_bytes: bool) -> Column:
    """Repeats beyond first copies, over distinct parts (or over all bytes)."""
    one = F.array_distinct(parts)
    if by_bytes:
        return F.when(F.size(parts) > 0, (T.total(parts, F.octet_length) - T.total(one, F.octet_length)) / T.total(parts, F.octet_length))
    return F.when(F.size(parts) > 0, (F.size(parts) - F.size(one)) / F.size(one))


def fused_reason(text: Column, ws: Column, shares: Column) -> Column:
    """First failure of a text with its words and n-gram shares, null for none."""
    return T.let(T.paragraphs(text), lambda ls: T.let(T.paragraphs(text, "\\n\\n"), lambda ps: _first_failure(text, ws, shares, ls, ps)))


def _first_failure(text: Column, ws: Column, shares: Column, ls: Column, ps: Column) -> Column:
    why = F.when(F.size(ws) == 0, "empty")
    for parts, name in ((ls, "line"), (ps, "paragraph")):
        why = why.when(repeated_share(parts, False) > 0.3, f"repetition_{name}").when(repeated_share(parts, True) > 0.2, f"repetition_{name}_bytes")
    for n, most in (repetition.TOP | repetition.ALL).items():
        why = why.when(F.get(shares, F.lit(n - 2)) > most, f"repetition_{n}_gram")
    n, some = F.size(ws), F.greatest(F.size(ls), F.lit(1))
    mean = T.total(ws, F.octet_length) / n
    return (
        why.when(n < 50, "quality_short")
        .when(n > 100_000, "quality_long")
        .when((mean < 3) | (mean > 10), "quality_word_length")
        .when(T.count_of(text, "#") / n > 0.1, "quality_hashes")
        .when(T.count_of(text, r"\.\.\.|…") / n > 0.1, "quality_ellipsis")
        .when(F.size(F.filter(ls, lambda x: x.rlike(rf"\A{BULLETS}"))) / some > 0.9, "quality_bullets")
        .when(F.size(F.filter(ls, lambda x: x.rlike(r"(\.\.\.|…)\z"))) / some > 0.3, "quality_end_ellipsis")
        .when(F.size(F.filter(ws, lambda w: w.rlike(r"\p{L}"))) / n < 0.8, "quality_alphabetic")
        .when(F.size(F.filter(ws, lambda w: w.isin(*STOP_WORDS))) < 2, "quality_stop_words")
        .when(T.share(ls, lambda x: x.rlike(T.TERMINAL)) < 0.12, "line_punctuation")
        .when(T.share(ls, lambda x: F.octet_length(x) <= 30) > 0.67, "line_short")
        .when((T.total(ls, F.octet_length) - T.total(F.array_distinct(ls), F.octet_length)) / F.greatest(F.octet_length(text), F.lit(1)) > 0.1, "line_duplicates")
        .when(T.count_of(text, "\n") / n > 0.3, "line_list")
    )


@step("global")
def fused_quality(df: DataFrame, text_col: str = "text", drop: bool = True) -> DataFrame:
    """Rewrites the text by line removal and drops what fails, or marks it in ``reason``."""
    text = F.col(f"`{text_col}`")
    kept = computed(df, text_col, F.coalesce(modify.line_removal(T.strip(text), 0.99, 3), F.lit("")))
    words, shares = fresh(df, "fused_words"), fresh(df, "fused_shares")
    both = computed(kept, words, T.words(text, "regex"))
    marked = both.withColumn(shares, repetition.ngram_shares(text, in_bytes=True)).withColumn("reason", fused_reason(text, F.col(words), F.col(shares))).drop(words, shares)
    return marked.filter("reason IS NULL").drop("reason") if drop else marked


def step_table(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(filter, removed): documents by the family of the rule that failed first, in one pass."""
    return fused_quality(df, text_col, drop=False).groupBy(F.coalesce(F.split_part("reason", F.lit("_"), F.lit(1)), F.lit("kept")).alias("filter")).agg(F.count("*").alias("pages"))
