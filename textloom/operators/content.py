"""Row predicates over the text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.registry import computed, fresh, keep, step

STOP_WORDS = ("and", "be", "have", "of", "that", "the", "to", "with")
BULLETS = "[●•*-]"
#: Bullets of the page rules: the web variant's two, and all that other word models count.
FEW_BULLETS, ALL_BULLETS = "[•-]", "[•‣▶◀◦■□▪▫–●-]"
CODE_EXTENSIONS = (".py", ".java", ".c", ".cpp", ".h", ".js", ".ts", ".go", ".rs", ".rb", ".php", ".scala", ".sh", ".md", ".sql", ".html", ".css")
POLICY = ("cookie policy", "use cookies", "use of cookies", "uses cookies", "privacy policy", "terms of use")


@step("filter")
def github_extension_filter(text: Column, filename_key: str = "filename", allowed_extensions: list[str] = CODE_EXTENSIONS) -> Column:
    name = F.col(filename_key)
    return F.coalesce(F.exists(F.array(*map(F.lit, allowed_extensions)), lambda e: F.endswith(name, e)), F.lit(False))


@step("filter")
def line_length_filter(text: Column, length_type: str = "max", max_length: int = 1000) -> Column:
    ls = T.split_lines(text)
    n = F.array_max(F.transform(ls, F.length)) if length_type == "max" else T.mean_length(ls)
    return F.coalesce(n <= max_length, F.lit(False))


@step("filter")
def alphanumeric_char_ratio_filter(text: Column, min_ratio: float = 0.25) -> Column:
    kept = F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]", ""))
    return F.when(F.length(text) > 0, kept / F.length(text) >= min_ratio).otherwise(F.lit(False))


@step("filter")
def alphabetic_characters_to_tokens_filter(text: Column, max_ratio: float = 1.5, count=None) -> Column:
    """Letters a token; ``count`` maps a text column to its token count (white space by default, or any tokenizer's UDF)."""
    n = count(text) if count else F.size(T.tokens(text))
    return F.when(n > 0, T.count_of(text, r"\p{L}") / n >= max_ratio).otherwise(F.lit(False))


@step("filter")
def page_length_filter(text: Column, length_type: str = "word", min_length: int = 1, max_length: float = float("inf"), model: str = "split", ignore_punctuation: bool = True) -> Column:
    n = {
        "word": lambda: F.size(T.words(text, model, ignore_punctuation)),
        "sentence": lambda: T.n_sentences(text),
        "line": lambda: F.size(T.paragraphs(text)),
        "paragraph": lambda: F.size(T.paragraphs(text, "\\n\\n")),
        "char": lambda: F.length(text),
    }[length_type]()
    return T.within(n, min_length, max_length)


@step("filter")
def substring_filter(text: Column, banlist: list[str] | str | None = None, location: str = "any", case_sensitive: bool = False, exact_word: bool = False, banlist_file: str | None = None) -> Column:
    """Removes texts in which one of the patterns (regular expressions; of a file too) is found."""
    banlist = T.read_list(banlist, banlist_file)
    pattern = "(?:" + "|".join(b if case_sensitive else b.lower() for b in banlist) + ")"
    if exact_word:
        pattern = rf"(?<![\p{{L}}\p{{N}}_]){pattern}(?![\p{{L}}\p{{N}}_])"
    pattern = {"any": pattern, "prefix": rf"\A{pattern}", "suffix": rf"{pattern}\z"}[location]
    return ~(text if case_sensitive else F.lower(text)).rlike(pattern)


@step("filter")
def bullet_count_filter(text: Column, max_bullet_start_ratio: float = 0.9) -> Column:
    return T.let(T.paragraphs(text), lambda ls: F.size(F.filter(ls, lambda x: x.rlike(rf"\A{BULLETS}"))) <= max_bullet_start_ratio * F.size(ls))


@step("filter")
def ellipsis_count_filter(text: Column, max_ellipsis_end_ratio: float = 0.3) -> Column:
    return T.let(T.paragraphs(text), lambda ls: F.size(F.filter(ls, lambda x: x.rlike(r"(\.\.\.|\. \. \.|…)\z"))) <= max_ellipsis_end_ratio * F.size(ls))


@step("filter")
def stop_word_filter(text: Column, count_unique: bool = False, min_stop_word: int = 2) -> Column:
    ws, stop = T.tokens(F.lower(text)), F.array(*map(F.lit, STOP_WORDS))
    hits = F.array_intersect(ws, stop) if count_unique else F.filter(ws, lambda w: w.isin(*STOP_WORDS))
    return F.size(hits) >= min_stop_word


@step("filter")
def word_length_filter(text: Column, min_length: float = 0, max_length: float = float("inf"), model: str = "split") -> Column:
    return F.coalesce(T.within(T.mean_length(T.words(text, model, False)), min_length, max_length), F.lit(False))


@step("filter")
def symbol_ratio_filter(text: Column, max_symbol_to_word_ratio: float = 0.1) -> Column:
    share = T.let(F.size(T.tokens(text)), lambda n: F.when(n > 0, T.count_of(text, r"#|\.\.\.|\. \. \.|…") / n))
    return F.coalesce(share <= max_symbol_to_word_ratio, F.lit(False))


@step("filter")
def word_removal_ratio_filter(text: Column, prev_word_count_key: str, new_word_count_key: str, max_removed_ratio: float = 0.05) -> Column:
    old, new = F.col(prev_word_count_key), F.col(new_word_count_key)
    return F.when(old > 0, (old - new) / old <= max_removed_ratio).otherwise(F.lit(False))


@step("filter")
def alphabetic_word_ratio_filter(text: Column, max_ratio: float = 0.2, model: str = "split") -> Column:
    return F.coalesce(T.share(T.words(text, model, False), lambda w: ~w.rlike(r"\p{L}")) <= max_ratio, F.lit(False))


@step("filter")
def min_sentences_filter(text: Column, min_sentences: int = 3) -> Column:
    return T.total(T.paragraphs(text), T.n_sentences) >= min_sentences


@step("filter")
def high_quality_ratio_filter(text: Column, threshold: float = 0.75, min_words: int = 10) -> Column:
    """Share of characters that stand in lines of so many words."""
    return F.coalesce(_long_line_share(text, min_words) >= threshold, F.lit(False))


def _long_line_share(text: Column, min_words: int) -> Column:
    long = lambda ls: T.total(F.filter(ls, lambda x: F.size(T.tokens(x)) >= min_words))
    return T.let(T.full_lines(text), lambda ls: F.when(T.total(ls) > 0, long(ls) / T.total(ls)))


@step("filter")
def line_punct_ratio_filter(text: Column, line_punct_thr: float = 0.12, line_punct_exclude_zero: bool = False, stop_chars: list[str] | None = None) -> Column:
    """Share of lines whose last character, white space included, ends a sentence; a text without lines is removed."""
    ends = (lambda x: F.exists(F.array(*map(F.lit, stop_chars)), lambda e: F.endswith(x, e))) if stop_chars else (lambda x: x.rlike(T.TERMINAL))
    share = T.share(T.full_lines(text), ends)
    ok = share >= line_punct_thr
    return F.coalesce(ok | (share == 0) if line_punct_exclude_zero else ok, F.lit(False))


@step("filter")
def short_line_ratio_filter(text: Column, short_line_thr: float = 0.67, short_line_length: int = 30) -> Column:
    return F.coalesce(T.share(T.full_lines(text), lambda x: F.length(x) <= short_line_length) <= short_line_thr, F.lit(False))


@step("filter")
def char_dup_ratio_filter(text: Column, char_duplicates_ratio: float = 0.1) -> Column:
    """Characters in repeats of lines, first copies apart, over characters without line feeds."""
    some = F.length(F.replace(text, F.lit("\n"), F.lit("")))
    ratio = T.let(T.full_lines(text), lambda ls: F.when(F.size(ls) > 0, _repeated_chars(ls) / some))
    return F.coalesce(ratio <= char_duplicates_ratio, F.lit(False))


def _repeated_chars(ls: Column) -> Column:
    return T.total(ls) - T.total(F.array_distinct(ls))


@step("filter")
def list_ratio_filter(text: Column, new_line_ratio: float = 0.3, model: str = "split", words: Column | None = None) -> Column:
    """Line feeds a word; ``words`` are words made before."""
    n = F.size(T.words(text, model, False) if words is None else words)
    return F.coalesce(T.let(n, lambda n: F.when(n > 0, T.count_of(text, "\n") / n)) <= new_line_ratio, F.lit(False))


@step("filter")
def lorem_ipsum_filter(text: Column) -> Column:
    return ~F.contains(F.lower(text), F.lit("lorem ipsum"))


def fineweb_quality_reason(text: Column, line_punct_thr: float = 0.12, line_punct_exclude_zero: bool = False, short_line_thr: float = 0.67, short_line_length: int = 30, char_duplicates_ratio: float = 0.1, new_line_ratio: float = 0.3, high_quality_ratio_value: float = -1, high_quality_min_line_num: int = 10, model: str = "split", stop_chars: list[str] | None = None, words: Column | None = None) -> Column:
    """Null for a text that passes, else the first reason; punctuation and short lines count only below the quality ratio."""
    why = F.when(F.size(T.full_lines(text)) == 0, "fineweb_quality_filter_zero_lines")
    if high_quality_ratio_value > 0:
        poor = F.coalesce(_long_line_share(text, high_quality_min_line_num) < high_quality_ratio_value, F.lit(True))
        why = why.when(poor & ~line_punct_ratio_filter(text, line_punct_thr, line_punct_exclude_zero, stop_chars), "line_punct_ratio_filter")
        why = why.when(poor & ~short_line_ratio_filter(text, short_line_thr, short_line_length), "short_line_ratio_filter")
    return why.when(~char_dup_ratio_filter(text, char_duplicates_ratio), "char_dup_ratio_filter").when(~list_ratio_filter(text, new_line_ratio, model, words), "list_ratio_filter")


@step("filter")
def fineweb_quality_filter(text: Column, words: Column | None = None, **kw) -> Column:
    return fineweb_quality_reason(text, words=words, **kw).isNull() & text.isNotNull()


def gopher_quality_reason(text: Column, min_doc_words: int = 50, max_doc_words: int = 100_000, min_avg_word_length: float = 3, max_avg_word_length: float = 10, max_symbol_word_ratio: float = 0.1, max_bullet_lines_ratio: float = 0.9, max_ellipsis_lines_ratio: float = 0.3, max_non_alpha_words_ratio: float = 0.8, min_stop_words: int = 2, model: str = "split", all_bullets: bool = False, whitelist: list[str] | None = None, words: Column | None = None) -> Column:
    """Null for a text that passes, else the name of the first rule that fails; ``words`` are words made before.

    Length rules count words with a character that isn't punctuation, other shares divide by all words. Stop words count as often
    as they occur. With ``whitelist`` its words and those of digits alone count as alphabetic.
    """
    bullets, bullet_reason = (ALL_BULLETS, "bullet_lines_check") if all_bullets else (FEW_BULLETS, "gopher_too_many_bullets")

    def alphabetic(w: Column) -> Column:
        return w.rlike(r"\p{L}") | w.rlike(r"\A\p{Nd}+\z") | w.isin(*whitelist) if whitelist is not None else w.rlike(r"\p{L}")

    def rules(ws: Column, real: Column, ls: Column, mean: Column) -> Column:
        n, n_real, n_lines = F.size(ws), F.size(real), F.size(ls)
        return (
            F.when(n_real < min_doc_words, "gopher_short_doc")
            .when(n_real > max_doc_words, "gopher_long_doc")
            .when(mean < min_avg_word_length, "gopher_below_avg_threshold")
            .when(mean > max_avg_word_length, "gopher_above_avg_threshold")
            .when(F.size(F.filter(ws, lambda w: w.isin(*STOP_WORDS))) < min_stop_words, "gopher_enough_stop_words")
            .when(T.count_of(text, "#") / n > max_symbol_word_ratio, "gopher_too_many_hashes")
            .when(T.count_of(text, r"\.\.\.|…") / n > max_symbol_word_ratio, "gopher_too_many_ellipsis")
            .when(F.size(F.filter(ls, lambda x: x.rlike(rf"\A\s*{bullets}"))) / n_lines > max_bullet_lines_ratio, bullet_reason)
            .when(F.size(F.filter(ls, lambda x: x.rlike(r"(\.\.\.|…)\s*\z"))) / n_lines > max_ellipsis_lines_ratio, "gopher_too_many_end_ellipsis")
            .when(F.size(F.filter(ws, alphabetic)) / n < max_non_alpha_words_ratio, "gopher_below_alpha_threshold")
        )

    def lines_of(ws: Column, real: Column) -> Column:
        return T.let(T.split_lines(text), lambda ls: T.let(T.mean_length(real), lambda mean: rules(ws, real, ls, mean)))

    return T.let(T.words(text, model, False) if words is None else words, lambda ws: T.let(F.filter(ws, lambda w: w.rlike(T.SYMBOL_FREE)), lambda real: lines_of(ws, real)))


@step("filter")
def fineweb_gopher_quality_filter(text: Column, words: Column | None = None, **kw) -> Column:
    return gopher_quality_reason(text, words=words, **kw).isNull() & text.isNotNull()


def c4_lines(text: Column, split_paragraph: bool = True, remove_citations: bool = True, filter_no_terminal_punct: bool = False, min_words_per_line: int = 3, max_word_length: int = 1000, filter_lorem_ipsum: bool = True, filter_javascript: bool = True, filter_curly_bracket: bool = True, filter_policy: bool = True) -> Column:
    """Lines, or sentences without ``split_paragraph``, as (line, state): keep, skip, or the reason for which the page goes.

    A line is judged in this order: a word too long, no sentence end, too few words, lorem ipsum, javascript, bracket, policy. Words
    are counted before citations are cut.
    """
    given = F.transform(T.split_lines(text) if split_paragraph else T.split_into_parts(text, "sentences"), T.strip)

    def judged(x: Column) -> Column:
        line = F.regexp_replace(x, r"\[(citation needed|edit|\d*)\]", "") if remove_citations else x
        low = F.lower(line)
        state = F.when(F.exists(T.tokens(x), lambda w: F.length(w) > max_word_length), "skip") if max_word_length != -1 else F.when(F.lit(False), "skip")
        if filter_no_terminal_punct:
            state = state.when(~line.rlike(r"[.?!\"']\z") | line.rlike(r"\.\.\.\z"), "skip")
        state = state.when(F.size(T.tokens(x)) < min_words_per_line, "skip")
        if filter_lorem_ipsum:
            state = state.when(F.contains(low, F.lit("lorem ipsum")), "lorem_ipsum")
        if filter_javascript:
            state = state.when(F.contains(low, F.lit("javascript")), "skip")
        if filter_curly_bracket:
            state = state.when(F.contains(line, F.lit("{")), "curly_bracket")
        if filter_policy:
            state = state.when(low.rlike("|".join(POLICY)), "skip")
        return F.struct(line.alias("line"), state.otherwise("keep").alias("state"))

    return F.transform(given, judged)


def c4_text(judged: Column, split_paragraph: bool = True) -> Column:
    """The kept lines, joined."""
    return T.strip(F.array_join(F.transform(F.filter(judged, lambda x: x["state"] == "keep"), lambda x: x["line"]), "\n" if split_paragraph else " "))


def c4_reason(judged: Column, min_num_sentences: int = 5, split_paragraph: bool = True) -> Column:
    """The first line's reason for which the page goes, else too few sentences in the kept lines, else null; -1 takes any number."""
    why = F.get(F.filter(judged, lambda x: ~x["state"].isin("keep", "skip")), F.lit(0))["state"]
    kept = F.transform(F.filter(judged, lambda x: x["state"] == "keep"), lambda x: x["line"])
    n = T.total(kept, T.n_sentences) if split_paragraph else F.size(kept)
    return F.coalesce(why, F.when(n < min_num_sentences, "too_few_sentences"))


@step("global")
def fineweb_c4_filter(df, text_col: str = "text", min_num_sentences: int = 5, split_paragraph: bool = True, annotate: bool = False, **kw):
    """Line rules rewrite the text, page rules drop the row (or name the reason where ``annotate`` holds)."""
    name, text = fresh(df, "judged"), F.col(f"`{text_col}`")
    got = computed(df, name, c4_lines(text, split_paragraph, **kw))
    judged = F.col(name)
    why = c4_reason(judged, min_num_sentences, split_paragraph)
    kept = c4_text(judged, split_paragraph)
    if annotate:
        marked = keep(got, why.isNull() & text.isNotNull(), why, True)
        return marked.withColumn(text_col, F.when(why.isNull(), kept).otherwise(text)).drop(name)
    return got.filter(why.isNull()).withColumn(text_col, kept).drop(name).filter(F.col(f"`{text_col}`") != "")
