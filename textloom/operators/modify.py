"""Projections that rewrite the text."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators.content import POLICY
from textloom.registry import WORDS, computed, fresh, step

COUNTED = "bookmarks|comments|downloads|downvotes|followers|likes|quotes|reposts|retweets|shares|upvotes|views"
COUNTER = rf"\A[^\p{{L}}\p{{N}}_]*[0-9][0-9.,]*[kmb]?\s+({COUNTED})[^\p{{L}}\p{{N}}_]*\z"
TLDS = ("com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "eu", "co", "dev", "app")
CITATION = r"\[([0-9]*|citation needed|edit)\]"
_ATOM, _HOST = "[a-zA-Z0-9_!#$%&'*/=?^`{|}~+-]+", "[0-9a-zA-Z]([0-9a-zA-Z-]*[0-9a-zA-Z])?"
EMAIL = rf"{_ATOM}(\.{_ATOM})*@({_HOST}\.)+{_HOST}"
_SCHEME, _REST = "(ftp://|http://|https://)?", "[a-zA-Z0-9@:%~#?&/=().,_+-]*"
IPV4 = rf"\s{{0,10}}\b{_SCHEME}([0-9]{{1,3}}\.){{3}}[0-9]{{1,3}}{_REST}"
PHONE = r"(\+[0-9]{1,3}[\s-]?[0-9]{3}[\s.-]?[0-9]{3,4}[\s.-]?[0-9]{4}|[0-9]{3}[-.\s]?[0-9]{3}[-.\s]?[0-9]{4}|\b[0-9]{7,}\b)\b"


#: A line of white space, not an empty one.
BLANK_LINE = r"(?:\A|\n)[ \t\x0B\f\r]+(?:\n|\z)"


def web_address(tlds: list[str] = TLDS) -> str:
    ends = "|".join(re.escape(t.lstrip(".")) for t in tlds)
    return rf"\s{{0,10}}{_SCHEME}[a-zA-Z0-9@:%.~#=_+-]{{1,256}}\.({ends})\b{_REST}"


def _lines_where(text: Column, keep, trim: bool = False) -> Column:
    joined = F.array_join(F.filter(T.lines(text), keep), "\n")
    return T.strip(joined) if trim else joined


# LaTeX
@step("modifier")
def arxiv_appendix_modifier(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(begin\{(references|thebibliography|REFERENCES)\}|bibliography\{.*?\}|appendix).*\z", "")


@step("modifier")
def arxiv_comment_modifier(text: Column, remove_multiline: bool = False) -> Column:
    """Comment lines, then comments within lines with the character before them."""
    x = F.regexp_replace(F.regexp_replace(text, r"(?m)^%.*\n?", ""), r"(?m)[^\\]%.+$", "")
    return F.regexp_replace(x, r"(?s)\\begin\{comment\}.*?\\end\{comment\}", "") if remove_multiline else x


_NAME, _VALUE = r"(\\[0-9A-Za-z]+)", r"\{(.*?)\}[ \t]*$"
_NEWCOMMAND = re.compile(rf"\\newcommand\*?\{{{_NAME}\}}{_VALUE}", re.M)
_DEF = re.compile(rf"\\def[ \t]*{_NAME}[ \t]*{_VALUE}", re.M)


def expand_macros(text: str) -> str:
    """Replaces macros without arguments by their values, in their definitions too."""
    macros = {m[1]: m[2] for p in (_NEWCOMMAND, _DEF) for m in p.finditer(text)}
    for name, value in macros.items():
        text = re.sub(re.escape(name) + r"(?=[^a-zA-Z0-9])", lambda _, v=value: v, text)
    return text


@step("modifier")
def arxiv_macro_modifier(text: Column) -> Column:
    @F.arrow_udf("string")
    def run(arr: pa.Array) -> pa.Array:
        return pa.array([t if t is None or "\\" not in t else expand_macros(t) for t in arr.to_pylist()], pa.string())

    return run(text)


@step("modifier")
def arxiv_section_strip_modifier(text: Column) -> Column:
    """From the first section command on; nothing without one."""
    head = r"\\(chapter|part|section|subsection|subsubsection)\b\*?(\[[^\]]*\])?\{"
    at = F.regexp_instr(text, F.lit(head))
    return F.when(at > 0, F.substr(text, at)).otherwise(F.when(text.isNotNull(), ""))


# Questions and answers
def _unlist(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"<li>|<ol>", "\n*"), r"</li>|</ol>|<ul>|</ul>", "")


def _answers(change) -> Column:
    return F.transform("answers", lambda a: F.struct(change(a["text"]).alias("text"), a["score"].alias("score")))


@step("global")
def stackexchange_list_modifier(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.withColumn("question", F.struct(_unlist(F.col("question.text")).alias("text"))).withColumn("answers", _answers(_unlist))


@step("global")
def stackexchange_answer_sort_modifier(df: DataFrame, text_col: str = "text", descending: bool = True) -> DataFrame:
    """Stable by score, a missing one being 0."""
    sign = -1 if descending else 1
    keyed = F.transform("answers", lambda a, i: F.struct((F.coalesce(a["score"], F.lit(0)) * sign).alias("k"), i.alias("i"), a.alias("a")))
    return df.withColumn("answers", F.transform(F.array_sort(keyed), lambda x: x["a"]))


def html_text(c: Column) -> Column:
    """Text of an HTML fragment: tags go, the common entities are read."""
    x = F.regexp_replace(F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", ""), r"<[^<>]*>", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(char))
    return x


@step("global")
def stackexchange_html_extraction_modifier(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.withColumn("question", F.struct(html_text(F.col("question.text")).alias("text"))).withColumn("answers", _answers(html_text))


@step("global")
def stackexchange_qa_formatter(df: DataFrame, text_col: str = "text", remove_qa: bool = False) -> DataFrame:
    said = F.array_join(F.transform(F.coalesce("answers", F.array().cast("array<struct<text:string,score:int>>")), lambda a: F.concat(F.lit("\nA: "), a["text"])), "")
    out = df.filter(F.col("question.text").isNotNull()).withColumn(text_col, F.concat(F.lit("Q: "), F.col("question.text"), said))
    return out.drop("question", "answers") if remove_qa else out


# Columns
URL_PLACES = ("WARC-Target-URI", "warc-target-uri", "warc_target_uri", "target_uri")


@step("global")
def move_url_modifier(df: DataFrame, text_col: str = "text", target: str = "url") -> DataFrame:
    """The first target address that isn't empty, from the ``metadata`` struct or the row."""
    found = []
    if "metadata" in df.columns and hasattr(df.schema["metadata"].dataType, "names"):
        found += [F.col(f"metadata.`{k}`") for k in URL_PLACES if k in df.schema["metadata"].dataType.names]
    found += [F.col(f"`{k}`") for k in URL_PLACES if k in df.columns]
    return df.withColumn(target, F.coalesce(*[F.nullif(c, F.lit("")) for c in found])) if found else df


@step("global")
def key_name_modifier(df: DataFrame, text_col: str = "text", old_key: str = "content", new_key: str = "text", allow_overwrite: bool = False) -> DataFrame:
    if new_key in df.columns and not allow_overwrite:
        return df
    return df.drop(new_key).withColumnRenamed(old_key, new_key)


BLOCK = r"(?i)</?(p|div|h[1-6]|li|ul|ol|table|tr|td|th|article|section|header|footer|nav|blockquote|pre|body|html|aside|main|title)\b[^<>]*>"


@step("modifier")
def html_content_extraction_modifier(text: Column, min_length: int = 70, max_link_share: float = 0.2) -> Column:
    """Paragraphs that are long and hardly linked, joined by blank lines (no stop list)."""
    x = F.regexp_replace(text, r"(?is)<(script|style|noscript|title|template)\b.*?</\1\s*>|<!--.*?-->", "")
    blocks = F.split(F.regexp_replace(x, BLOCK, "\u0001"), "\u0001")
    shown = lambda b: T.strip(F.regexp_replace(html_text(b), r"\s+", " "))
    linked = lambda b: T.total(F.regexp_extract_all(b, F.lit(r"(?is)<a\b[^<>]*>(.*?)</a>")), lambda a: F.length(shown(a)))
    good = F.filter(blocks, lambda b: (F.length(shown(b)) >= min_length) & (linked(b) <= max_link_share * F.length(shown(b))))
    return F.array_join(F.transform(good, shown), "\n\n")


# Lines
@step("modifier")
def substring_line_modifier(text: Column, banlist: list[str] | str | None = None, case_sensitive: bool = False, location: str = "any", max_length: int | None = None, remove_substring_only: bool = False, banlist_file: str | None = None) -> Column:
    """Drops lines with a pattern (regular expressions) or cuts the pattern; only lines of up to ``max_length`` words."""
    banlist = T.read_list(banlist, banlist_file)
    core = "(?:" + "|".join(banlist) + ")"
    pattern = {"any": rf"\s?{core}", "prefix": rf"^{core}\s?", "suffix": rf"\s?{core}$"}[location]
    pattern = pattern if case_sensitive else f"(?iu){pattern}"
    short = (lambda x: F.size(T.tokens(x)) <= max_length) if max_length is not None else (lambda x: F.lit(True))
    # What a line has the text has, unless the pattern looks around or holds on to what it took.
    plain = not re.search(r"\\[AZzGQ]|\(\?|[+*?}]\+", core.replace("(?:", "", 1))
    anywhere = (f"(?m){core}" if case_sensitive else f"(?ium){core}") if plain else ""
    if not remove_substring_only:
        return T.if_found(text, anywhere, _lines_where(text, lambda x: ~(short(x) & x.rlike(pattern)), trim=True), T.strip(text))
    cut = F.transform(T.lines(text), lambda x: F.when(short(x), F.regexp_replace(x, pattern, "")).otherwise(x))
    both = F.arrays_zip(T.lines(text).alias("old"), cut.alias("new"))
    kept = F.filter(both, lambda p: ~(short(p["old"]) & (p["old"] != "") & (T.strip(p["new"]) == "")))
    changed = T.strip(F.array_join(F.transform(kept, lambda p: p["new"]), "\n"))
    return F.when(text.rlike(anywhere) | text.rlike(BLANK_LINE), changed).otherwise(T.strip(text))


@step("modifier")
def short_line_modifier(text: Column, line_ratio: float = 1 / 3, edge_words: int = 5, middle_words: int = 2) -> Column:
    """In each third a short line stays only before a long one or at the third's end."""

    def chosen(ls: Column, sizes: Column) -> Column:
        n, a = F.size(ls), F.floor(F.size(ls) * line_ratio).cast("int")
        b = n - a

        def stays(x: Column, i: Column) -> Column:
            most = F.when((i < a) | (i >= b), edge_words).otherwise(middle_words)
            last = (i + 1 == n) | (i + 1 == a) | (i + 1 == b)
            return (F.get(sizes, i) > most) | last | F.coalesce(F.get(sizes, i + 1) > most, F.lit(False))

        return F.filter(ls, stays)

    full = F.filter(T.lines(text), lambda x: T.strip(x) != "")
    kept = T.let(full, lambda ls: T.let(F.transform(ls, lambda x: F.size(T.tokens(x))), lambda sizes: chosen(ls, sizes)))
    return T.strip(F.array_join(kept, "\n"))


@step("modifier")
def punctuation_line_modifier(text: Column, remove_ellipses: bool = False) -> Column:
    ends = lambda x: (x == "") | x.rlike(r'[.!?"…]\s*\z')
    return _lines_where(text, (lambda x: ends(x) & ~x.rlike(r"(\.\.\.|…)\s*\z")) if remove_ellipses else ends)


@step("modifier")
def line_length_modifier(text: Column, min_length: int = 0, max_length: float = float("inf")) -> Column:
    n = lambda x: F.size(T.tokens(x))
    return _lines_where(text, lambda x: (x == "") | ((n(x) >= min_length) & ((n(x) <= max_length) if max_length != float("inf") else F.lit(True))))


@step("modifier")
def word_length_modifier(text: Column, max_length: int = 1000, model: str = "split") -> Column:
    changed = _lines_where(text, lambda x: F.forall(T.words(x, model, False), lambda w: F.length(w) <= max_length))
    return T.if_found(text, rf"\S{{{max_length + 1}}}", changed, text) if model == "split" else changed


@step("modifier")
def uppercase_ratio_line_modifier(text: Column, max_ratio: float = 0.5) -> Column:
    return _lines_where(text, lambda x: (x == "") | (F.length(x) - F.length(F.regexp_replace(x, r"\p{Lu}+", "")) <= max_ratio * F.length(x)), trim=True)


@step("modifier")
def numeric_ratio_line_modifier(text: Column, max_ratio: float = 1.0) -> Column:
    return _lines_where(text, lambda x: (x == "") | (F.length(x) - F.length(F.regexp_replace(x, r"\p{Nd}+", "")) <= max_ratio * F.length(x)), trim=True)


@step("modifier")
def citation_removal_modifier(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("[")), F.regexp_replace(text, CITATION, "")).otherwise(text)


@step("modifier")
def url_removal_modifier(text: Column, tlds: list[str] | None = None, tlds_file: str | None = None) -> Column:
    """Web addresses under the given top-level domains (of a file too), and IPv4 addresses, with the white space before them."""
    tlds = T.read_list(tlds, tlds_file) or TLDS
    ends = "|".join(re.escape(t.lstrip(".")) for t in tlds)
    addresses = T.if_found(text, rf"\.({ends})\b", F.regexp_replace(text, web_address(tlds), ""), text)
    return T.let(addresses, lambda x: T.if_found(x, r"[0-9]\.[0-9]{1,3}\.[0-9]", F.regexp_replace(x, IPV4, ""), x))


@step("modifier")
def email_and_phone_removal_modifier(text: Column) -> Column:
    mails = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, r"\b" + EMAIL, "")).otherwise(text)
    return T.let(mails, lambda x: T.if_found(x, r"[0-9]{3}[\s.-]?[0-9]{3}", F.regexp_replace(x, PHONE, ""), x))


def bad_words_pattern(words: list[str], language: str = "en") -> str:
    core = "(?:" + "|".join(re.escape(w) for w in words) + ")"
    return f"(?iu){core}" if language == "zh" else rf"(?iu)(?<![\p{{L}}\p{{N}}_]){core}(?![\p{{L}}\p{{N}}_])"


@step("modifier")
def bad_words_modifier(text: Column, banlist: list[str] | None = None, banned_language: str = "en", remove_word: bool = False, banned_file: str | None = None) -> Column:
    """Cuts the words where ``remove_word`` holds; else texts stay as they are, and ``bad_words_hits`` counts those with one."""
    return F.regexp_replace(text, bad_words_pattern(T.read_list(banlist, banned_file), banned_language), "") if remove_word else text


def bad_words_hits(df: DataFrame, banlist: list[str], banned_language: str = "en", text_col: str = "text") -> DataFrame:
    """(documents, hits): documents in all, and those with a banned word."""
    hit = F.col(text_col).rlike(bad_words_pattern(banlist, banned_language))
    return df.agg(F.count("*").alias("documents"), F.coalesce(F.sum(hit.cast("long")), F.lit(0)).alias("hits"))


@step("modifier")
def counter_line_modifier(text: Column) -> Column:
    changed = _lines_where(text, lambda x: ~F.lower(x).rlike(COUNTER), trim=True)
    return T.if_found(F.lower(text), rf"[0-9][kmb]?\s+({COUNTED})|[0-9][.,]+[kmb]?\s+({COUNTED})", changed, T.strip(text))


@step("modifier", drop_empty=False)
def within_page_dedup(text: Column, granularity: str = "line", normalize: bool = True) -> Column:
    """First copies of lines or paragraphs; blank ones all stay."""
    sep = "\n" if granularity == "line" else "\n\n"
    parts = F.split(text, sep.replace("\n", "\\n"))
    keys = F.transform(parts, lambda x: F.lower(T.strip(x))) if normalize else parts

    def first(ks: Column) -> Column:
        firsts = F.map_from_entries(F.transform(F.array_distinct(ks), lambda k: F.struct(k.alias("key"), F.array_position(ks, k).alias("value"))))
        return T.let(firsts, lambda m: F.filter(parts, lambda x, i: (F.get(ks, i) == "") | (m[F.get(ks, i)] == i + 1)))

    return F.array_join(T.let(keys, first), sep)


@step("modifier", drop_empty=False)
def newline_removal_modifier(text: Column, max_consecutive: int = 2) -> Column:
    return F.regexp_replace(text, "\\n{%d,}" % (max_consecutive + 1), "\n" * max_consecutive)


@step("global")
def split_lines_modifier(df: DataFrame, text_col: str = "text", delimiter: str = "\n") -> DataFrame:
    if df.schema[text_col].dataType.typeName() == "array":
        return df
    return df.filter(F.col(text_col) != "").withColumn(text_col, F.split(text_col, re.escape(delimiter)))


@step("global")
def join_lines_modifier(df: DataFrame, text_col: str = "text", delimiter: str = "\n") -> DataFrame:
    if df.schema[text_col].dataType.typeName() != "array":
        return df
    return df.filter(F.size(text_col) > 0).withColumn(text_col, F.array_join(text_col, delimiter))


def line_is_removed(line: Column, max_uppercase_ratio: float, min_words: int) -> Column:
    def poor(low: Column) -> Column:
        script = F.contains(low, F.lit("javascript")) & low.rlike("enable|disable|require|activate|browser")
        shouting = F.length(line) - F.length(F.regexp_replace(line, r"\p{Lu}+", "")) > max_uppercase_ratio * F.length(line)
        return (low == "") | (F.size(T.tokens(low)) < min_words) | script | low.rlike("|".join(POLICY)) | shouting | low.rlike(r"\A\p{Nd}+\z") | low.rlike(COUNTER)

    return T.let(F.lower(T.strip(line)), poor)


def line_removal(text: Column, max_uppercase_ratio: float = 0.99, min_word_cnt_per_line: int = 2) -> Column:
    return _lines_where(text, lambda x: ~line_is_removed(x, max_uppercase_ratio, min_word_cnt_per_line))


@step("global")
def line_removal_modifier(df: DataFrame, text_col: str = "text", min_word_cnt_per_line: int = 2, max_uppercase_ratio: float = 0.99, max_removed_ratio: float = -1) -> DataFrame:
    """Drops poor lines; a text that loses more than ``max_removed_ratio`` of its words, or everything, goes."""
    text = F.col(text_col)
    new = fresh(df, "new_text")
    out = computed(df, new, line_removal(text, max_uppercase_ratio, min_word_cnt_per_line), drop_empty=True)
    if max_removed_ratio > 0:
        all_ = F.size(T.tokens(text))
        out = out.filter((all_ == 0) | ((all_ - F.size(T.tokens(F.col(new)))) <= max_removed_ratio * all_))
    return out.withColumn(text_col, F.col(new)).drop(new)


@step("global")
def cache_split_words_modifier(df: DataFrame, text_col: str = "text", model: str = "split") -> DataFrame:
    """Words of the text as it is now, which later rules read from the column ``words`` until it is dropped."""
    return computed(df, WORDS, T.words(F.col(text_col), model, False))


@step("global")
def uncache_split_words_modifier(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.drop(WORDS)
