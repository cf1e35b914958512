"""Every query of the engine's own operators and its SQL equivalent.

Each query runs an operator over whole tables. A filter's query gives its decision for every document, a modifier's the new text.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import aggregate as A
from textloom.operators import content as C
from textloom.operators import dedup, enrich, fused, metadata, modify, ngram_dedup, relational, repetition, sampling, split, tokenize
from textloom.plans import pipeline, presets
from textloom.ship import shipped

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
MOST_BAD = ["casino", "the", "und"]


def add(name: str, f: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = shipped(f)
    if sql:
        SQL[name] = sql


def _table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        spread = spark.sparkContext.defaultParallelism
        # One small file is one partition: spread the CPU-bound work. Large inputs come in many splits and aren't moved.
        return df.repartition(spread) if name in ("documents", "pages") and df.rdd.getNumPartitions() < spread // 2 else df

    return read


documents, pages, benchmark, labels, conversations, events = map(_table, ("documents", "pages", "benchmark", "labels", "conversations", "events"))


# DuckDB pieces
def strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A\s+|\s+\z', '', 'g')"


def toks(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> '')"


def pars(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, chr(10)), lambda p: {strip('p')}), lambda p: p <> '')"


def rows(x: str) -> str:
    return f"string_split({x}, chr(10))"


def total(x: str) -> str:
    return f"coalesce(list_sum(list_transform({x}, lambda s: length(s))), 0)"


def found(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, '{pattern}')"


def keep(name: str, predicate, sql: str, table: Callable = documents, id_col: str = "doc_id", source: str = "documents") -> None:
    add(name, lambda s, d: table(s, d).select(id_col, predicate(F.col("text")).alias("keep")), f"SELECT {id_col}, {sql} AS keep FROM {source}")


def rewrite(name: str, new, sql: str) -> None:
    add(name, lambda s, d: documents(s, d).select("doc_id", new(F.col("text")).alias("new_text")), f"SELECT doc_id, {sql} AS new_text FROM documents")


def lines_where(condition: str) -> str:
    return f"array_to_string(list_filter({rows('text')}, lambda x: {condition}), chr(10))"


# Metadata filters
add(
    "filter_language",
    lambda s, d: documents(s, d).withColumn("language_id", F.create_map("lang", F.lit(0.9))).select("doc_id", metadata.language_filter(F.col("text"), ["en", "de"], threshold=0.65).alias("keep")),
    "SELECT doc_id, lang IN ('en', 'de') AS keep FROM documents",
)
add(
    "filter_language_side_output",
    lambda s, d: metadata.language_filter_v2(documents(s, d).withColumn("language_id", F.create_map("lang", F.lit(0.9))), ["en"], threshold=0.65)[1].select("doc_id", "lang", "source", "n_chars"),
    "SELECT doc_id, lang, source, n_chars FROM documents",
)
add(
    "filter_quality",
    lambda s, d: documents(s, d).join(labels(s, d), "doc_id", "left").select("doc_id", metadata.quality_filter(F.col("text"), "quality", 1, key_must_exist=False).alias("keep")),
    "SELECT doc_id, coalesce(quality, 0) >= 1 AS keep FROM documents LEFT JOIN labels USING (doc_id)",
)
add(
    "filter_url_substring",
    lambda s, d: pages(s, d).select("page_id", metadata.url_substring_filter(F.col("html"), ["utm_", "ref", "th"], num_banned_substrs=2, ignore_chars=["-"]).alias("keep")),
    "SELECT page_id, (contains(replace(lower(url), '-', ''), 'utm_')::int + contains(replace(lower(url), '-', ''), 'ref')::int + contains(replace(lower(url), '-', ''), 'th')::int) < 2 AS keep FROM pages",
)
add(
    "filter_url_domain",
    lambda s, d: metadata.url_domain_filter(pages(s, d), pages(s, d).filter(F.pmod("page_id", F.lit(5)) == 0).select(F.parse_url("url", F.lit("HOST")).alias("domain"))).select("page_id", "url"),
    "SELECT page_id, url FROM pages WHERE lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) NOT IN (SELECT lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) FROM pages WHERE page_id % 5 = 0)",
)
add("sample_random", lambda s, d: documents(s, d).filter(metadata.random_sampling_filter(F.col("text"), 0.1, id_col="doc_id")).select("doc_id"))

# Content filters
keep("filter_line_length_max", lambda t: C.line_length_filter(t, "max", 1000), f"coalesce(list_max(list_transform({rows('text')}, lambda x: length(x))) <= 1000 AND text <> '', false)")
keep("filter_line_length_avg", lambda t: C.line_length_filter(t, "avg", 200), rf"coalesce(list_avg(list_transform(string_split(regexp_replace(text, '\n\z', ''), chr(10)), lambda x: length(x))) <= 200 AND text <> '', false)")
keep("filter_alphanumeric_ratio", lambda t: C.alphanumeric_char_ratio_filter(t, 0.7), r"CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) / length(text) >= 0.7 ELSE false END")
keep("filter_alphabetic_chars_to_tokens", C.alphabetic_characters_to_tokens_filter, rf"CASE WHEN len({toks('text')}) > 0 THEN {found('text', r'\p{L}')} / len({toks('text')}) >= 1.5 ELSE false END")
keep("filter_page_length_words", lambda t: C.page_length_filter(t, "word", 50, 500, ignore_punctuation=False), f"len({toks('text')}) BETWEEN 50 AND 500")
keep("filter_page_length_lines", lambda t: C.page_length_filter(t, "line", 2), f"len({pars('text')}) >= 2")
keep("filter_page_length_chars", lambda t: C.page_length_filter(t, "char", 100, 10_000), "length(text) BETWEEN 100 AND 10000")
keep("filter_substring", lambda t: C.substring_filter(t, ["licen[sc]e", "\\{"]), r"NOT regexp_matches(lower(text), '(?:licen[sc]e|\{)')")
keep("filter_bullets", C.bullet_count_filter, f"len(list_filter({pars('text')}, lambda x: {has('x', '^[●•*-]')})) <= 0.9 * len({pars('text')})")
keep("filter_ellipsis", C.ellipsis_count_filter, f"len(list_filter({pars('text')}, lambda x: {has('x', r'(\.\.\.|\. \. \.|…)\z')})) <= 0.3 * len({pars('text')})")
_stop = ", ".join(f"'{w}'" for w in C.STOP_WORDS)
keep("filter_stop_words", C.stop_word_filter, f"len(list_filter({toks('lower(text)')}, lambda x: x IN ({_stop}))) >= 2")
keep("filter_stop_words_unique", lambda t: C.stop_word_filter(t, True, 4), f"len(list_distinct(list_filter({toks('lower(text)')}, lambda x: x IN ({_stop})))) >= 4")
keep("filter_word_length", lambda t: C.word_length_filter(t, 3, 10), f"CASE WHEN len({toks('text')}) > 0 THEN {total(toks('text'))} / len({toks('text')}) BETWEEN 3 AND 10 ELSE false END")
keep("filter_symbol_ratio", C.symbol_ratio_filter, rf"CASE WHEN len({toks('text')}) > 0 THEN {found('text', r'#|\.\.\.|\. \. \.|…')} / len({toks('text')}) <= 0.1 ELSE false END")
add(
    "filter_word_removal_ratio",
    lambda s, d: documents(s, d).select("doc_id", F.size(T.tokens(F.col("text"))).alias("a"), F.size(T.tokens(modify.citation_removal_modifier(modify.email_and_phone_removal_modifier(F.regexp_replace("text", "[0-9]+ ", ""))))).alias("b")).select("doc_id", C.word_removal_ratio_filter(F.col("a"), "a", "b", 0.01).alias("keep")),
)
keep("filter_alphabetic_words", C.alphabetic_word_ratio_filter, rf"CASE WHEN len({toks('text')}) > 0 THEN len(list_filter({toks('text')}, lambda x: NOT {has('x', r'\p{L}')})) / len({toks('text')}) <= 0.2 ELSE false END")
keep("filter_high_quality_ratio", C.high_quality_ratio_filter, f"coalesce({total(f'list_filter({pars_raw}, lambda x: len({toks(chr(120))}) >= 10)')} / nullif({total(pars_raw)}, 0) >= 0.75, false)" if (pars_raw := f"list_filter({rows('text')}, lambda p: {strip('p')} <> '')") else "")
keep("filter_line_punctuation", C.line_punct_ratio_filter, f"coalesce(len(list_filter({pars_raw}, lambda x: {has('x', T.TERMINAL)})) / nullif(len({pars_raw}), 0) >= 0.12, false)")
keep("filter_line_punctuation_or_none", lambda t: C.line_punct_ratio_filter(t, 0.5, True, [".", "!"]), f"coalesce(len(list_filter({pars_raw}, lambda x: suffix(x, '.') OR suffix(x, '!'))) / nullif(len({pars_raw}), 0) NOT BETWEEN 1e-9 AND 0.4999999, false)")
keep("filter_short_lines", C.short_line_ratio_filter, f"coalesce(len(list_filter({pars_raw}, lambda x: length(x) <= 30)) / nullif(len({pars_raw}), 0) <= 0.67, false)")
_extra_chars = f"({total(pars_raw)} - {total('list_distinct(' + pars_raw + ')')}) / nullif(length(replace(text, chr(10), '')), 0)"
keep("filter_char_duplicates", C.char_dup_ratio_filter, f"coalesce(len({pars_raw}) > 0 AND {_extra_chars} <= 0.1, false)")
keep("filter_list_ratio", lambda t: C.list_ratio_filter(t, 0.02), f"CASE WHEN len({toks('text')}) > 0 THEN (len({rows('text')}) - 1) / len({toks('text')}) <= 0.02 ELSE false END")
keep("filter_lorem_ipsum", C.lorem_ipsum_filter, "NOT contains(lower(text), 'lorem ipsum')")
add("filter_min_sentences", lambda s, d: documents(s, d).select("doc_id", C.min_sentences_filter(F.col("text")).alias("keep")))
add(
    "filter_code_extension",
    lambda s, d: documents(s, d).withColumn("filename", F.concat(F.lit("f"), "doc_id", F.when(F.pmod("doc_id", F.lit(2)) == 0, ".py").otherwise(".bin"))).select("doc_id", C.github_extension_filter(F.col("text")).alias("keep")),
    "SELECT doc_id, doc_id % 2 = 0 AS keep FROM documents",
)
# Rules in their order: no lines, sentence ends and short lines (both only where few characters stand in lines of ten words), repeats, lists.
FINEWEB_SQL = f"""WITH a AS (SELECT doc_id, text, {pars_raw} AS ls, {toks("text")} AS ws FROM documents),
b AS (SELECT *, {total("list_filter(ls, lambda x: len(" + toks("x") + ") >= 10)")} / nullif({total("ls")}, 0) < 0.9 AS poor FROM a)
SELECT doc_id, coalesce(CASE WHEN len(ls) = 0 THEN 'fineweb_quality_filter_zero_lines'
 WHEN poor AND len(list_filter(ls, lambda x: {has("x", T.TERMINAL)})) / len(ls) < 0.12 THEN 'line_punct_ratio_filter'
 WHEN poor AND len(list_filter(ls, lambda x: length(x) <= 30)) / len(ls) > 0.67 THEN 'short_line_ratio_filter'
 WHEN ({total("ls")} - {total("list_distinct(ls)")}) / length(replace(text, chr(10), '')) > 0.1 THEN 'char_dup_ratio_filter'
 WHEN (len({rows("text")}) - 1) / len(ws) > 0.3 THEN 'list_ratio_filter' END, 'kept') AS reason FROM b"""
add("fineweb_quality_reasons", lambda s, d: documents(s, d).select("doc_id", F.coalesce(C.fineweb_quality_reason(F.col("text"), high_quality_ratio_value=0.9), F.lit("kept")).alias("reason")), FINEWEB_SQL)
keep("filter_fineweb_quality", C.fineweb_quality_filter, f"coalesce(len({pars_raw}) > 0 AND {_extra_chars} <= 0.1 AND (len({rows('text')}) - 1) / nullif(len({toks('text')}), 0) <= 0.3, false)")

_breaks = T.LINE_BREAK
_split_lines = f"CASE WHEN text = '' THEN [] ELSE regexp_split_to_array(regexp_replace(text, '(?:{_breaks})\\z', ''), '{_breaks}') END"
# The page rules in their order: length rules over words that aren't punctuation alone, stop words with repeats, the rest over all words.
GOPHER_SQL = rf"""
WITH a AS (SELECT *, {toks("text")} AS ws, {_split_lines} AS ls FROM documents),
b AS (SELECT *, list_filter(ws, lambda w: {has("w", T.SYMBOL_FREE)}) AS r FROM a),
c AS (SELECT *, len(r) AS m, len(ws) AS n, CASE WHEN len(r) > 0 THEN {total("r")} / len(r) END AS mean, len(ls) AS nl FROM b)
SELECT doc_id, m AS n_words, coalesce(CASE
 WHEN m < 50 THEN 'gopher_short_doc' WHEN m > 100000 THEN 'gopher_long_doc'
 WHEN mean < 3 THEN 'gopher_below_avg_threshold' WHEN mean > 10 THEN 'gopher_above_avg_threshold'
 WHEN len(list_filter(ws, lambda w: w IN ('the', 'be', 'to', 'of', 'and', 'that', 'have', 'with'))) < 2 THEN 'gopher_enough_stop_words'
 WHEN {found("text", "#")} / n > 0.1 THEN 'gopher_too_many_hashes'
 WHEN {found("text", r"\.\.\.|…")} / n > 0.1 THEN 'gopher_too_many_ellipsis'
 WHEN len(list_filter(ls, lambda x: {has("x", r"^\s*[•-]")})) / nl > 0.9 THEN 'gopher_too_many_bullets'
 WHEN len(list_filter(ls, lambda x: {has("x", r"(\.\.\.|…)\s*\z")})) / nl > 0.3 THEN 'gopher_too_many_end_ellipsis'
 WHEN len(list_filter(ws, lambda w: {has("w", r"\p{L}")})) / n < 0.8 THEN 'gopher_below_alpha_threshold' END, 'kept') AS reason
FROM c"""


def gopher_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    real = F.filter(T.tokens(F.col("text")), lambda w: w.rlike(T.SYMBOL_FREE))
    return documents(spark, sf_dir).select("doc_id", F.size(real).cast("long").alias("n_words"), F.coalesce(C.gopher_quality_reason(F.col("text")), F.lit("kept")).alias("reason"))


add("gopher_quality", gopher_quality, GOPHER_SQL)
add("gopher_quality_counts", lambda s, d: A.step_counts(documents(s, d), C.gopher_quality_reason(F.col("text"))), f"SELECT reason, count(*) AS pages FROM ({GOPHER_SQL}) GROUP BY reason")
_cut = r"regexp_replace(x, '\[(citation needed|edit|\d*)\]', '', 'g')"
# Each line by the first rule that holds: word length, number of words (both before citations go), lorem ipsum, javascript, bracket, policy.
C4_SQL = f"""WITH a AS (SELECT doc_id, list_transform({_split_lines}, lambda p: {strip("p")}) AS given FROM documents),
b AS (SELECT doc_id, list_transform(given, lambda x: {{'line': {_cut}, 'state': CASE WHEN coalesce(list_max(list_transform({toks("x")}, lambda w: length(w))), 0) > 1000 THEN 'skip'
 WHEN len({toks("x")}) < 3 THEN 'skip' WHEN contains(lower({_cut}), 'lorem ipsum') THEN 'lorem_ipsum' WHEN contains(lower({_cut}), 'javascript') THEN 'skip'
 WHEN contains({_cut}, '{{') THEN 'curly_bracket' WHEN {has(f"lower({_cut})", "|".join(C.POLICY))} THEN 'skip' ELSE 'keep' END}}) AS js FROM a),
c AS (SELECT doc_id, list_filter(js, lambda j: j.state NOT IN ('keep', 'skip'))[1].state AS reason, {strip("array_to_string(list_transform(list_filter(js, lambda j: j.state = 'keep'), lambda j: j.line), chr(10))")} AS kept FROM b)"""


def c4_judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = documents(spark, sf_dir).select("doc_id", C.c4_lines(F.col("text")).alias("js"))
    return judged.select("doc_id", F.coalesce(C.c4_reason(F.col("js"), -1), F.lit("kept")).alias("reason"), C.c4_text(F.col("js")).alias("new_text"))


add("c4_lines", c4_judged, f"{C4_SQL} SELECT doc_id, coalesce(reason, 'kept') AS reason, kept AS new_text FROM c")
add("c4_filter_any_sentences", lambda s, d: C.fineweb_c4_filter(documents(s, d), min_num_sentences=-1).select("doc_id", "text"), f"{C4_SQL} SELECT doc_id, kept AS text FROM c WHERE reason IS NULL AND kept <> ''")
add("c4_filter", lambda s, d: C.fineweb_c4_filter(documents(s, d)).select("doc_id", "text"))
add("c4_filter_sentences", lambda s, d: C.fineweb_c4_filter(documents(s, d), split_paragraph=False).select("doc_id", "text"))

# Repetition
_group = f"""
WITH p AS (SELECT doc_id, unnest({pars("text")}) AS seg FROM documents), c AS (SELECT doc_id, seg, count(*) AS n FROM p GROUP BY ALL),
s AS (SELECT doc_id, sum(n) AS segs, sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS again, sum(n * length(seg)) AS chars, sum(CASE WHEN n > 1 THEN n * length(seg) ELSE 0 END) AS again_chars FROM c GROUP BY doc_id)
SELECT d.doc_id, round(again / segs, 6) AS by_line, round(again_chars / chars, 6) AS by_char FROM documents d LEFT JOIN s USING (doc_id)"""
add("repetition_lines", lambda s, d: documents(s, d).select("doc_id", F.round(repetition.segment_fraction(F.col("text"), "line", False), 6).alias("by_line"), F.round(repetition.segment_fraction(F.col("text"), "line", True), 6).alias("by_char")), _group)
add("repetition_ngrams", lambda s, d: documents(s, d).select("doc_id", repetition.ngram_shares(F.col("text")).alias("x")).select("doc_id", *[F.round(F.get("x", F.lit(n - 2)), 6).alias(f"n{n}") for n in range(2, 11)]))
add("massive_web_repetition", lambda s, d: documents(s, d).withColumn("shares", repetition.ngram_shares(F.col("text"))).select("doc_id", F.coalesce(repetition.massive_web_reason(F.col("text"), F.col("shares")), F.lit("kept")).alias("reason")))
add("gopher_repetition", lambda s, d: documents(s, d).select("doc_id", F.coalesce(repetition.gopher_repetition_reason("text"), F.lit("kept")).alias("reason")))

add("fused_chain", lambda s, d: fused.fused_quality(documents(s, d), drop=False).select("doc_id", F.coalesce("reason", F.lit("kept")).alias("reason")))
add("fused_chain_counts", lambda s, d: fused.step_table(documents(s, d)))
add("simplify_text", lambda s, d: documents(s, d).select("doc_id", T.simplify_text(F.col("text"), unicode_accents=False).alias("new_text")), rf"SELECT doc_id, {strip(r'regexp_replace(regexp_replace(regexp_replace(lower(text), ' + chr(39) + r'\p{Nd}' + chr(39) + ', ' + chr(39) + '0' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + '), ' + chr(39) + r'[^\p{L}\p{N}\p{M}\s]' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + '), ' + chr(39) + r'\s+' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')')} AS new_text FROM documents")

# Modifiers
rewrite("modify_citations", modify.citation_removal_modifier, f"regexp_replace(text, '{modify.CITATION}', '', 'g')")
rewrite("modify_newlines", lambda t: modify.newline_removal_modifier(t, 1), r"regexp_replace(text, '\n{2,}', chr(10), 'g')")
rewrite("modify_punctuation_lines", lambda t: modify.punctuation_line_modifier(t, True), lines_where(rf"(x = '' OR {has('x', r'[.!?' + chr(34) + r'…]\s*\z')}) AND NOT {has('x', r'(\.\.\.|…)\s*\z')}"))
rewrite("modify_line_length", lambda t: modify.line_length_modifier(t, 5, 200), lines_where(f"x = '' OR len({toks('x')}) BETWEEN 5 AND 200"))
rewrite("modify_word_length", lambda t: modify.word_length_modifier(t, 20), lines_where(f"coalesce(list_max(list_transform({toks('x')}, lambda w: length(w))), 0) <= 20"))
rewrite("modify_uppercase_lines", modify.uppercase_ratio_line_modifier, strip(lines_where(rf"x = '' OR {found('x', r'\p{Lu}')} <= 0.5 * length(x)")))
rewrite("modify_numeric_lines", lambda t: modify.numeric_ratio_line_modifier(t, 0.05), strip(lines_where(rf"x = '' OR {found('x', r'\p{Nd}')} <= 0.05 * length(x)")))
rewrite("modify_counter_lines", modify.counter_line_modifier, strip(lines_where("NOT " + has("lower(x)", modify.COUNTER.replace("\\A", "^")))))
rewrite("modify_substring_lines", lambda t: modify.substring_line_modifier(t, ["licen[sc]ed?", "was the"], max_length=40), strip(lines_where(f"NOT (len({toks('x')}) <= 40 AND {has('x', r'(?i)\s?(?:licen[sc]ed?|was the)')})")))
rewrite("modify_substring_cut", lambda t: modify.substring_line_modifier(t, ["licen[sc]ed?", "was the"], remove_substring_only=True), strip("array_to_string(list_filter(list_transform(" + rows("text") + r", lambda x: [x, regexp_replace(x, '(?i)\s?(?:licen[sc]ed?|was the)', '', 'g')]), lambda p: p[1] = '' OR " + strip("p[2]") + " <> '').list_transform(lambda p: p[2]), chr(10))"))
add("modify_short_lines", lambda s, d: documents(s, d).select("doc_id", modify.short_line_modifier(F.col("text")).alias("new_text")))
rewrite("modify_within_page_dedup", modify.within_page_dedup, f"array_to_string(list_filter(list_transform({rows('text')}, lambda x, i: [x, CASE WHEN {strip('x')} = '' OR list_position(list_transform({rows('text')}, lambda y: lower({strip('y')})), lower({strip('x')})) = i THEN 'y' ELSE 'n' END]), lambda p: p[2] = 'y').list_transform(lambda p: p[1]), chr(10))")
rewrite("modify_phone", lambda t: F.regexp_replace(t, modify.PHONE, ""), f"regexp_replace(text, '{modify.PHONE}', '', 'g')")
rewrite("modify_email_and_phone", modify.email_and_phone_removal_modifier, f"regexp_replace(regexp_replace(text, '{(chr(92) + 'b' + modify.EMAIL).replace(chr(39), chr(39) * 2)}', '', 'g'), '{modify.PHONE}', '', 'g')")
rewrite("modify_urls", modify.url_removal_modifier, f"regexp_replace(regexp_replace(text, '{modify.web_address()}', '', 'g'), '{modify.IPV4}', '', 'g')")
_script = f"(contains(lower({strip('x')}), 'javascript') AND {has('lower(x)', 'enable|disable|require|activate|browser')})"
rewrite("modify_line_removal", modify.line_removal, lines_where(f"NOT ({strip('x')} = '' OR len({toks('x')}) < 2 OR {_script} OR {has('lower(x)', '|'.join(modify.POLICY))} OR {found('x', chr(92) + 'p{Lu}')} > 0.99 * length(x) OR {has('lower(' + strip('x') + ')', '^[0-9]+' + chr(92) + 'z')} OR {has('lower(' + strip('x') + ')', modify.COUNTER.replace(chr(92) + 'A', '^'))})"))
add("bad_words_hits", lambda s, d: modify.bad_words_hits(documents(s, d), MOST_BAD), rf"SELECT count(*) AS documents, sum(regexp_matches(text, '(?i)(^|[^\p{{L}}\p{{N}}_])(casino|the|und)([^\p{{L}}\p{{N}}_]|$)')::bigint)::bigint AS hits FROM documents")
rewrite("modify_arxiv_appendix", lambda t: modify.arxiv_appendix_modifier(F.concat(t, F.lit("\n\\appendix\nmore"))), "text || chr(10)")
rewrite("modify_arxiv_comments", modify.arxiv_comment_modifier, r"regexp_replace(regexp_replace(text, '(?m)^%[^\n]*\n?', '', 'g'), '(?m)[^\\]%[^\n]+$', '', 'g')")
rewrite("modify_arxiv_sections", lambda t: modify.arxiv_section_strip_modifier(F.concat(t, F.lit("\\section{A} b"))), r"'\section{A} b'")
rewrite("modify_arxiv_macros", lambda t: modify.arxiv_macro_modifier(F.concat(F.lit("\\newcommand{\\mac}{value}\n"), t, F.lit(" \\mac ."))), r"'\newcommand{value}{value}' || chr(10) || text || ' value .'")
add("modify_html_content", lambda s, d: pages(s, d).select("page_id", modify.html_content_extraction_modifier(F.col("html")).alias("new_text")))
add(
    "split_and_join_lines",
    lambda s, d: modify.join_lines_modifier(modify.split_lines_modifier(documents(s, d)), delimiter=" / ").select("doc_id", "text"),
    "SELECT doc_id, replace(text, chr(10), ' / ') AS text FROM documents WHERE text <> ''",
)
add(
    "rename_and_move_url",
    lambda s, d: modify.key_name_modifier(modify.move_url_modifier(pages(s, d).select("page_id", F.struct(F.col("url").alias("WARC-Target-URI")).alias("metadata"), F.col("html").alias("content")))).select("page_id", "url", F.length("text").cast("long").alias("n")),
    "SELECT page_id, url, length(html) AS n FROM pages",
)


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question (the first user turn) and its answers, scored by their length."""
    turns = conversations(spark, sf_dir)
    said = turns.groupBy("conv_id").agg(
        F.min_by("text", F.when(F.col("role") == "user", F.col("turn"))).alias("q"),
        F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", F.struct("turn", F.col("text"), F.length("text").alias("score"))))).alias("a"),
    )
    return said.select("conv_id", F.struct(F.col("q").alias("text")).alias("question"), F.transform("a", lambda x: F.struct(x["text"].alias("text"), x["score"].alias("score"))).alias("answers"))


add(
    "qa_sort_and_format",
    lambda s, d: modify.stackexchange_qa_formatter(modify.stackexchange_answer_sort_modifier(modify.stackexchange_html_extraction_modifier(modify.stackexchange_list_modifier(questions(s, d)))), remove_qa=True),
    """WITH t AS (SELECT conv_id, arg_min(text, turn) FILTER (role = 'user') AS q FROM conversations GROUP BY conv_id),
a AS (SELECT conv_id, string_agg(chr(10) || 'A: ' || text, '' ORDER BY length(text) DESC, turn) FILTER (role = 'assistant') AS a FROM conversations GROUP BY conv_id)
SELECT conv_id, 'Q: ' || q || coalesce(a, '') AS text FROM t JOIN a USING (conv_id) WHERE q IS NOT NULL""",
)


def repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = F.array_sort(F.collect_list(F.struct("doc_id", F.concat(F.lit("f"), "doc_id").alias("filename"), "text")))
    return documents(spark, sf_dir).groupBy(F.col("source").alias("repo_name")).agg(F.transform(files, lambda f: F.struct(f["filename"].alias("filename"), f["text"].alias("text"))).alias("files"))


add(
    "repo_split",
    lambda s, d: split.starcoder_v2_repo_splitter(repositories(s, d), max_files=7).select("repo_name", F.size("files").cast("long").alias("n"), F.get("files", F.lit(0))["filename"].alias("first")),
    "WITH r AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 7 AS k FROM documents) SELECT source AS repo_name, count(*) AS n, 'f' || min(doc_id) AS first FROM r GROUP BY source, k",
)
add("repo_format", lambda s, d: split.starcoder_v2_format_modifier(repositories(s, d)).select("repo_name", F.md5("text").alias("text_md5")))
add(
    "pattern_split",
    lambda s, d: split.pattern_splitter(documents(s, d), pattern="\\n").select("doc_id", F.col("chunk").cast("long").alias("chunk"), "text"),
    f"SELECT doc_id, unnest(range(len({rows('text')}))) AS chunk, unnest({rows('text')}) AS text FROM documents",
)

# Enrichers
add("enrich_counts", lambda s, d: pipeline.run(documents(s, d), ["line_counter_enricher", {"func": "word_counter_enricher", "ignore_punctuation": False}])[0].select("doc_id", "line_count", "word_count"), f"SELECT doc_id, len({pars('text')}) AS line_count, len({toks('text')}) AS word_count FROM documents")
add("enrich_language", lambda s, d: documents(s, d).select("doc_id", enrich.top_language(enrich.language_shares(F.col("text")), default="none").alias("guess")))
add("enrich_language_lines", lambda s, d: documents(s, d).select("doc_id", F.to_json(enrich.detect_lang_paragraph_enricher(F.col("text"))[1]).alias("langs")))
add(
    "enrich_perplexity",
    lambda s, d: enrich.unigram_perplexity(documents(s, d)).select("doc_id", "perplexity"),
    f"""WITH w AS (SELECT doc_id, unnest({toks("lower(text)")}) AS w FROM documents), f AS (SELECT w, count(*) AS c FROM w GROUP BY w), t AS (SELECT count(*) AS total FROM w),
p AS (SELECT doc_id, round(pow(10.0, -sum(log10(c / total)) / count(*)), 1) AS perplexity FROM w JOIN f USING (w) CROSS JOIN t GROUP BY doc_id) SELECT doc_id, perplexity FROM documents LEFT JOIN p USING (doc_id)""",
)


def classifier_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model, _ = enrich.train_fasttext_classifier(docs, labels(spark, sf_dir))
    return enrich.classify_fasttext_hq_prob_enricher(docs, model).select("doc_id", F.round("hq_prob", 4).alias("hq_prob"))


add("enrich_classifier", classifier_scores)

# Aggregates
_pct = ", ".join(f"list_sort(list(n_chars::double))[round_even({q} * (count(*) - 1), 0)::int + 1] AS {k}" for k, q in A.POINTS.items())
add("aggregate_percentiles", lambda s, d: A.percentiles(documents(s, d), "n_chars"), f'SELECT {_pct.replace("AS min", "AS \"min\"").replace("AS max", "AS \"max\"").replace("AS median", "AS \"median\"")}, round(avg(n_chars), 6) AS mean FROM documents')
add(
    "aggregate_histogram",
    lambda s, d: A.histogram(documents(s, d), "n_chars"),
    "WITH e AS (SELECT min(n_chars)::double AS lo, max(n_chars)::double AS hi FROM documents) SELECT round(lo + least(floor((n_chars - lo) / ((hi - lo) / 10)), 9) * ((hi - lo) / 10), 6) AS bin, count(*) AS n FROM documents, e GROUP BY 1",
)
add("aggregate_value_counts", lambda s, d: A.histogram(documents(s, d), "lang"), "SELECT lang AS bin, count(*) AS n FROM documents GROUP BY lang")
add(
    "aggregate_event_histogram",
    lambda s, d: A.histogram(events(s, d), "event_type"),
    "SELECT event_type AS bin, count(*) AS n FROM events GROUP BY 1",
)
add(
    "aggregate_threshold",
    lambda s, d: documents(s, d).groupBy(A.threshold_transform(F.create_map("lang", F.col("n_chars") / 5000.0), 0.5, "other").alias("label")).agg(F.count("*").alias("n")),
    "SELECT CASE WHEN n_chars / 5000.0 >= 0.5 THEN lang ELSE 'other' END AS label, count(*) AS n FROM documents GROUP BY 1",
)
add(
    "aggregate_stats_rollup",
    lambda s, d: A.stats_rollup(documents(s, d).groupBy(F.col("source").alias("subject"), F.col("lang").alias("name")).agg(F.count("*").alias("removed")), ["de", "en", "es", "fr"]),
    "SELECT source AS subject, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang = 'es') AS es, count(*) FILTER (lang = 'fr') AS fr, count(*) AS total_removed FROM documents GROUP BY source",
)
add(
    "aggregate_size_rollup",
    lambda s, d: A.size_rollup(documents(s, d).withColumnsRenamed({"source": "subject", "n_chars": "size"}), documents(s, d).filter("lang = 'en'").withColumnsRenamed({"source": "subject", "n_chars": "size"})),
    "SELECT source AS subject, count(*) AS processed_files, sum(n_chars)::bigint AS processed_size, count(*) FILTER (lang = 'en') AS deduped_files, coalesce(sum(n_chars) FILTER (lang = 'en'), 0)::bigint AS deduped_size FROM documents GROUP BY source",
)
add(
    "aggregate_merge_stats",
    lambda s, d: A.merge_stats(documents(s, d).select(F.col("lang").alias("name"), F.col("n_chars").alias("pages_in"), F.length("source").cast("long").alias("removed"))),
    "SELECT lang AS name, sum(n_chars)::bigint AS pages_in, sum(length(source))::bigint AS removed, count(*) AS shards FROM documents GROUP BY lang",
)


def _results(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    return parts.groupBy(F.col("p_type").alias("task")).agg((F.avg("p_size") / 50).alias("accuracy")), parts.groupBy(F.col("p_type").alias("task")).agg(F.min("p_brand").alias("category"), (F.min("p_size") * 1.0).alias("baseline"))


add(
    "aggregate_centered_means",
    lambda s, d: A.centered_means(*_results(s, d), core=["T1"]).select("category", F.round("mean", 6).alias("mean"), F.coalesce("tasks", F.lit(0)).alias("tasks")),
    """WITH r AS (SELECT p_type AS task, avg(p_size) / 50 AS accuracy, min(p_brand) AS category, min(p_size) * 0.01 AS b FROM part GROUP BY 1), c AS (SELECT *, (accuracy - b) / (1 - b) AS x FROM r)
SELECT category, round(avg(x), 6) AS mean, count(*) AS tasks FROM c GROUP BY 1 UNION ALL SELECT 'core', round(avg(x) FILTER (task = 'T1'), 6), count(*) FILTER (task = 'T1') FROM c UNION ALL SELECT 'extended', round(avg(x), 6), count(*) FROM c""",
)
add("aggregate_quality_table", lambda s, d: A.quality_table(documents(s, d)), rf"""SELECT doc_id, len(ls) AS line_num, round(CASE WHEN len(ls) > 0 THEN len(list_filter(ls, lambda x: {has("x", '[.!?"' + "''" + r"]\z")})) / len(ls) END, 6) AS punct_ratio, round(CASE WHEN len(ls) > 0 THEN len(list_filter(ls, lambda x: length(x) <= 30)) / len(ls) END, 6) AS short_ratio,
round(CASE WHEN len(ls) > 0 THEN ({total("ls")} - {total("list_distinct(ls)")}) / greatest(length(text), 1) END, 6) AS dup_ratio FROM (SELECT *, {pars("text")} AS ls FROM documents)""")

# Deduplication
add("dedup_exact", lambda s, d: dedup.exact_dedup(documents(s, d)).select("doc_id"), "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
add("dedup_exact_normalized_longest_source", lambda s, d: dedup.exact_dedup(documents(s, d), normalize="normalize_whitespace_and_lowercase", selection_key="source", selection_reverse=True).select("doc_id"), rf"SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lower({strip(r'regexp_replace(text, ' + chr(39) + r'\s+' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')')}) ORDER BY source DESC, doc_id) = 1")
add(
    "dedup_url",
    lambda s, d: dedup.url_dedup(pages(s, d).unionByName(pages(s, d).select((F.col("page_id") + 1_000_000).alias("page_id"), F.concat("url", F.lit("?utm_source=x")).alias("url"), "html"))).select("page_id"),
    r"WITH p AS (SELECT page_id, url FROM pages UNION ALL SELECT page_id + 1000000, url || '?utm_source=x' FROM pages) SELECT min(page_id) AS page_id FROM p GROUP BY regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '^(https?://)?(www\.)?', ''), '[?&](utm_|ref|feed).*$', ''), '/+$', '')",
)
add(
    "dedup_units",
    lambda s, d: modify.join_lines_modifier(dedup.exact_dedup(modify.split_lines_modifier(documents(s, d)), normalize="normalize_whitespace_and_lowercase")).select("doc_id", "text"),
    rf"WITH u AS (SELECT doc_id, unnest({rows('text')}) AS u, unnest(range(len({rows('text')}))) AS i FROM documents WHERE text <> ''), k AS (SELECT *, row_number() OVER (PARTITION BY lower({strip(r'regexp_replace(u, ' + chr(39) + r'\s+' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')')}) ORDER BY doc_id, i) AS n FROM u) SELECT doc_id, string_agg(u, chr(10) ORDER BY i) AS text FROM k WHERE n = 1 GROUP BY doc_id",
)
_words = r"regexp_extract_all(lower(unit), '([\p{L}\p{N}]+|[^\p{L}\p{N}\s])')"


def _ngram_sql(units: str, n: int = 13, low: int = 5) -> str:
    return f"""WITH u AS ({units}), w AS (SELECT *, {_words} AS ws FROM u),
g AS (SELECT pos, unnest(CASE WHEN len(ws) >= {n} THEN list_transform(range(1, len(ws) - {n} + 2), lambda i: array_to_string(ws[i:i + {n - 1}], ' ')) WHEN len(ws) >= {low} THEN [array_to_string(ws, ' ')] ELSE [] END) AS gram FROM w),
f AS (SELECT gram, min(pos) AS first FROM g GROUP BY gram), s AS (SELECT pos, count(*) AS total, sum((first < pos)::int) AS seen FROM g JOIN f USING (gram) GROUP BY pos)"""


_para = "SELECT doc_id, i AS idx, doc_id * 2147483648 + i AS pos, CASE WHEN i > 0 THEN chr(10) ELSE '' END || l AS unit FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)"
_whole = "SELECT doc_id, doc_id * 2147483648 AS pos, text AS unit FROM documents"
_kept = "k AS (SELECT doc_id, string_agg(unit, '' ORDER BY idx) AS text FROM u LEFT JOIN s USING (pos) WHERE NOT coalesce(seen / total {} 0.8, false) GROUP BY doc_id)"


def dedup_query(mode: str, *cols, **how) -> Callable:
    return lambda s, d: ngram_dedup.ngram_dedup(documents(s, d), mode=mode, **how).select("doc_id", *[c() if callable(c) else c for c in cols])


def _units():
    return F.array_join(F.transform("duplicate_units", lambda x: x.cast("string")), ",").alias("units")


# One round, in which n-grams of removed units count too, is SQL; the sequential result isn't, and is tested against brute force.
add("ngram_dedup_document_once", dedup_query("document", rounds=1), _ngram_sql(_whole) + " SELECT doc_id FROM u LEFT JOIN s USING (pos) WHERE NOT coalesce(seen / total > 0.8, false)")
add("ngram_dedup_paragraph_once", dedup_query("paragraph", "text", rounds=1), _ngram_sql(_para) + f", {_kept.format('>')} SELECT doc_id, text FROM k WHERE text <> ''")
add("ngram_dedup_old_both_once", dedup_query("old-both", "text", rounds=1), _ngram_sql(_para) + f", b AS (SELECT doc_id FROM s JOIN u USING (pos) GROUP BY doc_id HAVING sum(seen) / sum(total) > 0.8), {_kept.format('>')} SELECT doc_id, text FROM k WHERE text <> '' AND doc_id NOT IN (SELECT doc_id FROM b)")
add("ngram_dedup_both_once", dedup_query("both", "text", rounds=1), _ngram_sql(_para) + f", {_kept.format('>=')}, " + re.sub(r"\b([uwgfs]) AS", r"\g<1>2 AS", _ngram_sql(_whole).removeprefix("WITH ")).replace("FROM u)", "FROM u2)").replace("FROM w)", "FROM w2)").replace("FROM g GROUP", "FROM g2 GROUP").replace("FROM g JOIN f", "FROM g2 JOIN f2") + " SELECT doc_id, text FROM k WHERE text <> '' AND doc_id NOT IN (SELECT doc_id FROM u2 JOIN s2 USING (pos) WHERE seen / total >= 0.8)")
add("ngram_dedup_annotate_once", dedup_query("paragraph", _units, annotate_only=True, rounds=1), _ngram_sql(_para) + ", k AS (SELECT doc_id, string_agg(idx::varchar, ',' ORDER BY idx) AS units FROM u JOIN s USING (pos) WHERE seen / total > 0.8 GROUP BY doc_id) SELECT doc_id, units FROM documents LEFT JOIN k USING (doc_id)")
for _mode in ("document", "paragraph", "old-both", "both", "naive-both"):
    add(f"ngram_dedup_{_mode.replace('-', '_')}", dedup_query(_mode, "text"))
add("ngram_dedup_annotate", dedup_query("paragraph", _units, annotate_only=True))
add("ngram_dedup_shards", dedup_query("document", "text", shards=3))
add("ngram_dedup_exact", lambda s, d: ngram_dedup.ngram_dedup(documents(s, d), mode="exact", annotate_only=True).select("doc_id", "exact_duplicate"), "SELECT doc_id, doc_id > min(doc_id) OVER (PARTITION BY text) AS exact_duplicate FROM documents")
add("substring_dedup", lambda s, d: ngram_dedup.substring_dedup(documents(s, d)).select("doc_id", "text"))
add("overlap_with_benchmark", lambda s, d: ngram_dedup.decontamination_overlap(documents(s, d), benchmark(s, d)), r"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '([\p{L}\p{N}]+|[^\p{L}\p{N}\s])') AS ws FROM documents), b AS (SELECT regexp_extract_all(lower(text), '([\p{L}\p{N}]+|[^\p{L}\p{N}\s])') AS ws FROM benchmark),
g AS (SELECT doc_id, unnest(list_transform(range(1, len(ws) - 11), lambda i: array_to_string(ws[i:i + 12], ' '))) AS gram FROM d WHERE len(ws) >= 13), k AS (SELECT DISTINCT unnest(list_transform(range(1, len(ws) - 11), lambda i: array_to_string(ws[i:i + 12], ' '))) AS gram FROM b WHERE len(ws) >= 13)
SELECT doc_id, count(DISTINCT gram) AS overlap FROM g WHERE gram IN (SELECT gram FROM k) GROUP BY doc_id""")

# Tokens, packing, samples
_n = f"len({toks('text')}) + 1"
add("tokenize_counts", lambda s, d: tokenize.with_tokens(documents(s, d)).select("doc_id", F.size("tokens").cast("long").alias("n_tokens")), f"SELECT doc_id, {_n} AS n_tokens FROM documents")
add("pack_contexts", lambda s, d: tokenize.contexts(tokenize.with_tokens(documents(s, d))).groupBy("source").agg(F.count("*").alias("contexts"), F.sum(F.size(F.filter("tokens", lambda x: x != tokenize.VOCABULARY + 2))).alias("tokens")), f"SELECT source, ceil(sum({_n}) / 2049)::bigint AS contexts, sum({_n})::bigint AS tokens FROM documents GROUP BY source")
add("shuffle_manifest", lambda s, d: tokenize.manifest(tokenize.shuffle_chunks(tokenize.contexts(tokenize.with_tokens(documents(s, d)), seqlen=129), chunk=64, cells=4)))
add("count_manifest_tokens", lambda s, d: A.count_tokens(tokenize.manifest(tokenize.shuffle_chunks(tokenize.contexts(tokenize.with_tokens(documents(s, d)))))), f"SELECT sum(c)::bigint * 2049 AS tokens FROM (SELECT ceil(sum({_n}) / 2049)::bigint AS c FROM documents GROUP BY source)")
add("sample_head", lambda s, d: sampling.head(documents(s, d), 10).select("doc_id"), "SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 10")
add("sample_head_size", lambda s, d: sampling.head_size(documents(s, d), 20_000).select("doc_id"), "SELECT doc_id FROM documents QUALIFY coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 20000")
add("sample_files_balanced", lambda s, d: sampling.sample_files(documents(s, d), 200_000, "balance").select("doc_id"))
add("sample_files_proportional", lambda s, d: sampling.sample_files(documents(s, d), 200_000).select("doc_id"))

# Relations
add(
    "experiments_join",
    lambda s, d: relational.join_experiments(
        s.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.col("o_custkey").alias("model_uuid")),
        s.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("uuid"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("dataset_uuid")),
        s.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").alias("uuid"), F.col("n_name").alias("name")),
    ).select("o_orderkey", "model_name", "dataset_name"),
    "SELECT o_orderkey, c_name AS model_name, n_name AS dataset_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey",
)
add(
    "resolve_names",
    lambda s, d: relational.resolve_names(s.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", "s_nationkey"), s.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").alias("uuid"), F.col("n_name").alias("name")), "s_nationkey", "nation"),
    "SELECT s_suppkey, n_name AS nation_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey",
)
add("predicate_language", lambda s, d: relational.where(s.read.parquet(f"{d}/orders.parquet"), "o_totalprice>=100K", "o_orderpriority=^1").select("o_orderkey"), "SELECT o_orderkey FROM orders WHERE o_totalprice >= 100000 AND o_orderpriority LIKE '1%'")
add(
    "merge_reasons",
    lambda s, d: relational.merge_reasons(
        documents(s, d).select("doc_id", F.explode(F.array(F.struct(F.lit("gopher").alias("module"), C.gopher_quality_reason(F.col("text")).alias("filter_reason")), F.struct(F.lit("size").alias("module"), F.when(F.col("n_chars") > 5000, "long").alias("filter_reason")))).alias("x")).select("doc_id", "x.*"), ["gopher", "size"]
    ),
    f"SELECT d.doc_id, nullif(reason, 'kept') AS gopher, CASE WHEN n_chars > 5000 THEN 'long' END AS size FROM ({GOPHER_SQL}) g JOIN documents d USING (doc_id)",
)
add("unfinished_tasks", lambda s, d: relational.unfinished(documents(s, d), labels(s, d), "doc_id").select("doc_id"), "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
add(
    "paired_runs",
    lambda s, d: relational.paired(documents(s, d).filter("lang = 'en'").groupBy(F.col("source").alias("task")).agg(F.count("*").alias("score")), documents(s, d).filter("lang = 'de'").groupBy(F.col("source").alias("task")).agg(F.count("*").alias("score"))),
    'SELECT source AS task, count(*) FILTER (lang = \'en\') AS "left", count(*) FILTER (lang = \'de\') AS "right", count(*) FILTER (lang = \'en\') - count(*) FILTER (lang = \'de\') AS difference FROM documents GROUP BY source HAVING "left" > 0 AND "right" > 0',
)
add(
    "contaminated_share",
    lambda s, d: relational.contaminated_share(documents(s, d).join(ngram_dedup.decontamination_overlap(documents(s, d), benchmark(s, d)), "doc_id", "left").select(F.col("lang").alias("task"), F.coalesce("overlap", F.lit(0)).alias("overlap"))),
    SQL["overlap_with_benchmark"].replace("SELECT doc_id, count(DISTINCT gram)", ", o AS (SELECT doc_id, count(DISTINCT gram)").rstrip() + ") SELECT lang AS task, round(avg((coalesce(overlap, 0) > 0)::int), 6) AS contaminated FROM documents LEFT JOIN o USING (doc_id) GROUP BY lang",
)

# Pipelines
def addressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an address, and a model's score, for the presets that ask for them."""
    docs = documents(spark, sf_dir)
    site = F.when(F.pmod("doc_id", F.lit(10)) == 0, "spam.example").when(F.pmod("doc_id", F.lit(10)) == 1, "best-poker-bet.example").otherwise(F.concat("source", F.lit(".example")))
    return docs.withColumn("url", F.concat(F.lit("https://"), site, F.lit("/"), "doc_id")).withColumn("hq_prob", F.pmod("doc_id", F.lit(1000)) / 1000.0)


_url_ok = "CASE doc_id % 10 WHEN 0 THEN false WHEN 1 THEN false ELSE true END"
_fineweb_ok = FINEWEB_SQL.replace("< 0.9 AS poor", "< -1 AS poor")
_preset_sql = {
    "gopher_quality": f"SELECT doc_id, text FROM ({GOPHER_SQL}) JOIN documents USING (doc_id) WHERE reason = 'kept'",
    "v2.1": f"SELECT doc_id, text FROM ({_fineweb_ok}) JOIN documents USING (doc_id) WHERE reason = 'kept'",
    "v2.3": f"SELECT doc_id, text FROM ({_fineweb_ok}) JOIN documents USING (doc_id) WHERE reason = 'kept'",
    "v2.2": f"SELECT doc_id, text FROM ({FINEWEB_SQL.replace('< 0.9 AS poor', '< 0.73 AS poor').replace('< 0.12', '< 0.2').replace('> 0.67', '> 1')}) JOIN (SELECT * FROM documents WHERE {SQL['filter_high_quality_ratio'].removeprefix('SELECT doc_id, ').removesuffix(' AS keep FROM documents').replace('>= 0.75', '>= 0.73')}) USING (doc_id) WHERE reason = 'kept'",
    "fineweb_quality": "SELECT doc_id, text FROM documents WHERE " + " AND ".join(f"({SQL[f'filter_{x}'].removeprefix('SELECT doc_id, ').removesuffix(' AS keep FROM documents')})" for x in ("line_punctuation", "short_lines", "char_duplicates")) + f" AND CASE WHEN len({toks('text')}) > 0 THEN (len({rows('text')}) - 1) / len({toks('text')}) <= 0.3 ELSE false END",
    "model_filter": "SELECT doc_id, text FROM documents WHERE doc_id % 1000 / 1000.0 >= 0.018112",
    "equipment_filter": "SELECT doc_id, text FROM documents WHERE doc_id % 1000 / 1000.0 >= 0.9",
    "content_to_text": "SELECT doc_id, text FROM documents",
    "line_removal": SQL["modify_line_removal"].replace("AS new_text", "AS text").replace("SELECT doc_id", "SELECT * FROM (SELECT doc_id") + ") WHERE text <> ''",
    "url_rules": SQL["modify_urls"].replace("AS new_text", r"AS t").replace("SELECT doc_id", r"SELECT doc_id, regexp_replace(t, '\n{3,}', chr(10) || chr(10), 'g') AS text FROM (SELECT doc_id") + f" WHERE {_url_ok}) WHERE t <> ''",
}
for _name, _steps in presets.PRESETS.items():
    if _name in ("half", "no_language", "science", "language", "c4_pages"):  # the same steps as another, a sample, or steps for raw pages
        continue
    add(f"preset_{_name.replace('.', '_')}", lambda s, d, n=_name: pipeline.run(addressed(s, d), presets.PRESETS[n])[0].select("doc_id", "text"), _preset_sql.get(_name))
add("preset_c4_pages", lambda s, d: pipeline.run(pages(s, d).select(F.col("page_id").alias("doc_id"), F.struct(F.col("url").alias("WARC-Target-URI")).alias("metadata"), F.col("html").alias("content")), presets.PRESETS["c4_pages"][:8])[0].select("doc_id", "url", "text"))
add("annotate_rules", lambda s, d: pipeline.run(documents(s, d), presets.PAGE_RULES, annotate=True)[0].groupBy(F.coalesce("filter_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("pages")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality reasons of the distinct documents, by language."""
    docs = dedup.exact_dedup(documents(spark, sf_dir))
    return docs.groupBy("lang", F.coalesce(C.gopher_quality_reason(F.col("text")), F.lit("kept")).alias("reason")).agg(F.count("*").alias("pages"))


add("flagship", flagship, f"WITH k AS (SELECT min(doc_id) AS doc_id FROM documents GROUP BY text), r AS ({GOPHER_SQL}) SELECT lang, reason, count(*) AS pages FROM documents JOIN k USING (doc_id) JOIN r USING (doc_id) GROUP BY ALL")
