"""Ready-made pipelines by name. Word lists are ours and small: ``make`` takes your own, or the paths of list files."""

from __future__ import annotations

from dataclasses import dataclass

from textloom.operators.content import POLICY

WHITELIST = ["(", ")", "%"]


@dataclass(frozen=True)
class Lists:
    """Lists of the presets: entries, or the path of a file with one a line."""

    domains: list[str] | str = ("casino.example", "spam.example")
    curated: list[str] | str = ("arxiv.org", "stackoverflow.com")
    strict_words: list[str] | str = ("xxxvideo",)
    hard_words: list[str] | str = ("casino", "porn", "xxx")
    soft_words: list[str] | str = ("bet", "casino", "poker", "loan")
    bad_words: list[str] | str = ("casino", "viagra", "xxx")
    soft_bad_words: list[str] | str = ("damn",)
    zh_bad_words: list[str] | str = ("赌场",)
    short_lines: list[str] | str = ("click here", "share this")


def listed(entries: list[str] | str, file_key: str = "banlist_file") -> dict:
    return {file_key: entries} if isinstance(entries, str) else {"banlist": list(entries)}


def make(lists: Lists = Lists()) -> dict[str, list]:
    """Every preset, by name."""
    line = lambda words, where="any", most=10, only=True: {"func": "substring_line_modifier", "banlist": words, "location": where, "max_length": most, "remove_substring_only": only}
    language = [{"func": "detect_lang_whole_page_enricher"}, {"func": "language_filter", "keep_languages": ["en"], "threshold": 0.65}]
    domains = {"func": "url_substring_filter", **listed(lists.domains), "exact_domain_match": True, "ignore_chars": ["www"]}
    curated = {"func": "url_substring_filter", **listed(lists.curated), "exact_domain_match": True, "ignore_chars": ["www"]}
    url_words = [
        {"func": "url_substring_filter", **listed(lists.strict_words), "ignore_chars": ["-", "."]},
        {"func": "url_substring_filter", **listed(lists.hard_words), "match_substrings": False},
        {"func": "url_substring_filter", **listed(lists.soft_words), "num_banned_substrs": 2, "match_substrings": False},
    ]
    cleaned = [{"func": "url_removal_modifier"}, {"func": "newline_removal_modifier", "max_consecutive": 2}]
    url = [{"func": "move_url_modifier"}, domains, *url_words]
    symbols = [
        {"func": "symbol_ratio_filter", "max_symbol_to_word_ratio": 0.1},
        {"func": "bullet_count_filter", "max_bullet_start_ratio": 0.9},
        {"func": "ellipsis_count_filter", "max_ellipsis_end_ratio": 0.3},
        {"func": "alphabetic_word_ratio_filter", "max_ratio": 0.2},
    ]
    length = {"func": "page_length_filter", "length_type": "word", "min_length": 50, "max_length": 100_000}
    page = [length, {"func": "word_length_filter", "min_length": 3, "max_length": 10}, *symbols, {"func": "stop_word_filter", "min_stop_word": 2}]
    repeats = {"func": "massive_web_repetition_filters"}
    lines = [
        {"func": "uppercase_ratio_line_modifier", "max_ratio": 0.5},
        {"func": "numeric_ratio_line_modifier", "max_ratio": 0.999999},
        {"func": "counter_line_modifier"},
        {"func": "line_length_modifier", "min_length": 2},
        line("items in cart"),
        line("Read more\\.\\.\\.", "suffix"),
        line("Sign-in", "prefix"),
    ]
    counted = [{"func": "word_counter_enricher", "key": "words_before"}, *lines, {"func": "word_counter_enricher", "key": "words_after"}, {"func": "word_removal_ratio_filter", "prev_word_count_key": "words_before", "new_word_count_key": "words_after", "max_removed_ratio": 0.05}]
    rules = [*page, repeats, *counted]
    cache, uncache = {"func": "cache_split_words_modifier"}, {"func": "uncache_split_words_modifier"}
    web_repeats, web_page, wide_page = {"func": "fineweb_gopher_repetition_filter"}, {"func": "fineweb_gopher_quality_filter"}, {"func": "fineweb_gopher_quality_filter", "all_bullets": True}
    web_quality = {"func": "fineweb_quality_filter"}
    zh = {"func": "bad_words_modifier", **listed(lists.zh_bad_words, "banned_file"), "banned_language": "zh", "remove_word": True}
    en = [{"func": "bad_words_modifier", **listed(x, "banned_file")} for x in (lists.bad_words, lists.soft_bad_words)]
    tidy = [{"func": "email_and_phone_removal_modifier"}, {"func": "citation_removal_modifier"}]
    short = {"func": "substring_line_modifier", **listed(lists.short_lines), "max_length": 5}
    c4 = [
        {"func": "page_length_filter", "length_type": "char", "max_length": 190_000},
        {"func": "word_length_modifier", "max_length": 1000},
        {"func": "citation_removal_modifier"},
        {"func": "punctuation_line_modifier", "remove_ellipses": True},
        {"func": "line_length_modifier", "min_length": 5},
        {"func": "substring_filter", "banlist": ["lorem ipsum"]},
        {"func": "substring_line_modifier", "banlist": ["javascript"]},
        {"func": "substring_filter", "banlist": ["\\{"]},
        {"func": "substring_line_modifier", "banlist": list(POLICY)},
        {"func": "page_length_filter", "length_type": "sentence", "min_length": 3},
        {"func": "split_lines_modifier"},
        {"func": "exact_dedup", "normalize": "normalize_whitespace_and_lowercase"},
        {"func": "join_lines_modifier"},
        {"func": "within_page_dedup"},
        {"func": "page_length_filter", "length_type": "sentence", "min_length": 3},
        {"func": "substring_filter", **listed(lists.bad_words), "exact_word": True},
    ]

    def v2(least: int = 2, sign_in: str | list[str] = "Sign-in", only: bool = True, short_lines: bool = False) -> list[dict]:
        cart = [line("items in cart"), line("Read more\\.\\.\\.", "suffix"), line("Read more", "suffix"), line(sign_in, "prefix", only=only)]
        return [*tidy, *cart, {"func": "line_removal_modifier", "min_word_cnt_per_line": least}, *([short] if short_lines else []), {"func": "word_length_modifier"}, {"func": "lorem_ipsum_filter"}, {"func": "min_sentences_filter"}, cache]

    signs = ["Sign-in", "Sign in", "SignIn", "Sign-out", "Sign out", "SignOut"]
    tail = [repeats, wide_page, web_quality, uncache, zh]
    return {
        "c4": c4,
        "c4_pages": [{"func": "move_url_modifier"}, {"func": "key_name_modifier"}, *c4, {"func": "detect_lang_whole_page_enricher"}, {"func": "language_filter", "keep_languages": ["en"], "threshold": 0.99}],
        "web": [*url[:2], curated, *url[2:], *cleaned, *language, *rules],
        "web_baseline": [*url, *cleaned, *language, *rules],
        "web_rules": rules,
        "no_language": rules,
        "line_rules": counted,
        "url_rules": [*url, *cleaned],
        "prepare": [*url, *cleaned, *language],
        "multi_language": [*url, *cleaned, {"func": "detect_lang_whole_page_enricher"}, {**length, "model": "uniseg"}, *symbols[:3], {**symbols[3], "model": "uniseg"}, repeats, *counted],
        "science": rules,
        "science_v2": [*url, *cleaned, *rules],
        "fineweb": [cache, web_repeats, web_page, uncache, {"func": "fineweb_c4_filter"}, web_quality],
        "gopher": [repeats, web_page],
        "gopher_quality": [web_page],
        "gopher_repetition": [{**repeats, "use_fineweb_implementation": True}],
        "gopher_repetition_only": [web_repeats],
        "fineweb_quality": [{"func": "line_punct_ratio_filter"}, {"func": "short_line_ratio_filter"}, {"func": "char_dup_ratio_filter"}, {"func": "list_ratio_filter"}],
        "v0": [*url, *cleaned, *language, cache, web_repeats, web_page, web_quality, uncache],
        "v1": [*url, *cleaned, *language, cache, {"func": "line_removal_modifier"}, web_repeats, {**web_page, "whitelist": WHITELIST}, web_quality, uncache],
        "v2": [zh, *en, cleaned[0], *v2()[:-1], cache, wide_page, web_quality, repeats, uncache, *en],
        "v2.1": [web_quality],
        "v2.2": [{**web_quality, "line_punct_thr": 0.2, "high_quality_ratio_value": 0.73, "short_line_thr": 1}, {"func": "high_quality_ratio_filter", "threshold": 0.73}],
        "v2.3": [{**web_quality, "line_punct_thr": 0.2, "short_line_thr": 0.6167}],
        "v2_fast": [*v2(), *tail],
        "v2_min_word_3": [*v2(3), repeats, wide_page, uncache],
        "v2_template": [*v2(3, only=False, short_lines=True), repeats, wide_page, uncache],
        "v2_test": [*v2(4), *tail],
        "v2_test_signs": [*v2(3, signs, False, True), *tail],
        "v2_words": [cache, web_repeats, wide_page, web_quality, uncache],
        "v2_min_word_6": [*v2(6), *tail],
        "filter_en": language,
        "language": language,
        "content_to_text": [{"func": "key_name_modifier"}],
        "line_removal": [{"func": "line_removal_modifier"}],
        "half": [{"func": "random_sampling_filter", "keep_probability": 0.5}],
        "r3": [*v2(), wide_page, web_quality, repeats, uncache, zh],
        # The score column is filled by enrich.classify_fasttext_hq_prob_enricher before.
        "model_filter": [{"func": "quality_filter", "key": "hq_prob", "threshold": 0.018112}],
        "equipment_filter": [{"func": "quality_filter", "key": "hq_prob", "threshold": 0.9}],
    }


PRESETS = make()
PAGE_RULES = PRESETS["web_rules"][:7]
