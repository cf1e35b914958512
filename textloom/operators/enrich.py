"""New columns: counters, language guesses, classifier scores and perplexities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.registry import step

#: Frequent words by language, for the built-in guess.
LANGUAGE_WORDS = {
    "en": "the of and to in that is was for with as on be at by this are not or from have which".split(),
    "de": "der die das und ist von den zu mit sich auf für nicht ein eine als auch dem im des".split(),
    "es": "el los las y que por con una para se del no su lo es como más o pero sus".split(),
    "fr": "le la les des du et une est que qui dans pour pas sur au avec ce il ne plus".split(),
}


@step("enricher")
def line_counter_enricher(text: Column, key: str = "line_count", paragraph_end: str = "\\n", remove_empty: bool = True, overwrite: bool = False):
    return key, F.size(T.paragraphs(text, paragraph_end, remove_empty)).cast("long"), overwrite


@step("enricher")
def word_counter_enricher(text: Column, key: str = "word_count", ignore_punctuation: bool = True, model: str = "split", overwrite: bool = False):
    return key, F.size(T.words(text, model, ignore_punctuation)).cast("long"), overwrite


def language_shares(text: Column) -> Column:
    """Map of language to its share of the text's frequent words; empty for a text without any."""

    def shares(ws: Column) -> Column:
        def hits_of(known: list[str]) -> Column:
            return F.size(F.filter(ws, lambda w: w.isin(known))).cast("double")

        return F.array(*[F.struct(F.lit(k).alias("k"), hits_of(v).alias("n")) for k, v in LANGUAGE_WORDS.items()])

    def entries(hits: Column, total: Column) -> Column:
        return F.transform(F.filter(hits, lambda x: x["n"] > 0), lambda x: F.struct(x["k"].alias("key"), F.round(x["n"] / total, 6).alias("value")))

    ws = F.transform(T.tokens(F.lower(text)), lambda w: F.regexp_replace(w, r"[^\p{L}]", ""))
    found = T.let(T.let(ws, shares), lambda hits: T.let(F.aggregate(hits, F.lit(0.0), lambda a, x: a + x["n"]), lambda total: entries(hits, total)))
    return F.map_from_entries(found)


@step("enricher")
def detect_lang_whole_page_enricher(text: Column, key: str = "language_id", model=None, overwrite: bool = False):
    """Map of language to probability; ``model`` is any function of a text column to such a map."""
    return key, (model or language_shares)(text), overwrite


@step("enricher")
def detect_lang_paragraph_enricher(text: Column, key: str = "language_id_paragraph", overwrite: bool = False):
    """Map of language to (average probability, number) of the lines for which it is the most likely."""
    def top(m: Column) -> Column:
        return F.array_max(F.transform(F.map_entries(m), lambda e: F.struct(e["value"].alias("p"), e["key"].alias("k"))))

    best = F.filter(F.transform(T.paragraphs(text), lambda x: top(language_shares(x))), lambda b: b.isNotNull())

    def entry(best: Column, k: Column) -> Column:
        own = F.filter(best, lambda b: b["k"] == k)
        mean = F.aggregate(own, F.lit(0.0), lambda a, b: a + b["p"]) / F.size(own)
        return F.struct(k.alias("key"), F.struct(F.round(mean, 6).alias("average_probability"), F.size(own).cast("long").alias("number_of_sentences")).alias("value"))

    found = T.let(best, lambda best: F.transform(F.array_distinct(F.transform(best, lambda b: b["k"])), lambda k: entry(best, k)))
    return key, F.map_from_entries(found), overwrite


def top_language(langs: Column, threshold: float = 0.0, default: str = "en") -> Column:
    """The most likely language with a probability of at least ``threshold``; ties go to the later name."""
    best = F.array_max(F.transform(F.map_entries(langs), lambda e: F.struct(e["value"].alias("p"), e["key"].alias("k"))))
    return F.when(best["p"] >= threshold, best["k"]).otherwise(F.lit(default))


#: Hashed word pairs and words that a linear classifier reads.
FEATURES, TRAIN_ROWS = 1 << 16, 20_000


def train_fasttext_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", valid_share: float = 0.1, seed: int = 0, train_rows: int = TRAIN_ROWS):
    """A linear classifier on hashed words and word pairs; (model, {P@1, R@1, rows} on held-out rows).

    Trains on at most ``train_rows`` labelled rows, the first by a hash of the id.
    """
    from pyspark.ml.classification import LogisticRegression

    some = labels.filter(F.col(label_col).isNotNull()).orderBy(F.xxhash64(id_col, F.lit(seed)), id_col).limit(train_rows)
    rows = _features(docs.join(some.select(id_col, F.col(label_col).cast("double").alias("label")), id_col), text_col)
    held = F.pmod(F.xxhash64(id_col, F.lit(seed + 1)), F.lit(1000)) < int(1000 * valid_share)
    model = LogisticRegression(maxIter=20, regParam=0.01).fit(rows.filter(~held))
    model._java_obj.setSummary(docs.sparkSession._jvm.scala.Option.empty())  # it holds the session, which tasks can't be sent
    n = model.transform(rows.filter(held)).agg(F.count("*").alias("n"), F.sum((F.col("prediction") == F.col("label")).cast("long")).alias("right")).first()
    p = (n["right"] or 0) / n["n"] if n["n"] else 0.0
    return model, {"P@1": p, "R@1": p, "rows": n["n"]}


def _features(df: DataFrame, text_col: str) -> DataFrame:
    from pyspark.ml.feature import HashingTF

    ws = T.tokens(F.lower(F.coalesce(F.col(text_col), F.lit(""))))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="_grams", outputCol="features").transform(df.withColumn("_grams", F.concat(ws, T.ngrams(ws, 2)))).drop("_grams")


def classify_fasttext_hq_prob_enricher(df: DataFrame, model, key: str = "hq_prob", text_col: str = "text") -> DataFrame:
    """Probability of the label 1."""
    from pyspark.ml.functions import vector_to_array

    names = df.columns
    return model.transform(_features(df, text_col)).select(*names, F.get(vector_to_array("probability"), F.lit(1)).alias(key))


def unigram_perplexity(df: DataFrame, key: str = "perplexity", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Perplexity under the corpus's own word frequencies, to one decimal: 10 ** (-sum log10 p / number of words)."""
    ws = df.select(id_col, F.explode(T.tokens(F.lower(F.col(text_col)))).alias("w"))
    per = ws.groupBy(id_col, "w").agg(F.count("*").alias("n"))
    freq = per.groupBy("w").agg(F.sum("n").alias("c"))
    total = per.agg(F.sum("n").alias("total"))
    scored = per.join(freq, "w").crossJoin(F.broadcast(total))
    lp = F.sum(F.col("n") * F.log10(F.col("c") / F.col("total")))
    out = scored.groupBy(id_col).agg(F.round(F.pow(F.lit(10.0), -lp / F.sum("n")), 1).alias(key))
    return df.join(out, id_col, "left")
