"""Aggregates of step statistics and page values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from textloom.functions import running

POINTS = {"min": 0.0, "p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99, "max": 1.0}


def percentiles(df: DataFrame, value: str) -> DataFrame:
    """One row of exact percentiles by the nearest rank (halves to even), and the mean.

    Values are counted first, and their running sums are taken over ranges of them.
    """
    n = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(F.count("*").alias("c"))
    upto = running.before(n, [], ["v"], F.col("c"), "before").withColumn("upto", F.col("before") + F.col("c"))
    total = n.agg(F.sum("c").alias("total"), (F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("mean"))
    rank = lambda q: F.bround(F.lit(q) * (F.col("total") - 1), 0)
    return upto.crossJoin(F.broadcast(total)).agg(*[F.min(F.when(F.col("upto") > rank(q), F.col("v"))).alias(k) for k, q in POINTS.items()], F.round(F.first("mean"), 6).alias("mean"))


def histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """(bin, n): counts of texts, or of numbers in equal bins named by their left edge; the last bin is closed."""
    if df.schema[value].dataType.typeName() == "string":
        return df.groupBy(F.col(value).alias("bin")).agg(F.count("*").alias("n"))
    ends = df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    k = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col(value) - F.col("lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    rows = df.filter(F.col(value).isNotNull()).crossJoin(F.broadcast(ends))
    return rows.groupBy(F.round(F.col("lo") + k * width, 6).alias("bin")).agg(F.count("*").alias("n"))


def threshold_transform(values: Column, threshold: float, default: str) -> Column:
    """Key of the largest value of a map if that is at least ``threshold``."""
    best = F.array_max(F.transform(F.map_entries(values), lambda e: F.struct(e["value"].alias("v"), e["key"].alias("k"))))
    return F.when(best["v"] >= threshold, best["k"]).otherwise(F.lit(default))


def step_counts(df: DataFrame, reasons: Column) -> DataFrame:
    """(reason, pages) of a first-failure column; a null reason is kept."""
    return df.groupBy(F.coalesce(reasons, F.lit("kept")).alias("reason")).agg(F.count("*").alias("pages"))


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Counts rows on the way, without another pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("pages")), seen


def merge_stats(stats: DataFrame) -> DataFrame:
    """Sums of shard statistics by step."""
    names = [c for c in ("pages_in", "pages_out", "removed", "kept", "split", "errors", "secs") if c in stats.columns]
    return stats.groupBy("name").agg(*[F.sum(c).alias(c) for c in names], F.count("*").alias("shards"))


def stats_rollup(stats: DataFrame, steps: list[str], key: str = "subject", step_col: str = "name", value: str = "removed") -> DataFrame:
    """A wide row a subject: pages by step, and their total."""
    wide = stats.groupBy(key).pivot(step_col, steps).agg(F.sum(value))
    return wide.select(key, *[F.coalesce(F.col(f"`{s}`"), F.lit(0)).alias(s) for s in steps], sum((F.coalesce(F.col(f"`{s}`"), F.lit(0)) for s in steps), F.lit(0)).alias("total_removed"))


def size_rollup(left: DataFrame, right: DataFrame, key: str = "subject", size: str = "size") -> DataFrame:
    """Files and bytes by subject of two stages, side by side."""
    side = lambda df, p: df.groupBy(key).agg(F.count("*").alias(f"{p}_files"), F.sum(size).alias(f"{p}_size"))
    out = side(left, "processed").join(side(right, "deduped"), key, "full")
    return out.na.fill(0)


def centered_means(results: DataFrame, tasks: DataFrame, core: list[str], task: str = "task", value: str = "accuracy") -> DataFrame:
    """Mean of centred accuracies by category, over all tasks and over the core ones; (r - b) / (1 - b) for a baseline b in percent."""
    base = F.col("baseline") * 0.01
    rows = results.join(tasks, task).withColumn("centered", (F.col(value) - base) / (1 - base))
    by = rows.groupBy("category").agg(F.avg("centered").alias("mean"), F.count("*").alias("tasks"))
    over = rows.agg(F.avg(F.when(F.col(task).isin(core), F.col("centered"))).alias("mean"), F.sum(F.col(task).isin(core).cast("long")).alias("tasks")).select(F.lit("core").alias("category"), "mean", "tasks")
    return by.unionByName(over).unionByName(rows.agg(F.avg("centered").alias("mean"), F.count("*").alias("tasks")).select(F.lit("extended").alias("category"), "mean", "tasks"))


def count_tokens(manifest: DataFrame, seqlen: int = 2049) -> DataFrame:
    return manifest.agg((F.coalesce(F.sum("num_sequences"), F.lit(0)) * seqlen).alias("tokens"))


def quality_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Line statistics of every document."""
    from textloom.functions import text as T

    ls = T.paragraphs(F.col(text_col))
    return df.select(
        id_col,
        F.size(ls).cast("long").alias("line_num"),
        F.round(T.share(ls, lambda x: x.rlike(r"[.!?\"']\z")), 6).alias("punct_ratio"),
        F.round(T.share(ls, lambda x: F.length(x) <= 30), 6).alias("short_ratio"),
        F.round(F.when(F.size(ls) > 0, (T.total(ls) - T.total(F.array_distinct(ls))) / F.greatest(F.length(text_col), F.lit(1))), 6).alias("dup_ratio"),
    )
