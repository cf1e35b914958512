"""One row to many, and their inverse forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.registry import step


@step("splitter")
def starcoder_v2_repo_splitter(df: DataFrame, text_col: str = "text", max_files: int = 1000, delete_content: bool = True) -> DataFrame:
    """Rows of at most ``max_files`` files each."""
    at = F.sequence(F.lit(0), F.ceil(F.size("files") / max_files).cast("int") - 1)
    out = df.filter(F.size("files") > 0).withColumn("_at", F.explode(at)).withColumn("files", F.slice("files", F.col("_at") * max_files + 1, max_files)).drop("_at")
    return out.drop(text_col) if delete_content else out


@step("splitter")
def starcoder_v2_format_modifier(df: DataFrame, text_col: str = "text", add_metadata_prob: float = 0.5, add_sentinels: bool = True, seed: int = 0) -> DataFrame:
    """Files joined to a text, with repository and file names in a share of rows chosen by a hash of the repository's name."""
    sep = F.lit("<file_sep>" if add_sentinels else "")
    bare = F.concat(sep, F.array_join(F.transform("files", lambda f: f["text"]), "<file_sep>" if add_sentinels else "\n"))
    named = F.concat(F.lit("<repo_name>"), F.col("repo_name"), sep, F.array_join(F.transform("files", lambda f: F.concat(f["filename"], F.lit("\n"), f["text"])), "<file_sep>" if add_sentinels else "\n"))
    chosen = F.pmod(F.xxhash64("repo_name", F.lit(seed)), F.lit(1 << 20)) < int(add_metadata_prob * (1 << 20))
    return df.withColumn(text_col, F.when(chosen, named).otherwise(bare))


@step("splitter")
def pattern_splitter(df: DataFrame, text_col: str = "text", pattern: str = "\\n\\n", overlap: int = 0) -> DataFrame:
    """A row for each part between matches, numbered in ``chunk``; with ``overlap`` parts before it repeated."""
    parts = F.split(text_col, pattern)

    def with_before(ps):
        return F.transform(ps, lambda p, i: F.array_join(F.slice(ps, F.greatest(F.lit(1), i + 1 - overlap), F.least(i + 1, F.lit(overlap + 1))), "\n\n"))

    own = T.let(parts, with_before) if overlap else parts
    return df.select(*[c for c in df.columns if c not in (text_col, "chunk")], F.posexplode(own).alias("chunk", text_col))
