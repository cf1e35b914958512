"""Samples by quota, count and size. Every order is a hash of (id, seed), so that samples repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import running
from textloom.registry import fresh


def proportional_quotas(sizes: dict[str, int], target: int) -> dict[str, float]:
    total = sum(sizes.values())
    return {k: target * v / total if total else 0.0 for k, v in sizes.items()}


def balanced_quotas(sizes: dict[str, int], target: int) -> dict[str, float]:
    """Equal quotas; what a small subject can't fill is shared by the rest."""
    out: dict[str, float] = {}
    left, todo = float(target), dict(sizes)
    while todo:
        each = left / len(todo)
        small = {k: v for k, v in todo.items() if v <= each}
        if not small:
            return out | {k: each for k in todo}
        for k, v in small.items():
            out[k] = float(v)
            left -= v
            del todo[k]
    return out


def sample_files(df: DataFrame, target: int, mode: str = "proportional", key: str = "source", size: str = "n_chars", id_col: str = "doc_id", seed: int = 0) -> DataFrame:
    """Rows in a random order of each subject until its quota of size is crossed; only the subjects' sums reach the driver."""
    sizes = {r[0]: r[1] for r in df.groupBy(key).agg(F.sum(size)).collect()}
    quotas = (proportional_quotas if mode == "proportional" else balanced_quotas)(sizes, target)
    spark = df.sparkSession
    name, quota, size_before = (fresh(df, c) for c in ("quota_of", "quota", "size_before"))
    table = spark.createDataFrame(list(quotas.items()) or [("", 0.0)], f"{name} string, {quota} double")
    mark = fresh(df, "mark")
    rows = running.before(df.withColumn(mark, F.xxhash64(id_col, F.lit(seed))), [key], [mark, id_col], F.col(size), size_before)
    return rows.join(table, F.col(key).eqNullSafe(F.col(name))).filter(F.col(size_before) < F.col(quota)).select(*df.columns)


def head(df: DataFrame, n: int, key: str = "source", id_col: str = "doc_id") -> DataFrame:
    """The first ``n`` rows of each subject; others are dropped in the map tasks already (a window group limit)."""
    place = fresh(df, "place")
    return df.withColumn(place, F.row_number().over(Window.partitionBy(key).orderBy(id_col))).filter(F.col(place) <= n).drop(place)


def head_size(df: DataFrame, most: int, key: str = "source", size: str = "n_chars", id_col: str = "doc_id") -> DataFrame:
    """Rows of each subject until their size crosses ``most``."""
    size_before = fresh(df, "size_before")
    return running.before(df, [key], [id_col], F.col(size), size_before).filter(F.col(size_before) < most).select(*df.columns)


def train_valid(df: DataFrame, valid_share: float = 0.1, id_col: str = "doc_id", seed: int = 0) -> tuple[DataFrame, DataFrame]:
    held = F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(1 << 20)) < int(valid_share * (1 << 20))
    return df.filter(~held), df.filter(held)


def weighted_mix(parts: dict[str, tuple[DataFrame, float]], id_col: str = "doc_id", seed: int = 0) -> DataFrame:
    """Union of sources, each in its share (over 1: whole copies and a remainder)."""
    out = None
    for name, (df, weight) in sorted(parts.items()):
        keep = F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(1 << 20)) < int((weight % 1) * (1 << 20))
        copies = F.lit(int(weight)) + keep.cast("int")
        part = df.withColumn("mix_source", F.lit(name)).withColumn(fresh(df, "copy"), F.explode(F.sequence(F.lit(1), copies))).drop(fresh(df, "copy")) if weight >= 1 else df.withColumn("mix_source", F.lit(name)).filter(keep)
        out = part if out is None else out.unionByName(part)
    return out
