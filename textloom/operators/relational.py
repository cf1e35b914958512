"""Queries over experiment tables: foreign names, joins, a small predicate language, wide merges and comparisons."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SCALE = {unit: 1000.0 ** (i + 1) for i, unit in enumerate("KMBT")}
_COMPARE = {">=": "__ge__", "<=": "__le__", ">": "__gt__", "<": "__lt__"}


def flatten(df: DataFrame) -> DataFrame:
    """Structs as dotted columns, at any depth."""
    while any(f.dataType.typeName() == "struct" for f in df.schema):
        out = []
        for f in df.schema:
            if f.dataType.typeName() == "struct":
                out += [F.col(f"`{f.name}`.`{k}`").alias(f"{f.name}.{k}") for k in f.dataType.names]
            else:
                out.append(F.col(f"`{f.name}`"))
        df = df.select(*out)
    return df


def resolve_names(df: DataFrame, other: DataFrame, uuid_col: str, table: str, uuid: str = "uuid", name: str = "name") -> DataFrame:
    """Replaces a reference by the name of the row referred to; unknown ones become null."""
    names = other.select(F.col(uuid).alias("_u"), F.col(name).alias(f"{table}_name")).dropDuplicates(["_u"])
    return df.join(names, F.col(uuid_col) == F.col("_u"), "left").drop("_u", uuid_col)


def join_experiments(evals: DataFrame, models: DataFrame, datasets: DataFrame, model_key: str = "model_uuid", dataset_key: str = "dataset_uuid") -> DataFrame:
    """Evaluations with their models and those models' datasets; of several rows with one key the first by the other columns."""
    def first(df: DataFrame, prefix: str) -> DataFrame:
        rest = sorted(c for c in df.columns if c != "uuid")
        one = df.withColumn("_n", F.row_number().over(Window.partitionBy("uuid").orderBy(*rest))).filter("_n = 1").drop("_n")
        return one.select(*[F.col(c).alias(f"{prefix}_{c}" if c != dataset_key else c) for c in one.columns])

    out = evals.withColumnRenamed(model_key, "_m").join(first(models, "model"), F.col("_m") == F.col("model_uuid"), "left").drop("_m")
    return out.withColumnRenamed(dataset_key, "_d").join(first(datasets, "dataset"), F.col("_d") == F.col("dataset_uuid"), "left").drop("_d")


def predicate(text: str) -> Column:
    """``col=regex`` or ``col>=10B`` (also <=, >, <; suffixes K, M, B, T)."""
    m = re.fullmatch(r"\s*([\w.]+)\s*(>=|<=|>|<|=)\s*(.+?)\s*", text)
    if not m:
        raise ValueError(f"not a predicate: {text}")
    col, op, value = F.col(f"`{m[1]}`"), m[2], m[3]
    if op == "=":
        return col.cast("string").rlike(value)
    number = float(value[:-1]) * _SCALE[value[-1].upper()] if value[-1].upper() in _SCALE else float(value)
    return getattr(col.cast("double"), _COMPARE[op])(number)


def where(df: DataFrame, *predicates: str) -> DataFrame:
    for p in predicates:
        df = df.filter(predicate(p))
    return df


def lead_columns(df: DataFrame, *patterns: str) -> DataFrame:
    """Columns that match come first, in the patterns' order."""
    first = list(dict.fromkeys(c for p in patterns for c in df.columns if re.search(p, c)))
    return df.select(*[f"`{c}`" for c in first + [c for c in df.columns if c not in first]])


def unfinished(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return todo.join(done.select(key), key, "left_anti")


def merge_reasons(runs: DataFrame, modules: list[str], id_col: str = "doc_id", module: str = "module", reason: str = "filter_reason") -> DataFrame:
    """A wide row a document: its reason in each module's run."""
    return runs.groupBy(id_col).pivot(module, modules).agg(F.min(reason))


def paired(left: DataFrame, right: DataFrame, key: str = "task", value: str = "score") -> DataFrame:
    """(key, left, right, difference) of what both runs have."""
    a, b = left.select(key, F.col(value).alias("left")), right.select(key, F.col(value).alias("right"))
    return a.join(b, key).withColumn("difference", F.col("left") - F.col("right"))


def contaminated_share(overlaps: DataFrame, threshold: int = 0, key: str = "task", value: str = "overlap") -> DataFrame:
    return overlaps.groupBy(key).agg(F.round(F.avg((F.col(value) > threshold).cast("double")), 6).alias("contaminated"))
