"""Exact deduplication of texts, addresses and text units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import NORMALIZERS
from textloom.registry import fresh, step


def _norm(c: Column, normalize: str | list[str] | None) -> Column:
    for name in [normalize] if isinstance(normalize, str) else normalize or []:
        c = NORMALIZERS[name](c)
    return c


@step("global")
def exact_dedup(
    df: DataFrame, text_col: str = "text", content_key: str | None = None, normalize: str | list[str] | None = None, selection_key: str | None = None, selection_normalize: str | list[str] | None = None, selection_reverse: bool = False, id_col: str = "doc_id"
) -> DataFrame:
    """One row of each content, the first by the selection key (the last with ``selection_reverse``), then by id.

    Content is compared by a 128-bit hash. Rows meet once, by hash; all but the first of each are dropped in the map tasks
    already (a window group limit), so that a text with many copies doesn't fill one task. A list as content loses the elements
    that other rows (or earlier places) keep, by a partial aggregation; a row left without elements goes.
    """
    key = content_key or text_col
    many = df.schema[key].dataType.typeName() == "array"
    chosen = _norm(F.col(f"`{selection_key}`"), selection_normalize) if selection_key else F.lit(0)
    order = chosen.desc() if selection_reverse else chosen.asc()
    if not many:
        w = Window.partitionBy(F.md5(_norm(F.col(f"`{key}`"), normalize).cast("string"))).orderBy(order, F.col(f"`{id_col}`"))
        place = fresh(df, "place")
        return df.withColumn(place, F.row_number().over(w)).filter(F.col(place) == 1).drop(place)
    units = df.select(F.col(f"`{id_col}`").alias("_id"), chosen.alias("_s"), F.posexplode(key).alias("_at", "_unit"))
    best = F.min if not selection_reverse else F.max
    place = F.struct("_s", "_id", "_at") if not selection_reverse else F.struct("_s", (-F.col("_id")).alias("_id"), (-F.col("_at")).alias("_at"))
    mark = F.md5(_norm(F.col("_unit"), normalize).cast("string"))
    firsts = units.groupBy(mark.alias("_m")).agg(best(place).alias("p"))  # partial aggregation: a hot unit isn't one task's rows
    sign = F.lit(-1 if selection_reverse else 1)
    kept = firsts.select((F.col("p._id") * sign).alias("_id"), (F.col("p._at") * sign).alias("_at"))
    own, left = fresh(df, "kept_id"), fresh(df, "kept_at")
    lists = kept.groupBy(F.col("_id").alias(own)).agg(F.array_sort(F.collect_list("_at")).alias(left))
    out = df.join(lists, F.col(f"`{id_col}`") == F.col(own))
    return out.withColumn(key, F.transform(left, lambda i: F.get(F.col(f"`{key}`"), i))).drop(own, left)


def url_dedup(df: DataFrame, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    return exact_dedup(df, content_key=url_col, normalize="normalize_url", id_col=id_col)
