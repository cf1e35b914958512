"""Pipelines: a list of steps becomes one lazy plan; ``commit`` and global steps may be checkpointed."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from textloom.functions.lineage import cut
from textloom.operators import aggregate
from textloom.registry import load


def parse(text: str) -> dict[str, list]:
    """Steps by source of a YAML list of {source, steps}."""
    import yaml

    found = yaml.safe_load(text)
    return {x.get("source", ""): x["steps"] for x in (found if isinstance(found, list) else [found])}


def read(path: str) -> dict[str, list]:
    return parse(Path(path).read_text())


AGGREGATORS = {"percentiles": aggregate.percentiles, "histogram": aggregate.histogram}


def aggregated(df: DataFrame, key: str, how: dict) -> DataFrame:
    """The aggregate of a step's column; a map column becomes its likeliest key by ``transform``'s threshold first."""
    value = F.col(f"`{key}`")
    if "transform" in how:
        value = aggregate.threshold_transform(value, how["transform"].get("threshold", 0.0), how["transform"].get("default", "other"))
    return AGGREGATORS[how["type"]](df.select(value.alias("value")), "value")


def run(df: DataFrame, steps: list, text_col: str = "text", annotate: bool = False, stats: bool = False, aggregates: dict | None = None) -> tuple[DataFrame, list[tuple[str, Observation]]]:
    """The plan of the steps, and with ``stats`` an observation of the rows after each (filled when the plan runs).

    A step with ``_aggregate`` ({"key", "type"[, "transform"]}) puts a DataFrame of its aggregate into ``aggregates``.
    """
    seen: list[tuple[str, Observation]] = []

    def look(df: DataFrame, name: str) -> DataFrame:
        if not stats:
            return df
        o = Observation(f"{len(seen)}_{name}")
        seen.append((name, o))
        live = F.col("filter_reason").isNull() if "filter_reason" in df.columns else F.lit(True)
        return df.observe(o, F.count(F.when(live, 1)).alias("pages"))

    df = look(df, "input")
    for s in steps:
        if s == "commit":
            df = cut(df)
            continue
        s = {"func": s} if isinstance(s, str) else dict(s)
        name = s.pop("func")
        how = s.pop("_aggregate", None)
        df = look(load(name).apply(df, text_col=text_col, annotate=annotate, **s), name)
        if how and aggregates is not None:
            aggregates[f"{len(aggregates)}_{name}"] = aggregated(df, how["key"], how)
    return df, seen


def counts(seen: list[tuple[str, Observation]]) -> list[dict]:
    """Statistics of a plan that ran: pages in, out and removed by step."""
    pages = [(n, o.get["pages"]) for n, o in seen]
    return [{"name": n, "pages_in": a, "pages_out": b, "removed": max(0, a - b)} for (_, a), (n, b) in zip(pages, pages[1:])]
