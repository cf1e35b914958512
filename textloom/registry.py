"""Steps by name. A step is declared once and used with drop or annotate semantics, in batch or stream.

Kinds: a *filter* gives a predicate (true: keep; null: an error, which drops the row), a *modifier* a new text (and whether an
empty one drops the row), an *enricher* a new column, a *splitter* and a *global* step a whole DataFrame.
"""

from __future__ import annotations

import importlib
import inspect
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS: dict[str, "Step"] = {}
#: Column of cached words, read by every step whose function takes ``words``.
WORDS = "words"
RESERVED = ("module", "func", "annotate", "token")


@dataclass(frozen=True)
class Step:
    name: str
    kind: str
    make: Callable
    drop_empty: bool = True

    def apply(self, df: DataFrame, text_col: str = "text", annotate: bool = False, token: str = "", **kw) -> DataFrame:
        """The step over ``df``; with ``annotate`` rows stay and get the first reason in ``filter_reason``."""
        kw = {k: v for k, v in kw.items() if not k.startswith("_") and k not in RESERVED}
        if self.kind in ("splitter", "global"):
            return self.make(df, text_col=text_col, **kw)
        if WORDS in df.columns and WORDS in inspect.signature(self.make).parameters:
            kw.setdefault(WORDS, F.col(WORDS))
        made = self.make(F.col(f"`{text_col}`"), **kw)
        if self.kind == "filter":
            return keep(df, made, self.name + token, annotate)
        if self.kind == "enricher":
            key, value, overwrite = made
            if key in df.columns and not overwrite:
                raise ValueError(f"column {key} is there already")
            return df.withColumn(key, value)
        if not annotate or not self.drop_empty:
            return computed(df, text_col, made, drop_empty=self.drop_empty)
        empty = F.coalesce(made == "", F.lit(True))
        new = fresh(df, "new_text")
        return keep(df.withColumn(new, made), ~empty, self.name + token, True).withColumn(text_col, F.when(empty, F.col(f"`{text_col}`")).otherwise(F.col(new))).drop(new)


def computed(df: DataFrame, name: str, value: Column, drop_empty: bool = False) -> DataFrame:
    """Sets a column that is computed once: predicates on it aren't pushed below (which would compute it again for each).

    With ``drop_empty`` rows with an empty or null value go.
    """
    one = F.filter(F.array(value), lambda x: x != "") if drop_empty else F.array(value)
    made = F.explode(one).alias(name)
    if name in df.columns:
        return df.select(*[made if c == name else F.col(f"`{c}`") for c in df.columns])
    return df.select("*", made)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def keep(df: DataFrame, predicate: Column, reason: str | Column, annotate: bool) -> DataFrame:
    if not annotate:
        return df.filter(predicate)
    old = F.col("filter_reason") if "filter_reason" in df.columns else F.lit(None).cast("string")
    why = F.lit(reason) if isinstance(reason, str) else reason
    return df.withColumn("filter_reason", F.coalesce(old, F.when(~F.coalesce(predicate, F.lit(False)), why)))


def step(kind: str, name: str | None = None, drop_empty: bool = True):
    def add(f: Callable) -> Callable:
        STEPS[name or f.__name__] = Step(name or f.__name__, kind, f, drop_empty)
        return f

    return add


def map_pages(df: DataFrame, make: Callable, schema=None, factory: bool = False, safe: bool = True, **kw) -> DataFrame:
    """A user's mapper from a page (a dict) to a list of pages, in batches.

    With ``factory`` ``make(**kw)`` is called once a task and gives the mapper. A page on which it fails is dropped where ``safe``
    holds; null fields are absent keys, keys outside the schema are lost.
    """
    import pandas as pd
    from pyspark.sql.types import StructType

    out = df.schema if schema is None else StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = out.names

    def run(batches):
        f = make(**kw) if factory else lambda page: make(page, **kw)
        for pdf in batches:
            got = []
            for page in pdf.to_dict("records"):
                try:
                    got += f({k: v for k, v in page.items() if v is not None})
                except Exception:
                    if not safe:
                        raise
            yield pd.DataFrame([[p.get(n) for n in names] for p in got], columns=names, dtype=object)

    return df.mapInPandas(run, out)


def load(name: str) -> Step:
    """A step by name, or by dotted path ``package.module.function`` for a user's own."""
    for m in ("metadata", "content", "repetition", "modify", "enrich", "split", "dedup", "ngram_dedup", "fused"):
        importlib.import_module(f"textloom.operators.{m}")
    if name in STEPS:
        return STEPS[name]
    if "." in name:
        module, _, f = name.rpartition(".")
        made = getattr(importlib.import_module(module), f)
        return STEPS.get(f) or Step(f, getattr(made, "kind", "global"), made)
    raise KeyError(f"no step {name}")
