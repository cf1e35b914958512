"""Sends this package to the Python workers of a session, for clusters on which it isn't installed."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the session's Python path once an application."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="ship-")) / f"{here.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(target))
    _sent.add(app)


def shipped(f: Callable) -> Callable:
    """Wraps a function whose first argument is the session."""

    @wraps(f)
    def run(spark: SparkSession, *args, **kw):
        ship(spark)
        return f(spark, *args, **kw)

    return run
