"""Cuts lineage by a reliable checkpoint in the folder that the session names."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """``df.checkpoint()``; a folder of our own is set only where the session names none (as in tests)."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(sc.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="textloom-"))
    return df.checkpoint()
