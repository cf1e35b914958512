"""Shared storage for intermediate results and stable row identity.

Intermediate tables are written below the folder named in ``spark.checkpoint.dir``; a folder of our own is set only where
a session on one machine names none, and a cluster without one is an error. Every table read back has cut lineage and survives
the loss of any executor.

A function that returns a result removes its tables itself. A stage's plan still reads some (keys of rows that go, at most): they
are removed when a ``made()`` block ends, which ``corpus_pipeline.run`` opens around each stage and its writing.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; creates one only where none is configured on a single machine."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        jdir = sc._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            return jdir.get()
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="textloom-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(path)
    return path


_made: list[list["Scratch"]] = []


@contextmanager
def made() -> Iterator[None]:
    """Removes the tables of every ``Scratch`` that is created within the block."""
    _made.append([])
    try:
        yield
    finally:
        for s in _made.pop():
            s.drop()


class Scratch:
    """A folder of written tables below the shared folder; ``drop()`` removes it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
        self.names: list[str] = []
        if _made:
            _made[-1].append(self)

    def table(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        self.names.append(name)
        df.write.option("compression", "zstd").parquet(path)
        self.spark._jvm.System.gc()  # lets the driver forget, and executors delete, the shuffles behind the written table
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, name: str) -> None:
        self._delete(f"{self.root}/{name}")
        if name in self.names:
            self.names.remove(name)

    def only(self, *names: str) -> None:
        """Removes all other tables; rows of the input that ``filed`` wrote stay."""
        for name in [n for n in self.names if n not in names and not n.startswith("rows-")]:
            self.remove(name)

    def drop(self) -> None:
        self._delete(self.root)
        self.names.clear()

    def result(self, df: DataFrame) -> DataFrame:
        """Checkpoints a result eagerly, then removes the tables it was made from."""
        shared_dir(self.spark)
        out = df.checkpoint(eager=True)
        self.drop()
        return out

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


#: Rows of keys up to which a stored table is sent to a scan instead of shuffling the scan's rows to it.
SENT_KEYS = 1_000_000


def sent(stored: DataFrame, most: int = SENT_KEYS) -> DataFrame:
    """A stored table, to be broadcast if it has at most ``most`` rows; a longer one is joined by a shuffle."""
    return F.broadcast(stored) if stored.count() <= most else stored


def sent_bytes(stored: DataFrame, size: Column, most: int) -> DataFrame:
    """As ``sent``, by the bytes of all rows, of which ``size`` is an expression."""
    return F.broadcast(stored) if stored.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] <= most else stored


def text_key(text: Column) -> list[Column]:
    """128 bits of a text, by two hashes with independent seeds: (hash_a, hash_b)."""
    return [F.xxhash64(text).alias("hash_a"), F.xxhash64(F.lit("textloom"), text).alias("hash_b")]


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def filed(df: DataFrame, scratch: Scratch) -> DataFrame:
    """``df`` itself where it is a file scan, else its rows written to the shared folder and read again."""
    try:
        df.select("_metadata.file_path", "_metadata.row_index")
        return df
    except AnalysisException:
        return scratch.table(f"rows-{uuid.uuid4().hex[:8]}", df)


def keyed(df: DataFrame, key: str, scratch: Scratch, *cols: Column) -> DataFrame:
    """Selects ``cols`` with a 64-bit row key that is the same in every scan and every retry.

    For a file scan the key hashes file path and row index, whatever the splits; any other plan is first written to the
    shared folder and keyed there, with new keys in each call: rows that are keyed twice must be ``filed`` before.
    """
    made = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias(key)
    kept = df.select(*cols)
    try:
        return df.select(made, *cols)
    except AnalysisException:
        pass
    return filed(kept, scratch).select(made, *[F.col(f"`{c}`") for c in kept.columns])
