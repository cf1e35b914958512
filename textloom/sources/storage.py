"""Files on any storage that Spark reaches, and chunk archives."""

from __future__ import annotations

import gzip
import io
import json
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of everything below a folder."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def list_dir(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(p))


def make_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.mkdirs(p)


def split_large(df: DataFrame, total_bytes: int, most: int = 256 << 20) -> DataFrame:
    """As many partitions as keep each below ``most`` bytes, for files that can't be split when read."""
    return df.repartition(max(1, -(-total_bytes // most)))


def tar_chunks(chunks: DataFrame, key: str = "chunk_id") -> DataFrame:
    """(name, content, num_sequences): a tar of gzipped JSON arrays for each chunk, in order of ``place``."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        name, out = str(rows[key].iloc[0]), io.BytesIO()
        with tarfile.open(fileobj=out, mode="w") as tar:
            for i, tokens in enumerate(rows["tokens"]):
                data = gzip.compress(json.dumps([int(x) for x in tokens]).encode(), mtime=0)
                info = tarfile.TarInfo(f"{name}_{i}.json.gz")
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
        return pd.DataFrame({"name": [f"{name}.tar"], "content": [out.getvalue()], "num_sequences": [len(rows)]})

    return chunks.select(F.col(key), "place", "tokens").groupBy(key).applyInPandas(pack, "name string, content binary, num_sequences long")


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """Writes (name, content) rows to a folder shared by all executors; (name, bytes) of what was written."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pathlib import Path

        for pdf in batches:
            for name, content in zip(pdf["name"], pdf["content"]):
                target = Path(folder) / name
                target.parent.mkdir(parents=True, exist_ok=True)
                part = target.with_suffix(f"{target.suffix}.part")
                part.write_bytes(content)
                part.replace(target)  # a retry writes the same file again
            yield pd.DataFrame({"name": pdf["name"], "bytes": [len(c) for c in pdf["content"]]})

    return files.select("name", "content").mapInPandas(write, "name string, bytes long")
