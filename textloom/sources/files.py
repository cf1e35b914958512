"""Readers and writers: JSON lines, WARC, CSV, experiment folders, and file listings."""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def list_shard_files(spark: SparkSession, folder: str, num_shards: int | None = None, filters: list[str] = (), file_range: tuple[int, int] | None = None) -> list[str]:
    """Data files below a folder, sorted; first so many, then those with a part of the name, then a half-open range (-1: to the end)."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    names = sorted(r[0] for r in found.filter(~F.col("path").rlike("/(global_)?stats")).collect())
    names = names[:num_shards] if num_shards is not None else names
    names = [n for n in names if all(f in n for f in filters)]
    return names if file_range is None else names[file_range[0] : None if file_range[1] == -1 else file_range[1]]


def read_jsonl(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    """JSON lines, plain, gzip or zstd by the file's ending, with the file in ``shard``.

    Give a schema for large inputs: without one Spark reads everything twice.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    df = (reader.schema(schema) if schema else reader).json(path)
    return df.withColumn("shard", F.col("_metadata.file_path"))


def read_zstd_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines in ``.zstd`` files, decoded in the workers as a stream."""
    import zstandard

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                held = []
                for line in io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content)), "utf-8"):
                    held.append(line.rstrip("\n"))
                    if len(held) == 5000:
                        yield pd.DataFrame({"value": held, "shard": name})
                        held = []
                yield pd.DataFrame({"value": held, "shard": name})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInPandas(run, "value string, shard string").select(F.from_json("value", schema).alias("row"), "shard").select("row.*", "shard")


def write_jsonl(df: DataFrame, path: str, compression: str = "gzip", mode: str = "error", max_records: int = 0) -> None:
    df.write.mode(mode).option("compression", compression).option("maxRecordsPerFile", max_records).json(path)


def csv_to_jsonl(spark: SparkSession, source: str, target: str, schema: str | None = None) -> None:
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    (reader.schema(schema) if schema else reader).csv(source).write.json(target)


def jsonl_to_csv(spark: SparkSession, source: str, target: str, columns: list[str] | None = None) -> None:
    df = spark.read.json(source)
    df.select(*(columns or df.columns)).write.option("header", True).option("escape", '"').csv(target)


def warc_records(data: bytes) -> Iterator[dict]:
    """Records of a WARC file, gzip members or plain: headers (lower case) and body; a damaged tail ends the file."""
    stream = io.BytesIO(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        head: dict[str, str] = {}
        while (line := stream.readline().strip()) and b":" in line:
            k, _, v = line.decode("utf-8", "replace").partition(":")
            head[k.strip().lower()] = v.strip()
        yield {"headers": head, "body": stream.read(int(head.get("content-length") or 0))}


def read_warc(spark: SparkSession, path: str, kinds: tuple[str, ...] = ("response",)) -> DataFrame:
    """(url, record_id, date, metadata, html, shard); bodies that aren't UTF-8 are left out. For WET, kinds=("conversion",)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                rows = []
                for r in warc_records(content):
                    h = r["headers"]
                    if h.get("warc-type") not in kinds:
                        continue
                    body = r["body"].partition(b"\r\n\r\n")[2] if h["warc-type"] == "response" else r["body"]
                    try:
                        rows.append((h.get("warc-target-uri"), h.get("warc-record-id"), h.get("warc-date"), h, body.decode("utf-8"), name))
                    except UnicodeDecodeError:
                        continue
                    if len(rows) == 500:
                        yield pd.DataFrame(rows, columns=["url", "record_id", "date", "metadata", "html", "shard"])
                        rows = []
                yield pd.DataFrame(rows, columns=["url", "record_id", "date", "metadata", "html", "shard"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInPandas(run, "url string, record_id string, date string, metadata map<string,string>, html string, shard string")


def read_experiments(spark: SparkSession, folder: str) -> DataFrame:
    """One row a JSON file, structs as dotted columns, with its file in ``_source_json``."""
    from textloom.operators.relational import flatten

    df = spark.read.option("multiLine", True).option("recursiveFileLookup", True).json(folder)
    return flatten(df.withColumn("_source_json", F.col("_metadata.file_path")))


def sample_keys(keys: DataFrame, pattern: str, n: int, key: str = "key", seed: int = 0) -> DataFrame:
    """``n`` of the keys that match, in the order of a hash."""
    return keys.filter(F.col(key).rlike(pattern)).orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)
