"""Work lists over folders, what is left of them, and cards of finished datasets. Spark itself schedules and retries."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def tasks(spark: SparkSession, files: list[str], chunk: int | None = None, by_subject: bool = False) -> DataFrame:
    """(task, folder, files): one task a folder, a ``subject=`` folder, or ``chunk`` files of a folder."""
    rows = spark.createDataFrame([(f,) for f in files], "file string")
    folder = F.regexp_extract("file", r"^(.*subject=[^/]*)" if by_subject else r"^(.*)/[^/]*$", 1)
    n = F.row_number().over(Window.partitionBy("folder").orderBy("file")) - 1
    part = rows.withColumn("folder", folder).withColumn("part", F.floor(n / chunk) if chunk else F.lit(0))
    made = part.groupBy("folder", "part").agg(F.array_sort(F.collect_list("file")).alias("files"))
    return made.select(F.md5(F.concat_ws("|", "folder", "part")).alias("task"), "folder", "files")


def left_over(todo: DataFrame, finished: DataFrame, key: str = "task") -> DataFrame:
    return todo.join(finished.select(key).distinct(), key, "left_anti")


def dataset_card(name: str, url: str, manifest: DataFrame, sources: list[dict] = (), tokenizer: str | None = None, seqlen: int = 2049, size: int | None = None) -> dict:
    """The record of a dataset, with its number of tokens by the manifest."""
    sequences = manifest.agg(F.coalesce(F.sum("num_sequences"), F.lit(0))).first()[0]
    return {
        "uuid": str(uuid.uuid5(uuid.NAMESPACE_URL, url)),
        "name": name,
        "creation_date": datetime.datetime.now(datetime.timezone.utc).isoformat(),
        "dataset_url": url,
        "manifest_url": f"{url.rstrip('/')}/manifest",
        "sources": [{"uuid": s.get("uuid"), "name": s.get("name")} for s in sources],
        "tokenized": tokenizer is not None,
        "tokenizer": tokenizer,
        "num_tokens": sequences * seqlen,
        "size": size,
    }
