"""Tokens, fixed contexts, shuffled chunks and their manifest."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import running
from textloom.functions import text as T
from textloom.registry import fresh

EOT, VOCABULARY = 0, 50_257


def hashed_ids(text: Column, vocabulary: int = VOCABULARY) -> Column:
    """Stand-in ids of words between white space; any UDF from text to an array of ids can take its place."""
    return F.transform(T.tokens(text), lambda w: (F.pmod(F.crc32(w.cast("binary")), F.lit(vocabulary - 1)) + 1).cast("int"))


def with_tokens(df: DataFrame, text_col: str = "text", encode: Callable[[Column], Column] = hashed_ids, eot: int = EOT, bos: int | None = None) -> DataFrame:
    """Adds ``tokens``, each text's ids and an end-of-text, after a begin-of-text where one is given."""
    ids = F.concat(F.coalesce(encode(F.col(text_col)), F.array().cast("array<int>")), F.array(F.lit(eot)))
    return df.withColumn("tokens", ids if bos is None else F.concat(F.array(F.lit(bos)), ids))


def file_tokens(text: Column, path: str) -> Column:
    """Ids by a public vocabulary file (JSON of the ``tokenizers`` library), read once a worker."""

    @F.arrow_udf("array<int>")
    def run(arr: pa.Array) -> pa.Array:
        from tokenizers import Tokenizer

        if path not in _loaded:
            _loaded[path] = Tokenizer.from_file(path)
        known = _loaded[path]
        got = known.encode_batch([t or "" for t in arr.to_pylist()], add_special_tokens=False)
        return pa.array([g.ids for g in got], pa.list_(pa.int32()))

    return run(text)


_loaded: dict = {}


def contexts(df: DataFrame, seqlen: int = 2049, key: str = "source", id_col: str = "doc_id", pad: int = VOCABULARY + 2) -> DataFrame:
    """(key, context, tokens): each subject's texts in id order, cut into fixed contexts; the tail is padded.

    Texts get their offsets by a running sum and are cut into the contexts that they reach; only slices are shuffled.
    """
    n = F.size("tokens")
    placed = running.before(df.select(key, id_col, "tokens"), [key], [id_col], n.cast("long"), "at")
    first, last = F.floor(F.col("at") / seqlen), F.floor((F.col("at") + n - 1) / seqlen)
    cut = placed.withColumn("context", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.lit(0), F.col("context") * seqlen - F.col("at")).cast("int")
    hi = F.least(n.cast("long"), (F.col("context") + 1) * seqlen - F.col("at")).cast("int")
    parts = cut.select(key, "context", "at", F.slice("tokens", lo + 1, hi - lo).alias("part"))
    whole = parts.groupBy(key, "context").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "part"))), lambda x: x["part"])).alias("tokens"))
    fill = F.array_repeat(F.lit(pad), F.lit(seqlen) - F.size("tokens"))
    return whole.withColumn("tokens", F.concat("tokens", fill))


def shuffle_chunks(ctx: DataFrame, chunk: int = 8192, cells: int = 128, seed: int = 0, key: str = "source") -> DataFrame:
    """Adds ``chunk_id`` and ``place``: contexts in a random order, ``chunk`` to a chunk within each of ``cells`` cells."""
    mark, n = fresh(ctx, "mark"), fresh(ctx, "n_before")
    cell = ctx.withColumn(mark, F.xxhash64(key, "context", F.lit(seed))).withColumn("cell", F.pmod(mark, F.lit(cells)))
    placed = running.before(cell, ["cell"], [mark, key, "context"], F.lit(1).cast("long"), n)
    return placed.withColumn("chunk_id", F.concat_ws("_", "cell", F.floor(F.col(n) / chunk))).withColumn("place", F.pmod(n, F.lit(chunk))).drop(n, mark)


def manifest(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy(F.col("chunk_id").alias("shard")).agg(F.count("*").alias("num_sequences"))


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Chunks as folders of JSON lines with their manifest beside them."""
    chunks.repartition("chunk_id").sortWithinPartitions("chunk_id", "place").select("chunk_id", "tokens").write.partitionBy("chunk_id").option("compression", "gzip").json(f"{path}/chunks")
    manifest(chunks).coalesce(1).write.json(f"{path}/manifest")
