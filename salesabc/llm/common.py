"""Helpers shared by the operators: inputs, scratch tables, token hashing."""

from __future__ import annotations

import os
import sys
import tempfile
import types
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, as every contract here defines words.
WORD_SPACE = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may run without that setting; it then gets a private
    folder.  A cluster without it is an error, because executors could not
    see a folder on the driver's machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="salesabc-scratch-")
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it again.

    It cuts the lineage: a lost executor costs only the tasks that ran on it,
    and later readers all see the same rows.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, _UPPER, _LOWER)


def process_cache() -> dict:
    """A dictionary that lives as long as a Python worker does."""
    name = "_salesabc_llm_process_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def text_array(column) -> pa.Array:
    """An Arrow string column as one array, nulls as empty texts.

    A slice is copied to an array of its own: some string kernels misread
    arrays that begin inside a buffer.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.offset:
        column = column.take(pa.array(np.arange(len(column))))
    return pc.fill_null(column.cast(pa.large_string()), "")


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of ASCII-lower-cased texts, flat, and the offsets of each text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, offsets = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    keep = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not keep.all():
        before = np.concatenate(([0], np.cumsum(keep)))
        flat, offsets = flat.filter(pa.array(keep)), before[offsets]
    return flat, offsets


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hash_words(flat: pa.Array) -> np.ndarray:
    """XXH3 of every word as uint64; each distinct word is hashed once."""
    import xxhash

    coded = flat.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    digest = xxhash.xxh3_64_intdigest
    own = np.fromiter((digest(w) for w in coded.dictionary.to_pylist()), dtype=np.uint64, count=len(coded.dictionary))
    return own[coded.indices.to_numpy(zero_copy_only=False)] if len(flat) else np.zeros(0, np.uint64)
