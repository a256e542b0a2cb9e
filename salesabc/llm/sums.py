"""Sums of equally long vectors by key, and vectors packed as bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: A key, and a vector of it as compressed little-endian bytes.
SCHEMA = "key int, size long, vector binary"
_CODEC = "zstd"


def packed(key: int, vector: np.ndarray) -> pa.RecordBatch:
    """A row of SCHEMA."""
    raw = np.ascontiguousarray(vector).tobytes()
    return pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([len(raw)], pa.int64()), pa.array([pa.compress(raw, codec=_CODEC, asbytes=True)])],
                                      ["key", "size", "vector"])


def unpacked(size: int, vector: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(pa.decompress(vector, size, codec=_CODEC, asbytes=True), kind)


def summed(parts: DataFrame, kind: str, add: np.ufunc = np.add) -> dict[int, np.ndarray]:
    """The sum (or another reduction) of all vectors of each key, on the driver.

    The callers' keys and vectors are as many and as long whatever the input's
    size.  A task holds one running sum, however many rows a key has.
    """

    def run(batches):
        key, total = None, None
        for batch in batches:
            for k, size, vector in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = unpacked(size, vector, kind)
                if k != key:
                    if key is not None:
                        yield packed(key, total)
                    key, total = k, own
                else:
                    total = add(total, own)
        if key is not None:
            yield packed(key, total)

    rows = parts.repartition("key").sortWithinPartitions("key").mapInArrow(run, SCHEMA).collect()
    return {r["key"]: unpacked(r["size"], r["vector"], kind) for r in rows}
