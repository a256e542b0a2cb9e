"""SimHash near-duplicates: fingerprints of word shingles, linked within a Hamming radius.

Fingerprints: texts are ASCII-lower-cased, cut into words at ASCII white
space, and every run of ``shingle`` words (space-joined; a shorter text gives
its whole sequence) votes with its XXH64 (seed 42); a bit is set if it is set
in over half of the hashes.  Links come from ``hamming.near_links`` over the
distinct fingerprints, groups from connected components.

Defined cases: a null or wordless text has fingerprint zero and links like any
other; repeated rows share a fingerprint; a null id keeps its row, but never
names a component unless no other id is there; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_array, written
from .graph import connected_components
from .hamming import near_links

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Shingle hashes whose bits are summed at once.
BLOCK = 1 << 16


def simhash(text: str, shingle: int) -> int:
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    if len(words) > shingle:
        start, end = start[: len(words) - shingle + 1], end[shingle - 1:]
    else:
        start, end = start[:1], end[-1:]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(start.tolist(), end.tolist())), np.uint64, len(start))
    votes = np.zeros(64, np.int64)
    for lo in range(0, len(h), BLOCK):
        bits = np.unpackbits(h[lo:lo + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, the ``carry`` columns, fp long) of every document."""
    names = [id_col, *carry]

    def run(batches):
        for batch in batches:
            fps = np.fromiter((simhash(t, shingle) for t in text_array(batch.column(len(names))).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array(fps.view(np.int64))], [*names, "fp"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    return docs.select(*names, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, f"{kinds}, fp long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, carry: tuple[str, ...] = ()) -> DataFrame:
    """id, the ``carry`` columns, fingerprint (16 hex digits), component_id and component_fingerprint.

    The component id is the least id reachable over links of at most
    ``radius`` bits, the component fingerprint the least one.
    """
    hexed = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    own = written(fingerprints(docs, id_col, text_col, shingle, carry), "fingerprints")
    distinct = written(own.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct-fingerprints")
    groups = connected_components(near_links(distinct.select("fp"), radius))
    named = distinct.join(groups, distinct["fp"] == groups["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    label = written(named.join(least, "component").select("fp", "component", "component_id"), "labels")
    return own.join(label, "fp").select(id_col, *carry, hexed("fp").alias("fingerprint"), "component_id", hexed("component").alias("component_fingerprint"))
