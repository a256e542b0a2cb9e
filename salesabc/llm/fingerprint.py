"""SimHash document fingerprints and their search within a Hamming radius.

A text's terms are its runs of two words (a single word for one-word texts),
lower-cased and cut at white space; each distinct term votes with weight
1 + ln(occurrences) for or against every bit, by its hash.  ``likeness`` of two
fingerprints is the cosine of their term vectors as their bit distance
estimates it (0 at half of the bits and beyond).

``within_radius`` finds all fingerprints near given ones by permuted block
tables: a fingerprint has two lanes of 64 bits; within a radius of 2k + 1 one
lane differs in at most k bits.  A lane is cut into blocks; for every choice of
blocks that may hold all differences, the other blocks are the key of a table.

Defined cases: a null or blank text has the zero fingerprint; equal texts have
equal fingerprints; an empty table gives an empty result; extra columns are
ignored.  Ids must be integers; a null id sorts before all others.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_words, mix64, text_array, words_of, written

LANES = 2
BITS = 64 * LANES
#: Terms whose bits are weighed at once.
BLOCK = 1 << 14
#: Documents that one bucket of neighbours should hold, and the most id cells.
BUCKET_ROWS, MOST_CELLS = 2000, 131_072


def simhash_all(texts: pa.Array) -> np.ndarray:
    """Fingerprints of all texts, one row of LANES unsigned 64-bit numbers each."""
    flat, offsets = words_of(texts)
    words = hash_words(flat)
    out = np.zeros((len(texts), LANES), np.uint64)
    salts = mix64(np.arange(1, LANES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for i in range(len(texts)):
        own = words[offsets[i]:offsets[i + 1]]
        if not len(own):
            continue
        terms = mix64(own[:-1] * np.uint64(0x9E3779B97F4A7C15) + own[1:]) if len(own) > 1 else own
        terms, count = np.unique(terms, return_counts=True)
        weight = (1 + np.log(count)).astype(np.float32)
        votes = np.zeros(BITS, np.float32)
        for lo in range(0, len(terms), BLOCK):
            lanes = mix64(terms[lo:lo + BLOCK, None] ^ salts[None, :]).astype("<u8")
            bits = np.unpackbits(lanes.view(np.uint8), axis=1, bitorder="little")
            votes += weight[lo:lo + BLOCK] @ bits.astype(np.float32)
        out[i] = np.packbits(votes * 2 > weight.sum(), bitorder="little").view("<u8")
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    distance = np.bitwise_count(a ^ b).sum(axis=-1)
    return np.maximum(0.0, np.cos(np.pi * distance / BITS))


def _hex(fps: np.ndarray) -> list[str]:
    return ["".join(f"{x:016x}" for x in row) for row in fps.tolist()]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint as hex digits) of every document."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_hex(simhash_all(text_array(batch.column(1)))), pa.string())], [id_col, "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, f"`{id_col}` {kind}, fingerprint string")


def beside_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(bucket, tail, id, text), sorted in its partitions so that each row is followed by the next id of its bucket.

    The id range is cut into cells, and runs of cells with about
    ``BUCKET_ROWS`` documents make a bucket; a bucket's last row (tail) is a
    copy of the first row of the next one, and the last bucket's of the first.
    Only ids are read to lay out buckets; texts are shuffled once.  Buckets
    are streamed, so an uneven id range costs time in one task, not memory.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    n, low, high, nulls = ids.agg(F.count("*"), F.min("id"), F.max("id"), F.count_if(F.col("id").isNull())).first()
    low, high = (0, 0) if low is None else (low, high)
    low -= bool(nulls)
    cells = int(max(1, min(MOST_CELLS, 8 * n // BUCKET_ROWS + 1, high - low + 1)))
    width = -(-(high - low + 1) // cells)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(low))
    wide = "long" if high - low < 1 << 62 else "decimal(20,0)"  # a wider span would overflow
    cell = F.call_function("div", key.cast(wide) - F.lit(low).cast(wide), F.lit(width).cast(wide)).cast("int")
    counts = docs.select(key.alias("key"), cell.alias("cell")).groupBy("cell").agg(F.count("*").alias("n"), F.min("key").alias("first")).collect()
    of_cell, firsts, filled = [0] * cells, [], 0
    got = {r["cell"]: r for r in counts}  # at most MOST_CELLS rows
    for c in range(cells):
        if c in got:
            if not firsts or filled >= BUCKET_ROWS:
                firsts.append(got[c]["first"])
                filled = 0
            filled += got[c]["n"]
        of_cell[c] = max(0, len(firsts) - 1)
    numbers = lambda xs, suffix: "array(" + ",".join(f"{x}{suffix}" for x in xs) + ")"
    last = max(0, len(firsts) - 1)
    bucket = F.element_at(F.expr(numbers(of_cell, "")), F.col("_cell") + 1)
    first = F.element_at(F.expr(numbers(firsts or [0], "L")), F.col("bucket") + 1)
    before = F.when(F.col("bucket") == 0, F.lit(last)).otherwise(F.col("bucket") - 1)
    here = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("tail"))
    rows = (docs.select(key.alias("_key"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), cell.alias("_cell"))
            .withColumn("bucket", bucket)
            .withColumn("_at", F.explode(F.when(F.col("_key") == first, F.array(here, F.struct(before.alias("bucket"), F.lit(1).alias("tail")))).otherwise(F.array(here))))
            .select(F.col("_at.bucket").alias("bucket"), F.col("_at.tail").alias("tail"), "_key", "id", "text"))
    return rows.repartition("bucket").sortWithinPartitions("bucket", "tail", "_key", "text")


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its edited text's and its follower's likeness.

    The edited text has the last half of the code points (rounded down)
    replaced by as many first ones of the next document by id, or all if it
    has fewer; the last document is followed by the first.
    """

    def work(held):
        """held: rows (bucket, tail, id, text) whose follower in the list is known; the last row only follows."""
        use = [k for k in range(len(held) - 1) if not held[k][1] and held[k][0] == held[k + 1][0]]
        if not use:
            return None
        texts = [row[3] for row in held]
        edited = [texts[k][:len(texts[k]) - len(texts[k]) // 2] + texts[k + 1][:len(texts[k]) // 2] for k in use]
        own = simhash_all(pa.array(texts, pa.large_string()))
        new = simhash_all(pa.array(edited, pa.large_string()))
        at = np.array(use)
        return pa.RecordBatch.from_arrays([
            pa.array([held[k][2] for k in use], pa.int64()), pa.array([len(texts[k]) for k in use], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), pa.array(_hex(own[at])), pa.array(_hex(new)),
            pa.array(likeness(own[at], new)), pa.array(likeness(own[at], own[at + 1]))],
            [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                held += zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(3).to_pylist(), text_array(part.column(4)).to_pylist())
                if (done := work(held)) is not None:
                    yield done
                held = held[-1:]

    schema = f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return beside_next(docs, id_col, text_col).mapInArrow(run, schema)


def block_tables(radius: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(lane, [(first bit, bits)] of the key) of every table that a search within the radius needs."""
    k = radius // LANES
    blocks = k + 2
    cut = [64 * i // blocks for i in range(blocks + 1)]
    return [(lane, [(cut[b], cut[b + 1] - cut[b]) for b in kept]) for lane in range(LANES) for kept in combinations(range(blocks), blocks - k)]


def _table_keys(fps: DataFrame, radius: int) -> DataFrame:
    """A row for each table: table, key, lane0, lane1 of distinct fingerprints."""
    keys = []
    for number, (lane, kept) in enumerate(block_tables(radius)):
        key = F.lit(0).cast("long")
        for first, bits in kept:
            part = F.shiftrightunsigned(F.col(f"lane{lane}"), first).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
            key = F.shiftleft(key, bits).bitwiseOR(part)
        keys.append(F.struct(F.lit(number).alias("table"), key.alias("key")))
    return fps.select("lane0", "lane1", F.explode(F.array(*keys)).alias("k")).select("k.table", "k.key", "lane0", "lane1")


def _lanes(fps: DataFrame) -> DataFrame:
    both = [F.conv(F.substring("fingerprint", 16 * i + 1, 16), 16, -10).cast("long").alias(f"lane{i}") for i in range(LANES)]
    return fps.where("fingerprint is not null").select(*both).distinct()


def within_radius(queries: DataFrame, fps: DataFrame, radius: int = 6) -> DataFrame:
    """(query, fingerprint, distance) of all distinct fingerprints of ``fps`` within the radius of those of ``queries``.

    Both have a column fingerprint (hex digits).  Copies are not expanded:
    join the result with either table to get ids.
    """
    query = _table_keys(_lanes(queries), radius).withColumnsRenamed({"lane0": "q0", "lane1": "q1"})
    distance = F.bit_count(F.col("q0").bitwiseXOR(F.col("lane0"))) + F.bit_count(F.col("q1").bitwiseXOR(F.col("lane1")))
    near = (query.join(_table_keys(_lanes(fps), radius), ["table", "key"]).where(distance <= radius)
            .select("q0", "q1", "lane0", "lane1", distance.alias("distance")).distinct())
    name = lambda *c: F.lower(F.concat(*[F.lpad(F.hex(x), 16, "0") for x in c]))
    return near.select(name("q0", "q1").alias("query"), name("lane0", "lane1").alias("fingerprint"), "distance")


def search(docs: DataFrame, asked, id_col: str = "doc_id", text_col: str = "text", radius: int = 6) -> DataFrame:
    """All fingerprints within the radius of those of the rows for which ``asked`` holds.

    A row for each asking document and fingerprint near its own (its own
    too): id, fingerprint, near_fingerprint, distance, near_id (the least
    id with that fingerprint), near_docs (documents that have it).
    """
    own = written(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = written(own.groupBy("fingerprint").agg(F.min(id_col).alias("near_id"), F.count("*").alias("near_docs")), "fingerprint-classes")
    asking = own.where(asked)
    near = written(within_radius(asking.select("fingerprint").distinct(), classes, radius), "near-fingerprints")
    named = near.join(classes, "fingerprint").select("query", F.col("fingerprint").alias("near_fingerprint"), "distance", "near_id", "near_docs")
    return asking.join(named, F.col("fingerprint") == F.col("query")).select(id_col, "fingerprint", "near_fingerprint", "distance", "near_id", "near_docs")
