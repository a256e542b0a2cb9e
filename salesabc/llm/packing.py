"""Best-fit sequence packing by exact-complement hashing.

``token_pieces`` tokenises documents and cuts those longer than the capacity;
``best_fit_packing`` places pieces into sequences.  The plan depends on the
piece lengths alone: a histogram of at most ``capacity`` counts goes to the
driver, which indexes the sums of one, two and three lengths, consumes the
combinations that exactly fill the gap beside each longest piece as often as
the counts allow, and then fills what is left best-fit.  The plan (some
thousand rows, bounded by the capacity and not by the data) goes back as a
small table; each piece finds its place by its rank among the pieces of its
length.  Ranks are counted in salted buckets, so a length that a third of all
pieces share is spread over many tasks.

Defined cases: a null text is empty; an empty text is one piece holding the
end token alone; repeated rows are packed as often as they come; a null id
stays null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import process_cache, text_array, written

CAPACITY = 2048
END_ID = 0
#: Pieces of one length that are ranked together.
RANK_ROWS = 2_000
#: Unicode white space, as the tokenizer's pattern means it.
_SPACE = r"[\s\x0B\x{85}\p{Z}]"
#: Texts in which a plain space touches other white space or an end, or which end in white space.
_ODD = rf"(?s)^ | {_SPACE}|{_SPACE} |{_SPACE}\z"


def _encoding(ranks_path: str, pattern: str):
    cache = process_cache()
    key = ("encoding", ranks_path)
    if key not in cache:
        import base64

        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        cache[key] = own, sizes
    return cache[key]


def encode_texts(texts: pa.Array, ranks_path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts, flat, and the offsets of each text.

    A split before a lone space never cuts a pre-token, so each distinct
    space-led word of the batch is encoded once, in one joined string, and
    the ids are gathered per text.  Texts in which a space touches other
    white space are encoded whole.
    """
    encoding, sizes = _encoding(ranks_path, pattern)
    odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
    plain = pc.if_else(pa.array(odd), pa.scalar("", texts.type), texts) if odd.any() else texts
    split = pc.split_pattern(plain, " ")
    offsets = split.offsets.to_numpy().astype(np.int64)
    flat, offsets = split.flatten(), offsets - offsets[0]
    coded = flat.dictionary_encode()
    words = coded.dictionary
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    some = words.filter(pa.array(size > 0))
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some), pa.scalar(" ", some.type))[0].as_py()
    pool = np.asarray(encoding.encode_ordinary(" " + joined) if joined else [], dtype=np.uint32)
    ends = np.cumsum(sizes[pool])
    word_ends = np.cumsum(size + (size > 0))
    tok_end = np.searchsorted(ends, word_ends, side="right")
    tok_start = np.concatenate(([0], tok_end[:-1])) if len(tok_end) else tok_end
    start, count = tok_start[index], (tok_end - tok_start)[index]
    # The first word of a text has no space before it; an odd text is encoded as it is.
    heads, extra, at = offsets[:-1], [pool], len(pool)
    whole = texts.filter(pa.array(odd)).to_pylist() if odd.any() else []
    first = flat.take(pa.array(heads)).to_pylist() if len(heads) else []
    known: dict[str, tuple[int, int]] = {}
    rest = iter(whole)
    for i, (place, is_odd) in enumerate(zip(heads, odd)):
        word = next(rest) if is_odd else first[i]
        got = known.get(word)
        if got is None:
            ids = np.asarray(encoding.encode_ordinary(word), dtype=np.uint32)
            got = at, len(ids)
            extra.append(ids)
            at += len(ids)
            if len(word) < 64:
                known[word] = got
        start[place], count[place] = got
    pool = np.concatenate(extra)
    done = np.concatenate(([0], np.cumsum(count)))
    gather = np.arange(done[-1], dtype=np.int64) + np.repeat(start - done[:-1], count)
    return pool[gather], done[offsets]


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 keep_ids: bool = False) -> DataFrame:
    """Tokenise each text, add the end token, and cut into pieces.

    Rows: id, piece (from 0), start (ids before it in its document), length,
    ids_crc32 (of its ids as little-endian unsigned 32-bit numbers) and, with
    ``keep_ids``, the ids.  Only documents longer than the capacity are cut;
    their pieces are full except the first, which may be shorter.
    """
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    end = np.array([END_ID], np.uint32)

    def pieces(batches):
        for batch in batches:
            keys, texts = batch.column(0), text_array(batch.column(1))
            step = 4000
            for lo in range(0, len(texts), step):
                ids, offsets = encode_texts(text_array(texts.slice(lo, step)), ranks, pattern)
                row, piece, start, length, crc, kept = [], [], [], [], [], []
                for i in range(len(offsets) - 1):
                    own = np.concatenate((ids[offsets[i]:offsets[i + 1]], end))
                    n, a = len(own), 0
                    b = n if n <= capacity else (n % capacity or capacity)
                    k = 0
                    while a < n:
                        part = own[a:b]
                        row.append(lo + i), piece.append(k), start.append(a), length.append(b - a)
                        crc.append(zlib.crc32(part.astype("<u4", copy=False)))
                        if keep_ids:
                            kept.append(part)
                        a, b, k = b, b + capacity, k + 1
                cols = [keys.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = [id_col, "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    cols.append(pa.array([p.astype(np.int32) for p in kept], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(pieces, schema)


class _Lengths:
    """Available lengths with counts; bit sets answer which of two or three lengths add up to a sum."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity, self.count = capacity, dict(histogram)
        self.have = self.mirror = 0
        for x, n in histogram.items():
            if n > 0:
                self.have |= 1 << x
                self.mirror |= 1 << (capacity - x)

    def take(self, x: int, n: int) -> None:
        self.count[x] -= n
        if not self.count[x]:
            self.have &= ~(1 << x)
            self.mirror &= ~(1 << (self.capacity - x))

    def largest(self, most: int) -> int:
        """The largest available length of at most ``most``; 0 if there is none."""
        return (self.have & ((1 << (most + 1)) - 1)).bit_length() - 1 if self.have & ((1 << (most + 1)) - 1) else 0

    def pair(self, total: int) -> tuple[int, int] | None:
        """Available x >= y with x + y = total, x as large as it can be."""
        both = self.have & (self.mirror >> (self.capacity - total)) & ((1 << total) - 1)
        while both:
            x = both.bit_length() - 1
            if 2 * x != total or self.count[x] > 1:
                return x, total - x
            both &= ~(1 << x)
        return None

    def exact(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that add up to the gap."""
        if self.have >> gap & 1:
            return (gap,)
        if two := self.pair(gap):
            return two
        z = self.largest(gap - 2) if gap > 2 else 0
        while z and 3 * z >= gap:
            self.count[z] -= 1
            if self.count[z]:
                two = self.pair(gap - z)
            else:
                keep = self.have, self.mirror
                self.have, self.mirror = self.have & ~(1 << z), self.mirror & ~(1 << (self.capacity - z))
                two = self.pair(gap - z)
                self.have, self.mirror = keep
            self.count[z] += 1
            if two:
                return (z, *two)
            z = self.largest(z - 1)
        return None


def plan_patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, number of such sequences), using every piece of the histogram once.

    Each step applies one combination as often as the counts allow, so it
    uses up a length; the number of steps is bounded by the capacity.
    """
    left, plan = _Lengths(histogram, capacity), []
    while left.have:
        combo = [left.have.bit_length() - 1]
        left.count[combo[0]] -= 1
        emptied = [combo[0]] if not left.count[combo[0]] else []

        def hide(x):
            left.have &= ~(1 << x)
            left.mirror &= ~(1 << (capacity - x))

        for x in emptied:
            hide(x)
        gap = capacity - combo[0]
        while gap:
            fill = left.exact(gap) or ((x,) if (x := left.largest(gap)) else None)
            if not fill:
                break
            for x in fill:
                combo.append(x)
                gap -= x
                left.count[x] -= 1
                if not left.count[x]:
                    hide(x)
        # The combination was taken once; take it again as often as all its lengths last.
        need = {x: combo.count(x) for x in combo}
        more = min(left.count[x] // n for x, n in need.items())
        for x, n in need.items():
            if left.count[x]:
                left.take(x, n * more) if more else None
        plan.append((tuple(combo), 1 + more))
    return plan


def best_fit_packing(pieces: DataFrame, keys: list[str], capacity: int = CAPACITY, length_col: str = "length") -> DataFrame:
    """Add sequence_id and offset to pieces of at most ``capacity`` tokens.

    ``keys`` order pieces of the same length; equal keys are interchangeable.
    The input is read three times (histogram, bucket counts, places), so hand
    over a written table.
    """
    spark = pieces.sparkSession
    length = F.col(length_col)
    histogram = {r[0]: r[1] for r in pieces.groupBy(length).count().collect()}  # at most `capacity` rows
    if any(x is None or not 0 < x <= capacity for x in histogram):
        raise ValueError("piece lengths must be between 1 and the capacity")
    slots, taken, sequence = [], dict.fromkeys(histogram, 0), 0
    for combo, times in plan_patterns(histogram, capacity):
        offset = 0
        for x in combo:
            slots.append((x, taken[x], taken[x] + times, sequence, offset))
            taken[x] += times
            offset += x
        sequence += times
    slot_rows = spark.createDataFrame(slots, "_len long, _lo long, _hi long, _seq long, _off long")
    spread = spark.createDataFrame([(x, -(-n // RANK_ROWS)) for x, n in histogram.items()], "_len long, _spread long")
    salted = (pieces.join(F.broadcast(spread), length == F.col("_len")).drop("_len")
              .withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.col("_spread"))).drop("_spread"))
    per = salted.groupBy(length.alias("_len"), F.col("_bucket").alias("_b")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_len").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("_len", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy(length, "_bucket").orderBy(*keys)
    ranked = (salted.withColumn("_rn", F.row_number().over(own))
              .join(per, (length == F.col("_len")) & (F.col("_bucket") == F.col("_b"))).drop("_len", "_b")
              .withColumn("_rank", F.col("_base") + F.col("_rn") - 1))
    placed = ranked.join(F.broadcast(slot_rows), (length == F.col("_len")) & (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi")))
    return placed.select(*pieces.columns, (F.col("_seq") + F.col("_rank") - F.col("_lo")).alias("sequence_id"), F.col("_off").alias("offset"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   keep_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack documents: the columns of ``token_pieces``, sequence_id and offset."""
    pieces = written(token_pieces(docs, id_col, text_col, capacity, keep_ids), "pieces")
    return best_fit_packing(pieces, [id_col, "piece", "ids_crc32"], capacity)


def sequences(placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, from ``pack_documents(keep_ids=True)``.

    A group holds one sequence, so at most ``capacity`` tokens.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
