"""Katz back-off language model over words: count, store, and score whole texts.

Tokens are ASCII-lower-cased words and one end token a text; the model backs
off from word pairs to single words to one class of unknown words.  Counts r
up to five are discounted by Good-Turing; what a context loses goes to the
words not seen after it, in proportion to their lower-order probability, with
a weight that makes the context add up to one exactly.

Work is dealt in blocks (some million tokens of consecutive rows of an input
partition) and buckets (ranges of hashes):

1. every block sends its distinct words to word buckets, which add up counts,
   write the word table, and answer every block with the counts of its words;
2. blocks send the distinct pairs of training texts to pair buckets, which
   write the pair table (partitioned by bucket) with each context's share of
   lower-order probability; the counts of counts come from it;
3. blocks send the pairs of all texts, with the places of their documents;
   a bucket loads its part of the pair table, evaluates the recursion for each
   pair and sends sums per document back to the block.

Contexts that hold a large share of all tokens are dealt by the whole pair, so
no bucket receives one frequent word's pairs alone; there are at most twice as
many such contexts as buckets.  Words are 64-bit hashes, the second word of a
pair 40 bits of it.  Rows between stages are packed, sorted columns.

Tables and answers are read from the shared folder by path through Arrow; an
answer is checked against the block that asks.

Defined cases: a null text is empty and consists of the end token; repeated
rows count as often as they come; a null id counts as held out; without any
training text every token is unknown with probability one; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_words, mix64, scratch, text_array, words_of

K = 5  # counts up to K are discounted
BLOCK_TOKENS = 1_500_000
BUCKET_CHARS = 12_000_000
LEAST_BUCKETS = 48
BEGIN, END = (mix64(np.array([x], np.uint64))[0] for x in (0x1234567, 0x7654321))
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_ROW = "kind string, bucket int, block long, n long, a binary, b binary, c binary, d binary, e binary"


def squeeze(x: np.ndarray) -> bytes:
    """A column as compressed byte planes."""
    import zstandard

    x = np.ascontiguousarray(x)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()) if len(x) else b""


def expand(data: bytes, kind) -> np.ndarray:
    import zstandard

    if not data:
        return np.zeros(0, kind)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def squeeze_sorted(x: np.ndarray) -> bytes:
    return squeeze(np.diff(x, prepend=x.dtype.type(0)))


def expand_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(expand(data, np.uint64), dtype=np.uint64)


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the hash; never decreasing in it."""
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def row(kind: str, bucket: int, block: int, n: int, *cols: bytes) -> pa.RecordBatch:
    cells = [*cols, *[None] * (5 - len(cols))]
    return pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([bucket], pa.int32()), pa.array([block], pa.int64()), pa.array([n], pa.int64()), *(pa.array([c], pa.binary()) for c in cells)],
                                      ["kind", "bucket", "block", "n", "a", "b", "c", "d", "e"])


def discounts(counts: np.ndarray) -> np.ndarray:
    """Katz's d_1..d_K (index 0 unused) from n_1..n_{K+1} (index r holds n_r).

    If the counts of counts give no proper Good-Turing discounts for the first
    k counts, a smaller k is tried, and at last absolute discounting by n_1 and n_2.
    """
    out = np.ones(K + 1)
    for k in range(K, 0, -1):
        n = counts[1:k + 2].astype(float)
        if (n > 0).all():
            r = np.arange(1, k + 1)
            cut = (k + 1) * n[k] / n[0]
            if cut < 1:
                d = ((r + 1) * n[1:] / (r * n[:-1]) - cut) / (1 - cut)
                if ((d > 0) & (d < 1)).all():
                    out[1:k + 1] = d
                    return out
    off = min(0.9, max(0.1, counts[1] / max(1, counts[1] + 2 * counts[2])))
    out[1:] = 1 - off / np.arange(1, K + 1)
    return out


class Words:
    """The lower-order model: probability of a word by its training count (0: the class of unknown words)."""

    def __init__(self, counts_of_counts: np.ndarray, types: int, tokens: int):
        self.types, self.tokens = types, tokens
        self.d = discounts(counts_of_counts)
        r = np.arange(K + 1)
        lost = float((counts_of_counts[:K + 1] * r * (1 - self.d))[1:].sum())
        self.total, self.unknown = (tokens, lost / tokens) if lost > 0 else (tokens + 1, 1 / (tokens + 1))

    def probability(self, c: np.ndarray) -> np.ndarray:
        p = np.where(c <= K, self.d[np.minimum(c, K)], 1.0) * c / self.total
        return np.where(c > 0, p, self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.tokens + 0.1 * (self.types + 1)))


class _Blocks:
    """Cuts a task's batches into blocks of tokens; the same input partition always gives the same blocks."""

    def __init__(self, batches, limit: int):
        self.batches, self.limit = batches, limit

    def __iter__(self):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        held, size = [], 0
        for batch in self.batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                flat, offsets = words_of(text_array(part.column(2)))
                held.append((part.column(0).to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False), hash_words(flat), np.diff(offsets)))
                size += len(flat) + part.num_rows
                if size >= self.limit:
                    yield self.block(number, held)
                    number, held, size = number + 1, [], 0
        if held:
            yield self.block(number, held)

    @staticmethod
    def block(number, held):
        ids, train, words, sizes = (np.concatenate([h[i] for h in held]) for i in range(4))
        stop = np.cumsum(sizes + 1) - 1
        token = np.zeros(stop[-1] + 1, np.uint64)
        is_end = np.zeros(len(token), bool)
        is_end[stop] = True
        token[is_end], token[~is_end] = END, words
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), sizes + 1)
        return number, ids, train.astype(bool), token, doc, stop


def _by_bucket(batches):
    """(bucket, rows) from rows sorted by bucket."""
    bucket, rows = None, []
    for batch in batches:
        for r in batch.to_pylist():
            if bucket is not None and r["bucket"] != bucket:
                yield bucket, rows
                rows = []
            bucket = r["bucket"]
            rows.append(r)
    if rows:
        yield bucket, rows


def _folder_rows(uri: str) -> list[dict]:
    fs, path = pafs.FileSystem.from_uri(uri)
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        return []
    return pads.dataset(path, filesystem=fs, format="parquet").to_table().to_pylist()


def _counts_of(uri: str, block: int, words: np.ndarray, buckets: int) -> np.ndarray:
    """Training counts of a block's distinct words, from the answers to it."""
    got = {r["bucket"]: r for r in _folder_rows(f"{uri}/block={block}")}
    own = bucket_of(words, buckets)
    edges = np.searchsorted(own, np.arange(buckets + 1))
    out = np.zeros(len(words), np.int64)
    for b in range(buckets):
        lo, hi = edges[b], edges[b + 1]
        if lo == hi:
            continue
        r = got.get(b)
        if r is None or r["n"] != hi - lo or r["e"] != _check(words[lo:hi]):
            raise RuntimeError("the input gave other blocks than before; hand over a written table")
        out[lo:hi] = expand(r["c"], np.int64)
    return out


def _check(words: np.ndarray) -> bytes:
    return int(np.bitwise_xor.reduce(mix64(words + np.arange(len(words), dtype=np.uint64)))).to_bytes(8, "little")


def _pairs(token, doc, stop):
    """Context of every token: the token before it, or the beginning."""
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[np.concatenate(([0], stop[:-1] + 1))] = BEGIN
    return context


def _dealt(context, word40, hot: np.ndarray, buckets: int):
    """(bucket, places of its pairs sorted by context and word), for pairs of usual and of frequent contexts."""
    is_hot = np.isin(context, hot)
    for part in (False, True):
        at = np.flatnonzero(is_hot == part)
        c, w = context[at], word40[at]
        b = bucket_of(mix64(c * _PAIR + w), buckets) if part else bucket_of(c, buckets)
        order = np.lexsort((w, c, b)) if part else np.lexsort((w, c))
        at, b = at[order], b[order]
        edges = np.searchsorted(b, np.arange(buckets + 1))
        for k in range(buckets):
            if edges[k] < edges[k + 1]:
                yield k, at[edges[k]:edges[k + 1]]


def _starts(*cols) -> np.ndarray:
    """First places of runs of equal rows."""
    new = np.zeros(len(cols[0]), bool)
    new[:1] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """id, train, n_tokens, n_known, train_tokens, base_score, score of every document.

    ``docs`` has to give the same partitions when it is read again, as a
    table of files does; ids are integers.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).cast("string").alias("text"))
    own = own.withColumn("id", F.coalesce("id", F.lit(np.iinfo(np.int64).min).cast("long")))
    chars = own.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = int(max(LEAST_BUCKETS, chars // BUCKET_CHARS))
    word_table, pair_table = scratch(spark, "lm-words"), scratch(spark, "lm-pairs")

    # 1. Word counts.
    def send_words(batches):
        for block, _, learn, token, doc, _ in _Blocks(batches, block_tokens):
            words, at = np.unique(token, return_inverse=True)
            count = np.bincount(at, weights=learn[doc], minlength=len(words)).astype(np.int64)
            edges = np.searchsorted(bucket_of(words, buckets), np.arange(buckets + 1))
            for b in range(buckets):
                lo, hi = edges[b], edges[b + 1]
                if lo < hi:
                    yield row("words", b, block, hi - lo, squeeze_sorted(words[lo:hi]), squeeze(count[lo:hi]))

    def add_words(batches):
        for b, rows in _by_bucket(batches):
            keys = [expand_sorted(r["a"]) for r in rows]
            words, at = np.unique(np.concatenate(keys), return_inverse=True)
            count = np.bincount(at, weights=np.concatenate([expand(r["b"], np.int64) for r in rows]), minlength=len(words)).astype(np.int64)
            known = count > 0
            yield row("table", b, -1, int(known.sum()), squeeze_sorted(words[known]), squeeze(count[known]), squeeze(np.bincount(np.minimum(count, K + 2), minlength=K + 3)), squeeze(np.array([count.sum()])))
            for r, own_keys in zip(rows, keys):
                yield row("answer", b, r["block"], len(own_keys), None, None, squeeze(count[np.searchsorted(words, own_keys)]), None, _check(own_keys))

    (own.mapInArrow(send_words, _ROW).repartition(buckets, "bucket").sortWithinPartitions("bucket", "block").mapInArrow(add_words, _ROW)
     .repartition(buckets, "block").write.partitionBy("block").parquet(word_table))
    table = spark.read.schema(_ROW).parquet(word_table).where("block = -1")
    # At most one row a bucket, of a few numbers.
    stats = table.select("n", "c", "d").collect()
    seen = sum((expand(r["c"], np.int64) for r in stats), np.zeros(K + 3, np.int64))
    tokens, types = int(sum(expand(r["d"], np.int64)[0] for r in stats)), sum(r["n"] for r in stats)
    model = Words(seen[:K + 2], types, tokens)
    least = max(1, tokens // (2 * buckets))

    def frequent(batches):
        for batch in batches:
            for r in batch.to_pylist():
                count = expand(r["b"], np.int64)
                hot = np.flatnonzero(count >= least)
                words = expand_sorted(r["a"])[hot]
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(count[hot])], ["word", "n"])

    hot_rows = table.select("a", "b").mapInArrow(frequent, "word long, n long").collect() if tokens else []  # at most 2 * buckets
    starts = own.where("train").count()
    hot_count = {int(np.int64(r["word"]).astype(np.uint64)): r["n"] for r in hot_rows if np.int64(r["word"]).astype(np.uint64) != END} | {int(BEGIN): starts}
    hot = np.array(sorted(hot_count), np.uint64)

    # 2. Pair counts of training texts.
    def send_pairs(batches):
        for block, _, learn, token, doc, stop in _Blocks(batches, block_tokens):
            words, at = np.unique(token, return_inverse=True)
            count = _counts_of(word_table, block, words, buckets)
            use = np.flatnonzero(learn[doc])
            context, word = _pairs(token, doc, stop)[use], (token[use] >> np.uint64(24))
            c_word = count[at[use]]
            for b, place in _dealt(context, word, hot, buckets):
                c, w = context[place], word[place]
                first = _starts(c, w)
                n = np.diff(np.concatenate((first, [len(c)])))
                yield row("pairs", b, block, len(first), squeeze_sorted(c[first]), squeeze(w[first]), squeeze(n.astype(np.int32)), squeeze(c_word[place][first]))

    def add_pairs(batches):
        for b, rows in _by_bucket(batches):
            c, w, n, cw = (np.concatenate([f(r) for r in rows]) for f in (lambda r: expand_sorted(r["a"]), lambda r: expand(r["b"], np.uint64), lambda r: expand(r["c"], np.int32), lambda r: expand(r["d"], np.int64)))
            order = np.lexsort((w, c))
            c, w, n, cw = c[order], w[order], n[order].astype(np.int64), cw[order]
            first = _starts(c, w)
            count = np.add.reduceat(n, first)
            c, w, cw = c[first], w[first], cw[first]
            head = _starts(c)
            low = np.add.reduceat(model.probability(cw), head)
            by = np.bincount(np.minimum(count, K + 2), minlength=K + 3)
            group = np.repeat(np.arange(len(head)), np.diff(np.concatenate((head, [len(c)]))))
            some = np.isin(c[head], hot)
            part = np.zeros((len(head), K + 1), np.int64)
            small = count <= K
            np.add.at(part, (group[small], count[small]), 1)
            sums = np.column_stack((low[some], part[some].astype(float)))
            yield row("table", b, 0, len(c), squeeze_sorted(c), squeeze(w), squeeze(count.astype(np.int32)), squeeze(low))
            yield row("stats", b, 0, int(some.sum()), squeeze(by), squeeze(c[head][some]), squeeze(sums.ravel()))

    (own.mapInArrow(send_pairs, _ROW).repartition(buckets, "bucket").sortWithinPartitions("bucket", "block").mapInArrow(add_pairs, _ROW)
     .write.partitionBy("kind", "bucket").parquet(pair_table))
    kinds = spark.read.schema(_ROW).parquet(pair_table)

    def hot_sums(batches):
        for batch in batches:
            for r in batch.to_pylist():
                sums = expand(r["c"], np.float64).reshape(-1, K + 2)
                yield pa.RecordBatch.from_arrays([pa.array(expand(r["b"], np.uint64).view(np.int64)), pa.array(sums.tolist(), pa.list_(pa.float64()))], ["context", "sums"])

    pair_counts = sum((expand(r["a"], np.int64) for r in kinds.where("kind = 'stats'").select("a").collect()), np.zeros(K + 3, np.int64)) if tokens else np.zeros(K + 3, np.int64)
    d2 = discounts(pair_counts[:K + 2])
    hot_weight = {}
    if tokens:
        added = kinds.where("kind = 'stats'").select("b", "c").mapInArrow(hot_sums, "context long, sums array<double>").groupBy("context").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(K + 2)])
        for r in added.collect():  # at most 2 * buckets + 1
            h = int(np.int64(r["context"]).astype(np.uint64))
            lost = sum(r[f"s{i + 1}"] * i * (1 - d2[i]) for i in range(1, K + 1))
            total = hot_count[h] + (lost <= 0)
            hot_weight[h] = (lost if lost > 0 else 1) / total / max(1 - r["s0"], 1e-300), total

    # 3. Evaluation.
    def send_all(batches):
        for block, ids, learn, token, doc, stop in _Blocks(batches, block_tokens):
            words, at = np.unique(token, return_inverse=True)
            count = _counts_of(word_table, block, words, buckets)[at]
            begin = np.concatenate(([0], stop[:-1] + 1))
            yield row("docs", int(block % buckets), block, len(ids), squeeze(ids), squeeze(learn.astype(np.int8)), squeeze(stop + 1 - begin),
                      squeeze(np.add.reduceat((count > 0).astype(np.int64), begin)), squeeze(np.add.reduceat(model.base(count), begin)))
            context, word = _pairs(token, doc, stop), token >> np.uint64(24)
            for b, place in _dealt(context, word, hot, buckets):
                c, w = context[place], word[place]
                first = _starts(c, w)
                yield row("pairs", b, block, len(ids), squeeze_sorted(c[first]), squeeze(w[first]), squeeze(np.diff(np.concatenate((first, [len(c)]))).astype(np.int32)),
                          squeeze(count[place][first]), squeeze(doc[place].astype(np.uint32)))

    def load(b: int):
        rows = _folder_rows(f"{pair_table}/kind=table/bucket={b}")
        if not rows:
            return None
        c, w, n, low = expand_sorted(rows[0]["a"]), expand(rows[0]["b"], np.uint64), expand(rows[0]["c"], np.int32).astype(np.int64), expand(rows[0]["d"], np.float64)
        head = _starts(c)
        context = c[head]
        group = np.repeat(np.arange(len(head)), np.diff(np.concatenate((head, [len(c)]))))
        total = np.add.reduceat(n, head).astype(float)
        lost = np.add.reduceat(np.where(n <= K, n * (1 - d2[np.minimum(n, K)]), 0.0), head)
        kept = lost > 0
        total += ~kept
        weight = np.where(kept, lost, 1) / total / np.maximum(1 - low, 1e-300)
        for k in np.flatnonzero(np.isin(context, hot)):
            weight[k], total[k] = hot_weight[int(context[k])]
        log_seen = np.log10(np.where(n <= K, d2[np.minimum(n, K)], 1.0) * n / total[group])
        return context, np.log10(weight), group.astype(np.uint64) << np.uint64(40) | w, log_seen

    hot_log = {h: np.log10(x[0]) for h, x in hot_weight.items()}

    def evaluate(batches):
        for b, rows in _by_bucket(batches):
            table = load(b)
            for r in rows:
                if r["kind"] == "docs":
                    yield row("docs", b, r["block"], r["n"], r["a"], r["b"], r["c"], r["d"], r["e"])
                    continue
                c, w, m, cw, doc = expand_sorted(r["a"]), expand(r["b"], np.uint64), expand(r["c"], np.int32), expand(r["d"], np.int64), expand(r["e"], np.uint32)
                log = np.log10(model.probability(cw))
                back = np.zeros(len(c))
                is_hot = np.isin(c, hot)
                if is_hot.any():
                    back[is_hot] = [hot_log.get(int(x), 0.0) for x in c[is_hot]]
                if table is not None:
                    context, log_weight, pairs, log_seen = table
                    at = np.minimum(np.searchsorted(context, c), len(context) - 1)
                    known = context[at] == c
                    back = np.where(known, log_weight[at], back)
                    key = at.astype(np.uint64) << np.uint64(40) | w
                    place = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
                    log = np.where(known & (pairs[place] == key), log_seen[place], log + back)
                else:
                    log = log + back
                yield row("sums", b, r["block"], r["n"], squeeze(np.bincount(doc, weights=np.repeat(log, m), minlength=r["n"])))

    def finish(batches):
        block, held = None, []

        def done():
            facts = next(r for r in held if r["kind"] == "docs")
            score = np.zeros(facts["n"])
            for r in sorted((r for r in held if r["kind"] == "sums"), key=lambda r: (r["bucket"], r["a"])):
                score += expand(r["a"], np.float64)
            ids = expand(facts["a"], np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(expand(facts["b"], np.int8) > 0), pa.array(expand(facts["c"], np.int64)), pa.array(expand(facts["d"], np.int64)), pa.array(np.full(len(ids), tokens)),
                                               pa.array(expand(facts["e"], np.float64)), pa.array(score)], ["id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        for batch in batches:
            for r in batch.to_pylist():
                if block is not None and r["block"] != block:
                    yield done()
                    held = []
                block = r["block"]
                held.append(r)
        if held:
            yield done()

    out = (own.mapInArrow(send_all, _ROW).repartition(buckets, "bucket").sortWithinPartitions("bucket", "block").mapInArrow(evaluate, _ROW)
           .repartition(buckets, "block").sortWithinPartitions("block").mapInArrow(finish, "id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
    missing = F.col("id") == F.lit(np.iinfo(np.int64).min).cast("long")
    return out.select(F.when(~missing, F.col("id")).alias(id_col), "train", "n_tokens", "n_known", "train_tokens", "base_score", "score")
