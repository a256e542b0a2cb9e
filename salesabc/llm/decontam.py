"""Benchmark decontamination by greedy string tiling.

Texts are compared as lower-case words without punctuation.  Running hashes of
``min_match`` words (Karp-Rabin) of the benchmark items are the seeds; a
document and an item that share a seed are tiled: the longest match of words
not yet marked in either is marked, again and again, until no match of
``min_match`` words is left.  The share of an item's words under tiles is its
coverage, whatever the order of the tiles in the document, so reordered
passages count.

The longest match is found by bisection on its length: running hashes of one
length over the unmarked words of both sides tell whether a match that long is
left.  Nothing is listed by pairs of places, so memory is a few numbers per word
of the document and of the item, and the time of a round is proportional to
their words, however repetitive they are; an item takes at most its words
divided by ``min_match`` rounds.

The benchmark is a stated query set against all documents.  It is read in
blocks of at most ``block_words`` words, and only one block's seeds are held
by a task; documents are never shuffled.

Defined cases: a null or wordless text matches nothing; an item with fewer
words than ``min_match`` has to occur whole; a null id is kept; repeated rows
are judged alike; empty tables give an empty result; extra columns are ignored;
very long and repetitive texts are tiled whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_words, mix64, text_array

MIN_MATCH = 5
COVERAGE = 0.8
BLOCK_WORDS = 2_000_000
_BASE = 0x9E3779B97F4A7C15
_SIEVE_BITS = 20


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, flat, and the offsets of each text."""
    clean = pc.replace_substring_regex(texts, r"[^\p{L}\p{N}]+", " ")
    split = pc.ascii_split_whitespace(pc.utf8_lower(clean))
    offsets = split.offsets.to_numpy().astype(np.int64)
    flat, offsets = split.flatten(), offsets - offsets[0]
    keep = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    before = np.concatenate(([0], np.cumsum(keep)))
    return hash_words(flat.filter(pa.array(keep))), before[offsets]


def running_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """The Karp-Rabin hash of every run of k words (modulo 2^64)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * np.uint64(_BASE) + words[j:j + n]
    return mix64(h)


class _Runs:
    """Running hashes of any length over some words, each word usable until it is marked."""

    def __init__(self, words: np.ndarray):
        self.words, self.free = words, np.ones(len(words), bool)
        with np.errstate(over="ignore"):
            self.power = np.concatenate(([np.uint64(1)], np.cumprod(np.full(len(words), _BASE, np.uint64))))
            back = np.concatenate(([np.uint64(1)], np.cumprod(np.full(max(len(words) - 1, 0), pow(_BASE, -1, 1 << 64), np.uint64))))[: len(words)]
            self.sums = np.concatenate(([np.uint64(0)], np.cumsum(words * back, dtype=np.uint64)))
        self.used = np.zeros(len(words) + 1, np.int64)

    def mark(self, at: int, n: int) -> None:
        self.free[at:at + n] = False
        self.used = np.concatenate(([0], np.cumsum(~self.free)))

    def longest(self) -> int:
        edge = np.flatnonzero(np.concatenate(([True], ~self.free, [True])))
        return int(np.diff(edge).max()) - 1 if len(edge) > 1 else 0

    def hashes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of the runs of n unmarked words."""
        at = np.flatnonzero(self.used[n:] == self.used[: len(self.used) - n]) if n < len(self.used) else np.zeros(0, np.int64)
        return at, mix64((self.sums[at + n] - self.sums[at]) * self.power[at])


def tile(doc: np.ndarray, item: np.ndarray, seeds: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in the document, place in the item, words), given the places of seeds of k words.

    Every round takes the longest match of unmarked words (of equally long
    ones the first in the document, then in the item) and marks it.
    """
    inside = np.zeros(len(doc) + 1, np.int64)
    np.add.at(inside, seeds, 1)
    np.add.at(inside, seeds + k, -1)
    at = np.flatnonzero(np.cumsum(inside)[:-1] > 0)  # a match is made of seeds: other words of the document don't count
    gap = np.flatnonzero(np.diff(at) > 1) + 1
    at = np.insert(at, gap, -1)
    left, right = _Runs(np.where(at >= 0, doc[at], np.uint64(0))), _Runs(item)
    left.free[at < 0] = False
    left.mark(0, 0)

    def first(n: int) -> tuple[int, int] | None:
        a, ha = left.hashes(n)
        b, hb = right.hashes(n)
        order = np.argsort(hb, kind="stable")
        hb = hb[order]
        if not len(hb):
            return None
        low = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
        for j in np.flatnonzero(hb[low] == ha):
            x, y = int(a[j]), int(b[order[low[j]]])
            if (left.words[x:x + n] == right.words[y:y + n]).all():
                return x, y
        return None

    tiles, most = [], min(left.longest(), right.longest())
    while most >= k:
        good, best, bad = None, 0, most + 1
        n = most  # the last length first: equally long matches follow each other
        while best + 1 < bad or good is None and n >= k:
            found = first(n)
            if found:
                good, best = found, n
            else:
                bad = n
            if best + 1 >= bad or bad <= k:
                break
            n = max(k, (max(best, k - 1) + bad) // 2)
        if good is None:
            break
        tiles.append((int(at[good[0]]), good[1], best))
        left.mark(good[0], best)
        right.mark(good[1], best)
        most = min(best, left.longest(), right.longest())
    return tiles


class _Block:
    """The seeds of some items, by length of the seed."""

    def __init__(self, items: list, texts: list[str], min_match: int):
        words, offsets = plain_words(pa.array(texts, pa.large_string()))
        own = [words[offsets[i]:offsets[i + 1]] for i in range(len(items))]
        self.items, self.words, self.seeds = items, own, {}
        for k in sorted({min(min_match, len(w)) for w in own if len(w)}):
            which = [i for i, w in enumerate(own) if len(w) and min(min_match, len(w)) == k]
            hashes = [running_hashes(own[i], k) for i in which]
            h = np.concatenate(hashes)
            who = np.repeat(which, [len(x) for x in hashes])
            order = np.lexsort((who, h))
            once = np.ones(len(order), bool)  # a seed that an item repeats counts once
            once[1:] = (h[order][1:] != h[order][:-1]) | (who[order][1:] != who[order][:-1])
            order = order[once]
            sieve = np.zeros(1 << _SIEVE_BITS, bool)
            sieve[(h >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)] = True
            self.seeds[k] = h[order], who[order], sieve

    def matches(self, words: np.ndarray, offsets: np.ndarray):
        """(text, item, tiles) of the texts that share a seed with an item."""
        ends = offsets[1:]
        for k, (h, who, sieve) in self.seeds.items():
            own = running_hashes(words, k)
            place = np.flatnonzero(sieve[(own >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)])
            text = np.searchsorted(ends, place, side="right")
            inside = place + k <= ends[text]
            place, text = place[inside], text[inside]
            lo, hi = np.searchsorted(h, own[place], side="left"), np.searchsorted(h, own[place], side="right")
            found = np.flatnonzero(hi > lo)
            for part in np.split(found, np.flatnonzero(np.diff(text[found])) + 1) if len(found) else ():
                t = int(text[part[0]])
                seeds: dict[int, list] = {}  # of one text: places by item
                for j in part:
                    for i in who[lo[j]:hi[j]].tolist():
                        seeds.setdefault(i, []).append(int(place[j]) - int(offsets[t]))
                for i, at in sorted(seeds.items()):
                    yield t, i, tile(words[offsets[t]:offsets[t + 1]], self.words[i], np.array(at), k)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Documents that hold at least ``coverage`` of an item's words in tiles.

    Rows: document id, the ``carry`` columns, item id, item_words, matched_words, coverage, and tiles
    (place in the document, place in the item, words; counted in words).
    """
    tests = benchmark.select(F.col(item_col).cast("long").alias("item"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text"))
    total = tests.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0  # at most so many words
    blocks = int(total // block_words) + 1
    out = None
    names = [id_col, *carry]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    schema = f"{kinds}, item_id long, item_words long, matched_words long, coverage double, tiles array<struct<doc_word:long,item_word:long,words:long>>"
    own = docs.select(*names, F.col(text_col).cast("string").alias("_text"))
    for b in range(blocks):
        rows = tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).orderBy("item", "text").collect()  # one bounded block
        if not rows and out is not None:
            continue

        def run(batches, items=[r["item"] for r in rows], texts=[r["text"] for r in rows]):
            block = _Block(items, texts, min_match)
            for batch in batches:
                column = text_array(batch.column(len(names)))
                for lo in range(0, len(column), 2000):
                    words, offsets = plain_words(text_array(column.slice(lo, 2000)))
                    found = []
                    for t, i, tiles in block.matches(words, offsets):
                        n = sum(x[2] for x in tiles)
                        if n and n >= coverage * len(block.words[i]):
                            found.append((lo + t, block.items[i], len(block.words[i]), n, n / len(block.words[i]), [dict(zip(("doc_word", "item_word", "words"), x)) for x in sorted(tiles)]))
                    if found:
                        row, item, size, n, share, tiles = zip(*found)
                        spans = pa.list_(pa.struct([("doc_word", pa.int64()), ("item_word", pa.int64()), ("words", pa.int64())]))
                        yield pa.RecordBatch.from_arrays([*(batch.column(j).take(pa.array(row)) for j in range(len(names))), pa.array(item, pa.int64()), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array(share), pa.array(tiles, spans)],
                                                         [*names, "item_id", "item_words", "matched_words", "coverage", "tiles"])

        part = own.mapInArrow(run, schema)
        out = part if out is None else out.unionAll(part)
    return out
