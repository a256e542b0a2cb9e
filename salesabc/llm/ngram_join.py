"""N-gram Jaccard join: documents whose sets of word n-grams have a similarity of at least 4/5.

Sets are those of 64-bit n-gram hashes (words are hashed one by one, and the
five hashes together); equal sets are one class, known by a 64-bit digest.

Rare first: n-grams are ordered by an upper bound of their frequency, the lesser
of the counts of their cell among ``CELLS`` n-gram cells and of the rarest of
their words among ``WORD_CELLS`` word cells, both counted over all documents,
and then by their hash.  Any fixed order gives the same links.  A class is
posted under its first |x| - ceil(4|x|/5) + 1 n-grams; two classes meet under a
shared one if their lengths allow the similarity and if enough n-grams follow
(positional filter).  Pairs then pass the suffix filter (the n-grams of both are
counted by 64 ranges of their hashes; the differences add up to at most the
difference of the sets), the parity filter (of 2,048 bits, each turned by the
n-grams that fall on it, at most as many differ as n-grams do) and are verified
by their whole sets, once per pair.

Links matter here for what they connect.  Groups of near copies would give all
their pairs, so in the first rounds each class is compared with a few others
only that pass the filters in its lists (in each round with more, as fewer
classes are left outside of the large components); pairs that are connected
then need no check, and all others that meet are verified.  Lists of frequent n-grams are
dealt over slices, then over a grid of slices.

Defined cases: null or wordless text has no n-grams and links with nothing (its
component is its own id); fewer words than ``n`` are one n-gram, the whole
sequence; repeated rows share a class; a null id keeps its row, but names no
component unless no other id is there; extra columns are ignored; an empty
table gives an empty result.  Texts may be of any length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_words, mix64, text_array, words_of, written
from .graph import connected_components
from .sums import SCHEMA, packed, summed

N = 5
CELLS, WORD_CELLS = 1 << 22, 1 << 20
_CHUNK = 1 << 16
#: Rows of an n-gram's list that meet in one task's matrix; longer lists are dealt.
CELL = 4096
#: One class in so many is looked at to find lists that are longer.
LOOK = 32
#: Classes that a class is compared with in each of the first rounds.
PARTNERS = (3, 8, 24, 64)
#: Lists up to so many classes are searched whole for a partner.
SHORT = 16
_MATRIX = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_TEXT_BYTES = 1 << 20
_BLOOM_BITS = 1 << 26
#: Bits of a set's parities: how many of its n-grams fall on each, odd or even.
PARITIES = 2048


def _slices(batch, column: int):
    """Parts of a batch with about _TEXT_BYTES of text: (first row, texts)."""
    texts = text_array(batch.column(column))
    ends = np.cumsum(np.diff(np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1])) if len(texts) else np.zeros(0, np.int64)
    at = 0
    while at < len(texts):
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _TEXT_BYTES, "right"))
        stop = max(stop, at + 1)
        yield at, texts.slice(at, stop - at).take(pa.array(np.arange(stop - at)))
        at = stop


def grams(texts: pa.Array, n: int, word_cost: np.ndarray | None = None):
    """(hashes of the words, of all n-grams, text of each n-gram, least cost among each n-gram's words), n-grams unordered."""
    flat, offsets = words_of(texts)
    words, size = hash_words(flat), np.diff(offsets)
    cost = np.zeros(len(words), np.uint16) if word_cost is None else word_cost[_word_cell(words)]
    tokens, owner, least = [], [], []
    for m in range(1, n + 1):
        if m < n:
            who = np.flatnonzero(size == m)
            at, own = offsets[who], who
        else:
            of = np.repeat(np.arange(len(size)), size)
            at = np.flatnonzero(of[: len(of) - n + 1] == of[n - 1:]) if len(of) >= n else np.zeros(0, np.int64)
            own = of[at]
        if len(at):
            h, c = np.full(len(at), m, np.uint64), np.full(len(at), np.iinfo(np.uint16).max, np.uint16)
            for j in range(m):
                h = h * np.uint64(_BASE) + words[at + j]
                c = np.minimum(c, cost[at + j])
            tokens.append(mix64(h)), owner.append(own), least.append(c)
    if not tokens:
        return words, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint16)
    return words, np.concatenate(tokens), np.concatenate(owner), np.concatenate(least)


def _word_cell(words):
    return (words >> np.uint64(40)).astype(np.int64) % WORD_CELLS


def frequency_bounds(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all n-grams and words by cell, on a scale of 16 steps a doubling (2 bytes a cell, whatever the input)."""

    def count(batches):
        total, some = np.zeros(CELLS + WORD_CELLS, np.uint32), False
        for batch in batches:
            for _, texts in _slices(batch, 0):
                words, tokens, _, _ = grams(texts, n)
                np.add.at(total, (tokens >> np.uint64(20)).astype(np.int64) % CELLS, np.uint32(1))
                np.add.at(total, CELLS + _word_cell(words), np.uint32(1))
                some = True
        if some:
            for k in range(0, len(total), _CHUNK):
                yield packed(k // _CHUNK, total[k:k + _CHUNK].astype(np.int64))

    got = summed(docs.select("text").mapInArrow(count, SCHEMA), "<i8")
    total = np.concatenate([got[k] for k in range((CELLS + WORD_CELLS) // _CHUNK)]) if got else np.zeros(CELLS + WORD_CELLS, np.int64)
    steps = np.round(16 * np.log2(1.0 + total)).astype(np.uint16)
    return steps[:CELLS], steps[CELLS:]


def _sorted_sets(tokens, owner, rank, count):
    """N-grams of each text once, in (rank, hash) order: (tokens, owner, sizes, starts)."""
    order = np.lexsort((tokens, owner)) if rank is None else np.lexsort((tokens, rank, owner))
    tokens, owner = tokens[order], owner[order]
    keep = np.ones(len(tokens), bool)
    keep[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    tokens, owner = tokens[keep], owner[keep]
    sizes = np.bincount(owner, minlength=count)
    return tokens, owner, sizes, np.concatenate(([0], np.cumsum(sizes)))


def _digests(tokens, sizes, starts) -> np.ndarray:
    """A digest of each set, whatever its order."""
    total = np.concatenate(([np.uint64(0)], np.cumsum(mix64(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)))
    return mix64((total[starts[1:]] - total[starts[:-1]]) ^ (sizes.astype(np.uint64) * np.uint64(_BASE))).view(np.int64)


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(values))


def posted(docs: DataFrame, id_col: str, n: int) -> DataFrame:
    """id, size, class (null: no n-grams), and for each task's first of a class: counts by range and the prefix."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col("text").cast("string").alias("text"))
    gram_cost, word_cost = frequency_bounds(rows, n)
    held = docs.sparkSession.sparkContext.broadcast((gram_cost, word_cost))  # 2 bytes for each of a fixed number of cells

    def run(batches):
        gram_cost, word_cost = held.value
        seen = set()
        for batch in batches:
            for at, texts in _slices(batch, 1):
                m = len(texts)
                _, tokens, owner, least = grams(texts, n, word_cost)
                rank = np.minimum(least, gram_cost[(tokens >> np.uint64(20)).astype(np.int64) % CELLS])
                tokens, owner, sizes, starts = _sorted_sets(tokens, owner, rank, m)
                keys = _digests(tokens, sizes, starts)
                first = np.zeros(m, bool)
                for i in np.flatnonzero(sizes):
                    key = int(keys[i])
                    if key not in seen:
                        seen.add(key)
                        first[i] = True
                length = np.where(first, sizes - (4 * sizes + 4) // 5 + 1, 0)
                place = np.arange(len(tokens)) - starts[owner]
                prefix = tokens[place < length[owner]].view(np.int64)
                ranges = np.minimum(np.bincount(owner * 64 + (tokens >> np.uint64(58)).astype(np.int64), minlength=64 * m), 255).astype(np.uint8).reshape(m, 64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, m), pa.array(sizes, pa.int64()), pa.array(keys, mask=sizes == 0),
                    pa.array([r.tobytes() if f else None for r, f in zip(ranges, first)], pa.binary()), _lists(prefix, np.concatenate(([0], np.cumsum(length))))],
                    ["id", "size", "class", "ranges", "prefix"])

    return rows.mapInArrow(run, f"id {kind}, size long, class long, ranges binary, prefix array<long>")


def _groups(batches, solve):
    """Batches cut where (first, second) column changes; ``solve`` gets whole groups as numpy columns."""
    held = None
    for batch in batches:
        cols = [batch.column(i).to_numpy() for i in range(batch.num_columns)]
        if not len(cols[0]):
            continue
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
        cut = last[-1] + 1 if len(last) else 0
        if cut:
            yield from solve([c[:cut] for c in cols])
        held = [c[cut:] for c in cols]
    if held is not None:
        yield from solve(held)


def _edges(a, b):
    new = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
    start = np.concatenate(([0], new))
    return start, np.diff(np.concatenate((start, [len(a)])))


def _may_link(s1, p1, s2, p2):
    """Length and positional filters for two classes under a shared n-gram; s1 <= s2."""
    return (5 * s1 >= 4 * s2) & (9 * np.minimum(s1 - p1, s2 - p2) >= 4 * (s1 + s2))


def _first_partners(turn: int):
    """Rows of lists with several components; of short lists, those that pass the filters with another row.  A row gets
    some classes of other components that it passes them with, others by turn and by list; in a list, the row of the
    component with fewer rows asks, so a large component is asked by what is outside of it and doesn't ask itself."""

    def solve(cols):
        token, slot, size, key, pos, dealt, comp = cols
        start, length = _edges(token, slot)
        keep = np.zeros(len(token), bool)
        asking, asked = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        mixed = mix64(token.view(np.uint64) + np.uint64(turn))
        for a, n, d in zip(start.tolist(), length.tolist(), dealt[start].tolist()):
            if n < 2 and not d:
                continue
            at = np.arange(a, a + n)
            if n > 2:
                at = at[np.concatenate(([True], key[at][1:] != key[at][:-1]))]  # copies from several tasks follow each other
            if not d and (comp[at] == comp[at[0]]).all():
                continue
            n, pick = len(at), int(mixed[a] >> np.uint64(1))
            if n <= SHORT and not d:
                rows = list(zip(at.tolist(), size[at].tolist(), pos[at].tolist(), comp[at].tolist()))
                for j, (rj, sj, pj, cj) in enumerate(rows):
                    for ri, si, pi, ci in rows[:j]:
                        if 5 * si >= 4 * sj and 9 * min(si - pi, sj - pj) >= 4 * (si + sj):
                            keep[ri] = keep[rj] = True
                            if ci != cj:
                                asking.append([ri]), asked.append([rj])
                continue
            keep[at] = True
            s, p, c = size[at], pos[at], comp[at]
            _, of, many = np.unique(c, return_inverse=True, return_counts=True)
            weight = many[of]
            # Outside of the largest component, some rows of each component look through the whole list.
            stir = np.argsort(mix64(key[at].view(np.uint64) + np.uint64(turn)), kind="stable")
            stir = stir[np.argsort(of[stir], kind="stable")]
            rank = np.empty(n, np.int64)
            rank[stir] = np.arange(n) - np.concatenate(([0], np.cumsum(many)[:-1]))[of[stir]]
            few = np.flatnonzero((of != np.argmax(many)) & (rank < SHORT))
            if len(few) * n <= _MATRIX and many.max() > 1:
                first, second = np.minimum(few[:, None], np.arange(n)[None, :]), np.maximum(few[:, None], np.arange(n)[None, :])
                ok = _may_link(s[first], p[first], s[second], p[second]) & (c[few][:, None] != c[None, :])
                for r, row in zip(few.tolist(), ok):
                    others = np.flatnonzero(row)
                    if len(others):
                        chosen = others[(pick % len(others) + np.arange(min(8, len(others))) * max(1, len(others) // 8)) % len(others)]
                        asking.append(np.full(len(chosen), at[r])), asked.append(at[chosen])
                continue
            for t in range(8):
                shift = 1 + (pick >> 7 * t) % min(n - 1, 64) if n > 1 else 0
                if not shift:
                    break
                lo, hi = np.arange(n - shift), np.arange(shift, n)
                ok = _may_link(s[lo], p[lo], s[hi], p[hi]) & (c[lo] != c[hi])
                lo, hi = lo[ok], hi[ok]
                small = weight[lo] <= weight[hi]
                asking.append(at[np.where(small, lo, hi)]), asked.append(at[np.where(small, hi, lo)])
        if keep.any():
            place = np.cumsum(keep) - 1
            who, whom = (np.concatenate(x).astype(np.int64) for x in (asking, asked))
            order = np.argsort(who, kind="stable")
            at = np.flatnonzero(keep)
            ends = np.concatenate(([0], np.cumsum(np.bincount(place[who], minlength=len(at)))))
            yield pa.RecordBatch.from_arrays([*(pa.array(c[at]) for c in (token, size, key, pos, dealt)), _lists(key[whom[order]], ends)],
                                             ["token", "size", "class", "pos", "dealt", "partners"])

    return lambda batches: _groups(batches, solve)


def _all_partners(batches):
    """All pairs of different components that meet in a cell and pass the length and positional filters."""

    def solve(cols):
        token, cell, size, key, pos, comp, slot, dealt = cols
        start, length = _edges(token, cell)
        for a, n in zip(start.tolist(), length.tolist()):
            if n < 2:
                continue
            s, k, p, c, g = (x[a:a + n] for x in (size, key, pos, comp, slot))
            if (c == c[0]).all():
                continue
            grid = int(dealt[a])
            square = not grid or cell[a] // grid == cell[a] % grid
            step = max(1, _MATRIX // n)
            for lo in range(0, n, step):
                hi = min(n, lo + step)
                x, y = slice(lo, hi), slice(lo, n)
                ok = _may_link(s[x][:, None], p[x][:, None], s[y][None, :], p[y][None, :]) & (c[x][:, None] != c[y][None, :])
                if not square:
                    ok &= g[x][:, None] != g[y][None, :]
                i, j = np.nonzero(ok)
                below = i < j
                if below.any():
                    ki, kj = k[x][i[below]], k[y][j[below]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ki, kj)), pa.array(np.maximum(ki, kj))], ["a", "b"])

    yield from _groups(batches, solve)


def _near_ranges(batches):
    """Pairs that pass the suffix filter."""
    for batch in batches:
        sa, sb = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        ra, rb = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, 64).astype(np.int16) for i in (4, 5))
        apart = np.abs(ra - rb).sum(axis=1)
        shared = -(-4 * (sa + sb) // 9)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(apart <= sa + sb - 2 * shared))


def _parities(tokens, owner, count) -> np.ndarray:
    """For each set, whether an odd number of its n-grams falls on each of PARITIES bits, packed."""
    places = owner * PARITIES + (tokens >> np.uint64(32)).astype(np.int64) % PARITIES
    return np.packbits(np.bincount(places, minlength=count * PARITIES).reshape(count, PARITIES) & 1, axis=1)


def _near_parities(batches):
    """Pairs whose parities differ on no more bits than their sets may differ by n-grams: each of those turns one bit."""
    for batch in batches:
        total = batch.column(2).to_numpy() + batch.column(3).to_numpy()
        x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, PARITIES >> 3) for i in (4, 5))
        apart = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(apart <= total - 2 * -(-4 * total // 9)))


def _same_enough(batches):
    """Pairs whose sets are similar enough; the two sets of a pair follow each other, copies of a set too."""
    before, a_out, b_out = None, [], []
    for batch in batches:
        a, b, own = (batch.column(i).to_numpy() for i in range(3))
        grams = batch.column(3)
        for i in range(batch.num_rows):
            now = (a[i], b[i], own[i])
            if before is not None and now[:2] == before[0][:2] and now[2] != before[0][2]:
                x, y = before[1], np.frombuffer(grams[i].as_py(), "<u8")
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                if 9 * int((both[1:] == both[:-1]).sum()) >= 4 * (len(x) + len(y)):
                    a_out.append(now[0]), b_out.append(now[1])
                before = None
            elif before is None or now != before[0]:
                before = now, np.frombuffer(grams[i].as_py(), "<u8")
        if a_out:
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])
            a_out, b_out = [], []


def _bloom_places(row):
    return [(mix64(row.view(np.uint64) + np.uint64(s)) % np.uint64(_BLOOM_BITS)).astype(np.int64) for s in (1, 2, 3)]


def _bloom(rows: DataFrame):
    """Broadcast Bloom filter of fixed size, _BLOOM_BITS / 8 bytes, over a column of longs."""

    def mark(batches):
        bits, some = np.zeros(_BLOOM_BITS >> 3, np.uint8), False
        for batch in batches:
            for at in _bloom_places(batch.column(0).to_numpy()):
                np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
                some = True
        if some:
            for k in range(0, len(bits), 1 << 18):
                yield packed(k >> 18, bits[k:k + (1 << 18)])

    got = summed(rows.mapInArrow(mark, SCHEMA), "u1", np.bitwise_or)
    bloom = np.concatenate([got[k] for k in range(_BLOOM_BITS >> 21)]) if got else np.zeros(_BLOOM_BITS >> 3, np.uint8)
    return rows.sparkSession.sparkContext.broadcast(bloom)


def _marked(batch, bloom) -> np.ndarray:
    """Rows whose first column the filter lets pass."""
    take = np.ones(batch.num_rows, bool)
    for spot in _bloom_places(batch.column(0).to_numpy()):
        take &= (bloom[spot >> 3] >> (spot & 7).astype(np.uint8) & 1).astype(bool)
    return take


def _whole_sets(docs: DataFrame, id_col: str, ids: DataFrame, n: int) -> DataFrame:
    """(class, parities, set) of the texts under the given ids; a Bloom filter spares all other texts the way.

    It lets some more texts pass, and other texts under the same id; their
    classes find no request.
    """
    held = _bloom(ids.select(F.xxhash64("id").alias("row")))

    def run(batches):
        bloom, seen = held.value, set()
        for batch in batches:
            take = _marked(batch, bloom)
            if not take.any():
                continue
            for _, texts in _slices(batch.filter(pa.array(take)), 1):
                _, tokens, owner, _ = grams(texts, n)
                tokens, owner, sizes, starts = _sorted_sets(tokens, owner, None, len(texts))
                keys = _digests(tokens, sizes, starts)
                out = []
                for i in np.flatnonzero(sizes):
                    if int(keys[i]) not in seen:
                        seen.add(int(keys[i]))
                        out.append(i)
                for lo in range(0, len(out), 256):
                    some = out[lo:lo + 256]
                    own = [tokens[starts[i]:starts[i + 1]] for i in some]
                    parities = _parities(np.concatenate(own), np.repeat(np.arange(len(own)), sizes[some]), len(own))
                    yield pa.RecordBatch.from_arrays([pa.array(keys[some], pa.int64()), pa.array([x.tobytes() for x in parities], pa.binary()),
                                                      pa.array([x.astype("<u8").tobytes() for x in own], pa.binary())], ["class", "parities", "grams"])

    return docs.select(F.xxhash64(id_col), F.col("text").cast("string")).mapInArrow(run, "class long, parities binary, grams binary")


def _asked_sets(sets: DataFrame, asked: DataFrame) -> DataFrame:
    """(class, set) of the asked classes and, as a Bloom filter tells them, of few others: only these go into the join."""
    held = _bloom(asked.select("class"))

    def run(batches):
        bloom = held.value
        for batch in batches:
            yield batch.filter(pa.array(_marked(batch, bloom)))

    return sets.select("class", "grams").mapInArrow(run, "class long, grams binary")


def _both(pairs: DataFrame, table: DataFrame, *names: str) -> DataFrame:
    """a, b, and the named columns of both classes: name_a, name_b."""
    for side in ("a", "b"):
        pairs = pairs.join(table.select(F.col("class").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in names)), side)
    return pairs.select("a", "b", *(f"{c}_{side}" for c in names for side in ("a", "b")))


def similar_components(docs: DataFrame, classes: DataFrame, id_col: str, n: int = N) -> DataFrame | None:
    """(node, component) of the classes joined by chains of similar pairs; ``classes`` as from ``posted``, written."""
    one = classes.where("ranges is not null")
    lists = one.select("size", "class", F.posexplode("prefix").alias("pos", "token")).select("token", "size", "class", F.col("pos").cast("long").alias("pos"))
    long = written(lists.where(F.pmod(F.xxhash64("class"), F.lit(LOOK)) == 0).groupBy("token").count().where(F.col("count") * LOOK > 2 * CELL)
                   .select("token", F.ceil(F.col("count") * LOOK / CELL).cast("long").alias("dealt")), "long-lists")
    zero = F.lit(0).cast("long")
    slot = F.when(F.col("dealt") > 0, F.pmod(F.xxhash64("class"), F.col("dealt"))).otherwise(zero)

    def partners(rows, turn):
        order = ["token", "slot", "size", "class"]
        # In a later turn, a long list is sliced anew, so that its slices get mixed.
        own = F.when(F.col("dealt") > 0, F.pmod(F.xxhash64("class", F.lit(turn)), F.col("dealt"))).otherwise(zero)
        return (rows.withColumn("slot", own).select("token", "slot", "size", "class", "pos", "dealt", "comp").repartition("token", "slot").sortWithinPartitions(*order)
                .mapInArrow(_first_partners(turn), "token long, size long, class long, pos long, dealt long, partners array<long>"))

    lists = lists.join(long, "token", "left").withColumn("dealt", F.coalesce("dealt", zero))
    met = written(partners(lists.withColumn("comp", F.col("class")), 0), "meeting")
    needed = written(met.select("class").distinct(), "needed")
    if needed.isEmpty():
        return None
    ranges = written(one.join(needed, "class", "left_semi").groupBy("class").agg(F.first("size").alias("size"), F.first("ranges").alias("ranges"), F.min("id").alias("id")), "ranges")
    sets = written(_whole_sets(docs, id_col, ranges, n), "sets")

    # A class may come from several tasks; its parities are the same in all.
    signs = written(ranges.select("class", "size").join(sets.select("class", "parities"), "class").groupBy("class").agg(F.first("size").alias("size"), F.first("parities").alias("parities")), "signs")

    def verified(pairs):
        near = written(_both(pairs, ranges, "size", "ranges").mapInArrow(_near_ranges, "a long, b long"), "near")
        near = written(_both(near, signs, "size", "parities").mapInArrow(_near_parities, "a long, b long"), "nearer")
        asked = near.select(F.explode(F.array("a", "b")).alias("class"), "a", "b")
        both = asked.join(_asked_sets(sets, asked), "class").select("a", "b", "class", "grams").repartition("a", "b").sortWithinPartitions("a", "b", "class")
        return written(both.mapInArrow(_same_enough, "a long, b long"), "links")

    tried, links, comps = None, None, None
    for turn, most in enumerate(PARTNERS, 1):
        counted = met.select("class", F.explode("partners").alias("partner")).groupBy("class", "partner").count()
        best = F.slice(F.sort_array(F.collect_list(F.struct(-F.col("count"), F.xxhash64("class", "partner", F.lit(turn)), F.col("partner")))), 1, most)
        pairs = (counted.groupBy("class").agg(best.alias("best")).select("class", F.explode("best.partner").alias("partner"))
                 .select(F.least("class", "partner").alias("a"), F.greatest("class", "partner").alias("b")).distinct())
        pairs = written(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = pairs if tried is None else tried.unionAll(pairs)
        found = verified(pairs)
        if found.isEmpty():
            break
        links = found if links is None else links.unionAll(found)
        if turn < len(PARTNERS):
            comps = written(_merged(found, comps), "components")
        else:  # whole, as all pairs that are left between components will be verified
            comps = written(connected_components(_with_known(links, comps)), "components")
        named = met.drop("partners").join(comps, F.col("class") == F.col("node"), "left").withColumn("comp", F.coalesce("component", "class")).drop("node", "component")
        met = written(partners(named, turn), "meeting")
    named = met.drop("partners")
    named = named.withColumn("comp", F.col("class")) if comps is None else (
        named.join(comps, F.col("class") == F.col("node"), "left").withColumn("comp", F.coalesce("component", "class")).drop("node", "component"))
    # In the grid, a class of slot s goes to the cells (s, t) and (t, s), kept once: every two slots meet in one cell.
    side = F.col("slot")
    cells = F.when(F.col("dealt") > 0, F.transform(F.sequence(zero, F.greatest(F.col("dealt") - 1, zero)), lambda t: F.least(side, t) * F.col("dealt") + F.greatest(side, t))).otherwise(F.array(zero))
    dealt = named.withColumn("slot", slot).select("token", F.explode(cells).alias("cell"), "size", "class", "pos", "comp", "slot", "dealt")
    rest = (dealt.repartition("token", "cell").sortWithinPartitions("token", "cell", "size", "class").mapInArrow(_all_partners, "a long, b long").distinct())
    found = verified(written(rest if tried is None else rest.join(tried, ["a", "b"], "left_anti"), "pairs"))
    return written(connected_components(_with_known(found if links is None else links.unionAll(found), comps)), "components")


def _with_known(links: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Links, and those from the nodes of the components known before to their names."""
    new = links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    return new if comps is None else new.unionAll(comps.select(F.col("node").alias("src"), F.col("component").alias("dst")))


def _merged(links: DataFrame, comps: DataFrame | None) -> DataFrame:
    """(node, component) after new links, by one step to the least neighbour and two jumps from there.

    Nodes of one component are connected; connected nodes may still be in
    several, which costs later rounds some checks and loses nothing.
    """
    pairs = links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    known = comps
    for side in ("src", "dst"):
        if known is not None:
            named = known.select(F.col("node").alias(side), F.col("component").alias("_of"))
            pairs = pairs.join(named, side, "left").withColumn(side, F.coalesce("_of", side)).drop("_of")
    both = pairs.unionAll(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    low = written(both.groupBy("src").agg(F.least("src", F.min("dst")).alias("low")), "neighbours")
    for _ in range(2):
        low = low.join(low.select(F.col("src").alias("low"), F.col("low").alias("_next")), "low", "left").select("src", F.coalesce("_next", "low").alias("low"))
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    if known is not None:
        nodes = nodes.join(known, "node", "full").select("node", F.coalesce("component", "node").alias("component"))
    else:
        nodes = nodes.withColumn("component", F.col("node"))
    return nodes.join(low, F.col("component") == F.col("src"), "left").select("node", F.coalesce("low", "component").alias("component"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N) -> DataFrame:
    """id, n_shingles, component_id (the least id reachable by links) of every row."""
    docs = docs.select(id_col, F.col(text_col).alias("text"))
    classes = written(posted(docs, id_col, n), "classes")
    comps = similar_components(docs, classes, id_col, n)
    own = classes.select("id", "size", "class")
    least = own.where("class is not null").groupBy("class").agg(F.min("id").alias("least"))
    if comps is not None:
        named = written(least.join(comps, F.col("class") == F.col("node"), "left").select("class", "least", F.coalesce("component", "class").alias("comp")), "named")
        least = named.join(named.groupBy("comp").agg(F.min("least").alias("first")), "comp").select("class", F.col("first").alias("least"))
    label = written(least, "labels")
    return own.join(label, "class", "left").select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"),
                                                   F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))


ORACLE = r"""
with recursive words as (
  select row_number() over () as row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w
  from documents
), sets as (
  select row, doc_id, list_sort(list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end)) s from words
), classes as (
  select s, len(s) n, row_number() over (order by min(row)) c, min(doc_id) least from sets group by s
), gram as (
  select c, n, unnest(s) g from classes
), link as (
  select a.c a, b.c b from gram a join gram b on a.g = b.g and a.c < b.c and 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  group by a.c, b.c, a.n, b.n having 9 * count(*) >= 4 * (a.n + b.n)
), both_ways as (
  select a, b from link union all select b, a from link
), reach as (
  select c a, c b from classes where n > 0 union select reach.a, both_ways.b from reach join both_ways on both_ways.a = reach.b
), component as (
  select reach.a c, min(least) component_id from reach join classes on classes.c = reach.b group by reach.a
)
select sets.doc_id, classes.n::bigint as n_shingles, coalesce(component.component_id, sets.doc_id) as component_id
from sets join classes using (s) left join component using (c)
"""
