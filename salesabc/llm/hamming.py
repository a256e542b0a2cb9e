"""Links between 64-bit fingerprints within a Hamming radius, by a generalised pigeonhole.

The bits are grouped into parts, correlated bits together.  For a radius r and
m parts, any thresholds t_1..t_m (-1: skip the part) that add up to r - m + 1
are enough: two fingerprints within r bits differ in at most t_i bits in some
part i.  Every fingerprint is stored under its value in each part; as a query
it chooses its own thresholds by dynamic programming over the estimated number
of candidates, probes all part values within them, and verifies candidates by
the full bit distance.

Links between many fingerprints near each other would grow with the square of
their number, so a bucket gives out a spanning set of its links and never all
pairs: at most one row per member.  Buckets with many members are dealt over a
grid of cells of bounded size, each with one slice of the members and one of
the probes, so every pair still meets.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

BITS = 64
#: Cost of one probe or member row against that of one candidate check.
PAIR_COST = 0.01
#: Members (and probes) of a bucket that meet in one cell.
CELL = 4096


def choose_parts(n: int, radius: int) -> int:
    """The number of parts with the least estimated rows and candidates per query, for evenly spread values."""
    best = None
    for m in range(1, radius + 2):
        width, total = BITS // m, radius - m + 1
        share, rest = divmod(total, m)
        probes = sum(sum(comb(width, k) for k in range(share + (i < rest) + 1)) for i in range(m))
        if probes > 5000 or width > 62 and m > 1:
            continue
        cost = m + probes + PAIR_COST * probes * n / 2.0 ** min(width, 62)
        if best is None or cost < best[0]:
            best = cost, m
    return best[1] if best else radius + 1


def bit_moments(fingerprints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each two bits, of those that have both set (64 x 64, whatever the size)."""

    def counts(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            x = batch.column(0).to_numpy().astype(np.int64)
            for lo in range(0, len(x), 65536):
                bits = np.unpackbits(x[lo:lo + 65536].astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
                n += len(bits)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["n", "both"])

    part = fingerprints.mapInArrow(counts, "n long, both array<double>")
    flat = part.select("n", F.posexplode("both").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).collect()
    both, n = np.zeros(BITS * BITS), 0
    for r in flat:
        both[r["at"]], n = r["v"], r["n"]
    return int(n), both.reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """Deal the bits to m parts of near-equal width, each time adding the bit most correlated with its part."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    left, parts = set(range(BITS)), []
    for k in range(m):
        width = BITS // m + (k < BITS % m)
        order = sorted(left)
        start = order[int(np.argmax(corr[np.ix_(order, order)].sum(axis=1)))]
        part = [start]
        left.discard(start)
        while len(part) < width:
            order = sorted(left)
            nxt = order[int(np.argmax(corr[np.ix_(order, part)].sum(axis=1)))]
            part.append(nxt)
            left.discard(nxt)
        parts.append(sorted(part))
    return parts


def project(x: np.ndarray, part: list[int]) -> np.ndarray:
    out = np.zeros(len(x), np.uint64)
    for i, bit in enumerate(part):
        out |= (x >> np.uint64(bit) & np.uint64(1)) << np.uint64(i)
    return out


def halves(part: list[int]) -> list[list[int]]:
    """A part in slices of at most 11 bits, for which value counts are kept whole."""
    k = -(-len(part) // 11)
    return [part[i::k] for i in range(k)]


def slice_counts(fingerprints: DataFrame, parts: list[list[int]]) -> list[list[np.ndarray]]:
    """For each slice of each part, the number of fingerprints by value (at most 2,048 counts a slice)."""
    slices = [(i, j, s) for i, part in enumerate(parts) for j, s in enumerate(halves(part))]

    def counts(batches):
        got = [np.zeros(1 << len(s), np.int64) for _, _, s in slices]
        for batch in batches:
            x = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
            for c, (_, _, s) in zip(got, slices):
                c += np.bincount(project(x, s).astype(np.int64), minlength=len(c))
        for c, (i, j, _) in zip(got, slices):
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i, np.int32)), pa.array(np.full(len(at), j, np.int32)), pa.array(at), pa.array(c[at])], ["i", "j", "v", "n"])

    rows = fingerprints.mapInArrow(counts, "i int, j int, v long, n long").groupBy("i", "j", "v").agg(F.sum("n").alias("n")).collect()
    out = [[np.zeros(1 << len(s)) for s in halves(part)] for part in parts]
    for r in rows:
        out[r["i"]][r["j"]][r["v"]] = r["n"]
    return out


def by_distance(counts: np.ndarray, most: int) -> np.ndarray:
    """From counts by value: the number of entries at distance 0..most of every value."""
    width = (len(counts) - 1).bit_length()
    out = np.zeros((most + 1, len(counts)))
    out[0] = counts
    for bit in range(width):
        other = out[:, np.arange(len(counts)) ^ (1 << bit)].copy()
        out[1:] += other[:-1]
    return out


def allocate(estimates: np.ndarray, radius: int) -> np.ndarray:
    """Thresholds per query: estimates[i, t + 1, q] is the cost of threshold t (-1: none) in part i.

    Dynamic programming over the parts; the thresholds of a query add up to
    radius - parts + 1 at the least total cost.
    """
    m, levels, n = estimates.shape
    units = radius + 1  # sum of (t_i + 1)
    best = np.full((units + 1, n), np.inf)
    best[0] = 0
    choice = np.zeros((m, units + 1, n), np.int8)
    for i in range(m):
        new = np.full((units + 1, n), np.inf)
        for u in range(units + 1):
            for a in range(min(u, levels - 1) + 1):
                cost = best[u - a] + estimates[i, a]
                better = cost < new[u]
                new[u] = np.where(better, cost, new[u])
                choice[i, u] = np.where(better, a, choice[i, u])
        best = new
    out, u = np.zeros((m, n), np.int8), np.full(n, units)
    for i in range(m - 1, -1, -1):
        out[i] = choice[i, u, np.arange(n)] - 1
        u = u - (out[i] + 1)
    return out


def flips(width: int, t: int) -> np.ndarray:
    """All patterns of exactly t set bits out of width."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), t)], np.uint64)


def _rows(fingerprints: DataFrame, parts, tables, total, radius) -> DataFrame:
    """Member rows (kind 0) and probe rows (kind 1): part, key, kind, fp."""
    levels = min(radius, 3) + 2  # thresholds -1..3 in one part
    while len(parts) * (levels - 1) < radius + 1:
        levels += 1
    near = [[by_distance(c, levels - 2) for c in part] for part in tables]
    patterns = [[flips(len(part), t) for t in range(levels - 1)] for part in parts]
    slices = [halves(part) for part in parts]

    def expand(batches):
        for batch in batches:
            x = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
            for lo in range(0, len(x), 8192):
                q = x[lo:lo + 8192]
                cost = np.zeros((len(parts), levels, len(q)))
                for i, part in enumerate(parts):
                    dist = None  # expected members at each distance within the part, its slices taken as independent
                    for s, own in zip(slices[i], near[i]):
                        got = own[:, project(q, s).astype(np.int64)] / max(total, 1)
                        dist = got if dist is None else np.stack([sum(dist[a] * got[t - a] for a in range(t + 1)) for t in range(levels - 1)])
                    probes = np.cumsum([len(p) for p in patterns[i]])
                    cost[i, 1:] = probes[:, None] + PAIR_COST * total * np.cumsum(dist, axis=0)
                thresholds = allocate(cost, radius)
                for i, part in enumerate(parts):
                    value = project(q, part)
                    out = [(value, q, 0)]
                    for t in range(levels - 1):
                        who = thresholds[i] >= t
                        if who.any():
                            out.append(((value[who][:, None] ^ patterns[i][t][None, :]).ravel(), np.repeat(q[who], len(patterns[i][t])), 1))
                    for keys, fps, kind in out:
                        for at in range(0, len(keys), 100_000):
                            k, f = keys[at:at + 100_000], fps[at:at + 100_000]
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), i, np.int32)), pa.array(k.view(np.int64)), pa.array(np.full(len(k), kind, np.int32)), pa.array(f.view(np.int64))], ["part", "key", "kind", "fp"])

    return fingerprints.mapInArrow(expand, "part int, key long, kind int, fp long")


def _spanning(members: np.ndarray, probes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a cell that connect the same fingerprints as all its links within the radius do."""
    low_m, low_p = members.copy(), probes.copy()
    step = max(1, (1 << 21) // max(len(members), 1))
    near = [np.bitwise_count(probes[a:a + step, None] ^ members[None, :]) <= radius for a in range(0, len(probes), step)]
    big = np.uint64(np.iinfo(np.uint64).max)
    while True:
        was_m, was_p = low_m, low_p
        low_m = low_m.copy()
        new_p = []
        for k, hit in enumerate(near):
            a = k * step
            new_p.append(np.minimum(low_p[a:a + step], np.where(hit, low_m[None, :], big).min(axis=1)))
            low_m = np.minimum(low_m, np.where(hit, new_p[-1][:, None], big).min(axis=0))
        low_p = np.concatenate(new_p)
        if (low_m == was_m).all() and (low_p == was_p).all():
            break
    src, dst = np.concatenate((members, probes)), np.concatenate((low_m, low_p))
    some = src != dst
    return src[some], dst[some]


def _verify(radius: int):
    def links(batches):
        held: list[np.ndarray] | None = None

        def solve(cols):
            part, key, cell, kind, fp = cols
            if not len(part):
                return
            new = np.flatnonzero((part[1:] != part[:-1]) | (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])) + 1
            start = np.concatenate(([0], new))
            size = np.diff(np.concatenate((start, [len(part)])))
            n_probe = np.add.reduceat(kind, start)
            n_member = size - n_probe  # members come first in a cell
            pairs = n_probe * n_member
            src, dst = [], []
            for g in np.flatnonzero(pairs > 4096):
                a, b = start[g], start[g] + n_member[g]
                s, d = _spanning(fp[a:b], fp[b:start[g] + size[g]], radius)
                src.append(s), dst.append(d)
            small = np.flatnonzero((pairs > 0) & (pairs <= 4096))
            for lo in range(0, len(small), 2000):
                g = small[lo:lo + 2000]
                count = pairs[g]
                own = np.repeat(np.arange(len(g)), count)
                at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                m, p = at % n_member[g][own], at // n_member[g][own]
                x, y = fp[start[g][own] + m], fp[start[g][own] + n_member[g][own] + p]
                ok = (np.bitwise_count(x ^ y) <= radius) & (x != y)
                src.append(x[ok]), dst.append(y[ok])
            if src and sum(map(len, src)):
                s, d = np.concatenate(src), np.concatenate(dst)
                s, d = np.maximum(s, d), np.minimum(s, d)
                pair = np.unique(np.stack((s, d)), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pair[0].view(np.int64)), pa.array(pair[1].view(np.int64))], ["src", "dst"])

        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(4)] + [batch.column(4).to_numpy().astype(np.int64).view(np.uint64)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            part, key, cell = cols[:3]
            last = np.flatnonzero((part != part[-1]) | (key != key[-1]) | (cell != cell[-1]))
            cut = last[-1] + 1 if len(last) else 0
            yield from solve([c[:cut] for c in cols])
            held = [c[cut:] for c in cols]
        if held is not None:
            yield from solve(held)

    return links


def near_links(fingerprints: DataFrame, radius: int, parts: int | None = None) -> DataFrame:
    """(fp) distinct 64-bit fingerprints -> (src, dst) links that connect exactly those joined by chains of
    differences of at most ``radius`` bits.

    Nulls have no links; an empty table gives no links.  Every fingerprint is
    a member and a query; none is dropped and no bucket is capped.
    """
    fps = fingerprints.where("fp is not null")
    n, both = bit_moments(fps)
    m = parts or choose_parts(n, radius)
    groups = group_bits(n, both, m)
    tables = slice_counts(fps, groups)
    rows = written(_rows(fps, groups, tables, n, radius), "probes")
    sizes = rows.groupBy("part", "key").agg(F.sum(1 - F.col("kind")).alias("members"), F.sum("kind").alias("probed"))
    hot = written(sizes.where(f"members > 0 and (members > {CELL} or probed > {CELL})")
                  .select("part", "key", F.ceil(F.col("members") / CELL).alias("a"), F.ceil(F.col("probed") / CELL).alias("b")), "hot-buckets")
    # A member goes to one row of the grid and all its columns, a probe to one column and all its rows.
    slot = F.pmod(F.xxhash64("fp"), F.when(F.col("kind") == 0, F.col("a")).otherwise(F.col("b")))
    cells = F.when(F.col("kind") == 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("b") - 1), lambda j: F.col("slot") * F.col("b") + j)).otherwise(
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("a") - 1), lambda i: i * F.col("b") + F.col("slot")))
    dealt = (rows.join(hot, ["part", "key"], "left").withColumn("slot", slot)
             .select("part", "key", F.explode(F.when(F.col("a").isNull(), F.array(F.lit(0).cast("long"))).otherwise(cells)).alias("cell"), "kind", "fp"))
    return (dealt.repartition("part", "key", "cell").sortWithinPartitions("part", "key", "cell", "kind")
            .mapInArrow(_verify(radius), "src long, dst long"))
