"""SimHash near-duplicates against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from salesabc.llm import graph, hamming, simhash_dup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fp(text, k=4):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    parts = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps, radius):
    """{place: least reachable place}"""
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_equals_spark_hash(spark):
    text = "Ab cd é F gh"
    assert simhash_dup.simhash("ab CD é f", 4) == spark.range(1).select(F.xxhash64(F.lit("ab cd é f"))).first()[0] % (1 << 64)
    assert simhash_dup.simhash(text, 4) == brute_fp(text)


@pytest.mark.parametrize("parts", [None, 2, 3, 4])
def test_links_join_what_all_pairs_join(spark, parts, monkeypatch):
    monkeypatch.setattr(hamming, "CELL", 16)  # buckets of more than 16 members go over a grid
    r = random.Random(parts or 9)
    fps = {0, (1 << 64) - 1}
    for _ in range(25):  # balls of fingerprints, some drifting away in small steps
        x = r.getrandbits(64)
        for _ in range(r.choice([1, 3, 30])):
            fps.add(x)
            y = x
            for _ in range(r.randint(1, 5)):
                y ^= 1 << r.randrange(64)
            x = y if r.random() < 0.5 else x
            fps.add(y)
    fps = sorted(fps)
    df = spark.createDataFrame([(signed(x),) for x in fps] + [(None,)], "fp long")
    links = hamming.near_links(df, 4, parts)
    for row in links.collect():
        a, b = row["src"] % (1 << 64), row["dst"] % (1 << 64)
        # spanning links within a bucket may join chains, never other groups
        assert a in set(fps) and b in set(fps)
    got = {row["node"] % (1 << 64): row["component"] for row in graph.connected_components(links).collect()}
    want = brute_groups(fps, 4)
    mine = {}
    for x, w in zip(fps, want):
        mine.setdefault(w, set()).add(got.get(x, x))
    assert all(len(v) == 1 for v in mine.values())
    assert len({next(iter(v)) for v in mine.values()}) == len(mine)


def test_allocation_adds_up_and_follows_cost():
    cost = np.array([[[0, 5, 50, 500]], [[0, 1, 2, 3]], [[0, 9, 90, 900]]], float).transpose(0, 2, 1)
    t = hamming.allocate(cost, 4)[:, 0]
    assert t.sum() == 4 - 3 + 1 and t[1] == 2


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(300, 300), (None, 4)]
    got = {r["node"]: r["component"] for r in graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)}


def check(got, rows):
    fps = [brute_fp(t) for _, t in rows]
    groups = brute_groups(fps, 4)
    least = {}
    for (key, _), g in zip(rows, groups):
        least[g] = min(key, least.get(g, key))
    want = sorted((key, f"{fp:016x}", least[g]) for (key, _), fp, g in zip(rows, fps, groups))
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


def test_awkward_documents(spark, awkward, nothing):
    check(simhash_dup.near_duplicates(awkward).collect(), [(r["doc_id"], r["text"]) for r in awkward.collect()])
    assert simhash_dup.near_duplicates(nothing).count() == 0


def test_query_against_all_pairs(spark):
    from salesabc.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op10_simhash_near_dedup"](spark, sf).collect(), rows)
