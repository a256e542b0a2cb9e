"""N-gram Jaccard join against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from salesabc.llm import ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=5):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)])


def brute(rows):
    """[(id, set size, least id reachable)]"""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return sorted(((key, len(s), least.get(root(i)) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets))), key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def families(seed, groups, most, passage):
    """Near copies with edits around the threshold, a passage that many texts share, short texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefghij", k=r.randint(1, 4)))
    shared = [word() for _ in range(passage)]
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(r.choice([3, 6, 20, 60, 150]))]
        if r.random() < 0.4:
            base[len(base) // 2:len(base) // 2] = shared
        for _ in range(r.randint(1, most)):
            own = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                own[r.randrange(len(own))] = word()
            if r.random() < 0.2:
                own = own[: int(len(own) * r.uniform(0.75, 1)) + 1]
            rows.append((len(rows) + 7, "  ".join(w.upper() if r.random() < 0.1 else w for w in own)))
    return rows


@pytest.mark.parametrize("seed,groups,most,cell,look", [(1, 60, 6, 4096, 32), (2, 4, 90, 8, 1)])
def test_families(spark, monkeypatch, seed, groups, most, cell, look):
    monkeypatch.setattr(ngram_join, "CELL", cell)  # longer lists are dealt over slices and a grid
    monkeypatch.setattr(ngram_join, "LOOK", look)
    rows = families(seed, groups, most, 30)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(ngram_join.jaccard_components(df)) == brute(rows)


def test_without_first_rounds(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PARTNERS", ())
    rows = families(5, 10, 12, 20)
    assert got(ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_threshold_is_exact(spark):
    words = [f"w{i}" for i in range(13)]  # 9 shingles
    rows = [(1, " ".join(words)), (2, " ".join(words[:12])), (3, " ".join(words[:11])), (4, " ".join(["x"] + words[:10])), (5, " ".join(words[:4])), (6, " ".join(words[:3]))]
    assert got(ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_awkward_documents(spark, awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    more = spark.createDataFrame([(None, rows[4][1]), (None, "only a null id has this text here")], "doc_id long, text string")
    assert got(ngram_join.jaccard_components(awkward.select("doc_id", "text").unionAll(more))) == brute(rows + [tuple(r) for r in more.collect()])
    assert got(ngram_join.jaccard_components(awkward)) == brute(rows)
    assert ngram_join.jaccard_components(nothing).count() == 0


def test_digests_do_not_depend_on_order():
    r = np.random.default_rng(0)
    a = r.integers(0, 1 << 63, 12).astype(np.uint64)
    one = ngram_join._digests(np.concatenate((a, a[::-1], a[:5])), np.array([12, 12, 5]), np.array([0, 12, 24, 29]))
    assert one[0] == one[1] != one[2]


def test_query_against_all_pairs(spark):
    from salesabc.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    result = QUERIES["op13_ngram_jaccard_join"](spark, sf)
    assert [f.dataType.simpleString() for f in result.schema] == ["bigint", "bigint", "bigint"]
    assert got(result) == brute(rows)


def test_parity_filter_spares_far_pairs_and_no_near_one():
    rng = np.random.default_rng(13)
    size, kept = 720, {}
    shared = -(-4 * 2 * size // 9)  # the least number of n-grams that two such sets must share
    for common in (size, shared, shared - 200):
        sets = []
        for _ in range(50):
            base = rng.integers(0, 1 << 63, 2 * size - common).astype(np.uint64)
            sets += [base[:size], base[size - common:]]
        signs = ngram_join._parities(np.concatenate(sets), np.repeat(np.arange(100), size), 100)
        pairs = pa.RecordBatch.from_arrays([pa.array(range(50), pa.int64())] * 2 + [pa.array([size] * 50, pa.int64())] * 2
                                           + [pa.array([x.tobytes() for x in signs[side::2]], pa.binary()) for side in (0, 1)], list("abcdef"))
        kept[common] = sum(b.num_rows for b in ngram_join._near_parities([pairs]))
    assert kept == {size: 50, shared: 50, shared - 200: 0}


def test_sets_of_asked_classes_only(spark):
    sets = spark.range(1000).selectExpr("id as class", "encode(string(id), 'utf-8') as parities", "encode(string(id), 'utf-8') as grams")
    asked = spark.createDataFrame([(7,), (7,), (600,)], "class long")
    assert {7, 600} <= {r["class"] for r in ngram_join._asked_sets(sets, asked).collect()} < set(range(20)) | set(range(590, 610))
