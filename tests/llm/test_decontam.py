"""Greedy string tiling against a plain version; reordered and near passages."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from salesabc.llm import decontam

WORD = re.compile(r"[^\W_]+")


def plain(text):
    return WORD.findall((text or "").lower())


def brute_tiles(doc, item, k):
    """Textbook greedy string tiling: the marked words of the item."""
    md, mi, total = [False] * len(doc), [False] * len(item), 0
    while True:
        best = (0, 0, 0)
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n] and not md[a + n] and not mi[b + n]:
                    n += 1
                if n > best[2]:
                    best = a, b, n
        if best[2] < k:
            return total
        a, b, n = best
        for j in range(n):
            md[a + j] = mi[b + j] = True
        total += n


def brute(docs, items, k=5, coverage=0.8):
    out = set()
    for key, text in docs:
        d = plain(text)
        for item, t in items:
            w = plain(t)
            if w:
                n = brute_tiles(d, w, min(k, len(w)))
                if n and n >= coverage * len(w):
                    out.add((key, item, len(w), n))
    return out


def cases():
    r = random.Random(8)
    vocab = [f"w{i}" for i in range(40)] + ["É", "ß1"]
    say = lambda n: " ".join(r.choices(vocab, k=n))
    items = [(i, say(r.randint(8, 25))) for i in range(12)] + [(50, "two words"), (51, ""), (52, None), (53, "!!!"), (54, "the same the same the same the same the same the same")]
    docs = [(i, say(r.randint(0, 60))) for i in range(25)]
    for i, (_, t) in enumerate(items[:12]):
        w = t.split()
        h = len(w) // 2
        docs += [(100 + i, f"{say(10)}, {t.upper()}! {say(7)}"), (200 + i, " ".join([say(4), *w[h:], say(3), *w[:h], say(2)])), (300 + i, " ".join(w[:h])), (400 + i, " ".join(w[:h] + ["zz"] + w[h + 1:]))]
    docs += [(500, None), (501, ""), (502, "just two, words here"), (503, "the same " * 40), (503, "the same " * 40), (504, "x " * 50_000 + items[0][1])]
    return docs, items


def test_equals_brute_force(spark):
    docs, items = cases()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash")).withColumn("tiles", F.lit(1)).repartition(3, "doc_id")
    tests = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    want = brute([d for d in docs if d[0] != 504], items)
    assert {i + 200 for i in range(12)} & {k for k, *_ in want}
    for words in (2_000_000, 60):  # one block and several
        rows = decontam.contaminated(df, tests, block_words=words).collect()
        got = {(r["doc_id"], r["item_id"], r["item_words"], r["matched_words"]) for r in rows if r["doc_id"] != 504}
        assert got == want
        assert (504, 0) in {(r["doc_id"], r["item_id"]) for r in rows}
        assert sum(r["doc_id"] == 503 and r["item_id"] == 54 for r in rows) == 2
    for r in rows:
        doc = next(plain(t) for k, t in docs if k == r["doc_id"])
        item = next(plain(t) for k, t in items if k == r["item_id"])
        assert sum(t["words"] for t in r["tiles"]) == r["matched_words"]
        for t in r["tiles"]:
            assert doc[t["doc_word"]:t["doc_word"] + t["words"]] == item[t["item_word"]:t["item_word"] + t["words"]]


def test_empty_tables(spark, awkward, nothing):
    tests = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontam.contaminated(nothing, tests).count() == 0
    assert decontam.contaminated(awkward, tests.where("item_id < 0")).count() == 0


def test_running_hash_depends_on_the_run_alone():
    w = np.random.default_rng(1).integers(0, 1 << 62, 50).astype(np.uint64)
    h = decontam.running_hashes(np.concatenate([w, w]), 5)
    assert (h[:46] == h[50:96]).all() and len(set(h[:46].tolist())) == 46


def test_query_against_brute_force(spark):
    from salesabc.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r["doc_id"], r["item_id"], r["item_words"], r["matched_words"]) for r in QUERIES["op5_benchmark_decontamination"](spark, sf).collect()}
    # an item that shares no five words with a document has no tile there
    grams = {}
    for item, t in items:
        w = plain(t)
        for j in range(len(w) - 4):
            grams.setdefault(tuple(w[j:j + 5]), set()).add(item)
    want = set()
    for key, text in docs:
        d = plain(text)
        near = set().union(*(grams.get(tuple(d[j:j + 5]), set()) for j in range(len(d) - 4)), set())
        want |= brute([(key, " ".join(d[:3000]))], [x for x in items if x[0] in near])
    assert got == want


def test_tiles_of_repetitive_words_equal_the_textbook():
    r = random.Random(4)
    for _ in range(150):
        vocab = r.choice([2, 3, 8])
        doc, item = ([r.randrange(vocab) for _ in range(r.randint(1, 60))] for _ in range(2))
        k = r.choice([1, 2, 3, 5])
        if len(item) < k or len(doc) < k:
            continue
        d, w = np.array(doc, np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.array(item, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        grams = {tuple(item[i:i + k]) for i in range(len(item) - k + 1)}
        seeds = np.array([i for i in range(len(doc) - k + 1) if tuple(doc[i:i + k]) in grams], np.int64)
        tiles = decontam.tile(d, w, seeds, k) if len(seeds) else []
        assert sum(n for *_, n in tiles) == brute_tiles(doc, item, k)
        assert all(doc[a:a + n] == item[b:b + n] for a, b, n in tiles)


def test_very_long_repetitive_text(spark):
    """200,000 equal words against an item of 3,000 of them, in seconds and with memory by word."""
    import time
    import tracemalloc
    d, w = np.full(200_000, 7, np.uint64), np.full(3_000, 7, np.uint64)
    tracemalloc.start()
    start = time.time()
    assert sum(n for *_, n in decontam.tile(d, w, np.arange(199_996), 5)) == 3_000
    period = np.arange(200_000, dtype=np.uint64) % np.uint64(7) + np.uint64(1)
    assert sum(n for *_, n in decontam.tile(period, period[3:2_003], np.arange(199_996), 5)) == 2_000
    assert time.time() - start < 20 and tracemalloc.get_traced_memory()[1] < 200_000 * 400
    tracemalloc.stop()
    docs = spark.createDataFrame([(1, "same " * 200_000), (2, "other " * 200_000)], "doc_id long, text string")
    items = spark.createDataFrame([(5, "same " * 300), (6, "absent word")], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"], r["matched_words"]) for r in decontam.contaminated(docs, items).collect()] == [(1, 5, 300)]
