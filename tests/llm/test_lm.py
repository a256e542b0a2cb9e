"""Katz back-off against a plain dictionary version, and exact normalisation."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesabc.llm import lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens_of(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return WORD.findall(low) + ["\0end"]


def brute(rows):
    """rows: (id, text, train) -> {id: (n_tokens, n_known, N, base, score)} and the model as a function."""
    uni, pair = Counter(), defaultdict(Counter)
    for _, text, train in rows:
        if train:
            t = tokens_of(text)
            uni.update(t)
            for a, b in zip(["\0begin", *t], t):
                pair[a][b] += 1
    n, v = sum(uni.values()), len(uni)

    def counts(values):
        out = np.zeros(lm.K + 2, np.int64)
        for x in values:
            if x < len(out):
                out[x] += 1
        return out

    d1, d2 = lm.discounts(counts(uni.values())), lm.discounts(counts(c for x in pair.values() for c in x.values()))
    d = lambda t, c: t[c] if c <= lm.K else 1.0
    lost = sum(c * (1 - d(d1, c)) for c in uni.values())
    total, unknown = (n, lost / n) if lost > 0 else (n + 1, 1 / (n + 1))

    def p1(w):
        return d(d1, uni[w]) * uni[w] / total if uni[w] else unknown

    def p2(w, h):
        seen = pair.get(h)
        if not seen:
            return p1(w)
        c, left = sum(seen.values()), sum(x * (1 - d(d2, x)) for x in seen.values())
        if left <= 0:
            c, left = c + 1, 1
        if seen[w]:
            return d(d2, seen[w]) * seen[w] / c
        return left / c / (1 - sum(p1(x) for x in seen)) * p1(w)

    out = {}
    for key, text, _ in rows:
        t = tokens_of(text)
        out[key] = (len(t), sum(uni[w] > 0 for w in t), n, sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t),
                    sum(math.log10(p2(w, h)) for h, w in zip(["\0begin", *t], t)))
    return out, uni, pair, p2


def texts(seed, n, words):
    r = random.Random(seed)
    vocab = [f"W{i}é" if i % 7 == 0 else f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    rows = [(i, " \t".join(r.choices(vocab, weights, k=r.randint(0, 25))), r.random() < 0.8) for i in range(n)]
    return [*rows, (n, None, True), (n + 1, "", False), (n + 2, "\x0b\x1c new", False), (n + 3, "w0 w0 w0 " * 50, True)]


@pytest.mark.parametrize("seed,n,words,block", [(1, 60, 40, 100), (2, 150, 400, 4_000_000), (3, 2, 3, 10)])
def test_scores_equal_brute_force(spark, seed, n, words, block):
    rows = texts(seed, n, words)
    want, uni, pair, p2 = brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(3, "doc_id")
    df = df.withColumn("train", F.lit("clash"))
    got = {r["doc_id"]: r for r in lm.score_texts(df, F.col("learn"), block_tokens=block).collect()}
    assert got.keys() == want.keys()
    for key, (n_tokens, known, total, base, score) in want.items():
        r = got[key]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n_tokens, known, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r["score"], score, rel_tol=1e-9, abs_tol=1e-9)
    for h in [*list(pair)[:30], "never seen"]:
        assert math.isclose(sum(p2(w, h) for w in uni) + p2("\0unknown", h), 1, rel_tol=1e-9)


def test_no_training_and_empty(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm.score_texts(df, F.lit(False)).collect()}
    assert got[1]["train_tokens"] == 0 and got[1]["score"] == 0 and got[1]["n_known"] == 0
    assert lm.score_texts(df.where("doc_id > 5"), F.lit(True)).count() == 0


def test_discounts_are_proper():
    for n in ([0, 100, 40, 22, 14, 10, 7], [0, 5, 0, 0, 0, 0, 0], [0] * 7, [0, 3, 9, 1, 0, 2, 8]):
        d = lm.discounts(np.array(n))
        assert ((d[1:] > 0) & (d[1:] <= 1)).all()


def test_better_than_base_on_held_out(spark):
    from salesabc.llm.queries import QUERIES

    r = QUERIES["op6_lm_scoring"](spark, "/root/testdata/sf0.001").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]
