"""Toxicity and quality: held-out accuracy, the label model, and awkward inputs."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesabc.llm import cotraining, toxicity

SF = "/root/testdata/sf0.01"


def held_out(key):
    return zlib.crc32(str(key).encode()) % 3 == 1


def test_label_model_recovers_voters():
    r = np.random.default_rng(3)
    n, true = 40_000, None
    true = r.random(n) < 0.15
    fire = np.array([[0.02, 0.7], [0.05, 0.5], [0.01, 0.6], [0.3, 0.35]])
    x = np.stack([r.random(n) < fire[j][true.astype(int)] for j in range(4)] + [np.zeros(n, bool)], axis=1)
    x[:, 4] = x[:, 0] ^ (r.random(n) < 0.03)  # nearly a copy of the first voter
    pattern = (x * (1 << np.arange(5))).sum(axis=1)
    label = np.where(r.random(n) < 0.05, true.astype(int), -1)
    table = {}
    for p, g in zip(pattern, label):
        table[p, g] = table.get((p, g), 0) + 1
    p, g, c = (np.array(v) for v in zip(*((*k, v) for k, v in table.items())))
    model = toxicity.LabelModel(5).fit(p, g, c.astype(float))
    assert (0, 4) in model.pairs
    assert abs(model.prior[1] - 0.15) < 0.04
    post = model.posterior(pattern, np.full(n, -1))
    best = sum(max((true & (pattern == q)).sum(), (~true & (pattern == q)).sum()) for q in range(32)) / n  # no rule on these voters does better
    assert ((post > 0.5) == true).mean() > best - 0.02
    assert abs(np.exp(model._joint()).sum(axis=0) - 1).max() < 1e-9


@pytest.fixture(scope="module")
def labels(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_toxicity_held_out(spark, labels):
    from salesabc.llm.queries import QUERIES

    rows = QUERIES["op8_toxicity"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    test = [(r["predicted"], labels[r["doc_id"]]["toxic"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p and not y for p, y in test) <= 0.02 * len(test)
    assert sum(p and y for p, y in test) >= 0.7 * sum(y for _, y in test)


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300")
    own = spark.read.parquet(f"{SF}/labels.parquet")
    rest = F.crc32(F.col("doc_id").cast("string")) % 3
    flipped = own.withColumn("toxic", F.when(rest == 1, 1 - F.col("toxic")).otherwise(F.col("toxic"))).withColumn("quality", F.when(rest == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, t, rest != 1).collect()} for t in (own, flipped))
    assert a == b


def test_toxicity_awkward(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, None), (None, 1), (120, 0)], "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    learn = F.col("doc_id") % 2 >= 0
    for given in (labels, labels.where("toxic > 5")):
        rows = toxicity.toxicity(awkward, given, learn, carry=("lang",)).collect()
        assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 and r["lang"] == "en" for r in rows)
    assert toxicity.toxicity(nothing, labels, learn).count() == 0


def test_seed_lexicon_alone(spark):
    docs = spark.createDataFrame([(i, f"fine words here number {i}") for i in range(80)] + [(100 + i, "you stupid idiot, pathetic moron and scum") for i in range(10)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, none, F.lit(True)).collect()}
    assert min(got[100 + i] for i in range(10)) > max(got[i] for i in range(80))


def test_patterns_of_all_rows_count(spark):
    """Rows that give no labels still feed the label model."""
    docs = spark.createDataFrame([(i, f"fine words here number {i}") for i in range(80)] + [(100 + i, "you stupid idiot, pathetic moron and scum") for i in range(10)] + [(None, "fine words without an id")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, none, F.lit(False)).collect()
    assert len(got) == 91
    assert min(r["score"] for r in got if (r["doc_id"] or 0) >= 100) > max(r["score"] for r in got if (r["doc_id"] or 0) < 100)


def test_mined_voters_by_kind(spark):
    mined = [" alpha ", " beta ", " gamm", "elta "]
    found = [([0], 1), ([1], 2), ([2], 2), ([3], 4), ([4], 8), ([1, 4], 2 | 8), ([], 0)]
    rows = spark.createDataFrame([(f, 1, 1000, 0.0, 0.0, want) for f, want in found], "found array<int>, hits long, words long, upper double, symbols double, want int")
    assert all(r["got"] == r["want"] for r in rows.withColumn("got", toxicity.votes(1, mined)).collect())


def test_quality_held_out(spark, labels):
    from salesabc.llm.queries import QUERIES

    rows = QUERIES["op3_quality_classifier"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    test = [(r, labels[r["doc_id"]]["quality"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    for column in ("content_score", "metadata_score", "score"):
        assert np.mean([(r[column] >= 0.5) == y for r, y in test]) > 0.9
    assert np.mean([r["predicted"] == y for r, y in test]) > 0.95


def test_pool_is_all_outside_the_sample(spark, monkeypatch):
    """A table labelled throughout still has a pool; held-out rows and null ids are in it."""
    pools, best = [], cotraining._best_of_all

    def spy(pool, views, picks):
        pools.append({r["doc_id"] for r in pool.select("doc_id").collect()})
        return best(pool, views, picks)

    monkeypatch.setattr(cotraining, "_best_of_all", spy)
    words = ("plain calm prose of good length", "BUY!!! $$$ 999 CLICK")
    docs = spark.createDataFrame([(i, f"{words[i % 2]} {i}", "en", "web") for i in range(200)] + [(None, "no id", "en", "web")], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(200)], "doc_id long, quality int")
    rows = cotraining.co_train(docs, labels, F.col("doc_id") % 5 != 1, fit_rows=80, rounds=1, picks=5).collect()
    share = int(80 / 160 * 1_000_000)
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    fitted = {r["doc_id"] for r in labels.where((F.col("doc_id") % 5 != 1) & (hashed < share)).collect()}
    assert len(rows) == 201 and pools == [set(range(200)) - fitted | {None}]
    assert 0 < len(fitted) < 160


def test_quality_awkward(spark, awkward, nothing):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(3, None), (None, 1)], "doc_id long, quality int").withColumn("content", F.lit("clash"))
    for given in (labels, labels.where("quality = 1"), labels.where("quality > 5")):
        rows = cotraining.co_train(awkward, given, F.lit(True), rounds=1, picks=3).collect()
        assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert cotraining.co_train(nothing, labels, F.lit(True), rounds=1).count() == 0


def test_word_shapes():
    assert cotraining.shape("Hello,") == "Aa," and cotraining.shape("abc%%%") == "a%" and cotraining.shape("2024-01") == "0-0"
