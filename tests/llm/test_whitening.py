"""Whitening against numpy's eigenvectors and exact integers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesabc.llm import whitening

SF = "/root/testdata/sf0.001"


def brute(rows):
    """(n, S, mean-centred fit, kept rows as (id, x)) in exact integers."""
    kept = []
    for key, v in rows:
        if v is None or any(c is None or not np.isfinite(c) for c in v):
            continue
        kept.append((key, [int(np.floor(64 * float(c))) + 1000000 for c in v]))
    fit = sorted({tuple(x) for _, x in kept})
    n = len(fit)
    return n, [sum(c) for c in zip(*fit)], fit, kept


def check(got, rows, most=16):
    n, s, fit, kept = brute(rows)
    centred = np.array([[int(n * a - b) / n for a, b in zip(x, s)] for x in fit])
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, int((values > 1e-15 * np.trace(v)).sum()))
    assert len(got) == k * len(kept)
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], []).append(r)
    assert {r["identity_error"] for r in got if r["identity_error"] > 1e-9} == set()
    sign = {}
    for key, x in kept:
        mine = sorted((r for r in by[key]), key=lambda r: r["component"])
        assert {r["n"] for r in mine} == {n}
        assert int(mine[0]["deviation"]) in {sum((n * a - b) ** 2 for a, b in zip(y, s)) for i, y in kept if i == key}
        if len(mine) != k:
            continue  # an id on several rows
        dev = np.array([(n * a - b) / n for a, b in zip(x, s)])
        for j, r in enumerate(mine):
            assert r["component"] == j + 1 and abs(r["explained"] - values[j] / np.trace(v)) < 1e-10
            assert abs(r["identity_error"]) < 1e-6
            gap = min(abs(values[j] - o) for i, o in enumerate(values) if i != j) if len(values) > 1 else values[j]
            if gap > 1e-6 * values[0] and values[j] > 1e-6 * values[0]:
                want = dev @ vectors[:, j] / np.sqrt(values[j])
                if abs(want) > 1e-6:
                    sign.setdefault(j, np.sign(want * r["whitened"]))
                    assert abs(want * sign[j] - r["whitened"]) < 1e-7 * max(1, values[0] / gap)


def test_query(spark):
    from salesabc.llm.queries import QUERIES

    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op11_embedding_whitening"](spark, SF)
    assert [f.dataType.simpleString() for f in got.schema][:7] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    check(got.collect(), rows)


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
def test_components_of_hard_spectra(n):
    r = np.random.default_rng(n)
    q, _ = np.linalg.qr(r.standard_normal((n, n)))
    for values in (np.linspace(1, 2, n), np.logspace(-9, 3, n), np.ones(n), np.r_[np.ones(n // 2) * 3, np.ones(n - n // 2)], 1 + 1e-13 * np.arange(n), np.r_[np.zeros(n - 1), 5.0]):
        a = (q * values) @ q.T
        a = (a + a.T) / 2
        vectors = whitening.spectral(a)
        got, turn = whitening.rotated(vectors.T @ a @ vectors)
        got, vectors = whitening.components(got, vectors @ turn, n)
        want = np.linalg.eigvalsh(a)[::-1]
        assert len(got) >= (want > 1e-14 * np.trace(a)).sum()
        assert np.abs(got - want[: len(got)]).max() <= 1e-12 * np.abs(want).max()
        assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-12
        assert np.abs(a @ vectors - vectors * got).max() < 1e-11 * np.abs(want).max()


def test_polar_factor():
    r = np.random.default_rng(3)
    for k in (1e-14, 1e-6, 1.0):
        q, _ = np.linalg.qr(r.standard_normal((20, 20)))
        values = np.r_[k, -np.linspace(0.5, 2, 10), np.linspace(0.1, 3, 9)]
        u = whitening.polar((q * values) @ q.T)
        assert np.abs(u - (q * np.sign(values)) @ q.T).max() < (1e-1 if k < 1e-10 else 1e-8)
        assert np.abs(u @ u - np.eye(20)).max() < 1e-12


def awkward_vectors():
    r = np.random.default_rng(0)
    rows = [(i, [float(v) for v in r.standard_normal(5)]) for i in range(60)]
    rows += [(100, None), (101, [None, 1.0, 2.0, 3.0, 4.0]), (102, [float("nan")] * 5), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (104, [0.0, float("-inf"), 0.0, 0.0, 0.0])]
    rows += [(110, rows[3][1])] * 3 + [(None, rows[4][1]), (111, [1e7, -1e7, 0.0, 0.0, 1.0])]
    return rows


def test_awkward_rows(spark):
    rows = awkward_vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for name in ("x", "id", "n", "v", "component", "key", "size", "vector", "deviation"):
        df = df.withColumn(name, F.lit("clash"))
    rows = [(a, None if b is None else [None if c is None else float(np.float32(c)) for c in b]) for a, b in rows]
    check(whitening.whiten(df.repartition(4)).collect(), rows)
    # another length is no part of the fit, an empty vector neither
    more = df.select("vec_id", "embedding").unionAll(spark.createDataFrame([(500, [1.0, 2.0]), (501, [])], "vec_id long, embedding array<float>"))
    assert whitening.whiten(more).where("vec_id >= 500").count() == 0
    check(whitening.whiten(more).collect(), rows)


def test_nothing_to_whiten(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(df).count() == 0  # no variance
    assert whitening.whiten(df.where("vec_id < 0")).count() == 0
    assert whitening.whiten(df.where("vec_id = 1")).count() == 0
    # one of two dimensions varies
    got = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 3.0]), (3, [1.0, 5.0])], "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in got} == {1} and all(abs(r["explained"] - 1) < 1e-12 for r in got)
