"""Document fingerprints, edited texts, and the search by block tables."""

import hashlib
import random

import numpy as np
import pyarrow as pa

from salesabc.llm import fingerprint


def brute(rows):
    """rows in order -> {place: (n_chars, sha256 of the edited text)}"""
    out = []
    for i, (key, text) in enumerate(rows):
        follower = rows[(i + 1) % len(rows)][1]
        n = len(text)
        out.append((key, n, hashlib.sha256((text[:n - n // 2] + follower[:n // 2]).encode()).hexdigest()))
    return out


def in_order(df):
    return sorted(((r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0], r[1].encode()))


def test_awkward_documents(spark, awkward, nothing, monkeypatch):
    monkeypatch.setattr(fingerprint, "BUCKET_ROWS", 5)  # many buckets
    rows = in_order(awkward)
    got = fingerprint.fingerprint_pairs(awkward).collect()
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == sorted(brute(rows))
    by_text = {}
    for r, (_, text) in zip(sorted(got, key=lambda r: (r["doc_id"], r["n_chars"])), sorted(rows, key=lambda r: (r[0], len(r[1])))):
        by_text.setdefault(text, set()).add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(v) == 1 for v in by_text.values())
    assert by_text[""] == {"0" * 32}
    assert fingerprint.fingerprint_pairs(nothing).count() == 0
    single = fingerprint.fingerprint_pairs(awkward.where("doc_id = 7")).collect()
    assert len(single) == 1 and single[0]["near_next"] == 1


def test_uneven_and_null_ids(spark):
    rows = [(-(1 << 60), "a b"), (5, "c d e f"), (6, "g"), ((1 << 62), "h i j"), (None, "k l m")]
    got = fingerprint.fingerprint_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute([rows[-1], *rows[:-1]])
    key = lambda r: str(r)
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=key) == sorted(want, key=key)


def test_likeness_follows_overlap():
    r = random.Random(1)
    words = [f"w{r.randrange(10**6)}" for _ in range(600)]
    other = [f"v{r.randrange(10**6)}" for _ in range(600)]
    texts = [" ".join(words[:600 - k] + other[:k]) for k in (0, 0, 30, 300, 600)]
    fps = fingerprint.simhash_all(pa.array(texts, pa.large_string()))
    near = [float(fingerprint.likeness(fps[0], f)) for f in fps]
    assert near[1] == 1 and near[2] > 0.85 and 0.2 < near[3] < 0.75 and near[4] < 0.35


def test_block_tables_find_all(spark):
    r = random.Random(4)
    fps = set()
    for _ in range(60):
        x = r.getrandbits(128)
        for _ in range(6):
            y = x
            for _ in range(r.randint(0, 9)):
                y ^= 1 << r.randrange(128)
            fps.add(y)
    names = [f"{x:032x}" for x in sorted(fps)]
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "fingerprint string")
    queries = df.where("fingerprint < '8'")
    got = {(r["query"], r["fingerprint"]): r["distance"] for r in fingerprint.within_radius(queries, df, 6).collect()}
    want = {}
    for a in names:
        if a < "8":
            for b in names:
                d = (int(a, 16) ^ int(b, 16)).bit_count()
                if d <= 6:
                    want[a, b] = d
    assert got == want


def test_query_follows_ids(spark):
    from salesabc.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = in_order(spark.read.parquet(f"{sf}/documents.parquet"))
    got = QUERIES["op4_document_fingerprints"](spark, sf).collect()
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == sorted(brute(rows))
    assert np.mean([r["near_edited"] > r["near_next"] for r in got]) > 0.9


def plain_simhash(text):
    """The fingerprint by its definition, a term and a bit at a time."""
    import math

    import xxhash
    mask = (1 << 64) - 1

    def mix(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
        return x ^ x >> 31

    words = [xxhash.xxh3_64_intdigest(w) for w in (text or "").encode().lower().split()]
    terms = [mix(a * 0x9E3779B97F4A7C15 + b & mask) for a, b in zip(words, words[1:])] or words
    weight = {t: 1 + math.log(terms.count(t)) for t in set(terms)}
    lanes = []
    for lane in range(2):
        salt = mix((lane + 1) * 0x9E3779B97F4A7C15 & mask)
        votes = [sum(w if mix(t ^ salt) >> b & 1 else -w for t, w in weight.items()) for b in range(64)]
        lanes.append((sum(1 << b for b in range(64) if votes[b] > 1e-4), any(abs(v) <= 1e-4 for v in votes)))
    return "".join(f"{v:016x}" for v, _ in lanes), any(tie for _, tie in lanes)


def test_fingerprints_and_likeness_by_definition(spark, awkward):
    import math
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect() if r["text"] is None or len(r["text"]) < 5000]
    rows += [(1000 + i, t) for i, (_, t) in enumerate(in_order(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))[:40]) if len(t or "") < 5000]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in fingerprint.fingerprints(df).collect():
        got.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    for key, text in rows:
        want, tied = plain_simhash(text)
        assert tied or want in got[key]
    pairs = fingerprint.fingerprint_pairs(df.where("doc_id >= 1000")).collect()
    by = {r["doc_id"]: r for r in pairs}
    ids = sorted(by)
    for key, after in zip(ids, ids[1:] + ids[:1]):
        apart = (int(by[key]["fingerprint"], 16) ^ int(by[after]["fingerprint"], 16)).bit_count()
        assert abs(by[key]["near_next"] - max(0.0, math.cos(math.pi * apart / 128))) < 1e-6


def test_search_query_finds_all(spark):
    from salesabc.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    own = {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprints(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    classes = {}
    for key, fp in own.items():
        classes.setdefault(fp, []).append(key)
    want = {(key, fp, (int(own[key], 16) ^ int(fp, 16)).bit_count(), min(ids), len(ids)) for key in own if key % 50 == 0 for fp, ids in classes.items()
            if (int(own[key], 16) ^ int(fp, 16)).bit_count() <= 6}
    got = {(r["doc_id"], r["near_fingerprint"], r["distance"], r["near_id"], r["near_docs"]) for r in QUERIES["op4_fingerprint_search"](spark, sf).collect()}
    assert got == want and len(want) >= 4
