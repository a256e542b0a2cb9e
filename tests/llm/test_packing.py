"""Packing: exact tokens, gapless sequences, and a number of sequences near the least possible."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from salesabc.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_encoding_equals_tokenizer(tokenizer):
    r = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "'s", "'", "1", "23", "!", "%", "\xa0", "　", "\x1c", "\x85", "<|endoftext|>", "the", "ing", "​", "日本", "\r\n", "𝄞"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 30))) for _ in range(5000)] + ["", " ", "\n", " a", "a ", "a\n", "word " * 40]
    for batch in (texts, [""], [], ["", ""]):
        ids, offsets = packing.encode_texts(pa.array(batch, pa.large_string()), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in batch]


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once_and_wastes_little(seed):
    r, capacity = random.Random(seed), 64
    lengths = Counter(r.choice([r.randint(1, 64), r.randint(1, 10), 40]) for _ in range(r.choice([3, 50, 5000])))
    plan = packing.plan_patterns(lengths, capacity)
    used = Counter()
    for combo, times in plan:
        assert sum(combo) <= capacity and times > 0
        for x in combo:
            used[x] += times
    assert used == lengths
    got, total = sum(t for _, t in plan), sum(x * n for x, n in lengths.items())
    # first-fit decreasing as a yardstick
    bins = []
    for x in sorted(lengths.elements(), reverse=True)[:2000]:
        for i, free in enumerate(bins):
            if free >= x:
                bins[i] -= x
                break
        else:
            bins.append(capacity - x)
    if sum(lengths.values()) <= 2000:
        assert got <= len(bins) + 1
    big = sum(n for x, n in lengths.items() if 2 * x > capacity)
    assert got <= max(big, -(-total // capacity)) * 1.05 + 2


def test_exact_complements_come_first():
    plan = dict(packing.plan_patterns({60: 2, 4: 1, 3: 1, 1: 1, 50: 1, 7: 2}, 64))
    assert (60, 4) in plan and (60, 3, 1) in plan and (50, 7, 7) in plan


def check(rows, docs, tokenizer, capacity=packing.CAPACITY):
    want = Counter()
    for key, text in docs:
        ids = ids_of(tokenizer, text)
        cut, start = len(ids) if len(ids) <= capacity else (len(ids) % capacity or capacity), 0
        piece = 0
        while start < len(ids):
            part = ids[start:cut]
            want[key, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
            start, cut, piece = cut, cut + capacity, piece + 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    spans = defaultdict(list)
    for r in rows:
        spans[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in spans.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(spans)


def test_packs_awkward_documents(spark, awkward, nothing, tokenizer):
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    check(packing.pack_documents(awkward).collect(), docs, tokenizer)
    assert packing.pack_documents(nothing).count() == 0
    placed = packing.pack_documents(awkward, keep_ids=True).cache()
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        assert whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"]


def test_hot_length_is_ranked_in_buckets(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 7)
    docs = [(i, "same words here") for i in range(200)] + [(1000 + i, "w " * i) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    n = check(packing.pack_documents(df, capacity=64).collect(), docs, tokenizer, 64)
    total = sum(len(ids_of(tokenizer, t)) for _, t in docs)
    assert n <= -(-total // 64) * 1.05 + 1


def test_query_over_documents(spark, tokenizer):
    from salesabc.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op1_best_fit_packing"](spark, sf).collect(), docs, tokenizer)
