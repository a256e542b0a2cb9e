"""Conversation trie against a dictionary of prefixes; time-forward totals against plain recursion."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from salesabc.llm import timeforward, trie

SF = "/root/testdata/sf0.001"


def brute(rows):
    """Rows of the result from (conv_id, turn, role, text)."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs.setdefault(c, []).append(((turn is not None, turn or 0), role, (digest[:15], digest[16:31]), text))
    turns = {c: [(r[1], r[3]) for r in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        head = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = turns.get(head, [])[:h] + turns[c][h:]
    node = {}
    for c, t in whole.items():
        for d in range(len(t) + 1):
            node.setdefault(tuple(t[:d]), []).append(c)
    out = []
    leaves, saved, kids = {}, {}, {}
    for k in sorted(node, key=len, reverse=True):
        kids.setdefault(k, 0)
        leaves[k] = leaves.get(k, 0) or 1
        saved[k] = saved.get(k, 0) + (len(node[k]) - 1) * (len(k[-1][1]) if k else 0)
        if k:
            up = k[:-1]
            kids[up] = kids.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[k]
            saved[up] = saved.get(up, 0) + saved[k]
    for k, members in node.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(whole[c]) == len(k)))
        out.append((min(members), len(k), min(node[k[:-1]]) if k else None, len(members), kids[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query(spark):
    from salesabc.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op12_conversation_trie"](spark, SF)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert [f.dataType.simpleString() for f in got.schema][:7] == ["bigint"] * 7
    assert rows_of(got) == brute(rows)


def awkward_turns():
    r = random.Random(4)
    rows = [(c, t, r.choice(["user", "assistant"]), "same start" if t == 0 and r.random() < 0.6 else f"t{r.randint(0, 6)}") for c in range(230) for t in range(r.randint(1, 7))]
    rows += [(300, t, "user", f"é𝄞 {t % 50}") for t in range(3000)]  # one very long conversation
    rows += [(301, t, "user", f"é𝄞 {t % 50}") for t in range(1200)]
    rows += [(400, None, "user", "first"), (400, None, None, None), (400, 1, "user", "x" * 300_000), (400, 1, "user", "tie"), (400, 1, "user", "tie"), (400, 1, "assistant", "tie")]
    rows += [(None, 0, "user", "nobody"), (1_000_003, 0, None, ""), (1_000_004, 0, "", None), (-5, 0, "user", "minus"), (-200, 2, "user", "head of minus")]
    rows += [(c, t, "user", "common") for c in range(500, 700) for t in range(3)]
    return rows


@pytest.mark.parametrize("shard", [60, 100_000])
def test_awkward_rows(spark, monkeypatch, shard):
    monkeypatch.setattr(timeforward, "SHARD_NODES", shard)
    monkeypatch.setattr(timeforward.subtree_totals, "__defaults__", (shard,))
    monkeypatch.setattr(trie, "JOINED", 5)
    rows = awkward_turns()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("c", "pos", "path", "depth", "up", "first", "shard", "h1", "size", "head", "ends"):
        df = df.withColumn(name, F.lit("clash"))
    assert rows_of(trie.prefix_trie(df.repartition(5))) == brute(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.prefix_trie(df).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], df.schema)).count() == 0


@pytest.mark.parametrize("shape", ["chain", "star", "scattered"])
def test_totals_of_forests(spark, shape):
    r = random.Random(shape)
    nodes = {}  # (path, depth) -> parent key
    if shape == "chain":
        nodes = {(0, d): (0, d - 1) if d else None for d in range(900)}
    elif shape == "star":
        nodes = {(0, 0): None, (0, 1): (0, 0)} | {(p, 2): (0, 1) for p in range(1, 700)} | {(p, 3): (p, 2) for p in range(5, 300)}
    else:
        nodes, ends = {(0, 0): None, (9, 0): None}, [(0, 0)]
        for p in range(1, 400):
            at = r.choice(ends[-20:] if shape == "random" else ends)
            for d in range(at[1] + 1, at[1] + 1 + r.randint(1, 4)):
                nodes[(p + 10, d)] = at if d == at[1] + 1 else (p + 10, d - 1)
                ends.append((p + 10, d))
    own = {k: (r.randint(0, 3), r.randint(-9, 9)) for k in nodes}
    total = {k: list(v) for k, v in own.items()}
    for k in sorted(nodes, key=lambda k: -k[1]):
        if nodes[k]:
            for i in (0, 1):
                total[nodes[k]][i] += total[k][i]
    df = spark.createDataFrame([(*k, *(up or (None, None)), *own[k], f"note {k}") for k, up in nodes.items()],
                               "path long, depth long, up long, up_depth long, first long, second long, note string")
    got = {(x["path"], x["depth"]): [x["total_first"], x["total_second"]] for x in timeforward.subtree_totals(df, 24).collect()}
    assert got == total


def test_queue_spills_and_merges():
    r = random.Random(1)
    queue, held, got = timeforward.SpillingQueue(most=10, block=3), [], []
    for level in range(50, 0, -1):
        for _ in range(r.randint(0, 40)):
            m = (-level, r.randint(0, 5), r.randint(0, 9), 0, 0, 0, 0)
            queue.put(*m)
            held.append(m)
        for path in range(6):
            got += sorted(queue.take((-level, path)))
    assert got == sorted(held) and not queue.heap and not queue.runs
