"""Conversation prefix trie: shared beginnings of rebuilt conversations, with totals per node.

Every conversation c is rebuilt: the first h turns of conversation c - c % 100,
h = crc32(decimal c) % 6, then its own turns after its first h.  A node is a
distinct sequence of first turns (role, text) of rebuilt conversations; nodes
are known by their depth and two polynomial hashes (modulo 2^61 - 1) of their
turns' digests.  Such hashes of pieces can be put together, so a conversation
of any length is hashed in slices by many tasks, and a conversation that starts
with another's turns never repeats that other's work.

A node's key in the result is its least member and its depth, and those of one
least member lie on one way down; ``timeforward`` sums leaves and saved tokens
over all subtrees along them.

The digest of the members that end at a node is one SHA-256, serial as such:
sorted ranges of ids are joined to texts by many tasks, and each node's texts
are then fed to the hash one by one, never held together.

Defined cases: rows with a null conv_id belong to no conversation and go; null
role or text is empty; turns that tie (equal or null) come by role, then by the
digest of role and text, and repeated rows stay; an empty table has no nodes;
extra columns are ignored.  ``c % 100`` has the sign of c.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .timeforward import subtree_totals

GROUP = 100
MOST_HEAD = 5
_P = (1 << 61) - 1
_BASES = (0x1B873593CC9E2D51 % _P, 0x0F4A7C159E3779B9 % _P)
_BACK = tuple(pow(b, -1, _P) for b in _BASES)
#: Ids joined to one text before they are hashed.
JOINED = 8192


def _digest(part: int) -> Column:
    both = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    return F.conv(F.substring(both, 1 + 16 * part, 15), 16, 10).cast("long")


def _slices(batches):
    """Hashes of the turns of a conversation from its first row in this task on."""
    task, now, n, s = TaskContext.get().partitionId(), None, 0, [0, 0]
    for batch in batches:
        c, t1, t2 = (batch.column(i).to_pylist() for i in range(3))
        pos, s1, s2 = [], [], []
        for a, x, y in zip(c, t1, t2):
            if a != now:
                now, n, s = a, 0, [0, 0]
            n += 1
            s = [(s[0] * _BASES[0] + x) % _P, (s[1] * _BASES[1] + y) % _P]
            pos.append(n), s1.append(s[0]), s2.append(s[1])
        long = pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array([task] * len(c), pa.int32()), batch.column(0), pa.array(pos, long), pa.array(s1, long), pa.array(s2, long),
                                          batch.column(1), batch.column(2), batch.column(3)], ["task", "c", "pos", "s1", "s2", "t1", "t2", "size"])


def _before(batches):
    """For each slice of a conversation, turns and hashes of the slices before it."""
    for batch in batches:
        out = [[] for _ in range(5)]
        for c, slices in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            off, o = 0, [0, 0]
            for s in slices:
                for column, value in zip(out, (c, s["task"], off, *o)):
                    column.append(value)
                off += s["n"]
                o = [(o[k] * pow(_BASES[k], s["n"], _P) + s[f"e{k + 1}"]) % _P for k in (0, 1)]
        long = pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int32() if k == 1 else long) for k, v in enumerate(out)], ["c", "task", "off", "o1", "o2"])


def _shifted(batches):
    """s + o * base ^ pos for both hashes; pos moves by off."""
    for batch in batches:
        get = lambda name: batch.column(batch.schema.get_field_index(name)).to_pylist()
        s = [get("s1"), get("s2")]
        for i, (off, o1, o2, pos) in enumerate(zip(get("off"), get("o1"), get("o2"), get("pos"))):
            if off:
                s[0][i] = (s[0][i] + o1 * pow(_BASES[0], pos, _P)) % _P
                s[1][i] = (s[1][i] + o2 * pow(_BASES[1], pos, _P)) % _P
        pos = np.array(get("pos"), np.int64) + np.array([x or 0 for x in get("off")], np.int64)
        long = pa.int64()
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("c")), pa.array(pos), pa.array(s[0], long), pa.array(s[1], long),
                                          *(batch.column(batch.schema.get_field_index(x)) for x in ("t1", "t2", "size"))], ["c", "pos", "s1", "s2", "t1", "t2", "size"])


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(c, pos from 1, s1, s2 of the first pos turns, t1, t2 and code points of the last) of every turn."""
    spark = turns.sparkSession
    rows = turns.select(F.col("conv_id").cast("long").alias("c"), F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("c is not null")
    rows = rows.select("c", "turn", "role", _digest(0).alias("t1"), _digest(1).alias("t2"), F.length("text").cast("long").alias("size"))
    order = [F.col("c"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("t1"), F.col("t2")]
    ranged = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order).select("c", "t1", "t2", "size")
    cut = written(ranged.mapInArrow(_slices, "task int, c long, pos long, s1 long, s2 long, t1 long, t2 long, size long"), "slices")
    # A conversation lies in several tasks only where ranges meet: at most two rows a task are left here.
    ends = cut.groupBy("c", "task").agg(F.max("pos").alias("n"), F.max_by(F.struct("s1", "s2"), "pos").alias("e"))
    many = (ends.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("task", "n", F.col("e.s1").alias("e1"), F.col("e.s2").alias("e2")))).alias("slices"))
            .where(F.size("slices") > 1))
    before = written(many.mapInArrow(_before, "c long, task int, off long, o1 long, o2 long"), "before")
    return cut.join(F.broadcast(before), ["c", "task"], "left").mapInArrow(_shifted, "c long, pos long, s1 long, s2 long, t1 long, t2 long, size long")


def _nodes_of(batches):
    """A member's node and that node's parent, from the own hash moved behind the head."""
    for batch in batches:
        get = lambda name: batch.column(batch.schema.get_field_index(name)).to_pylist()
        own = [[], [], [], []]
        for k in (0, 1):
            base, back = _BASES[k], _BACK[k]
            for s, t, a, b, e in zip(get(f"s{k + 1}"), get(f"t{k + 1}"), get(f"a{k + 1}"), get(f"b{k + 1}"), get("e")):
                h = (s + (b - a) * pow(base, e, _P)) % _P if a != b else s
                own[k].append(h), own[2 + k].append((h - t) * back % _P)
        yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(x)) for x in ("c", "depth")), *(pa.array(x, pa.int64()) for x in own),
                                          *(batch.column(batch.schema.get_field_index(x)) for x in ("size", "ends"))], ["c", "depth", "h1", "h2", "g1", "g2", "size", "ends"])


def members(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rebuilt conversations: c, total turns; a row per conversation and node on its way, without the root)."""
    rows = written(prefix_hashes(turns), "prefixes")
    h = F.crc32(F.col("c").cast("string")) % (MOST_HEAD + 1)
    mine = rows.groupBy("c").agg(F.max("pos").alias("n"), F.max(F.when(F.col("pos") == h, F.struct("s1", "s2"))).alias("at"))
    heads = (rows.where((F.col("c") % GROUP == 0) & (F.col("pos") <= MOST_HEAD)).groupBy(F.col("c").alias("head_of"))
             .agg(F.sort_array(F.collect_list(F.struct("pos", "s1", "s2", "t1", "t2", "size"))).alias("head")))
    zero = F.lit(0).cast("long")
    info = mine.withColumn("h", h).join(heads, F.col("c") - F.col("c") % GROUP == F.col("head_of"), "left")
    info = info.withColumn("head", F.when(F.col("head").isNull() | (F.col("h") == 0), F.slice("head", 1, 0)).otherwise(F.slice("head", 1, F.col("h").cast("int"))))
    info = info.withColumn("hh", F.coalesce(F.when(F.col("head").isNotNull(), F.size("head").cast("long")), zero))
    last = F.when(F.col("hh") > 0, F.element_at("head", F.greatest(F.col("hh"), F.lit(1)).cast("int")))
    info = written(info.select("c", "h", "hh", "head", (F.col("hh") + F.greatest(F.col("n") - F.col("h"), zero)).alias("total"),
                               F.coalesce("at.s1", zero).alias("a1"), F.coalesce("at.s2", zero).alias("a2"),
                               F.coalesce(last["s1"], zero).alias("b1"), F.coalesce(last["s2"], zero).alias("b2")), "rebuilt")
    taken = info.select("c", "total", F.explode("head").alias("x")).select(
        "c", F.col("x.pos").alias("depth"), "x.s1", "x.s2", "x.t1", "x.t2", zero.alias("a1"), zero.alias("a2"), zero.alias("b1"), zero.alias("b2"), zero.alias("e"),
        "x.size", (F.col("x.pos") == F.col("total")).alias("ends"))
    rest = rows.where(F.col("pos") > h).join(info.drop("head"), "c").select(
        "c", (F.col("hh") + F.col("pos") - F.col("h")).alias("depth"), "s1", "s2", "t1", "t2", "a1", "a2", "b1", "b2", (F.col("pos") - F.col("h")).alias("e"),
        "size", (F.col("hh") + F.col("pos") - F.col("h") == F.col("total")).alias("ends"))
    found = taken.unionAll(rest).mapInArrow(_nodes_of, "c long, depth long, h1 long, h2 long, g1 long, g2 long, size long, ends boolean")
    return info.select("c", "total"), written(found, "members")


def _joined(batches):
    """Texts of comma-joined ids, in order: node, first id, text."""
    node, ids, first = None, [], None

    def row():
        return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in (*node, first)), pa.array([",".join(map(str, ids)).encode()])], ["depth", "h1", "h2", "first", "ids"])

    held = []
    for batch in batches:
        for *own, c in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if own != node or len(ids) >= JOINED:
                if ids:
                    held.append(row())
                    if len(held) >= 1000:
                        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                        held = []
                node, ids, first = own, [], c
            ids.append(c)
    if ids:
        held.append(row())
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _hashed(batches):
    """SHA-256 of a node's texts, joined by commas; the rows of a node follow each other."""
    node, digest, out = None, None, []

    def batch():
        columns = list(zip(*out))
        out.clear()
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3])], ["depth", "h1", "h2", "sha"])

    for got in batches:
        for *own, ids in zip(*(got.column(i).to_pylist() for i in (0, 1, 2, 4))):
            if own != node:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = own, hashlib.sha256(ids)
            else:
                digest.update(b"," + ids)
        if len(out) >= 10_000:
            yield batch()
    if node is not None:
        out.append((*node, digest.hexdigest()))
    if out:
        yield batch()


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, h1, h2, c) -> (depth, h1, h2, sha) over the ascending ids of each node."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["depth", "h1", "h2", "c"]
    texts = ends.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_joined, "depth long, h1 long, h2 long, first long, ids binary")
    return (texts.repartition("depth", "h1", "h2").sortWithinPartitions("depth", "h1", "h2", "first")
            .mapInArrow(_hashed, "depth long, h1 long, h2 long, sha string"))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rebuilt, way = members(turns)
    top = rebuilt.agg(F.min("c").alias("c"), F.count("*").alias("n")).first()
    schema = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    if not top["n"]:
        return turns.sparkSession.createDataFrame([], schema)
    key = ["depth", "h1", "h2"]
    below = written(way.groupBy(*key).agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), *(F.max(x).alias(x) for x in ("size", "g1", "g2"))), "nodes")
    parent = below.select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("conv_id").alias("up"))
    deep = below.where("depth > 1").join(parent, ["depth", "g1", "g2"])
    first = below.where("depth = 1").withColumn("up", F.lit(top["c"]).cast("long"))
    names = [*key, "conv_id", "up", "n_convs", "size"]
    root = turns.sparkSession.range(1).select(*(F.lit(v).cast("long").alias(c) for c, v in zip(names, (0, 0, 0, top["c"], None, top["n"], 0))))
    tree = written(deep.select(*names).unionAll(first.select(*names)).unionAll(root), "tree")
    kids = tree.where("up is not null").groupBy(F.col("up").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = tree.join(kids, ["conv_id", "depth"], "left").fillna(0, ["n_children"])
    ready = written(nodes.select(F.col("conv_id").alias("path"), "depth", "up", F.when(F.col("up").isNotNull(), F.col("depth") - 1).alias("up_depth"),
                                 (F.col("n_children") == 0).cast("long").alias("first"), ((F.col("n_convs") - 1) * F.col("size")).alias("second"),
                                 "h1", "h2", "n_convs", "n_children"), "ready")
    totals = subtree_totals(ready)
    zero = F.lit(0).cast("long")
    ends = way.where("ends").select(*key, "c").unionAll(rebuilt.where("total = 0").select(*(zero.alias(c) for c in key), "c"))
    empty = hashlib.sha256(b"").hexdigest()
    return totals.join(end_digests(ends), key, "left").select(
        F.col("path").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), "n_convs", "n_children", F.col("total_first").alias("n_leaves"),
        F.col("total_second").alias("saved_tokens"), F.coalesce("sha", F.lit(empty)).alias("ends_sha256"))


#: The same rows by texts instead of hashes, every node joined to all nodes above it.
ORACLE = """
with crc as (
  select distinct conv_id c, cast(conv_id as varchar) s from conversations where conv_id is not null
), h as (
  select c, xor(list_reduce(list_concat([4294967295::bigint], list_transform(range(0, 8 * len(s)), lambda i: i::bigint)),
    lambda a, i: xor(xor(a, case when i % 8 = 0 then ascii(s[(i // 8 + 1)::int])::bigint else 0::bigint end) >> 1,
                     3988292384::bigint * (xor(a, case when i % 8 = 0 then ascii(s[(i // 8 + 1)::int])::bigint else 0::bigint end) & 1))), 4294967295::bigint) % 6 h
  from crc
), own as (
  select c, row_number() over (partition by c order by turn nulls first, role, t) pos, t, size
  from (select conv_id c, turn, coalesce(role, '') as role, md5(coalesce(length(role), 0) || ':' || coalesce(role, '') || coalesce(text, '')) t,
          coalesce(length(text), 0) size from conversations where conv_id is not null)
), rebuilt as (
  select h.c, own.pos d, own.t, own.size from h join own on own.c = h.c - h.c % 100 and own.pos <= h.h
  union all
  select h.c, own.pos - h.h + (select count(*) from own o where o.c = h.c - h.c % 100 and o.pos <= h.h), own.t, own.size
  from h join own on own.c = h.c and own.pos > h.h
), way as (
  select c, d, size, md5(string_agg(t, '' ) over (partition by c order by d)) k from rebuilt
  union all
  select c, 0, 0, 'root' from h
), node as (
  select d, k, min(c) conv_id, count(*) n, max(size) size from way group by d, k
), edge as (
  select node.d, node.k, min(up.k) up from node join way own on own.c = node.conv_id and own.d = node.d join way up on up.c = own.c and up.d = own.d - 1
  group by node.d, node.k
), kids as (
  select d - 1 d, up k, count(*) n from edge group by 1, 2
), below as (
  select way.d, way.k, sum((node.n - 1) * node.size) saved, count(*) filter (where kids.n is null) leaves
  from node left join kids using (d, k) join way on way.c = node.conv_id and way.d <= node.d group by way.d, way.k
), ends as (
  select d, k, string_agg(cast(c as varchar), ',' order by c) ids from (select c, max(d) d, arg_max(k, d) k from way group by c) group by d, k
)
select node.conv_id, node.d::bigint as depth, up.conv_id as parent_conv_id, node.n as n_convs, coalesce(kids.n, 0) as n_children, below.leaves as n_leaves,
  below.saved::bigint as saved_tokens, sha256(coalesce(ends.ids, '')) as ends_sha256
from node join below using (d, k) left join kids using (d, k) left join ends using (d, k) left join edge using (d, k)
left join node up on up.d = node.d - 1 and up.k = edge.up
"""
