"""Subtree totals of a forest by time-forward processing, shard by shard.

A node has a key (path, depth) and its parent's key (up, up_depth), which is
lower in that order and of less depth.  Nodes are dealt over shards by ranges
of their key; a shard is sorted externally into reverse level order, and every
node sends its total to its parent through a priority queue that spills sorted
runs.  A message is one total and at most one node, however many nodes lie
below.

What leaves a shard: nodes with children in other shards are keys, and so is a
node at which the ways up from two keys meet.  The keys of all shards form a
tree of their own, each with the sum of what lies below it and below no lower
key.  That tree's totals are found in the same way; a last pass over the shards
starts from them.  No shard grows with the input beyond ``SHARDS`` shards, and
no node, however many children it has, needs more than its running sums.
"""

from __future__ import annotations

import heapq
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Nodes of a shard, while there are fewer than SHARDS shards.
SHARD_NODES = 16_384
SHARDS = 20_000
#: Messages that a queue holds in memory.
IN_MEMORY = 200_000
_WIDTH = 7


class SpillingQueue:
    """Messages (-depth, path, first, second, has node, node's path, node's depth) by their first two values.

    Beyond ``most`` messages, the queue writes what it holds as a sorted run to
    an unnamed file of its own task; taking merges the runs block by block.
    """

    def __init__(self, most: int = IN_MEMORY, block: int = 4096):
        self.most, self.block, self.heap, self.runs, self.file = most, block, [], [], None

    def put(self, *message: int) -> None:
        if len(self.heap) >= self.most:
            self._spill()
        heapq.heappush(self.heap, message)

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.heap.sort()
        start = self.file.seek(0, 2)
        for lo in range(0, len(self.heap), self.block):
            self.file.write(np.array(self.heap[lo:lo + self.block], "<i8").tobytes())
        run = self._read(start, len(self.heap))
        heapq.heappush(self.runs, (next(run), len(self.runs), run))
        self.heap = []

    def _read(self, start: int, n: int):
        for lo in range(0, n, self.block):
            self.file.seek(start + lo * _WIDTH * 8)
            rows = np.frombuffer(self.file.read(min(self.block, n - lo) * _WIDTH * 8), "<i8").reshape(-1, _WIDTH)
            yield from map(tuple, rows.tolist())

    def take(self, key: tuple[int, int]):
        """All messages of a key, which must be the least one left."""
        while self.runs and self.runs[0][0][:2] == key:
            message, k, run = self.runs[0]
            yield message
            following = next(run, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, k, run))
        while self.heap and self.heap[0][:2] == key:
            yield heapq.heappop(self.heap)


def _in_order(batches, names):
    """(shard, rows) in the order of the batches: a new queue for each shard, and each batch's columns as lists."""
    shard, queue = None, None
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names]
        for row in zip(*columns):
            if row[0] != shard:
                shard, queue = row[0], SpillingQueue()
            yield queue, row[1:]


def _contract(batches):
    """The keys of each shard, with what lies below them: path, depth, up, up_depth, first, second."""
    out = [[] for _ in range(6)]

    def emit(*row):
        for column, value in zip(out, row):
            column.append(value)

    def batch():
        got = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["path", "depth", "up", "up_depth", "first", "second"])
        for c in out:
            c.clear()
        return got

    for queue, (path, depth, up, up_depth, first, second, away, mark) in _in_order(batches, ["shard", "path", "depth", "up", "up_depth", "first", "second", "away", "mark"]):
        key, node = bool(mark), None
        for _, _, a, b, has, node_path, node_depth in queue.take((-depth, path)):
            first, second = first + a, second + b
            if has:
                if node is not None:
                    key = True
                    emit(*node, path, depth, 0, 0)
                node = node_path, node_depth
        if key:
            if node is not None:
                emit(*node, path, depth, 0, 0)
            emit(path, depth, None, None, first, second)
            first, second, node = 0, 0, (path, depth)
        if up is None:
            continue  # the top of a tree: what leads here has no key above
        if away:
            if node is not None:
                emit(*node, up, up_depth, 0, 0)
            emit(up, up_depth, None, None, first, second)
        else:
            queue.put(-up_depth, up, first, second, int(node is not None), *(node or (0, 0)))
        if len(out[0]) >= 10_000:
            yield batch()
    if out[0]:
        yield batch()


def _totals(schema):
    names = [f.name for f in schema if f.name not in ("total_first", "total_second")]

    def run(batches):
        for batch in batches:
            yield from one(batch)

    state = {"shard": None, "queue": None}

    def one(batch):
        firsts, seconds = [], []
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist()
                   for c in ("shard", "path", "depth", "up", "up_depth", "first", "second", "away", "known_first", "known_second")]
        for shard, path, depth, up, up_depth, first, second, away, known_first, known_second in zip(*columns):
            if shard != state["shard"]:
                state["shard"], state["queue"] = shard, SpillingQueue()
            queue = state["queue"]
            for message in queue.take((-depth, path)):
                first, second = first + message[2], second + message[3]
            if known_first is not None:
                first, second = known_first, known_second
            firsts.append(first), seconds.append(second)
            if up is not None and not away:
                queue.put(-up_depth, up, first, second, 0, 0, 0)
        yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), pa.array(firsts, pa.int64()), pa.array(seconds, pa.int64())],
                                         [*names, "total_first", "total_second"])

    return run


def subtree_totals(nodes: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """Nodes (path, depth, up, up_depth, first, second: longs, and more columns) -> the same with total_first and
    total_second, the sums of first and second over each node's subtree.

    Tops of trees have a null ``up``.  Keys are unique, every parent is there.
    """
    n = nodes.count()
    shards = -(-n // max(shard_nodes, -(-n // SHARDS), 1))
    dealt = written(nodes.repartitionByRange(max(shards, 1), "path", "depth").withColumn("shard", F.spark_partition_id()), "shards")
    order = [F.col("shard"), F.col("depth").desc(), F.col("path")]
    result = [f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema] + ["total_first long", "total_second long"]
    out = nodes.sparkSession.createDataFrame([], ", ".join(result)).schema
    if shards <= 1:
        ready = dealt.withColumns({"away": F.lit(False), "known_first": F.lit(None).cast("long"), "known_second": F.lit(None).cast("long")})
    else:
        low = dealt.groupBy("shard").agg(F.min(F.struct("path", "depth")).alias("low"))  # a row per shard
        cross = dealt.join(F.broadcast(low), "shard").withColumn("away", F.coalesce(F.struct(F.col("up"), F.col("up_depth")) < F.col("low"), F.lit(False))).drop("low")
        marks = written(cross.where("away").select(F.col("up").alias("path"), F.col("up_depth").alias("depth")).distinct(), "marks").withColumn("mark", F.lit(True))
        slim = cross.select("shard", "path", "depth", "up", "up_depth", "first", "second", "away").join(marks, ["path", "depth"], "left")
        found = (slim.repartition(shards, "shard").sortWithinPartitions(*order)
                 .mapInArrow(_contract, "path long, depth long, up long, up_depth long, first long, second long"))
        keys = written(found.groupBy("path", "depth").agg(*(F.max(c).alias(c) for c in ("up", "up_depth")), *(F.sum(c).alias(c) for c in ("first", "second"))), "keys")
        # Keys that don't get fewer (nodes scattered over all shards) go to larger shards.
        solved = subtree_totals(keys, shard_nodes if keys.count() * 4 < n else 4 * shard_nodes)
        known = written(solved.select("path", "depth", F.col("total_first").alias("known_first"), F.col("total_second").alias("known_second")), "known")
        ready = cross.join(known, ["path", "depth"], "left")
    return ready.repartition(max(shards, 1), "shard").sortWithinPartitions(*order).mapInArrow(_totals(out), out)
