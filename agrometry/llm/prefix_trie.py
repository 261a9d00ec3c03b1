"""The trie of conversations' beginnings, with totals of every subtree.

A conversation is a path of turns, written as one fingerprint of 16 bytes a turn; a node is a distinct beginning.

1. A bounded sample gives splitters (path, conv_id), which deal the conversations to shards in the order of their paths.
   As numbers are part of the order, copies of one conversation go to as many shards as they need.
2. A node that lies in several shards begins some splitter's path.  These nodes, the skeleton, are a trie that every
   task knows (broadcast; ``SPLITTER_BYTES`` of paths at most, the longest splitters are left out beyond).
3. Each shard is sorted and read once, with the nodes of the present path on a stack.  A node that is left is finished,
   unless it is of the skeleton: such a node gives one row of partial totals a shard, and the conversations that end
   there as written numbers, in pieces.
4. The partial totals are added up by node, and one task adds them up along the skeleton, whose size is bounded.

Turns are ordered by number (null first), then fingerprint; null roles and texts are empty; repeated rows are turns of
their own; rows without a conv_id are no conversation's; other columns are ignored; an empty table has no node.  A
conversation is one row of some 20 bytes a turn, whatever its texts' length.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrometry.llm.staging import staged

TOKEN = 16
#: Turns of a shard, about, and bounds on the number of shards.
SHARD_TURNS, LEAST_SHARDS, MOST_SHARDS = 1_000_000, 64, 16_384
SAMPLED_PER_SHARD = 20
SPLITTER_BYTES = 8 << 20
_PIECE = 50_000
_LOCAL, _PARTIAL, _ENDS = 0, 1, 2
_ROW = "kind int, node bigint, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, size bigint, ends string"
_TOTAL = "node bigint, parent bigint, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def turns(talks: DataFrame, key: list[str]) -> DataFrame:
    """Rows (key, turns): the turns (mark, size) of each conversation, in order; ``size`` counts bytes of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    mark = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    listed = F.sort_array(F.collect_list(F.struct("turn", mark.alias("mark"), F.octet_length(text).alias("size"))))
    return talks.groupBy(*key).agg(F.transform(listed, lambda t: F.struct(t["mark"].alias("mark"), t["size"].alias("size"))).alias("turns"))


def regrown(talks: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Rows (conv_id, turns): conversations that begin with turns of their family's first one.

    The family of ``c`` are the numbers from ``c - c % family`` on; the first ``crc32(c) % most`` turns are exchanged.
    """
    number = F.col("conv_id").cast("bigint")
    rows = talks.withColumn("conv_id", number).where("conv_id is not null").withColumn("family", number - number % family)
    held = turns(rows.select("family", "conv_id", "turn", "role", "text").repartition("family"), ["family", "conv_id"])
    head = F.max(F.when(F.col("conv_id") == F.col("family"), F.slice("turns", 1, most - 1))).over(Window.partitionBy("family"))
    held = held.withColumn("head", head).withColumn("taken", (F.crc32(F.col("conv_id").cast("string")) % most).cast("int"))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("taken")), F.slice("turns", 1, 0))
    own = F.slice("turns", F.col("taken") + 1, F.greatest(F.size("turns") - F.col("taken"), F.lit(0)))
    return held.select("conv_id", F.concat(head, own).alias("turns"))


def paths(held: DataFrame) -> DataFrame:
    """Rows (conv_id, path, sizes) of conversations given as (conv_id, turns), written to the shared folder."""
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["mark"]), ""))
    return staged(held.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes")), "paths")


def splitters(held: DataFrame) -> list[tuple[bytes, int]]:
    """Some conversations, as (path, conv_id) in order, between which about as many others lie each."""
    count, total = held.agg(F.count("*"), F.sum(F.size("sizes"))).first()
    least = max(LEAST_SHARDS, 4 * held.sparkSession.sparkContext.defaultParallelism)
    shards = min(MOST_SHARDS, max(least, (total or 0) // SHARD_TURNS))
    share = min(1.0, SAMPLED_PER_SHARD * shards / max(count, 1))
    chosen = F.pmod(F.xxhash64("conv_id", F.lit("split")), F.lit(1 << 30)) < int(share * (1 << 30))
    place, whole = F.row_number().over(Window.orderBy("path", "conv_id")), F.count("*").over(Window.partitionBy(F.lit(0)))
    sample = held.where(chosen).select("path", "conv_id", place.alias("place"), whole.alias("n"))
    even = F.floor(F.col("place") * shards / F.col("n")) > F.floor((F.col("place") - 1) * shards / F.col("n"))
    length = F.sum(F.octet_length("path") + TOKEN).over(Window.orderBy(F.octet_length("path"), "path", "conv_id"))
    found = sample.where(even).withColumn("upto", length).where(F.col("upto") <= SPLITTER_BYTES).select("path", "conv_id").toArrow()
    return sorted(zip(found.column("path").to_pylist(), found.column("conv_id").to_pylist()))


def skeleton(splits: list[tuple[bytes, int]]) -> tuple[dict[tuple[int, bytes], int], list[int], list[int]]:
    """Nodes on the splitters' paths: numbers by (parent, turn), and parents and depths by number; 0 is the root."""
    number, parents, depths = {}, [-1], [0]
    for path, _ in splits:
        node = 0
        for at in range(0, len(path), TOKEN):
            step = (node, path[at : at + TOKEN])
            if step not in number:
                number[step] = len(parents)
                parents.append(node)
                depths.append(at // TOKEN + 1)
            node = number[step]
    return number, parents, depths


def _dealer(sent):
    """The shard of each conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits = sent.value[0]
        for batch in batches:
            keys = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist())
            shard = pa.array([bisect_right(splits, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([shard, *batch.columns], ["shard", *batch.schema.names])

    return run


class _Node:
    """A node of the present path; ``known`` is its number in the skeleton."""

    __slots__ = ("known", "size", "n", "low", "children", "leaves", "saved", "ends", "listed", "first", "waiting")

    def __init__(self, known: int | None, size: int):
        self.known, self.size = known, size
        self.n = self.children = self.leaves = self.saved = 0
        self.low = self.ends = self.first = None
        self.listed: list[bytes] = []
        self.waiting: list[tuple] = []


class _Walk:
    """Reads the conversations of a shard in order and writes rows of nodes."""

    def __init__(self, number: dict[tuple[int, bytes], int]):
        self.number, self.rows, self.stack, self.path = number, [], [], b""

    def enter(self, conv_id: int, path: bytes, sizes: list[int]) -> None:
        if not self.stack:
            self.stack, self.path = [_Node(0, 0)], b""
        depth, most = 0, min(len(path), len(self.path)) // TOKEN
        if path[: most * TOKEN] == self.path[: most * TOKEN]:
            depth = most
        else:
            while path[depth * TOKEN : (depth + 1) * TOKEN] == self.path[depth * TOKEN : (depth + 1) * TOKEN]:
                depth += 1
        self.leave(depth + 1)
        for k in range(depth, len(sizes)):
            above = self.stack[-1].known
            known = None if above is None else self.number.get((above, path[k * TOKEN : (k + 1) * TOKEN]))
            self.stack.append(_Node(known, sizes[k]))
        self.path = path
        self.end(self.stack[-1], conv_id)

    def end(self, node: _Node, conv_id: int) -> None:
        """One more conversation ends at a node; they come by number."""
        node.n += 1
        node.low = conv_id if node.low is None else min(node.low, conv_id)
        if node.known is not None:
            node.first = conv_id if node.first is None else node.first
            node.listed.append(b"%d" % conv_id)
            if len(node.listed) >= _PIECE:
                self.write_ends(node)
        elif node.ends is None:
            node.ends = hashlib.sha256(b"%d" % conv_id)
        else:
            node.ends.update(b",%d" % conv_id)

    def write_ends(self, node: _Node) -> None:
        if node.listed:
            self.rows.append((_ENDS, node.known, None, node.first, None, None, None, None, None, None, b",".join(node.listed).decode()))
            node.listed, node.first = [], None

    def leave(self, keep: int) -> None:
        """Finish all nodes but the first ``keep`` of the present path."""
        while len(self.stack) > keep:
            depth = len(self.stack) - 1
            node = self.stack.pop()
            above = self.stack[-1] if self.stack else None
            if above:
                above.n += node.n
                above.low = node.low if above.low is None else min(above.low, node.low)
            if node.known is not None:
                self.write_ends(node)
                self.rows.append((_PARTIAL, node.known, depth, node.low, None, node.n, node.children, node.leaves, node.saved, node.size, None))
                continue
            leaves, saved = node.leaves or 1, node.saved + (node.n - 1) * node.size
            above.children += 1
            above.leaves += leaves
            above.saved += saved
            self.rows += [(_LOCAL, None, depth + 1, low, node.low, *rest) for low, *rest in node.waiting]
            mine = (node.low, node.n, node.children, leaves, saved, None, node.ends.hexdigest() if node.ends else _NO_ENDS)
            if above.known is None:
                above.waiting.append(mine)
            else:
                self.rows.append((_LOCAL, above.known, depth, mine[0], None, *mine[1:]))


def _walker(sent, schema: pa.Schema):
    def rows(walk: _Walk) -> pa.RecordBatch:
        columns = list(zip(*walk.rows))
        walk.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, present = _Walk(sent.value[1]), None
        for batch in batches:
            for shard, *talk in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != present:
                    walk.leave(0)
                    present = shard
                walk.enter(*talk)
                if len(walk.rows) > 20_000:
                    yield rows(walk)
        walk.leave(0)
        if walk.rows:
            yield rows(walk)

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of the pieces of each node, which come one after another."""
    node, state = None, None
    for batch in batches:
        done = []
        for now, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if now == node:
                state.update(b"," + piece.encode())
                continue
            if state:
                done.append((node, state.hexdigest()))
            node, state = now, hashlib.sha256(piece.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["node", "ends_sha256"])
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["node", "ends_sha256"])


def _reducer(sent):
    """Totals along the skeleton, whose nodes have higher numbers than their parents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, parents, depths = sent.value
        held = {node: row for batch in batches for node, *row in zip(*(c.to_pylist() for c in batch.columns))}
        for node in sorted(held, reverse=True):
            row = held[node]
            low, n, children, leaves, saved, size = row
            row[3], row[4] = leaves or 1, saved + (n - 1) * size
            if node:
                above = held[parents[node]]
                above[2] += 1
                above[3] += row[3]
                above[4] += row[4]
        done = [(node, parents[node], depths[node], *held[node][:5]) for node in sorted(held)]
        for at in range(0, len(done), 20_000):
            names = [f.split()[0] for f in _TOTAL.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done[at : at + 20_000])], names)

    return run


def trie(held: DataFrame) -> DataFrame:
    """Rows (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one for each node.

    ``held`` has rows (conv_id, path, sizes), each conv_id once, and is read more than once.
    """
    session = held.sparkSession
    splits = splitters(held)
    number, parents, depths = skeleton(splits)
    sent = session.sparkContext.broadcast((splits, number, parents, depths))
    dealt = held.mapInArrow(_dealer(sent), "shard int, conv_id bigint, path binary, sizes array<int>")
    dealt = dealt.repartition(len(splits) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
    kinds = [pa.field(name, {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[kind]) for name, kind in (f.split() for f in _ROW.split(", "))]
    rows = staged(dealt.mapInArrow(_walker(sent, pa.schema(kinds)), _ROW), "trie")

    added = rows.where(F.col("kind") == _PARTIAL).groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("size").alias("size")
    )
    totals = staged(added.coalesce(1).mapInArrow(_reducer(sent), _TOTAL), "skeleton")
    pieces = rows.where(F.col("kind") == _ENDS).select("node", "conv_id", "ends").repartition("node").sortWithinPartitions("node", "conv_id")
    ends = pieces.select("node", "ends").mapInArrow(_hashed, "node bigint, ends_sha256 string")
    above = F.broadcast(totals.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_low")))
    columns = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    spanning = totals.join(above, "parent", "left").join(ends, "node", "left").select(
        "conv_id", "depth", F.col("parent_low").alias("parent_conv_id"), *columns, F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256")
    )
    local = rows.where(F.col("kind") == _LOCAL).withColumnRenamed("node", "parent").join(above, "parent", "left")
    return spanning.union(local.select("conv_id", "depth", F.coalesce("parent_conv_id", "parent_low"), *columns, "ends"))


def sql() -> str:
    """The trie of the regrown conversations for DuckDB: paths as strings, subtrees by their beginnings."""
    from agrometry.llm.checksums import CRC_TABLE, crc_of

    return f"""
WITH {CRC_TABLE}, said AS (
    SELECT conv_id, text, mark, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) - 1 AS k
    FROM (SELECT conv_id, turn, coalesce(text, '') AS text, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark
        FROM conversations WHERE conv_id IS NOT NULL)
), talk AS (SELECT conv_id, count(*) AS n FROM said GROUP BY conv_id),
planned AS (
    SELECT t.conv_id, t.conv_id - t.conv_id % 5 AS base, {crc_of("t.conv_id")} % 9 AS h, coalesce(b.n, 0) AS held
    FROM crc, talk t LEFT JOIN talk b ON b.conv_id = t.conv_id - t.conv_id % 5
), built AS (
    SELECT p.conv_id, k, text, mark FROM planned p JOIN said s ON s.conv_id = p.base AND k < h
    UNION ALL SELECT p.conv_id, least(h, held) + k - h, text, mark FROM planned p JOIN said s ON s.conv_id = p.conv_id AND k >= h
), member AS (
    SELECT conv_id, k + 1 AS depth, strlen(text) AS bytes, string_agg(mark, '') OVER (PARTITION BY conv_id ORDER BY k) AS path FROM built
    UNION ALL SELECT conv_id, 0, 0, '' FROM planned
), ending AS (
    SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends
    FROM (SELECT conv_id, max(depth) AS depth, arg_max(path, depth) AS path FROM member GROUP BY conv_id) GROUP BY path
), node AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n, any_value(bytes) AS bytes FROM member GROUP BY path, depth),
above AS (SELECT *, left(path, 32 * (depth - 1)::INTEGER) AS up FROM node WHERE depth > 0),
child AS (SELECT up AS path, count(*) AS n_children FROM above GROUP BY up),
part AS (
    SELECT left(path, (32 * a)::INTEGER) AS path, sum((n - 1) * bytes) AS saved, count(*) FILTER (n_children IS NULL) AS leaves
    FROM (SELECT path, n, bytes, n_children, unnest(range(depth + 1)) AS a FROM node LEFT JOIN child USING (path)) GROUP BY 1
)
SELECT node.conv_id, node.depth, parent.conv_id AS parent_conv_id, node.n AS n_convs, coalesce(n_children, 0) AS n_children,
    leaves AS n_leaves, saved::BIGINT AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM node LEFT JOIN above USING (path) LEFT JOIN node parent ON parent.path = above.up
LEFT JOIN child ON child.path = node.path JOIN part ON part.path = node.path LEFT JOIN ending ON ending.path = node.path
"""
