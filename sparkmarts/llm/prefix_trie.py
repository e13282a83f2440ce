"""The trie of all conversations' prefixes, by a skeleton of splitter paths and local sorted shards.

A path is a conversation's sequence of turns, each by a 128-bit digest of its role and text. A node is a distinct prefix
of paths; its members are the conversations that start with it.

1. Splitters, pairs of a path and an id, cut the rows ordered by (path, id) into shards of about the same number of
   rows. They are picked from a sample, which decides about balance alone. Copies of one path, or paths with one first
   turn, are cut like all others, by what follows and by their ids.
2. A node can have members in two shards only if it is a prefix of a splitter. These nodes, the skeleton, are what
   every task is sent. A splitter is cut to its share of SKELETON_BYTES, so their number is bounded whatever the paths'
   lengths (a cut splitter is a splitter like any other).
3. Each shard is sorted and read once with a stack of open nodes. A node outside the skeleton is finished when the path
   leaves it; a skeleton node gives its partial aggregates.
4. The partial aggregates of a skeleton node are reduced over shards and then, from the deepest node up, over the
   skeleton. Ids that end at a skeleton node are hashed in the order of shards from pieces.

Paths and sizes are moved, never texts. Rows of one conversation are grouped, 20 bytes a turn; a conversation is one row
from then on and has to fit into a task, as do the children of a node within one shard.

Defined cases: rows without a conv_id belong to no conversation; null role or text is empty; a null turn comes first;
rows with equal turns are ordered by their digest, so repeated rows count as turns; the root of no turns has all
conversations as members; an empty table gives no node; other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_tasks, written

DIGEST = 16  # bytes of a turn
SKELETON_BYTES = 1 << 22  # of all splitters together, so at most 262,144 skeleton nodes
SAMPLE_PER_SHARD = 32
PIECE_IDS = 4096  # ids of a skeleton node in one row
ROWS = 10_000  # of nodes in a batch

NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string"
)
NODE_COLUMNS = [field.split()[0] for field in NODE.split(", ")]
# A finished node has `above` where its parent is in the skeleton. A part of a skeleton node has `skeleton` and `bytes`
# (of its last text), a piece of the ids that end there has `skeleton`, shard, piece and ids.
LOCAL = pa.schema(
    [pa.field(name, pa.string() if name == "ends_sha256" else pa.int64()) for name in NODE_COLUMNS]
    + [pa.field(name, pa.int64()) for name in ("above", "skeleton", "bytes", "shard", "piece")]
    + [pa.field("ids", pa.binary())]
)
LOCAL_SQL = f"{NODE}, above bigint, skeleton bigint, bytes bigint, shard bigint, piece bigint, ids binary"


# ---------------------------------------------------------------- paths


def turns(rows: DataFrame) -> DataFrame:
    """Per conversation: conv_id and its turns in order, each with a digest and the bytes of its text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    # The length of the role keeps ("a", "bc") and ("ab", "c") apart.
    digest = F.substring(F.unhex(F.sha2(F.concat_ws(":", F.length(role), role, text), 256)), 1, DIGEST)
    each = F.struct(F.col("turn"), digest.alias("digest"), F.octet_length(text).alias("bytes"))
    ordered = F.transform(F.sort_array(F.collect_list(each)), lambda t: F.struct(t["digest"], t["bytes"]))
    return rows.filter("conv_id is not null").groupBy("conv_id").agg(ordered.alias("turns"))


def paths(conversations: DataFrame) -> DataFrame:
    """conv_id, path (the digests in a row) and bytes of each turn's text; from conv_id and turns."""
    # A list of binary values is joined as text in hexadecimal, which orders as the bytes do.
    joined = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    sizes = F.transform("turns", lambda t: t["bytes"])
    return conversations.select("conv_id", joined.alias("path"), sizes.alias("bytes"))


# ---------------------------------------------------------------- splitters and skeleton


Splitter = tuple[bytes, int]


def splitters(rows: DataFrame, shards: int) -> list[Splitter]:
    """Fewer than `shards` pairs of a path, cut to its share of the bytes, and an id, in order."""
    share = SKELETON_BYTES // shards // DIGEST * DIGEST
    every = max(1, rows.count() // (shards * SAMPLE_PER_SHARD))
    sample = rows.filter(F.pmod(F.xxhash64("conv_id"), F.lit(every)) == 0)
    key = F.struct(F.substring("path", 1, share).alias("path"), "conv_id")
    # One task orders the sample, whose size depends on the number of shards alone.
    dealt = sample.select(key.alias("key")).select("key", F.ntile(shards).over(Window.orderBy("key")).alias("shard"))
    first = dealt.filter("shard > 1").groupBy("shard").agg(F.min("key").alias("key"))
    return sorted((bytes(r["key"]["path"]), r["key"]["conv_id"]) for r in first.collect())


class Skeleton:
    """The nodes of the splitters' paths, numbered so that a parent comes before its children; 0 is the root."""

    def __init__(self, cuts: list[Splitter]):
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent = [-1]
        for path, _ in cuts:
            at = 0
            for i in range(0, len(path), DIGEST):
                step = (at, path[i : i + DIGEST])
                if step not in self.child:
                    self.child[step] = len(self.parent)
                    self.parent.append(at)
                at = self.child[step]


def _dealt(cuts: list[Splitter]):
    def run(batches):
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)
            yield batch.append_column("shard", pa.array([bisect.bisect_right(cuts, key) for key in keys], pa.int32()))

    return run


# ---------------------------------------------------------------- local shards


class _Node:
    __slots__ = ("bytes", "skeleton", "low", "members", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, bytes: int, skeleton: int | None):
        self.bytes, self.skeleton = bytes, skeleton
        self.low: int | None = None
        self.members = self.children = self.leaves = self.saved = 0
        self.ends = None if skeleton is None else []  # a hash, or for a skeleton node the ids of the next piece
        self.waiting: list[list] = []  # finished children, which still need this node's smallest member


_NO_ENDS = hashlib.sha256().hexdigest()


class _Shard:
    """Takes the conversations of one shard in order; `rows` collects what is known of its nodes."""

    def __init__(self, number: int, skeleton: Skeleton):
        self.number, self.skeleton = number, skeleton
        self.stack, self.path = [_Node(0, 0)], b""
        self.rows: list[list] = []
        self.pieces = 0

    def add(self, conv: int, path: bytes, sizes: list[int]) -> None:
        if path != self.path:
            self._move(path, sizes)
        node = self.stack[-1]
        self._count(node, conv, 1)
        text = b"%d" % conv
        if node.skeleton is not None:
            node.ends.append(text)
            if len(node.ends) == PIECE_IDS:
                self._give_ids(node)
        elif node.ends is None:
            node.ends = hashlib.sha256(text)
        else:
            node.ends.update(b"," + text)

    def finish(self) -> None:
        while self.stack:
            self._close()

    def _move(self, path: bytes, sizes: list[int]) -> None:
        """Closes the nodes that are no prefix of the path and opens those that it adds."""
        shared, most = 0, min(len(path), len(self.path))
        while shared < most and self.path[shared : shared + DIGEST] == path[shared : shared + DIGEST]:
            shared += DIGEST
        while len(self.stack) - 1 > shared // DIGEST:
            self._close()
        for i in range(shared, len(path), DIGEST):
            above = self.stack[-1].skeleton
            known = None if above is None else self.skeleton.child.get((above, path[i : i + DIGEST]))
            self.stack.append(_Node(sizes[i // DIGEST], known))
        self.path = path

    @staticmethod
    def _count(node: _Node, low: int, members: int) -> None:
        node.members += members
        node.low = low if node.low is None else min(node.low, low)

    def _give_ids(self, node: _Node) -> None:
        if node.ends:
            ids = b",".join(node.ends)
            self.rows.append([None] * len(NODE_COLUMNS) + [None, node.skeleton, None, self.number, self.pieces, ids])
            self.pieces += 1
            node.ends = []

    def _close(self) -> None:
        node = self.stack.pop()
        above = self.stack[-1] if self.stack else None
        if above is not None:
            self._count(above, node.low, node.members)
        if node.skeleton is not None:
            self._give_ids(node)
            part = [node.low, len(self.stack), None, node.members, node.children, node.leaves, node.saved, None]
            self.rows.append([*part, None, node.skeleton, node.bytes, None, None, None])
            return
        leaves, saved = node.leaves or 1, node.saved + (node.members - 1) * node.bytes
        for child in node.waiting:
            child[2] = node.low
        self.rows += node.waiting
        ends = node.ends.hexdigest() if node.ends else _NO_ENDS
        row = [node.low, len(self.stack), None, node.members, node.children, leaves, saved, ends]
        row += [above.skeleton, None, None, None, None, None]
        (above.waiting if above.skeleton is None else self.rows).append(row)
        above.children += 1
        above.leaves += leaves
        above.saved += saved


def _batch(rows: list[list]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, LOCAL, strict=True)], schema=LOCAL)


def _local(cuts: list[Splitter]):
    def run(batches):
        skeleton, shard, rows = Skeleton(cuts), None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("shard", "conv_id", "path", "bytes"))
            for number, conv, path, sizes in zip(*columns, strict=True):
                if shard is None or shard.number != number:
                    if shard is not None:
                        shard.finish()
                    shard = _Shard(number, skeleton)
                    shard.rows = rows  # all shards of a task give into one list
                shard.add(conv, path, sizes)
                if len(rows) >= ROWS:
                    yield _batch(rows)
                    rows.clear()
        if shard is not None:
            shard.finish()
        for i in range(0, len(rows), ROWS):
            yield _batch(rows[i : i + ROWS])

    return run


# ---------------------------------------------------------------- reduction over the skeleton


def _hashed(batches):
    """One hash of each skeleton node's pieces, which come in order."""
    at, state, found = None, None, []
    for batch in batches:
        for skeleton, ids in zip(batch.column("skeleton").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if skeleton != at:
                if state:
                    found.append((at, state.hexdigest()))
                at, state = skeleton, hashlib.sha256(ids)
            else:
                state.update(b"," + ids)
    if state:
        found.append((at, state.hexdigest()))
    columns = [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())]
    yield pa.RecordBatch.from_arrays(columns, names=["skeleton", "ends"])


def _reduced(local: DataFrame, skeleton: Skeleton) -> list[tuple]:
    """Rows of the skeleton's nodes, with their number, from the sums over shards; from the deepest node up."""
    parts = local.filter("skeleton IS NOT NULL AND piece IS NULL").groupBy("skeleton")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    parts = parts.agg(F.min("conv_id").alias("low"), F.max("depth").alias("depth"), F.max("bytes").alias("bytes"), *sums)
    nodes = {r["skeleton"]: r.asDict() for r in parts.collect()}  # at most the skeleton's number of rows
    for at in sorted(nodes, reverse=True):
        node = nodes[at]
        node["n_leaves"] = node["n_leaves"] or 1
        node["saved_tokens"] += (node["n_convs"] - 1) * node["bytes"]
        if at:
            above = nodes[skeleton.parent[at]]
            above["n_children"] += 1
            above["n_leaves"] += node["n_leaves"]
            above["saved_tokens"] += node["saved_tokens"]
    lows = {at: node["low"] for at, node in nodes.items()}
    return [
        (at, n["low"], n["depth"], lows.get(skeleton.parent[at]), n["n_convs"], n["n_children"], n["n_leaves"], n["saved_tokens"])
        for at, n in nodes.items()
    ]


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (summed over its subtree, the bytes of each node's last text times its members but one) and ends_sha256
    (of the ids of the conversations that end there). `conversations` has conv_id and turns as `turns` gives them."""
    spark = conversations.sparkSession
    shards = shuffle_tasks(spark)
    rows = written(paths(conversations))
    cuts = splitters(rows, shards)
    skeleton = Skeleton(cuts)
    dealt = rows.mapInArrow(_dealt(cuts), "conv_id bigint, path binary, bytes array<int>, shard int")
    dealt = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    local = written(dealt.mapInArrow(_local(cuts), LOCAL_SQL))

    *plain, _ = NODE_COLUMNS
    reduced = spark.createDataFrame(
        _reduced(local, skeleton), "skeleton bigint, " + ", ".join(f"{c} bigint" for c in plain)
    )
    pieces = local.filter("piece IS NOT NULL").select("skeleton", "shard", "piece", "ids").repartition("skeleton")
    ends = pieces.sortWithinPartitions("skeleton", "shard", "piece").mapInArrow(_hashed, "skeleton bigint, ends string")
    ends_sha256 = F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256")
    spine = reduced.join(ends, "skeleton", "left").select(*plain, ends_sha256)

    finished = local.filter("skeleton IS NULL AND above IS NULL").select(*NODE_COLUMNS)
    lows = F.broadcast(reduced.select(F.col("skeleton").alias("above"), F.col("conv_id").alias("low")))  # the skeleton's size
    below = local.filter("above IS NOT NULL").drop("parent_conv_id").join(lows, "above")
    below = below.withColumnRenamed("low", "parent_conv_id").select(*NODE_COLUMNS)
    return finished.unionByName(below).unionByName(spine)
