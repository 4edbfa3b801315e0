"""The trie of all prefixes of conversations, packed shard by shard into double arrays.

A conversation is a sequence of turns (role, text). A turn is known by 120 bits of a SHA-256 of
role and text, a prefix by the exclusive or of 120-bit hashes of its (turn, depth) pairs, which is a
running aggregate: a conversation's turns are dealt out by ranges of (conversation, turn), numbered
by place and offset, and prefixes and byte sums are carried from range to range, so no task holds
or orders a whole conversation. Texts are hashed where they lie and never move.

Equal sequences are one class with a count (aggregated map-side), so copies of any number are one
path. The paths' turns are dealt out in prefix order and cut into shards of ``shard_rows`` turns. In
each shard the turns get dense ids, the shard's nodes are packed into BASE and CHECK arrays (state
t is the child of s by turn c where t = BASE[s] + c and CHECK[t] = s), every path is walked through
the arrays leaving its count and least id in each state, and the arrays are traversed for the
nodes. A path that begins inside a shard hangs below a turn of its own that stands for the node it
continues. Upper nodes that several shards share are then merged by an aggregate over all shards.

A node belongs to the class of its least member; these are the lower ends of the class's path, so
what a subtree holds is a sum over the classes through its top: of their suffix bytes, less each
node's own bytes once, and of the classes that end at a leaf.

Defined results: rows with a null conversation id take no part; a null role or text is empty; turns
are ordered by number, null first, ties by the turn's hash; repeated rows are turns of their own;
without any conversation there is no node, not even the root. Other columns are ignored. With
negative ids, c - c % group follows SQL (the remainder has the sign of c).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tectonic.llm.common import Workspace
from tectonic.operators.ordering import PART, PLACE, rows_before, written_in_order

SHARD_ROWS = 1 << 15
SORT_LEVELS = 4  # prefixes that order the paths before their class does
ID_BYTES = 1 << 20  # of one piece of a node's ids
NODE = ["x1", "x2", "depth"]


class DoubleArray:
    """A trie over dense symbols 1, 2, ...; state 0 is the root.

    ``parents`` and ``symbols`` give every other node's parent (-1: the root) and its symbol there.
    """

    def __init__(self, parents: np.ndarray, symbols: np.ndarray):
        n = len(parents)
        order = np.lexsort((symbols, parents))
        groups, first, sizes = np.unique(parents[order], return_index=True, return_counts=True)
        base = np.zeros(n + 1, np.int64)  # of each node; the root's is the last
        free = np.ones(max(2 * n, 64) + 1, bool)
        free[0] = False
        for g in np.argsort(-sizes, kind="stable").tolist():
            if sizes[g] == 1:
                break
            own = symbols[order[first[g]:first[g] + sizes[g]]]
            base[groups[g]], free = self._place(own, free)
            free[base[groups[g]] + own] = False
        single = sizes == 1
        slots = np.flatnonzero(free)
        if len(slots) < single.sum():
            slots = np.append(slots, np.arange(len(free), len(free) + int(single.sum()) - len(slots)))
        base[groups[single]] = slots[:single.sum()] - symbols[order[first[single]]]
        state = base[parents] + symbols
        self.state = state  # of each node
        size = int(state.max(initial=0)) + 1
        self.base, self.check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        self.base[state], self.base[0] = base[:n], base[n]
        self.check[state] = np.append(state, 0)[parents]

    @staticmethod
    def _place(own: np.ndarray, free: np.ndarray) -> tuple[int, np.ndarray]:
        """The lowest base at which all of the sorted symbols fall on free slots."""
        reach = int(own[-1] - own[0])
        candidates = np.flatnonzero(free[:max(len(free) - reach, 0)])
        for c in own[1:]:
            if not len(candidates):
                break
            candidates = candidates[free[candidates + (c - own[0])]]
        at = int(candidates[0]) if len(candidates) else len(free)
        if at + reach >= len(free):
            free = np.append(free, np.ones(max(at + reach + 1 - len(free), len(free)), bool))
        return at - int(own[0]), free

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The children of the states by the symbols; -1 where there is none."""
        at = self.base[states] + symbols
        known = (at > 0) & (at < len(self.check)) & (states >= 0)
        known &= self.check[np.where(known, at, 0)] == states
        return np.where(known, at, -1)

    def levels(self) -> Iterator[np.ndarray]:
        """The states level by level, from the root's children."""
        below = np.argsort(self.check, kind="stable")
        above = self.check[below]
        front = np.zeros(1, np.int64)
        while True:
            low, high = np.searchsorted(above, front, "left"), np.searchsorted(above, front, "right")
            front = np.concatenate([below[a:b] for a, b in zip(low.tolist(), high.tolist()) if b > a] or [front[:0]])
            if not len(front):
                return
            yield front


def _numbered(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of each distinct value's first occurrence, 0-based number of each row's value)."""
    rows = np.ascontiguousarray(np.stack(columns, axis=1)).view([("", np.int64)] * len(columns)).ravel()
    _, first, number = np.unique(rows, return_index=True, return_inverse=True)
    return first, number


COLUMNS = ["rep", "copies", "x1", "x2", "depth", "p1", "p2", "k1", "k2", "bytes"]
PARTIAL = ["x1", "x2", "depth", "p1", "p2", "n_convs", "conv_id", "bytes"]


def shard_nodes(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The nodes of one shard in level order, each with the summed copies (n_convs) and the least
    id (conv_id) of the paths through it. ``rows`` are turns of paths (COLUMNS): rep, copies, the
    node x1, x2, depth, its parent p1, p2, the turn k1, k2 and its bytes; a path's turns follow one
    another. A node that is reached both from its parent in the shard and as the first of a path
    that began elsewhere comes twice."""
    rep, depth = rows["rep"], rows["depth"]
    begins = np.flatnonzero(np.append(True, (rep[1:] != rep[:-1]) | (depth[1:] != depth[:-1] + 1)))
    lengths = np.diff(np.append(begins, len(rep)))
    tops, top = _numbered(rows["p1"][begins], rows["p2"][begins], depth[begins])
    # a prefix tells the whole way to it, so a node is told by it and by where its paths began
    first, node = _numbered(np.repeat(top, lengths), rows["x1"], rows["x2"], depth)
    _, turn = _numbered(rows["k1"], rows["k2"])
    above = np.append(-1, node[:-1])
    above[begins] = len(first) + top
    top_symbols = int(turn.max(initial=0)) + 2 + np.arange(len(tops))
    array = DoubleArray(np.append(above[first], np.full(len(tops), -1)), np.append(turn[first] + 1, top_symbols))
    n, least = np.zeros(len(array.check), np.int64), np.full(len(array.check), np.iinfo(np.int64).max)
    row_of = np.zeros(len(array.check), np.int64)
    longest = np.argsort(-lengths, kind="stable")  # paths still walking come first
    states = array.step(np.zeros(len(longest), np.int64), top_symbols[top[longest]])
    alive = np.searchsorted(-lengths[longest], -np.arange(int(lengths.max(initial=0))), "left")
    for k, many in enumerate(alive.tolist()):
        at = begins[longest[:many]] + k
        states = array.step(states[:many], turn[at] + 1)
        np.add.at(n, states, rows["copies"][at])
        np.minimum.at(least, states, rep[at])
        row_of[states] = at
    levels = list(array.levels())[1:]  # the first level are the paths' beginnings
    found = np.concatenate(levels) if levels else np.zeros(0, np.int64)
    own = row_of[found]
    return {name: rows[name][own] for name in ("x1", "x2", "depth", "p1", "p2")} | {
        "n_convs": n[found], "conv_id": least[found], "bytes": rows["bytes"][own]}


def _shards(size: int):
    def close(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        nodes = shard_nodes({name: table[name].to_numpy() for name in COLUMNS})
        yield pa.RecordBatch.from_arrays([pa.array(nodes[name], pa.int64()) for name in PARTIAL], PARTIAL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                many += batch.num_rows
            if many >= size:
                yield from close(held)
                held, many = [], 0
        if held:
            yield from close(held)
    return run


def _id_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conversation) rows to pieces: the ids of one node, joined by commas."""
    held, node, least = [], None, None

    def piece():
        return pa.RecordBatch.from_arrays(
            [*(pa.array([v], pa.int64()) for v in (*node, least)), pa.array([",".join(held)], pa.string())],
            [*NODE, "first", "ids"])

    size = 0
    for batch in batches:
        for *own, conv in zip(*(column.to_pylist() for column in batch.columns)):
            if own != node or size >= ID_BYTES:
                if held:
                    yield piece()
                held, node, least, size = [], own, conv, 0
            held.append(str(conv))
            size += len(held[-1]) + 1
    if held:
        yield piece()


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one digest a node, fed piece by piece."""
    node, digest = None, None

    def out():
        return pa.RecordBatch.from_arrays(
            [*(pa.array([v], pa.int64()) for v in node), pa.array([digest.hexdigest()], pa.string())],
            [*NODE, "ends_sha256"])

    for batch in batches:
        columns = [batch.column(i) for i in (0, 1, 2, 4)]
        for *own, ids in zip(*(column.to_pylist() for column in columns)):
            if own != node:
                if node is not None:
                    yield out()
                node, digest = own, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if node is not None:
        yield out()


def _long(digest, first: int):
    """Fifteen hex digits of a digest, from the given one (1-based), as a number of 60 bits."""
    return F.conv(F.substring(digest, first, 15), 16, 10).cast("long")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, rank over all conversations, part, k1, k2, bytes), in order of conversation and turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    written = written_in_order(
        turns.select("conv_id", "turn", _long(F.col("digest"), 1).alias("k1"), _long(F.col("digest"), 16).alias("k2"), "bytes"),
        [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("k1"), F.col("k2")])
    return written.join(F.broadcast(rows_before(written)), PART).select(
        "conv_id", (F.col("_before") + F.col(PLACE)).alias("rank"), F.col(PART).alias("part"), "k1", "k2", "bytes")


def rebuilt(turns: DataFrame, work: Workspace, group: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """(conversations, their rebuilt turns with depth): the first h turns are those of conversation
    c - c % group, the rest are the own ones after the first h; h = crc32(c) % heads."""
    own = turns.groupBy("conv_id").agg(F.min("rank").alias("start"), F.count("*").alias("n"))
    convs = work.save(own.select(
        "conv_id", "start", "n", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h")))
    placed = turns.join(convs.select("conv_id", "start", "h"), "conv_id") \
        .withColumn("place", F.col("rank") - F.col("start"))
    first = placed.where(F.col("place") < heads - 1).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "k1", "k2", "bytes"))).alias("head"))  # heads - 1 at most
    leads = convs.join(first.withColumnRenamed("conv_id", "base"), "base").where("h > 0").select(
        "conv_id", F.slice("head", 1, F.col("h").cast("int")).alias("head"))
    leads = work.save(leads)
    lead_rows = leads.select("conv_id", F.lit(-1).alias("part"), F.inline("head")).select(
        "conv_id", "part", (F.col("place") + 1).alias("depth"), "k1", "k2", "bytes")
    rest = placed.where(F.col("place") >= F.col("h")) \
        .join(leads.select("conv_id", F.size("head").alias("led")), "conv_id", "left").select(
            "conv_id", "part", (F.col("place") - F.col("h") + F.coalesce("led", F.lit(0)) + 1).alias("depth"),
            "k1", "k2", "bytes")
    return convs, lead_rows.unionByName(rest)


def with_prefixes(rows: DataFrame, work: Workspace) -> DataFrame:
    """Rebuilt turns plus the prefix that ends at each (x1, x2), the one before (p1, p2) and the bytes
    up to it. Each stretch of a conversation that lies in one range is summed up by itself; the
    sums of the stretches before (one row a range) are added to it."""
    z = F.sha2(F.concat_ws(",", "k1", "k2", "depth"), 256)
    hashed = rows.withColumn("z", z).select(
        "*", _long(F.col("z"), 1).alias("z1"), _long(F.col("z"), 16).alias("z2")).drop("z")
    running = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    within = work.save(hashed.select(
        "conv_id", "part", "depth", "k1", "k2", "bytes", "z1", "z2",
        F.bit_xor("z1").over(running).alias("y1"), F.bit_xor("z2").over(running).alias("y2"),
        F.sum("bytes").over(running).alias("upto")))
    sums = within.groupBy("conv_id", "part").agg(
        F.bit_xor("z1").alias("s1"), F.bit_xor("z2").alias("s2"), F.sum("bytes").alias("s"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("conv_id", "part", *(F.coalesce(f(c).over(earlier), F.lit(0)).alias(f"b{c}")
                                              for f, c in ((F.bit_xor, "s1"), (F.bit_xor, "s2"), (F.sum, "s"))))
    x1, x2 = (F.col(f"y{i}").bitwiseXOR(F.col(f"bs{i}")) for i in (1, 2))
    return work.save(within.join(before, ["conv_id", "part"]).select(
        "conv_id", "depth", "k1", "k2", "bytes", x1.alias("x1"), x2.alias("x2"),
        x1.bitwiseXOR(F.col("z1")).alias("p1"), x2.bitwiseXOR(F.col("z2")).alias("p2"),
        (F.col("upto") + F.col("bs")).alias("upto")))


def end_digests(ends: DataFrame) -> DataFrame:
    """Each node's ends_sha256 from (x1, x2, depth, conv_id) rows. Ids are joined to pieces by ranges
    first, so a node where a third of all conversations end is some pieces of a megabyte; the digest
    itself is sequential and is fed piece by piece in one task."""
    order = [*NODE, "conv_id"]
    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order) \
        .mapInArrow(_id_texts, "x1 long, x2 long, depth long, first long, ids string")
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first") \
        .mapInArrow(_id_digests, "x1 long, x2 long, depth long, ends_sha256 string")


def prefix_nodes(conversations: DataFrame, group: int = 5, heads: int = 9, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node of the trie of the rebuilt ``conversations`` (conv_id, turn, role, text):
    conv_id (least member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    work = Workspace(conversations.sparkSession)
    convs, rows = rebuilt(numbered_turns(conversations), work, group, heads)
    paths = with_prefixes(rows, work)
    last = F.max(F.struct("depth", "x1", "x2", "upto"))
    level = [F.max(F.when(F.col("depth") == d, F.col("x1"))).alias(f"l{d}") for d in range(1, SORT_LEVELS + 1)]
    whole = paths.groupBy("conv_id").agg(last.alias("end"), *level)
    ends = work.save(convs.select("conv_id").join(whole, "conv_id", "left").select(
        "conv_id", *(F.coalesce(f"end.{c}", F.lit(0)).alias(c) for c in (*NODE, "upto")),
        *(f"l{d}" for d in range(1, SORT_LEVELS + 1))))
    # equal sequences end at the same node: one path stands for all of them
    classes = work.save(ends.groupBy(*NODE).agg(
        F.min("conv_id").alias("rep"), F.count("*").alias("copies"), F.max("upto").alias("total"),
        *(F.max(f"l{d}").alias(f"l{d}") for d in range(1, SORT_LEVELS + 1))))
    own = classes.select("rep", "copies", *(f"l{d}" for d in range(1, SORT_LEVELS + 1)))
    order = [*(f"l{d}" for d in range(1, SORT_LEVELS + 1)), "rep", "depth"]
    # the shards: prefix order, cut by rows; a path longer than a shard goes on in the next
    partial = paths.join(own, paths["conv_id"] == own["rep"]).select(*COLUMNS, *order[:SORT_LEVELS]) \
        .repartitionByRange(*order).sortWithinPartitions(*order).select(*COLUMNS) \
        .mapInArrow(_shards(shard_rows), ", ".join(f"{c} long" for c in PARTIAL))
    below = partial.groupBy(*NODE, "p1", "p2").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("bytes").alias("bytes"))
    root = classes.agg(F.sum("copies").alias("n_convs"), F.min("rep").alias("conv_id")).where("conv_id is not null") \
        .select(F.lit(0).cast("long").alias("x1"), F.lit(0).cast("long").alias("x2"), F.lit(0).cast("long").alias("depth"),
                F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), "n_convs", "conv_id",
                F.lit(0).cast("long").alias("bytes"))
    nodes = work.save(below.unionByName(root))
    children = nodes.where("depth > 0").groupBy(
        F.col("p1").alias("x1"), F.col("p2").alias("x2"), (F.col("depth") - 1).alias("depth")) \
        .agg(F.count("*").alias("n_children"))
    # what a class adds to the nodes on its path
    first = nodes.groupBy(F.col("conv_id").alias("rep")).agg(
        F.min("depth").alias("first"), F.sum("bytes").alias("own_bytes"))
    leaves = classes.join(children.select(*NODE, F.lit(0).alias("inner")), NODE, "left").select(
        "rep", "copies", "total", F.when(F.col("inner").isNull(), 1).otherwise(0).alias("leaf"))
    shares = work.save(leaves.join(first, "rep", "left"))
    every = paths.select(F.col("conv_id").alias("rep"), *NODE, "bytes", "upto").unionByName(
        classes.select("rep", F.lit(0).cast("long").alias("x1"), F.lit(0).cast("long").alias("x2"),
                       F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"),
                       F.lit(0).cast("long").alias("upto")))
    suffix = F.col("total") - F.col("upto") + F.col("bytes")
    once = F.when(F.col("depth") >= F.col("first"), suffix).otherwise(F.coalesce("own_bytes", F.lit(0)))
    subtrees = every.join(shares, "rep").groupBy(*NODE).agg(
        F.sum("leaf").cast("long").alias("n_leaves"), F.sum(F.col("copies") * suffix - once).alias("saved_tokens"))
    parents = nodes.select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), (F.col("depth") + 1).alias("depth"),
                           F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(subtrees, NODE).join(children, NODE, "left").join(end_digests(ends), NODE, "left") \
        .join(parents, ["p1", "p2", "depth"], "left").select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
