"""Prefix trie of conversations, by union-find over sorted neighbours.

Turns become 128-bit digests, a conversation an array of them, and equal arrays
one path. Paths are sorted; the longest common prefix (LCP) of each neighbouring
pair is an edge. Taking edges in descending depth, union-find merges the runs of
paths on both sides: each merge creates a branching node, and the depths between
it and the branches below are unary nodes with the same members.

The sorted paths are cut into ranges. Each range knows the last path before it and
the first one after it, so its edges have their true depths. It finishes all nodes
that end inside the range. What is left is contracted to its two outer spines:
nodes that reach over a boundary are returned as partial sums under a digest of
their path, and adding those up merges the ranges' forests. All figures of a node
are sums over its run of paths, so no order of merging matters.

Equal paths are combined before anything is sorted, and a first turn shared by a
third of all conversations is cut like any other run. The hash over a node's
member ids has to be one sequential pass: ids are sorted by Spark and streamed, so
memory stays bounded. A task holds the digests (16 bytes a turn) of its range, and
of a conversation at a time, never its texts.

NULL ids are no conversations: their rows are left out. NULL roles and texts are
empty. Turns are ordered by number, NULL first, and equal numbers by digest. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stpanel.operators.storage import attach, materialize

EMPTY = hashlib.sha256(b"").hexdigest()
BLANKS = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Runs without ASCII white space: each run, with the blanks before it, becomes one character."""
    return F.length(F.regexp_replace(F.rtrim(text, F.lit(BLANKS)), r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++", "x")).cast("long")


def sequences(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, path``: the turns of each conversation in order, as digest and number of words."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.substring(F.unhex(F.sha2(told, 256)), 1, 16).alias("digest"),
            word_count(text).alias("words"),
        ).alias("entry"),
    )
    path = F.transform(F.sort_array(F.collect_list("entry")), lambda e: F.struct(e["digest"], e["words"]))
    return rows.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(path.alias("path"))


def rebuild(convs: DataFrame, block: int = 20, most: int = 4) -> DataFrame:
    """Conversations that start with turns of their block's first conversation.

    The first h = CRC-32 of the id (decimal) modulo ``most`` turns come from
    conversation ``conv_id - conv_id % block``, the rest are a conversation's own.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    heads = convs.filter(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.slice("path", 1, most).alias("head")
    )
    own = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % block).withColumn("h", h)
    empty = F.slice("path", 1, 0)
    begin = F.slice(F.coalesce("head", empty), F.lit(1), F.col("h"))
    rest = F.slice("path", F.col("h") + 1, F.greatest(F.size("path") - F.col("h"), F.lit(0)))
    return own.join(heads, "base", "left").select("conv_id", F.concat(begin, rest).alias("path"))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per run of equal classes: its size, smallest id and the hash over all ids."""
    current, state, size, least = None, None, 0, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"class": pa.array([current], pa.binary()), "n": [size], "least": pa.array([least], pa.int64()), "ends": [state.hexdigest()]}
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        classes, ids = batch.column("class").to_pylist(), batch.column("conv_id").to_pylist()
        cuts = [0, *(i for i in range(1, len(classes)) if classes[i] != classes[i - 1]), len(classes)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            told = ",".join(map(str, ids[a:b]))
            if classes[a] == current:
                state.update(f",{told}".encode())
                size += b - a
                continue
            if current is not None:
                yield row()
            current, state, size, least = classes[a], hashlib.sha256(told.encode()), b - a, ids[a]
    if current is not None:
        yield row()


def paths(convs: DataFrame) -> DataFrame:
    """Distinct paths, sorted into ranges: ``part, path, n, least, ends``."""
    digests = F.transform("path", lambda e: e["digest"])
    # A path's class is a digest of its digests, which all have one length.
    coded = F.sha2(F.array_join(F.transform(digests, lambda d: F.hex(d)), ""), 256)
    rows = materialize(convs.select("conv_id", "path", F.substring(F.unhex(coded), 1, 16).alias("class")), "trie-convs")
    members = (
        rows.select("class", "conv_id")
        .repartition("class")
        .sortWithinPartitions("class", "conv_id")
        .mapInArrow(_ends, "class binary, n long, least long, ends string")
    )
    single = rows.groupBy("class").agg(F.first("path").alias("path")).join(members, "class").drop("class")
    cut = single.repartitionByRange("path").withColumn("part", F.spark_partition_id())
    return materialize(cut, "trie-paths")


def common(a: list, b: list) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


@dataclass
class Run:
    """A component: neighbouring paths from ``start`` that share ``level`` turns."""

    start: int
    level: int
    convs: int
    least: int
    leaves: int
    branches: int  # children of the node at ``level``
    told: int  # words of all members, over their whole length
    first: int  # words of the nodes that paths after ``start`` begin


class Forest:
    """The nodes of one range of sorted distinct paths.

    ``words[i][d]`` counts the words of the first d turns of path i; ``lcp[i]`` is
    the common prefix with the path before it, and ``after`` that of the last path
    with the next range. Both are -1 where there is no such path.
    """

    def __init__(self, lengths, lcp, after, convs, least, words):
        self.lengths, self.lcp, self.after = lengths, lcp, after
        self.words = words
        self.size = len(lengths)
        follows = [*lcp[1:], after]
        self.runs = [
            Run(i, n, convs[i], least[i], int(follows[i] < n), 0, convs[i] * words[i][n], 0)
            for i, n in enumerate(lengths)
        ]
        self.parent = list(range(self.size))
        self.end = list(range(1, self.size + 1))

    def _find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def nodes(self) -> Iterator[tuple]:
        """``path, depth, shared, introduced, convs, least, children, leaves, saved`` of every node.

        ``shared``: the node's run reaches over the range's first or last path.
        ``introduced``: no earlier path has the node; children count where they are introduced.
        """
        for i in sorted(range(1, self.size), key=lambda i: -self.lcp[i]):
            left, right, depth = self.runs[self._find(i - 1)], self.runs[self._find(i)], self.lcp[i]
            yield from self._climb(left, depth)
            yield from self._climb(right, depth)
            self._merge(left, right, depth)
        if self.size:
            yield from self._climb(self.runs[0], -1)

    def _merge(self, left: Run, right: Run, depth: int) -> None:
        left.branches = (1 if left.level > depth else left.branches) + 1
        left.level = depth
        left.convs += right.convs
        left.least = min(left.least, right.least)
        left.leaves += right.leaves
        left.told += right.told
        words, n = self.words[right.start], self.lengths[right.start]
        left.first += right.first + words[n] - words[depth]
        self.parent[right.start] = left.start
        self.end[left.start] = self.end[right.start]

    def _climb(self, run: Run, above: int) -> Iterator[tuple]:
        """The nodes of a run from its level up to, not including, depth ``above``."""
        i = run.start
        words, n, known = self.words[i], self.lengths[i], max(self.lcp[i], -1)
        last = self.end[i] == self.size
        for depth in range(run.level, above, -1):
            old = i == 0 and depth <= known
            before = words[depth - 1] if depth else 0
            children = (run.branches if depth == run.level else 1) - (i == 0 and depth < known)
            own = words[n] - (words[known] if old else before)
            saved = run.told - run.convs * before - own - run.first
            shared = old or (last and depth <= self.after)
            yield i, depth, shared, not old, run.convs, run.least, children, run.leaves, saved


NODE = (
    "key binary, parent_key binary, conv_id long, depth int, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, shared boolean"
)


def chain(digests: list[bytes]) -> list[bytes]:
    """Keys of all prefixes, the empty one first."""
    keys = [hashlib.sha256(b"").digest()[:16]]
    for d in digests:
        keys.append(hashlib.sha256(keys[-1] + d).digest()[:16])
    return keys


def grow(table: pa.Table, neighbours: pa.Table) -> pa.Table:
    """All nodes of one range: finished ones, and partial ones of the outer spines.

    A finished node below a partial one gets its parent's figures later, by
    ``parent_key``.
    """
    schema = pa.schema([("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int32()), ("parent_conv_id", pa.int64()),
                        ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
                        ("ends", pa.string()), ("shared", pa.bool_())])
    if not table.num_rows:
        return schema.empty_table()
    found = [([e["digest"] for e in p], [e["words"] for e in p]) for p in table.column("path").to_pylist()]
    order = sorted(range(len(found)), key=lambda i: found[i][0])
    digests = [found[i][0] for i in order]
    words = [np.r_[0, np.cumsum(found[i][1], dtype=np.int64)].tolist() for i in order]
    convs, least, ends = (np.asarray(table.column(c).to_pylist(), object)[order].tolist() for c in ("n", "least", "ends"))
    before, after = (neighbours.column(c)[0].as_py() for c in ("before", "after"))
    edges = [-1 if before is None else common(before, digests[0])]
    edges += [common(a, b) for a, b in zip(digests, digests[1:], strict=False)]
    until = -1 if after is None else common(digests[-1], after)
    forest = Forest([len(d) for d in digests], edges, until, convs, least, words)
    spines = {0: chain(digests[0]), len(digests) - 1: chain(digests[-1])}
    last = len(digests) - 1
    columns: dict[str, list] = {name: [] for name in schema.names}
    at: dict[tuple[int, int], int] = {}  # finished nodes and partial ones by (first path, depth)
    for i, depth, shared, introduced, n, low, children, leaves, saved in forest.nodes():
        at[i, depth] = len(columns["key"])
        spine = spines[0] if i == 0 else spines[last]
        columns["key"].append(spine[depth] if shared else None)
        columns["parent_key"].append(spine[depth - 1] if shared and depth else None)
        ended = introduced and len(digests[i]) == depth
        for name, value in zip(schema.names[2:], (low, depth, None, n, children, leaves, saved, ends[i] if ended else EMPTY, shared), strict=True):
            columns[name].append(value)
    above = _above(edges)
    for (i, depth), row in at.items():
        if columns["shared"][row] or not depth:
            continue
        parent = at[i if depth - 1 > edges[i] else above[i], depth - 1]
        if columns["shared"][parent]:
            columns["parent_key"][row] = columns["key"][parent]
        else:
            columns["parent_conv_id"][row] = columns["conv_id"][parent]
    return pa.Table.from_pydict(columns, schema=schema)


def _above(lcp: list[int]) -> list[int]:
    """For each path, the path that begins the node it branches off from."""
    stack, found = [0], [0]
    for i in range(1, len(lcp)):
        while len(stack) > 1 and lcp[stack[-1]] >= lcp[i]:
            stack.pop()
        found.append(stack[-1])
        stack.append(i)
    return found


def nodes(convs: DataFrame) -> DataFrame:
    """One row per trie node of ``conv_id, path``: see ``trie``."""
    sorted_paths = paths(convs)
    digests = F.transform("path", lambda e: e["digest"])
    edges = sorted_paths.select("part", digests.alias("d")).groupBy("part").agg(F.min("d").alias("low"), F.max("d").alias("high"))
    by_part = Window.orderBy("part")  # one row per range
    neighbours = edges.select("part", F.lag("high").over(by_part).alias("before"), F.lead("low").over(by_part).alias("after"))
    grown = materialize(
        sorted_paths.groupBy("part").cogroup(neighbours.groupBy("part")).applyInArrow(grow, NODE), "trie-nodes"
    )
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    # Only the range that has a node's first path knows where conversations end.
    ended = F.coalesce(F.max(F.when(F.col("ends") != EMPTY, F.col("ends"))), F.lit(EMPTY))
    spines = materialize(
        grown.filter("shared")
        .groupBy("key")
        .agg(F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
             *[F.sum(c).alias(c) for c in sums], ended.alias("ends")),
        "trie-spines",
    )
    lookup = spines.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    inner = grown.filter("NOT shared").drop("key", "shared")
    below = inner.filter("parent_key IS NOT NULL").unionByName(
        spines.withColumn("parent_conv_id", F.lit(None).cast("long")).drop("key")
    )
    hung = attach(below, lookup, "parent_key", "left").withColumn("parent_conv_id", F.col("above")).drop("above")
    out = inner.filter("parent_key IS NULL").unionByName(hung.select(*inner.columns))
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", *sums, F.col("ends").alias("ends_sha256"))


def trie(turns: DataFrame, block: int = 20, most: int = 4, **columns: str) -> DataFrame:
    """The trie of the rebuilt conversations of ``turns``.

    Per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (the
    parent's; NULL for the root), ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (words that need not be read again below the node) and
    ``ends_sha256`` (over the ids that end at the node).
    """
    return nodes(rebuild(sequences(turns, **columns), block, most))
