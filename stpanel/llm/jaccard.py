"""Exact Jaccard join of documents in metric space, by regions within regions.

Documents are sets of word shingles, and one minus the Jaccard similarity is a
metric. The join finds the components of all links of at most ``1 - t``.

First level: the pivots are the single shingles. A document lies nearest to the
shingles it holds, and in the region of the first one in a global order that
puts shared shingles last. Two linked documents differ in few shingles, so
replicating each document into the regions of its first ``n - ceil(t n) + 1``
shingles (its window) makes every linked pair meet in a region.

Documents that meet in a region are compared by sketches first, bitmaps of the
parities of their shingles: linked sets differ in few shingles, and so in no more
bits. What shares a passage only parts here, whatever the size of the corpus.
Regions of the same classes are one, and a task ties classes once, so that the ties
follow the classes and not the shingles that they share.

Second level: documents tied by such meetings form a group, whose pivot is the
document shared most. The documents in its ball (at most ``1 - t`` away) are linked to it
and so to each other's component. By the triangle inequality, only documents in
the boundary, up to twice as far, can be linked to the ball; they are replicated
to it. The documents outside the ball are joined among themselves: few of them at
once; many form new groups by the regions that they still share, with pivots of
their own, and so on. What ``DEPTH`` levels leave is joined in tiles of bounded
size. A join looks at pairs that share a difference from the pivot, within the
window of distances that the inequality leaves, and returns a spanning forest of
its links, so a dense group never becomes all its pairs. No link is lost.

Equal sets are one class and never pairs. The order of shingles needs how many
documents share them. Shingles whose hash is in the lowest ``COUNTED`` of all
hashes are counted over all documents, and the counts of shared ones become
levels in bit tables, which have ``ROOM`` bits for each of them; a counted shingle
without a mark stands alone and opens no region. Shingles above that share are used,
and taken for shared, where a document has too few others; those that several of some
thousand documents share are counted as well and come later in the order. Levels only
steer the work; any level gives the same result. A full table would cost time: then
no shingle stands alone, and every window is full of shingles that nobody shares.

Documents without words are linked with nothing. NULL ids are members without a
say in the smallest id; a component with no other id has a NULL one. Repeated
rows are members of one class. Sets and rows are told
apart by 128 bits, shingles by 64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stpanel.llm.batches import small_batches
from stpanel.llm.bpe import slices
from stpanel.llm.graph import components
from stpanel.llm.shingles import shingle_sets
from stpanel.operators.skew import hub_blocks
from stpanel.operators.storage import attach, discard, materialize, scratch

PERCENT = 80  # least similarity
WORDS = 5
LEVELS = (2, 8, 64, 512)  # documents from which a shingle is put further back in the order
SLOT_BITS = 24  # size of the bit table of rows: two megabytes, whatever the input
COUNTED = 0.5  # share of all shingles, by hash, that are counted
BUCKETS = 1 << 13  # ranges of hashes that are counted together
HELD = 1 << 19  # counted shingles that a task combines before it sends them
ROOM = 2  # bits of a level's table for each of its shingles
MOST_SLOTS = 1 << 32  # of a table, over all hashes
FEW = 32  # classes up to which all pairs of a tile are taken at once
BLOCK = 4096  # classes that enter a tile together,
SHINGLES = 2_000_000  # with about so many shingles
DEPTH = 2  # levels of document pivots
KNOWN = 1 << 18  # classes up to which a task remembers what it has tied
SKETCH = 256, 8192  # least and most bits of a sketch; about one for each shingle between them


_LIMIT = np.uint64(int(COUNTED * 2**64))
_BOUNDS = np.arange(1, BUCKETS, dtype=np.uint64) * np.uint64((1 << 64) // BUCKETS)


def window(n: int, percent: int = PERCENT) -> int:
    """First shingles of a set of ``n`` in which every linked set has one."""
    return n + (-n * percent // 100) + 1 if n else 0


def _bit_table(rows: DataFrame, column: str) -> np.ndarray:
    """A packed bit table of the slots of the rows."""
    slot = F.col(column).bitwiseAND((1 << SLOT_BITS) - 1)
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = rows.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).cast("int").alias("word"))
    words = words.agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(1 << (SLOT_BITS - 6), np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    return table.view(np.uint8)


def _marked(table: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """Whether the slots are set."""
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & np.uint8(1) == 1


def _slots(hashes: np.ndarray, size: int) -> np.ndarray:
    """The slots of the hashes, in their order, in a table of ``size`` slots over all hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


def _row_keys(text: str, doc_id: str) -> list[Column]:
    """Two hashes of id and text, equal only for repeated rows."""
    values = [F.col(doc_id), F.col(text)]
    return [F.xxhash64(*values).alias("row"), F.xxhash64(F.lit("second"), *reversed(values)).alias("row2")]


def _pieces(level: int, hashes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """``level, bucket, shingles, n``: sorted hashes and their counts, cut into buckets."""
    ends = np.r_[0, np.searchsorted(hashes, _BOUNDS), len(hashes)].astype(np.int32)
    lists = [
        pa.Array.from_buffers(pa.binary(), BUCKETS, [None, pa.py_buffer(ends * x.itemsize), pa.py_buffer(np.ascontiguousarray(x))])
        for x in (hashes, n.astype(np.int32))
    ]
    full = pa.array(np.flatnonzero(ends[1:] > ends[:-1]).astype(np.int32))
    columns = [pa.array(np.full(len(full), level, np.int32)), full, *(x.take(full) for x in lists)]
    return pa.RecordBatch.from_arrays(columns, ["level", "bucket", "shingles", "n"])


def _values(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The numbers in all rows of a binary column, one after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _sums(hashes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes, sorted, and the sums of their counts."""
    order = np.argsort(hashes)
    hashes = hashes[order]
    first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)])
    return hashes[first], np.add.reduceat(n[order].astype(np.int64), first) if len(first) else n[:0].astype(np.int64)


_PIECES = "level int, bucket int, shingles binary, n binary"


def _shared(docs: DataFrame, k: int) -> DataFrame:
    """``level, bucket, shingles, n``: the shingles of each level, in ranges of hashes.

    Level 0 has the counted shingles that two documents share, the others have those of
    at least 8, 64, ... documents. Shingles above the counted share enter with the
    documents of a task that share them, and so may come too low, but never to level 0.
    A task sends its shingles as one list for each range, which a task adds up at once.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                held += shingle_sets(part.column("text").to_pylist(), k)
                size += sum(map(len, held[-part.num_rows :]))
                if size >= HELD / COUNTED:
                    yield several(held)
                    held, size = [], 0
        if size:
            yield several(held)

    def several(sets: list[np.ndarray]) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(sets), return_counts=True)
        kept = (found < _LIMIT) | (n > 1)
        return _pieces(0, found[kept], n[kept])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column("shingles").nbytes
            if size >= 8 * HELD:
                table = pa.Table.from_batches(held)
                bucket = table["bucket"].to_numpy()
                end = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
                if end:
                    yield from levels(table.slice(0, end))
                    held = table.slice(end).combine_chunks().to_batches()
                    size = sum(x.column("shingles").nbytes for x in held)
        if held:
            yield from levels(pa.Table.from_batches(held))

    def levels(table: pa.Table) -> Iterator[pa.RecordBatch]:
        found, n = _sums(_values(table["shingles"], np.uint64), _values(table["n"], np.int32))
        for level, least in enumerate(LEVELS):
            kept = n >= least
            if not level:
                kept &= found < _LIMIT
            yield _pieces(level, found[kept], n[kept])

    parts = docs.mapInArrow(cut, _PIECES)
    return parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(add, _PIECES)


def _shared_levels(docs: DataFrame, k: int) -> list[tuple[int, np.ndarray]]:
    """For each level the slots of its bit table, over all hashes, and the table: its shingles are marked."""
    shared = materialize(_shared(docs, k).select("level", "bucket", "shingles"), "jaccard-shared")
    count = F.sum(F.octet_length("shingles") / 8).cast("long")
    marks = dict(shared.groupBy("level").agg(count).collect())
    least, shares = 8 * BUCKETS, [COUNTED, *[1] * (len(LEVELS) - 1)]
    sizes = [min(MOST_SLOTS, least * max(1, -int(-ROOM * marks.get(i, 0) // (share * least)))) for i, share in enumerate(shares)]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = []
            for level, bucket, raw in zip(*(batch.column(c).to_pylist() for c in ("level", "bucket", "shingles")), strict=True):
                each = sizes[level] // BUCKETS
                bits = np.zeros(each, np.uint8)
                bits[_slots(np.frombuffer(raw, np.uint64), sizes[level]) - bucket * each] = 1
                pieces.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("level"), batch.column("bucket"), pa.array(pieces, pa.binary())], ["level", "bucket", "bits"])

    found = shared.mapInArrow(mark, "level int, bucket int, bits binary").toArrow()
    discard(shared)
    tables = [np.zeros(int(size * share) // 8, np.uint8) for size, share in zip(sizes, shares, strict=True)]
    for batch in found.to_batches():
        for level, bucket, bits in zip(*(batch.column(c) for c in ("level", "bucket", "bits")), strict=True):
            at = bucket.as_py() * (sizes[level.as_py()] // BUCKETS) // 8
            piece = np.frombuffer(bits.as_buffer(), np.uint8)
            tables[level.as_py()][at : at + len(piece)] = piece
    return list(zip(sizes, tables, strict=True))


def _levels(hashes: np.ndarray, tables: Sequence[tuple[int, np.ndarray]]) -> np.ndarray:
    """Places of shingles in the order: 0 stands alone, 1 is not counted, 2, 4, ... are shared by more and more."""
    out = np.where(hashes < _LIMIT, 0, 1).astype(np.int8)
    at = np.flatnonzero(out == 0)
    for i, (size, table) in enumerate(tables):
        at = at[_marked(table, _slots(hashes[at], size))]
        out[at] = 2 * i + 2
        if not i:
            at = np.r_[at, np.flatnonzero(out == 1)]
    return out


def _windows(docs: DataFrame, levels: list[tuple[int, np.ndarray]], k: int, percent: int) -> DataFrame:
    """``doc_id, row, row2, n, class, window, sketch``: the class is a hash of the set.

    Of the window only the shingles that others may share are kept. The order is
    the same for all documents: counted and unmarked, uncounted and unmarked, then by level.
    """
    shared = docs.sparkSession.sparkContext.broadcast(levels)
    names = ["doc_id", "row", "row2", "n", "class", "window", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                n, digests, found, sketches = [], [], [], []
                sets = shingle_sets(part.column("text").to_pylist(), k)
                places = _levels(np.concatenate(sets), tables)
                for s, level in zip(sets, np.split(places, np.cumsum([len(s) for s in sets[:-1]])), strict=True):
                    size = window(len(s), percent)
                    alone = len(s) - np.count_nonzero(level)
                    order = np.argsort(level, kind="stable")[alone:size] if alone < size else []
                    n.append(len(s))
                    digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                    found.append(s[order].view(np.int64) if len(order) else np.zeros(0, np.int64))
                    sketches.append(_sketch(s) if len(order) else None)
                columns = [part.column(c) for c in names[:3]]
                columns += [pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(found, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, row long, row2 long, n long, class binary, window array<long>, sketch binary")


def _sketch(hashes: np.ndarray) -> bytes:
    """A bit for each slot: whether an odd number of the set's hashes falls into it."""
    size = min(max(SKETCH[0], 1 << (len(hashes) - 1).bit_length()), SKETCH[1])
    slot = (hashes >> np.uint64(SLOT_BITS)) & np.uint64(size - 1)
    return np.packbits(np.bincount(slot.astype(np.int64), minlength=size) & 1).tobytes()


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``wanted`` (with unique ``row, row2``) and the ``shingles`` of its rows.

    A bit table of fixed size lets most other rows pass by unread; the join
    makes the choice exact.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_bit_table(wanted, "row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.flatnonzero(_marked(shared.value, batch.column("row").to_numpy() & ((1 << SLOT_BITS) - 1)))
            for part in slices(batch.take(pa.array(at)), "text", 2 << 20):
                sets = [s.view(np.int64) for s in shingle_sets(part.column("text").to_pylist(), k)]
                columns = [part.column("row"), part.column("row2"), pa.array(sets, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["row", "row2", "shingles"])

    keys = ["row", "row2"]
    rows = docs.select(*keys, "text").mapInArrow(run, "row long, row2 long, shingles array<long>")
    return rows.dropDuplicates(keys).join(wanted, keys).drop(*keys)


def _regions(stored: DataFrame) -> DataFrame:
    """``region, class, n, times``: the first-level regions that hold more than one class.

    Copies share many shingles. Regions of the same classes are one, which stands for
    ``times`` of them: what meets in it would meet in the others again.
    """
    classes = stored.filter(F.size("window") > 0).select("class", "n", "window").dropDuplicates(["class"])
    members = materialize(classes, "jaccard-classes").select(F.explode("window").alias("region"), "class", "n")
    marks = [F.bit_xor(F.xxhash64("class")).alias("mark"), F.bit_xor(F.xxhash64(F.lit("second"), "class")).alias("mark2")]
    held = members.groupBy("region").agg(F.count(F.lit(1)).alias("size"), *marks).filter("size > 1")
    kept = held.groupBy("size", "mark", "mark2").agg(F.min("region").alias("region"), F.count(F.lit(1)).alias("times"))
    return members.join(kept.select("region", "times"), "region")


class Sketches:
    """Sketches of several sizes; the larger one of a pair is folded to the smaller one's size."""

    def __init__(self, sketches: Sequence[bytes]):
        self.words = np.array([len(s) // 8 for s in sketches], np.int64)
        self.folded = {}
        words = int(self.words.max(initial=0))
        rows, table = np.zeros(0, np.int64), np.zeros((0, words), np.uint64)
        while words >= max(1, int(self.words.min(initial=1))):
            own = np.flatnonzero(self.words == words)
            new = np.frombuffer(b"".join(sketches[i] for i in own), np.uint64).reshape(len(own), words)
            rows, table = np.r_[rows, own], np.vstack([table, new])
            place = np.full(len(sketches), -1)
            place[rows] = np.arange(len(rows))
            self.folded[words] = place, table
            words //= 2
            table = table[:, :words] ^ table[:, words : 2 * words]

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """In how many bits the rows ``x`` and ``y`` differ: at most in as many as in shingles."""
        least, out = np.minimum(self.words[x], self.words[y]), np.zeros(len(x), np.int64)
        for words, (place, table) in self.folded.items():
            at = np.flatnonzero(least == words)
            if len(at):
                out[at] = np.bitwise_count(table[place[x[at]]] ^ table[place[y[at]]]).sum(1, dtype=np.int64)
        return out


class Trees:
    """The classes a task has met, numbered, and which of them its ties connect."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.root = np.zeros(0, np.int64)

    def number(self, names: Sequence[bytes]) -> np.ndarray:
        """Numbers of the classes; new ones are alone. Forgets what it met where that is too much."""
        if len(self.numbers) > KNOWN:
            self.__init__()
        for name in names:
            self.numbers.setdefault(name, len(self.numbers))
        self.root = np.r_[self.root, np.arange(len(self.root), len(self.numbers))]
        return np.fromiter(map(self.numbers.__getitem__, names), np.int64, len(names))


def _forest(
    key: np.ndarray, n: np.ndarray, sketches: Sketches, percent: int, node: np.ndarray | None = None, root: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Rows of equal keys (which are in order) whose sizes and sketches allow a link, as a spanning forest.

    Linked sets of ``a`` and ``b`` shingles differ in at most
    ``(a + b) (100 - percent) / (100 + percent)`` of them. ``node`` numbers what the rows
    stand for, each row by itself unless given; nodes with one ``root`` are tied already.
    """
    if node is None:
        node = np.arange(len(key))
    if root is None:
        root = np.arange(len(key))
    found = []

    def tie(pairs: Iterable[tuple[int, int]]) -> None:
        for i, j in pairs:
            a, b = node[i], node[j]
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            if a != b:
                root[b] = a
                found.append((i, j))

    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    sizes = np.diff(np.r_[first, len(key)])
    for start, size in zip(first[sizes > FEW], sizes[sizes > FEW], strict=True):
        tie(_spread(np.arange(start, start + size), n, sketches, percent, node, root))
    few = np.repeat(sizes <= FEW, sizes)
    step, at = 1, np.flatnonzero((key[1:] == key[:-1]) & few[1:])
    while len(at):
        x, y = at, at + step
        open_ = (root[node[x]] != root[node[y]]) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
        x, y = x[open_], y[open_]
        near = (100 + percent) * sketches.apart(x, y) <= (100 - percent) * (n[x] + n[y])
        tie(zip(x[near].tolist(), y[near].tolist(), strict=True))
        while near.any() and (root[root] != root).any():
            root[:] = root[root]
        step += 1
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
    return found


def _spread(
    rows: np.ndarray, n: np.ndarray, sketches: Sketches, percent: int, node: np.ndarray, root: np.ndarray
) -> list[tuple[int, int]]:
    """Ties between the rows of one large tile, without all its pairs.

    In order of size a row only asks those whose size allows a link, which are not tied
    to it yet and have not asked themselves; the rows of the largest tree need not ask.
    So a tile of copies takes a round of each, and less where they are tied already.
    """
    tree = node[rows]
    while (root[tree] != tree).any():
        tree = root[tree]
    root[node[rows]] = tree
    if (tree == tree[0]).all():
        return []
    order = np.argsort(n[rows], kind="stable")
    rows, tree = rows[order], tree[order]
    size, asked, found = n[rows], np.zeros(len(rows), bool), []
    low, high = np.searchsorted(100 * size, percent * size), np.searchsorted(percent * size, 100 * size, side="right")
    again = True
    while again:
        again, left = False, np.flatnonzero(~asked)
        trees, times = np.unique(tree[left], return_counts=True)
        if len(trees) < 2:
            break
        largest = trees[np.argmax(times)]
        for x in left.tolist():
            if tree[x] == largest:
                continue
            asked[x] = True
            at = low[x] + np.flatnonzero(~asked[low[x] : high[x]] & (tree[low[x] : high[x]] != tree[x]))
            if not len(at):
                continue
            near = at[(100 + percent) * sketches.apart(np.full(len(at), rows[x]), rows[at]) <= (100 - percent) * (size[x] + size[at])]
            if not len(near):
                continue
            olds, some = np.unique(tree[near], return_index=True)
            found += [(int(rows[x]), int(rows[y])) for y in near[some]]
            if (olds == largest).any():
                tree[np.isin(tree, np.r_[olds, tree[x]])] = largest
            else:
                tree[np.isin(tree, olds)] = tree[x]
            if len(olds) > FEW:  # another tree may be the largest now
                again = True
                break
    return found


def _meetings(members: DataFrame, sketches: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """``u, v``: classes that meet in a region and may be linked, tied together.

    A region of more than ``block`` classes is dealt into blocks; each two meet in a
    tile. Regions are sorted, not grouped, on their way to Python: most hold two classes.
    Copies meet in each region that they share; a task ties them in one of them only, so it
    returns fewer ties than it has classes, however many regions and copies there are.
    """
    hubs = hub_blocks(members, "region", block)
    rows = attach(members, hubs, "region", "left").join(sketches, "class")
    own = F.pmod(F.xxhash64("class"), F.coalesce("_blocks", F.lit(1))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1))
    rows = rows.select("region", "class", "n", "sketch", own.alias("own"), other.alias("other"))
    tile = [F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")]
    rows = rows.select("region", *tile, "class", "n", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Trees()

        def ties(table: pa.Table, key: np.ndarray) -> pa.RecordBatch:
            names, n = table["class"].to_pylist(), table["n"].to_numpy()
            node = trees.number(names)
            found = [(names[i], names[j]) for i, j in _forest(key, n, Sketches(table["sketch"].to_pylist()), percent, node, trees.root)]
            return pa.RecordBatch.from_pydict({"u": pa.array([u for u, _ in found], pa.binary()), "v": pa.array([v for _, v in found], pa.binary())})

        def keys(table: pa.Table) -> np.ndarray:
            new = np.zeros(table.num_rows, bool)
            for name in ("region", "i", "j"):
                column = table[name].to_numpy()
                new[1:] |= column[1:] != column[:-1]
            return np.cumsum(new)

        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= 4 * BLOCK:
                table = pa.Table.from_batches(held)
                key = keys(table)
                end = int(np.searchsorted(key, key[-1]))  # the last tile may go on
                if end:
                    yield ties(table.slice(0, end), key[:end])
                    held, count = table.slice(end).combine_chunks().to_batches(), table.num_rows - end
        if count:
            table = pa.Table.from_batches(held)
            yield ties(table, keys(table))

    place = ["region", "i", "j"]
    return rows.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, "u binary, v binary")


def _groups(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """``class, group, pivot``: classes tied in regions, and each group's pivot.

    The pivot is the document whose window is shared most: what others were
    copied from holds little of its own.
    """
    ties = materialize(_meetings(members, sketches, percent).distinct(), "jaccard-ties")  # components reads them four times
    groups = components(ties)
    groups = groups.select(F.col("node").alias("class"), F.col("component").alias("group"))
    shared = members.groupBy("class").agg(F.sum("times").alias("shared"), F.first("n").alias("n"))
    size = F.expr(f"n - ceil(n * {percent} / 100) + 1")
    placed = shared.join(groups, "class").select("class", "group", (F.col("shared") / size).alias("share"))
    placed = materialize(placed, "jaccard-groups")
    pivots = placed.groupBy("group").agg(F.max(F.struct("share", "class")).alias("top"))
    return placed.join(pivots.select("group", F.col("top.class").alias("pivot")), "group").drop("share")


def _placed(sets: DataFrame, percent: int) -> DataFrame:
    """Each class against its group's pivot.

    ``near`` is the distance, ``inside`` tells if it is a link, ``common`` and
    ``base`` are the sizes of what they share and of the pivot. Of the set itself
    go on: ``added``, what the pivot lacks, and ``part``, of the pivot what the set
    has (``far``) or lacks, whichever is less.
    """
    right = sets.filter(F.col("class") == F.col("pivot")).select("group", F.col("shingles").alias("right"))
    rows = sets.join(right, "group").select(
        "class", "group", "pivot", F.size("shingles").alias("n"), F.size("right").alias("base"),
        F.array_intersect("shingles", "right").alias("kept"), F.array_except("right", "shingles").alias("missing"),
        F.array_except("shingles", "right").alias("added"),
    )
    common, far = F.size("kept"), F.size("kept") < F.size("missing")
    union = F.col("n") + F.col("base") - common
    rows = rows.select(
        "class", "group", "pivot", (1 - common / union).alias("near"), (100 * common >= percent * union).alias("inside"),
        "n", "base", far.alias("far"), F.when(far, F.col("kept")).otherwise(F.col("missing")).alias("part"), "added",
    )
    return materialize(rows, "jaccard-placed")


def _sizes(placed: DataFrame, percent: int, block: int) -> DataFrame:
    """Per group with documents outside its ball: in how many blocks its parts enter tiles."""
    edge = ~F.col("inside") & (F.col("near") <= 2 * _radius(percent))

    def blocks(test: Column) -> Column:
        shingles = F.sum(F.when(test, F.size("added") + F.size("part")).otherwise(0))
        return F.greatest(F.ceil(F.count_if(test) / F.lit(block)), F.ceil(shingles / F.lit(SHINGLES)), F.lit(0)).cast("int")

    counts = placed.groupBy("group").agg(
        blocks(~F.col("inside")).alias("outs"), blocks(F.col("inside")).alias("ins"), blocks(edge).alias("edges"),
        F.count_if(~F.col("inside")).alias("outside"), F.count_if(edge).alias("at_edge"),
    )
    counts = counts.filter("outside > 0").withColumns(
        {"outs": F.greatest("outs", F.lit(1)), "ins": F.greatest("ins", F.lit(1)), "edges": F.when(F.col("at_edge") > 0, F.greatest("edges", F.lit(1))).otherwise(0)}
    )
    return counts.drop("outside", "at_edge")


def _radius(percent: int) -> float:
    return 1 - percent / 100 + 1e-9


def _tiles(placed: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """``group, kind, i, j, side`` and the columns of the class: where each class meets others.

    Documents inside a pivot's ball are one component already. Those outside are
    dealt into blocks, one if they are few; each two blocks meet in a tile ("out",
    none if ``outs`` is 0). Those in the boundary, up to twice the radius, meet the
    ball as well ("edge"); by the triangle inequality no others can be linked to it.
    """
    edge = ~F.col("inside") & (F.col("near") <= 2 * _radius(percent))
    rows = placed.join(sizes, "group").withColumn("edge", edge)

    def block(of: str) -> Column:
        return F.pmod(F.xxhash64("class"), F.greatest(F.col(of), F.lit(1))).cast("int")

    def upto(of: str) -> Column:
        return F.when(F.col(of) > 0, F.sequence(F.lit(0), F.col(of) - 1)).otherwise(F.array().cast("array<int>"))

    def tile(kind: str, i: Column, j: Column, side: int) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), F.lit(side).alias("side"))

    out = F.transform(upto("outs"), lambda o: tile("out", F.least(o, block("outs")), F.greatest(o, block("outs")), 0))
    at_edge = F.transform(upto("ins"), lambda i: tile("edge", i, block("edges"), 0))
    ball = F.transform(upto("edges"), lambda e: tile("edge", block("ins"), e, 1))
    none = F.array().cast("array<struct<kind: string, i: int, j: int, side: int>>")
    where = F.when(F.col("inside"), ball).otherwise(F.concat(out, F.when(F.col("edge"), at_edge).otherwise(none)))
    return rows.select("group", "class", "near", "n", "base", "far", "part", "added", F.inline(where))


def _tile_links(percent: int):
    """Links between the classes of one tile, as few as tie the linked ones together.

    What two sets share is what both add to the pivot and what both keep of it. The
    first is counted directly. The second follows from the parts: of two that keep
    little, the parts' common shingles; of one that lacks little and one that keeps
    little, the kept ones that are not lacking; of two that lack little, the pivot
    without both parts.
    """
    radius = _radius(percent)

    def run(table: pa.Table) -> pa.Table:
        names = table["class"].to_pylist()
        m = len(names)
        near, side = table["near"].to_numpy(), table["side"].to_numpy()
        sizes = table["n"].to_numpy().astype(np.int64)
        far = table["far"].to_numpy(zero_copy_only=False).astype(bool)
        base, at_edge = int(table["base"][0].as_py()), table["kind"][0].as_py() == "edge"
        added, part = Shared(table["added"]), Shared(table["part"])
        root, found = np.arange(m), []
        asked = np.flatnonzero(side == (0 if (side == 0).sum() <= (side == 1).sum() else 1)) if at_edge else np.arange(m)
        for x in asked:
            others = (root != root[x]) & (np.abs(near - near[x]) <= radius)
            if at_edge:
                others &= side != side[x]
            if not others.any():
                continue
            both = part.counts(x)
            if far[x]:
                both = np.where(far, both, part.sizes[x] - both)
            else:
                both = np.where(far, part.sizes - both, base - part.sizes[x] - part.sizes + both)
            common = both + added.counts(x)
            linked = np.flatnonzero(others & (100 * common >= percent * (sizes + sizes[x] - common)))
            roots, some = np.unique(root[linked], return_index=True)
            for old, y in zip(roots, linked[some], strict=True):
                root[root == old] = root[x]
                found.append((names[x], names[y]))
        return pa.table({"u": pa.array([x for x, _ in found], pa.binary()), "v": pa.array([y for _, y in found], pa.binary())})

    return run


class Shared:
    """How many shingles each list has in common with one of them."""

    def __init__(self, column: pa.ChunkedArray):
        lists = column.combine_chunks()
        self.sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        owner = np.repeat(np.arange(len(lists)), self.sizes)
        _, token, times = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
        several = times[token] > 1
        owner, self.token = owner[several], token[several]
        self.having = owner[np.argsort(self.token, kind="stable")]
        self.times = np.bincount(self.token, minlength=len(times))
        self.first = np.r_[0, np.cumsum(self.times)]
        self.bounds = np.searchsorted(owner, np.arange(len(lists) + 1))

    def counts(self, x: int) -> np.ndarray:
        mine = self.token[self.bounds[x] : self.bounds[x + 1]]
        if not len(mine):
            out = np.zeros(len(self.sizes), np.int64)
        else:
            each = self.times[mine]
            at = np.repeat(self.first[mine] - np.r_[0, np.cumsum(each)[:-1]], each) + np.arange(each.sum())
            out = np.bincount(self.having[at], minlength=len(self.sizes))
        out[x] = self.sizes[x]
        return out


def _joined(
    sets: DataFrame, members: DataFrame, sketches: DataFrame, percent: int, block: int = BLOCK, depth: int = DEPTH
) -> DataFrame | None:
    """``class, component`` of the classes with links; None if there are none."""
    found, placed = [], _placed(sets, percent)
    for level in range(depth):
        sizes = materialize(_sizes(placed, percent, block), "jaccard-sizes")
        again = (F.col("outs") > 1) & F.lit(level + 1 < depth)
        here = sizes.withColumn("outs", F.when(again, 0).otherwise(F.col("outs")))
        met = _tiles(placed, here, percent).groupBy("group", "kind", "i", "j").applyInArrow(_tile_links(percent), "u binary, v binary")
        inside = placed.filter("inside and class <> pivot").select(F.col("class").alias("u"), F.col("pivot").alias("v"))
        found.append(materialize(met.unionByName(inside), "jaccard-found"))
        large = sizes.filter(again).select("group")
        if large.isEmpty():
            break
        outside = placed.filter("NOT inside").join(large, "group", "left_semi").select("class")
        left = materialize(members.join(outside, "class", "left_semi"), "jaccard-left")
        groups = materialize(_groups(left, sketches, percent), "jaccard-regrouped")
        placed = _placed(sets.select("class", "shingles").join(groups, "class"), percent)
    links = reduce(DataFrame.unionByName, found)
    if links.isEmpty():
        return None
    return components(links).withColumnRenamed("node", "class")


def link(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    percent: int = PERCENT,
    k: int = WORDS,
    block: int = BLOCK,
    depth: int = DEPTH,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, row, row2, component`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable by links, ``row`` and ``row2``
    hashes of id and text. Ids may be NULL or shared by unlinked documents;
    ``component``, the smallest class hash, belongs to one component only. It is
    NULL without words.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), *_row_keys(text, doc_id), F.col(text).alias("text"))
    texts = rows.select("row", "row2", "text")
    stored = materialize(_windows(rows, _shared_levels(texts, k), k, percent), "jaccard-windows")
    members = materialize(_regions(stored), "jaccard-regions")
    first = stored.join(members.select("class").distinct(), "class", "left_semi").groupBy("class")
    first = first.agg(F.min(F.struct("row", "row2")).alias("first"), F.first("sketch").alias("sketch"))
    first = materialize(first.select("class", "first.row", "first.row2", "sketch"), "jaccard-first")
    sketches = first.select("class", "sketch")
    wanted = materialize(first.drop("sketch").join(_groups(members, sketches, percent), "class"), "jaccard-wanted")
    sets = materialize(_sets(texts, wanted, k), "jaccard-sets")
    nodes = _joined(sets, members, sketches, percent, block, depth)
    classes = stored.filter("n > 0").groupBy("class").agg(F.min("doc_id").alias("low"))
    if nodes is None:
        classes = classes.withColumn("component", F.col("class"))
    else:
        classes = classes.join(nodes, "class", "left").withColumn("component", F.coalesce("component", "class"))
        lowest = classes.groupBy("component").agg(F.min("low").alias("lowest"))
        classes = classes.join(lowest, "component").select("class", "component", F.col("lowest").alias("low"))
    classes = classes.withColumn("known", F.lit(True))
    own = F.when(F.col("known"), F.col("low")).otherwise(F.col("doc_id"))
    ids = F.when(F.col("n") > 0, F.col("class"))  # empty sets match no class
    return (
        stored.select("doc_id", "row", "row2", "n", ids.alias("class"))
        .join(classes, "class", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), "row", "row2", "component")
    )


def representatives(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT, k: int = WORDS) -> DataFrame:
    """One document of each component, with all columns: the smallest id.

    Of repeated rows one stays; documents without words all stay, NULL ids
    belong to the component of their text.
    """
    keys = ["row", "row2"]
    with scratch(docs.sparkSession) as keep:  # sets and tiles are of no more use then
        found = keep(materialize(link(docs, text, doc_id, percent, k), "jaccard-links"))
    real = found.filter("n_shingles > 0")
    first = real.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *keys)).alias("first"))
    kept = first.select("first.row", "first.row2").distinct()
    keyed = docs.select(*_row_keys(text, doc_id), F.struct(*docs.columns).alias("doc"))
    empty = found.filter("n_shingles = 0").select(*keys).distinct()
    twice = real.join(kept, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    chosen = materialize(twice.unionByName(empty.withColumn("copies", F.lit(0).cast("long"))), "jaccard-kept")
    once = keyed.join(materialize(chosen.filter("copies <= 1").select(*keys), "jaccard-once"), keys)
    # Repeated rows are few or none: a table of their own is small enough to broadcast.
    several = keyed.join(materialize(chosen.filter("copies > 1").select(*keys), "jaccard-several"), keys)
    return once.unionByName(several.dropDuplicates(keys)).select("doc.*")
