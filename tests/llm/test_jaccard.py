import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from stpanel.llm import graph, jaccard, shingles

SPACES = "\x20\t\n\x0b\x0c\r"


def plain_set(text, k=5):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for s in SPACES:
        text = text.replace(s, " ")
    words = [w for w in text.split(" ") if w]
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def plain_components(rows):
    """Brute force: (doc_id, n, smallest linked id) of rows of (doc_id, text)."""
    classes = defaultdict(list)
    for d, t in rows:
        classes[plain_set(t)].append(d)
    sets = [s for s in classes if s]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        seen = defaultdict(int)
        for x in s:
            for j in holders[x]:
                seen[j] += 1
        for j, both in seen.items():
            if j < i and 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    low = defaultdict(list)
    for i, s in enumerate(sets):
        low[root(i)] += [d for d in classes[s] if d is not None]
    where = {s: root(i) for i, s in enumerate(sets)}
    return sorted(
        ((d, len(plain_set(t)), min(low[where[plain_set(t)]], default=None) if plain_set(t) else d) for d, t in rows), key=order
    )


def order(row):
    return tuple((x is None, x or 0) for x in row)


def check(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, row string, n int")
    got = sorted((tuple(r)[:3] for r in jaccard.link(docs, **options).collect()), key=order)
    assert got == plain_components(rows)


def copies(r, base, n, edits):
    for _ in range(n):
        words = list(base)
        for _ in range(r.randint(0, edits)):
            words[r.randrange(len(words))] = f"e{r.randrange(10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize("seed", range(2))
def test_groups_and_passages(spark, seed):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(3000)}"
    texts = []
    for size, n, edits in ((60, 40, 4), (200, 30, 9), (12, 25, 1), (30, 60, 2), (6, 20, 1)):
        texts += copies(r, [word() for _ in range(size)], n, edits)
    passage = [word() for _ in range(60)]
    texts += [" ".join([*(word() for _ in range(r.randint(0, 40))), *passage, *(word() for _ in range(r.randint(0, 40)))]) for _ in range(60)]
    texts += [" ".join(word() for _ in range(r.randint(0, 9))) for _ in range(80)]
    texts += ["a b", "A  B", "a b c", "É x", "é x", "", None, " \n", "a b"]
    texts += r.sample(texts, 30)
    r.shuffle(texts)
    check(spark, list(enumerate(texts)))


@pytest.mark.parametrize(("block", "depth"), [(3, 1), (3, 5)])
def test_many_tiles_and_levels(spark, monkeypatch, block, depth):
    """With all shared shingles alike and tiny blocks, groups take new pivots or many tiles."""
    monkeypatch.setattr(jaccard, "LEVELS", (2,))
    r = random.Random(9)
    chain = [f"c{i}" for i in range(120)]
    texts = [" ".join(chain[i : i + 60]) for i in range(0, 60, 3)]
    passage = [f"p{i}" for i in range(30)]
    texts += [" ".join([*passage, *(f"q{r.randrange(10**6)}" for _ in range(10))]) for _ in range(15)]
    texts += copies(r, [f"b{i}" for i in range(80)], 40, 6)
    check(spark, list(enumerate(texts)), block=block, depth=depth)


def test_links_of_a_tile_are_counted_from_differences():
    """Sets around a pivot, joined from what they lack of it and add to it."""
    r = np.random.default_rng(3)
    pivot = set(range(100))
    sets = []
    for _ in range(60):
        s = set(r.choice(100, 100 - r.integers(0, 25), replace=False).tolist()) | set(r.integers(200, 260, r.integers(0, 20)).tolist())
        sets.append(s)
    sets += [set(r.integers(0, 400, 60).tolist()) for _ in range(20)]
    sets += [s | {500} for s in sets[-5:]]
    near = [1 - len(s & pivot) / len(s | pivot) for s in sets]
    far = [len(s & pivot) < len(pivot - s) for s in sets]
    assert 0 < sum(far) < len(sets)
    table = pa.table(
        {
            "class": pa.array([bytes([i]) for i in range(len(sets))], pa.binary()), "kind": ["out"] * len(sets),
            "side": pa.array([0] * len(sets), pa.int32()), "near": near, "n": [len(s) for s in sets], "base": [100] * len(sets), "far": far,
            "part": pa.array([sorted(s & pivot if f else pivot - s) for s, f in zip(sets, far, strict=True)], pa.list_(pa.int64())),
            "added": pa.array([sorted(s - pivot) for s in sets], pa.list_(pa.int64())),
        }
    )
    found = jaccard._tile_links(80)(table)
    parent = list(range(len(sets)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for u, v in zip(found["u"].to_pylist(), found["v"].to_pylist(), strict=True):
        a, b = sets[u[0]], sets[v[0]]
        assert 100 * len(a & b) >= 80 * len(a | b) and root(u[0]) != root(v[0])
        parent[root(u[0])] = root(v[0])
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                assert root(i) == root(j)


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted(tuple(r)[:3] for r in jaccard.link(docs).collect()) == plain_components(rows)


@pytest.mark.parametrize(
    "rows",
    [[], [(1, None)], [(1, ""), (2, " ")], [(None, "a b c d e f"), (None, "a b c d e f")], [(3, "x y"), (None, "x y"), (3, "x y"), (2, None), (2, None)]],
)
def test_small_tables(spark, rows):
    check(spark, rows)


def test_long_text(spark):
    long = " ".join(f"w{i}" for i in range(250_000))
    check(spark, [(1, long), (2, long + " more"), (3, "short one")])


def test_pieces_do_not_change_hashes(monkeypatch):
    r = random.Random(2)
    texts = ["".join(r.choice("ab \n\tCé") for _ in range(r.randint(0, 300))) for _ in range(50)]
    whole = shingles.shingle_sets(texts)
    monkeypatch.setattr(shingles, "PIECE", 7)
    assert all(np.array_equal(a, b) for a, b in zip(whole, shingles.shingle_sets(texts), strict=True))
    assert [len(s) for s in whole] == [len(plain_set(t)) for t in texts]


def test_representatives(spark):
    r = random.Random(4)
    base = [f"w{i}" for i in range(50)]
    texts = [*copies(r, base, 10, 2), "one two", "one two", "", "", None]
    rows = [(100 - i, t, "src") for i, t in enumerate(texts)] + [(100, texts[0], "src"), (None, texts[1], "src")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_shingles string")
    kept = jaccard.representatives(docs)
    assert kept.columns == docs.columns
    groups = {(i, n): c for i, n, c in plain_components([x[:2] for x in rows])}
    filled = {c for (_, n), c in groups.items() if n}
    got = sorted(x["doc_id"] for x in kept.collect())
    assert got == sorted([*filled, *(i for i, n in groups if not n)])


def test_representatives_of_unrelated_documents_without_own_ids(spark):
    """A NULL or shared id ties no documents together; links still do."""
    long = [f"w{i}" for i in range(50)]
    lost = ["alpha beta gamma delta epsilon", "one two three four five"]
    rows = [(None, t) for t in lost] + [(7, "six seven eight nine ten"), (7, "red green blue white black")]
    rows += [(None, " ".join(long)), (None, " ".join([*long, "more"])), (7, "Alpha beta gamma delta epsilon")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in jaccard.representatives(docs).collect()]
    pair = [r for r in kept if r[1].startswith("w0 ")]
    assert len(pair) == 1
    rest = [(7, "six seven eight nine ten"), (7, "red green blue white black"), (None, lost[1]), (7, "Alpha beta gamma delta epsilon")]
    assert sorted((r for r in kept if r not in pair), key=str) == sorted(rest, key=str)


def test_components_of_chains(spark):
    edges = [(f"{i:04}", f"{i + 1:04}") for i in range(300) if i % 50 != 49] + [("0000", "0000")]
    df = spark.createDataFrame(edges, "u string, v string")
    got = {x["node"]: x["component"] for x in graph.components(df).collect()}
    assert got == {f"{i:04}": f"{i // 50 * 50:04}" for i in range(300)}


def test_sketches_lose_no_link_and_part_passages():
    """Sets that share a quarter stay apart, also long ones; linked ones of any sizes are tied."""
    r = np.random.default_rng(5)
    passage = r.integers(0, 1 << 63, 2000, dtype=np.uint64)
    sets = []
    for n in (3, 9, 40, 250, 260, 500, 900, 1030, 2040, 4090, 8200):
        first = np.r_[passage[: n // 4], r.integers(0, 1 << 63, n - n // 4, dtype=np.uint64)]
        sets.append(first)
        sets += [np.r_[first[: n - int(n * 0.09)], r.integers(0, 1 << 63, int(n * 0.09) + extra, dtype=np.uint64)] for extra in (0, n // 40)]
        if n < 5000:
            sets += [np.r_[passage[: n // 4], r.integers(0, 1 << 63, n - n // 4, dtype=np.uint64)] for _ in range(3)]
    sets = [np.unique(x) for x in sets]
    n = np.array([len(x) for x in sets])
    found = jaccard._forest(np.zeros(len(sets), int), n, jaccard.Sketches([jaccard._sketch(x) for x in sets]), 80)
    root = list(range(len(sets)))
    for i, j in found:
        root = [root[i] if x == root[j] else x for x in root]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            common = len(np.intersect1d(a, b))
            share = common / (len(a) + len(b) - common)
            if share >= 0.8:
                assert root[i] == root[j]
            elif share < 0.3 and min(len(a), len(b)) > 200:
                assert root[i] != root[j]


@pytest.mark.parametrize("block", [2, 4096])
def test_meetings_in_blocks(spark, block):
    rows = [(region, bytes([i]), 10, bytes([i // 4]) * 32) for region in (1, 2) for i in range(0, 40, region)]
    members = spark.createDataFrame([r[:3] for r in rows], "region long, class binary, n long")
    sketches = spark.createDataFrame(list({r[1]: (r[1], r[3]) for r in rows}.values()), "class binary, sketch binary")
    ties = [(u[0], v[0]) for u, v in jaccard._meetings(members, sketches, 99, block).distinct().collect()]
    root = list(range(40))
    for i, j in ties:
        root = [root[i] if x == root[j] else x for x in root]
    assert all((root[i] == root[j]) == (i // 4 == j // 4) for i in range(40) for j in range(40))


def test_regions_of_the_same_classes_are_one(spark):
    """Three copies that share 50 shingles meet once; what only two share is a region of its own."""
    shared = list(range(50))
    windows = {b"a": [*shared, 100, 101, 900], b"b": [*shared, 100, 101], b"c": shared, b"d": [901]}
    rows = [(k, len(w), w) for k, w in windows.items() for _ in range(2)]
    found = jaccard._regions(spark.createDataFrame(rows, "class binary, n long, window array<long>")).collect()
    assert len(found) == 5
    met = defaultdict(set)
    for r in found:
        met[r["region"]].add((bytes(r["class"]), r["times"]))
    assert sorted(map(sorted, met.values())) == [[(b"a", 2), (b"b", 2)], [(b"a", 50), (b"b", 50), (b"c", 50)]]


def test_ties_follow_the_classes_and_not_their_regions(spark):
    """Copies that meet in many regions, in another order in each, are tied once by a task."""
    r = random.Random(6)
    rows = [(region, bytes([i]), 10) for region in range(300) for i in r.sample(range(20), 12)]
    members = spark.createDataFrame(rows, "region long, class binary, n long").coalesce(1)
    sketches = spark.createDataFrame([(bytes([i]), bytes([i // 10]) * 32) for i in range(20)], "class binary, sketch binary")
    ties = [(u[0], v[0]) for u, v in jaccard._meetings(members, sketches, 99).collect()]
    tasks = spark.sparkContext.defaultParallelism
    assert len(ties) <= 18 * tasks
    root = list(range(20))
    for i, j in ties:
        root = [root[i] if x == root[j] else x for x in root]
    assert all((root[i] == root[j]) == (i // 10 == j // 10) for i in range(20) for j in range(20))


def test_forgetting_classes_loses_no_tie(spark, monkeypatch):
    trees = jaccard.Trees()
    monkeypatch.setattr(jaccard, "KNOWN", 3)
    assert trees.number([b"a", b"b", b"a", b"c", b"d"]).tolist() == [0, 1, 0, 2, 3]
    trees.root[1] = 0
    assert trees.number([b"b", b"e"]).tolist() == [0, 1] and trees.root.tolist() == [0, 1]


def test_bit_tables_follow_the_shared_shingles(spark):
    """At least half of a table stays free, however many shingles are shared; every shared one has its level."""
    r = np.random.default_rng(8)
    base = [f"w{x}" for x in r.integers(0, 1 << 40, 120_000)]
    texts = [" ".join(base), " ".join(base[:90_000]), *[" ".join(base[:500])] * 7, *[" ".join([*base[:40], f"x{i}"]) for i in range(60)]]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    tables = jaccard._shared_levels(docs, 5)
    for size, table in tables:
        assert np.bitwise_count(table).sum() <= len(table) * 8 / jaccard.ROOM and size % (8 * jaccard.BUCKETS) == 0
    found, n = np.unique(np.concatenate(shingles.shingle_sets(texts)), return_counts=True)
    counted = found < jaccard._LIMIT
    assert (counted & (n > 1)).sum() > 40_000
    level = jaccard._levels(found, tables)
    least = 2 * np.searchsorted(jaccard.LEVELS, n, side="right")
    assert (level[counted] >= least[counted]).all() and (level[~counted] >= 1).all()
    assert (level[counted] == least[counted]).mean() > 0.5
    assert (level[~counted & (n == 1)] == 1).mean() > 0.9


def test_shared_passages_open_no_regions(spark):
    """Documents with more of their own than the window holds do not meet by a passage, counted or not."""
    r = np.random.default_rng(9)
    passage = [f"p{i}" for i in range(60)]
    texts = [" ".join([*passage, *(f"w{x}" for x in r.integers(0, 1 << 40, 45))]) for _ in range(200)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    rows = docs.select("doc_id", *jaccard._row_keys("text", "doc_id"), "text")
    windows = jaccard._windows(rows, jaccard._shared_levels(rows.select("row", "row2", "text"), 5), 5, 80).collect()
    shared = set(shingles.shingle_sets([" ".join(passage)])[0].view(np.int64).tolist())
    assert len(windows) == 200 and not any(shared & set(x["window"]) for x in windows)


@pytest.mark.parametrize("spare", [0, 3])
def test_large_tiles_are_tied_like_small_ones(spare):
    """More rows than ``FEW`` in a tile: the trees are those of all pairs, also of rows tied before."""
    r = np.random.default_rng(10 + spare)
    sets = []
    for size in (30, 60, 61, 200, 215, 900):
        center = r.integers(0, 1 << 63, size, dtype=np.uint64)
        for _ in range(int(r.integers(1, 40))):  # a chain: each is a copy of one before
            center = np.r_[center[size // 20 :], r.integers(0, 1 << 63, size // 20, dtype=np.uint64)]
            sets.append(np.unique(center))
    sets += [np.unique(r.integers(0, 1 << 63, int(x), dtype=np.uint64)) for x in r.integers(20, 300, 60)]
    sets = [sets[i] for i in r.permutation(len(sets))]
    assert len(sets) > 2 * jaccard.FEW
    n, sketches = np.array([len(x) for x in sets]), jaccard.Sketches([jaccard._sketch(x) for x in sets])
    x, y = (a.ravel() for a in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    near = (180 * sketches.apart(x, y) <= 20 * (n[x] + n[y])) & (100 * np.minimum(n[x], n[y]) >= 80 * np.maximum(n[x], n[y]))
    wanted = list(range(len(sets)))
    root = np.arange(len(sets))
    before = list(zip(x[near].tolist(), y[near].tolist(), strict=True))
    for i, j in before:
        wanted = [wanted[i] if v == wanted[j] else v for v in wanted]
    for i, j in [p for p in before if p[0] < p[1]][:spare]:
        root[root == root[j]] = root[i]
    got = root.tolist()
    for i, j in jaccard._forest(np.zeros(len(sets), int), n, sketches, 80, np.arange(len(sets)), root.copy()):
        assert got[i] != got[j]  # a forest: no tie is there twice
        got = [got[i] if v == got[j] else v for v in got]
    assert len(set(zip(got, wanted, strict=True))) == len(set(got)) == len(set(wanted))
