import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from stpanel.llm import trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def plain(rows):
    """Every node from all prefixes of the rebuilt conversations."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))

    def digest(t):
        return hashlib.sha256(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).digest()

    for c in own:
        own[c] = [t[2:] for t in sorted(own[c], key=lambda t: (t[:2], digest(t)))]
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        cost = (len(members[p]) - 1) * words(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += cost
    out = []
    for p, m in members.items():
        told = ",".join(map(str, sorted(ends.get(p, []))))
        above = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), above, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(told.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows):
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, path int, n string")
    df = trie.trie(turns)
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def sample(seed, n=160):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        c = r.choice([r.randint(0, 200), r.randint(-50, 60), 10**12 + r.randint(0, 40)])
        for t in range(r.randint(1, 6)):
            rows.append((c, r.choice([t, t, t, None]), r.choice(["user", "user", "bot", None]), r.choice(["a b", "hi", "hi", "x y z", "", None])))
    rows += [(None, 0, "user", "nobody"), *rows[:7]]
    hot = [(0, "user", "same start"), (1, "bot", "a long answer here"), (2, "user", "same start")]
    rows += [(1000 + c, *t) for c in range(60) for t in hot]
    rows += [(5000, t, "user", f"turn {t // 2}") for t in range(300)] + [(5020, t, "user", f"turn {t // 2}") for t in range(280)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("parts", [1, 3, 8, 40])
def test_against_plain(spark, parts):
    """Few and many ranges: boundaries fall inside shared prefixes."""
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = sample(parts)
        assert got(spark, rows) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(None, 0, "user", "a")],
        [(40, 0, "user", "a b")],
        [(21, 0, None, None)],
        [(c, 0, "u", "t") for c in range(25)],
        [(7, 0, "user", "word " * 50_000), (7, 1, "bot", "x" * 300_000), (8, 0, "user", "word " * 50_000)],
    ],
)
def test_small(spark, rows):
    assert got(spark, rows) == plain(rows)


def test_roles_and_texts_do_not_run_together(spark):
    rows = [(20, 0, "ab", "c"), (40, 0, "a", "bc"), (60, 0, "", "abc")]
    root = next(r for r in got(spark, rows) if r[1] == 0)
    assert root[4] == 3


def test_forest_by_hand():
    """Paths (a), (a, b), (a, c), (d) as one range."""
    forest = trie.Forest([1, 2, 2, 1], [-1, 1, 1, 0], -1, [2, 1, 1, 3], [5, 1, 9, 4], [[0, 10], [0, 10, 11], [0, 10, 12], [0, 7]])
    found = {(i, d): rest for i, d, *rest in forest.nodes()}
    assert found[0, 0] == [False, True, 7, 1, 2, 3, 3 * 10 + 2 * 7]
    assert found[0, 1] == [False, True, 4, 1, 2, 2, 30]
    assert found[1, 2] == [False, True, 1, 1, 0, 1, 0]
    assert found[3, 1] == [False, True, 3, 4, 0, 1, 14]
    assert len(found) == 5


def test_word_count(spark):
    from pyspark.sql import functions as F

    texts = ["", " ", "a", " a", "a ", "\t a\x0b\x0cb\r\n", "a b c", "x" * 10]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", trie.word_count(F.col("t")).alias("n")).collect()
    assert all(r["n"] == words(r["t"]) for r in rows)
