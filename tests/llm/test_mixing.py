import hashlib
import random
import re
from collections import defaultdict

import pytest

from stpanel.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows):
    """taken by (doc_id, size, place) for rows of (doc_id, text, source)."""
    sized = [(d, len(WORD.findall(t or "")), s) for d, t, s in rows]
    sources = sorted({s for _, _, s in sized}, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    size = defaultdict(int)
    for _, n, s in sized:
        size[s] += n
    total, capped = sum(size.values()), set()
    while True:
        rest = total - sum(3 * size[s] for s in capped)
        free = sum(weight[s] for s in sources if s not in capped)
        target = {s: 3 * size[s] if s in capped else rest * weight[s] / free for s in sources}
        above = {s for s in sources if s not in capped and target[s] > 3 * size[s]}
        if not above:
            break
        capped |= above
    key = lambda r: (hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest()[:15], r[0] is not None, r[0], r[1])
    out = []
    for s in sources:
        before, budget = 0, int(target[s])
        for d, n, _ in sorted((r for r in sized if r[2] == s), key=key):
            taken = n * (budget // size[s]) + max(0, min(n, budget % size[s] - before)) if size[s] else 0
            before += n
            out.append((d, n, size[s], float(target[s]), taken))
    return out


def order(row):
    return tuple((x is None, x or 0) for x in row)


@pytest.mark.parametrize("seed", range(4))
def test_against_plain(spark, seed):
    r = random.Random(seed)
    rows = [
        (i, " ".join("x" * r.randint(1, 3) for _ in range(r.choice([0, 1, 5, 40]))), r.choice(["a", "a", "a", "b", "\u00e9", "Z", ""]))
        for i in range(150)
    ]
    rows += [(None, "a b c", None), (7, None, None), (7, "a\tb\x0bc\u00a0d", None), (8, "", "empty"), *rows[:5]]
    docs = spark.createDataFrame([(*x, 1, 2) for x in rows], "doc_id long, text string, source string, size int, key int")
    got = sorted((tuple(x) for x in mixing.mix(docs).collect()), key=order)
    assert got == sorted(plain(rows), key=order)


def test_copies(spark):
    rows = [(i, f"w{i} two\nthree  four", "abc"[i % 3]) for i in range(30)]
    docs = spark.createDataFrame([(*x, len(x[1])) for x in rows], "doc_id long, text string, source string, n_chars long")
    mixed = mixing.apply(docs)
    assert mixed.columns == docs.columns
    words = defaultdict(int)
    for x in mixed.collect():
        words[x["doc_id"]] += len(WORD.findall(x["text"]))
        assert dict((a, b) for a, b, _ in rows)[x["doc_id"]].startswith(x["text"])
        assert x["n_chars"] == len(x["text"])
    assert dict(words) == {d: t for d, _, _, _, t in plain(rows) if t}


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (2, " ", "b")]])
def test_nothing_to_mix(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert [r["taken"] for r in mixing.mix(docs).collect()] == [0] * len(rows)
    assert mixing.apply(docs).count() == 0


def test_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    once, again = (sorted(map(tuple, mixing.mix(docs.repartition(n)).collect())) for n in (1, 5))
    assert once == again
