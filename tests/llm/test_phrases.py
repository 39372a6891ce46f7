import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from stpanel.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase int, n string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text):
    for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
        words = re.findall("[^\x20\x09]+", piece)
        for k in range(1, 5):
            for i in range(len(words) - k + 1):
                yield tuple(words[i : i + k])


def plain(rows, top):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for g in grams(text):
            counts[lang or "und"][g] += 1
            total[lang or "und"] += len(g) == 1
    out = []
    for lang, f in counts.items():
        often = {g: a for g, a in f.items() if len(g) > 1 and a >= 30}
        inside = defaultdict(int)
        for g, a in often.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    inside[g[i : i + k]] = max(inside[g[i : i + k]], a)
        found = []
        for g, a in often.items():
            if 100 * inside[g] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def sample(seed, vocabulary=14, docs=250):
    """Skewed words, fixed expressions and a passage that many documents share."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "x y", "Ab"]
    passage = "one two three four five six seven eight"
    rows = []
    for i in range(docs):
        told = [r.choice(words[: r.randint(1, len(words))]) for _ in range(r.randint(0, 40))]
        if r.random() < 0.3:
            told.insert(r.randint(0, len(told)), passage if r.random() < 0.9 else "two three four")
        if r.random() < 0.4:
            told.insert(0, "in  fact\tso")
        for _ in range(r.randint(0, 4)):
            told.insert(r.randint(0, len(told)), r.choice([".", ",", "\n", "\x0b", "?"]))
        rows.append((i, r.choice([" ", " ", "  "]).join(told), r.choice(["en", "en", "en", "de", None])))
    return rows + [(None, None, "en"), (1, "", "en"), (2, " \t", "xx"), *rows[:20]]


def got(spark, rows, top, **options):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in phrases.collocations(docs, top=top, **options).collect())


@pytest.mark.parametrize(("seed", "top", "rank"), [(1, 2000, 1.5), (2, 3, 1.5), (3, 12, 0.3), (4, 40, 1.0)])
def test_against_plain(spark, seed, top, rank):
    """Small tops leave branches unexpanded; low ranks need several rounds."""
    rows = sample(seed, vocabulary=10 + 8 * seed)
    assert got(spark, rows, top, first_rank=rank) == plain(rows, top)


def test_floors_spare_branches(spark):
    rows = sample(5, vocabulary=5, docs=400)
    docs = spark.createDataFrame([r[1:] for r in rows], "text string, lang string").na.fill({"lang": "und", "text": ""})
    words = phrases.count_words(docs).filter("phrase <> ''").cache()
    one = phrases.sketch(words, 1)
    two = phrases.count(docs, 2, phrases.pairs, one).cache()
    second = phrases.sketch(two, 2)
    all_of = phrases.count(docs, 3, phrases.triples, one, second, {}).count()
    high = dict.fromkeys(["en", "de", "und", "xx"], 900_000)
    assert 0 < phrases.count(docs, 3, phrases.triples, one, second, high).count() < all_of


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "a b " * 40, None)], [(1, "a b " * 29, "en")], [(1, "a " * 100, "en")] * 2])
def test_small(spark, rows):
    assert got(spark, rows, 2000) == plain(rows, 2000)


def test_long_text(spark):
    r = random.Random(9)
    long = " ".join(r.choice(["alpha", "beta", "gamma", "delta", "word"]) for _ in range(900_000))
    rows = [(1, long, "en"), (2, "x" * 3_000_000 + " y", "en")]
    assert got(spark, rows, 2000) == plain(rows, 2000)


@pytest.mark.parametrize("size", [1, 7, 64, 1000])
def test_chunks_lose_and_repeat_nothing(monkeypatch, size):
    monkeypatch.setattr(phrases, "CHUNK", size)
    rows = sample(7, docs=25) + [(0, "a, b;  c\td e.f g h " * 20, "en")]
    texts, langs = [(t or "").encode() for _, t, _ in rows], [n or "und" for _, _, n in rows]
    found = Counter()
    for chunk in phrases.chunks(texts, langs):
        for k in range(1, 5):
            batch = phrases.table(chunk, k, np.flatnonzero(chunk.whole(k)))
            for r in batch.to_pylist():
                found[r["lang"], r["phrase"]] += r["n"]
    expected = Counter((n or "und", " ".join(g)) for _, t, n in rows for g in grams(t))
    assert found == expected


def test_bytes_that_are_not_text():
    chunk = next(phrases.chunks([b"a \xff\xfe b", None], ["en", "en"]))
    assert phrases.table(chunk, 1, np.arange(3)).column("n").to_pylist() == [1, 1, 1]


def test_equal_first_hashes_are_told_apart():
    """Different words with one equal hash are separate phrases by the other."""
    chunk = next(phrases.chunks([b"a b a c"], ["en"]))
    chunk.hashes[0][:] = 7
    assert sorted(phrases.table(chunk, 1, np.arange(4)).column("n").to_pylist()) == [1, 1, 2]
