import zlib

import numpy as np
import pytest

from stpanel.llm import langid


@pytest.mark.parametrize("name", ["sf0.01", "sf0.1"])
def test_held_out_accuracy(spark, name):
    docs = spark.read.parquet(f"/root/testdata/{name}/documents.parquet")
    filters = langid.learn(docs.filter(~langid.held_out()))
    rows = langid.predict(docs, filters, keep=["doc_id", "lang", langid.held_out().alias("held_out")]).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    right = [r["lang"] == r["lang_pred"] for r in rows if r["held_out"]]
    assert np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_shares_against_sets():
    """Corrected popcounts are close to the shares of n-grams that plain sets know."""
    r = np.random.default_rng(1)
    alphabets = ["abcdefgh", "efghijkl", "ijklmnop"]
    text = lambda a, n: " ".join("".join(r.choice(list(a), r.integers(1, 8))) for _ in range(n))
    known = [langid.grams([text(a, 4000)])[0] for a in alphabets]
    import pyarrow as pa

    table = pa.table(
        {"lang": np.repeat(np.arange(3, dtype=np.int32), [len(k) for k in known]), "gram": np.concatenate(known).view(np.int64)}
    )
    filters = langid._filters(["x", "y", "z"], table)
    probes = [text(a, 200) for a in alphabets] + ["", "123", "qrs"]
    shares, lettered = filters.shares(probes)
    for i, probe in enumerate(probes):
        grams = langid.grams([probe])[0]
        if len(grams):
            true = [np.isin(grams, k).mean() for k in known]
            assert np.allclose(shares[i], true, atol=0.02)
    assert lettered.tolist() == [True, True, True, False, False, True]


def test_many_languages(spark):
    """More languages than bits of one slice."""
    rows = [(i, f"{chr(0x4E00 + 40 * i)}{chr(0x4E00 + 40 * i + j)} " * 5, f"l{i}") for i in range(70) for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = langid.learn(docs)
    assert len(filters.slices) == 2
    assert all(r["lang"] == r["lang_pred"] for r in langid.predict(docs, filters, keep=["lang"]).collect())


ODD = [(1, None, None), (2, "", "en"), (3, "123 !!", "en"), (4, "ß", None), (None, "the cat", "en"), (5, "x" * 200_000, None), (6, "İI", None)]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(*r, "a", "b") for r in ODD * 2], "doc_id long, text string, lang string, score string, lang_pred string")
    filters = langid.learn(docs.filter(~langid.held_out()))
    got = sorted(tuple(r) for r in langid.predict(docs, filters, keep=["text"]).collect() if r["text"] is not None)
    assert len(got) == 12
    assert {(t or "")[:7]: p for t, p, _ in got} == {"": "und", "123 !!": "und", "ß": "en", "the cat": "en", "xxxxxxx": "en", "İI": "en"}


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    filters = langid.learn(docs)
    assert [tuple(r) for r in langid.predict(docs, filters).collect()] == [(1, "und", 0.0)]
    assert langid.predict(docs.limit(0), filters).collect() == []


@pytest.mark.parametrize("block", [1, 2, 5, 1000])
def test_blocks_lose_no_gram(block):
    texts = ["the  cat, sat!", "", None, "a", "ABC déf " * 9, "12"]
    chars, owner, _ = langid.normalised(texts)
    parts = list(langid.gram_blocks(chars, owner, block=block))
    whole = list(langid.gram_blocks(chars, owner, block=10**6))
    for i in (0, 1):
        assert np.array_equal(np.concatenate([p[i] for p in parts]), np.concatenate([w[i] for w in whole]))


def test_distinct_grams_are_reduced_in_steps(monkeypatch):
    texts = [" ".join(f"w{i % 37}x" for i in range(3000)), "the cat"]
    hashes, owner, _ = langid.grams(texts)
    want = sorted(set(zip(owner.tolist(), hashes.tolist(), strict=True)))
    monkeypatch.setattr(langid.gram_blocks, "__defaults__", (langid.SIZES, 100))
    got = langid.distinct_grams(texts)
    assert list(zip(got[1].tolist(), got[0].tolist(), strict=True)) == want


def test_memory_of_a_long_text():
    """Eight million letters need no more than a few bytes each."""
    import tracemalloc

    filters = langid.Filters(["x"], [np.zeros(1 << langid.SLOT_BITS, np.uint8)], np.zeros(1))
    text = "lorem ipsum " * 700_000
    langid.normalised(["warm"])
    tracemalloc.start()
    filters.shares([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20


def test_select_keeps_rows_whole(spark):
    rows = [(1, "the cat sat", "en", "k"), (2, None, "en", None), (3, "123", None, "x"), (4, "xqzjk", None, "y"), (5, "the cat", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string")
    kept = langid.select(docs, langid.learn(docs.limit(1)), 0.2)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[4]]
