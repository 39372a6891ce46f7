import math
import zlib
from collections import Counter

import numpy as np

from stpanel.llm import pseudo

TEXTS = [(1, "the cat sat on the mat"), (2, ""), (3, None), (4, "Été"), (None, "the " * 40_000), (1, "the cat sat on the mat")]


def plain(network, frequent, text):
    """Word by word, with plain sums."""
    words = pseudo.Classes(frequent).number(pseudo.split(text)).tolist()
    total = 0.0
    for i, w in enumerate(words):
        offsets = [o for o in range(-pseudo.SPAN, pseudo.SPAN + 1) if o]
        near = [words[i + o] if 0 <= i + o < len(words) else pseudo.EDGE for o in offsets]
        h = np.tanh(sum(network.near[j][c].astype(float) for j, c in enumerate(near)) + network.bias)
        scores = h @ network.out + network.prior
        total += scores[w] - math.log(np.exp(scores).sum())
    return len(words), total


def test_scores_against_plain(spark):
    r = np.random.default_rng(0)
    network = pseudo.Network.start()
    network.out = r.normal(0, 0.5, network.out.shape).astype(np.float32)
    docs = spark.createDataFrame([(*t, "n") for t in TEXTS], "doc_id long, text string, n_words string")
    rows = pseudo.score(docs, network, ["the", "cat"]).collect()
    assert len(rows) == len(TEXTS)
    by_id = {r["doc_id"]: r for r in rows}
    for i, text in dict(TEXTS).items():
        n, total = plain(network, ["the", "cat"], text) if i is not None else (40_000, by_id[None]["log_prob"])
        assert by_id[i]["n_words"] == n
        assert math.isclose(by_id[i]["log_prob"], total, rel_tol=1e-4, abs_tol=1e-4)
        assert by_id[i]["score"] == (by_id[i]["log_prob"] / n if n else None)


def test_rare_words_have_a_share_of_their_class(spark):
    """Sums over tokens: log p(class) + log p(word | class), with counts of the whole corpus."""
    texts = [(1, "the plain words here plain words"), (2, "zxqv the"), (None, "plain " * 500), (None, None), (5, "words " * 90 + "Été")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    network, frequent, counts = pseudo.Network.start(), ["the"], pseudo.word_counts(docs)
    met = Counter(w for _, t in texts for w in pseudo.split(t))
    totals = Counter()
    for w, n in met.items():
        totals[zlib.crc32(w.encode()) % pseudo.HASHED] += n if w != "the" else 0
    rows = pseudo.score(docs, network, frequent, counts=counts).collect()
    wanted = []
    for i, t in texts:
        n, total = plain(network, frequent, t)
        inner = [met[w] / totals[zlib.crc32(w.encode()) % pseudo.HASHED] for w in pseudo.split(t) if w != "the"]
        wanted.append((i, n, total + sum(map(math.log, inner))))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for got, (i, n, total) in zip(sorted(map(tuple, rows), key=key), sorted(wanted, key=key), strict=True):
        assert got[:2] == (i, n)
        assert math.isclose(got[2], total, rel_tol=1e-4, abs_tol=1e-4)
        assert got[3] == (got[2] / n if n else None)
    other = spark.createDataFrame([(1, "plain"), (2, "zxqv"), (3, "neverseen")], "doc_id long, text string")
    one, two, three = (r["log_prob"] for r in pseudo.score(other, network, frequent, counts=spark.createDataFrame(
        [("plain", 500), ("zxqv", 1), *((f"w{i}", 100) for i in range(2000))], "word string, n long")).orderBy("doc_id").collect())
    assert one > two + 5 and one > three + 5


def test_a_word_never_predicts_itself():
    words, near = pseudo.windows([np.array([5, 6, 7]), np.array([], int), np.array([8])])
    assert words.tolist() == [5, 6, 7, 8]
    e = pseudo.EDGE
    assert near.T.tolist() == [[e, e, 6, 7], [e, 5, 7, e], [5, 6, e, e], [e, e, e, e]]


def test_training_beats_chance_and_shuffled_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    frequent = pseudo.frequent_words(docs)
    network = pseudo.fit(docs, frequent)
    again = pseudo.fit(docs, frequent)
    assert np.array_equal(network.flat(), again.flat())
    rows = pseudo.score(docs, network, frequent).agg({"log_prob": "sum", "n_words": "sum"}).first()
    mean = rows["sum(log_prob)"] / rows["sum(n_words)"]
    assert mean > -0.95 * math.log(pseudo.CLASSES)
    good = [r["text"] for r in docs.select("text").limit(200).collect()]
    rng = np.random.default_rng(1)
    mixed = [" ".join(rng.permutation(t.split())) for t in good]
    mixed = ["".join(rng.permutation(list(t))) for t in mixed]
    counts = pseudo.word_counts(docs)

    def score(texts):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
        found = pseudo.score(rows, network, frequent, counts=counts).agg({"log_prob": "sum", "n_words": "sum"}).first()
        return found["sum(log_prob)"] / found["sum(n_words)"]

    assert score(good) > score(mixed) + 1


def test_neighbours_help(spark):
    """Held-out words are likelier given their neighbours than by their frequency, and less so among others."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(4000)
    seen, unseen = docs.filter("doc_id % 10 <> 3"), docs.filter("doc_id % 10 = 3")
    frequent = pseudo.frequent_words(seen)
    network = pseudo.fit(seen, frequent)
    classes = pseudo.Classes(frequent)
    numbered = [[classes.number(pseudo.split(r["text"])) for r in d.select("text").collect()] for d in (seen, unseen)]
    share = np.bincount(np.concatenate(numbered[0]), minlength=pseudo.CLASSES) + 1.0
    plain = np.log(share / share.sum())[np.concatenate(numbered[1])].mean()
    rng = np.random.default_rng(2)
    everything = rng.permutation(np.concatenate(numbered[1]))
    cuts = np.cumsum([len(n) for n in numbered[1]])[:-1]
    given = network.log_probabilities(*pseudo.windows(numbered[1])).mean()
    assert given > plain + 0.3
    assert given > network.log_probabilities(*pseudo.windows(np.split(everything, cuts))).mean() + 0.3


def test_every_document_trains(spark, monkeypatch):
    monkeypatch.setattr(pseudo, "SHARD_WORDS", 50)
    rows = [(i if i % 2 else None, " ".join([f"w{i:02}"] * 50)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    network = pseudo.fit(docs, [f"w{i:02}" for i in range(30)])
    assert network.prior[:30].min() > network.prior[30:].max()


def test_frequent_words_count_everything(spark):
    docs = spark.createDataFrame([(1, "b b a"), (2, "A c"), (3, None)], "doc_id long, text string")
    assert pseudo.frequent_words(docs) == ["a", "b", "c"]
    assert pseudo.frequent_words(docs, most=2) == ["a", "b"]


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    network = pseudo.fit(none, pseudo.frequent_words(none))
    assert pseudo.score(none, network, []).collect() == []
    rows = pseudo.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), network, []).collect()
    assert math.isclose(rows[0]["score"], -math.log(pseudo.CLASSES), rel_tol=1e-5)


def test_only_words_beyond_the_head_are_joined(spark, monkeypatch):
    """Scores are the same with shares at hand, joined, or both; only the rest is handed to the join."""
    texts = [(1, "the plain words here plain words"), (2, "zxqv the"), (None, "plain " * 50), (None, None), (5, "words " * 9 + "Été")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    network, counts = pseudo.Network.start(), pseudo.word_counts(docs)
    joined, shares, found = [], pseudo._shares, []
    monkeypatch.setattr(pseudo, "_shares", lambda rare, others: joined.append(rare.count()) or shares(rare, others))
    for head in (100, 2, 0):
        monkeypatch.setattr(pseudo, "HEAD", head)
        rows = pseudo.score(docs, network, ["the"], counts=counts).collect()
        found.append(sorted((r["doc_id"] or 0, r["n_words"], round(r["log_prob"], 9)) for r in rows))
    assert joined == [0, 3, 7]
    assert found[0] == found[1] == found[2]


def test_texts_are_split_once_for_training_and_scoring(spark):
    """With the coded form at hand, neither reads a text again; results are the same."""
    texts = [(1, "the plain words here plain words"), (2, "zxqv the"), (None, "plain " * 50), (None, None), (5, "words " * 9 + "Été"), (2, "zxqv the")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    counts, frequent = pseudo.word_counts(docs), ["the", "plain"]
    known = pseudo.coded(docs, frequent, counts=counts)
    gone = docs.limit(0)
    network = pseudo.fit(gone, frequent, known=known)
    assert np.array_equal(network.flat(), pseudo.fit(docs, frequent).flat())
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(map(tuple, pseudo.score(gone, network, frequent, counts=counts, known=known).collect()), key=key)
    assert got == sorted(map(tuple, pseudo.score(docs, network, frequent, counts=counts).collect()), key=key)
    assert [r[:2] for r in got] == [(1, 6), (2, 2), (2, 2), (5, 10), (None, 0), (None, 50)]


def test_training_against_plain_steps():
    r = np.random.default_rng(3)
    words, near = pseudo.windows([r.integers(0, pseudo.CLASSES, n) for n in (300, 0, 1, 400)])
    network, plain = pseudo.Network.start(), pseudo.Network.start()
    plain.near, plain.bias, plain.out, plain.prior = weights = [w.astype(float) for w in (plain.near, plain.bias, plain.out, plain.prior)]
    sums = [np.full_like(w, 1e-2) for w in weights]
    for s in range(0, len(words), 256):
        w, c = words[s : s + 256], near[:, s : s + 256]
        h = np.tanh(sum(plain.near[i][c[i]] for i in range(len(c))) + plain.bias)
        p = np.exp(h @ plain.out + plain.prior)
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(w)), w] -= 1
        back = (p @ plain.out.T) * (1 - h * h)
        slopes = [np.zeros_like(plain.near), back.sum(0), h.T @ p, p.sum(0)]
        for i in range(len(c)):
            np.add.at(slopes[0][i], c[i], back)
        for weight, total, slope in zip(weights, sums, slopes, strict=True):
            total += (slope / len(w)) ** 2
            weight -= 0.3 * slope / len(w) / np.sqrt(total)
    network.train(words.astype(np.uint8), near.astype(np.uint8), 0.3)
    assert np.allclose(network.flat(), plain.flat(), atol=1e-5)


def test_large_weights_are_clipped():
    network = pseudo.Network.start()
    network.prior[:2] = 1e4, -1e4
    words, near = pseudo.windows([np.array([0, 1, 2] * 100)])
    logs = network.log_probabilities(words, near)
    assert np.allclose(logs[:3], [0, -120, -60], atol=1e-3)
    network.train(words, near, 0.3)
    assert np.isfinite(network.flat()).all()


def test_windows_of_nothing():
    for numbered in ([], [np.zeros(0, np.uint8)]):
        words, near = pseudo.windows(numbered)
        assert words.shape == (0,) and near.shape == (2 * pseudo.SPAN, 0)
