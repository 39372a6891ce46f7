"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every word is predicted from the words on both sides of it, never from itself:
the vectors of the neighbours, one set per position, are added up, squashed, and
turned into probabilities of all word classes, which are multiplied by the share
of the word in its class. The logarithms over a document's words add up to its score.

Word classes are the most frequent words of the whole corpus, one class each, and
hashed classes that share the other words by their endings, which neighbours can
predict. All words of the corpus are counted; the
counts stay distributed. The shares of the most frequent words, a bounded number, go
to every task; the others are joined to the words of the documents. Words that
were not counted are taken as met once.

Texts are split into words once more after the counting: training and scoring read
one byte for each word, its class, stored together with the sum of the shares at hand.

The network is trained in numpy on all documents.
Documents are dealt into shards of even size; each round, every shard trains from
the current weights, each task adds up its shards' results, and a tree of bounded
fan-in averages them. Only one set of weights (about 80 kB) reaches the driver.

NULL and empty texts have no words: 0 words, log-probability 0, score NULL.
Texts are taken whole; repeated rows give repeated results; only the named
columns are read. Without any word to train on, all classes stay equally likely.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stpanel.llm.batches import small_batches
from stpanel.llm.bpe import slices
from stpanel.operators.storage import discard, materialize

FREQUENT = 191  # words with a class of their own
HASHED = 64  # classes shared by all other words
ENDING = 2  # last characters of a word that choose its hashed class
HEAD = 100_000  # most frequent of these, whose shares every task holds; the shares of the rest are joined
SPAN = 2  # neighbours to either side
WIDTH = 16
SHARD_WORDS = 200_000  # words aimed at in a training shard: fewer do not reach the neighbours' part
ROUNDS = 1
RATE = 0.3
FAN = 64  # weight sets averaged at once
EDGE = FREQUENT + HASHED  # class of a missing neighbour
CLASSES = EDGE  # classes that can be predicted


def split(text: str | None) -> list[str]:
    return (text or "").lower().split()


@dataclass
class Network:
    near: np.ndarray  # (2 * SPAN, CLASSES + 1, WIDTH)
    bias: np.ndarray  # (WIDTH,)
    out: np.ndarray  # (WIDTH, CLASSES)
    prior: np.ndarray  # (CLASSES,)

    @classmethod
    def start(cls, seed: int = 7) -> Network:
        draw = np.random.default_rng(seed).normal
        return cls(
            draw(0, 0.1, (2 * SPAN, CLASSES + 1, WIDTH)).astype(np.float32),
            np.zeros(WIDTH, np.float32),
            np.zeros((WIDTH, CLASSES), np.float32),
            np.zeros(CLASSES, np.float32),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in (self.near, self.bias, self.out, self.prior)])

    @staticmethod
    def parts(flat: np.ndarray) -> list[np.ndarray]:
        """Views of the weights in ``flat``."""
        shapes = [(2 * SPAN, CLASSES + 1, WIDTH), (WIDTH,), (WIDTH, CLASSES), (CLASSES,)]
        cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
        return [p.reshape(s) for p, s in zip(np.split(flat, cuts), shapes, strict=True)]

    @staticmethod
    def upper(flat: np.ndarray) -> np.ndarray:
        """View of ``out`` in ``flat``, with ``prior`` as its last row."""
        return flat[-(WIDTH + 1) * CLASSES :].reshape(WIDTH + 1, CLASSES)

    @classmethod
    def of(cls, flat: np.ndarray) -> Network:
        return cls(*(p.astype(np.float32) for p in cls.parts(flat)))

    def room(self) -> float:
        """How far all scores are from being clipped at least. Hidden values are at most 1."""
        return 60 - (np.abs(self.out).sum(0) + np.abs(self.prior)).max()

    def log_probabilities(self, words: np.ndarray, context: np.ndarray, rows: int = 512) -> np.ndarray:
        """log p(word | neighbours) of each word."""
        out = np.empty(len(words), np.float64)
        work, clip, upper = Scratch(rows), not self.room() > 0, self.upper(self.flat())
        for s in range(0, len(words), rows):
            e = slice(s, s + rows)
            scores = work.scores(work.hidden(self, context[:, e] + work.sets), upper, clip)
            own = scores.reshape(-1)[work.starts[: len(scores)] + words[e]]
            np.exp(scores, out=scores)
            out[e] = np.minimum(own - np.log(scores @ work.ones), 0.0)
        return out

    def train(self, words: np.ndarray, context: np.ndarray, rate: float, rows: int = 256) -> None:
        """One pass of gradient ascent with momentum-free Adagrad steps, in order."""
        weights = self.flat()  # one row of numbers, so that a step takes few operations
        self.near, self.bias, self.out, self.prior = self.parts(weights)
        total, slope, root = np.full_like(weights, 1e-2), np.empty_like(weights), np.empty_like(weights)
        near, bias, _, _ = self.parts(slope)
        upper, upper_slope = self.upper(weights), self.upper(slope)
        work, room = Scratch(rows), 0.0
        cells = np.arange(self.near.size).reshape(-1, WIDTH)
        places, added = np.empty((2 * SPAN, rows, WIDTH), np.int64), np.empty((2 * SPAN, rows, WIDTH))
        for s in range(0, len(words), rows):
            w = words[s : s + rows]
            c = context[:, s : s + rows] + work.sets
            n = len(w)
            if n < rows:
                places, added = places[:, :n].copy(), added[:, :n].copy()
            if room <= 0:
                room = self.room()
            h = work.hidden(self, c)
            p = work.scores(h, upper, not room > 0)
            np.exp(p, out=p)
            # Rows of p are left unscaled: what is made of them is a sixteenth of their size.
            each = p @ work.ones
            p.reshape(-1)[work.starts[:n] + w] -= each
            back = p @ self.out.T
            each = 1 / each[:, None]
            back *= each
            back *= 1 - np.square(h[:, :WIDTH])
            cells.take(c, axis=0, out=places, mode="clip")
            added[:] = back
            near[:] = np.bincount(places.reshape(-1), added.reshape(-1), near.size).reshape(near.shape)
            back.sum(0, out=bias)
            np.matmul((h * each).T, p, out=upper_slope)
            slope /= n
            total += np.multiply(slope, slope, out=root)
            np.sqrt(total, out=root)
            slope *= rate
            slope /= root
            weights -= slope
            room -= (WIDTH + 1) * rate  # a step moves no weight by more than the rate


class Scratch:
    """Memory for blocks of ``rows`` words, used again for each."""

    def __init__(self, rows: int):
        self.sets = (CLASSES + 1) * np.arange(2 * SPAN)[:, None]  # added to a neighbour's class: its row of ``near``
        self.starts = CLASSES * np.arange(rows)
        self.taken = np.empty((2 * SPAN, rows, WIDTH), np.float32)
        self.units = np.ones((rows, WIDTH + 1), np.float32)  # the last one, always 1, stands for the prior
        self.out = np.empty((rows, CLASSES), np.float32)
        self.ones = np.ones(CLASSES, np.float32)

    def hidden(self, net: Network, cells: np.ndarray) -> np.ndarray:
        """Hidden values of each word, and a 1."""
        n = cells.shape[1]
        taken = self.taken if n == len(self.units) else np.empty((2 * SPAN, n, WIDTH), np.float32)
        net.near.reshape(-1, WIDTH).take(cells, axis=0, out=taken, mode="clip")
        total = taken.sum(0)
        total += net.bias
        np.tanh(total, out=self.units[:n, :WIDTH])
        return self.units[:n]

    def scores(self, hidden: np.ndarray, upper: np.ndarray, clip: bool) -> np.ndarray:
        scores = np.matmul(hidden, upper, out=self.out[: len(hidden)])
        return np.clip(scores, -60, 60, out=scores) if clip else scores


class Endings(dict):
    """Hashed classes by ending, remembered: there are far fewer endings than words."""

    def __missing__(self, ending: str) -> int:
        if len(self) > 100_000:
            self.clear()
        self[ending] = found = FREQUENT + zlib.crc32(ending.encode("utf-8", "replace")) % HASHED
        return found


class Classes:
    """Word classes."""

    def __init__(self, frequent: Sequence[str]):
        self.fixed = {w: i for i, w in enumerate(frequent)}
        self.ends = Endings()

    def number(self, words: Sequence[str]) -> np.ndarray:
        fixed, ends = self.fixed, self.ends
        return np.array([fixed[w] if w in fixed else ends[w[-ENDING:]] for w in words], np.int64)


class Codes(dict):
    """Word to a small number, whose class and log-share stand in ``kind`` and ``inner``.

    Frequent words have their class, words of ``head`` (``word, inner``) the number of their
    class and share together. All others are noted in ``rare`` and have their class, with no share.
    """

    def __init__(self, frequent: Sequence[str], head: pa.Table):
        self.ends, self.rare = Endings(), []
        words, inner = head["word"].to_pylist(), head["inner"].to_pylist()
        # Few numbers for many words: they and their shares stay in the cache.
        pairs: dict[tuple[int, float], int] = {}
        for word, share in zip(words, inner, strict=True):
            pair = self.ends[word[-ENDING:]], share
            self[word] = pairs.setdefault(pair, CLASSES + len(pairs))
        self.update((w, i) for i, w in enumerate(frequent))
        self.kind = np.array([*range(CLASSES), *(k for k, _ in pairs)], np.uint8)
        self.inner = np.array([0.0] * CLASSES + [x for _, x in pairs])

    def __missing__(self, word: str) -> int:
        self.rare.append(word)
        return self.ends[word[-ENDING:]]

    def number(self, words: Sequence[str]) -> tuple[np.ndarray, list[str]]:
        """The numbers of the words, and those of them that are rare."""
        self.rare = []
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words)), self.rare


def windows(numbered: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All words of the texts, and the classes of their neighbours within each text."""
    words = np.concatenate(numbered) if numbered else np.zeros(0, np.int64)
    lengths = np.array([len(n) for n in numbered], np.int64)
    where = np.arange(len(words)) + np.repeat(SPAN * np.arange(1, len(lengths) + 1), lengths)
    line = np.full(len(words) + SPAN * (len(lengths) + 1), EDGE, words.dtype)
    line[where] = words
    return words, np.stack([line[where + o] for o in range(-SPAN, SPAN + 1) if o])


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, n`` of every word of all texts, stored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(seen.keys(), pa.string()), "n": pa.array(seen.values(), pa.int64())})

        for batch in batches:
            for part in slices(batch, batch.schema.names[0], 4 << 20):
                for t in part.column(0).to_pylist():
                    seen.update(split(t))
                if len(seen) > 200_000:
                    yield rows()
                    seen.clear()
        yield rows()

    small_batches(docs.sparkSession)
    counts = docs.select(F.col(text).alias("text")).mapInArrow(count, "word string, n long")
    return materialize(counts.groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")


def most_frequent(counts: DataFrame, most: int = FREQUENT) -> list[str]:
    """The most frequent of the counted words; ties by the word."""
    return [r["word"] for r in counts.orderBy(F.col("n").desc(), "word").limit(most).collect()]


def frequent_words(docs: DataFrame, text: str = "text", most: int = FREQUENT) -> list[str]:
    """The most frequent words of all texts; ties by the word."""
    return most_frequent(word_counts(docs, text), most)


def _weights(table: pa.Table) -> tuple[int, np.ndarray]:
    """Words of all rows, and the mean of their weights by words."""
    n = table["n"].to_numpy().astype(float)
    total = np.zeros(len(table["weights"][0].as_py()) // 4)
    for w, share in zip(table["weights"], n / n.sum(), strict=True):
        total += np.frombuffer(w.as_py(), np.float32) * share
    return int(n.sum()), total.astype(np.float32)


def _average(weights: DataFrame, shards: int) -> np.ndarray | None:
    """Mean of the shards' weights, weighted by words, over a tree of groups."""

    def mean(table: pa.Table) -> pa.Table:
        n, flat = _weights(table)
        return pa.table({"shard": table["shard"].slice(0, 1), "n": [n], "weights": [flat.tobytes()]})

    def mean_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, words, total = None, 0, 0.0
        for batch in batches:
            if batch.num_rows:
                n, flat = _weights(pa.Table.from_batches([batch]))
                first = batch["shard"][0].as_py() if first is None else first
                words, total = words + n, total + flat.astype(float) * n
        if first is not None:
            flat = (total / words).astype(np.float32).tobytes()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([first], pa.int32()), "n": [words], "weights": [flat]})

    # A task's shards are added up before anything is shuffled.
    weights = weights.mapInArrow(mean_of_task, "shard int, n long, weights binary")
    while True:
        shards = -(-shards // FAN)
        weights = weights.withColumn("shard", (F.col("shard") % shards).cast("int"))
        weights = weights.groupBy("shard").applyInArrow(mean, "shard int, n long, weights binary")
        if shards == 1:
            row = weights.first()
            return None if row is None else np.frombuffer(row["weights"], np.float32)


def _trainer(shared, rate: float):
    """Trains the broadcast weights on one shard; rows are put in order first, so reruns agree."""

    def train(table: pa.Table) -> pa.Table:
        net = Network.of(shared.value)
        rows = zip(table["id"].to_pylist(), table["classes"].to_pylist(), strict=True)
        texts = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        words, near = windows([np.frombuffer(c, np.uint8) for _, c in texts])
        order = np.random.default_rng(1).permutation(len(words))
        net.train(words[order], near[:, order], rate)
        weights = net.flat().tobytes()
        return pa.table({"shard": table["shard"].slice(0, 1), "n": [max(1, len(words))], "weights": [weights]})

    return train


def _coded(docs: DataFrame, frequent: Sequence[str], text: str, kept: Column, doc_id: Column, head: pa.Table | None) -> DataFrame:
    """``row, kept, id, key``, ``classes`` (a byte for each word), ``inner`` and ``rare`` of all documents.

    ``inner`` is the sum of log p(word | class) over the words of ``head``, ``rare`` has the words
    beyond it and how often each is met; without ``head`` they are 0 and empty.
    """
    key = F.xxhash64(F.lit("shard"), doc_id, F.col(text)).alias("key")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), kept.alias("kept"), doc_id.alias("id"), key, F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((list(frequent), head))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, head = shared.value
        classes = Classes(frequent)
        codes = None if head is None else Codes(frequent, head)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                numbers, ends, pairs = [], [0], []
                for t in part.column("text").to_pylist():
                    # Each text is looked up while its words are in the cache.
                    if codes is None:
                        numbers.append(classes.number(split(t)))
                    else:
                        number, rare = codes.number(split(t))
                        numbers.append(number)
                        if rare:
                            pairs += Counter(rare).items()
                    ends.append(len(pairs))
                n = [len(x) for x in numbers]
                number = np.concatenate(numbers)
                kind, inner = number.astype(np.uint8), np.zeros(len(n))
                if codes is not None:
                    kind, inner = codes.kind[number], np.bincount(np.repeat(np.arange(len(n)), n), codes.inner[number], len(n))
                cuts = np.cumsum([0, *n]).tolist()
                coded = [kind[i:j].tobytes() for i, j in zip(cuts, cuts[1:])]
                items = pa.StructArray.from_arrays(
                    [pa.array([w for w, _ in pairs], pa.string()), pa.array([k for _, k in pairs], pa.int32())], ["word", "times"]
                )
                rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names[:4]), pa.array(coded, pa.binary()), pa.array(inner, pa.float64()), rare], names
                )

    word = T.StructType([T.StructField("word", T.StringType()), T.StructField("times", T.IntegerType())])
    new = [("classes", T.BinaryType()), ("inner", T.DoubleType()), ("rare", T.ArrayType(word))]
    schema = T.StructType([*rows.schema.fields[:4], *(T.StructField(*c) for c in new)])
    names = schema.names
    return rows.mapInArrow(run, schema)


def coded(
    docs: DataFrame,
    frequent: Sequence[str],
    text: str = "text",
    doc_id: str = "doc_id",
    keep: Sequence[str | Column] = ("doc_id",),
    counts: DataFrame | None = None,
) -> DataFrame:
    """What ``fit`` and ``score`` read of the documents, stored, so that texts are split once for both."""
    head = None if counts is None else _head(_others(counts, frequent))
    return materialize(_coded(docs, frequent, text, F.struct(*keep), F.col(doc_id), head), "lm-classes")


def fit(
    docs: DataFrame,
    frequent: Sequence[str],
    text: str = "text",
    doc_id: str = "doc_id",
    rounds: int = ROUNDS,
    known: DataFrame | None = None,
) -> Network:
    """Train on all documents, ``rounds`` times. ``known``: their ``coded`` form, if it is at hand."""
    network = Network.start()
    stored = coded(docs, frequent, text, doc_id, (doc_id,)) if known is None else known
    rows = stored.filter("octet_length(classes) > 0")
    words = rows.agg(F.sum(F.octet_length("classes"))).first()[0]
    if not words:
        return network
    shards = max(1, round(words / SHARD_WORDS))
    dealt = rows.select(F.pmod("key", F.lit(shards)).cast("int").alias("shard"), "id", "classes")
    context = docs.sparkSession.sparkContext
    for turn in range(rounds):
        shared = context.broadcast(network.flat())
        train = _trainer(shared, RATE / (1 + turn))
        mean = _average(dealt.groupBy("shard").applyInArrow(train, "shard int, n long, weights binary"), shards)
        if mean is not None:
            network = Network.of(mean)
    if known is None:
        discard(stored)
    return network


def _with_shares(words: DataFrame, others: DataFrame) -> DataFrame:
    """``words`` with the logarithm of each one's share ``inner`` of its class; ``others`` has the counts of all."""
    kind = (F.crc32(F.right("word", F.lit(ENDING)).cast("binary")) % HASHED).alias("class")
    totals = others.groupBy(kind).agg(F.sum("n").alias("total"))
    known = words.withColumn("class", kind).join(F.broadcast(totals), "class", "left")
    return known.withColumn("inner", F.log(F.col("n") / F.greatest(F.col("n"), F.coalesce("total", F.lit(0)))))


def _others(counts: DataFrame, frequent: Sequence[str]) -> DataFrame:
    """The counts of the words in hashed classes."""
    return counts.filter(~F.col("word").isin(list(frequent))) if frequent else counts


def _head(others: DataFrame) -> pa.Table:
    """``word, inner``: log p(word | class) of the ``HEAD`` most frequent words in hashed classes."""
    rows = others.orderBy(F.col("n").desc(), "word").limit(HEAD)
    return _with_shares(rows, others).filter("word IS NOT NULL AND inner IS NOT NULL").select("word", "inner").toArrow()


def _shares(rare: DataFrame, others: DataFrame) -> DataFrame:
    """``row, inner``: the sum of log p(word | class) over the rare words."""
    words = rare.join(others, "word", "left").select("row", "times", "word", F.coalesce("n", F.lit(1)).alias("n"))
    return _with_shares(words, others).groupBy("row").agg(F.sum(F.col("times") * F.col("inner")).alias("inner"))


def score(
    docs: DataFrame,
    network: Network,
    frequent: Sequence[str],
    text: str = "text",
    keep: Sequence[str | Column] = ("doc_id",),
    counts: DataFrame | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """``keep`` columns, ``n_words``, ``log_prob`` (sum over the words) and ``score`` (their mean).

    ``counts`` (``word_counts`` of the corpus) makes them probabilities of words;
    without it they are those of word classes. ``known``: the documents' ``coded`` form
    with the same ``keep`` and ``counts``, if it is at hand.
    """
    others = None if counts is None else _others(counts, frequent)
    if known is None:
        known = _coded(docs, frequent, text, F.struct(*keep), F.lit(None), None if others is None else _head(others))
        known = known if others is None else materialize(known, "lm-classes")
    shared = docs.sparkSession.sparkContext.broadcast(network)
    rows = known.select("row", "kept", "classes", "inner")
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("n_words", T.LongType()), T.StructField("log_prob", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for part in slices(batch, "classes", 1 << 18):
                numbered = [np.frombuffer(c, np.uint8) for c in part.column("classes").to_pylist()]
                logs = net.log_probabilities(*windows(numbered))
                n = np.array([len(x) for x in numbered], np.int64)
                total = np.bincount(np.repeat(np.arange(len(n)), n), weights=logs, minlength=len(n)).astype(float)
                total += part.column("inner").to_numpy()
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("kept"), pa.array(n), pa.array(total)], schema.names)

    small_batches(docs.sparkSession)
    scored = rows.mapInArrow(run, schema)
    log_prob = F.col("log_prob")
    if others is not None:
        scored = materialize(scored, "lm-scored")
        inner = _shares(known.select("row", F.inline("rare")), others)
        scored = scored.join(inner, "row", "left")
        log_prob = log_prob + F.coalesce("inner", F.lit(0.0))
    scored = scored.select("kept", "n_words", log_prob.alias("log_prob"))
    mean = F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words"))
    return scored.select("kept.*", "n_words", "log_prob", mean.alias("score"))
