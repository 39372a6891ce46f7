"""Phrase collocations by best-first branch and bound over n-gram counts.

A phrase of 2 to 4 words with count ``a`` is cut after each of its words; with
counts l and r of both parts, the cut scores floor(2000000 a / (l + r)), and the
lowest cut counts. A language's result are its best ``top`` phrases that no longer
phrase nearly always contains.

Growing a phrase never raises its count, so the count of a prefix (or suffix) x
with first word w bounds every phrase grown from it: score <= 2000000 f(x) /
(f(w) + f(x)). All pairs of frequent words are counted first. Their scores give
each language a floor, guessed from the score at a rank. Only branches whose bound
reaches the floor are grown to three and four words, together with the one-word
extensions that decide whether a phrase above the floor survives. If ``top``
survivors reach the floor, the language is settled: everything else scores less.
Otherwise its floor is lowered and its branches are expanded further, down to 0.

Counting passes read the texts in numpy, whole and in chunks of bounded size, and
send phrases with partial counts. Bounds come from sketches of fixed size with the
highest and lowest count per hash cell: collisions loosen a bound, never break it,
and all results come from exact counts by the phrase itself.

NULL texts are empty, a NULL language is ``und``. Repeated rows count repeatedly.
An empty table gives an empty result. Bytes that are not UTF-8 are parts of words.
Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stpanel.llm.batches import small_batches
from stpanel.llm.bpe import slices
from stpanel.operators.storage import materialize

LEAST = 30  # occurrences of a candidate
WORDS = 4  # in the longest candidate
TOP = 2000
SCALE = 2_000_000
NEAR = 80  # a phrase goes if a longer one has this percentage of its occurrences
FIRST_RANK = 1.5  # the first floor is the pair score at this multiple of TOP
LOWER = 4  # by how much the rank grows when a floor proves too high
LANGS = 1024  # languages with a floor; any more are expanded in full
CHUNK = 1 << 19  # bytes of text counted together
CELL_BITS = 20
SALTS = 64

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t", b"abcdefghijklmnopqrstuvwxyz ")
_BREAK = re.compile(rb"[ .,;:!?\x0A-\x0D]")
_AHEAD = re.compile(rb"(?:[ .,;:!?\x0A-\x0D]*[^ .,;:!?\x0A-\x0D]+){0,%d}" % (WORDS - 1))
_ODD = [(0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9), (0xC2B2AE3D27D4EB4F, 0x94D049BB133111EB)]


# --- words of a chunk ---------------------------------------------------------


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte, bytes between words, bytes between pieces."""
    numbers = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    piece = np.zeros(256, bool)
    piece[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
    between = piece.copy()
    between[0x20] = True
    return numbers, between, piece


_grown: dict[tuple[int, bool], np.ndarray] = {}


def _powers(base: int, inverse: bool, n: int) -> np.ndarray:
    if len(_grown.get((base, inverse), ())) < n:
        row = np.full(max(n, CHUNK + 4096), pow(base, -1, 1 << 64) if inverse else base, np.uint64)
        row[0] = 1
        _grown[base, inverse] = np.multiply.accumulate(row)
    return _grown[base, inverse][:n]


def _mix(h: np.ndarray, odd: int) -> np.ndarray:
    h = h * np.uint64(odd)
    return h ^ (h >> np.uint64(31))


@dataclass
class Chunk:
    """Words of some texts: byte positions, piece, language, two hashes, and whether they count."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    lang: np.ndarray
    counts: np.ndarray
    hashes: list[np.ndarray]
    names: list[str]

    def grams(self, k: int, which: int = 0) -> np.ndarray:
        """Hashes of the k words from each word on, with their language."""
        m = max(0, len(self.start) - k + 1)
        h = np.full(m, k, np.uint64)
        for i in range(k):
            h = _mix(h ^ self.hashes[which][i : i + m], _ODD[which][1])
        tongue = np.array([_name_hash(n)[which] for n in self.names], np.uint64)
        return _mix(h ^ tongue[self.lang[:m]], _ODD[which][0])

    def whole(self, k: int) -> np.ndarray:
        """Whether k words from each word on count and stand in one piece."""
        m = max(0, len(self.start) - k + 1)
        return self.counts[:m] & (self.piece[:m] == self.piece[k - 1 :])


@cache
def _name_hash(name: str) -> tuple[int, int]:
    raw = hashlib.blake2b(name.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return int.from_bytes(raw[:8], "little"), int.from_bytes(raw[8:], "little")


def normalise(text: bytes) -> bytes:
    """Lower-cased A-Z; blanks are single spaces."""
    text = text.translate(_LOWER)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text


def chunks(texts: Sequence[bytes | None], langs: Sequence[str]) -> Iterator[Chunk]:
    """All words of the texts, in chunks of about CHUNK bytes.

    A longer text is cut between words; a chunk also holds the next words after
    the cut, which end phrases but begin none.
    """
    parts: list[bytes] = []
    owners: list[str] = []
    limits: list[int] = []
    size = 0
    for text, lang in zip(texts, langs, strict=True):
        raw, at = normalise(text or b""), 0
        while at < len(raw):
            found = _BREAK.search(raw, at + CHUNK) if len(raw) - at > CHUNK else None
            cut = found.start() if found else len(raw)
            stop = _AHEAD.match(raw, cut).end() if found else cut
            if parts and size + stop - at > CHUNK:
                yield _chunk(parts, owners, limits)
                parts, owners, limits, size = [], [], [], 0
            parts.append(raw[at:stop])
            owners.append(lang)
            limits.append(cut - at)
            size += stop - at + 1
            at = cut
    if parts:
        yield _chunk(parts, owners, limits)


def _chunk(parts: list[bytes], owners: list[str], limits: list[int]) -> Chunk:
    data = np.frombuffer(b"\n".join(parts), np.uint8)
    numbers, between, piece = _tables()
    edges = np.flatnonzero(np.diff(np.r_[True, between[data], True].view(np.int8)))
    start, end = edges[::2], edges[1::2]
    sums, hashes = np.zeros(len(data) + 1, np.uint64), []
    for base, odd in _ODD:
        np.cumsum(numbers[data] * _powers(base, False, len(data)), out=sums[1:])
        hashes.append(_mix((sums[end] - sums[start]) * _powers(base, True, len(data) + 1)[start] + (end - start).astype(np.uint64), odd))
    begins = np.cumsum([0, *(len(p) + 1 for p in parts)])[:-1]
    owner = np.searchsorted(begins, start, side="right") - 1
    names = sorted(set(owners))
    number = {n: i for i, n in enumerate(names)}
    lang = np.array([number[o] for o in owners], np.int32)[owner]
    counts = start - begins[owner] < np.asarray(limits)[owner]
    return Chunk(data, start, end, np.cumsum(piece[data])[start] if len(start) else start, lang, counts, hashes, names)


def tally(chunk: Chunk, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and numbers of the distinct phrases of k words at the places ``at``."""
    a, b = chunk.grams(k)[at], chunk.grams(k, 1)[at]
    order = np.argsort(a, kind="stable")
    same = np.r_[False, a[order][1:] == a[order][:-1]]
    if np.any(same & np.r_[False, b[order][1:] != b[order][:-1]]):
        order = np.lexsort((b, a))
        same = np.r_[False, (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])]
    first = np.flatnonzero(~same)
    return at[order[first]], np.diff(np.r_[first, len(order)])


def table(chunk: Chunk, k: int, at: np.ndarray) -> pa.RecordBatch:
    """``lang, phrase, n`` of the distinct phrases at the given places."""
    place, n = tally(chunk, k, at) if len(at) else (at, at)
    start, end = chunk.start[place], chunk.end[place + k - 1]
    offsets = np.r_[0, np.cumsum(end - start)]
    values = chunk.data[np.repeat(start - offsets[:-1], end - start) + np.arange(offsets[-1])]
    phrase = pa.StringArray.from_buffers(len(place), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values.tobytes()))
    lang = pa.array(chunk.names, pa.string()).take(pa.array(chunk.lang[place]))
    return pa.RecordBatch.from_arrays([lang, phrase, pa.array(n, pa.int64())], ["lang", "phrase", "n"])


# --- bounds --------------------------------------------------------------------


@dataclass
class Sketch:
    """Highest and lowest count of the frequent phrases in each hash cell, rounded outwards."""

    high: np.ndarray
    low: np.ndarray

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cells = hashes >> np.uint64(64 - CELL_BITS)
        return self.high[cells], self.low[cells]


def sketch(counts: DataFrame, k: int) -> Sketch:
    """The bounds of a table of phrases of k words; its size does not depend on the table."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(1 << CELL_BITS), np.full(1 << CELL_BITS, np.inf)
        for batch in batches:
            n = batch.column("n").to_numpy()
            done = 0
            for chunk in chunks(batch.column("phrase").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist()):
                whole = np.flatnonzero(np.r_[True, chunk.piece[1:] != chunk.piece[:-1]])
                cell = chunk.grams(k)[whole] >> np.uint64(64 - CELL_BITS)
                of = n[done : done + len(whole)]
                done += len(whole)
                np.maximum.at(high, cell, of)
                np.minimum.at(low, cell, of)
        used = np.flatnonzero(high)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(high[used]), pa.array(low[used])], ["cell", "high", "low"])

    rows = counts.select("lang", "phrase", "n").mapInArrow(cells, "cell long, high double, low double")
    found = rows.groupBy("cell").agg(F.max("high").alias("high"), F.min("low").alias("low")).toArrow()
    high, low = np.zeros(1 << CELL_BITS, np.float32), np.zeros(1 << CELL_BITS, np.float32)
    cell = found.column("cell").to_numpy()
    high[cell] = np.nextafter(found.column("high").to_numpy().astype(np.float32), np.float32(np.inf))
    low[cell] = np.nextafter(found.column("low").to_numpy().astype(np.float32), np.float32(0))
    return Sketch(high, low)


def _reaches(count: np.ndarray, parts: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """Whether ``count`` over ``parts`` can score the floor (with room for rounding)."""
    return SCALE * 1.00001 * count >= floor * parts


def pairs(chunk: Chunk, words: Sketch) -> np.ndarray:
    """Places of two frequent words."""
    often = words.of(chunk.grams(1))[0] >= LEAST
    return np.flatnonzero(chunk.whole(2) & often[:-1] & often[1:]) if len(often) else np.zeros(0, np.int64)


def triples(chunk: Chunk, words: Sketch, two: Sketch, floors: Mapping[str, int]) -> np.ndarray:
    """Places of three words that can reach the floor, begin or end four that do, or extend a pair that does."""
    if len(chunk.start) < 3:
        return np.zeros(0, np.int64)
    high, low = two.of(chunk.grams(2))
    at = np.flatnonzero(chunk.whole(3) & (high[:-1] >= LEAST) & (high[1:] >= LEAST))
    single = words.of(chunk.grams(1))[1]
    w1, w2, w3 = (single[at + i] for i in range(3))
    floor = _floors(chunk, floors)[at]
    before, after = high[at], high[at + 1]
    most = np.minimum(before, after)
    wanted = _reaches(most, most + np.minimum(w1, w3), floor)
    wanted |= _reaches(before, w1 + w2, floor) & (100 * after >= NEAR * low[at])
    wanted |= _reaches(after, w2 + w3, floor) & (100 * before >= NEAR * low[at + 1])
    return at[wanted]


def fours(chunk: Chunk, words: Sketch, two: Sketch, three: Sketch, floors: Mapping[str, int]) -> np.ndarray:
    """Places of four words that can reach the floor or extend three words that do."""
    if len(chunk.start) < 4:
        return np.zeros(0, np.int64)
    high, low = three.of(chunk.grams(3))
    at = np.flatnonzero(chunk.whole(4) & ((high[:-1] >= LEAST) | (high[1:] >= LEAST)))
    single = words.of(chunk.grams(1))[1]
    w1, w2, w3, w4 = (single[at + i] for i in range(4))
    pair_high, pair_low = two.of(chunk.grams(2))
    floor = _floors(chunk, floors)[at]
    before, after = high[at], high[at + 1]
    most = np.minimum(before, after)
    wanted = (most >= LEAST) & _reaches(most, most + np.maximum(w1, w4), floor)
    for count, least, outer, first, second, third, left, right in (
        (before, low[at], pair_high[at + 2], w1, w2, w3, pair_low[at], pair_low[at + 1]),
        (after, low[at + 1], pair_high[at], w2, w3, w4, pair_low[at + 1], pair_low[at + 2]),
    ):
        can = _reaches(count, first + right, floor) & _reaches(count, left + third, floor)
        wanted |= (count >= LEAST) & (outer >= LEAST) & can & (100 * outer >= NEAR * least)
    return at[wanted]


def _floors(chunk: Chunk, floors: Mapping[str, int]) -> np.ndarray:
    return np.array([floors.get(n, 0) for n in chunk.names], np.float64)[chunk.lang]


# --- counting ------------------------------------------------------------------


def _chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        for part in slices(batch, "text", 2 * CHUNK):
            yield from chunks(part.column("text").cast(pa.binary()).to_pylist(), part.column("lang").to_pylist())


def count_words(docs: DataFrame) -> DataFrame:
    """``lang, phrase, n`` of frequent words; the empty phrase counts all words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks_of(batches):
            yield table(chunk, 1, np.flatnonzero(chunk.counts))
            n = np.bincount(chunk.lang[chunk.counts], minlength=len(chunk.names))
            yield pa.RecordBatch.from_pydict({"lang": chunk.names, "phrase": [""] * len(n), "n": n.astype(np.int64)})

    return _sums(docs, run).filter(f"n >= {LEAST} OR phrase = ''")


def count(docs: DataFrame, k: int, rule: Callable[..., np.ndarray], *bounds) -> DataFrame:
    """``lang, phrase, n`` of frequent phrases of k words at the places that ``rule(chunk, *bounds)`` names."""
    shared = docs.sparkSession.sparkContext.broadcast(bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks_of(batches):
            yield table(chunk, k, rule(chunk, *shared.value))

    return _sums(docs, run).filter(f"n >= {LEAST}")


def _sums(docs: DataFrame, run) -> DataFrame:
    rows = docs.mapInArrow(run, "lang string, phrase string, n long")
    return rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


# --- scores --------------------------------------------------------------------


def _wide(count: str) -> Column:
    return F.col(count).cast("decimal(20,0)")


def scored(grams: DataFrame, parts: DataFrame, k: int) -> DataFrame:
    """``lang, phrase, a, score, l, r`` of phrases of k words, from the cut that scores least.

    Phrases with an uncounted part are left out: they score below the floor.
    """
    word = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.lit(k - 1))).alias("k")
    halves = grams.select("lang", "phrase", F.col("n").alias("a"), word.alias("word"), cut).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("word", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("word", F.col("k") + 1, F.lit(k)), " ").alias("right"),
    )
    side = lambda name, n: parts.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    both = halves.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    score = F.expr(f"(cast(a AS decimal(20,0)) * {SCALE}) div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0)))")
    least = F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("least")
    found = both.groupBy("lang", "phrase", "a").agg(least, F.count(F.lit(1)).alias("cuts"))
    return found.filter(F.col("cuts") == k - 1).select("lang", "phrase", "a", "least.score", "least.l", "least.r")


def survivors(candidates: DataFrame, longer: Sequence[DataFrame]) -> DataFrame:
    """Candidates without a one-word extension that has NEAR % of their occurrences.

    A longer phrase around a candidate cannot be more frequent than the extension
    by one word that lies inside it, so these decide.
    """
    word = F.split("phrase", " ")
    inner = [F.slice(word, F.lit(1), F.size(word) - 1), F.slice(word, F.lit(2), F.size(word) - 1)]
    around = reduce(DataFrame.unionByName, longer).select(
        "lang", "n", F.explode(F.array(*[F.array_join(i, " ") for i in inner])).alias("phrase")
    )
    most = around.groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    near = _wide("most") * 100 >= _wide("a") * NEAR
    return candidates.join(most, ["lang", "phrase"], "left").filter(F.col("most").isNull() | ~near).drop("most")


def best(rows: DataFrame, top: int) -> DataFrame:
    """Each language's first ``top`` rows, ranked from 1, in two steps for large languages."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).drop("salt")


def floors_at(scores: DataFrame, ranks: Mapping[str, int]) -> dict[str, int]:
    """The score at each language's rank, 0 where there are fewer; one row per language and score is sorted."""
    names = [F.lit(x) for lang, rank in ranks.items() for x in (lang, rank)]
    rank = F.create_map(*names)[F.col("lang")]
    levels = scores.filter(F.col("lang").isin(list(ranks))).groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n"))
    above = F.sum("n").over(Window.partitionBy("lang").orderBy(F.col("score").desc()))
    reached = levels.withColumn("above", above).filter(F.col("above") >= rank).groupBy("lang").agg(F.max("score"))
    return dict.fromkeys(ranks, 0) | {r[0]: r[1] for r in reached.collect()}


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP, first_rank: float = FIRST_RANK) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best ``top`` phrases."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    words = materialize(count_words(rows), "phrases-1")
    totals = words.filter("phrase = ''").select("lang", F.col("n").alias("total"))
    single = words.filter(f"phrase <> '' AND n >= {LEAST}")
    one = sketch(single, 1)
    two = materialize(count(rows, 2, pairs, one), "phrases-2")
    second = sketch(two, 2)
    pair_scores = materialize(scored(two, single, 2), "phrases-pairs")
    sizes = pair_scores.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(LANGS)
    ranks = {r["lang"]: int(top * first_rank) for r in sizes.collect()}
    open_langs, others, settled = dict(ranks), ~F.col("lang").isin(list(ranks)) if ranks else F.lit(True), []
    while True:
        floors = floors_at(pair_scores, open_langs) if open_langs else {}
        expanding = F.col("lang").isin(list(floors)) | others if floors else others
        texts = rows.filter(expanding)
        three = materialize(count(texts, 3, triples, one, second, floors), "phrases-3")
        four = materialize(count(texts, 4, fours, one, second, sketch(three, 3), floors), "phrases-4")
        parts = single.unionByName(two).unionByName(three)
        found = pair_scores.unionByName(scored(three, parts, 3)).unionByName(scored(four, parts, 4)).filter(expanding)
        if floors:
            floor = F.coalesce(F.create_map(*[F.lit(x) for pair in floors.items() for x in pair])[F.col("lang")], F.lit(0))
            found = found.filter(F.col("score") >= floor)
        kept = materialize(survivors(found, [three, four]), "phrases-kept")
        numbers = {r["lang"]: r["n"] for r in kept.filter(F.col("lang").isin(list(floors))).groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
        again = {name: open_langs[name] * LOWER for name, floor in floors.items() if floor > 0 and numbers.get(name, 0) < top}
        settled.append(kept.filter(~F.col("lang").isin(list(again))) if again else kept)
        if not again:
            break
        open_langs, others = again, F.lit(False)
    result = best(reduce(DataFrame.unionByName, settled), top).join(totals, "lang")
    return result.select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
