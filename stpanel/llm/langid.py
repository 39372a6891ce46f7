"""Language identification with bit-sliced Bloom filters.

One filter serves all languages: a slot holds a bit mask with one bit per
language, so the AND of a character n-gram's slots gives every language whose
text contains the n-gram. Counting the bits per language over a text, and
correcting the counts for the filter's false positives, gives the share of the
text's n-grams that each language knows; the largest share decides.

A NULL text or one without a letter is ``und`` with score 0. A text whose
n-grams are unknown everywhere gets the most frequent learned language with
score 0. Ties go to the language with more learned documents, then by name.
Rows are independent, texts are taken whole, and all columns that are not named
pass through untouched. Without any labelled row every text is ``und``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stpanel.llm.batches import small_batches
from stpanel.llm.bpe import slices

SIZES = (3, 4)  # characters in an n-gram, word edges included
DOCS = 2000  # labelled documents read per language, on average
SHARE = 0.01  # an n-gram belongs to a language if this share of its documents has it
BLOCK = 1 << 18  # characters whose n-grams are hashed together
SLOT_BITS = 20
HASHES = 3
UND = "und"


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def normalised(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and single spaces of all texts, the position of each one's text, and which texts have letters.

    Texts are lower-cased; runs of other characters than letters are one space,
    and every text starts and ends with a space.
    """
    parts, owners, lettered = [], [], np.zeros(len(texts), bool)
    known = _letters()
    for i, text in enumerate(texts):
        points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "replace"), np.uint32)
        letter = known[points]
        lettered[i] = letter.any()
        keep = letter.copy()
        keep[0] = True
        keep[1:] |= letter[:-1]
        parts.append(np.where(letter[keep], points[keep], np.uint32(32)).astype(np.uint32))
        owners.append(len(parts[-1]))
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), owners)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32), owner, lettered


def gram_blocks(chars: np.ndarray, owner: np.ndarray, sizes: Sequence[int] = SIZES, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of all n-grams and the positions of their texts, of ``block`` characters at a time."""
    for n in sizes:
        for at in range(0, len(chars) - n + 1, block):
            part = chars[at : at + block + n - 1].astype(np.uint64)
            m = len(part) - n + 1
            h = np.full(m, n, np.uint64)
            for i in range(n):
                h = (h ^ part[i : i + m]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
            inside = owner[at : at + m] == owner[at + n - 1 : at + n - 1 + m]
            yield h[inside], owner[at : at + m][inside]


def grams(texts: Sequence[str | None], sizes: Sequence[int] = SIZES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams, the position of each one's text, and which texts have letters."""
    chars, owner, lettered = normalised(texts)
    found = list(gram_blocks(chars, owner, sizes))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), lettered
    return np.concatenate([h for h, _ in found]), np.concatenate([o for _, o in found]), lettered


def distinct_grams(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of each text (hash, text), reduced block by block."""
    chars, owner, _ = normalised(texts)
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    for hashes, of in gram_blocks(chars, owner):
        kept.append(_distinct(hashes, of))
        if len(kept) == 16:
            kept = [_distinct(*(np.concatenate(x) for x in zip(*kept, strict=True)))]
    if not kept:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    return _distinct(*(np.concatenate(x) for x in zip(*kept, strict=True)))


def _distinct(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    first = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])][: len(hashes)]
    return hashes[first], owner[first]


def slots(hashes: np.ndarray, bits: int = SLOT_BITS, count: int = HASHES) -> list[np.ndarray]:
    """The slots of each hash, from separate runs of its bits."""
    mask = np.uint64((1 << bits) - 1)
    return [((hashes >> np.uint64(64 - bits * (i + 1))) & mask).astype(np.int64) for i in range(count)]


@dataclass
class Filters:
    """``slices[i]`` holds the masks of languages 64 i to 64 i + 63 (in a smaller type if fewer)."""

    langs: list[str]  # by number of learned documents
    slices: list[np.ndarray]
    false: np.ndarray  # false-positive rate of each language

    def shares(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected share of known n-grams (text, language), and which texts have letters."""
        chars, owners, lettered = normalised(texts)
        total = np.zeros(len(texts))
        counts = np.zeros((len(texts), len(self.langs)))
        for hashes, owner in gram_blocks(chars, owners):
            total += np.bincount(owner, minlength=len(texts))
            where = slots(hashes)
            for i, masks in enumerate(self.slices):
                known = masks[where[0]]
                for w in where[1:]:
                    known &= masks[w]
                for bit in range(min(64, len(self.langs) - 64 * i)):
                    has = (known >> masks.dtype.type(bit)) & masks.dtype.type(1)
                    counts[:, 64 * i + bit] += np.bincount(owner, weights=has, minlength=len(texts))
        expected = total[:, None] * self.false
        corrected = (counts - expected) / (1 - self.false) / np.maximum(total, 1)[:, None]
        return np.clip(corrected, 0.0, 1.0), lettered


def _filters(langs: list[str], found: pa.Table) -> Filters:
    """Set the slots of the learned n-grams (``lang`` number, ``gram``)."""
    hashes = found["gram"].to_numpy().view(np.uint64)
    numbers = found["lang"].to_numpy()
    planes, false = [], np.zeros(len(langs))
    for first in range(0, len(langs), 64):
        width = min(64, len(langs) - first)
        kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if np.dtype(t).itemsize * 8 >= width)
        masks = np.zeros(1 << SLOT_BITS, kind)
        for bit in range(width):
            for at in slots(hashes[numbers == first + bit]):
                masks[at] |= kind(1 << bit)
            fill = ((masks >> kind(bit)) & kind(1)).mean()
            false[first + bit] = min(fill**HASHES, 0.999)
        planes.append(masks)
    return Filters(langs, planes, false)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept out of learning: its id's CRC-32 leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", docs: int = DOCS) -> Filters:
    """Fit the filters on rows with a language.

    Reads about ``docs`` documents of each language, chosen by a hash of the id;
    with fewer, all. An n-gram is kept if at least ``SHARE`` of the language's
    documents have it, which bounds what reaches the driver: at most
    (n-grams of an average document) / ``SHARE`` per language.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").collect()
    langs = [r["lang"] for r in sizes]
    if not langs:
        return Filters([], [], np.zeros(0))
    number = F.create_map(*[F.lit(x) for i, name in enumerate(langs) for x in (name, i)])
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, docs / r["n"]))])
    draw = F.pmod(F.xxhash64(F.lit("sample"), "id", F.length("text")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.filter(draw < share[F.col("lang")]).select(number[F.col("lang")].alias("lang"), "text")

    def collect_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                hashes, owner = distinct_grams(part.column("text").to_pylist())
                of = part.column("lang").to_numpy()[owner]
                for each in np.unique(of):
                    gram, n = np.unique(hashes[of == each], return_counts=True)
                    yield pa.RecordBatch.from_pydict(
                        {"lang": pa.array(np.full(len(gram), each), pa.int32()), "gram": gram.view(np.int64), "n": n}
                    )

    least = F.create_map(*[F.lit(x) for i, r in enumerate(sizes) for x in (i, SHARE * min(docs, r["n"]))])
    found = (
        sample.mapInArrow(collect_grams, "lang int, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least[F.col("lang")])
        .select("lang", "gram")
        .toArrow()
    )
    return _filters(langs, found)


def predict(docs: DataFrame, filters: Filters, text: str = "text", keep: Sequence[str | Column] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score``: the share of n-grams the language knows.

    The filters (a megabyte per eight languages) are all that the tasks receive.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*keep).alias("kept"), F.col(text).alias("text"))
    schema = T.StructType(
        [rows.schema["kept"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                names, score = _judge(shared.value, part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("kept"), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                    ["kept", "lang_pred", "score"],
                )

    return rows.mapInArrow(run, schema).select("kept.*", "lang_pred", "score")


def _judge(model: Filters, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
    """The language and score of each text."""
    shares, lettered = model.shares(texts)
    if not model.langs:
        return [UND] * len(texts), np.zeros(len(texts))
    at = shares.argmax(1)
    names = [model.langs[i] if ok else UND for i, ok in zip(at, lettered, strict=True)]
    return names, np.where(lettered, shares[np.arange(len(at)), at], 0.0)


def select(docs: DataFrame, filters: Filters, least: float, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in a learned language, known to at least the share ``least`` of their n-grams.

    Each row travels to Python once, and back only if it stays.
    """
    rows = docs.select(F.struct(*docs.columns).alias("kept"))
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "kept", 1 << 20):
                names, score = _judge(shared.value, part.column("kept").field(at).to_pylist())
                stays = (np.array(names) != UND) & (score >= least)
                yield part.filter(pa.array(stays))

    return rows.mapInArrow(run, rows.schema).select("kept.*")
