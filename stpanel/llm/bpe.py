"""Byte-level BPE through a sentencepiece model that is serialised from a rank file.

Every byte is mapped to a printable character, every vocabulary entry becomes a
piece with the score ``-rank``, and normalisation is the identity. Merging by the
best score is then merging by the lowest rank. Pre-tokens are encoded one by one,
so no merge crosses them. Decoding looks each id up in the inverse table.

NULL and empty texts have no ids. Texts are taken whole, at any length. Rows
are independent: repeated rows give repeated results, an empty table an empty
one, and only the named columns are read, so further columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Pre-tokens remembered by one Python worker before it starts afresh.
CACHE = 400_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Read a rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def byte_characters() -> list[str]:
    """A printable character for each byte; printable Latin-1 bytes stay themselves."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _piece(text: str, score: float, kind: int) -> bytes:
    score_field = _varint(2 << 3 | 5) + struct.pack("<f", score)
    return _bytes(1, _bytes(1, text.encode()) + score_field + _number(3, kind))


def serialise(ranks: Mapping[bytes, int]) -> bytes:
    """The sentencepiece model of a rank file; ids are ranks, the id after them is unknown."""
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must count from 0 without gaps")
    # Fixed numbers of the model format: piece kinds and field numbers.
    normal, unknown, bpe = 1, 2, 2
    chars = byte_characters()
    pieces = [
        _piece("".join(chars[b] for b in token), -float(rank), normal)
        for token, rank in sorted(ranks.items(), key=lambda item: item[1])
    ]
    trainer = _number(3, bpe) + _number(4, len(ranks) + 1) + _number(40, len(ranks))
    # No dummy prefix, no removed spaces, no escaped spaces.
    identity = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _piece("<unk>", 0.0, unknown) + _bytes(2, trainer) + _bytes(3, identity)


class Codec:
    """Encodes and decodes in a task; remembers the ids of frequent pre-tokens."""

    def __init__(self, model: bytes, tokens: Sequence[bytes], pattern: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.tokens = tokens
        self.ranks = {token: rank for rank, token in enumerate(tokens)}
        self.split = regex.compile(pattern).findall
        self.chars = dict(enumerate(byte_characters()))
        self.known: dict[str, bytes] = {}

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        parts = self.split(text or "")
        new = {p for p in parts if p not in self.known}
        if new:
            if len(self.known) + len(new) > CACHE:
                self.known.clear()
                new = set(parts)
            self._learn(sorted(new))
        return b"".join(map(self.known.__getitem__, parts))

    def _learn(self, parts: Sequence[str]) -> None:
        raw = [p.encode() for p in parts]
        mapped = [r.decode("latin-1").translate(self.chars) for r in raw]
        for part, r, ids in zip(parts, raw, self.model.encode(mapped, num_threads=1), strict=True):
            # A whole pre-token in the vocabulary is one id, whatever the merges say.
            whole = self.ranks.get(r)
            self.known[part] = struct.pack(f"<{len(ids)}I", *ids) if whole is None else struct.pack("<I", whole)

    def decode(self, ids: bytes | None) -> bytes:
        return b"".join(map(self.tokens.__getitem__, struct.unpack(f"<{len(ids or b'') // 4}I", ids or b"")))


_codecs: dict[bytes, Codec] = {}


def _codec(model: bytes, tokens: Sequence[bytes], pattern: str) -> Codec:
    """One codec per Python worker and vocabulary, kept between tasks."""
    key = hashlib.md5(model + pattern.encode()).digest()
    if key not in _codecs:
        _codecs[key] = Codec(model, tokens, pattern)
    return _codecs[key]


def _vocabulary(df: DataFrame, ranks: Mapping[bytes, int]):
    tokens = sorted(ranks, key=ranks.__getitem__)
    return df.sparkSession.sparkContext.broadcast((serialise(ranks), tokens))


def encode(
    docs: DataFrame,
    ranks: Mapping[bytes, int],
    pattern: str,
    text: str | Column = "text",
    keep: Sequence[str] = ("doc_id",),
    decoded: bool = False,
) -> DataFrame:
    """``keep`` columns, ``ids`` (little-endian unsigned 32-bit) of each whole text.

    With ``decoded`` also the bytes the ids stand for, from the same pass. The
    vocabulary (about 1 MB) is the only thing sent to the tasks.
    """
    rows = docs.select(F.struct(*keep).alias("kept"), (F.col(text) if isinstance(text, str) else text).alias("text"))
    fields = [T.StructField("kept", rows.schema["kept"].dataType), T.StructField("ids", T.BinaryType())]
    if decoded:
        fields.append(T.StructField("decoded", T.BinaryType()))
    shared = _vocabulary(docs, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*shared.value, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [codec.encode(t) for t in part.column("text").to_pylist()]
                out = {"kept": part.column("kept"), "ids": pa.array(ids, pa.binary())}
                if decoded:
                    out["decoded"] = pa.array([codec.decode(i) for i in ids], pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    return rows.mapInArrow(run, T.StructType(fields)).select("kept.*", *[f.name for f in fields[1:]])


def decode(
    encoded: DataFrame, ranks: Mapping[bytes, int], ids: str = "ids", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns and ``decoded``, the bytes that ``ids`` stand for."""
    rows = encoded.select(F.struct(*keep).alias("kept"), F.col(ids).alias("ids"))
    schema = T.StructType([rows.schema["kept"], T.StructField("decoded", T.BinaryType())])
    shared = _vocabulary(encoded, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*shared.value, "")
        for batch in batches:
            out = [codec.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"kept": batch.column("kept"), "decoded": pa.array(out, pa.binary())})

    return rows.mapInArrow(run, schema).select("kept.*", "decoded")


def slices(batch: pa.RecordBatch, column: str, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``size`` bytes of ``column``, one row at least."""
    rows = max(1, int(batch.num_rows * size / max(1, batch.column(column).nbytes)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
