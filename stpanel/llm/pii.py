"""Personal data: fixed patterns and a linear-chain conditional random field.

The patterns give the base spans. The field labels the tokens around anything
that could be personal data by their word shapes and adds spans that no pattern
covers, such as telephone numbers without a country code. It is trained by
gradient ascent on a small labelled table and decoded by Viterbi, many chains
at a time. An added span must pass an exact check of its kind and may not touch
a base span.

Every span needs a digit or an "@", so chains are laid around those characters:
``REACH`` characters to either side and on to white space, joined where they meet.
The whole text is searched for them; neither a chain nor a span has a longest
length. A run of labelled tokens that is no whole span is tried in its parts between
white space.

NULL and empty texts have no spans. Texts are taken whole. Rows are independent,
repeated rows give repeated results, and only the named columns are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stpanel.llm.batches import small_batches
from stpanel.llm.bpe import slices

KINDS = ("email", "ip", "card", "phone")
REACH = 48

# The contract's patterns, written so that no text makes them backtrack far: a
# number is entered at its first digit only, and an address at its "@".
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, str, int]  # start, kind, end


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _octet(digits: str) -> bool:
    short = digits.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, in order of start, then kind."""
    spans = [(s, "email", e) for s, e in _emails(text)] if "@" in text else []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), "card", m.end()))
    if "." in text:
        for m in _IP.finditer(text):
            if all(_octet(p) for p in m[0].split(".")):
                spans.append((m.start(), "ip", m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                spans.append((m.start(), "phone", m.end()))
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[1])))


# --- chains -----------------------------------------------------------------

_ANCHOR = re.compile(r"[0-9@]+")
_BLANK = re.compile(r"\s")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\W\d_]+|[^\sA-Za-z0-9]")

#: Words that announce a kind of personal data.
CUES = {
    "email": "email mail e-mail address contact write courriel correo",
    "ip": "ip host server addr address adresse",
    "card": "card visa mastercard amex credit karte carte tarjeta",
    "phone": "phone tel telephone call fax mobile cell telefon ruf telefono",
}
_CUE = {w: f"cue:{kind}" for kind, words in CUES.items() for w in words.split()}
_MARKS = "@.-+()/:,"


def shape(token: str) -> str:
    """The word shape of a token; digits by their number, letters by case."""
    if token[0].isdigit() and token.isascii():
        n = len(token)
        if 14 <= n <= 19:
            return "d14+luhn" if luhn(token) else "d14+"
        return f"d{n}" if n < 5 else "d5-6" if n < 7 else "d7-9" if n < 10 else "d10-13" if n < 14 else "d20+"
    if token.isalpha():
        lower = token.lower()
        if lower in _CUE:
            return _CUE[lower]
        if lower in ("at", "dot"):
            return lower
        return "X" if token.isupper() else "Xx" if token[0].isupper() else "x" if len(token) > 3 else "xx"
    return token if token in _MARKS else "?"


@cache
def shapes() -> dict[str, int]:
    """Numbers of all shapes, each with and without a space before; 0 is padding."""
    plain = ["d1", "d2", "d3", "d4", "d5-6", "d7-9", "d10-13", "d14+", "d14+luhn", "d20+", "at", "dot"]
    plain += ["X", "Xx", "x", "xx", "?", *_MARKS, *(f"cue:{k}" for k in KINDS)]
    return {f"{gap}{s}": i + 1 for i, (gap, s) in enumerate((g, s) for g in ("", " ") for s in plain)}


LABELS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
WINDOW = 4  # shapes to either side that a label sees


def chains(text: str) -> list[tuple[int, int]]:
    """The parts of a text around its digits and "@" signs; they begin and end at white space.

    A word that the reach would cut is taken whole, with REACH characters beyond it.
    """
    out: list[tuple[int, int]] = []
    done = 0
    for m in _ANCHOR.finditer(text):
        if out and m.end() + REACH <= done:
            continue
        end = _word_end(text, m.end() + REACH)
        if end > m.end() + REACH:
            end = _word_end(text, end + REACH)
        start = _word_start(text, m.start() - REACH, done)
        if start < m.start() - REACH:
            start = _word_start(text, start - REACH, done)
        if out and start <= done:
            out[-1] = (out[-1][0], max(done, end))
        else:
            out.append((start, end))
        done = out[-1][1]
    return out


def _word_end(text: str, at: int) -> int:
    """The end of the word that ``at`` falls into."""
    if at >= len(text) or text[at - 1].isspace():
        return min(at, len(text))
    blank = _BLANK.search(text, at)
    return blank.start() if blank else len(text)


def _word_start(text: str, at: int, least: int) -> int:
    """The start of the word that ``at`` falls into, but not before ``least``."""
    at = max(at, 0)
    while at > least and not text[at - 1].isspace():
        at -= 1
    return at


def tokens(text: str, start: int, end: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Shape numbers and spans of the tokens that lie in a part of a text."""
    numbers, spans, last = [], [], start
    known = shapes()
    for m in _TOKEN.finditer(text, start, end):
        gap = " " if m.start() > last or not spans else ""
        numbers.append(known[gap + _shape_of(m[0])])
        spans.append(m.span())
        last = m.end()
    return numbers, spans


_shapes_seen: dict[str, str] = {}


def _shape_of(token: str) -> str:
    found = _shapes_seen.get(token)
    if found is None:
        if len(_shapes_seen) > 200_000:
            _shapes_seen.clear()
        found = _shapes_seen[token] = shape(token)
    return found


class Field:
    """Weights of the chain: labels by the shapes around them, and label pairs."""

    def __init__(self) -> None:
        n = len(LABELS)
        self.emit = np.zeros((2 * WINDOW + 1, len(shapes()) + 1, n))
        self.step = np.zeros((n, n))
        # I-x only follows B-x or I-x, and no chain starts with I-x.
        self.allowed = np.zeros((n, n))
        self.first = np.zeros(n)
        for j, label in enumerate(LABELS):
            if label[0] == "I":
                self.first[j] = -1e9
                self.allowed[:, j] = -1e9
                self.allowed[[LABELS.index(f"B{label[1:]}"), j], j] = 0.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Label scores (chain, token, label) of padded shape numbers."""
        wide = np.pad(x, ((0, 0), (WINDOW, WINDOW)))
        return sum(self.emit[o][wide[:, o : o + x.shape[1]]] for o in range(2 * WINDOW + 1))

    def decode(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best labels by Viterbi, all chains together."""
        e, step = self.scores(x), self.step + self.allowed
        best, back = e[:, 0] + self.first, np.zeros((*x.shape, len(LABELS)), np.int8)
        rows = np.arange(len(x))
        for t in range(1, x.shape[1]):
            moves = best[:, :, None] + step
            back[:, t] = moves.argmax(1)
            new = moves.max(1) + e[:, t]
            best = np.where((t < lengths)[:, None], new, best)
        path = np.zeros(x.shape, np.int8)
        at = best.argmax(1)
        for t in range(x.shape[1] - 1, -1, -1):
            path[:, t] = at
            at = np.where(t < lengths, back[rows, t, at] if t else at, at)
        return path

    def fit(self, x: np.ndarray, lengths: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.3, decay: float = 1e-4) -> None:
        """Gradient ascent (Adagrad) on the log-likelihood of all chains."""
        n, (b, t_max) = len(LABELS), x.shape
        inside = np.arange(t_max) < lengths[:, None]
        gold = np.eye(n)[y] * inside[:, :, None]
        pairs = (gold[:, :-1, :, None] * gold[:, 1:, None, :]).sum((0, 1))
        wide = np.pad(x, ((0, 0), (WINDOW, WINDOW)))
        seen = [np.zeros_like(self.emit), np.zeros_like(self.step)]
        for _ in range(rounds):
            e, step = self.scores(x), np.exp(self.step + self.allowed)
            forward, backward = np.zeros((b, t_max, n)), np.ones((b, t_max, n))
            weight = np.exp(e - e.max(2, keepdims=True))
            forward[:, 0] = weight[:, 0] * np.exp(self.first)
            forward[:, 0] /= forward[:, 0].sum(1, keepdims=True)
            for t in range(1, t_max):
                a = (forward[:, t - 1] @ step) * weight[:, t]
                forward[:, t] = np.where(inside[:, t, None], a / np.maximum(a.sum(1, keepdims=True), 1e-300), 0.0)
            for t in range(t_max - 2, -1, -1):
                a = (backward[:, t + 1] * weight[:, t + 1]) @ step.T
                backward[:, t] = np.where(inside[:, t + 1, None], a / np.maximum(a.sum(1, keepdims=True), 1e-300), 1.0)
            belief = forward * backward * inside[:, :, None]
            belief /= np.maximum(belief.sum(2, keepdims=True), 1e-300)
            expected = np.zeros((n, n))
            for t in range(1, t_max):
                joint = forward[:, t - 1, :, None] * step * (weight[:, t] * backward[:, t])[:, None, :]
                total = joint.sum((1, 2), keepdims=True)
                expected += (joint / np.maximum(total, 1e-300) * inside[:, t, None, None]).sum(0)
            slope = np.zeros_like(self.emit)
            for o in range(2 * WINDOW + 1):
                np.add.at(slope[o], wide[:, o : o + t_max][inside], (gold - belief)[inside])
            for i, (w, g) in enumerate(((self.emit, slope), (self.step, pairs - expected))):
                g = g - decay * b * w
                seen[i] += g * g
                w += rate * g / np.sqrt(seen[i] + 1e-8)


def pad(rows: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows])
    out = np.zeros((len(rows), max(1, lengths.max(initial=1))), np.int32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.concatenate([np.asarray(r, np.int32) for r in rows]) if len(rows) else []
    return out, lengths


# Possessive, so that no text makes them backtrack.
_ADDRESS = re.compile(r"[\w.%+-]++ ?@ ?[\w-]++(?: ?\. ?[\w-]++)++")


def plausible(kind: str, text: str) -> bool:
    """The exact check of an added span."""
    if kind == "email":
        return bool(_ADDRESS.fullmatch(text))
    digits = _digits(text)
    if kind == "ip":
        parts = re.split(r"\D+", text)
        return len(parts) == 4 and all(p and _octet(p) for p in parts)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and bool(re.fullmatch(r"[(+]?[0-9][0-9 ()./-]*[0-9]", text)) and len(re.findall("[0-9]+", text)) > 1


def added_spans(texts: Sequence[str], base: Sequence[Sequence[Span]], field: Field, cells: int = 400_000) -> list[list[Span]]:
    """Spans that the field adds to each text."""
    found: list[list[Span]] = [[] for _ in texts]
    starts = [[s for s, _, _ in spans] for spans in base]
    reach = [list(accumulate((e for _, _, e in spans), max)) for spans in base]
    work = []
    for i, text in enumerate(texts):
        for start, end in chains(text):
            numbers, spans = tokens(text, start, end)
            if numbers:
                work.append((len(numbers), i, numbers, spans))
    work.sort(key=lambda w: w[0])
    first = 0
    while first < len(work):
        last = first + 1
        while last < len(work) and (last + 1 - first) * work[last][0] <= cells:
            last += 1
        x, lengths = pad([w[2] for w in work[first:last]])
        paths = field.decode(x, lengths)
        busy = np.flatnonzero(((paths > 0) & (np.arange(x.shape[1]) < lengths[:, None])).any(1))
        for row in busy:
            n, i, _, spans = work[first + row]
            for kind, a, b in _runs(paths[row, :n]):
                for start, end in _parts(kind, texts[i], spans[a : b + 1]):
                    at = bisect_left(starts[i], end)
                    if not at or reach[i][at - 1] <= start:  # no base span is touched
                        found[i].append((start, kind, end))
        first = last
    return found


def _parts(kind: str, text: str, spans: Sequence[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The whole run of tokens if it is a span of its kind, else its parts between white space that are."""
    if plausible(kind, text[spans[0][0] : spans[-1][1]]):
        yield spans[0][0], spans[-1][1]
        return
    first = 0
    for i in range(1, len(spans) + 1):
        if i == len(spans) or text[spans[i - 1][1] : spans[i][0]].strip() != text[spans[i - 1][1] : spans[i][0]]:
            part = spans[first][0], spans[i - 1][1]
            if (first or i < len(spans)) and plausible(kind, text[part[0] : part[1]]):
                yield part
            first = i


def _runs(path: np.ndarray) -> Iterator[tuple[str, int, int]]:
    """Labelled runs of a path: kind, first and last token."""
    kind, start = None, 0
    for t, label in enumerate([*(LABELS[p] for p in path), "O"]):
        if kind and label != f"I-{kind}":
            yield kind, start, t - 1
            kind = None
        if label[0] == "B":
            kind, start = label[2:], t


def scan_texts(texts: Sequence[str | None], field: Field) -> tuple[list[list[Span]], list[list[Span]]]:
    """Base spans, and all spans, of each text."""
    plain = [t or "" for t in texts]
    base = [base_spans(t) for t in plain]
    more = added_spans(plain, base, field)
    every = [sorted({*a, *b}, key=lambda x: (x[0], KINDS.index(x[1]), x[2])) for a, b in zip(base, more, strict=True)]
    return base, every


# --- training ---------------------------------------------------------------

#: The labelled table: personal data in brackets with its kind. Values are invented.
LABELLED = """
Call us at [phone:(020) 555 0143] before noon.
Our telephone number is [phone:030 5550 1992] in the office.
tel. [phone:0171-555-0192] or fax [phone:0171-555-0193] please
You can reach me on [phone:+44 20 5550 0199] after six.
phone: [phone:555-010-4477]; room 214, floor 3
Ruf mich an: Telefon [phone:089 / 555 01 22] heute.
Mobile [phone:(917) 555-0148], office hours 9 to 17.
contact [phone:1-800-555-0199] for 24 hour help
My number: [phone:+1 (212) 555-0187] thanks
write to [email:anna.berg@mail.example.org] soon
email [email:j.doe77@post.example.com] or call [phone:(415) 555-0133]
address: [email:sales @ shop . example] today
Correo [email:luis_m@correo.example.net], gracias
the server [ip:192.0.2.44] answered in 12 ms
host [ip:198.51.100.7] port 8080 closed
addr [ip:203 . 0 . 113 . 9] was blocked 3 times
paid by card [card:4111 1111 1111 1111] yesterday
visa [card:4012-8888-8888-1881] expires 12/27
Karte [card:5555555555554444] bitte
credit card [card:4222.2222.2222.2220] declined
the text [card:4111111111111111] stood alone
in the year 1998 there were 4500 of them
on 2019-04-12 at 10:30 the train 455 left
order 12345678 costs 1,299.00 for 2 people
see page 12, section 3.4.1 and figure 7
the ratio 3/4 of 1024 items, about 75 percent
ISBN 978-3-16-148410-0 in the second edition
key 1234567890123456 is not a valid one
serial 1234 5678 9012 3456 on the box
temperatures from -12.5 to 30.25 at 850 hPa
call number QA 76.73 is on shelf 19
we meet @ noon in room 5 of house 12
user @home wrote 300 lines on 3 May 2020
phone in 12 rooms and 45 halls, 2 floors
token 24be64439e3e49cf46b2d7c90f3602a3d0b907ff end
version 2.0 of 14.11.2021, build 20211114
lat 48.1372 lon 11.5756 height 519
""".strip().split("\n")


def labelled_table(spark: SparkSession, lines: Sequence[str] = tuple(LABELLED)) -> DataFrame:
    """``text, spans`` (start, kind, end) from bracketed lines."""
    rows = []
    for line in lines:
        text, spans = "", []
        for plain, kind, value in re.findall(r"([^\[]*)(?:\[(\w+):([^\]]*)\])?", line):
            text += plain
            if kind:
                spans.append((len(text), kind, len(text) + len(value)))
                text += value
        rows.append((text, spans))
    return spark.createDataFrame(rows, "text string, spans array<struct<start: int, kind: string, end: int>>")


def train(labelled: DataFrame, bound: int = 2000) -> Field:
    """Fit a field on at most ``bound`` rows of a labelled table (``text, spans``), by text order."""
    numbers, labels = [], []
    for row in labelled.orderBy("text").limit(bound).collect():
        for start, end in chains(row["text"] or ""):
            x, spans = tokens(row["text"], start, end)
            y = np.zeros(len(x), np.int64)
            for s in row["spans"] or []:
                inside = [i for i, (a, b) in enumerate(spans) if a >= s["start"] and b <= s["end"]]
                if inside:
                    y[inside] = LABELS.index(f"I-{s['kind']}")
                    y[inside[0]] = LABELS.index(f"B-{s['kind']}")
            numbers.append(x)
            labels.append(y)
    field = Field()
    if numbers:
        x, lengths = pad(numbers)
        field.fit(x, lengths, pad(labels)[0].astype(np.int64))
    return field


# --- tables -----------------------------------------------------------------

_SPANS = T.ArrayType(
    T.StructType(
        [T.StructField("start", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("end", T.IntegerType())]
    )
)
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))


def find(docs: DataFrame, field: Field, text: str = "text", keep: Sequence[str | Column] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``base`` and ``spans``: arrays of (start, kind, end) in code points."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*keep).alias("kept"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["kept"], T.StructField("base", _SPANS), T.StructField("spans", _SPANS)])
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = scan_texts(part.column("text").to_pylist(), shared.value)
                columns = [
                    pa.array([[{"start": s, "kind": k, "end": e} for s, k, e in row] for row in spans], _ARROW_SPANS)
                    for spans in found
                ]
                yield pa.RecordBatch.from_arrays([part.column("kept"), *columns], ["kept", "base", "spans"])

    return rows.mapInArrow(run, schema).select("kept.*", "base", "spans")


def masked(text: str, spans: Sequence[Span]) -> str:
    """The text with each span, or group of overlapping spans, replaced by its kind."""
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"<{kind}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """All columns of ``docs``, with the personal data in ``text`` replaced by its kind."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*docs.columns).alias("kept"))
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "kept"):
                columns = part.column("kept").flatten()
                texts = columns[at].to_pylist()
                _, spans = scan_texts(texts, shared.value)
                new = [masked(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
                columns[at] = pa.array(new, columns[at].type)
                kept = pa.StructArray.from_arrays(columns, fields=list(part.schema.field("kept").type))
                yield pa.RecordBatch.from_arrays([kept], ["kept"])

    return rows.mapInArrow(run, rows.schema).select("kept.*")


def digest(base: str = "base") -> Column:
    """``kind:start:end`` of all spans of an array, comma-joined."""
    return F.array_join(
        F.transform(base, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
