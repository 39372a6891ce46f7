import itertools
import random
import re

import numpy as np
import pytest

from stpanel.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1]))
                if not 14 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out, key=lambda s: (s[0], list(PATTERNS).index(s[1])))


@pytest.fixture(scope="module")
def field(spark):
    return pii.train(pii.labelled_table(spark))


def test_base_on_random_texts():
    r = random.Random(0)
    bits = ["@", ".", "-", "+", " ", "(", ")", "1", "23", "255", "4111 1111 1111 1111", "a", "b.c", "x@y.z", "%", "1.2.3.4", "é", "\n", "+1 (212) 555-0187"]
    for _ in range(4000):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 25)))
        assert pii.base_spans(text) == plain(text), text


def test_base_on_the_table(spark):
    for row in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect():
        assert pii.base_spans(row["text"]) == plain(row["text"])


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000 + "@", "+1" + "(" * 100_000, "1." * 50_000, "a@" * 50_000, "0" * 5000 + ".1.1.1", "4 " * 60_000])
def test_hard_texts_end(text, field):
    base, every = pii.scan_texts([text], field)
    assert set(base[0]) <= set(every[0])


def test_viterbi_against_all_paths():
    r = np.random.default_rng(3)
    field = pii.Field()
    field.emit = r.normal(size=field.emit.shape)
    field.step = r.normal(size=field.step.shape)
    rows = [r.integers(1, len(pii.shapes()), n).tolist() for n in (1, 2, 3, 4)]
    x, lengths = pii.pad(rows)
    paths = field.decode(x, lengths)
    for i, row in enumerate(rows):
        e = field.scores(x)[i]
        step = field.step + field.allowed
        value = lambda p: field.first[p[0]] + sum(e[t, l] for t, l in enumerate(p)) + sum(step[a, b] for a, b in itertools.pairwise(p))
        best = max(itertools.product(range(len(pii.LABELS)), repeat=len(row)), key=value)
        assert tuple(paths[i, : len(row)]) == best


def test_field_learns_its_table(spark, field):
    rows = pii.labelled_table(spark).collect()
    wanted = found = hit = 0
    for row in rows:
        true = {(s["start"], s["kind"], s["end"]) for s in row["spans"]}
        got = set(pii.scan_texts([row["text"]], field)[1][0])
        wanted, found, hit = wanted + len(true), found + len(got), hit + len(true & got)
    assert hit >= 0.9 * wanted and hit >= 0.9 * found


def test_new_lines(field):
    texts = [
        "Please call (030) 555 0182 in the morning.", "My telephone: 040-555-7719, thanks", "fax 0221 / 555 88 12 office",
        "In 2017 about 3500 people of 12 towns came.", "It cost 1,450.00 on 2021-03-04 at 11:45.", "chapter 12.3 has 40 pages",
    ]
    _, spans = pii.scan_texts(texts, field)
    assert [[(t[s:e], k) for s, k, e in row] for t, row in zip(texts, spans, strict=True)] == [
        [("(030) 555 0182", "phone")], [("040-555-7719", "phone")], [("0221 / 555 88 12", "phone")], [], [], [],
    ]


def test_nothing_new_on_the_corpus(spark, field):
    """The corpus holds no personal data beyond the patterns; few spans may be added."""
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").limit(4000).collect()]
    base, every = pii.scan_texts(texts, field)
    added = sum(len(e) - len(b) for b, e in zip(base, every, strict=True))
    assert added <= 0.01 * len(texts)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("write to anna.müller" + 70 * "ü" + "@example.org soon", "anna.müller" + 70 * "ü" + "@example.org"),
        ("write to " + 90 * "x" + " @ example . org today", 90 * "x" + " @ example . org"),
    ],
)
def test_long_spans_are_whole(field, text, want):
    _, spans = pii.scan_texts([text], field)
    assert [text[s:e] for s, k, e in spans[0] if k == "email"] == [want]


def test_chains_end_at_white_space():
    r = random.Random(1)
    for _ in range(500):
        text = "".join(r.choice("ab1@ \n") * r.choice([1, 1, 9, 60]) for _ in range(r.randint(0, 30)))
        found = pii.chains(text)
        assert all(b[0] > a[1] for a, b in itertools.pairwise(found))
        for start, end in found:
            assert start == 0 or text[start - 1].isspace() or text[start].isspace()
            assert end == len(text) or text[end].isspace()
        inside = lambda i: any(s <= i < e for s, e in found)
        assert all(inside(i) for i, c in enumerate(text) if c in "1@")


def test_find_and_redact(spark, field):
    text = "Mail a.b@c.de or +1 (212) 555-0187 now, 10.0.0.1 too."
    docs = spark.createDataFrame([(1, text, "k", [1]), (2, None, None, None), (None, "", "", []), (1, text, "k", [1])], "doc_id long, text string, kept string, base array<int>")
    rows = pii.find(docs, field).collect()
    assert len(rows) == 4
    got = {r["doc_id"]: [tuple(s) for s in r["base"]] for r in rows}
    assert got[1] == plain(text) and got[2] == [] and got[None] == []
    clean = sorted((tuple(r) for r in pii.redact(docs, field).collect()), key=str)
    want = "Mail <email> or <phone> now, <ip> too."
    assert clean == sorted([(1, want, "k", [1]), (2, None, None, None), (None, "", "", []), (1, want, "k", [1])], key=str)
    assert pii.find(docs.limit(0), field).collect() == [] and pii.redact(docs.limit(0), field).collect() == []


def test_masked_overlaps():
    assert pii.masked("abcdefgh", [(1, "card", 4), (3, "phone", 6)]) == "a<card>gh"
