import struct

import public_tokenizers
import pytest
import tiktoken

from stpanel.llm import bpe
from stpanel.llm.queries import RANKS

PATTERN = public_tokenizers.PATTERN
ODD = [
    None, "", " ", "\n\n  x", "a" * 5000, "don't we'll", "\u00e9\u00e8 \u4f60\u597d \U0001f600\u200d", "<|endoftext|>", "\x00\x01\u2581 \xa0",
    "1234567 89,0!!! ???", "  lead", "tail  ", "\ufffd\ufeff", " ".join(["word"] * 30000),
]


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path(RANKS))


@pytest.fixture(scope="module")
def judge(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def unpack(ids):
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))


def test_odd_texts(spark, ranks, judge):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] * 2, "doc_id long, text string, ids string")
    rows = bpe.encode(docs, ranks, PATTERN, decoded=True).collect()
    assert len(rows) == 2 * len(ODD)
    for row in rows:
        text = ODD[row["doc_id"]] or ""
        assert unpack(row["ids"]) == judge.encode_ordinary(text)
        assert row["decoded"] == text.encode()


def test_round_trip(spark, ranks):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    back = bpe.decode(bpe.encode(docs, ranks, PATTERN), ranks).collect()
    assert {r["doc_id"]: bytes(r["decoded"]) for r in back} == {i: (t or "").encode() for i, t in enumerate(ODD)}


def test_table(spark, ranks, judge):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    coded = {r["doc_id"]: unpack(r["ids"]) for r in bpe.encode(docs, ranks, PATTERN).collect()}
    assert coded == {r["doc_id"]: judge.encode_ordinary(r["text"]) for r in docs.collect()}


def test_empty_table(spark, ranks):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(docs, ranks, PATTERN, decoded=True).collect() == []


def test_ranks_must_be_dense():
    with pytest.raises(ValueError):
        bpe.serialise({b"a": 0, b"b": 2})
