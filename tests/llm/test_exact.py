import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from stpanel.llm import exact

SCHEMA = "doc_id long, text string, key int, row string"


def plain(rows):
    """(doc_id, keep_id, group_size, kept, sha) per row, ordered."""
    norm = [re.sub("[\x20\x09-\x0d]+", " ", r[1] or "") for r in rows]
    groups = {}
    for i, t in enumerate(norm):
        groups.setdefault(t, []).append(i)
    out = []
    for t, members in groups.items():
        members.sort(key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
        for i in members:
            digest = hashlib.sha256(t.encode()).hexdigest()
            out.append((rows[i][0], rows[members[0]][0], len(members), i == members[0], digest))
    return sorted(out, key=str)


def got(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in exact.mark(docs, **options).collect()), key=str)


def sample(seed, n=300):
    r = random.Random(seed)
    texts = [None, "", " ", "\t\n", "a b", "a  b", "a b", "a b ", "A b", "é", "word " * 4000, *(f"t {r.randint(0, 60)}" for _ in range(n))]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(5, "a\x0bb"), (4, "a b"), (4, "a b"), (None, "a b"), (None, "only null"), (None, "only null"), *rows[:9]]
    rows += [(1000 + i, "hot copy") for i in range(n // 2)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("bits", [64, 6, 3, 1])
def test_against_plain(spark, bits):
    """Few bits make unequal texts collide; then the bytes decide."""
    rows = sample(bits)
    assert got(spark, rows, key_bits=bits, capacity=4) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "a")], [(1, "a"), (1, "a"), (1, "a")]])
def test_small(spark, rows):
    assert got(spark, rows) == plain(rows)


def test_hot_text_and_ordinary_ones(spark):
    rows = [(i, "same" if i % 3 == 0 else f"text {i // 2}") for i in range(4000)]
    assert got(spark, rows, capacity=100) == plain(rows)


@pytest.mark.parametrize("capacity", [20, 100, 10_000])
def test_directory_covers_all_keys_and_splits_full_buckets(spark, capacity):
    keys = exact.materialize(spark.range(1000).select(F.xxhash64("id").alias("key")), "keys")
    directory, depth = exact.build_directory(keys, capacity)
    slots = {r["slot"]: r["bucket"] for r in directory.collect()}
    assert sorted(slots) == list(range(1 << depth))
    load = {}
    for r in keys.collect():
        s = (r["key"] % (1 << 64)) >> (64 - depth) if depth else 0
        load[slots[s]] = load.get(slots[s], 0) + 1
    assert max(load.values()) <= capacity


def test_directory_stops_at_the_last_bit(spark):
    keys = exact.materialize(spark.range(50).select(exact.hash_key(F.col("id").cast("string"), 2).alias("key")), "keys")
    directory, depth = exact.build_directory(keys, 1, bits=2)
    assert depth == 2 and directory.count() == 4


def test_pages_are_in_key_order_with_whole_buckets(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 1700).alias("text"))
    rows = docs.select(F.col("doc_id").alias("row"), "doc_id", exact.hash_key(F.col("text")).alias("key"))
    index = exact.build_index(exact.materialize(rows, "entries"), capacity=100)
    owners = index.pages.withColumn("file", F.input_file_name()).groupBy("bucket").agg(F.countDistinct("file").alias("files"))
    assert owners.filter("files > 1").isEmpty()
    assert index.pages.count() == 1700 and index.pages.agg(F.sum("n")).first()[0] == 3000


def test_kept_rows_keep_their_columns(spark):
    rows = [(2, "b  c", 7, "k"), (1, "b c", 8, "l"), (3, None, 9, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    single = exact.mark(docs, keep=docs.columns).filter("kept").select("doc.*")
    assert single.columns == docs.columns
    assert sorted(tuple(r) for r in single.collect()) == [rows[1], rows[2]]


def test_native_plan(spark):
    docs = spark.createDataFrame([(1, "a", 1, "x")] * 3, SCHEMA)
    plan = exact.mark(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
