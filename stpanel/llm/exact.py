"""Exact deduplication with an extendible-hash index on shared files.

A text's key is a 64-bit hash of its normalised form. The index has one record
per key, filed in buckets by the key's first bits. A directory of 2**depth slots
points to the buckets. It starts with too few slots and doubles: each overfull
bucket splits on its next bit, while slots of the others keep sharing one. The
records are written to shared files in key order, so that every owner task holds
whole buckets, a range of keys.

Keys only nominate: the texts of keys with several rows are compared byte by byte
(a grouping by key and text, combined before it is shuffled). Where a key turns
out to hold different texts, the key's chain gets one link per text, and its rows
are assigned by text.

A third of all rows may share a text: its rows become one record before anything
is shuffled, and the few keys that hold over a thousandth of the rows are matched
by a broadcast of fewer than 1,000 records.

NULL texts count as empty. Runs of ASCII white space are one space. The row with
the smallest id stays, NULL ids last; of rows with the same text and id one
stays. Bytes that are not UTF-8 count as U+FFFD. An empty table gives an empty
result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stpanel.operators.storage import attach, materialize

CAPACITY = 20_000  # keys in a bucket before it splits
KEY_BITS = 64
HOT_SHARE = 1_000  # a key with more than one in so many rows is matched by broadcast


def normalised(text: str = "text") -> Column:
    """The text with every run of ASCII white space as one space; empty for NULL.

    Single spaces, which are most of the runs, are left alone.
    """
    runs = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), runs, " ")


def hash_key(text: Column, bits: int = KEY_BITS) -> Column:
    """The first ``bits`` bits of the text's 64-bit hash, as the high bits of a BIGINT."""
    return F.xxhash64(text) if bits == 64 else F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 64 - bits), 64 - bits)


def slot(key: str, depth: int) -> Column:
    """The directory slot of a key: its first ``depth`` bits."""
    return F.shiftrightunsigned(F.col(key), 64 - depth) if depth else F.lit(0).cast("long")


@dataclass
class Index:
    """``directory``: slot, bucket; ``pages``: bucket, key and its record, in key order."""

    directory: DataFrame
    pages: DataFrame
    depth: int


def build_directory(keys: DataFrame, capacity: int = CAPACITY, bits: int = KEY_BITS) -> tuple[DataFrame, int]:
    """``slot, bucket`` of a directory for distinct, stored keys, and its depth.

    Starts at the depth where buckets are between once and twice full on average,
    and doubles until no bucket is overfull or the bits are used up; each doubling
    is an aggregate over the keys of overfull buckets. A bucket is named after its
    first slot at full depth.
    """
    depth = min(bits, max(0, (keys.count() // capacity).bit_length() - 1))
    buckets, settled = keys.sparkSession.range(1 << depth).select(F.col("id").alias("slot")), []
    while True:
        rows = attach(keys.select(slot("key", depth).alias("slot")), buckets, "slot", "left_semi")
        loads = rows.groupBy("slot").agg(F.count(F.lit(1)).alias("load"))
        filled = buckets.join(loads, "slot", "left").select("slot", F.coalesce("load", F.lit(0)).alias("n"))
        counts = materialize(filled, "index-buckets")
        full = (F.col("n") > capacity) if depth < bits else F.lit(False)
        settled.append((depth, counts.filter(~full).select("slot")))
        splitting = counts.filter(full).select("slot")
        if splitting.isEmpty():
            break
        buckets = splitting.select(F.explode(F.array(F.shiftleft("slot", 1), F.shiftleft("slot", 1) + 1)).alias("slot"))
        depth += 1
    slots = []
    for level, buckets in settled:
        shared = depth - level
        first = F.shiftleft("slot", shared)
        slots.append(
            buckets.select(first.alias("bucket"), F.explode(F.sequence(first, first + ((1 << shared) - 1))).alias("slot"))
        )
    return materialize(reduce(DataFrame.unionByName, slots).select("slot", "bucket"), "index-directory"), depth


def build_index(entries: DataFrame, capacity: int = CAPACITY, bits: int = KEY_BITS) -> Index:
    """The index of stored entries ``row, doc_id, key``."""
    records = materialize(_classes(entries, "key"), "index-records")
    directory, depth = build_directory(records.select("key"), capacity, bits)
    filed = attach(records.withColumn("slot", slot("key", depth)), directory, "slot").drop("slot")
    pages = filed.repartitionByRange("bucket").sortWithinPartitions("bucket", "key")
    return Index(directory, materialize(pages, "index-pages"), depth)


def _classes(entries: DataFrame, *by: str) -> DataFrame:
    """Per class: rows, the smallest id, and the row that stays; combined before the shuffle."""
    return entries.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("doc_id").alias("keep_id"),
        F.coalesce(F.min_by("row", "doc_id"), F.min("row")).alias("keep_row"),
    )


def chains(texts: DataFrame, index: Index) -> DataFrame:
    """Keys whose rows hold different texts, by comparing the bytes of ``key, text`` rows."""
    shared = index.pages.filter("n > 1").select("key", "bucket")
    links = attach(texts, shared, "key").groupBy("bucket", "key", "text").agg(F.count(F.lit(1)).alias("n"))
    return links.groupBy("bucket", "key").agg(F.count(F.lit(1)).alias("links")).filter("links > 1").select("key")


def mark(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    keep: Sequence[str] = (),
    capacity: int = CAPACITY,
    key_bits: int = KEY_BITS,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    With ``keep``, those columns follow as the struct ``doc``, so that
    ``filter("kept").select("doc.*")`` is the table without copies.
    """
    carried = [F.struct(*keep).alias("doc")] if keep else []
    hashed = docs.select(F.col(doc_id).alias("doc_id"), normalised(text).alias("text"), *carried)
    hashed = hashed.withColumn("key", hash_key(F.col("text"), key_bits))
    columns = ["row", "doc_id", "key", "sha", *(["doc"] if keep else [])]
    sha = F.unhex(F.sha2("text", 256)).alias("sha")
    entries = materialize(hashed.select("*", sha, F.monotonically_increasing_id().alias("row")).select(*columns), "index-entries")
    index = build_index(entries, capacity, key_bits)
    several = materialize(chains(hashed.select("key", "text"), index), "index-chains")
    out = _by_key(entries, index.pages)
    if not several.isEmpty():
        out = out.join(several, "key", "left_anti").unionByName(_by_text(hashed, several, columns))
    return out.select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        *(["doc"] if keep else []),
    )


def _by_key(entries: DataFrame, pages: DataFrame) -> DataFrame:
    """Entries with their key's record; keys with many rows are matched without a shuffle."""
    total = entries.count()
    records = pages.drop("bucket")
    hot = F.col("n") * HOT_SHARE > total
    few = F.broadcast(records.filter(hot))  # under HOT_SHARE rows, as their n sum up to the total
    rest = entries.join(few.select("key"), "key", "left_anti")
    return entries.join(few, "key").unionByName(rest.join(records.filter(~hot), "key"))


def _by_text(hashed: DataFrame, several: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of colliding keys, each with the record of its own text."""
    rows = attach(hashed, several, "key", "left_semi")
    sha = F.unhex(F.sha2("text", 256)).alias("sha")
    rows = materialize(rows.select("*", sha, F.monotonically_increasing_id().alias("row")), "index-links")
    return rows.join(_classes(rows, "key", "text"), ["key", "text"]).select(*columns, "n", "keep_id", "keep_row")
