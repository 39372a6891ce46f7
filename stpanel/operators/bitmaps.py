"""Sets of step numbers as bitmaps of fixed size.

A set of whole numbers is cut into ranges of 32,768; the numbers of a range are a
bitmap of 4 KB. Bitmaps are built with partial aggregates, so repeated numbers
cost nothing, and distinct numbers are counted by their bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stpanel.operators.storage import materialize

BITS = 32_768


def bit_range(value: str) -> Column:
    return F.floor(F.col(value) / F.lit(BITS)).cast("long")


def bit_of(value: str) -> Column:
    return F.pmod(F.col(value).cast("long"), F.lit(BITS).cast("long"))


def bitmap(value: str) -> Column:
    """Aggregate: the bitmap of the values of one range."""
    return F.bitmap_construct_agg(bit_of(value))


def bitmaps(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "bits") -> DataFrame:
    """``by, _range, bits``: the distinct numbers in ``value``; NULLs are left out."""
    rows = df.select(*by, bit_range(value).alias("_range"), F.col(value)).where(F.col(value).isNotNull())
    return rows.groupBy(*by, "_range").agg(bitmap(value).alias(name))


def count_distinct(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "n") -> DataFrame:
    """The number of distinct whole numbers per ``by``, from the bits of each range."""
    counts = bitmaps(df, value, by).groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))
    return counts.withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))


def extent(df: DataFrame, *columns: str) -> DataFrame:
    """``n_rows`` and one count of distinct whole numbers per column, in one scan.

    Rows are reduced to bitmaps per combination of ranges, which is a single group
    for up to 32,768 steps and nodes; the columns are then counted from those.
    """
    grouped = df.select(*columns).groupBy(*[bit_range(c).alias(f"_r{i}") for i, c in enumerate(columns)])
    cells = materialize(
        grouped.agg(F.count(F.lit(1)).alias("n"), *[bitmap(c).alias(f"_b{i}") for i, c in enumerate(columns)]), "extent"
    )
    counts = []
    for i in range(len(columns)):
        whole = cells.groupBy(f"_r{i}").agg(F.bitmap_or_agg(f"_b{i}").alias("bits"))
        counts.append(whole.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0))).scalar().cast("long").alias(f"n_{columns[i]}"))
    return cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")).select("n_rows", *counts)


def _byte(bits: Column, at: Column) -> Column:
    return F.substring(bits, (at + 1).cast("int"), F.lit(1))


def members_without(bits: Column, other: Column, start: Column) -> Column:
    """The numbers that ``bits`` holds and ``other`` (or NULL, an empty set) lacks; ``start`` begins the range.

    Only bytes that differ are taken apart.
    """
    zero = F.unhex(F.lit("00"))
    empty = F.coalesce(other, F.unhex(F.lit("")))
    theirs = lambda at: F.when(F.octet_length(empty) > at, _byte(empty, at)).otherwise(zero)
    number = lambda byte: F.conv(F.hex(byte), 16, 10).cast("int")
    bytes_ = F.filter(F.sequence(F.lit(0), F.lit(BITS // 8 - 1)), lambda at: _byte(bits, at) != theirs(at))

    def numbers(at: Column) -> Column:
        left = number(_byte(bits, at)).bitwiseAND(F.bitwise_not(number(theirs(at))))
        ones = F.filter(F.sequence(F.lit(0), F.lit(7)), lambda bit: F.getbit(left, bit) == 1)
        return F.transform(ones, lambda bit: start + (at * 8 + bit).cast("long"))

    return F.flatten(F.transform(bytes_, numbers))
