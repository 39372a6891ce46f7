"""Mixing sources to target weights with exact budgets.

Documents get hash-random keys. Within each source, key ranges cut the random
order into small even parts; the sizes of the parts are summed in two levels, and
each document learns how many words stand before it. A source's budget is whole
epochs over the source plus an exact cut through the last one.

No part grows with a source: keys are uniform, so a source with a third of all
documents has the same number of ranges as any other, of bounded length.

NULL sources are one source, last in order. NULL texts count 0 words. Documents
with equal keys (equal ids) follow each other by size; equal rows are
interchangeable. An empty table gives an empty result. Only the named columns
are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stpanel.operators.storage import materialize

COARSE = 1024  # key ranges of a source at the first level
ROWS = 1000  # rows aimed at in a range of the second level, for a source that holds all rows
KEY_BITS = 60
BLANKS = " \t\n\x0b\x0c\r"


def word_count(text: str = "text") -> Column:
    """Number of runs without ASCII white space; 0 for NULL.

    Each run, with the blanks before it, becomes one character; the words are never
    collected.
    """
    runs = F.regexp_replace(F.rtrim(F.col(text), F.lit(BLANKS)), r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++", "x")
    return F.coalesce(F.length(runs), F.lit(0)).cast("long")


def random_key(id_col: str = "doc_id") -> Column:
    """60 bits of the id's MD5: the same in every run."""
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def _ordered_sources(per_source: DataFrame) -> DataFrame:
    """Add ``rank`` (from 0, by code point, NULL last) without one task for all sources."""
    cut = materialize(
        per_source.repartitionByRange(F.col("none"), F.col("source")).withColumn("part", F.spark_partition_id()),
        "mix-sources",
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("part").orderBy("none", "source"))
    return cut.withColumn("own", own).join(before, "part").withColumn("rank", F.col("before") + F.col("own") - 1)


def targets(per_source: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Targets of sources with columns ``none, source, source_size``.

    Weights repeat over the sources in order. Together the targets are the sum of
    all sizes; a target above ``most`` times its source stops there, and the
    excess goes to the others by weight, until no target is above. Each round is
    one small aggregate over the stored sources.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = materialize(
        _ordered_sources(per_source).select("none", "source", "source_size", weight.cast("long").alias("weight")),
        "mix-weights",
    )
    cap, share = F.lit(most) * F.col("source_size"), F.col("weight").cast("decimal(38,0)")
    total, free = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    rest, free = total or 0, free or 0
    capped = F.lit(False)
    while free:
        above = share * F.lit(rest).cast("decimal(20,0)") > cap.cast("decimal(25,0)") * F.lit(free).cast("decimal(12,0)")
        held, left = sources.agg(F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))).first()
        capped = above
        if (total - (held or 0), left or 0) == (rest, free):
            break
        rest, free = total - (held or 0), left or 0
    else:
        capped = F.lit(True)
    target = F.when(capped, cap.cast("double")).otherwise(F.col("weight") * F.lit(rest) / F.lit(max(free, 1)))
    return sources.select("none", "source", "source_size", target.cast("double").alias("target"))


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``.

    With ``keep``, those columns as the struct ``kept`` instead of ``doc_id``.

    ``taken`` counts words with repeats: ``taken div size`` whole copies and one
    cut copy. A source's taken words are its target, rounded down.
    """
    keyed = docs.select(
        F.struct(*(keep or [F.col(doc_id).alias("doc_id")])).alias("kept"),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
        F.col(source).isNull().alias("none"),
        word_count(text).alias("size"),
        random_key(doc_id).alias("key"),
    )
    sized = materialize(keyed.drop("kept"), "mix-sizes")
    fine = max(1, sized.count() // (COARSE * ROWS))
    coarse = F.shiftright("key", KEY_BITS - 10)
    inner = F.col("key").bitwiseAND((1 << (KEY_BITS - 10)) - 1)
    ranges = {"coarse": coarse, "fine": F.floor(inner / F.lit((1 << (KEY_BITS - 10)) / fine))}
    rows = sized.withColumns(ranges)
    by = ["none", "source", "coarse", "fine"]
    parts = materialize(rows.groupBy(*by).agg(F.sum("size").alias("words")), "mix-parts")

    def earlier(keys, order):
        return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    blocks = parts.groupBy("none", "source", "coarse").agg(F.sum("words").alias("words"))
    outer = blocks.select(
        "none", "source", "coarse",
        F.coalesce(F.sum("words").over(earlier(["none", "source"], "coarse")), F.lit(0)).alias("outer"),
    )
    per_source = parts.groupBy("none", "source").agg(F.sum("words").alias("source_size"))
    budget = F.floor("target")
    goals = targets(per_source, weights, most).withColumns(
        {
            "epochs": F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0)),
            "cut": F.when(F.col("source_size") > 0, budget % F.col("source_size")).otherwise(F.lit(0)),
        }
    )
    offsets = (
        parts.withColumn("inner", F.coalesce(F.sum("words").over(earlier(by[:3], "fine")), F.lit(0)))
        .join(outer, by[:3])
        .join(goals, ["none", "source"])
        .select(*by, (F.col("inner") + F.col("outer")).alias("offset"), "source_size", "target", "epochs", "cut")
    )
    order = Window.partitionBy(*by).orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(order), F.lit(0)) + F.col("offset")
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("cut") - F.col("before")))
    if keep:
        rows = keyed.withColumns(ranges)
    return (
        rows.join(offsets, by)
        .withColumn("before", before)
        .select("kept" if keep else "doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs") + last).alias("taken"))
    )


def apply(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mixed documents, with the columns of ``docs``.

    A document comes once per whole copy the mix takes; the copy at a source's
    budget is cut after its last word (and ``n_chars``, if there, follows).
    Documents that the mix does not take are left out.
    """
    mixed = mix(docs, text, keep=docs.columns, **options).filter("taken > 0")
    whole = F.expr("cast(taken div size as int)")
    copies = F.explode(F.sequence(F.lit(1), whole + F.when(F.col("taken") % F.col("size") > 0, 1).otherwise(0)))
    rows = mixed.select("kept", "size", "taken", copies.alias("copy"))
    cut = F.col("copy") > whole
    pieces = F.regexp_extract_all(F.col(f"kept.{text}"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    begin = F.array_join(F.slice(pieces, F.lit(1), (F.col("taken") % F.col("size")).cast("int")), "")
    changed = {text: F.when(cut, begin).otherwise(F.col(f"kept.{text}"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(cut, F.length(begin).cast(kind)).otherwise(F.col("kept.n_chars"))
    return rows.select(*[changed.get(c, F.col(f"kept.{c}")).alias(c) for c in docs.columns])
