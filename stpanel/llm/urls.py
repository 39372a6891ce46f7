"""URL rules as a sort-merge range join.

A host with its labels reversed turns "this host and all subdomains" into one
key interval. Rule starts and URLs are sorted by key together, and a sweep keeps
the stack of rules whose interval is open: intervals of hosts with equally many
labels never overlap, so the stack has one slot per label count and a new start
replaces the old entry of its slot. Of the open rules, the longest whose path
starts the URL's path decides.

The sorted order is cut into ranges by key and row, so a host with a third of
all URLs is spread like any other; each range gets the stack it starts with from
a table of one row per range. Only DataFrame functions are used.

A NULL URL or one without "://" has an empty host and path and meets no rule.
Repeated rows give repeated results; an empty table of URLs or rules is fine.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stpanel.operators.storage import materialize

END = "\0"  # closes each label of a key
AFTER = "\1"  # the end of an interval: the next character after END


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: str) -> tuple[Column, Column]:
    """Host (lower-case) and path; both empty without "://"."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def host_key(host: str | Column) -> Column:
    """Labels from the last to the first, each closed by END; sorts a domain before its subdomains."""
    return F.concat(F.concat_ws(END, F.reverse(F.split(host, r"\."))), F.lit(END))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """A table of ``host, path, verdict`` from literals."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _fitting(top: Column) -> Column:
    """The rules of a stack slot that are open at the row's key and fit its path."""
    covers = (top["until"] > F.col("key")) & F.endswith(F.concat(F.lit("."), "host"), F.concat(F.lit("."), top["host"]))
    fits = F.filter(top["paths"], lambda p: F.startswith(F.col("path"), p["path"]))
    found = F.transform(
        fits,
        lambda p: F.struct(
            (F.length(top["host"]) + F.length(p["path"])).alias("length"),
            F.concat(top["host"], p["path"]).alias("rule"),
            p["verdict"].alias("verdict"),
        ),
    )
    return F.when(covers, found)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", page_id: str = "page_id", default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` has ``host, path, verdict``; one host's rules are kept together.
    Without a fitting rule, ``rule`` is NULL and the verdict ``default``, except
    that a URL without a host is blocked.
    """
    host, path = url_parts(url)
    urls = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")).select(
        "page_id", host.alias("host"), path.alias("path")
    )
    starts = (
        rules.groupBy("host")
        .agg(F.collect_set(F.struct("path", "verdict")).alias("paths"))
        .withColumn("slot", F.size(F.split("host", r"\.")))
    )
    slots = [r[0] for r in starts.select("slot").distinct().orderBy("slot").collect()]
    entry = "struct<key: string, until: string, host: string, paths: array<struct<path: string, verdict: string>>>"
    events = urls.select(
        host_key("host").alias("key"), F.lit(1).alias("kind"), "page_id", "host", "path",
        *[F.lit(None).cast(entry).alias(f"open{s}") for s in slots],
    ).unionByName(
        starts.withColumn("key", host_key("host")).select(
            "key", F.lit(0).alias("kind"), F.lit(None).cast(urls.schema["page_id"].dataType).alias("page_id"),
            F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"),
            *[
                F.when(
                    F.col("slot") == s,
                    F.struct("key", F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit(AFTER)).alias("until"), "host", "paths"),
                ).cast(entry).alias(f"open{s}")
                for s in slots
            ],
        )
    )
    cut = materialize(
        events.repartitionByRange("key", "kind", F.xxhash64("page_id", "path")).withColumn("part", F.spark_partition_id()),
        "url-events",
    )
    # Keys grow along the sweep, so the latest start of a slot is the largest one.
    tops = cut.groupBy("part").agg(*[F.max(f"open{s}").alias(f"top{s}") for s in slots], F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = tops.select("part", *[F.max(f"top{s}").over(before).alias(f"carry{s}") for s in slots])
    sweep = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = cut.select(
        "part", "key", "kind", "page_id", "host", "path", *[F.max(f"open{s}").over(sweep).alias(f"own{s}") for s in slots]
    ).join(carry, "part")
    stack = [_fitting(F.greatest(f"own{s}", f"carry{s}")) for s in slots]
    none = F.array().cast("array<struct<length: int, rule: string, verdict: string>>")
    longest = F.array_max(reduce(lambda a, b: F.concat(a, b), [F.coalesce(x, none) for x in stack], none))
    open_default = F.when(F.col("host") == "", F.lit("block")).otherwise(F.lit(default))
    return (
        swept.filter("kind = 1")
        .withColumn("longest", longest)
        .select("page_id", "host", "path", F.col("longest.rule").alias("rule"), F.coalesce("longest.verdict", open_default).alias("verdict"))
    )
