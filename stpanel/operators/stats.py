"""Aggregates over panels. Each is one partial-then-final hash aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stpanel.functions.scalar import is_missing
from stpanel.operators.bitmaps import extent
from stpanel.operators.panel import NODE, TIME
from stpanel.operators.storage import materialize


def global_stats(panel: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation of each column."""
    return panel.agg(
        *[
            agg
            for c in cols
            for agg in (F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"))
        ]
    )


def step_evolution(panel: DataFrame, col: str, digits: int | None = None) -> DataFrame:
    """Average and maximum over nodes for each time step."""
    avg, top = F.avg(col), F.max(col)
    if digits is not None:
        avg, top = F.round(avg, digits), F.round(top, digits)
    return panel.groupBy(TIME).agg(avg.alias("avg_value"), top.alias("max_value"))


def step_trend(panel: DataFrame, col: str, digits: int = 3, first: int = 5) -> DataFrame:
    """The rounded evolution of the first steps, as a top-k."""
    return step_evolution(panel, col, digits).orderBy(TIME).limit(first)


def missing_audit(panel: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing values (NULL or NaN) per column and in total, in one pass."""
    counts = panel.agg(
        *[
            F.coalesce(F.sum(F.when(is_missing(c), 1).otherwise(0)), F.lit(0)).alias(f"missing_{c}")
            for c in cols
        ]
    )
    total = sum((F.col(f"missing_{c}") for c in cols), F.lit(0))
    return counts.withColumn("missing_total", total.cast("long"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


SKETCH = 8192  # size of the quantile sketches: about 0.07 % error in rank
SLACK = 0.003  # share of the values looked at on each side of a rank
ACCURACY = 10_000


def _brackets(rows: DataFrame, names: Sequence[str], slack: float) -> tuple[int, int, DataFrame]:
    """Numbers of values and of NaN, and a row with a bracket around the middle.

    One pass gives each column a mergeable sketch; the merged sketch has the
    quantiles of all columns together.
    """
    found = rows.agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(names)],
        *[F.count(F.when(F.isnan(F.col(c).cast("double")), 1)).alias(f"x{i}") for i, c in enumerate(names)],
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(SKETCH)).alias(f"s{i}") for i, c in enumerate(names)],
    )
    found = materialize(found, "sketch")
    row = found.drop(*[f"s{i}" for i in range(len(names))]).first()
    n = sum(row[f"n{i}"] for i in range(len(names)))
    merged = [F.col(f"s{i}") for i in range(len(names)) if row[f"n{i}"]]
    sketch = reduce(F.kll_sketch_merge_double, merged) if merged else F.lit(None).cast("binary")
    middle = [max(0.0, 0.5 - slack - 1 / max(n, 1)), min(1.0, 0.5 + slack + 1 / max(n, 1))]
    ends = [F.kll_sketch_get_quantile_double(sketch, F.lit(q)).alias(e) for q, e in zip(middle, ("lo", "hi"), strict=True)]
    return n, sum(row[f"x{i}"] for i in range(len(names))), found.select(*ends)


def _ranked(rows: DataFrame, names: Sequence[str], lo: float, hi: float) -> DataFrame:
    """Values inside the bracket with their counts, ordered into ranges; all others as two rows."""

    def placed(c: str) -> Column:
        x = F.col(c).cast("double")
        side = F.when(x < lo, -1).when(x > hi, 1).otherwise(0)
        return F.when(x.isNotNull(), F.struct(side.alias("side"), F.when(side == 0, x).alias("v")))

    counts = rows.select(F.inline(F.array_compact(F.array(*[placed(c) for c in names])))).groupBy("side", "v").agg(
        F.count(F.lit(1)).alias("n")
    )
    return materialize(counts.repartitionByRange("side", "v").withColumn("part", F.spark_partition_id()), "bracket")


def _at_ranks(counts: DataFrame, ranks: Sequence[int]) -> list[tuple[int, float | None]]:
    """Side and value at each 0-based rank, from the ranges' totals and one range each."""
    totals = counts.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    out = []
    for rank in ranks:
        before = 0
        for part, n in totals:
            if rank < before + n:
                break
            before += n
        order = Window.partitionBy("part").orderBy("side", "v")
        upto = counts.where(F.col("part") == part).withColumn("upto", F.sum("n").over(order) + before)
        hit = upto.where(F.col("upto") > rank).agg(F.min(F.struct("side", "v"))).first()[0]
        out.append((hit["side"], hit["v"]))
    return out


def exact_median(rows: DataFrame, cols: str | Sequence[str]) -> float | None:
    """Exact median over all columns; NaN if any value is NaN, None without values.

    Two passes over the rows: mergeable quantile sketches bracket the middle rank,
    then values inside the bracket are counted one by one, all others as two rows.
    Memory does not depend on the number of rows. A bracket that misses the rank,
    which the counts show, is widened.
    """
    names = [cols] if isinstance(cols, str) else list(cols)
    slack = SLACK
    while True:
        n, n_nan, ends = _brackets(rows, names, slack)
        if n == 0:
            return None
        if n_nan:
            return float("nan")
        lo, hi = ends.first()
        ranks = sorted({(n - 1) // 2, n // 2})
        found = _at_ranks(_ranked(rows, names, lo, hi), ranks)
        if all(side == 0 for side, _ in found):
            return sum(v for _, v in found) / len(found)
        slack *= 8


def panel_profile(panel: DataFrame, features: Sequence[str], exact: bool = True) -> DataFrame:
    """Shape, maximum, minimum, mean and median over all features together."""
    highest = [F.max(c) for c in features]
    lowest = [F.min(c) for c in features]
    total = sum((F.coalesce(F.sum(c), F.lit(0.0)) for c in features), F.lit(0.0))
    number = sum((F.count(c) for c in features), F.lit(0))
    if exact:
        median = F.lit(exact_median(panel, features)).cast("double")
    else:
        values = panel.select(F.explode(F.array(*features)).alias("v"))
        median = values.agg(F.percentile_approx("v", 0.5, ACCURACY)).scalar()
    sizes = extent(panel, TIME, NODE)
    return panel.agg(
        sizes.select(f"n_{TIME}").scalar().alias("n_steps"),
        sizes.select(f"n_{NODE}").scalar().alias("n_nodes"),
        F.lit(len(features)).cast("long").alias("n_features"),
        (F.greatest(*highest) if len(features) > 1 else highest[0]).alias("max_value"),
        (F.least(*lowest) if len(features) > 1 else lowest[0]).alias("min_value"),
        F.try_divide(total, number).alias("mean_value"),
    ).withColumn("median_value", median)


def climatology(
    train: DataFrame, node_dim: DataFrame, target: str, name: str = "clim"
) -> DataFrame:
    """Per-node mean of the raw target over the training rows.

    Nodes without training rows get 0, so an empty training set gives zeros.
    """
    means = train.groupBy(NODE).agg(F.avg(target).alias(name))
    return (
        node_dim.select(NODE)
        .join(means, NODE, "left")
        .select(NODE, F.coalesce(name, F.lit(0.0)).alias(name))
    )


def histogram(df: DataFrame, col: str, bins: int = 60) -> DataFrame:
    """Equal-width bins over ``[min, max]``; the last bin is closed on the right.

    Empty bins are listed with count 0. If all values are equal, the range is
    half a unit to each side. Missing values are left out.
    """
    return histograms(df, {"": col}, bins).drop("series")


def histograms(df: DataFrame, cols: Mapping[str, str], bins: int = 60) -> DataFrame:
    """Histograms of several columns, labelled by ``series``: one scan for all
    ranges and one for all counts."""
    names = {name: f"x{i}" for i, name in enumerate(cols)}
    rows = df.select(*[F.col(c).cast("double").alias(names[name]) for name, c in cols.items()])
    present = {name: F.when(~is_missing(x), F.col(x)) for name, x in names.items()}

    def ends_of(x: Column) -> list[Column]:
        lo, hi = F.min(x), F.max(x)
        return [F.when(lo == hi, lo - 0.5).otherwise(lo), F.when(lo == hi, hi + 0.5).otherwise(hi)]

    ends = rows.agg(
        F.struct(
            *[
                end.alias(f"{side}_{names[name]}")
                for name, x in present.items()
                for side, end in zip(("lo", "hi"), ends_of(x), strict=True)
            ]
        ).alias("ends")
    ).scalar()

    def bin_of(name: str) -> Column:
        x = names[name]
        bucket = F.width_bucket(present[name], f"_e.lo_{x}", f"_e.hi_{x}", F.lit(bins))
        return F.when(bucket.isNotNull(), F.least(bucket, F.lit(bins)) - 1).cast("int")

    placed = F.array(*[F.struct(F.lit(n).alias("series"), bin_of(n).alias("bin")) for n in names])
    counts = (
        rows.withColumn("_e", ends)
        .select(F.inline(placed))
        .where("bin IS NOT NULL")
        .groupBy("series", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    series = F.explode(F.array(*[F.lit(n) for n in names])).alias("series")
    frame = df.sparkSession.range(bins).select(series, F.col("id").cast("int").alias("bin"))

    def edge(name: str) -> Column:
        lo, hi = F.col(f"_e.lo_{names[name]}"), F.col(f"_e.hi_{names[name]}")
        return lo + F.col("bin") * ((hi - lo) / bins)

    left = F.coalesce(*[F.when(F.col("series") == n, edge(n)) for n in names])
    return (
        frame.join(counts, ["series", "bin"], "left")
        .withColumn("_e", ends)
        .select("series", "bin", left.alias("left_edge"), F.coalesce("n", F.lit(0)).alias("n"))
    )


def lat_weights(node_dim: DataFrame, lat: str = "lat", name: str = "lat_weight") -> DataFrame:
    """Cosine latitude weights that average to 1 over the nodes."""
    cosine: Column = F.cos(F.radians(F.col(lat)))
    return node_dim.select("*", (cosine / node_dim.agg(F.avg(cosine)).scalar()).alias(name))


def time_range(time_dim: DataFrame, coord: str = "coord") -> DataFrame:
    return time_dim.agg(F.min(coord).alias("first_coord"), F.max(coord).alias("last_coord"))
