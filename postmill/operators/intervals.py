"""Confidence intervals of group means and medians, without collecting a group anywhere.

The interval of a mean uses Student's t. The interval of a median lies between two order statistics whose ranks follow from the
binomial distribution, so it holds for any spread of the values. Values are counted per group first; a window sees the counts
of one group per value range, and only ranges that hold a wanted rank are ranked.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window, functions as F

from postmill.functions.numeric import to_number
from postmill.functions.tails import t_point
from postmill.operators.inference import RANGE_BITS, range_no

#: Group sizes up to which the ranks around a median are exact; beyond, the normal approximation with continuity correction.
EXACT_SIZE = 200


def _rank(n: int, level: float) -> int:
    """Largest rank below which a fair coin's heads in n throws fall with at most half the error; 0 where no rank does."""
    total, below = 0, 0
    for heads in range(n):
        total += math.comb(n, heads)
        if 2.0 * total > (1.0 - level) * 2.0**n:
            break
        below = heads + 1
    return below


def median_rank(n: Column, level: float) -> Column:
    """Rank of the lower end of a median's interval in a group of n values; the upper end has as many values above it."""
    exact = F.get(F.array(*[F.lit(_rank(size, level)) for size in range(EXACT_SIZE + 1)]), n.cast("int"))
    z = NormalDist().inv_cdf((1.0 + level) / 2.0)
    rough = F.floor(n / 2.0 + 0.5 - z / 2.0 * F.sqrt(n.cast("double")))
    return F.when(n <= EXACT_SIZE, exact).otherwise(rough).cast("long")


def group_intervals(df: DataFrame, group: str, value: str, level: float = 0.95, bits: int = RANGE_BITS) -> DataFrame:
    """One row per group: n, mean, mean_low, mean_high, median, median_low, median_high at the given level.

    Rows whose group is NULL or whose value is no number are left out. The ends of a mean are NULL for a single value, those
    of a median where the group is too small for the level (fewer than 6 values at 0.95).
    """
    rows = df.select(F.col(f"`{group}`").alias("g"), to_number(F.col(f"`{value}`"), df.schema[value].dataType).alias("v")).dropna()
    rows = rows.select("g", (F.col("v") + 0.0).alias("v"))
    stats = rows.groupBy("g").agg(F.count("*").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("sd"))
    low = median_rank(F.col("n"), level)
    stats = stats.select("*", F.when(low > 0, low).alias("low"))

    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    cells = rows.groupBy("g", "v").agg(F.count("*").alias("w"))
    cells = cells.withColumn("edges", rows.agg(F.percentile_approx("v", steps, 10 << bits)).scalar())
    cells = cells.select("g", "v", "w", range_no(F.col("v"), F.col("edges"), bits).alias("range"))
    sizes = cells.groupBy("g", "range").agg(F.sum("w").alias("size"))  # 2^bits rows per group at most
    sizes = sizes.withColumn("upto", F.sum("size").over(Window.partitionBy("g").orderBy("range")))
    wanted = {
        "m1": F.floor((F.col("n") + 1) / 2), "m2": F.floor(F.col("n") / 2) + 1, "low": F.col("low"), "high": F.col("n") + 1 - F.col("low"),
    }
    start = F.col("upto") - F.col("size")
    held = [F.when((r > start) & (r <= F.col("upto")), r - start).alias(name) for name, r in wanted.items()]
    held = sizes.join(stats.select("g", "n", "low"), "g").select("g", "range", *held)
    held = held.where(F.coalesce(*wanted).isNotNull())  # four ranges per group at most

    ranked = cells.join(held, ["g", "range"])
    ranked = ranked.withColumn("last", F.sum("w").over(Window.partitionBy("g", "range").orderBy("v")))
    at = {name: F.max(F.when((F.col(name) > F.col("last") - F.col("w")) & (F.col(name) <= F.col("last")), F.col("v"))) for name in wanted}
    picked = ranked.groupBy("g").agg(*[c.alias(f"at_{name}") for name, c in at.items()])

    reach = t_point(F.col("n") - 1, level) * F.col("sd") / F.sqrt(F.col("n").cast("double"))
    out = stats.join(picked, "g")
    return out.select(
        F.col("g").alias(group), "n", "mean", (F.col("mean") - reach).alias("mean_low"), (F.col("mean") + reach).alias("mean_high"),
        ((F.col("at_m1") + F.col("at_m2")) / 2.0).alias("median"), F.col("at_low").alias("median_low"), F.col("at_high").alias("median_high"),
    )
