"""Exact quantiles and modes of large columns without collecting a column anywhere.

``percentile`` keeps every distinct value of a group in one task. Here a quantile is found
in narrowing passes over the column instead, each with a bounded state and a tiny shuffle:

1. an approximate sketch per group brackets every wanted quantile;
2. rows are counted per bracket and per slice of a bracket: a few thousand counts per group
   at most, whatever the size of the input;
3. only values in the slices that hold a wanted rank are ranked, a tiny share of the rows.

Passes 2 and 3 work with exact counts and look wherever the rank really falls, so the
sketch decides only how much is ranked, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

ACCURACY = 10_000
_SLICES = 1_024
# Shares into which the rows of each group are cut for joins against one record per group.
_SALTS = 16


def value_counts(df: DataFrame, value: Column, by: Sequence[str] = ()) -> DataFrame:
    """Distinct non-NULL values per group with their counts: columns by..., v, n."""
    return (
        df.select(*by, value.alias("v"))
        .where(F.col("v").isNotNull())
        .groupBy(*by, "v")
        .agg(F.count("*").alias("n"))
    )


def join_salted(counts: DataFrame, records: DataFrame, on: Sequence[str]) -> DataFrame:
    """Join value counts (column v) with one small record per key, a hot key being cut into shares by value."""
    salted = counts.withColumn("_salt", F.pmod(F.xxhash64("v"), F.lit(_SALTS)).cast("int"))
    copies = records.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return salted.join(copies, [*on, "_salt"]).drop("_salt")


def _brackets(value: Column, probabilities: Sequence[float]) -> Column:
    margin = 2.0 / ACCURACY
    edges = [min(1.0, max(0.0, p + side * margin)) for p in probabilities for side in (-1, 1)]
    return F.percentile_approx(value, edges, ACCURACY)


def _slot(v: Column, edges: Column, brackets: int) -> Column:
    """Position of a value: gaps between brackets are one slot, brackets are cut in slices."""
    width = _SLICES + 1
    out = F.when(F.lit(False), F.lit(0))
    for i in range(brackets):
        low, high = F.get(edges, F.lit(2 * i)), F.get(edges, F.lit(2 * i + 1))
        share = F.coalesce(F.try_divide(v - low, high - low), F.lit(0.0))
        slice_no = F.least(F.floor(share * _SLICES), F.lit(_SLICES - 1))
        out = out.when(v < low, F.lit(i * width)).when(v <= high, F.lit(i * width + 1) + slice_no)
    return out.otherwise(F.lit(brackets * width)).cast("int")


def exact_quantiles(df: DataFrame, value: Column, probabilities: Sequence[float],
                    by: Sequence[str] = (), counts: DataFrame | None = None,
                    few_groups: bool = False) -> DataFrame:
    """Exact quantiles with linear interpolation: columns by..., q (array in the given order).

    ``value`` must be a DOUBLE column without NaN, and group keys must not be NULL. ``counts``
    may hand in ready value counts of the same data, for the global form. Without ``by`` there is exactly one row;
    its q is NULL when there is no value. Probabilities must be in ascending order. Set
    ``few_groups`` only where the groups are few by construction, such as columns of a list; they are
    broadcast. Otherwise there is one plan for any number of groups: values are counted per group before
    they meet the record of their group. No job runs while the plan is built.
    """
    by = list(by)
    edges = df.where(value.isNotNull()).groupBy(*by).agg(_brackets(value, probabilities).alias("edges"))
    rows = df.select(*by, value.alias("v"), F.lit(1).alias("n")).dropna() if counts is None else counts
    if not by:
        located = rows.withColumn("edges", edges.scalar())
    elif few_groups:
        located = rows.join(F.broadcast(edges), by)
    else:
        located = join_salted(value_counts(df, value, by), edges, by)
    slot = _slot(F.col("v"), F.col("edges"), len(probabilities))
    located = located.select(*by, slot.alias("slot"), "v", "n")

    # Running count over slots; the window sees at most a few thousand rows per group.
    slots = located.groupBy(*by, "slot").agg(
        F.sum("n").alias("slot_n"), F.min("v").alias("first"), F.max("v").alias("last")
    )
    per_group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    slots = slots.select(
        "*",
        (F.sum("slot_n").over(per_group.orderBy("slot")) - F.col("slot_n")).alias("before"),
        F.sum("slot_n").over(per_group).alias("total"),
    )
    # Ranks are 0-based; a quantile lies between the ranks at floor and ceil of (total-1)*p.
    places = [(F.col("total") - 1) * F.lit(p) for p in probabilities]
    ranks = [f(place).cast("bigint") for place in places for f in (F.floor, F.ceil)]
    holds = F.exists(
        F.array(*ranks), lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("slot_n"))
    )
    hits = slots.where(holds)

    # A slot with one distinct value is settled; in the others the values are ranked.
    one_value = F.col("first") == F.col("last")
    settled = hits.where(one_value).select(
        *by, "total", F.col("first").alias("v"), F.col("before").alias("start"),
        (F.col("before") + F.col("slot_n")).alias("end"),
    )
    unsettled = hits.where(~one_value).select(*by, "slot", "before", "total")
    if not by or few_groups:
        wanted = located.join(F.broadcast(unsettled), [*by, "slot"])  # no more rows than wanted ranks
    else:
        wanted = join_salted(located, unsettled, [*by, "slot"])
    in_slot = Window.partitionBy(*by, "slot").orderBy("v")
    ranked = wanted.groupBy(*by, "slot", "before", "total", "v").agg(
        F.sum("n").alias("n")
    )
    ranked = ranked.withColumn("end", F.col("before") + F.sum("n").over(in_slot))
    ranked = ranked.select(*by, "total", "v", (F.col("end") - F.col("n")).alias("start"), "end")

    answers = []
    for i, rank in enumerate(ranks):
        covers = (F.col("start") <= rank) & (rank < F.col("end"))
        answers.append(F.max(F.when(covers, F.col("v"))).alias(f"r{i}"))
    found = settled.unionByName(ranked).groupBy(*by).agg(F.max("total").alias("total"), *answers)
    quantiles = []
    for i, place in enumerate(places):
        low, high = F.col(f"r{2 * i}"), F.col(f"r{2 * i + 1}")
        quantiles.append(low + (high - low) * (place - F.floor(place)))
    q = F.when(F.col("total").isNotNull(), F.array(*quantiles))
    return found.select(*by, q.alias("q"))


def smallest_mode(counts: DataFrame) -> DataFrame:
    """Most frequent value of a global value-count frame, smallest on ties: one row or none."""
    return counts.orderBy(F.col("n").desc(), F.col("v").asc()).limit(1)
