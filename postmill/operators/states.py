"""Profiles that merge: one small record per column and part of the data, from which the profile of any union follows.

A state holds counts, extremes and moments exactly, distinct values as a HyperLogLog sketch (2^12 registers, a standard error
of about 1.6 %) and the spread of numbers as a KLL sketch (k = 200, rank error about 1.3 %). States are rows of a table with two binary columns, so those
of a day can be written once and merged with those of other days without reading the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from postmill.functions.numeric import to_number


def profile_states(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per part (values of ``by``) and column: rows, present, numbers, total, mean, m2, least, most, distinct_sketch,
    number_sketch. Text is read as numbers where it is one; the sums and the number sketch are NULL where nothing is."""
    by = list(by)
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("text"),
                 (to_number(F.col(f"`{c}`"), df.schema[c].dataType) + 0.0).alias("number"))
        for c in columns
    ])
    long = df.select(*[F.col(f"`{b}`").alias(b) for b in by], F.explode(entries).alias("entry")).select(*by, "entry.*")
    return long.groupBy(*by, "column").agg(
        F.count("*").alias("rows"), F.count("text").alias("present"), F.count("number").alias("numbers"),
        F.sum("number").alias("total"), F.avg("number").alias("mean"),
        (F.var_pop("number") * F.count("number")).alias("m2"), F.min("number").alias("least"), F.max("number").alias("most"),
        # Digests, since the sketch passes over empty texts.
        F.hll_sketch_agg(F.when(F.col("text").isNotNull(), F.xxhash64("text")), 12).alias("distinct_sketch"), F.kll_sketch_agg_double("number", 200).alias("number_sketch"),
    )


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of the unions: one row per value of ``by`` and column, of the same shape. Merging merged states gives the same
    counts, extremes and moments as merging all at once."""
    keys = [*by, "column"]
    middles = states.groupBy(*[F.col(f"`{k}`").alias(f"of {k}") for k in keys]).agg((F.sum("total") / F.sum("numbers")).alias("middle"))
    # Deviations of the parts' means from the common mean, so that no large squares cancel; a NULL part is one of its own.
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`of {k}`")) for k in keys]
    met = states.join(middles, reduce(Column.__and__, same)).drop(*[f"of {k}" for k in keys])
    off = F.col("mean") - F.col("middle")
    return met.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("present").alias("present"), F.sum("numbers").alias("numbers"), F.sum("total").alias("total"),
        F.max("middle").alias("mean"), F.sum(F.col("m2") + F.col("numbers") * off * off).alias("m2"),
        F.min("least").alias("least"), F.max("most").alias("most"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double(F.when(F.col("numbers") > 0, F.col("number_sketch"))).alias("number_sketch"),
    )


def read_states(states: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Profiles of states: rows, missing, mean, std, least, most, approx_distinct and approx_quantiles (an array in the given
    order, NULL without numbers)."""
    sketch = F.when(F.col("numbers") > 0, F.col("number_sketch"))
    quantiles = F.array(*[F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))) for p in probabilities])
    kept = [c for c in states.columns if c not in (
        "rows", "present", "numbers", "total", "mean", "m2", "least", "most", "distinct_sketch", "number_sketch")]
    return states.select(
        *kept, "rows", (F.col("rows") - F.col("present")).alias("missing"), "mean",
        F.when(F.col("numbers") > 1, F.sqrt(F.col("m2") / (F.col("numbers") - 1))).alias("std"), "least", "most",
        F.hll_sketch_estimate("distinct_sketch").alias("approx_distinct"),
        F.when(F.col("numbers") > 0, quantiles).alias("approx_quantiles"),
    )
