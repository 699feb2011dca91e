"""Places of rows within keys, and running values along them, without gathering a key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from postmill.llm.common import hinted, kept, parallelism

#: Bits of monotonically_increasing_id below the partition number.
_ROW_BITS = 33


def placed(rows: DataFrame, key: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows sorted by key and order over many tasks, and where each key lies in them.

    First table: the rows, with ``seg`` (the partition that holds a row) and ``at`` (ascending in the whole order). Second:
    (key, seg, first, n, start, total), one row per key and partition; a row's place within its key, from 0, is
    start + at - first. A key of many rows spans many partitions, and rows that are equal in key and order are dealt out too. Nulls
    come first. ``rows`` must not have columns named seg, at, or tie.
    """
    fixed = kept(rows).withColumn("tie", F.monotonically_increasing_id())
    by = [F.col(c).asc_nulls_first() for c in (*key, *order, "tie")]
    ordered = kept(fixed.repartitionByRange(parallelism(rows.sparkSession), *by).sortWithinPartitions(*by).drop("tie"))
    numbered = ordered.withColumn("at", F.monotonically_increasing_id()).withColumn("seg", F.shiftright("at", _ROW_BITS))
    before = Window.partitionBy(*key).orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    spans = numbered.groupBy(*key, "seg").agg(F.min("at").alias("first"), F.count("*").alias("n")).select(
        "*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(Window.partitionBy(*key)).alias("total"))
    return numbered, kept(spans)


def with_spans(numbered: DataFrame, spans: DataFrame, key: list[str]) -> DataFrame:
    """Each row with the columns of its span and its place; null keys meet null keys."""
    side = spans.select(*[F.col(c).alias(f"span_{c}") for c in (*key, "seg")], *[c for c in spans.columns if c not in (*key, "seg")])
    same = F.col("seg") == F.col("span_seg")
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"span_{c}"))
    joined = numbered.join(hinted(side, spans.count()), same).withColumn("place", F.col("start") + F.col("at") - F.col("first"))
    return joined.drop(*[f"span_{c}" for c in (*key, "seg")], "first", "start", "n")


def running(rows: DataFrame, key: str, at: str, values: dict[str, str], fold, backwards: bool = False) -> DataFrame:
    """Running values along ``at`` within ``key``, the row itself included; ``values`` maps new names to columns.

    ``fold`` is bit_xor or sum. Rows have ``seg``, whose numbers ascend with ``at`` and which holds a bounded part of a key, so that
    a window never spans more than a part; the parts before it are carried over.
    """
    way = F.desc if backwards else F.asc
    totals = rows.groupBy(key, "seg").agg(*[fold(c).alias(f"carry_{new}") for new, c in values.items()])
    before = Window.partitionBy(key).orderBy(way("seg")).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(key, "seg", *[F.coalesce(fold(f"carry_{n}").over(before), F.lit(0)).alias(f"carry_{n}") for n in values])
    inside = Window.partitionBy(key, "seg").orderBy(way(at)).rowsBetween(Window.unboundedPreceding, 0)

    def whole(new: str, column: str) -> Column:
        own, carry = fold(column).over(inside), F.col(f"carry_{new}")
        return (own.bitwiseXOR(carry) if fold is F.bit_xor else own + carry).alias(new)

    return rows.join(carried, [key, "seg"]).select(*rows.columns, *[whole(n, c) for n, c in values.items()])
