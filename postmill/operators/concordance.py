"""Kendall's rank correlation of two columns, without forming pairs of rows.

Equal (x, y) rows are counted first. A discordant pair has the smaller x and the greater y. The values of y get digits, range
first and place inside the range after it, so two values differ first at exactly one digit: pairs are counted there, among the
rows that agree in the digits before. Rows of one such prefix are cut by ranges of x; inside a piece they are swept in order
of x, and whole pieces are counted against each other by their digit counts. A sweep remembers one count per digit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from postmill.functions.numeric import to_number
from postmill.functions.tails import normal_two_sided
from postmill.operators.inference import RANGE_BITS, range_no

_EXACT = "decimal(38,0)"
_KEYS = ["level", "range", "prefix", "block"]


def _weighted(a: np.ndarray, b: np.ndarray) -> int:
    """Sum of products of counts, in whole numbers of any size."""
    if float(a.sum()) * float(b.max(initial=0)) < 2.0**62:
        return int(a @ b)
    return sum(int(x) * int(y) for x, y in zip(a, b))


def _inside(piece: np.ndarray, at: np.ndarray, digit: np.ndarray, n: np.ndarray, bits: int) -> int:
    """Pairs of rows of one piece, sorted by at, with the smaller at and the greater digit; they part at one bit."""
    total = 0
    for bit in range(bits):
        group = (piece << bits) | (digit >> (bit + 1))
        order = np.argsort(group, kind="stable")
        g, a, w = group[order], at[order], n[order]
        up = (digit[order] >> bit) & 1 == 1
        before = np.concatenate([[0], np.cumsum(np.where(up, w, 0))])
        new_group = np.concatenate([[True], g[1:] != g[:-1]])
        new_at = new_group | np.concatenate([[True], a[1:] != a[:-1]])
        first = lambda marks: np.maximum.accumulate(np.where(marks, np.arange(len(g)), 0))
        smaller = before[first(new_at)] - before[first(new_group)]
        total += _weighted(w[~up], smaller[~up])
    return total


def _sweep(bits: int):
    """Discordant pairs of sorted batches of (keys, at, digit, n), one figure per batch; pieces may span batches."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last_at = None, None
        seen = np.zeros(1 << bits, np.int64)  # rows of the piece so far, by digit
        tied = np.zeros(1 << bits, np.int64)  # those of them at last_at
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in range(len(_KEYS))])
            at, digit, n = (batch.column(i).to_numpy() for i in range(len(_KEYS), len(_KEYS) + 3))
            starts = np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
            piece = np.cumsum(starts) - 1
            found = _inside(piece, at, digit, n, bits)
            if key is not None and (keys[:, 0] == key).all():
                mine = piece == 0
                for rows, counts in ((mine & (at == last_at), seen - tied), (mine & (at != last_at), seen)):
                    greater = counts[::-1].cumsum()[::-1] - counts
                    found += _weighted(n[rows], greater[digit[rows]])
            else:
                seen[:], tied[:], last_at = 0, 0, None
            if piece[-1]:
                seen[:], tied[:], last_at = 0, 0, None
            final = piece == piece[-1]
            if at[-1] != last_at:
                tied[:] = 0
            np.add.at(seen, digit[final], n[final])
            ties = final & (at == at[-1])
            np.add.at(tied, digit[ties], n[ties])
            key, last_at = keys[:, -1], at[-1]
            yield pa.record_batch([pa.array([str(found)])], names=["found"])

    return sweep


def _places(counts: DataFrame, edges: Column, bits: int) -> DataFrame:
    """Distinct values v with their range, their place inside it from 0 and the number of values there."""
    ranged = counts.withColumn("edges", edges)
    ranged = ranged.select("v", range_no(F.col("v"), F.col("edges"), bits).alias("range"))
    place = F.row_number().over(Window.partitionBy("range").orderBy("v")) - 1
    return ranged.select("v", "range", place.cast("long").alias("place"), F.count("*").over(Window.partitionBy("range")).alias("size"))


def discordant_pairs(cells: DataFrame, bits: int = RANGE_BITS) -> DataFrame:
    """Pairs of rows with the smaller x and the greater y, of distinct cells (x, y, n): one row with ``discordant``."""
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    edges = cells.agg(F.struct(*[F.percentile_approx(c, steps, 10 << bits).alias(c) for c in ("x", "y")]).alias("edges"))
    places = _places(cells.select(F.col("y").alias("v")).distinct(), edges.scalar()["y"], bits)
    rows = cells.join(places, cells["y"] == places["v"]).withColumn("edges", edges.scalar()["x"])
    rows = rows.select("x", "n", "range", "place", "size", range_no(F.col("x"), F.col("edges"), bits).cast("long").alias("block"))
    mask = (1 << bits) - 1

    # Level -1 is the range itself; level k >= 0 the k-th digit of the place, as many as the range needs.
    digits = F.ceil(F.log2(F.col("size").cast("double")) / bits).cast("int")
    rows = rows.withColumn("level", F.explode(F.sequence(F.lit(-1), digits - 1, F.lit(1))))
    shift = F.greatest(F.col("level"), F.lit(0)) * bits
    top = F.col("level") < 0
    rows = rows.select(
        F.col("level").cast("long").alias("level"), F.when(top, 0).otherwise(F.col("range")).cast("long").alias("range"),
        F.when(top, 0).otherwise(F.call_function("shiftright", F.col("place"), shift + bits)).cast("long").alias("prefix"),
        "block", F.col("x").alias("at"),
        F.when(top, F.col("range")).otherwise(F.call_function("shiftright", F.col("place"), shift).bitwiseAND(F.lit(mask))).cast("long").alias("digit"),
        "n",
    )
    rows = rows.groupBy(*_KEYS, "at", "digit").agg(F.sum("n").alias("n"))  # a hot x leaves one row per digit
    blocks = rows.groupBy("level", "range", "prefix", "block", "digit").agg(F.sum("n").alias("n"))
    blocks = blocks.select("level", "range", "prefix", F.lit(-1).cast("long").alias("block"),
                           F.col("block").cast("double").alias("at"), "digit", "n")
    pieces = rows.unionByName(blocks).repartition(*_KEYS).sortWithinPartitions(*_KEYS, "at")
    found = pieces.mapInArrow(_sweep(bits), "found string")
    return found.agg(F.coalesce(F.sum(F.col("found").cast(_EXACT)).cast(_EXACT), F.lit(0).cast(_EXACT)).alias("discordant"))


def kendall(df: DataFrame, first: str, second: str, bits: int = RANGE_BITS) -> DataFrame:
    """Kendall's tau-b of two columns, with the normal approximation of its test, corrected for ties, two-sided.

    One row: n (rows with a number in both), concordant and discordant pairs, tau_b, z and p_value, the last three NULL where
    a column has no two different values. Counts of pairs are whole numbers of up to 38 digits.
    """
    rows = df.select(
        (to_number(F.col(f"`{first}`"), df.schema[first].dataType) + 0.0).alias("x"),
        (to_number(F.col(f"`{second}`"), df.schema[second].dataType) + 0.0).alias("y"),
    ).dropna()
    cells = rows.groupBy("x", "y").agg(F.count("*").alias("n"))

    def ties(counts: DataFrame) -> Column:
        t = F.col("n").cast("decimal(19,0)")
        real = F.col("n").cast("double")
        pairs = (t * (t - 1)).cast(_EXACT)
        return counts.agg(F.struct(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(pairs).cast(_EXACT), F.lit(0).cast(_EXACT)).alias("pairs2"),
            F.sum(real * (real - 1.0) * (2.0 * real + 5.0)).alias("five"), F.sum(real * (real - 1.0) * (real - 2.0)).alias("three"),
        )).scalar()

    row = discordant_pairs(cells, bits)
    for name, counts in (("x", cells.groupBy("x").agg(F.sum("n").alias("n"))), ("y", cells.groupBy("y").agg(F.sum("n").alias("n"))), ("xy", cells)):
        row = row.withColumn(name, ties(counts))
    whole = F.col("xy.n").cast("decimal(19,0)")
    all2 = (whole * (whole - 1)).cast(_EXACT)
    # Ordered pairs count twice, so halves are whole.
    apart2 = all2 - F.col("x.pairs2") - F.col("y.pairs2") + F.col("xy.pairs2")
    concordant = ((apart2 / 2).cast(_EXACT) - F.col("discordant")).cast(_EXACT)
    row = row.select("*", concordant.alias("concordant"), all2.alias("all2"))
    n = F.col("xy.n").cast("double")
    score = (F.col("concordant") - F.col("discordant")).cast("double")
    untied = [(F.col("all2") - F.col(f"{c}.pairs2")).cast("double") / 2.0 for c in ("x", "y")]
    varied = (untied[0] > 0) & (untied[1] > 0)
    spread = (n * (n - 1.0) * (2.0 * n + 5.0) - F.col("x.five") - F.col("y.five")) / 18.0
    spread += F.col("x.pairs2").cast("double") * F.col("y.pairs2").cast("double") / (2.0 * n * (n - 1.0))
    spread += F.coalesce(F.try_divide(F.col("x.three") * F.col("y.three"), 9.0 * n * (n - 1.0) * (n - 2.0)), F.lit(0.0))
    row = row.select(
        F.col("xy.n").alias("n"), "concordant", "discordant",
        F.when(varied, score / F.sqrt(untied[0]) / F.sqrt(untied[1])).alias("tau_b"), F.when(varied, score / F.sqrt(spread)).alias("z"),
    )
    return row.select("*", normal_two_sided(F.col("z")).alias("p_value"))
