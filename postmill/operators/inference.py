"""Tests of whether groups differ (rank sums) and whether two categories depend on each other (contingency counts).

Equal cells are counted before anything else, so a hot value or group costs as much as a rare one. Ranks are taken in
value ranges side by side; the only window over all ranges sees one row per range. Each test returns exactly one row,
whose figures are NULL where they have no meaning (no rows, one group, all values equal).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from postmill.functions.numeric import to_number
from postmill.functions.tails import chi_square_tail, normal_two_sided

#: Binary digits of the number of value ranges that are ranked side by side.
RANGE_BITS = 10
_EXACT = "decimal(38,0)"


def range_no(v: Column, edges: Column, bits: int) -> Column:
    """How many edges lie at or below v, by halving."""
    steps = F.sequence(F.lit(bits - 1), F.lit(0))

    def step(at: Column, bit: Column) -> Column:
        width = F.pow(F.lit(2.0), bit).cast("int")
        return F.when(F.get(edges, at + width - 1) <= v, at + width).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def rank_cells(df: DataFrame, value: str, group: str, bits: int = RANGE_BITS) -> DataFrame:
    """Distinct (g, v) with their row count n, the number of rows with that value (ties), twice its average rank (rank2)
    and the number of all rows.

    Rows whose group is NULL or whose value is no number are left out. A sketch of the values sets 2^bits - 1 edges, so that
    each range holds about an equal share of the rows; it decides who ranks what, never a rank.
    """
    rows = df.select(F.col(f"`{group}`").alias("g"), to_number(F.col(f"`{value}`"), df.schema[value].dataType).alias("v")).dropna()
    rows = rows.select("g", (F.col("v") + 0.0).alias("v"))  # no negative zero, so that zeros tie
    count = 1 << bits
    steps = [i / count for i in range(1, count)]
    edges = rows.agg(F.percentile_approx("v", steps, 10 * count))
    cells = rows.groupBy("g", "v").agg(F.count("*").alias("n"))
    cells = cells.withColumn("edges", edges.scalar())
    cells = cells.select("g", "v", "n", range_no(F.col("v"), F.col("edges"), bits).alias("range"))

    sizes = cells.groupBy("range").agg(F.sum("n").alias("size"))  # one row per range, 2^bits at most
    before = F.sum("size").over(Window.partitionBy(F.lit(0)).orderBy("range")) - F.col("size")
    starts = sizes.select("range", before.alias("start"), F.sum("size").over(Window.partitionBy(F.lit(0))).alias("all"))
    cells = cells.select(
        "*",
        F.sum("n").over(Window.partitionBy("range").orderBy("v")).alias("upto"),
        F.sum("n").over(Window.partitionBy("range", "v")).alias("ties"),
    ).join(F.broadcast(starts), "range")
    rank2 = 2 * (F.col("start") + F.col("upto")) - F.col("ties") + 1
    return cells.select("g", "v", "n", "ties", rank2.alias("rank2"), "all")


def _rank_sums(cells: DataFrame) -> DataFrame:
    """Per group: rows, twice the rank sum, the group's share of the sum of t^3 - t over ties t, and the rows of all groups."""
    return cells.groupBy("g").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n").cast(_EXACT) * F.col("rank2").cast("decimal(20,0)")).cast(_EXACT).alias("sum2"),
        F.sum(F.col("n") * (F.col("ties").cast("double") * F.col("ties") - 1.0)).alias("tied"), F.max("all").alias("all"),
    )


def kruskal_wallis(df: DataFrame, value: str, group: str) -> DataFrame:
    """Kruskal-Wallis test that a value is spread alike in all groups, corrected for ties.

    One row: n, n_groups, h, df, p_value, epsilon_squared (the share of the ranks' variance that groups explain).
    """
    sums = _rank_sums(rank_cells(df, value, group))
    off = (F.col("sum2").cast("double") - F.col("n") * (F.col("all") + 1.0)) / 2.0  # the rank sum less what is expected
    row = sums.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("n_groups"),
        F.sum(off * off / F.col("n")).alias("between"), F.sum("tied").alias("tied"),
    )
    n = F.col("n").cast("double")
    spread = n * (n + 1.0) / 12.0 * (1.0 - F.try_divide(F.col("tied"), n * n * n - n))
    h = F.when((F.col("n_groups") > 1) & (spread > 0), F.col("between") / spread)
    row = row.select("n", "n_groups", h.alias("h"), (F.greatest(F.col("n_groups"), F.lit(1)) - 1).alias("df"))
    return row.select("*", chi_square_tail(F.col("h"), F.col("df")).alias("p_value"),
                      F.try_divide(F.col("h"), F.col("n") - 1.0).alias("epsilon_squared"))


def mann_whitney(df: DataFrame, value: str, group: str, first: object, second: object) -> DataFrame:
    """Mann-Whitney U test of two groups by the normal approximation, corrected for ties and continuity, two-sided.

    One row: n_first, n_second, u (of the first group: pairs in which its value is greater, ties as half), z, p_value and
    superiority, the share u has of all pairs.
    """
    one, two = F.lit(first).cast(df.schema[group].dataType), F.lit(second).cast(df.schema[group].dataType)
    key = F.col(f"`{group}`")
    sums = _rank_sums(rank_cells(df.where((key == one) | (key == two)), value, group))
    mine = F.col("g") == one
    row = sums.agg(
        F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0)).alias("n_first"),
        F.coalesce(F.sum(F.when(~mine, F.col("n"))), F.lit(0)).alias("n_second"),
        F.sum(F.when(mine, F.col("sum2"))).alias("sum2"), F.sum("tied").alias("tied"),
    )
    a, b = F.col("n_first").cast("double"), F.col("n_second").cast("double")
    least = F.col("n_first").cast(_EXACT) * (F.col("n_first") + 1).cast("decimal(20,0)")
    u = F.when((a > 0) & (b > 0), (F.col("sum2") - least.cast(_EXACT)).cast("double") / 2.0)
    row = row.select("*", u.alias("u"))
    spread = a * b / 12.0 * (a + b + 1.0 - F.try_divide(F.col("tied"), (a + b) * (a + b - 1.0)))
    off = F.col("u") - a * b / 2.0
    z = F.when(spread > 0, F.signum(off) * F.greatest(F.abs(off) - 0.5, F.lit(0.0)) / F.sqrt(spread) + 0.0)
    row = row.select("n_first", "n_second", "u", z.alias("z"), F.try_divide(F.col("u"), a * b).alias("superiority"))
    return row.select("n_first", "n_second", "u", "z", normal_two_sided(F.col("z")).alias("p_value"), "superiority")


def chi_square(df: DataFrame, first: str, second: str) -> DataFrame:
    """Chi-square test that two categories are independent, and Cramér's V; rows with a NULL in either are left out.

    One row: n, n_first and n_second (distinct values), chi_square, df, p_value, cramers_v, least_expected (the smallest
    expected count of any cell, empty ones included), low_cells (cells with rows whose expected count is below 5) and
    low_expected, whether any cell is that rare, in which case the p-value is a rough one. Empty cells add what they were
    expected to hold, which follows from the margins, so no pair of values without rows is ever formed.
    """
    cells = df.select(F.col(f"`{first}`").alias("a"), F.col(f"`{second}`").alias("b")).dropna()
    cells = cells.groupBy("a", "b").agg(F.count("*").alias("n"))
    rows = cells.groupBy("a").agg(F.sum("n").alias("of_a"))
    columns = cells.groupBy("b").agg(F.sum("n").alias("of_b"))
    met = cells.join(rows, "a").join(columns, "b")
    met = met.select("n", (F.col("of_a").cast(_EXACT) * F.col("of_b").cast("decimal(20,0)")).cast(_EXACT).alias("product"))
    met = met.withColumn("all", cells.agg(F.sum("n")).scalar())
    expected = F.col("product").cast("double") / F.col("all")
    off = F.col("n") - expected
    row = met.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum(off * off / expected).alias("held"),
        F.sum("product").cast(_EXACT).alias("products"), F.count(F.when(expected < 5, 1)).alias("low_cells"),
    )
    for margin, name in ((rows.select(F.col("of_a").alias("m")), "first"), (columns.select(F.col("of_b").alias("m")), "second")):
        row = row.withColumn(name, margin.agg(F.struct(F.count("*").alias("k"), F.min("m").alias("least"))).scalar())
    n = F.col("n").cast("double")
    # Exact whole numbers, so empty cells add nothing where there are none.
    empty = (F.col("n").cast(_EXACT) * F.col("n").cast("decimal(20,0)")).cast(_EXACT) - F.col("products")
    n_first, n_second = F.col("first.k"), F.col("second.k")
    least = F.try_divide(F.col("first.least").cast("double") * F.col("second.least"), n)
    smaller = F.least(n_first, n_second) - 1
    both = smaller >= 1
    row = row.select(
        "n", n_first.alias("n_first"), n_second.alias("n_second"),
        F.when(both, F.col("held") + empty.cast("double") / n).alias("chi_square"),
        F.when(both, (n_first - 1) * (n_second - 1)).alias("df"), smaller.alias("smaller"), least.alias("least_expected"),
        "low_cells", (least < 5).alias("low_expected"),
    )
    return row.select(
        "n", "n_first", "n_second", "chi_square", "df", chi_square_tail(F.col("chi_square"), F.col("df")).alias("p_value"),
        F.sqrt(F.try_divide(F.col("chi_square"), F.col("n").cast("double") * F.col("smaller"))).alias("cramers_v"),
        "least_expected", "low_cells", "low_expected",
    )
