"""Pairs of items that occur together, with support, confidence and lift.

Items below the least support are pruned first, the others are numbered. The pairs of a basket become rows that are counted where they arise, before
any shuffle. Where that would be many more rows than pairs of tiles (runs of numbers) the basket has items in, it becomes one row for each
pair of tiles instead, so that 10,000 items of as many make some hundred rows and not fifty million pairs. A task adds the rows of a tile pair
into one small matrix, or sorts them while they are few; hot tile pairs are dealt over shares whose counts are summed. So the work follows the
rows, however many items there are: tile pairs without a common basket cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

#: Items in a tile: a matrix has 512 x 512 counts, 2 MB.
TILE = 512
#: Items up to which a basket always becomes pairs, and pairs per row of tiles up to which a larger one does.
FEW_ITEMS, FEW_PAIRS = 32, 8


def item_counts(baskets: DataFrame, basket: str, item: str) -> DataFrame:
    """Rows (item, n): baskets with each item; repeats within a basket count once, nulls are left out."""
    once = baskets.where(F.col(item).isNotNull()).select(F.col(basket).alias("basket"), F.col(item).alias("item")).distinct()
    return once.groupBy("item").agg(F.count("*").alias("n"))


def pair_counts(baskets: DataFrame, basket: str, item: str, least: int, tile: int = TILE, shares: int | None = None) -> DataFrame:
    """Rows (a, b, n_a, n_b, n_both) of items a < b that share at least ``least`` baskets; null baskets form one."""
    spark = baskets.sparkSession
    shares = shares or int(spark.conf.get("spark.sql.shuffle.partitions"))
    once = baskets.where(F.col(item).isNotNull()).select(F.col(basket).alias("basket"), F.col(item).alias("item")).distinct()
    frequent = once.groupBy("item").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    # Numbers fall with frequency within each of some buckets, which are ranked side by side.
    frequent = frequent.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(shares)))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("n"), "item")).cast("bigint")
    numbered = frequent.select("item", "n", ((rank - 1) * shares + F.col("bucket")).alias("number")).persist()
    whole = once.join(numbered.select("item", "number"), "item").groupBy("basket").agg(F.sort_array(F.collect_list("number")).alias("items"))
    size = F.size("items").cast("bigint")
    tiles = F.size(F.array_distinct(F.transform("items", lambda x: F.floor(x / tile)))).cast("bigint")
    few = (size <= FEW_ITEMS) | (size * (size - 1) <= FEW_PAIRS * tiles * (tiles + 1))
    single = whole.where(few).select("items", F.posexplode("items").alias("i", "x")).select(
        "x", F.explode(F.slice("items", F.col("i") + 2, F.size("items"))).alias("y"), F.lit(1).cast("bigint").alias("n"))

    places = whole.where(~few).select("basket", F.explode("items").alias("number"))
    tiled = places.select("basket", F.floor(F.col("number") / tile).cast("int").alias("tile"), (F.col("number") % tile).cast("int").alias("place"))
    cut = tiled.groupBy("basket", "tile").agg(F.collect_list("place").alias("places"))
    rows = cut.groupBy("basket").agg(F.array_sort(F.collect_list(F.struct("tile", "places"))).alias("tiles"))
    left = rows.select("basket", "tiles", F.posexplode("tiles").alias("i", "x"))
    pairs = left.select("basket", "x", F.explode(F.slice("tiles", F.col("i") + 1, F.size("tiles"))).alias("y")).select(
        F.col("x.tile").alias("ta"), F.col("y.tile").alias("tb"), F.col("x.places").alias("pa"), F.col("y.places").alias("pb"),
        F.pmod(F.xxhash64("basket"), F.lit(shares)).alias("share"))

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ta, tb = key[0].as_py(), key[1].as_py()
        counts, cells, held = None, [], 0
        for batch in batches:
            for x, y in zip(batch.column("pa").to_pylist(), batch.column("pb").to_pylist()):
                if counts is not None:
                    counts[np.ix_(x, y)] += 1
                    continue
                cells.append((np.array(x)[:, None] * tile + np.array(y)).ravel())
                held += len(cells[-1])
                if held > tile * tile // 16:
                    counts, cells = np.bincount(np.concatenate(cells), minlength=tile * tile).reshape(tile, tile), []
        if counts is None:
            found, n = np.unique(np.concatenate(cells), return_counts=True)
        else:
            found = np.flatnonzero(counts)
            n = counts.ravel()[found]
        if ta == tb:
            upper = found // tile < found % tile
            found, n = found[upper], n[upper]
        for low in range(0, len(found), 1 << 16):
            i, j = np.divmod(found[low:low + (1 << 16)], tile)
            yield pa.RecordBatch.from_arrays([pa.array(ta * tile + i), pa.array(tb * tile + j), pa.array(n[low:low + (1 << 16)])], names=["x", "y", "n"])

    partial = pairs.groupBy("ta", "tb", "share").applyInArrow(add, "x bigint, y bigint, n bigint")
    both = single.unionByName(partial).groupBy("x", "y").agg(F.sum("n").alias("n_both")).where(F.col("n_both") >= least)
    side = lambda k: numbered.select(F.col("number").alias(k), F.col("item").alias(f"{k}_item"), F.col("n").alias(f"{k}_n"))
    named = both.join(side("x"), "x").join(side("y"), "y")
    first = F.col("x_item") < F.col("y_item")
    return named.select(
        F.when(first, F.col("x_item")).otherwise(F.col("y_item")).alias("a"), F.when(first, F.col("y_item")).otherwise(F.col("x_item")).alias("b"),
        F.when(first, F.col("x_n")).otherwise(F.col("y_n")).alias("n_a"), F.when(first, F.col("y_n")).otherwise(F.col("x_n")).alias("n_b"), "n_both")


def associations(baskets: DataFrame, basket: str, item: str, least: int, **options: int) -> DataFrame:
    """``pair_counts`` with support, confidence of a -> b and b -> a, and lift, over the number of baskets, those without items included."""
    total = baskets.agg(F.count_distinct(F.struct(F.col(basket).isNull(), F.col(basket))).alias("total"))
    both, a, b, n = (F.col(c).cast("double") for c in ("n_both", "n_a", "n_b", "total"))
    out = pair_counts(baskets, basket, item, least, **options).withColumn("total", total.scalar())
    return out.select("a", "b", "n_a", "n_b", "n_both", (both / n).alias("support"), (both / a).alias("confidence_ab"),
                      (both / b).alias("confidence_ba"), (both * n / (a * b)).alias("lift"))
