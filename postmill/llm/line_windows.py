"""Line deduplication over overlapping windows of three lines.

Windows are hashed, those that occur more than once anywhere are found, every occurrence but the first is marked,
and a document loses the lines that its marked windows cover.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postmill.llm.common import fresh, kept

WINDOW = 3
#: A single line with more words than this is a window of its own.
LONG_LINE = 50


def _windows(window: int, long_line: int) -> Column:
    """Per document: (hash, first line, last line) of each window; lines without text are passed over."""
    clean = F.transform("lines", lambda line, i: F.struct(
        i.alias("i"), F.trim(F.regexp_replace(line, r"\s+", " ")).alias("line")))
    full = F.filter(clean, lambda x: x["line"] != "")
    hashed = F.transform(full, lambda x: F.struct(
        x["i"].alias("i"), F.xxhash64(x["line"]).alias("h"),
        F.when(F.length(x["line"]) > 2 * long_line, F.size(F.split(x["line"], " "))).otherwise(0).alias("words")))

    def runs(xs: Column) -> Column:
        size = F.least(F.size(xs), F.lit(window))
        starts = F.when(size > 0, F.sequence(F.lit(0), F.size(xs) - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda j: F.struct(
            F.xxhash64(size, *[F.get(xs, j + k)["h"] for k in range(window)]).alias("h"),
            F.get(xs, j)["i"].alias("first"), F.get(xs, j + size - 1)["i"].alias("last")))

    def singles(xs: Column) -> Column:
        long = F.filter(xs, lambda x: x["words"] > long_line)
        return F.transform(long, lambda x: F.struct(
            F.xxhash64(F.lit(-1), x["h"]).alias("h"), x["i"].alias("first"), x["i"].alias("last")))

    # one evaluation of the hashed lines, bound by a lambda
    return F.flatten(F.transform(F.array(hashed), lambda xs: F.concat(runs(xs), singles(xs))))


def repeated_windows(docs: DataFrame, window: int = WINDOW, long_line: int = LONG_LINE) -> DataFrame:
    """Rows (doc_id, first, last): line ranges of all occurrences but the first of each repeated window.

    Occurrences are ordered by doc_id (null first), then line. Counting combines before it shuffles, and the
    windows of a hot key meet its one row in a join that adaptive execution splits.
    """
    found = docs.select("doc_id", F.split("text", "\n").alias("lines")).select(
        "doc_id", F.explode(_windows(window, long_line)).alias("w")).select("doc_id", "w.h", "w.first", "w.last")
    place = F.struct(F.col("doc_id").isNotNull().alias("k"), "doc_id", "first")
    repeated = kept(found.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("origin"))
                    .where("n > 1").select("h", "origin"))
    later = found.join(repeated, "h").where(~place.eqNullSafe(F.col("origin")))
    return later.select("doc_id", "first", "last")


def dedup_lines(docs: DataFrame, window: int = WINDOW, long_line: int = LONG_LINE) -> DataFrame:
    """The input with lines removed from ``text``, and lines_removed (bigint).

    A line goes if a window that covers it occurred before, in an earlier document (by doc_id) or further up.
    Windows span ``window`` successive lines with text, compared without surrounding and repeated white space;
    a document with fewer lines is one window, and a line of over ``long_line`` words is one as well. Lines without
    text inside a removed window go with it. A document that repeats others throughout ends with an empty text.
    Rows that share a doc_id are one document: they lose the same line numbers, and copies among them stay.
    Null texts stay null. Other columns are kept; if one is called lines_removed, the new one gets an underscore.
    """
    marks = repeated_windows(docs.select("doc_id", "text"), window, long_line)
    key, ranges = fresh(docs, "marked_doc_id"), fresh(docs, "marked_ranges")
    marks = marks.groupBy("doc_id").agg(F.collect_set(F.struct("first", "last")).alias(ranges)).withColumnRenamed("doc_id", key)
    removed = fresh(docs, "lines_removed")
    joined = docs.join(marks, docs["doc_id"].eqNullSafe(marks[key]), "left")
    covered = F.array_distinct(F.flatten(F.transform(ranges, lambda r: F.sequence(r["first"], r["last"]))))
    lines = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
    rest = F.transform(F.array(lines), lambda xs: F.array_join(F.transform(left, lambda i: F.get(xs, i)), "\n"))[0]
    hit = F.col(ranges).isNotNull() & F.col("text").isNotNull()
    changed = F.when(hit, rest).otherwise(F.col("text"))
    columns = [(changed.alias(c) if c.lower() == "text" else F.col(f"`{c}`")) for c in docs.columns]
    count = F.when(hit, F.size(lines) - F.size(left)).otherwise(0).cast("bigint")
    return joined.select(*columns, count.alias(removed))
