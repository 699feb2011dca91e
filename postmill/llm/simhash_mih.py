"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments. Two fingerprints that differ in at most ``radius`` bits are, in at least one
segment, within a small Hamming ball of each other, so each fingerprint is stored under its own segment values and
looked up under all values of the balls; whole distances are verified in the join. Nothing is approximate.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from postmill.llm.common import bounded_batches, fresh, hinted, kept
from postmill.llm.components import components
from postmill.sources.staging import staged

BITS = 64
#: Fingerprints with one segment value above which that value is not looked up; see ``_midpoint_links``.
BUCKET = 256
#: Distinct fingerprints up to which three segments are used; two beyond, so that buckets stay small.
THREE_SEGMENTS = 1 << 24
_CHUNK = 1 << 15
_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes | None, shingle: int) -> int:
    """64 bits, each set where more than half of the shingle hashes set it; 0 for a text without words."""
    words = (text or b"").lower().split()  # on bytes: A-Z and the six ASCII white-space characters only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    size = min(shingle, len(words))
    n = len(words) - size + 1
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, n, _CHUNK):
        high = min(n, low + _CHUNK)
        spans = zip(starts[low:high].tolist(), ends[low + size - 1:high + size - 1].tolist())
        octets = np.array([digest(joined[a:b], 42) for a, b in spans], dtype="<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            ones[8 * k:8 * k + 8] += np.bincount(octets[:, k], minlength=256) @ _BITS_OF_BYTE
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows (*columns, fp), one per input row; null texts count as empty."""
    bounded_batches(docs.sparkSession)
    source = docs.select(*columns, F.col("text").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("body").cast(pa.binary()).to_pylist()
            prints = pa.array([fingerprint(t, shingle) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), prints], names=[*columns, "fp"])

    return source.mapInArrow(run, T.StructType([*source.schema.fields[:-1], T.StructField("fp", T.LongType())]))


def _ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with at most ``radius`` ones."""
    return [sum(1 << i for i in ones) for k in range(radius + 1) for ones in combinations(range(width), k)]


def _longs(values: list[int]) -> Column:
    """An array literal, folded once; values are 64-bit patterns."""
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    return F.expr(f"array({','.join('bigint(' + repr(str(v)) + ')' for v in signed)})")


def segments(radius: int, count: int) -> list[tuple[int, int, int]]:
    """(shift, width, ball radius) per searched segment; the radii make a miss in all of them impossible.

    With radius = base * count + rest, a pair that is further than ``base`` in the first rest + 1 segments and
    further than ``base - 1`` in the others differs in more than ``radius`` bits.
    """
    base, rest = divmod(radius, count)
    found, shift = [], 0
    for i in range(count):
        width = BITS // count + (i < BITS % count)
        if (ball := base if i <= rest else base - 1) >= 0:
            found.append((shift, width, ball))
        shift += width
    return found


def _code(i: int, shift: int, width: int) -> Column:
    """Number and value of a segment in one bigint."""
    return F.shiftrightunsigned("fp", shift).bitwiseAND((1 << width) - 1).bitwiseOR(F.lit(i << 40).cast("bigint"))


def _asked(code: Column, width: int, radius: int) -> Column:
    """All codes within a ball around one."""
    return F.transform(_longs(_ball(width, radius)), lambda mask: code.bitwiseXOR(mask))


def _midpoint_links(prints: DataFrame, radius: int) -> DataFrame:
    """Exact links among fingerprints of overfull buckets, without comparing pairs.

    Two fingerprints within ``radius`` have a common point within half of it from both. Each one is sent to all
    points of its ball; members of a point are linked to its smallest close member. A point has no more members
    than a ball has points, so no group grows with the data.
    """
    near = radius // 2
    far = radius - near
    sent = prints.select("fp", F.explode(F.transform(
        _longs(_ball(BITS, far)), lambda m: F.struct(m.alias("mask"), (F.bit_count(m) <= near).alias("close"))
    )).alias("s")).select("fp", F.col("fp").bitwiseXOR(F.col("s.mask")).alias("point"), "s.close")
    members = sent.groupBy("point").agg(
        F.min(F.when(F.col("close"), F.col("fp"))).alias("a"), F.collect_set("fp").alias("all"))
    return members.where("a IS NOT NULL AND size(all) > 1").select("a", F.explode("all").alias("b")).where("a <> b")


def links(prints: DataFrame, radius: int = 4, count: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column fp) within ``radius`` differing bits.

    Every such pair is a link, except between members of buckets with over ``bucket`` entries, where only enough
    of them are made to connect the same fingerprints.
    """
    parts = list(enumerate(segments(radius, count)))
    own = prints.select("fp", F.explode(F.array(*[_code(i, s, w) for i, (s, w, _) in parts])).alias("code"))
    asked = prints.select("fp", F.explode(F.concat(*[_asked(_code(i, s, w), w, r) for i, (s, w, r) in parts])).alias("code"))
    full = kept(own.groupBy("code").count().where(F.col("count") > bucket).select("code"))
    made = None
    if not full.isEmpty():
        made = _midpoint_links(kept(own.join(full, "code", "left_semi").select("fp").distinct()), radius)
        own = own.join(full, "code", "left_anti")
    x, y = asked.alias("x"), own.alias("y")
    pairs = x.join(y, F.expr(
        f"x.code = y.code AND x.fp <> y.fp AND bit_count(x.fp ^ y.fp) <= {int(radius)}"
    )).select(F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b"))
    return (pairs if made is None else pairs.union(made)).distinct()


def _roots(nodes: DataFrame, radius: int, bucket: int) -> DataFrame:
    """Rows (fp, root) of the distinct fingerprints that have links."""
    count = 3 if nodes.count() <= THREE_SEGMENTS else 2
    return kept(components(links(nodes.select("fp"), radius, count, bucket)).withColumnRenamed("node", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, bucket: int = BUCKET) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id), one per input row.

    Documents whose fingerprints differ in at most ``radius`` bits are linked; component_id is the smallest
    doc_id that can be reached. Exact copies share a fingerprint and are never compared. Texts without words
    (null and empty ones too) have fingerprint 0 and are linked like any other. Rows that repeat a doc_id each
    get a result row; a component whose ids are all null has a null component_id. Other columns are ignored.
    """
    prints = kept(fingerprints(docs, shingle))
    nodes = kept(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = _roots(nodes, radius, bucket)
    linked = kept(roots.join(nodes, "fp"))
    smallest = kept(linked.groupBy("root").agg(F.min("first_id").alias("component_id")))
    moved = linked.join(smallest, "root").select("fp", "component_id")
    classes = kept(nodes.join(moved, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id")))
    return prints.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, radius: int = 4, bucket: int = BUCKET) -> DataFrame:
    """Exactly one row of each component that ``near_duplicates`` finds: the one of smallest doc_id, null ids last.

    Rows are told apart by a number they get here, not by doc_id: of rows that agree in it, or in all columns, one stays if they are linked, and
    each stays if they are not. Input rows are written once with their numbers, so that these outlive lost executors. All columns are
    returned as they are.
    """
    number = fresh(docs, "row_number")
    rows = staged(docs.withColumn(number, F.monotonically_increasing_id()))
    prints = kept(fingerprints(rows, shingle, ("doc_id", number)).withColumnRenamed(number, "row"))
    roots = _roots(kept(prints.select("fp").distinct()), radius, bucket)
    linked = prints.join(hinted(roots, roots.count()), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = linked.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("stays"))
    gone = kept(linked.select("root", "row").join(first, "root").where("row <> stays").select("row"))
    return rows.join(hinted(gone, gone.count()), rows[number] == gone["row"], "left_anti").drop(number)
