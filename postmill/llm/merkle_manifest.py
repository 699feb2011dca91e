"""A Merkle manifest of a data set by time-forward processing.

Nodes are labelled so that children come before their parent. Leaves are ranked within their tree and cut into blocks, each a whole subtree; the
sort of a shuffle hands a task its blocks in the order of labels, and a priority queue ordered by label
delivers child digests to parents while the leaves stream by. The roots of the blocks are the leaves of the next round, so rounds
grow with the logarithm of the rows. Then the rounds are swept in reverse: each block gets its proof suffix and
hands it to its leaves behind their own siblings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from postmill.llm.common import hinted, kept
from postmill.llm.places import placed, with_spans

#: Children of a node, and levels of a block: FAN ** LEVELS leaves lie in one.
FAN = 16
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_ROWS = 512
PROOF = "array<struct<position:int,siblings:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _h(digests: Iterable[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


class Queue:
    """Messages to nodes of one block, taken in the order of labels (last leaf below the node, level)."""

    def __init__(self, levels: int):
        self.levels = levels
        self.heap: list[tuple[int, int, int, str]] = []
        self.top = ""

    def send(self, level: int, index: int, digest: str) -> None:
        """The digest of a finished node, to its parent; a block's highest node has none."""
        if level == self.levels:
            self.top = digest
        else:
            span = FAN ** (level + 1)
            heappush(self.heap, (index // FAN * span + span - 1, level + 1, index, digest))

    def run(self, upto: float) -> None:
        """Finish the nodes whose last leaf is at most ``upto``; all of a node's messages are there by then."""
        heap = self.heap
        while heap and heap[0][0] <= upto:
            last, level, index, digest = heappop(heap)
            children = [digest]
            while heap and heap[0][:2] == (last, level):
                children.append(heappop(heap)[3])
            self.send(level, index // FAN, _h(children))


def _blocks(rows: Iterator[tuple], size: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Successive rows (tree, place, ...) of one block each."""
    row = next(rows, None)
    while row is not None:
        key = (row[0], row[1] // size)

        def members(first: tuple = row, key: tuple = key) -> Iterator[tuple]:
            nonlocal row
            row = first
            while row is not None and (row[0], row[1] // size) == key:
                yield row
                row = next(rows, None)

        yield key, members()


def _columns(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(n).to_pylist() for n in names))


def climb(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Rows (tree, place, n, digest) of the nodes ``levels`` above the given ones, or of the highest."""
    size = FAN ** levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (tree, block), members in _blocks(_columns(batches, ("tree", "place", "n", "digest")), size):
            queue = None
            for _, place, n, digest in members:
                if queue is None:
                    queue = Queue(min(levels, height(n)))
                    above = -(-n // FAN ** queue.levels)
                queue.send(0, place - block * size, digest)
                queue.run(place - block * size)
            queue.run(float("inf"))
            out.append((tree, block, above, queue.top))
            if len(out) == _ROWS:
                yield _batch(out, ("tree", "place", "n", "digest"))
                out = []
        if out:
            yield _batch(out, ("tree", "place", "n", "digest"))

    block = F.floor(F.col("place") / size)
    ordered = nodes.select("tree", "place", "n", "digest").repartition("tree", block).sortWithinPartitions("tree", "place")
    return ordered.mapInArrow(run, "tree string, place bigint, n bigint, digest string")


def _batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=list(names))


def descend(nodes: DataFrame, above: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``above`` rows (tree, place, proof, root, subroot) handed to the nodes below them: all columns of ``nodes`` and those three."""
    size = FAN ** levels
    names = nodes.columns
    kinds = {f.name: f.dataType for f in nodes.schema.fields}
    given = above.select(
        *[(F.col(c) if c == "tree" else (F.col("place") * size) if c == "place" else F.lit(None)).cast(kinds[c]).alias(c) for c in names],
        F.lit(0).alias("kind"), "proof", "root", "subroot")
    asked = nodes.select(*names, F.lit(1).alias("kind"), F.lit(None).cast(PROOF).alias("proof"),
                         F.lit(None).cast("string").alias("root"), F.lit(None).cast("string").alias("subroot"))
    ordered = given.union(asked).repartition("tree", F.floor(F.col("place") / size)).sortWithinPartitions("tree", "place", "kind")
    at = [names.index(c) for c in ("tree", "place", "n", "digest")]
    order = (*names, "kind", "proof", "root", "subroot")
    schema = T.StructType([*nodes.schema.fields, ordered.schema["proof"], ordered.schema["root"], ordered.schema["subroot"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []

        def rows() -> Iterator[tuple]:
            for b in batches:
                types[:] = [b.schema.field(c).type for c in order]
                for row in zip(*(b.column(c).to_pylist() for c in order)):
                    yield (row[at[0]], row[at[1]], row)

        for _, members in _blocks(rows(), size):
            suffix = next(members)[2]
            block = [m[2] for m in members]
            if block:
                proofs = own_proofs([r[at[3]] for r in block], min(levels, height(block[0][at[2]])))
                rest = [(p["position"], p["siblings"]) for p in suffix[-3]]
                for low in range(0, len(block), _ROWS):
                    part = block[low:low + _ROWS]
                    columns = [pa.array(c, k) for c, k in zip(zip(*(r[:len(names)] for r in part)), types)]
                    ends = [pa.array([suffix[k]] * len(part), pa.string()) for k in (-2, -1)]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, _proof_column([proofs[low + i] + rest for i in range(len(part))]), *ends], names=schema.names)

    return ordered.mapInArrow(run, schema)


def _proof_column(proofs: list[list[tuple[int, str]]]) -> pa.Array:
    offsets = [0]
    for p in proofs:
        offsets.append(offsets[-1] + len(p))
    flat = [step for p in proofs for step in p]
    steps = pa.StructArray.from_arrays(
        [pa.array([s[0] for s in flat], pa.int32()), pa.array([s[1] for s in flat], pa.string())], names=["position", "siblings"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), steps)


def own_proofs(digests: list[str], levels: int) -> list[list[tuple[int, str]]]:
    """(place in the run, digests of the others) on each level of a block, for each of its leaves: from the highest level down."""
    rows = [digests]
    for _ in range(levels):
        rows.append([_h(rows[-1][i:i + FAN]) for i in range(0, len(rows[-1]), FAN)])
    below: list[list[tuple[int, str]]] = [[] for _ in rows[-1]]
    for row in reversed(rows[:-1]):
        steps = []
        for i in range(len(row)):
            low = i // FAN * FAN
            steps.append((i - low, "".join(row[low:i]) + "".join(row[i + 1:low + FAN])))
        below = [[step, *below[i // FAN]] for i, step in enumerate(steps)]
    return below


def _ladder(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The given nodes and those of each round above, up to one per tree."""
    stages = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0  # one number
    while most > 1:
        stages.append(kept(climb(stages[-1], levels)))
        most = -(-most // FAN ** levels)
    return stages


def manifest(docs: DataFrame, carry: tuple[str, ...] = (), levels: int = LEVELS) -> DataFrame:
    """Rows (doc_id, source, place, leaf, subroot, root, proof, *carry), one per input row.

    A leaf is the digest of FIELDS. Per source leaves ascend by doc_id, nulls first and equal ids by digest; while several nodes remain every
    FAN successive ones become their digest, which gives the subroot. Subroots in the order of their sources (null first, by bytes) give the
    root likewise. ``proof`` lists from the leaf up the place in each run and the digests of its other nodes, and ``fold`` recomputes the root from
    it. Null fields, empty and very long texts are digested like any other; repeated rows are leaves of their own; an empty table has no
    rows. Columns outside FIELDS are ignored, unless ``carry`` names them. A hot source is many blocks; texts are read once and never shuffled.
    """
    def bound(column: str) -> Column:
        return F.col(f"`{column}`")

    rows = docs.select(bound("source").cast("string").alias("tree"), bound("doc_id").alias("doc_id"),
                       leaf_digest(*map(bound, FIELDS)).alias("digest"), *[bound(c).alias(f"carry_{i}") for i, c in enumerate(carry)])
    numbered, spans = placed(rows, ["tree"], ["doc_id", "digest"])
    leaves = kept(with_spans(numbered, spans, ["tree"]).drop("at", "seg")
                  .withColumnRenamed("total", "n"))
    stages = _ladder(leaves, levels)
    subroots = stages[-1].select(F.col("tree").alias("source"), "digest")
    top, top_spans = placed(subroots.withColumn("tree", F.lit("")), ["tree"], ["source"])
    nodes = kept(with_spans(top, top_spans, ["tree"]).drop("at", "seg")
                 .withColumnRenamed("total", "n"))
    tops = _ladder(nodes, levels)
    above = tops[-1].select("tree", "place", F.array().cast(PROOF).alias("proof"), F.col("digest").alias("root"),
                            F.lit("").alias("subroot"))
    for stage in reversed(tops[:-1]):
        above = descend(stage, above, levels).select(*(["source", "digest"] if stage is nodes else ["tree"]), "place", "proof", "root", "subroot")
    if len(tops) == 1:
        above = nodes.select("source", "digest", "place", F.array().cast(PROOF).alias("proof"), F.col("digest").alias("root"),
                             F.lit("").alias("subroot"))
    above = above.select(F.col("source").alias("tree"), F.lit(0).cast("bigint").alias("place"), "proof", "root",
                         F.col("digest").alias("subroot"))
    for stage in reversed(stages[:-1]):
        above = descend(stage, kept(above), levels)
    if len(stages) == 1:
        side = kept(above)
        joined = leaves.join(hinted(side.select(F.col("tree").alias("above_tree"), "proof", "root", "subroot"), side.count()),
                             F.col("tree").eqNullSafe(F.col("above_tree")))
        above = joined.drop("above_tree")
    return above.select("doc_id", F.col("tree").alias("source"), "place", F.col("digest").alias("leaf"), "subroot", "root", "proof",
                        *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)])


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings, level by level from the leaf up."""
    return F.sha2(F.array_join(F.transform(proof, lambda p: p["siblings"]), ""), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf has under its proof."""
    def step(digest: Column, p: Column) -> Column:
        cut = p["position"] * 64
        rest = F.substr(p["siblings"], cut + 1)
        return F.sha2(F.concat(F.substr(p["siblings"], F.lit(1), cut), digest, rest), 256)

    return F.aggregate(proof, leaf, step)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def report(docs: DataFrame, tampered: Callable[[Column], Column] = lambda doc_id: F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0,
           levels: int = LEVELS) -> DataFrame:
    """Digests of the manifest, and whether each leaf still proves the root after a fifth of the documents had A-Z lower-cased.

    Rows whose doc_id is null are not tampered with.
    """
    lowered = leaf_digest(*[F.translate("text", _UPPER, _LOWER) if c == "text" else F.col(c) for c in FIELDS])
    rows = docs.select(*FIELDS, F.when(tampered(F.col("doc_id")), lowered).alias("changed"))
    out = manifest(rows, ("changed",), levels)
    folded = fold(F.coalesce("changed", "leaf"), F.col("proof"))
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                      folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
