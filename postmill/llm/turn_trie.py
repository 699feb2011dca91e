"""The prefix trie of conversations as burst tries.

A shard holds containers: the suffixes of all conversations that share a head, a path of turns from the root. A container of more
than so many suffix turns bursts by the next turn id into containers of its own children, and its head becomes a node
of the access trie above the containers. Digests of all prefixes are known beforehand, so which containers burst is one
aggregation for all depths, not a job per depth. What remains is small, is sorted, and is swept into nodes. Nodes of the
access trie get their totals from the containers and nodes below them, along the conversations.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from postmill.llm.common import hinted, kept
from postmill.llm.places import placed, running, with_spans

#: Turns in the suffixes of a container, above which it bursts; each is a row of some 100 bytes.
CONTAINER = 8192
#: Conversation numbers that are joined to a text before it goes to the task that digests a node's ends.
_ENDS = 4096
_ROWS = 1024
_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_NODE_KINDS = [*[pa.int64()] * 7, pa.string()]


def placed_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns in order over many tasks, and the spans of each conversation; see ``places.placed``.

    Rows carry turn_key, a 128-bit digest of role and text, and n_bytes, the UTF-8 bytes of the text. Null roles and texts are empty, null turns
    first, and equal turns in the order of their digests. Rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("turn_key"),
        F.octet_length(text).cast("bigint").alias("n_bytes"))
    return placed(rows, ["conv_id"], ["turn", "turn_key"])


def whole(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are: rows (conv_id, seg, depth, turn_key, n_bytes, length), and (conv_id, length)."""
    turns, spans = placed_turns(conversations)
    rows = with_spans(turns, spans, ["conv_id"])
    return rows.select("conv_id", "seg", (F.col("place") + 1).alias("depth"), "turn_key", "n_bytes", F.col("total").alias("length")), \
        spans.select("conv_id", F.col("total").alias("length")).distinct()


def rebuilt(conversations: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the first of their family; the tables of ``whole``.

    A conversation c of h = crc32(c) % ``most`` begins with the first h turns of conversation c - c % ``family`` (% as in SQL), and its own turns
    behind its first h follow.
    """
    turns, spans = placed_turns(conversations)
    sizes = spans.select("conv_id", "total").distinct()
    base = F.col("conv_id") - F.col("conv_id") % family
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h")
    first = sizes.select(F.col("conv_id").alias("base"), F.col("total").alias("base_total"))
    convs = kept(sizes.select("*", base.alias("base"), shared).join(first, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("base_total", F.lit(0))).alias("lent"),
        F.greatest(F.col("total") - F.col("h"), F.lit(0)).alias("own")).withColumn("length", F.col("lent") + F.col("own")))
    n = convs.count()
    own = with_spans(turns, spans.join(hinted(convs.select("conv_id", "h", "lent", "length"), n), "conv_id"), ["conv_id"]).where(
        "place >= h").select("conv_id", "seg", (F.col("lent") + F.col("place") - F.col("h") + 1).alias("depth"), "turn_key", "n_bytes", "length")
    heads = with_spans(turns, spans.where(f"start < {most - 1} AND conv_id % {family} = 0"), ["conv_id"]).where(F.col("place") < most - 1).select(
        F.col("conv_id").alias("base"), "place", "turn_key", "n_bytes")
    lent = heads.join(convs.where("lent > 0"), "base").where("place < lent").select(
        "conv_id", F.lit(-1).cast("bigint").alias("seg"), (F.col("place") + 1).alias("depth"), "turn_key", "n_bytes", "length")
    return own.union(lent), convs.select("conv_id", "length")


def _paths(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Rows with the 128-bit digest (p1, p2) of the path down to them and that of their parent (q1, q2); the root is a row of each conversation.

    A path's digest is the exclusive or of digests of (depth, turn), so that it can be had part by part.
    """
    roots = convs.select("conv_id", F.lit(-1).cast("bigint").alias("seg"), F.lit(0).cast("bigint").alias("depth"),
                         F.lit(None).cast("binary").alias("turn_key"), F.lit(0).cast("bigint").alias("n_bytes"), "length")
    zero = F.lit(0).cast("bigint")
    parts = rows.unionByName(roots).withColumns({
        "e1": F.when(F.col("depth") > 0, F.xxhash64("turn_key", "depth")).otherwise(zero),
        "e2": F.when(F.col("depth") > 0, F.xxhash64(F.lit("path"), "depth", "turn_key")).otherwise(zero)})
    found = running(parts, "conv_id", "depth", {"p1": "e1", "p2": "e2"}, F.bit_xor)
    above = lambda p, e: F.when(F.col("depth") > 0, F.col(p).bitwiseXOR(F.col(e)))
    return kept(found.withColumns({"q1": above("p1", "e1"), "q2": above("p2", "e2")}).drop("e1", "e2"))


def _ends_digest(ids: list[int]) -> str:
    return sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


def sweep(members: dict[int, list[tuple[bytes, int]]], depth: int, complete: set[int]) -> list[list]:
    """Nodes of one container whose head's child lies at ``depth``, that one first.

    ``members`` maps a conversation to the (turn id, bytes) of its suffix. Sorted suffixes are swept with a stack of open nodes: a
    node closes when the next suffix leaves it.
    """
    nodes: list[list] = []  # conv_id, depth, parent, n_convs, n_children, n_leaves, saved_tokens, ends, bytes
    stack: list[int] = []

    def close() -> None:
        node = nodes[stack.pop()]
        node[5] = node[5] or 1
        node[6] += (node[3] - 1) * node[8]
        if stack:
            parent = nodes[stack[-1]]
            parent[5] += node[5]
            parent[6] += node[6]

    last: list[bytes] = []
    for keys, conv, turns in sorted((([k for k, _ in turns], conv, turns) for conv, turns in members.items()), key=lambda m: m[:2]):
        same = 0
        while same < min(len(keys), len(last)) and keys[same] == last[same]:
            same += 1
        while len(stack) > same:
            close()
        for i in range(same, len(keys)):
            if stack:
                nodes[stack[-1]][4] += 1
            nodes.append([conv, depth + i, stack[-1] if stack else None, 0, 0, 0, 0, [], turns[i][1]])
            stack.append(len(nodes) - 1)
        for at in stack:
            nodes[at][3] += 1
            nodes[at][0] = min(nodes[at][0], conv)
        if conv in complete:
            nodes[stack[-1]][7].append(conv)
        last = keys
    while stack:
        close()
    return [[n[0], n[1], None if n[2] is None else nodes[n[2]][0], *n[3:7], _ends_digest(n[7])] for n in nodes]


def _swept(tails: DataFrame) -> DataFrame:
    """Nodes of all containers: columns of a node, and (q1, q2), the container's head, at its highest node."""
    kinds = [*_NODE_KINDS, pa.int64(), pa.int64(), pa.bool_()]
    names = [*_NODE, "q1", "q2", "top"]

    def nodes(rows: Iterator[tuple]) -> Iterator[tuple]:
        head, members, first, low, above = None, {}, 0, set(), (None, None)

        def done() -> Iterator[tuple]:
            for i, node in enumerate(sweep(members, first, low)):
                yield (*node, *(above if i == 0 else (None, None)), i == 0)

        for t1, t2, conv, depth, key, size, length, q1, q2 in rows:
            if (t1, t2) != head:
                if members:
                    yield from done()
                head, members, first, low, above = (t1, t2), {}, depth, set(), (q1, q2)
            members.setdefault(conv, []).append((key or b"", size))
            if depth == length:
                low.add(conv)
        if members:
            yield from done()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        block: list[tuple] = []
        for node in nodes(rows):
            block.append(node)
            if len(block) == _ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*block), kinds)], names=names)
                block = []
        if block:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*block), kinds)], names=names)

    shard = tails.repartition("t1", "t2").sortWithinPartitions("t1", "t2", "conv_id", "depth")
    return shard.select("t1", "t2", "conv_id", "depth", "turn_key", "n_bytes", "length", "q1", "q2").mapInArrow(
        run, ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'boolean' if c == 'top' else 'bigint'}" for c in names))


def _ends(enders: DataFrame) -> DataFrame:
    """Rows (p1, p2, ends_sha256) of rows (p1, p2, conv_id): numbers are joined in parts side by side, and the parts digested in order.

    A digest is sequential by its nature; the task that makes it streams texts of up to 4,096 numbers and holds one batch.
    """
    rows, _ = placed(enders, ["p1", "p2"], ["conv_id"])
    ids = F.array_sort(F.collect_list("conv_id"))
    parts = rows.groupBy("p1", "p2", "seg", F.floor(F.col("at") / _ENDS).alias("part")).agg(
        F.min("at").alias("at"), F.array_join(F.transform(ids, lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, state = None, None
        for b in batches:
            out: list[tuple] = []
            for p1, p2, ids in zip(*(c.to_pylist() for c in b.columns)):
                if (p1, p2) == head:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    out.append((*head, state.hexdigest()))
                head, state = (p1, p2), sha256(ids.encode())
            yield _ended(out)
        if state:
            yield _ended([(*head, state.hexdigest())])

    def _ended(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["p1", "p2", "ends_sha256"])

    ordered = parts.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "at")
    return ordered.select("p1", "p2", "ids").mapInArrow(run, "p1 bigint, p2 bigint, ends_sha256 string")


def _on(side: DataFrame, *names: str) -> DataFrame:
    return side.select(*[F.col(a).alias(b) for a, b in (n.split(">") for n in names)])


def prefix_trie(rows: DataFrame, convs: DataFrame, container: int = CONTAINER) -> DataFrame:
    """One row per node, that is per distinct sequence of the first d turns of a conversation, the root (d = 0) included.

    Takes the tables of ``whole`` or ``rebuilt``. Rows (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256):
    the smallest conversation through the node and through its parent, conversations through it, children, childless nodes at or
    below it, bytes of texts that sharing saves there (n_convs - 1 times a node's own text), and the digest of the
    conversations that end there, ascending. Conversations without turns end at the root; no conversations, no rows. Groups of equal
    conversations and long ones never make a container: their heads burst to the end, and nodes of the access trie are aggregated.
    """
    paths = _paths(rows, convs)
    counted = paths.groupBy("p1", "p2").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("first_conv"), F.sum(F.col("length") - F.col("depth") + 1).alias("size"),
        F.min("depth").alias("depth"), F.min("n_bytes").alias("n_bytes"), F.min("q1").alias("q1"), F.min("q2").alias("q2"))
    burst = kept(counted.where(F.col("size") > container))
    n_burst = burst.count()
    keys = hinted(burst.select("p1", "p2"), n_burst)
    from_top = Window.partitionBy("conv_id").orderBy("depth")  # at most ``container`` rows each
    tails = paths.join(keys, ["p1", "p2"], "left_anti").select(
        "conv_id", "depth", "turn_key", "n_bytes", "length",
        *[F.first(a, ignorenulls=False).over(from_top).alias(b) for a, b in (("p1", "t1"), ("p2", "t2"), ("q1", "q1"), ("q2", "q2"))])
    nodes = kept(_swept(tails))
    low = nodes.where("NOT top OR q1 IS NULL").select(*_NODE)
    if not n_burst:
        return low
    tops = nodes.where("top AND q1 IS NOT NULL")
    heads = kept(_heads(paths, burst, n_burst, tops))
    parent = hinted(_on(burst, "p1>q1", "p2>q2", "first_conv>parent"), n_burst)

    def under(side: DataFrame) -> DataFrame:
        return side.join(parent, ["q1", "q2"], "left").withColumn("parent_conv_id", F.col("parent")).select(*_NODE)

    return low.union(under(tops)).union(under(heads))


def _heads(paths: DataFrame, burst: DataFrame, n_burst: int, tops: DataFrame) -> DataFrame:
    """Nodes of the access trie, with (q1, q2) of their parents.

    What a head adds itself and from the containers right below it stands at its row in its first conversation. Summed backwards along
    conversations, and then over the conversations through a head, that is the total below it: each row counts once.
    """
    below = _on(tops, "q1>p1", "q2>p2", "n_leaves>leaves", "saved_tokens>saved").union(
        burst.where("q1 IS NOT NULL").select(F.col("q1").alias("p1"), F.col("q2").alias("p2"), F.lit(0), F.lit(0)))
    kids = below.groupBy("p1", "p2").agg(F.count("*").alias("n_children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    zero = F.lit(0).cast("bigint")
    own = kept(burst.join(hinted(kids, n_burst), ["p1", "p2"], "left").select(
        "p1", "p2", "first_conv", "depth", "n_convs", "q1", "q2", F.coalesce("n_children", zero).alias("n_children"),
        F.when(F.col("n_children").isNull(), F.lit(1).cast("bigint")).otherwise(F.col("leaves")).alias("leaves"),
        (F.coalesce("saved", zero) + (F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved")))
    mine = F.col("conv_id") == F.col("first_conv")
    along = paths.select("conv_id", "seg", "depth", "length", "p1", "p2").join(
        hinted(own.select("p1", "p2", "first_conv", "leaves", "saved"), n_burst), ["p1", "p2"]).select(
        "p1", "p2", "conv_id", "seg", "depth", "length",
        *[F.when(mine, F.col(c)).otherwise(zero).alias(c) for c in ("leaves", "saved")])
    summed = running(along, "conv_id", "depth", {"n_leaves": "leaves", "saved_tokens": "saved"}, F.sum, backwards=True)
    totals = summed.groupBy("p1", "p2").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    ends = _ends(along.where("depth = length").select("p1", "p2", "conv_id"))
    none: Column = F.lit(sha256(b"").hexdigest())
    return own.drop("leaves", "saved").withColumnRenamed("first_conv", "conv_id").join(totals, ["p1", "p2"]).join(ends, ["p1", "p2"], "left").select(
        "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"), "q1", "q2")
