"""Language-model scores from a weighted backoff automaton of smoothed word n-grams.

The model holds every n-gram of the training documents and grows with them, so it is neither broadcast nor held
in one place. Documents are dealt into blocks of bounded size. A block sends its distinct n-grams, packed and
ordered, to the shards that add them up over the corpus, and gets the totals back in the same order. From these it
builds the part of the automaton that its own documents can visit and walks each text through it once, all texts of
the block side by side.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from postmill.llm.common import bounded_batches, parallelism, remainder, text_bytes
from postmill.llm.packing import pack_counts, pack_keys, unpack_counts, unpack_keys

BLOCK_BYTES = 4 << 20
SHARD_BYTES = 16 << 20
#: Words that a task counting the vocabulary holds, some 16 bytes each, before it adds them up and sends them on.
HELD_WORDS = 1 << 20
#: A context seen c times gives the mass SCALE * c ** POWER, against c, to continuations it was not seen with:
#: distinct continuations grow as a power of the count (Heaps). A weight for each context keeps all sums at 1.
SCALE, POWER = 1.0, 0.8
_START, _END = (xxhash.xxh64_intdigest(mark) for mark in (b" start", b" end"))  # no word holds a blank


def _mixed(keys: np.ndarray, nexts: np.ndarray) -> np.ndarray:
    """64-bit keys of n-grams that extend others by a token."""
    x = (keys ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9) + nexts
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


@dataclass
class Tokens:
    """Documents of a block as one sequence: a start mark, the words, an end mark for each."""

    symbols: np.ndarray  # numbers into ``hashes``
    hashes: np.ndarray  # the last two are the start and the end mark
    starts: np.ndarray  # position of each start mark
    lengths: np.ndarray  # with both marks

    @property
    def start(self) -> int:
        return len(self.hashes) - 2


def tokens(texts: pa.Array) -> Tokens:
    """Words are runs without ASCII white space, A-Z lower-cased; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = split.flatten().dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64))
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    if b"" in words:
        real = ids != words.index(b"")
        ids, doc = ids[real], doc[real]
    lengths = np.bincount(doc, minlength=len(texts)) + 2
    starts = np.cumsum(lengths) - lengths
    symbols = np.full(int(lengths.sum()), len(words) + 1, np.int64)
    symbols[starts] = len(words)
    symbols[np.arange(len(ids)) + 2 * doc + 1] = ids
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w) for w in words] + [_START, _END], np.uint64)
    return Tokens(symbols, hashes, starts, lengths)


@dataclass
class Grams:
    """Distinct n-grams of one length: where each occurs first, and which one ends at each position."""

    keys: np.ndarray
    first: np.ndarray
    at: np.ndarray  # -1 where too few tokens precede


def grams(seq: Tokens, order: int) -> list[Grams]:
    inside = np.arange(len(seq.symbols)) - np.repeat(seq.starts, seq.lengths)
    hashed = seq.hashes[seq.symbols]
    keys, found = hashed, []
    for k in range(order):
        if k:
            keys = np.concatenate([keys[:1], _mixed(keys[:-1], hashed[1:])])
        valid = np.flatnonzero(inside >= k)
        distinct, first, number = np.unique(keys[valid], return_index=True, return_inverse=True)
        at = np.full(len(keys), -1, np.int64)
        at[valid] = number
        found.append(Grams(distinct, valid[first] if len(valid) else valid, at))
    return found


def _sorted_keys(levels: list[Grams]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([g.keys for g in levels])
    order = np.argsort(keys, kind="stable")
    return keys[order], order


def _dealt(block: int, keys: np.ndarray, counts: np.ndarray, shards: int) -> pa.Table:
    """Ascending keys with their counts, a row per shard."""
    shard = ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    cuts = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
    full = np.flatnonzero(np.diff(cuts))
    return pa.table({
        "shard": pa.array(full, pa.int64()),
        "block": pa.array(np.full(len(full), block), pa.int64()),
        "keys": pa.array([pack_keys(keys[cuts[s]:cuts[s + 1]]) for s in full], pa.binary()),
        "counts": pa.array([pack_counts(counts[cuts[s]:cuts[s + 1]]) for s in full], pa.binary()),
    })


def _requests(block: int, seq: Tokens, levels: list[Grams], train: np.ndarray, shards: int) -> pa.Table:
    """Per shard, the n-grams of a block with their numbers of occurrences in training documents."""
    weight = np.repeat(train, seq.lengths)
    counts = [np.bincount(g.at[g.at >= 0], weight[g.at >= 0], minlength=len(g.keys)) for g in levels]
    keys, order = _sorted_keys(levels)
    return _dealt(block, keys, np.concatenate(counts).astype(np.int64)[order], shards)


def _totals(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a shard as (row numbers, counts over the corpus) of its n-grams, and one total per distinct key."""
    parts = [unpack_keys(c) for c in table.column("keys").to_pylist()]
    counts = np.concatenate([unpack_counts(c) for c in table.column("counts").to_pylist()])
    _, number = np.unique(np.concatenate(parts), return_inverse=True)
    sums = np.bincount(number, counts).astype(np.int64)
    return np.cumsum([len(p) for p in parts])[:-1], sums[number], sums


class Automaton:
    """States are contexts, arcs are n-grams of the model; a failure arc leads from a context to its shorter one.

    ``totals`` holds the training counts of all n-grams of the block, by length. State 0 is the empty context. It
    has an arc for every token, also for unknown ones, so each walk ends.
    """

    def __init__(self, seq: Tokens, levels: list[Grams], totals: list[np.ndarray], n_tokens: int, n_words: int):
        self.width = len(seq.hashes)
        self.base = base = np.cumsum([1] + [len(g.keys) for g in levels])  # state of gram i of length k + 1: base[k] + i
        symbol = seq.symbols[levels[0].first]
        probability = (totals[0] + 1) / (n_tokens + 1 * (n_words + 1))
        self.root_weight = np.full(self.width, math.nan)
        self.root_weight[symbol] = np.log10(probability)
        self.root_next = np.zeros(self.width, np.int64)
        if len(levels) > 1:
            self.root_next[symbol] = np.where(totals[0] > 0, base[0] + np.arange(len(symbol)), 0)
        backoff, failure = [np.zeros(1)], [np.zeros(1, np.int64)]
        keys, weights, nexts = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
        for k, (gram, total) in enumerate(zip(levels, totals)):
            shorter = base[k - 1] + levels[k - 1].at[gram.first] if k else np.zeros(len(gram.keys), np.int64)
            if k + 1 < len(levels):
                seen = np.maximum(total, 1).astype(float)
                mass = SCALE * seen**POWER
                backoff.append(np.where(total > 0, np.log10(mass / (seen + mass)), 0.0))
                failure.append(shorter)
            if k:
                context = levels[k - 1].at[gram.first - 1]
                c = totals[k - 1][context]
                spread = SCALE * c.astype(float) ** POWER
                below = probability[levels[k - 1].at[gram.first]]
                probability = (total + spread * below) / np.maximum(c + spread, 1e-300)
                real = (total > 0) & (c > 0)
                weights.append(np.log10(probability, out=np.full(len(total), math.nan), where=real))
                keys.append((base[k - 1] + context) * self.width + seq.symbols[gram.first])
                nexts.append(base[k] + np.arange(len(total)) if k + 1 < len(levels) else shorter)
        self.backoff, self.failure = np.concatenate(backoff), np.concatenate(failure)
        #: One place for each gram of two tokens or more; the weight is not a number where the model has no such arc.
        self.arc_key, self.arc_weight, self.arc_next = np.concatenate(keys), np.concatenate(weights), np.concatenate(nexts)
        self.begin = int(self.base[0] + np.flatnonzero(symbol == seq.start)[0]) if len(levels) > 1 and len(seq.starts) else 0

    @cached_property
    def arcs(self) -> dict[int, int]:
        """Arcs by state and symbol."""
        real = np.flatnonzero(~np.isnan(self.arc_weight))
        return dict(zip(self.arc_key[real].tolist(), real.tolist()))

    def walk(self, symbols: list[int]) -> float:
        """One traversal from left to right: follow an arc, or fail to the shorter context and try again."""
        arcs, weights, nexts, backoff, failure = self.arcs, self.arc_weight, self.arc_next, self.backoff, self.failure
        width, state, total = self.width, self.begin, 0.0
        for s in symbols:
            while state:
                arc = arcs.get(state * width + s)
                if arc is not None:
                    total += weights[arc]
                    state = nexts[arc]
                    break
                total += backoff[state]
                state = failure[state]
            else:
                total += self.root_weight[s]
                state = self.root_next[s]
        return float(total)

    def walk_block(self, seq: Tokens, levels: list[Grams]) -> np.ndarray:
        """What ``walk`` gives for each text of the block, all tokens at once.

        Each token is met in its longest context. Round by round it follows its arc, or fails to the shorter context,
        down to the empty one; contexts that the model lacks fail at no cost. The number of the gram that ends at a
        token is the place of the arc, so no arc is searched for.
        """
        predicted = np.ones(len(seq.symbols), bool)
        predicted[seq.starts] = False
        position = np.flatnonzero(predicted)
        state = np.zeros(len(position), np.int64)
        for k in range(1, len(levels)):
            inside = levels[k].at[position] >= 0
            state[inside] = self.base[k - 1] + levels[k - 1].at[position[inside] - 1]
        steps = np.zeros((len(position), len(levels)))  # what a token adds, in the order of the walk
        walking = np.ones(len(position), bool)
        for k in range(len(levels) - 1, 0, -1):
            here = np.flatnonzero(walking & (state >= self.base[k - 1]))
            weight = self.arc_weight[self.base[k] - self.base[1] + levels[k].at[position[here]]]
            failed = np.isnan(weight)
            steps[here, -1 - k] = np.where(failed, self.backoff[state[here]], weight)
            walking[here] = failed
            state[here] = self.failure[state[here]]
        steps[walking, -1] = self.root_weight[seq.symbols[position[walking]]]
        doc = np.repeat(np.arange(len(seq.starts)), (seq.lengths - 1) * len(levels))
        return np.bincount(doc, steps.ravel(), minlength=len(seq.starts))


def _score_block(seq: Tokens, levels: list[Grams], flat: np.ndarray, n_tokens: int, n_words: int):
    """Per document: tokens, known tokens, base score, score."""
    order = _sorted_keys(levels)[1]
    if len(flat) != len(order):
        raise ValueError("the texts of a block changed between two reads of the input")
    totals = np.empty(len(flat), np.int64)
    totals[order] = flat
    cut = np.cumsum([len(g.keys) for g in levels])[:-1]
    totals = np.split(totals, cut)
    predicted = np.ones(len(seq.symbols), bool)
    predicted[seq.starts] = False
    doc = np.repeat(np.arange(len(seq.starts)), seq.lengths)[predicted]
    count = totals[0][levels[0].at[predicted]]
    size = len(seq.starts)
    known = np.bincount(doc, count > 0, minlength=size).astype(np.int64)
    base = np.bincount(doc, np.log10((count + 1) / (n_tokens + 1 * (n_words + 1))), minlength=size)
    scores = Automaton(seq, levels, totals, n_tokens, n_words).walk_block(seq, levels)
    return seq.lengths - 1, known, base, scores


_REQUEST = "shard bigint, block bigint, keys binary, counts binary"


def _word_counts(batches: Iterator[pa.Array], shards: int, held_words: int = HELD_WORDS) -> Iterator[pa.Table]:
    """Words of the texts and their numbers, as rows for the shards; at most ``held_words`` and a batch are held."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def added() -> pa.Table:
        keys, number = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        counts = np.bincount(number, np.concatenate([c for _, c in held])).astype(np.int64)
        held.clear()
        return _dealt(0, keys, counts, shards)

    for texts in batches:
        seq = tokens(texts)
        held.append((seq.hashes, np.bincount(seq.symbols, minlength=len(seq.hashes))))
        if sum(len(k) for k, _ in held) >= held_words:
            yield added()
    if held:
        yield added()


def vocabulary_size(docs: DataFrame, shards: int) -> tuple[int, int]:
    """Tokens, and distinct tokens, of the training documents (columns text, train)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _word_counts((batch.column("text") for batch in batches), shards):
            yield from table.to_batches()

    def add(table: pa.Table) -> pa.Table:
        _, _, sums = _totals(table)
        return pa.table({"n": pa.array([int(sums.sum())]), "v": pa.array([int((sums > 0).sum())])})

    found = docs.where("train").select("text").mapInArrow(count, _REQUEST).groupBy("shard").applyInArrow(add, "n bigint, v bigint")
    row = found.agg(F.sum("n"), F.sum("v")).first()
    documents = docs.where("train").count()
    return (row[0] or 0) - documents, (row[1] or 0) - (documents > 0)  # without the start marks


def score(docs: DataFrame, order: int = 2, divisor: int = 7, left_out: int = 2,
          block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one per input row.

    Training documents are those whose crc32(doc_id) modulo ``divisor`` is not ``left_out``. Every text ends in an
    end token; null and empty texts consist of it alone. base_score is the add-one unigram score; score comes from
    the automaton of n-grams up to ``order``, whose probabilities of all next tokens sum to 1 in every state.
    Rows that repeat a doc_id are scored alike, and a null doc_id counts as an empty one. Without training
    documents every token is unknown. Other columns are ignored. Counts are exact but for collisions of 64-bit
    keys; blocks need an input that reads the same twice.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    size = text_bytes(docs)
    blocks = max(2 * parallelism(spark), math.ceil(size / block_bytes))
    shards = max(parallelism(spark), math.ceil(size / shard_bytes))
    train = remainder(F.col("doc_id"), divisor) != left_out
    source = docs.select("doc_id", "text").select(
        "doc_id", "text", train.alias("train"), F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(blocks)).alias("block"))
    n_tokens, n_words = vocabulary_size(source, shards)

    def request(key: tuple, table: pa.Table) -> pa.Table:
        seq = tokens(table.column("text").combine_chunks())
        weights = table.column("train").to_numpy().astype(np.int64)
        return _requests(key[0].as_py(), seq, grams(seq, order), weights, shards)

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        cuts, totals, _ = _totals(table)
        return pa.table({
            "block": table.column("block"),
            "shard": table.column("shard"),
            "totals": pa.array([pack_counts(t) for t in np.split(totals, cuts)], pa.binary()),
        })

    def finish(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        seq = tokens(table.column("text").combine_chunks())
        answers = answers.sort_by("shard")
        flat = [unpack_counts(c) for c in answers.column("totals").to_pylist()]
        flat = np.concatenate(flat) if flat else np.zeros(0, np.int64)
        length, known, base, scores = _score_block(seq, grams(seq, order), flat, n_tokens, n_words)
        return pa.table({
            "doc_id": table.column("doc_id"), "held_out": pc.invert(table.column("train")),
            "n_tokens": pa.array(length, pa.int64()), "n_known": pa.array(known, pa.int64()),
            "train_tokens": pa.array(np.full(len(length), n_tokens), pa.int64()),
            "base_score": pa.array(base), "score": pa.array(scores),
        })

    kind = source.schema["doc_id"].dataType.simpleString()
    totals = (source.groupBy("block").applyInArrow(request, _REQUEST)
              .groupBy("shard").applyInArrow(answer, "block bigint, shard bigint, totals binary"))
    return source.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(
        finish, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                "base_score double, score double")
