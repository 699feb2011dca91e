"""Packing of documents into sequences: first-fit decreasing with a tournament tree, in randomised groups of documents.

A document's tokens that fill sequences by themselves become such sequences; what is left of it goes to a group chosen by a
hash. Within a group the rests are taken longest first, and a tournament tree of the bins' free places finds the
first bin that holds each. The few bins that stay loose at the end of a group are joined and cut again, the very last rest at powers of two.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from postmill.llm.common import bounded_batches, text_bytes

LENGTH = 4096
END_ID = 2
#: Bytes of text whose rests form a group, on average; and how many times that a task holds before it packs what it has.
GROUP_BYTES = 16 << 20
_OVERFULL = 4
#: Free places up to which a bin is left as it is.
SLACK = 32
#: Words that a worker remembers, in each of two generations; longer ones than so many bytes are not kept.
_REMEMBERED, _WORD_BYTES = 1 << 18, 48
_SLICE = 1 << 20
_ROWS = 512


def public_file(name: str = "word_bpe_49k.json") -> str:
    """The place of an installed tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Words:
    """Token numbers of texts by a tokenizer that never joins what white space parts, remembered word by word.

    Words are looked up without regard to the case of A-Z, which the tokenizer lower-cases, unless a text has combining marks (they
    may compose with lower-case letters only) or the beginning of a special token. Unknown words of a batch are encoded in one call.
    """

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(file)
        probe = lambda s: self.tokenizer.encode(s, add_special_tokens=False).ids
        self.mark = probe("\0")
        self.split = len(self.mark) == 1 and probe("ab") + self.mark + probe("c,") + self.mark == probe("ab \0\tc,\n\0")
        self.folds = probe("AB") == probe("ab")
        self.letters = all(probe(w) == [t.id for t in self.tokenizer.model.tokenize(w)] for w in ("a", "letters", "xqzjy", "unbelievably"))
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _learn(self, words: set[bytes]) -> None:
        """Numbers of the words that are not in ``new``: from the older generation, or from the tokenizer."""
        new, old = self.new, self.old
        unknown = words.difference(old)
        known = words.difference(unknown)
        new.update(zip(known, map(old.__getitem__, known)))
        asked, odd, built = set(), [], []
        for w in unknown:
            if b"\0" in w:
                odd.append(w)
            elif w[-1:] in b".,;:!?" and 97 <= w[-2:][0] <= 122:  # a mark behind a letter is a token by itself
                built.append(w)
            else:
                asked.add(w)
        for w in built:
            for p in (w[:-1], w[-1:]):
                if p not in new:
                    if p in old:
                        new[p] = old[p]
                    else:
                        asked.add(p)
        for w in odd:
            new[w] = self._whole(w.decode())
        if self.letters:
            tokenize = self.tokenizer.model.tokenize
            plain = [w for w in asked if w.islower() and w.isalpha()]  # of bytes: a-z only
            for w in plain:
                new[w] = np.array([t.id for t in tokenize(w.decode())], self.kind).tobytes()
            asked.difference_update(plain)
        asked = list(asked)
        for low in range(0, len(asked), 4096):
            block = asked[low:low + 4096]
            joined = (b" \0 ".join(block) + b" \0").decode()
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(ids == self.mark[0])
            if len(ends) != len(block):  # a word encodes to the mark: one by one
                for w in block:
                    new[w] = self._whole(w.decode())
                continue
            data, size, start = ids.tobytes(), self.kind.itemsize, 0
            for w, end in zip(block, ends.tolist()):
                new[w] = data[start * size:end * size]
                start = end + 1
        for w in built:
            new[w] = new[w[:-1]] + new[w[-1:]]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Token numbers of whole UTF-8 texts, as bytes of ``kind``; long texts are taken in slices that end in white space."""
        if not self.split:
            return [self._whole(t.decode()) for t in texts]
        out: list[bytes] = []
        words: list[list[bytes]] = []
        waiting = 0
        for data in texts:
            plain = self.folds and not (b"<|" in data or b"\xcc" in data or b"\xcd" in data)
            if len(data) > _SLICE:
                out += self._spelled(words)
                words, waiting = [], 0
                out.append(b"".join(c for s in _slices(data) for c in self._spelled([(s.lower() if plain else s).split()])))
                continue
            words.append((data.lower() if plain else data).split())
            waiting += len(data)
            if waiting > _SLICE:
                out += self._spelled(words)
                words, waiting = [], 0
        return out + self._spelled(words)

    def _spelled(self, texts: list[list[bytes]]) -> list[bytes]:
        if len(self.new) > _REMEMBERED:
            self.old, self.new = self.new, {}
        new = self.new
        missing = set().union(*texts).difference(new)
        if missing:
            self._learn(missing)
        out = [b"".join(map(new.__getitem__, words)) for words in texts]
        for w in [w for w in missing if len(w) > _WORD_BYTES]:
            del new[w]
        return out


def _slices(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        end = at + _SLICE
        blanks = [i for i in (data.find(c, end) for c in (b" ", b"\n", b"\t", b"\r")) if i >= 0]
        end = min(blanks) if blanks else len(data)
        yield data[at:end]
        at = end


@lru_cache(maxsize=1)
def _words(file: bytes) -> Words:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Words(file)


def first_fit(sizes: list[int], capacity: int) -> list[int]:
    """The number of the first bin with room for each size, in the order given.

    ``tree`` is a tournament: each inner node holds the larger free place of its two children, leaves are the bins.
    """
    leaves = 1
    while leaves < max(len(sizes), 1):
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    bins = []
    for size in sizes:
        at = 1
        while at < leaves:
            at *= 2
            if tree[at] < size:
                at += 1
        bins.append(at - leaves)
        tree[at] -= size
        while at > 1:
            at //= 2
            most = max(tree[2 * at], tree[2 * at + 1])
            if tree[at] == most:
                break
            tree[at] = most
    return bins


def _is_power(n: int) -> bool:
    return n & (n - 1) == 0


def sequences_of(rests: list[tuple], length: int, slack: int) -> Iterator[list[tuple]]:
    """Sequences of one group: lists of (piece, from, to), piece being a place in ``rests``, whose first field is a size.

    ``rests`` are sorted, longest first. Every token of them lies in exactly one sequence.
    """
    bins: dict[int, list[int]] = {}
    for i, b in enumerate(first_fit([r[0] for r in rests], length)):
        bins.setdefault(b, []).append(i)
    loose = []
    for members in bins.values():
        filled = sum(rests[i][0] for i in members)
        if length - filled <= slack or _is_power(filled):
            yield [(i, 0, rests[i][0]) for i in members]
        else:
            loose += members
    left = sum(rests[i][0] for i in loose)
    now: list[tuple] = []
    room = 0
    for i in loose:
        at = 0
        while at < rests[i][0]:
            if not room:
                if now:
                    yield now
                now, room = [], length if left >= length else 1 << (left.bit_length() - 1)
                left -= room
            take = min(room, rests[i][0] - at)
            now.append((i, at, at + take))
            at, room = at + take, room - take
    if now:
        yield now


def pack(docs: DataFrame, tokenizer_file: str | None = None, length: int = LENGTH, end_id: int = END_ID,
         group_bytes: int = GROUP_BYTES, slack: int = SLACK, seed: int = 0) -> DataFrame:
    """Rows (doc_id, start, length, doc_tokens, sequence_id, offset, ids), one per piece of a document.

    A document is its token numbers and ``end_id``; ``start`` of them lie before the piece, ``ids`` holds the piece's numbers as
    little-endian 32-bit integers, and the piece lies ``offset`` tokens from the beginning of its sequence. Sequences
    hold at most ``length`` tokens, a power of two. They are whole, or up to ``slack`` short, or hold a power of two, but none is shorter otherwise.
    Null and empty texts consist of ``end_id``. Rows are packed one by one, so repeated rows and rows that share a doc_id (null
    too) each have pieces of their own; other columns are ignored. Groups are chosen by a hash of id and tokens, so they
    depend on no splits of the input, and a hot group is packed in parts.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer_file or public_file(), "rb") as f:  # on the driver
        file = spark.sparkContext.broadcast(f.read())
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = source.schema["doc_id"].dataType
    groups = max(1, -(-text_bytes(docs) // group_bytes))
    fields = [T.StructField("doc_id", id_type), *[T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens")]]
    cut_schema = T.StructType([*fields, T.StructField("codes", T.BinaryType()), T.StructField("width", T.IntegerType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(file.value)
        size = words.kind.itemsize
        last = np.array([end_id], words.kind).tobytes()
        for batch in batches:
            kind = batch.column("doc_id").type
            rows: list[tuple] = []
            for doc_id, codes in zip(batch.column("doc_id").to_pylist(), words.encode(batch.column("text").cast(pa.binary()).to_pylist())):
                codes += last
                total = len(codes) // size
                for start in range(0, total, length):
                    rows.append((doc_id, start, min(length, total - start), total, codes[start * size:(start + length) * size]))
                    if len(rows) == _ROWS:
                        yield _cut_batch(rows, kind, size, cut_schema.names)
                        rows = []
            if rows:
                yield _cut_batch(rows, kind, size, cut_schema.names)

    pieces = source.mapInArrow(cut, cut_schema).withColumn(
        "group", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", F.crc32("codes"), "doc_tokens"), F.lit(groups)))
    out_names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    out_schema = T.StructType([*fields, *[T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")],
                               T.StructField("ids", T.BinaryType())])
    most = _OVERFULL * group_bytes

    def fill(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = key[0].as_py() << 32
        rests: list[tuple] = []
        held = 0
        for batch in batches:
            kind = batch.column("doc_id").type
            for row in zip(*(batch.column(n).to_pylist() for n in ("length", "doc_id", "start", "doc_tokens", "codes", "width"))):
                rests.append(row)
                held += len(row[4]) + 256
            if held > most:
                for rows, number in _filled(rests, number):
                    yield _out_batch(rows, kind)
                rests, held = [], 0
        for rows, number in _filled(rests, number):
            yield _out_batch(rows, kind)

    def _filled(rests: list[tuple], number: int) -> Iterator[tuple[list[tuple], int]]:
        """Rows of the pieces in blocks, and the next sequence number."""
        rests.sort(key=lambda r: (-r[0], r[1] is not None, r[1] if r[1] is not None else 0, r[2], r[4]))
        rows: list[tuple] = []
        for sequence in sequences_of(rests, length, slack):
            offset = 0
            for i, low, high in sequence:
                _, doc_id, start, total, codes, width = rests[i]
                ids = np.frombuffer(codes, f"<u{width}")[low:high].astype("<u4").tobytes()
                rows.append((doc_id, start + low, high - low, total, number, offset, ids))
                offset += high - low
            number += 1
            if len(rows) >= _ROWS:
                yield rows, number
                rows = []
        yield rows, number

    def _out_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        kinds = [kind, *[pa.int64()] * 5, pa.binary()]
        columns = list(zip(*rows)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=out_names)

    return pieces.groupBy("group").applyInArrow(fill, out_schema)


def _cut_batch(rows: list[tuple], kind: pa.DataType, width: int, names: list[str]) -> pa.RecordBatch:
    kinds = [kind, *[pa.int64()] * 3, pa.binary()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([width] * len(rows), pa.int32())], names=names)


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """Rows (sequence_id, n_tokens, n_pieces, ids) of the output of ``pack``: what a trainer reads, padded unless n_tokens is a power of two."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.count("*").alias("n_pieces"), parts.alias("parts"))
    ids = F.expr("aggregate(parts, X'', (a, p) -> concat(a, p.ids))")
    pad = F.lit(int(pad_id).to_bytes(4, "little"))
    return joined.select("sequence_id", "n_tokens", "n_pieces", F.when(F.bit_count("n_tokens") == 1, ids).otherwise(
        F.rpad(ids, F.lit(4 * length), pad)).alias("ids"))


def report(docs: DataFrame, **options) -> DataFrame:
    """The pieces with a checksum of their token numbers in place of the numbers; see ``pack``."""
    return pack(docs, **options).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
