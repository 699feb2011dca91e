"""SentencePiece encoding and decoding with a weighted finite-state transducer.

The model file is compiled into states and arcs: the normaliser (a blank mark in front of the text and for every blank), the pieces
as a tree of states whose arcs read characters and whose last arc writes a piece, and byte fallback for characters
that no piece has. An input is composed with it place by place, and the path of least weight in the tropical semiring is its
encoding. A unigram model weighs each piece by its negative score. A BPE model weighs each pair of successive
pieces: zero if merging their text would leave them side by side, infinite if not; one path has a finite weight.
"""

from __future__ import annotations

import math
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from postmill.llm.common import bounded_batches, fresh

#: Where the public tokenizer files are installed; a parameter of every function that needs one.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
_BLANK = "▁"
#: Encodings of parts that a worker remembers, in each of two generations, and weights of pairs.
_REMEMBERED = 3 << 16
#: Characters of the longest part that is remembered.
_LONGEST = 24
# Bits of a code point (also enough for pieces and characters together); kinds of pieces and models in the file format.
_CHARACTER_BITS = 21
_NORMAL, _UNKNOWN, _USER, _BYTE = 1, 2, 4, 6
_UNIGRAM, _BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or number()
            yield tag >> 3, data[at:at + size]
            at += size


class Transducer:
    """Encoder and decoder compiled from the bytes of a model file."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        kinds: list[int] = []
        trainer, normaliser = {3: _UNIGRAM}, {3: 1, 4: 1, 5: 1}
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, _NORMAL))
            elif field == 2:
                trainer |= dict(_fields(value))
            elif field == 3:
                normaliser |= dict(_fields(value))
        if normaliser.get(2) or normaliser[4] or not normaliser[5] or trainer.get(24) or _USER in kinds:
            raise ValueError("only identity normalisers without user-defined pieces are compiled")
        self.merging = trainer[3] == _BPE
        if not self.merging and trainer[3] != _UNIGRAM:
            raise ValueError("only BPE and unigram models are compiled")
        self.prefix = _BLANK if normaliser[3] else ""
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == _NORMAL}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == _BYTE}
        self.unknown = kinds.index(_UNKNOWN)
        #: What a piece stands for when decoded; special pieces stand for nothing.
        self.spelled = [
            p.replace(_BLANK, " ").encode() if k == _NORMAL else bytes([int(p[3:5], 16)]) if k == _BYTE
            else " ⁇ ".encode() if k == _UNKNOWN else b"" for p, k in zip(self.pieces, kinds)
        ]
        # A state is its arcs by character, and the piece that is complete in it or -1.
        self.root: list = [{}, -1]
        for piece, i in self.ids.items():
            state = self.root
            for c in piece:
                state = state[0].setdefault(c, [{}, -1])
            state[1] = i
        self.least = min((self.scores[i] for i in self.ids.values()), default=0.0)
        # Where no piece holds a blank mark after another character, paths through such a place are independent.
        crossing = re.compile(f"[^{_BLANK}]{_BLANK}")
        self.parts = None if any(crossing.search(p) for p in self.ids) else re.compile(f"{_BLANK}+[^{_BLANK}]*|[^{_BLANK}]+")
        self.pairs: dict[int, bool] = {}
        self.seen: dict[str, bytes] = {}
        self.seen_before: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """Best-scored neighbours first, leftmost among equals; only used on texts of two pieces."""
        symbols = list(text)
        while True:
            best = None
            for i in range(len(symbols) - 1):
                piece = self.ids.get(symbols[i] + symbols[i + 1])
                if piece is not None and (best is None or self.scores[piece] > best[0]):
                    best = (self.scores[piece], i)
            if best is None:
                return symbols
            i = best[1]
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]

    def _spelling(self, i: int) -> str:
        return self.pieces[i] if i < len(self.pieces) else chr(i - len(self.pieces))

    def _side_by_side(self, last: int, piece: int) -> bool:
        """Whether the weight on two successive pieces of a merging model is finite; -1 stands before the first piece."""
        if len(self.pairs) >= _REMEMBERED:
            self.pairs.clear()
        b = self._spelling(piece)
        a = self._spelling(last) if last >= 0 else ""
        found = self.pairs[last << _CHARACTER_BITS | piece] = self.merged(a + b) == ([a, b] if a else [b])
        return found

    def _arcs_from(self, text: str, at: int) -> list[tuple[int, int]]:
        """Composition with the input at one place: (end, piece) of each arc path that writes a piece, shortest first.

        A character without a piece is a piece by itself, numbered the number of pieces plus its code point.
        """
        state = self.root[0].get(text[at])
        if state is None:
            return [(at + 1, len(self.pieces) + ord(text[at]))]
        arcs, piece = state
        found = [(at + 1, piece if piece >= 0 else len(self.pieces) + ord(text[at]))]
        for end in range(at + 1, len(text)):
            state = arcs.get(text[end])
            if state is None:
                break
            arcs, piece = state
            if piece >= 0:
                found.append((end + 1, piece))
        return found

    def shortest_path(self, text: str) -> list[int]:
        """Pieces of the path of least weight in the tropical semiring."""
        return self._zero_path(text) if self.merging else self._relaxed_path(text)

    def _zero_path(self, text: str) -> list[int]:
        """With weights of zero and infinity: the first path found is the shortest, so that a stack serves as the queue.

        The longest arcs are followed first. A place is reached by at most one last piece with a finite weight, so what has failed there is
        not tried again.
        """
        path: list[int] = []
        ends, at, n = [], 0, len(text)
        open_arcs = [self._arcs_from(text, 0)] if n else []
        failed: set[tuple[int, int]] = set()
        known = self.pairs
        while at < n:
            before = path[-1] if path else -1
            arcs = open_arcs[-1]
            while arcs:
                arc = arcs.pop()
                fits = known.get(before << _CHARACTER_BITS | arc[1])
                if fits is None:
                    fits = self._side_by_side(before, arc[1])
                if fits and (not failed or arc not in failed):
                    ends.append(at)
                    path.append(arc[1])
                    at = arc[0]
                    if at < n:
                        open_arcs.append(self._arcs_from(text, at))
                    break
            else:
                if not path:
                    raise ValueError("no finite path: the scores of this model do not order its merges")
                open_arcs.pop()
                failed.add((at, path.pop()))
                at = ends.pop()
        return path

    def _relaxed_path(self, text: str) -> list[int]:
        """With weights of single pieces: places in order, each arc relaxing the place where it ends."""
        n, scores, unknown = len(text), self.scores, 10.0 - self.least
        best: list[tuple[float, int, int]] = [(0.0, -1, 0)] + [(math.inf, -1, 0)] * n
        for at in range(n):
            for end, piece in self._arcs_from(text, at):
                weight = best[at][0] + (unknown if piece >= len(scores) else -scores[piece])
                if weight < best[end][0]:
                    best[end] = (weight, piece, at)
        path, at = [], n
        while at:
            path.append(best[at][1])
            at = best[at][2]
        return path[::-1]

    def _part(self, text: str) -> bytes:
        """Piece numbers of the text between blanks: from the older memory, or by its shortest path."""
        cell = self.seen_before.get(text)
        if cell is None:
            ids: list[int] = []
            for i in self.shortest_path(text):
                if i < len(self.pieces):
                    ids.append(i)
                else:
                    ids += [self.bytes.get(b, self.unknown) for b in self._spelling(i).encode()] if self.bytes else [self.unknown]
            cell = array("i", ids).tobytes()
        return cell

    def encode(self, text: str) -> np.ndarray:
        """Piece numbers of a whole text."""
        if not text:
            return np.zeros(0, "<i4")
        text = self.prefix + text.replace(" ", _BLANK)
        if len(self.seen) >= _REMEMBERED:
            self.seen_before, self.seen = self.seen, {}
        seen = self.seen
        parts = self.parts.findall(text) if self.parts else [text]
        new = set(parts).difference(seen)
        for p in new:
            seen[p] = self._part(p)
        cells = b"".join(map(seen.__getitem__, parts))
        for p in [p for p in new if len(p) > _LONGEST]:
            del seen[p]
        return np.frombuffer(cells, "<i4")

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.spelled.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


@lru_cache(maxsize=2)
def compiled(model: bytes) -> Transducer:
    """One transducer per worker process, so that tasks share what it remembers."""
    return Transducer(model)


def encode(docs: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """All columns of the input and piece_ids (array of int), n_pieces (bigint), round_trip (boolean).

    round_trip tells whether decoding the numbers gives the text back, with blank marks in the text read as the
    blanks they are normalised to. Null and empty texts have no pieces and count as a round trip. Whole texts are
    encoded, whatever their length; rows are independent, so repeated ones are encoded alike. New columns whose
    names the input has already get underscores behind them.
    """
    bounded_batches(docs.sparkSession)
    with open(model_file, "rb") as f:  # on the driver; the compiled machines are built where they are used
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    added = [fresh(docs, n) for n in ("piece_ids", "n_pieces", "round_trip")]
    text = next(c for c in docs.columns if c.lower() == "text")
    kinds = (T.ArrayType(T.IntegerType()), T.LongType(), T.BooleanType())
    schema = T.StructType([*docs.schema.fields, *map(T.StructField, added, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(model.value)
        for batch in batches:
            ids, same = [], []
            for t in batch.column(text).to_pylist():
                codes = machine.encode(t or "")
                ids.append(codes)
                same.append(machine.decode(codes) == (t or "").replace(_BLANK, " "))
            lengths = np.array([len(x) for x in ids], np.int64)
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, "<i4")
            cells = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, cells, pa.array(lengths), pa.array(same, pa.bool_())], names=schema.names)

    return docs.mapInArrow(run, schema)
