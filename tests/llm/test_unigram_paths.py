"""The transducer of a unigram model against the public library; the model file is written by hand."""

import random
import struct

import sentencepiece

from postmill.llm import piece_fst


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def part(number, data):
    return varint(number << 3 | 2) + varint(len(data)) + data


def model(pieces):
    """Bytes of a unigram model that leaves white space as it is; pieces are (text, score), and three special ones lead."""
    out = b""
    for i, (text, score) in enumerate([("<unk>", 0.0), ("<s>", 0.0), ("</s>", 0.0), *pieces]):
        kind = (2, 3, 3)[i] if i < 3 else 1
        out += part(1, part(1, text.encode()) + b"\x15" + struct.pack("<f", score) + b"\x18" + varint(kind))
    out += part(2, b"\x18\x01")
    return out + part(3, part(1, b"identity") + b"\x18\x01\x20\x00\x28\x01")


def test_unigram_paths_equal_the_library():
    rng = random.Random(8)
    letters = "abcdé▁"
    spelled = {*letters, *("".join(rng.choice(letters) for _ in range(rng.randint(2, 4))) for _ in range(60))}
    data = model([(p, -rng.uniform(1, 9) * len(p) ** 0.5) for p in sorted(spelled) if "▁" not in p[1:]])
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    machine = piece_fst.Transducer(data)
    assert not machine.merging
    for _ in range(400):
        text = "".join(rng.choice("abcdé abcdé x") for _ in range(rng.randint(0, 60)))
        got = machine.encode(text).tolist()
        assert _once(got) == library.encode(text), text


def _once(ids):
    """The library writes one unknown piece for successive unknown characters."""
    return [i for k, i in enumerate(ids) if i != 0 or k == 0 or ids[k - 1] != 0]


def test_arcs_spell_the_pieces():
    with open(piece_fst.MODEL_FILE, "rb") as f:
        machine = piece_fst.Transducer(f.read())
    for piece in ("▁the", "ing", "é"):
        assert machine._arcs_from(piece, 0)[-1] == (len(piece), machine.ids[piece])
    assert machine.shortest_path("") == []
