"""Prefix trie, Merkle manifest and packing against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from postmill.llm import merkle_manifest, sequence_packing, turn_trie
from postmill.llm.queries import LLM_QUERIES

EMPTY = hashlib.sha256(b"").hexdigest()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- prefix trie

def rebuilt(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest(),
                             role or "", text or ""))
    own = {c: [x[3:] for x in sorted(t)] for c, t in turns.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return own, {c: own.get(c - c % 5, [])[:h[c]] + own[c][h[c]:] for c in own}


def trie(convs):
    members = defaultdict(list)
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out = {}
    for p in sorted(members, key=len, reverse=True):
        below = [out[k] for k in kids[p]]
        ends = ",".join(str(c) for c in sorted(members[p]) if len(convs[c]) == len(p))
        out[p] = (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below),
                  sum(b[5] for b in below) or 1,
                  sum(b[6] for b in below) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0), sha(ends))
    return sorted(out.values(), key=repr)


def nodes(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


CHATS = [(c, t, "user", f"turn {t if c % 3 else 0}") for c in range(60) for t in range(c % 11)]
CHATS += [(70, 1, None, None), (70, None, "a", "ü"), (70, 1, None, None), (None, 0, "x", "lost"), (71, 0, "", "a:b"), (73, 5, "x" * 9, "y" * 5000)]
CHATS += [(100 + c, t, "user", f"same {t}") for c in range(40) for t in range(12)] + [(900, t, "u", str(t)) for t in range(300)]


@pytest.mark.parametrize("container", [1, 25, 200, 8192])
def test_trie_against_brute_force(spark, container):
    rows = CHATS[:]
    random.Random(5).shuffle(rows)
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id bigint, turn int, role string, text string, depth int, seg int")
    own, mixed = rebuilt(rows)
    assert nodes(turn_trie.prefix_trie(*turn_trie.rebuilt(table), container)) == trie(mixed)
    assert nodes(turn_trie.prefix_trie(*turn_trie.whole(table), container)) == trie(own)


def test_trie_query(spark, data_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{data_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = LLM_QUERIES["op11_prefix_trie"](spark, data_dir)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert nodes(out) == trie(rebuilt(rows)[1])


def test_trie_of_nothing(spark):
    table = spark.createDataFrame([], "conv_id bigint, turn int, role string, text string")
    assert turn_trie.prefix_trie(*turn_trie.rebuilt(table)).collect() == []


# ---- Merkle manifest

def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels_of(digests):
    rows = [digests]
    while len(rows[-1]) > 1:
        rows.append([sha("".join(rows[-1][i:i + 16])) for i in range(0, len(rows[-1]), 16)])
    return rows


def proof(rows, i):
    out = []
    for row in rows[:-1]:
        low = i // 16 * 16
        out.append((i - low, row[low:i] + row[i + 1:low + 16]))
        i //= 16
    return out


def manifest(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows (doc_id, source, lang, n_chars, text)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    trees = defaultdict(list)
    for r in rows:
        trees[r[1]].append(((r[0] is not None, r[0] or 0), sha("".join(map(field, r))), r))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for s in order:
        trees[s].sort(key=lambda x: x[:2])
        built[s] = levels_of([x[1] for x in trees[s]])
    top = levels_of([built[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (_, leaf, r) in enumerate(trees[s]):
            steps = proof(built[s], i) + proof(top, k)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            now = sha("".join(map(field, (*r[:4], r[4] and r[4].translate(lower))))) if hit else leaf
            for at, others in steps:
                now = sha("".join([*others[:at], now, *others[at:]]))
            out.append((r[0], leaf, built[s][-1][0], top[-1][0], sha("".join(x for _, o in steps for x in o)), now, now == top[-1][0]))
    return sorted(out, key=repr)


MERKLE = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest_against_brute_force(spark, levels):
    rows = [(i, ["hot", None, "b", "ä", ""][0 if i % 3 else i % 5], "en", i, f"Text {i}" + "X" * (i % 7)) for i in range(700)]
    rows += [(1000 + i, f"s{i}", None, None, None) for i in range(40)] + [(None, "hot", "en", 1, "No id"), (3, "hot", "en", 3, ""), (3, "hot", "en", 3, ""),
                                                                         (9000, "long", "x", 5, "Aß" * 300_000)]
    random.Random(2).shuffle(rows)
    docs = spark.createDataFrame([(r[0], r[1], r[2], r[3], r[4], 1, "q") for r in rows],
                                 "doc_id bigint, source string, lang string, n_chars bigint, text string, place int, Tree string")
    out = merkle_manifest.report(docs, levels=levels)
    assert out.columns == MERKLE and sorted(map(tuple, out.collect()), key=repr) == manifest(rows)


@pytest.mark.parametrize("rows", [[], [(1, "a", "en", 2, "Hi")], [(i, None, "en", 2, "Hi") for i in range(17)],
                                  [(i, f"s{i}", "en", 2, "Hi") for i in range(17)]])
def test_small_manifests(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert sorted(map(tuple, merkle_manifest.report(docs).collect()), key=repr) == manifest(rows)


def test_manifest_query(spark, data_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{data_dir}/documents.parquet").select(*merkle_manifest.FIELDS).collect()]
    got = sorted(map(tuple, LLM_QUERIES["op12_merkle_manifest"](spark, data_dir).collect()), key=repr)
    assert got == manifest(rows) and {r[-1] for r in got} == {True, False}


# ---- packing

def encoder():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(sequence_packing.public_file())
    return lambda text: [*whole.encode(text or "", add_special_tokens=False).ids, 2]


def check_packing(pieces, rows, length, most_padding=0.02):
    """``pieces`` as report() gives them; every token once, sequences without gaps."""
    encode = encoder()
    wanted = defaultdict(int)
    for doc_id, text in rows:
        wanted[doc_id, tuple(encode(text))] += 1
    ids = {doc_id: key for doc_id, key in wanted}
    assert all(n == 1 for n in wanted.values())
    cover, filled = defaultdict(list), defaultdict(list)
    for r in pieces:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.length > 0
        part = own[r.start:r.start + r.length]
        assert zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)) == r.ids_crc32
        cover[r.doc_id].append((r.start, r.length))
        filled[r.sequence_id].append((r.offset, r.length))
    for doc_id, own in ids.items():
        at = 0
        for start, n in sorted(cover[doc_id]):
            assert start == at
            at += n
        assert at == len(own)
    padding = 0
    for parts in filled.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    assert padding <= most_padding * sum(len(x) for x in ids.values())


ODD_TEXTS = [None, "", " ", "Hello,  WORLD!", "it's we'll I'd.", "a\0b \0 c", "<|endoftext|> x <|STARTOFTEXT|>", "H̱ T̈ é É", "İstanbul ΟΔΟΣ ς.",
             "12345 ½ ²", "a b c\x0bd\x0ce\x1cf", "“x”. y…. ,a", "中文字 テスト", "😀😀 x", "x." * 50, "a,b;c d'.", "K Å K", "w" * 70, "﻿ x"]


def test_words_equal_the_tokenizer():
    encode = encoder()
    with open(sequence_packing.public_file(), "rb") as f:
        words = sequence_packing.Words(f.read())
    assert words.split and words.folds
    texts = [t or "" for t in ODD_TEXTS] + ["Ab cd.\n" * 400_000] + [t * 3 for t in ODD_TEXTS if t] + [" ".join(t for t in ODD_TEXTS if t)]
    for _ in range(2):
        for t, codes in zip(texts, words.encode([t.encode() for t in texts])):
            assert [int.from_bytes(codes[i:i + 2], "little") for i in range(0, len(codes), 2)] == encode(t)[:-1], t[:50]


def test_first_fit():
    rng = random.Random(1)
    for n in (0, 1, 7, 300):
        sizes = sorted((rng.randint(1, 100) for _ in range(n)), reverse=True)
        free, slow = [100] * n, []
        for s in sizes:
            slow.append(next(i for i, f in enumerate(free) if f >= s))
            free[slow[-1]] -= s
        assert sequence_packing.first_fit(sizes, 100) == slow


@pytest.mark.parametrize("group_bytes, slack", [(16 << 20, 32), (3000, 0)])
def test_packing_small(spark, group_bytes, slack):
    rng = random.Random(4)
    texts = [*ODD_TEXTS, "ab cd ef, " * 30_000, *[" ".join(rng.choice(["one", "two", "Drei", "vier."]) for _ in range(rng.randint(0, 90))) for _ in range(300)]]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, start int, codes int")
    out = sequence_packing.report(docs, length=64, group_bytes=group_bytes, slack=slack)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check_packing(out.collect(), rows, 64, 0.0 if not slack else 0.3)
    assert sequence_packing.report(docs.where("false")).collect() == []


def test_packing_repeated_rows_and_sequences(spark):
    docs = spark.createDataFrame([(1, "same words here"), (1, "same words here"), (None, "x y"), (None, None)], "doc_id int, text string")
    pieces = sequence_packing.pack(docs, length=8, slack=0).collect()
    encode = encoder()
    assert sum(r.length for r in pieces) == 2 * len(encode("same words here")) + len(encode("x y")) + 1
    made = sequence_packing.sequences(sequence_packing.pack(docs, length=8, slack=7), 8, 9).collect()
    assert all(len(r.ids) == 4 * (r.n_tokens if r.n_tokens & (r.n_tokens - 1) == 0 else 8) for r in made)


def test_packing_query(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text")
    check_packing(LLM_QUERIES["op13_packing"](spark, data_dir).collect(), [tuple(r) for r in docs.collect()], 4096)
    assert sequence_packing.pack(docs).agg(F.sum("length") == F.sum(F.length("ids") / 4)).first()[0]
