"""Corpus operators on documents: brute force on small frames, and the cases every operator must bear.

The odd frame holds null and empty texts, a long text, ties, a repeated row, null ids and columns with the operators' own names.
"""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from postmill.llm import backoff_lm, decontam_templates, line_windows, nbsvm, pii_boosting, piece_fst, simhash_mih
from postmill.llm.components import components

ODD = "doc_id bigint, text string, block int, fp string, lines_removed int, piece_ids string, h int, Score double"
LONG = "word " * 3000 + "x" * 5000
ODD_ROWS = [(1, "One two three. Four five six seven.", LONG), (2, None, ""), (3, "", ""), (3, "", ""), (None, "alone here", "a"),
            (5, " \t\n ", "b"), (6, LONG, "c"), (7, "One two three. Four five six seven.", "d"), (None, None, "e")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, 1, c, 2, c, 3, 0.5) for i, t, c in ODD_ROWS], ODD)


@pytest.fixture(scope="module")
def documents(spark, data_dir):
    return spark.read.parquet(f"{data_dir}/documents.parquet").cache()


def texts_of(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


def words(text):
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))


# --- SimHash ----------------------------------------------------------------------------


def brute_fingerprint(text, k=4):
    w = words(text)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closest_roots(prints, radius):
    root = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    return root


def test_near_duplicates_equal_brute_force(documents):
    texts = texts_of(documents)
    ids = sorted(texts)
    prints = [brute_fingerprint(texts[i]) for i in ids]
    roots = closest_roots(prints, 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_mih.near_duplicates(documents).collect()}
    assert got == {i: (f"{p:016x}", ids[r]) for i, p, r in zip(ids, prints, roots)}


@pytest.mark.parametrize("count, bucket, radius", [(3, 256, 4), (2, 256, 4), (3, 2, 4), (3, 2, 3)])
def test_links_connect_all_within_the_radius(spark, count, bucket, radius):
    """With tiny buckets most links go through common points."""
    rng = random.Random(count + bucket)
    prints = [rng.getrandbits(64) for _ in range(30)]
    for _ in range(90):
        prints.append(rng.choice(prints) ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5]))))
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    made = simhash_mih.links(frame, radius, count, bucket)
    root = dict(zip(signed, signed)) | {r.node: r.root for r in components(made).collect()}
    expected = closest_roots(prints, radius)
    for i in range(len(prints)):
        for j in range(i):
            assert (root[signed[i]] == root[signed[j]]) == (expected[i] == expected[j])


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 90, 90: 90, 95: 90, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_near_duplicates_odd(odd):
    got = sorted((r.doc_id or -1, r.fingerprint, r.component_id) for r in simhash_mih.near_duplicates(odd).collect())
    assert len(got) == 9
    by_id = {i: (f, c) for i, f, c in got}
    assert by_id[2] == by_id[3] == by_id[5] == ("0" * 16, 2) and by_id[1] == by_id[7] and by_id[7][1] == 1
    assert {c for i, f, c in got if i == -1} == {None, 2}
    assert simhash_mih.near_duplicates(odd.where("false")).collect() == []


# --- language model ---------------------------------------------------------------------


def test_language_model_equals_brute_force(documents):
    texts = texts_of(documents)
    tokens = {i: [*words(t), "</s>"] for i, t in texts.items()}
    train = [i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2]
    one = Counter(w for i in train for w in tokens[i])
    n, v = sum(one.values()), len(one)
    pairs = Counter(p for i in train for p in zip(["<s>", *tokens[i]], tokens[i]))
    context = one | Counter({"<s>": len(train)})

    def log10p(previous, w):
        base = (one[w] + 1) / (n + v + 1)
        c = context[previous]
        mass = backoff_lm.SCALE * c**backoff_lm.POWER
        return math.log10((pairs[previous, w] + mass * base) / (c + mass) if c else base)

    for r in backoff_lm.score(documents, block_bytes=1 << 16, shard_bytes=1 << 16).collect():
        t = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(one[w] > 0 for w in t), n)
        assert r.held_out == (r.doc_id not in train)
        assert r.base_score == pytest.approx(sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
        assert r.score == pytest.approx(sum(map(log10p, ["<s>", *t], t)), rel=1e-9)


def test_automaton_weights_sum_to_one(spark):
    """Over all known tokens and one unknown, in every context, for n-grams up to three."""
    import pyarrow as pa

    texts = ["a b c a b", "a b b c", "c c a b a", "b a c", "a b c zz"]
    seq = backoff_lm.tokens(pa.array([*texts, "unseen"]))
    levels = backoff_lm.grams(seq, 3)
    weight = np.repeat(np.array([1, 1, 1, 1, 1, 0]), seq.lengths)
    totals = [np.bincount(g.at[g.at >= 0], weight[g.at >= 0], minlength=len(g.keys)).astype(int) for g in levels]
    n_words = int((totals[0] > 0).sum()) - 1
    model = backoff_lm.Automaton(seq, levels, totals, int(weight.sum()) - 5, n_words)
    known = [s for s in range(model.width) if s != seq.start and not math.isnan(model.root_weight[s])]
    last = [None, *(seq.symbols[p] for g in levels[:2] for p in g.first.tolist())]
    for state in range(len(model.backoff)):
        if last[state] == model.width - 1:
            continue  # nothing follows an end mark
        reached = 0.0
        for s in known:
            model.begin = state
            reached += 10 ** model.walk([s])
        assert reached == pytest.approx(1.0, rel=1e-9), state


def test_language_model_odd(odd):
    got = backoff_lm.score(odd).collect()
    assert len(got) == 9 and all(r.score <= 0 and r.n_known <= r.n_tokens for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (2, 3, 5)} == {1}
    assert backoff_lm.score(odd.where("false")).collect() == []
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2][:1]
    alone = backoff_lm.score(odd.where("doc_id = 1").withColumn("doc_id", F.lit(held[0]))).first()
    assert alone.train_tokens == 0 and alone.n_known == 0 and alone.score == alone.base_score == 0.0


# --- personal data ----------------------------------------------------------------------


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def strict_spans(text):
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]
    kinds = pii_boosting.KINDS
    return [f"{k}:{a}:{b}" for a, i, b, k in sorted((m.start(), kinds.index(k), m.end(), k) for k, m in found)]


PRIVATE = [
    "a@b.c_d@e.f.g, x.y+z@host-1.example.com.", "1.2.3.4.5.6.7.8 and 256.1.1.1 and 010.000.1.255 or 99999999999.1.1.1",
    "é😀 4111 1111-1111 1111 then 4111111111111112", "+1 (499) 555-0103 and +44 20 7946 0958. +123", "1" * 70 + " " + "4" * 9,
    "+1 (499) 555-0103 4111111111111111 tail", "write to ann (at) example.org or call (212) 555-0147", "@@@@ ++++ 1-2-3 - 4",
    "5 " * 700 + "4111111111111111", "q." * 4000 + "@example.com", "no private data at all. She was at home. Later.", "", None,
]


def test_personal_data(spark):
    rows = [(i, t) for i, t in enumerate(PRIVATE)]
    got = {r.doc_id: r for r in pii_boosting.report(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    for i, t in rows:
        base = strict_spans(t or "")
        assert got[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), (i, base)
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [
            sum(s.startswith(k) for s in base) for k in pii_boosting.KINDS]
        assert set(base) <= set(got[i].spans.split(",")) | {""}
    assert {"phone:0:17", "card:18:34"} <= set(got[5].spans.split(","))
    assert any(s.startswith("email:9:") for s in got[6].spans.split(",")) and "phone" in got[6].spans
    assert got[10].spans == got[11].spans == got[12].spans == ""
    clean = {r.doc_id: r.text for r in pii_boosting.redacted(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert clean[5] == "[phone] [card] tail" and clean[10] == PRIVATE[10]


def test_personal_data_odd(odd):
    got = pii_boosting.report(odd).collect()
    assert len(got) == 9 and all(r.spans == "" for r in got)
    assert pii_boosting.report(odd.where("false")).collect() == []


# --- pieces -----------------------------------------------------------------------------


def test_pieces_equal_the_library(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=piece_fst.MODEL_FILE)
    rng = random.Random(5)
    texts = [r.text for r in documents.select("text").collect()]
    texts += ["".join(rng.choice(" \n\tabcdethinsé日😀ｆ.,!019  ") for _ in range(rng.randrange(80))) for _ in range(300)]
    texts += [" " * n + "a" + " " * n for n in range(40)] + ["x" * 400, "=-" * 300, "▁ a▁"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in piece_fst.encode(frame).collect():
        assert r.piece_ids == library.encode(texts[r.doc_id]) and r.n_pieces == len(r.piece_ids) and r.round_trip


def test_pieces_odd(odd):
    out = piece_fst.encode(odd)
    assert out.columns == [*odd.columns, "piece_ids_", "n_pieces", "round_trip"]
    got = out.collect()
    assert len(got) == 9 and all(r.round_trip for r in got)
    assert [r.n_pieces for r in got if not r.text] == [0, 0, 0, 0]
    assert piece_fst.encode(odd.where("false")).collect() == []


# --- lines ------------------------------------------------------------------------------


def brute_lines(docs, window=3, long_line=50):
    seen, out = set(), {}
    for doc_id in sorted(docs):
        lines = docs[doc_id].split("\n")
        full = [(i, " ".join(re.split(r"[ \t\r\f\v]+", x)).strip()) for i, x in enumerate(lines)]
        full = [(i, x) for i, x in full if x]
        size = min(window, len(full))
        marks = set()
        keyed = [((size, *(x for _, x in full[j:j + size])), full[j][0], full[j + size - 1][0])
                 for j in range(len(full) - size + 1)] if size else []
        keyed += [((-1, x), i, i) for i, x in full if len(x) > 2 * long_line and len(x.split(" ")) > long_line]
        for key, a, b in sorted(keyed, key=lambda k: k[1]):
            if key in seen:
                marks |= set(range(a, b + 1))
            seen.add(key)
        out[doc_id] = "\n".join(x for i, x in enumerate(lines) if i not in marks)
    return out


def test_lines_equal_brute_force(spark):
    rng = random.Random(2)
    pool = [f"line {k} " + "w " * (60 if k % 9 == 0 else 2) for k in range(40)] + ["", "  "]
    docs = {}
    for i in range(120):
        lines = [rng.choice(pool) for _ in range(rng.randrange(12))]
        at = rng.randrange(len(lines) + 1)
        docs[i] = "\n".join(lines[:at] + pool[3:8] * (i % 3 == 0) + lines[at:])
    frame = spark.createDataFrame(list(docs.items()), "doc_id int, text string")
    got = {r.doc_id: r.text for r in line_windows.dedup_lines(frame).collect()}
    assert got == brute_lines(docs)


def test_lines_odd(odd):
    out = line_windows.dedup_lines(odd)
    assert out.columns == [*odd.columns, "lines_removed_"]
    got = {(r.doc_id, r.piece_ids): r.text for r in out.collect()}
    assert len(got) == 8 and got[7, "d"] == "" and got[1, LONG] == ODD_ROWS[0][1] and got[2, ""] is None
    assert got[5, "b"] == " \t\n " and got[6, "c"] == LONG and got[None, "a"] == "alone here"
    assert line_windows.dedup_lines(odd.where("false")).collect() == []


# --- templates --------------------------------------------------------------------------

ITEM = "A train leaves Leeds at 14 hours and travels 120 km before it meets Anna who waited 14 hours in the cold station hall."
CHANGED = "A train leaves York at 15 hours and travels 360 km before it meets Carla who waited 15 hours in the cold station hall."
BROKEN = "A train leaves York at 15 hours and travels 360 km before it meets Carla who waited 16 hours in the cold station hall."


def test_templates(spark):
    benchmark = spark.createDataFrame([(1, ITEM), (2, "What is 7 plus 12?"), (3, "word"), (4, None), (5, "")], "item_id int, text string")
    rows = [(1, f"Some words before. {ITEM} And after."), (2, f"so that {CHANGED}"), (3, f"so that {BROKEN}"),
            (4, "then what is 8 plus 13 of them"), (5, "a word and the cold station hall"), (6, None), (7, ""),
            (8, ITEM.split(" who ")[0]), (None, f"{ITEM}\n{ITEM}"), (1, "something else")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").withColumn("item_id", F.lit("clash")).withColumn("h", F.lit(1))
    got = {(r.doc_id, tuple(r.item_ids)) for r in decontam_templates.report(docs, benchmark).collect()}
    assert got == {(1, (1,)), (2, (1,)), (3, ()), (4, (2,)), (5, ()), (6, ()), (7, ()), (8, (1,)), (None, (1,))}
    left = decontam_templates.decontaminate(docs, benchmark)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {3, 5, 6, 7}
    assert decontam_templates.report(docs.where("false"), benchmark).collect() == []
    assert decontam_templates.decontaminate(docs, benchmark.where("false")).count() == 10


def test_benchmark_items_equal_brute_force(spark, documents, data_dir):
    """The tables hold no slots, so plain runs of words decide."""
    benchmark = spark.read.parquet(f"{data_dir}/benchmark.parquet")
    plain = lambda t: re.sub(r"[^\w]+", " ", t.lower()).split()
    windows = {}
    for r in benchmark.collect():
        w = plain(r.text)
        for i in range(len(w) - 7):
            windows.setdefault(tuple(w[i:i + 8]), []).append((r.item_id, i))
    expected = set()
    for doc_id, text in texts_of(documents).items():
        w, lined = plain(text), Counter()
        for i in range(len(w) - 7):
            for item, at in windows.get(tuple(w[i:i + 8]), ()):
                lined[item, i - at] += 1
        expected |= {(doc_id, item) for (item, _), n in lined.items() if n >= 6}
    got = {(r.doc_id, r.item_id) for r in decontam_templates.matches(documents, benchmark).collect()}
    assert got == expected and got


# --- quality ----------------------------------------------------------------------------


def test_quality_on_held_out_documents(spark, data_dir):
    folder = data_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    got = {r.doc_id: r for r in nbsvm.score(docs, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [i for i in truth if got[i].held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in got.items())
    assert sum(got[i].predicted == truth[i] for i in held) / len(held) > 0.9
    assert all(r.predicted == (r.score >= 0.7) for r in got.values())


def test_descent_meets_the_optimality_conditions():
    """Rows at no bound lie on the margin, the others on the right side of it."""
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(200, 20, replace=False)) for _ in range(80)]
    signs = np.where(np.arange(80) % 2, 1.0, -1.0)
    scaled = [rng.normal(size=20) + s * 0.4 for s in signs]
    lengths = [float(np.sqrt(v @ v)) for v in scaled]
    old, nbsvm.EPOCHS = nbsvm.EPOCHS, 3000
    try:
        w, b = nbsvm._descend(rows, scaled, lengths, signs, np.arange(80))
    finally:
        nbsvm.EPOCHS = old
    margin = np.array([w[x] @ v / n + b for x, v, n in zip(rows, scaled, lengths)])
    loss = 0.5 * (w @ w + b * b) + np.maximum(0, 1 - signs * margin).sum()
    for _ in range(200):
        d = rng.normal(size=w.size) * 1e-3
        m = np.array([(w + d)[x] @ v / n + b for x, v, n in zip(rows, scaled, lengths)])
        assert 0.5 * ((w + d) @ (w + d) + b * b) + np.maximum(0, 1 - signs * m).sum() >= loss - 1e-2


def test_quality_odd(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 0), (None, 1), (99, 1), (3, None), (7, 5)], "doc_id bigint, quality int")
    for used in (labels, labels.where("false")):
        got = nbsvm.score(odd, used).collect()
        assert len(got) == 9 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in nbsvm.score(odd, labels.where("false")).collect()} == {0.5}
    assert nbsvm.score(odd.where("false"), labels).collect() == []
