"""The pipeline row by row against plain Python, and its stages on odd tables."""

import re
from collections import Counter

import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_documents import brute_fingerprint, brute_lines, closest_roots

import corpus_pipeline
from postmill.llm import nbsvm, piece_fst

STAGES = dict(corpus_pipeline.STAGES)


def planted(rows, items):
    """Documents of the table and, built from its better ones: exact and near copies, repeated passages, and benchmark passages."""
    good = [r for r in rows if r[2] == "en" and 600 < len(r[1]) < 3000][:12] or [r for r in rows if 600 < len(r[1]) < 3000][:12]
    out, at = list(rows), 1_000_000
    passage = " ".join(w for r in good for w in r[1].split()[:12])
    for i, (_, text, lang, source, _) in enumerate(good):
        words = text.split(" ")
        texts = [text, text.replace(".", ",", 1), f"{text}\n{passage}", " ".join([*words[:40], items[i % len(items)], *words[40:]])]
        for t in texts:
            out.append((at, t, lang, source, len(t)))
            at += 1
    return out


def leaks(text, items):
    plain = lambda t: re.sub(r"[^\w]+", " ", t.lower()).split()
    w, lined = plain(text), Counter()
    places = {}
    for i in range(len(w) - 7):
        places.setdefault(tuple(w[i:i + 8]), []).append(i)
    for n, item in enumerate(items):
        t = plain(item)
        for i in range(len(t) - 7):
            for p in places.get(tuple(t[i:i + 8]), ()):
                lined[n, i - p] += 1
    return any(n >= 6 for n in lined.values())


def test_pipeline_equals_plain_python(spark, data_dir, tmp_path):
    read = lambda n: spark.read.parquet(f"{data_dir}/{n}.parquet")
    docs, labels, benchmark = read("documents"), read("labels"), read("benchmark")
    items = [r.text for r in benchmark.orderBy("item_id").collect()]
    rows = planted([tuple(r) for r in docs.orderBy("doc_id").collect()], items)
    for name, table in (("documents", spark.createDataFrame(rows, docs.schema)), ("labels", labels), ("benchmark", benchmark)):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    given = spark.read.parquet(f"{tmp_path}/documents.parquet")
    accepted = {r.doc_id for r in nbsvm.score(given, labels).where("predicted = 1").collect()}
    left = brute_lines({r[0]: r[1] for r in rows if r[0] in accepted})
    ids = sorted(left)
    roots = closest_roots([brute_fingerprint(left[i]) for i in ids], 4)
    left = {i: left[i] for k, i in enumerate(ids) if roots[k] == k}
    expected = {i: t for i, t in left.items() if not leaks(t, items)}
    library = sentencepiece.SentencePieceProcessor(model_file=piece_fst.MODEL_FILE)
    other = {r[0]: r[2:4] for r in rows}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.text, r.lang, r.source, r.n_chars, tuple(r.piece_ids)) for r in got) == sorted(
        (i, t, *other[i], len(t), tuple(library.encode(t))) for i, t in expected.items())
    assert len(accepted) > len(ids) - 1 > len(left) > len(expected) > 10


ODD = [(5, "one two three four five", 1), (9, "one two three four five", 2), (9, "quite another text of words here", 3), (1, "some text", 4), (1, "some text", 4),
       (None, "one two three four five", 5), (None, "lonely words of no number at all", 6), (7, None, 7), (8, "", 8), (None, None, 9)]


@pytest.fixture
def odd(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), n) for i, t, n in ODD],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, n int")
    return docs.withColumns({"Score": F.lit(1), "held_out": F.lit("x"), "predicted": F.lit(2), "row_number": F.lit(3), "fp": F.lit(4), "root": F.lit(5)})


def test_one_row_of_each_group_stays(spark, odd, data_dir):
    out = STAGES["SimHash near-dedup"](spark, odd, data_dir)
    assert out.columns == odd.columns
    assert sorted((r.n, r.doc_id) for r in out.collect()) == [(1, 5), (3, 9), (4, 1), (6, None), (7, 7)]
    assert STAGES["SimHash near-dedup"](spark, odd.where("false"), data_dir).collect() == []


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_tables(spark, odd, data_dir, name):
    out = STAGES[name](spark, odd, data_dir)
    rows = out.collect()
    assert out.columns[:len(odd.columns)] == odd.columns
    assert Counter(r.n for r in rows) <= Counter(r[2] for r in ODD)
    if name in ("line dedup", "benchmark decontamination", "SentencePiece encoding"):
        assert len(rows) == len(ODD)
