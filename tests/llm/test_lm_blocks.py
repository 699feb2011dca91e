"""Memory of the language model's tasks, and the walk of a whole block against the walk of each text."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from postmill.llm import backoff_lm
from postmill.llm.packing import unpack_counts, unpack_keys

TEXTS = ["a b c a b", "A b  b c", "c c a b a", None, "", " \t", "b a c\nzz", "unseen a b", "a " * 40]


def block(texts, order, train):
    seq = backoff_lm.tokens(pa.array(texts, pa.string()))
    levels = backoff_lm.grams(seq, order)
    weight = np.repeat(train, seq.lengths)
    totals = [np.bincount(g.at[g.at >= 0], weight[g.at >= 0], minlength=len(g.keys)).astype(np.int64) for g in levels]
    return seq, levels, totals


@pytest.mark.parametrize("order", [1, 2, 3, 4])
@pytest.mark.parametrize("learned", [7, 0])
def test_block_walk_equals_walk_of_each_text(order, learned):
    seq, levels, totals = block(TEXTS, order, (np.arange(len(TEXTS)) < learned).astype(np.int64))
    model = backoff_lm.Automaton(seq, levels, totals, 30, 4)
    symbols = seq.symbols.tolist()
    each = [model.walk(symbols[a + 1:a + n]) for a, n in zip(seq.starts.tolist(), seq.lengths.tolist())]
    assert model.walk_block(seq, levels).tolist() == each


def test_block_without_texts():
    seq, levels, totals = block([], 2, np.zeros(0, np.int64))
    assert len(backoff_lm.Automaton(seq, levels, totals, 0, 0).walk_block(seq, levels)) == 0


def test_scoring_a_block_holds_few_bytes_a_token():
    """Arcs are arrays: kept as dictionaries and lists they took 330 bytes a token."""
    picks = np.random.default_rng(4).integers(0, 20_000, (500, 400))
    seq, levels, totals = block([" ".join(map(str, p)) for p in picks.tolist()], 2, np.ones(500, np.int64))
    flat = np.concatenate(totals)[backoff_lm._sorted_keys(levels)[1]]
    tracemalloc.start()
    try:
        backoff_lm._score_block(seq, levels, flat, 200_000, 20_000)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 180 * len(seq.symbols)


def test_word_counts_are_sent_on_before_they_grow():
    texts = [pa.array([f"x{i} y{i} common", None]) for i in range(20)]
    tables = list(backoff_lm._word_counts(iter(texts), 3, held_words=20))
    assert len(tables) > 1
    total = {}
    for table in tables:
        cells = table.to_pydict()
        assert sum(len(unpack_counts(c)) for c in cells["counts"]) < 20 + 5
        for keys, counts in zip(cells["keys"], cells["counts"]):
            for k, c in zip(unpack_keys(keys).tolist(), unpack_counts(counts).tolist()):
                total[k] = total.get(k, 0) + c
    found = sorted(n for n in total.values() if n)
    assert found == [1] * 40 + [20, 40, 40]  # common, start and end marks


def test_arrow_batches_are_bounded(spark):
    """By default a batch has up to ten thousand rows; 8,000 of the check tables took 280 MB in a worker."""
    keys = [f"spark.sql.execution.arrow.{k}" for k in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    before = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], 10_000)
        out = backoff_lm.score(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string"))
        assert int(spark.conf.get(keys[0])) <= 1_000
        assert sorted(r.n_tokens for r in out.collect()) == [1, 3]
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
