"""Neighbours by vec_id where a third of the rows are copies, and on the given embeddings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from postmill.llm import hnsw_shards


def recall(got, ids, data, k=20):
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r.rank] = r.vec_id
    hits = 0
    for q, ranks in found.items():
        scores = data @ data[ids.index(q)]
        exact = [v for v in (ids[i] for i in np.lexsort((ids, -scores))) if v != q][:k]
        assert sorted(ranks) == list(range(1, k + 1)) and len(set(ranks.values())) == k
        hits += len(set(exact) & set(ranks.values()))
    assert set(found) == {i for i in ids if i % 20 == 0}
    return hits / (k * len(found))


def frame_of(spark, ids, data):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, data)], "vec_id bigint, embedding array<double>")


@pytest.mark.parametrize("shard_rows", [8192, 300])
def test_a_third_copies(spark, shard_rows):
    rng = np.random.default_rng(4)
    data = rng.integers(-8, 9, size=(1500, 16)).astype(float)  # inner products are exact, so copies tie
    copied = rng.permutation(1500)
    data[copied[:500]] = data[copied[0]]
    data[copied[500:700]] = data[copied[500]]
    ids = list(range(1500))
    got = hnsw_shards.nearest(frame_of(spark, ids, data), F.col("vec_id") % 20 == 0, 20, shard_rows).collect()
    assert recall(got, ids, data) >= 0.95


def test_given_embeddings(spark, data_dir):
    rows = spark.read.parquet(f"{data_dir}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    ids, data = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    got = hnsw_shards.nearest(frame_of(spark, ids, data), F.col("vec_id") % 20 == 0).collect()
    assert recall(got, ids, data) >= 0.95
