import math
import random

import numpy as np
import pandas as pd
import pytest

from tallyspark.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5):
    q = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q[i] = [math.floor(256 * float(np.float32(x))) for x in v]
    out = []
    for i in q:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in q if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    return sorted(out)


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, .2) for _ in range(16)], 1) for i in range(400)]
    rows += [(i, [0.5] * 16, 1) for i in range(400, 520)]                      # one very common vector, ties by id
    rows += [(600, None, 1), (601, [None] * 16, 1), (602, [float("nan")] * 16, 1), (650, [float("inf")] + [0.0] * 15, 1),
             (700, [0.0] * 16, 1), (750, [], 1), (None, [1.0] * 16, 1), (800, [300.0] * 16, 1), (850, [0.25] * 3, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    v = topk.quantise(df)
    for index_rows, query_rows in ((64, 4), (4096, 2048)):
        got = topk.top_k(v, v.where("vec_id % 50 = 0"), 5, index_rows, query_rows)
        assert sorted(map(tuple, got.collect())) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, n):
    df = spark.createDataFrame([(i * 50, [1.0, -1.0], 0) for i in range(n)], SCHEMA)
    assert sorted(map(tuple, topk.op2_topk(df).collect())) == brute([(i * 50, [1.0, -1.0], 0) for i in range(n)])


def test_pruning_is_proven():
    """Rows are dropped early only where no query can want them."""
    rng = np.random.default_rng(3)
    m = rng.integers(-256, 256, (500, 8))
    m[7] = 256
    bits = np.frexp(np.abs(m).astype(float))[1]
    segments = []
    for level in sorted(set(bits[m != 0].tolist()) | {0}, reverse=True):
        rows, dims = np.nonzero(bits == level) if level else (np.empty(0, int),) * 2
        rest = np.sqrt((np.where(bits < level, m, 0).astype(float) ** 2).sum(axis=1))
        segments.append((level, rows, dims, m[rows, dims], rest))
    q = rng.integers(-256, 256, (5, 8))
    for qid, ids, scores in topk.search_block(np.arange(5), q, np.arange(500), segments, 4):
        s = [(-int(q[qid] @ m[j]), j) for j in range(500) if j != qid]
        assert list(zip((-scores).tolist(), ids.tolist())) == sorted(s)[:4]


def test_few_postings_are_scored(spark):
    """2,000 queries at once: each pair is proven out by itself, so most
    postings of the block are never scored."""
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 1, (20, 64))
    m = centres[rng.integers(0, 20, 4000)] + rng.normal(0, .5, (4000, 64))
    m = np.floor(256 * m / np.linalg.norm(m, axis=1)[:, None]).astype(np.int64)
    block = topk._index_block(pd.DataFrame({"vec_id": np.arange(4000), "block": 0, "q": list(m)}))
    segments = [(s.level, np.frombuffer(s.rows, np.int32), np.frombuffer(s.dims, np.int32), np.frombuffer(s.vals, np.int64),
                 np.frombuffer(s.rest, np.float64)) for s in block.itertuples()]
    ids, asked, work = np.arange(4000), np.arange(2000), {}
    floors = topk.first_floors(asked, m[:2000], ids[3000:], m[3000:], 5)
    found = {qid: list(zip(scores.tolist(), rows.tolist())) for qid, rows, scores in
             topk.search_block(asked, m[:2000], ids, segments, 5, floors, work)}
    scores = m[:2000] @ m.T
    for i in asked:
        want = sorted((-int(s), j) for j, s in enumerate(scores[i]) if j != i)[:5]
        assert [(-s, j) for s, j in found[i]] == want
    assert work["pairs"] == 2000 * 4000 and work["rescored"] < 0.1 * work["pairs"]
    assert work["postings"] + 64 * work["rescored"] < 0.75 * 2000 * np.count_nonzero(m)


def test_clashing_columns_and_repeated_rows(spark):
    rows = [(i, [float(i % 7), 1.0], i % 3) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    odd = df.selectExpr("*", "1 as q", "'x' as block", "2.5 as score", "label as rank")
    assert sorted(map(tuple, topk.op2_topk(odd).collect())) == brute(rows)
