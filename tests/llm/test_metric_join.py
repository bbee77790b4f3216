import math

import numpy as np
import pytest

from tallyspark.llm import metric_join

SCHEMA = "vec_id long, embedding array<float>, label int, node string, weight long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "clash", 9) for i, v, label in rows], SCHEMA)


def brute(rows):
    def unit(v, label):
        if label is None or v is None or any(c is None or not math.isfinite(c) for c in v) or not any(v):
            return None
        v = np.array(v, np.float32).astype(float)
        return v / np.sqrt(v @ v)
    units = [unit(v, label) for _, v, label in rows]
    links = {i: set() for i in range(len(rows))}
    for i, u in enumerate(units):
        for j in range(i):
            w = units[j]
            if u is not None and w is not None and rows[i][2] == rows[j][2]:
                m = min(len(u), len(w))
                if u[:m] @ w[:m] >= 0.93:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((vec_id, len(links[i]), low, len(seen) == 1 if vec_id is None else vec_id == low))
    return sorted(out, key=str)


def data(rng):
    rows = []

    def add(v, label):
        rows.append((len(rows), [float(c) for c in np.float32(v)], label))
    for _ in range(250):
        add(rng.standard_normal(12), int(rng.integers(3)))
    for label, size, spread in ((0, 120, .03), (0, 60, .12), (1, 90, .16), (2, 25, .2)):  # tight and loose groups
        centre = rng.standard_normal(12)
        for _ in range(size):
            add(centre + spread * np.linalg.norm(centre) * rng.standard_normal(12) / math.sqrt(12), label)
    walk = rng.standard_normal(12)  # a chain whose ends are far apart
    for _ in range(60):
        add(walk, 1)
        walk = walk / np.linalg.norm(walk) + .08 * rng.standard_normal(12)
    for _ in range(80):  # copies, also of another length of vector
        add(rows[3][1], rows[3][2])
    add([2 * c for c in rows[5][1]], rows[5][2])
    rows.extend([(900, None, 0), (901, [float("nan")] * 12, 0), (902, [None] * 12, 0), (903, [0.0] * 12, 0), (904, [float("inf")] * 12, 0),
                 (905, rows[3][1], None), (906, rows[3][1], 7), (907, rows[3][1][:5], rows[3][2]), (908, rows[3][1] + [0.0], rows[3][2]),
                 (909, [], 0), (None, rows[3][1], rows[3][2]), (None, [5.0] + [0.0] * 11, 8), (300, rows[3][1], rows[3][2]), (910, [3e38] * 12, 9), (911, [2e38] * 12, 9)])
    return rows


@pytest.mark.parametrize("sample_rows,block_rows", [(8192, 1024), (400, 16), (2, 50)])
def test_against_brute_force(spark, sample_rows, block_rows):
    rows = data(np.random.default_rng(8))
    got = metric_join.near_duplicates(frame(spark, rows), sample_rows=sample_rows, block_rows=block_rows)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_one_label_of_copies_is_one_class(spark):
    rows = [(i, [1.0, 2.0, 3.0], 1) for i in range(3000)]
    nodes = metric_join.classes(frame(spark, rows).select("vec_id", "label", "embedding"))
    assert nodes.count() == 1
    got = metric_join.op11_metric_join(frame(spark, rows)).groupBy("n_links", "component_id").count().collect()
    assert [tuple(r) for r in got] == [(2999, 0, 3000)]


def test_close_ball_is_counted_without_comparison(spark):
    """A group within half the radius of its pivot makes no pair of blocks."""
    rng = np.random.default_rng(9)
    centre = rng.standard_normal(16)
    rows = [(i, [float(c) for c in np.float32(centre + .02 * rng.standard_normal(16))], 1) for i in range(600)]
    nodes = metric_join.classes(frame(spark, rows).select("vec_id", "label", "embedding"))
    found = metric_join.range_links(nodes, block_rows=50).collect()
    assert len(found) == 600 and {r["links"] for r in found} == {599}


def test_pairs_at_the_threshold(spark):
    angles = [math.acos(c) for c in (0.930001, 0.929999)]
    rows = [(0, [1.0, 0.0], 1)] + [(i + 1, [math.cos(a), math.sin(a) * (-1) ** i], 1) for i, a in enumerate(angles)]
    got = sorted(map(tuple, metric_join.op11_metric_join(frame(spark, rows)).collect()))
    assert got == [(0, 1, 0, True), (1, 1, 0, False), (2, 0, 2, True)]


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(4, [1.0], 1)]])
def test_few_rows(spark, rows):
    got = metric_join.op11_metric_join(frame(spark, rows))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == [(i, 0, i, True) for i, _, _ in rows]
