"""The metric range join against brute force."""

import random

import numpy as np
import pytest

from brindle.llm.metric_join import forest, linked, metric_links, unit

SCHEMA = "vec_id long, embedding array<double>, label int, n_links string, cell string"


def brute(rows, least):
    good = {}
    for k, (_, v, label, *_) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[k] = np.array(v, float)
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links = [0] * len(rows)
    for i in good:
        for j in good:
            if i < j and rows[i][2] == rows[j][2] and len(good[i]) == len(good[j]):
                a, b = good[i], good[j]
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= least:
                    links[i] += 1
                    links[j] += 1
                    parent[root(i)] = root(j)
    least_of = {}
    for k, row in enumerate(rows):
        if row[0] is not None:
            least_of[root(k)] = min(row[0], least_of.get(root(k), row[0]))
    out = [(row[0], links[k], least_of.get(root(k))) for k, row in enumerate(rows)]
    return sorted(((a, b, c, a == c) for a, b, c in out), key=repr)


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted((tuple(r) for r in metric_links(df, **options).collect()), key=repr)


def clustered(seed, n, dim=6, noise=0.15):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dim))
    rows = []
    for k in range(n):
        v = centers[rng.integers(6)] + rng.normal(size=dim) * noise * rng.random() if rng.random() < 0.7 else rng.normal(size=dim)
        rows.append((k, [float(x) for x in v], int(rng.integers(2)), "x", "y"))
    return rows


@pytest.mark.parametrize(("cell_rows", "least"), [(8, 0.8), (30, 0.93), (8, 0.99), (2048, 0.93)])
def test_equals_brute_force_at_every_cell_size(spark, cell_rows, least):
    rows = clustered(int(least * 100), 260)
    assert found(spark, rows, least=least, cell_rows=cell_rows) == brute(rows, least)


def test_a_hot_group_of_near_and_equal_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=16)
    rows = [(k, [float(x) for x in base + rng.normal(size=16) * 0.05], 1, None, None) for k in range(150)]
    rows += [(200 + k, [float(x) for x in base], 1, None, None) for k in range(60)]
    rows += [(300 + k, [float(x) for x in rng.normal(size=16)], 1 if k % 2 else None, None, None) for k in range(80)]
    assert found(spark, rows, cell_rows=16) == brute(rows, 0.93)


def test_defined_results_of_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1, "a", "b"),
        (2, [2.0, 4.0, 6.0], 1, "a", "b"),
        (3, v, None, "a", "b"),
        (4, None, 1, "a", "b"),
        (5, [0.0, 0.0, 0.0], 1, "a", "b"),
        (6, [1.0, None, 3.0], 1, "a", "b"),
        (7, [1.0, float("nan"), 3.0], 1, "a", "b"),
        (8, [float("inf"), 2.0, 3.0], 1, "a", "b"),
        (9, [], 1, "a", "b"),
        (10, [1.0, 2.0], 1, "a", "b"),
        (None, v, 1, "a", "b"),
        (None, v, 2, "a", "b"),
        (2, v, 1, "a", "b"),
        (12, [1e300, 2e300, 3e300], 1, "a", "b"),
        (13, [-1.0, -2.0, -3.0], 1, "a", "b"),
        (14, [-0.0, 0.0, 1.0], 3, "a", "b"),
        (15, [0.0, 0.0, 1.0], 3, "a", "b"),
    ]
    got = found(spark, rows)
    want = {1: (4, 1), 3: (0, 3), 4: (0, 4), 5: (0, 5), 6: (0, 6), 7: (0, 7), 8: (0, 8), 9: (0, 9), 10: (0, 10), 12: (4, 1), 13: (0, 13), 14: (1, 14), 15: (1, 14)}
    assert {(r[0], r[1], r[2]) for r in got if r[0] in want} == {(k, *w) for k, w in want.items()}
    assert [r for r in got if r[0] == 2] == [(2, 4, 1, False), (2, 4, 1, False)]
    assert sorted((r[1:] for r in got if r[0] is None), key=repr) == [(0, None, True), (4, 1, False)]


def test_empty_table(spark):
    assert found(spark, []) == []


def test_threshold_is_met_exactly_on_the_border():
    a = np.array([[1.0, 0.0]])
    assert linked(a, np.array([[0.6, 0.8]]), 0.6)[0, 0]
    assert not linked(a, np.array([[0.6, 0.8]]), 0.6000001)[0, 0]


def test_stars_span_the_parts():
    near = np.zeros((5, 5), bool)
    for i, j in [(0, 1), (1, 2), (3, 4)]:
        near[i, j] = near[j, i] = True
    assert sorted(map(tuple, forest(near).tolist())) == [(0, 1), (0, 2), (3, 4)]


def test_unit_length_of_huge_components():
    assert np.allclose(np.linalg.norm(unit(np.array([[1e300, -1e300]])), axis=1), 1)


def test_order_of_rows_does_not_matter(spark):
    rows = clustered(3, 120)
    again = rows[:]
    random.Random(1).shuffle(again)
    assert found(spark, rows, cell_rows=16) == found(spark, again, cell_rows=16)
