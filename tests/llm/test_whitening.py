import math
import random

import numpy as np
import pytest

from demandlake.llm.whitening import whiten


def table(spark, vectors, **extra):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(3)
    return df.withColumns({k: F.lit(v) for k, v in {"x": 1, "c": "a", "n": 2, "d": 3, "total": 4, "component": 5}.items()})


def brute(vectors, components):
    """Rows that count, their whole numbers, eigenvalues and eigenvectors of the covariance over distinct ones."""
    sound = [(i, v) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in sound]
    d = max(set(lengths), key=lambda k: (lengths.count(k), k))
    xs = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in sound if len(v) == d]
    fit = sorted({tuple(x) for _, x in xs})
    n, s = len(fit), [sum(col) for col in zip(*fit)]
    centred = np.array([[(n * a - b) / n for a, b in zip(x, s)] for x in fit])
    v = centred.T @ centred / n
    e, p = np.linalg.eigh(v)
    e, p = e[::-1], p[:, ::-1]
    m = min(components, int((e > 1e-14 * e[0]).sum()))
    return xs, n, s, e[:m], p[:, :m], np.trace(v)


def compare(spark, vectors, components=16, distinct_values=True):
    xs, n, s, e, p, trace = brute(vectors, components)
    got = whiten(table(spark, vectors), components).collect()
    assert len(got) == len(xs) * len(e)
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r)
    scores = {k: [] for k in range(1, len(e) + 1)}
    for i, x in xs:
        dev = sum((n * a - b) ** 2 for a, b in zip(x, s))
        for k in scores:
            r = by[(i, dev)][k][0]
            assert r["n"] == n and abs(r["explained"] * trace / e[k - 1] - 1) < 1e-9 and r["identity_error"] < 1e-9
            own = sum((n * a - b) / n * q for a, b, q in zip(x, s, p[:, k - 1])) / e[k - 1] ** 0.5
            scores[k].append((r["whitened"], own))
    if distinct_values:
        for pairs in scores.values():
            a, b = np.array(pairs).T
            assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8 * max(1, np.abs(b).max())
    return got


def random_vectors(n, d, seed=3):
    rng = np.random.default_rng(seed)
    shape = rng.standard_normal((d, d)) * np.linspace(2, 0.1, d)
    return [(i, (rng.standard_normal(d) @ shape).tolist()) for i in range(n)]


def test_equals_eigenvectors_of_the_covariance(spark):
    vectors = random_vectors(300, 18)
    vectors += [(1000 + i, vectors[7][1]) for i in range(150)]  # a third are copies: in the fit list once
    vectors += [(2000, None), (2001, []), (2002, [None] * 18), (2003, [math.nan] * 18), (2004, [math.inf] + [0.0] * 17), (2005, [1.0] * 7), (None, vectors[3][1]), (None, vectors[3][1])]
    got = compare(spark, vectors)
    assert not {r["vec_id"] for r in got} & set(range(2000, 2006))
    assert sum(r["vec_id"] is None for r in got) == 32


def test_fewer_dimensions_than_components_and_lost_rank(spark):
    compare(spark, random_vectors(60, 5))
    flat = [(i, [a, 2 * a, b, 1.0, a]) for i, (a, b) in enumerate((float(x), float(y)) for x in range(9) for y in range(0, 33, 3))]
    assert {r["component"] for r in compare(spark, flat)} == {1, 2}


def test_repeated_eigenvalues_are_all_found(spark):
    corners = [(i, [float(i >> k & 1) for k in range(6)]) for i in range(64)]  # the covariance is a multiple of the identity
    got = compare(spark, corners, distinct_values=False)
    assert {r["component"] for r in got} == set(range(1, 7))


def test_large_entries(spark):
    rng = random.Random(1)
    vectors = [(i, [rng.choice([-1, 1]) * 10.0 ** rng.randint(0, 9) for _ in range(4)]) for i in range(40)]
    xs, n, s, *_ = brute(vectors, 4)
    want = sorted((i, v if v < 2**63 else None) for i, x in xs for v in [sum((n * a - b) ** 2 for a, b in zip(x, s))])
    got = sorted({(r["vec_id"], r["deviation"]) for r in whiten(table(spark, vectors)).collect()})
    assert [(i, v) for i, v in got] == want


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, vectors):
    assert whiten(table(spark, vectors)).count() == 0
