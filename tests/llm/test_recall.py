"""Recall of the neighbour search against all pairs, where clusters are tight or far away."""

import numpy as np
import pytest

from moodline.llm import nn_descent


def recalls(spark, vectors: dict[int, np.ndarray], every: int = 20) -> dict[int, float]:
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids])
    rows = [(i, v.tolist(), "c") for i, v in vectors.items()]
    found: dict[int, set] = {}
    for r in nn_descent.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, u string").repartition(4), every).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
        assert r["score"] == pytest.approx(float(vectors[r["query_id"]] @ vectors[r["vec_id"]]))
    out = {}
    for q in (i for i in ids if i % every == 0):
        order = sorted((-s, i) for s, i in zip(x @ vectors[q], ids) if i != q)[:20]
        out[q] = len({i for _, i in order} & found.get(q, set())) / len(order)
    return out


def unit(rng) -> np.ndarray:
    v = rng.standard_normal(32)
    return v / np.linalg.norm(v)


def test_a_tight_cluster_and_outliers(spark):
    rng = np.random.default_rng(1)
    centre = unit(rng)
    vectors = {i: centre + 0.01 * rng.standard_normal(32) for i in range(1, 1501)}
    vectors |= {20 * i: unit(rng) for i in range(100, 105)}
    got = recalls(spark, vectors)
    assert np.mean(list(got.values())) >= 0.95 and min(got[20 * i] for i in range(100, 105)) >= 0.5


def test_an_opposite_vector(spark):
    rng = np.random.default_rng(2)
    centre = unit(rng)
    vectors = {i: centre + 0.05 * rng.standard_normal(32) for i in range(1, 1200)}
    vectors |= {0: -centre, 1200: -1.1 * centre}
    got = recalls(spark, vectors)
    assert np.mean(list(got.values())) >= 0.95 and got[0] >= 0.8


def test_clusters_of_different_lengths(spark):
    """The nearest of a short vector by inner product are in the clusters of long ones."""
    rng = np.random.default_rng(3)
    vectors, at = {}, 0
    for size in (0.5, 1, 2, 4, 8):
        centre = size * unit(rng)
        for _ in range(200):
            vectors[at] = centre + 0.1 * size * rng.standard_normal(32)
            at += 1
    assert np.mean(list(recalls(spark, vectors).values())) >= 0.95


def test_rows_follow_the_parts(spark, monkeypatch):
    """Graph and beams are a row for a part: what the driver keeps a record of does not follow the vectors."""
    rng = np.random.default_rng(4)
    vectors = {i: unit(rng) for i in range(600)}
    rows = []
    write = nn_descent.staged

    def staged(df, label):
        out = write(df, label)
        if label in ("graph", "beam"):
            rows.append((label, out.count()))
        return out

    monkeypatch.setattr(nn_descent, "staged", staged)
    monkeypatch.setattr(nn_descent, "PART", 50, raising=False)
    got = recalls(spark, vectors)
    assert len(got) == 30 and np.mean(list(got.values())) >= 0.95
    assert {label for label, _ in rows} == {"graph", "beam"} and max(n for _, n in rows) <= 25
