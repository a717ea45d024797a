import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from placefolio.llm import negatives, whitening
from placefolio.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, v string, whitened string, seq string, is_anchor string"


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA).repartition(3)


def rows_with_everything(n=120, dims=6, seed=5):
    r = random.Random(seed)
    rows = [(i, [round(r.uniform(-1, 1), 2) for _ in range(dims)], r.randrange(3)) for i in range(n)]
    rows += [(n + i, rows[7][1], 1) for i in range(30)]
    rows += [(n + 40, None, 1), (n + 41, [None] * dims, 1), (n + 42, [float("nan")] * dims, 1), (n + 43, [math.inf] + [0.0] * (dims - 1), 0),
             (n + 44, rows[3][1], None), (None, rows[3][1], 1), (7, rows[7][1], 1), (n + 45, [0.0] * dims, 2), (n + 45, [0.0] * dims, 2),
             (n + 46, [0.5, -0.25], 2), (n + 47, [], 0)]
    return rows


def numbers(vector, dims):
    if vector is None or any(c is None or not math.isfinite(c) for c in vector):
        return None
    return [math.floor(256 * float(np.float32(c))) for c in vector] + [0] * (dims - len(vector))


def test_whitening_equals_a_direct_solution(spark):
    dims, rows = 6, rows_with_everything()
    got = whitening.component_rows(made(spark, rows).select("vec_id", "embedding"), 4).collect()
    whole = [(i, numbers(v, dims)) for i, v, _ in rows if numbers(v, dims) is not None]
    distinct = sorted({tuple(x) for _, x in whole})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[float(Fraction(c) - Fraction(s, n)) for c, s in zip(x, sums)] for x in distinct])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == 4 * len(whole) and {r["n"] for r in got} == {n}
    assert got[0]["identity_error"] < 1e-12 and len({r["identity_error"] for r in got}) == 1
    by_id = {}
    for i, x in whole:
        by_id.setdefault(i, []).append(x)
    signs = {}
    for r in got:
        k = r["component"] - 1
        assert abs(r["explained"] - values[k] / np.trace(covariance)) < 1e-12
        x = by_id[r["vec_id"]][0]
        assert r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(x, sums))
        want = (np.array(x) - np.array(sums) / n) @ vectors[:, k] / math.sqrt(values[k])
        if abs(want) > 1e-6:
            signs.setdefault(k, set()).add(np.sign(want) == np.sign(r["whitened"]))
        assert abs(abs(want) - abs(r["whitened"])) < 1e-9
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_keeps_clashing_columns_and_takes_degenerate_tables(spark):
    df = made(spark, rows_with_everything(20))
    out = whitening.transform(df, whitening.fit(df))
    assert out.columns == [*df.columns, "_whitened", "deviation"]
    assert out.where("v = 'x' and whitened = 'y'").count() == out.count()
    none = df.limit(0)
    assert whitening.component_rows(none.select("vec_id", "embedding"), 4).count() == 0
    assert whitening.component_rows(df.where("embedding is null").select("vec_id", "embedding"), 4).count() == 0
    one = made(spark, [(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0)]).select("vec_id", "embedding")
    rows = whitening.component_rows(one, 4).collect()
    assert sorted((r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"])
                  for r in rows) == [(i, k, 1, 0, None, None, None) for i in (1, 2) for k in (1, 2)]
    huge = made(spark, [(1, [3e38, 0.0], 0), (2, [-3e38, 1.0], 0)]).select("vec_id", "embedding")
    assert {r["deviation"] for r in whitening.component_rows(huge, 1).collect()} == {None}
    line = made(spark, [(i, [i / 4, i / 2, 0.0], 0) for i in range(8)]).select("vec_id", "embedding")
    rows = whitening.component_rows(line, 3).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in rows)
    assert rows[0]["identity_error"] < 1e-12


@pytest.mark.parametrize("values", [
    np.linspace(1, 10, 40), np.repeat([5.0, 3.0, 1.0, 0.5], 10), np.repeat([5.0, 3.0, 1.0, 0.5], 10) + np.arange(40) * 1e-10,
    1 + np.arange(40) * 1e-12, np.r_[[5.0, 4.0], np.zeros(38)], np.geomspace(1e-12, 1e6, 40), np.ones(1)])
def test_refined_eigenvectors_reach_double_precision(values):
    q = np.linalg.qr(np.random.default_rng(3).normal(size=(len(values),) * 2))[0]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, rows = whitening.principal(a)
    size = np.abs(a).max()
    assert np.abs(rows @ rows.T - np.eye(len(a))).max() < 1e-14 and (np.diff(found) <= 1e-14 * size).all()
    assert np.abs(rows @ a @ rows.T - np.diag(found)).max() < 3e-14 * size
    assert np.abs(found - np.linalg.eigvalsh(a)[::-1]).max() < 3e-14 * size


def test_single_precision_alone_would_not_do():
    q = np.linalg.qr(np.random.default_rng(3).normal(size=(40, 40)))[0]
    a = (q * np.linspace(1, 10, 40)) @ q.T
    raw = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    assert np.abs(raw.T @ a @ raw - np.diag(np.diag(raw.T @ a @ raw))).max() > 1e-8


def brute_negatives(rows, dims, anchor, positives=5, keep=3, least=50, most=95):
    ready = [(i, x, label) for i, v, label in rows if label is not None and (x := numbers(v, dims)) is not None]
    order = lambda p: (-p[1], math.inf if p[0] is None else p[0])
    out = []
    for i, x, label in ready:
        if i is None or not anchor(i):
            continue
        scored = [(j, sum(a * b for a, b in zip(x, y)), other == label) for j, y, other in ready if j != i]
        for p, score, _ in sorted((s for s in scored if s[2]), key=order)[:positives]:
            fit = [s for s in scored if not s[2] and least * score <= 100 * s[1] <= most * score]
            out += [(i, p, rank, j, score, s) for rank, (j, s, _) in enumerate(sorted(fit, key=order)[:keep], 1)]
    return sorted(out, key=str)


def found(df, every=5, **kw):
    return sorted((tuple(r) for r in negatives.mine(df, F.col("vec_id") % every == 0, **kw).collect()), key=str)


@pytest.mark.parametrize("block,shard,cells", [(4096, 2048, 4096), (16, 8, 4096), (16, 8, 2)])
def test_negatives_match_brute_force(spark, monkeypatch, block, shard, cells):
    for name, value in (("BLOCK_ROWS", block), ("SHARD_ROWS", shard), ("CELLS", cells), ("GROUP_ANCHORS", max(8, shard // 100))):
        monkeypatch.setattr(negatives, name, value)
    rows = rows_with_everything()
    want = brute_negatives(rows, 6, lambda i: i % 5 == 0)
    assert len(want) > 100 and found(made(spark, rows)) == want
    # Many columns, so that bounds cut before all are read.
    wide = rows_with_everything(200, 40, 8)
    assert found(made(spark, wide)) == brute_negatives(wide, 40, lambda i: i % 5 == 0)


def test_negatives_with_numbers_beyond_doubles(spark):
    r = random.Random(2)
    rows = [(i, [float(np.float32(r.uniform(-1, 1) * 2 ** 40)) for _ in range(5)], i % 2) for i in range(60)]
    want = brute_negatives(rows, 5, lambda i: i % 5 == 0)
    cut = 2 ** 63 - 1
    assert want and max(abs(w[4]) for w in want) > cut
    assert found(made(spark, rows)) == sorted(((*w[:4], min(w[4], cut), min(w[5], cut)) for w in want), key=str)


def test_negatives_of_odd_tables(spark):
    rows = rows_with_everything(30)
    df = made(spark, rows)
    assert found(df.limit(0)) == [] and found(df.where("label = 1")) == []
    assert found(df, every=10 ** 6) == brute_negatives(rows, 6, lambda i: i % 10 ** 6 == 0)
    named = df.withColumn("label", F.concat(F.lit("l"), "label"))
    assert found(named) == found(df)


def test_bounds_leave_out_work(spark, sf_dir):
    """A block whose columns cannot reach the best rows so far is not read."""
    low = negatives.Block(np.arange(4), np.zeros(4, np.int32), {"a": 0}, np.ones((3, 4)))
    anchor = negatives.Anchor(0, 99, "a", np.array([3, 2, 0]), [negatives.Slot(2)])
    anchor.scan(negatives.Block(np.arange(4), np.zeros(4, np.int32), {"a": 0}, np.full((3, 4), 9)), True)
    assert anchor.slots[0].scores == [45, 45] and anchor.slots[0].ids == [0, 1]

    class Untouched(np.ndarray):
        def __getitem__(self, key):
            raise AssertionError("columns were read")

    low.columns = low.columns.view(Untouched)
    anchor.scan(low, True)
    assert anchor.slots[0].scores == [45, 45]
    assert table(spark, sf_dir, "embeddings").count() > 0
