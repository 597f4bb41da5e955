"""Hard-negative mining: Strassen's products, heaps, and the job against a plain version."""

from __future__ import annotations

import math

import numpy as np
import pytest

from civic_mart.llm import hard_negatives as hn

ROWS = "vec_id long, embedding array<float>, label int, score double, key string, block int"


def plain(rows, every=50, n_pos=5, n_neg=3, low=50, high=95):
    fit = []
    for k, (i, e, label) in enumerate(rows):
        if label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in e]
        fit.append((k, i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, q))
    out = []
    first = lambda found: sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0, f[2]))
    for k, i, label, q in fit:
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(q, p)), j, m, other) for m, j, other, p in fit if m != k]
        for ps, j, _, _ in first([s for s in scored if s[3] == label])[:n_pos]:
            inside = [s for s in scored if s[3] != label and low * ps <= 100 * s[0] <= high * ps]
            out += [(i, j, r + 1, s[1], ps, s[0]) for r, s in enumerate(first(inside)[:n_neg])]
    return sorted(out, key=str)


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (65, 64, 130), (200, 33, 97), (64, 300, 65)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(1)
    n, k, m = shape
    for most in (300, 2 ** 40):  # sums that wrap on the way come back
        a, b = rng.integers(-most, most, (n, k)), rng.integers(-most, most, (k, m))
        assert (hn.strassen(a, b, 8) == a @ b).all()
    assert hn.strassen(np.zeros((0, 4), np.int64), np.zeros((4, 3), np.int64)).shape == (0, 3)


def test_heaps_merge_in_any_cut():
    rng = np.random.default_rng(2)
    score = rng.integers(0, 6, (9, 60))  # many ties
    for cuts in ([60], [1, 2, 30, 60], list(range(1, 61))):
        heap, at = hn.Heaps(9, 4), 0
        for to in cuts:
            heap.merge(np.arange(9), score[:, at:to], np.arange(at, to))
            at = to
        want = np.argsort(-score, axis=1, kind="stable")[:, :4]
        assert (heap.column == want).all()


def random_rows(n, dim, labels=4, seed=3):
    rng = np.random.default_rng(seed)
    v = np.round(rng.normal(0, 0.05, (n, dim)) + 0.08, 2)
    return [(i, [float(x) for x in v[i]], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("block,dim", [(2048, 6), (37, 6), (64, 40)])
def test_equals_the_plain_version(spark, block, dim, monkeypatch):
    monkeypatch.setattr(hn, "TILE", 50)
    rows = random_rows(400, dim)
    rows[10] = (10, None, 1)
    rows[11] = (11, [0.1, None], 1)
    rows[12] = (12, [float("nan")] * dim, 1)
    rows[13] = (13, [float("inf")] * dim, 1)
    rows[14] = (14, rows[14][1], None)
    rows[15] = (15, [], 1)
    rows[16] = (16, [0.5, 0.5], 2)               # shorter: padded with zeros
    rows[17] = (None, rows[17][1], 2)
    rows += [rows[50], rows[21], rows[21]]         # repeats, one of an anchor
    df = spark.createDataFrame([(*r, 0.5, "k", 1) for r in rows], ROWS).repartition(5)
    got = sorted(map(tuple, hn.hard_negatives(df, block_rows=block).collect()), key=str)
    assert got == plain(rows) and len(got) > 20


def test_few_and_no_rows(spark):
    few = [(0, [1.0, 1.0], 1), (7, [0.25, 0.5], 0), (9, [0.5, 0.5], 2), (50, [-1.0, 0.0], 3)]
    df = spark.createDataFrame([(*r, 0.5, "k", 1) for r in few], ROWS)
    assert sorted(map(tuple, hn.hard_negatives(df).collect()), key=str) == plain(few) != []
    assert hn.hard_negatives(df.where("vec_id = 9")).collect() == []
    assert hn.hard_negatives(df.limit(0)).collect() == []


def test_scores_beyond_64_bits_fail_loudly(spark):
    df = spark.createDataFrame([(0, [1e9, 1e9], 1, 0.5, "k", 1)], ROWS)
    with pytest.raises(ValueError, match="64 bits"):
        hn.hard_negatives(df)
