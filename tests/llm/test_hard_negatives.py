import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake.llm.hard_negatives import Quantiser, bounds, hard_negatives

SCHEMA = "vec_id long, label long, embedding array<double>, id long, v int, code string, score double, cell int, rank int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 7, 1, "x", 2.0, 3, 4) for r in rows], SCHEMA).repartition(parts)


def plain(rows, step=10, k=5, low=80, high=100):
    """The contract over one row of each id."""
    dims = max((len(v) for _, _, v in rows if v), default=0)
    able = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole = (label, [max(-(1 << 24), min(1 << 24, math.floor(256 * x))) for x in v])
            able[i] = min(able.get(i, whole), whole)
    full = {i: (label, v + [0] * (dims - len(v))) for i, (label, v) in able.items()}
    out = set()
    for a in (i for i in full if i % step == 0):
        score = {i: sum(x * y for x, y in zip(full[a][1], v, strict=True)) for i, (_, v) in full.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if full[i][0] == full[a][0]][:k]:
            inside = [i for i in order if full[i][0] != full[a][0] and low * score[p] <= 100 * score[i] <= high * score[p]]
            out |= {(a, p, r, i, score[p], score[i]) for r, i in enumerate(inside[:k], 1)}
    return out


def mined(df, step=10, **settings):
    return {tuple(r) for r in hard_negatives(df, F.col("vec_id") % step == 0, **settings).collect()}


def test_bounds_hold_for_every_row():
    """Rows far from the fitting sample too."""
    rng = np.random.default_rng(1)
    quantiser = Quantiser(rng.integers(-80, 80, (500, 9)), 2)
    rows = np.concatenate([rng.integers(-80, 80, (400, 9)), rng.integers(-300, 300, (400, 9)), rng.integers(-(1 << 24), 1 << 24, (20, 9)), np.zeros((1, 9), np.int64)])
    anchors = rng.integers(-300, 300, (30, 9))
    least, most = bounds(*quantiser.tables(anchors), *quantiser.encode(rows))
    exact = rows @ anchors.T
    assert (least <= exact).all() and (exact <= most).all()
    assert np.median((most - least)[:400]) < exact[:400].std()


@pytest.mark.parametrize("settings", [{}, {"block": 3, "cell": 50, "cells": 2}, {"width": 5, "sample": 20}, {"low": -50, "high": 150, "positives": 3, "negatives": 9}])
def test_equals_brute_force(spark, settings):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(4, 12)) / 4
    rows = [(i, int(rng.integers(0, 3)), (centres[i % 4] + rng.normal(size=12) / 10).tolist()) for i in range(400)]
    right = plain(rows, k=5, **{k: v for k, v in settings.items() if k in ("low", "high")}) if "positives" not in settings else None
    got = mined(frame(spark, rows), **settings)
    if right is None:
        wide = plain(rows, k=9, low=-50, high=150)
        firsts = {(a, p) for a, p, *_ in got}
        right = {r for r in wide if r[:2] in firsts}
        assert all(len({p for b, p in firsts if b == a}) <= 3 for a, _ in firsts)
    assert got == right and got


def test_a_third_of_rows_are_one_vector(spark):
    """Ties by id; one label holds most rows; partitionings give the same rows."""
    rng = np.random.default_rng(3)
    rows = [(i, i % 5 if i % 3 == 0 else 0, [0.5, 0.25, -0.5] if i % 3 == 1 else (rng.normal(size=3) / 3).tolist()) for i in range(600)]
    assert mined(frame(spark, rows, 1), step=20) == mined(frame(spark, rows, 7), step=20) == plain(rows, step=20)


def test_odd_rows(spark):
    """Null ids, labels, vectors and components, infinite, short, empty and zero vectors, repeated rows and ids, huge components."""
    rng = np.random.default_rng(4)
    rows = [(i, i % 2, (rng.normal(size=4) / 2).tolist()) for i in range(60)]
    rows += [(None, 1, [1.0] * 4), (100, None, [1.0] * 4), (101, 1, None), (102, 1, [1.0, None, 1.0, 1.0]), (103, 0, [float("nan")] * 4), (104, 0, [float("inf")] * 4)]
    rows += [(110, 0, [0.5]), (111, 1, []), (112, 0, [0.0] * 4), *rows[:20], *((i, 1, [0.1 * i, 0.2, 0.3, 0.4]) for i in range(5)), (113, 1, [1e300, -1e300, 1.0, 0.0])]
    assert mined(frame(spark, rows)) == plain(rows)


def test_tables_without_anchors(spark):
    assert mined(frame(spark, [(1, 1, [1.0])])) == mined(frame(spark, [(0, 1, [1.0])]).limit(0)) == mined(frame(spark, [(0, 1, [1.0])])) == set()
    assert mined(frame(spark, [(0, 1, []), (1, 1, []), (2, 0, [])])) == {(0, 1, 1, 2, 0, 0)}
