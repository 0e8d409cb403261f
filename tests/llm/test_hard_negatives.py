"""Hard negatives against scoring every pair, and the threshold algorithm's early stop."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelake.llm import hard_negatives as hn

from .messy import by_row

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score string, rank string"


def plain(rows, is_anchor, positives=5, negatives=5, low=80, high=100):
    live = [(i, [math.floor(256 * float(np.float32(x))) for x in v], y) for i, v, y in rows
            if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]

    def dot(a, b):
        return sum(p * q for p, q in zip(a, b))  # what is missing counts as zero

    def order(r):
        return (-r[1], r[0] is None, r[0] or 0)

    out = []
    for at, (i, v, y) in enumerate(live):
        if i is None or not is_anchor(i):
            continue
        scored = [(j, dot(v, w), z) for k, (j, w, z) in enumerate(live) if k != at]
        near = sorted((r for r in scored if r[2] == y), key=order)[:positives]
        for p, s, _ in near:
            hard = sorted((r for r in scored if r[2] != y and low * s <= 100 * r[1] <= high * s), key=order)[:negatives]
            out += [(i, p, n + 1, j, s, t) for n, (j, t, _) in enumerate(hard)]
    return by_row(out)


def run(spark, rows, every=5, **how):
    df = spark.createDataFrame([(i, v, y, "a", "b", "c") for i, v, y in rows], SCHEMA).repartition(4)
    out = hn.hard_negatives(df, F.col("vec_id") % every == 0, **how)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return by_row(map(tuple, out.collect()))


def sample(n, width, seed=1, labels=3, grain=None):
    rng = random.Random(seed)

    def component():
        x = rng.gauss(0, 1)
        return round(x * grain) / grain if grain else x

    return [(i, [component() for _ in range(width)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("block,slice_,step", [(8192, 1024, 64), (50, 7, 1), (33, 100, 4)])
def test_equals_all_pairs(spark, monkeypatch, block, slice_, step):
    monkeypatch.setattr(hn, "BLOCK", block)
    monkeypatch.setattr(hn, "SLICE", slice_)
    monkeypatch.setattr(hn, "FIRST_STEP", step)
    ties = sample(150, 3, grain=2)  # few distinct scores: ties at every window's end
    odd = [(500, None, 1), (505, [1.0, 2.0, 3.0], None), (510, [1.0, None, 2.0], 1), (515, [float("nan"), 1.0, 1.0], 1),
           (520, [float("inf"), 0.0, 1.0], 0), (525, [0.0, 0.0, 0.0], 2), (530, [1.0], 1), (535, [], 0), (None, [1.0, 1.0, 1.0], 0),
           (None, [2.0, 1.0, 1.0], 1), (540, [-3.0, -3.0, -3.0], 7)]
    hot = [(600 + i, [1.5, 0.5, -1.0], i % 2) for i in range(60)] + [(10, [1.0, 0.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1)]
    rows = ties + odd + hot
    assert run(spark, rows) == plain(rows, lambda i: i % 5 == 0)
    rows = sample(200, 16, seed=2)
    assert run(spark, rows, every=9, positives=2, negatives=3, low=30, high=95) == plain(rows, lambda i: i % 9 == 0, 2, 3, 30, 95)


def test_empty_tables_and_large_numbers(spark):
    assert run(spark, []) == [] == run(spark, [(0, None, None)]) == run(spark, [(0, [1.0], 1)]) == run(spark, [(3, [1.0], 1), (4, [1.0], 2)])
    rows = [(i, [2.0 ** 16 * x for x in v], y) for i, v, y in sample(60, 4, seed=3)]
    assert run(spark, rows) == plain(rows, lambda i: i % 5 == 0)
    with pytest.raises(Exception, match="64 bits"):
        run(spark, [(0, [2.0 ** 30], 1), (1, [2.0 ** 30], 1)])


def test_reading_stops_early_and_never_too_early():
    rng = np.random.default_rng(5)
    x = rng.integers(-40, 41, (3000, 3))
    block = hn.Block(x, hn.Block.sorted_lists(x))
    ids = rng.permutation(3000)
    everything = np.ones(3000, bool)
    read = []

    class Watched(hn.Block):
        def scores(self, rows, anchor):
            read.append(len(rows))
            return super().scores(rows, anchor)

    watched = Watched(x, block.lists)
    for anchor in rng.integers(-9, 10, (40, 3)):
        best = hn.Best(5, ids, ids)
        read.clear()
        hn.best_positives(watched, anchor, everything, best)
        score = x @ anchor
        want = sorted(range(3000), key=lambda r: (-score[r], ids[r]))[:5]
        assert best.at.tolist() == want
        # Rows that could beat the fifth were all met; far from all rows were scored.
        assert not anchor.any() or sum(read) < 3000
        top = int(score.max())
        windows = [(80 * top, 100 * top), (50 * top, 70 * top), (100 * top, 80 * top)]
        bests = [hn.Best(5, ids, ids) for _ in windows]
        hn.best_in_windows(block, anchor, everything, windows, bests)
        for (low, high), b in zip(windows, bests):
            assert b.at.tolist() == sorted((r for r in range(3000) if low <= 100 * score[r] <= high), key=lambda r: (-score[r], ids[r]))[:5]
