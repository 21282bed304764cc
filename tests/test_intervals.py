"""Overlaps against lists of all pairs, and where those would be too many."""

import random
import threading

import numpy as np
import pytest

from loomspark.operators import intervals as I

TURNS = "chunk_audio_path string, pos long, seg_start double, seg_end double, speaker_id string"


def some(seed, n, whole):
    rnd, out = random.Random(seed), []
    for i in range(n):
        a = rnd.choice([rnd.uniform(0, 40), rnd.gauss(1000, 3), 20.0])
        d = rnd.choice([rnd.uniform(0, 3), rnd.uniform(0, 3), rnd.uniform(0, 60), 5.0, 0.0, -1.0])
        a, d = (float(round(a)), float(round(d))) if whole else (a, d)
        out.append((rnd.choice(["x", "y", "y", None]), rnd.choice([i, i, i, 7, None]), a, rnd.choice([a + d] * 9 + [None]), rnd.choice(["p", "q", "r", "s", "t", None])))
    return out


def pairs(a, b):
    for x in a:
        for y in b:
            if x[0] is not None and x[0] == y[0] and None not in (x[3], y[3]) and x[2] < y[3] and y[2] < x[3] and x[4] != y[4]:
                yield x, y, max(0.0, min(x[3], y[3]) - max(x[2], y[2]))


@pytest.mark.parametrize("whole", [True, False])
def test_seconds_of_others(spark, whole):
    a, b = some(1, 150, whole), some(2, 200, whole)
    sums = {}
    for x, _, d in pairs(a, b):
        sums[x[:2]] = sums.get(x[:2], 0.0) + d
    got = I.shared_seconds(spark.createDataFrame(a, TURNS), spark.createDataFrame(b, TURNS), "s", width=7.0).collect()
    expected = sorted((repr(x[:2]), sums.get(x[:2], 0.0) if x[1] is not None else 0.0) for x in a)
    assert len(got) == len(expected)
    for (k, v), (k2, v2) in zip(sorted((repr((r[0], r[1])), r[2]) for r in got), expected, strict=True):
        assert k == k2 and v == pytest.approx(v2, rel=1e-9, abs=1e-9) and (v == 0) == (v2 == 0)
    assert any(v for _, v in expected)


@pytest.mark.parametrize("part", [0.3, 0.9])
def test_swallowed(spark, part):
    a, b = some(3, 150, False), some(4, 200, False)
    expected = {x for x, _, d in pairs(a, b) if x[3] > x[2] and d >= part * (x[3] - x[2])}
    got = I.swallowed(spark.createDataFrame(a, TURNS), spark.createDataFrame(b, TURNS), part, width=7.0).collect()
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected and expected


def test_short_turn_recall(spark):
    a, b = [(x[0], i, *x[2:]) for i, x in enumerate(some(5, 150, False))], some(6, 60, False)
    best = {}
    for x, _, d in pairs([(*x[:4], "a") for x in a], [(*y[:4], "b") for y in b if y[3] is None or y[3] >= y[2]]):
        best[x[1]] = max(d, best.get(x[1], 0.0))
    got = I.short_turn_recall(spark.createDataFrame(a, TURNS), spark.createDataFrame(b, TURNS), longest=3.0, width=7.0).collect()
    expected = {x[1]: (best.get(x[1]), best.get(x[1], -1.0) >= 0.5 * (x[3] - x[2])) for x in a if x[3] is not None and 1e-9 <= x[3] - x[2] <= 3.0}
    assert {r.pos: (r.best, r.hit) for r in got} == expected and {h for _, h in expected.values()} == {True, False}


def test_longest_shared_with_many_speakers():
    rng = np.random.default_rng(7)
    s, gs = rng.uniform(0, 100, 300), rng.uniform(0, 100, 400)
    e, ge, who, g_who = s + rng.uniform(0.1, 20, 300), gs + rng.uniform(0, 10, 400), rng.integers(0, 50, 300), rng.integers(0, 50, 400)
    both = np.minimum(e[:, None], ge) - np.maximum(s[:, None], gs)
    both[(who[:, None] == g_who) | (s[:, None] >= ge) | (gs >= e[:, None])] = -1
    most = both.max(axis=1)
    assert np.array_equal(I.longest_shared(s, e, who, gs, ge, g_who), np.where(most < 0, np.nan, most), equal_nan=True)


@pytest.mark.parametrize("operator", [I.contamination, lambda t: I.foreign_overlap(t, t), lambda t: I.swallowed(t, t), lambda t: I.short_turn_recall(t, t, longest=100.0)])
def test_crowded_chunks(spark, operator):
    """80,000 turns that all overlap: their 6.4 billion pairs would not end in time."""
    turns = spark.range(80_000).selectExpr("'x' as chunk_audio_path", "id as pos", "double(id % 100) as seg_start", "double(200 - id % 89) as seg_end", "concat('s', id % 3) as speaker_id")
    late = threading.Timer(60, spark.sparkContext.cancelAllJobs)
    late.start()
    try:
        operator(turns).write.format("noop").mode("overwrite").save()
    finally:
        late.cancel()
