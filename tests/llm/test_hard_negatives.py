"""Hard negatives against all scores, and what holds for blocks and bounds."""

import math

import numpy as np
import pytest

from tapewright.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        kept[i, (label + 1) % 10 if i % 7 == 0 else label, q] = None
    out = []
    for a in kept:
        if a[0] % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in kept if b != a and len(b[2]) == len(a[2]))
        for ps, p, _ in [s for s in scored if s[2] == a[1]][:5]:
            window = [s for s in scored if s[2] != a[1] and 80 * -ps <= 100 * -s[0] <= 100 * -ps][:5]
            out += [(a[0], p, k + 1, n, -ps, -ns) for k, (ns, n, _) in enumerate(window)]
    return sorted(out)


def check(spark, rows):
    got = hn.mine(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    want = expected(rows)
    assert sorted(map(tuple, got)) == want
    return want


def vectors(n, dims, seed, centres=12):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centres, dims))
    centre = rng.integers(centres, size=n)
    near = middle[centre] + 0.3 * rng.standard_normal((n, dims))
    return [(i, near[i].tolist(), int(centre[i]) % 10) for i in range(n)]


@pytest.mark.parametrize("block", [8, 1024])
def test_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hn, "BLOCK", block)
    monkeypatch.setattr(hn, "PART", 3)
    monkeypatch.setattr(hn, "ZONES", 5)
    assert check(spark, vectors(900, 6, 1))


def test_ties_repeats_nulls_and_lengths(spark):
    rows = vectors(300, 4, 2)
    same = rows[5][1]
    rows += [(1000 + k, same, k % 3) for k in range(60)] + [(200, same, 1), (100, same, 2)]
    rows += rows[:20] + [(None, same, 1), (400, None, 1), (500, same, None), (600, [1.0, None, 0.0, 0.0], 1),
                         (700, [1.0, float("nan"), 0.0, 0.0], 1), (800, [float("inf"), 0.0, 0.0, 0.0], 1)]
    rows += [(900, [], 3), (901, [], 3), (902, [], 4), (1200, [0.0] * 4, 1), (1300, [-3.0] * 4, 3),
             (1400, [1.0, 2.0], 5), (1401, [1.0, 2.0], 5), (1402, [1.0, 1.9], 6)]
    assert check(spark, rows)


def test_few_rows_and_empty_table(spark):
    assert check(spark, [(0, [1.0, 0.0], 1)]) == []
    assert check(spark, [(100, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [1.0, 0.0], 2)])
    assert check(spark, []) == []


def test_extra_columns_and_scores_beyond_a_long(spark):
    rows = [(100, [1.0], 1, "a", {"x": 1}), (1, [1.0], 1, "b", None), (2, [1.0], 2, "c", {}), (3, [3e38], 2, "d", {})]
    docs = spark.createDataFrame(rows, SCHEMA + ", block string, score map<string,int>")
    assert [tuple(r) for r in hn.mine(docs).collect()] == [(100, 1, 1, 2, 65536, 65536)]


def test_curve_steps_to_a_neighbour():
    axis = np.arange(1 << hn._BITS)
    points = np.stack(np.meshgrid(axis, axis, axis), -1).reshape(-1, 3)
    key = hn._curve(points)
    assert sorted(key) == list(range(len(points)))
    assert (np.abs(np.diff(points[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(3)
    for scale in (1, 1 << 20):
        a = rng.integers(-200, 200, (20, 5)) * scale
        rows = rng.integers(-50, 50, (40, 30, 5)) * scale + rng.integers(-300, 300, (40, 1, 5)) * scale
        least, most = hn._bounds(a, rows.min(axis=1), rows.max(axis=1))
        scores = np.einsum("ad,brd->abr", a, rows)
        assert (least[:, :, None] <= scores).all() and (scores <= most[:, :, None]).all()
        assert (most < np.sort(scores.reshape(20, -1), axis=1)[:, -5:-4]).mean() > 0.5


def test_lowest_is_rounded_up():
    score = np.array([0, 1, 2, 3, 4, 5, 6, 99, 100, 101, 1 << 61])
    assert [int(x) for x in hn._lowest(score)] == [-(-80 * int(s) // 100) for s in score]
