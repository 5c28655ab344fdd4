"""Clustering, near-duplicates and hard negatives of vectors, against brute force, with nulls, ties, repeats and odd columns."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from atelier.llm import binarycodes, negatives, orchard

SMALL = "/root/testdata/sf0.001"
KIND = "vec_id long, embedding array<float>, label int"
CLASHING = "node content bucket ball share block x fit first angle cluster distance score scores positive".split()


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in CLASHING})


def vectors(rng, n, dim=64, groups=()):
    """Random unit vectors of ten labels, and groups of (size, noise) around one of them each."""
    x = rng.standard_normal((n, dim))
    label = rng.integers(0, 10, n)
    for size, noise in groups:
        c = rng.standard_normal(dim) / np.sqrt(dim)
        x = np.concatenate([x, c + noise / np.sqrt(dim) * rng.standard_normal((size, dim))])
        label = np.concatenate([label, np.full(size, rng.integers(0, 10))])
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    return [(int(i), v.tolist(), int(lab)) for i, v, lab in zip(rng.permutation(len(x)), x, label, strict=True)]


def odd_rows(dim=64):
    one = [0.5] + [0.0] * (dim - 1)
    return [
        (9001, None, 1), (9002, one, None), (None, one, 1), (9003, [0.0] * dim, 1), (9004, [None, *one[1:]], 1), (9005, [float("nan"), *one[1:]], 1),
        (9006, [float("inf"), *one[1:]], 1), (9007, [], 1), (9008, [1.0, 2.0], 1), (9009, one, 1), (9009, one, 1), (9010, one, 1), (9100, one, 2), (9100, one, 2),
        (9011, [3.0e38, *one[1:]], 1), (None, None, None), (9012, [-x for x in one], 1), (9013, [2 * x for x in one], 1), (9200, one, 1),
    ]


# ---- centroid clustering


def brute_clusters(rows, k=16, rounds=3):
    limit = 1 << 26
    kept = [(i, np.clip(np.floor(64 * np.array(v, np.float32).astype(float)), -limit, limit).astype(int).tolist(), v) for i, v, _ in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    named = sorted(((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v, w) for i, w, v in kept if i is not None), key=lambda x: x[:2])
    centroids = [w for _, _, w in named[:k]]
    near = lambda w: min((sum((a - b) ** 2 for a, b in zip(w, c, strict=True)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, w, _ in kept:
            own[near(w)[1]].append(w)
        centroids = [[sum(x) // len(own[j]) for x in zip(*own[j], strict=True)] if own[j] else c for j, c in enumerate(centroids)]
    last = [(i, *near(w)) for i, w, _ in kept]
    inertia = defaultdict(int)
    for _, d, j in last:
        inertia[j] += d
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for i, d, j in last), key=str)


def test_orchard_finds_the_nearest_of_the_smallest_number():
    rng = np.random.default_rng(2)
    for k, spread in ((1, 9), (2, 1), (16, 2), (300, 30), (300, 1)):
        centroids, x = rng.integers(-spread, spread + 1, (k, 5)), rng.integers(-spread, spread + 1, (400, 5))
        index = orchard.Orchard(centroids)
        best, distance = index.nearest(x)
        every = ((x[:, None] - centroids[None]) ** 2).sum(2)
        assert (best == every.argmin(1)).all() and (distance == every.min(1)).all()  # argmin takes the first of ties
    centres = rng.standard_normal((200, 8)) * 1000
    index = orchard.Orchard(centres.astype(int))
    index.nearest((np.repeat(centres, 20, 0) + rng.standard_normal((4000, 8)) * 30).astype(int))
    assert index.measured < 0.5 * 4000 * 200


def test_clustering(spark):
    rows = vectors(np.random.default_rng(3), 300, groups=[(60, 0.2)]) + odd_rows()
    got = sorted(map(tuple, orchard.clustered(clashing(spark.createDataFrame(rows, KIND))).collect()), key=str)
    assert got == brute_clusters(rows)
    few = vectors(np.random.default_rng(4), 5) * 2
    assert sorted(map(tuple, orchard.clustered(spark.createDataFrame(few, KIND)).collect()), key=str) == brute_clusters(few)
    assert orchard.clustered(spark.createDataFrame([], KIND)).collect() == []
    with pytest.raises(ValueError):
        orchard.clustered(spark.createDataFrame([], KIND), k=orchard.MOST + 1)


# ---- near-duplicates


def brute_links(rows, least=0.93):
    x = [np.array(v, np.float32).astype(float) if v is not None and None not in v else None for _, v, _ in rows]
    fit = [i is not None and lab is not None and v is not None and bool(np.isfinite(v).all()) and bool((v != 0).any()) for (i, _, lab), v in zip(rows, x, strict=True)]
    n, parent = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    unit = [v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) if f else None for v, f in zip(x, fit, strict=True)]
    for i in range(len(rows)):
        for j in range(i):
            if fit[i] and fit[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                n[i] += 1
                n[j] += 1
                parent[root(i)] = root(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[root(i)] = min(low.get(root(i), r[0]), r[0])
    return sorted(((r[0], n[i], low.get(root(i)), r[0] == low.get(root(i)) if r[0] is not None else None) for i, r in enumerate(rows)), key=str)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(5)
    a, b = rng.standard_normal((2, 20_000, 64))
    b = 0.9 * a + 0.6 * b
    a, b = binarycodes.unit(a), binarycodes.unit(b)
    signs, factor = binarycodes.encoded(a, 1024)
    about, error = binarycodes.estimates(signs, factor, b, 1024)
    off = about - (a * b).sum(1)
    assert abs(off.mean()) < 1e-3 and (np.abs(off) > binarycodes.ERRORS * error).mean() < 1e-3
    assert 0.5 < off.std() / error.mean() < 1.2


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicate_vectors(spark, seed):
    """Groups so tight that they are one ball, wider ones whose balls meet in part, and ones at the threshold."""
    rows = vectors(np.random.default_rng(seed), 300, groups=[(120, 0.1), (90, 0.24), (90, 0.3), (2, 0.1), (40, 0.35)]) + odd_rows()
    rows += [(8000 + i, v, lab) for i, (_, v, lab) in enumerate(rows[:40] + rows[310:330])]  # copies
    got = sorted(map(tuple, binarycodes.linked(clashing(spark.createDataFrame(rows, KIND))).collect()), key=str)
    assert got == brute_links(rows)
    assert sum(r[1] for r in got) > 15_000


def test_no_near_duplicate_vectors(spark):
    assert binarycodes.linked(spark.createDataFrame([], KIND)).collect() == []
    alone = spark.createDataFrame([(1, None, None), (2, [1.0], 1)], KIND)
    assert sorted(map(tuple, binarycodes.linked(alone).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


# ---- hard negatives


def brute_negatives(rows, each=100):
    limit = 1 << 24
    valid = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, np.clip(np.floor(256 * np.array(v, np.float32).astype(float)), -limit, limit).astype(int).tolist()) for i, v, lab in rows if i is not None and lab is not None and v is not None and None not in v and np.isfinite(v).all()]
    anchors = {}
    for r in sorted(valid):
        if r[0] % each == 0:
            anchors.setdefault(r[0], r)
    out = []
    for a, label, x in anchors.values():
        scored = [(-sum(p * q for p, q in zip(x, y, strict=True)), i, lab) for i, lab, y in valid if len(y) == len(x) and i != a]
        same, other = sorted({s[:2] for s in scored if s[2] == label}), sorted({s[:2] for s in scored if s[2] != label})
        for down, p in same[:5]:
            fit = [(n, -s) for s, n in other if 80 * -down <= 100 * -s <= 100 * -down]
            out += [(a, p, r, n, -down, s) for r, (n, s) in enumerate(fit[:5], 1)]
    return sorted(out)


def mined(df):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, negatives.mined(df, anchor=F.col("vec_id") % 100 == 0, label=label).collect()))


def test_hard_negatives(spark):
    rng = np.random.default_rng(6)
    rows = vectors(rng, 500, groups=[(150, 0.3)])
    rows += [(i + 700, v, (lab + 1) % 10) for i, v, lab in rows[450:600]]  # equal vectors of other labels: ties of score
    rows += odd_rows() + rows[:30] + [(100, rows[5][1], 3), (9300, [0.1, 0.2], 1), (9301, [0.1, 0.2], 2), (9302, [0.1, 0.2], 1)]
    want = brute_negatives(rows)
    assert mined(clashing(spark.createDataFrame(rows, KIND))) == want and len(want) > 100
    assert mined(spark.createDataFrame([], KIND)) == []
    assert mined(spark.createDataFrame([(100, [1.0], 1), (200, [1.0], 2)], KIND)) == []


def test_hard_negatives_in_blocks(spark, monkeypatch):
    """Several blocks of anchors, tiles within them, and groups that are cut again and again."""
    monkeypatch.setattr(negatives, "BLOCK", 3)
    monkeypatch.setattr(negatives, "TILE", 7)
    rows = vectors(np.random.default_rng(7), 300, dim=8)
    rows = [(i * 10, v, lab) for i, v, lab in rows]
    assert mined(spark.createDataFrame(rows, KIND).repartition(5)) == brute_negatives(rows)


def test_keys_sort_by_anchor_then_descending_score():
    rng = np.random.default_rng(8)
    rows = [tuple(map(int, r)) for r in rng.integers(-(1 << 60), 1 << 60, (500, 3))] + [(0, 0, 0), (0, 0, 1), (0, 1, 0), (0, -1, 0), (-1, 0, 0)]
    assert [negatives.unpacked(k) for k in sorted(negatives.packed(*r) for r in rows)] == sorted(rows, key=lambda r: (r[0], -r[1], r[2]))


def test_best_keeps_the_first_of_each_group():
    rng = np.random.default_rng(9)
    best, rows = negatives.Best(7, 3), []
    for _ in range(20):
        part = rng.integers(0, 7, 50), rng.integers(0, 9, 50), rng.integers(0, 40, 50)
        best.add(*part)
        rows += zip(*(x.tolist() for x in part), strict=True)
        best.rows()
    want = [r for g in range(7) for r in sorted({r for r in rows if r[0] == g}, key=lambda r: (-r[1], r[2]))[:3]]
    assert [tuple(r) for r in best.rows().tolist()] == want
