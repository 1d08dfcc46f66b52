"""Spherical-cap links and components against brute force."""

import numpy as np
import pytest

from ebbline.llm import caps
from ebbline.llm.components import components

SCHEMA = "vec_id bigint, embedding array<float>, label int, first int, copies int, filter string"


def brute(rows, threshold):
    ids = [r[0] for r in rows]
    usable = [r for r in rows if r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    unit = {r[0]: np.array(r[1], np.float32).astype(float) for r in usable}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    label = {r[0]: r[2] for r in usable}
    near = {i: [] for i in ids}
    for a in unit:
        near[a] = [b for b in unit if b != a and label[a] == label[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold]
    out = {}
    for i in ids:
        seen, stack = {i}, [i]
        while stack:
            for j in near[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        out[i] = (len(near[i]), min(seen), min(seen) == i)
    return out


def made(size=64):
    draw = np.random.default_rng(5)
    rows, centre = [], draw.normal(size=(40, size))
    for i in range(700):
        v = centre[i % 40] + draw.normal(size=size) * draw.choice([0.05, 0.15, 0.22, 0.3, 1.0])
        rows.append((i, [float(x) for x in v.astype(np.float32)], i % 3))
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(60)]  # equal vectors
    rows += [(1100 + i, rows[5][1], (rows[5][2] + 1) % 3) for i in range(3)]  # the same under another label
    rows += [(2000, None, 1), (2001, [0.0] * size, 1), (2002, [float("nan")] + [1.0] * (size - 1), 1), (2003, [None] * size, 1)]
    rows += [(2004, rows[0][1], None), (2005, [], 1), (2006, [1.0, 2.0], 0), (2007, [2.0, 4.0], 0), (2008, [float("inf")] * size, 0)]
    return rows


@pytest.mark.parametrize("block", [512, 16])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(caps, "BLOCK", block)
    rows = made()
    frame = spark.createDataFrame([(*r, 1, 1, "clash") for r in rows], SCHEMA).repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in caps.near_duplicates(frame).collect()}
    want = brute(rows, caps.THRESHOLD)
    assert set(got) == set(want)
    links = sum(w[0] for w in want.values())
    found = sum(g[0] for g in got.values())
    assert links > 5000 and all(got[i][0] <= want[i][0] for i in want)
    assert found >= 0.995 * links
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)


def test_recall_at_the_threshold():
    """Pairs just above the threshold, which are the hardest, share a filter."""
    draw = np.random.default_rng(2)
    a = draw.normal(size=(400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = draw.normal(size=a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.931 * a + np.sqrt(1 - 0.931**2) * side
    shape = caps.code_shape(50_000)
    left, right = caps.decode(a, *shape), caps.decode(b, *shape)
    assert np.mean([len(np.intersect1d(x, y)) > 0 for x, y in zip(left, right)]) >= 0.99
    assert 0.5 * caps.PASSED <= np.mean([len(x) for x in left]) <= 2 * caps.PASSED


def test_list_decoding_is_whole():
    draw = np.random.default_rng(3)
    a = draw.normal(size=(20, 30))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    for parts, words in ((2, 64), (3, 16)):
        rotation, codes = caps._code(30, parts, words)
        grid = np.stack([np.concatenate([codes[k][i] for k, i in enumerate(index)]) for index in np.ndindex(*[words] * parts)])
        goal = caps.height(30, parts, words)
        for mine, v in zip(caps.decode(a, parts, words), a @ rotation):
            want = np.flatnonzero(grid @ v >= goal)
            assert list(mine) == list(want) or not len(want) and len(mine) == 1


def test_nothing_to_compare(spark):
    assert caps.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_awkward_shapes(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    rest = [(3, 3), (5000, 4999), (5000, 4999)]
    got = {r.node: r.component for r in components(spark.createDataFrame(path + star + rest, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)} | {4999: 4999, 5000: 4999}
    assert got == want
