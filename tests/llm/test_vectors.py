import numpy as np

from flowquarry.llm import vectors


def brute(rows):
    """Links by all pairs."""
    good = {}
    for k, (_, v, label) in enumerate(rows):
        if v is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and rows[k][0] is not None:
            good[k] = np.array(v, dtype=np.float32).astype(float)
    near = {k: set() for k in range(len(rows))}
    for a in good:
        for b in good:
            if a != b and rows[a][2] == rows[b][2] and len(good[a]) == len(good[b]) and good[a] @ good[b] / np.sqrt(good[a] @ good[a]) / np.sqrt(good[b] @ good[b]) >= 0.98:
                near[a].add(b)
    out = []
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        low = rows[k][0] if rows[k][0] is None else min(rows[x][0] for x in seen)
        out.append((rows[k][0], len(near[k]), low, rows[k][0] is not None and low == rows[k][0]))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, rep string")


def test_equals_brute_force_with_a_crowded_cell(spark):
    rnd = np.random.default_rng(1)
    rows, k = [], 0
    for label in (0, 1):
        for _ in range(60):
            base = rnd.normal(size=16)
            for _ in range(int(rnd.integers(1, 4))):
                rows.append((k, [float(x) for x in np.float32(base + rnd.normal(size=16) * rnd.choice([0, 0.05, 0.2]))], label))
                k += 1
    hot = rnd.normal(size=16)
    rows += [(k + i, [float(x) for x in np.float32(hot + rnd.normal(size=16) * 0.08)], 1) for i in range(120)]
    found = vectors.near_duplicates(table(spark, rows), block=32).collect()
    assert sorted([tuple(r) for r in found], key=str) == brute(rows)


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [inf, 1.0], 0), (6, [nan, 1.0], 0), (7, [1.0, 2.0], None), (8, [1.0, 2.0], 0), (9, [2.0, 4.0], 0), (10, [1.0, 2.0, 0.0], 0), (11, [1e-30, 2e-30], 0), (12, [1e30, 2e30], 1), (8, [1.0, 2.0], 0), (None, [1.0, 2.0], 0), (13, [-1.0, -2.0], 0), (14, [5.0], 0)]
    found = vectors.near_duplicates(table(spark, rows)).collect()
    assert sorted([tuple(r) for r in found], key=str) == brute(rows)
    assert vectors.near_duplicates(table(spark, rows).limit(0)).count() == 0


def test_traversal_visits_cells_in_order_and_misses_none():
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(300, 8))
    centres = vectors.codebook(x, 9)
    near, low = vectors.bounds(x, centres)
    y = x + rnd.normal(size=x.shape) * 0.1
    of, _ = vectors.bounds(y, centres)
    assert (low[np.arange(300), of] <= ((x - y) ** 2).sum(axis=1) + 1e-9).all() and (low[np.arange(300), near] == 0).all()
    cells = vectors.multi_sequence(low[0], low[1], 0.5)
    sums = [low[0][a] + low[1][b] for a, b in cells]
    assert sums == sorted(sums) and len(cells) == sum(a + b <= 0.5 for a in low[0] for b in low[1])
