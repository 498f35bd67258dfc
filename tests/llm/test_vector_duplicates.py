import numpy as np

from millrace.llm import vector_duplicates as V


def test_dense_clusters_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 16)  # a cluster takes several blocks
    rng = np.random.default_rng(3)
    rows = []
    for c in range(6):
        center = rng.normal(size=24)
        for _ in range((3, 60, 10, 1, 25, 40)[c]):
            rows.append((len(rows), (center + rng.normal(size=24) * 0.12 * (1 + c % 2)).astype(np.float32).tolist(), c % 2))
    rows += [(900 + i, rows[5][1], 1) for i in range(40)] + [(5, rows[5][1], 1)]
    rows += [(1000, None, 1), (1001, [0.0] * 24, 1), (1002, [None] + [1.0] * 23, 1), (1003, [float("nan")] * 24, 1), (1004, rows[0][1], None), (None, rows[0][1], 0), (1005, [], 0), (1006, [1.0, 2.0], 0), (1007, [2.0, 4.0], 0), (1008, [1e-38] * 24, 0)]
    out = V.link(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    unit = []
    for _, v, label in rows:
        ok = bool(v) and label is not None and None not in v and np.isfinite(v).all() and np.any(v)
        unit.append(np.array(v, np.float64) / np.linalg.norm(v) if ok else None)
    n = len(rows)
    link = [[a != b and unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and float(unit[a] @ unit[b]) >= 0.93 for b in range(n)] for a in range(n)]
    component = [rows[i][0] for i in range(n)]
    for _ in range(n):
        new = [min([c for c in [component[a], *(component[b] for b in range(n) if link[a][b])] if c is not None], default=None) for a in range(n)]
        if new == component:
            break
        component = new
    want = sorted(((rows[i][0], sum(link[i]), component[i]) for i in range(n)), key=str)
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out), key=str) == want
    assert all(r["recall"] == 1 for r in out)


def test_empty(spark):
    assert V.link(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_links_between_groups_whose_lists_stay_inside(spark):
    rng = np.random.default_rng(4)
    axes = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    half = np.arccos(0.96) / 2
    centers = [np.cos(half) * axes[0] + np.sin(half) * s * axes[1] for s in (1, -1)]
    x = np.array([c + rng.normal(size=64) * 0.008 for c in centers for _ in range(200)]).astype(np.float32).astype(np.float64)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    s = unit @ unit.T
    np.fill_diagonal(s, -1)
    near = np.argsort(-s, axis=1)[:, : 16 * V.LIST]
    assert (near // 200 == np.arange(400)[:, None] // 200).all() and (s[:200, 200:] >= V.THRESHOLD).all()
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(1000 + i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(90, 64)))]
    out = V.link(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out} == {i: (int((s[i] >= V.THRESHOLD).sum()), 0) if i < 400 else (0, i) for i, _, _ in rows}


def test_many_vectors_equal_brute_force(spark):
    """Hyperplane cells are in use, groups saturate both list lengths, pairs lie right above and below the threshold."""
    rng = np.random.default_rng(8)
    x, label = [rng.normal(size=64) for _ in range(3000)], list(rng.integers(0, 3, 3000))
    for i in range(400):  # pairs at a given cosine
        a, side = x[i] / np.linalg.norm(x[i]), rng.normal(size=64)
        side -= (side @ a) * a
        c = rng.uniform(0.92, 0.96)
        x.append(c * a + np.sqrt(1 - c * c) * side / np.linalg.norm(side))
        label.append(label[i])
    for size, spread in ((25, 0.02), (120, 0.025), (300, 0.015), (30, 0.035), (700, 0.04)):
        center = rng.normal(size=64)
        center /= np.linalg.norm(center)
        x += [center + rng.normal(size=64) * spread for _ in range(size)]
        label += [1] * size
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label, strict=True))]
    out = {r["vec_id"]: r for r in V.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", V.F.lit(1)).withColumn("unit", V.F.lit(1))).collect()}
    u = np.array(x) / np.linalg.norm(x, axis=1)[:, None]
    link = (u @ u.T >= V.THRESHOLD) & (np.array(label)[:, None] == np.array(label)[None, :])
    np.fill_diagonal(link, False)
    found = sum(min(out[i]["n_links"], int(n)) for i, n in enumerate(link.sum(1)))
    assert found >= 0.999 * link.sum()
    assert all(out[i]["n_links"] <= n for i, n in enumerate(link.sum(1)))
    assert out[0]["recall"] >= 0.99
    root = V._roots(len(x), *np.nonzero(link))
    assert sum(out[i]["component_id"] == root[i] for i in range(len(x))) >= 0.995 * len(x)


def test_recall_is_null_where_nothing_is_measured(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).tolist() if i else None, 0) for i in range(1, 40)]
    assert {r["recall"] for r in V.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()} == {None}
