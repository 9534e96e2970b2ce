import numpy as np
import pytest

from tallyho.llm import cover_tree as C

SCHEMA = "vec_id long, embedding array<float>, label int, node long, cell int, n string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, "x") for r in rows], SCHEMA)


def brute(rows, t=0.98):
    n = len(rows)
    parent, links = list(range(n)), [0] * n

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def good(r):
        return (r[1] is not None and r[2] is not None and all(c is not None and np.isfinite(c) for c in r[1]) and any(r[1]))

    vec = [np.array(r[1], np.float32).astype(np.float64) if good(r) else None for r in rows]
    for i in range(n):
        for j in range(i):
            if vec[i] is None or vec[j] is None or rows[i][2] != rows[j][2] or len(vec[i]) != len(vec[j]):
                continue
            if vec[i] @ vec[j] / (np.linalg.norm(vec[i]) * np.linalg.norm(vec[j])) >= t:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    names = {}
    for i in range(n):
        if rows[i][0] is not None:
            names[root(i)] = min(names.get(root(i), rows[i][0]), rows[i][0])
    out = []
    for i in range(n):
        c = names.get(root(i)) if vec[i] is not None else rows[i][0]
        out.append((rows[i][0], links[i], c, rows[i][0] is not None and rows[i][0] == c))
    return sorted(out, key=repr)


def found(spark, rows):
    return sorted((tuple(r) for r in C.near_duplicates(table(spark, rows)).collect()), key=repr)


def cloud(seed, n, dim=16, labels=2):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, dim))
    rows = []
    for i in range(n):
        v = base[i % len(base)] + rng.normal(size=dim) * rng.choice([0, 0.02, 0.1, 0.25, 1.0])
        rows.append((i, [float(x) for x in np.float32(v)], int(i % len(base) % labels)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = cloud(seed, 300)
    assert found(spark, rows) == brute(rows)


def test_equals_brute_force_over_cells(spark, monkeypatch):
    monkeypatch.setattr(C, "CELL", 25)
    monkeypatch.setattr(C, "LEAF", 3)
    rows = cloud(4, 400, dim=4, labels=1)
    assert found(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    v, w = [1.0, 2.0, 3.0], [1.0, 2.0, 3.05]
    rows = [(1, v, 0), (2, v, 0), (2, v, 0), (3, w, 0), (4, v, None), (5, None, 0), (6, [0.0, 0.0, 0.0], 0), (7, [1.0, None, 2.0], 0),
            (8, [float("nan"), 1.0, 1.0], 0), (9, [float("inf"), 1.0, 1.0], 0), (None, v, 0), (None, [5.0, -1.0, 0.0], 0),
            (10, [], 0), (11, [1.0, 2.0], 0), (12, [2.0, 4.0], 0), (13, [-1.0, -2.0, -3.0], 0), (14, v, 1)]
    assert found(spark, rows) == brute(rows)


def test_empty_table_and_threshold(spark):
    assert found(spark, []) == []
    with pytest.raises(ValueError):
        C.near_duplicates(table(spark, []), threshold=1.5)


def test_tree_covers_and_traversal_meets_each_pair_once():
    x = np.random.default_rng(0).normal(size=(300, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = C.build(x, np.arange(300))

    def walk(ball, most):
        assert np.sqrt(np.maximum(0, 2 - 2 * x[ball.rows] @ x[ball.centre])).max() <= ball.radius + C._SLACK
        if ball.children:
            assert sorted(np.concatenate([c.rows for c in ball.children])) == sorted(ball.rows)
        for c in ball.children:
            walk(c, ball.radius)

    walk(tree, 2.0)
    seen = {}
    for a, b, every in C.traverse(x, tree, tree, 0.4):
        for i in a:
            for j in b:
                if i != j:
                    key = (min(i, j), max(i, j))
                    seen.setdefault(key, set()).add((id(a), id(b)))
    d = np.sqrt(np.maximum(0, 2 - 2 * x @ x.T))
    close = {(i, j) for i in range(300) for j in range(i + 1, 300) if d[i, j] <= 0.4}
    assert close <= set(seen) and all(len(v) == 1 for v in seen.values())
    assert len(seen) < 300 * 299 // 2  # some pairs of balls were pruned


@pytest.mark.parametrize("kind, labels", [("double", [1.2, 1.7, 1.2, float("nan"), float("nan")]), ("string", ["a", "b", "a", "", ""])])
def test_labels_of_any_type(spark, monkeypatch, kind, labels):
    """Equal labels only: they are compared as they are. Small cells, so that seeds are drawn."""
    monkeypatch.setattr(C, "CELL", 2)
    v = [1.0, 2.0, 3.0]
    rows = [(i, v if i % 2 else [x + 1e-4 * i for x in v], x) for i, x in enumerate(labels * 3)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")
    got = {r.vec_id: (r.n_links, r.component_id) for r in C.near_duplicates(df).collect()}
    name = lambda i: str(rows[i][2])
    same = {i: [j for j in range(len(rows)) if name(j) == name(i)] for i in range(len(rows))}
    assert got == {i: (len(s) - 1, min(s)) for i, s in same.items()}
