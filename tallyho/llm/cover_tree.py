"""Embedding near-duplicates by dual traversal of cover trees: exact threshold pairs.

Vectors are compared within their label. Equal vectors are one node with a
count, so copies are never paired with each other. On the unit sphere a cosine
of t is a distance of sqrt(2 - 2t).

A label's nodes are dealt to cells: seed vectors (picked by a hash, one for
about ``CELL`` nodes) each own the nodes nearest to them, and a node also
visits every cell whose border (the plane halfway between the two seeds) is
within that distance, so every pair meets in the cell that owns one of them.
A cell builds a cover tree: levels of halving radii, each node under one whose
ball holds it, every ball with its true covering radius. The dual traversal
drops a pair of balls when their centres are further apart than both radii and
the threshold distance together, and compares vectors only in pairs that
remain. A cell returns a count of links for each node and a spanning link for
each group it found, never the pairs.

Vectors at random angles lie about equally far from each other, so there the
bounds prune late and the distances within a label grow with the square of its
nodes, over the number of cells that a node need not visit.

Defined cases: null, empty, zero or non-finite vectors, vectors with a null
component and rows with a null label link with nothing (their component is
their own id); vectors of different sizes are never compared; rows with a null
id link like others, are never kept and never name a component; repeated rows
are copies; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, saved, small_batches, table

THRESHOLD = 0.98
#: Nodes that a cell owns, on average, about; more where the table has more than
#: ``SEEDS`` times as many.
CELL = 2048
#: Seeds over all labels, at most about: they are broadcast.
SEEDS = 16_384
#: Nodes of a leaf of the tree.
LEAF = 16
#: More than the rounding error of a distance, which is largest (2e-8) near 0.
_SLACK = 1e-7
_BLOCK = 128


class Ball:
    """A tree node: the row of its centre, the covering radius, all rows, children."""

    __slots__ = ("centre", "radius", "rows", "children")

    def __init__(self, centre: int, radius: float, rows: np.ndarray, children: list):
        self.centre, self.radius, self.rows, self.children = centre, radius, rows, children


def distances(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (x[a] @ x[b].T)))


def build(x: np.ndarray, rows: np.ndarray, reach: float = 2.0) -> Ball:
    """A cover tree over ``rows`` of the unit vectors ``x``: the centres of a level are
    further than its reach from each other, and the reach halves from level to level."""
    radius = float(distances(x, rows[:1], rows).max())
    if len(rows) <= LEAF or radius <= _SLACK:
        return Ball(int(rows[0]), radius, rows, [])
    while reach >= radius:
        reach /= 2
    children, rest = [], rows
    while len(rest):
        near = distances(x, rest[:_BLOCK], rest) <= reach
        free = np.ones(len(rest), bool)
        for i in range(len(near)):
            if free[i]:
                mine = near[i] & free
                mine[i] = True
                free &= ~mine
                children.append(build(x, rest[mine], reach / 2) if mine.sum() > 1 else Ball(int(rest[i]), 0.0, rest[i:i + 1], []))
        rest = rest[free]
    return Ball(int(rows[0]), radius, rows, children)


def traverse(x: np.ndarray, a: Ball, b: Ball, reach: float):
    """Pairs of row sets that may hold links: (rows, rows, all linked), each pair of
    rows met once. ``a`` and ``b`` are one tree or two trees over different rows."""
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if not a.children and not b.children:
            if a is not b or len(a.rows) > 1:
                yield a.rows, b.rows, False
            continue
        left, right = a.children or [a], b.children or [b]
        ra, rb = np.array([c.radius for c in left]), np.array([c.radius for c in right])
        ca, cb = np.array([c.centre for c in left]), np.array([c.centre for c in right])
        for at in range(0, len(left), 4 * _BLOCK):
            d = distances(x, ca[at:at + 4 * _BLOCK], cb)
            both = ra[at:at + 4 * _BLOCK, None] + rb
            for i, j in np.argwhere(d <= both + reach + _SLACK).tolist():
                p, q = left[at + i], right[j]
                if a is b and j < at + i or p is q and len(p.rows) == 1:
                    continue
                if p is not q and d[i, j] + both[i, j] <= reach - _SLACK:
                    yield p.rows, q.rows, True
                else:
                    todo.append((p, q))


class Links:
    """Counts of links and groups of linked rows of one cell. The first ``owned``
    rows belong to the cell, the others visit it and only count owned rows."""

    def __init__(self, raw: np.ndarray, weight: np.ndarray, owned: int, threshold: float):
        self.raw, self.weight, self.owned, self.threshold = raw, weight, owned, threshold
        self.norm = np.sqrt((raw * raw).sum(axis=1))
        self.unit = raw / self.norm[:, None]
        self.count = np.zeros(len(raw), np.int64)
        self.parent = list(range(len(raw)))

    def root(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)

    def add(self, a: np.ndarray, b: np.ndarray, every: bool) -> None:
        if every:
            linked = np.ones((len(a), len(b)), bool)
        else:
            linked = (self.raw[a] @ self.raw[b].T) / (self.norm[a][:, None] * self.norm[b]) >= self.threshold
            if a is b:
                np.fill_diagonal(linked, False)
        if not linked.any():
            return
        if b[0] < self.owned:  # one tree over the owned rows
            self.count[a] += linked @ self.weight[b]
            if a is not b:
                self.count[b] += linked.T @ self.weight[a]
        else:
            self.count[b] += linked.T @ self.weight[a]
        if every:
            for j in b.tolist():
                self.join(int(a[0]), j)
            for i in a.tolist():
                self.join(i, int(b[0]))
        else:
            for i, j in np.argwhere(linked).tolist():
                self.join(int(a[i]), int(b[j]))

    def find(self) -> None:
        reach = float(np.sqrt(2 - 2 * self.threshold)) + _SLACK
        tree = build(self.unit, np.arange(self.owned))
        for pair in traverse(self.unit, tree, tree, reach):
            self.add(*pair)
        if self.owned < len(self.raw):
            for pair in traverse(self.unit, tree, build(self.unit, np.arange(self.owned, len(self.raw))), reach):
                self.add(*pair)


def cell_links(threshold: float):
    def run(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(["visits", "node"], kind="stable")
        owned = int((~cell["visits"]).sum())
        node = cell["node"].to_numpy()
        if not owned:
            return pd.DataFrame({"node": node[:0], "n": node[:0], "root": node[:0]})
        links = Links(np.array(cell["vec"].tolist(), np.float64), cell["copies"].to_numpy(), owned, threshold)
        links.find()
        return pd.DataFrame({"node": node, "n": links.count, "root": node[[links.root(i) for i in range(len(node))]]})

    return run


def cells(nodes: DataFrame, threshold: float) -> DataFrame:
    """``nodes`` (label, dim, node, copies, vec) with the cells that they own or visit."""
    spark = nodes.sparkSession
    total = nodes.count()
    each = max(CELL, -(-total // SEEDS))
    large = nodes.groupBy("label", "dim").count().where(F.col("count") > each)  # SEEDS rows at most
    shares = [(r["label"], r["dim"], -(-r["count"] // each) / r["count"]) for r in large.collect()]
    seeds: dict[tuple, np.ndarray] = {}
    if shares:
        share = spark.createDataFrame(shares, nodes.select("label", "dim").schema.add("share", "double"))
        drawn = F.pmod(F.xxhash64(F.lit("seeds"), "node"), F.lit(1 << 30)) / float(1 << 30)
        picked = nodes.join(F.broadcast(share), ["label", "dim"]).where(drawn < F.col("share"))
        for r in picked.select("label", "dim", "node", "vec").orderBy("node").collect():  # about SEEDS at most
            seeds.setdefault((r["label"], r["dim"]), []).append(r["vec"])
    seeds = {k: np.array(v, np.float64) for k, v in seeds.items()}
    seeds = {k: v / np.linalg.norm(v, axis=1, keepdims=True) for k, v in seeds.items()}
    shared = spark.sparkContext.broadcast(seeds)
    reach = float(np.sqrt(2 - 2 * threshold)) + 1e-6
    schema = nodes.select("*").schema.add("cell", "integer").add("visits", "boolean")

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            cell, row, visits = [], [], []
            for key, part in f.groupby(["label", "dim"], sort=False, dropna=False):
                at = part.index.to_numpy()
                s = shared.value.get(key)
                if s is None:
                    row.append(at), cell.append(np.zeros(len(at), int)), visits.append(np.zeros(len(at), bool))
                    continue
                x = np.array(part["vec"].tolist(), np.float64)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                d = np.maximum(0, 2 - 2 * x @ s.T)  # squared distances to the seeds
                home = d.argmin(axis=1)
                apart = np.sqrt(np.maximum(0, 2 - 2 * s @ s.T))[home]
                # the distance to the plane halfway between two seeds
                goes = d - d[np.arange(len(x)), home][:, None] <= 2 * apart * reach + 1e-9
                i, j = np.nonzero(goes)
                row.append(at[i]), cell.append(j), visits.append(j != home[i])
            if row:
                out = f.loc[np.concatenate(row)].reset_index(drop=True)
                out["cell"], out["visits"] = np.concatenate(cell).astype(np.int32), np.concatenate(visits)
                yield out

    return nodes.mapInPandas(deal, schema)


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    if not 0 < threshold < 1:
        raise ValueError("the threshold must be between 0 and 1")
    small_batches(rows.sparkSession)
    v = F.col(vector)
    good = (F.col(label).isNotNull() & v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
            & F.exists(v, lambda c: c != 0))
    rows = rows.select(F.col(id_col).alias("vec_id"), F.col(label).alias("label"), v.alias("vec"),
                       F.coalesce(good, F.lit(False)).alias("good"))
    rows = rows.withColumn("node", F.when(F.col("good"), F.xxhash64("label", "vec")))
    nodes = saved(rows.where("good").groupBy("node").agg(
        F.first("label").alias("label"), F.first(F.size("vec")).cast("long").alias("dim"), F.first("vec").alias("vec"),
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
        .select("label", "dim", "node", "copies", "vec", "least"), "nodes")
    dealt = cells(nodes.drop("least"), threshold)
    found = saved(dealt.groupBy("label", "dim", "cell").applyInPandas(cell_links(threshold), "node long, n long, root long"), "cells")
    parts = connected_components(found.where("node <> root").selectExpr("node AS a", "root AS b"))
    least = nodes.select("node", "copies", "least").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    firsts = least.groupBy("component").agg(F.min("least").alias("component_id"))
    links = found.groupBy("node").agg(F.sum("n").alias("n"))
    info = least.join(firsts, "component").join(links, "node").selectExpr("node", "component_id", "n + copies - 1 AS n_links")
    out = rows.select("vec_id", "node").join(info, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
n AS (SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM v),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
r(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
m AS (SELECT x, min(y) AS component_id FROM r GROUP BY x),
k AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT m.x AS vec_id, coalesce(k.n_links, 0) AS n_links, m.component_id, m.x = m.component_id AS kept
FROM m LEFT JOIN k ON k.x = m.x
"""


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
