"""Exact nearest vectors by inner product with M-trees."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

#: Vectors of one tree, children of an inner node, vectors of a page, queries searched together.
TREE_SIZE, FANOUT, PAGE, QUERY_BLOCK = 16_384, 16, 64, 256
#: Queries that one task searches in one tree.
QUERY_CHUNK = 16_384


class Node:
    """A page or an inner node: its routing vector, covering radius, distance to the parent's routing vector."""

    __slots__ = ("center", "children", "norm", "norms", "parent_distance", "radius", "rows", "square", "to_center", "vectors")

    def __init__(self, center, parent_distance):
        self.center, self.parent_distance = center, parent_distance
        self.square = float(center @ center)
        self.children, self.radius, self.norm = [], 0.0, 0.0
        self.rows = self.vectors = self.norms = self.to_center = None


def built(x: np.ndarray, rows: np.ndarray, center: np.ndarray, parent_distance: float, rng) -> Node:
    """Bulk load: rows go to the nearest of some routing vectors; equal ones are dealt out evenly."""
    node = Node(center, parent_distance)
    distance = np.sqrt(((x[rows] - center) ** 2).sum(1))
    node.radius = float(distance.max(initial=0.0))
    norms = np.sqrt((x[rows] ** 2).sum(1))
    node.norm = float(norms.max(initial=0.0))
    if len(rows) <= PAGE:
        node.rows, node.vectors, node.norms, node.to_center = rows, x[rows], norms, distance
        return node
    routes = rng.choice(rows, FANOUT, replace=False)
    squares = (x[rows] ** 2).sum(1)[:, None] - 2 * x[rows] @ x[routes].T + (x[routes] ** 2).sum(1)[None, :]
    nearest = squares.argmin(1)
    if np.bincount(nearest, minlength=FANOUT).max() > 0.9 * len(rows):
        nearest = np.arange(len(rows)) * FANOUT // len(rows)
    for i, route in enumerate(routes):
        part = rows[nearest == i]
        if len(part):
            node.children.append(built(x, part, x[route], float(np.sqrt(((x[route] - center) ** 2).sum())), rng))
    return node


def bound(query_square: np.ndarray, query_norm: np.ndarray, least_distance: np.ndarray, norm: float | np.ndarray) -> np.ndarray:
    """No vector of norm up to ``norm`` at least ``least_distance`` away has a larger inner product with the query."""
    far = (query_square + norm**2 - least_distance**2) / 2
    return np.minimum(far, query_norm * norm) + 1e-6 * (1 + query_square + norm**2)


def search(root: Node, x: np.ndarray, ids: np.ndarray, rows_of: np.ndarray, q: np.ndarray, q_rows: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The best ``k`` rows for each query of a block: scores, ids and whether they are filled.

    Nodes wait in a queue by the best bound of any query; a node is opened for the queries whose current k-th
    score it could still reach. A child's routing distance is computed only where the stored distance to its parent
    cannot rule it out; the same holds for vectors of a page.
    """
    n = len(q)
    square = (q**2).sum(1)
    norm = np.sqrt(square)
    score = np.full((n, k), -np.inf)
    best = np.full((n, k), np.iinfo(np.int64).max)
    start = np.sqrt(np.maximum(square - 2 * q @ root.center + root.square, 0))
    turn = 0
    queue = [(-np.inf, turn, root, np.full(n, np.inf), start)]
    while queue:
        _, _, node, reach, distance = heapq.heappop(queue)
        live = np.flatnonzero(reach >= score[:, -1])
        if not len(live):
            continue
        if node.rows is not None:
            # Distances of the vectors to the page's routing vector, against the range of the queries' distances.
            least = np.maximum(np.maximum(node.to_center - distance[live].max(), distance[live].min() - node.to_center), 0)
            some = bound(square[live].max(), norm[live].max(), least, node.norms) >= score[live, -1].min()
            rows = node.rows[some]
            if not len(rows):
                continue
            found = q[live] @ node.vectors[some].T
            found[q_rows[live][:, None] == rows_of[rows][None, :]] = -np.inf
            better = (found >= score[live, -1:]).any(1)  # an equal score may have a smaller key
            live, found = live[better], found[better]
            if not len(live):
                continue
            scores = np.concatenate((score[live], found), 1)
            names = np.concatenate((best[live], np.broadcast_to(ids[rows], found.shape)), 1)
            order = np.lexsort((names, -scores), axis=-1)[:, :k]
            score[live] = np.take_along_axis(scores, order, 1)
            best[live] = np.take_along_axis(names, order, 1)
            continue
        for child in node.children:
            least = np.maximum(np.abs(distance[live] - child.parent_distance) - child.radius, 0)
            near = live[bound(square[live], norm[live], least, child.norm) >= score[live, -1]]
            if not len(near):
                continue
            inner = q[near] @ child.center
            away = np.full(n, np.inf)
            away[near] = np.sqrt(np.maximum(square[near] - 2 * inner + child.square, 0))
            reach_of = np.full(n, -np.inf)
            reach_of[near] = np.minimum(
                bound(square[near], norm[near], np.maximum(away[near] - child.radius, 0), child.norm),
                inner + norm[near] * child.radius + 1e-6 * (1 + square[near]),
            )
            if (reach_of >= score[:, -1]).any():
                turn += 1
                heapq.heappush(queue, (-reach_of.max(), turn, child, reach_of, away))
    return score, best


def matrix(bodies: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled with zeros."""
    out = np.zeros((len(bodies), width))
    for i, v in enumerate(bodies):
        out[i, : len(v)] = v
    return out


def top_inner(vectors: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For every row whose ``key`` is divisible by ``every`` the ``k`` other rows of the largest inner product.

    Components become floor(scale * x); ties go to the smaller key. Returns ``query_id``, ``rank`` (from 1),
    ``key``, ``score``. Rows whose key or vector is null, or whose vector holds a null or non-finite component, take
    no part. Rows that repeat a key are rows of their own (only the query's own row is left out); vectors of other
    lengths count as filled with zeros; scores are exact below 2^53. An empty table gives an empty one.

    Vectors are dealt evenly into trees, and every query visits every tree; where there are many queries, they
    come in chunks, each with its own copy of the tree's vectors. Results of the trees are merged by rank.
    """
    v = F.col(f"`{vector}`")
    sound = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    parts = F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))
    points = vectors.filter(sound & F.col(f"`{key}`").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").cast("long").alias("id"), parts.alias("v")
    )
    points = stored(points, "vectors")
    total, width = points.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    queries = points.filter(F.col("id") % every == 0).select(F.col("row").alias("q_row"), F.col("id").alias("q_id"), F.col("v").alias("q_v"))
    asked = queries.count() if total else 0
    trees, chunks = max(1, -(-total // TREE_SIZE)), max(1, -(-asked // QUERY_CHUNK))
    dealt = points.withColumn("tree", F.pmod(F.xxhash64("row"), F.lit(trees)))
    dealt = dealt.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    sent = queries.withColumn("chunk", F.pmod(F.xxhash64(F.lit(1), "q_row"), F.lit(chunks)).cast("int"))
    sent = sent.withColumn("tree", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(trees - 1).cast("long"))))

    def visit(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            left = left.sort_values("row")
            x = matrix(left["v"], width)
            ids, rows_of = left["id"].to_numpy(), left["row"].to_numpy()
            rng = np.random.default_rng(3)
            root = built(x, np.arange(len(x)), x.mean(0), 0.0, rng)
            q_all = matrix(right["q_v"], width)
            # Queries that look alike are searched together.
            routes = x[rng.choice(len(x), min(len(x), 64), replace=False)]
            right = right.iloc[np.argsort((q_all @ routes.T).argmax(1), kind="stable")]
            for at in range(0, len(right), QUERY_BLOCK):
                block = right.iloc[at : at + QUERY_BLOCK]
                score, best = search(root, x, ids, rows_of, matrix(block["q_v"], width), block["q_row"].to_numpy(), k)
                i, j = np.nonzero(np.isfinite(score))
                out.append(
                    pd.DataFrame({"row": block["q_row"].to_numpy()[i], "query_id": block["q_id"].to_numpy()[i], "id": best[i, j], "score": score[i, j].astype(np.int64)})
                )
        return pd.concat(out) if out else pd.DataFrame({n: np.zeros(0, np.int64) for n in ("row", "query_id", "id", "score")})

    found = dealt.groupBy("tree", "chunk").cogroup(sent.groupBy("tree", "chunk")).applyInPandas(visit, "row long, query_id long, id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
