"""Approximate nearest neighbours by cosine: a robust-pruned directed graph for each shard."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written


class Graph:
    """Vectors of length one with at most ``degree`` out-edges each, and the node where searches begin."""

    def __init__(self, units: np.ndarray, edges: np.ndarray):
        self.units, self.edges = units, edges
        self.start = int(np.argmax(units @ units.mean(axis=0))) if len(units) else 0

    def beam(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and squared distances of the ``width`` best found for each query, nearest first.

        All queries advance together: each expands its nearest node that is not yet expanded,
        until none of its beam is left to expand.
        """
        m, n = len(queries), len(self.units)
        width = min(width, n)
        nodes = np.full((m, width), -1, dtype=np.int64)
        far = np.full((m, width), np.inf)
        done = np.zeros((m, width), dtype=bool)
        seen = np.zeros((m, n), dtype=bool)
        nodes[:, 0], far[:, 0] = self.start, 2 - 2 * (queries @ self.units[self.start])
        seen[:, self.start] = True
        active = np.arange(m)
        while len(active):
            left = np.where(done[active] | (nodes[active] < 0), np.inf, far[active])
            best = left.argmin(axis=1)
            going = np.isfinite(left[np.arange(len(active)), best])
            active, best = active[going], best[going]
            if not len(active):
                break
            done[active, best] = True
            near = self.edges[nodes[active, best]]
            fresh = (near >= 0) & ~seen[active[:, None], near]
            seen[active[:, None], np.where(near >= 0, near, self.start)] = True
            away = 2 - 2 * np.matmul(self.units[near], queries[active][:, :, None])[:, :, 0]
            away[~fresh] = np.inf
            all_far = np.concatenate([far[active], away], axis=1)
            all_nodes = np.concatenate([nodes[active], np.where(fresh, near, -1)], axis=1)
            all_done = np.concatenate([done[active], np.zeros_like(fresh)], axis=1)
            order = np.argsort(all_far, axis=1, kind="stable")[:, :width]
            rows = np.arange(len(active))[:, None]
            far[active], nodes[active], done[active] = all_far[rows, order], all_nodes[rows, order], all_done[rows, order]
        return nodes, far


def _prune(units: np.ndarray, node: int, others: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` of ``others``: nearest first, without those that a kept one is ``alpha`` times nearer to.

    Places that are left go to the nearest of those passed over, so nodes amid equals keep
    their nearest neighbours.
    """
    others = np.unique(others[others != node])
    if len(others) <= 1:
        return others
    far = 2 - 2 * (units[others] @ units[node])
    order = np.argsort(far, kind="stable")[: 4 * degree]
    others, far = others[order], far[order]
    between = 2 - 2 * (units[others] @ units[others].T)
    open_ = np.ones(len(others), dtype=bool)
    kept: list[int] = []
    for i in range(len(others)):
        if open_[i]:
            kept.append(i)
            if len(kept) == degree:
                break
            open_ &= alpha * alpha * between[i] > far
            open_[i] = False
    if len(kept) < degree:
        rest = np.setdiff1d(np.arange(len(others)), kept)[: degree - len(kept)]
        kept += rest.tolist()
    return others[kept]


def build_graph(units: np.ndarray, degree: int = 32, width: int = 64, alpha: float = 1.2, batch: int = 256, seed: int = 7) -> Graph:
    """A graph over unit vectors: two rounds over all nodes, in batches, first without relaxed pruning.

    Each node searches for itself, keeps a pruned choice of what it met, and is added to the
    nodes it chose, which are pruned when they have half as many edges again.
    """
    n = len(units)
    random = np.random.default_rng(seed)
    room = degree + degree // 2
    edges = np.full((n, room), -1, dtype=np.int64)
    if n > 1:
        edges[:, : min(degree, n - 1)] = random.integers(0, n, (n, min(degree, n - 1)))
    graph = Graph(units, edges)
    for relaxed in (1.0, alpha):
        order = random.permutation(n)
        for at in range(0, n, batch):
            nodes = order[at : at + batch]
            met, _ = graph.beam(units[nodes], width)
            for node, others in zip(nodes.tolist(), met, strict=True):
                chosen = _prune(units, node, np.concatenate([others[others >= 0], edges[node][edges[node] >= 0]]), degree, relaxed)
                edges[node] = -1
                edges[node, : len(chosen)] = chosen
                for other in chosen.tolist():
                    own = edges[other]
                    if (own == node).any():
                        continue
                    free = np.flatnonzero(own < 0)
                    if len(free):
                        own[free[0]] = node
                    else:
                        less = _prune(units, other, np.append(own, node), degree, relaxed)
                        own[:] = -1
                        own[: len(less)] = less
    return graph


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, so that its largest component is near 1: squares neither overflow nor vanish, and nothing is rounded but what is 300 digits smaller."""
    _, exponents = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -exponents[:, None])


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled vectors of length one, in double precision: distances of near copies are far below single precision."""
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def valid_vectors(table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id and vector (doubles), one row a vec_id; without null ids and vectors that have no direction.

    A vector that is null, empty or zero, or holds a null or non-finite component, is left
    out. Rows that share a vec_id count once, by the least of their vectors.
    """
    vector = table[vector_column].cast("array<double>")
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    return (
        table.select(table[id_column].cast("long").alias("vec_id"), vector.alias("vector"))
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(~bad & some)
        .groupBy("vec_id").agg(F.min("vector").alias("vector"))
    )


INDEX = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("node", T.LongType()), T.StructField("vec_ids", T.ArrayType(T.LongType())),
    T.StructField("vector", T.ArrayType(T.DoubleType())), T.StructField("edges", T.ArrayType(T.LongType())),
])
FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])


def build_index(vectors: DataFrame, nearest: int = 5, shard_rows: int = 8192, degree: int = 32, width: int = 64, alpha: float = 1.2) -> tuple[DataFrame, int]:
    """The written index over all ``vectors`` (vec_id, vector) and its number of shards.

    A vector goes to a shard by its hash, so equal vectors meet; they are one node, which
    names the ``nearest`` + 1 least of their ids, all that an answer can hold. Vectors of
    different lengths are never compared and are in different shards.
    """
    shards = max(1, -(-vectors.count() // shard_rows))
    low, high = F.xxhash64("vector"), F.xxhash64(F.lit(1), "vector")
    equals = Window.partitionBy("low", "high", "size").orderBy("vec_id")
    dealt = (
        vectors.withColumns({"low": low, "high": high, "size": F.size("vector")}).withColumn("place", F.row_number().over(equals)).where(F.col("place") <= nearest + 1)
        .withColumn("shard", F.col("size") * shards + F.pmod("low", F.lit(shards)))
    )

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id")
        part["bytes"] = [np.asarray(v, dtype=np.float64).tobytes() for v in part["vector"]]
        ids = part.groupby("bytes", sort=False)["vec_id"].agg(list)
        matrix = np.stack([np.frombuffer(b, dtype=np.float64) for b in ids.index])
        graph = build_graph(_unit(scaled(matrix)), degree, width, alpha)
        return pd.DataFrame({
            "shard": int(key[0]), "node": range(len(ids)), "vec_ids": ids.to_list(), "vector": list(matrix), "edges": [e[e >= 0] for e in graph.edges],
        })

    return written(dealt.groupBy("shard").applyInPandas(build, INDEX), "graph"), shards


def search(index: DataFrame, shards: int, queries: DataFrame, nearest: int = 5, width: int = 96, block_rows: int = 20_000) -> DataFrame:
    """query_id, rank, vec_id and score of the ``nearest`` others found for each row of ``queries``.

    Blocks of queries meet every shard of their vectors' length; each shard answers by beam
    search, and the answers of all shards are ranked by exact cosine, ties by vec_id.
    """
    blocks = max(1, -(-queries.count() // block_rows))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    size = F.size("vector")
    asked = queries.select("vec_id", "vector", block.alias("block"), F.explode(F.sequence(size * shards, size * shards + (shards - 1))).alias("shard")).withColumn("shard", F.col("shard").cast("long"))
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def answer(key: tuple, nodes: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(nodes) and len(asks):
            nodes = nodes.sort_values("node")
            matrix = scaled(np.stack(nodes["vector"].to_list()).astype(np.float64))
            norms = np.sqrt((matrix * matrix).sum(axis=1))
            edges = np.full((len(nodes), max(1, max(map(len, nodes["edges"])))), -1, dtype=np.int64)
            for row, own in zip(edges, nodes["edges"], strict=True):
                row[: len(own)] = own
            graph, ids = Graph(_unit(matrix), edges), nodes["vec_ids"].to_list()
            for at in range(0, len(asks), 256):
                some = asks.iloc[at : at + 256]
                wanted = scaled(np.stack(some["vector"].to_list()).astype(np.float64))
                met, _ = graph.beam(_unit(wanted), width)
                for query, vector, found in zip(some["vec_id"], wanted, met, strict=True):
                    found = found[found >= 0]
                    scores = (matrix[found] * vector).sum(axis=1) / (norms[found] * np.sqrt((vector * vector).sum()))
                    rows = [(-s, i) for s, f in zip(scores.tolist(), found, strict=True) for i in ids[f] if i != query]
                    out += [(query, i, -s) for s, i in sorted(rows)[:nearest]]
        return pd.DataFrame(out, columns=[f.name for f in FOUND])

    found = spread.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(answer, FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
