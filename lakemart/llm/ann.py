"""Approximate nearest neighbours by a robust-pruned directed graph, one for each shard.

The vectors are dealt to shards by hash. Each shard builds its graph in rising batches: a
greedy search over the graph so far proposes the nodes that it visited as neighbours of a new
vector, relaxed distance pruning keeps a few diverse ones (a candidate goes if it lies, times
``alpha``, nearer to a neighbour already kept), and the kept ones link back, pruned the same
way. Queries follow the vectors into every shard in batches, walk its graph with a beam, and
return each shard's best with their exact cosine; the best of all shards are the answer.

The number of shards grows with the square root of the vectors (and keeps a shard below
``SHARD_MOST``), so graphs and the number of searches grow evenly. All vectors are indexed. Equal
vectors are one node; the least ids of each group, one more than a query asks for, stand for
it, which is exact, since no query can return more of them.

Vectors that are null, zero, or hold a null or non-finite component take no part, as vectors
or as queries. Vectors are compared with those of their own length. Of several rows of one id
the least vector counts. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import bounded_batches, stored

SHARD_MOST = 1 << 20
#: A shard has about this many times the square root of all vectors.
SHARD = 32


@dataclass(frozen=True)
class Settings:
    """``degree``: edges of a node. ``build_beam``, ``beam``: nodes that a search keeps while
    building and while querying. ``alpha``: relaxation of the pruning (of distances)."""
    degree: int = 32
    build_beam: int = 64
    beam: int = 160
    alpha: float = 1.2


class Graph:
    """Directed graph over unit vectors (float32); distance is 1 - cosine."""

    #: Nodes that a search expands at once; cells of the visited table that a batch may have.
    STEP, CELLS = 4, 1 << 25

    def __init__(self, vectors: np.ndarray, settings: Settings = Settings()):
        self.v, self.s = np.ascontiguousarray(vectors, np.float32), settings
        n = len(self.v)
        self.out = np.full((n, settings.degree), -1, np.int32)
        self.degree = np.zeros(n, np.int32)
        order = np.random.default_rng(0).permutation(n)
        if n:
            middle = int(np.argmax(self.v @ self.v.mean(0)))
            order = np.append(middle, order[order != middle])
            self.start = middle
        done, batch = 1, 1
        while done < n:
            batch = min(max(1, done), max(64, n // 50), self._batch(), n - done)
            self._insert(order[done:done + batch])
            done += batch

    def _batch(self) -> int:
        return max(16, min(512, self.CELLS // max(1, len(self.v))))

    def _insert(self, nodes: np.ndarray) -> None:
        _, _, visited = self._walk(self.v[nodes], self.s.build_beam, visits=True)
        kept = self._prune(nodes, visited)
        self.out[nodes] = kept
        self.degree[nodes] = (kept >= 0).sum(1)
        to, frm = kept.ravel(), np.repeat(nodes, kept.shape[1])
        to, frm = to[to >= 0], frm[to >= 0]
        order = np.argsort(to, kind="stable")
        to, frm = to[order], frm[order]
        targets, first, count = np.unique(to, return_index=True, return_counts=True)
        nth = np.arange(len(to)) - np.repeat(first, count)
        fits = np.repeat(self.degree[targets] + count <= self.s.degree, count)
        self.out[to[fits], self.degree[to[fits]] + nth[fits]] = frm[fits]
        whole = self.degree[targets] + count <= self.s.degree
        self.degree[targets[whole]] += count[whole].astype(np.int32)
        crowded = targets[~whole]
        for i in range(0, len(crowded), 256):
            some = crowded[i:i + 256]
            width = int(count[~whole][i:i + 256].max())
            new = np.full((len(some), width), -1, np.int32)
            at = np.searchsorted(some, to)
            mine = (at < len(some)) & (some[np.minimum(at, len(some) - 1)] == to)
            new[at[mine], nth[mine]] = frm[mine]
            kept = self._prune(some, np.concatenate([self.out[some], new], 1))
            self.out[some] = kept
            self.degree[some] = (kept >= 0).sum(1)

    def _prune(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Diverse neighbours of each node: nearest first, without what a kept one dominates."""
        kept = np.full((len(nodes), self.s.degree), -1, np.int32)
        c = np.sort(candidates, 1)
        bad = (c < 0) | (c == nodes[:, None])
        bad[:, 1:] |= c[:, 1:] == c[:, :-1]
        x = self.v[np.maximum(c, 0)]
        far = 1 - np.einsum("bmd,bd->bm", x, self.v[nodes])
        left = np.where(bad, np.inf, far)
        rows, relax = np.arange(len(nodes)), self.s.alpha ** 2  # distances go with the root of 1 - cosine
        for k in range(self.s.degree):
            best = left.argmin(1)
            some = np.isfinite(left[rows, best])
            if not some.any():
                break
            kept[some, k] = c[rows, best][some]
            between = 1 - np.einsum("bmd,bd->bm", x, x[rows, best])
            left[(relax * between <= far) & some[:, None]] = np.inf
            left[rows, best] = np.inf
        return kept

    def _walk(self, queries: np.ndarray, beam: int, visits: bool = False):
        """Beam search of several queries in step: ids and distances of the beams, and the visited nodes."""
        b, n = len(queries), len(self.v)
        ids, far = np.full((b, beam), -1, np.int32), np.full((b, beam), np.inf, np.float32)
        open_ = np.zeros((b, beam), bool)
        seen = np.zeros((b, n), bool)
        ids[:, 0], open_[:, 0] = self.start, True
        far[:, 0] = 1 - queries @ self.v[self.start]
        seen[:, self.start] = True
        live, visited = np.arange(b), []
        while len(live):
            cost = np.where(open_[live], far[live], np.inf)
            step = min(self.STEP, beam)
            pick = np.argpartition(cost, step - 1, 1)[:, :step] if step < beam else np.argsort(cost, 1)[:, :step]
            ok = np.isfinite(np.take_along_axis(cost, pick, 1))
            go = ok.any(1)
            live, pick, ok = live[go], pick[go], ok[go]
            if not len(live):
                break
            node = np.where(ok, np.take_along_axis(ids[live], pick, 1), -1)
            open_[live[:, None], pick] = False
            if visits:
                column = np.full((b, step), -1, np.int32)
                column[live] = node
                visited.append(column)
            near = np.where(node[:, :, None] >= 0, self.out[np.maximum(node, 0)], -1).reshape(len(live), -1)
            near.sort(1)
            fresh = near >= 0
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            at = np.maximum(near, 0)
            fresh &= ~seen[live[:, None], at]
            r, k = np.nonzero(fresh)
            found = near[r, k]
            seen[live[r], found] = True
            d = np.full(near.shape, np.inf, np.float32)
            d[r, k] = 1 - np.einsum("xd,xd->x", self.v[found], queries[live[r]])
            every_d = np.concatenate([far[live], d], 1)
            every = np.concatenate([ids[live], near], 1)
            every_open = np.concatenate([open_[live], fresh], 1)
            best = np.argpartition(every_d, beam - 1, 1)[:, :beam]
            far[live] = np.take_along_axis(every_d, best, 1)
            ids[live] = np.take_along_axis(every, best, 1)
            open_[live] = np.take_along_axis(every_open, best, 1)
        ids = np.where(np.isfinite(far), ids, -1)
        return ids, far, np.concatenate([*visited, ids], 1) if visits else None

    def search(self, queries: np.ndarray, k: int) -> np.ndarray:
        """Positions of the ``k`` nearest found for each query (-1 where there are fewer)."""
        out = np.full((len(queries), k), -1, np.int64)
        if not len(self.v):
            return out
        for i in range(0, len(queries), self._batch()):
            ids, far, _ = self._walk(queries[i:i + self._batch()], max(self.s.beam, k))
            order = np.argsort(far, 1, kind="stable")[:, :k]
            out[i:i + self._batch()] = np.take_along_axis(ids, order, 1)
        return out


def _usable(vector: str) -> Column:
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return x.isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column(4)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # neither overflow nor underflow below
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = (x.astype(np.float64) for x in (a, b))
    a, b = (np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1]) for x in (a, b))  # exact, and neither overflows
    return np.einsum("xd,xd->x", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))


def nearest(vectors: DataFrame, queries: Column, k: int = 5, settings: Settings = Settings(), id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score (cosine) of the ``k`` nearest found of each row that
    ``queries``, a condition on the id, selects; the row itself is no candidate."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = stored(vectors.filter(F.col(id_col).isNotNull() & _usable(vector_col))
                  .groupBy(F.col(id_col).cast("long").alias("vec_id")).agg(F.min(vector_col).alias("vector"))
                  .withColumn("query", queries), "vectors")
    light = rows.select("vec_id", F.xxhash64("vector").alias("a"), F.xxhash64(F.lit("other"), "vector").alias("b"),
                        F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("salt"))
    least = light
    for keys in (["a", "b", "salt"], ["a", "b"]):
        least = least.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy("vec_id"))).filter(F.col("n") <= k + 1)
    least = stored(least.select("a", "b", "vec_id", "n", F.min("vec_id").over(Window.partitionBy("a", "b")).alias("node")), "least")
    nodes = rows.join(least.filter("n = 1").select("vec_id"), "vec_id", "left_semi")
    count = least.filter("n = 1").count()
    shards = max(1, math.ceil(math.sqrt(count) / SHARD), math.ceil(count / SHARD_MOST))
    size = F.size("vector")
    dealt = nodes.select(size.alias("length"), F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"),
                         F.lit(False).alias("asks"), "vec_id", "vector")
    asked = rows.filter("query").select(size.alias("length"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                                        F.lit(True).alias("asks"), "vec_id", "vector")
    found_each = 2 * (k + 1)

    def serve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, parts, graph, raw = None, [], [], None, None
        for b in batches:
            keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if keys[lo][:2] != at:
                    at, ids, parts, graph, raw = keys[lo][:2], [], [], None, None
                rows = b.slice(lo, hi - lo)
                x, own = _matrix(rows), rows.column(3).to_numpy()
                if not keys[lo][2]:
                    ids.append(own)
                    parts.append(x)
                    continue
                if graph is None:
                    raw = np.concatenate(parts) if parts else np.zeros((0, at[0]), x.dtype)
                    named = np.concatenate(ids) if ids else np.zeros(0, np.int64)
                    graph = Graph(_unit(raw) if len(raw) else raw, settings)
                hit = graph.search(_unit(x), found_each)
                q, c = np.nonzero(hit >= 0)
                node = hit[q, c]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[q]), pa.array(named[node]), pa.array(_cosine(x[q], raw[node]))], names=["query_id", "node", "score"])

    hits = (dealt.union(asked).repartitionById(shards, "shard").sortWithinPartitions("length", "shard", "asks")
            .mapInArrow(serve, "query_id long, node long, score double"))
    groups = least.filter("n > 1 OR node <> vec_id").select("node").distinct()
    several = least.join(groups, "node", "left_semi").select("node", "vec_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.join(several, "node", "left")
            .select("query_id", F.coalesce("vec_id", "node").alias("vec_id"), "score").filter("query_id <> vec_id")
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
