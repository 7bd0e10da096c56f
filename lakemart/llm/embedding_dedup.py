"""Near-duplicate embeddings by collision-counting projections.

Unit vectors are projected on many random directions. Two vectors at the least cosine that
links them lie a distance d apart, and their projections differ by a normal number of
deviation d, whatever their dimension. A tile of vectors keeps every projection sorted; a
query cuts from each sorted list the window that is centred on its own value, and every
vector in a window collides with it once. Vectors with enough collisions are compared by
their exact cosine. The windows' half width and the least count are calibrated: at the least
cosine, the count is reached with the probability ``recall``, nearer pairs reach it oftener.

On the cluster, vectors of one label and length share a cell of a grid over the first
projections; the number of these grows with the logarithm of the largest label, so that cells
stay about as full at any size. A query visits each cell that a second, wider window
(calibrated by the same recall) touches. A cell of more than ``TILE`` vectors is dealt to
several tiles, and a query visits them all: a task holds one tile, and queries stream past
it in batches, so that no label, cell or cluster has to fit a task. Links don't leave a task
one by one: a tile returns each query's number of links, and edges of a spanning forest, at
most one for each query and each vector of the tile.

Equal vectors of a label are one class, which its least id stands for; n_links counts copies.
Vectors that are null, empty, zero or hold a null or non-finite component, and rows without a
label, link with nothing and stand for themselves. Vectors are compared with those of their
own length. Rows of one id count as one vector, the least (label, vector) of them. A row
without an id links with nothing; it has no component and is kept. Other columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import bounded_batches, stored
from lakemart.llm.components import components

#: Vectors of a tile; queries that are counted at once.
TILE, TOGETHER = 2048, 32
#: Share of a label's vectors that are left in a cell by each projection of the grid, about.
THINNED = 0.4


@dataclass(frozen=True)
class Settings:
    """``projections`` are counted, each with a window of ``width`` deviations to either side;
    ``recall`` is the share of pairs at exactly the least cosine that must be found."""
    projections: int = 24
    width: float = 1.5
    recall: float = 0.999


def least_count(n: int, p: float, recall: float) -> int:
    """The greatest count that a binomial variable (n, p) reaches with the probability ``recall``."""
    tail = 0.0
    for k in range(n, 0, -1):
        tail += math.comb(n, k) * p ** k * (1 - p) ** (n - k)
        if tail >= recall:
            return k
    return 1


class Calibration:
    """Window widths and the least count for a least cosine, and the directions."""

    def __init__(self, cosine: float, levels: int, settings: Settings):
        apart = math.sqrt(max(2 - 2 * cosine, 1e-12))
        missed, normal = (1 - settings.recall) / 2, NormalDist()  # half for the grid, half for the count
        self.half = settings.width * apart
        inside = 2 * normal.cdf(settings.width) - 1
        self.least = least_count(settings.projections, inside, 1 - missed)
        self.reach = -normal.inv_cdf(missed / max(1, levels) / 2) * apart
        self.cell = 2 * self.reach
        self.levels, self.projections = levels, settings.projections

    def directions(self, length: int) -> np.ndarray:
        """Random directions for vectors of a length: those of the grid, then those counted."""
        return np.random.default_rng([7, length]).standard_normal((length, self.levels + self.projections)).astype(np.float32)


def usable(vector: str) -> Column:
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(x.isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision, safe against overflow and underflow."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Tile:
    """Vectors (unit rows) with their sorted projections; answers queries, batch by batch."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, vectors: np.ndarray, cosine: float, cal: Calibration):
        self.ids, self.weights, self.v, self.cosine, self.cal = ids, weights, vectors, cosine, cal
        self.lines = cal.directions(vectors.shape[1])[:, cal.levels:]
        values = vectors.astype(np.float32) @ self.lines
        self.order = np.argsort(values, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.take_along_axis(values, self.order.T, 0).T.copy()
        self.root = np.arange(len(ids))  # of each vector, in the forest of this tile's links

    def candidates(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, vector) positions of pairs with enough collisions."""
        values = queries.astype(np.float32) @ self.lines
        rows, n = np.arange(len(queries)), len(self.ids)
        counts = np.zeros(len(queries) * n, np.int64)
        for j, (line, order) in enumerate(zip(self.sorted, self.order)):
            low = np.searchsorted(line, values[:, j] - self.cal.half, side="left")
            high = np.searchsorted(line, values[:, j] + self.cal.half, side="right")
            inside = high - low
            at = np.arange(int(inside.sum())) + np.repeat(low - np.cumsum(inside) + inside, inside)
            counts += np.bincount(np.repeat(rows * n, inside) + order[at], minlength=len(counts))
        return np.divmod(np.flatnonzero(counts >= self.cal.least), n)

    def answer(self, ids: np.ndarray, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(u, v, n): the number n of links that u has with this tile, and an edge of the forest."""
        for i in range(0, len(ids), TOGETHER):
            own, x = ids[i:i + TOGETHER], vectors[i:i + TOGETHER]
            q, c = self.candidates(x)
            linked = (np.einsum("xd,xd->x", x[q], self.v[c]) >= self.cosine) & (own[q] != self.ids[c])
            q, c = q[linked], c[linked]
            if not len(q):
                continue
            n = np.bincount(q, weights=self.weights[c], minlength=len(own)).astype(np.int64)
            before = self.root.copy()
            name = np.full(len(own), len(self.ids))  # of each query: the least root that it is linked to
            while True:  # queries and trees take the least root that a link shows them
                np.minimum.at(name, q, self.root[c])
                least = np.arange(len(self.ids))
                np.minimum.at(least, self.root[c], name[q])
                root = least[self.root]
                root = root[root]
                if (root == self.root).all():
                    break
                self.root = root
            has = np.flatnonzero(n)
            yield own[has], self.ids[name[has]], n[has]
            moved = np.unique(before[before != self.root])
            if len(moved):
                yield self.ids[moved], self.ids[self.root[moved]], np.zeros(len(moved), np.int64)


_PAIRS = "u long, v long, n long"


def _cells(classes: DataFrame, cal: Calibration) -> DataFrame:
    """Classes with the cell that holds them and the cells that a query from them must visit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["label", "length", "rep", "copies", "vector", "cell", "visits"]
        corners = np.array(np.meshgrid(*[(0, 1)] * cal.levels)).reshape(cal.levels, -1).T
        for b in batches:
            lengths = b.column(1).to_numpy()
            for length in np.unique(lengths):
                rows = b.filter(pa.array(lengths == length))
                value = unit(_matrix(rows.column(4))).astype(np.float32) @ cal.directions(int(length))[:, :cal.levels]
                cell = np.floor(value / cal.cell).astype(np.int64)
                low = np.floor((value - cal.reach) / cal.cell).astype(np.int64)
                high = np.floor((value + cal.reach) / cal.cell).astype(np.int64)
                both = high > low  # a window is as wide as a cell: it touches two of them at most
                wanted = (corners[None] <= both[:, None]).all(2)
                visits = [[_name(c) for c in (lo + corners[w]).tolist()] for lo, w in zip(low, wanted)]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array([_name(c) for c in cell.tolist()], pa.string()), pa.array(visits, pa.list_(pa.string()))],
                    names=names)

    kind = dict(classes.dtypes)
    return classes.select("label", "length", "rep", "copies", "vector").mapInArrow(
        run, f"label {kind['label']}, length int, rep long, copies long, vector {kind['vector']}, cell string, visits array<string>")


def _name(cell: list[int]) -> str:
    return ",".join(map(str, cell))


def links(classes: DataFrame, cosine: float, settings: Settings = Settings()) -> DataFrame:
    """(u, v, n) rows over stored ``classes`` (label, length, rep, copies, vector): the sum of n
    is the number of vectors that u links to outside its class, and the pairs (u, v) join the
    same components as all links."""
    spark = classes.sparkSession
    bounded_batches(spark)
    most = classes.groupBy("label", "length").count().agg(F.max("count")).first()[0] or 0
    levels = max(0, math.ceil(math.log(max(1, most / (4 * TILE))) / -math.log(THINNED)))
    cal = Calibration(cosine, levels, settings)
    placed = (stored(_cells(classes, cal), "cells") if levels else
              classes.withColumn("cell", F.lit("")).withColumn("visits", F.array(F.lit(""))))
    spaces = ["label", "length", "cell"]
    tiles = stored(placed.groupBy(*spaces).agg(F.ceil(F.count("*") / F.lit(TILE)).cast("int").alias("tiles")), "tiles")
    every = tiles.agg(F.sum("tiles")).first()[0] or 0
    deal = F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")
    held = placed.drop("visits").join(tiles, spaces).select(
        *spaces, deal.alias("tile"), F.lit(False).alias("asks"), "rep", "copies", "vector")
    asking = (placed.select("label", "length", F.explode("visits").alias("cell"), "rep", "copies", "vector").join(tiles, spaces)
              .select(*spaces, F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), F.lit(True).alias("asks"),
                      "rep", "copies", "vector"))
    place = F.xxhash64(*spaces, "tile")

    def serve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, tile = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            keys = list(zip(*(b.column(k).to_pylist() for k in range(5))))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                if keys[lo][:4] != at:
                    at, parts, tile = keys[lo][:4], [], None
                rows = b.slice(lo, hi - lo)
                ids, x = rows.column(5).to_numpy(), unit(_matrix(rows.column(7)))
                if not keys[lo][4]:
                    parts.append((ids, rows.column(6).to_numpy(), x))
                    continue
                if tile is None:
                    if not parts:  # hashing leaves a tile empty now and then
                        continue
                    tile = Tile(*(np.concatenate(p) for p in zip(*parts)), cosine, cal)
                for u, v, n in tile.answer(ids, x):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(n)], names=["u", "v", "n"])

    return (held.union(asking).repartition(max(1, min(10_000, 2 * every)), place)
            .sortWithinPartitions(*spaces, "tile", "asks").mapInArrow(serve, _PAIRS))


def near_duplicates(vectors: DataFrame, cosine: float = 0.98, settings: Settings = Settings(), id_col: str = "vec_id",
                    label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links (other vectors linked to directly), component_id (least vec_id that links
    reach, itself included) and kept (vec_id = component_id) of every vector."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    one = rows.filter("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r"))
    one = one.select("vec_id", "r.label", "r.vector", (usable("r.vector") & F.col("r.label").isNotNull()).alias("takes_part"))
    compared = one.filter("takes_part")
    classes = stored(compared.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
                     .select("label", F.size("vector").alias("length"), "rep", "copies", "vector"), "classes")
    found = stored(links(classes, cosine, settings), "links")
    counts = found.groupBy("u").agg(F.sum("n").alias("n"))
    comp = components(found.select("u", "v"))
    of_class = (classes.join(counts, F.col("rep") == F.col("u"), "left").join(comp, F.col("rep") == F.col("node"), "left")
                .select("label", "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
                        F.coalesce("component", "rep").alias("component_id")))
    linked = compared.join(of_class, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = lambda df, component: df.select("vec_id", F.lit(0).cast("long").alias("n_links"), component.alias("component_id"))
    every = (linked.unionByName(alone(one.filter("NOT takes_part"), F.col("vec_id")))
             .unionByName(alone(rows.filter("vec_id IS NULL"), F.lit(None).cast("long"))))
    return every.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
