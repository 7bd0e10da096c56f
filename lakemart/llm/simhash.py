"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints are sorted by Gray rank, in which neighbours differ in few bits. Groups of
neighbours form a tree: a node keeps, as mask and pattern, the bits that all fingerprints
below it share and that no node above it has named yet. On the way down the differences to a
query on these bits add up, and a whole group is dropped as soon as they exceed the limit.

On the cluster, the distinct fingerprints are cut at quantiles of the Gray rank into blocks;
the blocks' own shared bits are the tree's upper nodes and rule out pairs of blocks. Each
remaining pair of blocks is one group, to which go those fingerprints of either block that
differ little enough from the other's shared bits: it builds the lower tree over one side,
searches it with the other, and returns a spanning forest of the links that it found, which
has as many components as all links and at most one row per fingerprint. The number of blocks grows with
the square root of the fingerprints, so a task's memory is two blocks.

A null or empty text, or one without words, has the fingerprint zero and is linked like any
other. Copies meet in one fingerprint before the search. Rows without an id are
fingerprinted but belong to no group (component null). An empty table gives an empty result.
Only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import bounded_batches, small, stored, text_key
from lakemart.llm.components import components

SEED = 42
#: Fingerprints of a block are about this many times the square root of all.
BLOCK = 64
#: Fan-out of the tree and the queries that descend it together.
FAN, TOGETHER = 4, 128


def fingerprint(text: str | None, words_each: int = 4) -> int:
    """64-bit SimHash of a text's word shingles, each counted as often as it occurs."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(words_each, len(words))
    begins = np.append(0, ends[:-1] + 1)[:len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begins, ends[k - 1:].tolist())], np.uint64)
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 8192):
        votes += np.unpackbits(hashes[i:i + 8192, None].view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words_each: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its fingerprint as a (signed) long."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), words_each) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, fp long")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Position of each 64-bit pattern in the reflected Gray sequence."""
    rank = fp.astype(np.uint64, copy=True)
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _gray_order(fp: str) -> Column:
    """The Gray rank of a fingerprint (a signed long), in an order that signed longs have."""
    rank = F.col(fp)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-2**63))


class GrayTree:
    """Hierarchy over fingerprints in Gray order; level 0 holds the fingerprints themselves."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps
        every, some, levels = fps, fps, []
        while len(every) > 1:
            cuts = np.arange(0, len(every), FAN)
            every, some = np.bitwise_and.reduceat(every, cuts), np.bitwise_or.reduceat(some, cuts)
            levels.append((~(every ^ some), every))
        self.levels = []  # from the root: mask and pattern of the bits first shared here
        above = np.zeros(1, np.uint64)
        for mask, bits in reversed(levels):
            above = np.repeat(above, FAN)[:len(mask)] if self.levels else np.zeros(len(mask), np.uint64)
            own = mask & ~above
            self.levels.append((own, bits & own))
            above = mask

    def search(self, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, fingerprint) of positions whose fingerprints differ in at most ``most`` bits."""
        if not len(self.fps) or not len(queries):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q = np.arange(len(queries), dtype=np.int32)
        node, apart = np.zeros(len(q), np.int32), np.zeros(len(q), np.uint8)
        for depth, (mask, bits) in enumerate(self.levels):
            if depth:
                q, node, apart = self._children(q, node, apart, len(mask))
            apart = apart + np.bitwise_count((queries[q] ^ bits[node]) & mask[node])
            near = apart <= most
            q, node, apart = q[near], node[near], apart[near]
        if self.levels:
            q, node, apart = self._children(q, node, apart, len(self.fps))
        near = np.bitwise_count(queries[q] ^ self.fps[node]) <= most
        return q[near], node[near]

    @staticmethod
    def _children(q, node, apart, n):
        child = (node[:, None] * np.int32(FAN) + np.arange(FAN, dtype=np.int32)).ravel()
        inside = child < n
        return np.repeat(q, FAN)[inside], child[inside], np.repeat(apart, FAN)[inside]


class _Forest:
    """Union of positions, keeping the links that joined two trees."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.links: list[tuple[int, int]] = []

    def add(self, pairs: Iterator[tuple[int, int]]) -> None:
        parent = self.parent
        for a, b in pairs:
            x, y = a, b
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            while parent[y] != y:
                parent[y] = y = parent[parent[y]]
            if x != y:
                parent[max(x, y)] = min(x, y)
                self.links.append((a, b))


def _pair_links(left: pd.DataFrame, right: pd.DataFrame, same: bool, most: int) -> list[tuple[int, int]]:
    """A spanning forest, as pairs of representatives, of the links between two blocks."""
    a, b = left["fp"].to_numpy().view(np.uint64), right["fp"].to_numpy().view(np.uint64)
    tree, shift = GrayTree(b), 0 if same else len(a)
    forest = _Forest(len(a) if same else len(a) + len(b))
    for i in range(0, len(a), TOGETHER):
        q, hit = tree.search(a[i:i + TOGETHER], most)
        q = q.astype(np.int64) + i
        hit = hit.astype(np.int64)
        if same:
            q, hit = q[q < hit], hit[q < hit]
        forest.add(zip(q.tolist(), (hit + shift).tolist()))
    ids = np.concatenate([left["rep"], right["rep"]])
    return [(int(ids[x]), int(ids[y])) for x, y in forest.links]


def near_links(distinct: DataFrame, most: int = 4) -> DataFrame:
    """Links (u, v) between representatives that join the same components as all pairs of
    fingerprints at most ``most`` bits apart. ``distinct`` (stored): fp, rep, one row each."""
    bounded_batches(distinct.sparkSession)

    sorted_in = distinct.select("fp", "rep", _gray_order("fp").alias("gray"))
    n = distinct.count()
    blocks = max(1, math.ceil(math.sqrt(n) / BLOCK))
    cuts = sorted_in.agg(F.percentile_approx("gray", [i / blocks for i in range(1, blocks)], F.lit(10_000)).alias("c")
                         ).first()["c"] if blocks > 1 else []
    cuts = sorted(set(cuts or []))  # one bound per block

    at, width = np.array(cuts, np.int64), len(cuts) + 1
    block_of = lambda gray: np.searchsorted(at, gray.to_numpy(), side="left")

    def shared_bits(batches):
        """Of each block, what the batch's fingerprints share."""
        for b in batches:
            fp, block = b.column(0).to_numpy(), block_of(b.column(1))
            order = np.argsort(block, kind="stable")
            ids, first = np.unique(block[order], return_index=True)
            every, some = (f.reduceat(fp[order], first) if len(ids) else fp[:0] for f in (np.bitwise_and, np.bitwise_or))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(every), pa.array(some)], names=["block", "every", "some"])

    # The tree's upper nodes: one row per block, some thousands at the largest.
    top = sorted(sorted_in.select("fp", "gray").mapInArrow(shared_bits, "block int, every long, some long").groupBy("block")
                 .agg(F.bit_and("every").alias("every"), F.bit_or("some").alias("some")).collect())
    every, some = (np.array([r[c] for r in top], np.int64).view(np.uint64) for c in ("every", "some"))
    ids, mask = np.array([r["block"] for r in top], np.int64), ~(every ^ some)

    def spread(batches):
        """Each fingerprint goes to the pairs of its block with those blocks whose shared bits it
        differs from in no more than the limit: no other holds a neighbour of it."""
        for b in batches:
            fp, block = b.column(0).to_numpy().view(np.uint64), block_of(b.column(2))
            for i in range(0, len(fp), 1024):
                row, other = np.nonzero(np.bitwise_count((fp[i:i + 1024, None] ^ every) & mask) <= most)
                row, other = row + i, ids[other]
                own = block[row]
                pair = np.minimum(own, other) * width + np.maximum(own, other)
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(row)) for c in b.columns), pa.array(pair), pa.array(own <= other)],
                                                 names=["fp", "rep", "gray", "pair", "is_left"])

    def search(key, rows):
        lo, hi = divmod(int(key[0]), width)
        rows = rows.sort_values("gray")
        left, right = rows[rows["is_left"]], rows[rows["is_left"] == (lo == hi)]
        return pd.DataFrame(_pair_links(left, right, lo == hi, most), columns=["u", "v"], dtype="int64")

    return (sorted_in.mapInArrow(spread, "fp long, rep long, gray long, pair long, is_left boolean")
            .groupBy("pair").applyInPandas(search, "u long, v long"))


def near_duplicates(docs: DataFrame, words_each: int = 4, most: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the least doc_id that
    links of at most ``most`` differing bits reach."""
    fps = stored(fingerprints(docs, words_each, id_col, text_col), "fingerprints")
    distinct = stored(fps.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    comp = components(stored(near_links(distinct, most), "links"))
    labels = (distinct.join(comp, distinct["rep"] == comp["node"], "left")
              .select("fp", F.coalesce("component", "rep").alias("_component")))
    return (fps.join(labels, "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.when(F.col("doc_id").isNotNull(), F.col("_component")).alias("component_id")))


def drop_near_duplicates(docs: DataFrame, words_each: int = 4, most: int = 4, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """Keep, with all its columns, the first row of each group of near duplicates: that of the least
    id, then of the least hash of its text. Every row is judged by its own text, also where rows
    share an id. Rows of one id and text count once; rows without an id all stay."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def fingerprint_of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words_each) for t in texts], dtype="uint64").astype("int64")

    row = F.struct(*docs.columns).alias("row")
    rows = stored(docs.select(F.col(id_col).cast("long").alias("id"), *text_key(text_col), fingerprint_of(text_col).alias("fp"), row), "rows")
    key = ["id", "t1", "t2"]
    keys = stored(rows.filter("id IS NOT NULL").groupBy("fp", *key).agg(F.count("*").alias("n")), "keys")
    distinct = stored(keys.select("fp", F.col("fp").alias("rep")).distinct(), "distinct")
    comp = components(stored(near_links(distinct, most), "links"))
    grouped = (keys.join(comp, keys["fp"] == comp["node"], "left")
               .select(*key, "n", F.coalesce("component", "fp").alias("group"), F.struct(*key).alias("place")))
    first = grouped.groupBy("group").agg(F.min("place").alias("first"))
    judged = stored(grouped.join(first, "group").select(*key, "n", (F.col("place") == F.col("first")).alias("stays")), "judged")

    def of(marks: DataFrame, how: str) -> DataFrame:
        named = small(marks.select(*(F.col(k).alias(f"_{k}") for k in key)))
        return rows.join(named, [rows[k].eqNullSafe(named[f"_{k}"]) for k in key], how)

    repeated = judged.filter("stays AND n > 1")
    kept = of(stored(judged.filter("NOT stays OR n > 1"), "not-single"), "left_anti").select("row.*")
    once = of(repeated, "left_semi").groupBy(*key).agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")
    return kept.unionByName(once)
