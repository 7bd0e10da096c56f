"""Best-fit packing of token sequences.

Best-fit decreasing puts the next longest piece into the open sequence with the least room
that still holds it. Pieces of one length are interchangeable, so the packing is computed on
the histogram of lengths (at most ``capacity`` rows, whatever the corpus): a segment tree
over remaining capacities finds the tightest open sequence in logarithmic time, and whole
runs of equal pieces and equal sequences are placed in one step, with the same outcome as
one by one. The runs then go to the pieces on the executors: a piece's rank among those of
its length says which run, which sequence and which place it gets. Ranks come from salted
windows, so that a length shared by a third of all pieces is not one task.

A null or empty text is one piece of the end id alone. Repeated rows are packed each. An
empty table gives an empty result. Only the id and text columns are read; other columns,
whatever their names, play no part.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import bounded_batches, stored
from lakemart.llm.tokens import encoder

#: Pieces of one length that one ranking group holds, in the worst case of a corpus of equal lengths.
RANKED_TOGETHER = 1_000_000


class CapacityTree:
    """Segment tree over the capacities 0..capacity; a leaf counts open runs of sequences
    with that much room left."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, n: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += n
            i >>= 1

    def tightest(self, need: int) -> int | None:
        """Smallest room of at least ``need`` that is open."""
        i = need + self.size
        if self.count[i]:
            return need
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def plan_runs(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over a histogram of lengths.

    Returns runs (length, first rank, pieces, first sequence, pieces per sequence, offset):
    the pieces of that length with ranks from the first on fill sequences from the first on,
    so many each, starting at the offset. A sequence that takes a piece becomes tighter and
    so is the next choice until it can hold no more: filling one after another is exactly
    what best fit does piece by piece.
    """
    tree, open_runs, runs, used = CapacityTree(capacity), defaultdict(list), [], 0

    def push(room, first, n):
        if n:
            open_runs[room].append((first, n))
            tree.add(room, 1)

    for length in sorted(histogram, reverse=True):
        todo, rank = histogram[length], 0
        while todo:
            room = tree.tightest(length)
            if room is None:
                fresh = -(-todo // (capacity // length))
                push(capacity, used, fresh)
                used += fresh
                continue
            first, n = open_runs[room].pop()
            tree.add(room, -1)
            each = min(room // length, todo)
            took = min(n, todo // each)
            runs.append((length, rank, took * each, first, each, capacity - room))
            push(room - each * length, first, took)
            push(room, first + took, n - took)
            rank += took * each
            todo -= took * each
    return runs


def token_pieces(docs: DataFrame, vocab: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode each whole text, append the end id, and cut what is longer than ``capacity``.

    Columns: doc_id, piece, start (ids of the document before it), length, ids_crc32 of its
    little-endian unsigned 32-bit ids, and with ``with_ids`` these bytes themselves.
    """
    bounded_batches(docs.sparkSession)
    end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab)
        for batch in batches:
            rows: list[tuple] = []
            for doc, ids in zip(batch.column(0), enc.encode(batch.column(1).to_pylist())):
                ids += end
                for k, a in enumerate(range(0, len(ids), step)):
                    part = ids[a:a + step]
                    rows.append((doc, k, a // 4, len(part) // 4, zlib.crc32(part), part))
            cols = list(zip(*rows)) if rows else [[]] * 6
            arrays = [pa.array([d.as_py() for d in cols[0]], pa.int64()), pa.array(cols[1], pa.int32()),
                      *(pa.array(c, pa.int64()) for c in cols[2:5])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays, names = [*arrays, pa.array(cols[5], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(encode, schema)


def assign(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Give every row of ``pieces`` (a stored table with doc_id, piece and a length of 1 to
    ``capacity``) its sequence_id and offset."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = plan_runs(histogram, capacity)
    salts = 8 + sum(histogram.values()) // RANKED_TOGETHER
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = (salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
             .select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    ties = [c for c in ("doc_id", "piece", "ids_crc32") if c in pieces.columns]
    ranked = (salted.withColumn("_row", F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*ties)))
              .join(bases, ["length", "_salt"])
              .withColumn("_rank", F.col("_base") + F.col("_row") - 1))
    # Bounded by the square of the capacity, not by the corpus; in practice some thousand runs.
    table = np.array(sorted(runs), np.int64).reshape(-1, 6)
    base = int(table[:, 1].max(initial=0)) + 1
    starts = table[:, 0] * base + table[:, 1]
    plan = pieces.sparkSession.sparkContext.broadcast((table, starts, base))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, starts, base = plan.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            run = table[np.searchsorted(starts, length * base + np.minimum(rank, base - 1), side="right") - 1]
            nth = rank - run[:, 1]
            out = {n: batch.column(n) for n in kept}
            out["sequence_id"] = pa.array(run[:, 3] + nth // run[:, 4])
            out["offset"] = pa.array(run[:, 5] + nth % run[:, 4] * length)
            yield pa.RecordBatch.from_pydict(out)

    kept = pieces.columns
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema), "sequence_id long", "offset long"])
    return ranked.select(*kept, "_rank").mapInArrow(place, schema)


def pack(docs: DataFrame, vocab: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` tokens: one row per piece
    with its sequence_id and gapless offset, and its ids if asked for."""
    return assign(stored(token_pieces(docs, vocab, capacity, end_id, id_col, text_col, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids, from ``pack(with_ids=True)``.
    A sequence has at most ``capacity`` ids, so its group is bounded."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: F.hex(x["ids"]))
    return packed.groupBy("sequence_id").agg(F.unhex(F.array_join(parts, "")).alias("ids"))
