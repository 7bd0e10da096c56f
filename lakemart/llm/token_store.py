"""Token ids in binary shards with a minimal perfect hash index.

A shard is two files of one contiguous range of documents in key order. ``.ids`` holds the ids
of its documents one after another, and nothing else: little-endian, two bytes each if the
vocabulary allows it, else four. ``.mph`` maps a key to its place: a cascade of bit arrays
gives every key of the shard its own slot from 0 to n - 1 without storing keys (a key takes
the first level where no other of the remaining keys meets it, and its slot is the number of
set bits before), and the slot holds a 32-bit fingerprint of the key, which tells strangers
apart, with the number of its first record and how many records share the key. Each word of
a level stands beside the number of bits set before it, so that a slot is one read. A table
of offsets leads from records to the payload.

The directory has one row per shard: its least and greatest key and its number of ids. A key
is routed to its shard by binary search over these, and looked up by reading the head, a word
of each level that it passes, a table entry, two offsets and its own range of the payload.
Lookups of many keys coalesce these reads, and read a section whole once that is less.

Texts are encoded where they are read, and the ids, not the texts, are sorted by key and then
by a hash of themselves; so equal keys, and rows without a key, may fill several shards.
Shards are written under names of their own, and only those count that the directory names,
which Spark commits: a task that is lost and run again leaves an orphan file and no other
trace. Folders may be any that pyarrow's file systems open and all executors share.

A null or empty text has only the end id. Rows without a key come first and are found as the
null key. An empty table gives an empty store. Only the key and text columns are read.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.llm.common import bounded_batches, filesystem
from lakemart.llm.tokens import encoder

MAGIC = b"TOKMPH1\n"
#: Slots of a level for each key that is left.
SPARSE = 2.0
#: Ranges of the payload that lie this close, in bytes, are read at once, up to the most.
READ_GAP, READ_MOST = 1 << 16, 1 << 23
#: Bytes of ids of a shard, and the most shards; a larger store has larger shards.
SHARD_BYTES, SHARDS_MOST = 1 << 24, 10_000
DIRECTORY = "no int, shard string, low long, high long, n_ids long, nulls long"


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), different for each seed."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # of 64-bit words
        counts = [np.bitwise_count(w).astype(np.int64) for w in levels]
        before = np.cumsum([0, *(int(c.sum()) for c in counts)])
        self.before = [b + np.cumsum(c) - c for b, c in zip(before, counts)]
        self.size = int(before[-1])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys.view(np.uint64)
        while len(left):
            slots = 64 * max(1, int(np.ceil(SPARSE * len(left) / 64)))
            at = (_mix(left, len(levels)) % np.uint64(slots)).astype(np.int64)
            alone = np.bincount(at, minlength=slots) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; of a key that was not built in, any slot or -1."""
        keys = keys.view(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for seed, (words, before) in enumerate(zip(self.levels, self.before)):
            at = _mix(keys[left], seed) % np.uint64(64 * len(words))
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            here = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            slot = before[word] + np.bitwise_count(below)
            out[left[here]] = slot[here]
            left = left[~here]
        return out


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys.view(np.uint64), 10_007) >> np.uint64(32)).astype(np.uint32)


_WORD = np.dtype([("bits", "<u8"), ("before", "<u8")])
_ENTRY = np.dtype([("fp", "<u4"), ("run", "<u4"), ("record", "<u8")])


def _index_bytes(keys: np.ndarray, lengths: np.ndarray, nulls: int, width: int) -> bytes:
    """The index file. ``keys`` ascending, of the records after the ``nulls`` that have none."""
    distinct, first, run = np.unique(keys, return_index=True, return_counts=True)
    mph = PerfectHash.build(distinct)
    slot = mph.slots(distinct)
    table = np.zeros(len(distinct), _ENTRY)
    table["fp"][slot], table["run"][slot], table["record"][slot] = _fingerprints(distinct), run, first + nulls
    head = json.dumps({"levels": [len(w) for w in mph.levels], "keys": len(distinct), "records": len(lengths),
                       "nulls": nulls, "width": width}).encode()
    levels = [np.rec.fromarrays([w, b], dtype=_WORD).tobytes() for w, b in zip(mph.levels, mph.before)]
    offsets = np.append(0, np.cumsum(lengths)).astype("<u8")
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *levels, table.tobytes(), offsets.tobytes()])


class _Section:
    """Items of one kind in a file. Some are read by coalesced ranges; once that has cost as much as
    the whole section, it is read whole and kept."""

    def __init__(self, file, at: int, kind, items: int):
        self.file, self.at, self.kind, self.items = file, at, np.dtype(kind), items
        self.end, self.spent, self.whole = at + items * self.kind.itemsize, 0, None

    def take(self, numbers: np.ndarray) -> np.ndarray:
        size = self.kind.itemsize
        if self.whole is None and self.spent >= self.end - self.at:
            self.whole = np.frombuffer(self.file.read_at(self.end - self.at, self.at), self.kind)
        if self.whole is not None:
            return self.whole[numbers]
        wanted, place = np.unique(numbers, return_inverse=True)
        out = np.empty(len(wanted), self.kind)
        i = 0
        while i < len(wanted):
            j = i + 1
            while j < len(wanted) and (wanted[j] - wanted[j - 1]) * size <= READ_GAP and (wanted[j] - wanted[i]) * size <= READ_MOST:
                j += 1
            first, last = int(wanted[i]), int(wanted[j - 1])
            read = np.frombuffer(self.file.read_at((last - first + 1) * size, self.at + first * size), self.kind)
            out[i:j] = read[wanted[i:j] - first]
            self.spent += read.nbytes
            i = j
        return out[place]


class Shard:
    """An open shard: places by key, and ids by place."""

    def __init__(self, folder: str, name: str):
        fs, path = filesystem(folder)
        index = fs.open_input_file(f"{path}/{name}.mph")
        start = index.read_at(12, 0)
        if start[:8] != MAGIC:
            raise ValueError(f"{name}.mph is no index of this format")
        size, = struct.unpack("<I", start[8:])
        head, at = json.loads(index.read_at(size, 12)), 12 + size
        self.levels = []
        for words in head["levels"]:
            self.levels.append(_Section(index, at, _WORD, words))
            at = self.levels[-1].end
        self.table = _Section(index, at, _ENTRY, head["keys"])
        self.offsets = _Section(index, self.table.end, "<u8", head["records"] + 1)
        self.keys, self.nulls, self.width = head["keys"], head["nulls"], head["width"]
        self.payload = fs.open_input_file(f"{path}/{name}.ids")

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; of a key that the shard lacks, any slot or -1."""
        keys = keys.view(np.uint64)
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for seed, level in enumerate(self.levels):
            if not len(left):
                break
            at = _mix(keys[left], seed) % np.uint64(64 * level.items)
            word, bit = level.take((at >> np.uint64(6)).astype(np.int64)), at & np.uint64(63)
            here = (word["bits"] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word["bits"] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[here]] = (word["before"] + below)[here].astype(np.int64)
            left = left[~here]
        return out

    def records(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records of each key; no records where the shard lacks it."""
        first, run = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        slot = self.slots(keys)
        found = np.flatnonzero(slot >= 0)
        if len(found):
            entry = self.table.take(slot[found])
            held = entry["fp"] == _fingerprints(keys[found])
            first[found], run[found] = entry["record"].astype(np.int64), np.where(held, entry["run"], 0)
        return first, run

    def ids(self, records: np.ndarray) -> tuple[np.ndarray, Iterator[np.ndarray]]:
        """Place and ids of ascending records; ranges that lie close are read together."""
        low = self.offsets.take(records).astype(np.int64)
        high = self.offsets.take(records + 1).astype(np.int64)
        begin, end = low * self.width, high * self.width

        def read():
            i = 0
            while i < len(records):
                j = i + 1
                while j < len(records) and begin[j] - end[j - 1] <= READ_GAP and end[j] - begin[i] <= READ_MOST:
                    j += 1
                raw = memoryview(self.payload.read_at(int(end[j - 1] - begin[i]), int(begin[i])))
                for k in range(i, j):
                    yield np.frombuffer(raw[begin[k] - begin[i]:end[k] - begin[i]], f"<u{self.width}")
                i = j

        return low, read()


class Ranges:
    """Which shard a document goes to, by key and tie (a signed 64-bit hash of its ids). ``cuts`` are
    the greatest keys of all keyed shards but the last; a cut that is there several times is a key
    that fills as many shards, dealt by their ties, as are the first ``blank`` shards to rows
    without a key."""

    def __init__(self, blank: int, cuts: list[int]):
        self.blank, self.cuts = blank, np.array(cuts, np.int64)
        self.shards = blank + len(cuts) + 1

    def of(self, keys: np.ndarray, null: np.ndarray, ties: np.ndarray) -> np.ndarray:
        first = np.searchsorted(self.cuts, keys, side="left")
        several = np.maximum(np.searchsorted(self.cuts, keys, side="right") - first, 1)
        first, several = np.where(null, -self.blank, first), np.where(null, max(1, self.blank), several)
        share = ties.astype(np.float64) / 2.0 ** 64 + 0.5  # ascending with the tie
        return self.blank + first + np.minimum((share * several).astype(np.int64), several - 1)


def _ranges(docs: DataFrame, shards: int | None, id_col: str, text_col: str) -> Ranges:
    """About equal numbers of rows for each shard; from keys and lengths alone, so that no text is
    encoded for it."""
    key = F.col(id_col).cast("long")
    rows, keyed, size = docs.agg(F.count(F.lit(1)), F.count(key), F.sum(F.octet_length(F.coalesce(F.col(text_col), F.lit(""))))).first()
    if shards is None:
        shards = max(1, min(SHARDS_MOST, -(-(size or 0) // (2 * SHARD_BYTES))))  # two bytes for about four of text
    blank = max(1, round(shards * (rows - keyed) / rows)) if rows > keyed else 0
    parts = max(1, shards - blank)
    cuts = docs.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)], F.lit(20 * parts))).first()[0] if keyed and parts > 1 else []
    return Ranges(blank, sorted(cuts))


def _encoded(docs: DataFrame, ranges: Ranges, vocab: str, end_id: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """no, doc_id, tie and the ids of the whole text with the end id, ``width`` bytes each."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(vocab), np.array([end_id], f"<u{width}").tobytes()
        for b in batches:
            ids = [np.frombuffer(x, "<u4").astype(f"<u{width}").tobytes() + end for x in enc.encode(b.column(1).to_pylist())]
            tie = np.array([xxhash.xxh64_intdigest(x, 42) for x in ids], np.uint64).view(np.int64)
            null = b.column(0).is_null().to_numpy(zero_copy_only=False)
            no = ranges.of(b.column(0).fill_null(0).to_numpy().astype(np.int64), null, tie)
            yield pa.RecordBatch.from_arrays([pa.array(no.astype(np.int32)), b.column(0), pa.array(tie), pa.array(ids, pa.binary())],
                                             names=["no", "doc_id", "tie", "ids"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(encode, "no int, doc_id long, tie long, ids binary")


def write(docs: DataFrame, folder: str, vocab: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
          shards: int | None = None) -> None:
    """Encode whole texts, append the end id, and write shards below ``folder`` in ascending key
    order, with the directory in ``folder``/directory."""
    spark = docs.sparkSession
    bounded_batches(spark)
    width = 2 if _largest_id(vocab, end_id) < 1 << 16 else 4
    ranges = _ranges(docs, shards, id_col, text_col)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        name, out = uuid.uuid4().hex, None
        keys, lengths, nulls = [], [], 0
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                fs.create_dir(path, recursive=True)
                out = fs.open_output_stream(f"{path}/{name}.ids", compression=None)
            ids = b.column(1).to_pylist()
            lengths += [len(x) // width for x in ids]
            keys.append(b.column(0).drop_null().to_numpy())
            nulls += b.column(0).null_count
            out.write(b"".join(ids))
        if out is None:
            return
        out.close()
        held = np.concatenate(keys).astype(np.int64)
        sizes = np.array(lengths, np.int64)
        with fs.open_output_stream(f"{path}/{name}.mph", compression=None) as index:
            index.write(_index_bytes(held, sizes, nulls, width))
        ends = [int(held[0]), int(held[-1])] if len(held) else [None, None]
        row = [TaskContext.get().partitionId(), name, *ends, int(sizes.sum()), nulls]
        kinds = [pa.int32(), pa.string(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=[f.split()[0] for f in DIRECTORY.split(", ")])

    (_encoded(docs, ranges, vocab, end_id, width, id_col, text_col).repartitionById(ranges.shards, "no")
     .sortWithinPartitions("doc_id", "tie").select("doc_id", "ids").mapInArrow(shard, DIRECTORY).write.parquet(f"{folder}/directory"))


def _largest_id(vocab: str, end_id: int) -> int:
    return max(end_id, *encoder(vocab).tok.get_vocab().values())


def directory(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shard, at most ``SHARDS_MOST``: no (in key order), shard, low and high (its least
    and greatest key), n_ids, nulls (records without a key)."""
    return spark.read.schema(DIRECTORY).parquet(f"{folder}/directory")


def route(keys: DataFrame, folder: str) -> DataFrame:
    """doc_id and no of the shards that may hold each of the keys (column doc_id, null allowed),
    by binary search over the shards' key ranges."""
    spark = keys.sparkSession
    bounded_batches(spark)
    rows = sorted(directory(spark, folder).select("no", "low", "high", "nulls").collect())  # bounded, see above
    blank = np.array([r["no"] for r in rows if r["nulls"]], np.int64)
    keyed = [r for r in rows if r["low"] is not None]
    no, low, high = (np.array([r[c] for r in keyed], np.int64) for c in ("no", "low", "high"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            null = b.column(0).is_null().to_numpy(zero_copy_only=False)
            key = b.column(0).fill_null(0).to_numpy().astype(np.int64)
            first = np.searchsorted(high, key, side="left")
            count = np.where(null, len(blank), np.maximum(np.searchsorted(low, key, side="right") - first, 0))
            first = np.where(null, 0, first)
            row = np.repeat(np.arange(len(key)), count)
            at = np.arange(len(row)) + np.repeat(first - np.cumsum(count) + count, count)
            of = np.empty(len(row), np.int64)
            of[null[row]], of[~null[row]] = blank[at[null[row]]], no[at[~null[row]]]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), pa.array(of.astype(np.int32))], names=["doc_id", "no"])

    return keys.select(F.col("doc_id").cast("long")).mapInArrow(find, "doc_id long, no int")


def lookup(keys: DataFrame, folder: str) -> DataFrame:
    """The stored documents of distinct ``keys`` (column doc_id): doc_id, shard, start (in the
    shard), n_tokens, ids (little-endian unsigned 32-bit). Keys that the store lacks give no row."""
    spark = keys.sparkSession
    bounded_batches(spark)
    shards = directory(spark, folder)
    names = {r["no"]: r["shard"] for r in shards.select("no", "shard").collect()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, shard = None, None
        for b in batches:
            numbers = b.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if numbers[lo] != current:
                    current = numbers[lo]
                    shard = Shard(folder, names[current])
                part = b.column(0).slice(lo, hi - lo)
                absent = part.is_null().to_numpy(zero_copy_only=False)
                first, run = shard.records(part.fill_null(0).to_numpy().astype(np.int64))
                first, run = np.where(absent, 0, first), np.where(absent, shard.nulls, run)
                owner = np.repeat(np.arange(hi - lo), run)
                record = np.repeat(first - np.cumsum(run) + run, run) + np.arange(len(owner))
                order = np.argsort(record, kind="stable")
                owner, record = owner[order], record[order]
                for i in range(0, len(record), 512):  # bounded memory for repeated keys
                    start, found = shard.ids(record[i:i + 512])
                    ids = [x.astype("<u4").tobytes() for x in found]
                    yield pa.RecordBatch.from_arrays(
                        [part.take(pa.array(owner[i:i + 512])), pa.array([names[current]] * len(ids)), pa.array(start),
                         pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                        names=["doc_id", "shard", "start", "n_tokens", "ids"])

    return (route(keys, folder).repartitionById(max(1, len(names)), "no").sortWithinPartitions("no", "doc_id")
            .mapInArrow(read, "doc_id long, shard string, start long, n_tokens long, ids binary"))


def with_crc(found: DataFrame) -> DataFrame:
    """``found`` with ids_crc32 (unsigned, of the ids' bytes) in place of the ids."""
    return found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def bases(spark: SparkSession, folder: str) -> DataFrame:
    """shard and base, the ids of all shards before it. One row per shard file."""
    before = Window.orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    return directory(spark, folder).select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
