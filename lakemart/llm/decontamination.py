"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item of q distinct five-word shingles is contained in a document that holds at least
need = ceil(0.8 q) of them. The item's signature is q - need + 1 of its shingles, those that
the fewest items hold and of these the least hashes: a document that lacks all of them can
hold at most need - 1 shingles, so a search of the signatures misses nothing, however long
the document, and boilerplate of many items leads to no candidates. Items are partitioned by the size they
need, and a document is searched only for the partitions that it is large enough for.

The signatures reach the document scan as bitmaps of fixed size (one per size class, built
by aggregation), so the broadcast is bounded whatever the benchmark; a document without a
hit in its classes is done. For the others the shingles that occur in items go on, as text:
signature hits are joined with the signature table to candidate pairs, and these are
verified by counting the exact shingles that they share.

Texts are lower-cased and cut at everything but letters and digits. A text of fewer than
five words is one shingle of all its words, and an item that short is looked for by the runs of
as many words of a document, which may be longer; null, empty or wordless texts have none and never
match. Repeated items are reported each. What a document holds is found by its text, so copies are
searched once in all joins, rows that share an id are judged each by their own text, and rows
without an id are filtered like any other; the report names ids and has one row for each
(id, item). Empty tables give an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import bounded_batches, let, small, stored, text_key

WORDS, LEAST = 5, 0.8
SEED = 42  # of Spark's xxhash64
#: Bits of a bitmap, and of one that bitmap_construct_agg makes.
BITS, BUCKET = 1 << 22, 32768


def normal_text(col: str):
    """Words of a text in lower case with one space between."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(col), F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def item_shingles(items: DataFrame, id_col: str, text_col: str, words_each: int, least: float) -> DataFrame:
    """item_id, shingle, h, q (distinct shingles of the item), need, nth (place of h among the item's)."""
    grams = let(F.split("norm", " "), lambda words: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words) - (words_each - 1), F.lit(1))),
        lambda i: F.array_join(F.slice(words, i, words_each), " ")))
    per_item = Window.partitionBy("item_id")
    each = (items.select(F.col(id_col).alias("item_id"), normal_text(text_col).alias("norm")).filter("norm <> ''")
            .select("item_id", F.explode(F.array_distinct(grams)).alias("shingle")).distinct())
    held_by = each.groupBy("shingle").agg(F.count("*").alias("items"))
    return (each.join(held_by, "shingle").withColumn("h", F.xxhash64("shingle"))
            .withColumn("q", F.count("*").over(per_item))
            .withColumn("need", F.ceil(F.col("q") * F.lit(least) - F.lit(1e-9)))
            .withColumn("nth", F.row_number().over(per_item.orderBy("items", "h", "shingle"))))


def _bitmaps(hashes: DataFrame, by: str) -> dict[int, np.ndarray]:
    """Bitmap of the hashes' lowest bits for each value of ``by``, a few."""
    at = F.col("h").bitwiseAND(F.lit(BITS - 1)) + 1
    rows = (hashes.groupBy(by, F.bitmap_bucket_number(at).alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect())
    out: dict[int, np.ndarray] = {}
    for r in rows:
        whole = out.setdefault(int(r[by]), np.zeros(BITS // 8, np.uint8))
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        whole[(r["b"] - 1) * BUCKET // 8:][:len(part)] = part
    return out


def _has(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(BITS - 1)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def contained_items(docs: DataFrame, items: DataFrame, words_each: int = WORDS, least: float = LEAST,
                    id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                    item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, shared and item_shingles (counts), containment: all pairs whose
    document holds at least ``least`` of the item's shingles."""
    found = stored(contained_in_texts(docs, items, words_each, least, text_col, item_id_col, item_text_col), "contained")
    named = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), *text_key(text_col))
    best = F.max_by(F.struct("shared", "item_shingles", "containment"), F.struct("shared", F.col("item_shingles") * -1))
    return (named.join(small(found), ["t1", "t2"]).groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", "b.shared", "b.item_shingles", "b.containment"))


def contained_in_texts(docs: DataFrame, items: DataFrame, words_each: int = WORDS, least: float = LEAST, text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The same for texts, named by their ``text_key`` (t1, t2) instead of an id."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shingles = stored(item_shingles(items, item_id_col, item_text_col, words_each, least), "item-shingles")
    signature = (shingles.filter("nth <= q - need + 1")
                 .withColumn("size_class", F.floor(F.log2("need")).cast("int")))
    classes, so_far = [], np.zeros(BITS // 8, np.uint8)
    for size_class, bitmap in sorted(_bitmaps(signature, "size_class").items()):
        so_far = so_far | bitmap
        classes.append((1 << size_class, so_far))  # what a document of that many shingles may hold
    every = _bitmaps(shingles.withColumn("one", F.lit(0)), "one").get(0)
    # Items of fewer words than a shingle, by their number of words.
    short = _bitmaps(shingles.withColumn("k", F.size(F.split("shingle", " "))).filter(F.col("k") < words_each), "k")
    known = spark.sparkContext.broadcast((classes, every, short))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, every, short = known.value
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            out: list[tuple] = []
            for *doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = text.as_py().encode().split()
                if not words or not classes:
                    continue
                joined = b" ".join(words)
                stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
                starts = np.append(0, stops[:-1] + 1)

                def runs(k):
                    begins, ends = starts[:len(words) - k + 1], stops[k - 1:]
                    return begins, ends, np.array(
                        [digest(joined[a:b], SEED) for a, b in zip(begins.tolist(), ends.tolist())], np.uint64)

                begins, ends, h = runs(min(words_each, len(words)))
                size = len(np.unique(h))
                fitting = [bitmap for smallest, bitmap in classes if smallest <= size]
                if fitting:
                    hit = _has(fitting[-1], h)
                    if hit.any():
                        seen = np.flatnonzero(_has(every, h))
                        out += [(*doc, size, joined[begins[i]:ends[i]].decode(), bool(hit[i])) for i in seen.tolist()]
                for k in (k for k in short if k < len(words)):
                    begins, ends, h = runs(k)
                    out += [(*doc, size, joined[begins[i]:ends[i]].decode(), True) for i in np.flatnonzero(_has(short[k], h)).tolist()]
            cols = list(zip(*set(out))) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.bool_())],
                names=["t1", "t2", "size", "shingle", "hit"])

    doc = ["t1", "t2"]
    held = stored(docs.select(*text_key(text_col), normal_text(text_col))
                  .mapInArrow(scan, "t1 long, t2 long, size long, shingle string, hit boolean"), "held").distinct()
    candidates = (held.filter("hit").join(signature.select("shingle", "item_id", "need"), "shingle")
                  .filter("need <= size").select(*doc, "item_id").distinct())
    # The candidates' own shingles meet those of their text: no other pair is ever formed.
    shared = (candidates.join(shingles.select("shingle", "item_id", "q", "need"), "item_id")
              .join(held.select(*doc, "shingle").distinct(), [*doc, "shingle"])
              .groupBy(*doc, "item_id", "q", "need").agg(F.count("*").alias("shared")))
    return shared.filter("shared >= need").select(
        *doc, "item_id", "shared", F.col("q").alias("item_shingles"), (F.col("shared") / F.col("q")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, words_each: int = WORDS, least: float = LEAST,
                      text_col: str = "text", least_words: int = 1, item_text_col: str = "text") -> DataFrame:
    """Documents, with all their columns, that hold no item of at least ``least_words`` words: an
    item of an everyday word or two tells nothing of where a text comes from."""
    long = items.filter(F.size(F.split(normal_text(item_text_col), " ")) >= least_words)
    bad = stored(contained_in_texts(docs, long, words_each, least, text_col, item_text_col=item_text_col).select("t1", "t2").distinct(), "bad")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), *text_key(text_col))
    return keyed.join(small(bad), ["t1", "t2"], "left_anti").select("row.*")
