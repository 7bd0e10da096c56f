"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent n-grams (one to three letters, words
padded with a boundary sign) by falling frequency. A text is ranked the same way, and its
distance to a language is the sum over its n-grams of how far out of place they stand in
the profile; one that the profile lacks counts as the whole length of a profile. The nearest
language wins, ties by name; the score is one less the distance as a share of the largest
possible.

Profiles come from a bounded sample of labelled texts (``SAMPLE`` whole texts of a language by
hash of the id); every row is predicted, from its text alone. A null text, or one without a
letter, is ``und`` with score 0, and so is everything if no language was learned. Repeated
rows are predicted each; an empty table gives an empty result. Only the id and text columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import bounded_batches, stored

#: N-grams of a profile; labelled texts of a language that make one.
PROFILE, SAMPLE = 400, 1500
NONE = "und"


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> np.ndarray:
    """Codes of all n-grams of a text, with repeats. A code packs three code points of 21 bits;
    zero is the boundary of words, a two-gram carries the highest bit."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    points = np.concatenate([[0], np.where(_letters()[points], points, 0), [0]]).astype(np.uint64)
    points = points[np.append(True, (points[1:] != 0) | (points[:-1] != 0))]
    if len(points) < 3:
        return np.zeros(0, np.uint64)
    high, low = np.uint64(42), np.uint64(21)
    two = (points[:-1] << low) | points[1:] | np.uint64(1 << 63)
    three = (points[:-2] << high) | (points[1:-1] << low) | points[2:]
    return np.concatenate([points[points != 0], two, three[points[1:-1] != 0]])


def ranked(codes: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """Codes (ascending) by falling count, ties by code."""
    if len(codes) > 4 * most:  # only counts that can reach the profile
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.argsort(-counts, kind="stable")[:most]]


class Profiles:
    """Ranked codes of each language, with the languages in order of name."""

    def __init__(self, by_language: dict[str, np.ndarray], most: int = PROFILE):
        self.languages, self.most = sorted(by_language), most
        self.sorted = [(np.sort(by_language[n]), np.argsort(by_language[n], kind="stable")) for n in self.languages]

    def predict(self, text: str | None) -> tuple[str, float]:
        codes = grams(text)
        if not len(codes) or not self.languages:
            return NONE, 0.0
        own = ranked(*np.unique(codes, return_counts=True), self.most)
        place = np.arange(len(own))
        best, least = NONE, None
        for name, (codes, rank) in zip(self.languages, self.sorted):
            at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
            distance = int(np.where(codes[at] == own, np.abs(rank[at] - place), self.most).sum())
            if least is None or distance < least:
                best, least = name, distance
        return best, 1.0 - least / (self.most * len(own))


def learn(labelled: DataFrame, most: int = PROFILE, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Profiles:
    """Profiles of the languages of labelled rows; rows without a language are left out."""
    bounded_batches(labelled.sparkSession)
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    light = rows.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"))
    # Salted first, so that no language's rows are ranked in one task.
    order = [F.xxhash64("id"), F.col("id")]
    salted = (light.filter("id IS NOT NULL").distinct().withColumn("salt", F.pmod(F.hash("id"), F.lit(64)))
              .withColumn("n", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("n") <= sample))
    chosen = salted.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("n") <= sample)
    texts = rows.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")) \
        .join(chosen.select("id", "lang"), ["id", "lang"], "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            languages = b.column(0).to_numpy(zero_copy_only=False)
            for name in sorted(set(languages)):
                codes = [grams(t) for t in b.column(1).filter(pa.array(languages == name)).to_pylist()]
                codes, n = np.unique(np.concatenate(codes), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(n)],
                                                 names=["lang", "gram", "n"])

    counts = (texts.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    top = stored(counts.withColumn("place", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("n"), (F.col("gram") < 0).cast("int"), "gram"))).filter(F.col("place") <= most), "profiles")
    by_language: dict[str, list] = {}
    for r in top.orderBy("lang", "place").collect():  # ``most`` rows of each language
        by_language.setdefault(r["lang"], []).append(r["gram"])
    return Profiles({k: np.array(v, np.int64).view(np.uint64) for k, v in by_language.items()}, most)


def predict(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    known = spark.sparkContext.broadcast(profiles)  # some kilobytes for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [known.value.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in found], pa.string()),
                                              pa.array([s for _, s in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, lang_pred string, score double")
