"""Toxicity by a weighted lexicon, matched by Aho-Corasick.

Texts are folded first: lower case, look-alike letters of other scripts and digits that stand
for letters become the letter, everything else a space. Lexicon terms are whole words or
beginnings of words (inflected and compound forms); each occurrence counts once, with its
largest weight, unless it lies in an exception phrase. The sum of weights is normalised by
the length of the text, and a logistic curve turns both into a score.

The lexicon (log odds of a term between labelled texts), the learned exception phrases and
the curve come from a bounded sample of labelled rows, ``Settings.sample`` of each label by
hash of the id, whole texts; scoring covers every row. A label given to several rows of an
id is theirs all. Null, empty and wordless texts have no hits and get the curve's least
score. Without labels of both kinds the lexicon is empty and every score is 0. Repeated rows
are scored each; an empty table gives an empty result. Only the id and text columns are read,
and the id only to join labels.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import bounded_batches, let, stored

# Letters of other scripts that look like a Latin one, and digits used for one.
LOOK_ALIKE = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j",
              "ԁ": "d", "ɡ": "g", "ո": "n", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "α": "a", "ε": "e",
              "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x"}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SIGNS = {"@": "a", "$": "s"}

#: Terms after which a toxic text counts as explained; new texts that a further term must explain.
EXPLAINED, EXPLAINED_LEAST = 2, 3

#: Hashes of a text's sketch, and the share of them that makes a near copy.
SKETCH, SAME = 32, 0.7

#: Phrases in which an insulting word is none.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "scum line", "moron test")


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled rows of either label, at most. A term needs five toxic texts and
    ``support`` of all of them, and ``odds`` (natural log); a learned exception phrase as many clean ones. ``terms``: kept at most,
    the most frequent first. ``prefixes``: lengths of the beginnings of words."""
    sample: int = 4000
    support: float = 0.004
    odds: float = 3.0
    terms: int = 4000
    prefixes: tuple[int, ...] = (4, 5, 6)
    exceptions: tuple[str, ...] = EXCEPTIONS


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)  # " word " or " begin"
    exceptions: list[str] = field(default_factory=list)  # " two words "
    curve: tuple[float, float, float] | None = None  # of 1, log(1 + sum), sum per root of length


def folded(col: str):
    """Words of a text after folding, with a space before, between and after."""
    text = F.lower(F.coalesce(F.col(col), F.lit("")))
    for sign, letter in SIGNS.items():
        text = F.when(F.instr(text, F.lit(sign)) > 0,
                      F.regexp_replace(text, rf"(?<=\p{{L}})\{sign}(?=\p{{L}})", letter)).otherwise(text)
    table = {**LOOK_ALIKE, **DIGITS}
    text = F.translate(text, "".join(table), "".join(table.values()))
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(text, r"[^\p{L}]+", " ")), F.lit(" "))


def _sketch(col: str):
    """The least hashes of the two-word runs of a folded text, ascending: near copies share most."""
    return let(F.split(F.trim(F.col(col)), " "), lambda words: F.slice(F.array_sort(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))),
        lambda i: F.xxhash64(F.array_join(F.slice(words, i, 2), " "))))), 1, SKETCH))


def _without_copies(texts: DataFrame) -> DataFrame:
    """(label, folded) of ``texts`` with near copies once. Texts that share their least hash are
    held against the first of them, and go only if most of both sketches is the same."""
    sketched = stored(texts.distinct().withColumn("sketch", _sketch("folded")), "toxicity-sketches")
    group = ["label", F.col("sketch")[0].alias("least")]
    first = sketched.groupBy(*group).agg(F.min(F.struct("folded", "sketch")).alias("kept"))
    both = sketched.select("label", "folded", "sketch", group[1]).join(first, ["label", "least"])
    shared = F.size(F.array_intersect("sketch", "kept.sketch"))
    of = F.greatest(F.size("sketch"), F.size("kept.sketch"))
    return both.filter((F.col("folded") == F.col("kept.folded")) | (shared < SAME * of)).select("label", "folded")


class Matcher:
    def __init__(self, weights: dict[str, float], exceptions: list[str]):
        self.automaton = ahocorasick.Automaton()
        for term, weight in weights.items():
            self.automaton.add_word(term, (len(term), weight))
        for phrase in exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, float]]:
        """Start (of the space before the word) and weight of each occurrence that counts."""
        if not len(self.automaton):
            return []
        best: dict[int, float] = {}
        excepted: list[tuple[int, int]] = []
        for end, (size, weight) in self.automaton.iter(text):
            start = end - size + 1
            if weight is None:
                excepted.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        if excepted:
            for start, end in excepted:
                for at in [s for s in best if start <= s < end]:
                    del best[at]
        return sorted(best.items())


def _features(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(total)), np.log1p(total), total / np.sqrt(np.maximum(words, 1))])


def _map_texts(df: DataFrame, make, schema: str) -> DataFrame:
    """``make(batch of ids or labels, folded texts)`` returns the columns of ``schema``."""
    names = [p.split()[0] for p in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(make(b.column(0), b.column(1)), names=names)

    return df.mapInArrow(run, schema)


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> Model:
    """Lexicon, exception phrases and curve from a sample of the labelled documents."""
    spark = docs.sparkSession
    bounded_batches(spark)
    given = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(id_col).agg(
        F.max(label_col).cast("int").alias("label"))
    order = F.xxhash64(F.col(id_col).cast("long"))
    chosen = [given.filter(F.col("label") == v).orderBy(order, id_col).limit(settings.sample) for v in (0, 1)]
    texts = stored(docs.select(id_col, text_col).join(chosen[0].union(chosen[1]), id_col)
                   .select("label", folded(text_col).alias("folded")), "toxicity-texts")
    sample = stored(_without_copies(texts), "toxicity-sample")
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model()

    def counted(pairs_of):
        """(term, toxic texts, clean texts) of each batch, summed over all batches."""
        def make(label, texts):
            toxic, clean = Counter(), Counter()
            for y, t in zip(label.to_pylist(), texts.to_pylist()):
                (toxic if y else clean).update(pairs_of(t))
            terms = list(toxic.keys() | clean.keys())
            return [pa.array(terms, pa.string()), pa.array([toxic[t] for t in terms], pa.int64()),
                    pa.array([clean[t] for t in terms], pa.int64())]
        return (_map_texts(sample, make, "term string, toxic long, clean long")
                .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))

    odds = (F.log((F.col("toxic") + 0.5) / (sizes[1] + 1)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1)))
    lengths = settings.prefixes

    given_exceptions = [f" {e} " for e in settings.exceptions]

    def terms_of(text):
        for phrase in given_exceptions:
            text = text.replace(phrase, "  ")
        words = set(text.split())
        return {f" {w} " for w in words} | {f" {w[:k]}" for w in words for k in lengths if len(w) >= k}

    rows = (counted(terms_of).filter(F.col("toxic") >= max(5, settings.support * sizes[1])).withColumn("odds", odds)
            .filter(F.col("odds") >= settings.odds).orderBy(F.desc("toxic"), F.desc("odds"), "term")
            .limit(settings.terms).collect())
    weights = _covering({r["term"]: float(r["odds"]) for r in rows}, sample.filter("label = 1"), terms_of)

    def phrases_of(text):
        words, out = text.split(), set()
        for i, w in enumerate(words):
            if f" {w} " in weights or any(f" {w[:k]}" in weights for k in lengths):
                out.update(f" {' '.join(words[a:a + 2])} " for a in (i - 1, i) if 0 <= a < len(words) - 1)
        return out

    learned = (counted(phrases_of).filter(F.col("clean") >= max(5, settings.support * sizes[0])).filter(odds < -1.0)
               .orderBy(F.desc("clean"), "term").limit(settings.terms).collect()) if weights else []
    exceptions = sorted({*given_exceptions, *(r["term"] for r in learned)})
    model = Model(weights, exceptions)

    def totals(label, texts):
        matcher = Matcher(model.weights, model.exceptions)
        return [pa.array(label.to_pylist(), pa.int32()), *_totals(matcher, texts)]

    seen = _map_texts(sample, totals, "label int, total double, words long").toPandas()  # the bounded sample
    model.curve = _fit(_features(seen["total"].to_numpy(), seen["words"].to_numpy()), seen["label"].to_numpy())
    return model


def _covering(odds: dict[str, float], toxic: DataFrame, terms_of) -> dict[str, float]:
    """The candidates that explain toxic texts which no better one does: terms that only come
    along with insults, as the other words of a text that was copied often, are left out."""
    def present(label, texts):
        held = [sorted(terms_of(t) & odds.keys()) for t in texts.to_pylist()]
        return [pa.array(held, pa.list_(pa.string()))]

    texts = [r["terms"] for r in _map_texts(toxic, present, "terms array<string>").collect()]  # the bounded sample
    holders: dict[str, set[int]] = {t: set() for t in odds}
    for i, terms in enumerate(texts):
        for t in terms:
            holders[t].add(i)
    chosen: dict[str, float] = {}
    explained = Counter()
    while True:
        best = max(holders, key=lambda t: (len(holders[t]), odds[t], t), default=None)
        if best is None or len(holders[best]) < EXPLAINED_LEAST:
            return chosen
        chosen[best], now = odds[best], holders.pop(best)
        explained.update(now)
        done = {i for i in now if explained[i] >= EXPLAINED}
        for t in {t for i in done for t in texts[i]} & holders.keys():
            holders[t] -= done


def _totals(matcher: Matcher, texts: pa.Array) -> list[pa.Array]:
    total, words = [], []
    for t in texts:
        t = t.as_py()
        total.append(sum(w for _, w in matcher.hits(t)))
        words.append(t.count(" ") - 1)
    return [pa.array(total, pa.float64()), pa.array(words, pa.int64())]


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> tuple[float, float, float]:
    """Logistic regression by Newton steps; both labels weigh the same."""
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta)),
                               x.T @ (weight * (y - p)) - ridge * beta)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(b) for b in beta)


def scorer(spark, model: Model):
    """Pandas UDF from a folded text to (score, n_hits); the model is bounded by Settings.terms."""
    bounded_batches(spark)
    known = spark.sparkContext.broadcast(model)

    @F.pandas_udf("score double, n_hits long")
    def scored(texts: pd.Series) -> pd.DataFrame:
        model = known.value
        matcher = _matcher(model)
        hits = [matcher.hits(t) for t in texts]
        p = np.zeros(len(texts))
        if model.curve is not None and len(texts):
            total = np.array([sum(w for _, w in h) for h in hits], float)
            words = np.array([t.count(" ") - 1 for t in texts], float)
            p = 1 / (1 + np.exp(-np.clip(_features(total, words) @ np.array(model.curve), -30, 30)))
        return pd.DataFrame({"score": p, "n_hits": np.array([len(h) for h in hits], np.int64)})

    return scored


_MATCHERS: list[tuple[Model, Matcher]] = []


def _matcher(model: Model) -> Matcher:
    """The worker's automaton for a model; the last one is kept between batches."""
    if not _MATCHERS or _MATCHERS[0][0] is not model:
        _MATCHERS[:] = [(model, Matcher(model.weights, model.exceptions))]
    return _MATCHERS[0][1]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and n_hits of every row."""
    scored = scorer(docs.sparkSession, model)(folded(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), scored.alias("_s")).select("doc_id", "_s.score", "_s.n_hits")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """Documents, with all their columns, that score below the threshold."""
    return docs.filter(scorer(docs.sparkSession, model)(folded(text_col))["score"] < threshold)
