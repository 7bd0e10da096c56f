"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import (ann, decontamination, embedding_dedup, fill_middle, language, licenses, packing, pii, runs, simhash,
                          token_store, toxicity, warc)
from lakemart.llm.common import crc_bucket, let, read, tokenizer_path, workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@register("op4_best_fit_packing")
def op4_best_fit_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@register("op6_simhash_gray")
def op6_simhash_gray(spark, sf_dir):
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')) AS norm FROM documents
  UNION ALL
  SELECT 'i', item_id, trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')) FROM benchmark
), words AS (SELECT kind, id, string_split(norm, ' ') AS w FROM texts WHERE norm <> ''),
grams AS (
  SELECT DISTINCT kind, id, unnest(CASE WHEN len(w) <= 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS g FROM words
), items AS (SELECT id AS item_id, g, count(*) OVER (PARTITION BY id) AS q FROM grams WHERE kind = 'i'),
shared AS (
  SELECT d.id AS doc_id, item_id, count(*) AS shared, q AS item_shingles
  FROM grams d JOIN items i ON d.g = i.g WHERE d.kind = 'd' GROUP BY ALL
), brief AS (SELECT id AS item_id, w, len(w) AS k FROM words WHERE kind = 'i' AND len(w) < 5),
inside AS (
  SELECT DISTINCT d.id AS doc_id, item_id, 1::BIGINT AS shared, 1::BIGINT AS item_shingles FROM words d JOIN brief b
    ON d.kind = 'd' AND list_contains(
      [array_to_string(d.w[j:j + b.k - 1], ' ') FOR j IN range(1, len(d.w) - b.k + 2)], array_to_string(b.w, ' '))
), every AS (SELECT * FROM shared UNION SELECT * FROM inside)
SELECT doc_id, item_id, shared, item_shingles, shared::DOUBLE / item_shingles AS containment
FROM every WHERE shared >= ceil(item_shingles * 0.8 - 1e-9)
"""


@register("op7_decontamination", OP7_SQL)
def op7_decontamination(spark, sf_dir):
    return decontamination.contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@register("op8_toxicity_lexicon")
def op8_toxicity_lexicon(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    held_out = crc_bucket("doc_id", 5) == 0
    model = toxicity.learn(docs, read(spark, sf_dir, "labels").filter(~held_out))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score",
                                              (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op2_pii_disclosure")
def op2_pii_disclosure(spark, sf_dir):
    found = pii.find(read(spark, sf_dir, "documents"))
    number = lambda k: F.size(F.filter("base", lambda s: s["nth"] == k)).cast("long")
    return found.select("row.doc_id", *(number(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS[:4])),
                        F.sha2(pii.spans_text("base"), 256).alias("base_sha256"), pii.spans_text("spans").alias("spans"))


@register("op10_token_store")
def op10_token_store(spark, sf_dir):
    folder = workspace(spark, "tokens")
    docs = read(spark, sf_dir, "documents")
    token_store.write(docs, folder, tokenizer_path("byte_bpe_50k.json"))
    found = token_store.with_crc(token_store.lookup(docs.select("doc_id").distinct(), folder))
    return (found.join(token_store.bases(spark, folder), "shard")
            .select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"))


@register("op9_warc_index")
def op9_warc_index(spark, sf_dir):
    folder = workspace(spark, "warc")
    written = warc.write(read(spark, sf_dir, "pages"), folder)
    return warc.read(written, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op3_rank_order_language")
def op3_rank_order_language(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    held_out = crc_bucket("doc_id", 4) == 2
    profiles = language.learn(docs.filter(~held_out))
    return language.predict(docs, profiles).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@register("op5_license_digest", licenses.scan_sql())
def op5_license_digest(spark, sf_dir):
    return licenses.scan(read(spark, sf_dir, "documents"))


@register("op1_graph_neighbours")
def op1_graph_neighbours(spark, sf_dir):
    return ann.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP11_SQL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units FROM documents
), numbers AS (
  SELECT *, len(units) AS n, [('0x' || d[8 * k + 1 : 8 * k + 8])::BIGINT FOR k IN range(4)] AS h FROM drawn
), cuts AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers
), parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix FROM cuts
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN len(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN len(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts
"""


@register("op11_fill_in_middle", OP11_SQL)
def op11_fill_in_middle(spark, sf_dir):
    mixed = fill_middle.restore(fill_middle.fill_in_middle(read(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2("restored", 256).alias("restored_sha256"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """Every tenth document by crc32 of its id, from word a = g % n on, repeats its next p words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def tail(words):
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        repeated = F.transform(F.sequence(F.lit(0), n - a - 1), lambda i: F.get(words, (a + i % p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), repeated), " "))

    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return docs.withColumn("text", F.when(h % 10 == 0, let(words, tail)).otherwise(F.col("text")))


@register("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    found = runs.periodic_runs(with_periodic_tails(read(spark, sf_dir, "documents")))
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    better = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    best = found.withColumn("best", F.aggregate("runs", none, better))
    return best.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                       F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                       F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"))


OP13_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM usable a JOIN usable b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.98
), reached AS (SELECT u, w FROM links UNION SELECT r.u, l.w FROM reached r JOIN links l ON r.w = l.u),
least_reached AS (SELECT u, min(w) AS w FROM reached GROUP BY u),
degree AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(w, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(w, vec_id)) AS kept
FROM embeddings LEFT JOIN least_reached r ON vec_id = r.u LEFT JOIN degree d ON vec_id = d.u
"""


@register("op13_embedding_near_dedup", OP13_SQL)
def op13_embedding_near_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))
