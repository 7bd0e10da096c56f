"""Licence scans by canonical digest lookup.

A text is brought to a canonical form (case, punctuation, copyright lines and equivalent
spellings normalised) and hashed; the digest is hash-joined to the digests of known licences.
Whole texts are looked up, and every line of a text as a text of its own, so that a licence
notice inside a longer document is found where it stands on a line.

Everything is expressions and joins of Spark SQL. The known licences are a parameter; the
default is the fixed list below. A null text is empty; an empty canonical form is no licence.
Repeated rows get a result each. An empty table gives an empty result. Only the id and text
columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import apply_defaults, let, small, stored, text_key
from lakemart.llm.license_texts import HEADERS, KNOWN, LONG

# Spellings that licence matching treats as one, each on whole words.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "licencing": "licensing",
    "sublicence": "sublicense", "sub license": "sublicense", "sub licence": "sublicense",
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "copyright holder": "copyright owner", "copyright holders": "copyright owners", "emphasised": "emphasized",
    "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment", "https": "http",
    "initialise": "initialize", "judgement": "judgment", "labelling": "labeling", "labour": "labor", "merchantibility":
    "merchantability", "modelling": "modeling", "noncommercial": "non commercial", "organisation": "organization",
    "organise": "organize", "per cent": "percent", "practise": "practice", "programme": "program", "realise": "realize",
    "recognise": "recognize", "signalling": "signaling", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}
# The SQL's own, fewer rules, on parts of words: alike for all texts that hold no spelling of either list.
_SQL_SPELLINGS = {
    "licenc": "licens", " sub licens": " sublicens", "isation": "ization", "ised ": "ized ", "ise ": "ize ",
    "dgement": "dgment", "avour": "avor", "elling ": "eling ", " https ": " http ", "copyright holder": "copyright owner",
    "noncommercial": "non commercial", " whilst ": " while ",
}
_SQL_COPYRIGHT = r"^[ \t]*(copyright|\(c\)|©)[^\n]*"
# A line (lower case) that is a copyright statement: the word or sign and then a year, another sign, a
# placeholder or a name. Licence prose that a line break leaves behind the word is none; behind a
# bare (c), which also numbers paragraphs, a name is two to four words to the end of the line.
_PROSE = (r"(?:notices?|holders?|holder's|owners?|owner's|ownership|licen[cs]\w*|laws?|statements?|interests?|rights?|protection|"
          r"permissions?|treaty|treaties|disclaimers?|claims?|infringement|status|terms?|conditions?|material|works?|year|date|"
          r"line|information|management|law's|patents?|trademarks?|and|or|in|on|to|of|is|are|as|for|with|from|under|that|which|"
          r"if|when|where|may|must|shall|will|can|does|do|not|applicable|relevant|assignments?|policy|doctrines?|"
          r"(?:the|this|these|those|such|any|a|an|all|your|their|its)[ \t]+(?:software|library|program|works?|document\w*|"
          r"code|source|above|following|licen[cs]\w*|notices?|copyright|terms?|conditions?|rights?|materials?|same))(?![\w-])")
_YEAR = r"(?:19|20)[0-9]{2}(?![0-9])"
_COPYRIGHT = (r"^[ \t]*(?:(?:copyright(?![\w-])|©|\(c\)(?=[ \t]*(?:copyright(?![\w-])|©)))"
              r"(?:[ \t:,]*(?:\(c\)|©|copyright(?![\w-])))*"
              rf"(?:(?<=\)|©)[ \t]*|[ \t:,]*(?=[0-9\[<{{(])|[ \t:]+(?:by[ \t]+)?)(?!{_PROSE})(?:[\p{{L}}0-9]|[\[<{{(\"'])[^\n]*|"
              rf"\(c\)[ \t,:]*(?:{_YEAR}[^\n]*|[^\n]*?(?<![0-9]){_YEAR}[^\n]*|"
              r"(?:[ \t]+(?!(?:you|the|a|an|any|if|in|to|of|for|or|and|all|that|this|it|must|may|no|not|by|is|are|such|each|your|with|under|from|on|at|as)\b)"
              r"[^\s;:]+){2,4}(?:[ \t]+all rights reserved\.?)?[ \t]*$))")
_OTHER = r"[^\p{L}\p{N}]+"
_START = r"^[^\p{L}\p{N}]*[\p{L}\p{N}]+(?:[^\p{L}\p{N}]+[\p{L}\p{N}]+)?"


def _any_spelling() -> str:
    """One expression for a word or two of ``SPELLINGS``, told apart by their first letter."""
    ends: dict[str, list[str]] = {}
    for old in SPELLINGS:
        ends.setdefault(old[0], []).append(old[1:].replace(" ", "  "))
    return " (?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in ends.items()) + ") "


def _spelled(text: Column) -> Column:
    """The words of a lower-cased text, one space between them, in one spelling. Each rule is a pass
    over the text, so only texts that hold one of them are rewritten."""
    def rewritten(words):
        out = words
        for old, new in SPELLINGS.items():
            out = F.replace(out, F.lit(f" {old} ".replace(" ", "  ")[1:-1]), F.lit(f" {new} ".replace(" ", "  ")[1:-1]))
        return out

    # Two spaces between words, so that neighbours do not share one.
    words = F.concat(F.lit(" "), F.regexp_replace(text, _OTHER, "  "), F.lit(" "))
    return let(words, lambda w: F.trim(F.replace(
        F.when(w.rlike(_any_spelling()), rewritten(w)).otherwise(w), F.lit("  "), F.lit(" "))))


def canonical(text: Column) -> Column:
    return _spelled(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "(?md)" + _COPYRIGHT, " "))


def first_word(text: Column) -> Column:
    """First word of a line's canonical form, from the line's first two words (no rule joins more)."""
    return F.substring_index(_spelled(F.lower(F.regexp_extract(text, _START, 0))), " ", 1)


def digest(text: Column) -> Column:
    return F.coalesce(F.sha2(canonical(text), 256), F.lit(""))


def known_licenses(spark) -> DataFrame:
    """license_id and text of the default list, but for those in ``LONG``."""
    return spark.createDataFrame(KNOWN + HEADERS, "license_id string, text string")


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest of the canonical whole text, text_license (of that digest, or null) and
    line_licenses (ids of the licences that lines hold, sorted and comma-joined). ``known`` has
    license_id and text."""
    apply_defaults(docs.sparkSession)
    given = known_licenses(docs.sparkSession) if known is None else known
    long = docs.sparkSession.createDataFrame(LONG, "license_id string, first string, digest string") if known is None else None
    known = (given.select("license_id", digest(F.col("text")).alias("digest"),
                          F.substring_index(canonical(F.col("text")), " ", 1).alias("first"))
             .filter("first <> ''"))
    if long is not None:
        known = known.unionByName(long)
    known = (known.groupBy("digest", "first").agg(F.min("license_id").alias("license_id")))
    known = stored(known, "licences")
    whole = docs.select(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("digest"), *text_key(text_col))
    # Only a line that begins as a licence does can be one; the others are not hashed. What a line
    # holds belongs to its text, so rows that share an id but not a text keep theirs apart.
    lines = (docs.select(*text_key(text_col), F.explode(F.split(F.col(text_col), "\n")).alias("line"))
             .withColumn("first", first_word(F.col("line")))
             .join(small(known.select("first").distinct()), "first", "left_semi")
             .select("t1", "t2", digest(F.col("line")).alias("digest")))
    held = (lines.join(small(known.select("digest", "license_id")), "digest").groupBy("t1", "t2")
            .agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("line_licenses")))
    return (whole.join(small(known.select("digest", F.col("license_id").alias("text_license"))), "digest", "left")
            .join(held, ["t1", "t2"], "left")
            .select("doc_id", "digest", "text_license", F.coalesce("line_licenses", F.lit("")).alias("line_licenses")))


def scan_sql() -> str:
    """The same for DuckDB."""
    def form(text: str) -> str:
        lines = f"regexp_replace(lower(coalesce({text}, '')), '(?m){_SQL_COPYRIGHT}', ' ', 'g')"
        words = f"(' ' || regexp_replace({lines}, '{_OTHER}', ' ', 'g') || ' ')"
        for old, new in _SQL_SPELLINGS.items():
            words = f"replace({words}, '{old}', '{new}')"
        return f"sha256(trim({words}, ' '))"

    quoted = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in KNOWN)
    return f"""
WITH given(license_id, body) AS (VALUES {quoted}),
known AS (SELECT {form('body')} AS digest, min(license_id) AS license_id FROM given GROUP BY 1),
lines AS (SELECT DISTINCT text, unnest(string_split(text, chr(10))) AS line FROM documents),
held AS (
  SELECT text, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS line_licenses
  FROM lines JOIN known ON {form('line')} = digest GROUP BY 1
), whole AS (SELECT doc_id, text, {form('text')} AS digest FROM documents)
SELECT w.doc_id, w.digest, k.license_id AS text_license, coalesce(h.line_licenses, '') AS line_licenses
FROM whole w LEFT JOIN known k ON w.digest = k.digest LEFT JOIN held h ON w.text = h.text
"""
