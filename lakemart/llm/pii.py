"""Personal data: patterns, and terms that disclose whom it belongs to.

Base spans are e-mail addresses, IP addresses, card and phone numbers. Their values are the
protected entities. The corpus then tells how strongly a term reveals the entity: with P(e)
the share of documents that mention e, and P(e|t) the share of t's documents that do, the term
discloses PMI(t; e) = log2(P(e|t) / P(e)) of the entity's information IC(e) = -log2 P(e). P(e|t)
is drawn to P(e) as by one more document, so that few documents say less. A term whose share
PMI / IC exceeds a threshold, and that stands near e or is in several documents of it, is a span of kind ``term`` wherever it stands in the documents that mention the
entity: sanitising generalises it to its shape, and removes it above a second threshold. In
documents without the entity the term stays.

Everything is expressions, joins and aggregates of Spark SQL. Only documents with an entity give
candidates; their counts cover all documents. A document's words are paired with each of its
entities.

Positions are code points, the end exclusive. A null text is empty; empty texts have no spans.
Repeated rows are found each, and count as one document where they share an id; rows without
an id get base spans only. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import apply_defaults, let, small, stored

KINDS = ("email", "ip", "card", "phone", "term")

# Equivalent to the contract's patterns, without their backtracking: possessive, and not
# tried again inside a run of characters that has failed from its first one. ``guard`` is a
# character without which a text has no match.
PATTERNS = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Spans of a text that one step of a running sum takes together.
CHUNK = 256


@dataclass(frozen=True)
class Settings:
    """``window``: words on either side of a mention, at most ``reach`` characters away. ``support``:
    documents that must hold both an entity and a term that never stands near it. ``prior``: documents that the entity's own
    probability counts as in a term's. ``generalise``, ``remove``: shares of the entity's
    information that a term may disclose."""
    window: int = 3
    reach: int = 64
    support: int = 4
    prior: float = 1.0
    generalise: float = 0.9
    remove: float = 0.97


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        return s.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")
    if kind == "card":
        return F.length(_digits(s)).between(14, 19) & F.call_function("luhn_check", _digits(s))
    if kind == "phone":
        return F.length(_digits(s)).between(10, 15)
    return F.lit(True)


def _entity(kind: str, s: Column) -> Column:
    return F.lower(s) if kind in ("email", "ip") else _digits(s)


def _running(lengths: Column) -> Column:
    """Running sums of an array of ints, each including its own. Sums of chunks come first, so
    that no array is copied once per element however many there are."""
    zero = F.lit(0)
    add = lambda acc, x: acc + x
    chunks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / CHUNK).cast("int"))

    def within(k):
        part = F.slice(lengths, k * CHUNK + 1, CHUNK)
        base = F.aggregate(F.slice(lengths, F.lit(1), k * CHUNK), zero, add)
        return F.transform(part, lambda _, i: base + F.aggregate(F.slice(part, F.lit(1), i + 1), zero, add))

    return F.when(F.size(lengths) > 0, F.flatten(F.transform(chunks, within))).otherwise(F.array().cast("array<int>"))


def _spans_of(kind: str, text: Column) -> Column:
    """Array of (start, nth kind, end, value) of one kind: what stands between the matches and the
    matches themselves give the positions."""
    pattern, guard = PATTERNS[kind]
    p = F.lit(pattern)
    nth = KINDS.index(kind)
    empty = F.array().cast("array<struct<start:int,nth:int,end:int,value:string>>")

    def placed(found):
        between = F.split(text, pattern, -1)
        ends = _running(F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda b, m: F.length(b) + F.length(m)))
        return F.filter(
            F.zip_with(ends, found, lambda e, m: F.struct(
                (e - F.length(m)).alias("start"), F.lit(nth).alias("nth"), e.alias("end"), m.alias("value"))),
            lambda s: _valid(kind, s["value"]))

    spans = let(F.regexp_extract_all(text, p, F.lit(0)), lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(empty))
    if guard is None:
        # Few texts hold a run that long; most of the work is to say so.
        return F.when(text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"), spans).otherwise(empty)
    return F.when(F.instr(text, F.lit(guard)) > 0, spans).otherwise(empty)


def base_spans(text: Column) -> Column:
    """All base spans of a text by start, then kind."""
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(*(_spans_of(k, text) for k in KINDS[:4])))


def _contexts(found: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, entity, term: the words near each mention, or a null term where it has none. ``found``: doc_id, text, base."""
    reach, window = settings.reach, settings.window
    word = r"[^\p{L}\p{N}]+"
    mention = found.select("doc_id", "text", F.explode("base").alias("s")).select(
        "doc_id", F.concat(F.element_at(F.array(*map(F.lit, KINDS)), F.col("s.nth") + 1), F.lit(":"),
                           F.when(F.col("s.nth") <= 1, F.lower("s.value")).otherwise(_digits(F.col("s.value")))).alias("entity"),
        F.greatest(F.col("s.start") - reach, F.lit(0)).alias("from"), F.col("s.start").alias("start"), F.col("s.end").alias("end"),
        "text")
    mention = mention.select(
        "doc_id", "entity", "from", "start", "end",
        F.col("text").substr(F.col("from") + 1, F.col("start") - F.col("from")).alias("before"),
        F.col("text").substr(F.col("end") + 1, F.lit(reach)).alias("after"))

    def words(side: Column, at: Column) -> Column:
        """(start, end, word) of the words in a short string that begins at ``at``."""
        found = F.regexp_extract_all(side, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
        return let(found, lambda w: let(F.split(side, r"[\p{L}\p{N}]+", -1), lambda gap: F.zip_with(
            _running(F.zip_with(F.slice(gap, F.lit(1), F.size(w)), w, lambda g, x: F.length(g) + F.length(x))), w,
            lambda e, x: F.struct((at + e - F.length(x)).alias("start"), (at + e).alias("end"), x.alias("word")))))

    # A word that the reach cuts off is none.
    before = F.filter(words(F.col("before"), F.col("from")), lambda w: (w["start"] > F.col("from")) | (F.col("from") == 0))
    after = F.filter(words(F.col("after"), F.col("end")), lambda w: w["end"] < F.col("end") + reach)
    near = F.concat(F.slice(F.reverse(before), F.lit(1), F.lit(window)), F.slice(after, F.lit(1), F.lit(window)))
    return (mention.select("doc_id", "entity", F.explode_outer(near).alias("w"))
            .select("doc_id", "entity", F.lower("w.word").alias("term")).distinct())


def _pairs(mentioned: DataFrame, contexts: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, entity, n_entity (its documents), term, near: the words of each document with each of
    its entities; with an entity of one document, only the words near it."""
    entities = contexts.groupBy("doc_id", "entity").agg(F.collect_set("term").alias("close"))
    n_entity = entities.groupBy("entity").agg(F.count("*").alias("n_entity"))
    words = F.array_distinct(F.split(F.lower(F.col("text")), r"[^\p{L}\p{N}]+"))
    texts = mentioned.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list(words))).alias("words"))
    words_of = F.when(F.col("n_entity") < F.least(F.lit(2), F.lit(settings.support)), F.col("close")).otherwise(F.col("words"))
    return (entities.join(n_entity, "entity").join(texts, "doc_id")
            .select("doc_id", "entity", "n_entity", "close", F.explode(words_of).alias("term")).filter("term <> ''")
            .select("doc_id", "entity", "n_entity", "term", F.array_contains("close", F.col("term")).alias("near")))


def _document_counts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(term, n_term: documents that hold it) and the number of documents. Rows of one id are one
    document, rows without an id one each. Words are counted before they are shuffled, so that
    none moves more than once for each task; only those of repeated ids move by document."""
    words = F.array_distinct(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}\p{N}]+"))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.explode(words).alias("term")).filter("term <> ''")
    ids = docs.select(F.col(id_col).cast("long").alias("_id"))
    repeated = stored(ids.filter("_id IS NOT NULL").groupBy("_id").agg(F.count("*").alias("rows")).filter("rows > 1"), "repeated")
    surplus = repeated.agg(F.sum(F.col("rows") - 1)).first()[0] or 0
    n = (docs.count() - surplus) or 1
    if surplus:
        known = small(repeated.select("_id"))
        again = rows.join(known, "_id", "left_semi").distinct()
        rows = rows.join(known, "_id", "left_anti").unionByName(again)
    return rows.groupBy("term").agg(F.count("*").alias("n_term")), n


def disclosing_terms(docs: DataFrame, pairs: DataFrame, settings: Settings = Settings(), text_col: str = "text",
                     id_col: str = "doc_id") -> DataFrame:
    """entity, term and share (PMI / IC) of the terms above the lower threshold."""
    both = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_both"), F.max("n_entity").alias("n_entity"),
                                               F.max("near").alias("near"))
    # Fewer documents do not tell a disclosing word from any rare word of theirs, unless it stands near the entity.
    both = both.filter(F.col("near") | (F.col("n_both") >= settings.support))
    counts, n = _document_counts(docs, id_col, text_col)
    p_entity = F.col("n_entity") / F.lit(n)
    # An entity of all documents has no information to disclose.
    both = both.filter(F.col("n_entity") < n)
    given = F.least((F.col("n_both") + settings.prior * p_entity) / (F.col("n_term") + settings.prior), F.lit(1.0))
    return (both.join(counts, "term").select("entity", "term", (F.log2(given / p_entity) / -F.log2(p_entity)).alias("share"))
            .filter(F.col("share") > settings.generalise))


def _term_spans(text: Column, terms: Column) -> Column:
    """Spans of all words of a text that are keys of the map ``terms``, in any case; its values are theirs."""
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(F.map_keys(terms), "|"), F.lit(r")(?![\p{L}\p{N}])"))

    def placed(found):
        between = F.split(text, pattern, -1)
        ends = _running(F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda b, m: F.length(b) + F.length(m)))
        return F.zip_with(ends, found, lambda e, m: F.struct(
            (e - F.length(m)).alias("start"), F.lit(KINDS.index("term")).alias("nth"), e.alias("end"),
            F.coalesce(F.element_at(terms, F.lower(m)), F.lit("[WORD]")).alias("value")))

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), placed)


def find(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), ``base`` and ``spans``: arrays of (start, nth kind, end,
    value) by start, then kind; a term's value is what it becomes."""
    apply_defaults(docs.sparkSession)
    based = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("id"),
                        base_spans(F.col(text_col)).alias("base"))
    mentioned = stored(based.filter((F.size("base") > 0) & F.col("id").isNotNull())
                       .select(F.col("id").alias("doc_id"), F.col(f"row.{text_col}").alias("text"), "base"), "mentions")
    contexts = _contexts(mentioned, settings)
    pairs = stored(_pairs(mentioned, stored(contexts, "contexts"), settings), "pairs")
    terms = disclosing_terms(docs, pairs, settings, text_col, id_col)
    shape = F.when(F.col("share") > settings.remove, "").when(F.col("term").rlike("^[0-9]+$"), "[NUMBER]").otherwise("[WORD]")
    marked = (pairs.join(terms, ["entity", "term"]).groupBy("doc_id", "term").agg(F.min(shape).alias("value"))
              .groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("term", "value"))).alias("terms")))
    marked = stored(marked, "terms")
    free = lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    empty = F.array().cast("array<struct<start:int,nth:int,end:int,value:string>>")
    terms_here = F.when(F.col("terms").isNotNull(), F.filter(_term_spans(F.col(f"row.{text_col}"), F.col("terms")), free)).otherwise(empty)
    return (based.join(marked, based["id"] == marked["doc_id"], "left")
            .select("row", "base", F.array_sort(F.concat("base", F.coalesce(terms_here, empty))).alias("spans")))


def spans_text(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["nth"] + 1), s["start"], s["end"])), ",")


def sanitise(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data replaced by its kind, and disclosing terms generalised or removed.
    Spans that overlap become one, named after the first."""
    found = find(docs, settings, id_col, text_col)
    text, spans = F.coalesce(F.col(f"row.{text_col}"), F.lit("")), F.col("spans")
    label = lambda s: F.when(s["nth"] == KINDS.index("term"), s["value"]).otherwise(F.concat(
        F.lit("["), F.upper(F.element_at(F.array(*map(F.lit, KINDS)), s["nth"] + 1)), F.lit("]")))
    # Where the text before each span ends and continues: the furthest end of the spans before it.
    reached = F.transform(spans, lambda _, i: F.aggregate(F.slice(spans, F.lit(1), i), F.lit(0), lambda a, s: F.greatest(a, s["end"])))
    parts = F.zip_with(spans, reached, lambda s, r: F.when(s["start"] >= r, F.concat(
        F.substring(text, r + 1, s["start"] - r), label(s))).otherwise(""))
    last = F.aggregate(spans, F.lit(0), lambda a, s: F.greatest(a, s["end"]))
    cleaned = F.concat(F.array_join(parts, ""), F.substring(text, last + 1, F.length(text)))
    kept = F.when(F.size("spans") > 0, cleaned).otherwise(F.col(f"row.{text_col}"))
    return found.select(*(kept.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns))


def with_length(docs: DataFrame, text_col: str, length_col: str) -> DataFrame:
    """``docs`` with ``length_col``, if there is one, set to the code points of the text."""
    if length_col not in docs.columns:
        return docs
    kind = docs.schema[length_col].dataType
    return docs.withColumn(length_col, F.length(text_col).cast(kind)).select(*docs.columns)
