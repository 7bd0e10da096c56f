"""Graph neighbours, SimHash groups and decontamination against brute force."""

import math
import re

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.llm import ann, components, decontamination, simhash
from lakemart.llm.queries import ORACLES, QUERIES
from llm_fixtures import LONG, awkward_docs, empty_docs, words

SF01 = "/root/testdata/sf0.01"


def brute_neighbours(rows, asks, k):
    usable = {}
    for i, v in sorted((r for r in rows if r[0] is not None and r[1]), key=lambda r: (r[0], r[1]) if None not in r[1] else (r[0], [])):
        if None not in v and all(map(math.isfinite, v)) and any(v):
            usable.setdefault(i, np.array(v, float))
    out = {}
    for q, a in usable.items():
        if asks(q):
            scored = sorted((-float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), i) for i, b in usable.items()
                            if i != q and len(a) == len(b))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_neighbours_of_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(120)]
    rows += [(i, [1.0, 0.0] * 4) for i in range(200, 230)]  # one vector, many ids
    rows += [(300, None), (350, []), (400, [0.0] * 8), (450, [1.0, None] * 4), (500, [float("nan")] * 8),
             (550, [float("inf")] + [1.0] * 7), (600, [1.0, 2.0]), (650, [2.0, 1.0]), (None, [1.0] * 8), (50, rows[50][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("rank", F.lit(1))
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute_neighbours(rows, lambda q: q % 50 == 0, 5)
    assert got.keys() == {q for q in want if want[q]}
    for q in got:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12), q
    assert [i for i, _ in got[200]] == [201, 202, 203, 204, 205]


def test_no_vectors(spark):
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).count() == 0


def test_neighbour_recall(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    want = brute_neighbours(rows, lambda q: q % 50 == 0, 5)
    got = QUERIES["op1_graph_neighbours"](spark, SF01).collect()
    assert len(got) == sum(map(len, want.values()))
    hits = sum((r["vec_id"] in dict(want[r["query_id"]])) for r in got)
    assert hits >= 0.9 * len(got)


def test_graph_recall_on_a_larger_shard():
    v = ann._unit(np.random.default_rng(5).normal(size=(2500, 24)))
    graph, q = ann.Graph(v), v[::40]
    exact = np.argsort(-(q @ v.T), 1)[:, :6]
    found = graph.search(q, 6)
    assert np.mean([len(set(a) & set(b)) / 6 for a, b in zip(exact.tolist(), found.tolist())]) > 0.95
    assert (graph.degree <= graph.s.degree).all()


def plain_fingerprint(text, each=4):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if x]
    grams = [" ".join(w[i:i + each]) for i in range(max(1, len(w) - each + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_groups(fps, most):
    group = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in fps:
            least = min(group[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= most)
            if least < group[i]:
                group[i], changed = least, True
    return group


def test_simhash_of_awkward_rows(spark):
    docs = awkward_docs(spark)
    given_rows = docs.select("doc_id", "text").collect()
    fps = {r["doc_id"]: plain_fingerprint(r["text"]) for r in given_rows if r["doc_id"] is not None}
    want = brute_groups(fps, 4)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(given_rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["fingerprint"], r["component_id"]) == (f"{fps[r['doc_id']]:016x}", want[r["doc_id"]])
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(want.values())) and ids.count(None) == 2


def test_simhash_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    want = brute_groups(fps, 4)
    got = QUERIES["op6_simhash_gray"](spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{fps[i]:016x}", want[i]) for i in fps}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=40), st.lists(st.integers(0, 63), max_size=60), st.integers(0, 6))
def test_gray_tree_finds_all(base, flips, most):
    fps = sorted({b for b in base} | {base[i % len(base)] ^ (1 << f) for i, f in enumerate(flips)})
    a = np.array(fps, np.uint64)
    a = a[np.argsort(simhash.gray_rank(a))]
    q, hit = simhash.GrayTree(a).search(a, most)
    want = {(i, j) for i in range(len(a)) for j in range(len(a)) if (int(a[i]) ^ int(a[j])).bit_count() <= most}
    assert set(zip(q.tolist(), hit.tolist())) == want


def test_gray_rank_inverts_the_gray_code():
    n = np.arange(1000, dtype=np.uint64)
    assert (simhash.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def test_several_blocks_give_the_same_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 1)
    rng = np.random.default_rng(2)
    base = rng.integers(-2**63, 2**63 - 1, 60)
    fps = np.unique(np.concatenate([base ^ (1 << int(k)) for k in rng.integers(0, 62, 6)] + [base]))
    df = spark.createDataFrame([(int(f), i) for i, f in enumerate(fps)], "fp long, rep long")
    links = simhash.near_links(df, 4)
    got = {r["node"]: r["component"] for r in components.components(links).collect()}
    want = brute_groups({i: int(f) & (2**64 - 1) for i, f in enumerate(fps)}, 4)
    assert {i: got.get(i, i) for i in want} == want


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(500, 500 + i) for i in range(1, 40)] + [(7, 520), (520, 7), (3, 3)]
    df = spark.createDataFrame(chain + star, "u long, v long")
    got = {r["node"]: r["component"] for r in components.components(df).collect()}
    assert all(got[i] == 100 for i in range(100, 141))
    assert all(got[i] == 7 for i in [7, *range(500, 540)]) and 3 not in got
    assert components.components(df.filter("u < 0")).count() == 0


def test_simhash_of_nothing(spark):
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0


ITEM = words(11, 20)


def test_contained_items(spark):
    w = ITEM.split()
    partly = " ".join(w[:17] + ["other", "words"])  # 13 of 16 shingles
    less = " ".join(w[:16] + ["other", "words"])  # 12 of 16
    docs = spark.createDataFrame(
        [(1, f"{LONG} {ITEM.upper()}! {LONG}"), (2, partly), (3, less), (4, None), (5, ""), (6, "two words"), (7, ITEM),
         (7, ITEM), (None, ITEM), (8, "Two... Words"), (9, LONG)], "doc_id long, text string").withColumn("size", F.lit(1)).withColumn(
        "hit", F.lit("x"))
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "two words"), (5, ITEM), (5, ITEM)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["containment"] for r in decontamination.contained_items(docs, items).collect()}
    both = {(d, i): c for d, c in ((1, 1.0), (2, 13 / 16), (7, 1.0)) for i in (1, 5)}
    assert got == {**both, (6, 4): 1.0, (8, 4): 1.0}
    kept = decontamination.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [3, 4, 5, 9]  # a row without an id is judged by its text too
    kept = decontamination.drop_contaminated(docs, items, least_words=3)  # two words tell nothing
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [3, 4, 5, 6, 8, 9]
    assert decontamination.contained_items(empty_docs(spark), items).count() == 0
    assert decontamination.contained_items(docs, items.filter("item_id < 0")).count() == 0


def test_bitmaps_hold_exactly_their_hashes(spark):
    rng = np.random.default_rng(1)
    h = rng.integers(-2**63, 2**63 - 1, 500)
    df = spark.createDataFrame([(int(x),) for x in h], "h long").withColumn("one", F.lit(0))
    bitmap = decontamination._bitmaps(df, "one")[0]
    assert decontamination._has(bitmap, h.view(np.uint64)).all()
    assert int(np.unpackbits(bitmap).sum()) == len(np.unique(h.view(np.uint64) & np.uint64(decontamination.BITS - 1)))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF01}/{t}.parquet'")
    want = con.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, SF01).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    rows = lambda df: sorted(map(tuple, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()), key=str)
    assert rows(got) == rows(want)


def test_short_items_are_found_inside_longer_documents(spark):
    items = spark.createDataFrame([(1, "Blue whale?"), (2, "zebra"), (3, "one two three four"), (4, "a b c d e f")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "the answer is a blue, WHALE or some other thing"), (2, "zebra"), (3, "zero one two three four five six"),
                                  (4, "whale blue whales"), (5, "blue whale zebra"), (6, "one two three"), (7, "x a b c d e f")],
                                 "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["shared"]) for r in decontamination.contained_items(docs, items).collect()}
    assert got == {(1, 1, 1), (2, 2, 1), (3, 3, 1), (5, 1, 1), (5, 2, 1), (7, 4, 2)}


def test_rows_of_one_id_are_judged_each_by_their_text(spark):
    item = words(11, 20)
    docs = spark.createDataFrame([(1, item), (1, "other words " * 9), (None, item), (None, "clean text " * 9), (2, item), (2, item)],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = decontamination.drop_contaminated(docs, items).collect()
    assert sorted(((r["doc_id"] or 0), r["text"][:5]) for r in kept) == [(0, "clean"), (1, "other")]
    got = sorted(tuple(r) for r in decontamination.contained_items(docs, items).collect())
    assert got == [(1, 1, 16, 16, 1.0), (2, 1, 16, 16, 1.0)]


def test_boilerplate_of_all_items_makes_no_candidates(spark):
    """The signature takes shingles that few items hold, so a shared preamble alone leads nowhere."""
    preamble = words(50, 12)
    items = spark.createDataFrame([(i, f"{preamble} {words(100 + i, 40)}") for i in range(20)], "item_id long, text string")
    shingles = decontamination.item_shingles(items, "item_id", "text", 5, 0.8)
    signature = shingles.filter("nth <= q - need + 1")
    assert signature.filter("items > 1").isEmpty() and signature.select("item_id").distinct().count() == 20


def test_decontamination_sql_states_the_rules_for_short_items(spark):
    docs = spark.createDataFrame([(1, "the answer is a blue, WHALE or some other thing"), (2, "zebra"), (3, "zero one two three four five six"),
                                  (5, "blue whale zebra"), (7, "x a b c d e f"), (8, None), (9, "")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "Blue whale?"), (2, "zebra"), (3, "one two three four"), (4, "a b c d e f"), (5, None)],
                                  "item_id long, text string")
    con = duckdb.connect()
    for name, df in (("documents", docs), ("benchmark", items)):
        con.register(name, df.toPandas())
    want = sorted(con.execute(ORACLES["op7_decontamination"]).fetchall())
    assert sorted(tuple(r) for r in decontamination.contained_items(docs, items).collect()) == want and len(want) == 6


def test_near_duplicate_filter_decides_by_row(spark):
    a, z, q, r = (words(60 + i, 40) for i in range(4))
    rows = [(1, a, "x"), (2, a, "x"), (2, z, "x"), (3, q, "x"), (3, r, "x"), (4, z, "x"), (5, q, "one"), (5, q, "two"), (None, a, "x"),
            (None, words(70, 40), "x"), (6, None, "x"), (7, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn("group", F.lit(1)).withColumn("t1", F.lit(1))
    for _ in range(2):
        kept = simhash.drop_near_duplicates(docs.repartition(3))
        assert kept.columns == docs.columns
        assert sorted(((k["doc_id"] or 0), k["text"] or "") for k in kept.collect()) == sorted(
            [(1, a), (2, z), (3, q), (3, r), (0, a), (0, words(70, 40)), (6, "")])
    again = simhash.drop_near_duplicates(docs.filter("doc_id = 5").union(docs.filter("doc_id = 5"))).collect()
    assert len(again) == 1


def test_neighbours_of_very_large_and_very_small_components(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e200, 0.0]), (2, [1e-300, 1e-300]), (3, [0.0, 5e-324]), (4, [1e308, 1e308])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["vec_id"], round(r["score"], 9)) for r in ann.nearest(df, F.col("vec_id") % 50 == 0).orderBy("rank").collect()]
    assert got == [(2, 1.0), (4, 1.0), (1, round(math.sqrt(0.5), 9)), (3, round(math.sqrt(0.5), 9))]
