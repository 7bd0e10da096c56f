"""Fill-in-the-middle, periodic runs and embedding near-duplicates against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import awkward_docs, empty_docs
from pyspark.sql import functions as F

from lakemart.llm import embedding_dedup, fill_middle, queries, runs

SF001 = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- fill in the middle --------------------------------------------------------
def mixed(doc_id, text):
    """What the contract says of one document, by string slices."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_middle_of_awkward_documents(spark):
    docs = awkward_docs(spark).unionByName(spark.createDataFrame(
        [(100 + i, t) for i, t in enumerate(["has <M> inside", "<P", "a<S", ">b<", "漢字 and 😀 words", "é" * 50])], "doc_id long, text string"),
        allowMissingColumns=True)
    got = fill_middle.restore(fill_middle.fill_in_middle(docs)).collect()
    want = [(r.doc_id, *mixed(r.doc_id, r.text), r.text or "") for r in docs.collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_nothing(spark):
    out = fill_middle.restore(fill_middle.fill_in_middle(empty_docs(spark)))
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"] and out.isEmpty()


@pytest.mark.parametrize("window,piece", [(1 << 20, 4 << 20), (7, 50)])
def test_bytes_move_in_windows_and_slices(monkeypatch, window, piece):
    monkeypatch.setattr(fill_middle, "WINDOW", window)
    monkeypatch.setattr(fill_middle, "SLICE", piece)
    rnd = random.Random(3)
    letters = ["a", "Bc", "é", " ", "\n", "漢", "😀", "<", "P", ">", "<P>", "1", "S", "M"]
    for _ in range(60):
        texts = [None if rnd.random() < 0.1 else "".join(rnd.choices(letters, k=rnd.randint(0, 25))) for _ in range(rnd.randint(0, 12))]
        drawn = np.array([[rnd.randrange(2**32) for _ in range(4)] for _ in texts], np.int64).reshape(-1, 4)
        data, bounds = fill_middle.text_bytes(pa.array(texts, pa.string()))
        back = []
        for lo, hi in fill_middle._slices(bounds):
            out, at, _, form, _, _ = fill_middle._mix(data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo], drawn[lo:hi], 90, 20)
            back += fill_middle.bytes_column(*fill_middle._unmix(out, at, form)).to_pylist()
        assert back == [t or "" for t in texts]


def test_an_output_without_its_markers_is_an_error():
    data, bounds = fill_middle.text_bytes(pa.array(["<P>a<S>b"]))
    with pytest.raises(ValueError):
        fill_middle._unmix(data, bounds, np.array([fill_middle.PSM]))


def test_fill_in_middle_query(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op11_fill_in_middle"](spark, SF001).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        n, form, prefix, middle, output = mixed(r.doc_id, r.text)
        assert tuple(got[r.doc_id]) == (r.doc_id, n, form, prefix, middle, sha(output), sha(r.text or ""))


# -- periodic runs -------------------------------------------------------------
def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, found):
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def repetitive(rnd):
    words = rnd.choices("abcd"[:rnd.randint(1, 4)], k=rnd.randint(0, 60))
    for _ in range(rnd.randint(0, 3)):
        part = rnd.choices("abcdef", k=rnd.randint(1, 7))
        at = rnd.randint(0, len(words))
        words[at:at] = part * rnd.randint(2, 9) + part[:rnd.randint(0, len(part))]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_documents(monkeypatch, seed):
    monkeypatch.setattr(runs, "CANDIDATES", 16 if seed % 2 else 1 << 18)
    rnd = random.Random(seed)
    for _ in range(40):
        texts = [repetitive(rnd) for _ in range(rnd.randint(1, 10))]
        got = runs._analyse([[w.encode() for w in t] for t in texts])
        for words, (found, text) in zip(texts, got):
            want = brute_runs(words)
            assert list(map(tuple, found)) == want
            assert text.decode() == collapsed(words, want)


def test_every_derivation_position_of_a_nonterminal_gets_its_runs():
    part = "x y z".split() * 5
    texts = [part + ["end", str(i)] + part for i in range(20)]
    for words, (found, _) in zip(texts, runs._analyse([[w.encode() for w in t] for t in texts])):
        assert found == [(0, 15, 3), (17, 15, 3)] == brute_runs(words)


def test_runs_of_one_word_and_of_long_periods():
    assert runs._analyse([[b"a"] * 50_000])[0] == ([(0, 50_000, 1)], b"a")
    words = [str(i).encode() for i in range(5_000)]
    assert runs._analyse([words * 4])[0][0] == [(0, 20_000, 5_000)]
    assert runs._analyse([words * 4 + words[:-1]] * 2)[1][0] == [(0, 24_999, 5_000)]
    assert runs._analyse([(words * 4)[:-1]])[0][0] == []


def test_grammar_derives_every_position(monkeypatch):
    rnd = random.Random(1)
    words = np.array(rnd.choices(range(5), k=500))
    doc = np.repeat([0, 1], 250)
    for start, middle, end, name in runs.grammar(words, doc):
        assert ((start < middle) & (middle < end)).all() and (doc[start] == doc[end - 1]).all()
        for k in np.unique(name):
            assert len({tuple(words[a:b]) for a, b in zip(start[name == k], end[name == k])}) == 1


def test_runs_of_awkward_documents(spark):
    docs = awkward_docs(spark).unionByName(spark.createDataFrame(
        [(200, "go " * 9 + "on"), (None, "so\tso\nso\x0bso\x0cso\rso so"), (201, "né né né né né né"), (201, "né né né né né né"),
         (202, "a\xa0b " * 4 + "end"), (203, "no no no no no")], "doc_id long, text string"), allowMissingColumns=True)
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(docs).collect()]
    want = []
    for r in docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        found = brute_runs(words) if len(words) < 2000 else []
        want.append((r.doc_id, len(words), found, collapsed(words, found)))
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    got, want = ([r for r in sorted(rows, key=key) if r[1] < 2000] for rows in (got, want))
    assert got == want and len(got) > 15
    assert runs.periodic_runs(empty_docs(spark)).isEmpty()


def test_periodic_runs_query(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op12_periodic_runs"](spark, SF001).collect()}
    rows = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    assert len(got) == len(rows)
    some = 0
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        found = brute_runs(words)
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        some += bool(found)
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in found)
        milli = 1000 * best[1] // best[2] if found else None
        assert tuple(got[r.doc_id]) == (r.doc_id, len(found), *best, milli, sha(lines), sha(collapsed(words, found)))
    assert some > 5


# -- embedding near-duplicates -------------------------------------------------
def brute_links(rows, cosine=0.98):
    """vec_id to (n_links, component, kept) of (vec_id, label, vector) rows with distinct ids."""
    use = {}
    for i, label, v in rows:
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            x = x / np.abs(x).max()
            use[i] = (label, x / np.linalg.norm(x))
    near = {i: [j for j in use if j != i and use[j][0] == use[i][0] and len(use[j][1]) == len(use[i][1])
                and float(use[i][1] @ use[j][1]) >= cosine] for i in use}
    out = {}
    for i, _, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = (len(near.get(i, ())), min(seen), i == min(seen))
    return out


def clustered(seed, n, dims=16):
    """Vectors in chains and clusters about the threshold, with copies, in three labels."""
    rnd = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        kind = rnd.integers(4)
        if kind == 0 or not rows:
            v = rnd.standard_normal(dims)
        else:
            v = np.array(rows[rnd.integers(len(rows))][2])
            if kind > 1:
                v = v + rnd.standard_normal(dims) * np.linalg.norm(v) / np.sqrt(dims) * rnd.choice([0.02, 0.1, 0.2])
        rows.append((i, int(rnd.integers(3)) if kind != 1 else rows[rnd.integers(len(rows))][1] if rows else 0, v.astype(np.float32).tolist()))
    return rows


VECTORS = "vec_id long, label int, embedding array<float>"


def result(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("tile,levels", [(2048, 0), (16, 1), (16, 3)])
def test_embedding_links_in_tiles_and_cells(spark, monkeypatch, tile, levels):
    """The grid of several projections and cells of many tiles give what one tile gives."""
    rows = clustered(4, 400)
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    if levels:
        monkeypatch.setattr(embedding_dedup, "THINNED", (4 * tile / 200) ** (1 / levels) + 1e-9)
    settings = embedding_dedup.Settings(recall=0.999999, width=2.5)
    got = result(embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS), settings=settings))
    want = brute_links(rows)
    assert got == want
    assert max(n for n, _, _ in want.values()) > 5


def test_recall_at_exactly_the_least_cosine():
    """Pairs at cosine 0.98 are the hardest that must be found."""
    rnd = np.random.default_rng(0)
    n, dims = 3000, 64
    a = embedding_dedup.unit(rnd.standard_normal((n, dims)))
    b = rnd.standard_normal((n, dims))
    b = embedding_dedup.unit(b - (b * a).sum(1, keepdims=True) * a)
    near = 0.98 * a + math.sqrt(1 - 0.98 ** 2) * b
    cal = embedding_dedup.Calibration(0.98, 2, embedding_dedup.Settings())
    lines = cal.directions(dims)
    apart = np.abs((a - near).astype(np.float32) @ lines)
    found = ((apart[:, 2:] <= cal.half).sum(1) >= cal.least) & (apart[:, :2] <= cal.reach).all(1)
    assert found.mean() >= 0.996
    far = np.abs((a - np.roll(a, 1, 0)).astype(np.float32) @ lines[:, 2:])
    assert ((far <= cal.half).sum(1) >= cal.least).mean() < 0.01  # the count does rule out the rest


def test_least_count_is_the_greatest_that_is_reached_often_enough():
    assert embedding_dedup.least_count(4, 0.5, 0.9) == 1
    assert embedding_dedup.least_count(4, 0.5, 0.6) == 2
    assert embedding_dedup.least_count(5, 1.0, 0.999) == 5


def test_embeddings_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, [1.0, 0.0]), (2, 1, [1.0, 0.0]), (3, 1, [2.0, 0.0]), (4, 1, [0.0, 0.0]), (5, 1, None), (6, 1, []), (7, 1, [1.0, None]),
            (8, 1, [nan, 1.0]), (9, 1, [inf, 1.0]), (10, None, [1.0, 0.0]), (11, 2, [1.0, 0.0]), (12, 1, [1.0, 0.0, 0.0]),
            (13, 1, [1e30, 1e28]), (14, 1, [1e-30, 0.0]), (15, 1, [-1.0, 0.0])]
    nameless = [(None, 1, [1.0, 0.0]), (None, None, None)]
    df = spark.createDataFrame(rows + nameless, VECTORS).withColumn("rep", F.lit("x")).withColumn("n", F.lit("x")).withColumn("u", F.lit("x"))
    got = embedding_dedup.near_duplicates(df).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None} == brute_links(rows)
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)] * 2
    assert len(got) == 17
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).isEmpty()


def test_rows_of_one_vector_id_count_once(spark):
    rows = [(1, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 1, [1.0, 0.01]), (2, 1, [0.0, 1.0])]
    assert result(embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS))) == {1: (0, 1, True), 2: (0, 2, True)}


def test_embedding_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    assert result(queries.QUERIES["op13_embedding_near_dedup"](spark, "/root/testdata/sf0.01")) == brute_links(rows)
