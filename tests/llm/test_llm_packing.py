"""Best-fit packing and the token store against direct encoding and naive packing."""

import bisect
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
import xxhash
from tokenizers import Tokenizer

from lakemart.llm import packing, token_store
from lakemart.llm.common import tokenizer_path, workspace
from lakemart.llm.queries import QUERIES
from lakemart.llm.tokens import Encoder
from llm_fixtures import awkward_docs, empty_docs

SF001 = "/root/testdata/sf0.001"
ODD = ["", " ", "  a", "a  ", "a\n\nb", "it's  we'll\tgo", "x y 12 34a", "J̌́ ΣΑΣ İx", "日本語 テスト", "<|endoftext|> hi",
       "a\x1cb c", "😀 😀 ok!!", "\r\n a\r\n", "é́ ñ ñ", "''s 's 'sa", None, "ſS ŉ ǅ", "½ ²3 a_b", "“quoted” — dash", "a\x01b"]


def naive_sequences(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, n)
        room = rooms.pop(i) if i < len(rooms) else capacity
        bisect.insort(rooms, room - n)
    return Counter(rooms)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120), st.integers(40, 64))
def test_runs_equal_piecewise_best_fit(lengths, capacity):
    histogram = Counter(lengths)
    used, ranks = Counter(), Counter()
    for length, rank, n, first, each, offset in packing.plan_runs(histogram, capacity):
        assert rank == ranks[length]
        ranks[length] += n
        for k in range(n):
            assert used[first + k // each] == offset + k % each * length
            used[first + k // each] += length
    assert ranks == histogram
    assert Counter(capacity - n for n in used.values()) == naive_sequences(lengths, capacity)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library_on_whole_texts(spark, name):
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    e = Encoder(tokenizer_path(name))
    assert e.kind != "whole"
    for _ in range(2):  # new words, then known ones
        got = [np.frombuffer(x, "<u4").tolist() for x in e.encode(texts)]
        assert got == [x.ids for x in e.tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_packed(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    rooms = Counter(capacity - sum(n for _, n in p) for p in by_sequence.values())
    assert rooms == naive_sequences([r["length"] for r in rows], capacity)


def test_packing_of_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), capacity=64).collect()
    check_packed(rows, 64)
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = Counter()
    for r in docs.collect():
        ids = np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        for k in range(0, len(ids), 64):
            part = ids[k:k + 64]
            want[(r["doc_id"], k // 64, k, len(part), zlib.crc32(part.tobytes()))] += 1
    assert want == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)


def test_sequences_hold_their_pieces(spark):
    packed = packing.pack(awkward_docs(spark), tokenizer_path("word_bpe_49k.json"), capacity=128, with_ids=True)
    rows = packed.collect()
    made = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    for r in rows:
        assert made[r["sequence_id"]][4 * r["offset"]:4 * (r["offset"] + r["length"])] == bytes(r["ids"])


def test_empty_tables(spark):
    assert packing.pack(empty_docs(spark), tokenizer_path("word_bpe_49k.json")).count() == 0
    folder = workspace(spark, "tokens-test")
    token_store.write(empty_docs(spark), folder, tokenizer_path("byte_bpe_50k.json"))
    assert token_store.directory(spark, folder).count() == 0
    assert token_store.lookup(empty_docs(spark).select("doc_id"), folder).count() == 0
    assert token_store.lookup(awkward_docs(spark).select("doc_id").distinct(), folder).count() == 0


def test_packing_query(spark):
    rows = QUERIES["op4_best_fit_packing"](spark, SF001).collect()
    check_packed(rows, 2048)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(-2**63, 2**63 - 1), max_size=300), st.integers(-2**63, 2**63 - 1))
def test_perfect_hash(keys, stranger):
    keys = np.array(sorted(keys), np.int64)
    mph = token_store.PerfectHash.build(keys)
    assert sorted(mph.slots(keys).tolist()) == list(range(len(keys)))
    assert mph.slots(np.array([stranger]))[0] < max(1, len(keys))


def expected_store(docs):
    """(doc_id, ids) of all rows in the store's order: by key, null first, then by hash of the ids."""
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    ids = lambda t: np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
    tie = lambda raw: np.array([xxhash.xxh64_intdigest(np.frombuffer(raw, "<u4").astype("<u2").tobytes(), 42)], np.uint64).view(np.int64)[0]
    rows = [(r["doc_id"], ids(r["text"])) for r in docs.select("doc_id", "text").collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1])))


@pytest.mark.parametrize("shards", [1, 3, 7])
def test_store_round_trip_and_keyed_access(spark, shards):
    hot = spark.createDataFrame([(4, f"text number {i}") for i in range(40)] + [(None, f"other {i}") for i in range(20)], "doc_id long, text string")
    docs = awkward_docs(spark).unionByName(hot, allowMissingColumns=True)
    folder = workspace(spark, "tokens-test")
    token_store.write(docs, folder, tokenizer_path("byte_bpe_50k.json"), shards=shards)
    rows = token_store.directory(spark, folder).orderBy("no").collect()
    assert len(rows) <= shards + 1 and sum(r["nulls"] for r in rows) == 22
    if shards == 7:  # one key, and the rows without one, fill several shards
        assert sum(r["low"] is not None and r["low"] <= 4 <= r["high"] for r in rows) > 1
    bases = {r["shard"]: r["base"] for r in token_store.bases(spark, folder).collect()}
    found = token_store.lookup(docs.select("doc_id").distinct(), folder).collect()
    got = sorted(((bases[r["shard"]] + r["start"], r["doc_id"], bytes(r["ids"])) for r in found))
    at = 0
    for (doc_id, raw), (start, found_id, found_raw) in zip(expected_store(docs), got, strict=True):
        assert (start, found_id, found_raw) == (at, doc_id, raw)
        at += len(raw) // 4
    some = spark.createDataFrame([(9,), (10**12,), (-5,), (3,)], "doc_id long")
    assert sorted(r["doc_id"] for r in token_store.lookup(some, folder).collect()) == [3, 9]


def test_ranges_keep_the_order_and_split_hot_keys():
    rng = np.random.default_rng(2)
    keys, null = rng.choice([1, 5, 5, 5, 5, 9, -(2**63), 2**63 - 1], 4000), rng.random(4000) < 0.3
    ties = rng.integers(-2**63, 2**63 - 1, 4000)
    ranges = token_store.Ranges(3, [1, 5, 5, 5, 8])
    no = ranges.of(keys, null, ties)
    assert no.min() == 0 and no.max() < ranges.shards == 9 and set(no[null]) == {0, 1, 2} and set(no[~null & (keys == 5)]) == {4, 5, 6}
    order = np.lexsort((ties, np.where(null, 0, keys), ~null))
    assert (np.diff(no[order]) >= 0).all()


def test_a_key_is_read_by_ranges_not_by_the_whole_index(tmp_path, monkeypatch):
    """One key of 200,000 costs the head, some words of levels, an entry, two offsets and its ids."""
    n, folder = 200_000, str(tmp_path)
    keys = np.arange(n) * 7 - 1000
    lengths = np.full(n, 3)
    with open(f"{folder}/x.mph", "wb") as f:
        f.write(token_store._index_bytes(keys, lengths, 0, 2))
    with open(f"{folder}/x.ids", "wb") as f:
        f.write(np.arange(3 * n).astype("<u2").tobytes())
    assert token_store.Shard(folder, "x").records(np.array([5]))[1].tolist() == [0]
    shard = token_store.Shard(folder, "x")
    first, run = shard.records(keys[123_456:123_457])
    assert run.tolist() == [1] and first[0] == 123_456
    start, ids = shard.ids(first[:1])
    assert start.tolist() == [3 * 123_456] and next(ids).tolist() == (np.arange(3 * 123_456, 3 * 123_456 + 3) % 65536).tolist()
    spent = sum(s.spent for s in (*shard.levels, shard.table, shard.offsets))
    assert spent < 2_000
    first, run = shard.records(keys)  # all keys: sections are read whole
    assert (first == np.arange(n)).all() and (run == 1).all()


def test_store_query(spark):
    rows = QUERIES["op10_token_store"](spark, SF001).orderBy("doc_id").collect()
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    at = 0
    for r, d in zip(rows, spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect(), strict=True):
        ids = np.array(tok.encode(d["text"], add_special_tokens=False).ids + [0], "<u4")
        assert tuple(r) == (d["doc_id"], at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_encoder_keeps_the_words_of_a_large_vocabulary(monkeypatch):
    """Words beyond those kept go to the library once for each batch."""
    e = Encoder(tokenizer_path("byte_bpe_50k.json"))
    words = ["".join(chr(97 + i // 26 ** k % 26) for k in range(5)) for i in range(600_000)]
    parts = [" ".join(words[i:i + 40_000]) for i in range(0, len(words), 40_000)]
    first = [e.encode([part]) for part in parts]
    monkeypatch.setattr(e, "_encode_units", lambda units: pytest.fail(f"{len(units)} units are encoded again"))
    assert [e.encode([part]) for part in parts] == first


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_cuts_words_from_end_marks(name):
    texts = ["a.", " a!", "a", ".", "!", " !", " ", "", "ab.c", "a1.", "1.", "don't, I'll.", "é. Àb) ſa: x²", "a.\n b;\t\r\nc?", "'s 's. s's"]
    e = Encoder(tokenizer_path(name))
    assert e.encode(texts) == e._direct(texts) == [e.encode([t])[0] for t in texts]
