"""Id files: exact round trips, damage, and documents read back."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from parcelflow.llm import coder, queries, tokenfiles

SF = "/root/testdata/sf0.001"
WORD = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 513, 5000, 40_000])
@pytest.mark.parametrize("kind", ["same", "uniform", "skewed", "repeated", "edge"])
def test_round_trip(n, kind):
    rng = np.random.default_rng(n)
    ids = {"same": np.full(n, 49_407), "uniform": rng.integers(0, 49_408, n), "skewed": rng.zipf(1.3, n) % 49_408,
           "repeated": np.resize(rng.integers(0, 49_408, 37), n), "edge": np.where(np.arange(n) % 2, 0, 49_407)}[kind]
    block = coder.encode(ids, 49_408)
    assert np.array_equal(coder.decode(block), ids)


@pytest.mark.parametrize("vocab", [2, 3, 90, 5000, 49_408, 1 << 20])
def test_round_trip_of_few_and_of_very_frequent_ids(vocab):
    """One or two ids that hold nearly all of the block, with all others now and then, in vocabularies of any size."""
    rng = np.random.default_rng(vocab)
    for share in (0.5, 0.99, 0.9999):
        ids = np.where(rng.random(30_000) < share, rng.integers(0, 2, 30_000), rng.integers(0, vocab, 30_000))
        ids[15_000:20_000] = vocab - 1
        assert np.array_equal(coder.decode(coder.encode(ids, vocab)), ids)


def test_predictions_shorten_what_repeats():
    rng = np.random.default_rng(0)
    noise = rng.integers(0, 49_408, 60_000)
    assert len(coder.encode(np.resize(noise[:50], 60_000), 49_408)) < 0.1 * len(coder.encode(noise, 49_408))
    assert len(coder.encode(rng.zipf(1.5, 60_000) % 49_408, 49_408)) < 0.7 * 2 * 60_000


def test_blocks_do_not_depend_on_each_other():
    a, b = np.arange(3000) % 700, np.arange(2000) % 300
    assert coder.encode(b, 800) == coder.encode(b, 800)
    coder.encode(a, 800)
    assert np.array_equal(coder.decode(coder.encode(b, 800)), b)


def test_damage_is_found():
    block = bytearray(coder.encode(np.arange(1000) % 90, 100))
    for at in (0, 8, 20, 27, len(block) // 2, len(block) - 1):
        bad = bytearray(block)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            coder.decode(bytes(bad))
    with pytest.raises(ValueError):
        coder.decode(bytes(block[:-2]))
    with pytest.raises(ValueError):
        coder.encode(np.array([5]), 5)


def plain(rows):
    tokenizer, out, at = Tokenizer.from_file(WORD), [], 0
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_query_equals_plain_encoding(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    ids = [d for d, _ in docs]
    got, want = queries.op5_tokenfiles(spark, SF).collect(), plain(docs)
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((d, n, c) for d, _, n, c in want)
    once = {d for d in ids if ids.count(d) == 1}
    assert {(r["doc_id"], r["start"]) for r in got if r["doc_id"] in once} == {(d, s) for d, s, _, _ in want if d in once}
    ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_small_blocks_and_ids_come_back(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "BLOCK_IDS", 50)
    rows = [(i, f"word {i} and {'more ' * (i % 40)}") for i in range(200)]
    tokenfiles.write(docs(rows), f"{tmp_path}/ids", WORD, 49_408)
    assert spark.read.parquet(f"{tmp_path}/ids").count() > 30
    tokenizer = Tokenizer.from_file(WORD)
    got = {r["doc_id"]: r["ids"] for r in tokenfiles.read(spark, f"{tmp_path}/ids").collect()}
    assert got == {i: tokenizer.encode(t, add_special_tokens=False).ids + [2] for i, t in rows}


def test_edge_rows(spark, docs, tmp_path):
    rows = [(None, "no id"), (1, None), (2, ""), (3, "twice"), (3, "twice"), (-5, "first"), (9, "long " * 50_000)]
    frame = docs(rows).withColumnRenamed("lang", "ids").withColumnRenamed("source", "place")
    tokenfiles.write(frame, f"{tmp_path}/ids", WORD, 49_408)
    want = plain(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))
    assert sorted(map(tuple, tokenfiles.checksums(spark, f"{tmp_path}/ids").collect()), key=str) == sorted(want, key=str)
    tokenfiles.write(docs([]), f"{tmp_path}/none", WORD, 49_408)
    assert tokenfiles.checksums(spark, f"{tmp_path}/none").collect() == []
