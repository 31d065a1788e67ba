"""Packing: ids, cuts, places and quality."""

import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from parcelflow.llm import packing, queries, tokens
from parcelflow.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "a", " a", "a ", "a  b", "a   b", "a\nb", "a\n b", "a \nb", "\n\n x", "don't we'll 's 'S", "<|endoftext|> x", "x <|endoftext|>", "naïve é e ́", "ΑΣ ΑΣ.", "日本 語", "a b", "a\tb\r\nc",
       "a  b", "\u0085x y", "x\x1cy z", "1234 5.6", "😀 👍🏽", "İ I ı", "ﬁ ſ", "퟿ ok", "a​ b", "x\u0000y"]


def fuzz(n, seed):
    rnd = random.Random(seed)
    parts = [" ", " ", " ", "\n", "a", "the", "B", "é", "'s", "'", "12", ".", "!!", "\t", "́", "ß", "Σ", "<", "|", "  "]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("path,cut", [(BYTE, "space"), (WORD, "white")])
def test_pieces_of_text_give_the_ids_of_the_whole(path, cut):
    texts = ODD + fuzz(3000, 2)
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    encoder = Encoder(path, cut, most=500)
    for at in range(0, len(texts), 100):
        ids, offsets = encoder.columns(pa.array([*texts[at : at + 100], None])[0:101])
        got = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
        assert [t for t, a, b in zip(texts[at:], got, [*want[at : at + 100], []]) if a != b] == []
        closed, ends = encoder.closed(pa.array(texts[at : at + 100]), 7)
        assert [closed[a:b].tolist() for a, b in zip(ends, ends[1:])] == [g + [7] for g in got[:-1]]
    assert encoder.columns(pa.array([], pa.string()))[1].tolist() == [0]


def test_frequent_pieces_stay_when_the_rest_is_dropped(monkeypatch):
    encoder = Encoder(BYTE, "space", most=100)
    for i in range(30):
        encoder.columns(pa.array([" ".join(["often", "seen", *(f"once{i}x{j}" for j in range(20))])]))
        assert len(encoder.starts) <= 130
    asked = []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda new, lead: asked.extend(new) or learn(new, lead))
    encoder.columns(pa.array(["often seen once0x0 rare"]))
    assert asked == ["once0x0", "rare"]


def test_hashes_tell_pieces_apart():
    pieces = pa.array([f"{a}{b}{c}" for a in "abcé" for b in ["", "x", "yy"] for c in range(300)] + ["", "a", "aa", "aaa", "é" * 40])
    both = [tokens._hashed(pieces, salt)[0] for salt in (1, 2)]
    assert len(set(both[0].tolist()) | set(both[1].tolist())) == 2 * len(pieces)
    assert tokens._hashed(pieces.slice(7, 9), 1)[0].tolist() == both[0][7:16].tolist()


def test_an_idle_encoder_forgets_and_learns_again(monkeypatch):
    monkeypatch.setattr(tokens, "IDLE_SECONDS", 0)
    encoder = Encoder(BYTE, "space")
    text = pa.array(["some words to know"])
    want = encoder.columns(text)[0].tolist()
    deadline = time.monotonic() + 20
    while len(encoder.keys) and time.monotonic() < deadline:
        time.sleep(0.2)
    assert not len(encoder.keys) and len(encoder.starts) == 1
    assert encoder.columns(text)[0].tolist() == want


def sound(rows, texts, size=2048):
    """texts: (doc_id, text) of each row. Pieces cover each document once, and sequences hold them gapless."""
    tokenizer = Tokenizer.from_file(BYTE)
    want = []
    for doc, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        count = -(-len(ids) // size)
        head = len(ids) - size * (count - 1)
        cuts = [0, *range(head, len(ids) + 1, size)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((doc, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str) == sorted(want, key=str)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(by), -(-sum(w[3] for w in want) // size)


def test_query_places_every_piece(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    used, least = sound(queries.op7_packing(spark, SF).collect(), docs)
    assert used <= least * 1.02 + 1


def test_districts_are_merged_and_packed_well(spark, docs):
    rnd = random.Random(3)
    rows = [(i, "a " * rnd.choice([3, 50, 300, 700, 1100, 1500, 2047, 2048, 5000])) for i in range(600)]
    found = packing.pieces(docs(rows), BYTE)
    used, least = sound(packing.pack(found, district_rows=60, islands=3).collect(), rows)
    assert used <= least * 1.08


def test_pieces_that_cannot_share_end_at_once(spark, docs):
    rows = [(i, "a " * 1500) for i in range(50)]
    used, _ = sound(packing.pack(packing.pieces(docs(rows), BYTE), district_rows=10).collect(), rows)
    assert used == 50


def test_poor_bins_are_dealt_again_while_a_deal_fills_any(spark, monkeypatch):
    """Of 360 pieces most cannot share: after the first deal, which leaves more than half, none was dealt again."""
    rnd = random.Random(5)
    rows = [(i, i, 0, 0, length, 0) for i, length in enumerate([1500] * 240 + [rnd.randrange(400, 700) for _ in range(120)])]
    dealt, plain = [], packing.materialise
    monkeypatch.setattr(packing, "materialise", lambda df, label: (lambda t: dealt.append((label, t.count())) or t)(plain(df, label)))
    found = packing.pack(spark.createDataFrame(rows, packing.PIECES), district_rows=40).collect()
    left = [360, *(n for label, n in dealt if label == "open")]
    assert len(left) > 2 and left[1] > 180 and all(a >= b for a, b in zip(left, left[1:]))
    assert left[-1] == left[-2] or -(-left[-2] // 40) == 1
    bins = {}
    for r in found:
        bins[r["sequence_id"]] = bins.get(r["sequence_id"], 0) + r["length"]
    assert sorted(r["doc_id"] for r in found) == list(range(360)) and max(bins.values()) <= 2048
    assert sum(n >= 0.98 * 2048 for n in bins.values()) >= len([n for n in left if n]) - 1


def test_children_hold_every_item_once_and_bins_fit():
    rnd = random.Random(9)
    lengths = [rnd.randrange(1, 100) for _ in range(300)]
    individuals = packing.evolve(lengths, [], 100, 5, 4, rnd)
    for bins in [*individuals, packing.cross(individuals[0], individuals[1], lengths, 100, rnd), packing.mutate(individuals[0], lengths, 100, rnd)]:
        assert sorted(i for b in bins for i in b) == list(range(300))
        assert max(sum(lengths[i] for i in b) for b in bins) <= 100
    plain: list = []
    packing.best_fit(plain, [], sorted(range(300), key=lambda i: -lengths[i]), lengths, 100)
    assert len(individuals[0]) <= len(plain)


def test_edge_rows(spark, docs):
    rows = [(1, None), (1, None), (None, "x y"), (2, ""), (3, "same"), (3, "same"), (4, "long " * 20000)]
    frame = docs(rows).withColumnRenamed("lang", "row").withColumnRenamed("source", "piece")
    sound(packing.pack(packing.pieces(frame, BYTE)).collect(), rows)
    assert packing.pack(packing.pieces(docs([]), BYTE)).collect() == []
