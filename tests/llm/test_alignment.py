"""Alignments against whole encodings, token by token, and corpus counts in plain Python."""

import hashlib
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from parcelflow.llm import alignment, queries

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Rows of (doc_id, text) read token by token."""
    first, second = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    letters = {}
    n = 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            letters[chr(b)] = b
        else:
            letters[chr(256 + n)] = b
            n += 1

    def a_bytes(i):
        return bytes(letters[c] for c in first.id_to_token(i))

    def b_bytes(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()

    def rows(docs):
        read, counts = [], Counter()
        for doc_id, text in docs:
            ids_a = first.encode(" " + text, add_special_tokens=False).ids if text else []
            ids_b = second.encode(text) if text else []
            whole = (" " + (text or "")).encode()
            if not text or b"".join(map(a_bytes, ids_a)) != whole or b"".join(map(b_bytes, ids_b)) != whole:
                read.append((doc_id, [], [], [], []))
                continue
            ends = []
            for ids, of in ((ids_a, a_bytes), (ids_b, b_bytes)):
                at, found = 0, {}
                for k, i in enumerate(ids):
                    at += len(of(i))
                    found[at] = k
                ends.append(found)
            groups, links, i, j = [], [], 0, 0
            for end in sorted(set(ends[0]) & set(ends[1])):
                p, q = ends[0][end] + 1, ends[1][end] + 1
                groups.append(",".join(map(str, ids_a[i:p])) + "|" + ",".join(map(str, ids_b[j:q])))
                links.append((ids_a[p - 1], ids_b[q - 1]))
                i, j = p, q
            counts.update(links)
            read.append((doc_id, ids_a, ids_b, groups, links))
        most = {}
        for (_, b), n in counts.items():
            most[b] = max(most.get(b, 0), n)
        return [
            (d, len(a), len(b), len(g), len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "")
            for d, a, b, g, x in read
        ]

    return rows


def test_query_equals_whole_encodings(spark, plain):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op12_alignment(spark, SF).collect())) == sorted(plain(docs))


ODD = [
    (1, None), (2, ""), (3, " "), (4, "a  b   c "), (5, " lead"), (6, "x<|endoftext|>y <s> z </s> <unk> <0x0A>"), (7, "▁ is no space"), (8, "tab\there\nline\r\n\x0b"),
    (9, "café é ﬁ ½ ① \U0001f600\U0001f3fd 日本語 ال"), (9, "café é"), (None, "no id"), (11, "a b   c"), (12, "word " * 3000), (13, "don't 12345 !!!??? a.b"), (14, "\x00 nul"),
    (15, "longword" * 2000),
]


@pytest.mark.parametrize("small", [False, True])
def test_edge_rows(spark, docs, plain, monkeypatch, small):
    """Nulls, white space of all kinds, control strings, texts that B does not give back, long words, repeated rows; clashing columns."""
    if small:  # many blocks; memory that is dropped all the time
        found = {}
        a, b = alignment.Spaced(A, most=5), alignment.Spaced(B, most=5)
        windows = alignment.Windows(a.sizes, b.sizes)
        monkeypatch.setattr(alignment, "WINDOWS", 3)
        for doc_id, text in ODD:
            got = alignment.align(pa.array([text], pa.string()), a, b, windows)
            found.setdefault(doc_id, []).append((int(got["n_a"][0]), int(got["n_b"][0]), int(got["n_groups"][0]), hashlib.sha256(got["groups"][0]).hexdigest() if got["groups"][0] else ""))
        assert sorted((str(d), x) for d, xs in found.items() for x in xs) == sorted((str(r[0]), (*r[1:4], r[7])) for r in plain(ODD))
        return
    table = docs(ODD).withColumns({"row": F.lit(1), "t": F.lit("x"), "block": F.lit(3), "slot": F.lit(4)})
    got, pairs = alignment.aligned(table, A, B)
    rows = got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, plain(ODD)))
    assert {r["doc_id"] for r in rows if r["groups_sha256"] == ""} >= {1, 2, 7}
    assert all(r["best"] for r in pairs.groupBy("b").agg(F.max("best").alias("best")).collect())
    none, pairs = alignment.aligned(docs([]), A, B)
    assert none.collect() == [] and pairs.collect() == []
