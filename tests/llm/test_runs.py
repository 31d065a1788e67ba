"""Runs against a plain search over all periods, and the query against a plain reading of its contract."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import queries, runs, words

SF = "/root/testdata/sf0.001"


def plain_runs(x, least=12):
    """Runs of a list: for each period the stretches that keep it, the smallest period of each."""
    found = {}
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i + q < len(x):
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in found.items())


def plain_words(text):
    return [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]


def plain_row(doc_id, text, planted=True):
    w = plain_words(text)
    if planted and doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(w)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in sorted(found, key=lambda r: (r[0], r[2])))
    rest = " ".join(x for i, x in enumerate(w) if i not in dropped)
    first = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(found), *first, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest.encode()).hexdigest())


def test_transform_is_exact_and_convolves():
    draw = np.random.default_rng(1)
    for n in (2, 16, 128, 512, 4096):
        x, y = draw.integers(-runs._HALF, runs._HALF, (2, 1, n)).astype(float)
        assert ((runs.transform(runs.transform(x), True) - x * n) % runs.PRIME == 0).all()
        if n <= 512:
            product = runs.transform(runs._reduced(runs.transform(x) * runs.transform(y)), True)[0]
            want = [sum(int(x[0, j]) * int(y[0, (i - j) % n]) for j in range(n)) * n % runs.PRIME for i in range(n)]
            assert [int(v) % runs.PRIME for v in product] == want


@pytest.mark.parametrize("largest", [8, runs.LARGEST])
def test_all_runs_of_random_stretches(monkeypatch, largest):
    monkeypatch.setattr(runs, "LARGEST", largest)
    monkeypatch.setattr(runs, "CHUNK", 64)
    draw = random.Random(5)
    for _ in range(120):
        docs = []
        for _ in range(draw.randint(1, 5)):
            n, k = draw.choice([0, 1, 11, 12, 13, 40, 90, 200]), draw.choice([1, 2, 3, 40])
            d = [draw.randrange(k) for _ in range(n)]
            if n > 4:
                a = draw.randrange(n)
                p, b = 1 + (n - a) // draw.randint(2, 9), draw.randint(a, n)
                d[a:b] = [d[a + (i - a) % p] for i in range(a, b)]
            docs.append(d)
        offsets = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
        got = [x.tolist() for x in runs.find(np.array(sum(docs, []), np.int64), offsets)]
        want = sorted((a + offsets[i], b, q) for i, d in enumerate(docs) for a, b, q in plain_runs(d))
        assert list(zip(*got)) == [tuple(map(int, w)) for w in want]


def test_smallest_run_and_nested_runs():
    one = lambda w: [tuple(int(v[0]) for v in runs.find(np.array(w), np.array([0, len(w)])))] if len(runs.find(np.array(w), np.array([0, len(w)]))[0]) else []
    assert one([7] * 11) == [] and one([7] * 12) == [(0, 12, 1)]
    assert one(list(range(6)) * 2) == [(0, 12, 6)] and one(list(range(6)) * 2 + [0, 9]) == [(0, 13, 6)]
    assert one(list(range(7)) + list(range(6))) == []


def test_query_equals_plain_reading(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in queries.op11_runs(spark, SF).collect())
    assert got == sorted(plain_row(r["doc_id"], r["text"]) for r in docs)


def test_edge_rows(spark, docs):
    """Nulls, empty texts, repeated rows, null ids, all kinds of white space, and columns of any other name."""
    long = " ".join(["a", "b", "c"] * 70_000)
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "x " * 20), (5, "x\x0by\x0cx\ry\tx\ny " * 4), (5, "x\x0by\x0cx\ry\tx\ny " * 4), (6, long), (7, "  é" * 30)]
    table = docs(rows).withColumns({"runs": F.lit(1), "t": F.lit("z"), "start": F.lit(2)})
    got = runs.runs(table).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for doc_id, text in rows:
        r = by_id[doc_id]
        want = plain_runs(plain_words(text)) if text != long else [(0, 210_000, 3)]
        assert [tuple(x) for x in r["runs"]] == want and r["n_words"] == len(plain_words(text))
    assert by_id[None]["collapsed"] == "x" and by_id[6]["collapsed"] == "a b c" and by_id[1]["collapsed"] == ""
    assert runs.runs(docs([])).collect() == []


def test_words_of_bytes():
    import pyarrow as pa

    found, offsets = words.split(pa.array(["Éa B", None, "", " c\td ", "e"]), lower=True)
    assert found.to_pylist() == ["Éa".encode(), b"b", b"c", b"d", b"e"] and offsets.tolist() == [0, 2, 2, 2, 4, 5]
