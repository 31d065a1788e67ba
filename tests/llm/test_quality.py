"""Kneser-Ney perplexities and thresholds against a plain version, and what is kept."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from parcelflow.llm import quality, queries

SF = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int"


def plain_codes(text):
    return [ord(c) + 1 if ord(c) < quality.OWN else quality.OWN + 1 + ord(c) % quality.SHARED for c in text]


def plain_grams(text, order):
    seq = [0] * (order - 1) + plain_codes(text)
    return [tuple(seq[i : i + order]) for i in range(len(text))]


class PlainModel:
    """Interpolated modified Kneser-Ney over tuples."""

    def __init__(self, texts, order):
        self.order = order
        self.n = {order: Counter(g for t in texts for g in plain_grams(t, order))}
        for k in range(order - 1, 0, -1):
            self.n[k] = Counter(g[1:] for g in self.n[k + 1])
        self.d, self.total, self.left = {}, {}, {}
        for k, table in self.n.items():
            c = Counter(table.values())
            y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0.5
            self.d[k] = [min(i, max(0.05, i - (i + 1) * y * c[i + 1] / c[i] if c[i] else 0.5 * i)) for i in (1, 2, 3)]
            total, left = defaultdict(int), defaultdict(float)
            for g, n in table.items():
                total[g[:-1]] += n
                left[g[:-1]] += self.d[k][min(n, 3) - 1]
            self.total[k], self.left[k] = total, left

    def p(self, g):
        if not g:
            return 1 / (len(self.n[1]) + 1)
        k = len(g)
        total = self.total[k].get(g[:-1])
        if not total:
            return self.p(g[1:])
        n = self.n[k].get(g, 0)
        own = max(n - self.d[k][min(n, 3) - 1], 0) if n else 0
        return own / total + self.left[k][g[:-1]] / total * self.p(g[1:])

    def bits(self, text):
        return -sum(math.log2(self.p(g)) for g in plain_grams(text, self.order))


@pytest.mark.parametrize("order", [2, 4, 5])
def test_perplexities_equal_the_plain_model(spark, docs, monkeypatch, order):
    monkeypatch.setattr(quality, "PIECE", 300)
    rnd = random.Random(order)
    rows = [(i, "".join(rnd.choice("aab cé日本\n") for _ in range(rnd.choice([0, 1, 3, 40, 900])))) for i in range(120)]
    labels = [(i, 1, 0) for i in range(0, 100, 2)] + [(1, 0, 0), (3, 1, 1), (3, 1, None)]
    judged = quality.judge(docs(rows), spark.createDataFrame(labels, LABELS), order=order).collect()
    train = {i for i, q, t in labels if q == 1 and not t and zlib.crc32(str(i).encode()) % 5}
    model = PlainModel([t for i, t in rows if i in train], order)
    assert len(judged) == len(rows)
    for r in judged:
        text = dict(rows)[r["doc_id"]]
        if not text:
            assert r["perplexity"] is None and not r["keep"]
        else:
            assert math.isclose(math.log2(r["perplexity"]) * len(text), model.bits(text), rel_tol=1e-9), text


def test_probabilities_sum_to_one():
    model = PlainModel(["abab abc", "bca"], 3)
    seen = [g[0] for g in model.n[1]]
    for context in ([1, 2], [98, 99], [5, 98]):
        total = sum(model.p((*context, c)) for c in seen) + model.p((*context, 4000))
        assert math.isclose(total, 1, rel_tol=1e-9)


def test_thresholds_are_quantiles_of_held_out_trusted_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, ["en", "de", None][i % 3], int(i % 2), int(rng.integers(1, 500)), 100 if i % 7 else 0) for i in range(3000)]
    scored = spark.createDataFrame(rows, "doc_id bigint, lang string, band int, step bigint, n_chars bigint")
    ids = spark.createDataFrame([(i,) for i in range(2000)], "doc_id bigint")
    out = {(r["lang"], r["band"]): r["limit"] for r in quality.thresholds(scored, ids, 0.9, 10).collect()}
    for (lang, band), limit in out.items():
        mine = sorted(s for i, la, b, s, n in rows if i < 2000 and zlib.crc32(str(i).encode()) % 5 == 0 and la == lang and b == band and n)
        assert limit == mine[math.ceil(0.9 * len(mine)) - 1]
    assert len(out) == 6
    pooled = {r["limit"] for r in quality.thresholds(scored, ids, 0.9, 10**6).collect()}
    assert len(pooled) == 1


def test_clean_documents_stay_and_junk_goes(spark):
    truth = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op1_quality(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    good = [r["keep"] for r in rows if truth.get(r["doc_id"], (0, 1))[0] == 1]
    bad = [r["keep"] for r in rows if truth.get(r["doc_id"], (1, 1))[0] == 0]
    assert np.mean(good) > 0.98, np.mean(good)
    assert np.mean(bad) < 0.5, np.mean(bad)


def test_keep_leaves_columns_and_other_rows_alone(spark, docs):
    rows = [(i, "the cat sat on the mat and the dog ran " * 3, "en") for i in range(40)] + [(100, "@#$%^&*()" * 20, "en"), (101, None, "en"), (102, "", None), (None, "the cat sat", "en"), (5, "the cat sat on the mat " * 4, "en")]
    frame = docs(rows).withColumnRenamed("n_chars", "keep").withColumnRenamed("source", "bits")
    path = quality.materialise(frame)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], LABELS)
    left = quality.keep(path, labels)
    assert left.columns == frame.columns
    kept = {(r["doc_id"], r["text_hash"]) for r in quality.judge(path, labels).collect() if r["keep"]}
    hashed = left.select("doc_id", quality.F.xxhash64(left["text"].cast("binary"))).collect()
    assert {tuple(r) for r in hashed} == kept and len(hashed) == len(kept)
    ids = [r[0] for r in hashed]
    assert set(range(40)) <= set(ids) and not {100, 101, 102} & set(ids)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], LABELS)
    assert quality.judge(docs([]), none).collect() == []
    kept = {r["doc_id"]: r["keep"] for r in quality.judge(docs([(1, "abc"), (2, None), (None, "x")]), none).collect()}
    assert kept == {1: True, 2: False, None: True}


def test_small_languages_are_judged_by_their_own_rows(spark, docs):
    """The trusted rows of zz are noise; a rare language beside it must not inherit what they allow."""
    rnd = random.Random(5)
    words = "the cat sat on a mat and dog ran by old barn".split()

    def plain(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    def noise(n):
        return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz 0123456789") for _ in range(n))

    rows = [(i, plain(rnd.choice([20, 60, 200])), "en") for i in range(150)] + [(i, noise(rnd.choice([90, 300, 900])), "zz") for i in range(200, 350)]
    rows += [(i, noise(n), "en") for i, n in ((1000, 100), (1001, 300), (1002, 900))] + [(1003, noise(300), "zz"), (1004, noise(300), None)]
    labels = spark.createDataFrame([(r[0], 1, 0) for r in rows if r[0] < 1000], LABELS)
    kept = {r["doc_id"]: r["keep"] for r in quality.judge(docs(rows), labels).collect()}
    assert not kept[1000] and not kept[1001] and not kept[1002]
    assert kept[1003] and kept[1004]
    assert np.mean([kept[i] for i in range(150)]) > 0.95


def test_characters_of_every_script_stay_distinct(spark, docs):
    """Each character of a Chinese text moved by 190 code points is another text, and 16 bits a character fill the long."""
    rnd = random.Random(6)
    clean = [0x4E00 + i for i in range(120)]
    rows = [(i, "".join(chr(rnd.choice(clean)) for _ in range(200)), "zh") for i in range(60)]
    rows += [(100, rows[0][1], "zh"), (101, "".join(chr(ord(c) + 190) for c in rows[0][1]), "zh"), (102, "ab", "zh")]
    judged = {r["doc_id"]: r for r in quality.judge(docs(rows), spark.createDataFrame([(i, 1, 0) for i in range(60)], LABELS)).collect()}
    model = PlainModel([t for i, t, _ in rows[:60] if zlib.crc32(str(i).encode()) % 5], 4)
    for i, text, _ in rows:
        assert math.isclose(math.log2(judged[i]["perplexity"]) * len(text), model.bits(text), rel_tol=1e-9)
    assert judged[101]["perplexity"] > 2 * judged[100]["perplexity"] and judged[100]["keep"] and not judged[101]["keep"]


def test_large_alphabets_use_whole_longs(spark, docs):
    points = [p for p in range(0x4E00, 0x4E00 + 40_000) if not 0xD800 <= p < 0xE000]
    text = "".join(map(chr, points))
    rows = [(i, text[i * 7 :] + text[: i * 7]) for i in range(1, 5)] + [(50, text[100:300] + "z" + text[5:50])]
    judged = {r["doc_id"]: r for r in quality.judge(docs(rows), spark.createDataFrame([(i, 1, 0) for i in range(1, 5)], LABELS)).collect()}
    model = PlainModel([t for i, t in rows[:4] if zlib.crc32(str(i).encode()) % 5], 4)
    assert quality.Alphabet(np.array(points), 4).bits == 16
    for i, t in rows:
        assert math.isclose(math.log2(judged[i]["perplexity"]) * len(t), model.bits(t), rel_tol=1e-9)


def test_one_odd_row_sets_no_threshold(spark):
    """Up to 3,000 rows, the 0.999 quantile follows the tail of the rows and not the largest of them."""
    rng = np.random.default_rng(3)
    steps = [int(s) for s in rng.normal(2300, 35, 2000)]
    ids = spark.createDataFrame([(i,) for i in range(2000)], "doc_id bigint")

    def limit(odd):
        rows = [(i, "en", 2, odd if odd and i == first else s, 1600) for i, s in enumerate(steps)]
        scored = spark.createDataFrame(rows, "doc_id bigint, lang string, band int, step bigint, n_chars bigint")
        (r,) = quality.thresholds(scored, ids, 0.999, 200, alone=1).collect()
        return r["centre"] + r["rise"] / 40 if r["limit"] is None else r["limit"]

    first = next(i for i in range(2000) if zlib.crc32(str(i).encode()) % 5 == 0)
    plain = limit(None)
    assert 2300 + 3 * 35 < plain < 2300 + 7 * 35
    assert abs(limit(9000) - plain) < 35
